"""Words of a line are counted where the line arrives."""

from fairspark.operators import words


def test_per_doc_counts_shuffle_lines(spark):
    rows = [(1, 0, "a b a"), (1, 0, "a"), (1, 1, ""), (2, 0, "   "), (None, 0, "b b"), (None, 0, "b"), (3, 0, " x")]
    got = words.per_doc_counts(spark.createDataFrame(rows, "doc_id long, line_no int, value string"))
    assert {tuple(r) for r in got.collect()} == {(1, 0, "a", 3), (1, 0, "b", 1), (1, 1, "", 1), (None, 0, "b", 3),
                                                 (3, 0, "", 1), (3, 0, "x", 1)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 1 and "hashpartitioning(doc_id" in final
    assert "word" not in final[final.index("Exchange hashpartitioning"):].splitlines()[0]
