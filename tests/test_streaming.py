from fairspark.streaming import running_group_costs, running_word_counts, start, text_stream


def test_running_word_counts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("a b b\nc\n")
    q = start(running_word_counts(text_stream(spark, str(src))), "wc_test", "memory")
    try:
        q.processAllAvailable()
        (src / "b.txt").write_text("b c  d\n")
        q.processAllAvailable()
        got = {r["word"]: r["n"] for r in spark.sql("SELECT * FROM wc_test").collect()}
    finally:
        q.stop()
    assert got == {"a": 1, "b": 3, "c": 2, "": 1, "d": 1}


def test_running_group_costs(spark, tmp_path):
    src = tmp_path / "pts"
    src.mkdir()
    (src / "a.csv").write_text("0,0,A\n2,0,B\n")
    q = start(running_group_costs(text_stream(spark, str(src)), [(0.0, 0.0), (3.0, 0.0)], 2), "gc_test", "memory")
    try:
        q.processAllAvailable()
        (src / "b.csv").write_text("1,0,A\n")
        q.processAllAvailable()
        got = {r["grp"]: (r["n"], r["mean_cost"]) for r in spark.sql("SELECT * FROM gc_test").collect()}
    finally:
        q.stop()
    assert got == {"A": (2, 0.5), "B": (1, 1.0)}
