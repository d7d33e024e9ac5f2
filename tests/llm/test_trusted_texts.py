"""The texts that the labels trust: sent ids and shuffled texts give the same rows."""

import numpy as np

from fairspark.llm import quality_rules


def test_trusted_texts_stay(spark):
    docs = spark.createDataFrame([(1, "one"), (1, "one"), (2, "two"), (None, "none"), (3, None), (4, "four")], "doc_id long, text string")
    trusted = spark.createDataFrame([(1,), (3,), (4,), (9,)], "doc_id long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent, shuffled = quality_rules.trusted_texts(docs, trusted), quality_rules.trusted_texts(docs, trusted, 3)
        plan = sent._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        want = [(1, "one"), (1, "one"), (3, "None"), (4, "four")]
        for got in (sent, shuffled):
            assert sorted((r["doc_id"], str(r["text"])) for r in got.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_log_ratios_by_either_way(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text number {i} of many") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    sent = quality_rules.log_ratios(docs, labels)
    monkeypatch.setattr(quality_rules, "SENT_IDS", 0)
    assert np.array_equal(sent, quality_rules.log_ratios(docs, labels))
