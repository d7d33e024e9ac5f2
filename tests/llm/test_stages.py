"""The pipeline's stages keep the columns that documents came with, whatever their names, and nulls and repeated rows."""

import numpy as np
import pyarrow as pa
import pytest

from fairspark.llm import decontaminate, near_duplicates, quality_rules, repeats

NAMES = ["score", "items", "spans", "text_key", "_row", "_w", "_word", "kept", "Node", "hits", "kept_bytes", "base_failed", "_all"]
STAGES = [quality_rules.quality_stage, near_duplicates.near_duplicate_stage, repeats.repeats_stage, decontaminate.decontamination_stage]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("sf"))
    words = "the quick brown fox jumps over a lazy dog while seven wizards brew fine ale behind old barns".split()
    spark.createDataFrame([("i1", " ".join(words[:12]))], "item_id string, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def documents(spark, extra=NAMES):
    base = "the quick brown fox jumps over a lazy dog while seven wizards brew fine ale behind old barns"
    rows = [(i, f"{base} number {i} " + " ".join(f"w{i}x{j}" for j in range(80)), "en", "s", 7) for i in range(20)]
    rows += [(3, rows[3][1], "en", "s", 7), (None, rows[4][1], "en", "s", 7), (None, None, "en", "s", None), (30, "", None, None, 0), (31, None, "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{n}` string" for n in extra)
    return spark.createDataFrame([(*r, *[f"{n}-{i}" for n in extra]) for i, r in enumerate(rows)], schema)


@pytest.mark.parametrize("stage", STAGES, ids=lambda f: f.__name__)
def test_columns_stay(spark, sf_dir, stage):
    docs = documents(spark)
    got = stage(spark, docs, sf_dir)
    assert got.columns == docs.columns and got.schema.simpleString() == docs.schema.simpleString()
    for r in got.collect():
        assert len({str(r[n]).rsplit("-", 1)[1] for n in NAMES}) == 1 and all(str(r[n]).startswith(f"{n}-") for n in NAMES)
    plain = stage(spark, documents(spark, []), sf_dir)
    assert sorted(map(str, plain.collect())) == sorted(str(r) for r in got.select(plain.columns).collect())


@pytest.mark.parametrize("stage", STAGES, ids=lambda f: f.__name__)
def test_no_documents(spark, sf_dir, stage):
    docs = documents(spark).limit(0)
    assert stage(spark, docs, sf_dir).count() == 0


def test_near_duplicates_leave_one_row_of_each_group(spark, sf_dir):
    got = near_duplicates.near_duplicate_stage(spark, documents(spark), sf_dir).collect()
    ids = [r["doc_id"] for r in got if r["text"]]
    assert sorted(ids) == list(range(20))
    assert sum(not r["text"] for r in got) == 3  # texts without words stay


def test_decontamination_cuts_the_passage(spark, sf_dir):
    got = decontaminate.decontamination_stage(spark, documents(spark), sf_dir).collect()
    assert len(got) == 25
    assert not any("fox jumps" in (r["text"] or "") for r in got) and sum("behind old barns" in (r["text"] or "") for r in got) == 22


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abcdef \n"), 300)) for _ in range(50)]
    from pyspark.sql import types as T  # noqa: F401
    ratios = rng.normal(size=1 << quality_rules.BITS)
    whole = np.rint(ratios * quality_rules.SCALE).astype(np.int64)

    def score(part):
        buf, off = quality_rules.flat(pa.array(part))
        g = quality_rules.buckets(buf)
        ok = quality_rules.inside(off, len(g))
        value = np.zeros(len(buf), np.int64)
        value[:len(g)] = np.where(ok, whole[g], 0)
        total = np.concatenate([[0], np.cumsum(value)])
        return (total[off[1:]] - total[off[:-1]]).tolist()

    assert score(texts) == [score([t])[0] for t in texts]
