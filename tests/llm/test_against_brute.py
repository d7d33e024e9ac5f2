"""Each operator that SQL cannot express, on whole small tables against plain Python."""

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as se
from . import brute

SF = "/root/testdata/sf0.001"


def pairs(spark, name, *cols):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*cols).collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return pairs(spark, "documents", "doc_id", "text")


def rows(spark, name, cols):
    return sorted(tuple(r) for r in se.queries()[name](spark, SF).select(*cols).collect())


def test_op3(spark, docs):
    got = rows(spark, "op3_near_duplicates", ["doc_id", "n_shingles", "component_id", "kept"])
    assert got == sorted((d, n, c, d == c) for d, n, c in brute.near_duplicates(docs))


def test_op4(spark, docs):
    got = rows(spark, "op4_decontaminate", ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    assert got == sorted(brute.contamination(docs, pairs(spark, "benchmark", "item_id", "text")))
    assert any(r[-1] for r in got)


def test_op6(spark, docs):
    got = rows(spark, "op6_quality_rules", ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                            "base_failed", "kept"])
    want = []
    for d, t in docs:
        s = brute.base_stats(t)
        want.append((d, *s, s[0] < 10 or 100 * s[4] > 20 * s[0]))
    assert [r[:-1] for r in got] == sorted(want)
    assert not any(r[-1] and r[-2] for r in got)
    quality = dict(pairs(spark, "labels", "doc_id", "quality"))
    good = [r[-1] for r in got if quality.get(r[0]) == 1 and not r[-2]]
    bad = [r[-1] for r in got if quality.get(r[0]) == 0]
    assert np.mean(good) == 1 and np.mean(bad) < 0.1


def test_op7(spark, docs):
    got = rows(spark, "op7_suffix_dedup", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    want = sorted(brute.repeats(docs, 400))
    assert got == want and sum(r[2] for r in want)


def test_op2(spark, docs):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    ids = {d: brute.token_ids(lib, t, 0) for d, t in docs}
    got = rows(spark, "op2_packing", ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    at, sequences = defaultdict(int), defaultdict(list)
    for d, start, n, crc, total, seq, off in got:
        assert start == at[d] and total == len(ids[d]) and crc == brute.crc(ids[d][start:start + n])
        at[d] += n
        sequences[seq].append((off, n))
    assert {d: len(x) for d, x in ids.items()} == dict(at)
    padded = 0
    for s in sequences.values():
        end = 0
        for off, n in sorted(s):
            assert off == end
            end += n
        assert end <= 1024
        padded += end if end & (end - 1) == 0 else 1024
    assert padded < 1.01 * sum(at.values()) + 2048


def test_op10(spark, docs):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lib.encode_special_tokens = True
    start, want = 0, []
    for d, t in sorted(docs):
        x = brute.token_ids(lib, t, 1)
        want.append((d, start, len(x), brute.crc(x)))
        start += len(x)
    assert rows(spark, "op10_token_files", ["doc_id", "start", "n_tokens", "ids_crc32"]) == want


def test_op9_held_out_accuracy(spark):
    got = se.queries()["op9_quality_model"](spark, "/root/testdata/sf0.01").collect()
    quality = {r[0]: r[1] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality").collect()}
    held = [(r["predicted"], quality[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in quality]
    assert len(got) == 1000 and len(held) > 30 and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([p == q for p, q in held]) > 0.95
    assert 0.1 < np.mean([r["held_out"] for r in got]) < 0.3
