"""The pipeline's stage of repeated passages: runs of words against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as se
from fairspark.llm import repeats
from . import brute as plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n=50):
    """What is left of each (doc_id, text): words in an n-word run that occurs before go."""
    seen, out = set(), {}
    for doc_id, text in sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = list(WORD.finditer(text))
        gone = [False] * len(words)
        for i in range(len(words) - n + 1):
            run = tuple(w.group() for w in words[i:i + n])
            if run in seen:
                gone[i:i + n] = [True] * n
            seen.add(run)
        kept, at, i = [], 0, 0
        while i < len(words):
            j = i
            while j < len(words) and gone[j]:
                j += 1
            if j > i:
                kept.append(text[at:words[i].start()])
                at = words[j - 1].end()
            i = j + 1
        out[doc_id, text] = "".join(kept) + text[at:]
    return out


def fixture(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß中") for _ in range(rng.randint(1, 6)))
    text = lambda n, sep=" ": sep.join(word() for _ in range(n))
    p50, p49, p60, short = text(50), text(49), text(60), " ".join("ab" for _ in range(55))
    rows = []
    for i in range(40):
        part = [text(rng.randint(0, 30)), rng.choice([p50, p49, p60, short, ""]), text(rng.randint(0, 60), rng.choice([" ", "\n", "  "])),
                rng.choice([p50, p60, "", p49]), text(rng.randint(0, 5))]
        rows.append((i, rng.choice([" ", "\n", "\t"]).join(part)))
    rows += [(40, rows[4][1]), (41, rows[4][1]), (42, None), (43, ""), (44, p60.replace(" ", "\n")), (45, p50), (None, text(70)), (46, "x"),
             (46, "x"), (47, " \n ")]
    return [(i, t, "en", "s", len(t) if t else 0) for i, t in rows]


def test_words_of_later_copies_go(spark):
    rows = fixture()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows)
    got = repeats.cut_repeats(docs, length=50 * repeats.WORD, unit=repeats.WORD).collect()
    assert len(got) == len(rows)
    for r in got:
        left = bytes(r["kept_bytes"]).decode()
        assert left == (want[r["doc_id"], r["text"]] if r["text"] is not None else "")


def test_stage_keeps_columns_and_drops_what_is_empty(spark):
    rows = fixture(8)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    got = repeats.repeats_stage(spark, docs, "")
    assert got.schema.names == docs.schema.names
    left = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in got.collect()), key=str)
    expect = []
    for i, t, _, _, n in rows:
        kept = want[i, t] if t is not None else None
        if kept == t:
            expect.append((i, t, n))
        elif kept.strip():
            expect.append((i, kept, len(kept)))
    assert left == sorted(expect, key=str)


@pytest.mark.parametrize("words,left", [(5, 5), (49, 49), (50, 50), (60, 1)])
def test_a_run_may_repeat_within_itself(spark, words, left):
    one = spark.createDataFrame([(1, "word " * words, "en", "s", 1)], SCHEMA)
    assert len(repeats.repeats_stage(spark, one, "").first()["text"].split()) == left


def test_no_rows_give_none(spark):
    assert repeats.repeats_stage(spark, spark.createDataFrame([], SCHEMA), "").count() == 0


def repeated_words(rows, n=50):
    """Words of every (doc_id, text) in an n-word run that also starts elsewhere."""
    texts = [WORD.findall(r[1] or "") for r in rows]
    seen = Counter(tuple(w[i:i + n]) for w in texts for i in range(len(w) - n + 1))
    out = []
    for row, w in zip(rows, texts):
        hit = {i + k for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for k in range(n)}
        out.append((row[0], len(hit)))
    return out


def test_op7_tells_of_passages_under_400_bytes(spark, tmp_path):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))
    passage, long_one = text(55), text(120)
    assert len(passage) < 400 < len(long_one)
    rows = [(1, f"{text(30)} {passage} {text(30)}"), (2, f"{text(9)}\n{passage}\n{text(40)}"), (3, text(200)), (4, f"{long_one} {text(9)}"),
            (5, f"{text(20)} {long_one}"), (None, text(60)), (7, None), (8, ""), (9, "word " * 51), (9, "word " * 51), (10, passage[:-1])]
    rows += [(r[0], r[1], "en", "s", 1) for r in fixture(4)]
    rows = [(r[0], r[1]) for r in rows]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = se.queries()["op7_suffix_dedup"](spark, str(tmp_path)).collect()
    assert got[0].__fields__[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = [(*whole, n) for whole, (_, n) in zip(plain.repeats(rows, 400), repeated_words(rows))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    left = {(w[0], w[5]) for w in want if w[2] == 0}
    assert {(1, 55), (2, 55), (3, 0)} <= left  # the removal leaves them, the words tell


@pytest.mark.parametrize("shard", [1, 4000])
def test_words_of_a_crowded_anchor(spark, shard):
    passage = " ".join(f"tok{i}" for i in range(70))
    rows = [(i, f"{'q ' * i} {passage} tail{i} {passage}", "en", "s", 1) for i in range(1, 12)] + [(20, passage[:-1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = repeats.cut_repeats(docs, length=50 * repeats.WORD, unit=repeats.WORD, shard_contexts=shard).collect()
    want = brute(rows)
    assert {(r["doc_id"], r["text"]): bytes(r["kept_bytes"]).decode() for r in got} == want


def test_words_of_a_text_in_several_segments(spark, monkeypatch):
    rng = random.Random(6)
    text = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    passage = text(130)
    buf, off = repeats.coded(np.frombuffer(f"{text(300)} {passage} {text(290)} {passage} {text(7)}".encode(), np.uint8), np.array([0, 1]), repeats.WORD)
    whole = repeats.anchors_of(buf, np.array([0, len(buf)]), 400, 96, repeats.WORD)
    starts = np.concatenate([np.arange(lo, lo + left + right - 400 + 1, 8) for left, right, lo in zip(*whole[3:])])
    assert starts.tolist() == list(range(0, len(buf) - 400 + 1, 8))  # every run of 50 words has one anchor
    found = []
    for at in range(0, len(buf) - 400 + 1, 1600 - 400):
        piece = buf[at:at + 1600 - 8]
        _, _, _, left, right, lo = repeats.anchors_of(piece, np.array([0, len(piece)]), 400, 96, repeats.WORD)
        found += [np.arange(x + at, x + at + a + b - 400 + 1, 8) for a, b, x in zip(left, right, lo)]
    assert np.concatenate(found).tolist() == starts.tolist()
