"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fairspark.llm import chat, decontaminate, licenses, near_duplicates, packing, quality_model, quality_rules, repeats, token_files, urls
from fairspark.llm.shared import stage_path

from . import brute

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PASSAGE = " ".join(f"tok{i}" for i in range(90))
DOCS = [(1, None), (2, ""), (3, "a"), (4, f"one two. {PASSAGE} end"), (4, f"one two. {PASSAGE} end"), (None, f"é {PASSAGE}"),
        (None, None), (7, "w " * 3000), (8, f"{PASSAGE} {PASSAGE}"), (9, "Released under the MIT License.\nx")]
SCHEMA = "doc_id long, text string"


@pytest.fixture(params=["rows", "none"])
def data(request):
    return DOCS if request.param == "rows" else []


@pytest.fixture
def docs(spark, data):
    return spark.createDataFrame(data, SCHEMA).withColumns({"extra": F.lit(1), "score": F.lit("x"), "spans": F.lit("y")})


def out(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_repeats(docs, data):
    for first in (False, True):
        cut = repeats.cut_repeats(docs, keep_first=first)
        got = out(cut, "doc_id", F.size("spans"), F.sha2("kept_bytes", 256))
        want = brute.repeats(data, 400, first)
        assert got == sorted(((d, s, h) for d, _, _, s, h in want), key=repr)


@pytest.mark.parametrize("shard", [1, 4000])
def test_repeats_crowded_anchor(spark, shard):
    data = [(i, f"{'q' * i} {PASSAGE} tail{i}") for i in range(1, 12)]
    for first in (False, True):
        cut = repeats.cut_repeats(spark.createDataFrame(data, SCHEMA), keep_first=first, shard_contexts=shard)
        want = brute.repeats(data, 400, first)
        assert out(cut, "doc_id", F.sha2("kept_bytes", 256)) == sorted(((r[0], r[4]) for r in want), key=repr)


def test_near_duplicates(docs, data):
    got = out(near_duplicates.near_duplicate_groups(docs), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.near_duplicates(data), key=repr)


def test_near_duplicates_in_a_crowded_template(spark):
    """Texts of one template that do not link, and pairs among them that do."""
    shared = " ".join(f"form{i}" for i in range(160))
    data = []
    for i in range(0, 1200, 2):
        own = [f"own{i}x{j}" for j in range(26)]
        data += [(i, f"{shared} {' '.join(own)} {' '.join(f'a{i}y{j}' for j in range(18))}"),
                 (i + 1, f"{shared} {' '.join(own)} {' '.join(f'b{i}y{j}' for j in range(18))}")]
    want = [(d, 200, d - d % 2) for d, _ in data]
    assert sorted(brute.near_duplicates(data[:60])) == want[:60]
    got = near_duplicates.near_duplicate_groups(spark.createDataFrame(data, SCHEMA))
    assert out(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)


def test_near_duplicate_stage_decides_by_row(spark):
    def text(name, end=""):
        return " ".join(f"{name}{i}" for i in range(60)) + end

    data = [(1, text("a")), (None, text("a", " x")), (None, text("b")), (None, text("c")), (None, text("c", " x")),  # null ids
            (2, text("d")), (3, text("d", " x")), (3, text("e")),  # 3 stands on a copy and on a clean text
            (4, text("f")), (4, text("f", " x")), (5, text("g")), (5, text("g")), (6, None), (7, ""), (8, None)]
    docs = spark.createDataFrame(data, SCHEMA).withColumn("lang", F.lit("en"))
    kept = near_duplicates.near_duplicate_stage(spark, docs, "")
    assert kept.columns == ["doc_id", "text", "lang"]
    got = [(d, (t or "").split(" ")[0]) for d, t, _ in kept.collect()]
    assert sorted(got, key=repr) == sorted([(1, "a0"), (None, "b0"), (None, "c0"), (2, "d0"), (3, "e0"), (4, "f0"), (5, "g0"),
                                            (6, ""), (7, ""), (8, "")], key=repr)


def test_contamination(spark, docs, data):
    items = [(1, "two"), (2, None), (3, ""), (4, PASSAGE), (4, "tok3 tok4"), (4, "tok3 tok4"), (None, "tok7"), (None, "a"),
             (5, "zzz yyy"), (6, "end tok5 tok6"), (7, "one two tok0")] if data else []
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(docs, bench)
    want = brute.contamination(data, items)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    split = decontaminate.find_contamination(docs.withColumn("hits", F.lit(1)), bench, max_chars=40)  # a pass for each part
    for got in (found, split):
        assert out(got, "doc_id", "n_words", n_hit, F.size("items"), digest) == sorted((r[:5] for r in want), key=repr)
        assert got.columns == [*docs.columns, "n_words", "hits", "items"]
    assert out(split, "doc_id", "hits", "items") == out(found, "doc_id", "hits", "items")


def test_quality(spark, docs, data):
    labels = spark.createDataFrame([(4, 1), (4, 1), (None, 1), (7, 0)] if data else [], "doc_id long, quality int")
    judged = quality_rules.judge_quality(docs, quality_rules.log_ratios(docs, labels))
    got = out(judged, "doc_id", *quality_rules.STATS)
    assert got == sorted(((d, *brute.base_stats(t)) for d, t in data), key=repr)
    stats = quality_model.document_statistics(docs)
    scored = quality_model.score_documents(stats, quality_model.train(stats, labels)).collect()
    assert len(scored) == len(data) and all(0 <= r["score"] <= 1 for r in scored)


def test_packing_and_token_files(spark, docs, data):
    packed = packing.pack_documents(docs, BYTE).collect()
    tok = packing.tokenizer(BYTE)
    want = sorted(tok.encode([t or ""])[0] + bytes(4) for _, t in data)
    assert sum(len(w) for w in want) == sum(len(r["ids"]) for r in packed)
    seen = {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == seen.get(r["sequence_id"], 0)
        seen[r["sequence_id"]] = r["offset"] + r["length"]
    path = stage_path(spark, "edge")
    token_files.write_token_files(docs, path, WORD, parts=3, shard_tokens=50)
    back = token_files.read_token_files(spark, path).collect()
    lib = token_files.tokenizer(WORD)
    want = sorted((d is not None, d or 0, lib.encode([t or ""])[0] + (1).to_bytes(4, "little")) for d, t in data)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in back) == want
    assert sorted(r["start"] for r in back)[:1] == [0] * bool(data)


def test_wavelet_matrix():
    import numpy as np
    ids = np.random.default_rng(3).integers(0, 40, 200_000)
    w = token_files.WaveletMatrix(token_files.encode_matrix(ids, 6))
    assert (w.decode() == ids).all()
    for i in (0, 65_535, 65_536, 199_999):
        assert w.access(i) == ids[i]
    assert w.rank(7, 150_000, 10) == (ids[10:150_000] == 7).sum()
    places = np.flatnonzero(ids == 39)
    assert [w.select(39, k) for k in (0, 5, len(places) - 1, len(places))] == [places[0], places[5], places[-1], -1]


def test_wavelet_matrix_takes_wide_ids():
    import numpy as np
    ids = np.array([70_000, 3, 1 << 31, 0], "<u4")
    assert (token_files.WaveletMatrix(token_files.encode_matrix(ids)).decode() == ids).all()
    assert token_files.WaveletMatrix(token_files.encode_matrix(ids[:0])).n == 0
    with pytest.raises(ValueError, match="does not fit"):
        token_files.encode_matrix(ids, 16)


def test_token_files_split_a_repeated_row(spark):
    rows = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("one same text").alias("text"))
    path = stage_path(spark, "ties")
    token_files.write_token_files(rows, path, WORD, parts=4)
    files = spark.read.parquet(path)
    assert files.select("part").distinct().count() == 4 and files.agg(F.sum("n_docs")).head()[0] == 3000
    back = token_files.read_token_files(spark, path)
    assert back.select("start").distinct().count() == 3000 and back.select("ids").distinct().count() == 1


def test_licenses(docs, data):
    got = out(licenses.scan_licenses(docs), "doc_id", "license", "confirmed")
    assert got == ([(9, "MIT", True)] if data else [])


def test_licenses_in_one_line_and_over_line_breaks():
    prose = "Some prose about birds and rivers that fills a line with many words of no meaning. " * 4
    mit, cc, gpl = (licenses.TEMPLATES[k] for k in ("MIT", "CC-BY-4.0", "GPL-3.0-notice"))
    words = gpl.split(" ")
    wrapped = "\n".join(" * " + " ".join(words[i:i + 6]) for i in range(0, len(words), 6))
    wrapped = wrapped.replace("License as", "Licence as")  # one word differs
    parts = [prose, mit, prose * 3, mit, mit, prose, cc, prose, "\n", wrapped, "\n", prose]
    scanner = licenses.TemplateScanner()
    text = " ".join(parts)
    got = [r for r in scanner.scan(text) if r[-1]]
    assert [r[2] for r in got] == ["MIT", "MIT", "MIT", "CC-BY-4.0", "GPL-3.0-notice"]
    assert [text[r[0]:r[0] + r[1]] for r in got[:4]] == [mit[:-1]] * 3 + [cc[:-1]]
    assert got[-1][5:7] == (["license"], ["licence"])
    assert [r[-1] for r in scanner.scan(prose + "No license is given. " + prose)] == [False]


def test_licenses_find_every_notice(spark):
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sum(t in line for (x,) in texts.select("text").collect() for line in x.split("\n")
               for k, t in licenses.TEMPLATES.items() if "notice" not in k)
    assert licenses.scan_licenses(texts).filter("confirmed").count() == want > 0


def test_chat(spark):
    rows = [(1, 0, "system", "be <| kind \\"), (1, 1, "user", None), (1, 2, "assistant", "x" * 3000), (1, 2, "assistant", "x" * 3000),
            (1, 3, None, "\\|<\\|n"), (1, 4, "assistant", ""), (2, 0, "system", "only"), (None, None, "assistant", "a\n<|im_end|>\n"),
            (3, 0, "ro\nle\\n", "t")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(9))
    back = chat.read_windows(chat.format_windows(turns, 64, 16)).collect()
    for conv in (1, 2, 3, None):
        want = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda y: (y[0] or 0, y[1], y[2]))
        mine = sorted((b for b in back if b["conv_id"] == conv), key=lambda b: b["window"])
        assert [(x["role"], x["text"]) for b in mine for x in b["turns"]] == [w[1:] for w in want]
        assert "".join(b["loss_text"] for b in mine) == "".join(w[2] for w in want if w[1] == "assistant")
    assert chat.format_windows(turns.limit(0)).count() == 0


def test_urls(spark):
    rules = spark.createDataFrame([("com", "/", "allow"), ("a.com", "/x", "block"), ("a.com", "/x", "allow")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, None), (2, "no"), (3, "http://B.A.com/xy?q"), (4, "h://com"), (3, "http://B.A.com/xy?q")],
                                  "page_id long, url string").withColumn("rule", F.lit("old"))
    a = urls.judge_urls(pages, rules)
    b = urls.judge_urls(pages, rules, max_trie_chars=0)
    cols = ["page_id", "host", "path", "rule", "verdict"]
    assert out(a, *cols) == out(b, *cols)
    assert (3, "b.a.com", "/xy", "a.com/x", "block") in out(a, *cols) and (1, "", "", None, "allow") in out(a, *cols)


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
