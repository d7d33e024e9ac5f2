"""Hard negatives, best-fit packing and centroid clustering against plain Python, with their edge cases."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fairspark.llm import centroids, hard_negatives, swap_packing, vectors
from fairspark.llm.swap_packing import Search, best_fit, best_fit_documents, swap_pack

VECTORS = "vec_id long, embedding array<float>, label int, v string, row int, `Rank` int"


# ---------------------------------------------------------------- best-fit packing

@given(st.lists(st.integers(1, 97), max_size=300), st.sampled_from([97, 100, 200]))
@settings(max_examples=60, deadline=None)
def test_swap_pack_is_a_packing_no_worse_than_best_fit(sizes, capacity):
    lengths = np.array(sizes, np.int64)
    if not len(lengths):
        return
    bins, offsets, fill = swap_pack(lengths, capacity)
    placed = defaultdict(list)
    for b, o, n, f in zip(bins, offsets, lengths, fill):
        placed[int(b)].append((int(o), int(n), int(f)))
    assert sorted(placed) == list(range(len(placed)))
    for pieces in placed.values():
        end = 0
        for o, n, f in sorted(pieces):
            assert o == end
            end += n
        assert end <= capacity and all(f == end for _, _, f in pieces)
    first = best_fit(lengths, capacity)
    assert len(placed) <= len(first)
    assert len(placed) >= -(-sum(sizes) // capacity)


def test_exchanges_empty_a_bin_that_best_fit_leaves():
    # three bins of 10 + 9, 7 + 7 + 5, 4: the tokens fit into two bins of 21 by exchanges only
    lengths = np.array([10, 9, 7, 7, 5, 4])
    start = [[0, 1], [2, 3, 4], [5]]
    search = Search(lengths, start, 21)
    before = (search.fill ** 2).sum()
    search.run()
    assert (search.fill > 0).sum() == 2 and search.fill.max() <= 21
    assert (search.fill ** 2).sum() > before


def test_each_exchange_raises_the_squared_fill():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = rng.integers(20, 60, 40)
        bins = [[i] for i in range(40)]
        search, last = Search(lengths, bins, 100), 0
        for source in np.argsort(search.fill):
            while search.fill[source] and search._exchange(int(source)):
                now = int((search.fill ** 2).sum())
                assert now > last and search.fill.max() <= 100
                last = now
        assert search.fill.sum() == lengths.sum()


@pytest.mark.parametrize("per_shard", [16_384, 7])
def test_pieces_cover_every_document(spark, per_shard):
    texts = [None, "", "word", "a b c " * 5000, *["some words of a text " * n for n in range(1, 40)], *["same text"] * 30]
    rows = [(None if i % 9 == 8 else i // 2, t, 1, 2, 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, sequence_id int, Salt int").repartition(3)
    path = public_tokenizers.path("word_bpe_49k.json")
    got = best_fit_documents(docs, path, capacity=512, pieces_per_shard=per_shard).collect()
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    want = sorted((-1 if r[0] is None else r[0], tuple([*lib.encode(r[1] or "", add_special_tokens=False).ids, 1])) for r in rows)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] and r["piece"] == r["start"] // 512 and r["start"] % 512 == 0
        assert r["length"] == 512 or r["start"] + r["length"] == r["doc_tokens"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[-1 if r["doc_id"] is None else r["doc_id"]].append(tuple(ids))
    assert {k: sum(map(len, v)) for k, v in pieces.items()} == {
        k: sum(len(i) for d, i in want if d == k) for k, _ in want}
    assert sorted(x for k in pieces for p in pieces[k] for x in p) == sorted(x for _, i in want for x in i)
    for seq in sequences.values():
        end = 0
        for o, n in sorted(seq):
            assert o == end
            end += n
        assert end <= 512
    total = sum(len(i) for _, i in want)
    assert len(sequences) <= -(-total // 512) + 2


def test_no_documents_no_pieces(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert best_fit_documents(docs, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_packing_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    got = swap_packing.op12_best_fit_packing(spark, sf).collect()
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = np.array([*lib.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        for p in range(0, len(ids), 4096):
            want[r["doc_id"], p // 4096, p, len(ids[p:p + 4096])] = zlib.crc32(ids[p:p + 4096].tobytes())
    assert {(r["doc_id"], r["piece"], r["start"], r["length"]): r["ids_crc32"] for r in got} == want
    tokens = sum(k[3] for k in want)
    assert len({r["sequence_id"] for r in got}) == -(-tokens // 4096)


# ---------------------------------------------------------------- vectors

def some_vectors(n, dim, seed, groups=5, ties=True):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    x = (centres[rng.integers(0, groups, n)] + 0.4 * rng.normal(size=(n, dim))) / 4
    if ties:
        x = np.round(x * 8) / 8
        x[: n // 3] = x[0]  # a third of all rows is one vector
    return [(int(i), [float(v) for v in row], int(rng.integers(0, 3)), "x", 1, 2) for i, row in enumerate(x)]


BAD = [(7000, None, 1, "x", 1, 2), (7050, [1.0, None] * 4, 1, "x", 1, 2), (7100, [math.nan] * 8, 1, "x", 1, 2),
       (7150, [math.inf] * 8, 1, "x", 1, 2), (7200, [0.5] * 8, None, "x", 1, 2)]


def whole(x):
    return [math.floor(256 * float(np.float32(v))) for v in x]


def brute_negatives(rows, every=50, width=8):
    ok = [(i, whole(x) + [0] * (width - len(x)), lab) for i, x, lab, *_ in rows
          if x is not None and lab is not None and all(v is not None and math.isfinite(v) for v in x)]
    out = []
    first = lambda i: (i is not None, i or 0)
    for at, (a, x, lab) in enumerate(ok):
        if a is None or a % every:
            continue
        score = [(sum(p * q for p, q in zip(x, y)), i, lab2) for j, (i, y, lab2) in enumerate(ok) if j != at]
        score.sort(key=lambda s: (-s[0], first(s[1])))
        for ps, p, _ in [s for s in score if s[2] == lab][:5]:
            hard = [s for s in score if s[2] != lab and 50 * ps <= 100 * s[0] <= 95 * ps][:3]
            out += [(a, p, rank, n, ps, ns) for rank, (ns, n, _) in enumerate(hard, 1)]
    return sorted(out, key=str)


def spark_negatives(spark, rows, parts=3):
    df = spark.createDataFrame(rows, VECTORS).repartition(parts)
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[c] for c in cols) for r in hard_negatives.hard_negatives(df, "vec_id % 50 = 0").collect()), key=str)


@pytest.mark.parametrize("seed,ties", [(1, False), (2, True)])
def test_negatives_equal_brute_force(spark, seed, ties, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SAMPLE", 60)  # bounds from few rows: the walk has to do the work
    monkeypatch.setattr(hard_negatives, "BLOCK", 200)
    rows = some_vectors(700, 8, seed, ties=ties) + BAD
    rows += [(None, rows[5][1], 0, "x", 1, 2), (50, rows[9][1], 1, "x", 1, 2), (50, rows[9][1], 1, "x", 1, 2), (100, [0.0] * 8, 2, "x", 1, 2),
             (150, [0.5, 0.25], 1, "x", 1, 2), (200, [], 1, "x", 1, 2)]
    assert spark_negatives(spark, rows) == brute_negatives(rows)


def test_negatives_in_chunks_of_anchors(spark, monkeypatch):
    rows = some_vectors(400, 8, 4)
    monkeypatch.setattr(hard_negatives, "CHUNK_ANCHORS", 3)
    assert spark_negatives(spark, rows) == brute_negatives(rows)


def test_no_negatives_without_rows_or_anchors(spark):
    assert spark_negatives(spark, []) == []
    assert spark_negatives(spark, [(1, [1.0] * 8, 1, "x", 1, 2)]) == []
    assert spark_negatives(spark, [(50, [1.0] * 8, 1, "x", 1, 2)]) == []


def test_the_walk_ends_before_the_list_does():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 64))
    v = (200 * (centres[rng.integers(0, 20, 4000)] + 0.05 * rng.normal(size=(4000, 64)))).astype(np.int32)
    block = {"v": v, "label": np.zeros(4000, np.int64), "vec_id": np.arange(4000), "row": np.arange(4000)}
    directions = hard_negatives.fit_directions(v[:400])
    u, norm = hard_negatives.unit(v[:100])
    cosine = u @ directions.T
    cluster = cosine.argmax(axis=1)
    widest = np.zeros(len(directions))
    np.maximum.at(widest, cluster, np.arccos(cosine[np.arange(100), cluster]))
    anchors = {"v": v[:100], "row": np.arange(100), "label": np.zeros(100, np.int64), "norm": norm, "cluster": cluster,
               "widest": widest, "directions": directions, "least": np.full((100, 1), -np.inf), "most": np.full((100, 1), np.inf)}
    found, computed = hard_negatives.walk(block, anchors, True, 5)
    assert computed < 0.5 * 100 * 4000
    scores = v[:100].astype(np.int64) @ v.T.astype(np.int64)
    np.put_along_axis(scores, np.arange(100)[:, None], -1 << 60, axis=1)
    assert (np.sort(found.score.reshape(100, 5))[:, ::-1] == np.sort(scores)[:, :-6:-1]).all()


def test_large_products_are_exact():
    a = np.array([[vectors.LIMIT - 1] * 300, [1 - vectors.LIMIT] * 300])
    assert hard_negatives.products(a, a).tolist() == [[300 * (vectors.LIMIT - 1) ** 2, -300 * (vectors.LIMIT - 1) ** 2],
                                                      [-300 * (vectors.LIMIT - 1) ** 2, 300 * (vectors.LIMIT - 1) ** 2]]


# ---------------------------------------------------------------- centroid clustering

def brute_clusters(rows, k, rounds, dim):
    ok = [(i, whole(x)) for i, x, *_ in rows
          if x is not None and len(x) == dim and all(v is not None and math.isfinite(v) for v in x)]
    start = sorted(ok, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(),
                                      np.array(r[1], "<i4").tobytes().hex()))[:k]
    cs = [c for _, c in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in ok:
            groups[near(v)[1]].append(v)
        cs = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else c for j, c in enumerate(cs)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in ok), key=str), cs


@pytest.mark.parametrize("n,seed,ties", [(300, 1, True), (300, 2, False), (4, 3, False)])
def test_clusters_equal_brute_force(spark, n, seed, ties):
    rows = some_vectors(n, 8, seed, ties=ties) + BAD[:4] + [(3, [0.125] * 8, 1, "x", 1, 2), (3, [0.25] * 8, 1, "x", 1, 2), (None, [0.5] * 8, 1, "x", 1, 2),
                                                            (9001, [0.5] * 7, 1, "x", 1, 2), (9002, [], 1, "x", 1, 2)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got, cs = centroids.centroid_clusters(df, k=12, rounds=3, dim=8)
    want, want_cs = brute_clusters(rows, 12, 3, 8)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got.collect()), key=str) == want
    assert cs.tolist() == want_cs


def test_no_vectors_no_clusters(spark):
    got, cs = centroids.centroid_clusters(spark.createDataFrame([], VECTORS))
    assert got.count() == 0 and len(cs) == 0


def test_the_filter_spares_most_distances():
    rng = np.random.default_rng(0)
    scale = np.r_[np.full(6, 60.0), np.full(58, 4.0)]
    v = (rng.normal(size=(2000, 64)) * scale).astype(np.int64)
    c = v[:40].copy()
    rotation = centroids.Rotation(v)
    best, d, computed = centroids.nearest_centroid(v, *rotation(v), c, *rotation(c))
    full = ((v[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    assert (best == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
    assert computed < 0.25 * full.size
    assert (centroids.lower_bounds(*rotation(v), *rotation(c)) <= full).all()


def test_components_beyond_the_limit_are_an_error(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="is not below"):
        vectors.whole_vectors(df, "embedding", {"vec_id": F.col("vec_id")}).collect()
