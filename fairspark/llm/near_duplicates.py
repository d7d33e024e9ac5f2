"""Near-duplicate documents with an LSH forest over MinHash signatures.

A text's set is its distinct five-word shingles.  Texts with the same set are one class from the
start.  Every class stands in ``TREES`` sorted orders of its signature (each order begins with three
coordinates of its own); its candidates are the neighbours that share the longest prefixes there, at
least ``MIN_DEPTH`` values.  Sorting makes the depth adaptive: in a sparse region neighbours are those
with a short common prefix, in a crowded one only those with a long one.  In a crowded region every
member also meets the region's centres, the members that agree most with the majority of each
coordinate, so copies of one original that differ much from each other still meet it.

Candidates are confirmed on the full sets in three rounds.  The first takes the nearest neighbour on each
side and one centre of each region, of these the strongest neighbour and the strongest centre of each
class, and finds components.  The second reads the orders of all classes that have any neighbour
again, now with the roots of these components, and takes only candidates whose roots differ; so
copies that one component already holds never meet again.  A region (the classes of one tree that agree
in its own coordinates) lies in one task, so in regions of up to ``NEIGHBOURS + 1`` classes every two
meet.  In larger ones neighbours and centres are only a quick way to most links: the third round takes
all classes of such regions and every pair of them with different roots that can reach the threshold,
by an exact join on prefixes of their sets, rarest shingles first.  So every link is found whose ends
meet in any region; two sets at the threshold itself meet in none with probability (1 - 0.75^3)^20 =
2e-5, more alike ones less.

Defined results: null and texts without words have an empty set, link with nothing and are their own
component; a null id is never the smallest, and its component is null if no id is known; repeated
rows have equal sets and one component; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import carried, key_sketch, maybe_in, restored, stage, table
from .textvec import U, Words, chunks, flat, give_back, mix, shingle_set, stream

SHINGLE = 5
#: Links have 100 * |A and B| >= PERCENT * |A or B|.
PERCENT = 75
HASHES, TREES, DEPTH, MIN_DEPTH = 64, 20, 16, 3
#: Neighbours on each side in the orders of small regions; a longer region has one, and a centre.
NEIGHBOURS = 6
#: Counters of the order "rarest first" (a power of 2): shingles that share one only cost candidates.
COUNTERS = 1 << 19

_SALT, _ODD = stream(HASHES, 21), stream(HASHES, 22) | U(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima, 16 bits of each."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, dtype=U)
    for i in range(0, len(shingles), 4096):
        low = np.minimum(low, ((shingles[i:i + 4096, None] ^ _SALT) * _ODD).min(axis=0))
    return (mix(low) >> U(48)).astype(">u2")


def orders() -> np.ndarray:
    """Coordinates of each tree: three of its own, then others in a fixed pseudo-random order."""
    first = np.argsort(stream(HASHES, 23))
    out = []
    for t in range(TREES):
        own = first[MIN_DEPTH * t:MIN_DEPTH * (t + 1)]
        rest = np.argsort(stream(HASHES, 100 + t))
        out.append(np.concatenate([own, rest[~np.isin(rest, own)][:DEPTH - MIN_DEPTH]]))
    return np.array(out)


def _sets(part: pa.RecordBatch, column: str) -> Iterator[np.ndarray]:
    words = Words(*flat(part.column(part.schema.get_field_index(column))), lower=True)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        yield shingle_set(words.hash[a:b], SHINGLE)


def signatures(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, n_shingles, node, signature)``; ``node`` is an order-free 64-bit digest of
    the set (0 for the empty set): two sets among n meet with probability about n^2 / 2^65."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                n, a, s = [], [], []
                for x in _sets(part, "text"):
                    n.append(len(x))
                    a.append(int(mix(x).sum(dtype=U).astype(np.int64)))
                    s.append(signature(x).tobytes() if len(x) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(a, pa.int64()),
                     pa.array(s, pa.binary())], names=["doc_id", "text_key", "n_shingles", "node", "signature"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return keyed.mapInArrow(run, "doc_id long, text_key long, n_shingles long, node long, signature binary")


def forest_rows(classes: DataFrame) -> DataFrame:
    """``(key, node, n)``, and ``root`` where ``classes`` has it: a row per class and tree; the key is
    the tree and its ordered values."""
    order = orders()
    names = ["node", "n_shingles", "signature"] + ["root"] * ("root" in classes.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(2).to_pylist()), ">u2").reshape(b.num_rows, HASHES)
            for t in range(TREES):
                rows = np.ascontiguousarray(sig[:, order[t]]).view(np.uint8).reshape(b.num_rows, 2 * DEPTH)
                keys = np.concatenate([np.full((b.num_rows, 1), t, np.uint8), rows], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.tobytes() for k in keys], pa.binary()), b.column(0), b.column(1), *b.columns[3:]],
                    names=["key", "node", "n", *names[3:]])

    return classes.select(*names).mapInArrow(run, "key binary, node long, n long" + ", root long" * len(names[3:]))


def neighbours(rows: DataFrame, width: int, centres: int) -> DataFrame:
    """In each order the next one, in regions of up to ``NEIGHBOURS + 1`` the next ``width``, and the
    region's centres: ``(a, b, fits, weight, central)``: candidate pairs, a < b, whether their sizes allow a link, the
    number of prefix values they share in all orders, and that with one as the other's centre.  Where
    ``rows`` has ``root``, only pairs of two roots."""
    # by region, not by range: no two neighbours stand on two sides of a partition's edge
    ordered = rows.repartition(F.substring("key", 1, 2 * MIN_DEPTH + 1)).sortWithinPartitions("key", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: tuple | None = None
        for b in batches:
            if not b.num_rows:
                continue
            key = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(b.num_rows, 2 * DEPTH + 1)
            node, n, root = (b.column(i).to_numpy() for i in (1, 2, -1 if b.num_columns > 3 else 1))
            old = 0
            if tail is not None:
                key, node, n, root = (np.concatenate([x, y]) for x, y in zip(tail, (key, node, n, root)))
                old = len(tail[1])
            values = np.ascontiguousarray(key[:, 1:]).view(">u2").astype(np.uint16)
            same = np.concatenate([(key[1:, :1] == key[:-1, :1]), values[1:] == values[:-1]], axis=1)
            lcp = np.where(same.all(axis=1), DEPTH, same.argmin(axis=1) - 1)  # -1: another tree
            out = []
            common = np.full(len(node), DEPTH)
            edges = np.concatenate([[0], np.flatnonzero(lcp < MIN_DEPTH) + 1, [len(node)]])
            small = np.repeat(np.diff(edges) <= NEIGHBOURS + 1, np.diff(edges))
            for w in range(1, width + 1):
                common = np.minimum(common[:len(node) - w], lcp[w - 1:])
                i = np.flatnonzero((common >= MIN_DEPTH) & (small[:len(node) - w] | (w == 1)))
                i = i[i + w >= old]  # pairs within the rows carried over are out already
                out.append((i, i + w, common[i], np.zeros(len(i), np.int64)))
            out += _centres(values, lcp, node, centres)
            i, j, weight, central = (np.concatenate(x) for x in zip(*out))
            apart = (node[i] != node[j]) & (root[i] != root[j])
            i, j, weight, central = i[apart], j[apart], weight[apart], central[apart]
            # sets whose sizes differ more than the threshold allows cannot link
            fits = 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j])), pa.array(fits),
                 pa.array(weight.astype(np.int64)), pa.array(central)], names=["a", "b", "fits", "weight", "central"])
            keep = slice(-width, None)
            tail = key[keep].copy(), node[keep].copy(), n[keep].copy(), root[keep].copy()
            give_back()

    pairs = ordered.mapInArrow(run, "a long, b long, fits boolean, weight long, central long")
    return pairs.groupBy("a", "b", "fits").agg(F.sum("weight").alias("weight"), F.sum("central").alias("central"))


def _centres(values: np.ndarray, lcp: np.ndarray, node: np.ndarray, centres: int) -> list[tuple]:
    """Row pairs of each member of a crowded region with the region's centres; among members that agree
    alike, the smallest nodes, so that all orders tend to the same centres."""
    out = []
    cut = np.flatnonzero(lcp < MIN_DEPTH) + 1
    edges = np.concatenate([[0], cut, [len(values)]])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a <= NEIGHBOURS:
            continue
        part = values[a:b]
        agree = np.zeros(b - a, np.int64)
        for j in range(MIN_DEPTH, DEPTH):
            v, inverse, count = np.unique(part[:, j], return_inverse=True, return_counts=True)
            agree += inverse == count.argmax()
        for c in a + np.lexsort((node[a:b], -agree))[:centres]:
            out.append((np.full(b - a, c), np.arange(a, b), np.full(b - a, MIN_DEPTH), np.full(b - a, MIN_DEPTH)))
    return out


def crowded(classes: DataFrame) -> DataFrame:
    """``(node)`` of all classes in a region of more than ``NEIGHBOURS + 1``, perhaps with some others."""
    own = orders()[:, :MIN_DEPTH]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), ">u2").reshape(b.num_rows, HASHES)
            for t in range(TREES):
                region = np.full(b.num_rows, t, np.int64)
                for j in own[t]:
                    region = region << 16 | sig[:, j].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(region), b.column(0)], names=["region", "node"])
            give_back()

    rows = classes.select("node", "signature").mapInArrow(run, "region long, node long")
    large = rows.groupBy("region").count().filter(F.col("count") > NEIGHBOURS + 1)
    return maybe_in(rows, "region", key_sketch(large, "region")).select("node").distinct()


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles) & U(COUNTERS - 1)).astype(np.int64)


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How often each of ``COUNTERS`` counters of shingles stands in ``sets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for x in b.column(0):
                np.add.at(total, _counter(np.frombuffer(x.as_buffer(), U)), 1)
            give_back()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["counter", "count"])

    found = (sets.select("shingles").mapInArrow(run, "counter int, count long")
             .groupBy("counter").agg(F.sum("count").alias("count")).toArrow())
    counts = np.zeros(COUNTERS, np.int64)
    counts[found.column("counter").to_numpy()] = found.column("count").to_numpy()
    return counts


def prefix_candidates(sets: DataFrame) -> DataFrame:
    """``(a, b)``, a < b: of ``sets (node, root, shingles)`` every pair of two roots that can link.

    Sets that link have at least 75 % of the larger one in common, and 6/7 of the smaller one.  So with
    the shingles in any one order, the first 1/4 of the larger and the first 1/7 of the smaller (and one
    more each) have a shingle in common, and from the first such on enough of both sets is left for
    all that they must share.  The rarest come first: a passage that many sets share stands last and
    makes no candidates of sets that are otherwise different."""
    counts = sets.sparkSession.sparkContext.broadcast(shingle_counts(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                b = batch.slice(i, 256)
                rows, sizes, first, second = [], [], [], []
                for x in b.column(2):
                    x = np.frombuffer(x.as_buffer(), U)
                    n = len(x)
                    longer = n - -(-PERCENT * n // 100) + 1
                    shorter = n - -(-2 * PERCENT * n // (100 + PERCENT)) + 1
                    rows.append(x[np.lexsort((x, counts.value[_counter(x)]))[:longer]])
                    sizes.append(n)
                    first.append(longer)
                    second.append(np.arange(longer) < shorter)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(rows).astype(np.int64)), pa.array(np.repeat(b.column(0).to_numpy(), first)),
                     pa.array(np.repeat(b.column(1).to_numpy(), first)), pa.array(np.repeat(np.array(sizes, np.int64), first)),
                     pa.array(np.concatenate([n - np.arange(k) for n, k in zip(sizes, first)])),
                     pa.array(np.concatenate(second))], names=["shingle", "node", "root", "n", "rest", "short"])
                give_back()

    rows = stage(sets.select("node", "root", "shingles").mapInArrow(
        run, "shingle long, node long, root long, n long, rest long, short boolean"), "prefixes")
    # few shingles still stand in sets of two roots
    mixed = stage(rows.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                  .filter("low <> high").select("shingle"), "mixed")
    rows = stage(maybe_in(rows, "shingle", key_sketch(mixed, "shingle")).join(mixed, "shingle", "left_semi"), "postings")
    # roots meet before their sets do, so the sets of one root are never paired with each other
    short = rows.filter("short").select("shingle", F.col("root").alias("other"), F.col("node").alias("b"), F.col("n").alias("m"),
                                        F.col("rest").alias("rest_b"))
    meet = (rows.select("shingle", "root").distinct().join(short.select("shingle", "other").distinct(), "shingle")
            .filter("root <> other"))
    pairs = rows.join(meet, ["shingle", "root"]).join(short, ["shingle", "other"])
    pairs = pairs.filter(f"(m < n or m = n and b < node) and 100 * m >= {PERCENT} * n "
                         f"and {100 + PERCENT} * least(rest, rest_b) >= {PERCENT} * (n + m)")
    return pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(node, shingles binary)`` of the wanted classes ``(node, text_key)``, from their texts."""
    keyed = docs.select(F.xxhash64("text").alias("text_key"), "text")
    some = maybe_in(keyed, "text_key", key_sketch(wanted, "text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task sends each of its sets once
        for batch in batches:
            for part in chunks(batch, "text"):
                nodes, sets = [], []
                for x in _sets(part, "text"):
                    node = int(mix(x).sum(dtype=U).astype(np.int64))
                    if len(x) and node not in seen:
                        seen.add(node)
                        nodes.append(node)
                        sets.append(x.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return (some.mapInArrow(run, "node long, shingles binary")
            .join(wanted.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                p, q = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                ok.append(100 * both >= PERCENT * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
            give_back()

    joined = (pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"))
    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _grouped(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, n_shingles, root, component_id)``, one row per row of ``docs``; ``root`` is
    the component's smallest class, null for the empty set."""
    docs = docs.select("doc_id", "text")
    signed = stage(signatures(docs), "signatures")
    classes = stage(signed.filter("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"), F.min("n_shingles").alias("n_shingles"),
        F.any_value("signature").alias("signature")), "classes")
    near = stage(neighbours(forest_rows(classes), 1, 1), "candidates")
    # a class with any neighbour has one next to it, so these are all that can have links
    ends = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    social = stage(classes.join(ends, "node", "left_semi"), "social")
    # first the strongest neighbour and centre of each class, which settle most components
    best = (near.filter("fits").select("a", "b", "weight", "central", F.explode(F.array("a", "b")).alias("of"))
            .groupBy("of").agg(F.max(F.struct("weight", "a", "b")).alias("p"),
                               F.max(F.struct("central", "weight", "a", "b")).alias("q")))
    strongest = best.select("p.a", "p.b").unionByName(best.select("q.a", "q.b")).distinct()
    sets = stage(full_sets(docs, social.select("node", "text_key")), "sets")
    links = stage(confirmed(strongest, sets), "links")
    # then every candidate whose ends are still apart
    rooted = social.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = neighbours(forest_rows(rooted), NEIGHBOURS, 1).filter("fits").join(strongest, ["a", "b"], "left_anti")
    links = links.unionByName(stage(confirmed(apart, sets), "links"))
    # last, every pair of crowded regions that is apart even now and may link
    dense = stage(crowded(social), "crowded")
    rooted = dense.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    dense_sets = stage(maybe_in(sets, "node", key_sketch(dense, "node")).join(rooted, "node"), "dense-sets")
    links = links.unionByName(stage(confirmed(prefix_candidates(dense_sets), sets), "links"))
    roots = components(links)
    grouped = classes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = grouped.join(smallest, "root").select("node", "root", "component_id")
    full = signed.select("doc_id", "text_key", "n_shingles", "node").join(of_node, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return full.select("doc_id", "text_key", "n_shingles", "root", component.alias("component_id"))


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs`` (doc_id, text)."""
    return _grouped(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: of those with the smallest id (null only if no id is known) the one
    with the smallest hash of its text.  Rows without words stay; of rows equal in id and text one does."""
    def row(doc_id: Column, text_key: Column) -> list[Column]:
        # decided by id and text, spared by the hash of both; a null id is a value of its own
        return [F.coalesce(doc_id, F.lit(0)).alias("_id"), doc_id.isNull().alias("_unknown"), text_key.alias("_key"),
                F.xxhash64(doc_id, text_key).alias("_row")]

    who = ["_row", "_id", "_unknown", "_key"]
    groups = stage(_grouped(docs).select("root", *row(F.col("doc_id").cast("long"), F.col("text_key"))), "groups")
    first = (groups.filter("root is not null").groupBy("root").agg(F.min(F.struct("_unknown", "_id", "_key", "_row")).alias("f"))
             .select("f.*"))
    gone = stage(groups.filter("root is not null").select(*who).distinct().join(first, who, "left_anti"), "gone")
    again = groups.groupBy(*who).count().filter("count > 1").select(*who)
    sketch = stage(key_sketch(gone.unionByName(again), "_row"), "sketch")
    keyed = carried(docs)
    keyed = keyed.select("*", *row(F.col("doc_id").cast("long"), F.xxhash64("text")))
    perhaps = maybe_in(keyed, "_row", sketch).join(gone, who, "left_anti").dropDuplicates([*who, "text"])
    return restored(maybe_in(keyed, "_row", sketch, negate=True).unionByName(perhaps), docs.columns)
