"""Token files: one wavelet matrix per shard, as a compressed, queryable sequence of ids.

The documents are sorted by id over range partitions, encoded, and cut into shards at document
ends.  A shard's ids are stored as one bit plane per bit, most significant first; after each plane
the ids with a 0 come before those with a 1 (the wavelet matrix order).  Planes are cut into blocks
of 65,536 bits, compressed one by one with the number of ones before each, so access, counting and
the place of the k-th occurrence read a few blocks per plane and never the whole file.  A shard is
one Parquet file of one row, so that any store Spark reads can hold it.

Defined results: null text is empty and stored as the end id alone; null ids come first; equal ids
keep a fixed order by text hash, and rows equal in both may lie in several partitions, side by side; an
empty table gives no shard.  A shard has as many planes as its largest id needs, so no id is cut.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import stage_path, table
from .textvec import chunks
from .tokens import tokenizer

#: Entries of the token caches here: nothing else of size is held beside them.
TOKEN_UNITS, TOKEN_PIECES = 1_000_000, 200_000
#: Bytes of text for a range partition, where that gives more of them than the session's number.
PART_BYTES = 128 << 20
#: Rows equal in id and text are dealt to this many places of the range order.
TIES = 1 << 20
#: Tokens of a shard (it ends at the next document end) and bits of a block of a plane.
SHARD_TOKENS = 1 << 21
BLOCK_BITS = 1 << 16


def encode_matrix(ids: np.ndarray, bits: int | None = None, level: int = 1) -> bytes:
    """The file: header ``(n, bits)``, then per plane zeros, ones before each block, block sizes, blocks.

    Without ``bits`` there are as many as the largest id needs; an id that does not fit is an error.
    """
    need = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    bits = bits or need
    if need > bits:
        raise ValueError(f"an id of {need} bits does not fit a matrix of {bits}")
    press = zstandard.ZstdCompressor(level=level, write_content_size=True)
    out = [np.array([len(ids), bits], "<i8").tobytes()]
    cur = ids.astype(np.uint32 if bits > 16 else np.uint16)
    for k in range(bits - 1, -1, -1):
        one = (cur & cur.dtype.type(1 << k)) != 0
        bits_of = np.packbits(one, bitorder="little")
        packed, step = memoryview(bits_of), BLOCK_BITS // 8
        blocks = [press.compress(packed[i:i + step]) for i in range(0, len(packed), step)]
        ones = [int(np.bitwise_count(bits_of[i:i + step]).sum()) for i in range(0, len(bits_of), step)]
        before = np.concatenate([[0], np.cumsum(ones)]).astype("<i8")
        sizes = np.array([len(x) for x in blocks], "<i8")
        out += [before.tobytes(), sizes.tobytes(), *blocks]
        cur = np.concatenate([cur.take(np.flatnonzero(~one)), cur.take(np.flatnonzero(one))])  # masks take five times as long
    return b"".join(out)


class WaveletMatrix:
    """Reads the bytes of ``encode_matrix``: ``access``, ``rank`` (count), ``select`` (occurrence)."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        self.n, self.bits = (int(x) for x in np.frombuffer(data, "<i8", 2))
        blocks = -(-self.n // BLOCK_BITS)
        at, self.planes = 16, []
        for _ in range(self.bits):
            before = np.frombuffer(data, "<i8", blocks + 1, at)
            sizes = np.frombuffer(data, "<i8", blocks, at + 8 * (blocks + 1))
            at += 8 * (2 * blocks + 1)
            starts = at + np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            self.planes.append((before, starts))
            at = int(starts[-1])
        self._block = functools.lru_cache(maxsize=64)(self._read)

    def _read(self, plane: int, block: int) -> np.ndarray:
        _, starts = self.planes[plane]
        raw = zstandard.ZstdDecompressor().decompress(self.data[starts[block]:starts[block + 1]])
        return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")

    def _ones(self, plane: int, i: int) -> int:
        """Ones before place i."""
        block, rest = divmod(i, BLOCK_BITS)
        return int(self.planes[plane][0][block]) + (int(self._block(plane, block)[:rest].sum()) if rest else 0)

    def _zeros(self, plane: int) -> int:
        return self.n - int(self.planes[plane][0][-1])

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for k in range(self.bits):
            block, rest = divmod(i, BLOCK_BITS)
            bit, ones = int(self._block(k, block)[rest]), self._ones(k, i)
            i = self._zeros(k) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def rank(self, value: int, end: int, start: int = 0) -> int:
        """How often the id occurs in [start, end)."""
        if value >> self.bits:
            return 0
        for k in range(self.bits):
            a, b = self._ones(k, start), self._ones(k, end)
            if value >> (self.bits - 1 - k) & 1:
                start, end = self._zeros(k) + a, self._zeros(k) + b
            else:
                start, end = start - a, end - b
        return end - start

    def select(self, value: int, nth: int) -> int:
        """The place of the nth (from 0) occurrence; -1 if there are fewer."""
        if not 0 <= nth < self.rank(value, self.n):
            return -1
        start = 0
        for k in range(self.bits):
            a = self._ones(k, start)
            start = self._zeros(k) + a if value >> (self.bits - 1 - k) & 1 else start - a
        i = start + nth
        for k in range(self.bits - 1, -1, -1):
            one = value >> (self.bits - 1 - k) & 1
            i = self._find(k, one, i - self._zeros(k) if one else i)
        return i

    def _find(self, plane: int, bit: int, nth: int) -> int:
        """The place of the nth one (or zero) of a plane."""
        before = self.planes[plane][0]
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK_BITS, self.n) - before
        block = int(np.searchsorted(before, nth, side="right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self._block(plane, block) == bit)[nth - int(before[block])])

    def decode(self) -> np.ndarray:
        """All ids in order."""
        blocks = -(-self.n // BLOCK_BITS)
        cur = np.zeros(self.n, np.uint32 if self.bits > 16 else np.uint16)
        for k in range(self.bits - 1, -1, -1):
            one = np.concatenate([self._read(k, j) for j in range(blocks)])[:self.n].view(bool) if blocks else np.empty(0, bool)
            prev, zeros = np.empty_like(cur), self._zeros(k)
            prev[np.flatnonzero(~one)] = cur[:zeros]
            prev[np.flatnonzero(one)] = cur[zeros:] | cur.dtype.type(1 << (self.bits - 1 - k))
            cur = prev
        return cur


SHARDS = "part int, shard int, n_tokens long, n_docs long, doc_ids binary, null_ids binary, lengths binary, matrix binary"


def write_token_files(docs: DataFrame, out: str, path: str, end_id: int = 1, bits: int | None = None,
                      shard_tokens: int = SHARD_TOKENS, parts: int | None = None) -> None:
    """Encode the texts in ascending doc_id order and write one file per shard under ``out``."""
    spark = docs.sparkSession
    text_bytes = 0 if parts else docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes // PART_BYTES))
    text = F.coalesce("text", F.lit(""))
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
               .withColumn("_h", F.xxhash64("text"))
               .withColumn("_tie", F.pmod(F.monotonically_increasing_id(), F.lit(TIES)))
               .repartitionByRange(n, F.asc_nulls_first("doc_id"), "_h", "_tie")
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), "_h", "_tie")
               .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    end = np.array([end_id], "<u4").tobytes()

    def pack(part: int, shard: int, ids: list[int | None], parts: list[bytes]) -> pa.RecordBatch:
        matrix = encode_matrix(np.frombuffer(b"".join(parts), "<u4"), bits)
        sizes = np.array([len(p) // 4 for p in parts], "<i8")
        row = [part, shard, int(sizes.sum()), len(ids), np.array([x or 0 for x in ids], "<i8").tobytes(),
               np.packbits([x is None for x in ids]).tobytes(), sizes.tobytes(), matrix]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                          names=[x.split()[0] for x in SHARDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, TOKEN_UNITS, TOKEN_PIECES)
        ids: list[int | None] = []
        parts: list[bytes] = []
        size = shard = part = 0
        for b in (x for batch in batches for x in chunks(batch, "text", 1 << 20, clear=False)):
            part = b.column(0)[0].as_py()
            for doc, got in zip(b.column(1).to_pylist(), tok.encode(b.column(2).to_pylist())):
                ids.append(doc)
                parts.append(got + end)
                size += len(got) // 4 + 1
                if size >= shard_tokens:
                    yield pack(part, shard, ids, parts)
                    ids, parts, size, shard = [], [], 0, shard + 1
        if ids:
            yield pack(part, shard, ids, parts)

    ordered.mapInArrow(run, SHARDS).write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(out)


def shard_starts(files: DataFrame) -> DataFrame:
    """``(part, shard, first)``: ids before each shard.  The driver sees one sum per partition."""
    sums = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, rows = 0, []
    for part, n in sums:
        rows.append((part, before))
        before += n
    base = files.sparkSession.createDataFrame(rows, "part int, _base long")
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (files.select("part", "shard", "n_tokens")
            .withColumn("_in", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
            .join(base, "part").select("part", "shard", (F.col("_base") + F.col("_in")).alias("first")))


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids binary)`` per document, decoded from the files."""
    return _read(spark, out, False)


def _read(spark: SparkSession, out: str, digest: bool) -> DataFrame:
    files = spark.read.schema(SHARDS).parquet(out)
    shards = files.drop("n_tokens").join(F.broadcast(shard_starts(files)), ["part", "shard"]) \
        if _few(files) else files.drop("n_tokens").join(shard_starts(files), ["part", "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                row = {k: b.column(i)[r].as_py() for i, k in enumerate(b.schema.names)}
                ids = WaveletMatrix(row["matrix"]).decode().astype("<u4")
                sizes = np.frombuffer(row["lengths"], "<i8")
                ends = np.cumsum(sizes)
                null = np.unpackbits(np.frombuffer(row["null_ids"], np.uint8))[:row["n_docs"]].astype(bool)
                parts = [ids[e - s:e].tobytes() for s, e in zip(sizes.tolist(), ends.tolist())]
                last = pa.array([zlib.crc32(p) for p in parts], pa.int64()) if digest else pa.array(parts, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=null), pa.array(row["first"] + ends - sizes),
                     pa.array(sizes), last], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return shards.mapInArrow(run, f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digest else 'ids binary'}")


#: Shards whose starts (24 bytes each) may be broadcast; beyond it they are joined by a shuffle.
FEW_SHARDS = 100_000


def _few(files: DataFrame) -> bool:
    return files.select("part").count() <= FEW_SHARDS


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = stage_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"))
    return _read(spark, out, True)
