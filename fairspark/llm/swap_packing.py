"""Best-fit packing with swap-based local search.

Documents' token ids (with an end id) are cut only where they are longer than a sequence.  Pieces
are dealt evenly to shards.  A shard is packed best fit, longest first.  While it has more bins than
its tokens need, the emptiest bin is emptied into the other underfull ones: a document moves, changes
places with a shorter one, or two of its documents change places with one, always the exchange that
carries over most tokens.  Every exchange leaves an emptier bin emptier and a fuller one fuller, so
the sum of squared fills grows with each and the search ends.  A bin that nothing can leave waits
until another exchange has made room.

The emptiest bin of every shard is packed again with those of other shards, level by level, until
one shard holds them.

Defined results: null text is empty and gives the end id alone; equal rows are separate documents
and null ids stay; a document of any length is kept whole in its pieces; an empty table gives no
pieces; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .packing import cut_documents
from .shared import stage, table

CAPACITY = 4096
#: Pieces of a shard, on average; fewer shards where one would have no tokens for so many bins (then it
#: has at most ``LEAST_BINS`` times ``CAPACITY`` pieces, of a token each), so every level leaves less.
PIECES_PER_SHARD, LEAST_BINS = 16_384, 16
#: Places of a sequence number: level, shard, bin.
LEVEL_BITS, SHARD_BITS = 58, 22
#: Bins that the search of a shard tries to empty, at most; then the packing stays as it is.
MOST_SOURCES = 2_000
#: Entries of the unit and piece caches of this operator's tokenizer.
TOKEN_UNITS, TOKEN_PIECES = 600_000, 1_000_000


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the bin that it leaves least room in."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has exactly r tokens of room
    sizes = lengths.tolist()
    for p in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[p]
        fitting = rooms >> size
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + size
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(p)
        else:
            room, b = capacity, len(bins)
            bins.append([p])
        left = room - size
        by_room[left].append(b)
        rooms |= 1 << left
    return bins


class Search:
    """Local search over the underfull bins of a shard."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int):
        self.size, self.capacity = lengths.astype(np.int64), capacity
        self.bin = np.empty(len(lengths), np.int64)
        for b, pieces in enumerate(bins):
            self.bin[pieces] = b
        self.fill = np.bincount(self.bin, weights=self.size, minlength=len(bins)).astype(np.int64)

    def run(self) -> None:
        """Empty bins for as long as the tokens fit into fewer and an exchange can be made."""
        stuck = np.zeros(len(self.fill), bool)
        for _ in range(MOST_SOURCES):
            open_bins = np.flatnonzero((self.fill > 0) & ~stuck)
            used = int((self.fill > 0).sum())
            if not len(open_bins) or used <= -(-int(self.fill.sum()) // self.capacity):
                return
            source = int(open_bins[self.fill[open_bins].argmin()])
            changed = False
            while self.fill[source] and self._exchange(source):
                changed = True
            if changed:  # other bins may find room now
                stuck[:] = False
            stuck[source] = True  # emptied, or nothing more can leave it

    def _exchange(self, source: int) -> bool:
        """The exchange that carries most tokens out of ``source`` into fuller bins, if there is one."""
        room = self.capacity - self.fill
        goals = np.flatnonzero((room > 0) & (self.fill >= self.fill[source]))
        goals = goals[goals != source]
        if not len(goals):
            return False
        mine = np.flatnonzero(self.bin == source)
        sizes = self.size[mine]
        widest = goals[room[goals].argmax()]
        fits = sizes <= room[widest]
        if fits.any():  # a whole document moves, into the bin it fills best
            p = mine[fits][sizes[fits].argmax()]
            ok = goals[room[goals] >= self.size[p]]
            self._move(p, int(ok[room[ok].argmin()]))
            return True
        theirs = np.flatnonzero(np.isin(self.bin, goals))
        goal_of = self.bin[theirs]
        best = self._swap(mine[:, None], sizes, theirs, room[goal_of])
        if len(mine) > 1:  # two for one
            i, j = np.triu_indices(len(mine), 1)
            pairs = np.stack([mine[i], mine[j]], axis=1)
            best = max(best, self._swap(pairs, sizes[i] + sizes[j], theirs, room[goal_of]), key=lambda x: x[0])
        gain, out, back = best
        if gain <= 0:
            return False
        goal = int(self.bin[back])
        self._move(int(back), source)
        for p in out:
            self._move(int(p), goal)
        return True

    def _swap(self, groups: np.ndarray, sizes: np.ndarray, theirs: np.ndarray, room: np.ndarray) -> tuple:
        """``(tokens, pieces out, piece back)`` of the best swap of one of ``groups`` for one of ``theirs``.

        For each group: the piece back of size t must leave 0 < sizes - t <= room.
        """
        best = (0, groups[0], -1)
        back = self.size[theirs]
        for lo in range(0, len(groups), 256):
            gain = sizes[lo:lo + 256, None] - back[None, :]
            gain = np.where((gain > 0) & (gain <= room[None, :]), gain, 0)
            at = int(gain.argmax())
            g, t = divmod(at, gain.shape[1])
            if gain[g, t] > best[0]:
                best = (int(gain[g, t]), groups[lo + g], theirs[t])
        return best

    def _move(self, piece: int, goal: int) -> None:
        self.fill[self.bin[piece]] -= self.size[piece]
        self.fill[goal] += self.size[piece]
        self.bin[piece] = goal


def swap_pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bin, offset, fill of the bin)`` of each piece; bins are numbered from 0 without gaps."""
    search = Search(lengths, best_fit(lengths, capacity), capacity)
    search.run()
    _, bins = np.unique(search.bin, return_inverse=True)
    order = np.argsort(bins, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    first = np.searchsorted(bins[order], bins[order])
    offsets = np.empty(len(lengths), np.int64)
    offsets[order] = before - before[first]
    return bins, offsets, search.fill[search.bin]


def pack_whole_documents(pieces: DataFrame, capacity: int = CAPACITY,
                         pieces_per_shard: int = PIECES_PER_SHARD) -> DataFrame:
    """``pieces`` (a stored table with a unique ``row`` and a ``length``) with ``sequence_id`` and
    ``offset`` in place of ``row``.  Pieces that fill a sequence stay where they are."""
    whole = pieces.filter(F.col("length") >= capacity).withColumns(
        {"sequence_id": F.col("row"), "offset": F.lit(0).cast("long")})
    done, open_pieces, level = [whole], pieces.filter(F.col("length") < capacity), 0
    out = whole.schema
    names = [f.name for f in out.fields]
    while True:
        level += 1
        size = open_pieces.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")).first()
        shards = max(1, min(-(-size["n"] // pieces_per_shard), size["tokens"] // (LEAST_BINS * capacity)))
        schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in out.fields)}, last boolean"
        dealt = open_pieces.withColumn("_shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
        packed = dealt.groupBy("_shard").applyInPandas(_packer(level << LEVEL_BITS, names, capacity), schema)
        if shards == 1:
            done.append(packed.drop("last"))
            break
        packed = stage(packed, f"packed-{level}")
        done.append(packed.filter(~F.col("last")).drop("last"))
        open_pieces = packed.filter("last").drop("last", "sequence_id", "offset")
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.drop("row")


def _packer(base: int, names: list[str], capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", kind="stable")
        bins, pdf["offset"], fill = swap_pack(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = base | int(pdf["_shard"].iloc[0]) << SHARD_BITS | bins
        pdf["last"] = bins == bins[fill.argmin()]
        return pdf[[*names, "last"]]

    return pack


def best_fit_documents(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY,
                       digest: bool = False, pieces_per_shard: int = PIECES_PER_SHARD) -> DataFrame:
    """``(doc_id, piece, start, length, doc_tokens, ids, sequence_id, offset)`` of whole documents;
    with ``digest`` a column ``ids_crc32`` in place of the ids."""
    pieces = cut_documents(docs, path, end_id, capacity, digest, (TOKEN_UNITS, TOKEN_PIECES)).drop("salt")
    pieces = stage(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    packed = pack_whole_documents(pieces, capacity, pieces_per_shard)
    return packed.withColumn("piece", F.expr(f"CAST(start DIV {capacity} AS INT)"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = best_fit_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digest=True)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
