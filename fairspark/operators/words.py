"""Word counts over lines (one line = one document).

Four formulations give the same ``(word, n)``:

* ``one_round``   -- explode tokens, group by word;
* ``salted``      -- a salt per (document, word) attached to each token, count per
                     (salt, word), then sum per word;
* ``salted_expr`` -- the same with the salt computed inside the grouping;
* ``partition``   -- count per word within each task, then sum per word.

Catalyst already combines map-side (partial aggregation), so ``one_round``
is the plan to use, and ``partition`` is the same plan: the partial aggregate
is the count within a task.  The salted ones split a hot word over ``salts``
reducers in the first round.  The salt is a hash, not a random draw, so a retried task
reproduces its output exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens

MODES = ("one_round", "salted", "salted_expr", "partition")
DEFAULT_SALTS = 8
#: Bytes of lines whose words one task counts by line: their distinct words fit its memory.
LINE_BYTES = 8 << 20


def num_docs(lines: DataFrame) -> DataFrame:
    """``(n_docs)``: number of lines."""
    return lines.agg(F.count(F.lit(1)).alias("n_docs"))


def _words(lines: DataFrame, id_cols: Sequence[str], col: str = "value") -> DataFrame:
    # outer explode + null filter: an inner explode would make Catalyst add a
    # ``size(tokens) > 0`` filter that splits every line a second time
    return (lines.select(*id_cols, F.explode_outer(tokens(F.col(col))).alias("word"))
            .filter(F.col("word").isNotNull()))


def per_doc_counts(lines: DataFrame, id_cols: Sequence[str] = ("doc_id", "line_no"),
                   col: str = "value") -> DataFrame:
    """``(*id_cols, word, n)``: occurrences of each word in each line.

    Few words come twice in a line, so a map-side combine saves little: the lines are shuffled
    whole, by all of ``id_cols``, and their words counted where they arrive, without another shuffle.
    Lines of one id meet in one task, which holds their distinct words.
    """
    size = lines.agg(F.sum(F.octet_length(col))).first()[0] or 0
    parts = max(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // LINE_BYTES))
    placed = lines.select(*id_cols, col).repartition(parts, *id_cols)
    return (_words(placed, id_cols, col).groupBy(*id_cols, "word")
            .agg(F.count(F.lit(1)).alias("n")))


def _salt(keys: Sequence[str], salts: int) -> F.Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in keys], F.col("word")), F.lit(salts)).cast("int")


def word_counts(lines: DataFrame, mode: str = "one_round", salts: int | None = None,
                id_cols: Sequence[str] = (), col: str = "value") -> DataFrame:
    """``(word, n)`` over all lines.

    ``id_cols`` identify a line for the salt; without them the line text does.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    salts = salts or DEFAULT_SALTS
    one = F.count(F.lit(1)).alias("n")
    if mode == "one_round":
        return _words(lines, (), col).groupBy("word").agg(one)
    if mode == "partition":
        # counts of each task's own words, then of all: the key is where a word stands, not what it is
        first = _words(lines, (), col).withColumn("part", F.spark_partition_id()).groupBy("part", "word").agg(one)
        return first.groupBy("word").agg(F.sum("n").alias("n"))
    keys = list(id_cols) if id_cols else [col]
    w = _words(lines, keys, col)
    if mode == "salted":
        first = w.withColumn("salt", _salt(keys, salts)).groupBy("salt", "word").agg(one)
    else:
        first = w.groupBy(_salt(keys, salts).alias("salt"), "word").agg(one)
    return first.groupBy("word").agg(F.sum("n").alias("n"))


def distinct_words(counts: DataFrame) -> DataFrame:
    """``(n_words)``: number of distinct words."""
    return counts.agg(F.count(F.lit(1)).alias("n_words"))


def avg_word_length(counts: DataFrame) -> DataFrame:
    """``(avg_word_length)``: mean length (code points) of the distinct words."""
    return counts.agg(F.avg(F.length("word")).alias("avg_word_length"))
