"""Shared-folder staging and other helpers of the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; a cluster without it is an error,
    since a machine-local folder would not be seen by the other machines.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="fairspark-llm-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The result no longer depends on any executor's memory or disk, and later stages read only the
    columns they need.  The table stays for as long as the returned frame may be used; the folder
    belongs to the job and is removed with it.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged frame that no later frame reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def carried(docs: DataFrame) -> DataFrame:
    """``(_all, doc_id, text)``: all columns but the text as one, so no name of theirs meets an operator's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("_all"), "doc_id", "text")


def restored(df: DataFrame, columns: list[str], changed: Column | None = None) -> DataFrame:
    """The columns of ``carried`` documents again, with the text as it is now; where ``changed``, a
    column ``n_chars`` is the length of the new text."""
    def one(c: str) -> Column:
        if c == "text":
            return F.col("text")
        old = F.col("_all").getField(c)
        if c == "n_chars" and changed is not None:
            return F.when(changed, F.length("text")).otherwise(old).alias(c)
        return old.alias(c)

    return df.select(*[one(c) for c in columns])


#: Bits of the membership sketch of ``maybe_in``: its words are at most this / 64 rows (2 MB).
SKETCH_BITS = 1 << 23


def key_sketch(keys: DataFrame, key: str) -> DataFrame:
    """``(_word, _mask)``: a bit set over hashed keys, at most ``SKETCH_BITS / 64`` rows whatever
    the number of keys, so it may always be broadcast."""
    bit = F.pmod(F.xxhash64(key), F.lit(SKETCH_BITS))
    return (keys.select(F.shiftright(bit, 6).alias("_word"), F.pmod(bit, F.lit(64)).cast("int").alias("_b"))
            .groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _b)")).alias("_mask")))


def maybe_in(df: DataFrame, key: str, sketch: DataFrame, negate: bool = False) -> DataFrame:
    """Rows of ``df`` whose key may be in the sketch (no false negatives), or surely is not.

    It only spares the shuffle of rows that cannot join: a join on the exact key must follow.
    A full sketch passes every row, which is slower and still right.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(SKETCH_BITS))
    joined = df.withColumn("_w", F.shiftright(bit, 6)).join(
        F.broadcast(sketch), F.col("_w") == F.col("_word"), "left")
    hit = F.coalesce(F.expr("getbit(_mask, cast(pmod(xxhash64(`%s`), %d) %% 64 as int)) = 1"
                            % (key, SKETCH_BITS)), F.lit(False))
    return joined.filter(~hit if negate else hit).drop("_w", "_word", "_mask")
