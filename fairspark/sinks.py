"""Results out: written whole, then published by a manifest.

A result goes to a folder of its own under ``path``; its rows are counted as they are written and
again as they are read back.  Only then a manifest of one row names the folder, the format, the
schema and the number of rows.  Readers go by the newest manifest, so a failed, stopped or running
job never shows half a result, and the result before it stays readable.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .functions.geometry import Centers
from .operators.objective import center_text, centers_frame

MANIFEST = "version long, folder string, format string, schema string, rows long"


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """All published results under ``path``, one row each."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/manifest-*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def latest(spark: SparkSession, path: str):
    """The newest manifest row, or None; of two jobs with one version the larger folder name counts."""
    return manifests(spark, path).orderBy(F.desc("version"), F.desc("folder")).first()


def publish(df: DataFrame, path: str, format: str = "parquet") -> int:
    """Write ``df`` under ``path`` and publish it; returns its number of rows."""
    spark, path = df.sparkSession, path.rstrip("/")
    last = latest(spark, path)
    version, folder = (last["version"] + 1 if last else 0), f"data-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(format).save(f"{path}/{folder}")
    rows = _load(spark, path, folder, format, df.schema.json()).count()
    if rows != seen.get["rows"]:
        raise RuntimeError(f"{seen.get['rows']} rows were written to {path}/{folder}, {rows} are there")
    one = spark.createDataFrame([(version, folder, format, df.schema.json(), rows)], MANIFEST)
    one.coalesce(1).write.json(f"{path}/manifest-{version:012d}-{folder}")
    return rows


def read_published(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """The newest published result; with ``check`` its rows are counted against the manifest."""
    path = path.rstrip("/")
    m = latest(spark, path)
    if m is None:
        raise FileNotFoundError(f"nothing is published under {path}")
    df = _load(spark, path, m["folder"], m["format"], m["schema"])
    if check and (rows := df.count()) != m["rows"]:
        raise RuntimeError(f"{path}/{m['folder']} has {rows} rows, its manifest says {m['rows']}")
    return df


def _load(spark: SparkSession, path: str, folder: str, format: str, schema: str) -> DataFrame:
    from pyspark.sql.types import StructType
    import json

    return spark.read.format(format).schema(StructType.fromJson(json.loads(schema))).load(f"{path}/{folder}")


def center_rows(spark: SparkSession, models: dict[str, Centers], decimals: int = 6) -> DataFrame:
    """``(model, cid, center, center_text)`` of named centre lists, for ``publish``."""
    out = None
    for name, centers in models.items():
        rows = centers_frame(spark, centers).select(F.lit(name).alias("model"), "cid", "center", center_text("center", decimals).alias("center_text"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no centres to write")
    return out
