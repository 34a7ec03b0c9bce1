"""The model-comparison table: one row of figures per model, the newest one of each.

The table is a log. Every change adds an entry of its own, a folder whose name holds a number above all that its writer
saw and a random part, so two writers never write to one place and neither reads what it changes: both rows stay.
Readers take each model's row from its newest entry; of two with one number, written at the same time, the random part
decides, for all readers alike. An entry counts once its ``_SUCCESS`` mark is there; a job that dies half-way leaves
nothing behind that is read.

An entry may reset the table: what is older than it no longer counts. A training that starts anew does so with its first
model, so that a model of an earlier training can't be compared with those of the new one.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.sources.schemas import MODEL_COMPARISON
from stayline.sources.tables import read_table, write_table

_RESET = "-reset"


def read_metrics(spark: SparkSession, folder: str) -> DataFrame | None:
    """One row per model, or None when nothing was written yet."""
    found = _entries(spark, folder)
    if not found:
        return None
    since = max((name for name in found if name.endswith(_RESET)), default="")
    # A few entries per training: each is one small file.
    parts = [
        read_table(spark, f"{folder}/{name}", MODEL_COMPARISON).withColumn("_entry", F.lit(name))
        for name in found
        if name >= since
    ]
    names = MODEL_COMPARISON.names
    rows = reduce(DataFrame.unionByName, parts)
    newest = rows.groupBy("model").agg(F.max_by(F.struct(*names), "_entry").alias("row"))
    return newest.select(*[F.col(f"row.{name}").alias(name) for name in names])


def upsert_metrics(spark: SparkSession, folder: str, new: DataFrame, reset: bool = False) -> DataFrame:
    """Replace the models in ``new``, keep the others; with ``reset`` no others are kept."""
    new = new.select(*[new[f.name].cast(f.dataType).alias(f.name) for f in MODEL_COMPARISON])
    seen = max((_number(name) for name in _entries(spark, folder)), default=0)
    name = f"entry={seen + 1:06d}-{uuid.uuid4().hex}{_RESET if reset else ''}"
    write_table(new.coalesce(1), f"{folder}/{name}", "csv")
    return read_metrics(spark, folder)


def _number(name: str) -> int:
    return int(name.split("=")[1].split("-")[0])


def _entries(spark: SparkSession, folder: str) -> list[str]:
    """The names of all committed entries, in order."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/entry=*/_SUCCESS")) or []
    return sorted(str(s.getPath().getParent().getName()) for s in found)
