"""Reading and writing tables as CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.sources.schemas import RAW_TABLES

_CSV = {"header": "true", "dateFormat": "yyyy-MM-dd", "nullValue": "", "emptyValue": ""}


def read_table(spark: SparkSession, path: str, schema: T.StructType, format: str = "csv") -> DataFrame:
    """Typed scan: no inference pass over the data, dates parsed by the scan.

    ``FAILFAST`` makes a malformed line an error instead of a silent NULL. So is a
    number with more digits than its DECIMAL column holds: the CSV scan alone would
    round it, so such columns are read as text and cast.
    """
    if format != "csv":
        return spark.read.schema(schema).format(format).load(path)
    exact = [f.name for f in schema if isinstance(f.dataType, T.DecimalType)]
    read_as = T.StructType([T.StructField(f.name, T.StringType() if f.name in exact else f.dataType) for f in schema])
    scan = spark.read.schema(read_as).options(**_CSV, mode="FAILFAST", enforceSchema="false").csv(path)
    return scan.select(*[_whole(f).alias(f.name) if f.name in exact else F.col(f.name) for f in schema])


def _whole(field: T.StructField) -> Column:
    """A DECIMAL from its text; an error where the text is no number or loses digits."""
    text = F.col(field.name)
    value = text.try_cast(field.dataType)
    same = F.coalesce(value.cast("double") == text.try_cast("double"), F.lit(False))
    lost = F.concat(F.lit(f"{field.name} can't be cast to {field.dataType.simpleString()} whole: "), text)
    return F.when(text.isNull() | same, value).otherwise(F.raise_error(lost))


def read_raw(spark: SparkSession, folder: str, format: str = "csv") -> dict[str, DataFrame]:
    """The four raw tables of a folder."""
    return {
        name: read_table(spark, f"{folder}/{name}.{format}", schema, format)
        for name, schema in RAW_TABLES.items()
    }


def write_table(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Write all partitions in parallel; the folder appears when the job has committed."""
    writer = df.write.mode("overwrite")
    if format == "csv":
        writer.options(**_CSV).csv(path)
    else:
        writer.format(format).save(path)
