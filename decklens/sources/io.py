"""Sources and sinks (A1-A6): CSV, Parquet, JSON, models, predictions.

Paths on a cluster must be shared storage; scratch output of the registered
queries goes under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from decklens.session import checkpoint_dir

# pandas' default missing-value strings for read_csv.
PANDAS_NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                     "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                     "nan", "null"]


def na_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Map pandas' NA strings to NULL in string columns (whole-cell match)."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(PANDAS_NA_STRINGS), F.col(c)) for c in cols})


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """A1: header CSV with quoted multi-line fields (deck lists hold newlines).

    Every cell is read as text, pandas' missing-value strings become NULL, and
    only then are the cells cast to ``schema``; a cell that does not parse is
    NULL.  A file with multi-line fields is one task; ``multi_line=False``
    lets Spark split files whose fields hold no line breaks."""
    r = (spark.read.option("header", True).option("multiLine", multi_line).option("inferSchema", False)
         .option("quote", '"').option("escape", '"').option("mode", "FAILFAST"))
    if schema is None:
        return na_to_null(r.csv(path))
    if not isinstance(schema, StructType):
        schema = StructType.fromDDL(schema)
    text = na_to_null(r.schema(StructType([StructField(f.name, StringType()) for f in schema])).csv(path))
    return text.select(*[(F.col(f"`{f.name}`") if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`").try_cast(f.dataType)).alias(f.name)
                         for f in schema])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3: header CSV; maps become JSON text; whitespace is kept as is."""
    out = df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                      if f.dataType.typeName() in ("map", "struct", "array") else F.col(f.name)
                      for f in df.schema.fields])
    (out.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet, optionally partitioned (e.g. predictions by model)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4: JSON lines (the metric summary is one row)."""
    df.write.mode(mode).json(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "scratch", f"{name}-{uuid.uuid4().hex[:10]}")


def csv_roundtrip(df: DataFrame, name: str = "csv") -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


def parquet_roundtrip(df: DataFrame, name: str = "parquet", partition_by: list[str] | None = None) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_parquet(df, path, partition_by)
    back = spark.read.parquet(path)
    return back.select(*df.columns)
