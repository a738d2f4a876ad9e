"""JSON-lines scans of the raw daily feed.

The schema is always declared: no inference job, no per-file type drift,
and unparsable lines land in a corrupt-record column instead of failing or
vanishing. The originating file rides along from the hidden `_metadata`
column, so one scan can read every pending file at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoset.functions.scalar import file_date
from chronoset.schemas import RAW_TRANSACTION_SCHEMA, TS_NTZ_FORMAT, with_corrupt_column

CORRUPT = "_corrupt"


def as_struct(schema) -> T.StructType:
    """A declared schema as a struct type; DDL text is parsed."""
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def read_json(spark: SparkSession, paths, schema: T.StructType = RAW_TRANSACTION_SCHEMA, multiline: bool = False,
              with_file: bool = True, corrupt: bool = True, options: dict | None = None) -> DataFrame:
    """Read one or many JSON-lines files (or a whole JSON array with
    `multiline=True`). Blank lines are skipped by the reader."""
    if isinstance(paths, str):
        paths = [paths]
    sch = with_corrupt_column(as_struct(schema), CORRUPT) if corrupt else schema
    reader = spark.read.schema(sch).option("mode", "PERMISSIVE").option("timestampNTZFormat", TS_NTZ_FORMAT)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if multiline:
        reader = reader.option("multiLine", True)
    df = reader.json(list(paths))
    if with_file:
        df = df.withColumn("file_path", F.col("_metadata.file_path")).withColumn(
            "file_name", F.col("_metadata.file_name")).withColumn("file_date", file_date(F.col("_metadata.file_name")))
    return df


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, corrupt lines).

    Spark refuses a query on raw JSON that reads nothing but the corrupt
    column (e.g. a bare `count()` of either side); write the bad side to a
    quarantine folder, or read data columns with it.
    """
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    # Spark refuses queries that touch only the corrupt column of a raw
    # JSON scan; a projection that keeps the other columns is fine.
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.where(F.col(CORRUPT).isNotNull())
    return good, bad


def read_profiles(spark: SparkSession, paths, schema: T.StructType = RAW_TRANSACTION_SCHEMA,
                  struct_name: str = "customer_info") -> DataFrame:
    """The embedded profile of every row of several files."""
    return read_json(spark, paths, schema, with_file=False, corrupt=False).select(f"{struct_name}.*")


def parse_json_text(df: DataFrame, text_col: str, schema: T.StructType, name: str = "record") -> DataFrame:
    """JSON text column -> struct column."""
    return df.withColumn(name, F.from_json(F.col(text_col), schema))


def to_json_text(df: DataFrame, name: str = "value", keep_nulls: bool = False) -> DataFrame:
    """Whole row -> JSON text (X15); NULL fields dropped unless `keep_nulls`."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return df.select(F.to_json(F.struct(*df.columns), opts).alias(name))
