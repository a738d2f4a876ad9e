"""Helpers shared by the corpus operators: staged tables, and gapless ranks without one big sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoset.session import scratch_path

#: White space of the word and line rules: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under the shared checkpoint folder and read it back.

    Cuts the lineage and pins computed values (row ids, hashes) in files every
    executor can read, so the loss of an executor costs a re-read only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_text(col) -> Column:
    """A never-null text key of a nullable column; NULL sorts after any value."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~"))


def salt_of(*cols) -> Column:
    """One of 16 salts from the md5 of the given columns."""
    return F.substring(F.md5(F.concat_ws("|", *[key_text(c) for c in cols])), 1, 1)


def ranked(df: DataFrame, group: list[str], block: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Add the gapless 1-based rank of each row within `group`.

    Rows are ordered by `block` and, within a block, by `order`. Only a block
    is sorted in one task; a group's blocks are joined by a running sum over
    their counts (one row per block, made by a map-side combined count). So a
    group holding a third of all rows is ranked by many tasks. Neither
    `group` nor `block` may hold nulls.
    """
    keys = [*group, *block]
    running = Window.partitionBy(*group).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, F.coalesce(F.sum("__n").over(running), F.lit(0)).alias("__start"))
    )
    return (
        df.withColumn("__in", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        .join(starts, keys)
        .withColumn(name, F.col("__in") + F.col("__start"))
        .drop("__in", "__start")
    )
