"""Reading the history: point-in-time lookup and interval integrity.

These are additions that use the dimension the way SCD2 is meant to be used;
they are not part of the original loader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoset.schemas import CURRENT_COL, END_COL, START_COL


def point_in_time(facts: DataFrame, dimension: DataFrame, key: str, fact_day: str,
                  attrs: list[str] | None = None) -> DataFrame:
    """Each fact with the version valid on its day: `start <= day < end`.

    Every fact stays: without a valid version, or with a NULL key or day, its
    attributes are NULL.

    Without pair explosion: facts are first reduced to their distinct
    (key, day) pairs (bounded per key by the calendar, combined map-side).
    Those probes and the versions are unioned and scanned once per key in day
    order; the last version started on or before a probe is its candidate, kept
    when the probe day is before the version's end. Facts then meet the
    resolved pairs in an equi join on (key, day), where AQE can split a hot
    pair.
    """
    attrs = attrs or [c for c in dimension.columns if c not in (key, START_COL, END_COL, CURRENT_COL)]
    probes = facts.select(key, F.col(fact_day).alias("__day")).distinct().select(
        key, "__day", F.lit(1).alias("__kind"), F.lit(None).cast("struct<" + ",".join(
            [f"{c}:{t}" for c, t in _types(dimension, attrs + [START_COL, END_COL])]) + ">").alias("__v"))
    vers = dimension.select(
        key, F.col(START_COL).alias("__day"), F.lit(0).alias("__kind"),
        F.struct(*attrs, START_COL, END_COL).alias("__v"))
    w = Window.partitionBy(key).orderBy("__day", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    resolved = (
        vers.unionByName(probes)
        .withColumn("__hit", F.last("__v", ignorenulls=True).over(w))
        .where((F.col("__kind") == 1) & F.col("__hit").isNotNull() & (F.col("__day") < F.col(f"__hit.{END_COL}")))
        .select(key, F.col("__day").alias(fact_day), "__hit")
    )
    return facts.join(resolved, [key, fact_day], "left").select(
        *facts.columns, *[F.col(f"__hit.{c}").alias(c) for c in attrs + [START_COL]])


def _types(df: DataFrame, cols: list[str]):
    d = dict(df.dtypes)
    return [(c, d[c]) for c in cols]


def integrity(dimension: DataFrame, key: str) -> DataFrame:
    """One-row report of interval defects.

    keys, rows, keys with more than one open row, overlaps (next start before
    this end), gaps (next start after this end) and inverted intervals
    (end before start). A clean `changed_only` history has zeros only.
    """
    w = Window.partitionBy(key).orderBy(START_COL, END_COL)
    nxt = F.lead(START_COL).over(w)
    per_row = dimension.select(
        key, CURRENT_COL,
        F.coalesce(nxt < F.col(END_COL), F.lit(False)).alias("__ov"),
        F.coalesce(nxt > F.col(END_COL), F.lit(False)).alias("__gap"),
        (F.col(END_COL) < F.col(START_COL)).alias("__inv"),
    )
    per_key = per_row.groupBy(key).agg(
        F.count(F.lit(1)).alias("__rows"), F.count_if(CURRENT_COL).alias("__open"),
        F.count_if("__ov").alias("__ov"), F.count_if("__gap").alias("__gap"), F.count_if("__inv").alias("__inv"))
    return per_key.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("__rows").cast("long").alias("n_rows"),
        F.count_if(F.col("__open") > 1).alias("keys_multi_current"),
        F.sum("__ov").cast("long").alias("n_overlaps"),
        F.sum("__gap").cast("long").alias("n_gaps"),
        F.sum("__inv").cast("long").alias("n_inverted"),
    )
