"""Sharding by a k-d tree over document metadata.

A node that holds k leaves is split at the weighted quantile floor(k/2)/k of
its bytes, the weighted median where k is even, along the dimension in which
its rows are spread widest, until every leaf is one shard of the target size.

The quantile is found without a sort: bytes are summed by (node, one of 4,096
slices of the widest dimension), the slice that holds the quantile is summed
again by 4,096 slices of a hash, and the node is cut at the nearest of those.
So a value held by a third of the rows is split too. Sums are combined on the
map side. Cuts, one row per node, stay in tables that Catalyst broadcasts only
while they are small.

A text dimension counts by rank: the distinct values are dealt out by range and
counted, and 4,096 of them, evenly spaced, are the steps of the coordinate.

Defined results: NULL text has 0 bytes, a very long one its length; a NULL in a
dimension lies below all values; repeated rows count one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoset.llm.common import key_text, ranked, salt_of, staged

SLICES = 4096
OVERHEAD = 8


def text_bytes(text: Column, overhead: int = OVERHEAD) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("long")


def _quantiles(values: DataFrame, name: str, count: int = SLICES) -> list:
    """At most `count` of the distinct values of a column, evenly spaced by rank; all of them where there are no more.

    The distinct values are dealt out by ranges of themselves, so neither a
    common prefix nor a hot value puts them into one task; counts of the
    ranges give every value its rank.
    """
    width = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = values.select(F.col(name).alias("v")).where("v is not null").distinct()
    ranged = staged(distinct.repartitionByRange(width, "v").withColumn("p", F.spark_partition_id()), "kd-values")
    counts = sorted(tuple(r) for r in ranged.groupBy("p").count().collect())
    total = sum(n for _, n in counts)
    if total <= count:
        return sorted((r["v"] for r in ranged.select("v").collect()), key=lambda v: v.encode())
    start = dict(zip([p for p, _ in counts], [0, *accumulate(n for _, n in counts)], strict=False))
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in start.items() for x in pair]), F.col("p"))
    rank = F.row_number().over(Window.partitionBy("p").orderBy("v")) + offset
    # rank r is kept where r * count / total passes a whole number
    hit = F.floor(F.col("r") * count / total) > F.floor((F.col("r") - 1) * count / total)
    return sorted((r["v"] for r in ranged.withColumn("r", rank).where(hit).select("v").collect()), key=lambda v: v.encode())


def _place(c: Column, points: list) -> Column:
    """How many of the sorted points are at or below a value: among every 64th first, then among the 64 after."""
    step = 64
    heads = points[::step]
    blocks = [points[i : i + step] for i in range(0, len(points), step)]
    upto = lambda array: F.size(F.filter(array, lambda p: p <= c))
    head = upto(F.lit(heads))
    inside = upto(F.element_at(F.lit(blocks), F.greatest(head, F.lit(1))))
    return F.when(c.isNotNull(), F.when(head == 0, F.lit(0)).otherwise((head - 1) * step + inside)).cast("double")


def dimensions(df: DataFrame, names: list[str]) -> list[Column]:
    """A coordinate per dimension: texts by their rank among the distinct values, in 4,096 steps; `size` by its logarithm."""
    kinds = dict(df.dtypes)
    out = []
    for n in names:
        c = F.col(n)
        if kinds[n] == "string":
            points = _quantiles(df, n)
            d = _place(c, points) if points else F.lit(None).cast("double")
        else:
            d = F.log2(F.greatest(c.cast("double"), F.lit(0.0)) + 1) if n == "size" else c.cast("double")
        out.append(d.alias(f"__d{len(out)}"))
    return out


def kd_assigned(rows: DataFrame, dims: list[str], size_col: str = "size", shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """All columns of `rows` and `shard`, which replaces a column so named. `dims` are columns of `rows`; the first wins a tie."""
    rows = rows.drop("shard")
    ds = [f"__d{i}" for i in range(len(dims))]
    coords = rows.select("*", *dimensions(rows, dims), F.col(size_col).alias("__w"), F.pmod(F.xxhash64(*[key_text(c) for c in rows.columns]), F.lit(SLICES)).cast("int").alias("__h"))
    coords = staged(coords, "kd-rows")
    ends = coords.agg(F.sum("__w").alias("bytes"), *[F.min(d).alias(f"{d}_lo") for d in ds], *[F.max(d).alias(f"{d}_hi") for d in ds]).first()
    if shards is None:
        shards = max(1, math.ceil((ends["bytes"] or 0) / target_bytes))
    unit = []
    for d in ds:
        lo, hi = ends[f"{d}_lo"], ends[f"{d}_hi"]
        # (0, 1] over the whole table, NULL at 0
        x = (F.col(d) - F.lit(lo)) / F.lit(hi - lo) if lo is not None and hi > lo else F.when(F.col(d).isNotNull(), F.lit(0.0))
        unit.append(F.coalesce(x * F.lit(0.999) + F.lit(0.001), F.lit(0.0)).alias(d))
    tree = coords.select(*rows.columns, "__w", "__h", *unit, F.lit(0).alias("__at"), F.lit(shards).alias("__k"))
    node = ["__at", "__k"]
    k = shards
    while k > 1:
        cuts = staged(_cuts(tree, ds, node), "kd-cuts")
        left = F.floor(F.col("__k") / 2).cast("int")
        side = tree.join(cuts, node, "left")
        x = F.element_at(F.array(*[F.col(d) for d in ds]), F.col("__dim"))
        at = F.floor((x - F.col("__lo")) * F.col("__scale"))
        low = (at < F.col("__slice")) | ((at == F.col("__slice")) & (F.col("__h") < F.col("__cut")))
        low = F.coalesce(low, F.lit(False))
        split = F.col("__k") > 1
        tree = staged(
            side.select(
                *rows.columns, "__w", "__h", *ds,
                F.when(split & ~low, F.col("__at") + left).otherwise(F.col("__at")).alias("__at"),
                F.when(split, F.when(low, left).otherwise(F.col("__k") - left)).otherwise(F.col("__k")).alias("__k"),
            ),
            "kd-level",
        )
        k = k - k // 2
    return tree.select(*rows.columns, F.col("__at").alias("shard"))


def _cuts(tree: DataFrame, ds: list[str], node: list[str]) -> DataFrame:
    """One row per node of two leaves or more: dimension, its slice and the hash cut within the slice."""
    inner = tree.where("__k > 1")
    spread = inner.groupBy(*node).agg(F.sum("__w").alias("__sum"), *[F.min(d).alias(f"{d}_lo") for d in ds], *[F.max(d).alias(f"{d}_hi") for d in ds])
    widest = F.greatest(*[F.struct((F.col(f"{d}_hi") - F.col(f"{d}_lo")).alias("width"), F.lit(-i).alias("first"), F.col(f"{d}_lo").alias("lo")) for i, d in enumerate(ds)], F.lit(None).cast("struct<width:double,first:int,lo:double>"))
    nodes = staged(
        spread.withColumn("m", widest).select(
            *node,
            (F.lit(1) - F.col("m.first")).alias("__dim"),
            F.col("m.lo").alias("__lo"),
            F.when(F.col("m.width") > 0, F.lit(SLICES - 1) / F.col("m.width")).otherwise(F.lit(0.0)).alias("__scale"),
            (F.col("__sum") * F.floor(F.col("__k") / 2) / F.col("__k")).alias("__goal"),
        ),
        "kd-nodes",
    )
    x = F.element_at(F.array(*[F.col(d) for d in ds]), F.col("__dim"))
    sliced = inner.join(nodes, node).withColumn("__s", F.floor((x - F.col("__lo")) * F.col("__scale")))
    run = Window.partitionBy(*node).orderBy("__s")
    here = (
        sliced.groupBy(*node, "__s").agg(F.sum("__w").alias("__v"), F.first("__goal").alias("__goal"))
        .withColumn("__upto", F.sum("__v").over(run))
        .where("__upto >= __goal and __upto - __v < __goal")
        .select(*node, F.col("__s").alias("__slice"), (F.col("__upto") - F.col("__v")).alias("__base"))
    )
    here = staged(nodes.join(here, node), "kd-slice")
    inside = inner.join(here, node).where(F.floor((x - F.col("__lo")) * F.col("__scale")) == F.col("__slice"))
    fine = Window.partitionBy(*node).orderBy("__h")
    gap = F.abs(F.col("__base") + F.col("__upto") - F.col("__goal"))
    steps = inside.groupBy(*node, "__h").agg(F.sum("__w").alias("__v"), F.first("__base").alias("__base"), F.first("__goal").alias("__goal")).withColumn("__upto", F.sum("__v").over(fine))
    best = steps.groupBy(*node).agg(
        F.min(F.struct(gap.alias("gap"), (F.col("__h") + 1).alias("cut"))).alias("b"),
        F.min(F.abs(F.col("__base") - F.col("__goal"))).alias("none"),
    )
    # cut 0: the whole slice goes right
    best = best.select(*node, F.when(F.col("none") < F.col("b.gap"), F.lit(0)).otherwise(F.col("b.cut")).alias("__cut"))
    return here.join(best, node).select(*node, "__dim", "__lo", "__scale", "__slice", "__cut")


def with_slots(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add slot, gapless from 0 within each shard."""
    salted = rows.drop("slot").withColumn("__salt", salt_of(*order))
    return ranked(salted, ["shard"], ["__salt"], [F.col(c).asc_nulls_last() for c in order], "__r").withColumn("slot", (F.col("__r") - 1).cast("long")).drop("__r", "__salt")
