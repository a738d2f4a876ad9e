"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected target / source size times. In an order
by size, the expected copies are prefix-summed, one random offset per source
is added, and a document is emitted once for every integer boundary its
interval crosses. So the number of copies of any run of documents is within
one of its expectation, and a source's words come near the target.

The prefix sum is the rank times the expected copies, and the rank is made of
blocks (source, size band, salt): a hot source is sorted by many tasks.

Defined results: NULL sizes count as 0; NULL is a source of its own, after all
others; repeated rows are sampled one by one; a source of size 0 has target 0
and gives no copy; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoset.llm.common import WORD, key_text, ranked, salt_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_band(size: Column) -> Column:
    """Eight bands for each power of two, 0 for size 0; integers only, so every engine agrees."""
    bits = F.length(F.bin(size))
    top = F.call_function("shiftright", size * 8, bits - 1).cast("int")
    return F.when(size <= 0, F.lit(0)).otherwise(bits * 8 + top - 8)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Water-filling of share x all sizes over sources (columns source, source_size) -> + target.

    Capped sources are those with the smallest cap per weight; behind them
    one level, cap-free words per weight, holds for all others. One row per
    source goes through the window.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = (F.col("source_size") * most).cast("double")
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        sizes.withColumn("weight", w)
        .withColumn("cap", cap)
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        # the level of the first source that stays below its cap; none if all are capped
        .withColumn("open", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(everything))
        .withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("open.level") * F.col("weight"), F.col("cap"))))
        .select("source", "source_size", "target")
    )


def _drawn(docs: DataFrame, size: Column, source_col: str, tie: list[str], weights, share: float, most: int, seed: str) -> DataFrame:
    """All columns of `docs` and __source_size, __target, __copies."""
    rows = (
        docs.withColumn("__size", F.coalesce(size.cast("long"), F.lit(0)))
        .withColumn("__source", key_text(source_col))
        .withColumn("__band", F.lit(1000) - size_band(F.col("__size")))
        .withColumn("__salt", salt_of(*tie))
    )
    sizes = rows.groupBy("__source").agg(F.first(source_col).alias("source"), F.sum("__size").alias("source_size"))
    plan = targets(sizes.select("source", "source_size"), weights, share, most).withColumn("__source", key_text("source"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("__source"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.select("__source", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), offset.alias("__u"), each.alias("__each"))
    order = [F.col("__size").desc(), *[F.col(c).asc_nulls_last() for c in tie]]
    out = ranked(rows, ["__source"], ["__band", "__salt"], order, "__rank")
    upto = lambda r: F.floor(r * F.col("__each") + F.col("__u"))
    copies = F.least(upto(F.col("__rank")) - upto(F.col("__rank") - 1), F.lit(most)).cast("int")
    return out.join(plan, "__source").select(*docs.columns, "__source_size", "__target", copies.alias("__copies"))


def planned(docs: DataFrame, size: Column | str = "size", source_col: str = "source", tie: list[str] | None = None, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """All columns of `docs` and source_size, target, copies, which replace columns so named. `tie` orders rows of equal size."""
    size = F.col(size) if isinstance(size, str) else size
    docs = docs.drop("source_size", "target", "copies")
    out = _drawn(docs, size, source_col, tie or ["doc_id"], weights, share, most, seed)
    return out.withColumnsRenamed({"__source_size": "source_size", "__target": "target", "__copies": "copies"})


def mixed(docs: DataFrame, text_col: str = "text", source_col: str = "source", tie: list[str] | None = None, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mix itself: each row of `docs` as often as it was drawn, columns as before."""
    plan = _drawn(docs, word_count(F.col(text_col)), source_col, tie or ["doc_id"], weights, share, most, seed)
    return plan.withColumn("__copy", F.explode(F.expr("case when __copies > 0 then sequence(1, __copies) else array() end"))).select(*docs.columns)
