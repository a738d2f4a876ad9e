"""Exact dedup by a heavy-hitter split.

Misra-Gries counters (Spark's `freqItems`) find every digest above a share of
the rows in one pass with bounded memory. Those digests are recounted exactly
and their winners, at most 1 / support rows, are broadcast, so the largest
groups of copies are settled on the map side. All other digests take the
ordinary shuffle, where no group is above that share.

Defined results: NULL text counts as empty; NULL ids order after all others;
of rows repeated with the same id exactly one stays; an empty table gives an
empty result; a very long text is one digest; other columns of the input are
ignored, or kept by `drop_copies`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoset.llm.common import SPACE, staged

#: A digest above this share of the rows is certain to be found as frequent; also bounds the broadcast to 10,000 rows.
SUPPORT = 1e-4


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    return _grouped(docs, id_col, text_col, support, F.monotonically_increasing_id()).drop("rid")


def _grouped(docs: DataFrame, id_col: str, text_col: str, support: float, rid: Column) -> DataFrame:
    digests = staged(
        docs.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"), rid.alias("rid")),
        "digests",
    )
    # the counters work on 60 bits of the digest; the winners are verified on all of it
    short = F.conv(F.substring("text_sha256", 1, 15), 16, 10).cast("long")
    frequent = digests.select(short.alias("short")).freqItems(["short"], support).select(F.explode("short_freqItems").alias("short"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    winners = staged(
        digests.withColumn("short", short)
        .join(F.broadcast(frequent), "short", "left_semi")
        .groupBy("text_sha256")
        .agg(first.alias("w"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select("text_sha256", F.col("w.doc_id").alias("keep_id"), F.col("w.rid").alias("win"), "group_size"),
        "winners",
    )
    hot = digests.join(F.broadcast(winners), "text_sha256").withColumn("kept", F.col("rid") == F.col("win"))
    same = Window.partitionBy("text_sha256")
    order = same.orderBy(F.col("doc_id").asc_nulls_last(), "rid")
    rest = (
        digests.join(F.broadcast(winners), "text_sha256", "left_anti")
        .withColumn("keep_id", F.first("doc_id").over(order))
        .withColumn("kept", F.row_number().over(order) == 1)
        .withColumn("group_size", F.count(F.lit(1)).over(same))
    )
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "rid"]
    return hot.select(*out).unionByName(rest.select(*out))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of `docs` that stay, all columns; of repeated rows with one id, one.

    The rows are numbered in a table first, so that the row that stays is told
    from its copies.
    """
    rid = "__rid"
    numbered = staged(docs.withColumn(rid, F.monotonically_increasing_id()), "numbered")
    keep = _grouped(numbered, id_col, text_col, support, F.col(rid)).where("kept").select(F.col("rid").alias(rid))
    return numbered.join(keep, rid, "left_semi").drop(rid)
