"""Levels of a change (M9): which attribute a change starts from, and what should have followed.

Some attributes imply others: who moves to another state has another city,
address and postcode too. Given that order, widest first, a change's level is
the widest attribute that changed, the smallest one that explains all changes
of the order, and its violations are the narrower attributes that stayed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoset.schemas import START_COL

#: Widest first.
ADDRESS_ORDER = ["customer_state", "customer_city", "customer_address", "customer_zip"]


def level_of(changed: dict[str, Column], order: list[str]) -> tuple[Column, Column]:
    """Level and violations from a flag per attribute: NULL and an empty list when nothing of the order changed."""
    level = F.coalesce(*[F.when(changed[c], F.lit(c)) for c in order])
    at = F.coalesce(*[F.when(changed[c], F.lit(i)) for i, c in enumerate(order)])
    stayed = F.array_compact(F.array(*[F.when(~changed[c] & (F.lit(i) > at), F.lit(c)) for i, c in enumerate(order)]))
    return level, stayed


def change_levels(versions: DataFrame, key: str, order: list[str], others: list[str] = (), start: str = START_COL) -> DataFrame:
    """Per version after a key's first: level, violations and other changed attributes (comma lists).

    Values are compared null-safely with the version before: one exchange on
    the key, one sort. A key's group is bounded by its number of versions.
    """
    w = Window.partitionBy(key).orderBy(start)
    cols = [*order, *others]
    flags = versions.select(key, start, F.lag(F.lit(1)).over(w).alias("__had"), *[(~F.lag(c).over(w).eqNullSafe(F.col(c))).alias(f"__{c}") for c in cols])
    level, stayed = level_of({c: F.col(f"__{c}") for c in order}, order)
    rest = F.array_compact(F.array(*[F.when(F.col(f"__{c}"), F.lit(c)) for c in others])) if others else F.array().cast("array<string>")
    return flags.where("__had is not null").select(
        key, start, level.alias("level"), F.array_join(stayed, ",").alias("violations"), F.array_join(rest, ",").alias("others"))
