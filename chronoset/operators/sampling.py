"""Reproducible sampling.

Random order is replaced by the md5 of a seed and the row's key, so a sample
is repeatable and the same in any engine. The first n rows by that order are
those up to the row of rank n, so only that row is looked for:

1. a histogram of the order's leading hex digits, one grouped count of at most
   4,096 cells, tells in which cell rank n falls and how many rows lie before;
2. a cell with more than `cell_rows` rows is divided by the next digits, until
   the cell of rank n is small enough to be sorted;
3. the sample is a filter: rows whose (hash, key) is at most that of rank n.

The table itself is never shuffled, sorted or written, whatever n is. The
input is scanned by each histogram and by the filter, so it should be a table,
not a long computation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoset.functions.scalar import hash_order

DIGITS = 3
#: Rows of a cell that one task may sort.
CELL_ROWS = 1_000_000


def _nth(df: DataFrame, order: list[Column], n: int | None, fraction: float | None, cell_rows: int) -> tuple[bool, tuple | None]:
    """Whether all rows belong to the sample, and else the order values of its last row (None: an empty sample)."""
    keyed = df.select(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    prefix, before, total = "", 0, None
    while True:
        inside = keyed.where(F.col("o0").startswith(prefix)) if prefix else keyed
        cell = F.substring("o0", len(prefix) + 1, DIGITS)
        # some 4,096 rows
        cells = sorted(inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect())
        if total is None:
            total = sum(c["n"] for c in cells)
            n = sample_count(total, fraction) if n is None else n
            if n >= total or n <= 0:
                return n >= total, None
        hit = cells[0]
        for hit in cells:
            if before + hit["n"] >= n:
                break
            before += hit["n"]
        prefix += hit["cell"]
        # no digit left: rows of equal hash, told apart by the rest of the order
        if hit["n"] <= cell_rows or len(hit["cell"]) < DIGITS:
            last = keyed.where(F.col("o0").startswith(prefix)).orderBy(*keyed.columns).offset(n - before - 1).limit(1)
            return False, tuple(last.first())


def _upto(order: list[Column], last: tuple, schema) -> Column:
    """Rows at or before the row with these order values; the hash alone decides nearly every row."""
    here = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    there = F.struct(*[F.lit(v).cast(f.dataType).alias(f"o{i}") for i, (v, f) in enumerate(zip(last, schema.fields, strict=True))])
    return (order[0] < F.lit(last[0])) | (here <= there)


def top_n(df: DataFrame, order: list[Column], n: int | None, fraction: float | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The first `n` rows, or a fraction of all rows, by `order`: a hash text (not NULL), then what makes the order total. Exact."""
    everything, last = _nth(df, order, n, fraction, cell_rows)
    if everything:
        return df
    if last is None:
        return df.limit(0)
    return df.where(_upto(order, last, df.select(*order).schema))


def sample_count(total: int, fraction: float) -> int:
    """n = round(fraction * total), rounding half to even."""
    return int(round(fraction * total))


def sample_rows(df: DataFrame, key_cols: list[str], fraction: float, seed: str) -> DataFrame:
    """A fraction of the rows, hash-ordered by seed and key (T1, A5). The histogram gives the total too."""
    return top_n(df, [hash_order(seed, *key_cols), *[F.col(k) for k in key_cols]], None, fraction)


def sample_k(df: DataFrame, key_cols: list[str], k: int, seed: str) -> DataFrame:
    """k rows without replacement, hash-ordered."""
    return top_n(df, [hash_order(seed, *key_cols), *[F.col(c) for c in key_cols]], k)


def one_per_key(df: DataFrame, key: str, seed: str) -> DataFrame:
    """Distinct by key with a reproducible survivor.

    The survivor is the row with the smallest hash of (seed, key, row). A
    grouped min is combined map-side, so a hot key is reduced before the
    shuffle instead of being sorted in one task.
    """
    others = [c for c in df.columns if c != key]
    h = hash_order(seed, key, *others)
    best = df.groupBy(key).agg(F.min(F.struct(h.alias("__h"), *others)).alias("__b"))
    return best.select(key, *[F.col(f"__b.{c}").alias(c) for c in others])


def key_sample(keys: DataFrame, key: str, fraction: float, seed: str) -> Column:
    """A filter on the key that keeps a fraction of the distinct keys of a table.

    As it reads the key only, Spark applies it before what it filters is
    grouped, joined or windowed by the key: a sample of a history is the
    history of a sample.
    """
    order = [hash_order(seed, key), F.col(key)]
    distinct = keys.select(key).distinct()
    everything, last = _nth(distinct, order, None, fraction, CELL_ROWS)
    return F.lit(everything) if last is None else _upto(order, last, distinct.select(*order).schema)


def sample_profiles(df: DataFrame, key: str, fraction: float, seed: str) -> DataFrame:
    """A fraction of the distinct keys, one profile each (T3 = A7 and T1); profiles are chosen for sampled keys only."""
    return one_per_key(df.where(key_sample(df, key, fraction, seed)), key, seed)
