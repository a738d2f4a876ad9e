"""Type 2 history of a keyed entity, as set-based Spark plans.

Dimension rows carry the key, the attribute columns, and
`effective_start_date` / `effective_end_date` (half-open interval) /
`is_current`. Two change modes exist:

* ``changed_only`` (default): a version opens only when a tracked attribute
  differs from the open version, NULL compared as a value (`<=>`); exactly
  one open row per key.
* ``append_all``: every staged row is inserted and an open row is closed only
  when a tracked attribute differs under three-valued `<>` (NULL on either
  side is not a change). Kept for parity with the original loader.

Scale notes. Every history operator first reduces the feed to one row per
(key, day) with a map-side-combined aggregate, so a key's window group is
bounded by its number of days, never by its number of raw rows. The windows
of one operator share one partitioning and one sort on (key, day).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoset.functions.scalar import null_safe_changed, open_end, three_valued_changed
from chronoset.schemas import CURRENT_COL, END_COL, START_COL

CHANGED_ONLY = "changed_only"
APPEND_ALL = "append_all"
BOOK_COLS = [START_COL, END_COL, CURRENT_COL]


def _attrs(df: DataFrame, key: str, exclude: list[str]) -> list[str]:
    return [c for c in df.columns if c != key and c not in exclude]


def _or(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)


def changed(prev_cols: list, cur_cols: list, mode: str = CHANGED_ONLY) -> Column:
    """Change predicate between two attribute lists."""
    if mode == CHANGED_ONLY:
        return null_safe_changed(prev_cols, cur_cols)
    return F.coalesce(three_valued_changed(prev_cols, cur_cols), F.lit(False))


# ---------------------------------------------------------------------------
# Full history build (M5) and its append_all form (M6)
# ---------------------------------------------------------------------------

def build(daily: DataFrame, key: str, day: str, tracked: list[str], attrs: list[str] | None = None) -> DataFrame:
    """History from daily snapshots with one row per (key, day).

    A row opens a version when it is a key's first row or a tracked attribute
    differs (null-safe) from the previous day's row; the version ends at the
    next version's start. `lag` and `lead` run over the same
    (key ordered by day) window: one exchange on the key and one sort.
    Untracked attributes keep the values of the version's first day.
    """
    attrs = attrs or _attrs(daily, key, [day])
    w = Window.partitionBy(key).orderBy(day)
    first = F.lag(F.lit(1)).over(w).isNull()
    flag = first | null_safe_changed([F.lag(c).over(w) for c in tracked], [F.col(c) for c in tracked])
    versions = daily.select(key, day, *attrs, flag.alias("__chg")).where("__chg")
    nxt = F.lead(day).over(w)
    return versions.select(
        key,
        *attrs,
        F.col(day).alias(START_COL),
        F.coalesce(nxt, open_end()).alias(END_COL),
        nxt.isNull().alias(CURRENT_COL),
    )


def build_append_all(daily: DataFrame, key: str, day: str, tracked: list[str], attrs: list[str] | None = None) -> DataFrame:
    """History under `append_all`: every daily row is a version (M6).

    A row is closed at the first later day whose row differs under `<>` in at
    least one tracked column where both sides are non-null. Per column that
    day is the first later *run start* of the column's non-null subsequence
    (a non-null value that differs from the last non-null value before it);
    a row whose column is NULL can never be closed through that column. The
    end is the least such day over the tracked columns. This is exact with
    NULLs and linear: two window passes over the same key partitioning, no
    self join.
    """
    attrs = attrs or _attrs(daily, key, [day])
    asc = Window.partitionBy(key).orderBy(day)
    before = asc.rowsBetween(Window.unboundedPreceding, -1)
    starts = daily.select(
        key, day, *attrs,
        *[
            F.when(
                F.col(c).isNotNull()
                & ~F.coalesce(F.last(c, ignorenulls=True).over(before) == F.col(c), F.lit(False)),
                F.col(day),
            ).alias(f"__s{i}")
            for i, c in enumerate(tracked)
        ],
    )
    # "first run start after this row" = last non-null looking back in the
    # reversed order; a growing frame, so linear per key.
    desc = Window.partitionBy(key).orderBy(F.col(day).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = [
        F.when(F.col(c).isNotNull(), F.last(f"__s{i}", ignorenulls=True).over(desc)) for i, c in enumerate(tracked)
    ]
    end = F.least(*ends) if len(ends) > 1 else ends[0]
    out = starts.select(key, *attrs, F.col(day).alias(START_COL), end.alias("__end"))
    return out.select(
        key, *attrs, START_COL,
        F.coalesce("__end", open_end()).alias(END_COL),
        F.col("__end").isNull().alias(CURRENT_COL),
    )


def build_history(daily: DataFrame, key: str, day: str, tracked: list[str], mode: str = CHANGED_ONLY,
                  attrs: list[str] | None = None) -> DataFrame:
    if mode == CHANGED_ONLY:
        return build(daily, key, day, tracked, attrs)
    if mode == APPEND_ALL:
        return build_append_all(daily, key, day, tracked, attrs)
    raise ValueError(f"unknown mode {mode!r}")


# ---------------------------------------------------------------------------
# One-day merge: expire (M1), insert (M2), merge (M3), fold (M4)
# ---------------------------------------------------------------------------

def staged_from_daily(daily: DataFrame, day: str) -> DataFrame:
    """Daily snapshot rows -> staging rows (start = day, open, current)."""
    return (
        daily.withColumnRenamed(day, START_COL)
        .withColumn(END_COL, open_end())
        .withColumn(CURRENT_COL, F.lit(True))
    )


def _guard_one_per_key(staged: DataFrame, key: str) -> DataFrame:
    """One row per key of a staging set; fail the job when a key has two.

    A grouped count with a map-side partial step: a key that arrives with a
    third of all staged rows is reduced per map task before the shuffle,
    instead of being gathered into one window task. The surviving row is the
    key's only row (any other outcome raises). The result is partitioned on
    the key, which the following join on the key reuses.
    """
    others = [c for c in staged.columns if c != key]
    g = staged.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.max(F.struct(*others)).alias("__r"))
    g = g.where(_fail_when(F.col("__n") > 1, F.concat(F.lit("two staged profiles for key "), F.col(key).cast("string"))))
    return g.select(*[F.col(key) if c == key else F.col(f"__r.{c}").alias(c) for c in staged.columns])


def _fail_when(cond: Column, message) -> Column:
    """A filter predicate that is always true but fails the task when `cond`
    holds; as a predicate it cannot be pruned away like an unused column."""
    msg = F.lit(message) if isinstance(message, str) else message
    return F.when(cond, F.raise_error(msg)).isNull()


def expire(target: DataFrame, staged: DataFrame, key: str, tracked: list[str], mode: str = CHANGED_ONLY,
           check_unique: bool = True) -> DataFrame:
    """Close current rows whose tracked attributes changed in `staged` (M1).

    Matched on key and `is_current`; the closed row gets
    `effective_end_date = staged.effective_start_date` and `is_current=false`.
    Keys absent from the stage stay open. A staged day older than an open
    version fails the job (use `apply_days` to merge late days), and so does a
    stage that holds a key twice.

    Closed rows pass through; open rows are read once and joined once. In a
    stored dimension the two are different files.
    """
    if check_unique:
        staged = _guard_one_per_key(staged, key)
    s = staged.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__s_{c}") for c in tracked], F.col(START_COL).alias("__s_start"))
    j = target.where(F.col(CURRENT_COL)).withColumn("__k", F.col(key)).join(s, "__k", "left")
    has = F.col("__s_start").isNotNull()
    chg = has & changed([F.col(c) for c in tracked], [F.col(f"__s_{c}") for c in tracked], mode)
    late = has & (F.col("__s_start") < F.col(START_COL))
    j = j.where(_fail_when(late, "staged day is older than the open version"))
    updated = j.select(*[
        F.when(chg, F.col("__s_start")).otherwise(F.col(END_COL)).alias(END_COL) if c == END_COL
        else F.when(chg, F.lit(False)).otherwise(F.col(CURRENT_COL)).alias(CURRENT_COL) if c == CURRENT_COL
        else F.col(c) for c in target.columns])
    return target.where(~F.col(CURRENT_COL)).unionByName(updated)


def insert_versions(target: DataFrame, staged: DataFrame, key: str | None = None, tracked: list[str] | None = None,
                    only_changed: bool = False) -> DataFrame:
    """Append staged rows to the target by column name.

    With `only_changed`, a staged row is inserted only when its key has no
    open row with the same tracked attributes (null-safe), i.e. new or
    changed keys; `target` must be the dimension *before* expiry then.
    """
    staged = staged.select(*target.columns)
    if not only_changed:
        return target.unionByName(staged)
    cur = target.where(F.col(CURRENT_COL)).select(
        key, F.lit(1).alias("__has"), *[F.col(c).alias(f"__t_{c}") for c in tracked])
    staged = _guard_one_per_key(staged, key)
    keep = F.col("__has").isNull() | null_safe_changed([F.col(f"__t_{c}") for c in tracked], [F.col(c) for c in tracked])
    new_or_changed = staged.join(cur, key, "left").where(keep).select(*target.columns)
    return target.unionByName(new_or_changed)


def merge_day(target: DataFrame, staged: DataFrame, key: str, tracked: list[str], mode: str = CHANGED_ONLY,
              check_unique: bool = True) -> DataFrame:
    """Merge one staged day into the dimension (M3).

    ``changed_only``: the open rows are read once and joined once, fully outer,
    to the stage; each joined row emits 0, 1 or 2 rows (kept, closed + new,
    new) via `explode(array_compact(array(old, new)))`. Closed rows pass
    through. Re-merging the same day is a no-op. A staged day older than
    the open version, or the same day with other values, fails the job: such
    deliveries go through `apply_days`, which rebuilds the touched keys from
    the kept daily snapshots.

    ``append_all``: expire under `<>`, then insert every staged row.
    """
    if check_unique:
        staged = _guard_one_per_key(staged, key)
    if mode == APPEND_ALL:
        return insert_versions(expire(target, staged, key, tracked, APPEND_ALL, check_unique=False), staged)
    if mode != CHANGED_ONLY:
        raise ValueError(f"unknown mode {mode!r}")

    cols = target.columns
    t = target.where(F.col(CURRENT_COL)).select(F.col(key).alias("__k"), F.struct(*cols).alias("__t"))
    s = staged.select(F.col(key).alias("__k"), F.struct(*[F.col(c) for c in cols]).alias("__s"))
    j = t.join(s, "__k", "full_outer")
    has_t, has_s = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    chg = changed([F.col(f"__t.{c}") for c in tracked], [F.col(f"__s.{c}") for c in tracked], CHANGED_ONLY)
    t_start, s_start = F.col(f"__t.{START_COL}"), F.col(f"__s.{START_COL}")
    late = has_t & has_s & ((s_start < t_start) | ((s_start == t_start) & chg))
    old_row = F.when(
        has_t & has_s & chg,
        F.struct(*[
            s_start.alias(END_COL) if c == END_COL else F.lit(False).alias(CURRENT_COL) if c == CURRENT_COL
            else F.col(f"__t.{c}").alias(c) for c in cols
        ]),
    ).when(has_t, F.col("__t"))
    new_row = F.when(has_s & (~has_t | chg), F.col("__s"))
    merged = j.select(
        F.when(late, F.raise_error(F.lit("late or re-delivered day with other values: use apply_days")))
        .otherwise(F.array_compact(F.array(old_row, new_row))).alias("__rows")
    ).select(F.explode("__rows").alias("__r")).select("__r.*")
    return target.where(~F.col(CURRENT_COL)).unionByName(merged)


def fold_days(target: DataFrame, daily: DataFrame, key: str, day: str, tracked: list[str],
              mode: str = CHANGED_ONLY, stepwise: bool = False, cut_every: int = 1) -> DataFrame:
    """Apply `merge_day` day after day in date order (M4).

    `daily` must hold one row per (key, day), as `latest_per_day` makes it.

    Default form: one plan, no loop, no join. When days are merged in ascending
    order every day comes after all versions the earlier days made, so the
    fold equals a build of the open rows, as snapshots of their start days,
    with the whole list; an open row without new days comes out as it went in.
    Closed rows pass through. The guard and the build share one exchange on
    the key. The per-day guard of `merge_day` is applied once, per (key, day), against
    the target's open rows: a day older than the open version (or, under
    `changed_only`, the same day with other values) fails the job; the same
    day with the same values is a no-op. Under `append_all` any day not
    after the open version fails (its stepwise result would be a zero-length
    interval or a duplicate open row); use `stepwise=True` to reproduce that.

    `stepwise=True` runs the literal loop, one merge per day (tests compare
    both forms): only the list of distinct days reaches the driver; only open
    rows are carried through the loop; each day's result is persisted and
    lineage is cut with a reliable `checkpoint()` every `cut_every` days.
    """
    if stepwise:
        return _fold_stepwise(target, daily, key, day, tracked, mode, cut_every)
    if mode not in (CHANGED_ONLY, APPEND_ALL):
        raise ValueError(f"unknown mode {mode!r}")
    attrs = [c for c in target.columns if c not in (key, START_COL, END_COL, CURRENT_COL)]
    opened = target.where(F.col(CURRENT_COL)).select(key, F.col(START_COL).alias(day), *attrs, F.lit(True).alias("__open"))
    both = opened.unionByName(daily.select(key, day, *attrs, F.lit(False).alias("__open")))
    # the key's latest open version, with its tracked values (append_all may have several open rows)
    latest = F.max(F.when(F.col("__open"), F.struct(F.col(day).alias("s"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tracked)])))
    both = both.withColumn("__o", latest.over(Window.partitionBy(key)))
    new = ~F.col("__open") & F.col("__o").isNotNull()
    same_vals = ~null_safe_changed([F.col(f"__o.t{i}") for i in range(len(tracked))], [F.col(c) for c in tracked])
    if mode == CHANGED_ONLY:
        bad = new & ((F.col(day) < F.col("__o.s")) | ((F.col(day) == F.col("__o.s")) & ~same_vals))
        noop = new & (F.col(day) == F.col("__o.s")) & same_vals
    else:
        bad = new & (F.col(day) <= F.col("__o.s"))
        noop = F.lit(False)
    guarded = both.where(_fail_when(bad, "late or re-delivered day with other values: use apply_days")).where(~noop)
    folded = build_history(guarded.select(key, day, *attrs), key, day, tracked, mode, attrs)
    return target.where(~F.col(CURRENT_COL)).unionByName(folded.select(*target.columns))


def _fold_stepwise(target: DataFrame, daily: DataFrame, key: str, day: str, tracked: list[str],
                   mode: str, cut_every: int) -> DataFrame:
    from chronoset.session import checkpoint_root

    spark = daily.sparkSession
    checkpoint_root(spark)
    # the staged days are read once per day: materialise them once
    daily = daily.checkpoint(eager=True)
    days = [r[0] for r in daily.select(day).distinct().orderBy(day).collect()]
    staged_all = staged_from_daily(daily, day)
    closed_parts = [target.where(~F.col(CURRENT_COL))]
    cur = target.where(F.col(CURRENT_COL))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = []
    for i, d in enumerate(days, 1):
        stg = staged_all.where(F.col(START_COL) == F.lit(d))
        merged = merge_day(cur, stg, key, tracked, mode, check_unique=False).coalesce(width)
        if cut_every and i % cut_every == 0:
            # persisted first, so writing the checkpoint does not recompute the day
            merged.persist()
            cut = merged.checkpoint(eager=True)
            for h in held + [merged]:
                h.unpersist()
            held, merged = [], cut
        else:
            merged = merged.persist()
            held.append(merged)
        closed_parts.append(merged.where(~F.col(CURRENT_COL)))
        cur = merged.where(F.col(CURRENT_COL))
    return reduce(DataFrame.unionByName, closed_parts + [cur])


def empty_dimension(daily: DataFrame, key: str, day: str) -> DataFrame:
    """An empty dimension with the columns a history of `daily` would have."""
    return staged_from_daily(daily, day).limit(0)


def apply_days(dimension: DataFrame, snapshots: DataFrame, batch: DataFrame, key: str, day: str,
               tracked: list[str], mode: str = CHANGED_ONLY) -> DataFrame:
    """Merge a batch of daily snapshots in any arrival order.

    `snapshots` is the kept table of daily snapshots *including* the batch
    (one row per key and day). Keys present in the batch are rebuilt from
    their full kept history; other keys keep their stored versions. The
    result equals a full `build` whatever order days arrive in; only the
    touched keys are shuffled through the history windows.
    """
    keys = batch.select(key).distinct()
    touched_history = snapshots.join(keys, key, "left_semi")
    rebuilt = build_history(touched_history, key, day, tracked, mode)
    kept = dimension.join(keys, key, "left_anti")
    return kept.unionByName(rebuilt.select(*kept.columns))


def extend_open_parts(current_rows: DataFrame, batch: DataFrame, key: str, day: str, tracked: list[str],
                      mode: str = CHANGED_ONLY) -> tuple[DataFrame, DataFrame]:
    """`extend_open` from the open rows alone: (rebuilt rows, untouched open rows).

    The rebuilt rows are the touched keys' replayed histories, closed and open
    together (one plan, computed once); the untouched rows are the open rows
    of every other key. Closed versions are final, so they are neither read
    nor rewritten: a versioned store appends the rebuilt closed rows and
    replaces only the open set.
    """
    attrs = [c for c in current_rows.columns if c not in (key, START_COL, END_COL, CURRENT_COL)]
    keys = batch.select(key).distinct()
    seeds = current_rows.join(keys, key, "left_semi").select(key, F.col(START_COL).alias(day), *attrs)
    hist = build_history(seeds.unionByName(batch.select(key, day, *attrs)), key, day, tracked, mode, attrs)
    return hist.select(*current_rows.columns), current_rows.join(keys, key, "left_anti")


def extend_open(dimension: DataFrame, batch: DataFrame, key: str, day: str, tracked: list[str],
                mode: str = CHANGED_ONLY) -> DataFrame:
    """Merge a batch whose days all come after every stored day (fast path).

    Closed versions are final, so only the open rows of the batch's keys can
    change: each open row is replayed as a snapshot on its start day, followed
    by the batch rows, and that short history is rebuilt. Exact in both modes
    because a version's end only depends on later rows. Closed rows and open
    rows of other keys pass through; the split is a semi / anti join on the
    batch keys (broadcast when Spark measures the key set as small).
    """
    rebuilt, untouched = extend_open_parts(dimension.where(F.col(CURRENT_COL)), batch, key, day, tracked, mode)
    return dimension.where(~F.col(CURRENT_COL)).unionByName(untouched).unionByName(rebuilt)


# ---------------------------------------------------------------------------
# Reading a dimension
# ---------------------------------------------------------------------------

def current(dimension: DataFrame) -> DataFrame:
    """Open versions only (S3/F1); a partition filter when `is_current` is a partition column."""
    return dimension.where(F.col(CURRENT_COL))


def changed_columns(dimension: DataFrame, key: str, tracked: list[str], name: str = "changed_columns") -> DataFrame:
    """Per version, the tracked columns that differ from the key's previous version (M9).

    Result column is the comma-joined list of names in `tracked` order; the
    first version lists its non-null tracked columns.
    """
    w = Window.partitionBy(key).orderBy(START_COL)
    names = F.array_compact(F.array(*[
        F.when(~F.lag(c).over(w).eqNullSafe(F.col(c)), F.lit(c)) for c in tracked
    ]))
    return dimension.select(key, START_COL, F.array_join(names, ",").alias(name))


def changed_rows(current_rows: DataFrame, staged: DataFrame, key, tracked: list[str]) -> DataFrame:
    """Staged rows joined to the open row of their key with both change flags.

    `key` is a column name or a list of them. `changed_null_safe` is the
    default rule; `changed_three_valued` is the original `<>` rule (NULL on
    either side is not a change).
    """
    keys = [key] if isinstance(key, str) else list(key)
    t = current_rows.select(*keys, *[F.col(c).alias(f"__t_{c}") for c in tracked])
    j = staged.join(t, keys, "inner")
    prev = [F.col(f"__t_{c}") for c in tracked]
    cur = [F.col(c) for c in tracked]
    return j.select(
        *staged.columns,
        changed(prev, cur, CHANGED_ONLY).alias("changed_null_safe"),
        changed(prev, cur, APPEND_ALL).alias("changed_three_valued"),
    )
