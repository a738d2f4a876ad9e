"""Data quality: named rules evaluated in one aggregate pass (Q1-Q6).

A rule is an aggregate metric plus a pass condition. All rules of a suite
become the columns of a single `agg` (or a `DataFrame.observe`, so they ride
along with a write and cost no extra scan); the one-row result is unpivoted
into a table of (rule, column, metric, status).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chronoset.functions.scalar import amount_class, amount_decimal

SUCCESS, FAILURE = "Success", "Failure"


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    metric: Column            # aggregate expression, cast to double
    passes: Callable[[Column], Column]


def has_size(pred: Callable[[Column], Column] = lambda n: n > 0, name: str = "non_empty") -> Rule:
    """Row count rule (A1); default `size > 0`."""
    return Rule(name, "*", F.count(F.lit(1)).cast("double"), pred)


def is_complete(column: str, name: str | None = None) -> Rule:
    """Completeness = 1.0 (A2): share of non-null values."""
    metric = F.when(F.count(F.lit(1)) == 0, F.lit(1.0)).otherwise(
        F.count(F.col(column)).cast("double") / F.count(F.lit(1)))
    return Rule(name or f"{column}_not_null", column, metric, lambda m: m >= 1.0)


def dated_as_file(row_date: str, file_date: str, least: float = 1.0) -> Rule:
    """Share of rows whose date is that of their file; rows of boundary hours may belong to the day before."""
    same = F.count_if(F.col(row_date) == F.col(file_date)).cast("double")
    metric = F.when(F.count(F.lit(1)) == 0, F.lit(1.0)).otherwise(same / F.count(F.lit(1)))
    return Rule("dated_as_file", row_date, metric, lambda m: m >= least)


def default_rules(id_col: str = "transaction_id", key_col: str = "customer_id") -> list[Rule]:
    """The loader's suite: non-empty, id complete, key complete."""
    return [has_size(), is_complete(id_col, f"{id_col}_not_null"), is_complete(key_col, f"{key_col}_not_null")]


def _metric_row_exprs(rules: list[Rule]) -> list[Column]:
    return [r.metric.alias(f"m{i}") for i, r in enumerate(rules)]


def results_from_row(df_one_row: DataFrame, rules: list[Rule]) -> DataFrame:
    """Unpivot the one-row metric frame into the results table (Q2)."""
    rows = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.column).alias("column"),
            F.col(f"m{i}").alias("metric"),
            F.when(r.passes(F.col(f"m{i}")), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("status"),
        )
        for i, r in enumerate(rules)
    ]
    return df_one_row.select(F.inline(F.array(*rows)))


def run_checks(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rules in one aggregate pass; one row per rule (Q1 + Q2)."""
    return results_from_row(df.agg(*_metric_row_exprs(rules)), rules)


class CheckFailed(ValueError):
    pass


def gate(df: DataFrame, rules: list[Rule], on_fail: str = "raise") -> tuple[bool, list]:
    """Evaluate the suite and act on the overall status (Q3).

    Only the handful of result rows reach the driver. `on_fail="raise"` stops
    the job with `CheckFailed`; `"skip"` returns (False, results) so the
    caller leaves the input pending.
    """
    results = run_checks(df, rules).collect()
    ok = all(r["status"] == SUCCESS for r in results)
    if not ok and on_fail == "raise":
        bad = ", ".join(f"{r['rule']}={r['metric']}" for r in results if r["status"] != SUCCESS)
        raise CheckFailed(f"data quality checks failed: {bad}")
    return ok, results


def observed(df: DataFrame, rules: list[Rule], name: str = "dq") -> tuple[DataFrame, Observation]:
    """Attach the suite as an Observation: metrics are computed by the next
    action on the returned frame (e.g. the fact write) with no extra scan."""
    obs = Observation(name)
    return df.observe(obs, *_metric_row_exprs(rules)), obs


def observation_results(obs: Observation, rules: list[Rule]) -> list[dict]:
    vals = obs.get
    out = []
    for i, r in enumerate(rules):
        m = vals.get(f"m{i}")
        out.append({"rule": r.name, "column": r.column, "metric": m})
    return out


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: number of NULLs and whether there are none."""
    columns = columns or df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").cast("long").alias("null_count"),
                 (F.col(f"n{i}") == 0).alias("no_nulls"))
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*rows)))


# Target types whose text form always holds a decimal digit.
_DIGIT_TYPES = ("tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte", "decimal", "numeric",
                "date", "timestamp", "timestamp_ntz")


def converts(txt: Column, target: str) -> Column:
    """`try_cast(txt AS target)`, skipping texts that cannot convert.

    A failing text-to-integer parse is costly per row; text without any
    decimal digit (Unicode class Nd: the decimal parser accepts non-ASCII
    digits) never converts to an integral, decimal, date or timestamp type,
    so it is answered NULL without parsing. Same result as `try_cast`.
    """
    parsed = txt.try_cast(target)
    if target.split("(")[0].strip().lower() in _DIGIT_TYPES:
        return F.when(txt.rlike(r"\p{Nd}"), parsed)
    return parsed


def column_conformance(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """Type conformance report (Q5 re-aimed).

    For each column and target type: non-null values and values whose text
    does not convert (`try_cast` gives NULL). One aggregate pass.
    """
    items = list(targets.items())
    aggs = []
    for i, (c, t) in enumerate(items):
        txt = F.col(c).cast("string")
        aggs += [F.count(txt).alias(f"a{i}"), F.count_if(txt.isNotNull() & converts(txt, t).isNull()).alias(f"b{i}")]
    one = df.agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("target_type"),
                 F.col(f"a{i}").cast("long").alias("n_non_null"), F.col(f"b{i}").cast("long").alias("n_nonconforming"))
        for i, (c, t) in enumerate(items)
    ]
    return one.select(F.inline(F.array(*rows)))


def amount_classes(df: DataFrame, amount_col: str = "amount") -> DataFrame:
    """Counts and totals per amount fault class."""
    return (
        df.select(amount_class(F.col(amount_col)).alias("amount_class"),
                  amount_decimal(F.col(amount_col)).alias("__num"))
        .groupBy("amount_class")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("__num").cast("decimal(38,2)").cast("double").alias("total"))
    )


def quarantine_split(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) by a rule predicate; NULL predicate counts as good."""
    flag = F.coalesce(bad, F.lit(False))
    return df.where(~flag), df.where(flag)
