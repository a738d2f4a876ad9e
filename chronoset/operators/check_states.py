"""Mergeable states of quality checks (Q1, Q2, A1-A3 without reading twice).

Every delivered file leaves one row of partial states: its row count and, per
column, NULL count, least and greatest value, a distinct-count sketch (HLL)
and a quantile sketch (KLL), all built into Spark. The checks of any range of
days are the merged states of its files: counts add up exactly, sketches merge
within their error. A file delivered again replaces its row, so neither the
file nor its neighbours are read again. The state table has a row per file
and delivery, whatever the files hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoset.operators.quality import Rule, results_from_row
from chronoset.sinks.writers import list_dirs

FILE, DAY, NUMBER = "file_name", "file_date", "number"
#: Kinds of states and how two of them become one.
STATES = {"nulls": F.sum, "lo": F.min, "hi": F.max, "hll": F.hll_union_agg, "kll": F.kll_merge_agg_double}


class CheckStates:
    """States below `path` of the columns named: `counted` for NULLs, `distinct` and `ranged` (numbers) for sketches."""

    def __init__(self, spark: SparkSession, path: str, counted: list[str], distinct: list[str] = (), ranged: list[str] = ()):
        self.spark, self.path = spark, path.rstrip("/")
        self.counted, self.distinct, self.ranged = list(counted), list(distinct), list(ranged)

    def _columns(self) -> list[tuple[str, str]]:
        return ([("nulls", c) for c in self.counted] + [(k, c) for c in self.ranged for k in ("lo", "hi", "kll")]
                + [("hll", c) for c in self.distinct])

    def add(self, rows: DataFrame) -> None:
        """States of the files that `rows` (with file_name and file_date) come from: one grouped aggregate, combined map-side.

        Adding is one write under the next number; of a file added twice the
        last states count.
        """
        made = {
            "nulls": lambda c: F.count_if(F.col(c).isNull()), "lo": lambda c: F.min(F.col(c).cast("double")),
            "hi": lambda c: F.max(F.col(c).cast("double")), "hll": lambda c: F.hll_sketch_agg(F.col(c).cast("string")),
            "kll": lambda c: F.kll_sketch_agg_double(F.col(c).cast("double"))}
        states = rows.groupBy(FILE, DAY).agg(F.count(F.lit(1)).alias("n"), *[made[k](c).alias(f"{k}_{c}") for k, c in self._columns()])
        done = [int(x.split("=", 1)[1]) for x in list_dirs(self.spark, self.path)]
        states.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/{NUMBER}={max(done, default=0) + 1}")

    def files(self, first=None, last=None) -> DataFrame:
        """The states that count, one row per file, of a range of days."""
        rows = self.spark.read.parquet(self.path)
        if first is not None:
            rows = rows.where(F.col(DAY) >= F.lit(first))
        if last is not None:
            rows = rows.where(F.col(DAY) <= F.lit(last))
        cols = [c for c in rows.columns if c not in (FILE, NUMBER)]
        best = rows.groupBy(FILE).agg(F.max_by(F.struct(*cols), NUMBER).alias("r"))
        return best.select(FILE, "r.*")

    def merged(self, first=None, last=None) -> DataFrame:
        """One row of merged states."""
        merge = [STATES[k](f"{k}_{c}").alias(f"{k}_{c}") for k, c in self._columns()]
        return self.files(first, last).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *merge)

    def run_checks(self, rules: list[Rule], first=None, last=None) -> DataFrame:
        """Size and completeness rules of a range, as `quality.run_checks` gives them for its rows."""
        known = {("non_empty", "*"): F.col("n").cast("double")}
        for c in self.counted:
            known[(f"{c}_not_null", c)] = F.when(F.col("n") == 0, F.lit(1.0)).otherwise((F.col("n") - F.col(f"nulls_{c}")).cast("double") / F.col("n"))
        missing = [r.name for r in rules if (r.name, r.column) not in known]
        if missing:
            raise ValueError(f"no states for {missing}")
        one = self.merged(first, last).select(*[known[r.name, r.column].alias(f"m{i}") for i, r in enumerate(rules)])
        return results_from_row(one, rules)

    def profile(self, first=None, last=None, quantiles: tuple[float, ...] = (0.5, 0.99)) -> DataFrame:
        """Per column with sketches: distinct values (estimate), least and greatest value, quantiles (estimates)."""
        merged = self.merged(first, last)
        none = F.lit(None).cast("double")

        def row(c: str) -> Column:
            q = [F.kll_sketch_get_quantile_double(f"kll_{c}", F.lit(x)) if c in self.ranged else none for x in quantiles]
            return F.struct(F.lit(c).alias("column"), (F.hll_sketch_estimate(f"hll_{c}") if c in self.distinct else F.lit(None).cast("long")).alias("n_distinct"),
                            *[(F.col(f"{k}_{c}") if c in self.ranged else none).alias(k) for k in ("lo", "hi")],
                            *[v.alias(f"q{x}") for x, v in zip(quantiles, q, strict=True)])

        return merged.select(F.inline(F.array(*[row(c) for c in dict.fromkeys([*self.distinct, *self.ranged])])))
