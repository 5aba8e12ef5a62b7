"""Data-quality expectations (Q1-Q6): named SQL predicates applied to a DataFrame.

A row passes a rule only if the predicate is TRUE (NULL counts as a failure).  All forms
work on batch and streaming DataFrames:

* ``expect_or_drop``  - keep passing rows (Q1, Q4)
* ``expect_or_fail``  - stop the query at the first failing row (Q2, ``raise_error`` in the plan)
* ``expect``          - keep every row, count failures per rule (Q3, ``observe``)
* ``quarantine``      - failing rows with the names of the rules they failed (Q6)
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str | Column]


def _pred(p: str | Column) -> Column:
    return F.coalesce(F.expr(p) if isinstance(p, str) else p, F.lit(False))


def passes_all(rules: Rules) -> Column:
    cond = F.lit(True)
    for p in rules.values():
        cond = cond & _pred(p)
    return cond


def failed_rules(rules: Rules) -> Column:
    """array<string> of the names of the rules the row fails."""
    arr = F.array(*[F.when(~_pred(p), F.lit(name)) for name, p in rules.items()])
    return F.filter(arr, lambda x: x.isNotNull())


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(passes_all(rules))


def expect_or_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows pass through unchanged; the first failing row raises in the executor and the
    (batch or streaming) query fails with the rule names."""
    names = F.array_join(failed_rules(rules), ",")
    check = F.when(~passes_all(rules), F.raise_error(F.concat(F.lit("expectation failed: "), names)))
    return df.select("*", check.alias("_expect_check")).filter(F.col("_expect_check").isNull()).drop("_expect_check")


def expect(df: DataFrame, rules: Rules, name: str = "expectations") -> tuple[DataFrame, Observation | None]:
    """Keep all rows; the returned Observation holds ``rows`` and ``failed_<rule>`` counts
    once an action has run. A stream reports them in its progress under ``name`` (``StreamCounts``)."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.sum(F.when(~_pred(p), 1).otherwise(0)).alias(f"failed_{r}") for r, p in rules.items()]
    if df.isStreaming:
        return df.observe(name, *metrics), None
    obs = Observation(name)
    return df.observe(obs, *metrics), obs


class StreamCounts:
    """Counts that a finished streaming query observed, summed over its batches (``get``, like an Observation)."""

    def __init__(self, query, name: str):
        self.get: dict[str, int] = {}
        for progress in query.recentProgress:
            seen = progress["observedMetrics"] if isinstance(progress, dict) else progress.observedMetrics
            row = seen.get(name)
            for k, v in ((row if isinstance(row, dict) else row.asDict()) if row is not None else {}).items():
                self.get[k] = self.get.get(k, 0) + int(v or 0)


def expectation_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One-row DataFrame: rows, failed_<rule> per rule, dropped (rows failing any rule)."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.sum(F.when(~_pred(p), 1).otherwise(0)).cast("long").alias(f"failed_{r}") for r, p in rules.items()]
    aggs.append(F.sum(F.when(~passes_all(rules), 1).otherwise(0)).cast("long").alias("dropped"))
    return df.agg(*aggs)


def quarantine(df: DataFrame, rules: Rules, column: str = "failed_rules") -> DataFrame:
    return df.withColumn(column, failed_rules(rules)).filter(F.size(F.col(column)) > 0)


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(passing rows, quarantined rows with failed rule names)."""
    return expect_or_drop(df, rules), quarantine(df, rules)
