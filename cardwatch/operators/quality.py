"""Row expectations: data-quality predicates on a table's output rows.

An expectation is a SQL predicate with an action: ``drop`` keeps a row only
when the predicate is true (NULL drops too), ``warn`` keeps every row and
counts the failures.  Failure counts are taken with ``DataFrame.observe``
over the rows *before* any drop, one metric per expectation, so each count
is over all input rows whether or not another expectation dropped the row.
``observe`` works on streams too: every micro-batch reports its counts in
``StreamingQueryProgress.observedMetrics``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DROP = "drop"
WARN = "warn"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = WARN

    def __post_init__(self):
        if self.action not in (DROP, WARN):
            raise ValueError(f"unknown expectation action {self.action!r}")

    def holds(self) -> Column:
        """True when the row meets the expectation; NULL counts as not met."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def expect_or_drop(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, DROP)


def expect(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, WARN)


def failure_counts(expectations: list[Expectation]) -> list[Column]:
    """Aggregate columns: input rows, then failures per expectation."""
    return [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(~e.holds()).alias(e.name) for e in expectations]


def apply_expectations(df: DataFrame, expectations: list[Expectation],
                       observation: str | Observation = "expectations") -> DataFrame:
    """Count failures of every expectation, then drop rows failing a ``drop`` one.

    ``observation`` is the metric name for streams or an ``Observation`` to
    read after a batch action.
    """
    observed = df.observe(observation, *failure_counts(expectations))
    drops = [e.holds() for e in expectations if e.action == DROP]
    if not drops:
        return observed
    return observed.filter(reduce(lambda a, b: a & b, drops))


def expectation_report(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """One row per expectation: name, action, failed rows, input rows.

    A single distributed aggregate (partial counts per task, one row to the
    final stage), then unpivoted to a row per expectation.
    """
    counts = df.agg(*failure_counts(expectations))
    rows = [F.struct(F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action"),
                     F.col(e.name).alias("failed_rows"), F.col("rows").alias("total_rows"))
            for e in expectations]
    return counts.select(F.inline(F.array(*rows)))


def metrics_from_progress(progress: list, name: str = "expectations") -> dict[str, int]:
    """Sum one observation's counts over the micro-batches of a run."""
    totals: dict[str, int] = {}
    for p in progress:
        metrics = p.observedMetrics.get(name) if hasattr(p, "observedMetrics") else \
            p.get("observedMetrics", {}).get(name)
        if metrics is None:
            continue
        for key, value in metrics.asDict().items() if hasattr(metrics, "asDict") else metrics.items():
            totals[key] = totals.get(key, 0) + int(value)
    return totals


def observed_expectations(table, expectations: list[Expectation], source: str):
    """A ``foreachBatch`` handler that commits a micro-batch's rows to a ledger together with its failure counts."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = Observation()
        rows = apply_expectations(batch, expectations, counts)
        table.on(batch.sparkSession).append(rows, source, batch_id,
                                            lambda: {name: int(n) for name, n in counts.get.items()})
    return handle
