"""Reconciliation of the same metrics over several stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.profiling import union_all


def metric_rows(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Several aggregates of one table as rows (metric, value), computed in one pass."""
    wide = df.agg(*[F.coalesce(c.cast("decimal(22,2)"), F.lit(0)).alias(f"m{i}") for i, c in enumerate(metrics.values())])
    rows = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(f"m{i}").cast("decimal(22,2)").alias("value")) for i, m in enumerate(metrics)]
    )
    return wide.select(F.inline(rows))


def stage_metrics(tables: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    return union_all([metric_rows(df, metrics) for df, metrics in tables.values()])


def reconcile(stages: Mapping[str, DataFrame], explanations: Mapping[str, str]) -> DataFrame:
    """Metrics side by side with a status.

    All stages equal: ``Match``. Only the first differs and the difference is
    explained: ``Expected``. Anything else: ``MISMATCH``. Each stage is a handful of
    (metric, value) rows by the time they meet.
    """
    names = list(stages)
    long = union_all([df.withColumn("_stage", F.lit(s)) for s, df in stages.items()])
    wide = long.groupBy("metric").agg(
        *[F.max(F.when(F.col("_stage") == s, F.col("value"))).alias(s) for s in names]
    )
    explanation = F.lit(None).cast("string")
    for metric, text in explanations.items():
        explanation = F.when(F.col("metric") == metric, F.lit(text)).otherwise(explanation)

    def agree(columns: Sequence[str]) -> Column:
        same = F.lit(True)
        for c in columns[1:]:
            same = same & (F.col(columns[0]) == F.col(c))
        return F.coalesce(same, F.lit(False))

    status = (
        F.when(agree(names), "Match")
        .when(agree(names[1:]) & explanation.isNotNull(), "Expected")
        .otherwise("MISMATCH")
    )
    return wide.select(
        "metric",
        *names,
        status.alias("status"),
        (F.col(names[0]) - F.col(names[1])).alias("difference"),
        F.when(status == "Expected", explanation).alias("explanation"),
    )


def overall(result: DataFrame) -> DataFrame:
    return result.agg(
        F.count(F.lit(1)).alias("metrics"),
        F.count_if(F.col("status") == "Match").alias("matching"),
        F.count_if(F.col("status") == "Expected").alias("expected"),
        F.count_if(F.col("status") == "MISMATCH").alias("mismatching"),
        F.coalesce(F.bool_and(F.col("status") != "MISMATCH"), F.lit(True)).alias("reconciled"),
    )


def render_markdown(result: DataFrame, title: str = "Reconciliation") -> str:
    """The report as text. ``result`` has one row per metric, so collecting it is safe."""
    rows = result.orderBy("metric").collect()
    stages = [c for c in result.columns if c not in ("metric", "status", "difference", "explanation")]

    def number(value) -> str:
        return "" if value is None else (f"{value:,.2f}" if value != int(value) else f"{int(value):,}")

    lines = [f"# {title}", "", "| Metric | " + " | ".join(stages) + " | Status |"]
    lines.append("|---|" + "---:|" * len(stages) + "---|")
    lines += [f"| {r.metric} | " + " | ".join(number(r[s]) for s in stages) + f" | {r.status} |" for r in rows]
    explained = [r for r in rows if r.status == "Expected"]
    if explained:
        lines += ["", "## Explained differences", ""]
        lines += [f"- {r.metric} ({number(r.difference)}): {r.explanation}" for r in explained]
    failed = [r.metric for r in rows if r.status == "MISMATCH"]
    lines += ["", "Not reconciled: " + ", ".join(failed) if failed else "All metrics reconcile."]
    return "\n".join(lines) + "\n"
