"""The whole run: raw files to landed text, staging, model, checks and reports."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators import ledger, quality, reconcile
from tradewind.operators.audit import decision_log
from tradewind.plans import prepare, profile, validate
from tradewind.plans.warehouse import DIMENSIONS, FACTS, ChecksFailed, Warehouse
from tradewind.sources.files import scan_catalog, write_table
from tradewind.sources.schemas import STAGING_TYPES
from tradewind.sources.versions import Versions


def land(spark: SparkSession, folder: str, out: str, names: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Parse the raw files once and keep them as Parquet text columns.

    Profiling, cleaning, audit and reconciliation all read the raw entities; parsing
    delimited text again for each of them would dominate the run.
    """
    return {e: write_table(df, f"{out}/raw/{e}") for e, df in scan_catalog(spark, folder, names).items()}


def profile_reports(wh: Warehouse) -> dict[str, DataFrame]:
    return {
        "profile_columns": profile.column_report(wh.raw),
        "profile_duplicates": profile.duplicate_report(wh.raw),
        "profile_keys": profile.key_report(wh.raw, [*profile.SINGLE_KEYS, *profile.COMPOSITE_KEYS]),
        "profile_orphans": profile.relation_report(wh.raw, profile.ORPHANS),
        "profile_coverage": profile.relation_report(wh.raw, profile.COVERAGE),
        "profile_dates": profile.date_report(wh.raw),
        "profile_status": profile.status_report(wh.raw),
    }


def load_reports(wh: Warehouse) -> dict[str, DataFrame]:
    audit = prepare.cleaning_audit(wh.raw, wh.staged)
    staged = {f"stg_{e}": wh.staged(e) for e in STAGING_TYPES}
    return {
        "cleaning_audit": audit,
        "decision_log": decision_log(audit),
        "staging_counts": quality.with_total(quality.row_counts(staged)),
        "model_counts": quality.row_counts({t: wh.table(t) for t in DIMENSIONS + FACTS}),
    }


def check_reports(wh: Warehouse) -> dict[str, DataFrame]:
    return {
        "check_row_counts": validate.row_counts(wh),
        "check_money_totals": validate.money_totals(wh),
        "check_grain": validate.grain(wh),
        "check_identity": validate.identity(wh),
        "check_fanout": validate.fanout(wh),
        "check_constraints": validate.constraints(wh),
        "reconciliation": validate.reconciliation(wh),
    }


CHECKS = ("check_row_counts", "check_money_totals", "check_grain", "check_constraints", "reconciliation")


def failures(spark: SparkSession, folder: str) -> list[str]:
    """Names of the checks stored with a version that did not pass."""
    failed = []
    for name in CHECKS[:-1]:
        if not spark.read.parquet(f"{folder}/reports/{name}").filter(~F.col("passed")).isEmpty():
            failed.append(name)
    result = spark.read.parquet(f"{folder}/reports/{CHECKS[-1]}")
    if reconcile.overall(result).filter("reconciled").isEmpty():
        failed.append(CHECKS[-1])
    return failed


def failed_checks(wh: Warehouse, accept: Collection[str] = ()) -> list[str]:
    """Write the check reports next to a model and name those that did not pass."""
    for name, report in check_reports(wh).items():
        write_table(report, f"{wh.model_root}/reports/{name}")
    return [c for c in failures(wh.spark, wh.model_root) if c not in accept]


def run(
    spark: SparkSession,
    folder: str,
    out: str,
    names: Mapping[str, str] | None = None,
    allow_lost_values: bool = False,
    accept: Collection[str] = (),
) -> Warehouse:
    """Build a version of everything below ``out``, check it, and make it the current one.

    Each run writes raw text, staging, model, ledger and reports to a folder of its own. It stops
    without publishing, with the reports written, on

    - a value that does not fit its declared type or a required one that is missing, unless
      ``allow_lost_values`` says that nulls in their place are wanted, and
    - a check that does not pass, unless ``accept`` names it.

    So ``Warehouse.open`` sees the last version that was whole and right, whatever happened since.
    """
    versions = Versions(spark, out)
    home = versions.new_folder()
    wh = Warehouse(spark, land(spark, folder, home, names).__getitem__, home)
    lost = ledger.summary(wh.ledger.filter("stops"))
    write_table(lost, f"{home}/reports/lost_values")
    # Without required values there is no model worth checking: stop before it is built.
    if not allow_lost_values and (found := spark.read.parquet(f"{home}/reports/lost_values").limit(20).collect()):
        write_table(prepare.cleaning_audit(wh.raw, wh.staged), f"{home}/reports/cleaning_audit")
        said = [f"{r.entity}.{r.column_name} {r.reason}: {r.cells} cells, such as {r.first_value!r}" for r in found]
        raise ChecksFailed(["values lost in typing", *said])
    wh.build()
    for name, report in (profile_reports(wh) | load_reports(wh)).items():
        write_table(report, f"{home}/reports/{name}")
    if failed := failed_checks(wh, accept):
        raise ChecksFailed(failed)
    versions.publish({"staging": home, "model": home})
    return wh


def rebuild(wh: Warehouse, out: str, accept: Collection[str] = ()) -> None:
    """Build the model of a version anew; it replaces the current one when its checks pass."""
    wh.rebuild_model(lambda new: failed_checks(new, accept), Versions(wh.spark, out))
