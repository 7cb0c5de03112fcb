"""Ledger of the values that typing cannot keep: one row per cell, from one pass over the raw text."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import parse_timestamp

TIMESTAMP = "timestamp_ntz"
MISSING = "missing"


def parsed(name: str, kind: str) -> Column:
    """The value as staging keeps it: null where the text does not fit, with or without ANSI mode."""
    if kind == TIMESTAMP:
        return parse_timestamp(F.col(name).cast("string"))
    return F.col(name).try_cast(kind)


def reason(name: str, kind: str, required: bool) -> Column:
    """Why a cell is lost, null for one that is kept.

    A required cell is lost as ``missing`` if it is empty; any other empty cell is kept as null.
    """
    lost = F.when(F.col(name).isNotNull() & parsed(name, kind).isNull(), F.lit(f"not {kind}"))
    return lost.when(F.col(name).isNull(), F.lit(MISSING)) if required else lost


def stops(kind: str, required: bool) -> bool:
    """Whether a lost cell stops a run. An optional date that is none is set to null by a rule of the cleaning."""
    return required or kind != TIMESTAMP


def _checked(types: Mapping[str, str], required: Collection[str]) -> dict[str, str]:
    return {c: kind for c, kind in types.items() if kind != "string" or c in required}


def lost_rows(types: Mapping[str, str], required: Collection[str], only: str | None = None) -> Column:
    """Condition on rows with a lost cell that stops a run; ``only`` 'missing' or 'unfit' looks at one kind."""
    found = F.lit(False)
    for c, kind in _checked(types, required).items():
        why = reason(c, kind, c in required)
        if not stops(kind, c in required):
            continue
        if only == "missing":
            why = F.when(why == MISSING, why)
        elif only == "unfit":
            why = F.when(why != MISSING, why)
        found = found | why.isNotNull()
    return found


def lost_cells(
    raw: DataFrame, entity: str, types: Mapping[str, str], required: Collection[str], keys: Sequence[str]
) -> DataFrame:
    """One row per lost cell: entity, column, declared type, reason, text, the row's keys, and whether it stops a run.

    All columns are checked in one pass. Rows with a lost cell are picked first, and only these are
    written out by cell, so the cost of that and the table grow with the faults and not with the data. Rows are told apart by ``keys`` as JSON.
    """
    key = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]), {"ignoreNullFields": "false"})
    checked = _checked(types, required)
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kind).alias("declared"),
            reason(c, kind, c in required).alias("reason"),
            F.col(c).cast("string").alias("value"),
            F.lit(stops(kind, c in required)).alias("stops"),
        )
        for c, kind in checked.items()
    ]
    any_lost = reduce(Column.__or__, [reason(c, kind, c in required).isNotNull() for c, kind in checked.items()], F.lit(False))
    lost = F.filter(F.array(*cells), lambda cell: cell["reason"].isNotNull())
    # An outer inline: a filter on the cells would move into the reader and parse what is no record yet.
    rows = raw.select(key.alias("row_key"), F.when(any_lost, lost).alias("cells"))
    return rows.select(F.lit(entity).alias("entity"), "row_key", F.inline_outer("cells")).filter("column_name IS NOT NULL")


def summary(ledger: DataFrame) -> DataFrame:
    """Lost cells by entity, column and reason, with the smallest and largest text as examples."""
    return ledger.groupBy("entity", "column_name", "declared", "reason", "stops").agg(
        F.count(F.lit(1)).alias("cells"), F.min("value").alias("first_value"), F.max("value").alias("last_value")
    )
