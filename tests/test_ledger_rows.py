"""The ledger makes cells of rows with a loss only."""

from tradewind.operators import ledger


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_losses_are_dropped_before_cells_are_made(frame):
    raw = frame("k string, n string, t string", [("1", "5", "2017-01-01"), ("2", "x", "soon"), (None, "7", None)])
    lost = ledger.lost_cells(raw, "e", {"k": "string", "n": "int", "t": "timestamp_ntz"}, ["k"], ["k"])
    assert {(r.column_name, r.reason, r.value) for r in lost.collect()} == {
        ("n", "not int", "x"), ("t", "not timestamp_ntz", "soon"), ("k", "missing", None),
    }
    plan = _plan(lost)
    assert all("array(" not in line for line in plan.splitlines() if "Filter" in line)  # cells are not made twice
    assert "CASE WHEN ((CASE WHEN" in plan.replace("(((", "((")  # and only where some value is lost
