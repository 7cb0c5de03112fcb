"""Checks of a model run in small tasks."""

from tradewind.plans import validate


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_constraints_are_found_in_small_tasks(spark, small, monkeypatch):
    seen = []
    real = validate.small_tasks
    monkeypatch.setattr(validate, "small_tasks", lambda *a, **k: seen.append(k) or real(*a, **k))
    verdicts = validate.constraints(small)
    assert seen and seen[0]["task_bytes"] <= 4 << 20
    assert "FileScan" not in _plan(verdicts)  # nothing is left to run in tasks of the session's size
    assert verdicts.count() == 78
