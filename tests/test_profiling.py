from conftest import rows
from tradewind.operators import profiling as P


def test_column_profile(frame):
    df = frame("a int, `b c` string", [(1, None), (None, None), (3, "x")])
    assert rows(P.profile_table(df, "t")) == [("t", 1, "a", "int", 3, 2, 1), ("t", 2, "b c", "string", 3, 2, 2)]


def test_duplicate_rows_treat_nulls_as_equal(frame):
    df = frame("a int, b string", [(1, None), (1, None), (1, "x"), (None, None), (None, None), (None, None)])
    assert rows(P.duplicate_rows(df, "t")) == [("t", 6, 3)]
    assert rows(P.duplicate_rows(df.limit(0), "t")) == [("t", 0, 0)]


def test_key_profile_counts_null_as_a_value(frame):
    df = frame("a int, b int", [(1, 1), (1, 2), (1, None), (1, None), (None, 1)])
    assert rows(P.key_profile(df, ["a", "b"], "t")) == [("t", "a + b", 5, 4, 1, 3, False)]
    single = frame("a int", [(1,), (2,), (None,)])
    assert rows(P.key_profile(single, ["a"], "t")) == [("t", "a", 3, 3, 0, 1, True)]
    assert rows(P.key_profile(single.union(single.filter("a is null")), ["a"], "t"))[0][-1] is False


def test_distinct_count_leaves_nulls_out(frame):
    df = frame("a int, b int", [(1, None), (1, 2), (None, 3)])
    assert rows(P.distinct_count(df, ["a", "b"], "t")) == [("t", "a", 1), ("t", "b", 2)]


def test_orphans(frame):
    child = frame("k string, v int", [("a", 1), ("a", 2), ("z", 3), ("z", 4), (None, 5)])
    parent = frame("k string", [("a",), ("b",)])
    assert rows(P.orphans(child, parent, ["k"], ["k"]), "v") == [(3,), (4,), (5,)]
    assert rows(P.orphan_count(child, parent, ["k"], ["k"], "r")) == [("r", 3)]
    with_null = frame("k string", [("a",), (None,)])
    assert rows(P.orphan_count(child, with_null, ["k"], ["k"], "r")) == [("r", 2)]
    assert rows(P.orphan_count(parent, child, ["k"], ["k"], "r")) == [("r", 1)]


def test_orphan_count_sends_one_row_per_key(frame):
    child = frame("k string, v int", [("a", 1)])
    plan = P.orphan_count(child, child, ["k"], ["k"], "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("partial_count")  # the aggregate sits below the join
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_range_and_value_counts(frame):
    df = frame("s string, d int", [("x", 3), ("y", 1), ("x", None), (None, 2)])
    assert rows(P.value_range(df, "d")) == [(1, 3)]
    assert [tuple(r) for r in P.value_counts(df, "s").collect()] == [("x", 2), ("y", 1)]
