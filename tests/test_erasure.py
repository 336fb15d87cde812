"""Erasure over a key graph: cycles, shared children, copies."""

import random

import pytest

from tidewater.plans.erasure import KeyEdge, KeyGraph, erase_cascade, erased_rows


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def brute(data, graph, start, column, subjects):
    """data: {table: (columns, rows)}."""
    gone = {t: set() for t in data}
    cols = {t: data[t][0] for t in data}
    pk = lambda t, r: tuple(r[cols[t].index(k)] for k in graph.keys[t])
    todo = [(start, r) for r in data[start][1] if r[cols[start].index(column)] in subjects]
    while todo:
        t, r = todo.pop()
        if pk(t, r) in gone[t]:
            continue
        gone[t].add(pk(t, r))
        for e in graph.edges:
            if e.parent == t and (v := r[cols[t].index(e.parent_key)]) is not None:
                todo += [(e.child, x) for x in data[e.child][1] if x[cols[e.child].index(e.child_key)] == v]
    return {t: sorted((r for r in rs if pk(t, r) not in gone[t]), key=str) for t, (_, rs) in data.items()}, {t: len(g) for t, g in gone.items()}


GRAPH = KeyGraph(
    {"person": ["id"], "account": ["id"], "payment": ["id"], "mail": ["id"]},
    [KeyEdge("person", "id", "account", "owner"), KeyEdge("account", "id", "payment", "account"),
     KeyEdge("person", "id", "mail", "sender"), KeyEdge("payment", "id", "mail", "about"),
     KeyEdge("account", "guardian", "person", "id"),       # back to where it started
     KeyEdge("payment", "id", "payment", "refund_of")])    # onto itself


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_walk_row_by_row(spark, seed):
    rng = random.Random(seed)
    ref = lambda n: rng.choice([None, *range(n)])
    data = {
        "person": (["id", "city"], [(i, rng.choice("ab")) for i in range(25)]),
        "account": (["id", "owner", "guardian"], [(i, ref(25), ref(25)) for i in range(20)]),
        "payment": (["id", "account", "refund_of"], [(i, ref(20), ref(30)) for i in range(30)]),
        "mail": (["id", "sender", "about"], [(i, ref(25), ref(30)) for i in range(30)]),
    }
    frames = {t: spark.createDataFrame(r, ", ".join(f"{c} {'string' if c == 'city' else 'int'}" for c in cols)) for t, (cols, r) in data.items()}
    subjects = spark.createDataFrame([(3,), (3,), (None,), (99,)], "id int")
    kept, log = erase_cascade(frames, GRAPH, "person", subjects, "id")
    want, counts = brute(data, GRAPH, "person", "id", {3, 99})
    assert {t: rows(df) for t, df in kept.items()} == want
    assert dict(rows(log)) == counts


def test_any_table_can_be_the_start_and_any_column_the_subject(spark):
    frames = {"person": spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "id int, city string"),
              "account": spark.createDataFrame([(10, 1, None), (11, 2, None), (12, 3, 2)], "id int, owner int, guardian int"),
              "payment": spark.createDataFrame([(5, 11, None)], "id int, account int, refund_of int"),
              "mail": spark.createDataFrame([(7, 2, None), (8, 9, 5)], "id int, sender int, about int")}
    kept, log = erase_cascade(frames, GRAPH, "person", spark.createDataFrame([("x",)], "city string"), "city")
    # 1 and 3 go, their accounts, 3's guardian 2, with 2's account, payment and mails
    assert {t: df.count() for t, df in kept.items()} == {"person": 0, "account": 0, "payment": 0, "mail": 0}
    kept, log = erase_cascade(frames, GRAPH, "payment", spark.createDataFrame([(5,)], "id int"), "id")
    assert dict(rows(log)) == {"payment": 1, "mail": 1}
    assert set(kept) == {"payment", "mail"}


def test_a_table_needs_a_line_only(spark):
    graph = KeyGraph(GRAPH.keys | {"backup": ["copy"]}, [*GRAPH.edges, KeyEdge("person", "id", "backup", "person")])
    frames = {t: spark.createDataFrame([], f"id int, {c}") for t, c in (
        ("account", "owner int, guardian int"), ("payment", "account int, refund_of int"), ("mail", "sender int, about int"))}
    frames |= {"person": spark.createDataFrame([(1,)], "id int"), "backup": spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "copy string, person int")}
    kept, log = erase_cascade(frames, graph, "person", spark.createDataFrame([(1,)], "id int"), "id")
    assert rows(kept["backup"]) == [("b", 2)] and dict(rows(log))["backup"] == 2 and dict(rows(log))["mail"] == 0
    with pytest.raises(ValueError, match="not given"):
        erased_rows({"person": frames["person"]}, graph, "person", spark.createDataFrame([(1,)], "id int"), "id")
    with pytest.raises(ValueError, match="primary key"):
        KeyGraph({"a": ["x"]}, [KeyEdge("a", "x", "b", "y")])


def test_a_bound_on_rounds_raises_when_it_cuts(spark):
    graph = KeyGraph({"n": ["id"]}, [KeyEdge("n", "id", "n", "up")])
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(5)], "id int, up int")
    one = spark.createDataFrame([(0,)], "id int")
    assert erased_rows({"n": chain}, graph, "n", one, "id")["n"].count() == 5
    with pytest.raises(ValueError, match="beyond"):
        erased_rows({"n": chain}, graph, "n", one, "id", max_rounds=2)
