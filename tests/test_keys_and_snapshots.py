"""Deletes along foreign keys and differences of versions, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from stockwright.operators.keys import CASCADE, RESTRICT, SET_NULL, ForeignKey, KeyGraph
from stockwright.operators.snapshots import changed_rows, updates

KEYS = [
    ForeignKey("a", "up", "a", CASCADE),
    ForeignKey("b", "a1", "a", CASCADE),
    ForeignKey("b", "a2", "a", SET_NULL),
    ForeignKey("c", "b1", "b", CASCADE),
    ForeignKey("c", "a1", "a", CASCADE),
    ForeignKey("d", "c1", "c", RESTRICT),
    ForeignKey("d", "b1", "b", SET_NULL),
    ForeignKey("leaf", "c1", "c", CASCADE),
    ForeignKey("leaf", "a1", "a", SET_NULL),
]
COLUMNS = {"a": ["id", "up"], "b": ["id", "a1", "a2"], "c": ["id", "b1", "a1"], "d": ["id", "c1", "b1"], "leaf": ["c1", "a1"]}


def by_hand(rows, asked):
    """Each row asked for is followed on its own."""

    def taken(root):
        seen, todo = set(), [root]
        while todo:
            name, key = todo.pop()
            if (name, key) in seen:
                continue
            seen.add((name, key))
            for k in KEYS:
                if k.parent == name and k.on_delete == CASCADE and "id" in COLUMNS[k.child]:
                    todo += [(k.child, r["id"]) for r in rows[k.child] if r[k.column] == key]
        return seen

    gone, refused = set(), set()
    for name, ids in asked.items():
        for key in ids:
            if not any(r.get("id") == key for r in rows[name]):
                continue
            closure = taken((name, key))
            barred = any(
                r[k.column] == i for n, i in closure for k in KEYS if k.parent == n and k.on_delete == RESTRICT for r in rows[k.child]
            )
            if barred:
                refused.add((name, key))
            else:
                gone |= closure
    after = {}
    for name, held in rows.items():
        after[name] = []
        for r in held:
            if (name, r.get("id")) in gone:
                continue
            if any(k.child == name and k.on_delete == CASCADE and (k.parent, r[k.column]) in gone for k in KEYS):
                continue
            new = dict(r)
            for k in KEYS:
                if k.child == name and k.on_delete == SET_NULL and (k.parent, r[k.column]) in gone:
                    new[k.column] = None
            after[name].append(tuple(new[c] for c in COLUMNS[name]))
    return after, refused


@pytest.mark.parametrize("seed", [1, 2])
def test_deletes_on_a_random_graph(spark, seed):
    rng = random.Random(seed)
    sizes = {"a": 40, "b": 60, "c": 60, "d": 8, "leaf": 50}
    rows = {}
    for name, n in sizes.items():
        rows[name] = []
        for i in range(n):
            row = {}
            for column in COLUMNS[name]:
                target = {"up": "a", "a1": "a", "a2": "a", "b1": "b", "c1": "c"}.get(column)
                row[column] = i if column == "id" else None if rng.random() < 0.3 else rng.randrange(sizes[target])
            rows[name].append(row)
    for r in rows["a"]:  # a forest, with one circle
        r["up"] = None if r["id"] < 10 else rng.randrange(r["id"])
    rows["a"][0]["up"] = 39
    tables = {
        name: spark.createDataFrame([tuple(r[c] for c in COLUMNS[name]) for r in held], ", ".join(f"{c} long" for c in COLUMNS[name]))
        for name, held in rows.items()
    }
    asked = {"a": rng.sample(range(40), 9), "c": rng.sample(range(60), 9), "d": [0, 3, 99]}
    frames = {name: spark.createDataFrame([(i,) for i in [*ids, ids[0]]], "id long") for name, ids in asked.items()}
    done = KeyGraph(tables, KEYS).delete(frames)
    after, refused = by_hand(rows, asked)
    for name in tables:
        key = lambda r: [(x is not None, x) for x in r]
        assert sorted(map(tuple, done.tables[name].collect()), key=key) == sorted(after[name], key=key)
    assert {(name, r.id) for name, ids in done.refused.items() for r in ids.collect()} == refused
    assert refused and any(len(after[n]) < sizes[n] for n in ("a", "b"))


def test_circles_of_tables_are_refused(spark):
    rows = spark.createDataFrame([], "id long, x long")
    keys = [ForeignKey("p", "x", "q", CASCADE), ForeignKey("q", "x", "p", CASCADE)]
    with pytest.raises(ValueError):
        KeyGraph({"p": rows, "q": rows}, keys)
    with pytest.raises(ValueError):
        KeyGraph({"p": rows}, [ForeignKey("p", "x", "p", "NO ACTION")])


def test_changed_rows(spark):
    before = [(1, None, "a", "b"), (2, 1, None, "x"), (None, 1, "n", None), (4, 4, "same", None), (5, 5, "gone", "x")]
    after = [(1, None, "a", "c"), (2, 1, "x", None), (None, 1, "n", "m"), (4, 4, "same", None), (6, 5, "new", "x"), (None, None, "y", "y")]
    schema = "k1 long, k2 long, u string, v string"
    frames = [spark.createDataFrame(rows, schema).repartition(3) for rows in (before, after)]
    found = changed_rows(frames[0], frames[1].withColumn("added", F.lit(1)), ["k1", "k2"]).collect()
    image = lambda s: s and tuple(s)
    got = {(r.k1, r.k2): (r.change, image(r.old), image(r.new)) for r in found}
    assert len(found) == len(got)
    assert got == {
        (1, None): ("update", ("a", "b"), ("a", "c")),
        (2, 1): ("update", (None, "x"), ("x", None)),
        (None, 1): ("update", ("n", None), ("n", "m")),
        (5, 5): ("delete", ("gone", "x"), None),
        (6, 5): ("insert", None, ("new", "x")),
        (None, None): ("insert", None, ("y", "y")),
    }
    assert changed_rows(frames[0], frames[0], ["k1", "k2"]).count() == 0
    assert changed_rows(frames[0].limit(0), frames[0], ["k1", "k2"]).count() == len(before)


def test_updates_as_requested_changes(spark):
    before = spark.createDataFrame([(1, "DRAFT", 5), (2, "DRAFT", 6), (3, "DRAFT", 7)], "id long, status string, supplier_id long")
    after = spark.createDataFrame([(1, "CONFIRMED", 5), (2, "DRAFT", 6), (4, "DRAFT", 7)], before.schema)
    rows = updates(before, after, "id", {"status": "new_status", "supplier_id": "new_supplier_id"}).collect()
    assert [r.asDict() for r in rows] == [
        {"id": 1, "status": "DRAFT", "supplier_id": 5, "new_status": "CONFIRMED", "new_supplier_id": 5}
    ]
