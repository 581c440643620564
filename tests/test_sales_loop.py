"""Sales with competing invoice numbers and competing stock against a plain loop over the requests."""

import os
import random
import subprocess
import sys
from decimal import Decimal

import pytest

from stockwright.functions import wording as W
from stockwright.operators import changes, commands

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def loop(requests, stock, used):
    taken, out = set(used), {}
    for seq, number, product, warehouse, qty in sorted(requests):
        cell = (product, warehouse)
        if qty <= 0:
            out[seq] = W.NO_QTY
        elif number in taken:
            out[seq] = W.NUMBER_TAKEN
        elif stock.get(cell, 0) < qty:
            out[seq] = W.NO_STOCK
        else:
            stock[cell] -= qty
            taken.add(number)
            out[seq] = None
    return out


@pytest.mark.parametrize("chunks", [None, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_numbers_of_refused_sales_are_free(spark, seed, chunks):
    rng = random.Random(seed)
    requests = [
        (i, f"N{rng.randint(0, 60)}", 1 if rng.random() < 0.4 else rng.randint(2, 6), rng.randint(1, 2), rng.randint(0, 9))
        for i in range(300)
    ]
    stock = {(p, w): rng.randint(0, 60) for p in range(1, 7) for w in (1, 2)}
    used = {"N5", "N9"}
    frame = spark.createDataFrame(
        [(s, "c", n, p, w, Decimal(q), Decimal(1), "x") for s, n, p, w, q in requests],
        "seq long, customer_name string, invoice_no string, product_id long, warehouse_id long, qty decimal(12,2), "
        "unit_price decimal(12,2), issued_by string",
    )
    product = spark.createDataFrame(
        [(p, True, Decimal(1), None) for p in range(1, 7)],
        "id long, is_active boolean, min_stock_level decimal(12,2), max_stock_level decimal(12,2)",
    )
    warehouse = spark.createDataFrame([(1, True), (2, True)], "id long, is_active boolean")
    opening = spark.createDataFrame(
        [(*cell, Decimal(n)) for cell, n in stock.items()], "product_id long, warehouse_id long, stock decimal(12,2)"
    )
    numbers = spark.createDataFrame([(n,) for n in used], "invoice_no string")
    outcome = commands.process_sales(frame, product, warehouse, opening, numbers, chunks)
    found = {r.seq: r.reason for r in outcome.collect()}
    assert found == loop(requests, dict(stock), used)
    assert len({r.invoice_no for r in outcome.filter("reason IS NULL").collect()}) == list(found.values()).count(None)


def test_alerts_of_confirmed_sales_follow_the_order(spark):
    """Stock 9, minimum 5: a sale of 3 leaves 6 and raises nothing, a sale of 4 leaves 2."""
    lines = spark.createDataFrame(
        [("A", 1, 1, Decimal(3), 1), ("B", 1, 1, Decimal(4), 2), ("B", 1, 1, Decimal(1), 3)],
        "sales_invoice_id string, product_id long, warehouse_id long, qty decimal(12,2), seq long",
    )
    confirmed = spark.createDataFrame([("A",), ("B",)], "id string")
    movement = spark.createDataFrame(
        [(1, 1, "IN", Decimal(9))], "product_id long, warehouse_id long, movement_type string, qty decimal(12,2)"
    )
    product = spark.createDataFrame([(1, Decimal(5))], "id long, min_stock_level decimal(12,2)")
    found = changes.alerts_of_sales(confirmed, lines, movement, product)
    assert sorted(int(r.current_stock) for r in found.collect()) == [1, 2]
    nothing_open = spark.createDataFrame([], "product_id long, warehouse_id long, is_resolved boolean")
    once = changes.alerts_of_sales(confirmed, lines, movement, product, nothing_open)
    assert [int(r.current_stock) for r in once.collect()] == [2]


def test_runs_from_any_folder(tmp_path):
    """With the package on the driver's path only, the walk still runs in the Python workers."""
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "from stockwright.plans.catalog import QUERIES\n"
        "print('rows', QUERIES['safe_decrease_stock'](spark, '/root/testdata/sf0.001').count())\n"
    )
    path = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=path, capture_output=True, text=True, timeout=600)
    assert "rows" in done.stdout, done.stderr[-2000:]


def test_rounds_walk_less_and_less(spark, monkeypatch):
    """A round starts where the one before was wrong, and leaves cells alone that no rival asks for."""
    from stockwright.operators.allocation import Competition

    walked = []
    plain = Competition.settle

    def counting(self, rows):
        walked.append(rows.count())
        return plain(self, rows)

    monkeypatch.setattr(Competition, "settle", counting)
    rng = random.Random(3)
    requests = [(i, f"N{rng.randint(0, 60)}", 1, 1, rng.randint(1, 9)) for i in range(200)]
    requests += [(300 + i, f"Z{i}", 2, 1, 1) for i in range(30)]
    frame = spark.createDataFrame(
        [(s, "c", n, p, w, Decimal(q), Decimal(1), "x") for s, n, p, w, q in requests],
        "seq long, customer_name string, invoice_no string, product_id long, warehouse_id long, qty decimal(12,2), "
        "unit_price decimal(12,2), issued_by string",
    )
    product = spark.createDataFrame(
        [(p, True, Decimal(1), None) for p in (1, 2)],
        "id long, is_active boolean, min_stock_level decimal(12,2), max_stock_level decimal(12,2)",
    )
    warehouse = spark.createDataFrame([(1, True)], "id long, is_active boolean")
    stock = {(1, 1): 120, (2, 1): 10}
    opening = spark.createDataFrame(
        [(*cell, Decimal(n)) for cell, n in stock.items()], "product_id long, warehouse_id long, stock decimal(12,2)"
    )
    numbers = spark.createDataFrame([], "invoice_no string")
    outcome = commands.process_sales(frame, product, warehouse, opening, numbers, 5)
    assert {r.seq: r.reason for r in outcome.collect()} == loop(requests, dict(stock), set())
    # The last call books all requests; the rounds before it only read the cell with rivals, and less of it each time.
    *rounds, last = walked
    assert last == len(requests) and rounds[0] == 200 and len(rounds) > 1
    assert all(a > b for a, b in zip(rounds, rounds[1:]))


def test_cells_without_rivals_are_not_walked_again(spark, monkeypatch):
    """Requests for product 2 all have numbers of their own: what was found when they were put in order stands."""
    from stockwright.operators import allocation

    moved = set()
    plain = allocation._walk

    def noting(rows, groups):
        moved.update(row.product_id for row in rows.select("product_id").distinct().collect())
        return plain(rows, groups)

    monkeypatch.setattr(allocation, "_walk", noting)
    requests = [(i, f"N{i // 2}", 1, 1, 2) for i in range(20)] + [(100 + i, f"Z{i}", 2, 1, 3) for i in range(20)]
    frame = spark.createDataFrame(
        [(s, "c", n, p, w, Decimal(q), Decimal(1), "x") for s, n, p, w, q in requests],
        "seq long, customer_name string, invoice_no string, product_id long, warehouse_id long, qty decimal(12,2), "
        "unit_price decimal(12,2), issued_by string",
    )
    product = spark.createDataFrame(
        [(p, True, Decimal(1), None) for p in (1, 2)],
        "id long, is_active boolean, min_stock_level decimal(12,2), max_stock_level decimal(12,2)",
    )
    warehouse = spark.createDataFrame([(1, True)], "id long, is_active boolean")
    stock = {(1, 1): 11, (2, 1): 10}
    opening = spark.createDataFrame(
        [(*cell, Decimal(n)) for cell, n in stock.items()], "product_id long, warehouse_id long, stock decimal(12,2)"
    )
    numbers = spark.createDataFrame([], "invoice_no string")
    outcome = commands.process_sales(frame, product, warehouse, opening, numbers, 1)
    assert {r.seq: r.reason for r in outcome.collect()} == loop(requests, dict(stock), set())
    assert moved == {1}
