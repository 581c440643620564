"""Ordered operators against plain Python, with a key that holds most rows cut into many chunks."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockwright.operators.audit import StockTimeline, price_history_audit
from stockwright.operators.ordered import OrderedChunks, assign_ids, global_rank
from stockwright.sources.tables import stage


@pytest.fixture(scope="module")
def table(spark):
    """One key with most rows, one that is unknown, others with a few rows, one with a single row."""
    source = random.Random(7)
    keys = [1] * 400 + [None] * 90 + [source.randint(2, 40) for _ in range(200)] + [99]
    source.shuffle(keys)
    rows = [(key, i, source.randint(-9, 9) or None) for i, key in enumerate(keys)]
    return rows, spark.createDataFrame(rows, "k bigint, i bigint, v bigint").repartition(5)


def expected(rows):
    result = {}
    for key in {row[0] for row in rows}:
        group = sorted(row[1:] for row in rows if row[0] == key)
        total = 0
        for n, (i, value) in enumerate(group):
            total += value or 0
            later = next((v for _, v in group[n + 1 :] if v is not None and v > 0), None)
            result[i] = (key, total, group[n - 1][1] if n else None, later)
    return result


@pytest.mark.parametrize("chunks", [None, 1, 7, 40])
def test_running_values(table, chunks):
    rows, df = table
    ordered_rows = OrderedChunks(df, ["k"], ["i"], chunks)
    value = F.col("v")
    known = F.coalesce(value, F.lit(0))
    out = ordered_rows.running({"total": known}, {"whole": known}, {"before": value})
    out = ordered_rows.next_known(out, F.when(value > 0, value), "later")
    collected = out.collect()
    found = {row.i: (row.k, row.total, row.before, row.later) for row in collected}
    assert len(found) == len(rows)
    assert found == expected(rows)
    whole = {key: sum(v or 0 for k, _, v in rows if k == key) for key in {row[0] for row in rows}}
    assert all(row.whole == whole[row.k] for row in collected)


def test_large_groups_are_cut(table):
    rows, df = table
    cut = OrderedChunks(df, ["k"], ["i"], chunks=12)
    edges = cut.edges(cut.rows, {"n": F.count(F.lit(1))}).collect()
    assert len([row for row in edges if row.k == 1]) > 4 and len(edges) <= 24
    out = cut.running({"total": F.coalesce("v", F.lit(0))})
    assert {row.i: row.total for row in out.collect()} == {i: row[1] for i, row in expected(rows).items()}



def test_ids_are_consecutive_and_follow_the_order(table, spark):
    rows, df = table
    found = sorted((row.id, row.i) for row in assign_ids(df, ["i"]).collect())
    assert found == [(n + 1, n) for n in range(len(rows))]
    after = spark.createDataFrame([(41,), (7,)], "id bigint")
    assert min(row.id for row in assign_ids(df, ["i"], after=after).collect()) == 42
    assert min(row.id for row in assign_ids(df, ["i"], after=after.filter("id > 99")).collect()) == 1


def test_rank_over_the_whole_table_with_many_ties(table):
    rows, df = table
    values = df.filter("v IS NOT NULL")
    found = {row.i: row.r for row in global_rank(values, "v", "r").collect()}
    known = [(i, v) for _, i, v in rows if v is not None]
    assert found == {i: 1 + sum(other > v for _, other in known) for i, v in known}


@pytest.fixture(scope="module")
def moves(spark):
    source = random.Random(11)
    rows = []
    for i in range(500):
        product = 1 if source.random() < 0.7 else source.randint(2, 9)
        kind = source.choice(["IN", "OUT", "ADJUST", "OTHER"])
        qty = Decimal(source.randint(-3, 9))
        rows.append((product, 1, kind, qty, i))
    movement = spark.createDataFrame(
        rows, "product_id bigint, warehouse_id bigint, movement_type string, qty decimal(12,2), seq bigint"
    ).withColumn("created_at", F.timestamp_seconds("seq").cast("timestamp_ntz"))
    levels = [(p, None if p == 9 else Decimal(p % 4), p != 8) for p in range(1, 10)]
    product = spark.createDataFrame(levels, "id bigint, min_stock_level decimal(12,2), is_active boolean")
    return rows, levels, movement, product


def alerts_by_hand(rows, levels, opening):
    minimum = {p: m for p, m, _ in levels}
    active = {p: a for p, _, a in levels}
    stock, open_, found, episodes = dict(opening), {}, {}, {}
    for product, _, kind, qty, seq in rows:
        stock[product] = stock.get(product, 0) + {"IN": qty, "OUT": -qty, "ADJUST": qty}.get(kind, 0)
        if not active[product]:
            continue
        if minimum[product] is not None and stock[product] <= minimum[product]:
            if not open_.get(product):
                episodes[seq] = 0
            open_.setdefault(product, []).append(seq)
            found[seq] = [product, stock[product], None]
            episodes[open_[product][0]] += 1
        else:
            for alert in open_.pop(product, []):
                found[alert][2] = seq
    return found, episodes


def test_alerts_read_their_chunks_twice(moves, monkeypatch):
    """Once for what chunks hand on, once for the rows; after that only what is low, or ends it, is read."""
    from stockwright.operators import audit

    _, _, movement, product = moves
    plans = []

    def planned(rows, purpose):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return stage(rows, purpose)

    monkeypatch.setattr(audit, "stage", planned)
    timeline = StockTimeline(movement, product)
    assert len(plans) == 1 and plans[0].count("Relation ") == 2
    chunks = set(timeline.chunks.rows.inputFiles())
    assert not chunks & {*timeline.alerts().inputFiles(), *timeline.episodes().inputFiles()}


@pytest.mark.parametrize("chunks", [None, 9])
@pytest.mark.parametrize("start", [{}, {1: Decimal(40), 3: Decimal(-5)}])
def test_alerts(moves, spark, chunks, start):
    rows, levels, movement, product = moves
    opening = None
    if start:
        opening = spark.createDataFrame(
            [(p, 1, s) for p, s in start.items()], "product_id bigint, warehouse_id bigint, stock decimal(12,2)"
        )
    timeline = StockTimeline(movement, product, opening, chunks)
    expected_alerts, episodes = alerts_by_hand(rows, levels, start)
    found = {
        row.seq: [row.product_id, row.current_stock, row.second]
        for row in timeline.alerts().withColumn("second", F.unix_seconds(F.col("resolved_at").cast("timestamp"))).collect()
    }
    assert found == expected_alerts
    periods = {
        row.second: row.movements
        for row in timeline.episodes().withColumn("second", F.unix_seconds(F.col("opened_at").cast("timestamp"))).collect()
    }
    assert periods == episodes


def test_price_history(spark):
    prices = [(1, "10", 1), (1, "10", 2), (1, "12.5", 3), (1, None, 4), (1, "13", 5), (2, "0", 1), (2, "5", 2), (2, "9999", 3)]
    rows = spark.createDataFrame(
        [(p, v and Decimal(v), s) for p, v, s in prices], "product_id bigint, price decimal(12,2), seq bigint"
    ).withColumn("changed_at", F.col("seq"))
    last = spark.createDataFrame([(1, Decimal(8))], "product_id bigint, price decimal(12,2)")
    found = sorted(tuple(row) for row in price_history_audit(rows, last).collect())
    assert found == [
        (1, 1, 8, 10, Decimal("25.00"), False),
        (1, 3, 10, Decimal("12.50"), Decimal("25.00"), False),
        (2, 2, 0, 5, None, False),
        (2, 3, 5, 9999, None, True),
    ]
