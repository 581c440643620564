"""Sequential acceptance against a plain loop."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockwright.operators import allocation
from stockwright.operators.allocation import allocate


def by_hand(rows, opening):
    level, found = dict(opening), {}
    for key, seq, delta, guarded in rows:
        now = level.get(key, Decimal(0))
        ok = delta is not None and (not guarded or now + delta >= 0)
        level[key] = now + delta if ok else now
        found[seq] = (ok, level[key])
    return found


def run(spark, rows, opening, chunks):
    requests = spark.createDataFrame(rows, "k bigint, seq bigint, delta decimal(12,2), guarded boolean").repartition(3)
    levels = spark.createDataFrame([(k, v) for k, v in opening.items()], "k bigint, level decimal(12,2)")
    out = allocate(requests, ["k"], ["seq"], F.col("delta"), F.col("guarded"), levels, chunks)
    collected = out.collect()
    assert len(collected) == len(rows)
    return {row.seq: (row.accepted, row.level) for row in collected}


def requests(kind: str, seed: int, n: int = 400):
    source = random.Random(seed)
    rows = []
    for seq in range(n):
        key = 1 if source.random() < 0.6 else source.randint(2, 6)
        if kind == "sales":
            delta, guarded = -Decimal(source.randint(1, 2000)) / 100, True
        elif kind == "whole sales":
            delta, guarded = Decimal(-source.randint(1, 20)), True
        elif kind == "corrections":
            delta, guarded = Decimal(source.randint(-1000, 900)) / 100, True
        else:
            delta, guarded = Decimal(source.randint(-10, 10)), source.random() < 0.7
            if source.random() < 0.1:
                delta = None
        rows.append((key, seq, delta, guarded))
    return rows


@pytest.mark.parametrize("chunks", [None, 3, 25])
@pytest.mark.parametrize("kind", ["sales", "whole sales", "corrections", "mixed"])
def test_against_a_loop(spark, kind, chunks):
    rows = requests(kind, seed=len(kind))
    opening = {1: Decimal("350.55"), 2: Decimal(10), 3: Decimal(-8), 4: Decimal(100000)}
    assert run(spark, rows, opening, chunks) == by_hand(rows, opening)


def test_requests_that_alternate_between_fitting_and_not(spark):
    """Each rejection depends on all acceptances before it: the level creeps down cent by cent."""
    rows = []
    level = 60
    for step in range(60):
        rows.append((1, 2 * step, Decimal(-1), True))
        rows.append((1, 2 * step + 1, Decimal(-(level - step)), True))
    opening = {1: Decimal(level)}
    assert run(spark, rows, opening, 12) == by_hand(rows, opening)


def test_exhausted_stock_needs_no_walk(spark, monkeypatch):
    """Once nothing is left, the remaining chunks are rejected whole."""
    rows = [(1, seq, Decimal(-5), True) for seq in range(300)]
    walked = []
    plain = allocation._chain

    def spy(*args):
        result = plain(*args)
        walked.append(len(result[1]))
        return result

    monkeypatch.setattr(allocation, "_chain", spy)
    assert run(spark, rows, {1: Decimal(103)}, 30) == by_hand(rows, {1: Decimal(103)})
    assert max(walked) <= 2 and len(walked) <= 3


def test_only_cut_keys_are_settled_after_the_chunks_are_written(spark, monkeypatch):
    """Rows of keys that lie in one chunk are walked as they are written and not moved again."""
    moved = []
    plain = allocation._walk

    def counting(rows, groups):
        moved.append({row.k for row in rows.select("k").distinct().collect()})
        return plain(rows, groups)

    monkeypatch.setattr(allocation, "_walk", counting)
    rows = [(key, 100 * key + n, Decimal(-3), True) for key in range(40) for n in range(10)]
    opening = {key: Decimal(key) for key in range(40)}
    assert run(spark, rows, opening, 4) == by_hand(rows, opening)
    assert len(set().union(*moved)) <= 3
    moved.clear()
    assert run(spark, rows, opening, 1) == by_hand(rows, opening)
    assert not moved


def test_null_keys_and_order_left_out(spark):
    """Rows without a key keep their own places; the order is not carried on where it is not asked for."""
    rows = [(None, 1, None, True), (None, 2, None, True), (1, 3, Decimal(-2), True), (1, 4, Decimal(-2), True)]
    asked = spark.createDataFrame(rows, "k bigint, seq bigint, delta decimal(12,2), guarded boolean")
    levels = spark.createDataFrame([(1, Decimal(3))], "k bigint, level decimal(12,2)")
    for chunks in (None, 3):
        out = allocate(asked, ["k"], ["seq"], F.col("delta"), F.col("guarded"), levels, chunks, keep_order=False)
        assert "seq" not in out.columns
        found = sorted((row.k or 0, row.accepted, row.level) for row in out.collect())
        assert found == [(0, False, 0), (0, False, 0), (1, False, 1), (1, True, 1)]


def test_balances_outgrow_a_single_amount(spark):
    """The sum of a busy key is larger than any one quantity may be."""
    most = Decimal("9999999999.99")
    rows = [(1, seq, most if seq < 5 else -most, True) for seq in range(8)]
    assert run(spark, rows, {}, None) == by_hand(rows, {})
