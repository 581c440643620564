"""Sums kept up to date against sums made anew, and tables laid out by month."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from stockwright.operators.upkeep import merged_sums, signed_changes, touched_sums
from stockwright.sources.monthly import MonthlyTable

LINE = "struct<doc: long, site: long, amount: decimal(12,2)>"


def test_sums_after_random_batches(spark):
    rng = random.Random(4)
    lines, number = {}, 0
    stored = spark.createDataFrame([], "doc long, site long, amount decimal(22,2), rows long")
    for _ in range(4):
        batch = []
        for _ in range(60):
            action = rng.choice(["insert", "insert", "update", "delete"])
            cell = (1 if rng.random() < 0.4 else rng.randint(2, 9), rng.randint(1, 2))
            line = (*cell, rng.choice([None, Decimal(rng.randint(-500, 900)) / 100]))
            if action == "insert" or not lines:
                number += 1
                batch.append((None, line))
                lines[number] = line
            else:
                key = rng.choice(list(lines))
                old = lines.pop(key)
                batch.append((old, line if action == "update" else None))
                if action == "update":
                    lines[key] = line
        changes = spark.createDataFrame(batch, f"old {LINE}, new {LINE}").repartition(3)
        signed = signed_changes(changes, ["doc", "site"], "amount")
        touched = touched_sums(stored, signed, ["doc", "site"], "amount")
        cells = {line[:2] for pair in batch for line in pair if line}
        assert {(r.doc, r.site) for r in touched.collect()} == cells
        rows = merged_sums(stored, touched, ["doc", "site"]).collect()
        want = {}
        for doc, site, amount in lines.values():
            total, n = want.get((doc, site), (Decimal(0), 0))
            want[doc, site] = (total + (amount or 0), n + 1)
        assert {(r.doc, r.site): (r.amount, r.rows) for r in rows} == want
        stored = spark.createDataFrame([tuple(r) for r in rows], stored.schema)


def test_ranges_read_their_months(spark, tmp_path):
    start = datetime(1998, 1, 1)
    rows = [(i, start + timedelta(hours=7 * i)) for i in range(1500)] + [(9999, None)]
    frame = spark.createDataFrame(rows, "id long, at timestamp_ntz")
    table = MonthlyTable(spark, str(tmp_path / "t"), "at")
    table.append(frame.filter("id % 5 <> 0 OR id IS NULL"))
    table.append(frame.filter("id % 5 = 0"))
    assert table.read().count() == len(rows)
    first, last = date(1998, 2, 27), date(1998, 3, 2)
    found = table.between(first, last)
    want = sorted(i for i, at in rows if at and first <= at.date() <= last)
    assert sorted(r.id for r in found.collect()) == want
    read = [f for f in found.inputFiles()]
    months = {f.split("month=")[1].split("/")[0] for f in read}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    scanned = spark.read.parquet(str(tmp_path / "t")).filter(F.col("month").between(date(1998, 2, 1), date(1998, 3, 1)))
    assert scanned.select("month").distinct().count() == 2 < len({f for f in months}) or len(months) == 2
    late = spark.createDataFrame([(5000, datetime(1998, 2, 28, 5))], frame.schema)
    table.append(late)
    assert sorted(r.id for r in table.between(first, last).collect()) == sorted([*want, 5000])
    files = lambda month: len(list((tmp_path / "t" / f"month={month}").glob("*.parquet")))
    before, other = files("1998-02-01"), files("1998-04-01")
    table.rewrite(date(1998, 2, 10), date(1998, 2, 11))
    assert files("1998-02-01") < before and files("1998-04-01") == other
    assert sorted(r.id for r in table.between(first, last).collect()) == sorted([*want, 5000])
    assert table.read().count() == len(rows) + 1
