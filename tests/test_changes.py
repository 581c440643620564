"""Table changes and rules on rows with NULLs, zeros and duplicates."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockwright.functions import expressions as E
from stockwright.operators import audit, changes, rules
from stockwright.sources import tables

D = Decimal
NOW = datetime(2025, 2, 1)


def rows(df, *columns):
    return sorted((tuple(row) for row in (df.select(*columns) if columns else df).collect()), key=repr)


def test_update_sets_nulls_and_leaves_others(spark):
    table = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, None, 7)], "id int, name string, n int")
    update = spark.createDataFrame([(1, None), (3, "c"), (9, "z")], "id int, new string")
    assert rows(changes.apply_updates(table, update, "id", {"name": "new"})) == [(1, None, 5), (2, "b", 6), (3, "c", 7)]


def test_delete_keeps_rows_whose_condition_is_unknown(spark):
    table = spark.createDataFrame([(1, "sale 1"), (2, None), (3, "x")], "id int, note string")
    assert rows(changes.delete_where(table, F.col("note").like("sale%")), "id") == [(2,), (3,)]


def test_deleting_parents(spark):
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "n int, parent int")
    gone = spark.createDataFrame([(10,), (30,)], "id int")
    assert rows(changes.delete_parents(child, gone, "parent", "CASCADE"), "n") == [(2,), (3,)]
    assert rows(changes.delete_parents(child, gone, "parent", "SET NULL"), "n", "parent") == [(1, None), (2, 20), (3, None)]
    assert rows(changes.delete_parents(child, gone, "parent", "RESTRICT"), "id") == [(10,)]
    with pytest.raises(ValueError):
        changes.delete_parents(child, gone, "parent", "IGNORE")


def test_defaults(spark):
    table = spark.createDataFrame([(1, None), (2, "X")], "id int, status string")
    filled = changes.with_defaults(table, {"status": "DRAFT", "is_active": True})
    assert rows(filled, "id", "status", "is_active") == [(1, "DRAFT", True), (2, "X", True)]


def test_totals_of_empty_documents_are_zero(spark):
    header = spark.createDataFrame([(1, None), (2, D(9))], "id int, total_amount decimal(12,2)")
    lines = spark.createDataFrame([(1, D("2.50")), (1, D("0.75"))], "invoice int, line_total decimal(12,2)")
    assert rows(changes.invoice_totals(header, lines, "invoice"), "id", "total_amount") == [(1, D("3.25")), (2, D("0.00"))]


def test_latest_line_sets_the_price_and_new_offers_are_added(spark):
    offers = spark.createDataFrame(
        [(1, 1, D(5), True), (2, 1, D(6), True)],
        "product_id int, supplier_id int, last_purchase_price decimal(12,2), is_preferred boolean",
    )
    invoice = spark.createDataFrame([(7, 1), (8, 2)], "id int, supplier_id int")
    lines = spark.createDataFrame(
        [(7, 1, D(10), 1), (7, 1, D(11), 3), (7, 1, D(12), 2), (8, 1, D(3), 4)],
        "purchase_invoice_id int, product_id int, unit_price decimal(12,2), seq int",
    )
    columns = ["product_id", "supplier_id", "last_purchase_price"]
    assert rows(changes.refresh_last_purchase_price(offers, invoice, lines), *columns) == [(1, 1, D(11)), (2, 1, D(6))]
    upserted = changes.upsert_product_supplier(offers, invoice, lines)
    assert rows(upserted, *columns, "is_preferred") == [(1, 1, D(11), True), (1, 2, D(3), False), (2, 1, D(6), True)]


def test_equal_lines_are_booked_as_often_as_they_are_due(spark):
    schema = (
        "product_id int, warehouse_id int, movement_type string, qty decimal(12,2), related_type string, related_id int"
    )
    line = (1, 1, "IN", D(5), "purchase", 9)
    due = spark.createDataFrame([line] * 3 + [(2, 1, "IN", D(5), "purchase", 9)], schema).withColumn("note", F.lit("n"))
    ledger = spark.createDataFrame([line], schema)
    assert rows(changes.not_yet_moved(due, ledger), "product_id") == [(1,), (1,), (2,)]


def test_rows_repeat_in_blocks(spark):
    table = spark.createDataFrame([("a", 7), ("b", 1), ("c", 10)], "name string, n bigint")
    found = changes.repeat_rows(table, "n", block=3)
    assert sorted(row.name for row in found.collect()) == ["a"] * 7 + ["b"] + ["c"] * 10
    assert found.columns == ["name", "n"]


def alerts(spark):
    return spark.createDataFrame(
        [(1, 1, D(1), D(5), False), (2, 1, D(9), D(5), True), (3, 2, D(0), D(5), False)],
        "product_id int, warehouse_id int, current_stock decimal(12,2), min_stock_level decimal(12,2), is_resolved boolean",
    ).selectExpr("*", "timestamp_ntz'2025-01-01' AS alert_date", "CAST(NULL AS timestamp_ntz) AS resolved_at", "CAST(NULL AS string) AS resolved_by")


def at():
    return F.lit("2025-02-01 00:00:00").cast("timestamp_ntz")


def test_alert_upsert_reopens_and_adds(spark):
    low = spark.createDataFrame(
        [(2, 1, D(2), D(5)), (4, 1, D(3), D(5))],
        "product_id int, warehouse_id int, current_stock decimal(12,2), min_stock_level decimal(12,2)",
    )
    found = changes.upsert_alerts(alerts(spark), low, at())
    assert rows(found, "product_id", "current_stock", "is_resolved") == [
        (1, D(1), False),
        (2, D(2), False),
        (3, D(0), False),
        (4, D(3), False),
    ]


def test_alerts_close_by_cell_or_product(spark):
    lines = spark.createDataFrame([(1, 1), (1, 1), (3, 1)], "product_id int, warehouse_id int")
    closed = changes.resolve_by_purchase(alerts(spark), lines, at())
    assert rows(closed, "product_id", "is_resolved", "resolved_by") == [
        (1, True, "Purchase confirmation"),
        (2, True, None),
        (3, False, None),
    ]
    off = spark.createDataFrame([(3,), (3,)], "product_id int")
    closed = audit.resolve_on_deactivation(alerts(spark), off, at())
    assert rows(closed, "product_id", "is_resolved", "resolved_at") == [(1, False, None), (2, True, None), (3, True, NOW)]


def test_status_rules_ignore_unknown_states(spark):
    asked = spark.createDataFrame(
        [(1, "DRAFT", "CONFIRMED", 1, 2), (2, "CONFIRMED", "CANCELLED", 1, 1), (3, "CONFIRMED", "CONFIRMED", 1, 2),
         (4, None, "CONFIRMED", 1, 1), (5, "CANCELLED", None, 1, None)],
        "id int, status string, new_status string, supplier_id int, new_supplier_id int",
    )
    assert rows(rules.validate_purchase_status(asked), "id", "reason") == [
        (1, None),
        (2, "Cannot change status of confirmed or cancelled invoice"),
        (3, "Cannot change supplier for confirmed or cancelled invoice"),
        (4, None),
        (5, None),
    ]


def test_constraint_checks(spark):
    table = spark.createDataFrame(
        [(1, "a", "IN"), (1, "b", "OUT"), (None, "c", None), (None, None, "X"), (2, "dddd", "IN")],
        "id int, name string, kind string",
    )
    parents = spark.createDataFrame([(1,)], "id int")
    F_ = F.col  # noqa: N806
    checks = [
        (rules.Unique("t", "unique", ("id",)), 1),
        (rules.Unique("t", "unique pair", ("name", "kind")), 1),
        (rules.Holds("t", "null", F_("id").isNull() | F_("name").isNull()), 2),
        (rules.Exists("t", "orphan", "id", "parents"), 1),
        (rules.Exists("t", "orphan of some", "id", "parents", F_("id") > 1), 3),
        (rules.Holds("t", "domain", ~F_("kind").isin("IN", "OUT")), 1),
        (rules.Holds("t", "length", F.length("name") > 3), 1),
        (rules.Holds("t", "none", F.lit(False)), 0),
        (rules.Exists("t", "self", "id", "t"), 0),
        (rules.Unique("parents", "unique", ("id",)), 0),
    ]
    pair = spark.createDataFrame([("p", "q"), ("p", "q"), ("pq", ""), (None, "q"), (None, "q")], "name string, kind string")
    tables = {"t": table.unionByName(pair.withColumn("id", F.lit(None).cast("int"))), "parents": parents}
    tables["t"] = tables["t"].withColumn("kind", F.when(F_("name").isNull() | (F.length("name") < 5), F_("kind")))
    wanted = [(c, n) for c, n in checks if c.rule not in ("null", "domain")]
    report = rules.constraint_report(tables, [c for c, _ in wanted])
    assert set(rows(report, "table_name", "rule", "violations")) == {(c.table, c.rule, n) for c, n in wanted}
    # Conditions on the rows without the pairs.
    alone = rules.constraint_report({"t": table}, [c for c, _ in checks if c.rule in ("null", "domain")])
    assert rows(alone, "rule", "violations") == [("domain", 1), ("null", 2)]


def test_constraints_read_each_table_once(spark, tmp_path):
    spark.range(9).select("id", F.col("id").alias("up")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    checks = [rules.Unique("t", "a", ("id",)), rules.Exists("t", "b", "up", "t"), rules.Holds("t", "c", F.col("id") > 5)]
    report = rules.constraint_report({"t": table}, checks)
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation ") == 1
    assert rows(report, "rule", "violations") == [("a", 0), ("b", 0), ("c", 3)]


@pytest.mark.parametrize(
    ("top", "bottom", "expected"),
    [("1", "3", "0.33"), ("2", "3", "0.67"), ("-1", "8", "-0.13"), ("1", "8", "0.13"), ("1", "-8", "-0.13"),
     ("5", "0", None), (None, "1", None), ("0", "5", "0.00"), ("9999999999.99", "0.01", "999999999999.00")],
)
def test_rounded_quotients(spark, top, bottom, expected):
    row = spark.createDataFrame(
        [(top and D(top), bottom and D(bottom))], "a decimal(12,2), b decimal(12,2)"
    ).select(E.half_up_quotient(F.col("a"), F.col("b"))).first()
    assert row[0] == (expected and D(expected))


def test_supplier_price_audit_counts_a_rise_from_zero_as_full(spark):
    schema = "product_id int, supplier_id int, last_purchase_price decimal(12,2)"
    before = spark.createDataFrame([(1, 1, D(0)), (2, 1, D(10)), (3, 1, None), (4, 1, D(5))], schema)
    after = spark.createDataFrame([(1, 1, D(3)), (2, 1, D("7.5")), (3, 1, D(4)), (4, 1, D(5))], schema)
    assert rows(audit.supplier_price_audit(before, after), "product_id", "change_percent") == [
        (1, D("100.00")),
        (2, D("-25.00")),
    ]


def test_literal_text_search(spark):
    names = spark.createDataFrame([("50% off",), ("50 off",), ("a_b",), ("axb",), ("Off 50%",)], "name string")
    assert rows(names.filter(E.contains_text("name", "50%"))) == [("50% off",), ("Off 50%",)]
    assert rows(names.filter(E.contains_text("name", "A_B"))) == [("a_b",)]


def test_rows_are_appended_and_versions_kept(spark, tmp_path):
    path = str(tmp_path / "table")
    rows_ = spark.createDataFrame([(1,), (2,)], "id int")
    tables.write_snapshot(rows_, path)
    tables.append_rows(rows_, path)
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_snapshot(rows_, path)


def test_staged_tables_live_in_the_shared_folder_and_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "shared_folder", lambda _: str(tmp_path))
    staged = tables.stage(spark.range(5).toDF("n"))
    assert staged.inputFiles()[0].startswith(f"file://{tmp_path}")
    assert staged.count() == 5
    tables.drop_staged(spark)
    assert list(tmp_path.iterdir()) == []


def test_the_folder_the_cluster_names_is_used(monkeypatch):
    class Session:
        conf = {"spark.checkpoint.dir": "hdfs:///work/"}

        class sparkContext:  # noqa: N801
            master = "spark://host"

    assert tables.shared_folder(Session) == "hdfs:///work"
    Session.conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        tables.shared_folder(Session)
