"""The trade data model (documents, ledger, dimensions) derived from stored order tables.

Every property is a lazy DataFrame; Catalyst prunes the columns and joins a query does not use.

Document ids are text: an order split by supplier makes one purchase document per (order, supplier),
and no single integer holds both keys at any scale.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwright.functions import wording as W
from stockwright.functions.expressions import BALANCE, MONEY, line_total, money, signed_qty
from stockwright.operators.audit import price_audit
from stockwright.operators.ledger import current_stock
from stockwright.sources.tables import read_table

# Total order of document lines. Rows that tie on all of it are identical.
LINE_ORDER = (
    "l_shipdate",
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_returnflag",
    "l_linestatus",
    "l_discount",
    "l_tax",
)

# Day the reports are drawn up, just after the last movement of the test tables.
AS_OF = date(2001, 11, 4)

PURCHASE, SALE, ADJUSTMENT = "N", "A", "R"


class TradeData:
    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def base(self, name: str) -> DataFrame:
        return read_table(self.spark, self.directory, name)

    # Dimensions

    @cached_property
    def category(self) -> DataFrame:
        return self.base("part").select(F.col("p_brand").alias("id"), F.col("p_brand").alias("name")).distinct()

    @cached_property
    def unit(self) -> DataFrame:
        return self.base("part").select(F.col("p_type").alias("id"), F.col("p_type").alias("name")).distinct()

    @cached_property
    def supplier(self) -> DataFrame:
        return self.base("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            F.lit(None).cast("string").alias("contact_email"),
            F.lit(None).cast("string").alias("phone"),
            (F.col("s_acctbal") >= 0).alias("is_active"),
        )

    @cached_property
    def warehouse(self) -> DataFrame:
        return self.base("region").select(
            F.col("r_regionkey").cast("bigint").alias("id"),
            F.col("r_name").alias("name"),
            (F.col("r_regionkey") != 4).alias("is_active"),
        )

    @cached_property
    def product(self) -> DataFrame:
        size = F.col("p_size")
        return self.base("part").select(
            F.col("p_partkey").alias("id"),
            F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("category_id"),
            F.col("p_type").alias("unit_id"),
            money("p_retailprice").alias("default_price"),
            money(size).alias("min_stock_level"),
            _max_level().alias("max_stock_level"),
            (F.col("p_partkey") % 20 != 0).alias("is_active"),
        )

    @cached_property
    def product_supplier(self) -> DataFrame:
        """Who delivers what, from all purchase lines."""
        lines = self._items(PURCHASE, extra=["l_shipdate", "l_orderkey"])
        orders = self.base("orders").select("o_orderkey", "o_orderdate")
        return (
            lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .groupBy("product_id", "supplier_id")
            .agg(
                F.max_by("unit_price", "seq").alias("last_purchase_price"),
                F.min(F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))).alias("lead_time_days"),
            )
            .select(
                "product_id",
                "supplier_id",
                F.concat_ws("-", F.col("supplier_id").cast("string"), F.col("product_id").cast("string")).alias(
                    "supplier_sku"
                ),
                "lead_time_days",
                "last_purchase_price",
                (F.col("lead_time_days") <= 30).alias("is_preferred"),
            )
        )

    # Documents

    @cached_property
    def purchase_items(self) -> DataFrame:
        """Purchase lines without their warehouse, which costs a join."""
        return self._items(PURCHASE).drop("supplier_id")

    @cached_property
    def purchase_line(self) -> DataFrame:
        return self._items(PURCHASE, warehouse=True).drop("supplier_id")

    @cached_property
    def sales_items(self) -> DataFrame:
        return self._items(SALE).drop("supplier_id").withColumnRenamed("purchase_invoice_id", "sales_invoice_id")

    @cached_property
    def sales_line(self) -> DataFrame:
        return self._items(SALE, warehouse=True).drop("supplier_id").withColumnRenamed(
            "purchase_invoice_id", "sales_invoice_id"
        )

    @cached_property
    def purchase_invoice(self) -> DataFrame:
        return self._purchase_headers().select(
            "id", "supplier_id", "invoice_no", "date", "status", "total_amount", "created_at"
        )

    @cached_property
    def sales_invoice(self) -> DataFrame:
        return self._sales_headers().select(
            "id", "customer_name", "invoice_no", "date", "status", "total_amount", "created_at"
        )

    @cached_property
    def inventory_movement(self) -> DataFrame:
        flag = F.col("l_returnflag")
        kind = F.when(flag == PURCHASE, "IN").when(flag == SALE, "OUT").otherwise("ADJUST")
        qty = money("l_quantity")
        lost = (flag == ADJUSTMENT) & (F.col("l_linestatus") == "F")
        related = F.when(flag == PURCHASE, "purchase").when(flag == SALE, "sale").otherwise("adjustment")
        return self._at_warehouse(self.base("lineitem")).select(
            F.col("l_partkey").alias("product_id"),
            "warehouse_id",
            kind.alias("movement_type"),
            F.when(lost, -qty).otherwise(qty).cast(MONEY).alias("qty"),
            related.alias("related_type"),
            F.when(flag == PURCHASE, _purchase_id()).otherwise(F.col("l_orderkey").cast("string")).alias("related_id"),
            F.concat_ws(" ", related, F.col("l_orderkey").cast("string")).alias("note"),
            F.col("l_shipdate").alias("created_at"),
            F.struct(*LINE_ORDER).alias("seq"),
        )

    @cached_property
    def low_stock_alerts(self) -> DataFrame:
        """One alert per (product, warehouse) of an active product, open while stock is low."""
        return self._alerts(self.inventory_movement)

    def low_stock_alerts_before(self, day: date) -> DataFrame:
        """The alerts as they stood when only movements before a day were known."""
        return self._alerts(self.inventory_movement.filter(F.col("created_at") < F.lit(day)))

    def _alerts(self, movement: DataFrame) -> DataFrame:
        latest = movement.groupBy("product_id", "warehouse_id").agg(
            F.sum(signed_qty()).cast(BALANCE).alias("current_stock"), F.max("created_at").alias("alert_date")
        )
        product = self.product.filter("is_active").select(F.col("id").alias("product_id"), "min_stock_level")
        resolved = F.col("current_stock") > F.col("min_stock_level")
        return latest.join(product, "product_id").select(
            "product_id",
            "warehouse_id",
            "current_stock",
            "min_stock_level",
            "alert_date",
            resolved.alias("is_resolved"),
            F.when(resolved, F.col("alert_date")).alias("resolved_at"),
            F.when(resolved, F.lit(W.REPLENISHED)).alias("resolved_by"),
        )

    @cached_property
    def price_audit_log(self) -> DataFrame:
        """Audit rows of the requested price changes, spread over the month before ``AS_OF``."""
        audited = price_audit(self.product, self.product_changes)
        return audited.withColumn("changed_at", F.date_sub(F.lit(AS_OF), (F.col("product_id") % 30).cast("int")))

    # Requested changes

    @cached_property
    def product_changes(self) -> DataFrame:
        """New prices, levels and activity asked for each product."""
        key = F.col("p_partkey")
        price = F.round(F.col("p_retailprice") * 100).cast("bigint")
        rate = 100 + key % 61 - 30
        new_price = F.call_function("div", 2 * price * rate + 100, F.lit(200)) * F.lit("0.01").cast("decimal(3,2)")
        new_min = money(F.col("p_size") - 3)
        return self.base("part").select(
            key.alias("id"),
            new_price.cast(MONEY).alias("new_price"),
            new_min.alias("new_min"),
            F.when(key % 7 == 0, new_min).otherwise(_max_level()).alias("new_max"),
            ((key % 20 != 0) & (key % 11 != 0)).alias("new_active"),
        )

    @cached_property
    def purchase_status_changes(self) -> DataFrame:
        headers = self._purchase_headers()
        return headers.select(
            "id",
            "invoice_no",
            "supplier_id",
            "status",
            _new_status().alias("new_status"),
            (F.col("supplier_id") + F.when(F.col("o_custkey") % 10 == 0, 1).otherwise(0)).alias("new_supplier_id"),
        )

    @cached_property
    def sales_status_changes(self) -> DataFrame:
        return self._sales_headers().select(
            "id", "invoice_no", "customer_name", "status", _new_status().alias("new_status")
        )

    @cached_property
    def urgent_purchases(self) -> DataFrame:
        """Ids of the purchase documents that are to be confirmed at once."""
        return self._purchase_headers().filter(F.col("o_orderpriority") == "1-URGENT").select("id")

    def line_requests(self, flag: str) -> DataFrame:
        """Lines as asked for by a user: some quantities and prices break the rules."""
        price = F.when(F.col("l_tax") == 0, F.lit(0).cast(MONEY)).otherwise(_unit_price())
        return self._items(
            flag, warehouse=True, qty=money(F.col("l_quantity") - 2), price=price, extra=["l_orderkey", "l_linenumber"]
        )

    @cached_property
    def movement_requests(self) -> DataFrame:
        """The ledger as a batch of requests, with two units less in each."""
        return self.inventory_movement.withColumn(
            "qty",
            F.when(F.col("qty") < 0, F.col("qty") + 2).otherwise(F.col("qty") - 2).cast(MONEY),
        )

    @cached_property
    def opening_stock(self) -> DataFrame:
        """Everything ever received, before any sale."""
        return current_stock(self.inventory_movement.filter(F.col("movement_type") == "IN"))

    # Streams

    @cached_property
    def event_movements(self) -> DataFrame:
        return movements_of_events(self.base("events"))

    # Shared parts

    def _items(
        self,
        flag: str,
        warehouse: bool = False,
        qty: Column | None = None,
        price: Column | None = None,
        extra: list[str] | None = None,
    ) -> DataFrame:
        rows = self.base("lineitem").filter(F.col("l_returnflag") == flag)
        if warehouse:
            rows = self._at_warehouse(rows)
        document = _purchase_id() if flag == PURCHASE else F.col("l_orderkey").cast("string")
        return rows.select(
            document.alias("purchase_invoice_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            (money("l_quantity") if qty is None else qty).alias("qty"),
            (_unit_price() if price is None else price).alias("unit_price"),
            F.struct(*LINE_ORDER).alias("seq"),
            *(["warehouse_id"] if warehouse else []),
            *(extra or []),
        ).withColumn("line_total", line_total())

    def _at_warehouse(self, lines: DataFrame) -> DataFrame:
        # One join after the other: each is planned by the size of its file, which an estimate of the
        # dimensions joined to each other would hide.
        supplier = self.base("supplier").select("s_suppkey", "s_nationkey")
        nation = self.base("nation").select("n_nationkey", F.col("n_regionkey").cast("bigint").alias("warehouse_id"))
        return (
            lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
            .join(nation, supplier.s_nationkey == nation.n_nationkey)
            .drop("s_suppkey", "s_nationkey", "n_nationkey")
        )

    def _purchase_headers(self) -> DataFrame:
        totals = (
            self._items(PURCHASE, extra=["l_orderkey"])
            .groupBy("l_orderkey", "supplier_id")
            .agg(F.sum("line_total").alias("total_amount"))
        )
        orders = self.base("orders")
        key = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("supplier_id").cast("string"))
        return (
            totals.join(orders, totals.l_orderkey == orders.o_orderkey)
            .withColumn("id", key)
            .withColumn("invoice_no", F.concat(F.lit("PUR-"), F.col("id")))
            .withColumn("date", F.to_date("o_orderdate"))
            .withColumn("created_at", F.col("o_orderdate"))
            .withColumn("status", _status("CANCELLED"))
        )

    def _sales_headers(self) -> DataFrame:
        totals = (
            self._items(SALE, extra=["l_orderkey"])
            .groupBy("l_orderkey")
            .agg(F.sum("line_total").alias("total_amount"))
        )
        orders = self.base("orders")
        customer = self.base("customer").select("c_custkey", F.col("c_name").alias("customer_name"))
        return (
            totals.join(orders, totals.l_orderkey == orders.o_orderkey)
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .withColumn("id", F.col("l_orderkey").cast("string"))
            .withColumn("invoice_no", F.concat(F.lit("SALE-"), F.col("id")))
            .withColumn("date", F.to_date("o_orderdate"))
            .withColumn("created_at", F.col("o_orderdate"))
            .withColumn("status", _status("SHIPPED"))
        )


def movements_of_events(events: DataFrame) -> DataFrame:
    """Stock movements carried by an event feed: one product per user, one warehouse."""
    kind = F.col("event_type")
    value = money("value")
    return events.filter(kind.isin("signup", "purchase", "error")).select(
        F.col("user_id").alias("product_id"),
        F.lit(1).cast("bigint").alias("warehouse_id"),
        F.when(kind == "signup", "IN").when(kind == "purchase", "OUT").otherwise("ADJUST").alias("movement_type"),
        F.when(kind == "error", -value).otherwise(value).cast(MONEY).alias("qty"),
        F.col("ts").alias("created_at"),
        F.struct("ts", "event_id").alias("seq"),
    )


def prices_of_events(events: DataFrame) -> DataFrame:
    """Price quotations carried by the view events of a feed: one product per user."""
    return events.filter(F.col("event_type") == "view").select(
        F.col("user_id").alias("product_id"),
        money("value").alias("price"),
        F.col("ts").alias("changed_at"),
        F.struct("ts", "event_id").alias("seq"),
    )


def _purchase_id() -> Column:
    return F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string"))


def _unit_price() -> Column:
    """Half-up cents of extended price over quantity, in whole numbers."""
    qty = F.col("l_quantity").cast("bigint")
    total = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    cents = F.call_function("div", 2 * total + qty, 2 * qty)
    return (cents * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def _max_level() -> Column:
    return F.when(F.col("p_partkey") % 4 != 0, money(F.col("p_size") * 3 + 10))


def _status(other: str) -> Column:
    state = F.col("o_orderstatus")
    return F.when(state == "F", "CONFIRMED").when(state == "O", "DRAFT").otherwise(other)


def _new_status() -> Column:
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", "CONFIRMED").when(priority == "2-HIGH", "CANCELLED").otherwise(F.col("status"))
    )
