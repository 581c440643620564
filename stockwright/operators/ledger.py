"""Stock derived from the movement ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwright.functions import wording as W
from stockwright.functions.expressions import BALANCE, first_failure, signed_qty

CELL = ["product_id", "warehouse_id"]


def current_stock(movement: DataFrame) -> DataFrame:
    """Stock of every (product, warehouse) cell that ever moved. Partial sums run before the shuffle."""
    return movement.groupBy(*CELL).agg(F.sum(signed_qty()).cast(BALANCE).alias("stock"))


def stock_of(requests: DataFrame, movement: DataFrame, product: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Requested cells with their stock: 0 where nothing moved, a reason where the cell does not exist."""
    known_product = product.select(F.col("id").alias("product_id"), F.lit(True).alias("_product"))
    known_warehouse = warehouse.select(F.col("id").alias("warehouse_id"), F.lit(True).alias("_warehouse"))
    reason = first_failure(
        [
            (W.NO_PRODUCT, F.col("_product").isNull()),
            (W.NO_WAREHOUSE, F.col("_warehouse").isNull()),
        ]
    )
    return (
        requests.join(known_product, "product_id", "left")
        .join(known_warehouse, "warehouse_id", "left")
        .join(current_stock(movement), CELL, "left")
        .withColumn("reason", reason)
        .withColumn("stock", F.when(F.col("reason").isNull(), F.coalesce("stock", F.lit(0).cast(BALANCE))))
        .drop("_product", "_warehouse")
    )


def availability(requests: DataFrame, movement: DataFrame, product: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Adds whether the stock of a requested cell covers the required quantity."""
    return stock_of(requests, movement, product, warehouse).withColumn(
        "available", F.col("stock") >= F.col("required")
    )


def warehouse_value(movement: DataFrame, product: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Worth of the active products in each warehouse at list price."""
    active = product.filter("is_active").select(F.col("id").alias("product_id"), "default_price")
    value = (
        current_stock(movement)
        .join(active, "product_id")
        .groupBy("warehouse_id")
        .agg(F.sum(F.col("stock") * F.col("default_price")).alias("_value"))
    )
    return warehouse.join(value, warehouse.id == value.warehouse_id, "left").select(
        warehouse.id.alias("warehouse_id"),
        warehouse.name.alias("warehouse_name"),
        F.coalesce("_value", F.lit(0)).cast("decimal(24,2)").alias("total_value"),
    )


def stock_in(product: DataFrame, movement: DataFrame, warehouse_id: int) -> DataFrame:
    """Every given product with its stock in one warehouse; no grid is built."""
    stock = (
        current_stock(movement.filter(F.col("warehouse_id") == warehouse_id))
        .drop("warehouse_id")
        .withColumnRenamed("product_id", "id")
        .withColumnRenamed("stock", "current_stock")
    )
    return product.join(stock, "id", "left").withColumn(
        "current_stock", F.coalesce("current_stock", F.lit(0).cast(BALANCE))
    )
