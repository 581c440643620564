"""The trade data model as SQL, for checking results with a second engine.

Common table expressions over the stored tables; a check query appends its own SELECT.
"""

# seq numbers all lines in the total order of document lines.
MODEL = """
WITH RECURSIVE
m_site AS (
  SELECT s_suppkey, CAST(n_regionkey AS BIGINT) AS warehouse_id
  FROM supplier JOIN nation ON n_nationkey = s_nationkey
),
m_raw AS (
  SELECT l.*, site.warehouse_id,
    CAST(l_quantity AS DECIMAL(12,2)) AS qty,
    CAST(((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
          // (2 * CAST(l_quantity AS BIGINT))) * 0.01 AS DECIMAL(12,2)) AS unit_price,
    row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
      l_extendedprice, l_returnflag, l_linestatus, l_discount, l_tax) AS seq
  FROM lineitem l JOIN m_site site ON site.s_suppkey = l.l_suppkey
),
m_line AS (
  SELECT *, l_partkey AS product_id, CAST(qty * unit_price AS DECIMAL(12,2)) AS line_total,
    l_orderkey || '/' || l_suppkey AS purchase_id, CAST(l_orderkey AS VARCHAR) AS sale_id
  FROM m_raw
),
m_category AS (SELECT DISTINCT p_brand AS id, p_brand AS name FROM part),
m_unit AS (SELECT DISTINCT p_type AS id, p_type AS name FROM part),
m_supplier AS (
  SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS contact_email, CAST(NULL AS VARCHAR) AS phone,
    s_acctbal >= 0 AS is_active
  FROM supplier
),
m_warehouse AS (
  SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, r_regionkey <> 4 AS is_active FROM region
),
m_product AS (
  SELECT p_partkey AS id, 'SKU-' || p_partkey AS sku, p_name AS name, p_brand AS category_id, p_type AS unit_id,
    CAST(p_retailprice AS DECIMAL(12,2)) AS default_price, CAST(p_size AS DECIMAL(12,2)) AS min_stock_level,
    CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size * 3 + 10 AS DECIMAL(12,2)) END AS max_stock_level,
    p_partkey % 20 <> 0 AS is_active
  FROM part
),
m_purchase_line AS (
  SELECT purchase_id AS purchase_invoice_id, product_id, qty, unit_price, line_total, warehouse_id, seq,
    l_suppkey AS supplier_id, l_orderkey, l_linenumber, l_shipdate, l_quantity, l_tax
  FROM m_line WHERE l_returnflag = 'N'
),
m_sales_line AS (
  SELECT sale_id AS sales_invoice_id, product_id, qty, unit_price, line_total, warehouse_id, seq,
    l_orderkey, l_linenumber, l_quantity, l_tax
  FROM m_line WHERE l_returnflag = 'A'
),
m_purchase_invoice AS (
  SELECT h.id, h.supplier_id, 'PUR-' || h.id AS invoice_no, CAST(o_orderdate AS DATE) AS date,
    CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'DRAFT' ELSE 'CANCELLED' END AS status,
    h.total_amount, o_orderdate AS created_at, o_orderpriority, o_custkey
  FROM (SELECT purchase_invoice_id AS id, l_orderkey, supplier_id, SUM(line_total) AS total_amount
        FROM m_purchase_line GROUP BY ALL) h
  JOIN orders ON o_orderkey = h.l_orderkey
),
m_sales_invoice AS (
  SELECT h.id, c_name AS customer_name, 'SALE-' || h.id AS invoice_no, CAST(o_orderdate AS DATE) AS date,
    CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'DRAFT' ELSE 'SHIPPED' END AS status,
    h.total_amount, o_orderdate AS created_at, o_orderpriority
  FROM (SELECT sales_invoice_id AS id, l_orderkey, SUM(line_total) AS total_amount FROM m_sales_line GROUP BY ALL) h
  JOIN orders ON o_orderkey = h.l_orderkey JOIN customer ON c_custkey = o_custkey
),
m_movement AS (
  SELECT product_id, warehouse_id,
    CASE l_returnflag WHEN 'N' THEN 'IN' WHEN 'A' THEN 'OUT' ELSE 'ADJUST' END AS movement_type,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -qty ELSE qty END AS qty,
    CASE l_returnflag WHEN 'N' THEN 'purchase' WHEN 'A' THEN 'sale' ELSE 'adjustment' END AS related_type,
    CASE WHEN l_returnflag = 'N' THEN purchase_id ELSE sale_id END AS related_id,
    CASE l_returnflag WHEN 'N' THEN 'purchase' WHEN 'A' THEN 'sale' ELSE 'adjustment' END || ' ' || l_orderkey AS note,
    l_shipdate AS created_at, seq
  FROM m_line
),
m_signed AS (
  SELECT *, CASE movement_type WHEN 'IN' THEN qty WHEN 'OUT' THEN -qty WHEN 'ADJUST' THEN qty ELSE 0 END AS delta
  FROM m_movement
),
m_stock AS (
  SELECT product_id, warehouse_id, CAST(SUM(delta) AS DECIMAL(12,2)) AS stock
  FROM m_signed GROUP BY product_id, warehouse_id
),
m_opening AS (
  SELECT product_id, warehouse_id, CAST(SUM(qty) AS DECIMAL(12,2)) AS stock
  FROM m_movement WHERE movement_type = 'IN' GROUP BY product_id, warehouse_id
),
m_offer AS (
  SELECT product_id, supplier_id, arg_max(unit_price, seq) AS last_purchase_price,
    MIN(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS lead_time_days
  FROM m_purchase_line JOIN orders ON o_orderkey = l_orderkey
  GROUP BY product_id, supplier_id
),
m_product_supplier AS (
  SELECT product_id, supplier_id, supplier_id || '-' || product_id AS supplier_sku, lead_time_days,
    last_purchase_price, lead_time_days <= 30 AS is_preferred
  FROM m_offer
),
m_alert AS (
  SELECT m.product_id, m.warehouse_id, CAST(SUM(delta) AS DECIMAL(12,2)) AS current_stock, p.min_stock_level,
    MAX(created_at) AS alert_date, SUM(delta) > p.min_stock_level AS is_resolved
  FROM m_signed m JOIN m_product p ON p.id = m.product_id WHERE p.is_active
  GROUP BY m.product_id, m.warehouse_id, p.min_stock_level
),
m_change AS (
  SELECT p_partkey AS id, CAST(p_retailprice AS DECIMAL(12,2)) AS old_price,
    CAST(((2 * CAST(round(p_retailprice * 100) AS BIGINT) * (100 + p_partkey % 61 - 30) + 100) // 200) * 0.01
      AS DECIMAL(12,2)) AS new_price,
    CAST(p_size - 3 AS DECIMAL(12,2)) AS new_min,
    CASE WHEN p_partkey % 7 = 0 THEN CAST(p_size - 3 AS DECIMAL(12,2))
      WHEN p_partkey % 4 <> 0 THEN CAST(p_size * 3 + 10 AS DECIMAL(12,2)) END AS new_max,
    p_partkey % 20 <> 0 AS old_active, p_partkey % 20 <> 0 AND p_partkey % 11 <> 0 AS new_active
  FROM part
),
m_purchase_change AS (
  SELECT id, invoice_no, supplier_id, status,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'CONFIRMED' WHEN '2-HIGH' THEN 'CANCELLED' ELSE status END AS new_status,
    supplier_id + CASE WHEN o_custkey % 10 = 0 THEN 1 ELSE 0 END AS new_supplier_id
  FROM m_purchase_invoice
),
m_sales_change AS (
  SELECT id, invoice_no, customer_name, status,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'CONFIRMED' WHEN '2-HIGH' THEN 'CANCELLED' ELSE status END AS new_status
  FROM m_sales_invoice
),
m_event AS (
  SELECT user_id AS product_id, CAST(1 AS BIGINT) AS warehouse_id,
    CASE event_type WHEN 'signup' THEN 'IN' WHEN 'purchase' THEN 'OUT' ELSE 'ADJUST' END AS movement_type,
    CASE WHEN event_type = 'signup' THEN 1 ELSE -1 END * CAST(value AS DECIMAL(12,2)) AS delta, ts AS created_at,
    row_number() OVER (ORDER BY ts, event_id) AS seq
  FROM events WHERE event_type IN ('signup', 'purchase', 'error')
)
"""


def half_up(numerator: str, denominator: str) -> str:
    """ROUND(numerator / denominator, 2) of two-decimal amounts on whole cents, as DOUBLE."""
    top = f"CAST(({numerator}) * 100 AS HUGEINT)"
    bottom = f"CAST(({denominator}) * 100 AS HUGEINT)"
    return (
        f"CAST((CASE WHEN ({top} < 0) <> ({bottom} < 0) THEN -1 ELSE 1 END) * "
        f"((200 * abs({top}) + abs({bottom})) // NULLIF(2 * abs({bottom}), 0)) AS DOUBLE) / 100"
    )


def percent(old: str, new: str) -> str:
    return half_up(f"(({new}) - ({old})) * 100", old)


def status(stock: str) -> str:
    return (
        f"CASE WHEN {stock} <= p.min_stock_level THEN 'LOW' "
        f"WHEN p.max_stock_level IS NOT NULL AND {stock} >= p.max_stock_level * 0.9 THEN 'HIGH' ELSE 'NORMAL' END"
    )
