"""Check queries for table changes, rules, commands, alerts and audits."""

from stockwright.functions import wording as W
from stockwright.plans.oracle_model import percent

D = "CAST({} AS DOUBLE) AS {}".format


def first_failure(*rules: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {condition} THEN '{reason}'" for reason, condition in rules) + " END"


_QTY_PRICE = (
    (W.NO_QTY, "l.qty <= 0"),
    (W.NO_PRICE, "l.unit_price <= 0"),
)
_ASKED = """
CAST(l_quantity - 2 AS DECIMAL(12,2)) AS qty,
CAST(CASE WHEN l_tax = 0 THEN 0 ELSE unit_price END AS DECIMAL(12,2)) AS unit_price
"""


def _asked(source: str, key: str) -> str:
    return f"""asked AS MATERIALIZED (
  SELECT {key}, product_id, warehouse_id, seq, l_orderkey, l_linenumber, {_ASKED} FROM {source}
)"""


def _competition(level: str, delta: str, guarded: str, more: str = "", n: str = "") -> str:
    """Walks the rows of ``checked`` without a reason, cell by cell in seq order; ``n`` follows the names."""
    step = f"NOT ({guarded}) OR {{level}} + ({delta}) >= 0"
    first, then = step.format(level=level), step.format(level="w.level")
    return f"""
, runner{n} AS MATERIALIZED (
  SELECT l.*, row_number() OVER (PARTITION BY l.product_id, l.warehouse_id ORDER BY l.seq) AS rn {more}
  FROM checked{n} l WHERE reason IS NULL
), walk{n} AS (
  SELECT l.seq, l.product_id, l.warehouse_id, l.rn, {first} AS accepted,
    CAST({level} + CASE WHEN {first} THEN {delta} ELSE 0 END AS DECIMAL(18,2)) AS level
  FROM runner{n} l LEFT JOIN opening o ON o.product_id = l.product_id AND o.warehouse_id = l.warehouse_id WHERE l.rn = 1
  UNION ALL
  SELECT l.seq, l.product_id, l.warehouse_id, l.rn, {then} AS accepted,
    CAST(w.level + CASE WHEN {then} THEN {delta} ELSE 0 END AS DECIMAL(18,2)) AS level
  FROM walk{n} w JOIN runner{n} l ON l.product_id = w.product_id AND l.warehouse_id = w.warehouse_id AND l.rn = w.rn + 1
)"""


def _sale_batch(rounds: int = 6) -> str:
    """Sales in seq order: a number is taken once an earlier sale was accepted with it.

    Each round walks the stock for those that may try and lets the next round try those that no accepted earlier sale
    bars. ``outcome`` is empty unless the last round agrees with the one before: then every decision fits all earlier
    ones, which holds for the result of a plain loop over seq and for no other.
    """
    parts = [
        f"""
, {_asked('m_sales_line', 'sales_invoice_id')}, sound AS MATERIALIZED (
  SELECT l.*, 'S-' || l_orderkey || '-' || l_linenumber AS invoice_no, p.min_stock_level,
    {first_failure(*_QTY_PRICE, (W.PRODUCT_INACTIVE, "NOT p.is_active"),
                   (W.WAREHOUSE_INACTIVE, "NOT w.is_active"))} AS refused
  FROM asked l JOIN m_product p ON p.id = l.product_id JOIN m_warehouse w ON w.id = l.warehouse_id
), opening AS MATERIALIZED (SELECT * FROM m_opening)
, holder0 AS MATERIALIZED (SELECT invoice_no, MIN(seq) AS holder FROM sound WHERE refused IS NULL GROUP BY 1)
"""
    ]
    for k in range(1, rounds + 1):
        tries = "s.seq = h.holder" if k == 1 else "h.holder IS NULL OR s.seq <= h.holder"
        parts.append(
            f"""
, checked{k} AS MATERIALIZED (
  SELECT s.*, COALESCE(refused, CASE WHEN NOT ({tries}) THEN '{W.NUMBER_TAKEN}' END) AS reason
  FROM sound s LEFT JOIN holder{k - 1} h ON h.invoice_no = s.invoice_no
)
{_competition("COALESCE(o.stock, 0)", "-l.qty", "TRUE", n=str(k))}
, holder{k} AS MATERIALIZED (
  SELECT l.invoice_no, MIN(CASE WHEN w.accepted THEN l.seq END) AS holder
  FROM checked{k} l LEFT JOIN walk{k} w ON w.seq = l.seq WHERE l.refused IS NULL GROUP BY 1
)
"""
        )
    parts.append(
        f"""
, outcome AS MATERIALIZED (
  SELECT l.*, COALESCE(l.reason, CASE WHEN NOT w.accepted THEN '{W.NO_STOCK}' END) AS final,
    CASE WHEN w.accepted THEN w.level END AS stock_after
  FROM checked{rounds} l LEFT JOIN walk{rounds} w ON w.seq = l.seq
  WHERE NOT EXISTS (
    SELECT 1 FROM holder{rounds} a JOIN holder{rounds - 1} b ON a.invoice_no = b.invoice_no
    WHERE a.holder IS DISTINCT FROM b.holder)
)
"""
    )
    return "".join(parts)


_SALE_BATCH = _sale_batch()

_PURCHASE_BATCH = f"""
, {_asked('m_purchase_line', 'purchase_invoice_id')}, checked AS MATERIALIZED (
  SELECT l.*, p.max_stock_level,
    {first_failure(*_QTY_PRICE, (W.PRODUCT_UNUSABLE, "NOT p.is_active"),
                   (W.WAREHOUSE_UNUSABLE, "NOT w.is_active"),
                   (W.LINE_CLOSED, "i.status <> 'DRAFT'"))} AS reason
  FROM asked l JOIN m_product p ON p.id = l.product_id JOIN m_warehouse w ON w.id = l.warehouse_id
  JOIN m_purchase_invoice i ON i.id = l.purchase_invoice_id
), opening AS MATERIALIZED (SELECT * FROM m_stock)
{_competition("COALESCE(l.max_stock_level, 0) - COALESCE(o.stock, 0)", "-l.qty", "l.max_stock_level IS NOT NULL")}
"""

_ADJUST_BATCH = f"""
, checked AS MATERIALIZED (
  SELECT m.*, p.min_stock_level, CAST(NULL AS VARCHAR) AS reason
  FROM m_movement m JOIN m_product p ON p.id = m.product_id WHERE movement_type = 'ADJUST'
), opening AS MATERIALIZED (SELECT * FROM m_opening)
{_competition("COALESCE(o.stock, 0)", "l.qty", "TRUE")}
, outcome AS (
  SELECT l.*, CASE WHEN NOT walk.accepted THEN '{W.UNDER_ZERO}' END AS final,
    CASE WHEN walk.accepted THEN walk.level END AS stock_after
  FROM checked l LEFT JOIN walk ON walk.seq = l.seq
)
"""
_ADJUST_ACTIVE = f"""
, checked AS MATERIALIZED (
  SELECT m.*, p.min_stock_level,
    {first_failure((W.NO_PRODUCT, "NOT p.is_active"), (W.NO_WAREHOUSE, "NOT w.is_active"))} AS reason
  FROM m_movement m JOIN m_product p ON p.id = m.product_id JOIN m_warehouse w ON w.id = m.warehouse_id
  WHERE movement_type = 'ADJUST'
), outcome AS (
  SELECT c.*, CASE WHEN reason IS NULL THEN CAST(COALESCE(o.stock, 0) + SUM(CASE WHEN reason IS NULL THEN qty END)
    OVER (PARTITION BY c.product_id, c.warehouse_id ORDER BY seq) AS DECIMAL(12,2)) END AS stock_after
  FROM checked c LEFT JOIN m_opening o ON o.product_id = c.product_id AND o.warehouse_id = c.warehouse_id
)
"""


def _movement_batch(rules: str, guarded: str) -> str:
    return f"""
, asked AS MATERIALIZED (
  SELECT product_id, warehouse_id, movement_type, related_id, seq,
    CAST(CASE WHEN qty < 0 THEN qty + 2 ELSE qty - 2 END AS DECIMAL(12,2)) AS qty FROM m_movement
), checked AS MATERIALIZED (
  SELECT l.*, CASE movement_type WHEN 'OUT' THEN -qty ELSE qty END AS delta, {rules} AS reason
  FROM asked l JOIN m_product p ON p.id = l.product_id JOIN m_warehouse w ON w.id = l.warehouse_id
), opening AS MATERIALIZED (SELECT * FROM m_stock WHERE FALSE)
{_competition("COALESCE(o.stock, 0)", "l.delta", guarded)}
SELECT l.product_id, l.warehouse_id, l.movement_type, l.related_id, {D('l.qty', 'qty')},
  COALESCE(l.reason, CASE WHEN NOT walk.accepted THEN CASE WHEN l.movement_type = 'OUT' THEN '{W.NO_STOCK}'
    ELSE '{W.UNDER_ZERO}' END END) AS reason,
  {D('CASE WHEN walk.accepted THEN walk.level END', 'stock_after')}
FROM checked l LEFT JOIN walk ON walk.seq = l.seq
"""


_LATEST_PRICE = """
, latest AS (
  SELECT pl.product_id, pi.supplier_id, arg_max(pl.unit_price, pl.seq) AS price
  FROM m_purchase_line pl JOIN m_purchase_invoice pi ON pi.id = pl.purchase_invoice_id
  WHERE pi.status = 'CONFIRMED' GROUP BY 1, 2
)
"""

_PURCHASE_CHANGES = f"""
, judged AS (
  SELECT l.*, {first_failure(
      (W.PURCHASE_FIXED, "l.status <> 'DRAFT' AND l.new_status <> l.status"),
      (W.SUPPLIER_FIXED,
       "l.status <> 'DRAFT' AND l.new_supplier_id <> l.supplier_id"))} AS reason
  FROM m_purchase_change l
), confirmed AS (
  SELECT id, new_supplier_id AS supplier_id, invoice_no FROM judged
  WHERE reason IS NULL AND status <> 'CONFIRMED' AND new_status = 'CONFIRMED'
)
"""

_SALES_CHANGES = f"""
, shortage AS (
  SELECT sl.sales_invoice_id AS id, COUNT(*) FILTER (COALESCE(st.stock, 0) < sl.qty) AS short_lines
  FROM m_sales_line sl LEFT JOIN m_stock st ON st.product_id = sl.product_id AND st.warehouse_id = sl.warehouse_id
  GROUP BY 1
), judged AS (
  SELECT l.*, CASE WHEN l.status = 'DRAFT' AND l.new_status = 'CONFIRMED' THEN s.short_lines END AS short_lines,
    {first_failure(
      (W.SALE_FIXED,
       "l.status <> 'DRAFT' AND l.new_status <> l.status"),
      (W.SALE_SHORT,
       "l.status = 'DRAFT' AND l.new_status = 'CONFIRMED' AND s.short_lines > 0"))} AS reason
  FROM m_sales_change l JOIN shortage s ON s.id = l.id
), confirmed AS (
  SELECT * FROM judged WHERE reason IS NULL AND status <> 'CONFIRMED' AND new_status = 'CONFIRMED'
), cancelled AS (
  SELECT * FROM judged WHERE reason IS NULL AND status <> 'CANCELLED' AND new_status = 'CANCELLED'
)
"""

_SALE_ALERTS = f"""
, booked AS (
  SELECT sl.product_id, sl.warehouse_id, sl.seq, p.min_stock_level, COALESCE(st.stock, 0)
    - SUM(sl.qty) OVER (PARTITION BY sl.product_id, sl.warehouse_id ORDER BY sl.seq) AS left_over
  FROM m_sales_line sl JOIN confirmed c ON c.id = sl.sales_invoice_id JOIN m_product p ON p.id = sl.product_id
  LEFT JOIN m_stock st ON st.product_id = sl.product_id AND st.warehouse_id = sl.warehouse_id
), low AS (
  SELECT *, MIN(seq) OVER (PARTITION BY product_id, warehouse_id) AS first FROM booked WHERE left_over <= min_stock_level
)
SELECT l.product_id, l.warehouse_id, {D('l.left_over', 'current_stock')}, {D('l.min_stock_level', 'min_stock_level')}
FROM low l
"""

_OPEN_BEFORE = """
, earlier AS (
  SELECT m.product_id, m.warehouse_id, CAST(SUM(delta) AS DECIMAL(12,2)) AS current_stock, p.min_stock_level,
    MAX(created_at) AS alert_date, SUM(delta) > p.min_stock_level AS is_resolved
  FROM m_signed m JOIN m_product p ON p.id = m.product_id WHERE p.is_active AND m.created_at < DATE '2000-01-01'
  GROUP BY m.product_id, m.warehouse_id, p.min_stock_level
)
"""

_CLOSED = f"""
SELECT a.product_id, a.warehouse_id, a.is_resolved OR {{hit}} AS is_resolved,
  CASE WHEN NOT a.is_resolved AND {{hit}} THEN '2001-11-04 00:00:00'
    WHEN a.is_resolved THEN CAST(a.alert_date AS VARCHAR) END AS resolved_at,
  CASE WHEN NOT a.is_resolved AND {{hit}} THEN '{{by}}' WHEN a.is_resolved THEN '{W.REPLENISHED}' END AS resolved_by
FROM earlier a
"""


def _timeline(source: str, products: str) -> str:
    return f"""
, running AS (
  SELECT m.product_id, m.warehouse_id, m.created_at, m.seq, p.min_stock_level,
    CAST(SUM(m.delta) OVER cell AS DECIMAL(12,2)) AS current_stock,
    row_number() OVER cell AS position, COUNT(*) OVER (PARTITION BY m.product_id, m.warehouse_id) AS size
  FROM {source} m JOIN {products} p ON p.id = m.product_id
  WINDOW cell AS (PARTITION BY m.product_id, m.warehouse_id ORDER BY m.seq)
), levelled AS (
  SELECT *, current_stock <= min_stock_level AS low,
    MIN(CASE WHEN current_stock > min_stock_level THEN position END)
      OVER (PARTITION BY product_id, warehouse_id ORDER BY position ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS recovery,
    lag(current_stock <= min_stock_level) OVER (PARTITION BY product_id, warehouse_id ORDER BY position) AS was_low
  FROM running
)
"""


_ALERT_ROWS = f"""
SELECT l.product_id, l.warehouse_id, {D('l.current_stock', 'current_stock')},
  {D('l.min_stock_level', 'min_stock_level')}, CAST(l.created_at AS VARCHAR) AS alert_date,
  l.recovery IS NOT NULL AS is_resolved, CAST(r.created_at AS VARCHAR) AS resolved_at
FROM levelled l LEFT JOIN running r
  ON r.product_id = l.product_id AND r.warehouse_id = l.warehouse_id AND r.position = l.recovery
"""

_MOVEMENT_COLUMNS = f"product_id, warehouse_id, movement_type, {D('qty', 'qty')}, related_type, related_id, note"

ORACLES = {
    # Table changes
    "append_rows": f"""
SELECT related_type, COUNT(*) AS movements, {D('SUM(qty)', 'qty')} FROM (
  SELECT related_type, qty FROM m_movement
  UNION ALL
  SELECT 'purchase', pl.qty FROM m_purchase_line pl JOIN m_purchase_invoice pi ON pi.id = pl.purchase_invoice_id
  WHERE pi.status = 'CONFIRMED') GROUP BY related_type""",
    "movements_from_confirmed_purchases": f"""
SELECT pl.product_id, pl.warehouse_id, 'IN' AS movement_type, {D('pl.qty', 'qty')}, 'purchase' AS related_type,
  pi.id AS related_id, '{W.PURCHASE_NOTE}' || s.name || '{W.INVOICE_NOTE}' || pi.invoice_no AS note
FROM m_purchase_line pl JOIN m_purchase_invoice pi ON pi.id = pl.purchase_invoice_id
JOIN m_supplier s ON s.id = pi.supplier_id WHERE pi.status = 'CONFIRMED'""",
    "movements_from_confirmed_sales": f"""
SELECT sl.product_id, sl.warehouse_id, 'OUT' AS movement_type, {D('sl.qty', 'qty')}, 'sale' AS related_type,
  si.id AS related_id, '{W.SALE_NOTE}' || si.customer_name || '{W.INVOICE_NOTE}' || si.invoice_no AS note
FROM m_sales_line sl JOIN m_sales_invoice si ON si.id = sl.sales_invoice_id WHERE si.status = 'CONFIRMED'""",
    "apply_updates": f"""
SELECT p.id, p.sku, {D('CASE WHEN ch.new_active THEN ch.new_price ELSE p.default_price END', 'default_price')},
  {D('CASE WHEN ch.new_active THEN ch.new_min ELSE p.min_stock_level END', 'min_stock_level')},
  {D('CASE WHEN ch.new_active THEN ch.new_max ELSE p.max_stock_level END', 'max_stock_level')}
FROM m_product p JOIN m_change ch ON ch.id = p.id""",
    "refresh_last_purchase_price": _LATEST_PRICE
    + f"""
SELECT ps.product_id, ps.supplier_id, ps.lead_time_days, {D('COALESCE(l.price, ps.last_purchase_price)', 'last_purchase_price')}
FROM m_product_supplier ps LEFT JOIN latest l ON l.product_id = ps.product_id AND l.supplier_id = ps.supplier_id""",
    "upsert_product_supplier": _LATEST_PRICE
    + f"""
SELECT COALESCE(ps.product_id, l.product_id) AS product_id, COALESCE(ps.supplier_id, l.supplier_id) AS supplier_id,
  ps.lead_time_days, COALESCE(ps.is_preferred, FALSE) AS is_preferred,
  {D('COALESCE(l.price, ps.last_purchase_price)', 'last_purchase_price')}
FROM m_product_supplier ps FULL JOIN latest l ON l.product_id = ps.product_id AND l.supplier_id = ps.supplier_id""",
    "upsert_alerts": _OPEN_BEFORE
    + f"""
, low AS (SELECT * FROM m_alert WHERE NOT is_resolved)
SELECT COALESCE(e.product_id, l.product_id) AS product_id, COALESCE(e.warehouse_id, l.warehouse_id) AS warehouse_id,
  {D('COALESCE(l.current_stock, e.current_stock)', 'current_stock')},
  CASE WHEN l.product_id IS NOT NULL THEN '2001-11-04 00:00:00' ELSE CAST(e.alert_date AS VARCHAR) END AS alert_date,
  CASE WHEN l.product_id IS NOT NULL THEN FALSE ELSE e.is_resolved END AS is_resolved,
  {D('COALESCE(e.min_stock_level, l.min_stock_level)', 'min_stock_level')},
  CASE WHEN l.product_id IS NULL AND e.is_resolved THEN CAST(e.alert_date AS VARCHAR) END AS resolved_at,
  CASE WHEN l.product_id IS NULL AND e.is_resolved THEN '{W.REPLENISHED}' END AS resolved_by
FROM earlier e FULL JOIN low l ON l.product_id = e.product_id AND l.warehouse_id = e.warehouse_id""",
    "delete_where": f"""
SELECT {_MOVEMENT_COLUMNS} FROM m_movement m WHERE note NOT LIKE 'sale 1%'""",
    "cancel_sales": _SALES_CHANGES
    + f"""
SELECT {_MOVEMENT_COLUMNS} FROM m_movement m
WHERE NOT (related_type = 'sale' AND related_id IN (SELECT id FROM cancelled))""",
    "cancel_sales_alerts": _SALES_CHANGES
    + f"""
SELECT product_id, warehouse_id, {D('current_stock', 'current_stock')}, is_resolved FROM m_alert
WHERE product_id NOT IN (
  SELECT product_id FROM m_sales_line sl JOIN cancelled c ON c.id = sl.sales_invoice_id)""",
    "assign_ids": f"""
SELECT (SELECT MAX(p_partkey) FROM part) + row_number() OVER (ORDER BY pl.seq) AS id, product_id, {D('qty', 'qty')},
  {D('line_total', 'line_total')}
FROM m_purchase_line pl""",
    "line_totals": f"""
SELECT purchase_invoice_id, product_id, {D('qty', 'qty')}, {D('unit_price', 'unit_price')},
  {D('line_total', 'line_total')}, 'DRAFT' AS status FROM m_purchase_line""",
    "invoice_totals": f"""
SELECT pi.id, pi.invoice_no, {D('COALESCE(SUM(pl.line_total), 0)', 'total_amount')}
FROM m_purchase_invoice pi LEFT JOIN m_purchase_line pl ON pl.purchase_invoice_id = pi.id
GROUP BY pi.id, pi.invoice_no""",
    "cascade_delete": f"""
SELECT ps.product_id, ps.supplier_id, {D('ps.last_purchase_price', 'last_purchase_price')} FROM m_product_supplier ps
WHERE ps.product_id NOT IN (SELECT id FROM m_product WHERE NOT is_active)""",
    "set_null_delete": """
SELECT id, sku, CASE WHEN category_id = 'Brand#2' THEN NULL ELSE category_id END AS category_id FROM m_product""",
    "restrict_delete": """
SELECT s.id, s.name FROM m_supplier s
WHERE NOT s.is_active AND EXISTS (SELECT 1 FROM m_purchase_invoice pi WHERE pi.supplier_id = s.id)""",
    # Stock functions
    "current_stock": f"""
SELECT r.product_id, r.warehouse_id, {D('CASE WHEN p.id IS NOT NULL AND w.id IS NOT NULL THEN COALESCE(st.stock, 0) END', 'stock')},
  CASE WHEN p.id IS NULL THEN '{W.NO_PRODUCT}' WHEN w.id IS NULL THEN '{W.NO_WAREHOUSE}' END AS reason
FROM (SELECT CASE WHEN p_partkey % 50 = 0 THEN -1 ELSE p_partkey END AS product_id, p_partkey % 7 AS warehouse_id FROM part) r
LEFT JOIN m_product p ON p.id = r.product_id LEFT JOIN m_warehouse w ON w.id = r.warehouse_id
LEFT JOIN m_stock st ON st.product_id = r.product_id AND st.warehouse_id = r.warehouse_id""",
    "check_availability": f"""
SELECT l.product_id, l.warehouse_id, {D('l.qty', 'required')}, {D('COALESCE(st.stock, 0)', 'stock')},
  COALESCE(st.stock, 0) >= l.qty AS available
FROM m_sales_line l LEFT JOIN m_stock st ON st.product_id = l.product_id AND st.warehouse_id = l.warehouse_id""",
    "warehouse_total_value": f"""
SELECT w.id AS warehouse_id, w.name AS warehouse_name, {D('COALESCE(SUM(st.stock * p.default_price), 0)', 'total_value')}
FROM m_warehouse w LEFT JOIN (m_stock st JOIN m_product p ON p.id = st.product_id AND p.is_active) ON st.warehouse_id = w.id
GROUP BY w.id, w.name""",
    # Commands
    "process_sales": _SALE_BATCH
    + f"""
SELECT invoice_no, product_id, warehouse_id, {D('qty', 'qty')}, {D('unit_price', 'unit_price')}, final AS reason,
  {D('stock_after', 'stock_after')} FROM outcome""",
    "process_sales_alerts": _SALE_BATCH
    + f"""
SELECT product_id, warehouse_id, {D('stock_after', 'current_stock')}, {D('min_stock_level', 'min_stock_level')}
FROM outcome WHERE final IS NULL AND stock_after < min_stock_level""",
    "process_sales_documents": _SALE_BATCH
    + f"""
SELECT invoice_no, {D('CAST(qty * unit_price AS DECIMAL(12,2))', 'total_amount')}, 'CONFIRMED' AS status
FROM outcome WHERE final IS NULL""",
    "process_sales_lines": _SALE_BATCH
    + f"""
SELECT invoice_no, product_id, warehouse_id, {D('qty', 'qty')}, {D('unit_price', 'unit_price')},
  {D('CAST(qty * unit_price AS DECIMAL(12,2))', 'line_total')} FROM outcome WHERE final IS NULL""",
    "process_sales_movements": _SALE_BATCH
    + f"""
SELECT product_id, warehouse_id, 'OUT' AS movement_type, {D('qty', 'qty')}, 'sale' AS related_type,
  invoice_no AS related_id,
  '{W.SALE_NOTE}Customer of order ' || l_orderkey || '{W.INVOICE_NOTE}' || invoice_no AS note
FROM outcome WHERE final IS NULL""",
    "safe_decrease_stock": f"""
, checked AS MATERIALIZED (SELECT l.*, CAST(NULL AS VARCHAR) AS reason FROM m_sales_line l),
opening AS MATERIALIZED (SELECT * FROM m_opening)
{_competition("COALESCE(o.stock, 0)", "-l.qty", "TRUE")}
SELECT l.sales_invoice_id, l.product_id, l.warehouse_id, {D('l.qty', 'qty')},
  CASE WHEN NOT walk.accepted THEN '{W.NO_STOCK}' END AS reason,
  {D('CASE WHEN walk.accepted THEN walk.level END', 'stock_after')}
FROM checked l LEFT JOIN walk ON walk.seq = l.seq""",
    "add_purchase_lines_movements": _PURCHASE_BATCH
    + f"""
SELECT l.product_id, l.warehouse_id, 'IN' AS movement_type, {D('l.qty', 'qty')}, 'purchase' AS related_type,
  l.purchase_invoice_id AS related_id
FROM checked l SEMI JOIN (SELECT seq FROM walk WHERE accepted) USING (seq)""",
    "add_purchase_lines_prices": _PURCHASE_BATCH
    + f"""
, newest AS (
  SELECT l.product_id, i.supplier_id, arg_max(l.unit_price, l.seq) AS price
  FROM checked l JOIN m_purchase_invoice i ON i.id = l.purchase_invoice_id
  WHERE l.seq IN (SELECT seq FROM walk WHERE accepted) GROUP BY ALL
)
SELECT product_id, supplier_id, {D('IFNULL(price, last_purchase_price)', 'last_purchase_price')}
FROM m_product_supplier FULL JOIN newest USING (product_id, supplier_id)""",
    "add_purchase_lines_totals": _PURCHASE_BATCH
    + f"""
, amounts AS (
  SELECT purchase_invoice_id AS id, line_total AS amount FROM m_purchase_line
  UNION ALL SELECT purchase_invoice_id, CAST(qty * unit_price AS DECIMAL(12,2)) FROM checked
  WHERE seq IN (SELECT seq FROM walk WHERE accepted)
)
SELECT id, {D('IFNULL(SUM(amount), 0)', 'total_amount')} FROM (SELECT id FROM m_purchase_invoice) LEFT JOIN amounts
USING (id) GROUP BY id""",
    "add_purchase_lines_alerts": _OPEN_BEFORE + _PURCHASE_BATCH
    + _CLOSED.format(
        hit="EXISTS (SELECT 1 FROM checked l JOIN walk w ON w.seq = l.seq JOIN m_product p ON p.id = l.product_id "
        "WHERE w.accepted AND COALESCE(l.max_stock_level, 0) - w.level >= p.min_stock_level "
        "AND l.product_id = a.product_id AND l.warehouse_id = a.warehouse_id)",
        by=W.RECEIVED,
    ),
    "adjust_inventory_closed_alerts": _OPEN_BEFORE + _ADJUST_BATCH
    + _CLOSED.format(
        hit="EXISTS (SELECT 1 FROM outcome o WHERE o.final IS NULL AND o.stock_after >= o.min_stock_level "
        "AND o.product_id = a.product_id AND o.warehouse_id = a.warehouse_id)",
        by="stocktaking",
    ),
    "add_purchase_lines": _PURCHASE_BATCH
    + f"""
SELECT l.purchase_invoice_id, l.product_id, l.warehouse_id, {D('l.qty', 'qty')}, {D('l.unit_price', 'unit_price')},
  COALESCE(l.reason, CASE WHEN NOT walk.accepted THEN '{W.OVER_MAX}' END) AS reason,
  {D('CASE WHEN walk.accepted THEN COALESCE(l.max_stock_level, 0) - walk.level END', 'stock_after')}
FROM checked l LEFT JOIN walk ON walk.seq = l.seq""",
    "add_purchase_lines_v4": f"""
, {_asked('m_purchase_line', 'purchase_invoice_id')}
SELECT l.purchase_invoice_id, l.product_id, l.warehouse_id, {D('l.qty', 'qty')}, {D('l.unit_price', 'unit_price')},
  {first_failure((W.LINE_CLOSED, "i.status <> 'DRAFT'"),
                 (W.PRODUCT_UNUSABLE, "NOT p.is_active"),
                 (W.WAREHOUSE_UNUSABLE, "NOT w.is_active"))} AS reason
FROM asked l JOIN m_product p ON p.id = l.product_id JOIN m_warehouse w ON w.id = l.warehouse_id
JOIN m_purchase_invoice i ON i.id = l.purchase_invoice_id""",
    "adjust_inventory": _ADJUST_BATCH
    + f"""
SELECT product_id, warehouse_id, related_id, {D('qty', 'qty')}, final AS reason, {D('stock_after', 'stock_after')}
FROM outcome""",
    "adjust_inventory_alerts": _ADJUST_BATCH
    + f"""
SELECT product_id, warehouse_id, {D('stock_after', 'current_stock')}, {D('min_stock_level', 'min_stock_level')}
FROM outcome WHERE stock_after < min_stock_level""",
    "adjust_inventory_v4": _ADJUST_ACTIVE
    + f"""
SELECT product_id, warehouse_id, related_id, {D('qty', 'qty')}, reason, {D('stock_after', 'stock_after')} FROM outcome""",
    "adjust_inventory_v4_alerts": _OPEN_BEFORE
    + _ADJUST_ACTIVE
    + f"""
SELECT o.product_id, o.warehouse_id, {D('arg_min(stock_after, seq)', 'current_stock')},
  {D('arg_min(o.min_stock_level, seq)', 'min_stock_level')}
FROM outcome o WHERE stock_after <= o.min_stock_level AND NOT EXISTS (
  SELECT 1 FROM earlier e WHERE e.product_id = o.product_id AND e.warehouse_id = o.warehouse_id AND NOT e.is_resolved)
GROUP BY o.product_id, o.warehouse_id""",
    "confirm_purchases": f"""
SELECT pi.id, {first_failure((W.IS_CONFIRMED, "pi.status = 'CONFIRMED'"), (W.IS_CANCELLED, "pi.status = 'CANCELLED'"))} AS reason
FROM m_purchase_invoice pi WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT '-1/-1', '{W.NO_INVOICE}'""",
    "confirm_purchases_movements": f"""
SELECT pl.product_id, pl.warehouse_id, 'IN' AS movement_type, {D('pl.qty', 'qty')}, 'purchase' AS related_type,
  pi.id AS related_id, '{W.PURCHASE_NOTE}' || s.name || '{W.INVOICE_NOTE}' || pi.invoice_no AS note
FROM m_purchase_line pl JOIN m_purchase_invoice pi ON pi.id = pl.purchase_invoice_id
JOIN m_supplier s ON s.id = pi.supplier_id
WHERE pi.status = 'DRAFT' AND o_orderpriority = '1-URGENT' AND pl.l_shipdate >= DATE '2000-01-01'""",
    # Rules
    "validate_purchase_lines": f"""
, {_asked('m_purchase_line', 'purchase_invoice_id')}
SELECT l.purchase_invoice_id, l.product_id, l.warehouse_id, {D('l.qty', 'qty')}, {D('l.unit_price', 'unit_price')},
  {first_failure((W.LINE_CLOSED, "i.status <> 'DRAFT'"),
                 (W.BUY_INACTIVE, "NOT p.is_active"),
                 (W.BUY_CLOSED_SITE, "NOT w.is_active"), *_QTY_PRICE,
                 (W.OVER_MAX, "COALESCE(st.stock, 0) + l.qty > p.max_stock_level"))} AS reason
FROM asked l JOIN m_product p ON p.id = l.product_id JOIN m_warehouse w ON w.id = l.warehouse_id
JOIN m_purchase_invoice i ON i.id = l.purchase_invoice_id
LEFT JOIN m_stock st ON st.product_id = l.product_id AND st.warehouse_id = l.warehouse_id""",
    "validate_sales_lines": f"""
, {_asked('m_sales_line', 'sales_invoice_id')}
SELECT l.sales_invoice_id, l.product_id, l.warehouse_id, {D('l.qty', 'qty')}, {D('l.unit_price', 'unit_price')},
  {first_failure((W.NO_STOCK, "i.status <> 'DRAFT' AND COALESCE(st.stock, 0) < l.qty"),
                 (W.SELL_INACTIVE, "i.status <> 'DRAFT' AND NOT p.is_active"),
                 (W.SELL_CLOSED_SITE, "i.status <> 'DRAFT' AND NOT w.is_active"), *_QTY_PRICE)} AS reason
FROM asked l JOIN m_product p ON p.id = l.product_id JOIN m_warehouse w ON w.id = l.warehouse_id
JOIN m_sales_invoice i ON i.id = l.sales_invoice_id
LEFT JOIN m_stock st ON st.product_id = l.product_id AND st.warehouse_id = l.warehouse_id""",
    "validate_sales_lines_v4": f"""
, {_asked('m_sales_line', 'sales_invoice_id')}
SELECT l.sales_invoice_id, l.product_id, l.warehouse_id, {D('l.qty', 'qty')}, {D('l.unit_price', 'unit_price')},
  {first_failure((W.LINE_CLOSED, "i.status <> 'DRAFT'"),
                 (W.SELL_INACTIVE, "NOT p.is_active"),
                 (W.SELL_CLOSED_SITE, "NOT w.is_active"), *_QTY_PRICE,
                 (W.NO_STOCK, "COALESCE(st.stock, 0) < l.qty"),
                 (W.UNDER_MIN, "COALESCE(st.stock, 0) - l.qty < p.min_stock_level"))} AS reason
FROM asked l JOIN m_product p ON p.id = l.product_id JOIN m_warehouse w ON w.id = l.warehouse_id
JOIN m_sales_invoice i ON i.id = l.sales_invoice_id
LEFT JOIN m_stock st ON st.product_id = l.product_id AND st.warehouse_id = l.warehouse_id""",
    "validate_purchase_status": _PURCHASE_CHANGES
    + "SELECT id, status, new_status, supplier_id, new_supplier_id, reason FROM judged",
    "validate_sales_confirm": _SALES_CHANGES + "SELECT id, status, new_status, short_lines, reason FROM judged",
    "validate_sales_confirm_v4": f"""
SELECT id, status, new_status, {first_failure(
    (W.SALE_FIXED, "l.status <> 'DRAFT' AND l.new_status <> l.status"))} AS reason
FROM m_sales_change l""",
    "validate_product_updates": f"""
SELECT l.id, {D('l.old_price', 'old_price')}, {D('l.new_price', 'new_price')},
  {first_failure((W.PRICE_DROP, "l.new_price < l.old_price * 0.8"),
                 (W.MIN_NEGATIVE, "l.new_min < 0"),
                 (W.MAX_TOO_LOW, "l.new_max <= l.new_min"),
                 (W.ON_DRAFT_PURCHASE,
                  "l.old_active AND NOT l.new_active AND l.id IN (SELECT product_id FROM m_purchase_line pl "
                  "JOIN m_purchase_invoice pi ON pi.id = pl.purchase_invoice_id WHERE pi.status = 'DRAFT')"),
                 (W.ON_DRAFT_SALE,
                  "l.old_active AND NOT l.new_active AND l.id IN (SELECT product_id FROM m_sales_line sl "
                  "JOIN m_sales_invoice si ON si.id = sl.sales_invoice_id WHERE si.status = 'DRAFT')"))} AS reason,
  CASE WHEN l.new_price < l.old_price * 0.8 THEN -({percent('l.old_price', 'l.new_price')}) END AS reduction
FROM m_change l""",
    "validate_movements": _movement_batch(
        first_failure(
            (W.MOVE_INACTIVE, "NOT p.is_active AND l.movement_type <> 'ADJUST'"),
            (W.MOVE_CLOSED_SITE, "NOT w.is_active"),
        ),
        "l.movement_type IN ('OUT', 'ADJUST')",
    ),
    "validate_movements_v4": _movement_batch(
        first_failure(
            (W.MOVE_INACTIVE, "NOT p.is_active"),
            (W.MOVE_CLOSED_SITE, "NOT w.is_active"),
            (W.MOVE_KIND, "l.movement_type NOT IN ('IN', 'OUT', 'ADJUST')"),
            (W.NO_QTY, "l.qty <= 0"),
        ),
        "l.movement_type = 'OUT'",
    ),
    "validate_purchase_line_deletes": f"""
SELECT pl.purchase_invoice_id, pl.product_id, {D('pl.qty', 'qty')},
  CASE WHEN pi.status <> 'DRAFT' THEN '{W.DELETE_CLOSED}' END AS reason
FROM m_purchase_line pl JOIN m_purchase_invoice pi ON pi.id = pl.purchase_invoice_id WHERE pl.qty < 10""",
    "validate_sales_line_deletes": f"""
SELECT sl.sales_invoice_id, sl.product_id, {D('sl.qty', 'qty')},
  CASE WHEN si.status <> 'DRAFT' THEN '{W.DELETE_CLOSED}' END AS reason
FROM m_sales_line sl JOIN m_sales_invoice si ON si.id = sl.sales_invoice_id WHERE sl.qty < 10""",
    "constraint_checks": """
SELECT 'product' AS table_name, 'unique sku' AS rule, COUNT(*) AS violations
  FROM (SELECT sku FROM m_product GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'product', 'not null name, price', COUNT(*) FROM m_product WHERE name IS NULL OR default_price IS NULL
UNION ALL SELECT 'product', 'name up to 8 characters', COUNT(*) FROM m_product WHERE length(name) > 8
UNION ALL SELECT 'product', 'category exists', COUNT(*) FROM m_product WHERE category_id NOT IN (SELECT id FROM m_category)
UNION ALL SELECT 'product_supplier', 'unique pair', COUNT(*)
  FROM (SELECT 1 FROM m_product_supplier GROUP BY product_id, supplier_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'purchase_invoice', 'unique number', COUNT(*)
  FROM (SELECT invoice_no FROM m_purchase_invoice GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'purchase_invoice', 'status DRAFT or CONFIRMED', COUNT(*)
  FROM m_purchase_invoice WHERE status NOT IN ('DRAFT', 'CONFIRMED')
UNION ALL SELECT 'purchase_line', 'invoice exists', COUNT(*)
  FROM m_purchase_line WHERE purchase_invoice_id NOT IN (SELECT id FROM m_purchase_invoice)
UNION ALL SELECT 'purchase_line', 'product once per invoice', COUNT(*)
  FROM (SELECT 1 FROM m_purchase_line GROUP BY purchase_invoice_id, product_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'inventory_movement', 'movement type', COUNT(*)
  FROM m_movement WHERE movement_type NOT IN ('IN', 'OUT', 'ADJUST')
UNION ALL SELECT 'inventory_movement', 'product exists', COUNT(*)
  FROM m_movement WHERE product_id NOT IN (SELECT id FROM m_product WHERE is_active)
UNION ALL SELECT 'inventory_movement', 'warehouse exists', COUNT(*)
  FROM m_movement WHERE warehouse_id NOT IN (SELECT id FROM m_warehouse WHERE is_active)
UNION ALL SELECT 'sales_invoice', 'unique number', COUNT(*)
  FROM (SELECT invoice_no FROM m_sales_invoice GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'sales_invoice', 'status DRAFT, CONFIRMED or CANCELLED', COUNT(*)
  FROM m_sales_invoice WHERE status NOT IN ('DRAFT', 'CONFIRMED', 'CANCELLED')
UNION ALL SELECT 'sales_line', 'invoice exists', COUNT(*)
  FROM m_sales_line WHERE sales_invoice_id NOT IN (SELECT id FROM m_sales_invoice)
UNION ALL SELECT 'sales_line', 'product exists', COUNT(*)
  FROM m_sales_line WHERE product_id NOT IN (SELECT id FROM m_product)
UNION ALL SELECT 'unit', 'unique code', COUNT(*) FROM (SELECT name FROM m_unit GROUP BY 1 HAVING COUNT(*) > 1)""",
    # Effects
    "purchase_confirm_movements": _PURCHASE_CHANGES
    + f"""
SELECT pl.product_id, pl.warehouse_id, 'IN' AS movement_type, {D('pl.qty', 'qty')}, 'purchase' AS related_type,
  c.id AS related_id, '{W.PURCHASE_NOTE}' || s.name || '{W.INVOICE_NOTE}' || c.invoice_no AS note
FROM m_purchase_line pl JOIN confirmed c ON c.id = pl.purchase_invoice_id JOIN m_supplier s ON s.id = c.supplier_id""",
    "purchase_confirm_prices": _PURCHASE_CHANGES
    + f"""
, latest AS (
  SELECT pl.product_id, c.supplier_id, arg_max(pl.unit_price, pl.seq) AS price
  FROM m_purchase_line pl JOIN confirmed c ON c.id = pl.purchase_invoice_id GROUP BY 1, 2
)
SELECT ps.product_id, ps.supplier_id, {D('COALESCE(l.price, ps.last_purchase_price)', 'last_purchase_price')}
FROM m_product_supplier ps LEFT JOIN latest l ON l.product_id = ps.product_id AND l.supplier_id = ps.supplier_id""",
    "purchase_confirm_alerts": _PURCHASE_CHANGES
    + _OPEN_BEFORE
    + _CLOSED.format(
        hit="EXISTS (SELECT 1 FROM m_purchase_line pl JOIN confirmed c ON c.id = pl.purchase_invoice_id "
        "WHERE pl.product_id = a.product_id AND pl.warehouse_id = a.warehouse_id)",
        by=W.PURCHASE_CONFIRMED,
    ),
    "sales_confirm_movements": _SALES_CHANGES
    + f"""
SELECT sl.product_id, sl.warehouse_id, 'OUT' AS movement_type, {D('sl.qty', 'qty')}, 'sale' AS related_type,
  c.id AS related_id, '{W.SALE_NOTE}' || c.customer_name || '{W.INVOICE_NOTE}' || c.invoice_no AS note
FROM m_sales_line sl JOIN confirmed c ON c.id = sl.sales_invoice_id""",
    "sales_confirm_alerts": _SALES_CHANGES + _SALE_ALERTS,
    "sales_confirm_alerts_v4": _OPEN_BEFORE
    + _SALES_CHANGES
    + _SALE_ALERTS
    + """
WHERE l.seq = l.first AND NOT EXISTS (SELECT 1 FROM earlier e
    WHERE e.product_id = l.product_id AND e.warehouse_id = l.warehouse_id AND NOT e.is_resolved)""",
    # Alerts and audits
    "low_stock_alerts": _timeline("m_signed", "(SELECT * FROM m_product WHERE is_active)") + _ALERT_ROWS + " WHERE l.low",
    "alert_episodes": _timeline("m_signed", "(SELECT * FROM m_product WHERE is_active)")
    + f"""
SELECT l.product_id, l.warehouse_id, CAST(l.created_at AS VARCHAR) AS opened_at,
  {D('l.current_stock', 'stock_at_opening')}, {D('l.min_stock_level', 'min_stock_level')},
  COALESCE(l.recovery, l.size + 1) - l.position AS movements, CAST(r.created_at AS VARCHAR) AS closed_at
FROM levelled l LEFT JOIN running r
  ON r.product_id = l.product_id AND r.warehouse_id = l.warehouse_id AND r.position = l.recovery
WHERE l.low AND NOT COALESCE(l.was_low, FALSE)""",
    "price_audit": f"""
SELECT id AS product_id, {D('old_price', 'old_price')}, {D('new_price', 'new_price')},
  {percent('old_price', 'new_price')} AS change_percent, FALSE AS out_of_range
FROM m_change WHERE old_price <> new_price""",
    "price_audit_signed": f"""
SELECT id AS product_id, {D('old_price', 'old_price')}, {D('new_price', 'new_price')},
  {percent('old_price', 'new_price')} AS change_percent, FALSE AS out_of_range, 'purchasing' AS changed_by,
  'Price update' AS reason
FROM m_change WHERE old_price <> new_price""",
    "supplier_price_audit": _LATEST_PRICE
    + f"""
, audited AS (
  SELECT ps.product_id, ps.supplier_id, ps.last_purchase_price AS old_price, l.price AS new_price,
    {percent('ps.last_purchase_price', 'l.price')} AS percent
  FROM m_product_supplier ps JOIN latest l ON l.product_id = ps.product_id AND l.supplier_id = ps.supplier_id
  WHERE ps.last_purchase_price <> l.price
)
SELECT product_id, supplier_id, {D('old_price', 'old_price')}, {D('new_price', 'new_price')},
  CASE WHEN abs(percent) < 1000 THEN percent END AS change_percent, abs(percent) >= 1000 AS out_of_range
FROM audited""",
    "resolve_on_deactivation": _OPEN_BEFORE
    + _CLOSED.format(
        hit="EXISTS (SELECT 1 FROM m_change ch WHERE ch.id = a.product_id AND ch.old_active AND NOT ch.new_active)",
        by=W.DEACTIVATED,
    ),
    # Streams
    "stream_stock_and_alerts": _timeline(
        "m_event",
        "(SELECT DISTINCT user_id AS id, CAST(user_id % 40 AS DECIMAL(12,2)) AS min_stock_level FROM events)",
    )
    + _ALERT_ROWS
    + " WHERE l.low",
    "stream_price_audit": f"""
, steps AS (
  SELECT user_id AS product_id, ts, CAST(value AS DECIMAL(12,2)) AS new_price,
    lag(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old_price
  FROM events WHERE event_type = 'view'
), audited AS (
  SELECT *, {percent('old_price', 'new_price')} AS percent FROM steps WHERE old_price <> new_price
)
SELECT product_id, CAST(ts AS VARCHAR) AS changed_at, {D('old_price', 'old_price')}, {D('new_price', 'new_price')},
  CASE WHEN abs(percent) < 1000 THEN percent END AS change_percent, COALESCE(abs(percent) >= 1000, FALSE) AS out_of_range
FROM audited""",
}
