"""DuckDB reference SQL for the registered queries.

The oracle is written independently of the Spark code, the straightforward
way: global ``ROW_NUMBER()`` windows for "first row" and dense keys, plain
joins and group-bys. It must be one statement per query, so every query is
``WITH <shared chain> SELECT ...``. Conventions: money sums cast to
DECIMAL(18,2), counts to BIGINT, date parts to INTEGER.
"""

from __future__ import annotations

from .schema import NA_TOKENS

_NA_LIST = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)


def _na(c: str) -> str:
    return f"CASE WHEN {c} IN ({_NA_LIST}) THEN NULL ELSE {c} END AS {c}"


def _trim(c: str) -> str:
    return f"NULLIF(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '') AS {c}"


ORD = "o1, o2, o3, o4, o5"

RAW = """
raw AS (
  SELECT CONCAT('INV', CAST(l_orderkey AS VARCHAR)) AS invoice_no,
    CASE WHEN h = 5 THEN CONCAT('  SKU-', CAST(l_partkey AS VARCHAR), ' ')
         ELSE CONCAT('SKU-', CAST(l_partkey AS VARCHAR)) END AS stock_code,
    p_name AS description,
    CASE WHEN h = 2 THEN '-3' WHEN h = 4 THEN 'x'
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    CASE WHEN h = 1 THEN '' ELSE CAST(CAST(p_retailprice + (l_suppkey % 5) AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
    CASE WHEN h = 3 THEN 'not-a-date' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS invoice_date,
    CASE WHEN h = 0 THEN '' ELSE CONCAT('C-', CAST(o_custkey AS VARCHAR)) END AS customer_id,
    n_name AS country,
    l_orderkey AS o1, l_partkey AS o2, l_shipdate AS o3, l_linenumber AS o4, l_suppkey AS o5
  FROM (SELECT *, (l_orderkey * 31 + l_partkey * 17 + l_linenumber) % 1000 AS h FROM lineitem) l
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
)"""

NA = f"""
na AS (
  SELECT {_na('invoice_no')}, {_na('stock_code')}, {_na('description')}, {_na('quantity')},
         {_na('unit_price')}, {_na('invoice_date')}, {_na('customer_id')}, {_na('country')}, {ORD}
  FROM raw
)"""

BRONZE = f"""
bronze AS (
  SELECT {_trim('invoice_no')}, {_trim('stock_code')}, {_trim('description')},
    CASE WHEN isfinite(TRY_CAST(quantity AS DOUBLE))
              AND TRY_CAST(quantity AS DOUBLE) = floor(TRY_CAST(quantity AS DOUBLE))
         THEN CAST(TRY_CAST(quantity AS DOUBLE) AS BIGINT) END AS quantity,
    TRY_CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
    CASE WHEN regexp_full_match(invoice_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}([T ]\\d{{2}}:\\d{{2}}(:\\d{{2}}(\\.\\d{{1,9}})?)?)?')
         THEN TRY_CAST(invoice_date AS TIMESTAMP) END AS invoice_date,
    {_trim('customer_id')}, {_trim('country')}, {ORD}
  FROM na
)"""

CLASSIFIED = f"""
classified AS (
  SELECT *,
    CASE WHEN invoice_no IS NULL THEN 'missing_invoice_no'
         WHEN stock_code IS NULL THEN 'missing_stock_code'
         WHEN invoice_date IS NULL THEN 'missing_or_bad_date'
         WHEN customer_id IS NULL THEN 'missing_customer_id'
         WHEN unit_price IS NULL THEN 'missing_unit_price'
         WHEN quantity IS NULL THEN 'missing_quantity'
         WHEN COALESCE(quantity, 0) <= 0 THEN 'non_positive_quantity'
         WHEN ROW_NUMBER() OVER (PARTITION BY invoice_no, stock_code, invoice_date ORDER BY {ORD}) > 1
              THEN 'duplicate_invoice_line'
         WHEN CAST(quantity AS DECIMAL(19,0)) * unit_price >= 1000000000000 THEN 'amount_out_of_range'
    END AS quarantine_reason
  FROM bronze
),
valid AS (SELECT * EXCLUDE (quarantine_reason) FROM classified WHERE quarantine_reason IS NULL),
quarantine AS (
  SELECT invoice_no, stock_code, description, quantity, unit_price,
         CAST(invoice_date AS DATE) AS invoice_date, customer_id, country, quarantine_reason
  FROM classified WHERE quarantine_reason IS NOT NULL
)"""

DIMS = f"""
categories AS (
  SELECT CONCAT('SKU-', CAST(p_partkey AS VARCHAR)) AS stock_code, p_type AS category
  FROM part WHERE p_partkey % 50 <> 0
),
first_product AS (
  SELECT stock_code, description, unit_price FROM (
    SELECT stock_code, description, unit_price,
           ROW_NUMBER() OVER (PARTITION BY stock_code ORDER BY {ORD}) AS rn
    FROM valid) WHERE rn = 1
),
dim_product AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY f.stock_code) AS BIGINT) AS product_key,
         f.stock_code, f.description, COALESCE(c.category, 'Uncategorised') AS category, f.unit_price
  FROM first_product f LEFT JOIN categories c ON c.stock_code = f.stock_code
),
first_customer AS (
  SELECT customer_id, country FROM (
    SELECT customer_id, country,
           ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY {ORD}) AS rn
    FROM valid) WHERE rn = 1
),
dim_customer AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY customer_id) AS BIGINT) AS customer_key,
         customer_id, country, DATE '1900-01-01' AS effective_from,
         CAST(NULL AS DATE) AS effective_to, TRUE AS is_current
  FROM first_customer
),
days AS (SELECT DISTINCT CAST(invoice_date AS DATE) AS date FROM valid),
dim_date AS (
  SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key, date,
         CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
         CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
         dayname(date) AS weekday, isodow(date) >= 6 AS is_weekend
  FROM days
)"""

FACT = f"""
fact_sales AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY {ORD}) AS BIGINT) AS sale_id,
         p.product_key, c.customer_key,
         CAST(strftime(CAST(v.invoice_date AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
         v.invoice_no, v.quantity, v.unit_price,
         CAST(v.quantity * v.unit_price AS DECIMAL(14,2)) AS revenue
  FROM valid v
  LEFT JOIN dim_product p ON p.stock_code = v.stock_code
  LEFT JOIN (SELECT customer_key, customer_id FROM dim_customer WHERE is_current) c
         ON c.customer_id = v.customer_id
)"""

BRONZE_CHAIN = "WITH " + ",".join([RAW, NA, BRONZE])
CLASSIFIED_CHAIN = BRONZE_CHAIN + "," + CLASSIFIED
STAR_CHAIN = CLASSIFIED_CHAIN + "," + DIMS + "," + FACT


def on_bronze(select: str) -> str:
    return f"{BRONZE_CHAIN}\n{select}"


def on_classified(select: str) -> str:
    return f"{CLASSIFIED_CHAIN}\n{select}"


def on_star(select: str, extra_ctes: str = "") -> str:
    chain = STAR_CHAIN + ("," + extra_ctes if extra_ctes else "")
    return f"{chain}\n{select}"


# ---------------------------------------------------------------------------
# Incremental flows: batch 1 then batch 2 (see sources.tables.split_batches)
# ---------------------------------------------------------------------------

RUN_DATE_1 = "2025-01-01"
RUN_DATE_2 = "2025-02-01"


def _first(src: str, key: str, cols: str) -> str:
    return (f"SELECT {key}, {cols} FROM (SELECT {key}, {cols}, ROW_NUMBER() OVER "
            f"(PARTITION BY {key} ORDER BY {ORD}) AS rn FROM {src}) WHERE rn = 1")


def _fact_lines(src: str, prod: str, cust: str) -> str:
    return f"""
  SELECT p.product_key, c.customer_key,
         CAST(strftime(CAST(b.invoice_date AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
         b.invoice_no, b.quantity, b.unit_price,
         CAST(b.quantity * b.unit_price AS DECIMAL(14,2)) AS revenue, {', '.join('b.' + o for o in ORD.split(', '))}
  FROM {src} b
  JOIN {prod} p ON p.stock_code = b.stock_code
  JOIN (SELECT customer_key, customer_id FROM {cust} WHERE is_current) c ON c.customer_id = b.customer_id"""


FACT_COLS = "sale_id, product_key, customer_key, date_key, invoice_no, quantity, unit_price, revenue"

BATCHES = f"""
b1 AS (SELECT * FROM valid WHERE CAST(invoice_date AS DATE) < DATE '2000-01-01'),
moved AS (SELECT * REPLACE (CASE WHEN TRY_CAST(regexp_extract(customer_id, '(\\d+)$', 1) AS BIGINT) % 100 = 0
                                 THEN 'NATION_MOVED' ELSE country END AS country)
          FROM classified WHERE CAST(invoice_date AS DATE) >= DATE '1999-07-01'),
b2 AS (SELECT * EXCLUDE (quarantine_reason) FROM moved WHERE quarantine_reason IS NULL),
p1in AS ({_first('b1', 'stock_code', 'description, unit_price')}),
p1 AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY i.stock_code) AS BIGINT) AS product_key, i.stock_code,
              i.description, COALESCE(k.category, 'Uncategorised') AS category, i.unit_price
       FROM p1in i LEFT JOIN categories k ON k.stock_code = i.stock_code),
c1 AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY customer_id) AS BIGINT) AS customer_key, customer_id, country,
              DATE '1900-01-01' AS effective_from, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current
       FROM ({_first('b1', 'customer_id', 'country')})),
d1 AS (SELECT * FROM dim_date WHERE date IN (SELECT CAST(invoice_date AS DATE) FROM b1)),
r1 AS ({_fact_lines('b1', 'p1', 'c1')}),
f1 AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY {ORD}) AS BIGINT) AS sale_id, * EXCLUDE ({ORD}) FROM r1),
p2in AS (SELECT i.stock_code, i.description, COALESCE(k.category, 'Uncategorised') AS category, i.unit_price
         FROM ({_first('b2', 'stock_code', 'description, unit_price')}) i
         LEFT JOIN categories k ON k.stock_code = i.stock_code),
c2in AS ({_first('b2', 'customer_id', 'country')}),
p2 AS (
  SELECT p.product_key, p.stock_code,
         CASE WHEN i.stock_code IS NOT NULL THEN i.description ELSE p.description END AS description,
         CASE WHEN i.stock_code IS NOT NULL THEN i.category ELSE p.category END AS category,
         CASE WHEN i.stock_code IS NOT NULL THEN i.unit_price ELSE p.unit_price END AS unit_price
  FROM p1 p LEFT JOIN p2in i ON i.stock_code = p.stock_code
  UNION ALL
  SELECT CAST((SELECT COALESCE(MAX(product_key), 0) FROM p1) + ROW_NUMBER() OVER (ORDER BY stock_code) AS BIGINT),
         stock_code, description, category, unit_price
  FROM p2in WHERE stock_code NOT IN (SELECT stock_code FROM p1)
),
d2 AS (SELECT * FROM dim_date WHERE date IN (SELECT CAST(invoice_date AS DATE) FROM b1 UNION SELECT CAST(invoice_date AS DATE) FROM b2)),
decisions AS (
  SELECT COALESCE(i.customer_id, c.customer_id) AS customer_id,
         CASE WHEN i.customer_id IS NULL THEN 'absent' WHEN c.customer_id IS NULL THEN 'new'
              WHEN c.country IS DISTINCT FROM i.country THEN 'changed' ELSE 'unchanged' END AS action,
         c.customer_key, c.country AS old_country, i.country AS new_country
  FROM (SELECT * FROM c1 WHERE is_current) c FULL OUTER JOIN c2in i ON i.customer_id = c.customer_id
),
c2 AS (
  SELECT c.customer_key, c.customer_id, c.country, c.effective_from,
         CASE WHEN d.customer_key IS NOT NULL THEN DATE '{RUN_DATE_2}' ELSE c.effective_to END AS effective_to,
         CASE WHEN d.customer_key IS NOT NULL THEN FALSE ELSE c.is_current END AS is_current
  FROM c1 c LEFT JOIN (SELECT customer_key FROM decisions WHERE action = 'changed') d
         ON d.customer_key = c.customer_key
  UNION ALL
  SELECT CAST((SELECT MAX(customer_key) FROM c1) + ROW_NUMBER() OVER (ORDER BY customer_id) AS BIGINT),
         customer_id, new_country,
         CASE WHEN action = 'new' THEN DATE '1900-01-01' ELSE DATE '{RUN_DATE_2}' END,
         CAST(NULL AS DATE), TRUE
  FROM decisions WHERE action IN ('new', 'changed')
),
r2 AS ({_fact_lines('b2', 'p2', 'c2')}),
fm AS (
  SELECT f.sale_id, f.product_key,
         CASE WHEN r.o1 IS NOT NULL THEN r.customer_key ELSE f.customer_key END AS customer_key,
         f.date_key, f.invoice_no,
         CASE WHEN r.o1 IS NOT NULL THEN r.quantity ELSE f.quantity END AS quantity,
         CASE WHEN r.o1 IS NOT NULL THEN r.unit_price ELSE f.unit_price END AS unit_price,
         CASE WHEN r.o1 IS NOT NULL THEN r.revenue ELSE f.revenue END AS revenue
  FROM f1 f LEFT JOIN r2 r
    ON r.invoice_no = f.invoice_no AND r.product_key = f.product_key AND r.date_key = f.date_key
  UNION ALL
  SELECT CAST((SELECT MAX(sale_id) FROM f1) + ROW_NUMBER() OVER (ORDER BY {ORD}) AS BIGINT), * EXCLUDE ({ORD})
  FROM r2 WHERE NOT EXISTS (SELECT 1 FROM f1 WHERE f1.invoice_no = r2.invoice_no
                            AND f1.product_key = r2.product_key AND f1.date_key = r2.date_key)
),
ca AS (
  SELECT c.customer_key, c.customer_id,
         CASE WHEN i.customer_id IS NOT NULL AND c.is_current THEN i.country ELSE c.country END AS country,
         c.effective_from, c.effective_to, c.is_current
  FROM c1 c LEFT JOIN c2in i ON i.customer_id = c.customer_id
  UNION ALL
  SELECT CAST((SELECT MAX(customer_key) FROM c1) + ROW_NUMBER() OVER (ORDER BY customer_id) AS BIGINT),
         customer_id, country, DATE '1900-01-01', CAST(NULL AS DATE), TRUE
  FROM c2in WHERE customer_id NOT IN (SELECT customer_id FROM c1)
),
wm AS (SELECT COALESCE(MAX(date_key), 0) AS watermark FROM f1),
ra AS ({_fact_lines('b2', 'p2', 'ca')}),
fa AS (
  SELECT {FACT_COLS} FROM f1
  UNION ALL
  SELECT CAST((SELECT MAX(sale_id) FROM f1) + ROW_NUMBER() OVER (ORDER BY {ORD}) AS BIGINT), * EXCLUDE ({ORD})
  FROM ra WHERE date_key > (SELECT watermark FROM wm)
),
q1 AS (SELECT * FROM quarantine WHERE invoice_date IS NULL OR invoice_date < DATE '2000-01-01'),
q2 AS (SELECT invoice_no, stock_code, description, quantity, unit_price, CAST(invoice_date AS DATE) AS invoice_date,
              customer_id, country, quarantine_reason FROM moved WHERE quarantine_reason IS NOT NULL)"""


def on_batches(select: str) -> str:
    return on_star(select, BATCHES)
