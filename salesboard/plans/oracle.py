"""SQL twins of the fixtures and queries, for an independent SQL engine.

Each entry is plain ANSI-style SQL over the driver's tables (registered as
views named like the tables).  Common table expressions rebuild the record
fixtures exactly as ``salesboard.sources.fixtures`` does, then parse them by
the same rules.  Amounts are summed as DECIMAL(18,2) and cast to DOUBLE at
the end; timestamps are zone-free.
"""

from __future__ import annotations

# --- fixture twins ------------------------------------------------------------

RAW_TICKS = r"""
raw_ticks AS (
  SELECT 'sales' AS topic,
         CAST(event_id % 3 AS INTEGER) AS "partition",
         CAST(event_id // 3 AS BIGINT) AS "offset",
         CAST(ts AS TIMESTAMP) AS "timestamp",
         CASE event_id % 50
           WHEN 0 THEN 'x^y^id'
           WHEN 5 THEN line || '^^^'
           WHEN 6 THEN line || '^x'
           ELSE line END AS value,
         event_id AS ordinal
  FROM (
    SELECT event_id, ts, concat_ws('^',
        CASE event_id % 50 WHEN 7 THEN strftime(ts, '%Y-13-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END,
        'https://item.example/' || CAST(event_id % 97 AS VARCHAR),
        CAST(event_id % 97 AS VARCHAR),
        'item ' || CAST(event_id % 97 AS VARCHAR),
        event_type,
        'p' || CAST(event_id % 7 + 1 AS VARCHAR),
        CASE event_id % 50
          WHEN 2 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || ' - 99999'
          WHEN 4 THEN 'n/a'
          ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END,
        CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR),
        CAST(event_id % 5 + 1 AS VARCHAR),
        'R' || CAST(user_id % 5 AS VARCHAR) || ' C' || CAST(user_id % 23 AS VARCHAR),
        CASE WHEN event_id % 50 = 3 THEN '' ELSE CAST(user_id AS VARCHAR) END,
        CAST(event_id % 11 AS VARCHAR),
        CASE WHEN event_id % 50 = 1 THEN '' ELSE 'Shop ' || CAST(user_id AS VARCHAR) END
      ) AS line
    FROM events
  ) e
)"""

RAW_SALES = r"""
raw_sales AS (
  SELECT l_orderkey * 8 + l_linenumber AS ordinal,
         concat_ws('^',
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
           'https://item.example/' || CAST(p_partkey AS VARCHAR),
           CAST(p_partkey AS VARCHAR),
           p_name,
           p_type,
           'p' || CAST(l_linenumber AS VARCHAR),
           CASE WHEN l_linenumber = 1
                THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ' - ' || CAST(p_retailprice AS VARCHAR)
                ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END,
           CAST(p_retailprice AS VARCHAR),
           CAST(CAST(l_quantity AS INTEGER) AS VARCHAR),
           r_name || ' ' || n_name,
           CASE WHEN l_linenumber = 2 THEN '' ELSE CAST(s_suppkey AS VARCHAR) END,
           CAST(l_linenumber AS VARCHAR),
           CASE WHEN l_linenumber = 3 THEN '' ELSE s_name END) AS value
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""


def parsed(src: str, name: str, keys: str) -> str:
    """Parse CTE: split (trailing empties dropped), name fields, type price, status."""
    return rf"""
{name}_split AS (
  SELECT {keys}, value, string_split(regexp_replace(value, '\^+$', ''), '^') AS f FROM {src}
),
{name} AS (
  SELECT *,
    CASE WHEN n_fields <> 13 THEN 'bad_arity' WHEN price IS NULL THEN 'bad_price' END AS status
  FROM (
    SELECT {keys}, value,
      CAST(CASE WHEN regexp_replace(value, '\^+$', '') = '' AND value <> '' THEN 0 ELSE len(f) END
           AS INTEGER) AS n_fields,
      f[1] AS "time", f[2] AS url, f[3] AS product_id, f[4] AS name, f[5] AS keyword,
      f[6] AS "rank", f[7] AS current_price, f[8] AS original_price, f[9] AS sales_count,
      f[10] AS shipping_address, f[11] AS shop_id, f[12] AS comments_count, f[13] AS shop_name,
      TRY_CAST(trim(CASE WHEN contains(f[7], '-') THEN split_part(f[7], '-', 1) ELSE f[7] END)
               AS DECIMAL(18,2)) AS price
    FROM {name}_split
  ) p
)"""


def valid(src: str, name: str, keys: str) -> str:
    return rf"""
{name} AS (
  SELECT {keys}, try_strptime("time", '%Y-%m-%d %H:%M:%S') AS "time", product_id, name, price,
         shop_id, shop_name, keyword, TRY_CAST(sales_count AS INTEGER) AS sales_count,
         shipping_address
  FROM {src} WHERE status IS NULL
)"""


TICK_KEYS = '"partition", "offset", "timestamp", ordinal'

BASE = ",\n".join([
    RAW_TICKS,
    parsed("raw_ticks", "ticks_parsed", TICK_KEYS),
    valid("ticks_parsed", "ticks_valid", TICK_KEYS),
    RAW_SALES,
    parsed("raw_sales", "sales_parsed", "ordinal"),
    valid("sales_parsed", "sales_valid", "ordinal"),
    r"""
shop_amt AS (
  SELECT shop_id, SUM(price) AS amt FROM ticks_valid WHERE shop_id <> '' GROUP BY shop_id
),
trend AS (
  SELECT date_trunc('second', "time") AS bucket, SUM(price) AS amt
  FROM ticks_valid WHERE "time" IS NOT NULL GROUP BY 1
),
chunks AS (
  SELECT *, CAST((ordinal - (SELECT MIN(ordinal) FROM raw_ticks)) * 4
                 // ((SELECT MAX(ordinal) FROM raw_ticks) - (SELECT MIN(ordinal) FROM raw_ticks) + 1)
                 AS BIGINT) AS chunk
  FROM ticks_parsed
)""",
])


def q(body: str, *ctes: str) -> str:
    """Full oracle statement: the shared CTEs, extra ``ctes``, then ``body`` (a SELECT)."""
    extra = "".join(",\n" + c.strip() for c in ctes)
    return "WITH " + BASE.strip() + extra + "\n" + body.strip()
