"""Seven staging views over the driver's tables, in SQL both engines accept.

The rules of the views (what is left blank, missing or out of range) are set
down in FIXTURES.md.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = date(2009, 1, 1)
CALENDAR = (date(1994, 1, 1), date(2008, 12, 31))
BRANCH_LIMIT = 10

SOURCES = {
    "stg_customers": ("customer", "nation"),
    "stg_accounts": ("customer",),
    "stg_cards": ("orders",),
    "stg_merchants": ("supplier", "nation"),
    "stg_branches": ("nation", "region"),
    "stg_loans": ("orders",),
    "stg_transactions": ("lineitem", "orders"),
}

VIEWS = {
    "stg_customers": """
SELECT 'C' || lpad(CAST(c_custkey AS STRING), 9, '0') AS customer_id,
       CASE WHEN c_custkey % 11 = 0 THEN '  ' WHEN c_custkey % 13 = 0 THEN 'o''brien' WHEN c_custkey % 7 = 0 THEN ' MARY-jane' ELSE 'customer ' END AS first_name,
       CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 'no' || substr(c_name, 10) END AS last_name,
       CASE WHEN c_custkey % 17 = 0 THEN 'bad-email' WHEN c_custkey % 23 = 0 THEN NULL ELSE ' User' || CAST(c_custkey AS STRING) || '@Bank.Example ' END AS email,
       CASE WHEN c_custkey % 37 = 0 THEN '' ELSE lower(n_name) END AS city,
       CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(280 + (c_custkey * 37) % 600 AS INT) END AS credit_score,
       CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) END AS created_at
FROM customer
JOIN nation ON c_nationkey = n_nationkey
""",
    "stg_accounts": """
SELECT 'A' || lpad(CAST(c_custkey AS STRING), 9, '0') AS account_id,
       CASE WHEN c_custkey % 43 = 0 THEN 'C-MISSING' ELSE 'C' || lpad(CAST(c_custkey AS STRING), 9, '0') END AS customer_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'checking' WHEN 'MACHINERY' THEN ' Savings ' WHEN 'HOUSEHOLD' THEN 'INVESTMENT' WHEN 'FURNITURE' THEN 'credit' ELSE 'brokerage' END AS account_type,
       CASE WHEN c_custkey % 47 = 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(15,2)) * 13 AS DECIMAL(15,2)) END AS balance_usd,
       DATE '1994-06-01' + CAST(c_custkey % 200 AS INT) AS open_date
FROM customer
WHERE c_custkey % 41 <> 0
UNION ALL
SELECT 'S' || lpad(CAST(c_custkey AS STRING), 9, '0'),
       'C' || lpad(CAST(c_custkey AS STRING), 9, '0'),
       'savings', CAST(100.00 AS DECIMAL(15,2)), CAST(NULL AS DATE)
FROM customer
WHERE c_custkey % 3 = 0
""",
    "stg_cards": """
SELECT 'K' || lpad(CAST(o_orderkey AS STRING), 9, '0') AS card_id,
       'A' || lpad(CAST(o_custkey AS STRING), 9, '0') AS account_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'credit' WHEN '2-HIGH' THEN ' Debit' WHEN '3-MEDIUM' THEN 'PREPAID' WHEN '5-LOW' THEN '' ELSE 'gift' END AS card_type,
       CASE WHEN o_orderkey % 70 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + INTERVAL '4' YEAR AS DATE) END AS expiration_date
FROM orders
""",
    "stg_merchants": """
SELECT 'M' || lpad(CAST(s_suppkey AS STRING), 9, '0') AS merchant_id,
       CASE WHEN s_suppkey % 8 = 7 THEN ' ' ELSE s_name END AS merchant_name,
       CASE WHEN s_suppkey % 6 = 5 THEN NULL ELSE lower(n_name) END AS city
FROM supplier
JOIN nation ON s_nationkey = n_nationkey
WHERE s_suppkey % 10 <> 9
""",
    "stg_branches": """
SELECT 'B' || lpad(CAST(n_nationkey AS STRING), 3, '0') AS branch_id,
       CASE WHEN n_nationkey % 12 = 11 THEN '' ELSE n_name END AS branch_name,
       CASE WHEN n_nationkey % 9 = 8 THEN NULL ELSE lower(r_name) END AS manager_name
FROM nation
JOIN region ON n_regionkey = r_regionkey
""",
    "stg_loans": """
SELECT 'L' || lpad(CAST(o_orderkey AS STRING), 9, '0') AS loan_id,
       CASE WHEN o_orderkey % 85 = 0 THEN 'C-MISSING' ELSE 'C' || lpad(CAST(o_custkey AS STRING), 9, '0') END AS customer_id,
       CASE WHEN o_orderkey % 95 = 0 THEN CAST(0.00 AS DECIMAL(15,2)) ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS loan_amount,
       CAST(((o_orderkey * 13) % 4200) * 0.01 AS DECIMAL(6,2)) AS interest_rate,
       CAST(o_orderdate AS DATE) AS start_date
FROM orders
""",
    "stg_transactions": """
SELECT 'T' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS transaction_id,
       'A' || lpad(CAST(o_custkey AS STRING), 9, '0') AS account_id,
       CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE 'M' || lpad(CAST(l_suppkey AS STRING), 9, '0') END AS merchant_id,
       CASE WHEN l_partkey % 97 = 0 THEN CAST(0.00 AS DECIMAL(15,2)) WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(floor(CAST(l_extendedprice AS DECIMAL(15,2)) / 2) * 0.01 AS DECIMAL(15,2)) END AS amount_usd,
       l_shipdate AS transaction_date
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
""",
}


def staging_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One staging view over the parquet tables in ``sf_dir``."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCES[name]}
    named = re.sub(r"\b(FROM|JOIN) (\w+)", r"\1 {\2}", VIEWS[name])
    return spark.sql(named, **tables)
