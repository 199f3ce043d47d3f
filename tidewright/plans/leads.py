"""A messy records view derived from the customer table: one text for Spark and DuckDB, so that every operator has an oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import LINE

FIELDS = ["first_name", "last_name", "email", "phone", "job_title", "company", "join_date", "salary"]
TYPES = {"first_name": "first_name", "last_name": "last_name", "email": "email", "phone": "phone", "job_title": "job_title", "company": "company", "join_date": "date", "salary": "currency"}

LEADS = """
WITH b AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 9 ELSE c_custkey END AS b,
         c_mktsegment AS seg, c_acctbal AS bal FROM customer)
SELECT k + 1 AS line_no,
  CASE b % 7 WHEN 0 THEN 'john' WHEN 1 THEN 'Dr. JANE' WHEN 2 THEN 'alice (Al)' WHEN 3 THEN 'Bob 🔥'
             WHEN 4 THEN 'N/A' WHEN 5 THEN 'J0hn' ELSE 'o''brien' END AS first_name,
  CASE b % 5 WHEN 0 THEN 'doe' WHEN 1 THEN '  SMITH ' WHEN 2 THEN 'M.' WHEN 3 THEN NULL ELSE 'mc-donald' END AS last_name,
  CASE WHEN b % 11 = 0 THEN 'n/a' WHEN b % 13 = 0 THEN concat('user', CAST(b AS STRING), ' at corp dot net')
       ELSE concat('  User.', CAST(b AS STRING), '@Corp.NET ') END AS email,
  CASE WHEN k % 7 = 0 THEN '-' WHEN k % 5 = 0 THEN concat('(555) ', lpad(CAST(k % 1000 AS STRING), 3, '0'), '-0', lpad(CAST(k % 500 AS STRING), 3, '0'))
       WHEN k % 3 = 0 THEN concat('1555', lpad(CAST(k AS STRING), 7, '0'), ' ext. 9') WHEN k % 4 = 0 THEN '555-0199' ELSE CAST(k AS STRING) END AS phone,
  CASE b % 6 WHEN 0 THEN 'head of hr' WHEN 1 THEN 'Sales / Marketing' WHEN 2 THEN 'growth ninja' WHEN 3 THEN 'vp 🚀'
             WHEN 4 THEN '' ELSE 'r&d director' END AS job_title,
  CASE WHEN k % 8 = 0 THEN 'unknown' ELSE seg END AS company,
  CASE k % 4 WHEN 0 THEN '2023-01-01' WHEN 1 THEN '2023-06-15' WHEN 2 THEN NULL ELSE '2024-02-29' END AS join_date,
  concat('$', CAST(CAST(floor(bal) AS BIGINT) AS STRING)) AS salary
FROM b
"""


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line_no and eight nullable text columns."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment", "c_acctbal")
    return spark.sql(LEADS.replace("FROM customer", "FROM {customer}"), customer=customer)


def lined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as reader output: its fields and _line_number."""
    return leads(spark, sf_dir).select(*FIELDS, F.col("line_no").cast("long").alias(LINE))
