"""Domain views over the test tables: companies, filings and facts, as DataFrames and as SQL for the checks.

A customer is a company, an order a filing, a line item an extracted fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions import periods as P

FORMS = {"1-URGENT": "10-K", "2-HIGH": "10-Q", "3-MEDIUM": "6-K", "4-NOT SPECIFIED": "20-F", "5-LOW": "HK-IR"}
CURRENCIES = ["USD", "CNY", "HKD", "AUD", "EUR"]
TYPES = {"A": "direct", "N": "inferred", "R": "other"}
#: Columns that tell facts apart when all else ties.
TIES = ["partkey", "suppkey", "quantity", "tax", "value"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(column, names: dict[str, str]):
    return F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), column)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    currency = F.element_at(F.array(*[F.lit(x) for x in CURRENCIES]), F.col("n_regionkey") + 1)
    joined = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    return joined.select(F.col("c_custkey").alias("ticker"), (F.col("c_nationkey") % 12 + 1).alias("fye"), currency.alias("currency"), F.col("c_name").alias("name"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each filing with its company, fiscal year, token and period type."""
    date = F.to_date("o_orderdate")
    docs = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.col("o_custkey").alias("ticker"),
        date.alias("filing_date"),
        F.date_sub(F.trunc(date, "quarter"), 1).alias("period"),
        named(F.col("o_orderpriority"), FORMS).alias("form"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
    )
    out = docs.join(companies(spark, sf_dir), "ticker")
    fye, period, form = F.col("fye"), F.col("period"), F.col("form")
    out = out.withColumn("fy", P.fiscal_year(period, fye).cast("long")).withColumn("token", P.period_token(form, period, fye))
    return out.withColumn("period_type", P.period_type(F.lit(None).cast("string"), form, F.col("token"), period, fye))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each extracted fact with its filing and company."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        F.concat(F.lit("m"), F.col("l_linenumber")).alias("metric"),
        F.col("l_extendedprice").alias("value"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("value_usd"),
        named(F.col("l_returnflag"), TYPES).alias("kind"),
        F.when(F.col("l_linestatus") == "F", "reconcile-derived").otherwise("xbrl").alias("model"),
        F.to_date("l_shipdate").alias("extracted_at"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_tax").alias("tax"),
    )
    return rows.join(filings(spark, sf_dir), "doc_id")


def _case(column: str, names: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


#: The same views for the checks, to go before a SELECT.
SQL = f"""
WITH companies AS (SELECT c_custkey AS ticker, (c_nationkey % 12 + 1)::INT AS fye, {CURRENCIES}[n_regionkey + 1] AS currency, c_name AS name
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
filed AS (SELECT o_orderkey AS doc_id, o_custkey AS ticker, o_orderdate::DATE AS filing_date, (date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY)::DATE AS period,
  {_case("o_orderpriority", FORMS)} AS form, o_orderstatus AS status, o_totalprice AS total FROM orders),
dated AS (SELECT *, year(period) + CASE WHEN month(period) <= fye THEN 0 ELSE 1 END AS fy, (month(period) - fye - 1 + 24) % 12 + 1 AS mi FROM filed JOIN companies USING (ticker)),
tokened AS (SELECT *, CASE WHEN form IN ('10-K', '20-F') THEN 'AR' WHEN form = '10-Q' AND mi <= 9 THEN 'Q' || ((mi + 2) // 3) WHEN form = '6-K' THEN 'Q' || ((mi + 2) // 3)
  WHEN form = 'HK-IR' THEN CASE WHEN mi <= 6 THEN 'H1' ELSE 'H2' END END AS token FROM dated),
filings AS (SELECT *, CASE WHEN token = 'AR' THEN CASE WHEN mi = 12 THEN 'FY' ELSE '' END WHEN form = '10-Q' THEN CASE token WHEN 'Q1' THEN 'Q1' WHEN 'Q2' THEN 'H1' WHEN 'Q3' THEN '9M' ELSE '' END
  WHEN token IS NOT NULL THEN token ELSE '' END AS period_type FROM tokened),
facts AS (SELECT f.*, 'm' || l_linenumber AS metric, l_extendedprice AS value, l_extendedprice * (1 - l_discount) AS value_usd, {_case("l_returnflag", TYPES)} AS kind,
  CASE WHEN l_linestatus = 'F' THEN 'reconcile-derived' ELSE 'xbrl' END AS model, l_shipdate::DATE AS extracted_at, l_partkey AS partkey, l_suppkey AS suppkey, l_quantity AS quantity, l_tax AS tax
  FROM lineitem JOIN filings f ON l_orderkey = doc_id)
"""
