"""The reference's domain (clients, monthly prices, churn label) on the test tables.

* client table: ``customer`` plus four contract date strings derived from the
  customer's first order (written in the five accepted layouts, by key);
* price series: ``orders`` (``o_totalprice`` per client and order date);
* label: ``churn = 1`` when the client placed no order in the last 365 days
  before the newest order in the table.

Everything is derived by Spark from the given tables, so the work grows
with them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.operators.series import series_features

ID = "c_custkey"
PRICE_COLUMNS = ["o_totalprice"]
DATE_COLUMNS = ["date_activ", "date_end", "date_modif_prod", "date_renewal"]


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _render(d, k):
    """A date as text in one of the five accepted layouts, chosen by key."""
    return (F.when(k % 5 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 5 == 1, F.date_format(d, "dd-MM-yyyy"))
             .when(k % 5 == 2, F.date_format(d, "MM/dd/yyyy")).when(k % 5 == 3, F.date_format(d, "d MMM yyyy"))
             .otherwise(F.date_format(d, "MMMM d, yyyy")))


def client_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    first = (_read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias(ID))
             .agg(F.min("o_orderdate").alias("__first")))
    k, d = F.col(ID), F.col("__first")
    return (c.select(ID, "c_nationkey", "c_acctbal", "c_mktsegment")
             .join(first, ID, "left")
             .select(ID, "c_nationkey", "c_acctbal", "c_mktsegment",
                     _render(d, k).alias("date_activ"),
                     _render(F.date_add(d, 3650), k).alias("date_end"),
                     _render(F.date_add(d, 30), k).alias("date_modif_prod"),
                     _render(F.date_add(d, 365), k).alias("date_renewal")))


def price_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias(ID), F.date_format("o_orderdate", "yyyy-MM-dd").alias("price_date"),
                    F.col("o_orderkey").alias("price_seq"), "o_totalprice")


def churn_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    cutoff = F.date_sub(o.agg(F.max("o_orderdate")).scalar(), 365)
    last = o.groupBy(F.col("o_custkey").alias(ID)).agg(F.max("o_orderdate").alias("__last"))
    return last.select(ID, (F.col("__last") < cutoff).cast("int").alias("churn"))


def customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged entity features (client numerics + series features) with the label, for profiling."""
    feats = series_features(price_table(spark, sf_dir), PRICE_COLUMNS, id_column=ID, date_column="price_date",
                            tiebreak=["price_seq"])
    c = _read(spark, sf_dir, "customer").select(ID, "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.join(feats, ID, "inner").join(churn_labels(spark, sf_dir), ID, "inner")
