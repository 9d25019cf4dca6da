"""Queries: reading, writing and build-once tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.sources import files
from tabwright.sources.staging import stage
from tabwright.queries.registry import query
from tabwright.queries.tables import Tables


@query("SELECT conv_id, turn, role, text FROM conversations")
def csv_scan(t: Tables):
    """Write text with quotes, commas and line breaks as CSV and read it with a schema."""
    source, path = t.conversations, t.new_path()
    source.write.options(header=True, quote='"', escape='"', quoteAll=True).csv(path)
    return files.read_csv(t.spark, path, source.schema)


@query("SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority")
def csv_to_parquet(t: Tables):
    """Convert on first use, then read the Parquet copy."""
    source, path = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), t.new_path()
    source.write.option("header", True).csv(f"{path}_csv")
    files.load_or_convert(t.spark, f"{path}_csv", path, source.schema)
    again = files.load_or_convert(t.spark, f"{path}_csv", path, source.schema)
    total = F.round(F.sum("o_totalprice"), 2).alias("total")
    return again.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), total)


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment")
def materialized_table(t: Tables):
    rich = files.materialize(t.spark, t.new_path(), lambda: t.customer.where(F.col("c_acctbal") > 0))
    return rich.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY c_mktsegment, c_nationkey")
def staged_table(t: Tables):
    return stage(t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n")))


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def report_file(t: Tables):
    """A small result written as one CSV file and read back."""
    path = t.new_path()
    table = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    files.write_report(table, path)
    return files.read_csv(t.spark, path, table.schema)
