"""Delimited-text round trips: written from the test tables, read back by Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from featflow.functions.times import parse_date
from featflow.plans.fixtures import WINE_FEATURES, WINE_ID, WINE_LABEL, regression_table, table
from featflow.session import fresh_path
from featflow.sources.io import read_delimited, register_view, write_delimited

_WINE_SCHEMA = ("l_orderkey bigint, l_linenumber int, l_quantity double, l_discount double, "
                "l_tax double, l_extendedprice double")


def _wine_csv(spark, sf_dir) -> str:
    path = fresh_path(spark, "csv", "wine")
    write_delimited(regression_table(spark, sf_dir), path, sep=";")
    return path


def q_csv_semicolon(spark, sf_dir):
    """';'-separated text with a header, read with an explicit schema."""
    return read_delimited(spark, _wine_csv(spark, sf_dir), sep=";", schema=_WINE_SCHEMA)


def q_csv_infer(spark, sf_dir):
    """Same file, types inferred from the text; label split off by name."""
    df = read_delimited(spark, _wine_csv(spark, sf_dir), sep=";", infer=True)
    register_view(df, "wine_csv")
    features = [c for c in df.drop(WINE_LABEL).columns if c not in WINE_ID]
    assert features == list(WINE_FEATURES)
    return spark.sql("SELECT * FROM wine_csv")


def q_csv_dates(spark, sf_dir):
    """Comma text with ``d/M/yyyy`` dates: parse, then year and month."""
    src = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "d/M/yyyy").alias("Date"),
        F.col("o_totalprice").alias("temp"))
    path = fresh_path(spark, "csv", "temps")
    write_delimited(src, path)
    data = read_delimited(spark, path, infer=True)
    data = data.withColumn("Date", parse_date("Date", "d/M/yyyy")) \
        .withColumn("year", F.year("Date")).withColumn("month", F.month("Date"))
    return data.select("Date", "year", "month", "temp")


QUERIES = {
    "csv_semicolon": q_csv_semicolon,
    "csv_infer": q_csv_infer,
    "csv_dates": q_csv_dates,
}

SQL = {
    "csv_semicolon": "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, "
                     "l_extendedprice FROM lineitem",
    "csv_infer": "SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, l_linenumber, l_quantity, "
                 "l_discount, l_tax, l_extendedprice FROM lineitem",
    "csv_dates": "SELECT CAST(o_orderdate AS DATE) AS Date, CAST(year(o_orderdate) AS INTEGER) AS year, "
                 "CAST(month(o_orderdate) AS INTEGER) AS month, o_totalprice AS temp FROM orders",
}
