"""The given tables in the layouts the operators work on, with the matching SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import cents, epoch_millis, json_field
from pulsegrid.session import pin_session


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = pin_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log as messages; ``ram`` is a field of the raw JSON ``payload``."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("SID"),
        F.col("event_type").alias("brand"),
        json_field("props", "k").alias("ram"),
        cents("value").alias("price"),
        epoch_millis("ts").alias("saleTime"),
        "ts",
        F.col("props").alias("payload"),
    )


EVENTS = """ev AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS sid, event_type AS brand, json_extract_string(props, '$.k') AS ram,
         CAST(floor(value * 100 + 0.5) AS BIGINT) AS price, epoch_us(ts) // 1000 AS saletime, ts, props AS payload
  FROM events)"""


def sale_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sale messages; ``payload`` is the JSON line and costs nothing unless it is used."""
    typed = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("SID"),
        F.col("l_returnflag").alias("brand"),
        F.col("l_linestatus").alias("city"),
        F.col("l_linenumber").cast("string").alias("ram"),
        cents("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("long").alias("COUNT"),
        epoch_millis("l_shipdate").alias("saleTime"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_partkey").alias("product"),
    )
    fields = ["SID", "brand", "city", "ram", "price", "COUNT", "saleTime"]
    return typed.withColumn("payload", F.to_json(F.struct(*fields)))


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw JSON lines only."""
    return sale_messages(spark, sf_dir).select("payload")


SALES = """sl AS (
  SELECT *, '{"SID":"' || sid || '","brand":"' || brand || '","city":"' || city || '","ram":"' || ram
         || '","price":' || price || ',"COUNT":' || cnt || ',"saleTime":' || saletime || '}' AS payload
  FROM (SELECT CAST(l_suppkey AS VARCHAR) AS sid, l_returnflag AS brand, l_linestatus AS city,
               CAST(l_linenumber AS VARCHAR) AS ram, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS price,
               CAST(l_quantity AS BIGINT) AS cnt, epoch_us(l_shipdate) // 1000 AS saletime,
               l_shipdate AS ts, l_partkey AS product
        FROM lineitem) t)"""


def meter_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as meter readings in whole units, so that sums do not depend on their order."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("active_kw"),
        cents("l_discount").cast("double").alias("reactive_kw"),
        F.lit(230.0).alias("voltage"),
        F.col("l_linenumber").cast("double").alias("intensity"),
        cents("l_tax").cast("double").alias("kitchen"),
        F.col("l_linenumber").cast("double").alias("laundry"),
        F.col("l_quantity").alias("bedroom"),
    )


METER = """mt AS (
  SELECT l_shipdate AS ts, l_quantity AS active_kw, floor(l_discount * 100 + 0.5) AS reactive_kw,
         CAST(l_linenumber AS DOUBLE) AS intensity, floor(l_tax * 100 + 0.5) AS kitchen,
         CAST(l_linenumber AS DOUBLE) AS laundry, l_quantity AS bedroom
  FROM lineitem)"""


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as minute readings, for questions about the time of day."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", cents("value").cast("double").alias("active_kw"), F.col("user_id").cast("double").alias("intensity")
    )


def rating_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity each customer bought of each part."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(
        F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("product")
    ).agg(F.sum("l_quantity").alias("rating"))


RATINGS = """rt AS (
  SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS product, sum(l_quantity) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def part_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("product"), F.col("p_name").alias("title")
    )


def trade_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers (even ids) and suppliers (odd ids) as vertices; who ordered from whom as edges."""
    customers = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") * 2).alias("id"),
        F.col("c_name").alias("name"),
        F.floor("c_acctbal").cast("long").alias("age"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 2 + 1).alias("id"),
        F.col("s_name").alias("name"),
        F.floor("s_acctbal").cast("long").alias("age"),
    )
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    edges = (
        lines.groupBy("l_orderkey", "l_suppkey")
        .agg(F.count("*").alias("w"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy((F.col("o_custkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst"))
        .agg(F.sum("w").alias("weight"))
    )
    return customers.unionByName(suppliers), edges


GRAPH = """vx AS (
  SELECT c_custkey * 2 AS id, c_name AS name, CAST(floor(c_acctbal) AS BIGINT) AS age FROM customer
  UNION ALL SELECT s_suppkey * 2 + 1, s_name, CAST(floor(s_acctbal) AS BIGINT) FROM supplier),
eg AS (
  SELECT o_custkey * 2 AS src, l_suppkey * 2 + 1 AS dst, count(*) AS weight
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
