"""Message-log queries over the events and sale messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.operators import aggregates as agg
from pulsegrid.operators import filters, lattice, ranking
from pulsegrid.operators.joins import value_rows
from pulsegrid.operators.partitions import spread_out
from pulsegrid.operators.rank_select import (
    approximate_quantile,
    bucketed_median,
    grouped_rank_select,
    middle_value,
    quantile_table,
)
from pulsegrid.operators.time_buckets import distribution_report, time_distribution
from pulsegrid.plans.registry import query
from pulsegrid.plans.tables import EVENTS, SALES, event_messages, sale_messages, table

# January 2024 up to the 31st, and the span of the sale dates, in epoch ms
EVENT_START, EVENT_END = 1704067200000, 1706659200000
SALE_START, SALE_END = 788918400000, 1009843200000

CLICK_RULES = [("brand", "click"), ("ram", "69"), ("SID", "8")]
SALE_RULES = [("brand", "R"), ("city", "O"), ("ram", "3")]


@query("message_count", f"WITH {EVENTS} SELECT count(*) AS n FROM ev")
def message_count(spark, sf):
    return agg.message_count(event_messages(spark, sf))


@query("message_bytes", f"WITH {SALES} SELECT CAST(sum(strlen(payload)) AS BIGINT) AS bytes FROM sl")
def message_bytes(spark, sf):
    return agg.message_bytes(sale_messages(spark, sf))


@query("text_bytes", "SELECT CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents")
def text_bytes(spark, sf):
    """Bytes, not characters: the texts hold multi-byte letters."""
    return agg.message_bytes(table(spark, sf, "documents", "text"), "text")


@query("count_by_key_value", f"WITH {EVENTS} SELECT count(*) AS n FROM ev WHERE ram = '69'")
def count_by_key_value(spark, sf):
    return agg.count_where(event_messages(spark, sf), "ram", 69)


@query("bytes_by_key_value", f"WITH {SALES} SELECT CAST(sum(strlen(payload)) AS BIGINT) AS bytes FROM sl WHERE brand = 'R'")
def bytes_by_key_value(spark, sf):
    return agg.bytes_where(sale_messages(spark, sf), "brand", "R")


@query(
    "and_count",
    f"WITH {SALES} SELECT count(*) AS n FROM sl WHERE brand = 'R' AND city = 'O' AND ram = '3'",
)
def and_count(spark, sf):
    return agg.and_count(sale_messages(spark, sf), SALE_RULES)


@query(
    "condition_filter",
    f"WITH {SALES} SELECT sid, price, saletime AS sale_time FROM sl WHERE brand = 'R' AND city = 'O' AND ram = '3'",
)
def condition_filter(spark, sf):
    found = filters.condition_filter(sale_messages(spark, sf), SALE_RULES)
    return found.select(F.col("SID").alias("sid"), "price", F.col("saleTime").alias("sale_time"))


@query("and_filter_set", f"WITH {EVENTS} SELECT DISTINCT payload FROM ev WHERE brand = 'click'")
def and_filter_set(spark, sf):
    return filters.and_filter_set(event_messages(spark, sf), {"brand": "click"})


@query(
    "or_filter",
    f"WITH {EVENTS} SELECT event_id, brand, ram, sid FROM ev WHERE brand = 'click' OR ram = '69' OR sid = '8'",
)
def or_filter(spark, sf):
    found = filters.or_filter(event_messages(spark, sf), CLICK_RULES)
    return found.select("event_id", "brand", "ram", F.col("SID").alias("sid"))


@query("field_sum", f"WITH {EVENTS} SELECT CAST(sum(price) AS BIGINT) AS total FROM ev")
def field_sum(spark, sf):
    return agg.field_sum(event_messages(spark, sf), "price")


@query("field_average", f"WITH {SALES} SELECT CAST(sum(price) AS DOUBLE) / count(*) AS average FROM sl")
def field_average(spark, sf):
    return agg.field_avg(sale_messages(spark, sf), "price")


@query("count_distribution", f"WITH {EVENTS} SELECT sid, count(*) AS n FROM ev GROUP BY 1")
def count_distribution(spark, sf):
    return agg.count_by(event_messages(spark, sf), "SID").withColumnRenamed("SID", "sid")


@query("sum_distribution", f"WITH {SALES} SELECT sid, CAST(sum(price) AS BIGINT) AS total FROM sl GROUP BY 1")
def sum_distribution(spark, sf):
    return agg.sum_by(sale_messages(spark, sf), "SID", "price").withColumnRenamed("SID", "sid")


@query(
    "average_and_sum_by_key",
    f"""WITH {SALES} SELECT sid, CAST(sum(cnt) AS BIGINT) AS total, CAST(sum(cnt) AS DOUBLE) / count(*) AS average,
        CAST(sum(cnt) // count(*) AS BIGINT) AS int_average FROM sl GROUP BY 1""",
)
def average_and_sum_by_key(spark, sf):
    return agg.avg_sum_by(sale_messages(spark, sf), "SID", "COUNT").withColumnRenamed("SID", "sid")


@query("value_lists_by_key", f"WITH {EVENTS} SELECT sid, price AS value, count(*) AS copies FROM ev GROUP BY 1, 2")
def value_lists_by_key(spark, sf):
    return value_rows(event_messages(spark, sf), "SID", "price").withColumnRenamed("SID", "sid")


@query(
    "fold_summary",
    f"WITH {EVENTS} SELECT CAST(sum(price) AS BIGINT) AS total, count(*) AS n, min(price) AS low, max(price) AS high FROM ev",
)
def fold_summary(spark, sf):
    return agg.fold_summary(event_messages(spark, sf), "price")


@query("distinct_senders", f"WITH {EVENTS} SELECT count(DISTINCT sid) AS n_distinct FROM ev")
def distinct_senders(spark, sf):
    return agg.distinct_count(event_messages(spark, sf), "SID")


@query("approximate_distinct", f"WITH {EVENTS} SELECT count(DISTINCT sid) AS exact, true AS within FROM ev")
def approximate_distinct(spark, sf):
    """The sketch's answer is within four standard errors (2 % each) of the exact one."""
    events = event_messages(spark, sf)
    sketch = agg.approx_distinct_count(events, "SID").first().n_distinct
    exact = F.countDistinct("SID")
    return events.agg(exact.alias("exact"), (F.abs(F.lit(sketch) - exact) <= 0.08 * exact).alias("within"))


@query(
    "sql_group_report",
    f"""WITH {SALES} SELECT sid, CAST(sum(price) AS BIGINT) AS total, count(*) AS n, CAST(sum(price) AS DOUBLE) / count(*) AS average
        FROM sl GROUP BY sid ORDER BY total DESC, sid""",
)
def sql_group_report(spark, sf):
    sale_messages(spark, sf).createOrReplaceTempView("sale_messages")
    return spark.sql(
        """SELECT SID AS sid, sum(price) AS total, count(*) AS n, sum(price) / count(*) AS average
           FROM sale_messages GROUP BY SID ORDER BY total DESC, sid"""
    )


@query(
    "kpi_panel",
    f"""WITH {EVENTS}, r AS (SELECT price, row_number() OVER (ORDER BY price) AS pos, count(*) OVER () AS c FROM ev)
        SELECT count(*) AS n, CAST(sum(price) AS BIGINT) AS total,
               (SELECT price FROM r WHERE pos = greatest(1, floor((c + 1) * 0.5::DOUBLE))) AS median,
               CAST(sum(price) AS DOUBLE) / count(*) AS average, CAST(sum(strlen(payload)) AS BIGINT) AS bytes FROM ev""",
)
def kpi_panel(spark, sf):
    return agg.kpi_panel(event_messages(spark, sf), "price")


@query(
    "order_statistics",
    f"""WITH {SALES}, r AS (SELECT price, row_number() OVER (ORDER BY price) AS pos, count(*) OVER () AS c FROM sl),
        q(statistic, share) AS (VALUES ('median', 0.5::DOUBLE), ('p95', 0.95::DOUBLE), ('p98', 0.98::DOUBLE),
                                       ('lowest', 0.0::DOUBLE), ('highest', 1.0::DOUBLE))
        SELECT statistic, price AS value FROM q JOIN r ON pos = least(c, greatest(1, CAST(floor((c + 1) * share) AS BIGINT)))""",
)
def order_statistics(spark, sf):
    wanted = {"median": 0.5, "p95": 0.95, "p98": 0.98, "lowest": 0.0, "highest": 1.0}
    return quantile_table(sale_messages(spark, sf), "price", wanted)


@query(
    "middle_value",
    f"""WITH {EVENTS}, r AS (SELECT price, row_number() OVER (ORDER BY price) AS pos, count(*) OVER () AS c FROM ev)
        SELECT price AS middle FROM r WHERE pos = (c + 1) // 2""",
)
def middle(spark, sf):
    found = middle_value(event_messages(spark, sf), "price")
    return spark.createDataFrame([(found,)], "middle bigint")


@query(
    "bucketed_median",
    f"""WITH {SALES}, r AS (SELECT price, row_number() OVER (ORDER BY price) AS pos, count(*) OVER () AS c FROM sl)
        SELECT price AS value FROM r WHERE pos = greatest(1, floor((c + 1) * 0.5::DOUBLE))""",
)
def bucketed(spark, sf):
    return bucketed_median(sale_messages(spark, sf), "price", 50_000)


@query(
    "median_by_brand",
    f"""WITH {SALES}, r AS (SELECT brand, price, row_number() OVER (PARTITION BY brand ORDER BY price) AS pos,
                                   count(*) OVER (PARTITION BY brand) AS c FROM sl)
        SELECT brand, price AS median FROM r WHERE pos = greatest(1, floor((c + 1) * 0.5::DOUBLE))""",
)
def median_by_brand(spark, sf):
    """Few and large groups: no task sees a whole group."""
    return grouped_rank_select(sale_messages(spark, sf), ["brand"], "price", 0.5, name="median")


@query("approximate_median", f"WITH {SALES} SELECT count(*) AS n, true AS within FROM sl")
def approximate_median(spark, sf):
    """The sketch's answer has within 1 % of the rows as many values below as above."""
    sales = sale_messages(spark, sf).select("price")
    median = sales.agg(approximate_quantile("price").alias("m")).first().m
    below, upto = F.count_if(F.col("price") < median), F.count_if(F.col("price") <= median)
    n = F.count("*")
    return sales.agg(n.alias("n"), ((below <= 0.51 * n) & (upto >= 0.49 * n)).alias("within"))


def _distribution_sql(source, start, end, nodes, amount, where="true", anchor="start"):
    width = (end - start) // nodes
    first = start if anchor == "start" else end - width * nodes
    name = source.split(" ", 1)[0]
    return f"""WITH {source}, d AS (
        SELECT (saletime - {first}) // {width} + 1 AS pos, {amount} AS a FROM {name}
        WHERE saletime >= {first} AND saletime < {first + width * nodes} AND {where} GROUP BY 1)
      SELECT r.pos, {first} + r.pos * {width} AS bucket_end, CAST(coalesce(a, 0) AS BIGINT) AS amount
      FROM range(1, {nodes + 1}) r(pos) LEFT JOIN d ON r.pos = d.pos"""


@query("time_distribution_count", _distribution_sql(EVENTS, EVENT_START, EVENT_END, 12, "count(*)"))
def time_distribution_count(spark, sf):
    return time_distribution(event_messages(spark, sf), "ts", EVENT_START, EVENT_END, 12)


@query("time_distribution_amount", _distribution_sql(SALES, SALE_START, SALE_END, 17, "sum(price)"))
def time_distribution_amount(spark, sf):
    return time_distribution(sale_messages(spark, sf), "ts", SALE_START, SALE_END, 17, "price")


@query(
    "time_distribution_end_anchored",
    _distribution_sql(EVENTS, EVENT_START, EVENT_END, 17, "sum(price)", anchor="end"),
)
def time_distribution_end_anchored(spark, sf):
    return time_distribution(event_messages(spark, sf), "ts", EVENT_START, EVENT_END, 17, "price", anchor="end")


@query("time_distribution_by_millis", _distribution_sql(SALES, SALE_START, SALE_END, 12, "count(*)", "brand = 'R'"))
def time_distribution_by_millis(spark, sf):
    found = filters.condition_filter(sale_messages(spark, sf), {"brand": "R"})
    return time_distribution(found, "saleTime", SALE_START, SALE_END, 12)


def _report_sql(amount, field):
    return f"""WITH {SALES}, f AS (SELECT * FROM sl WHERE brand = 'R' AND city = 'O'
                                    AND saletime >= {SALE_START} AND saletime < {SALE_END}),
      d AS (SELECT (saletime - {SALE_START}) // {(SALE_END - SALE_START) // 12} + 1 AS pos, {amount} AS a FROM f GROUP BY 1)
      SELECT 'brand_city__bytesNum' AS result_key, 'value' AS field, CAST(sum(strlen(payload)) AS VARCHAR) AS value FROM f
      UNION ALL SELECT 'brand_city__{field}', 'value', CAST({amount} AS VARCHAR) FROM f
      UNION ALL SELECT 'brand_city__distribution_{field}', CAST({SALE_START} + r.pos * {(SALE_END - SALE_START) // 12} AS VARCHAR),
                       CAST(CAST(coalesce(a, 0) AS BIGINT) AS VARCHAR) FROM range(1, 13) r(pos) LEFT JOIN d ON d.pos = r.pos"""


@query("distribution_report_count", _report_sql("count(*)", "count"))
def distribution_report_count(spark, sf):
    return distribution_report(sale_messages(spark, sf), "ts", SALE_RULES[:2], SALE_START, SALE_END, 12)


@query("distribution_report_amount", _report_sql("CAST(sum(price) AS BIGINT)", "amount"))
def distribution_report_amount(spark, sf):
    return distribution_report(sale_messages(spark, sf), "ts", SALE_RULES[:2], SALE_START, SALE_END, 12, "price")


_SUBSETS = """s AS (
  SELECT i AS subset, CASE WHEN i = 0 THEN 'all' ELSE concat_ws('_', CASE WHEN i & 1 <> 0 THEN 'R' END,
         CASE WHEN i & 2 <> 0 THEN 'O' END, CASE WHEN i & 4 <> 0 THEN '3' END) END AS label FROM range(0, 8) t(i))"""
_IN_SUBSET = "(subset & 1 = 0 OR brand = 'R') AND (subset & 2 = 0 OR city = 'O') AND (subset & 4 = 0 OR ram = '3')"


@query(
    "filter_lattice_totals",
    f"""WITH {SALES}, {_SUBSETS} SELECT CAST(subset AS INTEGER) AS subset, label, count(*) AS n,
        CAST(sum(strlen(payload)) AS BIGINT) AS bytes, CAST(sum(price) AS BIGINT) AS amount
        FROM s JOIN sl ON {_IN_SUBSET} GROUP BY 1, 2""",
)
def filter_lattice_totals(spark, sf):
    return lattice.lattice_totals(sale_messages(spark, sf), SALE_RULES, "price")


@query(
    "filter_lattice_rankings",
    f"""WITH {SALES}, {_SUBSETS}, x AS (SELECT *, 'SID' AS dim, sid AS value FROM sl
          UNION ALL SELECT *, 'city' AS dim, city AS value FROM sl)
        SELECT CAST(subset AS INTEGER) AS subset, label, dim, value, count(*) AS n, CAST(sum(price) AS BIGINT) AS amount
        FROM s JOIN x ON {_IN_SUBSET} GROUP BY 1, 2, 3, 4""",
)
def filter_lattice_rankings(spark, sf):
    return lattice.lattice_rankings(sale_messages(spark, sf), SALE_RULES, ["SID", "city"], "price")


@query(
    "filter_lattice_top",
    f"""WITH {SALES}, {_SUBSETS}, x AS (SELECT *, 'SID' AS dim, sid AS value FROM sl
          UNION ALL SELECT *, 'city' AS dim, city AS value FROM sl),
        g AS (SELECT CAST(subset AS INTEGER) AS subset, dim, value, CAST(sum(price) AS BIGINT) AS amount
              FROM s JOIN x ON {_IN_SUBSET} GROUP BY 1, 2, 3)
        SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY subset, dim ORDER BY amount DESC, value) AS INTEGER) AS rank FROM g)
        WHERE rank <= 5""",
)
def filter_lattice_top(spark, sf):
    ranks = lattice.lattice_rankings(sale_messages(spark, sf), SALE_RULES, ["SID", "city"], "price")
    return lattice.top_of_lattice(ranks, "amount", 5).select("subset", "dim", "value", "amount", "rank")


@query("correlation", "SELECT round(corr(l_quantity, l_extendedprice), 9) AS correlation FROM lineitem")
def correlation(spark, sf):
    found = agg.pearson(table(spark, sf, "lineitem", "l_quantity", "l_extendedprice"), "l_quantity", "l_extendedprice")
    return found.select(F.round("correlation", 9).alias("correlation"))


def _stats_sql(column):
    return f"""SELECT '{column}' AS "column", round(avg({column}), 9) AS mean, round(var_samp({column}), 6) AS variance,
       CAST(min({column}) AS DOUBLE) AS low, CAST(max({column}) AS DOUBLE) AS high,
       count(*) FILTER (WHERE {column} <> 0) AS nonzeros FROM lineitem"""


@query("column_statistics", " UNION ALL ".join(_stats_sql(c) for c in ("l_quantity", "l_linenumber", "l_suppkey")))
def column_statistics(spark, sf):
    columns = ["l_quantity", "l_linenumber", "l_suppkey"]
    stats = agg.column_statistics(table(spark, sf, "lineitem", *columns), columns)
    return stats.withColumn("mean", F.round("mean", 9)).withColumn("variance", F.round("variance", 6))


@query(
    "purchase_report",
    """WITH p AS (SELECT user_id AS u, json_extract_string(props, '$.k') AS k, CAST(floor(value * 100 + 0.5) AS BIGINT) AS price
                  FROM events WHERE event_type = 'purchase'),
       t AS (SELECT k, count(*) AS n FROM p GROUP BY 1 ORDER BY n DESC, k LIMIT 1)
       SELECT count(*) AS purchases, count(DISTINCT u) AS buyers, CAST(sum(price) AS BIGINT) AS revenue,
              (SELECT k FROM t) AS top_product, (SELECT n FROM t) AS top_times FROM p""",
)
def purchase_report(spark, sf):
    bought = filters.condition_filter(event_messages(spark, sf), {"brand": "purchase"})
    return agg.purchase_report(bought, "SID", "ram", "price")


@query(
    "sorted_messages",
    f"WITH {EVENTS} SELECT event_id, price FROM ev ORDER BY price, event_id",
)
def sorted_messages(spark, sf):
    return ranking.sort_messages(event_messages(spark, sf), "price", ["event_id"]).select("event_id", "price")


@query("rank_by_count", f"WITH {EVENTS} SELECT sid, count(*) AS n FROM ev GROUP BY 1 ORDER BY n DESC, sid LIMIT 10")
def rank_by_count(spark, sf):
    return ranking.rank_by_count(event_messages(spark, sf), "SID", 10).withColumnRenamed("SID", "sid")


@query(
    "rank_by_sum",
    f"WITH {SALES} SELECT sid, CAST(sum(price) AS BIGINT) AS total FROM sl GROUP BY 1 ORDER BY total DESC, sid LIMIT 20",
)
def rank_by_sum(spark, sf):
    return ranking.rank_by_sum(sale_messages(spark, sf), "SID", "price", 20).withColumnRenamed("SID", "sid")


@query(
    "filtered_rank_report",
    f"""WITH {SALES}, g AS (SELECT sid AS key, count(*) AS n, CAST(sum(price) AS BIGINT) AS total FROM sl
          WHERE saletime >= {SALE_START} AND saletime < {SALE_END} AND brand = 'R' AND city = 'O' GROUP BY 1)
        (SELECT 'count' AS ranking, key, n AS score FROM g ORDER BY n DESC, key LIMIT 10)
        UNION ALL (SELECT 'amount', key, total FROM g ORDER BY total DESC, key LIMIT 10)""",
)
def filtered_rank_report(spark, sf):
    from pulsegrid.sources import time_range

    sales = sale_messages(spark, sf)
    inside = sales.filter(time_range(sales, "ts", SALE_START, SALE_END))
    return ranking.rank_report(inside, "SID", "price", SALE_RULES[:2], 10)


@query("top_rows", f"WITH {EVENTS} SELECT event_id, price FROM ev ORDER BY price DESC, event_id LIMIT 15")
def top_rows(spark, sf):
    return ranking.top_k(event_messages(spark, sf).select("event_id", "price"), [F.desc("price"), "event_id"], 15)


@query(
    "top_words",
    r"""SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents)
        WHERE word <> '' GROUP BY 1 ORDER BY n DESC, word LIMIT 25""",
)
def top_words(spark, sf):
    return ranking.top_words(spread_out(table(spark, sf, "documents", "text")), "text", 25)


@query("key_lookup", f"WITH {EVENTS} SELECT event_id, brand, price FROM ev WHERE sid = '8'")
def key_lookup(spark, sf):
    return ranking.lookup(event_messages(spark, sf), "SID", "8").select("event_id", "brand", "price")
