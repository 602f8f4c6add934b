"""Joins, set operations, splits, partitions, windows and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsegrid.functions import (
    clean_number,
    cosine_similarity,
    date_parts,
    dot,
    json_field,
    l2_norm,
    meter_time,
    millis_of_text,
    non_negative,
    relative_error_pct,
    same_direction,
    same_vector,
    squared_distance,
    threshold_label,
)
from pulsegrid.operators import filters, joins, partitions, setops
from pulsegrid.operators.aggregates import count_by
from pulsegrid.operators.ranking import top_per_group
from pulsegrid.plans.registry import query
from pulsegrid.plans.tables import (
    EVENTS,
    RATINGS,
    SALES,
    event_messages,
    rating_triples,
    sale_messages,
    table,
)

# ---- projections and filters


@query(
    "json_field_projection",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_field_projection(spark, sf):
    return table(spark, sf, "events").select("event_id", json_field("props", "k", "long").alias("k"))


@query(
    "map_and_filter",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS k1 FROM events WHERE event_type <> 'error'",
)
def map_and_filter(spark, sf):
    kept = table(spark, sf, "events").filter(F.col("event_type") != "error")
    return kept.select("event_id", (json_field("props", "k", "long") + 1).alias("k1"))


@query(
    "flat_map_sequence",
    """SELECT value, count(*) AS n FROM (SELECT unnest(range(l_linenumber, 5)) AS value FROM lineitem WHERE l_linenumber <= 4) GROUP BY 1""",
)
def flat_map_sequence(spark, sf):
    """Every number becomes itself up to 4; a greater number becomes nothing."""
    lines = table(spark, sf, "lineitem", "l_linenumber").filter("l_linenumber <= 4")
    spread = lines.select(F.explode(F.sequence(F.col("l_linenumber").cast("long"), F.lit(4).cast("long"))).alias("value"))
    return spread.groupBy("value").agg(F.count("*").alias("n"))


@query("sql_range_predicate", "SELECT c_name AS name FROM customer WHERE c_nationkey >= 13 AND c_nationkey <= 19")
def sql_range_predicate(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("people")
    return spark.sql("SELECT c_name AS name FROM people WHERE c_nationkey >= 13 AND c_nationkey <= 19")


@query(
    "inclusive_date_range",
    """SELECT count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate <= TIMESTAMP '1997-12-31'""",
)
def inclusive_date_range(spark, sf):
    from pulsegrid.operators.power import between_times
    from pulsegrid.plans.tables import meter_readings

    inside = between_times(meter_readings(spark, sf), "1997-01-01 00:00:00", "1997-12-31 00:00:00")
    return inside.agg(F.count("*").alias("n"), F.sum("active_kw").alias("total"))


@query(
    "minute_lookup",
    """WITH r AS (SELECT o_orderkey, date_trunc('minute', o_orderdate) AS m FROM orders),
       d AS (SELECT date_trunc('minute', l_shipdate) AS m, count(*) AS matches, min(l_quantity) AS actual FROM lineitem GROUP BY 1)
       SELECT o_orderkey, CAST(coalesce(matches, 0) AS BIGINT) AS matches, coalesce(actual, 0.0) AS actual,
              CASE WHEN matches IS NULL THEN 'missing' WHEN matches = 1 THEN 'one' ELSE 'duplicated' END AS outcome
       FROM r LEFT JOIN d USING (m)""",
)
def minute_lookup(spark, sf):
    """Order dates as requested minutes, shipments as readings."""
    requests = table(spark, sf, "orders").select("o_orderkey", F.date_trunc("minute", "o_orderdate").alias("at"))
    readings = table(spark, sf, "lineitem").select(F.date_trunc("minute", "l_shipdate").alias("at"), "l_quantity")
    return filters.point_lookup(requests, readings, "at", "l_quantity").drop("at")


@query(
    "year_split",
    """SELECT CASE WHEN year(l_shipdate) IN (1995, 1996, 1997) THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM lineitem
       WHERE year(l_shipdate) IN (1995, 1996, 1997, 1998) GROUP BY 1""",
)
def year_split(spark, sf):
    lines = table(spark, sf, "lineitem", "l_shipdate")
    train, test = filters.year_split(lines, "l_shipdate", [1995, 1996, 1997], [1998])
    return train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part"))).groupBy(
        "part"
    ).agg(F.count("*").alias("n"))


_TOKENS = r"""tk AS (SELECT word FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents) WHERE word <> ''),
  wl AS (SELECT DISTINCT word FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM benchmark) WHERE word <> '')"""


def _words(spark, sf, name):
    from pulsegrid.functions import word_tokens

    texts = partitions.spread_out(table(spark, sf, name, "text"))
    return texts.select(F.explode(word_tokens("text")).alias("word"))


@query("listed_words", f"WITH {_TOKENS} SELECT word, count(*) AS n FROM tk WHERE word IN (SELECT word FROM wl) GROUP BY 1")
def listed_words(spark, sf):
    counts = count_by(_words(spark, sf, "documents"), "word")
    return filters.listed_filter(counts, "word", _words(spark, sf, "benchmark"), "word")


@query(
    "unlisted_words",
    f"WITH {_TOKENS} SELECT word, count(*) AS n FROM tk WHERE word NOT IN (SELECT word FROM wl) GROUP BY 1",
)
def unlisted_words(spark, sf):
    counts = count_by(_words(spark, sf, "documents"), "word")
    return filters.listed_filter(counts, "word", _words(spark, sf, "benchmark"), "word", "unlisted")


@query(
    "blacklist_report",
    f"""WITH {_TOKENS} SELECT word IN (SELECT word FROM wl) AS dropped, count(*) AS n, count(DISTINCT word) AS words FROM tk GROUP BY 1""",
)
def blacklist_report(spark, sf):
    counts = filters.listed_report(_words(spark, sf, "documents"), "word", _words(spark, sf, "benchmark"), "word")
    return counts.groupBy("dropped").agg(F.sum("n").alias("n"), F.count("*").alias("words"))


@query(
    "pair_operations",
    """SELECT o_custkey AS key, o_orderkey + 1 AS value, o_orderkey AS swapped FROM orders""",
)
def pair_operations(spark, sf):
    """Key by a field, change the values, keep the old value as a key of its own."""
    pairs = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("value"))
    return pairs.withColumn("swapped", F.col("value")).withColumn("value", F.col("value") + 1)


@query(
    "slice_totals",
    "SELECT l_suppkey % 8 AS slice, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem GROUP BY 1",
)
def slice_totals(spark, sf):
    return partitions.slice_totals(table(spark, sf, "lineitem", "l_suppkey", "l_quantity"), "l_suppkey", 8, "l_quantity")


@query("tagged_partitions", "SELECT count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS total, true AS ordered FROM lineitem")
def tagged_partitions(spark, sf):
    """Sums of the range partitions of the keys, their total, and whether each partition ends before the next begins."""
    tagged = partitions.tagged_partitions(table(spark, sf, "lineitem", "l_orderkey", "l_quantity"), "l_orderkey", 8)
    parts = tagged.groupBy("partition").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("total"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high")
    )
    before = F.max("high").over(Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1))  # eight rows
    parts = parts.withColumn("ordered", F.coalesce(before <= F.col("low"), F.lit(True)))
    return parts.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.every("ordered").alias("ordered"))


@query("batch_map", "SELECT l_returnflag AS flag, CAST(sum(l_quantity * l_linenumber) AS DOUBLE) AS total FROM lineitem GROUP BY 1")
def batch_map(spark, sf):
    """User logic over whole batches of a partition, which hands on one row per batch and flag."""

    def reduce_batch(batches):
        for batch in batches:
            weighted = batch.assign(total=batch.l_quantity * batch.l_linenumber)
            yield weighted.groupby("l_returnflag", as_index=False).total.sum().rename(columns={"l_returnflag": "flag"})

    lines = table(spark, sf, "lineitem", "l_returnflag", "l_quantity", "l_linenumber")
    partial = partitions.map_batches(lines, reduce_batch, "flag string, total double")
    return partial.groupBy("flag").agg(F.sum("total").alias("total"))


@query(
    "row_iterative_map",
    r"SELECT conv_id, turn, right(regexp_replace(text, '\s+$', ''), 1) AS tail FROM conversations",
)
def row_iterative_map(spark, sf):
    """The last visible character of each text."""
    rows = table(spark, sf, "conversations", "conv_id", "turn", "text")
    return rows.select("conv_id", "turn", F.right(F.regexp_replace("text", r"\s+$", ""), F.lit(1)).alias("tail"))


@query(
    "row_index",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events",
)
def row_index(spark, sf):
    return partitions.row_index(table(spark, sf, "events", "event_id", "ts"), ["ts", "event_id"]).select("event_id", "pos")


@query("bernoulli_sample", "SELECT count(*) AS rows, true AS near FROM events")
def bernoulli_sample(spark, sf):
    """The size of a one-in-ten sample is within five standard deviations, and every row comes from the table."""
    events = table(spark, sf, "events", "event_id", "event_type")
    sample = partitions.bernoulli_sample(events, 0.1, 100).withColumn("hit", F.lit(1))
    n = F.count("*")
    joined = events.join(sample, ["event_id", "event_type"], "left")
    return joined.agg(n.alias("rows"), (F.abs(F.count("hit") - 0.1 * n) <= 5 * F.sqrt(0.09 * n)).alias("near"))


@query("take_sample", "SELECT event_id, event_type FROM events ORDER BY md5('100:' || event_id), event_id LIMIT 20")
def take_sample(spark, sf):
    return partitions.take_sample(table(spark, sf, "events", "event_id", "event_type"), 20, 100, "event_id")


_DIGEST = "('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT"


@query(
    "weighted_split",
    f"SELECT CASE WHEN {_DIGEST.format(seed=123, key='event_id')} % 10000 < 6000 THEN 0 ELSE 1 END AS part, count(*) AS n FROM events GROUP BY 1",
)
def weighted_split(spark, sf):
    parts = filters.hash_split(table(spark, sf, "events", "event_id"), "event_id", [0.6, 0.4], 123)
    return parts.groupBy("part").agg(F.count("*").alias("n"))


@query("random_split", "SELECT count(*) AS rows, true AS near FROM events")
def random_split(spark, sf):
    """Both parts together are the table, and the sizes are within five standard deviations of 60 and 40 %."""
    parts = partitions.random_split(table(spark, sf, "events", "event_id"), [0.6, 0.4], 123)
    both = parts[0].select("event_id", F.lit(1).alias("train")).unionByName(parts[1].select("event_id", F.lit(0).alias("train")))
    n = F.countDistinct("event_id")
    return both.agg(n.alias("rows"), (F.abs(F.sum("train") - 0.6 * n) <= 5 * F.sqrt(0.24 * n)).alias("near"))


@query(
    "k_fold_split",
    f"SELECT CAST({_DIGEST.format(seed=100, key='event_id')} % 4 AS INTEGER) AS fold, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1",
)
def k_fold_split(spark, sf):
    folds = filters.k_folds(table(spark, sf, "events", "event_id"), "event_id", 4, 100)
    return folds.groupBy("fold").agg(F.count("*").alias("n"), F.sum("event_id").alias("id_sum"))


@query("relayout", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1")
def relayout(spark, sf):
    """Rows placed by key, each key over at most eight partitions, then counted."""
    placed = partitions.layout(table(spark, sf, "lineitem", "l_suppkey", "l_orderkey"), key="l_suppkey", spread=8)
    return placed.groupBy("l_suppkey").agg(F.count("*").alias("n"))


# ---- joins


def _orders(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey", "o_orderpriority")


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), "l_partkey", "l_quantity")


@query(
    "inner_join",
    """SELECT o_orderpriority AS priority, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS total
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def inner_join(spark, sf):
    joined = joins.join_by_key(_lines(spark, sf), _orders(spark, sf), "key")
    return joined.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("total")
    )


@query(
    "salted_join",
    """SELECT l_suppkey, s_nationkey, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS total
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
)
def salted_join(spark, sf):
    """Lines of suppliers that hold more than a hundredth of all lines are spread before the join."""
    lines = table(spark, sf, "lineitem", "l_suppkey", "l_orderkey", "l_partkey", "l_quantity")
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = joins.salted_join(lines, suppliers, "l_suppkey")
    return joined.groupBy("l_suppkey", "s_nationkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"))


@query(
    "left_outer_join",
    """SELECT o_orderkey AS key, CAST(count(l_orderkey) AS BIGINT) AS lines FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def left_outer_join(spark, sf):
    lines = _lines(spark, sf).groupBy("key").agg(F.count("*").alias("lines"))
    joined = joins.join_by_key(_orders(spark, sf), lines, "key", "left")
    return joined.select("key", F.coalesce("lines", F.lit(0)).cast("long").alias("lines"))


@query(
    "right_outer_join",
    """SELECT o_orderkey AS key, o_custkey, l_partkey, l_quantity FROM lineitem RIGHT JOIN orders ON l_orderkey = o_orderkey""",
)
def right_outer_join(spark, sf):
    """Lines are the side that may hold a hot key, orders the side that is kept whole."""
    joined = joins.outer_join(_lines(spark, sf), _orders(spark, sf), "key", "right")
    return joined.select("key", "o_custkey", "l_partkey", "l_quantity")


@query(
    "cogroup",
    """SELECT o_custkey AS key, 'left' AS side, o_orderkey AS value, count(*) AS copies FROM orders GROUP BY 1, 2, 3
       UNION ALL SELECT user_id, 'right', event_id, count(*) FROM events GROUP BY 1, 2, 3""",
)
def cogroup(spark, sf):
    """Orders and events of the same person."""
    left = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("v"))
    right = table(spark, sf, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("v"))
    return joins.cogroup_rows(left, right, "key", "v")


@query("anti_join", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def anti_join(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    buyers = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"))
    return joins.anti_by_key(customers, buyers, "key").withColumnRenamed("key", "c_custkey")


@query(
    "dimension_lookup",
    """SELECT r_name, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def dimension_lookup(spark, sf):
    """Facts are summed per supplier before the dimensions are joined."""
    facts = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("total"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    named = joins.lookup_dim(joins.lookup_dim(joins.lookup_dim(facts, suppliers, "l_suppkey"), nations, "n_nationkey"), table(spark, sf, "region"), "r_regionkey")
    return named.groupBy("r_name").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


@query(
    "composite_key_join",
    f"""WITH {RATINGS}, w AS (SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS product, count(*) AS lines
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
        SELECT lines, count(*) AS n, CAST(sum(rating) AS DOUBLE) AS total FROM rt JOIN w USING ("user", product) GROUP BY 1""",
)
def composite_key_join(spark, sf):
    """Two tables by (user, product): quantity bought and number of order lines."""
    ratings = rating_triples(spark, sf)
    lines = (
        table(spark, sf, "lineitem", "l_orderkey", "l_partkey")
        .join(table(spark, sf, "orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("product"))
        .agg(F.count("*").alias("lines"))
    )
    joined = joins.join_by_key(ratings, lines, ["user", "product"])
    return joined.groupBy("lines").agg(F.count("*").alias("n"), F.sum("rating").alias("total"))


@query(
    "outer_join_default",
    """SELECT c_custkey, coalesce(n, 0) AS orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON c_custkey = o_custkey""",
)
def outer_join_default(spark, sf):
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    return joins.outer_with_default(table(spark, sf, "customer", "c_custkey"), counts, "c_custkey", {"orders": 0})


@query(
    "positional_zip",
    """WITH a AS (SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS p FROM events),
            b AS (SELECT event_id AS other_id, row_number() OVER (ORDER BY ts DESC, event_id) AS p FROM events)
       SELECT event_id, other_id FROM a JOIN b USING (p)""",
)
def positional_zip(spark, sf):
    events = table(spark, sf, "events")
    a = events.select("event_id", "value")
    b = events.select(F.col("event_id").alias("other_id"), "ts")
    return joins.zip_by_position(a, b, ["value", "event_id"], [F.desc("ts"), "other_id"]).select("event_id", "other_id")


# ---- set operations


@query("union_bag", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_bag(spark, sf):
    return setops.union_bag(*_nation_keys(spark, sf))


@query("intersection", "SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events")
def intersection(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return setops.intersect_set(orders, table(spark, sf, "events").select(F.col("user_id").alias("k")))


@query("subtract_keeping_duplicates", "SELECT o_custkey AS k FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def subtract_keeping_duplicates(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return setops.subtract_keep(orders, table(spark, sf, "events").select(F.col("user_id").alias("k")))


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return setops.distinct_rows(table(spark, sf, "lineitem", "l_returnflag", "l_linestatus", "l_linenumber"))


def _nation_keys(spark, sf):
    return (
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")),
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")),
    )


# ---- windows


@query(
    "top_per_group",
    f"""WITH {SALES} SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY sid ORDER BY price DESC, product) AS INTEGER) AS rank
          FROM (SELECT DISTINCT sid, product, price FROM sl)) WHERE rank <= 20""",
)
def top_per_group_query(spark, sf):
    """Twenty most expensive products of every supplier."""
    distinct = sale_messages(spark, sf).select(F.col("SID").alias("sid"), "product", "price").distinct()
    return top_per_group(distinct, ["sid"], [F.desc("price"), F.asc("product")], 20)


@query(
    "histogram_prefix_sum",
    f"""WITH {EVENTS} SELECT bucket, n, CAST(sum(n) OVER (ORDER BY bucket) AS BIGINT) AS upto
        FROM (SELECT price // 500 AS bucket, count(*) AS n FROM ev GROUP BY 1)""",
)
def histogram_prefix_sum(spark, sf):
    """Running total over the buckets of a histogram."""
    histogram = event_messages(spark, sf).groupBy(F.floor(F.col("price") / 500).alias("bucket")).agg(F.count("*").alias("n"))
    return partitions.running_total(histogram, ["bucket"], "n")


# ---- scalar functions


@query(
    "time_text_to_millis",
    """SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS millis, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d,
              year(o_orderdate) || '年' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '月' AS label FROM orders""",
)
def time_text_to_millis(spark, sf):
    """Dates written as text and parsed back, both in the log's and the meter's format."""
    from pulsegrid.functions import month_label

    texts = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("log"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("date"),
        F.date_format("o_orderdate", "HH:mm:ss").alias("time"),
    )
    ts = meter_time("date", "time")
    parts = {name: c.cast("long") for name, c in date_parts(ts).items()}
    return texts.select(
        "o_orderkey",
        millis_of_text("log").alias("millis"),
        parts["year"].alias("y"),
        parts["month"].alias("m"),
        parts["day"].alias("d"),
        month_label(ts).alias("label"),
    )


@query(
    "cleaning_functions",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS balance, CASE WHEN c_acctbal >= 5000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS rich,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0 ELSE c_acctbal END AS cleaned,
              contains(c_name, '00000') AS has_zeros, replace(trim(c_name), '#', '') AS flat_name FROM customer""",
)
def cleaning_functions(spark, sf):
    customers = table(spark, sf, "customer")
    marked = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("?")).otherwise(
        F.concat(F.lit('"'), F.col("c_acctbal").cast("string"), F.lit('"'))
    )
    return customers.select(
        "c_custkey",
        non_negative("c_acctbal").alias("balance"),
        threshold_label("c_acctbal", 5000).alias("rich"),
        clean_number(marked).alias("cleaned"),
        F.contains("c_name", F.lit("00000")).alias("has_zeros"),
        F.replace(F.trim("c_name"), F.lit("#"), F.lit("")).alias("flat_name"),
    )


@query(
    "numeric_functions",
    """SELECT o_orderkey, round(ln(o_totalprice + 1), 9) AS log_price, round(sqrt(o_totalprice), 9) AS root, round(pow(o_totalprice / 1000, 2), 6) AS squared,
              round(exp(o_totalprice / 1000000), 9) AS e, round(abs(o_totalprice - 1000) / o_totalprice * 100, 6) AS error_pct FROM orders""",
)
def numeric_functions(spark, sf):
    p = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.round(F.log(p + 1), 9).alias("log_price"),
        F.round(F.sqrt(p), 9).alias("root"),
        F.round(F.pow(p / 1000, F.lit(2)), 6).alias("squared"),
        F.round(F.exp(p / 1000000), 9).alias("e"),
        F.round(relative_error_pct(F.lit(1000.0), p), 6).alias("error_pct"),
    )


@query(
    "vector_functions",
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS a, list_transform(embedding::DOUBLE[], lambda x: -x) AS b,
                         list_transform(embedding::DOUBLE[], lambda x: x + 1) AS c FROM embeddings)
       SELECT vec_id, round(list_inner_product(a, c), 6) AS dot, round(sqrt(list_inner_product(a, a)), 6) AS norm,
              round(list_cosine_similarity(a, c), 6) AS cosine, round(list_inner_product(list_transform(a, lambda x: 1.0::DOUBLE), list_transform(a, lambda x: 1.0::DOUBLE)), 6) AS distance,
              true AS same_axis, false AS same, true AS itself FROM v""",
)
def vector_functions(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    v = v.withColumn("b", F.transform("a", lambda x: -x)).withColumn("c", F.transform("a", lambda x: x + 1))
    return v.select(
        "vec_id",
        F.round(dot("a", "c"), 6).alias("dot"),
        F.round(l2_norm("a"), 6).alias("norm"),
        F.round(cosine_similarity("a", "c"), 6).alias("cosine"),
        F.round(squared_distance("a", "c"), 6).alias("distance"),
        same_direction("a", "b").alias("same_axis"),
        same_vector("a", "b").alias("same"),
        same_vector("a", "a").alias("itself"),
    )
