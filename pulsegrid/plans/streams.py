"""Streaming queries: each runs a stream over a whole table and gives what the stream stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid import streaming as st
from pulsegrid.functions import cents, json_field, word_tokens
from pulsegrid.operators import filters
from pulsegrid.plans.messages import _IN_SUBSET, _SUBSETS, SALE_RULES
from pulsegrid.plans.registry import query
from pulsegrid.plans.tables import EVENTS, SALES, event_messages, table
from pulsegrid.session import pin_session, work_path
from pulsegrid.sinks import MetricTable, archive_stream, metric_rows
from pulsegrid.sources import open_stream, scan_cells, write_cells


def table_stream(spark, sf, name):
    """A given table as a file stream; the pattern fits a single file as well as a folder of files."""
    pin_session(spark)
    path = f"{sf}/{name}.parquet"
    return open_stream(spark, "parquet", f"{path}*", spark.read.parquet(path).schema)


def event_stream(spark, sf, delay=None):
    """Event messages with zoned event time."""
    rows = st.event_time(table_stream(spark, sf, "events"), "ts", delay)
    return rows.select(
        "event_id",
        F.col("user_id").cast("string").alias("sid"),
        F.col("event_type").alias("brand"),
        json_field("props", "k").alias("ram"),
        cents("value").alias("price"),
        "ts",
        F.col("props").alias("payload"),
    )


def sale_stream(spark, sf):
    return table_stream(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("SID"),
        F.col("l_returnflag").alias("brand"),
        F.col("l_linestatus").alias("city"),
        F.col("l_linenumber").cast("string").alias("ram"),
        cents("l_extendedprice").alias("price"),
        F.concat_ws("|", "l_returnflag", "l_linestatus", F.col("l_suppkey").cast("string")).alias("payload"),
    )


@query(
    "stream_batch_words",
    r"""SELECT word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM conversations) WHERE word <> '' GROUP BY 1""",
)
def stream_batch_words(spark, sf):
    """Word counts of every batch, added up where they are read."""
    path = st.run_available(table_stream(spark, sf, "conversations"), "words", "append", st.batch_words("text"))
    return st.stored_batches(spark, path).groupBy("word").agg(F.sum("n").alias("n"))


@query("stream_running_counts", f"WITH {EVENTS} SELECT sid, count(*) AS n, CAST(sum(price) AS BIGINT) AS amount FROM ev GROUP BY 1")
def stream_running_counts(spark, sf):
    totals = st.running_totals(event_stream(spark, sf), ["sid"], "price")
    return st.latest_rows(spark, st.run_available(totals, "running", keys=["sid"]), ["sid"])


@query(
    "stream_city_totals",
    f"""WITH {SALES} SELECT 'city_' || city AS result_key, field, CAST(v AS VARCHAR) AS value FROM (
          SELECT city, 'count' AS field, count(*) AS v FROM sl GROUP BY 1
          UNION ALL SELECT city, 'bytes', sum(strlen(brand) + strlen(city) + strlen(sid) + 2) FROM sl GROUP BY 1) t""",
)
def stream_city_totals(spark, sf):
    """Running bytes and count per city, kept as a keyed result table."""
    store = MetricTable(spark, work_path(spark, "city"))
    totals = st.running_totals(sale_stream(spark, sf), ["city"], payload="payload")

    def save(batch, batch_id):
        rows = metric_rows(batch, F.concat(F.lit("city_"), "city"), {"count": "n", "bytes": "bytes"})
        store.put(rows, "city", batch_id)

    writer = totals.writeStream.outputMode("update").foreachBatch(save)
    writer = writer.option("checkpointLocation", work_path(spark, "city_state"))
    with st.state_partitions(spark):
        query_ = writer.trigger(availableNow=True).start()
    query_.awaitTermination()
    return store.latest("city")


@query(
    "stream_totals_with_initial",
    f"""WITH {EVENTS} SELECT count(*) + (SELECT count(*) FROM orders) AS n, CAST(sum(strlen(payload)) AS BIGINT) AS bytes, CAST(sum(price) AS BIGINT) AS amount FROM ev""",
)
def stream_totals_with_initial(spark, sf):
    """Running (count, bytes, amount) on top of a count carried over from the orders."""
    path = st.run_available(st.global_totals(event_stream(spark, sf), "price", "payload"), "totals")
    zero = F.lit(0).cast("long")
    initial = table(spark, sf, "orders").agg(F.count("*").alias("n")).select("n", zero.alias("bytes"), zero.alias("amount"))
    return st.with_initial(st.latest_rows(spark, path, []), initial, [], ["n", "bytes", "amount"])


@query("stream_batch_sizes", "SELECT count(*) AS n FROM events")
def stream_batch_sizes(spark, sf):
    path = st.run_available(event_stream(spark, sf), "sizes", "append", st.batch_size())
    return st.stored_batches(spark, path).agg(F.sum("n").alias("n"))


@query(
    "stream_dimension_ranks",
    f"""WITH {SALES} SELECT dim, value, count(*) AS n, CAST(sum(price) AS BIGINT) AS amount FROM (
          SELECT 'brand' AS dim, brand AS value, price FROM sl UNION ALL SELECT 'city', city, price FROM sl) t GROUP BY 1, 2""",
)
def stream_dimension_ranks(spark, sf):
    totals = st.dim_totals(sale_stream(spark, sf), ["brand", "city"], "price")
    return st.latest_rows(spark, st.run_available(totals, "dims", keys=["dim", "value"]), ["dim", "value"])


@query(
    "stream_filter_lattice",
    f"""WITH {SALES}, {_SUBSETS} SELECT CAST(subset AS INTEGER) AS subset, dim, value, count(*) AS n, CAST(sum(price) AS BIGINT) AS amount
        FROM s JOIN (SELECT *, 'SID' AS dim, sid AS value FROM sl UNION ALL SELECT *, 'brand' AS dim, brand AS value FROM sl) x ON {_IN_SUBSET}
        GROUP BY 1, 2, 3""",
)
def stream_filter_lattice(spark, sf):
    """All subsets of three conditions with their rankings as one stateful query."""
    totals = st.lattice_stream(sale_stream(spark, sf), SALE_RULES, "price", "payload", ["SID", "brand"])
    keys = ["mask", "dim", "value"]
    return st.lattice_subsets(st.latest_rows(spark, st.run_available(totals, "lattice", keys=keys), keys), SALE_RULES)


@query(
    "stream_condition_filter",
    f"WITH {SALES} SELECT sid, price FROM sl WHERE brand = 'R' AND city = 'O' AND ram = '3'",
)
def stream_condition_filter(spark, sf):
    kept = filters.condition_filter(sale_stream(spark, sf), SALE_RULES)
    return st.append_table(kept.select(F.col("SID").alias("sid"), "price"), "filtered")


def _windows_sql(size, slide, key="", value=None, source=EVENTS):
    """Window starts are multiples of the slide; a row falls into size/slide of them."""
    keys = f", {key}" if key else ""
    amount = f", CAST(sum({value}) AS BIGINT) AS amount" if value else ""
    return f"""WITH {source}, w AS (SELECT *, (saletime // 1000) // {slide} * {slide} - o.o * {slide} AS window_start
          FROM ev, (SELECT unnest(range(0, {size // slide})) AS o) o)
        SELECT window_start{keys}, count(*) AS n{amount} FROM w GROUP BY window_start{keys}"""


@query("stream_sliding_totals", _windows_sql(3000, 300, value="price"))
def stream_sliding_totals(spark, sf):
    """Sliding windows of 50 minutes by 5 from stored panes of 5 minutes."""
    panes = st.pane_totals(event_stream(spark, sf, "1 hour"), "ts", 300, amount="price")
    stored = st.latest_rows(spark, st.run_available(panes, "panes", keys=["pane"]), ["pane"])
    return st.windows_of_panes(stored, 3000, 300)


@query(
    "stream_sliding_bytes",
    f"""WITH {EVENTS}, w AS (SELECT *, (saletime // 1000) // 300 * 300 - o.o * 300 AS window_start FROM ev, (SELECT unnest(range(0, 10)) AS o) o)
        SELECT window_start, count(*) AS n, CAST(sum(strlen(payload)) AS BIGINT) AS bytes FROM w GROUP BY 1""",
)
def stream_sliding_bytes(spark, sf):
    """Number and bytes of the messages in sliding windows."""
    panes = st.pane_totals(event_stream(spark, sf, "1 hour"), "ts", 300, payload="payload")
    return st.windows_of_panes(st.latest_rows(spark, st.run_available(panes, "pane_bytes", keys=["pane"]), ["pane"]), 3000, 300)


@query("stream_sliding_by_key", _windows_sql(7200, 3600, key="brand", value="price"))
def stream_sliding_by_key(spark, sf):
    windows = st.finished_windows(event_stream(spark, sf, "1 day"), "ts", "2 hours", "1 hour", ["brand"], "price")
    return st.latest_rows(spark, st.run_available(windows, "by_key", keys=["window_start", "brand"]), ["window_start", "brand"])


@query("stream_count_by_value_window", _windows_sql(7200, 3600, key="ram"))
def stream_count_by_value_window(spark, sf):
    counts = st.sliding_counts(event_stream(spark, sf, "1 day"), "ts", "2 hours", "1 hour", "ram")
    return st.latest_rows(spark, st.run_available(counts, "by_value", keys=["window_start", "ram"]), ["window_start", "ram"])


@query("stream_tumbling_records", _windows_sql(3600, 3600))
def stream_tumbling_records(spark, sf):
    windows = st.finished_windows(event_stream(spark, sf, "1 day"), "ts", "1 hour")
    return st.latest_rows(spark, st.run_available(windows, "tumbling", keys=["window_start"]), ["window_start"])


@query(
    "stream_window_median",
    f"""WITH {EVENTS}, w AS (SELECT price, (saletime // 1000) // 21600 * 21600 - o.o * 21600 AS window_start FROM ev, (SELECT unnest(range(0, 4)) AS o) o),
        r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY price) AS pos, count(*) OVER (PARTITION BY window_start) AS c FROM w)
        SELECT window_start, price AS median FROM r WHERE pos = greatest(1, floor((c + 1) * 0.5::DOUBLE))""",
)
def stream_window_median(spark, sf):
    """Exact median of daily windows sliding by six hours, from counts per pane and price."""
    counts = st.value_counts(event_stream(spark, sf, "1 day"), "ts", 21600, "price")
    stored = st.latest_rows(spark, st.run_available(counts, "price_counts", keys=["pane", "price"]), ["pane", "price"])
    return st.window_median(stored, 86400, 21600, "price")


@query(
    "batch_window_median",
    f"""WITH {EVENTS}, r AS (SELECT (saletime // 1000) // 86400 * 86400 AS window_start, price FROM ev),
        p AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY price) AS pos, count(*) OVER (PARTITION BY window_start) AS c FROM r)
        SELECT window_start, price AS median FROM p WHERE pos = greatest(1, floor((c + 1) * 0.5::DOUBLE))""",
)
def batch_window_median(spark, sf):
    events = table(spark, sf, "events").select("ts", cents("value").alias("price"))
    return st.batch_window_median(events, "ts", "1 day", "price")


@query(
    "stream_batch_sql",
    f"WITH {EVENTS} SELECT brand, CAST(sum(price) AS BIGINT) AS total, count(*) AS n FROM ev GROUP BY 1",
)
def stream_batch_sql(spark, sf):
    report = st.batch_sql("sensor_batch", "SELECT brand, sum(price) AS total, count(*) AS n FROM sensor_batch GROUP BY brand")
    stored = st.stored_batches(spark, st.run_available(event_stream(spark, sf), "sql", "append", report))
    return stored.groupBy("brand").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


@query("stream_transform", f"WITH {EVENTS} SELECT event_id, price * 2 AS doubled FROM ev WHERE brand <> 'error'")
def stream_transform(spark, sf):
    """An arbitrary DataFrame function applied to a stream."""

    def doubled(df):
        return df.filter(F.col("brand") != "error").select("event_id", (F.col("price") * 2).alias("doubled"))

    return st.append_table(event_stream(spark, sf).transform(doubled), "transformed")


@query(
    "stream_user_purchases",
    """SELECT CAST(user_id AS VARCHAR) AS "user", count(*) AS purchases, CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS BIGINT) AS revenue
       FROM events WHERE event_type = 'purchase' GROUP BY 1""",
)
def stream_user_purchases(spark, sf):
    bought = event_stream(spark, sf).filter(F.col("brand") == "purchase")
    return st.latest_rows(spark, st.run_available(st.user_purchases(bought, "sid", "price"), "purchases", keys=["user"]), ["user"])


@query(
    "stream_union_groups",
    "SELECT k, count(*) AS n FROM (SELECT user_id AS k FROM events UNION ALL SELECT o_custkey FROM orders) t GROUP BY 1",
)
def stream_union_groups(spark, sf):
    both = st.union_streams(
        table_stream(spark, sf, "events").select(F.col("user_id").alias("k")),
        table_stream(spark, sf, "orders").select(F.col("o_custkey").alias("k")),
    )
    return st.latest_rows(spark, st.run_available(st.running_totals(both, ["k"]), "union", keys=["k"]), ["k"])


@query(
    "stream_sum_by_value",
    "SELECT l_quantity AS value, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem GROUP BY 1",
)
def stream_sum_by_value(spark, sf):
    totals = st.sum_and_count_by_value(table_stream(spark, sf, "lineitem"), "l_quantity")
    return st.latest_rows(spark, st.run_available(totals, "by_quantity", keys=["value"]), ["value"])


@query(
    "stream_join",
    "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def stream_join(spark, sf):
    """Two streams about the same events, joined within an hour."""
    left = table_stream(spark, sf, "events").select("event_id", "event_type", "ts")
    right = table_stream(spark, sf, "events").select("event_id", "props", F.col("ts").alias("seen"))
    joined = st.stream_join(left, right, "event_id", "ts", "seen", "1 HOUR", "2 hours")
    return st.append_table(joined.select("a.event_id", "event_type", json_field("props", "k", "long").alias("k")), "joined")


@query(
    "stream_blacklist",
    r"""WITH wl AS (SELECT DISTINCT word FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM benchmark) WHERE word <> ''),
        tk AS (SELECT word FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM conversations) WHERE word <> '')
        SELECT word IN (SELECT word FROM wl) AS dropped, CAST(count(*) AS BIGINT) AS n FROM tk GROUP BY 1""",
)
def stream_blacklist(spark, sf):
    """Listed words are dropped and counted, batch by batch."""
    listed = table(spark, sf, "benchmark").select(F.explode(word_tokens("text")).alias("word")).distinct()

    def report(batch, _):
        words = batch.select(F.explode(word_tokens("text")).alias("word"))
        counts = filters.listed_report(words, "word", listed, "word")
        return counts.groupBy("dropped").agg(F.sum("n").alias("n"))

    stored = st.stored_batches(spark, st.run_available(table_stream(spark, sf, "conversations"), "blacklist", "append", report))
    return stored.groupBy("dropped").agg(F.sum("n").alias("n"))


@query(
    "stream_archive",
    f"WITH {EVENTS} SELECT sid, count(*) AS n FROM ev GROUP BY 1",
)
def stream_archive(spark, sf):
    """Array batches archived by the stream as cells under their arrival time."""
    path = work_path(spark, "stream_cells")
    message = F.to_json(F.struct(F.col("sid").alias("SID"), "price"))
    batches = event_stream(spark, sf).select(
        F.unix_millis("ts").alias("arrived"), F.concat(F.lit("["), message, F.lit("]")).alias("payload")
    )
    writer = archive_stream(batches, path, work_path(spark, "stream_cells_state"), arrived="arrived")
    writer.trigger(availableNow=True).start().awaitTermination()
    cells = scan_cells(spark, path, 0, 4102444800000)
    return cells.groupBy(F.get_json_object("value", "$.SID").alias("sid")).agg(F.count("*").alias("n"))


@query(
    "incremental_kpis",
    f"WITH {EVENTS} SELECT sid, count(*) AS n, CAST(sum(price) AS BIGINT) AS amount FROM ev GROUP BY 1 ORDER BY n DESC, sid LIMIT 10",
)
def incremental_kpis(spark, sf):
    """New cells are added to running totals as they arrive; the ranking is read from the totals."""
    path = work_path(spark, "growing")
    cells = event_messages(spark, sf).select(
        F.col("saleTime").alias("row_key"),
        F.lit("cf").alias("family"),
        F.col("SID").alias("qualifier"),
        F.col("price").cast("string").alias("value"),
    )
    write_cells(cells, path)
    arriving = open_stream(spark, "parquet", path, spark.read.parquet(path).schema)
    messages = arriving.select(F.col("qualifier").alias("sid"), F.col("value").cast("long").alias("price"))
    totals = st.running_totals(messages, ["sid"], "price")
    current = st.latest_rows(spark, st.run_available(totals, "kpis", keys=["sid"]), ["sid"])
    return current.orderBy(F.desc("n"), "sid").limit(10)


@query(
    "stream_report_job",
    f"""WITH {EVENTS}, ob AS (SELECT *, strlen('{{"SID":"' || sid || '","brand":"' || brand || '"' || coalesce(',"ram":"' || ram || '"', '') || ',"price":' || price || '}}') AS size FROM ev),
        w AS (SELECT (saletime // 1000) // 6 * 6 - o.o * 6 AS window_start, price FROM ev, (SELECT unnest(range(0, 50)) AS o) o),
        r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY price) AS pos, count(*) OVER (PARTITION BY window_start) AS c FROM w)
        SELECT 'total ' || brand AS report, count(*) AS n, CAST(sum(price) AS BIGINT) AS amount, CAST(sum(size) AS BIGINT) AS bytes FROM ob GROUP BY 1
        UNION ALL SELECT 'subset 0', count(*), CAST(sum(price) AS BIGINT), CAST(sum(size) AS BIGINT) FROM ob
        UNION ALL SELECT 'subset 1', count(*), CAST(sum(price) AS BIGINT), CAST(sum(size) AS BIGINT) FROM ob WHERE brand = 'click'
        UNION ALL SELECT 'subset 2', count(*), CAST(sum(price) AS BIGINT), CAST(sum(size) AS BIGINT) FROM ob WHERE ram = '69' HAVING count(*) > 0
        UNION ALL SELECT 'subset 3', count(*), CAST(sum(price) AS BIGINT), CAST(sum(size) AS BIGINT) FROM ob WHERE brand = 'click' AND ram = '69' HAVING count(*) > 0
        UNION ALL SELECT 'rank SID ' || sid, count(*), CAST(sum(price) AS BIGINT), 0 FROM ev WHERE brand = 'click' GROUP BY 1
        UNION ALL SELECT 'rank brand ' || brand, count(*), CAST(sum(price) AS BIGINT), 0 FROM ev WHERE brand = 'click' GROUP BY 1
        UNION ALL SELECT 'windows', count(DISTINCT window_start), CAST(sum(price) AS BIGINT), 0 FROM w
        UNION ALL SELECT 'medians', count(*), CAST(sum(price) AS BIGINT), 0 FROM r WHERE pos = greatest(1, floor((c + 1) * 0.5::DOUBLE))
        UNION ALL SELECT 'archive', count(*), CAST(sum(price) AS BIGINT), 0 FROM ev""",
)
def stream_report_job(spark, sf):
    """All streaming reports over the events as one-message batches, summed up per report."""
    message = F.to_json(F.struct(F.col("sid").alias("SID"), "brand", "ram", "price"))
    batches = event_stream(spark, sf).select(
        F.concat(F.lit("["), message, F.lit("]")).alias("payload"), F.col("ts").alias("arrived")
    )
    reports = st.StreamReports(spark, work_path(spark, "reports"), [("brand", "click"), ("ram", "69")], ["brand", "SID"])
    for running in reports.start(batches).values():
        running.awaitTermination()

    def line(df, report, n, amount, size=F.lit(0)):
        figures = [n.alias("n"), amount.alias("amount"), size.alias("bytes")]
        return df.select(report.alias("report"), *figures).withColumns({c: F.col(c).cast("long") for c in ("n", "amount", "bytes")})

    n, amount, size = F.col("n"), F.col("amount"), F.col("bytes")
    ranks = reports.ranks().filter("subset = 1")
    windows = reports.windows().agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    medians = reports.medians().agg(F.count("*").alias("n"), F.sum("median").alias("amount"))
    price = json_field("value", "price", "long")
    archive = scan_cells(spark, reports.archive(), 0, 4102444800000).agg(F.count("*").alias("n"), F.sum(price).alias("amount"))
    return st.union_streams(
        line(reports.totals(), F.concat(F.lit("total "), "brand"), n, amount, size),
        line(reports.subsets(), F.concat(F.lit("subset "), F.col("subset").cast("string")), n, amount, size),
        line(ranks, F.concat_ws(" ", F.lit("rank"), "dim", "value"), n, amount),
        line(windows, F.lit("windows"), n, amount),
        line(medians, F.lit("medians"), n, amount),
        line(archive, F.lit("archive"), n, amount),
    )
