"""Queries of kept state: tables of many batches, the incremental panel, restarts and offsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid import streaming as st
from pulsegrid.plans.registry import query
from pulsegrid.plans.tables import EVENTS, event_messages, table
from pulsegrid.session import work_path, written
from pulsegrid.sinks import MetricTable, metric_rows
from pulsegrid.sources import open_stream


def _events(spark, sf):
    rows = event_messages(spark, sf)
    return rows.select("event_id", F.col("SID").alias("sid"), "brand", "price", "saleTime", "ts", "payload")


def _in_two_runs(spark, sf, name, start):
    """Start a query on a folder, let it finish and stop, add files, and start it again on the same checkpoint.

    The first run sees events of even number, the second finds the others as new files, which the
    tasks of the scan write, one each. ``start`` gets the stream and the folder for the checkpoint.
    """
    rows, base = _events(spark, sf), work_path(spark, name)
    for odd in (0, 1):
        rows.filter(F.pmod("event_id", F.lit(2)) == odd).write.mode("append").parquet(f"{base}/in")
        stream = open_stream(spark, "parquet", f"{base}/in", rows.schema)
        with st.state_partitions(spark):
            start(stream, f"{base}/checkpoint").awaitTermination()
    return f"{base}/checkpoint"


# ---- result table

_FIFTY = "(event_id * 7 + user_id) % 50"


@query(
    "fifty_batches",
    f"WITH {EVENTS} SELECT 'totals' AS result_key, brand AS field, CAST(sum(price) AS BIGINT) AS value, true AS few_folders FROM ev GROUP BY 2",
)
def fifty_batches(spark, sf):
    """Fifty batches of increments; a reader opens one snapshot and the batches after it."""
    rows = table(spark, sf, "events", "event_id", "user_id").withColumn("batch", F.expr(_FIFTY))
    sums = rows.join(_events(spark, sf), "event_id").groupBy("batch", "brand").agg(F.sum("price").alias("total"))
    sums = written(sums.repartition(1), "fifty").persist()
    store = MetricTable(spark, work_path(spark, "fifty"), compact_every=10)
    for batch_id in range(50):
        part = sums.filter(F.col("batch") == batch_id)
        store.put(metric_rows(part, F.lit("totals"), field=F.col("brand"), value=F.col("total")), "total", batch_id, additive=True)
    opened = len(store.table("total").folders())
    sums.unpersist()
    return store.increments("total").withColumn("few_folders", F.lit(opened <= 11))


@query(
    "fifty_upserts",
    f"""WITH {EVENTS}, b AS (SELECT event_id, {_FIFTY} AS batch FROM events)
        SELECT sid AS result_key, 'last' AS field, CAST(arg_max(ev.price, (batch, event_id)) AS VARCHAR) AS value FROM ev JOIN b USING (event_id) GROUP BY 1""",
)
def fifty_upserts(spark, sf):
    """Fifty batches that overwrite fields, with expired rows among them, merged into snapshots as they come."""
    rows = table(spark, sf, "events", "event_id", "user_id").withColumn("batch", F.expr(_FIFTY)).join(_events(spark, sf), "event_id")
    last = rows.groupBy("batch", "sid").agg(F.max_by("price", "event_id").alias("last"))
    last = written(last.repartition(1), "fifty").persist()
    store = MetricTable(spark, work_path(spark, "upserts"), compact_every=10)
    for batch_id in range(50):
        part = last.filter(F.col("batch") == batch_id)
        store.put(metric_rows(part, F.col("sid"), {"last": "last"}), "last", batch_id)
        if batch_id % 10 == 0:
            store.put(metric_rows(part, F.col("sid"), {"gone": "last"}), "gone", batch_id, ttl_seconds=-1)
    last.unpersist()
    return store.latest()


# ---- dashboard

_SPAN = (1704067200000, 1706659200000, 12)
_WIDTH = (_SPAN[1] - _SPAN[0]) // _SPAN[2]


def _panel(spark, sf):
    panel = st.IncrementalPanel(
        spark, work_path(spark, "panel"), sender="sid", dims=("sid", "brand"), span=("saleTime", *_SPAN)
    )
    _in_two_runs(spark, sf, "panel_run", panel.start)
    return panel


@query(
    "incremental_panel",
    f"""WITH {EVENTS}, p AS (SELECT count(*) AS n, CAST(sum(price) AS BIGINT) AS total, CAST(sum(strlen(payload)) AS BIGINT) AS bytes FROM ev),
        r AS (SELECT price, row_number() OVER (ORDER BY price) AS pos, count(*) OVER () AS c FROM ev)
        SELECT n, total, bytes, round(total::DOUBLE / n, 6) AS average,
               (SELECT price FROM r WHERE pos = greatest(1, floor((c + 1) * 0.5::DOUBLE))) AS median,
               (SELECT price FROM r WHERE pos = greatest(1, floor((c + 1) * 0.99::DOUBLE))) AS high, true AS senders_close FROM p""",
)
def incremental_panel(spark, sf):
    """Panel after two batches, the second after a restart: equal to a rescan; the sketched senders within 3 % of the exact ones."""
    panel = _panel(spark, sf)
    exact = panel.by_key("sid").count()
    close = F.abs(F.col("senders") - exact) <= 0.03 * exact
    figures = panel.figures().withColumn("senders_close", close).drop("senders")
    high = F.lit(panel.order_statistic(0.99)).cast("long")
    return figures.withColumn("average", F.round("average", 6)).withColumn("high", high)


@query(
    "incremental_distributions",
    f"""WITH {EVENTS}, d AS (SELECT (saletime - {_SPAN[0]}) // {_WIDTH} + 1 AS pos, count(*) AS n, CAST(sum(price) AS BIGINT) AS amount FROM ev
          WHERE saletime >= {_SPAN[0]} AND saletime < {_SPAN[0] + 12 * _WIDTH} GROUP BY 1),
        t AS (SELECT r.pos, coalesce(n, 0) AS n, coalesce(amount, 0) AS amount FROM range(1, 13) r(pos) LEFT JOIN d ON d.pos = r.pos)
        SELECT 'time' AS dim, CAST({_SPAN[0]} + pos::BIGINT * {_WIDTH} AS VARCHAR) AS value, n, amount FROM t
        UNION ALL SELECT 'sid', sid, count(*), CAST(sum(price) AS BIGINT) FROM ev GROUP BY 2
        UNION ALL SELECT 'brand', brand, count(*), CAST(sum(price) AS BIGINT) FROM ev GROUP BY 2""",
)
def incremental_distributions(spark, sf):
    """Count and amount per key and per slice of time, from the same batches."""
    panel = _panel(spark, sf)
    times = panel.time_distribution("n").join(panel.time_distribution("amount").withColumnRenamed("amount", "total"), ["pos", "bucket_end"])
    out = times.select(F.lit("time").alias("dim"), F.col("bucket_end").cast("string").alias("value"), F.col("amount").alias("n"), F.col("total").alias("amount"))
    for dim in ("sid", "brand"):
        out = out.unionByName(panel.by_key(dim).select(F.lit(dim).alias("dim"), "value", "n", "amount"))
    return out


# ---- restart, offsets, snapshots


@query("state_after_restart", f"WITH {EVENTS} SELECT sid, count(*) AS n, CAST(sum(price) AS BIGINT) AS amount FROM ev GROUP BY 1")
def state_after_restart(spark, sf):
    """What the state store itself holds after a stop, new files and a restart."""

    def start(stream, checkpoint):
        totals = st.running_totals(stream, ["sid"], "price")
        return st.start_into_table(totals, f"{checkpoint}_rows", checkpoint, keys=["sid"])

    state = st.stored_state(spark, _in_two_runs(spark, sf, "restart", start))
    return state.select("key.sid", F.col("value.count").alias("n"), F.col("value.sum").alias("amount"))


@query(
    "offset_ledger",
    """SELECT b AS batch, 0 AS source, CASE b WHEN 1 THEN '{"logOffset":0}' END AS start_offset, '{"logOffset":' || b || '}' AS end_offset, n AS rows, 0 AS gaps
       FROM (SELECT CAST(event_id % 2 AS INTEGER) AS b, count(*) AS n FROM events GROUP BY 1) t""",
)
def offset_ledger(spark, sf):
    """Offsets of every batch and the rows it stored, kept through a restart, and the number of gaps between batches."""
    ledger = st.OffsetLedger(spark, work_path(spark, "ledger"))

    def start(stream, checkpoint):
        rows = stream.select("event_id", "brand", "price")
        return st.start_into_table(rows, f"{checkpoint}_rows", checkpoint, "append", ledger=ledger)

    _in_two_runs(spark, sf, "offsets", start)
    return ledger.rows().drop("batch_ms").withColumn("gaps", F.lit(ledger.gaps().count()).cast("int"))


@query(
    "stream_snapshots",
    f"WITH {EVENTS} SELECT sid, count(*) AS n, CAST(sum(price) AS BIGINT) AS amount FROM ev GROUP BY 1",
)
def stream_snapshots(spark, sf):
    """Totals of a stream of twelve batches, whose table is merged into a snapshot every four."""
    rows, base = _events(spark, sf), work_path(spark, "snapshots")
    rows.repartition(12, "event_id").write.parquet(f"{base}/in")
    stream = open_stream(spark, "parquet", f"{base}/in", rows.schema, maxFilesPerTrigger="1")
    path = st.run_available(st.running_totals(stream, ["sid"], "price"), "snapshots", path=base, keys=["sid"], compact_every=4)
    return st.latest_rows(spark, path, ["sid"])
