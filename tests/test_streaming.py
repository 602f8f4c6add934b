import os
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulsegrid import sinks, sources
from pulsegrid import streaming as st
from pulsegrid.operators.lattice import lattice_rankings, lattice_totals

EVENTS = "/root/testdata/sf0.001/events.parquet"
RULES = [("brand", "click"), ("ram", "69")]


def prepared(df):
    return df.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("sid"),
        F.col("event_type").alias("brand"),
        F.get_json_object("props", "$.k").alias("ram"),
        F.floor(F.col("value") * 100 + 0.5).alias("price"),
        F.col("props").alias("payload"),
    )


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events in eight files, so that a stream takes them in several batches."""
    path = str(tmp_path_factory.mktemp("events"))
    spark.read.parquet(EVENTS).repartitionByRange(8, "ts").write.mode("overwrite").parquet(path)
    return path


@pytest.fixture
def batch(spark, parts):
    return prepared(spark.read.parquet(parts))


@pytest.fixture
def stream(spark, parts):
    schema = spark.read.parquet(parts).schema
    return prepared(sources.open_stream(spark, "parquet", parts, schema, maxFilesPerTrigger="2"))


def stored(spark, df, folder, keys, mode="update"):
    return st.latest_rows(spark, st.run_available(df, "q", mode, path=folder), keys)


def test_running_totals_equal_batch(spark, stream, batch, folder):
    found = stored(spark, st.running_totals(stream, ["sid"], "price", "payload"), folder, ["sid"])
    assert spark.read.parquet(folder + "/rows").select("batch_id").distinct().count() > 1
    want = batch.groupBy("sid").agg(F.count("*"), F.sum(F.octet_length("payload")), F.sum("price"))
    assert rows(found, "sid", "n", "bytes", "amount") == rows(want)


def test_fifty_batches_are_read_from_a_snapshot_and_the_later_folders(spark, folder):
    path, want = folder + "/rows", {}
    for n in range(50):
        changed = [(f"k{n % 7}", n), (f"k{(n * 3) % 11}", 100 + n)]
        want.update(changed)
        batch = spark.createDataFrame(list(dict(changed).items()), "k string, v long").coalesce(1)
        st.store_batch(batch, path, n, ["k"], compact_every=10)
        if n == 29:  # a batch repeated after a failure, its snapshot too
            st.store_batch(batch, path, n, ["k"], compact_every=10)
    found = st.latest_rows(spark, path, ["k"])
    assert dict(rows(found, "k", "v")) == want
    number = lambda names: sorted(int(x.split("=")[1]) for x in names if x.startswith("batch_id="))
    assert number(os.listdir(path)) == list(range(40, 50)) and number(os.listdir(path + "_snapshot")) == [39, 49]
    assert not any("/rows/" in f for f in found.inputFiles())
    st.store_batch(spark.createDataFrame([("k1", -1)], "k string, v long"), path, 50, ["k"], compact_every=10)
    again = st.latest_rows(spark, path, ["k"])
    assert dict(rows(again, "k", "v")) == want | {"k1": -1}
    assert {f.split("/batch_id=")[1].split("/")[0] for f in again.inputFiles()} == {"49", "50"}


def test_lattice_stream_equals_batch(spark, stream, batch, folder):
    totals = stored(spark, st.lattice_stream(stream, RULES, "price", "payload"), folder + "/a", ["mask"])
    totals = st.lattice_subsets(totals, RULES)
    want = lattice_totals(batch, RULES, "price").select("subset", "n", "bytes", "amount")
    assert rows(totals, "subset", "n", "bytes", "amount") == rows(want)
    ranks = stored(
        spark, st.lattice_stream(stream, RULES, "price", "payload", ["sid"]), folder + "/b", ["mask", "dim", "value"]
    )
    ranks = st.lattice_subsets(ranks, RULES)
    columns = ("subset", "dim", "value", "n", "amount")
    assert rows(ranks, *columns) == rows(lattice_rankings(batch, RULES, ["sid"], "price"), *columns)


def test_panes_equal_native_sliding_windows(spark, stream, batch, folder):
    # the files come in no order of time, so a shorter delay would rightly drop late rows
    panes = stored(spark, st.pane_totals(st.event_time(stream, "ts", "40 days"), "ts", 300, ["brand"], "price"), folder, ["pane", "brand"])
    ours = st.windows_of_panes(panes, 1500, 300, ["brand"])
    native = st.finished_windows(batch, "ts", "1500 seconds", "300 seconds", ["brand"], "price")
    columns = ("window_start", "brand", "n", "amount")
    assert rows(ours, *columns) == rows(native, *columns)


def test_windows_of_uneven_panes(spark):
    panes = spark.createDataFrame([(p, 1) for p in range(0, 60, 10)], "pane long, n long")
    found = dict(rows(st.windows_of_panes(panes, 40, 30)))
    # windows [-30, 10) .. [30, 70): the panes inside each
    assert found == {-30: 1, 0: 4, 30: 3}


def test_window_median_equals_sorted_pick(spark, stream, batch, folder):
    counts = st.value_counts(st.event_time(stream, "ts", "40 days"), "ts", 43200, "price")
    found = dict(rows(st.window_median(stored(spark, counts, folder, ["pane", "price"]), 86400, 43200, "price")))
    want = {}
    for row in batch.collect():
        seconds = int(row.ts.timestamp())
        for start in (seconds // 43200 * 43200, seconds // 43200 * 43200 - 43200):
            want.setdefault(start, []).append(row.price)
    assert found == {k: sorted(v)[max(1, int((len(v) + 1) * 0.5)) - 1] for k, v in want.items()}


def test_append_windows_wait_for_the_watermark(spark, stream, folder):
    windows = st.finished_windows(st.event_time(stream, "ts", "1 day"), "ts", "1 hour")
    found = st.stored_batches(spark, st.run_available(windows, "w", "append", path=folder))
    assert found.groupBy("window_start").count().filter("count > 1").count() == 0


def test_restart_continues_from_the_checkpoint(spark, parts, tmp_path):
    source, work = tmp_path / "in", str(tmp_path / "work")
    source.mkdir()
    files = sorted(__import__("pathlib").Path(parts).glob("part-*.parquet"))
    schema = spark.read.parquet(parts).schema

    def run():
        events = prepared(sources.open_stream(spark, "parquet", str(source), schema))
        return st.latest_rows(spark, st.run_available(st.running_totals(events, ["brand"]), "q", path=work), ["brand"])

    for name in files[:4]:
        shutil.copy(name, source)
    first = dict(rows(run(), "brand", "n"))
    for name in files[4:]:
        shutil.copy(name, source)
    second = dict(rows(run(), "brand", "n"))
    want = dict(rows(spark.read.parquet(parts).groupBy("event_type").count()))
    assert second == want and sum(first.values()) < sum(second.values())
    # nothing new: the totals stay
    assert dict(rows(run(), "brand", "n")) == want


def test_repeated_batch_changes_nothing(spark, folder):
    store = sinks.MetricTable(spark, folder)
    one = spark.createDataFrame([("k", "f", "5")], "result_key string, field string, value string")
    for _ in range(3):
        store.put(one, "q", 4)
    assert rows(store.increments("q"), "value") == [(5,)]


def test_initial_totals(spark):
    totals = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    initial = spark.createDataFrame([("a", 10), ("c", 7)], "k string, n long")
    assert rows(st.with_initial(totals, initial, ["k"], ["n"])) == [("a", 11), ("b", 2), ("c", 7)]
    assert rows(st.merge_totals([totals, initial, totals], ["k"], ["n"])) == [("a", 12), ("b", 4), ("c", 7)]


def test_per_batch_work(spark, stream, batch, folder):
    for name, work, key in (
        ("counts", st.batch_counts("brand"), "brand"),
        ("sql", st.batch_sql("b", "SELECT brand, count(*) AS n FROM b GROUP BY brand"), "brand"),
    ):
        path = st.run_available(stream, name, "append", work, path=f"{folder}/{name}")
        found = st.stored_batches(spark, path).groupBy(key).agg(F.sum("n").alias("n"))
        assert rows(found) == rows(batch.groupBy(key).count())
    path = st.run_available(stream, "sizes", "append", st.batch_size(), path=folder + "/sizes")
    sizes = [r.n for r in st.stored_batches(spark, path).collect()]
    assert sum(sizes) == batch.count() and len(sizes) == 4


def test_archive_stream_is_exactly_once(spark, parts, folder):
    schema = spark.read.parquet(parts).schema

    def run():
        events = prepared(sources.open_stream(spark, "parquet", parts, schema))
        payload = F.concat(F.lit("["), F.to_json(F.struct(F.col("sid").alias("SID"))), F.lit("]"))
        batches = events.select(F.unix_millis("ts").alias("at"), payload.alias("payload"))
        writer = sinks.archive_stream(batches, folder + "/cells", folder + "/state", arrived="at")
        writer.trigger(availableNow=True).start().awaitTermination()

    run()
    run()
    assert sources.scan_cells(spark, folder + "/cells", 0, 4102444800000).count() == spark.read.parquet(parts).count()


def test_stream_join_respects_the_bound(spark, parts, folder):
    schema = spark.read.parquet(parts).schema
    left = sources.open_stream(spark, "parquet", parts, schema).select("event_id", "ts")
    late = F.when(F.col("event_id") % 2 == 0, F.expr("ts + interval 30 minutes")).otherwise(F.expr("ts + interval 3 hours"))
    right = sources.open_stream(spark, "parquet", parts, schema).select("event_id", late.alias("seen"))
    joined = st.stream_join(left, right, "event_id", "ts", "seen", "1 HOUR", "1 day").select("a.event_id")
    found = st.stored_batches(spark, st.run_available(joined, "j", "append", path=folder)).drop("batch_id")
    want = spark.read.parquet(parts).filter("event_id % 2 = 0").select("event_id")
    assert rows(found) == rows(want)


def test_text_stream_and_offset_report(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x y x\n")
    lines = sources.open_stream(spark, "text", str(tmp_path / "in"))
    query = st.start_into_table(
        lines, str(tmp_path / "rows"), str(tmp_path / "state"), "append", per_batch=st.batch_words("payload")
    )
    query.awaitTermination()
    assert rows(st.stored_batches(spark, str(tmp_path / "rows")), "word", "n") == [("x", 2), ("y", 1)]
    report = sources.offset_report(query)
    assert report[0]["batch_id"] == 0 and report[0]["rows"] == 1 and report[0]["end_offset"]


def test_console_stream(spark, stream, folder):
    writer = sinks.console(stream.groupBy("brand").count(), rows=1).option("checkpointLocation", folder)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
