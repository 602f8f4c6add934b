"""Tables of many batches, the incremental panel, offsets, restarts, and windows from entering and leaving panes."""

import os
import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulsegrid import sinks, sources
from pulsegrid import streaming as st
from pulsegrid.operators.aggregates import kpi_panel
from pulsegrid.operators.lattice import lattice_totals
from pulsegrid.operators.rank_select import quantile_rank
from pulsegrid.operators.time_buckets import time_distribution
from pulsegrid.plans.state import _in_two_runs


def additive(spark, path, **options):
    return sinks.BatchTable(spark, path, "k string, n bigint", ["k"], sinks.additive_fold(["k"], ["n"]), **options)


def test_folders_stay_few_and_sums_right(spark, folder):
    table = additive(spark, folder + "/t", compact_every=4, slots=3)
    want, most = defaultdict(int), 0
    for batch in range(23):
        data = [(f"k{(batch + i) % 5}", batch * i) for i in range(3)]
        df = spark.createDataFrame(data, "k string, n bigint")
        for _ in range(1 + batch % 2):  # every other batch is written twice
            table.put(df, batch)
        for k, n in data:
            want[k] += n
        most = max(most, len(table.folders()))
        assert dict(rows(table.current(), "k", "n")) == dict(want)
    assert most <= 5
    on_disk = os.listdir(folder + "/t/batches")
    assert len(on_disk) <= 10 and len(os.listdir(folder + "/t/snapshot")) <= 2
    assert len([n for n in os.listdir(folder + "/t/manifest") if n.endswith(".json")]) <= 3
    table.put(spark.createDataFrame([("k0", 10**6)], "k string, n bigint"), 3)  # long folded: final
    assert dict(rows(table.current(), "k", "n")) == dict(want)


def test_a_batch_repeated_at_a_snapshot_counts_once(spark, folder):
    table = additive(spark, folder, compact_every=2)
    for batch in (0, 1, 2, 2, 3, 4, 4, 5):
        table.put(spark.createDataFrame([("a", 10**batch)], "k string, n bigint"), batch)
    assert rows(table.current(), "n") == [(111_111,)]


def test_only_the_slots_of_the_keys_are_read(spark, folder):
    table = additive(spark, folder, compact_every=1, slots=8)
    for batch in range(3):
        table.put(spark.range(40).select(F.col("id").cast("string").alias("k"), F.lit(1).cast("long").alias("n")), batch)
    one = spark.createDataFrame([("7", 0)], "k string, n bigint")
    slots = table.slots_of(one)
    assert len(slots) == 1
    found = table.current(slots).filter("k = '7'")
    assert rows(found, "k", "n") == [("7", 3)]
    plan = table.rows(slots)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [slot" in plan or "slot#" in plan.split("PartitionFilters: [")[-1][:80]


def kpis(spark, **fields):
    return spark.createDataFrame([("k", f, str(v)) for f, v in fields.items()], "result_key string, field string, value string")


def test_values_expire_in_snapshots_and_channels_stay(spark, folder):
    store = sinks.MetricTable(spark, folder, compact_every=2)
    store.put(kpis(spark, a=1, b=1, gone=1), "q", 0)
    store.put(kpis(spark, gone=2), "q", 1, ttl_seconds=-1)
    store.put(kpis(spark, b=2), "q", 2, channel="news")
    store.put(kpis(spark, a=3), "q", 3)
    store.put(kpis(spark, c=4), "q", 4)
    assert rows(store.latest("q"), "field", "value") == [("a", "3"), ("b", "2"), ("c", "4")]
    assert rows(store.latest("q", "news"), "field", "value") == [("b", "2")]
    assert "gone" not in {r.field for r in store.table("q").rows().collect()}
    with pytest.raises(ValueError):
        store.put(kpis(spark, a=1), "q", 5, additive=True)
    with pytest.raises(ValueError):
        store.increments("q")


def test_increments_and_put_once_over_snapshots(spark, folder):
    store = sinks.MetricTable(spark, folder, compact_every=3)
    for batch in range(11):
        store.put(kpis(spark, a=batch, b=1), "sum", batch, additive=True)
        store.put_once(kpis(spark, **{"first": batch, f"f{batch}": batch}), "once", batch)
    assert rows(store.increments("sum"), "field", "value") == [("a", 55), ("b", 11)]
    found = dict(rows(store.latest("once"), "field", "value"))
    assert found["first"] == "0" and len(found) == 12


# panel


def sales(spark, n, seed):
    rng = random.Random(seed)
    data = [
        (rng.choice("abcdefg"), rng.choice([None, "x", "y"]), rng.choice([None, rng.randrange(-500, 10**rng.randrange(1, 9))]), rng.randrange(0, 1000), "p" * rng.randrange(9))
        for _ in range(n)
    ]
    return spark.createDataFrame(data, "SID string, brand string, price long, at long, payload string")


def test_value_buckets_follow_the_order(spark):
    values = sorted({s * v for v in [*range(0, 700), 2**20 - 1, 2**20, 2**40, 2**62, 2**63 - 1] for s in (1, -1)})
    df = spark.createDataFrame([(v,) for v in values], "v long")
    found = [b for _, b in sorted((r.v, r.b) for r in df.select("v", st.value_bucket(F.col("v")).alias("b")).collect())]
    assert found == sorted(found)
    assert all(b == v for v, b in zip(values, found) if abs(v) < 256)


def test_panel_equals_a_rescan_after_every_batch(spark, folder):
    panel = st.IncrementalPanel(spark, folder, dims=("SID", "brand"), span=("at", 0, 960, 8), compact_every=2)
    seen = None
    for batch in range(5):
        part = sales(spark, 150, batch)
        for _ in range(1 + (batch == 3)):
            panel.add(part, batch)
        seen = part if seen is None else seen.unionByName(part)
    want = kpi_panel(seen.filter("price is not null"), "price").first()
    got = panel.figures().first()
    assert (got.n, got.total, got.median) == (seen.count(), want.total, want.median)
    assert got.bytes == seen.agg(F.sum(F.octet_length("payload"))).first()[0] and got.senders == 7
    for q in (0.0, 0.01, 0.9, 1.0):
        values = sorted(r.price for r in seen.filter("price is not null").collect())
        assert panel.order_statistic(q) == values[quantile_rank(len(values), q) - 1]
    per = seen.groupBy("brand").agg(F.count("*"), F.coalesce(F.sum("price"), F.lit(0)))
    assert rows(panel.by_key("brand"), "value", "n", "amount") == rows(per)
    assert rows(panel.time_distribution()) == rows(time_distribution(seen, "at", 0, 960, 8))


def test_empty_panel(spark, folder):
    panel = st.IncrementalPanel(spark, folder)
    panel.add(sales(spark, 3, 1).filter("at < 0"), 0)
    assert panel.order_statistic() is None and panel.figures().first().n == 0


# offsets and restarts


def _files(spark, folder, batch):
    spark.range(batch * 10, batch * 10 + 10).withColumn("k", F.col("id") % 3).coalesce(1).write.mode("append").parquet(folder + "/in")


def test_ledger_outlives_restarts(spark, folder):
    ledger = st.OffsetLedger(spark, folder + "/ledger", compact_every=2)
    for batch in range(4):
        _files(spark, folder, batch)
        stream = sources.open_stream(spark, "parquet", folder + "/in", "id long, k long")
        st.run_available(stream, "q", "append", path=folder + "/q", ledger=ledger)
    found = ledger.rows().orderBy("batch").collect()
    assert [(r.batch, r.source, r.rows) for r in found] == [(b, 0, 10) for b in range(4)]
    assert [r.start_offset for r in found] == [None] + [r.end_offset for r in found[:-1]]
    assert ledger.gaps().count() == 0
    log = st.checkpoint_offsets(spark, folder + "/q/checkpoint")
    assert rows(log, "batch", "end_offset", "committed") == [(r.batch, r.end_offset, True) for r in found]
    lost = st.OffsetLedger(spark, folder + "/lost")
    for batch in (0, 1, 3):
        lost.record(folder + "/q/checkpoint", batch)
    assert rows(lost.gaps(), "batch") == [(3,)]


def test_state_store_after_a_restart(spark, folder):
    for batch in range(2):
        _files(spark, folder, batch)
        stream = sources.open_stream(spark, "parquet", folder + "/in", "id long, k long")
        st.run_available(st.running_totals(stream, ["k"], "id"), "q", path=folder + "/q", keys=["k"])
    state = st.stored_state(spark, folder + "/q/checkpoint")
    found = state.select("key.k", F.col("value.count").alias("n"), F.col("value.sum").alias("s"))
    want = spark.range(20).groupBy((F.col("id") % 3).alias("k")).agg(F.count("*"), F.sum("id"))
    assert rows(found) == rows(want)
    assert rows(found) == rows(st.latest_rows(spark, folder + "/q/rows", ["k"]), "k", "n", "amount")
    operators = spark.read.format("state-metadata").load(folder + "/q/checkpoint")
    assert rows(operators, "operatorId", "minBatchId", "maxBatchId") == [(0, 0, 1)]


# windows


def plain_windows(panes, size, slide):
    out = defaultdict(list)
    for p in panes:
        first = (p[0] - size) // slide * slide + slide
        for start in range(first, p[0] // slide * slide + 1, slide):
            out[start, p[1]].append(p)
    return out


@pytest.mark.parametrize("size, slide, block", [(300, 6, 4), (60, 60, 1), (90, 60, 4096), (12, 6, 2), (30, 60, 3)])
def test_windows_equal_plain_sums(spark, size, slide, block, monkeypatch):
    monkeypatch.setattr(st.windows, "BLOCK_SLIDES", block)
    rng = random.Random(size)
    step = 6 if slide % 6 == 0 else slide
    places = [rng.randrange(-40, 120) * step for _ in range(60)] + [10_000 * step]
    panes = [(p, rng.choice(["a", "b", None]), rng.randrange(-5, 50), rng.randrange(4)) for p in sorted(set(places))]
    df = spark.createDataFrame(panes, "pane long, k string, n long, bytes long")
    found = st.windows_of_panes(df, size, slide, ["k"])
    want = {k: (sum(p[2] for p in v), sum(p[3] for p in v)) for k, v in plain_windows(panes, size, slide).items()}
    assert {(r.window_start, r.k): (r.n, r.bytes) for r in found.collect()} == want
    with pytest.raises(TypeError):
        st.windows_of_panes(df.withColumn("n", F.col("n") / 2), size, slide, ["k"])


def test_rows_do_not_grow_with_the_window(spark):
    panes = spark.range(0, 6000, 6).select(F.col("id").alias("pane"), F.lit(1).cast("long").alias("n"))
    plan = lambda size: st.windows_of_panes(panes, size, 6)._jdf.queryExecution().optimizedPlan().toString()
    assert plan(60).count("Generate") == plan(3000).count("Generate") == 2 * plan(60).count("inline(") // 2 + 1
    assert st.windows_of_panes(panes, 3000, 6).count() == 1000 + 499


@pytest.mark.parametrize("kind, bits", [("long", 2), ("long", 10), ("int", 3), ("double", 4), ("decimal(10,2)", 10)])
def test_window_medians_equal_sorted_picks(spark, kind, bits, monkeypatch):
    monkeypatch.setattr(st.windows, "DIGIT_BITS", bits)
    rng = random.Random(bits)
    counts = {(rng.randrange(30) * 6, rng.choice([rng.randrange(-9, 9), rng.randrange(2000)])): rng.randrange(1, 9) for _ in range(200)}
    data = [(p, str(v / 4) if kind.startswith("d") else str(v), n) for (p, v), n in counts.items()]
    df = spark.createDataFrame(data, "pane long, v string, n long").withColumn("v", F.col("v").cast(kind))
    df = df.unionByName(spark.createDataFrame([(0, None, 5)], "pane long, v string, n long").withColumn("v", F.col("v").cast(kind)))
    for q in (0.5, 0.95):
        found = st.window_median(df, 30, 6, "v", q)
        assert dict(found.dtypes)["median"] == dict(df.dtypes)["v"]
        got = {r.window_start: float(r.median) for r in found.collect()}
        want = {}
        for (start, _), panes in plain_windows([(p, None, v, n) for (p, v), n in counts.items()], 30, 6).items():
            values = sorted(v / 4 if kind.startswith("d") else v for _, _, v, n in panes for _ in range(n))
            want[start] = float(values[quantile_rank(len(values), q) - 1])
        assert got == want


def test_median_of_no_counts(spark):
    assert st.window_median(spark.createDataFrame([], "pane long, v long, n long"), 30, 6, "v").count() == 0


def test_state_of_twenty_conditions_is_its_masks(spark):
    conditions = [(f"c{i}", "1") for i in range(20)]
    rng = random.Random(2)
    data = [[rng.choice("01") if rng.random() < 0.5 else "0" for _ in range(20)] + [i, "p"] for i in range(40)]
    df = spark.createDataFrame(data, ", ".join(f"c{i} string" for i in range(20)) + ", price long, payload string")
    state = st.lattice_stream(df, conditions, "price", "payload")
    masks = {sum(1 << i for i in range(20) if r[i] == "1") for r in data}
    assert state.count() == len(masks)
    found = {r.subset: (r.n, r.amount) for r in st.lattice_subsets(state, conditions).collect()}
    assert found == {r.subset: (r.n, r.amount) for r in lattice_totals(df, conditions, "price").collect()}
    for subset in (0, 1, 1 << 19, (1 << 3) | (1 << 7)):
        rows_ = [r[20] for r in data if all(r[i] == "1" for i in range(20) if subset >> i & 1)]
        assert found.get(subset, (0, None)) == ((len(rows_), sum(rows_)) if rows_ else (0, None))


def test_a_run_finds_one_file_of_each_task_and_makes_one_batch(spark, folder):
    events = [(n, n % 5, "view", n / 4, f'{{"k": {n}}}') for n in range(400)]
    df = spark.createDataFrame(events, "event_id long, user_id long, event_type string, value double, props string")
    df.withColumn("ts", F.timestamp_seconds("event_id")).repartition(16).write.parquet(f"{folder}/events.parquet")
    files, batches = [], []

    def start(stream, checkpoint):
        names = os.listdir(checkpoint.removesuffix("/checkpoint").removeprefix("file:") + "/in")
        files.append(sum(name.endswith(".parquet") for name in names))
        writer = stream.writeStream.option("checkpointLocation", checkpoint)
        return writer.foreachBatch(lambda batch, n: batches.append((n, batch.count()))).trigger(availableNow=True).start()

    _in_two_runs(spark, folder, "runs", start)
    assert files[0] > 1 and files[1] > files[0] and batches == [(0, 200), (1, 200)]
