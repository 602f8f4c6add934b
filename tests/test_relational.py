from conftest import rows
from pyspark.sql import functions as F

from pulsegrid.operators import graph, joins, partitions, power, setops
from pulsegrid.operators.ranking import top_per_group

A = [(10, 1), (20, 2), (20, 3), (40, 5), (None, 6)]
B = [(20, 70), (20, 71), (30, 72), (None, 73)]


def pair(spark, data, value="v"):
    return spark.createDataFrame(data, f"k long, {value} long")


def test_joins_on_literals(spark):
    a, b = pair(spark, A), pair(spark, B, "w")
    inner = [(20, 2, 70), (20, 2, 71), (20, 3, 70), (20, 3, 71)]
    assert rows(joins.join_by_key(a, b, "k")) == inner
    assert joins.join_by_key(a, b, "k", "left").count() == 7
    assert joins.join_by_key(a, b, "k", "right").count() == 6
    assert rows(joins.anti_by_key(a, b, "k")) == [(10, 1), (40, 5), (None, 6)]


def test_outer_join_equals_plain_outer_join(spark):
    a, b = pair(spark, A + [(None, 8)]), pair(spark, B + [(9, 9), (None, 7)], "w")
    for how in ("left", "right"):
        assert rows(joins.outer_join(a, b, "k", how), "k", "v", "w") == rows(a.join(b, "k", how), "k", "v", "w")


def test_salted_join_equals_plain_join(spark):
    left = spark.range(500).select(F.when(F.col("id") < 300, 7).otherwise(F.col("id") % 20).alias("k"), "id")
    right = spark.range(15).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("inner", "left"):
        want = rows(left.join(right, "k", how))
        assert rows(joins.salted_join(left, right, "k", how, salts=4, hot_share=0.2), *left.join(right, "k", how).columns) == want


def test_cogroup_keeps_both_sides_and_copies(spark):
    found = joins.cogroup_rows(pair(spark, A + [(20, 2)]), pair(spark, B), "k", "v")
    want = [(10, "left", 1, 1), (20, "left", 2, 2), (20, "left", 3, 1), (40, "left", 5, 1), (None, "left", 6, 1)]
    want += [(20, "right", 70, 1), (20, "right", 71, 1), (30, "right", 72, 1), (None, "right", 73, 1)]
    assert sorted(rows(found), key=str) == sorted(want, key=str)


def test_values_of_a_key_with_nearly_all_rows(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") % 5_000).alias("v"))
    found = joins.value_rows(df.unionByName(spark.createDataFrame([("cold", 1), ("cold", 1)], "k string, v long")), "k", "v")
    assert rows(found.filter("k = 'cold'")) == [("cold", 1, 2)]
    assert found.count() == 5_001 and found.filter("copies = 4").count() == 5_000


def test_running_total(spark):
    df = spark.range(300).select((F.col("id") * 7 % 300).alias("x"), (F.col("id") % 5).alias("n")).repartition(5)
    found = [(r.n, r.upto) for r in partitions.running_total(df, ["x"], "n").orderBy("x").collect()]
    total = 0
    for n, upto in found:
        total += n
        assert upto == total
    assert len(found) == 300


def test_set_operations(spark):
    a = spark.createDataFrame([(21,), (8,), (8,), (40,), (8,), (None,)], "x int")
    b = spark.createDataFrame([(40,), (33,), (None,), (21,)], "x int")
    assert rows(setops.subtract_keep(a, b)) == [(8,), (8,), (8,)]
    assert rows(setops.intersect_set(a, b)) == [(21,), (40,), (None,)]
    assert setops.union_bag(a, b).count() == 10
    assert setops.distinct_rows(a).count() == 4


def test_row_index_and_zip(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1009).alias("x")).repartition(6)
    indexed = partitions.row_index(df, ["x"])
    ordered = [r.x for r in indexed.orderBy("pos").collect()]
    assert ordered == sorted(ordered) and [r.pos for r in indexed.orderBy("pos").collect()] == list(range(1000))
    zipped = joins.zip_by_position(df, df.withColumnRenamed("x", "y"), ["x"], [F.desc("y")])
    assert zipped.filter("pos = 0").select("x", "y").first() == (ordered[0], ordered[-1])


def test_zip_needs_equal_sizes(spark):
    import pytest

    with pytest.raises(ValueError):
        joins.zip_by_position(spark.range(3), spark.range(4).toDF("y"), ["id"], ["y"])


def test_lookup_dim_same_result_with_and_without_broadcast(spark):
    facts, dim = spark.range(100).withColumn("k", F.col("id") % 5), spark.range(4).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    small = joins.lookup_dim(facts, dim, "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(small) == rows(joins.lookup_dim(facts, dim, "k")) and small.count() == 80
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tagged_partitions_split_a_hot_key(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    tagged = partitions.tagged_partitions(df, "k", 4)
    assert tagged.groupBy("partition").count().count() > 1


def test_layouts(spark):
    df = spark.range(100).withColumn("k", F.lit(1))
    assert partitions.layout(df, 3).rdd.getNumPartitions() == 3
    assert partitions.layout(df.repartition(8), 2, shrink=True).rdd.getNumPartitions() == 2
    spread = partitions.layout(df, 16, "k", spread=8).withColumn("p", F.spark_partition_id())
    assert spread.select("p").distinct().count() > 1 and spread.count() == 100


def test_top_per_group_limits_before_the_shuffle(spark, folder):
    spark.range(1000).withColumn("g", F.col("id") % 3).write.parquet(folder + "/t")
    top = top_per_group(spark.read.parquet(folder + "/t"), ["g"], [F.desc("id")], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert rows(top, "g", "id") == sorted([(0, 999), (0, 996), (1, 997), (1, 994), (2, 998), (2, 995)], key=lambda r: [str(x) for x in r])


def test_power_rollups(spark):
    data = [
        ("2007-01-31 12:05:00", 60.0, 6.0, 500.0, 0.0, 1.0),
        ("2007-01-31 00:05:00", 30.0, 0.0, 500.0, 0.0, 1.0),
        ("2007-02-01 00:00:00", 6.0, 3.0, 0.0, 0.0, 1.0),
    ]
    df = spark.createDataFrame(data, "t string, active_kw double, reactive_kw double, kitchen double, laundry double, bedroom double")
    readings = df.withColumn("ts", F.to_timestamp("t"))
    assert rows(power.power_by_month(readings)) == [("2007年01月", 1.5, 0.1), ("2007年02月", 0.1, 0.05)]
    assert rows(power.power_by_day(readings, 2007, 1)) == [(31, 1.5, 0.1)]
    summary = power.power_summary(readings).first()
    assert summary.active_mean_kw == 32.0 and summary.active_median_kw == 30.0 and summary.total_kwh == 1.6
    assert rows(power.appliance_by(readings, "month"))[0] == ("2007年01月", "bedroom", 0.002)
    # both bounds are included, and later the same day is not
    assert power.between_times(readings, "2007-01-31 00:05:00", "2007-02-01 00:00:00").count() == 3
    assert power.between_times(readings, "2007-01-31 00:00:00", "2007-01-31 00:05:00").count() == 1
    assert rows(power.minute_profile(readings, "active_kw")) == [(0, 6.0, 1), (5, 30.0, 1), (725, 60.0, 1)]
    series = power.month_series(power.power_by_month(readings), "active_kwh").first()
    assert (series.months, series.amounts) == ("2007年01月,2007年02月", "1.5,0.1")


def test_appliance_hours_are_whole(spark):
    df = spark.range(125).select(
        F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.lit(10.0).alias("kitchen"), F.lit(0.0).alias("laundry"), F.lit(1.0).alias("bedroom")
    )
    found = {r.room: r for r in power.appliance_usage(df).collect()}
    assert (found["kitchen"].days, found["kitchen"].hours, found["kitchen"].kwh) == (1, 2, 1.25)
    assert found["laundry"].hours == 0 and found["kitchen"].hours_per_day == 2.0


# a tie in age, a parallel edge, and a vertex without edges
TOWNS = [(11, "Oda", 310), (12, "Pyr", 95), (13, "Quo", 310), (14, "Rim", 12), (15, "Sol", 740)]
ROADS = [(11, 12, 4), (13, 12, 6), (14, 11, 1), (12, 13, 9), (12, 13, 2), (14, 12, 5), (11, 14, 3)]


def test_graph_on_literals(spark):
    vertices = spark.createDataFrame(TOWNS, "id long, name string, age long")
    edges = spark.createDataFrame(ROADS, "src long, dst long, weight long")
    assert rows(graph.graph_size(vertices, edges)) == [("edges", 7), ("vertices", 5)]
    found = {r.id: (r.in_degree, r.out_degree) for r in graph.degrees(vertices, edges).collect()}
    assert found == {11: (1, 2), 12: (3, 2), 13: (2, 1), 14: (1, 2), 15: (0, 0)}
    followers = {r.id: (r.follower, r.follower_age) for r in graph.oldest_follower(vertices, edges).collect()}
    assert followers == {11: ("Rim", 12), 12: ("Oda", 310), 13: ("Pyr", 95), 14: ("Oda", 310), 15: ("none", None)}
    kept, inner = graph.subgraph(vertices, edges, F.col("age") > 50)
    assert kept.count() == 4 and rows(inner, "src", "dst") == [(11, 12), (12, 13), (12, 13), (13, 12)]
    assert ("Pyr", "Quo", 9) in rows(graph.triplets(vertices, edges, ["name"]), "src_name", "dst_name", "weight")


def test_conditions_reach_the_files(spark, folder):
    from pulsegrid.operators import filters

    spark.sql("SELECT 'a' AS brand, timestamp'2008-05-01 00:00:00' AS ts").write.parquet(folder + "/t")
    df = spark.read.parquet(folder + "/t")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(brand,a)" in plan(filters.condition_filter(df, [("brand", "a")]))
    assert "EqualTo(brand,a)" in plan(filters.or_filter(df, [("brand", "a"), ("brand", "b")]))
    train, test = filters.year_split(df, "ts", [2007, 2008], [2009])
    assert "GreaterThanOrEqual(ts," in plan(train) and train.count() == 1 and test.count() == 0
