import json
import os

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid import sinks, sources
from pulsegrid.schema import MESSAGE, READING


def text(path, *lines):
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    return path


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "payload string")


def test_lines_and_messages(spark, folder):
    path = text(folder + "/a.txt", '{"SID":"a","price":5}', '{"SID":"b","price":"x"}')
    parsed = sources.parse_messages(sources.read_lines(spark, path))
    assert rows(parsed, "SID", "price") == [("a", 5), ("b", None)]


def test_glued_batches_keep_every_object(spark):
    raw = lines(spark, '[{"SID":"a"},{"SID":"b"}][{"SID":"c"}]', '[{"SID":"d"}] [{"SID":"e"}]', "[]", "junk")
    assert rows(sources.split_batches(raw), "SID", "idx") == [("a", 0), ("b", 1), ("c", 2), ("d", 0), ("e", 1)]


def test_lenient_parse_keeps_bad_rows(spark):
    parsed = sources.parse_lenient(lines(spark, '{"SID":"a","price":1}', "{broken", "", "[1"), MESSAGE)
    quality = sources.parse_quality(parsed).first()
    assert (quality.good_records, quality.bad_records) == (1, 3)
    assert parsed.count() == 4


def test_inferred_schema(spark):
    found = sources.infer_json(lines(spark, '{"a":1}', '{"a":2,"b":"x"}'))
    assert dict(found.dtypes)["a"] == "bigint" and rows(found, "a", "b") == [(1, None), (2, "x")]


def test_envelope(spark):
    assert sources.strip_envelope(lines(spark, "payload" + "d" * 24, "short")).collect() == [("payload",), ("",)]


def test_meter_lines(spark, folder):
    path = text(
        folder + "/m.csv",
        "16/12/2006;17:24:00;4.216;0.418;234.840;18.400;0.000;1.000;17.000",
        "16/12/2006;17:25:00;?;?;?;?;?;?;?",
        "1/1/2007;12:05:00;2;0;230;8;1;2;",
        "1/1/2007;12:06:00;2;0;230;8;1;2;3",
    )
    found = sources.read_meter(spark, path)
    assert rows(found.select(F.date_format("ts", "yyyy-MM-dd HH:mm"), "active_kw", "bedroom")) == [
        ("2006-12-16 17:24", 4.216, 17.0),
        ("2007-01-01 12:06", 2.0, 3.0),
    ]


def test_ratings_items_genres(spark, folder):
    ratings = sources.read_ratings(spark, text(folder + "/u.data", "196\t242\t3\t881250949", "186\t302\t3.5\t891717742"))
    assert rows(ratings) == [(186, 302, 3.5), (196, 242, 3.0)]
    items = sources.read_items(spark, text(folder + "/u.item", "1|Toy|d||u|0|1|1", "2|Non|d||u|0|0|0"))
    genres = spark.createDataFrame([("unknown", 0), ("Action", 1), ("War", 2)], "name string, index int")
    assert rows(sources.genres_of_items(items, genres)) == [(1, "Toy", ["Action", "War"]), (2, "Non", [])]


def test_labelled_tsv(spark, folder):
    path = text(
        folder + "/t.tsv",
        '"url"\t"id"\t"text"\t"cat"\t"x"\t"y"\t"label"',
        '"u"\t"1"\t"has, comma"\t"news"\t"0.5"\t"?"\t"1"',
        '"v"\t"2"\t"z"\t"?"\t"-3"\t"2"\t"0"',
    )
    plain = sources.read_labelled_tsv(spark, path)
    assert rows(plain) == [(0.0, "?", [-3.0, 2.0]), (1.0, "news", [0.5, 0.0])]
    clipped = sources.read_labelled_tsv(spark, path, clip_negative=True)
    assert rows(clipped)[0] == (0.0, "?", [0.0, 2.0])


def test_csv_vectors_libsvm(spark, folder):
    people = sources.read_typed_csv(spark, text(folder + "/p.csv", "Ann, 29", "Bob, 13"), "name string, age long")
    assert rows(people.filter("age between 13 and 19")) == [("Bob", 13)]
    vectors = sources.read_vectors(spark, text(folder + "/v.txt", "0.0 1.5  2", "9 9 9"))
    assert rows(vectors) == [([0.0, 1.5, 2.0],), ([9.0, 9.0, 9.0],)]
    points = sources.read_libsvm(spark, text(folder + "/l.txt", "1 1:0.5 3:2", "0 2:1"), 3)
    assert sorted((r.label, r.features.toArray().tolist()) for r in points.collect()) == [
        (0.0, [0.0, 1.0, 0.0]),
        (1.0, [0.5, 0.0, 2.0]),
    ]


def test_sequence_and_whole_files(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    sources.write_sequence_pairs(df, folder + "/seq", "k", "v")
    assert rows(sources.read_sequence_pairs(spark, folder + "/seq")) == [("a", "1"), ("b", "2")]
    os.mkdir(folder + "/w")
    text(folder + "/w/one.txt", "hello")
    found = sources.read_whole_files(spark, folder + "/w", "*.txt").first()
    assert found.path.endswith("one.txt") and bytes(found.content) == b"hello\n"


def cells(spark):
    day = 86_400_000
    data = [(0, "cf", "a_0", "x"), (day - 1, "cf", "a_1", "y"), (day, "price", "a_1", "5"), (3 * day, "cf", "b_0", "z")]
    return spark.createDataFrame(data, "row_key long, family string, qualifier string, value string"), day


def test_key_range_is_half_open_and_prunes_days(spark, folder):
    table, day = cells(spark)
    sources.write_cells(table, folder + "/c")
    assert rows(sources.scan_cells(spark, folder + "/c", 0, day), "value") == [("x",), ("y",)]
    assert rows(sources.scan_cells(spark, folder + "/c", day - 1, day + 1), "value") == [("5",), ("y",)]
    assert sources.scan_cells(spark, folder + "/c", 0, 10 * day, family="price").count() == 1
    plan = sources.scan_cells(spark, folder + "/c", 0, day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(row_key" in plan


def test_offset_ranges(spark):
    log = spark.createDataFrame([(0, i) for i in range(10)] + [(1, i) for i in range(10)], "partition int, offset long")
    assert rows(sources.offset_range(log, [(0, 2, 4), (1, 9, 100)])) == [(0, 2), (0, 3), (1, 9)]


def test_text_output_replaces_the_old_one(spark, folder):
    sinks.write_lines(spark.range(3), folder + "/o")
    sinks.write_lines(spark.createDataFrame([("a", 1)], "k string, v int"), folder + "/o")
    assert rows(sources.read_lines(spark, folder + "/o")) == [("a,1",)]


def test_archive_keeps_every_message(spark):
    batches = lines(spark, '[{"SID":"a","v":1}][{"SID":"a","v":2}]', "junk", '[{"v":1}]')
    found = sinks.archive_cells(batches, F.lit(1000))
    want = [("_0", '{"v":1}'), ("a_0", '{"SID":"a","v":1}'), ("a_1", '{"SID":"a","v":2}')]
    assert rows(found) == [(1000, "cf", *x) for x in want]
    assert found.count() == sources.split_batches(batches).count()


def kpis(spark, **fields):
    return spark.createDataFrame([("k", f, str(v)) for f, v in fields.items()], "result_key string, field string, value string")


def test_metric_table(spark, folder):
    store = sinks.MetricTable(spark, folder + "/m")
    assert store.latest().count() == 0
    store.put(kpis(spark, a=1, b=2), "q", 0)
    store.put(kpis(spark, b=3), "q", 1)
    store.put(kpis(spark, b=3), "q", 1)
    assert rows(store.latest("q"), "field", "value") == [("a", "1"), ("b", "3")]
    assert rows(store.increments("q"), "field", "value") == [("a", 1), ("b", 5)]
    store.put(kpis(spark, a=9, c=9), "q", 2, ttl_seconds=-5)
    assert rows(store.latest("q"), "field") == [("b",)]
    store.publish(kpis(spark, p=1), "q2", 0, "news")
    assert rows(store.latest(channel="news"), "field") == [("p",)]
    store.compact("q2", "q3")
    assert rows(store.latest("q3"), "field", "value") == [("p", "1")]


def test_put_once(spark, folder):
    store = sinks.MetricTable(spark, folder + "/m")
    store.put_once(kpis(spark, a=1), "q", 0)
    store.put_once(kpis(spark, a=2, b=2), "q", 1)
    assert rows(store.latest(), "field", "value") == [("a", "1"), ("b", "2")]


def test_report_json(spark):
    report = sinks.report_json(kpis(spark, b=2, a=1), "job_1")
    assert tuple(report.first()) == ("job_1", "report", '[{"a":"1"},{"b":"2"}]')


def test_glue_inside_values_stays(spark):
    texts = [
        '[{"SID":"a][b","v":"x] ["}][{"SID":"c"}]',
        r'[{"SID":"q\"][\""}] [{"SID":"d][", "v":"\\"}][{"SID":"][e"}]',
        '[{"SID":"plain"}]',
        "no array",
    ]
    want = ["a][b", "c", 'q"]["', "d][", "][e", "plain"]
    assert [r.SID for r in sources.split_batches(lines(spark, *texts)).collect()] == want
    assert sorted(json.loads(r.value)["SID"] for r in sinks.archive_cells(lines(spark, *texts), F.lit(1)).collect()) == sorted(want)


def test_batch_log_is_replaced_on_retry(spark, folder):
    for _ in range(2):
        sinks.batch_log(spark.range(2), folder + "/log", 7)
    found = sources.read_lines(spark, folder + "/log").collect()
    assert len(found) == 2 and all(r.payload.startswith("7 ") for r in found)


def test_reading_schema_accepts_quoted_numbers(spark):
    texts = T.StructType([T.StructField("UA", T.StringType())])
    parsed = sources.parse_messages(lines(spark, '{"UA":"1.5"}', '{"UA":2}'), texts)
    assert parsed.agg(F.sum(F.col("UA").cast("double"))).first()[0] == 3.5
    assert READING["UA"].dataType == T.DoubleType()
