"""Source and sink queries: tables written in each input format and read back, and raw texts parsed."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid import sinks, sources
from pulsegrid.functions import cents
from pulsegrid.operators.ranking import rank_by_count
from pulsegrid.plans.registry import query
from pulsegrid.plans.tables import EVENTS, RATINGS, SALES, event_messages, part_titles, rating_triples, sale_lines, sale_messages, table
from pulsegrid.session import work_path


@query("json_lines_totals", f"WITH {SALES} SELECT brand, count(*) AS n, CAST(sum(price) AS BIGINT) AS total FROM sl GROUP BY 1")
def json_lines_totals(spark, sf):
    """Text lines written, scanned and parsed once."""
    path = work_path(spark, "json_lines")
    sinks.write_lines(sale_lines(spark, sf), path)
    parsed = sources.parse_messages(sources.read_lines(spark, path))
    return parsed.groupBy("brand").agg(F.count("*").alias("n"), F.sum("price").alias("total"))


@query(
    "array_batch_split",
    """SELECT sid, count(*) AS n, CAST(sum(price) AS BIGINT) AS total FROM (
         SELECT CAST(l_suppkey AS VARCHAR) AS sid, CAST(l_quantity AS BIGINT) AS price FROM lineitem
         UNION ALL SELECT CAST(l_partkey AS VARCHAR), CAST(l_linenumber AS BIGINT) FROM lineitem) t GROUP BY 1""",
)
def array_batch_split(spark, sf):
    """Two glued array batches per line of text."""
    lines = table(spark, sf, "lineitem").select(
        F.concat(
            F.lit('[{"SID":"'), "l_suppkey", F.lit('","price":'), F.col("l_quantity").cast("long"),
            F.lit('}][{"SID":"'), "l_partkey", F.lit('","price":"'), "l_linenumber", F.lit('"}]'),
        ).alias("payload")
    )
    from pulsegrid.schema import MESSAGE

    # a quoted number is a number too, so the amount is read as text and cast
    layout = type(MESSAGE)([MESSAGE["SID"], type(MESSAGE["SID"])("price", MESSAGE["SID"].dataType)])
    rows = sources.split_batches(lines, layout)
    return rows.groupBy(F.col("SID").alias("sid")).agg(
        F.count("*").alias("n"), F.sum(F.col("price").cast("long")).alias("total")
    )


@query(
    "lenient_parse_counts",
    "SELECT (SELECT count(*) FROM events) AS good_records, (SELECT count(*) FROM documents) AS bad_records",
)
def lenient_parse_counts(spark, sf):
    """JSON payloads mixed with prose: the prose is counted as bad, nothing is lost."""
    lines = table(spark, sf, "events").select(F.col("props").alias("payload")).unionByName(
        table(spark, sf, "documents").select(F.col("text").alias("payload"))
    )
    from pyspark.sql import types as T

    parsed = sources.parse_lenient(lines, T.StructType([T.StructField("k", T.LongType())]))
    return sources.parse_quality(parsed)


@query(
    "inferred_schema_totals",
    "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1",
)
def inferred_schema_totals(spark, sf):
    lines = table(spark, sf, "events").select(F.col("props").alias("payload"))
    return sources.infer_json(lines).groupBy("k").agg(F.count("*").alias("n"))


@query(
    "envelope_strip",
    "SELECT event_id, props AS payload FROM events",
)
def envelope_strip(spark, sf):
    """A 24-character digest behind each payload is removed again."""
    wrapped = table(spark, sf, "events").select(
        "event_id", F.concat("props", F.substring(F.md5(F.col("event_id").cast("string")), 1, 24)).alias("payload")
    )
    return sources.strip_envelope(wrapped)


@query(
    "meter_file",
    """SELECT CAST(day(ts) AS INTEGER) AS day, count(*) AS n, CAST(sum(CAST(floor(value * 100 + 0.5) AS BIGINT)) AS BIGINT) AS total,
              CAST(sum(hour(ts) * 60 + minute(ts)) AS BIGINT) AS minutes FROM events WHERE event_type <> 'error' GROUP BY 1""",
)
def meter_file(spark, sf):
    """Meter text file; readings of failed events carry the missing marker and are dropped."""
    path = work_path(spark, "meter")
    value = F.when(F.col("event_type") == "error", "?").otherwise(F.col("value").cast("string"))
    sinks.write_lines(
        table(spark, sf, "events").select(
            F.date_format("ts", "dd/MM/yyyy").alias("d"),
            F.date_format("ts", "HH:mm:ss").alias("t"),
            value.alias("v"),
            *[F.lit(str(float(i))).alias(f"c{i}") for i in range(6)],
        ),
        path,
        sep=";",
    )
    readings = sources.read_meter(spark, path)
    return readings.groupBy(F.dayofmonth("ts").alias("day")).agg(
        F.count("*").alias("n"),
        F.sum(cents("active_kw")).alias("total"),
        F.sum(F.hour("ts") * 60 + F.minute("ts")).alias("minutes"),
    )


@query(
    "ratings_file",
    f"""WITH {RATINGS} SELECT "user", count(*) AS n, CAST(sum(rating) AS DOUBLE) AS total FROM rt GROUP BY 1""",
)
def ratings_file(spark, sf):
    path = work_path(spark, "ratings")
    sinks.write_lines(rating_triples(spark, sf).withColumn("stamp", F.lit(881250949)), path, sep="\t")
    return sources.read_ratings(spark, path).groupBy("user").agg(F.count("*").alias("n"), F.sum("rating").alias("total"))


@query(
    "item_genres",
    """SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS title,
              CASE WHEN p_size > 25 THEN 'BIG ' ELSE '' END || p_type || CASE WHEN p_retailprice > 1000 THEN ' DEAR' ELSE '' END AS genres FROM part""",
)
def item_genres(spark, sf):
    """Pipe file with 0/1 flags; flag names come from a second table."""
    path = work_path(spark, "items")
    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    flags = [F.col("p_size") > 25, *[F.col("p_type") == t for t in types], F.col("p_retailprice") > 1000]
    sinks.write_lines(
        table(spark, sf, "part").select(
            "p_partkey",
            "p_name",
            *[F.lit("-").alias(f"x{i}") for i in range(3)],
            *[F.when(f, "1").otherwise("0").alias(f"f{i}") for i, f in enumerate(flags)],
        ),
        path,
        sep="|",
    )
    names = spark.createDataFrame([(n, i) for i, n in enumerate(["BIG", *types, "DEAR"])], "name string, index int")
    items = sources.genres_of_items(sources.read_items(spark, path, "UTF-8"), names)
    return items.select("id", "title", F.array_join("genres", " ").alias("genres"))


@query(
    "labelled_table",
    """SELECT c_mktsegment AS category, count(*) AS n, CAST(sum(CASE WHEN c_nationkey >= 10 THEN 1 ELSE 0 END) AS DOUBLE) AS positives,
              CAST(sum(CASE WHEN c_nationkey % 5 = 0 THEN 0 ELSE c_nationkey END) AS DOUBLE) AS total FROM customer GROUP BY 1""",
)
def labelled_table(spark, sf):
    """Quoted tab-separated table with missing markers and negative numbers."""
    path = work_path(spark, "labelled")

    def quoted(c):
        return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))

    key = F.col("c_nationkey")
    rows = table(spark, sf, "customer").select(
        quoted(F.col("c_custkey")).alias("a"),
        quoted(F.col("c_name")).alias("b"),
        quoted(F.lit("x")).alias("c"),
        quoted(F.col("c_mktsegment")).alias("d"),
        F.when(F.pmod(key, F.lit(5)) == 0, quoted(F.lit("?"))).otherwise(quoted(key)).alias("e"),
        quoted(-key).alias("f"),
        quoted(F.when(key >= 10, 1).otherwise(0)).alias("g"),
    )
    sinks.write_lines(rows, path, sep="\t")
    parsed = sources.read_labelled_tsv(spark, path, clip_negative=True, header=False)
    total = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x)
    return parsed.groupBy("category").agg(
        F.count("*").alias("n"), F.sum("label").alias("positives"), F.sum(total).alias("total")
    )


@query("typed_csv", "SELECT c_name AS name FROM customer WHERE c_nationkey BETWEEN 13 AND 19")
def typed_csv(spark, sf):
    path = work_path(spark, "people")
    sinks.write_lines(table(spark, sf, "customer", "c_name", "c_nationkey"), path, sep=", ")
    return sources.read_typed_csv(spark, path, "name string, age long").filter("age between 13 and 19").select("name")


@query(
    "vector_file",
    """SELECT count(*) AS vectors, CAST(sum(len(embedding)) AS BIGINT) AS numbers,
              CAST(sum(len(list_filter(embedding, lambda x: x > 0))) AS BIGINT) AS positives FROM embeddings""",
)
def vector_file(spark, sf):
    path = work_path(spark, "vectors")
    sinks.write_lines(table(spark, sf, "embeddings").select(F.concat_ws(" ", F.col("embedding").cast("array<string>")).alias("v")), path)
    vectors = sources.read_vectors(spark, path)
    return vectors.agg(
        F.count("*").alias("vectors"),
        F.sum(F.size("embedding")).alias("numbers"),
        F.sum(F.size(F.filter("embedding", lambda x: x > 0))).alias("positives"),
    )


@query(
    "libsvm_file",
    """SELECT CAST(label AS DOUBLE) AS label, count(*) AS n, CAST(sum(len(list_filter(embedding, lambda x: x <> 0))) AS BIGINT) AS nonzeros FROM embeddings GROUP BY 1""",
)
def libsvm_file(spark, sf):
    from pyspark.ml.functions import vector_to_array

    path = work_path(spark, "libsvm")
    cells = F.transform("embedding", lambda x, i: F.concat((i + 1).cast("string"), F.lit(":"), x.cast("string")))
    sinks.write_lines(table(spark, sf, "embeddings").select(F.concat_ws(" ", F.col("label").cast("string"), cells).alias("v")), path)
    points = sources.read_libsvm(spark, path, 64).withColumn("x", vector_to_array("features"))
    return points.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(F.size(F.filter("x", lambda v: v != 0))).alias("nonzeros")
    )


@query(
    "parquet_projection",
    f"WITH {SALES} SELECT sid, CAST(sum(price) AS DOUBLE) / count(*) AS average FROM sl GROUP BY 1",
)
def parquet_projection(spark, sf):
    """A projection stored as Parquet; the report reads two of its columns."""
    path = work_path(spark, "projection")
    sinks.write_projection(sale_messages(spark, sf), path, ["SID", "price", "saleTime"])
    stored = sources.read_parquet(spark, path, ["SID", "price"])
    return stored.groupBy(F.col("SID").alias("sid")).agg((F.sum("price") / F.count("*")).alias("average"))


RANGE_START, RANGE_STOP = 1704499200000, 1705363200000


@query(
    "key_range_scan",
    f"""WITH {EVENTS} SELECT sid, count(*) AS n, CAST(sum(price) AS BIGINT) AS total FROM ev
        WHERE saletime >= {RANGE_START} AND saletime < {RANGE_STOP} GROUP BY 1""",
)
def key_range_scan(spark, sf):
    """Cells stored by day under their time key; the scan opens only the days it needs."""
    path = work_path(spark, "cells")
    cells = event_messages(spark, sf).select(
        F.col("saleTime").alias("row_key"),
        F.lit("price").alias("family"),
        F.concat_ws("_", "SID", "event_id").alias("qualifier"),
        F.col("price").cast("string").alias("value"),
    )
    sources.write_cells(cells, path)
    found = sources.scan_cells(spark, path, RANGE_START, RANGE_STOP, family="price")
    return found.groupBy(F.substring_index("qualifier", "_", 1).alias("sid")).agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total")
    )


@query(
    "column_family_scan",
    f"WITH {EVENTS} SELECT CAST(sum(price) AS BIGINT) AS total, count(*) AS n FROM ev",
)
def column_family_scan(spark, sf):
    """Two families per message; only one is read."""
    path = work_path(spark, "families")
    base = event_messages(spark, sf)
    qualifier = F.concat_ws("_", "SID", "event_id").alias("qualifier")
    cells = base.select(
        F.col("saleTime").alias("row_key"),
        qualifier,
        F.explode(
            F.array(
                F.struct(F.lit("cf").alias("family"), F.col("payload").alias("value")),
                F.struct(F.lit("price").alias("family"), F.col("price").cast("string").alias("value")),
            )
        ).alias("c"),
    ).select("row_key", "c.family", "qualifier", "c.value")
    sources.write_cells(cells, path)
    found = sources.scan_cells(spark, path, 0, 4102444800000, family="price")
    return found.agg(F.sum(F.col("value").cast("long")).alias("total"), F.count("*").alias("n"))


@query("source_filter_count", "SELECT count(*) AS n FROM customer WHERE c_acctbal >= 1800")
def source_filter_count(spark, sf):
    path = work_path(spark, "users")
    sinks.write_rows(table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), "c_name", "c_acctbal"), path)
    return sources.read_parquet(spark, path, ["c_acctbal"]).filter(F.col("c_acctbal") >= 1800).agg(F.count("*").alias("n"))


@query(
    "sequence_file",
    f"WITH {EVENTS} SELECT brand, count(*) AS n, CAST(sum(price) AS BIGINT) AS total FROM ev GROUP BY 1",
)
def sequence_file(spark, sf):
    path = work_path(spark, "sequence")
    sources.write_sequence_pairs(event_messages(spark, sf), path, "brand", "price")
    pairs = sources.read_sequence_pairs(spark, path)
    return pairs.groupBy(F.col("key").alias("brand")).agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total")
    )


@query("whole_files", "SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM conversations")
def whole_files(spark, sf):
    """Texts stored as files and read back file by file."""
    path = work_path(spark, "whole")
    sinks.write_lines(table(spark, sf, "conversations", "text"), path)
    files = sources.read_whole_files(spark, path, "part-*")
    return files.agg(F.sum(F.octet_length("content").cast("long")).alias("bytes"))


@query(
    "offset_replay",
    """SELECT "partition", count(*) AS n, min("offset") AS first, max("offset") AS last FROM (
         SELECT CAST(strlen(event_type) AS INTEGER) AS "partition", event_id AS "offset" FROM events) l
       WHERE ("partition" = 5 AND "offset" >= 100 AND "offset" < 1000000000000) OR ("partition" = 8 AND "offset" >= 0 AND "offset" < 1000000000000) GROUP BY 1""",
)
def offset_replay(spark, sf):
    """Replay of a stored log by partition and offsets."""
    log = table(spark, sf, "events").select(F.length("event_type").alias("partition"), F.col("event_id").alias("offset"))
    found = sources.offset_range(log, [(5, 100, 10**12), (8, 0, 10**12)])
    return found.groupBy("partition").agg(F.count("*").alias("n"), F.min("offset").alias("first"), F.max("offset").alias("last"))


@query(
    "archived_batches",
    f"""WITH {EVENTS} SELECT sid, count(*) AS n FROM (SELECT sid FROM ev UNION ALL SELECT sid FROM ev) t GROUP BY 1""",
)
def archived_batches(spark, sf):
    """Array batches of two messages stored as cells; a payload that is no array gives none."""
    path = work_path(spark, "archive")
    message = F.to_json(F.struct("SID", "price"))
    batches = event_messages(spark, sf).select(
        "saleTime", F.concat(F.lit("["), message, F.lit(","), message, F.lit("]")).alias("payload")
    )
    broken = event_messages(spark, sf).select("saleTime", F.lit("not a batch").alias("payload"))
    sources.write_cells(sinks.archive_cells(batches.unionByName(broken), F.col("saleTime")), path)
    cells = sources.scan_cells(spark, path, 0, 4102444800000, family="cf")
    return cells.groupBy(F.get_json_object("value", "$.SID").alias("sid")).agg(F.count("*").alias("n"))


@query(
    "keyed_upsert",
    f"WITH {EVENTS} SELECT 'ranks' AS result_key, sid AS field, CAST(count(*) AS VARCHAR) AS value FROM ev GROUP BY 2",
)
def keyed_upsert(spark, sf):
    """Results written twice; readers see the later value of each field."""
    counts = rank_by_count(event_messages(spark, sf), "SID")
    store = sinks.MetricTable(spark, work_path(spark, "upsert"))
    rows = sinks.metric_rows(counts, F.lit("ranks"), field=F.col("SID"), value=F.col("n"))
    store.put(rows.withColumn("value", F.lit("0")), "rank", 0)
    store.put(rows, "rank", 1)
    return store.latest("rank")


@query(
    "keyed_increments",
    f"WITH {EVENTS} SELECT 'totals' AS result_key, brand AS field, CAST(sum(price) AS BIGINT) AS value FROM ev GROUP BY 2",
)
def keyed_increments(spark, sf):
    """Two batches of increments, the second written twice as after a failure."""
    sums = event_messages(spark, sf).groupBy("brand", F.month("ts").alias("m"), (F.dayofmonth("ts") > 15).alias("late")).agg(
        F.sum("price").alias("total")
    )
    store = sinks.MetricTable(spark, work_path(spark, "increments"))
    for batch_id, late in ((0, False), (1, True), (1, True)):
        part = sums.filter(F.col("late") == late)
        store.put(sinks.metric_rows(part, F.lit("totals"), field=F.col("brand"), value=F.col("total")), "total", batch_id, additive=True)
    return store.increments("total")


@query(
    "user_top_titles",
    f"""WITH {RATINGS}, u AS (SELECT min("user") AS u FROM rt)
        SELECT product, "user", rating, p_name AS title FROM (SELECT * FROM rt WHERE "user" = (SELECT u FROM u) ORDER BY rating DESC, product LIMIT 10) t
        JOIN part ON p_partkey = product""",
)
def user_top_titles(spark, sf):
    from pulsegrid.operators.ranking import user_top_items

    ratings = rating_triples(spark, sf)
    first = table(spark, sf, "orders").join(
        table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi"
    ).agg(F.min("o_custkey").alias("u")).first().u
    return user_top_items(ratings, part_titles(spark, sf), int(first), 10)
