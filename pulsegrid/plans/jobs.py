"""Whole reports over stored messages and readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid import jobs
from pulsegrid.plans.messages import SALE_END, SALE_RULES, SALE_START, _report_sql
from pulsegrid.plans.power import _MONTH
from pulsegrid.plans.registry import query
from pulsegrid.plans.tables import METER, SALES, meter_readings, sale_messages
from pulsegrid.session import work_path
from pulsegrid.sinks import MetricTable
from pulsegrid.sources import write_cells

# results of a checked query must outlive the check
DAY = 86_400

_PANEL = """r AS (SELECT price, row_number() OVER (ORDER BY price) AS pos, count(*) OVER () AS c FROM sl),
  p AS (SELECT count(*) AS n, CAST(sum(price) AS BIGINT) AS total, CAST(sum(strlen(payload)) AS BIGINT) AS bytes FROM sl),
  m AS (SELECT price AS median FROM r WHERE pos = greatest(1, floor((c + 1) * 0.5::DOUBLE)))"""


ALL_TIME = (0, 253_402_300_800_000)


def _stored_sales(spark, sf, start=ALL_TIME[0], stop=ALL_TIME[1]):
    """The JSON lines stored as cells under the first day of their year, so that few folders hold them."""
    path = work_path(spark, "sale_cells")
    sales = sale_messages(spark, sf)
    year = F.unix_millis(F.date_trunc("year", "ts").cast("timestamp"))
    write_cells(
        sales.select(
            year.alias("row_key"), F.lit("cf").alias("family"), F.col("SID").alias("qualifier"), F.col("payload").alias("value")
        ),
        path,
    )
    return jobs.stored_messages(spark, path, start, stop)


def _store(spark, name):
    return MetricTable(spark, work_path(spark, name))


@query(
    "total_report_job",
    f"""WITH {SALES}, {_PANEL} SELECT 'total' AS result_key, field, value FROM (
        SELECT 'count' AS field, CAST(n AS VARCHAR) AS value FROM p UNION ALL SELECT 'amount', CAST(total AS VARCHAR) FROM p
        UNION ALL SELECT 'bytes', CAST(bytes AS VARCHAR) FROM p UNION ALL SELECT 'median', CAST(median AS VARCHAR) FROM m
        UNION ALL SELECT 'average', CAST(CAST(total::DOUBLE / n AS DECIMAL(38, 6)) AS VARCHAR) FROM p) t""",
)
def total_report_job(spark, sf):
    return jobs.total_report(_stored_sales(spark, sf), _store(spark, "total"), 0)


@query("distribution_job", _report_sql("CAST(sum(price) AS BIGINT)", "amount"))
def distribution_job(spark, sf):
    messages = _stored_sales(spark, sf)
    store = _store(spark, "distribution")
    return jobs.distribution_job(messages, store, 0, SALE_RULES[:2], SALE_START, SALE_END, 12, "price", DAY)


@query(
    "rank_job",
    f"""WITH {SALES}, g AS (SELECT sid, count(*) AS n, CAST(sum(price) AS BIGINT) AS total FROM sl WHERE brand = 'R' GROUP BY 1)
        SELECT * FROM (SELECT 'brand_SID_rank_count' AS result_key, sid AS field, CAST(n AS VARCHAR) AS value FROM g ORDER BY n DESC, sid LIMIT 10)
        UNION ALL SELECT * FROM (SELECT 'brand_SID_rank_amount', sid, CAST(total AS VARCHAR) FROM g ORDER BY total DESC, sid LIMIT 10)""",
)
def rank_job(spark, sf):
    return jobs.rank_job(_stored_sales(spark, sf), _store(spark, "rank"), 0, "SID", "price", SALE_RULES[:1], ttl_seconds=DAY)


@query(
    "and_count_job",
    f"WITH {SALES} SELECT 'brand_city_ram_and' AS result_key, 'count' AS field, CAST(count(*) AS VARCHAR) AS value FROM sl WHERE brand = 'R' AND city = 'O' AND ram = '3'",
)
def and_count_job(spark, sf):
    return jobs.and_count_job(_stored_sales(spark, sf), _store(spark, "and"), 0, SALE_RULES, DAY)


@query(
    "kpi_refresh_job",
    f"""WITH {SALES}, {_PANEL}, g AS (SELECT sid, count(*) AS n, CAST(sum(price) AS BIGINT) AS total FROM sl GROUP BY 1)
        SELECT 'kpi' AS result_key, 'count' AS field, CAST(n AS VARCHAR) AS value FROM p
        UNION ALL SELECT 'kpi', 'amount', CAST(total AS VARCHAR) FROM p UNION ALL SELECT 'kpi', 'bytes', CAST(bytes AS VARCHAR) FROM p
        UNION ALL SELECT 'kpi', 'median', CAST(median AS VARCHAR) FROM m
        UNION ALL SELECT 'kpi', 'average', CAST(CAST(total::DOUBLE / n AS DECIMAL(38, 6)) AS VARCHAR) FROM p
        UNION ALL SELECT 'count_by_key', sid, CAST(n AS VARCHAR) FROM g UNION ALL SELECT 'sum_by_key', sid, CAST(total AS VARCHAR) FROM g""",
)
def kpi_refresh_job(spark, sf):
    return jobs.refresh_kpis(_stored_sales(spark, sf), _store(spark, "kpi"), 0)


@query(
    "year_distribution_job",
    f"""WITH {SALES}, d AS (SELECT (saletime - 852076800000) // 2628000000 + 1 AS pos, count(*) AS a FROM sl
          WHERE saletime >= 852076800000 AND saletime < 852076800000 + 12 * 2628000000 GROUP BY 1)
        SELECT r.pos, 852076800000 + r.pos * 2628000000 AS bucket_end, coalesce(a, 0) AS amount FROM range(1, 13) r(pos) LEFT JOIN d ON d.pos = r.pos""",
)
def year_distribution_job(spark, sf):
    """The year 1997 in twelve equal parts."""
    return jobs.year_distribution(_stored_sales(spark, sf, 852076800000, 883612800000), 852076800000, 883612800000)


_BOUNDS = "ts >= TIMESTAMP '1996-01-01' AND ts <= TIMESTAMP '1999-12-31'"
_PERIOD = "1996-01-01 00:00:00_1999-12-31 00:00:00"


@query(
    "power_report_job",
    f"""WITH {METER}, f AS (SELECT * FROM mt WHERE {_BOUNDS}),
        r AS (SELECT active_kw, row_number() OVER (ORDER BY active_kw) AS pos, count(*) OVER () AS c FROM f),
        s AS (SELECT sum(active_kw) / count(*) AS am, sum(reactive_kw) / count(*) AS rm, sum(active_kw) / 60 AS total FROM f),
        ms AS (SELECT {_MONTH} AS month, sum(active_kw) / 60 AS kwh FROM f GROUP BY 1)
        SELECT 'power_{_PERIOD}' AS result_key, field, CAST(round(v, 3) AS VARCHAR) AS value FROM (
          SELECT 'active_mean_kw' AS field, am AS v FROM s UNION ALL SELECT 'reactive_mean_kw', rm FROM s
          UNION ALL SELECT 'mean_kwh', am / 60 FROM s UNION ALL SELECT 'total_kwh', total FROM s
          UNION ALL SELECT 'active_median_kw', active_kw FROM r WHERE pos = (c + 1) // 2) t
        UNION ALL SELECT 'power_{_PERIOD}', 'months', string_agg(month, ',' ORDER BY month) FROM ms
        UNION ALL SELECT 'power_{_PERIOD}', 'actives', string_agg(CAST(round(kwh, 2) AS VARCHAR), ',' ORDER BY month) FROM ms""",
)
def power_report_job(spark, sf):
    """The published figures and the two texts of the monthly series."""
    return jobs.power_report(meter_readings(spark, sf), _store(spark, "power"), 0, *_PERIOD.split("_"))


@query(
    "appliance_report_job",
    f"""WITH {METER}, f AS (SELECT * FROM mt WHERE {_BOUNDS}),
        u AS (SELECT 'kitchen' AS room, count(DISTINCT CAST(ts AS DATE)) AS days, count(*) FILTER (WHERE kitchen <> 0) // 60 AS hours, sum(kitchen) / 1000 AS kwh FROM f
          UNION ALL SELECT 'laundry', count(DISTINCT CAST(ts AS DATE)), count(*) FILTER (WHERE laundry <> 0) // 60, sum(laundry) / 1000 FROM f
          UNION ALL SELECT 'bedroom', count(DISTINCT CAST(ts AS DATE)), count(*) FILTER (WHERE bedroom <> 0) // 60, sum(bedroom) / 1000 FROM f),
        ms AS (SELECT {_MONTH} AS month, unnest(['kitchen', 'laundry', 'bedroom']) AS room, unnest([sum(kitchen), sum(laundry), sum(bedroom)]) / 1000 AS kwh FROM f GROUP BY {_MONTH})
        SELECT 'appliance_{_PERIOD}' AS result_key, room || '_hours' AS field, CAST(hours AS VARCHAR) AS value FROM u
        UNION ALL SELECT 'appliance_{_PERIOD}', room || '_hours_per_day', CAST(round(CAST(hours AS DOUBLE) / days, 2) AS VARCHAR) FROM u
        UNION ALL SELECT 'appliance_{_PERIOD}', room || '_kwh', CAST(round(kwh, 3) AS VARCHAR) FROM u
        UNION ALL SELECT 'appliance_{_PERIOD}', room || '_kwh_per_day', CAST(round(kwh / days, 2) AS VARCHAR) FROM u
        UNION ALL SELECT 'appliance_{_PERIOD}', room || '_months', string_agg(month, ',' ORDER BY month) FROM ms GROUP BY room
        UNION ALL SELECT 'appliance_{_PERIOD}', room || '_month_kwh', string_agg(CAST(round(kwh, 3) AS VARCHAR), ',' ORDER BY month) FROM ms GROUP BY room""",
)
def appliance_report_job(spark, sf):
    return jobs.appliance_report(meter_readings(spark, sf), _store(spark, "appliance"), 0, *_PERIOD.split("_"))
