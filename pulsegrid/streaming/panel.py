"""The dashboard kept up to date batch by batch, without reading old messages again.

A batch adds to mergeable parts: totals with a sketch of the senders, counts per value with a coarse
histogram above them, sums per key and per slice of time. The median is read from the histogram, which
names the one bucket that holds the rank, and from that bucket's counts alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from pulsegrid.functions import byte_length
from pulsegrid.operators.rank_select import quantile_rank
from pulsegrid.operators.time_buckets import bucket_bounds, bucket_position, fill_buckets
from pulsegrid.sinks.batch_table import BatchTable, additive_fold

__all__ = ["IncrementalPanel", "value_bucket"]

#: Leading bits of a value that name its bucket: a bucket spans at most 1/128 of its values.
BUCKET_BITS = 8


def value_bucket(value: Column) -> Column:
    """Bucket of a whole number, in the order of the numbers: small ones by themselves, others by exponent and leading bits."""
    size = F.abs(value)
    exponent = F.greatest(F.length(F.bin(size)) - BUCKET_BITS, F.lit(0))
    code = exponent * (1 << (BUCKET_BITS - 1)) + F.call_function("shiftright", size, exponent)
    return F.when(value < 0, -code).otherwise(code).cast("long")


class IncrementalPanel:
    """Count, amount, bytes, average, median, senders, sums per key and a time distribution of a growing table.

    ``amount`` is a whole number, ``span`` is (time column, start ms, end ms, buckets). Batches come in
    ascending order; a repeated batch replaces what it had added.
    """

    def __init__(
        self, spark: SparkSession, path: str, amount: str = "price", payload: str = "payload", sender: str = "SID",
        dims: tuple[str, ...] = ("SID",), span: tuple[str, int, int, int] | None = None, compact_every: int = 20,
    ):
        self.spark, self.amount, self.payload, self.sender, self.dims, self.span = spark, amount, payload, sender, dims, span

        def table(name: str, schema: str, keys: list[str], sums: list[str], slot_keys: list[str] | None = None) -> BatchTable:
            made = BatchTable(spark, f"{path}/{name}", schema, slot_keys or keys, additive_fold(keys, sums), compact_every)
            return made

        totals_fold = lambda rows: rows.agg(
            *[F.sum(c).alias(c) for c in ("n", "amount", "bytes")], F.hll_union_agg("senders", True).alias("senders"), F.max("batch_id").alias("batch_id")
        )
        self.totals = BatchTable(spark, f"{path}/totals", "n bigint, amount bigint, bytes bigint, senders binary", ["n"], totals_fold, compact_every, 1)
        self.buckets = table("buckets", "bucket bigint, n bigint", ["bucket"], ["n"])
        self.values = table("values", "bucket bigint, value bigint, n bigint", ["bucket", "value"], ["n"], ["bucket"])
        self.keys = table("keys", "dim string, value string, n bigint, amount bigint", ["dim", "value"], ["n", "amount"])
        self.times = table("times", "pos bigint, n bigint, amount bigint", ["pos"], ["n", "amount"])

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Add one batch (a ``foreachBatch`` function): it is read once and reduced before it is stored."""
        amount = F.col(self.amount).cast("long").alias("amount")
        pos = F.lit(None).cast("long")
        if self.span:
            time_col, start, end, nodes = self.span
            first, last, width = bucket_bounds(start, end, nodes)
            at = bucket_position(batch, time_col, first, width)
            pos = F.when(at.between(1, nodes), at)
        sender = F.col(self.sender).cast("string").alias("sender")
        dims = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in self.dims])
        held = batch.select(amount, byte_length(self.payload).alias("bytes"), sender, dims.alias("dims"), pos.alias("pos")).persist()
        try:
            zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
            self.totals.put(held.agg(F.count("*").alias("n"), zero("amount"), zero("bytes"), F.hll_sketch_agg("sender").alias("senders")), batch_id)
            counts = held.filter("amount is not null").groupBy(F.col("amount").alias("value")).agg(F.count("*").alias("n"))
            counts = counts.select(value_bucket(F.col("value")).alias("bucket"), "value", "n")
            self.values.put(counts, batch_id)
            self.buckets.put(counts.groupBy("bucket").agg(F.sum("n").alias("n")), batch_id)
            sums = [F.count("*").alias("n"), zero("amount")]
            self.keys.put(held.select(F.inline("dims"), "amount").groupBy("dim", "value").agg(*sums), batch_id)
            if self.span:
                self.times.put(held.filter("pos is not null").groupBy("pos").agg(*sums), batch_id)
        finally:
            held.unpersist()

    def start(self, stream: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Feed the panel from a stream; without ``every`` it stops when caught up."""
        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.add)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()

    def order_statistic(self, q: float = 0.5) -> int | None:
        """Value at rank ``floor((n+1)q)`` kept in 1..n: one histogram, then the counts of one bucket."""
        buckets = self.buckets.current()
        n = buckets.agg(F.sum("n")).first()[0]
        if not n:
            return None
        need = quantile_rank(n, q)
        reached = buckets.withColumn("upto", F.sum("n").over(Window.orderBy("bucket")))  # a bounded number of buckets
        found = reached.filter(F.col("upto") >= need).orderBy("bucket").select("bucket", (need - F.col("upto") + F.col("n")).alias("need")).first()
        slot = self.values.slots_of(self.spark.createDataFrame([(found.bucket,)], "bucket bigint"))
        inside = self.values.rows(slot).filter(F.col("bucket") == found.bucket).groupBy("value").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.orderBy("value"))  # distinct values of one bucket
        return inside.withColumn("upto", upto).filter(F.col("upto") >= found.need).agg(F.min("value")).first()[0]

    def figures(self, q: float = 0.5) -> DataFrame:
        """``n``, ``total``, ``bytes``, ``average``, ``median`` and ``senders`` (estimated from sketches), one row."""
        return self.totals.current().select(
            "n",
            F.col("amount").alias("total"),
            "bytes",
            F.try_divide("amount", "n").alias("average"),
            F.lit(self.order_statistic(q)).cast("long").alias("median"),
            F.hll_sketch_estimate("senders").alias("senders"),
        )

    def by_key(self, dim: str) -> DataFrame:
        """``value``, ``n`` and ``amount`` of one dimension."""
        return self.keys.current().filter(F.col("dim") == dim).select("value", "n", "amount")

    def time_distribution(self, measure: str = "n") -> DataFrame:
        """Zero-filled buckets of the span, as from a rescan."""
        _, start, end, nodes = self.span
        first, _, width = bucket_bounds(start, end, nodes)
        return fill_buckets(self.times.current().select("pos", F.col(measure).alias("amount")), first, width, nodes)
