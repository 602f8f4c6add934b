"""Mix sources to target weights by Pareto order sampling.

A source's target is its share of all words; a document of it is expected ``c`` times, where ``c``
falls slowly with the length class of the document (long texts would otherwise decide how far a
source misses its target) and is scaled so that the expected words equal the target. ``floor(c)``
copies are certain. The rest ``p = c - floor(c)`` is an inclusion probability: documents are ranked by
random odds over inclusion odds, ``u/(1-u) / (p/(1-p))``, and taken in that order until the words that
the source still lacks are filled; one further document may close the gap that a long text left at
the cut. The cut is found from two rounds of histograms of the rank, so a
source with a third of all rows is summed, never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.frames import packed, stored
from pulsegrid.operators.partitions import row_index

WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096
LEVELS = 2
#: A text of 16 times the words is expected 2 ** -0.25 times as often.
LENGTH_DISCOUNT = 1 / 16


def _measure(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, *extra: Column) -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words, length class ``k`` and the random number ``u`` in (0, 1)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    doc_id = F.col(f"`{id_col}`").cast("long")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        u.alias("u"),
        *extra,
    )
    return rows.withColumn("k", F.floor(F.log2(F.greatest("size", F.lit(1)).cast("double"))).cast("int"))


def source_targets(measured: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """``source``, ``source_size``, ``target``: the words of all sources shared out by weight.

    Sources in code point order, null last, take the weights in turn. A share above ``max_copies``
    times the source's own size is cut to that, and what is left over is shared again among the rest.
    """
    sums = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = row_index(sums.withColumn("last", F.col("source").isNull()), ["last", "source"], "pos")
    cycle = F.array(*[F.lit(w) for w in weights])
    sums = stored(sums.withColumn("weight", F.get(cycle, F.pmod("pos", F.lit(len(weights))).cast("int"))).drop("last", "pos"), "sources")
    most = max_copies * F.col("source_size")
    rate = 0.0
    while True:
        over = most < rate * F.col("weight")
        left, weight, total = sums.agg(
            F.sum("source_size") - F.coalesce(F.sum(F.when(over, most)), F.lit(0)),
            F.sum(F.when(~over, F.col("weight"))),
            F.sum("source_size"),
        ).first()
        if not weight or not total or left / weight <= rate:
            break
        rate = left / weight
    return sums.select("source", "source_size", F.least(most.cast("double"), F.lit(rate) * F.col("weight")).alias("target"))


def _scales(measured: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """Adds ``scale`` to the targets: expected copies are ``least(max_copies, scale * discount(k))``.

    Classes with the highest discount reach ``max_copies`` first; for each number of capped classes
    the scale follows directly. A source has at most 64 classes.
    """
    classes = measured.where("size > 0").groupBy("source", "k").agg(F.sum("size").alias("s"))
    classes = classes.join(targets, classes["source"].eqNullSafe(targets["source"])).select(targets["*"], "k", "s")
    before = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("source").orderBy("k").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    capped = F.coalesce(F.sum("s").over(before), F.lit(0))
    scale = (F.col("target") - max_copies * capped) / F.sum(F.col("s") * _discount()).over(after)
    tried = classes.withColumn("try", scale).where(F.col("try") * _discount() <= max_copies)
    scales = tried.groupBy("source").agg(F.min_by("try", "k").alias("scale"))
    joined = targets.join(scales, targets["source"].eqNullSafe(scales["source"]), "left").select(targets["*"], "scale")
    return joined.withColumn("scale", F.coalesce("scale", F.lit(float(max_copies) * 64)))


def _discount() -> Column:
    return F.pow(F.lit(2.0), -F.col("k") * LENGTH_DISCOUNT)


def _ranked(rows: DataFrame, state: DataFrame, max_copies: int) -> DataFrame:
    """Rows with the columns of their source, ``certain`` copies, probability ``p`` and rank ``x`` in (0, 1)."""
    joined = rows.join(state, rows["source"].eqNullSafe(state["source"])).drop(state["source"])
    expected = F.least(F.lit(float(max_copies)), F.col("scale") * _discount())
    joined = joined.withColumn("certain", F.floor(expected + 1e-9)).withColumn("p", F.greatest(expected - F.col("certain"), F.lit(0.0)))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    return joined.withColumn("x", F.when(F.col("p") > 1e-9, odds / (1 + odds)))


def plan_mix(measured: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """One row per source: sizes, target, scale and ``cut``, the rank up to which an extra copy is taken."""
    state = stored(_scales(measured, source_targets(measured, weights, max_copies), max_copies), "scales")
    ranked = _ranked(measured, state, max_copies)
    certain = ranked.groupBy("source").agg(F.sum(F.col("certain") * F.col("size")).alias("sure"))
    state = state.join(certain, state["source"].eqNullSafe(certain["source"]), "left").select(
        state["*"], (F.col("target") - F.coalesce("sure", F.lit(0))).alias("budget"), F.lit(0.0).alias("lo"), F.lit(1.0).alias("width")
    )
    state = stored(state, "budgets")
    for _ in range(LEVELS):
        state = stored(_narrow(measured, state, max_copies), "cut")
    last = _open_rows(measured, state, max_copies).groupBy("source", "x", "budget").agg(F.sum("size").alias("s"))
    run = F.sum("s").over(Window.partitionBy("source").orderBy("x"))
    taken = last.withColumn("run", run).where(F.col("run") - F.col("s") / 2 <= F.col("budget"))
    cuts = taken.groupBy("source").agg(F.max("x").alias("at"), F.max("run").alias("used"))
    joined = state.join(cuts, state["source"].eqNullSafe(cuts["source"]), "left").select(state["*"], "at", "used")
    state = stored(
        joined.select(
            "source", "source_size", "target", "scale", "lo", F.coalesce("at", F.lit(-1.0)).alias("cut"),
            (F.col("budget") - F.coalesce("used", F.lit(0))).alias("gap"),
        ), "cut",
    )
    return stored(_fill(measured, state, max_copies), "mix")


def _taken(rows: DataFrame) -> Column:
    """Whether the rank of a row is within the cut of its source."""
    return F.col("x").isNotNull() & ((F.col("x") < F.col("lo")) | (F.col("x") <= F.col("cut")))


def _fill(measured: DataFrame, state: DataFrame, max_copies: int) -> DataFrame:
    """Adds ``fill``, the rank of the one document behind the cut whose words close the gap best, if any does."""
    rest = _ranked(measured, state, max_copies)
    rest = rest.where(F.col("x").isNotNull() & (F.col("size") > 0) & ~_taken(rest))
    rest = rest.groupBy("source", "x", "gap").agg(F.sum("size").alias("s"))
    miss = F.abs(F.col("gap") - F.col("s"))
    best = rest.where(miss < F.col("gap")).groupBy("source").agg(F.min_by("x", F.struct(miss, "x")).alias("fill"))
    return state.join(best, state["source"].eqNullSafe(best["source"]), "left").select(state["*"], "fill")


def _open_rows(measured: DataFrame, state: DataFrame, max_copies: int) -> DataFrame:
    rows = _ranked(measured, state, max_copies).where("x is not null and size > 0")
    return rows.where((F.col("x") >= F.col("lo")) & (F.col("x") < F.col("lo") + F.col("width")))


def _narrow(measured: DataFrame, state: DataFrame, max_copies: int) -> DataFrame:
    """Replace the range of ranks that holds a source's cut by the bin of it that does."""
    rows = _open_rows(measured, state, max_copies)
    place = F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width") * BINS), F.lit(BINS - 1))
    bins = rows.groupBy("source", place.alias("bin"), "budget").agg(F.sum("size").alias("s"))
    run = F.sum("s").over(Window.partitionBy("source").orderBy("bin"))  # at most BINS rows per source
    over = bins.withColumn("run", run).where(F.col("run") > F.col("budget"))
    edge = over.groupBy("source").agg(F.min(F.struct("bin", (F.col("run") - F.col("s")).alias("used"))).alias("edge"))
    joined = state.join(edge, state["source"].eqNullSafe(edge["source"]), "left").select(state["*"], "edge")
    step = F.col("width") / BINS
    found = F.col("edge").isNotNull()
    return joined.select(
        "source", "source_size", "target", "scale",
        F.when(found, F.col("budget") - F.col("edge.used")).otherwise(F.col("budget")).alias("budget"),
        F.when(found, F.col("lo") + F.col("edge.bin") * step).otherwise(F.col("lo") + F.col("width")).alias("lo"),
        F.when(found, step).otherwise(F.lit(0.0)).alias("width"),
    )


def _copies(rows: DataFrame, plan: DataFrame, max_copies: int) -> DataFrame:
    ranked = _ranked(rows, plan, max_copies)
    extra = _taken(ranked) | F.col("x").eqNullSafe(F.coalesce("fill", F.lit(-1.0)))
    return ranked.withColumn("copies", F.col("certain") + extra.cast("long"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1), max_copies: int = 3, seed: int = 20_022,
) -> DataFrame:
    """Per row: ``doc_id``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` words.

    A null text has size 0 and is never more than 0 words; null is a source of its own and comes last.
    Random numbers are a hash of id and text, so runs agree and repeated rows are taken or left
    together. Ties of rank are taken together. An empty table gives no rows; other columns are not read.
    """
    measured = stored(_measure(docs, id_col, text_col, source_col, seed), "sizes")
    rows = _copies(measured, plan_mix(measured, weights, max_copies), max_copies)
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def take_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1), max_copies: int = 3, seed: int = 20_022,
) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it; a text without words as often as its certain copies."""
    measured = stored(_measure(docs, id_col, text_col, source_col, seed), "sizes")
    plan = plan_mix(measured, weights, max_copies)
    keys = ["doc_id", "source", "size", "u"]
    rows = _measure(packed(docs, *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate((id_col, text_col, source_col))]), "_0", "_1", "_2", seed, F.col("row"))
    copies = _copies(rows, plan, max_copies).where("copies > 0").drop(*keys)
    return copies.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
