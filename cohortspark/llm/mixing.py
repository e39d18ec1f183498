"""Mixing sources to target weights by entropy balancing.

Only DataFrame operations. Within a source, the rates nearest to one copy of each document (in
relative entropy) that bring the words to the target, none above the limit of copies, are
``min(limit, exp(tilt * size / mean size))``: one number for each source, the root of a convex dual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import WORD, Scratch, hash_order, unique_name

BINS = 4096


def word_count(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, limit: int = 2) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.

    Sources by code point, null last, have the weights in turn. ``share`` of all words is divided by
    weight; a target stops at ``limit`` times its source, and the excess goes to the others by
    weight. The level of words per weight that this ends at is the greatest of those that follow
    from taking the first k sources, in order of limit per weight, as full.
    """
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(limit))
    line = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("most").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = sources.withColumn("level", (F.sum("source_size").over(everything) * share - full) / rest)
    level = F.max("level").over(everything)
    return sources.select("source", "source_size", "rows", F.least(F.col("most"), F.col("weight") * level).alias("target"))


def _rate(limit: int) -> F.Column:
    tilted = F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0)))
    return F.when(F.col("full"), F.lit(float(limit))).otherwise(F.least(F.lit(float(limit)), tilted))


def balance(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, limit: int = 2, tolerance: float = 1e-7, steps: int = 40) -> DataFrame:
    """One row for each source: its size, target, tilt, and the threshold that rounds rates.

    ``docs`` has doc_id, source and size. Documents of one source and size share a rate, so Newton's
    steps run over counts by source and size. A step that leaves the bracket of the root is halved
    instead. Rates become copies as ``floor(rate + even hash + shift)``; the shift at which the words
    taken come nearest to the target is searched in three rounds of ever finer bins.
    """
    work = Scratch(docs.sparkSession, "mix")
    docs = work.keep(docs.select("doc_id", "source", "size"))
    sizes = work.keep(docs.groupBy("source", "size").agg(F.count("*").alias("rows")))
    sources = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("rows")
    )
    mean = F.greatest(F.col("source_size") / F.col("rows"), F.lit(1e-9))
    state = work.keep(
        source_targets(sources, weights, share, limit).select(
            "source", "source_size", "target",
            mean.alias("mean"),
            (F.col("target") >= F.col("source_size") * limit * (1 - 1e-12)).alias("full"),
            F.lit(0.0).alias("tilt"),
            (-50 * (mean + 1)).alias("low"),
            (F.log(F.lit(float(limit))) * (mean + 1) + 1).alias("high"),
            (F.col("source_size") <= 0).alias("done"),
        )
    )
    for _ in range(steps):
        rate = _rate(limit)
        words = (F.col("size") * F.col("rows")).cast("double")
        sums = (
            sizes.join(state.where("not done and not full"), sizes["source"].eqNullSafe(state["source"]))
            .select(state["source"], words.alias("words"), rate.alias("rate"), (F.col("size") / F.col("mean")).alias("z"))
            .groupBy("source")
            .agg(
                F.sum(F.col("words") * F.col("rate")).alias("taken"),
                F.sum(F.when(F.col("rate") < limit, F.col("words") * F.col("rate") * F.col("z")).otherwise(0.0)).alias("slope"),
            )
        )
        gap = F.col("taken") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        close = F.abs(gap) <= F.col("target") * tolerance
        moved = F.when(close, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2)
        new = sums.withColumnRenamed("source", "of").join(state, F.col("of").eqNullSafe(F.col("source")), "right")
        known = F.col("taken").isNotNull()
        # rounded: sums of doubles depend on the order of tasks in their last digits
        new = work.keep(
            new.select(
                "source", "source_size", "target", "mean", "full",
                F.when(known, F.round(moved, 9)).otherwise(F.col("tilt")).alias("tilt"),
                F.when(known, low).otherwise(F.col("low")).alias("low"),
                F.when(known, high).otherwise(F.col("high")).alias("high"),
                (F.col("done") | F.coalesce(close, F.lit(False))).alias("done"),
            )
        )
        work.drop(state)
        state = new
        if not state.where("not done and not full").limit(1).count():
            break
    # copies number k + 1 comes when the shift reaches k + 1 - rate - hash
    chance = hash_order("doc_id", "size", F.lit("copies"))
    joined = docs.join(state.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).where("size > 0 and not full")
    comes = joined.select("source", "size", "target", F.explode(F.array(*(F.lit(k + 1.0) - _rate(limit) - chance for k in range(limit)))).alias("at"))
    edges = state.select(F.col("source").alias("of"), F.lit(-float(limit)).alias("low"), F.lit(0).cast("long").alias("below"), F.lit(2.0 * limit).alias("width"))
    for _ in range(3):
        kept = comes.join(edges, F.col("source").eqNullSafe(F.col("of")))
        bin_ = F.floor((F.col("at") - F.col("low")) / F.col("width") * BINS)
        bins = (
            kept.where((F.col("at") >= F.col("low")) & (F.col("at") < F.col("low") + F.col("width")))
            .groupBy("of", "low", "below", "width", "target", bin_.alias("bin"))
            .agg(F.sum("size").alias("size"))
        )
        upto = Window.partitionBy("of").orderBy("bin")
        bins = bins.withColumn("upto", F.col("below") + F.sum("size").over(upto))
        # the first bin that reaches the target, or the last bin of all
        best = bins.groupBy("of").agg(
            F.min(F.when(F.col("upto") >= F.col("target"), F.struct("bin", F.col("upto") - F.col("size"), "low", "width", "upto"))).alias("hit"),
            F.max(F.struct("bin", F.col("upto") - F.col("size"), "low", "width", "upto")).alias("end"),
        )
        hit = best.select("of", F.coalesce("hit", "end").alias("h")).select("of", "h.*").toDF("of", "bin", "below", "low", "width", "upto")
        edges = work.keep(
            hit.select(
                "of",
                (F.col("low") + F.col("bin") * F.col("width") / BINS).alias("low"),
                "below",
                (F.col("width") / BINS).alias("width"),
                "upto",
            )
        )
    final = state.join(edges.select("of", F.col("low").alias("edge"), "below", "width", "upto"), F.col("source").eqNullSafe(F.col("of")), "left")
    nearer = F.col("upto") - F.col("target") <= F.col("target") - F.col("below")
    shift = F.when(nearer, F.col("edge") + F.col("width")).otherwise(F.col("edge"))
    plan = work.keep(
        final.select("source", "source_size", "target", "mean", "full", "tilt", F.coalesce(shift, F.lit(0.0)).alias("shift"), nearer.alias("closed"))
    )
    work.drop(docs, sizes, state)
    return plan


def mixed(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", limit: int = 2, **options) -> DataFrame:
    """``docs`` with its place in the mix: size, source_size, target, rate, copies, in struct ``mix``.

    Size: words of the text (null: 0). Documents without words are taken once. Rows alike in doc_id
    and size get the same copies. A null source is a source of its own. An empty table gives an
    empty result. All columns of ``docs`` stay; the struct's name is lengthened where it is taken.
    """
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"))
    plan = balance(sized, limit=limit, **options)
    name = unique_name(docs, "mix")
    facts = F.struct(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"))
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), facts.alias("facts"))
    row = row.select("row", "facts.*").join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    # the same arithmetic as in the search for the shift, so that both put a copy on the same side
    at = [F.lit(k + 1.0) - _rate(limit) - hash_order("doc_id", "size", F.lit("copies")) for k in range(limit)]
    come = sum((F.when(a < F.col("shift"), 1).otherwise(0) for a in at), F.lit(0))
    copies = F.when(F.col("size") == 0, 1).when(F.col("full"), limit).otherwise(come)
    mix = F.struct("size", "source_size", "target", _rate(limit).alias("rate"), copies.cast("int").alias("copies"))
    return row.select("row.*", mix.alias(name))


def repeated(mix: DataFrame, column: str = "mix") -> DataFrame:
    """The rows of the mix: each document as often as it is taken, without the column ``column``."""
    copies = F.explode(F.sequence(F.lit(1), F.col(f"{column}.copies")))
    name = unique_name(mix, "copy")
    return mix.where(F.col(f"{column}.copies") > 0).withColumn(name, copies).drop(name, column)
