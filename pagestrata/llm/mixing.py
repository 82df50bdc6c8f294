"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Documents are counted by source and size (number of words). Among all document rates between 0 and `most`, those of least relative
entropy to one copy each that meet a source's word target are exponentially tilted by size: rate = min(most, exp(lambda x
size / mean size)). The dual in lambda is convex and one-dimensional for each source; Newton steps, kept inside a
shrinking bracket, solve all sources at once as joins and aggregations over the counts, until every source meets its target to within a quarter of
a word, or its bracket is as narrow as doubles are. Rates become whole copies by cumulative rounding
from the longest documents on, and copies of one size are then moved, again and again, as long as that brings a source closer to its target.
source_taken says what each source got.

Tables of sources (targets, rates) have a row a source, and the ranking of sources needs them in one task: a list of sources, not of documents. The table of
counts by source and size is joined by its size as Spark finds it: broadcast below spark.sql.autoBroadcastJoinThreshold, shuffled above.

Defined results: null text has size 0; size 0 takes nothing; a null source is a source of its own, last in order; rows of one doc_id count
each; an empty table gives no rows; input columns named size, source_size, target, copies, taken or source_taken are replaced, all
others are kept. Ties of size are broken by a hash of doc_id and text, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, without

WORD = "[^\\x20\\x09-\\x0D]+"
GROUP_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target. sizes: source, source_size, a row a source.

    Targets share out share x all sizes by weight; one that would pass most x its source's size stops there and the rest is shared again.
    """
    order = F.struct(F.col("source").isNull(), F.encode("source", "utf-8"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(Window.orderBy(order)) - 1, F.lit(len(weights))) + 1).cast("int"))
    w = sizes.withColumn("_w", weight).withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    full = Window.orderBy(F.col("_cap") / F.col("_w"), order)
    past = full.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(past), F.lit(0.0))
    rate = left / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(past), F.lit(0.0)))
    # sources fill up in order of capacity by weight; from the first that does not on, all share at its rate
    leveled = w.withColumn("_rate", rate).withColumn("_level", F.min(F.when(F.col("_rate") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), F.col("_rate")))).over(every))
    return leveled.select("source", "source_size", F.least(F.col("_cap"), F.coalesce(F.col("_w") * F.col("_level")["_rate"], F.col("_cap"))).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: int = 2) -> DataFrame:
    """docs (doc_id, text, source, any more columns) with size, source_size, target, copies, taken = copies x size, and source_taken."""
    given = without(docs, "size", "source_size", "target", "copies", "taken", "source_taken")
    # the columns given travel as one, so that no name of theirs meets one of the steps below
    base = given.select(F.struct(*[F.col(f"`{c}`") for c in given.columns]).alias("row"), "source", F.xxhash64("doc_id", "text").alias("key"), word_count(F.col("text").cast("string")).alias("size"))
    cells = materialize(base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sums = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    goals = materialize(source_targets(sums.select("source", "source_size"), weights, share, most).join(sums.select(F.col("source").alias("_s"), "docs"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    x = F.col("size") * F.col("docs") / F.col("source_size")
    tilt = F.least(F.lit(float(most)), F.exp(F.greatest(F.least(F.col("lam") * x, F.lit(50.0)), F.lit(-700.0))))
    full = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
    state = goals.where("source_size > 0").select(F.col("source").alias("_s"), "source_size", "docs", "target", F.when(full, 1e6).otherwise(0.0).alias("lam"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), full.alias("met"))
    state = materialize(state)
    sized = cells.where("size > 0")
    while not state.where("NOT met").isEmpty():
        rated = sized.join(state.where("NOT met"), F.col("source").eqNullSafe(F.col("_s"))).withColumn("rate", tilt)
        moments = rated.groupBy(F.col("_s").alias("_k")).agg(F.sum(F.col("n") * F.col("size") * F.col("rate")).alias("got"), F.sum(F.when(F.col("rate") < most, F.col("n") * F.col("size") * x * F.col("rate")).otherwise(0.0)).alias("slope"))
        now = state.join(moments, F.col("_s").eqNullSafe(F.col("_k")), "left").drop("_k").withColumn("gap", F.col("target") - F.col("got"))
        low, high = F.when(F.col("gap") > 0, F.col("lam")).otherwise(F.col("low")), F.when(F.col("gap") < 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") + F.when(F.col("slope") > 0, F.col("gap") / F.col("slope")).otherwise(F.lit(None))
        inside = (newton > F.col("low2")) & (newton < F.col("high2"))
        wide = F.when((F.col("low2") <= -1e6) | (F.col("high2") >= 1e6), F.col("lam") + F.signum("gap") * (F.abs("lam") + 1.0)).otherwise((F.col("low2") + F.col("high2")) / 2)
        done = F.col("met") | (F.abs("gap") <= F.greatest(F.lit(0.25), F.col("target") * 1e-9)) | (F.col("high2") - F.col("low2") < 1e-12) | (F.abs("lam") > 1e5)
        after = now.withColumn("low2", low).withColumn("high2", high).withColumn("done", F.coalesce(done, F.lit(True)))
        after = after.select("_s", "source_size", "docs", "target", F.when(F.col("done"), F.col("lam")).when(inside, newton).otherwise(wide).alias("lam"), F.col("low2").alias("low"), F.col("high2").alias("high"), F.col("done").alias("met"))
        following = materialize(after)
        discard(state)
        state = following
    rated = sized.join(state, F.col("source").eqNullSafe(F.col("_s"))).withColumn("rate", tilt)
    running = F.sum(F.col("n") * F.col("rate")).over(Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = rated.withColumn("_c", running).withColumn("k", F.greatest(F.lit(0), F.least(F.col("n") * most, F.round("_c") - F.round(F.col("_c") - F.col("n") * F.col("rate")))).cast("long"))
    held = materialize(counted.select("source", "size", "n", "k", "target"))
    while True:
        off = held.groupBy(F.col("source").alias("_s")).agg((F.first("target") - F.sum(F.col("k") * F.col("size"))).alias("gap"))
        room = held.join(off, F.col("source").eqNullSafe(F.col("_s")))
        step = F.when(F.col("gap") > 0, F.when(F.col("k") < F.col("n") * most, 1)).otherwise(F.when(F.col("k") > 0, -1))
        times = F.greatest(F.lit(1), F.least(F.floor(F.abs("gap") / F.col("size")), F.when(F.col("gap") > 0, F.col("n") * most - F.col("k")).otherwise(F.col("k")))).cast("long")
        room = room.withColumn("step", step * times).withColumn("left", F.abs(F.col("gap") - F.col("step") * F.col("size"))).where("step IS NOT NULL AND left < abs(gap)")
        best = materialize(room.groupBy(F.col("source").alias("_s")).agg(F.min_by(F.struct("size", "step"), F.struct("left", "size")).alias("b")).select("_s", F.col("b.size").alias("_z"), F.col("b.step").alias("step")))
        if best.isEmpty():  # gaps shrink with every round, so this comes
            discard(best)
            break
        moved = held.join(best, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")), "left").select("source", "size", "n", (F.col("k") + F.coalesce("step", F.lit(0))).alias("k"), "target")
        following = materialize(moved)
        discard(held)
        discard(best)
        held = following
    # whole copies for all of a cell, one more for as many of its documents as are left over; large cells are dealt with in groups
    cut = held.select("source", "size", "n", F.floor(F.col("k") / F.col("n")).alias("each"), F.pmod("k", "n").alias("extra"))
    groups = max(1, -(-(cells.agg(F.max("n")).first()[0] or 1) // GROUP_ROWS))
    keyed = base.withColumn("_group", F.pmod("key", F.lit(groups)))
    parts = keyed.groupBy("source", "size", "_group").agg(F.count(F.lit(1)).alias("m")) if groups > 1 else cells.select("source", "size", F.lit(0).cast("long").alias("_group"), F.col("n").alias("m"))
    upto = F.sum("m").over(Window.partitionBy("source", "size").orderBy("_group").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    share_of = lambda c: F.floor(F.col("extra") * c / F.col("n"))
    same = lambda a, b: [a["source"].eqNullSafe(b["source"]), a["size"] == b["size"]]
    parts = parts.withColumn("_upto", upto)
    quota = parts.join(cut, same(parts, cut)).select(parts["source"].alias("_s"), parts["size"].alias("_z"), F.col("_group").alias("_g"), "each", (share_of(F.col("_upto")) - share_of(F.col("_upto") - F.col("m"))).alias("_quota"))
    dealt = keyed.join(quota, keyed["source"].eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("_group") == F.col("_g")), "left")
    rank = F.row_number().over(Window.partitionBy("source", "size", "_group").orderBy("key"))
    copied = dealt.withColumn("copies", (F.coalesce("each", F.lit(0)) + F.when(rank <= F.col("_quota"), 1).otherwise(0)).cast("long"))
    got = held.groupBy(F.col("source").alias("_u")).agg(F.sum(F.col("k") * F.col("size")).alias("source_taken"))
    goal = goals.join(got, F.col("source").eqNullSafe(F.col("_u")), "left").select(F.col("source").alias("_t"), "source_size", "target", F.coalesce("source_taken", F.lit(0)).alias("source_taken"))
    return copied.join(goal, F.col("source").eqNullSafe(F.col("_t"))).select("row.*", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "source_taken")
