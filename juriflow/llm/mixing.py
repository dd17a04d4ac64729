"""Mixing sources to target weights.

Weighted fair queueing: the shuffled documents of a source get the virtual
finish time (tokens of the source so far) / (target weight); all documents are
range-sorted by it and cut off at the total budget.  Running sums are taken in
buckets with carried offsets, so that no source is summed up by one task; there
are as many buckets as the number of documents asks for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from juriflow.session import small, stored

#: So many rows of targets (a mix, a source and a repeat each) or of buckets, about 60 MB, are broadcast at most.
BROADCAST_ROWS = 500_000

#: Rows that one window of a running sum holds, about.
WINDOW_ROWS = 20_000
#: Slots of the virtual time up to the budget, at least.
LEAST_SLOTS = 64


def running_sum(rows: DataFrame, group: list[str], bucket: str, order: list[str], value: str, out: str, most: str | None = None) -> DataFrame:
    """``out``: the sum of ``value`` up to and including the row, by group in the order (bucket, order).

    With ``most``, rows of buckets that begin beyond it leave before any window.
    """
    sums = rows.groupBy(*group, bucket).agg(F.sum(value).alias("_v"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    carried = small(sums.withColumn("_carried", F.coalesce(F.sum("_v").over(before), F.lit(0))).drop("_v"), BROADCAST_ROWS)
    d = rows.join(carried, [*group, bucket])
    d = d if most is None else d.filter(F.col("_carried") <= F.col(most))
    within = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumn(out, F.col("_carried") + F.sum(value).over(within)).drop("_carried")


def budgets(totals: DataFrame, targets: DataFrame, budget: int | None = None) -> DataFrame:
    """mix_id, budget, present (the shares of the sources with documents): the given total, or the largest that lets each of those sources reach its part of it within its repeats."""
    known = targets.join(totals, "source")
    most = known.groupBy("mix_id").agg(F.min(F.col("_all") * F.col("max_repeats") / F.col("target_share")).alias("_most"), F.sum("target_share").alias("present"))
    most = most.withColumn("_most", F.col("_most") * F.least("present", F.lit(1.0)))
    return most.select("mix_id", F.floor(F.col("_most") if budget is None else F.least(F.col("_most"), F.lit(budget))).alias("budget"), "present")


def mix(sized: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 0) -> DataFrame:
    """The documents of each mix in their order: mix_id, source, doc_id, use, tokens, finish.

    ``sized``: doc_id, source, tokens; ``targets``: mix_id, source,
    target_share, max_repeats.  Every repeat of a source is shuffled anew by a
    seeded hash.  Documents without a source or without tokens take no part,
    nor do sources with a share or repeats of 0; a listed source without documents reaches
    nothing while the others keep their proportions.  Repeated rows of
    ``sized`` are documents of their own.

    Slots of virtual time that begin beyond the budget leave before the total
    is summed.  Buckets and slots of both sums follow from the counts.
    """
    # the sizes are costly and read several times
    sized = stored(sized.select("doc_id", "source", "tokens").filter("source IS NOT NULL AND tokens > 0"))
    targets = targets.filter("target_share > 0 AND max_repeats > 0")
    totals = stored(sized.groupBy("source").agg(F.sum("tokens").alias("_all"), F.count(F.lit(1)).alias("_docs")))
    wanted = targets.join(budgets(totals, targets, budget), "mix_id").join(totals, "source").withColumn("_span", F.greatest("budget", F.lit(1)) / F.col("present"))
    # a source can serve at most its share of the budget and one document more, so later repeats need not be made
    uses = F.least(F.col("max_repeats"), F.ceil(F.col("_span") * F.col("target_share") / F.col("_all")) + 1).cast("int")
    parts = F.greatest(F.ceil(F.col("_docs") / WINDOW_ROWS), F.lit(1)).cast("int")
    wanted = wanted.withColumns({"_uses": uses, "_parts": parts})
    slots = wanted.groupBy("mix_id").agg(F.greatest(F.ceil(F.sum(F.col("_docs") * F.col("_uses")) / WINDOW_ROWS), F.lit(LEAST_SLOTS)).cast("int").alias("_slots"))
    wanted = wanted.join(slots, "mix_id").select("mix_id", "source", "target_share", "budget", "_span", "_parts", "_slots", F.explode(F.sequence(F.lit(1), F.col("_uses"))).alias("use"))
    place = F.xxhash64("doc_id", F.col("use"), F.col("mix_id"), F.lit(seed))
    rows = sized.join(small(wanted, BROADCAST_ROWS), "source").withColumn("_place", place).withColumn("_bucket", F.struct("use", F.pmod(F.shiftright("_place", 20), F.col("_parts")).alias("part")))
    served = running_sum(rows, ["mix_id", "source"], "_bucket", ["_place", "doc_id"], "tokens", "served").drop("_bucket", "_place", "_parts")
    # read for the slots' sums and for the rows
    timed = stored(served.withColumn("finish", F.col("served") / F.col("target_share")))
    slot = F.least(F.floor(F.col("finish") / F.col("_span") * F.col("_slots")), 4 * F.col("_slots").cast("bigint"))
    total = running_sum(timed.withColumn("_slot", slot), ["mix_id"], "_slot", ["finish", "source", "doc_id", "use"], "tokens", "_total", "budget")
    return total.filter(F.col("_total") <= F.col("budget")).select("mix_id", "source", "doc_id", "use", "tokens", "finish")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per mix and listed source: target_share, reached_share, tokens, documents (distinct) and most_uses of one document."""
    got = mixed.groupBy("mix_id", "source", "doc_id").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("uses"))
    got = got.groupBy("mix_id", "source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("uses").alias("most_uses"))
    out = targets.select("mix_id", "source", "target_share").join(got, ["mix_id", "source"], "left").fillna(0, ["tokens", "documents", "most_uses"])
    whole = F.sum("tokens").over(Window.partitionBy("mix_id"))
    return out.withColumn("reached_share", F.when(whole > 0, F.col("tokens") / whole).otherwise(0.0))
