"""What changed between full snapshots.

Each key is windowed by the index of the snapshot: a lagged hash reveals a
change, a gap in the index a removal and a later addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.functions.consistent import let, same_but_spacing
from juriflow.operators.references import article_key


def delivered(snapshots: DataFrame, snap: str) -> DataFrame:
    """The delivered snapshot numbers with their index, one row per delivery."""
    return snapshots.select(snap).dropna().distinct().withColumn("snap_ix", F.row_number().over(Window.orderBy(snap)))


def snapshot_changes(snapshots: DataFrame, snap: str, key: list[str], value: Column, loaded: str) -> DataFrame:
    """Records added, removed or changed from each delivered snapshot to the next.

    ``value`` is what decides on a change; it is hashed (128 bits) before any
    shuffle.  NULL differs from every value and equals NULL.  Rows with a NULL
    in a key column or without a snapshot number are no records, but their
    snapshot counts as delivered.  Of several rows of a record in one snapshot
    the one loaded last counts; at equal times the greater hash, so the result
    never depends on order.  An empty table gives no rows.

    Returns snap_from, snap_to, the key columns and ``what``.
    """
    names = [f"_k{i}" for i in range(len(key))]
    rows = snapshots.select(F.col(snap).alias("_snap"), *[F.col(k).alias(n) for k, n in zip(key, names, strict=True)], F.col(loaded).alias("_loaded"), value.alias("_value")).dropna(subset=["_snap", *names])
    hashed = rows.select("_snap", *names, "_loaded", let(F.col("_value"), lambda v: F.when(v.isNotNull(), F.struct(F.xxhash64(v).alias("a"), F.xxhash64(v, F.lit(1)).alias("b")))).alias("_h"))
    last = hashed.groupBy("_snap", *names).agg(F.max_by("_h", F.struct("_loaded", "_h")).alias("_h"))
    steps = delivered(snapshots.select(F.col(snap).alias("_snap")), "_snap")
    # one row per delivery, so this side is as small as the number of deliveries
    known = steps.withColumn("_next", F.lead("_snap").over(Window.orderBy("snap_ix"))).withColumn("_prev", F.lag("_snap").over(Window.orderBy("snap_ix")))
    indexed = last.join(known, "_snap")
    w = Window.partitionBy(*names).orderBy("snap_ix")
    seen = indexed.select(
        *names, "_snap", "_next", "_prev", "_h", "snap_ix",
        F.lag("snap_ix").over(w).alias("_before"), F.lag("_h").over(w).alias("_old"), F.lead("snap_ix").over(w).alias("_after"),
    )
    here = F.col("snap_ix")
    gap_before = F.col("_prev").isNotNull() & ~F.coalesce(F.col("_before") == here - 1, F.lit(False))
    gap_after = F.col("_next").isNotNull() & ~F.coalesce(F.col("_after") == here + 1, F.lit(False))
    altered = (F.col("_before") == here - 1) & ~F.col("_old").eqNullSafe(F.col("_h"))

    def event(when: Column, a: str, b: str, what: str) -> Column:
        return F.when(when, F.struct(F.col(a).alias("snap_from"), F.col(b).alias("snap_to"), F.lit(what).alias("what")))

    events = F.array_compact(F.array(event(gap_before, "_prev", "_snap", "added"), event(altered, "_prev", "_snap", "changed"), event(gap_after, "_snap", "_next", "removed")))
    return seen.select(*names, F.explode(events).alias("_e")).select("_e.snap_from", "_e.snap_to", *[F.col(n).alias(k) for k, n in zip(key, names, strict=True)], "_e.what")


def unit_changes(unit_snapshots: DataFrame) -> DataFrame:
    """Units added, removed or changed; keys are compared and shown like articles, texts but for spacing and look-alikes."""
    rows = unit_snapshots.select("snap_no", "doc_id", F.nullif(article_key(F.col("unit_key")), F.lit("")).alias("unit_key"), "text", "loaded_at")
    return snapshot_changes(rows, "snap_no", ["doc_id", "unit_key"], same_but_spacing(F.col("text")), "loaded_at").select("snap_from", "snap_to", "doc_id", "unit_key", "what")
