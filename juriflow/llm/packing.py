"""Filling fixed-capacity containers with items.

Minimum bin slack: for each container a bitset subset-sum over the available
lengths finds the fullest feasible combination, which is then removed.  The
search sees only the histogram of lengths, whose size is bounded by the
capacity however many items there are; a combination that can be taken many
times is found once.  Items are then dealt to the containers by their rank
among the items of equal length.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.session import stored

#: Rows of one length that one window ranks, about.
SHARD_ROWS = 20_000
#: Ranks are looked up in blocks of so many.
RANK_BLOCK = 32


def fullest(sizes: list[int], left: dict[int, int], room: int) -> list[int]:
    """The fullest combination of the available lengths within ``room``.

    ``sizes`` descend.  Lengths are added with binary-split multiplicities to a
    bitset of reachable sums until ``room`` itself is reached.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for s in sizes:
        if s > room:
            continue
        n, k = min(left[s], room // s), 1
        while n > 0:
            take = min(k, n)
            steps.append((s, take, reach))
            reach |= (reach << (s * take)) & mask
            n -= take
            k *= 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    best, chosen = reach.bit_length() - 1, []
    for s, take, before in reversed(steps):
        if before >> best & 1:
            continue
        best -= s * take
        chosen += [s] * take
    return chosen


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (size, first_rank, per_bin, times, first_bin) that use up the histogram.

    The largest remaining length opens a container; the rest of its room is
    filled as fully as can be.  The combination repeats while its lengths last.
    """
    left = {s: n for s, n in histogram.items() if 0 < s <= capacity and n > 0}
    sizes = sorted(left, reverse=True)
    used, rows, bin_no = dict.fromkeys(left, 0), [], 0
    while sizes:
        top = sizes[0]
        left[top] -= 1
        combo = {top: 1}
        for s in fullest([s for s in sizes if left[s]], left, capacity - top):
            combo[s] = combo.get(s, 0) + 1
        left[top] += 1
        times = min(left[s] // n for s, n in combo.items())
        for s, n in combo.items():
            rows.append((s, used[s], n, times, bin_no))
            used[s] += n * times
            left[s] -= n * times
        bin_no += times
        sizes = [s for s in sizes if left[s]]
    return rows


def pieces(items: DataFrame, capacities: dict[int, int], item: str, size: Column) -> DataFrame:
    """spec_id, capacity, item, piece, size: an item whole unless it alone exceeds the capacity, else full pieces and a rest."""
    kinds = F.array(*[F.struct(F.lit(k).cast("int").alias("spec_id"), F.lit(c).cast("bigint").alias("capacity")) for k, c in sorted(capacities.items())])
    # the sizes are costly and read several times
    sized = stored(items.select(F.col(item), F.coalesce(size, F.lit(0)).cast("bigint").alias("_size"))).select(item, "_size", F.inline(kinds))
    cap, full = F.col("capacity"), F.expr("_size div capacity")
    n = full + F.when((F.col("_size") % cap > 0) | (F.col("_size") == 0), 1).otherwise(0)
    return sized.select("spec_id", "capacity", item, "_size", full.alias("_full"), F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("piece")).select(
        "spec_id", "capacity", item, "piece", F.when(F.col("piece") < F.col("_full"), cap).otherwise(F.col("_size") % cap).cast("bigint").alias("size")
    )


def ranked(rows: DataFrame, counts: DataFrame, group: list[str], order: list[str], shard_rows: int) -> DataFrame:
    """``rank`` from 0 within each group, by shards of hashed order columns, so that no hot group is ranked by one task.

    ``counts``: the group and n, its rows; a group has one shard for each ``shard_rows`` of them.
    """
    many = F.greatest(F.ceil(F.col("n") / shard_rows), F.lit(1)).cast("int").alias("_shards")
    sharded = rows.join(counts.select(*group, many), group).withColumn("_shard", F.pmod(F.xxhash64(*order), F.col("_shards")).cast("int")).drop("_shards")
    sizes = sharded.groupBy(*group, "_shard").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    local = F.row_number().over(Window.partitionBy(*group, "_shard").orderBy(*order)) - 1
    return sharded.withColumn("_local", local).join(starts, [*group, "_shard"]).withColumn("rank", F.col("_start") + F.col("_local")).drop("_start", "_local", "_shard")


def histogram(parts: DataFrame) -> DataFrame:
    """spec_id, capacity, size, n: at most ``capacity`` rows a spec, however many pieces there are."""
    return stored(parts.filter("size > 0").groupBy("spec_id", "capacity", "size").agg(F.count(F.lit(1)).alias("n")))


def plans(sizes: DataFrame) -> DataFrame:
    """The packing plan of each capacity, from its histogram."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = plan({int(s): int(n) for s, n in zip(pdf["size"], pdf["n"], strict=True)}, int(pdf["capacity"].iloc[0]))
        out = pd.DataFrame(rows, columns=["size", "first_rank", "per_bin", "times", "first_bin"], dtype="int64")
        out.insert(0, "spec_id", int(pdf["spec_id"].iloc[0]))
        return out

    return sizes.groupBy("spec_id").applyInPandas(one, "spec_id int, size bigint, first_rank bigint, per_bin bigint, times bigint, first_bin bigint")


def pack(items: DataFrame, capacities: dict[int, int], item: str, size: Column, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Every item's pieces with their container: spec_id, capacity, item, piece, size, bin.

    ``item`` identifies an item; repeated rows are packed as often as they
    come.  An item of size 0 or NULL takes no room and has a NULL ``bin``.
    Containers are numbered from 0 in each spec.  A NULL item is an item too.
    """
    parts = pieces(items, capacities, item, size)
    sizes = histogram(parts)
    steps = plans(sizes).select("spec_id", "size", "first_rank", "per_bin", "first_bin", (F.col("first_rank") + F.col("per_bin") * F.col("times") - 1).alias("last_rank"))
    block = lambda c: F.expr(f"{c} div {RANK_BLOCK}")
    steps = steps.withColumn("block", F.explode(F.sequence(block("first_rank"), block("last_rank"))))
    dealt = ranked(parts.filter("size > 0"), sizes, ["spec_id", "size"], [item, "piece"], shard_rows).withColumn("block", block("rank"))
    placed = dealt.join(steps, ["spec_id", "size", "block"]).filter("rank BETWEEN first_rank AND last_rank")
    cols = ["spec_id", "capacity", item, "piece", "size"]
    placed = placed.select(*cols, F.expr("first_bin + (rank - first_rank) div per_bin").alias("bin"))
    return placed.unionByName(parts.filter("size = 0").select(*cols, F.lit(None).cast("bigint").alias("bin")))


def fill(packed: DataFrame) -> DataFrame:
    """Per spec: containers, tokens, and the share of the containers' room that is unused."""
    bins = packed.filter(F.col("bin").isNotNull()).groupBy("spec_id", "capacity", "bin").agg(F.sum("size").alias("_used"))
    out = bins.groupBy("spec_id", "capacity").agg(F.count(F.lit(1)).alias("bins"), F.sum("_used").alias("tokens"), F.max("_used").alias("fullest"))
    return out.withColumn("unused", 1 - F.col("tokens") / (F.col("bins") * F.col("capacity")))
