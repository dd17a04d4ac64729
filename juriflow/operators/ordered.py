"""Order-dependent columns over a document's lines.

``running`` and ``paged_sum`` hold a bucket or a page of a document in a window
and carry what came before it in a second window over one row for each bucket,
so no document is one task.  The others run over a whole document: their frames
reach from its start to the row or to a direct neighbour, so a task streams it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.session import stored

#: Places of a document that one window holds.
BUCKET = 16_384


def running_last(df: DataFrame, keys: list[str], order: str, cols: dict[str, Column]) -> DataFrame:
    """Each column's last value that is not NULL, up to and including the row."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({o: F.last(c, ignorenulls=True).over(w) for o, c in cols.items()})


def running_sum(df: DataFrame, keys: list[str], order: str, cols: dict[str, Column]) -> DataFrame:
    """Each column's sum up to and including the row."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({o: F.coalesce(F.sum(c).over(w), F.lit(0)) for o, c in cols.items()})


def neighbours(df: DataFrame, keys: list[str], order: str, before: dict[str, Column] | None = None, after: dict[str, Column] | None = None) -> DataFrame:
    """Values of the row before (``before``) and of the next row (``after``), NULL at a document's ends."""
    w = Window.partitionBy(*keys).orderBy(order)
    near = {o: F.lag(c).over(w) for o, c in (before or {}).items()} | {o: F.lead(c).over(w) for o, c in (after or {}).items()}
    return df.withColumns(near)


def paged_sum(df: DataFrame, order: str | list[str], cols: dict[str, Column]) -> DataFrame:
    """Each column's sum over the document up to and including the row, for rows with doc_id and page.

    A window holds one page; a second one, over a row for each page, carries the sums of the pages before.
    """
    page = ["doc_id", "page"]
    d = df.withColumns({f"_v_{o}": c for o, c in cols.items()})
    w = Window.partitionBy(*page).orderBy(*([order] if isinstance(order, str) else order)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy(*page).agg(*[F.sum(f"_v_{o}").alias(f"_t_{o}") for o in cols])
    carried = totals.select(*page, *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_c_{o}") for o in cols])
    d = d.withColumns({o: F.coalesce(F.sum(f"_v_{o}").over(w), F.lit(0)) for o in cols}).join(carried, page)
    return d.withColumns({o: F.col(o) + F.col(f"_c_{o}") for o in cols}).drop(*[f"{x}{o}" for o in cols for x in ("_v_", "_c_")])


def running(df: DataFrame, order: str, lasts: dict[str, Column], sums: dict[str, Column], bucket: int | None = None) -> DataFrame:
    """Each column's last value that is not NULL (``lasts``) and sum (``sums``) over the document up to and including the row, for rows with doc_id.

    The rows are written once, read for the buckets' totals and for themselves.
    """
    key = ["doc_id", "_bk"]
    d = df.withColumns({f"_v_{o}": c for o, c in (lasts | sums).items()}).withColumn("_bk", F.floor(F.col(order) / (bucket or BUCKET)))
    d = stored(d)
    ends = [F.max_by(f"_v_{o}", F.when(F.col(f"_v_{o}").isNotNull(), F.col(order))).alias(f"_e_{o}") for o in lasts] + [F.sum(f"_v_{o}").alias(f"_e_{o}") for o in sums]
    before = Window.partitionBy("doc_id").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carried = d.groupBy(*key).agg(*ends).select(
        *key, *[F.last(f"_e_{o}", ignorenulls=True).over(before).alias(f"_c_{o}") for o in lasts], *[F.coalesce(F.sum(f"_e_{o}").over(before), F.lit(0)).alias(f"_c_{o}") for o in sums]
    )
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({o: F.last(f"_v_{o}", ignorenulls=True).over(w) for o in lasts} | {o: F.coalesce(F.sum(f"_v_{o}").over(w), F.lit(0)) for o in sums}).join(carried, key)
    both = {o: F.coalesce(F.col(o), F.col(f"_c_{o}")) for o in lasts} | {o: F.col(o) + F.col(f"_c_{o}") for o in sums}
    return d.withColumns(both).drop("_bk", *[f"{x}{o}" for o in (*lasts, *sums) for x in ("_v_", "_c_")])
