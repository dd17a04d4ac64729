"""References to records that do not exist.

Integer parent keys are compressed into contiguous runs; a reference is matched
as of the preceding run start and is an orphan beyond the run's end.  Keys that
exist are then compared with the validity intervals of their rows at the time
of the referring record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a block of integer keys: no window partition holds more distinct keys than this per side.
BLOCK = 4096


def article_key(col: Column) -> Column:
    """Articles compared in lower case without white space; '1er' and 'premier' are '1'."""
    a = F.regexp_replace(F.lower(col), r"(?U)\s+", "")
    return F.when(a.isin("1er", "premier"), F.lit("1")).otherwise(a)


def code_key(col: Column) -> Column:
    """Codes compared trimmed and in lower case."""
    return F.lower(F.regexp_replace(col, r"(?U)^\s+|\s+$", ""))


def integer_part(key: Column) -> tuple[Column, Column]:
    """(number, rest) of a key text; a key without a plain leading number gets -1 and stays whole in the rest."""
    num = F.regexp_extract(key, r"^(0|[1-9][0-9]{0,17})(?![0-9])", 1)
    has = num != ""
    return F.when(has, num.cast("bigint")).otherwise(F.lit(-1).cast("bigint")), F.when(has, F.substring(key, F.length(num) + 1, F.length(key))).otherwise(key)


def key_runs(parents: DataFrame, part: list[str], num: str = "num", block: int = BLOCK) -> DataFrame:
    """Distinct integer keys of each part as contiguous runs ``(part..., block, run_start, run_end)``.

    A run ends at the latest at its block's end, so that no task holds more than one block of a part.
    """
    keys = parents.select(*part, F.col(num).alias("num")).distinct().withColumn("block", F.floor(F.col("num") / F.lit(block)))
    w = Window.partitionBy(*part, "block").orderBy("num")
    return (
        keys.withColumn("_island", F.col("num") - F.row_number().over(w))
        .groupBy(*part, "block", "_island")
        .agg(F.min("num").alias("run_start"), F.max("num").alias("run_end"))
        .drop("_island")
    )


def match_runs(keys: DataFrame, runs: DataFrame, part: list[str], num: str = "num", block: int = BLOCK) -> DataFrame:
    """Distinct keys with ``known``: whether the as-of run (the preceding run start) reaches them."""
    asked = keys.select(*part, F.floor(F.col(num) / F.lit(block)).alias("block"), F.col(num).alias("num")).distinct()
    both = asked.withColumn("run_end", F.lit(None).cast("bigint")).withColumn("_kind", F.lit(1)).unionByName(
        runs.select(*part, "block", F.col("run_start").alias("num"), "run_end", F.lit(0).alias("_kind"))
    )
    w = Window.partitionBy(*part, "block").orderBy("num", "_kind")
    ended = both.withColumn("_end", F.last("run_end", ignorenulls=True).over(w))
    return ended.filter("_kind = 1").select(*part, "num", F.coalesce(F.col("num") <= F.col("_end"), F.lit(False)).alias("known"))


def validity(targets: DataFrame, part: list[str], num: str = "num") -> DataFrame:
    """One row per target key: its distinct intervals (longest per start) and its first load.

    An interval is ``[starts, ends)``; a NULL end is open.  Rows without a load time are never valid.
    """
    open_end = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    spans = (
        targets.filter(F.col("starts").isNotNull())
        .groupBy(*part, F.col(num).alias("num"), "starts")
        .agg(F.max(F.coalesce(F.col("ends"), open_end)).alias("ends"))
    )
    return spans.groupBy(*part, "num").agg(F.collect_list(F.struct("starts", "ends")).alias("intervals"), F.min("starts").alias("first_start"))


def orphan_references(refs: DataFrame, targets: DataFrame, part: list[str]) -> DataFrame:
    """References that find no valid target row at their time.

    ``refs``: part columns, ``num``, ``t`` and any columns to report;
    ``targets``: part columns, ``num``, ``starts``, ``ends``.  Adds ``status``:
    'missing' (no target row at all), 'deleted' (some row loaded by then, none
    valid), 'late' (all rows loaded later) and ``ym``, the month of ``t``.

    A NULL part or number makes a reference no reference: the row is dropped.
    A reference without a time can only be 'missing' (``ym`` NULL) and is
    otherwise not reported.  Repeated rows are kept as often as they come.
    """
    refs = refs.dropna(subset=[*part, "num"])
    targets = targets.dropna(subset=[*part, "num"])
    known = match_runs(refs, key_runs(targets, part), part)
    keys = known.join(validity(targets, part), [*part, "num"], "left")
    t = F.col("t").cast("timestamp_ntz")
    joined = refs.join(keys, [*part, "num"])
    valid = F.exists(F.col("intervals"), lambda i: (i["starts"] <= t) & (i["ends"] > t))
    return (
        joined.withColumn(
            "status",
            F.when(~F.col("known"), "missing").when(t.isNull() | F.coalesce(valid, F.lit(False)), None).when(F.col("first_start") <= t, "deleted").otherwise("late"),
        )
        .filter(F.col("status").isNotNull())
        .withColumn("ym", F.date_format(t, "yyyy-MM"))
        .drop("known", "intervals", "first_start")
    )


def chunk_references(chunks: DataFrame) -> DataFrame:
    """The articles that chunks refer to: those of references with a code; of ranges the ends that are listed."""
    ref = chunks.select(F.lit("chunks").alias("src"), F.col("chunk_id").alias("rec_id"), F.col("loaded_at").alias("t"), F.explode("refs").alias("_r"))
    one = ref.select("src", "rec_id", "t", code_key(F.col("_r.code")).alias("code"), F.explode("_r.articles").alias("_a")).withColumn("article", article_key(F.col("_a")))
    num, rest = integer_part(F.col("article"))
    return one.filter((F.col("code") != "") & (F.col("article") != "")).select("src", "rec_id", "t", F.concat_ws(":", "code", "article").alias("ref_key"), "code", rest.alias("rest"), num.alias("num"))


def article_targets(code_articles: DataFrame) -> DataFrame:
    """Articles of the codes as targets."""
    a = code_articles.select(code_key(F.col("code")).alias("code"), article_key(F.col("article")).alias("_a"), F.col("loaded_at").cast("timestamp_ntz").alias("starts"), F.col("removed_at").cast("timestamp_ntz").alias("ends"))
    num, rest = integer_part(F.col("_a"))
    return a.select("code", rest.alias("rest"), num.alias("num"), "starts", "ends")


def footnote_references(units: DataFrame) -> DataFrame:
    """The notes that units name, by document and number."""
    f = units.select("doc_id", F.concat(F.col("doc_id"), F.lit("#"), F.col("unit_ix").cast("string")).alias("rec_id"), F.col("loaded_at").alias("t"), F.explode("footnotes").alias("_f"))
    num = F.expr("try_cast(regexp_extract(_f.id, '([0-9]+)', 1) AS bigint)")
    return f.select(F.lit("units").alias("src"), "rec_id", "t", "doc_id", num.alias("num")).filter(F.col("num").isNotNull()).withColumn("ref_key", F.concat(F.lit("fn"), F.col("num").cast("string")))


def footnote_targets(footnote_defs: DataFrame) -> DataFrame:
    """Footnote definitions as targets."""
    return footnote_defs.select("doc_id", F.col("num").cast("bigint").alias("num"), F.col("loaded_at").cast("timestamp_ntz").alias("starts"), F.col("withdrawn_at").cast("timestamp_ntz").alias("ends"))


def orphans(chunks: DataFrame, units: DataFrame, code_articles: DataFrame, footnote_defs: DataFrame) -> DataFrame:
    """Orphan references of chunks and units: src, rec_id, ref_key, status, ym; distinct rows."""
    cols = ["src", "rec_id", "ref_key", "status", "ym"]
    a = orphan_references(chunk_references(chunks), article_targets(code_articles), ["code", "rest"])
    b = orphan_references(footnote_references(units), footnote_targets(footnote_defs), ["doc_id"])
    return a.select(*cols).unionByName(b.select(*cols)).distinct()


def orphan_counts(found: DataFrame) -> DataFrame:
    """Orphans per table, period and status."""
    return found.groupBy("src", "ym", "status").agg(F.count(F.lit(1)).alias("n"))
