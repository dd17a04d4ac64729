"""Quality control of clean Markdown lines ``(doc_id, seq, text)``: every metric is an aggregate of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.functions import patterns as P
from juriflow.operators.ordered import neighbours, running_last


def article_marks(md: DataFrame) -> DataFrame:
    """Article marks in order: doc_id, seq, id, key (legal order)."""
    a = md.select("doc_id", "seq", F.posexplode(F.regexp_extract_all("text", F.lit(P.ART_MARK), F.lit(1))).alias("pos", "id"))
    return a.withColumn("at", F.col("seq") * 1000 + F.col("pos")).withColumn("key", P.article_sort_key(F.col("id"))).drop("pos")


def duplicate_articles(marks: DataFrame) -> DataFrame:
    """doc_id, id, n of articles that a document opens more than once."""
    return marks.groupBy("doc_id", "id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def article_numbers(marks: DataFrame) -> DataFrame:
    """doc_id, n_articles, first_number, last_number."""
    n = F.expr("try_cast(regexp_extract(id, '^([0-9]+)', 1) AS int)")
    return marks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_articles"), F.min(n).alias("first_number"), F.max(n).alias("last_number"))


def missing_numbers(marks: DataFrame) -> DataFrame:
    """doc_id, missing: numbers between a document's first and last article that it lacks, from the gaps between neighbours."""
    n = marks.select("doc_id", F.expr("try_cast(regexp_extract(id, '^([0-9]+)', 1) AS bigint)").alias("n")).dropna().distinct()
    g = neighbours(n, ["doc_id"], "n", after={"nx": F.col("n")}).filter(F.col("nx") > F.col("n") + 1)
    return g.select("doc_id", F.explode(F.sequence(F.col("n") + 1, F.col("nx") - 1)).alias("missing"))


def order_violations(marks: DataFrame) -> DataFrame:
    """doc_id, seq, id, prev_id where an article does not come after the one before in legal order."""
    m = neighbours(marks, ["doc_id"], "at", before={"prev_id": F.col("id"), "_pk": F.col("key")})
    return m.filter(F.col("key") <= F.col("_pk")).select("doc_id", "seq", "id", "prev_id")


def article_lengths(md: DataFrame) -> DataFrame:
    """doc_id, seq (of the mark), id, chars up to the next mark, line breaks included, page marks not."""
    line = md.withColumn("_id", P.extract(F.col("text"), P.ART_MARK))
    line = running_last(line, ["doc_id"], "seq", {"_m": F.when(F.col("_id").isNotNull(), F.struct("seq", F.col("_id").alias("id")))}).filter("_m IS NOT NULL")
    rest = F.regexp_replace(F.regexp_replace("text", P.ART_MARK, ""), P.PAGE_MARK, "")
    return line.groupBy("doc_id", F.col("_m.seq").alias("seq"), F.col("_m.id").alias("id")).agg(F.sum(F.length(rest) + 1).alias("chars"))


def length_stats(lengths: DataFrame) -> DataFrame:
    """doc_id, min_chars, median_chars (truncated), max_chars, over_3000."""
    c = F.col("chars")
    return lengths.groupBy("doc_id").agg(F.min(c).alias("min_chars"), F.percentile(c, F.lit(0.5)).cast("bigint").alias("median_chars"), F.max(c).alias("max_chars"), F.count_if(c > 3000).alias("over_3000"))


def longest_articles(lengths: DataFrame, k: int = 10) -> DataFrame:
    """The k longest articles of each document: doc_id, rank, id, chars; ties in order of the text."""
    w = Window.partitionBy("doc_id").orderBy(F.desc("chars"), "seq")
    return lengths.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("doc_id", "rank", "id", "chars")


def headings_per_level(md: DataFrame) -> DataFrame:
    """doc_id, level, n."""
    return md.filter(F.col("text").startswith("#")).groupBy("doc_id", F.length(F.regexp_extract("text", "^(#+)", 1)).alias("level")).agg(F.count(F.lit(1)).alias("n"))


def notes_balance(md: DataFrame) -> DataFrame:
    """doc_id, fid, refs, defs: how often each note is cited and defined; one of the two is 0 where the balance fails."""
    is_def = F.col("text").rlike(P.NOTE_DEF)
    refs = md.filter(~is_def).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(P.NOTE_REF), F.lit(1))).alias("fid"), F.lit(1).alias("r"), F.lit(0).alias("d"))
    defs = md.filter(is_def).select("doc_id", F.regexp_extract("text", P.NOTE_DEF, 1).alias("fid"), F.lit(0).alias("r"), F.lit(1).alias("d"))
    return refs.unionByName(defs).groupBy("doc_id", "fid").agg(F.sum("r").alias("refs"), F.sum("d").alias("defs"))


def marks_and_characters(md: DataFrame) -> DataFrame:
    """Per document: page marks, tables (their rulers), private-use and replacement characters, very long and digit-only lines, rulings."""
    t = F.col("text")
    return md.groupBy("doc_id").agg(
        F.sum(F.regexp_count(t, F.lit(P.PAGE_MARK))).cast("bigint").alias("page_markers"), F.count_if(t.rlike(r"^\|(?: --- \|)+$")).alias("tables"),
        F.sum(F.length(F.regexp_replace(t, r"[^\uE000-\uF8FF]", ""))).cast("bigint").alias("private_use_chars"), F.sum(F.length(F.regexp_replace(t, r"[^\uFFFD]", ""))).cast("bigint").alias("replacement_chars"),
        F.count_if(F.length(t) > 2500).alias("very_long_paragraphs"), F.count_if(P.strip(t).rlike(r"^\d{1,4}$")).alias("digit_only_paragraphs"), F.count_if(t.rlike(r"^## R\d+")).alias("n_rescrits"),
    )


def cross_references(md: DataFrame) -> DataFrame:
    """Edges of cross-references: doc_id, seq, pos, target ('non précisé' where none), is_range, article; own labels taken off."""
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", P.ART_MARK, ""), P.PAGE_MARK, ""), r"\*\*Art\. \S+ :\*\*", "")
    r = md.select("doc_id", "seq", F.posexplode(P.references(body)).alias("pos", "_r"))
    return r.select("doc_id", "seq", "pos", F.coalesce("_r.target", F.lit("non précisé")).alias("target"), "_r.is_range", F.explode_outer("_r.nums").alias("article"))


def references_by_target(edges: DataFrame) -> DataFrame:
    """doc_id, target, n references."""
    return edges.select("doc_id", "seq", "pos", "target").distinct().groupBy("doc_id", "target").agg(F.count(F.lit(1)).alias("n"))


def flags(md: DataFrame) -> DataFrame:
    """doc_id, flag: missing numbers, duplicates, order, references without a note, digit-only and very long paragraphs."""
    m = article_marks(md)
    lines = marks_and_characters(md)
    found = [
        (missing_numbers(m), "missing_numbers"), (duplicate_articles(m), "duplicate_articles"), (order_violations(m), "order_violations"),
        (notes_balance(md).filter("refs > 0 AND defs = 0"), "refs_without_def"),
        (lines.filter("digit_only_paragraphs > 0"), "digit_only_paragraphs"), (lines.filter("very_long_paragraphs > 0"), "very_long_paragraphs"),
    ]
    out = None
    for d, name in found:
        one = d.select("doc_id").distinct().withColumn("flag", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def length_changes(raw: DataFrame, clean: DataFrame, k: int | None = None) -> DataFrame:
    """Articles by change of length from raw to clean: doc_id, id, raw_chars, clean_chars, change; the k largest of each document, or all."""
    a = article_lengths(raw).groupBy("doc_id", "id").agg(F.sum("chars").alias("raw_chars"))
    b = article_lengths(clean).groupBy("doc_id", "id").agg(F.sum("chars").alias("clean_chars"))
    j = b.join(a, ["doc_id", "id"], "left").withColumn("raw_chars", F.coalesce("raw_chars", F.lit(0))).withColumn("change", F.col("clean_chars") - F.col("raw_chars"))
    if k is None:
        return j.select("doc_id", "id", "raw_chars", "clean_chars", "change")
    w = Window.partitionBy("doc_id").orderBy(F.desc(F.abs("change")), "id")
    return j.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).select("doc_id", "id", "raw_chars", "clean_chars", "change")


def sampled(events: DataFrame, order: list[Column | str], per: int = 8) -> DataFrame:
    """The first ``per`` samples of each document and key."""
    w = Window.partitionBy("doc_id", "key").orderBy(*order)
    return events.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per).drop("_r")
