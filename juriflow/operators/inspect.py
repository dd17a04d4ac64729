"""Inspection of documents before extraction: aggregates over lines in the form of ``layout.as_lines``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.functions import patterns as P
from juriflow.operators.ordered import neighbours

#: Leader dots before a page number in a table of contents, and the title of a code.
LEADERS = r"(?U)(?:\.{4,}|…{2,}|(?:\s\.){4,})\s*\d{1,4}\s*$"
CODE_TITLE = r"(?iuU)^\s*(?:code\s+g[ée]n[ée]ral\s+des\s+imp[ôo]ts|livre\s+des\s+proc[ée]dures\s+fiscales)\s*$"


def text_per_page(lines: DataFrame, first: int = 30) -> DataFrame:
    """Characters per page over the first pages, empty ones included: doc_id, pages, mean_chars, min_chars, scan (under 200), skip (under 100)."""
    per = lines.groupBy("doc_id", "page").agg(F.sum(F.length(P.strip(F.col("text")))).alias("c"))
    early = F.col("page") <= first
    d = per.groupBy("doc_id").agg(F.max("page").alias("_n"), F.count_if(early).alias("_seen"), F.sum(F.when(early, F.col("c")).otherwise(0)).alias("_s"), F.min(F.when(early, F.col("c"))).alias("_min"))
    d = d.withColumn("pages", F.least(F.col("_n"), F.lit(first)).cast("bigint"))
    mean = F.col("_s") / F.col("pages")
    return d.select("doc_id", "pages", mean.alias("mean_chars"), F.when(F.col("_seen") < F.col("pages"), 0).otherwise(F.col("_min")).alias("min_chars"), (mean < 200).alias("scan"), (mean < 100).alias("skip"))


def font_sizes(lines: DataFrame, k: int = 6) -> DataFrame:
    """The k sizes with most characters of each document: doc_id, rank, size, chars, percent."""
    h = lines.filter("size IS NOT NULL").groupBy("doc_id", F.round("size", 1).alias("size")).agg(F.sum(F.length("text")).alias("chars"))
    w = Window.partitionBy("doc_id")
    h = h.withColumn("percent", F.round(F.col("chars") * 100 / F.sum("chars").over(w), 1)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("chars"), "size")))
    return h.filter(F.col("rank") <= k).select("doc_id", "rank", "size", "chars", "percent")


def number_positions(lines: DataFrame, zone: float = 0.08) -> DataFrame:
    """Lines of digits only: doc_id, n, n_top, n_bottom, outside (of the margin zones), and least, median and greatest height in thousandths of the page."""
    y = (F.col("y0") + F.col("y1")) / 2 / F.col("page_h")
    d = lines.filter(F.col("text").rlike(P.DIGITS_ONLY) & y.isNotNull()).withColumn("y", y)
    mille = lambda c: F.floor(c * 1000).alias
    return d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") < 0.5).alias("n_top"), F.count_if(F.col("y") >= 0.5).alias("n_bottom"), F.count_if(~F.col("y").between(zone, 1 - zone)).alias("_in"), mille(F.min("y"))("min_y"), mille(F.percentile("y", F.lit(0.5)))("median_y"), mille(F.max("y"))("max_y")).withColumn("outside", F.col("n") - F.col("_in")).drop("_in")


def small_foot_lines(lines: DataFrame, stats: DataFrame, ratio: float = 0.92, low: float = 0.8) -> DataFrame:
    """Per document: small lines at the foot of pages, pages that have them, glued markers, superscript markers."""
    d = lines.join(stats.select("doc_id", "body_size"), "doc_id")
    small = (F.col("size") <= ratio * F.col("body_size")) & ((F.col("y0") + F.col("y1")) / 2 > low * F.col("page_h"))
    glued = F.col("text").rlike(P.GLUED_MARKER) & ~F.col("text").rlike(P.DIGITS_ONLY)
    return d.groupBy("doc_id").agg(F.count_if(small).alias("small_lines"), F.count_distinct(F.when(small, F.col("page"))).alias("pages"), F.count_if(glued).alias("glued_markers"), F.sum(F.regexp_count("text", F.lit(P.PLACEHOLDER))).cast("bigint").alias("superscripts"))


def foot_samples(lines: DataFrame, stats: DataFrame, k: int = 6, ratio: float = 0.92, low: float = 0.8) -> DataFrame:
    """The first small lines at the foot of pages: doc_id, rank, page, size, text (90 characters)."""
    d = lines.join(stats.select("doc_id", "body_size"), "doc_id").filter((F.col("size") <= ratio * F.col("body_size")) & ((F.col("y0") + F.col("y1")) / 2 > low * F.col("page_h")))
    w = Window.partitionBy("doc_id").orderBy("page", "ix")
    return d.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("doc_id", "rank", "page", "size", F.substring("text", 1, 90).alias("text"))


def two_columns(lines: DataFrame, stats: DataFrame, widths: DataFrame | None = None, top: float = 0.08, bottom: float = 0.08, page_w: float = 595.0) -> DataFrame:
    """doc_id, n (lines of body size between the margins), right (of them, those that begin beyond 45 % of their page's width), two_columns (over a quarter).

    ``widths``: doc_id, page, page_w; ``page_w`` holds for pages it does not list.
    """
    d = lines.join(stats.select("doc_id", "body_size"), "doc_id")
    cy = (F.col("y0") + F.col("y1")) / 2
    d = d.filter((F.abs(F.col("size") - F.col("body_size")) <= 0.6) & (cy > top * F.col("page_h")) & (cy < (1 - bottom) * F.col("page_h")))
    d = d.withColumn("page_w", F.lit(page_w)) if widths is None else d.join(widths.groupBy("doc_id", "page").agg(F.max("page_w").alias("page_w")), ["doc_id", "page"], "left").fillna(page_w, ["page_w"])
    d = d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x0") > 0.45 * F.col("page_w")).alias("right"))
    return d.withColumn("two_columns", F.col("right") * 4 > F.col("n"))


def large_gaps(lines: DataFrame, stats: DataFrame, factor: float = 1.6) -> DataFrame:
    """doc_id, n lines with a gap of less than three body sizes, large ones among them."""
    d = lines.join(stats.select("doc_id", "median_leading", "body_size"), "doc_id").filter((F.col("gap_before") > 0) & (F.col("gap_before") < 3 * F.col("body_size")))
    return d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("gap_before") > factor * F.col("median_leading")).alias("large"))


def headings_by_kind(lines: DataFrame) -> DataFrame:
    """doc_id, kind, n of heading lines."""
    return lines.withColumn("_h", P.heading(P.strip(F.col("text")))).filter("_h IS NOT NULL").groupBy("doc_id", F.col("_h.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def article_starts(lines: DataFrame) -> DataFrame:
    """doc_id, ix, page, id, number of article lines."""
    a = lines.withColumn("_a", P.article_start(P.strip(F.col("text")))).filter("_a IS NOT NULL")
    return a.select("doc_id", "ix", "page", F.col("_a.id").alias("id"), F.expr("try_cast(regexp_extract(_a.id, '^([0-9]+)', 1) AS int)").alias("number"))


def numbering_resets(lines: DataFrame) -> DataFrame:
    """Where numbering starts again (from 20 or more to 3 or less), which suggests a second code: doc_id, ix, page, prev_number, number."""
    a = neighbours(article_starts(lines).filter("number IS NOT NULL"), ["doc_id"], "ix", before={"prev_number": F.col("number")})
    return a.filter((F.col("prev_number") >= 20) & (F.col("number") <= 3)).select("doc_id", "ix", "page", "prev_number", "number")


def contents_pages(lines: DataFrame, least: int = 8) -> DataFrame:
    """Pages with at least 8 lines of leader dots: doc_id, page, n."""
    return lines.filter(F.col("text").rlike(LEADERS)).groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def code_title_pages(lines: DataFrame) -> DataFrame:
    """doc_id, page, text of lines that are a code's title."""
    return lines.filter(F.col("text").rlike(CODE_TITLE)).select("doc_id", "page", "text")


def rulings(lines: DataFrame) -> DataFrame:
    """Rulings in order: doc_id, ix, number, follows (whether the number is that of the one before plus 1)."""
    r = lines.filter(F.col("text").rlike(P.RULING_START)).select("doc_id", "ix", F.regexp_extract("text", P.RULING_START, 1).cast("int").alias("number"))
    r = neighbours(r, ["doc_id"], "ix", before={"_p": F.col("number")})
    return r.select("doc_id", "ix", "number", F.coalesce(F.col("number") == F.col("_p") + 1, F.lit(True)).alias("follows"))


def table_pages(tables: DataFrame) -> DataFrame:
    """doc_id, page, tables."""
    return tables.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("tables"))


def page_dump(lines: DataFrame, pages: list[int], page_w: float = 595.0) -> DataFrame:
    """Lines of the given pages with their place in percent: doc_id, page, ix, y, x, size, bold, text."""
    return lines.filter(F.col("page").isin(pages)).select("doc_id", "page", "ix", F.round(F.col("y0") * 100 / F.col("page_h"), 1).alias("y"), F.round(F.col("x0") * 100 / page_w, 1).alias("x"), "size", "bold", "text")


def _part(d: DataFrame, order: list[str], line: Column, title: str, most: int = 60) -> DataFrame:
    """doc_id and a section of a report: a title and the first ``most`` lines."""
    w = Window.partitionBy("doc_id").orderBy(*order)
    d = d.select("doc_id", F.row_number().over(w).alias("_r"), line.alias("_t")).filter(F.col("_r") <= most)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "_t"))), lambda x: x["_t"]), "\n")
    return d.groupBy("doc_id").agg(F.concat(F.lit(f"\n## {title}\n"), body).alias("text"))


def report(lines: DataFrame, stats: DataFrame, documents: DataFrame, repeated: DataFrame, tables: DataFrame | None = None, dump: DataFrame | None = None) -> DataFrame:
    """doc_id, value: a Markdown report of what inspection finds in each document."""
    bullet = lambda *parts: F.concat(F.lit("- "), *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    c = F.col
    arts = article_starts(lines)
    near = neighbours(arts.filter("number IS NOT NULL").select("doc_id", "number").distinct(), ["doc_id"], "number", after={"nx": c("number")})
    first = arts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("id", "ix").alias("a"), F.max_by("id", "ix").alias("z"))
    double = arts.groupBy("doc_id", "id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    head = lines.withColumn("_h", P.heading(P.strip(c("text")))).filter("_h IS NOT NULL")
    sections = [
        _part(text_per_page(lines), ["doc_id"], bullet("pages read: ", c("pages"), ", characters a page: mean ", F.round("mean_chars", 0), ", least ", c("min_chars"), F.when(c("scan"), " (probably scanned)").otherwise("")), "Text"),
        _part(font_sizes(lines), ["rank"], bullet(c("size"), " pt: ", c("percent"), " %"), "Font sizes"),
        _part(stats, ["doc_id"], bullet("body ", c("body_size"), " pt, line length p95 ", c("p95_len"), ", median leading ", F.round("median_leading", 1)), "Body"),
        _part(repeated, ["key"], bullet(c("key"), " (", c("n"), ")"), "Repeated margin lines"),
        _part(number_positions(lines), ["doc_id"], bullet(c("n"), " lines of digits, ", c("n_top"), " at the top, ", c("n_bottom"), " at the bottom, ", c("outside"), " outside of the margins; median height ", c("median_y"), " of 1000"), "Page numbers"),
        _part(small_foot_lines(lines, stats), ["doc_id"], bullet(c("small_lines"), " small lines on ", c("pages"), " pages, ", c("superscripts"), " superscripts, ", c("glued_markers"), " glued markers"), "Notes"),
        _part(foot_samples(lines, stats), ["rank"], bullet("p", c("page"), " ", c("size"), " pt: ", c("text")), "Samples of notes"),
        _part(two_columns(lines, stats), ["doc_id"], bullet(c("right"), " of ", c("n"), " lines begin in the right half", F.when(c("two_columns"), " (probably two columns)").otherwise("")), "Columns"),
        _part(large_gaps(lines, stats), ["doc_id"], bullet(c("large"), " of ", c("n"), " gaps are large"), "Gaps"),
        _part(headings_by_kind(lines), ["kind"], bullet(c("kind"), ": ", c("n")), "Headings"),
        _part(head, ["page", "ix"], bullet("p", c("page"), " [", c("_h.kind"), "] ", F.substring("text", 1, 90)), "Samples of headings", 14),
        _part(first, ["doc_id"], bullet(c("n"), " articles, first ", c("a"), ", last ", c("z")), "Articles"),
        _part(near.filter("nx > number + 1").select("doc_id", F.explode(F.sequence(c("number") + 1, c("nx") - 1)).alias("m")), ["m"], bullet(c("m")), "Missing articles", 40),
        _part(double, ["id"], bullet(c("id"), " (", c("n"), " times)"), "Articles found more than once", 20),
        _part(numbering_resets(lines), ["ix"], bullet("from article ", c("prev_number"), " to ", c("number"), " on page ", c("page"), ": a second code may begin here"), "Numbering starts again"),
        _part(code_title_pages(lines), ["page"], bullet("p", c("page"), ": ", c("text")), "Titles of codes", 12),
        _part(contents_pages(lines), ["page"], bullet("p", c("page"), ": ", c("n"), " lines with leader dots"), "Tables of contents", 20),
        _part(rulings(lines), ["ix"], bullet("R", c("number"), F.when(c("follows"), "").otherwise(" (does not follow)")), "Rulings", 12),
    ]
    if tables is not None:
        sections.append(_part(table_pages(tables), ["page"], bullet("p", c("page"), ": ", c("tables")), "Pages with tables", 40))
    if dump is not None:
        sections.append(_part(dump, ["page", "ix"], bullet("p", c("page"), " y ", c("y"), " x ", c("x"), " ", c("size"), " pt", F.when(c("bold"), " B").otherwise(""), " ", F.substring("text", 1, 110)), "Lines", 10_000))
    out = documents.select("doc_id", F.lit(0).alias("_i"), F.concat(F.lit("# Inspection: "), "doc_id", F.lit("\n- type: "), "doc_type").alias("text"))
    for i, one in enumerate(sections, 1):
        out = out.unionByName(one.withColumn("_i", F.lit(i)))
    return out.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "text"))), lambda x: x["text"]), "\n").alias("value"))
