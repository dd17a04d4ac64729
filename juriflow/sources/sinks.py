"""Sinks: Markdown files with front matter, JSON lines, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from juriflow.functions.patterns import ART_MARK_LINE
from juriflow.operators.qa import sampled
from juriflow.operators.rawmd import unresolved
from juriflow.plans.pipeline import Extracted

#: Fixed value: the keys of the front matter in their order.
FRONT_KEYS = ["doc_id", "source_doc_id", "doc_type", "code", "version_year", "published", "modified", "source_url", "pdf_file", "pdf_pages", "body_size_pt", "p95_len", "ocr", "ocr_tier", "structured_markdown"]


def front_matter(documents_meta: DataFrame) -> DataFrame:
    """doc_id, header: the YAML front matter of each document; NULLs are left out, order and letters are kept."""
    parts = []
    for k in [k for k in FRONT_KEYS if k in documents_meta.columns]:
        c = F.concat(F.lit("["), F.array_join(F.col(k).cast("array<string>"), ", "), F.lit("]")) if k == "pdf_pages" else F.col(k).cast("string")
        quoted = F.when(c.rlike(r"^[\w./ -]*$|^\[") & ~c.rlike(r"^\d{4}-\d{2}-\d{2}"), c).otherwise(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'")))
        parts.append(F.when(c.isNotNull(), F.concat(F.lit(f"{k}: "), quoted)))
    return documents_meta.select("doc_id", F.concat(F.lit("---\n"), F.array_join(F.array_compact(F.array(*parts)), "\n"), F.lit("\n---\n")).alias("header"))


def documents_text(md_lines: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """doc_id, value: each document's lines as one text, behind its header."""
    d = md_lines.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: F.coalesce(x["text"], F.lit(""))), "\n").alias("_b"))
    if headers is None:
        return d.select("doc_id", F.concat("_b", F.lit("\n")).alias("value"))
    return d.join(headers, "doc_id", "left").select("doc_id", F.concat(F.coalesce("header", F.lit("")), "_b", F.lit("\n")).alias("value"))


def write_markdown(texts: DataFrame, path: str) -> None:
    """One folder ``doc_id=...`` for each document with its text."""
    texts.write.mode("overwrite").partitionBy("doc_id").text(path)


def extract_headers(documents_meta: DataFrame, got: Extracted, parts: DataFrame | None = None) -> DataFrame:
    """The front matter of extracted documents: metadata, page range, body size and line length; parts of a document name their code and its id."""
    m = documents_meta.withColumn("_whole", F.col("doc_id"))
    if parts is not None:
        m = m.drop("code").join(parts.select("doc_id", "stem", "code"), "doc_id").withColumn("doc_id", F.col("stem")).drop("stem")
    pages = got.pages.groupBy("doc_id").agg(F.array(F.min("page"), F.max("page")).alias("pdf_pages"))
    size = got.stats.select(F.col("doc_id").alias("_whole"), F.col("body_size").alias("body_size_pt"), F.bround("p95_len", 0).cast("int").alias("p95_len"))
    m = m.drop("pdf_pages", "body_size_pt", "p95_len").join(pages, "doc_id").join(size, "_whole", "left").withColumn("source_doc_id", F.coalesce("source_doc_id", "_whole") if "source_doc_id" in m.columns else F.col("_whole"))
    return front_matter(m)


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines; NULLs are kept, letters are not escaped."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _firsts(d: DataFrame, cols: list[str], out: str, k: int, *more: str) -> DataFrame:
    """doc_id and the first ``k`` rows by ``cols`` as an array; taken before they are gathered."""
    w = Window.partitionBy("doc_id").orderBy(*cols)
    top = d.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    return top.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*cols, *more))).alias(out))


def _counts(d: DataFrame, key: str, out: str) -> DataFrame:
    """doc_id and a MAP of how many rows have each key."""
    n = d.groupBy("doc_id", F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return n.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_n")))).alias(out))


def extract_report(got: Extracted) -> DataFrame:
    """One row for each document: page range, how notes were found, what was dropped, counts of headings by kind, articles and rulings, the first 60 multi-line titles, unresolved markers and orphan notes, 100 warnings, the page map."""
    docs = got.pages.groupBy("doc_id").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count(F.lit(1)).alias("n_pages"), F.sum("reclaimed").alias("small_lines_returned"), F.array_sort(F.collect_list(F.struct(F.col("page").alias("pdf"), F.col("printed_page").alias("printed")))).alias("page_map"))
    dropped = got.routed.filter(F.col("route").isin("page_number", "running_header_footer", "drop_regex"))
    titles = headings(got.raw)
    warnings = got.articles.filter("NOT rising").select("doc_id", "page", F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(": article "), "id", F.lit(" après "), "prev_id", F.lit(" (ordre non croissant)")).alias("text"))
    many = got.titles.filter("lines > 1").select("doc_id", "page", F.concat("title", F.lit(" … ("), F.col("lines").cast("string"), F.lit(" lignes)")).alias("text"))
    whole = [
        _counts(got.pages, "footnote_method", "footnote_detection"), _counts(dropped, "route", "dropped_lines"), _counts(titles.filter("kind IS NOT NULL"), "kind", "headings_by_kind"),
        titles.groupBy("doc_id").agg(F.count_if(F.col("kind").isNotNull()).alias("n_headings"), F.count_if("ruling").alias("n_rescrits"), F.count_if("article").alias("n_articles")),
        got.orphans.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_orphan_notes")),
        _firsts(many, ["page", "text"], "multiline_headings", 60), _firsts(unresolved(got.links), ["page", "num"], "unresolved_footnote_markers", 60),
        _firsts(got.orphans, ["page", "num", "text"], "orphan_footnote_definitions", 60), _firsts(warnings, ["page", "text"], "warnings", 100),
    ]
    for one in whole:
        docs = docs.join(one, "doc_id", "left")
    return docs.fillna(0, ["n_headings", "n_rescrits", "n_articles", "n_orphan_notes"])


def headings(raw: DataFrame) -> DataFrame:
    """Lines of raw Markdown that open something: doc_id, seq, kind (of a title), ruling, article."""
    t = F.col("text")
    level = F.length(F.regexp_extract(t, "^(#{1,6}) ", 1))
    ruling = t.rlike(r"^## R\d+ : ")
    label = F.lower(F.regexp_extract(t, r"(?iuU)^#{1,6} (?:(livre|titre|chapitre|section|paragraphe) \S+|\S+ (partie))\b", 1))
    part = F.lower(F.regexp_extract(t, r"(?iuU)^#{1,6} (?:(?:livre|titre|chapitre|section|paragraphe) \S+|\S+ (partie))\b", 1))
    kind = F.when((level > 0) & ~ruling, F.coalesce(F.nullif(label, F.lit("")), F.nullif(part, F.lit("")), F.concat(F.lit("h"), level.cast("string"))))
    return raw.select("doc_id", "seq", kind.alias("kind"), ruling.alias("ruling"), t.rlike(ART_MARK_LINE).alias("article")).filter("kind IS NOT NULL OR ruling OR article")


def clean_report(clean: DataFrame, events: DataFrame, broken: DataFrame, flags: DataFrame) -> DataFrame:
    """One row for each document: a MAP of corrections, the first 8 samples of each, the first 250 broken words, the flags of quality control."""
    total = events.groupBy("doc_id", "key").agg(F.sum("n").alias("n")).groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "n")))).alias("corrections"))
    some = sampled(events.filter("sample IS NOT NULL"), ["seq", "sample"]).groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("seq", "sample")))["sample"].alias("s")).groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "s")))).alias("samples"))
    out = clean.select("doc_id").distinct().join(total, "doc_id", "left").join(some, "doc_id", "left").join(_firsts(broken, ["seq", "text"], "hyphens", 250, "how"), "doc_id", "left")
    return out.join(flags.groupBy("doc_id").agg(F.array_sort(F.collect_set("flag")).alias("flags")), "doc_id", "left")


def figures_markdown(figures: DataFrame) -> DataFrame:
    """doc_id, value: a Markdown report of figure lines by page."""
    pages = figures.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("_l"))
    block = F.concat(F.lit("## Page "), F.col("page").cast("string"), F.lit("\n"), F.array_join(F.transform("_l", lambda x: F.concat(F.lit("- "), x["text"])), "\n"), F.lit("\n"))
    g = pages.select("doc_id", "page", F.size("_l").alias("n"), block.alias("b")).groupBy("doc_id").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("page", "b"))).alias("_p"))
    return g.select("doc_id", F.concat(F.lit("# Chiffres à vérifier : "), "doc_id", F.lit("\n\n"), F.col("n").cast("string"), F.lit(" lignes contenant un taux ou un montant.\n\n"), F.array_join(F.transform("_p", lambda x: x["b"]), "\n")).alias("value"))
