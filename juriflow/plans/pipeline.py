"""The three stages as plans: lines to raw Markdown, raw to clean, clean to chunks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriflow.operators import chunks, inspect, layout, rawmd, reflow, units
from juriflow.session import stored
from juriflow.sources.manifest import pages_of_parts


@dataclass
class Extracted:
    """What extraction gives for a set of documents; ``titles`` are doc_id, page, title, lines."""

    raw: DataFrame
    pages: DataFrame
    stats: DataFrame
    routed: DataFrame
    defs: DataFrame
    links: DataFrame
    orphans: DataFrame
    articles: DataFrame
    titles: DataFrame


def documents_of(documents_meta: DataFrame) -> DataFrame:
    """One row for each doc_id with doc_type and first_page, from the row that was loaded last."""
    order = F.struct(*[c for c in ("loaded_at", "doc_type", "pdf_pages") if c in documents_meta.columns])
    m = documents_meta.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(order).alias("_m"))
    return m.select("doc_id", F.coalesce("_m.doc_type", F.lit("generic")).alias("doc_type"), F.coalesce(F.get("_m.pdf_pages", F.lit(0)), F.lit(1)).alias("first_page"))


def native(lines: DataFrame, documents: DataFrame) -> DataFrame:
    """The documents that hold native text, at least 100 characters a page over their first pages."""
    return documents.join(inspect.text_per_page(lines).filter("skip").select("doc_id"), "doc_id", "left_anti")


@dataclass
class Read:
    """Routed lines of documents with their notes."""

    documents: DataFrame
    stats: DataFrame
    routed: DataFrame
    defs: DataFrame
    body: DataFrame
    links: DataFrame
    orphans: DataFrame


def read(lines: DataFrame, documents: DataFrame, cfg: DataFrame | None = None, parts: DataFrame | None = None) -> Read:
    """Lines (as ``layout.as_lines`` or ``layout.page_lines`` gives them) to routed lines and resolved notes.

    ``cfg``: layout settings (``layout.settings``); ``parts``: the ranges of
    ``manifest.subdocument_ranges``, whose stems become documents of their own
    after the statistics of the whole.
    """
    cfg = cfg if cfg is not None else layout.settings(documents)
    lines = lines.join(documents.select("doc_id"), "doc_id", "left_semi")
    stats = stored(layout.doc_stats(lines, cfg))
    routed = layout.routed(lines, cfg, stats)
    if parts is not None:
        routed, documents = as_parts(routed, parts), as_parts_documents(documents, parts)
    routed = stored(routed)
    defs = stored(layout.footnote_defs(routed))
    # an order over the document: page, then the place on it
    body = layout.body_of(routed, defs).withColumn("ix", F.col("page").cast("bigint") * 1_000_000 + F.col("ix") % 1_000_000)
    links = stored(rawmd.note_links(body, defs))
    return Read(documents, stats, routed, defs, body, links, rawmd.orphan_notes(defs, links))


def extract(lines: DataFrame, documents: DataFrame, cfg: DataFrame | None = None, tables: DataFrame | None = None, parts: DataFrame | None = None) -> Extracted:
    """Lines to raw Markdown, by each document's type (see ``read``).

    ``tables``: doc_id, page, box and rows of tables, of which the good ones
    replace the lines inside them in narrative documents.  Steps that are read
    more than once are tables in the shared folder, so that plans stay small and
    an executor's loss costs one step.
    """
    r = read(lines, documents, cfg, parts)
    text = stored(rawmd.resolved(r.body, r.links).join(r.documents.select("doc_id", "doc_type"), "doc_id"))
    plain = r.documents.filter("doc_type NOT IN ('code', 'rescrits')").select("doc_id")
    generic = text.filter("doc_type NOT IN ('code', 'rescrits')")
    if tables is not None:
        tables = tables if parts is None else as_parts(tables, parts)
        tables = stored(layout.good_tables(tables).join(plain, "doc_id", "left_semi"))
        generic = layout.outside_tables(generic, tables)
    rows = rawmd.build_code(text.filter("doc_type = 'code'")).unionByName(rawmd.build_generic(generic, tables, r.orphans.join(plain, "doc_id", "left_semi")))
    pages = stored(layout.page_records(r.routed))
    marked = pages.join(r.documents.filter("doc_type <> 'rescrits'").select("doc_id"), "doc_id", "left_semi")
    rows = rows.unionByName(rawmd.empty_pages(marked, text)).unionByName(rawmd.build_rulings(text.filter("doc_type = 'rescrits'")))
    raw, titles = rawmd.emit(rows)
    return Extracted(stored(raw), pages, r.stats, r.routed, r.defs, r.links, r.orphans, rawmd.article_order(text.filter("doc_type = 'code'")), titles)


def as_parts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows with the stem of their page's part as doc_id; pages outside of all parts are left out."""
    return pages_of_parts(rows, parts.select("doc_id", "stem", "code", "first_page", "last_page")).withColumn("doc_id", F.col("stem")).drop("stem", "code")


def as_parts_documents(documents: DataFrame, parts: DataFrame) -> DataFrame:
    """The parts as documents, with the type of the whole."""
    return parts.select("doc_id", "stem", "first_page").join(documents.select("doc_id", "doc_type"), "doc_id").select(F.col("stem").alias("doc_id"), "doc_type", "first_page")


def clean(raw: DataFrame, p95: DataFrame | None = None) -> DataFrame:
    """Raw to clean Markdown lines."""
    return reflow.reflow(raw, p95)


def chunk(clean_lines: DataFrame, documents_meta: DataFrame, page_map: DataFrame | None = None, orphan_notes: DataFrame | None = None, limit: int = 3000, least: int = 250) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean lines to (chunks, units, outside lines)."""
    documents = documents_of(documents_meta)
    found = units.merge_small_units(units.units(clean_lines, documents), least)
    return chunks.chunks(found, documents_meta, page_map, orphan_notes, limit, least), found, units.outside_lines(clean_lines, documents)


def page_map(pages: DataFrame) -> DataFrame:
    """doc_id, pdf_page, printed_page."""
    return pages.select("doc_id", F.col("page").alias("pdf_page"), "printed_page")
