"""Queries of the document operators over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from juriflow.functions import patterns as P
from juriflow.functions import text as T
from juriflow.operators import chunks, inspect, layout, ocr, pack, qa, rawmd, reflow, units
from juriflow.operators.ordered import neighbours, running_last
from juriflow.plans import pipeline
from juriflow.session import stored, table
from juriflow.sources import sinks


#: The text and the height of a derived line, alike in Spark and in SQL.
_DERIVED = """CASE WHEN doc_id % 11 = 0 AND seq % 10 > 1 THEN concat(substring(line, 1, 20), ' ..... ', cast(seq AS {S}))
 WHEN doc_id % 13 = 0 AND seq % 10 = 2 THEN 'CODE GÉNÉRAL DES IMPÔTS'
 WHEN seq % 10 = 0 THEN concat('R', cast((seq {div} 10) % 90 + 1 + CASE WHEN seq % 70 = 0 THEN 2 ELSE 0 END AS {S}), ' : ', substring(line, 1, 40))
 WHEN seq % 10 = 1 THEN concat('Art. ', cast((doc_id + seq {div} 10 * 7) % 45 + 1 AS {S}), ' : ', substring(line, 1, 40), CASE WHEN (seq {div} 10) % 5 < 3 THEN concat('{{{{fn:', cast(seq {div} 10 + 1 + CASE WHEN (seq {div} 10) % 5 = 2 THEN 1 ELSE 0 END AS {S}), '}}}}') ELSE '' END)
 WHEN seq % 10 = 3 THEN concat(cast(seq % 7 + 1 AS {S}), 'Toutefois ', substring(line, 1, 30))
 WHEN seq % 10 = 8 THEN concat('{{{{fn:', cast(seq {div} 10 + 1 AS {S}), '}}}} Loi N°20', cast(10 + doc_id % 15 AS {S}), '-0', cast(10 + seq % 80 AS {S}), ' du 27 décembre 2020')
 WHEN seq % 10 = 9 THEN cast(seq {div} 10 + 101 AS {S}) ELSE line END"""
#: What a noisy line holds, alike in Spark and in SQL.
_NOISY = """CASE seq % 12 WHEN 1 THEN concat('• ', line) WHEN 2 THEN concat('de ', cast(seq * 100 AS {S}), ' A ', cast(seq * 100 + 99 AS {S}), ' ', cast(seq % 30 AS {S}), '%')
 WHEN 3 THEN ':' WHEN 4 THEN concat('<!--pg:', cast(seq {div} 12 + 1 AS {S}), '-->') WHEN 5 THEN concat(line, ' le 1 er janvier ( x ) , ci') WHEN 6 THEN concat('la ﬁn de ', line, ' exemp-')
 WHEN 7 THEN concat('tions et ', line, ' ci-') WHEN 8 THEN concat('dessus eux mêmes euxmêmes cidessous ', line) WHEN 9 THEN concat('| ', line, ' | 1 |') ELSE line END"""
_DERIVED_Y = "CASE WHEN seq % 10 = 8 THEN 700 WHEN seq % 10 = 9 THEN 805 ELSE 90 + 60 * (seq % 10) END * CAST(1 AS DOUBLE)"


def _lines(spark, d):
    return layout.as_lines(table(spark, d, "doc_lines"))


def _stats(spark, d, source=None):
    lines = (source or _lines)(spark, d)
    return lines, layout.doc_stats(lines, layout.settings(lines))


def _derived_lines(spark, d):
    """Pages of ten lines made of every line of ``documents.text``: rulings, articles whose numbers start again, leader dots, glued and small note markers, notes and page numbers."""
    t = table(spark, d, "documents").filter("doc_id IS NOT NULL").select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "line")).filter("trim(line) <> ''")
    return t.selectExpr(
        "concat('d:', cast(doc_id AS string)) AS doc_id", "cast(seq div 10 + 1 AS int) AS page", "cast(seq AS bigint) AS ix", f"{_DERIVED.format(S='string', div='div')} AS text",
        "60.0D AS x0", f"{_DERIVED_Y} AS y0", "260.0D AS x1", f"{_DERIVED_Y} + 10.0D AS y1", "CASE WHEN seq % 10 = 8 THEN 8.0D ELSE 11.0D END AS size", "seq % 10 = 1 AS bold",
        "CASE WHEN seq % 10 = 6 THEN 30.0D ELSE 14.0D END AS gap_before", "842.0D AS page_h",
    )


def _all_lines(spark, d):
    """``doc_lines`` and the derived pages."""
    return _lines(spark, d).unionByName(_derived_lines(spark, d))


def _text_lines(spark, d):
    """Every line of ``documents.text``: doc_id, seq, text."""
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "text")).withColumn("seq", F.col("seq").cast("bigint"))


def _noisy_lines(spark, d):
    """The lines of ``documents.text`` with bullets, brackets, marks, glued words, ligatures and broken words put in by place."""
    return _text_lines(spark, d).withColumnRenamed("text", "line").selectExpr("doc_id", "seq", f"{_NOISY.format(S='string', div='div')} AS text")


def _documents(spark, d):
    """``documents`` as metadata of one-page documents."""
    c = table(spark, d, "documents").filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    return c.select(F.col("doc_id").cast("string").alias("doc_id"), "source_doc_id", "doc_type", F.lit("CGI").alias("code"), "version_year", F.lit(None).cast("string").alias("published"), F.lit(None).cast("string").alias("source_url"), F.lit(None).cast("array<int>").alias("pdf_pages"))


def _marked(spark, d):
    """Clean lines of the documents' texts with article marks on lines of their own and headings as Markdown."""
    t = _text_lines(spark, d)
    a, h = P.article_start(P.strip(F.col("text"))), P.heading(P.strip(F.col("text")))
    art = F.array(F.concat(F.lit("<!--art:"), a["id"], F.lit("-->")), F.concat(F.lit("**Art. "), a["id"], F.lit(" :** "), a["rest"]))
    out = F.when(a.isNotNull(), art).when(h.isNotNull(), F.array(F.concat(F.repeat(F.lit("#"), h["level"]), F.lit(" "), "text"))).otherwise(F.array("text"))
    return t.select(F.col("doc_id").cast("string").alias("doc_id"), "seq", F.posexplode(out).alias("i", "text")).select("doc_id", (F.col("seq") * 2 + F.col("i")).alias("seq"), "text")


def _md(spark, d):
    """The lines of documents as Markdown with article marks, in one narrow step: what quality control reads."""
    t = _text_lines(spark, d)
    a, h = P.article_start(P.strip(F.col("text"))), P.heading(P.strip(F.col("text")))
    text = F.when(a.isNotNull(), F.concat(F.lit("<!--art:"), a["id"], F.lit("-->"), a["rest"])).when(h.isNotNull(), F.concat(F.repeat(F.lit("#"), h["level"]), F.lit(" "), "text")).otherwise(F.col("text"))
    return t.select("doc_id", "seq", text.alias("text"))


# -- patterns and scalar functions

def heading_lines(spark, d):
    h = P.heading(P.strip(F.col("text")))
    return _text_lines(spark, d).withColumn("h", h).filter("h IS NOT NULL").select("doc_id", "seq", "h.level", "h.kind", "h.num", "h.title")


def heading_levels(spark, d):
    return heading_lines(spark, d).groupBy("doc_id", "level").agg(F.count(F.lit(1)).alias("n"))


def heading_stack(spark, d):
    t = _text_lines(spark, d).withColumn("h", P.heading(P.strip(F.col("text"))))
    lev = F.col("h.level")
    cols = {f"l{k}": F.when(lev == k, F.struct(F.col("h.title").alias("t"))).when(lev < k, F.struct(F.lit(None).cast("string").alias("t"))) for k in range(1, 7)}
    r = running_last(t, ["doc_id"], "seq", cols)
    return r.select("doc_id", "seq", *[F.col(f"l{k}.t").alias(f"l{k}") for k in range(1, 7)])


def article_lines(spark, d):
    a = P.article_start(P.strip(F.col("text")))
    return _text_lines(spark, d).withColumn("a", a).filter("a IS NOT NULL").select("doc_id", "seq", "a.id", "a.rest")


def article_sort_keys(spark, d):
    k = P.article_sort_key(F.col("article"))
    return table(spark, d, "code_articles").select("code", "article").distinct().select("code", "article", k["n"].alias("n"), k["rank"].alias("rank"), k["suffix"].alias("suffix"))


def line_flags(spark, d):
    t = F.col("text")
    flags = {"is_list": t.rlike(P.LIST_START), "is_sub": t.rlike(P.SUBHEADING), "is_ruling": t.rlike(P.RULING_START), "is_digits": t.rlike(P.DIGITS_ONLY), "is_legal": t.rlike(P.LEGAL_START), "is_punct": t.rlike(P.LONE_PUNCT), "is_caption": t.rlike(P.TABLE_CAPTION)}
    return _text_lines(spark, d).select("doc_id", "seq", *[v.alias(k) for k, v in flags.items()])


def glued_markers(spark, d):
    return _all_lines(spark, d).filter(F.col("text").rlike(P.GLUED_MARKER)).select("doc_id", F.col("ix").alias("seq"), F.regexp_extract("text", P.GLUED_MARKER, 1).alias("marker"))


def bracket_rows(spark, d):
    return _lines(spark, d).select("doc_id", F.col("ix").alias("seq"), P.bracket(P.strip(F.regexp_replace("text", r" à [A-Z]\p{L}+$", ""))).alias("b")).filter("b IS NOT NULL").select("doc_id", "seq", "b.lo", "b.hi", "b.rate")


def cross_reference_edges(spark, d):
    return qa.cross_references(_text_lines(spark, d)).select("doc_id", "seq", "pos", "target", "is_range", "article")


def references_by_target(spark, d):
    return qa.references_by_target(cross_reference_edges(spark, d))


def law_notes(spark, d):
    n = P.note(F.col("text"))
    return table(spark, d, "footnote_defs").select("doc_id", "page", "num", "text").distinct().select("doc_id", "page", "num", n["text"].alias("text"), n["law"].alias("law"), n["date"].alias("date"), n["exercice"].alias("exercice"))


def normalized_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.normalize_chars(F.col("text"))).alias("digest"))


def fixed_text(spark, d):
    t = T.fix_text(F.col("text"))
    return _text_lines(spark, d).filter(t != F.col("text")).select("doc_id", "seq", t.alias("text"))


def bullets(spark, d):
    t = T.normalize_bullet(F.col("text"))
    return _text_lines(spark, d).filter(t.startswith("- ")).select("doc_id", "seq", t.alias("text"))


def plain_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length(T.clean_text(F.col("text"))).cast("bigint").alias("n"))


def hyphen_decisions(spark, d):
    t = neighbours(_lines(spark, d), ["doc_id"], "ix", after={"next": F.col("text")}).filter(F.col("text").rlike(r"[\p{L}\p{N}]-$") & F.col("next").isNotNull())
    return t.select("doc_id", F.col("ix").alias("seq"), T.hyphen_decision(F.col("text"), F.col("next")).alias("how"), T.join_pair(F.col("text"), F.col("next")).alias("joined"))


def title_words(spark, d):
    t = P.strip(F.col("text"))
    return heading_lines(spark, d).select("doc_id", "seq", T.is_upper(F.col("title")).alias("capitals"), T.ends_with_function_word(F.col("title")).alias("goes_on"), P.heading_label(F.col("kind"), F.col("num")).alias("label"))


# -- quality control

def article_numbers(spark, d):
    return qa.article_numbers(qa.article_marks(_md(spark, d)))


def duplicate_articles(spark, d):
    return qa.duplicate_articles(qa.article_marks(_md(spark, d)))


def missing_article_numbers(spark, d):
    return qa.missing_numbers(qa.article_marks(_md(spark, d)))


def article_order_violations(spark, d):
    return qa.order_violations(qa.article_marks(_md(spark, d)))


def article_lengths(spark, d):
    return qa.article_lengths(_md(spark, d))


def article_length_stats(spark, d):
    return qa.length_stats(qa.article_lengths(_md(spark, d)))


def longest_articles(spark, d):
    return qa.longest_articles(qa.article_lengths(_md(spark, d)))


def markdown_headings(spark, d):
    return qa.headings_per_level(_md(spark, d))


def marks_and_characters(spark, d):
    return qa.marks_and_characters(_md(spark, d))


def _typed_documents(spark, d):
    """The born-digital documents of ``doc_lines`` and those of the derived pages, which are of each type in turn."""
    derived = table(spark, d, "documents").filter("doc_id IS NOT NULL").selectExpr("concat('d:', cast(doc_id AS string)) AS doc_id", "CASE doc_id % 3 WHEN 0 THEN 'code' WHEN 1 THEN 'rescrits' ELSE 'generic' END AS doc_type", "1 AS first_page").distinct()
    return pipeline.documents_of(table(spark, d, "documents_meta").filter("ocr IS NULL")).unionByName(derived)


def _extracted(spark, d):
    return pipeline.extract(_all_lines(spark, d), _typed_documents(spark, d))


def _read(spark, d):
    return pipeline.read(_all_lines(spark, d), _typed_documents(spark, d))


def raw_markdown(spark, d):
    return _extracted(spark, d).raw


def note_links(spark, d):
    return _read(spark, d).links.select("doc_id", "ix", "pos", "num", "page", "def_page", "fid", F.md5("text").alias("digest"))


def orphan_notes(spark, d):
    return _read(spark, d).orphans


def unresolved_markers(spark, d):
    return rawmd.unresolved(_read(spark, d).links)


def extraction_report(spark, d):
    r = sinks.extract_report(_extracted(spark, d))
    return r.select("doc_id", "n_pages", "small_lines_returned", "n_orphan_notes", "n_headings", "n_articles", "n_rescrits", F.to_json("dropped_lines").alias("dropped"), F.to_json("footnote_detection").alias("detection"), F.size("page_map").alias("mapped"))


def span_markdown(spark, d):
    """Spans to raw Markdown: visual lines, superscript note markers, routing, builders."""
    lines = stored(layout.page_lines(table(spark, d, "spans")).withColumn("ix", F.col("page").cast("bigint") * 10_000 + F.col("ix")))
    return pipeline.extract(lines, pipeline.documents_of(table(spark, d, "documents_meta").filter("ocr IS NULL"))).raw


def stage_chunks(spark, d):
    """The three stages one after the other: extract, clean, chunk with page map and orphan notes; chunks of each document with what they carry."""
    got = _extracted(spark, d)
    meta = table(spark, d, "documents_meta").filter("ocr IS NULL").select("doc_id", "source_doc_id", "doc_type", "code", "version_year", "published", "source_url", "pdf_pages", "loaded_at")
    derived = table(spark, d, "documents").filter("doc_id IS NOT NULL").selectExpr("concat('d:', cast(doc_id AS string)) AS doc_id", "source_doc_id", "CASE doc_id % 3 WHEN 0 THEN 'code' WHEN 1 THEN 'rescrits' ELSE 'generic' END AS doc_type", "'CGI' AS code", "version_year", "CAST(NULL AS string) AS published", "CAST(NULL AS string) AS source_url", "CAST(NULL AS array<int>) AS pdf_pages", "loaded_at")
    meta = meta.withColumn("published", F.col("published").cast("string")).unionByName(derived)
    found = pipeline.chunk(stored(pipeline.clean(got.raw)), meta, pipeline.page_map(got.pages), got.orphans)[0]
    return found.select("chunk_id", "doc_id", "unit", "part", "n_parts", "page_start", "page_end", "printed_page_start", "printed_page_end", F.size("amended_by").alias("n_amended_by"), F.size("page_notes").alias("n_page_notes"), F.size("refs").alias("n_refs"), "n_chars", F.md5("text").alias("digest"))


def notes_balance(spark, d):
    return qa.notes_balance(_extracted(spark, d).raw)


def qa_flags(spark, d):
    return qa.flags(_md(spark, d))


def raw_vs_clean(spark, d):
    raw = _marked(spark, d)
    return qa.length_changes(raw, reflow.reflow(raw))


# -- layout and inspection

def line_statistics(spark, d):
    return _stats(spark, d, _all_lines)[1].select("doc_id", "n_pages", "body_size", "p95_len", "median_leading")


def repeated_margin_lines(spark, d):
    lines = _all_lines(spark, d)
    return layout.repeated_margin_lines(lines, layout.settings(lines))


def routed_lines(spark, d):
    lines, stats = _stats(spark, d, _all_lines)
    return layout.routed(lines, layout.settings(lines), stats).groupBy("doc_id", "route").agg(F.count(F.lit(1)).alias("n"))


def page_records(spark, d):
    lines, stats = _stats(spark, d, _all_lines)
    return layout.page_records(layout.routed(lines, layout.settings(lines), stats))


def page_footnotes(spark, d):
    lines, stats = _stats(spark, d, _all_lines)
    return layout.footnote_defs(layout.routed(lines, layout.settings(lines), stats))


def span_lines(spark, d):
    return layout.page_lines(table(spark, d, "spans")).select("doc_id", "page", "ix", "text", F.round("x0", 3).alias("x0"), "size", "bold")


def text_per_page(spark, d):
    return inspect.text_per_page(_all_lines(spark, d)).select("doc_id", "pages", "min_chars", "scan", "skip")


def font_sizes(spark, d):
    return inspect.font_sizes(_all_lines(spark, d)).select("doc_id", "rank", "size", "chars")


def number_positions(spark, d):
    return inspect.number_positions(_all_lines(spark, d))


def small_foot_lines(spark, d):
    return inspect.small_foot_lines(*_stats(spark, d, _all_lines))


def two_column_ratio(spark, d):
    widths = table(spark, d, "spans").select("doc_id", "page", "page_w").dropna()
    return inspect.two_columns(*_stats(spark, d, _all_lines), widths)


def foot_samples(spark, d):
    return inspect.foot_samples(*_stats(spark, d, _all_lines))


def code_title_pages(spark, d):
    return inspect.code_title_pages(_all_lines(spark, d))


def large_gaps(spark, d):
    return inspect.large_gaps(*_stats(spark, d, _all_lines))


def headings_by_kind(spark, d):
    return inspect.headings_by_kind(_all_lines(spark, d))


def numbering_resets(spark, d):
    return inspect.numbering_resets(_all_lines(spark, d))


def contents_pages(spark, d):
    return inspect.contents_pages(_all_lines(spark, d))


def ruling_continuity(spark, d):
    return inspect.rulings(_all_lines(spark, d))


# -- extraction, cleaning, chunking

def article_order(spark, d):
    return rawmd.article_order(_all_lines(spark, d))


def reflowed_lines(spark, d):
    return reflow.reflow(_text_lines(spark, d))


def line_length_p95(spark, d):
    return reflow.line_length_p95(_text_lines(spark, d))


def clean_events(spark, d):
    e = reflow.clean_events(_noisy_lines(spark, d))
    return e.groupBy("doc_id", "key").agg(F.sum("n").alias("n"))


def cleaned_lines(spark, d):
    """Cleaning by document: every fifth is structured Markdown already, every third knows its line length."""
    meta = table(spark, d, "documents").filter("doc_id IS NOT NULL").selectExpr("doc_id", "doc_id % 5 = 0 AS structured_markdown", "CASE WHEN doc_id % 3 = 0 THEN 70 ELSE 0 END AS p95_len")
    return reflow.clean(_noisy_lines(spark, d), meta)


def event_samples(spark, d):
    return qa.sampled(reflow.clean_events(_noisy_lines(spark, d)).filter("sample IS NOT NULL"), ["seq", "sample"]).select("doc_id", "key", "seq", "n", "sample")


def legal_units(spark, d):
    u = units.units(_marked(spark, d), pipeline.documents_of(_documents(spark, d)))
    return u.select("doc_id", "unit_ix", "kind", "key", "title", F.array_join(F.transform("hier", lambda h: h["v"]), " > ").alias("hierarchy"), F.length("text").alias("n_chars"), F.md5("text").alias("digest"), "page_start", "page_end")


def _chunked(spark, d):
    return pipeline.chunk(_marked(spark, d), _documents(spark, d))


def legal_chunks(spark, d):
    c = _chunked(spark, d)[0]
    return c.select("chunk_id", "doc_id", "unit", "article", "part", "n_parts", "page_start", "page_end", "context", "n_chars", "tokens_est", F.size("refs").alias("n_refs"), F.md5("text").alias("digest"))


def chunk_stats(spark, d):
    return chunks.chunk_stats(*_chunked(spark, d))


def outside_lines(spark, d):
    return units.outside_lines(_marked(spark, d), pipeline.documents_of(_documents(spark, d)))


def split_documents(spark, d):
    p = table(spark, d, "documents").select("doc_id", F.posexplode(pack.split_text(F.col("text"))).alias("part", "text"))
    return p.select("doc_id", "part", F.length("text").alias("n"), F.md5("text").alias("digest"))


def chunk_sizes(spark, d):
    c = table(spark, d, "chunks").select("chunk_id", "doc_type", "text").distinct()
    n = F.length("text")
    return c.groupBy("doc_type").agg(F.count(F.lit(1)).alias("n"), F.min(n).alias("min_chars"), F.percentile(n, F.lit(0.5)).cast("bigint").alias("median_chars"), F.max(n).alias("max_chars"), F.count_if(n > 3750).alias("over"))


def chunk_id_duplicates(spark, d):
    u = table(spark, d, "units").select("doc_id", "unit_ix", "kind", F.coalesce("unit_key", F.lit("")).alias("key"), F.coalesce("title", F.lit("")).alias("title"), "text").distinct().groupBy("doc_id", "unit_ix").agg(F.min(F.struct("kind", "key", "title")).alias("_u")).select("doc_id", "unit_ix", "_u.*")
    return chunks.with_ids(u.withColumn("parts", F.array(F.lit("x")))).select("doc_id", "unit_ix", "uid")


def page_range_notes(spark, d):
    u = table(spark, d, "units").filter("page_start IS NOT NULL AND page_end IS NOT NULL").groupBy("doc_id", "unit_ix").agg(F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.flatten(F.collect_set(F.coalesce("footnotes", F.array().cast("array<struct<id:string,text:string>>")))).alias("footnotes"))
    n = chunks.page_notes(u, table(spark, d, "footnote_defs").filter("text IS NOT NULL"))
    return n.select("doc_id", "unit_ix", F.size("page_notes").alias("n"))


def unit_contexts(spark, d):
    """The context of each unit of every kind, with its document's label."""
    u = table(spark, d, "units").select("doc_id", "unit_ix", F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("unit_key", F.lit("")).alias("key"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("hier", F.array().cast("array<struct<k:string,v:string>>")).alias("hier")).distinct()
    m = table(spark, d, "documents_meta").groupBy("doc_id").agg(F.max(F.struct("loaded_at", "doc_type", "code", "version_year")).alias("_m")).select("doc_id", "_m.doc_type", "_m.code", "_m.version_year")
    label = chunks.doc_label(F.col("doc_type"), F.col("code"), F.col("version_year"), F.col("doc_id"))
    return u.join(m, "doc_id", "left").select("doc_id", "unit_ix", "kind", chunks.build_context(label, F.col("kind"), F.col("key"), F.col("title"), F.col("hier"), F.lit(0), F.lit(1)).alias("context"))


def all_unit_contexts(spark, d):
    """The context of each part of each unit, of every kind, with its document's label; a unit without a text has one part."""
    u = table(spark, d, "units").select("doc_id", "unit_ix", F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("unit_key", F.lit("")).alias("key"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("hier", F.array().cast("array<struct<k:string,v:string>>")).alias("hier"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    m = table(spark, d, "documents_meta").groupBy("doc_id").agg(F.max(F.struct("loaded_at", "doc_type", "code", "version_year")).alias("_m")).select("doc_id", "_m.doc_type", "_m.code", "_m.version_year")
    u = u.withColumn("parts", pack.split_text(F.col("text"))).join(m, "doc_id", "left")
    u = u.select("*", F.greatest(F.size("parts"), F.lit(1)).alias("n_parts"), F.posexplode_outer("parts").alias("_part", "_text")).withColumn("part", F.coalesce("_part", F.lit(0)))
    label = chunks.doc_label(F.col("doc_type"), F.col("code"), F.col("version_year"), F.col("doc_id"))
    return u.select("doc_id", "unit_ix", "kind", "part", "n_parts", chunks.build_context(label, F.col("kind"), F.col("key"), F.col("title"), F.col("hier"), F.col("part"), F.col("n_parts")).alias("context"))


def _ocr_pages(spark, d):
    scans = table(spark, d, "documents_meta").filter("ocr IS NOT NULL").select("doc_id").distinct()
    lines = _lines(spark, d).join(scans, "doc_id", "left_semi")
    return lines.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ix", "text"))), lambda x: x["text"]), "\n").alias("markdown"))


def ocr_page_report(spark, d):
    return ocr.page_report(_ocr_pages(spark, d))


def ocr_figures(spark, d):
    return ocr.figure_lines(_ocr_pages(spark, d))


def ocr_raw_lines(spark, d):
    return ocr.raw_lines(_ocr_pages(spark, d))


QUERIES = {f.__name__: f for f in (
    heading_lines, heading_levels, heading_stack, article_lines, article_sort_keys, line_flags, glued_markers, bracket_rows, cross_reference_edges, references_by_target, law_notes,
    normalized_text, fixed_text, bullets, plain_text, hyphen_decisions, title_words, article_numbers, duplicate_articles, missing_article_numbers, article_order_violations,
    article_lengths, article_length_stats, longest_articles, markdown_headings, marks_and_characters, notes_balance, qa_flags, raw_vs_clean, line_statistics, repeated_margin_lines,
    routed_lines, page_records, page_footnotes, span_lines, text_per_page, font_sizes, number_positions, small_foot_lines, two_column_ratio, large_gaps, headings_by_kind,
    numbering_resets, contents_pages, ruling_continuity, article_order, raw_markdown, span_markdown, note_links, orphan_notes, unresolved_markers, extraction_report, stage_chunks, reflowed_lines, cleaned_lines, line_length_p95, clean_events, event_samples, foot_samples, code_title_pages, legal_units, legal_chunks,
    chunk_stats, outside_lines, split_documents, chunk_sizes, chunk_id_duplicates, page_range_notes, unit_contexts, all_unit_contexts, ocr_page_report, ocr_figures, ocr_raw_lines,
)}



def _re2(pattern: str) -> str:
    """A pattern of the library as a DuckDB literal."""
    flags = re.match(r"^\(\?[a-zA-Z]+\)", pattern)
    body = pattern[flags.end() :] if flags else pattern
    if flags and "U" in flags[0]:
        # Unicode white space and digits, inside and outside of brackets
        out, inside, i = [], False, 0
        while i < len(body):
            two = body[i : i + 2]
            wide = {"\\s": "\\s\\p{Z}", "\\d": "\\p{Nd}"}.get(two)
            if wide:
                out.append(wide if inside else f"[{wide}]")
            elif two[0] == "\\":
                out.append(two)
            else:
                inside = {"[": True, "]": False}.get(two[0], inside)
                out.append(two[0])
            i += 2 if two[0] == "\\" else 1
        body = "".join(out)
    return "'" + ("(?i)" if flags and "i" in flags[0] else "") + body.replace("\\uf0b7", "").replace("'", "''") + "'"


_T = "t AS (SELECT doc_id, unnest(range(len(p))) AS seq, unnest(p) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL))"
_S = lambda c: f"regexp_replace({c}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"
_L = (
    "l AS (SELECT doc_id, page, seq AS ix, text, x0, y0, x1, y1, size, bold, gap_before, page_h FROM doc_lines WHERE doc_id IS NOT NULL AND seq IS NOT NULL AND trim(text) <> '' "
    "QUALIFY row_number() OVER (PARTITION BY doc_id, seq ORDER BY page NULLS FIRST, text, y0 NULLS FIRST, x0 NULLS FIRST) = 1)"
)
_SQL = {"S": "VARCHAR", "div": "//"}
#: ``doc_lines`` and the derived pages.
_LL = _L.replace("l AS (", "l0 AS (") + (
    f", w AS (SELECT doc_id, unnest(range(len(p))) AS seq, unnest(p) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL)), "
    f"l AS (FROM l0 UNION ALL SELECT 'd:' || doc_id, CAST(seq // 10 + 1 AS INTEGER), seq, {_DERIVED.format(**_SQL)}, 60.0, {_DERIVED_Y}, 260.0, {_DERIVED_Y} + 10, CASE WHEN seq % 10 = 8 THEN 8.0 ELSE 11.0 END, seq % 10 = 1, CASE WHEN seq % 10 = 6 THEN 30.0 ELSE 14.0 END, 842.0 FROM w WHERE trim(line) <> '')"
)
#: Statistics of documents.
_STATS = f"""{_LL}, c AS (SELECT *, (y0 + y1) / 2 AS cy FROM l), np AS (SELECT doc_id, max(page) AS n_pages FROM l GROUP BY doc_id),
body AS (SELECT doc_id, s FROM (SELECT doc_id, round_even(size, 1) AS s, sum(length(text)) AS n, min(ix) AS f FROM l WHERE size IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) = 1),
bs AS (SELECT doc_id, n_pages, coalesce(s, 10.0) AS body_size FROM np LEFT JOIN body USING (doc_id)),
inn AS (SELECT c.*, body_size FROM c JOIN bs USING (doc_id) WHERE abs(size - body_size) <= 0.6 AND cy > CAST(0.08 AS DOUBLE) * page_h AND cy < CAST(0.92 AS DOUBLE) * page_h),
len95 AS (SELECT doc_id, list_sort(list(length(text))) AS v FROM inn GROUP BY doc_id), med AS (SELECT doc_id, median(gap_before) AS m FROM inn WHERE gap_before > 0 AND gap_before < 3 * body_size GROUP BY doc_id),
st AS (SELECT doc_id, n_pages, body_size, coalesce(CAST(v[1 + CAST(floor(0.95 * (len(v) - 1)) AS INTEGER)] AS DOUBLE), 80.0) AS p95_len, coalesce(m, body_size * 1.2) AS median_leading FROM bs LEFT JOIN len95 USING (doc_id) LEFT JOIN med USING (doc_id))"""
_KIND = "(?:Loi|Ordonnance|D[ée]cret|Arr[êe]t[ée]|Directive|R[èe]glement)"
_DIGITS = "'^\\s*[0-9]{1,4}\\s*$'"
#: Lines with their route.
_ROUTED = f"""{_STATS}, g AS (SELECT c.*, body_size, coalesce(cy < CAST(0.08 AS DOUBLE) * c.page_h OR cy > CAST(0.92 AS DOUBLE) * c.page_h, false) AS mar, lower(regexp_replace(regexp_replace(text, '[\\s\\p{{Z}}]+', ' ', 'g'), '^ | $', '', 'g')) AS nk,
 regexp_matches(text, {_DIGITS}) AS dig, cy > CAST(0.8 AS DOUBLE) * c.page_h AS low, size <= CAST(0.92 AS DOUBLE) * body_size AS tiny, trim(text) AS tx FROM c JOIN st USING (doc_id)),
rep AS (SELECT doc_id, nk FROM g JOIN np USING (doc_id) WHERE mar AND NOT dig GROUP BY doc_id, nk, n_pages HAVING n_pages >= 4 AND count(*) >= greatest(3, floor(0.25 * n_pages))),
r1 AS (SELECT g.*, CASE WHEN mar AND dig THEN 'page_number' WHEN mar AND rep.nk IS NOT NULL THEN 'running_header_footer' WHEN low AND tiny THEN 'foot' ELSE 'body' END AS r FROM g LEFT JOIN rep USING (doc_id, nk)),
r2 AS (SELECT *, min(CASE WHEN r = 'foot' AND regexp_matches(tx, '^(?:\\{{\\{{fn:[0-9]+\\}}\\}}|[0-9]{{1,3}}$|[0-9]{{1,3}}\\s*{_KIND}|(?:Loi|Ordonnance|D[ée]cret|Arr[êe]t[ée])\\s+N°)') THEN ix END) OVER (PARTITION BY doc_id, page) AS lab FROM r1),
r3 AS (SELECT * REPLACE (CASE WHEN r = 'foot' AND (lab IS NULL OR ix < lab) THEN 'body' ELSE r END AS r), coalesce(r = 'foot' AND (lab IS NULL OR ix < lab), false) AS reclaimed FROM r2),
r4 AS (SELECT *, first_value(CASE WHEN r = 'body' THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id, page ORDER BY ix ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM r3),
r5 AS (SELECT *, max(CASE WHEN r = 'foot' THEN 1 ELSE 0 END) OVER p = 1 AS geo, min(CASE WHEN r = 'body' AND low AND ((dig AND coalesce(regexp_matches(nxt, '^{_KIND}'), false)) OR regexp_matches(text, '^\\{{\\{{fn:[0-9]+\\}}\\}}\\s*{_KIND}')) THEN ix END) OVER p AS since FROM r4 WINDOW p AS (PARTITION BY doc_id, page)),
rt AS (SELECT *, CASE WHEN NOT geo AND r = 'body' AND ix >= since THEN 'foot' ELSE r END AS route, CASE WHEN geo THEN 'geometry' WHEN since IS NOT NULL THEN 'text' ELSE 'none' END AS footnote_method FROM r5)"""
_NUM = "CASE WHEN regexp_matches(tx, '^\\{\\{fn:[0-9]+\\}\\}') THEN regexp_extract(tx, '^\\{\\{fn:([0-9]+)', 1) WHEN dig THEN tx WHEN regexp_matches(tx, '^[0-9]{1,2}\\s+" + _KIND + "') THEN regexp_extract(tx, '^([0-9]{1,2})', 1) END"
_PIECE = "CASE WHEN regexp_matches(tx, '^\\{\\{fn:[0-9]+\\}\\}') THEN trim(regexp_replace(tx, '^\\{\\{fn:[0-9]+\\}\\}\\s*', '')) WHEN dig THEN '' WHEN regexp_matches(tx, '^[0-9]{1,2}\\s+" + _KIND + "') THEN regexp_replace(tx, '^[0-9]{1,2}\\s+', '') ELSE tx END"
_DEFS = f"""{_ROUTED}, ft AS (SELECT doc_id, page, ix, {_PIECE} AS piece, last_value(CAST({_NUM} AS INTEGER) IGNORE NULLS) OVER (PARTITION BY doc_id, page ORDER BY ix) AS num FROM rt WHERE route = 'foot'),
df AS (SELECT doc_id, page, num, trim(regexp_replace(coalesce(string_agg(piece, ' ' ORDER BY ix) FILTER (piece <> ''), ''), '\\{{\\{{fn:([0-9]+)\\}}\\}}', '', 'g')) AS text FROM ft WHERE num IS NOT NULL GROUP BY ALL)"""
#: Only documents whose marked numbers are unique, so that no marker competes for a page's note.
_LINKS = f"""{_DEFS}, docs AS (SELECT DISTINCT doc_id FROM documents_meta WHERE ocr IS NULL UNION SELECT 'd:' || doc_id FROM documents WHERE doc_id IS NOT NULL), mk AS (SELECT doc_id, page, CAST(page AS BIGINT) * 1000000 + ix % 1000000 AS ix, unnest(range(len(m))) AS pos, CAST(unnest(m) AS INTEGER) AS num FROM (SELECT *, regexp_extract_all(text, '\\{{\\{{fn:([0-9]+)\\}}\\}}', 1) AS m FROM rt WHERE route = 'body' AND doc_id IN (FROM docs))),
nd AS (SELECT doc_id, num, any_value(page) AS def_page, any_value(text) AS note FROM df WHERE doc_id IN (FROM docs) GROUP BY ALL),
lk AS (SELECT mk.*, CASE WHEN row_number() OVER (PARTITION BY doc_id, num ORDER BY ix, pos) = 1 THEN def_page END AS def_page, CASE WHEN row_number() OVER (PARTITION BY doc_id, num ORDER BY ix, pos) = 1 THEN note END AS note FROM mk LEFT JOIN nd USING (doc_id, num)),
ln AS (SELECT *, CASE WHEN def_page IS NOT NULL THEN 'fn' || count(def_page) OVER (PARTITION BY doc_id ORDER BY ix, pos) END AS fid FROM lk)"""
_ART2 = _re2(P.ARTICLE_START.replace(r"\s*(?::|[.\-–](?=\s))\s*(.*)$", r"\s*(?::\s*|[.\-–]\s+)(.*)$"))


def _aid(c: str) -> str:
    low = f"replace(lower({_S(c)}), ' ', '')"
    return f"(CASE WHEN {low} IN ('premier', '1er') THEN '1' ELSE {low} END)"


def _heading_cases(c: str, what: str) -> str:
    parts = []
    for k, (kind, pat) in enumerate(zip(P.LEVELS, P.HEADINGS, strict=True)):
        value = {"level": str(k + 1), "kind": f"'{kind}'", "num": f"regexp_extract({c}, {_re2(pat)}, 1)", "title": _S(f"regexp_extract({c}, {_re2(pat)}, 2)")}[what]
        parts.append(f"WHEN regexp_matches({c}, {_re2(pat)}) THEN {value}")
    return "CASE " + " ".join(parts) + " END"


_H = f"{_T}, s AS (SELECT doc_id, seq, {_S('text')} AS c FROM t), h AS (SELECT doc_id, seq, {_heading_cases('c', 'level')} AS level, {_heading_cases('c', 'kind')} AS kind, {_heading_cases('c', 'num')} AS num, {_heading_cases('c', 'title')} AS title FROM s)"
_A = f"{_T}, s AS (SELECT doc_id, seq, {_S('text')} AS c FROM t), a AS (SELECT doc_id, seq, {_aid(f'regexp_extract(c, {_ART2}, 1)')} AS id, {_S(f'regexp_extract(c, {_ART2}, 2)')} AS rest FROM s WHERE regexp_matches(c, {_ART2}))"
_RANK = "CASE sfx " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in P.LATIN_RANK.items()) + " WHEN '' THEN 0 ELSE 99 END"
_KEY = f"(SELECT struct_pack(n := CASE WHEN num = '' THEN 1000000 ELSE CAST(num AS INTEGER) END, rank := CASE WHEN num = '' THEN 0 ELSE {_RANK} END, suffix := CASE WHEN num = '' THEN id ELSE sfx END) FROM (SELECT regexp_extract(id, '^(\\d+)', 1) AS num, lower(regexp_replace(regexp_extract(id, '^\\d+(.*)$', 1), '^-+|-+$', '', 'g')) AS sfx))"
_REFS = f"regexp_extract_all(text, {_re2(P.REFERENCE)}, 1)"
_EDGES = f"""{_T}, r AS (SELECT doc_id, seq, unnest(range(len({_REFS}))) AS pos, unnest({_REFS}) AS nums, lower(replace(unnest(regexp_extract_all(text, {_re2(P.REFERENCE)}, 2)), '.', '')) AS tg FROM t),
e AS (SELECT doc_id, seq, pos, CASE WHEN tg IN ('présent code', 'present code', 'présent livre', 'present livre') THEN 'self' WHEN tg IN ('cgi', 'code général des impôts') THEN 'CGI' WHEN tg IN ('lpf', 'livre des procédures fiscales') THEN 'LPF' WHEN tg <> '' THEN tg ELSE 'non précisé' END AS target,
 regexp_matches(nums, '(?:^|[^a-zà])(?:à|au)(?:[^a-zà]|$)') AS is_range, unnest(regexp_extract_all(nums, '(?i){P._ART}')) AS article FROM r)"""
_PLACE = "regexp_replace(text, ' à [A-Z]\\p{L}+$', '')"
_BR = f"{_L}, c AS (SELECT doc_id, ix AS seq, {_S(_PLACE)} AS c FROM l)"
_TIDY = lambda x: _S(f"regexp_replace({x}, '[\\s\\p{{Z}}]+', ' ', 'g')")
_N = f"{_A}, n AS (SELECT doc_id, seq, id, CAST(nullif(regexp_extract(id, '^([0-9]+)', 1), '') AS BIGINT) AS n FROM a)"
_LEN = f"{_A}, ln AS (SELECT t.doc_id, t.seq, CASE WHEN a.id IS NOT NULL THEN a.rest WHEN h.level IS NOT NULL THEN repeat('#', h.level) || ' ' || t.text ELSE t.text END AS text, CASE WHEN a.id IS NOT NULL THEN t.seq END AS start, a.id FROM t LEFT JOIN a USING (doc_id, seq) LEFT JOIN (SELECT doc_id, seq, {_heading_cases('c', 'level')} AS level FROM s) h USING (doc_id, seq)), sec AS (SELECT doc_id, text, last_value(start IGNORE NULLS) OVER w AS seq, last_value(id IGNORE NULLS) OVER w AS id FROM ln WINDOW w AS (PARTITION BY doc_id ORDER BY seq)), len AS (SELECT doc_id, seq, id, CAST(sum(length(text) + 1) AS BIGINT) AS chars FROM sec WHERE seq IS NOT NULL GROUP BY ALL)"
_LA = f"{_LL}, a AS (SELECT doc_id, ix, page, {_aid(f'regexp_extract({_S('text')}, {_ART2}, 1)')} AS id FROM l WHERE regexp_matches({_S('text')}, {_ART2}))"
_FLAGS = {"is_list": P.LIST_START, "is_sub": P.SUBHEADING, "is_ruling": P.RULING_START, "is_digits": P.DIGITS_ONLY, "is_legal": P.LEGAL_START, "is_punct": P.LONE_PUNCT, "is_caption": P.TABLE_CAPTION}

def _let(value: str, name: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _packed(items: str, sep: str, limit: int, v: str) -> str:
    """Greedy packing in SQL; ``v`` makes the names of nested packings differ."""
    start = f"list_prepend({{'o': CAST([] AS VARCHAR[]), 'c': ''}}, list_transform({items}, lambda i_{v}: {{'o': CAST([] AS VARCHAR[]), 'c': i_{v}}}))"
    step = f"CASE WHEN a_{v}.c <> '' AND length(a_{v}.c) + {len(sep)} + length(x_{v}.c) > {limit} THEN {{'o': list_append(a_{v}.o, a_{v}.c), 'c': x_{v}.c}} ELSE {{'o': a_{v}.o, 'c': CASE WHEN a_{v}.c = '' THEN x_{v}.c ELSE a_{v}.c || {_chars(sep)} || x_{v}.c END}} END"
    return _let(f"list_reduce({start}, lambda a_{v}, x_{v}: {step})", f"r_{v}", f"CASE WHEN r_{v}.c <> '' THEN list_append(r_{v}.o, r_{v}.c) ELSE r_{v}.o END")


def _chars(text: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in text)


def _cut(items: str, limit: int, by: str, v: str) -> str:
    return f"flatten(list_transform({items}, lambda {v}: CASE WHEN length({v}) <= {limit} THEN [{v}] ELSE {by} END))"


def _split_sql(text: str, limit: int = 3000, least: int = 250) -> str:
    """The ladder of splits in SQL (no text of the tables begins with a table)."""
    at = f"CASE WHEN contains(left(h1.c, {limit}), ' ') THEN {limit} - strpos(reverse(left(h1.c, {limit})), ' ') ELSE -1 END"
    place = f"CASE WHEN {at} < {limit // 2} THEN {limit} ELSE {at} END"
    step = f"CASE WHEN length(h1.c) > {limit} THEN {{'o': list_append(h1.o, {_S(f'left(h1.c, {place})')}), 'c': {_S(f'substr(h1.c, {place} + 1)')}}} ELSE h1 END"
    hard = _let(f"list_reduce(list_prepend({{'o': CAST([] AS VARCHAR[]), 'c': s1}}, list_transform(range(length(s1) // {limit // 2} + 2), lambda q1: {{'o': CAST([] AS VARCHAR[]), 'c': ''}})), lambda h1, h2: {step})", "h3", "CASE WHEN h3.c <> '' THEN list_append(h3.o, h3.c) ELSE h3.o END")
    pieces = lambda t: f"string_split(regexp_replace({t}, '([.;:!?])[\\s\\p{{Z}}]+([«(\"A-ZÀ-ÖØ-Þ0-9-])', '\\1' || chr(1) || '\\2', 'g'), chr(1))"
    of_line = _packed(_cut(pieces("l1"), limit, hard, "s1"), " ", limit, "p")
    of_block = _packed(_cut("string_split(b1, chr(10))", limit, of_line, "l1"), chr(10), limit, "n")
    one_line = of_line.replace("l1", "b1")
    blocks = f"list_filter(list_transform(regexp_split_to_array({text}, '\\n[\\s\\p{{Z}}]*\\n'), lambda w: regexp_replace(w, '^\\n+|\\n+$', '', 'g')), lambda w: {_S('w')} <> '')"
    parts = _packed(_cut(blocks, limit, f"CASE WHEN contains(b1, chr(10)) THEN {of_block} ELSE {one_line} END", "b1"), chr(10) * 2, limit, "z")
    tail = _let(parts, "f", f"CASE WHEN len(f) > 1 AND length(f[-1]) < {least} AND length(f[-2]) + 2 + length(f[-1]) <= {limit * 1.25} THEN list_append(f[:-3], f[-2] || chr(10) || chr(10) || f[-1]) ELSE f END")
    return f"CASE WHEN length({text}) <= {limit} THEN CASE WHEN {_S(text)} <> '' THEN [array_to_string({blocks}, chr(10) || chr(10))] ELSE [] END ELSE {tail} END"


_IN = lambda words: "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"
_MD = f"{_A}, md AS (SELECT t.doc_id, t.seq, CASE WHEN a.id IS NOT NULL THEN '<!--art:' || a.id || '-->' || a.rest WHEN h.level IS NOT NULL THEN repeat('#', h.level) || ' ' || t.text ELSE t.text END AS text FROM t LEFT JOIN a USING (doc_id, seq) LEFT JOIN (SELECT doc_id, seq, {_heading_cases('c', 'level')} AS level FROM s) h USING (doc_id, seq))"
_TITLED = "array_to_string(list_transform(regexp_extract_all({0}, '\\p{{L}}+|\\P{{L}}+'), lambda w: upper(w[1]) || lower(w[2:])), '')"
_LABEL = f"CASE WHEN doc_type = 'code' THEN concat_ws(' ', nullif(code, ''), CASE WHEN version_year <> 0 THEN CAST(version_year AS VARCHAR) END) WHEN doc_type = 'rescrits' THEN 'Rescrits fiscaux' ELSE {_TITLED.format(chr(40) + 'replace(split_part(doc_id, ' + chr(39) + '__' + chr(39) + ', 1), ' + chr(39) + '_' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ')' + chr(41))} END"
_CTX = f"""mt AS (SELECT doc_id, m.doc_type AS doc_type, m.code AS code, m.version_year AS version_year FROM (SELECT doc_id, max(struct_pack(l := loaded_at, doc_type := doc_type, code := code, version_year := version_year)) AS m FROM documents_meta GROUP BY doc_id)),
u AS (SELECT DISTINCT doc_id, unit_ix, coalesce(kind, '') AS kind, coalesce(unit_key, '') AS key, coalesce(title, '') AS title, coalesce(hier, []) AS hier, coalesce(text, '') AS text FROM units),
cx AS (SELECT u.*, concat_ws(' | ', nullif({_LABEL}, ''), nullif(array_to_string(list_transform(hier, lambda h: h.v), ' > '), ''), nullif(CASE kind WHEN 'article' THEN 'Art. ' || key WHEN 'rescrit' THEN 'R' || key || ' : ' || title ELSE title END, '')) AS context FROM u LEFT JOIN mt USING (doc_id))"""
_OCR = f"{_L}, sc AS (SELECT DISTINCT doc_id FROM documents_meta WHERE ocr IS NOT NULL), raw0 AS (SELECT doc_id, page, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY ix, text) - 1 AS INTEGER) AS line_no, text FROM l WHERE doc_id IN (FROM sc)), ol AS (SELECT doc_id, page, line_no, regexp_replace(regexp_replace(regexp_replace(text, '[\\s\\p{{Z}}]+$', ''), '(?i)\\[?\\bicon\\s*:\\s*[^\\]\\n]*\\]?\\s*', '', 'g'), '[\\s\\p{{Z}}]+$', '') AS tx FROM raw0), od AS (SELECT *, regexp_matches({_S('tx')}, '(?i)^(?:logo|photo|figure|image)\\s*:\\s*.*$') AS gone FROM ol)"
#: Units of the marked lines of ``documents``.
_UNITS = f"""{_A}, hd AS (SELECT doc_id, seq, {_heading_cases('c', 'level')} AS level FROM s), dt AS (SELECT doc_id, coalesce(any_value(doc_type), 'generic') AS dt FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id),
m0 AS (SELECT t.doc_id, t.seq * 2 AS q, CASE WHEN a.id IS NOT NULL THEN '<!--art:' || a.id || '-->' WHEN hd.level IS NOT NULL THEN repeat('#', hd.level) || ' ' || t.text ELSE t.text END AS text FROM t LEFT JOIN a USING (doc_id, seq) LEFT JOIN hd USING (doc_id, seq) UNION ALL SELECT doc_id, seq * 2 + 1, '**Art. ' || id || ' :** ' || rest FROM a),
m1 AS (SELECT m0.*, dt, {_S('m0.text')} AS c FROM m0 JOIN dt USING (doc_id)),
m2 AS (SELECT *, length(regexp_extract(c, '^(#{{1,6}})[\\s\\p{{Z}}]+.*\\S', 1)) AS hl, {_S("regexp_extract(c, '^#{1,6}[\\s\\p{Z}]+(.*)$', 1)")} AS ht, {_S("regexp_extract(c, '^\\*\\*(.+?)\\*\\*$', 1)")} AS bd, regexp_matches(c, '^\\*\\*.+?\\*\\*$') AS isb FROM m1),
m3 AS (SELECT *, CASE WHEN c = '' THEN 'blank' WHEN hl > 0 THEN CASE WHEN dt = 'rescrits' AND hl >= 2 AND regexp_matches(ht, '^R[\\s\\p{{Z}}]?[0-9]{{1,3}}[\\s\\p{{Z}}]*[:–-][\\s\\p{{Z}}]*.+$') THEN 'ruling' ELSE 'heading' END WHEN dt = 'code' AND regexp_matches(c, '^<!--art:[^ >]+-->$') THEN 'article'
 WHEN dt = 'code' AND isb AND regexp_matches(bd, '^(?:I{{1,3}}|IV|VI{{0,3}}|IX|X|[A-H])\\s*[-–—]\\s*\\S.{{2,90}}$') THEN 'sub' WHEN dt NOT IN ('code', 'rescrits') AND isb THEN 'bold' ELSE 'text' END AS role FROM m2),
m4 AS (SELECT *, role IN ('article', 'ruling', 'bold') OR (role = 'heading' AND dt NOT IN ('code', 'rescrits')) AS op, role = 'sub' OR (role = 'heading' AND dt IN ('code', 'rescrits')) AS cl, CASE WHEN role = 'heading' THEN hl END AS lv, CASE WHEN role IN ('heading', 'ruling') THEN ht WHEN role IN ('sub', 'bold') THEN bd END AS tt FROM m3),
m5 AS (SELECT *, dt NOT IN ('code', 'rescrits') AND role = 'text' AND coalesce(count_if(op OR cl) OVER w, 0) = 0 AS loose FROM m4 WINDOW w AS (PARTITION BY doc_id ORDER BY q)),
m6 AS (SELECT *, op OR (loose AND count_if(loose) OVER w = 1) AS op2 FROM m5 WINDOW w AS (PARTITION BY doc_id ORDER BY q)),
m7 AS (SELECT *, count_if(op2 OR cl) OVER w AS un, last_value(CASE WHEN op2 OR cl THEN op2 END IGNORE NULLS) OVER w AS isop, {", ".join(f"max(CASE WHEN lv = {k} THEN q END) OVER w AS s{k}, max(CASE WHEN lv < {k} THEN q END) OVER w AS r{k}, last_value(CASE WHEN lv = {k} THEN tt END IGNORE NULLS) OVER w AS v{k}" for k in range(1, 7))},
 max(CASE WHEN role = 'sub' THEN q END) OVER w AS ss, max(CASE WHEN role = 'heading' THEN q END) OVER w AS sr, last_value(CASE WHEN role = 'sub' THEN tt END IGNORE NULLS) OVER w AS sv FROM m6 WINDOW w AS (PARTITION BY doc_id ORDER BY q)),
ua AS (SELECT doc_id, un, min(CASE WHEN op2 THEN q END) AS q, string_agg(CASE WHEN role = 'text' THEN regexp_replace(text, '[\\s\\p{{Z}}]+$', '') WHEN role = 'blank' THEN '' END, chr(10) ORDER BY q) AS body FROM m7 WHERE isop GROUP BY ALL),
uh AS (SELECT doc_id, un, CASE role WHEN 'article' THEN 'article' WHEN 'ruling' THEN 'rescrit' ELSE 'section' END AS kind, CASE role WHEN 'article' THEN regexp_extract(c, 'art:([^ >]+)-->', 1) WHEN 'ruling' THEN regexp_extract(ht, '^R\\s?([0-9]{{1,3}})', 1) ELSE '' END AS key,
 CASE role WHEN 'ruling' THEN {_S("regexp_extract(ht, '^R\\s?[0-9]{1,3}\\s*[:–-]\\s*(.+)$', 1)")} WHEN 'bold' THEN tt ELSE '' END AS title, concat_ws(' > ', {", ".join(f"CASE WHEN s{k} > coalesce(r{k}, -1) THEN v{k} END" for k in range(1, 7))}, CASE WHEN ss > coalesce(sr, -1) THEN sv END) AS hierarchy FROM m7 WHERE op2),
uu AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY q) - 1 AS INTEGER) AS unit_ix, kind, key, title, hierarchy, {_S("regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(coalesce(body, ''), '**', ''), '<!--pg:[0-9]+-->', '', 'g'), '\\[\\^(fn[0-9]+)\\]', '', 'g'), '[ \\t]{2,}', ' ', 'g'), ' +\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")} AS text FROM ua JOIN uh USING (doc_id, un))"""

_B0, _B1 = "(^|[^\\p{L}\\p{N}_])", "($|[^\\p{L}\\p{N}_])"


def _fixed_sql(c: str) -> str:
    """The corrections of a paragraph in SQL; word bounds are spelled out, as \\b knows only ASCII there."""
    out = f"regexp_replace({c}, '(?i){_B0}ci(dessous|dessus|après|apres|joint|jointe|contre|annexé|annexée|avant){_B1}', '\\1ci-\\2\\3', 'g')"
    out = f"regexp_replace({out}, '(?i){_B0}(eux|elles|lui|elle|moi|soi|nous|vous|toi)(mêmes?){_B1}', '\\1\\2-\\3\\4', 'g')"
    out = f"regexp_replace({out}, '(?i){_B0}([0-9]+) (er|ère|ème|èmes|e)( (?:{P.MONTHS}|trimestre|alinéa|jour|janv))', '\\1\\2\\3\\4', 'g')"
    out = f"regexp_replace({out}, '[\\s\\p{{Z}}]+([,.])([\\s\\p{{Z}}]|$)', '\\1\\2', 'g')"
    out = f"regexp_replace(regexp_replace({out}, '\\([\\s\\p{{Z}}]+', '(', 'g'), '[\\s\\p{{Z}}]+\\)', ')', 'g')"
    return _S(f"regexp_replace({out}, ' {{2,}}', ' ', 'g')")


def _normal_sql(c: str) -> str:
    return "regexp_replace(regexp_replace(translate(" + "replace(" * len(T.LIGATURES) + f"nfc_normalize({c})" + "".join(f", '{k}', '{v}')" for k, v in T.LIGATURES.items()) + ", chr(160) || chr(8239) || chr(8201) || chr(8199) || '’‘ʼ' || chr(8203) || chr(8204) || chr(8205) || chr(65279) || chr(8288) || chr(173), '    '''''''), '[ \\t]+', ' ', 'g'), '[\\s\\p{Z}]+$', '')"


_KEEP = f"regexp_matches(split_part(x, ' ', 1), '^[\\p{{Lu}}0-9]') OR regexp_matches(a, '[0-9]-$') OR lower(regexp_extract(a, '([\\p{{L}}\\p{{N}}_'']+)-$', 1)) IN {_IN(T.KEEP_PREFIX)} OR lower(regexp_replace(split_part(x, ' ', 1), '^[.,;:)]+|[.,;:)]+$', '', 'g')) IN {_IN(T.KEEP_SUFFIX)}"
_JOIN = f"CASE WHEN regexp_matches(a, '[\\p{{L}}\\p{{N}}]-$') THEN CASE WHEN {_KEEP} THEN a || x ELSE left(a, length(a) - 1) || x END ELSE a || ' ' || x END"
_BULLET_SQL = "'^[•·▪‣₋–—*●\\x{F0B7}][\\s\\p{Z}]*'"
_IS_BRACKET = f"regexp_matches(c, {_re2(P.BRACKET_ROW)}) OR regexp_matches(c, {_re2(P.BRACKET_LAST)})"
#: Clean lines of text lines that hold no page marks and no lone punctuation: ``cl`` has blocks, ``cz`` their lines.
_REFLOW = f"""{_T}, rn AS (SELECT doc_id, seq, {_normal_sql("text")} AS nt FROM t), rc AS (SELECT doc_id, seq, {_S("nt")} AS c FROM rn),
rp AS (SELECT doc_id, list_sort(list(length(nt)) FILTER (length(nt) > 0 AND NOT regexp_matches(nt, '^(?:#|<!--|\\[\\^|\\*\\*)'))) AS v FROM rn GROUP BY doc_id),
rq AS (SELECT doc_id, CAST(coalesce(v[1 + CAST(floor(0.95 * (len(v) - 1)) AS INTEGER)], 80) AS DOUBLE) AS p95 FROM rp),
rk AS (SELECT doc_id, seq, c, CASE WHEN c = '' THEN 'blank' WHEN {_IS_BRACKET} THEN 'bracket' WHEN starts_with(c, '|') THEN 'row' WHEN starts_with(c, '#') OR regexp_matches(c, '^\\*\\*[^*]+\\*\\*$') OR regexp_matches(c, '^\\[\\^fn[0-9]+\\]:') OR regexp_matches(c, '^<!--art:[^ >]+-->$') THEN 'struct' ELSE 'text' END AS kind FROM rc),
rl AS (SELECT *, CASE WHEN kind = 'text' AND regexp_matches(c, {_BULLET_SQL}) AND NOT starts_with(c, '**') THEN regexp_replace(c, {_BULLET_SQL}, '- ') ELSE c END AS line FROM rk),
rm AS (SELECT *, lag(kind) OVER w AS pk, lag(line) OVER w AS pl FROM rl JOIN rq USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY seq)),
ro AS (SELECT *, CASE WHEN kind = 'text' THEN coalesce(pk, '') <> 'text' OR starts_with(line, '**Art.') OR regexp_matches(line, {_re2(P.TABLE_CAPTION)}) OR regexp_matches(line, {_re2(P.LIST_START)}) OR coalesce(regexp_matches(pl, '[.!?:»]$') AND length(pl) < p95 * CAST(0.9 AS DOUBLE) AND regexp_matches(line, '^[\\p{{Lu}}«(]'), false) WHEN kind = 'bracket' THEN coalesce(pk, '') <> 'bracket' ELSE true END AS op FROM rm),
rb AS (SELECT *, count_if(op) OVER (PARTITION BY doc_id ORDER BY seq) AS blk FROM ro),
ry AS (SELECT doc_id, blk, min(seq) AS seq, any_value(kind) AS kind, list(line ORDER BY seq) AS ls FROM rb WHERE kind <> 'blank' GROUP BY ALL),
cl AS (SELECT doc_id, seq, kind, CASE WHEN kind = 'text' THEN [{_fixed_sql(f"list_reduce(ls, lambda a, x: {_JOIN})")}] WHEN kind = 'bracket' THEN ['| Tranche (FCFA) | Taux |', '| --- | --- |'] || list_transform(ls, lambda r: CASE WHEN regexp_matches(r, {_re2(P.BRACKET_ROW)}) THEN '| de ' || {_TIDY(f"regexp_extract(r, {_re2(P.BRACKET_ROW)}, 1)")} || ' à ' || {_TIDY(f"regexp_extract(r, {_re2(P.BRACKET_ROW)}, 2)")} || ' | ' || {_S(f"regexp_extract(r, {_re2(P.BRACKET_ROW)}, 3)")} || ' |' ELSE '| plus de ' || {_TIDY(f"regexp_extract(r, {_re2(P.BRACKET_LAST)}, 1)")} || ' | ' || {_S(f"regexp_extract(r, {_re2(P.BRACKET_LAST)}, 2)")} || ' |' END) WHEN starts_with(ls[1], '#') THEN [{_fixed_sql("ls[1]")}] ELSE ls END AS o FROM ry),
cs AS (SELECT *, lag(kind) OVER w AS pk, lag(o[-1]) OVER w AS pt FROM cl WINDOW w AS (PARTITION BY doc_id ORDER BY seq)),
cz AS (SELECT doc_id, seq, CASE WHEN pk IS NULL OR regexp_matches(pt, '^<!--art:[^ >]+-->$') OR (pk = 'row' AND kind = 'row') OR (starts_with(pt, '- ') AND starts_with(o[1], '- ')) THEN o ELSE [''] || o END AS o FROM cs),
ce AS (SELECT doc_id, seq, unnest(range(len(o))) AS i, unnest(o) AS text FROM cz)"""


def _article_sums(lines: str, at: str, out: str) -> str:
    """CTEs ``out``: characters of each article in ordered lines."""
    mark = "<!--art:([^ >]+)-->"
    rest = f"regexp_replace(regexp_replace(text, '{mark}', '', 'g'), '<!--pg:[0-9]+-->', '', 'g')"
    run = f"SELECT doc_id, length({rest}) + 1 AS n, last_value(CASE WHEN regexp_matches(text, '{mark}') THEN regexp_extract(text, '{mark}', 1) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY {at}) AS id FROM {lines}"
    return f"{out} AS (SELECT doc_id, id, CAST(sum(n) AS BIGINT) AS n FROM ({run}) WHERE id IS NOT NULL GROUP BY ALL)"


_MARKED = _UNITS[: _UNITS.index("m1 AS (")].rstrip(",\n ") + ", mk AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, q AS seq, text FROM m0)"

ORACLE: dict[str, str] = {
    "raw_vs_clean": f"WITH {_MARKED}{_REFLOW[len(_T):].replace('FROM t), rc', 'FROM mk), rc')}, {_article_sums('mk', 'seq', 'sa')}, {_article_sums('ce', 'seq, i', 'sb')} SELECT doc_id, id, coalesce(sa.n, 0) AS raw_chars, sb.n AS clean_chars, sb.n - coalesce(sa.n, 0) AS change FROM sb LEFT JOIN sa USING (doc_id, id)",
    "reflowed_lines": f"WITH {_REFLOW} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY seq, i) - 1 AS BIGINT) AS seq, text FROM ce",
    "fixed_text": f"WITH {_T}, f AS (SELECT doc_id, seq, text AS old, {_fixed_sql('text')} AS text FROM t) SELECT doc_id, seq, text FROM f WHERE text <> old",
    "chunk_id_duplicates": f"WITH u AS (SELECT doc_id, unit_ix, min(struct_pack(kind := kind, key := coalesce(unit_key, ''), title := coalesce(title, ''))) AS u FROM units GROUP BY ALL), b AS (SELECT doc_id, unit_ix, u.kind AS kind, CASE WHEN u.key <> '' THEN u.key ELSE coalesce(nullif(regexp_replace(regexp_replace(lower(u.title), '[^\\p{{L}}\\p{{M}}\\p{{Nd}}_]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 's' || (row_number() OVER (PARTITION BY doc_id ORDER BY unit_ix) - 1)) END AS base FROM u), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind, base ORDER BY unit_ix) AS nth FROM b) SELECT doc_id, unit_ix, CASE WHEN nth > 1 THEN base || '-dup' || nth ELSE base END AS uid FROM n",
    "legal_units": f"WITH {_UNITS} SELECT doc_id, unit_ix, kind, key, title, hierarchy, length(text) AS n_chars, md5(text) AS digest, 1 AS page_start, 1 AS page_end FROM uu",
    "outside_lines": f"WITH {_UNITS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, q AS seq, c AS text FROM m7 WHERE NOT coalesce(isop, false) AND role = 'text'",
    "split_documents": f"WITH p AS (SELECT doc_id, {_split_sql('text')} AS p FROM documents WHERE text IS NOT NULL) SELECT doc_id, CAST(unnest(range(len(p))) AS INTEGER) AS part, length(unnest(p)) AS n, md5(unnest(p)) AS digest FROM p",
    "unit_contexts": f"WITH {_CTX} SELECT doc_id, unit_ix, kind, context FROM (SELECT DISTINCT doc_id, unit_ix, kind, key, title, hier, context FROM cx)",
    "all_unit_contexts": f"WITH {_CTX}, pt AS (SELECT *, greatest(len({_split_sql('text')}), 1) AS n_parts FROM cx) SELECT doc_id, unit_ix, kind, CAST(unnest(range(n_parts)) AS INTEGER) AS part, CAST(n_parts AS INTEGER) AS n_parts, context || CASE WHEN n_parts > 1 THEN ' (partie ' || (unnest(range(n_parts)) + 1) || '/' || n_parts || ')' ELSE '' END AS context FROM pt",
    "normalized_text": "SELECT doc_id, md5(regexp_replace(regexp_replace(translate(" + "replace(" * len(T.LIGATURES) + "nfc_normalize(text)" + "".join(f", '{k}', '{v}')" for k, v in T.LIGATURES.items()) + ", chr(160) || chr(8239) || chr(8201) || chr(8199) || '’‘ʼ' || chr(8203) || chr(8204) || chr(8205) || chr(65279) || chr(8288) || chr(173), '    '''''''), '[ \\t]+', ' ', 'g'), '[\\s\\p{Z}]+$', '')) AS digest FROM documents",
    "plain_text": f"SELECT doc_id, length({_S('''regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, '**', ''), '<!--pg:[0-9]+-->', '', 'g'), '[[]\\^fn[0-9]+[]]', '', 'g'), '[ \\t]{2,}', ' ', 'g'), ' +\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g')''')}) AS n FROM documents",
    "title_words": f"WITH {_H}, q AS (SELECT *, regexp_replace(title, '\\P{{L}}', '', 'g') AS lt, lower(regexp_extract(title, '([^\\s\\p{{Z}}]+)[\\s\\p{{Z}}]*$', 1)) AS lw FROM h WHERE level IS NOT NULL) SELECT doc_id, seq, lt <> '' AND NOT regexp_matches(lt, '[^\\p{{Lu}}]') AS capitals, lw IN {_IN(T.FUNCTION_WORDS)} OR regexp_matches(lw, '[''’]$') AS goes_on, CASE kind WHEN 'partie' THEN upper(num) || ' PARTIE' WHEN 'section' THEN 'Section ' || num WHEN 'paragraphe' THEN 'Paragraphe ' || num ELSE upper(kind) || ' ' || upper(num) END AS label FROM q",
    "hyphen_decisions": f"WITH {_L}, q AS (SELECT doc_id, ix AS seq, text, lead(text) OVER (PARTITION BY doc_id ORDER BY ix) AS nx FROM l), r AS (SELECT *, split_part(nx, ' ', 1) AS f, lower(regexp_extract(text, '([\\p{{L}}\\p{{N}}_'']+)-$', 1)) AS lw FROM q WHERE nx IS NOT NULL AND regexp_matches(text, '[\\p{{L}}\\p{{N}}]-$')), k AS (SELECT *, regexp_matches(f, '^[\\p{{Lu}}0-9]') OR regexp_matches(text, '[0-9]-$') OR lw IN {_IN(T.KEEP_PREFIX)} OR lower(regexp_replace(f, '^[.,;:)]+|[.,;:)]+$', '', 'g')) IN {_IN(T.KEEP_SUFFIX)} AS keep FROM r) SELECT doc_id, seq, CASE WHEN keep THEN 'kept' ELSE 'joined' END AS how, CASE WHEN keep THEN text || nx ELSE left(text, length(text) - 1) || nx END AS joined FROM k",
    "marks_and_characters": f"WITH {_MD} SELECT doc_id, CAST(sum(len(regexp_extract_all(text, '<!--pg:[0-9]+-->'))) AS BIGINT) AS page_markers, count_if(regexp_matches(text, '^\\|(?: --- \\|)+$')) AS tables, CAST(sum(length(regexp_replace(text, '[^\\x{{E000}}-\\x{{F8FF}}]', '', 'g'))) AS BIGINT) AS private_use_chars, CAST(sum(length(regexp_replace(text, '[^\\x{{FFFD}}]', '', 'g'))) AS BIGINT) AS replacement_chars, count_if(length(text) > 2500) AS very_long_paragraphs, count_if(regexp_matches({_S('text')}, '^[0-9]{{1,4}}$')) AS digit_only_paragraphs, count_if(regexp_matches(text, '^## R[0-9]+')) AS n_rescrits FROM md GROUP BY doc_id",
    "qa_flags": f"WITH {_MD}, nn AS (SELECT doc_id, id, seq, CAST(nullif(regexp_extract(id, '^([0-9]+)', 1), '') AS BIGINT) AS n FROM a), kk AS (SELECT doc_id, seq, id, {_KEY} AS k FROM a), pp AS (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY seq) AS pk FROM kk), f AS (SELECT doc_id, 'missing_numbers' AS flag FROM nn WHERE n IS NOT NULL GROUP BY doc_id HAVING count(DISTINCT n) < max(n) - min(n) + 1 UNION SELECT doc_id, 'duplicate_articles' FROM nn GROUP BY doc_id, id HAVING count(*) > 1 UNION SELECT doc_id, 'order_violations' FROM pp WHERE pk IS NOT NULL AND (k.n, k.rank, k.suffix) <= (pk.n, pk.rank, pk.suffix) UNION SELECT doc_id, 'refs_without_def' FROM md WHERE regexp_matches(text, '\\[\\^fn[0-9]+\\]') UNION SELECT doc_id, 'digit_only_paragraphs' FROM md WHERE regexp_matches({_S('text')}, '^[0-9]{{1,4}}$') UNION SELECT doc_id, 'very_long_paragraphs' FROM md WHERE length(text) > 2500) SELECT * FROM f",
    "ocr_raw_lines": f"WITH {_OCR}, pg AS (SELECT DISTINCT doc_id, page FROM ol) SELECT doc_id, CAST(page AS BIGINT) * 1000002 + line_no + 2 AS seq, tx AS text FROM od WHERE NOT gone UNION ALL SELECT doc_id, CAST(page AS BIGINT) * 1000002, '<!--pg:' || page || '-->' FROM pg UNION ALL SELECT doc_id, CAST(page AS BIGINT) * 1000002 + 1, '' FROM pg UNION ALL SELECT doc_id, CAST(page AS BIGINT) * 1000002 + 1000001, '' FROM pg",
    "ocr_page_report": f"WITH {_OCR}, q AS (SELECT doc_id, page, sum(CASE WHEN gone THEN 0 ELSE length({_S('tx')}) END) AS c, count_if(gone) AS dropped, count_if(NOT gone AND regexp_matches(tx, '^#{{1,6}} ')) AS h, count_if(NOT gone AND starts_with(tx, '|')) AS r FROM od GROUP BY ALL) SELECT doc_id, count(*) AS n_pages, count_if(c < 20) AS empty_pages, CAST(sum(dropped) AS BIGINT) AS dropped_lines, CAST(sum(h) AS BIGINT) AS headings, CAST(sum(r) AS BIGINT) AS table_rows FROM q GROUP BY doc_id",
    "ocr_figures": f"WITH {_OCR} SELECT doc_id, page, line_no, left({_S('text')}, 300) AS text FROM raw0 WHERE {_S('text')} <> '' AND regexp_matches(text, '(?i)[0-9][0-9 \\x{{A0}}\\x{{202F}}.,]*\\s?(?:%|FCFA|F\\s?CFA|francs)|\\b[0-9]{{1,3}}(?:[ \\x{{A0}}\\x{{202F}}.][0-9]{{3}})+\\b') AND NOT regexp_matches(text, '^\\s*\\| ---')",
    "heading_lines": f"WITH {_H} SELECT * FROM h WHERE level IS NOT NULL",
    "heading_levels": f"WITH {_H} SELECT doc_id, level, count(*) AS n FROM h WHERE level IS NOT NULL GROUP BY ALL",
    "heading_stack": f"WITH {_H}, g AS (SELECT doc_id, seq, level, title, " + ", ".join(f"max(CASE WHEN level = {k} THEN seq END) OVER w AS s{k}, max(CASE WHEN level < {k} THEN seq END) OVER w AS r{k}, last_value(CASE WHEN level = {k} THEN title END IGNORE NULLS) OVER w AS v{k}" for k in range(1, 7)) + " FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY seq)) SELECT doc_id, seq, " + ", ".join(f"CASE WHEN s{k} > coalesce(r{k}, -1) THEN v{k} END AS l{k}" for k in range(1, 7)) + " FROM g",
    "article_lines": f"WITH {_A} SELECT * FROM a",
    "article_sort_keys": f"WITH d AS (SELECT DISTINCT code, article, article AS id FROM code_articles), k AS (SELECT code, article, {_KEY} AS k FROM d) SELECT code, article, k.n AS n, k.rank AS rank, k.suffix AS suffix FROM k",
    "line_flags": f"WITH {_T} SELECT doc_id, seq, " + ", ".join(f"regexp_matches(text, {_re2(v)}) AS {k}" for k, v in _FLAGS.items()) + " FROM t",
    "bracket_rows": f"WITH {_BR} SELECT doc_id, seq, CASE WHEN m THEN {_TIDY(f'regexp_extract(c, {_re2(P.BRACKET_ROW)}, 1)')} ELSE {_TIDY(f'regexp_extract(c, {_re2(P.BRACKET_LAST)}, 1)')} END AS lo, CASE WHEN m THEN {_TIDY(f'regexp_extract(c, {_re2(P.BRACKET_ROW)}, 2)')} END AS hi, {_S(f'CASE WHEN m THEN regexp_extract(c, {_re2(P.BRACKET_ROW)}, 3) ELSE regexp_extract(c, {_re2(P.BRACKET_LAST)}, 2) END')} AS rate FROM (SELECT *, regexp_matches(c, {_re2(P.BRACKET_ROW)}) AS m FROM c) WHERE m OR regexp_matches(c, {_re2(P.BRACKET_LAST)})",
    "cross_reference_edges": f"WITH {_EDGES} SELECT * FROM e",
    "references_by_target": f"WITH {_EDGES} SELECT doc_id, target, count(*) AS n FROM (SELECT DISTINCT doc_id, seq, pos, target FROM e) GROUP BY ALL",
    "law_notes": f"WITH f AS (SELECT DISTINCT doc_id, page, num, text FROM footnote_defs) SELECT doc_id, page, num, left(text, 400) AS text, CASE WHEN regexp_matches(text, {_re2(P.LAW)}) THEN upper(left(regexp_extract(text, {_re2(P.LAW)}, 1), 1)) || lower(substr(regexp_extract(text, {_re2(P.LAW)}, 1), 2)) || ' N°' || regexp_extract(text, {_re2(P.LAW)}, 2) END AS law, nullif(regexp_extract(text, {_re2(P.LAW)}, 3), '') AS date, try_cast(nullif(regexp_extract(text, {_re2(P.EXERCICE)}, 1), '') AS INTEGER) AS exercice FROM f",
    "bullets": f"WITH {_T}, b AS (SELECT doc_id, seq, CASE WHEN regexp_matches(text, {_re2(T.BULLET)}) AND NOT starts_with(text, '**') THEN regexp_replace(text, {_re2(T.BULLET)}, '- ') ELSE text END AS text FROM t) SELECT * FROM b WHERE starts_with(text, '- ')",
    "article_numbers": f"WITH {_N} SELECT doc_id, count(*) AS n_articles, CAST(min(n) AS INTEGER) AS first_number, CAST(max(n) AS INTEGER) AS last_number FROM n GROUP BY doc_id",
    "duplicate_articles": f"WITH {_N} SELECT doc_id, id, count(*) AS n FROM n GROUP BY ALL HAVING count(*) > 1",
    "missing_article_numbers": f"WITH {_N}, m AS (SELECT doc_id, unnest(range(min(n), max(n) + 1)) AS missing FROM n WHERE n IS NOT NULL GROUP BY doc_id) SELECT doc_id, missing FROM m WHERE NOT EXISTS (FROM n WHERE n.doc_id = m.doc_id AND n.n = m.missing)",
    "article_order_violations": f"WITH {_A}, k AS (SELECT doc_id, seq, id, {_KEY} AS k FROM a), p AS (SELECT *, lag(id) OVER w AS prev_id, lag(k) OVER w AS pk FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY seq)) SELECT doc_id, seq, id, prev_id FROM p WHERE prev_id IS NOT NULL AND (k.n, k.rank, k.suffix) <= (pk.n, pk.rank, pk.suffix)",
    "article_lengths": f"WITH {_LEN} SELECT * FROM len",
    "article_length_stats": f"WITH {_LEN} SELECT doc_id, min(chars) AS min_chars, CAST(floor(median(chars)) AS BIGINT) AS median_chars, max(chars) AS max_chars, count_if(chars > 3000) AS over_3000 FROM len GROUP BY doc_id",
    "longest_articles": f"WITH {_LEN} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY chars DESC, seq) AS INTEGER) AS rank, id, chars FROM len QUALIFY rank <= 10",
    "markdown_headings": f"WITH {_H}, m AS (SELECT h.doc_id, coalesce(level, length(regexp_extract(t.text, '^(#+)', 1))) AS level FROM h JOIN t USING (doc_id, seq) WHERE NOT regexp_matches({_S('t.text')}, {_ART2})) SELECT doc_id, level, count(*) AS n FROM m WHERE level > 0 GROUP BY ALL",
    "notes_balance": f"WITH {_LINKS} SELECT doc_id, fid, CAST(1 AS BIGINT) AS refs, CAST(1 AS BIGINT) AS defs FROM ln WHERE fid IS NOT NULL",
    "text_per_page": f"WITH {_LL}, p AS (SELECT doc_id, page, sum(length({_S('text')})) AS c FROM l GROUP BY ALL), q AS (SELECT doc_id, least(max(page), 30) AS n, count(*) FILTER (page <= 30) AS seen, coalesce(sum(c) FILTER (page <= 30), 0) AS s, min(c) FILTER (page <= 30) AS m FROM p GROUP BY doc_id) SELECT doc_id, CAST(n AS BIGINT) AS pages, CAST(CASE WHEN seen < n THEN 0 ELSE m END AS BIGINT) AS min_chars, s / n < 200 AS scan, s / n < 100 AS skip FROM q",
    "font_sizes": f"WITH {_LL}, h AS (SELECT doc_id, round(size, 1) AS size, CAST(sum(length(text)) AS BIGINT) AS chars FROM l WHERE size IS NOT NULL GROUP BY ALL) SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY chars DESC, size) AS INTEGER) AS rank, size, chars FROM h QUALIFY rank <= 6",
    "headings_by_kind": f"WITH {_LL}, k AS (SELECT doc_id, {_heading_cases(_S('text'), 'kind')} AS kind FROM l) SELECT doc_id, kind, count(*) AS n FROM k WHERE kind IS NOT NULL GROUP BY ALL",
    "two_column_ratio": f"WITH {_STATS}, wd AS (SELECT doc_id, page, max(page_w) AS pw FROM spans WHERE page_w IS NOT NULL GROUP BY ALL) SELECT doc_id, count(*) AS n, count_if(x0 > CAST(0.45 AS DOUBLE) * coalesce(pw, 595.0)) AS \"right\", count_if(x0 > CAST(0.45 AS DOUBLE) * coalesce(pw, 595.0)) * 4 > count(*) AS two_columns FROM inn LEFT JOIN wd USING (doc_id, page) GROUP BY doc_id",
    "large_gaps": f"WITH {_STATS} SELECT doc_id, count(*) AS n, count_if(gap_before > CAST(1.6 AS DOUBLE) * median_leading) AS large FROM l JOIN st USING (doc_id) WHERE gap_before > 0 AND gap_before < 3 * body_size GROUP BY doc_id",
    "line_statistics": f"WITH {_STATS} SELECT * FROM st",
    "small_foot_lines": f"WITH {_STATS}, q AS (SELECT doc_id, page, text, coalesce(size <= CAST(0.92 AS DOUBLE) * body_size AND cy > CAST(0.8 AS DOUBLE) * page_h, false) AS sm FROM c JOIN st USING (doc_id)) SELECT doc_id, count_if(sm) AS small_lines, count(DISTINCT page) FILTER (sm) AS pages, count_if(regexp_matches(text, '^[0-9]{{1,2}}(?:Art\\.|[A-ZÉÈÀÂ][a-zà-ÿ]+|[0-9]{{1,2}}\\s*[-–]\\s*\\S)') AND NOT regexp_matches(text, {_DIGITS})) AS glued_markers, CAST(sum(len(regexp_extract_all(text, '\\{{\\{{fn:[0-9]+\\}}\\}}'))) AS BIGINT) AS superscripts FROM q GROUP BY doc_id",
    "foot_samples": f"WITH {_STATS} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page, ix) AS INTEGER) AS rank, page, size, left(text, 90) AS text FROM c JOIN st USING (doc_id) WHERE size <= CAST(0.92 AS DOUBLE) * body_size AND cy > CAST(0.8 AS DOUBLE) * page_h QUALIFY rank <= 6",
    "number_positions": f"WITH {_LL}, q AS (SELECT doc_id, (y0 + y1) / 2 / page_h AS y FROM l WHERE regexp_matches(text, {_DIGITS})) SELECT doc_id, count(*) AS n, count_if(y < 0.5) AS n_top, count_if(y >= 0.5) AS n_bottom, count_if(y >= CAST(0.08 AS DOUBLE) AND y <= CAST(0.92 AS DOUBLE)) AS outside, CAST(floor(min(y) * 1000) AS BIGINT) AS min_y, CAST(floor(median(y) * 1000) AS BIGINT) AS median_y, CAST(floor(max(y) * 1000) AS BIGINT) AS max_y FROM q WHERE y IS NOT NULL GROUP BY doc_id",
    "glued_markers": f"WITH {_LL} SELECT doc_id, ix AS seq, regexp_extract(text, '^([0-9]{{1,2}})', 1) AS marker FROM l WHERE regexp_matches(text, '^[0-9]{{1,2}}(?:Art\\.|[A-ZÉÈÀÂ][a-zà-ÿ]+|[0-9]{{1,2}}\\s*[-–]\\s*\\S)')",
    "code_title_pages": f"WITH {_LL} SELECT doc_id, page, text FROM l WHERE regexp_matches(lower({_S('text')}), '^(?:code\\s+g[ée]n[ée]ral\\s+des\\s+imp[ôo]ts|livre\\s+des\\s+proc[ée]dures\\s+fiscales)$')",
    "routed_lines": f"WITH {_ROUTED} SELECT doc_id, route, count(*) AS n FROM rt GROUP BY ALL",
    "page_records": f"WITH {_ROUTED} SELECT doc_id, page, arg_max(TRY_CAST(tx AS INTEGER), ix) FILTER (route = 'page_number') AS printed_page, count_if(route = 'body') AS n_lines, count_if(route IN ('page_number', 'running_header_footer')) AS dropped, count_if(reclaimed) AS reclaimed, max(footnote_method) AS footnote_method FROM rt GROUP BY ALL",
    "page_footnotes": f"WITH {_DEFS} SELECT * FROM df",
    "note_links": f"WITH {_LINKS} SELECT doc_id, ix, CAST(pos AS INTEGER) AS pos, num, page, def_page, fid, md5(note) AS digest FROM ln",
    "orphan_notes": f"WITH {_LINKS} SELECT df.* FROM df WHERE doc_id IN (FROM docs) AND NOT EXISTS (FROM ln WHERE ln.doc_id = df.doc_id AND ln.num = df.num AND ln.def_page = df.page)",
    "unresolved_markers": f"WITH {_LINKS} SELECT doc_id, page, num FROM ln WHERE def_page IS NULL",
    "contents_pages": f"WITH {_LL} SELECT doc_id, page, count(*) AS n FROM l WHERE regexp_matches(text, {_re2(inspect.LEADERS)}) GROUP BY ALL HAVING count(*) >= 8",
    "ruling_continuity": f"WITH {_LL}, r AS (SELECT doc_id, ix, CAST(regexp_extract(text, {_re2(P.RULING_START)}, 1) AS INTEGER) AS number FROM l WHERE regexp_matches(text, {_re2(P.RULING_START)})) SELECT doc_id, ix, number, coalesce(number = lag(number) OVER (PARTITION BY doc_id ORDER BY ix) + 1, true) AS follows FROM r",
    "numbering_resets": f"WITH {_LA}, n AS (SELECT doc_id, ix, page, CAST(regexp_extract(id, '^([0-9]+)', 1) AS INTEGER) AS number FROM a WHERE regexp_matches(id, '^[0-9]')), p AS (SELECT *, lag(number) OVER (PARTITION BY doc_id ORDER BY ix) AS prev_number FROM n) SELECT doc_id, ix, page, prev_number, number FROM p WHERE prev_number >= 20 AND number <= 3",
    "article_order": f"WITH {_LA}, k AS (SELECT *, {_KEY} AS k FROM a), p AS (SELECT *, lag(id) OVER w AS prev_id, lag(k) OVER w AS pk FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY ix)) SELECT doc_id, ix, page, id, prev_id, prev_id IS NULL OR (k.n, k.rank, k.suffix) > (pk.n, pk.rank, pk.suffix) AS rising FROM p",
    "line_length_p95": f"WITH {_T}, n AS (SELECT doc_id, list_sort(list(length(text)) FILTER (length(text) > 0 AND NOT regexp_matches(text, '^(?:#|<!--|\\[\\^|\\*\\*)'))) AS v FROM t GROUP BY doc_id) SELECT doc_id, CAST(coalesce(v[1 + CAST(floor(0.95 * (len(v) - 1)) AS INTEGER)], 80) AS DOUBLE) AS p95 FROM n",
    "repeated_margin_lines": f"WITH {_LL}, m AS (SELECT doc_id, lower({_TIDY('text')}) AS key, (y0 + y1) / 2 AS cy, page_h FROM l WHERE NOT regexp_matches(text, {_re2(P.DIGITS_ONLY)})), n AS (SELECT doc_id, key, count(*) AS n FROM m WHERE cy < 0.08 * page_h OR cy > (1 - 0.08) * page_h GROUP BY ALL), p AS (SELECT doc_id, max(page) AS np FROM l GROUP BY doc_id) SELECT doc_id, key, n FROM n JOIN p USING (doc_id) WHERE np >= 4 AND n >= greatest(3, floor(0.25 * np))",
    "chunk_sizes": "WITH c AS (SELECT DISTINCT chunk_id, doc_type, text FROM chunks) SELECT doc_type, count(*) AS n, min(length(text)) AS min_chars, CAST(floor(median(length(text))) AS BIGINT) AS median_chars, max(length(text)) AS max_chars, count_if(length(text) > 3750) AS over FROM c GROUP BY doc_type",
    "page_range_notes": "WITH u0 AS (SELECT doc_id, unit_ix, page_start, page_end, footnotes FROM units WHERE page_start IS NOT NULL AND page_end IS NOT NULL), u AS (SELECT doc_id, unit_ix, min(page_start) AS a, max(page_end) AS b FROM u0 GROUP BY ALL), cited AS (SELECT DISTINCT doc_id, unit_ix, f.text AS text FROM (SELECT doc_id, unit_ix, unnest(footnotes) AS f FROM u0)), n AS (SELECT DISTINCT doc_id, page, text FROM footnote_defs WHERE text IS NOT NULL) SELECT u.doc_id, unit_ix, CAST(count(*) AS INTEGER) AS n FROM u JOIN n ON n.doc_id = u.doc_id AND n.page BETWEEN a AND greatest(a, b) WHERE NOT EXISTS (FROM cited c WHERE c.doc_id = u.doc_id AND c.unit_ix = u.unit_ix AND c.text = n.text) GROUP BY ALL",
}
