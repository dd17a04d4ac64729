"""Command line: python -m juriflow.cli STAGE --data FOLDER --out FOLDER [options].

Stages hand on folders: extract and ocr write ``raw`` (and ``page_map``,
``orphan_notes``, reports), clean reads ``raw`` and writes ``clean``, chunk reads
``clean`` and the sidecars and writes ``chunks``.  So one folder can serve as
--data and --out of them all.  Markdown files named ``*.raw.md`` or ``*.clean.md``
are read too.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from juriflow.operators import chunks, inspect, layout, ocr, qa, reflow
from juriflow.plans import pipeline
from juriflow.session import local_session, stored, table
from juriflow.sources import manifest, markdown, sinks

PAGE_MAP = "doc_id string, pdf_page int, printed_page int"
ORPHANS = "doc_id string, page int, num int, text string"


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="juriflow")
    p.add_argument("stage", choices=["inspect", "extract", "ocr", "clean", "chunk"])
    p.add_argument("--data", required=True, help="tables (inspect, extract, ocr) or the folder of the stage before")
    p.add_argument("--out", required=True)
    p.add_argument("--manifest", help="YAML file of documents, which gives types, layout settings and parts")
    p.add_argument("--doc", "--stem", dest="doc", nargs="*", help="only these documents")
    p.add_argument("--dump", default="", help="inspect: pages to list, as 1,2")
    p.add_argument("--show", type=int, default=0, help="clean, chunk: print so many articles or chunks")
    p.add_argument("--max-chars", type=int, default=3000)
    p.add_argument("--min-chars", type=int, default=250)
    p.add_argument("--provider", help="ocr: module:function that gives a document's pages as Markdown")
    p.add_argument("--key-name", help="ocr: name of the environment's variable that holds the service's key")
    p.add_argument("--env", default=".env", help="ocr: file of settings")
    p.add_argument("--tier", choices=ocr.TIERS, default="agentic")
    p.add_argument("--lang", nargs="*", default=["fr"])
    p.add_argument("--first", type=int, default=0, help="ocr: a trial of so many pages, which writes only to the folder trial")
    p.add_argument("--force", action="store_true", help="ocr: parse again what is cached")
    return p.parse_args(args)


def _entries(spark: SparkSession, a: argparse.Namespace) -> DataFrame | None:
    return manifest.select_docs(manifest.entries(spark, manifest.load_manifest(a.manifest)), a.doc) if a.manifest else None


def _exists(path: str) -> bool:
    spark = SparkSession.active()
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _tables(spark: SparkSession, a: argparse.Namespace):
    """Metadata, documents, lines, settings, tables and parts of the documents asked for."""
    found = _entries(spark, a)
    if found is None:
        meta = table(spark, a.data, "documents_meta")
        meta = meta.filter(F.col("doc_id").isin(a.doc)) if a.doc else meta
    else:
        meta = found.drop("subdocs", "layout").withColumn("pdf_pages", F.lit(None).cast("array<int>"))
    docs = pipeline.documents_of(meta)
    if _exists(f"{a.data}/doc_lines.parquet"):
        lines = layout.as_lines(table(spark, a.data, "doc_lines"))
    else:
        lines = layout.page_lines(table(spark, a.data, "spans")).withColumn("ix", F.col("page").cast("bigint") * 10_000 + F.col("ix"))
    lines = stored(lines.join(docs.select("doc_id"), "doc_id", "left_semi"))
    pages = lines.groupBy("doc_id").agg(F.max("page").alias("n_pages"))
    cfg = layout.settings_of(found) if found is not None else layout.settings(docs)
    parts = manifest.subdocument_ranges(found, pages) if found is not None else None
    tables = table(spark, a.data, "pdf_tables") if _exists(f"{a.data}/pdf_tables.parquet") else None
    return meta, docs, lines, cfg, tables, parts


def run_inspect(spark: SparkSession, a: argparse.Namespace) -> None:
    _, docs, lines, cfg, tables, _ = _tables(spark, a)
    stats = stored(layout.doc_stats(lines, cfg))
    dump = inspect.page_dump(lines, [int(x) for x in a.dump.split(",") if x.strip()]) if a.dump else None
    report = inspect.report(lines, stats, docs, layout.repeated_margin_lines(lines, cfg), layout.good_tables(tables) if tables is not None else None, dump)
    sinks.write_markdown(report, f"{a.out}/inspect")


def run_extract(spark: SparkSession, a: argparse.Namespace) -> None:
    meta, docs, lines, cfg, tables, parts = _tables(spark, a)
    sinks.write_json(inspect.text_per_page(lines).filter("skip").select("doc_id", "mean_chars"), f"{a.out}/without_text")
    docs = stored(pipeline.native(lines, docs))
    got = pipeline.extract(lines, docs, cfg, tables, parts)
    meta = meta.dropDuplicates(["doc_id"])
    sinks.write_markdown(sinks.documents_text(got.raw, sinks.extract_headers(meta, got, parts)), f"{a.out}/raw")
    sinks.write_json(sinks.extract_report(got), f"{a.out}/extract_report")
    sinks.write_json(got.orphans, f"{a.out}/orphan_notes")
    sinks.write_json(pipeline.page_map(got.pages), f"{a.out}/page_map")
    if parts is not None:
        sinks.write_json(manifest.one_bound_codes(parts.join(docs.filter("doc_type = 'code'").select("doc_id"), "doc_id", "left_semi")), f"{a.out}/one_part_codes")


def run_ocr(spark: SparkSession, a: argparse.Namespace) -> None:
    ocr.load_env(a.env)
    files, cache_at = table(spark, a.data, "files"), f"{a.out}/ocr_pages"
    files = files.filter(F.col("doc_id").isin(a.doc)) if a.doc else files
    cache = spark.read.parquet(cache_at) if _exists(cache_at) else None
    todo = ocr.uncached(files, cache, a.force)
    send = None
    if a.provider:
        module, name = a.provider.split(":")
        send = getattr(importlib.import_module(module), name)
    new = stored(ocr.ocr_pages(todo, ocr.HostedProvider(send, a.key_name), a.tier, tuple(a.lang)))
    if a.first:
        new = new.filter(F.col("page") <= a.first)
    pages = new if cache is None else stored(cache.join(new.select("doc_id").distinct(), "doc_id", "left_anti").unionByName(new))
    out = f"{a.out}/trial" if a.first else a.out
    if not a.first:
        pages.write.mode("overwrite").parquet(cache_at)
    if "n_pages" in files.columns:
        sinks.write_json(ocr.page_count_mismatch(pages, files), f"{out}/page_counts")
    head = pages.groupBy("doc_id").agg(F.array(F.min("page"), F.max("page")).alias("pdf_pages")).withColumns({"source_doc_id": F.col("doc_id"), "ocr": F.lit("hosted"), "ocr_tier": F.lit(a.tier), "structured_markdown": F.lit(True)})
    sinks.write_markdown(sinks.documents_text(ocr.raw_lines(pages), sinks.front_matter(head)), f"{out}/raw")
    sinks.write_markdown(sinks.figures_markdown(ocr.figure_lines(pages)), f"{out}/figures")
    sinks.write_json(ocr.page_report(pages), f"{out}/ocr_report")


def _markdown(spark: SparkSession, a: argparse.Namespace, kind: str) -> DataFrame:
    if _exists(f"{a.data}/{kind}"):
        return markdown.read_documents(spark, f"{a.data}/{kind}", a.doc)
    return markdown.read_markdown(spark, a.data, f".{kind}.md", a.doc)


def run_clean(spark: SparkSession, a: argparse.Namespace) -> None:
    files = stored(_markdown(spark, a, "raw"))
    lines, front = markdown.md_lines(files), markdown.front_matter(files)
    out = stored(reflow.clean(lines, front))
    header = files.filter("header IS NOT NULL").select(F.col("stem").alias("doc_id"), F.concat(F.lit("---\n"), "header", F.lit("\n---\n")).alias("header"))
    sinks.write_markdown(sinks.documents_text(out, header), f"{a.out}/clean")
    flowing = lines.join(front.filter("NOT structured_markdown").select("doc_id"), "doc_id", "left_semi")
    p95 = stored(reflow.line_length_p95(reflow.normalized(flowing)))
    sinks.write_json(sinks.clean_report(out, reflow.clean_events(flowing, p95), reflow.hyphens(flowing, p95), qa.flags(out)), f"{a.out}/clean_report")
    if a.show:
        qa.length_changes(lines, out, a.show).show(a.show * 20, truncate=False)


def run_chunk(spark: SparkSession, a: argparse.Namespace) -> None:
    files = stored(_markdown(spark, a, "clean"))
    lines, front = markdown.md_lines(files), stored(markdown.front_matter(files))
    pages, orphans = markdown.read_sidecar(spark, f"{a.data}/page_map", PAGE_MAP), markdown.read_sidecar(spark, f"{a.data}/orphan_notes", ORPHANS)
    found, units, outside = pipeline.chunk(lines, front, pages, orphans, a.max_chars, a.min_chars)
    found = stored(found)
    sinks.write_json(found, f"{a.out}/chunks")
    stats = stored(chunks.chunk_stats(found, units, outside, a.max_chars, a.min_chars))
    sinks.write_json(stats, f"{a.out}/stats")
    sinks.write_json(chunks.chunk_flags(stats, front), f"{a.out}/flags")
    if a.show:
        found.select("chunk_id", "context", "n_chars").show(a.show, truncate=False)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = arguments(args)
    {"inspect": run_inspect, "extract": run_extract, "ocr": run_ocr, "clean": run_clean, "chunk": run_chunk}[a.stage](spark or local_session(), a)


if __name__ == "__main__":
    main()
