"""Units to citation-ready chunks: notes, references, context, ids, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.functions import patterns as P
from juriflow.operators.ordered import running_sum
from juriflow.operators.pack import split_text
from juriflow.operators.reflow import nearest_rank

#: An article's own label at the head of its text, and the label of rulings where none is given.
OWN_LABEL = r"(?U)^Art(?:icle)?s?\.?\s*\S+\s*:\s*"
RULINGS_LABEL = "Rescrits fiscaux"


def normalize_refs(text: Column, own_code: Column) -> Column:
    """ARRAY<STRUCT<code, articles, range, assumed>>: own label taken off, the own code assumed where none is named, the first of equal references kept."""
    found = F.transform(P.references(F.regexp_replace(text, OWN_LABEL, "")), lambda r: F.struct(F.when(r["target"].isNull() | (r["target"] == "self"), own_code).otherwise(r["target"]).alias("code"), r["nums"].alias("articles"), r["is_range"].alias("range"), (r["target"].isNull() | (r["target"] == "self")).alias("assumed")))
    keys = F.transform(found, lambda r: F.struct(r["code"], r["articles"], r["range"]))
    return F.filter(found, lambda r, i: F.array_position(keys, F.struct(r["code"], r["articles"], r["range"])) == i + 1)


def title_case(text: Column) -> Column:
    """Every run of letters with a capital first and small letters after it, whatever stands before it."""
    runs = F.split(text, r"(?<=\p{L})(?=\P{L})|(?<=\P{L})(?=\p{L})")
    return F.array_join(F.transform(runs, F.initcap), "")


def doc_label(doc_type: Column, code: Column, version_year: Column, doc_id: Column, rulings_label: str = RULINGS_LABEL) -> Column:
    """Code and year; a constant for rulings; else the words of the id before '__', capitalised."""
    words = title_case(F.replace(F.element_at(F.split(doc_id, "__"), 1), F.lit("_"), F.lit(" ")))
    return F.when(doc_type == "code", F.concat_ws(" ", F.nullif(code, F.lit("")), F.when(version_year != 0, version_year.cast("string")))).when(doc_type == "rescrits", F.lit(rulings_label)).otherwise(words)


def build_context(label: Column, kind: Column, key: Column, title: Column, hier: Column, part: Column, n_parts: Column) -> Column:
    """Label | hierarchy | article, ruling or title, with the part's number where there are several."""
    tail = F.when(kind == "article", F.concat(F.lit("Art. "), key)).when(kind == "rescrit", F.concat(F.lit("R"), key, F.lit(" : "), title)).otherwise(title)
    levels = F.array_join(F.transform(hier, lambda h: h["v"]), " > ")
    bits = F.concat_ws(" | ", *[F.nullif(b, F.lit("")) for b in (label, levels, tail)])
    return F.concat(bits, F.when(n_parts > 1, F.concat(F.lit(" (partie "), (part + 1).cast("string"), F.lit("/"), n_parts.cast("string"), F.lit(")"))).otherwise(""))


def slug(title: Column) -> Column:
    """Lower case, runs of other than letters, digits and underscores as one hyphen."""
    return F.regexp_replace(F.regexp_replace(F.lower(title), r"(?U)\W+", "-"), "^-+|-+$", "")


def page_notes(units: DataFrame, orphan_notes: DataFrame) -> DataFrame:
    """doc_id, unit_ix, page_notes: orphan notes of the unit's pages that it does not cite, each text once per page.

    Pages are spelled out and joined by equality, so no nested loop is needed.
    """
    pages = units.select("doc_id", "unit_ix", F.transform("footnotes", lambda x: x["text"]).alias("_cited"), F.explode(F.sequence("page_start", F.greatest("page_start", "page_end"))).alias("page"))
    first = orphan_notes.groupBy("doc_id", "page", "text").agg(F.min("num").alias("num"))
    hit = pages.join(first, ["doc_id", "page"]).filter(~F.coalesce(F.array_contains("_cited", F.col("text")), F.lit(False)))
    note = F.struct("page", "num", P.note(F.col("text")).alias("n"))
    g = hit.groupBy("doc_id", "unit_ix").agg(F.array_sort(F.collect_list(note)).alias("_n"))
    return g.select("doc_id", "unit_ix", F.transform("_n", lambda x: F.struct(x["page"].alias("page"), x["n"]["text"].alias("text"), x["n"]["law"].alias("law"), x["n"]["date"].alias("date"), x["n"]["exercice"].alias("exercice"))).alias("page_notes"))


def with_ids(units: DataFrame) -> DataFrame:
    """Adds uid: the key, else the title's slug, else 's' and the number of parts before; '-dupN' from the second of a (kind, uid) on."""
    u = running_sum(units, ["doc_id"], "unit_ix", {"_seen": F.size("parts")})
    base = F.when(F.col("key") != "", F.col("key")).when(slug(F.col("title")) != "", slug(F.col("title"))).otherwise(F.concat(F.lit("s"), (F.col("_seen") - F.size("parts")).cast("string")))
    u = u.withColumn("_base", base)
    nth = F.row_number().over(Window.partitionBy("doc_id", "kind", "_base").orderBy("unit_ix"))
    return u.withColumn("_nth", nth).withColumn("uid", F.when(F.col("_nth") > 1, F.concat("_base", F.lit("-dup"), F.col("_nth").cast("string"))).otherwise(F.col("_base"))).drop("_seen", "_base", "_nth")


def chunks(units: DataFrame, documents_meta: DataFrame, page_map: DataFrame | None = None, orphan_notes: DataFrame | None = None, limit: int = 3000, least: int = 250, rulings_label: str = RULINGS_LABEL) -> DataFrame:
    """One row for each part of each unit with text.

    ``documents_meta``: one row is taken per doc_id (that loaded last where
    ``loaded_at`` exists).  ``page_map``: doc_id, pdf_page, printed_page.
    Missing sidecars give NULL printed pages and no page notes.
    """
    meta_cols = ["source_doc_id", "code", "version_year", "published", "source_url"]
    order = F.struct("loaded_at", *meta_cols) if "loaded_at" in documents_meta.columns else F.struct(*meta_cols)
    meta = documents_meta.groupBy("doc_id").agg(F.max(order).alias("_m")).select("doc_id", *[F.col(f"_m.{c}").alias(c) for c in meta_cols])
    u = with_ids(units.filter("text <> ''").withColumn("parts", split_text(F.col("text"), limit, least)))
    texts = F.array_distinct(F.transform("footnotes", lambda x: x["text"]))
    u = u.withColumn("amended_by", F.transform(texts, P.note)).join(meta, "doc_id", "left")
    note_type = "array<struct<page:int,text:string,law:string,date:string,exercice:int>>"
    none = F.array().cast(note_type)
    if orphan_notes is None:
        u = u.withColumn("page_notes", none)
    else:
        u = u.join(page_notes(units, orphan_notes), ["doc_id", "unit_ix"], "left").withColumn("page_notes", F.coalesce("page_notes", none))
    if page_map is None:
        u = u.withColumn("printed_page_start", F.lit(None).cast("int")).withColumn("printed_page_end", F.lit(None).cast("int"))
    else:
        for end in ("start", "end"):
            m = page_map.groupBy("doc_id", F.col("pdf_page").alias(f"page_{end}")).agg(F.max("printed_page").alias(f"printed_page_{end}"))
            u = u.join(m, ["doc_id", f"page_{end}"], "left")
    p = u.select("*", F.posexplode("parts").alias("part", "_text")).drop("text").withColumnRenamed("_text", "text").withColumn("n_parts", F.size("parts"))
    p = p.withColumn("context", build_context(doc_label(F.col("doc_type"), F.col("code"), F.col("version_year"), F.col("doc_id"), rulings_label), F.col("kind"), F.col("key"), F.col("title"), F.col("hier"), F.col("part"), F.col("n_parts")))
    return p.select(
        F.concat("doc_id", F.lit("::"), F.substring("kind", 1, 3), "uid", F.lit("::"), F.col("part").cast("string")).alias("chunk_id"),
        "doc_id", "source_doc_id", "doc_type", "code", "version_year", "published", "source_url", F.col("kind").alias("unit"),
        F.when(F.col("kind") == "article", F.col("key")).alias("article"), F.when(F.col("kind") == "rescrit", F.col("key")).alias("rescrit"), F.nullif("title", F.lit("")).alias("title"),
        F.map_from_entries("hier").alias("hierarchy"), "part", "n_parts", "page_start", "page_end", "printed_page_start", "printed_page_end",
        normalize_refs(F.col("text"), F.col("code")).alias("refs"), "amended_by", "page_notes", "context", "text",
        F.concat("context", F.lit("\n\n"), "text").alias("embed_text"), F.length("text").alias("n_chars"), F.expr("length(text) div 4").cast("int").alias("tokens_est"),
    )


def chunk_stats(found: DataFrame, units: DataFrame, outside: DataFrame, limit: int = 3000, least: int = 250) -> DataFrame:
    """One row for each document: numbers of units, chunks, split and empty units, characters outside, sizes, and how many chunks carry what."""
    n = F.col("n_chars")
    count = lambda c: F.coalesce(F.count_if(c), F.lit(0))
    c = found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.count_distinct(F.when(F.col("n_parts") > 1, F.regexp_extract("chunk_id", "^(.*)::[0-9]+$", 1))).alias("units_split"),
        F.min(n).alias("min_chars"), F.percentile(n, F.lit(0.5)).cast("int").alias("median_chars"), nearest_rank(F.collect_list(n), 0.95).alias("p95_chars"), F.max(n).alias("max_chars"),
        count(n > limit * 1.25).alias("chunks_over_max"), count((n < least) & (F.col("n_parts") == 1)).alias("chunks_under_min"),
        count(F.size("amended_by") > 0).alias("with_amended_by"), count(F.size("page_notes") > 0).alias("with_page_notes"), count(F.size("refs") > 0).alias("with_refs"),
    )
    u = units.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_units"), count(F.col("text") == "").alias("empty_units"))
    o = outside.groupBy("doc_id").agg(F.sum(F.length("text")).alias("text_outside_units_chars"))
    return u.join(c, "doc_id", "full").join(o, "doc_id", "full").fillna(0, ["n_units", "empty_units", "n_chunks", "units_split", "text_outside_units_chars", "chunks_over_max", "chunks_under_min", "with_amended_by", "with_page_notes", "with_refs"])


def chunk_flags(stats: DataFrame, doc_types: DataFrame) -> DataFrame:
    """doc_id, flag: what a person should look at: 'oversize', 'empty_units', 'outside'."""
    s = stats.join(doc_types.select("doc_id", "doc_type").distinct(), "doc_id", "left")
    flags = F.array_compact(F.array(F.when(F.col("chunks_over_max") > 0, "oversize"), F.when(F.col("empty_units") > 0, "empty_units"), F.when((F.col("doc_type") == "code") & (F.col("text_outside_units_chars") > 5000), "outside")))
    return s.select("doc_id", F.explode(flags).alias("flag"))
