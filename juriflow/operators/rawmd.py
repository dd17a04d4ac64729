"""Routed body lines to raw Markdown: notes resolved, titles merged, articles marked.

No title, table or paragraph decision leaves its page, so all windows but those
over a document's notes and pages hold one page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.functions import patterns as P
from juriflow.functions.text import ends_with_function_word, is_upper
from juriflow.operators.layout import markdown_table
from juriflow.operators.ordered import neighbours, paged_sum, running_sum
from juriflow.session import stored

_DOC, _PAGE = ["doc_id"], ["doc_id", "page"]
_NOTES = "array<struct<fid:string,text:string>>"


def note_links(body: DataFrame, defs: DataFrame) -> DataFrame:
    """Markers with the definition they take: doc_id, ix, pos, num, page, def_page, text, fid.

    In the order of the text each marker takes the first unused definition of
    its number on its page, the next, the one before, else on the first page
    that has one.  Markers compete only with those of the same number, so the
    fold runs over one (document, number).  ``fid`` numbers the links of a
    document; a marker without a definition has NULLs.
    """
    m = body.select("doc_id", "page", "ix", F.posexplode(F.regexp_extract_all("text", F.lit(P.PLACEHOLDER), F.lit(1)).cast("array<int>")).alias("pos", "num"))
    one = defs.groupBy("doc_id", "num", "page").agg(F.max("text").alias("text"))
    d = one.groupBy("doc_id", "num").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("_d"))
    g = m.groupBy("doc_id", "num").agg(F.array_sort(F.collect_list(F.struct("ix", "pos", "page"))).alias("_m")).join(d, ["doc_id", "num"], "left")
    kind = "array<struct<ix:bigint,pos:int,page:int,def_page:int,text:string>>"

    def step(s: Column, x: Column) -> Column:
        free = s["free"]
        on = lambda p: F.get(F.filter(free, lambda y: y["page"] == p), F.lit(0))
        got = F.coalesce(on(x["page"]), on(x["page"] + 1), on(x["page"] - 1), F.get(free, F.lit(0)))
        row = F.struct(x["ix"].cast("bigint").alias("ix"), x["pos"].alias("pos"), x["page"].alias("page"), got["page"].alias("def_page"), got["text"].alias("text"))
        return F.struct(F.filter(free, lambda y: ~y["page"].eqNullSafe(got["page"])).alias("free"), F.concat(s["out"], F.array(row)).alias("out"))

    none = F.array().cast("array<struct<page:int,text:string>>")
    out = F.aggregate("_m", F.struct(F.coalesce("_d", none).alias("free"), F.array().cast(kind).alias("out")), step, lambda s: s["out"])
    links = g.select("doc_id", "num", F.inline(out)).withColumn("_at", F.col("ix") * 1000 + F.col("pos"))
    links = running_sum(links, _DOC, "_at", {"_k": F.col("def_page").isNotNull().cast("int")})
    return links.withColumn("fid", F.when(F.col("def_page").isNotNull(), F.concat(F.lit("fn"), F.col("_k").cast("string")))).drop("_at", "_k")


def orphan_notes(defs: DataFrame, links: DataFrame) -> DataFrame:
    """Definitions that no marker took: doc_id, page, num, text."""
    used = links.filter("def_page IS NOT NULL").select("doc_id", F.col("def_page").alias("page"), "num").distinct()
    return defs.join(used, ["doc_id", "page", "num"], "left_anti")


def unresolved(links: DataFrame) -> DataFrame:
    """Markers without a definition: doc_id, page, num."""
    return links.filter("def_page IS NULL").select("doc_id", "page", "num")


def resolved(body: DataFrame, links: DataFrame) -> DataFrame:
    """Body lines with ``[^fnK]`` for their markers (nothing for unresolved ones) and ``notes``, the definitions they cite."""
    per = links.groupBy("doc_id", "ix").agg(F.array_sort(F.collect_list(F.struct("pos", "fid", "text"))).alias("_f"))
    b = body.join(per, ["doc_id", "ix"], "left")
    pieces = F.split("text", P.PLACEHOLDER)
    text = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(1))), F.get(pieces, F.lit(0)), lambda a, i: F.concat(a, F.coalesce(F.concat(F.lit("[^"), F.get("_f", i - 1)["fid"], F.lit("]")), F.lit("")), F.coalesce(F.get(pieces, i), F.lit(""))))
    notes = F.transform(F.filter("_f", lambda x: x["fid"].isNotNull()), lambda x: F.struct(x["fid"].alias("fid"), x["text"].alias("text")))
    return b.withColumn("text", F.when(F.col("text").rlike(P.PLACEHOLDER), text).otherwise(F.col("text"))).withColumn("notes", F.coalesce(notes, F.array().cast("array<struct<fid:string,text:string>>"))).drop("_f")


def merged_titles(lines: DataFrame, start: Column, title: Column, cont: Column, structural: Column, most: int) -> DataFrame:
    """Adds ``role`` (head, cont or other) and, on title rows, ``more`` and ``more_notes``: text and notes of the continuation lines.

    A continuation is one of the next ``most`` lines of the page, without a
    break, for which ``cont`` holds against the line before (columns p_*) and
    the title row (_h).
    """
    w = Window.partitionBy(*_PAGE).orderBy("ix")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(F.when(F.col("_start"), c), ignorenulls=True).over(run)
    d = lines.withColumns({"_start": F.coalesce(start, F.lit(False)), "_stop": F.coalesce(structural, F.lit(True)), "_title": title, "_rank": F.row_number().over(w)})
    d = d.withColumns({"_h": last(F.struct("ix", "bold", F.col("_title").alias("title"), F.col("_rank").alias("rank"))), "p_text": F.lag("text").over(w), "p_start": F.lag("_start").over(w)})
    ok = ~F.col("_start") & ~F.col("_stop") & (F.col("_rank") - F.col("_h.rank") <= most) & cont
    d = d.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    d = d.withColumn("_breaks", F.sum((~F.col("_ok") & ~F.col("_start")).cast("int")).over(run))
    # the chain holds while every line since the title row continues it
    d = d.withColumn("role", F.when(F.col("_start"), "head").when(F.col("_ok") & (F.col("_breaks") == last(F.col("_breaks"))), "cont").otherwise("other"))
    d = d.withColumn("_head", F.when(F.col("role") != "other", F.col("_h.ix")))
    after = F.collect_list(F.struct("_head", "role", "text", "notes")).over(w.rowsBetween(1, most))
    d = d.withColumn("_after", F.when(F.col("role") == "head", F.filter(after, lambda x: (x["role"] == "cont") & (x["_head"] == F.col("ix")))))
    more = F.array_join(F.transform("_after", lambda x: P.strip(x["text"])), " ")
    return d.withColumns({"more": more, "more_lines": F.size("_after"), "more_notes": F.flatten(F.transform("_after", lambda x: x["notes"]))}).drop("_start", "_stop", "_title", "_h", "_rank", "_ok", "_breaks", "_head", "_after", "p_start", "p_text")


def _gap() -> Column:
    """A gap above the line that parts paragraphs."""
    return F.coalesce(F.col("gap_before") > F.col("gap_factor") * F.col("median_leading"), F.lit(False))


def _all_notes() -> Column:
    return F.concat("notes", F.coalesce("more_notes", F.array().cast(_NOTES)))


def empty_pages(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows without text for pages (doc_id, page) that have none, so that their marks are put out."""
    bare = pages.select(*_PAGE).join(rows.select(*_PAGE).distinct(), _PAGE, "left_anti")
    return bare.select(*_PAGE, F.lit(0).cast("bigint").alias("ix"), F.array().cast("array<string>").alias("out"), F.array().cast(_NOTES).alias("notes"), F.lit(False).alias("flush"), F.lit(None).cast("int").alias("lines"))


def emit(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw lines (doc_id, seq, text) of rows (doc_id, page, ix, out, notes, flush, lines), and the titles among them (doc_id, page, title, lines).

    Notes follow the text of the unit that cites them, page marks precede their page's first line.
    """
    first = F.row_number().over(Window.partitionBy(*_PAGE).orderBy("ix")) == 1
    out = F.concat(F.when(first, F.array(F.concat(F.lit("<!--pg:"), F.col("page").cast("string"), F.lit("-->")))).otherwise(F.array().cast("array<string>")), "out")
    d = stored(paged_sum(rows.withColumn("out", out), "ix", {"_unit": F.col("flush").cast("int")}))
    # notes go before the next line that opens a unit, so to the end of the unit that cites them
    cited = d.filter(F.size("notes") > 0).groupBy("doc_id", "_unit").agg(F.flatten(F.array_sort(F.collect_list(F.struct("page", "ix", "notes")))["notes"]).alias("_n"))
    last = d.groupBy("doc_id", "_unit").agg(F.max(F.struct("page", "ix")).alias("_l"))
    defs = cited.join(last, ["doc_id", "_unit"]).select("doc_id", "_l.page", "_l.ix", F.lit(1).alias("_after"), F.concat(F.array(F.lit("")), F.transform("_n", lambda x: F.concat(F.lit("[^"), x["fid"], F.lit("]: "), x["text"])), F.array(F.lit(""))).alias("out"))
    both = d.select("doc_id", "page", "ix", F.lit(0).alias("_after"), "out").unionByName(defs)
    n = paged_sum(both, ["ix", "_after"], {"_end": F.size("out")})
    raw = n.select("doc_id", (F.col("_end") - F.size("out")).alias("_from"), F.posexplode("out").alias("_i", "text")).select("doc_id", (F.col("_from") + F.col("_i")).cast("bigint").alias("seq"), "text")
    title = F.get(F.filter("out", lambda x: x.startswith("#")), F.lit(0))
    return raw, d.filter("lines IS NOT NULL").select("doc_id", "page", F.regexp_replace(title, "^#+ ", "").alias("title"), "lines")


def line_features(body: DataFrame) -> DataFrame:
    """Resolved body lines with what the code builder asks of each: heading, article, structural, sub.  Written once, so that no pattern is matched again."""
    t = P.strip_notes(F.col("text"))
    d = body.withColumn("_t", t)
    d = d.withColumns({"heading": P.heading(F.col("_t")), "article": P.article_start(F.col("_t")), "sub": F.col("_t").rlike(P.SUBHEADING), "_item": F.col("_t").rlike(P.LIST_START) | F.col("_t").rlike(P.RULING_START)})
    d = d.withColumn("opens", F.col("heading").isNotNull() | F.col("article").isNotNull() | F.col("sub"))
    return d.withColumn("structural", F.col("opens") | F.col("_item")).drop("_t", "_item")


def code_lines(body: DataFrame) -> DataFrame:
    """Body lines of codes with role, heading, article and subheading: what the code builder decides on each line.

    A title goes on over up to five lines of its page that open nothing, if it
    is empty, or the line starts in lower case, or the line before ends with a
    function word, or both are capitals, or both are bold; and the line before
    does not close a sentence.
    """
    d = stored(line_features(body))
    cont = ((F.col("_h.title") == "") & F.col("p_start")) | F.col("text").rlike(r"^\p{Ll}") | ends_with_function_word(F.col("p_text")) | (is_upper(F.col("p_text")) & is_upper(F.col("text"))) | (F.col("_h.bold") & F.col("bold"))
    cont = cont & ~F.col("p_text").rlike(r"(?U)[.;:!?]\s*$")
    d = merged_titles(d, F.col("heading").isNotNull(), F.col("heading.title"), cont, F.col("structural"), 5)
    before_opening = F.lead("opens").over(Window.partitionBy(*_PAGE).orderBy("ix"))
    sub = F.col("sub") & ~P.strip_notes(F.col("text")).rlike("[;.,]$") & before_opening & F.col("heading").isNull() & F.col("article").isNull() & (F.col("role") == "other")
    return d.withColumn("sub", F.coalesce(sub, F.lit(False)))


def build_code(body: DataFrame) -> DataFrame:
    """Rows (see ``emit``) of codes: headings, article marks, bold subheadings, gaps; ``body`` is ``resolved``."""
    d = code_lines(body).filter("role <> 'cont'")
    h = F.col("heading")
    title = P.strip(F.concat_ws(" ", F.nullif(h["title"], F.lit("")), F.nullif("more", F.lit(""))))
    head = F.concat(F.repeat(F.lit("#"), h["level"]), F.lit(" "), P.heading_label(h["kind"], h["num"]), F.when(title != "", F.concat(F.lit(" : "), title)).otherwise(""))
    lead = F.regexp_extract("text", r"^((?:\[\^fn\d+\])+)", 1)
    art = F.concat(F.lit("**Art. "), F.col("article.id"), F.lit(" :**"), lead, F.when(F.col("article.rest") != "", F.concat(F.lit(" "), F.col("article.rest"))).otherwise(""))
    blank = F.lit("")
    out = (
        F.when(F.col("role") == "head", F.array(blank, head, blank)).when(F.col("article").isNotNull(), F.array(blank, F.concat(F.lit("<!--art:"), F.col("article.id"), F.lit("-->")), art))
        .when(F.col("sub"), F.array(blank, F.concat(F.lit("**"), P.strip_notes(F.col("text")), F.lit("**")), blank)).when(_gap(), F.array(blank, F.col("text"))).otherwise(F.array(F.col("text")))
    )
    return d.select(*_PAGE, "ix", out.alias("out"), _all_notes().alias("notes"), ((F.col("role") == "head") | F.col("article").isNotNull()).alias("flush"), F.when(F.col("role") == "head", F.col("more_lines") + 1).alias("lines"))


def build_rulings(body: DataFrame) -> DataFrame:
    """Rows (see ``emit``) of rulings: the first line in capitals as title, ``R<n>`` titles over up to two more lines."""
    full = F.length("p_text") >= 0.9 * F.col("p95_len")
    cont = (F.col("_h.bold") & F.col("bold")) | (full & F.col("text").rlike(r"^\p{Ll}")) | (full & ends_with_function_word(F.col("p_text")))
    start = F.col("text").rlike(P.RULING_START)
    d = merged_titles(body, start, F.regexp_extract("text", P.RULING_START, 2), cont, start, 2).filter("role <> 'cont'")
    caps = F.when((F.col("role") == "other") & is_upper(F.col("text")), F.struct("page", "ix"))
    first = d.groupBy("doc_id").agg(F.min(caps).alias("_top"))
    # one row for each document with a title, which is a small part of its lines
    top = F.coalesce(F.struct("page", "ix") == F.col("_top"), F.lit(False))
    d = d.join(first, "doc_id", "left").withColumn("_is_top", top)
    title = P.strip(F.concat_ws(" ", P.strip(F.regexp_extract("text", P.RULING_START, 2)), F.nullif("more", F.lit(""))))
    head = F.concat(F.lit("## R"), F.regexp_extract("text", P.RULING_START, 1), F.lit(" : "), title)
    blank = F.lit("")
    out = F.when(F.col("role") == "head", F.array(blank, head, blank)).when(F.col("_is_top"), F.array(F.concat(F.lit("# "), F.col("text")), blank)).when(_gap(), F.array(blank, F.col("text"))).otherwise(F.array(F.col("text")))
    return d.select(*_PAGE, "ix", out.alias("out"), _all_notes().alias("notes"), (F.col("role") == "head").alias("flush"), F.when(F.col("role") == "head", F.col("more_lines") + 1).alias("lines"))


def size_levels(body: DataFrame) -> DataFrame:
    """doc_id, s, level: distinct sizes of at least 1.15 of the body's, largest first, at most level 4."""
    big = body.filter(F.col("size") >= 1.15 * F.col("body_size")).select("doc_id", F.bround("size", 1).alias("s")).distinct()
    return big.withColumn("level", F.least(F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("s"))), F.lit(4)))


def generic_lines(body: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Lines and tables of narrative documents in order, with role (head, cont, sub, table or text), level, and a title's ``more`` and ``more_notes``.

    Tables stand among the lines of their page by their upper edge; a title
    goes on over lines of its size and weight that follow it without a table
    between.
    """
    b = body.withColumn("s", F.bround("size", 1)).join(size_levels(body), ["doc_id", "s"], "left").withColumn("rows", F.lit(None).cast("array<array<string>>"))
    cols = [*_PAGE, "ix", "y0", "text", "notes", "size", "s", "bold", "level", "body_size", "gap_before", "gap_factor", "median_leading", "rows"]
    b = b.select(*cols)
    if tables is not None:
        none = {c: F.lit(None).cast(b.schema[c].dataType) for c in cols}
        t = tables.select(*[F.col(c) if c in (*_PAGE, "y0", "rows") else none[c].alias(c) for c in cols])
        b = b.unionByName(t)
    w = Window.partitionBy(*_PAGE).orderBy("y0", F.col("ix").asc_nulls_last()) if tables is not None else Window.partitionBy(*_PAGE).orderBy("ix")
    b = b.withColumn("ix", F.row_number().over(w).cast("bigint"))
    w = Window.partitionBy(*_PAGE).orderBy("ix")
    head = F.col("level").isNotNull() & (F.length("text") <= 140) & ~F.col("text").endswith(".")
    b = b.withColumn("_head", F.coalesce(head, F.lit(False)))
    here = F.struct("_head", "s", F.coalesce("bold", F.lit(False)).alias("b"))
    cont = F.col("_head") & F.coalesce(F.lag(here).over(w) == here, F.lit(False))
    b = b.withColumn("_cont", cont)
    sub = F.col("bold") & (F.length("text") <= 100) & ~F.col("text").rlike("[.;,]$") & (F.col("size") >= F.col("body_size") - 0.5) & F.col("level").isNull()
    role = F.when(F.col("rows").isNotNull(), "table").when(F.col("_cont"), "cont").when(F.col("_head"), "head").when(F.coalesce(sub, F.lit(False)), "sub").otherwise("text")
    b = b.withColumn("role", role).withColumn("_t", F.when(F.col("_head"), F.last(F.when(F.col("role") == "head", F.col("ix")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    more = Window.partitionBy(*_PAGE, "_t").orderBy("ix").rowsBetween(1, Window.unboundedFollowing)
    rest = F.when(F.col("role") == "head", F.collect_list(F.when(F.col("role") == "cont", F.struct("text", "notes"))).over(more))
    return b.withColumn("_m", rest).withColumns({"more": F.array_join(F.transform("_m", lambda x: x["text"]), " "), "more_lines": F.size("_m"), "more_notes": F.flatten(F.transform("_m", lambda x: x["notes"]))}).drop("_m", "_t", "_head", "_cont")


def build_generic(body: DataFrame, tables: DataFrame | None = None, orphans: DataFrame | None = None) -> DataFrame:
    """Rows (see ``emit``) of narrative documents: titles by font size, bold subheadings, tables in place.

    Notes stay with the unit that cites them; ``orphans``, notes that none
    cites, are lines of their own at the end of their page.
    """
    d = generic_lines(body, tables).filter("role <> 'cont'")
    title = F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), F.concat_ws(" ", "text", F.nullif("more", F.lit(""))))
    blank, role = F.lit(""), F.col("role")
    out = (
        F.when(role == "table", F.concat(F.array(blank), markdown_table(F.col("rows")), F.array(blank))).when(role == "head", F.array(blank, title, blank))
        .when(role == "sub", F.array(blank, F.concat(F.lit("**"), F.col("text"), F.lit("**")), blank)).when(_gap(), F.array(blank, F.col("text"))).otherwise(F.array(F.col("text")))
    )
    rows = d.select(*_PAGE, "ix", out.alias("out"), F.coalesce(_all_notes(), F.array().cast(_NOTES)).alias("notes"), role.isin("head", "sub").alias("flush"), F.when(F.col("role") == "head", F.col("more_lines") + 1).alias("lines"))
    if orphans is not None:
        note = F.struct("num", F.concat(F.lit("> note "), F.col("num").cast("string"), F.lit(" : "), "text").alias("t"))
        per = orphans.groupBy(*_PAGE).agg(F.array_sort(F.collect_list(note))["t"].alias("out"))
        last = F.lit(2**40).cast("bigint")
        rows = rows.unionByName(per.select(*_PAGE, last.alias("ix"), "out", F.array().cast(_NOTES).alias("notes"), F.lit(False).alias("flush"), F.lit(None).cast("int").alias("lines")))
    return rows


def article_order(body: DataFrame) -> DataFrame:
    """Articles in order with the one before: doc_id, ix, page, id, prev_id, rising (False where the order does not increase)."""
    a = body.withColumn("_a", P.article_start(P.strip_notes(F.col("text")))).filter("_a IS NOT NULL").select("doc_id", "ix", "page", F.col("_a.id").alias("id"))
    a = neighbours(a, _DOC, "ix", before={"prev_id": F.col("id")})
    return a.withColumn("rising", F.coalesce(P.article_sort_key(F.col("id")) > P.article_sort_key(F.col("prev_id")), F.lit(True)))
