"""Layout: spans to visual lines, lines to routed pages.

All page-local steps partition by (doc_id, page), so one huge document is no
skew; document statistics are aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.functions import patterns as P
from juriflow.functions.text import norm_key

#: The layout settings that hold where a document gives none.
DEFAULTS = {"top_zone": 0.08, "bottom_zone": 0.08, "footnote_size_ratio": 0.92, "footnote_min_y": 0.80, "repeat_threshold": 0.25, "gap_factor": 1.6, "body_size": None, "drop_regex": [], "skip_pages": [], "footnote_enabled": True, "enable_glued_fallback": False}
NOTE_START = rf"(?U)^(?:\{{\{{fn:\d+\}}\}}|\d{{1,3}}$|\d{{1,3}}\s*(?:{P.LEGAL_KINDS})\b|(?:Loi|Ordonnance|D[ée]cret|Arr[êe]t[ée])\s+N°)"
NOTE_PLACEHOLDER = r"(?U)^\{\{fn:(\d+)\}\}\s*(.*)$"
NOTE_LEGAL = rf"(?U)^(\d{{1,2}})\s+((?:{P.LEGAL_KINDS})\b.*)$"

_PAGE = ["doc_id", "page"]


def visual_lines(spans: DataFrame) -> DataFrame:
    """Spans to visual lines: doc_id, page, line_ix, page_h, bbox and ``spans`` in order of x0.

    Raw lines are taken in order of their middle; one that overlaps the last
    group by at least half of the lower height joins it, and the group's box
    grows.  Blank raw lines and empty spans are dropped, repeated spans count once.
    """
    s = spans.select("doc_id", "page", "page_h", "raw_line", "span_ix", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("size", F.lit(0.0)).alias("size"), F.coalesce("bold", F.lit(False)).alias("bold"), F.coalesce("sup", F.lit(False)).alias("sup"), "x0", "y0", "x1", "y1").filter("text <> ''").dropDuplicates(["doc_id", "page", "raw_line", "span_ix"])
    piece = F.struct("x0", "raw_line", "span_ix", "x1", "text", "size", "bold", "sup")
    raw = s.groupBy("doc_id", "page", "raw_line").agg(F.array_sort(F.collect_list(piece)).alias("spans"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.max("page_h").alias("page_h"), F.array_join(F.array_sort(F.collect_list(F.struct("span_ix", "text")))["text"], "").alias("_t"))
    raw = raw.filter(P.strip(F.col("_t")) != "").withColumn("cy", (F.col("y0") + F.col("y1")) / 2)
    box = F.struct("cy", "raw_line", "x0", "y0", "x1", "y1", "spans")
    pages = raw.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(box)).alias("_r"), F.max("page_h").alias("page_h"))
    group = lambda r: F.struct(r["x0"].alias("x0"), r["y0"].alias("y0"), r["x1"].alias("x1"), r["y1"].alias("y1"), r["spans"].alias("spans"))

    def step(acc: Column, r: Column) -> Column:
        n = F.size(acc)
        g = F.get(acc, n - 1)
        over = F.least(g["y1"], r["y1"]) - F.greatest(g["y0"], r["y0"])
        low = F.least(g["y1"] - g["y0"], r["y1"] - r["y0"])
        merged = F.struct(F.least(g["x0"], r["x0"]).alias("x0"), F.least(g["y0"], r["y0"]).alias("y0"), F.greatest(g["x1"], r["x1"]).alias("x1"), F.greatest(g["y1"], r["y1"]).alias("y1"), F.concat(g["spans"], r["spans"]).alias("spans"))
        joins = (n > 0) & (low > 0) & (over / low >= 0.5)
        return F.when(F.coalesce(joins, F.lit(False)), F.concat(F.slice(acc, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(merged))).otherwise(F.concat(acc, F.array(group(r))))

    kind = "array<struct<x0:double,y0:double,x1:double,y1:double,spans:array<struct<x0:double,raw_line:int,span_ix:int,x1:double,text:string,size:double,bold:boolean,sup:boolean>>>>"
    folded = F.aggregate("_r", F.array().cast(kind), step)
    return pages.select("doc_id", "page", "page_h", F.posexplode(folded).alias("line_ix", "_g")).select("doc_id", "page", "line_ix", "page_h", "_g.x0", "_g.y0", "_g.x1", "_g.y1", F.array_sort("_g.spans").alias("spans"))


def rendered(found: DataFrame) -> DataFrame:
    """Text, size and weight of visual lines; small numbers become ``{{fn:N}}``, small ordinal endings are glued, gaps become spaces."""
    top = F.array_max(F.transform("spans", lambda s: s["size"]))
    small = lambda s: s["sup"] | (s["size"] < top * 0.85)
    marker = lambda s: small(s) & P.strip(s["text"]).rlike(r"^\d{1,2}$")
    ordinal = lambda s: small(s) & F.lower(P.strip(s["text"])).isin(P.ORDINAL_SUFFIXES)

    def step(a: Column, s: Column) -> Column:
        gap = a["x1"].isNotNull() & (s["x0"] - a["x1"] > s["size"] * 0.12) & ~((a["t"] != "") & a["t"].rlike(r"[ \-'’]$")) & ~s["text"].rlike(r"^[ ,.;:)”»'’]")
        t = F.when(marker(s), F.concat(a["t"], F.lit("{{fn:"), P.strip(s["text"]), F.lit("}}"))).when(ordinal(s), F.concat(a["t"], P.strip(s["text"]))).otherwise(F.concat(a["t"], F.when(gap, " ").otherwise(""), s["text"]))
        return F.struct(t.alias("t"), s["x1"].alias("x1"))

    text = F.aggregate("spans", F.struct(F.lit("").alias("t"), F.lit(None).cast("double").alias("x1")), step, lambda a: P.strip(F.regexp_replace(a["t"], "[ \t  ]+", " ")))
    body = F.filter("spans", lambda s: ~marker(s) & ~ordinal(s))
    weighed = F.transform(body, lambda s: F.struct(F.bround(s["size"], 1).alias("size"), F.length(P.strip(s["text"])).alias("n"), s["bold"].alias("bold")))
    d = found.withColumn("text", text).withColumn("_w", weighed).withColumn("_top", top)
    total = F.aggregate("_w", F.lit(0), lambda a, x: a + x["n"])
    heavy = F.aggregate("_w", F.lit(0), lambda a, x: a + F.when(x["bold"], x["n"]).otherwise(0))
    sizes = F.array_distinct(F.transform("_w", lambda x: x["size"]))
    # the size with most characters, of equal ones the first
    ranked = F.transform(sizes, lambda z, i: F.struct(F.aggregate(F.filter("_w", lambda x: x["size"] == z), F.lit(0), lambda a, x: a + x["n"]).alias("n"), (-i).alias("i"), z.alias("z")))
    d = d.withColumn("size", F.coalesce(F.array_max(ranked)["z"], F.col("_top"))).withColumn("bold", (total > 0) & (heavy / F.greatest(total, F.lit(1)) >= 0.6))
    return d.select("doc_id", "page", "page_h", "text", "x0", "y0", "x1", "y1", "size", "bold").filter("text <> ''")


def page_lines(spans: DataFrame) -> DataFrame:
    """Lines of pages from spans: order within the page ``ix`` and ``gap_before`` (0 for the first)."""
    d = rendered(visual_lines(spans))
    w = Window.partitionBy(*_PAGE).orderBy(F.bround("y0", 0), "x0", "y0", "text")
    return d.withColumn("ix", F.row_number().over(w)).withColumn("gap_before", F.coalesce(F.col("y0") - F.lag("y0").over(w), F.lit(0.0)))


def as_lines(doc_lines: DataFrame) -> DataFrame:
    """The ``doc_lines`` table in the same form; repeated rows of (doc_id, seq) count once, lines without a text are left out."""
    d = doc_lines.filter("doc_id IS NOT NULL AND seq IS NOT NULL AND trim(text) <> ''").withColumn("_r", F.row_number().over(Window.partitionBy("doc_id", "seq").orderBy("page", "text", "y0", "x0")))
    clean = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c)
    return d.filter("_r = 1").select("doc_id", "page", F.col("seq").alias("ix"), "text", clean("x0"), clean("y0"), clean("x1"), clean("y1"), clean("size"), "bold", clean("gap_before"), clean("page_h"))


def settings(documents: DataFrame, layout: dict | None = None) -> DataFrame:
    """doc_id and the layout settings; ``layout`` overrides the defaults, unknown keys are ignored."""
    cfg = DEFAULTS | {k: v for k, v in (layout or {}).items() if k in DEFAULTS}
    typed = {"body_size": F.lit(cfg["body_size"]).cast("double"), "drop_regex": F.array(*map(F.lit, cfg["drop_regex"])).cast("array<string>"), "skip_pages": F.array(*map(F.lit, cfg["skip_pages"])).cast("array<int>")}
    return documents.select("doc_id").distinct().select("doc_id", *[typed.get(k, F.lit(v)).alias(k) for k, v in cfg.items()])


def settings_of(entries: DataFrame) -> DataFrame:
    """doc_id and the layout settings of manifest entries (doc_id, layout as a MAP of texts); defaults where a document gives none, unknown keys are ignored."""

    def value(k: str, default) -> Column:
        given = F.try_element_at("layout", F.lit(k))
        if isinstance(default, list):
            kind = "array<int>" if k == "skip_pages" else "array<string>"
            return F.coalesce(F.from_json(given, kind), F.array().cast(kind))
        if isinstance(default, bool):
            return F.coalesce(F.lower(given) == "true", F.lit(default))
        return F.coalesce(F.expr(f"try_cast(layout['{k}'] AS double)"), F.lit(default).cast("double"))

    return entries.select("doc_id", *[value(k, v).alias(k) for k, v in DEFAULTS.items()])


def _margins(d: DataFrame) -> DataFrame:
    cy = (F.col("y0") + F.col("y1")) / 2
    d = d.withColumn("cy", cy)
    inside = (F.col("cy") < F.col("top_zone") * F.col("page_h")) | (F.col("cy") > (1 - F.col("bottom_zone")) * F.col("page_h"))
    return d.withColumn("in_margin", F.coalesce(inside, F.lit(False)))


def doc_stats(lines: DataFrame, cfg: DataFrame) -> DataFrame:
    """doc_id, n_pages, body_size, p95_len, median_leading, from histograms of sizes, lengths and leadings."""
    d = _margins(lines.join(cfg, "doc_id").filter(~F.array_contains("skip_pages", F.col("page"))))
    pages = lines.groupBy("doc_id").agg(F.max("page").alias("n_pages"))
    hist = d.groupBy("doc_id", F.bround("size", 1).alias("s")).agg(F.sum(F.length("text")).alias("n"), F.min("ix").alias("first"))
    body = hist.filter("s IS NOT NULL").groupBy("doc_id").agg(F.max_by("s", F.struct("n", (-F.col("first")).alias("f"))).alias("mode"))
    body = cfg.select("doc_id", F.col("body_size").alias("_given")).join(body, "doc_id", "left").select("doc_id", F.coalesce("_given", "mode", F.lit(10.0)).alias("body_size"))
    inner = d.drop("body_size").join(body, "doc_id").filter((F.abs(F.col("size") - F.col("body_size")) <= 0.6) & (F.col("cy") > F.col("top_zone") * F.col("page_h")) & (F.col("cy") < (1 - F.col("bottom_zone")) * F.col("page_h")))
    # counts per length and leading first, so that no document's lines meet in one task
    lens = inner.groupBy("doc_id", F.length("text").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    lead = inner.filter((F.col("gap_before") > 0) & (F.col("gap_before") < 3 * F.col("body_size"))).groupBy("doc_id", F.col("gap_before").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    p95 = lens.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("h"), F.sum("n").alias("t")).select("doc_id", _at_rank(F.floor(F.lit(0.95) * (F.col("t") - 1))).cast("double").alias("p95_len"))
    med = lead.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("h"), F.sum("n").alias("t")).select("doc_id", ((_at_rank(F.floor((F.col("t") - 1) / 2)) + _at_rank(F.floor(F.col("t") / 2))) / 2).alias("median_leading"))
    out = pages.join(body, "doc_id").join(p95, "doc_id", "left").join(med, "doc_id", "left")
    return out.select("doc_id", "n_pages", "body_size", F.coalesce("p95_len", F.lit(80.0)).alias("p95_len"), F.coalesce("median_leading", F.col("body_size") * 1.2).alias("median_leading"))


def _at_rank(rank: Column) -> Column:
    """The value at a rank of the histogram ``h`` (v, n)."""
    return F.aggregate("h", F.struct(F.lit(0).cast("bigint").alias("s"), F.lit(None).cast("double").alias("v")), lambda a, x: F.struct((a["s"] + x["n"]).alias("s"), F.when(a["v"].isNull() & (a["s"] + x["n"] > rank), x["v"].cast("double")).otherwise(a["v"]).alias("v")), lambda a: a["v"])


def repeated_margin_lines(lines: DataFrame, cfg: DataFrame) -> DataFrame:
    """doc_id, key, n of lines in the margins found on enough pages of documents of at least four."""
    d = _margins(lines.join(cfg, "doc_id").filter(~F.array_contains("skip_pages", F.col("page"))))
    n = d.filter(F.col("in_margin") & ~F.col("text").rlike(P.DIGITS_ONLY)).groupBy("doc_id", norm_key(F.col("text")).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.max("repeat_threshold").alias("_t"))
    pages = lines.groupBy("doc_id").agg(F.max("page").alias("n_pages"))
    return n.join(pages, "doc_id").filter((F.col("n_pages") >= 4) & (F.col("n") >= F.greatest(F.lit(3), F.floor(F.col("_t") * F.col("n_pages"))))).select("doc_id", "key", "n")


def routed(lines: DataFrame, cfg: DataFrame, stats: DataFrame) -> DataFrame:
    """Lines with ``route``: page_number, running_header_footer, drop_regex, foot (a note) or body; ``reclaimed`` small lines went back to the body.

    Small lines at the foot of a page before the first note label are body, and
    so are all where there is no label.  On pages without notes by geometry the
    first line of the lower part with a note's form, and all after it, are notes.
    """
    d = _margins(lines.join(cfg.drop("body_size"), "doc_id").filter(~F.array_contains("skip_pages", F.col("page"))).join(stats.select("doc_id", "body_size", "p95_len", "median_leading"), "doc_id"))
    again = repeated_margin_lines(lines, cfg).select("doc_id", F.col("key").alias("_key"), F.lit(True).alias("_again"))
    d = d.withColumn("_key", F.when(F.col("in_margin"), norm_key(F.col("text")))).join(again, ["doc_id", "_key"], "left")
    dropped = F.exists("drop_regex", lambda r: F.rlike(F.col("text"), F.concat(F.lit("(?iu)^(?:"), r, F.lit(")"))))
    low = F.col("cy") > F.col("footnote_min_y") * F.col("page_h")
    small = F.col("size") <= F.col("footnote_size_ratio") * F.col("body_size")
    first = (
        F.when(F.col("in_margin") & F.col("text").rlike(P.DIGITS_ONLY), "page_number").when(F.col("_again"), "running_header_footer").when(dropped, "drop_regex")
        .when(F.col("footnote_enabled") & low & small, "foot").otherwise("body")
    )
    d = d.withColumn("_r", first)
    page = Window.partitionBy(*_PAGE)
    label = F.min(F.when((F.col("_r") == "foot") & P.strip(F.col("text")).rlike(NOTE_START), F.col("ix"))).over(page)
    d = d.withColumn("_label", label)
    back = (F.col("_r") == "foot") & (F.col("_label").isNull() | (F.col("ix") < F.col("_label")))
    d = d.withColumn("reclaimed", F.coalesce(back, F.lit(False))).withColumn("_r", F.when(F.col("reclaimed"), "body").otherwise(F.col("_r")))
    kept = F.when(F.col("_r") == "body", F.col("text"))
    after = F.first(kept, ignorenulls=True).over(Window.partitionBy(*_PAGE).orderBy("ix").rowsBetween(1, Window.unboundedFollowing))
    d = d.withColumn("_after", after)
    legal = F.regexp_replace(P.strip(F.regexp_replace(F.col("text"), r"^\{\{fn:\d+\}\}", "")), "^$", "")
    starts = (F.col("_r") == "body") & F.col("footnote_enabled") & low & ((F.col("text").rlike(P.DIGITS_ONLY) & F.coalesce(F.col("_after").rlike(P.LEGAL_START), F.lit(False))) | (F.col("text").rlike(r"^\{\{fn:\d+\}\}") & legal.rlike(P.LEGAL_START)))
    geometry = F.max(F.col("_r") == "foot").over(page)
    d = d.withColumn("_geo", geometry).withColumn("_from", F.min(F.when(starts, F.col("ix"))).over(page))
    text_note = ~F.col("_geo") & (F.col("_r") == "body") & (F.col("ix") >= F.col("_from"))
    route = F.when(F.coalesce(text_note, F.lit(False)), "foot").otherwise(F.col("_r"))
    method = F.when(F.col("_geo"), "geometry").when(F.col("_from").isNotNull(), "text").otherwise("none")
    return d.withColumn("route", route).withColumn("footnote_method", method).select("doc_id", "page", "ix", "text", "x0", "y0", "x1", "y1", "size", "bold", "gap_before", "page_h", "route", "reclaimed", "footnote_method", "enable_glued_fallback", "gap_factor", "body_size", "p95_len", "median_leading")


def body_of(found: DataFrame, defs: DataFrame | None = None) -> DataFrame:
    """Body lines with ``gap_before`` against the kept line before; glued note markers are opened where the document asks for it."""
    b = found.filter("route = 'body'")
    w = Window.partitionBy(*_PAGE).orderBy("ix")
    b = b.withColumn("gap_before", F.coalesce(F.col("y0") - F.lag("y0").over(w), F.lit(0.0)))
    if defs is None:
        return b
    n = F.expr("try_cast(regexp_extract(text, '^([0-9]{1,2})', 1) AS int)")
    b = b.withColumn("_n", F.when(F.col("enable_glued_fallback") & F.col("text").rlike(P.GLUED_MARKER), n))
    b = b.join(defs.select("doc_id", "page", F.col("num").alias("_n"), F.lit(True).alias("_def")).distinct(), [*_PAGE, "_n"], "left")
    present = b.select("doc_id", "page", F.explode(F.regexp_extract_all("text", F.lit(P.PLACEHOLDER), F.lit(1)).cast("array<int>")).alias("_n")).distinct().withColumn("_seen", F.lit(True))
    b = b.join(present, [*_PAGE, "_n"], "left")
    glued = F.col("_def") & F.col("_seen").isNull()
    nth = F.row_number().over(Window.partitionBy(*_PAGE, "_n").orderBy("ix"))
    b = b.withColumn("_nth", F.when(F.coalesce(glued, F.lit(False)), nth))
    opened = F.concat(F.lit("{{fn:"), F.col("_n").cast("string"), F.lit("}}"), F.regexp_replace("text", r"^\d{1,2}", ""))
    return b.withColumn("text", F.when(F.col("_nth") == 1, opened).otherwise(F.col("text"))).drop("_n", "_def", "_seen", "_nth")


def footnote_defs(found: DataFrame) -> DataFrame:
    """Note definitions of pages: doc_id, page, num, text; lines before a label are ignored, a number opened twice goes on."""
    t = P.strip(F.col("text"))
    f = found.filter("route = 'foot'")
    num = F.when(t.rlike(NOTE_PLACEHOLDER), F.regexp_extract(t, NOTE_PLACEHOLDER, 1)).when(t.rlike(P.DIGITS_ONLY), t).when(t.rlike(NOTE_LEGAL), F.regexp_extract(t, NOTE_LEGAL, 1))
    piece = F.when(t.rlike(NOTE_PLACEHOLDER), F.regexp_extract(t, NOTE_PLACEHOLDER, 2)).when(t.rlike(P.DIGITS_ONLY), "").when(t.rlike(NOTE_LEGAL), F.regexp_extract(t, NOTE_LEGAL, 2)).otherwise(t)
    w = Window.partitionBy(*_PAGE).orderBy("ix")
    f = f.withColumn("_p", piece).withColumn("num", F.last(num.cast("int"), ignorenulls=True).over(w)).filter("num IS NOT NULL")
    g = f.groupBy(*_PAGE, "num").agg(F.array_sort(F.collect_list(F.when(F.col("_p") != "", F.struct("ix", "_p")))).alias("_l"))
    return g.select(*_PAGE, "num", P.strip(F.regexp_replace(F.array_join(F.transform("_l", lambda x: x["_p"]), " "), P.PLACEHOLDER, "")).alias("text"))


def page_records(found: DataFrame) -> DataFrame:
    """One row for each page: printed_page (of the last number in a margin), n_lines, dropped, reclaimed, footnote_method."""
    number = F.when(F.col("route") == "page_number", P.strip(F.col("text")).cast("int"))
    return found.groupBy(*_PAGE).agg(
        F.max_by(number, F.when(number.isNotNull(), F.col("ix"))).alias("printed_page"), F.count_if(F.col("route") == "body").alias("n_lines"),
        F.count_if(F.col("route").isin("page_number", "running_header_footer", "drop_regex")).alias("dropped"), F.count_if("reclaimed").alias("reclaimed"), F.max("footnote_method").alias("footnote_method"),
    )


def outside_tables(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """Lines that lie in no table's box (2 points of tolerance): a spatial anti join within the page."""
    t = tables.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "page", "x0", "y0", "x1", "y1")])
    cy = (F.col("y0") + F.col("y1")) / 2
    inside = (F.col("doc_id") == F.col("_doc_id")) & (F.col("page") == F.col("_page")) & (F.col("x0") >= F.col("_x0") - 2) & (F.col("x1") <= F.col("_x1") + 2) & cy.between(F.col("_y0") - 2, F.col("_y1") + 2)
    return lines.join(t, inside, "left_anti")


def good_tables(tables: DataFrame) -> DataFrame:
    """Tables with at least two rows, two columns and 40 % of their cells filled; cells with single blanks."""
    cells = F.flatten("rows")
    width = F.array_max(F.transform("rows", lambda r: F.size(r)))
    filled = F.size(F.filter(cells, lambda c: c.isNotNull() & (P.strip(c) != "")))
    tidy = F.transform("rows", lambda r: F.transform(r, lambda c: P.strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))))
    return tables.filter((F.size("rows") >= 2) & (width >= 2) & (filled / F.greatest(F.size(cells), F.lit(1)) >= 0.4)).withColumn("rows", tidy)


def markdown_table(rows: Column) -> Column:
    """ARRAY of the Markdown lines of a table; short rows are padded, bars escaped."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    bars = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))), lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |"))
    ruler = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    lines = F.transform(rows, bars)
    return F.concat(F.slice(lines, 1, 1), F.array(ruler), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))))
