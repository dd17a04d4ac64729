"""Clean Markdown lines to units: articles, rulings, sections.

Lines are classified, unit ids are running sums of the lines that open or close
a unit, and the hierarchy is a running last value per level; all are taken in
one pass over buckets of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriflow.functions import patterns as P
from juriflow.functions.text import clean_text
from juriflow.operators.ordered import running, running_sum

#: A Markdown heading, and the heading of a ruling.
HEADING = r"(?U)^(#{1,6})\s+(.*\S)\s*$"
RULING = r"(?U)^R\s?(\d{1,3})\s*[:\-–]\s*(.+)$"
BOLD = r"(?U)^\*\*(.+?)\*\*\s*$"


def unit_lines(clean_lines: DataFrame, documents: DataFrame) -> DataFrame:
    """Every line with its unit: unit (NULL outside), opens, kind, key, utitle, hier (on opening lines), page_before, page_after, role.

    ``documents``: doc_id, doc_type ('code', 'rescrits', else generic),
    first_page.  role: blank, page, heading, open, close, note, text.
    """
    d = clean_lines.select("doc_id", "seq", F.coalesce("text", F.lit("")).alias("text")).join(documents.select("doc_id", F.coalesce("doc_type", F.lit("generic")).alias("doc_type"), F.coalesce("first_page", F.lit(1)).alias("first_page")).dropDuplicates(["doc_id"]), "doc_id")
    s = P.strip(F.col("text"))
    d = d.withColumn("s", s)
    s = F.col("s")
    code, rulings = F.col("doc_type") == "code", F.col("doc_type") == "rescrits"
    generic = ~code & ~rulings
    level, title = F.length(F.regexp_extract(s, HEADING, 1)), P.strip(F.regexp_extract(s, HEADING, 2))
    bold = P.strip(F.regexp_extract(s, BOLD, 1))
    is_bold = s.rlike(BOLD)
    role = (
        F.when(s == "", "blank").when(s.rlike(P.PAGE_MARK_LINE), "page")
        .when(s.rlike(HEADING), F.when(rulings & (level >= 2) & title.rlike(RULING), "ruling").otherwise("heading"))
        .when(code & s.rlike(P.ART_MARK_LINE), "article").when(code & is_bold & bold.rlike(P.SUBHEADING), "sub")
        .when(s.rlike(P.NOTE_DEF), "note").when(generic & is_bold, "bold").otherwise("text")
    )
    d = d.withColumn("role", role).withColumn("level", F.when(F.col("role") == "heading", level)).withColumn("htitle", F.when(F.col("role").isin("heading", "ruling"), title).when(F.col("role").isin("sub", "bold"), bold))
    marks = F.regexp_extract_all(s, F.lit(P.PAGE_MARK), F.lit(1))
    d = d.withColumn("_pg", F.when(F.size(marks) > 0, F.element_at(marks, -1).cast("int")))
    lev = F.col("level")
    # a heading sets its level and clears the deeper ones
    cols = {f"_h{k}": F.when(lev == k, F.struct(F.col("htitle").alias("t"))).when(lev < k, F.struct(F.lit(None).cast("string").alias("t"))) for k in range(1, 7)}
    cols["_sub"] = F.when(F.col("role") == "sub", F.struct(F.col("htitle").alias("t"))).when(F.col("role") == "heading", F.struct(F.lit(None).cast("string").alias("t")))
    opening = F.col("role").isin("article", "ruling", "bold") | ((F.col("role") == "heading") & generic)
    closing = F.col("role").isin("sub") | ((F.col("role") == "heading") & ~generic)
    cols["page_after"] = F.col("_pg")
    cols["_page_line"] = F.when(F.col("role") == "page", F.col("_pg"))
    # in a generic document loose text before any title opens a section: only its first line
    d = d.withColumns({"_opening": opening, "_closing": closing})
    firsts = d.filter(generic).groupBy("doc_id").agg(F.min(F.when(F.col("_opening") | F.col("_closing"), F.col("seq"))).alias("_event1"), F.min(F.when(F.col("role") == "text", F.col("seq"))).alias("_text1"))
    d = d.join(firsts, "doc_id", "left")
    loose = (F.col("seq") == F.col("_text1")) & (F.col("_event1").isNull() | (F.col("_text1") < F.col("_event1")))
    d = d.withColumn("opens", F.coalesce(F.col("_opening") | loose, F.lit(False)))
    event = F.col("opens") | F.col("_closing")
    cols["_open"] = F.when(event, F.col("opens"))
    d = running(d.drop("_event1", "_text1"), "seq", cols, {"_unit": event.cast("int")})
    names = F.when(code, F.array(*map(F.lit, P.LEVELS))).otherwise(F.array(*[F.lit(f"h{i}") for i in range(1, 7)]))
    entries = [F.when(F.col(f"_h{k}.t").isNotNull(), F.struct(F.get(names, F.lit(k - 1)).alias("k"), F.col(f"_h{k}.t").alias("v"))) for k in range(1, 7)]
    entries.append(F.when(F.col("_sub.t").isNotNull(), F.struct(F.lit("sous").alias("k"), F.col("_sub.t").alias("v"))))
    kind = F.when(F.col("role") == "article", "article").when(F.col("role") == "ruling", "rescrit").otherwise("section")
    key = F.when(F.col("role") == "article", F.regexp_extract("s", P.ART_MARK, 1)).when(F.col("role") == "ruling", F.regexp_extract("htitle", RULING, 1)).otherwise("")
    utitle = F.when(F.col("role") == "ruling", P.strip(F.regexp_extract("htitle", RULING, 2))).when(F.col("role") == "bold", F.col("htitle")).otherwise("")
    # a mark within a line counts only after that line
    before = F.when((F.col("role") != "page") & F.col("_pg").isNotNull(), F.col("_page_line")).otherwise(F.col("page_after"))
    return d.select(
        "doc_id", "seq", "text", "s", "doc_type", "role", "opens", F.when(F.coalesce("_open", F.lit(False)), F.col("_unit")).alias("unit"),
        kind.alias("kind"), key.alias("key"), utitle.alias("utitle"), F.when(F.col("opens"), F.array_compact(F.array(*entries))).alias("hier"),
        F.coalesce(before, "first_page").alias("page_before"), F.coalesce("page_after", "first_page").alias("page_after"),
    )


def units(clean_lines: DataFrame, documents: DataFrame) -> DataFrame:
    """Units: doc_id, unit_ix (from 0, order of the text), kind, key, title, hier, text (clean), footnotes, page_start, page_end.

    Of a note defined twice in a unit the last definition counts.  Text outside
    of units is in ``outside_lines``.
    """
    d = unit_lines(clean_lines, documents).filter("unit IS NOT NULL")
    is_text, is_note = F.col("role") == "text", F.col("role") == "note"
    line = F.when(is_text | (F.col("role") == "blank"), F.struct("seq", F.when(is_text, F.regexp_replace("text", r"(?U)\s+$", "")).otherwise("").alias("t")))
    note = F.when(is_note, F.struct("seq", F.regexp_extract("s", P.NOTE_DEF, 1).alias("id"), P.strip(F.regexp_extract("s", P.NOTE_DEF, 2)).alias("t")))
    head = F.when(F.col("opens"), F.struct("seq", "kind", "key", "utitle", "hier", F.col("page_before").alias("page")))
    g = d.groupBy("doc_id", "unit").agg(
        F.array_sort(F.collect_list(line)).alias("_l"), F.array_sort(F.collect_list(note)).alias("_n"), F.min(head).alias("_h"),
        F.max(F.when(is_text, F.col("page_after"))).alias("_end"), F.first("doc_type").alias("doc_type"),
    )
    # the place of a note is that of its first definition, its text that of the last
    ids = F.array_distinct(F.transform("_n", lambda x: x["id"]))
    notes = F.transform(ids, lambda i: F.struct(i.alias("id"), F.element_at(F.filter("_n", lambda x: x["id"] == i), -1)["t"].alias("text")))
    g = g.select("doc_id", "unit", "doc_type", "_h.*", clean_text(F.array_join(F.transform("_l", lambda x: x["t"]), "\n")).alias("body"), notes.alias("footnotes"), "_end")
    g = running_sum(g, ["doc_id"], "seq", {"_ix": F.lit(1)})
    return g.select("doc_id", (F.col("_ix") - 1).cast("int").alias("unit_ix"), "doc_type", "kind", "key", F.col("utitle").alias("title"), "hier", F.col("body").alias("text"), "footnotes", F.col("page").alias("page_start"), F.greatest("page", F.coalesce("_end", "page")).alias("page_end"))


def outside_lines(clean_lines: DataFrame, documents: DataFrame) -> DataFrame:
    """Text lines that belong to no unit: doc_id, seq, text."""
    return unit_lines(clean_lines, documents).filter("unit IS NULL AND role = 'text'").select("doc_id", "seq", F.col("s").alias("text"))


def merge_small_units(found: DataFrame, least: int = 250) -> DataFrame:
    """Generic documents: a unit under ``least`` characters joins the next one of equal hierarchy; units without text go.

    The absorbing unit keeps its title.  The last unit of a document, if too
    small, joins the one before it of equal hierarchy.  Units of one run of
    equal hierarchy are folded together; other documents pass unchanged.
    """
    from juriflow.operators.ordered import neighbours

    generic = ~F.col("doc_type").isin("code", "rescrits")
    rest, rows = found.filter(~generic), found.filter(generic & (F.col("text") != ""))
    rows = neighbours(rows, ["doc_id"], "unit_ix", before={"_ph": F.col("hier")}, after={"_nh": F.col("hier")})
    rows = running_sum(rows, ["doc_id"], "unit_ix", {"_run": (~F.col("hier").eqNullSafe(F.col("_ph"))).cast("int")})
    runs = rows.groupBy("doc_id", "_run").agg(F.array_sort(F.collect_list(F.struct("unit_ix", "text", "title", "kind", "key", "page_start", "page_end", "footnotes", F.col("_nh").isNull().alias("last")))).alias("_u"), F.first("hier").alias("hier"), F.first("doc_type").alias("doc_type"))
    kind = "struct<unit_ix:int,kind:string,key:string,title:string,text:string,footnotes:array<struct<id:string,text:string>>,page_start:int,page_end:int>"
    fields = ["unit_ix", "kind", "key", "title", "text", "footnotes", "page_start", "page_end"]
    pick = lambda x: F.struct(*[x[f].alias(f) for f in fields])

    def absorbed(a, u):
        return F.struct(u["unit_ix"].alias("unit_ix"), u["kind"].alias("kind"), u["key"].alias("key"), u["title"].alias("title"), F.concat(a["text"], F.lit("\n\n"), u["text"]).alias("text"), u["footnotes"].alias("footnotes"), F.least(a["page_start"], u["page_start"]).alias("page_start"), u["page_end"].alias("page_end"))

    def step(s, x):
        u = F.when(s["carry"].isNotNull(), absorbed(s["carry"], x)).otherwise(pick(x))
        small = F.length(u["text"]) < least
        return F.struct(F.when(small, s["out"]).otherwise(F.concat(s["out"], F.array(u))).alias("out"), F.when(small, u).alias("carry"), x["last"].alias("last"))

    def finish(s):
        n = F.size(s["out"])
        prev = F.get(s["out"], n - 1)
        c = s["carry"]
        tail = F.struct(prev["unit_ix"].alias("unit_ix"), prev["kind"].alias("kind"), prev["key"].alias("key"), prev["title"].alias("title"), F.concat(prev["text"], F.lit("\n\n"), c["text"]).alias("text"), prev["footnotes"].alias("footnotes"), prev["page_start"].alias("page_start"), F.greatest(prev["page_end"], c["page_end"]).alias("page_end"))
        return F.when(c.isNull(), s["out"]).when(s["last"] & (n > 0), F.concat(F.slice(s["out"], F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(tail))).otherwise(F.concat(s["out"], F.array(c)))

    start = F.struct(F.array().cast(f"array<{kind}>").alias("out"), F.lit(None).cast(kind).alias("carry"), F.lit(False).alias("last"))
    merged = runs.select("doc_id", "doc_type", "hier", F.inline(F.aggregate("_u", start, step, finish)))
    return rest.unionByName(merged.select(*rest.columns))
