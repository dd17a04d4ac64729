"""Raw Markdown lines to clean lines: paragraphs, bracket tables, blanks.

Input and output are ordered relations ``(doc_id, seq, text)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.functions import patterns as P
from juriflow.functions import text as T
from juriflow.operators.ordered import neighbours, running_last, running_sum
from juriflow.session import stored

#: The header of a bracket table.
TABLE_HEAD = ["| Tranche (FCFA) | Taux |", "| --- | --- |"]


def nearest_rank(values: Column, share: float) -> Column:
    """The value at index floor(share * (n - 1)) of the sorted values; NULL of none."""
    return F.get(F.array_sort(values), F.floor(F.lit(share) * (F.size(values) - 1)).cast("int"))


def line_length_p95(md_lines: DataFrame, default: float = 80.0) -> DataFrame:
    """doc_id, p95: nearest-rank length of the lines that are no markup; the default where there are none.

    Lengths are counted per document and length, so the aggregate is as small as a document has lengths.
    """
    plain = (F.length("text") > 0) & ~F.col("text").rlike(r"^(?:#|<!--|\[\^|\*\*)")
    n = md_lines.groupBy("doc_id", F.when(plain, F.length("text")).alias("len")).agg(F.count(F.lit(1)).alias("n"))
    per = n.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(F.col("len").isNotNull(), F.struct("len", "n")))).alias("h"), F.sum(F.when(F.col("len").isNotNull(), F.col("n"))).alias("total"))
    rank = F.floor(F.lit(0.95) * (F.col("total") - 1))
    found = F.aggregate("h", F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("v")), lambda s, x: F.struct((s["seen"] + x["n"]).alias("seen"), F.when(s["v"].isNull() & (s["seen"] + x["n"] > rank), x["len"]).otherwise(s["v"]).alias("v")), lambda s: s["v"])
    return per.select("doc_id", F.coalesce(found.cast("double"), F.lit(default)).alias("p95"))


def classified(lines: DataFrame) -> DataFrame:
    """Adds ``line`` (stripped, bullets normal) and ``kind``: blank, pg, bracket, row, punct, struct or text."""
    s = P.strip(F.coalesce("text", F.lit("")))
    d = lines.withColumn("_s", s)
    c = F.col("_s")
    kind = (
        F.when(c == "", "blank").when(c.rlike(P.PAGE_MARK_LINE), "pg").when(c.rlike(P.BRACKET_ROW) | c.rlike(P.BRACKET_LAST), "bracket")
        .when(c.startswith("|"), "row").when(c.rlike(P.LONE_PUNCT), "punct")
        .when(c.startswith("#") | c.rlike(P.ART_MARK_LINE) | c.rlike(P.NOTE_DEF) | c.rlike(P.BOLD_LINE), "struct").otherwise("text")
    )
    d = d.withColumn("kind", kind)
    return d.withColumn("line", F.when(F.col("kind") == "text", T.normalize_bullet(c)).otherwise(c)).drop("_s")


def paragraph_bounds(lines: DataFrame, p95: DataFrame) -> DataFrame:
    """Adds ``block``: lines of one paragraph, or of one bracket run, share it; page marks and lone punctuation get NULL.

    A text line opens a paragraph if none is open, if it starts an article,
    caption or list item, or if the line before it closes a sentence, is
    shorter than 0.9 of the document's line length, and it starts like a
    sentence.
    """
    d = classified(lines)
    ordinary = d.filter(~F.col("kind").isin("pg", "punct")).join(p95, "doc_id", "left")
    ordinary = neighbours(ordinary, ["doc_id"], "seq", before={"pk": F.col("kind"), "pl": F.col("line")})
    line, prev = F.col("line"), F.col("pl")
    starts = line.startswith("**Art.") | line.rlike(P.TABLE_CAPTION) | line.rlike(P.LIST_START)
    closed = prev.rlike("[.!?:»]$") & (F.length(prev) < F.col("p95") * 0.9) & line.rlike(r"^[\p{Lu}«(]")
    opens = F.when(F.col("kind") == "text", (F.coalesce(F.col("pk"), F.lit("")) != "text") | starts | closed).when(F.col("kind") == "bracket", F.coalesce(F.col("pk"), F.lit("")) != "bracket").otherwise(F.lit(True))
    out = running_sum(ordinary, ["doc_id"], "seq", {"block": F.coalesce(opens, F.lit(True)).cast("int")}).drop("pk", "pl", "p95")
    rest = d.filter(F.col("kind").isin("pg", "punct")).withColumn("block", F.lit(None).cast("bigint"))
    return out.unionByName(rest)


def blocks(lines: DataFrame, p95: DataFrame) -> DataFrame:
    """Blocks in order: doc_id, seq (of the first line), kind, text lines ``out`` and ``joined``, the text before its corrections.

    Page marks inside a paragraph stay in its text; other marks are blocks of
    their own before the next block.  Lone punctuation is attached to the open
    paragraph's line before it, and dropped where none is open.
    """
    d = paragraph_bounds(lines, p95)
    d = running_last(d, ["doc_id"], "seq", {"_b": F.when(F.col("block").isNotNull(), F.struct("block", "kind"))})
    # the next line that is in a block decides whether a mark lies inside a paragraph
    # (looked up backwards: a frame that ends at the document's end is computed anew for each row)
    after = Window.partitionBy("doc_id").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, 0)
    d = stored(d.withColumn("_n", F.last("block", ignorenulls=True).over(after)))
    inside = (F.col("kind") == "pg") & (F.col("_b.block") == F.col("_n")) & (F.col("_b.kind") == "text")
    punct = (F.col("kind") == "punct") & (F.col("_b.kind") == "text")
    d = d.withColumn("_g", F.when(F.col("block").isNotNull(), F.col("block")).when(F.coalesce(inside | punct, F.lit(False)), F.col("_b.block")))
    marks = d.filter((F.col("kind") == "pg") & F.col("_g").isNull()).select("doc_id", "seq", F.lit("pg").alias("kind"), F.array("line").alias("out"))
    members = d.filter(F.col("_g").isNotNull() & (F.col("kind") != "blank"))
    g = members.groupBy("doc_id", "_g").agg(F.min("seq").alias("seq"), F.max(F.when(~F.col("kind").isin("pg", "punct"), F.col("kind"))).alias("kind"), F.array_sort(F.collect_list(F.struct("seq", "kind", F.col("line").alias("text")))).alias("_items"))
    one = F.element_at("_items", 1)["text"]
    # punctuation goes to the text line before it, page marks between stay where they are
    def attach(acc: Column, x: Column) -> Column:
        last = F.array_max(F.transform(acc, lambda y, i: F.when(y["kind"] != "pg", i)))
        glued = F.transform(acc, lambda y, i: F.when(i == last, F.struct(y["kind"].alias("kind"), F.concat(y["text"], F.lit(" "), x["text"]).alias("text"))).otherwise(y))
        return F.when(x["kind"] == "punct", glued).otherwise(F.concat(acc, F.array(F.struct(x["kind"].alias("kind"), x["text"].alias("text")))))

    none = F.array().cast("array<struct<kind:string,text:string>>")
    plain = F.transform("_items", lambda x: F.struct(x["kind"].alias("kind"), x["text"].alias("text")))
    items = F.when(F.exists("_items", lambda x: x["kind"] == "punct"), F.aggregate("_items", none, attach)).otherwise(plain)
    table = F.concat(F.array(*map(F.lit, TABLE_HEAD)), F.transform("_items", lambda x: bracket_line(x["text"])))
    # the text before the last corrections, NULL where none are made
    g = g.withColumn("joined", F.when(F.col("kind") == "text", T.join_items(items)).when(one.startswith("#"), one))
    out = F.when(F.col("kind") == "bracket", table).when(F.col("joined").isNotNull(), F.array(T.fix_text(F.col("joined")))).otherwise(F.array(one))
    return g.select("doc_id", "seq", "kind", "joined", out.alias("out")).unionByName(marks.withColumn("joined", F.lit(None).cast("string")))


def bracket_line(row: Column) -> Column:
    """A bracket row as a line of a Markdown table."""
    b = P.bracket(row)
    lo = F.when(b["hi"].isNotNull(), F.concat(F.lit("de "), b["lo"], F.lit(" à "), b["hi"])).otherwise(F.concat(F.lit("plus de "), b["lo"]))
    return F.concat(F.lit("| "), lo, F.lit(" | "), b["rate"], F.lit(" |"))


def spaced(found: DataFrame) -> DataFrame:
    """Clean lines (doc_id, seq, text) with single blank lines between blocks, none between rows of a table, list items, or after marks."""
    first, last = F.element_at("out", 1), F.element_at("out", -1)
    d = neighbours(found, ["doc_id"], "seq", before={"pk": F.col("kind"), "pt": last})
    tight = F.col("pk").isNull() | (F.col("pk") == "pg") | F.col("pt").rlike(P.ART_MARK_LINE) | ((F.col("pk") == "row") & (F.col("kind") == "row")) | (F.col("pt").startswith("- ") & first.startswith("- "))
    rows = d.select("doc_id", "seq", F.when(tight, F.col("out")).otherwise(F.concat(F.array(F.lit("")), F.col("out"))).alias("_o")).select("doc_id", "seq", F.posexplode("_o").alias("_i", "text"))
    # an order number that leaves room for each block's lines
    n = rows.groupBy("doc_id", "seq").agg(F.count(F.lit(1)).alias("_n"))
    starts = running_sum(n, ["doc_id"], "seq", {"_end": F.col("_n")}).select("doc_id", "seq", (F.col("_end") - F.col("_n")).alias("_at"))
    return rows.join(starts, ["doc_id", "seq"]).select("doc_id", (F.col("_at") + F.col("_i")).cast("bigint").alias("seq"), "text")


def reflow(md_lines: DataFrame, p95: DataFrame | None = None) -> DataFrame:
    """Clean lines of raw Markdown lines; NULL texts are blank lines, repeated rows of one (doc_id, seq) are taken once.

    ``p95``: doc_id, p95; computed where it is not given.
    """
    rows = md_lines.select("doc_id", F.col("seq").cast("bigint").alias("seq"), T.normalize_chars(F.coalesce("text", F.lit(""))).alias("text")).dropDuplicates(["doc_id", "seq"])
    # blocks are read for their lines and for their places
    return spaced(stored(blocks(rows, p95 if p95 is not None else line_length_p95(rows)).drop("joined")))


def passthrough(md_lines: DataFrame) -> DataFrame:
    """Clean lines of Markdown that is structured already: corrections and bullets only, marks and tables as they are."""
    rows = md_lines.select("doc_id", "seq", P.strip(T.normalize_chars(F.coalesce("text", F.lit("")))).alias("text"))
    rows = neighbours(rows, ["doc_id"], "seq", before={"pt": F.col("text")}).filter((F.col("text") != "") | (F.col("pt") != "")).drop("pt")
    t = F.col("text")
    verbatim = t.startswith("|") | t.rlike(P.PAGE_MARK_LINE) | t.rlike(P.ART_MARK_LINE)
    return rows.select("doc_id", "seq", F.when(verbatim, t).otherwise(T.fix_text(T.normalize_bullet(t))).alias("text"))


def clean(md_lines: DataFrame, documents_meta: DataFrame) -> DataFrame:
    """Clean lines, by the document's ``structured_markdown`` and with its ``p95_len`` where it is known and not 0."""
    meta = documents_meta.groupBy("doc_id").agg(F.max(F.coalesce("structured_markdown", F.lit(False))).alias("_sm"), F.max(F.nullif(F.col("p95_len"), F.lit(0))).alias("_p"))
    d = md_lines.join(meta, "doc_id", "left").withColumn("_sm", F.coalesce("_sm", F.lit(False)))
    flowing = d.filter(~F.col("_sm")).select("doc_id", "seq", "text")
    known = line_length_p95(flowing).join(meta, "doc_id", "left").select("doc_id", F.coalesce(F.col("_p").cast("double"), "p95").alias("p95"))
    return reflow(flowing, known).unionByName(passthrough(d.filter("_sm").select("doc_id", F.col("seq").cast("bigint").alias("seq"), "text")))


def hyphens(md_lines: DataFrame, p95: DataFrame) -> DataFrame:
    """Every word broken at a line's end inside of a paragraph: doc_id, seq (of the next line), how ('kept' or 'joined'), text."""
    rows = paragraph_bounds(normalized(md_lines), p95).filter("block IS NOT NULL AND kind = 'text'")
    rows = neighbours(rows, ["doc_id"], "seq", before={"_pl": F.col("line"), "_pb": F.col("block")}).filter((F.col("_pb") == F.col("block")) & F.col("_pl").rlike(r"[\p{L}\p{N}]-$"))
    word, first = F.regexp_extract("_pl", r"(?U)([\w']+)-$", 1), F.split("line", " ")[0]
    return rows.select("doc_id", "seq", T.hyphen_decision(F.col("_pl"), F.col("line")).alias("how"), F.concat(F.lower(word), F.lit("-|"), first).alias("text"))


def normalized(md_lines: DataFrame) -> DataFrame:
    """doc_id, seq and the normalised text; repeated rows of one place count once."""
    return md_lines.select("doc_id", F.col("seq").cast("bigint").alias("seq"), T.normalize_chars(F.coalesce("text", F.lit(""))).alias("text")).dropDuplicates(["doc_id", "seq"])


def clean_events(md_lines: DataFrame, p95: DataFrame | None = None) -> DataFrame:
    """What cleaning does, per document: doc_id, seq, key, n, sample.

    Keys: ligature_fixed, replacement_char, lone_punct_attached,
    bullet_normalized (by line); hyphen_kept, hyphen_joined (by broken word);
    glued_compound_fixed, ordinal_fixed, spacing_fixed (by paragraph or title);
    bareme_table_built (by table).
    """
    raw = md_lines.select("doc_id", F.col("seq").cast("bigint").alias("seq"), F.coalesce("text", F.lit("")).alias("raw")).dropDuplicates(["doc_id", "seq"])
    rows = normalized(md_lines)
    p95 = p95 if p95 is not None else line_length_p95(rows)
    event = lambda n, key, sample: F.when(n > 0, F.struct(F.lit(key).alias("key"), n.cast("bigint").alias("n"), sample.alias("sample")))
    none, one = F.lit(None).cast("string"), lambda c: c.cast("int")
    kinds = sum((one(F.col("raw").contains(k)) for k in T.LIGATURES), F.lit(0))
    c = classified(rows).join(raw.filter(kinds > 0).select("doc_id", "seq", kinds.alias("_lig")), ["doc_id", "seq"], "left")
    s = P.strip(F.col("text"))
    lines = c.select("doc_id", "seq", F.inline(F.array_compact(F.array(
        event(F.coalesce("_lig", F.lit(0)), "ligature_fixed", none), event(one(F.col("text").contains("\ufffd")), "replacement_char", F.substring("text", 1, 80)),
        event(one(F.col("kind") == "punct"), "lone_punct_attached", s), event(one((F.col("kind") == "text") & F.col("line").startswith("- ") & ~s.startswith("-")), "bullet_normalized", F.substring(s, 1, 40)),
    ))))
    broken = hyphens(md_lines, p95).select("doc_id", "seq", F.concat(F.lit("hyphen_"), "how").alias("key"), F.lit(1).cast("bigint").alias("n"), F.col("text").alias("sample"))
    b = blocks(rows, p95)
    counts = T.fix_counts(F.col("joined"))
    fixes = b.filter("joined IS NOT NULL").select("doc_id", "seq", F.explode(counts).alias("key", "_n")).filter("_n > 0").select("doc_id", "seq", "key", F.col("_n").cast("bigint").alias("n"), none.alias("sample"))
    tables = b.filter("kind = 'bracket'").select("doc_id", "seq", F.lit("bareme_table_built").alias("key"), F.lit(1).cast("bigint").alias("n"), F.concat((F.size("out") - 2).cast("string"), F.lit(" lignes")).alias("sample"))
    return lines.unionByName(broken).unionByName(fixes).unionByName(tables)
