"""Pattern library: predicates and extractors as ``Column -> Column`` functions.

Ignoring case needs ``(?iu)`` and Unicode classes ``(?U)`` in Java.  All
extractors give NULL where nothing matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words, marks and forms of French codes that the results depend on.
ORDINAL_M = "PREMIER|SECOND|DEUXI[ÈE]ME|TROISI[ÈE]ME|QUATRI[ÈE]ME|CINQUI[ÈE]ME|SIXI[ÈE]ME|SEPTI[ÈE]ME|HUITI[ÈE]ME|NEUVI[ÈE]ME|DIXI[ÈE]ME"
ORDINAL_F = "PREMI[ÈE]RE|DEUXI[ÈE]ME|TROISI[ÈE]ME|QUATRI[ÈE]ME|CINQUI[ÈE]ME|SIXI[ÈE]ME|SEPTI[ÈE]ME|HUITI[ÈE]ME|NEUVI[ÈE]ME|DIXI[ÈE]ME"
LEVELS = ["livre", "partie", "titre", "chapitre", "section", "paragraphe"]
LATIN_RANK = {"bis": 1, "ter": 2, "quater": 3, "quinquies": 4, "sexies": 5, "septies": 6, "octies": 7, "nonies": 8, "decies": 9}
MONTHS = "janvier|février|fevrier|mars|avril|mai|juin|juillet|août|aout|septembre|octobre|novembre|décembre|decembre"
ORDINAL_SUFFIXES = ["er", "ère", "re", "e", "ème", "eme", "èmes", "emes", "nd", "nde", "ers", "ères"]
BULLETS = "-•·▪‣₋–—*\\uf0b7●"
LEGAL_KINDS = "Loi|Ordonnance|D[ée]cret|Arr[êe]t[ée]|Directive|R[èe]glement"

_N, _SEP = r"[IVXLC]+|\d+", "[:\\-–—]"
_TAIL = rf"(?:\s*{_SEP}\s*(.*))?$"
HEADINGS = [
    rf"(?iuU)^LIVRE\s+({ORDINAL_M}|{_N})\b{_TAIL}",
    rf"(?iuU)^({ORDINAL_F}|(?:{_N})(?:[ÈE]RE|[ÈE]ME)?)\s+PARTIE\b{_TAIL}",
    rf"(?iuU)^TITRE\s+({ORDINAL_M}|{_N})\b{_TAIL}",
    rf"(?iuU)^CHAPITRE\s+({ORDINAL_M}|{_N})\b{_TAIL}",
    rf"(?iuU)^SECTION\s+({_N})\s*{_SEP}\s*(.*)$",
    rf"(?iuU)^PARAGRAPHE\s+({_N})\s*{_SEP}\s*(.*)$",
]
SUBHEADING = r"(?U)^(?:I{1,3}|IV|VI{0,3}|IX|X|[A-H])\s*[-–—]\s*\S.{2,90}$"
ARTICLE_START = r"(?U)^Art(?:icle)?s?\.?\s*(premier|1er|\d{1,3}(?:\s?(?:bis|ter|quater|quinquies))?(?:-\d{1,2})?)\s*(?:er)?\s*(?::|[.\-–](?=\s))\s*(.*)$"
RULING_START = r"(?U)^R\s?(\d{1,3})\s*[:\-–]\s*(.+)$"
DIGITS_ONLY = r"(?U)^\s*\d{1,4}\s*$"
LEGAL_START = rf"(?U)^(?:{LEGAL_KINDS})\b"
GLUED_MARKER = r"^(\d{1,2})(?=(?:Art\.|[A-ZÉÈÀÂ][a-zà-ÿ]+|\d{1,2}\s*[-–]\s*\S))"
LIST_START = rf"(?U)^(?:[{BULLETS}]\s+|\d{{1,2}}\s*[).]\s+|\d{{1,2}}\s*[-–—]\s*\S|\d{{1,2}}°\s|[a-z]\)\s*|[ivx]{{1,4}}\)\s*)"
LONE_PUNCT = r"(?U)^\s*[:;,.]\s*$"
_RATE = r"(\d+(?:[.,]\d+)?\s?%|exon[ée]r[ée]e?s?|n[ée]ant)"
BRACKET_ROW = rf"(?iuU)^de\s+(\d[\d\s]*?)\s+[Aà]\s+(\d[\d\s]*?)\s+{_RATE}\s*$"
BRACKET_LAST = rf"(?iuU)^(?:plus de|au-del[àa] de|sup[ée]rieure? [àa])\s+(\d[\d\s]*?)\s+{_RATE}\s*$"
TABLE_CAPTION = r"(?iuU)^Tableau\s+\d+\s*:"
PAGE_MARK, PAGE_MARK_LINE = r"<!--pg:(\d+)-->", r"^<!--pg:(\d+)-->$"
ART_MARK, ART_MARK_LINE = r"<!--art:([^\s>]+)-->", r"^<!--art:([^\s>]+)-->$"
NOTE_DEF = r"(?U)^\[\^(fn\d+)\]:\s*(.*)$"
NOTE_REF = r"\[\^(fn\d+)\]"
PLACEHOLDER = r"\{\{fn:(\d+)\}\}"
BOLD_LINE = r"^\*\*[^*]+\*\*$"
_ART = r"\d{1,3}(?:-[a-z0-9]{1,2})?"
TARGETS = r"CGI|LPF|C\.G\.I\.?|L\.P\.F\.?|Code G[ée]n[ée]ral des Imp[ôo]ts|Livre des Proc[ée]dures Fiscales|pr[ée]sent code|pr[ée]sent livre|code des investissements|code des douanes|code du travail|code civil"
REFERENCE = rf"(?iuU)\bart(?:icles?|\.)\s*({_ART}(?:\s*(?:,|et|à|au)\s*{_ART})*)(?:\s+(?:du|de la|des|dudit)\s+({TARGETS}))?"
LAW = r"(?iuU)\b(Loi|Ordonnance|D[ée]cret|Arr[êe]t[ée])\s+N°\s*([\w./-]+?)\s+du\s+(\d{1,2}(?:er)?\s+[A-Za-zéèûôàç]+\s+\d{4})"
EXERCICE = r"(?iuU)Exercice\s+(\d{4})"


def extract(col: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, NULL where the pattern does not match; an absent group is ''."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def heading(col: Column) -> Column:
    """STRUCT<level, kind, num, title> of a heading line, by the first of the six forms that matches; else NULL."""
    out = None
    for i, (kind, p) in enumerate(zip(LEVELS, HEADINGS, strict=True)):
        s = F.struct(F.lit(i + 1).alias("level"), F.lit(kind).alias("kind"), F.regexp_extract(col, p, 1).alias("num"), strip(F.regexp_extract(col, p, 2)).alias("title"))
        out = F.when(col.rlike(p), s) if out is None else out.when(col.rlike(p), s)
    return out


def strip(col: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def heading_label(kind: Column, num: Column) -> Column:
    """The label of a heading: kind and number."""
    up = F.upper(num)
    return F.when(kind == "partie", F.concat(up, F.lit(" PARTIE"))).when(kind.isin("livre", "titre", "chapitre"), F.concat(F.upper(kind), F.lit(" "), up)).otherwise(F.concat(F.initcap(kind), F.lit(" "), num))


def article_id(raw: Column) -> Column:
    """Lower case without spaces; 'premier' and '1er' are '1'."""
    a = F.replace(F.lower(strip(raw)), F.lit(" "))
    return F.when(a.isin("premier", "1er"), F.lit("1")).otherwise(a)


def article_start(col: Column) -> Column:
    """STRUCT<id, rest> of a line that opens an article; else NULL."""
    return F.when(col.rlike(ARTICLE_START), F.struct(article_id(F.regexp_extract(col, ARTICLE_START, 1)).alias("id"), strip(F.regexp_extract(col, ARTICLE_START, 2)).alias("rest")))


def article_sort_key(aid: Column) -> Column:
    """STRUCT<n, rank, suffix> that sorts in legal order: 171, 171bis, 171ter, 171quater."""
    num = F.regexp_extract(aid, r"^(\d+)", 1)
    suffix = F.lower(F.regexp_replace(F.regexp_extract(aid, r"^\d+(.*)$", 1), "^-+|-+$", ""))
    ranks = F.create_map(*[F.lit(x) for kv in LATIN_RANK.items() for x in kv])
    rank = F.coalesce(F.try_element_at(ranks, suffix), F.when(suffix == "", 0).otherwise(99))
    no = num == ""
    return F.struct(F.when(no, 10**6).otherwise(F.expr("0") + F.try_to_number(F.when(no, F.lit("0")).otherwise(F.substring(num, 1, 9)), F.lit("999999999")).cast("int")).alias("n"), F.when(no, 0).otherwise(rank).alias("rank"), F.when(no, aid).otherwise(suffix).alias("suffix"))


def is_structural(col: Column) -> Column:
    """Heading, article, list item, subheading or ruling."""
    t = strip_notes(col)
    return F.coalesce(heading(t).isNotNull() | t.rlike(ARTICLE_START) | t.rlike(LIST_START) | t.rlike(SUBHEADING) | t.rlike(RULING_START), F.lit(False))


def strip_notes(col: Column) -> Column:
    """Without note references at the start."""
    return strip(F.regexp_replace(col, r"^(?:\[\^fn\d+\])+", ""))


def references(col: Column) -> Column:
    """ARRAY<STRUCT<nums, is_range, target>> of the cross-references in a text; target 'self', 'CGI', 'LPF', another in lower case, or NULL.

    A list with a range anywhere is a range as a whole, and a number ends after
    three digits, as documented for the data this reads.
    """
    pairs = F.arrays_zip(F.regexp_extract_all(col, F.lit(REFERENCE), F.lit(1)).alias("n"), F.regexp_extract_all(col, F.lit(REFERENCE), F.lit(2)).alias("t"))

    def one(p: Column) -> Column:
        t = F.lower(F.replace(p["t"], F.lit(".")))
        target = (
            F.when(t.isin("présent code", "present code", "présent livre", "present livre"), "self")
            .when(t.isin("cgi", "code général des impôts", "code general des impots", "code général des impots", "code general des impôts"), "CGI")
            .when(t.isin("lpf", "livre des procédures fiscales", "livre des procedures fiscales"), "LPF")
            .when(t != "", t)
        )
        return F.struct(F.regexp_extract_all(p["n"], F.lit(rf"(?i)({_ART})"), F.lit(1)).alias("nums"), p["n"].rlike(r"(?U)\b(?:à|au)\b").alias("is_range"), target.alias("target"))

    return F.transform(pairs, one)


def bracket(col: Column) -> Column:
    """STRUCT<lo, hi, rate> of a bracket row; hi is NULL in the last one; else NULL."""
    tidy = lambda c: strip(F.regexp_replace(c, r"(?U)\s+", " "))
    row = F.struct(tidy(F.regexp_extract(col, BRACKET_ROW, 1)).alias("lo"), tidy(F.regexp_extract(col, BRACKET_ROW, 2)).alias("hi"), strip(F.regexp_extract(col, BRACKET_ROW, 3)).alias("rate"))
    last = F.struct(tidy(F.regexp_extract(col, BRACKET_LAST, 1)).alias("lo"), F.lit(None).cast("string").alias("hi"), strip(F.regexp_extract(col, BRACKET_LAST, 2)).alias("rate"))
    return F.when(col.rlike(BRACKET_ROW), row).when(col.rlike(BRACKET_LAST), last)


def note(col: Column) -> Column:
    """STRUCT<text (400 characters), law, date, exercice> of a note."""
    has = col.rlike(LAW)
    law = F.concat(F.initcap(F.regexp_extract(col, LAW, 1)), F.lit(" N°"), F.regexp_extract(col, LAW, 2))
    return F.when(col.isNotNull(), F.struct(F.substring(col, 1, 400).alias("text"), F.when(has, law).alias("law"), F.when(has, F.regexp_extract(col, LAW, 3)).alias("date"), extract(col, EXERCICE).cast("int").alias("exercice")))
