"""Scalar text functions: cleaning, spacing, hyphens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from juriflow.functions.consistent import compose, let
from juriflow.functions.patterns import BULLETS, MONTHS, NOTE_REF, PAGE_MARK, strip

# French words that decide on a hyphen, and function words that end no title.
KEEP_PREFIX = ["ci", "celui", "celle", "ceux", "celles", "eux", "elles", "lui", "elle", "non", "sous", "quasi", "semi", "demi", "mi", "vice", "ex", "anti", "extra", "inter", "intra", "multi", "micro", "mini", "auto", "contre", "co", "porte", "peut", "c'est", "n'est", "dix", "vingt", "trente", "quarante", "cinquante", "soixante", "quatre", "quatre-vingt", "cent", "mille", "deux", "trois", "cinq", "six", "sept", "huit", "neuf"]
KEEP_SUFFIX = ["même", "mêmes", "ci", "là", "dessus", "dessous", "après", "avant", "delà", "dire", "à-dire", "aussi", "joint", "jointe", "contre", "annexé"]
FUNCTION_WORDS = ["le", "la", "les", "l'", "l’", "de", "des", "du", "d'", "d’", "et", "à", "au", "aux", "en", "sur", "dont", "par", "pour", "ou", "un", "une", "sous", "dans", "entre", "vers", "avec", "sans", "que", "qui", "ci", "non", "ses", "leurs", "leur", "son", "sa", "ce", "cette"]
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
GLUED_CI = r"(?iuU)\bci(dessous|dessus|après|apres|joint|jointe|contre|annexé|annexée|avant)\b"
GLUED_SELF = r"(?iuU)\b(eux|elles|lui|elle|moi|soi|nous|vous|toi)(mêmes?)\b"
ORDINAL_GAP = rf"(?iuU)\b(\d+) (er|ère|ème|èmes|e)\b(?= (?:{MONTHS}|trimestre|alinéa|jour|janv))"
SPACE_BEFORE, SPACE_OPEN, SPACE_CLOSE = r"(?U)\s+([,.])(?=\s|$)", r"(?U)\(\s+", r"(?U)\s+\)"
BULLET = rf"(?U)^[{BULLETS.replace('-', '', 1)}]\s*"


def norm_key(col: Column) -> Column:
    """White space collapsed, stripped, lower case."""
    return F.lower(strip(F.regexp_replace(col, r"(?U)\s+", " ")))


def normalize_chars(col: Column) -> Column:
    """Composed form, ligatures, no invisible characters, plain spaces and apostrophes, single blanks, no blank at the end."""
    s = compose(col)
    for k, v in LIGATURES.items():
        s = F.replace(s, F.lit(k), F.lit(v))
    s = F.translate(s, "\u00a0\u202f\u2009\u2007’‘ʼ\u200b\u200c\u200d\ufeff\u2060\u00ad", "    '''")
    return F.regexp_replace(F.regexp_replace(s, r"[ \t]+", " "), r"(?U)\s+$", "")


def fix_text(col: Column) -> Column:
    """Known glued compounds, ordinals before a month, spaces before commas and inside brackets, double spaces."""
    s = F.regexp_replace(F.regexp_replace(col, GLUED_CI, "ci-$1"), GLUED_SELF, "$1-$2")
    s = F.regexp_replace(s, ORDINAL_GAP, "$1$2")
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, SPACE_BEFORE, "$1"), SPACE_OPEN, "("), SPACE_CLOSE, ")")
    return strip(F.regexp_replace(s, " {2,}", " "))


def fix_counts(col: Column) -> Column:
    """MAP of how often each correction of ``fix_text`` applies."""
    n = lambda c, p: F.regexp_count(c, F.lit(p))
    glued = n(col, GLUED_CI) + n(col, GLUED_SELF)
    spacing = n(col, SPACE_BEFORE) + n(col, SPACE_OPEN) + n(col, SPACE_CLOSE)
    return F.create_map(F.lit("glued_compound_fixed"), glued, F.lit("ordinal_fixed"), n(col, ORDINAL_GAP), F.lit("spacing_fixed"), spacing)


def normalize_bullet(col: Column) -> Column:
    """Any bullet at the start becomes '- '; bold lines stay."""
    return F.when(col.rlike(BULLET) & ~col.startswith("**"), F.regexp_replace(col, BULLET, "- ")).otherwise(col)


def clean_text(col: Column) -> Column:
    """Text without page marks, note references and bold marks; blanks and empty lines collapsed."""
    s = F.replace(F.regexp_replace(F.regexp_replace(col, PAGE_MARK, ""), NOTE_REF, ""), F.lit("**"))
    return strip(F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"[ \t]{2,}", " "), r" +\n", "\n"), r"\n{3,}", "\n\n"))


def is_upper(col: Column) -> Column:
    """Has letters, all of them capitals."""
    letters = F.regexp_replace(col, r"\P{L}", "")
    return (letters != "") & ~letters.rlike(r"[^\p{Lu}]")


def ends_with_function_word(col: Column) -> Column:
    """The last word is a function word or ends with an apostrophe."""
    last = F.lower(F.regexp_extract(col, r"(?U)(\S+)\s*$", 1))
    return last.isin(FUNCTION_WORDS) | last.rlike("['’]$")


def hyphen_decision(acc: Column, line: Column) -> Column:
    """How the end of a text joins a next line: 'space', 'joined' (the hyphen goes) or 'kept'."""
    first = F.split(line, " ")[0]
    word = F.lower(F.regexp_replace(first, r"^[.,;:)]+|[.,;:)]+$", ""))
    left = F.lower(F.regexp_extract(acc, r"(?U)([\wÀ-ÿ']+)-$", 1))
    keep = first.rlike(r"^\p{Lu}") | acc.rlike(r"\d-$") | first.rlike(r"^\d") | left.isin(KEEP_PREFIX) | word.isin(KEEP_SUFFIX)
    return F.when(~acc.rlike(r"[\p{L}\p{N}]-$"), "space").when(keep, "kept").otherwise("joined")


def join_pair(acc: Column, line: Column) -> Column:
    """Join a text and a next line by that decision."""
    joined = lambda how: F.when(how == "space", F.concat(acc, F.lit(" "), line)).when(how == "kept", F.concat(acc, line)).otherwise(F.concat(F.regexp_replace(acc, "-$", ""), line))
    return F.when(acc.endswith("-"), let(hyphen_decision(acc, line), joined)).otherwise(F.concat(acc, F.lit(" "), line))


def join_items(items: Column) -> Column:
    """Join ARRAY<STRUCT<kind, text>> into a paragraph; page marks ('pg') stay before the first word of their page.

    A mark inside a broken word goes behind the rejoined word; marks after the
    last text are not part of the paragraph.
    """

    def step(state: Column, x: Column) -> Column:
        acc, held, val = state["acc"], state["held"], x["text"]
        marks = F.array_join(held, " ")
        first, rest = F.split(val, " ", 2)[0], F.get(F.split(val, " ", 2), F.lit(1))
        broken = acc.rlike(r"[\p{L}\p{N}]-$")
        inside = F.when(broken & rest.isNotNull(), F.concat(join_pair(acc, first), F.lit(" "), marks, F.lit(" "), rest)).when(broken, F.concat(join_pair(acc, val), F.lit(" "), marks)).otherwise(F.concat(acc, F.lit(" "), marks, F.lit(" "), val))
        opened = F.when(F.size(held) > 0, F.concat(marks, F.lit(" "), val)).otherwise(val)
        text = F.when(acc == "", opened).when(F.size(held) > 0, inside).otherwise(join_pair(acc, val))
        none = F.array().cast("array<string>")
        return F.when(x["kind"] == "pg", F.struct(acc.alias("acc"), F.concat(held, F.array(val)).alias("held"))).otherwise(F.struct(text.alias("acc"), none.alias("held")))

    start = F.struct(F.lit("").alias("acc"), F.array().cast("array<string>").alias("held"))
    return F.aggregate(items, start, step, lambda s: s["acc"])
