"""One consistent form for text that looks the same but differs in its characters.

Everything here is a ``Column -> Column`` function that stays in the JVM.
Text made only of ordinary characters, nearly all of it, is passed through
after one regex test; only the rest takes the longer way.

Fixed values
    ``CLEAN`` lists the characters that never need repair: printable ASCII,
    the letters and signs of Latin-1 (but for no-break space, soft hyphen and
    the spacing acute), the French letters beyond it, and the signs that have
    a look of their own.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that are already in the consistent form.
CLEAN = r"\n\x20-\x7E¡-¬®-³µ-ÿŒœŸ–—“”„†-•…‰€™"
#: Matches a text of such characters only; a possessive class over the whole text is far cheaper in Java than a search for one outside of it.
ORDINARY = rf"^[{CLEAN}]*+\z"

#: Signs that stand for an apostrophe or for a hyphen.
APOSTROPHES = "‘’‛ʼʹ′´ꞌ՚"
HYPHENS = "‐‑﹣"
#: Invisible characters outside the Unicode category Cf.
INVISIBLE = "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0"
VARIATION = [(0x180B, 0x180D), (0xFE00, 0xFE0F)]

#: Letters of other scripts that have a Latin double.
CYRILLIC_DOUBLES = {"А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V",
                    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v", "ѐ": "è", "ё": "ë", "ї": "ï"}
GREEK_DOUBLES = {"Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ό": "ó"}
#: Letters that resemble a Latin one without being its double;
#: they are replaced only where a vocabulary knows the resulting word.
WEAK_DOUBLES = {"ν": "v", "ι": "i", "ρ": "p", "υ": "u", "α": "a", "κ": "k", "τ": "t", "γ": "y", "к": "k", "т": "t", "п": "n", "г": "r"}
DOUBLES = {**CYRILLIC_DOUBLES, **GREEK_DOUBLES}
FOREIGN = r"[\p{IsGreek}\p{IsCyrillic}]"
LATIN = r"\p{IsLatin}"


def _single_map() -> dict[str, str]:
    """Characters replaced by one character or by nothing ('')."""
    out: dict[str, str] = {}
    for cp in [*range(0x20, 0x3100), *range(0xFE00, 0x10000), *range(0xE0000, 0xE0080), *range(0x1BCA0, 0x1BCA4), *range(0x1D173, 0x1D17B)]:
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if kind == "Cf" or ch in INVISIBLE or any(a <= cp <= b for a, b in VARIATION):
            out[ch] = ""
        elif kind in ("Zs", "Zl", "Zp") and ch != " ":
            out[ch] = " "
    for cp in [*range(0xFF01, 0xFF5F), *range(0xFFE0, 0xFFE7), *range(0x1D400, 0x1D6A6), *range(0x1D7CE, 0x1D800)]:
        plain = unicodedata.normalize("NFKC", chr(cp))
        if len(plain) == 1 and plain != chr(cp):
            out[chr(cp)] = plain
    out.update(dict.fromkeys(APOSTROPHES, "'"))
    out.update(dict.fromkeys(HYPHENS, "-"))
    out["\t"] = " "
    return out


def _joined_map() -> dict[str, str]:
    """Glyphs that join several letters (ligatures, digraphs, Roman numerals); ``œ`` and ``æ`` are letters and stay."""
    out = {}
    for cp in [*range(0xFB00, 0xFB07), *range(0x2160, 0x2180), 0x132, 0x133, *range(0x1C4, 0x1CD), *range(0x1F1, 0x1F4)]:
        plain = unicodedata.normalize("NFKC", chr(cp))
        if plain != chr(cp) and plain.isalpha():
            out[chr(cp)] = plain
    return out


SINGLE = _single_map()
JOINED = _joined_map()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _translate(col: Column, table: dict[str, str]) -> Column:
    kept = [k for k, v in table.items() if v]
    gone = [k for k, v in table.items() if not v]
    return F.translate(col, "".join(kept + gone), "".join(table[k] for k in kept))


def compose(col: Column) -> Column:
    """Unicode NFC by the ICU library that Spark ships; only text with a combining mark takes that way."""
    nfc = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), col, F.lit(False))
    return F.when(col.rlike("[\\p{M}\u212a\u212b]"), nfc).otherwise(col)


def plain_characters(col: Column) -> Column:
    """Width, spaces, apostrophes, hyphens, joined glyphs, invisible characters; no look-alike letters, no composition."""

    def joined(simple: Column) -> Column:
        out = simple
        for glyph, letters in JOINED.items():
            out = F.replace(out, F.lit(glyph), F.lit(letters))
        return F.when(simple.rlike("[" + "".join(JOINED) + "]"), out).otherwise(simple)

    return let(_translate(col, SINGLE), joined)


def foreign_word(token: Column) -> Column:
    """True for a word truly in another script: no Latin letter, and a letter without a Latin double."""
    return ~token.rlike(LATIN) & token.rlike(rf"[\p{{L}}&&[^{''.join(DOUBLES)}]]")


def latin_doubles(token: Column, weak: bool = False) -> Column:
    """The token with the doubles of Latin letters replaced."""
    return _translate(token, {**DOUBLES, **WEAK_DOUBLES} if weak else DOUBLES)


def script_tokens(col: Column) -> Column:
    """ARRAY of alternating words (letters and marks) and what lies between; joined they give the text again."""
    word, other = r"[\p{L}\p{M}]", r"[^\p{L}\p{M}]"
    return F.split(col, f"(?<={word})(?={other})|(?<={other})(?={word})")


def latin_letters(col: Column) -> Column:
    """Replace look-alike letters, word by word, but for words truly in another script."""
    fixed = F.array_join(F.transform(script_tokens(col), lambda t: F.when(t.rlike(FOREIGN) & ~foreign_word(t), latin_doubles(t)).otherwise(t)), "")
    return F.when(col.rlike(FOREIGN), fixed).otherwise(col)


def is_suspect(col: Column) -> Column:
    """Whether the text holds any character that could need repair."""
    return ~col.rlike(ORDINARY)


def consistent_form(col: Column) -> Column:
    """The consistent form of a text: NULL stays NULL, an empty text stays empty, order and case are kept.

    Plain spaces are neither added to nor taken from those in the text, but a
    special space becomes a plain one.
    """
    return F.when(is_suspect(col), let(plain_characters(col), lambda p: let(latin_letters(p), compose))).otherwise(col)


def same_but_spacing(col: Column) -> Column:
    """A key that is equal for texts which differ only in spacing, line breaks or in their consistent form."""
    return F.regexp_replace(consistent_form(col), r"\s+", "")
