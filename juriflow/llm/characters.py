"""Visually identical text with different characters.

Script-aware repair: the dominant script of each token is determined and
look-alike letters are replaced in mixed-script tokens if the corpus vocabulary
knows the result; it chooses between readings, and weak look-alikes (Greek nu
for v) are read only on its word.  A token whose repair the vocabulary does not
know falls back on its script: if only Latin letters result, it is no word of
another script.  ``basis`` says which of the two decided.  Width, spaces, apostrophes, hyphens, joined glyphs, invisible
characters and composition are the core's consistent form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from juriflow.functions import consistent as C
from juriflow.session import stored

#: Splits a text into its words.
NOT_WORD = r"\P{L}+"


def vocabulary(corpus: DataFrame, text: str = "text", least: int = 2) -> DataFrame:
    """Words of the corpus's texts that need no repair, found at least ``least`` times: word, n."""
    words = corpus.filter(F.col(text).isNotNull() & ~C.is_suspect(F.col(text))).select(F.explode(F.split(F.lower(text), NOT_WORD)).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def _letters(token: Column, script: str) -> Column:
    return F.length(F.regexp_replace(token, rf"\P{{Is{script}}}", ""))


def token_repairs(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Per distinct token with letters of another script: token, script (the dominant one), fixed, basis.

    basis: 'vocabulary' (the corpus knows the result), 'script' (it does not,
    but only Latin letters result), 'foreign' (a word truly in another script,
    which stays) or 'none' (nothing known, it stays).  At a tie the dominant
    script is Latin, then Greek.
    """
    t = F.col("token")
    d = tokens.select("token").distinct().withColumn("_c", F.array(*[F.struct(_letters(t, s).alias("n"), F.lit(-i).alias("o"), F.lit(s).alias("s")) for i, s in enumerate(("Latin", "Greek", "Cyrillic"))]))
    d = d.select("token", F.array_max("_c")["s"].alias("script"), C.latin_doubles(t).alias("strong"), C.latin_doubles(t, weak=True).alias("weak"))
    words = d.select(F.explode(F.array(F.lower("strong"), F.lower("weak"))).alias("word")).distinct()
    known = words.join(vocab.select("word"), "word")
    d = d.join(known.select(F.col("word").alias("_s"), F.lit(True).alias("s_known")), F.lower("strong") == F.col("_s"), "left")
    d = d.join(known.select(F.col("word").alias("_w"), F.lit(True).alias("w_known")), F.lower("weak") == F.col("_w"), "left")
    latin = lambda c: ~F.col(c).rlike(C.FOREIGN)
    way = (
        F.when(C.foreign_word(t), F.struct(t.alias("fixed"), F.lit("foreign").alias("basis")))
        .when(F.col("s_known"), F.struct(F.col("strong").alias("fixed"), F.lit("vocabulary").alias("basis")))
        .when(F.col("w_known") & latin("weak"), F.struct(F.col("weak").alias("fixed"), F.lit("vocabulary").alias("basis")))
        .when(latin("strong"), F.struct(F.col("strong").alias("fixed"), F.lit("script").alias("basis")))
        .otherwise(F.struct(t.alias("fixed"), F.lit("none").alias("basis")))
    )
    return d.select("token", "script", way.alias("_r")).select("token", "script", "_r.fixed", "_r.basis")


def repair(rows: DataFrame, vocab: DataFrame, text: str = "text", out: str = "fixed") -> DataFrame:
    """Rows with ``out``, the consistent form of their text; rows, order-free, are kept as often as they come.

    NULL and empty texts stay as they are; texts without suspect characters are
    passed through.  All other columns are kept, whatever their names, except
    that ``out`` replaces a column of that name.
    """
    rows = rows.drop(out) if out in rows.columns else rows
    suspect = F.coalesce(C.is_suspect(F.col(text)), F.lit(False))
    return rows.filter(~suspect).withColumn(out, F.col(text)).unionByName(_repaired(rows.filter(suspect), vocab, text, out))


def _repaired(suspects: DataFrame, vocab: DataFrame, text: str, out: str) -> DataFrame:
    # read by four branches below
    plain = stored(suspects.withColumn(out, C.plain_characters(F.col(text))))
    foreign = F.coalesce(F.col(out).rlike(C.FOREIGN), F.lit(False))
    # what follows depends on the text alone, so every distinct text is repaired once
    texts = plain.filter(foreign).select(F.col(out).alias("_text")).distinct()
    pieces = texts.select("_text", F.posexplode(C.script_tokens(F.col("_text"))).alias("_pos", "token"))
    asked = pieces.filter(F.col("token").rlike(C.FOREIGN))
    fixes = token_repairs(asked, vocab)
    # one map of place to replacement for each text, applied to the text's own tokens
    changes = asked.join(fixes.filter("fixed <> token"), "token").groupBy("_text").agg(F.map_from_entries(F.collect_list(F.struct("_pos", "fixed"))).alias("_fix"))
    tokens = C.script_tokens(F.col("_text"))
    joined = F.array_join(F.transform(tokens, lambda tok, i: F.coalesce(F.try_element_at("_fix", i), tok)), "")
    fixed = changes.select("_text", joined.alias("_fixed"))
    back = plain.filter(foreign).join(fixed, F.col(out) == F.col("_text"), "left").withColumn(out, F.coalesce("_fixed", out)).drop("_text", "_fixed")
    return plain.filter(~foreign).unionByName(back).withColumn(out, C.compose(F.col(out)))


def squeezed(col: Column) -> Column:
    """The number of plain spaces plays no role."""
    return F.regexp_replace(col, " +", " ")


def differing(rows: DataFrame, vocab: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text differs from its consistent form in more than the number of plain spaces, with ``fixed``."""
    return _repaired(rows.filter(C.is_suspect(F.col(text))), vocab, text, "fixed").filter(squeezed(F.col(text)) != squeezed(F.col("fixed")))


def born_digital(documents_meta: DataFrame) -> DataFrame:
    """The documents without OCR, one row each: doc_id, source."""
    return documents_meta.filter(F.col("ocr").isNull() & F.col("doc_id").isNotNull()).select("doc_id", "source").distinct()


def texts(doc_lines: DataFrame, spans: DataFrame) -> DataFrame:
    """The texts of lines and spans with their places: src, doc_id, page, pos, span_ix, text."""
    a = doc_lines.select(F.lit("doc_lines").alias("src"), "doc_id", "page", F.col("seq").cast("bigint").alias("pos"), F.lit(0).alias("span_ix"), "text")
    b = spans.select(F.lit("spans").alias("src"), "doc_id", "page", F.col("raw_line").cast("bigint").alias("pos"), F.col("span_ix").cast("int").alias("span_ix"), "text")
    return a.unionByName(b)


def repaired_tokens(doc_lines: DataFrame, spans: DataFrame, documents_meta: DataFrame) -> DataFrame:
    """What decided on each token with letters of another script in born-digital documents: token, script, fixed, basis."""
    rows = texts(doc_lines, spans)
    born = born_digital(documents_meta).select("doc_id").distinct()
    foreign = rows.filter(C.is_suspect(F.col("text"))).join(born, "doc_id", "left_semi").select(C.plain_characters(F.col("text")).alias("_t")).filter(F.col("_t").rlike(C.FOREIGN))
    tokens = foreign.distinct().select(F.explode(C.script_tokens(F.col("_t"))).alias("token")).filter(F.col("token").rlike(C.FOREIGN))
    return token_repairs(tokens, vocabulary(rows))


def inconsistent_texts(doc_lines: DataFrame, spans: DataFrame, documents_meta: DataFrame) -> DataFrame:
    """Texts of born-digital documents that differ from their consistent form: src, doc_id, page, pos, span_ix, fixed."""
    rows = texts(doc_lines, spans)
    suspects = rows.filter(C.is_suspect(F.col("text"))).join(born_digital(documents_meta).select("doc_id").distinct(), "doc_id", "left_semi")
    found = differing(suspects, vocabulary(rows))
    return found.select("src", "doc_id", "page", "pos", "span_ix", "text", "fixed").distinct()
