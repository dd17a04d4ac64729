"""Noise in text from scanned pages.

A hidden Markov model labels the lines of each page as header, body, note,
page number or running foot from layout features (place on the page, indent,
form of the text, whether it recurs over the document's pages, capitals); its
tables are fitted by Baum-Welch on a bounded sample of pages and decoded by
Viterbi on all.  Words broken at the ends of body lines are rejoined over what
lies between, misread words and numbers are found by the corpus vocabulary and
a fixed table of confusions, and paragraphs are put together from the body.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.session import stored

STATES = ["header", "body", "note", "page_number", "foot"]
#: Pages from which the model is fitted; every page is decoded.
SAMPLE_PAGES = 2000
ROUNDS = 6

#: What a scanner reads, and what was printed.
CONFUSIONS = [("6", "b"), ("c", "e"), ("o", "a"), ("5", "s"), ("ii", "u"), ("ri", "n"), ("rn", "m"), ("0", "o"), ("f", "t"), ("l", "i"), ("1", "l"), ("9", "g"), ("cl", "d"), ("e", "é"), ("e", "è"), ("e", "ê"), ("6", "é"),
              ("d", "cl"), ("li", "h"), ("m", "rn"), ("1", "i"), ("i", "l"), ("n", "ri"), ("h", "li"), ("u", "ii"), ("e", "c"), ("a", "o"), ("t", "f"), ("a", "à"), ("a", "â"), ("o", "ô"), ("u", "û"), ("u", "ù"), ("i", "î"), ("8", "b"), ("vv", "w"), ("s", "5"), ("q", "g"), ("g", "q"), ("I", "l"), ("c", "ç"), ("é", "è"), ("è", "é"), ("v", "y"), ("y", "v"), ("n", "u"), ("u", "n"), ("tt", "ff"), ("fi", "ti")]
#: Letters that scanners put for digits.
DIGIT_LIKE = "OoIlSB"
MARKS = "-\u00ac\u2010\u00ad"
#: A misread word's correction is so many times as frequent as the misreading, which the corpus holds once at least.
RATIO = 20
#: So many ids (about 60 MB) are broadcast at most.
BROADCAST_IDS = 1_000_000

_WORD = r"[\p{L}\p{N}]+"
_NUM = f"[0-9{DIGIT_LIKE}|]"
#: A line with only the printed page number.
PAGE_NUMBER = rf"^\s*(?:[-–—\[(]\s*)?(?:(?:[Pp]age|[Pp]\.|[Ff]olio)\s*)?({_NUM}{{1,5}})(?:\s*(?:/|sur|de)\s*{_NUM}{{1,5}})?(?:\s*[-–—\])])?\s*$"
_NOTE = rf"^\s*\({_NUM}{{1,2}}\)\s"
_EDGE_NUMBER = rf"^\s*{_NUM}{{1,4}}\s{{2,}}|\s{{2,}}{_NUM}{{1,4}}\s*$"


def blurred(col: Column) -> Column:
    """A key that what was printed and what was read have in common."""
    k = F.lower(col)
    for wrong, right in (("rn", "m"), ("ri", "n"), ("ii", "u"), ("cl", "d"), ("li", "h")):
        k = F.replace(k, F.lit(wrong), F.lit(right))
    return F.translate(k, "01i|5986éèêcboàâô4ùû", "olllsgeeeeeeeaaaaauu")


def featured(lines: DataFrame) -> DataFrame:
    """Pages of lines (doc_id, page, seq, text, x0, y0, page_h): doc_id, page and ``lines`` in order, a struct of seq, h (of the text), code (the model's features in one integer) and key (of a title or of a page number's offset) each.

    Only numbers are shuffled.  Repeated rows count once; a NULL page is page -1.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    form = F.when(t.rlike(PAGE_NUMBER), 0).when(t.rlike(_NOTE), 1).when(t.rlike(_EDGE_NUMBER), 2).otherwise(3)
    rows = lines.withColumn("_form", form).withColumn("_num", F.when(F.col("_form") == 0, F.regexp_extract(t, PAGE_NUMBER, 1)))
    value = F.expr("try_cast(translate(_num, 'OoIl|SB', '0011158') AS int)")
    title = F.regexp_replace(blurred(F.when(F.col("_form") == 2, F.regexp_replace(t, _EDGE_NUMBER, "")).otherwise(t)), r"\P{L}+", "")
    key = F.when(F.col("_form") == 0, F.concat(F.lit("#"), (value - F.col("page")).cast("string"))).otherwise(title)
    y = F.col("y0") / F.col("page_h")
    zone = F.when(y.isNull() | F.isnan(y), 3).when(y < 0.1, 0).when(y > 0.88, 2).otherwise(1)
    indent = F.when(F.col("x0").isNull() | F.isnan("x0"), 21).otherwise(F.least(F.greatest(F.floor(F.col("x0") / 50), F.lit(0)), F.lit(11)))
    start = F.when(t.rlike(r"^\s*\p{Lu}"), 0).when(t.rlike(r"^\s*\p{Ll}"), 1).when(t.rlike(r"^\s*[0-9]"), 2).otherwise(3)
    code = (F.col("_form") * 2_000_000 + zone * 10_000 + indent * 100 + start).cast("int")
    line = F.struct("seq", _text_hash("text").alias("h"), code.alias("code"), F.when(key != "", F.xxhash64(key)).alias("key"))
    pages = rows.groupBy("doc_id", F.coalesce("page", F.lit(-1)).alias("page")).agg(F.array_sort(F.collect_set(line)).alias("lines"))
    first = F.filter("lines", lambda x, i: (i == 0) | (F.get("lines", i - 1)["seq"] != x["seq"]) | (F.get("lines", i - 1)["h"] != x["h"]))
    return pages.withColumn("lines", first)


def with_recurrence(pages: DataFrame) -> DataFrame:
    """Pages (see ``featured``) as doc_id, page, lines (seq, h) and ``codes``, which also say whether a line's key recurs on other pages of its document."""
    keys = pages.select("doc_id", "page", F.explode(F.array_distinct(F.filter(F.transform("lines", lambda x: x["key"]), lambda k: k.isNotNull()))).alias("key"))
    often = keys.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("doc_id", "key")
    again = keys.join(often, ["doc_id", "key"]).groupBy("doc_id", "page").agg(F.collect_list("key").alias("_again"))
    codes = F.transform("lines", lambda x: x["code"] + F.when(F.array_contains("_again", x["key"]), 1_000_000).otherwise(0))
    return pages.join(again, ["doc_id", "page"], "left").select("doc_id", "page", F.transform("lines", lambda x: F.struct(x["seq"].alias("seq"), x["h"].alias("h"))).alias("lines"), codes.alias("codes"))


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), F.col(text).isNull())


def _prior() -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Start, transition, end and emission tables that only say what the states mean."""
    n = len(STATES)
    start, end = np.array([6, 2, 0.2, 2, 0.2]), np.array([1, 4, 2, 4, 3])
    move = np.full((n, n), 0.2)
    move[0] = [0.5, 8, 0.2, 2, 0.2]
    move[1] = [0.2, 20, 1, 1, 1]
    move[2] = [0.05, 0.2, 3, 3, 3]
    move[3] = [2, 4, 0.1, 0.1, 0.1]
    move[4] = [0.05, 0.1, 0.1, 6, 0.5]
    form = np.full((n, 8), 0.2)
    form[0, [5, 7, 6, 4]] = [8, 20, 2, 1]
    form[1, [6, 7, 0, 1]] = [40, 2, 1, 0.2]
    form[2, [2, 3]] = [20, 4]
    form[3, [1, 0]] = [20, 4]
    form[4, [7, 6]] = [20, 1]
    zone = np.full((n, 4), 0.5)
    zone[0, 0], zone[1, 1], zone[1, 0], zone[2, 2], zone[3, 0], zone[3, 2], zone[4, 2] = 10, 20, 3, 10, 5, 8, 10
    zone[:, 3] = 2
    indent = np.ones((n, 22))
    first = np.full((n, 4), 0.5)
    first[0, 0], first[1, 1], first[1, 0], first[2, 3], first[3, 2], first[3, 3], first[4, 0] = 10, 10, 4, 10, 5, 8, 10
    edge = np.array([[10, 1], [3, 10], [8, 2], [20, 1], [20, 1]])
    rows = lambda a: a / a.sum(-1, keepdims=True)
    return rows(start), rows(move), rows(end), [rows(x) for x in (form, zone, indent, first, edge)]


def _edges(n: int) -> np.ndarray:
    """0 for the two outer lines at either end of a page, else 1."""
    at = np.arange(n)
    return ((at > 1) & (at < n - 2)).astype(np.int64)


class Model:
    """A hidden Markov model over a page's lines with independent features."""

    def __init__(self, start, move, end, emit):
        self.start, self.move, self.end, self.emit = start, move, end, emit

    def likelihood(self, page: np.ndarray) -> np.ndarray:
        out = np.ones((len(page), len(STATES)))
        for j, e in enumerate(self.emit):
            out *= e[:, page[:, j]].T
        return out

    def viterbi(self, page: np.ndarray) -> np.ndarray:
        b = np.log(self.likelihood(page))
        move = np.log(self.move)
        score, back = np.log(self.start) + b[0], []
        for x in b[1:]:
            all_ = score[:, None] + move
            back.append(all_.argmax(0))
            score = all_.max(0) + x
        state = int((score + np.log(self.end)).argmax())
        path = [state]
        for p in reversed(back):
            state = int(p[state])
            path.append(state)
        return np.array(path[::-1])

    def fitted(self, pages: list[np.ndarray], rounds: int) -> Model:
        """Baum-Welch from this model; its own tables stay in as 5 pages' worth of counts."""
        m = self
        for _ in range(rounds):
            start, move, end = m.start * 5, m.move * 5, m.end * 5
            emit = [e * 5 for e in m.emit]
            for page in pages:
                b = m.likelihood(page)
                n = len(page)
                f, g = np.empty_like(b), np.empty_like(b)
                f[0] = m.start * b[0]
                f[0] /= f[0].sum()
                for i in range(1, n):
                    f[i] = (f[i - 1] @ m.move) * b[i]
                    f[i] /= f[i].sum()
                g[-1] = m.end
                for i in range(n - 2, -1, -1):
                    g[i] = m.move @ (b[i + 1] * g[i + 1])
                    g[i] /= g[i].sum()
                p = f * g
                p /= p.sum(1, keepdims=True)
                start += p[0]
                end += p[-1]
                for i in range(1, n):
                    x = f[i - 1][:, None] * m.move * (b[i] * g[i])[None, :]
                    move += x / x.sum()
                for j, e in enumerate(emit):
                    np.add.at(e.T, page[:, j], p)
            m = Model(start / start.sum(), move / move.sum(1, keepdims=True), end / end.sum(), [e / e.sum(1, keepdims=True) for e in emit])
        return m


def _matrix(codes) -> np.ndarray:
    c = np.asarray(codes, dtype=np.int64)
    return np.column_stack([c // 1000000 % 100, c // 10000 % 100, c // 100 % 100, c % 100, _edges(len(c))])


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Model:
    """The model fitted on the ``sample`` pages of least hash."""
    rows = pages.filter(F.size("codes") > 0).select(F.xxhash64("doc_id", "page").alias("h"), "codes").orderBy("h", "codes").limit(sample).toPandas()
    return Model(*_prior()).fitted([_matrix(c) for c in rows["codes"]], ROUNDS)


def labelled(pages: DataFrame, model: Model) -> DataFrame:
    """doc_id, page and ``lines`` (seq, h, label)."""

    @F.pandas_udf("array<int>")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([model.viterbi(_matrix(c)).tolist() for c in s])

    names = F.array(*[F.lit(s) for s in STATES])
    return pages.select("doc_id", "page", F.zip_with("lines", decode("codes"), lambda x, s: F.struct(x["seq"].alias("seq"), x["h"].alias("h"), F.get(names, s).alias("label"))).alias("lines"))


def scanned(documents_meta: DataFrame) -> DataFrame:
    """The scanned documents, one row each.  Their ids are counted: few enough are broadcast, so that no lines are shuffled to find theirs."""
    ids = documents_meta.filter(F.col("ocr").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def line_blocks(doc_lines: DataFrame, documents: DataFrame, model: Model | None = None) -> DataFrame:
    """Pages of the given documents with labelled lines: src, doc_id, ord (the page), variant (0) and ``lines`` (seq, text, label).

    Repeated rows count once; rows with a NULL doc_id or seq are left out, a
    NULL page is a page of its own, NULL geometry and NULL text are features.
    Every step is written into the shared folder, so plans stay small and a
    lost executor costs one step.
    """
    rows = doc_lines.select("doc_id", "page", "seq", "text", "x0", "y0", "page_h").filter("doc_id IS NOT NULL AND seq IS NOT NULL").join(documents, "doc_id", "left_semi")
    pages = stored(with_recurrence(stored(featured(rows))))
    labels = labelled(pages, model or fit(pages))
    line = F.struct("seq", _text_hash("text").alias("h"), "text")
    texts = rows.groupBy("doc_id", F.coalesce("page", F.lit(-1)).alias("page")).agg(F.array_sort(F.collect_set(line)).alias("_t"))
    # both arrays hold the same (seq, h) in the same order
    lines = F.zip_with("_t", "lines", lambda t, x: F.struct(t["seq"].alias("seq"), t["text"].alias("text"), x["label"].alias("label")))
    got = texts.join(labels, ["doc_id", "page"])
    return stored(got.select(F.lit("doc_lines").alias("src"), "doc_id", F.col("page").cast("bigint").alias("ord"), F.lit(0).cast("bigint").alias("variant"), lines.alias("lines")))


def _stripped_hash(text: str | Column) -> Column:
    return F.xxhash64(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", ""))


def unit_blocks(units: DataFrame, documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Units of the given documents in the same form; a line has the label of the same line of its document, one that is not found there is body.

    Lines are looked up by hash; a unit's text is shuffled once.
    """
    unit = ["doc_id", "ord", "variant"]
    texts = units.select("doc_id", F.col("unit_ix").cast("bigint").alias("ord"), "text").dropna().join(documents, "doc_id", "left_semi")
    texts = texts.withColumn("variant", F.xxhash64("text")).groupBy(*unit).agg(F.first("text").alias("text"))
    lines = texts.select(*unit, F.posexplode(F.transform(F.split("text", "\n"), _stripped_hash)).alias("seq", "_h"))
    known = pages.select("doc_id", F.inline("lines")).groupBy("doc_id", _stripped_hash("text").alias("_h"), "label").agg(F.count(F.lit(1)).alias("_n"))
    known = known.groupBy("doc_id", "_h").agg(F.max_by("label", F.struct("_n", F.col("label") == "body")).alias("label")).filter("label <> 'body'")
    told = lines.join(known, ["doc_id", "_h"]).groupBy(*unit).agg(F.map_from_entries(F.collect_list(F.struct("seq", "label"))).alias("_l"))
    line = F.transform(F.split("text", "\n"), lambda t, i: F.struct(i.cast("bigint").alias("seq"), t.alias("text"), F.coalesce(F.try_element_at("_l", i), F.lit("body")).alias("label")))
    return stored(texts.join(told, unit, "left").select(F.lit("units").alias("src"), *unit, line.alias("lines")))


#: Pages of a document whose neighbours one window looks up; windows over these buckets carry the rest.
PAGE_BUCKET = 256


def body_lines(blocks: DataFrame, label: str = "body") -> DataFrame:
    """Body lines (or those of another label) with the text of the one before and of the next one, over whatever lies between; ``top`` and ``bottom`` of their page or unit.

    Lines inside of a page have their neighbours there and are not shuffled.
    Only the first and last lines go through windows: one over each bucket of
    ``PAGE_BUCKET`` pages, one over the ends of a document's buckets.
    """
    key = ["src", "doc_id", "ord", "variant"]
    b = blocks.withColumn("_b", F.filter("lines", lambda x: (x["label"] == label) & x["text"].isNotNull())).filter(F.size("_b") > 0).drop("lines")
    text = lambda i: F.get("_b", i)["text"]
    inner = b.filter(F.size("_b") > 2).select(*key, F.explode(F.transform(F.slice("_b", F.lit(2), F.greatest(F.size("_b") - 2, F.lit(0))), lambda x, i: F.struct(x["seq"].alias("seq"), x["text"].alias("text"), text(i + 2).alias("next"), text(i).alias("prev")))).alias("_x"))
    inner = inner.select(*key, "_x.*", F.lit(False).alias("top"), F.lit(False).alias("bottom"))
    n = F.size("_b")
    ends = b.select(*key, F.expr(f"ord div {PAGE_BUCKET}").alias("_bucket"), n.alias("_n"), F.get("_b", F.lit(0)).alias("_f"), text(F.lit(1)).alias("_f2"), F.get("_b", n - 1).alias("_l"), text(n - 2).alias("_l2"))
    doc, order = ["src", "doc_id", "_bucket"], F.struct("ord", "variant")
    w = Window.partitionBy(*doc).orderBy("ord", "variant")
    near = ends.withColumn("_next", F.lead("_f.text").over(w)).withColumn("_prev", F.lag("_l.text").over(w))
    w2 = Window.partitionBy("src", "doc_id").orderBy("_bucket")
    outer = ends.groupBy(*doc).agg(F.min_by("_f.text", order).alias("_bf"), F.max_by("_l.text", order).alias("_bl"))
    outer = outer.select(*doc, F.lead("_bf").over(w2).alias("_bn"), F.lag("_bl").over(w2).alias("_bp"))
    near = near.join(outer, doc).withColumn("_next", F.coalesce("_next", "_bn")).withColumn("_prev", F.coalesce("_prev", "_bp"))
    one = F.col("_n") == 1
    first = F.struct("_f.seq", "_f.text", F.when(one, F.col("_next")).otherwise(F.col("_f2")).alias("next"), F.col("_prev").alias("prev"), F.lit(True).alias("top"), one.alias("bottom"))
    last = F.struct("_l.seq", "_l.text", F.col("_next").alias("next"), F.col("_l2").alias("prev"), F.lit(False).alias("top"), F.lit(True).alias("bottom"))
    return inner.unionByName(near.select(*key, F.inline(F.when(one, F.array(first)).otherwise(F.array(first, last)))))


def _broken(text: Column, after: Column) -> Column:
    # the cheap test on the last character spares most lines the search
    marked = F.substring(F.rtrim(text), -1, 1).isin(*MARKS) | text.rlike(r"[\t\r\n\f]$")
    return marked & text.rlike(rf"[\p{{L}}\p{{N}}][{MARKS}]\s*$") & F.coalesce(after.rlike(r"^\s*[\p{Ll}0-9]"), F.lit(True))


def lexicon(corpus: DataFrame, text: str = "text") -> DataFrame:
    """Words as written and words with hyphens inside, over all lines: word, kind ('word' or 'compound'), n."""
    t = F.col(text)
    words = corpus.select(F.explode(F.split(t, r"[^\p{L}\p{N}]+")).alias("word")).filter(F.col("word").rlike(r"\p{L}")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("word"))
    inner = corpus.filter(t.contains("-") & t.rlike(r"\p{L}-\p{L}")).select(F.explode(F.regexp_extract_all(t, F.lit(r"\p{L}+(?:-\p{L}+)+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("compound"))
    # a summary of the corpus that is read several times
    return stored(words.unionByName(inner))


def misreadings(lex: DataFrame) -> DataFrame:
    """What scanners make of frequent words: form, word, n, at (where the form differs).

    Frequent are lower-case words, ``RATIO`` times as many as their misreading,
    compounds without their hyphens, and capitalised words that are a
    ten-thousandth of all.
    """
    total = lex.filter("kind = 'word'").agg(F.sum("n").alias("_all"))
    lower = F.col("word").rlike(r"^[\p{Ll}-]{2,}$") & (F.col("n") >= RATIO)
    # one row with the size of the corpus
    capital = F.col("word").rlike(r"^\p{Lu}\p{Ll}+$") & (F.col("n") * 10_000 >= F.col("_all"))
    often = lex.join(F.broadcast(total), F.lit(True)).filter(lower | capital).select(F.replace("word", F.lit("-")).alias("word"), "n")

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for word, n in zip(pdf["word"], pdf["n"], strict=True):
                for read, printed in CONFUSIONS:
                    at = word.find(printed)
                    while at >= 0:
                        out.append((word[:at] + read + word[at + len(printed) :], word, n, at))
                        at = word.find(printed, at + 1)
            yield pd.DataFrame(out, columns=["form", "word", "n", "at"]).astype({"n": "int64", "at": "int32"})

    all_ = often.mapInPandas(forms, "form string, word string, n bigint, at int")
    best = all_.groupBy("form").agg(F.max_by(F.struct("word", "n", "at"), F.struct("n", "word")).alias("_b"))
    own = lex.filter("kind = 'word'").select(F.col("word").alias("form"), F.col("n").alias("_own"))
    return best.join(own, "form", "left").select("form", "_b.*", F.coalesce("_own", F.lit(0)).alias("own")).filter(F.col("n") >= RATIO * F.greatest("own", F.lit(1)))


#: A number with a letter in a digit's place, or of such letters only.
BAD_NUMBER = rf"^(?![0-9]+$)(?:[{DIGIT_LIKE}]*[0-9][0-9{DIGIT_LIKE}]*|l[lIOo]+|I[lOo]+|O[OlI]+|[oO]{{2,}})$"


#: A body line's place.
KEY = ["src", "doc_id", "ord", "variant", "seq"]
#: So many misread forms (about 60 MB) are broadcast at most.
BROADCAST_FORMS = 1_000_000


def edges(body: DataFrame, *keep: str) -> DataFrame:
    """Body lines with the two parts of a word broken at their end (_l, _r) and at their start (_pl, _pr); NULL where none is.  Columns of ``keep`` stay."""
    t = F.col("text")
    ends, starts = F.coalesce(_broken(t, F.col("next")), F.lit(False)), F.coalesce(_broken(F.col("prev"), t), F.lit(False)) & F.col("prev").isNotNull()
    left, right = (lambda c: F.regexp_extract(c, rf"({_WORD})[{MARKS}]\s*$", 1)), (lambda c: F.coalesce(F.regexp_extract(c, rf"^\s*({_WORD})", 1), F.lit("")))
    return body.select(*KEY, "text", *keep, F.when(ends, left(t)).alias("_l"), F.when(ends, right(F.col("next"))).alias("_r"), F.when(starts, left(F.col("prev"))).alias("_pl"), F.when(starts, right(t)).alias("_pr"))


def compound_ends(rows: DataFrame, lex: DataFrame) -> DataFrame:
    """Places of lines that end in a compound which the corpus writes with a hyphen more often than as one word."""
    broken = rows.filter("_l IS NOT NULL").select(*KEY, "_l", "_r")
    blur = lex.select("kind", blurred(F.col("word")).alias("_k"), "n").groupBy("_k", "kind").agg(F.sum("n").alias("n"))
    pairs = broken.select("_l", "_r").distinct().select("_l", "_r", blurred(F.concat("_l", F.lit("-"), "_r")).alias("_hk"), blurred(F.concat("_l", "_r")).alias("_jk"))
    known = pairs.join(blur.filter("kind = 'compound'").select(F.col("_k").alias("_hk"), F.col("n").alias("_nh")), "_hk")
    known = known.join(blur.filter("kind = 'word'").select(F.col("_k").alias("_jk"), F.col("n").alias("_nj")), "_jk", "left").filter("_nh > coalesce(_nj, 0)").select("_l", "_r")
    return broken.join(known, ["_l", "_r"]).select(*KEY)


def misread(rows: DataFrame, lex: DataFrame) -> DataFrame:
    """Misread words and numbers of body lines, a place and (read, right) each.

    Words over a line's end are looked up whole; the part that holds the error
    is the misread one.  The body is read once.
    """
    t, n = F.col("text"), F.size("_w")
    first, last = F.when(F.col("_pl").isNotNull(), 1).otherwise(0), F.when(F.col("_l").isNotNull(), n - 1).otherwise(n)
    d = rows.withColumn("_w", F.filter(F.split(t, r"[^\p{L}\p{N}]+"), lambda x: x != ""))
    inner = F.array_distinct(F.slice("_w", first + 1, F.greatest(last - first, F.lit(0))))
    whole = F.transform(inner, lambda x: F.struct(x.alias("t"), F.lit(-1).alias("lo"), F.lit(9999).alias("hi"), x.alias("read")))
    over = F.array_compact(F.array(
        F.when(F.col("_l").isNotNull(), F.struct(F.concat("_l", "_r").alias("t"), F.lit(-1).alias("lo"), F.length("_l").alias("hi"), F.col("_l").alias("read"))),
        F.when(F.col("_pl").isNotNull(), F.struct(F.concat("_pl", "_pr").alias("t"), F.length("_pl").alias("lo"), F.lit(9999).alias("hi"), F.col("_pr").alias("read"))),
    ))
    asked = d.select(*KEY, F.inline(F.when(F.size(over) > 0, F.concat(whole, over)).otherwise(whole)))
    asked = asked.withColumn("_num", (F.col("lo") < 0) & (F.col("hi") == 9999) & F.col("t").rlike(BAD_NUMBER)).filter(F.col("_num") | F.col("t").rlike(r"\p{L}"))
    # a capitalised word is looked up as it is and in lower case
    asked = asked.withColumn("_form", F.explode(F.when(~F.col("_num") & F.col("t").rlike(r"^\p{Lu}\p{Ll}"), F.array("t", F.lower("t"))).otherwise(F.array("t"))))
    wrong = stored(misreadings(lex).select(F.col("form").alias("_form"), F.col("word").alias("_a"), F.col("at").alias("_at")))
    found = asked.join(F.broadcast(wrong) if wrong.count() <= BROADCAST_FORMS else wrong, "_form", "left").filter("_num OR (_at >= lo AND _at < hi)")
    right = F.when(F.col("_num"), F.translate("read", "OoIlSB", "001158")).when(F.col("lo") >= 0, F.substring("_a", F.col("lo") + 1, F.length("_a"))).when(F.col("hi") < 9999, F.expr("substring(_a, 1, length(_a) - (length(t) - hi))")).otherwise(F.when(F.col("t") != F.col("_form"), F.initcap("_a")).otherwise(F.col("_a")))
    return found.select(*KEY, "read", right.alias("right"))


def findings(rows: DataFrame, lex: DataFrame, *keep: str) -> DataFrame:
    """Per line (see ``edges``): glue (it ends in a broken word), hyphen (whose mark must go) and ``fixes``, the misread words (read, right)."""
    fixes = misread(rows, lex).groupBy(*KEY).agg(F.collect_set(F.struct("read", "right")).alias("_f"))
    compounds = compound_ends(rows, lex).distinct().withColumn("_c", F.lit(True))
    out = rows.join(fixes, KEY, "left").join(compounds, KEY, "left")
    none = F.array().cast("array<struct<read:string,right:string>>")
    glue = F.col("_l").isNotNull()
    return out.select(*KEY, "text", *keep, F.col("_pl").isNotNull().alias("joined"), glue.alias("glue"), (glue & F.col("_c").isNull()).alias("hyphen"), F.coalesce("_f", none).alias("fixes"))


def noise(doc_lines: DataFrame, units: DataFrame, documents_meta: DataFrame) -> DataFrame:
    """Faults of scanned documents: src, doc_id, pos, line_no, fault; distinct rows."""
    documents = scanned(documents_meta)
    pages = line_blocks(doc_lines, documents)
    blocks = pages.unionByName(unit_blocks(units, documents, pages))
    place = lambda c: [F.when(F.col("src") == "units", F.col("ord")).otherwise(F.col(c)).alias("pos"), F.when(F.col("src") == "units", F.col(c) + 1).otherwise(0).cast("int").alias("line_no")]
    outer = blocks.select("src", "doc_id", "ord", F.inline(F.filter("lines", lambda x: x["label"].isin("header", "foot", "page_number"))))
    outer = outer.select("src", "doc_id", *place("seq"), F.when(F.col("label") == "page_number", "page_number").otherwise("header").alias("fault"))
    rows, lex = edges(body_lines(blocks)), lexicon(doc_lines)
    broken = stored(rows.filter("_l IS NOT NULL").select(*KEY, "_l", "_r"))
    hyphens = broken.select(*KEY).join(compound_ends(broken, lex), KEY, "left_anti").withColumn("fault", F.lit("hyphen"))
    inner = hyphens.unionByName(misread(rows, lex).select(*KEY).withColumn("fault", F.lit("misread")))
    return outer.unionByName(inner.select("src", "doc_id", *place("seq"), "fault")).distinct()


def indents(doc_lines: DataFrame, documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Whether body lines are indented against their page's body, where the geometry is known: src, doc_id, at, indented.

    ``at`` is the seq for doc_lines and the hash of the stripped text for units, whose lines have no geometry of their own.
    """
    where = doc_lines.select("doc_id", "seq", "x0").filter("doc_id IS NOT NULL AND seq IS NOT NULL").join(documents, "doc_id", "left_semi").groupBy("doc_id", "seq").agg(F.min("x0").alias("x0"))
    body = pages.select("doc_id", "ord", F.inline("lines")).filter("label = 'body' AND text IS NOT NULL").join(where, ["doc_id", "seq"]).filter(F.col("x0").isNotNull() & ~F.isnan("x0"))
    body = body.withColumn("_in", F.col("x0") > F.min("x0").over(Window.partitionBy("doc_id", "ord")) + 4)
    # a line is found by its place and by its text; most of the places of a text decide
    both = body.select("doc_id", "_in", F.inline(F.array(F.struct(F.lit("doc_lines").alias("src"), F.col("seq").alias("at")), F.struct(F.lit("units").alias("src"), _stripped_hash("text").alias("at")))))
    return both.groupBy("src", "doc_id", "at").agg((F.sum(F.when(F.col("_in"), 1).otherwise(-1)) > 0).alias("indented"))


def paragraphs(doc_lines: DataFrame, documents_meta: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """Repaired paragraphs of scanned documents: src, doc_id, unit_ix, variant (of a unit with several texts), kind, para_no, page (of its first line), lines, text.

    ``src`` is 'doc_lines' (unit_ix NULL, paragraphs run over pages) or 'units'
    (page NULL, paragraphs end with their unit); ``kind`` is 'body' or 'note',
    each numbered by itself.  A body line opens a paragraph if it is indented
    against its page's body, or opens like an article, or follows a closed
    sentence on a short line where the geometry is unknown; a note opens with
    its number, at the top of its page or unit.
    """
    documents = scanned(documents_meta)
    blocks = pages = line_blocks(doc_lines, documents)
    if units is not None:
        blocks = pages.unionByName(unit_blocks(units, documents, pages))
    kinds = [body_lines(blocks, k).withColumn("kind", F.lit(k)) for k in ("body", "note")]
    of_units = F.col("src") == "units"
    short = F.col("prev").rlike(r"[.!?]\s*$") & F.col("text").rlike(r"^\s*\p{Lu}") & (F.length("prev") < F.length("text") - 8)
    # what the neighbours say is kept, the neighbours are not
    both = kinds[0].unionByName(kinds[1]).withColumns({"short": short, "alone": F.col("prev").isNull(), "goes_on": F.col("next").isNotNull() & ~(of_units & F.col("bottom"))})
    keep = ("kind", "top", "short", "alone", "goes_on")
    rows = stored(findings(stored(edges(both, *keep)), lexicon(doc_lines), *keep))
    rows = rows.withColumn("at", F.when(of_units, _stripped_hash("text")).otherwise(F.col("seq"))).join(indents(doc_lines, documents, pages), ["src", "doc_id", "at"], "left")
    body = F.col("text").rlike(r"^\s*(?:Art(?:icle)?\.?\s*[0-9IlOo]|[IVX]+\s*[.-]|[A-H]\s*-\s)") | F.coalesce("indented", "short")
    note = F.col("text").rlike(_NOTE) | (F.col("top") & ~F.col("joined"))
    opens = F.col("alone") | (of_units & F.col("top")) | F.when(F.col("kind") == "note", note).otherwise(body)
    rows = rows.withColumn("_open", F.coalesce(opens, F.lit(False)).cast("int")).withColumn("_unit", F.when(of_units, F.col("ord")).otherwise(-1))
    whole = ["src", "doc_id", "_unit", "variant", "kind"]
    starts = rows.groupBy(*whole, "ord").agg(F.sum("_open").alias("_n"))
    before = Window.partitionBy(*whole).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*whole, "ord").orderBy("seq", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_in", F.sum("_open").over(within)).join(starts, [*whole, "ord"]).withColumn("para_no", F.col("_before") + F.col("_in"))
    fixed = F.aggregate("fixes", F.col("text"), lambda acc, x: F.regexp_replace(acc, F.concat(F.lit(r"(?<![\p{L}\p{N}])"), x["read"], F.lit(r"(?![\p{L}\p{N}])")), x["right"]))
    # a word whose rest does not follow keeps its mark
    goes_on = F.col("goes_on")
    piece = F.when(F.col("hyphen") & goes_on, F.regexp_replace(fixed, rf"[{MARKS}]\s*$", "")).when(F.col("glue") & goes_on, F.regexp_replace(fixed, rf"[{MARKS}]\s*$", "-")).otherwise(F.concat(F.regexp_replace(fixed, r"^\s+|\s+$", ""), F.lit(" ")))
    lines = F.array_sort(F.collect_list(F.struct("ord", "seq", piece.alias("piece"))))
    out = rows.groupBy(*whole, "para_no").agg(lines.alias("_p"))
    unit, page = F.when(of_units, F.col("_unit")).cast("int"), F.when(~of_units, F.get("_p", F.lit(0))["ord"]).cast("int")
    return out.select("src", "doc_id", unit.alias("unit_ix"), "variant", "kind", F.col("para_no").cast("bigint").alias("para_no"), page.alias("page"), F.size("_p").alias("lines"), F.trim(F.array_join(F.transform("_p", lambda x: x["piece"]), "")).alias("text"))
