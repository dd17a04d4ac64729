"""Long exact spans shared between records.

Prefix-partitioned suffix trees.  Suffixes start at anchors: of any 101
consecutive windows of 100 code points the one with the least hash is an
anchor, so every span of 200 code points holds one, at the same place in each
of its copies.  Suffixes are partitioned by their first 100 code points; a
partition that only one text has is dropped at once, and suffixes with the same
200 code points after and 100 before their anchor are one leaf.

A partition with more leaves than a task holds gets a longer prefix.  Its
leaves share a code points before and b after the anchor; two of them that
share a span of 200 also share half of what is missing, on one side or on the
other, so each leaf goes into two partitions with prefixes of (a + half, b) and
(a, b + half), and so on until a partition fits or all its leaves share a span.  In each partition the sorted suffixes and their common prefixes are
the suffix tree; its internal nodes of depth d join the suffixes that also
agree on the 200 - d code points before the anchor.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from juriflow.session import small, stored

#: Least length of a shared span, in code points; half of it is the prefix of a partition.
SPAN = 200
#: Leaves of one partition that a task holds at once; a larger one gets longer prefixes.
HELD = 20_000
#: So many ids (16 MB) are broadcast at most.
BROADCAST_IDS = 2_000_000

_POS_BITS = np.uint64(24)
_POS = np.uint64((1 << 24) - 1)
_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Finds the anchors of texts; holds the tables of the rolling hash."""

    def __init__(self, span: int = SPAN):
        self.k = span // 2
        self.w = span - self.k + 1
        self.grow(1 << 16)

    def grow(self, n: int) -> None:
        self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)

    def _block(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, k = len(codes), self.k
        if n > len(self.up):
            self.grow(min(_BLOCK * 2, 1 << int(n).bit_length()))
        v = codes.astype(np.uint64)
        v *= np.uint64(0xD6E8FEB86659FD93)
        v ^= v >> np.uint64(29)
        v *= self.up[:n]
        s = np.empty(n + 1, dtype=np.uint64)
        s[0] = 0
        np.cumsum(v, out=s[1:])
        h = s[k:] - s[:-k]
        h *= self.down[: n - k + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        m = (h & ~_POS) | (_POS - np.arange(len(h), dtype=np.uint64))
        width = 1
        while width * 2 <= self.w:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        if self.w > width:
            rest = self.w - width
            m = np.minimum(m[:-rest], m[rest:])
        first = np.empty(len(m), dtype=bool)
        first[0] = True
        np.not_equal(m[1:], m[:-1], out=first[1:])
        pos = (_POS - (m[first] & _POS)).astype(np.int64)
        return pos, h[pos].view(np.int64)

    def find(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Places and prefix hashes of the anchors of a text of at least ``span`` code points."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if len(codes) <= _BLOCK:
            return self._block(codes)
        found: dict[int, int] = {}
        for at in range(0, len(codes) - 2 * self.k + 1, _BLOCK - 2 * self.k):
            pos, h = self._block(codes[at : at + _BLOCK])
            found.update(zip((pos + at).tolist(), h.tolist(), strict=True))
        pos = np.array(sorted(found), dtype=np.int64)
        return pos, np.array([found[p] for p in pos.tolist()], dtype=np.int64)


def anchors(texts: DataFrame, span: int) -> DataFrame:
    """doc_id, pos (from 0), h of every anchor."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Anchors(span).find
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at : at + 512]
                got = [find(t) for t in part["text"]]
                if got:
                    yield pd.DataFrame({"doc_id": np.repeat(part["doc_id"].to_numpy(), [len(p) for p, _ in got]), "pos": np.concatenate([p for p, _ in got]).astype("int32"), "h": np.concatenate([h for _, h in got])})

    return texts.select("doc_id", "text").mapInPandas(scan, "doc_id bigint, pos int, h bigint")


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def tree_nodes(rights: list[str]) -> list[tuple[int, list[tuple[int, int]]]]:
    """Internal nodes (depth, children as ranges of the sorted suffixes) of the suffix tree, from common prefixes of neighbours."""
    out: list[tuple[int, list[tuple[int, int]]]] = []
    stack: list[list] = []  # [depth, start, children]
    n = len(rights)
    lcp = [common(rights[i - 1], rights[i]) for i in range(1, n)] + [-1]
    for i in range(n):
        d, child = lcp[i], (i, i + 1)
        while stack and stack[-1][0] > d:
            depth, start, children = stack.pop()
            out.append((depth, [*children, child]))
            child = (start, i + 1)
        if d < 0:
            break
        if stack and stack[-1][0] == d:
            stack[-1][2].append(child)
        else:
            stack.append([d, child[0], [child]])
    return out


def shared_spans(docs: list[str], lefts: list[str], rights: list[str], span: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(node, child, leaf, before, after) for one partition: leaves of one node in different children share at least ``span``.

    ``rights`` are sorted and end after ``span``, ``lefts`` are reversed and
    end after half of it; ``docs`` names the document of a leaf, or the leaf
    itself where it has several.  ``before`` and ``after`` are the longest part
    around the anchor that another document of the node shares.  Depths lie between half a span and a
    span, so a leaf is visited by as many nodes as that at most.
    """
    for k, (depth, children) in enumerate(tree_nodes(rights)):
        need = max(0, span - depth)
        buckets: dict[str, list[tuple[str, int, int]]] = {}
        for c, (a, b) in enumerate(children):
            for i in range(a, b):
                if len(lefts[i]) >= need:
                    buckets.setdefault(lefts[i][:need], []).append((lefts[i], c, i))
        for j, rows in enumerate(buckets.values()):
            if len(rows) < 2 or len({docs[i] for _, _, i in rows}) < 2:
                continue
            rows.sort()
            reach = [0] * len(rows)
            for order in (range(len(rows)), range(len(rows) - 1, -1, -1)):
                # the nearest row of another document in this direction, and of the row itself one before that
                near: tuple[int, int] | None = None  # (document, common so far) of the last row
                other = -1  # common so far with the last row of a document other than near's
                last = None
                for r in order:
                    left, _, i = rows[r]
                    if last is not None:
                        c = common(left, last)
                        near = (near[0], min(near[1], c))
                        other = min(other, c)
                        if near[0] != docs[i]:
                            reach[r] = max(reach[r], near[1])
                            other = near[1]
                        elif other >= 0:
                            reach[r] = max(reach[r], other)
                    near, last = (docs[i], len(left)), left
            for (_, c, i), left in zip(rows, reach, strict=True):
                yield (k * 1_000_003 + j, c, i, max(left, need), depth)


def _trees(span: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["h", "node", "child", "x", "y", "before", "after"]
        held: list[tuple] = []
        out: list[tuple] = []

        def close():
            if len(held) > 1:
                h, who, x, y, left, right = zip(*held, strict=True)
                out.extend((h[0], node, child, x[i], y[i], before, after) for node, child, i, before, after in shared_spans(who, left, right, span))
            held.clear()

        def flush():
            pdf = pd.DataFrame(out, columns=cols)
            out.clear()
            return pdf.astype({"node": "int64", "child": "int32", "before": "int32", "after": "int32"})

        for pdf in batches:
            for row in zip(pdf["h"], pdf["who"], pdf["x"], pdf["y"], pdf["l"], pdf["r"], strict=True):
                if held and held[0][0] != row[0]:
                    close()
                    if len(out) > 20_000:
                        yield flush()
                held.append(row)
        close()
        if out:
            yield flush()

    return run


def leaves(texts: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """The leaves of all partitions that several texts have, and where they come from.

    Leaves: h (the prefix), leaf (a 128-bit hash), who (its document, or the
    leaf itself where it has several), l (reversed, before the anchor), r.
    Places: leaf, doc_id, pos.  A leaf that two documents have is a shared span
    by itself.
    """
    half = span // 2
    # read for the partitions' sizes and for their suffixes
    found = stored(anchors(texts, span))
    groups = found.groupBy("h").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b")).filter("_a < _b").select("h")
    hits = found.join(groups, "h")
    # the places of one text are as many as its length allows
    places = hits.groupBy("doc_id").agg(F.collect_list(F.struct("h", "pos")).alias("_p"))
    context = F.transform(
        "_p",
        lambda p: F.struct(
            p["h"].alias("h"), p["pos"].alias("pos"),
            F.reverse(F.substring(F.col("text"), F.greatest(p["pos"] - half, F.lit(0)) + 1, F.least(p["pos"], F.lit(half)))).alias("l"),
            F.substring(F.col("text"), p["pos"] + 1, F.lit(span)).alias("r"),
        ),
    )
    suffixes = texts.select("doc_id", "text").join(places, "doc_id").select("doc_id", F.inline(context))
    suffixes = stored(suffixes.withColumn("leaf", F.struct(F.xxhash64("l", "r").alias("x"), F.xxhash64("r", "l", F.lit(1)).alias("y"))))
    one = suffixes.groupBy("h", "leaf").agg(F.first("l").alias("l"), F.first("r").alias("r"), F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b"))
    who = F.when(F.col("_a") == F.col("_b"), F.col("_a").cast("string")).otherwise(F.concat(F.lit("#"), F.col("leaf.x").cast("string")))
    return one.select("h", "leaf", who.alias("who"), "l", "r"), suffixes.select("leaf", "doc_id", "pos")


def _common(x: str, y: str, most: int) -> Column:
    """Length of the common prefix of two texts of at most ``most`` code points."""
    return F.size(F.filter(F.sequence(F.lit(1), F.lit(most)), lambda i: (F.length(x) >= i) & (F.substring(F.col(x), F.lit(1), i) == F.substring(F.col(y), F.lit(1), i))))


def partitioned(found: DataFrame, span: int, held: int, widest: bool) -> tuple[DataFrame, DataFrame | None]:
    """Leaves with the key of a partition that fits, and those of partitions whose leaves all share a span, one node each.

    With ``widest`` such a partition is split on until its prefix is one window
    of the span, so that every window that a leaf shares with any other is met.
    """
    d = found.select(F.struct("h", F.lit(0).alias("k")).alias("key"), F.lit(0).alias("a"), F.lit(span // 2).alias("b"), "leaf", "who", "l", "r")
    small_, whole = [], []
    while True:
        # the next round reads these again
        d = stored(d)
        big = small(d.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > held).select("key"), BROADCAST_IDS)
        if big.isEmpty():
            small_.append(d)
            break
        # what all leaves of a partition share is what the first and the last of them share
        ends = [f(c).alias(f"_{f.__name__}_{c}") for f in (F.min, F.max) for c in ("l", "r")]
        big = d.join(big, "key", "left_semi").groupBy("key").agg(*ends)
        big = small(big.select("key", _common("_min_l", "_max_l", span).alias("_a"), _common("_min_r", "_max_r", span).alias("_b")), BROADCAST_IDS)
        jump = (F.col("_a") + F.col("_b") < span) if widest else F.lit(True)
        small_.append(d.join(big, "key", "left_anti"))
        over = d.join(big, "key").withColumns({"a": F.when(jump, F.col("_a")).otherwise(F.col("a")), "b": F.when(jump, F.col("_b")).otherwise(F.col("b"))}).drop("_a", "_b")
        full = F.col("a") + F.col("b") >= span
        whole.append(over.filter(full))
        more = F.ceil((span - F.col("a") - F.col("b")) / 2).cast("int")
        two = F.explode(F.array(F.struct((F.col("a") + more).alias("a"), F.col("b").alias("b")), F.struct(F.col("a").alias("a"), (F.col("b") + more).alias("b")))).alias("_t")
        over = over.filter(~full).select("key", "leaf", "who", "l", "r", two).select("key", "leaf", "who", "l", "r", "_t.a", "_t.b").filter((F.length("l") >= F.col("a")) & (F.length("r") >= F.col("b")))
        text = F.concat_ws("|", F.substring("l", F.lit(1), F.col("a")), F.substring("r", F.lit(1), F.col("b")))
        d = over.select(F.struct(F.xxhash64(text, "a").alias("h"), (F.col("a") * 1000 + F.col("b")).alias("k")).alias("key"), "a", "b", "leaf", "who", "l", "r")
    fits = functools.reduce(DataFrame.unionByName, small_)
    return fits, functools.reduce(DataFrame.unionByName, whole) if whole else None


def spans_of_texts(texts: DataFrame, span: int = SPAN, held: int = HELD, widest: bool = False) -> DataFrame:
    """Memberships (h, node, child, doc_id, lo, hi) over texts that are all different.

    Rows of one (h, node) in different children share the span; where the child
    is NULL, all documents of the node do.  Leaves that several documents have
    are nodes of their own with a NULL child.  ``widest`` finds every shared
    place in partitions that do not fit, where otherwise every link is enough.
    """
    half = span // 2
    found, places = leaves(texts, span)
    fits, whole = partitioned(found, span, held, widest)
    key = F.xxhash64("key")
    rows = fits.select(key.alias("h"), "who", F.col("leaf.x").alias("x"), F.col("leaf.y").alias("y"), "l", "r")
    trees = rows.repartition("h").sortWithinPartitions("h", "r", "l").mapInPandas(_trees(span), "h bigint, node bigint, child int, x bigint, y bigint, before int, after int")
    in_tree = trees.withColumn("leaf", F.struct("x", "y")).join(places, "leaf")
    in_tree = in_tree.select("h", "node", "child", "doc_id", (F.col("pos") - F.col("before")).alias("lo"), (F.col("pos") + F.col("after")).alias("hi"))
    several = places.groupBy("leaf").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b")).filter("_a < _b").select("leaf")
    sizes = texts.select("doc_id", F.length("text").alias("_n"))
    own = places.join(several, "leaf").join(sizes, "doc_id")
    own = own.select(F.col("leaf.x").alias("h"), F.col("leaf.y").alias("node"), F.lit(None).cast("int").alias("child"), "doc_id", F.greatest(F.col("pos") - half, F.lit(0)).alias("lo"), F.least(F.col("pos") + span, F.col("_n")).alias("hi"))
    out = in_tree.unionByName(own)
    if whole is not None:
        nodes = whole.select(key.alias("h"), F.col("key.k").cast("bigint").alias("node"), "leaf", "a", "b").join(places, "leaf")
        out = out.unionByName(nodes.select("h", "node", F.lit(None).cast("int").alias("child"), "doc_id", (F.col("pos") - F.col("a")).alias("lo"), (F.col("pos") + F.col("b")).alias("hi")))
    return out


def copy_classes(documents: DataFrame, span: int) -> DataFrame:
    """doc_id, first (the least doc_id with the same text), n (documents with it), for texts of at least ``span`` code points."""
    sized = documents.filter(F.length("text") >= span).select("doc_id", F.xxhash64("text").alias("_x"), F.xxhash64("text", F.lit(1)).alias("_y"))
    classes = sized.groupBy("_x", "_y").agg(F.min("doc_id").alias("first"), F.count_distinct("doc_id").alias("n"))
    return stored(sized.distinct().join(classes, ["_x", "_y"]).select("doc_id", "first", "n"))


def different_texts(documents: DataFrame, classes: DataFrame, span: int) -> DataFrame:
    """One document of each text.  The ids of the copies are counted: few enough are broadcast, so that no text is shuffled; more are joined by shuffle."""
    copies = classes.filter("doc_id <> first").select("doc_id")
    texts = documents.filter(F.length("text") >= span).select("doc_id", "text")
    return texts.join(F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies, "doc_id", "left_anti")


def sharing_texts(members: DataFrame) -> DataFrame:
    """Pairs a < b of different texts that share a span."""
    rows = stored(members.select("h", "node", "child", "doc_id").distinct())
    a = rows.select("h", "node", F.col("child").alias("ca"), F.col("doc_id").alias("a"))
    b = rows.select("h", "node", F.col("child").alias("cb"), F.col("doc_id").alias("b"))
    apart = (F.col("a") < F.col("b")) & (F.col("ca").isNull() | F.col("cb").isNull() | (F.col("ca") != F.col("cb")))
    return a.join(b, ["h", "node"]).filter(apart).select("a", "b").distinct()


def sharing_pairs(documents: DataFrame, span: int = SPAN, held: int = HELD) -> DataFrame:
    """doc_a < doc_b: every pair of documents whose texts share at least ``span`` code points, copies included.

    ``documents``: doc_id (unique), text.  NULL, empty and shorter texts take
    no part; rows with a NULL doc_id are left out.
    """
    documents = documents.select("doc_id", "text").dropna()
    classes = copy_classes(documents, span)
    texts = different_texts(documents, classes, span)
    pairs = sharing_texts(spans_of_texts(texts, span, held))
    first = classes.select(F.col("first").alias("a"), F.col("doc_id").alias("x"))
    second = classes.select(F.col("first").alias("b"), F.col("doc_id").alias("y"))
    across = pairs.join(first, "a").join(second, "b").select("x", "y")
    copied = classes.filter("n > 1").select("first", "doc_id")
    within = copied.select("first", F.col("doc_id").alias("x")).join(copied.select("first", F.col("doc_id").alias("y")), "first").filter("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b")).distinct()


def shared_share(documents: DataFrame, span: int = SPAN, held: int = HELD) -> DataFrame:
    """Per document: first (of its copies), copies, n_chars, shared_chars and share, the part of its text that lies in spans found elsewhere.

    Texts that are NULL, empty or too short have a share of 0; a copied text is shared whole.
    """
    documents = documents.select("doc_id", "text").filter("doc_id IS NOT NULL")
    classes = copy_classes(documents.dropna(), span)
    texts = different_texts(documents.dropna(), classes, span)
    spans = spans_of_texts(texts, span, held, widest=True).groupBy("doc_id", "lo").agg(F.max("hi").alias("hi"))
    w = Window.partitionBy("doc_id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    covered = spans.withColumn("_end", F.coalesce(F.max("hi").over(w), F.lit(0))).groupBy("doc_id").agg(F.sum(F.greatest(F.col("hi") - F.greatest("lo", "_end"), F.lit(0))).alias("_shared"))
    rows = documents.select("doc_id", F.length("text").cast("bigint").alias("n_chars")).distinct()
    out = rows.join(classes, "doc_id", "left").join(covered.withColumnRenamed("doc_id", "first"), "first", "left")
    shared = F.when(F.col("n") > 1, F.col("n_chars")).otherwise(F.coalesce("_shared", F.lit(0)))
    return out.select("doc_id", F.coalesce("first", "doc_id").alias("first"), F.coalesce("n", F.lit(1)).alias("copies"), F.coalesce("n_chars", F.lit(0)).alias("n_chars"), shared.cast("bigint").alias("shared_chars"), F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(0.0).alias("share"))


def span_members(documents: DataFrame, span: int = SPAN, held: int = HELD) -> DataFrame:
    """Who shares what, in as many rows as there are shared places: span (its hash), doc_id, lo, hi (from 0), n_docs.

    Links between different texts stand between the rows of one span; copies of
    a text are named by ``p8_shares``' first.  Of the children of a tree's node
    each row keeps its own, so rows of one span with the same ``child`` need not
    share it; a NULL child shares it with all.
    """
    documents = documents.select("doc_id", "text").dropna()
    texts = different_texts(documents, copy_classes(documents, span), span)
    rows = stored(spans_of_texts(texts, span, held).withColumn("span", F.xxhash64("h", "node")).select("span", "child", "doc_id", "lo", "hi").distinct())
    many = rows.groupBy("span").agg(F.count_distinct("doc_id").alias("n_docs")).filter("n_docs > 1")
    return rows.join(many, "span")
