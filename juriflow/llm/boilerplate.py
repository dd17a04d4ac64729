"""Lines repeated across one site's documents.

Per site a weighted graph has a node for each line (in its normal form) and an
edge between lines that follow each other; a weight is the number of documents
that support it.  Nodes and edges of high support are kept, the connected
components are the boilerplate blocks, and all occurrences of their lines are
removed.  A frequent line without a frequent edge is a block of its own, as a
line's support alone makes it boilerplate; edges say which lines belong to one
block, and so which runs of lines are one occurrence of it.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from juriflow.functions.consistent import consistent_form, let
from juriflow.session import small, stored

#: A line is boilerplate if at least so many documents of the site and at least this share of them have it.
LEAST_DOCS = 4
LEAST_SHARE = 0.2
#: So many rows (about 60 MB) of sites, frequent lines or their blocks are broadcast at most.
BROADCAST_ROWS = 500_000


def line_key(text: Column) -> Column:
    """Equal for lines that differ only in capitals, spacing, numbers, closing punctuation or look-alike characters; NULL without a letter."""
    key = F.regexp_replace(F.lower(consistent_form(text)), r"\s+", "")
    key = F.regexp_replace(F.regexp_replace(key, r"[0-9]+(?:[.,][0-9]+)*", "0"), r"\p{P}+$", "")
    return F.when(text.rlike(r"\p{L}"), key)


def keyed_lines(lines: DataFrame, documents: DataFrame) -> DataFrame:
    """source, doc_id, seq and the 128-bit key (ka, kb) of every line with a letter in the given documents."""
    hashes = let(line_key(F.col("text")), lambda k: F.struct(F.xxhash64(k).alias("ka"), F.xxhash64(k, F.lit(1)).alias("kb")))
    lettered = lines.filter(F.col("text").rlike(r"\p{L}")).select("doc_id", "seq", hashes.alias("_h"))
    return lettered.select("doc_id", "seq", "_h.ka", "_h.kb").join(documents, "doc_id")


def site_sizes(documents: DataFrame, least: int, share: float) -> DataFrame:
    """The support that each site asks for: source, need."""
    return documents.groupBy("source").agg(F.greatest(F.lit(least), F.ceil(F.lit(share) * F.count(F.lit(1)))).cast("bigint").alias("need"))


def frequent_nodes(keyed: DataFrame, needs: DataFrame) -> DataFrame:
    """source, ka, kb, support of the lines that enough documents of their site have."""
    once = keyed.groupBy("source", "ka", "kb", "doc_id").agg(F.lit(1).alias("_one"))
    return once.groupBy("source", "ka", "kb").agg(F.count(F.lit(1)).alias("support")).join(needs, "source").filter(F.col("support") >= F.col("need"))


def frequent_edges(hits: DataFrame, needs: DataFrame) -> DataFrame:
    """Edges between frequent lines that follow each other in enough documents; neighbours are joined by place, so no document is one task."""
    before = hits.select("doc_id", (F.col("seq") + 1).alias("seq"), F.col("ka").alias("pa"), F.col("kb").alias("pb"))
    once = hits.join(before, ["doc_id", "seq"]).groupBy("source", "pa", "pb", "ka", "kb", "doc_id").agg(F.lit(1).alias("_one"))
    return once.groupBy("source", "pa", "pb", "ka", "kb").agg(F.count(F.lit(1)).alias("support")).join(needs, "source").filter(F.col("support") >= F.col("need"))


def _components(pdf: pd.DataFrame) -> pd.DataFrame:
    """Union-find over one site's frequent graph."""
    root: dict[tuple[int, int], tuple[int, int]] = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for pa, pb, ka, kb in zip(pdf["pa"], pdf["pb"], pdf["ka"], pdf["kb"], strict=True):
        a, b = find((pa, pb)), find((ka, kb))
        root[max(a, b)] = min(a, b)
    nodes = sorted(root)
    ids = {r: i for i, r in enumerate(sorted({find(n) for n in nodes}))}
    return pd.DataFrame({"source": pdf["source"].iloc[0], "ka": [n[0] for n in nodes], "kb": [n[1] for n in nodes], "block": [ids[find(n)] for n in nodes]})


def blocks(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Boilerplate blocks: source, ka, kb, block.

    One task holds one site's frequent graph.  Its size has a proven bound that
    does not grow with the number of documents: the supports of a site's nodes
    sum to at most its lines and each is at least ``share`` of its documents,
    so there are at most 1 / share times as many nodes as lines in a mean
    document.  ``boilerplate_lines`` therefore refuses a share of 0.
    """
    loops = nodes.select("source", F.col("ka").alias("pa"), F.col("kb").alias("pb"), "ka", "kb")
    graph = loops.unionByName(edges.select("source", "pa", "pb", "ka", "kb"))
    return graph.groupBy("source").applyInPandas(_components, "source string, ka bigint, kb bigint, block int")


def boilerplate_lines(lines: DataFrame, documents: DataFrame, least: int = LEAST_DOCS, share: float = LEAST_SHARE) -> DataFrame:
    """Occurrences of boilerplate: source, doc_id, seq, block, support (of the line); one row for each place.

    ``lines``: doc_id, seq, text; ``documents``: doc_id, source, distinct.
    Lines of other documents, lines without a letter and lines with a NULL
    doc_id or seq are never boilerplate.  Repeated rows count once.
    """
    if share <= 0:
        raise ValueError("share must be positive, as it bounds a site's graph")
    lines, documents = lines.select("doc_id", "seq", "text").dropna(subset=["doc_id", "seq"]), documents.select("doc_id", "source").dropna().distinct()
    # read for the supports and again for the occurrences
    keyed = stored(keyed_lines(lines, documents))
    needs = small(site_sizes(documents, least, share), BROADCAST_ROWS)
    nodes = small(frequent_nodes(keyed, needs).select("source", "ka", "kb", "support"), BROADCAST_ROWS)
    hits = stored(keyed.join(nodes, ["source", "ka", "kb"]).distinct())
    found = small(blocks(nodes, frequent_edges(hits, needs)), BROADCAST_ROWS)
    return hits.join(found, ["source", "ka", "kb"]).select("source", "doc_id", "seq", "block", "support", "ka", "kb")


def block_report(places: DataFrame) -> DataFrame:
    """What each block is: source, block, lines (different ones), least_support, most_support, documents, occurrences (runs of its lines on end), rows."""
    p = places.select("source", "block", "doc_id", "seq", "ka", "kb", "support")
    before = p.select("source", "block", "doc_id", (F.col("seq") + 1).alias("seq"), F.lit(1).alias("_b")).distinct()
    p = p.join(before, ["source", "block", "doc_id", "seq"], "left")
    per = p.groupBy("source", "block", "ka", "kb").agg(F.max("support").alias("support"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_b").isNull()).alias("opens"))
    docs = p.groupBy("source", "block", "doc_id").agg(F.lit(1).alias("_d")).groupBy("source", "block").agg(F.count(F.lit(1)).alias("documents"))
    out = per.groupBy("source", "block").agg(F.count(F.lit(1)).alias("lines"), F.min("support").alias("least_support"), F.max("support").alias("most_support"), F.sum("rows").alias("rows"), F.sum("opens").alias("occurrences"))
    return out.join(docs, ["source", "block"])


def without_boilerplate(lines: DataFrame, documents: DataFrame, **limits) -> DataFrame:
    """The lines that remain; all columns and repeated rows are kept, lines with a NULL doc_id or seq too."""
    gone = boilerplate_lines(lines, documents, **limits).select(F.col("doc_id").alias("_d"), F.col("seq").alias("_s")).distinct()
    return lines.join(gone, (F.col("doc_id") == F.col("_d")) & (F.col("seq") == F.col("_s")), "left_anti")
