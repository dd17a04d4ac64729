"""OCR pages to raw Markdown; providers are pluggable."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from juriflow.functions import patterns as P

#: Descriptions of pictures, which are noise, and figures worth checking.
NOISE_LINE = r"(?iuU)^(?:logo|photo|figure|image)\s*:\s*.*$"
ICON = r"(?iuU)\[?\bicon\s*:\s*[^\]\n]*\]?\s*"
FIGURE = "(?iu)\\d[\\d   .,]*\\s?(?:%|FCFA|F\\s?CFA|francs)|\\b\\d{1,3}(?:[   .]\\d{3})+\\b"
TIERS = ("fast", "cost_effective", "agentic", "agentic_plus")


class Provider(Protocol):
    """Turns the bytes of a document into one Markdown text per page; must be picklable."""

    def parse(self, name: str, content: bytes, tier: str, languages: tuple[str, ...]) -> list[str]: ...


class HostedProvider:
    """A hosted service, reached by an injected function.

    ``send(name, content, options)`` gives one Markdown text (or None) for each
    page; ``options`` holds tier, languages and the key read from the
    environment.  Without a function, or without the key it names, parsing
    raises an error that says what is missing.
    """

    def __init__(self, send: Callable[[str, bytes, dict], list[str | None]] | None = None, key_name: str | None = None):
        self.send, self.key_name = send, key_name

    def parse(self, name: str, content: bytes, tier: str, languages: tuple[str, ...]) -> list[str]:
        if self.send is None:
            raise RuntimeError("no function to reach the OCR service was given")
        options = {"tier": tier, "languages": languages}
        if self.key_name is not None:
            if not (key := os.environ.get(self.key_name)):
                raise RuntimeError(f"the environment does not hold {self.key_name}")
            options["key"] = key
        return ["" if text is None else text for text in self.send(name, content, options)]


def load_env(path: str) -> dict[str, str]:
    """Settings of a file of NAME=VALUE lines that the environment does not hold yet are put into it and returned; an absent file has none."""
    try:
        with open(path, encoding="utf-8") as f:
            found = re.findall(r"""^[ \t]*([^#=\s][^=\n]*?)[ \t]*=[ \t]*(?:"([^"\n]*)"|'([^'\n]*)'|([^\n]*?))[ \t]*$""", f.read(), re.MULTILINE)
    except FileNotFoundError:
        return {}
    new = {name: a or b or c for name, a, b, c in found if name not in os.environ}
    os.environ.update(new)
    return new


def ocr_pages(files: DataFrame, provider: Provider, tier: str = "agentic", languages: tuple[str, ...] = ("fr",)) -> DataFrame:
    """doc_id, page, markdown of files (doc_id, content), parsed on the executors."""
    if tier not in TIERS:
        raise ValueError(f"tier must be one of {TIERS}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for doc_id, content in zip(pdf["doc_id"], pdf["content"], strict=True):
                pages = provider.parse(doc_id, bytes(content), tier, languages)
                yield pd.DataFrame({"doc_id": doc_id, "page": range(1, len(pages) + 1), "markdown": pages})

    return files.select("doc_id", "content").mapInPandas(run, "doc_id string, page int, markdown string")


def uncached(files: DataFrame, cache: DataFrame | None, force: bool = False) -> DataFrame:
    """Files that the cache of pages (doc_id, page, markdown) lacks; all with ``force``."""
    return files if cache is None or force else files.join(cache.select("doc_id").distinct(), "doc_id", "left_anti")


def page_count_mismatch(cache: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id, cached, expected where a cache does not hold as many pages as the document (doc_id, n_pages) has."""
    c = cache.groupBy("doc_id").agg(F.count_distinct("page").alias("cached"))
    return c.join(documents.select("doc_id", F.col("n_pages").alias("expected")), "doc_id").filter("cached <> expected")


def page_lines(pages: DataFrame, drop_regex: list[str] | None = None) -> DataFrame:
    """Lines of OCR pages with icons taken out and ``dropped`` for noise: doc_id, page, line_no, text, dropped."""
    d = pages.select("doc_id", "page", F.posexplode(F.split(F.replace(F.coalesce("markdown", F.lit("")), F.lit("\r")), "\n")).alias("line_no", "_t"))
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace("_t", r"(?U)\s+$", ""), ICON, ""), r"(?U)\s+$", "")
    s = P.strip(text)
    dropped = s.rlike(NOISE_LINE)
    for r in drop_regex or []:
        dropped = dropped | s.rlike(f"(?iu)^(?:{r})")
    return d.select("doc_id", "page", "line_no", text.alias("text"), dropped.alias("dropped"))


def raw_lines(pages: DataFrame, drop_regex: list[str] | None = None) -> DataFrame:
    """Raw Markdown lines (doc_id, seq, text): a page mark, a blank, the page's lines, a blank."""
    kept = page_lines(pages, drop_regex).filter("NOT dropped")
    mark = pages.select("doc_id", "page", F.explode(F.array(F.struct(F.lit(-2).alias("line_no"), F.concat(F.lit("<!--pg:"), F.col("page").cast("string"), F.lit("-->")).alias("text")), F.struct(F.lit(-1).alias("line_no"), F.lit("").alias("text")), F.struct(F.lit(999_999).alias("line_no"), F.lit("").alias("text")))).alias("_x")).select("doc_id", "page", "_x.*")
    alls = kept.select("doc_id", "page", "line_no", "text").unionByName(mark)
    return alls.select("doc_id", (F.col("page").cast("bigint") * 1_000_002 + F.col("line_no") + 2).alias("seq"), "text")


def page_report(pages: DataFrame, drop_regex: list[str] | None = None) -> DataFrame:
    """Per document: n_pages, empty_pages (under 20 characters), dropped_lines, headings, table_rows."""
    d = page_lines(pages, drop_regex)
    kept = ~F.col("dropped")
    per = d.groupBy("doc_id", "page").agg(F.sum(F.when(kept, F.length(P.strip(F.col("text")))).otherwise(0)).alias("c"), F.count_if("dropped").alias("dropped"), F.count_if(kept & F.col("text").rlike("^#{1,6} ")).alias("h"), F.count_if(kept & F.col("text").rlike(r"^\|")).alias("r"))
    return per.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(F.col("c") < 20).alias("empty_pages"), F.sum("dropped").alias("dropped_lines"), F.sum("h").alias("headings"), F.sum("r").alias("table_rows"))


def figure_lines(pages: DataFrame) -> DataFrame:
    """Lines with a rate or an amount, to be checked against the picture: doc_id, page, line_no, text (300 characters)."""
    d = pages.select("doc_id", "page", F.posexplode(F.split(F.coalesce("markdown", F.lit("")), "\n")).alias("line_no", "_t"))
    hit = (P.strip(F.col("_t")) != "") & F.col("_t").rlike(FIGURE) & ~F.col("_t").rlike(r"^\s*\| ---")
    return d.filter(hit).select("doc_id", "page", "line_no", F.substring(P.strip(F.col("_t")), 1, 300).alias("text"))
