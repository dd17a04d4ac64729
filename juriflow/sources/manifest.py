"""Manifest of documents: YAML to DataFrames, files found by name or pattern."""

from __future__ import annotations

import fnmatch
import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "doc_id string, file string, file_glob string, file_regex string, doc_type string, code string, version_year int, published string, modified string, source_url string, ocr string, subdocs array<struct<code:string,first_page:int>>, layout map<string,string>"


def load_manifest(path: str) -> dict:
    """The manifest as it is: folders and a list of documents."""
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def entries(spark: SparkSession, manifest: dict) -> DataFrame:
    """The manifest's documents as rows; fields it does not give are NULL, unknown ones are left out."""
    names = [f.split(" ")[0] for f in ENTRY.split(", ")]

    def value(d: dict, n: str):
        v = d.get(n)
        if n == "file_regex":
            return glob_to_regex(d["file_glob"]) if d.get("file_glob") else None
        if n == "subdocs":
            return [(s.get("code"), s.get("first_page")) for s in v or []]
        if n == "layout":
            return {k: json.dumps(x) if isinstance(x, list) else str(x) for k, x in (v or {}).items()}
        return str(v) if v is not None and n in ("published", "modified") else v

    return spark.createDataFrame([tuple(value(d, n) for n in names) for d in manifest.get("docs", [])], ENTRY)


def select_docs(found: DataFrame, only: list[str] | None) -> DataFrame:
    """The documents named; all without names; an unknown selection is an error that lists the ids."""
    if not only:
        return found
    got = found.filter(F.col("doc_id").isin(only))
    if got.isEmpty():
        raise ValueError(f"none of {only} is in the manifest")
    return got


def glob_to_regex(pattern: str) -> str:
    """A file pattern, case-insensitive, as a regular expression that Spark's ``rlike`` takes."""
    body = fnmatch.translate(pattern.lower())
    return re.sub(r"^\(\?s:(.*)\)\\[Zz]$", r"(?s)^(?:\1)$", body).replace("(?>", "(?:")


def resolve_files(found: DataFrame, files: DataFrame) -> DataFrame:
    """doc_id, path of each document: the exact file if it is there, else the only one that its pattern matches.

    ``files``: path, name.  Adds ``error``: 'missing' or 'ambiguous' where no
    single file was found, and NULL path there.
    """
    exact = found.join(files, found["file"] == files["name"]).select("doc_id", F.col("path").alias("_exact"))
    globs = found.filter("file_regex IS NOT NULL").select("doc_id", F.col("file_regex").alias("_re"))
    hits = globs.join(files, F.lower(F.col("name")).rlike(F.col("_re"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"), F.min("path").alias("_path"))
    d = found.select("doc_id").join(exact, "doc_id", "left").join(hits, "doc_id", "left")
    one = F.coalesce("_exact", F.when(F.col("_n") == 1, F.col("_path")))
    return d.select("doc_id", one.alias("path"), F.when(one.isNull(), F.when(F.coalesce("_n", F.lit(0)) > 1, "ambiguous").otherwise("missing")).alias("error"))


def subdocument_ranges(found: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, stem, code, first_page, last_page of each part of a document; a document without parts is one.

    ``pages``: doc_id, n_pages.  Parts without a first page are left out; each
    ends before the next one, the last at the document's end.
    """
    parts = F.array_sort(F.filter("subdocs", lambda s: s["first_page"].isNotNull()), lambda a, b: a["first_page"] - b["first_page"])
    d = found.select("doc_id", "code", parts.alias("_p")).join(pages.select("doc_id", "n_pages"), "doc_id")
    last = F.transform("_p", lambda s, i: F.struct(s["code"].alias("code"), s["first_page"].alias("first_page"), F.coalesce(F.get("_p", i + 1)["first_page"] - 1, F.col("n_pages")).alias("last_page"), F.concat("doc_id", F.lit("__"), s["code"]).alias("stem")))
    whole = F.array(F.struct("code", F.lit(1).alias("first_page"), F.col("n_pages").alias("last_page"), F.col("doc_id").alias("stem")))
    return d.select("doc_id", F.inline(F.when(F.size("_p") > 0, last).otherwise(whole))).select("doc_id", "stem", "code", "first_page", "last_page")


def pages_of_parts(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """Lines with the part that their page lies in; pages are spelled out, so that the join is by equality."""
    pages = ranges.filter("first_page <= last_page").select("doc_id", "stem", "code", F.explode(F.sequence("first_page", "last_page")).alias("page"))
    return lines.join(pages, ["doc_id", "page"])


def one_bound_codes(ranges: DataFrame) -> DataFrame:
    """Documents whose id names two codes but which have one part."""
    n = ranges.groupBy("doc_id").agg(F.count(F.lit(1)).alias("parts"))
    return n.filter((F.col("parts") == 1) & F.lower("doc_id").contains("cgi_lpf")).select("doc_id")
