"""Markdown files with front matter, and their sidecars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRONT = r"(?s)^---\n(.*?)\n---\n"


def read_markdown(spark: SparkSession, path: str, suffix: str, stems: list[str] | None = None) -> DataFrame:
    """stem, header (YAML, NULL where there is none), body of the files ``*suffix``."""
    d = spark.read.text(f"{path}/*{suffix}", wholetext=True).select(F.regexp_replace(F.col("_metadata.file_name"), F.lit(suffix.replace(".", r"\.") + "$"), F.lit("")).alias("stem"), "value")
    return _parted(d.withColumn("stem", F.url_decode("stem")), stems)


def read_documents(spark: SparkSession, path: str, stems: list[str] | None = None) -> DataFrame:
    """The same for what ``sinks.write_markdown`` wrote."""
    d = spark.read.schema("value string, doc_id string").text(path, wholetext=True)
    return _parted(d.select(F.col("doc_id").alias("stem"), F.regexp_replace("value", "\n$", "").alias("value")), stems)


def _parted(d: DataFrame, stems: list[str] | None) -> DataFrame:
    d = d.filter(F.col("stem").isin(stems)) if stems else d
    has = F.col("value").rlike(FRONT)
    return d.select("stem", F.when(has, F.regexp_extract("value", FRONT, 1)).alias("header"), F.when(has, F.regexp_replace("value", FRONT, "")).otherwise(F.col("value")).alias("body"))


def md_lines(files: DataFrame) -> DataFrame:
    """Lines (doc_id, seq, text) of files read by ``read_markdown``; the stem is the document."""
    return files.select(F.col("stem").alias("doc_id"), F.posexplode(F.split("body", "\n")).alias("seq", "text")).withColumn("seq", F.col("seq").cast("bigint"))


def front_matter(files: DataFrame) -> DataFrame:
    """Typed columns of the YAML headers: doc_id (the stem), front_id, source_doc_id, doc_type, code, version_year, published, modified, source_url, pdf_file, pdf_pages, p95_len, body_size_pt, ocr, structured_markdown."""
    one = lambda k: F.nullif(F.regexp_replace(F.regexp_extract("header", rf"(?m)^{k}:[ \t]*(.*)$", 1), "^['\"]|['\"]$", ""), F.lit(""))
    text = ["source_doc_id", "doc_type", "code", "published", "modified", "source_url", "pdf_file", "ocr"]
    pages = F.regexp_extract_all(F.regexp_extract("header", r"(?s)(?:^|\n)pdf_pages:[ \t]*((?:\[[^\]]*\])|(?:\n- *\d+)+)", 1), F.lit(r"(\d+)"), F.lit(1)).cast("array<int>")
    whole = lambda k: F.regexp_extract("header", rf"(?m)^{k}:[ \t]*(\d+)", 1)
    return files.select(
        F.col("stem").alias("doc_id"), one("doc_id").alias("front_id"), *[one(k).alias(k) for k in text], pages.alias("pdf_pages"),
        *[F.nullif(whole(k), F.lit("")).cast("int").alias(k) for k in ("version_year", "p95_len")], F.nullif(F.regexp_extract("header", r"(?m)^body_size_pt:[ \t]*([\d.]+)", 1), F.lit("")).cast("double").alias("body_size_pt"),
        (F.lower(F.coalesce(one("structured_markdown"), F.lit("false"))) == "true").alias("structured_markdown"),
    )


def read_sidecar(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON-lines sidecar with an explicit schema; an absent one is empty."""
    try:
        return spark.read.schema(schema).json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
