"""Optional scan of PDF files as a Python data source; without the PDF library it says so when it is read.

``spark.read.format("pdf_spans").option("path", file).option("doc_id", id).load()``;
one partition for each range of pages.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPANS = "doc_id string, page int, page_w double, page_h double, raw_line int, span_ix int, text string, size double, bold boolean, sup boolean, x0 double, y0 double, x1 double, y1 double"
TABLES = "doc_id string, page int, x0 double, y0 double, x1 double, y1 double, rows array<array<string>>"


def _library():
    try:
        import pymupdf
    except ImportError as e:
        raise RuntimeError("reading PDF files needs the package pymupdf; read spans from parquet instead") from e
    return pymupdf


class _Pages(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.doc_id = options.get("path"), options.get("doc_id", options.get("path"))
        self.step, self.first, self.last = int(options.get("pages_per_task", 20)), int(options.get("first", 1)), int(options.get("last", 0))

    def partitions(self):
        with _library().open(self.path) as doc:
            last = self.last or len(doc)
        return [_Pages(a, min(a + self.step - 1, last)) for a in range(self.first, last + 1, self.step)]


class SpanReader(_Reader):
    def read(self, partition):
        with _library().open(self.path) as doc:
            for n in range(partition.first, partition.last + 1):
                page = doc[n - 1]
                line_no = 0
                for block in page.get_text("dict")["blocks"]:
                    for line in block["lines"] if block.get("type") == 0 else []:
                        for i, s in enumerate(s for s in line["spans"] if s["text"]):
                            font = s.get("font", "").lower()
                            heavy = bool(s["flags"] & 16) or "bold" in font or font.endswith("-bd")
                            yield (self.doc_id, n, page.rect.width, page.rect.height, line_no, i, s["text"], float(s["size"]), heavy, bool(s["flags"] & 1), s["bbox"][0], line["bbox"][1], s["bbox"][2], line["bbox"][3])
                        line_no += 1


class TableReader(_Reader):
    def read(self, partition):
        with _library().open(self.path) as doc:
            for n in range(partition.first, partition.last + 1):
                for t in doc[n - 1].find_tables().tables:
                    yield (self.doc_id, n, *map(float, t.bbox), [[None if c is None else str(c) for c in r] for r in t.extract()])


class SpanSource(DataSource):
    @classmethod
    def name(cls):
        return "pdf_spans"

    def schema(self):
        return SPANS

    def reader(self, schema):
        return SpanReader(self.options)


class TableSource(DataSource):
    @classmethod
    def name(cls):
        return "pdf_tables"

    def schema(self):
        return TABLES

    def reader(self, schema):
        return TableReader(self.options)


def register(spark: SparkSession) -> None:
    """Register both formats in a session."""
    spark.dataSource.register(SpanSource)
    spark.dataSource.register(TableSource)
