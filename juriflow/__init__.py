"""juriflow: a Spark-native engine that structures legal and tax documents.

Positioned spans, marked Markdown lines and OCR pages are ordered DataFrames;
every stage is a declarative plan over them.
"""

__version__ = "0.1.0"
