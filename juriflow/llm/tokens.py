"""Sizes in tokens of a public tokenizer.

The vocabulary file's path is a parameter; the file must be reachable by the
executors.  Counts are exact: a text is cut before each plain space, which the
tokenizer's own pattern never crosses, and the pieces' counts are remembered.
Texts with a run of spaces take the tokenizer as it is.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the public vocabularies lie on this machine; pass another path elsewhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that belongs to this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Counts remembered in a worker process, about 40 MB.
REMEMBERED = 300_000


class _Counts(dict):
    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> int:
        n = len(self.encode(" " + word))
        if len(self) < REMEMBERED and len(word) < 40:
            self[word] = n
        return n


@functools.lru_cache(maxsize=2)
def counter(path: str):
    """A function from a text to its number of tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    counts = _Counts(encode)

    def count(text: str | None) -> int:
        if not text:
            return 0
        if "  " in text:
            return len(encode(text))
        first, *rest = text.split(" ")
        return len(encode(first)) + sum(map(counts.__getitem__, rest))

    return count


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Number of tokens of a text; 0 for NULL and for an empty text."""

    @F.pandas_udf("bigint")
    def sizes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(path)
        for s in batches:
            yield pd.Series([count(x) for x in s], dtype="int64")

    return sizes(text)
