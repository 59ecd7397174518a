"""Token counts of texts by a public tokenizer, whole texts, Arrow batches."""

from __future__ import annotations

import base64
import functools
import importlib.util
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Texts beyond this many characters are encoded in pieces cut before white space, which the pattern never joins to the left.
PIECE = 200_000


@functools.lru_cache(maxsize=2)
def encoding(path: str):
    """The tiktoken encoding of a ranks file; the pattern lies beside it, in the folder's module."""
    import tiktoken

    spec = importlib.util.spec_from_file_location("tessel_public_tokenizers", os.path.join(os.path.dirname(os.path.realpath(path)), "__init__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=mod.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(text: str, path: str = DEFAULT) -> int:
    enc = encoding(path)
    if len(text) <= PIECE:
        return len(enc.encode_ordinary(text))
    n, at = 0, 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and not (text[end].isspace() and not text[end - 1].isspace()) and end - at < 2 * PIECE:
            end += 1
        n += len(enc.encode_ordinary(text[at:end]))
        at = end
    return n


def token_count(c: Column, path: str = DEFAULT) -> Column:
    """Tokens of a text column as int: null for a null text, 0 for an empty one."""

    @F.pandas_udf("int")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([None if x is None else count(x, path) for x in s], dtype="Int32")

    return counted(c)
