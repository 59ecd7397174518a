"""Public tokenizers as column functions. Their files are a parameter; nothing here is trained."""

from __future__ import annotations

import base64
import functools
import importlib.util
import os

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@functools.lru_cache(maxsize=2)
def encoding(path: str = DEFAULT):
    """The encoding of a ranks file; the split pattern is a constant of the module beside it."""
    import tiktoken

    spec = importlib.util.spec_from_file_location("public_tokenizer_files", os.path.join(os.path.dirname(os.path.realpath(path)), "__init__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=mod.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(c: Column, path: str = DEFAULT) -> Column:
    def count(s: pd.Series) -> pd.Series:
        e = encoding(path)
        return pd.Series([None if t is None else len(e.encode_ordinary(t)) for t in s], dtype="Int32")

    return F.pandas_udf(count, "int")(c)


def encoded(c: Column, path: str = DEFAULT) -> Column:
    """struct<ids, round_trip>: token ids, and whether they decode to the text."""

    def run(s: pd.Series) -> pd.DataFrame:
        e = encoding(path)
        ids = [e.encode_ordinary(t or "") for t in s]
        return pd.DataFrame({"ids": ids, "round_trip": [e.decode(i) == (t or "") for i, t in zip(ids, s, strict=True)]})

    return F.pandas_udf(run, "ids array<int>, round_trip boolean")(c)


def last_tokens(c: Column, n: int, path: str = DEFAULT) -> Column:
    """The end of a text of at most n tokens, from the line break after the cut if there is one."""

    def run(s: pd.Series) -> pd.Series:
        e, out = encoding(path), []
        for t in s:
            ids = e.encode_ordinary(t) if t is not None else []
            if t is None or len(ids) <= n:
                out.append(t)
                continue
            tail = e.decode_bytes(ids[-n:]).decode("utf-8", "ignore")
            brk = tail.find("\n")
            out.append(tail[brk + 1 :] if 0 <= brk < len(tail) - 1 else tail)
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, "string")(c)
