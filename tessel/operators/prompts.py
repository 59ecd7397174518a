"""Blocks of facts and documents within token budgets, and the healing of blanks in finished token arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessel.functions.tokens import DEFAULT, encoding

# The keys of facts in the order of a block, and by priority; what stands between the items of a line.
KEYS = ("RET", "EXPECT", "ARG", "LOCAL", "FIELD", "PROPERTY", "RECV", "MEMBER", "CALL")
PRIORITY = ("EXPECT", "RECV", "CALL", "ARG", "LOCAL", "RET", "MEMBER", "FIELD", "PROPERTY")
SEPARATORS = {"MEMBER": "; ", "CALL": " | "}
MAX_ITEMS = 24


def block(lines: Mapping[str, Sequence[str]], budget: int, size) -> str:
    """The lines of a block that fit a budget: by priority each takes as many of its first items as fit, and comes out in the
    order of keys. ``size`` measures a line; two tokens of the budget are kept for the marks around the block."""
    left, taken = budget - 2, {}
    for key in PRIORITY:
        items = list(lines.get(key) or ())[:MAX_ITEMS]
        joined = lambda n, key=key, items=items: f"{key} {SEPARATORS.get(key, ' ').join(items[:n])}"
        lo, hi = 0, len(items)  # the size of a line grows with its items
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if size(joined(mid)) + 1 <= left else (lo, mid - 1)
        if lo:
            taken[key] = joined(lo)
            left -= size(taken[key]) + 1
    return "\n".join(taken[k] for k in KEYS if k in taken)


def facts_block(lines: Column, budget: int, path: str = DEFAULT) -> Column:
    """The block of a map<string, array<string>> of fact lines within a budget of tokens; empty where nothing fits."""

    def run(s: pd.Series) -> pd.Series:
        size = lambda t: len(encoding(path).encode_ordinary(t))
        return pd.Series([block({k: list(v) for k, v in dict(x).items() if v is not None}, budget, size) if x is not None else "" for x in s], dtype=object)

    return F.pandas_udf(run, "string")(lines)


def roots_block(roots: Column, budget: int, path: str = DEFAULT) -> Column:
    """The longest head of an ordered list of roots whose text fits a budget of tokens."""

    def run(s: pd.Series) -> pd.Series:
        out = []
        for x in s:
            got = ""
            for n in range(1, len(x) + 1 if x is not None else 1):
                text = " ".join(x[:n])
                if len(encoding(path).encode_ordinary(text)) > budget:
                    break
                got = text
            out.append(got)
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, "string")(roots)


def document(path: Column, left: Column, target: Column, right: Column, deps: Column | None = None, facts: Column | None = None) -> Column:
    """struct<prompt, completion, variant> of a caret: what follows it first, then what is known, the path and what precedes it. The
    blanks before the caret belong to the completion where code stands before them. Without deps and facts the variant is none,
    with deps alone deps, else full."""
    from tessel.operators.edits import healed

    a, b = healed(left, target)
    empty = F.lit("")
    wrap = lambda c, x, y: F.when(F.coalesce(c, empty) == "", empty).otherwise(F.concat(F.lit(x), c, F.lit(y)))
    d = empty if deps is None else wrap(deps, "<|reserved_0|>", "")
    f = empty if facts is None else wrap(facts, "<|reserved_1|>", "<|reserved_2|>")
    # facts stand before the line of the caret, so that the line itself stays whole
    head = F.regexp_extract(a, r"(?s)^(.*\n)[^\n]*\z", 1)
    line = F.substr(a, F.length(head) + 1)
    prompt = F.concat(F.lit("<|fim_prefix|><|fim_suffix|>"), right, F.lit("<|fim_middle|>"), d, F.lit("<|file_sep|>"), path, F.lit("\n"), head, f, line)
    variant = F.when((d == "") & (f == ""), "none").when(f == "", "deps").otherwise("full")
    return F.struct(prompt.alias("prompt"), F.concat(b, F.lit("<|endoftext|>")).alias("completion"), variant.alias("variant"))


def blank_tail(ids: Sequence[int], text_of, special: frozenset[int] = frozenset()) -> int:
    """How many tokens at the end of a prompt are blanks after code, to be moved to the completion: whole tokens of spaces and
    tabs whose line holds code before them; 0 for indentation."""
    n = 0
    while n < len(ids) and ids[-1 - n] not in special and (t := text_of(ids[-1 - n])) and not t.strip(b" \t"):
        n += 1
    if not n or n == len(ids) or ids[-1 - n] in special:
        return 0
    before = text_of(ids[-1 - n])
    return n if before[-1:] not in (b"", b"\n", b"\r", b" ", b"\t") else 0


def healed_ids(ids: Column, loss_start: Column, path: str = DEFAULT) -> Column:
    """The new start of the loss in a document's token array: blanks after code at the end of its prompt become a part of the
    completion. The tokens themselves stay, so a rewrite of shards changes one number per document."""

    def run(x: pd.Series, at: pd.Series) -> pd.Series:
        e = encoding(path)
        text = lambda i: e.decode_single_token_bytes(int(i))
        return pd.Series([None if i is None or pd.isna(k) else int(k) - blank_tail([int(v) for v in i[: int(k)]], text) for i, k in zip(x, at, strict=True)], dtype="Int32")

    return F.pandas_udf(run, "int")(ids, loss_start)
