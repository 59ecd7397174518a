"""Rule sets over rows: the first that holds, all that hold, words with exceptions, ordered categories, licences by text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.functions import text as X


def all_reasons(rules: Mapping[str, Column]) -> Column:
    """The names of all rules that hold, in their order; a null condition doesn't hold. Unlike ``first_reason``, reasons add up."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))


def category(text: Column, rules: Sequence[tuple[str, str]], other: str = "other") -> Column:
    """The name of the first pattern that is found in a text, whatever the case; several patterns may share a name."""
    return F.coalesce(*[F.when(text.rlike("(?i)" + rx), F.lit(n)) for n, rx in rules], F.lit(other))


def bucket(value: Column, members: Mapping[str, Sequence[str]], prefixes: Mapping[str, Sequence[str]], rest: str) -> Column:
    """The bucket that lists a value, else the one with a prefix of it, else ``rest`` (nulls too)."""
    out = [F.when(value.isin(list(v)), F.lit(n)) for n, v in members.items()]
    for n, ps in prefixes.items():
        out += [F.when(value.startswith(p), F.lit(n)) for p in ps]
    return F.coalesce(*out, F.lit(rest))


def tagged_or_said(tags: Column, text: Column, strong: Sequence[str], words: Sequence[str], benign: Sequence[str], names: tuple[str, str]) -> Column:
    """names[0] if a tag is a strong one, else names[1] if a word is found in the text and no benign one, else null."""
    said = text.rlike("|".join(words)) & ~text.rlike("|".join(benign))
    return X.first_reason([(names[0], F.arrays_overlap(tags, F.array(*map(F.lit, strong)))), (names[1], said)])


def detected_license(text: Column) -> Column:
    """The licence whose fixed phrases a text holds, else null."""
    has = lambda s: F.contains(text, F.lit(s))
    said = lambda s: F.contains(F.lower(text), F.lit(s.lower()))
    # Phrases of licence texts.
    return (
        F.when(has("Permission is hereby granted, free of charge") & said('THE SOFTWARE IS PROVIDED "AS IS"'), "MIT")
        .when(has("Apache License") & has("Version 2.0"), "Apache-2.0")
        .when(said("This is free and unencumbered software released into the public domain"), "Unlicense")
        .when(has("Redistribution and use in source and binary forms") & said('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"'), F.when(said("Neither the name"), "BSD-3-Clause").otherwise("BSD-2-Clause"))
    )


def reconciled_license(file: Column, text: Column, declared: Column, allowlist: Sequence[str]) -> Column:
    """struct<spdx, reason, file, allowed> of a repository: what its licence file says, against what was declared.

    Two different licences are a conflict, and neither counts. A declared and allowed one stands for a text that isn't
    recognised. What is unknown isn't allowed.
    """
    found = F.when(file.isNotNull(), detected_license(text))
    clash = F.coalesce(declared != found, F.lit(False))
    stands = found.isNull() & file.isNotNull() & F.coalesce(declared.isin(list(allowlist)), F.lit(False))
    spdx = F.when(~clash, F.when(stands, declared).otherwise(found))
    reason = (
        F.when(clash, F.concat(F.lit("declared_"), declared, F.lit("_conflicts_with_detected_"), found))
        .when(stands, F.concat(F.lit("declared:"), declared, F.lit(";license_file_present:"), file, F.lit(";text_unrecognized")))
        .when(file.isNull(), "no_license_file")
        .when(found.isNull(), "license_text_unrecognized")
        .otherwise(F.concat(F.lit("license_file_text_match:"), file))
    )
    return F.struct(spdx.alias("spdx"), reason.alias("reason"), file.alias("file"), F.coalesce(spdx.isin(list(allowlist)), F.lit(False)).alias("allowed"))


def license_file_of(files: DataFrame, scope: str, path: str, content: str) -> DataFrame:
    """(scope, file, text): the licence file at the root of each scope: the shortest name, then the first."""
    named = files.where(F.lower(path).rlike(r"^(un)?licen[cs]e([.-][\w.-]*)?$|^copying([.-][\w.-]*)?$"))
    return named.groupBy(scope).agg(F.min_by(F.struct(F.col(path).alias("file"), F.col(content).alias("text")), F.struct(F.length(path), ordinal(F.col(path)))).alias("f")).select(scope, "f.file", "f.text")


def ordinal(path: Column) -> Column:
    """A sort key in the order of UTF-16 units (Spark sorts by UTF-8 bytes, which differs beyond U+FFFF)."""
    return F.encode(path, "UTF-16BE")


def score(parts: Mapping[float, Column], scale: int = 1000) -> Column:
    """A weighted sum of parts in [0, 1] as a whole number, halves to even."""
    total = None
    for w, c in parts.items():
        total = F.lit(w) * c if total is None else total + F.lit(w) * c
    return F.bround(scale * total, 0).cast("int")


def days_since(ts: Column, start: str) -> Column:
    return F.datediff(F.to_date(F.substring(ts.cast("string"), 1, 10)), F.lit(start).cast("date"))


def within(x: Column, lo: float, hi: float) -> Column:
    """Where x stands between lo and hi, as a number cut to [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - lo) / (hi - lo)))
