"""Rules, licences by text, orders, windows around carets, state of runs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tessel import plugins, session
from tessel.functions import text as X
from tessel.operators import edits
from tessel.operators import rules as R
from tessel.plugins import DocumentTable, JobTable, LineWriter, ManifestFile
from tessel.streaming import state as S

MIT = 'Permission is hereby granted, free of charge, to any person\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT'
BSD = 'Redistribution and use in source and binary forms\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND'


def test_licenses_by_text(spark):
    rows = [(1, "LICENSE", MIT, None), (2, "LICENSE", BSD, None), (3, "LICENSE", BSD + "\nNeither the name of X", "BSD-3-Clause"), (4, "LICENSE", "Apache License\nVersion 2.0", "MIT"), (5, "LICENSE", "All rights reserved", "MS-PL"), (6, "LICENSE", "All rights reserved", None), (7, None, None, "MIT"), (8, "COPYING", "", "Custom")]
    df = spark.createDataFrame(rows, "i int, file string, text string, declared string")
    got = {r.i: (r.r.spdx, r.r.reason, r.r.allowed) for r in df.select("i", R.reconciled_license(F.col("file"), F.col("text"), F.col("declared"), ["MIT", "BSD-3-Clause", "MS-PL", "Apache-2.0"]).alias("r")).collect()}
    assert got == {
        1: ("MIT", "license_file_text_match:LICENSE", True), 2: ("BSD-2-Clause", "license_file_text_match:LICENSE", False), 3: ("BSD-3-Clause", "license_file_text_match:LICENSE", True), 4: (None, "declared_MIT_conflicts_with_detected_Apache-2.0", False),
        5: ("MS-PL", "declared:MS-PL;license_file_present:LICENSE;text_unrecognized", True), 6: (None, "license_text_unrecognized", False), 7: (None, "no_license_file", False), 8: (None, "license_text_unrecognized", False),
    }
    files = spark.createDataFrame([("r", "LICENSE.txt", "b"), ("r", "LICENCE", "a"), ("r", "sub/LICENSE", "c"), ("r", "licenses.md", "d"), ("q", "UNLICENSE", "e")], "s string, p string, c string")
    assert {tuple(x) for x in R.license_file_of(files, "s", "p", "c").collect()} == {("r", "LICENCE", "a"), ("q", "UNLICENSE", "e")}


def test_rules(spark):
    df = spark.createDataFrame([("a cheat", ["x"]), ("a cheat for packet", []), ("nice", ["cheat"]), (None, None)], "t string, tags array<string>")
    got = [r[0] for r in df.select(R.tagged_or_said(F.col("tags"), F.col("t"), ["cheat"], [r"\bcheat\b"], ["packet"], ("tag", "word"))).collect()]
    assert got == ["word", None, "tag", None]
    r = df.select(R.category(F.col("t"), [("one", "cheat"), ("two", "nice|cheat")]).alias("c"), R.bucket(F.col("t"), {"m": ["nice"]}, {"p": ["a "]}, "rest").alias("b"), R.all_reasons({"x": F.col("t") == "nice", "y": F.col("t").isNotNull()}).alias("r")).collect()
    assert [x.c for x in r] == ["one", "one", "two", "other"] and [x.b for x in r] == ["p", "p", "m", "rest"] and [x.r for x in r] == [["y"], ["y"], ["x", "y"], []]
    assert [x.s for x in spark.createDataFrame([(0.0005,), (0.0015,), (0.0025,)], "v double").select(R.score({1.0: F.col("v")}).alias("s")).collect()] == [0, 2, 2]
    paths = ["a￮", "a\U0001f600", "a", "B"]
    assert [x.p for x in spark.createDataFrame([(p,) for p in paths], "p string").orderBy(R.ordinal(F.col("p"))).collect()] == sorted(paths, key=lambda p: p.encode("utf-16-be"))


def test_context_windows(spark):
    text = "ab\U0001f600cd\U0001f600ef"
    units = lambda s: len(s.encode("utf-16-le")) // 2
    caret, end = units("ab\U0001f600c"), units("ab\U0001f600cd")
    for before in range(8):
        for after in range(6):
            w = spark.createDataFrame([(text, caret, end)], "t string, a int, b int").select(X.context_windows(F.col("t"), F.col("a"), F.col("b"), before, after).alias("w")).first().w if (before, after) in ((0, 0), (2, 1), (3, 2), (7, 5)) else None
            if w is None:
                continue
            raw = text.encode("utf-16-le")
            a, b = max(0, caret - before), min(units(text), end + after)
            left, right = raw[2 * a : 2 * caret].decode("utf-16-le", "ignore"), raw[2 * end : 2 * b].decode("utf-16-le", "ignore")
            assert (w.left, w.right) == (left, right)


def test_quality_flags(spark):
    rows = [("x();", 5, 5, 0), (") // note", 3, 5, 2), (' "// no" é', 1, 1, None), ("};", 1, 1, 0)]
    df = spark.createDataFrame(rows, "t string, e int, l int, s int").select(R.all_reasons(X.quality_flags(F.col("t"), F.col("e"), F.col("l"), F.col("s"))).alias("f"))
    assert [r.f for r in df.collect()] == [[], ["target_starts_with_closer", "trailing_whitespace", "target_has_comment", "file_has_syntax_errors"], ["target_starts_with_whitespace", "non_ascii_target"], ["trivial_target", "target_starts_with_closer"]]


def test_state(spark, tmp_path):
    t = S.StateTable(spark, str(tmp_path / "state"), "id")
    assert t.load() is None
    t.save(spark.createDataFrame([("a", "running"), ("b", "done")], "id string, status string"))
    t.upsert(spark.createDataFrame([("a", "failed"), ("c", "pending")], "id string, status string"))
    assert {tuple(r) for r in t.load().collect()} == {("a", "failed"), ("b", "done"), ("c", "pending")} and t.versions() == [1, 2]
    os.makedirs(tmp_path / "state" / "v3")  # a crash before the commit
    assert t.versions() == [1, 2]
    j = JobTable(spark, str(tmp_path / "jobs"), "id")
    j.save(spark.createDataFrame([("a", "running")], "id string, status string"))
    assert {tuple(r) for r in S.recovered(j.load(), "status").select("id", "status", "recovered").collect()} == {("a", "pending", True)}
    made = []
    make = lambda: made.append(1) or spark.range(3).toDF("n")
    for _ in range(2):
        assert S.step(spark, str(tmp_path / "out"), make).count() == 3
    assert made == [1] and S.done(spark, str(tmp_path / "out")) and not S.done(spark, str(tmp_path / "none"))
    df, o = S.measured(spark.range(5).toDF("n"), "five", top=F.max("n"))
    df.write.format("noop").mode("overwrite").save()
    assert o.get == {"rows": 5, "top": 4}
    p = S.Profile()
    assert p.time("x", lambda: 7) == 7 and p.snapshot()["x"]["count"] == 1
    assert "| q | 1.500 | 1.000 | +50% |" in S.report("t", {"q": 1.5}, {"q": 1.0})


def test_plugins(spark, tmp_path):
    docs = DocumentTable(spark.createDataFrame([("r", "a.cs", "h", "text")], "repository_id string, relative_path string, sha256 string, content string"))
    s = spark.createDataFrame([("s1", "r", "a.cs", "h"), ("s2", "r", "a.cs", "other"), ("s3", "r", "b.cs", "h")], "sample_id string, repository_id string, relative_path string, source_sha256 string")
    assert {r.sample_id: (r.content, r.reason) for r in docs.find(s).collect()} == {"s1": ("text", None), "s2": (None, "document_text_mismatch"), "s3": (None, "document_not_in_workspace")}
    w = LineWriter().write(spark.createDataFrame([("a", None)], "x string, y string"), str(tmp_path / "lines"))
    assert w.agg(F.sum("records")).first()[0] == 1
    assert json.loads("".join(open(tmp_path / "lines" / f).read() for f in os.listdir(tmp_path / "lines") if f.startswith("part-"))) == {"x": "a", "y": None}
    (tmp_path / "m.txt").write_text("https://h.example/a/b main\n# note\n\nhttps://h.example/a/b\n")
    got = [(r.line_no, r.error) for r in ManifestFile("txt").read(spark, str(tmp_path / "m.txt")).orderBy("line_no").collect()]
    assert got == [(0, None), (3, "duplicate_repository")]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_go_signatures(spark):
    cases = {"Name[T any](p T) (R, error)": "Name[T any](p T)->(R, error)", "F(f func(int) (string, error), m map[string][]int) bool": "F(f func(int) (string, error), m map[string][]int)->bool", "Run()": "Run()", "Broken(a": "Broken(a", "name": "name", "M[K comparable, V List[K]](k K) V": "M[K comparable, V List[K]](k K)->V"}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "s string")
    assert {r.s: r.c for r in df.select("s", X.compact_go_signature(F.col("s")).alias("c")).collect()} == {**cases, None: None}


def test_slow_and_failing_samples(spark):
    class Slow:
        schema = "sample_id string, status string, reason string"

        def enrich(self, batches):
            import time

            for pdf in batches:
                for s in pdf["sample_id"]:
                    if s == "slow":
                        time.sleep(60)
                    if s == "bad":
                        raise KeyError(s)
                yield pdf[["sample_id"]].assign(status="resolved", reason=None)

    df = spark.createDataFrame([("a",), ("slow",), ("bad",), ("b",)], "sample_id string").coalesce(1)
    assert {r.sample_id: (r.status, r.reason) for r in plugins.enriched(df, Slow(), seconds=0.5).collect()} == {"a": ("resolved", None), "b": ("resolved", None), "slow": ("failed", "timeout"), "bad": ("failed", "KeyError")}
    assert {r.sample_id for r in plugins.enriched(df, Slow(), required=True, seconds=0.5).collect()} == {"a", "b"}


def test_dataset_card(spark):
    df = spark.createDataFrame([(1, "a", "x|y", "go"), (2, "a", "z", None), (3, "b", "w", "go")], "id int, kind string, text string, lang string")
    card = edits.dataset_card(df, "Set", "kind", "id", "text", ["lang"])
    assert card.startswith("# Set\n\n3 rows.") and "| go | 2 | 66.7% |" in card and "| none | 1 |" in card and "## Examples" in card and "| b | 1 | `w` |" in card
