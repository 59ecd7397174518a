"""Lexer, carets, near-duplicates, tokenizer columns."""

import random

from pyspark.sql import functions as F

from tessel.functions import tokens as T
from tessel.operators import carets as C
from tessel.operators import near as N

SOURCE = 'using System;\nclass A {\n    int F(string s) {\n        // note { (\n        var total = s?.Length ?? 0;\n        if (total > 1) { _log.LogInformation("x {N}", total); }\n        return items.Where(x => x.Id).Count();\n    }\n}\n'


def test_lexer_covers_the_text():
    for kind, token, a, b in C.lex(SOURCE):
        assert SOURCE[a:b] == token and kind in ("comment", "directive", "string", "name", "number", "op")
    gaps = SOURCE
    for _, token, a, b in C.lex(SOURCE):
        gaps = gaps[:a] + " " * (b - a) + gaps[b:]
    assert not gaps.strip()


def test_carets(spark):
    rows = C.explode_carets(spark.createDataFrame([(1, SOURCE), (2, None), (3, ""), (4, "x" * 50_000)], "file_id long, content string")).collect()
    one = [r for r in rows if r.file_id == 1]
    assert len({r.offset for r in one}) == len(one)
    lines = SOURCE.split("\n")
    for r in one:
        assert lines[r.line][r.column :].rstrip() == r.target
    kinds = {r.kind for r in one}
    assert {"line_start", "member_access", "after_keyword", "after_operator", "control_flow", "lambda_body", "log_message", "linq", "argument_list", "identifier_partial"} <= kinds
    comment = SOURCE.index("// note")
    assert not [r for r in one if comment + 2 < r.offset < SOURCE.index("\n", comment)]


def test_sampled_carets_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, f"sha{i}", SOURCE.replace("total", f"t{i}")) for i in range(6)], "file_id long, sha256 string, content string")
    runs = [sorted(tuple(r) for r in C.sampled_carets(df.repartition(n), "7", per_file=10).select("file_id", "offset").collect()) for n in (1, 4)]
    assert runs[0] == runs[1] and runs[0]


def test_brace_closure():
    assert C.brace_closure("class A { void F() { // }\n var s = \"}\";") == "\n}}"
    assert C.brace_closure("} } {") == "\n}" and C.brace_closure("{ }") == ""


def test_locals_and_leakage():
    text = 'void F(int count) { var a = 1; string b = "var z = 1;"; // var y = 1;\n foreach (var item in a) { '
    assert C.locals_before(text, len(text)) == ["count", "a", "b", "item"]
    full = "var a = 1; use(b); var b = 2;"
    assert C.leakage(["a", "c"], full, 11, 18) == [] and C.leakage(["q"], "x q y", 2, 3) == ["q"]


def test_near_duplicates_against_exact_similarity(spark):
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(400)}"
    train = [[word() for _ in range(120)] for _ in range(25)]
    evals = [list(t) for t in train[:8]] + [[word() for _ in range(120)] for _ in range(5)]
    for t in evals[:4]:
        t[5] = "changed"
    rows = [(i, 0, " ".join(t)) for i, t in enumerate(train)] + [(100 + i, 1, " ".join(t)) for i, t in enumerate(evals)]
    rows += [(90, 0, " ".join(train[7])), (200, 1, "too short"), (201, 1, None)]
    got = {r.id: (r.best_id, r.similarity) for r in N.near_duplicates(spark.createDataFrame(rows, "id long, side int, text string")).collect()}
    runs = lambda t: {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
    for i, t in enumerate(evals):
        exact = max(len(runs(t) & runs(x)) / len(runs(t) | runs(x)) for x in train)
        assert (100 + i in got) == (exact >= 0.8)
        if 100 + i in got:
            assert abs(got[100 + i][1] - exact) < 1e-9
    assert got[107] == (7, 1.0)


def test_recall_of_near_duplicates(spark):
    """Against brute force over all pairs, most of them close to the threshold."""
    rnd = random.Random(11)
    train = [[f"w{rnd.randrange(900)}" for _ in range(rnd.randrange(40, 160))] for _ in range(150)]
    evals = []
    for t in train:
        e = list(t)
        for _ in range(max(1, len(e) // 60)):
            e[rnd.randrange(len(e))] = "changed"
        evals.append(e)
    rows = [(i, 0, " ".join(t)) for i, t in enumerate(train)] + [(1000 + i, 1, " ".join(t)) for i, t in enumerate(evals)]
    got = {r.id for r in N.near_duplicates(spark.createDataFrame(rows, "id long, side int, text string")).collect()}
    runs = lambda t: {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
    sets = [runs(t) for t in train]
    want = {1000 + i for i, e in enumerate(evals) if max(len(runs(e) & x) / len(runs(e) | x) for x in sets) >= 0.8}
    assert len(want) > 60 and got <= want and len(got) >= 0.99 * len(want)


def test_tokens(spark):
    df = spark.createDataFrame([(1, "hello world\n" * 40), (2, None), (3, "")], "i int, t string")
    r = {x.i: x for x in df.select("i", T.token_count(F.col("t")).alias("n"), T.encoded(F.col("t")).alias("e"), T.last_tokens(F.col("t"), 10).alias("l")).collect()}
    assert r[1].n == len(r[1].e["ids"]) and r[1].e["round_trip"] and r[2].n is None and r[3].n == 0
    assert r[1].l and ("hello world\n" * 40).endswith(r[1].l) and len(T.encoding().encode_ordinary(r[1].l)) <= 10 and r[2].l is None
