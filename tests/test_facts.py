"""Facts about carets, sub-kinds, tags, exclusions, blocks and documents: goldens of hand-made files."""

import bisect

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessel.functions import tokens as T
from tessel.operators import carets as C
from tessel.operators import facts as K
from tessel.operators import prompts as P

SOURCE = '''using System;
namespace A.B;
public class Base { public int Id { get; set; } public void Save() { } }
[Serializable]
public sealed class Order : Base, IThing
{
    private readonly List<string> _items = new();
    public const int Max = 3;
    public string Name { get; init; } = "x";
    public event Action Done;
    private Base _parent;
    public Order(string name, int n = 1) : base() { Name = name; }
    public async Task<int> CountAsync(Order other, params string[] xs)
    {
        var y = new Base();
        var z = "s";
        Dictionary<string, int> map = null;
        if (other.Name == "q") { return 1; }
        y.Save();
        this.Twice(1, 2);
        _parent.Id = 4;
        var w = new Order("a", 2);
        Name = other.Name;
        foreach (var i in xs) { Color.Red.ToString(); }
        return y.Id;
    }
    public int Twice(int a) => a * 2;
    public int Twice(int a, int b) => Twice(a);
}
public record Pair(int A, string B);
enum Color { Red, Green = 2 }
'''


def at(probe, src=SOURCE):
    tokens = [t for t in C.lex(src) if t[0] not in ("comment", "directive")]
    caret = src.index(probe) + len(probe)
    n, s = bisect.bisect_left([t[2] for t in tokens], caret), K.Scanner()
    for t in tokens[:n]:
        s.feed(t)
    return K.facts_at(tokens, n, caret, s)


def test_declarations(spark):
    df = spark.createDataFrame([("r", 1, SOURCE), ("r", 2, None), ("r", 3, ""), ("r", 4, "class } { ( broken")], "repository_id string, file_id long, content string")
    rows = K.declarations(df).collect()
    got = {(r.owner, r.kind, r.name, r.type) for r in rows}
    assert {(None, "type", "Order", "class"), ("Order", "field", "_items", "List<string>"), ("Order", "const", "Max", "int"), ("Order", "property", "Name", "string"), ("Order", "event", "Done", "Action"), ("Order", "constructor", "Order", "Order"), ("Order", "method", "CountAsync", "Task<int>"), ("Base", "property", "Id", "int"), ("Pair", "property", "B", "string"), ("Color", "enum_value", "Green", "Color"), ("Order", "base", "Base", "Base"), ("Order", "base", "IThing", "IThing")} <= got
    sig = {r.signature: [tuple(p) for p in r.params] for r in rows if r.signature and r.file_id == 1}
    assert sig["Task<int> CountAsync(Order other, string[] xs)"] == [("other", "Order"), ("xs", "string[]")] and sig["Order(string name, int n)"] == [("name", "string"), ("n", "int")] and "int Twice(int a, int b)" in sig
    assert K.declarations(df.limit(0)).count() == 0


def test_facts_at_carets():
    f = at("y.")
    assert (f["enclosing_type"], f["member"], f["return_type"], f["receiver"], f["receiver_kind"]) == ("Order", "CountAsync", "Task<int>", "y", "local")
    assert f["locals"] == [("other", "Order"), ("xs", "string[]"), ("y", "Base"), ("z", "string"), ("map", "Dictionary<string, int>")]
    expected = {"return ": ("int", "return"), "map = ": ("Dictionary<string, int>", "initializer"), "Twice(int a) => ": ("int", "expression_body"), "if (": ("bool", "condition"), "Max = ": ("int", "initializer")}
    assert {p: (at(p)["expected"], at(p)["source"]) for p in expected} == expected
    assert (at("this.Twice(1, ")["callee"], at("this.Twice(1, ")["argument"]) == ("Twice", 1) and at('new Order("a", ')["callee"] == "new Order"
    assert at("_parent.")["receiver_kind"] == "name" and at("this.")["receiver_kind"] == "this" and at("Color.Red.")["receiver_kind"] == "expression" and at("namespace A")["enclosing_type"] is None


@pytest.fixture(scope="module")
def known(spark):
    files = spark.createDataFrame([("r", 1, SOURCE), ("s", 2, "class Base { int Other; }")], "repository_id string, file_id long, content string")
    probes = ["y.", "this.", "_parent.", "Color.", "this.Twice(1, ", 'new Order("a", ', "return ", "namespace A"]
    carets = spark.createDataFrame([(p, 1, SOURCE.index(p) + len(p)) for p in probes], "sample_id string, file_id long, caret int")
    return K.declarations(files), K.caret_facts(files, carets), spark.createDataFrame([(p, ["Save", "Pair", "zzz"]) for p in probes], "sample_id string, names array<string>")


def test_members_calls_types_and_status(spark, known):
    decls, facts, prefix = known
    r = K.receiver_types(facts, decls)
    assert {x.sample_id: (x.receiver_type, x.is_static) for x in r.collect()} == {"y.": ("Base", False), "this.": ("Order", False), "_parent.": ("Base", False), "Color.": ("Color", True)}
    m = K.members_of(r.drop("used").join(prefix.withColumnRenamed("names", "used"), "sample_id"), decls, "receiver_type", 24)
    got = {x.sample_id: x.m for x in m.select("sample_id", F.transform("members", K.fact_text).alias("m")).collect()}
    assert got["y."] == ["void Save()", "Id:int"] and got["Color."] == ["Green:Color", "Red:Color"]
    assert got["this."][:3] == ["void Save()", "Name:string", "_items:List<string>"] and "int Twice(int a) (+1)" in got["this."] and got["this."][-1] == "Id:int"  # used first, then own, then inherited
    calls = {x.sample_id: [(c.signature, c.parameter_name, c.parameter_type) for c in x.candidates] for x in K.invocations(facts, decls).collect()}
    assert calls == {"this.Twice(1, ": [("int Twice(int a, int b)", "b", "int")], 'new Order("a", ': [("Order(string name, int n)", "n", "int")]}
    types = {(x.sample_id, x.type, x.source, x.place) for x in K.context_types(facts, decls, prefix).where("sample_id = 'return '").collect()}
    assert types == {("return ", "Base", "local", 1), ("return ", "Pair", "prefix", 2)}
    st = {x.sample_id: (x.status, x.reason) for x in K.statuses(facts, r, K.invocations(facts, decls)).collect()}
    assert st["namespace A"] == ("partially_resolved", "no_enclosing_symbol") and st["y."] == ("resolved", None)


def test_project_edges(spark):
    text = '<Project><ItemGroup><ProjectReference Include="..\\Core\\Core.csproj" /><ProjectReference Condition="x" Include="..\\Core\\Core.csproj"/><ProjectReference Include="../None/N.csproj" /></ItemGroup></Project>'
    df = spark.createDataFrame([("r", "src/App/App.csproj", text), ("r", "src/Core/Core.csproj", "<Project/>"), ("q", "src/Core/Core.csproj", None)], "repository_id string, path string, text string")
    assert [tuple(x) for x in K.project_edges(df).collect()] == [("r", "src/App/App.csproj", "src/Core/Core.csproj")]


def sub(line):
    tokens = [t for t in C.lex("; " + line) if t[0] not in ("comment", "directive")]
    return C.line_subkind(tokens, 1)


def test_line_subkinds():
    want = {"var x = 1;": "local_declaration", "List<int> x = y;": "local_declaration", "x = 1;": "assignment", "a.B(1);": "invocation", "await F();": "invocation", "return x;": "return", "foreach (var a in b) {": "control_flow", "throw e;": "exception", "using System;": "using_directive", "[Fact]": "attribute", "public int F(int a) {": "method_declaration", "Task<int> F() {": "method_declaration", "public int P { get; }": "field_or_property", "private readonly int _x;": "field_or_property", "public class A {": "type_declaration", "namespace A;": "namespace", "}": "brace"}
    assert {k: sub(k) for k in want} == want
    tokens = C.lex("x = a\n    .B();")
    assert C.line_subkind(tokens, 3) == "continuation"


def test_log_templates_and_tags():
    src = 'class A { [LoggerMessage(Level = L.Info, Message = "m {X}")] void M(); void F() { _log.LogInformation(e, "t {Y}", "no"); _log.LogError($"i {z}"); G("plain"); } }'
    tokens = C.lex(src)
    got = {t[1]: C.log_context(tokens, i) for i, t in enumerate(tokens) if t[0] == "string"}
    assert got == {'"m {X}"': "logger_message_attribute", '"t {Y}"': "ilogger", '"no"': None, '$"i {z}"': "ilogger_interpolated", '"plain"': None}
    src = "class A { void F() { var q = xs.Where(x => x.Foo); var p = new B { C = 1 }; if (a is B b) { } await G(); _l.LogError(1); var s = k switch { 1 => 2 }; } }"
    tokens = C.lex(src)
    tags = lambda probe: C.tags_at(tokens, bisect.bisect_left([t[2] for t in tokens], src.index(probe) + len(probe)))
    assert tags("x => x.") == ["lambda", "linq"] and tags("new B { C = ") == ["initializer"] and tags("a is ") == ["pattern"] and tags("await ") == ["await"] and tags("LogError(") == ["log_call"]
    assert "switch_expression" in tags("switch { 1 => ") and tags("var q = ") == [] and C.tags_at(tokens, 0, True) == ["test_code"]


def test_exclusions_and_strata(spark):
    src = 'class A {\n    // note here\n    /// doc\n#if X\n    int hidden;\n#endif\n    string s = "lit eral";\n    string r = """\n      raw {\n      """;\n    string password = "hunter2hunter2";\n    string env = "SOME_NAME_X";\n\n}\n'
    df = spark.createDataFrame([(1, src), (2, None), (3, "")], "file_id long, content string")
    got = {(r.line, r.stratum) for r in C.line_strata(df).where("file_id = 1").collect()}
    assert got == {(1, "comment"), (2, "doc_comment"), (3, "preprocessor_directive"), (4, "inactive_preprocessor_code"), (5, "preprocessor_directive"), (8, "inside_raw_string"), (9, "inside_raw_string"), (12, "blank"), (14, "blank")}
    c = C.explode_carets(df, reasons=True).where("file_id = 1").collect()
    why = {}
    for r in c:
        why.setdefault(r.line, set()).add(r.reason)
    assert why[7] >= {"raw_multiline_string"} and why[10] - {"empty_target"} == {"secret_detected"} and why[11] - {"empty_target"} == {None}
    tokens = C.lex(src)
    starts = [t[2] for t in tokens]
    one = lambda p, end, kind="token_boundary": C.exclusion(src, tokens, starts, p, end, src.find("\n", p), kind, False)
    inside = src.index("eral")
    assert one(inside, inside + 4) == "caret_inside_literal" and one(inside, inside + 4, "log_message") is None and one(inside, inside) == "empty_target" and one(src.index("note here") + 2, src.index("here") + 4) == "caret_inside_trivia" and one(0, 300) == "target_too_long"
    kept = C.sampled_carets(spark.createDataFrame([(1, "h", src)], "file_id long, sha256 string, content string"), "7")
    t = C.tagged(spark.createDataFrame([(1, src, True)], "file_id long, content string, is_test boolean"), kept).collect()
    assert len(t) == kept.count() > 0 and all("test_code" in r.tags for r in t)


def test_blocks_by_budget():
    size = lambda t: len(t.split())
    lines = {"MEMBER": ["a", "b", "c"], "RET": ["int"], "EXPECT": ["T"], "LOCAL": [], "CALL": ["f(x)->y", "g()"]}
    assert P.block(lines, 100, size) == "RET int\nEXPECT T\nMEMBER a; b; c\nCALL f(x)->y | g()"
    assert P.block(lines, 5, size) == "EXPECT T" and P.block(lines, 11, size) == "EXPECT T\nCALL f(x)->y | g()" and P.block(lines, 8, size) == "EXPECT T\nCALL f(x)->y" and P.block({}, 50, size) == "" and P.block(lines, 2, size) == ""
    for budget in range(2, 30):
        assert sum(size(x) + 1 for x in P.block(lines, budget, size).split("\n") if x) <= budget - 2


def test_documents_and_healing(spark):
    df = spark.createDataFrame([("p.cs", "a\nreturn ", "x;", "\n}", "RET int"), ("p.cs", "a\n    ", "x;", "\n}", None)], "p string, l string, t string, r string, f string")
    one, two = [r.d for r in df.select(P.document(F.col("p"), F.col("l"), F.col("t"), F.col("r"), None, F.col("f")).alias("d")).collect()]
    assert one.prompt == "<|fim_prefix|><|fim_suffix|>\n}<|fim_middle|><|file_sep|>p.cs\na\n<|reserved_1|>RET int<|reserved_2|>return" and one.completion == " x;<|endoftext|>" and one.variant == "full"
    assert two.prompt.endswith("p.cs\na\n    ") and two.completion == "x;<|endoftext|>" and two.variant == "none"
    e = T.encoding()
    rows = [(x, e.encode_ordinary(x)) for x in ("return  ", "x\n    ", "return", "", "a = b \t ")]
    got = {r.x: r.at - r.new for r in spark.createDataFrame([(x, ids + [1], len(ids)) for x, ids in rows], "x string, ids array<int>, at int").withColumn("new", P.healed_ids(F.col("ids"), F.col("at"))).collect()}
    for x, ids in rows:
        tail = b"".join(e.decode_single_token_bytes(i) for i in ids[len(ids) - got[x] :])
        assert not tail.strip(b" \t") and (got[x] > 0) == (x in ("return  ", "a = b \t ")), x
    deps = spark.createDataFrame([(["System", "Alpha", "Beta"],), ([],)], "d array<string>").select(P.roots_block(F.col("d"), 3).alias("b")).collect()
    assert deps[0].b.startswith("System") and deps[1].b == "" and len(e.encode_ordinary(deps[0].b)) <= 3


def test_carets_come_in_blocks_and_are_drawn_before_a_shuffle(spark):
    schema = pa.schema([("n", pa.int64())])
    taken = []
    blocks = C.in_blocks(((taken.append(n) or n,) for n in range(10_000)), schema, 64)
    assert next(blocks).num_rows == 64 and len(taken) == 64 and sum(b.num_rows for b in blocks) == 9_936
    text = "class A {\n" + "".join(f"    int Field{n} = Other{n}.Call(first{n}, {n});\n" for n in range(40)) + "}\n"
    files = spark.createDataFrame([(1, "h", text), (2, None, text)], "file_id long, sha256 string, content string")
    c = C.sampled_carets(files, "s", per_line=10**6, per_file=10**6).select("file_id", "offset", "kind")
    every = C.explode_carets(files).join(files.select("file_id", "sha256"), "file_id")
    w = lambda r: C.WEIGHTS[r.kind] * (0.05 if not r.target.strip("{}()[];, ") else 1)
    want = {(r.file_id, r.offset, r.kind) for r in every.collect() if C.uniform("s", "caret", r.sha256 or "", r.offset) < w(r)}
    assert {tuple(r) for r in c.collect()} == want and {k[0] for k in want} == {1, 2}
    plan = c._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan


def test_tags_of_large_batches(spark):
    """The tags of more carets than a block holds: none is lost or comes twice."""
    text = "class A {\n" + "".join(f"    int Field{n} = Other{n}.Call(first{n}, {n});\n" for n in range(300)) + "}\n"
    files = spark.createDataFrame([(n, text, n == 1) for n in range(3)], "file_id long, content string, is_test boolean").coalesce(1)
    carets = C.explode_carets(files)
    n = carets.count()
    assert n > 4096
    tagged = C.tagged(files, carets)
    assert tagged.count() == n and tagged.select("file_id", "offset").distinct().count() == n
