import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import records as R
from quire.functions import text as T
from quire.operators import corpus as C
from quire.operators import extract as X
from quire.operators import layout as L
from quire.operators import pagetext as P


def test_spaced_letters():
    assert P.join_spaced_letters("C O N S E I L  M U N I C I P A L du 3") == "CONSEIL MUNICIPAL du 3"
    assert P.join_spaced_letters("P ř i vyšší") == "Při vyšší"
    assert P.join_spaced_letters("1 x 9 x 8 * 9") == "1 x 9 x 8 * 9"
    assert P.join_spaced_letters("") == ""
    assert P.join_spaced_letters("| a b c d |") == "| a b c d |"


def test_lone_signs():
    assert P.join_lone_signs("word\n\n.\nnext") == "word.\nnext"
    assert P.join_lone_signs(".\nword") == ".\nword"
    assert P.join_lone_signs("done!\n.") == "done!\n."


def test_tables():
    t = "a<docling_table>| x | |\n|---|---|\n| 1 | |\n| | |</docling_table>b"
    assert P.clean_tables(t) == "a<docling_table>| x |\n|---|\n| 1 |</docling_table>b"
    r = P.drop_faulty_tables(t)
    assert r["text"] == "ab" and r["tables"] == 1 and set(r["faults"]) == {"empty_columns", "empty_rows"}
    assert P.clean_tables("<docling_table>x</docling_table>") == ""


def test_annotations_and_numbers():
    a = "<docling_picture_annotation>{}</docling_picture_annotation>"
    assert P.drop_poor_annotations(a.format("abc") + a.format("12a") + a.format("")) == a.format("abc")
    n = "<docling_page_number>{}</docling_page_number>"
    assert P.settle_page_numbers("12 " + n.format("3")) == "12 3"
    assert P.settle_page_numbers("x " + n.format("3")) == "x " + n.format("3")
    assert P.settle_page_numbers("12" + n.format("iv")) == "12" + n.format("iv")


def test_repetition_counts_repeats():
    line = "the same line\n"
    assert P.repetition(line * 3) == {"kind": None, "at": None}
    assert P.repetition(line * 4) == {"kind": "line", "at": len(line) * 4 - 1}
    assert P.repetition("|a|b|c|d|e|\n" * 9)["kind"] is None
    assert P.repetition("|a|b|c|d|e|\n" * 10)["kind"] == "line"
    assert P.repetition("x" * 350)["kind"] is None
    assert P.repetition("x" * 351) == {"kind": "char", "at": 350}
    s = " this is a sentence that is certainly longer than fifty."
    assert P.repetition(s * 5)["kind"] is None
    assert P.repetition(s * 6)["kind"] == "sentence"


def slow_repetition(text, lines=3, sentences=5, chars=350):
    buf, sen, last_l, last_s, last_c, nl, ns, nc = "", "", "", "", "", 0, 0, 0
    for i, c in enumerate(text):
        buf, sen, kind = buf + c, sen + c, None
        if c in ".?!":
            ns = ns + 1 if len(sen) >= 50 and sen == last_s else 0
            kind = "sentence" if ns >= sentences else kind
            last_s, sen = sen, ""
        nc = nc + 1 if c == last_c else 0
        kind = "char" if nc >= chars else kind
        last_c = c
        if c == "\n" and len(buf) > 2 and buf[-2] != "\n":
            nl = nl + 1 if buf == last_l else 0
            if nl >= lines and ("|" not in buf or nl >= 3 * lines) and (len(buf) >= 8 or nl >= 4 * lines):
                kind = "line"
            last_l, buf = buf, ""
        if kind:
            return {"kind": kind, "at": i}
    return {"kind": None, "at": None}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["ab\n", "\n", "long line here\n", "|x|\n", "|a longer|\n", "z"]), max_size=40))
def test_repetition_against_automaton(parts):
    t = "".join(p * 3 for p in parts)
    assert P.repetition(t) == slow_repetition(t)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n.", max_size=300), st.integers(5, 60))
def test_split_document(t, most):
    parts = P.split_document(t, most)
    assert all(len(p) <= most for p in parts)
    assert "".join("".join(parts).split()) == "".join(t.split())


def test_pages_to_text(spark):
    rows = [(1, ["one wor-", "d two", " ", "three"]), (2, ["", None]), (3, ["x-", "-y", "5-", "z"])]
    df = spark.createDataFrame(rows, "doc_id int, p array<string>").select("doc_id", T.pages_to_text(F.col("p")).alias("x"))
    got = {r[0]: tuple(r[1]) for r in df.collect()}
    assert got[1] == ("one word two\n\nthree", [8, 12, 19], [0, 1, 3])
    assert got[2] == ("", [], [])
    assert got[3] == ("x-y\n\n5-\n\nz", [2, 3, 7, 10], [0, 1, 2, 3])


def test_pages_and_ends(spark):
    df = spark.createDataFrame([("abcdef", [2, 6]), ("abc", None), ("a😀b", [2, 3])], "t string, e array<bigint>")
    got = [r[0] for r in df.select(T.pages(F.col("t"), F.col("e"))).collect()]
    assert got == [["ab", "cdef"], ["abc"], ["a😀", "b"]]
    assert df.select(T.page_ends(T.pages(F.col("t"), F.col("e")))).collect()[0][0] == [2, 6]


def test_lid_text_table_limit(spark):
    t = "\n".join(["| a |"] * 10 + ["x - y"])
    df = spark.createDataFrame([(t,)], "t string")
    assert df.select(T.lid_text(F.col("t"))).first()[0].strip() == "x y"
    assert df.select(T.lid_text(F.col("t"), 8)).first()[0].split() == ["a", "a", "x", "y"]


@pytest.mark.parametrize(("value", "want"), [("1, 2.5", [1.0, 2.5]), ("1,x", []), (None, []), ("", [])])
def test_scores(spark, value, want):
    assert spark.createDataFrame([(value,)], "t string").select(R.scores_of(F.col("t"))).first()[0] == want


def test_select_language(spark):
    rows = [(1, [("eng", 0.5), ("deu", 0.9)]), (2, [("zxx_Latn", 0.4), ("eng", 0.1)]), (3, [("eng", 0.01)]), (4, []), (5, [("xxx", 0.9)]), (6, [("b", 0.7), ("eng", 0.7)])]
    df = spark.createDataFrame(rows, "id int, s array<struct<lang:string,score:double>>")
    got = {r[0]: tuple(r[1]) for r in df.select("id", R.select_language(F.col("s"), {"eng": 0.05, "zxx_Latn": -1.0})).collect()}
    assert got == {1: ("eng", True), 2: ("zxx_Latn", True), 3: ("eng_removed", False), 4: ("unknown", False), 5: ("xxx", False), 6: ("eng", True)}


def test_boilerplate(spark):
    pages = [(1, i, f"Report {i}\nsame line\nbody {chr(97 + i) * 3}\nfoot") for i in range(6)] + [(2, 0, "x"), (3, 0, "a\nb"), (3, 1, "c\nd")]
    got = {(r[0], r[1]): (r[2], r[3]) for r in C.boilerplate(spark.createDataFrame(pages, "doc_id bigint, page_no int, text string")).collect()}
    assert got[1, 0] == (2, 1) and got[1, 5] == (2, 1)
    assert got[2, 0] == (0, 0) and got[3, 1] == (0, 0)


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, None), (4, None), (5, "a b")], "doc_id int, text string")
    got = {r["doc_id"]: (r["copies"], r["kept"]) for r in C.exact_duplicates(df, T.exact_key(F.col("text"))).collect()}
    assert got == {1: (3, True), 2: (3, False), 5: (3, False), 3: (1, True), 4: (1, True)}
    assert C.exact_duplicates(df.limit(0), T.exact_key(F.col("text"))).count() == 0


def test_thresholds_meet_limits(spark):
    import random

    random.seed(2)
    rows = [(lang, round(random.random(), 2), random.random() < 0.7 + 0.3 * (lang == "a")) for lang in "ab" for _ in range(300)] + [("c", 0.5, None), (None, 0.5, True)]
    df = spark.createDataFrame(rows, "lang string, score double, language_correct boolean")
    for r in C.language_thresholds(df).collect():
        kept = [c for lang, s, c in rows if lang == r["lang"] and s > r["threshold"]]
        assert len(kept) == r["kept"] and sum(kept) / len(kept) >= 0.9
    assert C.language_thresholds(df.limit(0)).count() == 0


def test_coalesce_failed(spark):
    df = spark.createDataFrame([(["<--- stop_reason_length --->", " ok "],), (["The 2003-04 season x"],)], "p array<string>")
    a, b = [r[0] for r in df.select(C.coalesce_failed(F.col("p"))).collect()]
    assert a["pages"] == ["<failed_page></failed_page>\n", "ok\n"] and a["ok"] and not b["ok"]


def test_hash_ranks_and_sampling(spark):
    import hashlib

    rows = [(i, i % 7 % 3) for i in range(300)] + [(900, None)]
    df = spark.createDataFrame(rows, "id bigint, y int")
    got = {(r["y"], r["id"]): (r["rank"], r["m"]) for r in C.hash_ranks(df, "y", "id", "42").collect()}
    for y in range(3):
        own = sorted((hashlib.md5(f"42{i}".encode()).hexdigest(), i) for i, k in rows if k == y)
        assert [got[y, i] for _, i in own] == [(n, len(own)) for n in range(1, len(own) + 1)]
    wanted = C.samples_per_class(df, "y", 0, 5, 2.0, 1.0)
    w = {r["label"]: r["samples"] for r in wanted.collect()}
    assert w[5] == 0
    drawn = {r[0]: r[1] for r in C.balanced_sample(df, "y", "id", wanted).groupBy("label").agg(F.sum("copies")).collect()}
    assert drawn == {k: v for k, v in w.items() if v}
    assert C.balanced_sample(df.limit(0), "y", "id", wanted).count() == 0
    split = C.stratified_split(df, "y", "id", 0.1)
    assert {r[0]: r[1] for r in split.where("split = 'test'").groupBy("y").count().collect()} == {y: -(-sum(k == y for _, k in rows) // 10) for y in range(3)}


def test_class_metrics_and_stats(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 1.6), (2, 2.5), (5, 9.0), (None, 1.0), (1, None)], "y int, p double")
    r = C.class_metrics(df, "y", "p").first()
    assert r["accuracy"] == 0.75 and r["macro_recall"] == pytest.approx(2.5 / 3, abs=1e-6)
    s = C.dataset_stats(spark.createDataFrame([(0.0,), (0.05,), (1.0,), (None,)], "v double"), "v").first()
    assert s["n"] == 3 and s["histogram"][0] == 1 and s["histogram"][1] == 1 and s["histogram"][19] == 1
    assert C.dataset_stats(spark.createDataFrame([], "v double"), "v").first()["mean"] == -1


def test_fixed_values(spark):
    rows = [("► one",), ("- two",), ("• three",), ("✓ four",), ("● five",), ("▪ ▪ six",), ("seven   eight",), (None,)]
    df = spark.createDataFrame(rows, "x string")
    got = [tuple(r) for r in df.select(T.unify_list_marks(F.col("x")), T.unify_list_marks(F.col("x"), True)).collect()]
    assert got == [("- one", "- one"), ("- two", "- two"), ("* three", "* three"), ("[x] four", "[x] four"), ("* five", "* five"), ("- six", "- six"), ("seven   eight", "seven eight"), (None, None)]
    yes = ["7", "3 / 12", "Page 3 of 10", "PAGE 3", "p 4", "Seite 2 von 9", "стр 5", "Страница 5 из 9", "第 3 页 共 9 页", "12. oldal", "Página: 18/24", "עמ' 4", "Muka surat 3"]
    no = ["07", "12345", "Pages 3", "Page3", "Section 4", "3 of 10", ""]
    items = spark.createDataFrame([(i, 0, "text", t, 0) for i, t in enumerate(yes + no)] + [(99, 0, "caption", "7", 0), (98, 0, "table", "7", 0)], "doc_id int, page_no int, label string, text string, position int")
    assert {r["doc_id"] for r in L.tag_page_numbers(items).where("is_page_number").collect()} == set(range(len(yes)))
    names = spark.createDataFrame([("Fujitsu ScanSnap",), ("KOFAX",), ("LibreOffice",), (None,)], "x string")
    assert [r[0] for r in names.select(T.scanner_producer(F.col("x"))).collect()] == [True, True, False, False]
    logs = spark.createDataFrame([("MuPDF error: format error: object out of range (1)", False), ("fine", True), ("Syntax Error", False), (None, None)], "x string, locked boolean")
    assert [r[0] for r in logs.select(X.corrupted(F.col("x"), F.col("locked"))).collect()] == [True, True, False, False]
    marks = spark.createDataFrame([("a_b ![c_d](e_f.png) g\\_h <i>",)], "x string")
    assert marks.select(T.escape_markdown(F.col("x"))).first()[0] == "a\\_b ![c_d](e_f.png) g\\_h &lt;i&gt;"
    assert P.join_lone_signs("This is the reason\n⸮") == "This is the reason⸮"
