import pytest

from quire.operators import evaluation as E
from quire.operators import extract as X
from quire.operators import models as M
from quire.operators import pagetext as P

BOX = "struct<l:double,t:double,r:double,b:double>"


def test_otsl_round_trip():
    rows = [[{"text": "h", "c": 2, "r": 1, "h": True}, {"text": "k", "c": 1, "r": 2, "h": True}], [{"text": "1", "c": 1, "r": 1, "h": False}, {"text": "", "c": 1, "r": 1, "h": False}]]
    data = X.otsl(rows)
    assert data == "<ched>h<lcel><ched>k<nl>\n<fcel>1<ecel><ucel><nl>\n"
    assert X.from_otsl(data) == rows
    assert X.from_otsl("") == [] and X.otsl([]) == ""


def test_doctags():
    n = X.from_doctags("<title>T</title>\n<section_header_level_1><loc_3>S</section_header_level_1>\n<list_item>a &amp; b</list_item>\n<otsl><ched>x<nl><fcel>1<nl></otsl>")
    assert [(x["kind"], x["text"]) for x in n] == [("title", "T"), ("heading", "S"), ("list", ""), ("item", "a & b"), ("table", "")]
    assert n[-1]["rows"] == [["x"], ["1"]]


def test_encoding():
    assert X.repair_encoding("cafÃ©") == "café"
    assert X.repair_encoding("a &amp; b\r\nc\x00\x1b[31md e") == "a & b\ncd\ne"
    assert X.repair_encoding("&lt; <b>") == "&lt; <b>" and X.repair_encoding(None) is None and X.repair_encoding("") == ""
    assert P.clean_page("ab c\n\n\n\nd ") == "ab\nc\n\nd"


def test_meteor():
    assert E.meteor("a b c", "a b c") == pytest.approx(1 - 0.5 / 27)
    assert E.meteor("a b", "c d") == 0 and E.meteor(None, "a") == 0


def test_extract_keeps_failures(spark):
    df = spark.createDataFrame([(1, "<a"), (2, "<article><body><p>x</p></body></article>"), (3, None)], "id bigint, content string")
    got = {r["id"]: (r["text"], r["route"]) for r in X.extract(df, "jats", "id").collect()}
    assert got == {1: ("", "failed"), 2: ("x", "extracted"), 3: ("", "extracted")}


def test_page_rules(spark):
    img = spark.createDataFrame([(1, p, 5, (0.0, 0.0, 595.0, 50.0)) for p in (0, 1, 2)] + [(1, 0, 6, (0.0, 51.0, 595.0, 99.0)), (1, 0, 6, (0.0, 51.0, 595.0, 99.0))], f"doc_id bigint, page_no int, xref int, box {BOX}")
    assert [r["xref"] for r in X.junk_images(img, img.select("doc_id", "page_no")).collect()] == [5]
    s = {(r["page_no"], r["strip"]): r["box"]["b"] for r in X.merge_strips(img).collect()}
    assert s == {(0, 0): 99.0, (1, 0): 50.0, (2, 0): 50.0}
    pages = spark.createDataFrame([(1, 0, "eng_Latn", "The end"), (1, 1, "eng_Latn", "The start"), (1, 2, "deu_Latn", "The x"), (1, 3, None, None)], "doc_id bigint, page_no int, best_lang string, text string")
    answers = spark.createDataFrame([(1, 0, "TEXT"), (1, 1, "BLANK")], "doc_id bigint, page_no int, answer string")
    assert sorted(r["page_no"] for r in X.drop_blank(X.blank_candidates(pages), answers).collect()) == [0, 2, 3]
    cells = spark.createDataFrame([(1, 0, 1, "exam-", (0.0, 0.0, 30.0, 10.0)), (1, 0, 1, "ple", (0.0, 12.0, 18.0, 22.0)), (1, 0, 1, "of", (24.0, 12.0, 36.0, 22.0))], f"doc_id bigint, page_no int, cluster bigint, text string, box {BOX}")
    assert X.join_lines(cells).first()["text"] == "example of"


def test_observed_counts(spark):
    df = spark.createDataFrame([("failed",), ("extracted",), (None,)], "route string")
    out, o = X.counted(df, "counts")
    out.collect()
    assert o.get == {"total": 3, "forwarded": 2, "dropped": 1}


def test_language_model_holds_out(spark):
    a, b = "the house near the river was old ", "das haus am fluss war sehr alt "
    rows = [(i, (a if i % 2 else b) * 5, ("eng" if i % 2 else "deu") if i < 40 else None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r["language"] for r in M.document_languages(docs, ("deu", "eng")).collect()}
    assert all(got[i] == ("eng" if i % 2 else "deu") for i in range(60))
