import gzip
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.operators import evaluation as E
from quire.operators import layout as L
from quire.operators import neardup as N
from quire.operators import tree as X
from quire.sources import archives as A
from quire.sources import formats as S
from quire.sources import sinks

BOX = "struct<l:double,t:double,r:double,b:double>"


def test_html():
    n = S.html('<body>pre<h1>T</h1><script>var t="</p>"</script><p>one<br>two<ul><li>a<li>b</ul><table><tr><th colspan=2>h</th></tr><tr><td>1</td><td>2</td></tr></table>')
    assert [(x["kind"], x["text"]) for x in n] == [("text", "pre"), ("title", "T"), ("text", "one\ntwo"), ("list", ""), ("item", "a"), ("item", "b"), ("table", "")]
    assert n[-1]["rows"] == [["h", "h"], ["1", "2"]] and n[0]["layer"] == "furniture" and n[4]["parent_id"] == 3
    assert S.html("") == [] and S.html("<p>x")[0]["layer"] == "body"


def test_other_formats():
    assert [x["kind"] for x in S.markdown("# T\n\na\nb\n\n- x\n  - y\n\n| a | b |\n|---|---|\n| 1 | 2 |\n")] == ["title", "text", "list", "item", "list", "item", "table"]
    assert S.csv_table("a;b\n1;2\n3")[0]["rows"] == [["a", "b"], ["1", "2"], ["3", ""]]
    assert [x["kind"] for x in S.asciidoc("= T\n\n== S\ntext\n\n* a\n\n.Cap\n|===\n|a|b\n|1|2\n|===\n")] == ["title", "heading", "text", "list", "item", "table", "caption"]
    j = "<article><front><article-title>T</article-title><abstract><p>A</p></abstract></front><body><sec><title>S</title><p>x <b>y</b></p></sec></body></article>"
    assert [(x["kind"], x["text"]) for x in S.jats(j)] == [("title", "T"), ("heading", "Abstract"), ("text", "A"), ("heading", "S"), ("text", "x y")]


def _zip(**files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for k, v in files.items():
            z.writestr(k.replace("__", "/").replace("_xml", ".xml"), v)
    return b.getvalue()


def test_office_formats():
    x = _zip(xl__worksheets__sheet1_xml='<w><c r="A1"><v>1</v></c><c r="B1" t="inlineStr"><is><t>z</t></is></c><c r="A2"><v>2</v></c><c r="D5"><v>9</v></c></w>')
    assert [n["rows"] for n in S.xlsx(x) if n["kind"] == "table"] == [[["1", "z"], ["2", ""]], [["9"]]]
    d = _zip(word__document_xml='<w:document xmlns:w="w"><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>H</w:t></w:r></w:p><w:p><w:r><w:t>x</w:t></w:r></w:p></w:body></w:document>')
    assert [(n["kind"], n["text"]) for n in S.docx(d)] == [("heading", "H"), ("text", "x")]
    p = _zip(ppt__slides__slide1_xml='<a><sp><ph type="title"/><p><t>T</t></p></sp><sp><p><pPr lvl="1"/><t>i</t></p></sp></a>')
    assert [n["kind"] for n in S.pptx(p)] == ["group", "title", "list", "item"]


def test_parse_keeps_bad_rows(spark):
    df = spark.createDataFrame([(1, "<a"), (2, None), (3, "<a/>")], "doc_id bigint, content string")
    got = {r["doc_id"]: (r["error"], len(r["nodes"])) for r in S.parse(df, "jats").collect()}
    assert got == {1: ("ParseError", 0), 2: (None, 0), 3: (None, 0)}


def test_tree(spark):
    md = "# T\n\nintro\n\n## S\n\n- a\n- b\n\n## R\n\nlast words here\n\n| x | y |\n|---|---|\n| 1 | 2 |"
    n = S.nodes(spark.createDataFrame([(1, md)], "doc_id bigint, content string"), "markdown").cache()
    assert X.serialised(n).first()["text"] == "# T\n\nintro\n\n## S\n\n- a\n\n- b\n\n## R\n\nlast words here\n\n| x | y |\n|---|---|\n| 1 | 2 |"
    c = X.hierarchical_chunks(n).orderBy("chunk").collect()
    assert [(r["headings"], r["text"]) for r in c] == [(["T"], "intro"), (["T", "S"], "- a\n- b"), (["T", "R"], "last words here"), (["T", "R"], "1, y = 2")]
    h = X.hybrid_chunks(n, 2).orderBy("chunk").collect()
    assert [r["text"] for r in h] == ["intro", "- a", "- b", "last words", "here", "1, y", "= 2"]
    assert X.broken(n).count() == 0
    assert X.without(n, n.where("text = 'S'")).where("kind = 'item'").count() == 0
    n.unpersist()


def test_layout(spark):
    cells = spark.createDataFrame([(1, 0, 0, "a", (0.0, 0.0, 10.0, 10.0)), (1, 0, 1, "b", (14.0, 0.0, 24.0, 10.0)), (1, 0, 2, "far", (500.0, 500.0, 510.0, 510.0))], f"doc_id bigint, page_no int, cell bigint, text string, box {BOX}")
    clusters = spark.createDataFrame([(1, 0, 7, "text", 0.9, (0.0, 0.0, 30.0, 10.0)), (1, 0, 8, "text", 0.8, (1.0, 0.0, 30.0, 10.0))], f"doc_id bigint, page_no int, cluster bigint, label string, confidence double, box {BOX}")
    a = L.assign_cells(cells, clusters)
    assert {(r["cell"], r["cluster"]) for r in a.collect()} == {(0, 7), (1, 7)}
    assert [r["cluster"] for r in L.orphans(cells, a).collect()] == [2]
    assert [r["cluster"] for r in L.without_overlaps(clusters).collect()] == [7]
    m = L.merge_cells(cells.withColumn("label", F.lit("text"))).collect()
    assert sorted(r["text"] for r in m) == ["a b", "far"]
    o = spark.createDataFrame([(1, 0, 1, "text", (0.0, 0.0, 40.0, 10.0)), (1, 0, 2, "text", (50.0, 0.0, 90.0, 10.0)), (1, 0, 3, "text", (0.0, 20.0, 40.0, 30.0)), (1, 0, 4, "page_header", (0.0, 90.0, 9.0, 99.0))], f"doc_id bigint, page_no int, item bigint, label string, box {BOX}")
    assert [r["item"] for r in L.reading_order(o).orderBy("position").collect()] == [4, 1, 3, 2]


def test_measures(spark):
    assert E.tree_distance(("a", [("b", []), ("c", [])]), ("a", [("c", [])])) == 1
    assert E.teds([["a", "b"]], [["a", "b"]]) == 1
    assert E.edit_similarity("a b c", "a x c") == pytest.approx(2 / 3) and E.edit_similarity("", None) == 1
    assert E.bleu("a b c d e", "a b c d e") == pytest.approx(1) and E.bleu("a", "") == 0
    t = spark.createDataFrame([(1, 0, 1, "x", (0.0, 0.0, 10.0, 10.0)), (1, 0, 2, "x", (20.0, 0.0, 30.0, 10.0))], f"doc_id bigint, page_no int, id bigint, label string, box {BOX}")
    g = t.withColumn("confidence", F.lit(0.9))
    assert E.average_precision(t, g).first()[1:] == (1.0, 1.0, 1.0)
    assert E.average_precision(t, g.where("id = 1")).first()[1] == 0.5


def test_minhash_groups(spark):
    words = " ".join(f"w{i}" for i in range(200))
    df = spark.createDataFrame([(1, "en", words), (2, "en", words + " more"), (3, "en", "quite another text about nothing at all"), (4, "de", words), (5, "en", None), (6, "en", "")], "doc_id bigint, lang string, text string")
    got = {r["doc_id"]: (r["cluster_id"], r["kept"]) for r in N.deduplicate(df, "lang").collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (4, True)}


def test_connected_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    got = {r["node"]: r["cluster"] for r in N.connected(e).collect()}
    assert {got[i] for i in range(41)} == {0} and got[101] == 100


def test_warc(spark, tmp_path):
    def rec(kind, body, url="http://x/"):
        http = b"HTTP/1.1 200 OK\r\nContent-Type: application/pdf; v=1\r\n\r\n" + body if kind == "response" else body
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(http)}\r\n\r\n".encode() + http + b"\r\n\r\n"

    parts = [gzip.compress(rec("warcinfo", b"x")), gzip.compress(rec("response", b"%PDF-1")), gzip.compress(rec("resource", b"y"))]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts))
    df = A.read_warc(spark, str(tmp_path))
    got = df.orderBy("warc_record_offset").collect()
    assert [(r["record_type"], bytes(r["body"]), r["content_mime_type"], r["warc_record_offset"]) for r in got] == [("response", b"%PDF-1", "application/pdf", len(parts[0])), ("resource", b"y", None, len(parts[0]) + len(parts[1]))]
    back = A.attach_payload(df.select("warc_filename", "warc_record_offset", "warc_record_length")).collect()
    assert {bytes(r["media_bytes"]) for r in back} == {b"%PDF-1", b"y"}
    lost = spark.createDataFrame([("no such file", 0, 10), (None, None, None)], "warc_filename string, warc_record_offset bigint, warc_record_length bigint")
    assert [r["media_bytes"] for r in A.attach_payload(lost).collect()] == [None, None]


def test_fetch_and_chain(spark):
    def get(u):
        if u == "bad":
            raise OSError
        return u.encode()

    df = spark.createDataFrame([("a",), ("bad",), (None,)], "url string")
    assert sorted((r[0] or "", r[1] and bytes(r[1])) for r in A.fetch_urls(df, get).collect()) == [("", None), ("a", b"a"), ("bad", None)]
    assert A.chained(df, spark.createDataFrame([(1,)], "other int")).count() == 4


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.9), (2, "b", 0.1), (3, "a", None)], "doc_id bigint, route string, edu_score double")
    sinks.write_routed(df, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r" / "route=a")).count() == 2
    sinks.write_published(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p" / "best")).count() == 1
    t = spark.createDataFrame([(i, [i, i]) for i in range(10)], "doc_id bigint, tokens array<int>")
    sinks.token_shards(t, str(tmp_path / "t"), 0, 10)
    x = spark.read.parquet(str(tmp_path / "t"))
    assert x.count() == 10 and x.select("shard").distinct().count() > 1 and x.where("element_at(tokens, -1) <> 0").count() == 0


def test_boxes_are_matched_on_every_page(spark):
    schema = f"doc_id bigint, page_no int, id bigint, label string, box {BOX}"
    a, b = (0.0, 0.0, 10.0, 10.0), (20.0, 20.0, 30.0, 30.0)
    truth = spark.createDataFrame([(1, 0, 0, "text", a), (1, 1, 0, "text", b), (1, 1, 1, "text", a)], schema)
    guess = spark.createDataFrame([(1, 0, 0, "text", a), (1, 0, 1, "text", b), (1, 1, 0, "text", a)], schema)
    got = {(r["page_no"], r["guess"]): (r["truth"], round(r["iou"], 3)) for r in E.match_boxes(truth, guess).collect()}
    assert got == {(0, 0): (0, 1.0), (0, 1): (None, 0.0), (1, 0): (1, 1.0)}
    got = {(r["page_no"], r["level"]): r["score"] for r in E.weighted_match(truth, guess, (0.5,)).collect()}
    assert got == {(0, 0.5): 0.5, (1, 0.5): 1.0}


def test_records(spark):
    from quire.operators import records as K

    df = spark.createDataFrame([(1, (2, "x"), None), (2, None, bytearray(b"a"))], "id int, meta struct<a:int,big:string>, media_bytes binary")
    assert K.without_field(df, "meta", "big").schema["meta"].dataType.names == ["a"] and K.without_field(df, "meta", "no").columns == df.columns == K.without_field(df, "no", "big").columns
    assert [r["route"] for r in K.fetched(df).orderBy("id").collect()] == ["failed", "fetched"]
    n = spark.range(4000).select(F.col("id"))
    assert abs(K.sampled(n, 0.25, "id").count() - 1000) < 120 and K.sampled(n, 0, "id").count() == 0 and K.sampled(n, 1, "id").count() == 4000
    assert K.repeated(n.limit(3), 2).count() == 6 and K.repeated(n.limit(3), 0).count() == 0
    assert K.target_column(["x", "labels", "ocr_quality_score"]) == "ocr_quality_score" and K.target_column(["y", "x"], "x") == "x"
    with pytest.raises(ValueError):
        K.target_column(["x"])
    lines = spark.createDataFrame([(["the coun-", "cil – “met” ", None, "", "on-", "_x", "a•b"],), ([],), (None,)], "l array<string>")
    assert [r[0] for r in lines.select(K.joined_cells(F.col("l"))).collect()] == ['the council – "met" on-_x a·b', "", None]
    t = spark.createDataFrame([("abcdef ghi",), ("abcdefghi",), ("ab",), (None,)], "t string")
    assert [r[0] for r in t.select(K.capped(F.col("t"), 4)).collect()] == ["abcdef", "abcd", "ab", None]
    assert K.chunks_of("one two three four", K.Words(), 2, 100) == ("one", None)
    top, bottom = K.chunks_of("aa bb cc dd " * 20, K.Words(), 3, 30)
    assert top == "aa bb" and bottom == "cc dd " or bottom.endswith("dd ")


def test_tree_edits(spark):
    from quire.operators import records as K

    rows = [(1, 0, None, 0, "heading", "h"), (1, 1, 0, 1, "list", ""), (1, 2, 1, 2, "item", "a"), (1, 3, 0, 3, "text", "z"), (2, 0, None, 0, "text", "o")]
    n = spark.createDataFrame(rows, "doc_id int, node_id int, parent_id int, seq int, kind string, text string")
    new = spark.createDataFrame([(1, 1, "text", "new"), (2, None, "text", "end"), (1, 77, "text", "lost")], "doc_id int, sibling int, kind string, text string")
    got = {d: [r["text"] for r in K.inserted(n, new).where(F.col("doc_id") == d).orderBy("seq").collect()] for d in (1, 2)}
    assert got == {1: ["h", "", "a", "new", "z"], 2: ["o", "end"]}
    assert [r["text"] for r in K.inserted(n, new, True).where("doc_id = 1").orderBy("seq").collect()] == ["h", "new", "", "a", "z"]
    swap = spark.createDataFrame([(1, 3, None, "Z")], "doc_id int, node_id int, kind string, text string")
    assert [(r["kind"], r["text"]) for r in K.replaced(n, swap).where("node_id = 3").collect()] == [("text", "Z")]
    deep = spark.createDataFrame([(1, i, i - 1 if i else None, i, "text", str(i)) for i in range(100)] + [(1, 100, None, 100, "text", "kept")], "doc_id int, node_id int, parent_id int, seq int, kind string, text string")
    assert [r["text"] for r in X.without(deep, deep.where("node_id = 0")).collect()] == ["kept"]
