import random

import pytest
from pyspark.sql import functions as F

from quire.llm import abuse, cutoff, language, leak, mixing, neardup, packing, reading, scan, tokens

DOCS = "doc_id bigint, text string, lang string, source string, score double, web_host string, page_ends array<bigint>, extra string"


def words(rng, n, tag="w"):
    return " ".join(f"{tag}{rng.randint(0, 5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        rows.append((i, words(rng, 120), "eng_Latn" if i % 3 else None, "a" if i % 3 else "b", float(i % 7), "WWW.Host.example" if i % 2 else "http://host.example:80/x", None, "x"))
    rows += [(100, None, None, None, None, None, None, None), (101, "", "und", "a", 3.0, None, [], "y"), (102, "x " * 60000, "deu_Latn", "a", None, "h", [5, 60000], "z"), (5, rows[5][1], "eng_Latn", "a", 5.0, "h", None, "again"), (103, rows[7][1].upper(), "eng_Latn", "c", 2.0, "h", None, "copy")]
    rows += [(104, rows[9][1] + " one two three four", "eng_Latn", "c", 2.0, None, None, "near")]
    return spark.createDataFrame(rows, DOCS)


def test_every_operator_takes_dirt_and_nothing(spark, docs):
    items = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, None), (3, "")], "item_id bigint, passage string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "doc_id bigint, toxic int")
    keep = spark.createDataFrame([("a", 50), ("nobody", 10), (None, 5), ("b", None)], "source string, keep_pct int")
    packs = spark.createDataFrame([(1, 64), (2, None), (3, 0)], "pack_id bigint, capacity_tokens bigint")
    mix = spark.createDataFrame([(1, "a", 500, 2), (1, "b", 400, 1), (1, "nobody", 100, 1), (2, "c", None, 1)], "mix_id bigint, source string, share_permille int, max_repeats int")
    for d in (docs, docs.limit(0)):
        m = language.fit(d)
        for df in (
            language.identify(d, m), language.label_cases(d, m), tokens.counted(d), tokens.cube(d), reading.found(d), reading.profile(d), neardup.pairs(d), neardup.groups(d), scan.examine(d, with_text=True), scan.found(d),
            cutoff.kept(d, keep), cutoff.report(d, keep), leak.found(d, items), packing.assign(d, packs), mixing.choose(d, mix)[0], mixing.shares(d, mix), abuse.found(d, labels), abuse.rates(d, labels),
        ):
            assert len(set(df.columns)) == len(df.columns)
            df.collect()


def test_neardup(spark, docs):
    got = {tuple(r) for r in neardup.pairs(docs).collect()}
    assert got == {(7, 103), (9, 104)}
    g = {r["doc_id"]: (r["class_id"], r["links"]) for r in neardup.groups(docs).collect()}
    assert g[103] == g[7] == (7, 0) and g[104][0] == g[9][0] == 9 and g[9][1] == 1 and 100 not in g and g[102][0] == 102


def test_neardup_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        if i % 4 and rows:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 12)):
                w[rng.randrange(len(w))] = f"n{rng.randint(0, 999)}"
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, words(rng, 150)))
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b]) - 1e-12}
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {tuple(r) for r in neardup.pairs(df).collect()} == want and len(want) > 50


def test_neardup_hot_region_recurses(spark, monkeypatch):
    rng = random.Random(3)
    base = words(rng, 100).split()
    rows = []
    for i in range(150):  # one family, so that regions are far over the bounds set here
        w = list(base)
        for _ in range(rng.randint(0, 10)):
            w[rng.randrange(100)] = f"n{rng.randint(0, 9999)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(neardup, "SMALL", 10)
    monkeypatch.setattr(neardup, "CELL", 40)
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(98)} for i, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b]) - 1e-12}
    got = {tuple(r) for r in neardup.pairs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == want and len(want) > 500


def test_components_of_a_chain(spark):
    nodes = spark.range(60).select(F.col("id").alias("doc_id"))
    edges = spark.createDataFrame([(i, i + 1) for i in range(49)], "a bigint, b bigint")
    got = {r["doc_id"]: r["class_id"] for r in neardup.components(nodes, edges).collect()}
    assert {got[i] for i in range(50)} == {0} and got[55] == 55


def test_cutoffs_with_ties(spark):
    rng = random.Random(4)
    rows = [(i, s, float(rng.randint(0, 4)) if s == "tied" else rng.random()) for s in ("tied", "plain", "one") for i in range(1 if s == "one" else 300)]
    rows.append((9, "plain", None))
    df = spark.createDataFrame(rows, "doc_id bigint, source string, score double").repartition(5)
    t = spark.createDataFrame([("tied", 33), ("plain", 7), ("one", 100), ("none", 50), ("tied", 20)], "source string, keep_pct int")
    for r in cutoff.cutoffs(df, t).collect():
        v = sorted((x[2] for x in rows if x[1] == r["source"] and x[2] is not None), reverse=True)
        if not v:
            assert r["cutoff"] is None and r["records"] == 0
            continue
        need = -(-len(v) * r["keep_pct"] // 100)
        assert r["cutoff"] == v[need - 1] and r["rank"] == need


def test_token_cube_adds_up(spark, docs):
    c = tokens.cube(docs).collect()
    total = tokens.counted(docs).agg(F.sum("n_tokens")).first()[0]
    assert sum(r["tokens"] for r in c if r["level"] == 0) == total and next(r["tokens"] for r in c if r["level"] == 7) == total
    assert {r["domain"] for r in c if r["level"] == 0} >= {"host.example", "h"}


def test_mix_reaches_shares(spark):
    rng = random.Random(5)
    rows = [(i, words(rng, rng.randint(20, 200)), "big" if i < 300 else "small") for i in range(340)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mix = spark.createDataFrame([(1, "big", 600, 2), (1, "small", 400, 3)], "mix_id bigint, source string, share_permille int, max_repeats int")
    for r in mixing.shares(d, mix).collect():
        assert abs(r["reached_permille"] - r["share_permille"]) < 10 and r["most_repeats"] <= (2 if r["source"] == "big" else 3)


def test_leak_frame(spark):
    d = spark.createDataFrame([(1, "Some words. Alpha beta gam-\nma delta epsilon zeta eta theta iota kappa. End"), (2, "alpha beta gamma only")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id bigint, passage string")
    assert [tuple(r) for r in leak.found(d, items).collect()] == [(1, 7, 1.0)]


@pytest.mark.skipif(not __import__("os").path.exists("/root/testdata/sf0.001"), reason="needs the test tables")
def test_all_queries_run(spark):
    from quire.llm import queries

    for name, q in queries.QUERIES.items():
        df = q(spark, "/root/testdata/sf0.001")
        assert len(set(df.columns)) == len(df.columns), name
        df.write.format("noop").mode("overwrite").save()
