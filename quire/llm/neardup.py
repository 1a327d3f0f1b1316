"""Problem 4: records that are mostly the same, at any size of the table.

Method: a Jaccard metric-space join. Equal shingle sets collapse into one representative first. Regions at the top are
those of single-shingle pivots under random orders (a text lies in the cell of the pivot that comes first among its own
shingles), because distances to whole-document pivots are all close to 1 there and triangle-inequality windows would
replicate every text into every region. Inside a region that stays large, where texts do share content, document pivots
create Voronoi cells; a text is replicated into each cell whose pivot is at most twice the radius farther than its
nearest one, cells split recursively, and each small cell is joined exactly. Every pair is verified on whole sets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.text import MIX, has_text, map_columns, mix, shingle_sets, spread
from quire.session import dropped, written

BANDS, ROWS = 48, 5
SLOTS = 1 << 24  # bits of a table of ids, which bounds it at 262,144 longs
SMALL = 200  # texts in a region that is paired directly
CELL = 200  # texts in a cell that one task joins
PIVOTS = 12


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240229)
    n = BANDS * ROWS
    return (r.integers(0, 1 << 32, n, dtype=np.uint64) | np.uint64(1)).astype(np.uint32), r.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)


def bands(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Region keys of each set: for each of BANDS, a hash of the first shingles under ROWS random orders; and one bit of
    each of these first shingles, as four longs, from which a pair's similarity is estimated before its sets are read."""
    n = np.array([len(s) for s in sets])
    h = np.concatenate(sets)
    h = (h >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum(n) - n
    a, b = _multipliers()
    low = np.empty((len(a), len(sets)), dtype=np.uint64)
    for i in range(len(a)):
        low[i] = np.minimum.reduceat((h ^ b[i]) * a[i], at)
    keys = np.zeros((BANDS, len(sets)), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(ROWS):
            keys = mix(keys * MIX + low[j::ROWS] + np.uint64(j + 1))
        keys = mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * MIX)
    bits = np.zeros((256, len(sets)), dtype=np.uint8)
    bits[: len(a)] = (low >> np.uint64(7)) & np.uint64(1)
    return keys.T.view(np.int64), np.ascontiguousarray(np.packbits(bits, axis=0).T).view(np.int64)


def _may_be(x: str, y: str, least: float):
    """Whether two sketches agree in so many bits that their sets may be similar: 5.5 deviations below what is expected
    at the threshold, which loses fewer than one in ten million pairs that lie exactly on it."""
    n, p = BANDS * ROWS, (1 + least) / 2
    most = int(n - (n * p - 5.5 * (n * p * (1 - p)) ** 0.5))
    return sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(4)), F.lit(0)) <= most


def marked(df: DataFrame, ids: DataFrame) -> DataFrame:
    """df with a boolean `marked`: true for each row whose doc_id is among ids, and for a few others.

    The ids set bits of a table of SLOTS bits, which is broadcast: its size has that bound, whatever the number of ids.
    What has to be exact compares the marked rows with the ids afterwards.
    """
    slot = f"pmod(xxhash64(doc_id), {SLOTS}L)"
    table = ids.select(F.expr(f"{slot} div 64").alias("slot_word"), F.expr(f"shiftleft(1L, cast({slot} % 64 as int))").alias("slot_bit")).groupBy("slot_word").agg(F.bit_or("slot_bit").alias("slot_bits"))
    got = df.withColumn("slot_word", F.expr(f"{slot} div 64")).join(F.broadcast(table), "slot_word", "left")
    return got.withColumn("marked", F.expr(f"coalesce(getbit(slot_bits, cast({slot} % 64 as int)), 0) = 1")).drop("slot_word", "slot_bits")


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, set_id, keys, bits): the size of the shingle set, its identity, region keys and sketch. Texts without a word are left out."""

    def run(cols):
        ids, texts = cols["doc_id"].to_pylist(), cols["text"]
        for a in range(0, len(ids), 128):
            sets = shingle_sets(texts[a : a + 128].to_pylist(), k)
            keep = [i for i, s in enumerate(sets) if len(s)]
            if not keep:
                continue
            sets = [sets[i] for i in keep]
            with np.errstate(over="ignore"):
                total = np.array([mix(s).sum(dtype=np.uint64) for s in sets])
            keys, bits = bands(sets)
            yield {"doc_id": [ids[a + i] for i in keep], "n": [len(s) for s in sets], "set_id": mix(total).view(np.int64), "keys": list(keys), "bits": list(bits)}

    return map_columns(spread(docs.where(has_text()).select("doc_id", "text")), run, "doc_id bigint, n int, set_id bigint, keys array<bigint>, bits array<bigint>")


def set_table(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, set): 32-bit shingle hashes of the given documents and of a few more, sorted. Texts are read again
    where the scan finds their id marked, so that none is shuffled."""

    def run(cols):
        ids, texts = cols["doc_id"].to_pylist(), cols["text"]
        for a in range(0, len(ids), 128):
            sets = [np.unique((s >> np.uint64(32)).astype(np.uint32)) for s in shingle_sets(texts[a : a + 128].to_pylist(), k)]
            yield {"doc_id": ids[a : a + 128], "n": [len(s) for s in sets], "set": [s.tobytes() for s in sets]}

    return map_columns(marked(docs.where(has_text()).select("doc_id", "text"), ids).where("marked").select("doc_id", "text"), run, "doc_id bigint, n int, set binary")


def _similar(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose similarity is at least `least`."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("sb"))

    def run(cols):
        a, b, sa, sb = (cols[c].to_pylist() for c in ("a", "b", "sa", "sb"))
        s = [_similar(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) for x, y in zip(sa, sb)]
        keep = [i for i, v in enumerate(s) if v >= least - 1e-12]
        yield {"a": [a[i] for i in keep], "b": [b[i] for i in keep], "similarity": [s[i] for i in keep]}

    return map_columns(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb"), run, "a bigint, b bigint, similarity double")


def _cell_pairs(rows, least: float) -> tuple[list, list, list]:
    """Exact join of one cell, or of its two blocks: rows of (doc_id, set, side); pivots prune pairs by the triangle inequality."""
    ids = np.array([r[0] for r in rows], dtype=np.int64)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    sets = [np.frombuffer(rows[i][1], np.uint32) for i in order]
    side = np.array([rows[i][2] for i in order])
    size = np.array([len(s) for s in sets])
    radius = 1 - least
    pivots = range(0, len(ids), max(1, len(ids) // 4))
    dist = np.array([[1 - _similar(s, sets[p]) for s in sets] for p in pivots])
    out: tuple[list, list, list] = ([], [], [])
    two = side.max() > 0
    for i in range(len(ids)):
        ok = (np.abs(dist - dist[:, i : i + 1]) <= radius + 1e-9).all(axis=0)
        ok &= (size >= least * size[i] - 1e-9) & (size * least <= size[i] + 1e-9)
        ok &= (side != side[i]) if two else True
        ok[: i + 1] = False
        for j in np.flatnonzero(ok):
            if ids[i] != ids[j] and (s := _similar(sets[i], sets[j])) >= least - 1e-12:
                out[0].append(int(ids[i]))
                out[1].append(int(ids[j]))
                out[2].append(s)
    return out


def voronoi_links(members: DataFrame, sets: DataFrame, least: float, rounds: int = 6) -> DataFrame:
    """Links inside large regions: members (region, doc_id), sets (doc_id, n, set).

    A round splits each region by its document pivots with windows of twice the radius. Cells of at most CELL texts are
    joined by one task. A cell that windows no longer shrink is joined by tasks of two blocks each, so that no task
    holds an unbounded group and no pair is left out.
    """
    from pyspark.sql.types import StructType

    spark = members.sparkSession
    radius = 1 - least
    todo = written(members.join(sets, "doc_id").select("region", "doc_id", "set").dropDuplicates(["region", "doc_id"]))
    links: list[DataFrame] = []
    schema = StructType.fromDDL("a bigint, b bigint, similarity double")

    def joined(cells: DataFrame) -> DataFrame:
        import pandas as pd

        def one(pdf):
            a, b, s = _cell_pairs(list(zip(pdf["doc_id"], pdf["set"], pdf["side"])), least)
            return pd.DataFrame({"a": pd.Series(a, dtype="int64"), "b": pd.Series(b, dtype="int64"), "similarity": pd.Series(s, dtype="float64")})

        return cells.groupBy("region", "block").applyInPandas(one, schema)

    for step in range(rounds + 1):
        sizes = written(todo.groupBy("region").agg(F.count("*").alias("m")))
        if sizes.limit(1).count() == 0:
            break
        sized = todo.join(sizes, "region")
        small = sized.where(F.col("m") <= CELL).select("region", F.lit("").alias("block"), "doc_id", "set", F.lit(0).alias("side"))
        links.append(written(joined(small)))
        large = sized.where(F.col("m") > CELL)
        if sizes.where(F.col("m") > CELL).limit(1).count() == 0:
            break
        if step == rounds:
            links.append(written(joined(_blocks(large))))
            break
        mark = F.pmod(F.xxhash64("doc_id", F.lit(step)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        pivots = large.where(mark < F.lit(float(PIVOTS)) / F.col("m")).groupBy("region").agg(F.collect_list("set").alias("pivots"))

        def assign(cols):
            region, doc, sets_, piv, m = (cols[c].to_pylist() for c in ("region", "doc_id", "set", "pivots", "m"))
            out: dict[str, list] = {"region": [], "doc_id": [], "set": [], "stuck": [], "m": []}
            for i in range(len(doc)):
                s = np.frombuffer(sets_[i], np.uint32)
                cells = [0]
                if piv[i]:
                    d = np.array([1 - _similar(s, np.frombuffer(p, np.uint32)) for p in piv[i]])
                    cells = np.flatnonzero(d <= d.min() + 2 * radius + 1e-9).tolist()
                for c in cells:
                    out["region"].append(f"{region[i]}.{c}")
                    out["doc_id"].append(doc[i])
                    out["set"].append(sets_[i])
                    out["stuck"].append(not piv[i])
                    out["m"].append(m[i])
            yield out

        cells = written(map_columns(large.join(pivots, "region", "left").select("region", "doc_id", "set", "pivots", "m"), assign, "region string, doc_id bigint, set binary, stuck boolean, m bigint"))
        now = cells.groupBy("region").agg(F.count("*").alias("now"))
        cells = cells.join(now, "region")
        still = (F.col("now") > 0.7 * F.col("m")) & (F.col("now") > CELL)
        # where a cell keeps most of its region, the region is joined in blocks instead; once per region
        parent = F.regexp_replace("region", r"\.\d+$", "")
        stuck = written(cells.where(still).select(parent.alias("region")).distinct())
        links.append(written(joined(_blocks(large.join(stuck, "region", "left_semi")))))
        todo = written(cells.withColumn("parent", parent).join(stuck.withColumnRenamed("region", "parent"), "parent", "left_anti").select("region", "doc_id", "set"))
    out = spark.createDataFrame([], schema)
    for x in links:
        out = out.unionByName(x)
    return out.dropDuplicates(["a", "b"])


def _blocks(cells: DataFrame) -> DataFrame:
    """Rows of large cells as tasks of two blocks of about half a CELL: each text goes to every block pair with its own."""
    half = CELL // 2
    b = F.ceil(F.col("m") / half).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), b).cast("int")
    x = cells.withColumn("b", b).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("b") - 1)))
    block = F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other"))
    side = (F.col("own") > F.col("other")).cast("int")
    return x.select("region", block.alias("block"), "doc_id", "set", side.alias("side"))


def links(docs: DataFrame, k: int, least: float) -> tuple[DataFrame, DataFrame]:
    """(members, links): members (doc_id, rep) joins equal shingle sets; links (a, b, similarity) are all between
    representatives whose Jaccard similarity is at least `least`.

    Null and empty texts, and texts without a word, are no members. Empty tables give empty results. Repeated rows of
    one doc_id count once.
    """
    sig = written(signatures(docs, k))
    reps = sig.groupBy("set_id", "n").agg(F.min("doc_id").alias("rep"))
    copies = written(sig.groupBy("doc_id", "set_id", "n").agg(F.count("*").alias("rows")).join(reps, ["set_id", "n"]).select("doc_id", "rep", "rows"))
    members = copies.select("doc_id", "rep").distinct()
    # one row of each representative; only the rows that may be copies are compared with the copies' ids
    odd = copies.where((F.col("doc_id") != F.col("rep")) | (F.col("rows") > 1)).select("doc_id")
    told = marked(sig.select("doc_id", "keys"), odd)
    others = copies.where(F.col("doc_id") != F.col("rep")).select("doc_id")
    alone = written(told.where(~F.col("marked")).drop("marked").unionByName(told.where("marked").drop("marked").join(others, "doc_id", "left_anti").dropDuplicates(["doc_id"])))
    regions = alone.select("doc_id", F.explode("keys").alias("region")).repartition(F.col("region"))
    sizes = regions.groupBy("region").agg(F.count("*").alias("m"), F.sum(F.xxhash64("doc_id") % F.lit(1 << 40)).alias("who"))
    shared = written(regions.join(sizes.where(F.col("m") > 1), "region"))
    dropped(alone)
    near_ids = shared.select("doc_id").distinct()
    sketches = marked(sig.select("doc_id", "n", "bits"), near_ids).where("marked").drop("marked").join(near_ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    small = written(shared.where(F.col("m") <= SMALL).select("region", "doc_id").join(sketches, "doc_id"))
    dropped(sig)
    x, y = (small.select("region", F.col("doc_id").alias(i), F.col("n").alias(f"n{i}"), F.col("bits").alias(f"s{i}")) for i in "ab")
    near = (F.col("a") < F.col("b")) & (F.col("na") >= F.col("nb") * least) & (F.col("nb") >= F.col("na") * least) & _may_be("sa", "sb", least)
    pairs = x.join(y, "region").where(near)
    pairs = written(pairs.select("a", "b").distinct())
    dropped(small)
    # large regions: one of those with the same members is enough
    big = written(shared.where(F.col("m") > SMALL).groupBy("m", "who").agg(F.min("region").alias("region")))
    members_big = shared.join(big.select("region"), "region", "left_semi").select(F.col("region").cast("string").alias("region"), "doc_id")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).union(members_big.select("doc_id"))
    sets = written(set_table(docs, wanted, k))
    found = _verified(pairs, sets, least)
    if big.limit(1).count():
        found = found.unionByName(voronoi_links(members_big, sets, least))
    found = written(found.dropDuplicates(["a", "b"]))
    dropped(pairs, shared, sets)
    return members, found


def pairs(docs: DataFrame, k: int = 3, least: float = 0.7) -> DataFrame:
    """All (doc_id_a, doc_id_b), a < b, that are similar; equal texts in full, as their number is the result's."""
    members, found = links(docs, k, least)
    a, b = members.select(F.col("rep").alias("a"), F.col("doc_id").alias("x")), members.select(F.col("rep").alias("b"), F.col("doc_id").alias("y"))
    across = found.select("a", "b").join(a, "a").join(b, "b").select("x", "y")
    within = a.join(b, F.col("a") == F.col("b")).where(F.col("x") < F.col("y")).select("x", "y")
    return across.union(within).select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(doc_id, class_id): least node of each connected component; alternating star contraction, tables cut the lineage.

    Every round each node points to the least neighbour and the neighbours' least is linked back, until no edge changes.
    """
    e = written(edges.select("a", "b").where(F.col("a") != F.col("b")))
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # large star: larger neighbours point at the least; small star: the node and its smaller neighbours do
        star = both.join(low, "a")
        large = star.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        e2 = large.where(F.col("a") != F.col("b")).distinct()
        down = e2.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low2 = down.groupBy("a").agg(F.min("b").alias("low"))
        s2 = down.join(low2, "a")
        e3 = s2.select(F.col("a"), F.col("low").alias("b")).union(s2.select(F.col("b").alias("a"), F.col("low").alias("b"))).where(F.col("a") != F.col("b")).distinct()
        new = written(e3)
        same = new.select("a", "b").exceptAll(e.select("a", "b")).limit(1).count() == 0 and e.select("a", "b").exceptAll(new).limit(1).count() == 0
        dropped(new if same else e)
        if same:
            break
        e = new
    label = e.groupBy("a").agg(F.min("b").alias("class_id"))
    return nodes.join(label.withColumnRenamed("a", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def groups(docs: DataFrame, k: int = 5, least: float = 0.8) -> DataFrame:
    """One row per document with text: doc_id, class_id (least document of its group), links to different texts."""
    members, found = links(docs, k, least)
    reps = members.select(F.col("rep").alias("doc_id")).distinct()
    classes = components(reps, found)
    degree = found.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("links"))
    by_rep = classes.join(degree, "doc_id", "left").select(F.col("doc_id").alias("rep"), "class_id", F.coalesce("links", F.lit(0)).alias("links"))
    return members.join(by_rep, "rep").select("doc_id", "class_id", "links")
