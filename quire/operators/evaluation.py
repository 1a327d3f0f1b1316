"""Measures of layout, text, order and tables."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import records as R
from quire.operators.layout import BOX, grouped


def token_overlap(a: Column, b: Column) -> Column:
    """struct(precision, recall, f1) of the word sets of two texts; all 0 where one has no words."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x != ""))
    x, y = words(a), words(b)
    n = F.size(F.array_intersect(x, y))
    p, r = F.coalesce(F.try_divide(n, F.size(y)), F.lit(0.0)), F.coalesce(F.try_divide(n, F.size(x)), F.lit(0.0))
    return F.struct(p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"))


def edit_similarity(a: str | None, b: str | None) -> float:
    """1 minus the word edit distance over the longer text's words; 1 for two empty texts."""
    x, y = (a or "").split(), (b or "").split()
    if not x and not y:
        return 1.0
    row = list(range(len(y) + 1))
    for i, u in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, v in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (u != v))
    return 1 - row[-1] / max(len(x), len(y))


def bleu(truth: str | None, guess: str | None, n: int = 4) -> float:
    """BLEU of words up to n-grams with brevity penalty; 0 where an order has no match or a text no words."""
    x, y = (truth or "").split(), (guess or "").split()
    if not x or not y:
        return 0.0
    total = 0.0
    for k in range(1, n + 1):
        a, b = (Counter(zip(*[w[i:] for i in range(k)])) for w in (x, y))
        hit, all_ = sum((a & b).values()), max(sum(b.values()), 0)
        if not hit:
            return 0.0
        total += math.log(hit / all_)
    return min(1.0, math.exp(1 - len(x) / len(y))) * math.exp(total / n)


def match_boxes(truth: DataFrame, guess: DataFrame) -> DataFrame:
    """(doc_id, page_no, guess, truth, iou): the truth box of a page with the largest IoU for each guessed box; none (null) where it meets none."""
    page = ["doc_id", "page_no"]
    j = guess.select(*page, F.col("id").alias("guess"), F.col("box").alias("g")).join(truth.select(*page, F.col("id").alias("truth"), F.col("box").alias("t")), page)
    x = j.withColumn("iou", R.iou(F.col("g"), F.col("t"))).where("iou > 0").groupBy(*page, "guess").agg(F.max_by("truth", F.struct("iou", -F.col("truth"))).alias("truth"), F.max("iou").alias("iou"))
    return guess.select(*page, F.col("id").alias("guess")).join(x, [*page, "guess"], "left").select(*page, "guess", "truth", F.round(F.coalesce("iou", F.lit(0.0)), 6).alias("iou"))


def reading_distance(items: DataFrame) -> DataFrame:
    """(doc_id, n, score): 1 minus the mean distance of predicted from true places over n; true and guess order columns."""
    t = F.row_number().over(Window.partitionBy("doc_id").orderBy("truth", "item")) - 1
    g = F.row_number().over(Window.partitionBy("doc_id").orderBy("guess", "item")) - 1
    return items.select("doc_id", t.alias("t"), g.alias("g")).groupBy("doc_id").agg(F.count("*").alias("n"), F.round(1 - F.sum(F.abs(F.col("t") - F.col("g"))) / (F.count("*") * F.count("*")), 6).alias("score"))


def spearman(items: DataFrame) -> DataFrame:
    """(doc_id, rho): 1 - 6 sum d² / n(n² - 1) of mean ranks; 0 for fewer than two items."""

    def rank(c: str) -> Column:
        low = F.rank().over(Window.partitionBy("doc_id").orderBy(c))
        return low + (F.count("*").over(Window.partitionBy("doc_id", c)) - 1) / 2

    x = items.select("doc_id", (rank("truth") - rank("guess")).alias("d")).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.col("d") * F.col("d")).alias("s"))
    return x.select("doc_id", F.round(F.when(F.col("n") > 1, 1 - 6 * F.col("s") / (F.col("n") * (F.col("n") * F.col("n") - 1))).otherwise(0.0), 6).alias("rho"))


def average_precision(truth: DataFrame, guess: DataFrame, levels: tuple[float, ...] = tuple(0.5 + 0.05 * i for i in range(10))) -> DataFrame:
    """(label, ap, ap50, ap75): area under the precision-recall steps, guesses matched greedily by confidence in a page.

    truth (doc_id, page_no, id, label, box), guess with confidence. Matching runs for a page; curves are windows.
    """

    def match(a, b) -> list[tuple]:
        out = []
        for label in {r["label"] for r in b or ()}:
            boxes = [r["box"] for r in a or () if r["label"] == label]
            own = sorted((r for r in b if r["label"] == label), key=lambda r: (-r["confidence"], r["id"]))
            # each pair is measured once, for all levels
            pairs = [[(_iou(r["box"], y), k) for k, y in enumerate(boxes)] for r in own]
            pairs = [sorted((x for x in p if x[0] >= levels[0]), reverse=True) for p in pairs]
            for level in levels:
                free = set(range(len(boxes)))
                for r, p in zip(own, pairs):
                    at = next((k for v, k in p if k in free), None)
                    ok = at is not None and next(v for v, k in p if k == at) >= level
                    if ok:
                        free.discard(at)
                    out.append((label, r["confidence"], level, int(ok)))
        return out

    part = lambda df, *c: df.groupBy("doc_id", "page_no").agg(F.collect_list(F.struct("id", "label", *c, "box")).alias("c" if c else "t"))
    u = F.udf(match, "array<struct<label:string,confidence:double,level:double,hit:int>>", useArrow=True).asNondeterministic()
    pages = part(truth).join(part(guess, "confidence"), ["doc_id", "page_no"], "full")
    m = pages.select(u("t", "c").alias("xs")).select(F.explode("xs").alias("x")).select("x.*")
    m = m.groupBy("label", "level", "confidence").agg(F.sum("hit").alias("h"), F.count("*").alias("c"))
    n = truth.groupBy("label").agg(F.count("*").alias("n"))
    w = Window.partitionBy("label", "level").orderBy(F.desc("confidence")).rowsBetween(Window.unboundedPreceding, 0)
    x = m.withColumns({"tp": F.sum("h").over(w), "all": F.sum("c").over(w)}).withColumn("p", F.col("tp") / F.col("all"))
    back = Window.partitionBy("label", "level").orderBy("confidence").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("p", F.max("p").over(back)).join(n, "label")
    ap = x.groupBy("label", "level").agg((F.sum(F.col("p") * F.col("h")) / F.first("n")).alias("ap"))
    at = lambda v: F.coalesce(F.max(F.when(F.abs(F.col("level") - v) < 1e-6, F.col("ap"))), F.lit(0.0))
    return n.join(ap, "label", "left").groupBy("label").agg(F.round(F.coalesce(F.sum("ap"), F.lit(0.0)) / len(levels), 6).alias("ap"), F.round(at(0.5), 6).alias("ap50"), F.round(at(0.75), 6).alias("ap75"))


def suppress(boxes: DataFrame, least: float = 0.35, most_iou: float = 0.35) -> DataFrame:
    """Boxes of enough confidence that no surer box of their label and page overlaps (non-maximum suppression)."""

    def one(rows: list[dict]) -> list[dict]:
        keep: list = []
        for r in sorted(rows, key=lambda r: (-r["confidence"], r["id"])):
            if all(_iou(r["box"], k["box"]) <= most_iou for k in keep):
                keep.append(r)
        return keep

    sure = boxes.where(F.col("confidence") >= least).select("doc_id", "page_no", "label", "id", "confidence", "box")
    return grouped(sure, ["doc_id", "page_no", "label"], one, f"id:bigint,confidence:double,box:{BOX}")


def _iou(a, b) -> float:
    s = max(min(a["r"], b["r"]) - max(a["l"], b["l"]), 0) * max(min(a["b"], b["b"]) - max(a["t"], b["t"]), 0)
    u = (a["r"] - a["l"]) * (a["b"] - a["t"]) + (b["r"] - b["l"]) * (b["b"] - b["t"]) - s
    return s / u if u > 0 else 0.0


Node = tuple[str, list]


def tree_distance(a: Node, b: Node, cost=None) -> float:
    """Zhang-Shasha edit distance of ordered trees (label, children); insert and delete cost 1, rename cost(x, y)."""
    cost = cost or (lambda x, y: float(x != y))

    def flat(t: Node):
        labels, left, keys = [], [], {}

        def walk(n: Node) -> int:
            first = None
            for c in n[1]:
                k = walk(c)
                first = k if first is None else first
            labels.append(n[0])
            left.append(len(labels) - 1 if first is None else first)
            keys[left[-1]] = len(labels) - 1
            return left[-1]

        walk(t)
        return labels, left, sorted(keys.values())

    la, fa, ka = flat(a)
    lb, fb, kb = flat(b)
    d = [[0.0] * len(lb) for _ in la]
    for i in ka:
        for j in kb:
            m, n = i - fa[i] + 2, j - fb[j] + 2
            t = [[0.0] * n for _ in range(m)]
            for x in range(1, m):
                t[x][0] = t[x - 1][0] + 1
            for y in range(1, n):
                t[0][y] = t[0][y - 1] + 1
            for x in range(1, m):
                for y in range(1, n):
                    p, q = fa[i] + x - 1, fb[j] + y - 1
                    if fa[p] == fa[i] and fb[q] == fb[j]:
                        t[x][y] = min(t[x - 1][y] + 1, t[x][y - 1] + 1, t[x - 1][y - 1] + cost(la[p], lb[q]))
                        d[p][q] = t[x][y]
                    else:
                        t[x][y] = min(t[x - 1][y] + 1, t[x][y - 1] + 1, t[fa[p] - fa[i]][fb[q] - fb[j]] + d[p][q])
    return d[-1][-1]


def teds(truth: list[list[str]], guess: list[list[str]]) -> float:
    """Tree-edit similarity of two tables given as rows of cells; renaming a cell costs its normalised edit distance."""

    def tree(rows: list[list[str]]) -> Node:
        return ("table", [("tr", [("td:" + c, []) for c in r]) for r in rows])

    def size(n: Node) -> int:
        return 1 + sum(map(size, n[1]))

    def cost(x: str, y: str) -> float:
        if x.startswith("td:") and y.startswith("td:"):
            return 1 - edit_similarity(" ".join(x[3:]), " ".join(y[3:]))
        return float(x != y)

    a, b = tree(truth), tree(guess)
    return 1 - tree_distance(a, b, cost) / max(size(a), size(b))


def meteor(truth: str | None, guess: str | None, alpha: float = 0.9, beta: float = 3.0, gamma: float = 0.5) -> float:
    """Harmonic mean of word matches, recall weighing more, less a penalty for the number of runs they fall into."""
    x, y = (truth or "").lower().split(), (guess or "").lower().split()
    if not x or not y:
        return 0.0
    where: dict[str, list[int]] = {}
    for i, w in enumerate(x):
        where.setdefault(w, []).append(i)
    at, last, runs, hit = None, -2, 0, 0
    for w in y:
        if not where.get(w):
            continue
        at = last + 1 if last + 1 in where[w] else where[w][0]
        where[w].remove(at)
        runs += at != last + 1
        hit, last = hit + 1, at
    if not hit:
        return 0.0
    p, r = hit / len(y), hit / len(x)
    return p * r / (alpha * p + (1 - alpha) * r) * (1 - gamma * (runs / hit) ** beta)


def weighted_match(truth: DataFrame, guess: DataFrame, levels: tuple[float, ...] = (0.5, 0.75, 0.9, 0.95)) -> DataFrame:
    """(doc_id, page_no, level, score): area of a page's guessed boxes that the first free truth box of their label meets at a level, over all their area."""

    def match(a, b) -> list[tuple]:
        own: dict[str, list] = {}
        for r in a or ():
            own.setdefault(r["label"], []).append(r["box"])
        free = {label: [list(range(len(boxes))) for _ in levels] for label, boxes in own.items()}
        good, whole = [0.0] * len(levels), 0.0
        for r in b or ():
            x = r["box"]
            s = (x["r"] - x["l"]) * (x["b"] - x["t"])
            whole += s
            boxes, seen = own.get(r["label"]), {}  # each pair is measured at most once, for all levels
            for n, level in enumerate(levels if boxes else ()):
                for k in free[r["label"]][n]:
                    if k not in seen:
                        seen[k] = _iou(boxes[k], x)
                    if seen[k] >= level:
                        free[r["label"]][n].remove(k)
                        good[n] += s
                        break
        return [(level, round(y / whole, 6) if whole else 0.0) for level, y in zip(levels, good)]

    part = lambda df, n: df.groupBy("doc_id", "page_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "label", "box"))), lambda r: r.dropFields("id")).alias(n))
    u = F.udf(match, "array<struct<level:double,score:double>>", useArrow=True).asNondeterministic()
    x = part(truth, "t").join(part(guess, "g"), ["doc_id", "page_no"], "full")
    return x.select("doc_id", "page_no", u("t", "g").alias("xs")).select("doc_id", "page_no", F.explode("xs").alias("x")).select("doc_id", "page_no", "x.*")
