"""Problem 1: a language with a confidence for each document and each stretch in another language.

Method: nearest-centroid classification. A text is cut into units (sentences, at most twelve words), a unit's
vector holds the TF-IDF weights of the letter n-grams inside its words, and it is compared by cosine with several
clustered centroids per language. Consecutive units share a language unless the evidence pays for the switch, and a
segment farther from every centroid than training segments of its length is rejected as `und`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.text import MIX, broadcast_value, char_tables, codes, groups_by_size, map_columns, mix, sampled_by_label, spread, word_hashes, word_ranges

LANGUAGES = ("deu_Latn", "eng_Latn", "fra_Latn", "ita_Latn", "nld_Latn", "por_Latn", "rus_Cyrl", "spa_Latn")
PLACEHOLDERS = ("", "und", "unknown")
DIMS = 1 << 14
UNIT_WORDS = 12
TERMINATORS = ".!?;:|•*#…"
SCHEMA = "doc_id bigint, label string, language string, score double, segments array<struct<start:int,stop:int,language:string,score:double,words:int>>"


@dataclass
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray  # DIMS x (languages * clusters), idf already multiplied in
    clusters: int
    switch: float  # evidence that a change of language must pay for
    floor: np.ndarray  # least cosine accepted, by log2 of the number of n-grams
    cache: dict = field(default_factory=dict)


def _grams(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 2-, 3- and 4-grams of each word with a blank on either side; the word that each belongs to."""
    n = end - start + 2
    at = np.cumsum(n) - n
    word = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(word)) - at[word]
    c = np.zeros(len(word) + 3, dtype=np.uint64)
    inner = (pos > 0) & (pos < n[word] - 1)
    c[:-3][inner] = low[(start[word] + pos - 1)[inner]]
    c[:-3][~inner] = 32
    left = n[word] - pos
    hs, ws = [], []
    with np.errstate(over="ignore"):
        h = c[:-3] + np.uint64(1)
        for k in (2, 3, 4):
            h = h * np.uint64(0x100000001B3) + c[k - 1 : len(word) + k - 1]
            ok = left >= k
            hs.append((mix(h[ok] * MIX + np.uint64(k)) >> np.uint64(50)).astype(np.int32))
            ws.append(word[ok])
    return np.concatenate(hs), np.concatenate(ws)


def _units(texts: list[str]) -> dict[str, np.ndarray]:
    """Words and units of several texts: ranges, hashes, unit of each word, document of each unit."""
    lower, kinds = char_tables()
    term = _terms()
    a = codes("\n\n".join(texts))
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(sizes + 2) - sizes - 2
    low, kind = lower[a], kinds[a]
    start, end = word_ranges(kind)
    # letters pulled apart are no words and speak for no language
    one = end - start == 1
    apart = one.copy()
    apart[:-1] &= ~one[1:] | (start[1:] - end[:-1] > 3)
    apart[1:] &= ~one[:-1] | (start[1:] - end[:-1] > 3)
    keep = ~one | apart
    start, end = start[keep], end[keep]
    doc = np.searchsorted(first, start, side="right") - 1
    flags = term[a]
    nl = a == 10
    flags[1:] |= nl[1:] & nl[:-1]
    cum = np.concatenate([[0], np.cumsum(flags)])
    brk = np.ones(len(start), dtype=bool)
    if len(start) > 1:
        brk[1:] = (cum[start[1:]] > cum[end[:-1]]) | (doc[1:] != doc[:-1])
    unit0 = np.cumsum(brk) - 1
    at = np.flatnonzero(brk)
    pos = np.arange(len(start)) - at[unit0] if len(start) else np.zeros(0, dtype=np.int64)
    brk |= (pos % UNIT_WORDS == 0) & (pos > 0)
    unit = np.cumsum(brk) - 1
    return {"low": low, "kind": kind, "start": start, "end": end, "first": first, "unit": unit, "at": np.flatnonzero(brk), "doc": doc[brk]}


def _terms() -> np.ndarray:
    t = np.zeros(0x10000, dtype=bool)
    t[[ord(c) for c in TERMINATORS]] = True
    return t


def _word_rows(u: dict[str, np.ndarray], matrix: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the dot products of its n-grams with the columns of matrix, its squared length and n-gram count.

    Words repeat, so each distinct word of the batch is computed once.
    """
    h = word_hashes(u["low"], u["start"], u["end"])
    _, at, back = np.unique(h, return_index=True, return_inverse=True)
    s, e = u["start"][at], u["end"][at]
    grams, word = _grams(u["low"], s, e)
    order = np.argsort(word, kind="stable")
    grams, word = grams[order], word[order]
    edges = np.searchsorted(word, np.arange(len(s)))
    rows = np.add.reduceat(matrix[grams], edges, axis=0) if len(s) else np.zeros((0, matrix.shape[1]), np.float32)
    square = np.add.reduceat(idf[grams] ** 2, edges) if len(s) else np.zeros(0, np.float32)
    count = np.diff(np.append(edges, len(grams)))
    digit = u["kind"][s] == 2  # numbers and codes speak for no language
    rows[digit], square[digit], count[digit] = 0, 0, 0
    return np.column_stack([rows, square, count]).astype(np.float32), back


def classify(texts: list[str | None], m: Model) -> list[tuple[str | None, float | None, list[tuple]]]:
    """(language, score, segments) of each text; a segment is (start, stop, language, score, words).

    None or empty text: (None, None, []). A text without letters is `und` with score 0 and no segments. The score is
    the share of the best cosine that stands above the second language's, 0 to 1.
    """
    out: list = [(None, None, []) for _ in texts]
    live = [i for i, t in enumerate(texts) if t]
    L, K = len(m.languages), m.clusters
    for lo, hi in groups_by_size([texts[i] for i in live], 1_000_000):
        ids = live[lo:hi]
        u = _units([texts[i] for i in ids])
        if not len(u["start"]):
            for i in ids:
                out[i] = ("und", 0.0, [])
            continue
        rows, back = _word_rows(u, m.centroids, m.idf)
        sums = np.add.reduceat(rows[back], u["at"], axis=0)  # units x (centroids, square, grams)
        words = np.diff(np.append(u["at"], len(u["start"])))
        best = sums[:, : L * K].reshape(-1, L, K).max(axis=2)
        label = _decode(best, u["doc"], len(ids), m.switch)
        # segments: runs of equal label in a document
        new = np.ones(len(label), dtype=bool)
        new[1:] = (label[1:] != label[:-1]) | (u["doc"][1:] != u["doc"][:-1])
        seg = np.flatnonzero(new)
        stot = np.add.reduceat(sums, seg, axis=0)
        swords = np.add.reduceat(words, seg)
        cos = stot[:, : L * K].reshape(-1, L, K).max(axis=2) / np.sqrt(np.maximum(stot[:, -2:-1], 1e-9))
        sdoc = u["doc"][seg]
        last_word = np.append(u["at"][1:], len(u["start"])) - 1
        sstart = u["start"][u["at"][seg]] - u["first"][sdoc]
        sstop = u["end"][last_word[np.append(seg[1:], len(label)) - 1]] - u["first"][sdoc]
        top = cos.argmax(axis=1)
        topv = cos[np.arange(len(cos)), top]
        second = np.where(np.arange(L) == top[:, None], -1, cos).max(axis=1)
        conf = np.clip((topv - second) / np.maximum(topv, 1e-9), 0, 1)
        bucket = np.minimum(np.log2(np.maximum(stot[:, -1], 1)).astype(int), len(m.floor) - 1)
        name = np.where((topv > 0) & (topv >= m.floor[bucket]), top, L)
        per: dict[int, list[tuple]] = {}
        names = [*m.languages, "und"]
        for d, s, e, n, c, w in zip(sdoc.tolist(), sstart.tolist(), sstop.tolist(), name.tolist(), conf.tolist(), swords.tolist()):
            got = per.setdefault(d, [])
            if got and got[-1][2] == names[n]:  # the rejected and the renamed may leave equal neighbours
                s0, _, _, c0, w0 = got.pop()
                s, c, w = s0, (c0 * w0 + c * w) / (w0 + w), w0 + w
            got.append((s, e, names[n], float(c), w))
        for j, i in enumerate(ids):
            segs = per.get(j, [])
            total: dict[str, list[float]] = {}
            for s in segs:
                x = total.setdefault(s[2], [0, 0.0])
                x[0] += s[4]
                x[1] += s[4] * s[3]
            known = {k: v for k, v in total.items() if k != "und"}
            if known:
                main = min(known, key=lambda k: (-known[k][0], k))
                out[i] = (main, known[main][1] / known[main][0], segs)
            else:
                out[i] = ("und", 0.0, segs)
    return out


def _decode(score: np.ndarray, doc: np.ndarray, docs: int, switch: float) -> np.ndarray:
    """Best labels of each document's units when every change of label costs `switch`; all documents advance together."""
    n = np.bincount(doc, minlength=docs)
    at = np.cumsum(n) - n
    order = np.argsort(-n, kind="stable")
    n, at = n[order], at[order]
    back = np.zeros(score.shape, dtype=np.int8)
    value = np.zeros((docs, score.shape[1]), dtype=np.float64)
    own = np.arange(score.shape[1], dtype=np.int8)
    alive = np.searchsorted(-n, -np.arange(int(n[0])), side="left").tolist()
    for t, live in enumerate(alive):
        v = value[:live]
        if t:
            best = v.argmax(axis=1)[:, None]
            jump = v.max(axis=1)[:, None] - switch
            back[at[:live] + t] = np.where(v >= jump, own, best)
            np.maximum(v, jump, out=v)
        v += score[at[:live] + t]
    label = np.zeros(len(score), dtype=np.int8)
    cur = value.argmax(axis=1)
    for t in range(int(n[0]) - 1, -1, -1):
        live = alive[t]
        label[at[:live] + t] = cur[:live]
        cur[:live] = back[at[:live] + t, cur[:live]]
    return label


def _vectors(texts: list[str]) -> tuple[np.ndarray, list[dict]]:
    """Counts of hashed n-grams by document, dense; the units of each."""
    out = np.zeros((len(texts), DIMS), dtype=np.float32)
    for i, t in enumerate(texts):
        u = _units([t])
        if len(u["start"]):
            keep = u["kind"][u["start"]] == 1
            g, _ = _grams(u["low"], u["start"][keep], u["end"][keep])
            out[i] = np.bincount(g, minlength=DIMS)
    return out


def train(rows: list[tuple[str, str]], clusters: int = 3, rounds: int = 6, seed: int = 1) -> Model:
    """Centroids from (label, text) rows, some of them wrongly labelled.

    A row nearer to another language's mean is set aside before the rows of each language are clustered.
    """
    rows = [(a, b) for a, b in rows if b and a]
    langs = tuple(sorted({a for a, _ in rows})) or LANGUAGES
    L, K = len(langs), clusters
    y = np.array([langs.index(a) for a, _ in rows], dtype=int)
    x = _vectors([b for _, b in rows]) if rows else np.zeros((0, DIMS), np.float32)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + np.float32(0.05)
    x *= idf
    x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-9)[:, None]
    good = np.ones(len(x), dtype=bool)
    for _ in range(4):
        mean = np.stack([x[good & (y == i)].mean(axis=0) if (good & (y == i)).any() else np.zeros(DIMS, np.float32) for i in range(L)])
        mean /= np.maximum(np.linalg.norm(mean, axis=1), 1e-9)[:, None]
        sim = x @ mean.T
        good = sim.argmax(axis=1) == y
    rng = np.random.default_rng(seed)
    cent = np.zeros((L, K, DIMS), dtype=np.float32)
    for i in range(L):
        z = x[good & (y == i)]
        if not len(z):
            continue
        c = z[rng.choice(len(z), K, replace=len(z) < K)].copy()
        for _ in range(rounds):
            near = (z @ c.T).argmax(axis=1)
            for k in range(K):
                if (near == k).any():
                    c[k] = z[near == k].mean(axis=0)
            c /= np.maximum(np.linalg.norm(c, axis=1), 1e-9)[:, None]
        cent[i] = c
    m = Model(langs, idf, np.ascontiguousarray((cent.reshape(L * K, DIMS) * idf).T), K, 0.0, np.zeros(24, np.float32))
    # the evidence of one word, and the cosines that segments of each length reach
    margins, cosines = [], [[] for _ in range(24)]
    for i in np.flatnonzero(good)[:: max(1, int(good.sum()) // 400)]:
        u = _units([rows[i][1]])
        r, back = _word_rows(u, m.centroids, m.idf)
        units = np.add.reduceat(r[back], u["at"], axis=0)
        words = np.diff(np.append(u["at"], len(u["start"])))
        best = units[:, : L * K].reshape(-1, L, K).max(axis=2)
        if L > 1:
            part = np.partition(best, L - 2, axis=1)
            margins += ((best[:, y[i]] - np.where(best[:, y[i]] == part[:, -1], part[:, -2], part[:, -1])) / words).tolist()
        for span in (1, 2, 4, 8, 1 << 30):
            for a in range(0, len(units), span):
                s = units[a : a + span].sum(axis=0)
                if s[-1] > 0:
                    cosines[min(int(np.log2(s[-1])), 23)].append(float(s[: L * K].max() / np.sqrt(max(s[-2], 1e-9))))
    m.switch = float(np.median(margins)) * 4 if margins else 0.0
    low = 0.0
    for b in range(24):
        if len(cosines[b]) >= 50:
            low = 0.5 * float(np.quantile(cosines[b], 0.005))
        m.floor[b] = low
    return m


def fit(docs: DataFrame, per_language: int = 120, clusters: int = 3) -> Model:
    """Fit on at most about per_language labelled rows of each language (the bound of the sample)."""
    rows = sampled_by_label(docs.where(F.col("text").isNotNull() & (F.length("text") >= 200) & (F.length("text") < 20000)), "lang", "doc_id", per_language, LANGUAGES)
    return train([(r[0], r[1]) for r in rows.select("lang", "text", "doc_id").orderBy("doc_id").drop("doc_id").collect()], clusters)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, label (the lang it came with), language, score, segments with code-point ranges.

    A null or empty text gives nulls and no segments; repeated rows stay repeated; an empty table gives none.
    """
    shared = broadcast_value(docs.sparkSession, {"m": [model.idf, model.centroids]})
    rest = (model.languages, model.clusters, model.switch, model.floor)

    def run(cols):
        idf, cent = shared.value["m"]
        m = Model(rest[0], idf, cent, *rest[1:])
        ids, labels, texts = cols["doc_id"].to_pylist(), cols["lang"].to_pylist(), cols["text"]
        for a in range(0, len(ids), 256):
            got = classify(texts[a : a + 256].to_pylist(), m)
            names = ("start", "stop", "language", "score", "words")
            yield {"doc_id": ids[a : a + 256], "label": labels[a : a + 256], "language": [g[0] for g in got], "score": [g[1] for g in got], "segments": [[dict(zip(names, s)) for s in g[2]] for g in got]}

    return map_columns(spread(docs.select("doc_id", "lang", "text")), run, SCHEMA)


def label_cases(docs: DataFrame, model: Model, run_words: int = 20, least_score: float = 0.25) -> DataFrame:
    """(doc_id, found_lang) of documents whose label is absent, names no language of the text, or whose text has several.

    A language counts when run_words words in a row are in it with a confidence of least_score; the main language always does.
    """
    found = identify(docs, model)
    counted = F.array_distinct(F.concat(F.array("language"), F.transform(F.filter("segments", lambda s: (s["words"] >= run_words) & (s["score"] >= least_score) & (s["language"] != "und")), lambda s: s["language"])))
    both = found.where(F.col("language").isNotNull() & (F.col("language") != "und")).select("doc_id", "label", counted.alias("langs"))
    same = F.col("label").isNotNull() & (F.col("langs") == F.array("label"))
    return both.where(~F.coalesce(same, F.lit(False))).select("doc_id", F.explode("langs").alias("found_lang"))
