"""Problem 3: reading difficulty of each document, and documents written throughout for beginners or for specialists.

Method: a linear pairwise ranker over syntax and vocabulary features of text windows, calibrated into levels by isotonic
regression. The tables hold no graded pairs, so a sample of documents is graded by the published LIX bands
(mean sentence length plus percentage of words over six letters), and pairs whose grades differ teach the ranker, which
then orders windows by all features together. A document's level is the word-weighted mean of its windows' levels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import language
from quire.llm.text import broadcast_value, char_tables, codes, groups_by_size, map_columns, sampled_by_label, spread, word_hashes, word_ranges

LANGUAGES = ("eng_Latn", "deu_Latn", "fra_Latn", "spa_Latn")
LIX_BANDS = (25, 35, 45, 55, 65)  # fixed values: very easy, easy, medium, difficult, very difficult
WINDOW_WORDS = 60
BASIC, EXPERT = 0.9, 4.5  # levels up to and from which a window is written for beginners or specialists
THROUGHOUT = 0.9  # share of the running text's words in such windows
FEATURES = ("sentence", "letters", "long", "very_long", "short", "clauses", "types")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # scores
    levels: np.ndarray  # isotonic levels at the knots


_ends: list[np.ndarray] = []


def _marks() -> list[np.ndarray]:
    if not _ends:
        e, c = np.zeros(0x10000, bool), np.zeros(0x10000, bool)
        e[[ord(x) for x in ".!?…"]] = True
        c[[ord(x) for x in ",;:—"]] = True
        b = np.zeros(0x10000, bool)
        b[[ord(x) for x in "|•#"]] = True
        _ends.extend([e, c, b])
    return _ends


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Running text in windows of about WINDOW_WORDS words: (features, document, words, lix) of each window.

    Headings, list items and table cells, that is short stretches without an end mark, are no running text.
    """
    empty = np.zeros((0, len(FEATURES))), np.zeros(0, int), np.zeros(0), np.zeros(0)
    lower, kinds = char_tables()
    end_mark, clause_mark, bar = _marks()
    a = codes("\n\n".join(texts))
    first = np.cumsum([0] + [len(t) + 2 for t in texts])[:-1]
    kind = kinds[a]
    start, end = word_ranges(kind)
    if not len(start):
        return empty
    doc = np.searchsorted(first, start, side="right") - 1
    nl = a == 10
    blank = np.zeros(len(a), bool)
    blank[1:] = nl[1:] & nl[:-1]
    ends, clauses = np.concatenate([[0], np.cumsum(end_mark[a])]), np.concatenate([[0], np.cumsum(clause_mark[a])])
    hard = np.concatenate([[0], np.cumsum(blank | bar[a])])
    nxt = np.append(start[1:], len(a))
    ended = ends[nxt] > ends[end]
    # an abbreviation or a number goes on without white space
    space = np.isin(a[np.minimum(end + 1, len(a) - 1)], (32, 10, 9, 34, 0x201D, 0xBB, 0x2019)) | (end + 1 >= len(a))
    ended &= space
    brk = np.ones(len(start), bool)
    brk[1:] = ended[:-1] | (hard[start[1:]] > hard[end[:-1]]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(brk)
    last = np.append(at[1:], len(start)) - 1
    n = last - at + 1
    alpha = kind[start] == 1
    running = (ended[last] & (n >= 2)) | (n > 12)
    if not running.any():
        return empty
    length = (end - start).astype(float) * alpha
    per = lambda x: np.add.reduceat(x.astype(float), at)
    words, letters = per(alpha), per(length)
    long, vlong, short = per(length > 6), per(length >= 11), per(alpha & (length <= 3))
    marks = (clauses[end[last]] - clauses[start[at]]).astype(float)
    sdoc = doc[at]
    keep = running & (words > 0)
    sid = np.flatnonzero(keep)
    # windows: sentences of one document by running word count; a short rest joins the window before
    w = words[sid]
    d = sdoc[sid]
    cum = np.cumsum(w)
    base = np.zeros(len(texts))
    f0 = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
    base[d[f0]] = cum[f0] - w[f0]
    total = np.bincount(d, weights=w, minlength=len(texts))
    slot = ((cum - w - base[d]) // WINDOW_WORDS).astype(int)
    most = np.maximum(total[d] // WINDOW_WORDS - 1, 0).astype(int)
    slot = np.minimum(slot, most)
    wb = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (slot[1:] != slot[:-1])))
    agg = lambda x: np.add.reduceat(x[sid], wb)
    W, S = agg(words), np.diff(np.append(wb, len(sid)))
    low = word_hashes(lower[a], start, end)
    wid = np.full(len(start), -1)
    order = np.cumsum(np.append(True, (d[1:] != d[:-1]) | (slot[1:] != slot[:-1]))) - 1
    wid_of_sentence = np.full(len(at), -1)
    wid_of_sentence[sid] = order
    wid = np.repeat(wid_of_sentence, n)
    inside = (wid >= 0) & alpha
    wi, lo = wid[inside], low[inside]
    by = np.lexsort((lo, wi))
    wi, lo = wi[by], lo[by]
    fresh = np.append(True, (wi[1:] != wi[:-1]) | (lo[1:] != lo[:-1]))
    types = np.bincount(wi[fresh], minlength=len(wb))
    sent = W / S
    lw = agg(long) / W
    x = np.column_stack([np.log(sent), agg(letters) / W, lw, agg(vlong) / W, agg(short) / W, np.log1p(agg(marks) / S), types / W])
    return x, d[wb], W, sent + 100 * lw


def train(texts: list[str], pairs: int = 20000, seed: int = 3) -> Model:
    """Ranker and calibration from a sample of texts graded by LIX."""
    x, doc, w, _ = windows(texts) if texts else (np.zeros((0, len(FEATURES))), np.zeros(0, int), np.zeros(0), np.zeros(0))
    if len(np.unique(doc)) < 2:
        return Model(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(len(FEATURES)), np.zeros(1), np.full(1, 2.5))
    n = doc.max() + 1
    total = np.maximum(np.bincount(doc, weights=w, minlength=n), 1e-9)
    f = np.stack([np.bincount(doc, weights=x[:, k] * w, minlength=n) / total for k in range(x.shape[1])], axis=1)
    lix = np.bincount(doc, weights=(np.exp(x[:, 0]) + 100 * x[:, 2]) * w, minlength=n) / total
    has = np.bincount(doc, minlength=n) > 0
    f, lix = f[has], lix[has]
    mean, scale = f.mean(axis=0), np.maximum(f.std(axis=0), 1e-6)
    z = (f - mean) / scale
    rng = np.random.default_rng(seed)
    i, j = rng.integers(0, len(z), pairs), rng.integers(0, len(z), pairs)
    gap = lix[i] - lix[j]
    ok = np.abs(gap) >= 5
    d, s = (z[i] - z[j])[ok], np.sign(gap[ok])
    wt = np.zeros(z.shape[1])
    for _ in range(300):  # logistic loss on pair differences, small ridge
        p = 1 / (1 + np.exp(np.clip(s * (d @ wt), -30, 30)))
        wt += 0.5 * ((s * p) @ d / max(1, len(s)) - 0.005 * wt)
    # calibration on windows, which is what is graded later
    sc = ((x - mean) / scale) @ wt
    wl = np.interp(np.exp(x[:, 0]) + 100 * x[:, 2], (LIX_BANDS[0] - 10, *LIX_BANDS[:-1], LIX_BANDS[-1]), range(6))
    order = np.argsort(sc, kind="stable")
    knots, levels = isotonic(sc[order], wl[order], w[order])
    return Model(mean, scale, wt, knots, levels)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over x in order: block means of x and the non-decreasing weighted means of y."""
    blocks: list[list[float]] = []  # sum wy, sum w, sum wx
    for a, b, c in zip(x.tolist(), y.tolist(), w.tolist()):
        blocks.append([b * c, c, a * c])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            p = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], p)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def levels_of(texts: list[str], m: Model) -> list[tuple[float | None, float, float]]:
    """(level 0-5 or None without running text, share of words in basic windows, share in expert windows)."""
    out: list = [(None, 0.0, 0.0) for _ in texts]
    for lo, hi in groups_by_size(texts, 1_000_000):
        x, doc, w, _ = windows(texts[lo:hi])
        if not len(doc):
            continue
        lv = np.interp(((x - m.mean) / m.scale) @ m.weights, m.knots, m.levels)
        t = np.bincount(doc, weights=w, minlength=hi - lo)
        mean, basic, expert = (np.bincount(doc, weights=w * v, minlength=hi - lo) for v in (lv, lv <= BASIC, lv >= EXPERT))
        for i in np.flatnonzero(t):
            out[lo + i] = (float(mean[i] / t[i]), float(basic[i] / t[i]), float(expert[i] / t[i]))
    return out


def fit(docs: DataFrame, per_language: int = 400) -> Model:
    """Fit on at most about per_language documents of each language label (the bound of the sample)."""
    rows = sampled_by_label(docs.where(F.col("text").isNotNull() & (F.length("text") >= 500) & (F.length("text") < 20000)), "lang", "doc_id", per_language, LANGUAGES)
    return train([r[1] for r in sorted(rows.select("doc_id", "text").collect())])


def grade(docs: DataFrame, model: Model, lid: language.Model) -> DataFrame:
    """(doc_id, source, language, level, basic_share, expert_share); nulls where there is no text or no running text."""
    shared = broadcast_value(docs.sparkSession, {"m": [lid.idf, lid.centroids]})
    rest = (lid.languages, lid.clusters, lid.switch, lid.floor)

    def run(cols):
        lm = language.Model(rest[0], *shared.value["m"], *rest[1:])
        ids, sources, texts = cols["doc_id"].to_pylist(), cols["source"].to_pylist(), cols["text"]
        for a in range(0, len(ids), 256):
            part = texts[a : a + 256].to_pylist()
            got = levels_of([t or "" for t in part], model)
            yield {
                "doc_id": ids[a : a + 256], "source": sources[a : a + 256], "language": [g[0] for g in language.classify(part, lm)], "level": [g[0] for g in got],
                "basic_share": [g[1] if t else None for g, t in zip(got, part)], "expert_share": [g[2] if t else None for g, t in zip(got, part)],
            }

    return map_columns(spread(docs.select("doc_id", "source", "text")), run, "doc_id bigint, source string, language string, level double, basic_share double, expert_share double")


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, reading_level): documents of LANGUAGES whose running text is throughout `basic` or `expert`."""
    g = grade(docs, fit(docs), language.fit(docs)).where(F.col("language").isin(*LANGUAGES) & F.col("level").isNotNull())
    kind = F.when(F.col("basic_share") >= THROUGHOUT, "basic").when(F.col("expert_share") >= THROUGHOUT, "expert")
    return g.select("doc_id", kind.alias("reading_level")).where(F.col("reading_level").isNotNull())


def profile(docs: DataFrame) -> DataFrame:
    """(source, language, band, documents): how many documents of each level, rounded, a source has."""
    g = grade(docs, fit(docs), language.fit(docs)).where(F.col("level").isNotNull())
    return g.groupBy("source", "language", F.round("level").cast("int").alias("band")).agg(F.count("*").alias("documents"))
