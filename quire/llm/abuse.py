"""Problem 10: abusive, hateful or sexually explicit sentences, and a score for each document.

Method: multiple-instance learning. A document is a bag of sentences; only documents carry labels. A sentence's
probability is logistic in its words, its word pairs and the kinds of offensive stems it holds; the document's is the
noisy-or of its sentences, and all weights are trained from the document labels through the noisy-or, which also says
which sentences offend. Every sentence with any feature is scored. Characters are read through common disguises (signs
for letters, doubled letters, masked letters, letters pulled apart, accents) before words are formed.

The kinds of stems carry a prior, so that a few positive bags still give a model; labels move it. A long sentence is
read in overlapping windows, so that what stands far from an offence does not hide it.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.leak import DIVIDED
from quire.llm.text import MIX, broadcast_value, char_tables, codes, groups_by_size, has_text, map_columns, mix, spread, word_hashes, word_ranges

# Signs that stand for letters in disguised words
DISGUISE = {"@": "a", "4": "a", "3": "e", "1": "i", "0": "o", "$": "s", "5": "s", "7": "t"}
# Common offensive stems in eight languages, by kind; "=" marks whole words
STEMS = {
    "insult": "idiot moron imbecil cretin asshole bastard bitch whore dickhead wanker cunt fuck pathetic worthless brainless scumbag arschloch wichser hurensohn mistkerl dreckskerl hirnlos schwachkopf vollidiot trottel drecksack gilipoll cabron =puta "
    "desgraciad malnacid pendejo capullo subnormal connard connass salaud salope encul débile abruti enfoiré stronz coglion schifos cabrão otário canalha arrombad klootzak eikel hoer sukkel debiel идиот ублюд мудак мудил дебил придур кретин сволоч",
    "dehuman": "vermin scum filth subhuman parasit cockroach =rats =pigs ungeziefer abschaum untermensch schmarotz =ratten schwein escoria basura alimaña =ratas racaill ordure =lixo escumalha =ratos feccia =ratti ongediert uitschot =крысы отброс нелюд мразь мрази",
    "threat": "choke drown =kill murder stab strangl =bullet verreck krepier abstech umbring erwürg prügel mueras =muere =matar reviente crevez égorge =morre crepa ammazz =kapot doodsla verrek сдох убью подохн зареж",
    "sexual": "porno =porn horny =naked =nude slut hardcore orgasm moaned uncensored =nackte =geile geil desnud follar =nues =nue =nuas =nua =nuda =naakte neuken порно =голые обнаж трахн",
    "you": "=you =your =du =dich =dir =dein =deine =deinen =euch =te =tu =vous =ton =votre =ti =tua =tuo =teu =vosotros =vuestro =jij =je =jou =jullie =ты =тебя =тебе =твой =твоя =вы =вас =вам",
}
KINDS = ("insult", "dehuman", "threat", "sexual", "masked", "you", "two", "three")
# Weights of the kinds before any label is seen, for a bias of -4
PRIOR = np.array([2.5, 2.0, 1.5, 2.6, 1.0, 0.8, 1.5, 1.0])
BIAS = -4.0
WINDOW = 24  # words; longer sentences are read in windows that overlap by half
LEAST_SCORE = 0.5
SURE = 16.0  # likelihood ratio from which a word or pair is taken to speak for abuse by itself
LIKELY = 8.0  # and beside a stem, where far fewer words are tried
BAG_CHARS = 20_000  # bags longer than this are not trained on
SAMPLE_CHARS = 24_000_000  # of all bags of one label that are trained on


@dataclass
class Model:
    features: np.ndarray  # sorted hashes of words and word pairs
    weights: np.ndarray
    kinds: np.ndarray  # weights of KINDS
    bias: float


_tables: list[np.ndarray] = []
_stems: list = []
_known: dict[int, int] = {}  # kinds of words by hash, as bits


def _plain(s: str) -> str:
    """Lower case without accents of Latin letters, doubled letters once."""
    out = []
    for c in s.lower():
        base = unicodedata.normalize("NFD", c)[0] if c < "ɐ" else c
        if not out or out[-1] != base:
            out.append(base)
    return "".join(out)


def _fold() -> list[np.ndarray]:
    """Letters behind disguises in lower case, the class of each (0 none, 1 part of a word), sentence ends."""
    if not _tables:
        lower, kind = char_tables()
        fold, on, ends = lower.copy(), (kind > 0).astype(np.uint8), np.zeros(0x10000, dtype=bool)
        for c in range(0xC0, 0x250):
            base = unicodedata.normalize("NFD", chr(int(lower[c])))[0]
            fold[c] = ord(base)
        for a, b in DISGUISE.items():
            fold[ord(a)], on[ord(a)] = ord(b), 1
        on[ord("*")] = 1
        ends[[ord(c) for c in ".!?…>|•"]] = True
        _tables.extend([fold, on, ends])
    return _tables


def _lexicon() -> list:
    """(exact words with their bit, pattern of stems at the start of a word or, from six letters on, anywhere, plain stems)."""
    if not _stems:
        exact: dict[str, int] = {}
        parts: dict[str, int] = {}
        for k, text in STEMS.items():
            bit = 1 << KINDS.index(k)
            for s in text.split():
                (exact if s[0] == "=" else parts)[_plain(s.lstrip("="))] = bit
        pattern = re.compile("|".join([f"^{s}" for s in parts if len(s) < 6] + sorted((s for s in parts if len(s) >= 6), key=len, reverse=True)))
        _stems.extend([exact, pattern, parts])
    return _stems


def kind_bits(word: str) -> int:
    """Kinds of a folded word; a masked word has those of the stems that it may stand for."""
    exact, pattern, parts = _lexicon()
    if "*" in word:
        inner = word.strip("*")
        if "*" not in inner:
            return kind_bits(inner) if inner else 0
        head, *_, tail = inner.split("*")
        bits = 1 << KINDS.index("masked")
        for s, b in (*parts.items(), *exact.items()):
            if len(s) > 3 and s.startswith(head) and (s.endswith(tail) or len(tail) > 1 and tail in s):
                bits |= b
        return bits & ~(1 << KINDS.index("you"))
    if word in exact:
        return exact[word]
    m = pattern.search(word)
    return parts[m[0]] if m else 0


def _bits_of(h: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Kinds of each word; those of words seen before come from a table that is bounded."""
    u, at, back = np.unique(h, return_index=True, return_inverse=True)
    if len(_known) > 1_000_000:
        _known.clear()
    bits = np.zeros(len(u), np.int64)
    for n, (key, i) in enumerate(zip(u.tolist(), at.tolist())):
        b = _known.get(key)
        if b is None:
            b = _known[key] = kind_bits("".join(map(chr, low[start[i] : end[i]].tolist())))
        bits[n] = b
    return bits[back]


def sentences(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of several texts: (feature hashes, their window), (windows, KINDS) as 0 and 1, document of each window,
    its start and stop. A sentence ends at end marks and blank lines.
    """
    fold, on, ends = _fold()
    a = codes("\n\n".join(texts))
    first = np.cumsum([0] + [len(t) + 2 for t in texts])[:-1]
    low, kind = fold[a], on[a]
    # doubled letters count once
    keep = np.ones(len(a), dtype=bool)
    keep[1:] = (low[1:] != low[:-1]) | (kind[1:] == 0)
    # letters pulled apart: from three single ones on, one blank apart
    s1, e1 = word_ranges(kind)
    if len(s1) > 2:
        apart = (e1[:-1] - s1[:-1] == 1) & (e1[1:] - s1[1:] == 1) & (s1[1:] - e1[:-1] == 1) & (a[np.minimum(e1[:-1], len(a) - 1)] == 32)
        run = np.concatenate([[False], apart, [False]])
        many = apart & (run[:-2] | run[2:])
        keep[e1[:-1][many]] = False
    place = np.flatnonzero(keep)
    low, kind = low[keep], kind[keep]
    flags = ends[a]
    nl = a == 10
    flags[1:] |= nl[1:] & nl[:-1]
    cum = np.concatenate([[0], np.cumsum(flags)])
    start, end = word_ranges(kind)
    if not len(start):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, np.zeros((0, len(KINDS))), z, z, z
    s0, e0 = place[start], place[end - 1] + 1
    doc = np.searchsorted(first, s0, side="right") - 1
    brk = np.ones(len(start), dtype=bool)
    brk[1:] = (cum[s0[1:]] > cum[e0[:-1]]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(brk)
    sent = np.cumsum(brk) - 1
    n = np.diff(np.append(at, len(start)))
    half = WINDOW // 2
    wins = np.maximum(-(-(n - WINDOW) // half), 0) + 1  # windows of a sentence
    base = np.cumsum(wins) - wins
    pos = np.arange(len(start)) - at[sent]
    slot = np.minimum(pos // half, wins[sent] - 1)
    owner = base[sent] + slot  # the later window of a word; the one before has it, too, where it reaches so far
    also = (slot > 0) & (pos < (slot - 1) * half + WINDOW)
    total = int(wins.sum())
    wsent = np.repeat(np.arange(len(at)), wins)
    k = np.arange(total) - base[wsent]
    w0 = at[wsent] + k * half
    w1 = np.minimum(w0 + WINDOW, at[wsent] + n[wsent])
    h = word_hashes(low, start, end)
    bits = _bits_of(h, low, start, end)
    kinds = np.zeros((total, len(KINDS)))
    hits = np.zeros(total)
    you = KINDS.index("you")
    some = np.flatnonzero(bits)
    # a stem that returns in a window counts once
    ow, wb, wh = np.concatenate([owner[some], owner[some][also[some]] - 1]), np.concatenate([bits[some], bits[some][also[some]]]), np.concatenate([h[some], h[some][also[some]]])
    for b in range(you + 1):
        kinds[ow[(wb >> b) & 1 == 1], b] = 1
    strong = (wb & ~(1 << you)) > 0
    if strong.any():
        by = np.lexsort((wh[strong], ow[strong]))
        o, x = ow[strong][by], wh[strong][by]
        fresh = np.append(True, (o[1:] != o[:-1]) | (x[1:] != x[:-1]))
        hits += np.bincount(o[fresh], minlength=total)
    kinds[:, you] *= hits > 0
    kinds[:, you + 1], kinds[:, you + 2] = hits >= 2, hits >= 3
    with np.errstate(over="ignore"):
        pair = mix(h[:-1] * MIX + h[1:] + np.uint64(7))
    same = sent[1:] == sent[:-1]
    # a pair lies in the windows that hold both of its words
    p_owner, p_also = owner[:-1], also[:-1] & also[1:] & (owner[1:] == owner[:-1])
    cross = same & (owner[1:] != owner[:-1])
    p_first = np.where(cross, owner[1:] - 1, p_owner)
    f = np.concatenate([h, h[also], pair[same], pair[same & p_also]])
    o = np.concatenate([owner, owner[also] - 1, p_first[same], p_owner[same & p_also] - 1])
    d = doc[w0]
    return f, o, kinds, d, s0[w0] - first[d], e0[w1 - 1] - first[d]


def train(rows: list[tuple[int, str]], rounds: int = 300, rate: float = 0.5, penalty: float = 0.01) -> Model:
    """Weights from (0/1, text) bags.

    Features are the kinds of stems, words and pairs found mostly in positive bags, and those that stand beside them,
    which tells mere reports from abuse. The weights of the kinds are drawn to PRIOR, the others to 0; a label set
    without positive bags gives PRIOR. Some labels are wrong: the share of positive bags without a reason is estimated.
    """
    rows = [(y, t) for y, t in rows if t]
    y = np.array([r[0] for r in rows], dtype=np.float64)
    texts = [t for _, t in rows]
    none = Model(np.zeros(0, np.uint64), np.zeros(0), PRIOR.copy(), BIAS)
    if not rows or not y.any():
        return none

    def parts():
        for lo, hi in groups_by_size(texts, 500_000):
            f, o, k, d, _, _ = sentences(texts[lo:hi])
            yield f, o, k, d + lo

    # features that some positive bag has; the bags with each of them; group by group, so that memory stays small
    cand = np.zeros(0, np.uint64)
    for f, o, _, d in parts():
        if len(f):
            cand = np.union1d(cand, f[y[d[o]] > 0])
    if not len(cand):
        return none
    dfp, dfn = np.zeros(len(cand)), np.zeros(len(cand))

    def place(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(cand, f)
        at[at == len(cand)] = 0
        hit = cand[at] == f
        return at[hit], hit

    for f, o, _, d in parts():
        fi, hit = place(f)
        bag = np.unique(fi.astype(np.int64) * len(y) + d[o[hit]])
        bf, by = bag // len(y), y[bag % len(y)]
        dfp += np.bincount(bf, weights=by, minlength=len(cand))
        dfn += np.bincount(bf, weights=1 - by, minlength=len(cand))
    P, N = y.sum(), len(y) - y.sum()
    # likelihood ratio of a feature's bags against the share of positive bags; chance alone seldom gives SURE
    share = min(P / (P + N), 1 - 1e-9)
    with np.errstate(divide="ignore", invalid="ignore"):
        n = dfp + dfn
        ratio = 2 * (np.where(dfp > 0, dfp * np.log(dfp / (n * share)), 0) + np.where(dfn > 0, dfn * np.log(dfn / (n * (1 - share))), 0))
    seeds = (dfp > 2 * n * share) & (dfp >= 0.3 * n) & (ratio >= SURE)
    # windows with a stem of some kind or a seed, with all candidate features in them
    got: list[list] = [[], [], [], []]
    total = 0
    for f, o, k, d in parts():
        fi, hit = place(f)
        pairs = np.unique(o[hit].astype(np.int64) * len(cand) + fi)
        oi, fi = pairs // len(cand), pairs % len(cand)
        marked = np.flatnonzero(np.bincount(oi, weights=seeds[fi], minlength=len(d)) + k[:, : KINDS.index("you")].sum(axis=1))
        index = np.full(len(d), -1)
        index[marked] = np.arange(len(marked)) + total
        use = index[oi] >= 0
        for to, x in zip(got, (fi[use], index[oi[use]], k[marked], d[marked])):
            to.append(x)
        total += len(marked)
    fi, oi, kinds, sdoc = map(np.concatenate, got)
    if not total:
        return none
    beside = np.bincount(fi, minlength=len(cand)) >= 3
    chosen = np.flatnonzero(seeds | beside)
    other = (~seeds & ((ratio < LIKELY) | (dfp < 2 * n * share) | (dfp < 0.9 * n)))[chosen]
    index = np.full(len(cand), -1)
    index[chosen] = np.arange(len(chosen))
    use = index[fi] >= 0
    fi, oi = index[fi[use]], oi[use]
    w, u = np.zeros(len(chosen)), PRIOR.copy()
    both = np.concatenate([w, u])
    m, v = np.zeros_like(both), np.zeros_like(both)
    floor, wrong = 0.02, 0.03  # shares of bags labelled positive, and negative, without reason; the former is estimated
    for t in range(1, rounds + 1):
        z = np.bincount(oi, weights=w[fi], minlength=total) + kinds @ u + BIAS
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        log_none = np.bincount(sdoc, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y))
        real = 1 - np.exp(log_none)
        pd = floor + (1 - floor - wrong) * real
        if t % 20 == 0:  # positive labels that no sentence explains
            blame = y * floor * (1 - real) / np.maximum(pd, 1e-9)
            floor = float(np.clip(blame.sum() / max(1.0, (1 - real).sum()), 0.005, 0.2))
        # d log-likelihood / d z of a window: (y - pd) / (pd (1 - pd)) times d pd / d z
        g = p * ((y - pd) / np.maximum(pd * (1 - pd), 1e-6) * (1 - floor - wrong) * np.exp(log_none))[sdoc]
        grad = np.concatenate([np.bincount(fi, weights=g[oi], minlength=len(w)) / P - penalty * w, g @ kinds / P - 2 * penalty * (u - PRIOR)])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        both = both + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-3) * min(1.0, 30 / t) * 0.3
        both[: len(w)][other] = np.minimum(both[: len(w)][other], 0)
        both[len(w) :] = np.maximum(both[len(w) :], 0)
        w, u = both[: len(w)], both[len(w) :]
    order = np.argsort(cand[chosen])
    return Model(cand[chosen][order], w[order], u, BIAS)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 6000) -> Model:
    """Fit on a sample of labelled documents: at most about per_label of each label, of at most BAG_CHARS characters each
    and SAMPLE_CHARS together, which bounds what reaches the driver.

    A document's label is the majority of its raters' non-null labels; ties are left out.
    """
    bag = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.avg("toxic").alias("m")).where(F.col("m") != 0.5).select("doc_id", (F.col("m") > 0.5).cast("int").alias("y"))
    own = docs.where(has_text() & (F.length("text") <= BAG_CHARS)).select("doc_id", "text").join(bag, "doc_id")
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rule = F.lit(False)
    for label, n, size in own.groupBy("y").agg(F.count("*"), F.sum(F.length("text"))).collect():
        rule |= (F.col("y") == label) & (h < int(min(1.0, per_label / n, SAMPLE_CHARS / size) * (1 << 30)))
    rows = own.where(rule).select("doc_id", "y", F.regexp_replace("text", DIVIDED, "").alias("text")).collect()
    return train([(r[1], r[2]) for r in sorted(rows, key=lambda r: (r[0], r[2]))])


def score_texts(texts: list[str], m: Model) -> list[tuple[float, list[tuple[int, int, float]]]]:
    """(document score, offending sentences) of each text that is not empty; sentences as (start, stop, score).

    Windows of one sentence that overlap and offend give one range.
    """
    out: list = [(0.0, []) for _ in texts]
    features = m.features if len(m.features) else np.zeros(1, np.uint64)
    weights = m.weights if len(m.features) else np.zeros(1)
    for lo, hi in groups_by_size(texts, 1_000_000):
        f, o, kinds, d, s, e = sentences(texts[lo:hi])
        if not len(d):
            continue
        at = np.searchsorted(features, f)
        at[at == len(features)] = 0
        hit = features[at] == f
        pairs = np.unique(o[hit].astype(np.int64) * len(features) + at[hit])
        oi, fi = pairs // len(features), pairs % len(features)
        z = np.bincount(oi, weights=weights[fi], minlength=len(d)) + kinds @ m.kinds + m.bias
        some = np.flatnonzero((np.bincount(oi, weights=weights[fi] > 0, minlength=len(d)) > 0) | (kinds.sum(axis=1) > 0))
        p = 1 / (1 + np.exp(-np.clip(z[some], -30, 30)))
        none = np.exp(np.bincount(d[some], weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=hi - lo))
        for i in range(lo, hi):
            out[i] = (float(1 - none[i - lo]), [])
        for k in np.flatnonzero(p >= LEAST_SCORE):
            i = some[k]
            spans = out[lo + d[i]][1]
            if spans and s[i] < spans[-1][1]:
                spans[-1] = (spans[-1][0], max(int(e[i]), spans[-1][1]), max(float(p[k]), spans[-1][2]))
            else:
                spans.append((int(s[i]), int(e[i]), float(p[k])))
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, source, score, sentences): null and empty texts score null and have no sentences; repeated rows stay.

    Sentence offsets count the code points of the text after words divided over line ends are joined.
    """
    shared = broadcast_value(docs.sparkSession, {"f": model.features, "w": model.weights, "k": model.kinds})
    bias = model.bias

    def run(cols):
        m = Model(shared.value["f"], shared.value["w"], shared.value["k"], bias)
        ids, sources, texts = cols["doc_id"].to_pylist(), cols["source"].to_pylist(), cols["text"].to_pylist()
        live = [i for i, t in enumerate(texts) if t]
        got = score_texts([texts[i] for i in live], m) if live else []
        res: list = [(None, [])] * len(ids)
        for i, g in zip(live, got):
            res[i] = g
        yield {"doc_id": ids, "source": sources, "score": [r[0] for r in res], "sentences": [[{"start": a, "stop": b, "score": c} for a, b, c in r[1]] for r in res]}

    return map_columns(spread(docs.select("doc_id", "source", F.regexp_replace("text", DIVIDED, "").alias("text"))), run, "doc_id bigint, source string, score double, sentences array<struct<start:int,stop:int,score:double>>")


def found(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id) of documents with an offending sentence."""
    return score(docs, fit(docs, labels)).where(F.size("sentences") > 0).select("doc_id")


def rates(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(source, documents, offending, rate): texts only; a null source is one of its own."""
    s = score(docs, fit(docs, labels)).where(F.col("score").isNotNull())
    bad = F.sum((F.size("sentences") > 0).cast("bigint"))
    return s.groupBy("source").agg(F.count("*").alias("documents"), bad.alias("offending"), F.round(bad / F.count("*"), 6).alias("rate"))
