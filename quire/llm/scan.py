"""Problem 5: noise in text from scanned pages, and its repair into continuous paragraphs.

Method: running lines and page numbers at page edges are found first, over all pages of a text, and leave the stream.
What remains is de-lined and decoded: a lattice over the tokens of every suspicious stretch, whose edges keep a word,
join pieces divided by a hyphen, a blank or a line end, part two words run together, or undo character confusions, is
solved for the least cost under the corpus' own word frequencies. Paragraph boundaries are chosen by dynamic programming
over the lines. Word counts come from all documents; the lexicon holds the words of at least a given relative frequency,
which bounds its size.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from difflib import SequenceMatcher

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.text import broadcast_value, has_text, map_columns, spread
from quire.session import written

LEAST_FREQUENCY = 2e-6  # of a word of the lexicon: at most 500,000 words
KINDS = ("broken_word", "misread", "running_header", "page_number")
# Fixed values: (as read, as printed) pairs that character recognition commonly confuses
CONFUSIONS = (
    ("c", "e"), ("@", "a"), ("l", "i"), ("f", "t"), ("0", "o"), ("ri", "n"), ("5", "s"), ("1", "l"), ("ii", "u"), ("cl", "d"), ("rn", "m"), ("q", "g"), ("b", "h"), ("6", "é"),
    ("vv", "w"), ("1", "i"), ("9", "g"), ("8", "b"), ("3", "e"), ("$", "s"), ("0", "о"), ("c", "е"), ("r", "т"), ("н", "и"), ("8", "в"), ("п", "л"), ("ьі", "ы"), ("6", "б"), ("3", "з"),
)
LOST = "■¦~^\\�"  # marks that stand for a letter that was not recognised
MARKS = "-‐­¬"
PAGE_WORDS = "page pages pagina página seite blatt blad bladzijde pag pg стр страница folio of von de di van из sur"
_TAG = re.compile(r"</?docling_[a-z_]+>")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(rf"[^\s.,;:!?()\[\]|\"'’“”«»„‘<>/—–•*#+=…&%€£‐­¬\-]+")
_BREAK = re.compile(rf"([^\W\d_]+)([{MARKS}])[ \t]*\n\s*([^\W\d_]+)")
_MARKED = re.compile(rf"[{MARKS}][ \t]*\n")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_] ){3,}[^\W\d_](?!\S)")
_BLANK = re.compile(r"\n[ \t]*\n")
_NUMBER = re.compile(r"\d{1,4}")
_ROMAN = re.compile(r"^[ivxlc]{1,7}$")
_ITEM = re.compile(r"^\s*(?:[-*•–—>#|]|\d{1,3}[.)]\s)")
_ALONE = re.compile(r"^\W*\d{1,4}\W*$")
_ENDS = tuple(".!?:;…")
GAP = "\n"  # between tokens of a stream that are parted by more than white space
_ALPHABET = "abcdefghijklmnopqrstuvwxyzäöüßàâçéèêëîïôûùœáíóúñãõìòабвгдежзийклмнопрстуфхцчшщъыьэюя"
_ROMAN_VALUE = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}


def lexicon(docs: DataFrame, least: float = LEAST_FREQUENCY) -> tuple[dict[str, int], int]:
    """Counts of the words that make at least the share `least` of all words, and the number of all words."""

    def run(cols):
        chunks: Counter = Counter()
        for t in cols["text"].to_pylist():
            chunks.update(t.lower().split())
        got: Counter = Counter()
        for c, n in chunks.items():
            if c.isalpha():
                got[c] += n
            else:
                for w in _WORD.findall(c):
                    got[w] += n
        yield {"word": list(got), "n": list(got.values())}

    counts = written(map_columns(spread(docs.where(has_text()).select("text")), run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") >= max(3, math.ceil(least * total))).collect()
    return {r[0]: r[1] for r in rows}, total


class Decoder:
    """Least-cost reading of token stretches under word frequencies."""

    def __init__(self, words: dict[str, int], total: int):
        self.words, self.total = words, max(total, 1)
        self.common = max(20, self.total * 1e-5)
        self.seen: dict[str, str | None] = {}
        self.chunks: dict[str, tuple[str, ...]] = {}
        self.odd: dict[str, bool] = {}
        self.parts: dict[str, tuple[float, list[str], bool] | None] = {}
        self.begins = {w[:k] for w in words for k in range(2, len(w) + 1)}  # what words begin with, and the words

    def cost(self, word: str) -> float:
        """Bits of a word; an unknown word pays as a very rare one, the more the longer."""
        n = self.words.get(word, 0)
        return -math.log2(n / self.total) if n else math.log2(self.total) + 7 + 0.5 * len(word)

    def corrected(self, token: str) -> str | None:
        """The word that a token misreads, or None: within two confusions or lost letters, and ten times as frequent."""
        if token not in self.seen:
            if len(self.seen) > 300_000:
                self.seen.clear()
            self.seen[token] = self._corrected(token)
        return self.seen[token]

    def _corrected(self, token: str) -> str | None:
        n = self.words.get(token, 0)
        if n >= self.common or not 3 <= len(token) <= 60:
            return None
        digits = sum(c.isdigit() for c in token)
        letters = sum(c.isalpha() for c in token)
        lost = sum(c in LOST for c in token)
        if letters < 2 or digits > 2 or lost > 2 or digits + lost > letters:
            return None
        # letters that all may be meant need more evidence than marks and digits inside a word, the more the shorter the word
        least = max((10 if digits or lost or not token.isalpha() else 30 if len(token) >= 6 else 100 if len(token) == 5 else 400) * max(n, 1), 5)
        level = {token}
        for depth in range(2):
            nxt: dict[str, int] = {}
            for w in level:
                at = next((i for i, c in enumerate(w) if c in LOST), -1)
                if at >= 0:  # a lost letter may be any
                    for c in _ALPHABET:
                        nxt[w[:at] + c + w[at + 1 :]] = 1
                    continue
                for read, printed in CONFUSIONS:
                    i = w.find(read)
                    while i >= 0:
                        nxt[w[:i] + printed + w[i + len(read) :]] = 1
                        i = w.find(read, i + 1)
            best = max(((self.words.get(w, 0), w) for w in nxt), default=(0, ""))
            if best[0] >= least and len(best[1]) >= 3:
                return best[1]
            if depth == 0 and (digits or lost or len(token) >= 6):
                level = set(nxt)
            else:
                break
        return None

    def misread(self, token: str) -> bool:
        """Whether a lower-case token is a misread word; a word in a disguise of two signs is none."""
        return self.words.get(token, 0) < self.common and self.corrected(token) is not None and sum(c in "@$0134" for c in token) < 2

    def stream(self, text: str) -> list[str]:
        """Tokens of a lower-case text in the order of reading, with GAP where two are parted by more than white space."""
        out: list[str] = []
        for chunk in text.split():
            got = self.chunks.get(chunk)
            if got is None:
                if len(self.chunks) > 300_000:
                    self.chunks.clear()
                got = self.chunks[chunk] = tuple(_tokens(chunk))
            out += got
        return out

    def divided(self, left: str, mark: str, right: str) -> bool:
        """Whether the mark at a line end divides one word, by the costs of the joint and of the parted reading."""
        if mark != "-":
            return True
        joint = left + right
        if joint not in self.words and (fixed := self.corrected(joint)):
            joint = fixed
        return self.cost(joint) < self.cost(left) + self.cost(right) + 4

    def parted(self, token: str) -> tuple[float, list[str], bool] | None:
        """(cost, words, whether one is misread) of the cheapest two words that a token may run together, or None."""
        if token not in self.parts:
            if len(self.parts) > 300_000:
                self.parts.clear()
            self.parts[token] = self._parted(token)
        return self.parts[token]

    def _parted(self, token: str) -> tuple[float, list[str], bool] | None:
        if not 6 <= len(token) <= 40:
            return None
        known = token in self.words
        got: list[tuple[float, list[str], bool]] = []
        for k in range(2, len(token) - 1):
            left, right = token[:k], token[k:]
            if left in self.words and right in self.words:
                got.append((self.cost(left) + self.cost(right) + 8, [left, right], False))
            elif known:
                continue
            elif self.words.get(left, 0) >= self.common and (fixed := self.corrected(right)):  # run together and misread at once
                got.append((self.cost(left) + self.cost(fixed) + 14, [left, fixed], True))
            elif self.words.get(right, 0) >= self.common and (fixed := self.corrected(left)):
                got.append((self.cost(fixed) + self.cost(right) + 14, [fixed, right], True))
        best = min(got, default=None)
        return best if best and best[0] < self.cost(token) else None

    def suspicious(self, token: str) -> bool:
        """Whether a token is no known word, a rare one that a frequent word explains, or one that parts into two cheaper ones."""
        got = self.odd.get(token)
        if got is None:
            if len(self.odd) > 300_000:
                self.odd.clear()
            n = self.words.get(token, 0)
            got = self.odd[token] = n < self.common and (self.corrected(token) is not None or not n and len(token) > 1 and any(map(str.isalpha, token)) and not any(map(str.isdigit, token))) or self.parted(token) is not None
        return got

    def joinable(self, pieces: list[str], joint: str) -> bool:
        """Whether pieces may be one word: beside a common word, it has to be ten times as frequent as its rarest piece."""
        if len(joint) < 3:
            return False
        counts = [self.words.get(p, 0) for p in pieces]
        return max(counts) < self.common or all(len(p) == 1 for p in pieces) or self.words.get(joint, 0) >= 10 * min(counts)

    def joins(self, tokens: list[str], i: int) -> int:
        """Behind the last of the tokens from i on that join to a word cheaper than they are, or 0."""
        joint, apart, end = tokens[i], self.cost(tokens[i]), 0
        for j in range(i + 1, min(len(tokens), i + 12)):
            joint += tokens[j]
            if joint not in self.begins:
                break
            apart += self.cost(tokens[j])
            if joint in self.words and self.cost(joint) + 5 < apart and self.joinable(tokens[i : j + 1], joint):
                end = j + 1
        return end

    def stretches(self, tokens: list[str]) -> list[tuple[int, int]]:
        """Stretches (start, stop) of a stream outside which every token is kept: of suspicious tokens with their neighbours, and of joins."""
        begins, odd = self.begins, self.suspicious
        spans: list[tuple[int, int]] = []
        for i, t in enumerate(tokens):
            if t != GAP and odd(t):
                spans.append((i - 1 if i and tokens[i - 1] != GAP else i, i + 2 if i + 1 < len(tokens) and tokens[i + 1] != GAP else i + 1))
        for i, (a, b) in enumerate(zip(tokens, tokens[1:])):
            if a + b in begins and (end := self.joins(tokens, i)):
                spans.append((i, end))
        out: list[tuple[int, int]] = []
        for lo, hi in sorted(spans):
            if out and lo < out[-1][1]:
                out[-1] = out[-1][0], max(hi, out[-1][1])
            else:
                out.append((lo, hi))
        return out

    def edges(self, tokens: list[str]) -> list[tuple[int, int, list[str], bool]]:
        """Edges (start, stop, words, whether misread) of the least cost over a stretch of lower-case tokens.

        Each keeps, corrects, joins up to twelve tokens, or parts one; joined and parted words may be misread besides.
        """
        n = len(tokens)
        best = [0.0] + [math.inf] * n
        back: list[tuple[int, list[str], bool]] = [(0, [], False)] * (n + 1)

        def edge(i: int, j: int, words: list[str], cost: float, misread: bool = False) -> None:
            if best[i] + cost < best[j]:
                best[j], back[j] = best[i] + cost, (i, words, misread)

        for i in range(n):
            t = tokens[i]
            edge(i, i + 1, [t], self.cost(t), self.misread(t))
            if (fixed := self.corrected(t)) is not None:
                edge(i, i + 1, [fixed], self.cost(fixed) + 6, self.misread(t))
            if parts := self.parted(t):
                edge(i, i + 1, parts[1], parts[0], parts[2] and sum(c in "@$0134" for c in t) < 2)
            joint = t
            # letters are pulled apart where a piece is no common word of its own, or all are single letters
            rare, single = self.words.get(t, 0) < self.common, len(t) == 1
            for j in range(i + 1, min(n, i + 12)):
                joint += tokens[j]
                rare |= self.words.get(tokens[j], 0) < self.common
                single &= len(tokens[j]) == 1
                word = joint if joint in self.words and self.joinable(tokens[i : j + 1], joint) else None
                if word is None and j == i + 1 and joint not in self.words and max(self.words.get(t, 0), self.words.get(tokens[j], 0)) < self.common and not (t in self.words and tokens[j] in self.words):
                    word = self.corrected(joint)  # divided and misread at once
                if word:
                    edge(i, j + 1, [word], self.cost(word) + 5, rare or single)
        out: list[tuple[int, int, list[str], bool]] = []
        j = n
        while j:
            i, words, misread = back[j]
            out.append((i, j, words, misread))
            j = i
        return out[::-1]

    def decode(self, tokens: list[str]) -> list[str]:
        """Words of the least-cost reading of a stretch of lower-case tokens."""
        return [w for _, _, words, _ in self.edges(tokens) for w in words]


def _tokens(chunk: str) -> list[str]:
    out, at = [], 0
    for m in _TOKEN.finditer(chunk):
        if m.start() > at:
            out.append(GAP)
        out.append(m[0])
        at = m.end()
    return out + [GAP] * (at < len(chunk))


def _number_values(line: str) -> list[int]:
    """Numbers that a page-edge line may carry as the page's: at its start or end, or among page words."""
    plain = line.lower()
    words = _WORD.findall(plain)
    got = [int(x) for x in _NUMBER.findall(plain)]
    if not got and not words:
        return []
    few = len(words) <= 1 or all(w in _PAGE for w in words)
    if not few:
        ends = []
        if m := re.match(r"\W*(\d{1,4})\b(?![.,]\d)", plain):
            ends.append(int(m[1]))
        if m := re.search(r"(?<![\d.,])(\d{1,4})\W*$", plain):
            ends.append(int(m[1]))
        got = ends
    for w in {words[0], words[-1]} if words else ():
        if _ROMAN.match(w) and (len(words) == 1 or len(words) <= 8):
            v = [_ROMAN_VALUE[c] for c in w]
            got.append(sum(-a if a < b else a for a, b in zip(v, v[1:] + [0])))
    return got


_PAGE = frozenset(PAGE_WORDS.split()) | {"p", "s"}


def _title(line: str) -> str:
    """Letters of a page-edge line that may be a title, in lower case; empty where it is none."""
    s = line.strip()
    if not 3 <= len(s) <= 90 or _ITEM.match(s) and not re.match(r"^[-—–*\s]*\d", s):
        return ""
    if s.startswith("|") or ". " in s.rstrip("0123456789 ") and len(s) > 40:
        return ""
    words = [w for w in _WORD.findall(s.lower()) if w not in _PAGE]
    if words and _ROMAN.match(words[0]):
        words = words[1:]
    if words and _ROMAN.match(words[-1]):
        words = words[:-1]
    t = "".join(words)
    return t if len(t) >= 4 and not (s[-1] in ".,;!?" and len(words) > 4) else ""


def _alike(a: str, b: str) -> bool:
    if a == b:
        return True
    if abs(len(a) - len(b)) > 0.25 * max(len(a), len(b)):
        return False
    m = SequenceMatcher(None, a, b, autojunk=False)
    return m.real_quick_ratio() >= 0.8 and m.quick_ratio() >= 0.8 and m.ratio() >= 0.8


def pages_of(text: str, ends: list[int] | None) -> list[list[tuple[int, int]]]:
    """Lines (start, stop) with text, by page; one page where the ends are unknown. Ends out of order or range are cut."""
    cuts = sorted({min(max(0, e), len(text)) for e in ends or [] if e is not None})
    if not cuts or cuts[-1] < len(text):
        cuts.append(len(text))
    lines, at = [], 0
    for x in text.split("\n"):
        lines.append((at, at + len(x)))
        at += len(x) + 1
    out, k = [[] for _ in cuts], 0
    for a, b in lines:
        while k < len(cuts) - 1 and a >= cuts[k]:
            k += 1
        while k < len(cuts) - 1 and b > cuts[k]:  # a page may end inside a line
            if text[a : cuts[k]].strip():
                out[k].append((a, cuts[k]))
            a, k = cuts[k], k + 1
        if text[a:b].strip():
            out[k].append((a, b))
    return out


def edge_lines(text: str, ends: list[int] | None) -> tuple[set[tuple[int, int]], bool, bool]:
    """Running lines to remove, whether there is a running header, whether pages carry their number.

    Texts without known pages have their short lines taken in order instead: numbers that count up, titles that return.
    """
    if ends and len(ends) < 3:
        return set(), False, False
    pages = pages_of(text, ends)
    known = len(pages) > 1
    edge: list[tuple[int, str, tuple[int, int]]] = []  # page, position, line
    if known:
        for p, lines in enumerate(pages):
            top, bottom = lines[:2], lines[2:][-2:]
            edge += [(p, "t", x) for x in top] + [(p, "b", x) for x in bottom]
            if len(lines) <= 2:
                edge += [(p, "b", x) for x in lines]
    elif len(pages[0]) > 6:
        short = [x for x in pages[0] if x[1] - x[0] <= 60]
        p = 0
        for x in short:
            s = _TAG.sub("", text[x[0] : x[1]])
            if (_title(s) or _NUMBER.search(s)) and (_ALONE.match(s) or not _ITEM.match(s)):
                edge.append((p, "t", x))
                p += 1
    if known and len(pages) < 3 or not edge:
        return set(), False, False
    drop: set[tuple[int, int]] = set()
    votes: dict[int, dict[int, tuple[int, int]]] = {}
    clusters: list[tuple[str, dict[int, tuple[int, int]], dict[str, int]]] = []
    near: dict[tuple, list[int]] = {}
    for p, where, x in edge:
        s = _TAG.sub("", text[x[0] : x[1]])
        if known:
            for v in _number_values(s):
                votes.setdefault(v - p, {}).setdefault(p, x)
        if t := _title(s):
            # a slightly changed title keeps its beginning, its end or its middle
            keys = [(where, 0, t[:4]), (where, 1, t[-4:]), (where, 2, t[len(t) // 2 - 2 : len(t) // 2 + 2])]
            for at in dict.fromkeys(k for key in keys for k in near.get(key, ())):
                rep, lines, equal = clusters[at]
                if rep == t or known and _alike(rep, t):
                    if known or x[0] - max(lines.values())[0] > 300:
                        lines.setdefault(p, x)
                    equal[t] = equal.get(t, 0) + 1
                    break
            else:
                for key in keys:
                    near.setdefault(key, []).append(len(clusters))
                clusters.append((t, {p: x}, {t: 1}))
    least = max(3, 0.2 * len(pages)) if known else 3
    header = False
    for rep, at, equal in clusters:
        # lines of running text may be alike by chance; a title stays the same at least twice, or nearly so throughout
        same = max(equal.values()) >= 2 or all(SequenceMatcher(None, rep, t, autojunk=False).ratio() >= 0.9 for t in equal)
        if len(at) >= least and same:
            header = True
            drop.update(at.values())
    number = False
    if known:
        for at in votes.values():
            if len(at) >= 3:
                number = True
                drop.update(x for x in at.values() if _TAG.search(text[x[0] : x[1]]) or not _title(text[x[0] : x[1]]) and len(text[x[0] : x[1]]) <= 40)
    else:
        seen = [(x, v[0]) for _, _, x in edge if (v := _number_values(_TAG.sub("", text[x[0] : x[1]]))) and (_ALONE.match(text[x[0] : x[1]]) or not _ITEM.match(text[x[0] : x[1]]))]
        best: dict[int, tuple[int, list]] = {}
        for x, v in seen:
            k = best.get(v - 1, (0, []))
            if k[0] + 1 > best.get(v, (0, []))[0]:
                best[v] = (k[0] + 1, [*k[1], x])
        if best:
            n, xs = max(best.values(), key=lambda z: z[0])
            if n >= 3:
                number = True
                drop.update(xs)
    return drop, header, number


def without(text: str, drop: set[tuple[int, int]]) -> str:
    """The text without the given lines."""
    if not drop:
        return text
    out, at = [], 0
    for a, b in sorted(drop):
        out.append(text[at:a])
        at = min(b + 1, len(text)) if a == 0 or text[a - 1] == "\n" else b
        at = max(at, a)
    out.append(text[at:])
    return "".join(out)


def noise(text: str, ends: list[int] | None, d: Decoder) -> tuple[list[str], int, int]:
    """Kinds of noise of a text, the number of divided words, the number of misread words."""
    drop, header, number = edge_lines(text, ends)
    body = without(text, drop)
    broken = sum(d.divided(a.lower(), m, b.lower()) for a, m, b in _BREAK.findall(body)) if _MARKED.search(body) else 0
    joined = _BREAK.sub(lambda m: m[1] + m[3] if d.divided(m[1].lower(), m[2], m[3].lower()) else m[0], body) if broken else body
    misread = 0
    if _SPACED.search(joined):
        lines = joined.split("\n")
        for i, line in enumerate(lines):
            if not line.startswith("|"):
                lines[i], n = _SPACED.subn(lambda m: m[0].replace(" ", ""), line)
                misread += n
        joined = "\n".join(lines)
    stream = d.stream(_BLANK.sub("\n|\n", joined.lower()))
    for lo, hi in d.stretches(stream):
        misread += sum(e[3] for e in d.edges(stream[lo:hi]))
    kinds = [k for k, on in zip(KINDS, (broken >= 2, misread >= 3, header, number)) if on]
    return kinds, broken, misread


def repaired(text: str, ends: list[int] | None, d: Decoder) -> str:
    """Continuous paragraphs: running lines gone, words joined and corrected, paragraphs parted by one blank line.

    Tables and list items keep their lines; the case of a corrected word follows the word as read.
    """
    drop, _, _ = edge_lines(text, ends)
    body = _TAG.sub("", without(text, drop))
    body = _BREAK.sub(lambda m: m[1] + m[3] if d.divided(m[1].lower(), m[2], m[3].lower()) else m[1] + m[2] + m[3], body)
    return "\n\n".join(_decoded(p, d) for p in paragraphs(body.split("\n")))


def paragraphs(lines: list[str]) -> list[str]:
    """Paragraph boundaries by dynamic programming: each line opens a paragraph or goes on; costs of the line ends decide."""
    lines = [x.rstrip() for x in lines]
    lengths = sorted(len(x) for x in lines if x)
    if not lengths:
        return []
    width = lengths[int(0.8 * (len(lengths) - 1))]
    best, back = (0.0, math.inf), []  # open, continue
    prev = ""
    for i, x in enumerate(lines):
        blank = not lines[i - 1] if i else True
        fixed = bool(_ITEM.match(x)) or bool(_ITEM.match(prev))
        full = len(prev) >= 0.75 * width
        ended = prev.endswith(_ENDS)
        lower = x[:1].islower()
        go = (6.0 if fixed else 0.0) + (3.0 if blank and (ended or not lower) else 0.0) + (2.0 if ended and not full else 0.0) + (1.5 if not full else 0.0)
        new = (3.0 if lower else 0.0) + (2.0 if not ended and full else 0.0) + (0.0 if blank or fixed else 1.5)
        if not i:
            go = math.inf
        low = min(best)
        back.append((best[0] <= best[1], best[0] <= best[1]))
        best = (low + new, low + go)
        if x:
            prev = x
    state, states = best[1] < best[0], []
    for i in range(len(lines) - 1, -1, -1):
        states.append(state)
        state = not back[i][int(state)]
    states.reverse()
    out: list[str] = []
    for x, goes in zip(lines, states):
        if not x:
            continue
        if goes and out:
            out[-1] += ("\n" if _ITEM.match(x) and _ITEM.match(out[-1]) else " ") + x.strip()
        else:
            out.append(x.strip())
    return out


def _decoded(par: str, d: Decoder) -> str:
    if par.startswith("|"):
        return par
    par = _SPACED.sub(lambda m: m[0].replace(" ", ""), par)

    toks = list(_TOKEN.finditer(par))
    stream: list[str] = []
    place: list[int] = []  # of each token of the stream among the tokens; -1 for a gap
    for k, t in enumerate(toks):
        if k and par[toks[k - 1].end() : t.start()] != " ":
            stream.append(GAP)
            place.append(-1)
        stream.append(t[0].lower())
        place.append(k)
    out, at = [], 0
    for lo, hi in d.stretches(stream):
        for i, j, words, _ in d.edges(stream[lo:hi]):
            if words != stream[lo + i : lo + j]:
                a, b = place[lo + i], place[lo + j - 1]
                out += [par[at : toks[a].start()], " ".join(_cased(words, [t[0] for t in toks[a : b + 1]]))]
                at = toks[b].end()
    return "".join(out) + par[at:]


def _cased(words: list[str], read: list[str]) -> list[str]:
    """Words in the case of the tokens that they were read from, first letters by first letters."""
    shout = all(t.isupper() for t in read) and len("".join(read)) > 1
    out, k, taken, given, fresh = [], 0, 0, 0, True
    for w in words:
        if k < len(read) and read[k].lower() == w:
            out.append(read[k])
        else:
            out.append(w.upper() if shout else w[:1].upper() + w[1:] if fresh and k < len(read) and read[k][:1].isupper() else w)
        given += len(w)
        fresh = False
        while k < len(read) and taken + len(read[k]) <= given + 1:
            taken += len(read[k])
            k += 1
            fresh = True
    return out


_decoders: dict = {}


def _decoder(shared) -> Decoder:
    key = shared.value["total"], len(shared.value["words"])
    if key not in _decoders:
        _decoders.clear()
        _decoders[key] = Decoder(shared.value["words"], shared.value["total"])
    return _decoders[key]


def examine(docs: DataFrame, least: float = LEAST_FREQUENCY, with_text: bool = False) -> DataFrame:
    """(doc_id, noise array, divided, misread [, repaired]) of each text that is not null or empty; repeated rows stay."""
    words, total = lexicon(docs, least)
    shared = broadcast_value(docs.sparkSession, {"words": words, "total": total})

    def run(cols):
        d = _decoder(shared)
        ids, texts, ends = cols["doc_id"].to_pylist(), cols["text"].to_pylist(), cols["page_ends"].to_pylist()
        got = [noise(t, e, d) for t, e in zip(texts, ends)]
        out = {"doc_id": ids, "noise": [g[0] for g in got], "divided": [g[1] for g in got], "misread": [g[2] for g in got]}
        if with_text:
            out["repaired"] = [repaired(t, e, d) for t, e in zip(texts, ends)]
        yield out

    schema = "doc_id bigint, noise array<string>, divided int, misread int" + ", repaired string" * with_text
    return map_columns(spread(docs.where(has_text()).select("doc_id", "text", "page_ends")), run, schema)


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, noise): one row for each kind of noise that a document has."""
    return examine(docs).select("doc_id", F.explode("noise").alias("noise"))
