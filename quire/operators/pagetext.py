"""Page-text rules that no built-in expresses: each runs over Arrow batches in one pass over a text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import fixed

_TABLE = re.compile(r"(?s)<docling_table>(.*?)</docling_table>")
_NOTE = re.compile(r"(?s)<docling_picture_annotation(?:_non_text)?>(.*?)</docling_picture_annotation(?:_non_text)?>")
_PAGE_NO = re.compile(r"<docling_page_number>(.*?)</docling_page_number>")
# White space that parts lines wherever a text's lines are taken
_LINES = re.compile("\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]")
_LONE = frozenset(fixed.LONE_SIGNS + fixed.TERMINAL_SIGNS + fixed.CONTROLS)  # signs that are no line of their own


def mapped(fn: Callable, returns: str, *cols: Column) -> Column:
    """fn over the values of columns, in Arrow batches; a null in the first gives null."""

    def run(*x):
        return None if x[0] is None else fn(*x)

    if len(cols) == 1:
        return F.udf(lambda a: run(a), returns, useArrow=True).asNondeterministic()(cols[0])
    return F.udf(lambda a, b: run(a, b), returns, useArrow=True).asNondeterministic()(*cols)


def table_rows(body: str) -> list[list[str]] | None:
    """Cells of a pipe table; None where it has fewer than two lines or no row. The second line may be its rule."""
    lines = body.strip().split("\n")
    if len(lines) < 2:
        return None
    rows = []
    for n, line in enumerate(map(str.strip, lines)):
        if n == 1 and "---" in line:
            continue
        if line[:1] == "|" and line[-1:] == "|":
            rows.append([c.strip() for c in line[1:-1].split("|")])
    return rows or None


def table_text(rows: list[list[str]]) -> str:
    """Pipe table with its rule under the first row."""
    if not rows:
        return ""
    lines = ["| " + " | ".join(r) + " |" for r in rows]
    return "\n".join([lines[0], "|" + "|".join(["---"] * len(rows[0])) + "|", *lines[1:]])


def clean_tables(text: str) -> str:
    """Tables without their empty columns and rows; malformed ones go."""

    def fix(m: re.Match) -> str:
        rows = table_rows(m[1])
        if rows is None:
            return ""
        width = max(map(len, rows))
        rows = [r + [""] * (width - len(r)) for r in rows]
        keep = [k for k in range(width) if any(r[k] for r in rows)]
        rows = [[r[k] for k in keep] for r in rows]
        rows = [r for r in rows if any(r)]
        return f"<docling_table>{table_text(rows)}</docling_table>" if rows else ""

    return _TABLE.sub(fix, text)


def table_faults(body: str) -> list[str]:
    """What is wrong with a table: malformed, empty_headers, empty_columns, empty_rows."""
    rows = table_rows(body)
    if rows is None:
        return ["malformed"]
    faults = []
    if not any(rows[0]):
        faults.append("empty_headers")
    if any(not any(r[k] for r in rows if k < len(r)) for k in range(len(rows[0]))):
        faults.append("empty_columns")
    if any(not any(r) for r in rows):
        faults.append("empty_rows")
    return faults


def drop_faulty_tables(text: str) -> dict:
    """The text without faulty tables, and how many tables had each fault."""
    count: dict[str, int] = {}
    tables = 0

    def fix(m: re.Match) -> str:
        nonlocal tables
        tables += 1
        faults = table_faults(m[1])
        for f in faults:
            count[f] = count.get(f, 0) + 1
        return "" if faults else m[0]

    return {"text": _TABLE.sub(fix, text), "tables": tables, "faults": count}


def drop_poor_annotations(text: str, least: float = 0.8) -> str:
    """Without picture annotations of which too small a part is letters; the others keep their tags."""

    def fix(m: re.Match) -> str:
        return m[0] if m[1] and sum(map(str.isalpha, m[1])) / len(m[1]) >= least else ""

    return _NOTE.sub(fix, text)


def settle_page_numbers(page: str) -> str:
    """Page-number tags around digits go where digits stand beside them in the page; other tags stay."""

    def fix(m: re.Match) -> str:
        if not re.fullmatch(r"\s*\d+\s*", m[1]):
            return m[0]
        beside = re.search(r"\d\s*\Z", page[: m.start()]) or re.match(r"\s*\d", page[m.end() :])
        return m[1] if beside else m[0]

    return _PAGE_NO.sub(fix, page)


def join_lone_signs(text: str) -> str:
    """A line that is one punctuation sign goes to the end of the last line with text, if that ends in a blank, letter or digit."""
    out: list[str] = []
    for line in _LINES.split(text)[: None if not text or not _LINES.match(text[-1]) else -1]:
        bare = line.strip()
        if len(bare) == 1 and bare in _LONE:
            k = len(out) - 1
            while k >= 0 and not out[k].strip():
                k -= 1
            if k >= 0 and (out[k][-1].isspace() or out[k][-1].isalnum()):
                del out[k + 1 :]
                out[k] += line
                continue
        out.append(line)
    return "\n".join(out)


def join_spaced_letters(text: str) -> str:
    """Words at a line's start whose letters stand apart are put together.

    The prefix of single characters with one blank between them, words parted by more, is joined if a word has four, or
    all have ten in two words or more, and enough of it is letters: all of up to eight characters, 65 % of more.
    """
    out = []
    for line in _LINES.split(text)[: None if not text or not _LINES.match(text[-1]) else -1]:
        if re.fullmatch(r"\s*(?:<docling_table>)?\s*\|.*\|\s*(?:</docling_table>)?\s*", line):
            out.append(line)
            continue
        lead = len(line) - len(line.lstrip(" \t"))
        m = re.compile(r"\S(?: \S)*(?: {2,}\S(?: \S)*)*:?").match(line, lead)
        if not m:
            out.append(line)
            continue
        words = re.split(r" {2,}", m[0])
        sizes = [w.count(" ") + 1 for w in words]
        dense = re.sub(r"\s+", "", m[0])
        letters = sum(map(str.isalpha, dense)) / max(1, len(dense))
        if not (max(sizes) >= 4 or sum(sizes) >= 10 and len(words) >= 2) or letters < (1.0 if len(dense) <= 8 else 0.65):
            out.append(line)
            continue
        fixed = " ".join(w.replace(" ", "") for w in words)
        rest = line[m.end() :]
        if rest and not rest[0].isspace() and not fixed.endswith(":"):
            fixed, rest = fixed[:-1], " " + fixed[-1] + rest
        out.append(line[:lead] + fixed + rest)
    return "\n".join(out)


def repetition(text: str, lines: int = 3, sentences: int = 5, chars: int = 350, sentence_length: int = 50, line_length: int = 8) -> dict:
    """Where a text first repeats itself too often: {kind, at} with kind sentence, char, line or None.

    Counted are repeats after the first time of: equal lines with their end (blank ones run into the next; lines with a
    bar need three times, short ones four times as many), equal sentences of some length up to .?!, equal characters.
    Kinds found at the same character: line before char before sentence.
    """
    best: tuple[int, int, str] | None = None

    def offer(at: int, rank: int, kind: str) -> None:
        nonlocal best
        if best is None or (at, rank) < best[:2]:
            best = (at, rank, kind)

    if m := re.search(r"(?s)(.)\1{%d}" % chars, text):
        offer(m.start() + chars, 1, "char")
    start, last, times = 0, None, 0
    for m in re.finditer(r"[.?!]", text):
        s = text[start : m.end()]
        times = times + 1 if len(s) >= sentence_length and s == last else 0
        if times >= sentences:
            offer(m.end() - 1, 2, "sentence")
            break
        start, last = m.end(), s
    start, last, times, at = 0, None, 0, text.find("\n")
    while at >= 0:
        if at - start >= 2 and text[at - 1] != "\n":
            s = text[start : at + 1]
            times = times + 1 if s == last else 0
            if times >= lines * (3 if "|" in s else 1) and (len(s) >= line_length or times >= 4 * lines):
                offer(at, 0, "line")
                break
            start, last = at + 1, s
        at = text.find("\n", at + 1)
    return {"kind": best[2], "at": best[0]} if best else {"kind": None, "at": None}


def split_document(text: str, most: int = 100_000) -> list[str]:
    """Parts of at most `most` characters, cut at the last blank line, line end, sentence end or blank, else hard."""
    parts = []
    while len(text) > most:
        head = text[:most]
        for mark, after in (("\n\n", 2), ("\n", 1), (". ", 2), (" ", 1)):
            k = head.rfind(mark)
            if k > 0:
                cut = k + after
                break
        else:
            cut = most
        parts.append(text[:cut].rstrip())
        text = text[cut:].lstrip()
    return [*parts, text]


def top_chunk(text: str, tokens: int = 2046, chars: int = 10_000) -> str:
    """The first `tokens` words inside the first `chars` characters, cut at a blank."""
    head = text[:chars]
    if len(text) > chars and not text[chars].isspace():
        head = head[: max(head.rfind(" "), head.rfind("\n"), 0)] or head
    ends = [m.end() for m in re.finditer(r"\S+", head)]
    return head[: ends[tokens - 1]] if len(ends) >= tokens else head.rstrip()


def clean_page(text: str) -> str:
    """A page's clean-up in its order: odd blanks, lone signs, letters apart, private characters, blank lines."""
    text = re.sub("\t\r \xa0[^\\S\n]*", " ", text)
    text = join_spaced_letters(join_lone_signs(text))
    text = re.sub("[-\U000f0000-\U000ffffd\U00100000-\U0010fffd�]", "", text)
    return re.sub(r"\n{2,}", "\n\n", text).strip()
