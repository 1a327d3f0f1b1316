import base64
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import abuse, language, leak, mixing, neardup, packing, reading, scan, tokens

WORDS = {
    "eng_Latn": "the old house near the river was sold by the council because nobody wanted to repair its broken windows and doors this year".split(),
    "deu_Latn": "das alte haus am fluss wurde von der gemeinde verkauft weil niemand die kaputten fenster und türen in diesem jahr reparieren wollte".split(),
    "spa_Latn": "la casa vieja junto al río fue vendida por el ayuntamiento porque nadie quería reparar sus ventanas y puertas rotas este año".split(),
}


def sentence(lang, rng, n=14):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n)).capitalize() + "."


def model():
    rng = random.Random(1)
    return language.train([(k, " ".join(sentence(k, rng) for _ in range(8))) for k in WORDS for _ in range(20)])


def test_language_segments():
    m, rng = model(), random.Random(2)
    mixed = " ".join(sentence("eng_Latn", rng) for _ in range(4)) + "\n\n" + " ".join(sentence("deu_Latn", rng) for _ in range(3))
    phrase = " ".join(sentence("eng_Latn", rng) for _ in range(4)) + " das alte Haus. " + sentence("eng_Latn", rng)
    a, b, c, d, e = language.classify([mixed, phrase, None, "", "12 34 !!"], m)
    assert a[0] == "eng_Latn" and [s[2] for s in a[2]] == ["eng_Latn", "deu_Latn"]
    assert mixed[a[2][1][0] :].startswith(mixed.split("\n\n")[1][:10]) and a[2][1][4] == 42
    assert b[0] == "eng_Latn" and len([s for s in b[2] if s[4] >= 20]) >= 1 and {s[2] for s in b[2] if s[4] >= 20} == {"eng_Latn"}
    assert c == d == (None, None, []) and e[0] == "und"
    assert language.train([]).languages and language.classify(["abc"], language.train([]))[0][0] == "und"


def test_language_held_out():
    m, rng = model(), random.Random(3)
    hit = sum(language.classify([" ".join(sentence(k, rng) for _ in range(2))], m)[0][0] == k for k in WORDS for _ in range(50))
    assert hit >= 147


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokens.TOKENIZER, "rb"))}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet="ab cdeéжß\n\t12'-.,_=\x1c🙂漢zthe  ", max_size=80))
def test_token_counts(encoding, text):
    assert tokens.counter().text(text) == len(encoding.encode_ordinary(text))


def test_token_counts_long(encoding):
    for t in ("=" * 3000, " " * 3000 + "x", "the" * 2000, "Straßenbahnhaltestelle" * 50):
        assert tokens.counter().text(t) == len(encoding.encode_ordinary(t))


def test_isotonic():
    x, y = reading.isotonic(np.arange(6.0), np.array([1, 3, 2, 2, 5, 4.0]), np.ones(6))
    assert (np.diff(y) > 0).all() and y[0] == 1 and y[-1] == 4.5 and len(x) == 3


def test_reading_levels():
    easy = "The cat is big. The dog can run. We see the sun. It is a red hat. " * 12
    hard = "The multidimensional characterisation of intersubjective presuppositions necessitates, notwithstanding considerable methodological reservations, a comprehensive reconsideration of institutional commensurability throughout contemporary interpretations. " * 12
    rng = random.Random(4)
    mid = " ".join(sentence("eng_Latn", rng, 16) for _ in range(30))
    m = reading.train([easy, hard, mid, easy + mid, mid + hard] * 4)
    a, b, c, d, e = reading.levels_of([easy, hard, mid, easy + mid, "| a | b |\n\n- x"], m)
    assert a[0] < c[0] < b[0] and a[1] == 1 and b[2] == 1 and d[1] < 0.9 and e[0] is None
    assert reading.levels_of([""], reading.train([])) == [(None, 0.0, 0.0)]


def decoder():
    rng = random.Random(5)
    words: dict[str, int] = {}
    for k in WORDS:
        for w in WORDS[k]:
            words[w] = words.get(w, 0) + 4000
    words |= {"well": 3000, "known": 3000, "long": 3000, "council": 5000}
    assert rng
    return scan.Decoder(words, sum(words.values()))


def test_scan_words():
    d = decoder()
    assert d.corrected("couricil") == "council" and d.corrected("wind0ws") == "windows" and d.corrected("w■ndows") == "windows"
    assert d.corrected("windows") is None and d.corrected("qqq") is None
    assert d.divided("coun", "-", "cil") and not d.divided("well", "-", "known") and d.divided("zz", "\xad", "yy")
    assert d.decode(["coun", "cil"]) == ["council"] and d.decode(["thehouse"]) == ["thehouse"] or d.decode(["thehouse"]) == ["the", "house"]
    kinds, broken, misread = scan.noise("the coun-\ncil was sold by the repa-\nir wind0ws hovse couricil riv■r nea^", None, d)
    assert broken == 2 and misread >= 3 and kinds[:2] == ["broken_word", "misread"]
    assert scan.noise("well-\nknown and well-\nknown", None, d)[1] == 0
    assert scan.noise("", None, d) == ([], 0, 0)
    assert scan.repaired("The coun cil sold thehouse near the riv■r. Wind0ws", None, d) == "The council sold the house near the river. Windows"


def test_scan_pages():
    d = decoder()
    body = ["the old house near the river was sold by the council this year", "nobody wanted to repair its broken windows and doors in this year"]
    pages = [f"Annual Report\n{body[0]}\n{body[1]}\n— {n} —\n" for n in range(7, 11)]
    ends = np.cumsum([len(p) for p in pages]).tolist()
    kinds = scan.noise("".join(pages), ends, d)[0]
    assert kinds == ["running_header", "page_number"]
    fixed = scan.repaired("".join(pages), ends, d)
    assert "Annual" not in fixed and "—" not in fixed
    assert scan.noise("".join(pages[:2]), ends[:2], d)[0] == []
    rng = random.Random(1)
    numbers = [f"{sentence('eng_Latn', rng)}\n{sentence('eng_Latn', rng)}\n{n}\n" for n in range(3, 7)]
    assert scan.noise("".join(numbers), np.cumsum([len(p) for p in numbers]).tolist(), d)[0] == ["page_number"]


def test_paragraphs():
    lines = ["A first line that is rather long and", "goes on until here.", "", "A second paragraph of some length", "that ends.", "- item one", "- item two"]
    assert scan.paragraphs(lines)[:2] == ["A first line that is rather long and goes on until here.", "A second paragraph of some length that ends."]
    assert scan.paragraphs([]) == [] and scan.paragraphs(["", ""]) == []


def test_leak_share_and_index():
    rng = random.Random(6)
    vocab = [f"word{i}" for i in range(400)]
    items = [" ".join(rng.choice(vocab) for _ in range(60)) for _ in range(30)]
    hashed = leak.words_of(items)
    ix = leak.Index(list(enumerate(hashed)))
    for k in range(30):
        w = items[k].split()
        half = w[:20] + ["x"] * 50 + w[30:45]
        altered = [("zz" if i % 9 == 8 else v) for i, v in enumerate(w)]
        for text, want in ((" ".join(half).upper(), True), (" ".join(altered), True), (" ".join(w[:15]), False)):
            t = leak.words_of([text])[0]
            assert (k in ix.hits(t) and leak.share(hashed[k], t) >= 0.5) is want
    assert leak.share(hashed[0], np.zeros(0, np.uint64)) == 0


def test_simhash_blocks_find_all_within_radius():
    rng = np.random.default_rng(7)
    items = [rng.integers(0, 1 << 63, 40).astype(np.uint64) for _ in range(20)]
    ix = leak.Index(list(enumerate(items)))
    fp, owner, tables = ix.by_span[leak.SPAN]
    for _ in range(300):
        k = rng.integers(len(fp))
        q = fp[k] ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, leak.RADIUS, replace=False).astype(np.uint64))
        found = set()
        for b, (order, off) in enumerate(tables):
            v = int(q >> np.uint64(16 * b)) & 0xFFFF
            found |= set(order[off[v] : off[v + 1]].tolist())
        assert k in found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.integers(20, 200))
def test_packing(sizes, capacity):
    box, who, begin, size = packing.pack(list(range(len(sizes))), sizes, capacity)
    fill: dict = {}
    for b, s in zip(box, size):
        fill[b] = fill.get(b, 0) + s
    assert all(v <= capacity for v in fill.values())
    for i, s in enumerate(sizes):
        parts = sorted((a, z) for w, a, z in zip(who, begin, size) if w == i)
        assert sum(z for _, z in parts) == s and (s > capacity or len(parts) == 1)
        assert [a for a, _ in parts] == [sum(z for _, z in parts[:k]) for k in range(len(parts))]
    assert len(fill) <= max(1, 2 * -(-sum(sizes) // capacity)) or not sizes


def test_packing_finds_exact_fill():
    import itertools

    rng = random.Random(8)
    for _ in range(50):
        lengths = sorted(rng.sample(range(1, 60), 8))
        room = rng.randint(20, 120)
        best = max(sum(c) for k in range(9) for c in itertools.combinations(lengths, k) if sum(c) <= room)
        assert sum(packing.fill(lengths, dict.fromkeys(lengths, 1), room)) == best


@settings(max_examples=40, deadline=None)
@given(st.integers(5, 300), st.floats(0.02, 0.98), st.integers(0, 1000))
def test_flight_keeps_totals(n, p, seed):
    rng = np.random.default_rng(seed)
    size = sorted((rng.integers(10, 500, n)).tolist(), reverse=True)
    q = mixing.flight([p] * n, size, rng)
    assert sum(0 < v < 1 for v in q) <= 2
    assert sum(q) == pytest.approx(n * p, abs=1e-4) and sum(a * b for a, b in zip(q, size)) == pytest.approx(p * sum(size), rel=1e-6)
    q = mixing.flight([p] * n, size, rng, True)
    assert set(q) <= {0.0, 1.0}
    assert abs(sum(a * b for a, b in zip(q, size)) - p * sum(size)) <= max(size)


def test_flight_is_fair():
    rng = np.random.default_rng(9)
    size = [100] * 10 + [10] * 30
    got = np.mean([mixing.flight([0.3] * 40, size, rng, True) for _ in range(400)], axis=0)
    assert abs(got[:10].mean() - 0.3) < 0.03 and abs(got[10:].mean() - 0.3) < 0.03


def test_abuse():
    rng = random.Random(10)
    bad = ["You are a pathetic idiot and I hope you choke", "you are a pathetic 1d10t and i hope you ch0ke", "YOU ARE A PATHETIC IDDDIOT AND I HOPE YOU CHOKE"]
    plain = lambda: " ".join(sentence("eng_Latn", rng) for _ in range(6))
    rows = [(1, plain() + " " + rng.choice(bad) + ". " + plain()) for _ in range(30)] + [(0, plain()) for _ in range(200)] + [(1, plain()) for _ in range(8)]
    m = abuse.train(rows)
    got = abuse.score_texts([bad[0] + ".", plain(), plain() + " " + bad[1] + "!", plain() + " The council talks of an idiot."], m)
    assert got[0][1] and got[2][1] and not got[1][1] and not got[3][1]
    s, e, p = got[2][1][0]
    assert p >= 0.5 and e - s >= 30
    assert abuse.score_texts(["x"], abuse.train([]))[0] == (0.0, [])
    assert abuse.score_texts(["x"], abuse.train([(0, "x y")]))[0] == (0.0, [])


def test_cell_join_is_exact():
    rng = np.random.default_rng(11)
    base = [rng.integers(0, 1 << 32, 60, dtype=np.uint64).astype(np.uint32) for _ in range(6)]
    rows = []
    for i in range(60):
        s = base[i % 6].copy()
        k = rng.integers(0, 14)
        s[:k] = rng.integers(0, 1 << 32, k, dtype=np.uint64).astype(np.uint32)
        rows.append((i, np.unique(s).tobytes(), 0))
    a, b, v = neardup._cell_pairs(rows, 0.7)
    sets = [set(np.frombuffer(r[1], np.uint32).tolist()) for r in rows]
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.7}
    assert set(zip(a, b)) == want and want


def test_scan_counts_come_from_the_lattice():
    d = decoder()
    assert scan.noise("the cou ricil sold t h e old house", None, d)[2] == 2  # divided by a blank and misread at once, a short word pulled apart
    assert scan.noise("nobody saw thecouricil and the coun\ncil", None, d)[2] == 2  # run together and misread at once, parted over a line end without a mark
    assert scan.noise("the house near the\n\nriver was sold", None, d)[2] == 0
    kinds = scan.noise("the cou ricil sold t h e old house to thecouricil", None, d)[0]
    assert kinds == ["misread"]


def test_abuse_one_telling_word_is_enough():
    rng = random.Random(4)
    plain = lambda: " ".join(sentence("eng_Latn", rng) for _ in range(6))
    rows = [(1, plain() + " Vermin! " + plain()) for _ in range(40)] + [(0, plain()) for _ in range(200)]
    m = abuse.train(rows)
    got = abuse.score_texts(["Vermin!", plain() + " Vermin. " + plain(), plain()], m)
    assert got[0][1] and got[1][1] and not got[2][1]
    assert [t[2] for t in got[0][1]] == [t[2] for t in got[1][1]]


def test_known_fragments_are_joined():
    words = decoder().words | {"appoint": 30, "ment": 30, "appointment": 900, "in": 9000, "for": 9000, "mation": 20, "information": 2000}
    d = scan.Decoder(words, 3_000_000)
    assert "ment" in d.words and d.corrected("ment") is None
    assert scan.repaired("The appoint ment was for the In for mation near the house", None, d) == "The appointment was for the Information near the house"
    assert scan.repaired("The house near the river", None, d) == "The house near the river"


def test_abuse_recall_on_held_out_bags():
    """Few labels, a twentieth of them wrong: sentences of families that training saw, in disguise and in long sentences, and of some that it never saw."""
    rng = random.Random(12)
    seen = ["You are a pathetic {x} and I hope you choke", "Those people are filthy vermin and nobody wants them", "horny naked girls wait for you", "du dreckiges {x}, verrecke doch", "cierra la boca, {x} de mierda"]
    fresh = ["shut up you worthless {x}", "Ihr seid alle ein {x} ohne Hirn, ihr Abschaum", "nackte Frauen und geile Pornos"]
    words = ["idiot", "1d10t", "id*ot", "i d i o t", "bastard", "b@stard", "arschloch", "cabrón"]
    plain = lambda: " ".join(sentence("eng_Latn", rng) for _ in range(6))
    bad = lambda f: plain()[:-1] + " " + rng.choice(f).format(x=rng.choice(words)) + (". " if rng.random() < 0.5 else " ") + plain()
    report = lambda: plain() + " The court heard that a witness had been called an idiot. " + plain()
    rows = [(int(rng.random() > 0.05), bad(seen)) for _ in range(25)] + [(int(rng.random() < 0.05), report() if i % 5 == 0 else plain()) for i in range(300)]
    m = abuse.train(rows)
    hits = [bool(g[1]) for g in abuse.score_texts([bad(seen) for _ in range(100)] + [bad(fresh) for _ in range(50)] + [plain() for _ in range(100)] + [report() for _ in range(50)], m)]
    assert sum(hits[:100]) >= 95 and sum(hits[100:150]) >= 30 and sum(hits[150:]) <= 3


def test_abuse_without_positive_labels_keeps_the_prior():
    m = abuse.train([(0, "the old house")])
    got = abuse.score_texts(["you pathetic idiot, choke", "the old house", "***", "x"], m)
    assert [bool(g[1]) for g in got] == [True, False, False, False]


def test_packing_uses_all_copies_and_lengths():
    assert sum(packing.fill([7], {7: 50}, 343)) == 343
    assert sum(packing.fill([6, 10], {6: 9, 10: 30}, 299)) == 298
    rng = random.Random(3)
    for _ in range(40):
        counts = {v: rng.randint(1, 9) for v in rng.sample(range(2, 40), 6)}
        room, sums = rng.randint(30, 250), {0}
        for v, n in counts.items():
            sums = {s + v * k for s in sums for k in range(n + 1)}
        got = packing.fill(sorted(counts), counts, room)
        assert sum(got) == max(s for s in sums if s <= room) and all(got.count(v) <= n for v, n in counts.items())


def test_leak_index_keeps_every_case():
    """Every altered copy that the exact share accepts has windows enough, down to every fourth word altered."""
    rng = random.Random(16)
    vocab = [f"word{i}" for i in range(300)]
    items = leak.words_of([" ".join(rng.choice(vocab) for _ in range(rng.randint(20, 90))) for _ in range(60)])
    ix = leak.Index(list(enumerate(items)))
    cases = 0
    for every in (4, 5, 6, 7, 9):
        for k, w in enumerate(items):
            t = w.copy()
            t[rng.randrange(every) :: every] = leak.words_of(["other"])[0][0]
            t = np.concatenate([leak.words_of(["before it"])[0], t[: rng.randint(len(t) // 2, len(t))]])
            if leak.share(w, t) >= 0.5:
                cases += 1
                assert k in ix.hits(t)
    assert cases > 150


def test_repair_lowers_the_word_error_rate():
    """Clean paragraphs with words divided, pulled apart and misread: most errors are gone after the repair."""
    rng = random.Random(21)
    d = decoder()

    def spoil(w):
        x = rng.random()
        if x < 0.08 and len(w) > 5:
            k = rng.randint(2, len(w) - 3)
            return w[:k] + "-\n" + w[k:]
        if x < 0.12 and len(w) > 5:
            k = rng.randint(2, len(w) - 3)
            return w[:k] + " " + w[k:]
        if x < 0.20 and len(w) > 4:
            for a, b in rng.sample([("o", "0"), ("l", "1"), ("i", "1"), ("e", "■"), ("n", "ri"), ("m", "rn")], 6):
                if a in w[1:-1]:
                    return w[0] + w[1:-1].replace(a, b, 1) + w[-1]
        return w

    wrong = [0, 0]
    for _ in range(40):
        clean = " ".join(sentence("eng_Latn", rng) for _ in range(4))
        read = " ".join(map(spoil, clean.split()))
        for n, text in enumerate((read, scan.repaired(read, None, d))):
            a, b = clean.split(), text.split()
            # words that are not there, by multiset
            wrong[n] += len(a) - sum(min(a.count(w), b.count(w)) for w in set(a))
    print(wrong)
    assert wrong[0] > 150 and wrong[1] < 0.25 * wrong[0]
