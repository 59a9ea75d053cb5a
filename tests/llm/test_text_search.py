"""The joins on shingles, the spelling variants and the ranked search against brute force, with edge rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.test_operators import documents, edited, sentence
from tidelog.llm import maxsketch, ngramjoin, spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def components(rows):
    """The smallest id that links reach, by comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    up = list(range(len(sets)))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            common = len(a & b)
            if common and 100 * common >= 80 * (len(a) + len(b) - common):
                up[top(x)] = top(y)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[top(k)] = min(i, low.get(top(k), i))
    return Counter((i, len(s), low.get(top(k))) for k, (i, s) in enumerate(sets))


def joined(frame):
    members, _ = ngramjoin.similar_sets(frame)
    return Counter(tuple(r) for r in members.select("doc_id", "n_shingles", "component_id").collect())


def test_ngram_join_equals_brute_force(spark):
    draw = random.Random(3)
    passage = sentence(draw, 50)
    texts = []
    for _ in range(6):
        base = sentence(draw, 100)
        texts += [base, base.upper(), base + " "] + [edited(draw, base, draw.randint(1, 4)) for _ in range(8)]
    chain = [sentence(draw, 120)]
    for _ in range(8):  # neighbours are linked, ends are not
        chain.append(edited(draw, chain[-1], 2))
    texts += chain
    texts += [f"{sentence(draw, n)} {passage} {sentence(draw, 3)}" for n in range(0, 40, 2)]  # share a passage only
    texts += [" ".join(f"w{k}" for k in range(n)) for n in (29, 28, 24, 23, 4, 5)]  # 20 of 25 is just enough
    texts += ["one two", "one  two\n", "One two", "", None, " \t\r\n", "...", "x " * 20_000, "É é " * 30, "É é " * 31]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (None, texts[0]), (None, "only here " * 9)]
    draw.shuffle(rows)
    assert joined(documents(spark, rows)) == components(rows)


def test_ngram_join_of_groups_of_copies(spark, monkeypatch):
    """Small blocks and few ranked shingles: groups are cut, and what the first text does not link meets in cells."""
    monkeypatch.setattr(ngramjoin, "BLOCK", 4)
    monkeypatch.setattr(ngramjoin, "RANKED", 10)
    monkeypatch.setattr(ngramjoin, "SLICE_BYTES", 20_000)
    draw = random.Random(4)
    base = sentence(draw, 90)
    near = [edited(draw, base, draw.randint(1, 3)) for _ in range(60)]
    far = [edited(draw, t, 3) for t in near[:20]]  # linked with others of them, not with the first text
    rows = [(k + 10, t) for k, t in enumerate([base] * 40 + near + far)]
    assert joined(documents(spark, rows)) == components(rows)
    assert joined(documents(spark, [])) == Counter()


def test_fragments_sum_to_the_overlap():
    draw = np.random.default_rng(5)
    names = draw.integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2)
    order = ngramjoin.Order(names[:40], np.arange(1, 41) * 10, 9000)
    place = order.of(names)
    assert len(np.unique(place)) == 500 and (np.diff(place[:40].astype(object)) > 0).all()
    assert place[40:].max() < place[:40].min()
    fragment = np.searchsorted(order.pivots, place, "right")
    assert fragment.max() < ngramjoin.FRAGMENTS
    assert sum(len(set(place[:300][fragment[:300] == f]) & set(place[200:][fragment[200:] == f])) for f in range(ngramjoin.FRAGMENTS)) == 100


def near_by_hand(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


def test_bitsets_find_one_error():
    draw = random.Random(6)
    words = sorted({"".join(draw.choice("abé\U0001f600") for _ in range(draw.randint(1, 8))) for _ in range(700)})
    index = spelling.Index(words)
    for m in sorted({len(w) for w in words}):
        asked = [w for w in words if len(w) == m] + ["z" * m]
        row, hit = spelling._hits(index.one_error(asked))
        got = {(asked[r], words[h]) for r, h in zip(row, hit)}
        assert got == {(a, w) for a in asked for w in words if near_by_hand(a, w)}


def spelled(rows, least=5):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= least}
    near = {w: [x for x in n if near_by_hand(w, x)] for w in n}
    form = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: f for w, f in form.items() if n[f] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def test_variants_equal_brute_force(spark, monkeypatch):
    draw = random.Random(7)
    base = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(6, 9))) for _ in range(40)]
    base += ["street" + x for x in "abcdefgh"]  # many share a half
    words = []
    for k, w in enumerate(base):
        words += [w] * draw.choice([5, 30, 160])
        for _ in range(3):
            at = draw.randrange(len(w))
            words += [draw.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "x" + w[at + 1 :]])] * draw.choice([4, 5, 6, 25])
    draw.shuffle(words)
    rows = [(k, " ".join(w.upper() if k % 7 == 0 else w for w in words[k::50])) for k in range(50)]
    rows += [(None, "Straßen ×÷×÷×÷ " * 7), (60, None), (61, ""), (62, "12 34 a b"), (1, rows[1][1]), (63, "langeswort " * 30_000)]
    expected = spelled(rows)
    assert sum(f is not None for _, f, *_ in expected) > 10 and any(r not in (w, f) for w, f, r, *_ in expected)
    for block in (spelling.BLOCK, 3):  # whole halves, and halves cut into blocks
        monkeypatch.setattr(spelling, "BLOCK", block)
        found = [tuple(r) for r in spelling.variants(documents(spark, rows)).collect()]
        assert len(found) == len(expected) and set(found) == expected
    assert spelling.variants(documents(spark, [])).isEmpty()


def ranking(rows, items, k):
    find = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
    docs = [(i, Counter(find((t or "").translate(LOW)))) for i, t in rows]
    n_docs, n_terms = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    by_item = {}
    for i, text in items:
        if i is not None:
            by_item.setdefault(i, set()).update(find((text or "").translate(LOW)))
    out = []
    for item, terms in by_item.items():
        scores = []
        for i, c in docs:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def test_ranked_equals_brute_force(spark, monkeypatch):
    draw = random.Random(8)
    words = [f"w{k}" for k in range(60)] + ["Äpfel", "x9", "don't"]
    texts = [" ".join(draw.choices(words, weights=range(len(words), 0, -1), k=draw.randint(1, 80))) for _ in range(200)]
    texts += [texts[0], texts[0].upper(), None, "", " .;", "w1 " * 30_000, "äpfel ÄPFEL"]
    rows = [(k * 3 % 211, t) for k, t in enumerate(texts)] + [(None, texts[1]), (5, texts[2]), (5, texts[2])]
    items = [(k, " ".join(draw.choices(words, k=draw.randint(1, 12)))) for k in range(25)]
    items += [(30, None), (31, "..."), (32, "w1 W1 w1"), (33, "absent words"), (None, "w1"), (34, "w2"), (34, "w3 w4"), (35, "Äpfel")]
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, score int")
    expected = ranking(rows, items, 4)
    assert len(expected) > 90
    for held, block in ((maxsketch.HELD, maxsketch.BLOCK_BYTES), (300, 200)):  # one pass, and many small ones
        monkeypatch.setattr(maxsketch, "HELD", held)
        monkeypatch.setattr(maxsketch, "BLOCK_BYTES", block)
        found = maxsketch.ranked(documents(spark, rows), asked, 4)
        assert Counter(tuple(r) for r in found.collect()) == expected
    assert maxsketch.ranked(documents(spark, []), asked).isEmpty()
    assert maxsketch.ranked(documents(spark, rows), asked.limit(0)).isEmpty()


def test_bounds_hold_and_spare_work():
    draw = random.Random(9)
    words = [f"t{k}" for k in range(4000)]
    texts = pa.array([" ".join(draw.choices(words, k=draw.randint(5, 400))) for _ in range(1500)])
    items = maxsketch.Items(pa.array(range(20)), pa.array([" ".join(draw.choices(words, k=12)) for _ in range(20)]))
    items.weighted(np.full(len(items.vocabulary), 3000))
    part = maxsketch.Slice(texts, 1500, 300_000)
    bound = part.bounds(items, 0, 20)
    item, doc = np.divmod(np.arange(20 * 1500), 1500)
    exact = part.scores(items, item, doc).reshape(20, 1500)
    assert (bound >= exact).all()
    best = maxsketch.Best(20, 10)
    maxsketch.rescored(part, np.arange(1500), items, best)
    assert (best.score == -np.sort(-exact, axis=1)[:, :10]).all()
    assert best.scored < 20 * 1500 / 4


def test_profiles_bound_the_overlap():
    draw = np.random.default_rng(10)
    for n, m, common in ((1, 1, 1), (40, 50, 30), (900, 1100, 850), (900, 1100, 5), (30_000, 26_000, 25_000), (30_000, 26_000, 0)):
        names = draw.integers(0, 2**64, n + m - common, dtype=np.uint64)
        x, y = ngramjoin._profiles(np.concatenate((names[:n], names[n - common :])), np.array([n, m])).to_pylist()
        most = ngramjoin._most(x, y)
        assert common <= most <= min(n, m) and ngramjoin._most(y, x) == most
        if n > 500 and common < n / 2:
            assert 9 * most < 4 * (n + m)
    same = np.full(600, 7, np.uint64)  # one full part
    x, y = ngramjoin._profiles(np.concatenate((same, same)), np.array([600, 600])).to_pylist()
    assert ngramjoin._most(x, y) >= 600
