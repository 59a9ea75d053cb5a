"""Helpers and methods without Spark, against plain versions."""

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidelog.llm.automaton import compile_rules, scan
from tidelog.llm.chat import CONTROLS, escape, unescape
from tidelog.llm.decontam import Matcher, myers, normal
from tidelog.llm.onebit import Best, cosines, encode, estimates, search_batch
from tidelog.llm.probminhash import probability_jaccard, signatures
from tidelog.llm.secretscan import ADDED, BASE, compiled, find
from tidelog.llm.textbytes import column_bytes, shingles, word_spans
from tidelog.llm import textbytes, tokenfile
from tidelog.llm.tokenfile import PieceEncoder, pack, unpack
from tidelog.llm.toxicity import Network, fit, read_words, windows


def test_words_and_shingles_equal_a_plain_reading():
    texts = ["one two  three four five six", "", None, "short one", "é-ß x", "a b c d e a b c d e", "???"]
    data, offsets = column_bytes(pa.array(texts).slice(0))
    starts, ends, rows = word_spans(data, offsets)
    raw = data.tobytes()
    found = [[raw[a:b].decode() for a, b, r in zip(starts, ends, rows) if r == i] for i in range(len(texts))]
    assert found == [re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", t or "") for t in texts]
    rows, keys, counts = shingles(data, offsets, 5)
    for i, words in enumerate(found):
        runs = [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else []
        assert (rows == i).sum() == len(set(runs)) and counts[rows == i].sum() == len(runs)
    assert len(set(keys.tolist())) == len(keys)
    sliced = column_bytes(pa.array(texts).slice(1, 3))
    assert sliced[0].tobytes() == b"short one" and sliced[1].tolist() == [0, 0, 0, 9]


def test_signatures_estimate_probability_jaccard():
    draw = np.random.default_rng(4)
    n, both = 400, 300
    keys = draw.integers(0, 2**63, 2 * n - both).astype(np.uint64)
    weights = draw.integers(1, 4, len(keys)).astype(float)
    x, y = weights.copy(), weights.copy()
    x[n:], y[: n - both] = 0, 0
    y[y > 0] += draw.integers(0, 2, (y > 0).sum())
    rows = np.concatenate((np.zeros(n, int), np.ones(n, int)))
    at = np.concatenate((np.flatnonzero(x), np.flatnonzero(y)))
    names = signatures(rows, keys[at], np.concatenate((x[x > 0], y[y > 0])), 2, 2048)
    plain = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in range(len(x)) if x[i] and y[i])
    assert probability_jaccard(x, y) == pytest.approx(plain)
    assert (names[0] == names[1]).mean() == pytest.approx(plain, abs=0.05)
    assert probability_jaccard(3 * x, x) == pytest.approx(1)


def test_myers_equals_dynamic_programming():
    draw = random.Random(1)
    for _ in range(400):
        p = "".join(draw.choice("abc") for _ in range(draw.randint(1, 9)))
        t = "".join(draw.choice("abc") for _ in range(draw.randint(0, 20)))
        for anchored in (False, True):
            row = [j if anchored else 0 for j in range(len(t) + 1)]
            for i, c in enumerate(p, 1):
                new = [i]
                for j, d in enumerate(t, 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
                row = new
            masks = {c: sum(1 << i for i, d in enumerate(p) if d == c) for c in p}
            assert myers(p, masks, t, anchored)[0] == min(row)


def test_every_passage_within_the_budget_is_found():
    draw = random.Random(2)
    item = " ".join("".join(draw.choice("abcdef") for _ in range(5)) for _ in range(30))
    matcher = Matcher([(7, normal(item))], 0.05)
    budget = int(len(item) * 0.05)
    for edits in range(budget + 1):
        text = list(item)
        for place in draw.sample(range(len(text)), edits):
            text[place] = draw.choice(["", "#", text[place] + "#"])
        hits = matcher.search("Some TEXT before " + "".join(text) + " and after")
        assert len(hits) == 1 and hits[0][0] == 7 and hits[0][1] <= edits
    assert matcher.search(item[: len(item) // 2]) == [] and matcher.search(None) == [] and matcher.search("") == []


@pytest.mark.parametrize("pattern", ["ab+c?", "(?:a|bc){2}x", "[a-c]{2,3}", "a(?:b|)c"])
def test_the_automaton_accepts_where_a_match_ends(pattern):
    draw = random.Random(3)
    automaton = compile_rules([(pattern, False)])
    for _ in range(200):
        text = "".join(draw.choice("abcx ") for _ in range(draw.randint(0, 12)))
        bits = scan(automaton, np.frombuffer(text.encode(), np.uint8), lanes=3)
        ends = [bool(re.search(f"(?:{pattern})$", text[: i + 1])) for i in range(len(text))]
        assert (bits > 0).tolist() == ends


def brute_secrets(text):
    rules = [
        (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
        (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
        (re.compile(r"[0-9a-f]+"), 0, 32),
    ]
    return sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(rules) for m in p.finditer(text) if len(m.group(g)) >= n)


def test_secrets_equal_the_plain_patterns():
    draw = random.Random(4)
    parts = ["password", "Token", "SECRET", "api_key", "=", ":", " ", "'", "AKIA", "ABCDEF0123", "deadbeef01234567", "é", "abc", "\n", "token=secret:"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 20))) for _ in range(1500)] + ["", "f" * 50_000]
    data, offsets = column_bytes(pa.array(texts))
    found = find(data, offsets, BASE + ADDED, compiled(BASE + ADDED))
    assert [[s for s in spans if s[1] < 3] for spans in found] == [brute_secrets(t) for t in texts]


def test_pieces_give_the_ids_of_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = PieceEncoder(path)
    draw = random.Random(5)
    parts = ["it's", "IT'S", "<|endoftext|>", "\x01", "é", "́", "ΑΣ", ",", "x1", "...", " ", "\n", "\x1c", "'", "don't", " "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 9))) for _ in range(800)] + ["word, " * 3000]
    for _ in range(2):  # the second time from memory
        ids, counts = encoder.encode(*column_bytes(pa.array(texts)))
        ends = np.cumsum(counts)
        got = [ids[a:b].tolist() for a, b in zip(ends - counts, ends)]
        assert got == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_pieces_that_come_again_are_remembered_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(tokenfile, "REMEMBERED", 20)
    encoder, asked = PieceEncoder(public_tokenizers.path("word_bpe_49k.json")), []
    encode = encoder._encode_pieces
    encoder._encode_pieces = lambda pieces: asked.extend(str(p) for p in pieces) or encode(pieces)
    common = ["alpha", "beta", "gammadelta"]
    for k in range(30):
        text = " ".join(common + [f"{'abcdefghij'[k % 10]}{'qrstuvwxyz'[k // 10]}{'klmnop'[i]}" for i in range(6)])
        ids, _ = encoder.encode(*column_bytes(pa.array([text])))
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.keys) <= 20
    assert len(asked) == 3 + 30 * 6  # each common one once


@pytest.mark.parametrize("kind, base", [("up", textbytes._BASE), ("down", textbytes._BASE_INVERSE)])
def test_long_runs_of_powers_are_those_of_the_kept_ones(monkeypatch, kind, base):
    monkeypatch.setattr(textbytes, "_KEPT_POWERS", 10)
    monkeypatch.setattr(textbytes, "_powers", {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    for n in (3, 10, 11, 37):
        assert textbytes._power(kind, n)[:n].tolist() == [pow(int(base), k, 2**64) for k in range(n)]
    assert len(textbytes._powers[kind]) == 10


@pytest.mark.parametrize("n", [0, 1, 4, 1001])
def test_packed_numbers_come_back(n):
    numbers = (np.random.default_rng(n).integers(0, 2**32, n) >> np.random.default_rng(n + 1).integers(0, 32, n)).astype(np.uint32)
    control, data = pack(numbers)
    assert (unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n) == numbers).all()


def test_escaping_is_reversible_and_leaves_no_control_string():
    draw = random.Random(6)
    parts = [*CONTROLS, "\\", "-", "<", "|", "a", "\n", "\\-"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 10)))
        assert unescape(escape(text)) == text and not any(c in escape(text) for c in CONTROLS)


def test_estimates_keep_within_their_bounds():
    vectors = np.random.default_rng(7).standard_normal((400, 64))
    vectors[5] = vectors[6]
    bits, correction = encode(vectors)
    unit = vectors[:40] / np.linalg.norm(vectors[:40], axis=1)[:, None]
    guess, error = estimates(bits, correction, unit)
    exact = np.array([cosines(np.broadcast_to(q, vectors.shape), vectors) for q in vectors[:40]])
    assert (np.abs(guess - exact) <= error).mean() > 0.9999 and exact[0, 5] == exact[0, 6]


def test_codes_choose_few_vectors_to_rerank():
    vectors = np.random.default_rng(8).standard_normal((4000, 64))
    batch = pa.record_batch([pa.array(range(4000)), pa.array(list(vectors))], ["vec_id", "v"])
    best = Best(40, 5)
    search_batch(batch, np.arange(40), vectors[:40], best)
    for q in range(40):
        exact = cosines(np.broadcast_to(vectors[q], vectors.shape), vectors)
        exact[q] = -2
        assert best.name[q].tolist() == np.lexsort((np.arange(4000), -exact))[:5].tolist()
    assert best.compared < 40 * 4000 / 10


def test_gradients_of_the_network():
    net = Network()
    words = read_words(*column_bytes(pa.array(["the bad cat sat", "zz yy xx", "", "q " * 60])))
    places, rows = windows(words, 4)
    assert rows.tolist() == [0, 1, 2, 3, 3] and (places[3:] >= 0).sum() == 48 + 24
    x, error = net.inputs(words), np.array([1, -0.5, 0.3, 0.7, 0.2], np.float32)
    logit, kept = net.logits(x, places, keep=True)
    assert np.allclose(logit, net.logits(x, places), atol=1e-5)
    found, _ = net.gradients(x, places, kept, error)
    for name in ("in_f", "re_f", "re_b", "bias_b", "look", "out"):
        at = tuple(s // 2 for s in net.p[name].shape)
        held, values = net.p[name][at], []
        for step in (1e-2, -1e-2):
            net.p[name][at] = held + step
            values.append(float((net.logits(x, places) * error).sum()))
        net.p[name][at] = held
        assert (values[0] - values[1]) / 2e-2 == pytest.approx(float(found[name][at]), rel=0.05, abs=1e-4)


def test_the_network_learns_words_and_stems():
    draw = random.Random(8)
    word = lambda: "".join(draw.choice(["ra", "ti", "no", "ve"]) for _ in range(3))
    make = lambda bad: " ".join([word() for _ in range(40)] + ["grumf" + draw.choice(["a", "en", "ia", "os"])] * bad + [word() for _ in range(40)])
    texts, labels = zip(*[(make(i % 2), i % 2) for i in range(200)])
    net = fit(list(texts), list(labels), steps=60)
    other = [(make(i % 2), i % 2) for i in range(80)]
    scores = net.scores(*column_bytes(pa.array([t for t, _ in other])))
    assert ((scores >= 0.5) == np.array([y for _, y in other], bool)).mean() > 0.95
    for labels in ([], [0], [1, 1]):
        constant = fit(["x"] * len(labels), labels)
        assert (constant.scores(*column_bytes(pa.array(["a", ""]))) >= 0.5).all() == (labels == [1, 1])
