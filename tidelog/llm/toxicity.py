"""Toxicity of texts: a bidirectional gated recurrent network with attention pooling, trained in numpy.

The input of a word joins a trained vector of the word, the mean of trained vectors of its character
n-grams, and two fixed numbers, the smoothed log-odds of the word and of its most telling n-gram in
the training texts. Two recurrent passes over a window of words are pooled by attention into one logit. A
text is scored in all its overlapping windows, and the highest window counts: one passage is enough.

The network is small and is fitted on the driver, on a bounded sample of labelled texts; scoring runs in
Arrow batches over all texts. Word inputs are computed once per different word of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.rows import free_name
from tidelog.llm.textbytes import column_bytes, mix, slices, span_hashes, word_spans

#: Labelled texts of each class used for fitting, at most, and their longest size in characters.
SAMPLE_PER_CLASS = 1500
SAMPLE_CHARS = 20_000
WINDOW, STRIDE = 48, 36
BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
EMBED, HIDDEN = 8, 12
STEPS, BATCH, RATE = 160, 64, 0.02
#: Windows of a text that compete in one training step.
CHOICES = 4
SLICE_BYTES = 2_000_000

_INPUT = 2 * EMBED + 2


@dataclass
class Words:
    """The words of a batch: which different word stands where, and the buckets of words and n-grams."""

    which: np.ndarray  # different word at each position
    rows: np.ndarray  # row of each position
    word: np.ndarray  # bucket of each different word
    gram: np.ndarray  # buckets of all n-grams
    owner: np.ndarray  # different word of each n-gram


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends, rows = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    names, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    starts, ends = starts[first], ends[first]
    size = ends - starts
    # Each word with a mark (0) before and behind it; n-grams are runs of these bytes.
    place = np.cumsum(size + 2) - (size + 2)
    flat = np.zeros(int((size + 2).sum()), np.uint64)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    flat[np.repeat(place + 1, size) + inner] = data[np.repeat(starts, size) + inner]
    owner = np.repeat(np.arange(len(size)), size + 2)
    grams, owners = [], []
    for n in GRAMS:
        if len(flat) < n:
            continue
        run = np.zeros(len(flat) - n + 1, np.uint64)
        for k in range(n):
            run = run * np.uint64(257) + flat[k : k + len(run)] + np.uint64(1)
        whole = owner[: len(run)] == owner[n - 1 :]
        grams.append((mix(run[whole]) & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(owner[: len(run)][whole])
    gram = np.concatenate(grams) if grams else np.zeros(0, np.int64)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    return Words(which.astype(np.int64), rows, (names & np.uint64(BUCKETS - 1)).astype(np.int64), gram, owner)


def windows(words: Words, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Different word at each place of every window (-1: none), and the row of the window.

    A row without words has one empty window.
    """
    count = np.bincount(words.rows, minlength=n_rows)
    begin = np.cumsum(count) - count
    per_row = 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE))
    row = np.repeat(np.arange(n_rows), per_row)
    number = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    at = number[:, None] * STRIDE + np.arange(WINDOW)
    inside = at < count[row][:, None]
    place = np.where(inside, at + begin[row][:, None], 0)
    which = words.which if len(words.which) else np.zeros(1, np.int64)
    return np.where(inside, which[place], -1), row


class Network:
    """Parameters by name; ``word_odds`` and ``gram_odds`` are fixed inputs, the others are trained."""

    def __init__(self, seed: int = 5) -> None:
        draw = np.random.Generator(np.random.PCG64(seed))
        normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        self.word_odds = np.zeros(BUCKETS, np.float32)
        self.gram_odds = np.zeros(BUCKETS, np.float32)
        self.p = {"word": normal(BUCKETS, EMBED, scale=0.05), "gram": normal(BUCKETS, EMBED, scale=0.05)}
        for d in ("f", "b"):
            self.p[f"in_{d}"] = normal(_INPUT, 3 * HIDDEN, scale=0.4)
            self.p[f"re_{d}"] = normal(HIDDEN, 3 * HIDDEN, scale=0.25)
            self.p[f"bias_{d}"] = np.zeros(3 * HIDDEN, np.float32)
        self.p["look"] = normal(2 * HIDDEN, scale=0.3)
        self.p["out"] = normal(2 * HIDDEN, scale=0.3)
        self.p["out_bias"] = np.zeros(1, np.float32)
        self.shift = 0.0

    def inputs(self, words: Words) -> np.ndarray:
        n = len(words.word)
        x = np.zeros((n, _INPUT), np.float32)
        x[:, :EMBED] = self.p["word"][words.word]
        grams = np.bincount(words.owner, minlength=n).astype(np.float32)
        vectors = self.p["gram"][words.gram]
        for k in range(EMBED):
            x[:, EMBED + k] = np.bincount(words.owner, vectors[:, k], n) / np.maximum(grams, 1)
        best = np.zeros(n, np.float32)
        np.maximum.at(best, words.owner, self.gram_odds[words.gram])
        x[:, -2], x[:, -1] = best, self.word_odds[words.word]
        return x

    def _pass(self, projected: np.ndarray, places: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states of one direction at every place, and what the way back needs."""
        n, steps = places.shape
        u = self.p[f"re_{d}"]
        h = np.zeros((n, HIDDEN), np.float32)
        states = np.zeros((steps, n, HIDDEN), np.float32)
        trace: list = [None] * steps
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x = projected[places[:, t]]
            rec = h @ u
            gates = np.clip(0.25 * (x[:, : 2 * HIDDEN] + rec[:, : 2 * HIDDEN]) + 0.5, 0, 1)
            r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + r * rec[:, 2 * HIDDEN :])
            mask = (places[:, t] >= 0)[:, None]
            new = np.where(mask, c + z * (h - c), 0 if d == "b" else h).astype(np.float32)
            trace[t] = (h, gates, c, rec[:, 2 * HIDDEN :], mask)
            h = new
            states[t] = h
        return states, trace

    def _pool(self, both: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        look = both @ self.p["look"]
        look = np.where(places.T >= 0, look, -1e9)
        weight = np.exp(look - look.max(0))
        weight /= weight.sum(0)
        context = np.einsum("tn,tnh->nh", weight, both)
        return context @ self.p["out"] + self.p["out_bias"][0], weight, context

    def _states(self, x: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Hidden states of both directions as :meth:`_pass` gives them, without what the way back needs."""
        n, steps = places.shape
        both = np.empty((steps, n, 2 * HIDDEN), np.float32)
        columns = np.ascontiguousarray(places.T)
        open_places = (columns < 0).any(1)
        for d, side in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            projected = np.vstack((x @ self.p[f"in_{d}"] + self.p[f"bias_{d}"], np.zeros((1, 3 * HIDDEN), np.float32)))
            gate_in = np.ascontiguousarray(0.25 * projected[:, : 2 * HIDDEN] + 0.5)
            cand_in = np.ascontiguousarray(projected[:, 2 * HIDDEN :])
            gate_re = np.ascontiguousarray(0.25 * self.p[f"re_{d}"][:, : 2 * HIDDEN])
            cand_re = np.ascontiguousarray(self.p[f"re_{d}"][:, 2 * HIDDEN :])
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                gates = gate_in[columns[t]]
                gates += h @ gate_re
                np.clip(gates, 0, 1, out=gates)
                c = h @ cand_re
                c *= gates[:, :HIDDEN]
                c += cand_in[columns[t]]
                np.tanh(c, out=c)
                h -= c
                h *= gates[:, HIDDEN:]
                h += c
                if d == "b" and open_places[t]:
                    h[columns[t] < 0] = 0
                both[t, :, side] = h
        return both

    def logits(self, x: np.ndarray, places: np.ndarray, keep: bool = False):
        """The logit of each window; with ``keep`` also what :meth:`gradients` needs."""
        if not keep:
            return self._pool(self._states(x, places), places)[0]
        runs = {}
        for d in ("f", "b"):
            projected = np.vstack((x @ self.p[f"in_{d}"] + self.p[f"bias_{d}"], np.zeros((1, 3 * HIDDEN), np.float32)))
            runs[d] = self._pass(projected, places, d)
        both = np.concatenate((runs["f"][0], runs["b"][0]), axis=2)
        logit, weight, context = self._pool(both, places)
        return logit, (runs, both, weight, context)

    def gradients(self, x: np.ndarray, places: np.ndarray, kept, error: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the parameters behind the inputs, and of the inputs, for ``error`` on the logits."""
        runs, both, weight, context = kept
        g = {"out": context.T @ error, "out_bias": error.sum(keepdims=True)}
        to_context = error[:, None] * self.p["out"]
        to_weight = (both * to_context).sum(2)
        to_look = weight * (to_weight - (weight * to_weight).sum(0))
        g["look"] = np.einsum("tn,tnh->h", to_look, both)
        to_both = weight[:, :, None] * to_context + to_look[:, :, None] * self.p["look"]
        to_x = np.zeros_like(x)
        steps = places.shape[1]
        for d, side in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            u = self.p[f"re_{d}"]
            to_u = np.zeros_like(u)
            to_projected = np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
            later = np.zeros((places.shape[0], HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
                h, gates, c, rec, mask = runs[d][1][t]
                r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
                dh = later + to_both[t][:, side]
                passed = np.where(mask, 0, dh if d == "f" else 0)
                dh = np.where(mask, dh, 0)
                dc = dh * (1 - z) * (1 - c * c)
                inside = 0.25 * ((gates > 0) & (gates < 1))
                dz = dh * (h - c) * inside[:, HIDDEN:]
                dr = dc * rec * inside[:, :HIDDEN]
                step = np.concatenate((dr, dz, dc), axis=1)
                back = np.concatenate((dr, dz, dc * r), axis=1)
                np.add.at(to_projected, places[:, t], step)
                to_u += h.T @ back
                later = (dh * z + back @ u.T + passed).astype(np.float32)
            to_projected = to_projected[:-1]
            g[f"re_{d}"], g[f"in_{d}"], g[f"bias_{d}"] = to_u, x.T @ to_projected, to_projected.sum(0)
            to_x += to_projected @ self.p[f"in_{d}"].T
        return g, to_x

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of each row in [0, 1]: that of its highest window."""
        return 1 / (1 + np.exp(-np.clip(self.row_logits(data, offsets) - self.shift, -30, 30)))

    def row_logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        words = read_words(data, offsets)
        places, rows = windows(words, n)
        x = self.inputs(words)
        logit = np.concatenate([self.logits(x, places[a : a + 1024]) for a in range(0, len(places), 1024)]) if len(places) else np.zeros(0)
        out = np.full(n, -np.inf)
        np.maximum.at(out, rows, logit)
        return out


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of each pair, ``count`` of them, one after the other."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _grams_of(words: Words, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram buckets of the different words ``used``, and how many each has."""
    order = np.argsort(words.owner, kind="stable")
    count = np.bincount(words.owner, minlength=len(words.word))
    return words.gram[order][_ranges((np.cumsum(count) - count)[used], count[used])], count[used]


def _odds(texts: list[str], label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log-odds of each word and n-gram bucket by the number of texts of each class that hold it."""
    seen = np.zeros((2, 2, BUCKETS))  # words or n-grams, class
    for low in range(0, len(texts), 50):
        part = label[low : low + 50].astype(int)
        words = read_words(*column_bytes(pa.array(texts[low : low + 50], pa.large_string())))
        pairs = _distinct(words.rows * np.int64(max(1, len(words.word))) + words.which)
        row, word = np.divmod(pairs, max(1, len(words.word)))
        grams, count = _grams_of(words, word)
        for kind, bucket, text in ((0, words.word[word], row), (1, grams, np.repeat(row, count))):
            once = _distinct(bucket * np.int64(50) + text)
            for c in (0, 1):
                seen[kind, c] += np.bincount(once[part[once % 50] == c] // 50, minlength=BUCKETS)
    ones, total = label.sum(), len(label)
    odds = np.log((seen[:, 1] + 0.5) / (ones + 1)) - np.log((seen[:, 0] + 0.5) / (total - ones + 1))
    both = seen.sum(1)
    return tuple((odds * both / (both + 4) / 2).astype(np.float32))


def fit(texts: list[str], labels: list[int], steps: int = STEPS, seed: int = 5) -> Network:
    """A network fitted to whole texts (lower case) with labels 0 and 1.

    In each step some windows of a text compete and the highest one learns. At the end the
    logit that parts the classes best on the training texts becomes the score 0.5.
    """
    net = Network(seed)
    label = np.array(labels, np.float64)
    if len(set(labels)) < 2:
        net.p["out"][:] = 0
        net.p["out_bias"][0] = 4.0 if labels and labels[0] else -4.0
        return net
    draw = np.random.Generator(np.random.PCG64(seed))
    net.word_odds, net.gram_odds = _odds(texts, label)
    classes = [np.flatnonzero(label == c) for c in (0, 1)]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        chosen = np.concatenate([draw.choice(c, BATCH // 2) for c in classes])
        words = read_words(*column_bytes(pa.array([texts[i] for i in chosen], pa.large_string())))
        places, rows = windows(words, len(chosen))
        first = np.searchsorted(rows, np.arange(len(chosen) + 1))
        spots = [a + draw.permutation(b - a)[:CHOICES] for a, b in zip(first, first[1:])]
        spot, of = np.concatenate(spots), np.repeat(np.arange(len(chosen)), [len(s) for s in spots])
        used, local = np.unique(places[spot], return_inverse=True)
        local = local.reshape(len(spot), -1) - (1 if used[0] < 0 else 0)
        used = used[used >= 0]
        grams, count = _grams_of(words, used)
        part = Words(used, used, words.word[used], grams, np.repeat(np.arange(len(used)), count))
        x = net.inputs(part)
        logit = net.logits(x, local)
        ranked = np.lexsort((-logit, of))
        best = ranked[np.searchsorted(of[ranked], np.arange(len(chosen)))]
        logit, kept = net.logits(x, local[best], keep=True)
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label[chosen]) / len(chosen)).astype(np.float32)
        g, to_x = net.gradients(x, local[best], kept, error)
        g["word"] = np.zeros_like(net.p["word"])
        np.add.at(g["word"], part.word, to_x[:, :EMBED])
        share = to_x[:, EMBED : 2 * EMBED] / np.maximum(np.bincount(part.owner, minlength=len(used)), 1)[:, None]
        g["gram"] = np.stack([np.bincount(part.gram, share[part.owner, k], BUCKETS) for k in range(EMBED)], axis=1)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in net.p.items():
            m, s = moment[k]
            m += 0.1 * (g[k] - m)
            s += 0.01 * (g[k] ** 2 - s)
            v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    logit = np.concatenate([net.row_logits(*column_bytes(pa.array(texts[i : i + 50], pa.large_string()))) for i in range(0, len(texts), 50)])
    net.shift = _parting(logit, label)
    return net


def _parting(logit: np.ndarray, label: np.ndarray) -> float:
    """The logit with the fewest errors; an error on class 0 weighs three times as much. Ties: the middle."""
    order = np.argsort(logit)
    z, y = logit[order], label[order]
    missed = np.concatenate(([0], np.cumsum(y)))
    wrong = (len(y) - y.sum()) - np.concatenate(([0], np.cumsum(1 - y)))
    cost = missed + 3 * wrong
    best = np.flatnonzero(cost == cost.min())
    i = best[len(best) // 2]
    return float((z[max(0, i - 1)] + z[min(len(z) - 1, i)]) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, allowed) -> tuple[list[str], list[int]]:
    """A bounded sample of labelled texts, the same on every run: by a hash of the id, per class."""
    clean = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    clean = clean.where(allowed(F.col("doc_id")))
    order = F.xxhash64("doc_id", F.lit(7))
    picked = [clean.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(SAMPLE_PER_CLASS) for c in (0, 1)]
    ids = docs.sparkSession.createDataFrame(picked[0].union(picked[1]).collect(), clean.schema)
    text = F.lower(F.col("text").cast("string"))
    rows = (
        docs.select("doc_id", text.alias("text"))
        .where(F.length("text").between(1, SAMPLE_CHARS))
        .join(F.broadcast(ids), "doc_id")
        .orderBy(order, "doc_id", "text")
        .limit(2 * SAMPLE_PER_CLASS)
        .collect()
    )
    return [r.text for r in rows], [r.toxic for r in rows]


def held_out(doc_id):
    """Whether a row is kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame) -> Network:
    """Fitted on labelled rows that are not held out. Without labels of both classes it is a constant."""
    return fit(*training_rows(docs, labels, lambda doc_id: ~held_out(doc_id)))


def score(docs: DataFrame, net: Network, name: str = "toxic_score") -> DataFrame:
    """``docs`` with the score in [0, 1] of every row in the column ``name``; all other columns stay.

    A null or empty text, or one without words, is one empty window and gets the network's
    score of that. Texts are scored whole; repeated rows and null ids are scored like others. A column
    ``name`` that is there already is replaced, other names do not matter.
    """
    others = docs.drop(name)
    fields = others.schema.fields
    schema = others.withColumn(name, F.lit(0.0)).schema
    rows = others.withColumn(free_name(others, "lower"), F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    last = len(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, last, SLICE_BYTES):
                values = net.scores(*column_bytes(batch.column(last)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(values, pa.float64())], [*[f.name for f in fields], name])

    return rows.mapInArrow(run, schema)
