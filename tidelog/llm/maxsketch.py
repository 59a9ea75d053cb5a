"""Ranked lexical search: upper bounds from hashed max-sketches, exact scores in descending order of the bounds.

A document's term with ``tf`` occurrences has the impact ``(10**9 * tf) div (1000 * tf + 8 * m)``, where ``m`` grows with the
document's length. The impacts of all its terms fold into a sketch of fixed width: a coordinate keeps the largest
impact of the terms hashed to it. The sum of ``weight * coordinate`` over an item's terms is then at least its score. All
items of a block are looked up in all sketches of a slice at once; per item the documents are scored exactly
from the highest bound down, until the next bound is below the lowest score kept so far.

Items are dealt to the tasks in blocks of bounded size, with two passes over the documents for each block: one for
the counts that weights need, one for the scores. A task keeps ``k`` documents for each item and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.textbytes import column_bytes, mix, slices, span_hashes, word_spans
from tidelog.session import shared_dir, written

#: Coordinates of a sketch.
WIDTH = 4096
#: Bytes of item texts in one pass.
BLOCK_BYTES = 4_000_000
SLICE_BYTES = 2_000_000
#: Looked up coordinates, and exactly scored terms, held at once.
HELD = 1_000_000
#: Documents of each item that are scored between two looks at the threshold.
STEP = 8
#: Slices of one item's results that are reduced apart before they meet.
SALTS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every term of a text column, in order."""
    data, offsets = column_bytes(column)
    data = _LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    return rows, span_hashes(data, starts, ends) if len(rows) else np.zeros(0, np.uint64)


def _keys(rows: np.ndarray, names: np.ndarray) -> np.ndarray:
    return names + mix(rows.astype(np.uint64) + np.uint64(1))


class Items:
    """The distinct terms of a block of items, item by item."""

    def __init__(self, ids: pa.Array, texts: pa.Array):
        """Texts of one id are one item; items without terms are left out."""
        rows, names = terms(texts)
        self.ids, number = np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)
        pair = np.unique(np.stack((number.ravel()[rows].astype(np.uint64), names), 1), axis=0)
        has, at = np.unique(pair[:, 0].astype(np.int64), return_inverse=True)
        self.ids = self.ids[has]
        self.names = pair[:, 1]
        self.start = np.searchsorted(at, np.arange(len(has) + 1))
        self.vocabulary, self.of = np.unique(self.names, return_inverse=True)

    def weighted(self, weights: np.ndarray) -> Items:
        """``weights`` of the vocabulary, kept by term."""
        self.weight = weights[self.of]
        return self


def _counts(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term of ``vocabulary``, then those with any term, and all terms with repeats."""
    total = np.zeros(len(vocabulary) + 2, np.int64)
    for whole in batches:
        for batch in slices(whole, 0, SLICE_BYTES):
            rows, names = terms(batch.column(0))
            if not len(rows):
                continue
            total[-2] += len(np.unique(rows))
            total[-1] += len(rows)
            at = np.minimum(np.searchsorted(vocabulary, names), len(vocabulary) - 1)
            known = vocabulary[at] == names
            pair = np.unique(rows[known] * len(vocabulary) + at[known])
            total[:-2] += np.bincount(pair % len(vocabulary), minlength=len(vocabulary))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "documents"])


class Slice:
    """The terms of a few documents with their impacts, and the sketches of the documents."""

    def __init__(self, texts: pa.Array, n_docs: int, n_terms: int):
        rows, names = terms(texts)
        size = np.bincount(rows, minlength=len(texts))
        self.m = 10 + 90 * size * n_docs // max(1, n_terms)
        self.keys, first, tf = np.unique(_keys(rows, names), return_index=True, return_counts=True)
        rows, names = rows[first], names[first]
        self.impact = 1_000_000_000 * tf // (1000 * tf + 8 * self.m[rows])
        self.sketch = np.zeros((len(texts), WIDTH), np.int32)
        np.maximum.at(self.sketch.reshape(-1), rows * WIDTH + _place(names), self.impact.astype(np.int32))

    def bounds(self, items: Items, low: int, high: int) -> np.ndarray:
        """Upper bounds of the scores of the items ``low`` to ``high`` (rows) in all documents (columns)."""
        part = slice(items.start[low], items.start[high])
        place, weight, begin = _place(items.names[part]), items.weight[part], items.start[low:high] - items.start[low]
        step = max(1, HELD // len(place))
        rows = range(0, len(self.sketch), step)
        return np.concatenate([np.add.reduceat(self.sketch[r : r + step, place] * weight, begin, axis=1) for r in rows]).T

    def scores(self, items: Items, item: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The exact scores of pairs of item and document."""
        size = items.start[item + 1] - items.start[item]
        begin = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(begin - items.start[item], size)
        wanted = _keys(np.repeat(doc, size), items.names[at])
        found = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        value = np.where(self.keys[found] == wanted, self.impact[found], 0) * items.weight[at]
        return np.add.reduceat(value, begin)


def _place(names: np.ndarray) -> np.ndarray:
    return (names & np.uint64(WIDTH - 1)).astype(np.int64)


class Best:
    """The ``k`` highest scores above 0 of each item, of equal scores the smaller ids."""

    def __init__(self, n: int, k: int):
        self.k, self.scored = k, 0
        self.score = np.zeros((n, k), np.int64)
        self.doc = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        self.scored += len(item)
        here = np.unique(item)
        row = np.concatenate((np.repeat(here, self.k), item))
        score = np.concatenate((self.score[here].ravel(), score))
        doc = np.concatenate((self.doc[here].ravel(), np.where(score[len(here) * self.k :] > 0, doc, np.iinfo(np.int64).max)))
        by = np.lexsort((doc, -score, row))
        take = by[np.searchsorted(row[by], here)[:, None] + np.arange(self.k)]
        self.score[here], self.doc[here] = score[take], doc[take]


def rescored(part: Slice, ids: np.ndarray, items: Items, best: Best) -> None:
    """Takes the documents ``ids`` of a slice into ``best``: exact scores by descending bound, until the threshold."""
    if not len(part.keys):
        return
    low = 0
    while low < len(items.ids):
        room = items.start[low] + max(1, HELD // len(ids))
        high = max(low + 1, int(np.searchsorted(items.start, room, "right")) - 1)
        bound = part.bounds(items, low, high)
        order = np.argsort(-bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, order, axis=1)
        open_items, at = np.arange(low, high), 0
        while at < len(ids) and len(open_items):
            # A document at the threshold may still be the smaller id.
            reach = (bound[open_items - low, at : at + STEP] >= best.score[open_items, -1:]) & (bound[open_items - low, at : at + STEP] > 0)
            row, col = np.nonzero(reach)
            if not len(row):
                break
            item, doc = open_items[row], order[open_items[row] - low, at + col]
            step = max(1, HELD // int(np.diff(items.start)[item].max()))
            for first in range(0, len(item), step):
                some = slice(first, first + step)
                best.add(item[some], ids[doc[some]], part.scores(items, item[some], doc[some]))
            open_items, at = open_items[reach[:, -1]], at + STEP
        low = high


def _search(batches: Iterator[pa.RecordBatch], items: Items, n_docs: int, n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    best = Best(len(items.ids), k)
    for whole in batches:
        for batch in slices(whole, 1, SLICE_BYTES):
            for low in range(0, batch.num_rows, 1024):
                some = batch.slice(low, 1024)
                rescored(Slice(some.column(1), n_docs, n_terms), some.column(0).to_numpy(), items, best)
    item, place = np.nonzero(best.score)
    columns = [pa.array(items.ids[item]), pa.array(best.doc[item, place]), pa.array(best.score[item, place])]
    yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 for each item.

    ``docs`` has ``doc_id`` (integer) and ``text``, ``items`` has ``item_id`` (integer) and ``text``. A term is a run of
    ASCII letters, digits and all characters beyond ASCII, only A-Z lower-cased. The score sums ``weight * impact`` over the
    item's different terms; ``weight = floor(1000 * ln((2 N + 2) / (2 df + 1)))`` with the documents N that hold any term and
    df that hold this one, ``m = 10 + (90 n N) div L`` with the document's terms n and all terms L.

    Equal scores go by the smaller doc_id. Null and empty texts have no terms and do not count in N. Documents without
    an id count in N, L and df but are not ranked; repeated documents are ranked one by one, repeated items are
    one item with the terms of all its rows, and items without an id or a term have no rows. Texts are taken
    whole. Other columns are not read. Empty tables give no rows. Terms are compared by 64-bit hashes.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    asked = written(items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), text.alias("text")), "search-items")
    blocks = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    path, done = shared_dir(docs.sparkSession, "search-ranked"), 0
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow().combine_chunks()
        block = Items(rows.column("item_id"), rows.column("text"))
        if not len(block.ids):
            continue
        counted = found.select("text").mapInArrow(lambda p, v=block.vocabulary: _counts(p, v), "term int, documents long")
        total = np.zeros(len(block.vocabulary) + 2, np.int64)
        for r in counted.groupBy("term").agg(F.sum("documents").alias("n")).collect():  # a row for each term of the block
            total[r.term] = r.n
        n_docs, n_terms = int(total[-2]), int(total[-1])
        block.weighted(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * total[:-2] + 1))).astype(np.int64))
        best = found.where(F.col("doc_id").isNotNull()).mapInArrow(
            lambda p, i=block, n=n_docs, t=n_terms: _search(p, i, n, t, k), "item_id long, doc_id long, score long"
        )
        best.write.parquet(f"{path}/block={b}")
        done += 1
    if not done:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc("doc_id")]
    near = docs.sparkSession.read.parquet(path).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("rank") <= k)
    last = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return last.select("item_id", "rank", "doc_id", "score")
