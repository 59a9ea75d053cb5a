"""Benchmark passages in documents, up to an edit distance, by pigeonhole pieces and Myers' algorithm.

An item with an error budget of k is cut into k + 1 pieces: k edits cannot touch them all, so a passage
within the budget holds at least one piece as it is. All pieces of all items are searched in one
pass with an Aho-Corasick automaton; around each hit the distance is computed bit-parallel.

Both sides are lower-cased and runs of white space count as one blank; positions refer to that form.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidelog.session import written

#: Edits allowed per character of an item, rounded down.
ERROR_RATE = 0.05
#: Items are given to the tasks in blocks of about so many bytes; each block is one pass over the documents.
BLOCK_BYTES = 8_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal size with their places (fewer, if the item is shorter)."""
    n = min(errors + 1, len(item))
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(pattern: str, masks: dict[str, int], text: str, anchored: bool = False) -> tuple[int, int]:
    """Smallest edit distance of ``pattern`` to a part of ``text``, and the first end of such a part.

    The part may begin anywhere, or with ``anchored`` only at the start of ``text``.
    """
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | anchored) & full
        down = down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """The items of one block, ready for search."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float) -> None:
        import ahocorasick

        self.items = [(name, text, int(len(text) * error_rate)) for name, text in items if text]
        self.masks: dict[int, dict[str, int]] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, errors) in enumerate(self.items):
            for at, piece in pieces(text, errors):
                found.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def _verify(self, i: int, starts: list[int], text: str) -> tuple[int, int, int] | None:
        """The nearest passage to item ``i``: distance, start and end."""
        _, item, errors = self.items[i]
        m = len(item)
        starts = sorted(set(starts))
        for s in starts:
            if s >= 0 and text.startswith(item, s):
                return 0, s, s + m
        masks = self.masks.setdefault(i, _masks(item))
        best = None
        k = 0
        while k < len(starts):
            first = last = starts[k]
            while k < len(starts) and starts[k] <= last + 2 * errors + 1:
                last = starts[k]
                k += 1
            low = max(0, first - errors)
            distance, end = myers(item, masks, text[low : last + m + errors])
            if distance <= errors and (best is None or distance < best[0]):
                best = (distance, low + end)
        if best is None:
            return None
        distance, end = best
        back = text[max(0, end - m - errors) : end][::-1]
        _, length = myers(item[::-1], _masks(item[::-1]), back, anchored=True)
        return distance, end - length, end

    def search(self, text: str | None, any_is_enough: bool = False) -> list[tuple[object, int, int, int]]:
        """Item, distance, start and end of each item found in ``text``."""
        if not self.items:
            return []
        text = normal(text)
        hits: dict[int, list[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            begin = end - size + 1
            for i, at in places:
                hits.setdefault(i, []).append(begin - at)
        out = []
        for i, starts in sorted(hits.items()):
            if found := self._verify(i, starts, text):
                out.append((self.items[i][0], *found))
                if any_is_enough:
                    break
        return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of bounded size; equal rows once."""
    items = written(
        benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").distinct(), "benchmark"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES) or 1
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        yield [(r.item_id, normal(r.text)) for r in rows]


def contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """``doc_id, item_id, distance, start, end`` for every document and item found in it.

    One row per row of ``docs`` and item: the nearest passage, the first of equal ones. Null and empty
    texts match nothing, null and empty items are not searched, and an item with an empty budget must
    occur exactly. Texts are searched whole. Empty tables give no rows; other columns are not read.
    """
    id_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id")))
    arrow_item = to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = f"doc_id {id_type}, item_id {item_type}, distance int, start int, end int"
    out = None
    for items in _blocks(benchmark):

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, error_rate)
            for batch in batches:
                rows, found = [], []
                for row, text in enumerate(batch.column(1)):
                    hits = matcher.search(text.as_py())
                    rows += [row] * len(hits)
                    found += hits
                columns = list(zip(*found)) or [()] * 4
                ids = batch.column(0).take(pa.array(rows, pa.int64()))
                arrays = [ids, pa.array(columns[0], arrow_item), *[pa.array(c, pa.int32()) for c in columns[1:]]]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "distance", "start", "end"])

        part = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(search, schema)
        out = part if out is None else out.union(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item; null and empty texts stay."""
    at = docs.columns.index("text")
    for items in _blocks(benchmark):

        def keep(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, error_rate)
            for batch in batches:
                clean = [not matcher.search(text.as_py(), any_is_enough=True) for text in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
