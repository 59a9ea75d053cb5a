"""Groups of spelling variants: words one code point apart, found by bitsets over the vocabulary.

For a block of words, one bitset per (position, code point) marks the words that have it there. A query reads its
own code points from left to right and keeps four bitsets: the words that agree so far without an error, and those
that agree with one replaced, one more or one missing code point. Each step is a few word-parallel operations;
the sets with an error follow the bitsets of the next or the previous position.

Of two words one code point apart either the first half or the last is the same, so only words that share a half and
the length of the longer one meet. A half that many words share is cut into blocks that all its words query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import written

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form has at least so many times the word's occurrences.
FORM_RATIO = 5
#: One run in so many loses a code point, as if mistyped.
MISTYPED = 199
#: Words of one shared half that are indexed together, and about the rows that one table of bitsets covers.
BLOCK = 2048
#: Queries that go through the recurrence at once.
CHUNK = 256


def runs(docs: DataFrame) -> DataFrame:
    """``word`` of every run of letters in ``docs``, lower-cased, after the stated deletions; only those long enough."""
    low = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = docs.select(doc.alias("doc"), F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"))
    found = found.where(F.length("run") >= LEAST_LENGTH)
    hashed = found.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % MISTYPED == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the distinct words of :func:`runs` with their occurrences, if at least ``least``."""
    counted = runs(docs).where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least)


class Index:
    """Bitsets over a block of words: which have a code point at a position, and which have a length."""

    def __init__(self, words: list[str]):
        self.words = words
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        size = np.array([len(w) for w in words])
        self.size = size
        row = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(codes)) - (np.cumsum(size) - size)[row]
        self.width = -(-len(words) // 64)
        self.alphabet, letter = np.unique(codes, return_inverse=True)
        # The last letter and the last two positions are empty: what queries ask for beyond the block.
        self.depth = int(size.max(initial=0)) + 2
        bits = np.zeros((self.depth, len(self.alphabet) + 1, self.width), np.uint64)
        np.bitwise_or.at(bits, (place, letter, row >> 6), np.uint64(1) << (row & 63).astype(np.uint64))
        self.bits = bits
        lengths = np.zeros((self.depth + 2, self.width), np.uint64)
        np.bitwise_or.at(lengths, (size, np.arange(len(words)) >> 6), np.uint64(1) << (np.arange(len(words)) & 63).astype(np.uint64))
        self.lengths = lengths

    def _at(self, position: int, letters: np.ndarray) -> np.ndarray:
        return self.bits[min(position, self.depth - 1)][letters]

    def _long(self, size: int) -> np.ndarray:
        return self.lengths[size] if 0 <= size < len(self.lengths) else np.zeros(self.width, np.uint64)

    def one_error(self, words: list[str]) -> np.ndarray:
        """For each of ``words``, all of one length, the bitset of the block's words exactly one error away."""
        m = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), m)
        letters = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        letters = np.where(self.alphabet[letters] == codes, letters, len(self.alphabet))
        none = np.zeros((len(words), self.width), np.uint64)
        exact, replaced, more, fewer = ~none, none, none, none
        for i in range(m):
            here = self._at(i, letters[:, i])
            # What has one code point fewer stands one position earlier, what has one more a position later.
            missed = fewer & self._at(i - 1, letters[:, i]) | exact if i else exact
            more = (more | exact) & self._at(i + 1, letters[:, i])
            replaced = replaced & here | exact & ~here
            exact, fewer = exact & here, missed
        found = replaced & self._long(m)
        found |= (more | exact) & self._long(m + 1)
        found |= fewer & self._long(m - 1)
        return found


def _hits(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bit of everything set in ``found``."""
    row, word = np.nonzero(found)
    bits = np.unpackbits(found[row, word].astype("<u8")[:, None].view(np.uint8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return row[at], word[at] * 64 + bit


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell: every word with the indexed words of its cell that are one error away."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        if held.num_rows < 2 * BLOCK:
            continue
        key = held.column("cell").to_numpy()
        cut = np.flatnonzero(key[1:] != key[:-1]) + 1
        if len(cut):
            yield from _block(held.slice(0, int(cut[-1])))
            held = held.slice(int(cut[-1])).combine_chunks()
    if held is not None and held.num_rows:
        yield from _block(held)


def _block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The pairs within each cell; neighbouring cells are indexed together, a pair found across cells is dropped."""
    cell = rows.column("cell").to_numpy()
    start = np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]))
    low = 0
    while low < len(start) - 1:
        high = max(low + 1, int(np.searchsorted(start, start[low] + BLOCK, "right")) - 1)
        part = rows.slice(int(start[low]), int(start[high] - start[low]))
        low = high
        words, counts = np.array(part.column("word").to_pylist(), object), part.column("n").to_numpy()
        cells = part.column("cell").to_numpy()
        own = np.flatnonzero(part.column("own").to_numpy(zero_copy_only=False))
        index = Index(words[own].tolist())
        if not len(own):
            continue
        size = np.array([len(w) for w in words])
        for m in np.unique(size):
            of_size = np.flatnonzero(size == m)
            for first in range(0, len(of_size), CHUNK):
                asked = of_size[first : first + CHUNK]
                q, hit = _hits(index.one_error(words[asked].tolist()))
                q, hit = asked[q], own[hit]
                same = cells[q] == cells[hit]
                q, hit = q[same], hit[same]
                if len(q):
                    columns = [pa.array(words[q], pa.string()), pa.array(words[hit], pa.string()), pa.array(counts[hit])]
                    yield pa.RecordBatch.from_arrays(columns, ["word", "near", "near_n"])


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: every ordered pair of different ``words`` (``word``, ``n``) one code point apart."""

    def halves(longer: Column) -> list[Column]:
        first = F.floor((longer - 1) / 2).cast("int")
        size = F.length("word")
        head = F.concat(F.lit("<"), longer.cast("string"), F.lit(":"), F.substring("word", F.lit(1), first))
        last = longer - 1 - first
        tail = F.concat(F.lit(">"), longer.cast("string"), F.lit(":"), F.substring("word", size - last + 1, last))
        return [head, tail]

    keys = F.array(*halves(F.length("word")), *halves(F.length("word") + 1))
    placed = words.select("word", "n", F.explode(keys).alias("half"))
    sizes = placed.groupBy("half").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = sizes.select("half", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int").alias("blocks"))
    rows = placed.join(sizes, "half").withColumn("mine", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(F.xxhash64("half", "block").alias("cell"), "word", "n", (F.col("mine") == F.col("block")).alias("own"))
    dealt = rows.repartition("cell").sortWithinPartitions("cell", "word")
    # A pair that shares both halves is found twice.
    return dealt.mapInArrow(_cells, "word string, near string, near_n long").distinct()


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of ``docs`` (``doc_id``, ``text``).

    A word is a run of letters, A-Z lower-cased, of six code points or more that occurs five times or more; one
    occurrence in 199 (by a checksum of doc_id and run) first loses a code point. ``n_near`` counts the words exactly one
    inserted, deleted or replaced code point away. ``form`` is the most frequent of them (ties: the smallest), if
    it has five times the word's ``n``, else null; ``root`` is reached by following forms.

    Null texts hold no words, a null doc_id counts as an empty one, repeated rows count as often as they
    stand there. Texts are taken whole. Columns of other names are not read. An empty table gives no rows.
    """
    words = written(vocabulary(docs), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    fits = -F.col("best.less") >= F.col("n") * FORM_RATIO
    named = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"),
        F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    named = written(named, "spelling-forms")
    # Pointer doubling: a form has five times the occurrences, so chains are short whatever the vocabulary.
    to = written(named.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-roots")
    while not to.join(to.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
        step = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        to = written(to.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return named.join(to, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
