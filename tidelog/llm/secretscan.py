"""Secrets in texts: all rules in one pass of one automaton, exact spans where it accepts.

A rule is a head and a class that must be repeated often enough. The automaton accepts where the class
has been repeated ``needed`` times, which keeps it small, so behind the start of every match. No match spans a byte that resets the automaton; only the stretches between resets in which a rule
accepted are matched again, for the exact leftmost spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.automaton import Automaton, compile_rules, scan
from tidelog.llm.textbytes import column_bytes, slices


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str  # the pattern up to the repeated class
    tail: str  # the repeated class
    least: int  # repetitions that a match needs; shorter ones are dropped
    ignore_case: bool = False
    needed: int = 6  # repetitions after which the automaton accepts, at most ``least``

    @property
    def searched(self) -> str:
        return f"{self.head}{self.tail}{{{self.needed}}}"

    @property
    def exact(self) -> re.Pattern:
        head = f"(?i:{self.head})" if self.ignore_case else self.head
        return re.compile(f"{head}({self.tail}+)".encode())


BASE = (
    Rule("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]", 8, True),
    Rule("access", r"AKIA", r"[A-Z0-9]", 12),
    Rule("hex", r"", r"[0-9a-f]", 32, needed=24),
)
#: Kinds beyond the base: keys of well-known public forms.
ADDED = (
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]", 36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]", 10),
)
SLICE_BYTES = 4_000_000


def compiled(rules: tuple[Rule, ...]) -> Automaton:
    return compile_rules([(r.searched, r.ignore_case) for r in rules])


def find(data: np.ndarray, offsets: np.ndarray, rules: tuple[Rule, ...], automaton: Automaton) -> list[list[tuple[int, int, int]]]:
    """For each row the spans (start, rule, end), in code points, by start and then by rule."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    if not len(data):
        return found
    exact = [r.exact for r in rules]
    # A reset byte between rows, so that no match spans two of them.
    gap = int(np.flatnonzero(automaton.resets)[0])
    spaced = np.insert(data, offsets[1:-1], gap)
    offsets = offsets + np.concatenate((np.arange(len(offsets) - 1), [len(offsets) - 2]))
    bits = scan(automaton, spaced)
    places = np.flatnonzero(bits)
    if not len(places):
        return found
    resets = np.concatenate(([-1], np.flatnonzero(automaton.resets[spaced]), [len(spaced)]))
    points = np.concatenate(([0], np.cumsum((spaced & 0xC0) != 0x80)))
    stretch = np.searchsorted(resets, places) - 1
    seen = np.zeros(len(resets), np.uint32)
    np.bitwise_or.at(seen, stretch, bits[places])
    for s in np.unique(stretch).tolist():
        low, high = int(resets[s]) + 1, int(resets[s + 1])
        row = int(np.searchsorted(offsets, low, "right")) - 1
        raw = spaced[low:high].tobytes()
        for k, pattern in enumerate(exact):
            if seen[s] >> k & 1:
                for m in pattern.finditer(raw):
                    if m.end(1) - m.start(1) >= rules[k].least:
                        begin, end = low + m.start(), low + m.end()
                        found[row].append((int(points[begin] - points[offsets[row]]), k, int(points[end] - points[offsets[row]])))
    for spans in found:
        spans.sort()
    return found


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED) -> DataFrame:
    """``doc_id`` and ``spans``, an array of (start, end, kind), for every row of ``docs``.

    Starts and ends are code points of the whole text, ends exclusive. A null or empty text has no spans.
    Matches of one kind are leftmost and do not overlap; too short ones are dropped without another
    try. Other columns are not read; an empty table gives no rows.
    """

    automaton = compiled(rules)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, SLICE_BYTES):
                found = find(*column_bytes(batch.column(1)), rules, automaton)
                listed = [[{"start": a, "end": b, "kind": rules[k].kind} for a, k, b in spans] for spans in found]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(listed, kind)], ["doc_id", "spans"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(search, f"doc_id {id_type}, spans array<struct<start: long, end: long, kind: string>>")
