"""Near-duplicate documents by ProbMinHash signatures, banding and verification.

A document is the weighted set of its five-word shingles (weight: how often one occurs). Each shingle
sends arrivals of a Poisson process whose rate is its weight to random registers, and a register
keeps the shingle that arrived first; two documents agree in a register with the probability of their
probability Jaccard similarity, sum over shared i of 1 / sum_j max(x_j / x_i, y_j / y_i), which is the
Jaccard similarity when all weights are 1. Arrivals later than the last first arrival change nothing,
so a shingle stops there.

Documents that agree in all registers of a band are candidates. A bucket of candidates is first compared
with one hub. Buckets that this leaves in several components are joined to groups and compared in blocks, so
that no link between two components is lost. Candidates whose signatures rule the threshold out are
dropped, the others are verified on their whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.components import connected
from tidelog.llm.rows import whole_row
from tidelog.llm.textbytes import column_bytes, mix, shingles, slices
from tidelog.session import written

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
#: How far below the threshold an estimate may lie: over five standard deviations of 96 registers.
MARGIN = 0.22
#: Nodes of a group that are compared with each other in one step.
BLOCK = 512
#: Bytes of their texts, of which a cell holds two blocks.
BLOCK_BYTES = 4_000_000
SLICE_BYTES = 1_500_000
#: Rows signed at once: with the registers this bounds the arrivals that are held, however short the texts are.
SLICE_ROWS = 1024

_ARRIVAL = np.uint64(0xA0761D6478BD642F)
_PLACE = np.uint64(0xE7037ED1A0B428DB)


def signatures(rows: np.ndarray, keys: np.ndarray, weights: np.ndarray, n_rows: int, registers: int = REGISTERS) -> np.ndarray:
    """For each row the 32-bit names of the shingles that reached its registers first."""
    first = np.full(n_rows * registers, np.inf)
    names = np.zeros(n_rows * registers, np.uint32)
    rate = np.bincount(rows, weights, n_rows)
    horizon = np.full(n_rows, np.inf)
    np.divide(registers * (np.log(registers) + 3), rate, out=horizon, where=rate > 0)
    limit = horizon.copy()
    time = np.zeros(len(rows))
    done = np.zeros(len(rows), np.int64)
    at = np.arange(len(rows))
    waiting: list[np.ndarray] = []
    while len(at) or waiting:
        if not len(at):
            # Rows with an unreached register go on beyond the horizon, all others are finished.
            open_rows = np.isinf(first.reshape(n_rows, registers).max(1))
            horizon[open_rows] *= 2
            limit = np.minimum(horizon, first.reshape(n_rows, registers).max(1))
            at = np.concatenate(waiting)
            at = at[open_rows[rows[at]]]
            waiting = []
            continue
        row = rows[at]
        block = np.clip(((limit[row] - time[at]) * weights[at]).astype(np.int64), 1, 4 * registers)
        owner = np.repeat(np.arange(len(at)), block)
        begin = np.cumsum(block) - block
        index = np.arange(len(owner)) - begin[owner] + done[at][owner]
        seed = keys[at][owner] + (index.astype(np.uint64) + np.uint64(1)) * _ARRIVAL
        draw = mix(seed)
        gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        running = np.cumsum(gap)
        base = running[begin] - gap[begin]
        arrival = time[at][owner] + (running - base[owner]) / weights[at][owner]
        place = ((mix(draw ^ _PLACE) >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
        cell = row[owner] * registers + place.astype(np.int64)
        earlier = arrival < first[cell]
        cell, hit, name = cell[earlier], arrival[earlier], keys[at][owner][earlier]
        order = np.argsort(-hit, kind="stable")
        first[cell[order]] = hit[order]
        names[cell[order]] = (name[order] >> np.uint64(32)).astype(np.uint32)
        time[at] = arrival[begin + block - 1]
        done[at] += block
        last = first.reshape(n_rows, registers).max(1)
        limit = np.minimum(horizon, last)
        alive = time[at] < last[row]
        within = time[at] <= limit[row]
        if np.any(alive & ~within):
            waiting.append(at[alive & ~within])
        at = at[alive & within]
    return names.reshape(n_rows, registers)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in (part.slice(low, SLICE_ROWS) for part in slices(whole, 2, SLICE_BYTES) for low in range(0, part.num_rows, SLICE_ROWS)):
            data, offsets = column_bytes(batch.column(2))
            rows, keys, weights = shingles(data, offsets, WORDS)
            names = signatures(rows, keys, weights, batch.num_rows)
            has = np.zeros(batch.num_rows, bool)
            has[rows] = True
            packed = pa.array([r.tobytes() if h else None for r, h in zip(names, has)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, pa.array(np.diff(offsets))], ["doc_id", "node", "sig", "bytes"])


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Exact probability Jaccard similarity of two weight vectors over the same elements."""
    both = (x > 0) & (y > 0)
    if not both.any():
        return 0.0
    ratio, share = np.unique(x[both] / y[both], return_counts=True)
    with np.errstate(divide="ignore"):
        order = np.argsort(own := np.where(y > 0, x / np.where(y > 0, y, 1), np.inf), kind="stable")
    own = own[order]
    below = np.concatenate(([0.0], np.cumsum(y[order])))
    above = np.concatenate(([0.0], np.cumsum(x[order])))
    cut = np.searchsorted(own, ratio, "left")
    total = above[-1] - above[cut] + ratio * below[cut]
    weight = {r: x[both][x[both] / y[both] == r].sum() for r in ratio}
    return float(sum(weight[r] / t for r, t in zip(ratio, total)))


def _pair_similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 2, SLICE_BYTES // 2):
            sets = []
            for column in (2, 3):
                rows, keys, counts = shingles(*column_bytes(batch.column(column)), WORDS)
                order = np.argsort(rows, kind="stable")
                sets.append((np.searchsorted(rows[order], np.arange(batch.num_rows + 1)), keys[order], counts[order]))
            (ca, ka, wa), (cb, kb, wb) = sets
            values = []
            for i in range(batch.num_rows):
                a, b = slice(ca[i], ca[i + 1]), slice(cb[i], cb[i + 1])
                names, at = np.unique(np.concatenate((ka[a], kb[b])), return_inverse=True)
                x, y = np.zeros(len(names)), np.zeros(len(names))
                n = a.stop - a.start
                x[at[:n]], y[at[n:]] = wa[a], wb[b]
                values.append(probability_jaccard(x, y))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.float64())], ["a", "b", "similarity"]
            )


def _estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = [
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, REGISTERS) for c in (2, 3)
        ]
        share = (sides[0] == sides[1]).mean(1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(share, pa.float64())], ["a", "b", "estimate"]
        )


def _cell_links(cell: pa.Table, threshold: float) -> pa.RecordBatch | None:
    """The verified links between different labels among the nodes of one cell."""
    sig = np.frombuffer(b"".join(cell.column("sig").to_pylist()), np.uint32).reshape(cell.num_rows, REGISTERS)
    label = cell.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
    block = cell.column("block").to_numpy()
    across = cell.column("i")[0].as_py() != cell.column("j")[0].as_py()
    rows, keys, counts = shingles(*column_bytes(cell.column("text").combine_chunks()), WORDS)
    order = np.argsort(rows, kind="stable")
    names, ids = np.unique(keys[order], return_inverse=True)
    counts = counts[order].astype(np.float64)
    start = np.searchsorted(rows[order], np.arange(cell.num_rows + 1))
    size = np.diff(start)
    weighted = np.maximum.reduceat(counts, start[:-1]) > 1
    mark = np.zeros(len(names), bool)
    found: list[tuple[int, int, float]] = []
    for r in range(cell.num_rows - 1):
        fits = (label[r + 1 :] != label[r]) & ((sig[r + 1 :] == sig[r]).mean(1) >= threshold - MARGIN)
        if across:
            fits &= block[r + 1 :] != block[r]
        others = np.flatnonzero(fits) + r + 1
        if not len(others):
            continue
        own = slice(start[r], start[r + 1])
        mark[ids[own]] = True
        low, high = int(others[0]), int(others[-1]) + 1
        common = np.add.reduceat(mark[ids[start[low] : start[high]]], start[low:high] - start[low], dtype=np.int64)[others - low]
        values = common / (size[r] + size[others] - common)
        unsure = weighted[others] | weighted[r]
        for o, value in zip(others[unsure | (values >= threshold)].tolist(), values[unsure | (values >= threshold)].tolist()):
            if weighted[r] or weighted[o]:
                its = slice(start[o], start[o + 1])
                both, at = np.unique(np.concatenate((ids[own], ids[its])), return_inverse=True)
                x, y = np.zeros(len(both)), np.zeros(len(both))
                x[at[: size[r]]], y[at[size[r] :]] = counts[own], counts[its]
                value = probability_jaccard(x, y)
            if value >= threshold:
                found.append((r, o, float(value)))
        mark[ids[own]] = False
    if not found:
        return None
    node = cell.column("node").combine_chunks()
    x, y, values = zip(*found)
    return pa.RecordBatch.from_arrays([node.take(pa.array(x)), node.take(pa.array(y)), pa.array(values, pa.float64())], ["a", "b", "similarity"])


def _in_cells(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, one cell after the other."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        first = table.column("first").combine_chunks().dictionary_encode().indices.to_numpy()
        keys = [first, table.column("i").to_numpy(), table.column("j").to_numpy()]
        new = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        bounds = [0, *new.tolist()]
        for low, high in zip(bounds, bounds[1:]):
            if (out := _cell_links(table.slice(low, high - low), threshold)) is not None:
                yield out
        held = table.slice(bounds[-1])
    if held is not None and held.num_rows and (out := _cell_links(held, threshold)) is not None:
        yield out


def _between(rest: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The links between different labels in the groups of ``rest`` (``first``, ``node``, ``label``).

    A group is cut into blocks of about ``BLOCK`` nodes and each pair of blocks is a cell of its own, so no
    task holds a group, and only links leave a cell.
    """
    one = _texts_of(rest.select("node"), texts)
    size = F.greatest(F.count(F.lit(1)) / F.lit(BLOCK), F.sum("bytes") / F.lit(BLOCK_BYTES))
    sizes = rest.select("first", "node").join(nodes.select("node", "bytes"), "node").groupBy("first").agg(F.ceil(size).cast("int").alias("blocks"))
    placed = rest.join(sizes, "first").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    full = placed.join(nodes.select("node", "sig"), "node").join(one, "node")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cells = full.select("first", "node", "label", "sig", "text", "block", other)
    cells = cells.select("first", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label", "sig", "text")
    dealt = cells.repartition("first", "i", "j").sortWithinPartitions("first", "i", "j")
    links = dealt.mapInArrow(lambda batches: _in_cells(batches, threshold), "a binary, b binary, similarity double")
    return written(links, "near-links")


def _texts_of(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """One text of each wanted node, by the same shuffle of the texts at every size of ``wanted``."""
    found = texts.join(wanted.hint("merge"), "node", "left_semi")
    return found.groupBy("node").agg(F.first("text").alias("text"))


def _verify(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs at or above the threshold: first by signature, then on the whole texts."""
    sig = nodes.select("node", "sig")
    estimated = (
        pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
        .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
        .mapInArrow(_estimates, "a binary, b binary, estimate double")
        .where(F.col("estimate") >= threshold - MARGIN)
    )
    likely = written(estimated, "near-likely")
    wanted = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    one = written(_texts_of(wanted, texts), "near-texts")
    verified = (
        likely.join(one.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
        .join(one.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
        .select("a", "b", "ta", "tb")
        .mapInArrow(_pair_similarity, "a binary, b binary, similarity double")
        .where(F.col("similarity") >= threshold)
    )
    return written(verified, "near-links")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``(members, links)`` of the near-duplicate graph of ``docs`` (columns ``doc_id``, ``text``).

    ``members`` has one row per row of ``docs``: ``doc_id``, ``node`` (digest of the text), ``class_id``
    (the smallest doc_id of its class), ``class_size`` (rows of the class) and ``kept`` (whether the row stands for its
    class; repeated rows all do). ``links`` has the verified
    pairs of different texts, ``a``, ``b`` and ``similarity``.

    Equal texts are one node, so copies are never paired. A null text counts as empty; texts without
    any word are linked to equal texts only. Texts under five words are one shingle. Repeated rows
    and repeated or null ids are rows like any other; a class of null ids only has a null class_id.
    Other columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("node"), F.lower(text).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed = written(texts.mapInArrow(_sign, f"doc_id {id_type}, node binary, sig binary, bytes long"), "near-signatures")
    nodes = written(
        signed.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig"), F.max("bytes").alias("bytes")),
        "near-nodes",
    )
    width = 4 * ROWS
    band = F.array(*[F.xxhash64(F.lit(b), F.substring("sig", 1 + b * width, width)) for b in range(BANDS)])
    banded = written(nodes.where(F.col("sig").isNotNull()).select("node", F.explode(band).alias("band")), "near-bands")
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = written(banded.join(sizes, "band"), "near-buckets")

    # A bucket's hub is the node with the most company in all its buckets: the text that others are copies of.
    company = shared.groupBy("node").agg(F.sum("size").alias("company"))
    hubs = shared.join(company, "node").groupBy("band").agg(F.max(F.struct("company", "node")).alias("hub"))
    pairs = (
        shared.join(hubs.select("band", F.col("hub.node").alias("hub")), "band")
        .where("node <> hub")
        .select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
        .distinct()
    )
    pairs = written(pairs, "near-pairs")
    links = _verify(pairs, nodes, texts, threshold)
    labels = connected(links)

    # Buckets that still hold several components: they and their neighbours are groups, compared in cells.
    labelled = shared.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    labelled = written(labelled, "near-open")
    split = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("center"))
    split = split.where("low <> high").select("band", "center")
    stars = written(labelled.join(split, "band").select(F.col("center").alias("a"), F.col("node").alias("b"), "label"), "near-stars")
    groups = connected(stars.select("a", "b")).withColumnRenamed("label", "first")
    rest = written(stars.select(F.col("b").alias("node"), "label").distinct().join(groups, "node"), "near-rest")
    more = _between(rest, nodes, texts, threshold)
    # The new links join components, so only their labels are connected anew.
    label = F.coalesce("label", "node")
    sides = [rest.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label")) for c in ("a", "b")]
    merged = connected(more.join(sides[0], "a").join(sides[1], "b").select(F.col("a_label").alias("a"), F.col("b_label").alias("b")))
    links = links.union(more)

    classed = nodes.join(labels, "node", "left").select("node", "first_id", "copies", label.alias("label"))
    new = merged.select(F.col("node").alias("label"), F.col("label").alias("new"))
    classed = classed.join(new, "label", "left").select("node", "first_id", "copies", F.coalesce("new", "label").alias("label"))
    classed = written(classed, "near-labels")
    # min() skips a null but orders a struct that holds one first: nodes of null ids only come last.
    first = F.min(F.struct(F.col("first_id").isNull().alias("unnamed"), "first_id", "node")).alias("first")
    ids = classed.groupBy("label").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"), first)
    by_node = classed.join(ids, "label").select("node", "class_id", "class_size", (F.col("node") == F.col("first.node")).alias("is_first"))
    members = signed.select("doc_id", "node").join(by_node, "node")
    return members.select("doc_id", "node", "class_id", "class_size", (F.col("is_first") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept")), links


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, with all columns: that of the smallest doc_id, and of repeated rows any one."""
    members, _ = near_duplicates(docs, threshold)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    wanted = members.where("kept").select(key.alias("id"), "node").distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # All columns ride in one struct, so that none can clash with the names used here.
    rows = docs.select(whole_row(docs), key.alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("node"))
    turn = F.row_number().over(Window.partitionBy("id", "node").orderBy("id"))
    first = rows.join(wanted, ["id", "node"]).withColumn("turn", turn).where("turn = 1")
    return first.select("row.*")
