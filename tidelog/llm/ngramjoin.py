"""Documents whose sets of five-word shingles overlap to 80 % or more, by vertical partitioning.

All shingles have one global order: those that many documents share come last, by their count, all others
before them by their hash. Each set, sorted by that order, is cut at the same pivots into fragments. A pair's
overlap is the sum of the overlaps of its fragments, and every fragment is counted on its own.

Pairs are counted only where they can reach the threshold: two such sets share a shingle among the first
``n - ceil(0.8 n) + 1`` of each, and what follows their first common shingle must be long enough. A bucket of
sets that share such a shingle is first compared with the set in which the shingle stands earliest, the text
that others are copies of. Only sets that this leaves in different components are then compared with each
other, so groups of copies cost no pairs and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.components import connected
from tidelog.llm.textbytes import column_bytes, mix, shingles, slices
from tidelog.session import written

WORDS = 5
#: Shingles with a rank of their own at the end of the order. A bound of what is broadcast, not of what is compared.
RANKED = 65_536
FRAGMENTS = 16
#: Sets of one bucket, or partners of one set, that a task takes together.
BLOCK = 512
#: Nodes with so many times fewer rows than the table are copied freely; the others (fewer than this) emit once.
COPIES_SHARE = 1000
#: Parts of the shingles' hashes whose counts bound a pair's overlap: at least two to this power.
LEAST_BITS = 4
#: Comparisons of two rows of a cell at a time.
STEP = 1_000_000
#: Slots of the filter that spares texts without candidates the shuffle. With more candidates it spares less, no more.
SLOTS = 1 << 20
SLICE_BYTES = 2_000_000

#: Words end at blanks, tabs and line ends only.
_INSIDE = np.ones(256, bool)
_INSIDE[[32, 9, 10, 11, 12, 13]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_OTHER = np.uint64(0x6A09E667F3BCC909)
_LATE = np.uint64(1 << 63)
_FULL = 255


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all rows, and the offsets of the rows; each row's are in no order."""
    data, offsets = column_bytes(column)
    rows, names, _ = shingles(_LOWER[data], offsets, WORDS, _INSIDE)
    by = np.argsort(rows, kind="stable")
    return names[by], np.searchsorted(rows[by], np.arange(len(column) + 1))


def _digests(names: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, the same in whatever order its shingles come."""
    out = []
    for mixed in (mix(names), mix(names ^ _OTHER)):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)))
        out.append((total[start[1:]] - total[start[:-1]]).view(np.int64))
    return out[0], out[1]


def _binary(high: np.ndarray, low: np.ndarray) -> pa.Array:
    raw = np.stack((high, low), 1).astype(">i8").tobytes()
    return pa.Array.from_buffers(pa.binary(16), len(high), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _new(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The first row of each set in a slice."""
    _, at = np.unique(np.stack((high, low), 1), axis=0, return_index=True)
    return np.sort(at)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and one for each shingle that several sets of a slice hold."""
    for whole in batches:
        for batch in slices(whole, 2, SLICE_BYTES):
            names, start = _sets(batch.column(2))
            high, low = _digests(names, start)
            size = np.diff(start)
            ids = batch.column(0)
            none = pa.nulls(batch.num_rows, pa.int64())
            columns = [ids, batch.column(1), _binary(high, low), pa.array(size, pa.int64()), _profiles(names, size), none, none]
            yield pa.RecordBatch.from_arrays(columns, _SCANNED)
            kept = _new(high, low)
            held = np.repeat(np.isin(np.arange(len(size)), kept), size)
            shared, count = np.unique(names[held], return_counts=True)
            shared, count = shared[count > 1].view(np.int64), count[count > 1]
            blank = [pa.nulls(len(shared), t) for t in (ids.type, pa.binary(), pa.binary(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*blank, pa.array(shared), pa.array(count, pa.int64())], _SCANNED)


_SCANNED = ["doc_id", "text_key", "node", "n", "profile", "shingle", "sets"]


def _profiles(names: np.ndarray, size: np.ndarray) -> pa.Array:
    """How many shingles of each set fall into equal parts of the hashes: one byte a part, four to eight shingles on average."""
    bits = np.maximum(LEAST_BITS, np.ceil(np.log2(np.maximum(1, size / 8)))).astype(np.int64)
    start = np.concatenate(([0], np.cumsum(1 << bits)))
    row = np.repeat(np.arange(len(size)), size)
    part = (names >> (np.uint64(64) - bits[row].astype(np.uint64))).astype(np.int64)
    count = np.bincount(start[row] + part, minlength=int(start[-1]))
    raw = np.minimum(count, _FULL).astype(np.uint8).tobytes()
    return pa.array([raw[s:e] for s, e in zip(start[:-1].tolist(), start[1:].tolist())], pa.binary())


def _most(x: bytes, y: bytes) -> int:
    """The largest overlap that two profiles allow; the finer one is folded to the parts of the coarser."""
    x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (x, y))
    parts = min(len(x), len(y))
    x, y = (np.where(v == _FULL, 2**40, v).reshape(parts, -1).sum(1) for v in (x, y))
    return int(np.minimum(x, y).sum())


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose parts, each with the smaller count of the two, hold enough together."""
    for batch in batches:
        most = [_most(x, y) for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
        yield batch.filter(pa.array(np.array(most, np.int64) >= batch.column(2).to_numpy())).select(["a", "b", "need"])


class Order:
    """The global order of shingles as unsigned integers, and the pivots that cut it."""

    def __init__(self, ranked: np.ndarray, counts: np.ndarray, total: int):
        """``ranked``: the most frequent shingles, rarest first; ``total``: shingles of all sets."""
        self.names = np.sort(ranked)
        self.rank = np.argsort(ranked).astype(np.uint64)
        late = int(counts.sum())
        early = max(1, total - late)
        running = np.cumsum(counts)
        cuts = []
        for k in range(1, FRAGMENTS):
            at = (early + late) * k / FRAGMENTS
            cuts.append(int(at / early * 2**63) if at < early else 2**63 + int(np.searchsorted(running, at - early)))
        self.pivots = np.array(cuts, np.uint64)

    def of(self, names: np.ndarray) -> np.ndarray:
        place = names >> np.uint64(1)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
            place = np.where(self.names[at] == names, _LATE + self.rank[at], place)
        return place


def _prefixes(batches: Iterator[pa.RecordBatch], order: Order, copied: dict[bytes, object]) -> Iterator[pa.RecordBatch]:
    """The first shingles of each set by the order, with their place: enough to share one with every similar set."""
    for whole in batches:
        for batch in slices(whole, 1, SLICE_BYTES):
            names, start = _sets(batch.column(1))
            high, low = _digests(names, start)
            size = np.diff(start)
            kept = np.flatnonzero(size)
            if copied:
                keys, ids = _binary(high[kept], low[kept]).to_pylist(), batch.column(0).take(pa.array(kept)).to_pylist()
                kept = kept[np.array([copied.get(k, i) == i for k, i in zip(keys, ids)], bool)]
            kept = kept[_new(high[kept], low[kept])]
            row = np.repeat(np.arange(len(size)), size)
            place = order.of(names)
            by = np.lexsort((place, row))
            at = np.arange(len(by)) - start[row]
            wanted = np.zeros(len(size), bool)
            wanted[kept] = True
            take = wanted[row] & (at <= size[row] - (4 * size[row] + 4) // 5)
            row, at = row[take], at[take]
            columns = [place[by][take].view(np.int64), high[row], low[row], at.astype(np.int64), size[row]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shingle", "high", "low", "at", "n"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shingle, place and node, each with the first of its bucket; ``more`` marks buckets of three or more.

    Repeats and shingles of one node are left out. Of a bucket of two only the second row is kept, if
    the pair can reach the threshold.
    """
    held = np.zeros((0, 5), np.int64)  # rows of the open bucket that are not out yet: two at most
    last, lead, seen = None, None, 0
    for end, batch in _then_none(batches):
        rows = held if end else np.concatenate((held, np.stack([c.to_numpy() for c in batch.columns], 1)))
        if not len(rows):
            continue
        before = np.concatenate((rows[:1] if last is None else last[None], rows[:-1]))
        new = (rows[:, :3] != before[:, :3]).any(1)
        new[0] |= last is None
        last = rows[-1]
        rows = rows[new]
        if not len(rows):
            continue
        goes_on = bool(seen and rows[0, 0] == lead[0])
        first = np.ones(len(rows), bool)
        first[1:] = rows[1:, 0] != rows[:-1, 0]
        start = np.flatnonzero(first)
        size = np.diff(np.append(start, len(rows)))
        hubs = rows[start]
        total = size.copy()
        if goes_on:
            hubs[0], total[0] = lead, total[0] + seen
        hub, total = np.repeat(hubs, size, axis=0), np.repeat(total, size)
        out = total > 1
        pair = total == 2
        out[pair] &= ~first[pair] & (9 * np.minimum(rows[pair, 4] - rows[pair, 3], hub[pair, 4] - hub[pair, 3]) >= 4 * (rows[pair, 4] + hub[pair, 4]))
        stop = len(rows)
        if not end and total[-1] < 3:
            stop = int(start[-1])
            held, seen, last = rows[stop:], 0, None
            # The held rows are compared anew with what follows them.
        else:
            held, lead, seen = rows[:0], hub[-1], int(total[-1])
        out, hub, more = rows[:stop][out[:stop]], hub[:stop][out[:stop]], total[:stop][out[:stop]] > 2
        if len(out):
            columns = [pa.array(out[:, 0]), _binary(out[:, 1], out[:, 2]), pa.array(out[:, 3]), pa.array(out[:, 4])]
            columns += [_binary(hub[:, 1], hub[:, 2]), pa.array(hub[:, 3]), pa.array(hub[:, 4]), pa.array(more)]
            yield pa.RecordBatch.from_arrays(columns, ["shingle", "node", "at", "n", "hub", "hub_at", "hub_n", "more"])


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for batch in batches:
        if batch.num_rows:
            yield False, batch
    yield True, None


def _segments(batches: Iterator[pa.RecordBatch], order: Order) -> Iterator[pa.RecordBatch]:
    """Each set's part in each fragment, as sorted 64-bit places."""
    for whole in batches:
        for batch in slices(whole, 1, SLICE_BYTES):
            names, start = _sets(batch.column(1))
            row = np.repeat(np.arange(batch.num_rows), np.diff(start))
            place = order.of(names)
            by = np.lexsort((place, row))
            place = place[by]
            key = row * FRAGMENTS + np.searchsorted(order.pivots, place, "right")
            cut = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)])) if len(key) else np.zeros(1, np.int64)
            raw = place.tobytes()
            parts = pa.array([raw[8 * s : 8 * e] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())], pa.binary())
            key = key[cut[:-1]]
            fragment = pa.array((key % FRAGMENTS).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(key // FRAGMENTS)), fragment, parts], ["node", "fragment", "places"])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted so that a set's fragment (``b`` null) precedes its partners' same fragments: the overlap with each."""
    held = np.zeros(0, np.uint64)
    for batch in batches:
        data, offsets = column_bytes(batch.column(3))
        data, offsets = np.frombuffer(data.tobytes(), np.uint64), offsets // 8
        lead = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        bounds = [0, *np.flatnonzero(lead).tolist(), batch.num_rows]
        common = np.zeros(batch.num_rows, np.int64)
        for low, high in zip(bounds, bounds[1:]):
            if low < high and lead[low]:
                held = data[offsets[low] : offsets[low + 1]]
                low += 1
            if low < high and len(held):
                part = data[offsets[low] : offsets[high]]
                hit = held[np.minimum(np.searchsorted(held, part), len(held) - 1)] == part
                total = np.concatenate(([0], np.cumsum(hit)))
                common[low:high] = total[offsets[low + 1 : high + 1] - offsets[low]] - total[offsets[low:high] - offsets[low]]
        take = pa.array(np.flatnonzero(common))
        columns = [batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take), pa.array(common).take(take)]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "need", "overlap"])


def _linked(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, order: Order) -> DataFrame:
    """The pairs (``a``, ``b``, ``need``) whose fragments' overlaps sum to ``need`` or more."""
    profile = lambda c: nodes.select(F.col("node").alias(c), F.col("profile").alias(f"{c}_profile"))
    known = pairs.hint("merge").join(profile("a"), "a").join(profile("b").hint("merge"), "b").select("a", "b", "need", "a_profile", "b_profile")
    pairs = written(known.mapInArrow(_possible, "a binary, b binary, need long"), "join-pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    keys = written(nodes.join(wanted.hint("merge"), "node").select("node", "text_key"), "join-keys")
    slot = F.pmod(F.xxhash64("text_key"), F.lit(SLOTS)).cast("int").alias("slot")
    some = texts.withColumn("slot", slot).join(F.broadcast(keys.select(slot).distinct()), "slot", "left_semi")
    named = some.select("text_key", "text").dropDuplicates(["text_key"]).join(keys.hint("merge"), "text_key").select("node", "text")
    segments = written(named.mapInArrow(lambda b: _segments(b, order), "node binary, fragment int, places binary"), "join-segments")

    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = pairs.join(blocks, "a").select("a", "b", "need", F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("block"))
    partners = dealt.join(segments.withColumnRenamed("node", "b").hint("merge"), "b").select("a", "b", "need", "places", "fragment", "block")
    none = [F.lit(None).cast("binary").alias("b"), F.lit(None).cast("long").alias("need")]
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    own = blocks.select("a", each).join(segments.withColumnRenamed("node", "a").hint("merge"), "a").select("a", *none, "places", "fragment", "block")
    rows = partners.union(own).repartition("a", "fragment", "block").sortWithinPartitions("a", "fragment", "block", F.asc_nulls_first("b"))
    counted = rows.select("a", "b", "need", "places").mapInArrow(_partial, "a binary, b binary, need long, overlap long")
    total = counted.groupBy("a", "b", "need").agg(F.sum("overlap").alias("overlap"))
    return written(total.where("overlap >= need").select("a", "b"), "join-links")


def _open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell: the pairs of different labels that may still reach the threshold after their common shingle."""
    held: pa.Table | None = None
    for end, batch in _then_none(batches):
        table = held if end else pa.Table.from_batches([batch])
        if not end and held is not None:
            table = pa.concat_tables([held, table])
        if table is None or not table.num_rows:
            continue
        key = np.stack((table.column("shingle").to_numpy(), table.column("block").to_numpy()), 1)
        cuts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [table.num_rows]))
        whole = int(cuts[-1 if end else -2])
        yield from _cell_pairs(table.slice(0, whole), cuts[: len(cuts) if end else -1])
        held = None if end else table.slice(whole).combine_chunks()


def _cell_pairs(rows: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The open pairs of all cells of ``rows``, which lie between ``cuts``; ``STEP`` comparisons at a time."""
    n, at = (rows.column(c).to_numpy() for c in ("n", "at"))
    rest = n - at
    node, label = (rows.column(c).combine_chunks() for c in ("node", "label"))
    label = label.dictionary_encode().indices.to_numpy()
    inner, own = (rows.column(c).to_numpy() for c in ("inner", "own"))
    size = np.diff(cuts)
    start, size = np.repeat(cuts[:-1], size), np.repeat(size, size)
    asks = np.flatnonzero(~inner)
    work = np.cumsum(size[asks])
    low = 0
    while low < len(asks):
        high = max(low + 1, int(np.searchsorted(work, (work[low - 1] if low else 0) + STEP, "right")))
        r = asks[low:high]
        low = high
        left = np.repeat(r, size[r])
        right = np.arange(len(left)) - np.repeat(np.cumsum(size[r]) - size[r], size[r]) + start[left]
        # Of two rows that are both dealt to all blocks the pair belongs to the block of the later one.
        fits = own[right] & (label[right] != label[left]) & (inner[right] | ~own[left] | (right > left))
        fits &= 9 * np.minimum(rest[left], rest[right]) >= 4 * (n[left] + n[right])
        left, right = left[fits], right[fits]
        if len(left):
            need = (4 * (n[left] + n[right]) + 8) // 9
            yield pa.RecordBatch.from_arrays([node.take(pa.array(left)), node.take(pa.array(right)), pa.array(need)], ["a", "b", "need"])


def _across(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of sets of different components in the buckets that hold several.

    Rows of the component of a bucket's first set are dealt to blocks, all others meet every block; only pairs
    that the length behind their common shingle allows leave a cell.
    """
    named = buckets.where("more").join(labels, "node", "left")
    named = named.select("shingle", "node", "at", "n", "hub", F.coalesce("label", "node").alias("label"))
    sizes = named.groupBy("shingle").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.max(F.when(F.col("node") == F.col("hub"), F.col("label"))).alias("main"),
    )
    sizes = sizes.where("low <> high").select("shingle", "blocks", "main")
    rows = named.join(sizes, "shingle").withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("inner", F.col("label") == F.col("main"))
    to = F.when(F.col("inner"), F.array("mine")).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = rows.withColumn("block", F.explode(to)).withColumn("own", F.col("block") == F.col("mine"))
    dealt = cells.select("shingle", "block", "node", "label", "n", "at", "inner", "own").repartition("shingle", "block")
    dealt = dealt.sortWithinPartitions("shingle", "block", "node")
    found = dealt.mapInArrow(_open_pairs, "a binary, b binary, need long")
    return found.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "need").agg(F.lit(0)).select("a", "b", "need")


def similar_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(members, links)`` of the join of ``docs`` (``doc_id``, ``text``) with itself on its sets of shingles.

    ``members`` has one row per row of ``docs``: ``doc_id``, ``n_shingles``, ``node`` (digest of the set) and
    ``component_id``, the smallest doc_id of the rows that links reach from it. ``links`` has verified pairs of
    nodes, enough to connect every component. Two sets are linked when ``100 * common >= 80 * all``.

    Only A-Z are lower-cased; words are runs without blanks, tabs and line ends. A text under five words is one
    shingle; a null or blank text has an empty set, is linked with nothing and has its own doc_id as component.
    Equal sets are one node, so copies, ties and repeated rows are never paired. Very long texts are taken whole.
    A component without any doc_id has a null component_id. Columns of other names are not read. An empty
    table gives no rows. Shingles are compared by 63-bit hashes, sets by 128 bits.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", F.unhex(F.md5(text.cast("binary"))).alias("text_key"), text.alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    scanned = written(texts.mapInArrow(_scan, f"doc_id {id_type}, text_key binary, node binary, n long, profile binary, shingle long, sets long"), "join-scan")
    sets = scanned.where(F.col("n").isNotNull()).select("doc_id", "text_key", "node", "n", "profile")

    about = [F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("profile").alias("profile")]
    nodes = written(sets.where("n > 0").groupBy("node").agg(F.count(F.lit(1)).alias("rows"), *about), "join-nodes")
    n_rows, total = nodes.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    often = scanned.where(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("sets").alias("sets"))
    top = often.orderBy(F.desc("sets"), "shingle").limit(RANKED).toArrow()  # at most RANKED rows
    ranked, counts = (top.column(c).to_numpy()[::-1] for c in ("shingle", "sets"))
    order = Order(np.ascontiguousarray(ranked).astype(np.int64).view(np.uint64), np.asarray(counts, np.int64), total)
    # Fewer than COPIES_SHARE nodes hold more than that part of the rows.
    copied = {bytes(r.node): r.first_id for r in nodes.where(F.col("rows") * COPIES_SHARE > n_rows).select("node", "first_id").collect()}

    first = docs.select("doc_id", text.alias("text")).mapInArrow(lambda b: _prefixes(b, order, copied), "shingle long, high long, low long, at long, n long")
    first = first.repartition("shingle").sortWithinPartitions("shingle", "at", "high", "low").select("shingle", "high", "low", "at", "n")
    buckets = written(first.mapInArrow(_buckets, "shingle long, node binary, at long, n long, hub binary, hub_at long, hub_n long, more boolean"), "join-buckets")

    fits = F.expr("9 * least(n - at, hub_n - hub_at) >= 4 * (n + hub_n)")
    need = F.expr("(4 * (n + hub_n) + 8) div 9").alias("need")
    with_hub = buckets.where(F.col("node") != F.col("hub")).where(fits).select(F.col("hub").alias("a"), F.col("node").alias("b"), need).distinct()
    text_of = texts.select("text_key", "text")
    links = _linked(with_hub, nodes, text_of, order)
    labels = written(connected(links), "join-labels")
    more = _linked(_across(buckets, labels), nodes, text_of, order)

    # Labels of the second links join those of the first.
    side = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    joined = more.join(side("a"), "a", "left").join(side("b"), "b", "left")
    merged = connected(joined.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")))
    merged = merged.select(F.col("node").alias("label"), F.col("label").alias("new"))
    labelled = nodes.join(labels, "node", "left").select("node", "first_id", F.coalesce("label", "node").alias("label"))
    labelled = labelled.join(merged, "label", "left").select("node", "first_id", F.coalesce("new", "label").alias("label"))
    labelled = written(labelled, "join-components")
    ids = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_node = labelled.join(ids, "label").select("node", "component_id")
    full = sets.where("n > 0").join(by_node, "node").select("doc_id", F.col("n").alias("n_shingles"), "node", "component_id")
    empty = sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), "node", F.col("doc_id").alias("component_id"))
    return full.union(empty), links.union(more)
