"""Token ids of a corpus in block files: frequency ranks in a byte-aligned variable-length code.

Texts are encoded with the tokenizers library. Its result for a text is that of the text's pieces,
one after the other: no rule of the tokenizer used here looks across white space, nor across the
border between an ASCII letter and an ASCII digit or sign (but for the apostrophe, which is never
cut at). So each different piece of a batch is encoded once, and a worker remembers pieces.

An id is replaced by its rank by frequency over all documents. Ranks are written in one to four
bytes; their lengths, two bits each, stand four to a control byte in a block of their own, so that
a reader looks all lengths up in a table of 256 rows and gathers the data bytes with array operations.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.textbytes import column_bytes, slices, span_hashes
from tidelog.session import shared_dir, written

MAGIC = b"FRV1"
SLICE_BYTES = 4_000_000
#: Pieces that a worker remembers before it drops those that it has not seen again.
REMEMBERED = 1_000_000
#: Pieces that are encoded as one text.
GROUP = 100
#: A block is closed when it holds this many ids; a document is never split.
BLOCK_IDS = 1_000_000

_codes = np.arange(256)
_SPACE, _LETTER, _HIGH, _SIGN, _GLUE = 0, 1, 2, 3, 4
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[9, 10, 13, 32]] = _SPACE
_KIND[(_codes >= 65) & (_codes <= 90) | (_codes >= 97) & (_codes <= 122)] = _LETTER
_KIND[_codes >= 128] = _HIGH
_KIND[39] = _GLUE
_LOWER = np.where((_codes >= 65) & (_codes <= 90), _codes + 32, _codes).astype(np.uint8)
_MARK = b" \x01 "


class PieceEncoder:
    """Encodes batches of texts; remembers the ids of pieces by their hashes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.encode(_MARK.strip().decode(), add_special_tokens=False).ids
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.uses = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)

    def forget(self) -> None:
        """Drops the pieces that one batch only had, and of the others the least used; later uses count twice as much."""
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > REMEMBERED // 2:
            keep = np.sort(keep[np.argsort(-self.uses[keep], kind="stable")[: REMEMBERED // 2]])
        self.ids = self._ids_at(keep)
        self.keys, self.count, self.uses = self.keys[keep], self.count[keep], self.uses[keep] // 2
        self.begin = np.cumsum(self.count, dtype=np.int64) - self.count

    def _ids_at(self, at: np.ndarray) -> np.ndarray:
        """The ids of the remembered pieces ``at``, one after the other."""
        counts = self.count[at]
        total = np.cumsum(counts, dtype=np.int64)
        return self.ids[np.repeat(self.begin[at] - (total - counts), counts) + np.arange(total[-1] if len(total) else 0)]

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and the number of ids of each."""
        groups = [pieces[i : i + GROUP] for i in range(0, len(pieces), GROUP)]
        # A group is encoded as one text, unless the mark cannot be told from what the pieces hold.
        texts = [_MARK.join(g) for g in groups]
        joined = [len(self.mark) == 1 and t.count(_MARK.strip()) == len(g) - 1 for g, t in zip(groups, texts)]
        encoded = iter(self.tokenizer.encode_batch_fast([t.decode() for t, j in zip(texts, joined) if j], add_special_tokens=False))
        ids, counts = [], []
        for group, together in zip(groups, joined):
            if together:
                found = np.array(next(encoded).ids, self.ids.dtype)
                marks = found == self.mark[0]
                sizes = np.diff(np.flatnonzero(marks), prepend=-1, append=len(found)) - 1
                found, together = found[~marks], len(sizes) == len(group)
            if not together:
                apart = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in group], add_special_tokens=False)]
                found = np.array([i for one in apart for i in one], self.ids.dtype)
                sizes = np.array([len(one) for one in apart])
            ids.append(found)
            counts.append(sizes.astype(np.int32))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, and the number of ids of each row."""
        rows = len(offsets) - 1
        if not len(data):
            return self.ids[:0], np.zeros(rows, np.int64)
        kind = _KIND[data]
        cut = np.zeros(len(data), bool)
        cut[1:] = (kind[1:] == _LETTER) & (kind[:-1] == _SIGN) | (kind[1:] == _SIGN) & (kind[:-1] == _LETTER)
        cut[1:] |= kind[:-1] == _SPACE
        space = kind == _SPACE
        lower = _LOWER[data]
        # Rows that may hold the string of a special token are encoded as they are, in one piece.
        for row in np.unique(np.searchsorted(offsets, np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)), "right") - 1):
            inside = slice(offsets[row], offsets[row + 1])
            cut[inside], space[inside], lower[inside] = False, False, data[inside]
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        after = np.ones(len(data), bool)
        after[:-1] = cut[1:] | space[1:]
        starts = np.flatnonzero(cut & ~space)
        ends = np.flatnonzero(after & ~space) + 1
        piece_rows = np.searchsorted(offsets, starts, "right") - 1
        names, first, which = np.unique(span_hashes(lower, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, names)
        known = self.keys[np.minimum(at, len(self.keys) - 1)] == names if len(self.keys) else np.zeros(len(names), bool)
        if not known.all():
            fresh = np.flatnonzero(~known)
            raw = lower.tobytes()
            found, counts = self._encode_pieces([raw[a:b] for a, b in zip(starts[first[fresh]].tolist(), ends[first[fresh]].tolist())])
            begin = len(self.ids) + np.cumsum(counts, dtype=np.int64) - counts
            keys = np.concatenate((self.keys, names[fresh]))
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.begin = np.concatenate((self.begin, begin))[order]
            self.count = np.concatenate((self.count, counts))[order]
            self.uses = np.concatenate((self.uses, np.zeros(len(fresh), np.int32)))[order]
            self.ids = np.concatenate((self.ids, found))
            at = np.searchsorted(self.keys, names)
        self.uses[at] += 1
        at = at[which]
        ids = self._ids_at(at)
        per_row = np.bincount(piece_rows, self.count[at], rows).astype(np.int64)
        if len(self.keys) > REMEMBERED:
            self.forget()
        return ids, per_row


_encoders: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def id_dtype(tokenizer_path: str, end_id: int) -> str:
    """Unsigned integers that hold every id, used between the passes."""
    return "<u2" if max(_encoder(tokenizer_path).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int, dtype: str) -> DataFrame:
    """``doc_id`` and ``ids`` (integers of ``dtype``) of every row, ``end_id`` at the end."""
    size = np.dtype(dtype).itemsize

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for whole in batches:
            for batch in slices(whole, 1, SLICE_BYTES):
                ids, counts = encoder.encode(*column_bytes(batch.column(1)))
                ids = np.insert(ids.astype(dtype), np.cumsum(counts), end_id)
                ends = np.concatenate(([0], np.cumsum(counts + 1))) * size
                packed = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column(0), packed.cast(pa.binary())], ["doc_id", "ids"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(encode, f"doc_id {id_type}, ids binary")


def frequency_ranks(encoded: DataFrame, dtype: str) -> np.ndarray:
    """Ids by falling frequency, ties by id. There are no more of them than the vocabulary has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            data, _ = column_bytes(batch.column(0).cast(pa.large_binary()).view(pa.large_string()))
            seen = np.bincount(data.view(dtype)) if len(data) else np.zeros(0, np.int64)
            if len(seen) > len(total):
                seen[: len(total)] += total
                total = seen
            else:
                total[: len(seen)] += seen
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    counted = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = counted.collect()
    return np.array([r.id for r in sorted(rows, key=lambda r: (-r.n, r.id))], np.uint32)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ``ranks``."""
    ranks = ranks.astype(np.uint32)
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    end = np.cumsum(size, dtype=np.int64)
    begin = end - size
    data = np.zeros(end[-1] if len(end) else 0, np.uint8)
    for k in range(4):
        long = size > k
        data[begin[long] + k] = (ranks[long] >> np.uint32(8 * k)) & np.uint32(0xFF)
    return control.tobytes(), data.tobytes()


#: The four lengths that a control byte states.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The inverse of :func:`pack` for ``n`` numbers."""
    size = LENGTHS[control].ravel()[:n]
    begin = np.cumsum(size) - size
    ranks = data[begin].astype(np.uint32)
    for k in range(1, 4):
        long = size > k
        if not long.any():
            break
        ranks[long] |= data[begin[long] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def write_blocks(encoded: DataFrame, path: str, by_rank: np.ndarray, dtype: str) -> None:
    """Writes ``encoded`` below ``path`` in ascending doc_id order: shards by range, blocks in each.

    ``blocks`` has a row per block, committed by Spark's file writer: ``shard``, ``block``,
    ``start`` (ids before it in its shard), ``n_ids``, ``doc_ids``, and ``payload``: magic, number of
    documents, number of ids, ids of each document (32-bit), control bytes, data bytes. ``ranks`` has
    the id of each rank.
    """
    spark = encoded.sparkSession
    item = np.dtype(dtype).itemsize
    size = int(by_rank.max()) + 1 if len(by_rank) else 0
    ranks = np.zeros(size, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def close(shard: int, block: int, start: int, parts: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        doc_ids = pa.concat_arrays([p[0] for p in parts])
        counts = np.concatenate([p[1] for p in parts]).astype("<u4")
        ids = np.concatenate([p[2] for p in parts])
        control, data = pack(ranks[ids])
        head = MAGIC + np.array([len(counts), len(ids)], "<u4").tobytes() + counts.tobytes()
        numbers = [pa.array([x], t) for x, t in ((shard, pa.int32()), (block, pa.int32()), (start, pa.int64()), (len(ids), pa.int64()))]
        listed = pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids)
        return pa.RecordBatch.from_arrays(
            [*numbers, listed, pa.array([head + control + data], pa.binary())], ["shard", "block", "start", "n_ids", "doc_ids", "payload"]
        )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        parts, held, block, start = [], 0, 0, 0
        for whole in batches:
            for batch in slices(pa.RecordBatch.from_arrays([whole.column(0), whole.column(1).cast(pa.large_binary()).view(pa.large_string())], ["doc_id", "ids"]), 1, item * BLOCK_IDS):
                data, offsets = column_bytes(batch.column(1))
                parts.append((batch.column(0), np.diff(offsets) // item, data.view(dtype)))
                held += len(data) // item
                if held >= BLOCK_IDS:
                    yield close(shard, block, start, parts)
                    parts, held, block, start = [], 0, block + 1, start + held
        if parts:
            yield close(shard, block, start, parts)

    id_type = encoded.schema["doc_id"].dataType.simpleString()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The hash stands for the ids, of which a sample would go to the driver.
    ordered = encoded.withColumn("tie", F.xxhash64("ids"))
    ordered = ordered.repartitionByRange(width, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    schema = f"shard int, block int, start long, n_ids long, doc_ids array<{id_type}>, payload binary"
    ordered.mapInArrow(blocks, schema).write.parquet(f"{path}/blocks")
    listed = list(enumerate(by_rank.tolist()))
    spark.createDataFrame(listed, "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")


def read_blocks(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of the files: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers) and, if asked for, ``ids``."""
    by_rank = np.array([r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)
    files = spark.read.parquet(f"{path}/blocks")
    id_type = files.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, payload, doc_ids in zip(*[batch.column(k).to_pylist() for k in (0, 1, 2)], batch.column(3)):
                raw = np.frombuffer(payload, np.uint8)
                if payload[:4] != MAGIC:
                    raise ValueError("not a block of token ids")
                n_docs, n_ids = (int(x) for x in raw[4:12].view("<u4"))
                body = 12 + 4 * n_docs
                counts = raw[12:body].copy().view("<u4").astype(np.int64)
                data_at = body + -(-n_ids // 4)
                ids = by_rank[unpack(raw[body:data_at], raw[data_at:], n_ids)].astype("<u4")
                ends = np.cumsum(counts)
                begins = ends - counts
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                columns = [
                    pa.array(np.full(n_docs, shard, np.int32)),
                    doc_ids.values,
                    pa.array(begins + start),
                    pa.array(counts),
                    pa.array(sums, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    decoded = files.select("shard", "start", "payload", "doc_ids").mapInArrow(
        decode, f"shard int, doc_id {id_type}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    )
    # One row per shard, of which there are as many as shuffle partitions.
    totals = files.groupBy("shard").agg(F.max(F.col("start") + F.col("n_ids")).alias("total"))
    offsets = totals.selectExpr("shard", "sum(total) over (order by shard) - total as before")
    joined = decoded.join(F.broadcast(offsets), "shard")
    return joined.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None) -> str:
    """Encodes ``docs`` (``doc_id``, ``text``), writes the block files and returns their folder.

    Null texts are empty and hold ``end_id`` only. Rows with the same id are ordered by a hash of
    their ids; null ids come first. Texts are encoded whole; a block holds at least one document. An empty table
    gives a folder without blocks. Other columns are not read.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark, "token-files")
    dtype = id_dtype(tokenizer_path, end_id)
    encoded = written(encode_documents(docs, tokenizer_path, end_id, dtype), "token-ids")
    write_blocks(encoded, path, frequency_ranks(encoded, dtype), dtype)
    return path
