"""Conversations as token sequences, assembled from separately encoded segments.

A turn is ``<|turn|>role<|text|>text<|end|>``. Role and text are encoded on their own and the three marks are
spliced in as reserved ids beyond the vocabulary, so no content can produce a mark. In the written-out form the
marks are strings; therefore control strings in roles and texts are escaped, reversibly. The loss mask is 1 on
the ids of assistant texts: +1 where such a segment starts, -1 where it ends, summed up.

Turns are encoded where they lie and then sorted by conversation and turn; what is written per
turn has its place in its conversation by a running sum. A reader goes through the sorted turns and keeps running
digests, so a conversation of any length is never held as a whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import shared_dir

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that mark something in this or another common template; none is left in escaped content.
CONTROLS = (TURN, TEXT, END, "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED = "assistant"

_CONTROL = re.compile("(?=" + "|".join(re.escape(c) for c in CONTROLS) + ").", re.S)
_ESCAPED = re.compile(r"\\([\\-])", re.S)


def escape(text: str) -> str:
    """``text`` with doubled backslashes and ``\\-`` behind the first sign of every control string."""
    return _CONTROL.sub(lambda m: m.group(0) + "\\-", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" if m.group(1) == "\\" else "", text)


_tokenizers: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        _tokenizers[path] = tokenizer
    return _tokenizers[path]


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokenizer = _tokenizer(path)
    size = tokenizer.get_vocab_size()
    turn, text_at, end = size, size + 1, size + 2
    for batch in batches:
        roles = [escape(r or "") for r in batch.column(2).to_pylist()]
        texts = [escape(t or "") for t in batch.column(3).to_pylist()]
        heads = {r: tokenizer.encode(r, add_special_tokens=False).ids for r in set(roles)}
        bodies = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids, masks = [], []
        for role, raw, body in zip(roles, batch.column(2).to_pylist(), bodies):
            head = [turn, *heads[role], text_at]
            row = np.array([*head, *body.ids, end], np.int32)
            step = np.zeros(len(row) + 1, np.int8)
            if raw == LEARNED:
                step[len(head)] += 1
                step[len(row) - 1] -= 1
            ids.append(row.tolist())
            masks.append(np.cumsum(step[:-1]).tolist())
        written = [f"{TURN}{r}{TEXT}{t}{END}" for r, t in zip(roles, texts)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int32())), pa.array(written)],
            ["conv_id", "turn", "ids", "loss_mask", "formatted"],
        )


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``start``, the ids before a turn in its conversation, to rows sorted by conversation."""
    last, total = object(), 0
    for batch in batches:
        starts = []
        sizes = np.diff(batch.column("ids").offsets.to_numpy())
        for conv, size in zip(batch.column(0).to_pylist(), sizes.tolist()):
            if conv != last:
                last, total = conv, 0
            starts.append(total)
            total += size
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(starts, pa.int64())], [*batch.schema.names, "start"])


def _sorted(turns: DataFrame, *ties: str) -> DataFrame:
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", *ties)


def write_chats(conversations: DataFrame, tokenizer_path: str, path: str | None = None) -> str:
    """Writes a row per turn below ``path`` (Parquet, ordered by conversation and turn) and returns the folder.

    Columns: ``conv_id``, ``turn``, ``start`` (ids before it in its conversation), ``ids``, ``loss_mask``
    and ``formatted``. ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; a null role or text is empty, a
    null turn comes first, a null conv_id is a conversation of its own kind. Turns with one number are ordered by
    their written form; repeated rows stay. Other columns are not read; an empty table gives no rows.
    """
    types = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = f"conv_id {types['conv_id']}, turn {types['turn']}, ids array<int>, loss_mask array<int>, formatted string"
    rows = conversations.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    encoded = rows.mapInArrow(lambda batches: _encode(batches, tokenizer_path), schema)
    path = path or shared_dir(conversations.sparkSession, "chats")
    _sorted(encoded, "formatted").mapInArrow(_placed, schema + ", start long").write.parquet(path)
    return path


def read_chats(spark: SparkSession, path: str, tokenizer_path: str) -> DataFrame:
    """One row per conversation from the ids and masks in ``path``.

    ``turns_sha256`` is over role, newline, text, newline of each turn; ``loss_chars`` and ``loss_sha256`` are over
    the text under the mask; both are unescaped. ``formatted_chars`` is the size of the written form.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        size = tokenizer.get_vocab_size()
        state: dict | None = None

        def closed() -> pa.RecordBatch:
            values = [[state["conv"]], [state["turns"]], [state["all"].hexdigest()], [state["chars"]], [state["loss"].hexdigest()], [state["formatted"]]]
            kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        conv_type = None
        for batch in batches:
            conv_type = batch.schema.field(0).type
            flat = batch.column(2).flatten().to_numpy()
            mask = batch.column(3).flatten().to_numpy().astype(bool)
            ends = np.cumsum(np.diff(batch.column(2).offsets.to_numpy()))
            middle = np.flatnonzero(flat == size + 1)
            begins = np.concatenate(([0], ends[:-1]))
            segments = []
            for a, m, b in zip(begins.tolist(), middle.tolist(), ends.tolist()):
                segments += [flat[a + 1 : m].tolist(), flat[m + 1 : b - 1].tolist(), flat[a:b][mask[a:b]].tolist()]
            decoded = tokenizer.decode_batch(segments, skip_special_tokens=False)
            done = []
            for row, (conv, formatted) in enumerate(zip(batch.column(0).to_pylist(), batch.column(4).to_pylist())):
                if state is None or conv != state["conv"]:
                    if state is not None:
                        done.append(closed())
                    state = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0}
                role, text, learned = (unescape(x) for x in decoded[3 * row : 3 * row + 3])
                state["turns"] += 1
                state["all"].update(f"{role}\n{text}\n".encode())
                state["chars"] += len(learned)
                state["loss"].update(learned.encode())
                state["formatted"] += len(formatted)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if state is not None:
            yield closed()

    rows = spark.read.parquet(path)
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    # The order of the files is made sure of again: a reader may get them in other splits.
    turns = _sorted(rows.select("conv_id", "turn", "ids", "loss_mask", "formatted", "start"), "start")
    return turns.select("conv_id", "turn", "ids", "loss_mask", "formatted").mapInArrow(digest, schema)
