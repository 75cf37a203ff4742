"""Packing of token sequences into windows of one size, by the sum-of-squares rule.

Each document is cut into full windows and a rest. Rests are placed one after another:
a rest of ``n`` tokens goes into a window filled to level ``h``, or a new one (level 0),
such that the sum over all levels of the squared count of windows filled to that level
grows least. Counts per level are all the rule looks at; windows leave when full.

Pieces are dealt by a hash into shards of a bounded number of documents and bytes, each
packed on its own. At a shard's end its windows that are still open are laid end to end and cut
anew, so that each shard leaves at most one window with padding beyond ``slack``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import encoder
from .common import in_chunks

SHARD_ROWS = 4096  # documents a shard has on average,
SHARD_BYTES = 1 << 24  # or as many bytes of text, if that is less
PIECES = (
    "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)


def place(lengths: list[int], size: int) -> tuple[list[int], dict[int, int]]:
    """The window of each length (1 to ``size - 1``) in turn, and the fill of those
    windows that stay open. Ties go to the fuller window."""
    counts = np.zeros(size + 1, np.int64)  # open windows by level; 0 and size stay 0
    windows: list[list[int]] = [[] for _ in range(size)]
    placed: list[int] = []
    made = 0
    for n in lengths:
        last = size - n
        # Half the change of the sum of squares: a window leaves level h for h + n.
        change = counts[n : size + 1] - counts[: last + 1]
        cost = np.where(counts[: last + 1] > 0, 2 * change + 2, np.iinfo(np.int64).max)
        cost[0] = 2 * counts[n] + 1
        if counts[last] > 0:
            cost[last] = 1 - 2 * counts[last]
        level = last - int(np.argmin(cost[::-1]))
        if level:
            window = windows[level].pop()
            counts[level] -= 1
        else:
            window, made = made, made + 1
        placed.append(window)
        if level + n < size:
            windows[level + n].append(window)
            counts[level + n] += 1
    return placed, {w: level for level, ws in enumerate(windows) for w in ws}


def pack_shard(rows: pd.DataFrame, size: int, slack: int) -> pd.DataFrame:
    """Sequence and offset of each piece of one shard; sequences count from 0."""
    rows = rows.sort_values(["doc_id", "ids_crc32", "start"], kind="stable", ignore_index=True)
    ids, starts, lengths = list(rows["ids"]), list(rows["start"]), list(rows["length"])
    short = [i for i, n in enumerate(lengths) if n < size]
    placed, fill = place([int(lengths[i]) for i in short], size)
    loose = {w for w, level in fill.items() if level < size - slack}
    inside: dict[int, list[int]] = {}
    for i, window in zip(short, placed, strict=True):
        inside.setdefault(window, []).append(i)

    # Row, start, length, ids, their crc, sequence, offset. Pieces that are not cut anew
    # are as they came, also without ids.
    crcs = list(rows["ids_crc32"])
    out: list[tuple[int, int, int, bytes | None, int, int, int]] = []
    sequence = 0
    for i, n in enumerate(lengths):
        if n == size:
            out.append((i, starts[i], n, ids[i], crcs[i], sequence, 0))
            sequence += 1
    for window, members in inside.items():
        if window in loose:
            continue
        offset = 0
        for i in members:
            out.append((i, starts[i], lengths[i], ids[i], crcs[i], sequence, offset))
            offset += int(lengths[i])
        sequence += 1
    offset = 0
    for window in sorted(loose):
        for i in inside[window]:
            start, left = starts[i], ids[i]
            while left:
                part = left[: 4 * (size - offset)]
                out.append((i, start, len(part) // 4, part, crc(part), sequence, offset))
                start, left = start + len(part) // 4, left[len(part) :]
                offset += len(part) // 4
                if offset == size:
                    sequence, offset = sequence + 1, 0
    at = [x[0] for x in out]
    return pd.DataFrame(
        {
            "doc_id": rows["doc_id"].take(at).array,
            "start": [x[1] for x in out],
            "length": [x[2] for x in out],
            "ids_crc32": [x[4] for x in out],
            "doc_tokens": rows["doc_tokens"].take(at).array,
            "sequence_id": [x[5] for x in out],
            "offset": [x[6] for x in out],
            "ids": [x[3] for x in out],
        }
    )


def tokenized(
    docs: DataFrame, path: str, size: int, end_id: int, doc_id: str, text: str, with_ids: bool = True
) -> DataFrame:
    """Pieces of at most ``size`` ids of each document with ``end_id`` at its end; without
    ``with_ids`` full ones go without their ids."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(path, offsets=False)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, last in in_chunks(texts):
                row, start, total, length, crcs, pieces = [], [], [], [], [], []
                for i, ids in enumerate(encode_texts(texts[first:last])[0], first):
                    whole = ids.tobytes() + end
                    n = len(whole) // 4
                    for at in range(0, n, size):
                        part = whole[4 * at : 4 * (at + size)]
                        row.append(i)
                        start.append(at)
                        total.append(n)
                        length.append(len(part) // 4)
                        crcs.append(crc(part))
                        pieces.append(part if with_ids or n - at < size else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int64())),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crcs, pa.int64()),
                        pa.array(total, pa.int64()),
                        pa.array(pieces, pa.binary()),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        work,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary",
    )


def pack(
    docs: DataFrame,
    path: str,
    size: int = 1024,
    end_id: int = 0,
    slack: int = 8,
    shard_rows: int = SHARD_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece, with its ids (unsigned, 4 bytes each, little-endian).

    A caller without use for the ids leaves them out, and they are not shuffled.

    Every id of every document, with ``end_id`` at its end, lies in exactly one piece;
    ``sequence_id`` and ``offset`` say where. A window with at most ``slack`` free places
    at the end of a shard stays as it is.

    NULL and empty texts are the one id ``end_id``. Rows are packed one by one, so a
    repeated row or id is there as often as in ``docs``, a NULL id among them. An empty
    table gives no pieces. Other columns are left out.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    texts = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.col(text))).alias("bytes")).first()
    shards = max(1, -(-texts["n"] // shard_rows), -(-(texts["bytes"] or 0) // SHARD_BYTES))
    pieces = tokenized(docs, path, size, end_id, doc_id, text, with_ids)
    # A rest's crc has all its ids in it, so rows that share an id go to many shards.
    dealt = pieces.withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards))
    )

    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = pack_shard(rows, size, slack)
        out["sequence_id"] = out["sequence_id"] * shards + int(key[0])
        return out

    packed = dealt.groupBy("shard").applyInPandas(work, PIECES.format(kind=kind))
    return packed if with_ids else packed.drop("ids")
