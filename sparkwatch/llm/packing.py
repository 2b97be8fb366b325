"""Token packing by Karmarkar-Karp multiway differencing.

A document is cut into whole windows and one rest. The rests, in pieces of at most ``max_piece`` tokens, are gathered in
blocks for a given number of windows. Differencing starts with one partial partition per piece; again and again the two
with the largest imbalance are merged, the fullest windows of one with the emptiest of the other, until one partition is
left, with near-equal windows. Where a window exceeds the capacity, the window count rises and the block is dealt anew.

Blocks lie within a task: nothing is shuffled, and a task holds one block of pieces at a time. Defined results: a null or
empty text is one piece with the end id alone; repeated rows are packed like others; further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from operator import add, itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .bpe import id_encoder
from .common import chunks

END = b"\0\0\0\0"  # the id 0 that ends every document
SCHEMA = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indices of ``sizes`` in ``windows`` groups of near-equal sums."""
    if windows == 1:
        return [list(range(len(sizes)))]
    # a partial partition: window sums in descending order and the members of each window as nested pairs
    heap: list[tuple[int, int, list[int], list]] = []
    for i, size in enumerate(sizes):
        heap.append((-size, i, [size], [i]))  # windows that hold nothing are left away
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, sums, members = heapq.heappop(heap)
        _, _, other_sums, other = heapq.heappop(heap)
        gap = windows - len(other_sums)  # empty windows of the other one meet the fullest of this one
        met = max(0, len(sums) - gap)  # windows in which both hold something
        other_sums.reverse()
        other.reverse()
        both = zip(map(add, sums[gap:], other_sums), zip(members[gap:], other, strict=False), strict=False)
        merged = [*zip(sums[:gap], members[:gap], strict=True), *both, *zip(other_sums[met:], other[met:], strict=True)]
        merged.sort(key=itemgetter(0), reverse=True)  # stable
        sums, members = [m[0] for m in merged], [m[1] for m in merged]
        least = sums[-1] if len(sums) == windows else 0
        heapq.heappush(heap, (least - sums[0], serial, sums, members))
        serial += 1
    return [leaves(m) for m in heap[0][3]]


def leaves(tree) -> list[int]:
    out, stack = [], [tree]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += node
        else:
            out.append(node)
    return sorted(out)


def balanced(sizes: list[int], capacity: int) -> list[list[int]]:
    """The fewest near-equal windows, counted up from the sum, that hold the pieces."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        groups = differencing(sizes, windows)
        if max(sum(sizes[i] for i in g) for g in groups) <= capacity:
            return groups
        windows += 1


def pack_tokens(
    df: DataFrame,
    path: str,
    capacity: int = 1024,
    max_piece: int = 192,
    block_windows: int = 48,
    slack: int = 14,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: where it begins in its document, and its sequence and place there.

    A block is filled up to ``slack`` tokens per window below its capacity, so that near-equal windows fit. Sequence ids
    carry the task's partition in their upper bits, hence no two tasks share one.
    """

    def task(batches):
        encoder = id_encoder(path)
        return pack(tokens(batches, encoder), (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33)

    def tokens(batches, encoder) -> Iterator[tuple[object, bytes]]:
        for batch, texts in chunks(batches, "text"):
            ids = batch.column(0).to_pylist()
            for doc, found in zip(ids, encoder.encode([t or "" for t in texts]), strict=True):
                yield doc, found + END

    def pack(docs, sequence: int):
        rows: list[tuple] = []
        block: list[tuple] = []  # (doc, start, ids, doc_tokens)
        held, full = 0, block_windows * (capacity - slack)

        def close() -> None:
            nonlocal sequence, held
            for group in balanced([len(p[2]) // 4 for p in block], capacity):
                offset, total = 0, sum(len(block[i][2]) // 4 for i in group)
                for i in group:
                    doc, start, ids, all_tokens = block[i]
                    n = len(ids) // 4
                    rows.append((doc, start, n, zlib.crc32(ids), all_tokens, sequence, offset, total))
                    offset += n
                sequence += 1
            block.clear()
            held = 0

        for doc, ids in docs:
            n = len(ids) // 4
            whole = n // capacity * capacity
            for start in range(0, whole, capacity):
                piece = ids[4 * start : 4 * (start + capacity)]
                rows.append((doc, start, capacity, zlib.crc32(piece), n, sequence, 0, capacity))
                sequence += 1
            start = whole
            while start < n:
                size = min(n - start, max_piece, full - held)
                block.append((doc, start, ids[4 * start : 4 * (start + size)], n))
                start += size
                held += size
                if held == full:
                    close()
            if len(rows) > 20_000:
                yield batch_of(rows)
                rows = []
        if block:
            close()
        if rows:
            yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.record_batch(
            [pa.array(columns[0], id_type), *(pa.array(np.array(c, np.int64)) for c in columns[1:])],
            "doc_id start length ids_crc32 doc_tokens sequence_id offset sequence_tokens".split(),
        )

    kind = df.schema[id_col].dataType.simpleString()
    id_type = to_arrow_type(df.schema[id_col].dataType)
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(task, SCHEMA.format(id=kind))
