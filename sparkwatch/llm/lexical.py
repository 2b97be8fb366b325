"""Ranked lexical search over K2-treaps.

Documents are cut into ranges. A range's postings are points of a grid, terms by documents, with an integer impact each. A
K2-treap holds the grid: a quadtree whose cells know the largest impact below them and have a bit per quadrant that isn't
empty; levels are flat arrays, and a child is found by the rank of its bit. An item walks down the row paths of
its terms jointly: a state is a range of documents with one cell per term, its bound the weighted sum of the cells' maxima.
States are opened best bound first, a batch at a time, until none can beat the k-th best document. A task carries
the k-th scores from range to range, so later ranges are mostly cut off near the root.

The terms of the items are what has to be indexed: they are shipped to the tasks in blocks of bounded size, one
pass over the documents for each block. Documents aren't moved; postings are written once, the k best per item and task are shuffled.

Defined results: null texts hold no terms; rows with one item id are one item; an item without a term, or whose terms occur
nowhere, has no rows; repeated document rows are documents each; equal scores go by document id, null first; further columns are
ignored; an empty table gives no rows. Ids of documents are integers.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import chunks, stored

BLOCK_PAIRS = 1 << 18  # (item, term) pairs shipped to tasks at once
RANGE_DOCS = 1 << 14  # documents of a range
RANGE_POSTINGS = 1 << 19  # postings from which a range is closed (a document isn't split)
BATCH = 64  # states opened at once, doubled with every round
# Fixed values of the ranking: weight scale, impact scale, damping, and shares of the length part in percent.
WEIGHT_SCALE, IMPACT_SCALE, DAMPING, LENGTH_SHARE = 1_000, 1_000_000_000, 8, 90
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# of UTF-8 bytes: letters in lower case, separators as spaces
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

INDEX = "ids binary, nulls binary, lengths binary, terms binary, columns binary, counts binary"


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term): the distinct terms of each item."""
    words = F.split(F.translate(F.col(text_col), UPPER, LOWER), SEPARATORS)
    pairs = items.select(F.col(id_col).alias("item_id"), F.explode(F.array_distinct(words)).alias("term"))
    return pairs.filter("term <> ''").distinct()


# ---- the index of a range


def spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers moved to the even places of 64 bits."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


ONES = np.array([bin(m).count("1") for m in range(16)], np.int64)


class Treap:
    """K2-treap over points (row, column, impact), all levels in one array: root first, the cells of a level in Morton order."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray):
        side = int(max(rows.max(), columns.max())) + 1
        self.height = max(1, math.ceil(math.log2(side)) if side > 1 else 1)
        code = (spread(rows) << np.uint64(1)) | spread(columns)
        order = np.argsort(code)
        code, best = code[order], impacts[order]
        levels = [(best, np.zeros(len(code), np.uint8), np.zeros(len(code), np.int64))]
        for _ in range(self.height):
            parent = code >> np.uint64(2)
            starts = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            bits = (1 << (code & np.uint64(3)).astype(np.int64)).astype(np.uint8)
            levels.append((np.maximum.reduceat(levels[-1][0], starts), np.bitwise_or.reduceat(bits, starts), starts))
            code = parent[starts]
        levels.reverse()
        begins = np.cumsum([0, *(len(x[0]) for x in levels)])
        self.best = np.concatenate([x[0] for x in levels])
        self.mask = np.concatenate([x[1] for x in levels])
        # index of a cell's first child: cells of a level are in order, so children lie side by side
        self.first = np.concatenate([x[2] + b for x, b in zip(levels, begins[1:])])

    def children(self, cells: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The child of each cell in its quadrant, -1 where there is none."""
        mask = self.mask[cells].astype(np.int64)
        child = self.first[cells] + ONES[mask & ((1 << quadrant) - 1)]
        return np.where((cells >= 0) & ((mask >> quadrant) & 1 == 1), child, -1)


def best_columns(treap: Treap, rows: np.ndarray, weights: np.ndarray, k: int, floor: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(columns, scores) of the best documents of a range, at least all of the k best that come before ``floor``.

    ``floor`` is (score, column): a document counts if its score is greater, or equal and its column smaller.
    Columns are in order of document ids, so ties fall to the smaller column.
    """
    level = np.array([treap.height], np.int64)
    column = np.zeros(1, np.int64)
    cells = np.zeros((1, len(rows)), np.int64)
    bound = np.array([int((weights * treap.best[0]).sum())], np.int64)
    heap: list[tuple[int, int]] = []  # the k best so far, worst first, as (score, -column)
    columns, scores = [], []
    batch = BATCH
    while True:
        if len(heap) == k:
            floor = stricter(floor, heap[0])
        alive = (bound > floor[0]) | ((bound == floor[0]) & ((column << level) < floor[1]))
        if not alive.all():
            level, column, cells, bound = level[alive], column[alive], cells[alive], bound[alive]
        if not len(bound):
            break
        if len(bound) > batch:
            cut = np.argpartition(-bound, batch)
            now, rest = cut[:batch], cut[batch:]
        else:
            now, rest = np.arange(len(bound)), np.empty(0, np.int64)
        batch *= 2
        leaves = now[level[now] == 0]
        for c, s in zip(column[leaves].tolist(), bound[leaves].tolist()):
            columns.append(c)
            scores.append(s)
            entry = (s, -c)
            if len(heap) < k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        inner = now[level[now] > 0]
        parts = [(level[rest], column[rest], cells[rest], bound[rest])]
        if len(inner):
            below = level[inner] - 1
            row_bit = ((rows[None, :] >> below[:, None]) & 1) << 1
            for half in (0, 1):
                child = treap.children(cells[inner], row_bit | half)
                worth = (np.where(child >= 0, treap.best[child], 0) * weights).sum(axis=1)
                some = worth > 0
                parts.append((below[some], ((column[inner] << 1) | half)[some], child[some], worth[some]))
        level, column, cells, bound = (np.concatenate(x) for x in zip(*parts))
    return np.array(columns, np.int64), np.array(scores, np.int64)


def stricter(floor: tuple[int, int], kth: tuple[int, int]) -> tuple[int, int]:
    """The stricter of a floor (score, column) and the k-th best (score, -column) found."""
    score, column = kth[0], -kth[1]
    return (score, column) if score > floor[0] or (score == floor[0] and column < floor[1]) else floor


# ---- tasks


def indexer(vocabulary: dict[bytes, int]):
    """Documents to the postings of ranges: sorted by id, term numbers and counts of the given terms only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[tuple] = []  # (id, number of terms, term numbers, counts)
        postings = 0

        def close() -> pa.RecordBatch:
            docs.sort(key=lambda d: (d[0] is not None, d[0] or 0))
            sizes = [len(d[2]) for d in docs]
            row = {
                "ids": np.array([d[0] or 0 for d in docs], np.int64),
                "nulls": np.array([d[0] is None for d in docs], np.bool_),
                "lengths": np.array([d[1] for d in docs], np.int64),
                "terms": np.concatenate([d[2] for d in docs]),
                "columns": np.repeat(np.arange(len(docs), dtype=np.int32), sizes),
                "counts": np.concatenate([d[3] for d in docs]),
            }
            return pa.RecordBatch.from_pydict({k: pa.array([v.tobytes()], pa.binary()) for k, v in row.items()})

        for batch, texts in chunks(batches, "text"):
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                words = (text or "").encode("utf-8", "replace").translate(FOLD).split()
                counted = Counter(words)
                known = [(vocabulary[w], n) for w, n in counted.items() if w in vocabulary]
                pair = np.array(known, np.int32).reshape(-1, 2)
                docs.append((doc, len(words), pair[:, 0], pair[:, 1]))
                postings += len(known)
                if len(docs) == RANGE_DOCS or postings >= RANGE_POSTINGS:
                    yield close()
                    docs, postings = [], 0
        if docs:
            yield close()

    return run


def arrays(row: dict) -> dict[str, np.ndarray]:
    kinds = {"ids": np.int64, "nulls": np.bool_, "lengths": np.int64, "terms": np.int32, "columns": np.int32, "counts": np.int32}
    return {k: np.frombuffer(row[k], kind) for k, kind in kinds.items()}


def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield arrays(batch.slice(i, 1).to_pylist()[0])


def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n): in how many documents each term occurs; term -1 has the documents with a term, -2 all terms."""
    total: Counter = Counter()
    for r in ranges(batches):
        terms, n = np.unique(r["terms"], return_counts=True)
        total.update(dict(zip(terms.tolist(), n.tolist())))
        total[-1] += int((r["lengths"] > 0).sum())
        total[-2] += int(r["lengths"].sum())
    if total:
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(total), pa.int32()), "n": pa.array(list(total.values()), pa.int64())})


def searcher(queries: list[tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int, k: int, schema: pa.Schema):
    """The k best documents of a task's ranges for each item, given as (term numbers, weights)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in queries]  # (-score, order of the id)
        for r in ranges(batches):
            if not len(r["terms"]):
                continue
            length = 100 - LENGTH_SHARE + (LENGTH_SHARE * r["lengths"] * n_docs) // n_terms
            counts = r["counts"].astype(np.int64)
            impact = (IMPACT_SCALE * counts) // (1_000 * counts + DAMPING * length[r["columns"]])
            present, row = np.unique(r["terms"], return_inverse=True)
            treap = Treap(row.astype(np.int64), r["columns"].astype(np.int64), impact)
            ids, nulls = r["ids"], r["nulls"]
            for q, (terms, weights) in enumerate(queries):
                at = np.searchsorted(present, terms)
                here = (at < len(present)) & (present[np.minimum(at, len(present) - 1)] == terms)
                if not here.any():
                    continue
                floor = (0, 0)
                if len(best[q]) == k:  # nulls come before all ids
                    score, known, doc = best[q][-1]
                    floor = (-score, int(np.searchsorted(ids[nulls.sum() :], doc)) + int(nulls.sum()) if known else 0)
                columns, scores = best_columns(treap, at[here], weights[here], k, floor)
                if len(columns):
                    found = [(-s, not nulls[c], int(ids[c])) for c, s in zip(columns.tolist(), scores.tolist())]
                    best[q] = heapq.nsmallest(k, best[q] + found)
        rows = [(q, doc if known else None, -score) for q, docs in enumerate(best) for score, known, doc in docs]
        for start in range(0, len(rows), 10_000):
            columns = list(zip(*rows[start : start + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents of each item, equal scores by ascending id."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kind = items.schema[item_col].dataType.simpleString()
    pairs = stored(item_terms(items, item_col, item_text), "item-terms")
    blocks = max(1, -(-pairs.count() // block_pairs))
    dealt = pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = [_search_block(source, dealt.filter(F.col("block") == b), k) for b in range(blocks)]
    found = [f for f in found if f is not None]
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")


def _search_block(source: DataFrame, pairs: DataFrame, k: int) -> DataFrame | None:
    """The k best documents per item and task for one block of items."""
    rows = pairs.select("item_id", "term").collect()  # about BLOCK_PAIRS, however large the tables
    if not rows:
        return None
    vocabulary = {t: i for i, t in enumerate(sorted({r["term"].encode() for r in rows}))}
    index = stored(source.mapInArrow(indexer(vocabulary), INDEX), "postings")
    counts = index.mapInArrow(statistics, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = {r["term"]: r["n"] for r in counts.collect()}  # a row per term of the block at most
    n_docs, n_terms = frequency.get(-1, 0), frequency.get(-2, 0)
    if not n_docs:
        return None
    items: dict = {}
    for r in rows:
        items.setdefault(r["item_id"], []).append(vocabulary[r["term"].encode()])
    names = list(items)
    queries = []
    for terms in items.values():
        numbers = np.array(sorted(terms), np.int64)
        weight = [math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * frequency.get(t, 0) + 1))) for t in numbers.tolist()]
        queries.append((numbers, np.array(weight, np.int64)))
    id_type = pairs.schema["item_id"].dataType
    schema = pa.schema([("item_id", to_arrow_type(id_type)), ("doc_id", pa.int64()), ("score", pa.int64())])
    search = searcher(queries, n_docs, n_terms, k, pa.schema([("q", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]))

    def named(batches):
        for batch in search(batches):
            yield pa.RecordBatch.from_arrays([pa.array([names[q] for q in batch.column(0).to_pylist()], schema[0].type), *batch.columns[1:]], schema=schema)

    return index.mapInArrow(named, f"item_id {id_type.simpleString()}, doc_id long, score long")
