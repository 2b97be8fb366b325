"""Exact top-k by inner product, as a Voronoi kNN join.

Components are scaled and rounded down to integers, so scores are exact. Pivots are vectors of the table; every vector goes
to the cell of its nearest pivot. In one pass each cell is summed up: count, largest distance from its pivot. A query's
k-th best score among candidates of its own cell is a floor for its result. Since q.x <= q.p + |q| * r for all x in a
cell with pivot p and radius r, cells whose bound is below the floor are left out for that query; queries are replicated to the
remaining cells only, and those are solved locally: cells in blocks of bounded size, a block against the queries that need it.

The replicated side are the queries, as the smaller one; no pair of vectors is emitted but those that reach the floor.
A crowded cell is many blocks. Scores fit 64 bits for components up to about 2 ** 20 in size after scaling.

Defined results: vectors that are null or hold null, NaN or infinite components take no part; a shorter vector counts as
followed by zeros; an empty vector scores zero; of a repeated id every row takes part, and a query is every such row;
candidates with the query's own id are left out; fewer candidates than k give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

PIVOTS = 256
BLOCK = 4_096  # vectors of a cell that are solved together
QUERIES = 4_096  # queries that meet a block together


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v) with whole-number components, for vectors that take part."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    ok = v.isNotNull() & ~F.coalesce(bad, F.lit(False))
    return df.filter(ok & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of int64, followed by zeros up to ``width``."""
    out = np.zeros((len(column), width), np.int64)
    flat, sizes = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
    if len(flat):
        row = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[row, at] = flat
    return out


def nearest(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x, p = vectors.astype(np.float64), pivots.astype(np.float64)
    square = (x * x).sum(axis=1)[:, None] - 2 * x @ p.T + (p * p).sum(axis=1)[None, :]
    cell = square.argmin(axis=1)
    return cell, np.sqrt(((x - p[cell]) ** 2).sum(axis=1))


def top_k(
    df: DataFrame,
    is_query: F.Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    pivots: int = PIVOTS,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query, ties to the smaller id."""
    spark = df.sparkSession
    vectors = integer_vectors(df, id_col, vector_col, scale)
    width = vectors.agg(F.max(F.size("v"))).first()[0]
    if not width:
        width = 1
    # a bounded number of vectors, spread over the table by hash
    chosen = vectors.orderBy(F.xxhash64("id"), "id").limit(pivots).toArrow()
    points = matrix(chosen.column("v").combine_chunks(), width) if chosen.num_rows else np.zeros((1, width), np.int64)
    points = np.unique(points, axis=0)
    shared = spark.sparkContext.broadcast(points)

    def assign(batches):
        for batch in batches:
            cell, distance = nearest(matrix(batch.column(1), width), shared.value) if batch.num_rows else ([], [])
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(distance, pa.float64())],
                ["id", "v", "cell", "distance"],
            )

    dealt = vectors.mapInArrow(assign, "id long, v array<long>, cell int, distance double")
    dealt = stored(dealt.withColumn("row", F.monotonically_increasing_id()), "knn-cells")
    summary = dealt.groupBy("cell").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).toArrow()  # a row per pivot
    radius, blocks = np.full(len(points), -1.0), np.ones(len(points), np.int64)
    cells = summary.column("cell").to_numpy()
    radius[cells] = summary.column("radius").to_numpy()
    blocks[cells] = -(-summary.column("n").to_numpy() // block)
    layout = spark.sparkContext.broadcast((radius, blocks))

    queries = dealt.withColumn("__id", F.col("id")).withColumnRenamed("id", id_col).filter(is_query)
    queries = queries.select(F.col("__id").alias("id"), "v", "cell", "row")
    data = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.element_at(F.lit(blocks.tolist()), F.col("cell") + 1))).select(
        "cell", "block", "id", "v"
    )

    # floors: the k-th best of the own cell
    first = replicated(queries.withColumn("floor", F.lit(-(2**62))), layout, None)
    own = solve(data, first, k, width)
    floors = own.withColumn("rank", F.row_number().over(best_first())).filter(F.col("rank") == k).select("row", F.col("score").alias("floor"))
    floored = queries.join(floors, "row", "left").fillna(-(2**62), ["floor"])
    rest = solve(data, replicated(floored, layout, shared, width), k, width)
    found = own.unionByName(rest).withColumn("rank", F.row_number().over(best_first())).filter(F.col("rank") <= k)
    return found.select(F.col("query").alias("query_id"), F.col("rank").cast("int"), F.col("id").alias("vec_id"), "score")


def best_first():
    return Window.partitionBy("row").orderBy(F.desc("score"), "id")


def replicated(queries: DataFrame, layout, pivots, width: int = 0) -> DataFrame:
    """A row per query and block to search: the own cell without ``pivots``, else every other cell whose bound is no less than the floor."""

    def task(batches):
        radius, blocks = layout.value
        for batch in batches:
            ids, vs, cell, row, floor = (batch.column(c) for c in ("id", "v", "cell", "row", "floor"))
            own = cell.to_numpy()
            if pivots is None:
                q, target = np.arange(batch.num_rows), own
            else:
                x, p = matrix(vs, width).astype(np.float64), pivots.value.astype(np.float64)
                bound = x @ p.T + np.sqrt((x * x).sum(axis=1))[:, None] * radius[None, :]
                # raised by more than its rounding error, also where it is negative
                need = (bound + 1e-9 * np.abs(bound) + 1 >= floor.to_numpy()[:, None]) & (radius >= 0)[None, :]
                need[np.arange(len(own)), own] = False
                q, target = np.nonzero(need)
            copies = blocks[target]
            q, target = np.repeat(q, copies), np.repeat(target, copies)
            number = np.arange(len(q)) - np.repeat(np.cumsum(copies) - copies, copies)
            take = pa.array(q)
            yield pa.record_batch(
                [pa.array(target, pa.int32()), pa.array(number, pa.int64()), row.take(take), ids.take(take), vs.take(take), floor.take(take)],
                ["cell", "block", "row", "id", "v", "floor"],
            )

    wanted = queries.select("id", "v", "cell", "row", F.col("floor").cast("long"))
    return wanted.mapInArrow(task, "cell int, block long, row long, id long, v array<long>, floor long")


def solve(data: DataFrame, queries: DataFrame, k: int, width: int) -> DataFrame:
    """(row, query, id, score) of the k best of each query in each block, as far as they reach the floor."""

    def block_task(key, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("row", "query", "id", "score")})
        if not left.num_rows or not right.num_rows:
            return empty
        x = matrix(left.column("v").combine_chunks(), width)
        order = np.argsort(left.column("id").to_numpy(), kind="stable")
        x, ids = x[order], left.column("id").to_numpy()[order]
        parts = []
        exact = np.abs(x).max(initial=0) < 1 << 20
        for start in range(0, right.num_rows, 512):
            part = right.slice(start, 512)
            q = matrix(part.column("v").combine_chunks(), width)
            # products of numbers this small are exact in double precision, which has the faster product
            scores = (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if exact and np.abs(q).max(initial=0) < 1 << 20 else q @ x.T
            query, floor, row = (part.column(c).to_numpy() for c in ("id", "floor", "row"))
            good = (scores >= floor[:, None]) & (ids[None, :] != query[:, None])
            for i in range(len(q)):
                at = np.flatnonzero(good[i])
                if len(at) > k:
                    at = at[np.argsort(-scores[i, at], kind="stable")[:k]]
                if len(at):
                    parts.append((np.full(len(at), row[i]), np.full(len(at), query[i]), ids[at], scores[i, at]))
        if not parts:
            return empty
        return pa.table({c: np.concatenate(v) for c, v in zip(("row", "query", "id", "score"), zip(*parts, strict=True), strict=True)})

    found = "row long, query long, id long, score long"
    # every block of a cell meets the same queries; beyond QUERIES of them they come in parts, each with a copy of the block
    meeting = {r["cell"]: r["count"] for r in queries.filter("block = 0").groupBy("cell").count().collect()}  # at most PIVOTS
    if max(meeting.values(), default=0) <= QUERIES:
        return data.groupBy("cell", "block").cogroup(queries.groupBy("cell", "block")).applyInArrow(block_task, found)
    parts = F.expr(f"array({', '.join(str(max(1, -(-meeting.get(c, 0) // QUERIES))) for c in range(max(meeting) + 1))})")
    here = F.coalesce(F.get(parts, F.col("cell")), F.lit(1))
    copies = data.withColumn("part", F.explode(F.sequence(F.lit(0), here - 1)))
    dealt = queries.withColumn("part", F.pmod(F.xxhash64("row"), here).cast("int"))
    keys = ("cell", "block", "part")
    return copies.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(block_task, found)
