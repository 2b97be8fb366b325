"""SimHash near-duplicates with a pigeonring filter.

Fingerprints have 64 bits; documents link at ``max_bits`` or fewer differing bits. The bits are dealt to
``max_bits + 1`` segments on a ring. By the pigeonring principle a linked pair has a segment from which on every chain of l
segments differs in at most l * max_bits / (max_bits + 1) bits, which is l - 1 when rounded down: the first is equal, the
first two differ in at most 1 bit, and so on. So a pair shares that segment and one half of the next one exactly (two of
the four quarters of the next two, where there are many fingerprints). Fingerprints are grouped by these keys; within a
group the chain conditions prune what the key lets through, and the full Hamming distance decides on the rest. A group
gives the edges of a spanning forest only, never all its pairs.

Copies are collapsed to their fingerprint first. A key that very many fingerprints share leaves that path: there two
fingerprints within an even max_bits are linked through a common value half way (at most max_bits / 2 bits from either),
which costs a fixed number of rows per fingerprint and no pairs at all.

Defined results: a null text counts as empty; no words give fingerprint zero, which links like any other; repeated rows
are members of one component; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, chunks, stored, unsigned_hex, without
from .components import connected_components

BITS = 64
DENSE = 16_384  # fingerprints that share a key from which on the key is looked at
DENSE_SHARE = 1 / 65_536  # or this share of all, whichever is more; bounds the number of dense keys
PAIRWISE_RUN = 32  # groups up to this size are compared by shifts, larger ones by search
FULL_GROUP = 64  # fingerprints that a random group may have on average before keys get longer


# ---- fingerprints ----


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # of bytes: only A-Z is lowered, only ASCII white space separates
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-shingle] + 1])
        digest = xxhash.xxh64_intdigest
        spans = zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have set."""
    total = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) with the 64 bits of the fingerprint as a long."""

    def task(batches):
        for batch, texts in chunks(batches, "text"):
            values = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(values)], ["id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        task, f"id {kind}, fp long"
    )


# ---- keys ----


def spread(first: int, length: int, parts: int) -> list[int]:
    """Masks of consecutive bits that cut ``length`` bits from ``first`` on, around the ring, into near-equal parts."""
    bounds = [length * p // parts for p in range(parts + 1)]
    return [sum(1 << ((first + i) % BITS) for i in range(a, b)) for a, b in zip(bounds, bounds[1:], strict=False)]


def segments(max_bits: int) -> list[int]:
    return spread(0, BITS, max_bits + 1)


def key_masks(max_bits: int, depth: int) -> list[tuple[int, int]]:
    """(segment that the chain starts at, mask of the bits that a linked pair shares)."""
    ring = segments(max_bits)
    m = len(ring)
    out = []
    for i, first in enumerate(ring):
        reach = min(depth, m - 1)
        if reach == 0:
            out.append((i, first))
            continue
        begin = sum(s.bit_count() for s in ring[: i + 1])
        following = sum(ring[(i + j) % m].bit_count() for j in range(1, reach + 1))
        parts = spread(begin, following, 2 * reach)  # at most `reach` of them hold a differing bit
        out += [(i, first | sum(chosen)) for chosen in combinations(parts, reach)]
    return out


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def key_depth(count: int, max_bits: int) -> int:
    """Segments after the first that keys take bits from, so that a random group keeps to FULL_GROUP fingerprints."""
    for depth in range(1, 3):
        bits = min(mask.bit_count() for _, mask in key_masks(max_bits, depth))
        if count >> bits <= FULL_GROUP:
            return depth
    return 2


# ---- groups ----


def chained(diff: np.ndarray, start: np.ndarray, ring: np.ndarray, max_bits: int) -> np.ndarray:
    """Which differences keep the chain budgets from their starting segment on, and the full distance."""
    m = len(ring)
    budget = [(step + 1) * max_bits // m for step in range(m)]
    kept = np.arange(len(diff))
    total = np.zeros(len(diff), np.int64)
    for step in range(m):
        total = total + np.bitwise_count(diff[kept] & ring[(start[kept] + step) % m])
        good = total <= budget[step]
        kept, total = kept[good], total[good]
        if not len(kept):
            break
    return kept


def group_links(key: np.ndarray, start: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (positions) that connect what is linked within each run of equal keys."""
    ring = np.array(segments(max_bits), np.uint64)
    n = len(fp)
    bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    sizes = np.diff(bounds)
    size_of = np.repeat(sizes, sizes)
    small = size_of <= PAIRWISE_RUN
    left, right = [], []
    for shift in range(1, min(PAIRWISE_RUN, n)):
        at = np.flatnonzero(small[:-shift] & (size_of[:-shift] > shift) & (key[shift:] == key[:-shift]))
        if not len(at):
            break
        kept = at[chained(fp[at] ^ fp[at + shift], start[at], ring, max_bits)]
        left.append(kept)
        right.append(kept + shift)
    for a, b in zip(bounds[:-1][sizes > PAIRWISE_RUN].tolist(), bounds[1:][sizes > PAIRWISE_RUN].tolist(), strict=True):
        open_ = np.arange(a + 1, b)
        frontier = [a]
        while len(open_):
            at = frontier.pop() if frontier else None
            if at is None:
                frontier, open_ = [int(open_[0])], open_[1:]
                continue
            near = chained(fp[open_] ^ fp[at], np.full(len(open_), start[a]), ring, max_bits)
            if len(near):
                found = open_[near]
                left.append(np.full(len(found), at))
                right.append(found)
                frontier += found.tolist()
                open_ = np.delete(open_, near)
    empty = np.array([], np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def links_of_groups(keyed: DataFrame, max_bits: int) -> DataFrame:
    """(a, b) of each group of (k, start, key, fp); a task goes through its sorted rows run by run."""
    columns = "k", "start", "key", "fp"

    def task(batches):
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.array([batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)])
            held.append(rows)
            changes = np.flatnonzero((rows[0, 1:] != rows[0, :-1]) | (rows[2, 1:] != rows[2, :-1]))
            opened = held[0][:, 0]
            if not len(changes) and (rows[[0, 2], -1] == opened[[0, 2]]).all():
                continue  # still the same run
            cut = changes[-1] + 1 if len(changes) else 0
            whole = np.concatenate([*held[:-1], rows[:, :cut]], axis=1)
            held = [rows[:, cut:]]
            yield from edges(whole)
        if held:
            yield from edges(np.concatenate(held, axis=1))

    def edges(rows: np.ndarray):
        if rows.shape[1] > 1:
            runs = np.cumsum(np.concatenate([[0], (rows[0, 1:] != rows[0, :-1]) | (rows[2, 1:] != rows[2, :-1])]))
            a, b = group_links(runs, rows[1], rows[3].view(np.uint64), max_bits)
            if len(a):
                yield pa.record_batch([pa.array(rows[3][a]), pa.array(rows[3][b])], ["a", "b"])

    dealt = keyed.select(*columns).repartition("k", "key").sortWithinPartitions("k", "key", "fp")
    return dealt.mapInArrow(task, "a long, b long")


def with_keys(fps: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    keys = [
        F.struct(
            F.lit(k).cast("long").alias("k"),
            F.lit(start).cast("long").alias("start"),
            F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("key"),
        )
        for k, (start, mask) in enumerate(masks)
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("s")).select("s.*", "fp")


def links_half_way(fps: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): every fingerprint with the smallest one that shares a value half way. Linear in the fingerprints."""
    reach = max_bits // 2
    masks = [sum(1 << i for i in c) for r in range(reach + 1) for c in combinations(range(BITS), r)]

    def task(batches):
        flips = np.array(masks, np.uint64).view(np.int64)
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for part in np.array_split(fp, max(1, len(fp) // 256)):
                values = (part[:, None] ^ flips[None, :]).ravel()
                yield pa.record_batch([pa.array(values), pa.array(np.repeat(part, len(flips)))], ["half", "fp"])

    halves = fps.select("fp").mapInArrow(task, "half long, fp long")
    first = halves.groupBy("half").agg(F.min("fp").alias("a"))
    joined = halves.join(first, "half").select("a", F.col("fp").alias("b")).filter("a <> b").distinct()
    return joined


def fingerprint_links(fps: DataFrame, max_bits: int = 4, dense: int | None = None) -> DataFrame:
    """(a, b) edges that connect distinct fingerprints within ``max_bits``; all links, none beyond."""
    count = fps.count()
    dense = dense if dense is not None else max(DENSE, int(count * DENSE_SHARE))
    depth = key_depth(count, max_bits)
    keyed = with_keys(fps, key_masks(max_bits, depth))
    # the groups of the first segment alone are few (2 ** 13 values for each of 5), so their sizes are known cheaply
    sizes = with_keys(fps, key_masks(max_bits, 0)).groupBy("k", "key").count().filter(F.col("count") > dense)
    crowded = sizes.select(F.col("k").alias("start"), F.col("key").alias("first")).collect()
    if not crowded:
        return links_of_groups(keyed, max_bits).distinct()
    ring = [signed(s) for s in segments(max_bits)]
    mark = F.broadcast(fps.sparkSession.createDataFrame(crowded, "start long, first long")).withColumn("crowded", F.lit(True))
    first = F.element_at(F.array(*[F.col("fp").bitwiseAND(F.lit(s)) for s in ring]), F.col("start").cast("int") + 1)
    keyed = keyed.withColumn("first", first).join(mark, ["start", "first"], "left")
    calm = keyed.filter("crowded IS NULL")
    busy = keyed.filter("crowded")
    groups = busy.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n"))
    large = groups.filter(F.col("n") > dense).select("k", "key")
    rest = busy.join(large, ["k", "key"], "left_anti").select("k", "start", "key", "fp")
    if max_bits % 2:
        raise ValueError("a value half way exists for an even max_bits only")
    swarm = busy.join(large, ["k", "key"], "left_semi").select("fp").distinct()
    near = links_of_groups(calm.select("k", "start", "key", "fp").unionByName(rest), max_bits)
    return near.unionByName(links_half_way(swarm, max_bits)).distinct()


# ---- components ----


def near_duplicates(
    df: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row with its fingerprint and component: (id, fingerprint, component_id, component_size).

    component_id is the smallest id that links lead to, component_size counts rows.
    """
    rows = stored(fingerprints(df, shingle, id_col, text_col), "fingerprints")
    fps = checkpointed(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    roots = connected_components(fingerprint_links(fps.select("fp"), max_bits))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = named.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("component_size"))
    by_fp = named.join(classes, "root").select("fp", "component_id", "component_size")
    return rows.join(by_fp, "fp").select(
        "id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id", "component_size"
    )


def drop_near_duplicates(
    df: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``df`` with one row of each component, that of the smallest id."""
    found = near_duplicates(df, shingle, max_bits, id_col, text_col)
    gone = found.filter(F.col("id") != F.col("component_id")).select(F.col("id").alias(id_col))
    return without(df, stored(gone, "near-gone"), id_col)
