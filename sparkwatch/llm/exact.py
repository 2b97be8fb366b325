"""Exact duplicates through an extendible-hash index on shared files.

The index holds a slim entry per document (64-bit hash, id, digest) and none of the texts. A directory over the leading
hash bits doubles for as long as a bucket holds more distinct hashes than its capacity, and only overfull buckets are split
by it; copies share one hash and count once, so a group of any size leaves its bucket as it is. Owner tasks process key
ranges of the directory. Hashes with one entry need no comparison. The texts of the others are compared byte by byte: equal
ones collapse within the scanning task already, and what is left of a hash forms a chain of different texts. Where a chain
has several texts, its documents are told apart by their bytes.

Defined results: a null text counts as empty; a null id stays where no other id has the text; of repeated ids each row is one document; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bitmap_of, marked, stored, without

CAPACITY = 100_000  # distinct hashes of a bucket
MAX_BUCKETS = 1 << 14  # the directory stays within this; beyond it buckets grow with the data


def hash_of(text: F.Column, hash_bits: int) -> F.Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - hash_bits) if hash_bits < 64 else F.xxhash64(text)


def directory(keys: DataFrame, hash_bits: int, capacity: int) -> list[tuple[int, int]]:
    """(depth, prefix) of every bucket, in key order. ``keys`` has the distinct hashes.

    Each round counts the entries of overfull buckets one bit deeper; the counts fit the directory, not the data.
    """
    total = keys.count()
    capacity = max(capacity, -(-total // MAX_BUCKETS))
    done: list[tuple[int, int]] = []
    depth, full = 0, [0] if total > capacity else []
    if not full:
        return [(0, 0)]
    step = max(1, min(hash_bits, (total // capacity).bit_length()))
    while full and depth < hash_bits:
        deeper = min(hash_bits, depth + step)
        prefix = F.shiftrightunsigned("h", hash_bits - deeper)
        parent = F.shiftrightunsigned("h", hash_bits - depth) if depth else F.lit(0).cast("long")
        counts = {r[0]: r[1] for r in keys.filter(parent.isin(full)).groupBy(prefix.alias("p")).count().collect()}
        children = [(f << (deeper - depth)) + i for f in full for i in range(1 << (deeper - depth))]
        full = [p for p in children if counts.get(p, 0) > capacity]
        done += [(deeper, p) for p in children if p not in set(full)]
        depth, step = deeper, 1
    done += [(depth, p) for p in full]
    return sorted(done, key=lambda b: b[1] << (hash_bits - b[0]))


def bucket_of(h: F.Column, buckets: list[tuple[int, int]], hash_bits: int) -> F.Column:
    """Number of the bucket of a hash: one look-up in the directory at its full depth."""
    depth = max(d for d, _ in buckets)
    slots = [n for n, (d, _) in enumerate(buckets) for _ in range(1 << (depth - d))]
    if depth == 0:
        return F.lit(0)
    return F.element_at(F.lit(slots), (F.shiftrightunsigned(h, hash_bits - depth) + 1).cast("int"))


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64, capacity: int = CAPACITY
) -> DataFrame:
    """Every row as (id, keep_id, group_size, kept, text_sha256); of equal texts the largest id stays."""
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("h", hash_of(F.col("text"), hash_bits))
    entries = stored(docs.select("h", "id", F.sha2("text", 256).alias("sha")), "exact-entries")
    keys = entries.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    buckets = directory(keys, hash_bits, capacity)
    index = stored(keys.withColumn("bucket", bucket_of(F.col("h"), buckets, hash_bits)), "exact-index", "bucket")

    # equal bytes collapse in the scanning task, then with the owner of the key range; what is left of a hash is its chain
    chains = stored(
        marked(docs, "h", bitmap_of(index.filter("n > 1"), "h"))
        .filter("__hit")
        .groupBy(bucket_of(F.col("h"), buckets, hash_bits).alias("bucket"), "h", "text")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max("id").alias("keep_id"))
        .withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("bucket", "h")))
        .withColumn("text", F.when(F.col("texts") > 1, F.col("text"))),
        "exact-chains",
    )
    single = chains.filter("texts = 1").select("h", "keep_id", "group_size")
    if not (collided := chains.filter("texts > 1")).isEmpty():
        told_apart = docs.join(collided.select("h", "text", "keep_id", "group_size"), ["h", "text"])
        apart = told_apart.select("h", "id", F.sha2("text", 256).alias("sha"), "keep_id", "group_size")
        alone = entries.join(collided.select("h").distinct(), "h", "left_anti")
        return finish(alone, single).unionByName(finish_rows(apart))
    return finish(entries, single)


def finish(entries: DataFrame, single: DataFrame) -> DataFrame:
    return finish_rows(entries.join(single, "h", "left"))


def finish_rows(rows: DataFrame) -> DataFrame:
    keep = F.coalesce("keep_id", "id")
    return rows.select(
        "id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the largest id of each group of equal texts."""
    gone = exact_duplicates(df, id_col, text_col).filter(~F.col("kept")).select(F.col("id").alias(id_col))
    return without(df, stored(gone, "exact-gone"), id_col)
