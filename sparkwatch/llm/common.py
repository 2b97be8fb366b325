"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from functools import cache, reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwatch.session import ensure_checkpoint_dir, shared_dir

CHUNK_CHARS = 2_000_000  # of text that a task holds decoded at once (one longer text is a chunk of its own)
BITMAP_BITS = 1 << 25  # 4 MB, the bound of a broadcast bitmap


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Lineage cut in the shared checkpoint folder of the cluster."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str, *partition: str) -> DataFrame:
    """Written as Parquet to the shared folder and read back: for what is used several times and is not small."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a ``stored`` table that nothing reads any more, and what shuffles nothing refers to have left.

    Spark removes a shuffle's files only when the driver's garbage is collected, which may be long after the disk has filled.
    """
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of Arrow batches whose texts stay within CHUNK_CHARS bytes, with the texts as Python values (null: None).

    After each batch, memory that texts have left free goes back to the system: a worker lives on and serves other steps.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > CHUNK_CHARS:
                yield batch.slice(start, i - start), column.slice(start, i - start).to_pylist()
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start), column.slice(start).to_pylist()
        free_unused()


@cache
def heap_trimmer():
    """The C library's malloc_trim, or nothing where it has none."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    return (lambda: trim(0)) if trim else (lambda: None)


def free_unused() -> None:
    """Give memory that this process has freed back to the system; small values freed between others keep heaps large."""
    pa.default_memory_pool().release_unused()
    heap_trimmer()()


def slot_of(key: str) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS))


def bitmap_of(df: DataFrame, key: str) -> DataFrame:
    """(block, bits): a bitmap of the keys by hash, of bounded size whatever the data."""
    slots = df.select(slot_of(key).alias("slot"))
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )


def marked(df: DataFrame, key: str, bitmap: DataFrame) -> DataFrame:
    """``df`` with a column ``__hit``: false only if the key is not among those of the bitmap."""
    slotted = df.withColumn("__slot", slot_of(key)).withColumn("__block", F.bitmap_bucket_number("__slot"))
    named = F.broadcast(bitmap.select(F.col("block").alias("__block"), F.col("bits").alias("__bits")))
    place = F.bitmap_bit_position("__slot")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return slotted.join(named, "__block", "left").withColumn("__hit", hit).drop("__slot", "__block", "__bits")


def without(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``gone``. Only rows that a bitmap takes for gone are moved to be compared."""
    seen = marked(df, key, bitmap_of(gone, key))
    kept = seen.filter(~F.col("__hit") | F.col(key).isNull())
    return kept.unionByName(seen.filter("__hit").join(gone.select(key), key, "left_anti")).select(df.columns)


def unsigned_hex(column) -> F.Column:
    """A long as 16 lowercase hex digits of its 64 bits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
