"""Versioned table snapshots: a table that is rewritten from its own content is never overwritten in place.

A version may hold only the partitions that changed: what is noted with it says in which version's folder each of the
other partitions lies, and they are carried over unread.
"""

from __future__ import annotations

import json
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .layers import write_layer


def _fs(spark: SparkSession, path: str):
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    return base.getFileSystem(spark._jsc.hadoopConfiguration()), base


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def list_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, base = _fs(spark, path)
    if not fs.exists(base):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(base) if s.isDirectory() and s.getPath().getName().startswith(prefix))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Complete versions under ``root``, oldest first; the commit marker tells which ones are complete."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    found = []
    for status in fs.listStatus(base):
        path = status.getPath()
        name = path.getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            found.append((int(name[2:]), path.toString()))
    return sorted(found)


def snapshot_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest complete version, or None."""
    versions = _versions(spark, root)
    return versions[-1][1] if versions else None


def read_snapshot(spark: SparkSession, root: str, only: Collection[str] | None = None) -> DataFrame | None:
    """The newest version under the schema it was written with: no partition value is guessed at from its text.

    ``only`` names partition folders (``column=value``) to read of a table that is kept by partitions.
    """
    path = snapshot_path(spark, root)
    if path is None:
        return None
    about = _about(spark, root, path)
    reader = spark.read.schema(StructType.fromJson(about["schema"])) if about else spark.read
    if not about or about.get("parts") is None:
        return reader.parquet(path)
    paths = [f"{root}/{version}/{folder}" for folder, version in sorted(about["parts"].items()) if only is None or folder in only]
    if not paths:
        return spark.createDataFrame([], StructType.fromJson(about["schema"]))
    return reader.option("basePath", root).parquet(*paths).drop("v")


def snapshot_parts(spark: SparkSession, root: str, partition: str) -> dict[str, str]:
    """{partition folder: version that holds it} of the newest version."""
    path = snapshot_path(spark, root)
    if path is None:
        return {}
    about = _about(spark, root, path)
    if about and about.get("parts") is not None:
        return about["parts"]
    version = path.rstrip("/").rpartition("/")[2]  # written as a whole
    return {folder: version for folder in list_folders(spark, path, f"{partition}=")}


def _about(spark: SparkSession, root: str, path: str) -> dict | None:
    text = _read_text(spark, f"{root}/_about/{path.rstrip('/').rpartition('/')[2]}.json")
    return json.loads(text) if text else None


def snapshot_note(spark: SparkSession, root: str):
    """What the writer of the newest version noted with it."""
    path = snapshot_path(spark, root)
    about = _about(spark, root, path) if path else None
    return about["note"] if about else None


def expire_snapshots(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all but the newest ``keep`` versions. Readers of a removed version fail: keep as many as they need.

    Partitions that a version still refers to stay where they are.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    versions = _versions(spark, root)
    if len(versions) <= keep:
        return
    needed: set[str] = set()
    for _, path in versions[-keep:]:
        about = _about(spark, root, path)
        needed |= {f"{version}/{folder}" for folder, version in ((about or {}).get("parts") or {}).items()}
    oldest = versions[-keep][0]
    for name in list_folders(spark, root, "v="):
        if int(name[2:]) >= oldest:
            continue
        delete_path(spark, f"{root}/{name}/_SUCCESS")  # no version of its own any more
        left = [folder for folder in list_folders(spark, f"{root}/{name}", "") if f"{name}/{folder}" in needed]
        if left:
            for folder in set(list_folders(spark, f"{root}/{name}", "")) - set(left):
                delete_path(spark, f"{root}/{name}/{folder}")
        else:
            delete_path(spark, f"{root}/{name}")


def next_version(spark: SparkSession, root: str) -> int:
    versions = _versions(spark, root)
    return versions[-1][0] + 1 if versions else 1


def write_snapshot(df: DataFrame, root: str, partition_by=(), note=None, parts: dict[str, str] | None = None, **kwargs) -> str:
    """Write the next version. Readers see it once it is complete; a failed write leaves the old one current.

    Schema and ``note`` lie beside the versions and are written first, so a complete version has them. Older
    versions stay until ``expire_snapshots``, so running readers are not disturbed. ``parts`` tells where the
    partitions lie ({folder: version}, None for this one) if ``df`` has only some of them.
    """
    version = f"v={next_version(df.sparkSession, root):08d}"
    path = f"{root}/{version}"
    placed = None if parts is None else {folder: held or version for folder, held in parts.items()}
    about = {"schema": df.schema.jsonValue(), "note": note, "parts": placed}
    _write_text(df.sparkSession, f"{root}/_about/{version}.json", json.dumps(about))
    write_layer(df, path, partition_by, mode="overwrite", **kwargs)
    return path
