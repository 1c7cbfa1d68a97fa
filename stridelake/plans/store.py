"""Versioned lake roots.

A root holds ``versions/<id>/<layer>/<table>`` folders, written once and never
changed, and for incremental lakes the append-only ``streams/...`` tables.  One
small file, ``_current.json``, names the folder of every table of the published
version; it is replaced by a rename, so readers see the old version or the new
one, and a failed run publishes nothing.  A table that is not named is not
part of the version (a mart left as a view), whatever older files lie around.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from stridelake.schemas import TABLES

POINTER = "_current.json"


class NoLake(RuntimeError):
    """The folder holds no published lake."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def published(spark: SparkSession, root: str) -> dict | None:
    """``{"kind", "version", "tables": {name: folder below the root}}``, or None."""
    fs, path = _fs(spark, f"{root.rstrip('/')}/{POINTER}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def expect_kind(spark: SparkSession, root: str, kind: str) -> dict | None:
    """The published version, if the root is new or of this kind; batch and incremental lakes don't mix."""
    now = published(spark, root)
    if now is not None and now["kind"] != kind:
        raise ValueError(f"{root} holds a lake of kind {now['kind']}; a {kind} run needs a root of its own")
    return now


def new_version() -> str:
    return f"versions/{uuid.uuid4().hex[:12]}"


def folder(version: str, name: str) -> str:
    return f"{version}/{TABLES[name].layer}/{name}"


def publish(spark: SparkSession, root: str, kind: str, version: str, tables: dict[str, str]) -> None:
    root = root.rstrip("/")
    fs, _ = _fs(spark, root)
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps({"kind": kind, "version": version, "tables": tables}).encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"), overwrite)
