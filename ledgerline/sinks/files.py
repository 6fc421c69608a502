"""Small files of the shared file system: replaced or created in one step.

Spark writes tables; what names the valid version of a table, and what says
that a load is done, is one small text file each.  A file is written beside
its place under a hidden name and renamed, so a reader sees the whole old file
or the whole new one.  (On an object store, where a rename is a copy, the
write itself is the atomic step.)
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return jvm, fs, fs.makeQualified(p)


def exists(spark: SparkSession, path: str) -> bool:
    _, fs, p = _path(spark, path)
    return fs.exists(p)


def has_data(spark: SparkSession, path: str) -> bool:
    """A folder with a finished write or with any entry."""
    _, fs, p = _path(spark, path)
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def delete(spark: SparkSession, path: str) -> bool:
    _, fs, p = _path(spark, path)
    return fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    _, fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    jvm, fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace the file by a rename."""
    jvm, fs, p = _path(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_tmp-{uuid.uuid4().hex}")
    stream = fs.create(tmp, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(tmp, p, options)


# --- versions of a folder ------------------------------------------------------------
POINTER = "_current"
KEEP = 2
HISTORY = 64  # published versions that the pointer names


class StaleVersion(RuntimeError):
    """Another writer published a version meanwhile."""


def current(spark: SparkSession, base: str) -> dict | None:
    """{"version", "path", "meta"} of the published version, if any."""
    text = read_text(spark, f"{base.rstrip('/')}/{POINTER}")
    if text is None:
        return None
    at = json.loads(text)
    return at | {"path": version_path(base, at["version"])}


def version_path(base: str, version: str) -> str:
    return f"{base.rstrip('/')}/version-{version}"


def new_version(spark: SparkSession, base: str) -> str:
    """A name after all earlier ones, so names sort by age; the folder of a
    crashed writer is never reused."""
    names = [c for c in children(spark, base) if c.startswith("version-")]
    last = max((int(c.split("-")[1]) for c in names), default=0)
    return f"{last + 1:08d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, base: str, version: str, meta: dict, expected: str | None) -> None:
    """Make ``version`` the one that readers see, as the last step of a write.
    ``expected`` is the version the writer started from: if another one was
    published meanwhile, nothing changes (one writer at a time is assumed; the
    check finds a second one, it does not lock it out)."""
    at = current(spark, base)
    if (at and at["version"]) != expected:
        raise StaleVersion(f"{base}: expected {expected}, found {at and at['version']}")
    published = [*(at["published"] if at else []), version][-HISTORY:]
    text = json.dumps({"version": version, "meta": meta, "published": published})
    write_text(spark, f"{base.rstrip('/')}/{POINTER}", text)


def prune(spark: SparkSession, base: str, keep: int = KEEP) -> list[str]:
    """Delete the version folders up to the published one, but for the last
    ``keep`` that were published; jobs that still read an older one need a
    greater ``keep``.  Folders after the published one may be a write in
    progress and stay."""
    at = current(spark, base)
    if at is None:
        return []
    kept = {f"version-{v}" for v in at["published"][-keep:]}
    names = [c for c in children(spark, base) if c.startswith("version-")]
    old = [c for c in names if c <= f"version-{at['version']}" and c not in kept]
    for name in old:
        delete(spark, f"{base.rstrip('/')}/{name}")
    return old
