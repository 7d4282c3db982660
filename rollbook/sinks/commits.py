"""Commits of versioned folders.

A table's folder holds versions, which are written in full before anyone reads them, and numbered commit files. The last commit says
what the table is now; a version without a commit (its writer was killed) is never seen. A commit file is created only
if its number is free, so of two writers that start from the same state one fails and can try again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

COMMITS = "_commits"  # hidden from Spark's file listing
END = "\n"            # a commit file without it is still being written


class Conflict(RuntimeError):
    """Another writer committed first."""


def _hadoop(spark: SparkSession, path: str):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = fs.Path(path)
    return fs, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_version(path: str) -> str:
    return f"{path.rstrip('/')}/v-{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, number: int, text: str) -> None:
    fs, target, system = _hadoop(spark, f"{path.rstrip('/')}/{COMMITS}/{number:012d}")
    try:
        out = system.create(target, False)
    except Exception as error:  # noqa: BLE001 - the file system's own kinds of "exists already"
        if system.exists(target):
            raise Conflict(f"commit {number} of {path} was made by another writer") from error
        raise
    try:
        out.write(bytearray((text + END).encode()))
    finally:
        out.close()


def latest(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number to build on and text of the last whole commit; (0, None) without any."""
    found = history(spark, path)
    whole = next(((n, t) for n, t in reversed(found) if t is not None), (0, None))
    return (found[-1][0] if found else 0), whole[1]


def history(spark: SparkSession, path: str) -> list[tuple[int, str | None]]:
    """All commits in order; one that was not written to its end has no text."""
    fs, target, system = _hadoop(spark, f"{path.rstrip('/')}/{COMMITS}")
    if not system.exists(target):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(target) if s.getPath().getName().isdigit())
    read = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    out = []
    for name in names[-KEPT:]:
        stream = system.open(fs.Path(target, name))
        text = read.toString(stream, "UTF-8")
        stream.close()
        out.append((int(name), text[:-1] if text.endswith(END) else None))
    return out


KEPT = 10  # commits that are looked at; older ones may go


def remove_unused(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete versions that none of the last `keep` commits names, and return how many. Not to be called while another
    writer is at work: its version is not committed yet."""
    fs, target, system = _hadoop(spark, path)
    named = "".join(text for _, text in [c for c in history(spark, path) if c[1] is not None][-keep:])
    folders = [s.getPath() for s in system.listStatus(target) if s.getPath().getName().startswith("v-")]
    unused = [f for f in folders if f.getName() not in named]
    for folder in unused:
        system.delete(folder, True)
    return len(unused)
