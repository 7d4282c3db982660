"""Files cut into byte ranges, so that every byte of the data is read by one task.

The plan lists the files, reads the few lines above the data of each to find the byte where its data starts, and cuts the
rest into splits. A split's task reads the lines that start in its range. A line is known by its file and byte offset,
which does not depend on how the file was cut.

Tasks open files through the file system that the path names. Lines end in a line feed, with or without a carriage return before it.
Compressed files are not cut; their offsets are those of the unpacked bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .encoding import decoded, repair_encoding

SPLIT_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
MOST_TASKS = 100_000  # further splits share tasks
COMPRESSED = r"\.(gz|bz2|zst|lz4)$"
LINES = "source_file string, source_offset long, value string"


def file_system(path: str):
    """(file system, path in it) of a path as Spark lists it."""
    from urllib.parse import quote

    from pyarrow import fs

    if path.startswith("file:") or path.startswith("/"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/"))


def _chunks(path: str, start: int) -> Iterator[bytes]:
    """The file's bytes from `start` on; a compressed file is unpacked."""
    import re

    system, inner = file_system(path)
    if re.search(COMPRESSED, path):
        with system.open_input_stream(inner) as stream:  # unpacks by the file's ending
            stream.read(start)
            while chunk := stream.read(CHUNK_BYTES):
                yield chunk
    else:
        with system.open_input_file(inner) as file:
            file.seek(start)
            while chunk := file.read(CHUNK_BYTES):
                yield chunk


def data_start(path: str, skip: int) -> int | None:
    """Offset of the byte after the first `skip` lines; None if the file has no more lines."""
    if skip <= 0:
        return 0
    before = 0
    for chunk in _chunks(path, 0):
        ends = chunk.count(b"\n")
        if ends >= skip:
            at = -1
            for _ in range(skip):
                at = chunk.index(b"\n", at + 1)
            return before + at + 1
        skip -= ends
        before += len(chunk)
    return None


def split_lines(path: str, first: int, last: int | None, data: int) -> Iterator:
    """(offsets, lines as bytes) of the lines that start in [first, last), in batches. A line that starts there is read to
    its end, also beyond `last`."""
    import numpy as np

    skipping = first > data  # unless the byte before it ends a line, `first` is within one
    at = first - 1 if skipping else first  # offset of the first byte in `held`
    held: list[bytes] = []
    for chunk in _chunks(path, at):
        end = chunk.find(b"\n") if skipping else 0
        if skipping:
            at += len(chunk) if end < 0 else end + 1
            if last is not None and at >= last:
                return
            if end < 0:
                continue
            chunk, skipping = chunk[end + 1:], False
        held.append(chunk)
        if b"\n" not in chunk:
            continue
        whole = b"".join(held)
        stop = whole.rfind(b"\n") + 1
        starts = np.append(0, np.flatnonzero(np.frombuffer(whole, np.uint8, stop - 1) == 10) + 1)
        ours = starts if last is None else starts[starts + at < last]
        end = stop if len(ours) == len(starts) else int(starts[len(ours)])
        if len(ours):
            yield ours + at, _lines(whole[:end], ours)
        at += stop
        if last is not None and at >= last:
            return
        held = [whole[stop:]]
    rest = b"".join(held)
    if rest and not skipping:
        yield np.array([at]), _lines(rest, np.array([0]))


def _lines(data: bytes, starts):
    """The lines of `data` that start at the given places, without their ends."""
    import numpy as np
    import pyarrow as pa

    held = np.frombuffer(data, np.uint8)
    feed = np.flatnonzero(held == 10)
    feed = np.union1d(feed, feed[(feed > 0) & (held[feed - 1] == 13)] - 1)
    offsets = np.append(starts - np.searchsorted(feed, starts), len(held) - len(feed)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.delete(held, feed))])


def list_data(spark: SparkSession, paths: str | Sequence[str], skip: int, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, data, first, last) of every split: the file, where its data starts, and the byte range; `last` is missing for
    a compressed file. Contents are not read, but for the lines above the data."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "length")

    def starts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [data_start(path, skip) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(found, pa.int64())], names=["path", "length", "data"])

    found = files.filter("length > 0").mapInArrow(starts, "path string, length long, data long") if skip > 0 else (
        files.filter("length > 0").withColumn("data", F.lit(0).cast("long")))
    whole = F.col("path").rlike(COMPRESSED)
    size = F.lit(split_bytes)
    firsts = F.when(whole, F.array("data")).when(F.col("data") < F.col("length"), F.sequence("data", F.col("length") - 1, size))
    splits = found.filter("data IS NOT NULL").select("path", "data", F.col("length"), whole.alias("whole"), F.explode(firsts).alias("first"))
    last = F.when(~F.col("whole"), F.least(F.col("first") + size, F.col("length")))
    return splits.select("path", "data", "first", last.alias("last"))


def read_lines(spark: SparkSession, paths: str | Sequence[str], skip: int = 0, encoding: str = "utf-8", repair: bool = False,
               split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(source_file, source_offset, value): the lines of all files below the paths, without the first `skip` of each file.
    With `repair` every line has an encoding of its own: see `encoding`."""
    splits = list_data(spark, paths, skip, split_bytes)
    tasks = min(max(splits.count(), 1), MOST_TASKS)

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for path, data, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                for offsets, lines in split_lines(path, first, last, data):
                    step = max(1, min(len(lines), 1 << 16))
                    for start in range(0, len(lines), step):
                        part = lines.slice(start, step)
                        yield pa.RecordBatch.from_arrays([pa.array([path] * len(part), pa.string()), pa.array(offsets[start:start + step], pa.int64()),
                                                          decoded(part, encoding, repair)], names=["source_file", "source_offset", "value"])

    lines = splits.repartition(tasks).mapInArrow(read, LINES)
    return lines.withColumn("value", repair_encoding(F.col("value"))) if repair else lines
