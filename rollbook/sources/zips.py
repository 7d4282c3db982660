"""Members of zip files as rows, from the directory at each archive's end.

The directory is a table of (path, member, offset, packed, size, method, crc). Members are dealt to tasks by size, the largest first,
and each task reads its members' own byte ranges: an archive of many members is read by many tasks, none reads a whole one.
A member is streamed; a single one can not be cut, as its bytes unpack from the start only.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.windows import number_rows
from ..session import shared_folder
from .files import list_files
from .splits import file_system

TASK_BYTES = 32 << 20
BATCH_LINES = 20_000
DIRECTORY = "path string, member string, offset long, packed long, size long, method int, crc long"
HEADER = 30  # fixed value: bytes of a member's own header before its name
ENCRYPTED = 1  # fixed value: flag bit


def list_members(spark: SparkSession, folder: str, pattern: str = r"\.zip$") -> DataFrame:
    """The directories of all archives below the folder whose name matches. Of the archives only their ends are read."""
    paths = list_files(spark, folder, pattern).select("path")

    def read(batches: Iterator) -> Iterator:
        import zipfile

        import pyarrow as pa

        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, inner = file_system(path)
                with system.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
                    held = [m for m in archive.infolist() if not m.is_dir()]
                if locked := [m.filename for m in held if m.flag_bits & ENCRYPTED]:
                    raise ValueError(f"members with a password in {path}: {locked[:3]}")
                columns = [[path] * len(held), [m.filename for m in held], [m.header_offset for m in held], [m.compress_size for m in held],
                           [m.file_size for m in held], [m.compress_type for m in held], [m.CRC for m in held]]
                types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                 names=["path", "member", "offset", "packed", "size", "method", "crc"])

    return paths.repartition(spark.sparkContext.defaultParallelism).mapInArrow(read, DIRECTORY)


def _open_member(file, row: dict):
    """The unpacked stream of a member, which checks its sum at the end."""
    import struct
    import zipfile

    file.seek(row["offset"])
    name, extra = struct.unpack("<HH", file.read(HEADER)[-4:])
    file.seek(row["offset"] + HEADER + name + extra)
    info = zipfile.ZipInfo(row["member"])
    info.compress_type, info.compress_size, info.file_size, info.CRC = row["method"], row["packed"], row["size"], row["crc"]
    return zipfile.ZipExtFile(file, "r", info)


def dealt(members: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The members in as many partitions as their bytes need, the largest ones apart."""
    spark = members.sparkSession
    shared_folder(spark)
    members = members.checkpoint()  # names and sizes only; read once, not again for each use below
    n, total = members.agg(F.count(F.lit(1)), F.coalesce(F.sum("packed"), F.lit(0))).first()
    tasks = max(1, min(n, max(-(-total // task_bytes), spark.sparkContext.defaultParallelism)))
    placed = number_rows(members, [], ["-packed", "path", "member", "offset"], "place")
    return placed.repartitionById(tasks, ((F.col("place") - 1) % tasks).cast("int")).drop("place")


def read_zip_lines(spark: SparkSession, folder: str, pattern: str = r"\.zip$", encoding: str = "utf-8", task_bytes: int = TASK_BYTES) -> DataFrame:
    """Lines of the files inside zip files: (source_file, source_member, source_line, value), numbered in each member from 0."""
    def unzip(batches: Iterator) -> Iterator:
        import io

        import pyarrow as pa

        def emit(row, first, lines):
            n = len(lines)
            return pa.RecordBatch.from_arrays(
                [pa.array([row["path"]] * n), pa.array([row["member"]] * n), pa.array(range(first, first + n), pa.int64()),
                 pa.array(lines, pa.string())], names=["source_file", "source_member", "source_line", "value"])

        for batch in batches:
            for row in batch.to_pylist():
                system, inner = file_system(row["path"])
                with system.open_input_file(inner) as file, _open_member(file, row) as raw:
                    place, lines = 0, []
                    for line in io.TextIOWrapper(raw, encoding=encoding, newline=None):
                        lines.append(line.rstrip("\n"))
                        if len(lines) == BATCH_LINES:
                            yield emit(row, place, lines)
                            place, lines = place + len(lines), []
                    if lines:
                        yield emit(row, place, lines)

    members = dealt(list_members(spark, folder, pattern), task_bytes)
    return members.mapInArrow(unzip, "source_file string, source_member string, source_line long, value string")
