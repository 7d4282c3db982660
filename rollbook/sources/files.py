"""File names: exports carry their year and faculty in the name, snapshots their date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.strings import extract


def decode_path(path: Column) -> Column:
    """The plain path. File metadata is URL-encoded: a blank reads %20, a plus sign stays one."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def export_path() -> Column:
    """Decoded path of the row's file."""
    return decode_path(F.col("_metadata.file_path"))


def _without_part(path: Column) -> Column:
    """The path up to the export, without part files and numbered sub-folders."""
    return F.regexp_replace(path, r"(/\w+=\d+)*/part-[^/]*$", "")


def export_name(path: Column | None = None) -> Column:
    """Name of the export a row came from. A table written by Spark is a folder of part files;
    its export name is the folder's, as for a single file it is the file's."""
    whole = _without_part(path if path is not None else export_path())
    return F.element_at(F.split(whole, "/"), -1)


def name_part(name: Column, pattern: str) -> Column:
    """First match of a pattern in a file name, NULL without one."""
    return extract(name, pattern)


def list_files(spark: SparkSession, folder: str, pattern: str = ".*") -> DataFrame:
    """(path, name) of the exports whose name matches. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    paths = files.select(_without_part(F.col("path")).alias("path")).distinct()
    return (paths.withColumn("name", F.element_at(F.split("path", "/"), -1))
            .filter(F.col("name").rlike(pattern)))


def latest_path(files: DataFrame, date_pattern: str = r"\d{4}-?\d{2}-?\d{2}") -> str:
    """Path of the file with the latest date in its name."""
    digits = F.replace(extract(F.col("name"), date_pattern), F.lit("-"), F.lit(""))
    dated = files.withColumn("date", F.try_to_date(digits, "yyyyMMdd")).filter(F.col("date").isNotNull())
    newest = dated.agg(F.max_by("path", F.struct("date", "name")).alias("path")).first()["path"]
    if newest is None:
        raise FileNotFoundError("no file with a date in its name")
    return newest
