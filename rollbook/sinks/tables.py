"""Writing tables to a folder or object store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..names import Key, col, cols, pairs
from ..operators.joins import anti
from ..sources.delimited import write_european_csv
from .commits import commit, latest, new_version


def write_table(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Publish parquet, or csv with ";" and decimal commas. The path may be on any store. A table that is there already
    is replaced: the new version is written in full beside it and one commit makes it the current one, so that readers, and the
    next run after a writer was killed, see the old or the new table. Read it through `current`."""
    if not path:
        raise ValueError("a path is needed")
    if kind not in ("parquet", "csv"):
        raise ValueError("kind must be 'parquet' or 'csv'")
    spark, version = df.sparkSession, new_version(path)
    number, _ = latest(spark, path)
    if kind == "parquet":
        df.write.parquet(version)
    else:
        write_european_csv(df, version)
    commit(spark, path, number + 1, version.rsplit("/", 1)[1])


def current(spark: SparkSession, path: str) -> str:
    """The folder of the version that is published at the path; a plain folder or file is its own."""
    _, version = latest(spark, path)
    return f"{path.rstrip('/')}/{version}" if version else path


def write_to_store(df: DataFrame, store: str, container: str, name: str, kind: str = "parquet") -> str:
    """Write to store/container/name.kind after checking the arguments; returns the path, to be read through `current`."""
    if not isinstance(df, DataFrame):
        raise TypeError("a DataFrame is needed")
    for label, value in (("store", store), ("container", container), ("name", name)):
        if not value:
            raise ValueError(f"{label} must not be empty")
    path = "/".join([store.rstrip("/"), container.strip("/"), f"{name}.{kind}"])
    write_table(df, path, kind)
    return path


def upsert(old: DataFrame, new: DataFrame, on: Key | Sequence[Key]) -> DataFrame:
    """The old rows without those whose key is replaced, and the new rows. Old rows without a
    key are dropped. For a table on disk `keyed.upsert_keyed` writes only the part that changes."""
    keys = [l for l, _ in pairs(on)]
    kept = old.dropna(subset=keys) if all("." not in k for k in keys) else old.filter(
        " AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return anti(kept, new, on).unionByName(new.select(*cols(old.columns)))


def latest_log(log: DataFrame, key: str, at: str) -> DataFrame:
    """One row per key of a log that was only appended to: the last one written."""
    from ..operators.windows import keep_first
    return keep_first(log.filter(col(key).isNotNull()), [key], ["-" + at])
