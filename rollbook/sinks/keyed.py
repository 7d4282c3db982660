"""Tables that are updated by key, copy on write.

Rows lie in buckets by the hash of their key. A commit lists, for every bucket, the version whose folder holds it. An upsert reads and
writes again only the buckets that the new keys fall in, and commits a list in which these point to the new
version: replacing few keys of a large table costs few buckets, and readers see all of it or nothing.

The list is one text with an entry a bucket, so buckets are bounded (`MOST_BUCKETS`); choose as many as make a bucket a few files.
A bucket with a hot key has several files. Rows without a key have a bucket of their own, which the next upsert drops.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..names import Key, col, cols, pairs
from ..operators.joins import anti
from .commits import Conflict, commit, latest, new_version

BUCKETS = 256
MOST_BUCKETS = 65_536
BUCKET = "__bucket"
NO_KEY = -1
TRIES = 5


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    missing = F.greatest(*[col(k).isNull() for k in keys], F.lit(False))
    return df.withColumn(BUCKET, F.when(missing, F.lit(NO_KEY)).otherwise(F.pmod(F.xxhash64(*cols(keys)), F.lit(buckets)).cast("int")))


def _write(df: DataFrame, path: str) -> list[int]:
    """Write a version, a folder for each bucket, and return the buckets it has."""
    spark = df.sparkSession
    # AQE puts small buckets together in a task and cuts a large one into several files
    df.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
    schema = T.StructType([T.StructField(BUCKET, T.IntegerType())])
    return [r[0] for r in spark.read.schema(schema).parquet(path).distinct().collect()]


def _read(spark: SparkSession, path: str, state: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(state["schema"])
    held = {int(b): v for b, v in state["versions"].items()}
    wanted = [f"{path.rstrip('/')}/{v}/{BUCKET}={b}" for b, v in held.items() if buckets is None or b in buckets]
    # an empty list of paths is no table for Spark
    return spark.read.schema(schema).parquet(*wanted) if wanted else spark.createDataFrame([], schema)


def create_keyed(df: DataFrame, path: str, keys: str | Sequence[str], buckets: int = BUCKETS) -> None:
    """Write a table that can be upserted by `keys`. A table that is there already is replaced in one commit."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MOST_BUCKETS}")
    spark, keys = df.sparkSession, [keys] if isinstance(keys, str) else list(keys)
    number, _ = latest(spark, path)
    version = new_version(path)
    found = _write(_bucketed(df, keys, buckets), version)
    state = {"keys": keys, "buckets": buckets, "schema": json.loads(df.schema.json()),
             "versions": {str(b): version.rsplit("/", 1)[1] for b in found}}
    commit(spark, path, number + 1, json.dumps(state))


def _state(spark: SparkSession, path: str) -> tuple[int, dict]:
    number, text = latest(spark, path)
    if text is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    return number, json.loads(text)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, _state(spark, path)[1])


def upsert_keyed(new: DataFrame, path: str, on: Key | Sequence[Key] | None = None) -> list[int]:
    """Replace the rows whose key is among the new rows' and add the new rows, in one commit. Returns the buckets that
    were written. Old rows without a key are dropped. Keys go by the table's names, or pairs of its name and the new rows' one; the new
    rows are cast to the table's types."""
    spark = new.sparkSession
    for _ in range(TRIES):
        number, state = _state(spark, path)
        schema = T.StructType.fromJson(state["schema"])
        names = dict(pairs(on)) if on else {k: k for k in state["keys"]}
        if sorted(names) != sorted(state["keys"]):
            raise ValueError(f"the table's keys are {state['keys']}")
        typed = new.select(*[col(names.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in schema])
        rows = _bucketed(typed, state["keys"], state["buckets"])
        touched = {r[0] for r in rows.select(BUCKET).distinct().collect()}  # at most one for each bucket
        kept = {b: v for b, v in state["versions"].items() if int(b) != NO_KEY and int(b) not in touched}
        replaced = sorted(b for b in touched if b != NO_KEY)
        old = _bucketed(_read(spark, path, state, replaced), state["keys"], state["buckets"])
        version = new_version(path)
        written = _write(anti(old, typed, state["keys"]).unionByName(rows), version)
        state["versions"] = kept | {str(b): version.rsplit("/", 1)[1] for b in written}
        try:
            commit(spark, path, number + 1, json.dumps(state))
            return sorted(written)
        except Conflict:
            continue
    raise Conflict(f"{path} was changed {TRIES} times during the upsert")
