"""One JSON body per row, and sending the bodies on."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from ..names import col, cols
from ..operators.joins import anti
from ..operators.windows import keep_first
from ..sources.splits import file_system


def row_payloads(df: DataFrame, key: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """`key` columns and `body`: the row as JSON, missing values left out."""
    columns = columns or [c for c in df.columns if c not in key]
    return df.select(*cols(key), F.to_json(F.struct(*cols(columns))).alias("body"))


def send_payloads(payloads: DataFrame, key: str, sender: Callable[[str], tuple[int, str]], path: str, batch_rows: int = 100) -> DataFrame:
    """Send every body and keep (key, status, content, attempt) in a ledger at `path`; an error becomes a
    row with status "Error" and does not stop the rest. The ledger keeps all attempts; returned is each key's latest.

    `sender(body)` returns a status and a text. Rows are dealt to batches of about `batch_rows` by a hash of the key, and a task
    writes a batch's results to the ledger before it opens the next one. A task that runs again finds them there, so it sends
    only its open batch again, and not even that if it ended by an error in Python. A second call sends only what has no good
    result in the ledger, also after a job that failed. Repeated keys are sent once. The receiving side should still treat `key` as the identity
    of a row; speculative execution must be off."""
    spark = payloads.sparkSession
    schema = f"`{key}` string, status string, content string, attempt int"
    todo = payloads.select(col(key).cast("string").alias("key"), "body")
    attempt = 0
    try:
        earlier = spark.read.schema(schema).parquet(path)
        todo = anti(todo, earlier.filter(F.col("status").startswith("2")).select(col(key).alias("key")), "key")
        attempt = (earlier.agg(F.max("attempt")).first()[0] or 0) + 1
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    todo = todo.groupBy("key").agg(F.min("body").alias("body"))
    batches = max(1, -(-todo.count() // batch_rows))
    dealt = todo.withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(batches)))
    dealt = dealt.repartition("batch").sortWithinPartitions("batch", "key")
    dealt.mapInArrow(_send(sender, key, path, attempt), "batch long").write.format("noop").mode("overwrite").save()
    return keep_first(spark.read.schema(schema).parquet(path), [key], ["-attempt", "status", "content"]).drop("attempt")


def _send(sender: Callable[[str], tuple[int, str]], key: str, path: str, attempt: int):
    def send(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, folder = file_system(path if ":" in path.split("/")[0] else "file:" + path)
        system.create_dir(folder, recursive=True)
        fields = pa.schema([(key, pa.string()), ("status", pa.string()), ("content", pa.string()), ("attempt", pa.int32())])

        def put(name: str, rows: list) -> None:
            """A ledger file appears whole or not at all."""
            if rows:
                pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields), f"{folder}/_{name}", filesystem=system)
                system.move(f"{folder}/_{name}", f"{folder}/{name}")

        rows_of = ((b, k, body) for batch in batches for b, k, body in zip(*(batch.column(c).to_pylist() for c in ("batch", "key", "body"))))
        for number, rows in groupby(rows_of, lambda r: r[0]):
            name = f"{attempt:06d}-{number:012d}.parquet"
            if system.get_file_info(f"{folder}/{name}").type != fs.FileType.NotFound:
                continue  # sent by this task's earlier run
            done: list = []
            try:
                for _, k, body in rows:
                    try:
                        status, content = sender(body)
                        done.append((k, str(status), content, attempt))
                    except Exception as error:  # noqa: BLE001 - any failure is a result row
                        done.append((k, "Error", str(error), attempt))
            except BaseException:
                # the task ends; what it sent must be known to the next call
                put(f"{attempt:06d}-{number:012d}-{uuid.uuid4().hex}.parquet", done)
                raise
            put(name, done)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())], names=["batch"])

    return send
