"""What the operators share: table reading, batches of bounded size for Python tasks, shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path, shared_folder

BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, as `id` and `text`; a missing text is empty. Other columns can not clash."""
    return df.select(df[id_col].alias("id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))


def small_batches(batches: Iterable[pa.RecordBatch], size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `size` bytes, at least a row each, so that a task's memory is bounded."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def per_text(df: DataFrame, make: Callable[[], Callable[[list, list], Sequence[Sequence]]], fields: pa.Schema, ddl: str,
             size: int = BATCH_BYTES) -> DataFrame:
    """Runs a function over batches of (id, text) of about `size` bytes. `make` is called once in a task and gives a function from the
    lists of ids and texts to the columns of the result, which need not have a row for each text. Its attribute `done`,
    if it has one, is called at the end, to let go of what an idle Python process should not hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        try:
            for batch in small_batches(batches, size):
                columns = work(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                                       for c, f in zip(columns, fields)], schema=fields)
                del columns
                pa.default_memory_pool().release_unused()  # Arrow would keep the pages of its largest batch
        finally:
            getattr(work, "done", lambda: None)()

    return df.mapInArrow(run, ddl)


FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def files_go(spark: SparkSession) -> Iterator[None]:
    """What is planned and run inside has its shuffle files removed as it ends. Otherwise they stay until the driver happens to
    collect its garbage, which depends on its heap and not on the disk, and those of many steps add up."""
    was = spark.conf.get(FILES_GO, None)
    spark.conf.set(FILES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(FILES_GO) if was is None else spark.conf.set(FILES_GO, was)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the folder that spark.checkpoint.dir names."""
    spark = df.sparkSession
    shared_folder(spark)
    with files_go(spark):
        made = df.select("*").checkpoint()  # planned anew, as a plan keeps the setting it was made under
    made._scratch = [made._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()]
    return made


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes an intermediate table to the shared folder and reads it again: a lost executor costs no earlier work."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with files_go(spark):
        df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._scratch = [path]
    return made


def reading(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """The same frame, known to read these tables: `let_go` of it removes them."""
    df._scratch = [path for t in tables for path in t.__dict__.get("_scratch", [])]
    return df


def let_go(*tables: DataFrame | None) -> None:
    """Removes the files of tables that `checkpointed` or `written` made, once nothing that is still to run reads them. Others are left alone."""
    for df in filter(lambda df: df is not None, tables):
        context = df.sparkSession.sparkContext
        for path in df.__dict__.pop("_scratch", []):
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


MAP_BITS = 23


def only_maybe(df: DataFrame, column: str, wanted: DataFrame, wanted_column: str) -> DataFrame:
    """Drops most rows whose key (a long) is not wanted, before they are shuffled to a join that drops the others.

    The wanted keys set bits of a map of 2 ** `MAP_BITS` bits, 1 MiB however many they are, which is all that is broadcast.
    The fuller the map, the more rows pass; none that is wanted is dropped."""
    bit = F.pmod(F.xxhash64(wanted[wanted_column]), F.lit(1 << MAP_BITS))
    bits = wanted.select(F.bitmap_bucket_number(bit).alias("__bucket"), F.bitmap_bit_position(bit).alias("__bit"))
    maps = F.broadcast(bits.groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__map")))
    bit = F.pmod(F.xxhash64(df[column]), F.lit(1 << MAP_BITS))
    place = F.bitmap_bit_position(bit)
    rows = df.withColumns({"__bucket": F.bitmap_bucket_number(bit), "__place": place}).join(maps, "__bucket")
    byte = F.conv(F.hex(F.substring("__map", (F.floor(F.col("__place") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, F.pmod(F.col("__place"), F.lit(8)).cast("int")) == 1
    return rows.filter(is_set).select(*df.columns)
