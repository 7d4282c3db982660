"""Delimited text: exports with lines above the data, European numbers, zipped deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.strings import format_european_number, parse_european_number, trim_all
from ..names import col, cols
from .encoding import repair_encoding, windows_signs
from .splits import SPLIT_BYTES, read_lines
from .zips import read_zip_lines

SOURCE_ORDER = ["source_file", "source_offset"]


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str = ",",
                na: Sequence[str] = ("",), keep: Sequence[str] = ()) -> DataFrame:
    """Split lines to columns. Values that are one of the `na` words become NULL, and so do
    values that are not of the column's type."""
    fields = ", ".join(f"c{i} STRING" for i in range(len(schema)))
    parsed = lines.withColumn("__fields", F.from_csv("value", fields, {"sep": sep, "mode": "PERMISSIVE"}))
    out = []
    for i, f in enumerate(schema):
        c = col("__fields").getField(f"c{i}")
        c = F.when(~c.isin(list(na)), c) if na else c
        out.append((c if isinstance(f.dataType, T.StringType) else _typed(c, f.dataType)).alias(f.name))
    return parsed.select(*out, *cols(keep))


def _typed(c: Column, kind: T.DataType) -> Column:
    """Lenient cast; numbers may carry grouping commas."""
    if isinstance(kind, T.NumericType):
        c = F.replace(F.trim(c), F.lit(","), F.lit(""))
    return c.try_cast(kind)


def read_csv_after(spark: SparkSession, paths: str | Sequence[str], skip: int, schema: T.StructType,
                   sep: str = ",", na: Sequence[str] = ("", "NA"), repair: bool = False,
                   split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Many delimited exports with `skip` lines above the data, as one table with the place of each row in its source: its
    file and byte offset. Files are read in splits, each byte once. A value may not hold a line break. `repair` as in `read_lines`."""
    lines = read_lines(spark, paths, skip, repair=repair, split_bytes=split_bytes).filter(F.trim("value") != "")
    return parse_lines(lines, schema, sep, na, keep=SOURCE_ORDER)


def year_columns(df: DataFrame, year: str, data: str, years: Sequence[int]) -> DataFrame:
    """One column per file year in place of `data`: each row fills its own year's column only."""
    return df.withColumns({str(y): F.when(col(year) == y, col(data)) for y in years}).drop(data)


def read_european_csv(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8", repair: bool = False) -> DataFrame:
    """";" as separator, "," as decimal mark, "." as grouping mark, blanks trimmed. With `repair` the file may mix encodings:
    values that are UTF-8 are read as such, also if they were taken for Latin-1 once before, all others as Windows' Latin-1; columns then go by their place, not by the header."""
    encoding = "ISO-8859-1" if repair else encoding
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = (spark.read.schema(text).option("sep", ";").option("header", "true").option("encoding", encoding)
           .option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true")
           .option("enforceSchema", str(repair).lower()).csv(path))
    out = []
    for f in schema:
        c = trim_all(windows_signs(repair_encoding(repair_encoding(col(f.name)))) if repair else col(f.name))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = parse_european_number(c).cast(f.dataType)
        elif not isinstance(f.dataType, T.StringType):
            c = c.try_cast(f.dataType)
        out.append(c.alias(f.name))
    return raw.select(*out)


def write_european_csv(df: DataFrame, path: str, na: str = "") -> None:
    numbers = (T.DoubleType, T.FloatType, T.DecimalType)
    text = [format_european_number(col(f.name)).alias(f.name) if isinstance(f.dataType, numbers) else col(f.name)
            for f in df.schema.fields]
    (df.select(*text).write.option("sep", ";").option("header", "true").option("nullValue", na)
     .option("emptyValue", "").csv(path))


def read_zip_csv(spark: SparkSession, folder: str, schema: T.StructType, sep: str = ",",
                 na: Sequence[str] = ("", "NA", "#"), pattern: str = r"\.zip$") -> DataFrame:
    """Zipped delimited files, each member with a header line, several words for missing values, and a type
    per column."""
    lines = read_zip_lines(spark, folder, pattern).filter(F.col("source_line") > 0)
    return parse_lines(lines, schema, sep, na)
