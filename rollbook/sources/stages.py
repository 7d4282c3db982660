"""Stage folders: each stage reads the folder the one before it wrote."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..names import cols

# Folder names of the stages.
STAGE_FOLDERS = {
    "read": "1. Ingelezen data", "prepare": "2. Geprepareerde data",
    "validate": "3. Analyseset", "send": "5. Rapportages",
}
READS_FROM = {"read": "read", "prepare": "read", "validate": "prepare", "send": "prepare"}


@dataclass(frozen=True)
class Stages:
    """Where datasets live. An explicit folder wins over the stage's own."""

    base: str
    folders: dict[str, str] = field(default_factory=lambda: dict(STAGE_FOLDERS))

    def path(self, name: str, stage: str, folder: str | None = None) -> str:
        return "/".join([self.base.rstrip("/"), (folder or self.folders[stage]).strip("/"), name])

    def read(self, spark: SparkSession, name: str, stage: str, folder: str | None = None) -> DataFrame:
        """A dataset as the given stage sees it: from the folder that stage reads, the version published there."""
        from ..sinks.tables import current
        return spark.read.parquet(current(spark, self.path(name, READS_FROM[stage], folder)))

    def write(self, df: DataFrame, name: str, stage: str, formats: Sequence[str] = ("parquet",),
              folder: str | None = None) -> None:
        from ..sinks.tables import write_table
        for kind in formats:
            suffix = "" if kind == "parquet" else f".{kind}"
            write_table(df, self.path(name, stage, folder) + suffix, kind)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 require_rows: bool = True) -> DataFrame:
    """Parquet with only the columns asked for; an empty table raises."""
    from ..sinks.tables import current
    df = spark.read.parquet(current(spark, path))
    df = df.select(*cols(columns)) if columns else df
    if require_rows and df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df
