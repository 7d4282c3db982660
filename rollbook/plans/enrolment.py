"""Enrolment counts by faculty and by programme."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.strings import paste, to_ascii
from ..names import col
from ..operators.columns import rename_by_documentation, sum_of
from ..operators.reshape import pivot_count

# Phases (B bachelor, M master, Q postmaster, S premaster), origins, and the
# start month and mode of study that are counted.
PHASES = ("B", "M", "Q", "S")
ORIGINS = ("EER", "NIET-EER", "NL")
START_MONTH = 9
STUDY_MODE = "Voltijd"


def clean_enrolments(enrolments: DataFrame, naming: DataFrame | dict | None = None) -> DataFrame:
    """Renamed through the documentation, whole-row duplicates and rows without a student
    number removed, names in ASCII."""
    if naming is not None:
        enrolments = rename_by_documentation(enrolments, naming)
    present = enrolments.filter(col("INS_Studentnummer").isNotNull()).distinct()
    return present.withColumns({n: to_ascii(col(n)) for n in ("INS_Faculteit", "INS_Opleidingsnaam_2002")})


def faculty_enrolment(enrolments: DataFrame, institution: str, phases: Sequence[str] = PHASES,
                      origins: Sequence[str] = ORIGINS) -> DataFrame:
    """Students by year and faculty, one column per phase and origin, with totals."""
    counted = enrolments.filter(
        (col("INS_Instelling") == institution)
        & (col("INS_Maand_inschrijving_van") == START_MONTH)
        & (col("INS_Opleidingsvorm") == STUDY_MODE)
        & col("INS_Indicatie_actief_op_peildatum")
        & col("INS_Opleidingsfase_actueel").isin(list(phases)))
    label = paste(col("INS_Opleidingsfase_actueel"), col("DEM_Nationaliteit_EER_naam"), sep="-")
    labels = [f"{p}-{o}" for p in phases for o in origins]
    wide = pivot_count(counted, ["INS_Inschrijvingsjaar", "INS_Faculteit"], label, labels, total="total")
    return wide.withColumns({p: sum_of([f"{p}-{o}" for o in origins]) for p in ("S", "Q") if p in phases})


def programme_enrolment(enrolments: DataFrame, institution: str, origins: Sequence[str] = ORIGINS,
                        keys: Sequence[str] = ("INS_Inschrijvingsjaar", "INS_Opleidingsnaam_2002",
                                               "INS_Opleidingscode_actueel")) -> DataFrame:
    """Students by year and programme, one column per origin; the total adds those columns."""
    counted = enrolments.filter(col("INS_Instelling") == institution)
    wide = pivot_count(counted, list(keys), col("DEM_Nationaliteit_EER_naam"), list(origins))
    return wide.withColumn("total", sum_of(list(origins)))
