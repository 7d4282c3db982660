"""Programme totals against hand-made figures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..names import col
from ..operators.columns import total_of
from ..operators.contains import keep_contained, replace_by_contained
from ..operators.joins import left_join
from ..operators.windows import attach, keep_first
from ..session import shared_folder
from .enrolment import programme_enrolment

# Column names of the hand-made table, by origin.
EXPECTED = {"NL": "NL Totaal Inschrijvingen", "EER": "EER (Excl. NL) Totaal Inschrijvingen",
            "NIET-EER": "Niet-EER Totaal Inschrijvingen"}
YEAR_KEYS = ("INS_Inschrijvingsjaar_EOI", "INS_Opleidingsnaam_2002")


def validate_programmes(inputs: Mapping[str, DataFrame], institution: str, year: int = 2021) -> DataFrame:
    """`inputs`: enrolments, expected_programmes. Counts of one year for the programmes whose
    name occurs in an expected name, with the expected figures and the differences, by name."""
    counts = programme_enrolment(inputs["enrolments"], institution, keys=YEAR_KEYS)
    counts = counts.filter(col("INS_Inschrijvingsjaar_EOI") == year)
    counts = counts.withColumn("INS_Opleidingsnaam_2002", F.upper("INS_Opleidingsnaam_2002"))
    # one row per programme, read several times below: count the enrolments once
    shared_folder(counts.sparkSession)
    counts = counts.checkpoint()

    asked = inputs["expected_programmes"]
    asked = keep_first(asked, ["Naam"], list(EXPECTED.values())).withColumn("naam_hoofdletters", F.upper("Naam"))
    counts = keep_contained(counts, "INS_Opleidingsnaam_2002", asked, "naam_hoofdletters").checkpoint()
    asked = replace_by_contained(asked, "naam_hoofdletters", counts, "INS_Opleidingsnaam_2002", "Naam_nieuw")
    asked = asked.select("Naam_nieuw", *[col(n) for n in EXPECTED.values()])

    joined = left_join(counts, asked, ("INS_Opleidingsnaam_2002", "Naam_nieuw"))
    joined = attach(joined, ["INS_Opleidingsnaam_2002"],
                    F.sum(total_of(list(EXPECTED.values()))).alias("Totaal_verwacht"))
    differences = {f"verschil_{o.lower().replace('-', '')}": col(n) - col(o) for o, n in EXPECTED.items()}
    return joined.withColumns({**differences, "verschil_totaal": col("Totaal_verwacht") - col("total")})
