"""Staff in full-time equivalents by faculty, year and function or salary band."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.conditions import band, case_when
from ..functions.numbers import clamp_negative, scale_where
from ..functions.strings import paste, replace_all, replace_first, trim_all
from ..names import col, cols
from ..operators.columns import mean_of, zero_missing
from ..operators.joins import translate
from ..operators.tables import sort_rows

# Names in the export, salary scales by band, and the half-year of data.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
MEASURE = "Doorbelaste FTE"
RENAMED_FUNCTIONS = {"Tandartsdocent": "Docent", "Specialist in opleiding": "Promovendus"}
BANDS = {
    "Schaal 5 t/m 10": ["005", "006", "007", "008", "009", "010"],
    "Schaal 11 en hoger": ["011", "012", "013", "014", "015", "016", "017", "018", "019", "020"],
}
OTHER_BAND = "Andere schalen"
DESCRIPTIVE = ["Salaris Schaal", "WP of OBP", "Omschrijving", "Geldstroom", "Kernactiviteit", "Jaar"]
STUDENT_ASSISTANT = "Student-assistent"
HALF_YEAR = 2021


def _yearly_means(inputs: Mapping[str, DataFrame]) -> DataFrame:
    rows = inputs["staff_export"].filter(col("MEASURES") == MEASURE)
    rows = zero_missing(rows, MONTHS)
    return rows.select(
        *cols(DESCRIPTIVE), F.substring(col("Profit Center aanstelling"), 1, 3).alias("Profit_center_afkorting"),
        mean_of(MONTHS).alias("FTE_gemiddelde"),
        mean_of(MONTHS[:6]).alias("FTE_gemiddelde_tot_juni"),
        mean_of(MONTHS[6:]).alias("FTE_gemiddelde_vanaf_juli"))


def _describe(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Faculty, salary band and function name."""
    rows = translate(rows, mapping, "Profit_center_afkorting", "Faculteit", keep_original=False)
    description = col("Omschrijving")
    for old, new in RENAMED_FUNCTIONS.items():
        description = F.when(description.contains(old), replace_first(description, old, new)).otherwise(description)
    # what follows the last slash
    scale = F.nullif(F.substring_index(col("Salaris Schaal"), "/", -1), F.lit(""))
    return (rows.withColumns({"schaal_categorie": band(scale, BANDS, OTHER_BAND),
                              "function": trim_all(replace_all(description, r"\d+"))})
            .withColumnRenamed("WP of OBP", "staff_kind").drop("Salaris Schaal", "Omschrijving"))


def prepare_staff(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """`inputs`: staff_export, profit_centre_mapping. Each row's yearly means, salary band and function name."""
    return _describe(_yearly_means(inputs), inputs["profit_centre_mapping"])


def staff_fte(inputs: Mapping[str, DataFrame]) -> DataFrame:
    """FTE by function, by function and core activity (first money stream), and by salary band.

    The rows are summed first by the texts as they stand in the export. Look-up, text cleaning and
    spreading to the up to two reports a row counts in run on those few combinations only.
    """
    combinations = _yearly_means(inputs).groupBy(*cols(DESCRIPTIVE), "Profit_center_afkorting").agg(
        F.sum("FTE_gemiddelde").alias("FTE_gemiddelde"))
    staff = _describe(combinations, inputs["profit_centre_mapping"])
    academic = (col("staff_kind") == "WP") | (col("function") == STUDENT_ASSISTANT)
    funded = academic & (col("Kernactiviteit") != "OV") & (col("Geldstroom") == "Geldstroom 1")
    support = (col("staff_kind") == "OBP") & (col("function") != STUDENT_ASSISTANT)

    def row(report: int, name, activity):
        return F.struct(F.lit(report).alias("report"), name.alias("name"), activity.cast("string").alias("activity"))

    reports = F.array_compact(F.array(
        F.when(academic, row(1, col("function"), F.lit(None))),
        F.when(funded, row(2, col("function"), col("Kernactiviteit"))),
        F.when(support, row(3, col("schaal_categorie"), col("staff_kind")))))
    spread = staff.select("Jaar", "Faculteit", "FTE_gemiddelde", F.inline(reports))
    summed = spread.groupBy("report", "name", "activity", "Jaar", "Faculteit").agg(
        F.sum("FTE_gemiddelde").alias("FTE_gemiddelde"))
    field = case_when((col("report") == 1, col("name")),
                      (col("report") == 2, paste(col("name"), col("activity"), sep=" - ")),
                      default=paste(col("activity"), col("name"), sep=" - "))
    fte = clamp_negative(scale_where(col("FTE_gemiddelde"), col("Jaar") == HALF_YEAR, 2.0))
    out = summed.select(field.alias("Veldnaam"), "Jaar", "Faculteit", fte.alias("FTE_gemiddelde"),
                        col("Jaar").alias("unl_verslagjaar"), (col("report") == 3).alias("support"))
    return sort_rows(out, ["Jaar", "Faculteit", "support", "Veldnaam"]).drop("support")
