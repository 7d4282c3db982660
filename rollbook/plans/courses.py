"""The course mart: offered courses with pass counts, calendar, language and exam form."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.conditions import case_when
from ..functions.numbers import add_days_where, round_half_even, to_number, weeks_between
from ..names import col, cols
from ..operators.joins import left_join, reconcile, semi
from ..operators.windows import keep_first

# First year reported, booking states, languages and exam form codes.
FIRST_YEAR = 2021
NO_PROGRAMME = 99999999
PASSED = "Afgesloten"
ENDED = "Zondersuccesbeëindigd"
LANGUAGES = {"Engels (EN)": "Engels", "Nederlands (NL)": "Nederlands", "Tweetalig (Z1)": "Nederlands/Engels"}
THESIS_CODES = {"Bachelor": 941790000, "Master": 941790001}
INTERNSHIP_CODE = 941790007
COURSE_COLUMNS = [
    "UAS_Vak_Code", "UAS_Vak_Jaar", "UAS_Vak_Naam_NL", "UAS_Vak_Studiepunten", "UAS_Groep_Verplichte_keuze",
    "UAS_Vak_Periode_start", "Startmoment_vak", "UAS_Vak_Duur", "total_students", "OPL_Instructietaal",
    "UAS_Opleiding_Onderwijstaal", "UAS_Groep_Groepstype", "UAS_Groep_College_jaar",
    "UAS_Vak_Opleidingsnaam_eigenaar", "UAS_Vak_Opleidingscode_eigenaar", "count_with_result", "count_afgesloten"]
COURSE_KEYS = ["UAS_Vak_Code", "UAS_Vak_Jaar", "UAS_Vak_Periode_start"]


def result_counts(results: DataFrame, order: str = "source_order") -> DataFrame:
    """Students and passes by year, module and code. A student's first booking of a module in a
    year counts, whatever its state; the states are looked at afterwards.

    With one booking per student left, counting rows counts distinct students.
    """
    first = keep_first(results, ["RES_Module_ID", "INS_Studentnummer", "Academisch_jaar"], [order])
    state = col("RES_Boekingsstatus_omschrijving")
    counted = first.filter((col("Academisch_jaar") >= FIRST_YEAR)
                           & (col("RES_Studieprogramma_ID") != NO_PROGRAMME)
                           & state.isin(PASSED, ENDED))
    return counted.groupBy("Academisch_jaar", "RES_Module_ID", "RES_Module_code").agg(
        F.count(F.lit(1)).alias("total_students"),
        F.count_if(state == PASSED).alias("count_afgesloten"),
        F.count_if(state == ENDED).alias("count_zondersucces"),
        F.count("RES_Beoordeling").alias("count_with_result"))


def exam_codes(courses: DataFrame, order: str) -> DataFrame:
    """Thesis and internship codes by course, year and period. Of several theses the first row
    counts, also when its phase has no code."""
    known = col("UAS_Opleiding_Fase_minimaal_generiek").isNotNull()
    thesis = col("UAS_Vak_scriptie") & known
    code = case_when(*[(col("UAS_Opleiding_Fase_minimaal_generiek") == phase, F.lit(value))
                       for phase, value in THESIS_CODES.items()])
    internship = col("UAS_Vak_stage") & known
    return (courses.filter(thesis | internship).groupBy(*cols(COURSE_KEYS))
            .agg(F.min_by(code, F.when(thesis, col(order))).alias("thesis_code"),
                 F.max(F.when(internship, F.lit(INTERNSHIP_CODE))).alias("internship_code")))


def course_mart(inputs: Mapping[str, DataFrame], order: str = "source_order") -> DataFrame:
    """`inputs`: courses, results, calendar, programme_map, exam_forms. `order` names the column
    that holds the place of a row in its source, which decides what "first" means.

    Every look-up is cut to its first row per key before its join, so no join multiplies rows.
    """
    calendar = inputs["calendar"].filter(col("ACA_Periode").isNotNull())
    starts = calendar.select("INS_Inschrijvingsjaar", "ACA_Periode", col("ACA_Einddatum_prev").alias("Startmoment_vak")).distinct()
    ends = calendar.select("INS_Inschrijvingsjaar", "ACA_Periode", "ACA_Einddatum_prev", "ACA_Einddatum")
    ends = keep_first(ends, ["INS_Inschrijvingsjaar", "ACA_Periode"], ["ACA_Einddatum_prev", "ACA_Einddatum"])
    counts = result_counts(inputs["results"], order).drop("count_zondersucces")
    counts = keep_first(counts, ["Academisch_jaar", "RES_Module_code"], ["RES_Module_ID"]).drop("RES_Module_ID")

    courses = inputs["courses"].filter((col("UAS_Vak_Jaar") >= FIRST_YEAR) & col("UAS_Vak_Naam_NL").isNotNull())
    dated = left_join(courses, starts, [("UAS_Vak_Jaar", "INS_Inschrijvingsjaar"),
                                        ("UAS_Vak_Periode_start", "ACA_Periode")])
    counted = left_join(dated, counts, [("UAS_Vak_Jaar", "Academisch_jaar"), ("UAS_Vak_Code", "RES_Module_code")])
    spoken = col("UAS_Opleiding_Onderwijstaal")
    language = case_when(*[(spoken == k, F.lit(v)) for k, v in LANGUAGES.items()], default=spoken)
    chosen = counted.withColumn("OPL_Instructietaal", F.coalesce(col("OPL_Instructietaal"), language))
    one = keep_first(chosen.select(*cols(COURSE_COLUMNS), order), COURSE_KEYS + ["Startmoment_vak"], [order])

    ended = one.withColumn("UAS_Vak_Periode_einde", col("UAS_Vak_Periode_start") + col("UAS_Vak_Duur") - 1)
    ended = left_join(ended, ends, [("UAS_Vak_Jaar", "INS_Inschrijvingsjaar"), ("UAS_Vak_Periode_einde", "ACA_Periode")])
    start = add_days_where(col("Startmoment_vak"), col("UAS_Vak_Periode_start") == 3, 14)
    ended = ended.withColumn("Startmoment_vak", start)
    ended = ended.withColumn("weeks_diff", round_half_even(weeks_between(col("ACA_Einddatum"), col("Startmoment_vak"))))

    programmes = keep_first(inputs["programme_map"].select("INS_Studieprogramma_CD", "INS_Opleidingscode_actueel"),
                            ["INS_Studieprogramma_CD"], ["INS_Opleidingscode_actueel"])
    coded = left_join(ended, programmes, ("UAS_Vak_Opleidingscode_eigenaar", "INS_Studieprogramma_CD"))
    coded = left_join(coded, exam_codes(inputs["courses"], order), COURSE_KEYS)
    forms = inputs["exam_forms"].select("UAS_Vak_Jaar", "Code", to_number(col("toetsvorm_code"), "int").alias("form_code"), order)
    forms = keep_first(forms.withColumnRenamed(order, "form_order"), ["UAS_Vak_Jaar", "Code"], ["form_order"])
    coded = left_join(coded, forms.drop("form_order"), [("UAS_Vak_Jaar", "UAS_Vak_Jaar"), ("UAS_Vak_Code", "Code")])
    exam = F.coalesce(col("thesis_code"), col("internship_code"), col("form_code")).cast("int")
    return (coded.withColumn("unl_eindtoetsnaam", exam)
            .drop("thesis_code", "internship_code", "form_code"))


def validate_courses(mart: DataFrame, expected: DataFrame, year: int = FIRST_YEAR) -> DataFrame:
    """The mart of one year against hand-made figures: equality flags and differences."""
    known = semi(mart.filter(col("UAS_Vak_Jaar") == year), expected, ("UAS_Vak_Code", "Vakcode"))
    asked = expected.withColumn("Startdatum_date", F.date_add(F.to_date("Startdatum"), 1))
    asked = asked.withColumn("verplicht_verwacht", col("Verplicht/Keuze") == "Verplicht")
    compared = reconcile(known, asked, ("UAS_Vak_Code", "Vakcode"), [
        ("total_students", "Aantal Deelnemers"), ("weeks_diff", "Aantal Collegeweken"),
        ("count_afgesloten", "Aantal Geslaagden Eindtoets")])
    return compared.withColumns({
        "ECs_overeen": col("UAS_Vak_Studiepunten") == col("EC's"),
        "Startdatum_overeen": col("Startdatum_date") == col("Startmoment_vak"),
        "verschil_startdatum": F.datediff(col("Startmoment_vak"), col("Startdatum_date")),
        "verplicht_overeen": col("UAS_Groep_Verplichte_keuze") == col("verplicht_verwacht")})
