"""Rows for the national data-entry form: field names, references by id, codes, required zeros.

Reference tables are the form's own lists: ref_faculties, ref_academic_years,
ref_calendar_years, ref_programmes, ref_courses. A value that finds no id stays NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.conditions import case_when, code_of, if_else, recode, yes_no_code
from ..functions.numbers import academic_year, key_text, minutes_to_hours
from ..functions.strings import clean_entity_name, extract, parse_number
from ..names import col, cols
from ..operators.columns import add_constants, rename_by_documentation, zero_missing_numbers
from ..operators.joins import left_join, left_join_checked, lookup_either_key, lookup_reference
from ..operators.reshape import first_of_lists, pivot_wide
from ..operators.windows import fill_down_up, fill_first, fill_from_previous, keep_first
from ..session import shared_folder
from .timetable import WRITTEN_EXAM

# Fields the form requires although nothing is reported in them.
FINANCE_ZEROS = ["unl_onderzoek4egeldstroom", "unl_aanvullendesubsidies"]
STAFF_ZEROS = [
    "unl_obp510fte1egeldstroomonderzoek", "unl_obp510fte1egeldstroomonderwijs", "unl_obp11fte1egeldstroomonderzoek",
    "unl_obp11fte1egeldstroomonderwijs", "unl_kosteninhuurderden1egeldstroom", "unl_inhuurderdenfte1egeldstroomonderwijs"]
PROGRAMME_ZEROS = ["unl_ecsexternestudentenverleend", "unl_ecseigenstudentenelders", "unl_vergoedingperecbetaalt",
                   "unl_vergoedingperecontvangt"]

# Codes of the form. Of a label listed twice the first code counts.
COURSE_YEAR_CODES = [("1", 1), ("2", 2), ("3", 3), ("4", 941790000), ("5", 941790001), ("Premaster", 4),
                     ("Honoursprogramma", 5), ("6", 941790002), ("7", 941790003)]
FORM_CODES = {
    "Hoorcollege": 941790007, "Werkcollege": 941790008, "Instructiecollege": 941790008,
    "Werk/instructiecollege": 941790008, "Practicum/Laboratorium": 941790009, "Practicum/Lab": 941790009,
    "Groepsopdracht (geroosterde begeleiding)": 941790004, "Groepsopdracht (met docent op afroep)": 941790011,
    "Groepsopdracht (niet geroosterde begeleiding)": 941790012, "Individuele begeleiding (geen scriptie)": 941790002,
    "Excursie": 941790010, "Stage": 941790005, "Scriptie/afstudeeropdracht BSc": 941790000,
    "Scriptie/afstudeeropdracht MSc": 941790001}
COURSE_LANGUAGE_CODES = {"Nederlands (NL)": 941790000, "Engels (EN)": 941790001, "Anderstalig": 941790002,
                         "Tweetalig (Z1)": 941790002}
STUDY_MODE_CODES = {"VOLTIJD": 1, "DEELTIJD": 2, "DUAAL": 3}
DEGREE_CODES = {"B": 1, "M": 2}
FACULTY_ALIASES = {"acta": "thk"}
PROGRAMME_YEARS = (2022, 2023, 2024)
YEAR_LABELS = {"new": ["2021-2022", "2022-2023", "2023-2024", "2024-2025", "2025-2026"],
               "old": ["2021-2022", "2022-2023", "2023-2024", "2024-2025"]}

YEAR = "unl_Jaar@odata.bind"
ACADEMIC_YEAR = "unl_Collegejaar@odata.bind"
REPORT_YEAR = "unl_Verslagjaar@odata.bind"
FACULTY = "unl_Faculteit@odata.bind"
STAFF_FACULTY = "unl_FaculteitNaam@odata.bind"
PROGRAMME = "unl_Opleiding@odata.bind"


def _bind_faculty(df: DataFrame, faculties: DataFrame, name: str, prefix: str, out: str) -> DataFrame:
    raw = col("unl_afkortingfaculteit")
    cleaned = df.withColumn("__faculty", clean_entity_name(col(name), prefix, FACULTY_ALIASES))
    bound = lookup_either_key(cleaned, faculties, "__faculty",
                              [clean_entity_name(raw, prefix, FACULTY_ALIASES), raw],
                              "unl_faculteitid", "unl_faculteits", out)
    return bound.drop("__faculty")


def _bind_academic_year(df: DataFrame, years: DataFrame, label: Column, out: str) -> DataFrame:
    return lookup_reference(df.withColumn("__label", label), years, ("__label", "unl_name"),
                            "unl_collegejaarid", "unl_collegejaars", out).drop("__label")


def _bind_calendar_year(df: DataFrame, years: DataFrame, name: str, out: str) -> DataFrame:
    return lookup_reference(df.withColumn("__year", key_text(col(name))), years, ("__year", "unl_name"),
                            "unl_kalenderjaarid", "unl_kalenderjaars", out).drop("__year")


def finance_payload(inputs: Mapping[str, DataFrame], fields: Sequence[str], naming, prefix: str) -> DataFrame:
    """`inputs`: finance (faculty, field, amount, year), ref_faculties, ref_calendar_years.
    `fields` are the report's amounts; `naming` gives faculty and year their unl_ names."""
    finance = inputs["finance"].select("Faculteit", "Jaar", "Veldnaam", "Waarde")
    wide = zero_missing_numbers(pivot_wide(finance, ["Faculteit", "Jaar"], "Veldnaam", "Waarde", fields, others="drop"))
    form = rename_by_documentation(wide, naming)
    form = _bind_faculty(form, inputs["ref_faculties"], "unl_faculteit", prefix, FACULTY).drop("unl_faculteit")
    form = _bind_calendar_year(form, inputs["ref_calendar_years"], "unl_jaar", YEAR)
    return add_constants(form, FINANCE_ZEROS).drop("unl_jaar")


def staff_payload(inputs: Mapping[str, DataFrame], fields: Sequence[str], naming, prefix: str) -> DataFrame:
    """`inputs`: staff (field, year, faculty, FTE, reporting year), ref_faculties,
    ref_academic_years, ref_calendar_years."""
    ids = ["Jaar", "Faculteit", "unl_verslagjaar"]
    wide = zero_missing_numbers(pivot_wide(inputs["staff"], ids, "Veldnaam", "FTE_gemiddelde", fields, others="drop"))
    form = rename_by_documentation(wide, naming)
    form = _bind_faculty(form, inputs["ref_faculties"], "unl_faculteitpersoneelid", prefix, STAFF_FACULTY)
    form = _bind_academic_year(form, inputs["ref_academic_years"], academic_year(col("unl_jaar")), YEAR)
    form = _bind_calendar_year(form, inputs["ref_calendar_years"], "unl_verslagjaar", REPORT_YEAR)
    return add_constants(form, STAFF_ZEROS).drop("unl_jaar", "unl_verslagjaar", "unl_faculteitpersoneelid")


def faculty_payload(inputs: Mapping[str, DataFrame], naming, prefix: str) -> DataFrame:
    """`inputs`: faculty_enrolment, ref_academic_years, ref_faculties. Rows without both
    references are left out."""
    counts = inputs["faculty_enrolment"]
    counts = counts.withColumns({f"total_{p}": col(f"{p}-EER") + col(f"{p}-NIET-EER") + col(f"{p}-NL") for p in ("B", "M")})
    form = rename_by_documentation(counts, naming)
    form = _bind_academic_year(form, inputs["ref_academic_years"], academic_year(col("unl_jaar")), ACADEMIC_YEAR).drop("unl_jaar")
    form = _bind_faculty(form, inputs["ref_faculties"], "unl_faculteit", prefix, FACULTY).drop("unl_faculteit")
    return form.filter(col(FACULTY).isNotNull() & col(ACADEMIC_YEAR).isNotNull())


def programme_students_payload(inputs: Mapping[str, DataFrame], naming) -> DataFrame:
    """`inputs`: programme_enrolment, ref_programmes, ref_academic_years. The programme is found
    by code and academic year, the first one if there are several; the others are left out."""
    years = inputs["ref_academic_years"].select("unl_collegejaarid", col("unl_name").alias("year_name"))
    programmes = left_join(inputs["ref_programmes"].select("unl_opleidingid", "unl_opleidingscodeisat", "_unl_collegejaar_value"),
                           years, ("_unl_collegejaar_value", "unl_collegejaarid"))
    students = inputs["programme_enrolment"].withColumns({
        "__label": academic_year(col("INS_Inschrijvingsjaar")), "__code": key_text(col("INS_Opleidingscode_actueel"))})
    bound = lookup_reference(students, programmes, [("__label", "year_name"), ("__code", "unl_opleidingscodeisat")],
                             "unl_opleidingid", "unl_opleidings", PROGRAMME)
    form = rename_by_documentation(bound.drop("__label", "__code", "INS_Inschrijvingsjaar", "INS_Opleidingscode_actueel"), naming)
    return form.filter(col(PROGRAMME).isNotNull())


def programme_payload(inputs: Mapping[str, DataFrame], naming, prefix: str, order: str = "source_order",
                      years: Sequence[int] = PROGRAMME_YEARS) -> DataFrame:
    """`inputs`: programmes, ref_academic_years, ref_faculties. Codes for mode, degree and
    language; a degree that is missing is taken from another row of the same programme."""
    names = ["INS_Faculteit", "INS_Opleidingsnaam_2002", "INS_Inschrijvingsjaar", "INS_Soort_onderwijs",
             "INS_Opleidingscode_Z08", "INS_Opleidingsvorm", "OPL_Code_actueel", "OPL_Instructietaal", "Graadtoevoeging"]
    chosen = inputs["programmes"].filter(col("INS_Faculteit").isNotNull() & col("INS_Opleidingsnaam_2002").isNotNull()
                                         & col("INS_Inschrijvingsjaar").isin(list(years)))
    # whole-row duplicates are merged, the place of the first one is kept
    chosen = chosen.groupBy(*cols(names)).agg(F.min(col(order)).alias("__place"))
    form = rename_by_documentation(chosen, naming)
    form = _bind_academic_year(form, inputs["ref_academic_years"], academic_year(col("unl_collegejaar")), ACADEMIC_YEAR)
    form = _bind_faculty(form.drop("unl_collegejaar"), inputs["ref_faculties"], "unl_faculteit", prefix, FACULTY)
    form = form.drop("unl_faculteit").withColumns({
        "unl_vorm": case_when(*[(col("unl_vorm") == k, F.lit(v)) for k, v in STUDY_MODE_CODES.items()], default=F.lit(1)),
        "unl_graad": recode(col("unl_graad"), DEGREE_CODES),
        "unl_opleidingscodeisat": col("unl_opleidingscodeisat").cast("string")})
    form = fill_first(form, ["unl_opleidingnaam", "unl_opleidingscodeisat"], ["__place"], ["unl_graad"])
    form = form.drop("OPL_Code_actueel", "__place").distinct()
    spoken = col("unl_taalvanopleiding")
    language = case_when((spoken.isin("Nederlands", "Nederlands/Engels"), F.lit(941790000)),
                         (spoken == "Engels", F.lit(941790001)), (spoken.isNotNull(), F.lit(941790002)))
    return add_constants(form.withColumn("unl_taalvanopleiding", language), PROGRAMME_ZEROS)


def target_groups(groups: DataFrame) -> DataFrame:
    """Course year codes by course and academic year, filled from the course's other years."""
    labelled = groups.filter(col("UAS_Vak_Jaar") >= 2021).select(
        "Code", "unl_vak_jaar_code", academic_year(col("UAS_Vak_Jaar")).alias("group_year"))
    # whole-row repeats change no fill, and without them the order below is complete
    filled = fill_down_up(labelled.distinct(), ["Code"], ["group_year", "unl_vak_jaar_code"], ["unl_vak_jaar_code"])
    return filled.distinct()


def _repair_from_previous_year(df: DataFrame, order: str) -> DataFrame:
    """Exam form and choice from the previous year; no exam form without credits, and the
    written exam where credits exist but no form is known."""
    keys = ["unl_vakcode", "unl_name"]
    df = fill_from_previous(df, keys, ["unl_jaar", order], ["unl_eindtoetsnaam", "unl_verplichtkeuze"])
    exam = F.when(col("unl_ecs").isNotNull(), F.coalesce(col("unl_eindtoetsnaam"), F.lit(WRITTEN_EXAM)))
    return df.withColumn("unl_eindtoetsnaam", exam)


def course_payload(inputs: Mapping[str, DataFrame], variant: str = "new", order: str = "source_order") -> DataFrame:
    """`inputs`: timetable (the workload job's result), ref_academic_years, ref_programmes,
    ref_courses, target_groups."""
    years, programmes = inputs["ref_academic_years"], inputs["ref_programmes"]
    slots = (1, 2) if variant == "new" else (1, 2, 3)
    form = inputs["timetable"]
    year_text = col("unl_vakjaar").cast("string")
    if variant == "old":
        number = parse_number(year_text)
        year_text = F.when(number.isNull(), year_text).otherwise(key_text(number))
    form = form.withColumn("unl_vakjaar", recode(year_text, COURSE_YEAR_CODES).cast("double"))
    form = lookup_reference(form, years, ("unl_jaar", "unl_name"), "unl_collegejaarid", "unl_collegejaars", YEAR)

    labelled = programmes.withColumn("__year_label", extract(col("unl_name"), r"\d{4}-\d{4}$"))
    labelled = labelled.filter(col("__year_label").isin(YEAR_LABELS[variant]))
    form = form.withColumn("__code", key_text(col("INS_Opleidingscode_actueel")))
    form = lookup_reference(form, labelled, [("__code", "unl_opleidingscodeisat"), ("unl_jaar", "__year_label")],
                            "unl_opleidingid", "unl_opleidings", PROGRAMME).drop("__code")

    form = form.withColumns({
        **{f"unl_werkvorm{i}naam": code_of(col(f"unl_werkvorm{i}naam"), FORM_CODES) for i in slots},
        "unl_verplichtkeuze": yes_no_code(col("unl_verplichtkeuze")),
        "unl_taalvanvak": recode(col("unl_taalvanvak"), COURSE_LANGUAGE_CODES)})
    form = form.drop("INS_Opleidingscode_actueel", "unl_hoorcollegetotaalcontacturen",
                     *[f"unl_werkvorm{i}totaalcontacturen" for i in slots])
    lists = [f.name for f in form.schema.fields if f.dataType.typeName() == "array"]
    # of the unnested rows of a course and year only the first one is sent, so the others are not made
    form = first_of_lists(form, lists)
    hours = [f"unl_{part}urenperweekpergroep" for part in ("hoorcollege", "werkcollege", "practicum")]
    hours += [f"unl_werkvorm{i}urenperweekpergroep" for i in slots]
    form = form.withColumns({h: minutes_to_hours(col(h)) for h in hours})

    form = fill_first(form, ["unl_vakcode"], [order], [PROGRAMME])
    needed = [PROGRAMME] + (["unl_startdatum", "unl_aantalgeslaagdeneindtoets"] if variant == "old" else [])
    for n in needed:
        form = form.filter(col(n).isNotNull())

    def at_least_one(groups: str, load: str) -> Column:
        return if_else((col(load) > 0) & (col(groups) == 0), F.lit(1).cast("long"), col(groups))

    form = form.withColumns({f"unl_{p}groepen": at_least_one(f"unl_{p}groepen", f"unl_{p}urenperweekpergroep")
                             for p in ("werkvorm2", "hoorcollege")})

    form = keep_first(form, ["unl_vakcode", "unl_jaar"], [order])
    # one row per course and year, read several times below
    shared_folder(form.sparkSession)
    form = form.checkpoint()
    form = left_join_checked(form, target_groups(inputs["target_groups"]),
                             [("unl_vakcode", "Code"), ("unl_jaar", "group_year")], "one-to-one")
    form = form.withColumn("unl_vakjaar", F.coalesce(col("unl_vakjaar"), col("unl_vak_jaar_code").cast("double")))
    if variant == "new":
        form = _with_course_ids(form, inputs["ref_courses"], years)
    return _repair_from_previous_year(form, order).drop("unl_vak_jaar_code", "unl_jaar", order)


def _with_course_ids(form: DataFrame, courses: DataFrame, years: DataFrame) -> DataFrame:
    """The id the form already has for a course and year, so that sending updates it."""
    ids = keep_first(courses.select("unl_vakcode", "unl_vakid", "_unl_jaar_value"),
                     ["unl_vakcode", "_unl_jaar_value"], ["unl_vakid"])
    names = years.select("unl_collegejaarid", col("unl_name").alias("id_year"))
    ids = left_join_checked(ids, names, ("_unl_jaar_value", "unl_collegejaarid"), "many-to-one")
    return left_join_checked(form, ids, [("unl_vakcode", "unl_vakcode"), ("unl_jaar", "id_year")], "many-to-one")
