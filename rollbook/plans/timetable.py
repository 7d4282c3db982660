"""Timetable activities to the teaching load per course and year, joined with the course mart."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import list_mean
from ..functions.conditions import fill_empty_text
from ..functions.numbers import round_half_even, weeks_between
from ..names import col, cols
from ..operators.columns import clear_if_all_empty, pick_by_name, rename_by_documentation
from ..operators.joins import left_join, left_join_coalesce
from ..operators.reshape import nested_field, pivot_wide_lists, pivot_wide_values
from ..operators.tables import frequency_table, workload
from ..operators.windows import fill_down_up, keep_first
from ..session import shared_folder
from ..sources.nested import keep_activity_files

LECTURE = "Hoorcollege"
CLASS = "Werk/instructiecollege"
LAB = "Practicum/Lab"
TRIP = "Excursie"
GUIDED = "Groepsopdracht (geroosterde begeleiding)"
UNGUIDED = "Groepsopdracht (niet geroosterde begeleiding)"
RANKED = [GUIDED, TRIP, UNGUIDED]
EXAM_TYPES = ["Tentamen schriftelijk", "Tentamen digitaal"]
WRITTEN_EXAM = 941790006
MEASURES = {"n_groups": "group", "n_weeks": "total_weeks", "minutes_per_group_week": "duration_per_group_per_week",
            "contact_hours": "contact_hours"}


@dataclass(frozen=True)
class Variant:
    """How an edition of the timetable report names types and combines values."""

    name: str
    types: Mapping[str, list[str]]
    slots: int
    list_cells: bool
    prefer_programme: str


# Activity types by the form they count as, in the new and the old edition.
NEW = Variant("new", {
    LECTURE: ["Hoorcollege", "Lecture"],
    CLASS: ["Werkcollege", "Instructiecollege", "Werkgroep"],
    LAB: ["Practicum", "Computerpracticum", "training"],
    TRIP: ["Excursie", "Veldwerk", "Symposium"],
    GUIDED: ["Studiegroep"],
}, slots=2, list_cells=True, prefer_programme="right")
OLD = Variant("old", {
    LECTURE: ["Hoorcollege", "Lecture"],
    CLASS: ["Werkcollege", "Instructiecollege"],
    LAB: ["Practicum", "Computerpracticum", "training"],
    GUIDED: ["Werkgroep"],
    TRIP: ["Excursie", "Veldwerk", "Symposium"],
    UNGUIDED: ["Studiegroep"],
}, slots=3, list_cells=True, prefer_programme="left")
VARIANTS = {"new": NEW, "old": OLD}

# Field names of the receiving form for the columns the later steps use.
FIELD_NAMES = {
    "ter_module_code": "unl_vakcode", "UAS_Vak_Naam_NL": "unl_name", "UAS_Vak_Studiepunten": "unl_ecs",
    "UAS_Groep_Verplichte_keuze": "unl_verplichtkeuze", "UAS_Groep_Groepstype": "unl_vakjaar",
    "UAS_Opleiding_Onderwijstaal": "unl_taalvanvak", "Startmoment_vak": "unl_startdatum",
    "count_afgesloten": "unl_aantalgeslaagdeneindtoets",
    "n_groups_Hoorcollege": "unl_hoorcollegegroepen", "n_weeks_Hoorcollege": "unl_hoorcollegeaantalweken",
    "minutes_per_group_week_Hoorcollege": "unl_hoorcollegeurenperweekpergroep",
    "contact_hours_Hoorcollege": "unl_hoorcollegetotaalcontacturen",
    "n_groups_Werk/instructiecollege": "unl_werkcollegegroepen",
    "n_weeks_Werk/instructiecollege": "unl_werkcollegeaantalweken",
    "minutes_per_group_week_Werk/instructiecollege": "unl_werkcollegeurenperweekpergroep",
    "n_groups_Practicum/Lab": "unl_practicumgroepen", "n_weeks_Practicum/Lab": "unl_practicumaantalweken",
    "minutes_per_group_week_Practicum/Lab": "unl_practicumurenperweekpergroep",
    **{f"name_form{i}": f"unl_werkvorm{i}naam" for i in (1, 2, 3)},
    **{f"group_{i}": f"unl_werkvorm{i}groepen" for i in (1, 2, 3)},
    **{f"total_weeks_{i}": f"unl_werkvorm{i}aantalweken" for i in (1, 2, 3)},
    **{f"duration_per_group_per_week_{i}": f"unl_werkvorm{i}urenperweekpergroep" for i in (1, 2, 3)},
    **{f"contact_hours_{i}": f"unl_werkvorm{i}totaalcontacturen" for i in (1, 2, 3)},
}


def unpack_activities(activities: DataFrame) -> DataFrame:
    """Week and minute lists of each activity; activities without a mean duration are dropped."""
    lists = activities.withColumns({"weeks": nested_field(activities, "ter_events", "week"),
                                    "minutes": nested_field(activities, "ter_events", "activityDurationMins")})
    return lists.withColumn("mean_minutes", list_mean(col("minutes"))).filter(col("mean_minutes").isNotNull())


def summarise(activities: DataFrame, variant: Variant) -> DataFrame:
    """Load by module, raw type and academic year."""
    return workload(unpack_activities(activities), ["ter_module_code", "ter_type", "unl_jaar"],
                    "ter_student_groups", "weeks", "minutes", variant.name)


def type_overview(summary: DataFrame) -> DataFrame:
    return frequency_table(summary, "ter_type")


def _rank_value(variant: Variant, form: str) -> Column:
    value = col(f"minutes_per_group_week_{form}")
    return F.array_max(value) if variant.list_cells else value


def rank_forms(wide: DataFrame, variant: Variant, slots: int = 3) -> DataFrame:
    """name_form1..: the guided, trip and unguided forms by weekly minutes, longest first.

    They are a fixed handful of columns of one row, so an array is sorted in the row. No
    unpivot, window, pivot and join back are needed.
    """
    forms = [f for f in RANKED if f in variant.types]
    entries = F.array(*[F.when(_rank_value(variant, f).isNotNull(),
                               F.struct((-_rank_value(variant, f)).alias("minutes"), F.lit(i).alias("place"),
                                        F.lit(f).alias("name"))) for i, f in enumerate(forms)])
    ranked = F.array_sort(F.array_compact(entries))
    return wide.withColumns({f"name_form{i}": F.get(ranked, F.lit(i - 1)).getField("name")
                             for i in range(1, slots + 1)})


def wide_forms(summary: DataFrame, variant: Variant) -> DataFrame:
    """One row per module and year: each form's measures, as lists over its raw types."""
    ids = ["ter_module_code", "unl_jaar"]
    summary = summary.filter(col("ter_type").isin([raw for raws in variant.types.values() for raw in raws]))
    if variant.list_cells:
        wide = pivot_wide_lists(summary, ids, "ter_type", variant.types, list(MEASURES))
    else:
        form = {raw: f for f, raws in variant.types.items() for raw in raws}
        named = summary.replace(form, subset=["ter_type"])
        wide = pivot_wide_values(named, ids, "ter_type", list(MEASURES), list(variant.types))
    return wide


def fill_course_mart(mart: DataFrame, programme_map: DataFrame, variant: Variant, order: str) -> DataFrame:
    """Programme codes, periods and dates filled from the programme map and from other rows."""
    codes = keep_first(programme_map.select("INS_Studieprogramma_CD", "INS_Inschrijvingsjaar", "INS_Opleidingscode_actueel"),
                       ["INS_Studieprogramma_CD", "INS_Inschrijvingsjaar"], ["INS_Opleidingscode_actueel"])
    mart = left_join_coalesce(mart, codes, [("UAS_Vak_Opleidingscode_eigenaar", "INS_Studieprogramma_CD"),
                                            ("UAS_Vak_Jaar", "INS_Inschrijvingsjaar")],
                              ["INS_Opleidingscode_actueel"], prefer=variant.prefer_programme)
    by_year = ["UAS_Vak_Jaar", order] if variant.name == "new" else [order]
    mart = fill_down_up(mart, ["UAS_Vak_Code"], by_year, ["UAS_Vak_Periode_start", "UAS_Vak_Periode_einde"])
    # the second search for hot groups and the second fill start from what the first fill made
    shared_folder(mart.sparkSession)
    mart = mart.checkpoint()
    mart = fill_down_up(mart, ["UAS_Vak_Jaar", "UAS_Vak_Periode_start"], by_year,
                        ["Startmoment_vak", "ACA_Einddatum", "ACA_Einddatum_prev"])
    return mart.withColumn("weeks_diff", round_half_even(weeks_between(col("ACA_Einddatum"), col("Startmoment_vak"))))


def pick_forms(wide: DataFrame, variant: Variant) -> DataFrame:
    """group_1, total_weeks_1 and so on: the measures of the form that got each slot."""
    picked = {}
    for i in range(1, variant.slots + 1):
        for measure, short in MEASURES.items():
            sources = {f: f"{measure}_{f}" for f in variant.types}
            picked[f"{short}_{i}"] = pick_by_name(f"name_form{i}", sources, wide.columns)
    return wide.withColumns(picked)


def timetable_workload(inputs: Mapping[str, DataFrame], variant: str = "new", order: str = "source_order",
                       naming: DataFrame | Mapping[str, str] = FIELD_NAMES) -> DataFrame:
    """`inputs`: activities, course_mart, programme_map. Rows by course and academic year.
    Activities name their yearly file, or hold unl_jaar themselves."""
    edition = VARIANTS[variant]
    activities = inputs["activities"]
    if "ter_source_file" in activities.columns:
        activities = keep_activity_files(activities)
    wide = rank_forms(wide_forms(summarise(activities, edition), edition), edition)

    mart = fill_course_mart(inputs["course_mart"], inputs["programme_map"], edition, order)
    exams = keep_first(unpack_activities(activities).filter(col("ter_type").isin(EXAM_TYPES))
                       .select("ter_module_code", "unl_jaar", order), ["ter_module_code"], [order])
    exams = exams.select("ter_module_code", "unl_jaar", F.lit(WRITTEN_EXAM).alias("unl_eindtoetsnaam"))

    joined = wide.withColumn("jaar", F.substring("unl_jaar", 1, 4).cast("int"))
    joined = left_join(joined, mart, [("ter_module_code", "UAS_Vak_Code"), ("jaar", "UAS_Vak_Jaar")])
    joined = joined.drop("ACA_Einddatum_prev", "UAS_Vak_Periode_einde", "jaar")
    joined = left_join_coalesce(joined, exams, ["ter_module_code", "unl_jaar"], ["unl_eindtoetsnaam"], prefer="left")

    out = pick_forms(joined, edition)
    out = out.withColumn("UAS_Groep_Groepstype", fill_empty_text(col("UAS_Groep_Groepstype"), col("UAS_Groep_College_jaar")))
    out = rename_by_documentation(out, naming)
    for i in range(1, edition.slots + 1):
        lists = [f"unl_werkvorm{i}{part}" for part in ("groepen", "aantalweken", "urenperweekpergroep", "totaalcontacturen")]
        if edition.list_cells:
            out = clear_if_all_empty(out, f"unl_werkvorm{i}naam", lists)
    return out
