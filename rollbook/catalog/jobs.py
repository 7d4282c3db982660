"""The reporting jobs on inputs derived from the given tables.

The derivations are plain projections, joins and aggregations of the test tables into the
input schemas of the jobs; the SQL makes the same inputs and computes the report its own way.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..names import col, cols
from ..plans import courses, enrolment, finance, payloads, staff, timetable, validation
from ..session import scratch_path
from ..sources import stages
from .aggregates import workload_sql
from .registry import query, table
from .sources import ACTIVITIES_SQL, activities_from_orders

INSTITUTION = "INST"
ORIGINS = ["EER", "NIET-EER", "NL"]


# --- enrolments -----------------------------------------------------------------------------

def enrolments(spark, sf_dir):
    """One enrolment per order; the customer gives programme, origin and mode, the nation the faculty."""
    rows = (table(spark, sf_dir, "orders")
            .join(table(spark, sf_dir, "customer"), col("o_custkey") == col("c_custkey"))
            .join(table(spark, sf_dir, "nation"), col("c_nationkey") == col("n_nationkey")))
    fourth = col("o_custkey") % 4
    status = col("o_orderstatus")
    year = F.year("o_orderdate")
    return rows.select(
        col("o_orderkey").cast("double").alias("INS_Studentnummer"),
        F.when(col("c_acctbal") < 0, F.lit("OTHER")).otherwise(F.lit(INSTITUTION)).alias("INS_Instelling"),
        F.concat(F.lit("Fac é "), "n_name").alias("INS_Faculteit"),
        F.concat(F.lit("Opl. "), F.lower("c_mktsegment")).alias("INS_Opleidingsnaam_2002"),
        col("c_nationkey").cast("bigint").alias("INS_Opleidingscode_actueel"),
        year.alias("INS_Inschrijvingsjaar"), year.alias("INS_Inschrijvingsjaar_EOI"),
        F.when(F.month("o_orderdate") == 2, F.lit(10)).otherwise(F.lit(9)).alias("INS_Maand_inschrijving_van"),
        F.when(col("c_mktsegment") == "BUILDING", F.lit("Deeltijd")).otherwise(F.lit("Voltijd")).alias("INS_Opleidingsvorm"),
        (col("o_orderpriority") != "5-LOW").alias("INS_Indicatie_actief_op_peildatum"),
        F.when(col("o_orderpriority") == "1-URGENT", F.lit("Q")).when(status == "F", F.lit("B"))
        .when(status == "O", F.lit("M")).otherwise(F.lit("S")).alias("INS_Opleidingsfase_actueel"),
        F.when(fourth == 0, F.lit("NL")).when(fourth == 1, F.lit("EER")).when(fourth == 2, F.lit("NIET-EER"))
        .alias("DEM_Nationaliteit_EER_naam"))


ENROLMENTS_SQL = """enrolled AS (
  SELECT *, year(o_orderdate) AS jaar, 'Fac e ' || n_name AS fac, 'Opl. ' || lower(c_mktsegment) AS opl,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Q' WHEN o_orderstatus = 'F' THEN 'B' WHEN o_orderstatus = 'O' THEN 'M' ELSE 'S' END AS fase,
         CASE o_custkey % 4 WHEN 0 THEN 'NL' WHEN 1 THEN 'EER' WHEN 2 THEN 'NIET-EER' END AS herkomst
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0)"""

FACULTY_SQL = ENROLMENTS_SQL + """, faculty AS (
  SELECT CAST(jaar AS INTEGER) AS "INS_Inschrijvingsjaar", fac AS "INS_Faculteit", """ + ", ".join(
    f"count(*) FILTER (WHERE fase = '{p}' AND herkomst = '{o}') AS \"{p}-{o}\"" for p in "BMQS" for o in ORIGINS) + """,
    count(*) AS total, count(*) FILTER (WHERE fase = 'S' AND herkomst IS NOT NULL) AS "S",
    count(*) FILTER (WHERE fase = 'Q' AND herkomst IS NOT NULL) AS "Q"
  FROM enrolled WHERE month(o_orderdate) <> 2 AND c_mktsegment <> 'BUILDING' AND o_orderpriority <> '5-LOW' GROUP BY 1, 2)"""

PROGRAMME_SQL = ENROLMENTS_SQL + """, programme AS (
  SELECT CAST(jaar AS INTEGER) AS "INS_Inschrijvingsjaar", opl AS "INS_Opleidingsnaam_2002",
         CAST(c_nationkey AS BIGINT) AS "INS_Opleidingscode_actueel", """ + ", ".join(
    f"count(*) FILTER (WHERE herkomst = '{o}') AS \"{o}\"" for o in ORIGINS) + """, count(herkomst) AS total
  FROM enrolled GROUP BY 1, 2, 3)"""


def _faculty(spark, sf_dir):
    return enrolment.faculty_enrolment(enrolment.clean_enrolments(enrolments(spark, sf_dir)), INSTITUTION)


def _programme(spark, sf_dir):
    return enrolment.programme_enrolment(enrolment.clean_enrolments(enrolments(spark, sf_dir)), INSTITUTION)


@query("WITH " + FACULTY_SQL + " SELECT * FROM faculty")
def job_faculty_enrolment(spark, sf_dir):
    return _faculty(spark, sf_dir)


@query("WITH " + PROGRAMME_SQL + " SELECT * FROM programme")
def job_programme_enrolment(spark, sf_dir):
    return _programme(spark, sf_dir)


def _years(spark, sf_dir):
    """Academic years of the orders, 1997 left out."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")).distinct().filter(col("y") != 1997)
    return years.select(F.concat(F.lit("J"), "y").alias("unl_collegejaarid"),
                        F.concat("y", F.lit("-"), col("y") + 1).alias("unl_name"))


@query("WITH " + FACULTY_SQL + """ SELECT """ + ", ".join(
    f"\"{p}-{o}\"" for p in "BMQS" for o in ORIGINS) + """, total AS unl_totaal, "S" AS unl_premaster, "Q" AS unl_postmaster,
    "B-EER" + "B-NIET-EER" + "B-NL" AS unl_bachelor, "M-EER" + "M-NIET-EER" + "M-NL" AS unl_master,
    'unl_collegejaars(J' || "INS_Inschrijvingsjaar" || ')' AS "unl_Collegejaar@odata.bind",
    'unl_faculteits(F' || n_nationkey || ')' AS "unl_Faculteit@odata.bind"
  FROM faculty JOIN nation ON "INS_Faculteit" = 'Fac e ' || n_name WHERE n_regionkey <> 3 AND "INS_Inschrijvingsjaar" <> 1997""")
def job_payload_faculty(spark, sf_dir):
    short = F.concat(F.lit("Fac e "), "n_name")
    faculties = table(spark, sf_dir, "nation").filter(col("n_regionkey") != 3).select(
        F.concat(F.lit("F"), "n_nationkey").alias("unl_faculteitid"),
        F.when(col("n_nationkey") % 2 == 0, F.concat(F.lit("INST - "), short)).otherwise(F.lower(short)).alias("unl_afkortingfaculteit"))
    naming = {"INS_Inschrijvingsjaar": "unl_jaar", "INS_Faculteit": "unl_faculteit", "total": "unl_totaal",
              "S": "unl_premaster", "Q": "unl_postmaster", "total_B": "unl_bachelor", "total_M": "unl_master"}
    return payloads.faculty_payload({"faculty_enrolment": _faculty(spark, sf_dir), "ref_academic_years": _years(spark, sf_dir),
                                     "ref_faculties": faculties}, naming, "inst")


@query("WITH " + PROGRAMME_SQL + """ SELECT "INS_Opleidingsnaam_2002" AS unl_opleidingnaam, "EER", "NIET-EER", "NL", total,
    'unl_opleidings(O' || min_key || ')' AS "unl_Opleiding@odata.bind"
  FROM programme JOIN (SELECT year(o_orderdate) AS y, c_nationkey AS n, lpad(CAST(min(o_custkey) AS VARCHAR), 12, '0') AS min_key
                       FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'FURNITURE' GROUP BY 1, 2)
  ON "INS_Inschrijvingsjaar" = y AND "INS_Opleidingscode_actueel" = n WHERE y <> 1997""")
def job_payload_programme_students(spark, sf_dir):
    programmes = (table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), col("o_custkey") == col("c_custkey"))
                  .filter(col("c_mktsegment") == "FURNITURE")
                  .select(F.concat(F.lit("O"), F.lpad(col("o_custkey").cast("string"), 12, "0")).alias("unl_opleidingid"),
                          col("c_nationkey").cast("string").alias("unl_opleidingscodeisat"),
                          F.concat(F.lit("J"), F.year("o_orderdate")).alias("_unl_collegejaar_value")))
    naming = {"INS_Opleidingsnaam_2002": "unl_opleidingnaam"}
    return payloads.programme_students_payload({"programme_enrolment": _programme(spark, sf_dir), "ref_programmes": programmes,
                                                "ref_academic_years": _years(spark, sf_dir)}, naming)


@query("WITH " + ENROLMENTS_SQL + """, counts AS (
    SELECT CAST(jaar AS INTEGER) AS "INS_Inschrijvingsjaar_EOI", upper(opl) AS "INS_Opleidingsnaam_2002",
           count(*) FILTER (WHERE herkomst = 'EER') AS "EER", count(*) FILTER (WHERE herkomst = 'NIET-EER') AS "NIET-EER",
           count(*) FILTER (WHERE herkomst = 'NL') AS "NL", count(herkomst) AS total
    FROM enrolled WHERE jaar = 1996 GROUP BY 1, 2),
  asked AS (SELECT 'OPL. ' || c_mktsegment AS opl, count(*) AS e_nl, count(*) FILTER (WHERE c_acctbal > 0) AS e_eer,
                   nullif(count(*) FILTER (WHERE c_mktsegment <> 'MACHINERY'), 0) AS e_niet
            FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' GROUP BY 1)
  SELECT c.*, e_nl AS "NL Totaal Inschrijvingen", e_eer AS "EER (Excl. NL) Totaal Inschrijvingen", e_niet AS "Niet-EER Totaal Inschrijvingen",
         e_nl + e_eer + coalesce(e_niet, 0) AS "Totaal_verwacht", e_nl - "NL" AS verschil_nl, e_eer - "EER" AS verschil_eer,
         e_niet - "NIET-EER" AS verschil_nieteer, e_nl + e_eer + coalesce(e_niet, 0) - total AS verschil_totaal
  FROM counts c JOIN asked ON "INS_Opleidingsnaam_2002" = opl""")
def job_validate_programme(spark, sf_dir):
    expected = (table(spark, sf_dir, "customer").filter(col("c_mktsegment") != "HOUSEHOLD")
                .groupBy(F.concat(F.lit("De opl. "), F.lower("c_mktsegment"), F.lit(" (voltijd)")).alias("Naam"))
                .agg(F.count(F.lit(1)).alias("NL Totaal Inschrijvingen"),
                     F.count_if(col("c_acctbal") > 0).alias("EER (Excl. NL) Totaal Inschrijvingen"),
                     F.nullif(F.count_if(col("c_mktsegment") != "MACHINERY"), F.lit(0)).alias("Niet-EER Totaal Inschrijvingen")))
    rows = enrolment.clean_enrolments(enrolments(spark, sf_dir))
    return validation.validate_programmes({"enrolments": rows, "expected_programmes": expected}, INSTITUTION, 1996)


# --- courses --------------------------------------------------------------------------------

def course_inputs(spark, sf_dir):
    """A course offering per order, a booking per order line."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key, status = col("o_orderkey"), col("o_orderstatus")
    code = F.concat(F.lit("V"), "o_custkey")
    year, period = (2020 + key % 3).cast("int"), (F.floor(key / 3) % 6 + 1).cast("int")
    offered = orders.join(customer, col("o_custkey") == col("c_custkey")).select(
        code.alias("UAS_Vak_Code"), year.alias("UAS_Vak_Jaar"),
        F.when(F.day("o_orderdate") != 11, F.concat(F.lit("Vak "), "o_custkey")).alias("UAS_Vak_Naam_NL"),
        (col("o_custkey") % 4 * 3).cast("double").alias("UAS_Vak_Studiepunten"),
        (status == "F").alias("UAS_Groep_Verplichte_keuze"), period.alias("UAS_Vak_Periode_start"),
        (1 + col("o_custkey") % 2).cast("int").alias("UAS_Vak_Duur"),
        F.when(status == "O", F.lit("Engels")).alias("OPL_Instructietaal"),
        F.when(col("c_nationkey") < 8, F.lit("Engels (EN)")).when(col("c_nationkey") < 16, F.lit("Tweetalig (Z1)"))
        .otherwise(F.lit("Frans")).alias("UAS_Opleiding_Onderwijstaal"),
        col("c_mktsegment").alias("UAS_Groep_Groepstype"), (key % 3 + 1).cast("int").alias("UAS_Groep_College_jaar"),
        col("c_name").alias("UAS_Vak_Opleidingsnaam_eigenaar"),
        F.concat(F.lit("P"), "c_nationkey").alias("UAS_Vak_Opleidingscode_eigenaar"),
        (F.month("o_orderdate") == 7).alias("UAS_Vak_scriptie"), (F.month("o_orderdate") == 5).alias("UAS_Vak_stage"),
        F.when(status == "F", F.lit("Bachelor")).when(status == "O", F.lit("Master")).alias("UAS_Opleiding_Fase_minimaal_generiek"),
        key.alias("source_order"))
    lines = table(spark, sf_dir, "lineitem").join(orders, col("l_orderkey") == key)
    results = lines.select(
        F.concat(code, F.lit("-"), col("l_linenumber") % 2).alias("RES_Module_ID"), code.alias("RES_Module_code"),
        (col("l_suppkey") % 10).cast("double").alias("INS_Studentnummer"), year.alias("Academisch_jaar"),
        F.when(col("l_tax") == 0.05, F.lit(99999999)).otherwise(F.lit(1)).cast("bigint").alias("RES_Studieprogramma_ID"),
        F.when(col("l_returnflag") == "R", F.lit(courses.PASSED)).when(col("l_returnflag") == "A", F.lit(courses.ENDED))
        .otherwise(F.lit("Open")).alias("RES_Boekingsstatus_omschrijving"),
        F.nullif(col("l_linestatus"), F.lit("O")).alias("RES_Beoordeling"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("source_order"))
    begin = F.date_add(F.make_date("UAS_Vak_Jaar", F.lit(9), F.lit(1)), (col("UAS_Vak_Periode_start") - 1) * 49 + col("UAS_Vak_Periode_start") % 3)
    calendar = offered.select("UAS_Vak_Jaar", "UAS_Vak_Periode_start").distinct().select(
        col("UAS_Vak_Jaar").alias("INS_Inschrijvingsjaar"), col("UAS_Vak_Periode_start").alias("ACA_Periode"),
        begin.alias("ACA_Einddatum_prev"), F.date_add(begin, 46).alias("ACA_Einddatum"))
    programme_map = customer.select(F.concat(F.lit("P"), "c_nationkey").alias("INS_Studieprogramma_CD"),
                                    (2021 + col("c_custkey") % 3).cast("int").alias("INS_Inschrijvingsjaar"),
                                    col("c_custkey").cast("double").alias("INS_Opleidingscode_actueel"))
    exam_forms = customer.select((2021 + col("c_custkey") % 2).cast("int").alias("UAS_Vak_Jaar"), F.concat(F.lit("V"), "c_custkey").alias("Code"),
                                 F.when(col("c_custkey") % 4 != 0, F.concat(F.lit("94179000"), col("c_custkey") % 10))
                                 .otherwise(F.lit("onbekend")).alias("toetsvorm_code"), col("c_custkey").alias("source_order"))
    return {"courses": offered, "results": results, "calendar": calendar, "programme_map": programme_map, "exam_forms": exam_forms}


COURSES_SQL = """offered AS (
  SELECT 'V' || o_custkey AS code, 2020 + o_orderkey % 3 AS jaar, (o_orderkey // 3) % 6 + 1 AS per, o_orderkey AS k, *
  FROM orders JOIN customer ON o_custkey = c_custkey),
booked AS (
  SELECT 'V' || o_custkey AS code, l_linenumber % 2 AS module, 2020 + o_orderkey % 3 AS jaar, l_tax, l_returnflag, l_linestatus,
         row_number() OVER (PARTITION BY o_custkey, l_linenumber % 2, o_orderkey % 3, l_suppkey % 10
                            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
counts AS (
  SELECT code, jaar, module, count(*) AS total_students, count(*) FILTER (WHERE l_returnflag = 'R') AS count_afgesloten,
         count(*) FILTER (WHERE l_linestatus <> 'O') AS count_with_result,
         row_number() OVER (PARTITION BY code, jaar ORDER BY module) AS first_module
  FROM booked WHERE rn = 1 AND jaar >= 2021 AND l_tax <> 0.05 AND l_returnflag <> 'N' GROUP BY 1, 2, 3),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY code, jaar, per ORDER BY k) AS rn FROM offered WHERE jaar >= 2021 AND day(o_orderdate) <> 11),
thesis AS (
  SELECT code, jaar, per, arg_min(CASE o_orderstatus WHEN 'F' THEN 941790000 ELSE 941790001 END, k) AS thesis_code
  FROM offered WHERE month(o_orderdate) = 7 AND o_orderstatus <> 'P' GROUP BY 1, 2, 3),
stage AS (SELECT DISTINCT code, jaar, per FROM offered WHERE month(o_orderdate) = 5 AND o_orderstatus <> 'P'),
periods AS (
  SELECT DISTINCT jaar, per, make_date(jaar, 9, 1) + CAST((per - 1) * 49 + per % 3 AS INTEGER) AS prev FROM offered),
mart AS (
  SELECT f.code AS "UAS_Vak_Code", CAST(f.jaar AS INTEGER) AS "UAS_Vak_Jaar", 'Vak ' || o_custkey AS "UAS_Vak_Naam_NL",
         CAST(o_custkey % 4 * 3 AS DOUBLE) AS "UAS_Vak_Studiepunten", o_orderstatus = 'F' AS "UAS_Groep_Verplichte_keuze",
         CAST(f.per AS INTEGER) AS "UAS_Vak_Periode_start", CASE WHEN f.per = 3 THEN a.prev + 14 ELSE a.prev END AS "Startmoment_vak",
         CAST(1 + o_custkey % 2 AS INTEGER) AS "UAS_Vak_Duur", total_students,
         CASE WHEN o_orderstatus = 'O' OR c_nationkey < 8 THEN 'Engels' WHEN c_nationkey < 16 THEN 'Nederlands/Engels' ELSE 'Frans' END AS "OPL_Instructietaal",
         CASE WHEN c_nationkey < 8 THEN 'Engels (EN)' WHEN c_nationkey < 16 THEN 'Tweetalig (Z1)' ELSE 'Frans' END AS "UAS_Opleiding_Onderwijstaal",
         c_mktsegment AS "UAS_Groep_Groepstype", CAST(k % 3 + 1 AS INTEGER) AS "UAS_Groep_College_jaar",
         c_name AS "UAS_Vak_Opleidingsnaam_eigenaar", 'P' || c_nationkey AS "UAS_Vak_Opleidingscode_eigenaar",
         count_with_result, count_afgesloten, k AS source_order, CAST(f.per + o_custkey % 2 AS INTEGER) AS "UAS_Vak_Periode_einde",
         b.prev AS "ACA_Einddatum_prev", b.prev + 46 AS "ACA_Einddatum",
         round_even((b.prev + 46 - CASE WHEN f.per = 3 THEN a.prev + 14 ELSE a.prev END) / 7, 0) AS weeks_diff,
         CAST((SELECT min(c2.c_custkey) FROM customer c2 WHERE c2.c_nationkey = f.c_nationkey) AS DOUBLE) AS "INS_Opleidingscode_actueel",
         CAST(coalesce(thesis_code, CASE WHEN s.code IS NOT NULL THEN 941790007 END,
                       CASE WHEN o_custkey % 4 <> 0 AND 2021 + o_custkey % 2 = f.jaar THEN 941790000 + o_custkey % 10 END) AS INTEGER) AS unl_eindtoetsnaam
  FROM firsts f LEFT JOIN counts n ON n.code = f.code AND n.jaar = f.jaar AND first_module = 1
  LEFT JOIN periods a ON a.jaar = f.jaar AND a.per = f.per LEFT JOIN periods b ON b.jaar = f.jaar AND b.per = f.per + o_custkey % 2
  LEFT JOIN thesis t ON t.code = f.code AND t.jaar = f.jaar AND t.per = f.per
  LEFT JOIN stage s ON s.code = f.code AND s.jaar = f.jaar AND s.per = f.per WHERE f.rn = 1)"""


@query("WITH " + COURSES_SQL + " SELECT * FROM mart")
def job_course_mart(spark, sf_dir):
    return courses.course_mart(course_inputs(spark, sf_dir))


@query("WITH " + COURSES_SQL + """ SELECT "UAS_Vak_Code", "UAS_Vak_Periode_start", total_students = k % 5 AS total_students_equal,
    total_students - k % 5 AS total_students_difference, weeks_diff = 7 AS weeks_diff_equal, weeks_diff - 7 AS weeks_diff_difference,
    count_afgesloten = 1 AS count_afgesloten_equal, count_afgesloten - 1 AS count_afgesloten_difference,
    "UAS_Vak_Studiepunten" = 6 AS "ECs_overeen", DATE '2021-09-02' = "Startmoment_vak" AS "Startdatum_overeen",
    CAST("Startmoment_vak" - DATE '2021-09-02' AS INTEGER) AS verschil_startdatum,
    "UAS_Groep_Verplichte_keuze" = (k % 2 = 0) AS verplicht_overeen
  FROM mart JOIN (SELECT c_custkey AS k FROM customer WHERE c_mktsegment <> 'HOUSEHOLD') ON "UAS_Vak_Code" = 'V' || k
  WHERE "UAS_Vak_Jaar" = 2021""")
def job_validate_courses(spark, sf_dir):
    key = col("c_custkey")
    expected = table(spark, sf_dir, "customer").filter(col("c_mktsegment") != "HOUSEHOLD").select(
        F.concat(F.lit("V"), key).alias("Vakcode"), F.lit(6.0).alias("EC's"),
        F.to_timestamp_ntz(F.lit("2021-09-01 10:00:00")).alias("Startdatum"), (key % 5).alias("Aantal Deelnemers"),
        F.lit(7.0).alias("Aantal Collegeweken"), F.lit(1).cast("long").alias("Aantal Geslaagden Eindtoets"),
        F.when(key % 2 == 0, F.lit("Verplicht")).otherwise(F.lit("Keuze")).alias("Verplicht/Keuze"))
    checked = courses.validate_courses(courses.course_mart(course_inputs(spark, sf_dir)), expected)
    flags = [c for c in checked.columns if c.endswith(("_equal", "_difference", "_overeen", "verschil_startdatum"))]
    return checked.select("UAS_Vak_Code", "UAS_Vak_Periode_start", *cols(flags))


# --- finance --------------------------------------------------------------------------------

def finance_inputs(spark, sf_dir):
    """An export line per order: the customer is the account, the priority the faculty."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    export = orders.select(
        F.when(F.day("o_orderdate") != 13, F.concat(F.lit("T"), "o_custkey")).alias("Toewijzing"),
        F.substring("o_orderpriority", 3, 3).alias("Faculteit"), F.year("o_orderdate").alias("Jaar"),
        col("o_totalprice").alias(finance.LAST_YEAR),
        F.when(col("o_orderstatus") != "P", col("o_totalprice")).alias(finance.THIS_YEAR), "o_orderkey")
    mapping = customer.select(F.concat(F.lit("T"), "c_custkey").alias("Toewijzing"),
                              F.when(col("c_mktsegment") != "BUILDING", col("c_mktsegment")).alias(finance.FIELD))
    return {"finance_export": export, "finance_mapping": mapping}


FINANCE_SQL = """fin AS (
  SELECT substr(o_orderpriority, 3, 3) AS "Faculteit", c_mktsegment AS "Veldnaam", 'T' || o_custkey AS acc, o_orderkey AS k, side,
         CAST(year(o_orderdate) - (1 - side) AS INTEGER) AS "Jaar",
         CASE WHEN side = 0 OR o_orderstatus <> 'P' THEN o_totalprice END AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey, range(0, 2) r(side) WHERE day(o_orderdate) <> 13 AND c_mktsegment <> 'BUILDING'),
long AS (SELECT "Faculteit", "Veldnaam", coalesce(round(sum(amount), 2), 0) AS "Waarde", "Jaar" FROM fin GROUP BY ALL)"""


def _finance(spark, sf_dir):
    rows = finance.finance_long(finance_inputs(spark, sf_dir), ["o_orderkey"], names=False)
    return rows.withColumn("Waarde", F.round("Waarde", 2))


@query("WITH " + FINANCE_SQL + """, placed AS (
    SELECT *, row_number() OVER (PARTITION BY "Faculteit", "Veldnaam", "Jaar" ORDER BY k, side) AS rn FROM fin)
  SELECT "Faculteit", "Veldnaam", "Jaar", (rn - 1) // 1000 AS part, md5(string_agg(acc, ', ' ORDER BY rn)) AS "Naam_intern",
         CASE WHEN part = 0 THEN any_value("Waarde") END AS "Waarde"
  FROM placed JOIN long USING ("Faculteit", "Veldnaam", "Jaar") GROUP BY 1, 2, 3, 4""")
def job_finance_long(spark, sf_dir):
    # so many names to a part that some groups have several
    rows = finance.finance_long(finance_inputs(spark, sf_dir), ["o_orderkey"], part_rows=1000)
    return rows.withColumns({"Waarde": F.round("Waarde", 2), "Naam_intern": F.md5("Naam_intern")})


@query("WITH " + FINANCE_SQL + """ SELECT "Faculteit", "Veldnaam", "Jaar", part, md5(string_agg(acc, ', ' ORDER BY rn)) AS names
  FROM (SELECT *, (rn - 1) // 100000 AS part FROM (SELECT *, row_number() OVER (PARTITION BY "Faculteit", "Veldnaam", "Jaar" ORDER BY k, side) AS rn FROM fin))
  GROUP BY ALL""")
def job_finance_names(spark, sf_dir):
    names = finance.finance_names(finance_inputs(spark, sf_dir), ["o_orderkey"])
    return names.withColumn("names", F.md5("names"))


@query("WITH " + FINANCE_SQL + """ SELECT "Faculteit", "Veldnaam", coalesce(round(sum(amount), 2), 0) AS "Waarde", "Jaar"
  FROM (SELECT *, max("Jaar") OVER (PARTITION BY "Faculteit", "Veldnaam", acc) AS last FROM fin) WHERE side = 0 OR "Jaar" = last GROUP BY ALL""")
def job_finance_long_strict(spark, sf_dir):
    rows = finance.finance_long(finance_inputs(spark, sf_dir), ["o_orderkey"], strict_max=True, names=False)
    return rows.withColumn("Waarde", F.round("Waarde", 2))


FIELDS = {"AUTOMOBILE": "unl_budget1egeldstroom", "FURNITURE": "unl_collegegelden", "HOUSEHOLD": "unl_externeinhuur",
          "MACHINERY": "unl_overigeexternebaten"}


@query("WITH " + FINANCE_SQL + " SELECT " + ", ".join(
    f"coalesce(max(\"Waarde\") FILTER (WHERE \"Veldnaam\" = '{f}'), 0) AS {n}" for f, n in FIELDS.items()) + """,
    CASE WHEN "Faculteit" <> 'MED' THEN 'unl_faculteits(F' || lower("Faculteit") || ')' END AS "unl_Faculteit@odata.bind",
    CASE WHEN "Jaar" >= 1996 THEN 'unl_kalenderjaars(K' || "Jaar" || ')' END AS "unl_Jaar@odata.bind",
    0 AS unl_onderzoek4egeldstroom, 0 AS unl_aanvullendesubsidies
  FROM long GROUP BY "Faculteit", "Jaar" """)
def job_payload_finance(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    short = F.substring("o_orderpriority", 3, 3)
    faculties = orders.select(short.alias("short")).distinct().filter(col("short") != "MED").select(
        F.concat(F.lit("F"), F.lower("short")).alias("unl_faculteitid"),
        F.when(col("short") == "LOW", F.concat(F.lit("Inst-"), "short")).otherwise(col("short")).alias("unl_afkortingfaculteit"))
    years = orders.select(F.year("o_orderdate").alias("y")).distinct().filter(col("y") >= 1996).select(
        F.concat(F.lit("K"), "y").alias("unl_kalenderjaarid"), col("y").cast("string").alias("unl_name"))
    naming = {"Faculteit": "unl_faculteit", "Jaar": "unl_jaar", **FIELDS}
    return payloads.finance_payload({"finance": _finance(spark, sf_dir), "ref_faculties": faculties, "ref_calendar_years": years},
                                    list(FIELDS), naming, "inst")


# --- staff ----------------------------------------------------------------------------------

DESCRIPTIONS = ["Docent 2", "Tandartsdocent", "Specialist in opleiding 1", "Student-assistent", "Hoogleraar 1"]


def staff_inputs(spark, sf_dir):
    """A staff line per order, with quarter values per month, some missing, some negative."""
    key, customer_key = col("o_orderkey"), col("o_custkey")
    months = [F.when((key + m) % 9 != 0, ((key * m) % 5 - 1) / 4).alias(name) for m, name in enumerate(staff.MONTHS, 1)]
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), col("o_custkey") == col("c_custkey"))
    export = rows.select(
        F.concat(F.lit("A/"), F.lpad((customer_key % 25).cast("string"), 3, "0")).alias("Salaris Schaal"),
        F.when(col("o_orderpriority") <= "2-HIGH", F.lit("WP")).when(col("o_orderpriority") <= "4", F.lit("OBP")).otherwise(F.lit("X")).alias("WP of OBP"),
        F.element_at(F.array(*[F.lit(d) for d in DESCRIPTIONS]), (customer_key % 5 + 1).cast("int")).alias("Omschrijving"),
        F.concat(F.lpad(col("c_nationkey").cast("string"), 3, "F"), F.lit(" centre")).alias("Profit Center aanstelling"),
        F.when(col("o_orderstatus") == "F", F.lit("Geldstroom 2")).otherwise(F.lit("Geldstroom 1")).alias("Geldstroom"),
        F.element_at(F.array(F.lit("OW"), F.lit("OZ"), F.lit("OV")), (key % 3 + 1).cast("int")).alias("Kernactiviteit"),
        F.when(F.day("o_orderdate") != 10, F.lit(staff.MEASURE)).otherwise(F.lit("Kosten")).alias("MEASURES"),
        (2020 + F.floor(key / 3) % 3).cast("int").alias("Jaar"), *months)
    mapping = table(spark, sf_dir, "nation").filter(col("n_regionkey") != 4).select(
        F.lpad(col("n_nationkey").cast("string"), 3, "F").alias("Profit_center_afkorting"), col("n_name").alias("Faculteit"))
    return {"staff_export": export, "profit_centre_mapping": mapping}


def _mean_sql(months: range) -> str:
    return "(" + " + ".join(f"CASE WHEN (o_orderkey + {m}) % 9 <> 0 THEN ((o_orderkey * {m}) % 5 - 1) / 4 ELSE 0 END" for m in months) + f") / {len(months)}"


STAFF_SQL = f"""rows_ AS (
  SELECT {_mean_sql(range(1, 13))} AS fte, o_orderstatus, o_orderpriority, CAST(2020 + (o_orderkey // 3) % 3 AS INTEGER) AS "Jaar",
         CASE WHEN n_regionkey <> 4 THEN n_name END AS "Faculteit", (['OW', 'OZ', 'OV'])[o_orderkey % 3 + 1] AS kern,
         (['Docent', 'Docent', 'Promovendus', 'Student-assistent', 'Hoogleraar'])[o_custkey % 5 + 1] AS func,
         CASE WHEN o_custkey % 25 BETWEEN 5 AND 10 THEN 'Schaal 5 t/m 10' WHEN o_custkey % 25 BETWEEN 11 AND 20 THEN 'Schaal 11 en hoger'
              ELSE 'Andere schalen' END AS schaal
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE day(o_orderdate) <> 10),
reports AS (
  SELECT func AS "Veldnaam", * FROM rows_ WHERE o_orderpriority <= '2-HIGH' OR func = 'Student-assistent'
  UNION ALL SELECT func || ' - ' || kern, * FROM rows_ WHERE (o_orderpriority <= '2-HIGH' OR func = 'Student-assistent') AND kern <> 'OV' AND o_orderstatus <> 'F'
  UNION ALL SELECT 'OBP - ' || schaal, * FROM rows_ WHERE o_orderpriority LIKE '3%' AND func <> 'Student-assistent'),
fte AS (
  SELECT "Veldnaam", "Jaar", "Faculteit", greatest(round(f * CASE WHEN "Jaar" = 2021 THEN 2 ELSE 1 END, 6), 0) AS "FTE_gemiddelde",
         "Jaar" AS unl_verslagjaar
  FROM (SELECT "Veldnaam", "Jaar", "Faculteit", sum(fte) AS f FROM reports GROUP BY 1, 2, 3))"""


def _staff(spark, sf_dir):
    return staff.staff_fte(staff_inputs(spark, sf_dir)).withColumn("FTE_gemiddelde", F.round("FTE_gemiddelde", 6))


@query("WITH " + STAFF_SQL + " SELECT * FROM fte")
def job_staff_fte(spark, sf_dir):
    return _staff(spark, sf_dir)


STAFF_FIELDS = {f: f"unl_fte{i}" for i, f in enumerate(
    ["Docent", "Hoogleraar", "Promovendus", "Student-assistent", "Docent - OW", "Docent - OZ", "Hoogleraar - OW", "Hoogleraar - OZ",
     "Promovendus - OW", "Promovendus - OZ", "Student-assistent - OW", "Student-assistent - OZ", "OBP - Schaal 5 t/m 10",
     "OBP - Schaal 11 en hoger", "OBP - Andere schalen"])}


@query("WITH " + STAFF_SQL + " SELECT " + ", ".join(
    f"coalesce(max(\"FTE_gemiddelde\") FILTER (WHERE \"Veldnaam\" = '{f}'), 0) AS {n}" for f, n in STAFF_FIELDS.items()) + """,
    'unl_faculteits(F' || any_value(n_nationkey) || ')' AS "unl_FaculteitNaam@odata.bind",
    CASE WHEN "Jaar" <> 2022 THEN 'unl_collegejaars(J' || "Jaar" || ')' END AS "unl_Jaar@odata.bind",
    'unl_kalenderjaars(K' || "Jaar" || ')' AS "unl_Verslagjaar@odata.bind", """ + ", ".join(f"0 AS {n}" for n in payloads.STAFF_ZEROS) + """
  FROM fte LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) n3 ON "Faculteit" = n_name GROUP BY "Jaar", "Faculteit" """)
def job_payload_staff(spark, sf_dir):
    inputs = staff_inputs(spark, sf_dir)
    faculties = table(spark, sf_dir, "nation").filter(col("n_regionkey") != 3).select(
        F.concat(F.lit("F"), "n_nationkey").alias("unl_faculteitid"), F.concat(F.lit("INST - "), "n_name").alias("unl_afkortingfaculteit"))
    years = inputs["staff_export"].select("Jaar").distinct()
    academic = years.filter(col("Jaar") != 2022).select(F.concat(F.lit("J"), "Jaar").alias("unl_collegejaarid"),
                                                        F.concat("Jaar", F.lit("-"), col("Jaar") + 1).alias("unl_name"))
    calendar = years.select(F.concat(F.lit("K"), "Jaar").alias("unl_kalenderjaarid"), col("Jaar").cast("string").alias("unl_name"))
    naming = {"Jaar": "unl_jaar", "Faculteit": "unl_faculteitpersoneelid", **STAFF_FIELDS}
    return payloads.staff_payload({"staff": _staff(spark, sf_dir), "ref_faculties": faculties, "ref_academic_years": academic,
                                   "ref_calendar_years": calendar}, list(STAFF_FIELDS), naming, "inst")


# --- programmes -----------------------------------------------------------------------------

@query("""WITH p AS (
    SELECT n_name, 'Opl ' || c_nationkey || c_mktsegment AS naam, 2021 + c_custkey % 4 AS jaar, c_custkey AS k,
           (['VOLTIJD', 'DEELTIJD', 'DUAAL', 'ANDERS'])[c_custkey % 4 + 1] AS vorm, CASE c_custkey % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'M' WHEN 2 THEN 'X' END AS graad,
           (['Nederlands', 'Engels', 'Nederlands/Engels', 'Frans', NULL])[c_custkey // 5 % 5 + 1] AS taal, c_nationkey
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE 2021 + c_custkey % 4 IN (2022, 2023, 2024)),
  coded AS (SELECT *, CASE vorm WHEN 'DEELTIJD' THEN 2 WHEN 'DUAAL' THEN 3 ELSE 1 END AS v, CASE graad WHEN 'B' THEN 1 WHEN 'M' THEN 2 END AS g FROM p),
  filled AS (SELECT *, coalesce(g, first_value(g IGNORE NULLS) OVER (PARTITION BY naam ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS g2 FROM coded)
  SELECT naam AS unl_opleidingnaam, 'WO' AS unl_soort, CAST(c_nationkey AS VARCHAR) AS unl_opleidingscodeisat, CAST(v AS INTEGER) AS unl_vorm,
         CAST(g2 AS INTEGER) AS unl_graad,
         CAST(CASE WHEN taal IN ('Nederlands', 'Nederlands/Engels') THEN 941790000 WHEN taal = 'Engels' THEN 941790001 WHEN taal IS NOT NULL THEN 941790002 END AS INTEGER) AS unl_taalvanopleiding,
         'unl_collegejaars(J' || jaar || ')' AS "unl_Collegejaar@odata.bind", 'unl_faculteits(F' || c_nationkey || ')' AS "unl_Faculteit@odata.bind", """
       + ", ".join(f"0 AS {n}" for n in payloads.PROGRAMME_ZEROS)
       + " FROM (SELECT DISTINCT naam, c_nationkey, v, g2, taal, jaar FROM filled)")
def job_payload_programme(spark, sf_dir):
    key = col("c_custkey")

    def choose(values, index):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), col("c_nationkey") == col("n_nationkey"))
    programmes = rows.select(
        col("n_name").alias("INS_Faculteit"), F.concat(F.lit("Opl "), "c_nationkey", "c_mktsegment").alias("INS_Opleidingsnaam_2002"),
        (2021 + key % 4).cast("int").alias("INS_Inschrijvingsjaar"), F.lit("WO").alias("INS_Soort_onderwijs"),
        col("c_nationkey").alias("INS_Opleidingscode_Z08"), choose(["VOLTIJD", "DEELTIJD", "DUAAL", "ANDERS"], key % 4).alias("INS_Opleidingsvorm"),
        F.lit("x").alias("OPL_Code_actueel"), choose(["Nederlands", "Engels", "Nederlands/Engels", "Frans", None], F.floor(key / 5) % 5).alias("OPL_Instructietaal"),
        choose(["B", "M", "X", None, None], key % 5).alias("Graadtoevoeging"), key.alias("source_order"))
    years = programmes.select(col("INS_Inschrijvingsjaar").alias("y")).distinct().select(
        F.concat(F.lit("J"), "y").alias("unl_collegejaarid"), F.concat("y", F.lit("-"), col("y") + 1).alias("unl_name"))
    faculties = table(spark, sf_dir, "nation").select(F.concat(F.lit("F"), "n_nationkey").alias("unl_faculteitid"),
                                                      F.lower("n_name").alias("unl_afkortingfaculteit"))
    naming = {"INS_Faculteit": "unl_faculteit", "INS_Opleidingsnaam_2002": "unl_opleidingnaam", "INS_Inschrijvingsjaar": "unl_collegejaar",
              "INS_Soort_onderwijs": "unl_soort", "INS_Opleidingscode_Z08": "unl_opleidingscodeisat", "INS_Opleidingsvorm": "unl_vorm",
              "OPL_Instructietaal": "unl_taalvanopleiding", "Graadtoevoeging": "unl_graad"}
    return payloads.programme_payload({"programmes": programmes, "ref_academic_years": years, "ref_faculties": faculties}, naming, "inst")


# --- timetable ------------------------------------------------------------------------------

def timetable_mart(spark, sf_dir):
    """A course per customer and year with gaps in periods, dates and programme codes."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), col("o_custkey") == col("c_custkey"))
    year = (2021 + col("o_orderkey") % 3).cast("int")
    grouped = rows.groupBy("o_custkey", "c_nationkey", "c_mktsegment", year.alias("UAS_Vak_Jaar")).agg(
        F.min("o_orderkey").alias("source_order"), F.count(F.lit(1)).alias("n"))
    key, per = col("o_custkey"), (col("source_order") % 6 + 1).cast("int")
    known = col("n") % 3 != 0
    start = F.date_add(F.make_date("UAS_Vak_Jaar", F.lit(9), F.lit(1)), per * 40)
    return grouped.select(
        F.concat(F.lit("V"), key).alias("UAS_Vak_Code"), "UAS_Vak_Jaar",
        F.concat(F.lit("Vak "), key).alias("UAS_Vak_Naam_NL"), F.when(key % 9 != 0, F.lit(6.0)).alias("UAS_Vak_Studiepunten"),
        F.when(col("n") % 4 != 0, col("n") % 2 == 0).alias("UAS_Groep_Verplichte_keuze"),
        F.when(known, per).alias("UAS_Vak_Periode_start"), F.when(known, per + 1).alias("UAS_Vak_Periode_einde"),
        F.when(key % 4 != 0, start).alias("Startmoment_vak"), F.when(key % 5 != 0, F.date_add(start, 45)).alias("ACA_Einddatum"),
        start.alias("ACA_Einddatum_prev"), F.when(key % 3 == 0, F.lit("")).when(key % 3 == 1, F.lit("Premaster")).alias("UAS_Groep_Groepstype"),
        (col("source_order") % 4 + 1).cast("int").alias("UAS_Groep_College_jaar"),
        F.when(key % 2 == 0, F.lit("Nederlands (NL)")).otherwise(F.lit("Frans")).alias("UAS_Opleiding_Onderwijstaal"),
        F.concat(F.lit("P"), "c_nationkey").alias("UAS_Vak_Opleidingscode_eigenaar"),
        F.when(key % 6 == 0, key.cast("double")).alias("INS_Opleidingscode_actueel"),
        F.when(col("n") % 5 == 0, F.lit(1)).alias("unl_eindtoetsnaam"), col("n").alias("count_afgesloten"), "source_order")


def timetable_inputs(spark, sf_dir):
    programme_map = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("P"), "c_nationkey").alias("INS_Studieprogramma_CD"), (2021 + col("c_custkey") % 2).cast("int").alias("INS_Inschrijvingsjaar"),
        col("c_custkey").cast("double").alias("INS_Opleidingscode_actueel"))
    return {"activities": activities_from_orders(table(spark, sf_dir, "orders")), "course_mart": timetable_mart(spark, sf_dir),
            "programme_map": programme_map}


def _cell_sql(edition: timetable.Variant, measure: str, form: str) -> str:
    raw = ", ".join(f"'{r}'" for r in edition.types[form])
    return f"list({measure} ORDER BY ter_type) FILTER (WHERE ter_type IN ({raw}))"


LOAD = ("n_groups", "n_weeks", "minutes_per_group_week", "contact_hours")
SHORT = {timetable.LECTURE: "lec", timetable.CLASS: "cls", timetable.LAB: "lab", timetable.TRIP: "trip", timetable.GUIDED: "grp", timetable.UNGUIDED: "own"}
TRIP, GUIDED, UNGUIDED = timetable.TRIP, timetable.GUIDED, timetable.UNGUIDED


def _fill_sql(name: str, window: str) -> str:
    return f"""coalesce(last_value({name} IGNORE NULLS) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                        first_value({name} IGNORE NULLS) OVER ({window} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def _slot_sql(edition: timetable.Variant, i: int) -> str:
    picks = {"groepen": "n_groups", "aantalweken": "n_weeks", "urenperweekpergroep": "minutes_per_group_week", "totaalcontacturen": "contact_hours"}
    forms = [f for f in timetable.RANKED if f in edition.types]
    return ", ".join(f"CASE f{i} " + " ".join(f"WHEN '{f}' THEN {SHORT[f]}_{m}" for f in forms) + f" END AS unl_werkvorm{i}{n}" for n, m in picks.items())


def timetable_sql(edition: timetable.Variant) -> str:
    """The common table expressions of the timetable job; the last one is `timetable`."""
    wide = ", ".join(f"{_cell_sql(edition, m, form)} AS {SHORT[form]}_{m}" for form in edition.types for m in LOAD)
    all_raw = ", ".join(f"'{r}'" for raws in edition.types.values() for r in raws)
    slots = range(1, edition.slots + 1)
    ranked = ", ".join(f"{{'m': -list_max({SHORT[f]}_minutes_per_group_week), 'p': {i}, 'n': '{f}'}}"
                       for i, f in enumerate(f for f in timetable.RANKED if f in edition.types))
    by_year = "jaar, k" if edition.name == "new" else "k"
    programme = "coalesce(code, own_code)" if edition.prefer_programme == "right" else "coalesce(own_code, code)"
    return ACTIVITIES_SQL + f""", load AS ({workload_sql(edition.name)}),
wide AS (SELECT ter_module_code, unl_jaar, {wide} FROM load WHERE ter_type IN ({all_raw}) GROUP BY 1, 2),
places AS (SELECT *, list_sort(list_filter([{ranked}], lambda x: x.m IS NOT NULL)) AS forms FROM wide),
ranked AS (SELECT * EXCLUDE (forms), {", ".join(f"forms[{i}].n AS f{i}" for i in slots)} FROM places),
raw_mart AS (
  SELECT o_custkey AS ck, c_nationkey, 2021 + o_orderkey % 3 AS jaar, min(o_orderkey) AS k, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
gaps AS (
  SELECT *, CASE WHEN n % 3 <> 0 THEN k % 6 + 1 END AS ps, make_date(jaar, 9, 1) + CAST((k % 6 + 1) * 40 AS INTEGER) AS start,
         CASE WHEN ck % 6 = 0 THEN CAST(ck AS DOUBLE) END AS own_code FROM raw_mart),
filled1 AS (SELECT *, {_fill_sql('ps', f'PARTITION BY ck ORDER BY {by_year}')} AS per FROM gaps),
filled2 AS (
  SELECT *, {_fill_sql('CASE WHEN ck % 4 <> 0 THEN start END', f'PARTITION BY jaar, per ORDER BY k')} AS begin_,
         {_fill_sql('CASE WHEN ck % 5 <> 0 THEN start + 45 END', f'PARTITION BY jaar, per ORDER BY k')} AS end_ FROM filled1),
exams AS (SELECT module, arg_min(jaar, k) AS jaar FROM acts WHERE kept = 1 AND n_events > 0 AND type = 'Tentamen digitaal' GROUP BY 1),
timetable AS (
  SELECT ter_module_code AS unl_vakcode, r.unl_jaar, r.* EXCLUDE (ter_module_code, unl_jaar, {", ".join(f"f{i}" for i in slots)}),
         {", ".join(f"f{i} AS unl_werkvorm{i}naam" for i in slots)}, {", ".join(_slot_sql(edition, i) for i in slots)},
         CASE WHEN ck IS NOT NULL THEN 'Vak ' || ck END AS unl_name, CASE WHEN ck % 9 <> 0 THEN CAST(6 AS DOUBLE) END AS unl_ecs, CASE WHEN n % 4 <> 0 THEN n % 2 = 0 END AS unl_verplichtkeuze,
         CAST(per AS INTEGER) AS period, begin_ AS unl_startdatum, end_ AS einddatum, round_even((end_ - begin_) / 7, 0) AS weeks_diff,
         CASE WHEN ck % 3 = 1 THEN 'Premaster' ELSE CAST(k % 4 + 1 AS VARCHAR) END AS unl_vakjaar,
         CASE WHEN ck IS NULL THEN NULL WHEN ck % 2 = 0 THEN 'Nederlands (NL)' ELSE 'Frans' END AS unl_taalvanvak,
         {programme} AS "INS_Opleidingscode_actueel", n AS count_afgesloten, k AS source_order,
         CAST(coalesce(CASE WHEN n % 5 = 0 THEN 1 END, CASE WHEN e.module IS NOT NULL THEN 941790006 END) AS INTEGER) AS unl_eindtoetsnaam
  FROM ranked r LEFT JOIN filled2 ON ter_module_code = 'V' || ck AND CAST(substr(r.unl_jaar, 1, 4) AS INTEGER) = jaar
  LEFT JOIN (SELECT c_nationkey AS nat, 2021 + c_custkey % 2 AS y, CAST(min(c_custkey) AS DOUBLE) AS code FROM customer GROUP BY 1, 2) ON nat = c_nationkey AND y = jaar
  LEFT JOIN exams e ON e.module = ter_module_code AND CAST(substr(r.unl_jaar, 1, 4) AS INTEGER) = e.jaar)"""


TIMETABLE_SQL = timetable_sql(timetable.NEW)


def _timetable(spark, sf_dir, variant="new"):
    return timetable.timetable_workload(timetable_inputs(spark, sf_dir), variant)


def list_text(name: str):
    return F.array_join(F.transform(col(name), lambda x: F.round(x, 4).cast("string")), ",")


GROUPS_AND_WEEKS = {"groepen": "n_groups", "aantalweken": "n_weeks"}
LIST_OUT = {
    **{f"unl_{form}{part}": f"{short}_{measure}" for form, short in (("hoorcollege", "lec"), ("werkcollege", "cls"), ("practicum", "lab"))
       for part, measure in GROUPS_AND_WEEKS.items()},
    **{f"{measure}_{form}": f"{short}_{measure}" for form, short in ((TRIP, "trip"), (GUIDED, "grp")) for measure in GROUPS_AND_WEEKS.values()},
    **{f"unl_werkvorm{i}{part}": f"unl_werkvorm{i}{part}" for i in (1, 2) for part in GROUPS_AND_WEEKS}}
MINUTES_OUT = {
    **{f"unl_{form}urenperweekpergroep": f"{short}_minutes_per_group_week" for form, short in (("hoorcollege", "lec"), ("werkcollege", "cls"), ("practicum", "lab"))},
    "unl_hoorcollegetotaalcontacturen": "lec_contact_hours", "contact_hours_Werk/instructiecollege": "cls_contact_hours", "contact_hours_Practicum/Lab": "lab_contact_hours",
    **{f"{measure}_{form}": f"{short}_{measure}" for form, short in ((TRIP, "trip"), (GUIDED, "grp")) for measure in ("minutes_per_group_week", "contact_hours")},
    **{f"unl_werkvorm{i}{part}": f"unl_werkvorm{i}{part}" for i in (1, 2) for part in ("urenperweekpergroep", "totaalcontacturen")}}
PLAIN_OUT = ["unl_vakcode", "unl_jaar", "unl_werkvorm1naam", "unl_werkvorm2naam", "unl_name", "unl_ecs", "unl_verplichtkeuze", "unl_startdatum",
             "weeks_diff", "unl_vakjaar", "unl_taalvanvak", "INS_Opleidingscode_actueel", "unl_eindtoetsnaam", "source_order"]


@query("WITH " + TIMETABLE_SQL + " SELECT " + ", ".join(f'"{n}"' for n in PLAIN_OUT) + ", "
       + ", ".join(f'array_to_string({sql}, \',\') AS "{n}"' for n, sql in LIST_OUT.items()) + ", "
       + ", ".join(f'round(list_sum({sql}), 4) AS "{n}"' for n, sql in MINUTES_OUT.items())
       + """, period AS "UAS_Vak_Periode_start", einddatum AS "ACA_Einddatum", count_afgesloten AS unl_aantalgeslaagdeneindtoets FROM timetable""")
def job_timetable_workload(spark, sf_dir):
    out = _timetable(spark, sf_dir)
    minutes = [F.round(F.aggregate(col(n), F.lit(0.0), lambda a, x: a + x), 4).alias(n) for n in MINUTES_OUT]
    return out.select(*cols(PLAIN_OUT), *[F.array_join(col(n).cast("array<string>"), ",").alias(n) for n in LIST_OUT], *minutes,
                      "UAS_Vak_Periode_start", "ACA_Einddatum", "unl_aantalgeslaagdeneindtoets")


OLD_LISTS = LIST_OUT | {f"{m}_{UNGUIDED}": f"own_{m}" for m in GROUPS_AND_WEEKS.values()} | {f"unl_werkvorm3{p}": f"unl_werkvorm3{p}" for p in GROUPS_AND_WEEKS}
OLD_MINUTES = MINUTES_OUT | {f"{m}_{UNGUIDED}": f"own_{m}" for m in ("minutes_per_group_week", "contact_hours")} | {
    f"unl_werkvorm3{p}": f"unl_werkvorm3{p}" for p in ("urenperweekpergroep", "totaalcontacturen")}


@query("WITH " + timetable_sql(timetable.OLD) + " SELECT unl_werkvorm3naam, " + ", ".join(f'"{n}"' for n in PLAIN_OUT) + ", "
       + ", ".join(f'array_to_string({sql}, \',\') AS "{n}"' for n, sql in OLD_LISTS.items()) + ", "
       + ", ".join(f'round(list_sum({sql}), 4) AS "{n}"' for n, sql in OLD_MINUTES.items())
       + """, period AS "UAS_Vak_Periode_start", einddatum AS "ACA_Einddatum", count_afgesloten AS unl_aantalgeslaagdeneindtoets FROM timetable""")
def job_timetable_workload_old(spark, sf_dir):
    out = _timetable(spark, sf_dir, "old")
    minutes = [F.round(F.aggregate(col(n), F.lit(0.0), lambda a, x: a + x), 4).alias(n) for n in OLD_MINUTES]
    return out.select("unl_werkvorm3naam", *cols(PLAIN_OUT), *[F.array_join(col(n).cast("array<string>"), ",").alias(n) for n in OLD_LISTS], *minutes,
                      "UAS_Vak_Periode_start", "ACA_Einddatum", "unl_aantalgeslaagdeneindtoets")


def payload_inputs(spark, sf_dir):
    """The form's own lists for the timetable's courses."""
    customer = table(spark, sf_dir, "customer")
    key = col("c_custkey")
    labels = table(spark, sf_dir, "orders").select((2021 + col("o_orderkey") % 3).cast("int").alias("y")).distinct()
    years = labels.select(F.concat(F.lit("J"), "y").alias("unl_collegejaarid"), F.concat("y", F.lit("-"), col("y") + 1).alias("unl_name"))
    programmes = customer.filter(col("c_mktsegment") != "HOUSEHOLD").select(
        F.concat(F.lit("O"), key).alias("unl_opleidingid"), key.cast("string").alias("unl_opleidingscodeisat"),
        F.concat(F.lit("M Programme "), 2021 + F.floor(key / 2) % 2, F.lit("-"), 2022 + F.floor(key / 2) % 2).alias("unl_name"))
    known = customer.filter(col("c_mktsegment") != "BUILDING").select(
        F.concat(F.lit("V"), key).alias("unl_vakcode"), F.concat(F.lit("id"), key).alias("unl_vakid"),
        F.concat(F.lit("J"), 2021 + key % 2).alias("_unl_jaar_value"))
    groups = customer.select(F.explode(F.array(F.lit(2020), F.lit(2021), F.lit(2022))).alias("UAS_Vak_Jaar"), key).select(
        F.concat(F.lit("V"), key).alias("Code"), "UAS_Vak_Jaar",
        F.when((key + col("UAS_Vak_Jaar")) % 3 == 0, (key % 5).cast("double")).alias("unl_vak_jaar_code"))
    return {"ref_academic_years": years, "ref_programmes": programmes, "ref_courses": known, "target_groups": groups}


COURSE_OUT = ["unl_vakcode", "unl_name", "unl_ecs", "unl_vakjaar", "unl_werkvorm1naam", "unl_werkvorm2naam", "unl_verplichtkeuze", "unl_taalvanvak",
              "unl_eindtoetsnaam", "unl_Jaar@odata.bind", "unl_Opleiding@odata.bind", "unl_startdatum", "weeks_diff", "unl_aantalgeslaagdeneindtoets",
              "UAS_Vak_Periode_start", "ACA_Einddatum"]


def _course_columns(lists: dict[str, str], minutes: dict[str, str]) -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """List cells that become one number, minutes that become hours, and the other numbers."""
    hours = {n: sql for n, sql in minutes.items() if n.endswith("urenperweekpergroep")}
    return lists, hours, {n: sql for n, sql in minutes.items() if n not in hours and not n.endswith("totaalcontacturen")}


def course_sql(edition: timetable.Variant, lists: dict[str, str], minutes: dict[str, str]) -> str:
    """The form's row of a course and year is its first one, so each list cell gives its first element."""
    lists, hours, rest = _course_columns(lists, minutes)
    slots, old = range(1, edition.slots + 1), edition.name == "old"
    codes = f"WHEN '{TRIP}' THEN 941790010 WHEN '{GUIDED}' THEN 941790004 WHEN '{UNGUIDED}' THEN 941790012"
    needed = " AND unl_startdatum IS NOT NULL AND count_afgesloten IS NOT NULL" if old else ""
    ids = "" if old else "CASE WHEN c_custkey IS NOT NULL THEN 'id' || c_custkey END AS unl_vakid,"
    id_join = "" if old else "LEFT JOIN customer ON 'V' || c_custkey = unl_vakcode AND c_mktsegment <> 'BUILDING' AND jaar = 2021 + c_custkey % 2"
    return "WITH " + timetable_sql(edition) + f""", bound AS (
    SELECT t.*, CAST(CASE unl_vakjaar WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 WHEN '4' THEN 941790000 WHEN 'Premaster' THEN 4 END AS DOUBLE) AS vakjaar,
           CASE WHEN c_custkey IS NOT NULL THEN 'unl_opleidings(O' || c_custkey || ')' END AS opl,
           CAST(substr(unl_jaar, 1, 4) AS INTEGER) AS jaar
    FROM timetable t LEFT JOIN customer ON c_custkey = "INS_Opleidingscode_actueel" AND c_mktsegment <> 'HOUSEHOLD'
      AND (2021 + c_custkey // 2 % 2) || '-' || (2022 + c_custkey // 2 % 2) = unl_jaar),
  filled AS (SELECT *, coalesce(opl, first_value(opl IGNORE NULLS) OVER (PARTITION BY unl_vakcode ORDER BY source_order NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS opl2 FROM bound),
  kept AS (SELECT * FROM filled WHERE opl2 IS NOT NULL{needed}),
  groups AS (
    SELECT 'V' || c_custkey AS code, y, CASE WHEN (c_custkey + y) % 3 = 0 THEN CAST(c_custkey % 5 AS DOUBLE) END AS c FROM customer, range(2021, 2023) r(y)),
  groups_filled AS (
    SELECT code, y, coalesce(c, lag(c) OVER (PARTITION BY code ORDER BY y), lead(c) OVER (PARTITION BY code ORDER BY y)) AS c FROM groups),
  repaired AS (
    SELECT *, coalesce(unl_eindtoetsnaam, lag(unl_eindtoetsnaam) OVER (PARTITION BY unl_vakcode, unl_name ORDER BY unl_jaar, source_order NULLS LAST)) AS exam,
           CASE WHEN unl_verplichtkeuze THEN 1 WHEN NOT unl_verplichtkeuze THEN 2 END AS keuze FROM kept)
  SELECT unl_vakcode, unl_name, unl_ecs, coalesce(vakjaar, c) AS unl_vakjaar,
         {", ".join(f"CAST(CASE unl_werkvorm{i}naam {codes} END AS INTEGER) AS unl_werkvorm{i}naam" for i in slots)},
         CAST(coalesce(keuze, lag(keuze) OVER (PARTITION BY unl_vakcode, unl_name ORDER BY unl_jaar, source_order NULLS LAST)) AS INTEGER) AS unl_verplichtkeuze,
         CAST(CASE unl_taalvanvak WHEN 'Nederlands (NL)' THEN 941790000 END AS INTEGER) AS unl_taalvanvak,
         CAST(CASE WHEN unl_ecs IS NOT NULL THEN coalesce(exam, 941790006) END AS INTEGER) AS unl_eindtoetsnaam,
         {", ".join(f'{sql}[1] AS "{n}"' for n, sql in lists.items())},
         {", ".join(f'round({sql}[1] / 60, 6) AS "{n}"' for n, sql in hours.items())},
         {", ".join(f'round({sql}[1], 6) AS "{n}"' for n, sql in rest.items())},
         unl_startdatum, weeks_diff, count_afgesloten AS unl_aantalgeslaagdeneindtoets, period AS "UAS_Vak_Periode_start", einddatum AS "ACA_Einddatum",
         {ids} 'unl_collegejaars(J' || jaar || ')' AS "unl_Jaar@odata.bind", opl2 AS "unl_Opleiding@odata.bind"
  FROM repaired LEFT JOIN groups_filled ON code = unl_vakcode AND y = jaar {id_join}"""


def _course_payload(spark, sf_dir, edition, lists, minutes, more):
    place = stages.Stages(scratch_path(spark, "timetable"))
    place.write(_timetable(spark, sf_dir, edition.name), "timetable", "prepare")
    rows = place.read(spark, "timetable", "send")
    out = payloads.course_payload({"timetable": rows, **payload_inputs(spark, sf_dir)}, edition.name)
    lists, hours, rest = _course_columns(lists, minutes)
    return out.select(*cols(COURSE_OUT), *more, *cols(list(lists)), *[F.round(col(n), 6).alias(n) for n in [*hours, *rest]])


@query(course_sql(timetable.NEW, LIST_OUT, MINUTES_OUT))
def job_payload_course(spark, sf_dir):
    return _course_payload(spark, sf_dir, timetable.NEW, LIST_OUT, MINUTES_OUT, ["unl_vakid"])


@query(course_sql(timetable.OLD, OLD_LISTS, OLD_MINUTES))
def job_payload_course_old(spark, sf_dir):
    return _course_payload(spark, sf_dir, timetable.OLD, OLD_LISTS, OLD_MINUTES, ["unl_werkvorm3naam"])
