"""The rules where the reporting scripts and plain Spark differ, row by row."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollbook.functions import arrays, conditions, numbers, strings
from rollbook.operators import columns, contains, joins, reshape, tables
from rollbook.plans.timetable import NEW, rank_forms, summarise, wide_forms


def values(df, *names):
    return sorted((tuple(r[n] for n in names or df.columns) for r in df.collect()), key=repr)


def one(spark, expression, **row):
    schema = ", ".join(f"{k} {v[0]}" for k, v in row.items())
    return spark.createDataFrame([tuple(v[1] for v in row.values())], schema).select(expression.alias("x")).first()["x"]


# joins ----------------------------------------------------------------------------------------

def test_missing_keys_match_in_joins(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "j int, r string")
    assert values(joins.left_join(left, right, ("k", "j")), "l", "r") == [("a", "x"), ("b", "y"), ("c", None)]
    assert values(joins.semi(left, right, ("k", "j")), "l") == [("a",), ("b",)]
    assert values(joins.anti(left, right, ("k", "j")), "l") == [("c",)]


def test_columns_on_both_sides_raise(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="both sides"):
        joins.left_join(df, df, "k")


def test_column_names_with_special_signs(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `unl_Jaar@odata.bind` int")
    other = spark.createDataFrame([(1, 5)], "`a.b` int, `S/t m` int")
    out = joins.left_join(df, other, "a.b")
    assert out.columns == ["a.b", "unl_Jaar@odata.bind", "S/t m"] and out.first()["S/t m"] == 5


def test_coalesce_prefers_the_side_asked_for(spark):
    left = spark.createDataFrame([(1, "l"), (2, None), (3, "l")], "k int, v string")
    right = spark.createDataFrame([(1, "r"), (2, "r")], "k int, v string")
    assert values(joins.left_join_coalesce(left, right, "k", ["v"], "right")) == [(1, "r"), (2, "r"), (3, "l")]
    assert values(joins.left_join_coalesce(left, right, "k", ["v"], "left")) == [(1, "l"), (2, "r"), (3, "l")]


@pytest.mark.parametrize("relationship", ["many-to-one", "one-to-one"])
def test_checked_join_fails_on_matched_repeats_only(spark, relationship):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    unmatched = spark.createDataFrame([(1, "x"), (9, "y"), (9, "z")], "k int, v string")
    assert values(joins.left_join_checked(left, unmatched, "k", relationship)) == [(1, "x"), (2, None)]
    matched = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="several right rows"):
        # no column of the right side is read: the check must hold all the same
        joins.left_join_checked(left, matched, "k", relationship).select("k").collect()


def test_one_to_one_fails_on_repeated_left_rows(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d")], "k int, l string")
    right = spark.createDataFrame([(3, "x")], "k int, v string")
    assert joins.left_join_checked(left, right, "k", "one-to-one").count() == 4
    assert joins.left_join_checked(left, spark.createDataFrame([(1, "x")], "k int, v string"), "k").count() == 4
    with pytest.raises(Exception, match="several left rows"):
        joins.left_join_checked(left, spark.createDataFrame([(1, "x")], "k int, v string"), "k", "one-to-one").collect()


def test_lookups(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("B ",)], "k string")
    ref = spark.createDataFrame([("a", "2"), ("a", "1"), (None, "9"), ("B ", "3")], "name string, id string")
    assert values(joins.lookup_reference(df, ref, ("k", "name"), "id", "set", "bind")) == [
        ("B ", "set(3)"), ("a", "set(1)"), ("b", None), (None, None)]
    either = joins.lookup_either_key(df, ref, "k", [F.lower(F.trim("name")), F.col("name")], "id", "set", "bind")
    assert values(either) == [("B ", "set(3)"), ("a", "set(1)"), ("b", "set(3)"), (None, None)]


def test_reconcile(spark):
    ours = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, n int")
    theirs = spark.createDataFrame([("a", 1), ("b", 5), ("c", None)], "name string, m int")
    out = joins.reconcile(ours, theirs, ("k", "name"), [("n", "m")])
    assert values(out, "k", "n_equal", "n_difference") == [("a", True, 0), ("b", False, -3), ("c", None, None)]
    safe = joins.reconcile(ours, theirs, ("k", "name"), [("n", "m")], null_safe=True)
    assert values(safe, "n_equal") == [(False,), (True,), (True,)]


def test_contained_names(spark, plan_of):
    needles = spark.createDataFrame([("RECHTEN",), ("KUNST",), ("",), ("RECHT",), (None,)], "n string")
    names = spark.createDataFrame([("M RECHTEN 2021",), ("B ARTS",), (None,), ("KUN ST",)], "t string")
    kept = contains.keep_contained(needles, "n", names, "t")
    assert values(kept) == [("RECHT",), ("RECHTEN",)]
    out = contains.replace_by_contained(names, "t", needles, "n", "c")
    assert values(out, "c") == [("B ARTS",), ("KUN ST",), ("RECHT",), (None,)]
    for plan in (plan_of(kept), plan_of(out)):
        assert "NestedLoop" not in plan and "Cartesian" not in plan


# conditions and aggregates ------------------------------------------------------------------

def test_missing_values_in_conditions(spark):
    c = F.col("c")
    assert one(spark, conditions.is_in(c, ["a"]), c=("string", None)) is False
    assert one(spark, conditions.if_else(c, F.lit(1), F.lit(2)), c=("boolean", None)) is None
    assert one(spark, conditions.band(c, {"low": ["1"]}, "other"), c=("string", None)) == "other"
    assert one(spark, conditions.yes_no_code(c), c=("boolean", None)) is None
    assert one(spark, conditions.recode(c, [("a", 1), ("a", 2)]), c=("string", "a")) == 1
    assert one(spark, conditions.code_of(c, {"a": 1}), c=("string", "b")) is None
    assert one(spark, numbers.clamp_negative(c), c=("double", None)) is None
    assert one(spark, conditions.fill_empty_text(c, F.lit(7)), c=("string", "")) == "7"


def test_aggregates_with_missing_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 2.0), ("c", None)], "g string, x double")
    out = df.groupBy("g").agg(conditions.strict_sum(F.col("x")).alias("strict"), conditions.sum_present(F.col("x")).alias("present"),
                              conditions.count_distinct_with_missing(F.col("x")).alias("n"))
    assert values(out) == [("a", None, 1.0, 2), ("b", 4.0, 4.0, 1), ("c", None, 0.0, 1)]


def test_sort_puts_missing_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert [r["x"] for r in tables.sort_rows(df, ["x"]).collect()] == [1, 2, None]
    assert [r["x"] for r in tables.sort_rows(df, ["-x"]).collect()] == [2, 1, None]


def test_frequency_and_repeats(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "x string")
    assert values(tables.frequency_table(df, "x")) == [("a", 2, 0.5), ("b", 1, 0.25), (None, 1, 0.25)]
    assert values(tables.repeated_keys(df, ["x"])) == [("a", 2)]


def test_group_relative_rule(spark):
    rows = [("g", 2020, "now"), ("g", 2021, "now"), ("g", 2019, "prev"), (None, 2020, "now")]
    df = spark.createDataFrame(rows, "k string, jaar int, label string")
    kept = tables.keep_label_or_latest(df, ["k"], "jaar", "label", "prev", "now")
    assert values(kept) == [("g", 2019, "prev"), ("g", 2021, "now"), (None, 2020, "now")]


# text and numbers ---------------------------------------------------------------------------

@pytest.mark.parametrize("text,plain", [("Économie & Größe", "Economie & Grosse"), ("œuvre Ærø", "oeuvre AEro"), ("été", "ete"),
                                        ("“a” – b…", '"a" - b...'), ("Łódź Šimić ồ", "Lodz Simic o"), (None, None)])
def test_ascii(spark, text, plain):
    assert one(spark, strings.to_ascii(F.col("c")), c=("string", text)) == plain


@pytest.mark.parametrize("text,number", [("EUR 1,234.50 x", 1234.5), ("-3", -3.0), ("none", None), ("2021-2022", 2021.0), (None, None)])
def test_parse_number(spark, text, number):
    assert one(spark, strings.parse_number(F.col("c")), c=("string", text)) == number


def test_text_rules(spark):
    c = F.col("c")
    assert one(spark, strings.replace_first(c, "a", "$1\\"), c=("string", "\nbanana")) == "\nb$1\\nana"
    assert one(spark, strings.replace_first(c, "^b", "x"), c=("string", "bab")) == "xab"
    assert one(spark, strings.trim_all(c), c=("string", "\u00a0\t a b\u2003\r\n")) == "a b"
    assert one(spark, strings.extract(c, "[^/]+$"), c=("string", "a/b/005")) == "005"
    assert one(spark, strings.extract(c, "z"), c=("string", "a")) is None
    assert one(spark, strings.paste(c, F.lit(1), sep=" - "), c=("string", None)) == "NA - 1"
    assert one(spark, strings.clean_entity_name(c, "inst", {"acta": "thk"}), c=("string", "INST - ACTA ")) == "thk"
    assert one(spark, strings.clean_entity_name(c, "inst", {"acta": "thk"}), c=("string", "acta x")) == "acta x"
    assert one(spark, strings.parse_european_number(c), c=("string", "1.234,5")) == 1234.5
    assert one(spark, strings.format_european_number(c), c=("double", 1234.5)) == "1234,5"
    assert one(spark, strings.format_european_number(c), c=("double", 120000000.0)) == "120000000"
    assert one(spark, strings.format_european_number(c), c=("double", -12345678.25)) == "-12345678,25"
    assert one(spark, numbers.round_half_even(c), c=("double", 2.5)) == 2.0
    assert one(spark, numbers.key_text(c), c=("double", 56604.0)) == "56604"
    assert one(spark, numbers.to_number(c), c=("string", "abc")) is None
    assert one(spark, numbers.academic_year(c), c=("double", 2021.0)) == "2021-2022"


def test_list_functions(spark):
    c = F.col("c")
    assert one(spark, arrays.list_mean(c), c=("array<double>", [])) is None
    assert one(spark, arrays.list_mean(c), c=("array<double>", [1.0, None])) is None
    assert one(spark, arrays.list_mean(c), c=("array<double>", [1.0, 2.0])) == 1.5
    assert one(spark, arrays.is_empty_list(c), c=("array<double>", None)) is True


# columns ------------------------------------------------------------------------------------

def test_repair_names():
    assert columns.repair_names(["a", "a", "a.1", "2 x", "b (c)", "a"]) == ["a", "a.2", "a.1", "X2.x", "b..c.", "a.3"]


def test_renaming_through_documentation(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    naming = spark.createDataFrame([("a", "x"), ("z", "y")], "`from` string, `to` string")
    assert columns.rename_by_documentation(df, naming).columns == ["x", "b", "c"]
    with pytest.raises(ValueError, match="one name"):
        columns.rename_by_documentation(df, {"a": "x", "b": "x"})
    with pytest.raises(ValueError, match="several names"):
        columns.rename_by_documentation(df, naming.union(spark.createDataFrame([("a", "w")], "f string, t string")))


def test_columns_with_values_and_clearing(spark):
    df = spark.createDataFrame([("n", [], None), ("n", [1], None), (None, None, None)], "name string, a array<int>, b array<int>")
    assert values(columns.columns_with_values(df)) == [("a", True), ("b", False), ("name", True)]
    assert values(columns.clear_if_all_empty(df, "name", ["a", "b"]), "name") == [("n",), (None,), (None,)]


# reshaping ----------------------------------------------------------------------------------

def test_unite_and_pivots(spark):
    df = spark.createDataFrame([("f", "B", None, 1), ("f", "B", "NL", 2), ("g", "M", "NL", 3)], "fac string, p string, o string, n int")
    united = reshape.unite(df, "label", ["p", "o"])
    assert values(united, "label") == [("B-NA",), ("B-NL",), ("M-NL",)]
    wide = reshape.pivot_wide(united, ["fac"], "label", "n", ["B-NL", "M-NL", "S-NL"], fill=0, others="drop")
    assert values(wide) == [("f", 2, 0, 0), ("g", 0, 3, 0)]
    counted = reshape.pivot_count(united, ["fac"], F.col("label"), ["B-NL"], total="total")
    assert values(counted) == [("f", 1, 2), ("g", 0, 1)]
    with pytest.raises(Exception, match="several rows for one cell"):
        reshape.pivot_wide(df, ["fac"], "p", "n", ["B", "M"]).collect()


def test_pivot_lists(spark):
    df = spark.createDataFrame([("m", "b", 2), ("m", "a", 1), ("m", "z", 5), ("k", "z", 6)], "id string, t string, v int")
    wide = reshape.pivot_wide_lists(df, ["id"], "t", {"ab": ["b", "a"], "z": ["z"]}, ["v"])
    assert values(wide) == [("k", None, [6]), ("m", [1, 2], [5])]


def test_long_forms_split_at_the_last_underscore(spark):
    df = spark.createDataFrame([(1, 10, None, 5)], "id int, n_groups_A int, n_groups_B int, load_A int")
    long = reshape.pivot_long_values(df, ["n_groups_A", "n_groups_B", "load_A"], "form")
    assert values(long, "id", "form", "n_groups", "load") == [(1, "A", 10, 5), (1, "B", None, None)]
    assert values(reshape.pivot_long(df, ["n_groups_A", "n_groups_B"], "k", "v"), "k", "v") == [("n_groups_A", 10), ("n_groups_B", None)]


def test_unnest_parallel(spark):
    rows = [(1, [1], [7, 8]), (2, None, [5, 6]), (3, None, None), (4, [], []), (5, [1, 2], [None, 3])]
    df = spark.createDataFrame(rows, "id int, a array<int>, b array<int>")
    assert values(reshape.unnest_parallel(df, ["a", "b"])) == [
        (1, 1, 7), (1, 1, 8), (2, None, 5), (2, None, 6), (5, 1, None), (5, 2, 3)]
    bad = spark.createDataFrame([(1, [1, 2], [1, 2, 3])], df.schema)
    with pytest.raises(Exception, match="different lengths"):
        reshape.unnest_parallel(bad, ["a", "b"]).collect()
    assert values(reshape.unnest_parallel(bad, ["a", "b"], unequal="null")) == [(1, 1, 1), (1, 2, 2), (1, None, 3)]
    with pytest.raises(ValueError):
        reshape.unnest_parallel(bad, ["a"], unequal="cut")


def test_first_of_lists_is_the_first_unnested_row(spark):
    rows = [(1, [1], [7, 8]), (2, None, [5, 6, 7]), (3, None, None), (4, [], []), (5, [1, 2], [None, 3, 4])]
    df = spark.createDataFrame(rows, "id int, a array<int>, b array<int>")
    unnested = reshape.unnest_parallel(df, ["a", "b"], "i", unequal="null").filter("i = 1").drop("i")
    assert values(reshape.first_of_lists(df, ["a", "b"])) == values(unnested) == [(1, 1, 7), (2, None, 5), (5, 1, None)]


def test_labelled_cells(spark):
    """Three class types and two lab types in a row; a measure that one label lacks does not move another label's value up."""
    rows = [(1, "lecture", 1, 10), (1, "seminar", None, 20), (1, "talk", 3, 30), (1, "lab", 4, None), (1, "field", 5, 50),
            (2, "lab", 6, 60), (3, None, 7, 70)]
    df = spark.createDataFrame(rows, "id int, label string, n int, load int")
    groups = {"class": ["talk", "seminar", "lecture"], "practice": ["lab", "field"]}
    wide = reshape.pivot_wide_labelled(df, ["id"], "label", groups, ["n", "load"])
    held = {r["id"]: r for r in wide.collect()}
    assert [tuple(x) for x in held[1]["n_class"]] == [("lecture", 1), ("seminar", None), ("talk", 3)] and held[2]["n_class"] is None
    out = reshape.unnest_labelled(wide, {g: [f"n_{g}", f"load_{g}"] for g in groups})
    assert values(out, "id", "class", "n_class", "load_class", "practice", "n_practice", "load_practice") == [
        (1, "lecture", 1, 10, "field", 5, 50), (1, "seminar", None, 20, "lab", 4, None), (1, "talk", 3, 30, None, None, None),
        (2, None, None, None, "lab", 6, 60)]
    again = df.union(df.filter("label = 'lab'"))
    with pytest.raises(Exception, match="several rows"):
        reshape.pivot_wide_labelled(again, ["id"], "label", groups, ["n"]).collect()
    with pytest.raises(Exception, match="not listed"):
        reshape.pivot_wide_labelled(df, ["id"], "label", {"class": ["talk"]}, ["n"]).collect()
    assert reshape.unnest_labelled(wide.limit(0), {"class": ["n_class"]}).count() == 0


def test_labels_that_only_one_cell_has(spark):
    cell = "array<struct<label:string,value:int>>"
    df = spark.createDataFrame([(1, [("a", 1), ("c", 3)], [("b", 2), ("b", 9)]), (2, [], None)], f"id int, x {cell}, y {cell}")
    assert values(reshape.unnest_labelled(df, {"k": ["x", "y"]}), "id", "k", "x", "y") == [(1, "a", 1, None), (1, "b", None, 2), (1, "c", 3, None)]


# timetable ----------------------------------------------------------------------------------

def activities(spark, rows):
    return spark.createDataFrame(rows, "ter_source_file string, ter_module_code string, ter_type string, ter_student_groups array<string>, "
                                       "ter_events array<struct<week:int,activityDurationMins:double>>, unl_jaar string")


def test_workload_both_editions(spark):
    rows = [("f", "m", "Lecture", ["g1"], [(1, 60.0), (2, 60.0)], "y"), ("f", "m", "Lecture", None, [(2, 120.0)], "y"),
            ("f", "m", "Lecture", ["g1"], [], "y"), ("f", "m", "Hoorcollege", ["g"], [(None, 30.0)], "y")]
    new = summarise(activities(spark, rows), NEW)
    # 240 minutes, weeks {1, 2}, groups {g1, missing}; a load over no known week is missing
    assert values(new, "ter_type", "n_groups", "n_weeks", "minutes_per_group_week", "contact_hours") == [
        ("Hoorcollege", 1, 0, None, 0.5), ("Lecture", 2, 2, 60.0, 4.0)]
    old = tables.workload(spark.createDataFrame([("m", "g", [1, 2], [60.0, 60.0]), ("m", "h", [2], [120.0])],
                                                "k string, g string, w array<int>, d array<double>"), ["k"], "g", "w", "d", "old")
    assert values(old) == [("m", 2, 2, 90.0, 4.5)]


def test_forms_are_ranked_by_weekly_minutes(spark):
    rows = [("f", "m", "Excursie", ["g"], [(1, 90.0)], "y"), ("f", "m", "Veldwerk", ["g"], [(1, 10.0)], "y"),
            ("f", "m", "Studiegroep", ["g"], [(1, 30.0)], "y"), ("f", "k", "Hoorcollege", ["g"], [(1, 30.0)], "y")]
    wide = rank_forms(wide_forms(summarise(activities(spark, rows), NEW), NEW), NEW)
    got = {r["ter_module_code"]: r for r in wide.collect()}
    assert got["m"]["name_form1"] == "Excursie" and got["m"]["name_form2"].startswith("Groepsopdracht")
    assert got["m"]["minutes_per_group_week_Excursie"] == [90.0, 10.0] and got["k"]["name_form1"] is None


def test_dates(spark):
    day = dt.date(2021, 9, 1)
    df = spark.createDataFrame([(3, day), (2, day)], "p int, d date")
    out = df.select(numbers.add_days_where(F.col("d"), F.col("p") == 3, 14).alias("d"))
    assert values(out) == [(day,), (day + dt.timedelta(14),)]


def test_pivots_raise_for_labels_that_are_not_listed(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3), (2, None, 4)], "id int, label string, v int")
    with pytest.raises(Exception, match="not listed"):
        reshape.pivot_wide(df, ["id"], "label", "v", ["a", "b"]).collect()
    with pytest.raises(Exception, match="not listed"):
        reshape.pivot_wide_values(df, ["id"], "label", ["v"], ["a", "b"]).collect()
    with pytest.raises(Exception, match="not listed"):
        reshape.pivot_wide_lists(df, ["id"], "label", {"x": ["a", "b"]}, ["v"]).collect()
    kept = reshape.pivot_wide(df, ["id"], "label", "v", ["a", "b"], others="drop")
    assert sorted(map(tuple, kept.collect())) == [(1, 1, 2), (2, None, None)]
    assert reshape.pivot_wide(df, ["id"], "label", "v", ["a", "b", "c"]).count() == 2


# contained names ----------------------------------------------------------------------------

def test_contained_names_against_all_pairs(spark):
    import random
    dice = random.Random(5)
    names = ["".join(dice.choice("abcé😀 ") for _ in range(dice.randrange(30))) for _ in range(200)] + [None, "", "a" * 3000]
    needles = [n[i:i + dice.randrange(1, 14)] for n in names if n for i in [dice.randrange(len(n))]] + ["zz", "abcabcabcabc", "", None, "a" * 2000]
    held = spark.createDataFrame([(n,) for n in names], "name string")
    wanted = spark.createDataFrame([(n,) for n in needles], "needle string")
    expected = sorted(n for n in needles if n and any(m and n in m for m in names))
    assert sorted(r[0] for r in contains.keep_contained(wanted, "needle", held, "name").collect()) == expected
    got = contains.replace_by_contained(held, "name", wanted, "needle", "out").collect()
    assert len(got) == len(names)
    for r in got:
        found = [n for n in needles if n and r["name"] and n in r["name"]]
        assert r["out"] == (min(found, key=lambda n: n.encode()) if found else r["name"])


def test_names_are_spread_to_lengths_that_occur_only(spark):
    names = spark.createDataFrame([(f"programme number {i}",) for i in range(20)], "name string")
    long = spark.createDataFrame([("number 1",), ("programme number 7",)], "needle string")
    wanted = contains._needles(long, "needle")
    spread = contains.spread_names(names, "name", wanted)
    assert {r[0] for r in spread.select("__size").distinct().collect()} == {8}
    assert spread.count() <= sum(len(f"programme number {i}") - 7 for i in range(20))
    # the run that few names have stands for the long needle
    anchors = {r["__piece"]: r["__run"] for r in contains._anchors(wanted, spread).collect()}
    assert anchors == {"number 1": "number 1", "programme number 7": "number 7"}
    assert contains.spread_names(names, "name", contains._needles(long.limit(0), "needle")).count() == 0


def test_a_needle_of_one_letter_is_known_without_pairs(spark, plan_of):
    names = spark.createDataFrame([(f"e{i}",) for i in range(50)], "name string")
    needles = spark.createDataFrame([("e",), ("x",)], "needle string")
    wanted = contains._needles(needles, "needle")
    spread = contains.spread_names(names, "name", wanted)
    assert contains._pairs(spread, contains._anchors(wanted, spread).filter("__run <> __piece")).count() == 0
    assert [r[0] for r in contains.keep_contained(needles, "needle", names, "name").collect()] == ["e"]
