"""Sources and sinks on files written by hand."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F, types as T

from rollbook.session import scratch_path, shared_folder
from rollbook.sinks import commits, keyed, payloads, tables
from rollbook.sources import delimited, encoding, files, nested, splits, stages, zips

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("amount", T.DoubleType())])


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


@pytest.mark.parametrize("split_bytes", [7, 64, 8000, 1 << 20])
def test_preamble_is_dropped_once_per_file_also_when_split(spark, tmp_path, monkeypatch, split_bytes):
    n = 40 if split_bytes == 7 else 2000
    monkeypatch.setattr(splits, "MOST_TASKS", 50)
    expected = set()
    for year in (2021, 2022):
        body = "".join(f'"n{i}, x","1,0{i % 10}0.5"\r\n' for i in range(n))
        expected |= {(year, f"n{i}, x", 1000.5 + 10 * (i % 10)) for i in range(n)}
        write(tmp_path / f"REPORT_PLAN SBE+ {year}.csv", "title\r\nfilter,1\r\n\r\nx\r\n" + body)
    rows = delimited.read_csv_after(spark, str(tmp_path), 4, SCHEMA, split_bytes=split_bytes)
    name = files.export_name(F.col("source_file"))
    got = rows.select(files.name_part(name, r"\d{4}").cast("int").alias("y"), "name", "amount", name.alias("file"),
                      files.name_part(name, r"\b[A-Za-z]{3,4}\b").alias("fac"), *delimited.SOURCE_ORDER).collect()
    assert {(r["y"], r["name"], r["amount"]) for r in got} == expected and len(got) == 2 * n
    assert {(r["file"], r["fac"]) for r in got} == {(f"REPORT_PLAN SBE+ {y}.csv", "SBE") for y in (2021, 2022)}
    ordered = sorted((r for r in got if "2021" in r["source_file"]), key=lambda r: [r[c] for c in delimited.SOURCE_ORDER])
    assert [r["name"] for r in ordered] == [f"n{i}, x" for i in range(n)]
    text = (tmp_path / "REPORT_PLAN SBE+ 2021.csv").read_bytes()
    assert all(text[r["source_offset"]:].startswith(f'"{r["name"]}"'.encode()) for r in ordered[:50])


def test_one_scan_reads_the_exports(spark, tmp_path, plan_of):
    write(tmp_path / "a.csv", "x\n1,2\n" * 100)
    plan = plan_of(delimited.read_csv_after(spark, str(tmp_path), 1, SCHEMA))
    assert plan.count("FileScan") == 1 and "Union" not in plan and "ReadSchema: struct<path:string,length:bigint>" in plan


def test_odd_files(spark, tmp_path):
    """Lines above the data beyond the first splits, files shorter than that, no line feed at the end, empty lines, empty files."""
    import gzip
    write(tmp_path / "long.csv", "x" * 500 + "\n" + "y" * 300 + "\na\n\nb\n" + "c" * 100)
    write(tmp_path / "short.csv", "title\n")
    write(tmp_path / "one.csv", "title\nno feed")
    write(tmp_path / "empty.csv", "")
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress(b"1\n2\nd\r\ne"))
    for size in (1, 5, 100, 10_000):
        got = splits.read_lines(spark, str(tmp_path), 2, split_bytes=size).collect()
        assert sorted((r["source_file"].split("/")[-1], r["source_offset"], r["value"]) for r in got) == [
            ("long.csv", 802, "a"), ("long.csv", 804, ""), ("long.csv", 805, "b"), ("long.csv", 807, "c" * 100), ("packed.csv.gz", 4, "d"), ("packed.csv.gz", 7, "e")]
        assert splits.read_lines(spark, str(tmp_path), 0, split_bytes=size).count() == 6 + 1 + 2 + 4


def test_file_without_faculty_or_year(spark, tmp_path):
    write(tmp_path / "X.csv", "a\nv,1\n")
    row = delimited.read_csv_after(spark, str(tmp_path), 1, SCHEMA).select(
        files.name_part(files.export_name(F.col("source_file")), r"\d{4}").alias("y")).first()
    assert row["y"] is None


def test_bad_values_and_na_words_become_missing(spark):
    lines = spark.createDataFrame([("a,1.5",), ("#,x",), ("NA,",), ("b",)], "value string")
    out = delimited.parse_lines(lines, SCHEMA, na=["", "NA", "#"])
    assert [tuple(r) for r in out.collect()] == [("a", 1.5), (None, None), (None, None), ("b", None)]


def test_zip_files_with_blanks_in_the_name(spark, tmp_path):
    for n in (1, 2):
        with zipfile.ZipFile(tmp_path / f"delivery {n} 2024-01-0{n}.zip", "w") as z:
            z.writestr("data.csv", "name;amount\n" + "".join(f"é{n}-{i};{'#' if i == 0 else i}\n" for i in range(30_000)))
    out = delimited.read_zip_csv(spark, str(tmp_path), SCHEMA, sep=";")
    assert out.count() == 60_000 and out.filter("amount IS NULL").count() == 2
    assert out.filter("name LIKE 'é1-%'").agg(F.sum("amount")).first()[0] == sum(range(30_000))


def test_members_of_one_archive_go_to_many_tasks(spark, tmp_path):
    kinds = [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA]
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as z:
        z.writestr("folder/", "")
        for n in range(40):
            z.writestr(f"folder/m{n}.csv", "".join(f"{n},{i}\n" for i in range(n * 20)), kinds[n % 4])
    lines = zips.read_zip_lines(spark, str(tmp_path), task_bytes=200)
    tasks = lines.groupBy(F.spark_partition_id().alias("t")).agg(F.countDistinct("source_member").alias("n")).collect()
    assert len(tasks) > 10 and sum(t["n"] for t in tasks) == 39
    got = lines.groupBy("source_member").agg(F.count(F.lit(1)).alias("n"), F.max("source_line").alias("last")).collect()
    assert {(r["source_member"], r["n"], r["last"]) for r in got} == {(f"folder/m{n}.csv", n * 20, n * 20 - 1) for n in range(1, 40)}
    assert zips.list_members(spark, str(tmp_path)).count() == 40


def test_damaged_members_raise(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a.csv", "abcdefgh\n" * 10)
    data = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "a.zip").write_bytes(data.replace(b"abcdefgh", b"abcdefgX", 1))
    with pytest.raises(Exception, match="CRC"):
        zips.read_zip_lines(spark, str(tmp_path)).collect()


def test_mixed_encodings(spark, tmp_path):
    """UTF-8, Latin-1, Windows signs, and UTF-8 that was taken for Latin-1 before, in one file."""
    lines = [b"naam;bedrag", "Caf\xe9 \u20ac;1,5".encode(), "Caf\xe9 \u20ac;2,5".encode("cp1252"), "Caf\xe9;3,5".encode().decode("cp1252").encode(), b"plain;4,5"]
    (tmp_path / "a.csv").write_bytes(b"\n".join(lines) + b"\n")
    schema = T.StructType([T.StructField("naam", T.StringType()), T.StructField("bedrag", T.DoubleType())])
    got = delimited.read_european_csv(spark, str(tmp_path), schema, repair=True).orderBy("bedrag").collect()
    assert [r["naam"] for r in got] == ["Caf\xe9 \u20ac", "Caf\xe9 \u20ac", "Caf\xe9", "plain"]
    values = [r["value"] for r in splits.read_lines(spark, str(tmp_path), 1, repair=True).orderBy("source_offset").collect()]
    assert values == ["Caf\xe9 \u20ac;1,5", "Caf\xe9 \u20ac;2,5", "Caf\xe9;3,5", "plain;4,5"]


def test_repair_leaves_right_texts_alone(spark):
    rows = [("Caf\xe9",), ("na\xefve \xc3",), ("\u65e5\u672c \xc3\xa9",), ("\u20ac 5",), ("",), (None,), ("Caf\xc3\xa9",), ("\xe2\u201a\xac 5",), ("\xc3\xa9 \xe9",)]
    df = spark.createDataFrame(rows, "t string").select("t", encoding.repair_encoding(F.col("t")).alias("r"))
    changed = {r["t"]: r["r"] for r in df.collect() if r["t"] != r["r"]}
    assert changed == {"Caf\xc3\xa9": "Caf\xe9", "\xe2\u201a\xac 5": "\u20ac 5"}


def test_latest_snapshot_by_date_in_name(spark, tmp_path):
    for day in ("2023-12-31", "20240115", "2024-01-02"):
        write(tmp_path / f"export {day}.csv", "x")
    write(tmp_path / "export latest.csv", "x")
    assert files.latest_path(files.list_files(spark, str(tmp_path), "^export")).endswith("export 20240115.csv")
    with pytest.raises(FileNotFoundError):
        files.latest_path(files.list_files(spark, str(tmp_path), "latest"))


def test_european_csv(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "naam;bedrag\n Caf\xe9 ;1.234,5\nx;\n", "latin1")
    schema = T.StructType([T.StructField("naam", T.StringType()), T.StructField("bedrag", T.DoubleType())])
    got = delimited.read_european_csv(spark, str(tmp_path / "in"), schema, "ISO-8859-1")
    assert [tuple(r) for r in got.collect()] == [("Café", 1234.5), ("x", None)]
    delimited.write_european_csv(got, str(tmp_path / "out"))
    assert "Café;1234,5" in "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))


def test_json_pages(spark, tmp_path):
    page = {"value": [{"@odata.etag": "W/1", "unl_id": "1", "_unl_y_value": "a", "x": 1}, {"unl_id": "2"}], "@odata.nextLink": "n"}
    write(tmp_path / "1.json", json.dumps(page, indent=2))
    write(tmp_path / "2.json", json.dumps({"value": []}))
    record = T.StructType([T.StructField(n, T.StringType()) for n in ("@odata.etag", "unl_id", "_unl_y_value", "x")])
    got = nested.read_json_pages(spark, str(tmp_path), record)
    assert got.columns == ["unl_id", "_unl_y_value"]
    assert sorted(map(tuple, got.collect()), key=repr) == [("1", "a"), ("2", None)]


RECORD = T.StructType([T.StructField("unl_id", T.StringType()), T.StructField("x", T.StringType())])


def land_pages(folder, links, records=2):
    for i, (asked, following) in enumerate(links):
        page = {"asked": asked, "value": [{"unl_id": f"{asked}{r}", "x": "-"} for r in range(records)], "@odata.nextLink": following}
        write(folder / f"{i}.json", json.dumps(page))


def test_pages_are_followed_in_the_order_of_the_links(spark, tmp_path):
    names = [f"p{(i * 7) % 23}" for i in range(23)]
    land_pages(tmp_path, sorted(zip(names, [*names[1:], None])))
    got = nested.read_json_pages(spark, str(tmp_path), RECORD, address="asked", place=True)
    assert got.columns == ["page", "page_row", "unl_id"]
    assert [r["unl_id"] for r in got.orderBy("page", "page_row").collect()] == [f"{n}{r}" for n in names for r in range(2)]
    assert nested.read_json_pages(spark, str(tmp_path), RECORD, address="asked").count() == 46


@pytest.mark.parametrize("links, wrong", [
    ([("a", "b"), ("b", "c")], "c is missing"), ([("a", "b"), ("c", None)], "b is missing"),
    ([("a", "b"), ("b", None), ("b", None)], "b is there twice"), ([("a", "b"), ("b", "a")], "cycle"),
    ([("a", "b"), ("b", "a"), ("c", None)], "cycle"), ([("a", None), ("b", None)], "chains"), ([("a", "c"), ("b", "c"), ("c", None)], "chains"),
    ([(None, None)], "no address")])
def test_a_landing_that_lacks_or_repeats_a_page_raises(spark, tmp_path, links, wrong):
    land_pages(tmp_path, links)
    with pytest.raises(ValueError, match=wrong):
        nested.read_json_pages(spark, str(tmp_path), RECORD, address="asked")


def test_chains_of_one_page_and_none(spark, tmp_path):
    land_pages(tmp_path, [("a", None)])
    assert [tuple(r) for r in nested.read_json_pages(spark, str(tmp_path), RECORD, address="asked", place=True).collect()] == [(0, 0, "a0"), (0, 1, "a1")]
    assert nested.chain_positions(spark.createDataFrame([], "node string, next string")).count() == 0
    with pytest.raises(ValueError, match="no order"):
        nested.read_json_pages(spark, str(tmp_path), RECORD, place=True)


def test_stages_and_empty_tables(spark, tmp_path):
    place = stages.Stages(str(tmp_path))
    df = spark.range(3)
    place.write(df, "d", "read", formats=("parquet", "csv"))
    assert place.read(spark, "d", "prepare").count() == 3
    place.write(df, "d", "read", folder="elsewhere")
    assert place.read(spark, "d", "send", folder="elsewhere").count() == 3
    place.write(df.limit(0), "none", "read")
    with pytest.raises(ValueError, match="no rows"):
        stages.read_parquet(spark, place.path("none", "read"), ["id"])
    for bad in (("", "c", "n"), ("s", "", "n"), ("s", "c", "")):
        with pytest.raises(ValueError):
            tables.write_to_store(df, *bad)


def test_activity_files(spark):
    rows = [("raw/activities_2021.rds",), ("activities_2022.csv",), (None,)]
    got = nested.keep_activity_files(spark.createDataFrame(rows, "ter_source_file string")).collect()
    assert [(r["jaar"], r["unl_jaar"]) for r in got] == [(2021, "2021-2022")]


def test_payload_leaves_out_missing_values(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 3.5, None)], "k int, `a.b` double, `unl_Jaar@odata.bind` string")
    bodies = {r["k"]: json.loads(r["body"]) for r in payloads.row_payloads(df, ["k"]).collect()}
    assert bodies == {1: {"unl_Jaar@odata.bind": "x"}, 2: {"a.b": 3.5}}


def test_sending_goes_on_after_errors_and_resumes(spark, tmp_path):
    sent = str(tmp_path / "sent.txt")
    broken = str(tmp_path / "broken")

    def sender(body):
        import os
        with open(sent, "a") as f:
            f.write(body + "\n")
        if '"k":2' in body and os.path.exists(broken):
            raise RuntimeError("refused")
        return 204, "ok"

    write(tmp_path / "broken", "")
    bodies = spark.createDataFrame([(i, i) for i in range(4)], "id int, k int").transform(lambda d: payloads.row_payloads(d, ["id"]))
    path = str(tmp_path / "results")
    first = payloads.send_payloads(bodies, "id", sender, path)
    assert sorted((r["id"], r["status"]) for r in first.collect()) == [("0", "204"), ("1", "204"), ("2", "Error"), ("3", "204")]
    (tmp_path / "broken").unlink()
    second = payloads.send_payloads(bodies, "id", sender, path)
    assert ("2", "204", "ok") in {tuple(r) for r in second.collect()}
    assert len(open(sent).read().split()) == 5


def test_a_task_that_fails_after_sending_sends_no_good_row_twice(spark, tmp_path):
    """One body ends its task in the middle of a batch; the job fails, and the next call sends the rest."""
    sent, broken = str(tmp_path / "sent.txt"), str(tmp_path / "broken")

    def sender(body):
        import os
        if '"k":17}' in body and os.path.exists(broken):
            raise KeyboardInterrupt("lost")
        with open(sent, "a") as f:
            f.write(body + "\n")
        return 204, "ok"

    write(tmp_path / "broken", "")
    bodies = payloads.row_payloads(spark.range(60).select("id", F.col("id").alias("k")), ["id"])
    bodies = bodies.union(bodies.filter("id = 3"))
    path = str(tmp_path / "ledger")
    with pytest.raises(Exception):
        payloads.send_payloads(bodies, "id", sender, path, batch_rows=7)
    before = open(sent).read().split() if os.path.exists(sent) else []
    assert '{"k":17}' not in before
    (tmp_path / "broken").unlink()
    done = payloads.send_payloads(bodies, "id", sender, path, batch_rows=7)
    lines = open(sent).read().split()
    assert len(lines) == len(set(lines)) == 60 and done.filter("status = '204'").count() == 60


def test_a_batch_that_is_in_the_ledger_is_not_sent_again(spark, tmp_path):
    """What a task does that Spark runs again: the same rows, the same attempt."""
    import pyarrow as pa
    sent = []
    send = payloads._send(lambda body: (sent.append(body) or 200, "ok"), "id", str(tmp_path / "l"), 0)
    rows = pa.RecordBatch.from_arrays([pa.array([0, 0, 1], pa.int64()), pa.array(["a", "b", "c"]), pa.array(["A", "B", "C"])], names=["batch", "key", "body"])
    task = send(iter([rows]))
    next(task)      # the first batch is sent and in the ledger, then the task is lost
    del task
    assert sent == ["A", "B"]
    list(send(iter([rows])))
    assert sent == ["A", "B", "C"]


def test_a_writer_that_is_killed_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(3), path)
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        tables.write_table(bad, path)
    assert spark.read.parquet(tables.current(spark, path)).count() == 3
    commits._hadoop(spark, path)[2].create(commits._hadoop(spark, f"{path}/_commits/{2:012d}")[1], False).close()  # killed while committing
    assert spark.read.parquet(tables.current(spark, path)).count() == 3
    tables.write_table(spark.range(7), path)
    assert spark.read.parquet(tables.current(spark, path)).count() == 7
    with pytest.raises(commits.Conflict):
        commits.commit(spark, path, 3, "v-late")
    assert commits.remove_unused(spark, path, keep=1) == 2 and spark.read.parquet(tables.current(spark, path)).count() == 7


def test_csv_is_written_twice(spark, tmp_path):
    place = stages.Stages(str(tmp_path))
    schema = T.StructType([T.StructField("id", T.LongType())])
    for n in (3, 4):
        place.write(spark.range(n), "d", "read", formats=("parquet", "csv"))
        assert place.read(spark, "d", "prepare").count() == n
        assert delimited.read_european_csv(spark, tables.current(spark, place.path("d", "read") + ".csv"), schema).count() == n
    with pytest.raises(ValueError):
        tables.write_table(spark.range(1), str(tmp_path / "x"), "json")


def test_upsert_writes_only_the_buckets_of_the_new_keys(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    keyed.create_keyed(rows.union(spark.createDataFrame([(None, "no key")], "k long, v string")), path, "k", buckets=64)
    assert keyed.read_keyed(spark, path).count() == 20_001

    def files_of():
        return {str(p.relative_to(path)) for p in (tmp_path / "log").rglob("*.parquet")}

    before = files_of()
    new = spark.createDataFrame([(i * 1000, "new") for i in range(10)] + [(50_000, "added")], "key int, v string")
    written = keyed.upsert_keyed(new, path, ("k", "key"))
    assert len(written) <= 11 and len(files_of() - before) <= 2 * len(written) and before <= files_of()
    got = keyed.read_keyed(spark, path)
    assert got.count() == 20_001 and got.filter("v = 'new'").count() == 10 and got.filter("k IS NULL").count() == 0
    assert got.dtypes == rows.dtypes
    expected = tables.upsert(rows, new.select(F.col("key").cast("long").alias("k"), "v"), "k")
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    keyed.upsert_keyed(new.limit(0), path, ("k", "key"))
    assert keyed.read_keyed(spark, path).count() == 20_001
    with pytest.raises(ValueError):
        keyed.upsert_keyed(new, path, ("v", "v"))
    with pytest.raises(FileNotFoundError):
        keyed.read_keyed(spark, str(tmp_path / "none"))


def test_of_two_upserts_at_once_both_are_kept(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    keyed.create_keyed(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path, ["k"], buckets=4)
    plain, once = keyed.commit, []

    def late(*args):
        if not once:
            once.append(1)
            keyed.upsert_keyed(spark.createDataFrame([(2, "other")], "k int, v string"), path)
        plain(*args)

    monkeypatch.setattr(keyed, "commit", late)
    keyed.upsert_keyed(spark.createDataFrame([(1, "mine")], "k int, v string"), path)
    assert sorted(map(tuple, keyed.read_keyed(spark, path).collect())) == [(1, "mine"), (2, "other")]


def test_keyed_table_without_rows_and_with_a_hot_key(spark, tmp_path):
    empty = spark.createDataFrame([], "k string, v int")
    keyed.create_keyed(empty, str(tmp_path / "e"), "k")
    assert keyed.read_keyed(spark, str(tmp_path / "e")).count() == 0
    keyed.upsert_keyed(spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int"), str(tmp_path / "e"))
    assert sorted(map(tuple, keyed.read_keyed(spark, str(tmp_path / "e")).collect()), key=repr) == [("a", 1), ("a", 2), (None, 3)]
    with pytest.raises(ValueError):
        keyed.create_keyed(empty, str(tmp_path / "e"), "k", buckets=0)


def test_upsert_and_latest_log(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("c", 8)], "k string, v int")
    assert sorted(map(tuple, tables.upsert(old, new, "k").collect())) == [("a", 9), ("b", 2), ("c", 8)]
    log = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-02"), (None, "x")], "k string, at string")
    assert [tuple(r) for r in tables.latest_log(log, "k", "at").collect()] == [("a", "2024-01-02")]


class FakeSession:
    """The two things `shared_folder` asks of a session."""

    def __init__(self, master, folder=None):
        self.sparkContext = self
        self.master, self.folder, self.set_to = master, folder, None
        self.conf = self

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.folder

    def getCheckpointDir(self):
        return self.set_to

    def setCheckpointDir(self, folder):
        self.set_to = folder


def test_scratch_is_in_the_folder_the_cluster_names(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    cluster = FakeSession("yarn", "hdfs://shared/checkpoints/")
    assert scratch_path(cluster, "x").startswith("hdfs://shared/checkpoints/rollbook-scratch/x-")
    assert cluster.set_to == "hdfs://shared/checkpoints/"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("yarn"))
