"""Loads as a whole: all partitions or none, columns that several loads add, rows by partition, and what is kept beside the data."""

import gzip
import json
import random
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.test_csv import CELLS
from tests.test_jobs import BAD, GOOD, HEADER, documents_of
from tests.test_table import BASE, content, files, frame
from tripmill import files as places
from tripmill.operators import ledger, staged, table
from tripmill.plans import jobs
from tripmill.session import held_settings
from tripmill.sources.csv import FAULTY, files_of, is_reject, read_checked_csv, read_csv, read_noted_csv, rejects_of
from tripmill.sources.tables import read_table

RELOAD = [(7, "new", "2024-01-02"), (8, "new", "2024-01-03"), (9, "new", None)]
BOTH = sorted([*BASE[:2], *RELOAD], key=repr)


@pytest.fixture
def base(spark):
    return frame(spark, *BASE)


# --- the schema and its place ---------------------------------------------------------------------


def test_a_column_may_be_called_location(spark, table_name, tmp_path):
    location = str(tmp_path / "t")
    rows = frame(spark, ("north", "x", "2024-01-01"), ddl="Location string, Provider string, date string")
    table.write(rows, table_name, location=location)
    table.write(rows.where("Location = ''").withColumn("late", F.lit(1)), table_name)
    assert table.location_of(spark, table_name) == f"file:{location}"
    assert (tmp_path / "t" / "_tripmill_schema.json").is_file()
    spark.sql(f"drop table {table_name}")
    assert table.attach(spark, table_name, location)
    assert spark.table(table_name).columns == ["Location", "Provider", "late", "date"]
    assert not Path("string").exists()


def test_keeping_the_schema_runs_no_job(spark, base, table_name):
    table.write(base, table_name)
    spark.sparkContext.setJobGroup("schema", "none expected")
    try:
        table.keep_schema(spark, table_name)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("schema")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_files_are_written_whole_or_not_at_all(spark, tmp_path):
    path = f"{tmp_path}/a b/x.json"
    assert places.read_text(spark, path) is None and places.names(spark, str(tmp_path / "a b")) == []
    for text in ("one", "zweï \U0001f600 " * 9999, ""):
        places.write_text(spark, path, text)
        assert places.read_text(spark, path) == text
    assert [n for n in places.names(spark, f"{tmp_path}/a b") if not n.startswith(".")] == ["x.json"]
    assert places.folders(spark, f"{tmp_path}/a*") == [f"file:{tmp_path}/a b"]
    assert places.remove(spark, f"{tmp_path}/a b") and not places.remove(spark, f"{tmp_path}/a b")


def test_no_other_module_asks_the_jvm():
    asking = {p.name for p in Path(table.__file__).parents[1].rglob("*.py") if "llm" not in p.parts and any(w in p.read_text() for w in ("_jvm", "_jsparkSession", "_jsc"))}
    assert asking == {"files.py"}


# --- all partitions or none -----------------------------------------------------------------------


def test_all_days_are_replaced_together(spark, base, table_name):
    table.write(base, table_name)
    before = set(spark.table(table_name).inputFiles())
    result = table.write(frame(spark, *RELOAD), table_name, all_or_none=True)
    assert (result.rows, result.created) == (3, False)
    assert content(spark, table_name) == BOTH
    assert spark.table(table_name).where("date = '2024-01-02'").count() == 1
    # What was replaced is gone, what was not is as it was.
    there = {path for path in before if Path(path.removeprefix("file:")).exists()}
    assert there == {path for path in before if "date=2024-01-01" in path}


def test_a_new_table_and_an_empty_load(spark, base, table_name):
    assert table.write(base, table_name, all_or_none=True).created
    assert table.write(base.where("a > 9").withColumn("c", F.lit(1)), table_name, all_or_none=True).rows == 0
    assert content(spark, table_name) == [(a, b, None, d) for a, b, d in BASE]


@pytest.mark.parametrize("at", [0, 1, 2])
def test_a_commit_that_fails_on_its_way_leaves_the_old_table(spark, base, table_name, monkeypatch, at):
    table.write(base, table_name)
    point, calls = staged._point, []

    def failing(*arguments, **named):
        calls.append(arguments)
        if len(calls) == at + 1:
            raise OSError("lost on purpose")
        point(*arguments, **named)

    monkeypatch.setattr(staged, "_point", failing)
    with pytest.raises(OSError, match="on purpose"):
        table.write(frame(spark, *RELOAD), table_name, all_or_none=True)
    monkeypatch.undo()
    assert content(spark, table_name) == BASE
    assert not table.recover(spark, table_name)
    table.write(frame(spark, *RELOAD), table_name, all_or_none=True)
    assert content(spark, table_name) == BOTH


def test_a_commit_that_fails_at_its_end_leaves_the_old_table(spark, base, table_name, monkeypatch):
    table.write(base, table_name, all_or_none=True)
    monkeypatch.setattr(staged, "_keep_places", lambda *a: pytest.fail("lost on purpose"))
    with pytest.raises(pytest.fail.Exception):
        table.write(frame(spark, *RELOAD), table_name, all_or_none=True)
    monkeypatch.undo()
    assert content(spark, table_name) == BASE


def lose_the_driver(spark, name, monkeypatch):
    """A load that stops half-way, with no one left to take it back."""
    point, calls = staged._point, []

    def lost(*arguments, **named):
        if len(calls) == 2:
            raise KeyboardInterrupt
        calls.append(point(*arguments, **named))

    monkeypatch.setattr(staged, "_point", lost)
    monkeypatch.setattr(staged, "_take_back", lambda *a: None)
    with pytest.raises(KeyboardInterrupt):
        table.write(frame(spark, *RELOAD), name, all_or_none=True)
    monkeypatch.undo()


def test_a_lost_drivers_load_is_taken_back(spark, base, table_name, monkeypatch):
    table.write(base, table_name)
    lose_the_driver(spark, table_name, monkeypatch)
    assert content(spark, table_name) != BASE
    assert table.recover(spark, table_name)
    assert content(spark, table_name) == BASE
    assert not table.recover(spark, table_name)


def test_the_next_load_takes_back_one_of_its_own_application(spark, base, table_name, monkeypatch):
    table.write(base, table_name)
    lose_the_driver(spark, table_name, monkeypatch)
    table.write(frame(spark, (5, "v", "2024-01-09")), table_name)
    assert content(spark, table_name) == [*BASE, (5, "v", "2024-01-09")]


def test_a_load_of_another_application_is_not_touched(spark, base, table_name, monkeypatch):
    table.write(base, table_name)
    lose_the_driver(spark, table_name, monkeypatch)
    journal = f"{table.location_of(spark, table_name)}/_tripmill_load"
    theirs = json.loads(places.read_text(spark, journal)) | {"application": "another"}
    places.write_text(spark, journal, json.dumps(theirs))
    with pytest.raises(staged.UnfinishedLoadError, match="application another"):
        table.write(base, table_name)
    assert table.recover(spark, table_name, force=True)
    assert content(spark, table_name) == BASE


def test_a_new_catalog_entry_shows_a_half_switched_load_not_at_all(spark, base, table_name, monkeypatch, tmp_path):
    location = str(tmp_path / "t")
    table.write(base, table_name, location=location)
    lose_the_driver(spark, table_name, monkeypatch)
    spark.sql(f"drop table {table_name}")
    table.attach(spark, table_name, location)
    assert content(spark, table_name) == BASE


def test_partitions_elsewhere_survive_the_catalog_and_plain_loads(spark, base, table_name, tmp_path):
    location = str(tmp_path / "it's $5 % here")
    table.write(base, table_name, location=location)
    table.write(frame(spark, *RELOAD), table_name, all_or_none=True)
    table.write(frame(spark, (1, "plain", "2024-01-03")), table_name)
    expected = sorted([r for r in BOTH if r[2] != "2024-01-03"] + [(1, "plain", "2024-01-03")], key=repr)
    assert content(spark, table_name) == expected
    spark.sql(f"drop table {table_name}")
    table.attach(spark, table_name, location)
    assert content(spark, table_name) == expected


def test_odd_partition_values_and_several_columns(spark, table_name):
    rows = [(1, "a/b", "x=y"), (2, "it's", "100%"), (3, "ü \\ \"", None), (4, None, None), (5, "", "z")]
    df = frame(spark, *rows, ddl="a int, k string, m string")
    table.write(df.withColumn("a", F.col("a") + 10), table_name, ["k", "m"])
    result = table.write(df, table_name, ["k", "m"], all_or_none=True)
    stored = [(a, k or None, m) for a, k, m in rows]
    assert content(spark, table_name) == sorted(stored, key=repr)
    assert result.partitions == {(k, m): 1 for _, k, m in stored}


def test_types_are_the_tables(spark, table_name):
    table.write(frame(spark, (2**40, 0.5, "x", "2024-01-01"), ddl="n bigint, v double, t string, date string"), table_name)
    table.write(frame(spark, (7, 3, 5, "2024-01-02"), ddl="n int, v int, t int, date string"), table_name, all_or_none=True)
    assert content(spark, table_name) == [(2**40, 0.5, "x", "2024-01-01"), (7, 3.0, "5", "2024-01-02")]


# --- rows by partition ----------------------------------------------------------------------------


@pytest.mark.parametrize("all_or_none", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_random_loads_against_a_model(spark, table_name, seed, all_or_none):
    rng = random.Random(seed)
    days = [*[f"2024-01-{d:02}" for d in range(1, 30)], None]
    model = {}
    for _ in range(4):
        rows = [(i, rng.choice(days[:: rng.randint(1, 4)])) for i in range(rng.choice([0, 3, 400]))]
        how = all_or_none and rng.random() < 0.7
        result = table.write(frame(spark, *rows, ddl="a int, date string"), table_name, all_or_none=how, cluster=rng.random() < 0.5)
        assert result.partitions == Counter((day,) for _, day in rows)
        for day in {day for _, day in rows}:
            model[day] = [r for r in rows if r[1] == day]
        assert Counter(map(tuple, spark.table(table_name).collect())) == Counter(r for kept in model.values() for r in kept)


def test_more_partitions_than_are_counted(spark, table_name, monkeypatch):
    rows = spark.range(60).selectExpr("id as a", "concat('d', id % 30) as date")
    monkeypatch.setattr(table, "_COUNTED", 20)
    result = table.write(rows, table_name)
    assert (result.rows, result.partitions) == (60, None)
    assert list(ledger.loads(spark, table.location_of(spark, table_name)).values()) == [None]


# --- columns that several loads add ---------------------------------------------------------------


def test_two_loads_add_one_column_at_once(spark, base, table_name):
    table.write(base, table_name)

    def load(k):
        day = frame(spark, (k, "t", k, k, f"2024-02-{k:02}"), ddl=f"a int, b string, shared int, own_{k % 3} int, date string")
        return table.write(day, table_name)

    with ThreadPoolExecutor(6) as pool:
        results = list(pool.map(load, range(1, 13)))
    got = spark.table(table_name)
    assert sorted(got.columns) == sorted(["a", "b", "shared", "own_0", "own_1", "own_2", "date"])
    assert sorted(c for r in results for c in r.added_columns) == ["own_0", "own_1", "own_2", "shared"]
    rows = {r.a: r for r in got.where("date >= '2024-02'").collect()}
    assert len(rows) == 12 and all(r.shared == k and r[f"own_{k % 3}"] == k for k, r in rows.items())
    kept = json.loads(places.read_text(spark, f"{table.location_of(spark, table_name)}/_tripmill_schema.json"))
    assert [f["name"] for f in kept["fields"]] == got.columns


def test_a_column_that_another_session_adds_meanwhile(spark, base, table_name, monkeypatch):
    table.write(base, table_name)
    add, calls = table.add_columns, []

    def late(s, name, fields):
        if not calls:
            calls.append(name)
            add(s, name, fields)
        return add(s, name, fields)

    monkeypatch.setattr(table, "add_columns", late)
    result = table.write(base.withColumn("c", F.lit(5)), table_name)
    assert calls and result.added_columns == []
    assert {r.c for r in spark.table(table_name).collect()} == {5}


def test_a_column_added_between_alignment_and_insert(spark, base, table_name, monkeypatch):
    table.write(base, table_name)
    replace, calls = table._replace, []

    def late(*arguments):
        if not calls:
            calls.append(spark.sql(f"alter table {table_name} add columns (c int)"))
        return replace(*arguments)

    monkeypatch.setattr(table, "_replace", late)
    table.write(frame(spark, (6, "w", "2024-01-02")), table_name)
    assert content(spark, table_name) == [(1, "x", None, "2024-01-01"), (2, "y", None, "2024-01-01"), (6, "w", None, "2024-01-02")]
    location = table.location_of(spark, table_name)
    assert all(loaded is not None for loaded in ledger.loads(spark, location).values())


def test_a_refusal_that_stays_is_raised(spark, base, table_name, monkeypatch):
    table.write(base, table_name)
    monkeypatch.setattr(table, "add_columns", lambda s, n, f: s.sql("select nothing_there"))
    with pytest.raises(AnalysisException):
        table.write(base.withColumn("c", F.lit(5)), table_name)


# --- one file that does not split -----------------------------------------------------------------


def zipped(tmp_path, lines, name="trips.csv.gz"):
    path = tmp_path / name
    with gzip.open(path, "wt") as out:
        out.write("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def many(n, days=1):
    return [f"red,2021-03-{1 + k % days:02} 12:30:00,2021-03-{1 + k % days:02} 12:50:{k % 60:02},{k % 9},{k}.5,,,,,,,card,,,,,,{k}" for k in range(n)]


def test_a_hot_day_of_one_zipped_file_is_cut_up(spark, table_name, tmp_path):
    path = zipped(tmp_path, many(20_000))
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}
    with held_settings(spark, small):
        jobs.dump(spark, path, f"{table_name}_plain", rows_per_task=10**9)
        result = jobs.dump(spark, path, table_name, rows_per_task=2_000).written
    assert result.partitions == {("2021-03-01",): 20_000}
    assert len(files(spark, f"{table_name}_plain")["date=2021-03-01"]) == 1
    assert len(files(spark, table_name)["date=2021-03-01"]) >= 5
    got, want = spark.table(table_name), spark.table(f"{table_name}_plain")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_only_files_that_do_not_split_are_salted(spark, table_name, tmp_path, monkeypatch):
    asked = []
    write = table.write
    monkeypatch.setattr(table, "write", lambda *a, **how: asked.append(how["rows_per_task"]) or write(*a, **how))
    plain = tmp_path / "plain.csv"
    plain.write_text("\n".join([HEADER, *many(10)]) + "\n")
    jobs.dump(spark, str(plain), table_name)
    jobs.dump(spark, [str(plain), zipped(tmp_path, many(10, 3))], table_name)
    assert asked == [None, 2_000_000]
    assert spark.table(table_name).count() == 20


def test_a_small_zipped_file_has_a_file_a_day(spark, table_name, tmp_path):
    jobs.dump(spark, zipped(tmp_path, many(900, 9)), table_name)
    assert {len(f) for f in files(spark, table_name).values()} == {1}


# --- rejects, from the files that have some -------------------------------------------------------


def test_only_files_with_rejects_are_read_again(spark, table_name, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(12):
        lines = [*GOOD, BAD] if k in (3, 7) else GOOD
        (folder / f"part {k} [x]%20{k}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    checked, noted = read_checked_csv(spark, str(folder)), read_noted_csv(spark, str(folder))
    note = bytes(checked.agg(files_of(is_reject())).first()[0])
    seen = Observation()
    noted.observe(seen, files_of(F.col(FAULTY)).alias("files")).write.format("noop").mode("overwrite").save()
    assert bytes(seen.get["files"]) == note
    again = read_checked_csv(spark, str(folder), files=note)
    assert rejects_of(again).count() == 2
    # Two files of a few bytes, read by no more than two tasks.
    assert again.count() == 6
    result = jobs.dump(spark, str(folder), table_name, rejects_path=str(tmp_path / "r"))
    assert (result.written.rows, result.rejects) == (26, 2)
    assert spark.read.json(str(tmp_path / "r")).count() == 2


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "timestamp", "string"])
def test_the_plain_read_finds_fault_where_the_checked_one_does(spark, tmp_path, kind):
    cells = [*CELLS, "\uff11\uff12", "-\u0663\u0664", "1\u096b", "+\u06f5", "\U0001d7ce", "\u0663" * 12, "\u0663" * 30, "\u00b2", "1\u00a0", "\u0663.5"]
    path = tmp_path / "cells.csv"
    path.write_text("id,c\n" + "".join(f'{i},"{cell}"\n' for i, cell in enumerate(cells)) + f"{len(cells)}\n{len(cells) + 1},1,2\n")
    schema = StructType.fromDDL(f"id int, c {kind}")
    noted = {(r.id, r.c): r.faulty for r in read_noted_csv(spark, str(path), schema).select("id", F.col("c").cast("string"), FAULTY).collect()}
    checked = {(r.id, r.c): r.bad for r in read_checked_csv(spark, str(path), schema).select("id", F.col("c").cast("string"), is_reject().alias("bad")).collect()}
    assert noted == checked
    plain = read_csv(spark, str(path), schema).select("id", F.col("c").cast("string")).collect()
    assert {tuple(r) for r in plain} == set(noted)


# --- only what has changed ------------------------------------------------------------------------


def put(tmp_path, *lines):
    path = tmp_path / "more.csv"
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_process_takes_what_has_changed(spark, table_name, tmp_path, monkeypatch):
    root = str(tmp_path / "documents")
    jobs.dump(spark, put(tmp_path, *GOOD), table_name)
    assert jobs.process(spark, root, table_name, changed=True).rows == 2
    assert jobs.process(spark, root, table_name, changed=True).rows == 0
    jobs.dump(spark, put(tmp_path, GOOD[1], GOOD[1]), table_name)
    read = []
    monkeypatch.setattr(jobs, "read_table", lambda *a, **how: read.append(how["dates"]) or read_table(*a, **how))
    assert jobs.process(spark, root, table_name, changed=True).rows == 2
    assert read == [["2021-03-05"]]
    got = Counter(r["index"] for r in documents_of(spark, table_name, root).collect())
    assert got == {"taxi-2021-03-04": 1, "taxi-2021-03-05": 2}
    # Another root has seen nothing yet.
    assert jobs.process(spark, str(tmp_path / "other"), table_name, changed=True).rows == 3


def test_a_day_without_a_value_changes_like_any_other(spark, table_name, tmp_path):
    root = str(tmp_path / "documents")
    jobs.dump(spark, put(tmp_path, *GOOD), table_name)
    jobs.process(spark, root, table_name, changed=True)
    jobs.dump(spark, put(tmp_path, BAD), table_name)
    with pytest.raises(ValueError, match="name a null_index"):
        jobs.process(spark, root, table_name, changed=True)
    assert jobs.process(spark, root, table_name, changed=True, null_index="none").rows == 1
    assert jobs.process(spark, root, table_name, changed=True, null_index="none").rows == 0


def test_a_load_that_did_not_finish_makes_all_days_new_once(spark, table_name, tmp_path):
    root = str(tmp_path / "documents")
    jobs.dump(spark, put(tmp_path, *GOOD), table_name)
    jobs.process(spark, root, table_name, changed=True)
    entry = ledger.begin(spark, table.location_of(spark, table_name))
    assert jobs.process(spark, root, table_name, changed=True).rows == 2
    assert jobs.process(spark, root, table_name, changed=True).rows == 0
    ledger.finish(spark, entry, {("2021-03-04",): 1})
    assert jobs.process(spark, root, table_name, changed=True).rows == 1


def test_a_run_that_fails_is_done_again(spark, table_name, tmp_path, monkeypatch):
    root = str(tmp_path / "documents")
    jobs.dump(spark, put(tmp_path, *GOOD), table_name)
    with monkeypatch.context() as patch:
        patch.setattr(jobs.documents, "write", lambda *a, **b: pytest.fail("lost on purpose"))
        with pytest.raises(pytest.fail.Exception):
            jobs.process(spark, root, table_name, changed=True)
    assert jobs.process(spark, root, table_name, changed=True).rows == 2


@pytest.mark.parametrize("how", [{"template": "{vendor_id}"}, {"template": "{date}-{vendor_id}"}, {"dates": "2021-03-04"}, {"since": "2021"}])
def test_what_cannot_be_told_by_days_is_refused(spark, table_name, tmp_path, how):
    jobs.dump(spark, put(tmp_path, *GOOD), table_name)
    with pytest.raises(ValueError):
        jobs.process(spark, str(tmp_path / "documents"), table_name, changed=True, **how)


def test_loads_that_fail_before_or_replace_nothing_leave_no_entry(spark, base, table_name):
    table.write(base, table_name)
    table.write(base.where("a > 9"), table_name)
    with pytest.raises(TypeError):
        table.write(frame(spark, (2**40, "x", "2024-01-01"), ddl="a bigint, b string, date string"), table_name)
    loads = ledger.loads(spark, table.location_of(spark, table_name))
    assert list(loads.values()) == [{("2024-01-01",): 2, ("2024-01-02",): 1}]


def test_changed_partitions():
    given = {"1": {("a",): 1}, "2": {("a",): 2, (None,): 1}, "3": {("c",): 1}}
    assert ledger.changed(given, None) is None
    assert ledger.changed(given, []) == {("a",), (None,), ("c",)}
    assert ledger.changed(given, ["1", "2"]) == {("c",)}
    assert ledger.changed(given | {"4": None}, ["1", "2", "3"]) is None
    assert ledger.changed(given | {"4": None}, ["1", "2", "3", "4:unfinished"]) == set()
    assert ledger.as_seen({"1": None, "2": {}}) == ["1:unfinished", "2"]
