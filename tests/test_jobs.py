"""Both jobs end to end, the rejects report, zones, and the scratch folder."""

import json
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from tripmill.functions.trips import enrich
from tripmill.operators import documents
from tripmill.operators.documents import document_schema
from tripmill.plans import jobs
from tripmill.schema import TABLE, TRIP
from tripmill.session import held_settings, held_zone, scratch_path
from tripmill.sources.documents import read_documents

HEADER = ",".join(TRIP.names)
GOOD = [
    "red,2021-03-04 12:30:00,2021-03-04 12:50:30,3,8.4,10.25,50.5,2,,10.5,50.75,card,21.0,1.0,0.25,2.0,0.0,24.25",
    "blue,2021-03-05 23:50:10,2021-03-06 00:10:40,1,2.5,11.0,51.5,1,Y,11.25,51.0,cash,9.0,0.0,0.25,0.0,1.5,10.75",
]
BAD = "red,yesterday,2021-03-04 13:00:00,two,3.5,10.0,50.0,1,,10.1,50.1,card,12.0,0.0,0.25,1.0,0.0,13.25"


@pytest.fixture
def csv(tmp_path):
    def put(*lines):
        path = tmp_path / "trips.csv"
        path.write_text("\n".join([HEADER, *lines]) + "\n")
        return str(path)

    return put


def documents_of(spark, name, root, pattern="*"):
    return read_documents(spark, root, document_schema(enrich(spark.table(name)).schema, ["date"]), pattern)


def test_csv_to_documents(spark, csv, table_name, tmp_path):
    root = str(tmp_path / "documents")
    assert jobs.dump(spark, csv(*GOOD), table_name).written.rows == 2
    assert spark.table(table_name).schema == TABLE
    assert jobs.process(spark, root, table_name).rows == 2
    rows = documents_of(spark, table_name, root, "taxi-2021-*").collect()
    assert {(r["index"], r.pickup_week_day, r.pickup_hour, r.duration, r.timestamp) for r in rows} == {
        ("taxi-2021-03-04", "Thursday", 12, 20.5, "2021-03-04T12:30:00.000+0000"),
        ("taxi-2021-03-05", "Friday", 23, 20.5, "2021-03-05T23:50:10.000+0000"),
    }
    stored = [json.loads(line) for p in Path(root).rglob("*.json") for line in p.read_text().splitlines()]
    assert all("date" not in d and "index" not in d for d in stored)
    jobs.process(spark, root, table_name)
    assert documents_of(spark, table_name, root).count() == 4
    jobs.process(spark, root, table_name, mode="replace")
    assert documents_of(spark, table_name, root).count() == 2


def test_dump_again_replaces_only_the_days_it_holds(spark, csv, table_name):
    jobs.dump(spark, csv(*GOOD), table_name)
    jobs.dump(spark, csv(GOOD[0], GOOD[0]), table_name)
    assert Counter(r.date for r in spark.table(table_name).collect()) == {"2021-03-04": 2, "2021-03-05": 1}


def test_years_far_away_are_kept(spark, csv, table_name, tmp_path):
    years = ["0001", "1582", "1899", "9999"]
    lines = [GOOD[0].replace("2021-03-04 12", f"{year}-01-31 12") for year in years]
    jobs.dump(spark, csv(*lines), table_name)
    rows = spark.table(table_name).orderBy("date").selectExpr("date", "string(dropoff_datetime)").collect()
    assert [tuple(r) for r in rows] == [(f"{y}-01-31", f"{y}-01-31 12:50:30") for y in years]
    root = str(tmp_path / "documents")
    jobs.process(spark, root, table_name)
    back = documents_of(spark, table_name, root)
    stamps = back.orderBy("index").selectExpr("index", "timestamp", "string(pickup_datetime)", "duration").collect()
    assert [tuple(r) for r in stamps] == [
        (f"taxi-{y}-01-31", f"{y}-01-31T12:30:00.000+0000", f"{y}-01-31 12:30:00", 20.5) for y in years
    ]


def test_rejects_report(spark, csv, table_name, tmp_path):
    path = str(tmp_path / "rejects")
    result = jobs.dump(spark, csv(*GOOD, BAD), table_name, rejects_path=path)
    assert (result.written.rows, result.rejects) == (3, 1)
    [reject] = [json.loads(line) for p in Path(path).glob("*.json") for line in p.read_text().splitlines()]
    assert (reject["pickup_datetime"], reject["passenger_count"]) == ("yesterday", "two")
    assert reject["bad_cells"] == ["pickup_datetime", "passenger_count"]
    [kept] = spark.table(table_name).where("date is null").collect()
    assert (kept.pickup_datetime, kept.passenger_count, kept.total_amount) == (None, None, 13.25)


@pytest.mark.parametrize("cluster", [True, False])
@pytest.mark.parametrize("lines", [GOOD, []])
def test_no_rejects_no_report(spark, csv, table_name, tmp_path, lines, cluster):
    path = tmp_path / "rejects"
    result = jobs.dump(spark, csv(*lines), table_name, rejects_path=str(path), cluster=cluster)
    assert (result.written.rows, result.rejects) == (len(lines), 0)
    assert not [line for p in path.glob("*.json") for line in p.read_text().splitlines()]


def test_a_report_is_never_that_of_an_earlier_load(spark, csv, table_name, tmp_path):
    path = tmp_path / "rejects"
    assert jobs.dump(spark, csv(*GOOD, BAD), table_name, rejects_path=str(path)).rejects == 1
    assert list(path.glob("*.json"))
    assert jobs.dump(spark, csv(*GOOD), table_name, rejects_path=str(path)).rejects == 0
    assert not [line for p in path.glob("*.json") for line in p.read_text().splitlines()]


def test_all_surplus_cells_are_in_the_report(spark, csv, table_name, tmp_path):
    path = tmp_path / "rejects"
    jobs.dump(spark, csv(GOOD[0] + ",a,b,,d,e"), table_name, rejects_path=str(path))
    [reject] = [json.loads(line) for p in path.glob("*.json") for line in p.read_text().splitlines()]
    assert reject["line"] == GOOD[0] + ",a,b,,d,e" and reject["bad_cells"] == ["line"]


def test_process_takes_days(spark, csv, table_name, tmp_path):
    jobs.dump(spark, csv(*GOOD, BAD), table_name)
    root = str(tmp_path / "documents")
    for days, rows in [({"dates": "2021-03-04"}, 1), ({"since": "2021-03-05"}, 1), ({"until": "2021-03-03"}, 0)]:
        assert jobs.process(spark, root, table_name, mode="replace", **days).rows == rows
    assert jobs.process(spark, root, table_name, dates=["2021-03-04", "2021-03-05"], mode="replace").rows == 2
    assert documents_of(spark, table_name, root).count() == 2


def test_a_null_day_is_refused_before_any_task(spark, csv, table_name, tmp_path):
    jobs.dump(spark, csv(*GOOD, BAD), table_name)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(documents, "write", lambda *a, **b: pytest.fail("the write began"))
        with pytest.raises(ValueError, match="null_index"):
            jobs.process(spark, str(tmp_path / "documents"), table_name)


def test_the_callers_zone_comes_back(spark, csv, table_name, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    jobs.dump(spark, csv(*GOOD), table_name)
    assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    with held_zone(spark, "Asia/Tokyo"), pytest.raises(ValueError, match="held at 'Asia/Tokyo'"):
        jobs.process(spark, str(tmp_path / "documents"), table_name)
    assert jobs.process(spark, str(tmp_path / "documents"), table_name).rows == 2


def test_writes_through_two_objects_of_a_session_share_what_is_held(spark):
    other = SparkSession(spark.sparkContext, spark._jsparkSession)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    first, second = held_settings(spark), held_settings(other)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert other.conf.get(mode) == "dynamic"
    second.__exit__(None, None, None)
    assert spark.conf.get(mode) == before


def test_checked_dump_gives_the_same_table(spark, csv, table_name, tmp_path):
    source = csv(*GOOD, BAD, GOOD[0] + ",extra", "short,2021-03-04 00:00:00")
    jobs.dump(spark, source, table_name)
    jobs.dump(spark, source, table_name + "_checked", rejects_path=str(tmp_path / "r"))
    assert Counter(spark.table(table_name).collect()) == Counter(spark.table(table_name + "_checked").collect())


def test_trip_without_pickup_stops_the_documents_unless_an_index_is_named(spark, csv, table_name, tmp_path):
    root = str(tmp_path / "documents")
    jobs.dump(spark, csv(*GOOD, BAD), table_name)
    with pytest.raises(PySparkException, match="no value for a field"):
        jobs.process(spark, root, table_name, template="{pickup_datetime}")
    assert jobs.process(spark, root, table_name, null_index="taxi-undated").rows == 3
    assert documents_of(spark, table_name, root, "taxi-undated").count() == 1


def test_zone_decides_the_day(spark, csv, table_name, tmp_path):
    jobs.dump(spark, csv(GOOD[1]), table_name, zone="America/New_York")
    assert spark.table(table_name).first().date == "2021-03-05"
    root = str(tmp_path / "documents")
    jobs.process(spark, root, table_name, zone="America/New_York")
    assert documents_of(spark, table_name, root).first().timestamp == "2021-03-05T23:50:10.000-0500"


def test_process_in_a_session_that_does_not_know_the_table(spark, csv, table_name, tmp_path):
    location = str(tmp_path / "table")
    jobs.dump(spark, csv(*GOOD), table_name, location=location)
    spark.sql(f"drop table {table_name}")
    assert jobs.process(spark, str(tmp_path / "documents"), table_name, location=location).rows == 2


def test_process_shuffles_only_if_the_table_is_not_laid_out_by_the_route(spark, csv, table_name, tmp_path):
    jobs.dump(spark, csv(*GOOD, *GOOD), table_name)
    shuffled = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(documents, "cluster_by", lambda df, *names: shuffled.append(names) or df)
        for template, cluster in [("taxi-{DATE}", None), ("{vendor_id}-{date}", None), ("all", None), ("{date}", True)]:
            jobs.process(spark, str(tmp_path / "documents"), table_name, template=template, cluster=cluster)
            shuffled.append(template)
    assert shuffled == ["taxi-{DATE}", ("index",), "{vendor_id}-{date}", "all", ("index",), "{date}"]
    assert documents_of(spark, table_name, str(tmp_path / "documents")).count() == 16


def test_header_check(spark, tmp_path, table_name):
    path = tmp_path / "other.csv"
    path.write_text("a,b\n1,2\n")
    for rejects in (None, str(tmp_path / "rejects")):
        with pytest.raises((PySparkException, Py4JJavaError), match="header"):
            jobs.dump(spark, str(path), table_name, check_header=True, rejects_path=rejects)
    # Each file's header is read by the task that reads its rows, so the table is there, without rows.
    assert spark.table(table_name).count() == 0


def test_scratch_is_in_the_shared_folder_if_one_is_named():
    def session(master, **settings):
        return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))

    cluster = session("spark://x:1", **{"spark.checkpoint.dir": "hdfs://shared/x/"})
    assert scratch_path(cluster, "t").startswith("hdfs://shared/x/t-")
    assert scratch_path(cluster, "t") != scratch_path(cluster, "t")
    assert Path(scratch_path(session("local[2]"), "t")).parent.is_dir()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://x:1"), "t")


def test_a_setting_that_cannot_be_set_leaves_the_others_as_they_were(spark):
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    with pytest.raises(PySparkException), held_settings(spark, {mode: "dynamic", "spark.sql.warehouse.dir": "x"}):
        pass
    assert spark.conf.get(mode) == before
