"""Physical plans: what is pruned and pushed down, where a shuffle is, and that no Python runs."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tripmill.functions.trips import enrich, with_date
from tripmill.operators import documents, layout, table
from tripmill.operators.documents import document_schema
from tripmill.operators.layout import cluster
from tripmill.plans.queries import derive_trips
from tripmill.sources.csv import read_checked_csv, read_csv, rejects_of
from tripmill.sources.documents import read_documents
from tripmill.sources.tables import read_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trips_table(session):
    name = "default.plans_trips"
    table.write(with_date(derive_trips(session, SF_DIR)), name)
    return name


def plan(df, capfd):
    capfd.readouterr()
    df.explain("formatted")
    return capfd.readouterr().out


def test_days_prune_partitions_and_columns_narrow_the_scan(spark, trips_table, capfd):
    text = plan(read_table(spark, trips_table, dates=["2024-01-03"], columns=["trip_id"]), capfd)
    assert re.search(r"PartitionFilters: \[.*date.*2024-01-03", text)
    assert "ReadSchema: struct<trip_id:bigint>" in text
    text = plan(read_table(spark, trips_table, since="2024-01-03", until="2024-01-05"), capfd)
    assert re.search(r"PartitionFilters: \[.*>= 2024-01-03.*<= 2024-01-05", text)


def test_filters_reach_the_files(spark, trips_table, capfd):
    text = plan(read_table(spark, trips_table).where("total_amount > 100").select("trip_id"), capfd)
    assert "GreaterThan(total_amount,100.0)" in text
    text = plan(
        read_table(spark, trips_table).where(F.col("pickup_datetime") > F.lit("2024-01-20")).select("trip_id"), capfd
    )
    assert "GreaterThan(pickup_datetime" in text


def test_timestamps_are_stored_with_statistics(spark, trips_table):
    import pyarrow.parquet as pq

    path = spark.table(trips_table).inputFiles()[0].removeprefix("file://")
    metadata = pq.ParquetFile(path).metadata
    at = metadata.schema.names.index("pickup_datetime")
    assert metadata.schema.column(at).physical_type == "INT64"
    assert metadata.row_group(0).column(at).statistics.has_min_max


def test_counting_reads_no_columns(spark, trips_table, capfd):
    assert "ReadSchema: struct<>" in plan(spark.sql(f"select count(*) from {trips_table}"), capfd)


def test_enriching_is_one_projection_without_a_shuffle(spark, trips_table, capfd):
    text = plan(spark.table(trips_table).transform(enrich), capfd)
    assert "Exchange" not in text
    assert len(re.findall(r"^\(\d+\) Project", text, re.M)) == 1
    assert "codegen id" in text


def test_dashboards_read_two_columns_and_combine_before_the_shuffle(spark, trips_table, capfd):
    text = plan(spark.table(trips_table).transform(enrich).groupBy("pickup_week_day").agg(F.avg("duration")), capfd)
    assert "ReadSchema: struct<pickup_datetime:timestamp,dropoff_datetime:timestamp>" in text
    assert "partial_avg" in text
    assert text.count("Exchange (") <= 2  # once in the tree, once in the details


def test_pattern_prunes_indices(spark, trips_table, tmp_path, capfd):
    trips = spark.table(trips_table).select("trip_id", "vendor_id", "date")
    documents.write(trips, str(tmp_path / "d"), "taxi-{date}", exclude=["date"])
    found = read_documents(spark, str(tmp_path / "d"), document_schema(trips.schema, ["date"]), "taxi-2024-01-1*")
    text = plan(found.select("trip_id"), capfd)
    assert re.search(r"PartitionFilters: \[.*StartsWith\(index#\d+, taxi-2024-01-1\)", text)
    assert "ReadSchema: struct<trip_id:bigint>" in text
    assert re.search(r"Location: InMemoryFileIndex \[.*taxi-2024-01-1\d, \.\.\. 9 entries\]", text)


def test_one_shuffle_on_the_key_for_a_write(spark, trips_table, capfd):
    text = plan(cluster(spark.table(trips_table), "date"), capfd)
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_rows_of_a_whole_file_are_streamed_to_their_partitions(spark, tmp_path, capfd, monkeypatch):
    paths = [str(tmp_path / name) for name in ("one", "two")]
    for path in paths:
        derive_trips(spark, SF_DIR).drop("trip_id").coalesce(1).write.option("header", True).csv(path, compression="gzip")

    def partitions(read):
        text = plan(cluster(with_date(read_csv(spark, read)), "date", rows_per_task=100), capfd)
        assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
        return int(re.search(r"hashpartitioning\(.*, (\d+)\), REBALANCE_PARTITIONS_BY_COL", text)[1])

    # Up to so many a map task gathers no rows: it would hold all of the file.
    streamed = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    assert 1 < partitions(paths[:1]) <= streamed
    assert 1 < partitions(paths) <= streamed
    monkeypatch.setattr(layout, "STREAMED_PARTITIONS", 1)
    assert partitions(paths) == layout.PARTITIONS


def test_checked_read_casts_in_one_pass(spark, tmp_path, capfd):
    path = str(tmp_path / "csv")
    derive_trips(spark, SF_DIR).drop("trip_id").write.option("header", True).csv(path)
    for df in (read_csv(spark, path), rejects_of(read_checked_csv(spark, path))):
        text = plan(df, capfd)
        assert "Exchange" not in text
        assert "Python" not in text
        assert len(re.findall(r"^\(\d+\) Scan csv", text, re.M)) == 1
    narrow = plan(read_checked_csv(spark, path).select("total_amount", "bad_cells").drop("bad_cells"), capfd)
    assert "ReadSchema: struct<total_amount:string>" in narrow


@pytest.mark.parametrize("name", ["csv_quarantine", "enrich", "table_partial_reload", "job_process"])
def test_no_python_on_any_path(spark, name, capfd):
    text = plan(entry_points.queries()[name](spark, SF_DIR), capfd)
    assert not re.search(r"Python|Pandas|ArrowEval|Cartesian|NestedLoop", text)
