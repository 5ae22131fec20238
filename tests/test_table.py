"""The table writer: creation, growth, what is replaced and what is not, refusals, file layout."""

import random
import threading
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripmill.operators import table
from tripmill.session import held_settings
from tripmill.sources.tables import read_table

MODE = "spark.sql.sources.partitionOverwriteMode"


@pytest.fixture
def base(spark):
    return frame(spark, (1, "x", "2024-01-01"), (2, "y", "2024-01-01"), (3, "z", "2024-01-02"))


def frame(spark, *rows, ddl="a int, b string, date string"):
    return spark.createDataFrame(list(rows), ddl)


def content(spark, name):
    return sorted((tuple(r) for r in spark.table(name).collect()), key=repr)


def files(spark, name):
    """Data files per partition directory."""
    found = {}
    for path in spark.table(name).inputFiles():
        found.setdefault(Path(path).parent.name, []).append(Path(path).name)
    return found


BASE = [(1, "x", "2024-01-01"), (2, "y", "2024-01-01"), (3, "z", "2024-01-02")]


def test_create(spark, base, table_name):
    result = table.write(base.select("date", "a", "b"), table_name)
    assert (result.rows, result.created, result.added_columns) == (3, True, [])
    assert spark.table(table_name).columns == ["a", "b", "date"]
    assert content(spark, table_name) == BASE
    [ddl] = spark.sql(f"show create table {table_name}").first()
    assert "USING parquet" in ddl
    assert "PARTITIONED BY (date)" in ddl


def test_snappy_whatever_the_session_says(spark, base, table_name):
    with held_settings(spark, {"spark.sql.parquet.compression.codec": "zstd"}):
        table.write(base, table_name)
    assert all(f.endswith(".snappy.parquet") for names in files(spark, table_name).values() for f in names)


def test_rerun(spark, base, table_name):
    table.write(base, table_name)
    result = table.write(base, table_name)
    assert (result.rows, result.created) == (3, False)
    assert content(spark, table_name) == BASE


@pytest.mark.parametrize("mode", ["STATIC", "DYNAMIC", None])
def test_partial_reload_under_any_session_mode(spark, base, table_name, mode):
    spark.conf.unset(MODE) if mode is None else spark.conf.set(MODE, mode)
    try:
        table.write(base, table_name)
        table.write(frame(spark, (9, "new", "2024-01-01"), (8, "later", "2024-01-05")), table_name)
        assert spark.conf.get(MODE, None) == mode
    finally:
        spark.conf.unset(MODE)
    assert content(spark, table_name) == [
        (3, "z", "2024-01-02"),
        (8, "later", "2024-01-05"),
        (9, "new", "2024-01-01"),
    ]


def test_settings_come_back_after_a_failure(spark):
    spark.conf.set(MODE, "STATIC")
    try:
        with pytest.raises(RuntimeError), held_settings(spark):
            assert spark.conf.get(MODE) == "dynamic"
            raise RuntimeError
        assert spark.conf.get(MODE) == "STATIC"
    finally:
        spark.conf.unset(MODE)


def test_task_size_is_the_callers_if_there_is_one(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        with held_settings(spark):
            assert spark.conf.get(key) == "256m"
            with held_settings(spark):
                assert spark.conf.get(key) == "256m"
            assert spark.conf.get(key) == "256m"
        assert spark.conf.get(key, None) is None
        spark.conf.set(key, "1m")
        with held_settings(spark):
            assert spark.conf.get(key) == "1m"
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_overlapping_writes_keep_the_mode_until_the_last_is_done(spark):
    spark.conf.set(MODE, "STATIC")
    inside, leave = threading.Event(), threading.Event()

    def hold():
        with held_settings(spark):
            inside.set()
            leave.wait(30)

    other = threading.Thread(target=hold)
    try:
        other.start()
        assert inside.wait(30)
        with held_settings(spark):
            pass
        assert spark.conf.get(MODE) == "dynamic"
        leave.set()
        other.join(30)
        assert spark.conf.get(MODE) == "STATIC"
    finally:
        leave.set()
        spark.conf.unset(MODE)


def test_writes_in_threads_keep_the_days_they_do_not_hold(spark, base, table_name):
    names = [f"{table_name}_{i}" for i in range(4)]
    spark.conf.set(MODE, "STATIC")
    try:
        for name in names:
            table.write(base, name)
        with ThreadPoolExecutor(4) as pool:
            one_day = base.where("date = '2024-01-02'").withColumn("a", F.lit(7))
            assert [r.rows for r in pool.map(lambda name: table.write(one_day, name), names)] == [1] * 4
        assert spark.conf.get(MODE) == "STATIC"
    finally:
        spark.conf.unset(MODE)
    for name in names:
        assert content(spark, name) == [*BASE[:2], (7, "z", "2024-01-02")]


def test_new_column(spark, base, table_name):
    table.write(base, table_name)
    result = table.write(
        frame(spark, (4, "w", 0.5, "2024-01-02"), ddl="a int, b string, c double, date string"), table_name
    )
    assert result.added_columns == ["c"]
    assert spark.table(table_name).columns == ["a", "b", "c", "date"]
    assert content(spark, table_name) == [
        (1, "x", None, "2024-01-01"),
        (2, "y", None, "2024-01-01"),
        (4, "w", 0.5, "2024-01-02"),
    ]


def test_missing_column(spark, base, table_name):
    table.write(base, table_name)
    table.write(frame(spark, (4, "2024-01-02"), ddl="a int, date string"), table_name)
    assert (4, None, "2024-01-02") in content(spark, table_name)
    assert spark.table(table_name).schema["b"].dataType.simpleString() == "string"


def test_case_of_names_does_not_matter(spark, base, table_name):
    table.write(base, table_name)
    result = table.write(
        frame(spark, ("2024-01-02", "w", 4), ddl="DATE string, B string, A int"), table_name
    )
    assert result.added_columns == []
    assert content(spark, table_name) == [*BASE[:2], (4, "w", "2024-01-02")]


def test_case_of_the_partition_column_on_create(spark, table_name):
    table.write(frame(spark, (1, "2024-01-01"), ddl="a int, Date string"), table_name)
    assert spark.table(table_name).columns == ["a", "date"]


def test_names_that_cannot_be_told_apart_are_refused(spark, table_name):
    twins = spark.range(1).selectExpr("1 as a", "2 as A", "'2024-01-01' as date")
    with pytest.raises(ValueError, match="'a' and 'A'"):
        table.write(twins, table_name)
    same = spark.range(1).selectExpr("1 as a", "2 as a", "'2024-01-01' as date")
    with pytest.raises(ValueError, match="'a' and 'a'"):
        table.write(same, table_name)
    assert not spark.catalog.tableExists(table_name)


def test_partition_column_is_required(spark, base, table_name):
    with pytest.raises(ValueError, match="date"):
        table.write(base.drop("date"), table_name)
    with pytest.raises(ValueError, match="besides"):
        table.write(base.select("date"), table_name)
    assert not spark.catalog.tableExists(table_name)


def test_other_partitioning_is_refused(spark, base, table_name):
    table.write(base, table_name, partition_by="b")
    with pytest.raises(ValueError, match="partitioned by"):
        table.write(base, table_name)
    assert content(spark, table_name) == sorted([(a, d, b) for a, b, d in BASE], key=repr)


def test_null_date_keeps_its_rows(spark, base, table_name):
    table.write(frame(spark, (1, "x", None), (2, "y", None), (3, "z", "2024-01-02")), table_name)
    assert content(spark, table_name).count((1, "x", None)) == 1
    table.write(frame(spark, (4, "w", "2024-01-02")), table_name)
    assert content(spark, table_name) == [(1, "x", None), (2, "y", None), (4, "w", "2024-01-02")]
    table.write(frame(spark, (5, "v", None)), table_name)
    assert content(spark, table_name) == [(4, "w", "2024-01-02"), (5, "v", None)]


@pytest.mark.parametrize("cluster", [True, False])
def test_empty_input_changes_the_schema_only(spark, base, table_name, cluster):
    table.write(base, table_name)
    wider = frame(spark, ddl="a int, b string, c double, date string")
    result = table.write(wider, table_name, cluster=cluster)
    assert (result.rows, result.added_columns) == (0, ["c"])
    assert content(spark, table_name) == [(a, b, None, d) for a, b, d in BASE]


def test_empty_input_creates(spark, table_name):
    assert table.write(frame(spark, ddl="a int, date string"), table_name).created
    assert spark.table(table_name).isEmpty()


def test_type_drift_names_every_column_and_widens_nothing(spark, base, table_name):
    table.write(base.withColumn("t", F.lit(True)), table_name)
    drifted = spark.range(1).selectExpr("'1' as A", "'x' as b", "1.5 as t", "1 as extra", "'2024-01-01' as date")
    with pytest.raises(TypeError, match=r"A: string into int; t: decimal\(2,1\) into boolean"):
        table.write(drifted, table_name)
    assert "extra" not in spark.table(table_name).columns


@pytest.mark.parametrize(
    ("have", "want"),
    [
        ("bigint", "int"), ("double", "int"), ("bigint", "double"), ("int", "float"), ("double", "float"),
        ("timestamp", "date"), ("decimal(10,2)", "decimal(9,2)"), ("decimal(10,2)", "decimal(10,1)"),
        ("decimal(5,2)", "double"), ("bigint", "decimal(18,0)"), ("array<double>", "array<int>"), ("string", "int"),
    ],
)
def test_what_would_lose_values_is_refused_by_name_before_ddl(spark, table_name, have, want):
    table.write(spark.sql(f"select cast(null as {want}) as n, 'x' as s, '2024-01-01' as date"), table_name)
    drifted = spark.sql(f"select cast(null as {have}) as n, 1 as extra, 'x' as s, '2024-01-02' as date")
    with pytest.raises(TypeError, match="n: "):
        table.write(drifted, table_name)
    assert spark.table(table_name).columns == ["n", "s", "date"] and spark.table(table_name).count() == 1


@pytest.mark.parametrize(
    ("have", "want"),
    [
        ("tinyint", "int"), ("int", "bigint"), ("int", "double"), ("float", "double"), ("smallint", "float"),
        ("decimal(9,2)", "decimal(10,2)"), ("int", "decimal(10,0)"), ("date", "timestamp"), ("bigint", "string"),
    ],
)
def test_what_widens_is_taken(spark, table_name, have, want):
    table.write(spark.sql(f"select cast(null as {want}) as n, 'x' as s, '2024-01-01' as date"), table_name)
    value = "date'2024-05-06'" if have == "date" else "7"
    table.write(spark.sql(f"select cast({value} as {have}) as n, 'x' as s, '2024-01-02' as date"), table_name)
    [row] = spark.table(table_name).where("date = '2024-01-02'").selectExpr("n is not null as kept").collect()
    assert row.kept


def test_types_that_fit(spark, table_name):
    table.write(
        frame(spark, (1, 1.0, "x", "2024-01-01"), ddl="n bigint, d double, s string, date string"), table_name
    )
    table.write(
        spark.range(1).selectExpr(
            "2 as n", "cast(2.5 as float) as d", "date'2024-05-06' as s", "date'2024-01-02' as date"
        ),
        table_name,
    )
    assert content(spark, table_name) == [(1, 1.0, "x", "2024-01-01"), (2, 2.5, "2024-05-06", "2024-01-02")]


def test_wide_types_and_odd_names(spark, table_name):
    df = spark.range(1).selectExpr(
        "cast(1.25 as decimal(20,4)) as dec",
        "array(1, 2) as arr",
        "map('k', named_struct('x y', 1)) as m",
        "named_struct('in`ner', 'v', 'select', 2) as st",
        "interval '1' day as iv",
        "binary('ab') as bin",
        "7 as `od``d na.me`",
        "'2024-01-01' as date",
    )
    table.write(df, table_name)
    assert spark.table(table_name).collect() == df.collect()
    more = df.selectExpr("*", "array(named_struct('p q', 1)) as `add.ed`")
    assert table.write(more, table_name).added_columns == ["add.ed"]
    assert spark.table(table_name).drop("date").collect() == more.select(
        *[f"`{c.replace('`', '``')}`" for c in spark.table(table_name).columns if c != "date"]
    ).collect()


def test_two_partition_columns(spark, table_name):
    df = frame(
        spark, (1, "v", "2024-01-01"), (2, "w", "2024-01-01"), (3, "v", "2024-01-02"), ddl="a int, k string, date string"
    )
    table.write(df, table_name, partition_by=["k", "date"])
    table.write(df.where("a = 1").withColumn("a", F.lit(9)), table_name, partition_by=["k", "date"])
    assert content(spark, table_name) == [(2, "w", "2024-01-01"), (3, "v", "2024-01-02"), (9, "v", "2024-01-01")]


def test_late_rows_can_be_merged_with_what_is_there(spark, base, table_name):
    table.write(base, table_name)
    late = frame(spark, (7, "late", "2024-01-02"))
    whole_days = spark.table(table_name).join(late.select("date").distinct(), "date", "left_semi")
    table.write(whole_days.unionByName(late), table_name)
    assert content(spark, table_name) == [*BASE, (7, "late", "2024-01-02")]


def test_location_outlives_the_catalog(spark, base, table_name, tmp_path):
    location = str(tmp_path / "it's here")
    assert not table.attach(spark, table_name, location)
    assert table.write(base, table_name, location=location).created
    table.write(frame(spark, (4, "w", 0.5, "2024-01-03"), ddl="a int, b string, c double, date string"), table_name)
    expected = content(spark, table_name)

    spark.sql(f"drop table {table_name}")
    assert table.attach(spark, table_name, location)
    assert spark.table(table_name).dtypes == [("a", "int"), ("b", "string"), ("c", "double"), ("date", "string")]
    assert content(spark, table_name) == expected

    spark.sql(f"drop table {table_name}")
    result = table.write(frame(spark, (9, "q", "2024-01-01")), table_name, location=location)
    assert not result.created
    assert content(spark, table_name) == [
        (3, "z", None, "2024-01-02"),
        (4, "w", 0.5, "2024-01-03"),
        (9, "q", None, "2024-01-01"),
    ]


def test_location_without_data(spark, base, table_name, tmp_path):
    location = str(tmp_path / "t")
    table.write(base.where("a > 9"), table_name, location=location)
    Path(location).mkdir(exist_ok=True)
    spark.sql(f"drop table {table_name}")
    assert table.attach(spark, table_name, location)
    assert not table.write(base, table_name, location=location).created
    assert content(spark, table_name) == BASE


def test_columns_of_an_empty_load_survive_without_a_job_over_footers(spark, base, table_name, tmp_path):
    location = str(tmp_path / "t")
    table.write(base, table_name, location=location)
    table.write(base.where("a > 9").withColumn("c", F.lit(0.5)), table_name)
    columns = spark.table(table_name).columns
    spark.sql(f"drop table {table_name}")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.read), "parquet", lambda *a, **b: pytest.fail("footers were read"))
        assert table.attach(spark, table_name, location)
    assert spark.table(table_name).columns == columns and "c" in columns
    assert spark.table(table_name).where("c is not null").count() == 0
    assert len(content(spark, table_name)) == len(BASE)


def test_one_text_is_one_name(spark, table_name):
    df = spark.sql("select 1 as `a.b`, 'x' as c, '2024-01-15' as day union all select 2, 'y', '2024-01-16'")
    table.write(df, table_name, "day")
    assert read_table(spark, table_name, dates="2024-01-15", columns="a.b", by="day").collect()[0][0] == 1
    assert read_table(spark, table_name, dates=["2024-01-15"], by="day").count() == 1
    assert read_table(spark, table_name, since="2024-01-16", columns=["c"], by="day").collect()[0].c == "y"


def test_attach_with_a_given_schema(spark, base, table_name, tmp_path):
    table.write(base, table_name, location=str(tmp_path / "t"))
    spark.sql(f"drop table {table_name}")
    assert table.attach(spark, table_name, str(tmp_path / "t"), schema=base.schema)
    assert content(spark, table_name) == BASE


def test_read_days_and_columns(spark, base, table_name):
    table.write(base, table_name)
    assert read_table(spark, table_name, dates=["2024-01-02"], columns=["a"]).collect() == [(3,)]
    assert read_table(spark, table_name, since="2024-01-02").count() == 1
    assert read_table(spark, table_name, until="2024-01-01").count() == 2
    assert read_table(spark, table_name.removeprefix("default.")).count() == 3


def test_sql_prompt(spark, base, table_name):
    table.write(base, table_name)
    assert spark.sql(f"select count(*) from {table_name}").first()[0] == 3


def test_preview_shows_rows(spark, base, table_name, capfd):
    table.write(base, table_name, preview=1)
    assert "2024-01-0" in capfd.readouterr().out


def test_one_file_per_small_day(spark, table_name):
    days = spark.range(0, 20_000, 1, 16).selectExpr(
        "id as a", "date_format(date_add(date'2024-01-01', cast(id % 20 as int)), 'yyyy-MM-dd') as date"
    )
    table.write(days, table_name)
    assert {len(names) for names in files(spark, table_name).values()} == {1}
    assert len(files(spark, table_name)) == 20
    table.write(days, table_name, cluster=False)
    assert {len(names) for names in files(spark, table_name).values()} == {16}
    assert spark.table(table_name).count() == 20_000


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_day_is_split_and_whole(spark, table_name, adaptive):
    rows = spark.range(0, 200_000, 1, 32).selectExpr(
        "id as a",
        "if(id % 2 = 0, '2024-01-15', date_format(date_add(date'2024-01-01', cast(id % 14 as int)), 'yyyy-MM-dd')) as date",
    )
    callers = {
        "spark.sql.adaptive.enabled": adaptive,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB",
    }
    with held_settings(spark, callers):
        assert table.write(rows, table_name).rows == 200_000
    per_day = {day: len(names) for day, names in files(spark, table_name).items()}
    assert per_day.pop("date=2024-01-15") >= 4
    assert set(per_day.values()) == {1}
    assert spark.table(table_name).exceptAll(rows).isEmpty()
    assert rows.exceptAll(spark.table(table_name)).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_random_writes_against_a_model(spark, table_name, seed):
    """Batches with changing columns, case and days; the model keeps a list of rows per day."""
    rng = random.Random(seed)
    days = ["2024-01-01", "2024-01-02", "2024-01-03", None]
    model, columns = {}, []
    for _ in range(5):
        names = ["a", *rng.sample(["b", "c", "d"], rng.randint(0, 3))]
        rng.shuffle(names)
        touched = rng.sample(days, rng.randint(0, 3))
        rows = [
            {**{n: rng.choice([None, rng.randint(0, 9)]) for n in names}, "date": day}
            for day in touched
            for _ in range(rng.randint(1, 5))
        ]
        spelled = [n.upper() if rng.random() < 0.5 else n for n in [*names, "date"]]
        batch = spark.createDataFrame(
            [tuple(row[n.lower()] for n in spelled) for row in rows],
            ", ".join(f"{n} {'string' if n.lower() == 'date' else 'int'}" for n in spelled),
        )
        result = table.write(batch, table_name, cluster=rng.random() < 0.5)
        fresh = [n for n in names if n not in columns]
        assert (result.rows, result.created) == (len(rows), not columns)
        assert [n.lower() for n in result.added_columns] == (fresh if columns else [])
        columns += fresh
        for day in touched:
            model[day] = [row for row in rows if row["date"] == day]
        expected = Counter(
            (*[row.get(n) for n in columns], row["date"]) for kept in model.values() for row in kept
        )
        assert [n.lower() for n in spark.table(table_name).columns] == [*columns, "date"]
        assert Counter(tuple(r) for r in spark.table(table_name).collect()) == expected
