"""The command line, in this process and session."""

from tripmill.__main__ import main
from tests.test_jobs import BAD, GOOD, HEADER


def test_dump_process_and_sql(spark, table_name, tmp_path, capsys):
    csv, location, root = tmp_path / "in.csv", str(tmp_path / "table"), str(tmp_path / "documents")
    csv.write_text("\n".join([HEADER, *GOOD, BAD]) + "\n")
    common = ["--table", table_name, "--location", location]
    main([*common, "dump", str(csv), "--rejects", str(tmp_path / "rejects"), "--check-header"])
    assert "rows=3" in capsys.readouterr().out
    spark.sql(f"drop table {table_name}")
    main([*common, "process", root, "--null-index", "taxi-undated"])
    assert "rows=3" in capsys.readouterr().out
    spark.sql(f"drop table {table_name}")
    main([*common, "sql", f"select count(*) as n from {table_name}"])
    assert "|3  |" in capsys.readouterr().out
    main([*common, "sql", f"select vendor_id from {table_name}", "--to", str(tmp_path / "whole"), "--format", "csv"])
    assert len([x for p in (tmp_path / "whole").glob("*.csv") for x in p.read_text().splitlines() if x != "vendor_id"]) == 3
    main([*common, "process", root, "--mode", "replace", "--dates", "2021-03-04"])
    assert "rows=1" in capsys.readouterr().out
    assert (tmp_path / "documents" / "index=taxi-2021-03-04").is_dir()


def test_changes_and_recovery(spark, table_name, tmp_path, capsys):
    csv, root = tmp_path / "in.csv", str(tmp_path / "documents")
    csv.write_text("\n".join([HEADER, *GOOD]) + "\n")
    main(["--table", table_name, "dump", str(csv), "--all-or-none", "--rows-per-task", "1"])
    assert "('2021-03-04',): 1" in capsys.readouterr().out
    for rows in (2, 0):
        main(["--table", table_name, "process", root, "--changed"])
        assert f"rows={rows}" in capsys.readouterr().out
    main(["--table", table_name, "recover", "--force"])
    assert "nothing to take back" in capsys.readouterr().out
