import datetime as dt
import json

from tidelog.cli import main
from tidelog.sync import Connection, Sync, Table

DAY = dt.datetime(2024, 1, 1)


def rows(spark, values, extra=False):
    kind = "id long, v string, updated_at timestamp, gone boolean" + (", extra string" if extra else "")
    return spark.createDataFrame([(i, v, DAY + dt.timedelta(minutes=m), g, *(["x"] if extra else [])) for i, v, m, g in values], kind)


def test_runs_read_what_is_new(spark, tmp_path):
    source = {"t": rows(spark, [(1, "a", 1, False), (2, "b", 2, False), (3, "c", 2, False)])}
    table = Table("t", "id", "updated_at", "gone")
    s = Sync(spark, Connection("c", lambda n: source[n], str(tmp_path), [table], buckets=2))
    assert s.run(100) == [("t", "success", 3)] and s.run(101) == [("t", "success", 0)]
    # a row at the cursor's time with a larger key is new, one with a smaller key is not
    source["t"] = rows(spark, [(1, "a", 1, False), (2, "b2", 2, False), (3, "c", 2, False), (4, "d", 2, False), (1, "a2", 3, True)])
    assert s.run(102) == [("t", "success", 2)]
    got = {r.id: (r.v, r.deleted_at is not None) for r in s.target(table).read().collect()}
    assert got == {1: ("a2", True), 2: ("b", False), 3: ("c", False), 4: ("d", False)}
    assert s.run(103, full=True) == [("t", "success", 5)] and s.target(table).read().count() == 5
    assert [(r.rows_read, r.failed_tables) for r in s.report(2).collect()] == [(5, 0), (2, 0)]
    assert s.status(110).first().age_s == 7 and s.reconcile().first().count_match


def test_schema_policy_stops_a_table_alone(spark, tmp_path):
    source = {"t": rows(spark, [(1, "a", 1, False)]), "u": rows(spark, [(1, "a", 1, False)])}
    tables = [Table("t", "id", "updated_at"), Table("u", "id", "updated_at", include=("id", "v")), Table("missing", "id")]
    s = Sync(spark, Connection("c", lambda n: source[n], str(tmp_path), tables, buckets=2))
    assert [x[1] for x in s.run(1)] == ["success", "success", "failed"]
    source["t"] = rows(spark, [(2, "b", 5, False)], extra=True)
    source["u"] = source["u"].withColumn("v", source["u"]["id"])
    assert s.changes(tables[0]) == [("extra", "added")] and s.changes(tables[1]) == [("v", "type_changed")]
    assert [x[:2] for x in s.run(2)] == [("t", "success"), ("u", "failed"), ("missing", "failed")]
    assert s.target(tables[0]).read().columns[-1] == "extra" and set(s.validate()) == {"u", "missing"}
    assert s.run(3, dry_run=True)[0] == ("t", "success", 0)


def test_a_second_run_at_once_is_refused(spark, tmp_path):
    import pytest

    s = Sync(spark, Connection("c", lambda n: None, str(tmp_path), []))
    assert s.lease.acquire("c", "other")
    with pytest.raises(RuntimeError, match="already locked"):
        s.run(1)


def test_command_line(spark, tmp_path, capsys):
    rows(spark, [(1, "a", 1, False), (2, "b", 2, False)]).write.parquet(str(tmp_path / "source" / "t.parquet"))
    path = str(tmp_path / "config.json")
    assert main([path, "init"]) == 0
    config = json.loads((tmp_path / "config.json").read_text())
    config["connections"][0] |= {"source": {"format": "parquet", "path": str(tmp_path / "source")}, "root": str(tmp_path / "out"), "buckets": 2, "tables": [{"name": "t", "primary_key": "id", "updated_at_column": "updated_at", "exclude": ["gone"]}]}
    (tmp_path / "config.json").write_text(json.dumps(config))
    assert [main([path, c], spark) for c in ("validate", "run", "status", "report", "reconcile")] == [0] * 5
    assert main([path, "run", "--every", "1s", "--passes", "2"], spark) == 0 and main([path, "run", "--schema-diff"], spark) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert said[1] == {"connection": "example", "table": "t", "status": "success", "rows_read": 2} and any(x.get("count_match") for x in said) and said[-1]["changes"] == []
