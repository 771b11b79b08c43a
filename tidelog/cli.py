"""Command line: python -m tidelog.cli CONFIG {init, run, status, validate, report, reconcile}.

The configuration is JSON: {"connections": [{"id", "enabled", "source": {"format", "path" or "options"}, "root", "policy", "tables": [...]}]}.
Tables of a source with a path lie at PATH/NAME.parquet (or as its format says); of one without, the name is the option `dbtable`.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession

from . import control
from .sync import Connection, Sync, Table

EXAMPLE = {
    "connections": [
        {
            "id": "example", "enabled": True, "source": {"format": "parquet", "path": "/data/source"}, "root": "/data/tables", "policy": "auto",
            "tables": [{"name": "orders", "primary_key": "id", "updated_at_column": "updated_at"}],
        }
    ]
}


def connection(spark: SparkSession, c: dict) -> Connection:
    source = c["source"]

    def read(name: str):
        r = spark.read.format(source["format"]).options(**source.get("options", {}))
        return r.load(f"{source['path'].rstrip('/')}/{name}.{source['format']}") if "path" in source else r.option("dbtable", name).load()

    tables = [Table(**{k: tuple(v) if isinstance(v, list) else v for k, v in t.items()}) for t in c["tables"]]
    return Connection(c["id"], read, c["root"], tables, c.get("policy", "auto"), c.get("enabled", True), c.get("buckets", 64))


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidelog")
    p.add_argument("config")
    p.add_argument("command", choices=["init", "run", "status", "validate", "report", "reconcile"])
    p.add_argument("--connection")
    p.add_argument("--full", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--schema-diff", action="store_true")
    p.add_argument("--every", help="go on at this interval, such as 5m; without it, one pass")
    p.add_argument("--passes", type=int, help="stop after so many passes")
    a = p.parse_args(args)
    if a.command == "init":
        with open(a.config, "x") as f:
            json.dump(EXAMPLE, f, indent=2)
        return 0
    with open(a.config) as f:
        config = json.load(f)
    spark = spark or SparkSession.builder.appName("tidelog").getOrCreate()
    syncs = [Sync(spark, connection(spark, c)) for c in control.selected_connections(config["connections"], a.connection)]
    say = lambda **x: print(json.dumps(x, default=str, sort_keys=True))
    failed, done = False, 0
    while True:
        for s in syncs:
            name, now = s.connection.id, int(time.time())
            if a.command == "run" and a.schema_diff:
                for t in s.connection.tables:
                    say(connection=name, table=t.name, changes=s.changes(t))
            elif a.command == "run":
                for table, status, n in s.run(now, a.full, a.dry_run):
                    failed |= status != "success"
                    say(connection=name, table=table, status=status, rows_read=n)
            elif a.command == "validate":
                bad = s.validate()
                failed |= bool(bad)
                say(connection=name, config=control.config_hash(config), problems=bad)
            else:
                rows = s.status(now) if a.command == "status" else s.report() if a.command == "report" else s.reconcile()
                for r in rows.toLocalIterator():
                    say(connection=name, **r.asDict())
        done += 1
        if a.command != "run" or not a.every or done == a.passes:
            return int(failed)
        time.sleep(control.schedule_seconds(a.every))


if __name__ == "__main__":
    sys.exit(main())
