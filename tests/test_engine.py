import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidelog import control
from tidelog.functions import scalars as X
from tidelog.operators import changes, incremental, ledger, merge, schema
from tidelog.sources import dynamic
from tidelog.storage import Lease, VersionedTable


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("text,seconds", [("3 days 04:05:06.5", 273906.5), ("1 mon", 2592000.0), ("-01:30:00", -5400.0)])
def test_intervals(spark, text, seconds):
    assert one(spark, X.interval_seconds(F.lit(text))) == seconds


def test_arrays():
    assert X.array_literal_json("{1,NULL,3}", "long") == "[1,null,3]"
    assert X.array_literal_json('{"a,b","NULL",x}', "string") == '["a,b","NULL","x"]'
    assert X.array_literal_json("{1,x}", "long") == "{1,x}"


def test_filters():
    assert X.normalise_filter(" ((A = 'X y')) ") == X.normalise_filter("a='X y'") != X.normalise_filter("a='x y'")


def test_chunks():
    got = incremental.plan_chunks(40_000, 1, 40_000, 1_000, 4)
    assert [(c.start, c.end) for c in got] == [(1, 10_000), (10_001, 20_000), (20_001, 30_000), (30_001, 40_000)]
    assert incremental.plan_chunks(31_999, 1, 40_000, 1_000, 4) == []


def test_reducer_does_not_depend_on_order(spark):
    rows = [(k % 7, s, o, f"{s}-{o}") for k in range(60) for s, o in [(k // 3, k % 3)]]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "id long, sequence long, tx_ordinal long, v string").repartition(3)
        got = sorted(map(tuple, merge.reduce_steps([df], "id").collect()))
        want = want or got
        assert got == want


def test_null_keys_are_always_inserted(spark):
    t = spark.createDataFrame([(1, "a"), (None, "b")], "id long, v string")
    s = spark.createDataFrame([(1, "c"), (None, "d")], "id long, v string")
    assert sorted((r.v for r in merge.upsert(t, s, "id").collect())) == ["b", "c", "d"]


def test_event_time_merge(spark):
    kind = "id long, event_at long, event_id string, deleted_at long"
    t = spark.createDataFrame([(1, 5, "a", None), (2, 5, "b", None), (3, None, None, None)], kind)
    s = spark.createDataFrame([(1, 5, "a", 5), (2, 4, "z", None), (3, 1, "c", None), (4, 9, "d", 9), (5, 9, "e", None), (5, None, "f", None)], kind)
    got = {r.id: (r.event_id, r.deleted_at) for r in merge.event_time_merge(t, s, "id").collect()}
    assert got == {1: ("a", 5), 2: ("b", None), 3: ("c", None), 5: ("e", None)}


def test_frontier_waits_for_all_fragments(spark):
    p = spark.createDataFrame([("c", 10, "l10", 2, 2), ("c", 11, "l11", 2, 1), ("c", 12, "l12", 1, 1)], "connection_id string, sequence long, commit_lsn string, expected_fragments long, succeeded_fragments long")
    assert tuple(ledger.frontier(p, 10, 100).first()) == ("c", 11, "l10")
    assert ledger.frontier(p, 9, 100).count() == 0


def test_window_stops_at_a_barrier(spark):
    kind = "connection_id string, table_key string, job_id string, first_sequence long, status string, stage string, barrier_kind string, reducer_eligible boolean, created_at long, updated_at long"
    rows = [("c", "t", f"j{n}", n, "pending", "loaded", "truncate" if n == 11 else None, True, n, n) for n in (10, 11, 12)]
    got = ledger.windows(spark.createDataFrame(rows, kind), 10_000, 0, 16, 0)
    assert [r.job_id for r in got.collect()] == ["j10"]
    got = ledger.windows(spark.createDataFrame(rows[1:], kind), 10_000, 0, 16, 0)
    assert [r.job_id for r in got.collect()] == ["j11"]


def test_truncate_cut(spark):
    rows = [(1, 0, "insert", "t", 1), (2, 0, "truncate", "t", None), (3, 0, "insert", "t", 2), (1, 1, "insert", "u", 3)]
    df = spark.createDataFrame(rows, "sequence long, tx_ordinal long, op string, table string, id long")
    assert sorted(r.id for r in changes.after_truncate(df).collect()) == [2, 3]


def test_null_key_in_compaction_fails(spark):
    df = spark.createDataFrame([(1, 0, "insert", None)], "sequence long, tx_ordinal long, op string, id long")
    with pytest.raises(Exception, match="primary key"):
        changes.compact(df, ["id"], True).collect()


def test_attributes():
    assert dynamic.decode_item('{"a":{"S":"x"},"b":{"L":[{"N":"1"},{"NULL":true}]},"c":{"?":1}}') == '{"a":"x","b":["1",null],"c":null}'


def test_schema_rules(spark):
    assert schema.select_columns(["id", "a", "b"], ["a"], ["a"], ["id"]) == ["id"]
    assert schema.select_tables(["x.y"], ["p.*"], ["p.b"], ["p.a", "p.b"]) == ["p.a", "x.y"]
    with pytest.raises(ValueError):
        schema.check_policy([("a", "type_changed")], False, "auto")
    schema.check_policy([("a", "removed")], False, "auto")
    old, new = spark.createDataFrame([(1, 2)], "id long, A long"), spark.createDataFrame([(3, 4, 5)], "id long, a long, extra long")
    assert schema.evolve(old, new).columns == ["id", "A", "extra"]


def test_versioned_table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "id")
    t.append(spark.createDataFrame([(1, "a")], "id long, v string"))
    t.write_batch(spark.createDataFrame([(1, "b"), (2, "c")], "id long, v string"), name="batch-1")
    t.write_batch(spark.createDataFrame([(1, "b"), (2, "c")], "id long, v string"), name="batch-2")
    assert sorted(map(tuple, t.read().collect())) == [(1, "b"), (2, "c")]
    t.truncate()
    assert t.read().count() == 0


def test_follow_is_idempotent(spark, tmp_path):
    from tidelog.streaming.follow import change_stream, follow

    src = str(tmp_path / "log")
    kind = "sequence long, tx_ordinal long, op string, table string, id long, v string"
    spark.createDataFrame([(1, 0, "insert", "t", 1, "a"), (1, 1, "insert", "t", 2, "b")], kind).coalesce(1).write.parquet(src)
    t = VersionedTable(spark, str(tmp_path / "t"), "id")
    run = lambda: follow(change_stream(spark, src, spark.read.parquet(src).schema), t, ["id", "v"], str(tmp_path / "ck"), F.lit(dt.datetime(2024, 1, 1))).awaitTermination()
    run()
    spark.createDataFrame([(2, 0, "delete", "t", 1, "a"), (2, 1, "update", "t", 2, "c")], kind).coalesce(1).write.mode("append").parquet(src)
    run()
    run()
    assert sorted((r.id, r.v, r.deleted_at is not None) for r in t.read().collect()) == [(1, "a", True), (2, "c", False)]


def test_lease(spark, tmp_path):
    lease = Lease(spark, str(tmp_path / "leases"))
    assert lease.acquire("x", "a", 0) and not lease.acquire("x", "b", 30) and lease.acquire("x", "a", 40) and not lease.acquire("x", "b", 90) and lease.acquire("x", "b", 100)
    lease.release("x", "a")
    assert not lease.acquire("x", "a", 110)
    lease.release("x", "b")
    assert lease.acquire("x", "a", 111) and lease.acquire("y", "b", 111)
    # two that have seen the same state: one makes the next file
    number, _ = lease._held("x")
    assert [lease._next("x", number, o, 112) for o in "ab"] == [True, False]


def test_control():
    assert control.schedule_seconds("5m") == 300
    assert control.feedback_lsn(9, 5, {"a": True, "b": False}) == 5
    with pytest.raises(ValueError):
        control.merged_payload([{"target_table": "a", "primary_key": "i", "steps": [], "truncate": True}, {"target_table": "a", "primary_key": "i", "steps": []}])


@pytest.mark.parametrize("text", ["3 fortnights", "5", "1 monkey", "01:30", "2 weeks", ""])
def test_no_intervals(spark, text):
    assert one(spark, X.try_interval_seconds(F.lit(text))) is None and one(spark, X.interval_seconds(F.lit(None).cast("string"))) is None
    with pytest.raises(Exception, match="no interval"):
        one(spark, X.interval_seconds(F.lit(text)))


@pytest.mark.parametrize("body", ['{"dynamodb":{"Keys":{"id":{"S":"k"}}}}', '{"eventName":"INSERT","dynamodb":{"OldImage":{}}}', '{"eventName":"REMOVE","dynamodb":{"NewImage":{}}}'])
def test_bad_change_records_fail(spark, body):
    with pytest.raises(Exception, match="a change record lacks"):
        dynamic.change_records(spark.createDataFrame([("s", 1, 0, body)], "shard string, position long, arrival_ms long, body string")).collect()


def test_native_readers_agree_with_the_parsers(spark):
    literals = ["{1,NULL,3}", "{}", "{01}", "{-5,null}", "{1,x}", "{+1}", "{1 ,2}", "{99999999999999999999}", "{t,false}", "{a,b:c}", '{"q",x}', "{a\\,b}", "{é}", "{,}", "x", None]
    for element in ("long", "bool", "string", "numeric", "double"):
        got = spark.createDataFrame([(i, t) for i, t in enumerate(literals)], "i int, t string").select("i", X.array_to_json(F.col("t"), element).alias("j")).collect()
        assert {r.i: r.j for r in got} == {i: X.array_literal_json(t, element) for i, t in enumerate(literals)}, element
    items = ['{"b":{"S":"x"},"a":{"N":"1"}}', '{"a":{"BOOL":false},"c":{"NULL":true},"d":{"B":"=="}}', '{"s":{"SS":["a","b"]},"n":{"NS":["1"]},"e":{"?":1}}', '{"m":{"M":{"x":{"L":[{"S":"y"}]}}}}', "{}", '{"q":{"S":"a\\"b"}}', '{"two":{"N":"1","S":"s"}}', None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "i int, t string").select("i", dynamic.decoded(F.col("t")).alias("j")).collect()
    assert {r.i: r.j for r in got} == {i: dynamic.decode_item(t) for i, t in enumerate(items)}


def test_retry_jitter_stays_within_bounds(spark):
    kind = "job_id int, table_key string, status string, retry_class string, attempt_count int, updated_at long, first_sequence long, created_at long"
    rows = [(i, f"t{i}", "failed", ("transient", "backpressure", "permanent")[i % 3], 3, 0, i, 0) for i in range(300)]
    j = spark.createDataFrame(rows, kind)
    n = [ledger.retry_due(j, now).count() for now in (50_000, 64_000, 77_000)]
    assert n[0] == 0 and 0 < n[1] < 200 and n[2] == 200
    due = [r.first_sequence for r in ledger.retry_due(j, 77_000).collect()]
    assert due == sorted(due) and ledger.retry_due(j, 64_000, jitter=False).count() == 200


def test_snapshot_scheduler():
    from tidelog.operators.snapshots import SnapshotScheduler, Task

    now, done, fails = [0.0], [], {"b2": 2, "d1": 1}

    def sleep(s):
        now[0] += s

    def work(name):
        def run():
            if name == "c1":
                raise PermissionError("no right to c")
            if fails.get(name, 0):
                fails[name] -= 1
                raise OSError("lost")
            done.append((name, now[0]))
        return run

    s = SnapshotScheduler(1, lambda: now[0], sleep, lambda attempt: 10.0 * attempt, lambda e: isinstance(e, PermissionError))
    for name in ("a1", "a2", "b1", "b2", "b3", "c1", "c2", "d1"):
        s.add(Task(name[0], work(name), upserts=name[0] == "b"))
    assert s.run() == {"c": "no right to c"}
    names = [n for n, _ in done]
    assert names[:3] == ["a1", "b1", "a2"] and set(names) == {"a1", "a2", "b1", "b2", "b3", "d1"}
    # the failed task of b is tried again after its delays, before the next one of b
    assert names.index("b2") < names.index("b3") and dict(done)["b2"] >= 30 and dict(done)["d1"] >= 10


def test_upserting_tasks_of_a_table_run_one_at_a_time():
    import threading
    import time

    from tidelog.operators.snapshots import SnapshotScheduler, Task

    active, most, lock = {"u": 0, "p": 0}, {"u": 0, "p": 0}, threading.Lock()

    def run(t):
        def work():
            with lock:
                active[t] += 1
                most[t] = max(most[t], active[t])
            time.sleep(0.05)
            with lock:
                active[t] -= 1
        return work

    s = SnapshotScheduler(4, time.monotonic, time.sleep, lambda a: 0.0, lambda e: True)
    for _ in range(4):
        s.add(Task("u", run("u"), upserts=True))
        s.add(Task("p", run("p")))
    assert s.run() == {} and most["u"] == 1 and most["p"] >= 2


def test_uncommitted_and_oversized_transactions(spark):
    from tidelog.streaming.decode import committed_changes

    kind = "position long, tx long, kind string, commit_lsn string, rel_id long, rel_ids array<long>, columns array<struct<name:string,type:string>>, before string, after string"
    rows = [(1, 1, "begin"), (2, 1, "insert"), (3, 1, "insert"), (4, 2, "begin"), (5, 2, "insert"), (6, 1, "commit")]
    m = spark.createDataFrame([(p, tx, k, "0/1" if k in ("begin", "commit") else None, 1, None, None, None, None) for p, tx, k in rows], kind)
    t = spark.createDataFrame([(1, "t")], "rel_id long, table string")
    assert [(r.tx, r.tx_ordinal) for r in committed_changes(m, t, 2).orderBy("tx_ordinal").collect()] == [(1, 0), (1, 1)]
    with pytest.raises(Exception, match="too many pending"):
        committed_changes(m, t, 1).collect()


_LOG = "position long, tx long, kind string, commit_lsn string, rel_id long, rel_ids array<long>, columns array<struct<name:string,type:string>>, before string, after string"


def test_many_relations_of_a_table_in_linear_time(spark):
    import time

    from tidelog.streaming.decode import committed_changes

    i = F.col("id")
    kind = F.when(i % 100 == 99, "commit").when(i % 2 == 0, "relation").otherwise("insert")
    columns = F.when(i % 2 == 0, F.array(F.struct(F.concat(F.lit("c"), i).alias("name"), F.lit("int8").alias("type"))))
    m = spark.range(60_000).select(i.alias("position"), F.expr("id div 100").alias("tx"), kind.alias("kind"), F.lit("0/1").alias("commit_lsn"), F.lit(1).cast("long").alias("rel_id"), F.lit(None).cast("array<long>").alias("rel_ids"), columns.alias("columns"), F.lit(None).cast("string").alias("before"), i.cast("string").alias("after"))
    began = time.monotonic()
    got = committed_changes(m, spark.createDataFrame([(1, "t")], "rel_id long, table string")).select("after", F.col("columns")[0]["name"].alias("name")).collect()
    assert {int(r.after): r.name for r in got} == {p: f"c{p - 1}" for p in range(1, 60_000, 2) if p % 100 != 99} and len(got) == 29_400
    assert time.monotonic() - began < 45  # some seconds; minutes if each change looked through its table's relations


def test_newest_relation_at_odd_positions(spark, monkeypatch):
    from tidelog.streaming import decode

    monkeypatch.setattr(decode, "SPAN", 8)
    rng = random.Random(5)
    ends = [-(2**63), 2**63 - 1]
    for places in (rng.sample(range(-300, 300), 200), [*ends, *rng.sample(range(1000), 60)], [*rng.sample(range(50), 40), *rng.sample(range(2**40, 2**40 + 200), 90)], [7], [2**63 - 1], []):
        rows = []
        for p in places:
            kind = rng.choice(("relation", "insert", "truncate", "insert"))
            columns = rng.choice((None, [], [(f"c{p}", "text")])) if kind == "relation" else None
            rows.append((p, p % 3, kind, None, rng.choice((1, 2, 3, None)), [1, 2], columns, None, str(p)))
        rows += [(None, 0, "relation", None, 1, None, [("nowhere", "text")], None, None), *((None, t, "commit", "0/1", None, None, None, None, None) for t in range(3))]
        rng.shuffle(rows)
        m = spark.createDataFrame(rows, _LOG).repartition(3)
        got = decode.committed_changes(m, spark.createDataFrame([(1, "1"), (2, "2")], "rel_id long, table string"))
        want = []
        for p, _, kind, _, rel, rels, _, _, after in rows:
            for of in (rels if kind == "truncate" else [rel] if kind == "insert" else []):
                if of in (1, 2):
                    last = max((r for r in rows if r[2] == "relation" and r[4] == of and r[0] is not None and r[0] < p), key=lambda r: r[0], default=None)
                    want.append((after, str(of), last and last[6]))
        assert sorted(((r.after, r.table, None if r.columns is None else [tuple(c) for c in r.columns]) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_shards_refuse_another_stream(spark):
    from tidelog.sources import shards

    s = spark.createDataFrame([("a",), ("b",)], "shard string")
    c = spark.createDataFrame([("a", "0099")], "shard string, sequence string")
    with pytest.raises(ValueError, match="rebuild"):
        shards.resume_points(s, c, None, "new", "old")
    assert sorted((r.shard, r.kind) for r in shards.resume_points(s, c, None, "x", None).collect()) == [("a", "AFTER_SEQUENCE_NUMBER"), ("b", "TRIM_HORIZON")]
    r = spark.createDataFrame([("a", x, 0) for x in ("98", "99", "100", "0101")] + [("b", "1", 0)], "shard string, sequence string, arrival_ms long")
    assert sorted(x.sequence for x in shards.unread(r, shards.resume_points(s, c, None, "x", None)).collect()) == ["0101", "1", "100"]


def test_boundaries_and_problems_are_errors(spark):
    from tidelog.operators import discovery
    from tidelog.streaming import triggers

    f = spark.createDataFrame([(True, False)], "landed boolean, applied boolean")
    assert triggers.acknowledged(f, "durable_enqueue", 10).first().acked and not triggers.acknowledged(f, "target_apply").first().acked
    for args in (("durable_enqueue",), ("other", 1)):
        with pytest.raises(ValueError):
            triggers.acknowledged(f, *args)
    with pytest.raises(ValueError, match="unknown whether idle"):
        triggers.feedback(F.lit(1), F.lit(0), {"in_tx": F.lit(True)})
    t = spark.createDataFrame([("a", None), ("b", "no primary key")], "name string, problem string")
    assert discovery.checked(t.where("name = 'a'")).count() == 1
    with pytest.raises(Exception, match="b: no primary key"):
        discovery.checked(t).collect()
    spark.sql("CREATE DATABASE IF NOT EXISTS found_here")
    spark.range(1).createOrReplaceTempView("passing")
    assert discovery.catalog_tables(spark, "found_here") == []


def test_other_tables_and_unknown_commits_fail(spark):
    df = spark.createDataFrame([(1, 0, "insert", 1, "u", "0/1")], "sequence long, tx_ordinal long, op string, id long, table string, commit_lsn string")
    with pytest.raises(Exception, match="not of table t"):
        changes.compact(df, ["id"], True, one_table="t").collect()
    with pytest.raises(Exception, match="a commit has no sequence"):
        changes.staging(df.drop("sequence"), commits=spark.createDataFrame([("0/2", 1)], "commit_lsn string, sequence long")).collect()


def test_strict_forms_fail(spark):
    for text, kind in (("x", "boolean"), ("1.5.2", "epoch"), ("2024-13-01", "date"), ("1e", "double")):
        with pytest.raises(Exception, match=f"not a {kind}"):
            one(spark, X.strict(F.lit(text), kind))
    assert one(spark, X.strict(F.lit("-3.2"), "epoch")) == -3_200_000 and one(spark, X.strict(F.lit(None).cast("string"), "long")) is None


def test_jdbc_scan_by_key_range(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(100).selectExpr("id", "id * 2 AS twice").write.jdbc(url, "numbers", properties=options)
    rows = dynamic.read_jdbc(spark, url, "numbers", "id", 0, 100, 4, **options)
    assert rows.rdd.getNumPartitions() == 4 and rows.where("id >= 90").agg(F.sum("twice")).first()[0] == sum(2 * i for i in range(90, 100))



def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "id", buckets=16)
    t.append(spark.range(200).selectExpr("id", "'a' AS v"))
    before = t.manifest()["parts"]
    t.write_batch(spark.createDataFrame([(5, "b"), (None, "n")], "id long, v string"), name="x")
    after = t.manifest()["parts"]
    assert 1 <= sum(after[b] != before.get(b) for b in after) <= 2
    rows = t.read().collect()
    assert len(rows) == 201 and [r.v for r in rows if r.id == 5] == ["b"]
    # the same name again: no version; NULL keys under another name: one more row
    assert t.write_batch(spark.createDataFrame([(5, "z")], "id long, v string"), name="x") == t.version() == 2
    t.write_batch(spark.createDataFrame([(None, "n")], "id long, v string"))
    assert t.read().where("id is null").count() == 2 and t.read(1).count() == 200


def test_appends_add_columns_and_compact(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "id", buckets=2)
    t.append(spark.createDataFrame([(1, "a")], "id long, V string"))
    for k in range(2, 6):
        t.append(spark.createDataFrame([(k, "b", k)], "id long, v string, extra long"))
    assert t.read().columns == ["id", "V", "extra"]
    want = [(1, "a", None)] + [(k, "b", k) for k in range(2, 6)]
    assert sorted(map(tuple, t.read().collect())) == want
    t.compact(1)
    assert all(len(ps) == 1 for ps in t.manifest()["parts"].values()) and sorted(map(tuple, t.read().collect())) == want
    t.expire(1)
    assert sorted(map(tuple, t.read().collect())) == want
    with pytest.raises(Exception):
        t.read(1)


def test_truncate_and_rows_are_one_version(spark, tmp_path):
    from tidelog.streaming.follow import apply_batch

    kind = "sequence long, tx_ordinal long, op string, table string, id long, v string"
    t = VersionedTable(spark, str(tmp_path / "t"), "id", buckets=4)
    batch = lambda *rows: spark.createDataFrame(list(rows), kind)
    apply_batch(t, batch((1, 0, "insert", "t", 1, "a")), 0, ["id", "v"], F.lit(7))
    cut = batch((2, 0, "insert", "t", 2, "b"), (2, 1, "truncate", "t", None, None), (2, 2, "insert", "t", 3, "c"))
    for _ in range(2):
        apply_batch(t, cut, 1, ["id", "v"], F.lit(7))
    assert t.version() == 2 and [r.id for r in t.read().collect()] == [3]


def test_two_writers_cannot_make_one_version(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "id", buckets=2)
    t.ensure(spark.range(1).schema)
    with pytest.raises(FileExistsError):
        t.files.create(f"{t.root}/manifests/{1:012d}.json", "{}")
    assert t.read().count() == 0


def test_event_time_merge_by_bucket(spark, tmp_path):
    kind = "id long, event_at long, event_id string, deleted_at long"
    t = VersionedTable(spark, str(tmp_path / "t"), "id", buckets=4)
    t.append(spark.createDataFrame([(1, 5, "a", None), (2, 5, "b", None)], kind))
    t.write_batch(spark.createDataFrame([(1, 6, "c", None), (2, 4, "z", None), (3, 9, "d", 9)], kind), merge=merge.event_time_merge)
    assert sorted((r.id, r.event_id) for r in t.read().collect()) == [(1, "c"), (2, "b")]


def test_window_joins_up_to_the_first_misfit(spark):
    kind = "connection_id string, table_key string, job_id string, first_sequence long, status string, stage string, barrier_kind string, reducer_eligible boolean, created_at long, updated_at long"
    row = lambda n, status="pending", stage="loaded", seq=None: ("c", "t", f"j{n:02}", seq or n, status, stage, None, True, n, n)
    jobs = spark.createDataFrame([row(1), row(2), row(3), row(4, stage="received"), row(5), row(6, seq=4)], kind)
    got = {r.job_id: r.ready for r in ledger.windows(jobs, 10_000, 0, 16, 0).collect()}
    # the misfit's own sequence still joins, later ones do not
    assert got == {"j01": True, "j02": True, "j03": True, "j06": True}
    assert not any(r.ready for r in ledger.windows(jobs, 10_000, 0, 16, 100_000).collect())
    assert len(ledger.windows(jobs, 10_000, 0, 2, 100_000).where("ready").collect()) == 2
    assert ledger.windows(spark.createDataFrame([row(1, status="failed"), row(2)], kind), 10_000, 0, 16, 0).count() == 0
    assert [r.job_id for r in ledger.claim(jobs, 10_000, 0, 2, 0).orderBy("place").collect()] == ["j01", "j02"]


def test_backoff_stays_within_its_limits(spark):
    rows = spark.range(1, 30).withColumn("n", F.col("id").cast("int")).select(X.backoff_seconds(F.col("n"), jitter_key=F.col("id").cast("string")).alias("s")).collect()
    assert all(16 <= r.s <= 1024 for r in rows)


def test_insight_without_samples_has_no_row(spark):
    from tidelog.operators import stats

    names = "failed_fragments failed_permanent_jobs snapshot_handoff_waiting_jobs failed_snapshot_handoff_jobs failed_retryable_jobs failed_unclassified_jobs failed_jobs rows_per_minute jobs_per_minute sequence_lag pending_fragments pending_jobs running_jobs wal_bytes_behind".split()
    kind = "sampler_status string, slot_active boolean, " + ", ".join(f"{n} long" for n in names)
    row = lambda sampler, **m: (sampler, None, *[m.get(n) for n in names])
    got = stats.insight(spark.createDataFrame([row("disabled"), row("disabled", pending_jobs=0), row("ok"), row("ok", failed_jobs=2, failed_retryable_jobs=2)], kind))
    assert sorted((r.status, r.blocker) for r in got.collect()) == [("backlogged", "retryable_job_backoff"), ("idle", "none"), ("unknown", "cdc_sampler")]


def test_change_records_are_decoded_whole_and_cut_by_shard(spark):
    from tidelog.plans import QUERIES
    from tidelog.sources import dynamic

    d = "/root/testdata/sf0.01"
    assert QUERIES["change_record_decode_all"](spark, d).count() == spark.read.parquet(f"{d}/events.parquet").count() > 5000
    body = '{"eventName":"INSERT","dynamodb":{"Keys":{"id":{"S":"k"}}}}'
    rows = [(f"s{s}", i, (s + 1) * 10 * i, body) for s in range(3) for i in range(10)] + [("s0", 10, 0, body)]
    got = dynamic.change_records(spark.createDataFrame(rows, "shard string, position long, arrival_ms long, body string"), cutoff_ms=60)
    assert {(r["event_id"]) for r in got.collect()} == {f"s{s}:{i}" for s, n in enumerate((7, 4, 3)) for i in range(n)}
