import datetime as dt

import pytest
from pyspark.sql import functions as F

from vela.operators import lineage as L
from vela.operators import versions as V
from vela.session import ensure_checkpoint_dir, scratch_path


def test_semantic_version_order(spark):
    log = V.VersionLog(spark, scratch_path(spark, "reg"))
    for v in ("1.0.0", "9.1.0", "10.0.0", "2.5.1"):
        log.register("m", v, metrics={"accuracy": 0.5})
    ev = log.read()
    assert V.latest_versions(ev).first()["latest_version"] == "10.0.0"
    order = [r.model_version for r in V.model_versions(ev).orderBy("version_rank").collect()]
    assert order == ["1.0.0", "2.5.1", "9.1.0", "10.0.0"]
    assert V.get_version(ev, "m").first()["model_version"] == "10.0.0"
    with pytest.raises(V.VersionNotFoundError, match="not found in registry"):
        V.get_version(ev, "other")
    with pytest.raises(V.VersionNotFoundError, match="Version 3.0.0"):
        V.get_version(ev, "m", "3.0.0")
    with pytest.raises(V.VersionNotFoundError):
        log.set_stage("m", "7.7.7", "Production")


def test_stage_fold_last_write_wins(spark):
    log = V.VersionLog(spark, scratch_path(spark, "reg"))
    log.register("m", "1.0.0", hyperparameters={"max_depth": 3}, metrics={"f1": 0.7})
    log.set_stage("m", "1.0.0", "Staging")
    log.set_stage("m", "1.0.0", "Production")
    ev = log.read()
    assert V.stages(ev).first()["stage"] == "Production"
    cmp = V.compare_versions(ev, "m").first()
    assert cmp["hp_max_depth"] == "3" and cmp["f1"] == 0.7 and cmp["stage"] == "Production"


def _io(spark, edges):
    rows = []
    for n, (a, b) in enumerate(edges):
        rows += [(f"r{n}", "input", "ns", a, None), (f"r{n}", "output", "ns", b, None)]
    return spark.createDataFrame(rows, "run_id string, side string, namespace string, name string, "
                                       "facets map<string,string>")


def _bfs(edges, start, reverse=False):
    adj = {}
    for a, b in edges:
        s, d = (b, a) if reverse else (a, b)
        adj.setdefault(s, set()).add(d)
    seen, frontier, depth, out = set(), {start}, 0, {}
    while frontier:
        depth += 1
        nxt = set()
        for x in frontier:
            for y in adj.get(x, ()):
                if y not in out:
                    out[y] = depth
                    nxt.add(y)
        frontier = nxt
        seen |= nxt
    return out


def test_closure_with_cycle_matches_bfs(spark):
    ensure_checkpoint_dir(spark)
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y"), ("b", "d")]
    io = _io(spark, edges)
    for direction in ("downstream", "upstream"):
        got = {}
        for r in L.closure(io, direction).collect():
            got.setdefault(r.origin, {})[r.node] = r.depth
        origins = {a for a, _ in edges} if direction == "downstream" else {b for _, b in edges}
        want = {o: _bfs(edges, o, direction == "upstream") for o in origins}
        assert got == want


def test_ingest_routes_bad_lines_and_dedupes(spark):
    path = scratch_path(spark, "events")
    log = L.LineageLog(spark, path)
    run = log.start("job_a", inputs=["table://t1"])
    log.complete(run, outputs=["model://m1"], facets={"score": 1})
    run2 = log.start("job_b")
    log.fail(run2, RuntimeError("boom"))
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(path)
    ev = L.read_events(spark, path)
    assert ev.where(F.col("error").isNotNull()).count() == 1
    runs = {r.run_id: r for r in L.runs(ev).collect()}
    assert runs[run["run_id"]].status == "COMPLETE"
    assert runs[run2["run_id"]].status == "FAIL" and runs[run2["run_id"]].error_message == "boom"
    assert L.run_io(ev).where("side = 'output'").first()["name"] == "model://m1"


def test_split_run_repair(spark):
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    rows = [("a", "START", t(1)), ("b", "COMPLETE", t(2)), ("c", "START", t(3)), ("d", "FAIL", t(4))]
    ev = spark.createDataFrame([(r, e, ts, "ns", "job", None) for r, e, ts in rows],
                               "run_id string, event_type string, event_time timestamp_ntz, job_namespace string,"
                               " job_name string, error string")
    got = [(r.start_run_id, r.end_run_id, r.status) for r in L.repair_split_runs(ev).orderBy("started_at").collect()]
    assert got == [("a", "b", "COMPLETE"), ("c", "d", "FAIL")]


def test_sequence_and_next_within_match_plain_windows_on_hot_key(spark):
    from pyspark.sql.window import Window

    from vela.operators.sequence import next_within, sequence_within

    # key 0 holds ~half of all rows, with tied timestamps broken by id
    df = spark.range(0, 4000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 37).alias("k"),
        (F.col("id") % 701).alias("t"), F.col("id"))
    w = Window.partitionBy("k").orderBy("t", "id")
    want = {(r.id, r.rn, r.nxt) for r in df.select("id", (F.row_number().over(w) - 1).alias("rn"),
                                                    F.lead("id").over(w).alias("nxt")).collect()}
    seq = sequence_within(df, ["k"], "t", ["id"], out="rn", buckets=8)
    nxt = next_within(df, ["k"], "t", ["id"], ["id"], buckets=8)
    got_rn = {r.id: r.rn for r in seq.collect()}
    got_nx = {r.id: r.next_id for r in nxt.collect()}
    assert {(i, got_rn[i], got_nx[i]) for i in got_rn} == want


def test_sequence_within_on_array_keys(spark):
    from pyspark.sql.window import Window

    from vela.operators.sequence import sequence_within

    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), (F.col("id") % 11).cast("string")))
        .alias("m"),
        F.array((F.col("id") % 13).cast("int"), (F.col("id") % 7).cast("int"), F.col("id").cast("int")).alias("v"))
    w = Window.partitionBy("m").orderBy("v")
    want = {(r.m, tuple(r.v), r.rn) for r in df.select("m", "v", (F.row_number().over(w) - 1).alias("rn")).collect()}
    got = {(r.m, tuple(r.v), r.seq) for r in sequence_within(df, ["m"], "v", buckets=8).collect()}
    assert got == want


def test_sequence_within_over_two_thousand_parts(spark):
    from vela.operators.sequence import next_within, sequence_within

    n = 200_000
    df = spark.range(n).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("m"),  # a third has no key
                               F.array((F.col("id") % 5).cast("int"), F.floor(F.col("id") / 5).cast("int")).alias("v"), "id")
    seq = sequence_within(df, ["m"], "v", ["id"], buckets=2000)
    hot = seq.where("m = 'hot'")
    assert seq.count() == n and hot.agg(F.max("seq"), F.count_distinct("seq")).first() == (hot.count() - 1, hot.count())
    pairs = hot.alias("a").join(hot.alias("b"), F.col("a.seq") + 1 == F.col("b.seq"))
    assert pairs.where(F.col("a.v") > F.col("b.v")).count() == 0
    nxt = next_within(df, ["m"], "v", ["id"], ["id"], buckets=200)
    assert nxt.where("next_id IS NULL").count() == 2
