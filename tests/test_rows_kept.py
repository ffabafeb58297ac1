"""No operator loses rows: deep graphs, malformed and late input, missing keys, equal times."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vela.operators import features as FE
from vela.operators import lineage as L
from vela.operators import versions as V
from vela.session import scratch_path
from vela.streaming import scoring as ST


def _io(spark, pairs):
    rows = []
    for run, (src, dst) in enumerate(pairs):
        rows += [(f"r{run}", "input", "n", src), (f"r{run}", "output", "n", dst)]
    return spark.createDataFrame(rows, "run_id string, side string, namespace string, name string")


def test_closure_follows_a_chain_of_seventy_hops(spark):
    io = _io(spark, [(f"d{k}", f"d{k + 1}") for k in range(70)])
    seed = spark.createDataFrame([("d0",)], "origin string")
    got = {r.node: r.depth for r in L.closure(io, "downstream", seed).collect()}
    assert got == {f"d{k}": k for k in range(1, 71)}


def test_closure_of_a_cycle_and_a_hub(spark):
    io = _io(spark, [("a", "b"), ("b", "a"), *[("hub", f"x{k}") for k in range(50)]])
    got = {(r.origin, r.node): r.depth for r in L.closure(io, "downstream").collect()}
    assert got == {("a", "b"): 1, ("a", "a"): 2, ("b", "a"): 1, ("b", "b"): 2} | {("hub", f"x{k}"): 1 for k in range(50)}


def test_missing_keys_are_tested_on(spark):
    df = spark.range(100).select(F.when(F.col("id") % 5 != 0, F.col("id")).alias("k"), "id")
    for train, test in (FE.split_hash(df, "k"), FE.split_prefix(df, "k")):
        assert train.count() + test.count() == 100
        assert train.where("k IS NULL").count() == 0 and test.where("k IS NULL").count() == 20


def test_bad_lines_and_times_keep_an_error(spark):
    path = scratch_path(spark, "bad-lines")
    good = '{"eventType":"START","eventTime":"%s","run":{"runId":"%s"},"job":{"namespace":"n","name":"j"}}'
    lines = [good % ("2024-01-01T02:00:00+02:00", "a"), good % ("2024-01-01T00:00:00Z", "b"), good % ("2024-01-01T00:00:00.5", "c"),
             good % ("no time", "d"), "{broken", good % ("2024-01-01T00:00:00Z", "b")]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    rows = L.read_events(spark, path).collect()
    assert len(rows) == 5 and sum(r.error is not None for r in rows) == 2
    times = {r.run_id: str(r.event_time) for r in rows if r.error is None}
    assert times == {"a": "2024-01-01 00:00:00", "b": "2024-01-01 00:00:00", "c": "2024-01-01 00:00:00.500000"}


def test_terminal_event_wins_at_equal_time(spark):
    path = scratch_path(spark, "ties")
    line = '{"eventType":"%s","eventTime":"2024-01-01T00:00:00Z","run":{"runId":"a"},"job":{"namespace":"n","name":"j","facets":{"f":"%s"}}}'
    spark.createDataFrame([(line % (t, t),) for t in ("START", "COMPLETE")], "value string").write.text(path)
    ev = L.read_events(spark, path)
    assert L.runs(ev).first().status == "COMPLETE"
    assert L.job_facets(ev).first().value == "COMPLETE"


def test_odd_versions_do_not_end_the_job(spark):
    rows = [("m", "9"), ("m", "10"), ("m", "1.0.1-rc1")]
    df = spark.createDataFrame(rows, "m string, v string")
    assert df.agg(F.max_by("v", V.version_key("v"))).first()[0] == "10"


def test_empty_record_array_has_an_error(spark):
    schema = T.StructType([T.StructField("k", T.LongType())])
    df = spark.createDataFrame([(1, "[]"), (2, '[{"k": 3}]')], "id bigint, p string")
    rows = {r.id: r for r in FE.parse_records(df, "p", schema, "id").collect()}
    assert rows[1].error == "no records" and rows[2].k == 3 and rows[2].error is None


def test_late_events_are_counted(spark):
    from datetime import datetime

    src, sink, ck = (scratch_path(spark, n) for n in ("late-src", "late-sink", "late-ck"))
    schema = "ts timestamp_ntz, event_type string, value double"
    for day in (2, 1):  # the earlier day comes last
        spark.createDataFrame([(datetime(2024, 1, day, 5), "a", float(day)), (datetime(2024, 1, day, 5), "a", None)], schema).write.mode("append").parquet(src)
        ST.event_counters_stream(spark, src, spark.read.parquet(src).schema, sink, ck).awaitTermination()
    rows = ST.fold_counters(spark.read.parquet(sink), ["window_start", "event_type"]).collect()
    assert sorted((r.window_start.day, r.requests, r.mean_value) for r in rows) == [(1, 2, 1.0), (2, 2, 2.0)]


def _bfs(pairs, seeds):
    out = {}
    for origin in seeds:
        front, depth = {origin}, 0
        while front:
            depth += 1
            front = {b for a, b in pairs if a in front and (origin, b) not in out}
            out |= {(origin, b): depth for b in front}
    return out


def _impact(spark, pairs, seeds, direction="downstream"):
    got = L.impact(_io(spark, pairs), spark.createDataFrame([(s,) for s in seeds], "origin string"), direction)
    rows = [(r.origin, r.node, r.depth) for r in got.collect()]
    assert len(rows) == len({r[:2] for r in rows})
    return {r[:2]: r[2] for r in rows}


def test_impact_of_a_long_chain_and_a_large_ring_takes_few_rounds(spark):
    from vela.operators import reach as R
    chain = [(f"d{k}", f"d{k + 1}") for k in range(70)]
    ring = [(f"r{k}", f"r{(k + 1) % 1000}") for k in range(1000)]
    pairs = [*chain, *ring, ("d35", "r10"), ("r500", "tail")]
    seeds = ["d0", "r700", "r700", "nowhere"]
    assert _impact(spark, pairs, seeds) == _bfs(pairs, seeds)
    edges = spark.createDataFrame(pairs, "src string, dst string").withColumn("length", F.lit(1))
    short, _ = R.condense(edges, spark.createDataFrame([(s,) for s in seeds], "node string"))
    assert short.count() <= 8  # what stands between the seeds, the junctions and the ends


def test_a_stretch_is_condensed_in_rounds_of_its_logarithm_and_rings_are_not_compared(spark, monkeypatch):
    from vela.operators import reach as R
    ring = [(f"r{k}", f"r{(k + 1) % 300}") for k in range(300)] + [(f"s{k}", f"s{(k + 1) % 5}") for k in range(5)]  # the second has no seed
    edges = spark.createDataFrame(ring, "src string, dst string").withColumn("length", F.lit(1))
    pins, rounds = spark.createDataFrame([("r0",), ("r7",)], "node string"), []
    whole = type(edges).checkpoint
    monkeypatch.setattr(type(edges), "checkpoint", lambda df, *a, **k: rounds.append(1) or whole(df, *a, **k))
    short, removed = R.condense(edges, pins)
    assert len(rounds) <= 20
    assert sorted(tuple(r) for r in short.collect()) == [("r0", "r7", 7), ("r7", "r0", 293)]
    assert sorted(r.offset for r in removed.collect()) == sorted([*range(1, 7), *range(1, 293)])


def test_impact_equals_search_on_random_graphs(spark):
    import random
    rnd = random.Random(5)
    pairs = [(f"n{rnd.randrange(30)}", f"n{rnd.randrange(30)}") for _ in range(40)]
    pairs += [("n29", "x0"), *[(f"x{k}", f"x{k + 1}") for k in range(8)], ("n1", "n1"), ("x3", "n2")]
    seeds = ["n0", "n1", "x2"]
    assert _impact(spark, pairs, seeds, "upstream") == _bfs([(b, a) for a, b in pairs], seeds)


def test_impact_without_edges_or_seeds_and_with_null_names(spark):
    assert _impact(spark, [("a", "b")], []) == {}
    assert _impact(spark, [], ["a"]) == {}
    assert _impact(spark, [("a", None), (None, "c"), ("a", "b")], ["a", None]) == {("a", "b"): 1}


def test_stored_metrics_of_a_scoring_stream_survive_a_restart(spark):
    src, sink, metrics, ck = (scratch_path(spark, n) for n in ("src", "sink", "metrics", "ck"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType())])
    run = lambda: ST.score_batches(spark, src, schema, F.col("x"), ["id"], sink, metrics, ck, threshold=0.5,
                                   checks=lambda: F.when(F.col("x").isNull(), "no x")).awaitTermination()
    for lines in (['{"id":1,"x":0.25}', "broken", '{"id":2,"x":0.75}'], ['{"id":3}', '{"id":4,"x":0.5}']):
        spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.mode("append").text(src)
        run()
    run()  # nothing new: no batch, no count
    got = ST.fold_metrics(ST.scoring_metrics(spark, metrics)).first()
    assert (got.batches, got.requests, got.errors, got.positives, got.scored, got.mean_probability) == (2, 5, 2, 2, 3, 0.5)
    assert got.mean_latency_ms > 0
    assert {(r.id, r.prediction, r.error) for r in spark.read.parquet(sink).collect()} == {
        (1, False, None), (2, True, None), (None, None, "broken"), (3, None, "no x"), (4, True, None)}
    none = ST.fold_metrics(spark.createDataFrame([], ST.METRICS)).first()
    assert (none.batches, none.requests, none.mean_probability) == (0, 0, None)
