"""Nested facets of both shapes, column references of filters, and the event stream's exactly-once tables."""

import json
import re

import pytest
from pyspark.sql import functions as F

from vela.operators import lineage as L
from vela.plans import catalog, lineage_queries
from vela.session import scratch_path


def event(kind="COMPLETE", run="r", time="2024-01-01T00:00:00Z", job=None, inputs=(), outputs=()):
    return json.dumps({"eventType": kind, "eventTime": time, "run": {"runId": run}, "job": {"namespace": "n", "name": "j", "facets": job or {}},
                       "inputs": list(inputs), "outputs": list(outputs), "producer": "p"})


def parsed(spark, *lines):
    return L.parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))


NESTED = {"_producer": "p", "_schemaURL": "u"}


def test_models_of_both_shapes(spark):
    nested = {"namespace": "n", "name": "model://a", "facets": {
        "version": {**NESTED, "version": "1.10"}, "model": {**NESTED, "type": "forest", "metrics": {"auc": 0.75}, "hyperparams": {"depth": 3, "names": ["x", "y"]}}}}
    bare = {"namespace": "n", "name": "model://b", "facets": {"version": "2.0", "metrics": {"auc": 0.5}, "model_type": "boosting", "feature_count": 7}}
    io = L.run_io(parsed(spark, event(outputs=[nested, bare, {"namespace": "n", "name": "model://c"}])))
    got = {(r.model, r.version, r.kind, r.key, r.value) for r in L.model_facets(io).collect()}
    assert got == {("model://a", "1.10", "metric", "auc", "0.75"), ("model://a", "1.10", "hyperparameter", "depth", "3"),
                   ("model://a", "1.10", "hyperparameter", "names", '["x","y"]'), ("model://a", "1.10", "property", "type", "forest"),
                   ("model://b", "2.0", "metric", "auc", "0.5"), ("model://b", "2.0", "property", "type", "boosting"), ("model://b", "2.0", "property", "feature_count", "7")}
    assert {r.name: r.version for r in L.dataset_details(io).collect()} == {"model://a": "1.10", "model://b": "2.0", "model://c": None}


def test_a_later_facet_replaces_the_whole_earlier_one(spark):
    ev = parsed(spark, event("START", job={"f": {"a": 1, "b": 2}, "g": "x"}), event("COMPLETE", time="2024-01-01T00:00:01Z", job={"f": {**NESTED, "a": 3}, "h": None}))
    assert {(r.facet, r.field, r.value) for r in L.job_facets(ev).collect()} == {("f", "a", "3"), ("g", "value", "x"), ("h", "value", None)}


def test_virtual_outputs_are_no_datasets(spark):
    out = {"namespace": "n", "name": "inference_result_j", "facets": {"virtual": {**NESTED, "isVirtual": True}}}
    io = L.run_io(parsed(spark, event(outputs=[out, {"namespace": "n", "name": "t", "facets": {"virtual": {"isVirtual": False}}}])))
    assert [r.name for r in L.dataset_details(io).collect()] == ["t"] and io.count() == 2


@pytest.mark.parametrize("text, columns", [
    ("age > 30 AND contract = 'AND age'", ["age", "contract"]), ("lower(name) LIKE 'a%' OR cast(x AS int) IS NULL", ["name", "x"]),
    ("`odd name` BETWEEN 1 AND 5e3", ["odd name"]), ("t.a.b = 'it''s' and not (c in (1, 2))", ["t.a.b", "c"]), ("1 = 1", []), ("", []), (None, None),
    ("case when flag then a else b end > 0", ["flag", "a", "b"])])
def test_filter_columns(spark, text, columns):
    got = spark.createDataFrame([(text,)], "f string").select(L.filter_columns(F.col("f")).alias("c")).first().c
    assert got == columns


def test_column_usage_counts_reads(spark):
    def read(run, filter_, selected):
        return event(run=run, job={L.READ_FACET: {**NESTED, "table_identifier": "d.t", "filter": filter_, "selected_fields": selected, "snapshot_id": 1}})

    ev = parsed(spark, read("a", "x > 1", ["x", "y"]), read("b", None, L.ALL_FIELDS), read("c", "x < 1 and x <> 0", ["x"]))
    assert {r.column_name: (r.selected, r.filtered) for r in L.column_usage(ev).collect()} == {"x": (2, 2), "y": (1, 0)}
    usage = L.table_usage(ev).first()
    assert (usage.reads, usage.writes, usage.rows_written) == (3, 0, 0)


def test_stream_keeps_late_events_once_through_restarts(spark):
    src, sink, ck = (scratch_path(spark, n) for n in ("src", "sink", "ck"))
    lines = [event("START", "a", "2024-01-01T00:00:00Z"), event("COMPLETE", "a", "2024-01-03T00:00:00Z"), event("START", "b", "2024-01-02T12:00:00Z")]
    rounds = [[lines[1], lines[1], "{broken"], [lines[0], lines[1]], [lines[2], lines[0]], []]
    for part in rounds:
        if part:
            spark.createDataFrame([(x,) for x in part], "value string").write.mode("append").text(src)
        L.ingest_stream(spark, src, sink, ck).awaitTermination()
    got = L.ingested(spark, sink)
    assert sorted((r.run_id, r.event_type) for r in got.collect()) == [("a", "COMPLETE"), ("a", "START"), ("b", "START")]
    assert L.runs(got.withColumn("error", F.lit(None).cast("string"))).count() == 2
    # a batch that is run again writes its own folder anew
    again = scratch_path(spark, "ck")
    L.ingest_stream(spark, src, sink, again).awaitTermination()
    assert L.ingested(spark, sink).count() == 3


def _parses(df):
    return len(re.findall(r"Project \[from_json", df._jdf.queryExecution().executedPlan().toString()))


def test_lines_are_parsed_in_one_pass_and_bad_ones_all_kept(spark):
    lines = [event("START"), event("START"), event("COMPLETE", time="2024-01-01T00:00:01Z"), "{broken", "{broken", event(time="never"), event(time="never")]
    ev = parsed(spark, *lines)
    assert sorted((r.event_type or "", r.error is None) for r in ev.select("event_type", "error").collect()) == [
        ("", False), ("", False), ("COMPLETE", False), ("COMPLETE", False), ("COMPLETE", True), ("START", True)]
    assert _parses(ev) == _parses(ev.where("error IS NULL")) == 1


@pytest.mark.parametrize("name", ["lineage_run_kinds", "lineage_downstream", "lineage_upstream", "namespace_summary", "lineage_impact", "lineage_inventory",
                                  "lineage_training_runs", "lineage_provenance", "lineage_inference_runs", "lineage_model_facets", "lineage_table_usage"])
def test_queries_parse_their_lines_once(spark, sf, name):
    assert _parses(catalog.queries()[name](spark, sf)) <= (name == "lineage_model_facets")  # others read the events from a scratch table


def test_null_columns_leave_no_lines_but_malformed_ones(spark):
    rows = [(5, None, 1, "click", "{}"), (50, "2024-01-01 00:00:00", None, "click", "{}"), (None, "2024-01-01 00:00:00", 3, "click", "{}"), (100, "2024-01-01 00:00:00", 4, "view", None)]
    events = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, props string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = [r.value for r in lineage_queries.event_lines(events).collect()]
    assert None not in got and '{"eventType":"START", broken 5' in got and sum('"runId":"4-0"' in x for x in got) == 2
