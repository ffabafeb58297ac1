import pytest
from pyspark.sql import functions as F

from vela.session import scratch_path
from vela.sources import generators as G
from vela.sources import snapshots as S


@pytest.fixture()
def cat(spark):
    return S.SnapshotCatalog(spark, scratch_path(spark, "test-wh"), namespace="t")


def _df(spark, n=100, version="1.0.0", seed=42):
    return G.customer_dataset(spark.range(1, n + 1), version, seed)


def test_missing_table_and_snapshot(cat, spark):
    with pytest.raises(S.SnapshotNotFoundError):
        cat.read("nope")
    cat.write(_df(spark), "c")
    with pytest.raises(S.SnapshotNotFoundError):
        cat.read("c", snapshot_id=7)


def test_time_travel_after_later_writes(cat, spark):
    first = _df(spark)
    cat.write(first, "c")
    cat.write(_df(spark, 50, "2.0.0", 43), "c")
    cat.write(_df(spark, 30, "3.0.0", 44), "c")
    assert sorted(cat.read("c", snapshot_id=1).collect()) == sorted(first.collect())
    assert cat.read("c").count() == 30
    assert cat.snapshot_ids("c") == [1, 2, 3]


def test_append_keeps_previous_files(cat, spark):
    cat.write(_df(spark, 40), "c")
    info = cat.write(_df(spark, 60, seed=7), "c", mode="append")
    assert info["row_count"] == 100 and info["added_rows"] == 60
    assert cat.read("c").count() == 100
    assert cat.read("c", snapshot_id=1).count() == 40


def test_failed_write_is_logged_and_skipped(cat, spark):
    cat.write(_df(spark), "c")
    bad = _df(spark).withColumn("Age", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        cat.write(bad, "c")
    log = {r["snapshot_id"]: r["status"] for r in cat.log().collect()}
    assert log == {1: "committed", 2: "error"}
    assert cat.read("c").count() == 100
    # the next commit does not reuse the failed id
    assert cat.write(_df(spark, 10), "c")["snapshot_id"] == 3


def test_rollback(cat, spark):
    cat.write(_df(spark, 10), "c")
    cat.write(_df(spark, 20), "c")
    cat.rollback("c", 1)
    assert cat.read("c").count() == 10
    assert [r["operation"] for r in cat.history("c").collect()] == ["overwrite", "overwrite", "rollback"]


def test_projection_and_filter_reach_the_scan(cat, spark):
    cat.write(G.credit_dataset(spark.range(1, 200), "2.0.0"), "f", partition_by=["MerchantCategory"])
    df = cat.read("f", columns=["TransactionId", "Amount"],
                  where=(F.col("MerchantCategory") == "online") & (F.col("Amount") > 10))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "online" in plan
    assert "PushedFilters" in plan and "Amount" in plan
    assert "ReadSchema: struct<TransactionId:string,Amount:double>" in plan
    assert df.count() == cat.read("f").where("MerchantCategory = 'online' AND Amount > 10").count()


def test_stats_and_evolved_union(cat, spark):
    cat.write(_df(spark, 10, "1.0.0"), "c")
    cat.write(_df(spark, 10, "2.0.0"), "c")
    row = cat.committed().where("snapshot_id = 1").first()
    assert row["row_count"] == 10 and row["added_files"] >= 1 and row["added_bytes"] > 0
    assert set(row["null_counts"].values()) == {0}
    u = S.tagged_union({i: cat.read("c", snapshot_id=i) for i in (1, 2)})
    assert u.where("snapshot_id = 1 AND HasPhoneService IS NULL").count() == 10
    assert u.where("snapshot_id = 2 AND HasPhoneService IS NOT NULL").count() == 10


def test_diff(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "Z"), (4, "w")], "k int, v string")
    got = {r["k"]: r["change"] for r in S.snapshot_diff(a, b, ["k"]).collect()}
    assert got == {1: "removed", 2: "unchanged", 3: "changed", 4: "added"}


def test_footer_null_counts_with_nulls_and_partitions(cat, spark):
    df = spark.range(0, 1000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") * 2).alias("x"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit("s")).alias("s"),
        (F.col("id") % 4).alias("p"))
    cat.write(df, "n", partition_by=["p"])
    row = cat.committed().where("table_identifier = 't.n'").first()
    assert row["row_count"] == 1000
    assert row["null_counts"]["x"] == 334 and row["null_counts"]["s"] == 143
    assert row["null_counts"]["id"] == 0 and row["null_counts"]["p"] == 0
    assert cat.read("n").where("x IS NULL").count() == 334


def test_read_as_of_timestamp(cat, spark):
    import datetime as dt
    import time

    cat.write(_df(spark, 10), "c")
    time.sleep(1.1)
    mid = dt.datetime.now()
    time.sleep(1.1)
    cat.write(_df(spark, 20), "c")
    assert cat.read("c", as_of=mid).count() == 10
    assert cat.read("c").count() == 20


def test_append_with_evolved_schema(cat, spark):
    cat.write(_df(spark, 10, "1.0.0"), "c")
    cat.write(_df(spark, 5, "2.0.0"), "c", mode="append")
    got = cat.read("c")
    assert got.columns[:7] == G.CUSTOMER_COLUMNS["1"] and "HasPhoneService" in got.columns
    assert got.where("HasPhoneService IS NULL").count() == 10 and got.count() == 15
    bad = _df(spark, 5).withColumn("Age", F.col("Age").cast("string"))
    with pytest.raises(ValueError, match="changes type"):
        cat.write(bad, "c", mode="append")


def test_append_to_partitioned_table(cat, spark):
    cat.write(G.credit_dataset(spark.range(1, 101), "2.0.0"), "p", partition_by=["MerchantCategory"])
    cat.write(G.credit_dataset(spark.range(101, 201), "2.0.0"), "p", mode="append", partition_by=["MerchantCategory"])
    df = cat.read("p", where=F.col("MerchantCategory") == "online")
    full = G.credit_dataset(spark.range(1, 201), "2.0.0").where("MerchantCategory = 'online'")
    assert sorted(df.collect()) == sorted(full.collect())
    assert cat.read("p").count() == 200
    assert "PartitionFilters" in df._jdf.queryExecution().executedPlan().toString()


def test_orphan_folder_id_is_not_reused(cat, spark):
    cat.write(_df(spark, 10), "c")
    # simulate a crash after the data write of snapshot 2, before its log row
    _df(spark, 5).write.parquet(f"{cat.warehouse}/t/c/snapshot-00000002")
    info = cat.write(_df(spark, 7), "c")
    assert info["snapshot_id"] == 3 and cat.read("c").count() == 7


def _profile(cat, table, sid):
    return {r.column_name: r for r in S.profile(cat.committed().where((F.col("table_identifier") == f"t.{table}") & (F.col("snapshot_id") == sid))).collect()}


def test_statistics_of_every_type_and_of_columns_without_values(cat, spark):
    nan = float("nan")
    rows = [(1, None, 1.5, "b", True, "2024-01-02 03:04:05.5"), (2, None, nan, "é", False, "1999-12-31 00:00:00"), (3, None, -2e30, None, None, None)]
    df = spark.createDataFrame(rows, "id int, none double, x double, s string, f boolean, ts string").withColumns(
        {"ts": F.col("ts").cast("timestamp_ntz"), "d": F.to_date("ts"), "m": F.col("id").cast("decimal(10,2)") * -10, "a": F.array("id")})
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.parquet.aggregatePushdown", "spark.sql.sources.useV1SourceList")}
    cat.write(df.repartition(3, "id"), "s", distinct=["id", "s"])  # files without any value of some columns
    assert {k: spark.conf.get(k, None) for k in before} == before
    p = _profile(cat, "s", 1)
    assert {c: r.null_count for c, r in p.items()} == {"id": 0, "none": 3, "x": 0, "s": 1, "f": 1, "ts": 1, "d": 1, "m": 0, "a": 0}
    assert (p["id"].min_value, p["id"].max_value) == (1, 3) and (p["s"].min_text, p["s"].max_text) == ("b", "é")
    assert (p["f"].min_text, p["f"].max_text) == ("false", "true") and p["d"].min_text == "1999-12-31" and p["ts"].max_text == "2024-01-02 03:04:05.5"
    assert p["x"].min_value == -2e30 and p["x"].max_text == "NaN" and (p["m"].min_value, p["m"].max_value) == (-30, -10)
    assert p["none"].min_text is None and p["a"].min_text is None and p["id"].distinct_values == 3 and p["s"].distinct_values == 2


def test_statistics_of_an_evolved_append_cover_the_union_of_the_columns(cat, spark):
    cat.write(spark.createDataFrame([(1, "x"), (2, None)], "id int, old string"), "e", distinct=["id"])
    cat.write(spark.createDataFrame([(10, 5.0), (2, None), (9, 7.0)], "id int, new double"), "e", mode="append", distinct=["id"])
    p = _profile(cat, "e", 2)
    assert {c: r.null_count for c, r in p.items()} == {"id": 0, "old": 4, "new": 3}
    assert (p["id"].min_value, p["id"].max_value, p["new"].max_value, p["old"].min_text) == (1, 10, 7.0, "x")  # 10 is above 9 as a number
    assert p["id"].distinct_values == 4 and p["id"].row_count == 5
    got = cat.read("e")
    assert {c: got.where(F.col(c).isNull()).count() for c in got.columns} == {c: r.null_count for c, r in p.items()}


def test_folders_keep_their_own_partition_spec(cat, spark):
    df = spark.range(90).select("id", (F.col("id") % 3).cast("int").alias("a"), F.concat(F.lit("k"), F.col("id") % 5).alias("b"))
    for k, parts in enumerate(([], ["a"], ["b", "a"])):
        cat.write(df.where(f"id % 9 DIV 3 = {k}"), "m", mode="append", partition_by=parts)
    got = cat.read("m", where="a = 1 AND b = 'k2'")
    assert sorted(got.collect()) == sorted(df.where("a = 1 AND b = 'k2'").collect()) and cat.read("m").count() == 90
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull") == 2
    assert cat.read("m", snapshot_id=2).count() == 60
    cat.rollback("m", 2)
    assert cat.read("m").count() == 60


def test_many_snapshots_are_one_scan(cat, spark):
    base = spark.range(10).select("id", F.lit(1).alias("v"))
    cat.write(base, "h")
    for _ in range(3):
        cat.write(base.withColumn("w", F.lit(2)), "h", mode="append")
    for k in range(96):
        cat.rollback("h", 1 + k % 4)
    every = cat.read_all("h")
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and len(cat.snapshot_ids("h")) == 100
    want = {r.snapshot_id: r.row_count for r in cat.committed().where("table_identifier = 't.h'").collect()}
    assert {r.snapshot_id: r["count"] for r in every.groupBy("snapshot_id").count().collect()} == want
    two = cat.read_all("h", [1, 2])
    assert two.where("w IS NULL").count() == 20 and two.count() == 30
    with pytest.raises(S.SnapshotNotFoundError):
        cat.read_all("h", [1, 777])


def test_failures_end_the_lineage_run_and_are_logged(spark):
    from vela.operators import lineage as L

    path = scratch_path(spark, "lineage")
    cat = S.SnapshotCatalog(spark, scratch_path(spark, "test-wh"), namespace="t", lineage=L.LineageLog(spark, path))
    cat.write(spark.range(3), "c")
    with pytest.raises(ValueError, match="changes type"):
        cat.write(spark.range(3).select(F.col("id").cast("string")), "c", mode="append")
    assert sorted(r.status for r in L.runs(L.read_events(spark, path)).collect()) == ["COMPLETE", "FAIL"]
    assert {r.snapshot_id: r.status for r in cat.log().collect()} == {1: "committed", 2: "error"}
    w = L.table_writes(L.read_events(spark, path)).first()
    assert (w.table_identifier, w["mode"], w.rows) == ("t.c", "overwrite", 3)


def test_commit_time_is_that_of_the_commit(cat, spark, monkeypatch):
    import datetime as dt

    seen = []
    summary = S.SnapshotCatalog._summary
    monkeypatch.setattr(S.SnapshotCatalog, "_summary", lambda self, path: (seen.append(dt.datetime.now()), summary(self, path))[1])
    cat.write(spark.range(4), "c")
    assert seen[0] <= cat.committed().first()["committed_at"] <= dt.datetime.now()  # the data was there before
