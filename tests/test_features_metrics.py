import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vela.operators import features as FE
from vela.operators import metrics as M


def test_hash_split_disjoint_and_complete(spark):
    df = spark.range(1, 2001).withColumnRenamed("id", "k")
    tr, te = FE.split_hash(df, "k", 0.8, 42)
    a, b = {r.k for r in tr.collect()}, {r.k for r in te.collect()}
    assert not a & b and len(a | b) == 2000
    assert 0.75 < len(a) / 2000 < 0.85


def test_prefix_split_matches_reference_rule(spark):
    df = spark.range(0, 1003).withColumn("k", (F.col("id") * 7919) % 1009).drop("id")
    tr, te = FE.split_prefix(df, "k", 0.8)
    keys = sorted(r.k for r in df.collect())
    cut = int(len(keys) * 0.8)
    assert sorted(r.k for r in tr.collect()) == keys[:cut]
    assert sorted(r.k for r in te.collect()) == keys[cut:]


def test_kth_smallest_multi_round(spark):
    rnd = random.Random(3)
    vals = [rnd.randint(0, 10**9) for _ in range(5000)]
    vals = list(dict.fromkeys(vals))
    df = spark.createDataFrame([(v,) for v in vals], "k long").repartition(7)
    s = sorted(vals)
    for k in (1, 17, len(s) // 2, len(s)):
        assert FE.kth_smallest(df, "k", k, buckets=8) == s[k - 1]


def test_kth_smallest_of_any_type_by_one_path(spark):
    base = spark.range(3000).selectExpr("id * 7919 % 3001 AS i")
    kinds = {"string": "concat('C-', i)", "decimal": "cast(i / 10 AS decimal(12, 3))", "date": "date_add(DATE '1990-01-01', cast(i AS int))",
             "double": "i / 7", "repeated": "concat('x', if(i < 2900, 500, i))"}
    for kind, sql in kinds.items():
        df = base.selectExpr(f"{sql} AS k")
        want = sorted(r.k for r in df.collect())
        for k in (1, 1234, 3000):
            assert FE.kth_smallest(df, "k", k, buckets=40) == want[k - 1], (kind, k)
    train, test = FE.split_prefix(base.selectExpr("concat('C-', i) AS key"), "key", 0.8)
    assert (train.count(), test.count()) == (2400, 600)
    assert train.agg({"key": "max"}).first()[0] < test.agg({"key": "min"}).first()[0]


def test_one_hot_unknown_is_zero_and_drop_first(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "x string")
    vocab = FE.fit_vocabulary(train, ["x"])
    assert vocab == {"x": ["a", "b", "c"]}
    test = spark.createDataFrame([("a",), ("zzz",)], "x string")
    rows = FE.one_hot(test, vocab).collect()
    assert [tuple(r) for r in rows] == [(1.0, 0.0, 0.0), (0.0, 0.0, 0.0)]
    assert FE.one_hot(test, vocab, drop_first=True).columns == ["x_b", "x_c"]


def test_vocabulary_cardinality_guard(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("x"))
    with pytest.raises(ValueError):
        FE.fit_vocabulary(df, ["x"], max_categories=10)


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    stats = FE.fit_standard_scaler(df, ["a", "b"])
    out = FE.standard_scale(df, stats).collect()
    assert [round(r.a, 6) for r in out] == [-1.224745, 0.0, 1.224745]
    assert [r.b for r in out] == [0.0, 0.0, 0.0]


def test_align_fill_and_strict(spark):
    want = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("s", T.StringType()),
                         T.StructField("f", T.BooleanType())])
    df = spark.createDataFrame([(7, "id1")], "a int, extra string")
    row = FE.align_features(df, want).first()
    assert (row.a, row.s, row.f, row.extra) == (7, "0", False, "id1")
    with pytest.raises(ValueError, match="s"):
        FE.align_features(df, want, strict=True)


def test_parse_records(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    df = spark.createDataFrame([(1, '{"k": 1}'), (2, '[{"k": 2}, {"k": 3}]'), (3, '{"k": '), (4, None), (5, "7")],
                               "rid int, p string")
    got = sorted((r.rid, r.item_index, r.k, r.error) for r in FE.parse_records(df, "p", schema, "rid").collect())
    assert got == [(1, 0, 1, None), (2, 0, 2, None), (2, 1, 3, None), (3, 0, None, "malformed JSON"),
                   (4, 0, None, "malformed JSON"), (5, 0, None, "unsupported payload")]


def _auc_brute(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_matches_pairwise_with_ties(spark):
    rnd = random.Random(5)
    rows = [(round(rnd.random(), 2), rnd.random() < 0.3) for _ in range(600)]
    df = spark.createDataFrame(rows, "s double, y boolean")
    for b in (1, 4, 16):
        got = M.roc_auc(df, "y", "s", buckets=b).first()["roc_auc"]
        assert abs(got - _auc_brute(rows)) < 1e-12


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, True), (0.5, True)], "s double, y boolean")
    assert M.roc_auc(df, "y", "s").first()["roc_auc"] is None


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([(False, False), (True, False)], "y boolean, p boolean")
    r = M.classification_metrics(df, "y", "p").first()
    assert (r.tn, r.fp, r.fn, r.tp) == (1, 0, 1, 0)
    assert (r.accuracy, r.precision, r.recall, r.f1) == (0.5, 0.0, 0.0, 0.0)


def test_rows_without_label_or_score_are_counted(spark):
    df = spark.createDataFrame([(True, True, 0.9), (False, False, 0.1), (None, True, 0.5), (True, None, None)],
                               "y boolean, p boolean, s double")
    r = M.classification_metrics(df, "y", "p").first()
    assert (r.tn, r.tp, r.unjudged, r.accuracy) == (1, 1, 2, 1.0)
    r = M.roc_auc(df, "y", "s").first()
    assert (r.roc_auc, r.positives, r.negatives, r.unjudged) == (1.0, 1, 1, 2)


def test_a_million_categories_are_numbered_and_encoded(spark):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") % 7).alias("small"), F.format_string("c%07d", F.col("id")).alias("wide"))
    vocab = FE.vocabulary_table(df, ["small", "wide"]).checkpoint()
    wrong = vocab.where("column_name = 'wide' AND category <> format_string('c%07d', index)").count()
    assert wrong == 0 and vocab.where("column_name = 'wide'").count() == n and vocab.where("column_name = 'small'").count() == 7
    test = spark.createDataFrame([(3, "c0000042"), (None, "c0999999"), (9, "unknown"), (0, None)], "small bigint, wide string")
    rows = FE.encode(test, vocab, ["small", "wide"]).collect()
    got = {r.wide: (r.small_code, r.wide_code, r.positions, r.size) for r in rows}
    assert got == {"c0000042": (3, 42, [3, 49], n + 7), "c0999999": (None, n - 1, [n + 6], n + 7), "unknown": (None, None, [], n + 7), None: (0, None, [0], n + 7)}
    dropped = {r.wide: (r.positions, r.size) for r in FE.encode(test, vocab, ["small", "wide"], drop_first=True).collect()}
    assert dropped["c0000042"] == ([2, 47], n + 5) and dropped[None] == ([], n + 5)


def test_encode_equals_one_hot(spark):
    df = spark.createDataFrame([("b", True), ("a", False), ("c", None), (None, True)], "x string, f boolean")
    dense = FE.one_hot(df.withColumn("k", F.monotonically_increasing_id()), FE.fit_vocabulary(df, ["x", "f"]))
    names = [c for c in dense.columns if c != "k"]
    want = {r.k: [i for i, c in enumerate(names) if r[c] == 1.0] for r in dense.collect()}
    coded = FE.encode(df.withColumn("k", F.monotonically_increasing_id()), FE.vocabulary_table(df, ["x", "f"]), ["x", "f"])
    assert {r.k: r.positions for r in coded.collect()} == want
