import math

from pyspark.sql import functions as F

from vela.functions import random as R
from vela.sources import generators as G


def test_sampler_moments(spark):
    n = 20000
    ids = spark.range(n)
    k = F.col("id")
    u = lambda s: R.uniform(k, s)
    cols = {
        "uniform": (u("a"), 0.5, 1 / 12),
        "normal": (R.normal(u("n0"), u("n1")), 0.0, 1.0),
        "gamma": (R.gamma_int_shape([u("g0"), u("g1")], 15.0), 30.0, 450.0),
        "beta25": (R.beta_order_stat([u(f"b{i}") for i in range(6)], 2), 2 / 7, (2 * 5) / (49 * 8)),
        "beta130": (R.beta_one(u("c"), 30.0), 1 / 31, 30 / (31 ** 2 * 32)),
        "exp30": (R.exponential(u("e"), 30.0), 30.0, 900.0),
    }
    z = R.normal(u("h0"), u("h1"))
    b158 = R.beta_half_int(z, u("h2"), [u(f"h{i + 3}") for i in range(8)])
    cols["beta158"] = (b158, 1.5 / 9.5, (1.5 * 8) / (9.5 ** 2 * 10.5))
    row = ids.select(*[c.alias(name) for name, (c, _, _) in cols.items()]).agg(
        *[F.avg(n_).alias(n_ + "_m") for n_ in cols]).first()
    for name, (_, mean, var) in cols.items():
        se = math.sqrt(var / n)
        assert abs(row[name + "_m"] - mean) < 4 * se, name


def test_partitioning_does_not_change_output(spark):
    a = G.customer_dataset(spark.range(1, 501, 1, 1), "3.0.0")
    b = G.customer_dataset(spark.range(1, 501, 1, 7).repartition(5), "3.0.0")
    assert sorted(a.collect()) == sorted(b.collect())


def test_columns_per_version_and_default(spark):
    ids = spark.range(1, 11)
    for v, m in (("1.0.0", "1"), ("2.0.0", "2"), ("3.0.0", "3"), ("9.9.9", "3")):
        assert G.customer_dataset(ids, v).columns == G.CUSTOMER_COLUMNS[m]
        assert G.credit_dataset(ids, v).columns == G.CREDIT_COLUMNS[m]


def test_ranges_and_rates(spark):
    df = G.customer_dataset(spark.range(1, 5001), "1.0.0")
    r = df.agg(F.min("Age"), F.max("Age"), F.min("Tenure"), F.max("Tenure"), F.avg(F.col("Churned").cast("int")),
               F.avg((F.col("ContractType") == "Month-to-month").cast("int"))).first()
    assert 18 <= r[0] and r[1] <= 95 and 0 <= r[2] and r[3] <= 100
    assert 0.05 < r[4] < 0.95
    assert abs(r[5] - 0.6) < 0.03
    ids = df.select("CustomerId").orderBy("CustomerId").first()[0]
    assert ids == "CUST-000001"


def test_no_python_udf_in_generator_plan(spark):
    df = G.credit_dataset(spark.range(1, 10), "3.0.0")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
