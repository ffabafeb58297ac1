"""Synthetic labelled data (customer churn and card fraud), versions 1-3.

Generation is a map-only projection over any id column: each row's values
are hashes of (id, seed, draw name), so output is identical for any
partitioning, any executor count and any re-run after executor loss.
``spark.range`` gives ids for a given size; a driver table's key column
(``customer.c_custkey + 1``) gives data that grows with that table.

Plan shape: ids -> Project(uniform columns) -> Project(features) ->
Project(probability, label).  Uniforms are materialised once per row as
columns so Catalyst never duplicates md5 work into several consumers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import random as R
from ..session import spread

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference generator's (weights, formulas'
# coefficients, clip bounds, id formats).  Listed in the reference's order.
# ---------------------------------------------------------------------------
CONTRACTS = {
    "1": [("Month-to-month", 0.6), ("One year", 0.3), ("Two year", 0.1)],
    "2": [("Month-to-month", 0.5), ("One year", 0.25), ("Two year", 0.15), ("Custom", 0.1)],
    "3": [("Month-to-month", 0.4), ("One year", 0.2), ("Two year", 0.15), ("Custom", 0.15), ("Flex", 0.1)],
}
INTERNET_SERVICE = [("DSL", 0.3), ("Fiber optic", 0.6), ("No", 0.1)]
PAYMENT_METHODS = [("Electronic check", 0.4), ("Mailed check", 0.1), ("Bank transfer", 0.25), ("Credit card", 0.25)]
MERCHANT_CATEGORIES = [
    ("grocery", 0.2), ("restaurant", 0.2), ("gas", 0.15), ("online", 0.2),
    ("retail", 0.1), ("travel", 0.05), ("other", 0.1),
]
PHONE_SHARE, INTERNET_SHARE = 0.9, 0.8
REPEAT_SHARE, CHIP_SHARE, PIN_SHARE, ONLINE_SHARE = 0.7, 0.8, 0.6, 0.4
CUSTOMER_ID_FORMAT, TRANSACTION_ID_FORMAT = "CUST-%06d", "TX-%08d"
CREDIT_TS_BASE, CREDIT_TS_SPAN = "2023-01-01 00:00:00", 60 * 60 * 24 * 365
CHURN_CLIP, FRAUD_CLIP = (0.05, 0.95), (0.001, 0.99)

CUSTOMER_COLUMNS = {
    "1": ["CustomerId", "Age", "Tenure", "ContractType", "MonthlyCharges", "TotalCharges", "Churned"],
    "2": ["CustomerId", "Age", "Tenure", "ContractType", "MonthlyCharges", "TotalCharges",
          "HasPhoneService", "HasInternetService", "Churned"],
    "3": ["CustomerId", "Age", "Tenure", "ContractType", "MonthlyCharges", "TotalCharges",
          "InternetService", "PaymentMethod", "CustomerValue", "RiskScore", "Churned"],
}
CREDIT_COLUMNS = {
    "1": ["TransactionId", "Amount", "HourOfDay", "DayOfWeek", "DistanceFromHome", "IsFraud"],
    "2": ["TransactionId", "Amount", "HourOfDay", "DayOfWeek", "DistanceFromHome",
          "DistanceFromLastTransaction", "RatioToMedianPurchasePrice", "MerchantCategory", "IsFraud"],
    "3": ["TransactionId", "Timestamp", "Amount", "HourOfDay", "DayOfWeek", "Month", "DistanceFromHome",
          "DistanceFromLastTransaction", "RatioToMedianPurchasePrice", "MerchantCategory",
          "RepeatRetailer", "UsedChip", "UsedPinNumber", "OnlineOrder", "FraudSignals", "IsFraud"],
}


def major(version: str) -> str:
    """'1.0.0' -> '1', '2.0.0' -> '2', anything else -> '3' (reference rule)."""
    return {"1.0.0": "1", "2.0.0": "2"}.get(version, "3")


def _ind(cond: Column, weight: float) -> Column:
    """weight * [cond] with numpy bool arithmetic semantics."""
    return F.when(cond, F.lit(weight)).otherwise(F.lit(0.0))


def _draws(ids: DataFrame, seed: int, spec: dict[str, int]) -> DataFrame:
    """Project the id plus one uniform column per requested draw."""
    key = F.col("id")
    cols = [key]
    for name, n in spec.items():
        if n == 1:
            cols.append(R.uniform(key, f"{seed}|{name}").alias(f"u_{name}"))
        else:
            cols += [R.uniform(key, f"{seed}|{name}.{i}").alias(f"u_{name}_{i}") for i in range(n)]
    return ids.select(*cols)


def _u(name: str, i: int | None = None) -> Column:
    return F.col(f"u_{name}") if i is None else F.col(f"u_{name}_{i}")


# ----------------------------------------------------------------- churn ---

def churn_probability(df: DataFrame | None = None, version: str = "1.0.0") -> Column:
    """Clipped churn probability of the given version, before noise.

    Works on any frame holding the version's feature columns.
    """
    v = major(version)
    t, m = F.col("Tenure"), F.col("MonthlyCharges")
    ct = F.col("ContractType")
    if v == "1":
        p = F.lit(0.3) - F.lit(0.003) * t + F.lit(0.003) * m
    elif v == "2":
        p = (F.lit(0.25) - F.lit(0.005) * t + F.lit(0.004) * m
             + _ind(ct == "Month-to-month", 0.2) - _ind(ct == "Two year", 0.1)
             - _ind(F.col("HasPhoneService"), 0.05) + _ind(F.col("HasInternetService"), 0.1))
    else:
        inet, pay = F.col("InternetService"), F.col("PaymentMethod")
        p = (F.lit(0.2) - F.lit(0.004) * t + F.lit(0.005) * m
             + _ind(ct == "Month-to-month", 0.25) - _ind(ct == "Two year", 0.15)
             + _ind(inet == "Fiber optic", 0.1) - _ind(inet == "No", 0.05)
             + _ind(pay == "Electronic check", 0.1)
             + F.lit(0.001) * F.col("CustomerValue") - F.lit(0.002) * F.col("RiskScore"))
    return R.clip(p, *CHURN_CLIP)


def customer_dataset(ids: DataFrame, version: str = "1.0.0", seed: int = 42,
                     noise_level: float = 0.5) -> DataFrame:
    """Customer churn rows for every ``id`` (1-based BIGINT) of ``ids``."""
    v = major(version)
    spec = {"age": 2, "tenure": 2, "monthly": 6, "total": 1, "contract": 1, "noise": 2, "label": 1}
    if v == "2":
        spec.update(phone=1, internet=1)
    elif v == "3":
        spec.update(inet=1, payment=1, value=6, risk_z=2, risk_h=1, risk_b=8)
    d = _draws(spread(ids.select(F.col("id").cast("bigint").alias("id"))), seed, spec)

    age = R.clip(R.normal(_u("age", 0), _u("age", 1), 45.0, 15.0).cast("int"), 18, 95)
    tenure = R.clip(R.gamma_int_shape([_u("tenure", 0), _u("tenure", 1)], 15.0).cast("int"), 0, 100)
    monthly = F.lit(50.0) + F.lit(50.0) * R.beta_order_stat([_u("monthly", i) for i in range(6)], 2)
    feats = [
        F.col("id"),
        F.format_string(CUSTOMER_ID_FORMAT, F.col("id")).alias("CustomerId"),
        age.alias("Age"), tenure.alias("Tenure"),
        R.weighted_choice(_u("contract"), CONTRACTS[v]).alias("ContractType"),
        monthly.alias("MonthlyCharges"),
        _u("total"), _u("noise", 0), _u("noise", 1), _u("label"),
    ]
    if v == "2":
        feats += [R.bernoulli(_u("phone"), PHONE_SHARE).alias("HasPhoneService"),
                  R.bernoulli(_u("internet"), INTERNET_SHARE).alias("HasInternetService")]
    elif v == "3":
        z = R.normal(_u("risk_z", 0), _u("risk_z", 1))
        feats += [
            R.weighted_choice(_u("inet"), INTERNET_SERVICE).alias("InternetService"),
            R.weighted_choice(_u("payment"), PAYMENT_METHODS).alias("PaymentMethod"),
            (R.beta_order_stat([_u("value", i) for i in range(6)], 2) * F.lit(100.0)).alias("CustomerValue"),
            (R.beta_half_int(z, _u("risk_h"), [_u("risk_b", i) for i in range(8)]) * F.lit(100.0)).alias("RiskScore"),
        ]
    f = d.select(*feats).withColumn(
        "TotalCharges",
        F.col("MonthlyCharges") * F.col("Tenure") * (F.lit(0.9) + F.lit(0.2) * F.col("u_total")))
    noise = F.lit(float(noise_level)) * R.normal(F.col("u_noise_0"), F.col("u_noise_1"), 0.0, 0.1)
    p = R.clip(churn_probability(version=version) + noise, *CHURN_CLIP)
    return f.withColumn("Churned", F.col("u_label") < p).select(*CUSTOMER_COLUMNS[v])


# ----------------------------------------------------------------- fraud ---

def fraud_probability(df: DataFrame | None = None, version: str = "1.0.0") -> Column:
    """Fraud probability of the given version, before noise and clip."""
    v = major(version)
    amt, h = F.col("Amount"), F.col("HourOfDay")
    home = F.col("DistanceFromHome")
    night = (h >= 1) & (h <= 5)
    if v == "1":
        return (F.lit(0.01) + F.lit(0.001) * amt / F.lit(100.0)
                + _ind(night, 0.01) + _ind(home > 100, 0.02))
    last, ratio = F.col("DistanceFromLastTransaction"), F.col("RatioToMedianPurchasePrice")
    online_cat = F.col("MerchantCategory") == "online"
    if v == "2":
        return (F.lit(0.005) + F.lit(0.0008) * amt / F.lit(100.0)
                + _ind(night, 0.01) + _ind(home > 100, 0.015) + _ind(last > 200, 0.02)
                + _ind(ratio > 5, 0.03) + _ind(online_cat, 0.02))
    return (F.lit(0.003) + F.lit(0.0005) * amt / F.lit(100.0)
            + _ind(night, 0.008) + _ind(home > 100, 0.01) + _ind(last > 200, 0.015)
            + _ind(ratio > 5, 0.02) + _ind(online_cat, 0.01)
            + _ind(F.col("RepeatRetailer"), -0.01) + _ind(F.col("UsedChip"), -0.01)
            + _ind(F.col("UsedPinNumber"), -0.005) + _ind(F.col("OnlineOrder"), 0.01)
            + F.lit(0.5) * F.col("FraudSignals"))


def credit_dataset(ids: DataFrame, version: str = "1.0.0", seed: int = 42,
                   noise_level: float = 0.5) -> DataFrame:
    """Card transactions for every ``id`` (1-based BIGINT) of ``ids``."""
    v = major(version)
    spec = {"amount": 2, "home": 1, "noise": 2, "label": 1}
    spec.update({"ts": 1} if v == "3" else {"hour": 1, "dow": 1})
    if v in ("2", "3"):
        spec.update(last=1, ratio=1, merchant=1)
    if v == "3":
        spec.update(repeat=1, chip=1, pin=1, online=1, signals=1)
    d = _draws(spread(ids.select(F.col("id").cast("bigint").alias("id"))), seed, spec)

    feats = [
        F.col("id"),
        F.format_string(TRANSACTION_ID_FORMAT, F.col("id")).alias("TransactionId"),
        R.clip(F.exp(R.normal(_u("amount", 0), _u("amount", 1), 4.0, 1.5)), 1.0, 5000.0).alias("Amount"),
        R.clip(R.exponential(_u("home"), 30.0), 0.0, 500.0).alias("DistanceFromHome"),
        _u("noise", 0), _u("noise", 1), _u("label"),
    ]
    if v == "3":
        base = F.lit(CREDIT_TS_BASE).cast("timestamp_ntz")
        feats.append(F.timestamp_add("SECOND", R.randint(_u("ts"), 0, CREDIT_TS_SPAN), base).alias("Timestamp"))
    else:
        feats += [R.randint(_u("hour"), 0, 24).alias("HourOfDay"), R.randint(_u("dow"), 0, 7).alias("DayOfWeek")]
    if v in ("2", "3"):
        feats += [
            R.clip(R.exponential(_u("last"), 20.0), 0.0, 1000.0).alias("DistanceFromLastTransaction"),
            R.clip(R.exponential(_u("ratio"), 1.0), 0.1, 10.0).alias("RatioToMedianPurchasePrice"),
            R.weighted_choice(_u("merchant"), MERCHANT_CATEGORIES).alias("MerchantCategory"),
        ]
    if v == "3":
        feats += [
            R.bernoulli(_u("repeat"), REPEAT_SHARE).alias("RepeatRetailer"),
            R.bernoulli(_u("chip"), CHIP_SHARE).alias("UsedChip"),
            R.bernoulli(_u("pin"), PIN_SHARE).alias("UsedPinNumber"),
            R.bernoulli(_u("online"), ONLINE_SHARE).alias("OnlineOrder"),
            R.beta_one(_u("signals"), 30.0).alias("FraudSignals"),
        ]
    f = d.select(*feats)
    if v == "3":
        ts = F.col("Timestamp")
        f = f.select("*", F.hour(ts).alias("HourOfDay"), F.weekday(ts).alias("DayOfWeek"),
                     F.month(ts).alias("Month"))
    noise = F.lit(float(noise_level)) * R.normal(F.col("u_noise_0"), F.col("u_noise_1"), 0.0, 0.01)
    p = R.clip(fraud_probability(version=version) + noise, *FRAUD_CLIP)
    return f.withColumn("IsFraud", F.col("u_label") < p).select(*CREDIT_COLUMNS[v])


# -------------------------------------------------------------- wrappers ---

def ids_range(spark: SparkSession, n_rows: int, num_partitions: int | None = None) -> DataFrame:
    """1-based ids 1..n_rows, split evenly across partitions, no shuffle."""
    return spark.range(1, n_rows + 1, 1, num_partitions).select(F.col("id"))


def descriptor(kind: str, version: str, seed: int, noise_level: float,
               columns: list[str], rows: int | None = None) -> dict[str, str]:
    """Dataset descriptor (G9) as a string map for the snapshot log."""
    name, target = {"customer": ("customer_churn", "Churned"),
                    "credit": ("credit_fraud", "IsFraud")}[kind]
    label = "customer churn" if kind == "customer" else "credit card fraud"
    out = {
        "name": name, "version": version, "features": ",".join(columns), "target": target,
        "random_seed": str(seed), "noise_level": str(noise_level),
        "description": f"Synthetic {label} dataset v{version}",
    }
    if rows is not None:
        out["rows"] = str(rows)
    return out
