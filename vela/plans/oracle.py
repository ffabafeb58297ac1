"""DuckDB SQL text for the correctness oracle.

These builders emit the *same arithmetic* as ``vela.functions.random`` and
``vela.sources.generators`` in DuckDB's dialect (hex-cast uniforms,
``list_sort`` order statistics, ``trunc`` before integer casts, ``::double``
literals so DuckDB does not read them as DECIMAL).  They exist only so the
driver can check the Spark results against an independent engine.
"""

from __future__ import annotations

import math

from ..sources import generators as G


def num(x: float) -> str:
    return f"{float(x)!r}::double"


def u(key: str, salt: str) -> str:
    return (f"(('0x' || substr(md5(concat(cast({key} as varchar), '|{salt}')), 1, 13))::bigint::double"
            f" / 4503599627370496.0::double)")


def normal(u1: str, u2: str, mean: float = 0.0, sd: float = 1.0) -> str:
    z = f"(sqrt({num(-2.0)} * ln({num(1.0)} - {u1})) * cos({num(2.0 * math.pi)} * {u2}))"
    return f"({num(mean)} + {num(sd)} * {z})"


def exponential(x: str, mean: float) -> str:
    return f"({num(-mean)} * ln({num(1.0)} - {x}))"


def gamma_int(us: list[str], scale: float) -> str:
    acc = " + ".join(f"ln({num(1.0)} - {x})" for x in us)
    return f"({num(-scale)} * ({acc}))"


def beta_order(us: list[str], k: int) -> str:
    return f"(list_sort([{', '.join(us)}])[{k}])"


def beta_half(z: str, uh: str, ub: list[str]) -> str:
    g1 = f"({num(-1.0)} * ln({num(1.0)} - {uh}) + {z} * {z} / {num(2.0)})"
    return f"({g1} / ({g1} + {gamma_int(ub, 1.0)}))"


def beta_one(x: str, b: float) -> str:
    return f"({num(1.0)} - pow({num(1.0)} - {x}, {num(1.0 / b)}))"


def choice(x: str, choices) -> str:
    parts, acc = [], 0.0
    for label, w in choices[:-1]:
        acc += w
        parts.append(f"WHEN {x} < {num(acc)} THEN '{label}'")
    return f"(CASE {' '.join(parts)} ELSE '{choices[-1][0]}' END)"


def clip(x: str, lo, hi) -> str:
    return f"greatest({lo}, least({hi}, {x}))"


def ind(cond: str, w: float) -> str:
    return f"(CASE WHEN {cond} THEN {num(w)} ELSE {num(0.0)} END)"


def randint(x: str, lo: int, hi: int) -> str:
    return f"cast(floor({num(lo)} + {num(hi - lo)} * {x}) as integer)"


def _draw(seed: int, name: str, i: int | None = None) -> str:
    return u("id", f"{seed}|{name}" if i is None else f"{seed}|{name}.{i}")


def churn_p(v: str) -> str:
    if v == "1":
        p = f"({num(0.3)} - {num(0.003)} * Tenure + {num(0.003)} * MonthlyCharges)"
    elif v == "2":
        p = (f"({num(0.25)} - {num(0.005)} * Tenure + {num(0.004)} * MonthlyCharges"
             f" + {ind("ContractType = 'Month-to-month'", 0.2)}"
             f" - {ind("ContractType = 'Two year'", 0.1)}"
             f" - {ind('HasPhoneService', 0.05)} + {ind('HasInternetService', 0.1)})")
    else:
        p = (f"({num(0.2)} - {num(0.004)} * Tenure + {num(0.005)} * MonthlyCharges"
             f" + {ind("ContractType = 'Month-to-month'", 0.25)}"
             f" - {ind("ContractType = 'Two year'", 0.15)}"
             f" + {ind("InternetService = 'Fiber optic'", 0.1)}"
             f" - {ind("InternetService = 'No'", 0.05)}"
             f" + {ind("PaymentMethod = 'Electronic check'", 0.1)}"
             f" + {num(0.001)} * CustomerValue - {num(0.002)} * RiskScore)")
    return clip(p, num(G.CHURN_CLIP[0]), num(G.CHURN_CLIP[1]))


def customer_sql(ids_sql: str, version: str = "1.0.0", seed: int = 42, noise: float = 0.5) -> str:
    """SQL producing the same rows as ``generators.customer_dataset``."""
    v = G.major(version)
    d = lambda n, i=None: _draw(seed, n, i)
    age = clip(f"cast(trunc({normal(d('age', 0), d('age', 1), 45.0, 15.0)}) as integer)", 18, 95)
    tenure = clip(f"cast(trunc({gamma_int([d('tenure', 0), d('tenure', 1)], 15.0)}) as integer)", 0, 100)
    monthly = f"({num(50.0)} + {num(50.0)} * {beta_order([d('monthly', i) for i in range(6)], 2)})"
    cols = [
        "id", f"printf('{G.CUSTOMER_ID_FORMAT}', id) AS CustomerId", f"{age} AS Age", f"{tenure} AS Tenure",
        f"{choice(d('contract'), G.CONTRACTS[v])} AS ContractType", f"{monthly} AS MonthlyCharges",
        f"{d('total')} AS u_total", f"{d('noise', 0)} AS u_n0", f"{d('noise', 1)} AS u_n1",
        f"{d('label')} AS u_label",
    ]
    if v == "2":
        cols += [f"({d('phone')} < {num(G.PHONE_SHARE)}) AS HasPhoneService",
                 f"({d('internet')} < {num(G.INTERNET_SHARE)}) AS HasInternetService"]
    elif v == "3":
        z = normal(d("risk_z", 0), d("risk_z", 1))
        cols += [
            f"{choice(d('inet'), G.INTERNET_SERVICE)} AS InternetService",
            f"{choice(d('payment'), G.PAYMENT_METHODS)} AS PaymentMethod",
            f"({beta_order([d('value', i) for i in range(6)], 2)} * {num(100.0)}) AS CustomerValue",
            f"({beta_half(z, d('risk_h'), [d('risk_b', i) for i in range(8)])} * {num(100.0)}) AS RiskScore",
        ]
    noise_term = f"({num(noise)} * {normal('u_n0', 'u_n1', 0.0, 0.1)})"
    p = clip(f"({churn_p(v)} + {noise_term})", num(G.CHURN_CLIP[0]), num(G.CHURN_CLIP[1]))
    out = ", ".join(c for c in G.CUSTOMER_COLUMNS[v] if c not in ("TotalCharges", "Churned"))
    return (f"SELECT {out}, MonthlyCharges * Tenure * ({num(0.9)} + {num(0.2)} * u_total) AS TotalCharges,"
            f" u_label < {p} AS Churned FROM (SELECT {', '.join(cols)} FROM ({ids_sql}))")


def fraud_p(v: str) -> str:
    night = "(HourOfDay >= 1 AND HourOfDay <= 5)"
    if v == "1":
        return (f"({num(0.01)} + {num(0.001)} * Amount / {num(100.0)} + {ind(night, 0.01)}"
                f" + {ind('DistanceFromHome > 100', 0.02)})")
    online = "MerchantCategory = 'online'"
    if v == "2":
        return (f"({num(0.005)} + {num(0.0008)} * Amount / {num(100.0)} + {ind(night, 0.01)}"
                f" + {ind('DistanceFromHome > 100', 0.015)} + {ind('DistanceFromLastTransaction > 200', 0.02)}"
                f" + {ind('RatioToMedianPurchasePrice > 5', 0.03)} + {ind(online, 0.02)})")
    return (f"({num(0.003)} + {num(0.0005)} * Amount / {num(100.0)} + {ind(night, 0.008)}"
            f" + {ind('DistanceFromHome > 100', 0.01)} + {ind('DistanceFromLastTransaction > 200', 0.015)}"
            f" + {ind('RatioToMedianPurchasePrice > 5', 0.02)} + {ind(online, 0.01)}"
            f" + {ind('RepeatRetailer', -0.01)} + {ind('UsedChip', -0.01)} + {ind('UsedPinNumber', -0.005)}"
            f" + {ind('OnlineOrder', 0.01)} + {num(0.5)} * FraudSignals)")


def credit_sql(ids_sql: str, version: str = "1.0.0", seed: int = 42, noise: float = 0.5) -> str:
    v = G.major(version)
    d = lambda n, i=None: _draw(seed, n, i)
    cols = [
        "id", f"printf('{G.TRANSACTION_ID_FORMAT}', id) AS TransactionId",
        f"{clip('exp(' + normal(d('amount', 0), d('amount', 1), 4.0, 1.5) + ')', num(1.0), num(5000.0))} AS Amount",
        f"{clip(exponential(d('home'), 30.0), num(0.0), num(500.0))} AS DistanceFromHome",
        f"{d('noise', 0)} AS u_n0", f"{d('noise', 1)} AS u_n1", f"{d('label')} AS u_label",
    ]
    if v == "3":
        cols.append(f"TIMESTAMP '{G.CREDIT_TS_BASE}' + to_seconds({randint(d('ts'), 0, G.CREDIT_TS_SPAN)})"
                    f" AS Timestamp")
    else:
        cols += [f"{randint(d('hour'), 0, 24)} AS HourOfDay", f"{randint(d('dow'), 0, 7)} AS DayOfWeek"]
    if v in ("2", "3"):
        cols += [
            f"{clip(exponential(d('last'), 20.0), num(0.0), num(1000.0))} AS DistanceFromLastTransaction",
            f"{clip(exponential(d('ratio'), 1.0), num(0.1), num(10.0))} AS RatioToMedianPurchasePrice",
            f"{choice(d('merchant'), G.MERCHANT_CATEGORIES)} AS MerchantCategory",
        ]
    if v == "3":
        cols += [
            f"({d('repeat')} < {num(G.REPEAT_SHARE)}) AS RepeatRetailer",
            f"({d('chip')} < {num(G.CHIP_SHARE)}) AS UsedChip",
            f"({d('pin')} < {num(G.PIN_SHARE)}) AS UsedPinNumber",
            f"({d('online')} < {num(G.ONLINE_SHARE)}) AS OnlineOrder",
            f"{beta_one(d('signals'), 30.0)} AS FraudSignals",
        ]
    inner = f"SELECT {', '.join(cols)} FROM ({ids_sql})"
    if v == "3":
        inner = (f"SELECT *, cast(hour(Timestamp) as integer) AS HourOfDay,"
                 f" cast(isodow(Timestamp) - 1 as integer) AS DayOfWeek,"
                 f" cast(month(Timestamp) as integer) AS Month FROM ({inner})")
    noise_term = f"({num(noise)} * {normal('u_n0', 'u_n1', 0.0, 0.01)})"
    p = clip(f"({fraud_p(v)} + {noise_term})", num(G.FRAUD_CLIP[0]), num(G.FRAUD_CLIP[1]))
    out = ", ".join(c for c in G.CREDIT_COLUMNS[v] if c != "IsFraud")
    return f"SELECT {out}, u_label < {p} AS IsFraud FROM ({inner})"


CUSTOMER_IDS = "SELECT c_custkey + 1 AS id FROM customer"
ORDER_IDS = "SELECT o_orderkey + 1 AS id FROM orders"
