"""Registered queries: Spark callables plus their DuckDB oracle SQL.

Every query reads the driver tables under ``sf_dir`` (or data Spark derives
from them), so its work grows with the tables.  Doubles are rounded to six
places in *both* engines at the very end so that last-ulp differences of
libm functions do not decide the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import generators as G
from ..sources import tables as TB
from . import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name) for f in df.schema.fields])


def rsql(sql: str, double_cols: list[str], places: int = 6) -> str:
    """Wrap oracle SQL so the listed double columns are rounded like ``round_doubles``."""
    reps = ", ".join(f"round({c}, {places}) AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({reps}) FROM ({sql})" if double_cols else sql


def _doubles(columns: list[str]) -> list[str]:
    """The generator columns of type DOUBLE (rounded in both engines)."""
    dbl = {"MonthlyCharges", "TotalCharges", "CustomerValue", "RiskScore", "Amount", "DistanceFromHome",
           "DistanceFromLastTransaction", "RatioToMedianPurchasePrice", "FraudSignals"}
    return [c for c in columns if c in dbl]


# ------------------------------------------------------------ generators ---

def _gen_customer(version: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return round_doubles(G.customer_dataset(TB.customer_ids(spark, sf), version))
    return run


def _gen_credit(version: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return round_doubles(G.credit_dataset(TB.order_ids(spark, sf), version))
    return run


for _v in ("1.0.0", "2.0.0", "3.0.0"):
    _m = G.major(_v)
    register(f"gen_customer_v{_m}", rsql(O.customer_sql(O.CUSTOMER_IDS, _v),
                                         _doubles(G.CUSTOMER_COLUMNS[_m])))(_gen_customer(_v))
    register(f"gen_credit_v{_m}", rsql(O.credit_sql(O.ORDER_IDS, _v),
                                       _doubles(G.CREDIT_COLUMNS[_m])))(_gen_credit(_v))


# Query modules register themselves on import.
from . import snapshot_queries  # noqa: E402,F401
from . import model_queries  # noqa: E402,F401
from . import registry_queries  # noqa: E402,F401
from . import lineage_queries  # noqa: E402,F401
from . import ml_queries  # noqa: E402,F401
