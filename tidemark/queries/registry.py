"""Named queries over the test tables with the SQL that must give the same rows.

A query has a column list in a small notation that both sides are brought to, so that
values compare exactly: ``name`` as is, ``name:i`` integer, ``name:4`` rounded to 4
places (by the same arithmetic on both sides, so ties agree), ``name:d`` date text, ``name:t`` timestamp text, ``name:l`` list joined by ``|``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def _columns(spec: str):
    for item in spec.split():
        name, _, form = item.partition(":")
        yield name, form


def shape(df: DataFrame, spec: str) -> DataFrame:
    out = []
    for name, form in _columns(spec):
        c = F.col(name)
        if form == "i":
            c = c.cast("bigint")
        elif form.isdigit():
            scale = float(10 ** int(form))
            c = F.floor(c.cast("double") * scale + 0.5) / scale
        elif form == "d":
            c = F.date_format(c, "yyyy-MM-dd")
        elif form == "t":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif form == "l":
            c = F.array_join(c, "|")
        out.append(c.alias(name))
    return df.select(*out)


def shape_sql(sql: str, spec: str) -> str:
    out = []
    for name, form in _columns(spec):
        c = f'"{name}"'
        if form == "i":
            c = f"CAST({c} AS BIGINT)"
        elif form.isdigit():
            scale = f"CAST({10 ** int(form)} AS DOUBLE)"
            c = f"floor(CAST({c} AS DOUBLE) * {scale} + 0.5) / {scale}"
        elif form == "d":
            c = f"strftime({c}, '%Y-%m-%d')"
        elif form == "t":
            c = f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
        elif form == "l":
            c = f"array_to_string({c}, '|')"
        out.append(f'{c} AS "{name}"')
    return f"SELECT {', '.join(out)} FROM ({sql.strip()}) AS result"


def query(name: str, spec: str, sql: str | None = None):
    """Register the decorated ``(spark, folder) -> DataFrame`` under a name."""

    def add(function):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: shape(function(spark, folder), spec)
        if sql is not None:
            ORACLES[name] = shape_sql(sql, spec)
        return function

    return add


# Whether a transaction falls to the tenth that the canary model scores.
CANARY = "CAST('0x' || substr(md5(CAST(transaction_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 1000"

# Entities of the data model as SQL over the test tables.
EVENTS_SQL = "(SELECT event_id AS id, ts, event_type AS value, user_id FROM events)"
FRAUD_SQL = """(SELECT event_id AS transaction_id, user_id, ts AS timestamp, value AS amount,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS merchant_id,
    event_type AS merchant_category, event_type = 'error' AS is_fraud FROM events)"""
ORDERS_SQL = """(SELECT o_orderkey AS transaction_id, o_custkey AS user_id,
    o_orderdate AS timestamp, o_totalprice AS amount,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'purchase' WHEN '2-HIGH' THEN 'refund'
        WHEN '3-MEDIUM' THEN 'subscription' ELSE 'transfer' END AS transaction_type,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
        WHEN 'P' THEN 'failed' ELSE 'cancelled' END AS status,
    floor(o_totalprice / 1000) AS processing_time_ms FROM orders)"""
USERS_SQL = """(SELECT c_custkey AS user_id, n_name AS country,
    DATE '1990-01-01' + c_nationkey * 30 AS signup_date,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'premium' WHEN 'MACHINERY' THEN 'enterprise'
        ELSE 'basic' END AS user_type,
    CASE WHEN c_acctbal < 2500 THEN '18-25' WHEN c_acctbal < 5000 THEN '26-35'
        ELSE '36+' END AS age_group
    FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
