"""Pieces of comparison SQL."""

from __future__ import annotations

from collections.abc import Sequence

# Column lists of the profiled tables: (name, kind).
LINEITEM = [
    ("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"),
    ("l_quantity", "float"), ("l_extendedprice", "float"), ("l_discount", "float"), ("l_tax", "float"),
    ("l_returnflag", "text"), ("l_linestatus", "text"), ("l_shipdate", "day"),
]
ORDERS = [
    ("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "text"), ("o_totalprice", "float"),
    ("o_orderdate", "day"), ("o_orderpriority", "text"),
]
CUSTOMER = [
    ("c_custkey", "int"), ("c_name", "text"), ("c_nationkey", "int"), ("c_acctbal", "float"), ("c_mktsegment", "text"),
]
DOCUMENTS = [("doc_id", "int"), ("text", "text"), ("lang", "text"), ("source", "text"), ("n_chars", "int")]

LABEL = {"int": "int64", "float": "float64", "text": "object", "day": "datetime64[ns]"}


def profile_sql(source: str, columns: Sequence[tuple[str, str]], order: str | None, digits: int = 4) -> str:
    """UNION ALL of one aggregate per column over ``source``, a table name or subquery."""
    parts = []
    for i, (name, kind) in enumerate(columns):
        number = kind in ("int", "float")
        first = f"min({order})" if order else "0"
        label = LABEL[kind]
        shown = f"strftime(v, '%Y-%m-%d')" if kind == "day" else "CAST(v AS VARCHAR)"
        if kind == "int":
            label_sql = f"CASE WHEN count({name}) < count(*) THEN 'float64' ELSE 'int64' END"
            gaps = f"(SELECT count({name}) < count(*) FROM {source})"
            shown = f"CASE WHEN {gaps} THEN CAST(CAST(v AS DOUBLE) AS VARCHAR) ELSE CAST(v AS VARCHAR) END"
        else:
            label_sql = f"'{label}'"

        def stat(expr: str) -> str:
            return f"round(CAST({expr} AS DOUBLE), {digits})" if number else "CAST(NULL AS DOUBLE)"

        parts.append(
            f"""SELECT {i} AS ordinal, '{name}' AS name, {label_sql} AS dtype,
       count({name}) AS non_null, count(*) - count({name}) AS missing,
       round((count(*) - count({name})) / count(*)::DOUBLE, {digits}) AS missing_share,
       count(DISTINCT {name}) AS "unique",
       (SELECT string_agg({shown}, '|' ORDER BY o, v)
          FROM (SELECT {name} AS v, {first} AS o FROM {source} WHERE {name} IS NOT NULL
                GROUP BY {name} ORDER BY o, v LIMIT 3)) AS examples,
       {"true" if number else "false"} AS is_numeric,
       {stat(f"min({name})")} AS "min", {stat(f"max({name})")} AS "max",
       {stat(f"avg({name})")} AS "mean", {stat(f"stddev_samp({name})")} AS "std"
  FROM {source}"""
        )
    return "\nUNION ALL\n".join(parts)


def union_all(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def top_sql(source: str, columns: Sequence[str], order: str, k: int = 5) -> str:
    """Top values per column, ties by first appearance."""
    parts = []
    for i, name in enumerate(columns):
        parts.append(
            f"""SELECT {i} AS ordinal, '{name}' AS "column", CAST(rk AS INTEGER) AS rank, value, n AS "count",
       round(n / (sum(n) OVER ())::DOUBLE, 6) AS share
  FROM (SELECT CAST({name} AS VARCHAR) AS value, count(*) AS n,
               row_number() OVER (ORDER BY count(*) DESC, min({order}), {name}) AS rk
          FROM {source} WHERE {name} IS NOT NULL GROUP BY {name}) WHERE rk <= {k}"""
        )
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


def histogram_sql(source: str, columns: Sequence[str], bins: int) -> str:
    parts = []
    for i, name in enumerate(columns):
        parts.append(
            f"""SELECT {i} AS ordinal, '{name}' AS "column", CAST(g.b AS INTEGER) AS bin,
       round(g.lo + g.b * g.w, 6) AS low,
       round(CASE WHEN g.b = {bins - 1} THEN g.hi ELSE g.lo + (g.b + 1) * g.w END, 6) AS high,
       count(x) AS "count"
  FROM (SELECT b, lo, hi, (hi - lo) / {bins} AS w
          FROM (SELECT CASE WHEN min({name}) = max({name}) THEN min({name}) - 0.5 ELSE min({name}) END::DOUBLE AS lo,
                       CASE WHEN min({name}) = max({name}) THEN max({name}) + 0.5 ELSE max({name}) END::DOUBLE AS hi
                  FROM {source}), range({bins}) r(b)) g
  LEFT JOIN (SELECT CAST({name} AS DOUBLE) AS x FROM {source} WHERE {name} IS NOT NULL) v
    ON x >= g.lo + g.b * g.w AND (x < g.lo + (g.b + 1) * g.w OR (g.b = {bins - 1}))
 GROUP BY ALL"""
        )
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)
