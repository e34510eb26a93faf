"""SQL-text builders for the DuckDB oracle (the independent correctness check).

Each helper returns DuckDB SQL text for the same rule the Spark column
functions implement, so ``oracle_sql()`` can state every query as plain SQL
over the driver's tables.
"""

from __future__ import annotations

from decimal import Decimal

from parcelspark import constants as K
from parcelspark.sources.survey_views import duckdb_view_sql


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lit(v) -> str:
    if isinstance(v, str):
        return q(v)
    if isinstance(v, Decimal):
        scale = -v.as_tuple().exponent
        return f"CAST({v} AS DECIMAL({max(len(v.as_tuple().digits), scale, 1)},{scale}))"
    return str(v)


def jx(t: str, path: str) -> str:
    """JSON text at path; NULL on bad JSON (DuckDB would raise)."""
    return f"(CASE WHEN json_valid({t}) THEN json_extract_string({t}, {q(path)}) END)"


def unwrap(c: str) -> str:
    w = f"('{{\"v\":' || {c} || '}}')"
    return f"(CASE WHEN json_valid({w}) THEN json_extract_string({w}, '$.v') END)"


def m(s: str, pattern: str) -> str:
    return f"regexp_matches({s}, {q(pattern)})"


def initcap(s: str) -> str:
    body = (f"list_aggregate(list_transform(regexp_extract_all(lower({s}), '[a-z0-9]+|[^a-z0-9]+'), "
            f"lambda x: upper(x[1:1]) || x[2:]), 'string_agg', '')")
    return f"(CASE WHEN {s} IS NULL THEN NULL ELSE coalesce({body}, '') END)"


def blank_default(s: str, d: str = "") -> str:
    return f"coalesce(nullif(trim({s}), ''), {q(d)})"


def blank_null(s: str) -> str:
    return f"nullif(trim({s}), '')"


def clean_pattern(s: str, pattern: str) -> str:
    return f"(CASE WHEN {m(s, pattern)} THEN {s} WHEN length(trim({s})) > 0 THEN trim({s}) END)"


def money(x: str) -> str:
    r = f"round({x}, 2)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN abs({r}) >= {K.MONEY_OVERFLOW_AT} THEN {q(K.MONEY_OVERFLOW_TEXT)} "
            f"ELSE regexp_replace(format('{{:,.2f}}', CAST({r} AS DOUBLE)), '^(-?)0[.]', '\\1.') END)")


def label(s: str, mapping: dict, default: str = "initcap", fallback: str | None = None, lower: bool = False) -> str:
    key = f"lower({s})" if lower else s
    whens = " ".join(f"WHEN {key} = {q(k)} THEN {q(v)}" for k, v in mapping.items())
    other = initcap(s) if default == "initcap" else f"upper({s})"
    if fallback is not None:
        other = f"coalesce({other}, {q(fallback)})"
    return f"(CASE {whens} ELSE {other} END)"


def normalize(s: str, synonyms: dict, default: str) -> str:
    key = f"lower(trim({s}))"
    whens = " ".join(f"WHEN {key} IN ({', '.join(q(w) for w in ws)}) THEN {q(v)}" for v, ws in synonyms.items())
    return f"(CASE {whens} ELSE {q(default)} END)"


def guarded(s: str, pattern: str, typ: str) -> str:
    return f"(CASE WHEN {m(s, pattern)} THEN TRY_CAST({s} AS {typ}) END)"


def coord(s: str, lo, hi) -> str:
    v = f"TRY_CAST({s} AS DECIMAL(18,10))"
    return f"(CASE WHEN {m(s, K.COORD_RE)} AND {v} BETWEEN {lo} AND {hi} THEN {v} END)"


def units(s: str) -> str:
    v = f"TRY_CAST({s} AS INTEGER)"
    return (f"(CASE WHEN {m(s, K.UNITS_RE)} AND {v} BETWEEN {K.UNITS_MIN} AND {K.UNITS_MAX} THEN {v} "
            f"ELSE {K.UNITS_DEFAULT} END)")


def rent(s: str) -> str:
    v = f"TRY_CAST({s} AS DECIMAL(18,4))"
    return (f"(CASE WHEN {m(s, K.RENT_RE)} AND {v} > 0 AND {v} <= {K.RENT_MAX} THEN {v} "
            f"ELSE CAST(0 AS DECIMAL(18,4)) END)")


def amount_paid(s: str) -> str:
    v = f"TRY_CAST({s} AS DECIMAL(18,4))"
    return f"(CASE WHEN {m(s, K.AMOUNT_RE)} AND {v} >= 0 THEN {v} ELSE CAST(0 AS DECIMAL(18,4)) END)"


def strict_date(s: str) -> str:
    return guarded(s, K.DATE_RE, "DATE")


def prefix_date(s: str) -> str:
    return f"(CASE WHEN {m(s, K.DATE_PREFIX_RE)} THEN TRY_CAST(substr({s}, 1, 10) AS DATE) END)"


def prefix_ts(s: str) -> str:
    return f"(CASE WHEN {m(s, K.DATE_PREFIX_RE)} THEN TRY_CAST({s} AS TIMESTAMP) END)"


def age(d: str, as_of: str) -> str:
    a = f"DATE {q(as_of)}"
    return (f"CAST(year({a}) - year({d}) - CASE WHEN strftime({a}, '%m%d') < strftime({d}, '%m%d') "
            f"THEN 1 ELSE 0 END AS INTEGER)")


def rate(cur: str) -> str:
    whens = " ".join(f"WHEN {cur} = {q(k)} THEN {lit(v)}" for k, v in K.RATES_TO_GMD.items())
    return f"(CASE {whens} ELSE {lit(K.RATES_TO_GMD[K.CURRENCY_DEFAULT])} END)"


def income_type(use: str, basis: str) -> str:
    return (f"(CASE WHEN {use} = 'place-of-business' THEN 'commercial' "
            f"WHEN {use} = 'residence' AND {basis} = 'owner' THEN 'residential_rental' "
            f"WHEN {use} = 'residence' AND {basis} <> 'owner' THEN 'residential_rental' ELSE 'business' END)")


def img_html(u: str) -> str:
    return f"(CASE WHEN {u} IS NOT NULL THEN '<img src=\"' || {u} || '\" width=\"100%\" height=\"100%\" />' END)"


def point_text(v: str) -> str:
    return f"regexp_replace(regexp_replace(CAST({v} AS VARCHAR), '0+$', ''), '[.]$', '')"


def with_views(*names: str) -> str:
    """``WITH`` prefix defining the survey views from the driver's tables."""
    return "WITH " + ",\n".join(f"{n} AS ({duckdb_view_sql(n)})" for n in names)
