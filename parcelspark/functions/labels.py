"""Normalisers and display labels as ``CASE`` chains (constant-folded by Catalyst)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelspark import constants as K
from parcelspark.functions.text import pg_initcap


def normalize(c: Column, synonyms: dict[str, list[str]], default: str) -> Column:
    """``lower(trim(x))`` looked up in a synonym table; anything else -> ``default``."""
    key = F.lower(F.trim(c))
    chain = None
    for value, words in synonyms.items():
        cond = key.isin(*words)
        chain = F.when(cond, F.lit(value)) if chain is None else chain.when(cond, F.lit(value))
    return chain.otherwise(F.lit(default))


def label(c: Column, mapping: dict[str, str], default: str = "initcap", fallback: str | None = None,
          compare_lower: bool = False) -> Column:
    """Exact-match label table; otherwise ``initcap(x)`` / ``upper(x)`` (then ``fallback`` if NULL)."""
    key = F.lower(c) if compare_lower else c
    chain = reduce(lambda acc, kv: acc.when(key == F.lit(kv[0]), F.lit(kv[1])),
                   list(mapping.items())[1:],
                   F.when(key == F.lit(next(iter(mapping))), F.lit(mapping[next(iter(mapping))])))
    other = pg_initcap(c) if default == "initcap" else F.upper(c)
    if fallback is not None:
        other = F.coalesce(other, F.lit(fallback))
    return chain.otherwise(other)


def norm_currency(c: Column) -> Column:
    return normalize(c, K.CURRENCY_SYNONYMS, K.CURRENCY_DEFAULT)


def norm_property_use(c: Column) -> Column:
    return normalize(c, K.PROPERTY_USE_SYNONYMS, K.PROPERTY_USE_DEFAULT)


def norm_basis(c: Column) -> Column:
    return normalize(c, K.BASIS_SYNONYMS, K.BASIS_DEFAULT)


def income_type(property_use: Column, basis: Column) -> Column:
    """place-of-business -> commercial; residence (any basis) -> residential_rental; else business."""
    return (F.when(property_use == "place-of-business", F.lit("commercial"))
            .when((property_use == "residence") & (basis == "owner"), F.lit("residential_rental"))
            .when((property_use == "residence") & (basis != "owner"), F.lit("residential_rental"))
            .otherwise(F.lit("business")))


def rate_for(currency: Column, rates: dict | None = None) -> Column:
    rates = rates or K.RATES_TO_GMD
    items = list(rates.items())
    chain = F.when(currency == items[0][0], F.lit(items[0][1]))
    for k, v in items[1:]:
        chain = chain.when(currency == k, F.lit(v))
    return chain.otherwise(F.lit(rates.get(K.CURRENCY_DEFAULT, items[0][1])))


def tax_rate_for(income: Column, rates: dict | None = None) -> Column:
    rates = rates or K.TAX_RATES
    items = list(rates.items())
    chain = F.when(income == items[0][0], F.lit(items[0][1]))
    for k, v in items[1:]:
        chain = chain.when(income == k, F.lit(v))
    return chain
