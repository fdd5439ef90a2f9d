"""Projection, relabelling and filter operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def select_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Project named columns under new names: ``{source: alias}``."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def with_literals(df: DataFrame, literals: Mapping[str, object]) -> DataFrame:
    """Add constant columns (``lit``); the input DataFrame is not changed."""
    return df.withColumns({k: F.lit(v) for k, v in literals.items()})


def drop_rename(df: DataFrame, drop: Sequence[str] = (), rename: Mapping[str, str] | None = None) -> DataFrame:
    out = df.drop(*drop)
    return out.withColumnsRenamed(dict(rename or {}))


def feature_columns(df: DataFrame, skip_first: int = 1) -> list[str]:
    """All columns but the first ``skip_first`` (id columns)."""
    return df.columns[skip_first:]


def relabel_expr(c, mapping: Mapping[str, str]) -> Column:
    """``CASE WHEN c = k1 THEN v1 ... ELSE c END``."""
    c = _c(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return c if expr is None else expr.otherwise(c)


def relabel(df: DataFrame, column: str, mapping: Mapping[str, str], out: str | None = None) -> DataFrame:
    """Replace values of ``column`` by ``mapping``; unmapped values stay.

    One map literal, whatever the number of entries; an entry with the target
    None gives NULL.
    """
    out = out or column
    if not mapping:
        return df.withColumn(out, _c(column))
    pairs = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v).cast("string"))])
    c = _c(column)
    return df.withColumn(out, F.when(F.map_contains_key(pairs, c), pairs[c]).otherwise(c))


def choose(cond: Column, when_true, otherwise) -> Column:
    """``CASE WHEN cond THEN a ELSE b END`` with column arguments."""
    return F.when(cond, _c(when_true)).otherwise(_c(otherwise))


def not_in(c, values: Sequence) -> Column:
    """SQL ``NOT IN``: rows whose value is NULL are dropped as well."""
    return ~_c(c).isin(list(values))


def ilike_contains(c, needle: str) -> Column:
    """``lower(c) LIKE '%needle%'``."""
    return F.lower(_c(c)).like(f"%{needle.lower()}%")
