"""Set operations and sorting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all_labelled(parts: Mapping[str, DataFrame], label: str = "label") -> DataFrame:
    """``SELECT 'a' AS label, * FROM a UNION ALL SELECT 'b', * FROM b ...``
    matched by column name, not position."""
    out = None
    for name, df in parts.items():
        d = df.select(F.lit(name).alias(label), *df.columns)
        out = d if out is None else out.unionByName(d)
    return out


def sort_by(df: DataFrame, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """Multi-key mixed-direction sort: ``[("a", "desc"), ("b", "asc")]``.
    A global sort is a range-partitioned shuffle (sampled bounds), so it
    spreads over all tasks rather than one."""
    cols: list[Column] = [F.col(c).desc() if d.lower() == "desc" else F.col(c).asc() for c, d in spec]
    return df.orderBy(*cols)


def top_n(df: DataFrame, spec: Sequence[tuple[str, str]], n: int) -> DataFrame:
    """First ``n`` rows in a total order (``ORDER BY ... LIMIT n``); Spark
    plans it as a per-task top-n followed by one merge of n rows per task."""
    return sort_by(df, spec).limit(n)
