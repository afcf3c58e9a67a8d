"""Exact column identity on an engine that resolves names without regard to case.

Names of a file or table are exact: ``Discount`` is not ``discount``.  Spark
resolves them as one, so a column whose name would be taken for another one gets
an internal name, and its own name goes into the field's metadata (kept by
projections and in Parquet).  ``restore`` gives a result its own names back
wherever they do not clash there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "exact_name"


def _bq(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def repeats_numbered(header: list[str]) -> list[str]:
    """A header whose repeated names are told apart: x, x.1, x.2 (a name that is there already is passed over)."""
    out, taken = [], set(header)
    seen: dict[str, int] = {}
    for c in header:
        name = c
        if c in seen:
            name = f"{c}.{seen[c]}"
            while name in taken:
                seen[c] += 1
                name = f"{c}.{seen[c]}"
            taken.add(name)
        seen[c] = seen.get(c, 0) + 1
        out.append(name)
    return out


def internal(names: list[str], wanted: list[str]) -> list[str]:
    """Names that no two columns and no wanted column share, compared without case. A wanted
    name stays what it is; of the others the first of its spelling does."""
    exact = set(wanted)
    used = {w.lower() for w in wanted}
    out = []
    for c in names:
        name, k = c, 1
        while c not in exact and name.lower() in used:
            name, k = f"{c}~{k}", k + 1
        used.add(name.lower())
        out.append(name)
    return out


def renamed(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` under internal names, position by position; other names are kept as metadata."""
    if names == df.columns:
        return df
    return df.toDF(*[f"_{i}" for i in range(len(names))]).select(*[
        F.col(f"_{i}").alias(n, metadata={**f.metadata, KEY: f.metadata.get(KEY, f.name)} if n != f.name else f.metadata)
        for i, (n, f) in enumerate(zip(names, df.schema.fields))])


def own_names(df: DataFrame) -> dict[str, str]:
    """Internal name -> own name of every column."""
    return {f.name: f.metadata.get(KEY, f.name) for f in df.schema.fields}


def restore(df: DataFrame) -> DataFrame:
    """``df`` with own names; a column whose own name another column goes by keeps its internal one."""
    own = own_names(df)
    if all(k == v for k, v in own.items()):
        return df
    lower = [v.lower() for v in own.values()]
    return df.select(*[F.col(_bq(k)).alias(v if lower.count(v.lower()) == 1 else k) for k, v in own.items()])
