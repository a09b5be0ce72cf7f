"""Schema checks. They look at the analysed plan only and start no job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def require_columns(df: DataFrame, *columns: str | None) -> DataFrame:
    """Return ``df`` unchanged, or raise if a named column is absent. ``None`` names are skipped."""
    missing = [c for c in columns if c is not None and c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {', '.join(missing)}; found {', '.join(df.columns)}")
    return df


def _types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def require_same_schema(expected: T.StructType, actual: T.StructType, what: str) -> None:
    """Raise unless both schemas hold the same names and types; order and nullability may differ."""
    want, got = _types(expected), _types(actual)
    if want != got:
        diff = sorted(set(want.items()) ^ set(got.items()))
        raise ValueError(f"schema mismatch in {what}: {diff}")


def concat_strict(*dfs: DataFrame) -> DataFrame:
    """UNION ALL of frames with the same schema.

    ``union`` alone matches by position and widens types silently, so the schemas are compared first.
    """
    for i, df in enumerate(dfs[1:], start=2):
        require_same_schema(dfs[0].schema, df.schema, f"input {i}")
    return reduce(DataFrame.unionByName, dfs)
