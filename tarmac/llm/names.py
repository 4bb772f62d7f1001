"""Column names that cannot clash with those an operator adds."""

from __future__ import annotations

from pyspark.sql import DataFrame


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns ``_c0, _c1, ...`` and the new name of each; ``toDF(*docs.columns)`` names them back."""
    names = {name: f"_c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names
