"""One-hot encoding with the first category dropped (M1).

``pyspark.ml.feature.OneHotEncoder`` drops the *last* category and emits a
vector, so it cannot reproduce ``get_dummies(drop_first=True)``.  Here the
sorted category list is found with one bounded aggregate (or given by the
caller, so scoring reuses the training columns) and each kept category becomes
a plain ``CASE`` column; a null category gives all zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.operators.aggregate import distinct_categories


def one_hot_columns(column: str, categories: list, drop_first: bool = True) -> list[tuple[str, object]]:
    """``(output_name, value)`` pairs for the kept categories, in sorted order."""
    cats = sorted(categories)
    kept = cats[1:] if drop_first else cats
    return [(f"{column}_{v}", v) for v in kept]


def one_hot(df: DataFrame, columns: list[str], categories: dict[str, list] | None = None,
            drop_first: bool = True, max_categories: int = 1000) -> DataFrame:
    """Replace each of ``columns`` by 0/1 int columns appended at the end (pandas order)."""
    categories = dict(categories or {})
    missing = [c for c in columns if c not in categories]
    if missing:
        categories.update(distinct_categories(df, missing, max_categories))
    keep = [F.col(c) for c in df.columns if c not in columns]
    dummies = []
    for c in columns:
        for name, v in one_hot_columns(c, categories[c], drop_first):
            dummies.append(F.when(F.col(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0)).alias(name))
    return df.select(*keep, *dummies)
