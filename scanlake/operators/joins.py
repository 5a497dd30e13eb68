"""Join helper shared by the enrichment operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPREAD = "__spread"


def _scatter_columns(rows: DataFrame) -> list[str]:
    """Cheap columns that tell rows apart."""
    ids = [c for c in ("measurement_id", "roundtrip") if c in rows.columns]
    plain = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.AtomicType)]
    return ids or plain


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    condition: Column | None = None,
) -> DataFrame:
    """Join many rows with a lookup that has one row per key.

    Nothing is hinted: the engine broadcasts the lookup when its run-time size is
    below the threshold and shuffles otherwise. For the shuffled case one derived
    key column is added, so a lookup that comes out of an aggregation on the same
    keys is exchanged once more (it is the small side). Both inputs are then plain
    shuffle stages, the shape in which adaptive execution can split a key that
    holds a large share of the rows over many tasks. Rows with a null key match
    nothing and are scattered instead of meeting in one task.

    ``condition`` may use the columns of both sides; lookup key columns are gone
    from the result.
    """
    has_keys = F.lit(True)
    for key in keys:
        has_keys = has_keys & F.col(key).isNotNull()
    spread = F.when(has_keys, F.xxhash64(*keys)).otherwise(F.xxhash64(*_scatter_columns(rows)))
    renamed = lookup.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[c for c in lookup.columns if c not in keys],
    ).withColumn("__right" + _SPREAD, F.xxhash64(*[f"__{k}" for k in keys]))
    left = rows.withColumn(_SPREAD, spread)
    on = F.col(_SPREAD) == F.col("__right" + _SPREAD)
    for key in keys:
        on = on & (F.col(key) == F.col(f"__{key}"))
    if condition is not None:
        on = on & condition
    joined = left.join(renamed, on, how)
    return joined.drop(_SPREAD, "__right" + _SPREAD, *[f"__{k}" for k in keys])
