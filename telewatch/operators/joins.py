"""Join helper for dimensions of proven size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner",
               known_small: bool = False) -> DataFrame:
    """Join ``big`` to ``small``.  ``known_small`` says that the side's size has
    a bound (a literal table, say), and it is broadcast; otherwise the
    optimizer decides from statistics, and AQE splits a hot key's partition."""
    return big.join(F.broadcast(small) if known_small else small, on, how)
