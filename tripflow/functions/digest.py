"""A 128-bit digest of a row, to count distinct wide rows without shuffling them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


_FLAGS_PER_LONG = 63


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes over the columns in opposite orders.

    A null leaves ``xxhash64`` unchanged, so it could trade places with a value
    of a neighbour; the null flags of all columns are therefore hashed as well.
    """
    values = [F.col(f"`{name}`") for name in columns]
    flags = [
        _null_flags(values[start : start + _FLAGS_PER_LONG])
        for start in range(0, len(values), _FLAGS_PER_LONG)
    ]
    forward = F.xxhash64(F.lit("forward"), *flags, *values)
    backward = F.xxhash64(F.lit("backward"), *flags, *reversed(values))
    return [forward.alias("digest_forward"), backward.alias("digest_backward")]


def _null_flags(values: Sequence[Column]) -> Column:
    bits = [F.shiftleft(F.isnull(value).cast("long"), bit) for bit, value in enumerate(values)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)
