"""Hash expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_fraction(*columns: str, seed: int | str = 0) -> Column:
    """Uniform number in [0, 1) that depends only on the seed and the column values.

    Taken from md5, so the value is the same on every run, partitioning and engine.
    """
    key = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns])
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return head / F.lit(4294967296.0)


def linear_hash(index: int, code: str, modulus: int) -> str:
    """SQL of one member of the MinHash family: ``(index * code + 1) mod modulus``."""
    return f"({index}L * {code} + 1L) % {modulus}L"


def universal_hash(multiplier: int, offset: int, code: str, prime: int) -> str:
    """SQL of one member of the universal family: ``(multiplier * code + offset) mod prime``."""
    return f"({multiplier}L * ({code} % {prime}L) + {offset}L) % {prime}L"
