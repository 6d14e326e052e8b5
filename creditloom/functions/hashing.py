"""Reproducible pseudo-randomness: md5 of the key and a seed, equal on every engine and re-run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(key: Column, seed: int) -> Column:
    """Hex digest that orders rows at random but reproducibly."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))


def digest_unit(digest: Column) -> Column:
    """First 32 bits of a hex digest as a double in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0


def key_unit(key: Column, seed: int) -> Column:
    return digest_unit(key_digest(key, seed))
