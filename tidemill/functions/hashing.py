"""Repeatable pseudo-random numbers derived from keys, so results do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_hash(seed: str, *keys: Column) -> Column:
    """Uniform number in (0, 1) from the first 32 bits of an MD5 over the keys and the seed."""
    text = F.concat_ws(":", *[k.cast("string") for k in keys], F.lit(seed))
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return (bits + 0.5) / 4294967296.0


def unit_hash_sql(seed: str, *keys: str) -> str:
    """The same number as SQL text for a twin query."""
    text = " || ':' || ".join([f"CAST({k} AS VARCHAR)" for k in keys] + [f"'{seed}'"])
    return f"((('0x' || substr(md5({text}), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


def normal_hash(seed: str, *keys: Column) -> Column:
    """Standard normal number by the Box-Muller formula over two uniform hashes."""
    u, v = unit_hash(f"{seed}u", *keys), unit_hash(f"{seed}v", *keys)
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(6.283185307179586) * v)


def normal_hash_sql(seed: str, *keys: str) -> str:
    u, v = unit_hash_sql(f"{seed}u", *keys), unit_hash_sql(f"{seed}v", *keys)
    return f"(sqrt(-2.0 * ln({u})) * cos(6.283185307179586 * {v}))"
