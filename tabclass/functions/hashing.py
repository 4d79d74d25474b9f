"""Seeded, engine-independent hashing used for every "random" choice.

A row's draw is ``md5('<seed>:<key>')``; its first 8 hex digits read as an
unsigned 32-bit integer. DuckDB computes the same value with
``('0x' || substr(md5(x), 1, 8))::BIGINT``, so every sampler has an exact SQL
oracle and re-running a task after an executor loss gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32
HASH_RANGE = float(2 ** HASH_BITS)


def _key(seed, *parts) -> Column:
    items = [F.lit(f"{seed}")]
    for p in parts:
        items.append(F.lit(":"))
        items.append(p.cast("string") if isinstance(p, Column) else F.lit(str(p)))
    return F.concat(*items)


def hash32(seed, *parts) -> Column:
    """Unsigned 32-bit draw in [0, 2^32) as bigint, from md5 of 'seed:part:...'."""
    return F.conv(F.substring(F.md5(_key(seed, *parts)), 1, 8), 16, 10).cast("bigint")


def hash_unit(seed, *parts) -> Column:
    """Uniform draw in [0, 1) from :func:`hash32`."""
    return hash32(seed, *parts) / F.lit(HASH_RANGE)


def hash_bucket(h: Column, bits: int = 8) -> Column:
    """Top ``bits`` bits of a :func:`hash32` value: 2^bits equal-sized buckets."""
    return F.shiftright(h, HASH_BITS - bits).cast("int")


def sql_hash32(seed, *parts: str) -> str:
    """DuckDB text of :func:`hash32` (parts are SQL expressions)."""
    inner = " || ':' || ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"CAST(('0x' || substr(md5({inner}), 1, 8)) AS BIGINT)"


def sql_hash_unit(seed, *parts: str) -> str:
    return f"({sql_hash32(seed, *parts)} / {HASH_RANGE!r})"
