"""Seeded, reproducible random draws as pure expressions.

A draw is the first 8 hex digits of ``md5("seed:epoch:id:step")`` read as an
unsigned 32-bit integer and divided by 2^32, so it lies in [0, 1). Every
engine with md5 computes the same numbers, a retried task recomputes the same
values, and no state is kept between rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(seed, epoch, row_id, step) -> Column:
    parts = [F.lit(str(seed)), F.lit(str(epoch)), F.col(row_id) if isinstance(row_id, str) else row_id,
             step if isinstance(step, Column) else F.lit(str(step))]
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def uniform(seed, epoch, row_id, step) -> Column:
    """U[0, 1) for (seed, epoch, row, step)."""
    h = F.substring(F.md5(_key(seed, epoch, row_id, step)), 1, 8)
    return F.conv(h, 16, 10).cast("double") / F.lit(TWO_32)


def uniform_range(lo: float, hi: float, seed, epoch, row_id, step) -> Column:
    return F.lit(lo) + (F.lit(hi) - F.lit(lo)) * uniform(seed, epoch, row_id, step)


def randint(lo: int, hi: int, seed, epoch, row_id, step) -> Column:
    """Integer in [lo, hi] inclusive."""
    return (F.lit(lo) + F.floor(uniform(seed, epoch, row_id, step) * (hi - lo + 1))).cast("int")


def normal(mean: float, std: float, seed, epoch, row_id, step) -> Column:
    """Box-Muller from two uniforms (steps ``step`` and ``step+1000``); 1 - u avoids ln(0)."""
    s = step if isinstance(step, int) else 0
    u1 = F.lit(1.0) - uniform(seed, epoch, row_id, s)
    u2 = uniform(seed, epoch, row_id, s + 1000)
    z = F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
    return F.lit(mean) + F.lit(std) * z


def sql_uniform(seed, epoch, row_id_sql: str, step) -> str:
    """The same draw in DuckDB SQL."""
    key = f"concat_ws(':', '{seed}', '{epoch}', CAST({row_id_sql} AS VARCHAR), '{step}')"
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) / {TWO_32})"


def sql_normal(mean: float, std: float, seed, epoch, row_id_sql: str, step: int) -> str:
    u1 = f"(1.0 - {sql_uniform(seed, epoch, row_id_sql, step)})"
    u2 = sql_uniform(seed, epoch, row_id_sql, step + 1000)
    return f"({mean} + {std} * sqrt(-2.0 * ln({u1})) * cos({2.0 * math.pi!r} * {u2}))"
