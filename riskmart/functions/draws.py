"""Reproducible per-row draws.

A draw depends only on the row key, a seed and a purpose, so it does not change with
partitioning, task retries or the engine: any system with MD5 can repeat it.
"""

from __future__ import annotations

DRAW_RANGE = 2**32


def draw(key: str, seed: int, purpose: str) -> str:
    """SQL for a whole number in ``[0, 2**32)``; ``key`` is a column name."""
    digest = f"md5(concat(`{key}`, ':{int(seed)}:{purpose}'))"
    return f"CAST(conv(substr({digest}, 1, 8), 16, 10) AS bigint)"


def fraction(key: str, seed: int, purpose: str) -> str:
    """SQL for a number in ``[0, 1)``."""
    return f"({draw(key, seed, purpose)} / {float(DRAW_RANGE)!r}D)"
