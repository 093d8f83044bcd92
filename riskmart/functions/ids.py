"""Identifiers: a fixed prefix and a zero-padded number."""

from __future__ import annotations


def identifier(prefix: str, number: str, width: int) -> str:
    """SQL for ``<prefix><number, zero-padded to width>``; ``number`` is an SQL expression."""
    return f"concat('{prefix}', lpad(CAST({number} AS string), {int(width)}, '0'))"
