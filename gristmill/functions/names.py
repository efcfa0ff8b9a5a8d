"""Column-name helpers."""

from __future__ import annotations


def quoted(name: str) -> str:
    """Back-tick a physical column name, so dots and hyphens stay part of the name."""
    return "`" + name.replace("`", "``") + "`"
