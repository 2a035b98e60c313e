"""Columns that an operator passes on, whatever their names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def set_aside(table: DataFrame, made: list[str], inner: list[str], needed: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table less columns named like those the operator makes, and with other names for those named like its inner ones.

    The function returned gives the latter their names back. ``needed`` columns, which the operator reads, stay.
    """
    table = table.drop(*[c for c in table.columns if c in made and c not in needed])
    others = {c: f"{c}_of_the_table" for c in table.columns if c in inner and c not in needed}
    return table.withColumnsRenamed(others), lambda found: found.withColumnsRenamed({other: c for c, other in others.items()})
