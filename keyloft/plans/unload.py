"""Unload: rows of a table are chosen, computed and written as text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import codecs
from ..schema import TableSpec
from . import mapping as M


def _columns(table: DataFrame, preserve: bool) -> list[str]:
    """What `*` stands for: stored write times and lives only if they are to be kept."""
    return [c for c in table.columns if preserve or not c.startswith(("writetime(", "ttl("))]


def records(table: DataFrame, spec: TableSpec, mapping: str = "*=*", settings: codecs.Settings = codecs.Settings(), preserve: bool = False) -> DataFrame:
    """Text records for delimited files. Only the mapped columns are read; nothing is shuffled.

    preserve: `*=*` also gives the cells' write times, in microseconds, and lives, in seconds.
    """
    columns = _columns(table, preserve)
    pairs = M.resolve(M.parse(mapping), columns, columns, preserve=preserve)
    M.check_unload(pairs, table.columns)
    out = []
    for p in pairs:
        name = p.column.text if isinstance(p.column, M.Name) else None
        value = M.evaluate(p.column)
        out.append((codecs.encode(value, spec.types[name], settings, spec.udts) if name in spec.types else value.cast("string")).alias(p.field.text))
    return table.select(*out)


def documents(table: DataFrame, mapping: str = "*=*", preserve: bool = False) -> DataFrame:
    """Records for JSON files: numbers, booleans and collections stay what they are."""
    return M.unload_map(table.select(*(f"`{c}`" for c in _columns(table, preserve))), mapping)
