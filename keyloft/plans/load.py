"""Load: records are mapped, converted, checked and merged into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codecs
from ..operators import errors, merge
from ..schema import TableSpec
from ..scratch import Scratch
from . import mapping as M

_OWN = ("_resource", "_position", "_error")


@dataclass(frozen=True)
class LoadSettings:
    mapping: str = "*=*"
    codec: codecs.Settings = field(default_factory=codecs.Settings)
    null_to_unset: bool = True
    allow_extra_fields: bool = True
    allow_missing_fields: bool = False
    threshold: errors.Threshold = field(default_factory=errors.Threshold)
    timestamp: int | None = None  # write time of all rows, microseconds
    ttl: int | None = None  # seconds
    preserve_timestamp: bool = False  # fields writetime(c) go with the inferred ones
    preserve_ttl: bool = False

    @property
    def preserve(self) -> tuple[str, ...]:
        return tuple(n for n, on in (("writetime", self.preserve_timestamp), ("ttl", self.preserve_ttl)) if on)


def _text(source: Column, kind: T.DataType) -> Column:
    """A field as text: collections and structs as JSON, bytes as base64, text and all else as they read."""
    if isinstance(kind, T.ArrayType | T.MapType | T.StructType):
        return F.to_json(source)
    return F.base64(source) if isinstance(kind, T.BinaryType) else source.cast("string")


def _typed(text: Column, target: str, spec: TableSpec, settings: codecs.Settings) -> Column:
    """A field's text as its column's type. A write time is a number of microseconds or a time, a life seconds."""
    if target.startswith("writetime("):
        return F.coalesce(text.try_cast("long"), codecs.writetime(codecs.timestamp(text, settings)))
    if target.startswith("ttl("):
        return codecs.narrow(codecs.number(text, settings), "int")
    return codecs.decode(text, spec.types.get(target, "text"), settings, spec.udts)


def bind(records: DataFrame, spec: TableSpec, settings: LoadSettings = LoadSettings()) -> DataFrame:
    """Records as rows of the table, with _resource and _position if there are any, and _error.

    _error names the first fault of a record: one of its reader, a field that can't be converted, a
    key column without a value, or an extra field where those aren't allowed.
    """
    fields = [c for c in records.columns if c not in _OWN]
    by_index = all(f.isdigit() for f in fields) and bool(fields)
    if "_position" not in records.columns:  # the order of the records that came in, before anything is written or shuffled
        records = records.withColumn("_position", F.monotonically_increasing_id())
    columns = [*spec.types, *(merge.cell(n, c) for n in settings.preserve for c in spec.types if spec.keeps_cell_metadata(c))]
    pairs = M.resolve(M.parse(settings.mapping), fields, columns, by_index, bool(settings.preserve))
    if settings.allow_missing_fields:
        pairs = [p for p in pairs if not isinstance(p.field, M.Name) or p.field.text in fields or p.field.index is not None]
    named = {p.column.text for p in pairs if isinstance(p.column, M.Name)}
    M.check_load(pairs, columns, spec.needed_key({c for c in named if c in spec.types}), None if by_index else fields)
    sources = M.load_columns(pairs, fields)
    if not settings.allow_extra_fields and (extra := set(fields) - {p.field.text for p in pairs if isinstance(p.field, M.Name)}):
        raise M.MappingError(f"fields without a column: {sorted(extra)}")

    raw = records.select(*(c for c in _OWN if c in records.columns), *(v.alias(f"raw {t}") for t, v in sources.items()))
    texts = {t: _text(F.col(f"`raw {t}`"), raw.schema[f"raw {t}"].dataType) for t in sources}
    raw = raw.select(*(c for c in raw.columns if c in _OWN), *(v.alias(f"raw {t}") for t, v in texts.items()))
    values = {t: _typed(F.col(f"`raw {t}`"), t, spec, settings.codec) for t in sources}
    rows = raw.select("*", *(v.alias(t) for t, v in values.items()))
    # an empty text is a value only of types that have one
    empty = lambda t: codecs.type_parts(spec.types[t], spec.udts)[0] in ("ascii", "text", "varchar", "blob") if t in spec.types else False
    given = lambda t: F.col(f"`raw {t}`") if empty(t) else codecs.empty_to_null(F.col(f"`raw {t}`"))
    text = lambda t: codecs.null_strings(given(t), settings.codec.null_strings)
    keys = spec.needed_key({c for c in named if c in spec.types})
    checks = [F.when(codecs.problem(text(t), F.col(f"`{t}`")), F.lit(f"can't convert {t}")) for t in sources]
    checks += [F.when(F.col(f"`{k}`").isNull(), F.lit(f"no value for key {k}")) for k in keys]
    earlier = [F.col("_error")] if "_error" in raw.columns else []
    rows = rows.withColumn("_error", F.coalesce(*earlier, *checks))
    rows = rows.drop(*(f"raw {t}" for t in sources))
    for name, value, kind in (("writetime", settings.timestamp, "long"), ("ttl", settings.ttl, "int")):
        if value is not None:
            for c in named:
                if spec.keeps_cell_metadata(c) and f"{name}({c})" not in rows.columns:
                    rows = rows.withColumn(f"{name}({c})", F.lit(value).cast(kind))
    for name in ("writetime", "ttl"):
        if f"{name}(*)" in rows.columns:
            for c in named:
                if spec.keeps_cell_metadata(c) and f"{name}({c})" not in rows.columns:
                    rows = rows.withColumn(f"{name}({c})", F.col(f"`{name}(*)`"))
            rows = rows.drop(f"{name}(*)")
    return rows


def load(records: DataFrame, current: DataFrame, spec: TableSpec, settings: LoadSettings = LoadSettings(), now: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(the table after the load, the rejected records). Raises TooManyErrors beyond the threshold.

    Columns that the load doesn't set keep what they hold. Where the table holds columns
    writetime(c), or times are preserved, an older write loses to the stored cell, and the table
    after the load holds the times and lives of its cells.
    """
    return merged(staged(records, spec, settings), current, spec, settings, now)


def staged(records: DataFrame, spec: TableSpec, settings: LoadSettings = LoadSettings()) -> DataFrame:
    """The bound records as a written table, so that they are converted once; raises TooManyErrors beyond the threshold."""
    rows = Scratch(records.sparkSession, "load").write(bind(records, spec, settings), "bound")
    errors.guard(rows, settings.threshold)
    return rows


def merged(rows: DataFrame, current: DataFrame, spec: TableSpec, settings: LoadSettings = LoadSettings(), now: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(the table with the good ones of the bound rows, the bad ones).

    Of writes to one cell at one time the last record's holds, by file and position. A static column's
    write holds for all rows of its partition; one of a partition without rows is a row without
    clustering values. Counters that aren't loaded stay.
    """
    good, bad = errors.route(rows)
    columns = [c for c in good.columns if c in spec.types and c not in spec.primary_key]
    if "_position" not in good.columns:
        if "_resource" in good.columns:
            raise ValueError("records of files need their positions, or no write is the last one")
        good = good.withColumn("_position", F.monotonically_increasing_id())
    order = [c for c in ("_resource", "_position") if c in good.columns]
    if spec.counters:
        return merge.increment(current, good, spec, spec.counters), bad
    shared = [c for c in columns if c in spec.static]
    if not spec.static & {*columns, *current.columns} or not spec.clustering:
        return _laid_over(good, current, spec, columns, order, settings, now), bad
    # rows and partitions are two tables, each with its own last writes
    whole = TableSpec(spec.partition_key, types=spec.types, udts=spec.udts)
    own = lambda c: [n for n in (c, merge.cell("writetime", c), merge.cell("ttl", c)) if n in current.columns]
    held = [n for c in sorted(spec.static) for n in own(c)]
    partitions = current.groupBy(*spec.partition_key).agg(*(F.max(f"`{n}`").alias(n) for n in held)) if held else current.select(*spec.partition_key).distinct()
    if shared:
        partitions = _laid_over(good, partitions, whole, shared, order, settings, now)
    keys = [c for c, _ in spec.clustering]
    plain = current.drop(*held).where(F.col(f"`{keys[0]}`").isNotNull())
    if all(k in good.columns for k in keys):
        plain = _laid_over(good, plain, spec, [c for c in columns if c not in shared], order, settings, now)
    both = plain.join(partitions, list(spec.partition_key), "full")
    first = [c for c in current.columns if c in both.columns]
    return both.select(*(f"`{c}`" for c in (*first, *(c for c in both.columns if c not in first)))), bad


def _laid_over(good: DataFrame, current: DataFrame, spec: TableSpec, columns: list[str], order: list[str], settings: LoadSettings, now: int | None) -> DataFrame:
    """current with the last writes of good to these columns."""
    timed = any(merge.cell(n, c) in df.columns for n in ("writetime", "ttl") for c in columns for df in (good, current))
    if not timed:
        return merge.upsert(current, merge.last_writes(good, spec, order, columns, settings.null_to_unset), spec, columns, settings.null_to_unset)
    keep = bool(settings.preserve) or any(c.startswith("writetime(") for c in current.columns)
    if keep and now is not None:  # a row without a time of its own is written now
        for c in columns:
            at = merge.cell("writetime", c)
            good = good.withColumn(at, F.coalesce(F.col(f"`{at}`"), F.lit(now)) if at in good.columns else F.lit(now))
    # the times tell an expired write, which hides what was there, from none
    last = merge.last_cells(good.withColumn("_at", F.struct(*order)), spec, columns, "_at", now, True, settings.null_to_unset)
    after = merge.upsert(current, last, spec, columns, settings.null_to_unset)
    return after if keep else after.drop(*(n for c in columns for n in (merge.cell("writetime", c), merge.cell("ttl", c)) if n not in current.columns))


def dry_run(records: DataFrame, spec: TableSpec, settings: LoadSettings = LoadSettings()) -> tuple[int, int]:
    """(errors, rows): everything but the write."""
    return errors.guard(bind(records, spec, settings), errors.Threshold(None))


def mean_row_size(df: DataFrame, columns: Sequence[str], least: int = 1000, fallback: float = 1024.0) -> float:
    """Mean bytes of the first `least` rows; `fallback` with fewer rows, or sizes that vary too much to tell."""
    size = codecs.row_size(*map(F.col, columns))
    n, mean, spread = df.limit(least).select(size.alias("s")).agg(F.count("s"), F.avg("s"), F.stddev("s")).first()
    return fallback if n < least or not mean or (spread or 0) / mean >= 1 else mean
