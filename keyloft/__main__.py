"""Commands: load, unload and count, over Parquet tables and text files.

    python -m keyloft count  --table T --key a,b --stats global,partitions
    python -m keyloft unload --table T --spec S.json --url OUT --mapping "id = k, v"
    python -m keyloft load   --table T --spec S.json --url IN --out NEW [--bad DIR] [--dry-run]

The specification is a JSON object: partition_key, clustering (pairs of column and asc or desc),
types, static, udts.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import codecs
from .operators import checkpoint, count, errors, ring
from .plans import load, unload
from .schema import TableSpec
from .sources import csv, files
from .sources import json as documents


def read_spec(path: str) -> TableSpec:
    d = json.loads(Path(path).read_text())
    return TableSpec(
        tuple(d["partition_key"]), tuple((c, o) for c, o in d.get("clustering", [])), d.get("types", {}), frozenset(d.get("static", [])), d.get("udts", {})
    )


#: What --codec can set.
_CODEC = tuple(f.name for f in dataclasses.fields(codecs.Settings) if f.name != "null_strings")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="keyloft", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("load", "unload", "count"):
        s = sub.add_parser(name)
        s.add_argument("-t", "--table", required=True, help="Parquet table")
        s.add_argument("--spec", help="keys and types, as JSON")
        if name == "count":
            s.add_argument("--key", default="", help="partition key columns")
            s.add_argument("--stats", default="global", help=",".join(count.MODES))
            s.add_argument("--splits", type=int, default=8)
            s.add_argument("--top", type=int, default=10)
            continue
        s.add_argument("-u", "--url", required=True)
        s.add_argument("-m", "--mapping", default="*=*")
        s.add_argument("-c", "--connector", choices=("csv", "json"), default="csv")
        s.add_argument("--delim", default=",")
        s.add_argument("--header", choices=("true", "false"), default="true")
        s.add_argument("--null-strings", default="")
        s.add_argument("--codec", action="append", default=[], metavar="NAME=VALUE", help="how values are written: " + ", ".join(_CODEC))
        s.add_argument("--quote", default='"')
        s.add_argument("--escape", default="\\")
        s.add_argument("--comment")
        s.add_argument("--compression", default="none")
        s.add_argument("--preserve-timestamp", action="store_true", help="*=* takes write times along")
        s.add_argument("--preserve-ttl", action="store_true", help="*=* takes lives along")
        if name == "load":
            s.add_argument("--out", help="where the table after the load goes")
            s.add_argument("--bad", help="where rejected records go")
            s.add_argument("--url-list", help="a file that lists paths, one a line")
            s.add_argument("--skip-records", type=int, default=0)
            s.add_argument("--max-records", type=int)
            s.add_argument("--max-errors", default="100", help="a number, or a share such as 5%%")
            s.add_argument("--dry-run", action="store_true")
            s.add_argument("--multi-line", action="store_true", help="quoted fields may hold line breaks; files aren't split")
            s.add_argument("--allow-missing-fields", action="store_true")
            s.add_argument("--no-extra-fields", action="store_true")
            s.add_argument("--fields", type=int, help="without a header: how many fields a record has")
            s.add_argument("--checkpoint", help="where the ranges of records dealt with are kept")
            s.add_argument("--replay", choices=tuple(checkpoint.STRATEGIES), help="leave out what an earlier run's --checkpoint holds")
            s.add_argument("--timestamp", type=int, help="write time of all rows, in microseconds")
            s.add_argument("--ttl", type=int, help="life of all rows, in seconds")
    return p


def threshold(text: str) -> errors.Threshold:
    return errors.Threshold(None, float(text[:-1]) / 100) if text.endswith("%") else errors.Threshold(int(text))


def _settings(args: argparse.Namespace) -> codecs.Settings:
    """The codecs' settings from --null-strings and --codec; words are parted by commas."""
    given = {"null_strings": tuple(filter(None, args.null_strings.split(",")))}
    for item in args.codec:
        name, found, value = item.partition("=")
        if not found or name not in _CODEC:
            raise SystemExit(f"unknown codec option {item}; there are {', '.join(_CODEC)}")
        given[name] = tuple(value.lower().split(",")) if name.endswith("_words") else value == "true" if name == "format_numbers" else value
    return codecs.Settings(**given)


def _form(args: argparse.Namespace) -> csv.Csv:
    load_only = {"multi_line": args.multi_line, "allow_extra": not args.no_extra_fields, "allow_missing": args.allow_missing_fields, "fields": args.fields} if args.command == "load" else {}
    return csv.Csv(header=args.header == "true", delimiter=args.delim, quote=args.quote, escape=args.escape, comment=args.comment, **load_only)


def _read(spark: SparkSession, args: argparse.Namespace, table: DataFrame) -> DataFrame:
    what = files.Files((args.url,), args.url_list, compression=args.compression)
    if args.connector == "json":
        records = documents.read(spark, what, table.schema, skip=args.skip_records, most=args.max_records, positions=bool(args.checkpoint))
    else:
        records = csv.read(spark, what, _form(args), args.skip_records, args.max_records, positions=True)
    if args.replay:
        records = checkpoint.replay(records, spark.read.parquet(args.checkpoint), args.replay)
    return records


def _keep_checkpoint(spark: SparkSession, path: str, results: DataFrame) -> None:
    """Add the run's ranges to those that are kept; `results` has _resource, _position and _failed."""
    made = checkpoint.checkpoint(results)
    made.write.mode("append").parquet(path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("keyloft").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    table = spark.read.parquet(args.table)
    if args.command == "count":
        made = count.count(table, args.stats.split(","), list(filter(None, args.key.split(","))), ring.even_ring(args.splits, ("local",)), args.top)
        for df in made.values():
            for row in df.toLocalIterator():
                print(*row)
        return errors.EXIT["ok"]
    spec = read_spec(args.spec)
    preserve = args.preserve_timestamp or args.preserve_ttl
    if args.command == "unload":
        if args.connector == "json":
            documents.write(unload.documents(table, args.mapping, preserve), args.url, compression=args.compression)
        else:
            csv.write(unload.records(table, spec, args.mapping, _settings(args), preserve), args.url, _form(args), compression=args.compression)
        return errors.EXIT["ok"]
    settings = load.LoadSettings(
        args.mapping, _settings(args), allow_extra_fields=not args.no_extra_fields, allow_missing_fields=args.allow_missing_fields, threshold=threshold(args.max_errors),
        timestamp=args.timestamp, ttl=args.ttl, preserve_timestamp=args.preserve_timestamp, preserve_ttl=args.preserve_ttl,
    )
    records = _read(spark, args, table)
    try:
        if args.dry_run:
            bad, _ = load.dry_run(records, spec, settings)
            return errors.EXIT["with_errors" if bad else "ok"]
        bound = load.staged(records, spec, settings)
        after, rejected = load.merged(bound, table, spec, settings, now=time.time_ns() // 1000)
    except errors.TooManyErrors as e:
        print(e, file=sys.stderr)
        return errors.EXIT["too_many_errors"]
    after.write.parquet(args.out)
    if args.bad:
        rejected.write.parquet(args.bad)
    if args.checkpoint:
        _keep_checkpoint(spark, args.checkpoint, bound.select("_resource", "_position", F.col("_error").isNotNull().alias("_failed")))
    return errors.EXIT["ok" if rejected.isEmpty() else "with_errors"]


if __name__ == "__main__":
    sys.exit(main())
