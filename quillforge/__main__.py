"""Commands: ``scrub IN OUT`` (JSON lines, with OUT.receipt.json), ``cast BUNDLE OUT``, ``verify FOLDER``. Exit 3: a gate refuses."""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def utc_now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillforge")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, args in (("scrub", ("source", "out")), ("cast", ("source", "out")), ("verify", ("source",))):
        one = sub.add_parser(name)
        for a in args:
            one.add_argument(a)
    opts = parser.parse_args(argv)
    if opts.command == "verify":
        from .sources.writers import verify

        problems = verify(opts.source)
        print("\n".join(problems) or "ok")
        return 3 if problems else 0
    from pyspark.sql import SparkSession

    from .operators import casting, release
    from .operators.receipts import GateError
    from .sources.readers import SourceError

    spark = SparkSession.builder.getOrCreate()
    if opts.command == "scrub":
        return 0 if release.scrub_file(spark, opts.source, opts.out, clock=utc_now)["is_clean"] else 3
    try:
        print(casting.cast_bundle(spark, opts.source, opts.out)["disposition"])
    except (GateError, SourceError) as e:
        print(e, file=sys.stderr)
        return 3
    return 0


if __name__ == "__main__":
    sys.exit(main())
