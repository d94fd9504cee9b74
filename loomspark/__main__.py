"""Command line: python -m loomspark --archive conversations.json --base-dir out [--only-stage chunk ...]."""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys

from .plans.config import Config


def parse(args: list[str]) -> Config:
    """Flags of every setting; booleans have a --no- form. An invalid setting ends with status 2."""
    p = argparse.ArgumentParser("loomspark")
    for f in dataclasses.fields(Config):
        flag = "--" + f.name.replace("_", "-")
        if isinstance(f.default, bool):
            p.add_argument(flag, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            p.add_argument(flag, type=int if isinstance(f.default, int) else str, default=f.default)
    c = Config(**vars(p.parse_args(args)))
    try:
        c.validate()
    except ValueError as e:
        p.error(str(e))
    return c


def main(args: list[str] | None = None) -> int:
    c = parse(sys.argv[1:] if args is None else args)
    from pyspark.sql import SparkSession

    from .plans.pipeline import pipeline_of

    spark = SparkSession.builder.appName("loomspark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    pipeline = pipeline_of(spark, c)
    did = pipeline.run()
    print(json.dumps({"stages": did, **pipeline.stats()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
