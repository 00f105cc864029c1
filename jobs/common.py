"""What the jobs share: configuration, logs and the command line."""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.sources import config as C

log = logging.getLogger("jobs")


def configured(name: str, path: str | None = None) -> dict:
    """The job's own configuration file, with the values of the one at path over it."""
    own = C.load(os.path.join(os.path.dirname(os.path.abspath(__file__)), f"{name}.json"))
    return C.merge(own, C.load(path), {}) if path else own


def view(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df as the configuration's columns: name to SQL expression."""
    return df.select(*[F.expr(said).alias(name) for name, said in columns.items()])


def written(df: DataFrame, what: str, path: str) -> DataFrame:
    log.info("wrote %s: %d rows in %s", what, df.count(), path)  # of Parquet footers alone
    return df


def main(name: str, run: Callable[..., object], arguments: dict[str, str], args: list[str] | None = None) -> int:
    """The command line: the only place that makes and stops a session. arguments: name to help, plain paths."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}", description=run.__doc__)
    for argument, said in arguments.items():
        parser.add_argument(f"--{argument}", required=True, help=said)
    parser.add_argument("--config", help="a JSON, TOML or YAML file whose values replace those of the job's own")
    given = vars(parser.parse_args(args))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        run(spark, **{a: given[a] for a in arguments}, config=configured(name, given["config"]))
    finally:
        spark.stop()
    return 0
