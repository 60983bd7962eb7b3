"""What the jobs' command lines share."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession


def config_of(job: str, path: str | None = None) -> dict:
    """The job's configuration: the file beside it, or another one."""
    return json.loads((Path(path) if path else Path(__file__).with_name(f"{job}.json")).read_text())


def main(job: str, run: Callable[..., None], folders: tuple[str, ...]) -> None:
    """Read the command line, run the job in a session of its own, and end it."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{job}", description=run.__doc__)
    for name in folders:
        parser.add_argument(f"--{name}", required=True, help="a path that all executors see")
    parser.add_argument("--config", help=f"by default {job}.json beside the job")
    given = vars(parser.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(job).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, *(given[name] for name in folders), config_of(job, given["config"]))
    finally:
        spark.stop()
