"""What the command lines share: options from a config file, overridden by flags, and a session that ends with the command."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from pathlib import Path


def options(description: str, defaults: str, argv: list[str] | None) -> dict:
    """The options of a JSON file (--config, by default the one beside the job), with every key also as a flag."""
    first = argparse.ArgumentParser(description=description)
    first.add_argument("--config", default=str(Path(__file__).parent / defaults))
    named, _ = first.parse_known_args(argv)
    found = json.loads(Path(named.config).read_text())
    for key, value in found.items():
        kind = type(value) if isinstance(value, (int, float)) else str
        first.add_argument(f"--{key.replace('_', '-')}", dest=key, type=kind, default=value)
    out = vars(first.parse_args(argv))
    del out["config"]
    if missing := [k for k, v in out.items() if v == ""]:
        first.error(f"set {', '.join(missing)} in the config file or by flag")
    return out


def command(name: str, run: Callable, chosen: dict) -> None:
    """Run a job in a session of its own."""
    from pyspark.sql import SparkSession

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, **chosen)
    finally:
        spark.stop()
