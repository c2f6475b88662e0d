"""One run of all layers: spark-submit this package with the landing and lake folders."""

from __future__ import annotations

import argparse

from fleetgauge.config import SensorConfig
from fleetgauge.plans.build import run_all
from fleetgauge.session import build_session
from fleetgauge.sources.layers import Layers


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="fleetgauge")
    parser.add_argument("landing", help="folder of CSV landing files")
    parser.add_argument("base", help="folder of the layers")
    parser.add_argument("--env", default="", help="environment suffix of the layers, empty for production")
    parser.add_argument("--schema", default="turbine_data")
    parser.add_argument("--full", action="store_true", help="recompute silver and gold from all of bronze")
    given = parser.parse_args(arguments)
    spark = build_session()
    layers = Layers(given.base, given.env, given.schema)
    run_all(spark, layers, given.landing, SensorConfig.from_session(spark), given.full)


if __name__ == "__main__":
    main()
