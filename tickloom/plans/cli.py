"""Command line: python -m tickloom.plans.cli --config job.toml --segments DIR"""

from __future__ import annotations

import argparse
import hashlib
import logging
import sys

from ..errors import ReplayError
from .config import LEVELS, Config, load_config, overridden


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tickloom", description="Replays recorded ticks of any number of files under one clock into tables. Settings of single replays are in the config file only.")
    p.add_argument("--config", default="config.toml", help="job description (default: config.toml)")
    p.add_argument("--realtime", type=float, help="pace: 1 as recorded, 0.5 twice as fast, 0 as fast as possible and reproducible")
    p.add_argument("--init_ts", help="origin of the data's time (UTC datetime or epoch ns; empty: the first event)")
    p.add_argument("--log-level", choices=sorted(LEVELS))
    p.add_argument("--progress-sec", type=int, help="seconds between progress lines; 0 or less: none")
    p.add_argument("--segments", default="segments", help="folder of the output tables")
    p.add_argument("--dry-run", action="store_true", help="check the config and stop")
    return p


def settings(argv: list[str]) -> tuple[Config, argparse.Namespace]:
    args = parser().parse_args(argv)
    return overridden(load_config(args.config), args.realtime, args.init_ts, args.log_level, args.progress_sec), args


def main(argv: list[str] | None = None) -> int:
    try:
        cfg, args = settings(sys.argv[1:] if argv is None else argv)
        logging.basicConfig(format="%(levelname)s %(message)s", level=LEVELS.get(cfg.log_level, logging.INFO))
        if args.dry_run:
            logging.info("config is valid: %d replays", len(cfg.replays))
            return 0
        from pyspark.sql import SparkSession

        from ..operators.stored import work_dir
        from ..streaming.paced import PacedReplay, Stopper

        spark = SparkSession.builder.appName("tickloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        if cfg.realtime == 0:
            from .replay import run

            run(spark, cfg, args.segments)
        else:
            # The job's own name, so that the driver after one that died finds its journal.
            name = hashlib.sha1(repr((cfg, args.segments)).encode()).hexdigest()
            PacedReplay(spark, cfg, args.segments, f"{work_dir(spark)}/paced-{name}").play(Stopper().install())
        return 0
    except ReplayError as e:
        logging.error("%s", e)
        return 1


if __name__ == "__main__":
    sys.exit(main())
