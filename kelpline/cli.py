"""Command line: ``python -m kelpline.cli primary|secondary --site S --data D --output O``."""

from __future__ import annotations

import argparse

from kelpline.config import PrimaryConfig, SecondaryConfig
from kelpline.rules import PRIMARY_SITES, SECONDARY_SITES
from kelpline.session import local_session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kelpline")
    flows = top.add_subparsers(dest="flow", required=True)
    for name, sites in (("primary", PRIMARY_SITES), ("secondary", SECONDARY_SITES)):
        p = flows.add_parser(name)
        p.add_argument("--site", required=True, choices=sites)
        p.add_argument("--data", required=True)
        p.add_argument("--output", required=True)
        p.add_argument("--year", default="2025")
        p.add_argument("--similarity", type=float, default=0.85)
        p.add_argument("--fuzzy", type=float, default=90.0)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = local_session("kelpline")
    if args.flow == "primary":
        from kelpline.plans import primary as flow

        cfg = PrimaryConfig(args.site, args.year, args.similarity, args.fuzzy)
    else:
        from kelpline.plans import secondary as flow

        cfg = SecondaryConfig(args.site, args.year, args.similarity, args.fuzzy)
    run = flow.run(spark, args.data, args.output, cfg)
    for k, v in run.summary.first().asDict().items():
        print(f"{k}: {v}")
    print(f"written: {run.path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
