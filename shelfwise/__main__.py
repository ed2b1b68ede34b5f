"""``python -m shelfwise <stage> ...``: the stages of a run as separate processes."""

from __future__ import annotations

import argparse
import json

from shelfwise.plans import jobs
from shelfwise.session import build_session

# Paths each stage takes, its settings, and the job that runs it.
STAGES = {
    "split": (("tracker", "orders", "out"), jobs.SplitSettings, jobs.split_job),
    "features": (("splits", "items", "out"), jobs.FeatureSettings, jobs.features_job),
    "sequences": (("features", "out"), jobs.SequenceSettings, jobs.sequence_job),
    "train": (("splits", "artifacts"), jobs.TrainSettings, jobs.train_job),
    "infer": (("artifacts", "users", "out"), None, jobs.infer_job),
}


def _setting(text: str) -> tuple[str, object]:
    name, _, value = text.partition("=")
    try:
        return name, json.loads(value)
    except json.JSONDecodeError:
        return name, value


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfwise", description=__doc__)
    stages = parser.add_subparsers(dest="stage", required=True)
    for name, (paths, settings, _) in STAGES.items():
        stage = stages.add_parser(name)
        for path in paths:
            stage.add_argument(f"--{path}", required=True)
        if name == "train":
            stage.add_argument("--features", help="feature tables, for truth or popularity from them")
        stage.add_argument("--master")
        if settings:
            stage.add_argument("--set", nargs="*", default=[], metavar="NAME=JSON", type=_setting, dest="settings")
    args = parser.parse_args(argv)
    paths, settings, job = STAGES[args.stage]
    spark = build_session(f"shelfwise {args.stage}", args.master)
    given = [getattr(args, path) for path in paths]
    if args.stage == "train":
        given_settings = settings(**dict(args.settings))
        job(spark, *given, given_settings, args.features)
    else:
        job(spark, *given, *([settings(**dict(args.settings))] if settings else []))


if __name__ == "__main__":
    main()
