"""Run all stages once: ``spark-submit ... -m eventlake --root PATH --log-format kafka -o subscribe=topic``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from eventlake import schemas as S
from eventlake.functions.contract import INTAKE, Contract
from eventlake.session import session_builder
from eventlake.sources.event_log import stream_log
from eventlake.streaming.jobs import Lake, run_once

WIRES = {"english": S.ENGLISH, "portuguese": S.PORTUGUESE}


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventlake", description="Drain master files and events, then stop.")
    parser.add_argument("--root", required=True, help="shared folder that holds all environments")
    parser.add_argument("--env", default="dev", help="environment name, part of every path")
    parser.add_argument("--buckets", type=int, default=256, help="buckets of new keyed tables, about 1 GB each")
    parser.add_argument("--log-format", default="parquet", help="kafka, or a file format with broker columns")
    parser.add_argument("--log-path", help="folder of a file log")
    parser.add_argument("-o", "--option", action="append", default=[], metavar="KEY=VALUE", help="source option")
    parser.add_argument("--wire", choices=sorted(WIRES), default="english", help="JSON field names")
    parser.add_argument("--strict", action="store_true", help="apply the publishing contract on intake too")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = parse(argv)
    spark = session_builder("eventlake").getOrCreate()
    options = dict(pair.split("=", 1) for pair in args.option)
    log = stream_log(spark, args.log_format, options, args.log_path)
    contract = Contract(S.CONSENT_TYPES, S.CONSENT_STATUSES, strict=True) if args.strict else INTAKE
    run_once(spark, Lake(args.root, args.env, args.buckets), log, wire=WIRES[args.wire], contract=contract)


if __name__ == "__main__":
    main()
