"""``python -m skyledger predict``: scores an archive with a model and publishes the predictions."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from skyledger.functions.values import DateError, MarketDate
from skyledger.operators.network import EngineError
from skyledger.plans.run import OK, PARTIAL, TOOL, TOOL_VERSION, PredictRequest, RequestError, exit_code, run
from skyledger.sources.files import ArchiveError
from skyledger.sources.predictions import OutputError


def market_date(text: str) -> MarketDate:
    try:
        return MarketDate.parse(text)
    except DateError as e:
        raise argparse.ArgumentTypeError(str(e)) from None


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog=TOOL, description=__doc__)
    top.add_argument("--version", action="version", version=f"{TOOL} {TOOL_VERSION}")
    predict = top.add_subparsers(dest="command", required=True).add_parser("predict", help="run one model over an identified archive")
    predict.add_argument("--creature", required=True, metavar="FILE", help="model JSON to activate")
    predict.add_argument("--archive", required=True, metavar="DIR", help="fingerprint root: <root>/<extension>/<fingerprint>")
    predict.add_argument("--dataset", metavar="ID", help="snapshot id; by default the one that <archive>/latest.json names")
    predict.add_argument("--from", dest="first", type=market_date, metavar="DATE", help="first market date, inclusive (YYYY-MM-DD)")
    predict.add_argument("--to", dest="last", type=market_date, metavar="DATE", help="last market date, inclusive (YYYY-MM-DD)")
    predict.add_argument("--output", required=True, metavar="DIR", help="folder for the predictions and the manifest")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    request = PredictRequest(args.creature, args.archive, args.output, args.dataset, args.first, args.last)
    try:
        request.validate()
        summary = run(spark or SparkSession.builder.appName(TOOL).getOrCreate(), request, lambda line: print(line, file=sys.stderr))
    except (RequestError, ArchiveError, EngineError, OutputError) as e:
        print(f"error: {e}", file=sys.stderr)
        return exit_code(e)
    if refused := summary.manifest["refused"]:
        print(f"error: {len(refused)} row(s) without a finite output were left out; {summary.output}/manifest.json names them", file=sys.stderr)
        return PARTIAL
    return OK


if __name__ == "__main__":
    sys.exit(main())
