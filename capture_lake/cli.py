"""Command line: ``python -m capture_lake capture ...`` (or ``spark-submit``).

Modes
-----
* batch (default): one job over the objects of ``--start``/``--end`` (hourly runs).
* ``--key K``: one object; exits non-zero when it ends up quarantined.
* ``--retry``: the objects whose latest result is a failure, from the results log.
* ``--stream``: continuous ingest with a ``--interval`` trigger (60 s), or
  ``--available-now`` to drain what is there and stop.  It takes ``--prefix`` and
  ``--format``; ``--start``, ``--end``, ``--key`` and ``--retry`` do not go with it.

Every run prints one JSON line per batch: totals, write counters and the two
histograms.  Failed rows, the log of results and the stream checkpoint go next to
the table unless their places are given.

Extractors are import paths to zero-argument factories, e.g.
``--ocr mypkg.ocr:make_reader`` and ``--pdf mypkg.pdf:make_parser``.
The session comes from the launcher (``spark-submit``); a local one is made
only when ``--local`` is given.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import SparkSession

from capture_lake.session import local_session, prepare


def _load_factory(path: str | None):
    if not path:
        return None
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def _read_table(spark: SparkSession, path: str):
    if path.endswith(".json") or path.endswith(".jsonl"):
        from capture_lake.sources.listing import MANIFEST_SCHEMA
        return spark.read.schema(MANIFEST_SCHEMA).json(path)
    return spark.read.parquet(path)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="capture_lake")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("capture", help="capture new objects into the table")
    c.add_argument("--images", required=True, help="image folder or bucket URI")
    c.add_argument("--manifest", required=True, help="parquet or JSON lines: key, metadata map")
    c.add_argument("--intake", help="source archive folder or bucket URI")
    c.add_argument("--table", required=True, help="<namespace>.<table>")
    c.add_argument("--warehouse", required=True, help="location of new tables")
    c.add_argument("--quarantine", help="where failed rows are appended (default: <warehouse>/<table>_quarantine)")
    c.add_argument("--results", help="log of per-object results (default: <warehouse>/<table>_results)")
    c.add_argument("--ocr", required=True, help="module:factory of the OCR reader")
    c.add_argument("--pdf", help="module:factory of the PDF text reader")
    c.add_argument("--prefix", default="")
    c.add_argument("--start")
    c.add_argument("--end")
    c.add_argument("--key")
    c.add_argument("--stream", action="store_true")
    c.add_argument("--available-now", action="store_true")
    c.add_argument("--interval", default="60 seconds")
    c.add_argument("--checkpoint", help="stream checkpoint (default: <warehouse>/<table>_checkpoint)")
    c.add_argument("--max-files", type=int, default=10_000, help="objects per micro-batch")
    c.add_argument("--retry", action="store_true", help="run the failed objects again")
    c.add_argument("--no-range-rules", action="store_true", help="write rows that break a range rule, as the producer does")
    c.add_argument("--format", default="parquet", choices=["parquet", "iceberg"])
    c.add_argument("--local", action="store_true", help="run on a local session")
    return p


def check_options(args: argparse.Namespace) -> None:
    """Options that a mode would ignore are errors."""
    if args.stream:
        ignored = [o for o in ("start", "end", "key", "retry") if getattr(args, o)]
    else:
        ignored = [o for o in ("available_now", "checkpoint") if getattr(args, o)]
    if args.retry and args.key:
        ignored.append("key")
    if ignored:
        raise SystemExit("not with this mode: " + ", ".join("--" + o.replace("_", "-") for o in ignored))
    if bool(args.start) != bool(args.end):
        raise SystemExit("--start and --end go together")


def run(args: argparse.Namespace, spark: SparkSession) -> int:
    from capture_lake.plans.capture import capture_files, run_single
    from capture_lake.sources.tables import read_target
    from capture_lake.streaming.ingest import read_sidecar, retry_queue, table_sidecar, write_results

    check_options(args)
    prepare(spark)
    manifest = _read_table(spark, args.manifest)
    ocr_factory, pdf_factory = _load_factory(args.ocr), _load_factory(args.pdf)
    results_path = args.results or table_sidecar(args.warehouse, args.table, "results")

    def job(keys=None):
        return capture_files(spark, args.images, manifest, read_target(spark, args.table), ocr_factory,
                             pdf_factory, intake_root=args.intake, start=args.start, end=args.end,
                             prefix=args.prefix, keys=keys, enforce_rules=not args.no_range_rules)

    def write(res) -> dict:
        return write_results(res, args.table, args.warehouse, args.format, args.quarantine, results_path)

    if args.stream:
        return _run_stream(args, spark, manifest, ocr_factory, pdf_factory, results_path)
    if args.key:
        held = {}

        def single(keys):
            held["res"] = job(keys)
            return held["res"]
        try:
            status = run_single(single, args.key)
        except RuntimeError as exc:
            if "res" in held:
                write(held["res"])
            print(json.dumps({"status": "failed", "key": args.key, "error": str(exc)}))
            return 1
        write(held["res"])
        print(json.dumps(status))
        return 0
    keys = None
    if args.retry:
        keys = retry_queue(read_sidecar(spark, results_path, args.table, args.warehouse))
    totals = write(job(keys))
    print(json.dumps(totals))
    return 0


def _run_stream(args, spark, manifest, ocr_factory, pdf_factory, results_path) -> int:
    from capture_lake.plans import capture as C
    from capture_lake.streaming.ingest import listing_stream, start_capture_stream, table_sidecar

    def process(rows):
        return C.payload_process(rows.sparkSession, args.images, ocr_factory, pdf_factory, args.intake,
                                 enforce_rules=not args.no_range_rules)(rows)

    checkpoint = args.checkpoint or table_sidecar(args.warehouse, args.table, "checkpoint")
    stream = listing_stream(spark, args.images, args.prefix, args.max_files)
    q = start_capture_stream(spark, stream, args.table, args.warehouse, checkpoint, process=process,
                             available_now=args.available_now, interval=args.interval,
                             quarantine_path=args.quarantine, manifest=manifest, fmt=args.format,
                             results_path=results_path, bounded=True,
                             report=lambda totals: print(json.dumps(totals), flush=True))
    q.awaitTermination()
    return 0 if q.exception() is None else 1


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = local_session() if args.local else SparkSession.builder.getOrCreate()
    return run(args, spark)


if __name__ == "__main__":
    sys.exit(main())
