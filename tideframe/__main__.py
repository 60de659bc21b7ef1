"""Commands: python -m tideframe etl|watch|retry|compact|repartition|validate|repair|health|sync|example-config."""

from __future__ import annotations

import argparse
import json
import time

from tideframe import job
from tideframe.config import load_config, write_example
from tideframe.operators import layout
from tideframe.session import get_spark
from tideframe.sources import segments, sync


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tideframe", description=__doc__)
    p.add_argument("--config", help="settings file")
    s = p.add_subparsers(dest="command", required=True)
    c = s.add_parser("etl", help="process the ready segments of a source")
    c.add_argument("source")
    c.add_argument("--start", help="first date in segment names, YYYY-MM-DD")
    c.add_argument("--end")
    c = s.add_parser("watch", help="the same as a stream; books and trades wait 10 s for others of their time, later ones are counted and left out of hf rows and bars")
    c.add_argument("source")
    c.add_argument("--checkpoint", required=True)
    c = s.add_parser("retry", help="failed segments back to ready")
    c.add_argument("source")
    c = s.add_parser("compact", help="fewer, larger files in each folder")
    c.add_argument("path")
    c.add_argument("--target-mb", type=float, default=100)
    c.add_argument("--min-files", type=int, default=1)
    c.add_argument("--max-file-mb", type=float)
    c.add_argument("--target-files", type=int)
    c.add_argument("--sort-by", nargs="*")
    c.add_argument("--dry-run", action="store_true")
    c = s.add_parser("repartition")
    c.add_argument("path")
    c.add_argument("target")
    c.add_argument("--by", nargs="+", required=True)
    c.add_argument("--dry-run", action="store_true")
    for name in ("validate", "repair"):
        c = s.add_parser(name)
        c.add_argument("path")
        c.add_argument("--columns", nargs="+", required=True)
    c = s.add_parser("health", help="waiting segments of a source")
    c.add_argument("source")
    c = s.add_parser("sync", help="copy files to another storage")
    c.add_argument("path")
    c.add_argument("target")
    c.add_argument("--delete-source", action="store_true")
    c.add_argument("--compact", action="store_true")
    c = s.add_parser("example-config")
    c.add_argument("path")
    return p


def run(args: argparse.Namespace) -> object:
    if args.command == "example-config":
        write_example(args.path)
        return {"written": args.path}
    cfg, spark = load_config(args.config), get_spark()
    if args.command == "etl":
        return job.drain(spark, args.source, cfg, args.start, args.end)
    if args.command == "watch":
        job.watch(spark, args.source, cfg, args.checkpoint, own_session=True).awaitTermination()
        return None
    if args.command == "retry":
        return {"segments": job.retry(spark, args.source, cfg)}
    if args.command == "compact":
        return layout.compact(spark, args.path, args.target_mb, args.min_files, args.max_file_mb, args.target_files, args.sort_by, args.dry_run)
    if args.command == "repartition":
        return layout.repartition(spark, args.path, args.target, args.by, dry_run=args.dry_run)
    if args.command == "validate":
        r = layout.validate(spark, args.path, args.columns)
        return {"ok": r.ok, **r.checks, **r.details}
    if args.command == "repair":
        return {"files": layout.repair(spark, args.path, args.columns)}
    if args.command == "health":
        waiting = segments.file_listing(spark, cfg.layout(args.source)["ready"], ".ndjson")
        return layout.backlog_health(waiting, int(time.time() * 1000)).first().asDict()
    return (sync.compact_then_sync if args.compact else sync.sync)(spark, args.path, args.target, delete_source=args.delete_source)


if __name__ == "__main__":
    print(json.dumps(run(parser().parse_args())))
