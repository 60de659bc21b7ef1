"""The ETL job: closed segments to channel datasets, by batch or as a stream."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideframe.config import Config, FeatureConfig
from tideframe.functions import fs
from tideframe.operators import enrich, features, parse
from tideframe.session import clean_scratch, materialise, small
from tideframe.sources import segments, sinks
from tideframe.streaming import carried, live


def with_arrival(messages: DataFrame, files_before: int = 0) -> DataFrame:
    """Adds ``seq``, the order of arrival: the rank of the segment by name, after those before, then the line's number within it.

    Lines are numbered within a segment, whose size is bounded; the names of the segments are as many as were listed.
    """
    spark = messages.sparkSession
    names = sorted(r._file for r in messages.select("_file").distinct().collect())
    rank = small(spark.createDataFrame(list(enumerate(names, files_before)) or [], "_rank long, _file string"), len(names))
    line = F.row_number().over(W.partitionBy("_file").orderBy("_line"))
    return messages.withColumn("_no", line).join(rank, "_file").withColumn("seq", F.col("_rank") * F.lit(1 << 33) + F.col("_no")).drop("_rank", "_no")


def _plain(parsed: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """The enabled channels whose rows need no others."""
    fn = {"ticker": lambda: enrich.unified_ticker(parse.ticker(parsed)), "trades": lambda: enrich.unified_trades(parse.trades(parsed))}
    return {c: fn[c]() for c in cfg.enabled_channels() if c in fn}


def _books_and_trades(seq: DataFrame) -> tuple[DataFrame, DataFrame]:
    b = parse.orderbook(seq, ["seq"]).withColumn("ts", F.col("timestamp"))
    t = parse.trades(seq, ["seq"]).withColumn("ts", F.col("timestamp"))
    return b.select("exchange", "symbol", "ts", "seq", "bids", "asks"), t.select("exchange", "symbol", "ts", "seq", "side", "amount")


def _partitions(outputs: dict[str, DataFrame], cfg: Config) -> dict[str, list[str]]:
    return {n: [p for p in cfg.channels[n.split("_")[0]].partition_cols if p in d.columns] for n, d in outputs.items()}


def process_segments(spark: SparkSession, paths: list[str], out: str, cfg: Config = Config(), features_of_books: bool = True) -> dict[str, int]:
    """Parse segments once and write every enabled channel; books also give features (hf) and bars. Counts lines and rejects."""
    lines = segments.read_lines(spark, paths)
    parsed, bad = segments.parse_json(lines, parse.ENVELOPE)
    parsed = materialise(parsed, "parsed")
    stats = {"messages": parsed.count(), "rejected": bad.count()}
    outputs = _plain(parsed, cfg)
    if "orderbook" in cfg.enabled_channels():
        if features_of_books:
            fc = FeatureConfig.from_options(cfg.channels["orderbook"].processor_options)
            b, t = _books_and_trades(with_arrival(parsed))
            outputs["orderbook_hf"] = features.hf_features(b, t, fc)
            outputs["orderbook_bars"] = features.feature_bars(b, fc)
        else:
            outputs["orderbook"] = parse.orderbook(parsed)
    parts = _partitions(outputs, cfg)
    sinks.write_outputs(outputs, out, parts)
    return stats


def drain(spark: SparkSession, source: str, cfg: Config, start: str | None = None, end: str | None = None) -> dict[str, int]:
    """Process the ready segments of a source, claimed by a move; after success they are deleted or kept in processing.

    A failure leaves them in processing, from where ``retry`` takes them back: nothing is deleted that was not written.
    """
    at = cfg.layout(source)
    ready = segments.segments(spark, at["ready"], start, end)
    mine = []
    for p in ready:
        to = f"{at['processing']}/{p.rsplit('/', 1)[-1]}"
        fs.rename(spark, p, to)
        mine.append(to)
    if not mine:
        return {"messages": 0, "rejected": 0}
    stats = process_segments(spark, mine, at["processed"], cfg)
    if cfg.delete_after_processing:
        for p in mine:
            fs.delete(spark, p)
    return stats


def retry(spark: SparkSession, source: str, cfg: Config) -> int:
    """Segments of a failed run back to ready."""
    at = cfg.layout(source)
    left = segments.segments(spark, at["processing"])
    for p in left:
        fs.rename(spark, p, f"{at['ready']}/{p.rsplit('/', 1)[-1]}")
    return len(left)


def stream_sink(out: str, cfg: Config, state: str, delay_ms: int, own_session: bool = False) -> Callable[[DataFrame, int], None]:
    """The outputs of ``process_segments`` for each micro-batch of lines, and its counts in ``_stats``. A batch done again replaces its own folders."""

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        lines = batch.filter(F.trim("value") != "").select("value", "_file", F.struct("_block", F.monotonically_increasing_id().alias("_row")).alias("_line"))
        lines = materialise(lines, "lines")
        parsed, bad = segments.parse_json(lines, parse.ENVELOPE)
        parsed = materialise(parsed, "parsed")
        stats = {"messages": parsed.count(), "rejected": bad.count(), "late": 0}
        outputs = _plain(parsed, cfg)
        if "orderbook" in cfg.enabled_channels():
            files = parsed.select("_file").distinct().count()
            b, t = _books_and_trades(with_arrival(parsed, carried.before(spark, state, number)[1]["files"]))
            fc = FeatureConfig.from_options(cfg.channels["orderbook"].processor_options)
            outputs["orderbook_hf"], outputs["orderbook_bars"], stats["late"] = carried.step(spark, state, number, b, t, files, fc, delay_ms)
        parts = _partitions(outputs, cfg)
        for n, d in outputs.items():
            at = f"{out}/{n}/batch={number}"
            fs.delete(spark, at)
            sinks.write_dataset(d, at, parts[n])
        fs.write_text(spark, f"{out}/_stats/batch={number}.json", json.dumps(stats))
        if own_session:
            clean_scratch(spark)

    return sink


def watch(spark: SparkSession, source: str, cfg: Config, checkpoint: str, once: bool = False, delay_ms: int = 10_000, own_session: bool = False):
    """The job as a stream over the ready folder, with the outputs of the batch job; books and trades wait ``delay_ms`` for others of their time.

    ``own_session``: nothing else in the session uses the shared folder, so what a micro-batch left there is removed after it.
    """
    at = cfg.layout(source)
    lines = live.read_segments(spark, at["ready"], cfg.max_files_per_trigger, "delete" if cfg.delete_after_processing else None)
    sink = stream_sink(at["processed"], cfg, f"{checkpoint.rstrip('/')}/carried", delay_ms, own_session)
    return live.start(lines, sink, checkpoint, None if once else f"{cfg.poll_seconds} seconds")


def migrate_schema(spark: SparkSession, source: str, cfg: Config, channels: list[str], archive: str | None = None, segments_from: str | None = None) -> dict[str, int]:
    """Make channels' datasets anew after a change of schema: their old folders are archived (or deleted), then the segments kept in a folder are processed again."""
    out = cfg.layout(source)["processed"]
    names = [n for n in fs.subdirs(spark, out) if n.split("_")[0] in channels]
    for n in names:
        if archive:
            fs.rename(spark, f"{out}/{n}", f"{archive.rstrip('/')}/{n}")
        else:
            fs.delete(spark, f"{out}/{n}")
    if not segments_from:
        return {"messages": 0, "rejected": 0}
    only = Config.from_dict(cfg.to_dict())
    only.channels = {c: o for c, o in cfg.channels.items() if c in channels}
    return process_segments(spark, segments.segments(spark, segments_from), out, only)
