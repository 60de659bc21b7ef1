"""Queries of the problems in this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe.functions import normal
from tideframe.llm import leak, nearest, packing, pii
from tideframe.session import materialise, spread


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    entity = [normal.exchange("exchange").alias("exchange"), normal.instrument("symbol").alias("symbol")]
    trades = spark.read.parquet(f"{d}/trades.parquet").select(*entity, "timestamp", F.col("rec_no").alias("trade_rec_no"))
    book = spark.read.parquet(f"{d}/orderbook.parquet").select(*entity, "timestamp", "sequence_num")
    return nearest.match_nearest(trades, book, ["exchange", "symbol"], "timestamp", "trade_rec_no", "timestamp", "sequence_num").select("trade_rec_no", "sequence_num")


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(spread(packing.read_documents(spark, d)))


def p8_sequences(spark: SparkSession, d: str) -> DataFrame:
    """Every sequence with its documents and tokens."""
    return p8_packed(spark, d).groupBy("sequence_id").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("tokens"))


def p8_sound(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every packing, counted: documents placed, and cases of each fault."""
    p = materialise(p8_packed(spark, d), "sound")
    by_doc = p.groupBy("doc_id").agg(F.sum("tokens").alias("n"), F.max("piece").alias("last"), F.count("*").alias("pieces"), F.countDistinct("piece").alias("different"), F.sum((F.col("start") != F.col("piece") * packing.CAPACITY).cast("int")).alias("moved"))
    by_seq = p.groupBy("sequence_id").agg(F.sum("tokens").alias("n"), F.count("*").alias("members"))
    wrong = lambda c, n: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n)
    need = F.greatest(F.lit(1), F.ceil(F.col("n") / packing.CAPACITY))
    a = by_doc.agg(F.count("*").alias("documents"), wrong((F.col("pieces") != need) | (F.col("different") != F.col("pieces")) | (F.col("last") + 1 != F.col("pieces")), "cut_wrongly"), wrong(F.col("moved") > 0, "pieces_moved"))
    b = by_seq.agg(wrong(F.col("n") > packing.CAPACITY, "sequences_over"), wrong(F.col("members") > packing.MAX_DOCUMENTS, "sequences_crowded"))
    missing = read_ids(spark, d).join(p.select("doc_id").distinct(), "doc_id", "left_anti").agg(F.count("*").alias("documents_missing"))
    return a.join(F.broadcast(b), F.lit(True)).join(F.broadcast(missing), F.lit(True))  # one row each


def read_ids(spark: SparkSession, d: str) -> DataFrame:
    return packing.read_documents(spark, d).select("doc_id")


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaks(spread(packing.read_documents(spark, d)), spark.read.parquet(f"{d}/eval_items.parquet"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id").distinct()


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """The leaked items with the documents that hold them, and how many of those hold the answer too."""
    return _leaks(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"), F.count(F.when(F.col("answer_too"), 1)).alias("with_answer"))


def _tagger(spark: SparkSession, d: str) -> pii.Model:
    return pii.model_for(spark.read.parquet(f"{d}/name_lexicon.parquet"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find(spread(packing.read_documents(spark, d)), _tagger(spark, d)).select("doc_id", "pii_type", "start_pos").distinct()


def p10_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact(spread(packing.read_documents(spark, d)), _tagger(spark, d))


def queries() -> dict:
    return {n: f for n, f in globals().items() if n[:1] == "p" and n[1:2].isdigit()}


_WORDS = """list_filter(regexp_split_to_array(lower(regexp_replace(regexp_replace({0}, '[​­]', '', 'g'), '<[^>]*>|&(#\\d+|#[xX][0-9a-fA-F]+|\\w+);', ' ', 'g')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"""
_GRAMS = "list_distinct(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' ')))"


def oracle_sql() -> dict[str, str]:
    return {
        "p7_found": """with m as (select distinct lower(trim(exchange)) ex, replace(symbol, '-', '/') sy, "timestamp" ts, sequence_num s from orderbook where "timestamp" is not null),
 t as (select rec_no, lower(trim(exchange)) ex, replace(symbol, '-', '/') sy, "timestamp" ts from trades where "timestamp" is not null),
 b as (select t.rec_no, t.ts - m.ts d, m.ts mt, m.s from t asof join m on t.ex = m.ex and t.sy = m.sy and t.ts >= m.ts),
 f as (select t.rec_no, m.ts - t.ts d, m.ts mt, m.s from t asof join m on t.ex = m.ex and t.sy = m.sy and t.ts <= m.ts)
 select rec_no trade_rec_no, arg_min(s, (d, mt, s)) sequence_num from (select * from b union all select * from f) where d <= 5000 group by 1""",
        "p8_sound": """select count(*) documents, cast(0 as bigint) cut_wrongly, cast(0 as bigint) pieces_moved, cast(0 as bigint) sequences_over, cast(0 as bigint) sequences_crowded, cast(0 as bigint) documents_missing from documents""",
        "p9_items": f"""with dw as (select doc_id, {_WORDS.format('"text"')} w from documents), d as (select doc_id, unnest({_GRAMS}) g from dw),
 iw as (select item_id, {_WORDS.format("item_text")} w, {_WORDS.format("answer")} a from eval_items), i as (select item_id, unnest({_GRAMS}) g from iw),
 f as (select distinct doc_id, item_id from d join i using (g)) select item_id, count(*) documents, count(*) filter (len(a) > 0 and list_has_all(dw.w, a)) with_answer from f join dw using (doc_id) join iw using (item_id) group by 1""",
        "p9_found": f"""with d as (select doc_id, unnest({_GRAMS}) g from (select doc_id, {_WORDS.format('"text"')} w from documents)),
 i as (select item_id, unnest({_GRAMS}) g from (select item_id, {_WORDS.format("item_text")} w from eval_items)) select distinct doc_id, item_id from d join i using (g)""",
    }
