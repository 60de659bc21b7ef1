"""Problem 8: documents put together into sequences of fixed capacity, by vector best-fit.

Texts are counted in tokens where they are read; only (doc_id, tokens) move on. A text above the capacity is
cut into full sequences and a rest; no other text is cut. Items are packed in shards of bounded size, largest
first: among the open bins in which an item fits under every constraint (tokens, documents,
attention cost, the sum of squared lengths) it goes where the weighted norm of what remains is least.
The items of poorly filled bins of all shards are packed once more together.

Defined results: an empty or null text has no tokens and still gets a place, as a document of zero tokens;
of equal sizes the lesser doc_id goes first; no documents, no sequences.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideframe import schemas
from tideframe.session import materialise, ship

CAPACITY = 2_048
MAX_DOCUMENTS = 256
#: Items packed by one task; a shard leaves about one bin that is not full.
SHARD_ITEMS = 20_000
#: Bins filled less than this are packed once more.
WELL_FILLED = 0.97
WEIGHTS = (1.0, 0.02, 0.02)
TOKENIZER = os.environ.get("TIDEFRAME_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: how this vocabulary splits a text into words before merging bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary(path: str = TOKENIZER) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encoding(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("tideframe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str = TOKENIZER):
    return encoding(vocabulary(path))


def count_tokens(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id and tokens of each whole text. The vocabulary is read on the driver and given to the executors, which need no copy of it."""
    ranks = documents.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches):
        enc = encoding(ranks.value)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "tokens"])

    ship(documents.sparkSession)
    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, tokens long")


def best_fit(sizes, capacity: int = CAPACITY, max_documents: int = MAX_DOCUMENTS, attention: int | None = None, weights=WEIGHTS):
    """Bin number of each item, for sizes in descending order, none above the capacity."""
    import numpy as np

    attention = capacity * capacity if attention is None else attention
    n = len(sizes)
    out = np.empty(n, np.int64)
    cap = 1024
    tok, doc, att, no = np.empty(cap, np.int64), np.empty(cap, np.int64), np.empty(cap, np.int64), np.empty(cap, np.int64)
    opened = bins = 0
    least = int(sizes[-1]) if n else 0
    w0, w1, w2 = weights[0] / capacity**2, weights[1] / max_documents**2, weights[2] / attention**2
    for i in range(n):
        t = int(sizes[i])
        rt = tok[:opened] - t
        ra = att[:opened] - t * t
        fits = np.flatnonzero((rt >= 0) & (ra >= 0) & (doc[:opened] > 0))
        if len(fits):
            a, b, c = rt[fits].astype(float), (doc[fits] - 1).astype(float), ra[fits].astype(float)
            j = fits[np.argmin(w0 * a * a + w1 * b * b + w2 * c * c)]
        else:
            if t * t > attention:
                raise ValueError(f"an item of {t} tokens exceeds the attention cost")
            if opened == cap:  # bins that can take nothing any more are closed before room is made
                live = (tok[:opened] >= least) & (doc[:opened] > 0)
                k = int(live.sum())
                for x in (tok, doc, att, no):
                    x[:k] = x[:opened][live]
                opened = k
                if opened > cap // 2:
                    tok, doc, att, no = (np.concatenate([x, np.empty(cap, np.int64)]) for x in (tok, doc, att, no))
                    cap *= 2
            j = opened
            tok[j], doc[j], att[j], no[j] = capacity, max_documents, attention, bins
            opened, bins = opened + 1, bins + 1
        tok[j] -= t
        doc[j] -= 1
        att[j] -= t * t
        out[i] = no[j]
        if tok[j] < least or doc[j] == 0:  # full: the last open bin takes its place
            opened -= 1
            for x in (tok, doc, att, no):
                x[j] = x[opened]
    return out


_PACKED = schemas.of(doc_id="long", piece="int", start="long", tokens="long", shard="long", bin="long", fill="long", members="int")


def _pack(items: DataFrame, shards: int, capacity: int, max_documents: int, attention: int | None) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        import numpy as np

        t = t.sort_by([("tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        size = t["tokens"].to_numpy()
        b = best_fit(size, capacity, max_documents, attention)
        fill, members = np.bincount(b, weights=size).astype("i8"), np.bincount(b).astype("i4")
        for n, v in (("bin", b), ("fill", fill[b]), ("members", members[b])):
            t = t.append_column(n, pa.array(v))
        return t.select(_PACKED.names)

    # As many partitions as shards: the rows are few bytes, and shards joined into one task would be packed one after another.
    d = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards))).repartition(shards, "shard")
    return d.groupBy("shard").applyInArrow(run, _PACKED)


def pack(documents: DataFrame, capacity: int = CAPACITY, max_documents: int = MAX_DOCUMENTS, attention: int | None = None, path: str = TOKENIZER, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """sequence_id, doc_id, piece, start (first token of the piece in its text) and tokens, for every document."""
    counted = materialise(count_tokens(documents, path), "tokens")
    piece = F.posexplode(F.expr(f"sequence(0L, greatest(0L, (tokens - 1) div {capacity}))"))
    items = counted.select("doc_id", F.col("tokens").alias("all"), piece.alias("piece", "k")).select("doc_id", "piece", (F.col("k") * capacity).alias("start"), F.least(F.col("all") - F.col("k") * capacity, F.lit(capacity)).alias("tokens"))
    full = items.filter(F.col("tokens") == capacity)
    rest = items.filter(F.col("tokens") < capacity)
    n = rest.count()
    shards = max(1, -(-n // shard_items))
    packed = materialise(_pack(rest, shards, capacity, max_documents, attention), "packed")
    name = lambda tag: F.concat_ws("-", F.lit(tag), "shard", "bin")
    good = (F.col("fill") >= int(WELL_FILLED * capacity)) | (F.col("members") >= max_documents)
    again = packed.filter(~good)
    m = again.count()
    second = _pack(again.select("doc_id", "piece", "start", "tokens"), max(1, -(-m // shard_items)), capacity, max_documents, attention)
    out = packed.filter(good).select(name("a").alias("sequence_id"), "doc_id", "piece", "start", "tokens").unionByName(second.select(name("b").alias("sequence_id"), "doc_id", "piece", "start", "tokens"))
    own = F.concat_ws("-", F.lit("f"), "doc_id", "piece")
    return out.unionByName(full.select(own.alias("sequence_id"), "doc_id", "piece", "start", "tokens"))


def read_documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
