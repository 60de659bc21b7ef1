"""Problem 9: test items that stand in training documents, found by a BM25 inverted index with block-max WAND.

The test items are the indexed side. Every document is cut into passages of twice the required run with
half overlap, so that every run of ``RUN`` words lies in one passage, and every passage is a query.
An item's threshold is the least score that any run of ``RUN`` of its own words gives, so every passage
that holds such a run scores at least as much: nothing is lost. Passages whose bound over all items stays below the least threshold are skipped, and then all blocks of items whose bound stays below the
block's own: their postings are not read. Items at or above their threshold are retrieved and verified word by word.

Defined results: items of fewer than ``RUN`` words have no run and leak nowhere; repeated items and
documents are reported one by one; empty and null texts contain nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tideframe import schemas
from tideframe.session import ship

RUN = 12
#: Parameters of BM25.
K1, B = 1.2, 0.75
BLOCK = 16
#: Items in one index, of some 1 kB each for texts of usual length, and items whose indexes a task holds together; only for more than these
#: the documents are read again.
ITEMS_PER_INDEX, ITEMS_PER_PASS = 50_000, 500_000

_BLANKED = re.compile(r"<[^>]*>|&(?:#\d+|#[xX][0-9a-fA-F]+|\w+);")
_DROPPED = re.compile("[​­]")
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case, tags and entities blanked, invisible characters dropped."""
    if not text:
        return []
    if "​" in text or "­" in text:
        text = _DROPPED.sub("", text)
    if "<" in text or "&" in text:
        text = _BLANKED.sub(" ", text)
    return _WORD.findall(text.lower())


@dataclass
class Index:
    """Inverted index over the items in blocks: postings by word and item, bounds by word and by word and block, thresholds."""

    vocab: dict[str, int]
    top: np.ndarray  # by word: greatest weight in any item; one more row, of zero, for words of no item
    entries: np.ndarray  # entries of word w are entries[w]:entries[w+1], one for each block it stands in
    entry_block: np.ndarray
    entry_top: np.ndarray  # greatest weight of the word in the block
    entry_postings: np.ndarray  # postings of entry e are [entry_postings[e], entry_postings[e+1])
    items: np.ndarray
    weights: np.ndarray
    block_thresholds: np.ndarray
    thresholds: np.ndarray
    ids: list
    codes: np.ndarray  # word numbers of all items, one after another
    code_starts: np.ndarray
    answers: list
    run: int
    seen: dict = field(default_factory=dict)

    def runs(self, item: int) -> set[bytes]:
        """The runs of word numbers an item has, kept once asked for."""
        if item not in self.seen:
            if len(self.seen) > 5_000:
                self.seen.clear()
            c = self.codes[self.code_starts[item] : self.code_starts[item + 1]]
            self.seen[item] = {c[k : k + self.run].tobytes() for k in range(len(c) - self.run + 1)}
        return self.seen[item]


def build_index(rows: list[tuple], run: int = RUN) -> Index:
    """rows: (item_id, item_text, answer)."""
    texts = [(i, words(t), words(a)) for i, t, a in rows]
    texts = [x for x in texts if len(x[1]) >= run]
    vocab: dict[str, int] = {}
    coded = [np.array([vocab.setdefault(w, len(vocab)) for w in t], np.int32) for _, t, _ in texts]
    n, nv = len(coded), len(vocab)
    mean = np.mean([len(c) for c in coded]) if n else 1.0
    tf = [np.unique(c, return_inverse=True, return_counts=True) for c in coded]
    df = np.zeros(nv)
    for w, _, _ in tf:
        df[w] += 1
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    weight, thresholds = [], np.empty(n)
    for i, (w, at, c) in enumerate(tf):
        weight.append(idf[w] * c * (K1 + 1) / (c + K1 * (1 - B + B * len(coded[i]) / mean)))
        upto = np.concatenate([[0.0], np.cumsum(weight[i][at])])
        thresholds[i] = (upto[run:] - upto[:-run]).min() - 1e-6
    # Items of like thresholds share a block, which keeps the block's least threshold high.
    order = np.argsort(-thresholds, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    none = np.empty(0)
    word = np.concatenate([w for w, _, _ in tf]).astype(np.int64) if n else none.astype(np.int64)
    item = np.repeat(place, [len(w) for w, _, _ in tf]) if n else none.astype(np.int64)
    weight = np.concatenate(weight) if n else none
    o = np.lexsort((item, word))
    word, item, weight = word[o], item[o], weight[o]
    block = item // BLOCK
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (block[1:] != block[:-1])
    heads = np.flatnonzero(new)
    entry_top = np.maximum.reduceat(weight, heads) + 1e-6 if len(heads) else none
    top = np.zeros(nv + 1)
    np.maximum.at(top, word[heads], entry_top)
    thresholds = thresholds[order]
    least = np.minimum.reduceat(thresholds, np.arange(0, n, BLOCK)) if n else none
    coded = [coded[i] for i in order]
    return Index(
        vocab, top, np.searchsorted(word[heads], np.arange(nv + 1)), block[heads], entry_top, np.append(heads, len(word)), item, weight, least, thresholds, [texts[i][0] for i in order],
        np.concatenate(coded) if n else np.empty(0, np.int32), np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64), [texts[i][2] for i in order], run,
    )


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of several ranges, and the range each is from."""
    size = ends - starts
    of = np.repeat(np.arange(len(starts)), size)
    return np.arange(size.sum()) - (np.cumsum(size) - size)[of] + starts[of], of


def search(ix: Index, ids: np.ndarray) -> list[int]:
    """Items of the index that have a run in common with a document, given its word numbers (-1: not in any item).

    A passage is passed over if it holds no whole run of indexed words, or if the words' greatest weights cannot reach the least threshold. Of
    the others the bounds of the blocks are added up; postings are read of those blocks only that could reach their least threshold.
    """
    run, n = ix.run, len(ids)
    if n < run or not len(ix.thresholds):
        return []
    known = np.concatenate([[0], np.cumsum(ids >= 0)])
    whole = np.concatenate([[0], np.cumsum(known[run:] - known[:-run] == run)])  # runs of indexed words that begin before each place
    if not whole[-1]:
        return []
    bound = np.concatenate([[0.0], np.cumsum(ix.top[ids])])  # -1 is the last row, zero
    lo = np.arange(0, n - run + 1, run)
    hi = np.minimum(lo + 2 * run, n)
    alive = np.flatnonzero((whole[hi - run + 1] > whole[lo]) & (bound[hi] - bound[lo] >= ix.thresholds[-1] - 1e-6))
    found: set[int] = set()
    for p in alive.tolist():
        a, b = int(lo[p]), int(hi[p])
        q = ids[a:b]
        q, times = np.unique(q[q >= 0], return_counts=True)
        e, of = _ranges(ix.entries[q], ix.entries[q + 1])
        blocks, at = np.unique(ix.entry_block[e], return_inverse=True)
        hot = np.bincount(at, ix.entry_top[e] * times[of]) >= ix.block_thresholds[blocks] - 1e-4
        if not hot.any():
            continue
        live = hot[at]
        e, of = e[live], of[live]
        post, entry = _ranges(ix.entry_postings[e], ix.entry_postings[e + 1])
        cand, at = np.unique(ix.items[post], return_inverse=True)
        score = np.bincount(at, ix.weights[post] * times[of][entry])
        cand = [c for c in cand[score >= ix.thresholds[cand]].tolist() if c not in found]
        if cand:
            grams = [ids[k : k + run].tobytes() for k in range(a, b - run + 1)]
            found.update(c for c in cand if not ix.runs(c).isdisjoint(grams))
    return sorted(found)


_FOUND = schemas.of(doc_id="long", item_id="long", answer_too="boolean")


def leaks(documents: DataFrame, items: DataFrame, run: int = RUN, items_per_index: int = ITEMS_PER_INDEX, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """doc_id, item_id and answer_too (all words of the answer stand in the document as well).

    The documents are read and cut into words once for all indexes that are held together.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = [(r.item_id, r.item_text, r.answer) for r in items.select("item_id", "item_text", "answer").toLocalIterator()]
    out = None
    for k in range(0, max(1, len(rows)), items_per_pass):
        some = rows[k : k + items_per_pass]
        held = [spark.sparkContext.broadcast(build_index(some[i : i + items_per_index], run)) for i in range(0, max(1, len(some)), items_per_index)]

        def find(batches, held=held):
            indexes = [h.value for h in held]
            none = [-1]
            for b in batches:
                d, i, a = [], [], []
                for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    ws, has = words(text), None
                    for ix in indexes:
                        get = ix.vocab.get
                        hits = search(ix, np.array([get(w, -1) for w in ws] or none, np.int32))
                        if hits:
                            has = has or set(ws)
                            d += [doc] * len(hits)
                            i += [ix.ids[h] for h in hits]
                            a += [bool(ix.answers[h]) and has.issuperset(ix.answers[h]) for h in hits]
                if d:
                    yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(a, pa.bool_())], ["doc_id", "item_id", "answer_too"])

        part = documents.select("doc_id", "text").mapInArrow(find, _FOUND)
        out = part if out is None else out.unionByName(part)
    return out
