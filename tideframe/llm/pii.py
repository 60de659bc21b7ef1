"""Problem 10: personal information in free text, found by a linear-chain conditional random field.

Texts are cut into words, numbers and signs. Each has features of its shape, ending, case and lexicon entry, seen from
up to three places away; of the last and next word; and of the chunk and the group of digits it lies in. The
weights are learned by stochastic gradient on the likelihood of a small labelled table (``pii_table``), the best labelling is
found by Viterbi for many lines at once in numpy. Lines no label of which could pay are passed over, by a
bound that cannot miss one; lines seen before in the same task are looked up.

Defined results: null and empty texts hold nothing; each occurrence is reported once with its first character, counted in
characters of the whole text; overlapping occurrences do not arise; repeated rows are reported each.
"""

from __future__ import annotations

import re
import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tideframe import schemas
from tideframe.llm.pii_table import LABELLED, labelled_rows
from tideframe.session import ship

#: Bounds of the training: lines of the labelled table, passes over it, lines in a step; and names taken from a lexicon.
TRAIN_LINES, EPOCHS, STEP_LINES, LEXICON_NAMES = 6_000, 5, 48, 200_000
REACH = 3
LABELS = ["O", *[f"{p}-{t}" for t in LABELLED for p in "BI"]]
L = len(LABELS)
_TOKEN = re.compile(r"\s*(?:[^\W\d_]+|\d+|[^\w\s]|_)")
_INVISIBLE = re.compile("[​­]")
_SEPARATORS = frozenset("+-./()")
CHUNK_CODES, DIGIT_CODES = 64, 16 * 6
PLACEHOLDERS = {t: f"[{t.upper()}]" for t in LABELLED}
#: Tokens decoded together; texts longer than that are decoded on their own.
BATCH_TOKENS = 150_000


#: Words for streets, endings of such words, and titles of persons, in the languages of the labelled table.
_STREET_WORDS = frozenset("street st lane road rd close avenue ave way drive court crescent terrace square row hill gardens grove rue boulevard place quai chemin impasse allée calle avenida plaza paseo camino ul al pl os ул пр пер наб просп".split())
_STREET_ENDINGS = ("weg", "gasse", "straße", "strasse", "platz", "allee", "damm")
_TITLES = frozenset("mr mrs ms miss dr prof professor sir captain rev herr herrn frau m mme mlle madame monsieur sr sra don doña señor señora pan pani pana доктор проф".split())


def _features(token: str, given: frozenset, surnames: frozenset) -> list[str]:
    w = token.lstrip()
    space = "_" if len(w) < len(token) else ""
    if w.isdigit():
        shape = "d" + str(min(len(w), 12))
        out = [shape, space + shape]
        if len(w) <= 3:
            out.append("w=" + w)
        return out
    low = w.lower()
    if low[0] in "ðñ" or "\x80" <= low[0] <= "\x9f":  # letters of another script read in the wrong encoding
        return ["misread"]
    if not w.isalpha():
        return ["w=" + w, space + w]
    case = "X" if len(w) == 1 and w.isupper() else "XX" if w.isupper() else "Xx" if w[0].isupper() else "x"
    if case == "Xx" and any(c.isupper() for c in w[1:]):
        case = "XxX"
    script = "" if low.isascii() else "c" if "а" <= low[0] <= "я" or low[0] == "ё" else "l"
    out = [case, space + case, "w=" + low, f"{case}{script}{min(len(w), 9)}"]
    if low in _STREET_WORDS or low.endswith(_STREET_ENDINGS):
        out += ["street", space + "street"]
    if low in _TITLES:
        out.append("title")
    if len(w) > 3:
        out += ["3" + low[-3:], "2" + low[-2:], "p" + low[:3], case + "3" + low[-3:]]
    if w in given or w.capitalize() in given:
        out += ["given", case + "given"]
    if w in surnames or w.capitalize() in surnames:
        out += ["surname", case + "surname"]
    return out


# What a token is for the chunk and digit-group features.
_AT, _DIGIT, _DOT, _LETTER, _UPPER, _JOIN, _SEP, _ATWORD, _OPEN, _HASH, _N64, _SPACE, _WORDLIKE = (1 << i for i in range(13))


def _kind(token: str) -> int:
    w = token.lstrip()
    k = _SPACE if len(w) < len(token) else 0
    if w.isdigit():
        return k | _DIGIT | (_N64 if w == "64" else 0)
    if w.isalpha():
        return k | _LETTER | (_WORDLIKE if len(w) > 1 else 0) | (_UPPER if w[0].isupper() else 0) | (_ATWORD if w.lower() == "at" else 0)
    return k | (_AT if w == "@" else 0) | (_DOT if w == "." else 0) | (_JOIN if w in "_-+" else 0) | (_SEP if w in _SEPARATORS else 0) | (_OPEN if w in "[(" else 0) | (_HASH if w == "#" else 0)


def _context(kind: np.ndarray, size: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, ...]:
    """Chunk code of each token, of the chunk before and after, its digit-group code, and the places of the last and next word (-1: none)."""
    n = len(kind)
    prev = np.concatenate([[0], kind[:-1]])
    same = np.concatenate([[False], line[1:] == line[:-1]])
    at = (kind & _AT > 0) | ((kind & _ATWORD > 0) & (prev & _OPEN > 0) & same) | ((kind & _N64 > 0) & (prev & _HASH > 0) & same)
    flags = at * 1 | (kind & _DIGIT > 0) * 2 | (kind & _DOT > 0) * 4 | (kind & _LETTER > 0) * 8 | (kind & _UPPER > 0) * 16 | (kind & _JOIN > 0) * 32
    start = (kind & _SPACE > 0) | ~same
    first = np.flatnonzero(start)
    chunk = np.cumsum(start) - 1
    code = np.bitwise_or.reduceat(flags, first) if n else flags
    cl = line[first]
    before = np.where(np.concatenate([[False], cl[1:] == cl[:-1]]), np.concatenate([[0], code[:-1]]), 0)
    after = np.where(np.concatenate([cl[1:] == cl[:-1], [False]]), np.concatenate([code[1:], [0]]), 0)
    member = kind & (_DIGIT | _SEP) > 0
    edge = np.flatnonzero(np.concatenate([[True], (member[1:] != member[:-1]) | ~same[1:]]))
    group = np.cumsum(np.isin(np.arange(n), edge)) - 1
    digit = kind & _DIGIT > 0
    total = np.minimum(np.add.reduceat(np.where(digit, size, 0), edge), 15)
    parts = np.minimum(np.add.reduceat(digit.astype(np.int64), edge), 5)
    digits = np.where(member, (total * 6 + parts)[group], 0)
    idx = np.arange(n)
    word = kind & _WORDLIKE > 0
    last = np.maximum.accumulate(np.where(word, idx, -1))
    last = np.concatenate([[-1], last[:-1]])
    nxt = np.minimum.accumulate(np.where(word, idx, n)[::-1])[::-1]
    nxt = np.concatenate([nxt[1:], [n]])
    last = np.where((last >= 0) & (line[np.maximum(last, 0)] == line), last, -1)
    nxt = np.where((nxt < n) & (line[np.minimum(nxt, n - 1)] == line), nxt, -1)
    return code[chunk], before[chunk], after[chunk], digits, last, nxt


@dataclass
class Model:
    """Weights of the field. ``words`` has a row for each feature: seen at -3..3, as the last and as the next word."""

    features: dict[str, int]
    words: np.ndarray
    chunks: np.ndarray  # own, before, after
    digits: np.ndarray
    moves: np.ndarray
    given: frozenset = field(default_factory=frozenset)
    surnames: frozenset = field(default_factory=frozenset)
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def rows(self, token: str) -> list[int]:
        get = self.features.get
        return [i for i in (get(f) for f in _features(token, self.given, self.surnames)) if i is not None]


PLACES_SEEN = 2 * REACH + 3


def _allowed() -> np.ndarray:
    """Zero where a label may follow another, else minus infinity."""
    ok = np.zeros((L, L))
    for a, x in enumerate(LABELS):
        for b, y in enumerate(LABELS):
            if y[0] == "I" and x not in (y, "B" + y[1:]):
                ok[a, b] = -np.inf
    return ok


def _tokens(lines: list[list[tuple[str, str]]]) -> tuple[list[str], np.ndarray, np.ndarray, set[str]]:
    """Tokens, labels, line numbers, and the words that stand outside the slots."""
    toks, labels, where, plain = [], [], [], set()
    for i, line in enumerate(lines):
        text = "".join(t for t, _ in line)
        spans, at = [], 0
        for t, label in line:
            if label:
                spans.append((at, at + len(t), label))
            at += len(t)
        end = 0
        for tok in _TOKEN.findall(text):
            end += len(tok)
            start = end - len(tok.lstrip())
            got = next((s for s in spans if s[0] <= start < s[1]), None)
            labels.append(0 if got is None else LABELS.index(("B-" if start == got[0] else "I-") + got[2]))
            if got is None or got[2] in ("address", "email", "phone"):
                plain.add(tok.strip().lower())
            toks.append(tok)
            where.append(i)
    return toks, np.array(labels), np.array(where), plain


def train(given: list[str], surnames: list[str], lines: int = TRAIN_LINES, epochs: int = EPOCHS, seed: int = 7, rate: float = 0.25, decay: float = 2e-4, forms: str = "all") -> Model:
    """Fit the field to ``lines`` labelled lines; the same arguments give the same weights. ``forms``: of which forms of the table."""
    rows = labelled_rows(sorted(given), sorted(surnames), lines, seed, forms)
    toks, y, line, plain = _tokens(rows)
    g, s = frozenset(given), frozenset(surnames)
    types = list(dict.fromkeys(toks))
    number = {t: i for i, t in enumerate(types)}
    t_of = np.array([number[t] for t in toks])
    used: dict[str, int] = {}
    feats = []
    for t in types:
        own = [f for f in _features(t, g, s) if not (f.startswith("w=") and f[2:] not in plain)]
        feats.append(np.array([used.setdefault(f, len(used)) for f in own], np.int64))
    flat, owner = np.concatenate(feats), np.repeat(np.arange(len(types)), [len(f) for f in feats])
    kind, size = np.array([_kind(t) for t in types])[t_of], np.array([len(t.lstrip()) for t in types])[t_of]
    code, before, after, digits, last, nxt = _context(kind, size, line)
    m = Model(used, np.zeros((len(used), PLACES_SEEN, L)), np.zeros((3, CHUNK_CODES, L)), np.zeros((DIGIT_CODES, L)), np.zeros((L, L)), g, s)
    allowed = _allowed()
    heads = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    lens = np.diff(np.concatenate([heads, [len(line)]]))
    rng = np.random.default_rng(seed)
    params = [m.words, m.chunks, m.digits, m.moves]
    seen = [np.full(p.shape, 1e-2) for p in params]
    n = len(toks)
    neighbour = np.stack([np.where((np.arange(n) + o >= 0) & (np.arange(n) + o < n) & (line[np.clip(np.arange(n) + o, 0, n - 1)] == line), np.clip(np.arange(n) + o, 0, n - 1), -1) for o in range(-REACH, REACH + 1)] + [last, nxt])
    for epoch in range(epochs):
        order = rng.permutation(len(heads))
        for k in range(0, len(order), STEP_LINES):
            pick = order[k : k + STEP_LINES]
            pick = pick[np.argsort(-lens[pick], kind="stable")]
            width = lens[pick].max()
            grid = heads[pick][:, None] + np.arange(width)
            real = np.arange(width) < lens[pick][:, None]
            at = grid[real]
            near = neighbour[:, at]
            nt = np.where(near >= 0, t_of[near], -1)
            need = np.unique(nt[nt >= 0])
            sel = np.isin(owner, need)
            local = np.searchsorted(need, owner[sel])
            table = np.zeros((len(need) + 1, PLACES_SEEN, L))
            np.add.at(table, local, m.words[flat[sel]])
            rows_at = np.where(nt >= 0, np.searchsorted(need, nt), len(need))
            em = m.chunks[0, code[at]] + m.chunks[1, before[at]] + m.chunks[2, after[at]] + m.digits[digits[at]]
            for p in range(PLACES_SEEN):
                em = em + table[rows_at[p], p]
            e = np.zeros((len(pick), width, L))
            e[real] = em
            moves = m.moves + allowed
            grad_e, grad_m = _gradient(e, real, moves, np.where(real, y[np.minimum(grid, n - 1)], 0))
            ge = grad_e[real]
            gt = np.zeros_like(table)
            for p in range(PLACES_SEEN):
                np.add.at(gt[:, p], rows_at[p], ge)
            gw = np.zeros_like(m.words)
            np.add.at(gw, flat[sel], gt[:-1][local])
            gc, gd = np.zeros_like(m.chunks), np.zeros_like(m.digits)
            for c, codes in enumerate((code, before, after)):
                np.add.at(gc[c], codes[at], ge)
            np.add.at(gd, digits[at], ge)
            for p, sq, gr in zip(params, seen, (gw, gc, gd, grad_m)):
                gr = gr / len(pick)
                sq += gr * gr
                p -= rate * (gr / np.sqrt(sq) + decay * p)
    return m


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def _starts() -> np.ndarray:
    return np.array([-np.inf if x[0] == "I" else 0.0 for x in LABELS])


def _gradient(e: np.ndarray, real: np.ndarray, moves: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected minus observed counts of labels at places and of moves, by forward and backward sums."""
    b, width, _ = e.shape
    fwd, bwd = np.zeros_like(e), np.zeros_like(e)
    fwd[:, 0] = e[:, 0] + _starts()
    for t in range(1, width):
        step = _lse(fwd[:, t - 1][:, :, None] + moves, 1) + e[:, t]
        fwd[:, t] = np.where(real[:, t][:, None], step, fwd[:, t - 1])
    for t in range(width - 2, -1, -1):
        step = _lse(moves + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
        bwd[:, t] = np.where(real[:, t + 1][:, None], step, 0.0)
    z = _lse(fwd[:, -1], 1)
    p = np.exp(fwd + bwd - z[:, None, None]) * real[:, :, None]
    i, j = np.nonzero(real)
    p[i, j, y[real]] -= 1
    both = real[:, 1:]
    with np.errstate(invalid="ignore"):
        pair = np.exp(fwd[:, :-1, :, None] + moves + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None])
    gm = (np.nan_to_num(pair) * both[:, :, None, None]).sum(axis=(0, 1))
    np.add.at(gm, (y[:, :-1][both], y[:, 1:][both]), -1)
    return p, gm


def _viterbi(e: np.ndarray, lens: np.ndarray, moves: np.ndarray) -> list[np.ndarray]:
    """Best labels of lines given longest first, padded to one width."""
    b, width, _ = e.shape
    back = np.zeros((width, b, L), np.int8)
    score = e[:, 0] + _starts().astype(e.dtype)
    by_target = np.ascontiguousarray(moves.T)[None]
    final = score.copy()
    alive = b
    for t in range(1, width):
        alive = int(np.searchsorted(-lens, -t))  # lines longer than t
        s = score[:alive, None, :] + by_target
        k = s.argmax(axis=2)
        back[t, :alive] = k
        score = np.take_along_axis(s, k[:, :, None], 2)[:, :, 0] + e[:alive, t]
        final[:alive] = score
    out = np.zeros((b, width), np.int8)
    cur = final.argmax(axis=1)
    for t in range(width - 1, -1, -1):
        alive = lens > t
        out[alive, t] = cur[alive]
        if t:
            cur = np.where(alive, back[t][np.arange(b), cur], cur)
    return [out[i, : lens[i]] for i in range(b)]


class Tagger:
    """Decodes texts; keeps what it knows of tokens and lines for as long as a task runs."""

    def __init__(self, model: Model, keep_lines: int = 60_000, keep_tokens: int = 300_000):
        self.m, self.keep_lines, self.keep_tokens = model, keep_lines, keep_tokens
        self.moves = (model.moves + _allowed()).astype(np.float32)
        # Scores relative to the label O change no best labelling; they are what the bound is about.
        self.gain = 2 * max(0.0, float(np.max(np.where(np.isfinite(self.moves), self.moves, -1e9)) - self.moves[0, 0]))  # k labels take k + 1 moves
        own = lambda a: (a - a[..., :1]).astype(np.float32)
        self.words, self.chunks, self.digits = own(model.words), own(model.chunks), own(model.digits)
        self.lines: dict[str, tuple] = {}
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((4096, PLACES_SEEN, L), np.float32)
        self.kinds, self.sizes, self.bares = (np.zeros(4096, np.int64) for _ in range(3))

    def _new(self, token: str) -> int:
        i = len(self.number) + 1
        if i >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.kinds, self.sizes, self.bares = (np.concatenate([x, np.zeros_like(x)]) for x in (self.kinds, self.sizes, self.bares))
        self.table[i] = self.words[self.m.rows(token)].sum(axis=0)
        self.kinds[i], self.sizes[i], self.bares[i] = _kind(token), len(token), len(token.lstrip())
        self.number[token] = i
        return i

    def _emissions(self, t: np.ndarray, size: np.ndarray, line: np.ndarray) -> np.ndarray:
        code, before, after, digits, last, nxt = _context(self.kinds[t], size, line)
        e = self.chunks[0][code] + self.chunks[1][before] + self.chunks[2][after] + self.digits[digits] + self.table[:, REACH][t]
        n = len(t)
        for o in range(1, REACH + 1):
            same = line[o:] == line[:-o]
            e[o:] += self.table[:, REACH - o][np.where(same, t[:-o], 0)]
            e[:-o] += self.table[:, REACH + o][np.where(same, t[o:], 0)]
        e += self.table[:, -2][np.where(last >= 0, t[last], 0)]
        e += self.table[:, -1][np.where(nxt >= 0, t[np.minimum(nxt, n - 1)], 0)]
        return e

    def _decode(self, lines: list[str]) -> None:
        """Put the spans of new lines into ``self.lines``."""
        if len(self.number) > self.keep_tokens:
            self._forget()
        get, toks, count = self.number.get, [], []
        for s in lines:
            f = _TOKEN.findall(s)
            toks += f
            count.append(len(f))
        for s, c in zip(lines, count):
            if not c:
                self.lines[s] = ()
        if not toks:
            return
        t = np.array([get(x) or self._new(x) for x in toks], np.int64)
        size, bare = self.sizes[t], self.bares[t]
        count = np.array(count)
        line = np.repeat(np.arange(len(lines)), count)
        ends = np.cumsum(size)
        heads = np.concatenate([[0], np.cumsum(count)[:-1]])
        offset = ends[np.maximum(heads - 1, 0)] * (heads > 0)
        e = self._emissions(t, bare, line)
        # A labelled stretch can only pay if one of its tokens pays by itself with the best move.
        pays = np.zeros(len(lines), bool)
        pays[line[e[:, 1:].max(axis=1) + self.gain > 0]] = True
        for i in np.flatnonzero(~pays):
            self.lines[lines[i]] = ()
        todo = np.flatnonzero(pays & (count > 0))
        todo = todo[np.argsort(-count[todo], kind="stable")]
        k = 0
        while k < len(todo):
            width = int(count[todo[k]])
            some = todo[k : k + max(1, BATCH_TOKENS // width)]
            some = some[count[some] * 2 >= width] if len(some) > 1 else some
            k += len(some)
            pad = np.zeros((len(some), width, L), np.float32)
            for r, i in enumerate(some):
                pad[r, : count[i]] = e[heads[i] : heads[i] + count[i]]
            for i, labels in zip(some, _viterbi(pad, count[some], self.moves)):
                hit = np.flatnonzero(labels)
                spans = []
                for p in hit.tolist():
                    a = int(ends[heads[i] + p] - bare[heads[i] + p] - offset[i])
                    z = int(ends[heads[i] + p] - offset[i])
                    if labels[p] % 2 == 1 or not spans:
                        spans.append([LABELLED[(labels[p] - 1) // 2], a, z])
                    else:
                        spans[-1][2] = z
                self.lines[lines[i]] = tuple((kind, a, z) for kind, a, z in spans if plausible(kind, lines[i][a:z]))

    def spans(self, texts: list[str | None]) -> list[list[tuple[str, int, int]]]:
        """(type, start, end) of each text, in order."""
        if len(self.lines) > self.keep_lines:
            self.lines = {}
        cut, size = [], 0
        new: dict[str, None] = {}
        for s in texts:
            parts = []
            if s:
                hidden = [m.start() for m in _INVISIBLE.finditer(s)] if "​" in s or "­" in s else None
                parts = (_INVISIBLE.sub("", s) if hidden else s).split("\n")
                cut.append((parts, hidden))
                for p in parts:
                    if p not in self.lines and p not in new:
                        new[p] = None
                        size += len(p)
                        if size > 4 * BATCH_TOKENS:
                            self._decode(list(new))
                            new, size = {}, 0
            else:
                cut.append(([], None))
        if new:
            self._decode(list(new))
        out = []
        for parts, hidden in cut:
            got, at = [], 0
            for p in parts:
                got += [(k, a + at, z + at) for k, a, z in self.lines[p]]
                at += len(p) + 1
            if hidden:  # back to places in the text with its invisible characters
                real = np.array(hidden) - np.arange(len(hidden))
                got = [(k, a + int(np.searchsorted(real, a, "right")), z + int(np.searchsorted(real, z - 1, "right"))) for k, a, z in got]
            out.append(got)
        return out


def plausible(kind: str, s: str) -> bool:
    """The exact check behind the field: what an occurrence must hold whatever its surroundings."""
    digits = sum(c.isdigit() for c in s)
    if kind == "email":
        return "@" in s or "#64" in s or bool(re.search(r"[\[({]\s*at\s*[\])}]", s, re.I))
    if kind == "phone":
        return 7 <= digits <= 15
    if kind == "id_number":
        return 5 <= digits <= 14
    if kind == "address":
        return digits > 0 and any(c.isalpha() for c in s)
    return digits == 0 and len(re.findall(r"[^\W\d_]{2,}", s)) >= 2


_MODELS: dict[tuple, Model] = {}


def model_for(lexicon: DataFrame) -> Model:
    """The model for a lexicon (name, kind), trained once in a process.

    Its size is that of a dictionary, not of the documents: all names are looked up. Training takes LEXICON_NAMES of them at most, chosen by a hash.
    """
    rows = lexicon.select("name", "kind").filter("name is not null").distinct().collect()
    given, surnames = (sorted(r.name for r in rows if r.kind == k) for k in ("given", "surname"))
    key = (tuple(given), tuple(surnames))
    if key not in _MODELS:
        some = lambda names: names if len(names) <= LEXICON_NAMES else sorted(names, key=lambda n: zlib.crc32(n.encode()))[:LEXICON_NAMES]
        model = train(some(given), some(surnames))
        model.given, model.surnames = frozenset(given), frozenset(surnames)
        _MODELS[key] = model
    return _MODELS[key]


_TAGGERS: dict[str, Tagger] = {}


def _tagger(held) -> Tagger:
    """The tagger of this worker process: what it knows serves all tasks the process runs."""
    model = held.value
    if model.key not in _TAGGERS:
        _TAGGERS.clear()
        _TAGGERS[model.key] = Tagger(model)
    return _TAGGERS[model.key]


_FOUND = schemas.of(doc_id="long", pii_type="string", start_pos="int", end_pos="int")


def find(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, pii_type, start_pos and end_pos of every occurrence in ``text``."""
    ship(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        tagger = _tagger(held)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                ids, got = b.column("doc_id").to_pylist(), tagger.spans(b.column("text").to_pylist())
                rows = [(i, *s) for i, spans in zip(ids, got) for s in spans]
                if rows:
                    d, k, a, z = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(k, pa.string()), pa.array(a, pa.int32()), pa.array(z, pa.int32())], _FOUND.names)

    return documents.select("doc_id", "text").mapInArrow(run, _FOUND)


def redact(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and the text with a typed placeholder for each occurrence; every other character is unchanged."""
    ship(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        tagger = _tagger(held)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                texts, out = b.column("text").to_pylist(), []
                for s, spans in zip(texts, tagger.spans(texts)):
                    parts, end = [], 0
                    for kind, a, z in spans:
                        parts += [s[end:a], PLACEHOLDERS[kind]]
                        end = z
                    out.append(s if s is None else "".join([*parts, s[end:]]))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, text string")
