"""The core's data-processing problems against brute force, with hot groups, ties, nulls, empty tables and odd columns."""

import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideframe.functions import fs
from tideframe.operators import changefeed, drift, latebars, redelivery, smallfiles, spikes
from tideframe.plans import problems
from tideframe.session import scratch, shared_dir

TRADE_COLS = "exchange string, symbol string, trade_id string, timestamp long, collected_at long, price double, amount double, rec_no long, n long, file string, key string, w int"


def some_trades(n=600, seed=1):
    """A third of the rows are deliveries of one trade; n, file, key and w are columns of no meaning."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        hot = r.random() < 0.33
        ts = 1_000_000 if hot else r.choice([None, r.randint(0, 4_000_000)])
        tid = "hot" if hot else r.choice([None, str(r.randint(0, 40))])
        out.append((r.choice(["ax", "AX ", "by"]) if not hot else r.choice(["ax", " Ax"]), r.choice(["A/B", "C/D"]) if not hot else "A/B", tid, ts, r.choice([0, 1000, 60_000, 3_000_000, 3_600_000]) + (ts or 0),
                    None if r.random() < 0.1 else float(r.randint(1, 9)), float(r.randint(1, 5)), i, r.randint(0, 3), "x", None, r.randint(0, 9)))
    return out


def norm(e):
    return e.strip().lower()


def write(spark, rows, schema, files=3):
    at = scratch(spark, "in")
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(at)
    return at


def key():
    return {"exchange": F.lower(F.trim("exchange")), "trade_id": F.col("trade_id"), "timestamp": F.col("timestamp")}


def order():
    return [F.col("collected_at"), F.col("rec_no")]



@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_copies_leave_by_deletion_vectors(spark, limit):
    rows = some_trades()
    at = write(spark, rows, TRADE_COLS)
    got = redelivery.drop_copies(spark, at, key(), order(), limit=limit)
    assert got.columns == spark.read.parquet(at).columns
    first = {}
    keep = []
    for x in rows:
        k = (norm(x[0]), x[2], x[3])
        if None in k:
            keep.append(x)
        elif k not in first or (x[4], x[7]) < (first[k][4], first[k][7]):
            first[k] = x
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in spark.createDataFrame(keep + list(first.values()), TRADE_COLS).collect())
    dv = redelivery.find_copies(spark, at, key(), order(), limit)
    gone = redelivery.apply_vectors(spark, at, dv, ["rec_no"], deleted=True, limit=limit)
    assert gone.count() + got.count() == len(rows)


def test_copies_in_an_empty_table(spark):
    at = scratch(spark, "in")
    spark.createDataFrame([], TRADE_COLS).write.parquet(at)
    assert redelivery.drop_copies(spark, at, key(), order()).count() == 0


def some_changes(n=500, seed=2):
    r = random.Random(seed)
    out = []
    for i in range(n):
        hot = r.random() < 0.33
        out.append((None if r.random() < 0.03 else "ax", "A", "bid" if hot else r.choice(["bid", "ask", None]), 100 if hot else r.choice([None, r.randint(0, 15)]), r.choice([None, 0.0, 1.5, 2.5]), None if r.random() < 0.05 else r.randint(0, 60), r.random() < 0.3, i % 3, "clash", i))
    return out


CHANGE_COLS = "exchange string, symbol string, side string, level long, q double, seq long, gone boolean, period int, v string, _o int"


def standing(rows):
    best = {}
    for x in rows:
        k = x[:4]
        if None in k or x[5] is None:
            continue
        removed = x[6] or x[4] == 0.0
        v = (x[5], removed, x[4] is not None, x[4] or 0.0)
        best[k] = max(best.get(k, v), v)
    return {k: v[0] for k, v in best.items() if not v[1]}


def test_change_table_merges_runs_and_compacts(spark):
    rows = some_changes()
    t = changefeed.ChangeTable(spark, scratch(spark, "lsm"), ["exchange", "symbol", "side", "level"], ["q"], buckets=3, batch_rows=7)
    for part in (rows[250:], rows[:150], rows[150:250], rows[100:200]):  # out of order, and some again
        d = spark.createDataFrame(part, CHANGE_COLS)
        t.append(d, F.col("seq"), F.col("gone") | (F.col("q") == 0), F.col("period"))
    want = standing(rows)
    of = lambda r: (r.exchange, r.symbol, r.side, r.level)
    got = [(of(r), r._seq) for r in t.read().collect()]
    assert len(got) == len(want) and dict(got) == want
    assert t.runs == 12
    t.compact()
    assert t.runs == 1 and {of(r): r._seq for r in t.read().collect()} == want
    again = changefeed.ChangeTable(spark, t.root, t.key, t.payload)
    again.append(spark.createDataFrame(rows[:50], CHANGE_COLS), F.col("seq"), F.col("gone") | (F.col("q") == 0))
    assert {of(r): r._seq for r in again.read().collect()} == want  # repeated after the compaction, removals included


def test_a_change_repeated_after_its_removal_stays_without_effect(spark):
    row = lambda q, seq, gone: spark.createDataFrame([(1, q, seq, gone)], "k long, q double, seq long, gone boolean")
    args = F.col("seq"), F.col("gone")
    for horizon, back in ((None, False), (10_000, False), (10, True)):
        t = changefeed.ChangeTable(spark, scratch(spark, "lsm"), ["k"], ["q"], buckets=2, redelivery_horizon_ms=horizon)
        t.append(row(1.0, 1, False), *args, now_ms=1000)
        t.append(row(None, 2, True), *args, now_ms=1000)
        t.compact(now_ms=2000)
        assert t.read().count() == 0
        t.append(row(1.0, 1, False), *args, now_ms=3000)
        assert (t.read().count() == 1) == back  # beyond the stated horizon the removal is forgotten


def test_runs_stay_few_and_buckets_grow(spark, monkeypatch):
    monkeypatch.setattr(changefeed, "RUNS_PER_TIER", 3)
    monkeypatch.setattr(changefeed, "BASE_BYTES", 4000)
    t = changefeed.ChangeTable(spark, scratch(spark, "lsm"), ["exchange", "symbol", "side", "level"], ["q"], buckets=2, batch_rows=7)
    rows, most = some_changes(400, 9), 0
    for i in range(20):
        t.append(spark.createDataFrame(rows[20 * i : 20 * i + 20], CHANGE_COLS), F.col("seq"), F.col("gone") | (F.col("q") == 0))
        most = max(most, t.runs)
    assert most <= 6
    want = standing(rows)
    of = lambda r: (r.exchange, r.symbol, r.side, r.level)
    assert {of(r): r._seq for r in t.read().collect()} == want
    monkeypatch.setattr(changefeed, "BUCKET_BYTES", 1000)
    t.append(spark.createDataFrame(rows[:20], CHANGE_COLS), F.col("seq"), F.col("gone") | (F.col("q") == 0))
    assert t.state["buckets"] > 2 and {of(r): r._seq for r in t.read().collect()} == want


def test_of_equal_sequences_the_greater_payload_stands_whatever_the_run(spark):
    for order in ([1.0, 2.0], [2.0, 1.0]):
        t = changefeed.ChangeTable(spark, scratch(spark, "lsm"), ["k"], ["q"], buckets=1)
        for q in order:
            t.append(spark.createDataFrame([(1, q, 5)], "k long, q double, seq long"), F.col("seq"), F.lit(False))
        assert [r.q for r in t.read().collect()] == [2.0]


def test_change_table_without_changes(spark):
    t = changefeed.ChangeTable(spark, scratch(spark, "lsm"), ["exchange", "level"], ["q"])
    t.append(spark.createDataFrame([], CHANGE_COLS), F.col("seq"), F.col("gone"))
    assert t.read().count() == 0
    t.compact()
    assert t.read().count() == 0


def bars_of(rows):
    arrival, trade = {}, {}
    for x in rows:
        if x[3] is None:
            continue
        k = (norm(x[0]), x[2], x[3]) if x[2] is not None else ("own", x[7])
        if k not in arrival or (x[4], x[7]) < (arrival[k], trade[k][7]):
            arrival[k], trade[k] = x[4], x
    out = defaultdict(Counter)
    dropped = 0
    for k, x in trade.items():
        for d in latebars.DURATIONS:
            start = x[3] - x[3] % (d * 1000)
            late = arrival[k] - start - d * 1000
            if late > 900_000:
                dropped += 1
            else:
                c = out[norm(x[0]), x[1], d, start]
                c["late"] += late > 5000
                c["n"] += x[5] is not None
                c["v"] += x[6] if x[5] is not None else 0
    return {k: (v["n"], v["late"], v["v"]) for k, v in out.items()}, dropped


@pytest.mark.parametrize("slices", [1, 4])
def test_late_trades_correct_bars(spark, slices):
    rows = some_trades(400)
    d = spark.createDataFrame(rows, TRADE_COLS)
    b = latebars.EventTimeBars(spark).run(d, slices)
    want, dropped = bars_of(rows)
    got = {(r.exchange, r.symbol, r.duration, r.bar_start): (r.trade_count, r.n_late, r.volume or 0) for r in b.current().collect()}
    assert got == want
    assert b.dropped().count() == dropped
    if slices > 1:
        assert b.current().filter("corrections > 0").count() > 0


def test_a_batch_done_again_changes_nothing(spark):
    d = spark.createDataFrame(some_trades(200), TRADE_COLS)
    b = latebars.EventTimeBars(spark)
    b.process(d, 0)
    before = sorted(map(str, b.current().collect()))
    b.process(d, 0)
    assert sorted(map(str, b.current().collect())) == before


TRADE = "exchange string, symbol string, trade_id string, timestamp long, collected_at long, price double, amount double, rec_no long"
DAY = 86_400_000


def test_bars_outlive_their_process(spark):
    rows = sorted(some_trades(300, 8), key=lambda x: x[4])
    root = scratch(spark, "bars")
    for i in range(3):  # a new process for each batch; the second one breaks off and is done again
        b = latebars.EventTimeBars(spark, root)
        part = spark.createDataFrame(rows[100 * i : 100 * i + 100], TRADE_COLS)
        if i == 1:
            with pytest.raises(ZeroDivisionError):
                latebars.EventTimeBars(spark, root, upsert=lambda d, n: 1 / 0).process(part, i)
            assert not latebars.EventTimeBars(spark, root).taken(i)
        b.process(part, i)
        b.process(part, i)
    want, dropped = bars_of(rows)
    again = latebars.EventTimeBars(spark, root)
    assert {(r.exchange, r.symbol, r.duration, r.bar_start): (r.trade_count, r.n_late, r.volume or 0) for r in again.current().collect()} == want
    assert again.dropped().count() == dropped
    with pytest.raises(ValueError):
        latebars.EventTimeBars(spark, root, durations=(60,))


@pytest.mark.parametrize("slices", [1, 3, 30])
def test_a_redelivery_days_later_is_neither_counted_nor_dropped(spark, slices):
    r = random.Random(slices)
    rows = []
    for day in (0, 1, 2):
        for i in range(60):
            ts = day * DAY + r.randint(0, 7_200_000)
            rows.append(["ax", "A/B", f"{day}-{i}", ts, ts + r.choice([0, 70_000, 1_500_000]), 1.0, 1.0])
    rows += [[*x[:4], x[4] + r.choice([6 * 3_600_000, DAY, 2 * DAY]), *x[5:]] for x in r.sample(rows, 60)]
    rows = [(*x, i) for i, x in enumerate(rows)]
    b = latebars.EventTimeBars(spark).run(spark.createDataFrame(rows, TRADE), slices)
    want, dropped = bars_of(rows)
    got = {(x.exchange, x.symbol, x.duration, x.bar_start): (x.trade_count, x.n_late, x.volume) for x in b.current().collect()}
    assert got == want and b.dropped().count() == dropped and len(b.state["taken"]) == 1


def test_cost_and_state_of_a_batch_do_not_grow(spark, monkeypatch):
    """Batches of ten minutes: open bars, pieces of a slot and folders stay few; upserts give each bar's last state."""
    monkeypatch.setattr(latebars, "PIECES", 3)
    last = {}
    keep = lambda d, n: last.update({(x.symbol, x.duration, x.bar_start): x.trade_count for x in d.collect()})
    b = latebars.EventTimeBars(spark, durations=(60, 300), forget_after_ms=3_600_000, upsert=keep)
    opened = []
    for i in range(14):
        rows = [("ax", "A/B", f"{i}-{k}", 600_000 * i + 60_000 * k, 600_000 * i + 60_000 * k + 500, 1.0, 1.0, k) for k in range(10)]
        b.process(spark.createDataFrame(rows, TRADE), i)
        opened.append(b._open().count())
    assert max(opened[4:]) == opened[4] and all(len(p) <= 4 for what in ("seen", "bars") for p in b.state[what].values())
    assert len(b.state["seen"]) <= 3 and b.state["taken"] == [[0, 13]]
    assert last == {(x.symbol, x.duration, x.bar_start): x.trade_count for x in b.current().collect()}
    assert len(fs.subdirs(spark, f"{b.root}/bars/batch=0")) == 0


def test_bars_of_nothing(spark):
    d = spark.createDataFrame([], TRADE_COLS)
    assert latebars.EventTimeBars(spark).run(d, 2).current().count() == 0


def med(x):
    s = sorted(x)
    return (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2


def flags_of(ticker, trades):
    """The definition, record by record."""
    series, recs, out = defaultdict(list), {}, set()
    for rec, e, s, ts, bid, ask, *_ in ticker:
        if (bid is not None and bid <= 0) or (ask is not None and ask <= 0) or (bid is not None and ask is not None and bid > ask):
            out.add(("ticker", rec))
        recs[rec] = (norm(e), s.replace("-", "/"), ts, bid, ask)
    for rec, (e, s, ts, bid, ask) in recs.items():
        if ts is not None:
            series[e, s].append((ts, rec, bid, ask))
    group = defaultdict(list)
    for rec, e, s, tid, ts, coll, price, *_ in trades:
        group[(norm(e), tid, ts) if tid is not None and ts is not None else ("own", rec)].append((coll, rec, norm(e), s, ts, price))
    tr = defaultdict(list)
    for g in group.values():
        coll, rec, e, s, ts, price = min(g)
        if price is not None and price <= 0:
            out |= {("trades", x[1]) for x in g}
        if ts is not None and price is not None:
            tr[e, s].append((ts, min(x[1] for x in g), price, g))

    def spikes_in(rows):
        rows = sorted(rows)
        v = [x[2] for x in rows]
        d = [abs(a - b) for a, b in zip(v[1:], v) if a != b]
        for i, x in enumerate(rows):
            b, a = v[max(0, i - 5) : i], v[i + 1 : i + 6]
            if d and a and b:
                p, q = v[i] - med(b), v[i] - med(a)
                if p * q > 0 and min(abs(p), abs(q)) > 10 * med(d):
                    yield x

    for rows in series.values():
        for f in (2, 3):
            out |= {("ticker", x[1]) for x in spikes_in([(r[0], r[1], r[f]) for r in rows if r[f] is not None])}
        both = sorted(r for r in rows if r[2] is not None and r[3] is not None)
        i = 0
        while i < len(both):
            j = i
            while j < len(both) and both[j][2:] == both[i][2:]:
                j += 1
            if j - i >= 12:
                out |= {("ticker", r[1]) for r in both[i + 1 : j]}
            i = j
    for rows in tr.values():
        for x in spikes_in([(a, b, p) for a, b, p, _ in rows]):
            g = next(g for a, b, p, g in rows if b == x[1])
            out |= {("trades", y[1]) for y in g}
    return out


TICKER = "rec_no long, exchange string, symbol string, timestamp long, bid double, ask double, tbl string, id int, ts int"
TRADES = "rec_no long, exchange string, symbol string, trade_id string, timestamp long, collected_at long, price double, field int, dev double"


def readings(seed, n):
    r = random.Random(seed)
    ticker, trades, p = [], [], 100.0
    for i in range(n):
        p = p + r.choice([0, 0, 0.01, -0.01, 0.02]) if not n // 3 < i < n // 2 else p  # a long stuck stretch
        x = p + 5 if r.random() < 0.03 else -1.0 if r.random() < 0.02 else p
        e, s = ("Ax ", "A-B") if i % 5 else (r.choice(["by", "cz"]), "C/D")
        ticker.append((i, e, s, 1000 * i if r.random() > 0.03 else None, None if r.random() < 0.05 else x, None if r.random() < 0.05 else x + 0.01, "t", i, None))
        trades.append((i, e, "A/B", r.choice([None, str(i)]), r.choice([None, 1000 * i, 1000 * i, 1000 * i]), i, None if r.random() < 0.05 else x, 1, None))
    ticker += r.sample(ticker, n // 10)
    trades += [(n + k, *x[1:5], x[5] + 1, *x[6:]) for k, x in enumerate(r.sample(trades, n // 5))]
    return ticker, trades


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 7), (3, 40)])
def test_flags_over_cut_sources(spark, seed, parts):
    """With forty partitions a source and its stuck run lie in many of them."""
    ticker, trades = readings(seed, 260)
    got = spikes.flags(spark.createDataFrame(ticker, TICKER), spark.createDataFrame(trades, TRADES), parts)
    found = [(r.source_table, r.rec_no) for r in got.select("source_table", "rec_no").distinct().collect()]
    assert len(found) == len(set(found)) and set(found) == flags_of(ticker, trades)
    assert {r.reason for r in got.select("reason").distinct().collect()} == {"impossible", "spike", "stuck"}


def test_flags_of_nothing(spark):
    assert spikes.flags(spark.createDataFrame([], TICKER), spark.createDataFrame([], TRADES), 3).count() == 0


@pytest.mark.parametrize("bracket", [200_000, 10])
def test_medians_are_exact_whatever_the_sketch(spark, bracket):
    r = np.random.default_rng(5)
    pdf = pd.concat([pd.DataFrame({"k": k, "x": np.round(r.exponential(size=n), d), "h": r.integers(0, 4, n)}) for k, n, d in (("a", 9001, 8), ("b", 5000, 1), ("c", 1, 3), ("d", 2, 3))])
    m = spikes.exact_medians(spark.createDataFrame(pdf), ["k"], "x", "h", bracket)
    assert {x.k: x["median"] for x in m.collect()} == pdf.groupby("k").x.median().to_dict()


RAW = "exchange string, file_seq long, line_no int, raw string, name string, value int"


def raw_lines():
    f = lambda e, s, i, **v: (e, s, i, json.dumps(v), "clash", None)
    return [
        f("ax", 1, 1, bid=1.5, bidVolume=2.5, note="n", info_json={"b": 1.5, "B": 2.5}),
        f("AX ", 1, 1, bid=1.5, bidVolume=2.5, note="n", info_json={"b": 1.5, "B": 2.5}),
        ("ax", 1, 2, '{"bid": 1.', "clash", None),
        f("ax", 2, 1, bid="1.25", bid_volume=3.5, extra=True, info_json='{"b": 1.25, "B": 3.5}'),
        f("ax", 3, 1, bid=1.25, bid_volume="4.5", extra=None, info_json={"b": 1.25, "B": 4.5}),
        ("ax", 4, 1, "[1]", "clash", None),
        f("by", 9, 1, x=1),
    ]


def test_changes_between_files(spark):
    got = {tuple(r) for r in drift.changes(spark.createDataFrame(raw_lines(), RAW)).select("exchange", "file_seq", "change", "old_field", "new_field").collect()}
    assert got == {
        ("ax", 2, "renamed", "bidVolume", "bid_volume"), ("ax", 2, "retyped", "bid", "bid"), ("ax", 2, "retyped", "info_json", "info_json"), ("ax", 2, "removed", "note", ""), ("ax", 2, "added", "", "extra"),
        ("ax", 3, "retyped", "bid", "bid"), ("ax", 3, "retyped", "bid_volume", "bid_volume"), ("ax", 3, "retyped", "info_json", "info_json"), ("ax", 3, "removed", "extra", ""),
        ("ax", 4, "removed", "bid", ""), ("ax", 4, "removed", "bid_volume", ""), ("ax", 4, "removed", "info_json", ""),
    }


def test_equal_values_in_a_quiet_file_make_no_rename(spark):
    """bid goes, last comes, and in the one line between them both equal the same two payload keys; the other files tell them apart."""
    f = lambda s, i, info, **v: ("ax", s, i, json.dumps(v | {"info_json": info}), "clash", None)
    rows = [f(1, i, {"b": i + 1.0, "l": i + 9.5}, bid=i + 1.0) for i in range(3)] + [f(2, 0, {"b": 7.0, "l": 7.0}, bid=7.0), f(3, 0, {"b": 7.0, "l": 7.0}, last=7.0)]
    rows += [f(4, i, {"b": i + 1.0, "l": i + 9.5}, last=i + 9.5) for i in range(3)]
    d = spark.createDataFrame(rows, RAW)
    got = {tuple(r) for r in drift.changes(d).select("file_seq", "change", "old_field", "new_field").collect()}
    assert got == {(3, "removed", "bid", ""), (3, "added", "", "last")}
    assert drift.undecided(d).count() == 0
    two = spark.createDataFrame([r for r in rows if r[1] in (2, 3)], RAW)
    assert {(r.file_seq, r.name, tuple(r["keys"])) for r in drift.undecided(two).collect()} == {(2, "bid", ("b", "l")), (3, "last", ("b", "l"))}


def test_the_file_before_is_found_across_stretches(spark):
    rows = [("a", s) for s in (1, 5, 7, 12, 30, 31, 500)] + [("b", 3), ("b", None), (None, 1), (None, 9)]
    got = {(r.e, r.s): r.prev for r in drift.before(spark.createDataFrame(rows, "e string, s long"), "e", "s", 4).filter("e is not null").collect()}
    assert got == {("a", 1): None, ("a", 5): 1, ("a", 7): 5, ("a", 12): 7, ("a", 30): 12, ("a", 31): 30, ("a", 500): 31, ("b", 3): None}


def test_rescue_and_replay(spark):
    target = {"bid": "double", "bid_volume": "double"}
    t = drift.ingest(spark.createDataFrame(raw_lines(), RAW), target, {}, ["exchange", "file_seq", "line_no"])
    assert t.count() == 7
    row = t.filter("file_seq = 1 and line_no = 1").first()
    assert row.bid == 1.5 and row.bid_volume is None and json.loads(row._rescued)["bidVolume"] == "2.5"
    assert json.loads(t.filter("line_no = 2").first()._rescued)["_line"] == '{"bid": 1.'
    again = drift.replay(t, target, {"bidVolume": "bid_volume"})
    row = again.filter("file_seq = 1 and line_no = 1").first()
    assert row.bid_volume == 2.5 and "bidVolume" not in json.loads(row._rescued) and json.loads(row._rescued)["note"] == "n"
    assert drift.replay(drift.ingest(spark.createDataFrame([], RAW), target, {}, ["exchange"]), target, {"bidVolume": "bid_volume"}).count() == 0
    assert drift.changes(spark.createDataFrame([], RAW)).count() == 0


PAYLOAD_KEYS = {"bid": "b", "ask": "a", "bid_volume": "B", "ask_volume": "A", "last": "l", "open": "o", "high": "h", "low": "x", "vwap": "w", "base_volume": "v", "quote_volume": "q"}


def holds_what_the_payload_says(spark, d):
    """The columns of p5_table against the payload: a line's value under any name that repeats a column's payload key. Returns the values compared."""
    lines, n = Counter(), 0
    for r in spark.read.parquet(f"{d}/ticker_raw.parquet").collect():
        try:
            v = json.loads(r.raw)
            info = v["info_json"] if isinstance(v["info_json"], dict) else json.loads(v["info_json"])
        except (ValueError, KeyError, TypeError):
            continue
        number = lambda x: float(x) if isinstance(x, (int, float, str)) and not isinstance(x, bool) and re.fullmatch(r"-?[\d.]+(e-?\d+)?", str(x)) else None
        held = {number(x) for k, x in v.items() if k != "info_json"} - {None}
        lines[r.exchange.strip().lower(), r.file_seq, r.line_no, tuple(number(info[k]) if k in info and number(info[k]) in held else None for k in PAYLOAD_KEYS.values())] += 1
        n += 1
    table = Counter((r.exchange, r.file_seq, r.line_no, tuple(r[c] for c in PAYLOAD_KEYS)) for r in problems.p5_table(spark, d).collect())
    assert n and not lines - table
    return sum(x is not None for k in lines for x in k[3])


def test_ticker_table_holds_every_value_by_payload_key(spark, tmp_path):
    from tests.conftest import DATA

    if not (DATA / "sf0.01").exists():
        pytest.skip("no test data here")
    assert holds_what_the_payload_says(spark, str(DATA / "sf0.01")) > 1000
    names = {"best_bid_size": "B", "best_ask_size": "A", "lastPrice": "l", "avgPrice": "w", "volume24h": "v", "turnover": "q", "open_24h": "o", "somethingNew": "x"}
    own = {"bidVolume": "B", "askVolume": "A", "last": "l", "vwap": "w", "baseVolume": "v", "quoteVolume": "q", "open": "o", "low": "x"}
    rows = []
    for seq, fields in ((1, own), (2, names)):
        for i in range(3):
            info = {k: 10.0 * seq + i + j / 16 for j, k in enumerate("BAlwvqox")}
            rows.append(("Ax ", seq, i, json.dumps({f: str(info[k]) if i == 1 else info[k] for f, k in fields.items()} | {"halted": True, "info_json": info})))
    spark.createDataFrame(rows, "exchange string, file_seq long, line_no int, raw string").write.parquet(f"{tmp_path}/ticker_raw.parquet")
    assert holds_what_the_payload_says(spark, str(tmp_path)) == 6 * 8
    assert {r._rescued for r in problems.p5_table(spark, str(tmp_path)).collect()} == {'{"halted":"true"}'}


def test_superseded_files(spark):
    r = random.Random(4)
    rows = []
    for f in range(80):
        g = f"g{f % 3}"
        own = r.sample(range(30), r.randint(1, 4)) + ([7] if f % 3 == 0 else [])  # one record in a third of the files
        rows += [(g, f, x) for x in own] + ([(g, f, own[0])] if f % 5 == 0 else [])
    rows += [("g0", 200, x) for x in range(12)] + [("g1", 201, 5), ("g1", 202, 5), (None, None, 1), ("g0", None, 3), ("g0", 9, None)]
    held = defaultdict(set)
    of = {}
    for g, f, x in rows:
        if f is not None and x is not None:
            held[f].add(x)
            of[f] = g
    want = {a for a in held if any(of[a] == of[b] and a != b and held[a] <= held[b] and (len(held[b]) > len(held[a]) or b < a) for b in held)}
    got = [x.file_no for x in smallfiles.superseded(spark.createDataFrame(rows, "g string, file_no long, rec_no long")).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert smallfiles.superseded(spark.createDataFrame([], "g string, file_no long, rec_no long")).count() == 0


def test_hilbert_curve_visits_every_point_by_single_steps():
    g = np.array(np.meshgrid(*[range(16)] * 3, indexing="ij")).reshape(3, -1)
    c = smallfiles.hilbert_codes(list(g), 4)
    assert sorted(c) == list(range(4096))
    assert np.abs(np.diff(g[:, np.argsort(c)], axis=1)).sum(axis=0).max() == 1


def test_compaction_keeps_every_record_once(spark):
    rows = [(i, i % 50, "ax" if i % 3 else "by", "A/B", 1_000_000 + (i % 7) * 10**6 if i % 11 else None, float(i), "x") for i in range(3000)]
    rows += [(i, 90 + i % 3, *r[2:]) for i, r in enumerate(rows[:400])] + [(None, 1, "ax", "A/B", 5, 1.0, None)] * 3
    at = write(spark, rows, "rec_no long, file_no long, exchange string, symbol string, timestamp long, bid double, code string", 20)
    c = smallfiles.compact(spark, at, rows_per_file=500)
    back = spark.read.parquet(c.path)
    assert c.source == c.written and back.count() == 3003 and back.filter("rec_no is not null").select("rec_no").distinct().count() == 3000
    assert 6 <= c.files <= 8
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 1000
    empty = scratch(spark, "in")
    spark.createDataFrame([], "rec_no long, file_no long, exchange string, symbol string, timestamp long").write.parquet(empty)
    assert smallfiles.compact(spark, empty).written[0] == 0


def test_compacted_files_have_the_target_size(spark, monkeypatch):
    from tests.conftest import DATA

    if not (DATA / "sf0.1").exists():
        pytest.skip("no test data here")
    done, compact = [], smallfiles.compact
    monkeypatch.setattr(smallfiles, "compact", lambda *a, **k: done.append(compact(*a, **k)) or done[-1])
    n = problems.p6_compacted(spark, str(DATA / "sf0.1")).count()
    assert n > 50_000 and done[0].files == 1 and len(fs.files(spark, done[0].path)) == 1
    path = f"{DATA}/sf0.1/ticker.parquet"
    size = sum(f.size for f in fs.files(spark, path)) / 1e6
    c = compact(spark, path, target_mb=size / 4)
    assert c.files == -(-4 * c.written[0] // spark.read.parquet(path).count()) > 1


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    at = scratch(spark, "x")
    fs.write_text(spark, at + "/a.txt", "hello")
    assert fs.read_text(spark, at + "/a.txt") == "hello" and fs.delete(spark, at) and not fs.exists(spark, at)
