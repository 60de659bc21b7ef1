"""The queries of ``workload`` in SQL, as DuckDB runs it."""

from __future__ import annotations

import re

from tideframe.plans.workload import _BOOKS, _QUOTES, _TICKS


def _total(side: str, n: int | None = None) -> str:
    s = f"{side}[1:{n}]" if n else side
    return f"coalesce(list_sum(list_transform({s}, lambda x: x.size)), 0)"


def _notional(side: str, n: int) -> str:
    return f"list_sum(list_transform({side}[1:{n}], lambda x: x.price * x.size))"


def _band(side: str, lo: int, hi: int) -> str:
    sign = "1" if side == "bids" else "-1"
    return f"coalesce(list_sum(list_transform(list_filter({side}, lambda x: {sign} * (mid - x.price) / mid * 10000 >= {lo} and {sign} * (mid - x.price) / mid * 10000 < {hi}), lambda x: x.size)), 0)"


def _imb(a: str, b: str) -> str:
    return f"case when {a} + {b} > 0 then ({a} - {b}) / ({a} + {b}) else 0 end"


def _ratio(a: str, b: str) -> str:
    return f"case when {b} > 0 then ({a}) / ({b}) end"


def _cum(side: str, n: str = "20") -> str:
    return f"list_transform(range(1, least(len({side}), {n}) + 1), lambda i: list_sum(list_transform({side}[1:i], lambda x: x.size)))"


def _half(side: str) -> str:
    return f"cast(len(list_filter({_cum(side)}, lambda c: c < {_total(side, 20)} * 0.5)) as integer)"


def _hhi(side: str) -> str:
    return f"list_sum(list_transform({side}[1:20], lambda x: x.size * x.size)) / ({_total(side, 20)} * {_total(side, 20)})"


def _smart(side: str) -> str:
    sign = "1" if side == "bids" else "-1"
    return f"list_sum(list_transform({side}[1:50], lambda x: x.size * exp(-100 * ({sign} * (mid - x.price) / mid))))"


def _slope(side: str) -> str:
    sign = "1" if side == "bids" else "-1"
    return f"""(select case when count(*) >= 3 and max(p) > min(p) then (count(*) * sum(x * y) - sum(x) * sum(y)) / (count(*) * sum(x * x) - sum(x) * sum(x)) end
 from (select unnest(list_transform(range(1, n10 + 1), lambda i: {sign} * (mid - {side}[i].price) / mid * 10000)) x, unnest(list_transform(range(1, n10 + 1), lambda i: {side}[i].price)) p, unnest({_cum(side, "n10")}) y))"""


def _r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) {name}"


def _roll(agg: str, x: str, h_ms: int, none: str = "0") -> str:
    """agg over (t - h, t] of the rows already seen, by the frame with all peers less the later ones."""
    k = "partition by exchange, symbol"
    return f"(coalesce({agg}({x}) over ({k} order by ts range between {h_ms - 1} preceding and current row), {none}) - coalesce({agg}({x}) over ({k}, ts order by seq rows between 1 following and unbounded following), {none}))"


_PREV = "partition by exchange, symbol order by ts, seq"
_LAGGED = f"(select *, lag(mid) over w pm, lag(bb) over w pb, lag(ba) over w pa, lag(sb) over w psb, lag(sa) over w psa, lag(bids) over w pbids, lag(asks) over w pasks, lag(ts) over w t1, lag(ts, 2) over w t0, lag(mid, 2) over w m0 from {_BOOKS} window w as ({_PREV}))"
_OFI = """case when pm is null then 0.0 else (case when bb > pb then sb when bb < pb then -psb else sb - psb end) - (case when ba > pa then -psa when ba < pa then sa else sa - psa end) end"""


def _multi(weight: str) -> str:
    one = lambda s, up, down: f"coalesce(list_sum(list_transform(range(1, least(len({s}), len(p{s}), 10) + 1), lambda i: {weight} * (case when {s}[i].price > p{s}[i].price then {up} when {s}[i].price < p{s}[i].price then {down} else {s}[i].size - p{s}[i].size end))), 0)"
    return f"case when pm is null then 0.0 else {one('bids', 'bids[i].size', '-pbids[i].size')} - {one('asks', '-pasks[i].size', 'asks[i].size')} end"


def _feature(cols: str, extra: str = "seq") -> str:
    return f"select {extra}, {cols} from (select *, least(len(bids), len(asks), 10) n10, least(len(bids), len(asks), 20) n20 from {_BOOKS})"


_UNITS = f"(select *, cast(round(amount / 1e-8) as bigint) u from {_TICKS} where round(amount / 1e-8) > 0)"


def _fills(size: int, cols: str = "*") -> str:
    return f"""(select {cols}, least(cum, (bucket + 1) * {size}) - greatest(cum - u, bucket * {size}) fill from
 (select *, unnest(range((cum - u) // {size}, (cum - 1) // {size} + 1)) bucket from (select *, cast(sum(u) over ({_PREV}) as bigint) cum from {_UNITS})))"""


#: Digits and names of the computed numbers, which come in single precision as in ``workload``.
ROUNDED = {
    "g_quotes": (6, "best_bid best_ask mid_price spread relative_spread imbalance_L1 microprice"),
    "g_levels": (6, "bid_price_L0 bid_size_L0 bid_price_L1 bid_size_L1 ask_price_L3 ask_size_L3 ask_price_L12 ask_size_L12"),
    "g_bands": (6, "bid_vol_band_0_5bps ask_vol_band_0_5bps imb_band_0_5bps bid_vol_band_25_50bps ask_vol_band_25_50bps imb_band_25_50bps lambda_like amihud_like book_convexity"),
    "g_depth": (6, "bid_concentration ask_concentration book_pressure total_bid_volume total_ask_volume bid_depth_decay_5 avg_depth_decay_5"),
    "g_vwap": (6, "vwap_bid_5 vwap_ask_5 vwap_spread smart_bid_depth smart_ask_depth smart_depth_imbalance center_of_gravity cog_vs_mid"),
    "g_slopes": (4, "bid_slope_simple ask_slope_simple bid_slope_regression ask_slope_regression slope_asymmetry"),
    "g_best_quotes": (6, "best_bid best_bid_amount best_ask best_ask_amount spread mid_price"),
    "g_research": (6, "spread_bps bid_volume_10 volume_imbalance_5 weighted_oi_5 notional_pressure_10 bid_level_spacing_mean ask_depth_10bps bid_slope volume_ratio_3 effective_spread kyle_lambda_bid amihud_illiquidity bid_concentration"),
    "h_flow_l1": (8, "log_return_step ofi_step micro_minus_mid"),
    "h_flow_levels": (6, "ofi_multi mlofi_decay"),
    "i_running": (9, "amount_mean amount_var"),
    "i_rolling_sum": (6, "w_sum w_mean"),
    "i_rolling_std": (6, "w_mean w_var w_std"),
    "i_percentile": (6, "w_rank w_p20 w_p80"),
    "i_regimes": (6, "side_buy_frac side_sell_frac"),
    "i_kyle": (6, "kyle_lambda kyle_lambda_r2"),
    "j_time_bars": (6, "sum_ofi realized_variance sum_mlofi_decay close_step_mlofi"),
    "j_feature_bars": (6, "open high low close mean_spread mean_l1_imbalance sum_ofi max_spread"),
    "j_feature_bars_all": (6, "open high low close mean_spread mean_l1_imbalance sum_ofi max_spread"),
    "j_volume_bars": (5, "volume buy_volume vwap buy_ratio"),
    "j_vpin": (5, "buy_volume sell_volume vpin"),
    "j_window_vwap": (5, "vwap volume"),
    "n_book_states": (6, "mid_price spread spread_bps"),
    "n_hf_features": (1, "mid_price ofi_step ofi_sum_5184000s mlofi_sum_5184000s depth_0_5bps_sigma spread_percentile spread_regime_tight_frac cog_momentum_mean_5184000s cog_momentum_std_5184000s"),
    "o_upsert": (6, "bid ask"),
    "o_upsert_all": (6, "bid ask"),
}


def _single(sql: str, digits: int, cols: list[str]) -> str:
    """The query with its numbers unrounded inside, and in single precision outside."""
    inner = re.sub(r"\bround\((?!amount / 1e-8)", "if(true, ", sql)
    return f"select * replace ({', '.join(f'cast(round({c}, {digits + 3}) + 0.0 as float) as {c}' for c in cols)}) from ({inner})"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # Sample queries.
    q["s01_day_stats"] = f"select count(*) n, min(bid) low, max(bid) high, round(avg(bid), 6) mean from {_QUOTES} where exchange = 'kelvane' and symbol = 'QVNT/USDX' and date = '2025-03-03'"
    q["s02_top_products"] = f"select exchange, symbol, count(*) n from {_TICKS} where hour(make_timestamp(ts * 1000)) in (22, 23, 0) group by 1, 2 order by n desc, 1, 2 limit 10"
    q["s03_hourly_average"] = f"select symbol, ts // 3600000 as hour, round(avg(price), 6) mean_price from {_TICKS} where symbol in ('KASP/USDX', 'QVNT/USDX', 'FENO/USDX') group by 1, 2"
    q["s04_projection"] = """select "timestamp", bid, ask from ticker where date = '2025-03-04' and exchange = 'kelvane'"""
    q["s05_hourly_stats"] = f"""select exchange, symbol, "timestamp" // 3600000 as hour, count(*) n, round(avg(last), 6) mean, min(last) low, max(last) high from {_QUOTES} group by 1, 2, 3"""
    q["s06_partition_agg"] = f"select count(*) n, round(avg(bid), 6) mean_bid, min(last) low, max(last) high from {_QUOTES} where exchange = 'kelvane' and date = '2025-03-04'"
    q["s07_hour_range"] = f"""select exchange, symbol, cast(hour(make_timestamp("timestamp" * 1000)) as integer) as hour, count(*) n, round(avg(ask), 6) mean_ask from {_QUOTES} where hour(make_timestamp("timestamp" * 1000)) between 22 and 23 and symbol in ('KASP/USDX', 'QVNT/USDX') group by 1, 2, 3"""
    part = lambda n: f"nullif(regexp_extract(path, '(?:^|/){n}=([^/]+)', 1), '') {n}"
    q["s08_partitions"] = f"select {part('exchange')}, {part('symbol')}, {part('date')}, count(*) files, cast(sum(n_bytes) as bigint) bytes from (select distinct file_no, path, n_bytes from ticker_files) group by 1, 2, 3"
    q["s09_mid_spread"] = f"select exchange, symbol, date, round(avg((bid + ask) / 2), 6) mid, round(avg(ask - bid), 6) spread, round(avg((ask - bid) / bid * 100), 6) spread_pct from {_QUOTES} where bid > 0 and ask > 0 group by 1, 2, 3"
    q["s10_bars"] = "select duration, exchange, symbol, count(*) n, cast(sum(trade_count) as bigint) trades, max(high) high, min(low) low from bars group by 1, 2, 3"
    q["s11_symbols"] = f"select distinct symbol from {_TICKS} where symbol like '%/USDX' and symbol not like 'SKEL%'"
    q["s12_round_trip"] = f"select exchange, seq, price from {_TICKS} where price > 1000"
    # Joins, sets, sorts, filters.
    q["k_left_join"] = "select n.file_no, listed, held from (select file_no, count(*) held from ticker group by 1) n left join (select file_no, max(n_rows) listed from ticker_files group by 1) f on f.file_no = n.file_no"
    q["k_anti_join"] = f"select distinct exchange, symbol from {_TICKS} t where not exists (select 1 from orderbook o where lower(trim(o.exchange)) = t.exchange and replace(o.symbol, '-', '/') = t.symbol)"
    q["k_asof"] = f"""select t.seq, q.quote_no from {_TICKS} t asof left join (select exchange, symbol, "timestamp" ts, max(rec_no) quote_no from {_QUOTES} group by 1, 2, 3) q on t.exchange = q.exchange and t.symbol = q.symbol and t.ts >= q.ts"""
    q["k_interval"] = f"""select t.seq, b.bar_start from {_TICKS} t join (select distinct lower(trim(exchange)) exchange, symbol, cast("timestamp" * 1000 as bigint) bar_start from bars where duration = 300) b on t.exchange = b.exchange and t.symbol = b.symbol and t.ts >= b.bar_start and t.ts < b.bar_start + 300000"""
    q["k_intervals"] = f"""select t.seq, cast(b.duration as integer) duration, b.bar_start from {_TICKS} t join (select distinct lower(trim(exchange)) exchange, symbol, duration, cast("timestamp" * 1000 as bigint) bar_start from bars) b on t.exchange = b.exchange and t.symbol = b.symbol and t.ts >= b.bar_start and t.ts < b.bar_start + b.duration * 1000"""
    q["l_union"] = f"""select exchange, symbol, count(*) n, count(rec_no) quotes, max(price) high from (select exchange, symbol, price, null rec_no from {_TICKS} union all select exchange, symbol, last, rec_no from {_QUOTES} where last is not null) group by 1, 2"""
    q["l_distinct_on"] = """select trade_id, "timestamp", rec_no, price from trades qualify row_number() over (partition by trade_id, "timestamp" order by collected_at, rec_no) = 1"""
    q["m_book_order"] = "select *, cast(row_number() over (partition by exchange, symbol order by sequence_num) as integer) place from (select distinct lower(trim(exchange)) exchange, symbol, sequence_num from orderbook)"
    q["m_tiers"] = f"select *, case when place <= 4 then 1 when place <= 12 then 2 when place <= 20 then 3 else 4 end tier from (select *, cast(row_number() over (order by traded desc, exchange, symbol) as integer) place from (select exchange, symbol, round(sum(price * amount), 2) traded from {_TICKS} group by 1, 2))"
    q["c_predicates"] = f"select rec_no, case when upper(trim(side)) in ('BUY', 'B') then 'buy' else 'sell' end side from trades where side is not null and price between 1 and 5000 and taker_or_maker in ('taker', 'maker')"
    q["f_partition_values"] = "select replace(symbol, '/', '-') symbol, lower(trim(exchange)) exchange, count(*) n from ticker group by 1, 2"
    q["f_path_values"] = f"select file_no, {part('exchange')}, {part('symbol')}, {part('date')}, regexp_matches(path, 'part_\\d{{8}}T\\d{{2}}_[a-f0-9]{{8}}(_\\d+)?\\.parquet$') named_well from (select distinct file_no, path from ticker_files)"
    t = 'make_timestamp("timestamp" * 1000)'
    part = lambda f, n: f"cast({f}({t}) as integer) as {n}"
    q["e_time_fields"] = f"""select rec_no, file_no, {part('year', 'year')}, {part('month', 'month')}, {part('day', 'day')}, {part('hour', 'hour')}, {part('minute', 'minute')}, {part('second', 'second')}, cast(microsecond({t}) % 1000000 as integer) as microsecond,
 strftime({t}, '%Y-%m-%d') date, cast(isodow({t}) - 1 as integer) day_of_week, isodow({t}) >= 6 is_weekend from ticker"""
    q["e_iso_times"] = "select distinct exchange, sequence_num, event_time, epoch_ms(cast(event_time as timestamptz)) event_ms from orderbook where event_time is not null"
    # Parsing.
    q["d_ticker"] = """select rec_no, exchange, symbol, strftime(make_timestamp("timestamp" * 1000), '%Y-%m-%d') date, "timestamp", bid, ask, coalesce("bidVolume", bid_volume) "bidVolume", base_volume "baseVolume",
 round(ask - bid, 8) spread, round(case when bid > 0 then (ask - bid) / bid * 100 end, 4) spread_pct from ticker"""
    q["d_trades"] = """select rec_no, exchange, symbol, strftime(make_timestamp(coalesce("timestamp", collected_at) * 1000), '%Y-%m-%d') date, trade_id, coalesce("timestamp", collected_at) "timestamp", side, price, amount, cost, taker_or_maker "takerOrMaker" from trades"""
    q["d_stats"] = "select 'ticker' as type, count(*) n from ticker union all select 'trades', count(*) from trades union all select 'rejected', count(*) from trades where rec_no % 100 = 0"
    q["d_orderbook"] = f"select seq, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') date, cast(least(len(bids), 5) as integer) levels, bb best_bid, sa ask_size from {_BOOKS}"
    q["d_events"] = """select symbol, case when side = 'offer' then 'ask' else side end side_normalized, lower(event_type) = 'snapshot' is_snapshot, count(*) n, max(price_level) high, round(sum(coalesce(new_quantity, 0)), 4) quantity from orderbook where sequence_num is not null and price_level is not null group by 1, 2, 3"""
    # Book features.
    q["g_quotes"] = _feature(", ".join([_r("bb", "best_bid"), _r("ba", "best_ask"), _r("mid", "mid_price"), _r("ba - bb", "spread"), _r("(ba - bb) / mid", "relative_spread"), _r(_imb("sb", "sa"), "imbalance_L1"), _r("(bb * sa + ba * sb) / (sa + sb)", "microprice")]))
    lvl = lambda s, i, f: f"{'round(' + s + f'[{i + 1}].price, 6)' if f == 'price' else 'round(coalesce(' + s + f'[{i + 1}].size, 0), 6)'} {s[:-1]}_{f}_L{i}"
    q["g_levels"] = _feature(", ".join(lvl(s, i, f) for s, i in (("bids", 0), ("bids", 1), ("asks", 3), ("asks", 12)) for f in ("price", "size")))
    b05, a05, b2550, a2550 = (_band(s, lo, hi) for lo, hi in ((0, 5), (25, 50)) for s in ("bids", "asks"))
    near, wider, far = f"({b05} + {a05})", f"({_band('bids', 0, 10)} + {_band('asks', 0, 10)})", f"({_band('bids', 0, 50)} + {_band('asks', 0, 50)})"
    q["g_bands"] = _feature(", ".join([
        _r(b05, "bid_vol_band_0_5bps"), _r(a05, "ask_vol_band_0_5bps"), _r(_imb(b05, a05), "imb_band_0_5bps"), _r(b2550, "bid_vol_band_25_50bps"), _r(a2550, "ask_vol_band_25_50bps"), _r(_imb(b2550, a2550), "imb_band_25_50bps"),
        _r(_ratio("ba - bb", near), "lambda_like"), _r(_ratio("ba - bb", wider), "amihud_like"), _r(_ratio(near, far), "book_convexity"),
    ]))
    tb, ta = _total("bids", 20), _total("asks", 20)
    deep = lambda s: f"case when len(bids) >= 5 and len(asks) >= 5 then {_ratio(f'{s}[5].size', f'{s}[1].size')} end"
    q["g_depth"] = _feature(", ".join([
        f"{_half('bids')} bid_50pct_depth_levels", f"{_half('asks')} ask_50pct_depth_levels", _r(_hhi("bids"), "bid_concentration"), _r(_hhi("asks"), "ask_concentration"), _r(_imb(tb, ta), "book_pressure"),
        _r(tb, "total_bid_volume"), _r(ta, "total_ask_volume"), _r(deep("bids"), "bid_depth_decay_5"), _r(f"({deep('bids')} + {deep('asks')}) / 2", "avg_depth_decay_5"),
    ]))
    vb, va = (f"{_notional(s, 5)} / {_total(s, 5)}" for s in ("bids", "asks"))
    cog = "(list_sum(list_transform(bids[1:n20], lambda x: x.price * x.size)) + list_sum(list_transform(asks[1:n20], lambda x: x.price * x.size))) / (list_sum(list_transform(bids[1:n20], lambda x: x.size)) + list_sum(list_transform(asks[1:n20], lambda x: x.size)))"
    q["g_vwap"] = _feature(", ".join([
        _r(vb, "vwap_bid_5"), _r(va, "vwap_ask_5"), _r(f"{va} - {vb}", "vwap_spread"), _r(_smart("bids"), "smart_bid_depth"), _r(_smart("asks"), "smart_ask_depth"), _r(_imb(_smart("bids"), _smart("asks")), "smart_depth_imbalance"),
        _r(cog, "center_of_gravity"), _r(f"({cog} - mid) / mid * 10000", "cog_vs_mid"),
    ]))
    simple = lambda s: f"case when len({s}) >= 5 then abs({s}[5].price - {s}[1].price) / {_total(s, 5)} end"
    q["g_slopes"] = f"select seq, round(bs, 4) bid_slope_simple, round(as_, 4) ask_slope_simple, round(br, 4) bid_slope_regression, round(ar, 4) ask_slope_regression, round(case when ar > 0 then br / ar end, 4) slope_asymmetry from ({_feature(f'{simple("bids")} bs, {simple("asks")} as_, {_slope("bids")} br, {_slope("asks")} ar')})"
    q["g_best_quotes"] = f"select seq, round(bb, 6) best_bid, round(sb, 6) best_bid_amount, round(ba, 6) best_ask, round(sa, 6) best_ask_amount, round(ba - bb, 6) spread, round(mid, 6) mid_price from {_BOOKS}"
    nb, na = "list_sum(list_transform(bids[1:{0}], lambda x: x.price * x.size))", "list_sum(list_transform(asks[1:{0}], lambda x: x.price * x.size))"
    cut = lambda s, k: f"list_sum(list_transform({s}[1:least(len(bids), len(asks), {k})], lambda x: x.size))"
    micro = "(bb * sa + ba * sb) / (sa + sb)"
    q["g_research"] = _feature(", ".join([
        f"cast(len(list_filter({_cum('bids', '1000')}, lambda c: c < {_total('bids')} * 0.5)) as integer) bid_50pct_depth", _r("(ba - bb) / mid * 10000", "spread_bps"), _r(cut("bids", 10), "bid_volume_10"), _r(_imb(cut("bids", 5), cut("asks", 5)), "volume_imbalance_5"),
        _r(_imb(nb.format(5), na.format(5)), "weighted_oi_5"), _r(_imb(nb.format(10), na.format(10)), "notional_pressure_10"), _r("case when len(bids) >= 2 then (bids[least(len(bids), 10)].price - bb) / (least(len(bids), 10) - 1) else 0 end", "bid_level_spacing_mean"),
        _r("list_sum(list_transform(list_filter(asks, lambda x: x.price <= ba * 1.001), lambda x: x.size))", "ask_depth_10bps"), _r(f"case when len(bids) >= 5 then (bids[5].price - bb) / {_total('bids', 5)} else 0 end", "bid_slope"), _r(f"{_total('bids', 3)} / {_total('asks', 3)}", "volume_ratio_3"),
        _r(f"2 * abs({micro} - mid)", "effective_spread"), _r(f"(ba - bb) / (2 * {cut('bids', 5)})", "kyle_lambda_bid"), _r(f"(ba - bb) / ({cut('bids', 10)} + {cut('asks', 10)})", "amihud_illiquidity"),
        _r(f"list_sum(list_transform(bids[1:10], lambda x: x.size * x.size)) / ({_total('bids')} * {_total('bids')})", "bid_concentration"),
    ]))
    # Flow.
    q["h_flow_l1"] = f"select seq, round(case when pm is null then 0.0 else ln(mid / pm) end, 8) log_return_step, round({_OFI}, 8) ofi_step, round((bb * sa + ba * sb) / (sa + sb) - mid, 8) micro_minus_mid from {_LAGGED}"
    q["h_flow_levels"] = f"select seq, round({_multi('1')}, 6) ofi_multi, round({_multi('exp(-0.5 * (i - 1))')}, 6) mlofi_decay from {_LAGGED}"
    v1, v0 = "case when ts > t1 then (mid - pm) / ((ts - t1) / 1000) end", "case when t1 > t0 then (pm - m0) / ((t1 - t0) / 1000) end"
    q["h_velocity"] = f"select seq, round(coalesce(v1, 0) * 1e9, 4) + 0.0 mid_velocity_e9, round(coalesce((v1 - v0) / (((ts - t1) / 1000 + (t1 - t0) / 1000) / 2), 0) * 1e15, 2) + 0.0 mid_accel_e15 from (select *, {v1} v1, {v0} v0 from {_LAGGED})"
    # Windows.
    seen = f"({_PREV} rows between unbounded preceding and current row)"
    q["i_running"] = f"select seq, count(amount) over {seen} amount_n, round(avg(amount) over {seen}, 5) amount_mean, round(coalesce(var_samp(amount) over {seen}, 0), 5) amount_var from {_TICKS}"
    q["i_rolling_sum"] = f"select seq, n w_n, round(s, 6) w_sum, round(case when n > 0 then s / n else 0 end, 6) w_mean from (select seq, {_roll('count', 'amount', 60000)} n, {_roll('sum', 'amount', 60000)} s from {_TICKS})"
    var = "case when n > 1 then greatest((ss - s * s / n) / (n - 1), 0) else 0 end"
    q["i_rolling_std"] = f"select seq, round(case when n > 0 then c + s / n else 0 end, 4) w_mean, round({var}, 4) w_var, round(sqrt({var}), 4) w_std from (select seq, c, {_roll('count', 'amount', 60000)} n, {_roll('sum', '(amount - c)', 60000)} s, {_roll('sum', '((amount - c) * (amount - c))', 60000)} ss from (select *, first_value(amount) over ({_PREV}) c from {_TICKS}))"
    q["i_percentile"] = f"""select seq, round(case when len(vs) > 0 then len(list_filter(vs, lambda v: v < amount)) / len(vs) else 0.5 end, 6) w_rank, round(list_sort(vs)[cast(floor(0.2 * (len(vs) - 1)) as int) + 1], 6) w_p20, round(list_sort(vs)[cast(floor(0.8 * (len(vs) - 1)) as int) + 1], 6) w_p80
 from (select seq, amount, list_transform(list_filter(l, lambda e: e.t < ts or e.s <= seq), lambda e: e.v) vs from (select *, list({{'s': seq, 't': ts, 'v': amount}}) over (partition by exchange, symbol order by ts range between 59999 preceding and current row) l from {_TICKS}))"""
    fr = "(partition by exchange, symbol order by ts range between 299999 preceding and current row)"
    frac = lambda k: f"round(case when sum(dt) over {fr} > 0 then coalesce(sum(case when pr = '{k}' then dt end) over {fr}, 0) / sum(dt) over {fr} else 0 end, 6) side_{k}_frac"
    q["i_regimes"] = f"select seq, {frac('buy')}, {frac('sell')} from (select *, cast(ts - lag(ts) over ({_PREV}) as double) dt, lag(side) over ({_PREV}) pr from {_TICKS} where side is not null)"
    kn, ka, kb, kaa, kbb, kab = (_roll("count" if x == "p" and n == "n" else "sum", x, 300000) for n, x in (("n", "p"), ("a", "p"), ("b", "f"), ("aa", "(p * p)"), ("bb", "(f * f)"), ("ab", "(p * f)")))
    q["i_kyle"] = f"""select seq, round(case when n >= 2 and vb >= 1e-10 then cov / vb else 0 end, 6) kyle_lambda, round(case when n >= 2 and vb >= 1e-10 and va >= 1e-10 then cov * cov / (va * vb) else 0 end, 6) kyle_lambda_r2 from
 (select seq, n, ab / n - a / n * b / n cov, aa / n - a / n * a / n va, bb / n - b / n * b / n vb from (select seq, {kn} n, {ka} a, {kb} b, {kaa} aa, {kbb} bb, {kab} ab from (select *, ln(amount) p, case when side = 'buy' then amount else -amount end f from {_TICKS} where side is not null)))"""
    sided = lambda k: f"(select exchange, symbol, ts, arg_max(v, seq) v from (select exchange, symbol, ts, seq, {_roll('sum', 'amount', 60000)} v from {_TICKS} where side = '{k}') group by 1, 2, 3)"
    q["i_trade_flow"] = f"""select q.seq, round(case when coalesce(b.v, 0) + coalesce(s.v, 0) > 0 then (coalesce(b.v, 0) - coalesce(s.v, 0)) / (coalesce(b.v, 0) + coalesce(s.v, 0)) else 0 end, 6) tfi, round(coalesce(b.v, 0) + coalesce(s.v, 0), 6) volume
 from (select exchange, symbol, "timestamp" ts, min(rec_no) seq from {_QUOTES} group by 1, 2, 3) q asof left join {sided('buy')} b on q.exchange = b.exchange and q.symbol = b.symbol and q.ts >= b.ts asof left join {sided('sell')} s on q.exchange = s.exchange and q.symbol = s.symbol and q.ts >= s.ts"""
    # Bars.
    q["j_time_bars"] = f"""select * exclude (nxt, f) from (select *, lead(f) over w close_step_mlofi, lead(bar_start) over w nxt from (select exchange, symbol, cast(d as integer) duration, ts - ts % (d * 1000) bar_start, arg_min(price, (ts, seq)) as open, max(price) high, min(price) low, arg_max(price, (ts, seq)) as close,
 count(*) count, strftime(make_timestamp((ts - ts % (d * 1000)) * 1000), '%Y-%m-%d') date, round(sum(case when side = 'buy' then amount else -amount end), 6) sum_ofi, round(coalesce(var_samp(ln(amount)), 0), 6) realized_variance, round(sum(amount), 6) sum_mlofi_decay, round(arg_min(amount, (ts, seq)), 6) f
 from {_TICKS}, (values (60), (300), (900), (3600)) v(d) group by exchange, symbol, d, bar_start) window w as (partition by exchange, symbol, duration order by bar_start)) where nxt is not null"""
    month = 86_400 * 30
    q["j_feature_bars"] = f"""select * exclude (nxt) from (select *, lead(bar_start) over (partition by exchange, symbol order by bar_start) nxt from (select exchange, symbol, cast({month} as integer) duration, ts - ts % {month * 1000} bar_start, count(*) count, round(arg_min(mid, (ts, seq)), 6) as open, round(max(mid), 6) high, round(min(mid), 6) low, round(arg_max(mid, (ts, seq)), 6) as close,
 round(sum(ba - bb) / count(*), 6) mean_spread, round(sum({_imb('sb', 'sa')}) / count(*), 6) "mean_l1_imbalance", round(sum({_OFI}), 6) sum_ofi, round(max(ba - bb), 6) max_spread from {_LAGGED} group by 1, 2, 3, 4)) where nxt is not null"""
    q["j_feature_bars_all"] = f"""select * exclude (nxt) from (select *, lead(bar_start) over (partition by exchange, symbol, duration order by bar_start) nxt from (select exchange, symbol, cast(d as integer) duration, ts - ts % (d * 1000) bar_start, count(*) count, round(arg_min(mid, (ts, seq)), 6) as open, round(max(mid), 6) high, round(min(mid), 6) low, round(arg_max(mid, (ts, seq)), 6) as close,
 round(sum(ba - bb) / count(*), 6) mean_spread, round(sum({_imb('sb', 'sa')}) / count(*), 6) "mean_l1_imbalance", round(sum(ofi), 6) sum_ofi, round(max(ba - bb), 6) max_spread from (select *, {_OFI} ofi from {_LAGGED}), (values (60::bigint), (300), (900), (3600), ({month})) v(d) group by 1, 2, 3, 4)) where nxt is not null"""
    size = round(50 / 1e-8)
    q["j_volume_bars"] = f"""select exchange, symbol, bucket, coalesce(lag(c) over w, o) as open, c as close, n trade_count, coalesce(lag(et) over w, st) start_time, et end_time, round(v * 1e-8, 5) volume, round(b * 1e-8, 5) buy_volume, round(pv / v, 5) vwap, round(b * 1e-8 / (v * 1e-8), 5) buy_ratio from
 (select exchange, symbol, bucket, arg_min(price, (ts, seq)) o, arg_max(price, (ts, seq)) c, min(ts) st, max(ts) et, count(*) n, cast(sum(fill) as bigint) v, cast(coalesce(sum(fill) filter (side = 'buy'), 0) as bigint) b, sum(price * fill) pv from {_fills(size)} group by 1, 2, 3) window w as (partition by exchange, symbol order by bucket) qualify v >= {size}"""
    size = round(20 / 1e-8)
    buy = f"case when side = 'buy' then 1.0 when side = 'sell' then 0.0 when price > lag(price) over ({_PREV}) then 1.0 when price < lag(price) over ({_PREV}) then 0.0 else 0.5 end"
    fills = _fills(size).replace(f"from {_UNITS}", f"from (select x.*, {buy} bought from (select *, cast(round(amount / 1e-8) as bigint) u from {_TICKS}) x) where u > 0")
    q["j_vpin"] = f"""select exchange, symbol, bucket, round(b * 1e-8, 5) buy_volume, round((v - b) * 1e-8, 5) sell_volume, round(sum(abs(2 * b - v)) over w / (count(*) over w * {size}), 5) vpin from
 (select exchange, symbol, bucket, sum(fill) v, sum(fill * bought) b from {fills} group by 1, 2, 3 having sum(fill) >= {size}) window w as (partition by exchange, symbol order by bucket rows between 49 preceding and current row)"""
    q["j_window_vwap"] = f"""select exchange, symbol, ts - ts % 300000 window_start, arg_min(price, (ts, seq)) as open, max(price) high, min(price) low, arg_max(price, (ts, seq)) as close, count(price) trades, round(sum(price * amount) / sum(amount), 5) vwap, round(sum(amount), 5) volume from {_TICKS} group by 1, 2, 3"""
    q["j_duplicates"] = f"select exchange, symbol, ts, price, count(*) n from {_TICKS} group by 1, 2, 3, 4 having count(*) > 1"
    q["j_estimate"] = f"select count(*) partitions, cast(sum(n) as bigint) total_rows, round(avg(n), 4) avg_rows, max(n) max_rows, round(avg(n) * 1024 / 1048576, 6) avg_mb from (select exchange, symbol, date, count(*) n from {_QUOTES} group by 1, 2, 3)"
    q["j_backlog"] = "select count(*) files, cast(sum(n_bytes) as bigint) bytes, round((1741100000000 - min(epoch_ms(written_at))) / 1000, 3) oldest_s, case when count(*) > 50 or (1741100000000 - min(epoch_ms(written_at))) / 1000 > 600 then 'critical' when count(*) > 20 then 'warning' else 'ok' end status from ticker_files"
    q["j_collisions"] = "select regexp_extract(path, '([^/]+)$', 1) as name, count(*) n from (select distinct path from ticker_files) group by 1 having count(*) > 1"
    # Stateful.
    q["n_downsample"] = f"""with recursive t as (select * from {_TICKS}), r as (select exchange, symbol, min(ts) ts from t where ts >= 30000 group by 1, 2
 union all select * from (select r.exchange, r.symbol, (select min(t.ts) from t where t.exchange = r.exchange and t.symbol = r.symbol and t.ts >= r.ts + 30000) ts from r) where ts is not null)
 select exchange, symbol, ts, min(t.seq) seq from r join t using (exchange, symbol, ts) group by 1, 2, 3"""
    q["n_book_states"] = """with o as (select lower(trim(exchange)) exchange, symbol, case when lower(side) = 'bid' then 'bid' else 'ask' end side, price_level p, sequence_num s, max(new_quantity) q, bool_or(lower(event_type) = 'delete' or coalesce(new_quantity = 0, false)) gone from orderbook group by 1, 2, 3, 4, 5),
 iv as (select *, lead(s) over (partition by exchange, symbol, side, p order by s) e from o), t as (select distinct exchange, symbol, s from o),
 j as (select t.exchange, t.symbol, t.s, max(case when iv.side = 'bid' then p end) bb, arg_max(case when iv.side = 'bid' then q end, case when iv.side = 'bid' then p end) bq, min(case when iv.side = 'ask' then p end) ba, arg_min(case when iv.side = 'ask' then q end, case when iv.side = 'ask' then p end) aq
  from t left join iv on t.exchange = iv.exchange and t.symbol = iv.symbol and not iv.gone and iv.s <= t.s and (iv.e is null or t.s < iv.e) group by 1, 2, 3)
 select exchange, symbol, s sequence_num, case when ok then bb end best_bid, case when ok then bq end best_bid_size, case when ok then ba end best_ask, case when ok then aq end best_ask_size, round(case when ok then (bb + ba) / 2 end, 6) mid_price, round(case when ok then ba - bb end, 6) spread,
 round(case when ok then (ba - bb) / ((bb + ba) / 2) * 10000 end, 6) spread_bps from (select *, bb is not null and ba is not null ok from j)"""
    # Changes to datasets, and their layout.
    base = f"(select distinct exchange, symbol, date, rec_no, bid, ask, base_volume from {_QUOTES} where bid is not null)"
    q["o_delete"] = f"select exchange, date, rec_no, bid, base_volume from {base} where not (base_volume < 5000)"
    q["o_update"] = f"select exchange, date, rec_no, case when date = '2025-03-04' and bid > ask then ask else bid end bid, ask, case when date = '2025-03-04' and bid > ask then 0 else base_volume end base_volume from {base}"
    q["o_upsert"] = f"""with b as (select * from {base}), n as (select exchange, date, symbol, case when rec_no % 3 = 0 then -rec_no else rec_no end rec_no, bid + 1 bid, case when rec_no % 2 = 0 then ask + 1 end ask from b where rec_no % 5 = 0)
 select coalesce(b.exchange, n.exchange) exchange, coalesce(b.date, n.date) date, coalesce(b.symbol, n.symbol) symbol, coalesce(b.rec_no, n.rec_no) rec_no, round(coalesce(n.bid, b.bid), 6) bid, round(coalesce(n.ask, b.ask), 6) ask from b full join n on b.exchange = n.exchange and b.date = n.date and b.rec_no = n.rec_no"""
    q["o_upsert_all"] = f"""with b as (select * from {base}), n as (select exchange, date, symbol, case when base_volume < 5000 then -rec_no else rec_no end rec_no, bid + 1 bid, case when bid < 1000 then ask + 1 end ask from b)
 select coalesce(b.exchange, n.exchange) exchange, coalesce(b.date, n.date) date, coalesce(b.symbol, n.symbol) symbol, coalesce(b.rec_no, n.rec_no) rec_no, round(coalesce(n.bid, b.bid), 6) bid, round(coalesce(n.ask, b.ask), 6) ask from b full join n on b.exchange = n.exchange and b.date = n.date and b.rec_no = n.rec_no"""
    q["o_deduplicate"] = f"select exchange, rec_no, file_no, bid from {_QUOTES} qualify row_number() over (partition by rec_no order by file_no) = 1"
    q["p_repartition"] = f"select replace(symbol, '/', '-') symbol, cast(hour(make_timestamp(ts * 1000)) as integer) as hour, count(*) n, max(price) high from {_TICKS} group by 1, 2"
    q["p_compact"] = f"select exchange, rec_no, file_no, bid from {_QUOTES}"
    q["p_repair"] = f"select replace(symbol, '/', '-') symbol, count(*) n from {_QUOTES} group by 1"
    q["q_sync"] = f"select exchange, rec_no, file_no, bid from {_QUOTES}"
    # The feature row, from the parts above.
    w = 86_400_000 * 60
    mean_std = f"(select *, {_roll('count', 'cvm', w)} cn, {_roll('sum', 'cvm', w)} cs, {_roll('sum', '(cvm * cvm)', w)} css from x)"
    q["n_hf_features"] = f"""with recursive f as (select *, {_OFI} ofi, {_multi('exp(-0.5 * (i - 1))')} ml, (ba - bb) / mid rel, {b05} + {a05} depth, ({cog} - mid) / mid * 10000 cvm from (select *, least(len(bids), len(asks), 20) n20 from {_LAGGED})),
 x as (select *, list({{'s': seq, 't': ts, 'v': rel}}) over (partition by exchange, symbol order by ts range between {w - 1} preceding and current row) l, cast(ts - lag(ts) over ({_PREV}) as double) dt from f),
 y as (select *, {_roll('sum', 'ofi', w)} ofs, {_roll('sum', 'ml', w)} mls, {_roll('count', 'depth', w)} dn, {_roll('sum', 'depth', w)} ds, {_roll('sum', '(depth * depth)', w)} dss, len(list_filter(l, lambda e: (e.t < ts or e.s <= seq) and e.v < rel)) / len(list_filter(l, lambda e: e.t < ts or e.s <= seq)) pc from {mean_std}),
 z as (select *, case when pc <= 0.2 then 'tight' when pc >= 0.8 then 'wide' else 'normal' end rg from y), u as (select *, lag(rg) over ({_PREV}) pr from z),
 v as (select *, sum(dt) over fr whole, sum(case when pr = 'tight' then dt end) over fr part from u window fr as (partition by exchange, symbol order by ts range between {w - 1} preceding and current row)),
 r as (select exchange, symbol, min(ts) ts from f group by 1, 2 union all select * from (select r.exchange, r.symbol, (select min(f.ts) from f where f.exchange = r.exchange and f.symbol = r.symbol and f.ts >= r.ts + 86400000) ts from r) where ts is not null),
 keep as (select exchange, symbol, ts, min(f.seq) seq from r join f using (exchange, symbol, ts) group by 1, 2, 3)
 select v.exchange, v.symbol, v.seq, rg spread_regime, cast(hour(make_timestamp(v.ts * 1000)) as integer) hour_of_day, cast(isodow(make_timestamp(v.ts * 1000)) - 1 as integer) day_of_week, cast(isodow(make_timestamp(v.ts * 1000)) >= 6 as integer) is_weekend, round(mid, 4) mid_price, round(ofi, 4) ofi_step, round(ofs, 4) ofi_sum_5184000s, round(mls, 4) mlofi_sum_5184000s,
 round(sqrt(case when dn > 1 then greatest((dss - ds * ds / dn) / (dn - 1), 0) else 0 end), 4) depth_0_5bps_sigma, round(pc, 4) spread_percentile, round(case when whole > 0 then coalesce(part, 0) / whole else 0 end, 4) spread_regime_tight_frac,
 round(cs / cn, 4) cog_momentum_mean_5184000s, round(sqrt(case when cn > 1 then greatest((css - cs * cs / cn) / (cn - 1), 0) else 0 end), 4) cog_momentum_std_5184000s from v join keep using (exchange, symbol, ts, seq)"""
    for name, (digits, cols) in ROUNDED.items():
        q[name] = _single(q[name], digits, cols.split())
    return q
