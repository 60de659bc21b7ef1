"""Every registered query that has SQL, against DuckDB on the smallest tables."""

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402

SQL = entry.oracle_sql()


def canon(df, cols):
    out = df[cols].copy()
    for c in cols:
        if str(out[c].dtype) in ("float64", "float32", "int64", "int32", "Int64", "Int32", "Float64"):
            out[c] = out[c].astype("float64")
    return sorted(tuple("" if v is None or v != v else str(v) for v in row) for row in out.itertuples(index=False))


@pytest.fixture(scope="module")
def con(tmp_path_factory):
    from tests.conftest import DATA

    d = DATA / "sf0.001"
    if not d.exists():
        pytest.skip("no test data here")
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for p in d.glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf, con, name):
    got, want = entry.queries()[name](spark, sf).toPandas(), con.sql(SQL[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert canon(got, cols) == canon(want, cols)


def test_whole_feature_row(spark, sf, con):
    """Its columns that n_hf_features has too, and the flow of trades against a plain loop."""
    f = entry.queries()["n_hf_whole"](spark, sf)
    assert len(f.columns) > 160
    f = f.toPandas()
    few = entry.queries()["n_hf_features"](spark, sf).toPandas().set_index("seq")
    both = [c for c in few.columns if c in f.columns and c not in ("exchange", "symbol")]
    assert len(both) == 13 and set(f.seq) == set(few.index)
    for c in both:
        got = f.set_index("seq")[c].loc[few.index]
        assert (got == few[c]).all() if few[c].dtype == object else (abs(got.astype(float) - few[c].astype(float)) <= 1e-3 * (1 + abs(few[c].astype(float)))).mean() == 1, c
    rows = con.sql("select o_orderstatus e, cast(o_custkey as varchar) s, epoch_ms(o_orderdate) ts, case when l_linestatus = 'O' then 'buy' else 'sell' end side, cast(l_quantity as double) q from lineitem join orders on o_orderkey = l_orderkey").fetchall()
    trades = {}
    for e, s, ts, side, q in rows:
        trades.setdefault((e, s), []).append((ts, side, q))
    for r in f.itertuples():
        for days in (1, 5, 10, 30, 60):
            v = []
            for side in ("buy", "sell"):
                mine = [(t, q) for t, x, q in trades[r.exchange, r.symbol] if x == side and t <= r.ts]
                end = max((t for t, _ in mine), default=0)
                v.append(sum(q for t, q in mine if t > end - days * 86_400_000))
            assert abs(getattr(r, f"trade_vol_{days * 86_400}s") - sum(v)) < 1e-6 and abs(getattr(r, f"tfi_{days * 86_400}s") - (v[0] - v[1]) / sum(v)) < 1e-9


def test_entry_and_names(spark):
    assert set(SQL) <= set(entry.queries())
    assert entry.entry(spark).schema.names == ["exchange", "trade_id", "timestamp"]


def test_nothing_else_imports_the_llm_subpackage():
    from pathlib import Path

    root = Path(entry.__file__).parent / "tideframe"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "tideframe.llm" in p.read_text()]


def test_no_lineage_is_cut_on_one_machine():
    from pathlib import Path

    root = Path(entry.__file__).parent / "tideframe"
    assert not [p for p in root.rglob("*.py") if "localCheckpoint" in p.read_text()]
