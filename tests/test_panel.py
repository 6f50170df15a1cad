import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwise.functions import dates as fd
from panelwise.functions.pvalues import incomplete_beta, p_value_chi2, p_value_f, p_value_norm, p_value_t, upper_gamma
from panelwise.operators import mapping as mp
from panelwise.operators import panel as op
from panelwise.operators import portfolio as pf
from panelwise.operators import reference as ref
from panelwise.operators import regression as rg
from panelwise.plans import panel_queries, registry
from panelwise.sources import panels as src
from panelwise.streaming import ingest

D = dt.date.fromisoformat


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(D(v) if isinstance(v, str) and len(v) == 10 and v[4] == "-" else v for v in r) for r in rows], schema)


def test_periodic_rates(spark):
    r = spark.range(1).select(fd.periodic(F.lit(12.0), 12), fd.periodic(F.lit(12.0), 52), fd.periodic(F.lit(12.0), 252), fd.periodic(F.lit(5.0), 12)).first()
    assert [round(x, 7) for x in r] == [0.01, 0.0023077, 0.0004762, 0.0041667]


def test_aligned_start_and_tolerance(spark):
    df = spark.createDataFrame([("monthly",), ("daily",), ("weekly",), ("other",)], "f string")
    r = {x.f: (x.a, x.t) for x in df.select(
        "f", fd.aligned_start(F.lit("2014-01-01").cast("date"), F.col("f")).alias("a"), fd.tolerance(F.col("f")).alias("t")
    ).collect()}
    assert r == {"monthly": (D("2014-01-31"), 3), "daily": (D("2014-01-01"), 2), "weekly": (D("2014-01-03"), 6), "other": (D("2014-01-01"), 2)}


def test_interval_overlap(spark):
    spans = frame(spark, [(1, "2007-03-01", "2017-08-17"), (1, "2022-06-23", "2025-07-09")], "ticker int, start_date date, end_date date")
    got = sorted((r.start_date, r.end_date) for r in ref.overlaps(spans, "2014-01-01", "2024-12-31").collect())
    assert got == [(D("2014-01-01"), D("2017-08-17")), (D("2022-06-23"), D("2024-12-31"))]


def test_successor_chains(spark):
    rows = [("FB", "META"), ("CBS", "VIAC"), ("VIAC", "PARA"), ("LIFE", None), ("HFC", "DINO")]
    mapping = ref.overridden(spark.createDataFrame(rows, "old string, new string"), spark.createDataFrame([("HFC", None)], "old string, new string"))
    closed = ref.closed_successors(mapping)
    assert {r.old: r.chain for r in closed.collect()}["CBS"] == ["CBS", "VIAC", "PARA"]
    names = spark.createDataFrame([(x,) for x in ("FB", "CBS", "LIFE", "AAPL", "HFC")], "k string")
    assert {r.k: (r.resolved, r.delisted) for r in ref.resolved(names, closed, "k").collect()} == {
        "FB": ("META", False), "CBS": ("PARA", False), "LIFE": (None, True), "AAPL": ("AAPL", False), "HFC": (None, True)
    }
    with pytest.raises(Exception, match="cycle"):
        ref.closed_successors(spark.createDataFrame([("a", "b"), ("b", "a")], "old string, new string")).collect()


def test_clean_tickers_and_divisions(spark):
    df = spark.createDataFrame([("AAPL.1",), ("MSFT.",), ("brk.b",)], "t string")
    assert [r[0] for r in df.select(fd.clean_ticker(F.col("t"))).collect()] == ["AAPL", "MSFT", "BRK.B"]
    codes = spark.createDataFrame([(999,), (1000,), (1800,), (5200,), (9000,), (None,)], "c int")
    assert [r[0] for r in codes.select(fd.sic_division(F.col("c"))).collect()] == [
        "Agriculture", "Mining", "Manufacturing", "Retail Trade", "Public Administration", None
    ]


def test_gap_check(spark):
    required = frame(
        spark, [(1, "2023-10-02", "2024-12-31"), (2, "2020-01-01", "2020-04-03"), (3, "2020-01-01", "2020-02-01")],
        "ticker int, start_date date, end_date date"
    )
    panel = frame(spark, [(1, "2023-10-04"), (1, "2024-12-31"), (2, "2020-04-01"), (2, "2020-04-03")], "ticker int, date date")
    got = {r.ticker: (r.status, r.missing_start_days if r.actual_start else None) for r in ref.gap_check(required, panel, "daily").collect()}
    assert got == {1: ("complete", 2), 2: ("partial", 91), 3: ("missing", None)}


def test_intervals_round_trip(spark):
    rows = [(1, "2020-01-31"), (1, "2020-02-29"), (1, "2020-04-30"), (2, "2020-02-29"), (2, "2020-03-31"), (2, "2020-04-30")]
    daily = frame(spark, rows, "ticker int, date date")
    spans = ref.intervals(daily)
    assert sorted(tuple(r) for r in spans.collect()) == [
        (1, D("2020-01-31"), D("2020-02-29")), (1, D("2020-04-30"), D("2020-04-30")), (2, D("2020-02-29"), D("2020-04-30"))
    ]
    assert sorted(tuple(r) for r in ref.expanded(spans, daily.select("date").distinct()).collect()) == sorted((a, D(b)) for a, b in rows)


def test_premium_and_caps(spark):
    f = spark.createDataFrame([("mkt", D("2020-01-31"), 0.1396)], "signal string, date date, factor double")
    assert pf.premia(f, {"mkt": 0.06}, 0.5).first().premium == pytest.approx(0.0998)
    b = spark.createDataFrame([(3.2,), (-7.69,)], "x double")
    assert [r.x_capped for r in pf.capped(b, "x", 3.0).collect()] == [3.0, -3.0] and [r.x_capped for r in pf.capped(b, "x", 5.0).collect()] == [3.2, -5.0]


def test_ranks_and_buckets_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"date": np.repeat([1, 2, 3], 40), "x": np.round(rng.normal(size=120), 1)}).reset_index(names="ticker")
    df = spark.createDataFrame(pdf)
    got = op.percentile_rank(df, "x").toPandas().sort_values("ticker")
    assert np.allclose(got["pct"], pdf.groupby("date")["x"].rank(pct=True))
    pdf["y"] = rng.normal(size=120)
    got = op.quantile_bucket(spark.createDataFrame(pdf), "y").toPandas().sort_values("ticker")
    want = pdf.groupby("date")["y"].transform(lambda s: pd.qcut(s, 10, labels=False) + 1)
    assert (got["bucket"].to_numpy() == want.to_numpy()).all()


def test_ewma_matches_pandas(spark):
    x = np.random.default_rng(2).normal(size=50)
    df = spark.createDataFrame([(1, D("2000-01-01") + dt.timedelta(days=31 * i), float(v)) for i, v in enumerate(x)], "ticker int, date date, ret double")
    assert pf.ewma(df, 36).first().ewma == pytest.approx(pd.Series(x).ewm(span=71).mean().iloc[-1] * 12)


def test_hac_against_plain_sums(spark):
    rng = np.random.default_rng(3)
    x, e = rng.normal(size=(80, 2)), rng.normal(size=80)
    y = 0.5 + x @ [1.0, -2.0] + e
    beta, error, rest = rg.hac_ols(y, x, 4)
    design = np.column_stack([np.ones(80), x])
    assert np.allclose(beta, np.linalg.lstsq(design, y, rcond=None)[0])
    s = sum((1 - abs(a - b) / 5) * rest[a] * rest[b] * np.outer(design[a], design[b]) for a in range(80) for b in range(80) if abs(a - b) <= 4)
    inv = np.linalg.inv(design.T @ design)
    assert np.allclose(error, np.sqrt(np.diag(inv @ s @ inv)))


def test_p_values(spark):
    df = spark.createDataFrame([(2.0, 10.0), (0.0, 5.0), (None, 5.0)], "t double, d double")
    got = [r[0] for r in df.select(p_value_t("t", "d")).collect()]
    assert got[0] == pytest.approx(0.0733880, abs=1e-6) and got[1] == pytest.approx(1.0) and got[2] is None
    assert df.select(p_value_norm("t")).first()[0] == pytest.approx(math.erfc(2 / math.sqrt(2)))
    assert incomplete_beta(np.array([2.0]), np.array([3.0]), np.array([0.4]))[0] == pytest.approx(0.5248)


def test_asof_ties_and_unmatched(spark):
    left = frame(spark, [(1, "2020-01-01"), (1, "2020-02-01"), (1, "2020-03-01")], "ticker int, date date")
    right = frame(spark, [(1, "2020-02-01", 5.0)], "ticker int, date date, v double")
    assert sorted((r.date.month, r.v) for r in op.backward_asof(left, right, "v").collect()) == [(2, 5.0), (3, 5.0)]
    assert op.backward_asof(left, right, "v", True).count() == 3


def test_explode_members(spark):
    raw = spark.createDataFrame([("2020-01-02", "aapl, MSFT,brk.b, 'aapl'"), ("bad", "x")], "date string, tickers string")
    assert sorted(r.ticker for r in src.explode_members(raw).collect()) == ["AAPL", "BRK.B", "MSFT"]


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "2020-01-31", 1.0, 2020, 0), (1, "2021-01-31", 2.0, 2021, 0)]
    schema = "ticker int, date date, v double, year int, seq long"
    src.upsert(spark, path, frame(spark, rows, schema), ["ticker", "date"], ["year"], str(tmp_path / "s0"))
    for i in range(2):
        src.upsert(
            spark, path, frame(spark, [(1, "2021-01-31", 3.0, 2021, 1), (2, "2021-01-31", 4.0, 2021, 1)], schema), ["ticker", "date"],
            ["year"], str(tmp_path / f"s{i + 1}")
        )
    assert sorted((r.ticker, r.year, r.v) for r in spark.read.parquet(path).collect()) == [(1, 2020, 1.0), (1, 2021, 3.0), (2, 2021, 4.0)]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = str(tmp_path / "events")
    events.repartition(3).write.parquet(folder)
    stream = ingest.bars(
        ingest.read_events(spark, folder), lookback_days=60
    ).writeStream.format("memory").queryName("bars").outputMode("complete").trigger(availableNow=True).start()
    stream.awaitTermination(120)
    key = lambda df: sorted((r.start, r.event_type, r.last_value, r.n) for r in df.collect())
    assert key(spark.table("bars")) == key(ingest.bars(events))


def test_long_short_is_long_minus_short(spark):
    rows = [(t, D("2020-01-31") + dt.timedelta(days=31 * m), float(t % 7 + m), float(t)) for t in range(20) for m in range(4)]
    df = spark.createDataFrame(rows, "ticker int, date date, excess double, s double")
    out = op.long_short(df, op.long_signals(df.select("ticker", "date", "s"), ["s"])).collect()
    assert len(out) == 3 and all(r.factor == pytest.approx(r.long_leg - r.short_leg) for r in out)


def test_two_way_effects(spark):
    rng = np.random.default_rng(8)
    rows = [(e, t, float(x), float(0.7 * x + e - 0.3 * t + z)) for e in range(12) for t in range(5) if (e + t) % 4 for x, z in [rng.normal(size=2)]]
    df = spark.createDataFrame([*rows, (99, 0, None, 1.0)], "ticker int, year int, x double, y double")
    found = rg.two_way_effects(df, "y", ["x"]).first()
    e, t, x, y = (np.array(c) for c in zip(*rows, strict=True))
    design = np.column_stack([x, *(e == i for i in range(12)), *(t == i for i in range(1, 5))]).astype(float)
    coef, rest, _, _ = np.linalg.lstsq(design, y, rcond=None)
    error = np.sqrt(rest[0] / (len(y) - design.shape[1]) * np.linalg.inv(design.T @ design)[0, 0])
    assert (found.coef, found.std_error, found.n) == (pytest.approx(coef[0]), pytest.approx(error), len(y))
    assert rg.two_way_effects(df.where("false"), "y", ["x"]).count() == 0


def test_mapping(spark):
    raw = spark.createDataFrame([(1, " ab ", 3), (1, "AB", 1), (1, "cd", 2), (2, "ab", 0), (None, "x", 4), (3, "", 5)], "k int, name string, o int")
    pairs = mp.clean_pairs(raw, F.col("k"), F.col("name"), F.col("o"))
    assert sorted(map(tuple, pairs.collect())) == [(1, "AB", 1), (1, "CD", 2), (2, "AB", 0)]
    asked = spark.createDataFrame([("Ab",), ("zz",), (None,)], "ticker string")
    assert {r.ticker: r.key for r in mp.key_of(asked, pairs).collect()} == {"Ab": 2, "zz": None, None: None}
    put = mp.put(mp.first_name(pairs).select("ticker", "key"), spark.createDataFrame([("ab", 7)], "ticker string, key long"))
    assert [tuple(r) for r in put.collect()] == [("ab", 7)]


def test_read_returns(spark, tmp_path):
    rows = [(0.5, 9.0, "2020-01-31"), (float("nan"), 9.0, "2020-02-29"), (None, 9.0, "2020-03-31")]
    df = spark.createDataFrame(rows, "`r.x` double, other double, date string")
    df.write.parquet(str(tmp_path / "p.parquet"))
    df.select(F.col("date").alias("day"), "`r.x`").coalesce(1).write.csv(str(tmp_path / "p.csv"), header=True)
    for kind in ("parquet", "csv"):
        found = {r.date: r.ret for r in src.read_returns(spark, str(tmp_path / f"p.{kind}")).collect()}
        assert found == {D("2020-01-31"): 0.5, D("2020-02-29"): None, D("2020-03-31"): None}
    with pytest.raises(ValueError):
        src.read_returns(spark, "p.txt")


def months(n):
    return [(pd.Timestamp("2000-01-31") + pd.offsets.MonthEnd(i)).date() for i in range(n)]


def factor_rows(n=50, tickers=(1, 2)):
    rng = np.random.default_rng(11)
    rows = []
    for t in tickers:
        x = rng.normal(size=(n, 2))
        y = 0.1 * t + x @ [1.0, -0.5 * t] + rng.normal(size=n)
        rows += [(t, d, *map(float, (v, *u))) for d, v, u in zip(months(n), y, x, strict=True)]
    return rows, "ticker long, date date, y double, a double, b double"


def test_lowest_p_values_of_score_betas(spark):
    folder = "/root/testdata/sf0.001"
    rows = panel_queries._score_change(panel_queries.Panels(spark, folder)).select("ticker", "excess", "chg").where("excess is not null and chg is not null").toPandas()
    want = []
    for ticker, own in rows.groupby("ticker"):
        x, y, n = own["chg"].to_numpy(float), own["excess"].to_numpy(float), len(own)
        if n < 24:
            continue
        a = np.column_stack([np.ones(n), x])
        coef, left = np.linalg.lstsq(a, y, rcond=None)[:2]
        t = coef[1] / math.sqrt(left[0] / (n - 2) * np.linalg.inv(a.T @ a)[1, 1])
        # Student's t by integration: the density's tail from |t| on, x = tan(u).
        u = np.linspace(math.atan(abs(t)), math.pi / 2, 200_001)
        density = np.cos(u) ** (n - 3) * (1 + (1 / (n - 2) - 1) * np.sin(u) ** 2) ** (-(n - 1) / 2)
        scale = math.exp(math.lgamma((n - 1) / 2) - math.lgamma((n - 2) / 2)) / math.sqrt((n - 2) * math.pi)
        want.append((2 * scale * float(np.trapezoid(density, u)), ticker, n, coef[1], t))
    want.sort()
    got = registry.QUERIES["f12_lowest_p"](spark, folder).collect()
    assert len(want) >= 2 and len(got) == min(10, len(want))
    for r, (p, ticker, n, beta, t) in zip(got, want, strict=False):
        assert (r.ticker, r.n) == (ticker, n) and (r.beta, r.t_stat) == (pytest.approx(beta, abs=1e-5), pytest.approx(t, abs=1e-3))
        assert r.p_value == pytest.approx(p, abs=1e-5)


def test_more_p_values(spark):
    df = spark.createDataFrame([(3.841459, 1.0), (5.991465, 2.0), (11.0, 10.0), (40.0, 10.0), (None, 1.0)], "x double, d double")
    got = [r[0] for r in df.select(p_value_chi2("x", "d")).collect()]
    assert got[:2] == pytest.approx([0.05, 0.05], abs=1e-6) and got[2:4] == pytest.approx([0.357518, 1.694e-5], rel=1e-3) and got[4] is None
    assert upper_gamma(np.array([1.0, 1.0]), np.array([0.5, 7.0])) == pytest.approx(np.exp([-0.5, -7.0]))
    f = spark.createDataFrame([(4.0, 1.0, 20.0)], "f double, a double, b double").select(p_value_f("f", "a", "b"), p_value_t(F.lit(2.0), F.lit(20.0))).first()
    assert f[0] == pytest.approx(f[1])


def test_zero_means(spark):
    rng = np.random.default_rng(11)
    rows = [("a", int(q), float(x)) for q, x in zip(rng.integers(0, 3, 200), rng.normal(0.1, 1, 200), strict=True)]
    edge = [("a", 0, None), ("a", 7, 0.5), ("one", 0, 1.0), ("flat", 0, 2.0), ("flat", 0, 2.0), ("empty", 0, None)]
    df = spark.createDataFrame(rows + edge, "ticker string, q int, x double")
    got = {r.ticker: r for r in rg.zero_means(df, "x", "q").collect()}
    assert got.keys() == {"a", "one", "flat"}
    x = np.array([v for _, _, v in [*rows, edge[1]]])
    z = x.mean() / (x.std(ddof=1) / math.sqrt(len(x)))
    assert (got["a"].n, got["a"].groups) == (201, 3)
    assert (got["a"].z, got["a"].p_value) == (pytest.approx(z), pytest.approx(math.erfc(abs(z) / math.sqrt(2))))
    cells = [np.array([v for _, g, v in rows if g == k]) for k in range(3)]
    wald = sum(len(c) * c.mean() ** 2 / c.var(ddof=1) for c in cells)
    tail = math.erfc(math.sqrt(wald / 2)) + math.sqrt(2 * wald / math.pi) * math.exp(-wald / 2)
    assert (got["a"].wald, got["a"].wald_p) == (pytest.approx(wald), pytest.approx(tail))
    assert all((got[t].z, got[t].p_value, got[t].groups, got[t].wald, got[t].wald_p) == (None, None, 0, None, None) for t in ("one", "flat"))


def test_rolling_regressions_against_least_squares(spark):
    rows, schema = factor_rows()
    df = spark.createDataFrame(rows, schema)
    one = {(r.ticker, r.date): r for r in rg.rolling_ols(df, "y", "a", 12, 8).collect()}
    two = {(r.ticker, r.date): r for r in rg.two_factor(df, "y", "a", "b", 12, 8).collect()}
    hac = {(r.ticker, r.date, r.term): r for r in rg.rolling_hac(df, "y", ["a", "b"], 12, 3, 8).collect()}
    assert len(one) == len(two) == 2 * 43 and len(hac) == 3 * len(two)
    for t in (1, 2):
        own = np.array([r[2:] for r in rows if r[0] == t])
        for i, d in enumerate(months(50)):
            if i < 7:
                continue
            y, x = own[max(0, i - 11) : i + 1, 0], own[max(0, i - 11) : i + 1, 1:]
            slope, intercept = np.polyfit(x[:, 0], y, 1)
            assert (one[t, d].beta, one[t, d].alpha / 12, one[t, d].observations) == pytest.approx((slope, intercept, len(y)))
            coef, error, rest = rg.hac_ols(y, x, 3)
            assert [two[t, d].alpha, two[t, d].beta_1, two[t, d].beta_2] == pytest.approx(coef)
            assert [hac[t, d, k].coef for k in ("alpha", "a", "b")] == pytest.approx(coef) and [hac[t, d, k].std_error for k in ("alpha", "a", "b")] == pytest.approx(error)
            assert hac[t, d, "a"].r_squared == pytest.approx(two[t, d].r_squared) == pytest.approx(1 - rest @ rest / ((y - y.mean()) ** 2).sum())


def test_plain_regression_and_f(spark):
    rows, schema = factor_rows()
    got = {(r.ticker, r.term): r for r in rg.regress_hac(spark.createDataFrame(rows, schema), "y", ["a", "b"], None).collect()}
    own = np.array([r[2:] for r in rows if r[0] == 1])
    design = np.column_stack([np.ones(50), own[:, 1:]])
    coef, rest, *_ = np.linalg.lstsq(design, own[:, 0], rcond=None)
    error = np.sqrt(rest[0] / 47 * np.diag(np.linalg.inv(design.T @ design)))
    r2 = 1 - rest[0] / ((own[:, 0] - own[:, 0].mean()) ** 2).sum()
    assert [got[1, k].coef for k in ("alpha", "a", "b")] == pytest.approx(coef) and [got[1, k].std_error for k in ("alpha", "a", "b")] == pytest.approx(error)
    assert got[1, "a"].f == pytest.approx(r2 / 2 / ((1 - r2) / 47)) and got[1, "a"].stars == "***"
    assert got[1, "b"].p == pytest.approx(float(incomplete_beta(23.5, 0.5, 47 / (47 + got[1, "b"].t ** 2))))
    table = {r.ticker: r for r in rg.batch_table(rg.regress_hac(spark.createDataFrame([(t, d, y, a, b) for t, d, y, a, b in rows], "ticker long, date date, excess double, mkt_excess double, factor double"), "excess", ["mkt_excess", "factor"])).collect()}
    assert table[None].alpha == pytest.approx((table[1].alpha + table[2].alpha) / 2) and table[1].beta_market == pytest.approx(coef[1])


def test_residual_diagnostics(spark):
    rows, schema = factor_rows(80, (1,))
    got = rg.residual_diagnostics(spark.createDataFrame(rows, schema), "y", "a", "b").first()
    own = np.array([r[2:] for r in rows])
    design = np.column_stack([np.ones(80), own[:, 1:]])
    e = own[:, 0] - design @ np.linalg.lstsq(design, own[:, 0], rcond=None)[0]
    s, k = (e**3).mean() / (e**2).mean() ** 1.5, (e**4).mean() / (e**2).mean() ** 2 - 3
    jb = 80 / 6 * (s * s + k * k / 4)
    fit = design @ np.linalg.lstsq(design, e**2, rcond=None)[0]
    bp = 80 * (1 - ((e**2 - fit) ** 2).sum() / ((e**2 - (e**2).mean()) ** 2).sum())
    assert (got.durbin_watson, got.jarque_bera, got.jb_p, got.breusch_pagan, got.bp_p) == pytest.approx((
        ((np.diff(e)) ** 2).sum() / (e**2).sum(), jb, math.exp(-jb / 2), bp, math.exp(-bp / 2)
    ))


def test_expected_returns_caps_and_dates(spark):
    rates = frame(spark, [("2020-01-31", 1.2), ("2020-02-29", 1.2), ("2020-03-31", 2.4)], "date date, rate double")
    betas = frame(
        spark, [(1, "2020-02-29", 3.2, -7.69), (2, "2020-02-15", 1.0, 1.0), (2, "2020-03-31", 2.0, -1.0)],
        "ticker int, date date, beta_market double, beta_score double"
    )
    premia = spark.createDataFrame([(0.01, 0.002)], "market double, score double")
    got = {(r.ticker, r.date): r for r in pf.expected_returns(betas, rates, premia).collect()}
    assert set(got) == {(1, D("2020-01-31")), (1, D("2020-02-29")), (1, D("2020-03-31")), (2, D("2020-02-29")), (2, D("2020-03-31"))}
    first = got[1, D("2020-01-31")]
    assert (
        first.beta_market, first.beta_score, first.beta_market_capped, first.beta_score_capped
    ) == (3.2, -7.69, 3.0, -5.0) and first.beta_date == D("2020-02-29")
    assert first.er_monthly == pytest.approx(0.001 + 3 * 0.01 - 5 * 0.002) and first.er_annual == pytest.approx((1 + first.er_monthly) ** 12 - 1)
    assert got[2, D("2020-02-29")].beta_market == 1.0 and got[2, D("2020-03-31")].beta_market == 2.0
    constant = [r.beta_market for r in pf.expected_returns(betas, rates, premia, constant=True).where("ticker = 2").collect()]
    assert constant == [2.0, 2.0, 2.0] and pf.expected_returns(betas, rates, premia, None).where("ticker = 1").first().beta_market_capped == 3.2
    parts = pf.contributions(pf.expected_returns(betas, rates, premia), premia).where("ticker = 1").first()
    assert (parts.rf_part, parts.market_part, parts.score_part) == pytest.approx((0.024, 0.36, -0.12))


def test_portfolios_against_matrices(spark):
    rng = np.random.default_rng(5)
    n = 30
    x = rng.normal(size=(4, n)) * 0.05
    returns = spark.createDataFrame(
        [(t, d, float(x[t, i])) for t in range(4) for i, d in enumerate(months(n)) if not (t == 1 and i == 3)],
        "ticker long, date date, ret double"
    )
    w, b, e = np.array([0.5, 0.3, 0.2]), np.array([0.25, 0.25, 0.25, 0.25]), np.array([1.0, -2.0, 0.0, 4.0])
    weights = spark.createDataFrame([("p", t, float(w[t])) for t in range(3)], "portfolio string, ticker long, weight double")
    got = pf.evaluate(
        weights, returns, 0.001, spark.createDataFrame([(0, 1.0), (1, -2.0), (3, 4.0)], "ticker long, exposure double"),
        spark.createDataFrame([(t, 0.25) for t in range(4)], "ticker long, weight double")
    ).first()
    full = np.delete(x[:3], 3, axis=1)
    s = np.cov(full)
    mean = np.array([x[0].mean(), np.delete(x[1], 3).mean(), x[2].mean()])
    assert (got.exp_return, got.variance, got.exposure) == pytest.approx((w @ mean, w @ s @ w, w @ e[:3]))
    assert (got.tracking_error, got.active_return) == pytest.approx((math.sqrt((w - b[:3]) @ s @ (w - b[:3])), (w - b[:3]) @ mean))
    cost = pf.turnover(weights, spark.createDataFrame([(t, 0.25) for t in range(4)], "ticker long, weight double")).first().turnover
    assert cost == pytest.approx(0.25 + 0.05 + 0.05 + 0.25)
    cov = {(r.ticker_i, r.ticker_j): (r.cov, r.n) for r in op.pairwise_covariance(returns).collect()}
    wide = pd.DataFrame(x.T)
    wide.iloc[3, 1] = np.nan
    assert len(cov) == 10 and all(c == pytest.approx(wide[[i, j]].dropna().cov().iloc[0, -1] if i != j else wide[i].var()) for (i, j), (c, _) in cov.items())
    assert op.complete_dates(returns).select("date").distinct().count() == n - 1


def test_covariance_over_blocks(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 12))
    returns = spark.createDataFrame([(t, d, float(x[t, i])) for t in range(150) for i, d in enumerate(months(12))], "ticker long, date date, ret double")
    got = op.pairwise_covariance(returns).toPandas()
    want = np.cov(x)
    assert len(got) == 150 * 151 // 2 and np.allclose(got["cov"], want[got["ticker_i"], got["ticker_j"]]) and (got["ticker_i"] <= got["ticker_j"]).all()


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_covariance_shuffles_no_pairs(spark, monkeypatch, broadcast):
    """Blocks meet as they are stored: rows dealt to each pair of blocks were shuffled once a block."""
    monkeypatch.setattr(op, "NAMES", 8)
    monkeypatch.setattr(op, "SLICE", 3)
    rng = np.random.default_rng(8)
    x = np.where(rng.random((60, 9)) < 0.4, np.nan, rng.normal(size=(60, 9)))
    x[5], x[7, 1:] = np.nan, np.nan
    rows = [(f"t{t}", d, None if t % 2 and np.isnan(x[t, i]) else float(x[t, i])) for t in range(60) for i, d in enumerate(months(9))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        df = op.pairwise_covariance(spark.createDataFrame(rows, "ticker string, date date, ret double"))
        plan, got = df._jdf.queryExecution().executedPlan().toString(), {(r.ticker_i, r.ticker_j): (r.cov, r.n) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plan and ("CartesianProduct" in plan) == (broadcast == "-1")
    want = {}
    for i in range(60):
        for j in range(60):
            both = ~np.isnan(x[i]) & ~np.isnan(x[j])
            if f"t{i}" <= f"t{j}" and both.any():
                want[f"t{i}", f"t{j}"] = (float(np.cov(x[i, both], x[j, both])[0, 1]) if both.sum() > 1 else None, int(both.sum()))
    assert set(got) == set(want) and all(got[k] == (pytest.approx(c), n) if c is not None else got[k] == (None, n) for k, (c, n) in want.items())


def test_james_stein(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(5, 40)) * 0.03 + np.array([[0.02], [0.0], [0.01], [-0.01], [0.03]])
    df = spark.createDataFrame(
        [("u", t, d, float(x[t, i])) for t in range(5) for i, d in enumerate(months(40))], "u string, ticker long, date date, ret double"
    )
    mean, s = x.mean(axis=1), np.cov(x)
    d = mean - mean.mean()
    share = max(0.0, min(3 / (40 * d @ np.linalg.solve(s, d)), 1.0))
    got = sorted(rg.james_stein(df, "u").collect(), key=lambda r: r.ticker)
    assert [r.shrunk for r in got] == pytest.approx(((1 - share) * mean + share * mean.mean()) * 12) and got[0].intensity == pytest.approx(share) and 0 < share < 1


def test_rolling_estimates_and_bootstrap(spark):
    x = np.random.default_rng(4).normal(size=70)
    df = spark.createDataFrame([(1, d, float(v)) for d, v in zip(months(70), x, strict=True)], "ticker long, date date, ret double")
    got = {r.date: r.estimate for r in pf.rolling_mean_returns(df, 60, "ewma").collect()}
    assert len(got) == 11 and got[months(70)[-1]] == pytest.approx(pd.Series(x[-60:]).ewm(span=30).mean().iloc[-1] * 12)
    one = pf.bootstrap(df, 1000).first()
    assert one.mean == pytest.approx(x.mean() * 12, abs=0.3) and one.std_error == pytest.approx(x.std() / math.sqrt(70) * 12, rel=0.15) and one.low < one.mean < one.high
    assert pf.bootstrap(df, 1000).first() == one and pf.bootstrap(df, 200, lookback=24).first().mean == pytest.approx(x[-24:].mean() * 12, abs=1.0)


def test_units_names_and_numbers(spark):
    df = spark.createDataFrame([(0.5,), (None,), (-1.0,)], "x double")
    assert pf.check_units(df, "x").count() == 3 and [r.x for r in pf.check_units(df, "x").collect()] == [0.5, None, -1.0]
    with pytest.raises(Exception, match="monthly decimal"):
        pf.check_units(spark.createDataFrame([(1.5,)], "x double"), "x").collect()
    a, b, c = (spark.createDataFrame([(v,) for v in x], "ticker int") for x in ([1, 2, 3, 3], [2, 3], [3, 4]))
    assert [r.ticker for r in pf.common_names(a, b, c).collect()] == [3]
    text = spark.createDataFrame([("1.5",), (".",), ("nan",), (None,)], "t string")
    assert [r[0] for r in text.select(src.number(F.col("t"))).collect()] == [1.5, None, None, None]
    raw = spark.createDataFrame([("7", "202002", "50", ".", "1", "2"), ("7", "202013", "1", "1", "1", "1"), ("8", "x", "1", "1", "1", "1")], [*src.RAW_SCORES])
    assert [tuple(r) for r in src.raw_scores(raw).collect()] == [(7, D("2020-02-29"), 2020, 2, 50.0, None, 1.0, 2.0)]
    with pytest.raises(ValueError, match="missing columns"):
        src.raw_scores(raw.drop("gvkey"))


def test_membership_build_and_inventory(spark, tmp_path):
    one, two = frame(
        spark, [("2020-01-31", 1), ("2020-02-29", 1)], "date date, ticker int"
    ), frame(spark, [("2020-02-29", 1), ("2020-02-29", 2)], "date date, ticker int")
    path = str(tmp_path / "members")
    assert src.build_membership(spark, path, one).first().rows == 2
    merged = src.build_membership(spark, path, two).first()
    assert (merged.rows, merged.dates, merged.tickers) == (3, 2, 2)
    assert src.build_membership(spark, path, two, rebuild=True).first().rows == 2
    found = src.inventory(spark.read.parquet(path)).first()
    assert found["kind"] == "members" and found["files"] >= 1 and found["bytes"] > 0


def test_sliding_windows_and_spells_on_a_stream(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = str(tmp_path / "events")
    events.repartition(3).write.parquet(folder)
    newest = events.agg(F.max("ts")).first()[0]
    for name, f, mode, days, columns in (("sliding", ingest.rolling_coverage, "append", 5, ("start", "event_type", "n", "users")), ("spells", ingest.spells, "complete", 60, ("start", "end", "user_id", "n"))):
        source = ingest.read_events(spark, folder, files_a_batch=None)
        f(source, lookback_days=days).writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination(120)
        key = lambda df, columns=columns: sorted(tuple(r[c] for c in columns) for r in df.collect())
        whole = f(events)
        want = whole.where(F.col("end") <= F.lit(newest - dt.timedelta(days=5))) if mode == "append" else whole
        assert key(spark.table(name)) == key(want) and spark.table(name).count() > 0
