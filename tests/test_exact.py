"""Ranks, quantiles, products, draws, shrinkage, period effects and spells on a stream against brute force."""

import datetime
import math
import struct

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelwise.operators import panel as op
from panelwise.operators import portfolio as pf
from panelwise.operators import ranks
from panelwise.operators import reference as ref
from panelwise.operators import regression as rg
from panelwise.streaming import ingest


def test_bits_are_those_of_doubles(spark):
    rng = np.random.default_rng(1)
    known = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf, math.nan]
    values = known + [2.0**k * m for k in range(-1022, 1023, 7) for m in (1, 1 - 2**-53, -1)] + [struct.unpack("d", rng.bytes(8))[0] for _ in range(500)]
    for r in ranks.ordered_bits(spark.createDataFrame([(v,) for v in values], "x double"), "x").collect():
        bits = struct.unpack("q", struct.pack("d", abs(r.x)))[0]
        assert r._bits == ((2047 << 52) + 1 if math.isnan(r.x) else -bits if r.x < 0 else bits)


def cross_sections():
    """Weights that differ in their last bits, returns, a constant, ties, both zeros, and groups of one row and of null."""
    rng = np.random.default_rng(2)
    columns = {
        "weights": 1e-5 * (1 + rng.integers(0, 400, 300) * 2.0**-50), "returns": rng.normal(size=300) * 0.02, "constant": np.full(300, 3.5),
        "ties": rng.integers(0, 4, 300).astype(float), "zeros": np.where(rng.random(300) < 0.5, 0.0, -0.0), "one": np.array([7.0]), None: rng.normal(size=50)
    }
    return [(k, i, float(x)) for k, v in columns.items() for i, x in enumerate(v)] + [("returns", 900, None), ("none", 901, None)]


@pytest.mark.parametrize("bound", [8, 1 << 16])
def test_ranks_and_quantiles_of_any_spread(spark, monkeypatch, bound):
    monkeypatch.setattr(ranks, "BOUND", bound)
    df = spark.createDataFrame(cross_sections(), "kind string, i int, x double")
    known = pd.DataFrame(cross_sections(), columns=["kind", "i", "x"]).dropna(subset="x").fillna({"kind": "null"})
    got = {(r.kind or "null", r.i): r.pct for r in ranks.percentile_rank(df, "x", "kind").collect()}
    want = known.groupby("kind")["x"].rank(pct=True)
    assert len(got) == len(known) and all(got[k, i] == pytest.approx(p, abs=1e-12) for k, i, p in zip(known["kind"], known["i"], want, strict=True))
    points = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    edges = {r.kind or "null": r.edges for r in ranks.quantiles(df, "x", points, "kind").collect()}
    assert edges.keys() == set(known["kind"])
    for kind, own in known.groupby("kind"):
        assert edges[kind] == pytest.approx(np.quantile(own["x"], points), rel=1e-14, abs=1e-300)
    exact = df.groupBy("kind").agg(F.expr("percentile(x, array(0.1D, 0.2D, 0.3D, 0.4D, 0.5D, 0.6D, 0.7D, 0.8D, 0.9D))").alias("e"))
    plain = df.join(exact, df["kind"].eqNullSafe(exact["kind"])).select("i", F.expr("1 + size(filter(e, v -> v < x))").alias("b"), "x")
    bucketed = ranks.quantile_bucket(df, "x", 10, "kind")
    key = lambda rows: sorted((r.i, r.x, r.b) for r in rows.where("x is not null").collect())
    assert key(bucketed.select("i", "x", F.col("bucket").alias("b"))) == key(plain)
    assert "percentile(" not in bucketed._jdf.queryExecution().toString()


def test_fused_edges_are_those_of_the_sql(spark):
    """Deciles of numbers that tie or nearly tie at the edges, as quantile_cont's edges, bit by bit."""
    rng = np.random.default_rng(13)
    rows = [(k, i, float(x)) for k in range(60) for i, x in enumerate((rng.integers(0, 12, 83) * 100 / 7 + rng.integers(0, 3, 83) * 2.0**-46) / 3)]
    rows += [(90, i, x) for i, x in enumerate([1e-5, 1e300, 1.7e308, 1.7e308, -3.0])] + [(91, i, 0.1) for i in range(7)]
    df = spark.createDataFrame(rows, "k int, i int, x double")
    con = duckdb.connect()
    known = pd.DataFrame(rows, columns=["k", "i", "x"])  # noqa: F841
    want = dict(con.execute("select k, quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) from known group by k").fetchall())
    points = [i / 10 for i in range(1, 10)]
    got, plain = ({r.k: r.edges for r in ranks.quantiles(df, "x", points, "k", fused=f).collect()} for f in (True, False))
    assert got == want and plain != want and all(plain[k] == pytest.approx(want[k], rel=1e-14) for k in want)


def test_cells_are_bounded(spark):
    """Ten times the rows leave the cells that one task sorts as they are."""
    for n in (20_000, 200_000):
        rows = ranks._digits(spark.range(n).select(F.lit(1).alias("g"), (1 + F.rand(3) * 1e-4).alias("x")), "x")
        wide = rows.groupBy("_d1").count().agg(F.max("count")).first()[0]
        fine = rows.groupBy("_d1", "_d2").count().agg(F.max("count")).first()[0]
        assert wide == n and fine < n / 90


def months(n):
    return [d.date() for d in pd.date_range("1995-01-31", periods=n, freq="ME")]


def test_a_total_loss_stays(spark):
    def run(values):
        df = spark.createDataFrame([(1, d, r) for d, r in zip(months(len(values)), values, strict=True)], "ticker int, date date, ret double")
        return [(r.cumulative, r.drawdown) for r in op.drawdowns(df).orderBy("date").collect()], df.agg(F.expr(op.compounded("(1 + ret)")).alias("p")).first().p
    rows, product = run([0.1, -1.0, 0.5])
    assert [c for c, _ in rows] == pytest.approx([0.1, -1, -1]) and [d for _, d in rows] == pytest.approx([0, -1, -1]) and product == 0
    rows, product = run([0.5, -3.0, 0.2, -1.5])
    assert [c for c, _ in rows] == pytest.approx([0.5, -4, -4.6, 0.8]) and product == pytest.approx(1.8)
    rows, product = run([-1.0, 0.2])
    assert rows == [(-1.0, None), (-1.0, None)] and product == 0


def test_resamples_share_no_draws():
    n = 5000
    place = pf.draws(7, np.arange(60)[:, None], n, 5)
    weights = np.stack([np.bincount(row, minlength=n) for row in place])
    near = [np.corrcoef(weights[b], weights[b + 1])[0, 1] for b in range(59)]
    shifted = [np.corrcoef(place[b][1000:], place[b + 1][:-1000])[0, 1] for b in range(59)]
    assert max(map(abs, near)) < 0.06 and max(map(abs, shifted)) < 0.06 and abs(np.mean(near)) < 0.01
    assert weights.var() == pytest.approx(1 - 1 / n, rel=0.05) and (weights.sum(axis=1) == n).all()


def test_ewma_over_several_blocks(spark):
    x = np.random.default_rng(5).normal(size=700)
    df = spark.createDataFrame([(1, (datetime.date(2000, 1, 1) + datetime.timedelta(days=i)), float(v)) for i, v in enumerate(x)], "ticker int, date date, ret double")
    found = pf.rolling_mean_returns(df, 60, "ewma").orderBy("date")
    keep = (1 - 2 / 31) ** np.arange(59, -1, -1)
    assert [r.estimate for r in found.collect()] == pytest.approx([x[i - 59 : i + 1] @ keep / keep.sum() * 12 for i in range(59, 700)], rel=1e-9)
    assert "collect_list" not in found._jdf.queryExecution().toString()


def test_james_stein_of_more_names_than_dates(spark):
    rng = np.random.default_rng(6)
    rows = [("wide", i, d, float(v)) for i in range(600) for d, v in zip(months(24), rng.normal(size=24), strict=True)]
    rows += [("gap", i, d, float(v)) for i in range(3) for d, v in zip(months(30)[i:], rng.normal(size=30 - i) + i, strict=True)] + [("gap", 0, months(31)[-1], None)]
    df = spark.createDataFrame(rows, "u string, ticker long, date date, ret double")
    got = {(r.u, r.ticker): r for r in rg.james_stein(df, "u").collect()}
    wide = np.array([r[3] for r in rows[: 600 * 24]]).reshape(600, 24).mean(axis=1)
    assert all(got["wide", i].intensity == 0.5 and got["wide", i].shrunk == pytest.approx((wide[i] + wide.mean()) * 6) for i in range(600))
    x = np.array([[r[3] for r in rows if r[0] == "gap" and r[1] == i and months(30)[2] <= r[2] <= months(30)[-1]] for i in range(3)])
    d = x.mean(axis=1) - x.mean()
    share = max(0.0, min(1 / (28 * d @ np.linalg.solve(np.cov(x), d)), 1.0))
    assert [got["gap", i].intensity for i in range(3)] == pytest.approx([share] * 3) and rg.js_intensity(np.ones((2, 5))) == 0.5


def test_effects_of_a_thousand_periods(spark):
    rng = np.random.default_rng(7)
    rows = [(e, t, float(x), float(w), float(0.4 * x - 1.1 * w + e + math.sin(t) + z)) for e in range(4) for t in range(1000) if (e * 7 + t) % 5 for x, w, z in [rng.normal(size=3)]]
    df = spark.createDataFrame(rows, "ticker int, year int, x double, w double, y double")
    got = {r.term: r for r in rg.two_way_effects(df, "y", ["x", "w"]).collect()}
    e, t, x, w, y = (np.array(c) for c in zip(*rows, strict=True))
    design = np.column_stack([x, w, *(e == i for i in range(4)), *(t == i for i in range(1, 1000))]).astype(float)
    inverse = np.linalg.inv(design.T @ design)
    coef = inverse @ design.T @ y
    rest = y - design @ coef
    errors = np.sqrt(rest @ rest / (len(y) - design.shape[1]) * np.diag(inverse))
    assert [(got[c].coef, got[c].std_error) for c in "xw"] == [(pytest.approx(coef[i]), pytest.approx(errors[i])) for i in (0, 1)] and got["x"].n == len(rows)


def test_score_beta_extremes(spark):
    fit = spark.createDataFrame([(i, 30, b, t) for i, (b, t) in enumerate([(0.1, 1.0), (0.5, -9.0), (0.5, None), (-2.0, 3.0), (None, 8.0)])], "ticker int, n int, beta double, t_stat double")
    got = [(r.list, r.place, r.ticker) for r in rg.beta_extremes(fit, 2).collect()]
    assert sorted(got) == [("bottom", 1, 3), ("bottom", 2, 0), ("largest_t", 1, 1), ("largest_t", 2, 3), ("top", 1, 1), ("top", 2, 2)]


def test_recorded_spells_on_a_stream(spark, tmp_path):
    """Rows in three batches, some late: the closed spells are those of the batch form."""
    rng = np.random.default_rng(8)
    dates = sorted({datetime.date(2020, 1, 1) + datetime.timedelta(days=int(d)) for d in rng.integers(0, 200, 60)})
    rows = [(k, d) for k in range(6) for d in dates if rng.random() < 0.7] + [(None, dates[0]), (1, None)]
    schema, at = "ticker long, date date", lambda i: [r for r in rows if r[1] is None or dates[20 * i] <= r[1] <= dates[min(20 * i + 19, len(dates) - 1)]]
    late = [r for r in at(0) if r[1] and r[1] >= dates[19] - datetime.timedelta(days=3)]
    for i, own in enumerate(([r for r in at(0) if r not in late], [*at(1), *at(0)[:3]], at(2))):
        own = [*own, *late] if i == 1 else own
        spark.createDataFrame(own, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        spark.createDataFrame([(d,) for d in dates], "date date").write.mode("overwrite").parquet(f"{tmp_path}/dates")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{tmp_path}/in")
    spells = ingest.recorded_spells(stream, spark.read.parquet(f"{tmp_path}/dates"), lookback_days=200)
    spells.writeStream.format("memory").queryName("recorded").outputMode("append").trigger(availableNow=True).start().awaitTermination(120)
    assert spark.table("recorded").count() == 0  # nothing closes within the lookback
    spells = ingest.recorded_spells(stream, spark.read.parquet(f"{tmp_path}/dates"), lookback_days=30)
    spells.writeStream.format("memory").queryName("recorded30").outputMode("append").trigger(availableNow=True).start().awaitTermination(120)
    whole = ref.intervals(spark.createDataFrame([r for r in rows if None not in r], schema)).collect()
    bound = max(r[1] for r in rows if r[1]) - datetime.timedelta(days=30)
    after = dict(zip(dates, [*dates[1:], None], strict=True))
    want = sorted((r.ticker, r.start_date, r.end_date) for r in whole if after[r.end_date] and after[r.end_date] < bound)
    assert want and sorted(tuple(r) for r in spark.table("recorded30").collect()) == want


def test_recorded_spells_take_a_call_a_bucket(spark, tmp_path, monkeypatch):
    """State has a row a bucket; it had one a key, and each was a call in each micro-batch."""
    monkeypatch.setattr(ingest, "BUCKETS", 8)
    dates = [datetime.date(2020, 12, 1) + datetime.timedelta(days=20 * i) for i in range(5)]
    rows = [(f"k{k}", dates[i]) for k in range(300) for i in range(5) if (k >> i) & 1 or (i == 4 and k % 2)]
    schema = "ticker string, date date"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    spells = ingest.recorded_spells(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), spark.createDataFrame([(d,) for d in dates], "date date"))
    query = spells.writeStream.format("memory").queryName("bucketed").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert max(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators) <= 8
    whole = ref.intervals(spark.createDataFrame(rows, schema)).collect()
    want = sorted((r.ticker, r.start_date, r.end_date) for r in whole if r.end_date < dates[3])
    assert want and sorted(tuple(r) for r in spark.table("bucketed").collect()) == want


def test_closed_runs_against_rows():
    rng = np.random.default_rng(11)
    day, unknown = np.cumsum(rng.integers(1, 9, 40)) - 60, ingest._UNKNOWN
    for watermark in (None, -5, 60, 10_000):
        names, runs, rows = [], [], {}
        for _ in range(400):
            name, a = f"n{rng.integers(20)}", int(rng.integers(39))
            b = min(a + int(rng.integers(3)), 39)
            names.append(name)
            runs.append((a, day[a], b, day[b], day[b + 1] if b < 39 and rng.random() < 0.9 else unknown))
            rows.setdefault(name, {}).update({i: max(rows.get(name, {}).get(i, unknown), runs[-1][4] if i == b else unknown) for i in range(a, b + 1)})
        want = []
        for name, own in rows.items():
            first = None
            for i in sorted(own):
                first = i if i - 1 not in own else first
                if i + 1 not in own:
                    want.append((name, first, day[first], i, day[i], own[i], watermark is not None and unknown < own[i] < watermark))
        got, joined, closed = ingest._closed_runs(watermark, np.array(names, dtype=object), np.array(runs, dtype=np.int64).T)
        assert sorted((n, *map(int, r), bool(c)) for n, r, c in zip(got, joined.T, closed, strict=True)) == sorted(want)
    assert ingest._closed_runs(5, np.array([], dtype=object), np.zeros((5, 0), np.int64))[1].shape == (5, 0)


def test_tickers_of_many_lengths_are_solved_together(spark, monkeypatch):
    """As each alone; solved in few calls, where each ticker was a group and a call of its own."""
    rng = np.random.default_rng(12)
    rows = []
    for t in range(40):
        for i in range(int(rng.integers(20, 60)) if t else 700):
            rows.append((f"t{t}", datetime.date(2000, 1, 1) + datetime.timedelta(days=i), *(None if rng.random() < 0.02 else float(v) for v in rng.normal(size=3))))
    rows += [(None, r[1], 1.0, 2.0, 3.0) for r in rows[:50]]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "ticker string, date date, y double, a double, b double")
    monkeypatch.setattr(rg, "ROWS", 256)
    fit = rg.regress_hac(df, "y", ["a", "b"])
    got = {(r.ticker, r.term): r for r in fit.collect()}
    assert "FlatMapGroups" not in fit._jdf.queryExecution().toString()
    seen = set()
    for t in range(40):
        own = np.array([r[2:] for r in rows if r[0] == f"t{t}" and None not in r])
        if len(own) >= 24:
            seen |= {(f"t{t}", k) for k in ("alpha", "a", "b")}
            coef, error, _ = rg.hac_ols(own[:, 0], own[:, 1:])
            each = [got[f"t{t}", k] for k in ("alpha", "a", "b")]
            assert [r.coef for r in each] == pytest.approx(coef) and [r.std_error for r in each] == pytest.approx(error) and {r.n for r in each} == {len(own)}
    assert set(got) == seen and 60 < len(seen) < 120
    batches = [pa.RecordBatch.from_pydict({"ticker": own}) for own in ([1] * 5, [1, 1, 2, 3, 3], [3])]
    assert [t.column("ticker").to_pylist() for t in rg._whole_series(iter(batches), 4)] == [[1] * 7 + [2], [3, 3, 3]]
