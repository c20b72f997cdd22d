"""G0 gate rules on small in-memory batches (cases of FIXTURES.md section 1)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import gate as G

UNIVERSE = ["AAPL", "MSFT", "GOOGL", "RELIANCE"]
SCHEMA = "symbol string, date string, open double, high double, low double, close double, volume long, seq int"
BASE = ("AAPL", "2024-01-02", 185.0, 186.0, 184.0, 185.5, 72000000, 0)
ASOF = "2024-01-02"  # a Tuesday


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def universe(spark):
    return spark.createDataFrame([(s,) for s in UNIVERSE], "symbol string")


def passing(spark, rows, asof=ASOF):
    v = G.verdicts(frame(spark, rows), universe(spark), asof)
    return G.passing_rows(v, ["seq"]).collect()


def row(**kw):
    d = dict(zip(["symbol", "date", "open", "high", "low", "close", "volume", "seq"], BASE))
    d.update(kw)
    return tuple(d.values())


def dates(n):
    start = dt.date(2023, 6, 1)
    return [(start + dt.timedelta(days=i)).isoformat() for i in range(n)]


def test_valid_row_passes(spark):
    assert len(passing(spark, [BASE])) == 1


@pytest.mark.parametrize("kw,expected", [
    ({"close": -1.0}, 0), ({"open": 0.0}, 0), ({"volume": 0}, 1), ({"high": 185.0, "low": 185.0}, 1),
    ({"high": 184.0, "low": 186.0}, 0), ({"symbol": "ZZZZ"}, 0), ({"date": "2099-01-01"}, 0),
    ({"date": "2020-06-30"}, 1), ({"date": "not a date"}, 0), ({"volume": None}, 0), ({"symbol": None}, 0),
])
def test_row_rules(spark, kw, expected):
    assert len(passing(spark, [row(**kw)])) == expected


def test_future_cutoff_rules(spark):
    # Friday -> next Monday, Saturday -> Monday, Sunday -> Monday, Tuesday -> Wednesday
    cases = {"2024-01-05": "2024-01-08", "2024-01-06": "2024-01-08", "2024-01-07": "2024-01-08",
             "2024-01-02": "2024-01-03"}
    df = spark.createDataFrame([(k,) for k in cases], "asof string")
    got = {r.asof: str(r.c) for r in df.select("asof", G.future_cutoff(F.col("asof")).alias("c")).collect()}
    assert got == cases


def test_today_and_next_business_day_pass(spark):
    assert len(passing(spark, [row(date="2024-01-02"), row(symbol="MSFT", date="2024-01-03")])) == 2
    assert len(passing(spark, [row(date="2024-01-04")])) == 0


def test_mixed_symbols(spark):
    out = passing(spark, [BASE, row(symbol="UNKNOWN", seq=1)])
    assert [r.symbol for r in out] == ["AAPL"]


def test_duplicates_keep_first(spark):
    out = passing(spark, [row(seq=2, close=185.7), row(seq=1, close=185.6), row(symbol="MSFT", seq=3)])
    got = {r.symbol: r.close for r in out}
    assert got == {"AAPL": 185.6, "MSFT": 185.5}


def _batch(n, n_missing):
    return [row(date=d, volume=None if i < n_missing else 100, symbol=UNIVERSE[i % 4], seq=i)
            for i, d in enumerate(dates(n))]


def test_missing_ratio_threshold(spark, tmp_path):
    ok = G.run(spark, frame(spark, _batch(100, 2)), "finnhub", ASOF, universe(spark), asof=ASOF, order=["seq"],
               audit_path=str(tmp_path / "audit"))
    assert ok.passed.count() == 98 and ok.audit["status"] == "PARTIAL"
    five = G.run(spark, frame(spark, _batch(100, 5)), "finnhub", ASOF, universe(spark), asof=ASOF, order=["seq"])
    assert five.passed.count() == 95  # exactly 5 % is allowed (strictly greater fails)
    with pytest.raises(G.GateError, match="missing-field ratio"):
        G.run(spark, frame(spark, _batch(100, 6)), "finnhub", ASOF, universe(spark), asof=ASOF, order=["seq"],
              audit_path=str(tmp_path / "audit"))
    statuses = [r.status for r in spark.read.parquet(str(tmp_path / "audit")).orderBy("timestamp").collect()]
    assert statuses == ["PARTIAL", "FAIL"]


def test_four_percent_nulls_dropped(spark):
    rows = [row(date=d, seq=i) for i, d in enumerate(dates(25))]
    rows[3] = row(date=dates(25)[3], volume=None, seq=3)
    assert len(passing(spark, rows)) == 24


def test_audit_statuses_and_quarantine(spark, tmp_path):
    res = G.run(spark, frame(spark, [BASE]), "finnhub", ASOF, universe(spark), asof=ASOF, order=["seq"],
                quarantine_root=str(tmp_path))
    assert res.audit["status"] == "PASS" and res.audit["reject_count"] == 0 and res.quarantine_path == ""
    assert not os.path.exists(tmp_path / "quarantine")
    res = G.run(spark, frame(spark, [BASE, row(symbol="MSFT", close=-5.0, seq=1)]), "finnhub", ASOF,
                universe(spark), asof=ASOF, order=["seq"], quarantine_root=str(tmp_path))
    assert res.audit["status"] == "PARTIAL" and res.audit["reject_count"] == 1 and res.audit["pass_count"] == 1
    q = spark.read.json(res.quarantine_path).collect()
    assert [r.symbol for r in q] == ["MSFT"] and "non_positive_price" in q[0].g0_reasons
    res = G.run(spark, frame(spark, [row(close=-1.0)]), "finnhub", ASOF, universe(spark), asof=ASOF, order=["seq"])
    assert res.audit["status"] == "FAIL"


def test_no_mandatory_columns_fails(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(G.GateError):
        G.run(spark, df, "finnhub", ASOF, universe(spark))


def test_empty_batch(spark):
    res = G.run(spark, frame(spark, []), "finnhub", ASOF, universe(spark), asof=ASOF, order=["seq"])
    assert res.passed.count() == 0 and res.audit["status"] == "PASS"


def test_missing_column_rejects_all(spark):
    df = frame(spark, [BASE]).drop("volume")
    v = G.verdicts(df, universe(spark), ASOF)
    assert v.filter("g0_pass").count() == 0


def test_batch_ratio_per_date(spark):
    rows = [row(date="2023-12-01", symbol=UNIVERSE[i % 4], seq=i) for i in range(20)]
    rows += [row(date="2023-12-04", symbol=UNIVERSE[i % 4], seq=100 + i, volume=None if i < 2 else 5)
             for i in range(20)]
    v = G.verdicts(frame(spark, rows), universe(spark), ASOF, batch_cols=["date"])
    audit = {r.date: r.status for r in G.audit_by_batch(v, ["date"], ["seq"]).collect()}
    assert audit == {"2023-12-01": "PASS", "2023-12-04": "FAIL"}  # duplicates are dropped, not rejected
