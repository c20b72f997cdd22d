"""Landing parsers and scalar rules (FIXTURES.md sections 2 and 3)."""

import json

from pyspark.sql import functions as F

from ledgerline.functions import exprs as X
from ledgerline.sources import landing as L


def test_delivery_csv_file(spark, tmp_path):
    p = tmp_path / "bhav.csv"
    p.write_text("SYMBOL, SERIES, DELIV_PER\nRELIANCE, EQ, 55.4\nINVALID, BE, 10.0\nX, EQ, -\n")
    got = {r.symbol: r.delivery_pct for r in L.read_delivery_csv(spark, str(p)).collect()}
    assert got == {"RELIANCE.NS": 55.4, "X.NS": None}


def test_circuit_bands(spark):
    lines = spark.createDataFrame([(f"S,{b}",) for b in ["2", "5", "10", "20", "No Band", "-", " 5 "]], "line string")
    got = [r.circuit_band for r in L.parse_circuit_lines(lines).collect()]
    assert got == [0.02, 0.05, 0.10, 0.20, None, None, 0.05]


def test_universe_csv_header_with_space(spark, tmp_path):
    p = tmp_path / "eq.csv"
    p.write_text("SYMBOL,NAME OF COMPANY, SERIES\nTCS,Tata, EQ\nABC,Abc, BE\n")
    assert [r.symbol for r in L.read_universe_csv(spark, str(p)).collect()] == ["TCS.NS"]


def test_sentiment_json(spark):
    doc = json.dumps([
        {"requested_symbol": "A", "sentiment": {"bullishPercent": 0.6, "bearishPercent": 0.5},
         "buzz": {"articlesInLastWeek": 1}},
        {"requested_symbol": "B", "sentiment": {"bullishPercent": 0.4, "bearishPercent": 0.5},
         "buzz": {"articlesInLastWeek": 2}},
        {"requested_symbol": "C", "sentiment": {"bullishPercent": None}},
        {"requested_symbol": "D", "sentiment": {"bullishPercent": 0.8, "bearishPercent": 0.1},
         "buzz": {"articlesInLastWeek": 9}},
    ])
    out = {r.symbol: r for r in L.flatten_sentiment_json(spark.createDataFrame([(doc,)], "json string")).collect()}
    assert out["A"].sentiment_direction == 0 and out["A"].news_coverage_flag == "low"
    assert out["B"].sentiment_direction == 0 and out["B"].news_coverage_flag == "normal"
    assert out["C"].sentiment_score == 0.0 and out["C"].news_intensity == 0
    assert out["D"].sentiment_direction == 1


def test_corporate_actions_two_rows(spark):
    doc = json.dumps({"INFY.NS": {"2024-01-05": {"dividend": 18.0, "split": 2.0}, "2024-01-09": {"dividend": 1.0}}})
    rows = L.explode_corporate_actions(spark.createDataFrame([(doc,)], "json string")).collect()
    assert [(str(r.date), r.action_type, r.action_value) for r in rows] == [
        ("2024-01-05", "DIVIDEND", 18.0), ("2024-01-05", "SPLIT", 2.0), ("2024-01-09", "DIVIDEND", 1.0)]


def test_earnings_only_when_key_exists(spark):
    docs = [(json.dumps({"A": {"next_earnings_date": "2024-02-01"}}),), (json.dumps({"B": {}}),)]
    rows = L.explode_earnings_calendar(spark.createDataFrame(docs, "json string")).collect()
    assert [(r.symbol, str(r.next_earnings_date)) for r in rows] == [("A", "2024-02-01")]


def test_fundamentals_flag(spark):
    docs = [("A", json.dumps({"trailingPE": 20.5})), ("B", json.dumps({"totalRevenue": 1e9})),
            ("C", json.dumps({"marketCap": 5e8}))]
    out = {r.symbol: r.fundamental_presence_flag
           for r in L.flatten_fundamentals_json(spark.createDataFrame(docs, "symbol string, json string")).collect()}
    assert out == {"A": 1, "B": 1, "C": 0}


def test_macro_html_rules(spark):
    html = ("<table><tr><td>Policy Repo Rate</td><td>:\r\n   6.50%</td></tr>"
            "<tr><td>Policy Repo Rate</td><td>: 5.25%</td></tr>"
            "<tr><td>Policy Repo Rate</td><td>: n/a</td></tr></table>"
            "<table><tr><th>6.48% GS 2035</th><td>: 7.0015% #</td></tr>"
            "<tr><td>7.10% GS 2041</td><td>: 6.90%</td></tr><tr><td>GS 2029</td><td>: 9.1%</td></tr>"
            "<tr><td>only one cell</td></tr></table>")
    r = L.extract_macro_html(spark.createDataFrame([(html,)], "html string")).first()
    assert r.rbi_repo_rate == 5.25 and r.india_10y_yield == 7.0015


def test_macro_prices_missing_ticker(spark):
    doc = json.dumps({"^NSEI": {"close": 23408.59, "date": "2026-06-04"}})
    r = L.scan_macro_prices_json(spark.createDataFrame([(doc,)], "json string")).first()
    assert r.india_vix_close is None and r.nifty50_close == 23408.59


def test_wide_to_long(spark):
    df = spark.createDataFrame([("2024-01-02", 1.0, 2.0, 0.5, 1.5, 10.0, None, None, None, None, None)],
                               "Date string, `A|Open` double, `A|High` double, `A|Low` double, `A|Close` double, "
                               "`A|Volume` double, `B|Open` double, `B|High` double, `B|Low` double, "
                               "`B|Close` double, `B|Volume` double")
    rows = L.wide_to_long(df).collect()
    assert len(rows) == 1 and rows[0].symbol == "A" and rows[0].volume == 10


def test_event_reference(spark, tmp_path):
    p = tmp_path / "events.yaml"
    p.write_text("events:\n  - event_date: '2026-02-01'\n    event_type: union_budget\n"
                 "    sectors_impacted: 'banks, nbfc'\n    notes: x\n    source: y\n")
    df = L.load_event_reference(spark, L.read_yaml_events(str(p)), run_id="J07_1")
    r = df.first()
    assert r.sectors_impacted == ["banks", "nbfc"] and r.market_context == "india" and r.ingestion_run_id == "J07_1"


def test_scalar_rules(spark):
    df = spark.createDataFrame([("RELIANCE.NS", "2026-06-06"), ("TCS.BO", "2026-01-26"), ("AAPL", "2026-06-03")],
                               "s string, d string")
    out = df.select(X.market_context("s").alias("m"), X.trading_day_flag("d").alias("t"),
                    X.bhav_date_format("d").alias("b")).collect()
    assert [r.m for r in out] == ["india", "india", "us"]
    assert [r.t for r in out] == [False, False, True]
    assert out[2].b == "03062026"


def test_drop_all_null_bars_and_names(spark):
    df = spark.createDataFrame([(None, None, None, None, None), (1.0, None, None, None, None)],
                               "open double, high double, low double, close double, volume long")
    assert X.drop_all_null_bars(df).count() == 1
    named = X.normalize_column_names(spark.createDataFrame([(1,)], "`BBL_20_2.0` int"))
    assert named.columns == ["bbl_20_2_0"]


def test_require_columns_present(spark):
    import pytest

    df = spark.createDataFrame([(1.0, None)], "rbi_repo_rate double, nifty50_close double")
    with pytest.raises(Exception):
        X.require_columns_present(df, ["rbi_repo_rate", "nifty50_close"]).collect()
    ok = spark.createDataFrame([(1.0, 2.0)], "rbi_repo_rate double, nifty50_close double")
    assert X.require_columns_present(ok, ["rbi_repo_rate", "nifty50_close"]).count() == 1


def test_next_upcoming_date_array(spark):
    df = spark.createDataFrame([(["2024-01-01", "2024-03-01", "2024-02-01"],)], "d array<string>")
    df = df.select(F.transform("d", lambda x: x.cast("date")).alias("d"))
    r = df.select(X.next_upcoming_date("d", "2024-01-15").alias("n")).first()
    assert str(r.n) == "2024-02-01"


def test_universe_of_a_market(spark):
    india = spark.createDataFrame([("TCS.NS",)], "symbol string")
    names = lambda m: sorted(r.symbol for r in L.universe_of(india, m).collect())
    assert names("india") == ["TCS.NS"] and names("us") == ["AAPL", "MSFT"] and names(None) == ["AAPL", "MSFT", "TCS.NS"]


def test_absent_institutional_share_is_zero(spark):
    got = L.flatten_fundamentals_json(spark.createDataFrame([("A", "{}")], "symbol string, json string")).first()
    assert got.institutional_ownership_pct == 0.0 and got.pe_ratio is None


def test_event_groups_reach_sectors_and_industries(spark):
    from ledgerline.operators import enrichment as EN

    days = [f"2024-01-{i:02d}" for i in range(1, 6)]
    rows = spark.createDataFrame([(s, d, "india", sec, ind) for s, sec, ind in (
        ("A", "Financials", "Banking"), ("B", "Consumer Discretionary", "Automobiles"), ("C", "Energy", "Oil & Gas")) for d in days],
        "symbol string, date string, market_context string, sector string, industry string").withColumn("date", F.to_date("date"))
    events = spark.createDataFrame([("2024-01-04", "policy", "banks, auto")], "event_date string, event_type string, sectors_impacted string")
    out = EN.macro_event_features(rows, events.withColumn("event_date", F.to_date("event_date")), EN.trading_calendar_index(rows))
    assert {r.symbol for r in out.where("macro_event_type is not null").collect()} == {"A", "B"}
