"""Real files in, real files out."""

import datetime as dt
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from earshot.plans.dataset import build_dataset, preprocess
from earshot.sources import markets, sinks, tables
from earshot.sources import transcripts as S
from earshot.streaming import quotes as Q

HEADER = "Symbol: {t}\nPeriod: Q{q} {y}\nDate: {d}\n==========\n\n"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture
def roots(tmp_path):
    e, c = tmp_path / "expanded", tmp_path / "cache"
    write(e / "KO_transcripts" / "KO_2024_Q1.txt", HEADER.format(t="KO", q=1, y=2024, d="2024-04-30") + "Hello ==\nworld " * 3)
    write(e / "KO_transcripts" / "KO_2024_Q2.txt", HEADER.format(t="KO", q=2, y=2024, d="soon") + "no date here")
    write(e / "BRK-B_transcripts" / "BRK-B_2024_Q1.txt", HEADER.format(t="BRK-B", q=1, y=2024, d="2024-05-01") + "text")
    write(c / "KO" / "2024Q1.json", json.dumps([{"content": "from cache", "date": "2024-04-29"}]))
    write(c / "KO" / "2024Q3.json", json.dumps({"content": None, "date": "2024-10-29 08:00:00"}))
    write(c / "KO" / "2024Q4.json", "[]")
    write(c / "KO" / "KO_2023_Q4.txt", "plain text only")
    write(c / "PEP_2024_Q1.txt", HEADER.format(t="PEP", q=1, y=2024, d="2024-04-23") + "root level")
    return e, c


def test_roots_and_precedence(spark, roots):
    e, c = map(str, roots)
    raw = {(r.ticker, r.year, r.quarter): r for r in S.read_raw_transcripts(spark, e, c).collect()}
    assert set(raw) == {("KO", 2024, 1), ("KO", 2024, 2), ("BRK-B", 0, 0), ("KO", 2024, 3), ("KO", 2024, 4), ("KO", 2023, 4)}
    assert raw[("KO", 2024, 1)].source == "local_txt" and raw[("KO", 2024, 1)].content.startswith("Hello world")
    assert raw[("KO", 2024, 2)].call_date is None and raw[("KO", 2024, 3)].content == "" and raw[("KO", 2024, 4)].call_date is None
    assert str(raw[("KO", 2024, 3)].call_date) == "2024-10-29"
    cached = sorted((r.ticker, r.year, r.quarter) for r in S.read_all_cached(spark, c).collect())
    assert cached == [("KO", 2023, 4), ("KO", 2024, 1), ("KO", 2024, 3), ("KO", 2024, 4), ("PEP", 2024, 1)]


def test_preprocess_job(spark, roots, tmp_path):
    e, c = map(str, roots)
    out = str(tmp_path / "clean")
    stats = {r.ticker: r for r in preprocess(spark, e, c, out, min_words=2).collect()}
    assert (stats["KO"].n_written, stats["KO"].n_missing_date, stats["KO"].n_too_short) == (3, 2, 2)
    assert stats["BRK-B"].n_unparseable == 1
    table = spark.read.parquet(out)
    got = [(r.year, r.quarter) for r in S.load_transcripts(table, "KO").collect()]
    assert got == [(2023, 4), (2024, 1), (2024, 2)]
    flat = spark.createDataFrame([("KO", "World", None, "yes", 0.4, "2024-06-01", "", "m1"), ("KO", "zzz", None, "no", None, "2024-06-01", "", "m2")],
                                 "company_label STRING, word STRING, label INT, result STRING, implied_prob DOUBLE, close_date STRING, settlement_date STRING, market_ticker STRING")
    labels = {r.market_ticker: r for r in build_dataset(flat, table, str(tmp_path / "labels")).collect()}
    assert labels["m1"].hist_rate == 1.0 and labels["m2"].hist_rate == 0.0 and labels["m1"].split == labels["m2"].split


def test_speaker_files(spark, tmp_path):
    long_line = "word " * 120
    write(tmp_path / "a" / "X_2024_Q1.txt", f"Symbol: KO\nPeriod: q1 2024\nDate: 2024-04-30\n=====\nJane Doe: {long_line}\n\n  Bob:\nplain: lower stays\n")
    write(tmp_path / "a" / "Y_2024_Q1.txt", "Period: Q2 2024\nJane Doe: short\n")
    write(tmp_path / "a" / "Z_2024_Q1.txt", "Symbol: Z\nno period\n")
    write(tmp_path / "a" / "W_2024_Q1.txt", "Symbol: W\nPeriod: Q1 2024\nDate: 2024-13-45\n====\nx\n")
    got = {r.ticker: r for r in S.read_speaker_corpus(spark, str(tmp_path)).collect()}
    assert set(got) == {"KO", "Y"}
    assert got["KO"].content == long_line.strip() + " plain: lower stays" and got["KO"].period_num == 8097
    assert got["Y"].content == "Period: Q2 2024 Jane Doe: short" and str(got["Y"].sort_key) == "2024-07-01"


def test_market_files(spark, tmp_path):
    m = {"ticker": "T1", "event_ticker": "KXMENTIONEARNAIR-26JAN09", "custom_strike": {"Word": "AI / ML"}, "result": "Yes", "previous_price_dollars": "0.4200",
         "close_time": "2026-01-09T15:00:00Z", "status": "finalized", "volume_fp": "12.00", "rules_primary": 'If "AI", yes\nelse no', "extra": 1}
    write(tmp_path / "KXMENTIONEARNAIR-26JAN09.json", json.dumps([m, {"ticker": "T2", "status": "active", "custom_strike": None}], indent=1))
    write(tmp_path / "KXMENTIONEARNAIR-26APR09.json", "[]")
    write(tmp_path / "events_KXMENTIONEARNAIR.json", json.dumps([{"event_ticker": "E1"}, {"ticker": "E2"}, {"title": "none"}]))
    flat = markets.flatten_markets(markets.read_market_files(spark, str(tmp_path)))
    got = {r.market_ticker: r for r in flat.collect()}
    assert set(got) == {"T1", "T2"} and got["T1"].company_label == "AIR" and got["T1"].label == 1 and got["T1"].implied_prob == 0.42
    assert got["T2"].word == "" and got["T2"].implied_prob is None and got["T2"].yes_bid == 0.0 and got["T2"].close_date == ""
    events = markets.read_event_index(spark, str(tmp_path))
    assert sorted((r.series_ticker, r.event_ticker) for r in events.collect()) == [("KXMENTIONEARNAIR", "E1"), ("KXMENTIONEARNAIR", "E2")]
    out = str(tmp_path / "csv")
    sinks.write_flat_markets(flat, out)
    back = {r.market_ticker: r for r in sinks.read_flat_markets(spark, out).collect()}
    assert back["T1"].rules_primary == 'If "AI", yes\nelse no' and back["T2"].implied_prob is None and back["T1"].volume == 12.0


def test_tracked_series(spark):
    known = {r.series_ticker: r.stock_ticker for r in markets.series_to_stock(spark).collect()}
    assert known["KXEARNINGSMENTIONLLY"] == "LLY" and known["KXBRKMENTION"] == "BRK-B" and known["KXMENTIONEARNM"] == "M"
    assert known["KXEARNINGSMENTIONCOINBASE"] == "COIN" and "KXEARNINGSMENTIONM" not in known
    sectors = {r.stock_ticker: r.sector for r in markets.stock_sectors(spark).collect()}
    assert sectors["AAPL"] == "Tech" and sectors["M"] == "Consumer" and "BABA" not in sectors


def test_experiment_log(spark, tmp_path):
    path = str(tmp_path / "log")
    for i, f1 in enumerate((0.5, 0.7)):
        sinks.append_experiment(spark, path, {"model": "tree", "split": "test", "feature_set": "all"},
                                {"n": 175, "f1_macro": f1, "confusion_matrix": [[71, 1], [8, 95]]}, timestamp=f"2026-01-0{i + 1}T00:00:00")
    (tmp_path / "log" / "hand.json").write_text('\n{"timestamp": "2025-01-01", "config": {}, "metrics": {"n": 1}, "notes": ""}\n\n', encoding="utf-8")
    log = tables.read_experiments(spark, path)
    assert log.count() == 3
    table = {(r.model, r.split): r.f1_macro for r in sinks.results_table(log).collect()}
    assert table == {("tree", "test"): 0.7, ("?", "?"): None}
    assert tables.find_experiments(log, "tree", "all", "test").select(F.col("metrics.confusion_matrix")[1][1]).first()[0] == 95


def test_stream_equals_batch(spark, sf_dir):
    from earshot.catalog.trading import scored_quotes
    from earshot.plans import fixtures as X
    from earshot.plans.recommender import score_quotes

    schema = X.table(spark, sf_dir, "events").schema
    stream = X.quotes(spark, sf_dir, Q.file_stream(spark, sf_dir, schema, "events.parquet"))
    probs = X.quotes(spark, sf_dir).select("market_ticker", "word").distinct().withColumn("tx_prob", F.lit(0.6))
    got = Q.drain(Q.scored_stream(stream, probs).select("event_id", "recommendation", "kelly"), "test-stream")
    batch = scored_quotes(spark, sf_dir).withColumn("tx_prob", F.lit(0.6)).withColumn("final_prob", (F.lit(0.6) + F.col("live_open_mid")) / 2)
    want = score_quotes(batch).select("event_id", "recommendation", "kelly")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_news_files(spark, tmp_path):
    from earshot.sources import news

    for name, text in {"2024Q1.json": '[{"publishedDate": "2024-04-02 08:30:00", "title": "AI", "text": "chips"}, {"title": "no date"}]',
                       "2024Q2.json": "[]", "2024Q3.json": "broken", "notes.json": '[{"publishedDate": "x"}]'}.items():
        (tmp_path / "KO").mkdir(exist_ok=True)
        (tmp_path / "KO" / name).write_text(text)
    rows = {(r.year, r.quarter, r.title): (r.ticker, str(r.call_date), r.content) for r in news.read_news(spark, str(tmp_path)).collect()}
    assert rows == {(2024, 1, "AI"): ("KO", "2024-04-02", "AI\nchips"), (2024, 1, "no date"): ("KO", "None", "no date\n"), (0, 0, ""): ("KO", "None", "\n")}


@pytest.fixture
def quote_files(spark, tmp_path):
    """Four files read one by one; a day that changes later, days that stay open, and a row behind the watermark."""
    rows = [
        [(1, "A", dt.datetime(2024, 1, 1, 9), 0.4, 10), (2, "A", dt.datetime(2024, 1, 1, 23, 50), 0.6, 5), (3, "B", dt.datetime(2024, 1, 1, 12), 0.1, 1)],
        [(4, "A", dt.datetime(2024, 1, 1, 23, 30), 0.9, 2), (5, "A", dt.datetime(2024, 1, 2, 8), 0.5, 3)],
        [(7, "B", dt.datetime(2024, 1, 3, 1), 0.3, 4), (8, "A", dt.datetime(2024, 1, 2, 9), 0.7, 1)],
        # Spark drops late rows by the watermark that the batch before last has reached.
        [(6, "B", dt.datetime(2024, 1, 1, 13), 0.2, 7)],
    ]
    folder = tmp_path / "quotes"
    folder.mkdir()
    for k, part in enumerate(rows):
        frame = pd.DataFrame(part, columns=["event_id", "market_ticker", "ts", "mid", "volume"]).astype({"ts": "datetime64[us]"})
        frame.to_parquet(folder / f"{k}.parquet", index=False)
        os.utime(folder / f"{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    return str(folder), spark.createDataFrame([], "event_id LONG, market_ticker STRING, ts TIMESTAMP, mid DOUBLE, volume LONG").schema


def test_candles_hold_open_days_and_newest_state(spark, quote_files):
    folder, schema = quote_files
    stream = Q.daily_candles(Q.file_stream(spark, folder, schema, files_per_trigger=1))
    got = {(r.market_ticker, r.day_start.day): (r.open_mid, r.close_mid, r.low_mid, r.high_mid, r.volume, r.n_quotes)
           for r in Q.drain(stream, "test-candles", "update", Q.CANDLE_KEYS).collect()}
    assert got == {
        ("A", 1): (0.4, 0.6, 0.4, 0.9, 17, 3),  # the second file changes a day of the first
        ("B", 1): (0.1, 0.1, 0.1, 0.1, 1, 1),  # quote 6 comes after the watermark
        ("A", 2): (0.5, 0.7, 0.5, 0.7, 4, 2), ("B", 3): (0.3, 0.3, 0.3, 0.3, 4, 1),  # open at the end
    }


@pytest.mark.parametrize("breaks_after_writing", [True, False])
def test_stream_goes_on_after_a_broken_batch_without_doubles(spark, quote_files, tmp_path, monkeypatch, breaks_after_writing):
    folder, schema = quote_files
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    write, seen = Q._write_batch, []

    def breaks(batch, batch_id, path):
        if batch_id == 1 and not breaks_after_writing:
            raise RuntimeError("executor lost")
        write(batch, batch_id, path)
        seen.append(batch_id)
        if batch_id == 1:
            raise RuntimeError("executor lost")

    def quotes():
        return Q.file_stream(spark, folder, schema, files_per_trigger=1)

    with monkeypatch.context() as patched:
        patched.setattr(Q, "_write_batch", breaks)
        with pytest.raises(Exception, match="executor lost"):
            Q.run_in_batches(quotes(), path, checkpoint)
    assert seen == ([-1, 0, 1] if breaks_after_writing else [-1, 0])
    Q.run_in_batches(quotes(), path, checkpoint)
    assert sorted(r.event_id for r in Q.read_batches(spark, path, schema).collect()) == list(range(1, 9))
    Q.run_in_batches(quotes(), path, checkpoint)  # nothing new
    assert Q.read_batches(spark, path, schema).count() == 8


def test_stream_without_input_leaves_an_empty_table(spark, quote_files, tmp_path):
    _, schema = quote_files
    (tmp_path / "none").mkdir()
    assert Q.drain(Q.file_stream(spark, str(tmp_path / "none"), schema), "test-no-input").count() == 0
