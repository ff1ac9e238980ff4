"""Column expressions against hand-made values."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from earshot.constants import SAFE_HARBOR_PHRASES
from earshot.functions import market, periods, trading
from earshot.functions import text as T
from earshot.functions import words as W


def values(spark, expr, rows, schema="x STRING"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_clean_transcript_matches_python_rules(spark):
    texts = [
        "Revenue up. This is a Forward-Looking Statement about it. Good\n\nday!",
        "Actual results could, for reasons, vary  materially! ok",
        "See https://a.b/c?d now www.x.y end",
        "Full-width ＡＢＣ and ﬁne print\n Related: links\nmore",
        "no terminator but risk factors here",
        "a. risk factors. b safe harbor? c",
        "", "   ", "We made a forward-looking agreement.",
        "word " * 3000 + "risk factors",
    ]

    def expected(s):
        s = unicodedata.normalize("NFKC", s)
        s = re.sub(r"\n\s*Related\s*:.*\Z", "", s, flags=re.S | re.I)
        s = re.sub(r"(?:https?://|www\.)\S+", " ", s, flags=re.I)
        for p in SAFE_HARBOR_PHRASES:
            s = re.sub(rf"[^.?!]*{p}[^.?!]*[.?!]", " ", s, flags=re.I)
        return re.sub(r"\s+", " ", s.lower()).strip()

    assert values(spark, T.clean_transcript(F.col("x")), texts) == [expected(s) for s in texts]


def test_word_count(spark):
    assert values(spark, T.word_count(F.col("x")), ["", "a", " a  b\nc d "]) == [0, 1, 4]


def test_variants_and_counts(spark):
    assert values(spark, W.word_variants(F.col("x")), ["AI / AI model", " / ", None, "a/b"]) == [
        ["ai", "ai model"], [], [], ["a", "b"]]
    rows = [
        ("AI model and ai", "AI / AI model", 3), ("", "a", 0), (None, "a", 0), ("c++ is c+", "c++", 0),
        ("a.b axb", "a.b", 1), (r"x\Ey xEy", r"x\Ey", 1), ("the the the", "The", 3), ("café cafés", "café", 1),
    ]
    df = spark.createDataFrame(rows, "t STRING, w STRING, want INT")
    for r in df.select("want", W.count_mentions(F.col("t"), F.col("w")).alias("got")).collect():
        assert r.got == r.want


def test_whole_word_against_python(spark):
    rows = [("we said AI today", "AI"), ("said", "AI"), ("a / b", "a / b"), ("ab", "a / b"), ("x+y", "+"), ("über alles", "ber"), ("A_B", "a")]
    df = spark.createDataFrame(rows, "t STRING, w STRING")
    got = [r[0] for r in df.select(W.says_word(F.lower("t"), F.lower("w"))).collect()]
    assert got == [bool(re.search(r"\b" + re.escape(w) + r"\b", t, re.I)) for t, w in rows]


def test_word_shape(spark):
    assert values(spark, W.is_phrase(F.col("x")), ["AI model", "AI", "a / b c"]) == [1, 0, 1]
    assert values(spark, W.is_common_financial(F.col("x")), ["Revenue", "Foo / Growth", "Foo"]) == [1, 1, 0]


def test_quarter_inference(spark):
    files = [
        ("Operator: Welcome to the Third-Quarter call\nfirst quarter", 3), ("Intro\nOur Q2, was good", 2), ("in q2 we", None),
        ("First Half results", 2), ("second half", 4), ("Date: 2024-02-03\nnothing", 4), ("Date: 2024-05-03 10:00:00\nx", 1),
        ("Date: soon\nx", None), ("the 4th quarter", 4), ("Operator: hello\nQ1-numbers", 1), ("Q1", None),
    ]
    assert values(spark, T.infer_quarter(F.col("x")), [f[0] for f in files]) == [f[1] for f in files]


def test_patch_period_header_touches_first_only(spark):
    raw = "Symbol: A\nPeriod: Q? 2005\nbody\nPeriod: Q9 2006\n"
    assert values(spark, T.patch_period_header(F.col("x"), F.lit(4)), [raw, "none"]) == [
        "Symbol: A\nPeriod: Q4 2005\nbody\nPeriod: Q9 2006\n", "none"]


def test_file_names(spark):
    stems = ["2024Q2", "KO_2025_Q3", "BRK-B_2025_Q3", "KO_2025_Q", "x2024Q2"]
    assert values(spark, T.stem_year(F.col("x")), stems) == [2024, 2025, 0, 0, 0]
    assert values(spark, T.stem_quarter(F.col("x")), stems) == [2, 3, 0, 0, 0]
    assert values(spark, T.is_good_name(F.col("x")), ["A_2020_Q1.txt", "A_2020_Q5.txt", "a_2020_Q1.txt"]) == [True, False, False]


def test_event_dates(spark):
    e = F.col("x")
    rows = ["S-26JAN09", "S-26FEB30", "S-26XYZ11", "S", None]
    assert [str(v) for v in values(spark, periods.event_date(e), rows)] == ["2026-01-09", "None", "2026-01-11", "None", "None"]
    assert values(spark, periods.target_quarter(e), ["S-25NOV09", "S-26FEB30", "S"]) == [4, 1, 2]
    assert values(spark, periods.target_year(e), ["S-25NOV09", "S"]) == [2025, 2026]


def test_periods(spark):
    row = spark.createDataFrame([(2023, 4)], "y INT, q INT").select(
        periods.news_window_end(F.col("y"), F.col("q")).cast("string"), periods.news_window_start(F.col("y"), F.col("q")).cast("string"),
        periods.period_fallback_date(periods.period_num(F.col("y"), F.col("q"))).cast("string")).first()
    assert tuple(row) == ("2024-01-15", "2023-12-16", "2024-01-01")
    pairs = [("2024-01-02", "2024-01-03"), ("", "2024-01-03"), ("bad", None), (None, None), ("", "")]
    got = values(spark, periods.prediction_date(F.col("c"), F.col("s")).cast("string"), pairs, "c STRING, s STRING")
    assert got == ["2024-01-02", "2024-01-03", None, None, None]


def test_market_fields(spark):
    s = F.col("x")
    assert values(spark, market.company_label(s), ["KXEARNINGSMENTIONBLK", "KXMENTIONEARNAIR", "KXBRKMENTION"]) == ["BLK", "AIR", "KXBRKMENTION"]
    assert values(spark, market.series_display_label(s), ["KXMENTIONEARNAIR", "KXBRKMENTION", "FOO"]) == ["EARNAIR", "", "FOO"]
    assert values(spark, market.money(s, 1.0), ["0.0000", "", None, "x", "0.5"]) == [0.0, 1.0, 1.0, 1.0, 0.5]
    assert values(spark, market.outcome(s), ["YES", "no", None]) == [1, 0, 0]
    bands = [0.2, 0.8, 0.19, None]
    assert values(spark, market.in_uncertain_band(F.col("x")), bands, "x DOUBLE") == [True, True, False, False]
    assert values(spark, market.null_if_nan(F.col("x")), [float("nan"), 0.5, None], "x DOUBLE") == [None, 0.5, None]


def test_kelly_and_pnl(spark):
    df = spark.createDataFrame([(0.7, 0.5), (0.4, 0.5), (0.999, 0.995), (None, 0.5)], "m DOUBLE, p DOUBLE")
    e = F.col("m") - F.col("p")
    got = [r[0] for r in df.select(trading.kelly_yes(e, F.col("p"))).collect()]
    assert got[0] == pytest.approx(0.1) and got[1] == 0.0 and got[2] == pytest.approx(0.004 / 0.01 * 0.25) and got[3] is None


def verdict(spark, **kw):
    base = dict(tx=0.5, vol=100.0, prior=1, ey=0.0, en=0.0, flag="NONE", prob=0.6, price=0.6, ky=0.07, kn=0.08) | kw
    df = spark.createDataFrame([tuple(base.values())],
                               "tx DOUBLE, vol DOUBLE, prior INT, ey DOUBLE, en DOUBLE, flag STRING, prob DOUBLE, price DOUBLE, ky DOUBLE, kn DOUBLE")
    return tuple(df.select(trading.recommend(*[F.col(c) for c in base]).alias("v")).select("v.*").first())


@pytest.mark.parametrize("given, want", [
    (dict(tx=0.04), ("PASS", "NO_HISTORY", 0.0)), (dict(vol=9.0, prior=0), ("PASS", "ILLIQUID", 0.0)),
    (dict(vol=9.0, prior=1), ("PASS", "LOW_EDGE", 0.0)), (dict(ey=0.2), ("BUY_YES", "HIGH", 0.07)),
    (dict(ey=0.12), ("BUY_YES", "MEDIUM", 0.07)), (dict(ey=0.06), ("BUY_YES", "LOW", 0.07)), (dict(ey=0.05), ("PASS", "LOW_EDGE", 0.0)),
    (dict(ey=0.2, price=0.5), ("PASS", "DISAGREE_WITH_CROWD", 0.0)), (dict(ey=0.2, flag="TRENDING_NO"), ("PASS", "MOMENTUM_CONFLICT", 0.0)),
    (dict(ey=0.2, flag="SPIKE"), ("BUY_YES", "HIGH", 0.07)), (dict(en=0.2, prob=0.4, price=0.4), ("BUY_NO", "HIGH", 0.08)),
    (dict(en=0.2), ("PASS", "DISAGREE_WITH_CROWD", 0.0)), (dict(en=0.2, prob=0.4, price=0.4, flag="TRENDING_YES"), ("PASS", "MOMENTUM_CONFLICT", 0.0)),
    (dict(ey=0.2, en=0.2), ("BUY_YES", "HIGH", 0.07)),
])
def test_recommendation_rules(spark, given, want):
    assert verdict(spark, **given) == want


def test_momentum_flag(spark):
    rows = [(1, 0.11), (1, 0.21), (1, -0.21), (1, -0.15), (1, 0.10), (0, 0.5)]
    got = values(spark, trading.momentum_flag(F.col("h"), F.col("m")), rows, "h INT, m DOUBLE")
    assert got == ["TRENDING_YES", "SPIKE", "SPIKE", "TRENDING_NO", "NONE", "NONE"]


def test_separator_characters_are_white_space(spark):
    texts = ["a\x1cb c", "a\x1fb", "\x1d a \x1e", "x\x85y z\xa0w"]
    assert values(spark, T.word_count(F.col("x")), texts) == [len(t.split()) for t in texts]
    assert values(spark, T.collapse_whitespace(F.col("x")), texts) == [" ".join(t.split()) for t in texts]
    assert values(spark, T.strip_text(F.col("x")), texts) == [t.strip() for t in texts]
