"""Truth tables for the category mappers (cases from the source system's tests and rules)."""

import datetime as dt

import pytest

from stakeflow.functions import mappers as M


def _map(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn("v")).collect()]


@pytest.mark.parametrize("raw,expected", [
    ("Live Roulette", "live_dealer"), ("live poker", "live_dealer"), ("Baccarat", "live_dealer"),
    ("sic bo", "live_dealer"), ("Teen Patti", "live_dealer"), ("starburst slot", "slot"),
    ("Reel Fruit", "slot"), ("Table Poker", "table"), ("aviator", "crash"), ("cricket crash", "crash"),
    ("instant keno", "instant_win"), ("mystery", "unknown"), (None, "unknown"), ("", "unknown"),
])
def test_game_type(spark, raw, expected):
    assert _map(spark, M.map_game_type, [raw]) == [expected]


@pytest.mark.parametrize("raw,expected", [
    ("Evolution Gaming", "Evolution"), ("EvoSW", "Evolution"), ("revolver", "Evolution"),
    ("ezugi", "EZUGI"), ("Spribe", "Spribe"), ("OnlyPlay", "OnlyPlay"), ("hub88", "HUB88"),
    ("Peter & Sons", "PeterAndSons"), ("peterandsons", "PeterAndSons"),
    ("aaaaaaaaaaaaaaaaaaaaaaaa", "unknown"), ("0123456789abcdef01234567", "unknown"),
    (None, "unknown"), ("nan", "unknown"), ("  Pragmatic  ", "Pragmatic"),
])
def test_provider(spark, raw, expected):
    assert _map(spark, M.map_provider, [raw]) == [expected]


@pytest.mark.parametrize("raw,expected", [
    ("Android", "mobile"), ("android tablet", "mobile"), ("iOS", "mobile"), ("Windows", "desktop"),
    ("web", "desktop"), ("tablet", "tablet"), ("xyz", "unknown"), (None, "unknown"),
])
def test_device(spark, raw, expected):
    assert _map(spark, M.map_device_type, [raw]) == [expected]


@pytest.mark.parametrize("raw,expected", [
    ("livecasino", "livecasino"), ("Live Casino", "livecasino"), ("sports book", "sportsbook"),
    ("Home", "direct"), ("direct", "direct"), ("lobby", "lobby"), ("casino", "casino"),
    ("promo page", "promo_page"), ("search", "search"), (None, "unknown"), ("null", "unknown"),
])
def test_entry_point(spark, raw, expected):
    assert _map(spark, M.map_entry_point, [raw]) == [expected]


@pytest.mark.parametrize("raw,expected", [
    ("WIN", "net_positive"), ("win", "net_positive"), ("LOSS", "net_negative"), ("lose", "net_negative"),
    (" WIN", "break_even"), ("DRAW", "break_even"), (None, "break_even"),
])
def test_outcome(spark, raw, expected):
    assert _map(spark, M.map_outcome, [raw]) == [expected]


def test_time_of_day_and_weekday(spark):
    rows = [(dt.datetime(2024, 1, 1, h),) for h in (0, 5, 6, 11, 12, 17, 18, 21, 22)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r[0] for r in df.select(M.map_time_of_day("ts")).collect()]
    assert got == ["late_night", "late_night", "morning", "morning", "afternoon", "afternoon",
                   "evening", "evening", "late_night"]
    assert df.select(M.map_day_of_week("ts")).first()[0] == "monday"


def test_exit_type_and_ids(spark):
    df = spark.createDataFrame([(0.0, True), (10.0, True), (100.0, True), (100.0, False)],
                               "d double, r boolean")
    got = [r[0] for r in df.select(M.exit_type("d", "r")).collect()]
    assert got == ["unknown", "quick_exit", "returned_quickly", "natural_end"]
    ids = spark.createDataFrame([("12.0",), (" nan ",), ("NULL",), ("x",)], "v string")
    assert [r[0] for r in ids.select(M.id_before_dot("v")).collect()] == ["12", "nan", "NULL", "x"]
    assert [r[0] for r in ids.select(M.is_null_like("v")).collect()] == [False, True, True, False]
    slug = spark.createDataFrame([("  Crazy Time!! 2 ",)], "v string").select(M.game_slug("v")).first()[0]
    assert slug == "game_crazy_time_2"


def test_first_element_fields(spark):
    schema = "p array<struct<sportName:string,categoryName:string,tournamentName:string,tournamentId:string>>"
    df = spark.createDataFrame([([("a", "b", "c", "d")],), ([],), (None,), ([(None, "x", None, None)],)], schema)
    got = df.select(*M.first_element_fields("p", ["sportName", "categoryName"])).collect()
    assert [tuple(r) for r in got] == [("a", "b"), (None, None), (None, None), (None, "x")]


def test_tokens_skip_nulls(spark):
    df = spark.createDataFrame([("a", None)], "game_type string, provider string")
    assert df.select(M.tokens(["game_type", "provider"])).first()[0] == ["game_type:a"]


def test_token_label(spark):
    df = spark.createDataFrame([("preferred_device:mobile",), ("provider:" + "x" * 40,)], "t string")
    got = [r[0] for r in df.select(M.token_label("t")).collect()]
    assert got[0] == "device=mobile"
    assert len(got[1]) == 38 and got[1].endswith("...")
