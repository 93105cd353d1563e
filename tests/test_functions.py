import datetime

import pytest
from pyspark.sql import functions as F

from helpers import column
from salesprep.functions import months, numbers, text
from salesprep.markets import PROFILES, WindowRule, profile
from salesprep.session import MIB, settings_for

DAY = datetime.date


def test_split_stops_at_the_first_underscore(spark):
    codes = ["D_1", "D_A_B", "D", "D_", "_x", "", None]
    assert column(spark, text.distributor_part, codes) == ["D", "D", "D", "D", "", "", None]
    assert column(spark, text.outlet_part, codes) == ["1", "A_B", "", "", "x", "", ""]
    assert column(spark, text.outlet_key, ["D_A>B>C", "D>E_F"]) == ["A_B_C", "F"]


def test_compose_spells_missing_parts(spark):
    assert column(spark, lambda x: text.compose_code(x, F.lit("7")), ["P", None, ""]) == ["P_7", "NA_7", "_7"]


def test_trims_differ(spark):
    padded = [" \t a b\r\n", None]
    assert column(spark, text.trim_spaces, padded) == ["\t a b\r\n", None]
    assert column(spark, text.trim_whitespace, padded) == ["a b", None]


def test_null_is_kept_by_negated_text_tests(spark):
    values = ["Based on", "based on", None]
    assert column(spark, lambda x: text.lacks_text(x, "Based on"), values) == [False, True, True]
    assert column(spark, lambda x: text.lacks_match(x, "ZOOM|ADJ"), ["aADJ", "adj", None]) == [False, True, True]
    assert column(spark, lambda x: text.one_of(x, ["a"]), ["a", "b", None]) == [True, False, False]


def test_mapping_override_fallback(spark):
    assert column(spark, lambda x: text.map_values(x, {"a": "1", "1": "2"}), ["a", "1", "b", None]) == ["1", "2", "b", None]
    by_code = {"a": "X"}
    assert column(spark, lambda x: text.override_by_code(F.lit("old"), x, by_code), ["a", "b", None]) == ["X", "old", "old"]
    assert column(spark, lambda x: text.sentinel_fallback(x, F.lit("f"), "NA"), ["NA", "na", None]) == ["f", "na", None]


def test_recode_strip_sanitize(spark):
    assert column(spark, lambda x: text.recode(x, "341", "161"), ["0341341", None]) == ["0161161", None]
    assert column(spark, lambda x: text.recode(x, "341", "161"), [3410], "bigint") == ["1610"]
    assert column(spark, lambda x: text.strip_token(x, "SF"), ["SFaSF", "sf"]) == ["a", "sf"]
    assert column(spark, text.sanitize, ["A_B-C D/é", None]) == ["A_B_C_D__", None]


def test_fill_category_needs_value(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 0.0), (None, None), ("c", 1.0)], "c string, v double")
    filled = [r[0] for r in rows.select(text.fill_category(F.col("c"), F.col("v"), "Others")).collect()]
    assert filled == ["Others", None, None, "c"]


def test_parse_number(spark):
    values = ["1,234,567.5", "abc", "", None, "-3"]
    assert column(spark, numbers.parse_number, values) == [1234567.5, None, None, None, -3.0]


def test_month_to_date(spark):
    assert column(spark, months.month_to_date, ["2020/02", "2020/13", "x", None]) == [DAY(2020, 2, 1), None, None, None]


def test_snapshot_tag_at_month_end(spark):
    days = [DAY(2020, 2, 29), DAY(2020, 2, 28), DAY(2021, 2, 28), DAY(2020, 12, 31), DAY(2020, 3, 15)]
    assert column(spark, months.snapshot_tag, days, "date") == ["20200301", "20200228", "20210301", "20210101", "20200315"]
    assert column(spark, months.is_month_end, days, "date") == [True, False, True, True, False]


@pytest.mark.parametrize(
    "rule, day, start, end",
    [
        (WindowRule(first_month="201701", open_at_month_end=True), DAY(2020, 2, 29), "201701", "202002"),
        (WindowRule(first_month="201701", open_at_month_end=True), DAY(2020, 2, 28), "201701", "202001"),
        (WindowRule(months_back=38, open_at_month_end=True), DAY(2020, 3, 31), "201701", "202003"),
        (WindowRule(months_back=36), DAY(2020, 3, 31), "201703", "202002"),
        (WindowRule(months_back=25), DAY(2020, 3, 15), "201802", "202002"),
    ],
)
def test_windows(spark, rule, day, start, end):
    assert column(spark, lambda x: months.window_start(x, rule), [day], "date") == [start]
    assert column(spark, lambda x: months.window_end(x, rule), [day], "date") == [end]


def test_month_sequence_is_empty_when_the_start_is_later(spark):
    make = lambda x: months.month_sequence(x, F.lit("202002"))
    assert column(spark, make, ["202003", "202002", None]) == [[], ["2020/02"], None]


def test_suffixes_of_literals_are_no_numbers(spark):
    values = ["5d", "5f", "5D ", "1.F", "5", "1e3", "NaN", "Infinity", "d"]
    found = column(spark, numbers.parse_number, values)
    assert found[:6] == [None, None, None, None, 5.0, 1000.0] and found[6] != found[6] and found[7:] == [float("inf"), None]


def test_month_sequence_includes_both_ends(spark):
    make = lambda x: months.month_sequence(x, F.lit("202002"))
    assert column(spark, make, ["201911", "202002"]) == [["2019/11", "2019/12", "2020/01", "2020/02"], ["2020/02"]]


def test_in_months_wants_a_month(spark):
    make = lambda x: months.in_months(x, F.lit("202001"), F.lit("202003"))
    values = ["2019/12", "2020/01", "2020/03", "2020/04", "2020/02x", "2020/1", None]
    assert column(spark, make, values) == [False, True, True, False, False, False, None]


def test_profiles():
    assert {name: p.focus_months for name, p in PROFILES.items() if p.focus_months} == {
        "INDIA_HEALTH": 6,
        "PAK_HEALTH": 6,
        "MY_HEALTH": 5,
    }
    assert [name for name, p in PROFILES.items() if p.active_months] == ["PAKISTAN_HOME"]
    assert {name for name, p in PROFILES.items() if p.route_stores} == {"INDO_HOME", "INDO_HEALTH"}
    with pytest.raises(ValueError):
        profile("ELSEWHERE")


def test_session_settings():
    small, large = settings_for(10 * MIB, 8), settings_for(100 * MIB**2, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert large["spark.sql.shuffle.partitions"] == "204800"
