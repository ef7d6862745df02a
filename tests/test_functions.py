"""Column functions on the awkward values they exist for."""

import math

import pytest
from pyspark.sql import functions as F

from claimweft.functions import amounts, codes, dates, flags, text


def col_values(spark, values, dtype, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_zip3_keeps_leading_zeros(spark):
    got = col_values(spark, ["02139", "2139.0", "30301-1234", None], "string", text.zip3)
    assert got == ["021", "021", "303", None]


def test_strip_non_word_keeps_accents(spark):
    assert col_values(spark, ["Café-Net #1_x"], "string", text.strip_non_word) == ["CaféNet1_x"]


def test_lenient_dates(spark):
    raw = ["0", "", "garbage", "2024-02-29", "1/5/2024", "2024-01-05 10:00:00", None, "2023-02-29"]
    got = col_values(spark, raw, "string", lambda c: dates.lenient_date(c).cast("string"))
    assert got == [None, None, None, "2024-02-29", "2024-01-05", "2024-01-05", None, None]


def test_age_counts_month_ends(spark):
    rows = [("2025-02-28", "1960-02-29"), ("2025-02-27", "1960-02-29"), ("2025-06-15", "1960-06-16"), ("2025-06-16", "1960-06-16")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r.o for r in df.select(dates.age_years(F.to_date("a"), F.to_date("b")).alias("o")).collect()]
    assert got == [65, 64, 64, 65]


def test_unknown_birth_date_counts_as_young(spark):
    df = spark.createDataFrame([("2025-01-01", None)], "a string, b string")
    assert df.filter(dates.under_age(F.to_date("a"), F.to_date("b"))).count() == 1


def test_age_buckets_are_right_closed(spark):
    got = col_values(spark, [-5, 30, 31, 90, 91, 180, 181, 365, 366, None], "int", amounts.age_bucket)
    assert got == ["0-30", "0-30", "31-90", "31-90", "91-180", "91-180", "181-365", "181-365", "365+", None]


def test_clip_and_flags_on_null_and_negative(spark):
    assert col_values(spark, [-1.0, 2.0, None], "double", amounts.clip_low) == [0.0, 2.0, None]
    assert col_values(spark, [-1.0, 2.0, None], "double", amounts.positive_flag) == [0, 1, 0]
    assert col_values(spark, [-1.0, 0.0, None], "double", amounts.log_amount) == [0.0, 0.0, None]


def test_infinite_and_missing(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (3.0, 2.0)], "a double, b double")
    raw = amounts.raw_ratio(F.col("a"), F.col("b"))
    got = [r.o for r in df.select(amounts.clean_infinite(raw).alias("o")).collect()]
    assert got == [1.0, 1.0, 0.0, 0.0, 1.5]
    safe = [r.o for r in df.select(amounts.savings_rate(F.col("a"), F.col("b")).alias("o")).collect()]
    assert safe == [0.0, 0.0, 0.0, 0.0, 1.5]


def test_round_even_follows_array_libraries(spark):
    np = pytest.importorskip("numpy")
    values = [0.575, 0.125, 0.135, 0.425, 2.675, 1 / 3, 0.005]
    got = col_values(spark, values, "double", lambda c: amounts.round_even(c, 2))
    assert got == [float(np.round(v, 2)) for v in values]


def test_codes_fall_back_to_text(spark):
    book = codes.CODE_BOOKS["MAR"]
    got = col_values(spark, ["1", "5", "9", "x", None], "string", lambda c: codes.label_code(c, book))
    assert got == ["Married", "Never married", "9", "x", None]


def test_indicator_first_match_and_null(spark):
    rule = flags.INDICATOR_RULES["bmp"]
    values = ["BMP=EN;BMP=E;", "ADJ=Y;BMP=EN;", "", None]
    assert col_values(spark, values, "string", lambda c: flags.first_match(c, rule)) == ["E", "EN", "NA", "NA"]
    compat = col_values(spark, values, "string", lambda c: flags.first_match(c, rule, strict_compat=True))
    assert compat == ["E", "EN", "NA", "E"]


def test_conditional_overwrite(spark):
    df = spark.createDataFrame([("NetEXT", "DIP"), ("Next", None), ("Prim", "DIS"), (None, "D")], "n string, p string")
    got = [r.o for r in df.select(flags.overwrite_where_contains(F.col("n"), "Ext", F.col("p")).alias("o")).collect()]
    assert got == ["DIP", "Next", "Prim", None]


def test_paid_and_text_flags(spark):
    assert col_values(spark, ["paid", "PAID", "UNPAID", None], "string", text.paid_flag) == [1, 1, 0, 0]
    assert col_values(spark, [" yes ", "No", None], "string", lambda c: text.is_text(c, "YES")) == [1, 0, 0]


def test_null_tokens_and_numbers(spark):
    assert col_values(spark, ["NA", "nan", "", "x", None], "string", text.null_tokens) == [None, None, None, "x", None]
    assert col_values(spark, [" ", "12.5", "1e3", "abc"], "string", text.to_number) == [None, 12.5, 1000.0, None]


def test_differs_keeps_null(spark):
    df = spark.createDataFrame([("TEST",), ("LEE",), (None,)], "v string")
    assert df.filter(text.differs_or_null(F.col("v"), "TEST")).count() == 2
    assert df.filter(text.null_or_not_like(F.col("v"), "%TEST%")).count() == 2


def test_nan_is_not_lost(spark):
    assert math.isnan(col_values(spark, [float("nan")], "double", amounts.clip_low)[0])


def test_more_spellings_of_dates(spark):
    raw = ["2024-01-05 00:00:00.000", "2024-01-05 10:11:12.5", "2024-01-05 10:11", "2024-01-05T10:11:12Z", "05-JAN-24", "1/5/2024 10:11:12",
           "1/5/2024 3:04 PM", "2024/01/05", "Jan 5, 2024", "2024-01-05T10:11:12+02:00", "20240105"]
    bad = ["2024-01-05 25:00", "2024-13-05", "1/5", "yesterday", "2024-01-05 10"]
    df = spark.createDataFrame([(t,) for t in raw + bad + ["0", "", None]], "d string")
    got = [r[0] for r in df.select(dates.lenient_date(F.col("d")).cast("string")).collect()]
    assert got == ["2024-01-05"] * len(raw) + [None] * (len(bad) + 3)
    assert [tuple(r) for r in dates.unparsed_dates(df, ["d"]).collect()] == [("d", len(bad))]


def test_codes_that_are_not_whole(spark):
    from claimweft.functions.codes import CODE_BOOKS, label_code

    df = spark.createDataFrame([("1",), ("2.0",), ("2.5",), ("NaN",), ("x",), (None,), ("7",)], "v string")
    got = [r[0] for r in df.select(label_code(F.col("v"), CODE_BOOKS["SEX"])).collect()]
    assert got == ["Male", "Female", "2.5", None, "x", None, "7"]
    got = [r[0] for r in df.select(label_code(F.col("v").try_cast("double"), CODE_BOOKS["SEX"])).collect()]
    assert got == ["Male", "Female", "2.5", None, None, None, "7.0"]


def test_status_codes_in_any_spelling(spark):
    from claimweft.functions.text import has_code

    df = spark.createDataFrame([("2004.0",), (" 2004 ",), ("2004",), ("A",), ("2005",), (None,), ("2004x",)], "v string")
    assert [r[0] for r in df.select(has_code(F.col("v"), 0, 2004)).collect()] == [True, True, True, False, False, None, False]
    assert [r[0] for r in df.select(has_code(F.col("v"), "A", "N")).collect()] == [False, False, False, True, False, None, False]
    assert [r[0] for r in spark.range(2).select(has_code(F.col("id"), 1)).collect()] == [False, True]


def test_chi_square_tail(spark):
    from claimweft.functions.stats import chi_square_log_p

    # ln p from erfc (1 degree), the exponential (2 degrees) and the Poisson sum (even degrees)
    def poisson(x, k):
        logs = [i * math.log(x / 2) - math.lgamma(i + 1) - x / 2 for i in range(k // 2)]
        top = max(logs)
        return top + math.log(sum(math.exp(v - top) for v in logs))

    cases = [(100.0, 1, math.log(math.erfc(math.sqrt(50)))), (0.01, 1, math.log(math.erfc(math.sqrt(0.005)))), (900.0, 2, -450.0)]
    cases += [(x, k, poisson(x, k)) for x, k in ((3.0, 4), (30.0, 10), (30000.0, 20000), (20100.0, 20000), (19900.0, 20000), (5000.0, 200))]
    df = spark.createDataFrame([c[:2] for c in cases], "x double, k long")
    got = [r[0] for r in df.select(chi_square_log_p(F.col("x"), F.col("k"))).collect()]
    assert got == pytest.approx([c[2] for c in cases], rel=1e-7, abs=1e-9)
