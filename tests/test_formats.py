import pytest
from frames import table

from fairlead.functions.formats import percentage, usd_billions, usd_millions, whole_number

CASES = [
    (12_345_678_901.0, "12,35 bi US$", "12.345,68 mi US$"),
    (1_234_567_890_123.0, "1.234,57 bi US$", "1.234.567,89 mi US$"),
    (-5_000_000.0, "-0,01 bi US$", "-5,00 mi US$"),
    (125_000_000.0, "0,12 bi US$", "125,00 mi US$"),
    (0.0, "0,00 bi US$", "0,00 mi US$"),
    (None, "—", "—"),
]


def test_money_texts(spark):
    df = table(spark, "v double, a string, b string", *CASES)
    for row in df.selectExpr("*", f"{usd_billions('v')} AS x", f"{usd_millions('v')} AS y").collect():
        assert (row.x, row.y) == (row.a, row.b)


@pytest.mark.parametrize(
    "fraction, decimals, text",
    [(0.1234, 1, "12,3%"), (12.5, 1, "1250,0%"), (0.5, 0, "50%"), (0.12345, 2, "12,35%"), (None, 1, "—")],
)
def test_percentages(spark, fraction, decimals, text):
    df = table(spark, "v double", (fraction,))
    assert df.selectExpr(percentage("v", decimals)).first()[0] == text


def test_whole_numbers(spark):
    assert table(spark, "v bigint", (17657810,)).selectExpr(whole_number("v")).first()[0] == "17.657.810"
