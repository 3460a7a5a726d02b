import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyward.fixed_values import MISSING_TOKENS
from tallyward.functions.dates import parse_date
from tallyward.functions.numbers import (
    blank_to_null,
    drop_check_digit,
    municipality_code,
    no_check_digit_to_drop,
    not_an_int,
    strict_int,
)
from tallyward.functions.text import clean_text, leading_code, missing_to_null, strip


def apply(spark, function, inputs, kind="string"):
    rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, c {kind}")
    return [r.o for r in rows.select("i", function(F.col("c")).alias("o")).orderBy("i").collect()]


def test_clean_text(spark):
    cases = {
        "a": "A", None: "DESCONHECIDO", " NaN ": "DESCONHECIDO", "None": "DESCONHECIDO",
        "": "DESCONHECIDO", "{ñ class}": "DESCONHECIDO", "\xa0x\t": "X", "ß": "SS",
        " 　São  ": "SÃO", "a  b": "A  B", "\x1f": "DESCONHECIDO", "nana": "NANA",
    }
    assert apply(spark, clean_text, cases) == list(cases.values())
    again = apply(spark, lambda c: clean_text(clean_text(c)), cases)
    assert again == list(cases.values())


def test_strip_agrees_with_python(spark):
    texts = [f"{chr(i)} a{chr(i)}b{chr(i)}" for i in range(0x3100) if chr(i).isprintable() or chr(i).isspace()]
    assert apply(spark, strip, texts) == [t.strip() for t in texts]


def test_missing_tokens(spark):
    assert apply(spark, missing_to_null, MISSING_TOKENS) == [None] * len(MISSING_TOKENS)
    assert apply(spark, missing_to_null, ["none", " ", "NULLS", None]) == ["none", " ", "NULLS", None]


def test_parse_date(spark):
    day = dt.date(2025, 2, 1)
    cases = {
        "01/02/2025": day, "1/2/2025": day, "31/02/2025": None, "2025/02": day, "2025/02/01": day,
        "2025-2-1": day, "{ñ class}": None, "x": None, "": None, None: None, "01/13/2025": None,
        "01/02/25": None, " 01/02/2025\xa0": day, "01/02/2025 10:00": None, "29/02/2024": dt.date(2024, 2, 29),
        "29/02/2023": None, "001/02/2025": None, "01/02/02025": None,
    }
    assert apply(spark, parse_date, cases) == list(cases.values())
    short = apply(spark, lambda c: parse_date(c, ["d/M/yyyy", "d/M/yy"]), ["01/02/25", "1/2/2025"])
    assert short == [day, day]


def test_codes(spark):
    heads = {"355030-São Paulo": "355030", "-x": "", "3550": "3550", "{Ñ CLASS}": "{Ñ CLASS}", " 1 -2-3": "1"}
    assert apply(spark, leading_code, heads) == list(heads.values())
    codes = {"355030-são paulo": 355030, None: 0, " nan ": 0, "-x": None, "12a-b": None, "7": 7}
    assert apply(spark, municipality_code, codes) == list(codes.values())


def test_strict_int(spark):
    cases = {
        " 7 ": 7, "+7": 7, "-7": -7, "12a": None, "": None, "12.0": None, "1_0": None, None: None,
        "2147483647": 2147483647, "2147483648": None, "1e3": None, "\xa05\t": 5, "0012": 12, "--1": None,
    }
    assert apply(spark, strict_int, cases) == list(cases.values())
    bad = [text is not None and value is None for text, value in cases.items()]
    assert apply(spark, not_an_int, cases) == bad


def test_blank_numeric(spark):
    assert apply(spark, blank_to_null, ["", "NAN", "NONE", "7", "nan", None]) == [
        None, None, None, "7", "nan", None,
    ]


@pytest.mark.parametrize("kind", ["int", "long"])
def test_drop_check_digit(spark, kind):
    cases = {3550308: 355030, 99: 9, 10: 1, 9: None, 0: None, None: None, -70: -7, -7: None}
    assert apply(spark, drop_check_digit, cases, kind) == list(cases.values())
    unusable = apply(spark, no_check_digit_to_drop, cases, kind)
    assert unusable == [c is None or -10 < c < 0 for c in cases]
