import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill import schemas
from ledgermill.functions import (
    capitalise_words,
    exact_avg,
    number_or_fail,
    parse_date,
    parse_timestamp,
    valid_email_or,
    whole_or_fail,
)
from ledgermill.operators.staging import clean_staging, clean_text


def values(spark, texts, fn):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("t"))).collect()]


def test_text_is_stripped_of_any_whitespace(spark):
    got = values(spark, [" C1001 ", "C1002  ", "\t Jane\n", " x ", "  ", None, "", "NA", " NA "], clean_text)
    assert got == ["C1001", "C1002", "Jane", "x", "", None, None, None, "NA"]


def test_dates_are_tried_per_value(spark):
    texts = {
        "2022/01/15": date(2022, 1, 15),
        "15-08-2023": date(2023, 8, 15),
        "05-08-2023": date(2023, 5, 8),
        "08/15/2023": date(2023, 8, 15),
        "2023.1.5": date(2023, 1, 5),
        "20230115": date(2023, 1, 15),
        "2023-05-10 14:30:00": date(2023, 5, 10),
        "2023-05-10T14:30:00Z": date(2023, 5, 10),
        "2023-05": date(2023, 5, 1),
        "5 Mar 2021": date(2021, 3, 5),
        "March 5, 2021": date(2021, 3, 5),
        "2022-01-15 garbage": None,
        "20220115 xyz": None,
        "2022-01-15 10:30 PM": date(2022, 1, 15),
        "12/31/22": date(2022, 12, 31),
        "31-12-68": date(2068, 12, 31),
        "12/31/69": date(1969, 12, 31),
        "2023-02-30": None,
        "31-31-2023": None,
        "tomorrow": None,
        "": None,
    }
    assert values(spark, list(texts), parse_date) == list(texts.values())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Ho_Chi_Minh"])
def test_timestamps_drop_the_fraction_in_any_session_zone(spark, zone):
    texts = {
        "2023-05-10 14:30:00.123456": datetime(2023, 5, 10, 14, 30),
        "2023-03-12 02:30:00.999": datetime(2023, 3, 12, 2, 30),
        "2023/05/10T4:05": datetime(2023, 5, 10, 4, 5),
        "15-08-2023 23:59:59": datetime(2023, 8, 15, 23, 59, 59),
        "2023-05-10": datetime(2023, 5, 10),
        "2022-01-15 10:30 PM": datetime(2022, 1, 15, 22, 30),
        "2022-01-15 12:05:09 am": datetime(2022, 1, 15, 0, 5, 9),
        "2022-01-15 13:30 PM": None,
        "2022-01-15 10:30 garbage": None,
        "12/31/22 1:02": datetime(2022, 12, 31, 1, 2),
        "2023-05-10 25:00:00": None,
        "noon": None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert values(spark, list(texts), parse_timestamp) == list(texts.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_words_start_after_any_non_alphanumeric(spark):
    got = values(spark, ["o'brien", "MARY-jane  smith", "élodie d'été", "3rd st", None], capitalise_words)
    assert got == ["O'Brien", "Mary-Jane  Smith", "Élodie D'Été", "3rd St", None]


def test_email_rule(spark):
    got = values(spark, [" A.B@Bank.Example ", "a@b.c", "a@b.com\n", "no", None], lambda c: valid_email_or(c, "bad"))
    assert got == ["a.b@bank.example", "bad", "bad", "bad", "bad"]


def test_numbers_round_half_up_and_bad_text_fails(spark):
    kind = T.DecimalType(15, 2)
    good = values(spark, ["1.005", "1e3", " 2 ", "-0.005", None], lambda c: number_or_fail(c, kind, "amount"))
    assert good == [Decimal("1.01"), Decimal("1000.00"), Decimal("2.00"), Decimal("-0.01"), None]
    for bad in ("ten", "99999999999999999"):
        with pytest.raises(Exception, match="amount: cannot load"):
            values(spark, [bad], lambda c: number_or_fail(c, kind, "amount"))
    assert values(spark, ["700", "700.0", None], lambda c: whole_or_fail(c, "score")) == [700, 700, None]
    with pytest.raises(Exception, match="score: cannot load"):
        values(spark, ["700.5"], lambda c: whole_or_fail(c, "score"))


def test_average_is_rounded_once(spark):
    rows = spark.sql("select cast(x as decimal(15,2)) as x from values (0.01), (0.02) t(x)")
    assert rows.agg(exact_avg(F.col("x"))).first()[0] == Decimal("0.02")


def test_over_long_text_fails_the_batch(spark):
    raw = spark.createDataFrame([("B" * 51, "n", "m")], "branch_id string, branch_name string, manager_name string")
    with pytest.raises(Exception, match="branch_id: text longer than 50"):
        clean_staging(raw, "branches").collect()
    assert clean_staging(raw, "branches", check_width=False).count() == 1


def test_typing_transactions_stays_short_enough_for_the_jvm_to_compile(spark):
    """A method beyond 8,000 bytes is never compiled, so each value would be parsed by the JVM's interpreter."""
    raw = spark.createDataFrame([("T1", "A1", "M1", "1.00", "1996-09-13T00:00:00.000")], schemas.raw_schema("transactions"))
    typed = clean_staging(raw, "transactions")
    code = typed._sc._jvm.PythonSQLUtils.explainString(typed._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
    assert typed.first().transaction_date == datetime(1996, 9, 13)
