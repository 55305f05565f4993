"""Known rows and boundary rows of the column functions and scoring rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import dates, fixed_values as V, numbers, text
from tidemark.operators import cdc, projections, scoring


def rows(spark, values, schema):
    return spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def vector(spark, column):
    return value(spark, column)


def test_order_line_scores(spark):
    created = F.lit(1745447489000)
    assert value(spark, dates.pay_time_slot(created)) == "早晨"
    line = spark.range(1).select(
        F.lit("早晨").alias("pay_time_slot"), F.lit("21195.0").alias("total_amount"),
        F.lit("苹果").alias("tname"), F.lit("手机").alias("b1_name"),
    )
    got = scoring.add_order_scores(line).first()
    take = lambda p: [got[c] for c in scoring.score_columns(p)]
    assert take("pay_time") == [0.01, 0.01, 0.01, 0.01, 0.02, 0.03]
    assert take("amount") == [0.015, 0.03, 0.045, 0.06, 0.075, 0.09]
    assert take("tname") == [0.18, 0.16, 0.14, 0.14, 0.14, 0.1]
    assert take("b1name") == [0.27, 0.24, 0.18, 0.12, 0.06, 0.03]


def test_page_scores(spark):
    page = spark.range(1).select(F.lit("Android,iOS").alias("os"), F.lit(None).cast("string").alias("searchCategory"))
    got = scoring.add_page_scores(page).first()
    assert got["judge_os"] == "iOS"
    assert [got[c] for c in scoring.score_columns("device")] == [0.07, 0.06, 0.05, 0.04, 0.03, 0.02]
    assert [got[c] for c in scoring.score_columns("search")] == [0] * 6


def test_unknown_device_has_no_score(spark):
    page = spark.range(1).select(F.lit("Symbian").alias("os"), F.lit("性价比").alias("searchCategory"))
    got = scoring.add_page_scores(page).first()
    assert [got[c] for c in scoring.score_columns("device")] == [None] * 6
    assert got["search_50"] == 0.12


@pytest.mark.parametrize("birthday,sign,decade,age", [
    ("1979-07-06", "巨蟹座", 1970, 45), ("2005-08-12", "狮子座", 2000, 19), ("1997-09-06", "处女座", 1990, 27),
])
def test_profile(spark, birthday, sign, decade, age):
    born, day = F.lit(birthday).cast("date"), F.lit("2025-05-12").cast("date")
    assert value(spark, dates.zodiac_sign(born)) == sign
    assert value(spark, dates.decade(born)) == decade
    assert value(spark, dates.age_on(born, day)) == age


def test_age_of_leap_day_and_birthday(spark):
    age = lambda b, d: value(spark, dates.age_on(F.lit(b).cast("date"), F.lit(d).cast("date")))
    assert age("2004-02-29", "2005-02-28") == 0
    assert age("2004-02-29", "2005-03-01") == 1
    assert age("2000-05-12", "2025-05-12") == 25
    assert age("2000-05-13", "2025-05-12") == 24


def test_every_zodiac_edge(spark):
    edges = []
    for i, (last, name) in enumerate(V.ZODIAC):
        after = V.ZODIAC[i + 1][1] if i + 1 < len(V.ZODIAC) else V.LAST_ZODIAC
        day = dt.date(2001, last // 100, last % 100)
        edges += [(day, name), (day + dt.timedelta(days=1), after)]
    df = spark.createDataFrame(edges, "born DATE, sign STRING")
    assert df.filter(dates.zodiac_sign(F.col("born")) != F.col("sign")).count() == 0


def test_epoch_day(spark):
    assert value(spark, dates.epoch_day_to_date(F.lit(265))) == dt.date(1970, 9, 23)


def test_pay_time_slot_hours(spark):
    hours = spark.range(24).select(dates.pay_time_slot(F.col("id") * dates.HOUR_MS - 8 * dates.HOUR_MS).alias("s"), "id")
    got = [r["s"] for r in hours.orderBy("id").collect()]
    assert got == ["凌晨"] * 6 + ["早晨"] * 3 + ["上午"] * 3 + ["中午"] * 2 + ["下午"] * 4 + ["晚上"] * 4 + ["夜间"] * 2


@pytest.mark.parametrize("amount,first", [
    ("999.99", 0.12), ("1000", 0.015), ("1000.01", 0.03), ("3999.99", 0.03), ("4000", 0.015),
    ("-5", 0.12), (None, 0.12), ("junk", 0.12),
])
def test_amount_tiers(spark, amount, first):
    assert value(spark, scoring.amount_vector(F.lit(amount).cast("string"))[0]) == first


@pytest.mark.parametrize("amount,first", [
    ("0", 0.12), ("1000", 0.12), ("1000.01", 0.03), ("4000", 0.03), ("4000.01", 0.015), ("-1", 0.015),
])
def test_order_price_tiers(spark, amount, first):
    assert value(spark, scoring.order_price_vector(F.lit(amount))[0]) == first


def test_brand_and_category_defaults(spark):
    assert value(spark, scoring.brand_vector(F.lit("其他"))[5]) == 0.12
    assert value(spark, scoring.brand_vector(F.lit(""))) is None
    assert value(spark, scoring.brand_vector(F.lit(None).cast("string"))) is None
    assert value(spark, scoring.category_vector(F.lit("其他"))[5]) == 0.27


def test_first_bucket_wins_ties_and_every_bucket_can_win(spark):
    tie = [F.lit(0.5)] * 6
    assert value(spark, scoring.first_largest(V.BUCKETS, tie)) == "18_24"
    for i, bucket in enumerate(V.BUCKETS):
        scores = [F.lit(1.0 if j >= i else 0.1) for j in range(6)]
        assert value(spark, scoring.first_largest(V.BUCKETS, scores)) == bucket


def test_numbers(spark):
    assert value(spark, numbers.round3(F.lit(0.0525))) == 0.053
    convert = lambda v, ether=False: value(
        spark, numbers.hex_or_decimal_to_text(F.lit(v).cast("string"), ether)
    )
    assert convert("0x" + "f" * 64) == str(2**256 - 1)
    assert convert("12.50") == "12.50"
    assert convert(None) == "0"
    assert convert("1500000000000000000", True) == "1.5"
    assert convert("0xde0b6b3a7640000", True) == "1"
    assert convert("1", True) == "0.000000000000000001"
    assert convert("0", True) == "0"


def test_text(spark):
    assert value(spark, text.upper_first(F.lit("fooBar baz"))) == "FooBar baz"
    assert value(spark, text.lower_first(F.lit("FooBar"))) == "fooBar"
    assert value(spark, text.upper_first(F.lit(""))) == ""
    assert value(spark, text.is_blank(F.lit("\t\x01 \n"))) is True
    assert value(spark, text.is_blank(F.lit(" "))) is False
    assert value(spark, text.is_allowed_text(F.lit("中文abc-1"))) is True
    assert value(spark, text.is_allowed_text(F.lit("a b"))) is False
    assert value(spark, text.hash_bucket(F.lit("abc"))) == "%04d" % (int("900150983cd24fb0d6963f7d28e17f72"[-3:], 16) % 128)
    assert value(spark, text.hot_key_bucket(F.lit("0xDAC17F958D2EE523A2206206994597C13D831EC7"))) == "9002"
    assert value(spark, text.join_list(F.array(F.lit("a"), F.lit(None)), "|")) == "a|null"
    assert value(spark, text.join_list(F.lit(None).cast("array<string>"))) is None
    assert text.camel_name("BASE_CATEGORY_NAME") == "baseCategoryName"


def test_hex_words(spark):
    words = lambda d: value(spark, text.hex_words(F.lit(d)))
    assert words("0x") == []
    assert words("") == []
    assert words("0x" + "a" * 63) == []
    assert words("0x" + "a" * 64 + "b" * 64 + "c") == ["0x" + "a" * 64, "0x" + "b" * 64]


def test_json_list(spark):
    assert value(spark, text.append_to_json_list(F.lit('["a"]'), F.lit("b"))) == '["a","b"]'
    assert value(spark, text.append_to_json_list(F.lit(None).cast("string"), F.lit("b"))) == '["b"]'


def test_day_partitions(spark):
    days = lambda a, b: value(spark, dates.day_partitions(F.lit(a).cast("date"), F.lit(b).cast("date")))
    assert days("2024-02-28", "2024-03-01") == [20240228, 20240229, 20240301]
    assert days("2024-03-01", "2024-03-01") == [20240301]
    assert days("2024-03-02", "2024-03-01") == []


def test_event_times(spark):
    assert value(spark, dates.event_millis(F.lit("x"), F.lit(5))) == 5
    assert value(spark, dates.event_millis(F.lit(None).cast("string"))) == 0
    seconds = dates.block_event_timestamp(F.lit(None).cast("bigint"), F.lit(10).cast("bigint"))
    assert value(spark, F.unix_millis(seconds)) == 10_000
    records = F.array(F.struct(F.lit(7).cast("bigint").alias("window_start_time")))
    assert value(spark, F.unix_millis(dates.first_window_timestamp(records))) == 7


def test_page_projection(spark):
    lines = [
        '{"common":{"uid":"7","os":"iOS 13.3.1","sid":"s","mid":"m","is_new":"1","ch":"web"},'
        '"page":{"item":"shoe","item_type":"keyword"},"ts":5}',
        '{"common":{"os":"Android 11.0"},"page":{"item":"shoe","item_type":"sku_id"},"ts":6}',
        '{"ts":7}', "not json", None,
    ]
    got = projections.page(cdc.parse_page_log(rows(spark, lines, "value STRING"))).collect()
    assert [(r["uid"], r["ts"], r["deviceInfo"]["os"], r["search_item"]) for r in got] == [
        ("7", 5, "iOS", "shoe"), ("-1", 6, "Android", None),
    ]
    assert not {"sid", "mid", "is_new"} & set(got[0]["deviceInfo"].asDict())


def test_amounts_as_numbers_or_text_in_changes(spark):
    lines = [
        '{"before":null,"after":{"id":1,"user_id":2,"total_amount":12.5},"source":{"table":"order_info"},"op":"c","ts_ms":3}',
        '{"before":null,"after":{"id":"4","user_id":"5","total_amount":"12.5"},"source":{"table":"order_info"},"op":"u","ts_ms":6}',
        '{"before":{"id":"4"},"after":null,"source":{"table":"order_info"},"op":"d","ts_ms":7}',
        '{"before":null,"after":{"id":"9"},"source":{"table":"other"},"op":"c","ts_ms":8}',
    ]
    envelopes = cdc.parse_envelope(rows(spark, lines, "value STRING"))
    got = projections.order(cdc.table(envelopes, "order_info")).collect()
    assert [(r["id"], r["uid"], r["total_amount"], r["ts_ms"]) for r in got] == [
        ("1", "2", "12.5", 3), ("4", "5", "12.5", 6),
    ]


def test_order_sum_uses_each_buckets_own_scores(spark):
    order = spark.range(1).select(
        F.lit("500").alias("total_amount"), F.lit("苹果").alias("btname"), F.lit("性价比").alias("bcname")
    )
    got = scoring.add_order_sums(order).first()
    assert got["sum_18_24"] == pytest.approx(0.18 + 0.06 + 0.12)
    assert got["sum_40_49"] == pytest.approx(0.04 + 0.24 + 0.03)


def test_right_wins(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', 2) AS l, named_struct('b', 3, 'c', 4) AS r")
    assert projections.right_wins(df, "l", "r").first().asDict() == {"a": 1, "b": 3, "c": 4}
    merged = text.merge_maps(F.expr("map('a', 1, 'b', 2)"), F.expr("map('b', 3)"))
    assert value(spark, merged) == {"a": 1, "b": 3}


def test_plain_bucket_names(spark):
    df = spark.range(1).select(F.lit(1).alias("pay_time_18-24"), F.lit(2).alias("sum_25~29"), F.lit(3).alias("sum_50"), F.lit(4).alias("ts_ms"))
    assert projections.plain_bucket_names(df).columns == ["pay_time_18_24", "sum_25_29", "sum_50", "ts_ms"]


def test_against_python_on_random_values(spark):
    import hashlib
    import random

    pick = random.Random(3)
    data = []
    for _ in range(300):
        number = pick.getrandbits(pick.choice([8, 64, 256]))
        first = dt.date(2023, 1, 1) + dt.timedelta(days=pick.randrange(900))
        last = first + dt.timedelta(days=pick.randrange(-3, 40))
        payload = "0x" + "".join(pick.choice("0123456789abcdef") for _ in range(pick.randrange(200)))
        data.append((str(number), hex(number), first, last, payload))
    df = spark.createDataFrame(data, "n STRING, h STRING, a DATE, b DATE, p STRING").select(
        "*", numbers.hex_or_decimal_to_text(F.col("h")).alias("number"), text.hash_bucket(F.col("n")).alias("bucket"),
        dates.day_partitions(F.col("a"), F.col("b")).alias("days"), text.hex_words(F.col("p")).alias("words"),
    )
    for r in df.collect():
        assert r["number"] == r["n"]
        assert r["bucket"] == "%04d" % (int(hashlib.md5(r["n"].encode()).hexdigest()[-3:], 16) % 128)
        days = [r["a"] + dt.timedelta(days=i) for i in range((r["b"] - r["a"]).days + 1)]
        assert r["days"] == [int(d.strftime("%Y%m%d")) for d in days]
        body = r["p"][2:]
        assert r["words"] == ["0x" + body[i * 64: i * 64 + 64] for i in range(len(body) // 64)]


def test_today_is_the_day_in_shanghai(spark):
    zone = dt.timezone(dt.timedelta(hours=8))
    before = dt.datetime.now(zone).date()
    got = value(spark, dates.today())
    assert before <= got <= dt.datetime.now(zone).date()


def test_routed_values_keep_their_types(spark):
    line = '{"after":{"id":1,"amount":12.5,"name":"x","other":true},"source":{"table":"t"},"op":"c","ts_ms":3}'
    routes = spark.createDataFrame([("t", "sink", "id, amount,name", "f", "id", "r")], schemas.DIM_ROUTE)
    facts = spark.createDataFrame([("t", "kind", "sink", "id", "r"), ("t2", "kind", "gone", "id", "d")], schemas.FACT_ROUTE)
    envelopes = cdc.parse_envelope(rows(spark, [line], "value STRING"))
    assert cdc.route(envelopes, routes).first()["value"] == '{"id":1,"amount":12.5,"name":"x"}'
    assert cdc.route(envelopes, facts).first()["value"] == '{"id":1}'


def plain_decimal_text(text, shift):
    """Hex or decimal text by Python's own numbers."""
    from decimal import Context, Decimal

    if text is None:
        return "0"
    exact = Context(prec=400)
    number = exact.create_decimal(int(text[2:] or "0", 16) if text.startswith("0x") else text)
    if shift:
        own_scale = max(0, -number.as_tuple().exponent)
        number = exact.scaleb(number, -shift)
        while -number.as_tuple().exponent > own_scale and number.as_tuple().digits[-1] == 0:
            digits = number.as_tuple()
            number = Decimal((digits.sign, digits.digits[:-1] or (0,), digits.exponent + 1))
    return format(number, "f")


def test_numbers_of_any_length_equal_plain_ones(spark):
    import random

    rng = random.Random(8)
    cases = [None, "0", "0x", "0x0", "0x00000000", "-0", "+7", "007", "1e3", "12E-4", ".5", "5.", "-1.500", "0.00", "1E+2", "120e-1"]
    cases += [hex(rng.getrandbits(n)) for n in range(1, 330, 3)] + [hex(16**n) for n in range(0, 70, 3)] + [hex(10**n) for n in range(0, 78, 2)]
    cases += [str(rng.getrandbits(n)) for n in range(1, 260, 9)] + [f"{rng.choice(['', '-'])}{rng.getrandbits(90)}.{rng.choice(['', '0', '00'])}{rng.getrandbits(rng.choice([1, 40, 90]))}0" for _ in range(60)]
    cases += [f"{10**rng.randint(0, 30)}" for _ in range(30)] + ["0X1F".replace("X", "x"), "0xABCDEF"]
    df = spark.createDataFrame([(c,) for c in cases], "v STRING").select(
        "v", numbers.hex_or_decimal_to_text(F.col("v")).alias("plain"), numbers.hex_or_decimal_to_text(F.col("v"), True).alias("ether"))
    for r in df.collect():
        assert (r.plain, r.ether) == (plain_decimal_text(r.v, 0), plain_decimal_text(r.v, 18)), r.v
    for bad in ("", "x", "0xZ", "1.2.3", "."):
        with pytest.raises(Exception, match="no number"):
            spark.createDataFrame([(bad,)], "v STRING").select(numbers.hex_or_decimal_to_text(F.col("v"))).collect()
