from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import arrays, codes, dates, keys


def test_numbers(evaluate):
    values = ["3.5", "3,5", " 7 ", " 8", "x", "", None, "1d", "NaN", "0x1p3", "1e2", ".5", "-2.", "1 2", "e"]
    strict = [3.5, None, 7.0, 8.0, None, None, None, None, None, None, 100.0, 0.5, -2.0, None, None]
    assert evaluate(codes.to_number, values) == strict
    assert evaluate(codes.to_decimal_comma, values)[:3] == [3.5, 3.5, 7.0]
    assert evaluate(lambda c: codes.safe_int(c, 1), ["5", " 6 ", "x", None, "5.0"]) == [5, 6, 1, 1, 1]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789.,+-eE xd\t ", max_size=8), min_size=1, max_size=40))
def test_numbers_follow_python(evaluate, values):
    def expected(v):
        try:
            return float(v)
        except ValueError:
            return None

    assert evaluate(codes.to_number, values) == [expected(v) for v in values]


def test_frequency(evaluate):
    values = ["0.25", "0.5", "1", "1.5", "2.5", "3.4", "15", "30", "99", "text", None, "1.0", "6.5"]
    labels = [
        "once_per_month", "every_15_days", "once_per_week", "once_per_week", "twice_per_week",
        "three_times_per_week", "every_15_days", "once_per_month", "", "", "", "once_per_week",
        "six_times_per_week",
    ]
    assert evaluate(lambda c: codes.frequency_label(codes.to_number(c)), values) == labels
    texts = ["0.25", "0.5", "1", "1.5", "2.5", "3.4", "15", "30", "99", "text", "", "1", "6.5"]
    assert evaluate(lambda c: codes.frequency_key(c, codes.to_number(c)), values) == texts
    assert evaluate(codes.frequency_texts, ["once_per_week", "every_15_days", "", "odd"]) == [
        ["1", "1.5"], ["15", "0.5"], [""], ["odd"],
    ]


def test_hour_rate(spark):
    rows = [
        (Decimal("100.00"), 1.0, 10.0, Decimal("2.50")),
        (Decimal("100.00"), 0.0, 10.0, Decimal("0.00")),
        (Decimal("100.00"), 1.0, None, Decimal("0.00")),
        (None, 1.0, 1.0, Decimal("0.00")),
        (Decimal("0.50"), 1.0, 1.0, Decimal("0.12")),  # 0.125, a real tie: half to even
        (Decimal("1.50"), 1.0, 1.0, Decimal("0.38")),  # 0.375
        (Decimal("10.00"), 3.0, 1.0, Decimal("0.83")),
    ]
    df = spark.createDataFrame(rows, "p decimal(18,2), f double, h double, want decimal(18,2)")
    got = df.select("want", codes.hour_rate(F.col("p"), F.col("f"), F.col("h")).alias("got"))
    assert all(r["want"] == r["got"] for r in got.collect())


def test_hours_key(evaluate):
    values = ["1", "1.0", None, "x", "3,5"]
    assert evaluate(lambda c: codes.hours_key(c, codes.to_decimal_comma(c)), values) == [
        "1.0", "1.0", "0.0", "", "3.5",
    ]


def test_registration_and_places(evaluate):
    values = ["12.345", "2147483647", "2147483648", "00000", "12345678901", "", None]
    assert evaluate(codes.registration_number, values) == [12345, 2147483647, None, None, None, None, None]
    assert evaluate(codes.place_code, ["35-50308", "", None, "x", "123456789012"]) == [
        3550308, None, None, None, 1234567890,
    ]
    assert evaluate(codes.place_code_text, [3550308, 0, None], "bigint") == ["3550308", None, None]


def test_booleans_and_statuses(evaluate):
    words = ["true", "1", "Sim", "YES", "false", "0", "nao", "não", "no", "other", None]
    assert evaluate(lambda c: codes.safe_bool(c, True), words) == [True] * 4 + [False] * 5 + [True] * 2
    assert evaluate(lambda c: codes.safe_bool(c, False), words)[-2:] == [False, False]
    assert evaluate(codes.scenario_status, [0, 11, None, 6], "int") == [0, 0, 0, 1]
    assert evaluate(codes.active_text, [True, False, None], "boolean") == ["active", "inactive", "inactive"]
    assert evaluate(codes.order_status_text, [0, 5, 9, None], "int") == ["pending", "inactive", "status_9", "pending"]
    assert evaluate(codes.marital_label, [1, 4, 9, None], "int") == ["Solteiro", "Viúvo", None, None]
    assert evaluate(codes.person_id_type, ["F", "J", "X"]) == ["CPF", "CNPJ", None]
    number = lambda c: codes.status_number(c, F.lit(True))
    assert evaluate(number, [7, None], "int") == [7, 1]


def test_dates(evaluate):
    moment = dt.datetime(2024, 5, 1, 13, 0)
    run = "2024-01-01 00:00:00"
    assert evaluate(lambda c: dates.first_day(run, c), [moment, None], "timestamp_ntz") == [
        dt.date(2024, 5, 1), dt.date(2024, 1, 1),
    ]
    assert evaluate(lambda c: dates.first_timestamp(run, c), [None], "timestamp_ntz") == [
        dt.datetime(2024, 1, 1),
    ]


def test_keys(evaluate):
    h = hashlib.md5(b"customer|1:7").hexdigest()
    want = f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"
    assert evaluate(lambda c: keys.surrogate_key("customer", c), [7], "bigint") == [want]
    values = [None, "", "|", "-", "1:", "a|b"]
    pairs = [(a, b) for a in values for b in values]
    ids = evaluate(lambda c: keys.surrogate_key("x", c["a"], c["b"]), pairs, "struct<a:string,b:string>")
    assert len(set(ids)) == len(pairs)
    merged = evaluate(lambda c: keys.merge_key(c, F.lit(5)), ["12345678000195", "0" * 14, "12345678901", None])
    assert merged == ["12345678000195", "__id_5", "__id_5", "__id_5"]
    assert evaluate(keys.tax_id_status, ["0" * 14, "12345678901"]) == ["invalid", "valid"]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(0, 10**9), min_size=1, max_size=5, unique=True), min_size=1, max_size=20))
def test_synthetic_tax_id(evaluate, groups):
    def expected(ids):
        digest = hashlib.sha256(str(tuple(sorted(ids))).encode()).hexdigest()
        return f"9{int(digest, 16) % 10**13:013d}"

    build = lambda c: keys.synthetic_tax_id(keys.id_tuple_text(c))
    assert evaluate(build, groups, "array<bigint>") == [expected(g) for g in groups]
    single = lambda c: keys.synthetic_tax_id(keys.single_id_text(c[0]))
    assert evaluate(single, [[g[0]] for g in groups], "array<bigint>") == [expected(g[:1]) for g in groups]


def test_arrays(evaluate):
    values = [[1, 2], [], None, [3]]
    assert evaluate(arrays.length, values, "array<bigint>") == [2, 0, 0, 1]
    assert evaluate(arrays.is_empty, values, "array<bigint>") == [False, True, True, False]
    assert evaluate(lambda c: arrays.any_in(c, [2, 9]), values[:2], "array<bigint>") == [True, False]
