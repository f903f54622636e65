import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.functions import identity, money, scalars
from tests.rows import values


def one(spark, value, kind, build):
    frame = spark.createDataFrame([(value,)], f"x {kind}")
    return frame.select(build(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "nanos, expected",
    [
        (1735689600123456789, dt.datetime(2025, 1, 1, 0, 0, 0, 123456)),
        (0, None),
        (None, None),
        (-1, dt.datetime(1969, 12, 31, 23, 59, 59, 999999)),
    ],
)
def test_nanoseconds(spark, nanos, expected):
    frame = spark.createDataFrame([(nanos,)], "x long")
    got = frame.select(scalars.nanos_to_timestamp(F.col("x")).cast("timestamp_ntz")).first()[0]
    assert got == expected


def test_timestamps_are_converted_by_the_type_found(spark):
    frame = spark.createDataFrame(
        [(1735689600000000000, dt.date(2025, 1, 1), dt.datetime(2025, 1, 1, 5), 7)],
        "criado_em long, data_nascimento date, data_venda timestamp, outro long",
    )
    got = scalars.convert_timestamps(frame, ("criado_em", "data_nascimento", "data_venda", "atualizado_em"))
    assert dict(got.dtypes) == {
        "criado_em": "timestamp", "data_nascimento": "timestamp", "data_venda": "timestamp", "outro": "bigint",
    }
    row = got.select(*[F.col(c).cast("string") for c in got.columns]).first()
    assert list(row) == ["2025-01-01 00:00:00", "2025-01-01 00:00:00", "2025-01-01 05:00:00", "7"]


def test_full_name_with_a_missing_part_is_missing(spark):
    frame = spark.createDataFrame([("Ana", None), ("Ana", "Lima")], "nome string, sobrenome string")
    assert values(frame.select(scalars.full_name("nome", "sobrenome").alias("n")), "n") == [("Ana Lima",), (None,)]


def test_age_ignores_the_birthday(spark):
    age = lambda c: scalars.age_in_years(c, dt.date(2001, 1, 1))
    assert one(spark, dt.date(1980, 12, 31), "date", age) == 21
    assert one(spark, None, "date", age) is None


@pytest.mark.parametrize(
    "day, weekday, kind, name",
    [
        (dt.date(2024, 12, 28), 7, "Final de Semana", "Saturday"),
        (dt.date(2024, 12, 29), 1, "Final de Semana", "Sunday"),
        (dt.date(2024, 12, 30), 2, "Dia Útil", "Monday"),
    ],
)
def test_calendar(spark, day, weekday, kind, name):
    frame = spark.createDataFrame([(day,)], "d date")
    row = frame.select(*[c.alias(n) for n, c in scalars.calendar_parts(F.col("d")).items()]).first()
    assert (row["dia_semana"], row["tipo_dia"], row["dia_semana_nome"]) == (weekday, kind, name)


def test_iso_week_over_new_year(spark):
    frame = spark.createDataFrame([(dt.date(2024, 12, 30),)], "d date")
    parts = scalars.calendar_parts(F.col("d"))
    row = frame.select(parts["semana_ano"], parts["ano"], scalars.iso_year(F.col("d"))).first()
    assert list(row) == [1, 2024, 2025]


def test_run_metadata(spark):
    frame = scalars.with_run_metadata(spark.range(1), "gold", "2025-01-01", "me")
    assert frame.columns == ["id", "gold_created_at", "gold_execution_date", "triggered_by"]
    assert frame.first()["gold_execution_date"] == "2025-01-01"


@settings(max_examples=8, deadline=None)
@given(
    rows=st.lists(
        st.tuples(st.integers(-(10**13), 10**13), st.integers(1, 10**7)), min_size=1, max_size=40
    )
)
def test_means_are_rounded_once_half_away_from_zero(spark, rows):
    frame = spark.createDataFrame([(Decimal(c) / 100, n) for c, n in rows], "total decimal(28,2), n long")
    got = [r[0] for r in frame.select(money.rounded_quotient(F.col("total"), F.col("n"))).collect()]
    for (cents, count), value in zip(rows, got):
        whole = (2 * abs(cents) + count) // (2 * count)
        assert value == Decimal(whole if cents >= 0 else -whole) / 100


def test_mean_of_nothing_is_missing(spark):
    frame = spark.createDataFrame([(None, 0)], "total decimal(28,2), n long")
    assert frame.select(money.rounded_quotient(F.col("total"), F.col("n"))).first()[0] is None


@pytest.mark.parametrize(
    "text, valid",
    [
        ("529.982.247-25", True), ("52998224725", True), ("52998224724", False),
        ("111.111.111-11", False), ("123", False), ("", False), (None, None),
    ],
)
def test_cpf(spark, text, valid):
    assert one(spark, text, "string", identity.valid_cpf) is valid


@pytest.mark.parametrize(
    "text, valid", [("11.222.333/0001-81", True), ("11.222.333/0001-82", False), ("1", False)]
)
def test_cnpj(spark, text, valid):
    assert one(spark, text, "string", identity.valid_cnpj) is valid


def _check_digit(numbers, first):
    weights = [2 + (len(numbers) - 1 - i) % first for i in range(len(numbers))]
    rest = sum(w * n for w, n in zip(weights, numbers)) % 11
    return 0 if rest < 2 else 11 - rest


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=9, max_size=9), min_size=1, max_size=30))
def test_cpf_built_by_the_rule_is_valid_and_a_changed_digit_is_not(spark, bases):
    good, bad = [], []
    for base in bases:
        full = base + [_check_digit(base, 10)]
        full += [_check_digit(full, 11)]
        if len(set(full)) > 1:
            good.append("".join(map(str, full)))
            bad.append("".join(map(str, full[:-1] + [(full[-1] + 1) % 10])))
    if not good:
        return
    frame = spark.createDataFrame(list(zip(good, bad)), "g string, b string")
    row = frame.agg(
        F.every(identity.valid_cpf(F.col("g"))), F.some(identity.valid_cpf(F.col("b")))
    ).first()
    assert list(row) == [True, False]


@pytest.mark.parametrize(
    "text, valid",
    [("a@b.co", True), ("a@b", False), (None, False), ("a@b.co x", False), ("a.b+c@d-e.f.org", True), ("a@.co", False)],
)
def test_email(spark, text, valid):
    assert one(spark, text, "string", identity.valid_email) is valid


def test_fixed_width_numbers(spark):
    assert one(spark, "1.234-5", "string", identity.cpf_digits) == "00000012345"
    assert one(spark, "abc", "string", identity.cpf_digits) is None
    assert one(spark, "11222333000181", "string", identity.cnpj_digits) == "11222333000181"
    assert one(spark, "+55 (11) 98765-4321", "string", identity.phone_digits) == "11987654321"
    assert one(spark, "011 3456-7890", "string", identity.phone_digits) == "1134567890"
    assert one(spark, "12345", "string", identity.phone_digits) is None


def test_dates_in_several_formats(spark):
    read = lambda c: identity.iso_date(c, "yyyy-MM-dd", "dd/MM/yyyy")
    assert one(spark, "2025-03-01", "string", read) == dt.date(2025, 3, 1)
    assert one(spark, "01/03/2025", "string", read) == dt.date(2025, 3, 1)
    assert one(spark, "soon", "string", read) is None


def test_clean_text(spark):
    assert one(spark, "  a\t\n b\x00c \x07 d ", "string", identity.clean_text) == "a bc d"
