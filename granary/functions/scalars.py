"""Scalar helpers for timestamps, names, ages and the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Labels of the calendar dimension, and Spark's numbers for
# Sunday and Saturday.
WEEKEND_DAYS = (1, 7)
WEEKEND_LABEL = "Final de Semana"
WORKDAY_LABEL = "Dia Útil"


def integer_quotient(numerator: Column, denominator: Column) -> Column:
    """Whole-number division on integers or decimals, without going through doubles."""
    return F.call_function("div", numerator, denominator)


def nanos_to_timestamp(nanos: Column) -> Column:
    """Nanoseconds since 1970 to a timestamp; NULL and 0 both mean "no value".

    Rounds down to whole microseconds, also before 1970.
    """
    thousand = F.lit(1000).cast("bigint")
    micros = integer_quotient(nanos - F.pmod(nanos, thousand), thousand)
    return F.when(nanos != 0, F.timestamp_micros(micros))


def convert_timestamps(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Bring the named columns, where present, to a timestamp type.

    What happens depends on the type found: whole numbers are nanoseconds,
    dates become midnight, anything else stays.
    """
    found = {f.name: f.dataType for f in df.schema.fields if f.name in columns}
    changed = {}
    for name, kind in found.items():
        if isinstance(kind, T.LongType):
            changed[name] = nanos_to_timestamp(F.col(name))
        elif isinstance(kind, T.DateType):
            changed[name] = F.col(name).cast("timestamp")
    return df.withColumns(changed) if changed else df


def literal_like(value: dt.date | dt.datetime | str, kind: T.DataType) -> Column:
    """A constant of the column's own type.

    Comparing a zone-less column with a zoned constant would cast the column,
    and a cast column is not pushed down to the scan.
    """
    return F.lit(value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)).cast(kind)


def full_name(*parts: str) -> Column:
    """Parts with a space between them; NULL as soon as one part is NULL."""
    spaced = [F.col(parts[0])]
    for part in parts[1:]:
        spaced += [F.lit(" "), F.col(part)]
    return F.concat(*spaced)


def age_in_years(birth: Column, as_of: dt.date) -> Column:
    """Difference of the calendar years; the birthday itself is ignored."""
    return F.lit(as_of.year) - F.year(birth)


def calendar_parts(day: Column) -> dict[str, Column]:
    """The calendar attributes of a date, by output column name."""
    weekday = F.dayofweek(day)
    return {
        "ano": F.year(day),
        "mes": F.month(day),
        "dia": F.dayofmonth(day),
        "dia_semana": weekday,
        "semana_ano": F.weekofyear(day),
        "trimestre": F.quarter(day),
        "mes_nome": F.date_format(day, "MMMM"),
        "dia_semana_nome": F.date_format(day, "EEEE"),
        "tipo_dia": F.when(weekday.isin(*WEEKEND_DAYS), F.lit(WEEKEND_LABEL)).otherwise(
            F.lit(WORKDAY_LABEL)
        ),
    }


def iso_year(day: Column) -> Column:
    """The year the ISO week belongs to; differs from the calendar year around 1 January."""
    return F.extract(F.lit("YEAROFWEEK"), day)


def month_index(day: Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    return F.year(day) * 12 + F.month(day) - 1


def with_run_metadata(df: DataFrame, layer: str, execution_date: str, triggered_by: str) -> DataFrame:
    return df.withColumns(
        {
            f"{layer}_created_at": F.current_timestamp(),
            f"{layer}_execution_date": F.lit(execution_date),
            "triggered_by": F.lit(triggered_by),
        }
    )
