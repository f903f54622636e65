"""Brazilian document numbers, phones, e-mails and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lengths and check-digit weights of the public number formats.
CPF_DIGITS = 11
CPF_WEIGHTS = ((10, 9, 8, 7, 6, 5, 4, 3, 2), (11, 10, 9, 8, 7, 6, 5, 4, 3, 2))
CNPJ_DIGITS = 14
CNPJ_WEIGHTS = (
    (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2),
    (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2),
)
CHECK_MODULUS = 11
# End of fixed values.

EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}"

_CONTROL = "[\\x00-\\x08\\x0E-\\x1F\\x7F]"
_BLANKS = "[ \\t\\n\\x0B\\f\\r]+"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def fixed_digits(text: Column, length: int) -> Column:
    """The digits of ``text``, padded with zeros in front; NULL if there are none or too many."""
    only = digits(text)
    return F.when(F.length(only).between(1, length), F.lpad(only, length, "0"))


def cpf_digits(text: Column) -> Column:
    return fixed_digits(text, CPF_DIGITS)


def cnpj_digits(text: Column) -> Column:
    return fixed_digits(text, CNPJ_DIGITS)


def phone_digits(text: Column) -> Column:
    """Area code and number; the country code 55 and a leading 0 are taken off."""
    only = F.regexp_replace(digits(text), "^0+", "")
    local = F.when(F.length(only).isin(12, 13) & only.startswith("55"), F.substring(only, 3, 11)).otherwise(only)
    return F.when(F.length(local).isin(10, 11), local)


def _check_digit(number: Column, weights: tuple[int, ...]) -> Column:
    positions = F.array(*[F.lit(w) for w in weights])
    products = F.transform(
        positions, lambda weight, i: weight * F.substr(number, i + 1, F.lit(1)).cast("int")
    )
    rest = F.aggregate(products, F.lit(0), lambda total, x: total + x) % CHECK_MODULUS
    return F.when(rest < 2, F.lit(0)).otherwise(F.lit(CHECK_MODULUS) - rest)


def _valid_number(text: Column, length: int, weights: tuple[tuple[int, ...], ...]) -> Column:
    """Right length, not one digit repeated, and both check digits right; NULL for NULL."""
    number = digits(text)
    shaped = (F.length(number) == length) & ~number.rlike("^(.)\\1*$")
    padded = F.rpad(number, length, "0")
    checks = [
        F.substr(padded, F.lit(len(w) + 1), F.lit(1)).cast("int") == _check_digit(padded, w)
        for w in weights
    ]
    return shaped & checks[0] & checks[1]


def valid_cpf(text: Column) -> Column:
    return _valid_number(text, CPF_DIGITS, CPF_WEIGHTS)


def valid_cnpj(text: Column) -> Column:
    return _valid_number(text, CNPJ_DIGITS, CNPJ_WEIGHTS)


def valid_email(text: Column) -> Column:
    """The whole text is an e-mail address; a missing one is not valid."""
    return F.coalesce(text.rlike(f"^{EMAIL}$"), F.lit(False))


def emails_in(text: Column) -> Column:
    """All addresses inside a longer text."""
    return F.regexp_extract_all(text, F.lit(f"({EMAIL})"), F.lit(1))


def clean_text(text: Column) -> Column:
    """Without control characters, runs of white space as one blank, trimmed."""
    visible = F.regexp_replace(text, _CONTROL, "")
    return F.trim(F.regexp_replace(visible, _BLANKS, " "))


def iso_date(text: Column, *patterns: str) -> Column:
    """The first pattern that reads the text; NULL if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)).cast("date") for p in patterns])
