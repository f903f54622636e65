"""Rules that rows have to keep, evaluated together, and the rows that break them.

All rules of a table are evaluated in one pass into an array with the names of
those that a row breaks. Rules of one kind refuse the row: it is kept out of
silver. The others only report it: the row goes on, and is listed. Text is
cleaned and numbers are brought to one form before the rules look at them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.identity import clean_text, cnpj_digits, cpf_digits, phone_digits, valid_cnpj, valid_cpf, valid_email
from granary.plans import silver
from granary.schemas import BROKEN


@dataclass(frozen=True)
class Rule:
    """``passes``: whether a row keeps the rule, made when a session runs; NULL counts as broken."""

    name: str
    passes: Callable[[], Column]
    refuses: bool = True


def present(column: str) -> Rule:
    return Rule(f"{column}_ausente", lambda: F.col(column).isNotNull())


def shaped(name: str, column: str, check: Callable[[Column], Column], refuses: bool = False) -> Rule:
    """A format that a value has if there is one."""
    return Rule(name, lambda: F.col(column).isNull() | check(F.col(column)), refuses)


def _not_negative(value: Column) -> Column:
    return value >= 0


RULES: dict[str, tuple[Rule, ...]] = {
    "clientes": (present("id"), shaped("email_invalido", "email", valid_email), shaped("cpf_invalido", "cpf", valid_cpf)),
    "fornecedores": (present("id"), shaped("email_invalido", "email", valid_email), shaped("cnpj_invalido", "cnpj", valid_cnpj)),
    "produtos": (
        present("id"),
        Rule("categoria_id_ausente", lambda: F.col("categoria_id").isNotNull(), False),
        shaped("preco_negativo", "preco", _not_negative), shaped("estoque_negativo", "quantidade_estoque", _not_negative),
    ),
    "categorias": (present("id"), Rule("nome_ausente", lambda: F.col("nome").isNotNull(), False)),
    "enderecos": (present("id"), Rule("cliente_id_ausente", lambda: F.col("cliente_id").isNotNull(), False)),
}

# How text columns are brought to one form; what does not fit the form is only cleaned.
_FORMS: dict[str, Callable[[Column], Column]] = {"cpf": cpf_digits, "cnpj": cnpj_digits, "telefone": phone_digits}
CLEANED = {
    "clientes": ("nome", "sobrenome", "email", "telefone", "cpf"),
    "fornecedores": ("nome", "email", "telefone", "cnpj"),
    "produtos": ("nome", "descricao"),
    "categorias": ("nome", "descricao"),
    "enderecos": ("cep", "logradouro", "numero", "complemento", "bairro", "cidade", "estado"),
}


def standardised(frame: DataFrame, table: str) -> DataFrame:
    """Text without control characters and double blanks, phones and document numbers as digits."""
    changes = {}
    for column in CLEANED.get(table, ()):
        text = clean_text(F.col(column).cast("string"))
        form = _FORMS.get(column)
        changes[column] = F.coalesce(form(text), text) if form else text
    return frame.withColumns(changes) if changes else frame


def broken(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Names of the rules that a row breaks, and whether one of them refuses it."""
    fails = {r: ~F.coalesce(r.passes(), F.lit(False)) for r in rules}
    names = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(f, F.lit(r.name)) for r, f in fails.items()]))
    refused = reduce(Column.__or__, [f for r, f in fails.items() if r.refuses], F.lit(False))
    return names, refused


def judged(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The frame with ``motivos`` and ``recusada``; every rule is evaluated once per row."""
    names, refused = broken(rules)
    return frame.withColumns({"motivos": names, "recusada": refused})


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Judged rows without the refused ones, and all rows that break a rule."""
    return rows.filter(~F.col("recusada")).drop("motivos", "recusada"), rows.filter(F.size("motivos") > 0)


def as_report(rows: DataFrame, table: str, key: str = "id") -> DataFrame:
    """Broken rows of any table in one form: table, key, reasons, and the row as JSON."""
    own = [c for c in rows.columns if c not in ("motivos", "recusada")]
    kinds = {f.name: f.dataType for f in BROKEN.fields}
    values = {"tabela": F.lit(table), "chave": F.col(key).cast("string"), "motivos": F.col("motivos"), "recusada": F.col("recusada"), "linha": F.to_json(F.struct(*own))}
    return rows.select(*[values[name].cast(kind).alias(name) for name, kind in kinds.items()])


def line_rules() -> tuple[Rule, ...]:
    """What a line needs to enter the fact, as rules: the same checks that the fact filters by."""
    return tuple(Rule(f"{name}_invalido" if name in silver.POSITIVE else f"{name}_ausente", lambda c=check: c) for name, check in silver.line_checks().items())


def refused_lines(sales: DataFrame, lines: DataFrame, held: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Lines that the fact leaves out, with all their reasons.

    Lines and headers that fail are picked before the join, so only they and
    what belongs to them meet, not the whole fact once more. ``held`` may store
    them, so that their real size is known when the joins are planned: if they
    are few, the other lines and headers stay where they are.
    """
    bad_line = ~silver.valid_line(("produto_id",))
    bad_line = F.coalesce(bad_line, F.lit(True))
    failing = silver.sale_lines(sales, held(lines.filter(bad_line)))
    others = silver.sale_lines(held(sales.filter(F.col("cliente_id").isNull())), lines.filter(~bad_line))
    return judged(failing.union(others), line_rules()).drop("recusada")


def reasons(judged_tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """Per table and rule: rows, and rows that break it; zero where none does."""
    parts = []
    for table, rows in judged_tables.items():
        counts = rows.agg(F.count("*").alias("linhas"), *[F.count_if(F.array_contains("motivos", r.name)).alias(r.name) for r in rules[table]])
        each = F.array(*[F.struct(F.lit(r.name).alias("regra"), F.lit(r.refuses).alias("recusa"), F.col(r.name).alias("violacoes")) for r in rules[table]])
        parts.append(counts.select(F.lit(table).alias("tabela"), "linhas", F.inline(each)))
    return reduce(DataFrame.union, parts)
