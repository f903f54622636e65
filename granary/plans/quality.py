"""Cleaning and checking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.quantiles import exact_quantiles

# Tukey's fences reach this many quartile ranges beyond the quartiles.
FENCE = 1.5


def convert_types(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Text columns to other types; what does not read as the type becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in targets.items()})


def conversion_report(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Per converted column: rows, missing values, converted and refused ones."""
    converted = df.select(
        *[F.col(c).alias(f"{c}_texto") for c in targets],
        *[F.col(c).try_cast(kind).alias(f"{c}_valor") for c, kind in targets.items()],
    )
    counted = converted.agg(
        F.count("*").alias("linhas"),
        *[F.count(f"{c}_texto").alias(f"{c}_texto") for c in targets],
        *[F.count(f"{c}_valor").alias(f"{c}_valor") for c in targets],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(c).alias("coluna"),
                F.lit(kind).alias("tipo"),
                F.col("linhas"),
                (F.col("linhas") - F.col(f"{c}_texto")).alias("nulos"),
                F.col(f"{c}_valor").alias("convertidos"),
                (F.col(f"{c}_texto") - F.col(f"{c}_valor")).alias("recusados"),
            )
            for c, kind in targets.items()
        ]
    )
    return counted.select(F.inline(per_column))


def outliers_iqr(df: DataFrame, group: str, value: str) -> DataFrame:
    """All rows with their group's fences, a flag, and the value clipped to the fences.

    Fences are rounded to six digits before anything is compared with them.
    """
    quartiles = exact_quantiles(df, [group], value, [0.25, 0.75])
    q1, q3 = F.round(F.col("quantis")[0], 6), F.round(F.col("quantis")[1], 6)
    reach = (q3 - q1) * FENCE
    fences = quartiles.select(
        F.col(group).alias("_group"),
        F.round(q1 - reach, 6).alias("limite_inferior"),
        F.round(q3 + reach, 6).alias("limite_superior"),
    )
    low, high, x = F.col("limite_inferior"), F.col("limite_superior"), F.col(value)
    return df.join(fences, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group").withColumns(
        {
            "atipico": (x < low) | (x > high),
            "valor_ajustado": F.when(x.isNotNull(), F.least(F.greatest(x, low), high)),
        }
    )


def checked(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Adds one flag per format check."""
    return df.withColumns(dict(checks))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
