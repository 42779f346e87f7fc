"""Flags, codes and missing values."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import fixed_values as V


def flag(text: Column) -> Column:
    """Three-valued flag from yes/no, true/false or 1/0 text; anything else is unknown."""
    word = F.lower(F.trim(text.cast("string")))
    return F.when(word.isin("yes", "true", "1"), True).when(word.isin("no", "false", "0"), False)


def enforce_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns named in ``schema``; text that does not fit becomes NULL."""
    wanted = {field.name: field.dataType for field in schema}

    def typed(name: str) -> Column:
        if name not in wanted or df.schema[name].dataType == wanted[name]:
            return F.col(name)
        if isinstance(wanted[name], T.BooleanType):
            return flag(F.col(name)).alias(name)
        return F.col(name).try_cast(wanted[name]).alias(name)

    return df.select(*[typed(name) for name in df.columns])


def _lookup(mapping: dict[str, str], key: Column, default: str) -> Column:
    pairs = F.create_map(*[F.lit(item) for item in chain.from_iterable(mapping.items())])
    return F.coalesce(pairs[key], F.lit(default))


def decode_sex(code: Column) -> Column:
    return _lookup(V.SEX_OF_CODE, code, V.SEX_UNKNOWN)


def encode_sex(sex: Column) -> Column:
    return _lookup(V.CODE_OF_SEX, sex, V.CODE_UNKNOWN)


def library_built(strandedness: Column) -> Column:
    return F.when(strandedness == "single", "ss").when(strandedness == "double", "ds")


def udg_fallback(strandedness: Column, udg: Column) -> Column:
    """Single-stranded libraries of unknown treatment count as untreated: nothing is trimmed."""
    untreated = (strandedness == "single") & (udg == "Unknown")
    return F.when(untreated, "none").otherwise(udg)


def classify_sex(
    x_rate: Column,
    y_rate: Column,
    xx: tuple[float, float, float, float] = V.XX_CUTOFFS,
    xy: tuple[float, float, float, float] = V.XY_CUTOFFS,
) -> Column:
    """F, M or U from the X and Y rates; range ends belong to the range."""

    def inside(box: tuple[float, float, float, float]) -> Column:
        return x_rate.between(box[0], box[1]) & y_rate.between(box[2], box[3])

    return F.when(inside(xx), "F").when(inside(xy), "M").otherwise(V.SEX_UNKNOWN)


def fill_ploidy(
    df: DataFrame, value: str = V.GENOTYPE_PLOIDY, column: str = "Genotype_Ploidy"
) -> DataFrame:
    """Give samples without a ploidy the given one."""
    return df.na.fill({column: value})


def textify(df: DataFrame, missing: str = V.METADATA_MISSING, separator: str = ";") -> DataFrame:
    """Every column as text; lists joined, missing values spelled out."""

    def as_text(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), separator)
        return F.coalesce(column.cast("string"), F.lit(missing)).alias(field.name)

    return df.select(*[as_text(field) for field in df.schema])
