"""From text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def empty_as_null(df: DataFrame) -> DataFrame:
    """Empty text is null in every text column of a table."""
    return df.select(*[
        F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def unparsable(text: Column, kind: str) -> Column:
    """Whether a present text fails to convert."""
    return text.isNotNull() & text.try_cast(kind).isNull()


def typed_load(df: DataFrame, columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Convert the named columns; rows with a value that does not convert are set aside.

    Returns ``(good, rejects)``; rejects keep the text and name the failing columns in ``reject_reason``.
    """
    fails = {name: unparsable(F.col(name), kind) for name, kind in columns.items()}
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in fails.items()]))
    marked = df.withColumn("reject_reason", F.array_join(reasons, ","))
    good = marked.where(F.col("reject_reason") == "").select(*[
        F.col(c).try_cast(columns[c]).alias(c) if c in columns else F.col(c) for c in df.columns])
    return good, marked.where(F.col("reject_reason") != "")


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The given columns by name, in order, in their types; values that do not convert become null."""
    return df.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in columns.items()])
