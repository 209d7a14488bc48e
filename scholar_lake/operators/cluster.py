"""Order rows by several columns at once, so that the statistics of Parquet's row groups serve a filter on any of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _number(column: Column, kind: T.DataType) -> Column:
    """A number in the column's order; of other types than numbers and dates the first seven bytes of the text."""
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    start = F.substring(F.encode(column.cast("string"), "UTF-8"), 1, 7)
    return F.conv(F.rpad(F.hex(start), 14, "0"), 16, 10).cast("double")


def interleave(ranks: list[Column], bits: int) -> Column:
    """One number from the bits of several: the highest of each in the given order, then the next lower ones."""
    n = len(ranks)
    placed = [F.shiftleft(F.shiftright(rank, i).bitwiseAND(F.lit(1)).cast("bigint"), i * n + n - 1 - d)
              for d, rank in enumerate(ranks) for i in range(bits)]
    return reduce(Column.bitwiseOR, placed)


def with_cluster_key(rows: DataFrame, columns: tuple[str, ...], name: str = "_cluster", bits: int = 6) -> DataFrame:
    """Add interleaved ranks of the columns among 2**bits approximate quantiles of ``rows``: a sort key that keeps rows near in all columns together.

    Nulls have rank 0, as have all values of a column without any. The quantiles are one row, a scalar subquery over these columns alone; a rank is
    found in ``bits`` steps.
    """
    if len(columns) * bits > 63:
        raise ValueError("columns x bits must fit in 63 bits")
    kinds = {field.name: field.dataType for field in rows.schema.fields}
    numbers = [_number(F.col(c), kinds[c]) for c in columns]
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    bounds = rows.agg(F.struct(*[F.percentile_approx(x, shares, 1000).alias(f"q{i}") for i, x in enumerate(numbers)]).alias("s")).scalar()

    def rank(number: Column, limits: Column) -> Column:
        steps = F.array(*[F.lit(2 ** i) for i in reversed(range(bits))])
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(limits, at + step - 1) <= number, at + step).otherwise(at))
    # the subquery is a column of its own first, as Spark takes none inside lambdas
    bounded = rows.withColumn("_bounds", bounds)
    return bounded.withColumn(name, interleave([rank(x, F.col(f"_bounds.q{i}")) for i, x in enumerate(numbers)], bits)).drop("_bounds")
