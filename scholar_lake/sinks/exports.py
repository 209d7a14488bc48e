"""Files for other systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scholar_lake.functions.lists import array_literal, parse_literal
from scholar_lake.schemas import TableSpec


def write_csv(rows: DataFrame, spec: TableSpec, path: str) -> None:
    """Gzipped CSV with a header in the table's column order; other columns are left out, null is an empty field."""
    flat = rows.select(*[
        array_literal(F.col(name)).alias(name) if kind.startswith("array") else F.col(name)
        for name, kind in spec.columns.items()])
    (flat.write.mode("overwrite").option("header", True).option("compression", "gzip").option("escape", '"')
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))


def read_csv(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Load such files by column name into typed columns; an empty field is null."""
    text = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .schema(", ".join(f"`{name}` string" for name in spec.columns)).csv(path))
    columns = []
    for name, kind in spec.columns.items():
        value = F.nullif(F.col(name), F.lit(""))
        if kind.startswith("array"):
            columns.append(parse_literal(value).alias(name))
        else:
            columns.append(value.try_cast(kind).alias(name))
    return text.select(*columns)


def write_json(documents: DataFrame, path: str) -> None:
    """Search documents as JSON lines, null fields left out."""
    documents.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", True).json(path)


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               partitions: int = 8, batch: int = 10_000) -> None:
    """Append a table to a relational database over at most ``partitions`` connections.

    Lists are written as their literal, since not every database has an array type.
    """
    lists = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.ArrayType)}
    flat = rows.select(*[array_literal(F.col(c)).alias(c) if c in lists else F.col(c) for c in rows.columns])
    (flat.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
     .option("numPartitions", partitions).option("batchsize", batch).options(**(properties or {})).save())
