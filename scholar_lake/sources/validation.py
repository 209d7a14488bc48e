"""Set aside records that break the format, with the reasons, instead of failing the run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from scholar_lake.functions.abstracts import bind
from scholar_lake.functions.casting import unparsable
from scholar_lake.functions.ids import strip_id
from scholar_lake.schemas import ENUMERATIONS, REQUIRED, record_ddl
from scholar_lake.sources.snapshot import CORRUPT

REASON = "reject_reason"
#: Why a record cannot become a search document. The search form asks for an id and well-typed fields only.
SEARCH_REASON = "search_reject_reason"


def violates(path: str, fails) -> Column:
    """Whether the value at ``path`` fails a test, where ``a[].b`` looks at every element of the list a.

    An absent parent has no value to test, so it passes.
    """
    if "[]." in path:
        outer, inner = path.split("[].", 1)
        return F.coalesce(F.exists(F.col(outer), lambda e: F.coalesce(fails(_field(e, inner)), F.lit(False))),
                          F.lit(False))
    value = F.col(path)
    if "." in path:
        parent = F.col(path.rsplit(".", 1)[0])
        return parent.isNotNull() & F.coalesce(fails(value), F.lit(False))
    return F.coalesce(fails(value), F.lit(False))


def _field(element: Column, inner: str) -> Column:
    for name in inner.split("."):
        element = element[name]
    return element


def basic_rules(columns: list[str]) -> dict[str, Column]:
    """What every target asks of a record."""
    rules = {"missing id": strip_id(F.col("id")).isNull() | (strip_id(F.col("id")) == "")}
    if CORRUPT in columns:
        rules = {"malformed": F.col(CORRUPT).isNotNull(), **rules}
    for name in ("created_date", "updated_date"):
        rules[f"unparsable {name}"] = unparsable(F.nullif(F.col(name), F.lit("")), "timestamp_ntz")
    return rules


def broken(rules: dict[str, Column]) -> Column:
    return F.array_join(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()])), ",")


def reject_reasons(entity: str, columns: list[str]) -> Column:
    """Names of the tables' rules that a record breaks, joined by commas; '' for a good record."""
    rules = basic_rules(columns)
    for path in REQUIRED[entity]:
        rules[f"missing {path}"] = violates(path, lambda v: v.isNull())
    for path, allowed in ENUMERATIONS.get(entity, {}).items():
        rules[f"unknown {path}"] = violates(path, lambda v, allowed=allowed: ~v.isin(*allowed))
    return broken(rules)


def mark(records: DataFrame, entity: str) -> DataFrame:
    """Add ``reject_reason``, and for works ``search_reject_reason``."""
    marked = records.withColumn(REASON, reject_reasons(entity, records.columns))
    return marked.withColumn(SEARCH_REASON, broken(basic_rules(records.columns))) if entity == "work" else marked


def type_tests(kind: T.DataType, path: str = "") -> list[tuple[str, Callable[[Column], Column]]]:
    """For a declared type and all types inside it the path, where ``a[].b`` is b in the elements of the list a, and a test whether a variant has a value there
    that the parser does not take. Text takes any value, and null is a value of any type."""
    def other_than(pattern: str) -> Callable[[Column], Column]:
        return lambda v: F.coalesce(~F.schema_of_variant(v).rlike(f"^(VOID|{pattern})"), F.lit(False))

    def inside(step: str, test: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda v: test(F.try_variant_get(v, step, "variant"))

    def in_any(test: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda v: F.coalesce(F.exists(F.try_variant_get(v, "$", "array<variant>"), test), F.lit(False))
    if isinstance(kind, T.StructType):
        fields = [(inner, inside(f"$['{f.name}']", test)) for f in kind.fields
                  for inner, test in type_tests(f.dataType, f"{path}.{f.name}" if path else f.name)]
        return [(path, other_than("OBJECT")), *fields]
    if isinstance(kind, T.ArrayType):
        return [(path, other_than("ARRAY")), *[(inner, in_any(test)) for inner, test in type_tests(kind.elementType, f"{path}[]")]]
    if isinstance(kind, T.MapType):
        return [(path, other_than("OBJECT"))]
    if isinstance(kind, T.BooleanType):
        return [(path, other_than("BOOLEAN"))]
    if isinstance(kind, T.IntegralType):
        return [(path, other_than("BIGINT"))]
    if isinstance(kind, T.NumericType):
        return [(path, other_than("BIGINT|DECIMAL|DOUBLE|FLOAT"))]
    return []


def with_wrong_types(rows: DataFrame, entity: str) -> DataFrame:
    """Add ``wrong_types``: of a malformed record the paths whose values are not of the declared type, sorted and joined by commas; ``no JSON`` where the text
    cannot be parsed; null for a record that is not malformed. The text is parsed once, and only in malformed records."""
    if CORRUPT not in rows.columns:
        return rows.withColumn("wrong_types", F.lit(None).cast("string"))
    tests = type_tests(T.StructType.fromDDL(record_ddl(entity)))

    def paths(value: Column) -> Column:
        found = F.array(*[F.when(test(value), F.lit(path or "record")) for path, test in tests])
        return F.when(value.isNull(), "no JSON").otherwise(F.array_join(F.array_sort(F.array_compact(found)), ","))
    return rows.withColumn("wrong_types", F.when(F.col(CORRUPT).isNotNull(), bind(F.try_parse_json(F.col(CORRUPT)), paths)))


def split(marked: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)`` of marked records, by the rules of one target."""
    return (marked.where(F.col(reason) == "").drop(REASON, SEARCH_REASON, CORRUPT), marked.where(F.col(reason) != ""))


def not_null_split(rows: DataFrame, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows with and without a null in the given columns."""
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return rows.where(present), rows.where(~present)
