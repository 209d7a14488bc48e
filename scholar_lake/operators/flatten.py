"""Nested records to relational tables.

Every function takes the records of one entity and returns one of its tables with the columns and types of the table's
:class:`~scholar_lake.schemas.TableSpec`. Missing parents give null, null or empty lists give no rows.

The key of a link table starts with the id of the record that owns the row. Where records are unique by id, duplicate keys can
only come from one record, and they are removed inside it before its list is spread out. So flattening is projection and
generation throughout and shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scholar_lake.functions.abstracts import abstract_text
from scholar_lake.functions.casting import conform, empty_as_null
from scholar_lake.functions.documents import apc_value, grants_json, is_primary, mesh_json
from scholar_lake.functions.ids import strip_id
from scholar_lake.functions.lists import clean_list, society_names, unique_items
from scholar_lake.operators.dedup import unique_links
from scholar_lake.schemas import TABLES, tables_of
from scholar_lake.sources.validation import not_null_split


def shape(rows: DataFrame, table: str) -> DataFrame:
    """Column order and types of a table, with empty text as null."""
    return empty_as_null(conform(rows, TABLES[table].columns))


def accept(rows: DataFrame, table: str, unique_records: bool = False) -> DataFrame:
    """Rows that satisfy a table's NOT NULL columns and, for link tables, its key.

    With ``unique_records`` (no two records share an id) the key already holds and needs no shuffle.
    """
    spec = TABLES[table]
    good, _ = not_null_split(rows, spec.not_null)
    return good if unique_records or spec.key == ("id",) else unique_links(good, spec.key)


def rejected(rows: DataFrame, table: str) -> DataFrame:
    """Rows with a null where the table forbids it."""
    return not_null_split(rows, TABLES[table].not_null)[1]


def _same(*names: str) -> list[Column]:
    return [F.col(name) for name in names]


def _id() -> Column:
    return strip_id(F.col("id"))


def _metrics() -> list[Column]:
    return [F.col("cited_by_count"), F.col("works_count"), F.col("summary_stats.h_index").alias("h_index"),
            F.col("summary_stats.i10_index").alias("i10_index")]


def _list(name: str, strip: bool = False) -> Column:
    return clean_list(F.col(name), strip).alias(name.rsplit(".", 1)[-1])


def _from_ids(*names: str) -> list[Column]:
    return [F.col(f"ids.{name}").alias(f"id_{name}") for name in names]


def _dates() -> list[Column]:
    return _same("created_date", "updated_date")


def authors(records: DataFrame) -> DataFrame:
    return shape(records.select(
        _id().alias("id"), *_metrics(), F.col("display_name"), _list("display_name_alternatives"),
        *_from_ids("mag", "orcid", "scopus", "twitter", "wikipedia"), *_dates()), "authors")


def institutions(records: DataFrame) -> DataFrame:
    place = ("city", "geonames_city_id", "region", "country", "country_code", "latitude", "longitude")
    return shape(records.select(
        _id().alias("id"), *_same("type", "homepage_url"), *_metrics(), F.col("display_name"),
        _list("display_name_alternatives"), _list("display_name_acronyms"), F.col("ror").alias("id_ror"),
        *_from_ids("mag", "wikipedia", "wikidata", "grid"), *[F.col(f"geo.{p}").alias(p) for p in place], *_dates()),
        "institutions")


def publishers(records: DataFrame) -> DataFrame:
    return shape(records.select(
        _id().alias("id"), *_metrics(), F.col("display_name"), _list("alternate_titles"), _list("country_codes"),
        *_from_ids("ror", "wikidata"), F.col("hierarchy_level"), _list("lineage", strip=True),
        strip_id(F.col("parent_publisher.id")).alias("parent"), *_dates()), "publishers")


def funders(records: DataFrame) -> DataFrame:
    return shape(records.select(
        _id().alias("id"), *_metrics(), F.col("display_name"), _list("alternate_titles"),
        *_same("description", "homepage_url"), *_from_ids("ror", "wikidata", "crossref", "doi"), *_dates()), "funders")


def concepts(records: DataFrame) -> DataFrame:
    return shape(records.select(
        _id().alias("id"), *_metrics(), *_same("display_name", "description", "level"),
        F.col("ids.mag").alias("id_mag"), clean_list(F.col("ids.umls_cui")).alias("id_umls_cui"),
        clean_list(F.col("ids.umls_aui")).alias("id_umls_aui"), *_from_ids("wikidata", "wikipedia"), *_dates()), "concepts")


def sources(records: DataFrame) -> DataFrame:
    return shape(records.select(
        _id().alias("id"), *_metrics(), *_same("display_name", "abbreviated_title"), _list("alternate_titles"),
        # host_organization keeps its URL form, its lineage does not
        *_same("country_code", "homepage_url", "type", "apc_usd", "host_organization", "host_organization_name"),
        _list("host_organization_lineage", strip=True), society_names(F.col("societies")).alias("societies"),
        *_same("is_in_doaj", "is_oa"), *_from_ids("mag", "fatcat"), clean_list(F.col("ids.issn")).alias("id_issn"),
        *_from_ids("issn_l", "wikidata"), *_dates()), "sources")


def works(records: DataFrame) -> DataFrame:
    return shape(records.select(
        _id().alias("id"), F.col("title"), abstract_text(F.col("abstract_inverted_index")).alias("abstract"),
        *_same("display_name", "language", "publication_date", "publication_year"),
        *[F.col(f"biblio.{name}").alias(name) for name in ("volume", "issue", "first_page", "last_page")],
        strip_id(F.col("primary_location.source.id")).alias("primary_location"), *_same("type", "type_crossref"),
        *_from_ids("doi", "mag", "pmid", "pmcid"), F.col("is_oa"), F.col("open_access.oa_status").alias("oa_status"),
        F.col("open_access.oa_url").alias("oa_url"),
        F.col("open_access.any_repository_has_fulltext").alias("oa_any_repository_has_fulltext"),
        apc_value(F.col("apc_paid")).alias("apc_paid"), F.col("apc_list.value_usd").alias("apc_list"),
        *_same("license", "cited_by_count", "is_paratext", "is_retracted"),
        mesh_json(F.col("mesh")).alias("mesh"), grants_json(F.col("grants")).alias("grants"), *_dates()), "works")


def _links(records: DataFrame, table: str, items: Column, *fields) -> DataFrame:
    """One row per list element: the owner's id and the given functions of the element, in the table's column order."""
    owner, *names = TABLES[table].columns
    made = F.transform(items, lambda x: F.struct(*[make(x).alias(name) for name, make in zip(names, fields)]))
    return _spread_out(records, table, owner, made, names)


def _spread_out(records: DataFrame, table: str, owner: str, items: Column, names: list[str]) -> DataFrame:
    key = [name for name in TABLES[table].key if name != owner]
    each = records.select(strip_id(F.col("id")).alias(owner), F.explode(unique_items(items, key)).alias("_item"))
    return shape(each.select(owner, *[F.col(f"_item.{name}").alias(name) for name in names]), table)


def _short_id(item: Column) -> Column:
    return strip_id(item["id"])


def institutions_associations(records: DataFrame) -> DataFrame:
    return _links(records, "institutions_associations", F.col("associated_institutions"),
                  _short_id, lambda x: x["relationship"])


def institutions_concepts(records: DataFrame) -> DataFrame:
    return _links(records, "institutions_concepts", F.col("x_concepts"), _short_id, lambda x: x["score"])


def concepts_ancestors(records: DataFrame) -> DataFrame:
    return _links(records, "concepts_ancestors", F.col("ancestors"), _short_id)


def concepts_related(records: DataFrame) -> DataFrame:
    return _links(records, "concepts_related", F.col("related_concepts"), _short_id, lambda x: x["score"])


def _each(records: DataFrame, generated: Column, item: str, *kept: str) -> DataFrame:
    """Spread out a list with the work's id.

    The inner form of explode makes the optimizer test the list twice beforehand, which builds a derived list three times;
    the outer form does not, and the row it makes of a missing list is dropped here.
    """
    each = records.select(strip_id(F.col("id")).alias("work_id"), *kept, generated)
    return each.where(F.col(item).isNotNull())


def works_authorships(records: DataFrame) -> DataFrame:
    each = _each(records, F.posexplode_outer("authorships").alias("exact_position", "a"), "a")
    return shape(each.select(
        "work_id", strip_id(F.col("a.author.id")).alias("author_id"), F.col("a.author_position").alias("position"),
        "exact_position", F.col("a.raw_author_name").alias("raw_author_name"),
        F.col("a.raw_affiliation_string").alias("raw_affiliation"),
        F.col("a.is_corresponding").alias("is_corresponding")), "works_authorships")


def works_authorship_institutions(records: DataFrame) -> DataFrame:
    pairs = F.flatten(F.transform("authorships", lambda a: F.transform(
        F.coalesce(a["institutions"], F.array()),
        lambda i: F.struct(strip_id(a["author"]["id"]).alias("author_id"), _short_id(i).alias("institution_id")))))
    return _spread_out(records, "works_authorship_institutions", "work_id", pairs, ["author_id", "institution_id"])


def works_locations(records: DataFrame) -> DataFrame:
    each = _each(records, F.explode_outer("locations").alias("x"), "x", "primary_location")
    return shape(each.select(
        "work_id", strip_id(F.col("x.source.id")).alias("source_id"), F.col("x.is_oa").alias("is_oa"),
        is_primary(F.col("primary_location"), F.col("x")).alias("is_primary"),
        *[F.col(f"x.{name}").alias(name) for name in ("landing_page_url", "license", "pdf_url", "version")]),
        "works_locations")


def works_concepts(records: DataFrame) -> DataFrame:
    return _links(records, "works_concepts", F.col("concepts"), _short_id, lambda x: x["score"])


def works_sdgs(records: DataFrame) -> DataFrame:
    # goals keep their full id
    return _links(records, "works_sdgs", F.col("sustainable_development_goals"),
                  lambda x: x["id"], lambda x: x["display_name"], lambda x: x["score"])


def works_references(records: DataFrame) -> DataFrame:
    return _links(records, "works_references", F.col("referenced_works"), lambda x: strip_id(x))


def works_related(records: DataFrame) -> DataFrame:
    return _links(records, "works_related", F.col("related_works"), lambda x: strip_id(x))


FLATTEN = {
    "authors": authors, "institutions": institutions, "institutions_associations": institutions_associations,
    "institutions_concepts": institutions_concepts, "publishers": publishers, "funders": funders, "concepts": concepts,
    "concepts_ancestors": concepts_ancestors, "concepts_related": concepts_related, "sources": sources, "works": works,
    "works_authorships": works_authorships, "works_authorship_institutions": works_authorship_institutions,
    "works_locations": works_locations, "works_concepts": works_concepts, "works_sdgs": works_sdgs,
    "works_references": works_references, "works_related": works_related,
}


def flatten(records: DataFrame, entity: str, unique_records: bool = True) -> dict[str, DataFrame]:
    """All tables of an entity from its validated records, keys and NOT NULLs satisfied."""
    return {spec.name: accept(FLATTEN[spec.name](records), spec.name, unique_records) for spec in tables_of(entity)}
