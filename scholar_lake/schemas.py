"""Input record schemas and output table specifications.

Schemas are DDL text with exactly the fields that reach an output, plus those a record must have to be
accepted; every other field of the input is never parsed. Field, table and column names, types, keys and
enumerations are fixed values of the snapshot format and of the relational model.
"""

from __future__ import annotations

from dataclasses import dataclass

ENTITIES = ("work", "author", "funder", "publisher", "source", "institution", "concept")

COUNTS = "array<struct<year:int,works_count:int,cited_by_count:int>>"
STATS = "struct<h_index:int,i10_index:int>"
RATED_CONCEPTS = "array<struct<id:string,display_name:string,score:double>>"
LOCATION = (
    "struct<is_oa:boolean,landing_page_url:string,license:string,"
    "source:struct<id:string,display_name:string,host_organization:string,host_organization_name:string,"
    "issn:array<string>,issn_l:string,type:string>,pdf_url:string,version:string>"
)
AUTHORSHIPS = (
    "array<struct<author:struct<id:string,display_name:string,orcid:string>,author_position:string,"
    "institutions:array<struct<id:string,display_name:string,ror:string,country_code:string,type:string>>,"
    "is_corresponding:boolean,raw_affiliation_string:string,raw_author_name:string>>"
)

_COMMON = {
    "id": "string",
    "display_name": "string",
    "cited_by_count": "int",
    "works_count": "int",
    "summary_stats": STATS,
    "created_date": "string",
    "updated_date": "string",
}

RECORDS: dict[str, dict[str, str]] = {
    "author": {
        **_COMMON,
        "display_name_alternatives": "array<string>",
        "ids": "struct<mag:bigint,orcid:string,scopus:string,twitter:string,wikipedia:string>",
    },
    "institution": {
        **_COMMON,
        "counts_by_year": COUNTS,
        "type": "string",
        "homepage_url": "string",
        "ror": "string",
        "display_name_alternatives": "array<string>",
        "display_name_acronyms": "array<string>",
        "ids": "struct<mag:bigint,wikipedia:string,wikidata:string,grid:string>",
        "geo": "struct<city:string,geonames_city_id:string,region:string,country:string,country_code:string,"
               "latitude:double,longitude:double>",
        "associated_institutions": "array<struct<id:string,relationship:string>>",
        "x_concepts": RATED_CONCEPTS,
    },
    "publisher": {
        **_COMMON,
        "counts_by_year": COUNTS,
        "alternate_titles": "array<string>",
        "country_codes": "array<string>",
        "hierarchy_level": "int",
        "lineage": "array<string>",
        "parent_publisher": "struct<id:string>",
        "ids": "struct<ror:string,wikidata:string>",
    },
    "funder": {
        **_COMMON,
        "counts_by_year": COUNTS,
        "alternate_titles": "array<string>",
        "description": "string",
        "homepage_url": "string",
        # crossref is a string or a number; a string field keeps the text of either
        "ids": "struct<ror:string,wikidata:string,crossref:string,doi:string>",
    },
    "concept": {
        **_COMMON,
        "counts_by_year": COUNTS,
        "description": "string",
        "level": "int",
        "ids": "struct<mag:bigint,umls_cui:array<string>,umls_aui:array<string>,wikidata:string,wikipedia:string>",
        "ancestors": "array<struct<id:string>>",
        "related_concepts": RATED_CONCEPTS,
    },
    "source": {
        **_COMMON,
        "abbreviated_title": "string",
        "alternate_titles": "array<string>",
        "country_code": "string",
        "homepage_url": "string",
        "type": "string",
        "apc_usd": "int",
        "host_organization": "string",
        "host_organization_name": "string",
        "host_organization_lineage": "array<string>",
        "societies": "array<struct<url:string,organization:string>>",
        "is_in_doaj": "boolean",
        "is_oa": "boolean",
        "ids": "struct<mag:bigint,fatcat:string,issn:array<string>,issn_l:string,wikidata:string>",
    },
    "work": {
        "id": "string",
        "title": "string",
        "display_name": "string",
        "doi": "string",
        "language": "string",
        "license": "string",
        "type": "string",
        "type_crossref": "string",
        "publication_date": "string",
        "publication_year": "int",
        "cited_by_count": "int",
        "is_oa": "boolean",
        "is_paratext": "boolean",
        "is_retracted": "boolean",
        # two shapes (object or JSON text), so raw text here and functions.abstracts reads both
        "abstract_inverted_index": "string",
        "biblio": "struct<volume:string,issue:string,first_page:string,last_page:string>",
        "ids": "struct<openalex:string,doi:string,mag:bigint,pmid:string,pmcid:string>",
        "open_access": "struct<oa_status:string,oa_url:string,any_repository_has_fulltext:boolean>",
        "apc_list": "struct<value_usd:int>",
        # an object or a list of objects, so raw text
        "apc_paid": "string",
        "primary_location": LOCATION,
        "locations": f"array<{LOCATION}>",
        "authorships": AUTHORSHIPS,
        "concepts": RATED_CONCEPTS,
        "sustainable_development_goals": "array<struct<id:string,display_name:string,score:double>>",
        "grants": "array<struct<funder:string,funder_display_name:string,award_id:string>>",
        "mesh": "array<struct<descriptor_ui:string,descriptor_name:string,qualifier_ui:string,"
                "qualifier_name:string,is_major_topic:boolean>>",
        "referenced_works": "array<string>",
        "related_works": "array<string>",
        "created_date": "string",
        "updated_date": "string",
    },
}

#: Columns that are looked up by value, beside the owner id: they get bloom filters.
LOOKUP_COLUMNS = {"works": ("id", "id_doi"), "works_authorships": ("author_id",)}

#: Columns by which a table's files are ordered together; other tables are ordered by their owner's id.
CLUSTER_COLUMNS = {"works": ("publication_year", "type", "id")}

#: The fields of a work that its search document needs.
SEARCH_FIELDS = (
    "id", "display_name", "title", "abstract_inverted_index", "authorships", "biblio", "cited_by_count",
    "created_date", "doi", "ids", "is_oa", "is_paratext", "is_retracted", "language", "locations",
    "primary_location", "publication_date", "publication_year", "type", "updated_date",
)

#: Fields that must be present. ``a[].b`` means b of every element of a; ``a.b`` means b whenever a is there.
REQUIRED: dict[str, tuple[str, ...]] = {
    "author": (),
    "institution": ("counts_by_year", "associated_institutions", "associated_institutions[].relationship",
                    "x_concepts[].score"),
    "publisher": ("counts_by_year",),
    "funder": ("counts_by_year", "ids"),
    "concept": ("counts_by_year", "related_concepts[].score"),
    "source": (),
    "work": ("ids.openalex", "authorships[].author", "concepts[].score"),
}

#: Closed value lists of the format; null is allowed unless the field is required.
ENUMERATIONS: dict[str, dict[str, tuple[str, ...]]] = {
    "institution": {
        "type": ("education", "healthcare", "company", "archive", "nonprofit", "government", "facility", "other"),
        "associated_institutions[].relationship": ("parent", "child", "related", "other"),
    },
    "source": {"type": ("journal", "repository", "conference", "ebook platform", "book series", "other")},
    "work": {
        "open_access.oa_status": ("gold", "green", "hybrid", "bronze", "closed"),
        "locations[].source.type": ("journal", "repository", "conference", "ebook platform", "book series", "other"),
        "primary_location.source.type": ("journal", "repository", "conference", "ebook platform", "book series", "other"),
    },
}


def record_ddl(entity: str, only: tuple[str, ...] | None = None) -> str:
    """DDL of an entity's record, narrowed to ``only`` when given."""
    record = RECORDS[entity]
    return ", ".join(f"`{name}` {record[name]}" for name in (only or record))


@dataclass(frozen=True)
class TableSpec:
    """One output table: typed columns, the key that is unique in it, and the column naming the owning record."""

    name: str
    entity: str
    columns: dict[str, str]
    owner: str = "id"
    key: tuple[str, ...] = ("id",)
    not_null: tuple[str, ...] = ("id",)

    @property
    def is_link(self) -> bool:
        """Whether one owner may have many rows."""
        return self.key != (self.owner,)

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns.items())


def _entity_table(name: str, entity: str, columns: str) -> TableSpec:
    return TableSpec(name, entity, _columns(columns))


def _link_table(name: str, entity: str, columns: str, key: str = "", not_null: str = "") -> TableSpec:
    parsed = _columns(columns)
    owner = next(iter(parsed))
    keys = tuple(key.split())
    return TableSpec(name, entity, parsed, owner, keys, tuple(not_null.split()) or keys or (owner,))


def _columns(text: str) -> dict[str, str]:
    return {name: kind for name, kind in (item.split() for item in text.replace("\n", " ").split(","))}


_DATES = "created_date timestamp_ntz, updated_date timestamp_ntz"
_METRICS = "cited_by_count int, works_count int, h_index int, i10_index int"

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _entity_table("authors", "author", f"""
            id string, {_METRICS}, display_name string, display_name_alternatives array<string>,
            id_mag bigint, id_orcid string, id_scopus string, id_twitter string, id_wikipedia string, {_DATES}"""),
        _entity_table("institutions", "institution", f"""
            id string, type string, homepage_url string, {_METRICS}, display_name string,
            display_name_alternatives array<string>, display_name_acronyms array<string>,
            id_ror string, id_mag bigint, id_wikipedia string, id_wikidata string, id_grid string,
            city string, geonames_city_id string, region string, country string, country_code string,
            latitude float, longitude float, {_DATES}"""),
        _link_table("institutions_associations", "institution", """
            institution_a_id string, institution_b_id string, relationship string""",
                    "institution_a_id institution_b_id"),
        _link_table("institutions_concepts", "institution", """
            institution_id string, concept_id string, score float""", "institution_id concept_id"),
        _entity_table("publishers", "publisher", f"""
            id string, {_METRICS}, display_name string, alternate_titles array<string>,
            country_codes array<string>, id_ror string, id_wikidata string, hierarchy_level int,
            lineage array<string>, parent string, {_DATES}"""),
        _entity_table("funders", "funder", f"""
            id string, {_METRICS}, display_name string, alternate_titles array<string>, description string,
            homepage_url string, id_ror string, id_wikidata string, id_crossref string, id_doi string, {_DATES}"""),
        _entity_table("concepts", "concept", f"""
            id string, {_METRICS}, display_name string, description string, level int, id_mag bigint,
            id_umls_cui array<string>, id_umls_aui array<string>, id_wikidata string, id_wikipedia string, {_DATES}"""),
        _link_table("concepts_ancestors", "concept", """
            concept_a_id string, concept_b_id string""", "concept_a_id concept_b_id"),
        _link_table("concepts_related", "concept", """
            concept_a_id string, concept_b_id string, score float""", "concept_a_id concept_b_id"),
        _entity_table("sources", "source", f"""
            id string, {_METRICS}, display_name string, abbreviated_title string, alternate_titles array<string>,
            country_code string, homepage_url string, type string, apc_usd int, host_organization string,
            host_organization_name string, host_organization_lineage array<string>, societies array<string>,
            is_in_doaj boolean, is_oa boolean, id_mag bigint, id_fatcat string, id_issn array<string>,
            id_issn_l string, id_wikidata string, {_DATES}"""),
        _entity_table("works", "work", f"""
            id string, title string, abstract string, display_name string, language string,
            publication_date string, publication_year int, volume string, issue string, first_page string,
            last_page string, primary_location string, type string, type_crossref string, id_doi string,
            id_mag bigint, id_pmid string, id_pmcid string, is_oa boolean, oa_status string, oa_url string,
            oa_any_repository_has_fulltext boolean, apc_paid int, apc_list int, license string,
            cited_by_count int, is_paratext boolean, is_retracted boolean, mesh string, grants string, {_DATES}"""),
        _link_table("works_authorships", "work", """
            work_id string, author_id string, position string, exact_position int, raw_author_name string,
            raw_affiliation string, is_corresponding boolean"""),
        _link_table("works_authorship_institutions", "work", """
            work_id string, author_id string, institution_id string""", "work_id author_id institution_id"),
        _link_table("works_locations", "work", """
            work_id string, source_id string, is_oa boolean, is_primary boolean, landing_page_url string,
            license string, pdf_url string, version string"""),
        _link_table("works_concepts", "work", """
            work_id string, concept_id string, score float""", "work_id concept_id"),
        _link_table("works_sdgs", "work", """
            work_id string, sdg_id string, display_name string, score float""", "work_id sdg_id"),
        _link_table("works_references", "work", """
            work_a_id string, work_b_id string""", "work_a_id work_b_id"),
        _link_table("works_related", "work", """
            work_a_id string, work_b_id string""", "work_a_id work_b_id"),
    )
}

SEARCH_TABLE = _entity_table("search_works", "work", """
    id string, display_name string, title string, abstract string, title_abstract string, authorships string,
    biblio string, cited_by_count int, created_date timestamp_ntz, doi string, mag string, pmid string,
    pmcid string, is_oa boolean, is_paratext boolean, is_retracted boolean, language string, locations string,
    publication_date date, publication_year int, type string, updated_date timestamp_ntz""")


def tables_of(entity: str) -> list[TableSpec]:
    """The entity's own table first, then its link tables."""
    return [spec for spec in TABLES.values() if spec.entity == entity]
