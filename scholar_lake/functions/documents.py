"""Derived fields of a work."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from scholar_lake.functions.ids import strip_id

KEEP_NULLS = {"ignoreNullFields": "false"}


def title_abstract(title: Column, abstract: Column) -> Column:
    """Title, a blank, abstract; null only when both are."""
    either = title.isNotNull() | abstract.isNotNull()
    return F.when(either, F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(abstract, F.lit(""))))


def grants_json(grants: Column) -> Column:
    """JSON of the grants with short funder ids, nulls written out; null when there are none."""
    short = F.transform(grants, lambda g: F.struct(
        strip_id(g["funder"]).alias("funder"), g["funder_display_name"].alias("funder_display_name"),
        g["award_id"].alias("award_id")))
    return F.when(F.size(grants) > 0, F.to_json(short, KEEP_NULLS))


def mesh_json(mesh: Column) -> Column:
    """JSON of the subject headings without null fields; null when there are none."""
    return F.when(F.size(mesh) > 0, F.to_json(mesh))


def apc_value(raw: Column) -> Column:
    """Price in USD of a raw APC field; null when it holds a list of prices."""
    return F.get_json_object(raw, "$.value_usd").try_cast("int")


def is_primary(primary: Column, location: Column) -> Column:
    """Whether a location is the primary one: both name a source, and source, pdf and version agree (null = null)."""
    same_source = (primary["source"]["id"].eqNullSafe(location["source"]["id"])
                   & primary["source"]["display_name"].eqNullSafe(location["source"]["display_name"]))
    return (primary["source"].isNotNull() & location["source"].isNotNull() & same_source
            & primary["pdf_url"].eqNullSafe(location["pdf_url"])
            & primary["version"].eqNullSafe(location["version"]))


AUTHORSHIP_FIELDS = ("author", "author_position", "institutions", "is_corresponding", "raw_affiliation_string")


def authorships_json(authorships: Column) -> Column:
    """JSON of the authorships for the search document; null when there are none. An authorship's own null fields are written out, those
    of the author and the institutions inside it are left out."""
    def one(a: Column) -> Column:
        # a list of one value is written without the nulls inside the value; cutting its brackets off leaves the value
        values = [F.concat(F.lit(f'"{name}":'), F.when(a[name].isNull(), "null").otherwise(_bare(a[name])))
                  for name in AUTHORSHIP_FIELDS]
        return F.concat(F.lit("{"), F.concat_ws(",", *values), F.lit("}"))
    return F.when(F.size(authorships) > 0, F.concat(F.lit("["), F.array_join(F.transform(authorships, one), ","), F.lit("]")))


def _bare(value: Column) -> Column:
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def locations_json(primary: Column, locations: Column) -> Column:
    """JSON of the locations with their ``is_primary`` flag; null when there are none. Null fields are left out."""
    shown = F.transform(locations, lambda x: F.struct(
        x["is_oa"].alias("is_oa"), is_primary(primary, x).alias("is_primary"),
        *[x[name].alias(name) for name in ("landing_page_url", "license", "source", "pdf_url", "version")]))
    return F.when(F.size(locations) > 0, F.to_json(shown))


def biblio_json(biblio: Column) -> Column:
    """JSON of the bibliographic position, only when there is a volume."""
    return F.when(biblio["volume"].isNotNull(), F.to_json(biblio))
