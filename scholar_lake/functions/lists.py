"""Text lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from scholar_lake.functions.abstracts import bind
from scholar_lake.functions.ids import strip_id


def clean_item(item: Column) -> Column:
    """Remove commas and both kinds of quote."""
    return F.translate(item, ",\"'", "")


def clean_list(items: Column, strip: bool = False) -> Column:
    """Drop null and empty items, clean the rest; null when nothing is left.

    The emptiness test comes before the cleaning, so an item made only of removed characters stays as ''.
    With ``strip`` each item is an id to shorten, and items too short to be ids are dropped as well.
    """
    kept = F.transform(F.filter(items, lambda x: F.length(x) > 0), clean_item)
    if strip:
        kept = F.filter(F.transform(kept, lambda x: strip_id(x)), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, kept)


def list_literal(items: Column) -> Column:
    """``{a,b}`` text of a list, for the CSV sink."""
    return F.when(items.isNotNull(), F.concat(F.lit("{"), F.array_join(items, ","), F.lit("}")))


def array_literal(items: Column) -> Column:
    """The text of a list as databases read it: items that are empty, the word NULL, hold a brace, comma, quote or backslash, or begin or end with
    white space are quoted, quotes and backslashes escaped; a null item is NULL."""
    def written(item: Column) -> Column:
        quoted = F.concat(F.lit('"'), F.regexp_replace(item, r'(["\\])', r"\\$1"), F.lit('"'))
        return F.when(item.isNull(), "NULL").when(item.rlike(r'^$|^[Nn][Uu][Ll][Ll]$|[{}",\\]|^\s|\s\z'), quoted).otherwise(item)
    return F.when(items.isNotNull(), F.concat(F.lit("{"), F.array_join(F.transform(items, written), ","), F.lit("}")))


def parse_literal(text: Column) -> Column:
    """The list that such a text stands for; null for what is none. Of a nested list, each inner list is an item, to be parsed again."""
    item = r'"(?:[^"\\]|\\.)*+"|\{(?:[^{}"]|"(?:[^"\\]|\\.)*+")*+\}|[^,{}"\s](?:[^,{}"]*[^,{}"\s])?'

    def read(found: Column) -> Column:
        bare = F.substr(found, F.lit(2), F.length(found) - 2)
        return F.when(found.startswith('"'), F.regexp_replace(bare, r"(?s)\\(.)", "$1")).when(F.upper(found) != "NULL", found)
    whole = F.trim(text).rlike(rf"(?s)^\{{\s*(?:(?:{item})\s*(?:,\s*(?:{item})\s*)*)?\}}$")
    inner = F.substr(F.trim(text), F.lit(2), F.length(F.trim(text)) - 2)
    return F.when(whole, F.transform(F.regexp_extract_all(inner, F.lit("(?s)" + item), F.lit(0)), read))


def society_names(societies: Column) -> Column:
    """Organisation names of a list of societies, cleaned."""
    return clean_list(F.transform(societies, lambda s: s["organization"]))


def unique_items(items: Column, key: list[str]) -> Column:
    """Structs of a list with one per key, the greatest in each; the key must be the leading fields.

    Sorting makes equal keys neighbours, which keeps this n log n for very long lists (array_distinct compares
    structs pairwise).
    """
    def differs(item: Column, following: Column) -> Column:
        same = F.lit(True)
        for name in key:
            same = same & following[name].eqNullSafe(item[name])
        return following.isNull() | ~same

    return bind(F.sort_array(items), lambda s: F.filter(s, lambda x, i: differs(x, F.get(s, i + 1))))
