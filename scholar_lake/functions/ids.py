"""Identifiers: records are named by URL, tables hold the short form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Length of the URL prefix in front of every id; a fixed value of the input format.
ID_PREFIX_LENGTH = 21


def strip_id(url: Column, prefix_length: int = ID_PREFIX_LENGTH) -> Column:
    """Text after the prefix; null for null or anything shorter than the prefix, '' for the bare prefix."""
    return F.when(F.length(url) >= prefix_length, F.substr(url, F.lit(prefix_length + 1)))


def partition_label(file_path: Column) -> Column:
    """``<date>-<file stem>`` of a snapshot file, as used to name the outputs of one input file."""
    parent = F.substring_index(F.substring_index(file_path, "/", -2), "/", 1)
    stem = F.regexp_replace(F.substring_index(file_path, "/", -1), r"\.[^.]*$", "")
    return F.concat(F.replace(parent, F.lit("updated_date="), F.lit("")), F.lit("-"), stem)
