"""Keyed delete and replace: whole rows, and whole sets of child rows, are exchanged by owner id."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from scholar_lake.operators.skew import heavy_keys, skew_join
from scholar_lake.schemas import TableSpec
from scholar_lake.sources.merged_ids import present_ids


def delete_by_key(target: DataFrame, ids: DataFrame, key: str, hot_owners: bool = False, parts: int = 0) -> DataFrame:
    """Target rows whose key is not in ``ids``; null keys and null ids never match.

    The ids are made distinct first. Whether they are broadcast is left to Spark's measured size limit. With
    ``hot_owners`` (child tables, in which one owner may have very many rows) heavy keys of the target are salted: Spark's
    own splitting of skewed joins does not apply where one side comes straight from an aggregate, as the distinct ids do. With ``parts``
    the join has so many tasks: Spark sizes them by bytes, of which rows of a few numbers have so few that a task would hold millions of them.
    """
    doomed = present_ids(ids).withColumnRenamed("id", key)
    if hot_owners:
        return skew_join(target, doomed, key, "left_anti", parts=parts)
    if parts:
        target, doomed = target.repartition(parts, key), doomed.repartition(parts, key)
    return target.join(doomed, key, "left_anti")


def cascade_delete(tables: dict[str, DataFrame], specs: list[TableSpec], ids: DataFrame,
                   rows_per_task: int = 0) -> dict[str, DataFrame]:
    """Delete the ids from an entity's table and, by owner column, from its link tables.

    References from the other side (for instance ``work_b_id``) stay. With ``rows_per_task`` the tables are counted and dealt accordingly, for stored
    tables of few bytes a row.
    """
    parts = {s.name: ceil(tables[s.name].count() / rows_per_task) if rows_per_task else 0 for s in specs}
    return {s.name: delete_by_key(tables[s.name], ids, s.owner, s.is_link, parts[s.name]) for s in specs}


def replace_rows(target: DataFrame, new: DataFrame, key: str, changed: DataFrame | None = None,
                 deleted: DataFrame | None = None, hot_owners: bool = False) -> DataFrame:
    """Target without every changed or deleted key, plus the new rows.

    ``changed`` names the records the new rows belong to; it defaults to the keys found in them, but must be given
    for child tables, where a changed record may have no children left. Deletes come before inserts, so an id that is both
    merged away and present as new survives.
    """
    ids = [present_ids(new if changed is None else changed, key if changed is None else "id")]
    if deleted is not None:
        ids.append(present_ids(deleted))
    gone = reduce(DataFrame.unionByName, ids)
    return delete_by_key(target, gone, key, hot_owners).unionByName(new.select(*target.columns))


def exchange_rows(target: DataFrame, new: DataFrame, gone: list[DataFrame], owner: str, place: Column, sub_places: int = 1,
                  hot_owners: bool = False) -> DataFrame:
    """``replace_rows`` with one exchange: target rows, new rows and the ids (``id``) of all changed and deleted owners, brought together by ``place``.

    ``place`` is a function of the owner (the bucket that its rows are stored in); the result has it as a column, its rows are partitioned by it, and go on
    to a write by place as they are. An owner's ids come first among its rows and mark the target rows behind them, so nothing is joined or buffered.
    Each place is dealt over ``sub_places`` tasks by owner; with ``hot_owners``, the rows of an owner that holds many of them over as many as its
    share is worth, each of which gets the ids too.
    """
    ids = reduce(DataFrame.unionByName, [g.select(F.col("id").alias(owner)) for g in gone]).where(F.col(owner).isNotNull())
    part = F.pmod(F.xxhash64(F.lit(1), F.col(owner)), F.lit(sub_places)).cast("int")
    kinds = [df.select("*", F.lit(kind).alias("_kind"), place.alias("_place"), part.alias("_part"))
             for kind, df in enumerate((ids, target, new.select(*target.columns)))]
    if hot_owners:
        heavy = F.broadcast(heavy_keys(target, owner))
        salts = F.coalesce("salts", F.lit(1).cast("long"))
        own = F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in target.columns]), salts)).otherwise(0)
        salt = [F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)), own, own]
        kinds = [df.join(heavy, F.col(owner) == F.col("heavy_key"), "left").select(*df.columns, s.alias("_salt")) for df, s in zip(kinds, salt)]
    else:
        kinds = [df.withColumn("_salt", F.lit(0)) for df in kinds]
    ids, old, fresh = kinds
    rows = old.unionByName(fresh).unionByName(ids, allowMissingColumns=True).repartition("_place", "_part", "_salt")
    # sorted by place and owner first, as a write by place wants them
    by_owner = Window.partitionBy("_place", owner, "_part", "_salt").orderBy("_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = rows.withColumn("_first", F.first("_kind").over(by_owner))
    return marked.where((F.col("_kind") == 2) | (F.col("_kind") == 1) & (F.col("_first") == 1)).select(*target.columns, "_place")


def drop_stale(records: DataFrame, current: DataFrame, key: str = "id", version: str = "updated_date") -> DataFrame:
    """Records that are not older than the current row of the same key.

    ``current`` needs the key and the version column only; a missing version on either side does not make a record stale. Keys that
    hold many of the records are salted.
    """
    known = current.select(F.col(key), F.col(version).alias("_known"))
    return skew_join(records, known, key, "left").where(
        F.coalesce(F.col("_known") <= F.col(version), F.lit(True))).drop("_known")
