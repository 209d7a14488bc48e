"""Chat formatting: schema fingerprints pick declared mappings to canonical turns, which a reversible template renders with a loss mask.

Only built-in functions. The nested field paths of a JSON record that some layout names are joined and hashed, and the hash selects the
mapping in LAYOUTS; adding a layout is adding an entry there. Fields that no layout names are not looked at. The columns of a table are
fingerprinted in the same way.

Defined results: null roles and texts are empty; a record that is null, not JSON or of an unknown set of paths has a null layout and no
turns, and ``rejects`` returns it; turns of one number are ordered by role, then text; a null conversation id is a conversation of its
own; an empty table gives an empty table; columns outside the layout are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

HEAD, COLON, END = "### ", ": ", "</turn>\n"
#: Characters of control strings, and what stands for them inside roles and texts. The backslash comes first.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))

#: Either (role, path) pairs in order, or a list's path with the paths of role and text inside. The paths are the layout's fingerprint.
LAYOUTS = {
    "prompt": [("user", "$.prompt"), ("assistant", "$.completion")],
    "question": [("user", "$.question"), ("assistant", "$.answer")],
    "instruction": [("user", "$.instruction"), ("assistant", "$.output")],
    "instruction_input": [("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")],
    "instruction_system": [("system", "$.system"), ("user", "$.instruction"), ("assistant", "$.output")],
    "messages": ("$.messages", "$.role", "$.content"),
    "nested_messages": ("$.data.messages", "$.role", "$.content"),
    "from_value": ("$.conversations", "$.from", "$.value"),
}
TURN_ROWS = ("conv_id", "role", "text", "turn")
TURNS = "array<struct<role:string,text:string>>"
#: A record that is made of turn rows has so many turns at most, of so many bytes together.
RECORD_TURNS, LARGEST = 8, 8 << 20
#: Other names of roles, in layouts with a list.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256(",".join(sorted(paths)).encode()).hexdigest()


def paths_of(mapping) -> list[str]:
    """The nested field paths that a mapping reads; a list's fields come after ``[]``."""
    if isinstance(mapping, list):
        return [path for _, path in mapping]
    many, *inner = mapping
    return [many + "[]" + path[1:] for path in inner]


def record_print(value: Column, layouts: dict = LAYOUTS) -> Column:
    """The hash of those paths of the layouts that a record (a variant) has; a list has a path if one of its items does."""
    def held(path: str) -> Column:
        if "[]" not in path:
            return F.try_variant_get(value, path, "variant").isNotNull()
        many, inner = path.split("[]")
        items = F.try_variant_get(value, many, "array<variant>")
        return F.coalesce(F.exists(items, lambda item: F.try_variant_get(item, "$" + inner, "variant").isNotNull()), F.lit(False))
    known = sorted({path for mapping in layouts.values() for path in paths_of(mapping)})
    return F.sha2(F.concat_ws(",", *[F.when(held(path), path) for path in known]), 256)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _turns(value: Column, mapping) -> Column:
    if isinstance(mapping, list):
        return F.array(*[_turn(F.lit(role), F.try_variant_get(value, path, "string")) for role, path in mapping])
    many, role, text = mapping
    items = F.try_variant_get(value, many, "array<variant>")

    def one(item: Column) -> Column:
        named = F.try_variant_get(item, role, "string")
        for other, name in ROLE_NAMES.items():
            named = F.when(named == other, name).otherwise(named)
        return _turn(named, F.try_variant_get(item, text, "string"))
    return F.transform(items, one)


def turns_of_records(df: DataFrame, record: str, layouts: dict = LAYOUTS) -> DataFrame:
    """df with ``layout`` and ``turns`` (role, text), from JSON texts of any of the layouts, row by row."""
    value, seen = F.col("layout_value"), F.col("layout_print")
    marked = df.withColumn("layout_value", F.try_parse_json(record)).withColumn("layout_print", record_print(value, layouts))
    name, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for layout, mapping in layouts.items():
        hit = seen == fingerprint(paths_of(mapping))
        name, turns = F.when(hit, layout).otherwise(name), F.when(hit, _turns(value, mapping)).otherwise(turns)
    return marked.withColumn("turns", turns).withColumn("layout", name).drop("layout_value", "layout_print")


def rejects(records: DataFrame) -> DataFrame:
    """The rows of turns_of_records that no layout fits."""
    return records.where("layout IS NULL").drop("layout", "turns")


def turns_of_table(df: DataFrame) -> DataFrame:
    """One row per turn (conv_id, ordinal from 0, role, text), from a table with columns of the fingerprint of turn rows, in any order and among others,
    or from turns_of_records with a column conv_id, and with first_ordinal where a conversation has several records."""
    if fingerprint(c for c in df.columns if c in TURN_ROWS) == fingerprint(TURN_ROWS):
        order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
        return df.select("conv_id", (F.row_number().over(order) - 1).alias("ordinal"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    if {"conv_id", "turns"} <= set(df.columns):
        first = F.col("first_ordinal") if "first_ordinal" in df.columns else F.lit(0)
        each = df.select("conv_id", first.alias("first"), F.posexplode("turns").alias("place", "turn"))
        return each.select("conv_id", (F.col("first") + F.col("place")).alias("ordinal"), "turn.role", "turn.text")
    raise ValueError(f"no mapping for the columns {df.columns}")


def write_record(turns: Column, mapping) -> Column:
    """The JSON text of turns in a layout: what _turns reads back."""
    def nested(path: str, value: Column) -> Column:
        for field in reversed(path[2:].split(".")):
            value = F.struct(value.alias(field))
        return value
    if isinstance(mapping, list):
        return F.to_json(F.struct(*[F.get(turns, F.lit(i))["text"].alias(path[2:]) for i, (_, path) in enumerate(mapping)]))
    many, role, text = mapping
    return F.to_json(nested(many, F.transform(turns, lambda t: F.struct(t["role"].alias(role[2:]), t["text"].alias(text[2:])))))


def records_of_turns(turns: DataFrame, layouts: dict = LAYOUTS) -> DataFrame:
    """Turn rows (conv_id, ordinal, role, text) as JSON records of the layouts: conv_id, first_ordinal, ``record`` and ``rest``.

    A record holds RECORD_TURNS turns in a row, or the conversation's last ones. A layout with fixed roles takes turns of just these roles, a layout
    with a list any; the record's hash picks one of those that fit. Turns of more than LARGEST bytes together (a variant has a size limit) and
    those with a role that a layout would rename are no record; they stay as they are, in ``rest``, which is null for all others.
    """
    one = F.struct("ordinal", F.struct("role", "text").alias("turn"))
    parts = turns.groupBy("conv_id", F.expr(f"ordinal div {RECORD_TURNS}").alias("part")).agg(F.array_sort(F.collect_list(one)).alias("all"),
                                                                                F.sum(F.octet_length("role") + F.octet_length("text")).alias("octets"))
    parts = parts.select("conv_id", (F.col("part") * RECORD_TURNS).alias("first_ordinal"), F.transform("all", lambda x: x["turn"]).alias("said"), "octets")
    said, roles = F.col("said"), F.transform("said", lambda t: t["role"])
    fixed, lists = {}, []
    for mapping in layouts.values():
        if isinstance(mapping, list):
            fixed.setdefault(tuple(role for role, _ in mapping), []).append(mapping)
        else:
            lists.append(mapping)

    def dealt(mappings: list) -> Column:
        turn = F.pmod(F.xxhash64("conv_id", "first_ordinal"), F.lit(len(mappings)))
        chosen = write_record(said, mappings[-1])
        for i, mapping in enumerate(mappings[:-1]):
            chosen = F.when(turn == i, write_record(said, mapping)).otherwise(chosen)
        return chosen
    record = dealt(lists)
    for names, mappings in fixed.items():
        record = F.when(roles == F.array(*[F.lit(r) for r in names]), dealt(mappings)).otherwise(record)
    rest = (F.col("octets") > LARGEST) | F.exists(roles, lambda r: r.isin(*ROLE_NAMES))
    return parts.select("conv_id", "first_ordinal", F.when(~rest, record).alias("record"), F.when(rest, said).alias("rest"))


def through_records(turns: DataFrame) -> DataFrame:
    """Turn rows written as records of the layouts and mapped back by fingerprint."""
    mapped = turns_of_records(records_of_turns(turns), "record")
    return turns_of_table(mapped.withColumn("turns", F.coalesce("rest", "turns")))


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chats(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, ``formatted`` and ``loss_spans`` (start, length in code points of formatted).

    Offsets are running sums over the conversation's turns, so a conversation is gathered once, as the text it becomes.
    """
    head = F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(COLON))
    pieces = (turns.withColumn("chat_head", head).withColumn("chat_body", escape(F.col("text")))
              .withColumn("chat_chars", (F.length("chat_head") + F.length("chat_body") + len(END)).cast("long")))
    before = Window.partitionBy("conv_id").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("chat_chars").over(before), F.lit(0)) + F.length("chat_head")
    piece = F.struct("ordinal", F.concat("chat_head", "chat_body", F.lit(END)).alias("piece"), (F.col("role") == learn).alias("learn"),
                     start.alias("start"), F.length("chat_body").cast("long").alias("length"))
    chats = pieces.withColumn("chat_piece", piece).groupBy("conv_id").agg(F.array_sort(F.collect_list("chat_piece")).alias("all"))
    return chats.select(
        "conv_id", F.array_join(F.transform("all", lambda p: p["piece"]), "").alias("formatted"),
        F.transform(F.filter("all", lambda p: p["learn"]),
                    lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"))).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation. Escaped text has no < and no #, so the end mark is never part of one."""
    pieces = F.split(formatted, END, -1)
    whole = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def one(piece: Column) -> Column:
        colon = F.locate(COLON, piece)
        role = F.substring(piece, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1)
        return F.struct(unescape(role).alias("role"),
                        unescape(F.substring(piece, colon + len(COLON), F.length(piece))).alias("text"))
    return F.transform(whole, one)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    cuts = F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(cuts, "")
