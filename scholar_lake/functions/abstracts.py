"""Abstracts are delivered as inverted indexes: token -> positions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INDEX_TYPE = "map<string,array<int>>"


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body`` (a lambda body is otherwise re-evaluated
    for every element it visits, which would make the functions below quadratic)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def read_index(raw: Column) -> Column:
    """Index from its raw JSON: either the map itself or the older ``{IndexLength, InvertedIndex}`` document.

    Text that is neither gives null. The older reading is tried only where its key occurs at all. A token may itself be
    called InvertedIndex: its value is then a list, the older reading fails on it and the plain one applies.
    """
    older = F.from_json(raw, f"IndexLength int, InvertedIndex {INDEX_TYPE}")["InvertedIndex"]
    return F.coalesce(F.when(raw.contains('"InvertedIndex"'), older), F.from_json(raw, INDEX_TYPE))


def rebuild_abstract(index: Column) -> Column:
    """Text of an inverted index.

    There are as many slots as positions in the whole index. Every token goes to its positions, those outside
    the slots are dropped, a later token wins a contested slot, unused slots stay empty, and the slots are joined by
    one blank. Position and token number are packed into one bigint, so that what is sorted (n log n) is plain numbers: a slot's winner is
    the last of its position, and the blanks in front of it are the distance from the previous winner.
    """
    packed = F.flatten(F.transform(F.map_values(index), lambda positions, number: F.transform(
        positions, lambda position: F.shiftleft(position.cast("bigint"), 32).bitwiseOR(number.cast("bigint")))))

    def text(all_places: Column) -> Column:
        slots = F.size(all_places)
        ordered = F.sort_array(F.filter(all_places, lambda p: (p >= 0) & (_position(p) < slots)))
        return bind(ordered, lambda o: bind(_last_per_position(o), lambda w: bind(F.map_keys(index), lambda t: _spell(w, t, slots))))

    return bind(packed, text)


def _position(packed: Column) -> Column:
    return F.shiftright(packed, 32).cast("int")


def _last_per_position(ordered: Column) -> Column:
    # get() is null past the end, and null-safe equality then keeps the last number
    return F.filter(ordered, lambda p, i: ~_position(F.get(ordered, i + 1)).eqNullSafe(_position(p)))


def _spell(winners: Column, tokens: Column, slots: Column) -> Column:
    words = F.transform(winners, lambda p, i: F.concat(
        F.repeat(F.lit(" "), _position(p) - F.coalesce(_position(F.get(winners, i - 1)), F.lit(0))),
        F.get(tokens, p.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))))
    last = F.coalesce(_position(F.get(winners, F.size(winners) - 1)), F.lit(0))
    return F.concat(F.array_join(words, ""), F.repeat(F.lit(" "), slots - 1 - last))


def blank_to_null(text: Column) -> Column:
    """Null unless the text has at least one character that is not white space (Unicode sense)."""
    return bind(text, lambda t: F.when(t.rlike(r"(?U)\S"), t))


def abstract_text(raw: Column) -> Column:
    """Abstract of a work from its raw index field; blank or unreadable ones are null."""
    return blank_to_null(rebuild_abstract(read_index(raw)))


def build_index(tokens: Column) -> Column:
    """Inverted index of a token list (null for an empty one): the inverse of :func:`rebuild_abstract`."""
    pairs = F.sort_array(F.transform(tokens, lambda t, i: F.struct(t.alias("tok"), i.alias("pos"))))

    def grouped(p: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(p) - 1),
                          lambda i: ~F.get(p, i - 1)["tok"].eqNullSafe(F.get(p, i)["tok"]))
        return bind(starts, lambda s: F.map_from_arrays(
            F.transform(s, lambda i: F.get(p, i)["tok"]),
            F.transform(s, lambda i, k: F.transform(
                F.slice(p, i + 1, F.coalesce(F.get(s, k + 1), F.size(p)) - i), lambda x: x["pos"]))))

    return F.when(F.size(tokens) > 0, bind(pairs, grouped))
