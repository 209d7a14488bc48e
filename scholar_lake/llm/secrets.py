"""Secret scans: base patterns, and sliding-window Shannon entropy per character class over candidate strings.

Only built-in functions, no shuffle. Positions come from the lengths of what lies between the matches. A candidate is a maximal run of one
class's characters; its window of WINDOW characters slides by one, and the sum of c*log2(c) over the window's counts changes by the count
of the character that leaves and of the one that comes, so a run costs time in proportion to its length. What the allow-list names is blanked
before runs are cut out, so it suppresses the windows that it touches and no others. Method spans inside a base span are left out; base spans
always stay.

Defined results: null text is empty; equal rows give equal rows; spans at one start are in the order of KINDS; an empty table gives an
empty table; input columns that bear the name of a computed one are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from scholar_lake.functions.abstracts import bind


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LONG = ASSIGN[:-2] + "{8,})"
ACCESS = "AKIA[A-Z0-9]{12,}"  # as AKIA[A-Z0-9]+ of 16 characters and more: a run's first AKIA takes all of the run
HEX = "[0-9a-f]{32,}"  # as runs of 32 and more

WINDOW = 24
PART = 256
_THREE_DIGITS = "[0-9][^0-9]*[0-9][^0-9]*[0-9]"
#: Class: its characters, the least entropy in bits of a suspicious window, and what a run must contain.
CLASSES = {
    "entropy_hex": ("0-9A-Fa-f", 3.0, ("[0-9]", "[A-Fa-f]")),
    "entropy_base64": ("A-Za-z0-9+/_=-", 4.0, ("[0-9]", "[A-Z]", "[a-z]")),
    "entropy_lower": ("a-z0-9", 3.7, (_THREE_DIGITS, "[a-z]")),
    "entropy_upper": ("A-Z0-9", 3.7, (_THREE_DIGITS, "[A-Z]")),
}
#: Patterns of what is long and mixed, yet no secret, each with the number of characters that it takes; applied in this order.
ALLOWED = (
    ("[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}", 36), ("[0-9]{4}-[0-9]{2}-[0-9]{2}", 10), (_either_case("sha") + "(256|384|512)-", 7),
    *[(_either_case(word), len(word)) for word in ("example", "placeholder", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz")],
)
KINDS = ("assign", "access", "hex", *CLASSES)
ANY_CLASS = "A-Za-z0-9+/_=-"  # the characters of all classes
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def matches(text: Column, pattern: str, guard: str | None = None) -> Column:
    """Leftmost non-overlapping matches as an array of (start, hit), start in code points. Texts without a match of guard give none.

    Starts are added up within parts of PART matches, then over the parts: an array that grows by a match a step is copied in each.
    """
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, hit: F.struct(F.length(gap).cast("bigint").alias("gap"), hit.alias("hit")))
    none = F.array().cast("array<struct<start:bigint,hit:string>>")

    def step(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + x["gap"]
        more = F.concat(so_far["found"], F.array(F.struct(start.alias("start"), x["hit"].alias("hit"))))
        return F.struct((start + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
                        F.when(x["hit"].isNull(), so_far["found"]).otherwise(more).alias("found"))

    def in_parts(all_pairs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_pairs) - 1) / PART).cast("int")), lambda i: F.aggregate(
            F.slice(all_pairs, i * PART + 1, PART), F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found")), step))

    def joined(parts: Column) -> Column:
        begins = F.aggregate(parts, F.array(F.lit(0).cast("bigint")), lambda b, p: F.concat(b, F.array(F.element_at(b, -1) + p["at"])))
        return bind(begins, lambda b: F.flatten(F.transform(parts, lambda p, j: F.transform(p["found"], lambda m: F.struct(
            (m["start"] + F.get(b, j)).alias("start"), m["hit"].alias("hit"))))))
    return F.when(text.rlike(guard or pattern), bind(bind(pairs, in_parts), joined)).otherwise(none)


def _spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                                 (m["start"] + F.length(m["hit"])).alias("end"))).cast(SPAN)


def _times_log(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def _count(window: Column, character: Column) -> Column:
    return (F.length(window) - F.length(F.replace(window, character, F.lit("")))).cast("double")


def hot_stretch(run: Column, least: float, window: int = WINDOW) -> Column:
    """(first, last): where the first window of at least that entropy begins and the last one ends, in the run; first is null if none."""
    start = F.struct(F.lit("").alias("win"), F.lit(0).alias("n"), F.lit(0.0).alias("total"),
                     F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

    def leave(s: Column) -> tuple[Column, Column]:
        full = F.length(s["win"]) == window
        count = _count(s["win"], F.substring(s["win"], 1, 1))
        return (F.when(full, F.substring(s["win"], 2, window)).otherwise(s["win"]),
                F.when(full, s["total"] - _times_log(count) + _times_log(count - 1)).otherwise(s["total"]))

    def slide(s: Column, x: Column) -> Column:
        rest, total = leave(s)
        count = _count(rest, x)
        return F.struct(F.concat(rest, x).alias("win"), (s["n"] + 1).alias("n"),
                        (total - _times_log(count) + _times_log(count + 1)).alias("total"), s["first"].alias("first"),
                        s["last"].alias("last"))

    def mark(s: Column) -> Column:
        hot = (s["n"] >= window) & (F.lit(math.log2(window)) - s["total"] / window >= least - 1e-9)
        return F.struct(s["win"].alias("win"), s["n"].alias("n"), s["total"].alias("total"),
                        F.when(s["first"].isNull() & hot, s["n"] - window).otherwise(s["first"]).alias("first"),
                        F.when(hot, s["n"]).otherwise(s["last"]).alias("last"))
    slid = F.aggregate(F.split(run, ""), start,
                       lambda s, x: F.element_at(F.transform(F.array(slide(s, x)), mark), 1))
    return F.struct(slid["first"].alias("first"), slid["last"].alias("last"))


def blanked(text: Column, allowed: tuple[tuple[str, int], ...] = ALLOWED) -> Column:
    """text with spaces in place of what is allowed; empty where no run of any class is long enough."""
    left = text
    for pattern, length in allowed:
        left = F.regexp_replace(left, pattern, " " * length)
    return F.when(text.rlike(f"[{ANY_CLASS}]{{{WINDOW}}}"), left).otherwise(F.lit(""))


def entropy_spans(text: Column, kind: str, window: int = WINDOW) -> Column:
    """Spans of one class in a text without what is allowed."""
    characters, least, needs = CLASSES[kind]
    runs = matches(text, f"(?<![{characters}])[{characters}]{{{window},}}+")

    def suspicious(m: Column) -> Column:
        ok = F.lit(True)
        for need in needs:
            ok = ok & m["hit"].rlike(need)
        return ok
    hot = F.transform(F.filter(runs, suspicious), lambda m: F.struct(m["start"].alias("start"), hot_stretch(m["hit"], least, window).alias("hot")))
    return F.transform(F.filter(hot, lambda m: m["hot"]["first"].isNotNull()), lambda m: F.struct(
        (m["start"] + m["hot"]["first"]).alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
        (m["start"] + m["hot"]["last"]).alias("end"))).cast(SPAN)


def find_secrets(docs: DataFrame, text: str = "text", allowed: tuple[tuple[str, int], ...] = ALLOWED) -> DataFrame:
    """docs with ``base_spans`` and ``method_spans``: arrays of (start, kind as a place in KINDS, end), sorted."""
    whole = F.coalesce(F.col(text), F.lit(""))
    assigned = F.filter(matches(whole, ASSIGN, ASSIGN_LONG), lambda m: F.length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= 8)
    base = F.array_sort(F.concat(_spans(assigned, "assign"), _spans(matches(whole, ACCESS), "access"), _spans(matches(whole, HEX), "hex")))
    with_base = docs.withColumns({"base_spans": base, "method_text": blanked(whole, allowed)})
    with_base = with_base.withColumn("method_all", F.concat(*[entropy_spans(F.col("method_text"), k) for k in CLASSES]))
    alone = F.filter("method_all", lambda s: ~F.exists("base_spans", lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"])))
    return with_base.withColumn("method_spans", F.array_sort(alone)).drop("method_all", "method_text")


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
