"""Text analysis shared by indexing and querying."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, functions as F

#: Runs of letters and digits.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def tokenize(text: Column) -> Column:
    """Lower-cased tokens in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


#: Letters of scripts that put spaces between words, and marks that belong to the character before them.
_LETTER = r"(?:[\p{L}\p{Nl}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsMyanmar}\p{IsKhmer}]][\p{M}\p{Cf}]*+)"
_DIGIT = r"(?:\p{Nd}[\p{M}\p{Cf}]*+)"
#: Fixed values of the Unicode word break rules: what may stand between two letters, between two digits, and what joins words.
_IN_WORDS, _IN_NUMBERS, _JOINS = r"['’‘.:·․‧︓﹕．＇]", r"['’‘.,;․﹐﹔，．；＇]", r"[\p{Pc}]"
_UNIT = f"(?:{_LETTER}++(?:{_IN_WORDS}{_LETTER}++)*+|{_DIGIT}++(?:{_IN_NUMBERS}{_DIGIT}++)*+)"
#: One token: letters and digits with inner signs, a run of Katakana, one ideograph or Hiragana sign, or a run of a script without spaces.
WORD_PATTERN = (f"{_JOINS}*+{_UNIT}(?:{_JOINS}*+{_UNIT})*+{_JOINS}*+|(?:[\\p{{IsKatakana}}ー]\\p{{M}}*+)++|[\\p{{IsHan}}\\p{{IsHiragana}}]\\p{{M}}*+"
                r"|[\p{L}\p{M}]++")


def tokenize_words(text: Column) -> Column:
    """Lower-cased tokens by the Unicode word break rules, in order: "can't" and "3,000.5" are one token each, every ideograph is one.

    A pattern without backtracking: all its repetitions are possessive, so long texts take time in proportion.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def drop_stop_words(tokens: Column, stop_words: Iterable[str] = ()) -> Column:
    """Tokens without stop words (given in any case)."""
    stops = sorted({word.lower() for word in stop_words})
    return F.filter(tokens, lambda t: ~t.isin(stops)) if stops else tokens


class Form(NamedTuple):
    """One way to say a term: its width in tokens, and its words with their places in it (stop words leave gaps)."""

    width: int
    words: tuple[tuple[int, str], ...]


class Term(NamedTuple):
    """A term of a query: the place of its first token, how many tokens it takes there, and its forms, the query's own first."""

    offset: int
    width: int
    forms: tuple[Form, ...]


def query_tokens(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def analyze_query(query: str, stop_words: Iterable[str] = (), synonyms: Mapping[str, Iterable[str]] | None = None) -> list[Term]:
    """Terms of a query string with their synonyms, in order. Runs on the driver: a query is one short line.

    Synonyms are found before stop words go, may have several words on either side, and the longest one that fits wins. As in postings, stop
    words leave a gap.
    """
    stops = {word.lower() for word in stop_words}
    wider: dict[tuple[str, ...], list[list[str]]] = {}
    for said, others in (synonyms or {}).items():
        wider.setdefault(tuple(query_tokens(said)), []).extend(query_tokens(other) for other in others)
    longest = max(map(len, wider), default=0)
    tokens, terms, at = query_tokens(query), [], 0
    while at < len(tokens):
        width = next((n for n in range(min(longest, len(tokens) - at), 0, -1) if tuple(tokens[at:at + n]) in wider), 1)
        said = tokens[at:at + width]
        forms = [Form(len(f), tuple((i, w) for i, w in enumerate(f) if w not in stops)) for f in [said, *wider.get(tuple(said), [])]]
        kept = tuple(dict.fromkeys(f for f in forms if f.words))
        if kept:
            terms.append(Term(at, width, kept))
        at += width
    return terms


def phrases(terms: list[Term]) -> list[tuple[tuple[int, str], ...]]:
    """Every way to say the whole query: words with their places, where a longer or shorter form moves what follows."""
    ways = []
    for forms in product(*[term.forms for term in terms]):
        moved, way = 0, []
        for term, form in zip(terms, forms):
            way += [(term.offset + moved + i, word) for i, word in form.words]
            moved += form.width - term.width
        first = way[0][0] if way else 0
        ways.append(tuple((place - first, word) for place, word in way))
    return list(dict.fromkeys(way for way in ways if way))


def occurrences(tokens: Column, form: Form) -> Column:
    """How often a form occurs in a row's tokens, which should be bound (a lambda would compute them again for each token)."""
    first, word = form.words[0]
    if len(form.words) == 1:
        return F.size(F.filter(tokens, lambda t: t == word))
    return F.size(F.filter(tokens, lambda t, i: reduce(
        Column.__and__, [F.coalesce(F.get(tokens, i + place - first) == w, F.lit(False)) for place, w in form.words])))


def has_any(tokens: Column, terms: list[Term]) -> Column:
    """Whether any query term occurs, in any form."""
    forms = list(dict.fromkeys(form for term in terms for form in term.forms))
    single = sorted({form.words[0][1] for form in forms if len(form.words) == 1})
    found = [F.exists(tokens, lambda t: t.isin(single))] if single else []
    return reduce(Column.__or__, found + [occurrences(tokens, form) > 0 for form in forms if len(form.words) > 1], F.lit(False))
