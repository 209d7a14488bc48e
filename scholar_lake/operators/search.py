"""Search documents, their postings, and keyword queries.

Postings ``(token, id, pos)`` are made from the documents by the query that needs them, for its own words only, so all that is spread out or
shuffled are hits. All aggregates group by document (or by document and start position) and combine on the map side first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from scholar_lake.functions.abstracts import abstract_text, bind
from scholar_lake.functions.casting import conform, empty_as_null
from scholar_lake.functions.documents import authorships_json, biblio_json, locations_json, title_abstract
from scholar_lake.functions.ids import strip_id
from scholar_lake.functions.text import Term, drop_stop_words, occurrences, phrases, tokenize
from scholar_lake.schemas import SEARCH_TABLE

Terms = list[Term]


def search_documents(records: DataFrame) -> DataFrame:
    """One search document per work."""
    with_abstract = records.select("*", abstract_text(F.col("abstract_inverted_index")).alias("abstract"))
    return empty_as_null(conform(with_abstract.select(
        strip_id(F.col("id")).alias("id"), "display_name", "title", "abstract",
        title_abstract(F.col("title"), F.col("abstract")).alias("title_abstract"),
        authorships_json(F.col("authorships")).alias("authorships"), biblio_json(F.col("biblio")).alias("biblio"),
        "cited_by_count", "created_date", "doi", F.col("ids.mag").cast("string").alias("mag"),
        F.col("ids.pmid").alias("pmid"), F.col("ids.pmcid").alias("pmcid"), "is_oa", "is_paratext", "is_retracted",
        "language", locations_json(F.col("primary_location"), F.col("locations")).alias("locations"),
        "publication_date", "publication_year", "type", "updated_date"), SEARCH_TABLE.columns))


def _words(terms: Terms) -> list[str]:
    return sorted({word for term in terms for form in term.forms for _, word in form.words})


def postings(docs: DataFrame, text: str, id: str = "id", stop_words: tuple[str, ...] = (),
             terms: Terms | None = None) -> DataFrame:
    """``token, id, pos`` of a text column. Stop words leave gaps in the positions.

    With ``terms`` only the postings of those words are produced: the rest is dropped inside the row, before it
    is spread out.
    """
    found = F.transform(tokenize(F.col(text)), lambda t, i: F.struct(t.alias("token"), i.alias("pos")))
    stops = sorted({w.lower() for w in stop_words})
    if stops:
        found = F.filter(found, lambda p: ~p["token"].isin(stops))
    if terms is not None:
        wanted = _words(terms)
        found = F.filter(found, lambda p: p["token"].isin(wanted))
        # a plain substring search is much cheaper than tokenizing texts that cannot have a hit
        docs = docs.where(reduce(Column.__or__, [F.lower(F.col(text)).contains(word) for word in wanted], F.lit(False)))
    each = docs.select(F.col(id).alias("id"), F.explode(found).alias("p"))
    return each.select(F.col("p.token").alias("token"), "id", F.col("p.pos").alias("pos"))


def document_lengths(docs: DataFrame, text: str, id: str = "id", stop_words: tuple[str, ...] = ()) -> DataFrame:
    """``id, length`` in tokens, for documents that have the text."""
    length = F.size(drop_stop_words(tokenize(F.col(text)), stop_words))
    return docs.where(F.col(text).isNotNull()).select(F.col(id).alias("id"), length.alias("length"))


def matches(index: DataFrame, ways: list[tuple[tuple[int, str], ...]]) -> DataFrame:
    """``id, way, start`` of every place where one of the ways, each a list of words with their places, occurs.

    A posting of a word with place k at position p votes for a start at p - k; a start with all votes of a way is a match. No
    posting meets another one, so frequent tokens cost one row each and not one pair.
    """
    by_word: dict[str, list[tuple[int, int]]] = {}
    for number, way in enumerate(ways):
        for place, word in way:
            by_word.setdefault(word, []).append((number, place))
    if not by_word:
        return index.select("id", F.lit(0).alias("way"), F.col("pos").alias("start")).where(F.lit(False))
    pairs = [x for word, votes in by_word.items()
             for x in (F.lit(word), F.array(*[F.struct(F.lit(n).alias("way"), F.lit(k).alias("k")) for n, k in votes]))]
    each = index.where(F.col("token").isin(sorted(by_word))).select("id", "pos", F.explode(F.create_map(*pairs)[F.col("token")]).alias("v"))
    each = each.select("id", F.col("v.way").alias("way"), (F.col("pos") - F.col("v.k")).alias("start"))
    long = {number: len(way) for number, way in enumerate(ways) if len(way) > 1}
    if not long:
        return each
    needed = F.create_map(*[F.lit(x) for pair in long.items() for x in pair])
    starts = each.where(F.col("way").isin(list(long))).groupBy("id", "way", "start").agg(F.count("*").alias("n"))
    return each.where(~F.col("way").isin(list(long))).unionByName(
        starts.where(F.col("n") == needed[F.col("way")]).select("id", "way", "start"))


def term_matches(index: DataFrame, terms: Terms) -> DataFrame:
    """``id, term, start``: every occurrence of a term, in any form. ``term`` is its number in the list."""
    ways = [(number, form.words) for number, term in enumerate(terms) for form in term.forms]
    found = matches(index, [words for _, words in ways])
    if not ways:
        return found.withColumnRenamed("way", "term")
    return found.select("id", F.get(F.array(*[F.lit(n) for n, _ in ways]), F.col("way")).alias("term"), "start")


def distinct_terms(terms: Terms) -> Terms:
    return list({term.forms: term for term in terms}.values())


def match_any(index: DataFrame, terms: Terms) -> DataFrame:
    """Ids of documents with at least one of the terms."""
    return term_matches(index, terms).select("id").distinct()


def match_all(index: DataFrame, terms: Terms) -> DataFrame:
    """Ids of documents with every term."""
    terms = distinct_terms(terms)
    hits = term_matches(index, terms)
    return hits.groupBy("id").agg(F.size(F.collect_set("term")).alias("n")).where(F.col("n") == len(terms)).select("id")


def match_phrase(index: DataFrame, terms: Terms) -> DataFrame:
    """``id, start`` of every place where the terms follow one another as in the query, gaps of stop words included."""
    ways = phrases(terms)
    found = matches(index, ways).select("id", "start")
    return found if len(ways) == 1 else found.distinct()


def phrase_places(docs: DataFrame, text: str, terms: Terms, id: str = "id") -> DataFrame:
    """``id, start`` as by ``match_phrase``, found inside each document's row: nothing is shuffled."""
    ways = phrases(terms)

    def places(tokens: Column, way: tuple[tuple[int, str], ...]) -> Column:
        def start(token: Column, i: Column) -> Column:
            others = [F.get(tokens, i + place) == word for place, word in way[1:]]
            return F.when(reduce(Column.__and__, [token == way[0][1], *others]), i)
        return F.filter(F.transform(tokens, start), lambda x: x.isNotNull())

    def starts(tokens: Column) -> Column:
        each = [places(tokens, way) for way in ways]
        return F.array_distinct(F.concat(*each)) if len(each) > 1 else each[0]
    if not ways:
        return docs.select(F.col(id).alias("id"), F.lit(0).alias("start")).where("false")
    lower = F.lower(F.col(text))
    able = reduce(Column.__or__, [reduce(Column.__and__, [lower.contains(word) for _, word in way]) for way in ways])
    return docs.where(able).select(F.col(id).alias("id"), F.explode(bind(tokenize(F.col(text)), starts)).alias("start"))


def near(docs: DataFrame, text: str, terms: Terms, slop: int, id: str = "id") -> DataFrame:
    """``id, start, width``: documents in which all terms (single words or synonyms of one word) stand within a window of at most ``slop`` more tokens than
    there are terms; the smallest window, the first of equal ones.

    The hits of a document are walked once; of each term the last place is kept, and each hit closes a window that starts at the least of them.
    """
    words = [sorted({form.words[0][1] for form in term.forms if len(form.words) == 1}) for term in distinct_terms(terms)]
    n = len(words)
    if not n or not all(words):
        raise ValueError("every term needs a form of one word")
    hits = F.filter(F.transform(tokenize(F.col(text)), lambda t, i: F.struct(
        i.alias("pos"), F.array(*[t.isin(w) for w in words]).alias("is_term"))), lambda h: F.exists(h["is_term"], lambda x: x))
    nothing = F.struct(F.array_repeat(F.lit(-1), n).alias("last"), F.lit(-1).alias("start"), F.lit(2 ** 31 - 1).alias("width"))

    def walk(state: Column, hit: Column) -> Column:
        last = F.transform(state["last"], lambda p, i: F.when(F.get(hit["is_term"], i), hit["pos"]).otherwise(p))
        return bind(last, lambda places: bind(F.array_min(places), lambda least: F.when(
            (least >= 0) & (hit["pos"] - least + 1 < state["width"]),
            F.struct(places.alias("last"), least.alias("start"), (hit["pos"] - least + 1).alias("width")))
            .otherwise(F.struct(places.alias("last"), state["start"].alias("start"), state["width"].alias("width")))))
    lower = F.lower(F.col(text))
    able = reduce(Column.__and__, [reduce(Column.__or__, [lower.contains(word) for word in w]) for w in words])
    best = docs.where(able).select(F.col(id).alias("id"), F.aggregate(hits, nothing, walk).alias("w"))
    return best.where(F.col("w.width") <= n + slop).select("id", F.col("w.start").alias("start"), F.col("w.width").alias("width"))


def search_fields(docs: DataFrame, weights: dict[str, float], terms: Terms, id: str = "id", every: bool = False, k: int = 10, k1: float = 1.2,
                  b: float = 0.75) -> DataFrame:
    """The k best documents over several fields: ``id, score``, ties by id; with ``every`` only documents in which each term occurs in some field.

    A term's frequencies are normed by each field's mean length, weighted, and added up before they are saturated (BM25 over fields). A document counts once in a term's
    document frequency, in whatever field it has the term. One pass: lengths and frequencies are counted inside each row by field, and only they go on.
    """
    terms = distinct_terms(terms)
    names, numbers = list(weights), range(len(terms))

    def counts(tokens: Column) -> Column:
        per_term = [sum((occurrences(tokens, form) for form in term.forms), F.lit(0)) for term in terms]
        return F.struct(F.size(tokens).alias("length"), F.array(*per_term).alias("tf"))

    def no_text(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit(""))
    counted = docs.select(F.col(id).alias("id"), *[bind(tokenize(no_text(F.col(f"`{f}`"))), counts).alias(f"c{i}") for i, f in enumerate(names)])
    fields = range(len(names))
    narrow = counted.select("id", F.array(*[F.col(f"c{i}.length") for i in fields]).alias("lengths"),
                            F.array(*[F.col(f"c{i}.tf") for i in fields]).alias("tf")).repartition("id")

    def has(t: int) -> Column:
        return reduce(Column.__or__, [F.col("tf")[i][t] > 0 for i in fields])
    stats = narrow.agg(F.struct(
        F.count("*").cast("double").alias("n"), F.array(*[F.avg(F.col("lengths")[i]) for i in fields]).alias("means"),
        F.array(*[F.count(F.when(has(t), 1)).cast("double") for t in numbers]).alias("df")).alias("s")).scalar()
    hits = narrow.where(reduce(Column.__and__ if every else Column.__or__, [has(t) for t in numbers], F.lit(every)))
    scored = hits.select("*", stats.alias("s"))

    def score(t: int) -> Column:
        idf = F.log(1 + (F.col("s.n") - F.col("s.df")[t] + 0.5) / (F.col("s.df")[t] + 0.5))
        weighted = sum((F.lit(float(weights[f])) * F.col("tf")[i][t] / (1 - b + b * F.col("lengths")[i] / F.greatest(F.col("s.means")[i], F.lit(1e-9)))
                        for i, f in enumerate(names)), F.lit(0.0))
        return idf * weighted * (k1 + 1) / (weighted + k1)
    return scored.select("id", sum((score(t) for t in numbers), F.lit(0.0)).alias("score")).orderBy(F.desc("score"), "id").limit(k)


def bm25(index: DataFrame, lengths: DataFrame, terms: Terms, k: int = 10, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The k best documents for the terms: ``id, score`` by the published BM25 formula, ties by id.

    Term frequencies are counted per (document, term) from postings and joined with the documents' lengths. Document frequencies (one row)
    and the collection's size and mean length (one row) are scalar subqueries.
    """
    terms = distinct_terms(terms)
    frequencies = term_matches(index, terms).groupBy("id", "term").agg(F.count("*").alias("tf"))
    doc_counts = frequencies.agg(F.array(*[
        F.count(F.when(F.col("term") == n, 1)) for n in range(len(terms))]).alias("df")).scalar()
    collection = lengths.agg(F.struct(F.count("*").cast("double").alias("n"),
                                      F.avg("length").alias("mean")).alias("c")).scalar()
    scored = frequencies.join(lengths, "id").withColumns({
        "df": F.get(doc_counts, F.col("term")).cast("double"), "n": collection["n"], "mean": collection["mean"]})
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    return (scored.groupBy("id").agg(F.sum(idf * weight).alias("score"))
            .orderBy(F.desc("score"), "id").limit(k))


def bm25_scan(docs: DataFrame, text: str, terms: Terms, id: str = "id", k: int = 10, k1: float = 1.2,
              b: float = 0.75, stop_words: tuple[str, ...] = ()) -> DataFrame:
    """The same result in one pass over the documents.

    Lengths and term frequencies are counted inside each document's row and only they go on: one narrow exchange by id serves both the
    collection's statistics and the scores.
    """
    terms = distinct_terms(terms)
    numbers = range(len(terms))

    def counts(tokens: Column) -> Column:
        per_term = [sum((occurrences(tokens, form) for form in term.forms), F.lit(0)) for term in terms]
        return F.struct(F.size(tokens).alias("length"), F.array(*per_term).alias("tf"))

    narrow = docs.where(F.col(text).isNotNull()).select(
        F.col(id).alias("id"), bind(drop_stop_words(tokenize(F.col(text)), stop_words), counts).alias("c"))
    narrow = narrow.select("id", F.col("c.length").alias("length"), F.col("c.tf").alias("tf")).repartition("id")
    stats = narrow.agg(F.struct(
        F.count("*").cast("double").alias("n"), F.avg("length").alias("mean"),
        F.array(*[F.count(F.when(F.col("tf")[i] > 0, 1)).cast("double") for i in numbers]).alias("df")).alias("s")).scalar()
    scored = narrow.select("*", stats.alias("s"))
    norm = k1 * (1 - b + b * F.col("length") / F.col("s.mean"))
    score = sum((F.log(1 + (F.col("s.n") - F.col("s.df")[i] + 0.5) / (F.col("s.df")[i] + 0.5))
                 * F.col("tf")[i] * (k1 + 1) / (F.col("tf")[i] + norm) for i in numbers), F.lit(0.0))
    # documents without a term score 0 and come last; dropping them earlier would tokenize the text once more
    return scored.select("id", score.alias("score")).orderBy(F.desc("score"), "id").limit(k).where(F.col("score") > 0)


def facets(hits: DataFrame, fields: list[str]) -> DataFrame:
    """Counts per value of each field in one pass: ``field, value, n`` (values as text, nulls not counted)."""
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return (hits.select(F.explode(entries).alias("e")).select("e.field", "e.value").where(F.col("value").isNotNull())
            .groupBy("field", "value").agg(F.count("*").alias("n")))


def histogram(hits: DataFrame, field: str, start: float, gap: float, end: float, distinct: str | None = None) -> DataFrame:
    """``low, n`` of the intervals [low, low + gap) from start to end that hold values of a number field, and of what lies ``before`` and ``after`` them; with
    ``distinct`` also ``n_distinct``, about how many values of that field each interval holds, by a sketch of bounded size that merges on the map side.

    ``part`` says which of the three a row is; nulls are not counted.
    """
    value = F.col(field).cast("double")
    part = F.when(value < start, "before").when(value >= end, "after").otherwise("between")
    low = F.when(part == "between", start + F.floor((value - start) / gap) * gap)
    counts = [F.count("*").alias("n")]
    if distinct:
        counts.append(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(distinct))).alias("n_distinct"))
    return hits.where(value.isNotNull()).groupBy(part.alias("part"), low.alias("low")).agg(*counts)


def sort_missing_last(rows: DataFrame, field: str, descending: bool = False, then: str = "id") -> DataFrame:
    """Order by a field with missing values last in either direction."""
    column = F.col(field)
    return rows.orderBy(column.desc_nulls_last() if descending else column.asc_nulls_last(), then)
