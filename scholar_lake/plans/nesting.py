"""The driver's flat tables as snapshot-shaped records.

Every record is built from one row (lists come from the row's own numbers), so nesting needs no shuffle and no group can grow.
A line item stands for one delivered record of its order's work, so one work id is delivered several times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scholar_lake.functions.abstracts import bind, build_index

#: 21 characters, as every id prefix of the format.
PREFIX = "https://scholar.test/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def url(letter: str, number: Column) -> Column:
    return F.concat(F.lit(PREFIX + letter), number.cast("string"))


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _pick(number: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int") + 1)


def _day(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd")


def _stats(number: Column) -> Column:
    return F.struct((number % 50).cast("int").alias("h_index"), (number % 70).cast("int").alias("i10_index"))


def _to(n: Column) -> Column:
    """1..n, empty for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))


def order_works(orders: DataFrame) -> DataFrame:
    """One work per order: scalar fields, biblio, ids, open access, APC, grants, mesh, references."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    day = _day(F.col("o_orderdate"))
    price = F.struct((F.col("o_totalprice") / 100).cast("int").alias("value_usd"))
    return orders.select(
        url("W", key).alias("id"),
        F.when(F.col("o_orderstatus") != "P", _text("Order ", key, ", ", F.col("o_orderpriority"))).alias("title"),
        _text("Order ", key).alias("display_name"),
        _text("https://doi.test/10.1/", key).alias("doi"),
        _pick(cust, "en", "fr", "de", "es").alias("language"),
        F.when(key % 4 > 0, F.lit("cc-by")).otherwise("").alias("license"),
        _pick(key, "article", "book", "dataset").alias("type"),
        F.col("o_orderpriority").alias("type_crossref"),
        day.alias("publication_date"),
        F.year("o_orderdate").alias("publication_year"),
        cust.cast("int").alias("cited_by_count"),
        (F.col("o_orderstatus") == "O").alias("is_oa"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_paratext"),
        (F.col("o_orderstatus") == "F").alias("is_retracted"),
        F.lit(None).cast("string").alias("abstract_inverted_index"),
        F.when(key % 5 > 0, F.struct(
            F.when(key % 3 > 0, cust.cast("string")).alias("volume"), (key % 12).cast("string").alias("issue"),
            F.lit("1").alias("first_page"), F.lit(None).cast("string").alias("last_page"))).alias("biblio"),
        F.when(key % 9 > 0, F.struct(
            url("W", key).alias("openalex"), _text("https://doi.test/10.1/", key).alias("doi"),
            F.when(key % 2 > 0, key + 1_000_000_000_000).alias("mag"),
            F.when(cust % 2 > 0, cust.cast("string")).alias("pmid"), F.lit("").alias("pmcid"))).alias("ids"),
        F.when(key % 6 > 0, F.struct(
            _pick(cust, "gold", "green", "hybrid", "bronze", "closed").alias("oa_status"),
            _text("https://oa.test/", key).alias("oa_url"),
            (cust % 2 == 0).alias("any_repository_has_fulltext"))).alias("open_access"),
        F.when(key % 2 > 0, price).alias("apc_list"),
        F.when(key % 3 == 0, F.to_json(price)).when(key % 3 == 1, F.to_json(F.array(price))).alias("apc_paid"),
        F.struct(F.struct(url("S", cust).alias("id"), F.lit("Journal").alias("display_name")).alias("source"),
                 F.lit(None).cast("string").alias("pdf_url"), F.lit("v1").alias("version")).alias("primary_location"),
        F.transform(_to(key % 3), lambda i: F.struct(
            url("F", cust + i).alias("funder"), _text("Funder ", cust).alias("funder_display_name"),
            F.when(i > 1, _text("grant ", key)).alias("award_id"))).alias("grants"),
        F.transform(_to(cust % 3), lambda i: F.struct(
            _text("D", i).alias("descriptor_ui"), _pick(key, "Humans", "Mice").alias("descriptor_name"),
            F.lit(None).cast("string").alias("qualifier_ui"), F.lit(None).cast("string").alias("qualifier_name"),
            (i == 1).alias("is_major_topic"))).alias("mesh"),
        F.array(url("W", cust), url("W", F.floor(key / 2)), F.when(key % 2 > 0, F.lit("W1"))).alias("referenced_works"),
        F.when(key % 7 > 0, F.array(url("W", key + 1), url("W", cust), url("W", key + 1))).alias("related_works"),
        day.alias("created_date"),
        _text(day, "T10:20:30.123456").alias("updated_date"))


def line_works(lineitem: DataFrame) -> DataFrame:
    """One record per line item: authorships, locations, concepts, goals."""
    supp, part, n = F.col("l_suppkey"), F.col("l_partkey"), F.col("l_linenumber")

    def source(number: Column) -> Column:
        return F.struct(url("S", number).alias("id"), _text("Journal ", number).alias("display_name"),
                        F.lit(None).cast("string").alias("host_organization"),
                        F.lit(None).cast("string").alias("host_organization_name"),
                        F.lit(None).cast("array<string>").alias("issn"), F.lit(None).cast("string").alias("issn_l"),
                        F.lit("journal").alias("type"))

    def location(where: Column, pdf: Column, version: Column) -> Column:
        return F.struct((F.col("l_returnflag") == "R").alias("is_oa"),
                        _text("https://land.test/", part).alias("landing_page_url"),
                        F.lit(None).cast("string").alias("license"), where.alias("source"), pdf.alias("pdf_url"),
                        version.alias("version"))

    def institution(k: Column) -> Column:
        return F.struct(url("I", k).alias("id"), _text("Institution ", k).alias("display_name"),
                        F.lit(None).cast("string").alias("ror"), F.lit(None).cast("string").alias("country_code"),
                        F.lit("education").alias("type"))

    def authorship(i: Column, line: Column) -> Column:
        return F.struct(
            F.struct(F.when((supp + i) % 11 > 0, url("A", (supp * i) % 1000)).alias("id"),
                     F.concat(line["author"], i.cast("string")).alias("display_name"),
                     F.lit(None).cast("string").alias("orcid")).alias("author"),
            F.when(i == 1, F.lit("first")).when(i == n, F.lit("last")).otherwise("middle").alias("author_position"),
            F.array(line["home"], institution(i.cast("long")), line["home"]).alias("institutions"),
            (i == 1).alias("is_corresponding"), F.lit("").alias("raw_affiliation_string"),
            line["raw"].alias("raw_author_name"))

    # what all authors of a line share is made once
    shared = F.struct(institution(supp % 25).alias("home"), _text("Author ", supp, " ").alias("author"), _text("A. ", supp).alias("raw"))
    pdf = F.when(F.col("l_returnflag") == "A", _text("https://pdf.test/", part))
    status = F.col("l_linestatus")
    return lineitem.select(
        url("W", F.col("l_orderkey")).alias("id"),
        bind(shared, lambda line: F.transform(F.sequence(F.lit(1), n), lambda i: authorship(i, line))).alias("authorships"),
        location(F.when(n != 2, source(part)), pdf, status).alias("primary_location"),
        F.array(location(source(part), pdf, status),
                location(source(part), pdf, F.when(n == 3, status)),
                location(F.when(n == 4, source(part + 1)), F.lit("x"), status)).alias("locations"),
        F.array(F.struct(url("C", supp % 50).alias("id"), F.lit("c").alias("display_name"),
                         (F.col("l_discount") + 0.25).alias("score")),
                F.struct(url("C", F.col("l_quantity").cast("int")).alias("id"), F.lit("c").alias("display_name"),
                         (F.col("l_tax") + 0.5).alias("score"))).alias("concepts"),
        F.transform(_to(n - 1), lambda i: F.struct(
            _text("https://goals.test/", i).alias("id"), _text("Goal ", i).alias("display_name"),
            (F.col("l_tax") + 0.125).alias("score"))).alias("sustainable_development_goals"),
        F.col("l_linenumber"))


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def text_works(documents: DataFrame) -> DataFrame:
    """One work per document: the abstract is its whole text, every third one in the older index shape."""
    key = F.col("doc_id")
    indexed = documents.withColumn("_index", build_index(words(F.col("text"))))
    older = F.to_json(F.struct(F.size(words(F.col("text"))).alias("IndexLength"), F.col("_index").alias("InvertedIndex")))
    journal = F.struct(url("S", key % 20).alias("id"), F.col("source").alias("display_name"))
    place = F.struct(F.lit(True).alias("is_oa"), F.lit(None).cast("string").alias("landing_page_url"),
                     F.lit(None).cast("string").alias("license"), journal.alias("source"),
                     F.lit(None).cast("string").alias("pdf_url"), F.col("lang").alias("version"))
    return indexed.select(
        url("W", key).alias("id"),
        F.when(key % 7 > 0, _text("Document ", key, " of ", F.col("source"))).alias("title"),
        _text("Document ", key).alias("display_name"),
        F.when(key % 3 == 0, older).otherwise(F.to_json("_index")).alias("abstract_inverted_index"),
        F.when(key % 4 > 0, F.array(F.struct(
            F.struct(_text("Author ", key).alias("display_name"), url("A", key % 100).alias("id"),
                     F.lit(None).cast("string").alias("orcid")).alias("author"),
            F.lit("first").alias("author_position"),
            F.lit(None).cast("array<struct<id:string>>").alias("institutions"), F.lit(True).alias("is_corresponding"),
            F.lit(None).cast("string").alias("raw_affiliation_string")))).alias("authorships"),
        F.struct(F.when(key % 2 > 0, key.cast("string")).alias("volume"), F.lit("2").alias("issue"),
                 F.lit(None).cast("string").alias("first_page"), F.lit(None).cast("string").alias("last_page")).alias("biblio"),
        F.col("n_chars").cast("int").alias("cited_by_count"),
        F.lit("2024-01-01").alias("created_date"),
        _text("https://doi.test/10.2/", key).alias("doi"),
        F.struct(F.when(key % 5 > 0, key + 1).alias("mag"), F.lit(None).cast("string").alias("pmid"),
                 F.lit("PMC1").alias("pmcid")).alias("ids"),
        (F.col("lang") == "en").alias("is_oa"), F.lit(False).alias("is_paratext"), F.lit(False).alias("is_retracted"),
        F.col("lang").alias("language"), place.alias("primary_location"), F.array(place).alias("locations"),
        F.lit("2023-05-06").alias("publication_date"), (2000 + key % 20).cast("int").alias("publication_year"),
        F.col("source").alias("type"), F.lit("2024-02-03T04:05:06").alias("updated_date"),
        F.col("doc_id"), F.col("source"))


def customer_authors(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        url("A", key).alias("id"), F.col("c_name").alias("display_name"), (key % 1000).cast("int").alias("cited_by_count"),
        F.col("c_nationkey").cast("int").alias("works_count"), _stats(key).alias("summary_stats"),
        F.array(F.col("c_mktsegment"), F.lit(""), F.lit(None).cast("string"),
                _text("\"", F.col("c_name"), "\", jr")).alias("display_name_alternatives"),
        F.struct(F.when(key % 3 > 0, key).alias("mag"), _text("orcid-", key).alias("orcid"),
                 F.lit(None).cast("string").alias("scopus"), F.lit("").alias("twitter"),
                 F.col("c_mktsegment").alias("wikipedia")).alias("ids"),
        F.lit("2023-01-01").alias("created_date"), F.lit("2023-02-03T04:05:06.5").alias("updated_date"))


def supplier_institutions(supplier: DataFrame) -> DataFrame:
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return supplier.select(
        url("I", key).alias("id"), F.col("s_name").alias("display_name"), nation.cast("int").alias("cited_by_count"),
        (key % 100).cast("int").alias("works_count"), _stats(key).alias("summary_stats"),
        F.array().cast("array<struct<year:int>>").alias("counts_by_year"),
        _pick(key, "education", "company", "other").alias("type"), _text("https://home.test/", key).alias("homepage_url"),
        _text("ror-", key).alias("ror"), F.array(F.col("s_name"), _text("It's ", nation)).alias("display_name_alternatives"),
        F.array(F.lit(None).cast("string")).alias("display_name_acronyms"),
        F.struct(key.alias("mag"), F.lit(None).cast("string").alias("wikipedia"), F.lit("Q1").alias("wikidata"),
                 F.lit("").alias("grid")).alias("ids"),
        F.when(key % 4 > 0, F.struct(
            _text("City ", nation).alias("city"), F.lit(None).cast("string").alias("geonames_city_id"),
            F.lit(None).cast("string").alias("region"), _text("Country ", nation).alias("country"),
            F.lit("XX").alias("country_code"), (F.col("s_acctbal") / 128).alias("latitude"),
            (nation + 0.5).cast("double").alias("longitude"))).alias("geo"),
        F.array(F.struct(url("I", key + 1).alias("id"), F.lit("child").alias("relationship")),
                F.struct(url("I", nation).alias("id"), F.lit("related").alias("relationship"))
                ).alias("associated_institutions"),
        F.array(F.struct(url("C", key % 9).alias("id"), F.lit("c").alias("display_name"), F.lit(0.5).alias("score")),
                F.struct(url("C", nation).alias("id"), F.lit("c").alias("display_name"),
                         F.lit(0.25).alias("score"))).alias("x_concepts"),
        F.lit("2023-01-01").alias("created_date"), F.lit("2023-02-03").alias("updated_date"))


def nation_publishers(nation: DataFrame) -> DataFrame:
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    return nation.select(
        F.when(key != 3, url("P", key)).alias("id"), F.col("n_name").alias("display_name"), key.alias("cited_by_count"),
        region.alias("works_count"), _stats(key).alias("summary_stats"),
        F.array(F.col("n_name"), F.lit("a,b")).alias("alternate_titles"),
        F.when(key % 2 > 0, F.array(F.lit("DE"), F.lit("FR"))).alias("country_codes"),
        (region % 2).alias("hierarchy_level"),
        F.array(url("P", key), F.lit("short"), url("P", region)).alias("lineage"),
        F.when(key % 3 > 0, F.struct(url("P", region).alias("id"))).alias("parent_publisher"),
        F.struct(_text("ror-", key).alias("ror"), F.lit("").alias("wikidata")).alias("ids"),
        F.lit("2023-01-01").alias("created_date"), F.lit("2023-02-03").alias("updated_date"))


def supplier_funders(supplier: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    return supplier.select(
        url("F", key).alias("id"), F.col("s_name").alias("display_name"), F.col("s_nationkey").cast("int").alias("cited_by_count"),
        (key % 100).cast("int").alias("works_count"), _stats(key).alias("summary_stats"),
        F.when(key % 2 > 0, F.array(F.col("s_name"))).otherwise(F.array().cast("array<string>")).alias("alternate_titles"),
        _text("Funds ", F.col("s_nationkey")).alias("description"), F.lit("").alias("homepage_url"),
        # a number in some records, text in others; both arrive as text
        F.struct(_text("ror-", key).alias("ror"), F.lit("Q2").alias("wikidata"),
                 F.when(key % 2 > 0, _text("100", key)).otherwise(_text("x", key)).alias("crossref"),
                 F.lit(None).cast("string").alias("doi")).alias("ids"),
        F.lit("2023-01-01").alias("created_date"), F.lit("2023-02-03").alias("updated_date"))


def part_concepts(part: DataFrame) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return part.select(
        url("C", key).alias("id"), F.col("p_name").alias("display_name"), size.alias("cited_by_count"),
        (key % 100).cast("int").alias("works_count"), _stats(key).alias("summary_stats"),
        F.col("p_type").alias("description"), (size % 6).cast("int").alias("level"),
        F.struct(key.alias("mag"), F.array(F.col("p_brand"), F.lit("")).alias("umls_cui"),
                 F.array(F.lit("")).alias("umls_aui"), F.lit("Q3").alias("wikidata"),
                 F.lit(None).cast("string").alias("wikipedia")).alias("ids"),
        F.transform(_to(size % 4), lambda i: F.struct(url("C", size * i).alias("id"))).alias("ancestors"),
        F.when(size > 5, F.array(
            F.struct(url("C", size).alias("id"), F.lit("c").alias("display_name"),
                     (F.col("p_retailprice") / 4096).alias("score")),
            F.struct(F.lit("short").alias("id"), F.lit("c").alias("display_name"),
                     F.lit(0.5).alias("score")))).alias("related_concepts"),
        F.lit("2023-01-01").alias("created_date"), F.lit("2023-02-03").alias("updated_date"))


def part_sources(part: DataFrame) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return part.select(
        url("S", key).alias("id"), F.col("p_name").alias("display_name"), size.alias("cited_by_count"),
        (key % 100).cast("int").alias("works_count"), _stats(key).alias("summary_stats"),
        F.col("p_brand").alias("abbreviated_title"), F.array(F.col("p_name"), F.col("p_type")).alias("alternate_titles"),
        F.lit("").alias("country_code"), _text("https://s.test/", key).alias("homepage_url"),
        _pick(key, "journal", "repository", "conference").alias("type"), (size * 10).alias("apc_usd"),
        url("P", size % 25).alias("host_organization"), F.col("p_brand").alias("host_organization_name"),
        F.array(url("P", size % 25), url("P", size % 5)).alias("host_organization_lineage"),
        F.when(size % 3 > 0, F.array(
            F.struct(F.lit("u").alias("url"), F.col("p_brand").alias("organization")),
            F.struct(F.lit("u").alias("url"), F.lit(None).cast("string").alias("organization")))).alias("societies"),
        (size % 2 == 0).alias("is_in_doaj"), (size % 5 == 0).alias("is_oa"),
        F.struct(key.alias("mag"), F.lit(None).cast("string").alias("fatcat"),
                 F.array(_text("1234-", key), _text("4321-", size)).alias("issn"), _text("1234-", key).alias("issn_l"),
                 F.lit("Q4").alias("wikidata")).alias("ids"),
        F.lit("2023-01-01").alias("created_date"), F.lit("2023-02-03").alias("updated_date"))
