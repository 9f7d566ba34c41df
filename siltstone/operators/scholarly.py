"""Scholarly records of several services to fixed rows.

Each cleaner takes a DataFrame of raw records with typed nested columns and returns the rows that pass in their fixed
schema (``siltstone.schemas``). Missing and empty values are the same; all is built of column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from siltstone.functions import text as t
from siltstone.operators.records import inverted_index
from siltstone.schemas import conform

#: Limits of the records.
LEAST_CHARS, LEAST_WORDS, LEAST_TITLE = 50, 10, 5
MOST_FULL_TEXT, LEAST_PDF_CHARS = 50_000, 200
#: Servers of preprints, the first of which stands for others.
SERVERS = ("biorxiv", "medrxiv")
#: Spellings of languages.
LANGUAGES = {"tr": ("tur", "tr", "turkish"), "en": ("eng", "en", "english")}
ISSN = r"(?i)\b(\d{4}-\d{3}[\dX])\b"
DOI = r"\b(10\.\d{4,9}/[-._;()/:A-Za-z0-9]+)\b"


def some(c: Column) -> Column:
    """The value, or null where it is empty."""
    return F.nullif(c, F.lit(""))


def first_of(*cs: Column) -> Column:
    return F.coalesce(*(some(c) for c in cs), F.lit(""))


def plain(c: Column) -> Column:
    return t.clean_markup(F.coalesce(c, F.lit("")))


def words(c: Column) -> Column:
    return t.word_count(c)


def in_bounds(c: Column) -> Column:
    return (F.length(c) >= LEAST_CHARS) & (words(c) >= LEAST_WORDS)


def listed(array: Column, use=lambda x: x, separator: str = "; ", most: int | None = None, distinct: bool = False) -> Column:
    """The non-empty values of the first ``most`` entries, joined."""
    array = F.coalesce(array, F.array())
    values = F.filter(F.transform(F.slice(array, 1, most) if most else array, use), lambda x: x.isNotNull() & (x != ""))
    return F.array_join(F.array_distinct(values) if distinct else values, separator)


def facts(**parts: Column) -> Column:
    """``**Name:** value`` for each part that has one, in order, with bars between."""
    return F.concat_ws(" | ", *(F.concat(F.lit(f"**{k.replace('_', ' ')}:** "), some(v)) for k, v in parts.items()))


def markdown(title: Column, meta: Column | None = None, **sections: Column) -> Column:
    """A heading, a line of facts and titled sections; empty parts are left out."""
    parts = [F.concat(F.lit("# "), some(title))] + ([some(meta)] if meta is not None else [])
    parts += [F.concat(F.lit(f"## {k.replace('_', ' ')}\n"), some(v)) for k, v in sections.items()]
    return F.concat_ws("\n\n", *parts)


def sized(df: DataFrame, text: str, kind: str) -> DataFrame:
    """In the fixed schema, with the sizes of one column."""
    return conform(df.withColumns({"char_count": F.length(text), "word_count": words(F.col(text))}), kind)


def capitals(c: Column) -> Column:
    """Every run of letters with a capital first letter."""
    runs = F.regexp_extract_all(c, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


def api_works(works: DataFrame, least: int = 30) -> DataFrame:
    """Works of a search service with an abstract or a full text (``fulltext``, may be null), thirty words at least."""
    abstract = F.coalesce(inverted_index(F.col("abstract_inverted_index"), least, "keep"), F.lit(""))
    ranked = F.array_sort(F.transform("concepts", lambda x, k: F.struct((-F.coalesce(x["score"], F.lit(0.0))).alias("by"), k.alias("k"), x["display_name"].alias("name"))))
    full = t.strip(t.sub(t.sub(t.sub(F.col("fulltext"), r"<[^>]{1,200}>", ""), r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"))
    works = works.withColumns({"abstract": abstract, "clean_title": t.strip(first_of(F.col("title"), F.col("display_name"))), "body": F.substring(F.coalesce(full, F.lit("")), 1, MOST_FULL_TEXT)})
    works = works.where((F.col("abstract") != "") | (F.coalesce("fulltext", F.lit("")) != ""))
    works = works.withColumn("text", t.strip(F.concat_ws("\n\n", F.concat(F.lit("# "), some(F.col("clean_title"))), some(F.col("abstract")), some(F.col("body")))))
    out = works.where(words(F.col("text")) >= least).select(
        F.col("id").alias("work_id"),
        "doi",
        F.col("clean_title").alias("title"),
        listed(F.col("authorships"), lambda a: a["author"]["display_name"], most=10).alias("authors"),
        "publication_year",
        "publication_date",
        "abstract",
        listed(F.slice(ranked, 1, 5), lambda x: x["name"]).alias("concepts"),
        "language",
        F.col("type").alias("work_type"),
        "cited_by_count",
        first_of(F.col("open_access.oa_url"), F.col("best_oa_location.landing_page_url"), F.col("primary_location.landing_page_url")).alias("oa_url"),
        "fulltext_source",
        "text",
    )
    return sized(out, "text", "api_work")


def papers(raw: DataFrame, least: int = 20) -> DataFrame:
    """Papers with an abstract of ``least`` words. Fields of study are structs with a category, or strings."""

    def tidy(c: str) -> Column:
        return t.strip(t.sub(t.sub(F.coalesce(c, F.lit("")), r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"))

    study = raw.schema["fields"].dataType
    named = isinstance(study, ArrayType) and isinstance(study.elementType, StructType)
    raw = raw.withColumns({"clean_title": tidy("title"), "clean_abstract": tidy("abstract")}).where(words(F.col("clean_abstract")) >= least)
    out = raw.select(
        F.col("paperId").alias("paper_id"),
        F.col("externalIds.DOI").alias("doi"),
        F.col("externalIds.ArXiv").alias("arxiv_id"),
        F.col("externalIds.PubMed").alias("pubmed_id"),
        F.col("clean_title").alias("title"),
        F.col("clean_abstract").alias("abstract"),
        listed(F.col("authors"), lambda a: a["name"], most=10).alias("authors"),
        "year",
        F.col("publicationDate").alias("publication_date"),
        F.col("citationCount").alias("citation_count"),
        F.col("referenceCount").alias("reference_count"),
        F.coalesce("isOpenAccess", F.lit(False)).cast("byte").alias("is_open_access"),
        F.col("openAccessPdf.url").alias("oa_pdf_url"),
        listed(F.col("fields"), (lambda f: f["category"]) if named else (lambda f: f), most=5).alias("fields_of_study"),
        listed(F.col("publicationTypes"), most=3).alias("publication_types"),
        F.col("journal.name").alias("journal"),
        markdown(F.col("clean_title")).alias("head"),
    )
    out = out.withColumn("text", F.concat_ws("\n\n", some(F.col("head")), "abstract")).drop("head")
    return with_pdf(sized(out, "text", "paper"), F.lit(None).cast("string"))


def with_pdf(rows: DataFrame, text: Column) -> DataFrame:
    """PDF columns of papers: ``text`` is the layer of the fetched file, null if none was fetched.

    Under 200 characters the layer is dropped and recognition asked for; only open papers with a link count.
    """
    fetched = (F.col("is_open_access") == 1) & (F.coalesce("oa_pdf_url", F.lit("")) != "") & text.isNotNull()
    enough = fetched & (F.length(text) >= LEAST_PDF_CHARS)
    return rows.withColumns(
        {
            "pdf_text": F.when(enough, text).otherwise(""),
            "pdf_ocr_needed": (fetched & ~enough).cast("byte"),
            "pdf_char_count": F.when(enough, F.length(text)).otherwise(0),
        }
    )


def preprints(raw: DataFrame) -> DataFrame:
    fields = ("doi", "title", "abstract", "server", "category", "authors", "author_corresponding", "author_corresponding_institution", "license", "published")
    rows = raw.select(*(plain(F.col(f)).alias(f) for f in fields), t.strip(F.coalesce("date", F.lit(""))).alias("date"), t.strip(F.coalesce("version", F.lit("1"))).alias("version"))
    rows = rows.where(F.contains("doi", F.lit("/")) & (F.length("title") >= LEAST_TITLE) & ~t.is_paratext(F.col("title")) & in_bounds(F.col("abstract")))
    low = F.lower("server")
    day = F.when(F.substring("date", 1, 10).rlike(r"^\d{4}-\d\d-\d\d$"), F.try_to_date(F.substring("date", 1, 10), "yyyy-MM-dd"))
    rows = rows.withColumns({"server": F.when(low.isin(*SERVERS), low).otherwise(SERVERS[0]), "category": F.lower(first_of(F.col("category"), F.lit("general"))), "day": day})
    rows = rows.withColumns(
        {
            "pub_date": F.coalesce(F.col("day").cast("string"), "date"),
            "pub_year": F.coalesce(F.year("day"), F.regexp_extract("date", r"^(\d{4})", 1).try_cast("int"), F.lit(0)),
            "version": F.when(F.col("version").rlike(r"^\d+$"), F.col("version").try_cast("int")).otherwise(1),
            "published_doi": F.when(F.lower("published") == "na", "").otherwise(F.col("published")),
        }
    )
    meta = facts(
        Authors=F.col("authors"),
        Server=F.initcap("server"),
        Category=capitals(F.col("category")),
        DOI=F.concat("doi", F.lit(" (v"), "version", F.lit(")")),
        Date=F.col("pub_date"),
        Institution=F.col("author_corresponding_institution"),
        License=F.col("license"),
        Published_Version=F.col("published_doi"),
    )
    rows = rows.withColumn("text", markdown(F.col("title"), meta, Abstract=F.col("abstract")))
    return sized(rows.withColumnsRenamed({"author_corresponding": "corresponding_author", "author_corresponding_institution": "institution"}), "text", "preprint")


def mesh_names(df: DataFrame, name: str = "mesh_terms", most: int = 20) -> Column:
    """Terms with a star if major, from structs, strings or one string with commas."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, StringType):
        c = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), t.strip), lambda x: x != "")
        return listed(c, separator=", ", most=most)
    if isinstance(kind.elementType, StructType):
        c = F.transform(F.filter(c, lambda m: F.coalesce(m["name"], F.lit("")) != ""), lambda m: F.concat(m["name"], F.when(F.coalesce(m["is_major"], F.lit(False)), "*").otherwise("")))
    return listed(c, separator=", ", most=most)


def medical_articles(raw: DataFrame) -> DataFrame:
    fields = ("title", "abstract", "text", "journal", "authors", "doi", "pmcid", "keywords")
    year = F.coalesce("pub_year", F.lit(0)).cast("int")
    rows = raw.select(t.strip(F.coalesce(F.col("pmid").cast("string"), F.lit(""))).alias("pmid"), *(plain(F.col(f)).alias(f) for f in fields), year.alias("pub_year"), mesh_names(raw).alias("mesh_terms"))
    rows = rows.where(F.col("pmid").rlike(r"^\d+$") & (F.length("title") >= LEAST_TITLE) & ~t.is_paratext(F.col("title")) & in_bounds(first_of(F.col("abstract"), F.col("text"))))
    journal = F.concat(some(F.col("journal")), F.when(F.col("pub_year") > 0, F.concat(F.lit(" ("), "pub_year", F.lit(")"))).otherwise(""))
    meta = facts(Authors=F.col("authors"), Journal=journal, PMID=F.col("pmid"), PMCID=F.col("pmcid"), DOI=F.col("doi"), MeSH=F.col("mesh_terms"))
    rows = rows.withColumn("text", markdown(F.col("title"), meta, Abstract=F.col("abstract"), Full_Text=F.col("text")))
    return sized(rows.withColumn("is_pmc_oa", F.col("pmcid") != ""), "text", "medical_article")


def oa_articles(raw: DataFrame, least_title: int = 3, least_abstract: int = 0) -> DataFrame:
    """Articles with a nested ``bibjson``: the first DOI, all ISSNs, distinct affiliations, keywords and subjects, the best link."""
    b = F.col("bibjson")
    rows = raw.where(t.strip(F.coalesce("id", F.lit(""))) != "").select(t.strip(F.col("id")).alias("id"), "bibjson", plain(b["title"]).alias("title"), plain(b["abstract"]).alias("abstract"))
    rows = rows.where((F.length("title") >= least_title) & ~t.is_paratext(F.col("title")) & (F.length("abstract") >= least_abstract))
    none = F.array().cast("array<string>")

    def ids(test) -> Column:
        kept = F.filter(b["identifier"], lambda x: test(F.lower(F.coalesce(x["type"], F.lit("")))) & (t.strip(F.coalesce(x["id"], F.lit(""))) != ""))
        return F.coalesce(F.transform(kept, lambda x: t.strip(x["id"])), none)

    own = ids(lambda kind: F.contains(kind, F.lit("issn")) & (kind != "doi"))
    more = F.filter(F.array_distinct(F.coalesce(b["journal"]["issns"], none)), lambda x: x.isNotNull() & (x != "") & ~F.array_contains(own, x))
    links = F.filter(F.transform(b["link"], lambda x: F.struct(t.strip(F.coalesce(x["url"], F.lit(""))).alias("url"), F.lower(F.coalesce(x["type"], F.lit(""))).alias("type"))), lambda x: x["url"] != "")
    full = F.filter(links, lambda x: x["type"] == "fulltext")
    spoken = F.when(F.size(F.coalesce(b["journal"]["language"], none)) > 0, b["journal"]["language"]).otherwise(b["language"])
    rows = rows.select(
        "id",
        F.coalesce(F.get(ids(lambda kind: kind == "doi"), F.lit(0)), F.lit("")).alias("doi"),
        "title",
        "abstract",
        plain(b["journal"]["title"]).alias("journal"),
        plain(b["journal"]["publisher"]).alias("publisher"),
        F.array_join(F.concat(own, more), ", ").alias("issn"),
        listed(spoken, F.upper, ", ").alias("language"),
        b["year"].try_cast("int").alias("year"),
        listed(t.clean_markup_all(F.transform(b["author"], lambda a: a["name"])), separator=", ").alias("authors"),
        listed(t.clean_markup_all(F.transform(b["author"], lambda a: a["affiliation"])), distinct=True).alias("affiliations"),
        listed(t.clean_markup_all(b["keywords"]), separator=", ", distinct=True).alias("keywords"),
        listed(t.clean_markup_all(F.transform(b["subject"], lambda s: s["term"])), separator=", ", distinct=True).alias("subjects"),
        F.coalesce(F.get(full, F.lit(0))["url"], F.get(links, F.lit(0))["url"]).alias("fulltext_url"),
    )
    return sized(rows.withColumn("measured", F.concat_ws("\n\n", "title", some(F.col("abstract")))), "measured", "oa_article")


def _line(c: Column) -> Column:
    """Entities decoded, white space as single blanks."""
    return t.strip(t.sub(t.unescaped(F.coalesce(c.cast("string"), F.lit(""))), rf"[{t.WS}]+", " "))


def _lines(array: Column) -> Column:
    array = F.transform(array, lambda x: F.coalesce(x, F.lit("")))
    return F.transform(t.unescaped_all(array), lambda x: t.strip(t.sub(x, rf"[{t.WS}]+", " ")))


def portal_articles(raw: DataFrame, least_title: int = 3, pattern: str = "https://example.org/pub/{set}/article/{id}") -> DataFrame:
    """Harvested journal articles; the link is the explicit one, else PDF, article page, DOI, or ``pattern``."""
    rows = raw.where(F.coalesce("status", F.lit("")) != "deleted")
    given = ("id", "identifier", "title", "abstract", "description", "journal", "source", "publisher", "publication_date", "date", "language", "doi", "issn", "fulltext_url", "pdf_url", "html_url", "set_spec", "subjects", "affiliations")
    rows = rows.select(*(_line(F.col(f)).alias(f) for f in given), _lines(F.col("identifiers")).alias("ids"), listed(_lines(F.col("authors"))).alias("authors"), listed(_lines(F.col("keywords")), separator=", ").alias("keywords"))
    named = first_of(F.col("id"), F.col("identifier"))
    rows = rows.withColumns({"id": F.when(named.startswith("http"), named).otherwise(t.strip(F.element_at(F.split(named, ":"), -1))), "title": t.strip(t.sub(F.col("title"), "<[^>]+>", "")), "abstract": t.strip(t.sub(first_of(F.col("abstract"), F.col("description")), "<[^>]+>", ""))})
    rows = rows.where((F.col("id") != "") & (F.length("title") >= least_title))

    def first_id(test, use=lambda x: x) -> Column:
        return F.coalesce(F.get(F.filter(F.transform(F.filter("ids", test), use), lambda x: x != ""), F.lit(0)), F.lit(""))

    def is_pdf(x: Column) -> Column:
        return x.endswith(".pdf") | F.contains(x, F.lit("/download/"))

    found_doi = first_id(lambda x: F.contains(x, F.lit("doi.org/")) | x.startswith("10."), lambda x: first_of(F.regexp_extract(x, DOI, 1), F.when(x.startswith("10."), x)))
    rows = rows.withColumns(
        {
            "doi": first_of(F.col("doi"), found_doi),
            "issn": first_of(F.col("issn"), first_id(lambda x: x.rlike(ISSN), lambda x: F.upper(F.regexp_extract(x, ISSN, 1))), F.upper(F.regexp_extract(first_of(F.col("journal"), F.col("source")), ISSN, 1))),
            "pdf": first_id(is_pdf),
            "page": first_id(lambda x: F.contains(x, F.lit("/article/")) & x.startswith("http") & ~is_pdf(x)),
        }
    )
    by_pattern = F.when(F.col("set_spec") != "", F.replace(F.replace(F.lit(pattern), F.lit("{set}"), F.col("set_spec")), F.lit("{id}"), F.element_at(F.split("id", "/"), -1)))
    day, tongue = first_of(F.col("publication_date"), F.col("date")), F.lower(first_of(F.col("language"), F.lit("tr")))
    folded = tongue
    for code, spellings in LANGUAGES.items():
        folded = F.when(tongue.isin(*spellings), code).otherwise(folded)
    rows = rows.withColumns(
        {
            "fulltext_url": first_of(F.col("fulltext_url"), F.col("pdf_url"), F.col("html_url"), F.col("pdf"), F.col("page"), F.concat(F.lit("https://doi.org/"), some(F.col("doi"))), by_pattern),
            "journal": first_of(F.col("journal"), F.col("source")),
            "language": folded,
            "year": F.regexp_extract(day, r"\b((?:19|20)\d{2})\b", 1).try_cast("int"),
            "measured": F.concat("title", F.lit(" "), "abstract"),
        }
    )
    return sized(rows, "measured", "portal_article")


def repository_records(raw: DataFrame, publisher: str = "", least_title: int = 3, files_url: str = "https://example.org/records/{id}/files/{key}") -> DataFrame:
    """Records of a repository in two shapes: harvested (``dc`` lists, with ``oai_identifier``) or of its own service (``metadata``)."""
    harvested = F.col("dc").isNotNull() & F.col("oai_identifier").isNotNull()
    dc, meta = F.col("dc"), F.col("metadata")

    def head(array: Column) -> Column:
        return t.strip(F.coalesce(F.get(array, F.lit(0)), F.lit("")))

    def json_list(array: Column) -> Column:
        return F.to_json(F.filter(F.transform(F.coalesce(array, F.array().cast("array<string>")), t.strip), lambda x: x != ""))

    ids = F.transform(F.coalesce(dc["identifier"], F.array().cast("array<string>")), t.strip)
    dois = F.filter(F.transform(ids, lambda x: F.when(F.contains(x, F.lit("doi.org/")), F.element_at(F.split(x, "doi.org/"), -1)).when(x.startswith("10."), x)), lambda x: x.isNotNull())
    one = raw.where(harvested).select(
        t.strip(F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("id"),
        F.coalesce(F.try_element_at(dois, F.lit(-1)), F.lit("")).alias("doi"),
        plain(F.array_join(dc["title"], " ")).alias("title"),
        listed(dc["creator"], t.strip).alias("creators"),
        plain(F.array_join(dc["description"], "\n\n")).alias("description"),
        first_of(head(dc["publisher"]), F.lit(publisher)).alias("publisher"),
        first_of(head(dc["date"]), F.substring("datestamp", 1, 10)).alias("publication_date"),
        F.replace(F.element_at(F.split(head(dc["type"]), "/"), -1), F.lit("info:eu-repo:semantics:"), F.lit("")).alias("resource_type"),
        first_of(head(dc["language"]), F.lit("unknown")).alias("language"),
        json_list(dc["subject"]).alias("keywords"),
        json_list(dc["subject"]).alias("subjects"),
        listed(dc["rights"], t.strip).alias("rights"),
        F.lit(0).alias("file_count"),
        F.lit(0).cast("long").alias("total_file_size"),
        F.lit("[]").alias("files_json"),
    )
    files = F.coalesce(F.col("files"), F.array())
    address = lambda f: F.coalesce(some(f["links"]["self"]), F.replace(F.replace(F.lit(files_url), F.lit("{id}"), F.col("id").cast("string")), F.lit("{key}"), F.coalesce(f["key"], F.lit(""))))
    listing = F.transform(files, lambda f: F.struct(F.coalesce(f["id"], F.lit("")).alias("id"), F.coalesce(f["key"], F.lit("")).alias("key"), F.coalesce(f["size"], F.lit(0)).alias("size"), F.coalesce(f["checksum"], F.lit("")).alias("checksum"), address(f).alias("download_url")))
    two = raw.where(~F.coalesce(harvested, F.lit(False)) & F.col("id").isNotNull()).select(
        t.strip(F.col("id").cast("string")).alias("id"),
        first_of(t.strip(meta["doi"]), F.col("doi")).alias("doi"),
        plain(first_of(meta["title"], F.col("title"))).alias("title"),
        listed(meta["creators"], lambda c: t.strip(c["name"])).alias("creators"),
        plain(meta["description"]).alias("description"),
        first_of(t.strip(meta["publisher"]), F.lit(publisher)).alias("publisher"),
        first_of(meta["publication_date"], F.substring("created", 1, 10)).alias("publication_date"),
        first_of(meta["resource_type"]["type"], meta["resource_type"]["title"]).alias("resource_type"),
        first_of(t.strip(meta["language"]), F.lit("unknown")).alias("language"),
        json_list(meta["keywords"]).alias("keywords"),
        F.to_json(F.array_distinct(F.filter(F.flatten(F.transform(F.coalesce(meta["branches"], F.array()), lambda b: F.array(b["title"]["tr"], b["title"]["en"]))), lambda x: F.coalesce(x, F.lit("")) != ""))).alias("subjects"),
        first_of(meta["license"], meta["access_right"]).alias("rights"),
        F.size(files).alias("file_count"),
        F.aggregate(files, F.lit(0).cast("long"), lambda acc, f: acc + F.coalesce(f["size"], F.lit(0))).alias("total_file_size"),
        F.to_json(listing).alias("files_json"),
    )
    rows = one.unionByName(two).withColumn("measured", t.strip(F.concat("title", F.lit(" "), "description")))
    rows = rows.where((F.col("id") != "") & (F.length("title") >= least_title) & ~t.is_paratext(F.col("title")) & in_bounds(F.col("measured")))
    return sized(rows, "measured", "repository_record")


def with_full_texts(articles: DataFrame, texts: DataFrame) -> DataFrame:
    """Articles joined with ``texts(id, fulltext)``, in the schema of full texts; articles without one are left out."""
    own = texts.select(F.col("id").alias("__id"), "fulltext").where(F.coalesce("fulltext", F.lit("")) != "")
    joined = articles.join(own, F.col("id") == F.col("__id"))
    return conform(joined.withColumn("fulltext_chars", F.length("fulltext")), "fulltext_article")
