"""Fixed output schemas of the sinks, by kind of record, and how a table is brought into one.

Names and types are fixed values that readers of the written files rely on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType, StructType, _parse_datatype_string

_SIZES = "char_count int, word_count int"
_WIKI = "article_id long, title string, lang string, text string, raw_length int, clean_length int, url string, timestamp string"
_ARTICLE = f"id string, doi string, title string, abstract string, journal string, publisher string, issn string, language string, year short, authors string, affiliations string, keywords string, subjects string, fulltext_url string, {_SIZES}"

SCHEMAS = {
    "corpus": "doc_id string, text string, title string, source string, domain string, license_group string, char_count long, word_count long, ref_token_count long, created_at string",
    "snapshot_work": f"id string, doi string, title string, year short, authors string, topics string, is_oa boolean, oa_url string, citations int, text string, {_SIZES}",
    "api_work": f"work_id string, doi string, title string, authors string, publication_year int, publication_date string, abstract string, concepts string, language string, work_type string, cited_by_count int, oa_url string, fulltext_source string, text string, {_SIZES}",
    "paper": f"paper_id string, doi string, arxiv_id string, pubmed_id string, title string, abstract string, authors string, year int, publication_date string, citation_count int, reference_count int, is_open_access byte, oa_pdf_url string, fields_of_study string, publication_types string, journal string, text string, {_SIZES}, pdf_text string, pdf_ocr_needed byte, pdf_char_count int",
    "preprint": f"doi string, title string, server string, category string, pub_date string, pub_year short, version short, authors string, corresponding_author string, institution string, license string, published_doi string, abstract string, text string, {_SIZES}",
    "medical_article": f"pmid string, pmcid string, doi string, title string, journal string, pub_year short, authors string, mesh_terms string, keywords string, abstract string, text string, is_pmc_oa boolean, {_SIZES}",
    "oa_article": _ARTICLE,
    "portal_article": _ARTICLE,
    "fulltext_article": f"{_ARTICLE}, fulltext string, fulltext_chars int",
    "repository_record": f"id string, doi string, title string, creators string, description string, publisher string, publication_date string, resource_type string, language string, keywords string, subjects string, rights string, file_count int, total_file_size long, files_json string, {_SIZES}",
    "klines": "open_time long, open double, high double, low double, close double, volume double, close_time long, quote_volume double, trades long, taker_base double, taker_quote double, symbol string, market string, interval string, source_file string",
    "trades": "trade_id long, price double, qty double, quote_qty double, trade_time long, is_buyer_maker boolean, symbol string, market string, source_file string",
    "agg_trades": "agg_trade_id long, price double, quantity double, first_trade_id long, last_trade_id long, transact_time long, is_buyer_maker boolean, symbol string, market string, source_file string",
    "book": f"book_id int, title string, authors string, language string, subjects string, bookshelves string, rights string, text string, {_SIZES}, source_url string, has_images byte, downloads int",
    "thread": "thread_id long, site string, title string, tags string, score int, view_count int, question string, answer string, answer_score int, comments string, creation_date string, answer_count int",
    "wiki_page": _WIKI,
    "quote_page": _WIKI.replace("clean_length int,", "clean_length int, quotes_count int,"),
    "dictionary_entry": _WIKI.replace("title", "word"),
    "wiki_extract": "id string, url string, title string, text string",
}
_LIMITS = {"tinyint": 1 << 7, "smallint": 1 << 15, "int": 1 << 31}


def struct_of(kind: str) -> StructType:
    return _parse_datatype_string(SCHEMAS[kind])


def _empty(kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return F.lit("")
    return F.lit(False) if isinstance(kind, BooleanType) else F.lit(0).cast(kind)


def conform(df: DataFrame, kind: str) -> DataFrame:
    """``df`` in a fixed schema: its columns in order and type, nothing else.

    What is null, missing or can't be cast becomes the type's empty value; numbers beyond a type's range its nearest.
    """
    have = {c.lower() for c in df.columns}

    def column(name: str, to: DataType) -> Column:
        if name.lower() not in have:
            return _empty(to)
        c = F.col(name)
        if isinstance(to, NumericType) and to.simpleString() in _LIMITS:
            most = _LIMITS[to.simpleString()]
            whole = c.try_cast("long")
            c = F.when(whole.isNotNull(), F.greatest(F.lit(-most), F.least(F.lit(most - 1), whole)))
        return F.coalesce(c.try_cast(to), _empty(to))

    return df.select(*(column(f.name, f.dataType).alias(f.name) for f in struct_of(kind).fields))
