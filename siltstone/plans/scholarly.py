"""Queries of the scholarly cleaners: raw records are built from every row of ``documents``, with what must go, fold or be preferred."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators import records, scholarly
from siltstone.plans.registry import query, table


def _raw(spark, sf_dir, **columns: str):
    """``documents`` as raw records, each column by a SQL expression over doc_id (k), source and lang."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), "source", "lang")
    return docs.select("k", *(F.expr(e).alias(n) for n, e in columns.items()))


def _words(n: str, word: str = "w") -> str:
    return f"array_join(transform(sequence(0, cast({n} as int) - 1), i -> concat('{word}', i)), ' ')"


_SQL_WORDS = "array_to_string(list_transform(range(0, {n}), lambda i: '{w}' || i), ' ')"


def _sql_words(n: str, word: str = "w") -> str:
    return _SQL_WORDS.format(n=n, w=word)


@query(f"""WITH d AS (SELECT doc_id, source, {_sql_words('20 + doc_id % 25')} AS a FROM documents WHERE doc_id % 25 >= 10)
SELECT 'W' || doc_id AS work_id, 'Title ' || doc_id AS title, 'Ann; Bo' AS authors, source || '; B; A' AS concepts, CASE doc_id % 3 WHEN 0 THEN 'oa' WHEN 1 THEN 'best' ELSE 'first' END AS oa_url, doc_id::INT % 2000 AS publication_year,
md5('# Title ' || doc_id || chr(10) || chr(10) || a || CASE WHEN doc_id % 2 = 0 THEN chr(10) || chr(10) || 'full body ' || doc_id ELSE '' END) AS text, (23 + doc_id % 25 + CASE WHEN doc_id % 2 = 0 THEN 3 ELSE 0 END)::INT AS word_count FROM d""")
def c2_api_works(spark, sf_dir):
    """Thirty words of abstract at least, concepts by score, the first link that is there."""
    raw = _raw(
        spark,
        sf_dir,
        id="concat('W', k)",
        doi="cast(null as string)",
        title="if(k % 2 = 0, concat(' Title ', k), '')",
        display_name="concat('Title ', k)",
        publication_year="cast(k % 2000 as int)",
        publication_date="''",
        type="'article'",
        language="lang",
        cited_by_count="cast(null as int)",
        abstract_inverted_index="map_from_entries(transform(sequence(0, cast(19 + k % 25 as int)), i -> struct(concat('w', i), array(i))))",
        authorships="array(named_struct('author', named_struct('display_name', 'Ann')), named_struct('author', named_struct('display_name', '')), named_struct('author', named_struct('display_name', 'Bo')))",
        concepts="array(named_struct('display_name', 'A', 'score', 0.1D), named_struct('display_name', source, 'score', 0.9D), named_struct('display_name', 'B', 'score', 0.9D), named_struct('display_name', '', 'score', 0.5D))",
        open_access="named_struct('oa_url', if(k % 3 = 0, 'oa', ''))",
        best_oa_location="if(k % 3 = 1, named_struct('landing_page_url', 'best'), null)",
        primary_location="named_struct('landing_page_url', 'first')",
        fulltext="if(k % 2 = 0, concat('<b>full</b>  body ', k), null)",
        fulltext_source="''",
    )
    out = scholarly.api_works(raw)
    return out.select("work_id", "title", "authors", "concepts", "oa_url", "publication_year", F.md5("text").alias("text"), "word_count")


_PAPER = dict(
    paperId="concat('p', k)",
    title="concat('A  paper ', k)",
    abstract=_words("15 + k % 10"),
    externalIds="named_struct('DOI', concat('10.1/', k), 'ArXiv', cast(null as string), 'PubMed', '')",
    authors="transform(sequence(1, 12), i -> named_struct('name', if(i = 2, '', concat('N', i))))",
    year="cast(2000 + k % 20 as int)",
    publicationDate="cast(null as string)",
    citationCount="cast(k % 9 as int)",
    referenceCount="cast(null as int)",
    isOpenAccess="k % 2 = 0",
    openAccessPdf="if(k % 3 = 0, null, named_struct('url', 'u'))",
    fields="array(named_struct('category', source), named_struct('category', 'Maths'))",
    publicationTypes="array('a', 'b', 'c', 'd')",
    journal="named_struct('name', 'J')",
)


@query(f"""SELECT 'p' || doc_id AS paper_id, '10.1/' || doc_id AS doi, 'A paper ' || doc_id AS title, 'N1; N3; N4; N5; N6; N7; N8; N9; N10' AS authors, source || '; Maths' AS fields_of_study, 'a; b; c' AS publication_types, (doc_id % 9)::INT AS citation_count, (CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END)::TINYINT AS is_open_access,
md5('# A paper ' || doc_id || chr(10) || chr(10) || {_sql_words('15 + doc_id % 10')}) AS text FROM documents WHERE doc_id % 10 >= 5""")
def c3_papers(spark, sf_dir):
    out = scholarly.papers(_raw(spark, sf_dir, **_PAPER))
    return out.select("paper_id", "doi", "title", "authors", "fields_of_study", "publication_types", "citation_count", "is_open_access", F.md5("text").alias("text"))


@query("""WITH p AS (SELECT doc_id, doc_id % 2 = 0 AND doc_id % 3 <> 0 AND doc_id % 4 <> 0 AS fetched, (doc_id * 7 % 400)::INT AS n FROM documents WHERE doc_id % 10 >= 5)
SELECT 'p' || doc_id AS paper_id, (CASE WHEN fetched AND n < 200 THEN 1 ELSE 0 END)::TINYINT AS pdf_ocr_needed, CASE WHEN fetched AND n >= 200 THEN n ELSE 0 END AS pdf_char_count, CASE WHEN fetched AND n >= 200 THEN repeat('x', n) ELSE '' END AS pdf_text FROM p""")
def c4_pdf_enrichment(spark, sf_dir):
    """Text layers of open papers with a link; short ones are dropped and marked for recognition."""
    found = scholarly.papers(_raw(spark, sf_dir, **_PAPER))
    k = F.substring("paper_id", 2, 20).cast("long")
    layer = F.when(k % 4 != 0, F.repeat(F.lit("x"), (k * 7 % 400).cast("int")))
    return scholarly.with_pdf(found, layer).select("paper_id", "pdf_ocr_needed", "pdf_char_count", "pdf_text")


@query(f"""WITH d AS (SELECT doc_id, source, CASE WHEN doc_id % 4 = 0 THEN 'medrxiv' ELSE 'biorxiv' END AS server, CASE WHEN doc_id % 3 = 0 THEN '2021-02-03' WHEN doc_id % 3 = 1 THEN '2019' ELSE '2020-13-45' END AS day, {_sql_words('20', 'word')} AS a FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0)
SELECT '10.1/' || doc_id AS doi, server, 'cell-type biology' AS category, day AS pub_date, CASE doc_id % 3 WHEN 0 THEN 2021 WHEN 1 THEN 2019 ELSE 2020 END::SMALLINT AS pub_year, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END::SMALLINT AS version, CASE WHEN doc_id % 2 = 0 THEN '' ELSE '10.9/x' END AS published_doi,
md5('# A preprint ' || doc_id || chr(10) || chr(10) || '**Authors:** Ann, Bo | **Server:** ' || upper(server[1]) || server[2:] || ' | **Category:** Cell-Type Biology | **DOI:** 10.1/' || doc_id || ' (v' || CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END || ') | **Date:** ' || day || ' | **Institution:** ' || source || CASE WHEN doc_id % 2 = 0 THEN '' ELSE ' | **Published Version:** 10.9/x' END || chr(10) || chr(10) || '## Abstract' || chr(10) || a) AS text FROM d""")
def c5_preprints(spark, sf_dir):
    raw = _raw(
        spark,
        sf_dir,
        doi="if(k % 5 = 0, 'none', concat('10.1/', k))",
        title="if(k % 7 = 0, 'Editorial Board', concat('A <i>preprint</i>  ', k))",
        abstract=_words("20", "word"),
        server="if(k % 4 = 0, 'MedRxiv', if(k % 4 = 1, null, 'other'))",
        category="'Cell-type BIOLOGY'",
        authors="'Ann, Bo'",
        author_corresponding="'Ann'",
        author_corresponding_institution="source",
        license="cast(null as string)",
        published="if(k % 2 = 0, 'NA', '10.9/x')",
        date="case k % 3 when 0 then '2021-02-03' when 1 then '2019' else '2020-13-45' end",
        version="if(k % 2 = 0, '2', 'x')",
    )
    return scholarly.preprints(raw).select("doi", "server", "category", "pub_date", "pub_year", "version", "published_doi", F.md5("text").alias("text"))


@query(f"""WITH d AS (SELECT doc_id, source, {_sql_words('14', 'word')} AS a FROM documents WHERE doc_id % 5 <> 0)
SELECT doc_id::VARCHAR AS pmid, 'Brain*, ' || source AS mesh_terms, doc_id % 2 = 0 AS is_pmc_oa, (1950 + doc_id % 3)::SMALLINT AS pub_year,
md5('# An article ' || doc_id || chr(10) || chr(10) || '**Authors:** Ann | **Journal:** J (' || 1950 + doc_id % 3 || ') | **PMID:** ' || doc_id || CASE WHEN doc_id % 2 = 0 THEN ' | **PMCID:** PMC1' ELSE '' END || ' | **MeSH:** Brain*, ' || source || CASE WHEN doc_id % 3 = 0 THEN '' ELSE chr(10) || chr(10) || '## Abstract' || chr(10) || a END || CASE WHEN doc_id % 3 = 1 THEN '' ELSE chr(10) || chr(10) || '## Full Text' || chr(10) || a END) AS text FROM d""")
def c6_medical_articles(spark, sf_dir):
    """The body is the abstract, else the text; numeric ids only."""
    raw = _raw(
        spark,
        sf_dir,
        pmid="if(k % 5 = 0, concat('x', k), concat(' ', k))",
        title="concat('An article ', k)",
        abstract=f"if(k % 3 = 0, '', {_words('14', 'word')})",
        text=f"if(k % 3 = 1, null, {_words('14', 'word')})",
        journal="'J'",
        authors="'Ann'",
        doi="''",
        pmcid="if(k % 2 = 0, 'PMC1', '')",
        keywords="''",
        pub_year="cast(1950 + k % 3 as int)",
        mesh_terms="array(named_struct('name', 'Brain', 'is_major', true), named_struct('name', cast(null as string), 'is_major', true), named_struct('name', source, 'is_major', false))",
    )
    return scholarly.medical_articles(raw).select("pmid", "mesh_terms", "is_pmc_oa", "pub_year", F.md5("text").alias("text"))


@query(f"""WITH d AS (SELECT doc_id, source, upper(lang) AS l FROM documents WHERE doc_id % 6 <> 0)
SELECT 'a' || doc_id AS id, '10.5/' || doc_id AS doi, '1111-2222, 3333-444X' AS issn, l || ', TR' AS language, 'Ann, Bo' AS authors, 'Uni A' AS affiliations, source || ', k2' AS keywords, 'Law' AS subjects, CASE WHEN doc_id % 2 = 0 THEN 'http://full' ELSE 'http://home' END AS fulltext_url,
(CASE WHEN doc_id % 4 = 0 THEN 0 ELSE 1990 END)::SMALLINT AS year, (3 + CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 12 END)::INT AS word_count FROM d""")
def c7_oa_articles(spark, sf_dir):
    raw = _raw(
        spark,
        sf_dir,
        id="if(k % 6 = 0, ' ', concat('a', k))",
        bibjson=f"""named_struct('title', concat('Open paper ', k), 'abstract', if(k % 3 = 0, cast(null as string), {_words('12')}),
        'identifier', array(named_struct('type', 'eISSN', 'id', '1111-2222'), named_struct('type', 'DOI', 'id', concat('10.5/', k)), named_struct('type', 'doi', 'id', '10.6/later')),
        'journal', named_struct('title', 'J', 'publisher', 'P', 'issns', array('1111-2222', '3333-444X'), 'language', array(lang, 'tr')), 'language', array('xx'), 'year', if(k % 4 = 0, 'n.d.', '1990'),
        'author', array(named_struct('name', 'Ann', 'affiliation', 'Uni A'), named_struct('name', '<b>Bo</b>', 'affiliation', 'Uni A'), named_struct('name', '', 'affiliation', '')),
        'keywords', array(source, ' k2', source), 'subject', array(named_struct('term', 'Law'), named_struct('term', 'Law')),
        'link', array(named_struct('url', 'http://home', 'type', 'homepage'), named_struct('url', if(k % 2 = 0, 'http://full', ''), 'type', 'FullText')))""",
    )
    return scholarly.oa_articles(raw).select("id", "doi", "issn", "language", "authors", "affiliations", "keywords", "subjects", "fulltext_url", "year", "word_count")


@query("""SELECT CASE WHEN doc_id % 2 = 0 THEN 'article/' || doc_id ELSE doc_id::VARCHAR END AS id, CASE WHEN doc_id % 3 = 0 THEN '10.1234/ab.' || doc_id ELSE '' END AS doi, CASE WHEN doc_id % 4 = 0 THEN '1234-567X' ELSE '' END AS issn, 'Ann; Bo & Co' AS authors, (1900 + doc_id % 100)::SMALLINT AS year, CASE WHEN doc_id % 2 = 0 THEN 'tr' ELSE 'en' END AS language,
CASE WHEN doc_id % 5 = 0 THEN 'http://x/a.pdf' WHEN doc_id % 5 = 1 THEN 'https://x/article/9' WHEN doc_id % 3 = 0 THEN 'https://doi.org/10.1234/ab.' || doc_id ELSE 'https://example.org/pub/' || source || '/article/' || doc_id END AS fulltext_url, source AS keywords FROM documents WHERE doc_id % 7 <> 0""")
def c8_portal_articles(spark, sf_dir):
    """Deleted records go; ids lose their prefix; links by preference."""
    raw = _raw(
        spark,
        sf_dir,
        status="if(k % 7 = 0, 'deleted', '')",
        id="cast(null as string)",
        identifier="if(k % 2 = 0, concat('oai:host.org:article/', k), concat('x:', k))",
        title="concat('Bir <i>yazı</i> ', k)",
        abstract="''",
        description="'&lt;özet&gt; metin'",
        journal="''",
        source="if(k % 4 = 0, 'Dergi ISSN 1234-567x', 'Dergi')",
        publisher="'P'",
        publication_date="''",
        date="concat('yıl ', 1900 + k % 100, '.')",
        language="if(k % 2 = 0, 'Turkish', 'ENG')",
        doi="''",
        issn="''",
        fulltext_url="''",
        pdf_url="''",
        html_url="''",
        set_spec="source",
        subjects="''",
        affiliations="''",
        identifiers="array_compact(array(' ', if(k % 3 = 0, concat('https://doi.org/10.1234/ab.', k), null), if(k % 5 < 2, 'https://x/article/9', null), if(k % 5 = 0, 'http://x/a.pdf', null)))",
        authors="array('Ann', ' ', 'Bo &amp;\n Co')",
        keywords="array(source, '')",
    )
    out = scholarly.portal_articles(raw)
    return out.select("id", "doi", "issn", "authors", "year", "language", "fulltext_url", "keywords")


@query(f"""SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 2 = 0 THEN '10.2/' || doc_id ELSE '10.3/r' END AS doi, 'Ann; Bo' AS creators, CASE WHEN doc_id % 2 = 0 THEN 'article' ELSE 'poster' END AS resource_type, CASE WHEN doc_id % 2 = 0 THEN 'en' ELSE 'unknown' END AS language, '["' || source || '","k"]' AS keywords,
CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 2 END AS file_count, CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 5 + doc_id END::BIGINT AS total_file_size, 'Pub' AS publisher, '2020-01-02' AS publication_date, 15 AS word_count,
CASE WHEN doc_id % 2 = 0 THEN '[]' ELSE '[{{"id":"f","key":"a.txt","size":5,"checksum":"","download_url":"u"}},{{"id":"","key":"b","size":' || doc_id || ',"checksum":"","download_url":"https://example.org/records/' || doc_id || '/files/b"}}]' END AS files_json FROM documents WHERE doc_id % 9 <> 0""")
def c9_repository_records(spark, sf_dir):
    """Two shapes of record in one table."""
    raw = _raw(
        spark,
        sf_dir,
        id="cast(k as string)",
        oai_identifier="if(k % 2 = 0, 'oai', null)",
        datestamp="'2020-01-02T00:00:00Z'",
        dc=f"""if(k % 2 = 0, named_struct('title', array('A', concat('record ', k)), 'creator', array('Ann ', '', 'Bo'), 'description', array({_words('12', 'long')}), 'identifier', array(concat('https://doi.org/10.2/', k)), 'date', cast(array() as array<string>),
        'type', array('info:eu-repo/semantics/article'), 'language', array('en'), 'subject', array(source, ' ', 'k'), 'rights', array('r'), 'publisher', array('Pub')), null)""",
        doi="'10.3/r'",
        title="if(k % 9 = 0, '', concat('A record ', k))",
        created="'2020-01-02T00'",
        metadata=f"""named_struct('title', if(k % 9 = 0, 'x', ''), 'doi', '', 'creators', array(named_struct('name', 'Ann'), named_struct('name', 'Bo ')), 'description', {_words('12', 'long')}, 'publisher', 'Pub', 'publication_date', '', 'resource_type', named_struct('type', '', 'title', 'poster'),
        'language', '', 'keywords', array(source, 'k'), 'branches', array(named_struct('title', named_struct('tr', 'a', 'en', 'b'))), 'license', 'l', 'access_right', '')""",
        files="array(named_struct('id', 'f', 'key', 'a.txt', 'size', 5L, 'checksum', cast(null as string), 'links', named_struct('self', 'u')), named_struct('id', cast(null as string), 'key', 'b', 'size', k, 'checksum', cast(null as string), 'links', named_struct('self', '')))",
    )
    out = scholarly.repository_records(raw.where("k % 2 = 1 OR k % 9 <> 0"))
    return out.select("id", "doi", "creators", "resource_type", "language", "keywords", "file_count", "total_file_size", "publisher", "publication_date", "word_count", "files_json")


@query("""SELECT doc_id AS trade_id, doc_id / 4.0 AS price, doc_id % 2 = 0 AS is_buyer_maker, 'BTC' AS symbol, 'spot' AS market, doc_id + 7 AS trade_time FROM documents WHERE doc_id % 5 <> 0""")
def c20_trades(spark, sf_dir):
    """One line for each document, some of them bad; a header in each symbol's file goes."""
    line = F.expr("case when doc_id % 5 = 0 then if(doc_id % 2 = 0, 'bad,1,1,1,1', 'Trade_Id,price,qty,quote_qty,time') else concat_ws(',', doc_id, doc_id / 4, ' 1 ', 2.5, doc_id + 7, if(doc_id % 2 = 0, 'True', null)) end")
    out = records.market_rows(table(spark, sf_dir, "documents").select(line.alias("line")), "trades", "BTC")
    return out.select("trade_id", "price", "is_buyer_maker", "symbol", "market", "trade_time")


@query("""SELECT doc_id AS agg_trade_id, doc_id / 8.0 AS price, doc_id - 1 AS first_trade_id, doc_id + 1 AS last_trade_id, false AS is_buyer_maker, 'um' AS market FROM documents WHERE doc_id % 3 <> 0""")
def c20_agg_trades(spark, sf_dir):
    line = F.expr("concat_ws(',', doc_id, doc_id / 8, '3', doc_id - 1, doc_id + 1, if(doc_id % 3 = 0, 'x', '9'), '0')")
    out = records.market_rows(table(spark, sf_dir, "documents").select(line.alias("line")), "agg_trades", "ETH", "um")
    return out.select("agg_trade_id", "price", "first_trade_id", "last_trade_id", "is_buyer_maker", "market")
