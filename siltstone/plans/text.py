"""Queries over ``documents``: normalisation, redaction, quality gates, exact and near dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import text as t
from siltstone.operators import dedup
from siltstone.plans.registry import query, table, texts


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents", "doc_id")


#: DuckDB expressions of the quality metrics over a column ``x`` of trimmed text.
_TRIM = r"regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')"
_METRICS = r"""m AS (SELECT doc_id, lang, text, x, length(x)::BIGINT AS char_count,
  (CASE WHEN x = '' THEN 0 ELSE len(string_split_regex(x, '\s+')) END)::BIGINT AS word_count, ceil(length(x) / 4.0)::BIGINT AS estimated_tokens,
  CASE WHEN length(x) > 0 THEN round(length(regexp_replace(x, '[^\p{L}]', '', 'g'))::DOUBLE / length(x), 4) ELSE 0 END AS alpha_ratio,
  CASE WHEN length(x) > 0 THEN round(length(regexp_replace(x, '[^!@#$%^&*()_+=\[\]{};'':"\\|,.<>/?~`§±]', '', 'g'))::DOUBLE / length(x), 4) ELSE 0 END AS symbol_ratio,
  CASE WHEN len(ls) > 0 THEN round((len(ls) - len(list_distinct(ls)))::DOUBLE / len(ls), 4) ELSE 0 END AS duplicate_line_fraction,
  CASE WHEN len(ls) > 0 THEN round(len(list_filter(ls, lambda l: ends_with(l, '...') OR ends_with(l, '…')))::DOUBLE / len(ls), 4) ELSE 0 END AS ellipsis_line_fraction,
  CASE WHEN x <> '' THEN round(length(regexp_replace(x, '\s', '', 'g'))::DOUBLE / len(string_split_regex(x, '\s+')), 2) ELSE 0 END AS mean_word_length
  FROM (SELECT *, list_filter(list_transform(string_split(x, chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')), lambda l: l <> '') AS ls FROM (SELECT *, TRIM_X AS x FROM documents)))""".replace("TRIM_X", _TRIM)
_PASSED = "word_count >= 30 AND char_count >= 100 AND symbol_ratio <= 0.2 AND alpha_ratio >= 0.6 AND duplicate_line_fraction <= 0.35 AND ellipsis_line_fraction <= 0.3"


@query(f"""WITH {_METRICS}, k AS (SELECT *, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM m WHERE {_PASSED})
SELECT lang, count(*)::BIGINT AS docs_kept, sum(char_count)::BIGINT AS chars, sum(estimated_tokens)::BIGINT AS est_tokens, round(avg(alpha_ratio), 6) AS mean_alpha FROM k WHERE r = 1 GROUP BY lang""")
def flagship_corpus_by_lang(spark, sf_dir):
    """Hash, measure, gate, drop exact copies, and sum by language."""
    docs = t.with_quality_metrics(_docs(spark, sf_dir)).where(F.size(t.gate_reasons()) == 0)
    docs = docs.select("doc_id", "lang", "char_count", "estimated_tokens", "alpha_ratio", F.sha2("text", 256).alias("key"))
    kept = dedup.drop_exact(docs, "key", "doc_id")
    return kept.groupBy("lang").agg(F.count("*").alias("docs_kept"), F.sum("char_count").alias("chars"), F.sum("estimated_tokens").alias("est_tokens"), F.round(F.avg("alpha_ratio"), 6).alias("mean_alpha"))


_NOISE = "'  ' || text || chr(8203) || chr(160) || 'x' || chr(7) || chr(13) || chr(10) || repeat(chr(10), 5) || chr(9) || ' end  ' || chr(65279)"


@query(f"""WITH n AS (SELECT doc_id, replace(replace(replace({_NOISE}, chr(160), ' '), chr(8203), ''), chr(65279), '') AS a FROM documents),
b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(a, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g'), '\\r\\n|\\r', chr(10), 'g'), '[ \\t]+', ' ', 'g'), '(?m)^ | $', '', 'g') AS b FROM n)
SELECT doc_id, md5(regexp_replace(regexp_replace(b, '\\n{{3,}}', repeat(chr(10), 3), 'g'), '^\\s+|\\s+$', '', 'g')) AS normal FROM b""")
def n1_normalise(spark, sf_dir):
    """The normaliser on texts with deterministic noise: invisible characters, controls, breaks and blanks."""
    noisy = _docs(spark, sf_dir).select("doc_id", F.expr(_NOISE.replace("chr(8203)", "'\u200b'").replace("chr(65279)", "'\ufeff'").replace("chr(160)", "'\u00a0'")).alias("noisy"))
    return noisy.select("doc_id", F.md5(t.normalise(F.col("noisy"))).alias("normal"))


@query(f"""SELECT doc_id, sha256(text) AS raw_sha256, sha256({_TRIM}) AS normalized_sha256, sha256(text) <> sha256({_TRIM}) AS changed FROM (SELECT doc_id, text || '  ' AS text FROM documents)""")
def n2_lineage_hashes(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", F.concat("text", F.lit("  ")).alias("text"))
    raw, new = F.sha2("text", 256), F.sha2(t.normalise(F.col("text")), 256)
    return docs.select("doc_id", raw.alias("raw_sha256"), new.alias("normalized_sha256"), (raw != new).alias("changed"))


_REDACTED = "text"
for _p, _m in t.REDACTIONS:
    _REDACTED = f"regexp_replace({_REDACTED}, '{_p}', '{_m}', 'g')"


@query(f"""SELECT doc_id, md5(r) AS redacted, (length(r) - length(replace(r, '_REDACTED]', '')))::BIGINT // 10 AS marks FROM (SELECT doc_id, {_REDACTED} AS r FROM documents)""")
def n4_redact(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", t.redact(F.col("text")).alias("r"))
    return docs.select("doc_id", F.md5("r").alias("redacted"), F.floor((F.length("r") - F.length(F.replace("r", F.lit("_REDACTED]"), F.lit("")))) / 10).alias("marks"))


@query(f"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace({_REDACTED}, '[ \\t]{{2,}}', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) AS normal
FROM (SELECT doc_id, text || ' a & b <c>  x' || repeat(chr(10), 4) || 'end' AS text FROM documents)""")
def n3_normalise_corpus(spark, sf_dir):
    """Entities, zero-width characters and runs of blanks are put in first, and must all go."""
    noisy = F.concat("text", F.lit(" a &amp; b\u200b &lt;c&gt; \t x\n\n\n\nend"))
    return _docs(spark, sf_dir).select("doc_id", F.md5(t.normalise_corpus(noisy)).alias("normal"))


@query(r"""SELECT doc_id, md5(array_to_string(list_filter(list_transform(string_split_regex(regexp_replace(replace(replace(regexp_replace('<p>' || text || '</p>  .' || chr(10) || ' ' || chr(10) || '<b>R</b>&amp;D &lt;ok', '<[^>]+>', ' ', 'g'), '&amp;', '&'), '&lt;', '<'), '\s+([.,;:!?])', '\1', 'g'), '\n\s*\n+'),
  lambda p: regexp_replace(regexp_replace(p, '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g')), lambda p: p <> ''), chr(10) || chr(10))) AS clean FROM documents""")
def n5_clean_markup(spark, sf_dir):
    marked = F.concat(F.lit("<p>"), "text", F.lit("</p>  .\n \n<b>R</b>&amp;D &lt;ok"))
    return _docs(spark, sf_dir).select("doc_id", F.md5(t.clean_markup(marked)).alias("clean"))


@query("SELECT doc_id, length(text)::BIGINT AS visible, [8203, 8205, 65279]::BIGINT[] AS points FROM documents")
def n6_invisible(spark, sf_dir):
    """Invisible characters are put in and stripped; the histogram's code points are listed in order."""
    noisy = F.concat(F.lit("\u200b"), "text", F.lit("\u200d\ufeff"))
    docs = _docs(spark, sf_dir).select("doc_id", F.length(t.strip_invisible(noisy)).cast("long").alias("visible"), t.invisible_histogram(noisy).alias("found"))
    points = F.transform("found", lambda c: F.ascii(c).cast("long"))
    return docs.select("doc_id", "visible", points.alias("points"))


@query("SELECT doc_id, md5(trim(translate(lower(translate(text, 'İI', 'iı')), 'çğıöşü', 'cgiosu'))) AS folded, contains(translate(lower(translate(text, 'İI', 'iı')), 'çğıöşü', 'cgiosu'), 'the') AS has_the FROM documents")
def n7_turkish_folding(spark, sf_dir):
    folded = t.fold_turkish(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.md5(folded).alias("folded"), folded.contains("the").alias("has_the"))


@query(f"WITH {_METRICS} SELECT doc_id, char_count, word_count, estimated_tokens, alpha_ratio, symbol_ratio, duplicate_line_fraction, ellipsis_line_fraction, mean_word_length FROM m")
def q1_quality_metrics(spark, sf_dir):
    return t.with_quality_metrics(_docs(spark, sf_dir)).select("doc_id", *t.METRICS)


@query(f"""WITH {_METRICS} SELECT doc_id, array_to_string(list_filter([CASE WHEN word_count < 30 THEN 'min_words' END, CASE WHEN char_count < 100 THEN 'min_chars' END, CASE WHEN symbol_ratio > 0.2 THEN 'max_symbol_ratio' END,
CASE WHEN alpha_ratio < 0.6 THEN 'min_alpha_ratio' END, CASE WHEN duplicate_line_fraction > 0.35 THEN 'max_duplicate_line_fraction' END, CASE WHEN ellipsis_line_fraction > 0.3 THEN 'max_ellipsis_line_fraction' END], lambda x: x IS NOT NULL), ',') AS reasons,
{_PASSED} AS quality_passed FROM m""")
def q2_gate_flags(spark, sf_dir):
    """Flag mode: every failed rule, in order."""
    docs = t.with_quality_metrics(_docs(spark, sf_dir))
    return docs.select("doc_id", F.array_join(t.gate_reasons(), ",").alias("reasons"), (F.size(t.gate_reasons()) == 0).alias("quality_passed"))


GATE_SQL = f"WITH {_METRICS} SELECT doc_id, word_count, alpha_ratio FROM m WHERE {_PASSED}"


@query(GATE_SQL)
def q3_gate_drop(spark, sf_dir):
    """Drop mode keeps the metrics of those that pass."""
    docs = t.with_quality_metrics(_docs(spark, sf_dir)).where(F.size(t.gate_reasons()) == 0)
    return docs.select("doc_id", "word_count", "alpha_ratio")


@query(r"""WITH d AS (SELECT doc_id, text, length(text) AS n, list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS ws,
  list_filter(list_transform(string_split(text, chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')), lambda l: length(l) > 10) AS ls FROM documents),
e AS (SELECT *, length(regexp_replace(text, '\s', '', 'g'))::DOUBLE / len(ws) AS mean, list_max(list_transform(list_distinct(ls), lambda x: len(list_filter(ls, lambda y: y = x)))) AS most FROM d)
SELECT doc_id, CASE WHEN n < 100 THEN 'too_short_chars' WHEN len(ws) < 20 THEN 'too_few_words' WHEN mean < 3 OR mean > 15 THEN 'abnormal_word_length'
  WHEN length(regexp_replace(text, '[^#$%^&*~|=+<>{}\[\]\\]', '', 'g'))::DOUBLE / n > 0.25 THEN 'high_symbol_ratio' WHEN len(ls) >= 5 AND most::DOUBLE / len(ls) > 0.35 THEN 'high_repeated_line_ratio' END AS reason FROM e""")
def q4_first_failure(spark, sf_dir):
    return t.with_first_failure(_docs(spark, sf_dir)).select("doc_id", "reason")


@query(r"""SELECT doc_id, length(text) >= 50 AND len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')) >= 10 AS in_bounds,
regexp_matches(lower(title), 'table of contents|editorial board|author index|subject index|title page|back matter|front matter|contents of volume|issue information') AS paratext
FROM (SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN ' Editorial Board ' WHEN 1 THEN 'Front Matter 3' ELSE substr(text, 1, 40) END AS title FROM documents)""")
def q5_record_bounds(spark, sf_dir):
    title = F.expr("CASE doc_id % 4 WHEN 0 THEN ' Editorial Board ' WHEN 1 THEN 'Front Matter 3' ELSE substr(text, 1, 40) END")
    text = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", ((F.length(text) >= 50) & (F.size(t.words_of(text)) >= 10)).alias("in_bounds"), t.is_paratext(title).alias("paratext"))


@query(r"""SELECT doc_id, ceil(length(text) / 4.0)::BIGINT AS by_chars, greatest(1, floor(len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')) * 1.33::DOUBLE))::BIGINT AS by_words,
floor(length(text) * 0.3::DOUBLE)::BIGINT AS by_share FROM documents""")
def q6_token_estimates(spark, sf_dir):
    text = F.col("text")
    return _docs(spark, sf_dir).select("doc_id", t.estimated_tokens(text).alias("by_chars"), t.estimated_tokens_by_words(F.size(t.words_of(text))).alias("by_words"), F.floor(F.length(text) * 0.3).alias("by_share"))


_LANGS = ", ".join(f"{{'n': len(list_filter(w, lambda x: x IN ({', '.join(repr(v) for v in s.split())}))), 'lang': '{k}'}}" for k, s in sorted(t.STOP_WORDS.items()))


@query(rf"""WITH d AS (SELECT doc_id, text, string_split_regex(lower(text), '[^\p{{L}}]+') AS w FROM documents), e AS (SELECT doc_id, text, list_max([{_LANGS}]) AS b FROM d)
SELECT doc_id, CASE WHEN length(regexp_replace(text, '^\s+|\s+$', '', 'g')) < 20 OR b.n = 0 THEN 'und' ELSE b.lang END AS guess FROM e""")
def q7_language(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", t.language(F.col("text")).alias("guess"))


@query("""WITH d AS (SELECT doc_id, text, 900 AS b FROM documents), w AS (SELECT doc_id, text, substr(text, 721, 180) AS tail FROM d),
c AS (SELECT doc_id, text, CASE WHEN contains(tail, chr(10) || '#') THEN 720 + length(tail) - instr(reverse(tail), '#' || chr(10)) - 1 WHEN contains(tail, chr(10) || chr(10)) THEN 720 + length(tail) - instr(reverse(tail), chr(10) || chr(10)) - 1
  WHEN contains(tail, ' ') THEN 720 + length(tail) - instr(reverse(tail), ' ') ELSE 900 END AS cut FROM w)
SELECT doc_id, length(text) > 900 AS truncated, md5(CASE WHEN length(text) <= 900 THEN text ELSE regexp_replace(substr(text, 1, cut), '\\s+$', '') END) AS body FROM c""")
def b4_context_budget(spark, sf_dir):
    body, cut = t.within_budget(F.col("text"), 900)
    return _docs(spark, sf_dir).select("doc_id", cut.alias("truncated"), F.md5(body).alias("body"))


@query("SELECT min(doc_id)::BIGINT AS doc_id, sha256(text) AS content_sha256, count(*)::BIGINT AS copies FROM documents GROUP BY text")
def d1_exact_dedup(spark, sf_dir):
    """First seen wins; how many rows share its content. One partial aggregate, one shuffle of hashes, no sort."""
    return _docs(spark, sf_dir).groupBy(F.sha2("text", 256).alias("content_sha256")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("""WITH k AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first FROM documents)
SELECT doc_id, first <> doc_id AS is_duplicate, CASE WHEN first <> doc_id THEN 'exact' END AS duplicate_type, CASE WHEN first <> doc_id THEN first END AS duplicate_match FROM k""")
def d6_exact_flags(spark, sf_dir):
    return dedup.flag_exact(_docs(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("key")), "key", "doc_id").drop("key")


@query()
def d5_near_dedup(spark, sf_dir):
    """Greedy near dedup over 64-bit fingerprints of UTF-16 FNV-1a shingles, three bits or fewer apart."""
    return dedup.near_greedy(_docs(spark, sf_dir).select("doc_id", "text"), bits=3)


@query()
def d3_simhash(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", dedup.simhash64(F.col("text")).alias("fp"))
    return docs.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("simhash_64"))


@query("""WITH f AS (SELECT doc_id, md5(text) AS h FROM documents)
SELECT a.doc_id AS left_id, b.doc_id AS right_id, bit_count(xor(('0x' || substr(a.h, 1, 15))::BIGINT, ('0x' || substr(b.h, 1, 15))::BIGINT))::INT AS distance FROM f a JOIN f b ON a.doc_id = b.doc_id - 1""")
def d4_hamming(spark, sf_dir):
    """Distances between neighbours' hashes."""
    f = _docs(spark, sf_dir).select("doc_id", F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long").alias("fp"))
    g = f.select((F.col("doc_id") - 1).alias("at"), F.col("doc_id").alias("right_id"), F.col("fp").alias("other"))
    return f.join(g, f["doc_id"] == g["at"]).select(F.col("doc_id").alias("left_id"), "right_id", F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))).alias("distance"))


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def d7_incremental_dedup(spark, sf_dir):
    """Rows whose ids a catalogue has already are skipped."""
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("known"))
    return _docs(spark, sf_dir).join(known, F.col("doc_id") == F.col("known"), "left_anti").select("doc_id", "source")


@query(r"""WITH l AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(x) > 10)) AS line FROM documents), c AS (SELECT doc_id, line, count(*) AS n FROM l GROUP BY ALL)
SELECT doc_id, max(n)::BIGINT AS most, sum(n)::BIGINT AS lines, round(max(n)::DOUBLE / sum(n), 6) AS share FROM c GROUP BY doc_id""")
def a11_line_frequency(spark, sf_dir):
    """The share of a text's most common line."""
    lines = _docs(spark, sf_dir).select("doc_id", F.explode(F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 10)).alias("line"))
    counts = lines.groupBy("doc_id", "line").agg(F.count("*").alias("n"))
    return counts.groupBy("doc_id").agg(F.max("n").alias("most"), F.sum("n").alias("lines"), F.round(F.max("n") / F.sum("n"), 6).alias("share"))


@query(r"""SELECT doc_id, 'b,ç_1,' || source AS tags, 'x.y,z' AS mentions FROM documents""")
def c30_hashtags_mentions(spark, sf_dir):
    """Distinct tags and mentions in the order of their first places."""
    s = F.concat(F.lit("#b @x.y, #ç_1! #b @z (@x.y) #"), "source", F.lit(" # @ #b"))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(t.hashtags(s), ",").alias("tags"), F.array_join(t.mentions(s), ",").alias("mentions"))


@query("""SELECT raw, CASE WHEN ends_with(l, 'k') THEN round(left(l, -1)::DOUBLE * 1e3)::BIGINT WHEN ends_with(l, 'm') THEN round(left(l, -1)::DOUBLE * 1e6)::BIGINT WHEN ends_with(l, 'b') THEN round(left(l, -1)::DOUBLE * 1e9)::BIGINT ELSE coalesce(TRY_CAST(l AS BIGINT), 0) END AS number
FROM (SELECT raw, lower(trim(replace(raw, ',', ''))) AS l FROM (VALUES ('1.2M'), ('45K'), ('3B'), ('1,234'), (' 7 '), ('none')) v(raw))""")
def c29_compact_numbers(spark, sf_dir):
    rows = spark.createDataFrame([(x,) for x in ("1.2M", "45K", "3B", "1,234", " 7 ", "none")], "raw string")
    return rows.select("raw", t.compact_number(F.col("raw")).alias("number"))
