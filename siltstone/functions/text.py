"""Text operators as column expressions: normalisers, redaction, quality metrics and gates, estimates, folding.

Whitespace is Unicode's, spelt out, as Java's ``\\s`` is ASCII only. What Spark has no function for (NFKC, HTML entities) runs as
an Arrow-batched pandas UDF; everything else stays in the JVM.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Fixed value: the characters that count as white space.
WS = r"\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
#: Fixed value: the characters that count as symbols in the quality metrics (the hyphen does not).
SYMBOLS = r"!@#$%^&*()_+=\[\]{};':\"\\|,.<>/?~`§±"
#: Fixed value: the symbols of the first-failure filter.
GOPHER_SYMBOLS = r"#$%^&*~|=+<>{}\[\]\\"
#: Redaction patterns and their marks, in the order in which they apply.
REDACTIONS = (
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,7}\b", "[EMAIL_REDACTED]"),
    (r"(?:\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}", "[PHONE_REDACTED]"),
    (r"\b[A-Z]{2}\d{2}[A-Z0-9]{4}\d{7}([A-Z0-9]?){0,16}\b", "[FINANCIAL_REDACTED]"),
    (r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9._-]{10,}\.[A-Za-z0-9_-]{10,}\b", "[SECRET_REDACTED]"),
)
#: Fixed value: characters that are stripped as invisible (U+200C only where joiners need not stay).
INVISIBLE = r"\x{AD}\x{200B}\x{200D}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{2069}\x{FEFF}\x{FFF9}-\x{FFFB}"
#: Fixed value: phrases in a title that mark paratext.
PARATEXT = ("table of contents", "editorial board", "author index", "subject index", "title page", "back matter", "front matter", "contents of volume", "issue information")


#: The same characters one by one, for functions that take a list of characters.
WS_CHARS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or unicodedata.is_normalized("NFKC", x) else unicodedata.normalize("NFKC", x))


def nfkc(c: Column) -> Column:
    """Compatibility form. Only texts with other characters than ASCII are sent to Python; the rest is in it already."""
    return F.coalesce(_nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


@F.pandas_udf(StringType())
def unescaped_nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", html.unescape(x)))


@F.pandas_udf(StringType())
def unescaped(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


def sub(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, pattern, to)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: White space beyond blank, tab and line ends.
_RARE_WS = WS_CHARS.replace("\t", "").replace("\n", "").replace("\r", "").replace(" ", "")


def word_sizes(c: Column) -> Column:
    """(words, solid): how many runs of other characters than white space there are, and their length.

    All white space is made one blank for each run; the blanks that are left are counted by length, not by matching words.
    """
    for mark in "\n\t\r":
        c = F.replace(c, F.lit(mark), F.lit(" "))
    plain = let(c, lambda x: F.when(x.rlike(f"[{_RARE_WS}]"), F.translate(x, _RARE_WS, " " * len(_RARE_WS))).otherwise(x))
    lengths = let(strip(sub(plain, "  +", " ")), lambda x: F.struct(F.length(x).alias("n"), F.length(F.replace(x, F.lit(" "), F.lit(""))).alias("solid")))
    return let(lengths, lambda x: F.struct(F.when(x["n"] == 0, 0).otherwise(x["n"] - x["solid"] + 1).alias("words"), x["solid"].alias("solid")))


def word_count(c: Column) -> Column:
    return word_sizes(c)["words"]


def first_text(*names: str) -> Column:
    """The first candidate field that is neither null nor empty."""
    return F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names))


#: Control characters but tab and line ends, and invisible ones.
_DROPPED = "".join(chr(k) for k in (*range(9), 11, 12, *range(14, 32), 127, 0x200B, 0x200C, 0x200D, 0xFEFF, 0x2060))


def normalise(c: Column, max_breaks: int = 2, compose: bool = True) -> Column:
    """Compatibility form, invisible and control characters, line ends, blanks in lines, runs of breaks (one more than the maximum stays), ends."""
    c = nfkc(c) if compose else c
    # One pass for all that is deleted or becomes a blank.
    c = F.translate(c, "\xa0" + _DROPPED, " ")
    c = F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    c = F.array_join(F.transform(F.split(sub(c, r"[ \t]{2,}|\t", " "), "\n"), strip), "\n")
    return strip(sub(c, rf"\n{{{max_breaks + 1},}}", "\n" * (max_breaks + 1)))


def redact(c: Column) -> Column:
    for pattern, mark in REDACTIONS:
        c = sub(c, pattern, mark)
    return c


def normalise_corpus(c: Column, mask: bool = True) -> Column:
    """Entities and compatibility form, control and zero-width characters, redaction, runs of blanks and breaks (two stay)."""
    c = unescaped_nfkc(c)
    c = sub(sub(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", ""), r"[\x{200B}-\x{200F}\x{FEFF}]", "")
    c = redact(c) if mask else c
    blanks = WS.replace(r"\s", r" \t\x{0C}")
    return strip(sub(sub(c, rf"[{blanks}]{{2,}}", " "), r"\n{3,}", "\n\n"))


@F.pandas_udf(ArrayType(StringType()))
def unescaped_all(s: pd.Series) -> pd.Series:
    return s.map(lambda xs: None if xs is None else [None if x is None else html.unescape(x) for x in xs])


def _untagged(c: Column, controls: bool = True) -> Column:
    c = sub(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", " ") if controls else c
    return sub(c, r"<[^>]+>", " ")


def _in_paragraphs(c: Column) -> Column:
    paragraphs = F.transform(F.split(sub(c, r"\s+([.,;:!?])", "$1"), r"\n\s*\n+"), lambda p: strip(sub(p, r"[ \t]+", " ")))
    return strip(F.array_join(F.filter(paragraphs, lambda p: p != ""), "\n\n"))


def clean_markup(c: Column, controls: bool = True) -> Column:
    """Tags and (if asked) control characters as blanks, entities, blanks before punctuation, paragraphs one blank line apart."""
    return _in_paragraphs(unescaped(_untagged(c, controls)))


def clean_markup_all(array: Column) -> Column:
    """``clean_markup`` of every entry; null entries become empty."""
    return F.transform(unescaped_all(F.transform(array, lambda x: _untagged(F.coalesce(x, F.lit(""))))), _in_paragraphs)


def strip_invisible(c: Column, keep_joiners: bool = False) -> Column:
    return sub(c, f"[{INVISIBLE}{'' if keep_joiners else chr(92) + 'x{200C}'}]", "")


def invisible_histogram(c: Column) -> Column:
    """Every stripped character, for counting."""
    return F.regexp_extract_all(c, F.lit(f"([{INVISIBLE}\\x{{200C}}])"), F.lit(1))


def fold_turkish(c: Column) -> Column:
    """Dotted and dotless i first, then lower case, then letters with marks, then marks of their own: the order matters."""
    low = F.translate(F.lower(F.translate(c, "İI", "iı")), "çğıöşü", "cgiosu")
    return F.trim(sub(low, r"[\x{300}-\x{36F}]+", ""))


def estimated_tokens(c: Column) -> Column:
    return F.ceil(F.length(c) / 4).cast("long")


def estimated_tokens_by_words(words: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(words * 1.33)).cast("long")


def words_of(c: Column) -> Column:
    return F.filter(F.split(c, rf"[{WS}]+"), lambda w: w != "")


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that the optimizer computes once each, however often later expressions use them."""
    for name, c in columns.items():
        df = df.select("*", F.explode(F.array(c)).alias(name))
    return df


def with_quality_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the rounded metrics of a text; gates compare the rounded values.

    All metrics are one struct, whose parts are computed once each; lines are only parted where a text has more than one.
    """

    def ellipsis(x: Column) -> Column:
        return x.endswith("...") | x.endswith("…")

    def of_lines(lines: Column) -> Column:
        n = F.size(lines)
        return F.struct(share(n - F.size(F.array_distinct(lines)), n).alias("copies"), share(F.size(F.filter(lines, ellipsis)), n).alias("ellipses"))

    def of_counts(c: Column) -> Column:
        chars, words, lines = c["chars"], c["sizes"]["words"], c["lines"]
        return F.struct(
            chars.cast("long").alias("char_count"),
            words.cast("long").alias("word_count"),
            F.ceil(chars / 4).cast("long").alias("estimated_tokens"),
            share(c["letters"], chars).alias("alpha_ratio"),
            share(c["symbols"], chars).alias("symbol_ratio"),
            lines["copies"].alias("duplicate_line_fraction"),
            lines["ellipses"].alias("ellipsis_line_fraction"),
            share(c["sizes"]["solid"], words, 2).alias("mean_word_length"),
        )

    def of_text(t: Column) -> Column:
        one = F.struct(F.lit(0.0).alias("copies"), F.when(ellipsis(t), 1.0).otherwise(0.0).alias("ellipses"))
        many = let(F.filter(F.transform(F.split(t, "\n"), strip), lambda x: x != ""), of_lines)
        counts = F.struct(
            F.length(t).alias("chars"),
            word_sizes(t).alias("sizes"),
            (F.length(t) - F.length(sub(t, r"\p{L}+", ""))).alias("letters"),
            F.length(sub(t, f"[^{SYMBOLS}]+", "")).alias("symbols"),
            F.when(F.contains(t, F.lit("\n")), many).otherwise(one).alias("lines"),
        )
        return let(counts, of_counts)

    metrics = let(strip(F.coalesce(F.col(text), F.lit(""))), of_text)
    # A generator, so that a filter on the metrics is not pushed below them, which would compute them twice.
    return df.select("*", F.explode(F.array(metrics)).alias("__metrics")).select("*", "__metrics.*").drop("__metrics")


METRICS = ("char_count", "word_count", "estimated_tokens", "alpha_ratio", "symbol_ratio", "duplicate_line_fraction", "ellipsis_line_fraction", "mean_word_length")

#: Default limits of the quality gate.
GATE = {"min_words": 30, "max_words": None, "min_chars": 100, "max_symbol_ratio": 0.2, "min_alpha_ratio": 0.6, "max_duplicate_line_fraction": 0.35, "max_ellipsis_line_fraction": 0.3}


def gate_reasons(limits: dict | None = None) -> Column:
    """All failed rules, in fixed order, over the columns of ``with_quality_metrics``."""
    g = GATE | (limits or {})
    rules = [("min_words", F.col("word_count") < g["min_words"])]
    if g["max_words"] is not None:
        rules.append(("max_words", F.col("word_count") > g["max_words"]))
    rules += [
        ("min_chars", F.col("char_count") < g["min_chars"]),
        ("max_symbol_ratio", F.col("symbol_ratio") > g["max_symbol_ratio"]),
        ("min_alpha_ratio", F.col("alpha_ratio") < g["min_alpha_ratio"]),
        ("max_duplicate_line_fraction", F.col("duplicate_line_fraction") > g["max_duplicate_line_fraction"]),
        ("max_ellipsis_line_fraction", F.col("ellipsis_line_fraction") > g["max_ellipsis_line_fraction"]),
    ]
    return F.array_compact(F.array(*(F.when(failed, F.lit(name)) for name, failed in rules)))


def with_first_failure(df: DataFrame, text: str = "text", name: str = "reason") -> DataFrame:
    """``df`` with the first rule that a text fails, or null."""
    c = F.col(text)
    chars = F.length(c)

    def most(lines: Column) -> Column:
        """How often the most common line stands: equal lines stand together once sorted."""
        start = F.struct(F.lit("").alias("last"), F.lit(0).alias("n"), F.lit(0).alias("most"))

        def step(acc: Column, x: Column) -> Column:
            n = F.when(acc["last"] == x, acc["n"] + 1).otherwise(1)
            return F.struct(x.alias("last"), n.alias("n"), F.greatest(acc["most"], n).alias("most"))

        return F.aggregate(F.array_sort(lines), start, step, lambda acc: acc["most"])

    def repeated(lines: Column) -> Column:
        n = F.size(lines)
        # Only where enough lines are copies at all are they counted one by one.
        may = (n >= 5) & ((n - F.size(F.array_distinct(lines)) + 1) / n > 0.35)
        return F.when(may, most(lines) / n > 0.35).otherwise(False)

    long_lines = F.filter(F.transform(F.split(c, "\n"), strip), lambda x: F.length(x) > 10)

    def rules(sizes: Column) -> Column:
        mean = sizes["solid"] / sizes["words"]
        return (
            F.when(sizes["words"] < 20, F.lit("too_few_words"))
            .when((mean < 3) | (mean > 15), F.lit("abnormal_word_length"))
            .when(F.length(sub(c, f"[^{GOPHER_SYMBOLS}]+", "")) / chars > 0.25, F.lit("high_symbol_ratio"))
            .when(F.contains(c, F.lit("\n")) & let(long_lines, repeated), F.lit("high_repeated_line_ratio"))
        )

    return df.withColumn(name, F.when(chars < 100, F.lit("too_short_chars")).otherwise(let(word_sizes(c), rules)))


def is_paratext(title: Column) -> Column:
    low = F.lower(strip(title))
    out = F.lit(False)
    for phrase in PARATEXT:
        out = out | low.contains(phrase)
    return out


def within_budget(c: Column, budget: int) -> tuple[Column, Column]:
    """(cut text, whether it was cut): at the last heading, else blank line, else blank in the last fifth, else hard."""
    start = max(0, budget - budget * 2 // 10)
    tail = F.substring(c, start + 1, budget - start)

    def last(mark: str) -> Column:
        back = F.locate(mark[::-1], F.reverse(tail))
        return F.when(back > 0, F.lit(budget) - back - (len(mark) - 1))

    cut = F.coalesce(last("\n#"), last("\n\n"), last(" "), F.lit(budget))
    return F.when(F.length(c) <= budget, c).otherwise(sub(F.substring(c, F.lit(1), cut), rf"[{WS}]+$", "")), F.length(c) > budget


#: Function words by language, for a small scorer where no detector is at hand.
STOP_WORDS = {"en": "the and of to in is that was for with", "de": "der die und das den von nicht mit ist ein", "fr": "les des une est dans que pour sur pas qui", "es": "los las una por con para del que como más"}


def language(c: Column) -> Column:
    """The language whose function words a text has most of; ``und`` for short texts or none."""
    words = F.split(F.lower(c), r"[^\p{L}]+")

    def hits(own: list[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(*own)))

    scores = [F.struct(hits(s.split()).alias("n"), F.lit(k).alias("lang")) for k, s in sorted(STOP_WORDS.items())]
    best = F.greatest(*scores)
    return F.when((F.length(strip(c)) < 20) | (best["n"] == 0), F.lit("und")).otherwise(best["lang"])


def compact_number(c: Column) -> Column:
    """``1.2M``, ``45K``, ``3B`` or plain digits, commas ignored."""
    low = F.lower(F.trim(F.replace(c, F.lit(","), F.lit(""))))
    number = F.regexp_extract(low, r"^(\d+(?:\.\d+)?)[kmb]$", 1).try_cast("double")
    scale = F.when(low.endswith("k"), 1e3).when(low.endswith("m"), 1e6).when(low.endswith("b"), 1e9)
    return F.coalesce(F.round(number * scale).cast("long"), F.regexp_extract(low, r"^(-?\d+)", 1).try_cast("long"), F.lit(0).cast("long"))


def distinct_matches(c: Column, pattern: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)))


def hashtags(c: Column) -> Column:
    return distinct_matches(c, r"#([a-zA-Z0-9_\x{C0}-\x{24F}]+)")


def mentions(c: Column) -> Column:
    return distinct_matches(c, r"@([a-zA-Z0-9_.]+)")
