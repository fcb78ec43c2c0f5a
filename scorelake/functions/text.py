"""Text rules over a comment column (D)."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions import vocab
from scorelake.sizing import small_table

# Unicode classes for \d \s \w \b, and only "\n" ends a line for ".".
UNICODE = "(?Ud)"
UNICODE_NOCASE = "(?iUd)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def terms_array(terms: Sequence[str]) -> Column:
    """A constant array; one expression however long the list."""
    return F.split(F.lit("\x1f".join(terms)), "\x1f")


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """True when any term is a substring; NULL text gives false."""
    if not terms:
        return F.lit(False)
    if len(terms) <= 3:
        return F.coalesce(reduce(or_, [F.contains(text, F.lit(term)) for term in terms]), F.lit(False))
    return F.coalesce(F.exists(terms_array(terms), lambda term: F.contains(text, term)), F.lit(False))


def hits(text: Column, terms: Sequence[str]) -> Column:
    """How many of the terms are substrings."""
    return F.size(F.filter(terms_array(terms), lambda term: F.contains(text, term)))


def keyword_sentiment(
    text: Column,
    positive: Sequence[str] = vocab.POSITIVE_TERMS,
    negative: Sequence[str] = vocab.NEGATIVE_TERMS,
    scale: float = 5.0,
) -> Column:
    def score(low: Column) -> Column:
        total = hits(low, positive) - hits(low, negative)
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), total / F.lit(scale)))

    return F.when(text.isNull(), F.lit(0.0)).otherwise(let(F.lower(text), score))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?U)[^\s\x1c-\x1f]+"), F.lit(0))


def lexicon_sentiment(df: DataFrame, row_id: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Mean polarity of the words found in a ``(token, polarity)`` table, 0 when none is found.

    A small lexicon is broadcast, so one row per text shuffles. A wide one is joined on words already
    counted per text, so a frequent word is no wider than the texts that hold it.
    """
    spoken = df.select(row_id, F.explode_outer(words(F.lower(F.col(text)))).alias("token"))
    table = lexicon.select("token", "polarity")
    small = small_table(table)
    if small is not None:
        hits = spoken.join(F.broadcast(small), "token", "left").withColumn("n", F.lit(1))
    else:
        counted = spoken.groupBy(row_id, "token").agg(F.count(F.lit(1)).alias("n"))
        hits = counted.join(table, "token", "left")
    found = F.sum(F.when(F.col("polarity").isNotNull(), F.col("n")))
    mean = F.try_divide(F.sum(F.col("n") * F.col("polarity")), found)
    return hits.groupBy(row_id).agg(F.coalesce(mean, F.lit(0.0)).alias("sentiment"))


def extract_salary(text: Column, patterns: Sequence[str] = vocab.SALARY_PATTERNS) -> Column:
    def amount(pattern: str) -> Column:
        found = F.nullif(F.regexp_extract(text, UNICODE_NOCASE + pattern, 1), F.lit(""))
        return F.translate(found, ",.", ".").try_cast("double")

    value = F.coalesce(*[amount(p) for p in patterns])
    thousands = (value < 100) & F.contains(F.lower(text), F.lit("k"))
    return F.when(thousands, value * 1000).otherwise(value)


def extract_days(text: Column, pattern: str = vocab.DAYS_PATTERN) -> Column:
    return F.nullif(F.regexp_extract(F.lower(text), UNICODE + pattern, 1), F.lit("")).try_cast("bigint")


def engagement_flag(
    text: Column,
    engaged: Sequence[str] = vocab.ENGAGEMENT_TERMS,
    blockers: Sequence[str] = vocab.ENGAGEMENT_BLOCKERS,
    hired: Sequence[str] = vocab.HIRED_TERMS,
    denials: Sequence[str] = vocab.HIRED_DENIALS,
) -> Column:
    def flag(low: Column) -> Column:
        shortcut = contains_any(low, hired) & ~contains_any(low, denials)
        return shortcut | (contains_any(low, engaged) & ~contains_any(low, blockers))

    return let(F.lower(text), flag)


def culture_flag(text: Column, terms: Sequence[str] = vocab.CULTURE_TERMS) -> Column:
    return let(F.lower(text), lambda low: contains_any(low, terms))


def has_term(low: Column, term: Column) -> Column:
    """Word-boundary hit. The cheap substring test spares the regex on most rows."""
    pattern = F.concat(F.lit(UNICODE + r"\b"), term, F.lit(r"\b"))
    return F.contains(low, term) & F.rlike(low, pattern)


def extract_terms(text: Column, terms: Sequence[str] = vocab.COMMENT_SKILLS) -> Column:
    return let(F.lower(text), lambda low: F.filter(terms_array(terms), lambda term: has_term(low, term)))


# The flag families below take ``low``, the lower-cased text as its own column, so that one lowering
# serves every flag.


def with_lower(df: DataFrame, text: str, out: str = "__low") -> DataFrame:
    return df.withColumn(out, F.lower(F.col(text)))


def term_flags(low: Column, terms: Sequence[str] = vocab.FLAGGED_SKILLS, prefix: str = "menciona_") -> dict[str, Column]:
    return {prefix + t: F.coalesce(has_term(low, F.lit(t)), F.lit(False)) for t in terms}


def literal_starts(pattern: str) -> list[str] | None:
    """The literal text each alternative must begin with, or None when one has no clear start."""
    if re.search(r"[()]", pattern):
        return None
    starts = []
    for part in pattern.split("|"):
        plain = re.match(r"(?:\\[$.]|[^\\\[\]{}.*+?^$])*", part)[0]
        rest = part[len(plain):]
        text = re.sub(r"\\(.)", r"\1", plain)
        text = text[:-1] if rest[:1] in ("*", "?", "{") else text
        if len(text) < 2:
            return None
        starts.append(text.lower())
    return starts


def regex_flags(text: Column, low: Column, patterns: Mapping[str, str] = vocab.MENTION_PATTERNS) -> dict[str, Column]:
    """Case-insensitive pattern flags. A row that holds none of a pattern's literal starts skips the regex."""
    out = {}
    for name, pattern in patterns.items():
        hit = text.rlike(UNICODE_NOCASE + pattern)
        starts = literal_starts(pattern)
        if starts:
            # Letters that fold to ASCII from outside it are left to the regex.
            odd = F.contains(text, F.lit("\u017f")) | F.contains(text, F.lit("\u212a"))
            hit = (contains_any(low, starts) | odd) & hit
        out[name] = F.coalesce(hit, F.lit(False))
    return out


def keyword_group_flags(low: Column, groups: Mapping[str, Sequence[str]] = vocab.MENTION_GROUPS) -> dict[str, Column]:
    return {name: contains_any(low, terms) for name, terms in groups.items()}


def text_length(text: Column) -> Column:
    return F.coalesce(F.char_length(text), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)[^\s\x1c-\x1f]+")), F.lit(0))


def withdrawal_risk(other_offer: Column, values: Column, engaged: Column) -> Column:
    return (other_offer | (values & ~engaged)).cast("int")
