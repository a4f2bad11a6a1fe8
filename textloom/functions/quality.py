"""Text quality, layout and readability measures as expressions on a string column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, words

READABLE = r"[\p{L}\p{N}_\s.,;:!?\-'\"()\[\]{}]"
# What broken extraction leaves behind.
GIBBERISH = [r"[_\-]{3,}", r"[\^*@#%&]{2,}", r"\.{4,}", r"[a-z][A-Z]{2,}[a-z]", r"[^\p{L}\p{N}_\s.,;:!?\-'\"()\[\]{}]{3,}"]
MORE_GIBBERISH = [*GIBBERISH, r"\b\d{10,}\b", r"[\x00-\x08\x0b-\x0c\x0e-\x1f]"]
MIN_CHARS, MIN_READABLE, MAX_GIBBERISH = 500, 0.7, 0.3
MIN_COVERAGE, MIN_PAGE_CHARS = 0.7, 50
# Signs of garbled text, screenshots, corrupted structure, contents pages and publishers' notes.
GARBLE = r"(?i)(?:&[a-z]{1,4};|[A-Z]&[a-z];|\b[a-z]+&[a-z]+\b|[^\x00-\x7F]{3,})"
SCREEN = r"(?:[\x{25A0}-\x{25FF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}]|\bE2[lI]\b)"
CORRUPT = r"(?i)(?:\bC[li]i?apter\b|\b[a-zA-Z]{3,},[a-zA-Z]{2,}\b|\blnforma[a-zA-Z]{2,}\b)"
CONTENTS = r"(?i)(?:\bChapter\s+\d+|\bPart\s+[IVX]+|\bSection\s+\d+\.\d+|\.{4,}\s*\d+|\bpage\s+\d{2,})"
PUBLISHER = r"(?i)(?:\bpublisher\b|\bMurach\b.*\bpublishing\b|\bISBN\b|\bCopyright\s+\d{4}|\bAll rights reserved\b|\bprinted in\b)"
# Words that carry no topic in a title.
TITLE_STOP_WORDS = ["with", "from", "into", "that", "this", "which", "where", "when", "select", "using", "have", "been", "will", "shall", "more", "than", "what", "each", "some", "over", "also", "both", "most", "only"]
LIMITS = {"garble": 0.008, "contents": 3, "publisher": 2, "overlap": 0.15, "duplication": 0.40, "screen": 0.010, "corrupt": 2, "words": 40}


def matches(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def matched_length(c: Column, pattern: str) -> Column:
    """Code points in matches of a pattern."""
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


def readable_chars(c: Column) -> Column:
    return matched_length(c, READABLE + "+")


def gibberish_count(c: Column, patterns: list[str] = GIBBERISH) -> Column:
    return sum((matches(c, p) for p in patterns), F.lit(0))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def text_quality(c: Column) -> dict[str, Column]:
    total, readable, bad = F.length(c), readable_chars(c), gibberish_count(c)
    good = (total >= MIN_CHARS) & (share(readable, total) >= MIN_READABLE) & (share(bad, total) <= MAX_GIBBERISH)
    return {"total_chars": total, "readable_chars": readable, "gibberish_patterns": bad, "readable_ratio": share(readable, total), "gibberish_ratio": share(bad, total), "is_quality_good": good}


def coverage(c: Column) -> Column:
    """Share of readable characters less twice the gibberish matches per character, not below 0."""
    return F.greatest(F.lit(0.0), share(readable_chars(c), F.length(c)) - 2 * share(gibberish_count(c, MORE_GIBBERISH), F.length(c)))


def column_bleed(c: Column, width: int = 100) -> Column:
    """How likely columns ran into each other: the longest line against the mean, and the share of long lines; 0 to 1."""
    sizes = F.transform(F.filter(F.transform(F.split(c, "\n", -1), strip), lambda x: x != ""), F.length)

    def score(s: Column) -> Column:
        n = F.size(s).cast("double")
        mean = F.aggregate(s, F.lit(0), lambda a, x: a + x) / n
        long = F.size(F.filter(s, lambda x: x > width * 0.9)) / n
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.array_max(s) / mean - 1) * 0.3 + long * 0.7))

    return F.element_at(F.transform(F.array(sizes), lambda s: F.when(F.size(s) == 0, 0.0).otherwise(score(s))), 1)


def density(c: Column, pattern: str) -> Column:
    """Characters of a text inside matches."""
    return share(matched_length(c, pattern), F.length(c))


def title_keywords(title: Column, definition: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.concat_ws(" ", title, definition)), F.lit("([a-z]{4,})"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda x: ~x.isin(TITLE_STOP_WORDS)))


def keyword_overlap(keywords: Column, text: Column) -> Column:
    """Share of the keywords that the text holds anywhere."""
    low = F.lower(text)
    return F.when((F.size(keywords) == 0) | (text == ""), 0.0).otherwise(F.size(F.filter(keywords, lambda k: F.contains(low, k))) / F.size(keywords))


def duplication(c: Column) -> Column:
    """Share of sentences of eight or more words that came before; 0 for fewer than four."""
    parts = F.filter(F.transform(F.split(c, r"[.\n!]+", -1), strip), lambda x: F.size(words(x)) >= 8)
    return F.element_at(F.transform(F.array(parts), lambda p: F.when(F.size(p) < 4, 0.0).otherwise((F.size(p) - F.size(F.array_distinct(p))) / F.size(p))), 1)
