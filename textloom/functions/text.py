"""Text cleaning as expressions on a string column; all stay in the JVM.

Java's `\\w` is ASCII, so word characters are spelt as letters, digits and `_`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wrong readings of scanned text and what they stand for, in the order applied.
OCR_FIXES = [
    (r"frrst", "first"),
    (r"ru·e", "rule"),
    (r"ru\.", "rule"),
    (r"fr·om", "from"),
    (r"\bo\s*f\b", "of"),
    (r"\bt\s*o\b", "to"),
    (r"\bs\s*t\s*a\s*t\s*e\s*m\s*e\s*n\s*t\b", "statement"),
]
# Typographic characters and their plain forms.
PLAIN_CHARACTERS = [("·", " "), ("―", "-"), ("—", "-"), ("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"')]
# Statement words that open a line of SQL.
SQL_LINE_STARTS = ["SELECT ", "FROM ", "WHERE ", "INSERT ", "UPDATE ", "DELETE ", "CREATE ", "ALTER ", "DROP ", "JOIN ", "GROUP ", "ORDER ", "HAVING ", "LIMIT ", "UNION ", "VALUES ", "AND ", "OR "]
# Lines of chapters, page numbers, sections and figures.
CHAPTER_LINE = r"(?mi)^Chapter\s+\d+\s+.*?\d{1,3}\s*$"
PAGE_NUMBER_LINE = r"(?m)^\s*\d{1,3}\s*$"
SECTION_LINE = r"(?mi)^Section\s+\d+\s+.*?$"
FIGURE_LINE = r"(?i)^\s*Figure\s+\d+[\-.]\d+\s*$"
FIGURE_REFERENCE = r"(?i)Figure\s+\d+[\-.]\d+.*$"
BLANKS = " \t\n\r\f\u000b"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def normalize(c: Column) -> Column:
    """NUL and runs of blanks and tabs become one blank, runs of line breaks one; stripped."""
    c = F.regexp_replace(F.replace(c, F.lit("\x00"), F.lit(" ")), r"[ \t]+", " ")
    return strip(F.regexp_replace(c, r"\n{2,}", "\n"))


def fingerprint(c: Column) -> Column:
    """Lower case, stripped, each run of white space one blank."""
    return F.regexp_replace(strip(F.lower(c)), r"\s+", " ")


def similarity_hash(c: Column) -> Column:
    """MD5 of the fingerprint."""
    return F.md5(fingerprint(c).cast("binary"))


def bound(c: Column, body: Callable[[Column], Column]) -> Column:
    """body(c) with c computed once: an array of one element binds it, whatever else names it."""
    return F.element_at(F.transform(F.array(c), body), 1)


def drop_near_paragraphs(c: Column, least: int = 20, ratio: float = 0.95) -> Column:
    """Paragraphs (at blank lines) whose fingerprint is held by, or holds, a kept one of nearly its length go; short ones stay."""
    paragraphs = lambda c: F.transform(F.split(c, "\n\n", -1), lambda p: F.struct(p.alias("p"), fingerprint(p).alias("f"), (F.length(strip(p)) >= least).alias("long")))
    empty = F.struct(F.array().cast("array<string>").alias("kept"), F.array().cast("array<string>").alias("seen"))

    def near(seen: Column, f: Column) -> Column:
        return F.exists(seen, lambda s: (F.least(F.length(s), F.length(f)) >= ratio * F.greatest(F.length(s), F.length(f))) & (F.contains(s, f) | F.contains(f, s)))

    def step(acc: Column, x: Column) -> Column:
        drop = x["long"] & near(acc["seen"], x["f"])
        kept = F.when(drop, acc["kept"]).otherwise(F.array_append(acc["kept"], x["p"]))
        seen = F.when(drop | ~x["long"], acc["seen"]).otherwise(F.array_append(acc["seen"], x["f"]))
        return F.struct(kept.alias("kept"), seen.alias("seen"))

    # a text of one paragraph has nothing to compare
    return bound(c, lambda x: F.when((F.length(x) < least) | ~F.contains(x, F.lit("\n\n")), x).otherwise(F.aggregate(paragraphs(x), empty, step, lambda acc: F.array_join(acc["kept"], "\n\n"))))


def drop_repeated_lines(c: Column, repeats: int = 3) -> Column:
    """Every copy of a line of two or more characters that comes `repeats` times or more (stripped, lower case) goes."""
    norm = lambda x: F.lower(strip(x))
    # in sorted order a repeated line equals the one repeats - 1 places on
    often = lambda lines: bound(F.array_sort(F.filter(F.transform(lines, norm), lambda x: F.length(x) >= 2)), lambda s: F.array_distinct(F.filter(s, lambda x, i: F.coalesce(F.get(s, i + (repeats - 1)) == x, F.lit(False)))))
    kept = lambda lines: bound(often(lines), lambda o: F.when(F.size(o) == 0, F.array_join(lines, "\n")).otherwise(F.array_join(F.filter(lines, lambda x: ~F.array_contains(o, norm(x))), "\n")))
    return bound(F.split(c, "\n", -1), kept)


def join_lines(c: Column) -> Column:
    """Words broken at line ends are mended, and a line goes on from one that does not end a sentence."""
    c = F.regexp_replace(c, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", "$1$2")
    c = strip_lines(c)
    return F.regexp_replace(c, r"([^.!?:;\n])\n(?=[^\n])", "$1 ")


def strip_lines(c: Column) -> Column:
    """Each line stripped."""
    return F.regexp_replace(F.btrim(c, F.lit(" \t\r\f\u000b")), r"[ \t\r\f\x0B]*\n[ \t\r\f\x0B]*", "\n")


def mend_punctuation(c: Column) -> Column:
    """A blank after a full stop before a capital, no runs of blanks, no white space before closing marks."""
    c = F.regexp_replace(c, r"(?<=[a-zA-Z])\.([A-Z])", r". $1")
    c = F.regexp_replace(c, r" {2,}", " ")
    return F.regexp_replace(c, r"\s+([.,;:!?)\]])", "$1")


def drop_page_furniture(c: Column) -> Column:
    """Chapter lines with page numbers, lines of a page number alone and section lines go."""
    for pattern in (CHAPTER_LINE, PAGE_NUMBER_LINE, SECTION_LINE):
        c = F.regexp_replace(c, pattern, "")
    return strip(F.regexp_replace(c, r"\n{2,}", "\n"))


def drop_figure_references(c: Column) -> Column:
    """Lines that are a figure's number alone go; elsewhere a reference goes with what follows on its line."""
    lines = F.filter(F.split(c, "\n", -1), lambda x: ~F.rlike(x, F.lit(FIGURE_LINE)))
    return F.array_join(F.transform(lines, lambda x: F.regexp_replace(x, FIGURE_REFERENCE, "")), "\n")


def mend_scans(c: Column) -> Column:
    """Common wrong readings and typographic characters, one after the other."""
    for pattern, to in OCR_FIXES:
        c = F.regexp_replace(c, f"(?i){pattern}", to)
    for a, b in PLAIN_CHARACTERS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def clean(c: Column, deduplicate: bool = True) -> Column:
    """The whole chain for reading: normalise, drop furniture and figure references, mend, join lines, drop repeats."""
    c = mend_punctuation(join_lines(mend_scans(drop_figure_references(drop_page_furniture(normalize(c))))))
    if deduplicate:
        c = drop_repeated_lines(drop_near_paragraphs(c, 30), 3)
    return strip(F.regexp_replace(F.regexp_replace(c, r"\n{2,}", "\n\n"), r"[ \t]+", " "))


def code_kind(line: Column) -> Column:
    """'sql', 'output' or '' for a line."""
    upper = strip(F.upper(line))
    starts = F.lit(False)
    for word in SQL_LINE_STARTS:
        starts = starts | F.startswith(upper, F.lit(word))
    return (
        F.when(starts | F.rlike(line, F.lit(r"^\s*[\p{L}\p{N}_]+\s*[=<>!]+\s*[\p{L}\p{N}_'\"]")), "sql")
        .when(F.contains(line, F.lit("|")) | F.rlike(line, F.lit(r"^\s*-+\s*$")), "output")
        .otherwise("")
    )


def slug(c: Column) -> Column:
    """Lower case, runs of anything but ASCII letters and digits one hyphen, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), F.lit("-"))


def words(c: Column) -> Column:
    """White-space separated words."""
    return F.filter(F.split(c, r"\s+", -1), lambda x: x != "")


def tidy_chunk(c: Column) -> Column:
    """A chunk for display: runs of blanks and of three or more line breaks shortened, stripped."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def segments_of_markdown(c: Column) -> Column:
    """Parts of a markdown text, each from a heading of level two or more to the next."""
    return F.filter(F.split(c, r"\n(?=##+\s)", -1), lambda x: strip(x) != "")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two texts as sets of lower-case words; 0 if either has none."""
    x, y = F.array_distinct(words(F.lower(a))), F.array_distinct(words(F.lower(b)))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


# Wrong readings found in scanned textbooks and the words they stand for.
SCAN_WORDS = [
    (r"\bArz\b", "An"), (r"\bstatc\b", "state"), (r"\binforination\b", "information"), (r"\bCalcuIu,s\b", "Calculus"), (r"\bCalcuIus\b", "Calculus"), (r"\bstaternent\b", "statement"), (r"\brne\b", "me"), (r"\bquesry\b", "query"),
    (r"\bproblern\b", "problem"), (r"\bdetcrminc\b", "determine"), (r"\bopcrator\b", "operator"), (r"\bfonns\b", "forms"), (r"\bdepart~ent\b", "department"), (r"\bempl~yee\b", "employee"), (r"\bSCALI'-I\]P", "SCALABILITY"), (r"\bKACTSiSEC\b", "FACTS/SEC"),
]


def mend_scanned_words(c: Column) -> Column:
    for pattern, to in SCAN_WORDS:
        c = F.regexp_replace(c, f"(?i){pattern}", to)
    return c


def drop_column_repeats(c: Column) -> Column:
    """Lines of which the first 50, 40 or 30 characters (as many as it has) open a kept line go; lines of more than 30 are remembered by 50.

    A fold over the lines of one text: what is kept depends on what was kept before.
    """
    lines = F.split(c, "\n", -1)
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.array().cast("array<string>").alias("seen"))

    def step(acc: Column, line: Column) -> Column:
        s = strip(line)
        n = F.least(F.lit(50), F.length(s))
        again = F.exists(F.array(n, n - 10, n - 20), lambda k: (k > 20) & F.array_contains(acc["seen"], F.substr(s, F.lit(1), k)))
        kept = F.when(again, acc["kept"]).otherwise(F.array_append(acc["kept"], line))
        seen = F.when(again | (F.length(s) <= 30), acc["seen"]).otherwise(F.array_append(acc["seen"], F.substr(s, F.lit(1), F.lit(50))))
        return F.struct(kept.alias("kept"), seen.alias("seen"))

    return F.aggregate(lines, start, step, lambda acc: F.array_join(acc["kept"], "\n"))


def tidy_format(c: Column) -> Column:
    """At most one blank line, no runs of blanks, no lines of a dash alone."""
    c = F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"[ \t]{2,}", " ")
    return F.regexp_replace(c, r"\n\s*[-—]\s*\n", "\n")
