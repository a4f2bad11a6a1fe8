"""Checks of SQL snippets as text, rewriting onto practice schemas, and a bank of misconception patterns.

Tables: snippets (id, sql, concept). Pattern banks are small fixed lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

KINDS = {"SELECT": "SELECT", "INSERT": "INSERT", "UPDATE": "UPDATE", "DELETE": "DELETE", "CREATE": "CREATE", "ALTER": "ALTER", "DROP": "DROP", "WITH": "CTE"}
# Name -> pattern of what is always wrong
FAULTS = {"duplicate_from": r"(?i)\bFROM\s+FROM\b", "duplicate_where": r"(?i)\bWHERE\s+WHERE\b", "duplicate_select": r"(?i)\bSELECT\s+SELECT\b", "double_star": r"\*\*", "double_equals": r"=="}
# Patterns of comparisons with nulls.
NULL_MISTAKES = [("null-equals", "where-filter", 1, r"(?i)=\s*NULL\b"), ("not-null-differs", "where-filter", 2, r"(?i)(!=|<>)\s*NULL\b")]
# (id, concept, order, pattern): typical mistakes of learners, ours but for the first two
MISCONCEPTIONS = [
    *NULL_MISTAKES, ("aggregate-in-where", "group-by", 1, r"(?i)\bWHERE\b[^;]*\b(COUNT|SUM|AVG|MIN|MAX)\s*\("),
    ("having-without-group", "group-by", 2, r"(?i)^[^;]*\bHAVING\b"), ("comma-join", "inner-join", 1, r"(?i)\bFROM\s+\w+\s*,\s*\w+"), ("join-without-on", "inner-join", 2, r"(?i)\bJOIN\s+\w+\s*(;|$|WHERE\b)"),
    ("select-star", "select-basic", 1, r"(?i)SELECT\s+\*"), ("like-without-wildcard", "where-filter", 3, r"(?i)\bLIKE\s+'[^%_']*'"), ("order-by-number", "order-by", 1, r"(?i)\bORDER\s+BY\s+\d"),
    ("distinct-call", "select-basic", 2, r"(?i)\bDISTINCT\s*\("), ("quoted-number", "where-filter", 4, r"=\s*'\d+'"), ("update-without-where", "where-filter", 5, r"(?i)^UPDATE\s+\w+\s+SET\b[^;]*$"),
]
#: (table, column, table, column) of the practice schema's foreign keys.
FOREIGN_KEYS = [("orders", "user_id", "users", "id"), ("orders", "product_id", "products", "id"), ("employees", "dept_id", "departments", "id")]
#: Names of textbook tables and columns on the practice schema.
RENAMES = [("sailors", "users"), ("boats", "products"), ("reserves", "orders"), ("sailor_id", "user_id"), ("boat_id", "product_id")]
SNIPPETS = [
    (1, "SELECT name FROM users WHERE age > 30;", "where-filter"), (2, "SELECT * FROM users WHERE email = NULL;", "where-filter"), (3, "SELECT dept, COUNT(*) FROM employees WHERE COUNT(*) > 3 GROUP BY dept;", "group-by"),
    (4, "SELECT u.name FROM users u JOIN orders o ON orders.user_id = users.id;", "inner-join"), (5, "SELECT users.name FROM users JOIN orders ON orders.id = users.id", "inner-join"), (6, "INSERT users VALUES (1, 'a');", "select-basic"),
    (7, "UPDATE users SET age = 3;", "where-filter"), (8, "DELETE FROM users;", "where-filter"), (9, "SELECT name FROM FROM users;", "select-basic"), (10, "SELECT (name FROM users;", "select-basic"), (11, "", "select-basic"), (12, "HELLO world;", "select-basic"),
    (13, "WITH x AS (SELECT 1) SELECT * FROM x;", "subquery"), (14, "SELECT name FROM Sailors, Boats WHERE sailor_id == 3;", "inner-join"), (15, "SELECT name FROM users ORDER BY 1;", "order-by"), (16, "select distinct(name) from users where name like 'bob';", "select-basic"),
    (17, "SELECT id FROM users; DROP TABLE users;", "select-basic"), (18, "SELECT a FROM reserves WHERE id = '12';", "where-filter"), (19, None, "select-basic"), (20, "SELECT COUNT(*) FROM orders HAVING COUNT(*) > 1;", "group-by"),
]


def snippets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SNIPPETS, "id int, sql string, concept string")


def kind(sql: Column) -> Column:
    """The statement's kind by its first word, null if none is known."""
    out = F.lit(None).cast("string")
    for start, name in reversed(KINDS.items()):
        out = F.when(F.startswith(F.upper(strip(sql)), F.lit(start)), name).otherwise(out)
    return out


def validate(rows: DataFrame) -> DataFrame:
    """id, kind, is_valid, issues, warnings: an empty text and an unknown statement end the checks."""
    sql = strip(F.coalesce(F.col("sql"), F.lit("")))
    rows = rows.select("id", sql.alias("s"), F.upper(sql).alias("u")).withColumn("kind", kind(F.col("s")))
    k, u, s = F.col("kind"), F.col("u"), F.col("s")
    lacks = lambda w: ~F.contains(u, F.lit(w))
    count = lambda c: F.length(s) - F.length(F.replace(s, F.lit(c), F.lit("")))
    issues = [
        F.when(~F.endswith(s, F.lit(";")), "no_semicolon"), F.when(count("(") != count(")"), "parentheses"), *(F.when(F.rlike(s, F.lit(p)), n) for n, p in FAULTS.items()), F.when((k == "SELECT") & lacks("FROM"), "no_from"),
        F.when((k == "INSERT") & lacks("INTO"), "no_into"), F.when((k == "INSERT") & lacks("VALUES") & lacks("SELECT"), "no_values"), F.when((k == "UPDATE") & lacks("SET"), "no_set"),
    ]
    warnings = [F.when(F.rlike(s, F.lit(r"(?i);\s*DROP\s+")), "dangerous"), F.when((k == "SELECT") & F.rlike(u, F.lit(r"SELECT\s+\*")), "select_star"), F.when(k.isin("UPDATE", "DELETE") & lacks("WHERE"), "all_rows")]
    found = F.when(s == "", "empty").when(k.isNull(), "unknown_statement").otherwise(F.concat_ws(",", *issues))
    out = rows.select("id", "kind", found.alias("issues"), F.when((s == "") | k.isNull(), "").otherwise(F.concat_ws(",", *warnings)).alias("warnings"))
    return out.select("id", "kind", (F.col("issues") == "").alias("is_valid"), "issues", "warnings")


def scan_misconceptions(rows: DataFrame, bank: list | None = None) -> DataFrame:
    """id, misconception, concept, ord of every pattern that a snippet matches; the bank is unrolled into the plan, so rows are read once."""
    bank = bank or MISCONCEPTIONS
    sql = F.coalesce(F.col("sql"), F.lit(""))
    hits = F.array(*(F.when(F.rlike(sql, F.lit(p)), F.struct(F.lit(m).alias("misconception"), F.lit(c).alias("concept"), F.lit(o).alias("ord"))) for m, c, o, p in bank))
    return rows.select("id", F.explode(F.array_compact(hits)).alias("h")).select("id", "h.misconception", "h.concept", "h.ord")


def join_checks(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """id, condition, is_key: join conditions `ON a.b = c.d` and whether either direction is a foreign key."""
    pattern = r"(?i)\bON\s+(\w+\.\w+\s*=\s*\w+\.\w+)"
    found = rows.select("id", F.explode(F.regexp_extract_all(F.coalesce("sql", F.lit("")), F.lit(pattern), F.lit(1))).alias("condition"))
    sides = found.select("id", F.regexp_replace(F.lower("condition"), r"\s", "").alias("condition")).distinct()
    known = keys.select(F.concat_ws("=", F.concat_ws(".", "a", "b"), F.concat_ws(".", "c", "d")).alias("k")).union(keys.select(F.concat_ws("=", F.concat_ws(".", "c", "d"), F.concat_ws(".", "a", "b"))))
    return sides.join(F.broadcast(known), F.col("condition") == F.col("k"), "left").select("id", "condition", F.col("k").isNotNull().alias("is_key"))


def rewrite(sql: Column, renames: list[tuple[str, str]] | None = None) -> Column:
    """Whole words renamed in any case, white space folded, closed by a semicolon; an empty text stays empty."""
    out = sql
    for a, b in renames or RENAMES:
        out = F.regexp_replace(out, rf"(?i)\b{a}\b", b)
    out = strip(F.regexp_replace(out, r"\s+", " "))
    return F.when(out == "", "").when(F.endswith(out, F.lit(";")), out).otherwise(F.concat(out, F.lit(";")))


def tables_used(rows: DataFrame) -> DataFrame:
    """id, table of names after FROM and JOIN."""
    return rows.select("id", F.explode(F.regexp_extract_all(F.lower(F.coalesce("sql", F.lit(""))), F.lit(r"\b(?:from|join)\s+(\w+)"), F.lit(1))).alias("table")).distinct()


def prose_share(block: Column) -> Column:
    """Share of a block's lines, blank ones left out, that hold three or more function words."""
    lines = F.filter(F.transform(F.split(block, "\n", -1), strip), lambda x: x != "")
    prose = F.filter(lines, lambda x: F.regexp_count(x, F.lit(FUNCTION_WORDS)) >= 3)
    return F.when(F.size(lines) > 0, F.size(prose) / F.size(lines)).otherwise(0.0)


# Function words of English prose that SQL hardly has.
FUNCTION_WORDS = (
    r"(?i)\b(?:the|this|that|which|we|you|it|they|have|has|is|are|was|were|can|will|be|not|if|with|from|by|an|what|how|when|where|whether|"
    r"also|such|only|more|most|all|both|each|every|some|any|would|should)\b"
)
