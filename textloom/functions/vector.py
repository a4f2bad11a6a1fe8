"""Deterministic hash embeddings and cosine similarity as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIMENSIONS = 24


def tokens(c: Column) -> Column:
    """Runs of three or more ASCII letters and digits, lower case."""
    return F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "), " "), lambda t: F.length(t) >= 3)


def token_hash(t: Column) -> Column:
    """h = 31 h + code, modulo 2**32, over the characters."""
    codes = F.transform(F.split(t, ""), F.ascii)
    return F.aggregate(codes, F.lit(0).cast("long"), lambda h, c: (h * 31 + c).bitwiseAND(F.lit(4294967295)))


def embed_tokens(toks: Column, dim: int = DIMENSIONS) -> Column:
    """Counts of tokens per bucket, scaled to length one; zeros without tokens."""
    buckets = F.transform(toks, lambda t: token_hash(t) % dim)
    counts = F.transform(F.array(buckets), lambda b: F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.size(F.filter(b, lambda x: x == i)).cast("double")))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.element_at(F.transform(counts, lambda v: F.transform(v, lambda x: F.when(norm(v) == 0, 0.0).otherwise(x / norm(v)))), 1)


def embed(c: Column, dim: int = DIMENSIONS) -> Column:
    return embed_tokens(tokens(c), dim)


def cosine(a: Column, b: Column) -> Column:
    """0 for different lengths or a zero vector."""
    a, b = a.cast("array<double>"), b.cast("array<double>")
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    square = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    return F.when((F.size(a) != F.size(b)) | (square(a) == 0) | (square(b) == 0), 0.0).otherwise(dot / (F.sqrt(square(a)) * F.sqrt(square(b))))
