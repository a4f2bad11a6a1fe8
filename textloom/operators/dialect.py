"""Writers of SQL expressions: one rule text, for Spark's SQL and for the SQL that checks it."""

from __future__ import annotations


class Spark:
    """Expressions as Spark's parser reads them."""

    def lit(self, s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t") + "'"

    def rx(self, x: str, pattern: str) -> str:
        return f"rlike({x}, {self.lit(pattern)})"

    def count(self, x: str, pattern: str) -> str:
        return f"regexp_count({x}, {self.lit(pattern)})"

    def some(self, xs: str, v: str, condition: str) -> str:
        return f"exists({xs}, {v} -> {condition})"

    def each(self, xs: str, v: str, value: str) -> str:
        return f"transform({xs}, {v} -> {value})"

    def keep(self, xs: str, v: str, condition: str) -> str:
        return f"filter({xs}, {v} -> {condition})"

    def size(self, xs: str) -> str:
        return f"size({xs})"

    def at(self, xs: str, i: str) -> str:
        return f"get({xs}, ({i}) - 1)"

    def strip(self, x: str) -> str:
        return f"trim(BOTH {self.lit(' ' + chr(9) + chr(10))} FROM {x})"

    def split(self, x: str, by: str) -> str:
        return f"split({x}, {self.lit(by)})"

    def words(self, x: str) -> str:
        return f"filter(split({x}, {self.lit(chr(92) + 's+')}), zw -> zw <> '')"

    def join(self, xs: str) -> str:
        return f"array_join({xs}, ' ')"

    def array(self, *xs: str) -> str:
        return f"array({', '.join(xs)})"

    def empty(self, kind: str = "string") -> str:
        return f"cast(array() as array<{kind}>)"

    def both(self, a: str, b: str) -> str:
        return f"concat({a}, {b})"

    def first(self, xs: str, n: str) -> str:
        return f"slice({xs}, 1, cast({n} as int))"

    def struct(self, **fields: str) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    def steps(self, n: str) -> str:
        """1 to n; n may be 0."""
        return f"filter(sequence(1, greatest({n}, 1)), zs -> zs <= {n})"

    def total(self, xs: str) -> str:
        return f"aggregate({xs}, cast(0 as bigint), (za, zx) -> za + zx)"

    def text(self, x: str) -> str:
        return f"cast({x} as string)"


class Duck(Spark):
    """The same expressions for DuckDB."""

    def lit(self, s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def rx(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, {self.lit(pattern)})"

    def count(self, x: str, pattern: str) -> str:
        return f"len(regexp_extract_all({x}, {self.lit(pattern)}))"

    def some(self, xs: str, v: str, condition: str) -> str:
        return f"(len(list_filter({xs}, lambda {v}: {condition})) > 0)"

    def each(self, xs: str, v: str, value: str) -> str:
        return f"list_transform({xs}, lambda {v}: {value})"

    def keep(self, xs: str, v: str, condition: str) -> str:
        return f"list_filter({xs}, lambda {v}: {condition})"

    def size(self, xs: str) -> str:
        return f"len({xs})"

    def at(self, xs: str, i: str) -> str:
        return f"({xs})[{i}]"

    def strip(self, x: str) -> str:
        return f"trim({x}, ' ' || chr(9) || chr(10))"

    def split(self, x: str, by: str) -> str:
        return f"string_split({x}, {self.lit(by)})"

    def words(self, x: str) -> str:
        return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda zw: zw <> '')"

    def join(self, xs: str) -> str:
        return f"array_to_string({xs}, ' ')"

    def array(self, *xs: str) -> str:
        return f"[{', '.join(xs)}]"

    def empty(self, kind: str = "string") -> str:
        return f"[]::{'VARCHAR' if kind == 'string' else kind}[]"

    def both(self, a: str, b: str) -> str:
        return f"list_concat({a}, {b})"

    def first(self, xs: str, n: str) -> str:
        return f"list_slice({xs}, 1, {n})"

    def struct(self, **fields: str) -> str:
        return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"

    def steps(self, n: str) -> str:
        return f"range(1, ({n}) + 1)"

    def total(self, xs: str) -> str:
        return f"coalesce(list_sum({xs}), 0)"

    def text(self, x: str) -> str:
        return f"({x})::VARCHAR"


def one_of(x: str, values, d: Spark) -> str:
    return f"({x} IN ({', '.join(d.lit(v) for v in values)}))"


def any_in(x: str, parts, d: Spark) -> str:
    """Whether a text holds one of the parts."""
    return "(" + " OR ".join(f"contains({x}, {d.lit(p)})" for p in parts) + ")"
