"""One definition of an expression for two SQL dialects: Spark, where it runs, and DuckDB, where it is checked.

Patterns keep to what both regular-expression engines understand alike: no look-around, \\p{L} and \\p{N} instead of
\\w, {1} for a group in a replacement. Positions in lists count from 1.
"""

from __future__ import annotations

import re


class Dialect:
    name = ""

    def table(self, name: str) -> str:
        return name

    # literals and casts
    def lit(self, s: str) -> str:
        raise NotImplementedError

    def big(self, e: str) -> str:
        return f"CAST({e} AS BIGINT)"

    def dbl(self, e: str) -> str:
        return f"CAST({e} AS DOUBLE)"

    def strings(self, items: list[str]) -> str:
        return self.array([self.lit(x) for x in items])

    def isin(self, e: str, items: list[str]) -> str:
        return f"{e} IN (" + ", ".join(map(self.lit, items)) + ")"

    def any_of(self, e: str, items: list[str]) -> str:
        """Whether a text holds any of the phrases."""
        return "(" + " OR ".join(f"contains({e}, {self.lit(x)})" for x in items) + ")"

    def count_if(self, cond: str) -> str:
        return self.big(f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)")

    def compact(self, items: list[str]) -> str:
        return self.filt(self.array(items), "z", "z IS NOT NULL")

    def ordered_distinct(self, e: str) -> str:
        return self.filti(e, "u", "k", f"{self.position(e, 'u')} = k")

    def nonblank(self, e: str) -> str:
        return self.filt(e, "b", self.rx("b", r"[^\s]"))


class Spark(Dialect):
    name = "spark"

    def __init__(self, suffix: str = "") -> None:
        self.suffix = suffix
        self.used: set[str] = set()

    def table(self, name: str) -> str:
        self.used.add(name)
        return f"{name}{self.suffix}"

    def lit(self, s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r") + "'"

    def array(self, items):
        return f"array({', '.join(items)})" if items else "CAST(array() AS ARRAY<STRING>)"

    def rx(self, e, pattern):
        return f"({e} RLIKE {self.lit(pattern)})"

    def sub(self, e, pattern, new=""):
        return f"regexp_replace({e}, {self.lit(pattern)}, {self.lit(re.sub(r'[{](\d)[}]', r'$\1', new))})"

    def ext(self, e, pattern, group=1):
        return f"nullif(regexp_extract({e}, {self.lit(pattern)}, {group}), '')"

    def all(self, e, pattern):
        return f"regexp_extract_all({e}, {self.lit(pattern)}, 0)"

    def split(self, e, pattern):
        return f"split({e}, {self.lit(pattern)})"

    def filt(self, e, x, cond):
        return f"filter({e}, {x} -> {cond})"

    def filti(self, e, x, i, cond):
        return f"filter({e}, ({x}, {i}_) -> {re.sub(rf'(?<![A-Za-z_]){i}(?![A-Za-z_])', f'({i}_ + 1)', cond)})"

    def trans(self, e, x, to):
        return f"transform({e}, {x} -> {to})"

    def exists(self, e, x, cond):
        return f"exists({e}, {x} -> {cond})"

    def reduce(self, e, start, a, x, to):
        return f"aggregate({e}, {start}, ({a}, {x}) -> {to})"

    def join(self, e, sep):
        return f"array_join({e}, {self.lit(sep)})"

    def size(self, e):
        return f"CAST(size({e}) AS BIGINT)"

    def slice(self, e, start, n):
        return f"slice({e}, {start}, {n})"

    def el(self, e, i):
        return f"get({e}, CAST({i} AS INT) - 1)"

    def position(self, e, x):
        return f"array_position({e}, {x})"

    def has(self, e, x):
        return f"array_contains({e}, {x})"

    def overlap(self, a, b):
        return f"arrays_overlap({a}, {b})"

    def seq(self, a, b):
        """Integers from a to b, none if b < a."""
        return f"(CASE WHEN ({b}) >= ({a}) THEN sequence(CAST({a} AS INT), CAST({b} AS INT)) ELSE CAST(array() AS ARRAY<INT>) END)"

    def explode(self, e):
        return f"explode({e})"

    def hash8(self, e):
        return f"CAST(conv(substr(md5({e}), 1, 8), 16, 10) AS BIGINT)"

    def code(self, e):
        return f"ascii({e})"

    def any_sorted(self, e):
        return f"array_sort(collect_list({e}))"

    def trim(self, e):
        """Without ASCII blanks at either end."""
        return f"trim({e})"

    def sentences(self, e):
        return f"split({e}, {self.lit(r'(?<=[.!?])\s+')})"

    def pmod(self, a, b):
        return f"pmod({a}, {b})"

    def numbered(self, source, e):
        """(FROM clause, index): the rows of source with each item of a list as item, counted from 1."""
        return f"{source} LATERAL VIEW posexplode({e}) x AS item_at, item", "CAST(item_at + 1 AS BIGINT)"

    def last_known(self, e, over):
        return f"last_value({e}) IGNORE NULLS OVER ({over})"

    def ordered_join(self, e, order, sep):
        return f"array_join(transform(array_sort(collect_list(struct({order} AS o, {e} AS v))), y -> y.v), {self.lit(sep)})"

    def messages(self, line):
        """The messages of a JSON line; null unless the line is one JSON object."""
        return f"CASE WHEN trim({line}) LIKE '{{%}}' THEN from_json({line}, 'messages ARRAY<STRUCT<role: STRING, content: STRING>>').messages END"

    def cat(self, a, b):
        return f"concat({a}, {b})"


class Duck(Dialect):
    name = "duck"

    def lit(self, s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def array(self, items):
        return f"[{', '.join(items)}]" if items else "CAST([] AS VARCHAR[])"

    def rx(self, e, pattern):
        return f"regexp_matches({e}, {self.lit(pattern)})"

    def sub(self, e, pattern, new=""):
        return f"regexp_replace({e}, {self.lit(pattern)}, {self.lit(re.sub(r'[{](\d)[}]', r'\\\1', new))}, 'g')"

    def ext(self, e, pattern, group=1):
        return f"nullif(regexp_extract({e}, {self.lit(pattern)}, {group}), '')"

    def all(self, e, pattern):
        return f"regexp_extract_all({e}, {self.lit(pattern)})"

    def split(self, e, pattern):
        return f"regexp_split_to_array({e}, {self.lit(pattern)})"

    def filt(self, e, x, cond):
        return f"list_filter({e}, lambda {x}: {cond})"

    def filti(self, e, x, i, cond):
        return f"list_filter({e}, lambda {x}, {i}: {cond})"

    def trans(self, e, x, to):
        return f"list_transform({e}, lambda {x}: {to})"

    def exists(self, e, x, cond):
        return f"(len(list_filter({e}, lambda {x}: {cond})) > 0)"

    def reduce(self, e, start, a, x, to):
        return f"list_reduce({e}, lambda {a}, {x}: {to}, {start})"

    def join(self, e, sep):
        return f"coalesce(array_to_string({e}, {self.lit(sep)}), CASE WHEN {e} IS NOT NULL THEN '' END)"

    def size(self, e):
        return f"CAST(len({e}) AS BIGINT)"

    def slice(self, e, start, n):
        return f"list_slice({e}, {start}, {start} + {n} - 1)"

    def el(self, e, i):
        return f"list_extract({e}, {i})"

    def position(self, e, x):
        return f"list_position({e}, {x})"

    def has(self, e, x):
        return f"list_contains({e}, {x})"

    def overlap(self, a, b):
        return f"list_has_any({a}, {b})"

    def seq(self, a, b):
        return f"range({a}, ({b}) + 1)"

    def explode(self, e):
        return f"unnest({e})"

    def hash8(self, e):
        return f"CAST('0x' || md5({e})[1:8] AS BIGINT)"

    def code(self, e):
        return f"unicode({e})"

    def any_sorted(self, e):
        return f"list_sort(list({e}))"

    def trim(self, e):
        return f"trim({e}, ' ')"

    def sentences(self, e):
        return f"string_split(regexp_replace({e}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"

    def pmod(self, a, b):
        return f"((({a}) % ({b})) + ({b})) % ({b})"

    def cat(self, a, b):
        return f"list_concat({a}, {b})"

    def numbered(self, source, e):
        return f"{source}, unnest({e}) WITH ORDINALITY AS x(item, item_at)", "CAST(item_at AS BIGINT)"

    def last_known(self, e, over):
        return f"last_value({e} IGNORE NULLS) OVER ({over})"

    def ordered_join(self, e, order, sep):
        return f"string_agg({e}, {self.lit(sep)} ORDER BY {order})"

    def messages(self, line):
        inner = f"json_extract(CASE WHEN json_valid({line}) THEN {line} END, '$.messages')"
        return f"CASE WHEN json_type({inner}) = 'ARRAY' THEN from_json({inner}, '[{{\"role\":\"VARCHAR\",\"content\":\"VARCHAR\"}}]') END"


DUCK = Duck()
