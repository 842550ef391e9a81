"""A compiler of SPARQL SELECT queries to DataFrame plans.

Covers prefixes, basic graph patterns with ``;`` and ``,``, OPTIONAL (nested
too), UNION, VALUES, FILTER, BIND, DISTINCT, GROUP BY with aggregates, HAVING,
ORDER BY, LIMIT and OFFSET.  A pattern is a join on its shared variables, so
order and strategy are the planner's.  A variable is a struct of value, kind,
datatype and language; an expression that fails leaves its variable unbound.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import PREFIXES, TYPE, XSD

_TOKENS = re.compile(
    r"""\s+|\#[^\n]*|(?P<iri><[^<>\s]*>)|(?P<var>[?$]\w+)|(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')(?:\^\^(?P<dt><[^<>]*>|[\w-]*:[\w.-]+)|@(?P<lang>[\w-]+))?"""
    r"""|(?P<num>\d+(?:\.\d+)?)|(?P<name>[A-Za-z][\w-]*:[\w.-]*[\w-]|[A-Za-z][\w-]*:|:[\w.-]+)|(?P<word>[A-Za-z_]\w*)|(?P<op>\|\||&&|!=|<=|>=|[{}().;,=<>!*/+-])"""
)
_TERM = "struct<v:string,k:string,d:string,l:string>"
_AGGREGATES = {"COUNT", "MAX", "MIN", "SUM", "AVG", "SAMPLE"}


class SyntaxProblem(ValueError):
    pass


@dataclass
class Token:
    kind: str
    text: str
    extra: tuple[str | None, str | None] = (None, None)


@dataclass
class Group:
    """Elements of a group in order: ("triples", list), ("optional", Group), ("union", [Group]), ("bind", expr, var), ("values", vars, rows); filters apply to the whole."""

    elements: list[tuple] = field(default_factory=list)
    filters: list[Any] = field(default_factory=list)


def tokenise(text: str) -> list[Token]:
    out, at = [], 0
    while at < len(text):
        m = _TOKENS.match(text, at)
        if not m:
            raise SyntaxProblem(f"cannot read {text[at : at + 20]!r}")
        at = m.end()
        if m.lastgroup:
            kind = "str" if m["str"] else m.lastgroup
            out.append(Token(kind, m[kind], (m["dt"], m["lang"])))
    return out


class Parser:
    def __init__(self, text: str):
        self.tokens, self.at, self.prefixes = tokenise(text), 0, dict(PREFIXES)

    def peek(self, *words: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at].text.upper() in words

    def take(self, *words: str) -> Token:
        if self.at >= len(self.tokens) or (words and not self.peek(*words)):
            found = self.tokens[self.at].text if self.at < len(self.tokens) else "the end"
            raise SyntaxProblem(f"expected {' or '.join(words) or 'more'}, found {found}")
        self.at += 1
        return self.tokens[self.at - 1]

    def accept(self, *words: str) -> bool:
        if self.peek(*words):
            self.at += 1
            return True
        return False

    def query(self) -> dict[str, Any]:
        while self.accept("PREFIX"):
            name = self.take().text
            self.prefixes[name.rstrip(":")] = self.take().text[1:-1]
        self.take("SELECT")
        out: dict[str, Any] = {"distinct": self.accept("DISTINCT"), "select": [], "group": [], "having": None, "order": [], "limit": None, "offset": 0}
        while not self.peek("WHERE", "{"):
            if self.accept("*"):
                continue
            if self.accept("("):
                expression = self.expression()
                self.take("AS")
                out["select"].append((self.take().text[1:], expression))
                self.take(")")
            else:
                name = self.take().text[1:]
                out["select"].append((name, ("var", name)))
        self.accept("WHERE")
        out["where"] = self.group()
        while self.at < len(self.tokens):
            if self.accept("GROUP"):
                self.take("BY")
                while self.at < len(self.tokens) and self.tokens[self.at].kind == "var":
                    out["group"].append(self.take().text[1:])
            elif self.accept("HAVING"):
                out["having"] = self.expression()
            elif self.accept("ORDER"):
                self.take("BY")
                while self.at < len(self.tokens) and (self.tokens[self.at].kind == "var" or self.peek("ASC", "DESC")):
                    if self.peek("ASC", "DESC"):
                        down = self.take().text.upper() == "DESC"
                        self.take("(")
                        out["order"].append((self.expression(), down))
                        self.take(")")
                    else:
                        out["order"].append((("var", self.take().text[1:]), False))
            elif self.accept("LIMIT"):
                out["limit"] = int(self.take().text)
            elif self.accept("OFFSET"):
                out["offset"] = int(self.take().text)
            else:
                raise SyntaxProblem(f"unexpected {self.tokens[self.at].text}")
        return out

    def group(self) -> Group:
        out = Group()
        self.take("{")
        while not self.accept("}"):
            if self.accept("."):
                continue
            if self.accept("OPTIONAL"):
                out.elements.append(("optional", self.group()))
            elif self.accept("FILTER"):
                out.filters.append(self.expression())
            elif self.accept("BIND"):
                self.take("(")
                expression = self.expression()
                self.take("AS")
                out.elements.append(("bind", expression, self.take().text[1:]))
                self.take(")")
            elif self.accept("VALUES"):
                out.elements.append(self.values())
            elif self.peek("{"):
                parts = [self.group()]
                while self.accept("UNION"):
                    parts.append(self.group())
                out.elements.append(("union", parts))
            else:
                out.elements.append(("triples", self.triples()))
        return out

    def values(self) -> tuple:
        several = self.accept("(")
        names = []
        while self.tokens[self.at].kind == "var":
            names.append(self.take().text[1:])
        if several:
            self.take(")")
        self.take("{")
        rows = []
        while not self.accept("}"):
            if several:
                self.take("(")
                rows.append([None if self.accept("UNDEF") else self.term() for _ in names])
                self.take(")")
            else:
                rows.append([None if self.accept("UNDEF") else self.term()])
        return "values", names, rows

    def triples(self) -> list[tuple]:
        out, subject = [], self.term()
        while True:
            predicate = ("iri", TYPE) if self.peek("A") and self.take() else self.term()
            while True:
                out.append((subject, predicate, self.term()))
                if not self.accept(","):
                    break
            if not self.accept(";"):
                return out
            while self.accept(";"):
                pass
            if self.peek(".", "}"):
                return out

    def term(self) -> tuple:
        t = self.take()
        if t.kind == "var":
            return "var", t.text[1:]
        if t.kind == "iri":
            return "iri", t.text[1:-1]
        if t.kind == "name":
            return "iri", self.expand(t.text)
        if t.kind == "num":
            return "lit", t.text, XSD + ("double" if "." in t.text else "integer"), None
        if t.kind == "str":
            raw = re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), t.text[1:-1])
            datatype = t.extra[0]
            return "lit", raw, (datatype[1:-1] if datatype.startswith("<") else self.expand(datatype)) if datatype else None, t.extra[1]
        raise SyntaxProblem(f"not a term: {t.text}")

    def expand(self, name: str) -> str:
        prefix, _, local = name.partition(":")
        if prefix not in self.prefixes:
            raise SyntaxProblem(f"unknown prefix {prefix}:")
        return self.prefixes[prefix] + local

    def expression(self, least: int = 0) -> tuple:
        left = self.unary()
        ranks = {"||": 1, "&&": 2, "=": 3, "!=": 3, "<": 3, ">": 3, "<=": 3, ">=": 3, "+": 4, "-": 4, "*": 5, "/": 5}
        while self.at < len(self.tokens) and ranks.get(self.tokens[self.at].text, 0) > least:
            op = self.take().text
            left = (op, left, self.expression(ranks[op]))
        return left

    def unary(self) -> tuple:
        if self.accept("!"):
            return "!", self.unary()
        if self.accept("("):
            out = self.expression()
            self.take(")")
            return out
        t = self.tokens[self.at]
        if t.kind == "word" and t.text.upper() not in ("TRUE", "FALSE"):
            name = self.take().text.upper()
            self.take("(")
            distinct, args = self.accept("DISTINCT"), []
            while not self.accept(")"):
                args.append(("*",) if self.accept("*") else self.expression())
                self.accept(",")
            return "call", name, args, distinct
        if t.kind == "word":
            return "lit", self.take().text.lower(), XSD + "boolean", None
        return self.term()


def _struct(v: Column, kind: str | Column, d: Column | None = None, lang: Column | None = None) -> Column:
    none = F.lit("")
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    made = F.struct(v.alias("v"), kind.alias("k"), F.coalesce(d if d is not None else none, none).alias("d"), F.coalesce(lang if lang is not None else none, none).alias("l"))
    return F.when(v.isNotNull(), made)



class Compiler:
    def __init__(self, triples: DataFrame):
        self.triples = triples

    def pattern(self, s: tuple, p: tuple, o: tuple) -> tuple[DataFrame, set[str]]:
        rows, columns, names = self.triples, [], set()
        terms = ((s, "s", _struct(F.col("s"), F.when(F.col("s").startswith("_:"), "bnode").otherwise("iri"))), (p, "p", _struct(F.col("p"), "iri")), (o, "o", _struct(F.col("o"), F.col("o_kind"), F.col("o_dt"), F.col("o_lang"))))
        for term, column, value in terms:
            if term[0] == "var":
                if term[1] in names:  # a repeated variable is an equality
                    rows = rows.where(value == next(c for n, c in columns if n == term[1]))
                else:
                    columns.append((term[1], value))
                    names.add(term[1])
            else:
                rows = rows.where(F.col(column) == term[1])
                if column == "o":
                    rows = rows.where((F.col("o_kind") == "lit") if term[0] == "lit" else (F.col("o_kind") != "lit"))
        return (rows.select(*(c.alias(n) for n, c in columns)) if columns else rows.select(F.lit(1).alias("_one")).limit(1)), names

    def join(self, left: tuple[DataFrame, set[str], set[str]] | None, right: DataFrame, names: set[str], how: str, maybe: set[str] = frozenset()) -> tuple[DataFrame, set[str], set[str]]:
        """Compatible join: equality on shared variables, where one that may be unbound matches anything."""
        if left is None:
            return right, set(names), set(maybe)
        rows, have, loose = left
        shared = sorted(have & names)
        renamed = right.select(*(F.col(c).alias(f"_r_{c}") if c in shared else F.col(c) for c in right.columns))
        condition = F.lit(True)
        for c in shared:
            same = F.col(c) == F.col(f"_r_{c}")
            if c in loose:
                same = same | F.col(c).isNull()
            if c in maybe:
                same = same | F.col(f"_r_{c}").isNull()
            condition = condition & same
        joined = rows.join(renamed, condition, how)
        joined = joined.select(*(F.coalesce(c, f"_r_{c}").alias(c) if c in shared else F.col(c) for c in [*rows.columns, *(x for x in right.columns if x not in shared)]))
        new = (names - have) if how == "left" else (maybe - have)
        still = (loose & (maybe | (have - names))) | new if how == "inner" else loose | new
        return joined, have | names, still

    def group(self, group: Group) -> tuple[DataFrame, set[str], set[str]]:
        state = None
        for element in group.elements:
            kind = element[0]
            if kind == "triples":
                for triple in element[1]:
                    rows, names = self.pattern(*triple)
                    state = self.join(state, rows, names, "inner")
            elif kind == "optional":
                rows, names, maybe = self.group(element[1])
                state = self.join(state, rows, names, "left", maybe) if state else (rows, names, maybe)
            elif kind == "union":
                parts = [self.group(g) for g in element[1]]
                rows = parts[0][0]
                for more, _, _ in parts[1:]:
                    rows = rows.unionByName(more, allowMissingColumns=True)
                names = set().union(*(n for _, n, _ in parts))
                maybe = {n for n in names if any(n not in own or n in loose for _, own, loose in parts)}
                state = self.join(state, rows, names, "inner", maybe)
            elif kind == "values":
                _, names, values = element
                spark = self.triples.sparkSession
                data = [tuple(None if t is None else (t[1], t[0], (t[2] or "") if len(t) > 2 else "", (t[3] or "") if len(t) > 3 else "") for t in row) for row in values]
                rows = spark.createDataFrame(data, ", ".join(f"`{n}` {_TERM}" for n in names))
                maybe = {n for k, n in enumerate(names) if any(row[k] is None for row in values)}
                state = self.join(state, rows, set(names), "inner", maybe)
            else:
                _, expression, name = element
                rows, have, loose = state or (self.triples.sparkSession.range(1).select(F.lit(1).alias("_one")), set(), set())
                state = rows.withColumn(name, self.term(expression, have)), have | {name}, loose | {name}
        rows, have, loose = state or (self.triples.sparkSession.range(1).select(F.lit(1).alias("_one")), set(), set())
        for condition in group.filters:
            rows = rows.where(F.coalesce(self.truth(condition, have), F.lit(False)))
        return rows, have, loose

    def term(self, e: tuple, have: set[str]) -> Column:
        """An expression as a term; null is unbound."""
        if e[0] == "var":
            return F.col(e[1]) if e[1] in have else F.lit(None).cast(_TERM)
        if e[0] == "iri":
            return _struct(F.lit(e[1]), "iri")
        if e[0] == "lit":
            return _struct(F.lit(e[1]), "lit", F.lit(e[2] or ""), F.lit(e[3] or ""))
        if e[0] == "call" and e[1] == "COALESCE":
            return F.coalesce(*(self.term(x, have) for x in e[2]))
        if e[0] == "call" and e[1] == "IF":
            return F.when(self.truth(e[2][0], have), self.term(e[2][1], have)).otherwise(self.term(e[2][2], have))
        if e[0] == "call" and e[1] in ("IRI", "URI"):
            return _struct(self.text(e[2][0], have), "iri")
        if e[0] in ("+", "-", "*", "/"):
            return _struct(self.number(e, have).cast("string"), "lit", F.lit(XSD + "double"))
        if e[0] in ("||", "&&", "!", "=", "!=", "<", ">", "<=", ">=") or (e[0] == "call" and e[1] in _BOOLEAN):
            return _struct(self.truth(e, have).cast("string"), "lit", F.lit(XSD + "boolean"))
        return _struct(self.text(e, have), "lit", F.lit(XSD + "integer") if e[1] == "STRLEN" else None)

    def text(self, e: tuple, have: set[str]) -> Column:
        if e[0] == "call":
            name, args = e[1], e[2]
            arg = lambda k: self.text(args[k], have)
            simple = {"STR": lambda x: x, "LCASE": F.lower, "UCASE": F.upper, "STRLEN": lambda x: F.length(x).cast("string")}
            if name in simple:
                return simple[name](arg(0))
            if name == "REPLACE":
                return F.regexp_replace(arg(0), arg(1), arg(2))
            if name == "CONCAT":
                return F.concat(*(arg(k) for k in range(len(args))))
            if name == "SUBSTR":
                length = self.number(args[2], have).cast("int") if len(args) > 2 else F.length(arg(0))
                return F.substring(arg(0), self.number(args[1], have).cast("int"), length)
            if name in ("STRAFTER", "STRBEFORE"):
                at = F.position(arg(1), arg(0))
                cut = F.substring(arg(0), at + F.length(arg(1)), F.length(arg(0))) if name == "STRAFTER" else F.substring(arg(0), F.lit(1), at - 1)
                return F.when(at > 0, cut).otherwise("")
            if name == "LANG":
                return self.term(args[0], have)["l"]
            if name == "DATATYPE":
                return self.term(args[0], have)["d"]
            if name not in ("COALESCE", "IF", "IRI", "URI", *_BOOLEAN):
                raise SyntaxProblem(f"unknown function {name}")
        return self.term(e, have)["v"]

    def number(self, e: tuple, have: set[str]) -> Column:
        if e[0] in ("+", "-", "*"):
            a, b = (self.number(x, have) for x in e[1:])
            return {"+": a + b, "-": a - b, "*": a * b}[e[0]]
        if e[0] == "/":
            return F.try_divide(self.number(e[1], have), self.number(e[2], have))
        return self.text(e, have).try_cast("double")

    def truth(self, e: tuple, have: set[str]) -> Column:
        if e[0] == "||":
            return self.truth(e[1], have) | self.truth(e[2], have)
        if e[0] == "&&":
            return self.truth(e[1], have) & self.truth(e[2], have)
        if e[0] == "!":
            return ~self.truth(e[1], have)
        if e[0] in ("=", "!=", "<", ">", "<=", ">="):
            a, b = self.text(e[1], have), self.text(e[2], have)
            x, y = a.try_cast("double"), b.try_cast("double")
            both = x.isNotNull() & y.isNotNull()
            compare = {"=": lambda p, q: p == q, "!=": lambda p, q: p != q, "<": lambda p, q: p < q, ">": lambda p, q: p > q, "<=": lambda p, q: p <= q, ">=": lambda p, q: p >= q}[e[0]]
            return F.when(both, compare(x, y)).otherwise(compare(a, b))
        if e[0] == "call" and e[1] in _BOOLEAN:
            args = e[2]
            if e[1] == "BOUND":
                return self.term(args[0], have).isNotNull()
            if e[1] in ("ISIRI", "ISURI", "ISLITERAL", "ISBLANK"):
                return self.term(args[0], have)["k"] == {"ISLITERAL": "lit", "ISBLANK": "bnode"}.get(e[1], "iri")
            a, b = self.text(args[0], have), self.text(args[1], have)
            if e[1] == "REGEX":
                flags = args[2][1] if len(args) > 2 else ""
                return F.regexp(a, F.concat(F.lit(f"(?{flags})" if flags else ""), b))
            return {"STRSTARTS": F.startswith, "STRENDS": F.endswith, "CONTAINS": F.contains}[e[1]](a, b)
        return self.text(e, have) == "true"

    def aggregate(self, e: tuple, have: set[str]) -> Column | None:
        """An aggregate call as a column; None if ``e`` is none."""
        if e[0] != "call" or e[1] not in _AGGREGATES:
            return None
        name, (arg, *_), distinct = e[1], e[2], e[3]
        if name == "COUNT":
            value = F.lit(1) if arg == ("*",) else self.term(arg, have)
            return F.count_distinct(value) if distinct else F.count(value)
        n, text = self.number(arg, have), self.text(arg, have)
        if name in ("SUM", "AVG"):
            return F.sum(n) if name == "SUM" else F.avg(n)
        pick = {"MAX": F.max, "MIN": F.min, "SAMPLE": F.any_value}[name]
        return F.coalesce(pick(n).cast("string"), pick(text)) if name == "SAMPLE" else F.when(F.count(n) == F.count(text), pick(n))


_BOOLEAN = ("BOUND", "REGEX", "STRSTARTS", "STRENDS", "CONTAINS", "ISIRI", "ISURI", "ISLITERAL", "ISBLANK")


def query(triples: DataFrame, text: str, bindings: dict[str, str] | None = None) -> DataFrame:
    """Rows of a SELECT query over a set of triples: a string column for each variable, numbers for aggregates.

    ``bindings`` gives variables IRIs before planning.
    """
    parsed = Parser(text).query()
    compiler = Compiler(triples)
    where = parsed["where"]
    for name, value in (bindings or {}).items():
        where.elements.insert(0, ("values", [name], [[("iri", value)]]))
    rows, have, _ = compiler.group(where)
    select = parsed["select"] or [(n, ("var", n)) for n in sorted(have)]
    aggregates = [(n, compiler.aggregate(e, have)) for n, e in select]
    if parsed["group"] or any(a is not None for _, a in aggregates):
        keys = [F.col(k)["v"].alias(k) for k in parsed["group"]]
        rows = rows.groupBy(*keys).agg(*(a.alias(n) for n, a in aggregates if a is not None))
        if parsed["having"] is not None:
            typed = rows.select(*(_struct(F.col(c).cast("string"), "lit").alias(c) for c in rows.columns), F.struct(*rows.columns).alias("_row"))
            rows = typed.where(F.coalesce(compiler.truth(parsed["having"], set(rows.columns)), F.lit(False))).select("_row.*")
        rows = rows.select(*(n for n, _ in select))
        order = [(F.col(e[1]), down) for e, down in parsed["order"]]
    else:
        order = [(F.struct(compiler.number(e, have), compiler.text(e, have)), down) for e, down in parsed["order"]]
        if order and not parsed["distinct"]:
            rows = rows.orderBy(*(c.desc_nulls_last() if down else c.asc_nulls_first() for c, down in order))
            order = []
        rows = rows.select(*(compiler.term(e, have)["v"].alias(n) for n, e in select))
        if parsed["distinct"]:
            rows = rows.distinct()
            order = [(F.col(e[1]), down) for e, down in parsed["order"] if e[0] == "var"]
    if order:
        rows = rows.orderBy(*(c.desc_nulls_last() if down else c.asc_nulls_first() for c, down in order))
    if parsed["offset"]:
        rows = rows.offset(parsed["offset"])
    return rows.limit(parsed["limit"]) if parsed["limit"] is not None else rows
