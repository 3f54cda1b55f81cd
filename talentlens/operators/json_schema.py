"""Q12 from a schema document: a JSON Schema compiled to column predicates over parsed lines.

Each keyword of the document becomes one rule, named ``path: keyword`` (``profile.years_of_experience: maximum``,
``skills[].name: type``, ``scores{}: minimum`` for the values of an open object).  A rule is a SQL condition over the
line's VARIANT, so a null, a missing key and a wrong type are told apart, and a table is checked in one pass inside the
JVM.  Understood are ``type``, ``enum``, ``const``, ``required``, ``properties``, ``additionalProperties``, ``items``,
``minItems``, ``maxItems``, ``minimum``, ``maximum``, ``exclusiveMinimum``, ``exclusiveMaximum``, ``multipleOf``, ``minLength``,
``maxLength``, ``pattern``, ``format`` (``date``), ``allOf``, ``anyOf``, ``not``, and ``$ref`` within the document.
``title``, ``description``, ``default``, ``examples`` and the like say nothing about values; any other keyword is an error
rather than a rule that silently doesn't hold.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keywords that carry no rule.
SILENT = {"$schema", "$id", "$comment", "title", "description", "default", "examples", "definitions", "$defs", "readOnly", "writeOnly", "deprecated"}
DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


@dataclass(frozen=True)
class Rule:
    name: str
    broken: str                                                     # SQL condition over the columns of ``prepared``
    each: tuple[str, str, str] | None = None                        # of a rule on an array's elements: the array's column, the element's name, what breaks it


def load(spark: SparkSession, path: str) -> dict:
    """A schema document from any Hadoop file system."""
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _step(key: str) -> str:
    if '"' in key or "\\" in key:
        raise ValueError(f"a key with quotes or backslashes can't be checked: {key!r}")
    return f'["{key}"]'


def _keys(schema: dict) -> list[str]:
    """The properties that a schema names."""
    return list(dict.fromkeys([*schema.get("properties", {}), *schema.get("required", [])]))


def _kind(x: str) -> str:
    return f"schema_of_variant({x})"


def _number(x: str) -> str:
    return f"try_variant_get({x}, '$', 'double')"


def _string(x: str) -> str:
    return f"try_variant_get({x}, '$', 'string')"


_IS = {
    "string": lambda kind, number: f"{kind} = 'STRING'", "boolean": lambda kind, number: f"{kind} = 'BOOLEAN'", "null": lambda kind, number: f"{kind} = 'VOID'",
    "object": lambda kind, number: f"startswith({kind}, 'OBJECT')", "array": lambda kind, number: f"startswith({kind}, 'ARRAY')",
    "number": lambda kind, number: f"(startswith({kind}, 'DECIMAL') OR {kind} IN ('BIGINT', 'DOUBLE', 'FLOAT'))",
    "integer": lambda kind, number: f"({_IS['number'](kind, number)} AND {number} = floor({number}))",
}


def _quoted(key: str) -> str:
    return "`" + key.replace("`", "``") + "`"


class _Elements:
    """What rules ask of an array's elements: fields of one column, each computed once an element from the element ``f``.

    An element that is a variant (``f.v``) first has its properties taken out, as further fields of ``f``.
    """

    def __init__(self, i: str, struct: bool):
        self.i, self.struct, self.parts, self.fields = i, struct, {}, {}

    def part(self, key: str) -> str:
        taken = f"variant_get(e, {_text('$' + _step(key))}, 'variant')"
        return f"f.{_quoted(key)}" if self.struct else f"f.{self.parts.setdefault(taken, f'v{len(self.parts)}')}"

    def field(self, expression: str) -> str:
        return f"{self.i}.{self.fields.setdefault(expression, f'p{len(self.fields)}')}"

    def over(self, items: str) -> str:
        named = lambda fields: "named_struct(" + ", ".join(f"'{name}', {x}" for x, name in fields.items()) + ")"
        first = items if self.struct else f"transform({items}, e -> {named({'e': 'v'} | self.parts)})"
        return f"transform({first}, f -> {named(self.fields)})"


@dataclass(frozen=True)
class _Place:
    """Where rules find a value.  ``x`` is null where it is missing and, unless its form is ``variant``, where it is of another kind."""
    x: str
    depth: int | None                                               # of the columns in ``x``; None inside a lambda
    form: str = "variant"                                           # or struct, array, map: taken out of the variant as such
    source: str = ""                                                # of these, the variant to look into and the path of the value there
    path: str = ""
    held: _Elements | None = None                                   # of an element and its parts, the fields that rules see


class _Compiler:
    def __init__(self, document: dict):
        self.document, self.columns, self.levels, self.lambdas, self.each = document, {}, [], 0, {}

    def column(self, expression: str, depth: int) -> str:
        """A name for an expression over the columns of the level above, so that it is computed once a row."""
        if expression not in self.columns:
            while len(self.levels) < depth:
                self.levels.append([])
            self.columns[expression] = name = f"_c{len(self.columns)}"
            self.levels[depth - 1].append((name, expression))
        return self.columns[expression]

    def resolve(self, schema, seen=()):
        while isinstance(schema, dict) and "$ref" in schema:
            ref = schema["$ref"]
            if not ref.startswith("#") or ref in seen:
                raise ValueError(f"a reference that leads out of the document or back to itself: {ref}")
            seen, schema = (*seen, ref), self.document
            for part in filter(None, ref[1:].split("/")):
                schema = schema[part.replace("~1", "/").replace("~0", "~")]
        return schema

    def enter(self, schema, refs: tuple) -> tuple:
        """The schema itself and the references on the way to it."""
        if isinstance(schema, dict) and schema.get("$ref") in refs:
            raise ValueError(f"a schema that contains itself has no fixed set of columns: {schema['$ref']}")
        return self.resolve(schema), (*refs, schema["$ref"]) if isinstance(schema, dict) and "$ref" in schema else refs

    def fresh(self) -> str:
        self.lambdas += 1
        return f"i{self.lambdas}"

    def shape(self, schema, refs: tuple, element: bool = False) -> tuple[str, str]:
        """(form, SQL type) in which the values of a schema are taken out of a variant, all parts that rules look at in one cast.

        An object or array becomes a struct, map or array if its keywords need no more than that, anything else stays a variant;
        inside of an array's ``element`` (a struct at most) everything does.
        """
        plain = ("variant", "variant")
        schema, refs = self.enter(schema, refs)
        if not isinstance(schema, dict):
            return plain
        words = set(schema) - SILENT
        keys = _keys(schema)
        if schema.get("type") == "array" and not element and words <= {"type", "items", "minItems", "maxItems"} and isinstance(schema.get("items"), dict):
            return "array", f"array<{self.shape(schema['items'], refs, element=True)[1]}>"
        if schema.get("type") == "object" and keys and words <= {"type", "required", "properties"}:
            if "" in keys or len({k.lower() for k in keys}) < len(keys):                # as a struct's fields they couldn't be told apart
                return plain
            parts = schema.get("properties", {})
            return "struct", "struct<" + ", ".join(f"{_quoted(k)}: {'variant' if element or k not in parts else self.shape(parts[k], refs)[1]}" for k in keys) + ">"
        if schema.get("type") == "object" and not element and words == {"type", "additionalProperties"} and isinstance(schema["additionalProperties"], dict | bool):
            return "map", "map<string, variant>"
        return plain

    def taken(self, schema, source: str, path: str, depth: int, refs: tuple) -> _Place:
        """The value at a path of a variant, in the schema's form, as a column of the next level."""
        form, kind = self.shape(schema, refs)
        if form == "variant":
            return _Place(source if path == "$" else self.column(f"variant_get({source}, {_text(path)}, 'variant')", depth + 1), depth if path == "$" else depth + 1)
        return _Place(self.column(f"try_variant_get({source}, {_text(path)}, {_text(kind)})", depth + 1), depth + 1, form, source, path)

    def child(self, p: _Place, key: str, schema, refs: tuple) -> _Place:
        step = _step(key)
        if p.held and p.x in ("f", "f.v"):
            return _Place(p.held.part(key), None, held=p.held)
        if p.form == "struct":
            return _Place(f"{p.x}.{_quoted(key)}", p.depth, self.shape(schema, refs)[0], p.source, p.path + step)
        if p.depth is None:
            return _Place(f"variant_get({p.x}, {_text('$' + step)}, 'variant')", None, held=p.held)
        return self.taken(schema, p.x, "$" + step, p.depth, refs)

    def once(self, expression: str, p: _Place) -> str:
        """A column, or a field of an element: computed once for all rules of the value (its kind walks all that is in it)."""
        if p.held:
            return p.held.field(expression)
        return expression if p.depth is None else self.column(expression, p.depth + 1)

    def there(self, p: _Place, schema) -> str:
        """Whether there is a value, of whatever kind."""
        if p.form == "variant":
            return f"{self.once(_kind(p.x), p)} IS NOT NULL" if isinstance(schema, dict) and "type" in schema else self.once(f"{p.x} IS NOT NULL", p)
        if p.held:                                                  # an array has no gaps
            return "true"
        # a case, so that the variant is only looked into where the value isn't of its form
        return self.once(f"CASE WHEN {p.x} IS NOT NULL THEN true ELSE variant_get({p.source}, {_text(p.path)}, 'variant') IS NOT NULL END", p)

    def number(self, p: _Place) -> str:
        return self.once(_number(p.x), p)

    def string(self, p: _Place) -> str:
        return self.once(_string(p.x), p)

    def is_a(self, kind: str, p: _Place) -> str:
        """Null where there is no value, unless its form isn't ``variant``."""
        if p.form != "variant":
            return self.once(f"{p.x} IS NOT NULL", p)               # the only kind that its rules ask for
        return _IS[kind](self.once(_kind(p.x), p), self.number(p) if kind == "integer" else "")

    def equals(self, p: _Place, value) -> str:
        if value is None:
            return self.is_a("null", p)
        if isinstance(value, bool):
            boolean = self.once(f"try_variant_get({p.x}, '$', 'boolean')", p)
            return f"({self.is_a('boolean', p)} AND {boolean} = {str(value).lower()})"
        if isinstance(value, (int, float)):
            return f"({self.is_a('number', p)} AND {self.number(p)} = {value!r}D)"
        if isinstance(value, str):
            return f"({self.is_a('string', p)} AND {self.string(p)} = {_text(value)})"
        raise ValueError(f"only plain values can be listed: {value!r}")

    def one_of(self, p: _Place, values: list) -> str:
        texts = [v for v in values if isinstance(v, str)]
        tests = [self.equals(p, v) for v in values if not isinstance(v, str)]
        if texts:
            tests.append(f"({self.is_a('string', p)} AND {self.string(p)} IN ({', '.join(map(_text, texts))}))")
        return "(" + " OR ".join(tests or ["false"]) + ")"

    def rules(self, schema, p: _Place, path: str, refs: tuple = ()) -> list[tuple[str, str]]:
        """(name, broken) of the value at a place; a condition that is null isn't broken."""
        schema, refs = self.enter(schema, refs)
        if schema is True or schema == {}:
            return []
        if schema is False:
            return [(f"{path}: false", self.there(p, schema))]
        found: list[tuple[str, str]] = []
        rule = lambda keyword, holds, only=None: found.append((
            f"{path}: {keyword}", f"{self.is_a(only, p) if only else self.there(p, schema)} AND NOT coalesce({holds}, false)"))
        parts = schema.get("properties", {})
        for keyword, value in schema.items():
            if keyword in SILENT:
                continue
            elif keyword == "type":
                kinds = " OR ".join(self.is_a(k, p) for k in (value if isinstance(value, list) else [value]))
                found.append((f"{path}: type", f"NOT ({kinds})" if p.form == "variant" else f"{self.there(p, schema)} AND NOT ({kinds})"))
            elif keyword == "enum":
                rule("enum", self.one_of(p, value))
            elif keyword == "const":
                rule("const", self.equals(p, value))
            elif keyword in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
                rule(keyword, f"{self.number(p)} {dict(minimum='>=', maximum='<=', exclusiveMinimum='>', exclusiveMaximum='<')[keyword]} {float(value)!r}D", "number")
            elif keyword == "multipleOf":
                rule(keyword, f"{self.number(p)} / {float(value)!r}D = floor({self.number(p)} / {float(value)!r}D)", "number")
            elif keyword in ("minLength", "maxLength"):
                rule(keyword, f"length({self.string(p)}) {'>=' if keyword == 'minLength' else '<='} {int(value)}", "string")
            elif keyword == "pattern":
                rule("pattern", f"{self.string(p)} RLIKE {_text(value)}", "string")
            elif keyword == "format":
                if value != "date":
                    raise ValueError(f"unknown format: {value}")
                rule("format", f"{self.string(p)} RLIKE {_text(DATE)} AND try_cast({self.string(p)} AS date) IS NOT NULL", "string")
            elif keyword in ("minItems", "maxItems"):
                size = self.once(f"size({p.x})", p) if p.form == "array" else f"size({self.items(p)})"
                rule(keyword, f"{size} {'>=' if keyword == 'minItems' else '<='} {int(value)}", "array")
            elif keyword == "required":
                for key in value:
                    sub = parts.get(key, True)
                    found.append((f"{path}: required {key}", f"{self.is_a('object', p)} AND NOT ({self.there(self.child(p, key, sub, refs), self.resolve(sub))})"))
            elif keyword == "properties":
                for key, sub in value.items():
                    found += self.rules(sub, self.child(p, key, sub, refs), f"{path}.{key}" if path else key, refs)
            elif keyword == "additionalProperties":
                named = ", ".join(map(_text, parts))
                i = self.fresh()
                whole = p.x if p.form == "map" else f"try_variant_get({p.x}, '$', 'map<string,variant>')"
                entries = f"map_entries({whole})"
                if named:
                    entries = f"filter({entries}, {i} -> {i}.key NOT IN ({named}))"
                entries = self.once(entries, p)
                if value is False:
                    found.append((f"{path}: additionalProperties", f"coalesce(size({entries}) > 0, false)"))
                elif value is not True:
                    j = self.fresh()
                    found += [(n, f"coalesce(exists({entries}, {j} -> {b}), false)") for n, b in self.rules(value, _Place(f"{j}.value", None), path + "{}", refs)]
            elif keyword == "items":
                if isinstance(value, list):
                    raise ValueError("items by position aren't understood")
                found += self.of_elements(value, p, path + "[]", refs)
            elif keyword == "allOf":
                for n, part in enumerate(value):
                    found += [(f"{name} (allOf {n})", b) for name, b in self.rules(part, p, path, refs)]
            elif keyword == "anyOf":
                found.append((f"{path}: anyOf", f"{self.there(p, schema)} AND " + " AND ".join(self.any_broken(part, p, refs) for part in value)))
            elif keyword == "not":
                found.append((f"{path}: not", f"{self.there(p, schema)} AND NOT {self.any_broken(value, p, refs)}"))
            else:
                raise ValueError(f"unknown keyword at {path or 'the root'}: {keyword}")
        return found

    def of_elements(self, schema, p: _Place, path: str, refs: tuple) -> list[tuple[str, str]]:
        items, i = p.x if p.form == "array" else self.items(p), self.fresh()
        if p.depth is None:
            return [(n, f"coalesce(exists({items}, {i} -> {b}), false)") for n, b in self.rules(schema, _Place(i, None), path, refs)]
        struct = p.form == "array" and self.shape(schema, refs, element=True)[0] == "struct"
        held = _Elements(i, struct)
        rules = self.rules(schema, _Place("f", None, "struct", held=held) if struct else _Place("f.v", None, held=held), path, refs)
        if not rules:
            return []
        column = self.column(held.over(items), p.depth + (1 if p.form == "array" else 2))
        found = [(n, f"coalesce(exists({column}, {i} -> {b}), false)") for n, b in rules]
        self.each |= {whole: (column, i, b) for (_, whole), (_, b) in zip(found, rules, strict=True)}
        return found

    def any_broken(self, schema, p: _Place, refs: tuple) -> str:
        parts = [f"coalesce({b}, false)" for _, b in self.rules(schema, p, "", refs)]
        return "(" + " OR ".join(parts or ["false"]) + ")"

    def items(self, p: _Place) -> str:
        return self.once(f"try_variant_get({p.x}, '$', 'array<variant>')", p)


@dataclass(frozen=True)
class Compiled:
    rules: tuple[Rule, ...]
    levels: tuple[tuple[tuple[str, str], ...], ...]

    def prepared(self, lines: DataFrame, column: str) -> DataFrame:
        """``lines`` with ``_v``, the variant of each, and the parts that rules look at, level by level."""
        out = lines.select("*", F.try_parse_json(F.col(column)).alias("_v"))
        for level in self.levels:
            out = out.select("*", *[F.expr(e).alias(n) for n, e in level])
        return out

    def broken(self, name: str) -> Column:
        return F.coalesce(F.expr(next(r.broken for r in self.rules if r.name == name)), F.lit(False))

    def any_broken(self, names: list[str]) -> Column:
        """Whether a line breaks any of these rules (or null); rules on the elements of one array walk it once."""
        rules = {r.name: r for r in self.rules}
        tests, each = [], {}
        for r in map(rules.get, names):
            if r.each:
                each.setdefault(r.each[:2], []).append(r.each[2])
            else:
                tests.append(r.broken)
        tests += [f"exists({column}, {i} -> {' OR '.join(f'({b})' for b in found)})" for (column, i), found in each.items()]
        return F.expr(" OR ".join(f"({t})" for t in tests) or "false")


def compile_schema(document: dict) -> Compiled:
    """All rules of a document; a line that isn't JSON breaks the rule ``: json`` alone."""
    compiler = _Compiler(document)
    rules = [(": json", "_v IS NULL"), *compiler.rules(document, compiler.taken(document, "_v", "$", 0, ()), "")]
    names: dict[str, str] = {}
    for name, broken in rules:
        names[name] = f"({names[name]}) OR ({broken})" if name in names else broken
    return Compiled(tuple(Rule(n, b, compiler.each.get(b)) for n, b in names.items()), tuple(tuple(level) for level in compiler.levels))


def violations(lines: DataFrame, document: dict, column: str = "value") -> DataFrame:
    """The lines that break a rule: all columns and ``broken``, the names of the rules in the document's order."""
    compiled = compile_schema(document)
    names = F.array_compact(F.array(*[F.when(compiled.broken(r.name), F.lit(r.name)) for r in compiled.rules]))
    return compiled.prepared(lines, column).select(*lines.columns, names.alias("broken")).where(F.size("broken") > 0)


def conformance(lines: DataFrame, document: dict, column: str = "value", groups: dict[str, list[str]] | None = None) -> DataFrame:
    """(rule, violations): how many lines break each rule, or any rule of each of the named ``groups``, in one aggregation."""
    compiled = compile_schema(document)
    groups = groups or {r.name: [r.name] for r in compiled.rules}
    tests = compiled.prepared(lines, column).select(*[compiled.any_broken(names).alias(f"_b{n}") for n, names in enumerate(groups.values())])
    counts = [F.struct(F.lit(g).alias("rule"), F.count(F.when(F.col(f"_b{n}"), F.lit(1))).alias("violations")) for n, g in enumerate(groups)]
    return tests.agg(F.array(*counts).alias("c")).select(F.explode("c").alias("c")).select("c.*")
