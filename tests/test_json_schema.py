"""JSON Schema documents compiled to column predicates."""
import json

import pytest
from conftest import base_record, with_profile, with_signals

from talentlens.operators import audit
from talentlens.operators import json_schema as J

#: A second schema: references, nested lists, open objects, combinations.
ORDERS = {
    "$schema": "x", "title": "orders", "type": "object", "required": ["id", "lines"],
    "definitions": {"money": {"type": "number", "minimum": 0, "multipleOf": 0.25}, "line": {
        "type": "object", "required": ["sku"], "additionalProperties": False,
        "properties": {"sku": {"type": "string", "minLength": 2, "maxLength": 4}, "price": {"$ref": "#/definitions/money"}, "tags": {
            "type": "array", "maxItems": 2, "items": {"type": "string", "pattern": "^t"}}}}},
    "properties": {
        "id": {"type": "integer", "exclusiveMinimum": 0}, "lines": {"type": "array", "minItems": 1, "items": {"$ref": "#/definitions/line"}},
        "state": {"enum": ["new", 3, None, True]}, "kind": {"const": "order"}, "it's odd": {"type": "boolean"},
        "rates": {"type": "object", "properties": {"base": True}, "additionalProperties": {"type": "number", "exclusiveMaximum": 1}},
        "code": {"anyOf": [{"type": "integer"}, {"type": "string", "pattern": "^[0-9]+$"}]}, "free": {"not": {"type": "array"}},
        "day": {"allOf": [{"type": "string"}, {"format": "date"}]}}}

GOOD = {"id": 1.0, "lines": [{"sku": "ab", "price": 0.75, "tags": ["t1", "t2"]}, {"sku": "abcd"}], "state": "new", "kind": "order", "it's odd": True,
        "rates": {"base": "any", "x": 0.5}, "code": "007", "free": {}, "day": "2024-02-29"}


def broken(spark, documents, schema, raw=()):
    lines = [json.dumps(d) for d in documents] + list(raw)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, value string")
    got = {r.i: r.broken for r in J.violations(df, schema).collect()}
    return [got.get(i, []) for i in range(len(lines))]


CASES = [
    ({}, []), ({"state": 3}, []), ({"state": None}, []), ({"state": True}, []), ({"code": 7}, []), ({"unknown": [1]}, []), ({"rates": {}}, []),
    ({"id": 1.5}, ["id: type"]), ({"id": "1"}, ["id: type"]), ({"id": 0}, ["id: exclusiveMinimum"]), ({"id": None}, ["id: type"]),
    ({"lines": []}, ["lines: minItems"]), ({"lines": {}}, ["lines: type"]), ({"lines": [{"price": 1}]}, ["lines[]: required sku"]),
    ({"lines": [{"sku": "ab"}, {"sku": "a"}]}, ["lines[].sku: minLength"]), ({"lines": [{"sku": "abcde"}]}, ["lines[].sku: maxLength"]),
    ({"lines": [{"sku": "ab", "price": 0.3}]}, ["lines[].price: multipleOf"]), ({"lines": [{"sku": "ab", "price": -1}]}, ["lines[].price: minimum"]),
    ({"lines": [{"sku": "ab", "other": 1}]}, ["lines[]: additionalProperties"]), ({"lines": [{"sku": "ab", "tags": ["t", "t", "t"]}]}, ["lines[].tags: maxItems"]),
    ({"lines": [{"sku": "ab"}, {"sku": "ab", "tags": ["t", "x"]}]}, ["lines[].tags[]: pattern"]), ({"lines": [7]}, ["lines[]: type"]),
    ({"state": "old"}, ["state: enum"]), ({"state": False}, ["state: enum"]), ({"kind": "x"}, ["kind: const"]), ({"it's odd": "yes"}, ["it's odd: type"]),
    ({"rates": {"x": 1}}, ["rates{}: exclusiveMaximum"]), ({"rates": {"x": "1"}}, ["rates{}: type"]), ({"code": "a"}, ["code: anyOf"]), ({"free": []}, ["free: not"]),
    ({"day": "2023-02-29"}, ["day: format (allOf 1)"]), ({"day": 3}, ["day: type (allOf 0)"])]


def test_every_keyword_of_a_second_schema(spark):
    got = broken(spark, [GOOD | change for change, _ in CASES] + [{k: v for k, v in GOOD.items() if k != "lines"}, [1]], ORDERS, raw=["{", "null", ""])
    assert got[:len(CASES)] == [sorted(want) for _, want in CASES]
    assert got[len(CASES):] == [[": required lines"], [": type"], [": json"], [": type"], [": json"]]
    df = spark.createDataFrame([(json.dumps(GOOD | {"id": -1}),), (json.dumps(GOOD | {"id": "x"}),), (json.dumps(GOOD),)], "value string")
    counts = {r.rule: r.violations for r in J.conformance(df, ORDERS).collect()}
    assert counts["id: type"] == counts["id: exclusiveMinimum"] == 1 and sum(counts.values()) == 2
    assert [tuple(r) for r in J.conformance(df, ORDERS, groups={"id": ["id: type", "id: exclusiveMinimum"]}).collect()] == [("id", 2)]
    assert J.conformance(df.limit(0), ORDERS).where("violations > 0").count() == 0


@pytest.mark.parametrize("schema", [
    {"uniqueItems": True}, {"format": "email"}, {"$ref": "other.json"}, {"items": [{}]}, {"enum": [[1]]},
    {"definitions": {"n": {"properties": {"next": {"$ref": "#/definitions/n"}}}}, "$ref": "#/definitions/n"}])
def test_what_is_not_understood_is_an_error(schema):
    with pytest.raises(ValueError):
        J.compile_schema(schema)


def test_the_declared_schema_from_a_file(spark, tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(json.dumps(audit.declared_schema("signals"), indent=2), encoding="utf-8")
    document = J.load(spark, str(path))
    job = base_record()["career_history"][0]
    whole = {c: "x" for c in audit.REQUIRED["job"]} | job | {"start_date": "2020-01-01", "end_date": None, "company_size": "11-50"}
    good = with_profile(base_record(), anonymized_name="n")
    good |= {"career_history": [whole], "education": [{"institution": "i", "degree": "d", "field_of_study": "f", "start_year": 2000, "end_year": 2004}]}
    good = with_signals(good, profile_views_received_30d=1, connection_count=1, endorsements_received=1, search_appearance_30d=1)
    no_end = {k: v for k, v in whole.items() if k != "end_date"}
    got = broken(spark, [good, good | {"career_history": [no_end]}, with_signals(good, notice_period_days=181), with_profile(good, years_of_experience="7"),
                         with_signals(good, skill_assessment_scores={"a": 101}), good | {"candidate_id": "CAND_1"}, good | {"skills": None}], document)
    assert got == [[], ["career_history[]: required end_date"], ["signals.notice_period_days: maximum"], ["profile.years_of_experience: type"],
                   ["signals.skill_assessment_scores{}: maximum"], ["candidate_id: pattern"], ["skills: type"]]
    names = [r.name for r in J.compile_schema(document).rules]
    groups = audit.conformance_groups(names)
    assert set(groups) == set(audit.conformance_rules()) and all(groups.values()) and {n for g in groups.values() for n in g} <= set(names)


def test_one_scan_and_no_python_worker(spark, tmp_path):
    (tmp_path / "l.txt").write_text(json.dumps(GOOD), encoding="utf-8")
    plan = J.conformance(spark.read.text(str(tmp_path)), ORDERS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan and plan.count("try_parse_json") <= 1


def test_kinds_and_parts_are_taken_out_once(spark):
    """No rule of a value or of an array's element walks it for its kind or takes a property out again; results are the plain ones."""
    import json
    from talentlens.operators import json_schema as J
    document = {"type": "object", "required": ["n", "a"], "properties": {"n": {"type": "integer", "minimum": 1}, "a": {"type": "array", "items": {
        "type": "object", "required": ["x", "z"], "properties": {"x": {"type": "number", "maximum": 5}, "y": {"type": ["string", "null"], "enum": ["p", None]}}}}}}
    compiled = J.compile_schema(document)
    assert not [r for r in compiled.rules if "schema_of_variant" in r.broken or "variant_get(i" in r.broken.replace("try_variant_get(", "")]
    rows = [{"n": 1, "a": [{"x": 1, "y": "p", "z": 0}]}, {"n": 1.5, "a": [{"x": 6.5, "y": None, "z": None}, 3, None]}, {"n": "1", "a": {"x": 1}}, {"a": [{"x": "1", "y": "q"}]}, [], 7]
    lines = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)] + [(6, "{"), (7, None)], "i int, value string")
    got = {r.i: r.broken for r in J.violations(lines, document).collect()}
    assert got == {1: ["n: type", "a[]: type", "a[].x: maximum"], 2: ["n: type", "a: type"],
                   3: [": required n", "a[]: required z", "a[].x: type", "a[].y: enum"], 4: [": type"], 5: [": type"], 6: [": json"], 7: [": json"]}


def test_one_cast_takes_a_record_apart(spark):
    """Objects and arrays are taken out of a line's variant by one cast, and rules on an array's elements walk it once for each group."""
    compiled = J.compile_schema(audit.declared_schema())
    first, *more = compiled.levels
    assert len(first) == len(more) == 1 and first[0][1].startswith("try_variant_get(_v, '$', 'struct<")
    assert not [e for _, e in more[0] if "variant_get" in e.replace("try_variant_get", "") and not e.startswith("CASE WHEN")]
    jobs = [r.name for r in compiled.rules if r.name.startswith("career_history[].")]
    assert len(jobs) > 10 and str(compiled.any_broken(jobs)).count("exists(") == 1


def test_forms_that_values_are_taken_out_in(spark):
    """Missing, null and of another kind are told apart, within structs, maps and arrays as well, and whatever the keys are."""
    text, number = {"type": "string"}, {"type": "integer", "minimum": 0}
    inner = {"type": "object", "required": ["a", "z"], "properties": {"a": number, "deep": {"type": "object", "required": ["x"], "properties": {"x": text}}}}
    schema = {"type": "object", "required": ["o", "l", "m"], "properties": {
        "o": inner, "l": {"type": "array", "items": inner | {"properties": {"a": number, "t": {"type": "array", "items": text}}}, "minItems": 1},
        "m": {"type": "object", "additionalProperties": number}, "n": {"type": "array", "items": number}, "no": False,
        "it's `odd`, a.b": {"type": "object", "required": ["k"]}, "Case": {"type": "object", "properties": {"k": text, "K": number}}}}
    good = {"o": {"a": 1, "z": None}, "l": [{"a": 2, "z": 0}], "m": {"k": 3}}
    cases = [
        ({}, []), ({"o": None}, ["o: type"]), ({"o": []}, ["o: type"]), ({"o": 3}, ["o: type"]), ({"o": {}}, ["o: required a", "o: required z"]),
        ({"o": {"a": 1, "z": 1, "deep": None}}, ["o.deep: type"]), ({"o": {"a": -1, "z": 1, "deep": {}}}, ["o.a: minimum", "o.deep: required x"]),
        ({"o": {"a": 1, "z": 1, "deep": {"x": 1}}}, ["o.deep.x: type"]), ({"l": None}, ["l: type"]), ({"l": {"a": 1}}, ["l: type"]), ({"l": []}, ["l: minItems"]),
        ({"l": [None]}, ["l[]: type"]), ({"l": [good["l"][0], 3]}, ["l[]: type"]), ({"l": [{"a": 1}]}, ["l[]: required z"]), ({"l": [{"z": 1, "a": 1.5}, {"z": 1}]}, ["l[]: required a", "l[].a: type"]),
        ({"l": [{"a": 1, "z": 1, "t": ["x", 1]}]}, ["l[].t[]: type"]), ({"l": [{"a": 1, "z": 1, "t": {}}]}, ["l[].t: type"]), ({"m": []}, ["m: type"]), ({"m": {}}, []),
        ({"m": {"k": -1, "j": "x"}}, ["m{}: type", "m{}: minimum"]), ({"m": {"k": None}}, ["m{}: type"]), ({"n": [1, None]}, ["n[]: type"]), ({"n": [1, -1]}, ["n[]: minimum"]), ({"n": None}, ["n: type"]),
        ({"no": None}, ["no: false"]), ({"it's `odd`, a.b": {}}, ["it's `odd`, a.b: required k"]), ({"it's `odd`, a.b": {"k": None}}, []), ({"it's `odd`, a.b": 1}, ["it's `odd`, a.b: type"]),
        ({"Case": {"k": 1, "K": 1}}, ["Case.k: type"]), ({"Case": {"k": "a", "K": "a"}}, ["Case.K: type"]), ({"Case": {"k": "a", "K": -1}}, ["Case.K: minimum"]), ({"case": 3, "O": 3}, [])]
    lines = [good | c for c, _ in cases] + [{k: v for k, v in good.items() if k != gone} for gone in good]
    want = [w for _, w in cases] + [[f": required {gone}"] for gone in good]
    assert broken(spark, lines, schema, raw=["null", "[]"]) == [*want, [": type"], [": type"]]
    groups = {"elements": ["l[]: type", "l[]: required a", "l[]: required z", "l[].a: minimum", "o: type"], "none": []}
    df = spark.createDataFrame([(json.dumps(x),) for x in lines], "value string")
    hits = sum(any(n in groups["elements"] for n in w) for w in want)
    assert {r.rule: r.violations for r in J.conformance(df, schema, groups=groups).collect()} == {"elements": hits, "none": 0}


@pytest.mark.parametrize("schema", [{"definitions": {"n": {"type": "object", "properties": {"next": {"$ref": "#/definitions/n"}}}}, "$ref": "#/definitions/n"}])
def test_an_object_within_itself_is_an_error(schema):
    with pytest.raises(ValueError):
        J.compile_schema(schema)
