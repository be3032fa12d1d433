import json

import pytest
from pyspark.sql import types as T

from docspark.errors import SchemaError
from docspark.operators.drift import diff_mappings
from docspark.schema import Collection, DynamicTemplate, Field, glob_match

PARCEL = Collection("parcel", {
    "code": Field("keyword"),
    "label": Field("text", analyzer="standard", fields={"exact": Field("keyword")}),
    "grams": Field("integer"),
    "insured": Field("boolean"),
    "sentAt": Field("date"),
    "sender": Field("object", properties={"city": Field("keyword"), "depot": Field("integer")}),
})


def test_struct_type_and_metadata():
    st = PARCEL.struct_type()
    assert st.fieldNames() == ["_id", "code", "label", "grams", "insured", "sentAt", "sender", "label__exact"]
    assert st["grams"].dataType == T.IntegerType()
    assert st["sentAt"].dataType == T.TimestampNTZType()
    assert isinstance(st["sender"].dataType, T.StructType)
    meta = json.loads(st["label"].metadata["docspark"])
    assert meta["analyzer"] == "standard" and meta["fields"] == {"exact": {"type": "keyword"}}


def test_physical_and_logical_names():
    assert PARCEL.physical_name == "parcel_v1"
    assert PARCEL.with_version(3).physical_name == "parcel_v3"
    plain = Collection("plain", {"id": Field("keyword")}, use_alias=False)
    assert plain.physical_name == "plain"


def test_declaration_errors():
    with pytest.raises(SchemaError):
        Collection("empty", {})
    with pytest.raises(SchemaError):
        Field("money")
    with pytest.raises(SchemaError):
        Field("keyword", properties={"a": Field("keyword")})
    with pytest.raises(SchemaError):
        Collection("x", {"_id": Field("keyword")})


def test_multi_and_nested_types():
    c = Collection("c", {"tags": Field("keyword", multi=True),
                         "lines": Field("nested", properties={"q": Field("double")}),
                         "where": Field("geo_point")})
    st = c.struct_type()
    assert st["tags"].dataType == T.ArrayType(T.StringType())
    assert isinstance(st["lines"].dataType, T.ArrayType)
    assert st["where"].dataType.fieldNames() == ["lat", "lon"]


def test_dynamic_template_matching():
    t = DynamicTemplate("strings", Field("keyword"), match_mapping_type="string", match="*_code", unmatch="tmp_*")
    assert t.matches("zip_code", "string")
    assert not t.matches("zip_code", "long")
    assert not t.matches("tmp_code", "string")
    assert glob_match("a*b", "axxb") and not glob_match("a*b", "axxc")


# --- mapping diff ------------------------------------------------------------------------------------------------

VALVE = {"code": {"type": "keyword"},
         "body": {"type": "object", "properties": {
             "bore": {"type": "double"}, "seal": {"type": "object", "properties": {"grade": {"type": "keyword"}}}}},
         "tests": {"type": "nested", "properties": {"bar": {"type": "integer"}}}}


def edited(path, value):
    """VALVE with the mapping at a dotted path replaced (None: taken out)."""
    out = json.loads(json.dumps(VALVE))
    at, (*head, last) = out, path.split(".")
    for part in head:
        at = at[part]["properties"]
    if value is None:
        del at[last]
    else:
        at[last] = value
    return out


@pytest.mark.parametrize("path", ["code", "body", "body.bore", "body.seal.grade", "tests.bar"])
def test_each_path_is_added_removed_or_changed_alone(path):
    assert diff_mappings(VALVE, VALVE) == diff_mappings({}, {})
    added = diff_mappings(VALVE, edited(path, None))
    assert (added.added_fields, added.removed_fields, added.is_breaking) == ([path], [], False)
    removed = diff_mappings(edited(path, None), VALVE)
    assert (removed.added_fields, removed.removed_fields, removed.is_breaking) == ([], [path], False)
    new = {"type": "date", "format": "yyyy"}
    changed = diff_mappings(edited(path, new), VALVE)
    assert changed.is_breaking and [c["field"] for c in changed.changed_fields] == [path]
    assert changed.changed_fields[0]["after"] == new
    assert not changed.added_fields and not changed.removed_fields       # nothing is told twice below a change


def test_diff_ignores_key_order_and_knows_a_missing_collection():
    one = {"note": {"type": "text", "analyzer": "x", "search_analyzer": "y"}}
    two = {"note": dict(reversed(one["note"].items()))}
    assert not diff_mappings(one, two).changed_fields
    assert sorted(diff_mappings(VALVE, None).added_fields) == ["body", "code", "tests"]


def test_fields_come_back_from_their_mapping():
    for f in PARCEL.fields.values():
        assert Field.from_mapping(f.mapping()) == f
