"""Collection declarations.

A collection is declared once as plain Python: a name, a version, a dynamic-field policy and a dict of
:class:`Field`. The declaration yields

* ``struct_type()``: the Spark schema of the stored table (field options kept in ``StructField.metadata``);
* ``mapping()``: a canonical nested dict used to diff two declarations (:mod:`docspark.operators.drift`);
* ``physical_name`` / ``logical_name``: ``{name}_v{version}`` behind the logical name, or the plain name.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field as dc_field, replace
from typing import Any, Mapping

from pyspark.sql import types as T

from .errors import SchemaError

# The closed list of field types a declaration may use.
FIELD_TYPES = ("keyword", "text", "integer", "long", "float", "double", "boolean", "date", "object", "nested",
               "ip", "geo_point")
# The dynamic-field policies.
DYNAMIC_MODES = (True, False, "strict", "runtime")
# Fixed value: the default date format when a date field declares none.
DEFAULT_DATE_FORMAT = "strict_date_optional_time||epoch_millis"

ID_COL = "_id"
SCORE_COL = "_score"
SOURCE_COL = "_source"
ERRORS_COL = "_errors"
# Columns that operators put beside a document's own; a key of such a name gets another column.
SYSTEM_COLS = frozenset({ID_COL, SCORE_COL, SOURCE_COL, ERRORS_COL, "_ord", "_present", "_sort"})
KEY_META = "docspark_key"          # metadata of a column that is not named after its JSON key: the key
# Characters that need quoting in column paths or that table formats refuse.
ODD_CHARS = re.compile(r"[.`,;{}()\[\]\n\r\t=\\'\" ]")


def column_for(key: str, taken: set[str], subs: tuple[str, ...] = ()) -> str:
    """A column name for a JSON key: the key itself, or where that can't be (odd characters, a system column, or a
    name that is ``taken`` but for its case) its plain characters and a hash of the key, so that different keys get
    different names. The names of its multi-fields must be free as well."""
    def free(name: str) -> bool:
        return taken.isdisjoint({name.lower(), *(f"{name}__{s}".lower() for s in subs)})

    if key and not ODD_CHARS.search(key) and not key.startswith("__") and key.lower() not in SYSTEM_COLS and free(key):
        return key
    plain = re.sub(r"\W", "_", key).strip("_") or "key"
    digest = hashlib.sha256(key.encode("utf-8", "surrogatepass")).hexdigest()
    return next(n for n in (f"{plain}_{digest[:size]}" for size in range(8, 65, 8)) if free(n))


def named_columns(fields: Mapping[str, "Field"]) -> dict[str, "Field"]:
    """``fields`` with a ``column`` for every key that can't be its own column; names that are fixed stay, and earlier
    keys go before later ones. What lies below is named as well."""
    taken = {n.lower() for k, f in fields.items() if f.column for n in f.columns(k)}
    out: dict[str, Field] = {}
    for key, f in fields.items():
        if f.column is None:
            name = column_for(key, taken, tuple(f.fields or ()))
            f = f if name == key else replace(f, column=name)
            taken |= {n.lower() for n in f.columns(key)}
        out[key] = replace(f, properties=named_columns(f.properties)) if f.properties else f
    return out


@dataclass(frozen=True)
class Field:
    """One declared field.

    ``multi=True`` declares a multi-valued scalar, stored as ``ARRAY<elem>``; sort modes apply to it.
    ``fields`` are multi-fields (extra mappings of the same source value, e.g. ``raw`` keyword under a text field).
    ``coerce`` accepts numeric strings for numeric fields (default: rejected).
    """

    type: str
    analyzer: str | None = None
    search_analyzer: str | None = None
    fields: Mapping[str, "Field"] | None = None
    null_value: Any = None
    format: str | None = None
    properties: Mapping[str, "Field"] | None = None
    dynamic: Any = None
    multi: bool = False
    coerce: bool = False
    column: str | None = None          # name of the column where it is not the key (see named_columns)

    def __post_init__(self):
        if self.type not in FIELD_TYPES:
            raise SchemaError(f"unknown field type {self.type!r}")
        if self.properties is not None and self.type not in ("object", "nested"):
            raise SchemaError("properties are only valid on object or nested fields")
        if self.type in ("object", "nested") and not self.properties:
            raise SchemaError(f"{self.type} field needs properties")
        if self.dynamic is not None and self.dynamic not in DYNAMIC_MODES:
            raise SchemaError(f"bad dynamic mode {self.dynamic!r}")

    def columns(self, key: str) -> list[str]:
        """The column of the field under ``key`` and those of its multi-fields."""
        name = self.column or key
        return [name, *(f"{name}__{sub}" for sub in self.fields or ())]

    # ----- Spark type -------------------------------------------------------------------------------------------
    def element_type(self) -> T.DataType:
        t = self.type
        if t in ("keyword", "text", "ip"):
            return T.StringType()
        if t == "integer":
            return T.IntegerType()
        if t == "long":
            return T.LongType()
        if t == "float":
            return T.FloatType()
        if t == "double":
            return T.DoubleType()
        if t == "boolean":
            return T.BooleanType()
        if t == "date":
            return T.TimestampNTZType()
        if t == "geo_point":
            return T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
        return struct_of(self.properties or {}, multi_fields=True)

    def spark_type(self) -> T.DataType:
        et = self.element_type()
        if self.type == "nested" or self.multi:
            return T.ArrayType(et)
        return et

    def options(self) -> dict:
        """Mapping options of this field (canonical: only set options, properties excluded)."""
        out: dict[str, Any] = {"type": self.type}
        for k in ("analyzer", "search_analyzer", "null_value", "format", "dynamic"):
            v = getattr(self, k)
            if v is not None:
                out[k] = v
        if self.multi:
            out["multi"] = True
        if self.coerce:
            out["coerce"] = True
        if self.fields:
            out["fields"] = {k: f.mapping() for k, f in sorted(self.fields.items())}
        return out

    def mapping(self) -> dict:
        """:meth:`options`, the column where it is not the key, and the properties."""
        out = self.options()
        if self.column:
            out["column"] = self.column
        if self.properties:
            out["properties"] = {k: f.mapping() for k, f in self.properties.items()}
        return out

    @classmethod
    def from_mapping(cls, m: Mapping[str, Any]) -> "Field":
        """The field that :meth:`mapping` describes."""
        keys = ("analyzer", "search_analyzer", "null_value", "format", "dynamic", "multi", "coerce", "column")
        return cls(m["type"], **{k: m[k] for k in keys if k in m},
                   **({"fields": {k: cls.from_mapping(v) for k, v in m["fields"].items()}} if m.get("fields") else {}),
                   **({"properties": {k: cls.from_mapping(v) for k, v in m["properties"].items()}}
                      if m.get("properties") else {}))

    def date_formats(self) -> list[str]:
        return [f.strip() for f in (self.format or DEFAULT_DATE_FORMAT).split("||") if f.strip()]


def struct_of(props: Mapping[str, Field], multi_fields: bool = False) -> T.StructType:
    """The struct of some fields; with ``multi_fields`` (inside objects) each field's sub-fields follow it as
    ``name__sub``."""
    out = []
    for key, f in props.items():
        name, *subs = f.columns(key)
        meta = {"docspark": json.dumps(f.options())} | ({KEY_META: key} if name != key else {})
        out.append(T.StructField(name, f.spark_type(), True, meta))
        if multi_fields:
            out += [T.StructField(n, sf.spark_type(), True, {"docspark": json.dumps(sf.options())})
                    for n, sf in zip(subs, (f.fields or {}).values(), strict=True)]
    return T.StructType(out)


def stored_mapping(schema: T.StructType) -> dict[str, dict]:
    """The mapping that a stored table's schema was declared with, by JSON key, read from its fields' metadata. System
    columns and the columns of multi-fields (which their parent's options describe) are left out."""
    out: dict[str, dict] = {}
    derived: set[str] = set()
    for f in schema.fields:
        if "docspark" not in (f.metadata or {}):
            continue
        m = json.loads(f.metadata["docspark"])
        derived |= {f"{f.name}__{sub}" for sub in m.get("fields", {})}
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if m["type"] in ("object", "nested") and isinstance(inner, T.StructType):
            m["properties"] = stored_mapping(inner)
        if KEY_META in f.metadata:
            m["column"] = f.name
        out[f.name] = m
    return {schema[k].metadata.get(KEY_META, k): v for k, v in out.items() if k not in derived}


@dataclass(frozen=True)
class DynamicTemplate:
    """Rule for undeclared fields: first matching template (in list order) gives the mapping."""

    name: str
    mapping: Field
    match_mapping_type: str | None = None  # json kind: string, long, double, boolean, object, or "*"
    match: str | None = None               # glob on the field name
    unmatch: str | None = None

    def matches(self, field_name: str, kind: str) -> bool:
        if self.match_mapping_type not in (None, "*") and self.match_mapping_type != kind:
            return False
        if self.match is not None and not glob_match(self.match, field_name):
            return False
        if self.unmatch is not None and glob_match(self.unmatch, field_name):
            return False
        return True


def glob_match(pattern: str, name: str) -> bool:
    rx = "^" + ".*".join(re.escape(p) for p in pattern.split("*")) + "$"
    return re.match(rx, name) is not None


@dataclass(frozen=True)
class Collection:
    """A declared collection of documents."""

    name: str
    fields: Mapping[str, Field]
    version: int = 1
    use_alias: bool = True
    dynamic: Any = True
    dynamic_templates: tuple = ()
    num_shards: int | None = None
    settings: Mapping[str, Any] = dc_field(default_factory=dict)

    def __post_init__(self):
        if not self.name:
            raise SchemaError("collection needs a name")
        if not self.fields:
            raise SchemaError(f"collection {self.name!r} declares no fields")
        if self.dynamic not in DYNAMIC_MODES:
            raise SchemaError(f"bad dynamic mode {self.dynamic!r}")
        if self.version < 1:
            raise SchemaError("version must be >= 1")
        if ID_COL in self.fields:
            raise SchemaError(f"{ID_COL} is a system column")
        object.__setattr__(self, "fields", named_columns(self.fields))

    @property
    def logical_name(self) -> str:
        return self.name

    @property
    def physical_name(self) -> str:
        return f"{self.name}_v{self.version}" if self.use_alias else self.name

    def with_version(self, version: int) -> "Collection":
        return Collection(self.name, self.fields, version, self.use_alias, self.dynamic, self.dynamic_templates,
                          self.num_shards, self.settings)

    def with_fields(self, fields: Mapping[str, Field]) -> "Collection":
        return Collection(self.name, fields, self.version, self.use_alias, self.dynamic, self.dynamic_templates,
                          self.num_shards, self.settings)

    def static_settings(self) -> dict:
        """The settings that stored tables depend on: the analysis chain and the number of shards (if declared)."""
        return {k: v for k, v in (("analysis", self.settings.get("analysis")), ("num_shards", self.num_shards))
                if v is not None}

    def stored_type(self) -> T.StructType:
        """Schema of the collection's tables: :meth:`struct_type` and the document as it was given."""
        return T.StructType([*self.struct_type().fields, T.StructField(SOURCE_COL, T.VariantType())])

    def struct_type(self) -> T.StructType:
        """Conformed schema: ``_id`` then declared fields, then multi-field columns ``name__sub``."""
        base = struct_of(self.fields)
        extra = [T.StructField(name, sf.spark_type(), True, {"docspark": json.dumps(sf.options())})
                 for key, f in self.fields.items() for name, sf in zip(f.columns(key)[1:], (f.fields or {}).values())]
        return T.StructType([T.StructField(ID_COL, T.StringType(), False)] + list(base.fields) + extra)

    def mapping(self) -> dict:
        return {k: f.mapping() for k, f in self.fields.items()}

    def column_of(self, path: str) -> str:
        """The column path of a field by its path of JSON keys (dots inside keys escaped as ``\\.``)."""
        props, out = self.fields, []
        for key in split_path(path):
            out.append(props[key].column or key)
            props = props[key].properties or {}
        return ".".join(out)

    def field_at(self, path: str) -> Field | None:
        props: Mapping[str, Field] | None = self.fields
        f = None
        for part in split_path(path):
            if props is None or part not in props:
                return None
            f = props[part]
            props = f.properties
        return f


def join_path(prefix: str, key: str) -> str:
    """``prefix.key``, with the dots (and backslashes) of the key escaped."""
    key = key.replace("\\", "\\\\").replace(".", "\\.")
    return f"{prefix}.{key}" if prefix else key


def split_path(path: str) -> list[str]:
    """The keys of a path made by :func:`join_path`."""
    parts = re.findall(r"(?:^|\.)((?:\\.|[^.\\])*)", path, re.S)
    return [re.sub(r"\\(.)", r"\1", p, flags=re.S) for p in parts]


def flatten_paths(props: Mapping[str, Field], prefix: str = "") -> list[tuple[str, Field]]:
    """All declared (dotted path, field) pairs, parents before children."""
    out = []
    for name, f in props.items():
        path = join_path(prefix.rstrip("."), name)
        out.append((path, f))
        if f.properties:
            out.extend(flatten_paths(f.properties, path))
    return out
