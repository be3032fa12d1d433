"""Conform documents to a declared collection.

Input is a DataFrame with one document per row, either a JSON text column or a VARIANT column. Typed DataFrames are
turned into a VARIANT object first (:func:`conform_frame`), so one code path handles both. Each declared field is
read with ``try_variant_get`` after checking the JSON kind of the value with ``schema_of_variant``; failures append
``struct(field, reason)`` to the ``_errors`` array instead of failing the job. :func:`split_valid` separates accepted
rows from the quarantine.

Everything is a per-row projection: no shuffle, fully inside whole-stage codegen except the variant functions.
"""

from __future__ import annotations

import json
import re
from dataclasses import replace
from typing import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.dates import parse_date
from ..functions.ip import ip_key
from ..plans.sizing import ensure_parallelism
from ..schema import (DYNAMIC_MODES, ERRORS_COL, ID_COL, SOURCE_COL, Collection, DynamicTemplate, Field, join_path,
                      split_path)
from ..session import ensure_checkpoint_dir

# Integer ranges of the declared integral types.
INT_RANGE = {"integer": (-(2 ** 31), 2 ** 31 - 1), "long": (-(2 ** 63), 2 ** 63 - 1)}
FLOAT_MAX = 3.4028234663852886e38
# Estimated bytes of input for one task that conforms documents: some hundred thousand short ones.
CONFORM_PARTITION_BYTES = 4 << 20

ERROR_TYPE = T.ArrayType(T.StructType([T.StructField("field", T.StringType()),
                                       T.StructField("reason", T.StringType())]))


# ----------------------------------------------------------------------------------------------------------------
# JSON kind of a variant value
# ----------------------------------------------------------------------------------------------------------------

def kind_of_schema(s: Column) -> Column:
    """JSON kind from a ``schema_of_variant`` string (prefix tests only; objects and arrays tested first)."""
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(s.startswith("OBJECT"), "object")
            .when(s.startswith("ARRAY"), "array")
            .when(s == "STRING", "string")
            .when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "long")
            .when(s.startswith("DECIMAL") & s.endswith(",0)"), "long")
            .when(s.startswith("DECIMAL") | s.isin("DOUBLE", "FLOAT"), "double")
            .when(s == "BOOLEAN", "boolean")
            .when(s.startswith("TIMESTAMP") | (s == "DATE"), "date")
            .when(s == "VOID", "null")
            .otherwise(F.lower(s)))


def variant_kind(v: Column) -> Column:
    """JSON kind of a VARIANT value: string, long, double, boolean, object, array, date, null; NULL when absent.
    (Where it matters for speed, compute ``schema_of_variant`` once into a column and use :func:`kind_of_schema`.)"""
    return F.when(v.isNotNull(), kind_of_schema(F.schema_of_variant(v)))


def _path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def child(v: Column, name: str) -> Column:
    if re.search(r"['\"\\\]\[]", name):                    # characters that variant paths can't quote
        return F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), F.lit(name))
    return F.try_variant_get(v, _path(name), "variant")


def object_keys(v: Column) -> Column:
    return F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))


# Errors are kept as a list of items while expressions are built: a scalar item is a struct-or-null (one possible
# error), an array item is an array of error structs (from nested arrays). _combine turns the list into one array
# column with a single array_compact per row, instead of allocating and concatenating an array per field.
Err = tuple  # (Column, is_array: bool)


def _err(cond: Column, field: str, reason: str | Column) -> Column:
    r = F.lit(reason) if isinstance(reason, str) else reason
    return F.when(cond, F.struct(F.lit(field).alias("field"), r.alias("reason")))


def _no_errors() -> Column:
    return F.array().cast(ERROR_TYPE)


def _combine(items: list) -> Column:
    scalars = [c for c, is_arr in items if not is_arr]
    arrays = [F.coalesce(c, _no_errors()) for c, is_arr in items if is_arr]
    # array_compact is interpreted, with all it holds: it runs on rows that have an error only
    base = (F.when(F.coalesce(*scalars).isNull(), _no_errors()).otherwise(F.array_compact(F.array(*scalars)).cast(ERROR_TYPE))
            if scalars else _no_errors())
    return F.concat(base, *arrays) if arrays else base


def _when_items(cond: Column, items: list) -> list:
    """Keep ``items`` only where ``cond`` holds."""
    return [(F.when(cond, c).otherwise(_no_errors()) if is_arr else F.when(cond, c), is_arr) for c, is_arr in items]


# ----------------------------------------------------------------------------------------------------------------
# Scalars
# ----------------------------------------------------------------------------------------------------------------

def _scalar(x: Column, kind: Column, f: Field, path: str) -> tuple[Column, Column]:
    """Typed value and error (struct or null) for one scalar of declared field ``f``; ``x`` is present."""
    t = f.type
    numeric = kind.isin("long", "double")
    if t in ("keyword", "text"):
        ok = kind.isin("string", "long", "double", "boolean", "date")
        return F.when(ok, F.try_variant_get(x, "$", "string")), _err(~ok, path, "expected a string")
    if t in ("integer", "long"):
        lo, hi = INT_RANGE[t]
        # JSON integers are read as bigint directly; only fractional-looking numbers need the whole-number test
        as_long = F.when(kind == "long", F.try_variant_get(x, "$", "bigint"))
        dbl = F.when(kind == "double", F.try_variant_get(x, "$", "double"))
        if f.coerce:
            dbl = F.coalesce(dbl, F.when(kind == "string", F.try_variant_get(x, "$", "string").try_cast("double")))
        whole = dbl == F.floor(dbl)
        d_range = (dbl >= F.lit(float(lo))) & (dbl <= F.lit(float(hi)))
        l_range = F.lit(True) if t == "long" else as_long.between(lo, hi)
        val = F.coalesce(F.when(l_range, as_long), F.when(whole & d_range, dbl.cast("long")))
        reason = (F.when(kind == "long", F.lit(f"out of range for {t}"))
                  .when(dbl.isNull(), F.lit(f"expected {'a number' if not f.coerce else 'a number or numeric string'}"))
                  .when(~whole, F.lit("fractional value for an integral field"))
                  .otherwise(F.lit(f"out of range for {t}")))
        return val.cast("int" if t == "integer" else "long"), _err(val.isNull(), path, reason)
    if t in ("float", "double"):
        src = F.when(numeric, F.try_variant_get(x, "$", "double"))
        if f.coerce:
            src = F.coalesce(src, F.when(kind == "string", F.try_variant_get(x, "$", "string").try_cast("double")))
        ok = src.isNotNull()
        if t == "float":
            ok = ok & (F.abs(src) <= F.lit(FLOAT_MAX))
        return F.when(ok, src.cast(t)), _err(~ok, path, f"expected a number for {t}")
    if t == "boolean":
        s = F.lower(F.try_variant_get(x, "$", "string"))
        val = (F.when(kind == "boolean", F.try_variant_get(x, "$", "boolean"))
               .when((kind == "string") & (s == "true"), F.lit(True))
               .when((kind == "string") & (s == "false"), F.lit(False)))
        return val, _err(val.isNull(), path, "expected a boolean")
    if t == "date":
        s = F.when(kind == "string", F.try_variant_get(x, "$", "string"))
        num = F.when(kind == "long", F.try_variant_get(x, "$", "long"))
        native = F.when(kind == "date", F.try_variant_get(x, "$", "timestamp_ntz"))
        # dates have millisecond resolution
        val = F.date_trunc("millisecond", F.coalesce(native, parse_date(s, f.date_formats(), num))).cast("timestamp_ntz")
        return val, _err(val.isNull(), path, "date does not match format " + (f.format or "default"))
    if t == "ip":
        s = F.when(kind == "string", F.trim(F.try_variant_get(x, "$", "string")))
        ok = ip_key(s).isNotNull()
        return F.when(ok, s), _err(~ok, path, "not an IP address")
    if t == "geo_point":
        obj_lat = F.when(kind == "object", F.try_variant_get(x, "$.lat", "double"))
        obj_lon = F.when(kind == "object", F.try_variant_get(x, "$.lon", "double"))
        s = F.when(kind == "string", F.split(F.try_variant_get(x, "$", "string"), r"\s*,\s*"))
        str_lat, str_lon = s[0].try_cast("double"), s[1].try_cast("double")
        arr_lon = F.when(kind == "array", F.try_variant_get(x, "$[0]", "double"))
        arr_lat = F.when(kind == "array", F.try_variant_get(x, "$[1]", "double"))
        lat = F.coalesce(obj_lat, str_lat, arr_lat)
        lon = F.coalesce(obj_lon, str_lon, arr_lon)
        ok = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
        ok = F.coalesce(ok, F.lit(False))
        return (F.when(ok, F.struct(lat.alias("lat"), lon.alias("lon"))),
                _err(~ok, path, "expected a geo point with lat in [-90,90] and lon in [-180,180]"))
    raise ValueError(t)


def _reason(x: Column, kind: Column, f: Field) -> Column:
    """Why a present scalar value did not convert (evaluated only for rejected values)."""
    t = f.type
    single = F.lit("expected a single value")
    shape = kind.isin("array", "object") if t != "geo_point" else F.lit(False)
    if t in ("integer", "long"):
        dbl = F.try_variant_get(x, "$", "double")
        why = (F.when(kind == "long", F.lit(f"out of range for {t}"))
               .when((kind == "double") & (dbl != F.floor(dbl)), F.lit("fractional value for an integral field"))
               .when(kind == "double", F.lit(f"out of range for {t}"))
               .otherwise(F.lit("expected a number" if not f.coerce else "expected a number or numeric string")))
    else:
        msg = {"keyword": "expected a string", "text": "expected a string", "float": "expected a number for float",
               "double": "expected a number for double", "boolean": "expected a boolean", "ip": "not an IP address",
               "date": "date does not match format " + (f.format or "default"),
               "geo_point": "expected a geo point with lat in [-90,90] and lon in [-180,180]"}[t]
        why = F.lit(msg)
    return F.when(shape, single).otherwise(why)


def _null_value(f: Field) -> Column | None:
    if f.null_value is None:
        return None
    return F.lit(f.null_value).cast(f.element_type())


# ----------------------------------------------------------------------------------------------------------------
# Fields and objects
# ----------------------------------------------------------------------------------------------------------------

def conform_value(x: Column, f: Field, path: str, dynamic, kind: Column | None = None,
                  pre: dict | None = None) -> tuple[Column, list]:
    """Value of field ``f`` from variant ``x`` (already the field's own value) plus its error items. ``kind`` may
    be passed in when it was computed by an earlier projection; ``pre`` maps dotted paths of object descendants to
    their precomputed (value, kind) columns."""
    kind = variant_kind(x) if kind is None else kind
    present = kind.isNotNull() & (kind != "null")
    if f.type == "object":
        value, items = conform_object(x, f.properties, path + ".", f.dynamic if f.dynamic is not None else dynamic, pre)
        is_obj = kind == "object"
        return (F.when(is_obj, value),
                _when_items(is_obj, items) + [(_err(present & ~is_obj, path, "expected an object"), False)])
    if f.type == "nested":
        elems = F.when(kind == "array", F.try_variant_get(x, "$", "array<variant>")) \
            .when(kind == "object", F.array(x))
        d = f.dynamic if f.dynamic is not None else dynamic
        props = list(f.properties)

        # Inside lambdas Spark does not share common subexpressions, so each element's children and their JSON
        # kinds are extracted once by a first transform (schema strings), then kinds by a second, and the
        # conversions below only read struct fields.
        def extract(e):
            parts = [e.alias("v"), F.when(e.isNotNull(), F.schema_of_variant(e)).alias("s")]
            for j, n in enumerate(props):
                c = child(e, n)
                parts += [c.alias(f"c{j}"), F.when(c.isNotNull(), F.schema_of_variant(c)).alias(f"s{j}")]
            return F.struct(*parts)

        def kinds(z):
            parts = [z["v"].alias("v"), kind_of_schema(z["s"]).alias("k")]
            for j in range(len(props)):
                parts += [z[f"c{j}"].alias(f"c{j}"), kind_of_schema(z[f"s{j}"]).alias(f"k{j}")]
            return F.struct(*parts)

        staged = F.transform(F.transform(elems, extract), kinds)

        def pre_of(z):
            return {f"{path}.{n}": (z[f"c{j}"], z[f"k{j}"]) for j, n in enumerate(props)}

        def elem_value(z):
            return F.when(z["k"] == "object", conform_object(z["v"], f.properties, path + ".", d, pre_of(z))[0])

        def elem_errors(z):
            _, items = conform_object(z["v"], f.properties, path + ".", d, pre_of(z))
            is_obj = z["k"] == "object"
            return _combine(_when_items(is_obj, items) + [(_err(~is_obj, path, "expected an object"), False)])

        value = F.transform(staged, elem_value)
        errs = F.flatten(F.transform(staged, elem_errors))
        bad_kind = present & ~kind.isin("array", "object")
        return value, [(errs, True), (_err(bad_kind, path, "expected an array of objects"), False)]
    if f.multi:
        elems = F.when(kind == "array", F.try_variant_get(x, "$", "array<variant>")) \
            .when(present, F.array(x))
        value = F.transform(elems, lambda e: _scalar(e, variant_kind(e), f, path)[0])
        errs = F.array_compact(F.transform(elems, lambda e: F.when(variant_kind(e) != "null",
                                                                   _scalar(e, variant_kind(e), f, path)[1])))
        return value, [(errs, True)]
    is_array = kind.isin("array", "object") if f.type != "geo_point" else F.lit(False)
    value, err = _scalar(x, kind, f, path)
    nv = _null_value(f)
    value = F.when(present & ~is_array, value)
    if nv is not None:
        value = F.when(kind == "null", nv).otherwise(value)
    err = F.when(is_array, F.struct(F.lit(path).alias("field"), F.lit("expected a single value").alias("reason"))) \
        .when(present, err)
    return value, [(err, False)]


def conform_object(v: Column, props: Mapping[str, Field], prefix: str, dynamic,
                   pre: dict | None = None) -> tuple[Column, list]:
    """Struct of the declared properties read from object variant ``v`` plus the error items."""
    values, items = [], []
    for name, f in props.items():
        cx, ck = pre[prefix + name] if pre and (prefix + name) in pre else (child(v, name), None)
        columns = f.columns(name)
        subs = [(col, f"{name}.{sub}", sf) for col, (sub, sf) in zip(columns[1:], (f.fields or {}).items())]
        for out_name, path, ff in [(columns[0], name, f), *subs]:
            val, errs = conform_value(cx, ff, prefix + path, dynamic, ck, pre)
            values.append(val.cast(ff.spark_type()).alias(out_name))
            items += errs
    if dynamic == "strict":
        extra = F.array_except(F.coalesce(object_keys(v), F.array().cast("array<string>")),
                               F.array(*[F.lit(k) for k in props]))
        items.append((_err(F.size(extra) > 0, prefix.rstrip(".") or "_root",
                           F.concat(F.lit("strict mapping rejects undeclared field(s): "), F.array_join(extra, ","))), False))
    return F.struct(*values), items


def conform_variant(df: DataFrame, collection: Collection, doc: Column, id_expr: Column | None = None,
                    keep: list[str] | None = None, keep_source: bool = True,
                    is_object: Column | None = None, id_field: str | None = None) -> DataFrame:
    """C1-C11 on a VARIANT document column. Output: ``_id``, declared fields, multi-field columns ``f__sub``,
    optionally ``_source`` (the whole document, C5/C7) and ``_errors``; ``keep`` columns are passed through.
    The id (U1) is ``id_expr`` over the input columns, or the text of the document's top-level ``id_field``."""
    if collection.dynamic not in DYNAMIC_MODES:
        raise ValueError(collection.dynamic)
    # Stage 1 extracts each top-level value and its JSON kind once; stage 2 converts. Two small projections keep
    # the generated code of each under the JVM method size limit (one huge expression falls back to interpretation).
    names = list(collection.fields)
    df = ensure_parallelism(df, target_bytes=CONFORM_PARTITION_BYTES)
    d = df.select(*(keep or []), doc.alias("__doc"), *([id_expr.alias("__id")] if id_expr is not None else []),
                  *([is_object.alias("__isobj")] if is_object is not None else []))
    d = d.select("*", *[child(F.col("__doc"), n).alias(f"__v{i}") for i, n in enumerate(names)],
                 *([] if is_object is not None else
                   [(F.col("__doc").isNotNull() & F.schema_of_variant(F.col("__doc")).startswith("OBJECT")).alias("__isobj")]))
    # descendants of object fields (not inside arrays) are extracted level by level as columns too
    pre_cols: dict[str, str] = {}
    level = [(n, f"__v{i}", collection.fields[n]) for i, n in enumerate(names) if collection.fields[n].type == "object"]
    while level:
        nxt, exprs = [], []
        for path, col, f in level:
            for cname, cf in f.properties.items():
                cpath, ccol = f"{path}.{cname}", f"__p{len(pre_cols)}"
                pre_cols[cpath] = ccol
                exprs.append(child(F.col(col), cname).alias(ccol))
                if cf.type == "object":
                    nxt.append((cpath, ccol, cf))
        d = d.select("*", *exprs)
        level = nxt
    value_cols = [f"__v{i}" for i in range(len(names))] + list(pre_cols.values())
    d = d.select("*", *[F.when(F.col(c).isNotNull(), F.schema_of_variant(F.col(c))).alias(f"{c}_s") for c in value_cols])
    d = d.select("*", *[kind_of_schema(F.col(f"{c}_s")).alias(f"{c}_k") for c in value_cols])
    pre = {p: (F.col(c), F.col(f"{c}_k")) for p, c in pre_cols.items()}
    v = F.col("__doc")
    cols, items = [], []
    not_object = ~F.coalesce(F.col("__isobj"), F.lit(False))
    # Scalar values are converted in their own projection; their errors are then just "present but not
    # converted" on the next one, so no conversion expression is generated twice.
    scalar_vals, scalar_errs = [], []
    for i, (name, f) in enumerate(collection.fields.items()):
        x, k = F.col(f"__v{i}"), F.col(f"__v{i}_k")
        present = k.isNotNull() & (k != "null")
        columns = f.columns(name)
        targets = [(columns[0], name, f)] + [(col, f"{name}.{sub}", sf)
                                             for col, (sub, sf) in zip(columns[1:], (f.fields or {}).items())]
        for out_name, path, ff in targets:
            if ff.type in ("object", "nested") or ff.multi:
                val, errs = conform_value(x, ff, path, collection.dynamic, k, pre)
                cols.append(val.cast(ff.spark_type()).alias(out_name))
                items += errs
            else:
                val, _ = conform_value(x, ff, path, collection.dynamic, k, pre)
                tmp = f"__c{len(scalar_vals)}"
                scalar_vals.append(val.cast(ff.spark_type()).alias(tmp))
                cols.append(F.col(tmp).alias(out_name))
                scalar_errs.append((_err(present & F.col(tmp).isNull(), path, _reason(x, k, ff)), False))
    items = scalar_errs + items
    if scalar_vals:
        d = d.select("*", *scalar_vals)
    if collection.dynamic == "strict":
        extra = F.array_except(F.coalesce(object_keys(v), F.array().cast("array<string>")),
                               F.array(*[F.lit(k) for k in collection.fields]))
        items.append((_err(F.size(extra) > 0, "_root",
                           F.concat(F.lit("strict mapping rejects undeclared field(s): "), F.array_join(extra, ","))), False))
    root_err = F.array(F.struct(F.lit("_root").alias("field"), F.lit("document is not a JSON object").alias("reason")))
    all_errs = F.when(not_object, root_err.cast(ERROR_TYPE)).otherwise(_combine(items))
    # Optimizer barrier: a filter on _errors (split_valid) would otherwise be pushed below these staged
    # projections with every column alias substituted, re-expanding the per-field kind expressions many times
    # over. spark_partition_id() is non-deterministic for Catalyst (so filters stay above this projection) but
    # always >= 0, so the value is unchanged.
    all_errs = F.when(F.spark_partition_id() >= 0, all_errs)
    out = [*(keep or [])]
    if id_expr is not None:
        out.append(F.col("__id").cast("string").alias(ID_COL))
    elif id_field is not None:
        out.append(F.try_variant_get(F.col("__doc"), _path(id_field), "string").alias(ID_COL))
    out += cols
    if keep_source:
        out.append(v.alias(SOURCE_COL))
    out.append(all_errs.alias(ERRORS_COL))
    return d.select(*out)


def conform_json(df: DataFrame, collection: Collection, raw_col: str = "doc", id_expr: Column | None = None,
                 keep: list[str] | None = None, keep_source: bool = True, id_field: str | None = None) -> DataFrame:
    """S2 + C1: JSON text documents → typed rows. Unparseable text is an error row, not a failed job."""
    parsed = F.try_parse_json(F.col(raw_col))
    looks_like_object = F.ltrim(F.col(raw_col)).startswith("{") & parsed.isNotNull()
    return conform_variant(df, collection, parsed, id_expr, keep, keep_source, looks_like_object, id_field)


def _typed_scalar(c: Column, src: T.DataType, f: Field, path: str) -> tuple[Column, Column] | None:
    """Conversion of a typed column to a declared scalar field, or None when only the variant path applies."""
    t = f.type
    present = c.isNotNull()
    if f.multi or t in ("object", "nested", "geo_point"):
        return None
    if t in ("keyword", "text"):
        return (c, None) if isinstance(src, T.StringType) else None
    if t in ("integer", "long"):
        lo, hi = INT_RANGE[t]
        if isinstance(src, (T.ByteType, T.ShortType, T.IntegerType)) or (t == "long" and isinstance(src, T.LongType)):
            return c.cast(t if t == "long" else "int"), None
        if isinstance(src, (T.LongType, T.DecimalType, T.DoubleType, T.FloatType)):
            d = c.cast("double") if not isinstance(src, (T.LongType, T.DecimalType)) else c.cast("decimal(38,6)")
            whole = d == F.floor(d)
            in_range = (d >= F.lit(lo)) & (d <= F.lit(hi))
            ok = whole & in_range
            reason = F.when(~whole, F.lit("fractional value for an integral field")).otherwise(F.lit(f"out of range for {t}"))
            return F.when(ok, c.cast("int" if t == "integer" else "long")), _err(present & ~ok, path, reason)
        return None
    if t in ("float", "double"):
        if isinstance(src, T.NumericType):
            v = c.cast("double")
            if t == "float":
                ok = F.abs(v) <= F.lit(FLOAT_MAX)
                return F.when(ok, v.cast("float")), _err(present & ~ok, path, "expected a number for float")
            return v, None
        return None
    if t == "boolean":
        return (c, None) if isinstance(src, T.BooleanType) else None
    if t == "date":
        if isinstance(src, (T.TimestampNTZType, T.TimestampType, T.DateType)):
            return F.date_trunc("millisecond", c.cast("timestamp")).cast("timestamp_ntz"), None
        if isinstance(src, T.StringType):
            v = F.date_trunc("millisecond", parse_date(c, f.date_formats())).cast("timestamp_ntz")
            return v, _err(present & v.isNull(), path, "date does not match format " + (f.format or "default"))
        return None
    if t == "ip" and isinstance(src, T.StringType):
        ok = ip_key(c).isNotNull()
        return F.when(ok, F.trim(c)), _err(present & ~ok, path, "not an IP address")
    return None


def conform_frame(df: DataFrame, collection: Collection, id_expr: Column | None = None,
                  keep: list[str] | None = None, keep_source: bool = False) -> DataFrame:
    """C1 on an already typed DataFrame. Columns whose Spark type converts directly (numbers, strings, booleans,
    timestamps) are cast with the same checks as JSON values, without building a VARIANT; anything else (objects,
    arrays, strings into numbers) goes through the VARIANT path. A null column value counts as an explicit null."""
    src = {f.name: f.dataType for f in df.schema.fields}
    plan = {}
    for name, f in collection.fields.items():
        if name not in src:
            plan[name] = (F.lit(None).cast(f.spark_type()), None)
            continue
        r = _typed_scalar(F.col(name), src[name], f, name)
        if r is None or any(_typed_scalar(F.col(name), src[name], sf, f"{name}.{sub}") is None
                            for sub, sf in (f.fields or {}).items()):
            plan = None
            break
        plan[name] = r
    extra = [c for c in df.columns if c not in collection.fields]
    if plan is None or keep_source:
        cols = [c for c in df.columns if c not in (ID_COL, SOURCE_COL, ERRORS_COL)]
        return conform_variant(df, collection, F.to_variant_object(F.struct(*[F.col(c) for c in cols])),
                               id_expr, keep, keep_source)
    out = [*(keep or [])]
    if id_expr is not None:
        out.append(id_expr.cast("string").alias(ID_COL))
    errs = []
    for name, f in collection.fields.items():
        val, err = plan[name]
        nv = _null_value(f)
        if nv is not None and name in src:
            val = F.when(F.col(name).isNull(), nv).otherwise(val)
        columns = f.columns(name)
        out.append(val.cast(f.spark_type()).alias(columns[0]))
        errs.append(err)
        for col, (sub, sf) in zip(columns[1:], (f.fields or {}).items()):
            sval, serr = _typed_scalar(F.col(name), src[name], sf, f"{name}.{sub}")
            out.append(sval.cast(sf.spark_type()).alias(col))
            errs.append(serr)
    if collection.dynamic == "strict":
        undeclared = [c for c in extra if c not in (ID_COL, SOURCE_COL, ERRORS_COL) and c not in (keep or [])]
        if undeclared:
            names_present = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in undeclared]))
            errs.append(_err(F.size(names_present) > 0, "_root",
                             F.concat(F.lit("strict mapping rejects undeclared field(s): "), F.array_join(names_present, ","))))
    out.append(_combine([(e, False) for e in errs if e is not None]).alias(ERRORS_COL))
    return df.select(*out)


def runtime_field(path: str, spark_type: str, source_col: str = SOURCE_COL) -> Column:
    """An undeclared field read at query time from the kept source."""
    return F.try_variant_get(F.col(source_col), "$." + path, spark_type)


# ----------------------------------------------------------------------------------------------------------------
# Accepted / rejected split and counts
# ----------------------------------------------------------------------------------------------------------------

def split_valid(conformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without ``_errors``, rejected rows with ``_errors``)."""
    ok = F.size(F.col(ERRORS_COL)) == 0
    return conformed.filter(ok).drop(ERRORS_COL), conformed.filter(~ok)


def generated_id(salt: str | int, cols: list[str], ordinal: Column | None = None) -> Column:
    """Id for documents without one: hash of a salt that names the write, the row's input position (``ordinal``,
    taken on the file scan before any shuffle, so stable under task retry) and its content. Writes with different
    salts give equal documents different ids."""
    pos = (ordinal if ordinal is not None else F.monotonically_increasing_id()).cast("string")
    return F.substring(F.sha2(F.concat_ws("\u0001", F.lit(str(salt)), pos,
                                          F.to_json(F.struct(*[F.col(c) for c in cols]))), 256), 1, 32)


# ----------------------------------------------------------------------------------------------------------------
# Partial documents
# ----------------------------------------------------------------------------------------------------------------

def object_depth(v: Column, levels: int) -> Column:
    """How many object levels a VARIANT object has, ``levels`` at most (objects inside arrays do not count)."""
    def below(x: Column, left: int) -> Column:
        if left == 0:
            return F.lit(0)
        values = F.map_values(F.try_variant_get(x, "$", "map<string,variant>"))
        return F.lit(1) + F.coalesce(F.array_max(F.transform(values, lambda y: F.when(_is_object(y), below(y, left - 1))
                                                             .otherwise(F.lit(0)))), F.lit(0))
    return F.when(_is_object(v), below(v, levels)).otherwise(F.lit(0))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def merge_documents(stored: Column, partial: Column, levels: int) -> Column:
    """The stored VARIANT document with a partial one put over it: keys that the partial document names are set (also to
    null), objects on both sides are merged key by key, ``levels`` deep, anything else is replaced, and keys that it does
    not name stay. Where there is no partial document the stored one stays."""
    def entries(v: Column) -> Column:
        return F.coalesce(F.try_variant_get(v, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))

    def over(old: Column, new: Column, left: int) -> Column:
        def pick(_, a: Column, b: Column) -> Column:
            kept = F.when(b.isNull(), a)
            if left > 1:
                kept = kept.when(_is_object(a) & _is_object(b), over(a, b, left - 1))
            return kept.otherwise(b)
        return F.to_variant_object(F.map_zip_with(entries(old), entries(new), pick))

    return F.when(partial.isNull(), stored).otherwise(over(stored, partial, max(levels, 1)))


# ----------------------------------------------------------------------------------------------------------------
# Dynamic discovery
# ----------------------------------------------------------------------------------------------------------------

LEVELS = 6                   # object levels that one scan of the documents looks into


PATHS = "array<struct<path:string,kind:string,below:variant>>"


def _paths_of(v: Column, prefix: Column | None, levels: int, elements: bool) -> Column:
    """array<struct(path, kind, below)>: every key below object ``v``, ``levels`` deep. Objects that go on deeper are
    listed once more without a kind, with themselves as ``below``."""
    none, no_value = F.array().cast(PATHS), F.lit(None).cast("variant").alias("below")

    def entry(e: Column) -> Column:
        key = F.replace(F.replace(e["key"], F.lit("\\"), F.lit("\\\\")), F.lit("."), F.lit("\\."))
        path = key if prefix is None else F.concat(prefix, F.lit("."), key)
        return F.struct(path.alias("p"), e["value"].alias("v"), kind_of_schema(F.schema_of_variant(e["value"])).alias("k"))

    def found(z: Column) -> Column:
        many, one = z["k"] == "array", z["k"] == "object"
        held = F.when(many, F.try_variant_get(z["v"], "$", "array<variant>")).when(one, F.array(z["v"]))
        inside = F.transform(held, lambda x: F.struct(x.alias("v"), kind_of_schema(F.schema_of_variant(x)).alias("k")))
        item = lambda kind: F.struct(z["p"].alias("path"), kind.alias("kind"), no_value)                 # noqa: E731
        parts = [F.array(item(z["k"]))]
        if elements:
            parts.append(F.when(many, F.transform(inside, lambda x: item(F.concat(F.lit("array<"), x["k"], F.lit(">")))))
                         .otherwise(none))
        objects = F.filter(inside, lambda x: x["k"] == "object")
        if levels > 1:
            deeper = F.flatten(F.transform(objects, lambda x: _paths_of(x["v"], z["p"], levels - 1, elements)))
        else:
            deeper = F.transform(objects, lambda x: F.struct(z["p"].alias("path"), F.lit(None).cast("string").alias("kind"),
                                                             x["v"].alias("below")))
        parts.append(F.when(many | one, deeper).otherwise(none))
        return F.concat(*parts)

    entries = F.map_entries(F.coalesce(F.try_variant_get(v, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    return F.flatten(F.transform(F.transform(entries, entry), found))


def observed_paths(df: DataFrame, doc: Column, depth: int | None = None, elements: bool = False) -> DataFrame:
    """(path, kind, n_docs) for every key seen in the documents, down to ``depth`` object levels (all by default). Keys
    inside arrays of objects are counted per element. A dot inside a key is escaped as ``\\.``. With ``elements``, what
    arrays hold is counted too, as the kind ``array<kind>``.

    One expression lists all paths of a document, so the documents are scanned once for every ``LEVELS`` levels they
    have, and the listed paths are counted with partial aggregation. Whether documents go on below is one of the counts
    (which are written to the checkpoint folder, so asking costs no scan); if so, the objects down there are listed in
    the same way. An aggregated schema of all documents would tell the shape first, but it grows with the distinct keys
    in the memory of every task, and hides what lies below a key of several kinds."""
    rows = ensure_parallelism(df, target_bytes=CONFORM_PARTITION_BYTES).select(F.lit(None).cast("string").alias("prefix"), doc.alias("doc"))
    first, seen = True, None
    while True:
        levels = min(LEVELS, depth or LEVELS)
        found = rows.select(F.explode(_paths_of(F.col("doc"), None if first else F.col("prefix"), levels, elements)).alias("f"))
        counts = found.groupBy("f.path", "f.kind").agg(F.count(F.lit(1)).alias("n_docs"))
        depth = depth and depth - levels
        if depth != 0:
            ensure_checkpoint_dir(df.sparkSession)
            counts = counts.checkpoint(eager=True)
        known = counts.where("kind IS NOT NULL")
        seen = known if seen is None else seen.unionByName(known)
        if depth == 0 or counts.where("kind IS NULL").isEmpty():
            return seen if first else seen.groupBy("path", "kind").agg(F.sum("n_docs").alias("n_docs"))
        rows, first = found.where("f.kind IS NULL").select(F.col("f.path").alias("prefix"), F.col("f.below").alias("doc")), False


# Shapes that do not tell every (path, kind) of a document: arrays of anything but one plain kind, and quoted keys.
OPEN_SHAPE = r"ARRAY<(?!(BIGINT|STRING|BOOLEAN)>)|VARIANT|`"


def representatives(df: DataFrame, doc: Column) -> DataFrame:
    """``doc``: documents that show the same (path, kind) pairs as all of ``df``, whole arrays of nulls or of nothing
    apart: one for each shape (the schema of a document with its numbers as whole or not), and every document whose
    shape leaves something open. Listing the paths of a document costs many times what its shape does."""
    rows = ensure_parallelism(df, target_bytes=CONFORM_PARTITION_BYTES).select(doc.alias("doc"))
    # a filter must not sink below the dealing of the rows, into few input tasks (see the barrier in conform_variant)
    rows = rows.select("doc", F.when(F.spark_partition_id() >= 0, F.schema_of_variant("doc")).alias("shape"))
    is_open = F.coalesce(F.col("shape").rlike(OPEN_SHAPE), F.lit(True))
    shape = F.regexp_replace(F.regexp_replace("shape", r"DECIMAL\(\d+,0\)", "BIGINT"), r"DECIMAL\(\d+,\d+\)", "DOUBLE")
    alike = rows.where(~is_open).select("doc", shape.alias("shape")).dropDuplicates(["shape"])
    return alike.select("doc").unionByName(rows.where(is_open).select("doc"))


# The field type given to an undeclared field of each JSON kind when no template matches.
DEFAULT_DYNAMIC_TYPES = {"long": "long", "double": "float", "boolean": "boolean", "date": "date"}


def dynamic_field(kind: str, name: str, templates: tuple[DynamicTemplate, ...]) -> Field | None:
    for t in templates:
        if t.matches(name, kind):
            return t.mapping
    if kind == "string":
        return Field("text", fields={"keyword": Field("keyword")})
    if kind in DEFAULT_DYNAMIC_TYPES:
        return Field(DEFAULT_DYNAMIC_TYPES[kind])
    return None


# Which kind stands for a path that is seen with several, first to last.
KIND_ORDER = ("object", "string", "double", "long", "boolean", "date", "array")


def _leading(kinds) -> str | None:
    known = [k for k in KIND_ORDER if k in kinds]
    return known[0] if known else None


def _discovered(name: str, path: str, by_path: dict[str, set], held: dict[str, set], below: dict[str, list],
                templates: tuple[DynamicTemplate, ...]) -> Field | None:
    """The field for an undeclared key, with what lies under it."""
    kinds = by_path[path] - {"null"}
    kind = _leading(kinds - {"array"} if "array" not in kinds else (kinds | held.get(path, set())) - {"array", "null"})
    many = "array" in kinds
    if kind is None:
        return None
    if kind == "object" or below.get(path):
        props = {k: f for k, p in below.get(path, []) if (f := _discovered(k, p, by_path, held, below, templates))}
        return Field("nested" if many else "object", properties=props) if props else None
    f = dynamic_field(kind, name, templates)
    if f is None or not many:
        return f
    return replace(f, multi=True, fields=None) if f.type not in ("object", "nested") else f


def _added(fields: Mapping[str, Field], prefix: str, dynamic, by_path, held, below, templates) -> dict[str, Field]:
    out = dict(fields)
    for name, path in below.get(prefix, []):
        if name not in out:
            if dynamic is True and name != ID_COL:
                f = _discovered(name, path, by_path, held, below, templates)
                if f is not None:
                    out[name] = f
        elif out[name].properties:
            own = out[name].dynamic if out[name].dynamic is not None else dynamic
            out[name] = replace(out[name], properties=_added(out[name].properties, path, own, by_path, held, below,
                                                             templates))
    return out


def widen(collection: Collection, paths: list[tuple[str, str]]) -> Collection:
    """C4 + C9: add the undeclared fields seen in the data (``paths``: (path, kind) pairs of :func:`observed_paths`
    with its ``elements``; arrays whose elements are not given are left out), at any depth, inside declared objects too unless the object's own
    ``dynamic`` says otherwise. A path seen with several kinds takes the first of ``KIND_ORDER``; arrays of scalars
    become multi-valued fields, arrays of objects nested ones. Templates apply in list order. Keys that can't name a
    column get another name (:func:`docspark.schema.named_columns`); an empty key gets no column and stays in
    ``_source``."""
    by_path: dict[str, set] = {}
    elements: dict[str, set] = {}
    for p, k in paths:
        if k is not None and k.startswith("array<"):
            elements.setdefault(p, set()).add(k[6:-1])
        elif k is not None:
            by_path.setdefault(p, set()).add(k)
    below: dict[str, list] = {}
    for p in sorted(by_path):
        parts = split_path(p)
        if "" in parts:
            continue
        parent = ""
        for k in parts[:-1]:
            parent = join_path(parent, k)
        below.setdefault(parent, []).append((parts[-1], p))
    return collection.with_fields(_added(collection.fields, "", collection.dynamic, by_path, elements, below,
                                         collection.dynamic_templates))
