"""Collections in the Spark catalog: versions, logical names, writes, rebuilds.

A collection with ``use_alias=True`` is a view named after the collection over an immutable physical table
``{name}_v{version}`` (later writes of the same version get ``__g{n}`` suffixes). Every write builds the new
content as a DataFrame (:mod:`docspark.operators.writes`), writes it as a new table bucketed by ``_id`` and then
replaces the view in one catalog call. Readers that resolved the old table keep reading it (snapshot, S14).
One writer per collection at a time is assumed.

Tables are written with ``saveAsTable`` into the session's warehouse (on a cluster: the shared warehouse the
platform configures). A bulk batch is conformed once into the checkpoint folder; its counts and the upsert read it.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..errors import BreakingChangeError, BulkPartialFailureError, CollectionNotFoundError, FieldLimitError, MigrationError
from ..operators import conform as C
from ..operators import writes as W
from ..operators.drift import SchemaDiff, diff_mappings, diff_settings, evolve_additive
from ..plans.sizing import partitions_for, scratch_path
from ..schema import ERRORS_COL, ID_COL, SOURCE_COL, Collection, Field, flatten_paths, stored_mapping

PROP_PHYSICAL = "docspark.physical"
PROP_VERSION = "docspark.version"
PROP_BUCKETS = "docspark.buckets"
PROP_GENERATION = "docspark.generation"      # highest write generation ever used; numbers are not used again
PROP_SETTINGS = "docspark.settings"
PROP_PIN = "docspark.pin."                   # one property of the physical table for each open snapshot
FIELD_LIMIT = 10_000                         # different (path, kind) pairs that one write may bring
LEVEL_LIMIT = 20                             # object levels of a partial document


@dataclass
class Snapshot:
    """A pinned physical table; reading it never sees later writes. ``pin`` names an open snapshot's pin."""
    name: str
    physical: str
    pin: str | None = None


@dataclass
class MigrateResult:
    from_index: str
    to_index: str
    documents_reindexed: int


class DocStore:
    def __init__(self, spark: SparkSession, database: str | None = None, default_shards: int | None = None):
        self.spark = spark
        self.database = database
        self.default_shards = default_shards

    # ----- names -------------------------------------------------------------------------------------------------
    def _q(self, name: str) -> str:
        if not re.match(r"^[A-Za-z_][A-Za-z0-9_]*$", name):
            raise ValueError(f"bad table name {name!r}")
        return f"{self.database}.{name}" if self.database else name

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self._q(name))

    def _props(self, name: str) -> dict:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self._q(name)}").collect()}

    def current(self, name: str) -> str:
        """Physical table behind a logical name (the name itself for plain tables)."""
        if not self.exists(name):
            raise CollectionNotFoundError(name)
        return self._props(name).get(PROP_PHYSICAL, name)

    def read(self, name: str) -> DataFrame:
        """By logical or physical name."""
        if not self.exists(name):
            raise CollectionNotFoundError(name)
        return self.spark.table(self._q(name))

    def snapshot(self, name: str) -> Snapshot:
        return Snapshot(name, self.current(name))

    def read_snapshot(self, snap: Snapshot) -> DataFrame:
        return self.spark.table(self._q(snap.physical))

    def open_snapshot(self, name: str) -> Snapshot:
        """A snapshot whose table stays until :meth:`close_snapshot`, whoever drops unused tables or rebuilds the
        collection meanwhile. The pin is a property of the table, so other sessions of the catalog see it."""
        snap = Snapshot(name, self.current(name), uuid.uuid4().hex)
        self.spark.sql(f"ALTER TABLE {self._q(snap.physical)} SET TBLPROPERTIES ('{PROP_PIN}{snap.pin}'='open')")
        return snap

    def close_snapshot(self, snap: Snapshot) -> bool:
        """Give up an open snapshot; False if it was closed before. Its table goes with the next :meth:`drop_unused`."""
        if snap.pin is None or not self.exists(snap.physical) or snap.pin not in self.pins(snap.physical):
            return False
        self.spark.sql(f"ALTER TABLE {self._q(snap.physical)} UNSET TBLPROPERTIES IF EXISTS ('{PROP_PIN}{snap.pin}')")
        return True

    def pins(self, physical: str) -> set[str]:
        """The open snapshots of a physical table."""
        return {k[len(PROP_PIN):] for k in self._props(physical) if k.startswith(PROP_PIN)}

    # ----- writing tables ----------------------------------------------------------------------------------------
    def _shards(self, coll: Collection, df: DataFrame | None = None) -> int:
        """Bucket count: declared ``num_shards``, else the store default, else sized from the data (~256 MB each)."""
        if coll.num_shards or self.default_shards:
            return coll.num_shards or self.default_shards
        return partitions_for(df) if df is not None else int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _generation(self, coll: Collection) -> int:
        """Highest generation number of this version that was ever written (0: none). The logical name remembers
        it, so a number is not used again after its table was dropped and old snapshots never see new rows."""
        used = [0]
        if coll.use_alias and self.exists(coll.logical_name):
            props = self._props(coll.logical_name)
            if props.get(PROP_PHYSICAL, "").split("__g")[0] == coll.physical_name:
                used.append(int(props.get(PROP_GENERATION, 1)))
        tables = self.generations(coll.logical_name) if coll.use_alias else []
        used += [int(t.split("__g")[1]) if "__g" in t else 1 for t in tables if t.split("__g")[0] == coll.physical_name]
        return max(used)

    def _next_physical(self, coll: Collection) -> str:
        g = self._generation(coll) + 1
        return coll.physical_name if g == 1 else f"{coll.physical_name}__g{g}"

    def _write(self, df: DataFrame, table: str, coll: Collection, buckets: int | None = None) -> int:
        """Write ``df`` as a table bucketed by ``_id``; returns the bucket count.

        With ``buckets`` given (a new generation of an existing collection) the content comes from the previous
        generation's bucketed scan joined to a change set, so its rows already arrive grouped by bucket: it is
        written without another shuffle, keeping the same bucket count. A first write (create, migrate) shuffles
        once by ``_id`` so each bucket is one file."""
        writer = None
        if buckets:
            n = buckets
            writer = df.write
        else:
            n = self._shards(coll, df)
            writer = df.repartition(n, ID_COL).write
        writer.bucketBy(n, ID_COL).mode("errorifexists").saveAsTable(self._q(table))
        return n

    def _buckets(self, name: str) -> int | None:
        v = self._props(name).get(PROP_BUCKETS) if self.exists(name) else None
        return int(v) if v else None

    def _point(self, coll: Collection, physical: str, buckets: int | None = None) -> None:
        if not coll.use_alias:
            return
        settings = json.dumps(coll.static_settings(), sort_keys=True, default=str).replace("\\", "\\\\").replace("'", "\\'")
        generation = max(self._generation(coll), int(physical.split("__g")[1]) if "__g" in physical else 1)
        extra = f", '{PROP_GENERATION}'='{generation}', '{PROP_SETTINGS}'='{settings}'"
        extra += f", '{PROP_BUCKETS}'='{buckets}'" if buckets else ""
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._q(coll.logical_name)} TBLPROPERTIES "
            f"('{PROP_PHYSICAL}'='{physical}', '{PROP_VERSION}'='{coll.version}'{extra}) "
            f"AS SELECT * FROM {self._q(physical)}")

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._q(table)}")

    def empty(self, coll: Collection) -> DataFrame:
        return self.spark.createDataFrame([], coll.stored_type())

    def create(self, coll: Collection, df: DataFrame | None = None) -> str:
        """Create the physical table (no-op when it exists) and point the logical name at it. Refuses when
        the logical name already points at another version (use :meth:`migrate`)."""
        phys = coll.physical_name
        if coll.use_alias and self.exists(coll.logical_name):
            cur = self.current(coll.logical_name)
            if cur.split("__g")[0] != phys:
                raise MigrationError(f"{coll.logical_name} points at {cur}; migrate to change versions")
            return cur
        n = None
        if not self.exists(phys):
            n = self._write(self._with_source(df, coll) if df is not None else self.empty(coll), phys, coll)
        self._point(coll, phys, n)
        return phys

    def _with_source(self, df: DataFrame, coll: Collection) -> DataFrame:
        """Conformed rows in the collection's stored schema; where there is no ``_source`` it is null (a rebuild then
        reads the columns)."""
        stored = coll.stored_type()
        out = df if SOURCE_COL in df.columns else df.withColumn(SOURCE_COL, F.lit(None).cast("variant"))
        return out.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in stored.fields if f.name in out.columns],
                          *[c for c in out.columns if c not in stored.fieldNames()])

    def _replace(self, coll: Collection, new_content: DataFrame) -> str:
        """Write the new content as the next physical table of this version and repoint the logical name."""
        if not coll.use_alias:
            # plain table: materialise first (the new content reads the table being replaced)
            saved = new_content.checkpoint(eager=True)
            n = self._shards(coll, saved)
            saved.repartition(n, ID_COL).write.bucketBy(n, ID_COL).mode("overwrite").saveAsTable(
                self._q(coll.physical_name))
            return coll.physical_name
        phys = self._next_physical(coll)
        n = self._write(new_content, phys, coll, buckets=self._buckets(coll.logical_name))
        self._point(coll, phys, n)
        return phys

    # ----- document writes ---------------------------------------------------------------------------------------
    def stored_mapping(self, name: str) -> dict:
        """The mapping that the stored rows were written with (fields discovered by earlier writes included)."""
        return stored_mapping(self.read(name).schema)

    def _stored(self, coll: Collection) -> Collection:
        """``coll`` with the fields that the stored rows were written with. Its settings are the declared ones: they are
        compared with the stored ones by :meth:`schema_diff`, a write only asks whether the fields fit."""
        fields = {k: Field.from_mapping(m) for k, m in self.stored_mapping(coll.logical_name).items()}
        return replace(coll, fields=fields or coll.fields)

    def _keep_columns(self, coll: Collection, discovered: bool = False) -> Collection:
        """``coll`` with the columns that stored fields have; with ``discovered`` also the undeclared fields themselves."""
        if not self.exists(coll.logical_name):
            return coll

        def merge(declared, stored: dict) -> dict:
            out = dict(declared)
            for k, m in stored.items():
                if k not in out:
                    if discovered:
                        out[k] = replace(Field.from_mapping(m), column=m.get("column", k))
                    continue
                below = m.get("properties") if out[k].properties else None
                out[k] = replace(out[k], column=m.get("column", k),
                                 **({"properties": merge(out[k].properties, below)} if below else {}))
            return out
        return replace(coll, fields=merge(coll.fields, self.stored_mapping(coll.logical_name)))

    def _effective(self, coll: Collection) -> Collection:
        """``coll`` with the columns of what is stored and the undeclared fields that earlier writes discovered."""
        return self._keep_columns(coll, discovered=coll.dynamic is True)

    def _widened(self, asked: Collection, coll: Collection, docs: DataFrame, doc: Column) -> Collection:
        """``coll`` with the undeclared fields of ``docs`` where the declaration lets them become fields."""
        if asked.dynamic is not True and not any(f.dynamic is True for _, f in flatten_paths(coll.fields)):
            return coll
        seen = C.observed_paths(C.representatives(docs, doc), F.col("doc"), elements=True).select("path", "kind").limit(FIELD_LIMIT + 1).collect()
        if len(seen) > FIELD_LIMIT:
            raise FieldLimitError(f"the documents have more than {FIELD_LIMIT} different paths; keys that are data belong "
                                  "under an object whose dynamic is false or runtime")
        return C.widen(coll, [(r["path"], r["kind"]) for r in seen])

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` to the checkpoint folder once and go on from the files."""
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def bulk_index(self, coll: Collection, docs: DataFrame, raw_col: str | None = "doc", id_expr: Column | None = None,
                   order_col: str | None = None, throw_on_failure: bool = False,
                   id_field: str | None = None, batch: str | None = None) -> W.BulkResult:
        """Conform JSON (``raw_col``) or typed documents, upsert the accepted ones (last duplicate id wins),
        publish, and report counts. With ``throw_on_failure`` nothing is published when any document failed.

        Every stored row keeps its document in ``_source``. Undeclared keys live there (``dynamic`` false or
        ``runtime``), or become typed columns first (``dynamic`` true; per object where the object says so). A
        document without an id gets a generated one, salted with ``batch`` (default: the generation being written),
        so equal documents of different writes stay apart. ``order_col`` gives the order of the documents; without
        it their position in a file scan counts, which a shuffle before this call would not keep."""
        name = coll.logical_name
        asked, coll = coll, self._effective(coll)
        if order_col is None:
            docs = W.with_input_order(docs)
            order_col = W.ORDER_COL
        if raw_col is not None:
            parsed = docs.withColumn("__json", F.try_parse_json(F.col(raw_col)))
        else:
            fields = [c for c in docs.columns if c not in (ID_COL, SOURCE_COL, ERRORS_COL, order_col)]
            parsed = docs.withColumn("__json", F.to_variant_object(F.struct(*[F.col(c) for c in fields])))
        coll = self._widened(asked, coll, parsed, F.col("__json"))
        looks = (F.ltrim(F.col(raw_col)).startswith("{") & F.col("__json").isNotNull()) if raw_col is not None else None
        conformed = C.conform_variant(parsed, coll, F.col("__json"), id_expr, [order_col], True, looks, id_field)
        if id_expr is None and id_field is None:
            conformed = conformed.withColumn(ID_COL, F.lit(None).cast("string"))
        salt = batch or (self._next_physical(coll) if coll.use_alias else uuid.uuid4().hex)
        own = [c for c in conformed.columns if c not in (ERRORS_COL, SOURCE_COL, order_col, ID_COL)]
        conformed = conformed.withColumn(ID_COL, F.coalesce(F.col(ID_COL), C.generated_id(salt, own, F.col(order_col))))
        # The conformed batch is written once to the checkpoint folder: counts come from it (one small column),
        # the upsert reads it, and the lineage back to the raw input is cut (a lost executor does not re-parse).
        staged = self._stage(conformed, f"bulk-{name}")
        cnt = staged.agg(F.count(F.lit(1)).alias("total"),
                         F.count_if(F.size(ERRORS_COL) > 0).alias("failed")).first()
        total, failed = int(cnt["total"]), int(cnt["failed"] or 0)
        ok, bad = C.split_valid(staged)
        res = W.BulkResult(total, total - failed, failed, bad)
        if throw_on_failure and failed:
            raise BulkPartialFailureError(f"{failed} of {total} documents failed", res)
        target = [f.name for f in coll.stored_type().fields]
        if self.exists(name):
            base = self.read(name)
            base = evolve_additive(self._with_source(base, coll), self._stored(coll), coll)
        else:
            base = self.empty(coll)
        base = base.select(*target, *[c for c in base.columns if c not in target])
        self._upsert(coll, base, W.last_per_id(ok, ID_COL, order_col))
        return res

    def _upsert(self, coll: Collection, base: DataFrame, changes: DataFrame) -> None:
        """Publish ``base`` with the rows of ``changes`` (one per id) in place of its own; what is stored in buckets
        keeps one file a bucket."""
        n = self._buckets(coll.logical_name) if coll.use_alias else None
        new = W.upsert_in_buckets(base, changes, n) if n else W.upsert(base, changes, ID_COL, unique=True)
        self._replace(coll, self._with_source(new, coll))

    def update(self, coll: Collection, changes: DataFrame, order_col: str | None = None) -> DataFrame:
        """:meth:`update_docs` with columns; returns the ids that matched nothing."""
        return self.update_docs(coll, changes, None, order_col).unmatched_ids

    def update_docs(self, coll: Collection, changes: DataFrame, raw_col: str | None = "doc",
                    order_col: str | None = None) -> W.UpdateResult:
        """Put partial documents over stored ones: ``_id`` and JSON in ``raw_col``, or with ``raw_col=None`` the
        other columns (with ``_present`` only the keys it lists; else every column, nulls included). Of several changes
        to one id the last counts (by ``order_col``, else by position in a file scan).

        The stored document takes the named keys (:func:`~docspark.operators.conform.merge_documents`), then it is
        conformed again: multi-fields, null values, type checks and ``dynamic`` follow it like a written document.
        A document that the change makes invalid stays as it was and is reported with its ``_errors``; others of the
        same batch are updated. Rows without a stored document are read back from their columns first."""
        name = coll.logical_name
        asked, coll = coll, self._effective(coll)
        if order_col is None:
            changes = W.with_input_order(changes)
            order_col = W.ORDER_COL
        if raw_col is not None:
            part = F.try_parse_json(F.col(raw_col))
            text = F.ltrim(F.col(raw_col)).startswith("{") & part.isNotNull()
        else:
            known = {f.column or k: k for k, f in coll.fields.items()}
            cols = [c for c in changes.columns if c not in (ID_COL, SOURCE_COL, ERRORS_COL, W.PRESENT_COL, order_col)]
            unknown = [c for c in cols if c not in known]
            if unknown and asked.dynamic is not True:
                raise ValueError(f"update names undeclared fields: {unknown}")
            part = F.to_variant_object(F.struct(*[F.col(f"`{c}`").alias(known.get(c, c)) for c in cols]))
            if W.PRESENT_COL in changes.columns:
                keys = F.try_variant_get(part, "$", "map<string,variant>")
                part = F.to_variant_object(F.map_filter(keys, lambda k, _: F.array_contains(W.PRESENT_COL, k)))
            text = F.lit(True)
        given = changes.select(F.col(ID_COL).cast("string").alias(ID_COL), part.alias("__part"), text.alias("__ok"), order_col)
        given = self._stage(W.last_per_id(given, ID_COL, order_col), f"update-{name}")
        levels = given.agg(F.max(C.object_depth(F.col("__part"), LEVEL_LIMIT + 1))).first()[0] or 0
        if levels > LEVEL_LIMIT:
            raise FieldLimitError(f"partial documents have more than {LEVEL_LIMIT} object levels")
        base = evolve_additive(self._with_source(self.read(name), coll), self._stored(coll), coll)
        coll = self._widened(asked, coll, given, F.col("__part"))
        wide = evolve_additive(base, self._stored(coll), coll)
        hit = wide.join(given, ID_COL)
        merged = C.merge_documents(self._document(wide), F.col("__part"), levels)
        staged = self._stage(C.conform_variant(hit, coll, merged, F.col(ID_COL), [], True, F.col("__ok")), f"updated-{name}")
        ok, bad = C.split_valid(staged)
        n = staged.agg(F.count(F.lit(1)).alias("hit"), F.count_if(F.size(ERRORS_COL) > 0).alias("bad")).first()
        total = given.count()
        unmatched = self._stage(given.select(ID_COL).join(staged.select(ID_COL), ID_COL, "left_anti"), f"unmatched-{name}")
        if n["hit"] > (n["bad"] or 0):
            self._upsert(coll, wide, ok)
        return W.UpdateResult(total, n["hit"] - (n["bad"] or 0), n["bad"] or 0, total - n["hit"],
                              bad.select(ID_COL, ERRORS_COL), unmatched)

    @staticmethod
    def _document(rows: DataFrame) -> Column:
        """The document as given where it is kept; else its fields (not the columns of multi-fields) by their keys,
        without the absent ones: a column that is null says nothing about the document."""
        keys = stored_mapping(rows.schema) or {c: {} for c in rows.columns if c not in (ID_COL, SOURCE_COL)}
        doc = F.try_parse_json(F.to_json(F.struct(*[F.col(f"`{m.get('column', k)}`").alias(k) for k, m in keys.items()])))
        return F.coalesce(F.col(SOURCE_COL), doc) if SOURCE_COL in rows.columns else doc

    def delete(self, coll: Collection, ids: DataFrame) -> DataFrame:
        """Returns ids that matched nothing."""
        remaining, unmatched = W.delete_ids(self.read(coll.logical_name), ids)
        unmatched = unmatched.checkpoint(eager=True)
        self._replace(coll, remaining)
        return unmatched

    def delete_where(self, coll: Collection, predicate: Column) -> None:
        """S11."""
        self._replace(coll, W.delete_where(self.read(coll.logical_name), predicate))

    # ----- evolution and rebuild ---------------------------------------------------------------------------------
    def stored_settings(self, name: str) -> dict:
        return json.loads(self._props(name).get(PROP_SETTINGS, "{}")) if self.exists(name) else {}

    def schema_diff(self, declared: Collection) -> SchemaDiff:
        """The declaration against what is stored: the mapping in the table's field metadata and the static
        settings in its properties."""
        name = declared.logical_name
        if not self.exists(name):
            return diff_mappings(declared.mapping(), None)
        out = diff_mappings(declared.mapping(), self.stored_mapping(name))
        if declared.use_alias:
            out.changed_settings = diff_settings(declared.static_settings(), self.stored_settings(name))
        return out

    def sync(self, *declared: Collection) -> str:
        """Publish the additive evolution of the stored content under the same version; refuses when a stored
        field or static setting changed. (Given several declarations, the last counts; what is stored is read.)"""
        new = declared[-1]
        if not self.exists(new.logical_name):
            return self.create(new)
        diff = self.schema_diff(new)
        if diff.is_breaking:
            names = [c["field"] for c in diff.changed_fields] + [f"settings.{k}" for k in diff.changed_settings]
            raise BreakingChangeError("the stored collection differs in " + ", ".join(names), names)
        if not diff.added_fields:
            return self.current(new.logical_name)
        new = self._keep_columns(new)
        return self._replace(new, self._with_source(evolve_additive(self.read(new.logical_name), self._stored(new), new), new))

    def migrate(self, old: Collection, new: Collection, delete_old: bool = False) -> MigrateResult:
        """Copy every document into ``new``'s version under its schema, verify the count, swap, optionally
        drop the old table (one of an open snapshot stays until :meth:`drop_unused` finds it closed). On any failure the new table is removed and the logical name is unchanged."""
        if not new.use_alias:
            raise MigrationError("migrate needs a logical name (use_alias=True)")
        if not self.exists(new.logical_name):
            raise MigrationError(f"{new.logical_name} does not exist")
        src = self.current(new.logical_name)
        target = new.physical_name
        if src.split("__g")[0] == target:
            raise MigrationError(f"version {new.version} of {new.logical_name} is the current one")
        if self.exists(target):
            raise MigrationError(f"a table named {target} is in the way")
        source = self.spark.table(self._q(src))
        n_src = source.count()
        conformed = C.conform_variant(source, new, self._document(source), F.col(ID_COL), keep_source=True)
        ok, _ = C.split_valid(conformed)
        ok = self._with_source(ok, new)
        try:
            n = self._write(ok, target, new)
            written = self.spark.table(self._q(target)).count()
            if written != n_src:
                raise MigrationError(f"copy to {target} accepted {written} of {n_src} documents")
        except Exception as e:
            self.drop(target)
            if isinstance(e, MigrationError):
                raise
            raise MigrationError(f"copy to {target} failed: {e}") from e
        self._point(new, target, n)
        if delete_old and not self.pins(src):
            self.drop(src)
        return MigrateResult(src, target, written)

    def generations(self, name: str) -> list[str]:
        """Physical tables of a logical name (every version and write generation), oldest first."""
        rx = re.compile(rf"^{re.escape(name)}_v\d+(__g\d+)?$")
        db = self.database
        tables = [t.name for t in self.spark.catalog.listTables(db) if rx.match(t.name) and not t.tableType == "VIEW"]
        key = lambda t: (int(t.split("_v")[-1].split("__g")[0]), int(t.split("__g")[1]) if "__g" in t else 1)
        return sorted(tables, key=key)

    def drop_unused(self, name: str, keep: tuple[str, ...] = ()) -> list[str]:
        """Drop every physical table of ``name`` except the current one, ``keep`` and those of open snapshots."""
        cur = self.current(name)
        gone = [t for t in self.generations(name) if t != cur and t not in keep and not self.pins(t)]
        for t in gone:
            self.drop(t)
        return gone
