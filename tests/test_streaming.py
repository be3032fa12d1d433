import json
import os

from pyspark.sql import functions as F

from docspark.schema import Collection, Field
from docspark.streaming.ingest import index_stream, json_file_stream

COLL = Collection("stream_product", {"id": Field("keyword"), "price": Field("integer")})


def test_index_stream_micro_batches(spark, store, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(json.dumps({"id": f"p{i}", "price": i}) for i in range(5)))
    (src / "b.json").write_text("\n".join([json.dumps({"id": "p1", "price": 100}), json.dumps({"id": "bad", "price": 1.5})]))
    stream = json_file_stream(spark, str(src), max_files_per_trigger=1)
    report = f"{store.database}.stream_report"
    q = index_stream(stream, store, COLL, str(tmp_path / "ckpt"),
                     id_expr=F.try_variant_get(F.try_parse_json("doc"), "$.id", "string"), report_table=report)
    q.awaitTermination(120)
    rows = {r["_id"]: r["price"] for r in store.read(COLL.name).collect()}
    assert rows == {"p0": 0, "p1": 100, "p2": 2, "p3": 3, "p4": 4}
    rep = spark.table(report).agg(F.sum("total"), F.sum("failed")).first()
    assert tuple(rep) == (7, 1)
