import pytest

from docspark.operators.templates import TemplateRegistry


def test_template_params_size_and_from(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(30)], "k int, v int")
    reg = TemplateRegistry()
    reg.put("page", "SELECT k FROM {t} WHERE v >= :lo ORDER BY k LIMIT :size OFFSET :from")
    assert [r["k"] for r in reg.search(spark, "page", {"lo": 100}, size=3, frames={"t": df}).collect()] == [10, 11, 12]
    assert [r["k"] for r in reg.search(spark, "page", {"lo": 100}, from_=2, frames={"t": df}).collect()] == list(range(12, 22))
    reg.put("plain", "SELECT count(*) AS n FROM {t} WHERE v < :hi")
    assert reg.search(spark, "plain", {"hi": 50}, frames={"t": df}).first()["n"] == 5
    reg.delete("plain")
    with pytest.raises(KeyError):
        reg.get("plain")
