"""Over the whole run, nothing of a copy is packed beside its original."""

import corpus_pipeline

from pyspark.sql import functions as F

from tickloom.llm.queries import table
from tickloom.sources.tables import staged

SF = "/root/testdata/sf0.001"


def test_copies_go_whole(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    several = docs.where(F.size(F.split("text", "\n")) >= 3)
    copies = several.withColumn("doc_id", F.col("doc_id") + 1_000_000)
    near = several.withColumn("doc_id", F.col("doc_id") + 2_000_000).withColumn(
        "text", F.concat(F.col("text"), F.lit("\nwhat only this copy says "), F.col("doc_id").cast("string")))
    planted = staged(docs.unionByName(copies).unionByName(near.select(docs.columns)), "planted")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: planted)
    rows = corpus_pipeline.run(spark, SF).select("doc_id", "doc_tokens").distinct().collect()
    tokens = {r.doc_id: r.doc_tokens for r in rows}
    assert copies.count() > 100
    assert [i for i, n in tokens.items() if 1_000_000 <= i < 2_000_000 and n] == []
    assert all(n < 30 for i, n in tokens.items() if i >= 2_000_000)
    assert any(n > 30 for i, n in tokens.items() if i < 1_000_000)
