"""The training sample has one row per labelled id."""

from pyspark.sql import functions as F

from riskspark.llm import labelled


def test_repeated_ids_give_one_row(spark):
    docs = spark.range(4000).selectExpr("id % 40 AS doc_id", "concat('text ', id) AS text")
    marks = spark.range(40).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    rows = labelled.training_texts(docs, marks, "toxic", 10).collect()
    assert len(rows) == 10 == len({r["doc_id"] for r in rows})
    keyed = {}
    for r in docs.select("doc_id", "text", F.xxhash64("text").alias("key")).collect():
        keyed[r["doc_id"]] = min(keyed.get(r["doc_id"], (r["key"], r["text"])), (r["key"], r["text"]))
    assert all(r["text"] == keyed[r["doc_id"]][1] and r["label"] == r["doc_id"] % 2 for r in rows)
