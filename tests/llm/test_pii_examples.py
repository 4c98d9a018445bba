"""All spans and candidates of a table are examples, not a part of them."""

from pyspark.sql import functions as F

from berthlake.llm import pii


def test_every_span_counts(spark):
    texts = [f"word ip {i // 250}.{i % 250}.1.2 and version {i}.7 here" for i in range(4300)]
    docs = spark.createDataFrame([(t,) for t in texts + texts[:50]], "text string")
    rows = pii.examples(docs)
    n = {r["name"]: r["n"] for r in rows.filter("label = 1").groupBy("name").agg(F.sum("n").alias("n")).collect()}
    # three other ways to write each distinct address, with and without what stands before it
    assert n["ip"] >= 3 * 4300
    counter = rows.filter("label = 0 AND foreign = 1 AND name = 'ip'").agg(F.sum("n")).first()[0]
    assert counter >= 4300
    assert rows.count() < 500  # equal vectors are counted, so the table of examples stays small
