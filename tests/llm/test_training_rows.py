"""Classifiers learn from one row per labelled document, however often its id is repeated."""

from pyspark.sql import functions as F

from tidemill.llm import quality, toxicity


def test_repeated_ids_are_one_training_row(spark, sf_dir, monkeypatch):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    first = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).agg(F.min("doc_id")).first()[0]
    more = spark.range(300).select(F.lit(first).cast("long").alias("doc_id"), F.concat(F.lit("again "), F.col("id").cast("string")).alias("text"))
    many = docs.select("doc_id", "text").union(more)
    known = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).join(docs.select("doc_id"), "doc_id").select("doc_id").distinct().count()
    seen = []
    monkeypatch.setattr(quality, "train", lambda x, y: seen.append(len(y)))
    monkeypatch.setattr(toxicity, "train_chain", lambda rows, *_: seen.append(len(rows)))
    quality.fit_quality(many, labels)
    toxicity.fit_toxicity(many, labels, ["toxic"])
    assert seen == [known, known]
