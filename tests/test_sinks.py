"""Sinks: table write, versioned upsert publish, incremental results, model files."""

from plaintscope.sources import sinks


def test_write_table_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, 'say "hi"')], "id int, t string")
    sinks.write_table(df, str(tmp_path / "p"))
    sinks.write_table(df, str(tmp_path / "c"), fmt="csv")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert sorted(r.t for r in back.collect()) == ["a,b", 'say "hi"']


def test_model_persistence(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    train = spark.createDataFrame([(Vectors.sparse(2, [0], [1.0]), 0.0), (Vectors.sparse(2, [1], [1.0]), 1.0)],
                                  ["features", "label"])
    model = LogisticRegression(maxIter=5).fit(train)
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "term string, term_index int")
    sinks.save_classifier(model, vocab, ["q0", "q1"], str(tmp_path / "m"))
    m2, v2, classes = sinks.load_classifier(spark, str(tmp_path / "m"))
    assert classes == ["q0", "q1"] and v2.count() == 2
    assert m2.coefficientMatrix.toArray().tolist() == model.coefficientMatrix.toArray().tolist()
