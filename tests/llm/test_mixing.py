import math

from pyspark.sql import functions as F

from tamizal.llm.mixing import BUDGET, MARGINS, mixing_stage, mixture, raked_factors


def test_margins_meet_targets(spark):
    rows = [("hot", "en", "a", 900), ("hot", "de", "a", 50), ("b", "en", "b", 30), ("b", "de", "a", 20), (None, "en", "b", 5), ("b", None, "b", 7)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens bigint")
    wanted = {"source": {"hot": 0.5, "b": 0.4, None: 0.1}, "lang": {"en": 0.6, "de": 0.3, None: 0.1}, "topic": {"a": 0.6, "b": 0.4}}
    targets = {m: spark.createDataFrame(list(t.items()), "value string, target double") for m, t in wanted.items()}
    factors = {m: {r.value: r.factor for r in f.collect()} for m, f in raked_factors(cells, targets, 200).items()}
    for k, margin in enumerate(MARGINS):
        for value, target in wanted[margin].items():
            mass = sum(r[3] * math.prod(factors[m][r[j]] for j, m in enumerate(MARGINS)) for r in rows if r[k] == value)
            assert abs(mass - target) < 1e-6


def test_targets_that_no_weights_meet_are_told(spark):
    import pytest

    from tamizal.llm.mixing import residual

    cells = spark.createDataFrame([("x", "en", "a", 10), ("y", "de", "a", 10)], "source string, lang string, topic string, tokens bigint")
    wanted = {"source": {"x": 0.9, "y": 0.1}, "lang": {"en": 0.2, "de": 0.8}, "topic": {"a": 1.0}}
    targets = {m: spark.createDataFrame(list(t.items()), "value string, target double") for m, t in wanted.items()}
    with pytest.warns(UserWarning, match="not settled"):
        factors = raked_factors(cells, targets, 3)
    assert 0.05 < residual(cells, factors, targets) < 1


def test_same_draw_again_and_budget(spark, docs):
    a = mixture(docs).cache()
    b = mixture(docs.repartition(3))
    assert {(r.doc_id, r.sampled) for r in a.collect()} == {(r.doc_id, r.sampled) for r in b.collect()}
    expected, total = a.agg(F.sum(F.col("n_tokens") * F.col("probability")), F.sum("n_tokens")).first()
    assert abs(expected / total - BUDGET) < 1e-6
    assert a.where("probability < 0 OR probability > 1").count() == 0 and a.count() == docs.count()


def test_stage_columns_and_no_rows(spark, docs, empty):
    clash = docs.withColumn("topic", F.lit(3)).withColumn("tokens", F.lit(1)).withColumn("cell_lang", F.lit("q"))
    out = mixing_stage(spark, clash, "")
    assert out.columns == clash.columns and 0 < out.count() < docs.count()
    assert mixing_stage(spark, empty, "").count() == 0
