import datetime as dt
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

import rows
from mensura.operators.quantile import exact_quantiles, quantile_of_counts
from mensura.operators import quantile
from mensura.plans import features, forecast, silver, star


def test_exact_quantiles(spark):
    rnd = random.Random(7)
    values = [(rnd.gauss(0, 1), rnd.choice([None, 1.0, 2.0]), None, rnd.randrange(10**9)) for _ in range(3001)]
    df = spark.createDataFrame(values, "a double, b double, c double, d long")
    for q in (0.0, 0.5, 0.8, 1.0):
        found = exact_quantiles(df, ["a", "b", "c", "d"], q)
        expected = df.agg(*[F.percentile(c, F.lit(q)).alias(c) for c in "abcd"]).first().asDict()
        assert found == pytest.approx(expected)


def test_exact_quantiles_narrow_in_rounds(spark, monkeypatch):
    """Tiny limits force several rounds of narrowing; the answer stays exact."""
    monkeypatch.setattr(quantile, "RANKABLE", 20)
    monkeypatch.setattr(quantile, "ACCURACY", 20)
    rnd = random.Random(3)
    values = [(float(rnd.randrange(5000)), 1.0 if rnd.random() < 0.9 else rnd.random()) for _ in range(4000)]
    df = spark.createDataFrame(values, "a double, hot double")
    found = exact_quantiles(df, ["a", "hot"], 0.5)
    expected = df.agg(F.median("a").alias("a"), F.median("hot").alias("hot")).first().asDict()
    assert found == pytest.approx(expected)


def test_a_bracket_that_misses_is_drawn_again(spark, monkeypatch):
    """A sketch that answers wrongly costs a round, not the result."""
    monkeypatch.setattr(quantile, "RANKABLE", 20)
    real, tries = quantile._narrowed, []

    def wrong_at_first(df, counts, bracket, *rest):
        tries.append(1)
        return {c: (0.0, 10.0) for c in counts} if len(tries) == 1 else real(df, counts, bracket, *rest)

    monkeypatch.setattr(quantile, "_narrowed", wrong_at_first)
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"))
    assert exact_quantiles(df, ["a"], 0.5) == {"a": 499.5} and len(tries) > 1
    monkeypatch.setattr(quantile, "_narrowed", lambda df, counts, *rest: {c: (0.0, 10.0) for c in counts})
    with pytest.raises(RuntimeError, match="no bracket"):
        exact_quantiles(df, ["a"], 0.5)


def test_quantile_of_counts(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "v int, n long")
    assert quantile_of_counts(df, "v", "n", 0.8).first()["quantile"] == pytest.approx(2.6)
    assert quantile_of_counts(df.limit(0), "v", "n", 0.8).first()["quantile"] is None


def test_cut_is_the_day_inside_the_month(spark):
    months = spark.createDataFrame([(dt.date(2024, m, 1),) for m in (1, 2, 3)], "fecha_mes date")
    assert forecast.split_date(months).first()["corte"] == dt.date(2024, 2, 18)


@pytest.fixture(scope="module")
def store(spark):
    rnd = random.Random(1)
    months = [
        (w, 2020 + m // 12, m % 12 + 1, None if rnd.random() < 0.05 else 100.0 * w * 0.95**m, 10.0 * w)
        for w in range(1, 9) for m in range(24)
    ]
    fct = rows.fact(spark, months)
    wells = rows.pozos(spark, [(w, *rows.WELLS[w % 3][1:]) for w in range(1, 9)])
    stg = silver.stg_pozos(wells)
    off = features.offline(fct, star.dim_pozo(silver.stg_produccion(rows.produccion(spark, [])), stg)).cache()
    return off, features.online(off).cache()


def test_train_rows(store):
    off, _ = store
    train = forecast.train_set(off)
    assert train.filter("label is null or baseline is null").count() == 0
    assert not {"target_prod_pet_m1", "target_prod_gas_m1", "pozo_sk", "tiempo_sk"} & set(train.columns)
    assert set(forecast.TEXTUAL) == {"cuenca", "provincia", "formacion_productiva", "tipo_reservorio"}


def test_split_in_time(store):
    split = forecast.temporal_split(forecast.train_set(store[0]))
    last = split.train.agg(F.max("fecha_mes")).first()[0]
    assert last <= split.cut < split.valid.agg(F.min("fecha_mes")).first()[0] and not split.in_sample
    one = forecast.train_set(store[0]).filter(F.col("fecha_mes") == "2020-03-01")
    assert forecast.temporal_split(one).in_sample


def test_unseen_category_is_all_zeros(spark, store):
    train = forecast.prepared(forecast.train_set(store[0]))
    coder = Pipeline(stages=forecast.encoder_stages()).fit(train)
    odd = coder.transform(train.limit(1).withColumn("cuenca", F.lit("Marte"))).first()
    assert odd["cuenca_vector"].numNonzeros() == 0 and odd["provincia_vector"].numNonzeros() == 1


def test_columns_without_values_are_left_out(store):
    train = forecast.train_set(store[0]).withColumn("iny_gas_m", F.lit(None).cast("double"))
    model = forecast.fit(train)
    assert forecast.predict(model, train).filter("prediccion is null").count() == 0


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (5.0, 4.0, 4.0)], "prediccion double, label double, baseline double")
    m = forecast.evaluate(df).first()
    assert (m["n_valid"], m["mae"], m["rmse"], m["mae_baseline"], m["skill_score"]) == (2, 1.0, 1.0, 0.5, -1.0)
    assert forecast.gate(m.asDict()) and not forecast.gate(m.asDict(), 0.0)
    perfect = forecast.evaluate(df.withColumn("baseline", F.col("label"))).first()
    assert perfect["skill_score"] == 0.0


def test_persistence(layers):
    found = rows.as_dicts(forecast.naive(layers["feat_produccion_online"]), "idpozo")
    got = {w: (r["prediccion"], str(r["fecha_mes_pred"])) for w, r in found.items()}
    assert got == {"1": (80.0, "2024-03-01"), "2": (300.0, "2024-03-01"), "3": (12.5, "2024-02-01")}


def test_fallback(layers, spark):
    on = layers["feat_produccion_online"]
    scored = forecast.naive(on).filter("idpozo <> '2'").withColumn("prediccion", F.lit(1.0))
    found = rows.as_dicts(forecast.with_fallback(scored, on, max_age_months=0), "idpozo")
    assert {w: (r["strategy"], r["prediccion"]) for w, r in found.items()} == {
        "1": ("model", 1.0), "2": ("persistence", 300.0), "3": ("persistence", 12.5),
    }


def test_train_gate_promote_and_score(spark, store, tmp_path):
    off, on = store
    root = str(tmp_path / "ml")
    assert forecast.production_version(spark, root, "forecast_prod_pet") is None
    first = forecast.train_and_score(off, on, root, "prod_pet", "r1")
    assert first.count() == 8 and first.select("model_version").distinct().first()[0] == "r1"
    both = forecast.train_and_score(off, on, root, "prod_gas", "r2")
    assert {r["target_kind"] for r in both.collect()} == {"prod_pet", "prod_gas"} and both.count() == 16
    with pytest.raises(forecast.GateRejected):
        forecast.train_and_score(off, on, root, "prod_pet", "r3", min_skill=2.0)
    assert forecast.production_version(spark, root, "forecast_prod_pet") == "r1"
    kept = forecast.read_forecast(spark, root).filter("target_kind = 'prod_pet'")
    assert {r["model_version"] for r in kept.collect()} == {"r1"}
    log = rows.as_dicts(forecast.runs(spark, root), "run_id")
    assert {r: v["validation_passed"] for r, v in log.items()} == {"r1": True, "r2": True, "r3": False}
    assert forecast.versions(spark, root).count() == 3
    assert log["r1"]["n_train"] + log["r1"]["n_valid"] == forecast.train_set(off).count()


def test_null_share(layers):
    shares = {r["feature"]: r["null_share"] for r in forecast.null_share(layers["feat_produccion_offline"]).collect()}
    assert shares["prod_pet_lag0"] == 0.0 and shares["prod_pet_lag1"] == pytest.approx(0.6) and shares["prod_pet_lag12"] == 1.0
