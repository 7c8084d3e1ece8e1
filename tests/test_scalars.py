import math

import pytest
from pyspark.sql import functions as F

from tallyflow.functions import dates, mapping, maths, scoring, text
from tallyflow.operators.priors import _psi, fit_beta


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_empty_and_bad_timestamps(spark):
    assert one(spark, dates.date_text(F.lit(""))) == ""
    assert one(spark, dates.epoch_millis(F.lit("soon"))) is None
    assert one(spark, dates.epoch_millis(F.lit("1970-01-01 00:00:02.9"))) == 2000
    assert one(spark, dates.weekday_and_hour(F.lit("2024-01-01 05:00:00"))[0]) == 0


def test_horizon_label_rounds_half_even(spark):
    # 76 / 30.4 = 2.5 rounds to 2
    assert one(spark, dates.horizon_label(F.lit(76), 3)) == 1
    assert one(spark, dates.horizon_label(F.lit(76), 2)) == 0


def test_strict_bool_raises(spark):
    assert one(spark, text.to_bool(F.lit("TRUE"))) is True
    with pytest.raises(Exception, match="not a boolean"):
        one(spark, text.to_bool(F.lit("yes")))


def test_names_and_tokens(spark):
    assert one(spark, text.normal_name(F.lit("Food &amp; Drink_y_More"))) == "food_and_drink_and_more"
    found = one(spark, text.tokens(F.lit("Hi @bob :) see #x_1 http://a.b/c 1,000.5 don't!"), lowercase=True))
    assert found == ["hi", "@bob", ":)", "see", "#x_1", "http://a.b/c", "1,000.5", "don't", "!"]


def test_stop_words_leave_before_punctuation(spark):
    assert one(spark, text.clean_description(F.lit("The cat, don't, and  a DOG"))) == "cat don t dog"


def test_day_bins_and_maps(spark):
    days = [-1.0, 6.0, 349.9, 350.0, None]
    rows = spark.createDataFrame([(d,) for d in days], "d double").select(mapping.day_bin(F.col("d"))).collect()
    assert [r[0] for r in rows] == ["a", "b", "l", "m", None]
    assert one(spark, mapping.midpoint(F.lit("15+"), mapping.RESIDENCE_YEARS)) == 25.0
    assert one(spark, mapping.midpoint(F.lit("?"), mapping.AGE)) is None


def test_binomial_likelihood_small_large_and_edges(spark):
    for theta, n, x in ((0.3, 10, 4), (0.5, 200, 90), (0.0, 5, 0), (1.0, 5, 5), (0.0, 5, 1)):
        want = math.comb(n, x) * theta**x * (1 - theta) ** (n - x)
        got = one(spark, maths.binomial_likelihood(F.lit(theta), F.lit(n), F.lit(x)))
        assert got == pytest.approx(want, rel=1e-9, abs=1e-15)


def test_digamma_column_matches_numpy(spark):
    import numpy as np

    for x in (0.01, 0.5, 3.0, 250.0):
        assert one(spark, maths.digamma(F.lit(x))) == pytest.approx(float(_psi(np.array(x))), rel=1e-10)


def test_scores(spark):
    score = lambda event, action=None, feedback=None: one(
        spark,
        scoring.event_score(
            F.lit(event), F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("double"),
            F.lit(action).cast("string"), F.lit(feedback).cast("boolean"), F.lit(None).cast("array<string>"),
        ),
    )
    assert score("ContentItem_View") == 1.0
    # the feedback action without a value falls through to the ignored actions
    assert score("contentitem_click", "feedbackmodule") == 0.0
    assert score("contentitem_click", "feedbackmodule", False) == -15.0
    assert score("contentitem_click", "share") == 1.0
    assert score("timeline_onboardingmessage_click") == -75.0
    assert one(spark, scoring.reading_score(F.lit(2.0), F.lit(120.0))) == 0.0
    assert one(spark, scoring.reading_score(F.lit(500.0), F.lit(120.0))) == 10.0


def test_fit_beta_recovers_the_rate():
    import numpy as np

    rng = np.random.default_rng(1)
    p = rng.beta(4, 12, 400)
    n = np.full(400, 300.0)
    a, b, steps = fit_beta(n, rng.binomial(300, p).astype(float))
    assert a / (a + b) == pytest.approx(0.25, abs=0.02)
    assert 1 < steps <= 901
