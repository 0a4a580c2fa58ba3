import math

import pytest
from pyspark.sql import functions as F

from txrisk.functions.scores import probability_array, probability_text, probability_vector, score_of
from txrisk.functions.stats import required_n, student_t_two_sided, two_sided_p


@pytest.mark.parametrize(
    "t,df,p",
    [
        (2.228139, 10, 0.05),
        (12.706205, 1, 0.05),
        (1.959964, 10**9, 0.05),
        (0.0, 5, 1.0),
        (1.0, 1, 0.5),
        (3.169273, 10, 0.01),
        (-2.228139, 10, 0.05),
    ],
)
def test_student_t(t, df, p):
    assert student_t_two_sided(t, df) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("df", [1e3, 1e5, 1e6, 1e9, 1e12])
@pytest.mark.parametrize("t", [1e-3, 0.5, 1.0, 2.0, 5.0, 10.0])
def test_student_t_with_many_degrees(t, df):
    """Against the normal tail with its correction in 1 / df."""
    normal = math.erfc(t / math.sqrt(2))
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    expected = normal + 2 * density * (t**3 + t) / (4 * df)
    slack = 2 * density * (3 * t**7 + 5 * t**5 + 7 * t**3 + 3 * t) / (32 * df * df)
    assert student_t_two_sided(t, df) == pytest.approx(expected, rel=1e-10, abs=2 * slack)


@pytest.mark.parametrize("t", [1e-6, 0.1, 1.0, 12.0, 1e4])
def test_student_t_in_closed_form(t):
    assert student_t_two_sided(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-9)
    assert student_t_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-6)


def test_student_t_of_nothing():
    assert math.isnan(student_t_two_sided(float("nan"), 5))
    assert student_t_two_sided(float("inf"), 5) == 0.0


def test_p_column(spark):
    df = spark.createDataFrame([(2.228139, 10.0), (None, 10.0)], "t DOUBLE, df DOUBLE")
    got = [r[0] for r in df.select(two_sided_p(F.col("t"), F.col("df"))).collect()]
    assert got[0] == pytest.approx(0.05, abs=1e-6)
    assert got[1] is None or math.isnan(got[1])


def test_required_n(spark):
    df = spark.createDataFrame([(0.90, 0.92), (0.95, 0.96), (0.5, 0.5), (None, 0.5)], "a DOUBLE, b DOUBLE")
    got = [r[0] for r in df.select(required_n(F.col("a"), F.col("b"))).collect()]
    assert got == [3532, 7457, None, None]


def test_scores(spark):
    df = spark.createDataFrame([(1.0, [0.25, 0.75]), (0.0, [0.9, 0.1])], "prediction DOUBLE, probability ARRAY<DOUBLE>")
    text = df.withColumn("probability", probability_text(df))
    assert text.first()["probability"] == "[0.25,0.75]"
    vector = text.withColumn("probability", probability_vector(text))
    assert vector.select(probability_array(vector)).first()[0] == [0.25, 0.75]
    for form in (df, text, vector):
        assert [r[0] for r in form.select(score_of(form)).collect()] == [0.75, 0.1]
        # The class that was not predicted.
        odd = [r[0] for r in form.select(score_of(form, "unpredicted")).collect()]
        assert odd == [pytest.approx(0.25), pytest.approx(0.1, abs=1e-7)]
    with pytest.raises(ValueError):
        score_of(df, "other")
