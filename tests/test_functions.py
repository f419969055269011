import math

import pytest
from pyspark.sql import functions as F

from flowsift.functions import numeric, order, text
from flowsift.operators.clean import coerce_features
from flowsift.operators.scoring import usable_features
from flowsift.spec import DEFAULT_SPEC


def values(spark, rows, expr, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(expr).collect()]


def test_binary_label(spark):
    benign = ["bEnIgN", "\u2003benign\n", None, "\x0b", "mostly benign, some noise", "unbenignly"]
    attack = [*(c for c in DEFAULT_SPEC.categories if c != "benign"), "-", "0", "be nign", "scan of hosts"]
    got = values(spark, benign + attack, text.binary_label(F.col("x")))
    assert got == ["BENIGN"] * len(benign) + ["ATTACK"] * len(attack)


def test_category_label(spark):
    cases = {f"\t{raw.title()} ": kind for raw, kind in DEFAULT_SPEC.categories.items()}
    cases |= {"ddos ddos": "Other", "hulk": "Other", "\u3000": "Other", None: "BENIGN",
              "web attack \u0097 xss": "Other"}
    assert values(spark, cases, text.category_label(F.col("x"))) == list(cases.values())


def test_label_codes(spark):
    got = values(spark, ["BENIGN", "ATTACK", "x", None], text.encode_label(F.col("x")))
    assert got == [0, 1, None, None]


def test_strip_takes_every_unicode_space(spark):
    spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    assert values(spark, [f"{spaces}a b{spaces}"], text.strip(F.col("x"))) == ["a b"]
    assert set(text.SPACES) == set(spaces)


def test_to_number(spark):
    cases = {
        "1": 1.0, " 2.5\t": 2.5, " 3e2 ": 300.0, "-.5": -0.5, "7.": 7.0, "1.5d": None,
        "1f": None, "abc": None, "": None, "NaN": None, "0x10": None, "1_000": None, None: None,
        "Infinity": math.inf, "-inf": -math.inf, "+INF": math.inf, "1e400": math.inf,
    }
    assert values(spark, cases, numeric.to_number(F.col("x"))) == list(cases.values())


def test_to_number_strips_what_a_pattern_lets_pass(spark):
    cases = {"5\n": 5.0, "5\u0085": 5.0, "\u20285": 5.0, "\u3000-inf\xa0": -math.inf, "5\n6": None, "5 d\n": None}
    assert values(spark, cases, numeric.to_number(F.col("x"))) == list(cases.values())


def test_texts_of_a_row_are_read_by_one_function(spark):
    names = [f"f {i}" for i in range(14)] + ["n"]
    row = [" 1 ", "x", None, "inf", "nan", *["2.5"] * 9, 7]
    df = spark.createDataFrame([tuple(row)], ", ".join(f"`{c}` string" for c in names[:-1]) + ", n int")
    want = [1.0, None, None, math.inf, None, *[2.5] * 9, 7.0]
    for ready, infinite in ((coerce_features(df, names).drop("_bad_text"), math.inf), (usable_features(df, names), None)):
        assert ready.columns == names
        assert list(ready.first()) == [infinite if v == math.inf else v for v in want]
        assert ready._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 2


def test_is_number_text(spark):
    got = values(spark, ["nan", "1.0", "-inf", "x", ""], numeric.is_number_text(F.col("x")))
    assert got == [True, True, True, False, False]


def test_finite_and_infinite(spark):
    rows = [1.0, math.inf, -math.inf, math.nan, None]
    assert values(spark, rows, numeric.finite(F.col("x")), "x double") == [1.0] + [None] * 4
    assert values(spark, rows, numeric.is_infinite(F.col("x")), "x double") == [
        False, True, True, False, False]


def test_ratio_of_zero(spark):
    rows = values(spark, [0.0, 2.0], numeric.ratio(F.lit(1.0), F.col("x")), "x double")
    assert rows == [0.0, 0.5]


def test_threshold_grid():
    grid = numeric.threshold_grid()
    assert len(grid) == 61 and grid[0] == -3.0 and grid[30] == 0.0 and grid[-1] == 3.0
    assert grid == [round((i - 30) / 10, 4) for i in range(61)]


def test_gaussian_noise_is_normal(spark):
    z = order.gaussian(order.order_hash(1, F.col("id")))
    row = spark.range(20000).select(z.alias("z")).agg(
        F.avg("z"), F.stddev_pop("z"), F.kurtosis("z")).first()
    assert row[0] == pytest.approx(0, abs=0.03)
    assert row[1] == pytest.approx(1, abs=0.03)
    assert row[2] == pytest.approx(0, abs=0.15)


def test_feature_groups():
    spec = DEFAULT_SPEC
    assert len(spec.features) == 15
    assert len(spec.without_groups([])) == 15
    assert len(spec.without_groups(["flow_rates"])) == 13
    assert len(spec.without_groups(["tcp_flags", "no_such_group"])) == 11
    left = spec.without_groups(["flow_rates", "tcp_flags"])
    assert len(left) == 9 and left == [f for f in spec.features if f in left]
