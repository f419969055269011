"""Per-feature statistics, exact quantiles, distribution comparison, perturbation."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.functions.numeric import display, percent_of
from flowsift.functions.order import gaussian, order_hash
from flowsift.operators.small import pin_small, unpivot_row
from flowsift.spec import SEED

QUARTILES = (0.25, 0.5, 0.75)
ACCURACY = 10_000  # rank error of the sketch is below rows / ACCURACY
FINE = 2_000_000  # values per feature and quantile that one window task may order


def _moments(features: list[str]) -> list[Column]:
    fns = {
        "n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
        "skew": F.skewness, "kurt": F.kurtosis,
    }
    out = [
        fn(f"`{f}`").alias(f"{k}{i}") for i, f in enumerate(features) for k, fn in fns.items()
    ]
    missing = [F.count_if(F.col(f"`{f}`").isNull()).alias(f"missing{i}")
               for i, f in enumerate(features)]
    return out + missing


def feature_statistics(
    df: DataFrame, features: list[str], digits: int | None = None, exact: bool = True
) -> DataFrame:
    """Mean, std, min, quartiles, max, skewness, kurtosis and missing count per feature.

    Skewness and kurtosis carry the small-sample correction. One aggregate for
    the moments; quartiles exact, or from the sketch with exact=False.
    """
    names = ["n", "mean", "std", "min", "max", "skew", "kurt", "missing"]
    row, known = pin_small(df.agg(*_moments(features)))
    wide = {k: [F.col(f"{k}{i}") for i in range(len(features))] for k in names}
    base = unpivot_row(row, wide, features)
    n = F.col("n").cast("double")
    constant = F.col("min") == F.col("max")
    skew = F.when(n > 2, F.when(constant, 0.0).otherwise(
        F.col("skew") * F.sqrt(n * (n - 1.0)) / (n - 2.0)))
    kurt = F.when(n > 3, F.when(constant, 0.0).otherwise(
        (n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1.0) * F.col("kurt") + 6.0)))
    if exact:
        ranges = [tuple(known[0][f"{k}{i}"] for k in ("n", "min", "max"))
                  for i in range(len(features))]
        quantiles = exact_quantiles(df, features, QUARTILES, ranges)
    else:
        approx = df.agg(*[
            F.percentile_approx(f"`{f}`", list(QUARTILES), ACCURACY).alias(f"q{i}")
            for i, f in enumerate(features)
        ])
        cols = {f"q_{j}": [F.col(f"q{i}")[j] for i in range(len(features))] for j in range(3)}
        quantiles = unpivot_row(approx, cols, features).withColumnRenamed("name", "feature")
    shown = {
        "mean": F.col("mean"), "std": F.col("std"), "min": F.col("min"),
        "q25": F.col("q_0"), "median": F.col("q_1"), "q75": F.col("q_2"), "max": F.col("max"),
        "skewness": skew, "kurtosis": kurt,
    }
    return base.withColumnRenamed("name", "feature").join(quantiles, "feature", "left").select(
        "feature", *[display(c, digits).alias(k) for k, c in shown.items()], "missing"
    )


def exact_quantiles(
    df: DataFrame, features: list[str], qs=QUARTILES, ranges: list[tuple] | None = None
) -> DataFrame:
    """Linear-interpolated quantiles, one row per feature with columns q_0, q_1, ...

    The exact percentile aggregate keeps all distinct values of a feature in one
    task. Here a quantile sketch gives an interval that holds the wanted ranks,
    rows below it are counted and only the values inside are grouped and ordered.
    The interval is narrowed again while it holds too many values. `ranges` are
    (count, min, max) per feature where they are known already. Features hold no NaN.
    """
    spark = df.sparkSession
    col = [F.col(f"`{f}`") for f in features]
    if ranges is None:
        row = df.agg(*[fn(c) for c in col for fn in (F.count, F.min, F.max)]).first()
        ranges = [tuple(row[3 * i : 3 * i + 3]) for i in range(len(features))]
    # (feature, quantile) -> interval, rows below and inside, and the two ranks
    spans = {}
    for i, (n, lo, hi) in enumerate(ranges):
        for j, q in enumerate(qs):
            if n:
                pos = q * (n - 1)
                spans[i, j] = {
                    "lo": lo, "hi": hi, "below": 0, "inside": n, "part": pos - math.floor(pos),
                    "first": math.floor(pos) + 1, "last": math.ceil(pos) + 1, "slack": 1.0,
                }
    if not spans:
        empty = ", ".join(f"q_{j} double" for j in range(len(qs)))
        return spark.createDataFrame([], f"feature string, {empty}")

    def within(i: int, lo: float, hi: float) -> Column:
        return (col[i] >= F.lit(lo)) & (col[i] <= F.lit(hi))

    todo = {ij for ij, s in spans.items() if s["lo"] < s["hi"]}
    while todo:
        # Quantiles of a feature with the same interval share a sketch.
        shared: dict[tuple, list] = {}
        for i, j in sorted(todo):
            shared.setdefault((i, spans[i, j]["lo"], spans[i, j]["hi"]), []).append((i, j))
        order = [ij for ijs in shared.values() for ij in ijs]
        sketches = df.agg(*[
            _sketch(F.when(within(*key), col[key[0]]), [q for ij in ijs for q in _around(spans[ij])])
            for key, ijs in shared.items()
        ]).first()
        flat = [v for values in sketches for v in values]
        ends = list(zip(flat[::2], flat[1::2]))
        counts = df.agg(*[
            F.count_if(c) for (i, j), (lo, hi) in zip(order, ends)
            for c in (col[i] < F.lit(lo), within(i, lo, hi))
        ]).first()
        for k, ij in enumerate(order):
            s, (lo, hi), (below, inside) = spans[ij], ends[k], counts[2 * k : 2 * k + 2]
            fits = below < s["first"] and s["last"] <= below + inside
            if not fits and 2.0 * s["slack"] < ACCURACY:  # the sketch was off: ask for more
                s["slack"] *= 8.0
                continue
            narrower = fits and inside < s["inside"]
            if narrower:
                s.update(lo=lo, hi=hi, below=below, inside=inside)
            # Nothing gained: few values, very often. Grouping makes them few rows.
            if not narrower or inside <= FINE or lo == hi:
                todo.discard(ij)
    rows = [(i, j, s["below"], s["first"], s["last"], s["part"]) for (i, j), s in spans.items()]
    table = F.broadcast(spark.createDataFrame(  # one row per feature and quantile
        rows, "i int, j int, below bigint, first bigint, last bigint, part double"))
    single = [(i, j, s["lo"], s["inside"]) for (i, j), s in spans.items() if s["lo"] == s["hi"]]
    values = spark.createDataFrame(single, "i int, j int, v double, n bigint")
    wide = {ij: s for ij, s in spans.items() if s["lo"] < s["hi"]}
    if wide:
        held = {ij: within(ij[0], s["lo"], s["hi"]) for ij, s in wide.items()}
        cells = F.array_compact(F.array(*[
            F.when(c, F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                               col[i].cast("double").alias("v")))
            for (i, j), c in held.items()
        ]))
        found = df.select(F.explode(F.when(reduce(or_, held.values()), cells)).alias("x"))
        values = values.unionByName(
            found.groupBy("x.i", "x.j", "x.v").agg(F.count(F.lit(1)).alias("n")))
    upto = F.sum("n").over(Window.partitionBy("i", "j").orderBy("v"))
    ranked = values.withColumn("upto", upto).join(table, ["i", "j"])
    end = F.col("below") + F.col("upto")
    start = end - F.col("n")
    at = lambda rank: F.max(F.when(
        (start < F.col(rank)) & (F.col(rank) <= end), F.col("v")))
    ends = ranked.groupBy("i", "j").agg(
        at("first").alias("a"), at("last").alias("b"), F.max("part").alias("part"))
    value = F.col("a") + (F.col("b") - F.col("a")) * F.col("part")
    names = F.array(*[F.lit(f) for f in features])
    named = ends.withColumn("feature", F.element_at(names, F.col("i") + 1))
    return named.groupBy("feature").agg(*[
        F.max(F.when(F.col("j") == j, value)).alias(f"q_{j}") for j in range(len(qs))
    ])


def _around(s: dict) -> list[float]:
    """Shares of the rows inside that enclose both ranks, sketch error and rounding included."""
    slack = s["slack"] * (2.0 / ACCURACY + 2.0 / s["inside"])
    return [max(0.0, (s["first"] - s["below"]) / s["inside"] - slack),
            min(1.0, (s["last"] - s["below"]) / s["inside"] + slack)]


def _sketch(c: Column, qs: list[float]) -> Column:
    return F.percentile_approx(c, qs, ACCURACY)


def distribution_comparison(
    train: DataFrame, other: DataFrame, features: list[str], digits: tuple[int, int] | None = None
) -> DataFrame:
    """Mean and std of two tables per feature and their change in percent of the train std."""
    cols = [F.col(f"`{f}`") for f in features]
    both = train.select(F.lit(0).alias("_side"), *cols).unionByName(
        other.select(F.lit(1).alias("_side"), *cols))
    return compare_sides(both, F.col("_side") == 0, F.col("_side") == 1, features, digits)


def compare_sides(
    df: DataFrame, is_train: Column, is_other: Column, features: list[str],
    digits: tuple[int, int] | None = None,
) -> DataFrame:
    """distribution_comparison for two parts of one table, in one aggregate."""
    aggs = []
    for i, f in enumerate(features):
        for side, cond in (("t", is_train), ("o", is_other)):
            c = F.when(cond, F.col(f"`{f}`"))
            aggs += [F.avg(c).alias(f"{side}m{i}"), F.stddev_samp(c).alias(f"{side}s{i}")]
    k = range(len(features))
    row = unpivot_row(df.agg(*aggs), {
        "train_mean": [F.col(f"tm{i}") for i in k], "shifted_mean": [F.col(f"om{i}") for i in k],
        "train_std": [F.col(f"ts{i}") for i in k], "shifted_std": [F.col(f"os{i}") for i in k],
    }, features)
    value, pct = digits or (None, None)
    change = lambda what: percent_of(
        F.abs(F.col(f"shifted_{what}") - F.col(f"train_{what}")), F.col("train_std"))
    return row.select(
        F.col("name").alias("feature"),
        *[display(F.col(c), value).alias(c) for c in ("train_mean", "shifted_mean")],
        display(change("mean"), pct).alias("mean_change_pct"),
        *[display(F.col(c), value).alias(c) for c in ("train_std", "shifted_std")],
        display(change("std"), pct).alias("std_change_pct"),
    )


def shifted_features(features: list[str], seed: int = SEED) -> list[str]:
    """The third of the features (one at least) that a seed picks."""
    import hashlib

    picked = sorted(features, key=lambda f: hashlib.md5(f"{seed}|{f}".encode()).hexdigest())
    return picked[: max(1, len(features) // 3)]


def perturb_columns(
    df: DataFrame, features: list[str], key: list[str], magnitude: float = 1.5, seed: int = SEED
) -> DataFrame:
    """Add seeded Gaussian noise of scale std * (magnitude - 1) to a third of the features."""
    if magnitude < 1:
        raise ValueError("magnitude must be at least 1")
    picked = shifted_features(features, seed)
    std = df.agg(*[F.stddev_samp(f"`{f}`") for f in picked]).first()
    noisy = {}
    for f, s in zip(picked, std):
        if s is not None and s > 0:
            h = order_hash(f"{seed}|{f}", *[F.col(f"`{c}`") for c in key])
            noisy[f] = F.col(f"`{f}`") + gaussian(h) * F.lit(s * (magnitude - 1.0))
    return df.withColumns(noisy) if noisy else df


def covariance_matrix(df: DataFrame, features: list[str]) -> DataFrame:
    """Sample covariance of every feature pair, one aggregate, long form."""
    pairs = [(i, j) for i in range(len(features)) for j in range(i, len(features))]
    row = df.agg(*[
        F.covar_samp(f"`{features[i]}`", f"`{features[j]}`").alias(f"c{i}_{j}") for i, j in pairs
    ])
    cells = [
        F.struct(F.lit(features[i]).alias("feature_a"), F.lit(features[j]).alias("feature_b"),
                 F.col(f"c{min(i, j)}_{max(i, j)}").alias("covariance"))
        for i in range(len(features)) for j in range(len(features))
    ]
    return row.select(F.inline(F.array(*cells)))
