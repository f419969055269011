"""Quality rules as learned decision lists.

Statistics of every text are built-in Spark expressions. From those of labelled documents,
sequential covering learns an ordered list of conjunctions of thresholds: a rule grows by the
condition with the largest information gain on two thirds of the labelled rows, is cut back to the
prefix that does best on the other third, and is kept if it is precise enough there; the rows it
covers are taken out before the next. Each step is one small aggregate over binned statistics. The
list becomes one conditional expression.

Cases: a null text counts as empty; an empty text has no words and fails the base; texts of any
length are read whole; repeated rows are judged alike; repeated labels count once, the worse one
wins, and null labels are left out; without labelled rows of both kinds there is no rule and the
base decides; an empty table gives an empty table; other columns of the input are left out of the
statistics.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.llm.scratch import drop, land

BLANKS = r"[\x20\x09-\x0D]+"
VISIBLE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
RUN = 8  # words in a window that counts as repeated

#: Labelled rows that rules are learned from, at most; chosen by a hash of the id.
LABELLED = 20_000
BINS = 24
MAX_CONDITIONS = 4
MAX_RULES = 10
PRECISION = 0.97
LEAST_COVERED = 3


#: Statistics that rules may use: a count, or a count per another.
FEATURES = {
    "words": ("n_words", None),
    "mean_word": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "mark_share": ("n_marks", "word_chars"),
    "distinct_share": ("n_distinct", "n_words"),
}


def feature(name: str) -> Column:
    part, whole = FEATURES[name]
    if whole is None:
        return F.col(part).cast("double")
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _sorted_windows() -> Column:
    return F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))


def _starts_of_repeats() -> Column:
    """Starts of windows that occur twice or more: equal windows are neighbours once sorted."""
    p, n = F.col("pairs"), F.size("pairs")
    twice = F.filter(F.sequence(F.lit(0), n - 1), lambda k: (
        (k > 0) & (p[F.greatest(k - 1, F.lit(0))]["x"] == p[k]["x"])
        | (k < n - 1) & (p[F.least(k + 1, n - 1)]["x"] == p[k]["x"])))
    return F.sort_array(F.transform(twice, lambda k: p[k]["i"]))


def _covered() -> Column:
    """Words that windows of RUN words cover together, from their sorted starts."""
    s = F.col("starts")
    return RUN + F.aggregate(F.sequence(F.lit(1), F.size(s) - 1), F.lit(0),
                             lambda acc, k: acc + F.least(F.lit(RUN), s[k] - s[k - 1]))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns in keep, and counts of each text: n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words, n_upper, n_digits, n_marks, n_distinct (long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = ["doc_id", *keep]
    # A column that later steps use more than once is computed once; Spark does not inline it.
    words = docs.select(*kept, text.alias("text")).select(
        *kept, "text",
        F.array_remove(F.split("text", BLANKS), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(VISIBLE)).alias("lines"))
    hashed = words.select(
        *kept,
        F.size("words").alias("n_words"),
        F.char_length(F.array_join("words", "")).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).alias("n_symbols"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("n_upper"),
        F.regexp_count("text", F.lit("[0-9]")).alias("n_digits"),
        F.regexp_count("text", F.lit("[!?]")).alias("n_marks"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    h = F.col("hashes")
    runs = hashed.withColumn("n_distinct", F.size(F.array_distinct("hashes"))).withColumn(
        "windows",
        F.when(F.size(h) > RUN, F.transform(
            F.sequence(F.lit(0), F.size(h) - RUN),
            lambda i: F.xxhash64(*[h[i + k] for k in range(RUN)]))).otherwise(F.array().cast("array<bigint>")))
    repeated = runs.withColumn("pairs", F.when(
        F.size("windows") > F.size(F.array_distinct("windows")), _sorted_windows()))
    repeated = repeated.withColumn("starts", F.when(F.col("pairs").isNotNull(), _starts_of_repeats()))
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_upper", "n_digits",
              "n_marks", "n_distinct"]
    covered = F.when(F.col("starts").isNull(), 0).otherwise(_covered())
    return repeated.select(*kept, *[F.col(c).cast("long") for c in counts],
                           covered.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def labelled(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """Statistics of at most `most` labelled documents, `bad` and whether a row is for growing.
    The chosen ids are at most `most`, so they are broadcast to the scan of the texts."""
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        "doc_id").agg((F.min("quality") == 0).alias("bad"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    grow = (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) > 0).alias("grow")
    return where_true(statistics(own, "bad"), ~base_failed()).select(
        "bad", grow, *[feature(f).alias(f) for f in FEATURES])


def where_true(rows: DataFrame, condition: Column) -> DataFrame:
    """A filter that stays above the statistics. Spark pushes a plain filter below them and writes
    their expressions into it, each as often as it is used, down to the split of the text."""
    once = F.explode(F.when(condition, F.array(F.lit(True))))
    return rows.select("*", once.alias("__met")).drop("__met")


def learn(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> list[Rule]:
    """Ordered rules that reject; each was precise on rows it did not grow from."""
    rows = land(labelled(docs, labels, most), "labelled")
    cuts = _cuts(rows)
    bins = [_bin(f, cuts[f]).alias(f) for f in cuts]
    # At most `most` rows: one partition, so that the many small aggregates need no exchange.
    binned = land(rows.select("bad", "grow", *bins).coalesce(1), "binned") if cuts else None
    rules: list[Rule] = []
    free = F.lit(True)
    while binned is not None and len(rules) < MAX_RULES:
        left = binned.where(free)
        grown = _grow(left.where("grow"), cuts)
        rule = _prune(left.where("not grow"), grown) if grown else []
        if not rule:
            break
        rules.append(tuple(Condition(f, up, float(cuts[f][k - 1])) for f, up, k in rule))
        free = free & ~_all(_binned(c) for c in rule)
    drop(rows, *([binned] if binned is not None else []))
    return rules


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Thresholds to choose from: quantiles of each kind's rows, without the least value."""
    share = [i / BINS for i in range(1, BINS)]
    got = rows.agg(*[
        F.percentile_approx(F.when(F.col("bad") if bad else ~F.col("bad"), F.col(f)), share, 10_000)
        .alias(f"{f}_{bad}") for f in FEATURES for bad in (0, 1)]).first()
    out = {f: sorted({*(got[f"{f}_0"] or ()), *(got[f"{f}_1"] or ())}) for f in FEATURES}
    return {f: v for f, v in out.items() if v} if got["words_0"] and got["words_1"] else {}


def _bin(name: str, thresholds: list[float]) -> Column:
    """How many of the thresholds a value reaches."""
    array = F.array(*[F.lit(float(t)) for t in thresholds])
    return F.size(F.filter(array, lambda t: t <= F.col(name))).cast("int")


def _binned(condition: tuple[str, bool, int]) -> Column:
    f, up, k = condition
    return F.col(f) >= k if up else F.col(f) < k


def _grow(rows: DataFrame, cuts: dict) -> list[tuple[str, bool, int]]:
    rule: list[tuple[str, bool, int]] = []
    for _ in range(MAX_CONDITIONS):
        pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in cuts])
        table = rows.where(_all(map(_binned, rule))).select("bad", F.inline(pairs)).groupBy("f", "bin").agg(
            F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
        per = {f: {r["bin"]: (r["p"], r["n"]) for r in table if r["f"] == f} for f in cuts}
        p0, n0 = (sum(v[i] for v in next(iter(per.values())).values()) for i in (0, 1))
        if p0 < LEAST_COVERED or not n0:
            break
        best = (1e-9, None)
        for f in cuts:
            for k in range(1, len(cuts[f]) + 1):
                p = sum(v[0] for b, v in per[f].items() if b >= k)
                n = sum(v[1] for b, v in per[f].items() if b >= k)
                for up, (q, m) in ((True, (p, n)), (False, (p0 - p, n0 - n))):
                    if q >= LEAST_COVERED:
                        best = max(best, (_gain(q, m, p0, n0), (f, up, k)), key=lambda b: b[0])
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def _prune(rows: DataFrame, rule: list[tuple[str, bool, int]]) -> list[tuple[str, bool, int]]:
    """The prefix of the rule with the best balance on rows it did not grow from, or nothing."""
    met, held = F.lit(0), F.lit(True)
    for c in rule:
        held = held & _binned(c)
        met = met + held.cast("int")
    table = rows.groupBy(met.alias("met")).agg(
        F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
    best = (0.0, 0)
    for k in range(1, len(rule) + 1):
        p = sum(r["p"] for r in table if r["met"] >= k)
        n = sum(r["n"] for r in table if r["met"] >= k)
        if p >= LEAST_COVERED and p >= PRECISION * (p + n):
            best = max(best, ((p - n) / (p + n) * math.log1p(p), k))
    return rule[:best[1]]


def verdict(rules: list[Rule]) -> Column:
    """The first rule that a row meets, as text; null if none. One conditional expression."""
    out = None
    for rule in rules:
        hit, name = _all(c.column() for c in rule), F.lit(" and ".join(map(str, rule)))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(None).cast("string") if out is None else out


def judge(docs: DataFrame, rules: list[Rule], *keep: str) -> DataFrame:
    """Statistics of every document with base_failed, rule and kept."""
    return statistics(docs, *keep).withColumn("base_failed", base_failed()).withColumn(
        "rule", F.when(~F.col("base_failed"), verdict(rules))).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns as they are."""
    rules = learn(docs, labels)
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    return where_true(judge(packed, rules, "row"), F.col("kept")).select("row.*")
