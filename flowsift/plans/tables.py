"""Flow-shaped tables made from the test tables; every row of the source takes part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.spec import CATEGORIES, FlowSpec

EV_FEATURES = [
    "flow_duration", "tot_fwd", "tot_bwd", "len_fwd", "len_bwd", "fwd_mean", "bwd_mean",
    "bytes_s", "pkts_s", "len_mean", "fin", "syn", "rst", "ack",
]
EV_KEY = ["user_id", "flow_day", "copy_no"]
EV_SPEC = FlowSpec(
    features=[*EV_FEATURES[:10], "len_std", *EV_FEATURES[10:]],
    groups={
        "flow_duration": ["flow_duration"],
        "packet_counts": ["tot_fwd", "tot_bwd", "len_fwd", "len_bwd"],
        "packet_stats": ["fwd_mean", "bwd_mean", "len_mean", "len_std"],
        "flow_rates": ["bytes_s", "pkts_s"],
        "tcp_flags": ["fin", "syn", "rst", "ack"],
    },
    notes={"flow_duration": "Microseconds", "len_std": "Bytes"},
    categories=CATEGORIES,
    ablations={
        "baseline": ("All features", []),
        "no_flow_rates": ("Without rates", ["flow_rates"]),
        "no_tcp_flags": ("Without flag counts", ["tcp_flags"]),
        "reduced": ("Core features", ["flow_rates", "tcp_flags"]),
    },
    label_col="raw_label",
    original_label_col="original_label",
)
LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_KEY = ["row_key"]
LI_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LI_FEATURES, "l_returnflag",
              "l_linestatus", "l_shipdate"]
# Coefficients of models that are given and not fitted.
GIVEN_FEATURES = ["rst", "len_fwd", "ack"]
GIVEN_PAIRS = {(0, 1): ([0.5, -1.0, 0.25], 0.1), (0, 2): ([-0.75, 0.5, 0.0], -0.2),
               (1, 2): ([1.0, 0.3, -0.6], 0.05)}
# The same for records of a stream: scaling, and pairs over two features.
STREAM_FEATURES = ["k", "amount"]
STREAM_SCALING = ([50.0, 30.0], [25.0, 20.0])
STREAM_PAIRS = {(0, 1): ([0.5, -1.0], 0.125), (0, 2): ([-0.75, 0.5], -0.25), (1, 2): ([1.0, -0.5], 0.0625)}
GIVEN_NORM = 0.8 * 0.8 + 2 * 0.004 * 0.004
SCORE_FEATURES = ["rst", "len_fwd", "len_bwd"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a time-zoned timestamp."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flow per user and day, some of them twice, with infinite and NaN rates and raw labels."""
    e = events(spark, sf_dir)
    kind, amount = F.col("event_type"), F.col("value").cast("decimal(18,2)")
    fwd = kind.isin("click", "purchase", "signup")
    zero = F.lit(0).cast("decimal(18,2)")
    times = F.unix_micros("ts")
    count_of = lambda k: F.count_if(kind == k).cast("double")
    sums = e.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("flow_day")).agg(
        (F.max(times) - F.min(times)).cast("double").alias("flow_duration"),
        F.count_if(fwd).cast("double").alias("tot_fwd"),
        F.count_if(~fwd).cast("double").alias("tot_bwd"),
        F.sum(F.when(fwd, amount).otherwise(zero)).cast("double").alias("len_fwd"),
        F.sum(F.when(~fwd, amount).otherwise(zero)).cast("double").alias("len_bwd"),
        F.sum(amount).cast("double").alias("total"),
        F.count(F.lit(1)).cast("double").alias("n"),
        count_of("purchase").alias("fin"),
        count_of("signup").alias("syn"),
        count_of("error").alias("rst"),
        count_of("click").alias("ack"),
    )
    idle = F.col("flow_duration") == 0
    mean = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    rate = lambda c: F.col(c) * F.lit(1e6) / F.col("flow_duration")
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    label = (
        F.when(F.col("user_id") % 50 == 7, F.lit(None).cast("string"))
        .when(F.col("total") > 400, "DDoS")
        .when(F.col("rst") >= 2, "Bot")
        .when(F.col("user_id") % 11 == 3, " Benign ")
        .otherwise("BENIGN")
    )
    copies = F.sequence(F.lit(0), F.when(F.col("user_id") % 10 == 0, 1).otherwise(0))
    return sums.select(
        "user_id", "flow_day", F.explode(copies).alias("copy_no"),
        "flow_duration", "tot_fwd", "tot_bwd", "len_fwd", "len_bwd",
        mean("len_fwd", "tot_fwd").alias("fwd_mean"), mean("len_bwd", "tot_bwd").alias("bwd_mean"),
        F.when(idle & (F.col("rst") > 0), nan).when(idle, inf).otherwise(rate("total"))
        .alias("bytes_s"),
        F.when(idle, inf).otherwise(rate("n")).alias("pkts_s"),
        (F.col("total") / F.col("n")).alias("len_mean"),
        "fin", "syn", "rst", "ack", label.alias("raw_label"),
    )


#: Raw labels of every kind: each known one as it is and in other writing, unknown and blank ones.
RAW_LABELS = [
    *CATEGORIES, *[f" {x.upper()}\t" for x in CATEGORIES],
    "no such attack", "dos", "xss", "", "  ", "\t",
]


def labelled_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows whose raw labels run through all kinds, by user."""
    flows = event_flows(spark, sf_dir)
    at = (F.col("user_id") % len(RAW_LABELS) + 1).cast("int")
    label = F.element_at(F.array(*[F.lit(x) for x in RAW_LABELS]), at)
    return flows.withColumn("raw_label", F.when(F.col("user_id") % 50 != 7, label))


def fixed_score(cols=None):
    """Linear score of a flow with given weights."""
    c = cols or {f: F.col(f) for f in SCORE_FEATURES}
    return (F.lit(0.8) * c["rst"] + F.lit(0.004) * (c["len_fwd"] + c["len_bwd"])) - F.lit(2.0)


def scored_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with the fixed score, the encoded label y and the prediction p."""
    from flowsift.functions.text import binary_label, encode_label

    flows = event_flows(spark, sf_dir)
    return flows.withColumn("y", encode_label(binary_label(F.col("raw_label")))).withColumn(
        "score", fixed_score()).withColumn("p", (F.col("score") > 0).cast("int"))


def category_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with a true category and a rule-based prediction."""
    from flowsift.functions.text import category_label

    volume = F.col("len_fwd") + F.col("len_bwd")
    called = (
        F.when(volume > 420, "DDoS")
        .when((F.col("rst") >= 2) | (F.col("syn") >= 3), "Bot")
        .otherwise("BENIGN")
    )
    return event_flows(spark, sf_dir).select(
        category_label(F.col("raw_label")).alias("truth"), called.alias("called"))


def lineitem_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a numeric table with a unique row key and a three-class label."""
    li = table(spark, sf_dir, "lineitem")
    cents = (F.col("l_extendedprice") * 100.0 + 0.5).cast("bigint")
    key = F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)
    return li.select(
        key.alias("row_key"), *LI_FEATURES, "l_returnflag",
        F.year("l_shipdate").alias("ship_year"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_records(events(spark, sf_dir))


def as_records(e: DataFrame) -> DataFrame:
    """Events as name -> text records: some lack a feature, some hold no number."""
    k = F.regexp_extract("props", "[0-9]+", 0)
    kind = F.col("event_type")
    amount = F.when(kind == "view", kind).when(kind == "signup", F.lit(None)).otherwise(
        F.col("value").cast("decimal(18,2)").cast("string"))
    full = F.create_map(F.lit("k"), k, F.lit("amount"), amount)
    part = F.create_map(F.lit("k"), k)
    return e.select(
        "event_id", "ts", "event_type", F.when(kind == "error", part).otherwise(full).alias("record"))


def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, near-numbers and junk as text, from the props of every event."""
    k = F.regexp_extract("props", "[0-9]+", 0)
    kind, n = F.col("event_type"), F.col("k").cast("int")
    raw = (
        F.when(kind == "view", F.concat(F.lit("\t"), "k", F.lit(" ")))
        .when(kind == "click", F.concat("k", F.lit(".5d")))
        .when(kind == "purchase", F.concat(F.lit("-"), "k", F.lit("e1")))
        .when(kind == "error", F.col("props"))
        .when(n < 30, "Infinity").when(n < 60, "NaN").when(n < 80, "-inf").otherwise("")
    )
    return events(spark, sf_dir).withColumn("k", k).select("event_id", raw.alias("raw"))
