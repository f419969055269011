"""Labels, de-duplication, cleaning and the data-quality report."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from flowsift.functions.numeric import INF, display, is_infinite, ratio, with_numbers
from flowsift.functions.text import binary_label, category_label, na_to_null
from flowsift.sources.observed import write_observed
from flowsift.spec import ATTACK, BENIGN, DEFAULT_SPEC, FlowSpec

BAD_TEXT = "_bad_text"
COPIES = "copies"
USABLE = "usable"


def label_flows(df: DataFrame, spec: FlowSpec = DEFAULT_SPEC) -> DataFrame:
    """Keep the raw label beside the binary one. Non-text labels count as BENIGN."""
    raw = F.col(f"`{spec.label_col}`")
    is_text = isinstance(df.schema[spec.label_col].dataType, StringType)
    label = binary_label(raw) if is_text else F.lit(BENIGN)
    return df.withColumns({spec.original_label_col: raw, spec.label_col: label})


def add_category(df: DataFrame, out: str, spec: FlowSpec = DEFAULT_SPEC) -> DataFrame:
    """Multiclass label from the raw label."""
    return df.withColumn(out, category_label(F.col(f"`{spec.original_label_col}`"), spec))


def coerce_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Features as doubles, anything unreadable and NaN as NULL; infinities stay.

    Unreadable texts are kept in one side column, so that de-duplication tells
    a row with a bad text from a row with a missing value.
    """
    text = [f for f in features if isinstance(df.schema[f].dataType, StringType)]
    read, numbers, side = with_numbers(df, features)
    bad = [
        F.when(numbers[f].isNull() & na_to_null(F.col(f"`{f}`")).isNotNull(),
               F.concat(F.lit(f"{f}="), F.col(f"`{f}`")))
        for f in text
    ]
    kept = F.concat_ws("\n", *bad) if bad else F.lit("")
    return read.withColumns({**numbers, BAD_TEXT: kept}).drop(side)


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    groups = df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def dedupe_first(
    df: DataFrame, keys: list[str], order: list[str], keep: list[str]
) -> DataFrame:
    """First row of every key in the given order, with its number of copies.

    An aggregate and no window: copies are combined before the shuffle, so one
    key with a large part of all rows is no hot task.
    """
    first = F.min_by(F.struct(*_cols(keep)), F.struct(*_cols(order)))
    grouped = df.groupBy(*_cols(keys)).agg(first.alias("_first"), F.count(F.lit(1)).alias(COPIES))
    return grouped.select(
        *_cols(keys), *[F.col("_first").getField(k).alias(k) for k in keep], COPIES
    )


def drop_unusable(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows with a missing or infinite feature go."""
    return df.where(_usable(features))


def clean_flows(
    df: DataFrame, features: list[str], order: list[str], spec: FlowSpec = DEFAULT_SPEC
) -> DataFrame:
    """Labelled, de-duplicated rows before the last drop, as the report needs them.

    `order` says which copy comes first; the survivor keeps these columns, which
    make a row key for sampling. Follow with drop_unusable for the cleaned table,
    or with clean_report.
    """
    keys = [*features, BAD_TEXT, spec.label_col]
    coerced = coerce_features(label_flows(df, spec), features)
    return dedupe_first(coerced, keys, order, [spec.original_label_col, *order]).drop(BAD_TEXT)


def _usable(features: list[str]) -> Column:
    # One plain comparison per feature. NULL and NaN do not pass it either. The
    # optimizer derives constraints from filters, and one expression over all
    # features at once has too many equivalent forms.
    return reduce(and_, [F.abs(F.col(f"`{f}`")) < F.lit(INF) for f in features])


def _report_columns(features: list[str]) -> dict[str, Column]:
    copies = F.col(COPIES)
    zero = F.lit(0).cast("bigint")
    usable = F.count_if(_usable(features))
    raw = F.coalesce(F.sum(copies), zero)
    inf = reduce(add, [is_infinite(F.col(f"`{f}`")).cast("bigint") for f in features])
    return {
        "raw_rows": raw,
        "cleaned_rows": usable,
        "removed_rows": raw - usable,
        "duplicates_removed": F.coalesce(F.sum(copies - 1), zero),
        "inf_replaced": F.coalesce(F.sum(inf), zero),
        "nan_rows_dropped": F.count(F.lit(1)) - usable,
    }


def clean_report(deduped: DataFrame, features: list[str]) -> DataFrame:
    """Row counts of the cleaning steps, one aggregate over the de-duplicated rows."""
    return deduped.agg(*[c.alias(k) for k, c in _report_columns(features).items()])


def write_cleaned(deduped: DataFrame, features: list[str], path: str) -> DataFrame:
    """Write the cleaned table and read it back."""
    drop_unusable(deduped, features).drop(COPIES).write.mode("overwrite").parquet(path)
    return deduped.sparkSession.read.parquet(path)


def class_distribution(df: DataFrame, label: str, digits: int | None = None) -> DataFrame:
    """Rows and percentage per class. Missing labels are not counted."""
    c = F.col(f"`{label}`")
    counts = df.groupBy(c.alias("class")).agg(F.count(c).alias("n")).where(F.col("n") > 0)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", display(F.col("n") / total * 100.0, digits))


def imbalance(df: DataFrame, label: str, digits: int | None = None) -> DataFrame:
    """Largest over smallest class when there are exactly two, else 0."""
    counts = class_distribution(df, label)
    value = F.when(F.count(F.lit(1)) == 2, ratio(F.max("n"), F.min("n"))).otherwise(F.lit(0.0))
    return counts.agg(
        F.count(F.lit(1)).alias("classes"), display(value, digits).alias("imbalance_ratio")
    )


def report_metrics(features: list[str], spec: FlowSpec = DEFAULT_SPEC) -> dict[str, Column]:
    """Everything the report counts, as aggregates that can be observed while the de-duplicated rows
    are written."""
    label = F.col(f"`{spec.label_col}`")
    return {
        **_report_columns(features),
        **{f"class_{c}": F.count_if(_usable(features) & (label == c)) for c in (ATTACK, BENIGN)},
    }


def write_deduped(
    deduped: DataFrame, features: list[str], path: str, spec: FlowSpec = DEFAULT_SPEC
) -> tuple[DataFrame, dict]:
    """Write de-duplicated rows, usable ones and others in folders of their own, and count them on
    the way: the cleaned table and the report's counts, in one pass."""
    marked = deduped.withColumn(USABLE, F.coalesce(_usable(features), F.lit(False)))
    written, counts = write_observed(marked, path, report_metrics(features, spec), [USABLE])
    return _cleaned_of(written), counts


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned table among the rows that write_deduped wrote."""
    return _cleaned_of(spark.read.parquet(path))


def _cleaned_of(written: DataFrame) -> DataFrame:
    return written.where(F.col(USABLE).cast("boolean")).drop(USABLE, COPIES)


def counted_report(
    spark: SparkSession, counts: dict, features: list[str], missing: list[str],
    spec: FlowSpec = DEFAULT_SPEC, source: str | None = None, fingerprint: str | None = None,
    corrupt: int = 0,
) -> DataFrame:
    """validation_report from counts that were observed."""
    names = list(_report_columns(features))
    classes = [(c, counts[f"class_{c}"]) for c in (ATTACK, BENIGN) if counts[f"class_{c}"]]
    schema = ", ".join(f"{n} bigint" for n in names)
    row = spark.createDataFrame(
        [(*[counts[n] for n in names], classes)],
        f"{schema}, classes array<struct<label: string, cleaned_rows: bigint>>")
    return _report_row(row, features, missing, spec, source, fingerprint, corrupt)


def validation_report(
    deduped: DataFrame, features: list[str], missing: list[str],
    spec: FlowSpec = DEFAULT_SPEC, source: str | None = None, fingerprint: str | None = None,
    corrupt: int = 0,
) -> DataFrame:
    """The whole report as one row: counts, features and the two classes as maps.

    Raw labels are free text, so their distribution is a table of its own:
    class_distribution of the raw label. `corrupt` is the number of malformed lines
    that were set aside when the files were read.
    """
    by_class = deduped.groupBy(F.col(f"`{spec.label_col}`").alias("label")).agg(
        *[c.alias(k) for k, c in _report_columns(features).items()])
    entry = F.struct(F.col("label"), F.col("cleaned_rows"))
    row = by_class.agg(
        *[F.coalesce(F.sum(k), F.lit(0).cast("bigint")).alias(k) for k in _report_columns(features)],
        F.sort_array(F.collect_list(F.when(F.col("cleaned_rows") > 0, entry))).alias("classes"),
    )
    return _report_row(row, features, missing, spec, source, fingerprint, corrupt)


def _report_row(
    row: DataFrame, features: list[str], missing: list[str], spec: FlowSpec, source: str | None,
    fingerprint: str | None, corrupt: int,
) -> DataFrame:
    label, original = spec.label_col, spec.original_label_col
    sizes = F.transform("classes", lambda c: c["cleaned_rows"])
    two = (F.size("classes") == 2) & (F.array_min(sizes) > 0)
    return row.select(
        F.lit(source).cast("string").alias("dataset_path"),
        F.lit(fingerprint).cast("string").alias("dataset_hash"),
        F.lit(corrupt).cast("bigint").alias("corrupt_rows"),
        *_report_columns(features),
        F.array(*[F.lit(f) for f in spec.features]).alias("features_requested"),
        F.array(*[F.lit(f) for f in features]).alias("features_resolved"),
        F.array(*[F.lit(f) for f in missing]).cast("array<string>").alias("features_missing"),
        F.lit(len(features)).alias("num_features"),
        F.map_from_entries("classes").alias("class_distribution"),
        F.map_from_entries(F.transform("classes", lambda c: F.struct(
            c["label"], F.round(c["cleaned_rows"] / F.col("cleaned_rows") * 100.0, 2)
        ))).alias("class_percentages"),
        F.when(two, F.round(F.array_max(sizes) / F.array_min(sizes), 2)).otherwise(0.0)
        .alias("imbalance_ratio"),
        F.array(*[F.lit(c) for c in [*features, label, original]]).alias("columns"),
    )


def _cols(names: list[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]
