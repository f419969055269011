"""Line dedup by a suffix array over sequences of line ids.

Every line with a word gets an id; each document is a sequence of ids. Prefix doubling ranks the
suffixes by their first 1, 2, 4, ... lines: pairs of ranks are counted, sorted by range, and the
rank of a pair is the number of suffixes that sort before it. Suffixes that share their rank with
no other one leave, so each round handles only what is repeated. Ranks at min_lines are the
intervals of suffixes whose longest common prefix is at least that long; doubling further would
split them but delete the same lines. In every interval the first suffix in document order stays;
the windows of the others are deleted, and windows that follow each other make up the maximal
repeated runs. With min_words, a single line of so many words counts as a run of its own, as the
pipeline stage has it; the query and its SQL twin judge runs by lines alone.

Cases: lines are compared by a 64-bit hash, blanks included; lines without a word are never
deleted; a null text stays null and has no line; a run that overlaps its first copy in the same
document is not deleted; documents count in the order of their ids, those without an id last, and
rows that share an id by a hash of the text; rows that agree in id and text are one document; an
empty table gives an empty table; a document can be of any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.llm.columns import set_aside, with_chars
from flowsift.llm.scratch import land
from flowsift.llm.tokens import batches_by_size

MIN_LINES = 2
#: Words that make a single line a run, in the pipeline.
MIN_WORDS = 50
VISIBLE = r"[^\x20\x09-\x0D]"
BATCH_BYTES = 16_000_000


def row_key():
    """A name for a row: equal for rows that agree in id and text."""
    return F.xxhash64("doc_id", "text")


def long_line(line, min_words: int | None):
    """Whether a line has min_words words or more; none has if that is None."""
    blank = r"[\x20\x09-\x0D]"
    return F.lit(False) if min_words is None else line.rlike(
        f"^{blank}*+(?:{VISIBLE}++{blank}++){{{max(min_words, 1) - 1}}}{VISIBLE}")


def line_table(docs: DataFrame, min_words: int | None = None) -> DataFrame:
    """row, doc_id, at (number among the lines with a word), line (hash) and long."""
    ids = F.transform(F.filter(F.split("text", "\n"), lambda x: x.rlike(VISIBLE)), lambda x: F.struct(
        F.xxhash64(x).alias("line"), long_line(x, min_words).alias("long")))
    rows = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), ids.alias("ids"))
    flat = rows.select("row", "doc_id", F.posexplode("ids").alias("at", "item"))
    return flat.select("row", "doc_id", "at", "item.line", "item.long")


def ranked(keys: DataFrame, by: list[str]) -> DataFrame:
    """Distinct keys with their count n -> rank: how many rows have a smaller key. The keys are
    sorted by range; a partition adds what the partitions before it hold."""
    width = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartitionByRange(width, *by).sortWithinPartitions(*by)
    fields = ", ".join(f"{c} long" for c in by)

    def run(batches):
        total, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = np.asarray(batch.column("n"))
            before = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in by), batch.column("n"), pa.array(np.full(len(n), part)),
                 pa.array(before.astype(np.int64))], names=[*by, "n", "part", "before"])

    rows = land(dealt.select(*by, "n").mapInArrow(run, f"{fields}, n long, part long, before long"), "ranks")
    sums = rows.groupBy("part").agg(F.sum("n").alias("rows")).orderBy("part").collect()  # a row per partition
    start, total = [], 0
    for s in sums:
        start.append(F.struct(F.lit(s["part"]).alias("part"), F.lit(total).cast("long").alias("start")))
        total += s["rows"]
    if not start:
        return rows.select(*by, F.lit(0).cast("long").alias("rank"))
    starts = keys.sparkSession.range(1).select(F.inline(F.array(*start)))
    return rows.join(F.broadcast(starts), "part").select(*by, (F.col("start") + F.col("before")).alias("rank"))


def _repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """row, doc_id, at, rank of the rows whose key another row has too."""
    keys = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return land(rows.join(ranked(keys, by), by).select("row", "doc_id", "at", "rank"), "suffixes")


def suffix_ranks(lines: DataFrame, length: int) -> DataFrame:
    """Ranks of the suffixes by their first `length` lines, where another suffix begins alike."""
    ranks, done = _repeated(lines, ["line"]), 1
    while done < length:
        step = min(done, length - done)  # a last step may overlap what is ranked already
        after = ranks.select("row", (F.col("at") - step).cast("int").alias("at"), F.col("rank").alias("next"))
        pairs = ranks.withColumnRenamed("rank", "this").join(after, ["row", "at"])
        ranks, done = _repeated(pairs, ["this", "next"]), done + step
    return ranks


def _later_windows(rows: DataFrame, by: str, length: int) -> DataFrame:
    """row and at of the lines in windows of this length that have the key of an earlier one."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "at")
    first = rows.groupBy(by).agg(F.min(order).alias("first"))
    later = rows.join(first, by).where(
        (F.col("row") != F.col("first.row")) | (F.col("at") >= F.col("first.at") + length))
    return later.select("row", F.explode(F.sequence(F.col("at"), F.col("at") + length - 1)).alias("at"))


def later_copies(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """row and the sorted numbers of its lines to delete."""
    lines = land(line_table(docs, min_words).distinct(), "lines")
    windows = _later_windows(suffix_ranks(lines, min_lines), "rank", min_lines)
    if min_words is not None:
        windows = windows.union(_later_windows(_repeated(lines.where("long"), ["line"]), "rank", 1))
    return windows.groupBy("row").agg(F.sort_array(F.collect_set("at")).alias("gone"))


def dedup(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """The documents with all their columns, text without later copies of line runs, and a struct
    `line_runs` of n_lines, n_removed and n_runs (maximal deleted runs), which takes the place of
    a column of that name."""
    docs = docs.drop("line_runs")
    gone = land(later_copies(docs, min_lines, min_words), "gone")
    rows = docs.select(row_key().alias("row"), "text", F.struct(*docs.columns).alias("doc")).join(
        gone.hint("merge"), "row", "left")  # at every size alike, by a shuffle
    flat = rows.select("doc", "text", "gone")
    schema = T.StructType([
        flat.schema["doc"], T.StructField("text", T.StringType()),
        *(T.StructField(c, T.LongType()) for c in ("n_lines", "n_removed", "n_runs"))])

    def run(batches):
        for batch in batches:
            texts, lists = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for cut in batches_by_size([len(t or "") for t in texts], BATCH_BYTES):
                out, counts = [], []
                for text, numbers in zip(texts[cut], lists[cut]):
                    kept, count = without(text, numbers or [])
                    out.append(kept)
                    counts.append(count)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[cut.start:cut.stop], pa.array(out, pa.string()),
                     *(pa.array(c, pa.int64()) for c in zip(*counts))],
                    names=schema.names)

    done = flat.mapInArrow(run, schema)
    return done.select(*[F.col("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns],
                       F.struct("n_lines", "n_removed", "n_runs").alias("line_runs"))


def without(text: str | None, numbers: list[int]) -> tuple[str | None, tuple[int, int, int]]:
    """A text without the lines of these numbers (among those with a word), and the counts."""
    if text is None:
        return None, (0, 0, 0)
    gone, kept, n = set(numbers), [], 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            if n not in gone:
                kept.append(line)
            n += 1
        else:
            kept.append(line)
    runs = sum(1 for x in numbers if x - 1 not in gone)
    return "\n".join(kept), (n, len(numbers), runs)


def deduped_documents(docs: DataFrame) -> DataFrame:
    """Documents with their columns; text and n_chars (if there) are those after the deletion. A
    document that loses all its lines goes. A column named line_runs stays as it is."""
    renamed, own = set_aside(docs, ["line_runs"])
    done = dedup(renamed, min_words=MIN_WORDS)
    left = done.where((F.col("line_runs.n_lines") == 0) | (F.col("line_runs.n_removed") < F.col("line_runs.n_lines")))
    return with_chars(left, F.col("line_runs.n_removed") > 0).select(own)
