"""Exact cuts of classes at given ranks of a hash order, without sorting a class.

Sampling, splitting and fold assignment all say: order the rows of each class by
a hash and cut the order at certain ranks. A window per class would put a class
with nearly all rows into one task. Here only the hash values at the cuts are
searched, then every row is compared with the cut hashes of its class. The table
itself is scanned but never shuffled.

Hashes are uniform, so the hash at a rank lies close to rank / rows. One pass
counts the rows below an interval around it and the hashes inside, which gives
the exact hash. Repeated keys can spoil the estimate. It is checked, and if an
interval misses, the hash is found by counting rows per prefix and refining.

When all cuts are at low ranks, as for samples, one scan is enough to find them:
every task keeps its class sizes and its smallest hashes per class, which are
merged in two steps, so no task gets more than MERGED sets of a class.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.operators.small import pin_small
from flowsift.session import landed

CLASS, HASH, COPIES = "_class", "_hash", "_copies"
HASH_WIDTH = 32
SIGMAS = 8  # half width of the interval around an expected hash
UNIT_DIGITS = 13  # hex digits of an interval end, exact in a double
STEP = 3  # hex digits per refinement: 4096 prefixes per class
PREFIX_ROWS = 200_000  # prefix counts of up to 48 classes are kept as a local table
FINE = 2_000_000  # rows per prefix that one window task may order
EXPAND = 100_000  # copies written by one explode
HELD = 200_000  # hashes that a task may hold per class
MERGED = 64  # sets of hashes of a class that a task merges at first

Cuts = Callable[[DataFrame], DataFrame]


def class_key(c: Column) -> Column:
    """Class as text, NULL being a class of its own."""
    return F.coalesce(c.cast("string"), F.lit("\0"))


def slice_rows(
    df: DataFrame, by: Column | None, order: Column, cuts: Cuts, n_cuts: int, out: str = "slice",
    highest: int | None = None,
) -> DataFrame:
    """Add the number of the slice each row falls into, 0 to n_cuts.

    cuts gets the class sizes (_class, n) and returns (_class, cut, rank): slice
    `cut` ends with the row of that rank, counted from 1; ranks rise with cut.
    Without `by` the whole table is one class. `highest` bounds the ranks, where that is known.
    Rows with equal hashes are cut exactly too: by content, and identical rows
    by number.
    """
    cols = df.columns
    keyed = df.withColumn(HASH, order)
    # Without classes all rows share an empty text. A literal would make the joins
    # below pair rows without a key.
    keyed = keyed.withColumn(CLASS, F.substring(HASH, 1, 0) if by is None else class_key(by))
    only = keyed.select(CLASS, HASH)
    if highest is not None and 0 < highest <= HELD:
        found, rows = _smallest(only, cuts, highest)
    else:
        found, rows = _estimate(only, cuts, n_cuts) or _locate(only, cuts)
    cut_table = _per_class(found, n_cuts)
    if rows is not None:
        cut_table = F.broadcast(cut_table)
    marked = keyed.join(cut_table, CLASS, "left")
    beyond = [
        F.when(F.col(HASH) <= F.col(f"_h{j}"), 0).otherwise(1) for j in range(n_cuts)
    ]
    number = sum(beyond[1:], beyond[0]).cast("int")
    ties_possible = rows is None or any(r["rank"] < r["n"] for r in rows)
    if not ties_possible:
        return marked.select(*cols, number.alias(out))
    tied = F.lit(False)
    for j in range(n_cuts):
        tied = tied | F.coalesce((F.col(HASH) == F.col(f"_h{j}")) & F.col(f"_t{j}"), F.lit(False))
    whole = marked.where(~tied).select(*cols, number.alias(out))
    split = _slice_ties(marked.where(tied).select(*cols, CLASS, HASH), found, n_cuts, out)
    return whole.unionByName(split)


_SET = f"{CLASS} string, part int, n long, hashes binary, counts binary"


def _smallest(keyed: DataFrame, cuts: Cuts, highest: int):
    """_locate in one scan, for ranks up to `highest`: the smallest different hashes of each class
    with their numbers, which hold the row of every such rank."""

    def of_task(batches):
        held: dict[str, list] = {}
        for batch in batches:
            named, raw = batch.column(0).dictionary_encode(), _hashes(batch.column(1))
            codes = np.asarray(named.indices)
            for code, name in enumerate(named.dictionary.to_pylist()):
                own = raw[codes == code]
                state = held.setdefault(name, [0, [], 0])
                state[0] += len(own)
                state[1].append(_counted(own, np.ones(len(own), np.int64), highest))
                state[2] += len(state[1][-1][0])
                if state[2] > 2 * highest:
                    state[1] = [_counted(*map(np.concatenate, zip(*state[1])), highest)]
                    state[2] = len(state[1][0][0])
        part = TaskContext.get().partitionId() % MERGED
        for name, (n, sets, _) in held.items():
            yield _set_row(name, part, n, *_counted(*map(np.concatenate, zip(*sets)), highest))

    def merged(table: pa.Table) -> pa.Table:
        raw = np.concatenate([np.frombuffer(v, "S16") for v in table.column("hashes").to_pylist()])
        counts = np.concatenate([np.frombuffer(v, np.int64) for v in table.column("counts").to_pylist()])
        return pa.Table.from_batches([_set_row(
            table.column(CLASS)[0].as_py(), table.column("part")[0].as_py(),
            sum(table.column("n").to_pylist()), *_counted(raw, counts, highest))])

    sets = keyed.select(CLASS, F.unhex(HASH).alias(HASH)).mapInArrow(of_task, _SET)
    for by in ([CLASS, "part"], [CLASS]):
        sets = sets.groupBy(*by).applyInArrow(merged, _SET)
    sets = landed(sets, "smallest")
    totals, _ = pin_small(sets.select(CLASS, "n"))
    wanted = cuts(totals).where("rank > 0")

    def at_rank(batches):
        for batch in batches:
            rows = []
            for name, cut, rank, raw, counts in zip(*(batch.column(k).to_pylist() for k in range(5))):
                raw, upto = np.frombuffer(raw, "S16"), np.cumsum(np.frombuffer(counts, np.int64))
                k = int(np.searchsorted(upto, rank))
                n = int(upto[k] - (upto[k - 1] if k else 0))
                rows.append((name, cut, raw[k:k + 1].tobytes().hex(), n, rank - int(upto[k]) + n))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                    names=[CLASS, "cut", HASH, "n", "rank"])

    hits = wanted.select(CLASS, F.col("cut").cast("int").alias("cut"), F.col("rank").cast("long").alias("rank")).join(
        sets.select(CLASS, "hashes", "counts"), CLASS).mapInArrow(
        at_rank, f"{CLASS} string, cut int, {HASH} string, n long, rank long")
    return pin_small(hits)


def _hashes(column: pa.Array) -> np.ndarray:
    """16 bytes of each value, which compare as their hex digits do."""
    width = HASH_WIDTH // 2
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else np.empty(0, np.uint8)
    start = column.offset and np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return data[start:start + width * len(column)].view(f"S{width}")


def _counted(raw: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` smallest different hashes and how many rows have them."""
    different, at = np.unique(raw, return_inverse=True)
    return different[:most], np.bincount(at, counts, len(different)).astype(np.int64)[:most]


def _set_row(name: str, part: int, n: int, raw: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([part], pa.int32()), pa.array([n], pa.int64()),
         pa.array([raw.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())],
        names=[CLASS, "part", "n", "hashes", "counts"])


def _estimate(keyed: DataFrame, cuts: Cuts, n_cuts: int):
    """_locate by intervals around the expected hashes; None when one of them misses."""
    totals, rows = pin_small(keyed.groupBy(CLASS).agg(F.count(F.lit(1)).alias("n")))
    if rows is None:
        return None
    share, n = F.col("rank") / F.col("class_n"), F.col("class_n").cast("double")
    slack = SIGMAS * F.sqrt(share * (1.0 - share) / n) + 20.0 / n
    wanted, wanted_rows = pin_small(
        cuts(totals).join(totals.withColumnRenamed("n", "class_n"), CLASS).where("rank > 0")
        .select(CLASS, "cut", "rank", _hex(share - slack).alias("lo"), _hex(share + slack).alias("hi"))
    )
    if not wanted_rows:
        return None
    ends = F.broadcast(wanted.groupBy(CLASS).agg(*[
        F.max(F.when(F.col("cut") == j, F.col(c))).alias(f"_{c}{j}")
        for j in range(n_cuts) for c in ("lo", "hi")
    ]))
    held = [
        F.coalesce(F.col(HASH).between(F.col(f"_lo{j}"), F.col(f"_hi{j}")), F.lit(False))
        for j in range(n_cuts)
    ]
    counts = (
        keyed.join(ends, CLASS)
        .groupBy(CLASS, F.when(reduce(or_, held), F.col(HASH)).alias(HASH))
        .agg(F.count(F.lit(1)).alias("n"),
             *[F.count_if(F.col(HASH) < F.col(f"_lo{j}")).alias(f"_b{j}") for j in range(n_cuts)])
    )
    whole = Window.partitionBy(CLASS)
    below = counts.withColumns({f"_b{j}": F.sum(f"_b{j}").over(whole) for j in range(n_cuts)})
    below_cut = F.element_at(F.array(*[F.col(f"_b{j}") for j in range(n_cuts)]), F.col("cut") + 1)
    inside = (
        below.where(F.col(HASH).isNotNull()).join(wanted, CLASS)
        .where(F.col(HASH).between(F.col("lo"), F.col("hi")))
        .withColumn("_last", below_cut + F.sum("n").over(
            Window.partitionBy(CLASS, "cut").orderBy(HASH)))
    )
    before = F.col("_last") - F.col("n")
    hits, found = pin_small(
        inside.where((F.col("rank") > before) & (F.col("rank") <= F.col("_last")))
        .select(CLASS, "cut", HASH, "n", (F.col("rank") - before).alias("rank"))
    )
    return (hits, found) if found is not None and len(found) == len(wanted_rows) else None


def _hex(share: Column) -> Column:
    """First hex digits of the hash at a share of the hash range; above all hashes from 1 on."""
    at = F.floor(F.greatest(share, F.lit(0.0)) * float(16**UNIT_DIGITS)).cast("bigint")
    return F.when(share >= 1, "g").otherwise(F.lpad(F.lower(F.hex(at)), UNIT_DIGITS, "0"))


def _locate(keyed: DataFrame, cuts: Cuts, weight: str | None = None):
    """The hash at every cut: (_class, cut, _hash, n rows with that hash, rank in them)."""
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    width, step, hits, rows = 0, STEP, None, None
    while True:
        old = F.substring(HASH, 1, width)
        width = min(width + step, HASH_WIDTH)
        part = keyed.withColumn("_old", old).withColumn("_new", F.substring(HASH, 1, width))
        if hits is not None:
            held = hits.select(CLASS, F.col(HASH).alias("_old")).distinct()
            part = part.join(F.broadcast(held) if rows is not None else held,
                             [CLASS, "_old"], "left_semi")
        counts = part.groupBy(CLASS, "_old", "_new").agg(size.alias("n"))
        if hits is None:
            counts, _ = pin_small(counts, PREFIX_ROWS)
            totals = counts.groupBy(CLASS).agg(F.sum("n").alias("n"))
            wanted = cuts(totals).join(totals.withColumnRenamed("n", "class_n"), CLASS)
            wanted = wanted.withColumn("_old", F.lit(""))
        else:
            wanted = hits.drop("n").withColumnRenamed(HASH, "_old")
        run = Window.partitionBy(CLASS, "_old").orderBy("_new")
        last = counts.withColumn("_last", F.sum("n").over(run))
        before = F.col("_last") - F.col("n")
        hits = (
            last.join(wanted, [CLASS, "_old"])
            .where((F.col("rank") > before) & (F.col("rank") <= F.col("_last")))
            .select(CLASS, "cut", F.col("_new").alias(HASH), "n",
                    (F.col("rank") - before).alias("rank"), "class_n")
        )
        hits, rows = pin_small(hits)
        if width == HASH_WIDTH:
            return hits, rows
        biggest = max((r["class_n"] for r in rows), default=0) if rows is not None else 0
        step = STEP if biggest / 16**width > FINE else HASH_WIDTH


def _per_class(found: DataFrame, n_cuts: int) -> DataFrame:
    """One row per class: cut hashes _h, ranks inside the hash _r, partial flags _t."""
    wide = []
    for j in range(n_cuts):
        here = F.col("cut") == j
        wide.append(F.max(F.when(here, F.col(HASH))).alias(f"_h{j}"))
        wide.append(F.max(F.when(here, F.col("rank"))).alias(f"_r{j}"))
        wide.append(F.max(F.when(here, F.col("rank") < F.col("n"))).alias(f"_t{j}"))
    return found.groupBy(CLASS).agg(*wide)


def _slice_ties(tied: DataFrame, found: DataFrame, n_cuts: int, out: str) -> DataFrame:
    """Cut groups of rows with one hash: order by content, split identical rows by count."""
    cols = [c for c in tied.columns if c not in (CLASS, HASH)]
    content = F.md5(F.to_json(F.struct(*cols)))
    inner = F.concat_ws("|", CLASS, HASH)
    groups = (
        tied.groupBy(*cols, CLASS, HASH).agg(F.count(F.lit(1)).alias(COPIES))
        .withColumn("_group", inner).withColumn("_content", content)
    )
    keyed = groups.select(F.col("_group").alias(CLASS), F.col("_content").alias(HASH), COPIES)

    partial = (
        found.where(F.col("rank") < F.col("n"))
        .select(CLASS, F.col(HASH).alias("_tie"), F.col("n").alias("_tie_n")).distinct()
    )
    every_cut = found.join(partial, CLASS).select(
        F.concat_ws("|", CLASS, "_tie").alias(CLASS),
        "cut",
        F.when(F.col("_tie") < F.col(HASH), F.col("_tie_n"))
        .when(F.col("_tie") == F.col(HASH), F.col("rank"))
        .otherwise(F.lit(0)).alias("rank"),
    )
    inner_found, rows = _locate(keyed, lambda totals: every_cut, COPIES)
    cut_table = _per_class(inner_found, n_cuts).withColumnRenamed(CLASS, "_group")
    if rows is not None:
        cut_table = F.broadcast(cut_table)
    placed = groups.join(cut_table, "_group", "left")
    upto = [F.lit(0)]
    for j in range(n_cuts):
        upto.append(
            F.when(F.col("_content") < F.col(f"_h{j}"), F.col(COPIES))
            .when(F.col("_content") == F.col(f"_h{j}"), F.col(f"_r{j}"))
            .otherwise(F.lit(0))
        )
    upto.append(F.col(COPIES))
    parts = F.array(*[
        F.struct(F.lit(j).cast("int").alias(out), (upto[j + 1] - upto[j]).cast("bigint").alias("n"))
        for j in range(n_cuts + 1)
    ])
    pieces = placed.select(*cols, F.inline(parts)).where(F.col("n") > 0)
    chunks = pieces.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {EXPAND}")))
    )
    spread = chunks.repartition(*cols, out, "_chunk")
    left = F.least(F.col("n") - F.col("_chunk") * EXPAND, F.lit(EXPAND).cast("bigint"))
    return spread.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left))
    ).select(*cols, out)
