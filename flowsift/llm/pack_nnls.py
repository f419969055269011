"""Packing by non-negative least squares on the histogram of lengths.

Documents are cut into full windows and a rest. The histogram of rests has at most window - 1
bins, whatever the corpus. Combinations of two or three lengths that fill a window exactly are
enumerated; non-negative least squares gives how often each is to be used; the counts are rounded
within what the histogram holds. What is left is packed greedily by longest and best fit where
that all but fills a window, and else laid end to end and cut at window borders, so one very
frequent length wastes nothing. The solution says, for each length and range of ranks, which
windows take the rests; ranks come from counts per partition, so no length is gathered anywhere.

Cases: null text counts as empty, an empty document is its end id alone; documents of any length
are kept whole, in pieces; equal lengths go by partition and row order; repeated rows are packed
each; an empty table gives no rows; other columns of the input are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsift.llm.scratch import land
from flowsift.llm.token_ids import document_ids, rank_encoder
from flowsift.llm.tokens import batches_by_size

#: Steps of the solver, and the room a greedy window may leave, as a part of the window.
STEPS = 400
SLACK = 1 / 64
#: Bytes of ids handed to Spark at once.
BATCH_BYTES = 16_000_000

PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")


# --- the plan: driver side, bounded by the window ------------------------------------


def combinations(present: np.ndarray, window: int) -> np.ndarray:
    """Sorted pairs and triples of present lengths that add up to the window, 0 for no third."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    a = np.arange(1, window)
    pairs = [(x, window - x, 0) for x in a[a <= window - a] if has[x] and has[window - x]]
    triples = [np.empty((0, 3), np.int64)]
    for x in present[3 * present <= window]:
        y = np.arange(x, (window - x) // 2 + 1)
        y = y[has[y] & has[window - x - y]]
        triples.append(np.stack([np.full(len(y), x), y, window - x - y], axis=1))
    return np.concatenate([np.array(pairs, np.int64).reshape(-1, 3), *triples])


def least_squares(combos: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative repeats x that bring the combinations' lengths closest to the counts.

    Accelerated projected gradient; the matrix has a 1 for each length of a combination, so its
    products are sums over three index columns. Column 0 of counts stands for "no third"."""
    used = combos > 0

    def forward(x):
        return sum(np.bincount(combos[:, k], x * used[:, k], len(counts)) for k in range(3))

    def back(r):
        return sum(r[combos[:, k]] * used[:, k] for k in range(3))

    v = np.ones(len(combos))
    for _ in range(20):  # largest singular value
        v = back(forward(v))
        v /= np.linalg.norm(v) or 1.0
    step = 1.0 / max(np.linalg.norm(forward(v)) ** 2, 1.0)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - step * back(forward(y) - counts), 0.0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def solve(histogram: dict[int, int], window: int) -> dict:
    """Ranges of ranks per length -> windows. All arrays are bounded by the window's size.

    `slots`: (length, first rank, rests in all, copies per window, first window, offset of the
    first copy). `stream`: length -> (first rank, first position in the stream of cut rests).
    `windows`: number of windows before the stream."""
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    taken = np.zeros(window + 1, np.int64)
    slots: list[tuple] = []
    windows = 0

    def use(parts: list[tuple[int, int]], repeats: int) -> None:
        """Windows of (length, copies), so many times."""
        nonlocal windows
        offset = 0
        for length, copies in parts:
            slots.append((length, int(taken[length]), repeats * copies, copies, windows, offset))
            offset += length * copies
            taken[length] += repeats * copies
            left[length] -= repeats * copies
        windows += repeats

    combos = combinations(np.flatnonzero(left), window)
    if len(combos):
        x = least_squares(combos, left.astype(float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.05:
                break
            lengths, copies = np.unique(combos[j][combos[j] > 0], return_counts=True)
            repeats = min(int(np.ceil(x[j])), int((left[lengths] // copies).min()))
            if repeats:
                use([(int(n), int(c)) for n, c in zip(lengths, copies)], repeats)

    # Greedy: the longest, as often as it fits, then always the longest that still fits.
    cut = np.zeros(window + 1, bool)
    for longest in range(window - 1, 0, -1):
        while left[longest] > 0 and not cut[longest]:
            parts, room = [], window
            for length in [longest, *range(min(window - longest, longest), 0, -1)]:
                copies = min(room // length, int(left[length])) if length <= room else 0
                if copies and (not parts or length != parts[0][0]):
                    parts.append((length, copies))
                    room -= length * copies
                if room == 0:
                    break
            if room > window * SLACK:
                cut[longest] = True  # these go to the stream
            else:
                use(parts, min(int(left[n]) // c for n, c in parts))

    stream, position = {}, 0
    for length in np.flatnonzero(left):
        stream[int(length)] = (int(taken[length]), position)
        position += int(left[length]) * int(length)
    return {"slots": np.array(sorted(slots), np.int64).reshape(-1, 6), "stream": stream,
            "windows": windows, "in_all": windows + -(-position // window)}


def place(plan: dict, window: int, length: int, ranks: np.ndarray):
    """For rests of one length: lists of (part of the rest, length, window, offset) per rest."""
    slots = plan["slots"]
    lo, hi = np.searchsorted(slots[:, 0], [length, length + 1])
    first = slots[lo:hi, 1]
    held = first[-1] + slots[hi - 1, 2] if hi > lo else 0
    out = []
    for rank in ranks:
        if rank < held:
            _, start, _, copies, base, offset = slots[lo + np.searchsorted(first, rank, "right") - 1]
            nth = int(rank - start)
            out.append([(0, length, int(base) + nth // int(copies), int(offset) + nth % int(copies) * length)])
        else:
            start, base = plan["stream"][length]
            at, done, parts = base + int(rank - start) * length, 0, []
            while done < length:
                size = min(length - done, window - (at + done) % window)
                parts.append((done, size, plan["windows"] + (at + done) // window, (at + done) % window))
                done += size
            out.append(parts)
    return out


# --- Spark side ------------------------------------------------------------------------


def token_table(docs: DataFrame, path: str, pattern: str, window: int, end_id: int,
                id_col: str, text_col: str) -> DataFrame:
    """Documents' ids, with the partition, the running number of full windows in it, the rest's
    length and the rest's number among those of its length in the partition."""

    def run(batches):
        encoding = rank_encoder(path, pattern)
        part = TaskContext.get().partitionId()
        seen = [0] * window
        full = 0
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for cut in batches_by_size([2 * len(t or "") for t in texts], BATCH_BYTES):
                rows = []
                for text in texts[cut]:
                    ids = document_ids(encoding, text, end_id)
                    n = len(ids) // 2
                    rest = n % window
                    rows.append((n, full, rest, seen[rest], ids))
                    full += n // window
                    seen[rest] += 1
                yield pa.RecordBatch.from_arrays(
                    [keys[cut.start:cut.stop], pa.array([part] * len(rows), pa.int64()),
                     *(pa.array(c, t) for c, t in zip(
                         zip(*rows), [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]))],
                    names=["doc_id", "part", "n", "full", "rest", "nth", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, part long, n long, full long, rest int, nth long, ids binary")


def _batches(rows: list[tuple]):
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    for cut in batches_by_size([len(r[-1]) for r in rows], BATCH_BYTES):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary() if n == "ids" else pa.int64())
             for n, c in zip(names, zip(*rows[cut]))], names=names)


def pack(docs: DataFrame, path: str, pattern: str, window: int = 1024, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset and `ids` (little-endian
    unsigned 32-bit). A sequence's pieces lie end to end from offset 0; their ids add up to at
    most the window."""
    spark = docs.sparkSession
    tokens = land(token_table(docs, path, pattern, window, end_id, id_col, text_col), "tokens")
    rests = tokens.where("rest > 0")
    per_part = rests.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n_rests"))
    histogram = {r["rest"]: r["n"] for r in per_part.groupBy("rest").agg(F.sum("n_rests").alias("n")).collect()}
    plan = solve(histogram, window)
    shared = spark.sparkContext.broadcast(plan)  # bounded by the window, not by the corpus
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "part", "rest", F.coalesce(F.sum("n_rests").over(before), F.lit(0)).alias("before"))

    def full_windows(batches):
        base = shared.value["in_all"]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], "<u2").astype("<u4")
                for k in range(r["n"] // window):
                    rows.append((r["doc_id"], k * window, window, r["n"],
                                 base + (r["part"] << 33) + r["full"] + k, 0,
                                 ids[k * window:(k + 1) * window].tobytes()))
            yield from _batches(rows)

    def placed(batches):
        plan = shared.value
        for batch in batches:
            lengths = batch.column("rest").to_numpy()
            ranks = batch.column("rank").to_numpy()
            docs_, sizes = batch.column("doc_id").to_pylist(), batch.column("n").to_pylist()
            ids = batch.column("ids")
            rows = []
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                for i, parts in zip(at.tolist(), place(plan, window, int(length), ranks[at])):
                    own = np.frombuffer(ids[i].as_py(), "<u2").astype("<u4")
                    for done, size, sequence, offset in parts:
                        rows.append((docs_[i], sizes[i] - int(length) + done, size, sizes[i], sequence,
                                     offset, own[done:done + size].tobytes()))
            yield from _batches(rows)

    long_docs = tokens.where(F.col("n") >= window).select("doc_id", "part", "n", "full", "ids")
    tails = rests.select(
        "doc_id", "n", "part", "rest", "nth",
        F.expr("substring(ids, cast(octet_length(ids) - 2 * rest + 1 as int))").alias("ids"),
    ).join(offsets, ["part", "rest"]).select(
        "doc_id", "n", "rest", (F.col("before") + F.col("nth")).alias("rank"), "ids")
    return long_docs.mapInArrow(full_windows, PIECES).unionAll(tails.mapInArrow(placed, PIECES))


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
