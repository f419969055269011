"""Near-duplicate documents by SimHash fingerprints, joined over pivot distance tables.

A fingerprint has a bit where more than half of the hashes of its document's 3-word shingles have
it. Documents with one fingerprint are one class, and classes that differ in 3 bits or fewer are
linked:

1. The distances of every fingerprint to a number of reference fingerprints are computed first and
   go with it as its row of the distance table.
2. Half the difference of the distances to a reference and to the same reference turned over in a
   block of bits tells the distance within the block. Of any blocks that share out the bits, all
   but three are alike in two linked fingerprints, and so are all distances within them. So rows
   are dealt by their distances within all but three of the blocks, once for each choice of three.
3. Rows dealt alike are compared by their rows of the table: a pair with two distances that differ
   by more than 3 cannot be linked and goes; what is left is verified. A group gives the links of a
   spanning forest, not its pairs.
4. A group of more than LIMIT rows is not compared. Bits that vary within it are shared out anew,
   balanced by how much they vary, into so many blocks that its parts are small. Rows are distinct,
   so this ends: a group whose members vary in k bits has 2^k rows at most.

Cases: a document of fewer words than a shingle has its whole sequence as one; without words, or
null, its fingerprint is zero and linked like any other; very long texts count whole; rows that
repeat an id are rows of their own; a row without an id gets the component of its fingerprint, and
null where no member has an id; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.components import connect
from flowsift.llm.heavy_keys import join_by_key
from flowsift.llm.scratch import land
from flowsift.llm.textbytes import scrambled
from flowsift.operators.small import pin_small

SIZE = 3
SEED = 42
NEAR = 3
#: Rows that are compared with each other at most; hashes whose bits are counted at once.
LIMIT = 1_000
PART_HASHES = 200_000
#: Groups of this size are aimed at when rows are dealt.
AIM = 64
MOST_BLOCKS = 16

_RNG = np.random.default_rng(20240301)
#: Reference fingerprints of the table, and those whose distances within blocks deal the rows.
TABLE = _RNG.integers(0, 2 ** 64, 16, dtype=np.uint64)
WITHIN = _RNG.integers(0, 2 ** 64, 8, dtype=np.uint64)
_ODD = scrambled(np.arange(1, 1000, dtype=np.uint64)) | np.uint64(1)


def fingerprint(text: str | None) -> int:
    import xxhash

    words = (text or "").encode().lower().split()  # both know A-Z and bytes 9-13, 32 only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    n = max(len(words) - SIZE + 1, 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, PART_HASHES):
        part = words[at:at + PART_HASHES + SIZE - 1]
        shingles = zip(*(part[k:] for k in range(SIZE))) if len(part) >= SIZE else [part]
        hashes = np.fromiter((digest(b" ".join(s), SEED) for s in shingles), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def distances(fp: np.ndarray, references: np.ndarray, mask: int = 2 ** 64 - 1) -> np.ndarray:
    """Distance of every fingerprint to every reference within the bits of the mask. That is
    (d(x, r) - d(x, r turned over in the mask) + bits of the mask) / 2, counted directly."""
    return np.bitwise_count((fp[:, None] ^ references) & np.uint64(mask))


def block_keys(fp: np.ndarray, masks: list[int], before: int = 0) -> np.ndarray:
    """For each choice of blocks but three a number for the distances within them: fp x choices."""
    own = [scrambled(distances(fp, WITHIN, m).view(np.uint64)[:, 0] + np.uint64(k)) for k, m in enumerate(masks)]
    choices = list(itertools.combinations(range(len(masks)), max(len(masks) - NEAR, 0)))
    keys = np.empty((len(fp), len(choices)), np.uint64)
    for c, kept in enumerate(choices):
        total = np.full(len(fp), (before * 0x9E3779B97F4A7C15 + c + 1) % 2 ** 64, np.uint64)
        for k in kept:
            total += own[k] * _ODD[k]
        keys[:, c] = scrambled(total)
    return keys


def shared_out(weights: np.ndarray, blocks: int) -> list[int]:
    """Masks of that many blocks, each with about the same weight of bits; weightless bits are left out."""
    masks, held = [0] * blocks, [0.0] * blocks
    for bit in np.argsort(-weights, kind="stable"):
        if weights[bit] > 0:
            to = held.index(min(held))
            masks[to] |= 1 << int(bit)
            held[to] += float(weights[bit])
    return [m for m in masks if m]


def blocks_for(rows: int, weight: float) -> int:
    """Blocks of which all but three hold enough of the weight, in bits, to make groups small."""
    needed = math.log2(max(rows, 1) / AIM)
    return next((b for b in range(NEAR + 1, MOST_BLOCKS) if weight * (b - NEAR) / b >= needed), MOST_BLOCKS)


def _keyed(distinct: DataFrame, masks: list[int]) -> DataFrame:
    def run(batches):
        for batch in batches:
            fp = np.asarray(batch.column(0)).view(np.uint64)
            keys = block_keys(fp, masks)
            yield _rows(keys, fp, batch.column(1))

    return distinct.select("fp", "distances").mapInArrow(run, "key long, fp long, distances binary")


def _rows(keys: np.ndarray, fp: np.ndarray, table: pa.Array) -> pa.RecordBatch:
    times = keys.shape[1]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(fp, times).view(np.int64)),
         table.take(pa.array(np.repeat(np.arange(len(fp)), times)))], names=["key", "fp", "distances"])


def _masks(hot_rows: DataFrame) -> DataFrame:
    """key, masks: new blocks of the bits that vary within each of the groups."""

    def counted(batches):
        for batch in batches:
            keys, owner = np.unique(np.asarray(batch.column(0)), return_inverse=True)
            bits = np.unpackbits(np.asarray(batch.column(1)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            order = np.argsort(owner, kind="stable")
            first = np.searchsorted(owner[order], np.arange(len(keys)))
            sums = np.add.reduceat(bits[order], first, axis=0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(np.bincount(owner, minlength=len(keys))),
                 *(pa.array(sums[:, k]) for k in range(64))], names=["key", "rows", *(f"b{k}" for k in range(64))])

    names = ["rows", *(f"b{k}" for k in range(64))]
    sums = hot_rows.select("key", "fp").mapInArrow(counted, "key long, " + ", ".join(f"{c} long" for c in names))
    sums = sums.groupBy("key").agg(*(F.sum(c).alias(c) for c in names))

    def planned(batches):
        for batch in batches:
            masks = []
            for row in batch.to_pylist():
                share = np.array([row[f"b{k}"] for k in range(64)]) / row["rows"]
                varies = (share > 0) & (share < 1)
                p = np.where(varies, share, 0.5)
                weights = np.where(varies, -p * np.log2(p) - (1 - p) * np.log2(1 - p), 0)
                masks.append(np.array(shared_out(weights, blocks_for(row["rows"], weights.sum())), np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(masks, pa.list_(pa.int64()))], names=["key", "masks"])

    return sums.mapInArrow(planned, "key long, masks array<long>")


def _rekeyed(hot_rows: DataFrame) -> DataFrame:
    """Rows (key, fp, distances, masks) dealt by the blocks of their groups."""

    def run(batches):
        for batch in batches:
            keys = np.asarray(batch.column("key"))
            order = np.argsort(keys, kind="stable")
            cuts = np.flatnonzero(np.diff(keys[order])) + 1
            for own in np.split(order, cuts) if len(order) else []:
                rows = batch.take(pa.array(own))
                masks = np.array(rows.column("masks")[0].as_py(), np.int64).view(np.uint64).tolist()
                fp = np.asarray(rows.column("fp")).view(np.uint64)
                some = max(1, PART_HASHES // math.comb(len(masks), min(NEAR, len(masks))))
                for k in range(0, len(fp), some):
                    yield _rows(block_keys(fp[k:k + some], masks, int(keys[own[0]])), fp[k:k + some],
                                rows.column("distances").slice(k, some))

    return hot_rows.select("key", "fp", "distances", "masks").mapInArrow(run, "key long, fp long, distances binary")


def near_pairs(keys: np.ndarray, fp: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked fingerprints among rows that are sorted by key, as a spanning forest."""
    n = len(keys)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if n else np.empty(0, np.int64)
    end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    label = np.arange(n)  # of each row, the first row that it is known to be connected with
    at, step = np.arange(n), 1
    while True:
        at = at[at + step < end[at]]
        if not len(at):
            break
        pair = at[label[at] != label[at + step]]
        for k in range(0, table.shape[1], 4):
            differ = np.abs(table[pair, k:k + 4] - table[pair + step, k:k + 4])
            pair = pair[(differ <= NEAR).all(axis=1)]
        pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + step]) <= NEAR]
        while len(pair):
            least = np.minimum(label[pair], label[pair + step])
            np.minimum.at(label, label[pair], least)
            np.minimum.at(label, label[pair + step], least)
            while (label[label] != label).any():
                label = label[label]
            pair = pair[label[pair] != label[pair + step]]
        step += 1
    joined = np.flatnonzero(label != np.arange(n))
    return joined, label[joined]


def _compared(rows: DataFrame) -> DataFrame:
    """Links a, b between the rows of each key."""

    def links(table: pa.Table) -> pa.RecordBatch:
        fp = np.asarray(table.column("fp").combine_chunks())
        held = b"".join(table.column("distances").to_pylist())
        near = np.frombuffer(held, np.uint8).reshape(len(fp), -1).astype(np.int16)
        a, b = near_pairs(np.asarray(table.column("key").combine_chunks()), fp.view(np.uint64), near)
        return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    def run(batches):
        waiting = None  # rows of the last key so far; the next batch may have more of them
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if waiting is None else pa.concat_tables([waiting, table])
            keys = np.asarray(table.column("key").combine_chunks())
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            waiting = table.slice(whole)
            if whole:
                yield links(table.slice(0, whole))
        if waiting is not None and len(waiting):
            yield links(waiting)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, rows: int, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints `fp` with NEAR differing bits or fewer."""

    def measured(batches):
        for batch in batches:
            table = distances(np.asarray(batch.column(0)).view(np.uint64), TABLE)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in table], pa.binary())], names=["fp", "distances"])

    table = distinct.select("fp").mapInArrow(measured, "fp long, distances binary")
    dealt = land(_keyed(table, shared_out(np.ones(64), blocks_for(rows, 64))), "dealt")
    found = None
    while True:
        counts = land(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "groups")
        hot, _ = pin_small(counts.where(F.col("n") > limit).select("key"))
        # A group of one row has no pair; it would only be moved.
        own = land(_compared(dealt.join(counts.where(F.col("n") <= limit).select("key"), "key", "left_semi")), "links")
        found = own if found is None else found.unionAll(own)
        if hot.isEmpty():
            return found
        hot_rows = land(dealt.join(hot, "key"), "hot")
        masks, _ = pin_small(_masks(hot_rows))
        dealt = land(_rekeyed(hot_rows.join(masks, "key")), "dealt")


def near_classes(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest id
    reachable by links)."""
    names = land(fingerprints(docs), "names")
    classes = land(names.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    sizes = classes.agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("rows")).first()
    labels = connect(links(classes, sizes["classes"], limit)).select(F.col("class").alias("fp"), "comp")
    known = classes.join(labels, "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    least = known.groupBy("comp").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    least = land(least, "components")
    known = join_by_key(land(known.select("fp", "comp", "n"), "members"), least, "comp", "members", sizes["classes"])
    known = land(known.select("fp", "n", "component_id"), "known")
    return join_by_key(names, known, "fp", "n", sizes["rows"] or 0).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
