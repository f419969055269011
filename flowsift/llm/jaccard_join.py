"""Near-duplicate classes of documents: a similarity join on word shingles by prefix filtering.

1. Documents with the same set of shingles are one class; a class is handled once.
2. Shingles are counted in buckets of bounded size, packed as bytes. A shingle that a bounded,
   sampled list knows to be very frequent is not counted: its rows are dealt out by class, and it
   orders behind all others. What only one class has cannot be shared; of the rest every class has
   a narrow row per shingle, and goes on only if enough of its shingles have a second class.
3. The shingles of a class are ordered rarest first. Two sets that are similar enough share one
   among the first few, so only those are joined on. Pairs pass a length filter, a positional
   filter and a suffix filter (shingles after the shared one, counted by ranges of their hash).
4. The classes of a frequent shingle are not paired all with all: a few hubs, taken from its most
   frequent component, are verified against those outside that component; links join components;
   hubs leave, and the next round takes four times as many. Classes of a rare shingle, and what
   few pairs are left between components in the end, are all verified. No pair of different
   components is left out, so components are exact.

Similarity is 100 * shared >= 75 * union on hashes of shingles of 63 bits, of which 48 and the number
of the bucket are compared (all 63 from 32,768 buckets on).

Cases: a document with fewer words than a shingle has its whole word sequence as its set; without
words or text the set is empty and the document alone; very long texts have all their shingles;
rows that repeat an id are kept as rows and linked through their sets; a row without an id takes
the component of its set; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.llm.components import connect
from flowsift.llm.heavy_keys import join_by_key
from flowsift.llm.scratch import land
from flowsift.llm.textbytes import PartHashes, parts, scrambled, words

SIZE = 5
PERCENT = 75
#: Shingles of a bucket; bytes of text handled at once.
BUCKET = 4_000_000
PART_BYTES = 2_000_000
#: One class in so many is looked at for very frequent shingles, which are those in more than a
#: 500th of that sample (8 classes at least). So their list has 500 times the mean set size at most.
SAMPLED = 64
HOT_SHARE = 500
HOT_LEAST = 8
LOW = 48  # bits of a shingle within its bucket, at most
RANGES = 8  # of the suffix filter
#: A shingle of at most so many classes has them all paired. Hubs of the first round.
RARE = 32
HUBS = 4
#: From the second round on, all that is left is compared once it is so few pairs a row; nearly all
#: of these end at the length and positional filters.
FEW_PAIRS = 2_000
#: Rows of a code that one task pairs with the few rows on the other side.
SALT_ROWS = 2_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WEIGHTS = scrambled(np.arange(1, SIZE + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data = _LOWER[data]
    starts, ends, row = words(data, offsets)
    hashes = PartHashes(data).of(starts, ends)
    first = np.searchsorted(row, np.arange(len(offsets)))
    n = np.maximum(len(hashes) - size + 1, 0)
    whole = np.zeros(n, np.uint64)
    for k in range(size):
        whole += hashes[k:k + n] * _WEIGHTS[k]
    whole = scrambled(whole)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            own = np.sort(whole[a:b - size + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif b > a:
            few = (hashes[a:b] * _WEIGHTS[:b - a]).sum(dtype=np.uint64)
            out.append(scrambled(np.array([few + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def class_of(own: np.ndarray) -> int:
    """A set's 64-bit name."""
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def set_names(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class, for sampled classes their shingles, and what tells the row apart."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for row, end, data, offsets in parts(batch.column(1), PART_BYTES):
                sets = shingle_sets(data, offsets)
                names = [class_of(s) for s in sets]
                kept = [s.tobytes() if c % SAMPLED == 0 else None for s, c in zip(sets, names)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[row:end], pa.array(map(len, sets), pa.int64()),
                     pa.array(names, pa.int64()), pa.array(kept, pa.binary()), batch.column(2)[row:end]],
                    names=["doc_id", "n_shingles", "class", "sampled", "unit"])

    return docs.select("doc_id", "text", unit_of("doc_id", "text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, class long, sampled binary, unit binary")


def frequent(names: DataFrame) -> np.ndarray:
    """Sorted hashes of the shingles that too many sampled classes have; bounded, see HOT_SHARE."""
    sampled = names.where("sampled is not null and n_shingles > 0").groupBy("class").agg(
        F.first("sampled").alias("sampled"))
    n = sampled.count()

    def counted(batches):
        for batch in batches:
            own = [np.frombuffer(v.as_py(), np.int64) for v in batch.column(0)]
            if own:
                found, times = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times)], names=["shingle", "n"])

    rows = sampled.select("sampled").mapInArrow(counted, "shingle long, n long").groupBy("shingle").agg(
        F.sum("n").alias("n")).where(F.col("n") >= max(HOT_LEAST, n // HOT_SHARE)).select("shingle").toArrow()
    return np.sort(np.asarray(rows.column("shingle")).astype(np.int64).view(np.uint64))


def _dealt(docs: DataFrame, hot, buckets: int) -> DataFrame:
    """Shingles by bucket, packed: a row per bucket and part of the input. Buckets from `buckets`
    on are those of the frequent shingles, dealt by class; theirs are numbers in the list."""
    def run(batches):
        known = hot.value
        for batch in batches:
            for _, _, data, offsets in parts(batch.column(0), PART_BYTES):
                sets = shingle_sets(data, offsets)
                by_name = {class_of(s): s for s in sets if len(s)}  # copies in one part: once
                if not by_name:
                    continue
                names = np.fromiter(by_name, np.int64, len(by_name))
                sizes = np.array([len(s) for s in by_name.values()], np.int64)
                every = np.concatenate(list(by_name.values()))
                owner = np.repeat(np.arange(len(names)), sizes)
                at = np.searchsorted(known, every)
                is_hot = np.zeros(len(every), bool)
                if len(known):
                    is_hot = known[np.minimum(at, len(known) - 1)] == every
                within, of = np.divmod(every >> np.uint64(1), np.uint64(buckets))
                code = np.where(is_hot, at.astype(np.uint64), within & np.uint64((1 << LOW) - 1))
                bucket = np.where(is_hot, buckets + names[owner] % buckets, of.astype(np.int64))
                order = np.argsort(bucket, kind="stable")  # within a bucket by class, as before
                bucket, code, owner = bucket[order], code[order], owner[order]
                cut = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
                low = code.view(np.uint8).reshape(-1, 8)[:, :LOW // 8]
                columns = [[], [], [], [], []]
                for a, b in zip(cut[:-1], cut[1:]):
                    who, count = np.unique(owner[a:b], return_counts=True)
                    for column, value in zip(columns, (
                            int(bucket[a]), names[who].tobytes(), sizes[who].astype("<u4").tobytes(),
                            count.astype("<u4").tobytes(), low[a:b].tobytes())):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                    names=["bucket", "classes", "sizes", "counts", "low"])

    return docs.select("text").mapInArrow(
        run, "bucket long, classes binary, sizes binary, counts binary, low binary")


def _unpacked(column, kind, width=1) -> np.ndarray:
    joined = b"".join(v.as_py() for v in column)
    return np.frombuffer(joined, kind) if width == 1 else np.frombuffer(joined, kind).reshape(-1, width)


def _shared(dealt: DataFrame, buckets: int) -> DataFrame:
    """A row for every shingle of a class that another class has too: the class, the size of its set,
    the shingle's code, and how many classes have it (65534 at most; 65535 for the frequent ones)."""
    schema = pa.schema([("class", pa.int64()), ("n", pa.int32()), ("code", pa.int64()), ("often", pa.int32())])

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        names, sizes = _unpacked(table.column("classes"), np.int64), _unpacked(table.column("sizes"), "<u4")
        counts = _unpacked(table.column("counts"), "<u4").astype(np.int64)
        low = _unpacked(table.column("low"), np.uint8, LOW // 8)
        first = np.zeros(len(names), bool)
        first[np.unique(names, return_index=True)[1]] = True  # copies in several parts: once
        kept = np.repeat(first, counts)
        names, sizes, counts = names[first], sizes[first].astype(np.int32), counts[first]
        code = np.zeros((int(kept.sum()), 8), np.uint8)
        code[:, :LOW // 8] = low[kept]
        code = code.reshape(-1).view(np.uint64)
        if bucket >= buckets:
            code = code | np.uint64(1 << 63)
            often = np.full(len(code), 65535, np.int32)
        else:
            order = np.argsort(code, kind="stable")
            run_start = np.flatnonzero(np.concatenate(([True], np.diff(code[order]) != 0)))
            times = np.diff(np.append(run_start, len(code)))
            often = np.empty(len(code), np.int32)
            often[order] = np.repeat(np.minimum(times, 65534), times)
            code = code * np.uint64(buckets) + np.uint64(bucket)
        shared = often > 1
        return pa.table([pa.array(np.repeat(names, counts)[shared]), pa.array(np.repeat(sizes, counts)[shared]),
                         pa.array(code[shared].view(np.int64)), pa.array(often[shared])], schema=schema)

    return dealt.groupBy("bucket").applyInArrow(run, "class long, n int, code long, often int")


def _ordered(shared: DataFrame) -> DataFrame:
    """Classes that can have a similar one: n, their shared shingles rarest first, and how many of
    the first are to be joined on."""

    def ordered(rows: list[np.ndarray]) -> pa.RecordBatch:
        name, n, code, often = rows
        order = np.lexsort((code.view(np.uint64), often, name))
        name, n, code = name[order], n[order].astype(np.int64), code[order]
        start = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        held, n = np.diff(np.append(start, len(name))), n[start]
        needed = (n * PERCENT + 99) // 100  # what a set has in common with any similar one, at least
        prefix = n - needed + 1 - (n - held)  # those that no other class has come first
        able = (held >= needed) & (prefix > 0)
        offsets = np.concatenate(([0], np.cumsum(held[able]))).astype(np.int32)
        codes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(code[np.repeat(able, held)]))
        return pa.RecordBatch.from_arrays(
            [pa.array(name[start][able]), pa.array(n[able]), codes, pa.array(prefix[able].astype(np.int32))],
            names=["class", "n", "codes", "prefix"])

    def run(batches):
        waiting: list[list[np.ndarray]] = []  # rows of one class so far
        for batch in batches:
            rows = [np.asarray(c) for c in batch.columns]
            if not len(rows[0]):
                continue
            whole = int(np.searchsorted(rows[0], rows[0][-1]))
            if waiting and (whole or waiting[0][0][0] != rows[0][0]):
                waiting.append([c[:whole] for c in rows])
                yield ordered([np.concatenate(c) for c in zip(*waiting)])
                waiting = []
            elif whole:
                yield ordered([c[:whole] for c in rows])
            waiting.append([c[whole:] for c in rows])
        if waiting:
            yield ordered([np.concatenate(c) for c in zip(*waiting)])

    return shared.repartition("class").sortWithinPartitions("class").mapInArrow(
        run, "class long, n long, codes array<long>, prefix int")


def _postings(sets: DataFrame) -> DataFrame:
    """A row for each shingle to join on: its place in the whole order, and how many of the
    class's shingles after it fall in each range of hashes."""

    def run(batches):
        for batch in batches:
            columns = [[], [], [], [], []]
            for name, n, codes, prefix in zip(*(batch.column(k).to_pylist() for k in (
                    "class", "n", "codes", "prefix"))):
                codes = np.array(codes, np.int64)
                ranges = (scrambled(codes.view(np.uint64)) >> np.uint64(61)).astype(np.int64)
                after = np.zeros((len(codes) + 1, RANGES), np.int32)
                after[np.arange(len(codes)), ranges] = 1
                after = after[::-1].cumsum(axis=0)[::-1]
                for column, value in zip(columns, (
                        codes[:prefix], np.full(prefix, name), np.full(prefix, n),
                        n - len(codes) + np.arange(prefix), after[1:prefix + 1])):
                    column.append(value)
            if columns[0]:
                flat = [np.concatenate(c) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c.astype(np.int64)) for c in flat[:4]),
                     pa.FixedSizeListArray.from_arrays(pa.array(flat[4].reshape(-1)), RANGES).cast(
                         pa.list_(pa.int32()))], names=["code", "class", "n", "place", "after"])

    return sets.mapInArrow(run, "code long, class long, n long, place long, after array<int>")


def _may_be_similar() -> Column:
    """Length, positional and suffix filter for a pair that shares the shingle of its row, if that
    is the first that it shares."""
    n, m = F.col("n"), F.col("other.n")
    needed = F.ceil((n + m) * PERCENT / (100 + PERCENT))
    length = (100 * F.least(n, m)) >= PERCENT * F.greatest(n, m)
    place = 1 + F.least(n - F.col("place") - 1, m - F.col("other.place") - 1) >= needed
    suffix = 1 + F.aggregate(
        F.zip_with("after", F.col("other.after"), lambda x, y: F.least(x, y)), F.lit(0), lambda a, x: a + x) >= needed
    return length & place & suffix


def _pairs(many: DataFrame, few: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of classes of different components that share a code and pass. The rows
    in `many` of a frequent code are dealt to several tasks, and each of them gets those in `few`."""
    tasks = F.ceil(F.col("in_all") / SALT_ROWS).cast("int")
    salted = many.withColumn("salt", F.pmod(F.xxhash64("class"), tasks).cast("int"))
    other = few.select("code", F.explode(F.sequence(F.lit(0), tasks - 1)).alias("salt"),
                       F.struct("class", "comp", "n", "place", "after").alias("other"))
    hit = salted.join(other, ["code", "salt"]).where(
        (F.col("comp") != F.col("other.comp")) & _may_be_similar())
    return hit.select(F.least("class", "other.class").alias("a"),
                      F.greatest("class", "other.class").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("codes").alias("codes_a"))
    two = sets.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("codes").alias("codes_b"))
    both = F.size(F.array_intersect("codes_a", "codes_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", both.alias("both")).where(
        100 * F.col("both") >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after the links (a, b) have joined their components."""
    ends = [labels.select(F.col("class").alias(c), F.col("comp").alias(f"comp_{c}")) for c in ("a", "b")]
    between = links.join(ends[0], "a").join(ends[1], "b").select(
        F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).where("a != b")
    moved = connect(between).select(F.col("class").alias("comp"), F.col("comp").alias("to"))
    return land(labels.join(moved, "comp", "left").select(
        "class", F.coalesce("to", "comp").alias("comp")), "labels")


def _hubs(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Codes whose classes are in several components: how many pairs are left, and up to `most`
    rows of the largest component of each. A low place in the order means that a class has few
    shingles of its own, as the text that others were copied from, so low places come first."""
    per = rows.groupBy("code", "comp").agg(F.count(F.lit(1)).alias("k"), (-F.min("place")).alias("near"))
    size = F.struct("k", "near", "comp")
    codes = land(per.groupBy("code").agg(
        F.sum("k").alias("k"), F.sum(F.col("k").cast("double") * F.col("k")).alias("squares"),
        F.max(size).alias("top"), F.count(F.lit(1)).alias("comps")).where("comps > 1").select(
        "code", "k", ((F.col("k").cast("double") * F.col("k") - F.col("squares")) / 2).alias("pairs"),
        F.col("top.comp").alias("comp")), "codes")
    # Of a frequent shingle only so many classes are kept, before and after the shuffle.
    nth = F.row_number().over(Window.partitionBy("code").orderBy("place", "class"))
    top = rows.join(codes.select("code", "comp"), ["code", "comp"]).withColumn("nth", nth).where(
        F.col("nth") <= most)
    return codes, top.select("code", "class", "comp", "n", "place", "after")


def components(sets: DataFrame) -> DataFrame:
    """class, comp (the smallest class of its component) of the classes in sets."""
    postings = land(_postings(sets), "postings")
    labels = land(sets.select("class", F.col("class").alias("comp")), "labels")
    checked, hubs = None, HUBS
    rows = postings.withColumn("comp", F.col("class"))
    while True:
        codes, top = _hubs(rows, hubs)
        left = codes.agg(F.sum("pairs").alias("pairs"), F.sum("k").alias("rows")).first()
        if not left["rows"]:
            return labels
        known = codes.select("code", F.col("k").alias("in_all"), F.col("comp").alias("largest"), "k")
        going = join_by_key(rows, known, "code", "k", left["rows"])
        # Few pairs are left: verify them all. Else the rare shingles, and the hubs of the others.
        last = left["pairs"] <= FEW_PAIRS * left["rows"] and hubs > HUBS
        if last:
            # Of two components one is not the largest: no more than twice what is left is compared.
            pairs = _pairs(going, going.where("comp != largest"))
        else:
            rare = going.where(F.col("in_all") <= RARE)
            frequent_ = going.where(F.col("in_all") > RARE)
            pairs = _pairs(rare, rare).unionAll(_pairs(
                frequent_, top.join(codes.select("code", F.col("k").alias("in_all")), "code"))).distinct()
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = land(pairs, "pairs")
        labels = _joined(labels, land(_verified(pairs, sets), "links"))
        if last:
            return labels
        checked = pairs if checked is None else checked.unionAll(pairs)
        rest = frequent_.join(top.select("code", "class"), ["code", "class"], "left_anti")
        rows = land(rest.drop("comp", "in_all", "largest").join(labels, "class"), "postings")
        hubs *= 4


def _components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names of the sets, by row, and of each set its component (`comp`), landed."""
    names = land(set_names(docs), "names")
    total = names.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))
    hot = docs.sparkSession.sparkContext.broadcast(frequent(names))
    sets = land(_ordered(_shared(_dealt(docs, hot, buckets), buckets)), "sets")
    unit = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "unit"))
    classes = names.where("n_shingles > 0").groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), unit.alias("first"))
    known = classes.join(components(sets), "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    return names, land(known, "classes")


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    names, known = _components(docs)
    per = land(known.groupBy("comp").agg(
        F.min("least").alias("component_id"), F.count(F.lit(1)).alias("classes")), "components")
    classes = land(join_by_key(known.select("class", "comp", "n"), per, "comp", "classes").select(
        "class", "n", "component_id"), "members")
    linked = join_by_key(names.where("n_shingles > 0"), classes, "class", "n")
    alone = names.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies, with all columns as they are: the one with the
    smallest id (rows without an id come last), and of rows alike in id and text any one. Documents
    without words are alone and stay."""
    names, known = _components(docs)
    first = known.groupBy("comp").agg(F.min("first").alias("first")).select("first.unit")
    copies = names.where("n_shingles > 0").groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
    first = land(first.join(copies, "unit").withColumn("copies", F.col("n")), "firsts")
    key, repeated = (_unused(name, docs.columns) for name in ("unit", "copies"))
    first = first.withColumnsRenamed({"unit": key, "copies": repeated, "n": f"{repeated}_n"})
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.where(worded).withColumn(key, unit_of("doc_id", "text"))
    kept = join_by_key(keyed, first, key, f"{repeated}_n")
    own = [F.col(f"`{c}`") for c in docs.columns]
    alike = kept.where(F.col(repeated) > 1).groupBy(key).agg(F.any_value(F.struct(*own)).alias("row")).select("row.*")
    return kept.where(F.col(repeated) == 1).select(*own).unionByName(alike).unionByName(docs.where(~worded))


def unit_of(doc_id: str, text: str) -> Column:
    """16 bytes that tell rows of different id or text apart."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.col(text))))


def _unused(name: str, columns: list[str]) -> str:
    while any(c.lower().startswith(name.lower()) for c in columns):
        name = f"_{name}"
    return name
