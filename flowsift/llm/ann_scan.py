"""Nearest neighbours by inverted lists and an adaptive scan of dimensions.

Largest inner product becomes least distance by one more dimension that makes all vectors equally
long. Vectors are rotated at random, so that a few leading dimensions say much about the whole
distance. Centroids are fitted on a bounded sample; every distinct vector goes to its nearest
list. A query scans its nearest lists block of columns by block of columns and abandons a
candidate as soon as a hypothesis test on the partial distance says that it is farther than the
worst neighbour held. What survives is scored exactly on the original vectors.

How many lists a query needs depends on the vectors and on their number, so it is measured: the
neighbours of a bounded set of the queries are found by brute force over all rows, and probes, up to
all lists, and if need be the test's strictness are raised until enough of them are found.

Equal vectors are one candidate with its smallest ids, and equal queries are searched once, so a
vector with a third of all rows costs as much as any other. Groups of lists and their queries are
dealt out in blocks of bounded size.

Cases: vectors that are null, zero, or hold a null or non-finite component take no part; nor do
vectors of another length than the most frequent one; ties go to the smaller id; fewer candidates
than k give fewer rows; repeated rows (same id and vector) are one candidate; an empty table gives
no rows; other columns of the input are left out.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowsift.llm.scratch import land

#: Vectors the centroids are fitted on, at most; vectors per list aimed at; lists at most.
SAMPLE = 20_000
LIST_SIZE = 256
MAX_LISTS = 4_096
#: Share of the lists a query scans, and how many at least; more where the measured recall asks for it.
PROBE_SHARE = 0.1
LEAST_PROBES = 16
#: Queries that recall is measured on, and the recall that must be reached less two standard errors.
TRIED = 256
WANTED = 0.95
#: Lists that are dealt out together; rows of such a group, and queries, in one block. Every query
#: gets k + 1 candidates from each block of rows that it meets, so those are the larger ones.
GROUP = 64
BLOCK = 16_384
ASKERS = 2_048
#: Columns compared between two tests, and the test's strictness: larger loses fewer neighbours.
COLUMNS = 16
EPSILON = 2.1


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and vector (array of double) of the rows that take part."""
    v = F.col("vec")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    good = rows.where(F.col("id").isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(v, lambda x: x != 0))
    lengths = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return good.where(F.size("vec") == (lengths[0]["n"] if lengths else 0))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: vec, its `keep` smallest ids in order, the smallest as class."""
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.distinct().withColumn("nth", nth).where(F.col("nth") <= keep)
    ids = F.sort_array(F.collect_list("id"))
    return few.groupBy("vec").agg(ids.alias("ids")).withColumn("class", F.col("ids")[0])


def rotation(size: int, seed: int = 42) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """One more dimension, so that all candidates have the same length."""
    rest = np.sqrt(np.maximum(longest ** 2 - (x * x).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def centroids(x: np.ndarray, n: int, rounds: int = 12, seed: int = 42) -> np.ndarray:
    """Plain k-means; an empty list takes a random vector."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), n, replace=False)]
    for _ in range(rounds):
        own = nearest(x, c, 1)[:, 0]
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=n)
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], x[rng.choice(len(x), n)])
    return c


def nearest(x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centroids of each row, in no order. All of them if n is their number."""
    out, half = np.empty((len(x), n), np.int64), (c * c).sum(axis=1) / 2
    for i in range(0, len(x), 1024):
        far = half - x[i:i + 1024] @ c.T
        out[i:i + 1024] = np.argpartition(far, n - 1, axis=1)[:, :n] if n < len(c) else np.arange(len(c))
    return out


def scan(query: np.ndarray, rows: np.ndarray, k: int, columns: int = COLUMNS,
         epsilon: float = EPSILON) -> np.ndarray:
    """Rows that may be among the k nearest of a rotated query, nearly equal distances included.

    A candidate whose distance over the first d of D dimensions, scaled by D / d, is beyond the
    k-th best by more than the test allows is abandoned; the others go on to the next columns."""
    size = rows.shape[1]
    held_at, held = np.empty(0, np.int64), np.empty(0)
    for start in range(0, len(rows), 512):
        at = np.arange(start, min(start + 512, len(rows)))
        far = np.zeros(len(at))
        worst = np.partition(held, k - 1)[k - 1] if len(held) >= k else np.inf
        for d in range(0, size, columns):
            step = rows[at, d:d + columns] - query[d:d + columns]
            far += np.einsum("ij,ij->i", step, step)
            done = min(d + columns, size)
            if np.isfinite(worst):
                limit = worst * (1 + epsilon / np.sqrt(done)) ** 2 * done / size if done < size else worst
                going = far <= limit + 1e-9 * (1 + worst)
                at, far = at[going], far[going]
            if not len(at):
                break
        held_at, held = np.concatenate([held_at, at]), np.concatenate([held, far])
    if len(held) > k:
        held_at = held_at[held <= np.partition(held, k - 1)[k - 1] * (1 + 1e-9) + 1e-9]
    return held_at


def search(df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           probe_share: float = PROBE_SHARE, least_probes: int = LEAST_PROBES) -> DataFrame:
    """For each row of queries (same columns) its k nearest rows of df other than itself: query_id,
    rank from 1, id_col, score (inner product of the original vectors)."""
    spark = df.sparkSession
    base = vectors(df, id_col, vec_col)
    found = land(classes(base, k + 1), "vectors")
    size_row = found.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x * x)).alias("longest")).first()
    wanted = vectors(queries, id_col, vec_col).distinct()
    empty = f"query_id long, rank int, {id_col} long, score double"
    if not size_row["n"]:
        return spark.createDataFrame([], empty)
    index = _index(found, size_row["n"], float(np.sqrt(size_row["longest"])))
    shared = spark.sparkContext.broadcast(index)  # bounded by MAX_LISTS
    n_lists = len(index["centroids"])
    least = min(n_lists, max(least_probes, round(probe_share * n_lists)))

    in_list = land(_listed(found, shared), "lists")
    queries_of = found.select("vec", "class").join(wanted, "vec").select(F.col("id").alias("query_id"), "class", "vec")
    queries_of = land(queries_of, "queries")
    asking = queries_of.select("class", "vec").distinct()
    probes, epsilon = _effort(in_list, asking, index, k, least)
    probing = land(_probing(asking, shared, probes), "probes")

    blocks = in_list.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    asked = probing.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / ASKERS).cast("int").alias("askers"))
    sizes = F.broadcast(blocks.join(asked, "group"))  # a row per group, MAX_LISTS / GROUP at most

    def dealt(rows, own, other):
        return rows.join(sizes, "group").withColumn(
            own, F.pmod(F.xxhash64("class"), F.col(own + "s")).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1)))

    keys = ["group", "block", "asker"]
    left = dealt(in_list, "block", "asker").select(*keys, "list", "class", "ids", "vec")
    right = dealt(probing, "asker", "block").select(*keys, "lists", "class", "vec")
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _scanner(shared, k, epsilon), "query long, class long, ids array<long>, score double")

    best = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    few = near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    by_id = few.select("query", "score", F.explode("ids").alias("id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    tops = by_id.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    lists = tops.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("near"))
    answered = queries_of.select("query_id", "class").join(lists, F.col("class") == F.col("query"))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return answered.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias(id_col), "hit.score")


def _index(found: DataFrame, n: int, longest: float) -> dict:
    """Rotation and centroids, from a sample chosen by a hash of the class."""
    rows = found.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("vec").toArrow()
    x = lengthened(_matrix(rows.column("vec")), longest)
    turn = rotation(x.shape[1])
    n_lists = int(min(max(1, n // LIST_SIZE), MAX_LISTS, len(x)))
    return {"turn": turn, "longest": longest, "centroids": centroids(x @ turn, n_lists)}


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _listed(rows: DataFrame, shared) -> DataFrame:
    """class, ids and vec with the nearest list and its group."""
    def run(batches):
        index = shared.value
        for batch in batches:
            if not len(batch):
                continue
            x = lengthened(_matrix(batch.column("vec")), index["longest"])
            lists = nearest(x @ index["turn"], index["centroids"], 1)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(lists // GROUP), pa.array(lists), *batch.columns],
                                             names=["group", "list", *batch.schema.names])

    return rows.select("class", "ids", "vec").mapInArrow(
        run, "group long, list long, class long, ids array<long>, vec array<double>")


def _turned(queries: np.ndarray, index: dict) -> np.ndarray:
    """Queries have 0 in the dimension that makes candidates equally long."""
    return np.pad(queries, ((0, 0), (0, 1))) @ index["turn"]


def _effort(in_list: DataFrame, asking: DataFrame, index: dict, k: int, least: int) -> tuple[int, float]:
    """Lists to probe, `least` of them or more, and epsilon, so that the recall is WANTED.

    A neighbour found by brute force is held for lost if its list is not among the probed ones or if
    it would be abandoned against the distance of the true k-th; the scan never knows a smaller one."""
    n_lists, spark = len(index["centroids"]), in_list.sparkSession
    tried = asking.orderBy(F.xxhash64("class"), "class").limit(TRIED).toArrow()
    if not len(tried) or least == n_lists and index["turn"].shape[0] <= COLUMNS:  # nothing can be lost
        return least, EPSILON
    names, q = np.asarray(tried.column("class")), _matrix(tried.column("vec"))
    best = _brute(in_list, spark.sparkContext.broadcast(q), k + 1)  # TRIED times k + 1 rows
    rows = in_list.join(F.broadcast(spark.createDataFrame(best, "query int, class long")), "class").select(
        "query", "class", "list", F.size("ids").alias("n"), "vec").toArrow()
    asker, own, n = (np.asarray(rows.column(c)) for c in ("query", "class", "n"))
    x, turned = _matrix(rows.column("vec")), _turned(q, index)
    far = (index["centroids"] ** 2).sum(axis=1) / 2 - turned @ index["centroids"].T
    place = np.argsort(np.argsort(far, axis=1, kind="stable"), axis=1)[asker, np.asarray(rows.column("list"))]
    strict = _strictness(turned[asker], lengthened(x, index["longest"]) @ index["turn"], asker, k + 1)
    score = (x * q[asker]).sum(axis=1)
    n = n - (own == names[asker])  # a row is no neighbour of its own
    at = np.lexsort((own, -score, asker))
    share = np.zeros(len(n))  # of the k neighbours of its query
    for i in range(len(q)):
        mine = at[asker[at] == i]
        counted = np.minimum(np.cumsum(n[mine]), k)
        share[mine] = np.diff(counted, prepend=0) / max(counted[-1], 1)
    asked = np.unique(asker[share > 0])

    def safe(probes: int, epsilon: float) -> bool:
        hit = np.bincount(asker, share * ((place < probes) & (strict <= epsilon)), len(q))[asked]
        return not len(hit) or hit.mean() - 2 * hit.std() / np.sqrt(len(hit)) >= WANTED

    epsilon = next(e for e in (EPSILON, 2 * EPSILON, 4 * EPSILON, 1e6) if e == 1e6 or safe(n_lists, e))
    return least + bisect_left(range(least, n_lists), True, key=lambda p: safe(p, epsilon)), epsilon


def _strictness(queries: np.ndarray, rows: np.ndarray, asker: np.ndarray, k: int) -> np.ndarray:
    """The least epsilon at which scan() keeps each row, if it knew the k-th distance of its query."""
    size = rows.shape[1]
    far = np.cumsum((rows - queries) ** 2, axis=1)
    worst = np.zeros(asker.max() + 1)
    np.maximum.at(worst, asker, far[:, -1])
    worst[np.bincount(asker) < k] = np.inf
    out = np.zeros(len(rows))
    for done in range(COLUMNS, size, COLUMNS):
        part = far[:, done - 1] * size / done / np.maximum(worst[asker], 1e-300)
        out = np.maximum(out, np.where(far[:, done - 1] > 1e-9, (np.sqrt(part) - 1) * np.sqrt(done), 0))
    return out


def _brute(rows: DataFrame, shared, k: int) -> list[tuple[int, int]]:
    """Number and class of the k largest inner products of each query, over all rows."""
    def run(batches):
        q = shared.value
        score, own = np.full((len(q), k), -np.inf), np.zeros((len(q), k), np.int64)
        for batch in batches:
            for i in range(0, len(batch), 4_096):
                part = batch.slice(i, 4_096)
                score = np.concatenate([score, q @ _matrix(part.column("vec")).T], axis=1)
                own = np.concatenate([own, np.broadcast_to(np.asarray(part.column("class")), (len(q), len(part)))], axis=1)
                top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                score, own = np.take_along_axis(score, top, 1), np.take_along_axis(own, top, 1)
        query, at = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(own[query, at]),
                                          pa.array(score[query, at])], names=["query", "class", "score"])

    near = rows.select("class", "vec").mapInArrow(run, "query int, class long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    tops = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
    return [(r["query"], r["class"]) for r in tops.select("query", "class").collect()]


def _probing(asking: DataFrame, shared, probes: int) -> DataFrame:
    """Each query with its nearest lists, a row per group of lists."""
    def run(batches):
        index = shared.value
        for batch in batches:
            for start in range(0, len(batch), step):
                part = batch.slice(start, step)
                lists = nearest(_turned(_matrix(part.column("vec")), index), index["centroids"], probes).ravel()
                row = np.repeat(np.arange(len(part)), probes)
                order = np.lexsort((lists, row))
                lists, key = lists[order], row[order] * n_groups + lists[order] // GROUP
                first = np.flatnonzero(np.diff(key, prepend=-1))
                ends = pa.array(np.append(first, len(key)).astype(np.int32))
                taken = part.take(pa.array(row[order][first]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[first] % n_groups), pa.ListArray.from_arrays(ends, pa.array(lists)),
                     *taken.columns], names=["group", "lists", *taken.schema.names])

    n_groups, step = MAX_LISTS // GROUP + 1, max(1, 500_000 // probes)
    return asking.select("class", "vec").mapInArrow(
        run, "group long, lists array<long>, class long, vec array<double>")


def _scanner(shared, k: int, epsilon: float):
    fields = pa.schema([("query", pa.int64()), ("class", pa.int64()), ("ids", pa.list_(pa.int64())),
                        ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return fields.empty_table()
        index = shared.value
        x, q = _matrix(left.column("vec")), _matrix(right.column("vec"))
        rows = lengthened(x, index["longest"]) @ index["turn"]
        turned = _turned(q, index)
        classes_, lists = np.asarray(left.column("class")), np.asarray(left.column("list"))
        order = np.lexsort((classes_, lists))  # the same answer for any order of rows
        x, rows, classes_, lists = x[order], rows[order], classes_[order], lists[order]
        queries, taken, scores = [], [], []
        for i, (name, asked) in enumerate(zip(right.column("class").to_pylist(), right.column("lists").to_pylist())):
            own = np.concatenate([np.arange(*np.searchsorted(lists, [n, n + 1])) for n in asked])
            at = own[scan(turned[i], rows if len(own) == len(rows) else rows[own], k + 1, epsilon=epsilon)]
            score = (x[at] * q[i]).sum(axis=1)
            first = np.lexsort((classes_[at], -score))[:k + 1]
            queries += [name] * len(first)
            taken.append(at[first])
            scores.append(score[first])
        taken = np.concatenate(taken)
        return pa.table([pa.array(queries, pa.int64()), pa.array(classes_[taken]),
                         left.column("ids").combine_chunks().take(pa.array(order[taken])),
                         pa.array(np.concatenate(scores))], schema=fields)

    return run
