"""Alignment of two tokenizers' tokens over the same texts.

Both tokenizers cut the bytes of " " + text: A is a byte-level rank vocabulary, B a piece model,
which puts the blank there itself. An interval of bytes whose ends are token ends of both sides is
divided and conquered: among the ends of its A tokens the one nearest to the middle that bisecting
finds among the ends of B cuts it in two, and both halves are handled likewise; an interval in
which no such end is found is a group. All intervals of one depth, of all texts of a part, are
looked at together, in windows around their middles that double until an end is found.

Tokens that share a byte are linked. How many documents hold an id pair linked is counted by a
grouped sum over what each task has added up. The counts are held against the documents in slices
of A ids that are counted first, so what is broadcast is bounded at every corpus size; each slice
reads only its part of the documents' pairs.

Cases: a null or empty text, and one whose tokens do not give back its bytes, has no tokens, zeros
and an empty hash; strings of special tokens are plain text; very long texts are handled whole;
rows that repeat an id, or have none, are rows of their own and count as documents of their own; an
empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.scratch import land
from flowsift.llm.textbytes import flat, parts
from flowsift.llm.token_ids import rank_encoder

#: Bytes of text, and pairs of ids, handled at once.
PART_BYTES = 1_500_000
PART_PAIRS = 4_000_000
#: Id pairs of one broadcast slice: 13 bytes each.
SLICE_PAIRS = 8_000_000

_READY: dict[tuple[str, str], "Tokenizers"] = {}


class Table:
    """The bytes of every id, in one buffer."""

    def __init__(self, entries: list[bytes]) -> None:
        self.length = np.array([len(e) for e in entries], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.length)))[:-1]
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        texts = [str(i).encode() for i in range(len(entries))]
        #: Decimal ids with the mark behind them: within a group, and at the end of its side.
        self.inner = [t + b"," for t in texts]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        first = np.cumsum(length) - length
        return self.data[np.repeat(self.start[ids] - first, length) + np.arange(length.sum())]


class Tokenizers:
    """Both tokenizers and what they write for each id; one instance per worker process."""

    def __init__(self, path_a: str, path_b: str, pattern: str) -> None:
        import sentencepiece

        self.a = rank_encoder(path_a, pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.table_a = Table([self._entry(i) for i in range(self.a.n_vocab)])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.table_b = Table([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                              for i, p in enumerate(pieces)])
        a, b = len(self.table_a.length), len(self.table_b.length)
        #: Ids of A inside and at the end of their side of a group, then those of B.
        self.written = (self.table_a.inner + [t[:-1] + b"|" for t in self.table_a.inner]
                        + self.table_b.inner + [t[:-1] + b";" for t in self.table_b.inner])
        self.base = (0, a, 2 * a, 2 * a + b)

    def _entry(self, i: int) -> bytes:
        try:
            return self.a.decode_single_token_bytes(i)
        except KeyError:  # a number that the file leaves free
            return b""


def tokenizers(path_a: str, path_b: str, pattern: str) -> Tokenizers:
    if (path_a, path_b) not in _READY:
        _READY[path_a, path_b] = Tokenizers(path_a, path_b, pattern)
    return _READY[path_a, path_b]


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of tokens, in order: for each the number of A tokens, and of B tokens, up to its end.

    ends_a, ends_b are rising ends of all tokens; a, b bound the texts: text k has the tokens
    a[k] to a[k + 1] and b[k] to b[k + 1], none of them empty, and both sides end alike."""
    lo, hi, low, high = a[:-1], a[1:], b[:-1], b[1:]
    done_a, done_b = [], []
    while len(lo):
        cut, at = _middle_cut(ends_a, ends_b, lo, hi, low, high)
        leaf = cut < 0
        done_a.append(hi[leaf])
        done_b.append(high[leaf])
        lo, hi, low, high, cut, at = (x[~leaf] for x in (lo, hi, low, high, cut, at))
        lo, hi = np.concatenate((lo, cut)), np.concatenate((cut, hi))
        low, high = np.concatenate((low, at)), np.concatenate((at, high))
    if not done_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.sort(np.concatenate(done_a)), np.sort(np.concatenate(done_b))


def _middle_cut(ends_a, ends_b, lo, hi, low, high) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the A and B tokens before the shared end nearest to its middle; -1: none."""
    cut, at = np.full(len(lo), -1, np.int64), np.full(len(lo), -1, np.int64)
    open_ = np.flatnonzero((hi - lo > 1) & (high - low > 1))
    middle = (lo + hi - 2) // 2  # the last token ends with the interval
    near, far = 0, 1
    while len(open_):
        # Tokens at a distance of near to far - 1 from the middle, on both sides, nearest first.
        steps = np.repeat(np.arange(near, far), 2) * np.tile([1, -1], far - near)
        steps = steps if near else steps[1:]
        token = middle[open_][:, None] + steps
        inside = (token >= lo[open_][:, None]) & (token < hi[open_][:, None] - 1)
        row, col = np.nonzero(inside)
        end = ends_a[token[row, col]]
        found_at = np.searchsorted(ends_b, end)
        same = ends_b[np.minimum(found_at, len(ends_b) - 1)] == end
        row, col, found_at = row[same], col[same], found_at[same]
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else row
        cut[open_[row[first]]] = token[row[first], col[first]] + 1
        at[open_[row[first]]] = found_at[first] + 1
        reach = np.maximum(middle - lo, hi - 2 - middle)[open_]
        open_ = open_[(cut[open_] < 0) & (reach >= far)]
        near, far = far, 2 * far
    return cut, at


@dataclass
class Aligned:
    """Tokens of a part of the texts; text k has the tokens a[k] to a[k + 1] of side A, and so on."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray  # tokens of A up to the end of each group
    group_b: np.ndarray
    groups: np.ndarray  # groups before each text, and in all
    link_a: np.ndarray  # token of A, token of B of every link, by A and then by B
    link_b: np.ndarray
    links: np.ndarray


def align_part(texts: list[str | None], tools: Tokenizers) -> Aligned:
    ids_a, ids_b = [], []
    with_text = [k for k, t in enumerate(texts) if t]
    of_b = tools.b.encode([texts[k] for k in with_text], num_threads=1)
    a, b = np.zeros(len(texts) + 1, np.int64), np.zeros(len(texts) + 1, np.int64)
    for k, own_b in zip(with_text, of_b):
        ids_a.append(np.array(tools.a.encode_ordinary(" " + texts[k]), np.int64))
        ids_b.append(np.array(own_b, np.int64))
        a[k + 1], b[k + 1] = len(ids_a[-1]), len(ids_b[-1])
    all_a = np.concatenate(ids_a) if ids_a else np.empty(0, np.int64)
    all_b = np.concatenate(ids_b) if ids_b else np.empty(0, np.int64)
    true = [np.frombuffer((" " + texts[k]).encode(), np.uint8) for k in with_text]
    fits = _gives_back(true, all_a, a[1:][with_text], tools.table_a) & _gives_back(
        true, all_b, b[1:][with_text], tools.table_b)
    if not fits.all():
        all_a = np.concatenate([x for x, ok in zip(ids_a, fits) if ok] or [np.empty(0, np.int64)])
        all_b = np.concatenate([x for x, ok in zip(ids_b, fits) if ok] or [np.empty(0, np.int64)])
        odd = np.array(with_text, np.int64)[~fits] + 1
        a[odd] = b[odd] = 0
    a, b = np.cumsum(a), np.cumsum(b)
    ends_a, ends_b = np.cumsum(tools.table_a.length[all_a]), np.cumsum(tools.table_b.length[all_b])
    some = np.flatnonzero(np.diff(a))
    group_a, group_b = shared_cuts(ends_a, ends_b, np.append(a[some], a[-1]), np.append(b[some], b[-1]))
    first = np.searchsorted(ends_b, ends_a - tools.table_a.length[all_a], "right")
    count = np.searchsorted(ends_b, ends_a, "left") - first + 1
    link_a = np.repeat(np.arange(len(all_a)), count)
    before = np.concatenate(([0], np.cumsum(count)))
    link_b = np.repeat(first - before[:-1], count) + np.arange(before[-1])
    return Aligned(all_a, all_b, a, b, group_a, group_b, np.searchsorted(group_a, a, "right"), link_a, link_b,
                   before[a])


def _gives_back(true: list[np.ndarray], ids: np.ndarray, counts: np.ndarray, table: Table) -> np.ndarray:
    """Whether the tokens of each text join to its bytes."""
    sizes = np.array([len(t) for t in true], np.int64)
    before = np.concatenate(([0], np.cumsum(table.length[ids])))
    ends = np.concatenate(([0], np.cumsum(counts)))
    same = np.diff(before[ends]) == sizes
    whole = np.flatnonzero(same)
    if len(whole):
        keep = np.repeat(same, counts)
        written = table.bytes_of(ids[keep])
        differ = written != np.concatenate([true[k] for k in whole])
        wrong = np.add.reduceat(differ, np.concatenate(([0], np.cumsum(sizes[whole])[:-1])), dtype=np.int64) > 0
        same[whole[wrong]] = False
    return same


def written_groups(part: Aligned, tools: Tokenizers) -> Iterator[bytes]:
    """`a1,a2|b1;a3|b2,b3` of each text; nothing for a text without tokens."""
    n = len(part.group_a)
    in_a, in_b = np.diff(part.group_a, prepend=0), np.diff(part.group_b, prepend=0)
    order = np.empty(len(part.ids_a) + len(part.ids_b), np.int64)
    codes_a, codes_b = part.ids_a + tools.base[0], part.ids_b + tools.base[2]
    codes_a[part.group_a - 1] += tools.base[1] - tools.base[0]
    codes_b[part.group_b - 1] += tools.base[3] - tools.base[2]
    order[np.arange(len(codes_a)) + np.repeat(part.group_b - in_b, in_a)] = codes_a
    order[np.arange(len(codes_b)) + np.repeat(part.group_a, in_b)] = codes_b
    assert n == part.groups[-1]
    for k in range(len(part.a) - 1):
        own = order[part.a[k] + part.b[k]:part.a[k + 1] + part.b[k + 1]].tolist()
        yield b"".join(map(tools.written.__getitem__, own))[:-1]


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """doc_id, the ids of both sides, and for each group how many of them it ends with: ids_a,
    ids_b, group_a, group_b (arrays)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tools = tokenizers(path_a, path_b, pattern)
        for ids, part in _aligned(batches, tools):
            columns = []
            for values, ends in ((part.ids_a, part.a), (part.ids_b, part.b)):
                columns.append(pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(values, pa.int32())))
            n = np.diff(part.groups)
            for values, ends in ((part.group_a, part.a), (part.group_b, part.b)):
                columns.append(pa.ListArray.from_arrays(
                    part.groups.astype(np.int32), pa.array(values - np.repeat(ends[:-1], n), pa.int32())))
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "ids_a", "ids_b", "group_a", "group_b"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, ids_a array<int>, ids_b array<int>, group_a array<int>, group_b array<int>")


def _aligned(batches, tools: Tokenizers) -> Iterator[tuple[pa.Array, Aligned]]:
    for batch in batches:
        for row, end, _, _ in parts(batch.column(1), PART_BYTES):
            yield batch.column(0).slice(row, end - row), align_part(
                batch.column(1).slice(row, end - row).to_pylist(), tools)


def _distinct_pairs(part: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id pairs (A above 32 bits, B below) that each text links, how often, and the texts' ends."""
    texts = len(part.links) - 1
    pair = (part.ids_a[part.link_a].astype(np.uint64) << np.uint64(32)) | part.ids_b[part.link_b].astype(np.uint64)
    distinct, times, ends = [], [], [0]
    for k in range(texts):
        own = np.sort(pair[part.links[k]:part.links[k + 1]])
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.empty(0, np.int64)
        distinct.append(own[first])
        times.append(np.diff(np.append(first, len(own))))
        ends.append(ends[-1] + len(first))
    return np.concatenate(distinct), np.concatenate(times), np.array(ends)


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = (ends * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _unpacked(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    return np.frombuffer(np.ascontiguousarray(data).tobytes(), kind), offsets // np.dtype(kind).itemsize


def _described(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """A row per document: its counts, the hash of its groups, and its distinct id pairs packed: the
    A ids and B ids (4 bytes each) and how often each pair is linked."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tools = tokenizers(path_a, path_b, pattern)
        for ids, part in _aligned(batches, tools):
            hashes = [hashlib.sha256(g).hexdigest() if g else "" for g in written_groups(part, tools)]
            pairs, times, ends = _distinct_pairs(part)
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(np.diff(x), pa.int64()) for x in (part.a, part.b, part.groups, part.links)),
                 pa.array(hashes, pa.string()), _packed((pairs >> np.uint64(32)).astype("<u4"), ends),
                 _packed(pairs.astype("<u4"), ends), _packed(times.astype("<u4"), ends)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "of_a", "of_b", "times"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "of_a binary, of_b binary, times binary")


def _batch_pairs(batch, row: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = batch.slice(row, end - row)
    (a, ends), (b, _), (times, _) = (_unpacked(own.column(c), "<u4") for c in ("of_a", "of_b", "times"))
    return (a.astype(np.uint64) << np.uint64(32)) | b, times.astype(np.int64), ends


def pair_counts(described: DataFrame) -> DataFrame:
    """a, b, n: documents that hold A id a and B id b linked."""

    def run(batches):
        for batch in batches:
            for row, end, _, _ in parts(batch.column("of_a"), 4 * PART_PAIRS):
                pairs, n = np.unique(_batch_pairs(batch, row, end)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((pairs >> np.uint64(32)).astype(np.int32)),
                     pa.array(pairs.astype(np.uint32).astype(np.int32)), pa.array(n, pa.int64())], names=["a", "b", "n"])

    added = described.select("of_a", "of_b", "times").mapInArrow(run, "a int, b int, n long")
    return added.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _held(counts: DataFrame, of: int, which: int):
    """Sorted pairs of a slice, their counts, and whether each is its A id's highest."""
    rows = counts.where(F.col("a") % of == which).toArrow()
    a, b, n = (np.asarray(rows.column(c).combine_chunks()) for c in ("a", "b", "n"))
    key = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
    order = np.argsort(key)
    key, n, a = key[order], n[order], a[order]
    best = np.empty(0, bool)
    if len(key):
        first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        top = np.maximum.reduceat(n, first)
        best = n == np.repeat(top, np.diff(np.append(first, len(a))))
    return counts.sparkSession.sparkContext.broadcast((key, n, best))


def _judged(table: DataFrame, held, kept: list[str]) -> DataFrame:
    """Rows with n_best and count_sum over the pairs in `held`."""
    fields = [f for f in table.schema.fields if f.name in kept]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", n_best long, count_sum long"

    def run(batches):
        key, n, best = held.value
        for batch in batches:
            n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for row, end, _, _ in parts(batch.column("of_a"), 4 * PART_PAIRS):
                pairs, times, ends = _batch_pairs(batch, row, end)
                if len(pairs):
                    at = np.searchsorted(key, pairs)
                    for out, value in ((n_best, best[at] * times), (total, n[at] * times)):
                        before = np.concatenate(([0], np.cumsum(value)))
                        out[row:end] = np.diff(before[ends])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in fields), pa.array(n_best), pa.array(total)],
                names=[*(f.name for f in fields), "n_best", "count_sum"])

    return table.select(*(f.name for f in fields), "of_a", "of_b", "times").mapInArrow(run, schema)


def _by_slice(table: DataFrame, slices: int) -> DataFrame:
    """Each document's pairs, a row for every slice of A ids that it has any of."""

    def run(batches):
        for batch in batches:
            for row, end, _, _ in parts(batch.column("of_a"), 4 * PART_PAIRS):
                pairs, times, ends = _batch_pairs(batch, row, end)
                owner = np.repeat(np.arange(row, end), np.diff(ends))
                which = ((pairs >> np.uint64(32)) % np.uint64(slices)).astype(np.int64)
                order = np.lexsort((owner, which))
                pairs, times, owner, which = pairs[order], times[order], owner[order], which[order]
                new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (which[1:] != which[:-1])))
                first = np.flatnonzero(new[:len(owner)])
                cut = np.append(first, len(owner))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(owner[first])), pa.array(which[first]),
                     _packed((pairs >> np.uint64(32)).astype("<u4"), cut), _packed(pairs.astype("<u4"), cut),
                     _packed(times.astype("<u4"), cut)], names=["row", "slice", "of_a", "of_b", "times"])

    return table.select("row", "of_a", "of_b", "times").mapInArrow(
        run, "row long, slice long, of_a binary, of_b binary, times binary")


def digests(docs: DataFrame, path_a: str, path_b: str, pattern: str, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has its
    A id's highest count), count_sum (of the counts of all links), groups_sha256."""
    described = land(_described(docs, path_a, path_b, pattern).withColumn(
        "row", F.monotonically_increasing_id()), "aligned")
    counts = land(pair_counts(described), "pairs")
    slices = max(1, -(-counts.count() // slice_pairs))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    if slices == 1:
        done = _judged(described, _held(counts, 1, 0), columns)
    else:
        cut = land(_by_slice(described, slices), "slices", by="slice")
        sums = None
        for k in range(slices):
            # Written at once, so that one slice at a time is held.
            own = land(_judged(cut.where(F.col("slice") == k), _held(counts, slices, k), ["row"]), "judged")
            sums = own if sums is None else sums.unionAll(own)
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        done = described.join(sums, "row", "left").withColumns({
            c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
