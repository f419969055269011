"""Removal of byte strings that a document with a smaller id holds too, by suffix sorting.

Sorting every suffix of the corpus would move many times its size. So the cover by which suffixes
are sampled is chosen by content: of the 16-byte grams in a window of `length` bytes the one with
the smallest hash is sampled. Equal windows sample equal grams, as in any difference cover.
Consecutive windows with the same sampled gram are a run, and its bytes are the run's context.

1. Runs are dealt by their gram in buckets of bounded size, packed as bytes; copies of a context
   within a part of the input go as one. Grams that one document alone has drop out here. A
   context that a smaller document has too is removed whole. Prose shares most of its grams, so a
   run drops out too unless another document has the same gram with the bytes that go on for half
   a window before it, or after it: equal windows agree in one of the two.
2. What is left are different contexts of a gram. Their bytes are fetched, equal ones combined, and
   dealt by gram. In every group the contexts' suffixes are sorted by the difference-cover
   algorithm: sort sampled triples, recurse on names, merge the others. Adjacent prefixes of
   `length` bytes are compared, and each class of equal windows learns its smallest document. A
   gram with very many contexts, as at the ends of a passage that a part of all documents holds,
   is split into its windows, which are combined by hash, so that no group grows with the corpus.
3. Intervals are collected per document and cut out.

Grams and whole contexts are compared by 64-bit hashes, windows of different contexts by bytes,
those of grams with very many contexts by hash.

Cases: null text counts as empty; texts shorter than `length` bytes are left alone; matches never
cross documents; strings are judged on the input, so chains of copies all point to the smallest
document; rows that share an id never remove from each other; rows without an id neither lose
anything nor cover others; rows alike in id and text get the same result; an empty table gives an
empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.llm.columns import set_aside, with_chars
from flowsift.llm.difference_cover import equal_prefixes, suffix_array
from flowsift.llm.scratch import drop, land
from flowsift.llm.textbytes import PartHashes, flat, parts, scrambled
from flowsift.llm.tokens import batches_by_size

LENGTH = 50
GRAM = 16
#: Contexts of a gram beyond which it is split into windows.
MANY = 20_000
#: Windows of a run at most; bytes of text handled at once; runs aimed at in a bucket.
RUN = 64
PART_BYTES = 1_500_000
#: Bytes of text whose runs are dealt together.
HELD_BYTES = 8_000_000
BUCKET = 700_000
#: Bytes of contexts aimed at in a group that is sorted.
SORTED_BYTES = 1_000_000
BATCH_BYTES = 16_000_000


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes from each position on; size is a multiple of 8."""
    words = np.empty(max(len(data) - 7, 0), np.uint64)
    for k in range(8):
        words[k::8] = data[k:k + (len(data) - k) // 8 * 8].view("<u8")
    n = max(len(data) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(0, size, 8):
        out = (out ^ words[k:k + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(32)
    return scrambled(out)


def window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` consecutive hashes."""
    have, out = 1, hashes
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def runs(grams: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Row, start in the buffer, number of windows and sampled gram of each run, by the hashes of its grams."""
    if len(grams) < length - gram + 1:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    names = window_minima(grams, length - gram + 1)
    starts, sizes = offsets[:-1], np.maximum(np.diff(offsets) - length + 1, 0)
    inside = np.zeros(len(names) + 1, np.int8)
    some = sizes > 0
    np.add.at(inside, starts[some], 1)
    np.add.at(inside, (starts + sizes)[some], -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    fresh = np.ones(len(names), bool)
    fresh[1:] = names[1:] != names[:-1]
    fresh[starts[some]] = True
    fresh[1:] |= ~inside[:-1]
    begin = np.flatnonzero(fresh & inside)
    stops = np.flatnonzero(inside & ~np.append(inside[1:] & ~fresh[1:], False)) + 1
    count = stops - begin
    pieces = -(-count // RUN)  # long runs, as in a text of one letter, are cut
    first = np.repeat(begin, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    count = np.minimum(np.repeat(begin + count, pieces) - first, RUN)
    return np.searchsorted(offsets, first, "right") - 1, first, count, names[first]


def keyed(docs: DataFrame) -> DataFrame:
    """Row key (equal for rows that agree in id and text), id and text of rows that have both."""
    return docs.where("doc_id is not null and text is not null").select(
        F.xxhash64("doc_id", "text").alias("row"), F.col("doc_id").cast("long").alias("doc"), "text")


def halves(grams: np.ndarray, hashes: PartHashes, start: np.ndarray, count: np.ndarray, name: np.ndarray,
           length: int):
    """Of each run: the hash of its gram with the bytes before it, of its gram with the bytes after it,
    and whether it is `loose`. Equal windows agree in one of the two, as one of the two sides of the gram
    has half of the window's other bytes. 0 stands for a side that no window of the run reaches that far.
    A loose run holds the gram at several places, has neither, and may equal any run of its gram."""
    spare = length - GRAM
    before = (spare + 1) // 2
    after = spare - before + 1
    place = np.zeros(len(start), np.int64)  # of the first such gram in the run's first window
    for k in range(spare, -1, -1):
        place[grams[start + k] == name] = k
    loose = place < count - 1
    at = start + place
    left = ~loose & (place >= before)
    right = ~loose & (place - (count - 1) < before)
    out = []
    for own, first, end in ((left, at - before, at + GRAM), (right, at, at + GRAM + after)):
        value = np.zeros(len(start), np.uint64)
        value[own] = hashes.of(first[own], end[own]) % np.uint64(2 ** 24 - 1) + np.uint64(1)
        out.append(value)
    return *out, loose


#: Columns of a packed run and the bytes that each has: bytes of one weight stand together, so that those that
#: are 0 nearly everywhere pack well. `flags` has count - 1, 64 for the first run of a row, 128 for a loose one.
RUN_BYTES = {"context": 8, "name": 4, "left": 3, "right": 3, "at": 4, "flags": 1}
PLACE = RUN_BYTES["at"] + RUN_BYTES["flags"]


def _planes(values: np.ndarray, size: int) -> np.ndarray:
    """The lowest `size` bytes of the values, a row for the bytes of each weight."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:size]


def _values(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :len(planes)] = planes.T
    return out.view("<u8").ravel()


def _dealt(rows: DataFrame, buckets: int, length: int) -> DataFrame:
    """Runs by bucket of their gram, packed. A context that came before in the same part, in a
    document with a smaller id, goes to a bucket of its own kind: it is removed whole."""

    def found(keys, docs, data, offsets):
        grams, hashes = gram_hashes(data, GRAM), PartHashes(data)
        of, start, count, name = runs(grams, offsets, length, GRAM)
        context = hashes.of(start, start + count + length - 1)
        left, right, loose = halves(grams, hashes, start, count, name, length)
        key, doc = keys[of], docs[of]
        order = np.lexsort((start, doc, context))
        same = np.zeros(len(order), bool)
        same[1:] = context[order[1:]] == context[order[:-1]]
        group = np.cumsum(~same) - 1
        least = doc[order[np.flatnonzero(~same)]][group]
        covered = np.zeros(len(order), bool)
        covered[order] = doc[order] > least
        bucket = (name % np.uint64(buckets)).astype(np.int64)
        bucket[covered] = buckets + key[covered] % buckets
        columns = {"context": context, "name": name // np.uint64(buckets), "left": left, "right": right,
                   "at": start - offsets[of], "flags": count - 1 + 128 * loose}
        return of, bucket, np.concatenate([_planes(columns[c], n) for c, n in RUN_BYTES.items()])

    def packed(held):
        keys, docs, of, bucket, planes = zip(*held)
        shift = np.cumsum([0] + [len(k) for k in keys])
        of = np.concatenate([o + s for o, s in zip(of, shift)])
        bucket, planes = np.concatenate(bucket), np.concatenate(planes, axis=1)
        who = np.concatenate([_planes(np.concatenate(v), 8) for v in (docs, keys)])
        order = np.argsort(bucket, kind="stable")  # rows ascend within a bucket
        of, bucket, planes = of[order], bucket[order], planes[:, order]
        first = np.ones(len(of), bool)
        first[1:] = (of[1:] != of[:-1]) | (bucket[1:] != bucket[:-1])
        planes[-1] |= np.where(first, 64, 0).astype(np.uint8)
        who = who[:, of[first]]
        cut = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
        rows_at = np.concatenate(([0], np.cumsum(first)))[cut]
        spans = [(a, b, 0 if bucket[a] < buckets else len(planes) - PLACE) for a, b in zip(cut[:-1], cut[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cut[:-1]], pa.int64()),
             pa.array([who[:, a:b].tobytes() for a, b in zip(rows_at[:-1], rows_at[1:])], pa.binary()),
             pa.array([planes[top:, a:b].tobytes() for a, b, top in spans], pa.binary())],
            names=["bucket", "who", "runs"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            keys, docs = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for row, end, data, offsets in parts(batch.column(2), PART_BYTES):
                own = found(keys[row:end], docs[row:end], data, offsets)
                if len(own[0]):
                    held.append((keys[row:end].copy(), docs[row:end].copy(), *own))
                    size += len(data)
                if size >= HELD_BYTES:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    return rows.mapInArrow(run, "bucket long, who binary, runs binary")


FOUND = "row long, doc long, at int, size int, name long, whole boolean, many boolean"


def _judged(dealt: DataFrame, buckets: int, length: int) -> DataFrame:
    """Runs that are removed whole (bytes at .. at + size), and, for grams with different contexts of
    different documents, one run of each context that may have a window of another document."""
    schema = pa.schema([("row", pa.int64()), ("doc", pa.int64()), ("at", pa.int32()), ("size", pa.int32()),
                        ("name", pa.int64()), ("whole", pa.bool_()), ("many", pa.bool_())])

    def joined(table, column, height):
        return np.concatenate([np.frombuffer(v.as_py(), np.uint8).reshape(height, -1)
                               for v in table.column(column)], axis=1)

    def shared(by_name, half, doc):
        """Whether another document has the same half of the same gram."""
        out = np.zeros(len(doc), bool)
        own = np.flatnonzero(half)
        if len(own):
            kind = by_name[own] << 24 | half[own].astype(np.int64)
            own = own[np.argsort(kind)]
            kind = by_name[own] << 24 | half[own].astype(np.int64)
            fresh = np.concatenate(([True], kind[1:] != kind[:-1]))
            heads = np.flatnonzero(fresh)
            several = np.minimum.reduceat(doc[own], heads) < np.maximum.reduceat(doc[own], heads)
            out[own] = several[np.cumsum(fresh) - 1]
        return out

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        hidden = bucket >= buckets
        who = joined(table, "who", 16)
        planes = joined(table, "runs", PLACE if hidden else sum(RUN_BYTES.values()))
        columns, top = {}, 0
        for c in ("at", "flags") if hidden else RUN_BYTES:
            columns[c] = _values(planes[top:top + RUN_BYTES[c]])
            top += RUN_BYTES[c]
        flags, at = columns["flags"].astype(np.int32), columns["at"].astype(np.int32)
        own = np.cumsum(flags >> 6 & 1) - 1
        doc, row = _values(who[:8]).view(np.int64)[own], _values(who[8:]).view(np.int64)[own]
        size = (flags & 63) + np.int32(length)
        if hidden:
            return pa.table(list(map(pa.array, (
                row, doc, at, size, np.zeros(len(row), np.int64), np.ones(len(row), bool),
                np.zeros(len(row), bool)))), schema=schema)
        name, context = columns["name"], columns["context"]
        order = np.lexsort((at, doc, context, name))
        name, context, doc, row, at, size, flags = (v[order] for v in (name, context, doc, row, at, size, flags))
        new_name = np.concatenate(([True], name[1:] != name[:-1]))
        new_context = new_name | np.concatenate(([True], context[1:] != context[:-1]))
        names = np.flatnonzero(new_name)
        by_context = np.cumsum(new_context) - 1
        by_name = np.cumsum(new_name) - 1
        first = doc[new_context][by_context]  # documents ascend within a context
        least = np.minimum.reduceat(doc, names)[by_name]
        most = np.maximum.reduceat(doc, names)[by_name]
        contexts = np.add.reduceat(new_context.astype(np.int64), names)[by_name]
        loose = np.maximum.reduceat(flags >> 7, names)[by_name] > 0
        whole = doc > first
        # One run of each context stands for it; a document may hold the context several times, and
        # then all its runs are asked for, as each has to be marked.
        ask = ~whole & (contexts > 1) & (most > least)
        may = np.flatnonzero(ask & ~loose)
        from_ = order[may]
        ask[may] = (shared(by_name[may], columns["left"][from_], doc[may])
                    | shared(by_name[may], columns["right"][from_], doc[may]))
        many = np.add.reduceat((new_context & ask).astype(np.int64), names)[by_name] > MANY
        kept = whole | ask
        named = name[kept] * np.uint64(buckets) + np.uint64(bucket)
        return pa.table(list(map(pa.array, (
            row[kept], doc[kept], at[kept], size[kept], named.view(np.int64), whole[kept], many[kept]))),
            schema=schema)

    return dealt.groupBy("bucket").applyInArrow(run, FOUND)


def _fetched(rows: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """The runs to be compared: name, row, doc, at, size, bytes. Runs of grams with many contexts
    come as single windows without bytes, whose name says what they hold."""
    per = asked.groupBy("row").agg(F.collect_list(F.struct("at", "size", "name", "many")).alias("asked"))
    both = rows.join(per.hint("merge"), "row").select("row", "doc", "text", "asked")

    def run(batches):
        for batch in batches:
            out, size = [[] for _ in range(6)], 0
            for row, doc, text, asked in zip(*(batch.column(i) for i in range(4))):
                row, doc, text = row.as_py(), doc.as_py(), text.as_py().encode()
                for a in asked.as_py():
                    at, n, name = a["at"], a["size"], a["name"]
                    if a["many"]:
                        starts = np.arange(n - length + 1)
                        data = np.frombuffer(text[at:at + n], np.uint8)
                        own = PartHashes(data).of(starts, starts + length) ^ np.int64(name).view(np.uint64)
                        names = scrambled(own).view(np.int64).tolist()
                        pieces, n = [None] * len(names), length
                    else:
                        names, pieces = [name], [text[at:at + n]]
                    out[0] += names
                    out[1] += [row] * len(names)
                    out[2] += [doc] * len(names)
                    out[3] += range(at, at + len(names))
                    out[4] += [n] * len(names)
                    out[5] += pieces
                    size += n * len(names)
                if size > BATCH_BYTES // 4:
                    yield _pieces(out)
                    out, size = [[] for _ in range(6)], 0
            if out[0]:
                yield _pieces(out)

    return both.mapInArrow(run, "name long, row long, doc long, at int, size int, bytes binary").withColumn(
        "hash", F.xxhash64("bytes"))


def _pieces(out: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)],
                                      names=["name", "row", "doc", "at", "size", "bytes"])


def _least(pieces: DataFrame) -> DataFrame:
    """A piece that several documents have is sorted once, for the smallest of them; the others
    contain nothing that it does not."""
    return land(pieces.groupBy("name", "hash").agg(
        F.min("doc").alias("first"), F.first("bytes").alias("bytes")), "least")


def _compared(pieces: DataFrame, least: DataFrame, groups: int, length: int) -> DataFrame:
    """Intervals of the pieces that smaller documents cover, by suffix sorting in every group."""
    places = pieces.select("name", "hash", "row", "doc", "at", "size")
    same = places.join(least.select("name", "hash", "first"), ["name", "hash"]).where("doc > first").select(
        "row", "at", "size")
    dealt = least.where("bytes is not null").withColumn("group", F.pmod(F.col("name"), F.lit(groups)))
    schema = pa.schema([("name", pa.int64()), ("hash", pa.int64()), ("from", pa.int32()), ("size", pa.int32())])

    def run(table: pa.Table) -> pa.Table:
        name, doc = np.asarray(table.column("name")), np.asarray(table.column("first"))
        order = np.lexsort((doc, name))
        fresh = np.concatenate(([True], name[order[1:]] != name[order[:-1]]))
        heads = np.flatnonzero(fresh)
        of = np.cumsum(fresh) - 1
        # Names whose contexts are all of one document have nothing to give.
        several = np.minimum.reduceat(doc[order], heads) < np.maximum.reduceat(doc[order], heads)
        table = table.take(pa.array(np.sort(order[several[of]]))).combine_chunks()
        if not len(table):
            return schema.empty_table()
        data, offsets = flat(table.column("bytes"))
        piece, first, size = covered_parts(data, offsets, np.asarray(table.column("first")), length)
        at = pa.array(piece)
        return pa.table([table.column("name").take(at), table.column("hash").take(at),
                         pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32))], schema=schema)

    hits = dealt.groupBy("group").applyInArrow(run, "name long, hash long, from int, size int")
    # Only for the document that a piece was sorted for; larger ones are covered whole.
    partly = places.drop("size").join(hits, ["name", "hash"]).select(
        "row", (F.col("at") + F.col("from")).alias("at"), "size")
    return same.unionAll(partly)


def covered_parts(data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, length: int):
    """Parts of pieces that pieces of smaller documents cover: piece, start in it, size."""
    sizes = np.diff(offsets)
    # Values from 2 on, with a 1 after every piece; what stands behind it never counts, as windows
    # that cross it are left out.
    text = np.ones(len(data) + len(sizes), np.int16)
    text[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data.astype(np.int16) + 2
    begin = offsets[:-1] + np.arange(len(sizes))
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    order = suffix_array(text)
    of = owner[order]
    inside = order - begin[of] + length <= sizes[of]
    order, of = order[inside], of[inside]
    # Windows hold bytes only; where a piece ends, any byte does for what stands between.
    same = equal_prefixes(np.maximum(text - 2, 0).astype(np.uint8), order, length)
    smallest = np.minimum.reduceat(doc[of], np.flatnonzero(~same))[np.cumsum(~same) - 1]
    order = np.sort(order[smallest < doc[of]])
    of = owner[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (order[1:] != order[:-1] + 1) | (of[1:] != of[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(order)) - 1 if len(first) else first
    return of[first], order[first] - begin[of[first]], order[last] - order[first] + length


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """row and `spans` (at, size) in bytes, which may overlap, of everything to be removed."""
    rows = keyed(docs).where(F.octet_length("text") >= length)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, total // (BUCKET * (length - GRAM) // 2))
    found = land(_judged(_dealt(rows, buckets, length), buckets, length), "runs")
    asked = found.where("not whole")
    bytes_asked = asked.agg(F.sum("size")).first()[0] or 0
    pieces = land(_fetched(rows, asked, length), "pieces")
    groups = max(1, bytes_asked // SORTED_BYTES)
    least = _least(pieces)
    spans = found.where("whole").select("row", "at", "size").unionAll(_compared(pieces, least, groups, length))
    out = land(spans.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("at", "size"))).alias("spans")), "spans")
    drop(found, pieces, least)
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes outside the sorted spans, and the maximal removed runs (from, to)."""
    merged: list[list[int]] = []
    for at, size in spans:
        if merged and at <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], at + size)
        else:
            merged.append([at, at + size])
    kept, done = [], 0
    for a, b in merged:
        kept.append(text[done:a])
        done = b
    kept.append(text[done:])
    return b"".join(kept), [(a, b) for a, b in merged]


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The columns of docs with what is left as text, and n_bytes, `kept` (the bytes left) and
    `removed` (from, to). Parts of characters at the edge of a removed run are in kept, not in
    text. A null text stays null. Columns of docs by the names of these three give way."""
    docs = docs.drop("n_bytes", "kept", "removed")
    spans = repeated_spans(docs, length)
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.struct(*others).alias("doc"), "text").join(
        spans.hint("merge"), "row", "left").select("doc", "text", "spans")
    run_type = T.ArrayType(T.StructType([T.StructField("from", T.IntegerType()), T.StructField("to", T.IntegerType())]))
    schema = T.StructType([
        T.StructField("doc", rows.schema["doc"].dataType), T.StructField("text", T.StringType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("kept", T.BinaryType()),
        T.StructField("removed", run_type)])
    arrow_runs = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))

    def run(batches):
        for batch in batches:
            texts, lists = batch.column(1).to_pylist(), batch.column(2)
            for part in batches_by_size([len(t or "") for t in texts], BATCH_BYTES):
                out = []
                for i in range(part.start, part.stop):
                    text = (texts[i] or "").encode()
                    kept, removed = cut(text, [(s["at"], s["size"]) for s in lists[i].as_py() or []])
                    shown = texts[i] if not removed else kept.decode("utf-8", "ignore")
                    out.append((shown, len(text), kept, [{"from": a, "to": b} for a, b in removed]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part.start:part.stop], *(pa.array(c, t) for c, t in zip(
                        zip(*out), [pa.string(), pa.int64(), pa.binary(), arrow_runs]))], names=schema.names)

    return rows.mapInArrow(run, schema).select(
        *[F.col("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns],
        "n_bytes", "kept", "removed")


def digests(docs: DataFrame) -> DataFrame:
    """Per document: bytes, bytes removed, maximal removed runs, SHA-256 of what is left."""
    return dedup(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def deduped_documents(docs: DataFrame) -> DataFrame:
    """Documents with their columns; text and n_chars (if there) are those after the removal. A
    document that loses all its bytes goes. Columns named as those of dedup stay as they are."""
    renamed, own = set_aside(docs, ["n_bytes", "kept", "removed"])
    done = dedup(renamed)
    changed = F.size("removed") > 0
    return with_chars(done.where(~changed | (F.octet_length("kept") > 0)), changed).select(own)
