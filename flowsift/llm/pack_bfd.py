"""Best-fit-decreasing packing of documents into fixed windows of token ids.

Every Spark partition packs what it reads, buffer by buffer, so nothing is shuffled and memory is
bounded; a lost executor only repeats its partitions. A document longer than the window is split
without loss into full windows and a rest. Rests of a buffer are packed longest first, each into
the open window with the least room that still takes it. That window is found in a segment tree
over the possible rooms.

Cases: null text counts as empty, and an empty document is its end id alone; documents of any
length are kept whole, in pieces; equal lengths go by row order; repeated rows are packed each; an
empty table gives no rows; other columns of the input are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.token_ids import document_ids, rank_encoder

#: Ids held by a task before it packs them, and rows it hands to Spark at once.
BUFFER_IDS = 4_000_000
ROWS = 2_000

SCHEMA = ("sequence_id long, n_tokens int, doc_ids array<long>, doc_starts array<long>, "
          "cu_seqlens array<int>, ids binary, position_ids binary")
ARROW = pa.schema([
    ("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_starts", pa.list_(pa.int64())), ("cu_seqlens", pa.list_(pa.int32())),
    ("ids", pa.binary()), ("position_ids", pa.binary()),
])


class Rooms:
    """Open windows by room left: a segment tree that finds the least room that is enough."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.filled = [0] * (2 * self.leaves)  # open windows below each node
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.filled[node] += by
            node >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._change(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Least room of at least `least`, and the newest window that has it."""
        node = self.leaves + least
        if not self.filled[node]:
            while node > 1 and (node & 1 or not self.filled[node + 1]):
                node >>= 1  # no room further right below this node's parent
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.filled[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return room, self.windows[room].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of piece numbers; every length is between 1 and the window."""
    rooms, packed = Rooms(window), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[i])
        room, at = found or (window, len(packed))
        if found is None:
            packed.append([])
        packed[at].append(i)
        if room > lengths[i]:
            rooms.put(room - lengths[i], at)
    return packed


def _row(pieces: list[tuple[int, int, np.ndarray]], window: int, pad_id: int) -> tuple:
    """One window: its documents, where they start in them, segment ends, ids and positions."""
    ids = np.full(window, pad_id, "<u2")
    positions = np.zeros(window, "<u2")
    ends = [0]
    for _, _, part in pieces:
        ids[ends[-1]:ends[-1] + len(part)] = part
        positions[ends[-1]:ends[-1] + len(part)] = np.arange(len(part))
        ends.append(ends[-1] + len(part))
    return (ends[-1], [p[0] for p in pieces], [p[1] for p in pieces], ends, ids.tobytes(),
            positions.tobytes())


def pack(docs: DataFrame, path: str, pattern: str, window: int = 1024, end_id: int = 50256,
         pad_id: int = 50256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of a packed matrix: `ids` has the window's ids, 16-bit little-endian, padded at its
    end; `cu_seqlens` starts at 0 and ends at n_tokens; `position_ids` begins anew at 0 with every
    segment and is 0 in the padding; doc_ids and doc_starts name each segment's document and the
    first of its ids. sequence_id is the partition, times 2^33, plus a running number."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        encoding = rank_encoder(path, pattern)
        number = TaskContext.get().partitionId() << 33
        ready: list[tuple] = []
        rests: list[tuple[int, int, np.ndarray]] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            columns = list(zip(*ready))
            if columns:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(number, number + len(ready)), pa.int64()),
                     *(pa.array(c, f.type) for c, f in zip(columns, list(ARROW)[1:]))], schema=ARROW)
            number += len(ready)
            ready.clear()

        def pack_rests() -> Iterator[pa.RecordBatch]:
            for group in best_fit_decreasing([len(r[2]) for r in rests], window):
                ready.append(_row([rests[i] for i in group], window, pad_id))
                if len(ready) >= ROWS:
                    yield from flush()
            rests.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(document_ids(encoding, text.as_py(), end_id), "<u2")
                full = len(ids) - len(ids) % window
                for start in range(0, full, window):
                    ready.append(_row([(doc_id, start, ids[start:start + window])], window, pad_id))
                    if len(ready) >= ROWS:
                        yield from flush()
                if full < len(ids):
                    rests.append((doc_id, full, ids[full:].copy()))
                    held += len(ids) - full
                if held >= BUFFER_IDS:
                    yield from pack_rests()
                    held = 0
        yield from pack_rests()
        yield from flush()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed matrix as Parquet files."""
    packed.write.parquet(path)
