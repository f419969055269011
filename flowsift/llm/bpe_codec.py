"""Byte-level BPE by a rank file: encode with character offsets, decode to bytes and text.

The ranks become a model of the tokenizers library: every byte stands for one printable
character, every split of a token into two tokens is a merge at the token's rank, and a cut that
is a token itself is taken whole. Encoding and decoding run over Arrow batches.

Cases: null text counts as empty; an empty text has no ids; repeated rows are encoded each; an
empty table gives an empty table; columns of the input other than id and text are left out, so
their names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.tokens import batches_by_size, encoder

#: Bytes of ids and decoded text sent to Spark at once.
BATCH_BYTES = 16_000_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in printable)
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def model_of_ranks(ranks: dict[bytes, int], pattern: str) -> str:
    """The rank file as a model of the tokenizers library, in its JSON form."""
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    shown = byte_characters()
    name = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [
        (name[token[:i]], name[token[i:]])
        for token in sorted(ranks, key=ranks.get)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    vocab = {name[token]: rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    tokenizer.decoder = decoders.ByteLevel()
    return tokenizer.to_str()


def _from_json(model: str):
    def make():
        from tokenizers import Tokenizer

        return Tokenizer.from_str(model)

    return encoder(("json", hashlib.sha256(model.encode()).hexdigest()), make, 4)


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, `ids` (binary: little-endian unsigned 32-bit ids) and, if asked for, `starts` and
    `ends`: the characters of the text that each id covers. Ids that share a character give the
    same range. The model goes to the workers once; its size is that of the rank file."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(model_of_ranks(read_ranks(path), pattern))
    kind = docs.schema[id_col].dataType.simpleString()
    extra = ", starts array<int>, ends array<int>" if offsets else ""

    def run(batches):
        enc = _from_json(model.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for cut in batches_by_size([4 * len(t or "") for t in texts], BATCH_BYTES):
                part = texts[cut]
                columns = [keys[cut.start:cut.stop]]
                if offsets:
                    full = enc.tokenizer.encode_batch([t or "" for t in part], add_special_tokens=False)
                    columns.append(pa.array([np.array(e.ids, "<u4").tobytes() for e in full], pa.binary()))
                    columns += [pa.array([[o[k] for o in e.offsets] for e in full], pa.list_(pa.int32()))
                                for k in (0, 1)]
                else:
                    columns.append(pa.array(enc.encode(part), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "starts", "ends"][:len(columns)])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, ids binary{extra}").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, text: bool = True, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """id, ids, `decoded` (bytes) and `decoded_text`, where bytes that are no character, such as
    one split at the edge of a window, become U+FFFD. Null ids decode to nothing. An id that is
    not in the rank file is an error. text=False leaves decoded_text out."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        table = {rank: token for token, rank in ranks.value.items()}.__getitem__
        for batch in batches:
            sizes = [v.as_py() and len(v.as_py()) or 0 for v in batch.column(1)]
            for cut in batches_by_size(sizes, BATCH_BYTES):
                part = batch.slice(cut.start, cut.stop - cut.start)
                out = [b"".join(map(table, np.frombuffer(v.as_py() or b"", "<u4").tolist()))
                       for v in part.column(1)]
                columns = [part.column(0), part.column(1), pa.array(out, pa.binary())]
                if text:
                    columns.append(pa.array([b.decode("utf-8", "replace") for b in out], pa.string()))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["id", "ids", "decoded", "decoded_text"][:len(columns)])

    shown = ", decoded_text string" if text else ""
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"id {kind}, ids binary, decoded binary{shown}").withColumnsRenamed(
        {"id": id_col, "ids": ids_col})


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids, SHA-256 of the bytes they decode to."""
    decoded = decode(encode(docs, path, pattern), path, text=False)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
