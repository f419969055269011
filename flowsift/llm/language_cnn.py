"""Language identification by a convolutional network over bytes.

Bytes are embedded, filters of several widths slide over a window of fixed length, each filter's
largest answer is kept, and a softmax over the languages follows. The network is trained in numpy
on a bounded, documented sample of labelled documents and applied inside Arrow batches to every
window of every text. A filter's answer is a sum over its bytes, so for the application each byte
and place has its share in a table, and a layer is a few table rows added up.

Cases: a text that is null or has no letter gets `und` with score 0; short texts fill one window
with blanks; long texts have all their windows scored, weighted by their bytes; equal texts get
equal answers; without labelled rows everything is `und`; an empty table gives an empty table;
other columns of the input are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 256
WIDTHS = (2, 3, 4)
#: The labelled sample: documents in all, and windows from each.
SAMPLE_DOCS = 4_000
SAMPLE_WINDOWS = 3
UNKNOWN = "und"
#: Windows scored at once: their layer stays in the processor's cache.
AT_ONCE = 48
BLANK = 32


@dataclass
class Network:
    """Weights of a trained network; `filters[w]` has w * embedding rows."""

    languages: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """For each place in a filter: what each byte there adds to each filter's answer."""
        size, out = self.embedding.shape[1], []
        for place in range(max(WIDTHS)):
            parts = [
                self.embedding @ self.filters[w][place * size:(place + 1) * size]
                if place < w else np.zeros((256, self.filters[w].shape[1]), np.float32)
                for w in WIDTHS
            ]
            out.append(np.ascontiguousarray(np.concatenate(parts, axis=1), np.float32))
        return out


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text, each with the bytes after it that its last filters reach into."""
    reach = max(WIDTHS) - 1
    n = max(1, -(-len(text) // WINDOW))
    padded = np.full(n * WINDOW + reach, BLANK, np.uint8)
    padded[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (n, WINDOW + reach), (WINDOW, 1))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(net: Network, tables: list[np.ndarray], windows: np.ndarray) -> np.ndarray:
    """Softmax over the languages for each window."""
    out = np.empty((len(windows), len(net.languages)), np.float32)
    for i in range(0, len(windows), AT_ONCE):
        part = windows[i:i + AT_ONCE]
        answers = tables[0][part[:, :WINDOW]]
        for place in range(1, len(tables)):
            answers += tables[place][part[:, place:place + WINDOW]]
        pooled = np.maximum(answers.max(axis=1) + net.bias, 0.0)
        out[i:i + AT_ONCE] = _softmax(pooled @ net.dense + net.dense_bias)
    return out


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], filters: int = 8,
        embedding: int = 6, epochs: int = 6, batch: int = 64, rate: float = 0.01,
        seed: int = 42) -> Network:
    """Train by Adam on cross entropy. Only the winning place of a filter gets a gradient."""
    rng = np.random.default_rng(seed)
    width_of = np.repeat(WIDTHS, filters)
    p = {"e": rng.normal(0, 0.5, (256, embedding)), "b": np.zeros(len(width_of)),
         "d": rng.normal(0, 0.3, (len(width_of), len(languages))), "c": np.zeros(len(languages))}
    p |= {w: rng.normal(0, 1 / np.sqrt(w * embedding), (w * embedding, filters)) for w in WIDTHS}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), batch):
            rows = order[i:i + batch]
            x, y, n = windows[rows], labels[rows], len(rows)
            net = Network(languages, p["e"], {w: p[w] for w in WIDTHS}, p["b"], p["d"], p["c"])
            answers = sum(t[x[:, k:k + WINDOW]] for k, t in enumerate(net.tables()))
            best = answers.argmax(axis=1)
            raw = np.take_along_axis(answers, best[:, None, :], 1)[:, 0] + p["b"]
            pooled = np.maximum(raw, 0)
            error = _softmax(pooled @ p["d"] + p["c"])
            error[np.arange(n), y] -= 1
            error /= n
            back = (error @ p["d"].T) * (raw > 0)
            grad = {"d": pooled.T @ error, "c": error.sum(0), "b": back.sum(0), "e": np.zeros_like(p["e"])}
            for g, w in enumerate(WIDTHS):
                own = slice(g * filters, (g + 1) * filters)
                at = best[:, own, None] + np.arange(w)
                bytes_ = x[np.arange(n)[:, None, None], at]  # rows, filters, places
                seen = p["e"][bytes_].reshape(n, filters, w * embedding)
                grad[w] = np.einsum("nfk,nf->kf", seen, back[:, own])
                to_e = np.einsum("nf,kf->nfk", back[:, own], p[w]).reshape(n, filters, w, embedding)
                np.add.at(grad["e"], bytes_, to_e)
            step += 1
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                p[k] = p[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                p[k] = p[k].astype(np.float32)
    return Network(languages, p["e"], {w: p[w] for w in WIDTHS}, p["b"], p["d"], p["c"])


def held_out(doc_id: Column | str) -> Column:
    """Documents no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, most: int = SAMPLE_DOCS) -> DataFrame:
    """lang and windows of at most `most` labelled documents, as many of each language as there
    is room for, chosen by a hash of the id. Only ids and languages are compared; the few chosen
    ids go out to a second scan."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    n_langs = rows.select("lang").distinct().limit(most).count()
    if not n_langs:
        return rows.select("lang", F.array().cast("array<string>").alias("parts")).limit(0)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = rows.select("doc_id", "lang").withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= max(1, most // n_langs)).select("doc_id").distinct().limit(most)
    step = F.greatest(F.lit(1), F.floor(F.char_length("text") / SAMPLE_WINDOWS)).cast("int")
    parts = [F.substring("text", F.lit(1) + F.lit(k) * step, F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)]
    return rows.join(F.broadcast(chosen), "doc_id", "left_semi").select(
        "lang", "doc_id", F.array_distinct(F.array(*parts)).alias("parts"))


def train(docs: DataFrame) -> Network | None:
    """A network from the labelled sample; None without labelled rows."""
    rows = sorted(sample(docs).collect(), key=lambda r: (r["lang"], r["doc_id"]))
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return None
    pairs = [(windows_of(p.encode()[:WINDOW])[0], languages.index(r["lang"])) for r in rows for p in r["parts"]]
    return fit(np.stack([w for w, _ in pairs]), np.array([k for _, k in pairs]), languages)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score: the language with the largest mean probability over all windows."""
    rows = docs.select("doc_id", "text")
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if net is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        net = shared.value
        tables, names = net.tables(), np.array([*net.languages, UNKNOWN], object)
        for batch in batches:
            texts, letters = batch.column(1), batch.column(2).to_pylist()
            best, score = np.full(len(texts), len(net.languages)), np.zeros(len(texts))
            for i, known in enumerate(letters):
                if not known:
                    continue
                text = texts[i].as_py().encode()
                windows = windows_of(text)
                weight = np.full(len(windows), WINDOW, float)
                weight[-1] = len(text) - (len(windows) - 1) * WINDOW
                mean = weight @ probabilities(net, tables, windows) / weight.sum()
                best[i] = mean.argmax()
                score[i] = min(1.0, float(mean[best[i]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"])

    return rows.withColumn("letters", letters).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double")


def classify(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out, predict all."""
    return predict(docs, train(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
