"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

#: Names that the operators use for columns of their own.
CLASHING = ["row", "ids", "n", "rest", "kept", "class", "size", "shard", "slot", "spans", "line_runs",
            "removed", "rank", "comp", "node", "decoded", "words", "vec"]


def texts(n: int = 60, seed: int = 5) -> list[str | None]:
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7))) for _ in range(300)]

    def line(words: int) -> str:
        return " ".join(rnd.choice(vocabulary) for _ in range(words))

    passage = line(60)
    lines = [line(12) for _ in range(4)]
    base = [line(40) for _ in range(3)]
    near = []
    for _ in range(8):
        words = " ".join(base).split(" ")
        words[rnd.randrange(len(words))] = line(1)
        near.append(" ".join(words))
    out: list[str | None] = [None, "", " ", "\n\n", "a", "one two", "é ü 🙂 ñ", "1234 5678", "the the the the the",
                             "x" * 300, "ab " * 400, "\n".join(lines + lines), "\n".join(lines[:2] + [line(9)]),
                             "<|endoftext|> plain", "A b\tC\r\nd  e", "\x00\x1c odd \x85 blank"]
    out += near + [near[0], near[0], passage, line(30) + " " + passage + " " + line(20), passage + " " + line(9)]
    while len(out) < n:
        out.append("\n".join(line(rnd.randint(3, 40)) for _ in range(rnd.randint(1, 5))))
    out.append("\n".join(line(30) for _ in range(300)))
    return out


def rows(n: int = 60) -> list[tuple]:
    out = [(i, t, ["en", "fr", None][i % 3], f"src{i % 4}" if i % 5 else None, None if t is None else len(t))
           for i, t in enumerate(texts(n))]
    out.append(out[20])  # a repeated row
    out.append((30, "another text of an id that is there " * 3, "en", "src1", 111))
    out.append((None, out[25][1], "en", "src1", 5))  # no id
    return out


def table(spark, data: list[tuple], clashing: bool = True):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if clashing else df


def empty(spark):
    return table(spark, [])
