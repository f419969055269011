"""Token ids of texts by the tokenizers library, inside Arrow batches.

Byte-level BPE never merges across the start of a blank that follows a visible character, so a
text is cut there and each cut is encoded once per worker. Cuts are remembered in a dictionary of
bounded size; a cut that is not in it goes through the library.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator

#: Entries of a worker's dictionary, and the longest cut it keeps.
REMEMBERED = 300_000
LONGEST = 64
#: Characters handled at once, so that the list of cuts stays small.
AT_ONCE = 1_000_000

_BLANK_AFTER_BLANK = re.compile(r"\s ")
_BLANK_AFTER_VISIBLE = re.compile(r"(?<=\S) ")

_ENCODERS: dict[tuple, "Encoder"] = {}


def cuts(text: str) -> list[str]:
    """Parts of a text at blanks that follow a visible character, without those blanks."""
    if _BLANK_AFTER_BLANK.search(text) or text.startswith(" "):
        return _BLANK_AFTER_VISIBLE.split(text)
    return text.split(" ")


class Encoder:
    """Ids as little-endian unsigned integers of 2 or 4 bytes; equal to encoding the whole text."""

    def __init__(self, tokenizer, width: int = 4) -> None:
        tokenizer.encode_special_tokens = True
        self.tokenizer, self.code = tokenizer, {2: "H", 4: "I"}[width]
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def _learn(self, known: dict[str, bytes], wanted: set[str], lead: str) -> dict[str, bytes]:
        """Ids of all wanted cuts; short ones are remembered."""
        missing = [w for w in wanted if w not in known]
        if len(known) + len(missing) > REMEMBERED:
            known.clear()
            missing = list(wanted)
        found = self.tokenizer.encode_batch_fast([lead + w for w in missing], add_special_tokens=False)
        long = {}
        for word, enc in zip(missing, found):
            ids = array(self.code, enc.ids)
            if sys.byteorder == "big":
                ids.byteswap()
            (known if len(word) <= LONGEST else long)[word] = ids.tobytes()
        return long

    def _few(self, texts: list[str]) -> list[bytes]:
        parts = [cuts(t) for t in texts]
        heads = self._learn(self.first, {p[0] for p in parts}, "")
        tails = self._learn(self.later, {w for p in parts for w in p[1:]}, " ")
        first, later = self.first, self.later
        if heads:
            first = {**first, **heads}
        if tails:
            return [first[p[0]] + b"".join([tails[w] if w in tails else later[w] for w in p[1:]])
                    for p in parts]
        get = later.__getitem__
        return [first[p[0]] + b"".join(map(get, p[1:])) for p in parts]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text in turn; null counts as empty."""
        held, size = [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= AT_ONCE:
                yield from self._few(held)
                held, size = [], 0
        if held:
            yield from self._few(held)


def encoder(key: tuple, make, width: int) -> Encoder:
    """One encoder per worker process and tokenizer; Spark's tasks are the parallelism."""
    if (key, width) not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[(key, width)] = Encoder(make(), width)
    return _ENCODERS[(key, width)]


def file_encoder(path: str, width: int) -> Encoder:
    """Encoder of a tokenizer file, which every machine holds at that path."""

    def make():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    return encoder(("file", path), make, width)


def batches_by_size(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices of at most `most` in total, one item at least."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))
