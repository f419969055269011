import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowsift.llm import token_alignment
from flowsift.llm.bpe_codec import byte_characters
from flowsift.llm.catalog import ENGLISH, PATTERN, PIECES
from tests.llm import cases

ODD = ["a</s>b <unk> <s>", "tab\tand blank", "▁ piece mark", "日本語のテキスト。中文", "ﬁ ligature ½ ①", "é e",
       "  two  leading", "trailing  ", "🙂🙃 👩‍👩‍👧", "1234567 8.90", "<0x41> <|endoftext|>", "x" * 5000, "\u0000 nul"]


def plain(texts):
    """Tokens, groups and links of each text, said directly."""
    a_lib, b_lib = Tokenizer.from_file(ENGLISH), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_lib.encode_special_tokens = True
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    out = []
    for text in texts:
        empty = ([], [], [], [])
        if not text:
            out.append(empty)
            continue
        a = a_lib.encode(" " + text, add_special_tokens=False).ids
        b = b_lib.encode(text)
        bytes_a = [bytes(byte_of[c] for c in a_lib.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i)
                   else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            out.append(empty)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append((a[i:to_a], b[j:to_b]))
            i, j = to_a, to_b
        owner_a = [k for k, x in enumerate(bytes_a) for _ in x]
        owner_b = [k for k, x in enumerate(bytes_b) for _ in x]
        links = [(a[x], b[y]) for x, y in sorted(set(zip(owner_a, owner_b)))]
        out.append((a, b, groups, links))
    return out


def expected(texts):
    found = plain(texts)
    counts = Counter(p for *_, links in found for p in set(links))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    rows = []
    for a, b, groups, links in found:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((len(a), len(b), len(groups), len(links), sum(counts[p] == top[p[0]] for p in links),
                     sum(counts[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return rows


@pytest.mark.parametrize("slice_pairs", [token_alignment.SLICE_PAIRS, 4_000])
def test_digests_equal_plain_alignment(spark, slice_pairs):
    data = [(i, t, None, None, None) for i, t in enumerate(ODD + cases.texts())]
    data += [data[20], (None, "an id is missing here", None, None, None)]
    done = token_alignment.digests(cases.table(spark, data), ENGLISH, PIECES, PATTERN, slice_pairs)
    assert done.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted((tuple(r) for r in done.collect()), key=repr)
    want = [(d[0], *r) for d, r in zip(data, expected([d[1] for d in data]))]
    assert got == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in got) > 60


def test_normalised_text_has_no_tokens(spark):
    """A text that a tokenizer changes has zeros; its neighbours are left as they are."""
    texts = ["plain words", "� odd", "more words"]
    tools = token_alignment.tokenizers(ENGLISH, PIECES, PATTERN)
    fits = token_alignment._gives_back(
        [np.frombuffer((" " + t).encode(), np.uint8) for t in texts],
        np.concatenate([np.array(tools.a.encode_ordinary(" " + t)) for t in ("plain words", "? odd", "more wordz")]),
        np.array([len(tools.a.encode_ordinary(" " + t)) for t in ("plain words", "? odd", "more wordz")]), tools.table_a)
    assert fits.tolist() == [True, False, False]


def test_align_gives_ids_and_group_ends(spark):
    data = [(i, t, None, None, None) for i, t in enumerate(["one unbelievable thing", None, "", "日本語"])]
    rows = {r.doc_id: r for r in token_alignment.align(cases.table(spark, data), ENGLISH, PIECES, PATTERN).collect()}
    for i, (a, b, groups, _) in enumerate(plain([d[1] for d in data])):
        assert (rows[i].ids_a, rows[i].ids_b) == (a, b)
        assert rows[i].group_a == np.cumsum([len(x) for x, _ in groups]).tolist()
        assert rows[i].group_b == np.cumsum([len(y) for _, y in groups]).tolist()


def test_empty_table(spark):
    assert token_alignment.digests(cases.empty(spark), ENGLISH, PIECES, PATTERN).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 300)), st.sets(st.integers(1, 300)), st.integers(1, 320)), min_size=1,
                max_size=4))
def test_cuts_are_the_shared_ends(texts):
    ends_a, ends_b, a, b, offset, want = [], [], [0], [0], 0, []
    for one, two, last in texts:
        one, two = {x for x in one if x < last} | {last}, {x for x in two if x < last} | {last}
        ends_a += [offset + x for x in sorted(one)]
        ends_b += [offset + x for x in sorted(two)]
        want += [offset + x for x in sorted(one & two)]
        offset += last
        a.append(len(ends_a))
        b.append(len(ends_b))
    ends_a, ends_b = np.array(ends_a), np.array(ends_b)
    group_a, group_b = token_alignment.shared_cuts(ends_a, ends_b, np.array(a), np.array(b))
    assert ends_a[group_a - 1].tolist() == ends_b[group_b - 1].tolist() == want
