import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowsift.llm import bpe_codec, pack_bfd, pack_nnls
from flowsift.llm.token_ids import document_ids, rank_encoder
from flowsift.llm.tokens import Encoder, batches_by_size, cuts
from tests.llm import cases

ENGLISH = public.path("byte_bpe_50k.json")
MULTI = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def english():
    return Tokenizer.from_file(ENGLISH)


@pytest.fixture(scope="module")
def multi():
    return tiktoken.Encoding("multi", pat_str=public.PATTERN, mergeable_ranks=bpe_codec.read_ranks(MULTI),
                             special_tokens={})


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_str(bpe_codec.model_of_ranks(bpe_codec.read_ranks(MULTI), public.PATTERN))


ODD = st.text(st.sampled_from("ab c'  \n\t 　\x85\x1cé1½٣🙂'll!?<|endoftext|>\r"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(ODD)
def test_cuts_join_to_the_text(text):
    assert " ".join(cuts(text)) == text


def test_added_token_in_a_text(english):
    ranks = rank_encoder(ENGLISH, public.PATTERN)
    for text in ("see <|endoftext|> here", "<|endoftext|><|endoftext|>", " <|endoftext|", "a<|endoftext|>\n b"):
        want = english.encode(text, add_special_tokens=False).ids
        assert document_ids(ranks, text, 0) == np.array([*want, 0], "<u2").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.lists(ODD, max_size=5))
def test_both_libraries_give_the_same_ids(english, multi, model, texts):
    ranks = rank_encoder(ENGLISH, public.PATTERN)
    for text in texts:
        want = english.encode(text, add_special_tokens=False).ids
        assert document_ids(ranks, text, 7) == np.array([*want, 7], "<u2").tobytes()
    got = list(Encoder(model).encode(texts))
    assert got == [np.array(multi.encode_ordinary(t), "<u4").tobytes() for t in texts]


def test_vocabulary_of_the_json_file_is_that_of_the_rank_file():
    own = rank_encoder(ENGLISH, public.PATTERN)._mergeable_ranks
    assert own == bpe_codec.read_ranks(public.path("byte_bpe_50k.tiktoken"))


def test_codec_digests(spark, multi):
    data = cases.rows()
    got = bpe_codec.digests(cases.table(spark, data), MULTI, public.PATTERN).collect()
    want = Counter()
    for doc_id, text, *_ in data:
        ids = multi.encode_ordinary(text or "")
        want[(doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
              hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, got)) == want
    assert bpe_codec.digests(cases.empty(spark), MULTI, public.PATTERN).count() == 0


def test_codec_offsets_and_split_characters(spark):
    df = spark.createDataFrame([(1, "a 🙂é b"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in bpe_codec.encode(df, MULTI, public.PATTERN, offsets=True).collect()}
    text, row = "a 🙂é b", rows[1]
    n = len(row["ids"]) // 4
    assert n == len(row["starts"]) == len(row["ends"])
    assert row["starts"][0] == 0 and row["ends"][-1] == len(text)
    covered = {i for a, b in zip(row["starts"], row["ends"]) for i in range(a, b)}
    assert covered == set(range(len(text)))
    assert rows[2]["starts"] == []
    halves = [(i, row["ids"][:4 * i]) for i in range(n + 1)]
    back = bpe_codec.decode(spark.createDataFrame(halves, "doc_id long, ids binary"), MULTI).collect()
    for r in back:
        assert text.encode().startswith(bytes(r["decoded"]))
        assert r["decoded_text"] == bytes(r["decoded"]).decode("utf-8", "replace")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_decreasing(lengths):
    packed = pack_bfd.best_fit_decreasing(lengths, 64)
    assert sorted(i for w in packed for i in w) == list(range(len(lengths)))
    # The plain rule: longest first, into the fullest window that takes it.
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(64 - n)
    assert sorted(64 - sum(lengths[i] for i in w) for w in packed) == sorted(rooms)


def _expected(english, data, end):
    return Counter((d, tuple(english.encode(t or "", add_special_tokens=False).ids + [end])) for d, t, *_ in data)


def test_bfd_pack_is_lossless(spark, english):
    data = cases.rows()
    rows = pack_bfd.pack(cases.table(spark, data), ENGLISH, public.PATTERN, window=128).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    pieces = defaultdict(list)
    for r in rows:
        ids, at = np.frombuffer(r["ids"], "<u2"), r["cu_seqlens"]
        positions = np.frombuffer(r["position_ids"], "<u2")
        assert len(ids) == 128 and at[0] == 0 and at[-1] == r["n_tokens"] <= 128
        assert (ids[at[-1]:] == 50256).all() and not positions[at[-1]:].any()
        for doc, start, a, b in zip(r["doc_ids"], r["doc_starts"], at, at[1:]):
            assert (positions[a:b] == np.arange(b - a)).all()
            pieces[doc].append((start, tuple(ids[a:b].tolist())))
    for doc, want in _by_doc(_expected(english, data, 50256)).items():
        assert Counter(pieces[doc]) == Counter(
            (k, ids[k:k + 128]) for ids in want for k in range(0, len(ids), 128))
    assert pack_bfd.pack(cases.empty(spark), ENGLISH, public.PATTERN).count() == 0


def _by_doc(counter):
    out = defaultdict(list)
    for (doc, ids), n in counter.items():
        out[doc] += [ids] * n
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 400), max_size=20))
def test_nnls_plan_places_every_rest_once(histogram):
    plan = pack_nnls.solve(histogram, 64)
    used = defaultdict(list)
    for length, n in histogram.items():
        for parts in pack_nnls.place(plan, 64, length, np.arange(n)):
            assert sum(p[1] for p in parts) == length
            for _, size, window, offset in parts:
                used[window].append((offset, size))
    assert set(used) == set(range(plan["in_all"]))
    for spans in used.values():
        at = 0
        for offset, size in sorted(spans):
            assert offset == at
            at += size
        assert at <= 64
    total = sum(k * v for k, v in histogram.items())
    # A greedy window leaves at most a 64th; only the last window of the stream may be half empty.
    assert plan["in_all"] <= total / (64 * (1 - pack_nnls.SLACK)) + 1


def test_nnls_fills_windows_where_lengths_match():
    plan = pack_nnls.solve({100: 50, 924: 50, 512: 20, 300: 9, 400: 9, 324: 9}, 1024)
    assert plan["in_all"] == 50 + 10 + 9 and not plan["stream"]


def test_nnls_pack(spark, english):
    data = cases.rows()
    rows = pack_nnls.digests(pack_nnls.pack(cases.table(spark, data), ENGLISH, public.PATTERN, window=128)).collect()
    windows, pieces = defaultdict(list), Counter()
    for r in rows:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[(r["doc_id"], r["doc_tokens"], r["start"], r["length"], r["ids_crc32"])] += 1
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 128
    tokens = sum(r["length"] for r in rows)
    assert tokens / (128 * len(windows)) > 0.97
    for doc, wanted in _by_doc(_expected(english, data, 0)).items():
        own = [p for p, n in pieces.items() if p[0] == doc for _ in range(n)]
        assert sum(p[3] for p in own) == sum(map(len, wanted))
        for p in own:
            assert any(len(ids) == p[1] and zlib.crc32(np.array(ids[p[2]:p[2] + p[3]], "<u4").tobytes()) == p[4]
                       for ids in wanted)
        if len(wanted) == 1:
            at = 0
            for p in sorted(own, key=lambda p: p[2]):
                assert p[2] == at
                at += p[3]
            assert at == len(wanted[0])
    assert pack_nnls.pack(cases.empty(spark), ENGLISH, public.PATTERN).count() == 0


def test_batches_by_size():
    assert [list(range(*s.indices(5))) for s in batches_by_size([3, 9, 1, 1, 1], 3)] == [[0], [1], [2, 3, 4]]
    assert list(batches_by_size([], 3)) == []
