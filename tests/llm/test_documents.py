"""Operators on whole documents against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.llm import jaccard_join, kd_shards, line_runs, quality_rules, suffix_dedup
from flowsift.llm.components import connect
from flowsift.llm.difference_cover import equal_prefixes, suffix_array
from flowsift.llm.textbytes import PartHashes, flat, words
from tests.llm import cases

WORD = "[^\x20\x09-\x0D]+"


def python_udfs(df) -> bool:
    return any(k in df._jdf.queryExecution().executedPlan().toString() for k in ("Python", "Pandas", "MapInArrow"))


# --- quality rules -----------------------------------------------------------------------


def statistics(text):
    text = text or ""
    found = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = defaultdict(list)
    for i in range(len(found) - 7):
        windows[tuple(found[i:i + 8])].append(i)
    covered = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    failed = len(found) < 20 or 100 * len(covered) > 30 * len(found)
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


def test_statistics_equal_brute_force(spark):
    data = cases.rows() + [(900, "p q r s t u v w x " * 5 + "#* $%&|<> ~", "en", "s", 1)]
    df = quality_rules.judge(cases.table(spark, data), [])
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                   r["n_repeat_words"], r["base_failed"]) for r in df.collect())
    assert got == Counter((d, *statistics(t)) for d, t, *_ in data)
    assert not python_udfs(df)
    assert quality_rules.judge(cases.empty(spark), []).count() == 0


@pytest.fixture(scope="module")
def marked(spark):
    """Shouting and symbols are bad, the rest is good."""
    rnd = random.Random(3)
    data, labels = [], []
    for i in range(400):
        word = ["".join(rnd.choice("abcdefg") for _ in range(rnd.randint(2, 8))) for _ in range(60)]
        kind = i % 10
        if kind == 0:
            word = [w.upper() + "!!" for w in word]
        elif kind == 1:
            word = [w + "#$" for w in word]
        data.append((i, " ".join(word), "en", "s", 1))
        labels.append((i, int(kind > 1)))
    labels += [(0, 0), (1, None), (None, 0), (5000, 0)]
    return data, spark.createDataFrame(labels, "doc_id long, quality int")


def test_learned_rules_find_the_bad_and_keep_the_good(spark, marked):
    data, labels = marked
    docs = cases.table(spark, data)
    rules = quality_rules.learn(docs, labels)
    assert rules and all(1 <= len(r) <= quality_rules.MAX_CONDITIONS for r in rules)
    df = quality_rules.judge(docs, rules)
    kept = {r["doc_id"]: r["kept"] for r in df.collect()}
    assert not python_udfs(df)
    good = [kept[i] for i in kept if i % 10 > 1]
    bad = [kept[i] for i in kept if i % 10 <= 1]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)
    assert rules == quality_rules.learn(docs.repartition(7), labels)
    left = quality_rules.good_documents(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(kept.values())


def test_conditional_is_the_first_rule_that_holds(spark):
    c = quality_rules.Condition
    rules = [(c("words", True, 100.0),), (c("words", True, 30.0), c("symbol_share", False, 0.1))]
    rows = quality_rules.judge(cases.table(spark, cases.rows()), rules).collect()
    for r in rows:
        want = None
        if not r["base_failed"]:
            share = r["n_symbols"] / r["word_chars"]
            want = str(rules[0][0]) if r["n_words"] >= 100 else (
                " and ".join(map(str, rules[1])) if r["n_words"] >= 30 and share < 0.1 else None)
        assert r["rule"] == want and r["kept"] == (not r["base_failed"] and want is None)


def test_no_labels_no_rules(spark, marked):
    data, labels = marked
    docs = cases.table(spark, data[:20])
    assert quality_rules.learn(docs, labels.limit(0)) == []
    assert quality_rules.learn(docs, labels.where("quality = 1")) == []
    assert quality_rules.learn(cases.empty(spark), labels) == []


# --- shards --------------------------------------------------------------------------------


def shards_of(df):
    rows = df.collect()
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return rows, {k: sum(r["size"] for r in v) for k, v in by.items()}


def test_kd_shards_hold_every_row_and_near_equal_bytes(spark):
    rnd = random.Random(4)
    data = [(i, "w" * rnd.choice([0, 5, 50, 400]), rnd.choice(["en", "fr"]),
             "hot" if rnd.random() < 0.4 else f"s{rnd.randrange(9)}", 1) for i in range(3000)]
    data[7] = (7, None, None, None, None)
    df = kd_shards.shard(cases.table(spark, data), shards=16)
    rows, sizes = shards_of(df)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in data)
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(abs(s - mean) for s in sizes.values()) <= 4 * 401
    assert not python_udfs(df)


def test_kd_search_narrows_ranges(spark, monkeypatch):
    rnd = random.Random(8)
    data = [(rnd.randrange(10 ** 12), "w" * rnd.choice([0, 5, 50]), "en", "hot", 1) for _ in range(300)]
    docs = cases.table(spark, data)
    plain = sorted(map(tuple, kd_shards.shard(docs, shards=3).collect()), key=repr)
    monkeypatch.setattr(kd_shards, "FEW_ROWS", 3)
    monkeypatch.setattr(kd_shards, "RANGES", 256)
    assert sorted(map(tuple, kd_shards.shard(docs, shards=3).collect()), key=repr) == plain


def kd_tree(rows, shards, first=0, whole=None):
    """(row, shard) by the plain rule; a row is (size, source, lang, id, crc, place)."""
    if shards == 1 or not rows:
        return [(r, first) for r in rows]
    width = [max(r[d] for r in rows) - min(r[d] for r in rows) for d in range(4)]
    whole = whole or [max(1, w) for w in width]
    widest = max(range(4), key=lambda d: width[d] / whole[d])
    rows = sorted(rows, key=lambda r: (r[widest], r[3], r[4], r[0], r[5]))
    total = sum(r[0] for r in rows)
    goal, before, cut = total * (shards // 2) / shards, 0, 0
    while cut < len(rows) - 1 and before + rows[cut][0] < goal:
        before += rows[cut][0]
        cut += 1
    size = rows[cut][0]
    nearer = size - (goal - before) <= goal - before
    if not before or (nearer and before + size < total):
        cut += 1
    half = shards // 2
    return kd_tree(rows[:cut], half, first, whole) + kd_tree(rows[cut:], shards - half, first + half, whole)


@pytest.mark.parametrize("shards", [3, 16])
def test_kd_shards_equal_the_plain_tree(spark, monkeypatch, shards):
    monkeypatch.setattr(kd_shards, "FEW_ROWS", 5)
    rnd = random.Random(9)
    data = cases.rows() + [(i, "w" * rnd.choice([1, 9, 90]), rnd.choice(["en", "fr", None]),
                            "hot" if rnd.random() < 0.4 else f"s{rnd.randrange(9)}", 1) for i in range(500, 900)]
    data += [data[-1]] * 60
    code = lambda x: -1 if x is None else zlib.crc32(x.encode())
    rows = [(len((t or "").encode()) + 1, code(s), code(la), -(2 ** 62) if d is None else d,
             zlib.crc32((t or "").encode()), k) for k, (d, t, la, s, _) in enumerate(data)]
    want = Counter((r[3], r[0], r[4], shard) for r, shard in kd_tree(rows, shards))
    got = kd_shards.shard(cases.table(spark, data), shards=shards).collect()
    assert Counter((-(2 ** 62) if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"], r["shard"])
                   for r in got) == want


def test_kd_odd_tables(spark):
    data = cases.rows()
    rows, _ = shards_of(kd_shards.shard(cases.table(spark, data), shards=4))
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, *_ in data)
    alike = [(1, "same", "en", "s", 4)] * 40 + [(None, "none", "en", "s", 4)] * 40
    rows, sizes = shards_of(kd_shards.shard(cases.table(spark, alike), shards=4))
    assert len(rows) == 80 and set(sizes.values()) == {100}
    assert kd_shards.shard(cases.empty(spark), shards=16).count() == 0
    assert len(shards_of(kd_shards.shard(cases.table(spark, data), target_bytes=4000))[1]) > 3


# --- near duplicates -----------------------------------------------------------------------


def shingles(text):
    found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(WORD, text or "")]
    if not found:
        return set()
    return {tuple(found[i:i + 5]) for i in range(len(found) - 4)} or {tuple(found)}


def near_groups(data):
    """The shingles of each row, and the group that it is in."""
    sets = [shingles(t) for _, t, *_ in data]
    at = list(range(len(data)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                at[root(i)] = root(j)
    return sets, [root(i) for i in range(len(data))]


def near(data):
    sets, group = near_groups(data)
    least = {}
    for i, (doc, *_) in enumerate(data):
        if doc is not None:
            least[group[i]] = min(doc, least.get(group[i], doc))
    return Counter((doc, len(sets[i]), least.get(group[i]) if sets[i] else doc) for i, (doc, *_) in enumerate(data))


def test_jaccard_join_equals_brute_force(spark):
    data = cases.rows(90)
    df = jaccard_join.near_classes(cases.table(spark, data))
    assert Counter(map(tuple, df.collect())) == near(data)
    assert jaccard_join.near_classes(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_jaccard_join_on_chains_and_large_groups(spark, monkeypatch, hot):
    if hot:  # frequent shingles and several buckets, as on large tables
        monkeypatch.setattr(jaccard_join, "SAMPLED", 1)
        monkeypatch.setattr(jaccard_join, "HOT_LEAST", 6)
        monkeypatch.setattr(jaccard_join, "BUCKET", 500)
        monkeypatch.setattr(jaccard_join, "RARE", 2)
        monkeypatch.setattr(jaccard_join, "HUBS", 1)
        monkeypatch.setattr(jaccard_join, "FEW_PAIRS", 3)
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    data, base = [], [word() for _ in range(40)]
    for i in range(60):  # a chain: each differs a little from the one before
        base = list(base)
        base[rnd.randrange(40)] = word()
        data.append((1000 - i, " ".join(base), "en", "s", 1))
    star = [word() for _ in range(50)]
    for i in range(60):  # near copies of one text, some too far from each other
        own = list(star)
        for _ in range(rnd.randint(0, 3)):
            own[rnd.randrange(50)] = word()
        data.append((2000 + i, " ".join(own), "en", "s", 1))
    common = " ".join(word() for _ in range(12))
    for i in range(60):  # a common passage alone links nothing
        data.append((3000 + i, common + " " + " ".join(word() for _ in range(rnd.randint(1, 40))), "en", "s", 1))
    got = Counter(map(tuple, jaccard_join.near_classes(cases.table(spark, data)).collect()))
    assert got == near(data)


def test_one_of_each_decides_by_row(spark):
    """One row of each group stays: the smallest id, no id last, one of those alike. A text that
    shares its id with a copy is judged by itself; rows without words stay."""
    data = cases.rows(90)
    data += [data[30]] * 3 + [(None, data[31][1], "en", "s", 1)] * 2  # alike; near copies without an id
    data += [(None, "no id has this text of ten words in all here", "en", "s", 1)] * 2
    data += [(data[30][0], "a clean text that shares its id with some copies " * 2, "en", "s", 1)]
    docs = cases.table(spark, data).withColumn("unit", F.lit("mine")).withColumn("copies", F.lit("mine"))
    left = jaccard_join.one_of_each(docs)
    assert left.columns == docs.columns
    kept = left.collect()
    assert all(r["unit"] == r["copies"] == "mine" for r in kept)
    sets, group = near_groups(data)
    want = Counter((data[i][0], data[i][1]) for i in range(len(data)) if not sets[i])
    members = defaultdict(list)
    for i in range(len(data)):
        if sets[i]:
            members[group[i]].append(data[i][:2])
    for rows in members.values():
        want[min(rows, key=lambda r: (r[0] is None, r[0] or 0))] += 1
    assert Counter((r["doc_id"], r["text"]) for r in kept) == want


def test_near_copies_make_rows_in_proportion(spark, monkeypatch):
    """Variants of one text: links are found without enumerating the pairs of the group."""
    rnd = random.Random(6)
    star = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    data = []
    for i in range(1500):
        own = list(star)
        own[rnd.randrange(60)] = f"w{i}"
        data.append((i, " ".join(own), "en", "s", 1))
    docs = cases.table(spark, data)
    sizes = []
    verified = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, sets: sizes.append(pairs.count()) or verified(pairs, sets))
    assert {r["component_id"] for r in jaccard_join.near_classes(docs).collect()} == {0}
    assert sum(sizes) < 40 * len(data)


def test_components(spark):
    rnd = random.Random(2)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 480)]
    pairs += [(700, i) for i in range(701, 760)] + [(5, 5)]
    got = {r["class"]: r["comp"] for r in connect(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {}
    for a, b in pairs:
        if a != b:
            x, y = want.get(a, {a}), want.get(b, {b})
            for k in x | y:
                want[k] = x | y
    assert got == {k: min(v) for k, v in want.items()}


# --- line runs -----------------------------------------------------------------------------


def cut_lines(data, length):
    rows = sorted({(d is None, d if d is not None else 0, t) for d, t, *_ in data if t is not None})
    seen, out = {}, {}
    for no_id, doc, text in rows:
        lines = text.split("\n")
        own = [k for k, x in enumerate(lines) if re.search(WORD, x)]
        gone = set()
        for i in range(len(own) - length + 1):
            key = tuple(lines[k] for k in own[i:i + length])
            first = seen.setdefault(key, ((no_id, doc, text), i))
            if first[0] != (no_id, doc, text) or first[1] + length <= i:
                gone.update(range(i, i + length))
        dropped = {own[i] for i in gone}
        out[(None if no_id else doc, text)] = (
            "\n".join(x for k, x in enumerate(lines) if k not in dropped), len(own), len(gone),
            sum(1 for i in gone if i - 1 not in gone))
    return out


@pytest.mark.parametrize("length", [1, 2, 3, 5])
def test_line_runs_equal_brute_force(spark, length):
    rnd = random.Random(length)
    data = [(i, "\n".join(rnd.choice("abcde ") for _ in range(rnd.randint(1, 30))), "en", "s", 1) for i in range(25)]
    data += [(i + 100, t, "en", "s", 1) for i, t in enumerate(cases.texts(30)) if t != "\n\n"]
    want = cut_lines(data, length)
    done = line_runs.dedup(cases.table(spark, data), length)
    for r in done.collect():
        expected = want.get((r["doc_id"], next(t for d, t, *_ in data if d == r["doc_id"])), (None, 0, 0, 0))
        assert (r["text"], *r["line_runs"]) == expected


def cut_long_lines(data, length, words):
    """Like cut_lines, with lines of so many words as runs of one line."""
    rows = sorted({(d, t) for d, t, *_ in data})
    seen, out = {}, {}
    for doc, text in rows:
        lines = text.split("\n")
        own = [k for k, x in enumerate(lines) if re.search(WORD, x)]
        gone = set()
        for n in (1, length):
            for i in range(len(own) - n + 1):
                key = tuple(lines[k] for k in own[i:i + n])
                if n == length or len(re.findall(WORD, key[0])) >= words:
                    first = seen.setdefault(key, (doc, text, i))
                    if first[:2] != (doc, text) or first[2] + n <= i:
                        gone.update(range(i, i + n))
        dropped = {own[i] for i in gone}
        out[doc] = ("\n".join(x for k, x in enumerate(lines) if k not in dropped), len(own), len(gone),
                    sum(1 for i in gone if i - 1 not in gone))
    return out


def test_long_lines_are_runs(spark):
    rnd = random.Random(9)
    pool = [" ".join(rnd.choice("abcdef") for _ in range(n)) + end
            for n in (3, 49, 50, 51, 200) for end in ("", " ", "\t\r", " y z")] + ["  " + "q " * 50, "", " "]
    data = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.choice([1, 1, 2, 5, 9]))), "en", "s", 1) for i in range(60)]
    for length, words in ((2, 50), (3, 50), (2, 1)):
        want = cut_long_lines(data, length, words)
        got = line_runs.dedup(cases.table(spark, data), length, words).collect()
        assert {r["doc_id"]: (r["text"], *r["line_runs"]) for r in got} == want


def test_pipeline_drops_copies_of_one_long_line(spark):
    long, short = " ".join(f"w{i}" for i in range(50)), " ".join(f"v{i}" for i in range(49))
    texts = [long, long, f"a b\n{long}\nc d", short, short, f"e f\n{short}\ng h"]
    data = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    left = line_runs.deduped_documents(cases.table(spark, data, clashing=False)).collect()
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in left} == {
        0: (long, len(long)), 2: ("a b\nc d", 7), **{i: (texts[i], len(texts[i])) for i in (3, 4, 5)}}


def test_line_runs_odd_tables(spark):
    data = cases.rows()
    docs = cases.table(spark, data)
    done = line_runs.dedup(docs)
    assert done.drop("line_runs").columns == [c for c in docs.columns if c != "line_runs"] or done.count() == len(data)
    assert Counter(r["doc_id"] for r in done.select("doc_id").collect()) == Counter(d for d, *_ in data)
    left = line_runs.deduped_documents(cases.table(spark, data, clashing=False))
    assert left.columns == cases.SCHEMA.names
    assert all(r["n_chars"] == len(r["text"]) for r in left.collect() if r["text"] and r["n_chars"] != 111
               and r["doc_id"] is not None)
    assert line_runs.deduped_documents(cases.table(spark, [], clashing=False)).count() == 0


def test_suffix_ranks_sort_suffixes(spark):
    data = [(1, "b\na\nb\na\nc", "en", "s", 1), (2, "a\nb\na\nb", "en", "s", 1)]
    lines = line_runs.line_table(cases.table(spark, data, clashing=False))
    value = {r["line"]: r["line"] for r in lines.collect()}
    seq = defaultdict(dict)
    for r in lines.collect():
        seq[r["row"]][r["at"]] = value[r["line"]]
    for length in (1, 2, 3):
        ranks = [(r["rank"], [seq[r["row"]][r["at"] + k] for k in range(length)])
                 for r in line_runs.suffix_ranks(lines, length).collect()]
        for rank, key in ranks:
            same = {q for q, k in ranks if k == key}
            assert same == {rank} and sum(k == key for _, k in ranks) > 1
            assert all((q < rank) == (k < key) for q, k in ranks if k != key)


# --- repeated strings ----------------------------------------------------------------------


def cut_strings(data, length):
    data = sorted({(d, t) for d, t, *_ in data if d is not None}, key=lambda x: (x[0], x[1] or ""))
    first = {}
    for doc, text in data:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i:i + length], doc)
    out = {}
    for doc, text in data:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < doc:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[(doc, text)] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check_strings(spark, data):
    want = cut_strings(data, 50)
    got = Counter(tuple(r) for r in suffix_dedup.digests(cases.table(spark, data)).collect())
    expected = Counter()
    for d, t, *_ in data:
        raw = (t or "").encode()
        expected[(d, *want.get((d, t), (len(raw), 0, 0, hashlib.sha256(raw).hexdigest())))] += 1
    assert got == expected


def test_suffix_dedup_equals_brute_force(spark):
    check_strings(spark, cases.rows(80))
    assert suffix_dedup.digests(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_suffix_dedup_on_spliced_texts(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    if seed == 2:  # many small buckets and groups, and grams split into windows
        monkeypatch.setattr(suffix_dedup, "MANY", 1)
        monkeypatch.setattr(suffix_dedup, "BUCKET", 30)
        monkeypatch.setattr(suffix_dedup, "SORTED_BYTES", 2000)
    letters = "ab" if seed == 3 else "abcdefghij klmé"
    source = ["".join(rnd.choice(letters) for _ in range(400)) for _ in range(4)]
    data = []
    for i in range(60):
        text = "".join(rnd.choice(source)[(a := rnd.randrange(350)):a + rnd.randint(20, 160)] + rnd.choice(letters)
                       for _ in range(rnd.randint(1, 5)))
        data.append((rnd.randrange(10 ** 6), text, "en", "s", 1))
    data += [(5, "z" * 900, "en", "s", 1), (6, "z" * 300 + "q" * 60, "en", "s", 1), (7, "q" * 61, "en", "s", 1)]
    check_strings(spark, data)


def noise(rnd, n):
    return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))


def test_suffix_dedup_fetches_only_runs_that_may_repeat(spark):
    rnd = random.Random(4)
    phrases = [noise(rnd, 24) for _ in range(5)]  # shared grams, but no shared window
    data = [(i, "".join(noise(rnd, 30) + rnd.choice(phrases) for _ in range(20)), "en", "s", 1) for i in range(40)]
    rows = suffix_dedup.keyed(cases.table(spark, data))
    found = suffix_dedup._judged(suffix_dedup._dealt(rows, 1, 50), 1, 50)
    assert found.count() == 0
    check_strings(spark, data)


def test_suffix_dedup_of_barely_equal_windows(spark):
    rnd = random.Random(6)
    data = []
    for i in range(120):
        same = noise(rnd, 49 + i % 4)  # one byte short of a window, a window, a little more
        data += [(2 * i + k, noise(rnd, rnd.randint(0, 60)) + same + noise(rnd, rnd.randint(0, 60)), "en", "s", 1)
                 for k in (0, 1)]
    check_strings(spark, data)


def test_suffix_dedup_of_documents(spark):
    data = cases.rows()
    docs = cases.table(spark, data, clashing=False)
    left = suffix_dedup.deduped_documents(docs)
    assert left.columns == docs.columns
    want = cut_strings(data, 50)
    rows = {(r["doc_id"]): r for r in left.collect()}
    for (doc, text), (n, removed, _, _) in want.items():
        if removed == n and n:
            assert doc not in rows or sum(d == doc for d, *_ in data) > 1
        elif not removed and sum(d == doc for d, *_ in data) == 1:
            assert rows[doc]["text"] == text


def test_suffix_array_by_difference_cover():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(0, 60)))
        assert suffix_array(a).tolist() == sorted(range(len(a)), key=lambda i: a[i:].tolist())
    a = np.array([1, 2, 1, 2, 1, 2, 3])
    order = np.array([0, 2, 4])
    assert equal_prefixes(a, order, 3).tolist() == [False, True, False]


def test_part_hashes_do_not_depend_on_place():
    import pyarrow as pa

    data, offsets = flat(pa.array(["ab cd ab", None, "", " cd"]))
    start, end, row = words(data, offsets)
    assert row.tolist() == [0, 0, 0, 3]
    hashes = PartHashes(data).of(start, end)
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3] and hashes[0] != hashes[1]
    assert flat(pa.array(["x", "yy", "zzz"])[1:])[1].tolist() == [0, 2, 5]


@pytest.mark.parametrize("stage", [line_runs.deduped_documents, suffix_dedup.deduped_documents, jaccard_join.one_of_each])
def test_stages_leave_columns_of_clashing_names(spark, stage):
    names = ["line_runs", "n_bytes", "KEPT", "removed", "unit", "copies", "row", "spans"]
    docs = cases.table(spark, cases.rows(), clashing=False).drop("n_chars").withColumns(
        {c: F.concat(F.lit(f"my {c} "), F.col("doc_id")) for c in names})
    done = stage(docs)
    assert done.schema == docs.schema
    rows = done.collect()
    assert len(rows) > 20
    assert all(r[c] == (None if r["doc_id"] is None else f"my {c} {r['doc_id']}") for r in rows for c in names)
