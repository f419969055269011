import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flowsift.llm import simhash_pivots
from tests.llm import cases


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """component_id of each (doc_id, fingerprint)."""
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                label[top(i)] = top(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(top(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return [least[top(i)] for i in range(len(rows))]


def test_documents_equal_brute_force(spark):
    data = cases.rows()
    got = simhash_pivots.near_classes(cases.table(spark, data))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = [(d[0], plain_fingerprint(d[1])) for d in data]
    want = [(i, f"{fp:016x}", c) for (i, fp), c in zip(rows, plain_components(rows))]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_fingerprint_in_parts(monkeypatch):
    text = next(t for t in cases.texts() if t and len(t.split()) > 5000)
    whole = simhash_pivots.fingerprint(text)
    monkeypatch.setattr(simhash_pivots, "PART_HASHES", 7)
    assert simhash_pivots.fingerprint(text) == whole == plain_fingerprint(text)


def ball(rng, centre, bits, n):
    """n distinct fingerprints that differ from the centre in some of the given bits."""
    out = set()
    while len(out) < n:
        flips = rng.choice(bits, rng.integers(0, 9), replace=False)
        out.add(int(centre) ^ sum(1 << int(b) for b in flips))
    return out


@pytest.mark.parametrize("limit", [simhash_pivots.LIMIT, 16])
def test_links_connect_what_is_near(spark, limit):
    rng = np.random.default_rng(7)
    fps = set(rng.integers(0, 2 ** 64, 300, dtype=np.uint64).tolist())
    for fp in list(fps)[:100]:  # pairs at distances of 1 to 6
        fps.add(fp ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False)))
    fps |= ball(rng, 12345678901234567890, np.arange(0, 40, 2), 700)
    fps = np.array(sorted(fps), np.uint64)
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(3)
    found = simhash_pivots.links(table, len(fps), limit).distinct().collect()
    assert all((a ^ b) % 2 ** 64 for a, b in found)
    assert len(found) < 40 * len(fps)  # no pairs of a whole group
    label = {int(x): int(x) for x in fps.view(np.int64)}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in found:
        label[top(a)] = top(b)
    distance = np.bitwise_count(fps[:, None] ^ fps)
    group = np.array([top(int(x)) for x in fps.view(np.int64)])
    for i in range(len(fps)):
        assert (group[distance[i] <= 3] == group[i]).all()
    true = plain_components([(i, int(x)) for i, x in enumerate(fps)])
    assert len(set(true)) == len(set(group.tolist()))


def test_distance_within_a_block_follows_from_two_references():
    rng = np.random.default_rng(3)
    fp, ref, mask = rng.integers(0, 2 ** 64, 50, dtype=np.uint64), simhash_pivots.WITHIN, 0xFFFF0000
    turned = ref ^ np.uint64(mask)
    two = simhash_pivots.distances(fp, ref).astype(int) - simhash_pivots.distances(fp, turned) + 16
    assert (two // 2 == simhash_pivots.distances(fp, ref, mask)).all()


def test_empty_table_and_no_ids(spark):
    assert simhash_pivots.near_classes(cases.empty(spark)).collect() == []
    rows = simhash_pivots.near_classes(cases.table(spark, [(None, "a b c d", None, None, None)] * 3))
    assert rows.where(F.col("component_id").isNull()).count() == 3
