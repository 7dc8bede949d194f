"""SimHash near-dedup against brute force."""

import random

import numpy as np
import xxhash

from retally.llm import simhash
from retally.llm.simhash import masks, near_groups, similar_links, spanning_links

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, node string"


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows):
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(fps)):
        for y in range(x):
            if bin(fps[x][1] ^ fps[y][1]).count("1") <= 3:
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(fps):
        least.setdefault(find(x), []).append(i)
    return sorted((i, f"{fp:016x}", min(least[find(x)])) for x, (i, fp) in enumerate(fps))


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(1)
    covering = masks(3)
    assert len(covering) == 15
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(diff & m == 0 for m in covering)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in near_groups(docs).collect())
    assert got == slow_groups(rows)


def test_edge_cases_and_clashing_columns(spark):
    long = "Word " * 40000 + "end"
    texts = [None, "", " \t\n", "one", "ONE", "one two", "a b c", "a b c", "É b c", "é b c", long, long.lower(),
             "the same words over and over again with a small change at the end here",
             "the same words over and over again with a small change at the end there"]
    data = [(i, t, None, None, None, "x", "y") for i, t in enumerate(texts)]
    got = sorted(tuple(r) for r in near_groups(spark.createDataFrame(data, SCHEMA)).collect())
    assert got == slow_groups(list(enumerate(texts)))
    assert near_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    repeated = near_groups(spark.createDataFrame([data[6], data[6]], SCHEMA)).collect()
    assert len(repeated) == 2 and {r.component_id for r in repeated} == {6}


def test_dense_entries_are_cut_into_blocks_without_losing_links(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    fps = {base}
    for _ in range(400):                       # a ball of close fingerprints: large table entries
        fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    values = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(v,) for v in values], "fp long")

    def classes(links):
        root = {v: v for v in values}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in links:
            assert bin((a ^ b) & (2**64 - 1)).count("1") <= 3
            root[find(a)] = find(b)
        return sorted(sorted(v for v in values if find(v) == r) for r in {find(v) for v in values})

    exact = classes([(a, b) for a in values for b in values if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3])
    for entry in (7, 100, simhash.ENTRY):
        assert classes([tuple(r) for r in similar_links(frame, 3, entry).collect()]) == exact


def test_spanning_links_join_what_all_pairs_join():
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, 2**12, 300).astype(np.uint64))
    links = spanning_links(values, values, 1)
    assert len(links) < len(values)
    assert all(bin(a ^ b).count("1") <= 1 for a, b in links)

