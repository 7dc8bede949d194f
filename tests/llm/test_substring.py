"""Substring dedup against a plain window count."""

import hashlib
import random
import re

import numpy as np

from retally.llm import substring
from retally.llm.substring import Batch, repeated_words, rolling

SCHEMA = "doc_id long, text string, batch string, ids string, n_words string"


def slow(rows, window=20):
    """rows in document order -> (id, words, removed, digest of what stays)."""
    seen, out = set(), []
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def result(frame, **more):
    return sorted((tuple(r)[:4] for r in repeated_words(frame, **more).collect()), key=lambda r: (r[0] is None, r[0]))


def test_whole_table_equals_plain_count(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert result(docs) == slow(rows)


def test_planted_repeats_across_many_small_batches(spark, monkeypatch):
    monkeypatch.setattr(substring, "BATCH_BYTES", 3000)
    monkeypatch.setattr(substring, "RANGE_WORDS", 500)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "日本", "a b"]
    passages = [" ".join(rng.choices(vocabulary, k=n)) for n in (19, 20, 21, 55, 300)]
    rows = []
    for i in range(120):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 60)))]
        for p in passages:
            if rng.random() < 0.3:
                parts += [p, "\n\t".join(rng.choices(vocabulary, k=rng.randrange(0, 12)))]
        rows.append((i, " ".join(parts)))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "same " * 3000), (204, "same " * 25), (205, rows[7][1]), (206, rows[7][1])]
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(5)
    assert result(frame, parts=4) == slow(rows)


def test_spans_and_text(spark):
    line = " ".join(f"p{i}" for i in range(50))
    frame = spark.createDataFrame([(1, "a b " + line), (2, "c " + line + " d")], "doc_id long, text string")
    got = {r.doc_id: r for r in repeated_words(frame, with_text=True).collect()}
    assert got[1].spans == [] and got[2].kept_text == "c d"
    assert [(s.start, s.length) for s in got[2].spans] == [(1, 50)]


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert repeated_words(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(f"q{i}" for i in range(30))
    got = result(spark.createDataFrame([(None, text), (4, text), (4, text)], "doc_id long, text string"))
    assert [(r[0], r[2]) for r in sorted(got, key=lambda r: (r[0] is None, r[2]))] == [(4, 0), (4, 30), (None, 30)]


def test_rolling_hash_is_the_polynomial():
    words = np.random.default_rng(1).integers(0, 2**63, 50).astype(np.uint64)
    for width in (1, 3, 10, 20):
        want = [sum(int(w) * int(substring.MULTIPLIER) ** j for j, w in enumerate(words[i:i + width])) % 2**64
                for i in range(50 - width + 1)]
        assert rolling(words, width).tolist() == want
    assert len(rolling(words[:5], 10)) == 0
    assert Batch.__doc__
