"""Operator 11: the positional index against brute force, cut texts, blocks of items, proximity."""

import hashlib
import random
import re

import pytest

from retally.llm import decontam
from retally.llm.queries import op11_benchmark_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC = "doc_id long, text string, source string"
ITEM = "item_id long, text string, lang string"


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def windows_of(text, window):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[i:i + window]) for i in range(max(1, len(w) - window + 1))}


def brute(docs, items, window=10):
    wins = {}
    for name, text in items:
        for x in windows_of(text, window):
            wins.setdefault(x, set()).add("" if name is None else str(name))
    sizes = {len(x) for x in wins}
    out = []
    for doc, text in docs:
        w, hit, names = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                got = wins.get(tuple(w[i:i + size]))
                if got:
                    names |= got
                    hit |= set(range(i, i + size))
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, "s") for d, t in docs], DOC).repartition(3),
            spark.createDataFrame([(i, t, "en") for i, t in items], ITEM))


def made(seed, n_docs=60, n_items=12):
    rng = random.Random(seed)
    vocabulary = ["the"] * 6 + ["of", "and"] * 3 + [f"w{i}" for i in range(40)] + ["naïve", "ÉTÉ", "日本", "x1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 10, 14, 30]))) for i in range(n_items)]
    docs = []
    for d in range(n_docs):
        t = text(rng.randrange(0, 80))
        if rng.random() < 0.5:
            t = f"{t}. {rng.choice(items)[1].upper() if rng.random() < .3 else rng.choice(items)[1]}, {text(5)}"
        docs.append((d, t))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    docs, items = made(seed)
    docs += [(None, "the of"), (7, docs[7][1]), (100, None), (101, ""), (102, " \n\t.,;")]
    items += [(None, "w1 w2"), (3, "of of"), (50, None), (51, " ")]
    d, i = frames(spark, docs, items)
    assert rows_of(decontam.contamination(d, i)) == brute(docs, items)


def test_segments_of_a_cut_text_overlap(monkeypatch):
    """Every word is owned once and sees ``reach`` words around it."""
    docs, items = made(5, n_docs=25)
    docs.append((900, " ".join(t for _, t in docs) * 3))
    monkeypatch.setattr(decontam, "SHARD_BYTES", 120)
    pieces = []
    for doc, text in docs:
        start = 0
        for lead, words, owned in decontam._segments(text.encode(), 20):
            assert words[lead:lead + owned] == words_of_bytes(text)[start:start + owned]
            assert words[:lead] == words_of_bytes(text)[start - lead:start]
            after = words_of_bytes(text)[start + owned:start + owned + 20]
            assert words[lead + owned:] == after
            pieces.append(owned)
            start += owned
        assert start == len(words_of_bytes(text))
    assert len(pieces) > len(docs) + 20


def words_of_bytes(text):
    return decontam.words_of_bytes(text.encode())


def test_cut_text_end_to_end(spark):
    """A text of three shards and more: matches in the middle, across the cuts and at the ends."""
    filler = " ".join(f"f{i % 5000}" for i in range(2_200_000))
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    words = filler.split()
    for at in (0, 500_000, 712_345, 1_000_000, len(words) - 11):
        words[at:at + 11] = item.split()
    docs = [(1, " ".join(words)), (2, "beta gamma"), (3, item)]
    d, i = frames(spark, docs, [(9, item), (10, "f7 f8 f9")])
    got = {r.doc_id: r for r in decontam.contamination(d, i).collect()}
    assert got[1].n_words == len(words) and got[1].items == ["10", "9"]
    expected = 5 * 11 + 3 * sum(words[k:k + 3] == ["f7", "f8", "f9"] for k in range(len(words)))
    assert got[1].n_hit == expected
    assert (got[2].n_hit, got[3].n_hit) == (0, 11)


def test_items_in_several_blocks(spark, monkeypatch):
    docs, items = made(8, n_items=30)
    items.append((77, " ".join(t for _, t in items) * 3))            # long item: several pieces
    docs.append((500, items[-1][1]))
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 900)
    monkeypatch.setattr(decontam, "PIECE_WORDS", 16)
    d, i = frames(spark, docs, items)
    pieces, blocks = decontam._blocks(decontam._item_pieces(i, "item_id", "text", 10))
    assert blocks > 2
    assert rows_of(decontam.contamination(d, i)) == brute(docs, items)


def test_phrase_matches_and_proximity(spark):
    docs = [(1, "x a b c d y a b c"), (2, "c q b r a"), (3, "a b. C"), (4, "a b"), (5, "c a p b a q c b")]
    items = [(1, "a b c")]
    d, i = frames(spark, docs, items)
    index = decontam.build_index(d)
    exact = sorted((r.doc_id, r.item, r.start, r.length) for r in decontam.phrase_matches(index, i).collect())
    assert exact == [(1, "1", 1, 3), (1, "1", 6, 3), (3, "1", 0, 3)]
    near = {(r.doc_id, r.start, r.length) for r in decontam.proximity_matches(index, i, within=5).collect()}
    assert (2, 0, 5) in near and (1, 1, 3) in near and (5, 0, 4) in near and (3, 0, 3) in near
    assert not any(doc == 4 for doc, _, _ in near)
    words = {doc: words_of(t) for doc, t in docs}
    for doc, start, length in near:
        assert {"a", "b", "c"} <= set(words[doc][start:start + length])
        assert not {"a", "b", "c"} <= set(words[doc][start + 1:start + length])
        assert not {"a", "b", "c"} <= set(words[doc][start:start + length - 1])
    with pytest.raises(ValueError):
        decontam.proximity_matches(index, i, within=100)


def test_proximity_finds_every_document_brute_force(spark):
    docs, items = made(11, n_docs=80)
    d, i = frames(spark, docs, items)
    got = {(r.doc_id, r.item) for r in decontam.proximity_matches(decontam.build_index(d), i, within=14).collect()}
    expected = set()
    for doc, text in docs:
        w = words_of(text)
        for name, item in items:
            if any(set(x) <= set(w[k:k + 14]) for x in windows_of(item, 10) for k in range(len(w))):
                expected.add((doc, str(name)))
    assert got == expected


def test_empty_tables_and_extra_columns(spark):
    docs, items = made(4, n_docs=5)
    d, i = frames(spark, docs, items)
    assert decontam.contamination(d.limit(0), i).count() == 0
    none = decontam.contamination(d, i.limit(0)).collect()
    assert {(r.n_hit, r.n_items, r.contaminated, r.items_sha256) for r in none} == {(0, 0, False, hashlib.sha256(b"").hexdigest())}
    clash = d.selectExpr("*", "1 AS row", "2 AS item_id", "3 AS items", "4 AS id")
    assert rows_of(decontam.contamination(clash, i.selectExpr("*", "5 AS doc_id"))) == brute(docs, items)


def test_query_equals_brute_force(spark):
    sf_small = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    assert rows_of(op11_benchmark_decontamination(spark, sf_small)) == brute(docs, items)
