"""Operator 13: signatures lose no near pair, forms and roots against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from retally.llm import variants
from retally.llm.queries import op13_spelling_variants
from retally.llm.variants import near_pairs, roots, signature_rows, spelling_variants

DOC = "doc_id long, text string, lang string"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(docs):
    n = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def neighbours(words):
    """Near words by trying out every deletion and, for replacements, every blank."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((i, w[:i], w[i + 1:]), []).append(w)
    near = {w: set() for w in words}
    for (i, a, b), members in holes.items():
        for w in members:
            near[w] |= set(members) - {w}
        if a + b in near:
            for w in members:
                near[w].add(a + b)
                near[a + b].add(w)
    return near


def brute(docs):
    n = counted(docs)
    near, form = neighbours(n), {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def made(seed, n=300):
    rng = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "é", "ñ", "ÿ", "À", "×", "st"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5))) for _ in range(300)]
    words += [w[:k] + w[k + 1:] for w in words[:80] for k in (0, len(w) // 2, len(w) - 1)]
    words += [w[:1] + "q" + w[1:] for w in words[:40]] + ["aaaaa", "aaaaaa", "aaaaaaa", "aaaaab", "abcde" * 30, "abcde" * 29 + "abcd"]
    weights = [rng.random() ** 4 for _ in words]
    docs = [(d, rng.choice([" ", "-", "1", "日", "\n"]).join(rng.choices(words, weights, k=rng.randrange(0, 60)))) for d in range(n)]
    return [(d, t.upper() if rng.random() < .1 else t) for d, t in docs] + [(None, "thererer " * 50), (5, None), (6, ""), (7, "1 2"), docs[3], docs[3]]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs = made(seed)
    assert rows_of(spelling_variants(spark.createDataFrame(docs, DOC.replace(", lang string", "")).repartition(4))) == brute(docs)


@pytest.mark.parametrize("parts", [3, 4, 6])
def test_near_words_share_a_key(spark, parts):
    rng = random.Random(parts)
    words = {"".join(rng.choice("abcàÿ") for _ in range(rng.randrange(5, 9))) for _ in range(1500)} | {"x" * k for k in range(5, 30)}
    table = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    got = {frozenset((r.word, r.other)) for r in near_pairs(table, parts).collect()}
    near = neighbours(words)
    assert got == {frozenset((a, b)) for a in near for b in near[a]}
    keys = signature_rows(table, {}, parts).groupBy("word").count().collect()
    choices = parts * (parts - 1) // 2
    assert {r["count"] for r in keys} <= {2 * choices, 4 * choices}


def test_candidates_are_verified_by_code_points(spark):
    table = spark.createDataFrame([("naïve", 3), ("naive", 9), ("naîve", 3), ("naève", 3), ("naveÿ", 4)], "word string, n long")
    got = {frozenset((r.word, r.other)) for r in near_pairs(table).collect()}
    assert got == {frozenset(x) for x in [("naïve", "naive"), ("naïve", "naîve"), ("naive", "naîve"), ("naève", "naive"), ("naève", "naïve"), ("naève", "naîve")]}
    assert all(is_near(*pair) for pair in got)


def test_roots_of_long_chains(spark):
    forms = [(f"w{k}", f"w{k + 1}") for k in range(45)] + [("x", "w7"), ("y", "z")]
    got = {r.word: r.root for r in roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {**{f"w{k}": "w45" for k in range(45)}, "x": "w45", "y": "z"}


def test_long_texts_are_read_run_by_run(spark, monkeypatch):
    docs = made(3, 40) + [(900, "therein herein thereon " * 60_000)]
    assert rows_of(spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)
    pattern = re.compile("[a-zÀ-ÿ]{5,}")
    short = variants._runs("Abcdef ghijk abcdef".encode(), pattern)
    monkeypatch.setattr(variants, "LONG_TEXT", 3)
    assert variants._runs("Abcdef ghijk abcdef".encode(), pattern) == short == {"abcdef": 2, "ghijk": 1}


def test_empty_tables_and_clashing_columns(spark):
    docs = made(4, 60)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(spelling_variants(df.limit(0))) == []
    assert rows_of(spelling_variants(df.where("text IS NULL"))) == []
    clash = df.selectExpr("*", "1 AS word", "2 AS n", "3 AS key", "4 AS id", "5 AS own")
    assert rows_of(spelling_variants(clash)) == brute(docs)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert rows_of(op13_spelling_variants(spark, "/root/testdata/sf0.001")) == brute(docs)


def test_no_join_is_broadcast_however_small_the_planner_takes_its_sides(spark, monkeypatch):
    plans, honest = [], variants.materialise

    def watching(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return honest(df, purpose)

    monkeypatch.setattr(variants, "materialise", watching)
    texts = [(1, "letters letters letters letters letters letters lettars lettars lettars other words words words", "en")]
    found = spelling_variants(spark.createDataFrame(texts, DOC))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert {r.word: (r.form, r.root, r.n) for r in found.collect()} == {
        "letters": (None, "letters", 6), "lettars": ("letters", "letters", 3), "words": (None, "words", 3)}
    joined = [p for p in plans if "Join" in p]
    assert len(joined) >= 3 and all("SortMergeJoin" in p and "Broadcast" not in p for p in joined)
