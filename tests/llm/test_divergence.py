"""Operator 12: exact shares, divergences and marking terms against brute force."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from retally.llm import divergence, terms
from retally.llm.divergence import source_divergence
from retally.llm.queries import op12_source_divergence

DOC = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, min_docs=30, top=50):
    by_lang = defaultdict(list)
    for _, text, lang, source in docs:
        by_lang[lang or ""].append((source or "", Counter(terms_of(text))))
    out = []
    for lang, rows in by_lang.items():
        df = Counter(t for _, c in rows for t in c)
        kept = sorted(t for t in df if df[t] >= min_docs)
        counts = defaultdict(Counter)
        for source, c in rows:
            counts[source].update({t: c[t] for t in kept if t in c})
        whole = sum(counts.values(), Counter())

        def p(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        shares, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s in shares:
            pairs = sorted(((-sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in shares if o != s),
                           key=lambda x: (x[0], x[1].encode()))
            marks = sorted(((q[t] - shares[s][t], t) for t in kept if counts[s][t] and shares[s][t] > q[t]),
                           key=lambda x: (x[0], x[1].encode()))[:top]
            for part, found in (("pair", pairs), ("term", marks)):
                out += [(lang, s, part, item, -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def made(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqr"] + ["Été", "ÉTÉ", "naïve", "日本", "𝔘x"]
    docs = []
    for d in range(n):
        source = rng.choice(["s1"] * 6 + ["s2", "s3", "S3", "é", None, ""])
        part = vocabulary[: 40 + 10 * len(source or "")]
        text = rng.choice([" ", ", ", "1", "\n"]).join(rng.choice(part).upper() if rng.random() < .2 else rng.choice(part)
                                                       for _ in range(rng.randrange(0, 60)))
        docs.append((d, text, rng.choice(["en"] * 4 + ["de", None]), source))
    docs += [(n, None, "en", "s1"), (n + 1, "", "en", "blank"), (n + 2, "12 34", "fr", "s1"), (n + 3, "x y z", "fr", "s2"),
             (n + 4, "solo", "it", "s1"), docs[0], docs[0]]
    return docs


def test_equals_brute_force(spark):
    docs = made(1)
    assert rows_of(source_divergence(spark.createDataFrame(docs, DOC).repartition(5))) == brute(docs)


def test_tiles_and_blocks_change_nothing(spark, monkeypatch):
    docs = made(2, 300) + [(1000 + k, "ak al am an", "en", f"source {k % 23}") for k in range(300)]
    monkeypatch.setattr(divergence, "TILE", 4)
    monkeypatch.setattr(divergence, "BLOCK", 7)
    assert rows_of(source_divergence(spark.createDataFrame(docs, DOC), min_docs=9, top=5)) == brute(docs, 9, 5)


def test_no_kept_terms_gives_pairs_of_zero(spark):
    docs = [(k, f"word{chr(97 + k % 26)}{k}", "en", f"s{k % 3}") for k in range(60)]
    docs = [(k, "".join(random.Random(k).choices("abcdefgh", k=12)), "en", f"s{k % 3}") for k, _, _, _ in docs]
    got = rows_of(source_divergence(spark.createDataFrame(docs, DOC)))
    assert got == brute(docs) and {r[4] for r in got} == {0} and len(got) == 6


def test_empty_table_and_clashing_columns(spark):
    docs = made(3, 150)
    df = spark.createDataFrame(docs, DOC)
    assert rows_of(source_divergence(df.limit(0))) == []
    clash = df.selectExpr("*", "1 AS terms", "2 AS vector", "3 AS file_key", "4 AS n", "5 AS place", "6 AS term")
    assert rows_of(source_divergence(clash)) == brute(docs)


def test_long_text_and_hot_term(spark):
    docs = [(k, "the " * 50, "en", f"s{k % 4}") for k in range(120)] + [(500, "the cat " * 300_000, "en", "s1")]
    assert rows_of(source_divergence(spark.createDataFrame(docs, DOC))) == brute(docs)


def test_fit_sees_each_term_of_a_document_once_and_no_terms_are_stored(spark, monkeypatch):
    docs = made(4, 200)
    given, folders = [], []
    fit, fresh = divergence.CountVectorizer.fit, divergence.fresh_path

    def counting(self, rows):
        given.extend(sorted(r.terms) for r in rows.collect())
        return fit(self, rows)

    def noting(spark, purpose):
        folders.append(fresh(spark, purpose))
        return folders[-1]

    monkeypatch.setattr(divergence.CountVectorizer, "fit", counting)
    monkeypatch.setattr(divergence, "fresh_path", noting)
    assert rows_of(source_divergence(spark.createDataFrame(docs, DOC).repartition(3))) == brute(docs)
    langs = Counter(lang or "" for _, _, lang, _ in docs)
    assert sorted(given) == sorted(t for t in (sorted(set(terms_of(text))) for _, text, lang, _ in docs if langs[lang or ""] >= 30) if t)
    assert folders and not [f for f in folders if any(kind.startswith("array") for _, kind in spark.read.parquet(f).dtypes)]


def test_sums_given_out_early_change_nothing(spark, monkeypatch):
    docs = made(5, 300)
    monkeypatch.setattr(divergence, "HELD", 40)
    monkeypatch.setattr(divergence, "TERM_SLICE", 500)
    assert rows_of(source_divergence(spark.createDataFrame(docs, DOC).repartition(2), min_docs=9, top=7)) == brute(docs, 9, 7)


def test_terms_of_cut_arrays_with_nulls():
    texts = ["skipped", None, "", " 1 ", "B a,a\u00a0b \u00c9t\u00e9 B", "\x1fx\x00y\x7f", "12", "end"]
    lists, some = terms.terms_of(pa.array(texts, pa.string()).cast("binary").slice(1, 6))
    assert some.to_pylist() == [bool(terms_of(t)) for t in texts[1:7]]
    assert lists.to_pylist() == [terms_of(t) for t in texts[1:7] if terms_of(t)]
    assert [sorted(t) for t in terms.distinct_terms(lists).to_pylist()] == [sorted(set(terms_of(t))) for t in texts[1:7] if terms_of(t)]


def test_shares_agree_on_both_sides_of_long_arithmetic(spark):
    near = [divergence.NARROW + k for k in (-2, -1, 0, 1)]
    rows = spark.createDataFrame([(n, 3 * n + 7, 11) for n in near], "n long, total long, v long")
    got = [r[0] for r in rows.select(divergence.share(rows.n, rows.total, rows.v)).collect()]
    assert sorted(got) == sorted(1 + 10**9 * (n + 5) // (3 * n + 7 + 55) for n in near)


def test_counts_beyond_32_bits_stay_exact(spark):
    rows = spark.createDataFrame([(9_000_000_000_000, 40_000_000_000_000, 3_000_000)], "n long, total long, v long")
    got = rows.select(divergence.share(rows.n, rows.total, rows.v)).first()[0]
    assert got == 1 + 10**9 * (9_000_000_000_000 + 5) // (40_000_000_000_000 + 5 * 3_000_000)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert rows_of(op12_source_divergence(spark, "/root/testdata/sf0.001")) == brute(docs)
