"""The pipeline's stages, each against a brute-force version on its own input."""

import re

import duckdb
import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as cp
from retally.llm import tokens
from retally.llm.queries import ORACLES
from retally.llm.shared import materialise
from tests.llm.test_exact_dedup import slow as slow_exact
from tests.llm.test_mixing import slow_targets
from tests.llm.test_simhash import slow_fingerprint, slow_groups

SF = "/root/testdata/sf0.001"


def test_every_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality_rules", "exact_dedup", "simhash_near_dedup", "source_mixing", "packing"]
    stages = dict(cp.STAGES)

    def step(name, frame):
        return materialise(stages[name](spark, frame, SF), "test-stage")

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    kept = con.execute(f"SELECT doc_id FROM ({ORACLES['op10_quality_rules']}) q WHERE kept").fetchall()
    one = step("quality_rules", docs)
    assert one.columns == columns and sorted(r.doc_id for r in one.collect()) == sorted(r[0] for r in kept)

    rows = [(r.doc_id, r.text) for r in one.collect()]
    two = step("exact_dedup", one)
    assert two.columns == columns and sorted(r.doc_id for r in two.collect()) == sorted(r[0] for r in slow_exact(rows) if r[3])

    rows = [(r.doc_id, r.text) for r in two.collect()]
    three = step("simhash_near_dedup", two)
    assert sorted(r.doc_id for r in three.collect()) == sorted(i for i, _, c in slow_groups(rows) if i == c)

    four = step("source_mixing", three)
    assert four.columns == columns
    before, after = three.toPandas(), four.toPandas()
    n = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in before.itertuples()}
    targets = slow_targets({s: sum(n[d] for d in g.doc_id) for s, g in before.groupby("source")})
    assert after.groupby("doc_id").size().max() <= 3 and set(after.doc_id) <= set(before.doc_id)
    for source, target in targets.items():
        got = sum(n[d] for d in after[after.source == source].doc_id)
        assert abs(got - target) <= 0.05 * target + 20

    pieces = step("packing", four).collect()
    tokenizer = Tokenizer.from_file(tokens.default_path())
    total = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in after.text)
    assert sum(r.length for r in pieces) == total
    copies = after.groupby("doc_id").size().to_dict()
    text = dict(zip(after.doc_id, after.text))
    of_doc: dict = {}
    for r in pieces:
        of_doc.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids)))
    assert set(of_doc) == set(copies)
    for doc in copies:
        ids = np.array(tokenizer.encode(text[doc], add_special_tokens=False).ids + [1], "<u4")
        found = sorted(of_doc[doc])
        cover = np.zeros(len(ids), int)
        for start, length, data in found:
            assert data == ids[start:start + length].tobytes()
            cover[start:start + length] += 1
        assert (cover == copies[doc]).all()


def test_edge_rows_and_clashing_columns(spark):
    schema = ("doc_id long, text string, lang string, source string, n_chars long, row string, kept string, size string, copies string, "
              "row_hash string, doc string, `a.b` string, copy string")
    extra = ("r", "k", "s", "c", "h", "d", "ab", "y")
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, good, "en", "s", 1, *extra), (1, good, "en", "s", 1, *extra), (2, None, None, None, None, *extra), (3, "", "en", None, 0, *extra),
            (None, good + " more", None, "s", None, *extra), (4, "long " + " ".join(f"x{i}" for i in range(40000)), "en", "s", 5, *extra)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in cp.STAGES:
        alone = stage(spark, spark.createDataFrame(rows, schema), SF)
        assert stage(spark, spark.createDataFrame([], schema), SF).count() == 0
        got = alone.collect()
        if name == "packing":
            assert {r.doc_id for r in got} == {1, 2, 3, 4, None}
        else:
            assert alone.columns == docs.columns
        if name == "quality_rules":
            assert sorted((r.doc_id or 0) for r in got) == [0, 1, 1, 4]
        if name == "exact_dedup":
            assert len(got) == 4                     # the repeated row and one of the two blank texts go
        if name == "source_mixing":
            assert all(r["a.b"] == "ab" and r.copy == "y" for r in got)
            assert sum(1 for r in got if r.doc_id == 1) <= 6


def test_run_and_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    assert cp.run(spark, SF).count() > 0


def test_near_copies_with_null_and_repeated_ids(spark):
    def near(word, n):
        """``n`` different texts of one near group."""
        base = " ".join(f"{word}{i}" for i in range(600))
        texts, first = [base], slow_fingerprint(base)
        for k in range(2000):
            text = f"{base} {word}x{k}"
            if bin(slow_fingerprint(text) ^ first).count("1") <= 1:
                texts.append(text)
            if len(texts) == n:
                return texts
        raise AssertionError("no near texts")

    a, b, c, d, e = near("a", 2), near("b", 2), near("c", 2), near("d", 3), near("e", 2)
    clean = [" ".join(f"{w}{i}" for i in range(300)) for w in ("p", "q", "r")]
    rows = [(7, a[0]), (9, a[1]),                     # 7 leads this group ...
            (3, b[0]), (7, b[1]),                     # ... and loses here
            (5, c[0]), (5, c[1]),                     # near copies that share an id
            (None, d[0]), (None, d[1]), (None, d[2]),       # near copies without ids
            (None, e[0]), (4, e[1]),                  # a null id beside an id
            (None, clean[0]), (None, clean[1]), (8, clean[2]), (8, clean[2])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in cp.simhash_near_dedup(spark, docs, SF).collect()]
    assert len(got) == len(set(got))
    assert {t for _, t in got if t in a + b + e} == {a[0], b[0], e[1]}
    assert len([t for _, t in got if t in c]) == 1 and len([t for _, t in got if t in d]) == 1
    assert {(i, t) for i, t in got if t in clean} == {(None, clean[0]), (None, clean[1]), (8, clean[2])}
    texts = [t for _, t in rows]
    groups = {c for _, _, c in slow_groups([(k, t) for k, t in enumerate(texts)])}
    assert len(got) == len(groups)


def test_rows_that_differ_in_another_column_only_are_rows_of_their_own(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, url string, tags map<string,string>"
    text = " ".join(f"w{i}" for i in range(90))
    rows = [(1, text, "en", "s", 1, "u1", {}), (1, text, "en", "s", 1, "u2", {}), (1, text, "en", "s", 1, "u2", {"a": "b"}),
            (2, " ".join(f"v{i}" for i in range(90)), "en", "s", 1, "u3", {})]
    docs = spark.createDataFrame(rows, schema)
    mixed = cp.source_mixing(spark, docs, SF).collect()
    assert {r.url for r in mixed} == {"u1", "u2", "u3"} and len(mixed) == 4
    near = cp.simhash_near_dedup(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in near) == [1, 2]
