"""Packing and token files: exact round trips."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from retally.llm import binary, tokens
from retally.llm.binary import FileBuilder, TokenFile, ids_before, read_tokens, token_positions, write_tokens
from retally.llm.packing import _grains, _tail, divide, pack, pack_documents, sequence_rows
from retally.llm.shared import fresh_path

SCHEMA = "doc_id long, text string, start string, ids string, sequence_id string, file string"
TEXTS = [None, "", " \t\n", "hello", "Hello, World!", "it's I'LL 'S we've", "H̱ ẖ é É Å İstanbul ΣΑΣ ς straße ẞ", "１２ 12a3 a1.",
         "a<|endoftext|>b <|startoftext|>", "...hello!!### x$$$", " nbsp em x\u0085y \x1c\x1d", "日本語 テスト。 кошка", "​zero á. 🙂🙂 ok ﬁ Ǆ",
         "x" * 5000, "word " * 30000, "Überzeugung élève ñandú"]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokens.default_path())
    return lambda text, end: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def frame(spark):
    rows = [(i, t, "x", "y", "z", "f") for i, t in enumerate(TEXTS)]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr(
        "doc_id + 1000 AS doc_id", "text", "'x' AS start", "'y' AS ids", "'z' AS sequence_id", "'f' AS file")
    return spark.createDataFrame(rows, SCHEMA).unionByName(docs).repartition(4)


def test_pieces_hold_every_id_once(spark, plain):
    docs = frame(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces = pack_documents(docs).cache()
    by_doc, by_sequence = {}, {}
    for r in pieces.collect():
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        found = sorted(by_doc[doc], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in found) == plain(text, 1).tobytes()
        at = 0
        for r in found:
            assert r.start == at and 4 * r.length == len(r.ids) and r.doc_tokens == len(plain(text, 1))
            at += r.length
    total = padding = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding < 0.05 * total
    rows = {r.sequence_id: r for r in sequence_rows(pieces).collect()}
    for key, parts in by_sequence.items():
        assert bytes(rows[key].ids) == b"".join(bytes(r.ids) for r in sorted(parts, key=lambda r: r.offset))


def test_differencing_balances_and_respects_capacity():
    rng = random.Random(10)
    for _ in range(20):
        sizes = [rng.randrange(1, 2048) for _ in range(rng.randrange(1, 300))]
        found = pack(sizes)
        assert sorted(i for w in found for i in w) == list(range(len(sizes)))
        assert max(sum(sizes[i] for i in w) for w in found) <= 2048
    even = divide([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in even) in ([14, 16], [15, 15])
    fine = [rng.randrange(1, 60) for _ in range(2000)]
    sums = [sum(fine[i] for i in w) for w in divide(fine, 20)]
    assert max(sums) - min(sums) <= 2


def test_tail_and_grains_cut_without_loss():
    pieces = [(0, 0, 300), (1, 0, 77), (2, 5, 1000)]
    for cut in (_tail(pieces), [_grains(pieces, 2048)]):
        ids = sorted((r, k) for s in cut for r, a, n in s for k in range(a, a + n))
        assert ids == sorted((r, k) for r, a, n in pieces for k in range(a, a + n))
    for sequence in _tail(pieces):
        n = sum(p[2] for p in sequence)
        assert n & (n - 1) == 0


def test_empty_table_and_repeated_rows(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    row = (None, "hello", "", "", "", "")
    assert [r.doc_id for r in pack_documents(spark.createDataFrame([row, row], SCHEMA)).collect()] == [None, None]


def test_token_files_equal_plain_encoding(spark, plain):
    docs = frame(spark)
    want, at = [], 0
    for doc, text in sorted((r.doc_id, r.text) for r in docs.collect()):
        ids = plain(text, 2)
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in token_positions(docs).collect()) == want


def test_reading_some_documents_opens_only_their_frames(spark, plain, monkeypatch):
    builder = FileBuilder(2)
    monkeypatch.setattr(binary, "FRAME_IDS", 100)
    rows, rng = [], np.random.default_rng(1)
    docs = {k: rng.integers(0, 50000, n).astype("<u4") for k, n in enumerate([5, 0, 250, 1, 99, 100, 101, 640, 3])}
    for k, ids in docs.items():
        rows += builder.add(k, ids)
    rows += builder.finish()
    data = b"\n".join(rows) + b"\n"
    file = TokenFile(io.BytesIO(data))
    assert all(np.array_equal(file.ids(k), ids) for k, ids in docs.items())
    one = TokenFile(io.BytesIO(data))
    assert np.array_equal(one.ids(8), docs[8]) and one.opened == 1
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole == b"".join(ids.astype("<u2").tobytes() for ids in docs.values())
    broken = bytearray(data)
    broken[20] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        TokenFile(io.BytesIO(bytes(broken))).ids(0)


def test_selected_documents_and_empty_table(spark, plain):
    docs = frame(spark)
    path = fresh_path(spark, "test-tokens")
    write_tokens(docs, path, parts=3)
    got = {r.doc_id: bytes(r.ids) for r in read_tokens(spark, path, [3, 14, 1005]).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got == {d: plain(texts[d], 2).tobytes() for d in (3, 14, 1005)}
    assert token_positions(spark.createDataFrame([], SCHEMA)).count() == 0
    row = (None, "hello", "", "", "", "")
    assert sorted(r.start for r in token_positions(spark.createDataFrame([row, row], SCHEMA)).collect()) == [0, 2]


def test_files_are_ordered_by_part_number_not_by_name(spark):
    parts = [0, 9, 10001, 99999, 100000, 100001, 1000000]
    rows = [(f"part-{p:05d}-5e0d3f6c-0000-4000-8000-000000000000-c000.txt", 10 ** k) for k, p in enumerate(parts)]
    got = {r.file: r.before for r in ids_before(spark.createDataFrame(rows[::-1], "file string, n long")).collect()}
    assert [got[name] for name, _ in rows] == [sum(n for _, n in rows[:k]) for k in range(len(rows))]


def test_only_words_with_marks_are_cut_one_by_one(monkeypatch):
    """Marks of many words: ids equal the tokenizer's, and words without marks take no step of their own."""
    encoder = tokens.encoder_of(tokens.default_path())
    stems = [a + b for a in ("hello", "Straße", "ñandú", "word") for b in ("", "s", "er", "ing", "abc")]
    words = [*stems, "hello.", "words,,", "Straßer!?", "...", "a1.", "<s>", "ñandú;x"]
    lists, honest = [], pa.array

    def spy(values, *more, **named):
        if isinstance(values, list) and values and isinstance(values[0], bytes):
            lists.append(len(values))
        return honest(values, *more, **named)

    monkeypatch.setattr(pa, "array", spy)
    got = encoder.words(honest(words)).to_pylist()
    assert got == [encoder.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert lists == [1 + 3]
