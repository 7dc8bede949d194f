"""Token ids of whole texts, batch by batch inside a task.

Texts are cut at ASCII white space, which no token crosses in a tokenizer that
drops white space and marks word ends.  Each distinct word of a slice of texts
is encoded once, with a bounded memory of words seen before, and the ids are
gathered back in text order with array operations.  The result equals
``Tokenizer.encode(text, add_special_tokens=False).ids``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 * 1024 * 1024      # text gathered at once
REMEMBER = 300_000                # word stems kept between slices, per Python worker
PROBE = ("hello", "straße", "élève", "ñandú", "слово", "überzeugung", "a")
PLAIN_END = ".,;:!?#$%&*|"       # a run of these after letters is a token run of its own


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.memory: dict[bytes, bytes] = {}
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the short way below holds for byte-level models with word ends; others encode word by word
        self.short = self._encode_stems([w.encode() for w in PROBE]) == self._encode_words([w.encode() for w in PROBE])

    def _encode_stems(self, stems: list[bytes]) -> dict[bytes, bytes]:
        """Runs of letters in ASCII lower case, given to the model itself: nothing in them is left to split."""
        tokenize, normal, level = self.tokenizer.model.tokenize, self.tokenizer.normalizer, self.bytes
        got = {}
        for stem in stems:
            text = stem.decode("utf-8", "replace")
            if not stem.isascii():
                text = normal.normalize_str(text)
                if not text.isalpha():                 # lower case that adds a mark
                    got.update(self._encode_words([stem]))
                    continue
                text = level.pre_tokenize_str(text)[0][0]
            ids = [t.id for t in tokenize(text)]
            got[stem] = pack(f"<{len(ids)}I", *ids)
        return got

    def _encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        batch = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return {w: np.array(got.ids, "<u4").tobytes() for w, got in zip(words, batch)}

    def pieces(self, keys: pa.Array, stems: np.ndarray) -> list[bytes]:
        """Little-endian 32-bit ids of distinct keys; ``stems`` says which are runs of letters."""
        memory, keys = self.memory, keys.to_pylist()
        found = list(map(memory.get, keys))
        new = [k for k, ids in enumerate(found) if ids is None]
        fresh = {**self._encode_stems([keys[k] for k in new if stems[k]]), **self._encode_words([keys[k] for k in new if not stems[k]])}
        for k in new:
            found[k] = fresh[keys[k]]
        if len(memory) < REMEMBER:
            memory.update(fresh)
        return found

    def words(self, words: pa.Array) -> pa.LargeListArray:
        """Ids of distinct words.

        A word of letters is its letters in ASCII lower case and the marks after
        them, two keys; any other word is a key of its own.
        """
        stem = pc.utf8_rtrim(words, characters=PLAIN_END)
        plain = pc.and_(pc.utf8_is_alpha(stem), pa.scalar(self.short))
        keys = pc.if_else(plain, pc.ascii_lower(stem), words).cast(pa.binary()).dictionary_encode()
        plain, lengths = plain.to_numpy(zero_copy_only=False), pc.binary_length(stem).to_numpy()
        marked = np.flatnonzero(plain & (lengths < pc.binary_length(words).to_numpy()))      # most words carry no marks
        tails = zip(words.take(pa.array(marked)).cast(pa.binary()).to_pylist(), lengths[marked].tolist())
        marks = pa.array([b"", *(w[n:] for w, n in tails)], pa.binary()).dictionary_encode()
        mark = np.zeros(len(words), np.int64)
        mark[marked] = marks.indices.to_numpy()[1:]
        index = keys.indices.to_numpy()
        stems = np.zeros(len(keys.dictionary), bool)
        stems[index] = plain
        found = self.pieces(keys.dictionary, stems) + self.pieces(marks.dictionary, np.zeros(len(marks.dictionary), bool))
        pool = _lists(found)
        both = np.stack([index, mark + len(stems)], axis=1).ravel()
        sizes = np.diff(pool.offsets.to_numpy())[both].reshape(-1, 2).sum(axis=1)
        return pa.LargeListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))), pool.take(pa.array(both)).flatten())

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order (uint32) and the bounds of each text in them (null: no ids)."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten()
        bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
        if not len(words):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        coded = words.dictionary_encode()
        by_word = self.words(coded.dictionary)
        ids = by_word.take(coded.indices).flatten().to_numpy()
        sizes = np.diff(by_word.offsets.to_numpy())[coded.indices.to_numpy()]
        return ids, np.concatenate(([0], np.cumsum(sizes)))[bounds]


def _lists(pieces: list[bytes]) -> pa.LargeListArray:
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
    return pa.LargeListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))), np.frombuffer(b"".join(pieces), "<u4"))


@lru_cache(maxsize=2)
def encoder_of(path: str) -> WordEncoder:
    """One encoder per Python worker: its memory serves all tasks the worker runs."""
    return WordEncoder(path)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows with about ``limit`` bytes of text."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, start = np.cumsum(size), 0
    while start < len(size):
        base = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, base + limit, "right")))
        yield start, end
        start = end


def encoded(texts: pa.Array, encoder: WordEncoder, end_id: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids with the end id) of each text, a slice of rows in memory at a time."""
    for a, b in slices(texts):
        ids, bounds = encoder.texts(texts.slice(a, b - a))
        for k in range(b - a):
            yield a + k, np.append(ids[bounds[k]:bounds[k + 1]], np.uint32(end_id))
        del ids
        pa.default_memory_pool().release_unused()      # what a slice took is given back before the next one
