"""Spelling variant grouping with PartEnum signatures.

Words are maximal runs of letters (``A-Za-z`` and U+00C0 to U+00FF, A-Z in
lower case) of whole texts.  One in ``SPOIL`` runs of a document, chosen by a
checksum of document and run, loses a letter first; that plants misspellings at
a known rate.  Kept are words of at least ``min_chars`` code points and ``min_count``
occurrences.  Two words are near if one code point inserted, deleted or replaced
turns one into the other.

1. A word is read as the multiset of its letters, a binary vector with one
   position per (letter, how often so far).  One edit changes at most two
   positions, so near words lie within Hamming distance 2.
2. PartEnum (Arasu, Ganti and Kaushik, "Efficient exact set-similarity joins",
   2006) with one first-level part: the positions are dealt into ``PARTS`` parts
   of about equal entropy, and every choice of ``PARTS - 2`` parts is a
   signature.  Two vectors within distance 2 agree in all parts of some choice,
   so no near pair is lost.
3. A signature is joined together with half of the word: an edit lies in one
   half of the shorter word and leaves the other as it is.  So a word has a key
   per signature, half and length that the shorter word may have.  This is exact
   as well, and it splits signatures that many words share (permutations of the
   same syllables) before the join.
4. Keys meet in an equi-join, which verifies every candidate pair by edit
   distance at once and lets only near pairs out.  Keys are 64-bit hashes;
   they only select.
5. A word's form is its near word with the most occurrences, if that has at
   least twice as many.  Roots follow from forms by pointer jumping: counts
   double at every step, so chains are short and have no circle.

The join runs over distinct words, so frequent words are not hot keys.  A
bucket that still is large is an ordinary skewed join key: it is sorted, can
spill and is split by AQE.  Joins are merged, never broadcast: the planner takes
the 12 to 24 keys of a word for one row, and stored words for the size of their
compressed files, so the tables it would broadcast do not fit the driver.

Defined results: a null, empty or letterless text has no words; a null id counts
as an empty string in the checksum; repeated rows count each time; an empty
table gives an empty result.  Only the named columns are read, so further
columns cannot clash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retally.llm.shared import materialise

MIN_CHARS = 5
MIN_COUNT = 3
SPOIL = 97
PARTS = 4
DISTANCE = 2            # positions of the multiset that one edit changes
COUNTED_REPEATS = 8     # repeats of a letter whose frequency is counted to balance the parts
LONG_TEXT = 1_000_000   # code points: beyond that runs are taken one by one
HELD_WORDS = 400_000    # distinct words a task holds before it hands their counts on
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _runs(text: bytes, pattern: re.Pattern) -> Counter:
    lowered = text.lower().decode("utf-8", "replace")        # bytes: A-Z only
    if len(lowered) > LONG_TEXT:
        return Counter(m.group() for m in pattern.finditer(lowered))
    return Counter(pattern.findall(lowered))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): kept words with their occurrences, stored in the shared folder."""
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % min_chars)      # a shorter run can not become a kept word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                start = zlib.crc32(f"{doc}:".encode())
                for word, times in _runs(text.as_py() or b"", pattern).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % SPOIL == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    held[word] += times
                if len(held) > HELD_WORDS:
                    yield out()
        yield out()

    read = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    counted = read.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialise(counted.where((F.col("n") >= min_count) & (F.char_length("word") >= min_chars)), "variant-words")


def _elements(word: str) -> Iterator[tuple[str, int]]:
    """The multiset of letters as positions of a binary vector: (letter, 1), (letter, 2), ..."""
    for letter, times in Counter(word).items():
        for k in range(1, times + 1):
            yield letter, k


def balanced_parts(words: DataFrame, parts: int = PARTS) -> dict[tuple[str, int], int]:
    """A part for each (letter, repeat), of about equal entropy in sum.

    At most (letters) * ``COUNTED_REPEATS`` numbers reach the driver.  Any
    dealing is exact; a balanced one gives the fewest candidates.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                held.update(e for e in _elements(word) if e[1] <= COUNTED_REPEATS)
        yield pa.record_batch([pa.array([a for a, _ in held], pa.string()), pa.array([k for _, k in held], pa.int32()),
                               pa.array(list(held.values()), pa.int64())], names=["letter", "repeat", "n"])

    total = words.count()
    seen = (words.select("word").mapInArrow(run, "letter string, repeat int, n long")
            .groupBy("letter", "repeat").agg(F.sum("n").alias("n")).collect())

    def entropy(n: int) -> float:
        return -sum(p * math.log(p) for p in (n / total, 1 - n / total) if p > 0)

    load, dealt = [0.0] * parts, {}
    for r in sorted(seen, key=lambda r: (-entropy(r["n"]), r["letter"], r["repeat"])):
        part = load.index(min(load))
        dealt[r["letter"], r["repeat"]] = part
        load[part] += entropy(r["n"])
    return dealt


def signature_rows(words: DataFrame, dealt: dict[tuple[str, int], int], parts: int = PARTS, min_chars: int = MIN_CHARS,
                   only_own: bool = False) -> DataFrame:
    """(key, own, word, n): a row per signature, half and shorter length.

    ``own`` says that the key is for pairs whose shorter word is as long as
    this one; ``only_own`` leaves the other keys out.
    """
    choices = list(combinations(range(parts), parts - DISTANCE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[tuple[str, int], tuple[int, int]] = {}

        def code(element: tuple[str, int]) -> tuple[int, int]:
            if element not in codes:
                number = xxhash.xxh3_64_intdigest(f"{element[0]}{element[1]}".encode())
                codes[element] = (dealt.get(element, number % parts), number)
            return codes[element]

        for batch in batches:
            words_, kinds = batch.column(0).to_pylist(), (0,) if only_own else (0, 1)
            sums, halves, fits = [], [], []
            for word in words_:
                total = [0] * parts
                for element in _elements(word):
                    part, number = code(element)
                    total[part] += number
                sums.append([t & 0xFFFFFFFFFFFFFFFF for t in total])
                row = []
                for kind in kinds:
                    shorter = len(word) - kind
                    half = shorter // 2
                    rest = len(word) - (shorter - half)
                    row += [xxhash.xxh3_64_intdigest(f"{shorter}<{word[:half]}".encode()),
                            xxhash.xxh3_64_intdigest(f"{shorter}>{word[rest:]}".encode())]
                halves.append(row)
                fits.append([True, True] if only_own else [True, True] + [len(word) > min_chars] * 2)
            if not words_:
                continue
            sums, halves = np.array(sums, np.uint64), np.array(halves, np.uint64)
            signature = np.zeros((len(words_), len(choices)), np.uint64)
            for k, choice in enumerate(choices):
                for part in choice:
                    signature[:, k] = signature[:, k] * MIX[0] + sums[:, part]
                signature[:, k] = signature[:, k] * MIX[1] + np.uint64(k)
            keys = (signature[:, None, :] * MIX[0]) ^ halves[:, :, None]
            keys = (keys ^ (keys >> np.uint64(31))) * MIX[1]
            keep = np.repeat(np.array(fits, bool)[:, :, None], len(choices), axis=2)
            own = np.zeros(keys.shape, bool)
            own[:, :2] = True
            which = np.repeat(np.arange(len(words_)), keys[0].size)[keep.ravel()]
            yield pa.record_batch([pa.array(keys[keep].view(np.int64)), pa.array(own[keep]),
                                   batch.column(0).take(pa.array(which)), batch.column(1).take(pa.array(which))],
                                  names=["key", "own", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, own boolean, word string, n long")


def near_pairs(words: DataFrame, parts: int = PARTS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(word, n, other, other_n): every near pair once, in either order."""
    dealt = balanced_parts(words, parts)
    shorter = signature_rows(words, dealt, parts, min_chars, only_own=True).drop("own").alias("a")
    either = signature_rows(words, dealt, parts, min_chars).hint("merge").alias("b")
    met = shorter.join(either, (F.col("a.key") == F.col("b.key"))
                       & (~F.col("b.own") | (F.col("a.word") < F.col("b.word")))
                       & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1))
    found = met.select(F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("other"), F.col("b.n").alias("other_n"))
    return materialise(found.distinct(), "variant-pairs")


def roots(forms: DataFrame) -> DataFrame:
    """``forms`` has (word, form); returns (word, root), the last word when forms are followed."""
    at = materialise(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(at.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                  F.col("next").isNotNull().alias("moved")), "variant-roots")
        at = moved.drop("moved")
        if not moved.where("moved").head(1):
            return at


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                      min_count: int = MIN_COUNT, ratio: int = 2) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = word_counts(docs, id_col, text_col, min_chars, min_count)
    pairs = near_pairs(words, PARTS, min_chars)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.max("n").alias("n"), F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    strong = -F.col("best.less") >= ratio * F.col("n")
    formed = materialise(best.select("word", "n_near", F.when(strong, F.col("best.other")).alias("form"),
                                     F.when(strong, -F.col("best.less")).alias("form_n")), "variant-forms")
    rooted = roots(formed.where("form IS NOT NULL"))
    return (words.join(formed.hint("merge"), "word", "left").join(rooted.hint("merge"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
