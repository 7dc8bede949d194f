"""Terms of whole texts, a slice of texts at a time, by Arrow kernels inside a task.

Apart from the operator, so that Python workers do not load what only the driver needs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Letters of ASCII in lower case, bytes beyond ASCII as they are, all others blank.
_TABLE = bytes(b if 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(texts: pa.Array) -> tuple[pa.ListArray, pa.Array]:
    """The terms, in order, of the binary texts that have any, and which those are."""
    texts = pc.fill_null(texts, b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    plain = data.slice(bounds[0], bounds[-1] - bounds[0]).to_pybytes() if data else b""
    blank = pa.StringArray.from_buffers(len(texts), pa.py_buffer(bounds - bounds[0]), pa.py_buffer(plain.translate(_TABLE)))
    trimmed = pc.ascii_trim_whitespace(blank)
    some = pc.not_equal(trimmed, "")
    return pc.ascii_split_whitespace(trimmed.filter(some)), some


def distinct_terms(lists: pa.ListArray) -> pa.ListArray:
    """Every list with each of its terms once, in any order."""
    coded = lists.flatten().dictionary_encode()
    bits = len(coded.dictionary).bit_length()
    row = np.repeat(np.arange(len(lists), dtype=np.int64) << bits, lists.value_lengths().to_numpy())
    key = np.sort(row | coded.indices.to_numpy())
    key = key[np.diff(key, prepend=-1) != 0]
    bounds = np.searchsorted(key, np.arange(len(lists) + 1, dtype=np.int64) << bits)
    return pa.ListArray.from_arrays(bounds.astype(np.int32), coded.dictionary.take(pa.array(key & ((1 << bits) - 1))))
