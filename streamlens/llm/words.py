"""Words of whole texts as dictionary codes (numpy and Arrow, inside tasks)."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_IS_WORD = np.array([48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)])
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if _IS_WORD[c] else 32 for c in range(256))


class Words:
    """The words of some texts: dictionary codes, counts per text, byte places."""

    def __init__(self, texts: list[bytes]):
        data = b" ".join([*texts, b""]).translate(_FOLD)
        offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
        raw = np.frombuffer(data, np.uint8)
        inside = raw != 32
        edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        begin, end = edge[::2], edge[1::2]
        cut = np.searchsorted(begin, offsets)
        self.n_words = np.diff(cut)
        doc_start = np.repeat(offsets[:-1], self.n_words)
        self.begin, self.end = begin - doc_start, end - doc_start
        flat = pa.Array.from_buffers(
            pa.large_binary(), len(begin),
            [None, pa.py_buffer(np.concatenate([[0], np.cumsum(end - begin)])), pa.py_buffer(raw[inside].tobytes())])
        coded = flat.dictionary_encode()
        self.vocabulary = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A ``mapInArrow`` function that returns its free memory to the system when
    its task ends: Python workers live on and would hold it beside the next
    stage's."""
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # not glibc
            pass
    return wrapped


def byte_slices(batch: pa.RecordBatch, place: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text in column ``place``
    (a longer text is a slice of its own); all rows, in order."""
    if not batch.num_rows:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False))
    cuts = np.flatnonzero(np.diff(size // limit)) + 1
    for s, e in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(s, e - s)
