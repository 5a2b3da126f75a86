"""Packing by power-of-two decomposition.

A document's token ids (plus an end id) are cut into pieces whose lengths are
powers of two: as many pieces of ``max_len`` as fit, then the binary digits of
the rest from large to small.  Every piece is a sequence of its own, so no
sequence crosses documents and none needs padding; sequences of one ``bucket``
(log2 of the length) batch together.

Edge cases: a NULL or empty text is just the end id (one piece of length 1).
Repeated rows are packed once each.  An empty table gives an empty result.
Columns other than the id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.llm.words import byte_slices, giving_back

_CHUNK = 5_000  # distinct units per tokenizer call: bounds its result objects
_PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
MAX_KNOWN = 500_000  # distinct units a worker keeps
SLICE_BYTES = 4 << 20
_BLANKS = b" \t\n\x0b\x0c\r"
_KIND = np.full(256, 4, np.uint8)  # 0 white space, 1 ASCII letter or digit, 2 punctuation, 4 any other
_KIND[list(_BLANKS)] = 0
_KIND[[c for c in range(128) if chr(c).isalnum()]] = 1
_KIND[list(b".,;:!?")] = 2


def _load(path: str):
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks in parallel
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class Units:
    """Token ids of the units met so far, kept between batches and tasks.

    At most ``MAX_KNOWN`` units are kept (then it starts afresh), so memory is
    bounded whatever the corpus; the ids never depend on what is kept.
    """

    def __init__(self, tok):
        self.tok = tok
        self.is_word_end = np.zeros(tok.get_vocab_size(), bool)
        self.is_word_end[[i for t, i in tok.get_vocab().items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_utf8())
        self.flat, self.off = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _any(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tok.encode_batch_fast(units, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum())), counts

    def _plain(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units of letters only are one pre-token each, so many go in one call
        and the word-end tokens tell them apart."""
        ids = np.array(self.tok.encode(" ".join(units), add_special_tokens=False).ids, np.uint32)
        ends = np.flatnonzero(self.is_word_end[ids])
        if len(ends) != len(units):
            return self._any(units)
        return ids, np.diff(ends, prepend=-1)

    def ids(self, units: pa.Array) -> np.ndarray:
        """Numbers of distinct units in ``flat`` / ``off``."""
        at = pc.index_in(units, value_set=self.known)
        if at.null_count and len(self.known) + at.null_count > MAX_KNOWN:
            self.forget()
            at = pc.index_in(units, value_set=self.known)
        out = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if at.null_count:
            missing = np.flatnonzero(pc.is_null(at).to_numpy(zero_copy_only=False))
            plain = pc.match_substring_regex(units.take(pa.array(missing)), _PLAIN).to_numpy(zero_copy_only=False)
            missing = np.concatenate([missing[plain], missing[~plain]])
            new, n_plain = units.take(pa.array(missing)), int(plain.sum())
            out[missing] = len(self.known) + np.arange(len(missing))
            flat, counts = [self.flat], [np.diff(self.off)]
            for lo, hi, encode in ((0, n_plain, self._plain), (n_plain, len(new), self._any)):
                for s in range(lo, hi, _CHUNK):
                    ids, n = encode(new.slice(s, min(_CHUNK, hi - s)).to_pylist())
                    flat.append(ids)
                    counts.append(n)
            self.flat, self.off = np.concatenate(flat), np.concatenate([[0], np.cumsum(np.concatenate(counts))])
            self.known = pa.concat_arrays([self.known, new])
        return out


_units_of: dict[str, Units] = {}  # by tokenizer, for the life of a worker process: about 25 MB


def _known_units(path: str) -> Units:
    if path not in _units_of:
        _units_of[path] = Units(_load(path))
    return _units_of[path]


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges starts[i] .. starts[i]+lengths[i]-1."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units that are tokenized alone, and how many each text has.

    A unit ends at ASCII white space and where an ASCII letter or digit meets
    one of .,;:!? - the pre-tokenizer cuts there too.  Case is folded at once
    (the tokenizer folds it later), unless a special token's marker or a
    combining accent is near, for which the order of the steps matters.
    """
    raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    data = b" ".join([*raw, b""])
    if b"<|" not in data and b"\xcc" not in data and b"\xcd" not in data:
        data = data.lower()
    offsets = np.cumsum([0, *[len(t) + 1 for t in raw]])
    kind = _KIND[np.frombuffer(data, np.uint8)]
    before = np.concatenate((kind[:1] * 0, kind[:-1]))
    inside = kind != 0
    begin = np.flatnonzero(inside & ((before == 0) | (before + kind == 3)))
    cut = np.searchsorted(begin, offsets)
    size = np.add.reduceat(inside, begin, dtype=np.int64) if len(begin) else begin
    flat = pa.Array.from_buffers(
        pa.large_utf8(), len(begin),
        [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)])), pa.py_buffer(data.translate(None, _BLANKS))])
    return flat, np.diff(cut)


def encode_texts(known: Units, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, document offsets), each document closed by ``end_id``.

    The tokenizer drops white space and never merges across its pre-tokens, so
    a text's ids are those of its units in order.  Each distinct unit is
    tokenized once.
    """
    units, n_units = _units(texts)
    coded = units.dictionary_encode()
    code = known.ids(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
    per_unit = np.diff(known.off)[code]
    ends = np.concatenate([[0], np.cumsum(per_unit)])[np.cumsum(n_units)]
    doc_off = np.concatenate([[0], ends + np.arange(1, len(texts) + 1)])
    ids = np.empty(doc_off[-1], np.uint32)
    is_end = np.zeros(len(ids), bool)
    is_end[doc_off[1:] - 1] = True
    ids[is_end] = end_id
    ids[~is_end] = known.flat[expand(known.off[code], per_unit)]
    return ids, doc_off


def decompose(lengths: np.ndarray, max_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document index, start, length) of the pieces, in document order."""
    doc = np.arange(len(lengths))
    whole = lengths // max_len
    rest = lengths % max_len
    d, s, ln = [np.repeat(doc, whole)], [expand(np.zeros_like(whole), whole) * max_len], \
        [np.full(int(whole.sum()), max_len, np.int64)]
    at = whole * max_len
    for bit in range(max_len.bit_length() - 2, -1, -1):
        has = (rest >> bit) & 1 == 1
        d.append(doc[has])
        s.append(at[has])
        ln.append(np.full(int(has.sum()), 1 << bit, np.int64))
        at = at + (has.astype(np.int64) << bit)
    d, s, ln = np.concatenate(d), np.concatenate(s), np.concatenate(ln)
    o = np.lexsort((s, d))
    return d[o], s[o], ln[o]


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the id column, ``start``, ``length``, ``token_ids``
    (little-endian unsigned 32-bit ids), ``doc_tokens``, ``bucket``,
    ``sequence_id`` and ``offset``.  ``max_len`` must be a power of two.

    A map over the scan: no shuffle.  Sequence ids are a function of the input
    split and the row's place in it, so a retried task repeats them.
    """
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 1, SLICE_BYTES):
                ids, off = encode_texts(_known_units(tokenizer_path), b.column(1), end_id)
                lengths = np.diff(off)
                d, s, ln = decompose(lengths, max_len)
                # pieces cover the ids in order, so their byte offsets are the running lengths
                cuts = np.concatenate([[0], np.cumsum(ln)]) * 4
                data = pa.Array.from_buffers(pa.large_binary(), len(ln), [None, pa.py_buffer(cuts), pa.py_buffer(
                    ids.astype("<u4", copy=False))])
                out = pa.table({"id": b.column(0).take(pa.array(d)), "start": s, "length": ln, "token_ids": data,
                                "doc_tokens": lengths[d], "bucket": np.log2(ln).astype(np.int32)})
                for part in out.to_batches(max_chunksize=50_000):
                    yield pa.RecordBatch.from_arrays(
                        [c.cast(pa.binary()) if n == "token_ids" else c for n, c in zip(out.column_names, part.columns)],
                        names=out.column_names)

    pieces = narrow.mapInArrow(
        giving_back(run), f"id {id_type}, start long, length long, token_ids binary, doc_tokens long, bucket int")
    return (pieces.withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long"))
            .withColumnRenamed("id", id_col))
