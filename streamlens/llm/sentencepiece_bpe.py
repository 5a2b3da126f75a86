"""SentencePiece BPE encoding by the last piece of every prefix, and decoding.

The merge order of a BPE model fixes, for every prefix of a text, the last
piece of that prefix's encoding.  Going through the pieces that end at a place
(an automaton over the vocabulary reports them), exactly one continues the
prefix before it: the one whose *pair* with that prefix's last piece the merges
leave as it is.  A table of one piece per prefix is filled in one pass, whatever
the length of the text, and the pieces are read off it from the end.

* A pair is tested by merging the two pieces' text alone (best score first, ties
  to the left, as the library does) and the answer is kept for the worker's life.
* Texts are cut where no piece of the vocabulary has the two bytes beside each
  other, so no piece can span the cut, and every distinct unit is encoded once.
* Characters without a piece become their UTF-8 bytes' pieces (or the unknown id).

Whole texts are encoded; a text without any cut is one unit and costs time and
memory in proportion to its length.  At most ``KNOWN_BYTES`` of distinct units
and ``MAX_PAIRS`` answers are kept by a worker, then it starts afresh: neither
changes an id.

Edge cases: a NULL or empty text has no ids and decodes to the empty string.
Repeated rows are encoded once each, an empty table gives an empty result, and
input columns named like the output columns are replaced by them; every other
column, whatever its name, is returned as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.llm.common import without
from streamlens.llm.packing import expand
from streamlens.llm.words import byte_slices, giving_back

SLICE_BYTES = 4 << 20
KNOWN_BYTES = 32 << 20
MAX_PAIRS = 2_000_000
_SPACE = "▁"  # the model's mark of a blank
_NORMAL = 1


class Model:
    """Vocabulary, automaton and pair answers of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if (proto.trainer_spec.model_type != pb.TrainerSpec.BPE or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix
                or proto.trainer_spec.treat_whitespace_as_suffix
                or any(p.type in (pb.ModelProto.SentencePiece.USER_DEFINED, pb.ModelProto.SentencePiece.UNUSED)
                       for p in proto.pieces)):
            raise ValueError("only BPE models with identity normalisation, a dummy prefix and normal pieces are read")
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {p.piece.replace(_SPACE, " "): (i, p.score) for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.id = {t: i for t, (i, _) in pieces.items()}
        self.score = {t: s for t, (_, s) in pieces.items()}
        self.text = {i: t for t, i in self.id.items()}
        if any(c not in self.id for t in self.id for c in t):
            raise ValueError("a piece has a character that is not a piece")
        bytes_of = [self.lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_ids = bytes_of if proto.trainer_spec.byte_fallback else None
        self.unk = self.lib.unk_id()
        self.automaton = ahocorasick.Automaton()
        for t, i in self.id.items():
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        #: byte pairs that may be inside a piece, or inside a character: no cut between them
        self.joined = np.zeros((256, 256), bool)
        self.joined[:, 128:192] = True
        for t in self.id:
            raw = np.frombuffer(t.encode(), np.uint8)
            self.joined[raw[:-1], raw[1:]] = True
        self.pairs: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.flat, self.off = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def merged(self, text: str) -> list[str]:
        """The merges on a short text: best score first, ties to the left."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _pair(self, a: int, b: int) -> bool:
        """Do the merges leave piece a and then piece b?  a < 0: b alone."""
        x, y = self.text.get(a, ""), self.text[b]
        answer = self.merged(x + y) == ([x, y] if x else [y])
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        self.pairs[a, b] = answer
        return answer

    def encode_unit(self, text: str) -> list[int]:
        """Ids of one unit: the table of last pieces, read backwards."""
        n, pairs = len(text), self.pairs
        last, size = [-2] * (n + 1), [1] * (n + 1)  # the last piece of each prefix; -2: a character without a piece
        last[0] = -1
        found = [False] * (n + 1)
        found[0] = True
        for end, (piece, length) in self.automaton.iter(text):
            if found[end + 1]:
                continue
            before = last[end + 1 - length]
            if before < 0:
                before = -1  # nothing merges with a character that has no piece
            ok = pairs.get((before, piece))
            if self._pair(before, piece) if ok is None else ok:
                last[end + 1], size[end + 1], found[end + 1] = piece, length, True
        out, at = [], n
        while at:
            if last[at] >= 0:
                out.append(last[at])
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in reversed(text[at - 1].encode()))
            else:
                out.append(self.unk)
            at -= size[at]
        out.reverse()
        return out

    def _numbers(self, units: pa.Array) -> np.ndarray:
        """Numbers of distinct units in ``flat`` / ``off``."""
        at = pc.index_in(units, value_set=self.known)
        if at.null_count and self.known.nbytes > KNOWN_BYTES:
            self.forget()
            at = pc.index_in(units, value_set=self.known)
        out = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if at.null_count:
            missing = np.flatnonzero(pc.is_null(at).to_numpy(zero_copy_only=False))
            out[missing] = len(self.known) + np.arange(len(missing))
            new = units.take(pa.array(missing))
            ids = [np.array(self.encode_unit(u.decode()), np.int32) for u in new.to_pylist()]
            self.flat = np.concatenate([self.flat, *ids])
            self.off = np.concatenate([self.off, self.off[-1] + np.cumsum([len(i) for i in ids])])
            self.known = pa.concat_arrays([self.known, new])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, document offsets) of an array of texts."""
        raw = [(b" " + t).replace(_SPACE.encode(), b" ") if t else b"" for t in texts.cast(pa.binary()).to_pylist()]
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts = np.cumsum([0, *map(len, raw)])
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(raw) + 1, np.int64)
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.joined[data[:-1], data[1:]]
        cut[starts[:-1][starts[:-1] < len(data)]] = True
        begin = np.flatnonzero(cut)
        units = pa.Array.from_buffers(pa.large_binary(), len(begin), [
            None, pa.py_buffer(np.append(begin, len(data))), pa.py_buffer(data)]).dictionary_encode()
        number = self._numbers(units.dictionary)[units.indices.to_numpy(zero_copy_only=False)]
        size = np.diff(self.off)[number]
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.flat[expand(self.off[number], size)], ends[np.searchsorted(begin, starts)]


_models: dict[str, Model] = {}  # by path, for the life of a worker


def load(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the ids of its texts (array of int, no begin or end ids).

    ``decoded_col`` adds the text that these ids decode to.  A map over the
    scan: no shuffle.  ``model_path`` must exist on every executor.
    """
    new = [ids_col, *([decoded_col] if decoded_col else [])]
    out = T.StructType([f for f in without(docs, *new).schema.fields] + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
                       + ([T.StructField(decoded_col, T.StringType())] if decoded_col else []))
    kept = [F.col(f"`{f.name}`") for f in out.fields[:-len(new)]]
    # the text travels beside the kept columns, by place: its own name may be among the new ones
    rows = docs.select(*kept, F.col(f"`{text_col}`"))
    n_kept = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            for b in byte_slices(batch, n_kept, SLICE_BYTES):
                ids, off = model.encode(b.column(n_kept))
                column = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids, pa.int32()))
                cols = [*b.columns[:n_kept], column]
                if decoded_col:
                    plain = ids.tolist()
                    cols.append(pa.array([model.lib.decode(plain[s:e]) for s, e in zip(off[:-1], off[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=out.fieldNames())

    return rows.mapInArrow(giving_back(run), out)


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` with the text of its id lists, as the library decodes them
    (NULL for a NULL list)."""
    out = T.StructType([*without(rows, text_col).schema.fields, T.StructField(text_col, T.StringType())])
    n_kept = len(out.fields) - 1
    source = rows.select(*[F.col(f"`{f.name}`") for f in out.fields[:-1]], F.col(f"`{ids_col}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = load(model_path).lib
        for b in batches:
            texts = pa.array([None if i is None else lib.decode(i) for i in b.column(n_kept).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:n_kept], texts], names=out.fieldNames())

    return source.mapInArrow(giving_back(run), out)
