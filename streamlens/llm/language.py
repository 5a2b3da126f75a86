"""Language identification with blended-spectrum string kernels.

Kernel: two texts share n-grams of 1 to ``max_n`` characters; k(x, y) is the
number of n-grams present in both over the geometric mean of the numbers
present in each (presence, so length does not dominate).  Presence vectors are
hashed to ``bits`` bits.  Nystroem: a few landmark texts stand for the kernel;
on the landmark features a one-versus-rest kernel ridge regression is solved in
closed form.  Scoring is two matrix products per batch of whole texts.

Texts are lower-cased and every run of non-letters becomes one blank.  The
regression is fitted on a bounded sample (``sample_rows``, spread evenly over
the languages, one row of each at least; a hash picks the rows of a language,
eleven expected, so chance leaves out one in about 10^5); everything is scored.
The number of languages has no bound: the model and the time to score grow with it.

Edge cases: a NULL text or one without letters is "und" with score 0; so is
every text when there is nothing to learn from.  Rows with a NULL language or
id are not learnt from.  Ties go to the first language in name order.  Repeated
rows are scored each; an empty table gives an empty result.  Columns other than
id, text and language are not read, and the language only for the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm.words import giving_back

BITS = 1 << 14
MAX_N = 3
LANDMARKS = 256
SAMPLE_ROWS = 4000
RIDGE = 1e-4
_BATCH = 256
_SPAN = 1 << 22  # characters of a text worked on at once

_letters: np.ndarray | None = None


def _letter_codes() -> np.ndarray:
    """Code point -> itself for letters, 0 for all others."""
    global _letters
    if _letters is None:
        codes = np.arange(0x110000, dtype=np.uint32)
        is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        _letters = np.where(is_letter, codes, 0).astype(np.uint32)
    return _letters


def presence(text: str | None, out: np.ndarray) -> bool:
    """Set out[hash] for every n-gram of the text; False: it has no letter."""
    if not text:
        return False
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = False
    for s in range(0, len(raw), _SPAN):
        # an overlap keeps the n-grams that cross the cut
        codes = _letter_codes()[raw[max(0, s - MAX_N):s + _SPAN]]
        if not codes.any():
            continue
        letter = True
        blank = codes == 0
        codes = codes[~(blank & np.concatenate(([False], blank[:-1])))]
        h = np.zeros(len(codes), np.uint32)
        for n in range(1, MAX_N + 1):
            if len(codes) < n:
                break
            h = (h[:len(codes) - n + 1] + codes[n - 1:]) * np.uint32(0x9E3779B1) + np.uint32(n)
            out[(h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - (len(out) - 1).bit_length())] = 1
    return letter


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # packed presence bits, one row per landmark
    weights: np.ndarray    # landmark kernel values -> one score per language
    bias: np.ndarray


def _kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.maximum(x.sum(1), 1))[:, None] * np.sqrt(np.maximum(landmarks.sum(1), 1))[None, :]
    return (x @ landmarks.T) / norm


def _unpack(packed: np.ndarray) -> np.ndarray:
    return np.unpackbits(packed, axis=1).astype(np.float32)


def fit(packed: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nystroem features and ridge regression on packed presence rows."""
    languages = sorted(set(labels))
    number = {v: i for i, v in enumerate(languages)}
    y = np.array([number[v] for v in labels])
    order, size = np.argsort(y, kind="stable"), np.bincount(y)
    place = np.empty(len(y), np.int64)  # of a row among those of its language
    place[order] = np.arange(len(y)) - np.repeat(np.cumsum(size) - size, size)
    marks = packed[np.sort(np.argsort(place, kind="stable")[:landmarks])]  # evenly over the languages
    lm = _unpack(marks)
    k = np.concatenate([_kernel(_unpack(packed[s:s + _BATCH]), lm) for s in range(0, len(y), _BATCH)]).astype(np.float64)
    value, vector = np.linalg.eigh(_kernel(lm, lm).astype(np.float64))
    good = value > 1e-6 * value[-1]
    root = vector[:, good] / np.sqrt(value[good])
    phi = k @ root
    mean = phi.mean(0)
    # targets are 1 for the language and -1 else: sums over its rows stand for their products
    target = 2 * size / len(y) - 1
    product = 2 * np.add.reduceat((phi - mean)[order], np.cumsum(size) - size).T
    gram = (phi - mean).T @ (phi - mean) + ridge * len(y) * np.eye(phi.shape[1])
    beta = np.linalg.solve(gram, product)
    return Model(languages, marks, (root @ beta).astype(np.float32), target - mean @ beta)


def is_held_out(doc_id: str | Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2 (NULL ids: not held out)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS, landmarks: int = LANDMARKS, bits: int = BITS) -> Model | None:
    """Fit on a sample of the rows that are not held out."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{lang_col}`").alias("lang")).where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & ~is_held_out("id"))
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return None
    quota = max(1, sample_rows // len(counts))
    ratio = docs.sparkSession.createDataFrame(
        [(r[0], min(1.0, 1.3 * quota / r[1] + 10 / r[1])) for r in counts], "lang string, ratio double")
    h = F.xxhash64("id", "text")
    picked = (rows.withColumn("h", h).join(F.broadcast(ratio), "lang")  # a row per language
              .where(F.pmod("h", F.lit(1 << 30)) < F.col("ratio") * (1 << 30))
              .dropDuplicates(["lang", "h"]).select("lang", "h", "text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, bit = [], []
            for i, t in enumerate(b.column(2).to_pylist()):
                x = np.zeros(bits, np.uint8)
                if presence(t, x):
                    rows.append(i)
                    bit.append(np.packbits(x).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int32())), b.column(1).take(pa.array(rows, pa.int32())),
                 pa.array(bit, pa.binary())], names=["lang", "h", "bits"])

    got: dict[str, list] = {}
    for r in sorted(picked.mapInArrow(giving_back(features), "lang string, h long, bits binary").collect(), key=lambda r: r.h):
        got.setdefault(r.lang, []).append(bytes(r.bits))
    labels, packed = [], []
    for lang in sorted(got):
        part = got[lang][:quota]
        labels += [lang] * len(part)
        packed += part
    if not packed:
        return None
    return fit(np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1), labels, landmarks)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lm = _unpack(m.landmarks) if m else None
        for batch in batches:
            for s in range(0, batch.num_rows, _BATCH):
                b = batch.slice(s, _BATCH)
                lang, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
                if m:
                    x = np.zeros((b.num_rows, lm.shape[1]), np.float32)
                    known = [i for i, t in enumerate(b.column(1).to_pylist()) if presence(t, x[i])]
                    f = _kernel(x[known], lm) @ m.weights + m.bias
                    for i, k, v in zip(known, f.argmax(1), f.max(1, initial=-1)):
                        lang[i], score[i] = m.languages[k], min(1.0, max(0.0, (v + 1) / 2))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(lang), pa.array(score)], names=["id", "lang_pred", "score"])

    return narrow.mapInArrow(giving_back(run), f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col)
