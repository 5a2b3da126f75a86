"""Quality classifier: cumulative-link ordinal regression on hashed text.

Ratings have ordered grades 0..K-1.  One weight vector over hashed text
features is shared by all grades and K-1 increasing thresholds cut its score:
P(grade <= k) = sigmoid(theta_k - w.x).  A document gets its expected grade and
the tail probability P(grade >= K-1) that selection uses.

Features are presences, so a document's length does not scale them: every
distinct word, and the document's style (shares of immediate repetitions, of
capital letters, of marks such as !#%, and of bars and brackets) as one hashed
token for every level reached.  Weights are fitted on a bounded sample of
labelled rows (``sample_rows``), for the features whose frequency in some grade
departs from chance (``min_z``), so that the many neutral words of a long text
do not add up.  Every whole text is scored.

Edge cases: a NULL or empty text has style features only.  Labels with a NULL
grade or id are ignored; of several labels of one id the lowest counts.  With
nothing to learn from (no or only one grade), every document is kept, with p_top
1 and expected grade NaN.  Repeated
rows are scored each; an empty table gives an empty result.  Input columns
named like an output column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamlens.llm.common import without
from streamlens.llm.words import Words, byte_slices, giving_back

BUCKETS = 1 << 18
SAMPLE_ROWS = 20_000
MIN_DOCS = 5
MIN_Z = 5.0
SLICE_BYTES = 2 << 20
_OUT = "expected_grade double, p_top double, keep boolean"
_LEVELS = np.array([0.002, 0.005, 0.01, 0.02, 0.035, 0.05, 0.075, 0.1, 0.15, 0.2, 0.3, 0.5, 0.75])
_STYLE = ("repeat", "capital", "mark", "bar")
_MARK = np.array([chr(c) in "!?#$%&*+=@^_~`\\" for c in range(256)])
_BAR = np.array([chr(c) in "|<>{}[]" for c in range(256)])


def style(texts: list[bytes], words: Words) -> np.ndarray:
    """Level of each style measure: one row per text, one column per measure."""
    n = len(texts)
    size = np.maximum([len(t) for t in texts], 1)
    count = np.maximum(words.n_words, 1)
    doc = np.repeat(np.arange(n), words.n_words)
    same = np.zeros(len(doc), bool)
    same[1:] = (words.codes[1:] == words.codes[:-1]) & (doc[1:] == doc[:-1])
    raw = np.frombuffer(b"".join([*texts, b" "]), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64) if n else np.zeros(0, np.int64)

    def share(flag: np.ndarray) -> np.ndarray:
        total = np.add.reduceat(flag, begin, dtype=np.int64) if n else np.zeros(0)
        return np.where([len(t) > 0 for t in texts], total, 0) / size
    capital = share((raw >= 65) & (raw <= 90))
    shares = (np.bincount(doc, same, n) / count, capital, share(_MARK[raw]), share(_BAR[raw]))
    return np.stack([np.searchsorted(_LEVELS, v) for v in shares], 1)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every distinct feature of every text, offsets by text)."""
    words = Words(texts)
    n = len(texts)
    code = np.fromiter((zlib.crc32(w) for w in words.vocabulary.to_pylist()), np.int64, len(words.vocabulary)) % BUCKETS
    doc = np.repeat(np.arange(n), words.n_words)
    levels = style(texts, words)
    keys = [doc * BUCKETS + code[words.codes]]
    for j, name in enumerate(_STYLE):
        for v in range(len(_LEVELS) + 1):
            keys.append(np.flatnonzero(levels[:, j] >= v) * BUCKETS + zlib.crc32(f"\0{name}:{v}".encode()) % BUCKETS)
    key = np.unique(np.concatenate(keys))
    return key % BUCKETS, np.searchsorted(key, np.arange(n + 1) * BUCKETS)


@dataclass
class Model:
    weights: np.ndarray     # one per hash bucket, float32
    thresholds: np.ndarray  # increasing
    grades: np.ndarray      # the grades in use, increasing

    def cumulative(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """P(grade <= k) per text and threshold."""
        total = np.concatenate([[0.0], np.cumsum(self.weights[ids], dtype=np.float64)])
        score = total[offsets[1:]] - total[offsets[:-1]]
        return 1 / (1 + np.exp(np.clip(score[:, None] - self.thresholds[None, :], -60, 60)))


def informative(ids: np.ndarray, offsets: np.ndarray, grade: np.ndarray, min_z: float) -> np.ndarray:
    """Buckets seen in MIN_DOCS documents or more whose share of some grade's
    features is ``min_z`` standard deviations or more from chance."""
    size = np.diff(offsets)
    per = np.repeat(grade, size)
    total = np.bincount(ids, minlength=BUCKETS).astype(float)
    keep = np.zeros(BUCKETS, bool)
    for k in range(int(grade.max()) + 1):
        p = size[grade == k].sum() / max(1, len(ids))
        z = (np.bincount(ids[per == k], minlength=BUCKETS) - total * p) / np.sqrt(np.maximum(total * p * (1 - p), 1e-9))
        keep |= np.abs(z) >= min_z
    return keep & (total >= MIN_DOCS)


def fit(ids: np.ndarray, offsets: np.ndarray, grade: np.ndarray, epochs: int = 150, batch: int = 256,
        rate: float = 0.05, decay: float = 1e-2, min_z: float = MIN_Z, seed: int = 7) -> Model:
    """Maximum likelihood by Adam; other than informative buckets have weight
    zero.  At least two grades must be in use."""
    grades, grade = np.unique(grade, return_inverse=True)
    k = len(grades) - 1
    used = informative(ids, offsets, grade, min_z)
    column = np.cumsum(used) - 1
    w = np.zeros(int(used.sum()))
    share = np.array([(grade <= j).mean() for j in range(k)])
    theta = np.log(share / (1 - share))
    first, gap = theta[0], np.log(np.maximum(np.diff(theta), 1e-3))
    params = [w, np.array([first]), gap]
    m1 = [np.zeros_like(p) for p in params]
    m2 = [np.zeros_like(p) for p in params]
    rng, step, n = np.random.default_rng(seed), 0, len(grade)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    keep = used[ids]
    doc, col = doc[keep], column[ids[keep]]
    start = np.searchsorted(doc, np.arange(n + 1))
    for epoch in range(epochs):
        order = rng.permutation(n)
        for s in range(0, n, batch):
            rows = order[s:s + batch]
            size = start[rows + 1] - start[rows]
            at = np.repeat(start[rows] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            c, r = col[at], np.repeat(np.arange(len(rows)), size)
            score = np.bincount(r, params[0][c], len(rows))
            theta = np.concatenate([params[1], params[1] + np.cumsum(np.exp(params[2]))])
            cut = 1 / (1 + np.exp(np.clip(score[:, None] - theta, -60, 60)))
            edge = np.concatenate([np.zeros((len(rows), 1)), cut, np.ones((len(rows), 1))], 1)
            slope = np.concatenate([np.zeros((len(rows), 1)), cut * (1 - cut), np.zeros((len(rows), 1))], 1)
            i, g = np.arange(len(rows)), grade[rows]
            p = np.maximum(edge[i, g + 1] - edge[i, g], 1e-9)
            # d(-log p)/d theta_j, for the threshold above and the one below the grade
            d_theta = np.zeros((len(rows), k + 2))
            d_theta[i, g + 1] -= slope[i, g + 1] / p
            d_theta[i, g] += slope[i, g] / p
            d_theta = d_theta[:, 1:-1] / len(rows)
            d_score = -d_theta.sum(1)
            per = d_theta.sum(0)
            grads = [np.bincount(c, d_score[r], len(params[0])) + decay / len(rows) * params[0], np.array([per.sum()]),
                     np.array([per[j + 1:].sum() for j in range(k - 1)]) * np.exp(params[2])]
            step += 1
            lr = rate * (1 - epoch / epochs)
            for j, grad in enumerate(grads):
                m1[j] = 0.9 * m1[j] + 0.1 * grad
                m2[j] = 0.999 * m2[j] + 0.001 * grad * grad
                params[j] -= lr * (m1[j] / (1 - 0.9 ** step)) / (np.sqrt(m2[j] / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = params[0]
    return Model(weights, np.concatenate([params[1], params[1] + np.cumsum(np.exp(params[2]))]), grades)


def rating(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Grade of a label: 0 toxic, 1 poor, 2 sound and clean."""
    q, t = F.col(quality), F.col(toxic)
    return F.when(q.isNotNull() & t.isNotNull(),
                  F.when(t > 0, 0).when(q < 1, 1).otherwise(2)).cast("int")


def train(docs: DataFrame, labels: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on at most about ``sample_rows`` labelled documents, picked by a
    hash of the id.  Features are made in the tasks; the driver gets the hashed
    features of the sample only."""
    graded = (labels.select(F.col(f"`{id_col}`").alias("id"), grade.alias("grade"))
              .where("id is not null and grade is not null").groupBy("id").agg(F.min("grade").alias("grade")))
    total = graded.count()
    if not total:
        return None
    share = min(1.0, sample_rows / total)
    picked = graded.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
            .join(F.broadcast(picked), "id")  # bounded by sample_rows
            .dropDuplicates(["id"]).select("id", "grade", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 2, SLICE_BYTES):
                ids, offsets = features([t or b"" for t in b.column(2).cast(pa.binary()).to_pylist()])
                found = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1), found],
                                                 names=["id", "grade", "ids"])

    got = rows.mapInArrow(giving_back(run), "id string, grade int, ids array<int>").toArrow().sort_by("id").combine_chunks()
    if not got.num_rows or len(set(got["grade"].to_pylist())) < 2:
        return None
    ids = got["ids"].combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    return fit(ids.flatten().to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(np.diff(ids.offsets.to_numpy()))]),
               got["grade"].to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model | None, least: float = 0.5, text_col: str = "text",
          keep_text: bool = True) -> DataFrame:
    """``docs`` plus ``expected_grade``, ``p_top`` (probability of the top
    grade) and ``keep`` (p_top >= ``least``)."""
    docs = without(docs, "expected_grade", "p_top", "keep")
    place = docs.columns.index(text_col)
    kept = [i for i, c in enumerate(docs.columns) if keep_text or c != text_col]
    schema = StructType([docs.schema[i] for i in kept] + StructType.fromDDL(_OUT).fields)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for b in byte_slices(batch, place, SLICE_BYTES):
                if m:
                    below = m.cumulative(*features([t or b"" for t in b.column(place).cast(pa.binary()).to_pylist()]))
                    expected, top = m.grades[0] + (1 - below) @ np.diff(m.grades), 1 - below[:, -1]
                else:
                    expected, top = np.full(b.num_rows, np.nan), np.ones(b.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(i) for i in kept] + [pa.array(expected), pa.array(top), pa.array(top >= least)],
                    names=[f.name for f in schema])

    return docs.mapInArrow(giving_back(run), schema)
