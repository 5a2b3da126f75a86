"""SimHash near-duplicates with bit-sliced comparison.

A document's fingerprint takes, per bit, the majority over the XXH64 hashes of
its word shingles.  Fingerprints within ``max_distance`` bits are linked and
components are formed over the links.

Candidates: the 64 bits are cut into blocks; two fingerprints within d bits
agree in at least blocks-d whole blocks, so one table per combination of
blocks-d blocks, keyed by their bits, misses no pair.  Distinct fingerprints
only are compared, so exact copies cost one row.  A key with more than
``bucket_rows`` fingerprints is dealt out over pairs of chunks, so no task
holds an unbounded group and no pair is lost.

Comparison: a task holds its sorted buckets as 64 bit planes, 64 fingerprints
to a word.  For each distance s in the sorted order, a plane XOR itself shifted
by s rows gives 64 pair comparisons at once; the differing bits are added up in
carry-save bitwise counters, and blocks of 64 pairs whose counters have all
passed the radius (or whose rows are of different buckets) are abandoned.

Edge cases: NULL and empty texts have no words and fingerprint zero, linked
like any other.  Rows that repeat a doc_id are all returned, each with its
text's fingerprint; a NULL doc_id never names a component unless it has no
other member.  An empty table gives an empty result.  Columns other than the
id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm.common import materialize, own_exchange, set_aside
from streamlens.llm.components import connected_components, local_roots
from streamlens.llm.words import byte_slices, giving_back

BLOCKS = 6          # 15 tables with keys of 20-22 bits; 7 gives 35 of 27-28 bits, 8 gives 70 of 32 bits
BUCKET_ROWS = 2048
SLICE_BYTES = 1 << 20
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_VOTE_ROWS = 1 << 16
_PAIR_WORDS = 1 << 16


def text_hashes(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """Unsigned XXH64 of every shingle of the lower-cased words."""
    from xxhash import xxh64_intdigest as h
    words = text.lower().split()  # bytes: folds A-Z and splits at ASCII white space only
    if len(words) <= shingle:
        return np.array([h(b" ".join(words), seed)] if words else [], np.uint64)
    joined = b" ".join(words)
    del words
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    begin = np.append(0, blanks + 1)
    end = np.append(blanks, len(joined))[shingle - 1:]
    out = np.empty(len(end), np.uint64)
    for k in range(0, len(end), _VOTE_ROWS):  # long texts: bounds the numbers held as Python objects
        part = slice(k, min(k + _VOTE_ROWS, len(end)))
        out[part] = [h(joined[s:e], seed) for s, e in zip(begin[part].tolist(), end[part].tolist())]
    return out


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each document: bits set in over half of its hashes."""
    votes = np.zeros((len(counts), 64), np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    for s in range(0, len(hashes), _VOTE_ROWS):
        part, d = hashes[s:s + _VOTE_ROWS], doc[s:s + _VOTE_ROWS]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at = np.flatnonzero(np.diff(d, prepend=-1))
        votes[d[at]] += np.add.reduceat(bits, at, axis=0, dtype=np.uint32)
    return np.packbits(2 * votes > counts[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp): one row per document, fp as a signed long."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                         F.xxhash64(f"`{text_col}`").alias("text_hash"))
    id_type = narrow.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 1, SLICE_BYTES):
                hashes = [text_hashes(t or b"", shingle, seed) for t in b.column(1).cast(pa.binary()).to_pylist()]
                counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
                fp = majority(np.concatenate(hashes), counts).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fp)],
                                                 names=["id", "text_hash", "fp"])

    return narrow.mapInArrow(giving_back(run), f"id {id_type}, text_hash long, fp long")


def _planes(fp: np.ndarray) -> np.ndarray:
    """64 bit planes over the rows; the shifted reads may run past the end."""
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    out = np.zeros((64, len(fp) // 64 + 1), np.uint64)
    packed = np.packbits(bits, axis=1, bitorder="little")
    out.view(np.uint8)[:, :packed.shape[1]] = packed
    return np.concatenate([out, np.zeros((64, out.shape[1] + 1), np.uint64)], 1)


def _rows_to_words(flag: np.ndarray) -> np.ndarray:
    return np.packbits(flag, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def near_pairs(fp: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of equal bucket (rows sorted by it) within ``radius`` bits."""
    n = len(fp)
    last = np.flatnonzero(np.diff(bucket, append=bucket[-1] + 1)) if n else np.zeros(0, int)
    later = np.repeat(last, np.diff(last, prepend=-1)) - np.arange(n)  # rows after this one in its bucket
    planes = _planes(fp)
    padded = np.zeros(-(-n // 64) * 64, np.int64)
    padded[:n] = later
    reach = padded.reshape(-1, 64)
    most = reach.max(1)
    bits = radius.bit_length()
    start = (1 << bits) - 1 - radius  # a counter overflows exactly when it passes the radius
    left, right = [], []
    ends = np.cumsum(most)
    total = int(ends[-1]) if len(ends) else 0
    for lo in range(0, total, _PAIR_WORDS):  # (word, shift) pairs, in blocks of bounded size
        k = np.arange(lo, min(total, lo + _PAIR_WORDS))
        word = np.searchsorted(ends, k, side="right")
        shift = k - (ends[word] - most[word]) + 1
        over = ~_rows_to_words(reach[word] >= shift[:, None])
        counter = [np.full(len(k), _FULL if start >> i & 1 else 0, np.uint64) for i in range(bits)]
        for p in range(64):
            if p % 8 == 0 and p >= 16 or not p:
                live = np.flatnonzero(over != _FULL)
                if len(live) < len(over):
                    word, shift, over = word[live], shift[live], over[live]
                    counter = [c[live] for c in counter]
                at, r = word + (shift >> 6), (shift & 63).astype(np.uint64)
                r_up = np.uint64(63) - r
            x = planes[p][at] >> r
            x |= (planes[p][at + 1] << np.uint64(1)) << r_up
            x ^= planes[p][word]
            for i in range(bits):  # carry-save: x is the carry into the next counter bit
                carry = counter[i] & x
                counter[i] ^= x
                x = carry
            over |= x
        near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        e, bit = np.nonzero(near)
        i = word[e] * 64 + bit
        left.append(i)
        right.append(i + shift[e])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def block_keys(fp: str, blocks: int, max_distance: int) -> Column:
    """The key of a fingerprint in every table: table number and the bits of
    its combination of blocks, as an array of longs."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for t, combo in enumerate(combinations(range(blocks), blocks - max_distance)):
        mask = 0
        for i in combo:
            mask |= ((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i]
        keys.append(F.xxhash64(F.lit(t), F.col(fp).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
    return F.array(*keys)


def links(fps: DataFrame, max_distance: int = 4, blocks: int = BLOCKS,
          bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Spanning links (a, b) of the distinct fingerprints ``fp`` within
    ``max_distance`` bits: the links of each bucket, reduced to its trees."""
    if blocks <= max_distance:
        raise ValueError("blocks must exceed max_distance")
    keyed = fps.select("fp", F.explode(block_keys("fp", blocks, max_distance)).alias("key"))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(2 * F.col("n") / bucket_rows)
    # chunk c meets every chunk j in the group (min, max); small buckets are one group
    groups = keyed.join(own_exchange(counts, "key"), "key").withColumn("k", F.when(F.col("n") > bucket_rows, chunks).otherwise(1)) \
        .withColumn("c", F.pmod(F.xxhash64("fp"), F.col("k"))) \
        .withColumn("j", F.explode(F.when(F.col("k") == 1, F.array(F.lit(0).cast("long"))).otherwise(
            F.filter(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda j: j != F.col("c"))))) \
        .select("fp", F.xxhash64("key", F.least("c", "j"), F.greatest("c", "j")).alias("bucket"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(fp, bucket):
            a, b = near_pairs(fp.view(np.uint64), bucket, max_distance)
            root = local_roots(len(fp), a, b)
            child = np.flatnonzero(root != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[root[child]])], names=["a", "b"])

        fp, bucket = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            fp = np.concatenate([fp, b.column(0).to_numpy()])
            bucket = np.concatenate([bucket, b.column(1).to_numpy()])
            cut = np.searchsorted(bucket, bucket[-1]) if len(bucket) else 0
            if cut >= 8192:  # the last bucket may go on in the next batch
                yield compare(fp[:cut], bucket[:cut])
                fp, bucket = fp[cut:].copy(), bucket[cut:].copy()
        if len(fp):
            yield compare(fp, bucket)

    return (groups.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(giving_back(run), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per document: the id column, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest id of its component), ``text_hash``, ``root``
    (the component's smallest signed fingerprint, a key that is never NULL)."""
    rows = materialize(fingerprints(docs, shingle, seed, id_col, text_col), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("first_id"))
    distinct = materialize(distinct, "simhash-distinct")
    comps = connected_components(links(distinct, max_distance, blocks, bucket_rows), "a", "b")
    rooted = distinct.join(comps, distinct.fp == comps.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(own_exchange(first, "root"), "root").select("fp", "root", "component_id")
    return rows.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id", "text_hash", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row per near-duplicate component: the one with the
    smallest id (NULL last), then the smallest text hash.  Of rows that repeat
    both, one stays."""
    docs, now, back = set_aside(docs, "__id", "__hash")
    id_col, text_col = now(id_col), now(text_col)
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    best = F.min(F.struct(F.col(id_col).isNull().alias("null_id"), F.col(id_col).alias("id"), "text_hash"))
    chosen = found.groupBy("root").agg(best.alias("b")).select(
        F.xxhash64("b.id").alias("__id"), F.col("b.text_hash").alias("__hash")).distinct()
    # one exchange of the texts serves both the repeated rows (collapsed before it) and the join
    marked = docs.withColumns({"__id": F.xxhash64(f"`{id_col}`"), "__hash": F.xxhash64(f"`{text_col}`")})
    return back(marked.dropDuplicates(["__id", "__hash"]).join(chosen, ["__id", "__hash"], "left_semi")
                .drop("__id", "__hash"))
