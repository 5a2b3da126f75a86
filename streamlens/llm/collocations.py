"""Phrase collocation mining over a prefix-free parse.

Texts are cut into pieces at punctuation and line ends, pieces into words.  A
word whose hash is divisible by ``PERIOD`` triggers a cut, so equal passages are
cut alike wherever they stand: each piece becomes chunks that start at a trigger
and reach ``max_words - 1`` words into the next chunk.  The dictionary holds the
distinct chunks with their frequencies in the parse.  Phrases are counted inside
distinct chunks only, weighted by the frequency; one that starts in a chunk's
own words is counted there, so what stands in an overlap is counted once.

Phrases of n > 2 words are counted when their two parts of n - 1 words are
frequent (a phrase is never more frequent than its parts).  The frequent parts reach the
tasks as a Bloom filter of at most ``FILTER_BITS`` bits, whatever their number:
beyond that it lets more phrases through, which the exact count then drops.
Where no word triggers for ``LONGEST`` words a cut is made all the same; it only
costs repeats in the dictionary.

Counts are longs, products ``decimal(38,0)``: exact while the squared count
times 10^6 has at most 38 digits (counts below 10^16).

Edge cases: NULL and empty texts have no words.  A NULL language is ``und``; an
empty one is a language of its own.  Repeated rows count each.  An empty table
gives an empty result.  Columns other than the text and language are not read,
whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlens.llm.common import materialize, own_exchange
from streamlens.llm.packing import expand
from streamlens.llm.words import byte_slices, giving_back

PERIOD = 12
LONGEST = 96
FILTER_BITS = 1 << 27
_BLOCK_BITS = 1 << 20  # a task builds the filter in blocks of 128 KB
SLICE_BYTES = 4 << 20
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 10 if c in _BREAKS else 32 if c == 9 else c for c in range(256))


class _Words:
    """The words of some texts: codes, distinct words, and where pieces end."""

    def __init__(self, texts: list[bytes]):
        data = b"\n".join([*texts, b""]).translate(_FOLD)
        raw = np.frombuffer(data, np.uint8)
        inside = (raw != 32) & (raw != 10)
        edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        begin, end = edge[::2], edge[1::2]
        breaks = np.flatnonzero(raw == 10)
        piece = np.searchsorted(breaks, begin)  # number of the piece each word is in
        starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
        self.text = np.searchsorted(starts, begin, side="right") - 1
        self.new_piece = np.diff(piece, prepend=-1) != 0
        size = end - begin
        flat = pa.Array.from_buffers(pa.large_binary(), len(begin), [
            None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)])), pa.py_buffer(raw[inside].tobytes())])
        coded = flat.dictionary_encode()
        self._raw, self._inside, self._end, self._size = raw, inside, end, size
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.distinct = coded.dictionary

    def runs(self, start: np.ndarray, count: np.ndarray) -> pa.Array:
        """Runs of neighbouring words (count >= 1), joined by blanks."""
        kept = self._inside.copy()
        kept[self._end] = True  # one byte after every word: a run is a slice
        line = self._raw[kept]
        at = np.concatenate([[0], np.cumsum(self._size + 1)])
        line[at[1:] - 1] = 32
        line = line.tobytes()
        return pa.array([line[a:b] for a, b in zip(at[start].tolist(), (at[start + count] - 1).tolist())], pa.large_binary())

    def phrases(self, start: np.ndarray, n: int) -> pa.Array:
        """Phrases of n words."""
        words = [self.distinct.take(pa.array(self.codes[start + k])) for k in range(n)]
        return words[0] if n == 1 else pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary()))


def _hashes(distinct: pa.Array) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, distinct.to_pylist()), np.int64, len(distinct))


def parse(docs: DataFrame, max_words: int = 3, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, chunk, own, freq): the dictionary of distinct chunks, their words
    joined by blanks; ``own`` words are the chunk's, the rest is overlap."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 1, SLICE_BYTES):
                w = _Words(b.column(1).cast(pa.binary()).to_pylist())
                if not len(w.codes):
                    continue
                n = len(w.codes)
                at = np.arange(n)
                cut = w.new_piece | (_hashes(w.distinct) % PERIOD == 0)[w.codes]
                since = at - np.maximum.accumulate(np.where(cut, at, 0))
                start = np.flatnonzero(cut | (since % LONGEST == 0))
                own = np.diff(start, append=n)
                piece_end = np.append(np.flatnonzero(w.new_piece)[1:], n)
                end = piece_end[np.searchsorted(piece_end, start, side="right")]
                count = np.minimum(own + max_words - 1, end - start)
                chunks = w.runs(start, count).dictionary_encode()
                lang = b.column(0).dictionary_encode()
                # equal chunks of the slice are counted here
                code = chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                place = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[w.text[start]]
                at, freq = _added_up(place, len(lang.dictionary), [own, code], max(LONGEST + 1, len(chunks.dictionary)),
                                     np.ones(len(code), np.int64))
                yield from _text_batches(
                    [lang.dictionary.take(pa.array(place[at])), chunks.dictionary.take(pa.array(code[at])),
                     pa.array(own[at], pa.int32()), pa.array(freq)], ["lang", "chunk", "own", "freq"])

    parts = rows.mapInArrow(giving_back(run), "lang string, chunk string, own int, freq long")
    return parts.groupBy("lang", "chunk", "own").agg(F.sum("freq").alias("freq"))


def _text_batches(columns: list[pa.Array], names: list[str], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    for s in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays(
            [c.slice(s, rows).cast(pa.binary()).cast(pa.string()) if pa.types.is_large_binary(c.type) else c.slice(s, rows)
             for c in columns], names=names)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _phrase_hash(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of phrases from the hashes of their language and words."""
    h = _mix(lang.astype(np.uint64) + np.uint64(1))
    for w in words:
        h = _mix(h * np.uint64(31) + w)
    return h


def _word_hash(distinct: pa.Array) -> np.ndarray:
    import xxhash
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))


def _lang_hash(lang: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(x.encode()) for x in lang.to_pylist()), np.int64, len(lang))


def _bits_for(keys: int) -> int:
    """Filter size: 16 bits a key, a power of two, at most FILTER_BITS."""
    bits = _BLOCK_BITS
    while bits < min(keys * 16, FILTER_BITS):
        bits *= 2
    return bits


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(36)) & mask).astype(np.int64)


def bloom(frequent: DataFrame) -> np.ndarray:
    """Bloom filter (as packed bits) of phrases (lang, phrase).  Blocks of
    128 KB are built by tasks; at most FILTER_BITS / 8 bytes reach the driver."""
    bits = _bits_for(frequent.count())

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = _Words(b.column(1).cast(pa.binary()).to_pylist())
            hashed, lang = _word_hash(w.distinct)[w.codes], _lang_hash(b.column(0))
            first = np.searchsorted(w.text, np.arange(b.num_rows))
            count = np.diff(first, append=len(w.codes))
            both = []
            for n in np.unique(count):
                at = np.flatnonzero(count == n)
                both += _places(_phrase_hash(lang[at], [hashed[first[at] + k] for k in range(n)]), bits)
            place = np.unique(np.concatenate(both)) if both else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place // _BLOCK_BITS), pa.array((place % _BLOCK_BITS).astype(np.int32))],
                                             names=["block", "bit"])

    def block(group: pa.Table) -> pa.Table:
        found = np.zeros(_BLOCK_BITS, np.uint8)
        found[group.column("bit").to_numpy()] = 1
        return pa.table({"block": group.column("block").slice(0, 1),
                         "data": pa.array([np.packbits(found).tobytes()], pa.binary())})

    blocks = (frequent.select("lang", "phrase").mapInArrow(giving_back(places), "block long, bit int").distinct()
              .groupBy("block").applyInArrow(block, "block long, data binary"))
    out = np.zeros(bits // 8, np.uint8)
    for row in blocks.toLocalIterator():
        out[row.block * (_BLOCK_BITS // 8):(row.block + 1) * (_BLOCK_BITS // 8)] = np.frombuffer(row.data, np.uint8)
    return out


def _added_up(place: np.ndarray, n_places: int, words: list[np.ndarray], n_words: int, freq: np.ndarray):
    """(one index of each distinct phrase, the sum of its frequencies)."""
    key, values = place, n_places
    for w in words:
        if values * n_words >= 1 << 62:  # number the phrases so far, to stay within 64 bits
            key = np.unique(key, return_inverse=True)[1]
            values = len(key)
        key, values = key * n_words + w, values * n_words
    order = np.argsort(key)
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    return order[first], np.add.reduceat(freq[order], first)


def _counted(chunks: DataFrame, sizes: list[int], min_count: int, parts: DataFrame | None) -> DataFrame:
    """(lang, phrase, f) of phrases of so many words with f >= min_count;
    ``parts`` are the frequent phrases of one word less."""
    spark = chunks.sparkSession
    held = spark.sparkContext.broadcast(bloom(parts)) if parts is not None else None  # at most FILTER_BITS / 8 bytes

    def passes(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
        a, b = _places(h, len(bits) * 8)
        return ((bits[a >> 3] >> (7 - (a & 7)).astype(np.uint8)) & (bits[b >> 3] >> (7 - (b & 7)).astype(np.uint8)) & 1) == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 1, SLICE_BYTES):
                w = _Words(b.column(1).cast(pa.binary()).to_pylist())
                own, freq = b.column(2).to_numpy().astype(np.int64), b.column(3).to_numpy()
                first = np.searchsorted(w.text, np.arange(b.num_rows))
                count = np.diff(first, append=len(w.codes))
                lang = b.column(0).dictionary_encode()
                lang_of = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                if held is not None:
                    hashed, of_lang = _word_hash(w.distinct), _lang_hash(lang.dictionary)
                for n in sizes:
                    here = np.maximum(np.minimum(own, count - n + 1), 0)
                    start, row = expand(first, here), np.repeat(np.arange(b.num_rows), here)
                    if held is not None:
                        for k in range(2):  # the parts without the last and without the first word
                            h = _phrase_hash(of_lang[lang_of[row]], [hashed[w.codes[start + k + j]] for j in range(n - 1)])
                            good = passes(h, held.value)
                            start, row = start[good], row[good]
                    if not len(start):
                        continue
                    at, f = _added_up(lang_of[row], len(lang.dictionary), [w.codes[start + k] for k in range(n)],
                                      len(w.distinct), freq[row])
                    yield from _text_batches(
                        [lang.dictionary.take(pa.array(lang_of[row[at]])),
                         w.phrases(start[at], n), pa.array(f)],
                        ["lang", "phrase", "f"])

    rows = chunks.select("lang", "chunk", "own", "freq").mapInArrow(giving_back(run), "lang string, phrase string, f long")
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def phrase_counts(chunks: DataFrame, max_words: int = 3, min_count: int = 10) -> DataFrame:
    """(lang, phrase, n_words, f) of all phrases of up to max_words words with f >= min_count."""
    size = (F.size(F.split("phrase", " "))).alias("n_words")
    # single words need no filter, and pairs gain little from one: both in one pass
    out = materialize(_counted(chunks, [1, 2][:max_words], min_count, None).select("*", size), "phrases-2")
    parts = out.where("n_words = 2")
    for n in range(3, max_words + 1):
        parts = materialize(_counted(chunks, [n], min_count, parts).select("*", size), f"phrases-{n}")
        out = out.unionByName(parts)
    return out


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2000, covered_pct: int = 50,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``,
    ``a`` (its count), ``l`` and ``r`` (of the parts of its worst cut), ``n``
    (words of the language) and ``score`` = floor(10^6 a^2 / (l r)).

    A candidate inside a longer one of at least ``covered_pct`` percent of its
    count is dropped.
    """
    chunks = materialize(parse(docs, max_words, text_col, lang_col), "chunks")
    total = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))
    counted = phrase_counts(chunks, max_words, min_count)
    words = F.split("phrase", " ")
    phrases = counted.where("n_words >= 2").select("lang", "phrase", "n_words", F.col("f").alias("a"), words.alias("w"))
    cuts = phrases.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"), "w")
    cuts = cuts.select("lang", "phrase", "a", "k",
                       F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"))
    # one row per phrase on the counted side; a word that begins or ends many phrases is a skewed join that AQE splits
    found = counted.select("lang", "phrase", "f")
    for part, count in (("left", "l"), ("rest", "r")):
        cuts = cuts.join(own_exchange(found.select("lang", F.col("phrase").alias(part), F.col("f").alias(count)),
                                      "lang", part), ["lang", part])
    big = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.withColumn("big_a", big("a")).withColumn("big_l", big("l")).withColumn("big_r", big("r"))
    scored = cuts.withColumn("score", F.expr("(cast(1000000 as decimal(38,0)) * big_a * big_a) div (big_l * big_r)"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select(
        "lang", "phrase", "b.score", "b.a", "b.l", "b.r")
    # every shorter candidate inside a longer one, with the longer one's count
    size = F.size("w")
    inside = phrases.where("n_words > 2").select(
        "lang", F.col("a").alias("longer"), F.explode(F.flatten(F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda m: F.transform(F.sequence(F.lit(1), size - m + 1),
                                  lambda i: F.array_join(F.slice("w", i, m), " "))))).alias("phrase"))
    most = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = (best.join(most, ["lang", "phrase"], "left")
            .where("longer is null or 100 * cast(longer as decimal(38,0)) < %d * cast(a as decimal(38,0))" % covered_pct))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    # a group limit in every task comes before the exchange, so a language sends at most `top` rows a task
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


#: the SQL twin of ``collocations`` with its default parameters, on documents
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM words WHERE len(w) > 0 GROUP BY lang),
counted AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, s.size, unnest(list_transform(range(1, len(w) + 2 - s.size),
      lambda i: array_to_string(w[i:i + s.size - 1], ' '))) AS phrase
    FROM words, (VALUES (1), (2), (3)) s(size) WHERE len(w) >= s.size)
  GROUP BY lang, size, phrase HAVING count(*) >= 10),
candidates AS MATERIALIZED (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size >= 2),
cuts AS MATERIALIZED (
  SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
scored AS MATERIALIZED (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, l.f AS l, r.f AS r,
         (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN counted l ON l.lang = c.lang AND l.phrase = c.head
  JOIN counted r ON r.lang = c.lang AND r.phrase = c.rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
    FROM candidates WHERE size = 3) GROUP BY lang, phrase),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.phrase = b.phrase
  WHERE x.a IS NULL OR 100 * x.a < 50 * b.a)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r,
       t.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= 2000
"""
