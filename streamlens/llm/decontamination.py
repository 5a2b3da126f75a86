"""Benchmark decontamination with an FM-index per training shard.

Every task cuts its documents into shards of bounded text, indexes each shard
(fm_index.py) and backward-searches the benchmark's word windows in it.  Hits
are located by sampled suffix positions and merged into removal spans.  The
index does not depend on the benchmark: its windows are built by Spark tasks as
files of bounded size in the shared folder.  A worker holds the indexes of several
shards and one block at a time, and reads every block once for them all (with one
block only, which stays loaded, it holds one shard).  Documents are neither shuffled nor compared with each other.

Words: A-Z lower-cased, then runs of ASCII letters, digits and all non-ASCII
characters.  A window is ``window`` consecutive words of an item; an item of
fewer words (but not none) is one window.

Edge cases: NULL or empty texts have no words and are never hit; items without
words are ignored; a NULL item id counts as an item named "".  Repeated items
with one id count once.  Empty tables are fine on either side.  Input columns
named like an output column are replaced.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamlens.llm.common import without
from streamlens.llm.fm_index import FMIndex
from streamlens.llm.packing import expand
from streamlens.llm.words import Words, byte_slices, giving_back
from streamlens.session import scratch_path
from streamlens.sources.files import filesystem

SHARD_BYTES = 3 << 20  # an index takes about 30 times as much memory while it is built
BLOCK_BYTES = 4 << 20  # of text; its windows take about 15 times as much
HELD_BYTES = 48 << 20  # of text, whose indexes a worker holds while the blocks pass; measured at 3 times as much beside the texts
_OUT = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start:int,end:int>>"


def windows(items: list[tuple[str, bytes]], size: int) -> dict:
    """The distinct windows of a block of items and the items of each window."""
    words = Words([t for _, t in items])
    names = sorted({i for i, _ in items})
    index = {n: k for k, n in enumerate(names)}
    first = np.concatenate([[0], np.cumsum(words.n_words)])
    per_item = np.where(words.n_words == 0, 0, np.maximum(words.n_words - size + 1, 1))
    start = expand(first[:-1], per_item)
    length = np.repeat(np.minimum(words.n_words, size), per_item)
    item = np.repeat(np.array([index[i] for i, _ in items], np.int64), per_item)
    grid = np.full((len(start), size), -1, np.int64)
    for j in range(size):  # right-aligned
        has = length > j
        grid[has, size - 1 - j] = words.codes[start[has] + length[has] - 1 - j]
    distinct, which = np.unique(grid, axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.reshape(-1), item], 1), axis=0)
    return {"vocabulary": words.vocabulary, "grid": distinct, "length": (distinct >= 0).sum(1),
            "items": pairs[:, 1], "items_at": np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)),
            "names": names}


_last: tuple[str, dict] | None = None


def _loaded(path: str) -> dict:
    """A block of windows; a worker keeps the last one only."""
    global _last
    if _last is None or _last[0] != path:
        _last = None
        fs, at = filesystem(path)
        with fs.open_input_stream(at) as f:
            _last = (path, pickle.loads(f.read()))
    return _last[1]


class Shard:
    """The index of some texts and what has been found in it so far."""

    def __init__(self, texts: list[bytes]):
        words = Words(texts)
        self.n_words, self.vocabulary = words.n_words, words.vocabulary
        self.begin, self.end = words.begin.astype(np.int32), words.end.astype(np.int32)
        self.hit = np.zeros(len(words.codes), bool)
        self.found: list[set] = [set() for _ in texts]
        self.index = FMIndex(words.codes, words.n_words, len(words.vocabulary)) if len(words.codes) else None

    def search(self, block: dict) -> None:
        """Add the occurrences of a block's windows."""
        index = self.index
        if index is None:
            return
        code = pc.index_in(block["vocabulary"], value_set=self.vocabulary)
        code = np.append(code.fill_null(-1).to_numpy(zero_copy_only=False), 0)  # -1 (padding) -> 0
        grid = code[block["grid"]]
        known = np.flatnonzero((grid >= 0).all(1))
        lo, hi = index.search(grid[known], block["length"][known])
        some = hi > lo
        lo, count, known = lo[some], (hi - lo)[some], known[some]
        at = index.locate(expand(lo, count))
        which = np.repeat(known, count)
        doc = np.searchsorted(index.starts, at, side="right") - 1
        at = at - doc  # separators before it
        delta = np.zeros(len(self.hit) + 1, np.int64)
        np.add.at(delta, at, 1)
        np.add.at(delta, at + block["length"][which], -1)
        self.hit |= np.cumsum(delta[:-1]) > 0
        pair = np.unique(doc * np.int64(len(block["length"])) + which)
        doc, which = np.divmod(pair, len(block["length"])) if len(pair) else (pair, pair)
        begin = block["items_at"][which]
        per = block["items_at"][which + 1] - begin
        pair = np.unique(np.repeat(doc, per) * np.int64(len(block["names"])) + block["items"][expand(begin, per)])
        for d, i in zip(*(np.divmod(pair, len(block["names"])) if len(pair) else (pair, pair))):
            self.found[d].add(block["names"][i])

    def result(self) -> tuple[np.ndarray, np.ndarray, list, list]:
        """Per text: words, hit words, names of the items found, spans to remove."""
        first = np.concatenate([[0], np.cumsum(self.n_words)])
        total = np.concatenate([[0], np.cumsum(self.hit)])
        n_hit = total[first[1:]] - total[first[:-1]]
        spans: list = [[] for _ in self.found]
        for d in np.flatnonzero(n_hit):
            edge = np.flatnonzero(np.diff(self.hit[first[d]:first[d + 1]].astype(np.int8), prepend=0, append=0))
            spans[d] = [(int(self.begin[first[d] + s]), int(self.end[first[d] + e - 1]))
                        for s, e in zip(edge[::2], edge[1::2])]
        return self.n_words, n_hit, [sorted(f) for f in self.found], spans


def search_shards(shards: list[Shard], blocks: list[dict | str]) -> None:
    """Pass every block once over all the shards."""
    if not any(s.index for s in shards):
        return
    for b in blocks:
        block = None  # not two at once
        block = _loaded(b) if isinstance(b, str) else b
        for s in shards:
            s.search(block)


def _blocks(benchmark: DataFrame, window: int, id_col: str, text_col: str, block_bytes: int) -> list[str]:
    """The files of the benchmark's windows.  The number of blocks follows the
    measured size, so a block is made of about ``block_bytes`` of text (more
    only if one item is longer)."""
    items = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                             F.col(f"`{text_col}`").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes)
    if not n:
        return []
    root = scratch_path(benchmark.sparkSession, "benchmark-blocks")

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        items = sorted(set(zip(rows["id"].to_pylist(), rows["text"].to_pylist())))
        block = windows([(i, t.encode()) for i, t in items], window)
        path = f"{root}/block-{key[0].as_py()}"
        some = len(block["length"]) and block["length"].max() > 0
        if some:
            fs, at = filesystem(root)
            fs.create_dir(at, recursive=True)
            tmp = f"{at}/.{uuid.uuid4().hex}.part"  # a retry writes the same name
            with fs.open_output_stream(tmp) as out:
                out.write(pickle.dumps(block, pickle.HIGHEST_PROTOCOL))
            fs.move(tmp, f"{at}/block-{key[0].as_py()}")
        return pa.table({"path": pa.array([path] if some else [], pa.string())})

    k = F.pmod(F.xxhash64("id", "text"), F.lit(n)).alias("block")
    built = items.select(k, "id", "text").groupBy("block").applyInArrow(build, "path string")
    return sorted(r.path for r in built.collect())


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", cut: bool = False,
                  keep_text: bool = True, shard_bytes: int = SHARD_BYTES,
                  block_bytes: int = BLOCK_BYTES, held_bytes: int = HELD_BYTES) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit``, ``item_ids`` (sorted names of the
    items found) and ``spans`` (byte ranges of the UTF-8 text that hold the hit
    words).  ``cut`` removes the spans from the text; ``keep_text=False`` leaves
    the text column out of the result.
    """
    docs = without(docs, "n_words", "n_hit", "item_ids", "spans")
    place = docs.columns.index(text_col)
    blocks = _blocks(benchmark, window, item_col, item_text_col, block_bytes)
    kept = [i for i, c in enumerate(docs.columns) if keep_text or c != text_col]
    schema = StructType([docs.schema[i] for i in kept]
                        + StructType.fromDDL(_OUT).fields)
    out_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def finished(b: pa.RecordBatch, texts: list[bytes], shard: Shard) -> pa.RecordBatch:
        n_words, n_hit, items, spans = shard.result()
        cols = [b.column(i) for i in range(b.num_columns)]
        if cut and n_hit.any():
            new = b.column(place).to_pylist()
            for d in np.flatnonzero(n_hit):
                ends = [0, *[e for _, e in spans[d]]]
                begins = [*[s for s, _ in spans[d]], len(texts[d])]
                new[d] = b"".join(texts[d][s:e] for s, e in zip(ends, begins)).decode()
            cols[place] = pa.array(new, b.column(place).type)
        return pa.RecordBatch.from_arrays(
            [cols[i] for i in kept] + [
                pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(items, pa.list_(pa.string())), pa.array(spans, out_type)],
            names=[f.name for f in schema])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        """Shards whose texts have about ``held_bytes`` together."""
        group, held = [], 0
        for batch in batches:
            for b in byte_slices(batch, place, shard_bytes):
                texts = [t or b"" for t in b.column(place).cast(pa.binary()).to_pylist()]
                group.append((b, texts, Shard(texts)))
                held += sum(map(len, texts))
                if len(blocks) < 2 or held >= held_bytes:
                    yield group
                    group, held = [], 0
        if group:
            yield group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            search_shards([shard for *_, shard in group], blocks)
            while group:
                yield finished(*group.pop(0))

    return docs.mapInArrow(giving_back(run), schema)
