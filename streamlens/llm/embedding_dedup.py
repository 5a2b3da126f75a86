"""Embedding near-duplicates by product quantisation.

Coarse k-means centroids give inverted lists; each vector is stored in its
nearest list with the subspace codes of its residual.  Every vector then
queries its ``probes`` nearest lists: the asymmetric distance to a stored code
is a sum of table look-ups, and since the code's own error e is stored too, a
vector y with code y' can only be within r of the query x if
|x - y'| <= r + e (triangle inequality).  What passes is reranked by the exact
cosine in double precision, so only true links are returned; only pairs that
lie in lists neither side probes can be missed.

Equal vectors are one row with a weight.  A list is dealt out in blocks of
stored rows and blocks of queries, so no task holds an unbounded list.  Tasks
return link counts per vector and the trees of the links they found, never the
pairs.

The coarse quantiser has two levels.  At most ``CELLS`` cells are fitted on a
bounded sample (``sample_rows``); where more lists than cells are wanted, every
cell is split by k-means in a Spark task of its own, on at most ``CELL_ROWS``
rows, into lists in proportion to its share of the rows.  A vector is compared
with the lists of its nearest ``CELL_PROBES`` cells.  Every vector is indexed and
queries.  ``lists`` defaults to the power of two at the root of the number of
distinct vectors, so a vector meets about ``probes`` times that root of stored
codes at any size; the table of lists (at most ``CELLS`` x ``CELL_LISTS`` rows,
reached at 7 x 10^10 vectors) is what the workers hold.

Edge cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components link with nothing, and vectors of different dimension do not link.
Repeated rows are rows of their own and link with each other.  A NULL id never
names a component unless it has no other member, and is not kept.  An empty
table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm.common import materialize, own_exchange
from streamlens.llm.components import connected_components, local_roots
from streamlens.llm.words import giving_back

SAMPLE_ROWS = 20_000
CELLS, CELL_LISTS, CELL_ROWS, CELL_PROBES = 1024, 256, 4096, 8
PROBES = 8
SUB_DIM = 8
STORED_ROWS, QUERY_ROWS = 8192, 65536
CHUNK_ROWS = 1024  # queries held against a block of stored rows at a time


def unit_rows(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (x @ centers.T - 0.5 * (centers * centers).sum(1)).argmax(1)


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = np.concatenate([_nearest(x[s:s + 4096], centers) for s in range(0, len(x), 4096)])
        order = np.argsort(at, kind="stable")
        used, first, count = np.unique(at[order], return_index=True, return_counts=True)
        centers[used] = np.add.reduceat(x[order], first, axis=0) / count[:, None]
    return centers


@dataclass
class Quantiser:
    cells: np.ndarray         # centroids of the cells
    starts: np.ndarray        # cell c has the lists starts[c] to starts[c + 1]
    lists: np.ndarray         # centroids of the lists
    cuts: list[int]           # subspace borders
    books: list[np.ndarray]   # code words per subspace

    def nearest_lists(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The nearest lists of unit rows, nearest first; -1 where the nearest
        cells have fewer than ``probes``."""
        score = x @ self.cells.T - 0.5 * (self.cells * self.cells).sum(1)
        if len(self.lists) == len(self.cells):  # every cell is one list
            which = np.broadcast_to(np.arange(len(self.lists)), score.shape)
        else:
            slots, width = min(CELL_PROBES, score.shape[1]), int(np.diff(self.starts).max())
            near = np.argpartition(-score, slots - 1, axis=1)[:, :slots]
            score = np.full((len(x), slots, width), -np.inf)
            which = np.full((len(x), slots, width), -1)
            order = np.argsort(near, axis=None, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(near.reshape(-1)[order])) + 1):
                row, slot = np.divmod(part, slots)
                lo, hi = self.starts[near[row[0], slot[0]]:][:2]
                centers = self.lists[lo:hi]
                score[row, slot, :hi - lo] = x[row] @ centers.T - 0.5 * (centers * centers).sum(1)
                which[row, slot, :hi - lo] = np.arange(lo, hi)
            score, which = score.reshape(len(x), -1), which.reshape(len(x), -1)
        probes = min(probes, score.shape[1])
        top = np.argpartition(-score, probes - 1, axis=1)[:, :probes]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(score, top, 1), axis=1, kind="stable"), 1)
        return np.take_along_axis(which, top, 1).astype(np.int32)

    def encode(self, x: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nearest lists, codes, error of the reconstruction) of unit rows."""
        top = self.nearest_lists(x, probes)
        residual = x - self.lists[top[:, 0]]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        error = np.zeros(len(x))
        for m, book in enumerate(self.books):
            part = residual[:, self.cuts[m]:self.cuts[m + 1]]
            codes[:, m] = _nearest(part, book)
            error += ((part - book[codes[:, m]]) ** 2).sum(1)
        return top, codes, np.sqrt(error)

    def distances(self, queries: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of queries to the codes of one list."""
        residual = queries - self.lists[which]
        total = np.zeros((len(queries), len(codes)), np.float32)
        for m, book in enumerate(self.books):
            part = residual[:, self.cuts[m]:self.cuts[m + 1]]
            table = (part * part).sum(1)[:, None] - 2 * part @ book.T + (book * book).sum(1)
            total += table.astype(np.float32)[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def fit(sample: np.ndarray, lists: int, sub_dim: int = SUB_DIM,
        split: Callable[[np.ndarray], list[np.ndarray]] | None = None) -> Quantiser:
    """Cells and residual code books from unit rows.  ``split`` gives the list
    centroids of every cell; without it a cell is one list."""
    cells = kmeans(sample, max(1, min(lists, CELLS, len(sample) // 16 or 1)))
    per_cell = split(cells) if split is not None else [c[None] for c in cells]
    starts = np.concatenate([[0], np.cumsum([len(c) for c in per_cell])])
    dim = sample.shape[1]
    cuts = [dim * i // max(1, dim // sub_dim) for i in range(max(1, dim // sub_dim) + 1)]
    z = Quantiser(cells, starts, np.concatenate(per_cell), cuts, [])
    own = np.concatenate([z.nearest_lists(sample[s:s + 1024], 1)[:, 0] for s in range(0, len(sample), 1024)])
    residual = sample - z.lists[own]
    z.books = [kmeans(residual[:, a:b], min(256, len(sample))) for a, b in zip(cuts, cuts[1:])]
    return z


def _hashed(salt: int, share) -> Column:
    """A filter that keeps a share of the rows by their uid."""
    return F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(1 << 30)) < F.floor(share * F.lit(1 << 30))


def _split_cells(vectors: DataFrame, dim: int, kind, lists: int, total: int, cells: np.ndarray) -> list[np.ndarray]:
    """List centroids per cell, fitted by one task per cell on 16 sampled rows
    per list, at most ``CELL_ROWS``.  The driver gets counts and centroids."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(cells)

    def to_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 1024):
                part = b.slice(s, 1024)
                raw = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind)
                at = _nearest(unit_rows(raw, dim), shared.value)
                each = [raw[i * dim:(i + 1) * dim].tobytes() for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(at.astype(np.int32)), pa.array(each, pa.binary())],
                                                 names=["uid", "cell", "x"])

    sampled = materialize(vectors.where(_hashed(13, F.lit(min(1.0, 16 * lists / total)))).select("uid", "x")
                          .mapInArrow(giving_back(to_cell), "uid long, cell int, x binary"), "pq-cells")
    counts = {r.cell: r["count"] for r in sampled.groupBy("cell").count().collect()}  # a row per cell
    share = lists / max(1, sum(counts.values()))
    n = sampled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    bounded = sampled.join(F.broadcast(n), "cell").where(_hashed(17, F.least(F.lit(1.0), F.lit(CELL_ROWS) / F.col("n"))))

    def split(key: tuple, t: pa.Table) -> pa.Table:
        x = unit_rows(np.frombuffer(b"".join(t.sort_by("uid")["x"].to_pylist()), kind), dim)
        want = max(1, min(round(share * counts[key[0].as_py()]), CELL_LISTS, len(x) // 4))
        return pa.table({"cell": pa.array([key[0].as_py()] * want, pa.int32()),
                         "center": pa.array([c.tobytes() for c in kmeans(x, want)], pa.binary())})

    found = bounded.select("cell", "uid", "x").groupBy("cell").applyInArrow(split, "cell int, center binary").toArrow()
    out = [[] for _ in cells]
    for cell, center in zip(found["cell"].to_pylist(), found["center"].to_pylist()):
        out[cell].append(np.frombuffer(center, np.float64))
    return [np.array(sorted(c, key=bytes)) if c else cells[i][None] for i, c in enumerate(out)]


def _find(stored: dict, q: dict, which: int, quantiser: Quantiser, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (query, stored) whose exact cosine is at least ``least``."""
    radius = np.sqrt(max(0.0, 2 - 2 * least)) + 1e-5  # the margin covers the tables' single precision
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s in range(0, len(q["uid"]), 256):
        x = q["x"][s:s + 256]
        near = quantiser.distances(x, which, stored["codes"]) <= radius + stored["error"].astype(np.float32)
        i, j = np.nonzero(near & (q["uid"][s:s + 256, None] != stored["uid"]))
        cosine = np.concatenate([np.einsum("ij,ij->i", x[i[k:k + 65536]], stored["x"][j[k:k + 65536]])
                                 for k in range(0, len(i), 65536)] or [np.zeros(0)])
        good = cosine >= least
        left.append(i[good] + s)
        right.append(j[good])
    return np.concatenate(left), np.concatenate(right)


def _links_of(vectors: DataFrame, dim: int, least: float, lists: int | None, probes: int, sample_rows: int) -> DataFrame:
    """(uid, n, peer): parts of the link counts, and links that span the
    components, of distinct vectors (uid, weight, x) of one dimension."""
    spark = vectors.sparkSession
    wide = vectors.schema["x"].dataType.elementType.typeName() == "double"
    kind = np.float64 if wide else np.float32
    total = vectors.count()
    if lists is None:
        lists = 1 << max(0, round(np.log2(max(1, total)) / 2))
    lists = min(lists, CELLS * CELL_LISTS)
    sample_rows = max(256, min(sample_rows, (64 << 20) // (8 * dim)))
    picked = vectors.where(F.pmod(F.xxhash64("uid", F.lit(11)), F.lit(1 << 30)) <= int(min(1.0, sample_rows / total) * (1 << 30)))
    sample = picked.select("uid", "x").toArrow().combine_chunks().sort_by("uid")
    flat = np.asarray(sample["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False))
    if not len(flat):
        flat = np.asarray(vectors.first().x)  # a table so small that the hash picked none
    split = None
    if lists > min(CELLS, sample_rows // 16):  # more than the sample can fit
        split = lambda cells: _split_cells(vectors, dim, kind, lists, total, cells)
    shared = spark.sparkContext.broadcast(fit(unit_rows(flat, dim), lists, split=split))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = shared.value
        for b in batches:
            for s in range(0, b.num_rows, 1024):
                part = b.slice(s, 1024)
                raw = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind)
                top, codes, error = z.encode(unit_rows(raw, dim), probes)
                n = part.num_rows
                each = [raw[i * dim:(i + 1) * dim].tobytes() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(top[:, 0]), pa.array(each, pa.binary()),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                     pa.array([t[t >= 0].tolist() for t in top], pa.list_(pa.int32()))],
                    names=["uid", "weight", "own", "x", "codes", "error", "probes"])

    indexed = materialize(vectors.select("uid", "weight", "x").mapInArrow(
        giving_back(assign), "uid long, weight long, own int, x binary, codes binary, error double, probes array<int>"), "pq-index")
    asked = indexed.select("uid", F.explode("probes").alias("list"))
    blocks = (asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("qn"))
              .join(indexed.groupBy(F.col("own").alias("list")).agg(
                  F.ceil(F.count(F.lit(1)) / STORED_ROWS).cast("int").alias("sn")), "list"))
    blocks = F.broadcast(materialize(blocks, "pq-blocks"))  # a row per list: at most CELLS * CELL_LISTS
    none = F.lit(None)
    stored = (indexed.join(blocks, indexed.own == blocks.list)
              .select("list", F.pmod(F.xxhash64("uid"), "sn").cast("int").alias("sb"),
                      F.explode(F.sequence(F.lit(0), F.col("qn") - 1)).alias("qb"), F.lit(False).alias("query"),
                      "uid", "weight", "own", "x", "codes", "error", "probes"))
    queries = (indexed.withColumn("probe", F.explode("probes")).join(blocks, F.col("probe") == blocks.list)
               .select("list", F.explode(F.sequence(F.lit(0), F.col("sn") - 1)).alias("sb"),
                       F.pmod(F.xxhash64("uid"), "qn").cast("int").alias("qb"), F.lit(True).alias("query"),
                       "uid", "weight", "own", "x", none.cast("binary").alias("codes"),
                       none.cast("double").alias("error"), none.cast("array<int>").alias("probes")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = shared.value

        def load(rows: list[pa.RecordBatch], is_query: bool) -> dict:
            t = pa.Table.from_batches(rows)
            out = {"uid": t["uid"].to_numpy(), "weight": t["weight"].to_numpy(), "own": t["own"].to_numpy(),
                   "x": unit_rows(np.frombuffer(b"".join(t["x"].to_pylist()), kind), dim)}
            if not is_query:
                out["codes"] = np.frombuffer(b"".join(t["codes"].to_pylist()), np.uint8).reshape(t.num_rows, -1)
                out["error"] = t["error"].to_numpy()
                probed = t["probes"].to_pylist()  # padded: a vector may have fewer lists near it
                out["probes"] = np.array([p + [-1] * (probes - len(p)) for p in probed], np.int32)
            return out

        def results(stored: dict, q: dict, which: int) -> pa.RecordBatch:
            i, j = _find(stored, q, which, z, least)
            # a stored vector that does not probe the query's list would not find it: count it here
            back = (stored["probes"][j] != q["own"][i, None]).all(1) & (q["own"][i] != which)
            n = np.concatenate([np.bincount(j[back], q["weight"][i[back]], len(stored["uid"])),
                                np.bincount(i, stored["weight"][j], len(q["uid"]))]).astype(np.int64)
            uid = np.concatenate([stored["uid"], q["uid"]])
            _, node = np.unique(uid, return_inverse=True)  # a vector is stored and queries its own list
            first = np.full(node.max() + 1, len(uid))
            np.minimum.at(first, node, np.arange(len(uid)))
            root = local_roots(len(first), node[j], node[len(stored["uid"]) + i])
            peer = uid[first[root[node]]]
            hit = (n > 0) | (peer != uid)
            return pa.RecordBatch.from_arrays([pa.array(uid[hit]), pa.array(n[hit]), pa.array(peer[hit])],
                                              names=["uid", "n", "peer"])

        group, rows, stored = None, [], None
        for b in batches:
            key = np.stack([b.column(c).to_numpy() for c in range(3)], 1)
            is_query = b.column(3).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(key, axis=0) != 0).any(1) | (np.diff(is_query.astype(np.int8)) != 0)) + 1
            for s, e in zip([0, *edges], [*edges, b.num_rows]):
                if e == s:
                    continue
                if group != tuple(key[s]):
                    group, rows, stored = tuple(key[s]), [], None
                if not is_query[s]:  # stored rows come first, maybe over several batches
                    rows.append(b.slice(s, e - s))
                elif rows or stored:
                    if stored is None:
                        stored, rows = load(rows, False), []
                    for p in range(s, e, CHUNK_ROWS):
                        yield results(stored, load([b.slice(p, min(CHUNK_ROWS, e - p))], True), int(group[0]))

    return (stored.union(queries).repartition("list", "sb", "qb").sortWithinPartitions("list", "sb", "qb", "query")
            .mapInArrow(giving_back(search), "uid long, n long, peer long"))


def near_duplicates(embeddings: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
                    lists: int | None = None, probes: int = PROBES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector."""
    v = F.col(f"`{vector_col}`")
    usable = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                        & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = embeddings.select(F.col(f"`{id_col}`").alias("id"), F.when(usable, v).alias("x"))
    distinct = (rows.where("x is not null").groupBy("x").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("first_id"))
                .withColumn("uid", F.monotonically_increasing_id()))
    distinct = materialize(distinct, "vectors")
    found = None
    for r in distinct.groupBy(F.size("x").alias("dim")).count().orderBy("dim").collect():
        part = _links_of(distinct.where(F.size("x") == r.dim), r.dim, least, lists, probes, sample_rows)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    found = materialize(found, "links")
    counts = found.groupBy("uid").agg(F.sum("n").alias("n"))
    comps = connected_components(found.select("uid", "peer").where("uid <> peer"), "uid", "peer")
    rooted = (distinct.select("uid", "x", "weight", "first_id").join(counts, "uid", "left")
              .join(comps.withColumnRenamed("node", "uid"), "uid", "left")
              .withColumn("root", F.coalesce("root", "uid"))
              .withColumn("n", F.coalesce("n", F.lit(0)) + F.col("weight") - 1))
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(own_exchange(first, "root"), "root").select("x", F.col("n").alias("n_links"), "component_id")
    linked = rows.where("x is not null").join(classes, "x").select("id", "n_links", "component_id")
    alone = rows.where("x is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(
        F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
