"""Near-duplicate vectors: all pairs by int8 tile products with error bounds.

Equal vectors are one class first. Classes are dealt into tiles of about ``tile`` rows
and every pair of tiles is one row of work. Inside it both sides are scaled to length one
and rounded to int8 with a scale per vector; the length of what rounding lost is kept, so
``product + lost`` is a true upper bound of the cosine. Only pairs whose bound reaches
the threshold are computed in double precision. A task returns per vector the number of
its links and one edge to the smallest member of its local component, never all pairs.

A vector that is null, empty, zero or has a null or non-finite component links with
nothing; vectors of different lengths never link. Null ids take part but cannot name a
component. A repeated id is one row each time; equal vectors under one id are copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import stored
from riskloom.llm.components import components

TILE = 4096
NO_ID = 2**63 - 1
EXACT_DIMS = 1024  # 127 * 127 * 1024 < 2**24, so float32 sums of int8 products are exact
SLACK = 1e-9


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1).cast(pa.list_(pa.float64()))
        values = lists.values.to_numpy(zero_copy_only=False) + 0.0
        offsets = lists.offsets.to_numpy()
        valid = lists.is_valid().to_numpy(zero_copy_only=False)
        keys, raws = [], []
        for i in range(len(lists)):
            vector = values[offsets[i] : offsets[i + 1]] if valid[i] else values[:0]
            good = len(vector) and np.isfinite(vector).all() and vector.any()
            raw = _short(vector) if good else None
            keys.append(hashlib.md5(vector.tobytes()).digest() if good else None)
            raws.append(raw)
        yield pa.record_batch(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())], ["vec_id", "key", "raw"]
        )


def _short(vector: np.ndarray) -> bytes:
    """The bytes of the vector: a mark, then float32 where that is exact, else float64."""
    with np.errstate(over="ignore"):
        single = vector.astype(np.float32)
    return b"s" + single.tobytes() if (single == vector).all() else b"d" + vector.tobytes()


def _long(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if raw[:1] == b"s" else np.float64, offset=1).astype(np.float64)


class Tile:
    """One side of a product: exact vectors, int8 codes and what rounding lost."""

    def __init__(self, rows: pa.StructArray):
        self.ids = rows.field("id").to_numpy()
        self.keys = rows.field("key")
        self.copies = rows.field("copies").to_numpy()
        vectors = np.stack([_long(r) for r in rows.field("raw").to_pylist()])
        # a common factor changes no cosine and keeps squares in range
        self.exact = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        self.norm = np.sqrt((self.exact**2).sum(1))
        unit = self.exact / self.norm[:, None]
        self.scale = np.abs(unit).max(1) / 127.0
        self.codes = np.rint(unit / self.scale[:, None]).astype(np.int8)
        kept = self.codes * self.scale[:, None]
        self.lost = np.sqrt(((unit - kept) ** 2).sum(1)) + SLACK
        self.length = np.sqrt((kept**2).sum(1)) + SLACK


def links_of(a: Tile, b: Tile, same: bool, cosine: float, step: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the linked pairs; for a tile with itself only left < right."""
    dims = a.codes.shape[1]
    right = b.codes.astype(np.float32)
    left_rows, right_rows = [], []
    for at in range(0, len(a.ids), step):
        stop = min(at + step, len(a.ids))
        left = a.codes[at:stop].astype(np.float32)
        product = left[:, :EXACT_DIMS] @ right[:, :EXACT_DIMS].T
        if dims > EXACT_DIMS:
            product = product.astype(np.float64)
            for d in range(EXACT_DIMS, dims, EXACT_DIMS):
                product += left[:, d : d + EXACT_DIMS] @ right[:, d : d + EXACT_DIMS].T
        # unit_a . unit_b <= kept_a . kept_b + |kept_a| lost_b + lost_a
        need = cosine - SLACK - a.lost[at:stop, None] - a.length[at:stop, None] * b.lost[None, :]
        r, c = np.nonzero(product >= (need / (a.scale[at:stop, None] * b.scale[None, :]) - 1e-3))
        r = r + at
        if same:
            r, c = r[r < c], c[r < c]
        for part in np.array_split(np.arange(len(r)), len(r) // 200_000 + 1):
            i, j = r[part], c[part]
            real = np.einsum("ij,ij->i", a.exact[i], b.exact[j]) / (a.norm[i] * b.norm[j])
            left_rows.append(i[real >= cosine])
            right_rows.append(j[real >= cosine])
    return np.concatenate(left_rows), np.concatenate(right_rows)


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable number of each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _products(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            same = batch.column(0)[k].as_py() == batch.column(1)[k].as_py()
            a = Tile(batch.column(2)[k].values)
            b = a if same else Tile(batch.column(3)[k].values)
            i, j = links_of(a, b, same, cosine)
            if not len(i):
                continue
            base = 0 if same else len(a.ids)
            n = len(a.ids) + (0 if same else len(b.ids))
            ids = a.ids if same else np.concatenate([a.ids, b.ids])
            keys = a.keys if same else pa.concat_arrays([a.keys, b.keys])
            copies = a.copies if same else np.concatenate([a.copies, b.copies])
            j = j + base
            links = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
            order = np.lexsort((np.array(keys.to_pylist(), dtype=object), ids))
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n)
            roots = order[_roots(n, rank[i], rank[j])][rank]
            rows = np.flatnonzero(links)
            yield pa.record_batch(
                [
                    pa.array(ids[rows], pa.int64()),
                    keys.take(pa.array(rows)),
                    pa.array(np.rint(links[rows]).astype(np.int64)),
                    pa.array(ids[roots[rows]], pa.int64()),
                    keys.take(pa.array(roots[rows])),
                ],
                ["id", "key", "links", "root_id", "root_key"],
            )


def near_duplicates(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.9,
    tile: int = TILE,
) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept)."""
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = stored(base.mapInArrow(_classes, "vec_id long, key binary, raw binary"), "vectors")
    order = F.coalesce("vec_id", F.lit(NO_ID))
    classes = stored(
        rows.where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.min(order).alias("id"), F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw"))
        .withColumn("dims", ((F.length("raw") - 1) / F.when(F.substring("raw", 1, 1) == b"s", 4).otherwise(8)).cast("int")),
        "classes",
    )
    sizes = stored(
        classes.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles")), "sizes"
    )
    packed = stored(
        classes.join(sizes, "dims")
        .withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
        .groupBy("dims", "tiles", "tile")
        .agg(F.collect_list(F.struct("key", "id", "copies", "raw")).alias("rows")),
        "tiles",
    )
    work = sizes.agg(F.sum(F.col("tiles") * (F.col("tiles") + 1) / 2)).first()[0]
    pairs = (
        packed.select(
            "dims", F.col("tile").alias("i"), F.col("rows").alias("a"),
            F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("j"),
        )
        .join(packed.select("dims", F.col("tile").alias("j"), F.col("rows").alias("b")), ["dims", "j"])
        .repartition(max(1, int(work or 1)), "dims", "i", "j")
        .select("i", "j", "a", "b")
    )
    found = stored(
        pairs.mapInArrow(
            lambda b: _products(b, cosine), "id long, key binary, links long, root_id long, root_key binary"
        ),
        "links",
    )
    node = F.struct("id", "key")
    edges = found.select(
        node.alias("u"), F.struct(F.col("root_id").alias("id"), F.col("root_key").alias("key")).alias("v")
    )
    roots = components(edges).select(F.col("node").alias("c"), "root")
    totals = found.groupBy(node.alias("c")).agg(F.sum("links").alias("links"))
    special = (
        classes.select(node.alias("c"), "copies")
        .join(totals, "c", "left")
        .join(roots, "c", "left")
        .where("copies > 1 OR links IS NOT NULL")
        .select(
            F.col("c.key").alias("key"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("root.id", "c.id").alias("to"),
        )
    )
    joined = rows.select("vec_id", "key").join(stored(special, "components"), "key", "left")
    component = F.when(F.col("to").isNull(), F.col("vec_id")).when(F.col("to") != NO_ID, F.col("to"))
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
