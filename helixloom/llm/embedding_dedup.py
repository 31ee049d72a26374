"""Near-duplicate embeddings within a label: int8 tile products with error bounds, full precision only where needed.

A vector x of norm 1 is kept as scale * q + e with q in -127..127. For two vectors
|x.y - sx sy qx.qy| <= |ex| |y^| + |x^| |ey| + |ex| |ey| with x^ = sx qx, and these norms are computed for each vector. So a
pair whose upper bound stays below the threshold can't be a link, one whose lower bound reaches it must be one, and only
pairs between the two are recomputed by the cosine in double precision. The products of int8 tiles run as float32 matrix
products, which are exact for these integers up to dimension 1040; longer vectors are multiplied in slices.

Equal vectors of a label are one class with a multiplicity, quantised once. Classes of a label are dealt into blocks of
bounded size; each pair of blocks is a tile. First only codes, scales and norms go to the tiles, an eighth of the vectors'
bytes. A tile returns, for each of its classes, the number of vectors surely linked in this tile, a spanning forest of
these links, and the classes that have an undecided pair. Then only these classes' vectors go to the tile once more, which
decides the pairs. So links are counted without being listed, and no pair is ever written out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixloom.llm.components import connected_components
from helixloom.llm.shared import SharedTables
from helixloom.llm.tiles import map_tiles, with_tiles

BLOCK_VECTORS = 2048
SLICE = 1024


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the coded vectors and of the errors (both rounded up) of unit rows."""
    scale = np.abs(unit).max(1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    up = 1 + 1e-12
    return codes, scale, np.linalg.norm(coded, axis=1) * up, (np.linalg.norm(unit - coded, axis=1) + 1e-15) * up


def bounds(a, b) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of all pairs, and how far off they may be."""
    (qa, sa, na, ea), (qb, sb, nb, eb) = a, b
    dot = np.zeros((len(qa), len(qb)), np.float64)
    for lo in range(0, qa.shape[1], SLICE):
        dot += qa[:, lo : lo + SLICE].astype(np.float32) @ qb[:, lo : lo + SLICE].astype(np.float32).T
    slack = ea[:, None] * nb[None, :] + na[:, None] * eb[None, :] + ea[:, None] * eb[None, :]
    return dot * sa[:, None] * sb[None, :], slack


def possible(a, b, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs whose upper bound on the cosine reaches the threshold, and whether the lower one does too; the margins
    are far above the rounding of either cosine."""
    near, slack = bounds(a, b)
    r, c = np.nonzero(near + slack >= threshold - 1e-12)
    return r, c, near[r, c] - slack[r, c] >= threshold + 1e-9


def _packed(batches):
    """Vectors as float64 bytes; null for those that are null, empty, zero or hold null or non-finite components."""
    for batch in batches:
        body = []
        for values in batch.column("vector"):
            x = values.values.to_numpy(zero_copy_only=False).astype(np.float64) if values.is_valid and not values.values.null_count else np.zeros(0)
            body.append((x + 0.0).tobytes() if np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(body, pa.binary())], names=["id", "label", "body"])


def _unit(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and their norms; vectors beyond the range of squares are scaled first."""
    x = np.stack([np.frombuffer(b, np.float64) for b in bodies])
    norm = np.linalg.norm(x, axis=1)
    big = ~np.isfinite(norm) | (norm < 1e-150)
    if big.any():
        x = np.where(big[:, None], x / np.abs(x).max(1)[:, None], x)
        norm = np.linalg.norm(x, axis=1)
    return x, norm


def _coded(batches):
    """Adds codes, scales and the norms of codes and errors; a batch's vectors are taken by dimension."""
    for batch in batches:
        bodies = batch.column("body").to_pylist()
        codes, numbers = [None] * len(bodies), np.zeros((3, len(bodies)))
        dims = np.array([len(b) for b in bodies])
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            for lo in range(0, len(at), 4096):
                part = at[lo : lo + 4096]
                x, norm = _unit([bodies[i] for i in part])
                q, *rest = quantised(x / norm[:, None])
                numbers[:, part] = rest
                for i, row in zip(part.tolist(), q, strict=True):
                    codes[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary()), *map(pa.array, numbers)], names=[*batch.schema.names, "code", "scale", "norm", "error"])


FOUND = "class bigint, rep bigint, other bigint, links bigint, label bigint, dim int, ti int, tj int, blk int"


def _tile(threshold: float, exact: bool):
    """One pair of blocks: without vectors the sure links and the classes of undecided pairs, with them the undecided pairs."""

    def side(table, at):
        code = table.column("code").to_pylist()
        q = np.stack([np.frombuffer(code[i], np.int8) for i in at])
        return (q, *(table.column(c).to_numpy()[at] for c in ("scale", "norm", "error")))

    def tile(table: pa.Table) -> pa.RecordBatch | None:
        reps, classes, copies, blk = (table.column(c).to_numpy() for c in ("rep", "class", "copies", "blk"))
        label, dim, ti, tj = (table.column(c)[0].as_py() for c in ("label", "dim", "ti", "tj"))
        ia, ib = np.flatnonzero(blk == ti), np.flatnonzero(blk == tj)
        if not len(ia) or not len(ib):
            return None
        qa = side(table, ia)
        qb = qa if ti == tj else side(table, ib)
        if exact:
            x, norm = _unit(table.column("body").to_pylist())
        counts, open_ = np.zeros(len(reps), np.int64), np.zeros(len(reps), bool)
        root = {}

        def find(i):
            while root.setdefault(i, i) != i:
                root[i] = i = root[root[i]]
            return i

        forest = []
        for lo in range(0, len(ia), 512):
            r, c, sure = possible(tuple(v[lo : lo + 512] for v in qa), qb, threshold)
            r = r + lo
            if ti == tj:
                r, c, sure = r[r < c], c[r < c], sure[r < c]
            p, q = ia[r], ib[c]
            if exact:
                p, q = p[~sure], q[~sure]
                linked = np.zeros(len(p), bool)
                for s in range(0, len(p), 1 << 15):
                    i, j = p[s : s + (1 << 15)], q[s : s + (1 << 15)]
                    linked[s : s + (1 << 15)] = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j]) >= threshold
                p, q = p[linked], q[linked]
            else:
                open_[p[~sure]] = open_[q[~sure]] = True
                p, q = p[sure], q[sure]
            np.add.at(counts, p, copies[q])
            np.add.at(counts, q, copies[p])
            for i, j in zip(p.tolist(), q.tolist(), strict=True):
                y, z = find(i), find(j)
                if y != z:
                    root[y] = z
                    forest.append((i, j))
        hit, need, f = np.flatnonzero(counts), np.flatnonzero(open_), np.array(forest, np.int64).reshape(-1, 2)
        at = np.concatenate((hit, f[:, 0], need))
        ask = np.arange(len(at)) >= len(hit) + len(f)
        other = np.concatenate((reps[hit], reps[f[:, 1]], reps[need]))
        n = np.concatenate((counts[hit], np.zeros(len(f) + len(need), np.int64)))
        tile_of = [pa.array(np.full(len(at), v), t, mask=~ask) for v, t in ((label, pa.int64()), (dim, pa.int32()), (ti, pa.int32()), (tj, pa.int32()))]
        return pa.RecordBatch.from_arrays([pa.array(classes[at]), pa.array(reps[at]), pa.array(other), pa.array(n), *tile_of, pa.array(blk[at], pa.int32(), mask=~ask)], names=["class", "rep", "other", "links", "label", "dim", "ti", "tj", "blk"])

    return tile


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, block: int = BLOCK_VECTORS) -> DataFrame:
    """One row per vector: ``<id_col>, n_links, component_id, kept``.

    Vectors with equal, non-null labels and equal dimension are linked when their cosine in double precision is at least
    ``threshold`` (above 0). Vectors that are null, empty, zero or hold null or non-finite components, or whose label or
    id is null, have no links; a null id has a null component. Rows that repeat an id are nodes of one name, and each
    counts as a linked vector. An empty input gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    store = SharedTables(spark, "vectors")
    plain = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).alias("vector"))
    rows = store.write(plain.mapInArrow(_packed, "id bigint, label bigint, body binary"), "rows")
    linkable = F.expr("body is not null and id is not null and label is not null")
    usable = rows.where(linkable).select("id", "label", "body", F.length("body").alias("dim"))
    classes = usable.groupBy("label", "dim", "body").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    schema = "label bigint, dim int, body binary, rep bigint, copies bigint, class bigint"
    classes = store.write(classes.withColumn("class", F.xxhash64("label", "body")).mapInArrow(_coded, f"{schema}, code binary, scale double, norm double, error double"), "classes")
    sizes = store.write(classes.groupBy("label", "dim").agg(F.count("*").alias("size")), "sizes")
    keys = ["label", "dim", "ti", "tj"]
    tiles = with_tiles(classes.drop("body").join(sizes, ["label", "dim"]), F.xxhash64("class", "rep"), F.col("size"), block)
    found = store.write(map_tiles(tiles, keys, _tile(threshold, False), FOUND), "found")
    undecided = found.where("blk is not null").select("class", "rep", "blk", "ti", "tj")
    tiles = undecided.join(classes, ["class", "rep"])
    settled = store.write(map_tiles(tiles, keys, _tile(threshold, True), FOUND), "settled")
    found = found.where("blk is null").unionByName(settled)
    comps = connected_components(found.where("links = 0").select(F.col("rep").alias("a"), F.col("other").alias("b")), store)
    links = found.where("links > 0").groupBy("class", "rep").agg(F.sum("links").alias("links"))
    about = classes.join(links, ["class", "rep"], "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    about = store.write(about.select("label", "body", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "about")
    store.drop(classes, sizes)
    linked = rows.where(linkable).join(about, ["label", "body"]).select("id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(linkable, F.lit(False))).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
