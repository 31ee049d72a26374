"""Near-duplicate documents: MinHash with banding, signature verification, exact confirmation and components.

Plan (no step holds a whole group in one task, none makes all pairs of a group):

1. One pass over the texts: the set of hashed word shingles and its size, universal-hash minima, band keys, and a 128-bit
   digest of the sequence of lower-cased words.
2. Documents of equal sequences form a class; only its smallest id goes on. The minimum is a partial aggregate.
3. Band buckets with several classes; buckets with the same members count once. Each member is compared with its
   bucket's smallest member: first the sizes, then the signatures (5 standard deviations of slack), then the full sets,
   made anew from both texts under a hash that is independent of the one of step 1, so no single collision makes a link.
4. Components of the confirmed links. In a bucket that still holds several components, the most frequent one is its
   main component, the other members are its strays. Two members of different components still have to meet: strays of a
   bucket meet each other, and the strays of a main component's buckets meet its members in those buckets (once, not
   once for each bucket). Both happen in tiles of bounded blocks (by members and by shingles), twice: first with sizes and
   signatures alone, which return the members that any pair of the tile may link; then with the full sets of these
   members, where intersections of all pairs are one matrix product over the shingles that both blocks have. A tile
   emits a spanning forest of the links across components, never its pairs. So every pair of a bucket is confirmed,
   refuted, or already in one component.
5. Components of all links.

A pair at the threshold shares no bucket with a chance below 1e-7; ``bands_for`` picks the number of bands for that.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixloom.llm.components import connected_components
from helixloom.llm.shared import SharedTables
from helixloom.llm.tiles import map_tiles, with_tiles
from helixloom.llm.words import mix, normal_digests, shingle_hashes, sub_batches, utf8, word_hashes, word_spans

ROWS = 5
MISS = 1e-7
SIGMAS = 5.0
BLOCK_MEMBERS = 256
BLOCK_SHINGLES = 1 << 20
#: Seed of the word hash that confirms; minima use another.
CONFIRM = 2


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands such that a pair at ``similarity`` misses all of them with a chance below ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-(similarity**rows)))


def minima(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """For each universal hash a*x+b mod 2^32 its minimum over the shingles."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 2048):
        np.minimum(out, (factors[:, None] * x[None, lo : lo + 2048] + shifts[:, None]).min(1), out=out)
    return out


def _sketcher(k: int, rows: int, bands: int, seed: int):
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2**32, rows * bands, dtype=np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 2**32, rows * bands, dtype=np.uint32)
    salt = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def sketch(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi, part, offs in sub_batches(data, offsets):
                starts, ends, first = word_spans(part, offs)
                words = word_hashes(part, starts, ends)
                digests = normal_digests(part, starts, ends, first)
                sizes, sigs, keys = [], [], []
                for i in range(hi - lo):
                    s = shingle_hashes(words[first[i] : first[i + 1]], k)
                    sizes.append(len(s))
                    if not len(s):
                        sigs.append(None), keys.append(None)
                        continue
                    m = minima(s, factors, shifts)
                    sigs.append((m & np.uint32(0xFFFF)).astype(np.uint16).tobytes())
                    acc = salt.copy()
                    for r in range(rows):
                        acc = mix(acc ^ m[r::rows].astype(np.uint64))
                    keys.append(acc.view(np.int64))
                flat = [x for x in keys if x is not None]
                lens = np.array([0 if x is None else bands for x in keys])
                keyed = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lens))), pa.int32()), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()), keyed], names=["id", "n", "digest", "sig", "bands"])

    return sketch


def _likely(floor: float, num: int, den: int):
    """Pairs whose sizes and signatures allow the threshold."""

    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            sa, sb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
            ok = (den * np.minimum(na, nb) >= num * np.maximum(na, nb)) & ((sa == sb).mean(1) >= floor)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return keep


def _confirm(k: int, num: int, den: int):
    """Pairs whose full shingle sets reach the threshold, from both texts."""

    def one(batch, name, lo, hi):
        data, offsets = utf8(batch.column(name).slice(lo, hi - lo))
        starts, ends, first = word_spans(data, offsets)
        return word_hashes(data, starts, ends, seed=CONFIRM), first

    def confirm(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for lo in range(0, batch.num_rows, 256):
                hi = min(lo + 256, batch.num_rows)
                (wa, fa), (wb, fb) = one(batch, "text_a", lo, hi), one(batch, "text_b", lo, hi)
                for i in range(hi - lo):
                    left, right = shingle_hashes(wa[fa[i] : fa[i + 1]], k), shingle_hashes(wb[fb[i] : fb[i + 1]], k)
                    both = len(left) + len(right) - len(np.union1d(left, right))
                    ok[lo + i] = den * both >= num * (len(left) + len(right) - both) and both > 0
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return confirm


def _sets(k: int):
    """Shingle sets of whole texts as sorted 64-bit hashes."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi, part, offs in sub_batches(data, offsets):
                starts, ends, first = word_spans(part, offs)
                words = word_hashes(part, starts, ends, seed=CONFIRM)
                body = [shingle_hashes(words[first[i] : first[i + 1]], k).tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(body, pa.binary())], names=["rep", "body"])

    return run


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of the left with all of the right."""
    cols = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float64)
    for lo in range(0, len(cols), width):
        part = cols[lo : lo + width]
        sides = []
        for sets in (left, right):
            m = np.zeros((len(sets), len(part)), np.float32)
            for row, s in zip(m, sets, strict=True):
                s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
                at = np.searchsorted(part, s)
                row[at[part[at] == s]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _maybe(floor: float, num: int, den: int):
    """In one tile: the rows that sizes and signatures let link with a row of the other side and of another component."""

    def tile(table: pa.Table) -> pa.RecordBatch | None:
        comp, side, n = (table.column(c).to_numpy() for c in ("comp", "blk", "n"))
        ti, tj = table.column("ti")[0].as_py(), table.column("tj")[0].as_py()
        ia, ib = np.flatnonzero(side == ti), np.flatnonzero(side == tj)
        if not len(ia) or not len(ib):
            return None
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(len(n), -1)
        hit = np.zeros(len(n), bool)
        for lo in range(0, len(ia), 32):
            a = ia[lo : lo + 32]
            ok = (comp[a][:, None] != comp[ib][None, :]) & (den * np.minimum(n[a][:, None], n[ib][None, :]) >= num * np.maximum(n[a][:, None], n[ib][None, :]))
            r, c = np.nonzero(ok)
            for s in range(0, len(r), 1 << 14):
                p, q = a[r[s : s + (1 << 14)]], ib[c[s : s + (1 << 14)]]
                same = (sigs[p] == sigs[q]).mean(1) >= floor
                hit[p[same]] = hit[q[same]] = True
        table = table.filter(pa.array(hit)).select(["g", "rep", "comp", "blk", "ti", "tj"]).combine_chunks()
        return table.to_batches()[0] if table.num_rows else None

    return tile


def _forest(num: int, den: int):
    """In one tile: links between rows of its two sides that join different components, as a spanning forest."""

    def tile(table: pa.Table) -> pa.RecordBatch | None:
        ids, comp, side = (table.column(c).to_numpy() for c in ("rep", "comp", "blk"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("body").to_pylist()]
        ti, tj = table.column("ti")[0].as_py(), table.column("tj")[0].as_py()
        ia, ib = np.flatnonzero(side == ti), np.flatnonzero(side == tj)
        if not len(ia) or not len(ib):
            return None
        both = shared_counts([sets[i] for i in ia], [sets[i] for i in ib])
        sizes = np.array([len(x) for x in sets])
        total = sizes[ia][:, None] + sizes[ib][None, :] - both
        r, c = np.nonzero((den * both >= num * total) & (both > 0) & (comp[ia][:, None] != comp[ib][None, :]))
        root: dict[int, int] = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        out = []
        for i, j in zip(ia[r].tolist(), ib[c].tolist(), strict=True):
            x, y = find(int(comp[i])), find(int(comp[j]))
            if x != y:
                root[x] = y
                out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return tile


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, num: int = 80, den: int = 100, rows: int = ROWS, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: ``<id_col>, n_shingles, component_id, kept``.

    Documents are linked when ``den * |intersection| >= num * |union|`` of their sets of ``shingle_words``-word shingles
    (words lower-cased A-Z). A shorter document's set is its whole word sequence; null, empty and blank texts have an
    empty set and are linked with nothing. Rows that repeat an id are one node; a row with a null id is linked with
    nothing and has a null component. An empty input gives an empty result; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    store = SharedTables(spark, "minhash")
    bands = bands_for(num / den, rows)
    hashes = rows * bands
    floor = num / den - SIGMAS * math.sqrt(num / den * (1 - num / den) / hashes)
    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sketches = store.write(plain.mapInArrow(_sketcher(shingle_words, rows, bands, seed), "id bigint, n bigint, digest binary, sig binary, bands array<bigint>"), "sketches")
    classes = store.write(sketches.where("n > 0 and id is not null").groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    first = sketches.join(classes, (sketches.id == classes.rep) & (sketches.digest == classes.digest), "left_semi")
    reps = store.write(first.select(F.col("id").alias("rep"), "n", "sig", "bands"), "reps")
    keyed = reps.select("rep", "n", F.explode("bands").alias("h"))
    stats = keyed.groupBy("h").agg(F.count("*").alias("size"), F.min("rep").alias("leader"), F.max("rep").alias("last"), F.expr("bit_xor(xxhash64(rep))").alias("mark"))
    # one bucket for each set of members
    stats = stats.where("leader < last").groupBy("size", "leader", "last", "mark").agg(F.min("h").alias("h"))
    stats = store.write(stats.select("h", "size", "leader"), "buckets")
    members = store.write(keyed.join(stats, "h").select("h", "size", "leader", "rep", "n"), "members")
    sigs, texts = reps.select("rep", "n", "sig"), plain.where("id is not null")

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sigs.toDF("a", "na", "sig_a"), "a").join(sigs.toDF("b", "nb", "sig_b"), "b")
        likely = store.write(both.mapInArrow(_likely(floor, num, den), "a bigint, b bigint").distinct(), "likely")
        both = likely.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
        links = store.write(both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(shingle_words, num, den), "a bigint, b bigint"), "links")
        store.drop(likely)
        return links

    links = confirmed(members.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct())
    comps = connected_components(links, store)

    # buckets that still hold several components
    held = members.where("size > 2").join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("h", "rep", "n", F.coalesce("component", "rep").alias("comp"))
    held = store.write(held, "held")
    main = held.groupBy("h", "comp").agg(F.count("*").alias("k"), F.sum("n").alias("w")).groupBy("h")
    main = main.agg(F.count("*").alias("comps"), F.sum("k").alias("ks"), F.sum("w").alias("ws"), F.max(F.struct("k", "w", F.col("comp").alias("main"))).alias("top"))
    main = store.write(main.where("comps > 1").select("h", "top.main", (F.col("ks") - F.col("top.k")).alias("strays"), (F.col("ws") - F.col("top.w")).alias("weight")), "main")
    held_open = store.write(held.join(main, "h"), "open")
    strays, core = held_open.where("comp <> main"), held_open.where("comp = main")
    sets = held_open.select("rep").distinct().join(texts.toDF("rep", "text"), "rep").select("rep", "text").mapInArrow(_sets(shingle_words), "rep bigint, body binary").dropDuplicates(["rep"])
    sets = store.write(sets, "sets")

    def in_blocks(members, shingles):
        """Members as blocks count them: many, or of many shingles."""
        return F.greatest(members.cast("double"), shingles * (BLOCK_MEMBERS / BLOCK_SHINGLES))

    among = with_tiles(strays.where("strays > 1").select(F.col("h").alias("g"), "rep", "comp", "strays", "weight"), F.col("rep"), in_blocks(F.col("strays"), F.col("weight")), BLOCK_MEMBERS)
    sides = core.select("main", "rep", "comp", "n").distinct().withColumn("side", F.lit(0)).union(strays.select("main", "rep", "comp", "n").distinct().withColumn("side", F.lit(1)))
    sides = store.write(sides, "sides")
    blocks = sides.groupBy("main").agg(*[F.ceil(in_blocks(F.count_if(F.col("side") == i), F.coalesce(F.sum(F.when(F.col("side") == i, F.col("n"))), F.lit(0))) / BLOCK_MEMBERS).cast("int").alias(f"n{i}") for i in (0, 1)])
    meet = sides.drop("n").join(store.write(blocks, "blocks"), "main")
    own, other = (F.when(F.col("side") == 0, F.col(x)).otherwise(F.col(y)) for x, y in (("n0", "n1"), ("n1", "n0")))
    meet = meet.withColumn("blk", F.pmod(F.xxhash64("rep"), own).cast("int") * 2 + F.col("side")).withColumn("x", F.explode(F.sequence(F.lit(0), other - 1))).withColumn("x", F.col("x") * 2 + 1 - F.col("side"))
    meet = meet.select(F.col("main").alias("g"), "rep", "comp", "blk", F.when(F.col("side") == 0, F.col("blk")).otherwise(F.col("x")).alias("ti"), F.when(F.col("side") == 0, F.col("x")).otherwise(F.col("blk")).alias("tj"))
    tile = ["g", "ti", "tj"]
    for name, tiles in (("among", among), ("meet", meet)):
        tiles = tiles.select("g", "rep", "comp", "blk", "ti", "tj").join(sigs, "rep")
        tiles = store.write(map_tiles(tiles, tile, _maybe(floor, num, den), "g bigint, rep bigint, comp bigint, blk int, ti int, tj int"), f"{name}-maybe")
        found = store.write(map_tiles(tiles.join(sets, "rep"), tile, _forest(num, den), "a bigint, b bigint"), name)
        store.drop(tiles)
        links = links.union(found)
    comps = connected_components(links, store)
    store.drop(held, held_open, sets, sides)
    groups = classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    groups = store.write(groups, "groups")
    store.drop(reps, members, stats)
    out = sketches.select("id", "n", "digest").join(groups, "digest", "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
