"""Language-model scores from a log-frequency Bloom filter of quantised bigram counts.

Counts are quantised on a log scale; a bigram of level q enters the filter as the events (bigram, 1) .. (bigram, q), so
its level is read back by asking for rising events until one is absent. The filter is blocked: the top bits of a
bigram's hash choose a block and all its events stay there, so blocks are built by independent tasks of even size, also
when one word makes up much of the text, and the filter's size follows the number of distinct bigrams.

The model interpolates: P(w | v) = share * c(v w) / c(v) + (1 - share) * (c(w) + a) / (N + a (V + 1)), with c(v w) from
the filter and the unigram counts exact (64 bits). Where the bigram is absent only the unigram part counts, in full if v
itself was never seen. Levels round counts down, so the bigram shares of a v add up to 1 at most.

Workers get the model by broadcast, in slices whose files they map (one copy an executor, in file pages), while it takes at
most ``broadcast_bytes``. A larger model stays in its parts: the texts are stored in blocks, each block sends its distinct words
and bigrams to the groups of parts that hold them, the groups answer with counts, and the answers meet their block again.
Blocks and groups are bounded. A block asks every group, so the number of questions is the product of both; they are made
large (ASK_BYTES of text, GROUP_BYTES of model) so that a question holds many hashes, and questions are answered together,
each distinct hash once. The driver sees sums over the parts, never a list of them, unless the model is broadcast (at most
MOST_PARTS parts then).
"""

from __future__ import annotations

import math
import mmap
import pickle
import uuid
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixloom.llm.shared import SharedTables
from helixloom.llm.words import mix, sub_batches, utf8, word_hashes, word_spans

END = np.uint64(0xE4D0E4D0E4D0E4D1)
START = np.uint64(0x57A257A257A257A3)
PROBES = 6
BITS_PER_EVENT = 12
BASE = 1.5
LEVELS = np.unique(np.round(BASE ** np.arange(0, 80)).astype(np.float64))
PART_TOKENS = 1 << 19
FLUSH = 3 << 19
BLOCK_BYTES = 1 << 20
ASK_BYTES = 4 << 20
GROUP_BYTES = 8 << 20
ANSWER_KEYS = 1 << 20
MOST_PARTS = 1 << 14
SLICE_BYTES = 32 << 20
MARK = b"\x93helixloom-slice"


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens with one end token after each document, the token before each, and the document bounds."""
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    n = len(offsets) - 1
    bounds = first + np.arange(n + 1)
    tokens = np.empty(len(words) + n, np.uint64)
    last = np.zeros(len(tokens), bool)
    last[bounds[1:] - 1] = True
    tokens[last] = END
    tokens[~last] = words
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = START
    return tokens, before, bounds


def bigram_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9E3779B97F4A7C15) ^ word)


def block_of(grams: np.ndarray, blocks: int) -> np.ndarray:
    return (((grams >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, counts, "right")


def event_positions(grams: np.ndarray, level: int, bits: np.ndarray) -> np.ndarray:
    """PROBES bit positions of the event (n-gram, level) within blocks of ``bits`` bits."""
    a = mix(grams ^ np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
    b = (a >> np.uint64(32)) | np.uint64(1)
    a = a & np.uint64(0xFFFFFFFF)
    return np.stack([((a + b * np.uint64(i)) & np.uint64(0xFFFFFFFF)) * bits >> np.uint64(32) for i in range(PROBES)])


def runs_of(sorted_values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, first, past last) of each run of equal values."""
    if not len(sorted_values):
        return []
    cut = [0, *(np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1).tolist(), len(sorted_values)]
    return [(int(sorted_values[lo]), lo, hi) for lo, hi in zip(cut, cut[1:], strict=False)]


def packed(counts: np.ndarray) -> bytes:
    """Counts in four bytes each, in eight if one of them needs that."""
    return counts.astype("<u4" if counts.max(initial=0) < 1 << 32 else "<i8").tobytes()


def unpacked(body: bytes, n: int) -> np.ndarray:
    return np.frombuffer(body, "<i8" if n and len(body) == 8 * n else "<u4").astype(np.int64)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
    return k[first], (np.add.reduceat(c, first) if len(k) else c)


def _gather(parts: int):
    """Per task: counts of the hashes of tokens (kind 0) and of bigrams (kind 1), packed by part."""

    def pack(kind, keys, counts):
        k, c = _merged(keys, counts)
        for p, lo, hi in runs_of(block_of(k, parts)):
            yield kind, p, k[lo:hi].tobytes(), packed(c[lo:hi])

    def gather(batches):
        held = {0: ([], []), 1: ([], [])}

        def flush(least):
            rows = []
            for kind, (keys, counts) in held.items():
                if keys and sum(map(len, keys)) > least:
                    rows += pack(kind, keys, counts)
                    keys.clear(), counts.clear()
            if rows:
                kinds, ps, ks, cs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(ps, pa.int32()), pa.array(ks, pa.binary()), pa.array(cs, pa.binary())], names=["kind", "part", "keys", "counts"])

        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for _, _, part, offs in sub_batches(data, offsets):
                tokens, before, _ = tokens_of(part, offs)
                for kind, grams in ((0, tokens), (1, bigram_hash(np.where(before == START, END, before), tokens))):
                    k, c = np.unique(grams, return_counts=True)
                    held[kind][0].append(k), held[kind][1].append(c.astype(np.int64))
                yield from flush(FLUSH)
        yield from flush(-1)

    return gather


def _combine(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
    counts = [unpacked(x, len(k)) for x, k in zip(table.column("counts").to_pylist(), keys, strict=True)]
    return _merged(keys, counts)


def _finish(table: pa.Table) -> pa.Table:
    """One part: exact unigram counts, or filter blocks over the part's n-grams."""
    kind, part = table.column("kind")[0].as_py(), table.column("part")[0].as_py()
    keys, counts = _combine(table)
    if kind == 0:
        body, extra, total, size = keys.tobytes(), packed(counts), int(counts.sum()), len(keys)
    else:
        levels = level_of(counts)
        bits = max(64, int(levels.sum()) * BITS_PER_EVENT + 63 & ~63)
        on = np.zeros(bits, bool)
        for q in range(1, int(levels.max(initial=0)) + 1):
            on[event_positions(keys[levels >= q], q, np.uint64(bits)).ravel()] = True
        body, extra, total, size = np.packbits(on, bitorder="little").tobytes(), b"", 0, bits
    return pa.table({"kind": pa.array([kind], pa.int32()), "part": pa.array([part], pa.int32()), "body": pa.array([body], pa.binary()), "extra": pa.array([extra], pa.binary()), "total": pa.array([total], pa.int64()), "size": pa.array([size], pa.int64())})


class Filter:
    """A run of blocks as one byte array."""

    def __init__(self, blocks: int, first: int, bits: np.ndarray, data: np.ndarray):
        self.blocks, self.first, self.bits, self.data = blocks, first, bits, data
        self.offset = np.concatenate(([0], np.cumsum(bits))).astype(np.uint64)

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Quantised counts (0: absent)."""
        return counts_at(self.levels(grams))

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """Levels of counts (0: absent) by repeated probes for rising ones."""
        at = block_of(grams, self.blocks) - self.first
        level = np.zeros(len(grams), np.int64)
        live, q = np.arange(len(grams)), 1
        while len(live) and q <= len(LEVELS):
            pos = event_positions(grams[live], q, self.bits[at[live]].astype(np.uint64)) + self.offset[at[live]]
            hit = np.ones(len(live), bool)
            for p in pos:
                hit &= (self.data[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            live = live[hit]
            level[live] = q
            q += 1
        return level


def counts_at(levels: np.ndarray) -> np.ndarray:
    return np.concatenate(([0.0], LEVELS))[levels]


def exact_counts(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Counts of the wanted hashes in a sorted table, 0 if absent."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[at], 0).astype(np.float64)


class Model:
    """The smoothed probabilities, given counts."""

    def __init__(self, total: int, distinct: int, alpha: float, share: float):
        self.total, self.distinct, self.alpha, self.share = total, distinct, alpha, share

    def sums(self, bounds, c, before, pair) -> list[np.ndarray]:
        """Per document: tokens, known tokens, base score and score, from each token's count, its predecessor's and their pair's."""
        p1 = (c + self.alpha) / (self.total + self.alpha * (self.distinct + 1))
        p2 = np.minimum(pair / np.maximum(before, 1), 1.0)
        both = np.where(before > 0, self.share * p2 + (1 - self.share) * p1, p1)
        per_token = (np.ones(len(c), np.int64), (c > 0).astype(np.int64), np.log10(p1), np.log10(both))
        return [np.add.reduceat(x, bounds[:-1]) for x in per_token]


def _distinct(data, offsets):
    """Bounds of the documents; distinct words and bigrams in order of their hashes; where each token finds its own."""
    tokens, before, bounds = tokens_of(data, offsets)
    before = np.where(before == START, END, before)  # as many texts begin as end
    words, at_word = np.unique(tokens, return_inverse=True)
    grams, at_gram = np.unique(bigram_hash(before, tokens), return_inverse=True)
    return bounds, words, at_word, np.searchsorted(words, before), grams, at_gram


SUMS = ("n_tokens", "n_known", "base_score", "score")


def _empty_sums():
    return [np.zeros(0, np.int64)] * 2 + [np.zeros(0)] * 2


def _scorer(slices: list, parts: int, model: Model):
    def score(batches):
        looks = {kind: [(x.first, x.upto, x.look()) for x in slices if x.kind == kind] for kind in (0, 1)}

        def found(kind, keys):
            out, at = np.zeros(len(keys)), block_of(keys, parts)
            for first, upto, look in looks[kind]:
                lo, hi = np.searchsorted(at, (first, upto))
                out[lo:hi] = look(keys[lo:hi])
            return out

        for batch in batches:
            data, offsets = utf8(batch.column(0))
            out = []
            for _, _, part, offs in sub_batches(data, offsets, BLOCK_BYTES):
                bounds, words, at_word, at_before, grams, at_gram = _distinct(part, offs)
                # a predecessor is a token of the block too, but for the end token, which every document has
                c = found(0, words)
                out.append(model.sums(bounds, c[at_word], c[at_before], found(1, grams)[at_gram]))
            cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else _empty_sums()
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *map(pa.array, cols)], names=[*batch.schema.names[1:], *SUMS])

    return score


def _blocks(batches):
    """Documents of about ASK_BYTES a row."""
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for lo, hi, _, _ in sub_batches(data, offsets, ASK_BYTES):
            cols = [pa.array([batch.column(c).slice(lo, hi - lo).to_pylist()], pa.list_(t)) for c, t in ((0, pa.string()), (1, pa.int64()), (2, pa.bool_()))]
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *cols], names=["block", "texts", "ids", "held"])


def _probes(parts: int, per: int):
    def probe(batches):
        for batch in batches:
            for block, texts in zip(batch.column("block").to_pylist(), batch.column("texts"), strict=True):
                _, words, _, _, grams, _ = _distinct(*utf8(texts.values))
                rows = []
                for kind, keys in ((0, words), (1, grams)):
                    rows += [(kind, g, block, keys[lo:hi].tobytes()) for g, lo, hi in runs_of(block_of(keys, parts) // per)]
                kinds, gs, blocks, keys = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(gs, pa.int32()), pa.array(blocks), pa.array(keys, pa.binary())], names=["kind", "group", "block", "keys"])

    return probe


def _lookup(kind: int, group: int, rows: list, parts: int, per: int):
    """Counts of words (kind 0) or levels of bigrams (kind 1) from a group's stored parts, in order of parts."""
    if kind == 0:
        keys = [np.frombuffer(body, np.uint64) for _, body, _, _ in rows]
        values = [unpacked(extra, len(k)) for (_, _, extra, _), k in zip(rows, keys, strict=True)]
        keys, values = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *values])
        return lambda wanted: exact_counts(keys, values, wanted)
    first = group * per
    held = {part: (size, body) for part, body, _, size in rows}
    of = [held.get(p, (64, bytes(8))) for p in range(first, min(first + per, parts))]
    return Filter(parts, first, np.array([size for size, _ in of]), np.frombuffer(b"".join(body for _, body in of), np.uint8)).levels


def _replies(kind: int, look, asked: list[bytes]):
    """The packed answers to several questions; what they ask in common is looked up once."""
    lo = 0
    while lo < len(asked):
        hi, n = lo + 1, len(asked[lo]) // 8
        while hi < len(asked) and n + len(asked[hi]) // 8 <= ANSWER_KEYS:
            n += len(asked[hi]) // 8
            hi += 1
        distinct, at = np.unique(np.frombuffer(b"".join(asked[lo:hi]), np.uint64), return_inverse=True)
        found = look(distinct).astype(np.int64)[at]
        ends = np.cumsum([len(x) // 8 for x in asked[lo:hi]])
        for x in np.split(found, ends[:-1]):
            yield packed(x) if kind == 0 else x.astype(np.uint8).tobytes()
        lo = hi


def _answers(parts: int, per: int):
    """Answers to all blocks that ask, from rows sorted by group with the model's rows before the questions to it. Rows are
    answered as they come, so a group that every block asks (the most frequent words) takes no more memory than others."""

    def answer(batches):
        at, rows, look = None, [], None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("kind", "group", "block", "keys", "part", "body", "extra", "size")]
            out, replies = [], []
            for key, of in groupby(enumerate(zip(*cols, strict=True)), lambda x: (x[1][0], x[1][1])):
                if at != key:
                    at, rows, look = key, [], None
                asked = []
                for i, (_, _, block, keys, *stored) in of:
                    if block is None:
                        rows.append(stored)
                    else:
                        out.append(i), asked.append(keys)
                if asked and look is None:
                    look, rows = _lookup(*key, rows, parts, per), []
                replies += _replies(key[0], look, asked)
            taken = batch.take(pa.array(out, pa.int64()))
            sizes = pa.array([len(cols[3][i]) // 8 for i in out], pa.int32())
            yield pa.RecordBatch.from_arrays([*(taken.column(c) for c in ("block", "kind", "group")), sizes, pa.array(replies, pa.binary())], names=["block", "kind", "group", "n", "counts"])

    return answer


def _assembled(model: Model):
    """One block's documents with the answers to all its questions, which in order of groups follow its sorted hashes."""

    def assemble(block: pa.Table, answers: pa.Table) -> pa.Table:
        texts = block.column("texts").combine_chunks().values
        bounds, _, at_word, at_before, _, at_gram = _distinct(*utf8(texts))
        answers = answers.sort_by([("kind", "ascending"), ("group", "ascending")])
        rows = list(zip(*(answers.column(c).to_pylist() for c in ("kind", "n", "counts")), strict=True))
        words = np.concatenate([unpacked(x, n) for kind, n, x in rows if kind == 0]).astype(np.float64)
        pairs = counts_at(np.frombuffer(b"".join(x for kind, _, x in rows if kind == 1), np.uint8))
        sums = model.sums(bounds, words[at_word], words[at_before], pairs[at_gram])
        ids, held = (block.column(c).combine_chunks().values for c in ("ids", "held"))
        return pa.table({"id": ids, "held_out": held, **{n: pa.array(x) for n, x in zip(SUMS, sums, strict=True)}})

    return assemble


class Slice:
    """Neighbouring parts of one kind, broadcast as one body of bytes.

    Workers map the file that Spark keeps of a broadcast instead of loading it, so all workers of an executor share one copy,
    in file pages that the system can drop; a file that can't be mapped (encrypted) is loaded.
    """

    def __init__(self, spark, parts: int, kind: int, first: int, upto: int, sizes: list[int], body: bytes):
        self.parts, self.kind, self.first, self.upto, self.sizes = parts, kind, first, upto, np.array(sizes, np.int64)
        at = pickle.dumps(MARK + bytes(len(body) + 1), pickle.HIGHEST_PROTOCOL).index(MARK)
        pad = -(at + len(MARK) + 1) % 8
        self.length = len(body)
        self.sent = spark.sparkContext.broadcast(b"".join((MARK, bytes([pad]), bytes(pad), body)))

    def _body(self):
        try:
            with open(self.sent._path, "rb") as f:
                held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
            at = held.find(MARK, 0, 4096)
            if at < 0 or at + self.length > len(held):
                raise ValueError("not the plain file of a broadcast")
        except (AttributeError, OSError, TypeError, ValueError):
            held, at = self.sent.value, 0
        return held, at + len(MARK) + 1 + held[at + len(MARK)]

    def look(self):
        """A function from sorted hashes to their counts (quantised ones of bigrams)."""
        held, at = self._body()
        if self.kind:
            return Filter(self.parts, self.first, self.sizes, np.frombuffer(held, np.uint8, self.length, at)).counts
        n = self.length // 16
        keys, counts = np.frombuffer(held, np.uint64, n, at), np.frombuffer(held, np.int64, n, at + 8 * n)
        return lambda wanted: exact_counts(keys, counts, wanted)


def _slices(built: DataFrame, parts: int) -> list[Slice]:
    """The stored parts in slices of about SLICE_BYTES; the driver holds one of them at a time."""
    spark, out, held = built.sparkSession, [], []

    def flush(upto):
        kind, first = held[0][0], out[-1].upto if out and out[-1].kind == held[0][0] else 0
        if kind == 0:
            counts = [unpacked(extra, size) for _, _, _, extra, size in held]
            body = b"".join([*(r[2] for r in held), *(c.tobytes() for c in counts)])
            sizes = []
        else:
            of = {part: (size, body) for _, part, body, _, size in held}
            of = [of.get(p, (64, bytes(8))) for p in range(first, upto)]
            sizes, body = [size for size, _ in of], b"".join(x for _, x in of)
        out.append(Slice(spark, parts, kind, first, upto, sizes, body))
        held.clear()

    size = 0
    for r in built.select("kind", "part", "body", "extra", "size").orderBy("kind", "part").toLocalIterator():
        if held and held[0][0] != r.kind:
            flush(parts)
            size = 0
        elif held and size + len(r.body) > SLICE_BYTES:
            flush(r.part)
            size = 0
        held.append((r.kind, r.part, bytes(r.body), bytes(r.extra), r["size"]))
        size += len(r.body) * (1 if r.kind else 2)
    if held:
        flush(parts)
    return out


def workers_of(spark) -> int:
    """Python workers of one executor, at most: its cores, or all cores where the session doesn't say."""
    return int(spark.sparkContext.getConf().get("spark.executor.cores") or spark.sparkContext.defaultParallelism)


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.1, share: float = 0.6, broadcast_bytes: int = 2 << 30) -> DataFrame:
    """Scores every row of ``docs``; learns from the rows where ``held_out`` is false.

    Returns ``<id_col>, held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10 probabilities), one row per
    row. Tokens are words lower-cased (A-Z) plus one end token; null, empty and blank texts are the end token alone. A
    null ``held_out`` (a null id) counts as held out. Nothing to learn from: all counts are 0. Words are counted by 64-bit
    hash. Other columns of ``docs`` are not read; rows that repeat an id are scored each; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    store = SharedTables(spark, "lm")
    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(held_out, F.lit(True)).alias("held_out"), F.col(text_col).alias("text"))
    train = plain.where("not held_out").select("text")
    chars = train.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    parts = 1 << max(0, math.ceil(math.log2(max(1, chars / 6 / PART_TOKENS))))
    gathered = train.mapInArrow(_gather(parts), "kind int, part int, keys binary, counts binary")
    built = gathered.groupBy("kind", "part").applyInArrow(_finish, "kind int, part int, body binary, extra binary, total bigint, size bigint")
    built = store.write(built, "model", lean=True)
    sums = built.agg(F.sum("total").alias("total"), F.sum(F.when(F.col("kind") == 0, F.col("size"))).alias("distinct"), F.sum(F.length("body") + F.length("extra")).alias("bytes")).first()
    total, distinct = sums.total or 0, sums.distinct or 0
    model = Model(total, distinct, alpha, share)
    rows = plain.select("text", "id", "held_out")
    schema = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    copies = workers_of(spark) if spark.sparkContext.getConf().get("spark.io.encryption.enabled", "false") == "true" else 1
    if parts <= MOST_PARTS and (sums.bytes or 0) * copies <= broadcast_bytes:
        out = rows.mapInArrow(_scorer(_slices(built, parts), parts, model), schema)
    else:
        blocks = store.write(rows.mapInArrow(_blocks, "block string, texts array<string>, ids array<bigint>, held array<boolean>"), "blocks", lean=True)
        per = max(1, GROUP_BYTES * 2 * parts // max(1, sums.bytes or 0))
        asked = blocks.select("block", "texts").mapInArrow(_probes(parts, per), "kind int, group int, block string, keys binary")
        stored = built.drop("total").withColumn("group", F.floor(F.col("part") / per).cast("int"))
        both = stored.unionByName(asked, allowMissingColumns=True).repartition("kind", "group").sortWithinPartitions("kind", "group", F.col("block").isNotNull(), "part")
        answers = store.write(both.mapInArrow(_answers(parts, per), "block string, kind int, group int, n int, counts binary"), "answers", lean=True)
        store.drop(built)
        out = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_assembled(model), schema)
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
