"""Packing token sequences into bins of fixed capacity by bin completion.

Texts become token pieces in one pass, whose rows (numbers only) are stored. A piece of full length is a sequence of its own
and isn't moved. The others are dealt by hash into shards of about ``SHARD_PIECES`` pieces; each shard is packed by itself,
so a task holds a bounded number of rows whatever the corpus, and each shard wastes less than one bin when packed
optimally, one in several thousand.

Within a shard, equal lengths are interchangeable, so the search runs over a histogram of lengths: the largest remaining
piece opens a bin, its fillings are enumerated by rising waste, dominated ones (an available larger piece could replace
one or two of the filling's) are skipped, and a branch ends when its waste exceeds what a solution better than the
incumbent may waste. Best-fit decreasing gives the first incumbent. A filling without waste is applied as often as
its lengths last. A first round tries ``BRANCHES`` fillings a bin and ``FILL_NODES`` nodes for those of one sum; a round
that left something out and found nothing is followed by one of four times the width. This ends at the lower bound, when
nothing is left to try, or after ``NODES`` nodes. An incumbent above the bound is then improved in parts: a few of its bins,
the emptiest among them, are completed anew, largest piece first and each by its fullest filling, and the new bins are
taken if they gather the free room in fewer bins. After ``REPAIRS`` such moves the incumbent is the result.
"""

from __future__ import annotations

import json
import random
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helixloom.llm.bpe_codec import byte_characters
from helixloom.llm.shared import SharedTables

CAPACITY = 1024
SHARD_PIECES = 16_384
NODES = 200_000
FILL_NODES = 300
BRANCHES = 4
REPAIRS = 3000
POOL = 16
#: How byte-level vocabularies of this family pick words from text (fixed value).
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of sizes by best-fit decreasing; the open room is kept as a bit mask."""
    bins: list[list[int]] = []
    room: dict[int, list[int]] = {}
    mask = 0
    for s in sorted(sizes, reverse=True):
        fits = mask >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            at = room[r].pop()
            if not room[r]:
                mask &= ~(1 << r)
        else:
            r, at = capacity, len(bins)
            bins.append([])
        bins[at].append(s)
        if r > s:
            room.setdefault(r - s, []).append(at)
            mask |= 1 << (r - s)
    return bins


class Budget:
    """Search nodes left, and how wide the present round searches: fillings tried for a bin, nodes for those of one sum.
    ``cut`` tells that the round left something out."""

    def __init__(self, nodes: int, width: int = 1):
        self.left = nodes
        self.round(width)

    def round(self, width: int) -> None:
        self.branches, self.fill, self.cut = BRANCHES * width, FILL_NODES * width, False


def reachable(counts: list[int], mask: int, room: int) -> int:
    """Bit t is set if some available pieces sum to t <= room."""
    sums, keep = 1, (1 << (room + 1)) - 1
    rest = mask & keep
    while rest:
        s = (rest & -rest).bit_length() - 1
        rest &= rest - 1
        left, n = min(counts[s], room // s), 1
        while left > 0:  # n, 2n, 4n ... copies together reach every number of copies
            n = min(n, left)
            sums |= sums << (s * n) & keep
            left, n = left - n, 2 * n
    return sums


def fillings(counts: list[int], mask: int, room: int, waste: int, budget: Budget) -> Iterator[tuple[int, ...]]:
    """Undominated multisets of available sizes whose sum lies in room-waste .. room, fullest first, large pieces first."""
    sums = None
    target = room
    while target >= max(0, room - waste):
        yield from _exactly(counts, mask, target, room - target, budget)
        if sums is None:
            sums = reachable(counts, mask, room)
        below = sums & ((1 << target) - 1)
        target = below.bit_length() - 1
        if budget.left <= 0:
            budget.cut = True
            return


def _exactly(counts: list[int], mask: int, target: int, spare: int, budget: Budget) -> Iterator[tuple[int, ...]]:
    stack, chosen, nodes, most = [(target, target)], [], 0, min(budget.fill, budget.left)
    while stack:  # depth first: at each depth the next smaller available size is tried
        left, top = stack.pop()
        back = True
        if left == 0:
            if not _dominated(chosen, counts, mask, spare):
                yield tuple(chosen)
        else:
            nodes += 1
            low = mask & ((1 << (min(left, top) + 1)) - 1)
            s = low.bit_length() - 1
            while s > 0 and chosen.count(s) >= counts[s]:
                s = (low & ((1 << s) - 1)).bit_length() - 1
            if s > 0 and nodes <= most:
                back = False
                stack.append((left, s - 1))
                chosen.append(s)
                stack.append((left - s, s))
        if back and chosen and stack:
            chosen.pop()
        if nodes > most:
            budget.cut = True
            break
    budget.left -= nodes


def _dominated(chosen: list[int], counts: list[int], mask: int, spare: int) -> bool:
    fits = mask & ((1 << (spare + 1)) - 2)
    while fits:  # another piece still fits
        x = fits.bit_length() - 1
        if counts[x] > chosen.count(x):
            return True
        fits &= ~(1 << x)
    for i, y in enumerate(chosen):
        if spare and mask >> (y + 1) & ((1 << spare) - 1):
            x = (mask >> (y + 1) & -(mask >> (y + 1))).bit_length() + y
            if counts[x] > chosen.count(x):
                return True
        for z in chosen[:i]:
            if mask >> (y + z) & 1 and counts[y + z] > chosen.count(y + z):
                return True
    return False


def complete(sizes: list[int], capacity: int, bins: int, budget: Budget) -> list[list[int]] | None:
    """A packing into at most ``bins`` bins, or None if the search ended without."""
    counts = [0] * (capacity + 1)
    for s in sizes:
        counts[s] += 1
    mask = sum(1 << s for s, n in enumerate(counts) if n)
    slack = bins * capacity - sum(sizes)
    path: list[tuple[tuple[int, ...], int, int]] = []  # bin, times, slack before
    options: list[Iterator[tuple[int, ...]]] = []

    def use(items, times, sign):
        nonlocal mask
        for s in items:
            counts[s] -= sign * times
            if counts[s]:
                mask |= 1 << s
            else:
                mask &= ~(1 << s)

    while mask:
        if len(options) == len(path):
            top = mask.bit_length() - 1
            use((top,), 1, 1)
            found = list(islice(fillings(counts, mask, capacity - top, min(slack, capacity), budget), budget.branches + 1))
            budget.cut |= len(found) > budget.branches
            options.append(iter([(top, *f) for f in found[: budget.branches]]))
            use((top,), 1, -1)
        bin_ = next(options[-1], None)
        if bin_ is not None:
            lost = capacity - sum(bin_)
            times = min(counts[s] // bin_.count(s) for s in set(bin_)) if lost == 0 else 1
            path.append((bin_, times, slack))
            slack -= lost
            use(bin_, times, 1)
            continue
        options.pop()
        if not path or budget.left <= 0:
            return None
        bin_, times, slack = path.pop()
        use(bin_, times, -1)
    return [list(items) for items, times, _ in path for _ in range(times)]


def lower_bound(sizes: list[int], capacity: int) -> int:
    """The bound L2 of Martello and Toth: for each a, pieces above capacity-a stand alone, other pieces above half need
    a bin each, and what pieces from a to half don't find room for there needs more."""
    counts = np.bincount(sizes, minlength=capacity + 1)
    n, total = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    half, best = capacity // 2, 0
    for a in range(half + 1):
        big, middle = n[-1] - n[capacity - a], n[capacity - a] - n[half]
        room = middle * capacity - (total[capacity - a] - total[half])
        small = total[half] - (total[a - 1] if a else 0)
        best = max(best, int(big + middle + max(0, -(-(small - room) // capacity))))
    return best


def refill(items: list[int], capacity: int) -> list[list[int]]:
    """Bins opened by the largest item left and filled as full as the others allow, by large ones first."""
    out, items = [], sorted(items, reverse=True)
    while items:
        top, *items = items
        room = capacity - top
        keep, fits = (1 << (room + 1)) - 1, [i for i, s in enumerate(items) if s <= room]
        sums = [1]  # bit t of entry k: some of the last k that fit sum to t
        for i in reversed(fits):
            sums.append(sums[-1] | sums[-1] << items[i] & keep)
        left, chosen = sums[-1].bit_length() - 1, set()
        for k, i in enumerate(fits, 2):
            if not left:
                break
            if items[i] <= left and sums[-k] >> (left - items[i]) & 1:
                chosen.add(i)
                left -= items[i]
        out.append([top, *(items[i] for i in chosen)])
        items = [s for i, s in enumerate(items) if i not in chosen]
    return out


def repaired(bins: list[list[int]], capacity: int, bound: int, moves: int = REPAIRS, pool: int = POOL, seed: int = 1) -> list[list[int]]:
    """The packing after ``moves`` completions of ``pool`` of its bins, each taken unless it spreads the free room."""
    rng = random.Random(seed)
    bins, free = [list(b) for b in bins], [capacity - sum(b) for b in bins]
    for _ in range(moves):
        if len(bins) <= bound or len(bins) < 3:
            break
        open_ = [i for i, f in enumerate(free) if f]
        picked = {max(open_, key=free.__getitem__), *rng.sample(open_, min(len(open_), pool // 2))}
        while len(picked) < min(pool, len(bins)):
            picked.add(rng.randrange(len(bins)))
        at = sorted(picked)
        new = refill([s for i in at for s in bins[i]], capacity)
        new += [[]] * (len(at) - len(new))
        if len(new) > len(at) or sum((capacity - sum(b)) ** 2 for b in new) < sum(free[i] ** 2 for i in at):
            continue
        for i, b in zip(at, new, strict=True):
            bins[i], free[i] = b, capacity - sum(b)
        if not all(new):
            bins = [b for b in bins if b]
            free = [capacity - sum(b) for b in bins]
    return bins


def pack(sizes: list[int], capacity: int = CAPACITY, nodes: int = NODES, moves: int = REPAIRS) -> list[list[int]]:
    """Bins of sizes, as few as the search finds."""
    if not sizes:
        return []
    best, budget, bound, width = best_fit(sizes, capacity), Budget(nodes), lower_bound(sizes, capacity), 1
    while len(best) > bound and budget.left > 0:
        better = complete(sizes, capacity, len(best) - 1, budget)
        if better is not None:
            best = better
        elif budget.cut:
            width *= 4
        else:
            break
        budget.round(width)
    return repaired(best, capacity, bound, moves) if budget.left <= 0 else best


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, as the tokenizer file's own library gives them.

    Byte-level files whose ids follow the order of their merges are encoded by the faster rank-based library, which gives
    the same ids; special tokens are cut out of the text first, as the file asks. Other files go to their library, and so
    do texts on which the faster one fails (runs of a million white-space characters and more).
    """

    def __init__(self, spec: str):
        told = json.loads(spec)
        self.spec, self.ranked = spec, None
        self.special = {x["content"]: x["id"] for x in told["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        vocab, merges = told["model"]["vocab"], told["model"]["merges"]
        pairs = ("".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges)
        step = told.get("pre_tokenizer") or {}
        if told.get("normalizer") is None and step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space") and all(vocab[p] == 256 + i for i, p in enumerate(pairs)):
            byte = {c: b for b, c in enumerate(byte_characters())}
            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
            self.ranked = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self) -> Tokenizer:
        library = Tokenizer.from_str(self.spec)
        library.no_truncation()
        library.no_padding()
        return library

    def _plain(self, text: str) -> bytes:
        if self.ranked is not None:
            try:
                return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
            except ValueError:  # the pattern's stack ends at a run of a million white-space characters
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.cut is None or "<" not in text:
            return self._plain(text)
        parts = self.cut.split(text)
        return b"".join([np.array([self.special[p]], "<u4").tobytes() if i % 2 else self._plain(p) for i, p in enumerate(parts)])


@lru_cache(1)
def encoder_of(spec: str) -> Encoder:
    """One encoder a worker, whatever the number of its tasks."""
    return Encoder(spec)


def _pieces(spec, end: int, capacity: int):
    def run(batches):
        encoder, tail, full = encoder_of(spec.value), np.array([end], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, x in enumerate(batch.column(1)):
                ids = encoder.encode(x.as_py() or "") + tail
                at = 0
                first = len(ids) % full or full
                for k in range(-(-len(ids) // full)):
                    stop = first + k * full
                    row.append(i), piece.append(k), start.append(at // 4), length.append((stop - at) // 4), crc.append(zlib.crc32(ids[at:stop]))
                    at = stop
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))], names=["id", "piece", "start", "length", "ids_crc32"])

    return run


def _placed(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        order = np.lexsort((table.column("ids_crc32").to_numpy(), table.column("piece").to_numpy(), table.column("id").to_pandas().fillna(-1).to_numpy()))
        table = table.take(pa.array(order))
        length = table.column("length").to_numpy()
        wait: dict[int, list[int]] = {}
        for i in range(len(length) - 1, -1, -1):
            wait.setdefault(int(length[i]), []).append(i)
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        bins = pack(length.tolist(), capacity)
        for b, items in enumerate(bins):
            at = 0
            for s in items:
                i = wait[s].pop()
                sequence[i], offset[i] = b, at
                at += s
        return table.drop_columns(["shard"]).append_column("sequence_id", pa.array(sequence + (shard << 32))).append_column("offset", pa.array(offset))

    return run


def pack_documents(docs: DataFrame, path: str, end: int = 2, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``<id_col>, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its token ids and ``end``; null and empty texts are ``end`` alone. Only documents longer than
    ``capacity`` are cut; their first piece takes the remainder. Every row of ``docs`` is packed, rows that repeat an id
    or have none too. An empty table gives an empty result; other columns are not read.
    """
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # a tokenizer file, megabytes
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col))
    schema = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    pieces = SharedTables(docs.sparkSession, "pieces").write(rows.mapInArrow(_pieces(spec, end, capacity), schema), "pieces")
    full, short = pieces.where(F.col("length") == capacity), pieces.where(F.col("length") < capacity)
    shards = max(1, -(-short.count() // SHARD_PIECES))
    short = short.withColumn("shard", F.pmod(F.xxhash64("id", "piece", "ids_crc32", F.lit(1)), F.lit(shards)))
    placed = short.groupBy("shard").applyInArrow(_placed(capacity), f"{schema}, sequence_id bigint, offset bigint")
    alone = full.withColumn("sequence_id", F.monotonically_increasing_id() + F.lit(1 << 62)).withColumn("offset", F.lit(0).cast("bigint"))
    return placed.unionByName(alone).withColumnRenamed("id", id_col)
