"""Per-read transformations: trimming, quality, windows, fragments, pairing, adapters."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixloom.functions.seq import codelength, reverse_complement, zero_pad
from helixloom.operators.ranks import with_rank


def _both(df: DataFrame, seq: Column, qual: Column) -> DataFrame:
    return df.withColumns({"seq": seq, "qual": qual})


def _cut(c: str, start: Column, size: Column) -> Column:
    return F.substring(F.col(c), start, size)


def trim(reads: DataFrame, size: int = 0, final_size: int = 0, end: int = 3, leading_n: bool = False) -> DataFrame:
    """Cuts ``size`` bases off an end, or all but ``final_size``; first any leading N if asked."""
    if leading_n:
        n = F.length("seq") - F.length(F.ltrim(F.col("seq"), F.lit("N")))
        reads = _both(reads, _cut("seq", n + 1, F.length("seq")), _cut("qual", n + 1, F.length("seq")))
    keep = F.greatest(F.lit(0), F.length("seq") - size) if size else F.least(F.lit(final_size), F.length("seq"))
    start = F.lit(1) if end == 3 else F.length("seq") - keep + 1
    return _both(reads, _cut("seq", start, keep), _cut("qual", start, keep))


def trim_poly_tails(reads: DataFrame, repeat: int = 9, least: int = 20, keep_short: bool = False) -> DataFrame:
    """Removes runs of at least ``repeat`` equal bases from both ends, cuts at a run of 31 A or 3 N, turns N into A; reads
    below ``least`` go unless ``keep_short``, and an emptied read becomes A with quality I."""
    s = F.upper("seq")
    head = F.length(s) - F.length(F.regexp_replace(s, f"^([ACGT])\\1{{{repeat - 1},}}|^N+", ""))
    rows = reads.withColumn("_h", head)
    rest = F.substring(s, F.col("_h") + 1, F.length(s))
    tail = F.regexp_replace(rest, f"([ACGT])\\1{{{repeat - 1},}}$|N+$", "")
    a, n = F.instr(tail, "A" * 31), F.instr(tail, "NNN")
    cut = F.when(a > 0, F.substring(tail, F.lit(1), a - 1)).when(n > 0, F.substring(tail, F.lit(1), n - 1)).otherwise(tail)
    rows = rows.withColumn("_c", cut)
    rows = rows.withColumn("qual", F.when(F.col("_c") == "", "I").otherwise(F.substring(F.col("qual"), F.col("_h") + 1, F.length("_c"))))
    rows = rows.withColumn("seq", F.when(F.col("_c") == "", "A").otherwise(F.replace("_c", F.lit("N"), F.lit("A")))).drop("_h", "_c")
    return rows if keep_short else rows.where(F.length("seq") >= least)


def clip_quality(reads: DataFrame, window: int = 4, threshold: int = 5, offset: int = 33) -> DataFrame:
    """Cuts at the first low base of the first window in which at least half of the bases are low, and trailing N; at
    least one base stays. The last window isn't looked at."""
    need = int(window / 2 + 0.5)
    low = F.transform(F.sequence(F.lit(1), F.length("qual")), lambda i: (F.ascii(F.substring(F.col("qual"), i, F.lit(1))) - offset < threshold).cast("int"))
    rows = reads.withColumn("_low", low)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("_low") - window))
    bad = F.filter(starts, lambda i: F.aggregate(F.slice("_low", i, window), F.lit(0), lambda a, x: a + x) >= need)
    at = F.get(bad, F.lit(0))
    first = at + F.array_position(F.slice("_low", at, window), 1).cast("int") - 1
    size = F.when(at.isNull(), F.length("seq")).otherwise(first - 1)
    seq = F.rtrim(F.substring(F.col("seq"), F.lit(1), size), F.lit("N"))
    keep = F.greatest(F.lit(1), F.length(seq))
    return _both(rows, _cut("seq", F.lit(1), keep), _cut("qual", F.lit(1), keep)).drop("_low")


def mask_low_quality(reads: DataFrame, mark: str = "B", replacement: str = "N", threshold: int = 0, find: bool = False) -> DataFrame:
    """Bases under a run of ``mark`` qualities at the end become ``replacement``; with ``find`` all bases from the first
    mark on, whose qualities become marks too. Masked reads with fewer than ``threshold`` bases before that go."""
    first = F.instr("qual", mark)
    kept = F.when(first > 0, first - 1).otherwise(F.length("qual")) if find else F.length(F.rtrim(F.col("qual"), F.lit(mark)))
    rest = F.length("qual") - kept
    masked = _both(reads, F.concat(_cut("seq", F.lit(1), kept), F.repeat(F.lit(replacement), rest)), F.concat(_cut("qual", F.lit(1), kept), F.repeat(F.lit(mark), rest)))
    return masked if not threshold else masked.where((F.length(F.rtrim(F.col("qual"), F.lit(mark))) >= threshold) | ~F.col("qual").endswith(mark))


def least_quality(reads: DataFrame) -> str:
    """The least quality character of all reads, F without any (one value reaches the driver)."""
    low = reads.where("qual <> ''").select(F.min(F.array_min(F.split("qual", ""))).alias("m")).first()["m"]
    return low or "F"


def pad(reads: DataFrame, size: int, base: str = "N", quality: str | None = None) -> DataFrame:
    """P5: padded or cut to one size; qualities by ``quality``, the least one of the reads if none is given."""
    return _both(reads, F.rpad("seq", size, base), F.rpad("qual", size, quality or least_quality(reads)))


def windows(reads: DataFrame, width: int, step: int) -> DataFrame:
    """One row per window of a read, with the same id."""
    last = F.length("seq") - width
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    rows = reads.withColumn("at", F.explode(starts))
    return _both(rows, _cut("seq", F.col("at") + 1, F.lit(width)), _cut("qual", F.col("at") + 1, F.lit(width)))


def half_pairs(reads: DataFrame, anchor: int = 22) -> DataFrame:
    """P8, for single reads: frag, seq_1, qual_1, seq_2, qual_2 with the read's first half and ``anchor`` bases more, and the same
    of its reverse complement."""
    half = F.ceil(F.length("seq") / 2).cast("int") + anchor
    frag = F.regexp_replace("read_id", "/[12]$", "")
    back = reverse_complement("seq")
    cut = lambda x: F.substring(x, F.lit(1), half)
    return reads.select(frag.alias("frag"), cut(F.col("seq")).alias("seq_1"), cut(F.col("qual")).alias("qual_1"), cut(back).alias("seq_2"), cut(F.reverse("qual")).alias("qual_2"))


def fragment_pairs(pairs: DataFrame, width: int = 82, step: int = 60, anchors: int = 4, wiggle_end: int = 16, skip: int = 0, single: bool = False) -> DataFrame:
    """Windows of mate 1 against the first ``anchors`` windows of mate 2, then the first ones of mate 1 against the other
    windows of mate 2: read_id (NN_id, from 00), seq_1, seq_2 and qualities if ``pairs`` (frag, seq_1, seq_2) has them.

    Windows end at ``width`` and every ``step`` bases on, and at the end of a mate if ``wiggle_end`` bases or more (any, with
    ``single``) are left there; a mate up to ``width`` is one window. Windows and mates below ``skip`` are left out.
    """

    def ends(c: str) -> Column:
        n = F.length(c)
        every = F.sequence(F.lit(width), F.greatest(F.lit(width), n - 1), F.lit(step))
        rest = F.lit(True) if single else n - F.element_at(every, -1) >= wiggle_end
        return F.when(n <= width, F.array(n)).when(rest, F.concat(every, F.array(n))).otherwise(every)

    rows = pairs.where((F.length("seq_1") >= skip) & (F.length("seq_2") >= skip))
    rows = rows.select("*", F.posexplode(ends("seq_1")).alias("i", "a")).select("*", F.posexplode(ends("seq_2")).alias("j", "b")).where((F.col("i") < anchors) | (F.col("j") < anchors))
    late = F.col("j") >= anchors
    cut = lambda c, end: _cut(c, F.greatest(F.lit(0), F.col(end) - width) + 1, F.least(F.col(end), F.lit(width)))
    names = [(c, e) for c, e in (("seq_1", "a"), ("qual_1", "a"), ("seq_2", "b"), ("qual_2", "b")) if c in pairs.columns]
    rows = rows.select("frag", "i", "j", late.alias("late"), *[cut(c, e).alias(c) for c, e in names]).where((F.length("seq_1") >= skip) & (F.length("seq_2") >= skip))
    order = Window.partitionBy("frag").orderBy("late", F.when(F.col("late"), F.col("i")).otherwise(F.col("j")), F.when(F.col("late"), F.col("j")).otherwise(F.col("i")))
    n = F.row_number().over(order) - 1
    return rows.select(F.concat(zero_pad(n, 2), F.lit("_"), "frag").alias("read_id"), *[c for c, _ in names])


def split_at(reads: DataFrame, cuts: DataFrame, wiggle: int = 0, gap: int = 0, anchor: int = 15, reverse_second: bool = False, anchor_max: int = 500) -> DataFrame:
    """Two parts per cut: read_id __NNa / __NNb (from 00), seq, qual. ``cuts``: read_id, cut, the last base of part one,
    from 0.

    Each cut stands for those within ``wiggle`` too, in rising order. With a ``gap`` parts keep 1 to ``gap`` bases between
    them, before and after the cut, and none without a gap. Part one has ``anchor`` bases at least, part two two fewer (one
    fewer after a gap behind the cut). If a part is longer than ``anchor_max``, a copy follows with part one's last, else part
    two's first ``anchor_max`` bases.
    """
    wanted = cuts.select("read_id", F.explode(F.sequence(F.col("cut") - wiggle, F.col("cut") + wiggle)).alias("c")).groupBy("read_id").agg(F.array_sort(F.collect_set("c")).alias("_cuts"))
    n = F.length("seq")
    place = lambda a, b, least: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), (b + least <= n).alias("ok"))
    plain = F.transform("_cuts", lambda c: place(c + 1, c + 1, anchor - 2))
    gaps = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(max(1, gap))), lambda g: F.flatten(F.transform("_cuts", lambda c: F.array(place(c + 1 - g, c + 1, anchor - 2), place(c + 1, c + 1 + g, anchor - 1))))))
    good = F.filter(gaps if gap else plain, lambda p: p["ok"] & (p["a"] >= anchor))
    parts = F.array_distinct(F.transform(good, lambda p: F.struct(F.lit(0).alias("from"), p["a"].alias("a"), p["b"].alias("b"), n.alias("to"))))

    def copies(p: Column) -> Column:
        long = F.when(p["a"] > anchor_max, F.struct((p["a"] - anchor_max).alias("from"), p["a"].alias("a"), p["b"].alias("b"), p["to"].alias("to")))
        long = long.when(p["to"] - p["b"] >= anchor_max, F.struct(p["from"].alias("from"), p["a"].alias("a"), p["b"].alias("b"), (p["b"] + anchor_max).alias("to")))
        return F.filter(F.array(p, long), lambda x: x.isNotNull())

    rows = reads.join(wanted, "read_id").select("read_id", "seq", "qual", F.posexplode(F.flatten(F.transform(parts, copies))).alias("i", "p"))
    piece = lambda c, a, b: _cut(c, F.col(a) + 1, F.col(b) - F.col(a))
    second = piece("seq", "p.b", "p.to"), piece("qual", "p.b", "p.to")
    if reverse_second:
        second = reverse_complement(second[0]), F.reverse(second[1])
    both = F.array(F.struct(F.lit("a").alias("x"), piece("seq", "p.from", "p.a").alias("seq"), piece("qual", "p.from", "p.a").alias("qual")), F.struct(F.lit("b").alias("x"), second[0].alias("seq"), second[1].alias("qual")))
    return rows.select(F.concat("read_id", F.lit("__"), zero_pad(F.col("i"), 2)).alias("n"), F.explode(both).alias("r")).select(F.concat("n", "r.x").alias("read_id"), "r.seq", "r.qual")


def phred_format(reads: DataFrame) -> str:
    """Sanger, solexa or illumina, by the least quality character of all reads (one number reaches the driver)."""
    low = ord(least_quality(reads))
    return "sanger" if low < 59 else "solexa" if low < 64 else "illumina"


def phred_offset(reads: DataFrame) -> int:
    """33 or 64, by the least quality character of all reads."""
    return 33 if phred_format(reads) == "sanger" else 64


#: Offset and least score of the quality formats (fixed values).
FORMATS = {"sanger": (33, 0), "solexa": (64, -5), "illumina": (64, 0), "illumina-1.5": (64, 0)}


def converted_score(score: int, source: str, target: str) -> int:
    """A score in the scale of another format: Solexa scores are odds of an error, the others probabilities."""
    if (source == "solexa") == (target == "solexa"):
        return score
    if target == "solexa":
        return max(-5, round(10 * math.log10(10 ** (score / 10) - 1))) if score > 0 else -5
    return round(10 * math.log10(10 ** (score / 10) + 1))


def convert_quality(reads: DataFrame, source: str | int, target: str | int) -> DataFrame:
    """Quality characters from one format to another (or between the offsets 33 and 64); scores below the target's least
    become that. In illumina-1.5 the two least scores are written as B."""
    source, target = ({33: "sanger", 64: "illumina"}.get(x, x) for x in (source, target))
    (from_, _), (to, least) = FORMATS[source], FORMATS[target]
    chars = [chr(c) for c in range(33, 127)]
    moved = [chr(min(126, to + max(least, converted_score(ord(c) - from_, source, target)))) for c in chars]
    if target == "illumina-1.5":
        moved = ["B" if c in "@A" else c for c in moved]
    return reads.withColumn("qual", F.translate("qual", "".join(chars), "".join(moved)))


def convert_headers(reads: DataFrame, drop_failed: bool = True) -> DataFrame:
    """'id 1:Y:...' becomes id/1; reads marked Y are dropped."""
    rows = reads.where(~F.col("read_id").rlike(r"\s[12]:Y:")) if drop_failed else reads
    return rows.withColumn("read_id", F.regexp_replace("read_id", r"\s+([12]):.*$", "/$1"))


def shorten_failed(reads: DataFrame) -> DataFrame:
    """reads marked as failed keep one base; the header's comment goes."""
    bad = F.col("read_id").rlike(r"\s[12]:Y:")
    rows = _both(reads.withColumn("_b", bad), F.when(bad, F.left("seq", F.lit(1))).otherwise(F.col("seq")), F.when(bad, F.left("qual", F.lit(1))).otherwise(F.col("qual")))
    return rows.withColumn("read_id", F.regexp_replace("read_id", r"\s.*$", "")).drop("_b")


def long_reads(reads: DataFrame, least: int) -> DataFrame:
    """F18."""
    return reads.where(F.length("seq") >= least)


def long_pairs(pairs: DataFrame, least: int = 25) -> DataFrame:
    """F19."""
    return pairs.where((F.length("seq_1") > least - 1) & (F.length("seq_2") > least - 1))


def drop_complete_pairs(reads: DataFrame, keep: DataFrame) -> DataFrame:
    """drops both mates of complete fragments, but for fragments in ``keep``."""
    frag = F.expr("left(read_id, length(read_id) - 2)")
    rows = reads.withColumn("frag", frag)
    whole = rows.groupBy("frag").agg(F.count("*").alias("n")).where("n = 2").select("frag").join(keep.select("frag"), "frag", "left_anti")
    return rows.join(whole, "frag", "left_anti").drop("frag")


def drop_repeats(reads: DataFrame, threshold: float = 1.4, window: int = 24, k: int = 2) -> tuple[DataFrame, DataFrame]:
    """reads whose least window entropy exceeds ``threshold``, and the repetitive others."""
    rows = reads.withColumn("entropy", codelength("seq", window, k))
    rich = F.coalesce(F.col("entropy") > threshold, F.lit(False))
    return rows.where(rich), rows.where(~rich)


def short_ids(reads: DataFrame) -> DataFrame:
    """Ids by rank of the fragment in base 36, mate kept; as wide as half of the reads and ten more need."""
    frag = F.expr("left(read_id, length(read_id) - 2)")
    total = max(1, reads.count())
    width = max(1, math.ceil(round(math.log((total + 10) / 2, 36), 9)))
    ranked = with_rank(reads.select(frag.alias("frag")).distinct(), "frag", "_r")
    ids = ranked.select("frag", zero_pad(F.conv(F.col("_r").cast("string"), 10, 36), width).alias("code"))
    rows = reads.withColumn("frag", frag).join(ids, "frag")
    return rows.withColumn("read_id", F.concat("code", F.right("read_id", F.lit(2)))).drop("frag", "code")


def simulated_reads(sequences: DataFrame, step: int = 1, gap: int = 50, length: int = 100) -> DataFrame:
    """Read pairs tiled over sequences; mate 2 is reverse-complemented."""
    last = F.length("seq") - (2 * length + gap)
    rows = sequences.where(last >= 0).withColumn("at", F.explode(F.sequence(F.lit(0), last, F.lit(step))))
    return rows.select(F.concat("id", F.lit("_"), "at").alias("frag"), _cut("seq", F.col("at") + 1, F.lit(length)).alias("seq_1"), reverse_complement(_cut("seq", F.col("at") + length + gap + 1, F.lit(length))).alias("seq_2"))


def _matrix(texts: pd.Series, width: int, fill: int) -> np.ndarray:
    """Sequences as rows of bytes, filled to one width."""
    data = b"".join(x.encode("ascii", "replace").ljust(width, bytes([fill])) for x in texts)
    return np.frombuffer(data, np.uint8).reshape(len(texts), width)


#: Distances of a seed's end from the end of its sequence (fixed values).
SEED_ENDS = (1, 10, 20, 30)


def _first_place(seeds: np.ndarray, target: np.ndarray, rows: np.ndarray, begin: int, end: int) -> np.ndarray:
    """For each of ``rows`` the first place of its seed in target[begin:end], -1 if there is none."""
    out, size = np.full(len(seeds), -1), seeds.shape[1]
    for p in range(begin, end - size + 1):
        if not len(rows):
            break
        hit = (target[rows, p : p + size] == seeds[rows]).all(1)
        out[rows[hit]] = p
        rows = rows[~hit]
    return out


def _plain_seeds(seeds: np.ndarray) -> np.ndarray:
    """Seeds without N and . that aren't one base throughout."""
    return ~((seeds == ord("N")) | (seeds == ord("."))).any(1) & (seeds != seeds[:, :1]).any(1)


def _groups(a: pd.Series, b: pd.Series):
    """Rows of equal lengths, a few thousand at once, and their sequences as rows of bytes."""
    sizes = pd.DataFrame({"a": a.str.len().to_numpy(), "b": b.str.len().to_numpy()})
    for (la, lb), rows in sizes.groupby(["a", "b"]).indices.items():
        for lo in range(0, len(rows), 4096):
            part = rows[lo : lo + 4096]
            yield part, _matrix(a.iloc[part], la, 0), _matrix(b.iloc[part], lb, 1)


def mate_shifts(a: pd.Series, b: pd.Series, most: float, seed: int, wiggle: int, both: bool, log_reject: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per pair: found, how far b begins behind a, mismatches (two N are one).

    The first seed of a, from SEED_ENDS, that occurs in b (but for its last ``wiggle`` bases) lays b on a. The pair is found
    if mismatches are at most a share ``most`` of what lies together, and, with ``log_reject`` and more than 50 bases, at most
    two more than the log2 of it. With ``both`` the other pairs are tried by seeds of b in a. Equal sequences are found.
    """
    found, shift, mism = np.zeros(len(a), bool), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for part, x, y in _groups(a, b):
        la, lb = x.shape[1], y.shape[1]
        same = (x == y).all(1) if la == lb else np.zeros(len(part), bool)
        found[part[same]] = True
        for source, target, sign in ((x, y, 1), (y, x, -1)) if both else ((x, y, 1),):
            rest = np.flatnonzero(~found[part])
            n = source.shape[1]
            for back in SEED_ENDS:
                lo, hi = n - seed - back, n - back
                if lo < 0 or not len(rest):
                    continue
                seeds = source[:, lo:hi]
                at = _first_place(seeds, target, rest[_plain_seeds(seeds[rest])], 0, target.shape[1] - wiggle)
                hit = rest[at[rest] >= 0]
                rest = rest[at[rest] < 0]
                for d in np.unique(lo - at[hit]):
                    rows = hit[lo - at[hit] == d]
                    s = sign * int(d)
                    size = min(la - max(s, 0), lb - max(-s, 0))
                    u, v = x[rows, max(s, 0) : max(s, 0) + size], y[rows, max(-s, 0) : max(-s, 0) + size]
                    miss = ((u != v) | ((u == ord("N")) & (v == ord("N")))).sum(1)
                    ok = miss <= most * size
                    if log_reject and size > 50:
                        ok &= miss - 2 <= math.log2(size)
                    found[part[rows[ok]]], shift[part[rows[ok]]], mism[part[rows[ok]]] = True, s, miss[ok]
    return found, shift, mism


def mate_overlaps(pairs: DataFrame, most: float = 0.3, seed: int = 13, wiggle: int = 2, both: bool = True, log_reject: bool = False) -> DataFrame:
    """Adds fragment, the length that seq_1 and the reverse complement of seq_2 span together, shift, how far the second
    begins behind the first, and mismatches; all null for pairs that don't overlap."""

    @F.pandas_udf("shift int, mismatches int")
    def laid(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        found, shift, mism = mate_shifts(a.fillna(""), b.fillna(""), most, seed, wiggle, both, log_reject)
        return pd.DataFrame({c: pd.Series(v).where(pd.Series(found)).astype("Int32") for c, v in (("shift", shift), ("mismatches", mism))})

    rows = pairs.withColumn("_m", laid("seq_1", reverse_complement("seq_2", keep_n=True)))
    return rows.withColumns({"fragment": F.col("_m.shift") + F.length("seq_2"), "shift": F.col("_m.shift"), "mismatches": F.col("_m.mismatches")}).drop("_m")


def merge_mates(pairs: DataFrame, most: float = 0.1, seed: int = 11) -> DataFrame:
    """Adds merged, the fragment's sequence, and merged_qual if ``pairs`` has qual_1 and qual_2; null for mates that don't
    overlap. Mate 1 counts where both have a base, and is merged as it is if mate 2 ends inside it; of a fragment shorter
    than mate 1 whose mate 2 begins before it, the fragment's bases of mate 1 stay."""
    rows = mate_overlaps(pairs, most, seed, 1, both=False, log_reject=True)
    n, f = F.length("seq_1"), F.col("fragment")

    def whole(first: Column, second: Column) -> Column:
        return F.when(F.col("shift") < 0, F.substring(first, F.lit(1), f)).when(n < f, F.concat(first, F.right(second, f - n))).when(f.isNotNull(), first)

    rows = rows.withColumn("merged", whole(F.col("seq_1"), reverse_complement("seq_2", keep_n=True)))
    return rows.withColumn("merged_qual", whole(F.col("qual_1"), F.reverse("qual_2"))) if {"qual_1", "qual_2"} <= set(pairs.columns) else rows


def fragment_histogram(overlaps: DataFrame, read_length: int) -> tuple[DataFrame, DataFrame]:
    """Counts per fragment length (column fragment) with share and running share; the mode (the largest of equals) and
    the bases read twice by two mates of ``read_length``."""
    counts = overlaps.where("fragment is not null").groupBy("fragment").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    shares = counts.select("fragment", "n", F.round(100 * F.col("n") / total, 6).alias("share"), F.round(100 * F.sum("n").over(Window.orderBy("fragment")) / total, 6).alias("running"))
    about = counts.agg(F.max(F.struct("n", "fragment")).alias("m"), F.sum((2 * read_length - F.col("fragment")) * F.col("n")).alias("wasted")).select(F.col("m.fragment").alias("mode"), "wasted")
    return shares, about


def flanks(a: pd.Series, b: pd.Series, k: int = 13) -> tuple[list[str], list[str]]:
    """Per pair of a mate and the other's reverse complement that read past each other: the ``k`` bases behind the fragment in a,
    and those before it in b, empty if there aren't as many.

    Seeds of ``k`` bases of b are tried from its end, every seven bases in its last quarter. One that occurs in a, more to the
    left, lays them on each other; with mismatches in less than a fifth of the bases the next one is tried. Bases of N count
    as mismatches too if they are above three tenths.
    """
    behind, before = [""] * len(a), [""] * len(a)
    for part, x, y in _groups(a, b):
        la, lb = x.shape[1], y.shape[1]
        rest = np.arange(len(part))
        for back in range(3, lb // 4, 7):
            lo = lb - k - back
            if lo < 0 or not len(rest):
                break
            at = _first_place(y[:, lo : lo + k], x, rest, 2, la)
            for i in rest[(at[rest] >= 0) & (at[rest] < lo)]:
                s, size = lo - at[i], min(at[i] + lb - lo, la)
                u, v = x[i, : min(size, lb - s)], y[i, s : s + min(size, lb - s)]
                unknown = (u == ord("N")) | (v == ord("N"))
                miss = ((u != v) | ((u == ord("N")) & (v == ord("N")))).sum()
                if unknown.sum() > 0.3 * size:
                    miss += unknown.sum()
                if 0 < miss < 0.2 * size and size != la:
                    continue
                row = part[i]
                if la - size >= k:
                    behind[row] = a.iloc[row][size : size + k]
                if s >= k:
                    before[row] = b.iloc[row][s - k : s]
                at[i] = -2
            rest = rest[at[rest] != -2]
    return behind, before


def adapters(pairs: DataFrame, k: int = 13, share: float = 0.0001, first: int = 3_000_000) -> tuple[str | None, str | None]:
    """The adapters at the 3' and the 5' end: the most frequent k-mers behind and before the fragments of the first
    ``first`` pairs (a fixed sample size of the method, in order of frag); ties by the greater k-mer; None below the share.
    K-mers of at most two bases and repetitive ones (S10) don't count."""

    @F.pandas_udf("behind string, before string")
    def cut(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        behind, before = flanks(a.fillna(""), b.fillna(""), k)
        return pd.DataFrame({"behind": behind, "before": before})

    mers = pairs.orderBy("frag").limit(first).select(cut("seq_1", reverse_complement("seq_2", keep_n=True)).alias("m"))
    rows = mers.select(F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("m.behind").alias("mer")), F.struct(F.lit(1).alias("side"), F.col("m.before").alias("mer")))).alias("r")).select("r.*")
    good = rows.where("mer <> ''").where(F.size(F.array_distinct(F.split("mer", ""))) > 2).where(no_repeats(F.col("mer")))
    top = good.groupBy("side", "mer").agg(F.count("*").alias("n")).groupBy("side").agg(F.max(F.struct("n", "mer")).alias("t"))
    best = {r.side: r.t.mer for r in top.collect() if r.t.n > share * first}
    return best.get(0), best.get(1)


def trim_adapter(reads: DataFrame, adapter_seq: str, mismatches: float = 0.3, least: int = 10, shortest: int = 20) -> DataFrame:
    """Cuts a read where the adapter begins, allowing mismatches; what is shorter than ``shortest`` becomes one N."""
    pattern = np.frombuffer(adapter_seq.encode(), np.uint8)

    @F.pandas_udf("int")
    def start(seqs: pd.Series) -> pd.Series:
        seqs = seqs.fillna("")
        sizes = seqs.str.len().to_numpy()
        out = sizes.astype(np.int32)
        for size in np.unique(sizes):  # reads of one length at once
            rows = np.flatnonzero(sizes == size)
            x, open_ = _matrix(seqs.iloc[rows], int(size), 0), np.arange(len(rows))
            for i in range(max(0, size - least + 1)):
                n = min(len(pattern), size - i)
                if not len(open_) or n < least:
                    break
                hit = (x[open_, i : i + n] != pattern[:n]).sum(1) <= mismatches * n
                out[rows[open_[hit]]] = i
                open_ = open_[~hit]
        return pd.Series(out)

    rows = reads.withColumn("_n", start("seq"))
    short = F.col("_n") < shortest
    return _both(rows, F.when(short, "N").otherwise(_cut("seq", F.lit(1), F.col("_n"))), F.when(short, "I").otherwise(_cut("qual", F.lit(1), F.col("_n")))).drop("_n")


def interleave(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records of two files by ordinal, mate 1 before mate 2."""
    return first.withColumn("mate", F.lit(1)).unionByName(second.withColumn("mate", F.lit(2))).orderBy("ord", "mate")


def read_lengths(reads: DataFrame) -> DataFrame:
    """distinct lengths, longest first, with counts."""
    return reads.groupBy(F.length("seq").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("length"))


def deinterleave(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records of even and of odd ordinals."""
    return reads.where("ord % 2 = 0"), reads.where("ord % 2 = 1")


def no_repeats(seq: Column, share: float = 0.30) -> Column:
    """No pair of neighbouring bases makes up ``share`` or more of all such pairs; true without a pair."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(seq) - 1)), lambda i: F.substring(seq, i, F.lit(2)))
    most = F.array_max(F.transform(F.array_distinct(pairs), lambda p: F.size(F.filter(pairs, lambda x: x == p))))
    return (F.length(seq) < 2) | (most < (F.length(seq) - 1) * F.lit(share))
