"""Scalar functions over sequences, ids and symbols, as column expressions."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The standard genetic code (fixed values): codons in the order of bases T, C, A, G.
BASES = "TCAG"
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reverse_complement(seq: Column | str, keep_n: bool = False) -> Column:
    """The reverse complement of an upper-cased sequence; N becomes A unless ``keep_n``."""
    return F.reverse(F.translate(F.upper(_c(seq)), "ACGTN", "TGCAN" if keep_n else "TGCAA"))


def pair_low(a: Column | str, b: Column | str) -> Column:
    return F.least(_c(a), _c(b))


def pair_high(a: Column | str, b: Column | str) -> Column:
    return F.greatest(_c(a), _c(b))


def flip_mate(read_id: Column | str) -> Column:
    """S3: .../1 and .../2 swapped."""
    r = _c(read_id)
    stem, last = F.substring(r, F.lit(1), F.length(r) - 1), F.right(r, F.lit(1))
    return F.concat(stem, F.when(last == "1", "2").otherwise("1"))


def mismatches(column: Column | str) -> Column:
    """Number of pos:a>b entries."""
    c = _c(column)
    return F.length(c) - F.length(F.replace(c, F.lit(":"), F.lit("")))


def junction_star(seq: Column | str, at: Column) -> Column:
    """The sequence with * after ``at`` bases."""
    s = _c(seq)
    return F.concat(F.substring(s, F.lit(1), at), F.lit("*"), F.substring(s, at + 1, F.length(s)))


def junction_window(seq: Column | str, window: int = 30) -> Column:
    """The window around the only *, upper-cased; empty if there isn't exactly one."""
    parts = F.split(_c(seq), r"\*")
    key = F.concat(F.right(F.get(parts, F.lit(0)), F.lit(window)), F.lit("*"), F.left(F.get(parts, F.lit(1)), F.lit(window)))
    return F.when(F.size(parts) == 2, F.upper(key)).otherwise("")


def similar_symbols(a: Column, b: Column) -> Column:
    """Equal, equal without a last part of one or two characters after . - or _, or equal without -as<N> / -it<N>."""

    def cut(x: Column, n: int) -> Column:
        return F.substring(x, F.lit(1), F.length(x) - n)

    def mark(x: Column, n: int) -> Column:
        return F.substring(x, F.length(x) - n + 1, F.lit(1)).isin(".", "-", "_")

    long = (F.length(a) > 3) & (F.length(b) > 3)
    short = F.lit(False)
    for i in (1, 2):
        short = short | (mark(a, i) & ((cut(a, i) == b) | (cut(a, i) == cut(b, 1)) | (cut(a, i) == cut(b, 2))))
        short = short | (mark(b, i) & (cut(b, i) == a))
    bare = lambda x: F.regexp_replace(F.lower(x), "-(as|it)[0-9]+$", "")
    return (a == b) | (long & short) | (bare(a) == bare(b))


def is_znf(symbol: Column | str) -> Column:
    """S8."""
    return _c(symbol).rlike(r"^ZNF\s*[+-]?\d+\s*$")


def is_poly(seq: Column | str) -> Column:
    """One base throughout."""
    return _c(seq).rlike(r"^(.)\1*$")


def zero_pad(x: Column | str, width: int) -> Column:
    """Padded on the left, never cut."""
    s = _c(x).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def base36(n: Column | str, width: int) -> Column:
    """A number in base 36, padded."""
    return zero_pad(F.conv(_c(n).cast("string"), 10, 36), width)


def clean_description(text: Column | str) -> Column:
    """Lower case, without bracketed parts, cut before the word pseudogene."""
    out = F.regexp_replace(F.lower(_c(text)), r"\[[^\]]*\]|\([^)]*\)", "")
    return F.trim(F.regexp_replace(out, "pseudogene.*$", ""))


def pair_symbols(text: Column | str) -> Column:
    """Upper-cased parts of A--B, A::B, A->B, A---B or A|B."""
    return F.transform(F.split(F.regexp_replace(F.upper(_c(text)), "[\"']", ""), r"---|--|::|->|\|"), lambda x: F.trim(x))


def window_entropy(seq: str, window: int, k: int) -> float | None:
    """The least entropy (bits) of the k-mers of any window of an upper-case sequence; None below k bases."""
    n = min(len(seq), window)
    total = n - k + 1
    if total < 1:
        return None
    weigh = [0.0] + [c * math.log2(c) for c in range(1, total + 1)]
    counts: dict[str, int] = {}
    held, best = 0.0, None
    for i in range(len(seq) - k + 1):
        if i >= total:
            old = seq[i - total : i - total + k]
            c = counts[old]
            counts[old] = c - 1
            held += weigh[c - 1] - weigh[c]
        new = seq[i : i + k]
        c = counts.get(new, 0)
        counts[new] = c + 1
        held += weigh[c + 1] - weigh[c]
        if i >= total - 1:
            e = math.log2(total) - held / total
            best = e if best is None else min(best, e)
    return best


def codelength(seq: Column | str, window: int, k: int) -> Column:
    """The least entropy (bits) of the k-mers of any window; of the whole sequence if it is shorter. N counts as A.

    Counts slide along the sequence, which column functions can't do without quadratic work: a pandas function.
    """

    @F.pandas_udf("double")
    def least(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else window_entropy(x, window, k) for x in s], dtype="float64")

    return least(F.replace(F.upper(_c(seq)), F.lit("N"), F.lit("A")))


def translate_dna(seq: Column | str) -> Column:
    """The protein up to the first stop, which is included; N counts as A; a rest below three bases is left out."""
    codes = {a + b + c: AMINO_ACIDS[16 * i + 4 * j + k] for i, a in enumerate(BASES) for j, b in enumerate(BASES) for k, c in enumerate(BASES)}
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    s = F.replace(F.upper(_c(seq)), F.lit("N"), F.lit("A"))
    n = F.floor(F.length(s) / 3).cast("int")
    codons = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(table, F.substring(s, i * 3 + 1, F.lit(3))))).otherwise(F.array().cast("array<string>"))
    return F.regexp_replace(F.array_join(codons, "", "X"), r"\*.*$", "*")


def cigar_blocks(cigar: Column | str) -> Column:
    """Array of (n, op)."""
    ops = F.regexp_extract_all(_c(cigar), F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(0))
    return F.transform(ops, lambda x: F.struct(F.regexp_extract(x, r"\d+", 0).cast("int").alias("n"), F.right(x, F.lit(1)).alias("op")))


def sam_flag(flag: Column | str, bit: int) -> Column:
    """S22."""
    return _c(flag).bitwiseAND(F.lit(bit)) > 0


def gtf_attributes(text: Column | str) -> Column:
    """The attribute column as a map. Of a key that occurs more than once (such as tag) the last value counts; parts
    that aren't a key and a value are left out."""
    parts = F.transform(F.split(F.translate(_c(text), "\"'", ""), ";"), lambda x: F.split(F.trim(x), " "))
    pairs = F.filter(parts, lambda x: F.size(x) == 2)
    keys = F.transform(pairs, lambda x: F.element_at(x, 1))
    last = F.filter(pairs, lambda x, i: F.array_position(F.slice(keys, i + 2, F.size(keys)), F.element_at(x, 1)) == 0)
    return F.map_from_entries(F.transform(last, lambda x: F.struct(F.element_at(x, 1).alias("key"), F.element_at(x, 2).alias("value"))))


def locus_name(symbol: Column | str) -> Column:
    """A symbol with _locus in it, in any case, becomes its part before the first _, in upper case, and @."""
    s = _c(symbol)
    return F.when(F.instr(F.lower(s), "_locus") > 0, F.concat(F.upper(F.split_part(s, F.lit("_"), F.lit(1))), F.lit("@"))).otherwise(s)


def genome_like(start: Column, end: Column, strand: Column, at: Column) -> Column:
    """P20: a 1-based place in a gene as a place on its chromosome."""
    return F.when(strand.cast("string").isin("-", "-1"), end - at + 1).otherwise(start + at - 1)
