"""Document fingerprints by one-permutation MinHash, in SQL functions alone.

Every shingle is hashed once; the top bits of the hash choose one of 256 bins and each bin keeps its least hash. A bin
that got none borrows by optimal densification: it walks a random permutation of the bins, its own and the same for all
documents, to the first bin that is filled. The walk of bin i visits (c_i * t + d_i) mod 257 for t = 0, 1, ...; the first
steps are looked up, and for what is still empty the filled bin of least t is found by solving for t. The fingerprint
packs the low 4 bits of each bin as one hexadecimal digit. Likeness is the share of equal digits, less the share that
agrees by chance: (m - 1/16) / (1 - 1/16), cut to 0..1.

One bound value per row (``let``) keeps each array from being computed again inside the functions that use it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixloom.llm.shared import SharedTables

BINS = 256
PRIME = 257
STEPS = 6
LOW = 55  # bits of a hash below the bin's number
SHINGLE_WORDS = 5
DIGITS = "0123456789abcdef"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _walk_factor(i: int) -> int:
    return i * 131 % 256 + 1


def _walk_start(i: int) -> int:
    return i * i * 89 % PRIME


def shingles(text: Column, k: int) -> Column:
    """63-bit hashes of the k-word shingles; of all words together if there are fewer; none without words."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        several = F.transform(F.sequence(F.lit(1), F.size(h) - (k - 1)), lambda i: F.xxhash64(*[F.element_at(h, i + j) for j in range(k)]))
        few = F.array(F.xxhash64(h))
        return F.when(F.size(h) >= k, several).when(F.size(h) > 0, few).otherwise(F.array().cast("array<bigint>"))

    return let(hashes, lambda h: F.transform(grams(h), lambda x: x.bitwiseAND(F.lit((1 << 63) - 1))))


def fingerprint(text: Column, k: int = SHINGLE_WORDS) -> Column:
    """256 hexadecimal digits, or the empty string for a text without words (null, empty, blank)."""
    none = (1 << LOW) - 1
    sentinels = F.array(*[F.lit((i << LOW) | none) for i in range(BINS)])
    bin_of = lambda x: F.shiftrightunsigned(x, LOW).cast("int")
    empty = lambda x: x.bitwiseAND(F.lit(none)) == none

    def firsts(ordered: Column) -> Column:
        """The least hash of each bin, its sentinel if there is no other."""
        return F.filter(ordered, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(ordered, i - 1))))

    starts = F.array(*[F.lit(_walk_start(i)) for i in range(BINS)])
    factors = F.array(*[F.lit(_walk_factor(i)) for i in range(BINS)])
    inverses = F.array(*[F.lit(pow(_walk_factor(i), -1, PRIME)) for i in range(BINS)])

    def step(bins: Column, filled: Column, t: int) -> Column:
        def visit(x: Column, i: Column) -> Column:
            at = (F.get(factors, i) * t + F.get(starts, i)) % PRIME
            return F.when(empty(x) & (at < BINS) & ~empty(F.get(bins, at)), F.get(bins, at)).otherwise(x)

        return F.transform(filled, visit)

    def rest(bins: Column, filled: Column) -> Column:
        donors = F.filter(bins, lambda x: ~empty(x))

        def nearest(i: Column, given: Column) -> Column:
            steps = F.transform(given, lambda x: F.pmod((bin_of(x) - F.get(starts, i)) * F.get(inverses, i), F.lit(PRIME)) * 16 + x.bitwiseAND(F.lit(15)).cast("int"))
            return F.array_min(steps) % 16

        return let(donors, lambda given: F.transform(filled, lambda x, i: F.when(empty(x), nearest(i, given)).otherwise(x.bitwiseAND(F.lit(15)).cast("int"))))

    def walk(bins: Column) -> Column:
        def go(filled: Column, t: int) -> Column:
            return rest(bins, filled) if t == STEPS else let(step(bins, filled, t), lambda f: go(f, t + 1))

        return go(bins, 0)

    digits = F.array(*[F.lit(c) for c in DIGITS])
    packed = let(F.sort_array(F.concat(shingles(text, k), sentinels)), lambda s: let(firsts(s), walk))
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.array_join(F.transform(packed, lambda v: F.get(digits, v)), "")).otherwise("")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two fingerprints; 1 for equal ones, 0 if only one is empty."""
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))))
    share = same / F.lit(BINS)
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (share - 1 / 16) / (1 - 1 / 16))))


def with_next(ids: DataFrame, store: SharedTables) -> DataFrame:
    """``id, k, next`` for a table ``id, k`` of distinct ids: the next id in ascending order, the first after the last.

    Ids are range-partitioned; inside a partition the next row is the next id, and only the least id of each partition
    takes part in the order across partitions.
    """
    dealt = store.write(ids.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "ids")
    heads = dealt.groupBy("part").agg(F.min("id").alias("head"))
    follow = heads.select("part", F.coalesce(F.lead("head").over(Window.orderBy("part")), F.min("head").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("head"))
    inside = F.lead("id").over(Window.partitionBy("part").orderBy("id"))
    return dealt.withColumn("inside", inside).join(F.broadcast(follow), "part").select("id", "k", F.coalesce("inside", "head").alias("next"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, a row per row.

    The edited text is the text whose last floor(n_chars / 4) code points are replaced by the first as many (or all) of
    the next document in ascending order of ids, the first one after the last. Null texts count as empty; likeness of two
    empty fingerprints is 1. Rows that repeat an id all take the next greater id, and of a repeated next id the least
    text; rows with a null id have no next document, so theirs is empty. An empty table gives an empty result.
    """
    store = SharedTables(docs.sparkSession, "prints")
    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = plain.where("id is not null").groupBy("id").agg(F.floor(F.max(F.length("text")) / 4).cast("int").alias("k"))
    wanted = store.write(with_next(ids, store), "wanted")
    # both joins deal the same rows by id, so they share one exchange
    printed = plain.where("id is not null").select("id", "text", fingerprint(F.col("text")).alias("print"))
    heads = printed.join(wanted.select(F.col("id").alias("of"), "k", F.col("next").alias("id")), "id")
    heads = heads.select(F.col("of").alias("id"), F.struct(F.expr("left(text, k)").alias("head"), F.col("print").alias("next_print")).alias("next"))
    heads = heads.groupBy("id").agg(F.min("next").alias("next"))
    known = printed.join(heads, "id").select("id", "text", "print", "next.head", "next.next_print")
    lost = plain.where("id is null").select("id", "text", fingerprint(F.col("text")).alias("print"), F.lit("").alias("head"), F.lit("").alias("next_print"))
    rows = known.unionByName(lost)
    n = F.length("text")
    k = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - k), F.substring(F.col("head"), F.lit(1), k))
    rows = rows.select("id", n.cast("bigint").alias("n"), "print", edited.alias("edited"), "next_print")
    rows = rows.select("id", "n", "print", F.sha2(F.col("edited").cast("binary"), 256).alias("sha"), fingerprint(F.col("edited")).alias("edited_print"), "next_print")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"), F.col("print").alias("fingerprint"), F.col("edited_print").alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next"))
