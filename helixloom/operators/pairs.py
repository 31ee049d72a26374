"""Candidate gene pairs: discovery from paired alignments, counting, labelling and extraction.

Inputs are long tables; every order-dependent rule takes an explicit order column. Counts are partial aggregates, and
lookups are left to the optimizer to broadcast where they are small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixloom.functions.seq import pair_high, pair_low, similar_symbols


def mate_pairs(alignments: DataFrame, homologs: DataFrame | None = None, no_protein: DataFrame | None = None) -> DataFrame:
    """All passing (mate 1, mate 2) alignment combinations of a fragment.

    ``alignments``: frag, mate (1 or 2), ord, gene, transcript, strand, pos. Fragments whose mates share a gene are left
    out; mates on one strand, pairs in ``homologs`` (g_lo, g_hi) and genes in ``no_protein`` are dropped. Adds the
    position key z, in which the second mate carries an extra mark, so mate-swapped duplicates stay apart.
    """
    left, right = (alignments.where(F.col("mate") == m).select("frag", *[F.col(c).alias(f"{c}_{m}") for c in ("ord", "gene", "transcript", "strand", "pos")]) for m in (1, 2))
    pairs = left.join(right, "frag")
    # rows of a fragment lie together after the join, so the test for a shared gene needs no second one
    shared = F.max(F.col("gene_1") == F.col("gene_2")).over(Window.partitionBy("frag"))
    out = pairs.withColumn("_shared", shared).where("not _shared and strand_1 <> strand_2").drop("_shared")
    out = out.withColumn("g_lo", pair_low("gene_1", "gene_2")).withColumn("g_hi", pair_high("gene_1", "gene_2"))
    if homologs is not None:
        out = out.join(homologs.select("g_lo", "g_hi"), ["g_lo", "g_hi"], "left_anti")
    if no_protein is not None:
        for m in (1, 2):
            out = out.join(no_protein.select(F.col("gene").alias(f"gene_{m}")), f"gene_{m}", "left_anti")
    z1, z2 = F.concat("transcript_1", F.lit("+++"), "pos_1"), F.concat("transcript_2", F.lit("+++t"), "pos_2")
    return out.withColumn("z", F.concat(F.least(z1, z2), F.lit("-+-"), F.greatest(z1, z2)))


def pair_discovery(passing: DataFrame) -> DataFrame:
    """g_lo, g_hi, n: fragments that support a pair at a position not seen before (A1).

    A fragment counts once for a pair, and only if the first of its combinations for that pair is also the first of all
    combinations with its position key, in order of (frag, ord_1, ord_2). So each key gives at most one count: its first
    combination's, if that is also the first of its fragment and pair. The first of a key is a minimum, which combines
    before the shuffle however often a key occurs.
    """
    own = Window.partitionBy("frag", "g_lo", "g_hi").orderBy("ord_1", "ord_2", "z")
    marked = passing.withColumn("_later", (F.row_number().over(own) > 1).cast("int"))
    first = marked.groupBy("z").agg(F.min(F.struct("frag", "ord_1", "ord_2", "_later", "g_lo", "g_hi")).alias("m"))
    return first.where("m._later = 0").groupBy(F.col("m.g_lo").alias("g_lo"), F.col("m.g_hi").alias("g_hi")).agg(F.count("*").alias("n"))


def pair_reads(passing: DataFrame) -> DataFrame:
    """g_lo, g_hi, n, frag: all distinct supporting fragments of a pair, a row each, with their number (A2). A pair may have any
    number of them, so they aren't gathered in one row."""
    rows = passing.select("g_lo", "g_hi", "frag").distinct()
    return rows.join(rows.groupBy("g_lo", "g_hi").agg(F.count("*").alias("n")), ["g_lo", "g_hi"]).select("g_lo", "g_hi", "n", "frag")


def transcript_pairs(passing: DataFrame) -> DataFrame:
    """t_lo, t_hi, n: passing combinations of a (transcript, gene) pair, without position rules (A3)."""
    a, b = (F.concat(f"transcript_{m}", F.lit(";"), f"gene_{m}") for m in (1, 2))
    return passing.groupBy(F.least(a, b).alias("t_lo"), F.greatest(a, b).alias("t_hi")).agg(F.count("*").alias("n"))


def missing_mates(alignments: DataFrame) -> DataFrame:
    """frag, missing, found, genes: fragments aligned on one mate only."""
    grouped = alignments.groupBy("frag").agg(F.min("mate").alias("lo"), F.max("mate").alias("found"), F.array_join(F.array_sort(F.collect_set("gene")), ",").alias("genes"))
    return grouped.where("lo = found").select("frag", (3 - F.col("found")).alias("missing"), "found", "genes")


def homolog_pairs(hits: DataFrame, reads: int = 1, best_only: bool = False, skip_prefix: str | None = None, most: int = 50) -> DataFrame:
    """g_lo, g_hi, n: reads that map on both genes (A4). ``hits``: read_id, gene[, n_mismatch].

    A read's distinct genes, in order, give all pairs; reads with one gene give none; the reference's own limit of 50 genes
    a read holds for every read. ``best_only``: a read with an exact hit loses genes hit with two mismatches.
    """
    if skip_prefix:
        hits = hits.where(~F.col("gene").startswith(skip_prefix))
    if best_only:
        best = hits.groupBy("read_id").agg(F.min("n_mismatch").alias("best"))
        hits = hits.join(best, "read_id").where("not (best = 0 and n_mismatch = 2)")
    genes = hits.groupBy("read_id").agg(F.slice(F.array_sort(F.collect_set("gene")), 1, most).alias("genes")).where(F.size("genes") > 1)
    left = genes.select("genes", F.posexplode("genes").alias("i", "g_lo"))
    pairs = left.select("g_lo", F.explode(F.slice("genes", F.col("i") + 2, most)).alias("g_hi"))
    return pairs.groupBy("g_lo", "g_hi").agg(F.count("*").alias("n")).where(F.col("n") >= reads)


def join_homologs(first: DataFrame, second: DataFrame, reads: int = 1) -> tuple[DataFrame, DataFrame]:
    """Sums two pair counts; pairs with at least ``reads``, and the rest."""
    both = first.select("g_lo", "g_hi", "n").unionAll(second.select("g_lo", "g_hi", "n")).groupBy("g_lo", "g_hi").agg(F.sum("n").alias("n"))
    return both.where(F.col("n") >= reads), both.where(F.col("n") < reads)


def offending_reads(hits: DataFrame, genes: DataFrame, tolerance: int = 50) -> DataFrame:
    """Reads that map on two genes that don't overlap (A5, J13), with both mate names. ``genes``: gene, chrom, start, end."""
    located = hits.select("read_id", "gene").distinct().join(genes, "gene")
    a, b = (located.select("read_id", *[F.col(c).alias(f"{c}_{x}") for c in ("gene", "chrom", "start", "end")]) for x in "ab")
    apart = a.join(b, "read_id").where("gene_a < gene_b").where(f"not (chrom_a = chrom_b and end_a - start_b > {tolerance} and end_b - start_a > {tolerance})")
    stem = F.expr("left(read_id, length(read_id) - 1)")
    return apart.select(F.explode(F.array(F.concat(stem, F.lit("1")), F.concat(stem, F.lit("2")))).alias("read_id")).distinct()


def with_label(candidates: DataFrame, hit: Column, label: str) -> DataFrame:
    """Appends ``label`` to the labels array where ``hit``; a label may occur twice."""
    return candidates.withColumn("labels", F.when(F.coalesce(hit, F.lit(False)), F.concat("labels", F.array(F.lit(label)))).otherwise(F.col("labels")))


def label_pair_set(candidates: DataFrame, pairs: DataFrame, label: str, threshold: int = 0) -> DataFrame:
    """Labels candidates whose unordered pair is in ``pairs`` (g_lo, g_hi[, n]), with n >= threshold if given."""
    if threshold and "n" in pairs.columns:
        pairs = pairs.where(F.col("n") >= threshold)
    marked = pairs.select("g_lo", "g_hi").distinct().withColumn("_hit", F.lit(True))
    return with_label(candidates.join(marked, ["g_lo", "g_hi"], "left"), F.col("_hit"), label).drop("_hit")


def label_gene_set(candidates: DataFrame, genes: DataFrame, label: str) -> DataFrame:
    """Labels candidates with a gene in ``genes``."""
    marked = genes.select("gene").distinct()
    a, b = (marked.select(F.col("gene").alias(c), F.lit(True).alias(f"_{c}")) for c in ("g_lo", "g_hi"))
    out = candidates.join(a, "g_lo", "left").join(b, "g_hi", "left")
    return with_label(out, F.coalesce("_g_lo", "_g_hi"), label).drop("_g_lo", "_g_hi")


def label_similar_symbols(candidates: DataFrame, label: str = "similar_symbols") -> DataFrame:
    """Labels candidates whose symbols differ by a short suffix at most."""
    return with_label(candidates, similar_symbols(F.col("symbol_1"), F.col("symbol_2")), label)


def label_distance(candidates: DataFrame, genes: DataFrame, distance: int, label: str) -> DataFrame:
    """Labels pairs on one chromosome and strand whose nearest ends lie within ``distance``.

    ``genes``: gene, chrom, strand, start, end; the first row of a gene counts (its least start), swapped ends are put right.
    """
    one = genes.groupBy("gene").agg(F.min(F.struct(F.least("start", "end").alias("s"), F.greatest("start", "end").alias("e"), "chrom", "strand")).alias("at"))
    a, b = (one.select(F.col("gene").alias(c), F.col("at").alias(f"_{c}")) for c in ("g_lo", "g_hi"))
    out = candidates.join(a, "g_lo", "left").join(b, "g_hi", "left")
    near = F.least(*[F.abs(F.col(f"_g_lo.{x}") - F.col(f"_g_hi.{y}")) for x in "se" for y in "se"])
    hit = (F.col("_g_lo.chrom") == F.col("_g_hi.chrom")) & (F.col("_g_lo.strand") == F.col("_g_hi.strand")) & (near <= distance)
    return with_label(out, hit, label).drop("_g_lo", "_g_hi")


def ambiguous_counts(candidates: DataFrame, common: DataFrame) -> DataFrame:
    """Adds common_n, the reads that map on both genes, 0 if unknown."""
    return candidates.join(common.select("g_lo", "g_hi", F.col("n").alias("common_n")), ["g_lo", "g_hi"], "left").withColumn("common_n", F.coalesce("common_n", F.lit(0)))


def label_ambiguous(candidates: DataFrame, common: DataFrame, label: str = "similar_reads", factor: int = 20) -> DataFrame:
    """Labels pairs whose common mapping reads exceed ``factor`` times their support."""
    return with_label(ambiguous_counts(candidates, common), F.col("common_n") > F.col("n") * factor, label).drop("common_n")


def label_multi(candidates: DataFrame, data: DataFrame, labels: tuple[str, str], pairs: int) -> DataFrame:
    """With v a pair's count in ``data`` (ordered pair, 0 if absent) and v <> n: label ``a<v>``, and b if v < pairs."""
    out = candidates.join(data.select("g_lo", "g_hi", F.col("n").alias("v")), ["g_lo", "g_hi"], "left").withColumn("v", F.coalesce("v", F.lit(0)))
    more = F.when(F.col("n") == F.col("v"), F.array().cast("array<string>")).otherwise(F.concat(F.array(F.concat(F.lit(labels[0]), F.col("v").cast("string"))), F.when(F.col("v") < pairs, F.array(F.lit(labels[1]))).otherwise(F.array().cast("array<string>"))))
    return out.withColumn("labels", F.concat("labels", more)).drop("v")


def label_short_reads(candidates: DataFrame, reads: DataFrame, short: DataFrame) -> DataFrame:
    """Labels a pair t<N>, N its supporting reads in ``short`` (J8). ``reads``: g_lo, g_hi, read_id."""
    n = reads.join(short, "read_id", "left_semi").groupBy("g_lo", "g_hi").agg(F.countDistinct("read_id").alias("t"))
    out = candidates.join(n, ["g_lo", "g_hi"], "left")
    return out.withColumn("labels", F.when(F.col("t") > 0, F.concat("labels", F.array(F.concat(F.lit("t"), F.col("t").cast("string"))))).otherwise(F.col("labels"))).drop("t")


def extract_candidates(candidates: DataFrame, threshold_pairs: int = 3, threshold_pairs_known: int = 0, threshold_count: int = 5000, skip: tuple[str, ...] = ("paralog",), allowed: tuple[str, ...] = ("known",), further: tuple[str, ...] = ("further_fusion",)) -> DataFrame:
    """Adds status: further_analysis or skipped (F1), in order of (n desc, g_lo, g_hi).

    A further label always passes. Otherwise a pair needs enough reads (known ones have their own threshold) and no
    skipped label, or an allowed one, and fewer than ``threshold_count`` pairs accepted before it. Acceptance without that
    limit decides the running count, because a pair that the limit turns down is followed only by pairs it turns down.
    """
    known = threshold_pairs_known or threshold_pairs
    has = lambda names: F.arrays_overlap("labels", F.array(*[F.lit(x) for x in names]))
    always = has(further)
    usual = ((F.col("n") >= threshold_pairs) & (has(allowed) | ~has(skip))) | ((F.col("n") >= known) & has(allowed))
    # the last pair within the limit: one row, found by each partition's first rows alone
    place = F.struct((-F.col("n")).alias("n"), "g_lo", "g_hi")
    first = candidates.where(always | usual).select(place.alias("k")).orderBy("k").limit(threshold_count)
    last = first.agg(F.when(F.count("*") >= threshold_count, F.max("k")).alias("k")).scalar()
    within = F.coalesce(place <= last, F.lit(True)) if threshold_count > 0 else F.lit(False)
    return candidates.withColumn("status", F.when(always | (usual & within), "further_analysis").otherwise("skipped"))


def selected_reads(candidates: DataFrame, reads: DataFrame) -> DataFrame:
    """Both mate names of all reads that support a pair under further analysis."""
    keep = candidates.where("status = 'further_analysis'").select("g_lo", "g_hi")
    frag = F.col("frag").cast("string")
    return reads.join(keep, ["g_lo", "g_hi"], "left_semi").select(F.explode(F.array(F.concat(frag, F.lit("/1")), F.concat(frag, F.lit("/2")))).alias("read_id")).distinct()


def fragments_fusion(fragment_reads: DataFrame, minimum: int = 0) -> DataFrame:
    """Pairs whose reads are split fragments of fewer than ``minimum`` original reads (F31): g_lo, g_hi, reads, originals."""
    original = F.expr("if(instr(read_id, '_') > 0, substring(read_id, instr(read_id, '_') + 1), read_id)")
    n = fragment_reads.groupBy("g_lo", "g_hi").agg(F.countDistinct("read_id").alias("reads"), F.countDistinct(original).alias("originals"))
    return n.where((F.col("reads") != F.col("originals")) & (F.col("originals") < minimum))


def union_labels(frames: list[tuple[DataFrame, str]]) -> DataFrame:
    """Union of reports, each tagged by its method (SET6)."""
    return reduce(DataFrame.unionByName, [df.withColumn("method", F.lit(tag)) for df, tag in frames])
