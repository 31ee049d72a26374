"""Interval operators: overlaps, adjacency, merging, enlargement, distances. Ranges join by bins, never by a cross join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BIN = 1 << 17


def normal(genes: DataFrame) -> DataFrame:
    """Swapped ends put right."""
    return genes.withColumn("lo", F.least("start", "end")).withColumn("hi", F.greatest("start", "end")).drop("start", "end").withColumnsRenamed({"lo": "start", "hi": "end"})


def overlap_candidates(genes: DataFrame, keys: list[str], bin_size: int = BIN) -> DataFrame:
    """Pairs of rows with equal ``keys`` whose closed intervals meet, each once, ordered by gene (columns ..._a, ..._b).

    Intervals are spread over fixed bins; a pair is kept only in the first bin that both have, so no distinct is needed.
    """
    binned = genes.withColumn("first_bin", F.floor(F.col("start") / bin_size)).withColumn("bin", F.explode(F.sequence("first_bin", F.floor(F.col("end") / bin_size))))
    cols = [c for c in binned.columns if c not in (*keys, "bin")]
    a, b = (binned.select(*keys, "bin", *[F.col(c).alias(f"{c}_{x}") for c in cols]) for x in "ab")
    near = a.join(b, [*keys, "bin"]).where("gene_a < gene_b and bin = greatest(first_bin_a, first_bin_b)")
    return near.where("start_a <= end_b and start_b <= end_a").drop("bin", "first_bin_a", "first_bin_b")


def overlapping_genes(genes: DataFrame, tolerance: int = 40, bin_size: int = BIN) -> DataFrame:
    """g_lo, g_hi, kind (full or partial), same_strand for genes that overlap by more than ``tolerance``."""
    pairs = overlap_candidates(normal(genes), ["chrom"], bin_size).where(f"end_a - start_b > {tolerance} and end_b - start_a > {tolerance}")
    inside = f"(start_a >= start_b - {tolerance} and end_a <= end_b + {tolerance}) or (start_b >= start_a - {tolerance} and end_b <= end_a + {tolerance})"
    return pairs.select(F.col("gene_a").alias("g_lo"), F.col("gene_b").alias("g_hi"), F.when(F.expr(inside), "full").otherwise("partial").alias("kind"), (F.col("strand_a") == F.col("strand_b")).alias("same_strand")).distinct()


def adjacent_genes(genes: DataFrame) -> DataFrame:
    """g_first, g_second: genes of one chromosome and strand with no whole gene between them (J12); start <= end.

    In order of (start, end, gene), j follows i without a blocker when start_j <= the least end of the genes that start
    after end_i. That limit is a suffix minimum over starts; the genes up to it are a run of ranks after i's own, so the
    partners are found by an equality of ranks. Both numbers come from windows that merge genes and questions; they run
    from the far end, since frames that grow backwards are computed in one pass and shrinking ones are not.
    """
    key = Window.partitionBy("chrom", "strand")
    ranked = genes.select("chrom", "strand", "gene", "start", "end", F.row_number().over(key.orderBy("start", "end", "gene")).alias("rank"))
    points = ranked.select("chrom", "strand", F.col("start").alias("at"), F.col("end").alias("its_end"), F.lit(None).cast("int").alias("of"))

    def asked(at: str, rows: DataFrame, answer: Column, frame: WindowSpec, name: str) -> DataFrame:
        asks = rows.select("chrom", "strand", F.col(at).alias("at"), F.lit(None).cast(dict(points.dtypes)["its_end"]).alias("its_end"), F.col("rank").alias("of"))
        both = points.unionByName(asks).withColumn(name, answer.over(frame))
        return both.where("of is not null").select("chrom", "strand", F.col("of").alias("rank"), name)

    limits = asked("end", ranked, F.min("its_end"), key.orderBy(-F.col("at")).rangeBetween(Window.unboundedPreceding, -1), "limit")
    last = genes.groupBy("chrom", "strand").agg(F.max("start").alias("last"))
    limits = limits.join(last, ["chrom", "strand"]).withColumn("limit", F.coalesce("limit", "last"))
    upto = asked("limit", limits, F.count("its_end"), key.orderBy("at").rangeBetween(Window.unboundedPreceding, 0), "upto")
    a = ranked.select("chrom", "strand", "rank", F.col("gene").alias("g_first")).join(upto, ["chrom", "strand", "rank"])
    a = a.where("upto > rank").select("chrom", "strand", "g_first", F.explode(F.sequence(F.col("rank").cast("bigint") + 1, F.col("upto"))).alias("rank"))
    b = ranked.select("chrom", "strand", F.col("rank").cast("bigint").alias("rank"), F.col("gene").alias("g_second"))
    return a.join(b, ["chrom", "strand", "rank"]).where("g_first <> g_second").select("chrom", "strand", "g_first", "g_second")


def readthroughs(adjacent: DataFrame) -> DataFrame:
    """Adjacent pairs in the direction of transcription: g_5end, g_3end."""
    down = F.col("strand").isin("-", "-1")
    return adjacent.select(F.when(down, F.col("g_second")).otherwise(F.col("g_first")).alias("g_5end"), F.when(down, F.col("g_first")).otherwise(F.col("g_second")).alias("g_3end"))


def _islands(bed: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    flagged = bed.withColumn("_new", (before.isNull() | (F.col("start") >= before)).cast("int"))
    grouped = flagged.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "_island")
    return grouped.agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def merge_intervals(bed: DataFrame, bin_size: int = BIN) -> DataFrame:
    """chrom, start, end with overlapping intervals merged; touching ones stay apart.

    Intervals that start in one bin merge first, so the pass along a whole chromosome sees islands of bins instead of rows.
    """
    rows = bed.select("chrom", "start", "end").withColumn("_bin", F.floor(F.col("start") / bin_size))
    return _islands(_islands(rows, ["chrom", "_bin"]).drop("_bin"), ["chrom"])


def enlarge_genes(genes: DataFrame, chroms: DataFrame, size: int = 5000) -> DataFrame:
    """gene, chrom, start, end, new_start, new_end: genes stretched into free space.

    A gene grows by ``size`` on each side, at most to the middle of the gap to the next gene outside it, and within its
    chromosome (``chroms``: chrom, length). Genes inside or overlapping others don't grow on that side.
    """
    order = Window.partitionBy("chrom").orderBy("start", "end", "gene")
    left_end = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    right_start = F.min("start").over(Window.partitionBy("chrom").orderBy(-F.col("start")).rangeBetween(Window.unboundedPreceding, -1))
    gaps = genes.withColumn("_l", left_end).withColumn("_r", right_start).join(chroms, "chrom")
    free_left = F.when(F.col("_l").isNull(), F.col("start") - 1).otherwise(F.floor((F.col("start") - F.col("_l") - 1) / 2))
    free_right = F.when(F.col("_r").isNull(), F.col("length") - F.col("end")).otherwise(F.floor((F.col("_r") - F.col("end") - 1) / 2))
    grow = lambda free: F.greatest(F.lit(0), F.least(F.lit(size), free))
    return gaps.select("gene", "chrom", "start", "end", (F.col("start") - grow(free_left)).alias("new_start"), (F.col("end") + grow(free_right)).alias("new_end"))


def tile_genes(genes: DataFrame, length: int, step: int) -> DataFrame:
    """Windows of ``length`` every ``step`` along each gene (P27): gene, chrom, start, end."""
    starts = F.sequence(F.col("start"), F.greatest(F.col("start"), F.col("end") - length + 1), F.lit(step).cast("bigint"))
    return genes.select("gene", "chrom", "end", F.explode(starts).alias("at")).select("gene", "chrom", F.col("at").alias("start"), F.least(F.col("at") + length - 1, F.col("end")).alias("end"))


def synthetic_exons(enlarged: DataFrame, exons: DataFrame, short: int = 200, skip: DataFrame | None = None) -> DataFrame:
    """Gene, chrom, start, end of the exons that cover what genes gained (the result of ``enlarge_genes``).

    A gene with one exon, or shorter than ``short``, gets one exon over all of it; another that grew gets one for each side
    that grew. A gene that didn't grow gets one only if it is short and has several exons. Genes in ``skip`` get none.
    ``exons``: gene and a row an exon.
    """
    counts = exons.groupBy("gene").agg(F.count("*").alias("_n"))
    rows = enlarged.join(counts, "gene")
    if skip is not None:
        rows = rows.join(skip.select("gene").distinct(), "gene", "left_anti")
    left, right = F.col("new_start") < F.col("start"), F.col("new_end") > F.col("end")
    small = (F.col("end") - F.col("start")) < short
    part = lambda a, b: F.struct(F.col(a).alias("start"), F.col(b).alias("end"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    sides = F.concat(F.when(left, F.array(part("new_start", "start"))).otherwise(none), F.when(right, F.array(part("end", "new_end"))).otherwise(none))
    parts = F.when(left | right, F.when((F.col("_n") == 1) | small, F.array(part("new_start", "new_end"))).otherwise(sides)).when((F.col("_n") > 1) & small, F.array(part("start", "end"))).otherwise(none)
    return rows.select("gene", "chrom", F.explode(parts).alias("p")).select("gene", "chrom", "p.start", "p.end")
