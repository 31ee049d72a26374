"""Alignment tables: conversion, filters, best unique hits, mate consistency, split-read joins, junction coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from helixloom.functions.seq import cigar_blocks, flip_mate, sam_flag


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def sam_to_psl(sam: DataFrame, lengths: DataFrame) -> DataFrame:
    """SAM rows as PSL rows (P17). ``sam``: qname, flag, rname, pos, cigar, seq, nm (null if absent); ``lengths``: rname, length.

    Blocks are runs of M, = and X, joined across insertions of other operators only where nothing lies between; unmapped
    rows are left out. Matches are the aligned bases less the mismatches of NM, which counts only up to 0.9 of the read.
    """
    rows = sam.where(~sam_flag("flag", 4) & (F.col("cigar") != "*")).join(lengths, "rname").withColumn("ops", cigar_blocks("cigar"))
    zero = F.struct(F.lit(0).alias("q"), F.lit(0).alias("t"), F.array().cast("array<struct<size:int,q:int,t:int>>").alias("blocks"), F.lit("").alias("last"))

    def step(acc: Column, x: Column) -> Column:
        op, n = x["op"], x["n"]
        match, gap_q, gap_t = op.isin("M", "=", "X"), op.isin("I", "S"), op.isin("D", "N")
        top = F.element_at(acc["blocks"], -1)
        same = match & (acc["last"] == "M")
        grown = F.concat(F.slice(acc["blocks"], F.lit(1), F.size(acc["blocks"]) - 1), F.array(F.struct((top["size"] + n).alias("size"), top["q"].alias("q"), top["t"].alias("t"))))
        added = F.concat(acc["blocks"], F.array(F.struct(n.alias("size"), acc["q"].alias("q"), acc["t"].alias("t"))))
        blocks = F.when(same, grown).when(match, added).otherwise(acc["blocks"])
        q = acc["q"] + F.when(match | gap_q | (op == "H"), n).otherwise(0)
        t = acc["t"] + F.when(match | gap_t, n).otherwise(0)
        return F.struct(q.alias("q"), t.alias("t"), blocks.alias("blocks"), F.when(match, "M").otherwise(op).alias("last"))

    rows = rows.withColumn("a", F.aggregate("ops", zero, step))
    rows = rows.withColumn("size", F.col("a.q")).withColumn("aligned", _sum(F.transform("a.blocks", lambda b: b["size"])))
    nm = F.when(F.coalesce("nm", F.lit(0)) > F.col("size") * 0.9, 0).otherwise(F.coalesce("nm", F.lit(0)))
    inserted = _sum(F.transform(F.filter("ops", lambda x: x["op"] == "I"), lambda x: x["n"]))
    skipped = F.filter("ops", lambda x: x["op"].isin("D", "N"))
    out = rows.withColumn("mm", F.least("aligned", nm))
    return out.select(
        (F.col("aligned") - F.col("mm")).alias("matches"),
        F.col("mm").alias("mismatches"),
        F.size(F.filter("ops", lambda x: x["op"] == "I")).alias("q_num_insert"),
        inserted.alias("q_base_insert"),
        F.size(skipped).alias("t_num_insert"),
        _sum(F.transform(skipped, lambda x: x["n"])).alias("t_base_insert"),
        F.when(sam_flag("flag", 16), "-").otherwise("+").alias("strand"),
        F.col("qname").alias("q_name"),
        F.col("size").alias("q_size"),
        F.element_at("a.blocks", 1)["q"].alias("q_start"),
        (F.element_at("a.blocks", -1)["q"] + F.element_at("a.blocks", -1)["size"]).alias("q_end"),
        F.col("rname").alias("t_name"),
        F.col("length").alias("t_size"),
        (F.col("pos") - 1).alias("t_start"),
        (F.col("pos") - 1 + F.col("a.t")).alias("t_end"),
        F.size("a.blocks").alias("block_count"),
        F.transform("a.blocks", lambda b: b["size"]).alias("block_sizes"),
        F.transform("a.blocks", lambda b: b["q"]).alias("q_starts"),
        F.transform("a.blocks", lambda b: b["t"] + F.col("pos") - 1).alias("t_starts"),
    )


def fusion_hits(psl: DataFrame, share: float = 0.70, anchor: int = 9) -> DataFrame:
    """Two-block hits with one gap in the target."""
    gap = (F.col("q_num_insert") == 0) | ((F.col("q_num_insert") == 1) & (F.col("q_base_insert") <= 3))
    return psl.where((F.col("matches") / F.col("q_size") >= share) & (F.col("block_count") == 2) & (F.col("t_num_insert") == 1) & gap & (F.array_min("block_sizes") > anchor))


def with_border(psl: DataFrame) -> DataFrame:
    """The parts of a target name gene1|gene2|border."""
    parts = F.split("t_name", r"\|")
    return psl.withColumn("gene_1", F.get(parts, F.lit(0))).withColumn("gene_2", F.get(parts, F.lit(1))).withColumn("border", F.get(parts, F.lit(2)).cast("int"))


def junction_hits_two(psl: DataFrame, share: float = 0.90, overlap: int = 17) -> DataFrame:
    """two blocks of at least ``overlap`` bases around the border between two genes' sequences."""
    near = (F.get("t_starts", F.lit(0)) + F.get("block_sizes", F.lit(0)) <= F.col("border") + 1) & (F.get("t_starts", F.lit(1)) + 1 > F.col("border"))
    inside = (F.col("t_start") < F.col("border")) & (F.col("border") < F.col("t_end"))
    return fusion_hits(with_border(psl), share, overlap - 1).where(near & inside)


def junction_hits(psl: DataFrame, share: float = 0.75, mismatches: int = 1000) -> DataFrame:
    """hits of 2 to 8 blocks across the border."""
    return with_border(psl).where("block_count > 1 and block_count < 9 and t_num_insert > 0 and t_num_insert < 7 and q_num_insert < 7").where((F.col("mismatches") <= mismatches) & (F.col("matches") / F.col("q_size") >= share) & (F.col("t_start") < F.col("border")) & (F.col("border") < F.col("t_end")))


def short_blocks_as_mismatches(psl: DataFrame, threshold: int = 15, mismatches: int = 1000) -> DataFrame:
    """bases of blocks below ``threshold`` become mismatches; rows above ``mismatches`` go, before and after."""
    short = _sum(F.filter("block_sizes", lambda b: b < threshold))
    moved = psl.where(F.col("mismatches") <= mismatches).withColumn("_s", short)
    return moved.withColumn("matches", F.col("matches") - F.col("_s")).withColumn("mismatches", F.col("mismatches") + F.col("_s")).drop("_s").where(F.col("mismatches") <= mismatches)


def _best() -> WindowSpec:
    return Window.partitionBy("q_name").orderBy(F.desc("matches"), "mismatches", "block_count", "t_name", "t_start")


def best_unique_hits(psl: DataFrame) -> DataFrame:
    """A read's best hit, if no other has as many matches."""
    ranked = psl.withColumn("_rn", F.row_number().over(_best())).withColumn("_next", F.lead("matches").over(_best()))
    return ranked.where("_rn = 1 and (_next is null or _next <> matches)").drop("_rn", "_next")


def best_hits_with_ties(psl: DataFrame, allowed: Column | None = None) -> DataFrame:
    """A read's best hits, alone or tied on one target with each overlapping the first; or all ``allowed``."""
    top = psl.withColumn("_m", F.max("matches").over(Window.partitionBy("q_name"))).where("matches = _m").drop("_m")
    whole = Window.partitionBy("q_name")
    first = _best().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tied = top.withColumn("_s", F.first("t_start").over(first)).withColumn("_e", F.first("t_end").over(first)).withColumn("_n", F.count("*").over(whole))
    tied = tied.withColumn("_one", F.min("t_name").over(whole) == F.max("t_name").over(whole)).withColumn("_meet", F.min((F.col("t_start") <= F.col("_e")) & (F.col("t_end") >= F.col("_s"))).over(whole))
    ok = (F.col("_n") == 1) | (F.col("_one") & F.col("_meet"))
    if allowed is not None:
        tied = tied.withColumn("_all", F.min(allowed).over(whole))
        ok = ok | F.col("_all")
    return tied.where(ok).drop("_s", "_e", "_n", "_one", "_meet", "_all")


def best_hits_overlapping_genes(psl: DataFrame, overlapping: DataFrame) -> DataFrame:
    """Tied best hits stay if their targets are different gene pairs and any two of them share an overlapping-gene
    relation between one gene of each. ``psl`` has gene_1, gene_2."""
    top = psl.withColumn("_m", F.max("matches").over(Window.partitionBy("q_name"))).where("matches = _m").drop("_m")
    n = top.groupBy("q_name").agg(F.count("*").alias("_n"), F.countDistinct(F.least("gene_1", "gene_2"), F.greatest("gene_1", "gene_2")).alias("_d"))
    a, b = (top.select("q_name", *[F.col(c).alias(f"{c}_{x}") for c in ("t_name", "gene_1", "gene_2")]) for x in "ab")
    both = a.join(b, "q_name").where("t_name_a < t_name_b")
    links = overlapping.select("g_lo", "g_hi").union(overlapping.select("g_hi", "g_lo")).distinct()
    crossed = both.select("q_name", "t_name_a", "t_name_b", F.explode(F.array(*[F.struct(F.col(f"gene_{i}_a").alias("x"), F.col(f"gene_{j}_b").alias("y")) for i in (1, 2) for j in (1, 2)])).alias("p"))
    linked = crossed.join(links.toDF("x", "y"), (F.col("p.x") == F.col("x")) & (F.col("p.y") == F.col("y")), "left_semi").select("q_name", "t_name_a", "t_name_b").distinct()
    bad = both.join(linked, ["q_name", "t_name_a", "t_name_b"], "left_anti").select("q_name").distinct()
    keep = n.where("_n = 1 or _n = _d").select("q_name").join(bad, "q_name", "left_anti")
    return top.join(keep, "q_name", "left_semi")


def best_unique_by_gene(psl: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of a read that agree in matches and gene count once (the first); unique best hits, and the other reads."""
    first = Window.partitionBy("q_name", "matches", "gene").orderBy("mismatches", "block_count", "t_name", "t_start")
    once = psl.withColumn("_k", F.row_number().over(first)).where("_k = 1").drop("_k")
    unique = best_unique_hits(once)
    return unique, once.join(unique.select("q_name"), "q_name", "left_anti")


def mate_consistent(junction_hits: DataFrame, mate_genes: DataFrame, only_pairs: bool = False) -> DataFrame:
    """Drops (read, junction) whose mate maps, but on neither of the junction's genes.

    ``junction_hits``: read_id, gene_1, gene_2, ...; ``mate_genes``: read_id, gene (transcriptome hits). Reads whose mate
    isn't mapped stay unless ``only_pairs``.
    """
    mates = mate_genes.select(flip_mate("read_id").alias("read_id"), "gene").distinct()
    hits = junction_hits.select("read_id", "gene_1", "gene_2").distinct()
    agree = hits.join(mates, "read_id").where("gene = gene_1 or gene = gene_2").select("read_id", "gene_1", "gene_2").distinct()
    keep = junction_hits.join(agree, ["read_id", "gene_1", "gene_2"], "left_semi")
    if only_pairs:
        return keep
    return keep.unionByName(junction_hits.join(mates.select("read_id").distinct(), "read_id", "left_anti"))


def mate_consistent_single(junction_hits: DataFrame, mate_genes: DataFrame) -> DataFrame:
    """As J15 with mapped mates only, after fragments with junction hits on both mates are removed."""
    frag = F.expr("left(read_id, length(read_id) - 2)")
    both = junction_hits.groupBy(frag.alias("frag")).agg(F.min("read_id").alias("x"), F.max("read_id").alias("y")).where("x <> y").select("frag")
    single = junction_hits.withColumn("frag", frag).join(both, "frag", "left_anti").drop("frag")
    return mate_consistent(single, mate_genes, only_pairs=True)


def reads_with_candidate_mate(reads: DataFrame, mate_genes: DataFrame, genes: DataFrame) -> DataFrame:
    """Single reads whose mate maps on a candidate gene."""
    frag = F.expr("left(read_id, length(read_id) - 2)")
    both = reads.groupBy(frag.alias("frag")).agg(F.min("read_id").alias("x"), F.max("read_id").alias("y")).where("x <> y").select("frag")
    near = mate_genes.join(genes.select("gene"), "gene", "left_semi").select(flip_mate("read_id").alias("read_id")).distinct()
    return reads.withColumn("frag", frag).join(both, "frag", "left_anti").drop("frag").join(near, "read_id", "left_semi")


def better_on_transcriptome(transcriptome: DataFrame, genome: DataFrame) -> DataFrame:
    """Reads whose first genome row has at least as many mismatches as their first transcriptome row, or none.

    Both have read_id, ord, n_mism; all rows of a kept read stay.
    """
    first = lambda df, name: df.groupBy("read_id").agg(F.min_by("n_mism", "ord").alias(name))
    worse = first(transcriptome, "t").join(first(genome, "g"), "read_id").where("g < t").select("read_id")
    return transcriptome.join(worse, "read_id", "left_anti")


def by_read_ids(rows: DataFrame, ids: DataFrame, extract: bool = True, mate: bool = False) -> DataFrame:
    """rows whose read is (or isn't) in a list, or whose mate is."""
    wanted = ids.select(flip_mate("read_id").alias("read_id") if mate else F.col("read_id")).distinct()
    return rows.join(wanted, "read_id", "left_semi" if extract else "left_anti")


def merge_parts(parts: DataFrame, exactly_two: bool = False, absorb: int = 9, overlap: int = 17) -> DataFrame:
    """Split alignments of a read on one target and strand, merged pairwise.

    ``parts``: q_name, t_name, strand, ord, q_start, q_end, t_start, t_end, matches, mismatches. The part that starts first
    in the read is part 1; a read gap of up to ``absorb`` bases goes to part 1, an overlap below ``overlap`` is cut from part
    2; target order must follow the strand.
    """
    keys = ["q_name", "t_name", "strand"]
    if exactly_two:
        parts = parts.join(parts.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n = 2").select(*keys), keys, "left_semi")
    cols = ["ord", "q_start", "q_end", "t_start", "t_end", "matches", "mismatches"]
    a, b = (parts.select(*keys, *[F.col(c).alias(f"{c}_{x}") for c in cols]) for x in (1, 2))
    both = a.join(b, keys).where("q_start_1 < q_start_2 or (q_start_1 = q_start_2 and ord_1 < ord_2)").where("t_start_1 < t_start_2")
    gap = F.col("q_start_2") - F.col("q_end_1")
    both = both.withColumn("gap", gap).where((gap <= absorb) & (gap > -overlap))
    cut = F.greatest(F.lit(0), -F.col("gap"))
    both = both.where(F.col("q_end_2") - F.col("q_start_2") > cut)
    grow = F.greatest(F.lit(0), F.col("gap"))
    return both.select(
        *keys,
        (F.col("matches_1") + F.col("matches_2") - cut).alias("matches"),
        (F.col("mismatches_1") + F.col("mismatches_2") + grow).alias("mismatches"),
        F.col("q_start_1").alias("q_start"),
        F.col("q_end_2").alias("q_end"),
        F.col("t_start_1").alias("t_start"),
        F.col("t_end_2").alias("t_end"),
        F.array(F.col("q_end_1") - F.col("q_start_1") + grow, F.col("q_end_2") - F.col("q_start_2") - cut).alias("block_sizes"),
        F.array(F.col("q_start_1"), F.col("q_start_2") + cut).alias("q_starts"),
        F.array(F.col("t_start_1"), F.col("t_start_2") + cut).alias("t_starts"),
    )


def merge_sam_mates(sam: DataFrame, most: int = 10000, most_short: int = 10000, short: int = 20, other_strand: bool = False) -> DataFrame:
    """Properly paired mates of a fragment on one target, side by side: frag, rname and pos, cigar, flag of each.

    ``sam``: qname (its last character tells the mates apart), flag, rname, pos, cigar, seq, nm. Flags tell the first mate. A
    read may have ``most`` mismatches, one of at most ``short`` bases only ``most_short``. Mates must lie on one strand, or on
    both with ``other_strand``, where the second one's strand bit is then flipped. Each CIGAR is padded by the mate's length
    as hard-clipped bases, on the side where the mate lies.
    """
    nm, size = F.coalesce("nm", F.lit(0)), F.length("seq")
    rows = sam.where(sam_flag("flag", 1) & sam_flag("flag", 2)).where((nm <= most) & ((size > short) | (nm <= most_short)))
    rows = rows.select(F.expr("left(qname, length(qname) - 1)").alias("frag"), "rname", "pos", "cigar", "flag", size.alias("n"), sam_flag("flag", 16).alias("rev"), sam_flag("flag", 64).alias("first"))
    a, b = (rows.where(F.col("first") == first).select("frag", "rname", *[F.col(c).alias(f"{c}_{m}") for c in ("pos", "cigar", "flag", "n", "rev")]) for m, first in ((1, True), (2, False)))
    same = F.col("rev_1") == F.col("rev_2")
    both = a.join(b, ["frag", "rname"]).where(~same if other_strand else same)
    mate = [F.concat(F.col(f"n_{m}").cast("string"), F.lit("H")) for m in (2, 1)]
    one = F.when(F.col("rev_1"), F.concat(mate[0], "cigar_1")).otherwise(F.concat("cigar_1", mate[0]))
    two = F.when(F.col("rev_1"), F.concat("cigar_2", mate[1])).otherwise(F.concat(mate[1], "cigar_2"))
    flag = F.col("flag_2").bitwiseXOR(F.lit(16)) if other_strand else F.col("flag_2")
    return both.select("frag", "rname", "pos_1", one.alias("cigar_1"), "flag_1", "pos_2", two.alias("cigar_2"), flag.alias("flag_2"))


def clip_points(psl: DataFrame, clip: int = 20) -> DataFrame:
    """q_name, cut for reads with one alignment and ``clip`` free bases on a side; the longest block counts."""
    single = psl.join(psl.groupBy("q_name").agg(F.count("*").alias("_n")).where("_n = 1").select("q_name"), "q_name", "left_semi")
    at = F.array_position("block_sizes", F.array_max("block_sizes")).cast("int") - 1
    rows = single.withColumn("p2", F.get("q_starts", at)).withColumn("p3", F.col("p2") + F.array_max("block_sizes"))
    left, right = F.col("p2"), F.col("q_size") - F.col("p3")
    cut = F.when((left >= clip) & (left >= right), F.col("p2")).when(right >= clip, F.col("p3"))
    flipped = F.when(F.col("strand") == "-", F.col("q_size") - cut).otherwise(cut)
    return rows.select("q_name", flipped.alias("cut")).where("cut is not null")


def border_anchors(psl: DataFrame, least: int = 17) -> DataFrame:
    """Bases left and right of the border, and the read with * between; both anchors at least ``least``."""
    sizes = F.zip_with("block_sizes", "t_starts", lambda n, t: F.greatest(F.lit(0), F.least(n, F.col("border") - t)))
    left = _sum(sizes)
    total = _sum(F.col("block_sizes"))
    rows = psl.withColumn("anchor_1", left).withColumn("anchor_2", total - left)
    return rows.where(F.least("anchor_1", "anchor_2") >= least)


def split_pairs(parts: DataFrame, most_genes: int = 3) -> DataFrame:
    """reads with two parts on disjoint sets of at most ``most_genes`` genes: read_id, genes_1, genes_2."""
    sets = parts.groupBy("read_id", "part").agg(F.array_sort(F.collect_set("gene")).alias("genes"))
    both = sets.groupBy("read_id").agg(F.array_sort(F.collect_list(F.struct("part", "genes"))).alias("p")).where("size(p) = 2")
    one, two = (F.get("p", F.lit(i))["genes"] for i in (0, 1))
    out = both.select("read_id", one.alias("genes_1"), two.alias("genes_2"))
    return out.where((F.size("genes_1") <= most_genes) & (F.size("genes_2") <= most_genes) & ~F.arrays_overlap("genes_1", "genes_2"))


def filter_splits(splits: DataFrame, allowed: DataFrame) -> DataFrame:
    """splits (read_id, gene_1, gene_2) on different genes, one of which is allowed for the fragment."""
    rows = splits.where("gene_1 <> gene_2").withColumn("frag", F.expr("left(read_id, length(read_id) - 2)"))
    ok = allowed.select("frag", F.col("gene").alias("_g")).distinct()
    one = rows.join(ok, (rows.frag == ok.frag) & (rows.gene_1 == ok._g), "left_semi")
    two = rows.join(ok, (rows.frag == ok.frag) & (rows.gene_2 == ok._g), "left_semi")
    return one.union(two).drop("frag").distinct()


def filter_fragment_pairs(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F8: fragments with two mates whose common genes (but for those starting with >) are exactly two, out of fewer than
    seven rows; and the other fragments. ``hits``: frag, mate, gene. Each fragment keeps its own ids."""
    sets = hits.groupBy("frag").agg(F.count("*").alias("n"), *[F.collect_set(F.when((F.col("mate") == m) & ~F.col("gene").startswith(">"), F.col("gene"))).alias(f"g{m}") for m in (1, 2)], F.countDistinct("mate").alias("mates"))
    sets = sets.where("mates = 2").withColumn("genes", F.array_sort(F.array_intersect("g1", "g2")))
    good = (F.col("n") < 7) & (F.size("genes") == 2)
    return sets.where(good).select("frag", "genes"), sets.where(~good).select("frag", "genes")
