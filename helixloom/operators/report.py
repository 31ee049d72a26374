"""Junction evidence, reports, their merging, labelling, filtering, and the final products."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixloom.functions.seq import codelength, junction_window, locus_name, translate_dna
from helixloom.operators.pairs import union_labels, with_label
from helixloom.operators.ranks import with_rank

SITE = ["gene_1", "gene_2", "chrom_1", "strand_1", "pos_1", "chrom_2", "strand_2", "pos_2"]


def junction_summary(hits: DataFrame, anchor: int = 10, strict: bool = True) -> DataFrame:
    """One row per junction: counts, unique positions, anchors.

    ``hits``: junction (id), pair, read_id, start, end (1-based), junct, n_mism. A hit must reach ``anchor`` bases past the
    junction on both sides. For each position the hit of least (mismatches, read) counts, with the smaller of its two anchors.
    ``strict`` keeps the rule that drops junctions with one position if they have many mismatches or a long anchor.
    """
    near = hits.where(f"start <= junct - {anchor} and end >= junct + {anchor}")
    one = near.groupBy("junction", "pair", "start", "end").agg(F.count("*").alias("n"), F.min(F.struct("n_mism", "read_id")).alias("best"), F.min("junct").alias("junct"))
    one = one.withColumn("d", F.least(F.abs(F.col("junct") - F.col("start") + 1), F.abs(F.col("end") - F.col("junct"))))
    out = one.groupBy("junction", "pair").agg(
        F.sum("n").alias("counts"),
        F.count("*").alias("unique"),
        F.max("d").alias("longest"),
        F.round(F.avg("d"), 6).alias("mean_anchor"),
        F.round(F.avg("best.n_mism"), 6).alias("mean_mismatches"),
        F.array_join(F.transform(F.reverse(F.array_sort(F.collect_list("d"))), lambda x: x.cast("string")), ",").alias("anchors"),
    )
    if strict:
        mism, longest = F.col("mean_mismatches"), F.col("longest")
        out = out.where(~((F.col("unique") == 1) & (((mism > 0) & (longest / mism <= 5)) | (longest > 14))))
    first = Window.partitionBy("pair", "anchors").orderBy("junction")
    return out.withColumn("_k", F.row_number().over(first)).where("_k = 1").drop("_k")


def split_junctions(mappings: DataFrame, reads: int = 1, anchor2: int = 40, mismatches: int = 2, mismatches_gap: int = 7) -> DataFrame:
    """Support of exact splice sites. ``mappings``: SITE columns, read_id, start, end, anchor, n_mism, seq, ord.

    A junction sequence with a gap (*n) has its own mismatch limit. Rows that agree in site and place count once; the
    sequence is that of the last row. A site stays with enough unique reads or a long anchor. Returns SITE, unique, longest,
    seq, n_reads; the names of a site's reads, which may be very many, are the rows of ``split_junction_reads``.
    """
    good = _few_mismatches(mappings, mismatches, mismatches_gap)
    out = good.groupBy(*SITE).agg(F.countDistinct(F.struct("start", "end")).alias("unique"), F.max("anchor").alias("longest"), F.max_by("seq", F.struct("ord", "seq")).alias("seq"), F.countDistinct("read_id").alias("n_reads"))
    return supported(out, reads, anchor2)


def _few_mismatches(mappings: DataFrame, mismatches: int, mismatches_gap: int) -> DataFrame:
    limit = F.when(F.instr(F.lower("seq"), "*n") > 0, mismatches_gap).otherwise(mismatches)
    return mappings.where(F.col("n_mism") <= limit)


def split_junction_reads(mappings: DataFrame, sites: DataFrame, mismatches: int = 2, mismatches_gap: int = 7) -> DataFrame:
    """SITE and read_id: the reads behind the rows of ``split_junctions``, one row a read; a sink may join the names."""
    return _few_mismatches(mappings, mismatches, mismatches_gap).select(*SITE, "read_id").distinct().join(sites.select(*SITE), SITE)


def trimmed_coordinates(sizes: Column, starts: Column, size: int = 40, left: bool = True) -> Column:
    """Block coordinates cut to ``size`` bases next to the junction: an array of (start, end)."""
    blocks = F.zip_with(starts, sizes, lambda s, n: F.struct(s.alias("s"), (s + n).alias("e")))
    ordered = F.reverse(blocks) if left else blocks
    zero = F.struct(F.lit(size).alias("left"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))

    def step(acc: Column, b: Column) -> Column:
        take = F.least(acc["left"], b["e"] - b["s"])
        part = F.struct((b["e"] - take).alias("s"), b["e"].alias("e")) if left else F.struct(b["s"].alias("s"), (b["s"] + take).alias("e"))
        return F.struct((acc["left"] - take).alias("left"), F.when(take > 0, F.concat(acc["out"], F.array(part))).otherwise(acc["out"]).alias("out"))

    out = F.aggregate(ordered, zero, step)["out"]
    return F.reverse(out) if left else out


def supported(report: DataFrame, unique: int = 1, longest: int = 40) -> DataFrame:
    """F13."""
    return report.where((F.col("unique") >= unique) | (F.col("longest") >= longest))


def first_per_junction(report: DataFrame) -> DataFrame:
    """The best row per pair of coordinates, by (unique desc, longest desc, mismatches)."""
    w = Window.partitionBy("pos_1", "pos_2").orderBy(F.desc("unique"), F.desc("longest"), "mean_mismatches", "junction")
    return report.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def evidence(pair_reads: DataFrame, junction_reads: DataFrame) -> DataFrame:
    """R1, SNK5: fusion, read_id, role: reads that support the pair, the junction, or both."""
    both = pair_reads.select("fusion", "read_id", F.lit(1).alias("p"), F.lit(0).alias("j")).union(junction_reads.select("fusion", "read_id", F.lit(0), F.lit(1)))
    role = F.when((F.col("p") == 1) & (F.col("j") == 1), "_supports_fusion_pair_and_junction").when(F.col("p") == 1, "_supports_fusion_pair").otherwise("_supports_fusion_junction")
    return both.groupBy("fusion", "read_id").agg(F.max("p").alias("p"), F.max("j").alias("j")).select("fusion", "read_id", role.alias("role"))


def merge_reports(reports: list[tuple[DataFrame, str]], labels: DataFrame, common: DataFrame, reads: int = 2, pairs: int = 2) -> DataFrame:
    """R3, J20, SET6, SO4: all methods' rows with enough support, their pair's labels and common mapping reads.

    Reports have g_1, g_2, pos_1, pos_2, exon_1, exon_2, pairs, reads, longest; ``labels``: g_lo, g_hi, labels (array).
    """
    rows = union_labels(reports).where((F.col("reads") >= reads) & (F.col("pairs") >= pairs))
    rows = rows.withColumn("g_lo", F.least("g_1", "g_2")).withColumn("g_hi", F.greatest("g_1", "g_2")).join(labels, ["g_lo", "g_hi"])
    rows = rows.join(common.select("g_lo", "g_hi", F.col("n").alias("common_n")), ["g_lo", "g_hi"], "left")
    return rows.withColumn("common_n", F.coalesce("common_n", F.lit(0))).drop("g_lo", "g_hi")


#: Which set of distance labels becomes which label (fixed values).
GAPS = {
    ("dist200kbp", "dist100kbp", "dist10kbp", "dist1000bp"): "gap<1K",
    ("dist200kbp", "dist100kbp", "dist10kbp"): "1K<gap<10K",
    ("dist200kbp", "dist100kbp"): "10K<gap<100K",
    ("dist200kbp",): "100K<gap<200K",
}


def distance_bucket(labels: Column) -> Column:
    """The set of distance labels decides; the empty string for a set that isn't listed."""
    have = F.array_sort(F.array_distinct(F.filter(labels, lambda x: x.startswith("dist"))))
    out = F.lit("")
    for names, gap in GAPS.items():
        out = F.when(have == F.array(*[F.lit(x) for x in sorted(names)]), gap).otherwise(out)
    return out


def squish(merged: DataFrame) -> DataFrame:
    """One row per (pos_1, pos_2, g_1, g_2), the first in report order; methods joined, exons filled from the last row that
    has them. Distance labels become one label at the end; only then short_distance goes too. Loci get their names (S18).

    The first row, the last exons and the methods come from one aggregate, so rows combine before the shuffle.
    """
    keys = ["pos_1", "pos_2", "g_1", "g_2"]
    order = F.struct(-F.col("pairs"), -F.col("reads"), -F.col("longest"), "method", "exon_1", "exon_2")
    rest = [c for c in merged.columns if c not in (*keys, "method")]
    rows = merged.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), order).alias("_r"),
        F.max_by(F.struct("exon_1", "exon_2"), F.when(F.col("exon_1") != "", order)).alias("_x"),
        F.array_join(F.array_sort(F.collect_set("method")), ";").alias("methods"),
    )
    rows = rows.select(*keys, "_r.*", "methods", "_x")
    rows = rows.withColumns({f"exon_{i}": F.when(F.col("exon_1") != "", F.col(f"exon_{i}")).otherwise(F.coalesce(F.col(f"_x.exon_{i}"), F.lit(""))) for i in (1, 2)}).drop("_x")
    if "symbol_1" in rows.columns:
        rows = rename_loci(rows)
    plain = F.filter("labels", lambda x: (x != "short_distance") & ~x.startswith("dist"))
    far = F.exists("labels", lambda x: x.startswith("dist"))
    return rows.withColumn("labels", F.when(far, F.concat(plain, F.array(distance_bucket(F.col("labels"))))).otherwise(F.col("labels")))


def report_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("pairs"), "symbol_1", "symbol_2", F.desc("reads"), F.desc("longest"), "methods")


def rename_loci(df: DataFrame) -> DataFrame:
    """S18 on both symbols."""
    return df.withColumn("symbol_1", locus_name("symbol_1")).withColumn("symbol_2", locus_name("symbol_2"))


def label_found(report: DataFrame, pairs: DataFrame, label: str, ordered: bool = False) -> DataFrame:
    """Labels report rows whose gene pair is in ``pairs`` (g_1, g_2), in either order unless ``ordered``."""
    wanted = pairs.select("g_1", "g_2")
    if not ordered:
        wanted = wanted.union(pairs.select("g_2", "g_1"))
    hit = wanted.distinct().withColumn("_hit", F.lit(True))
    return with_label(report.join(hit, ["g_1", "g_2"], "left"), F.col("_hit"), label).drop("_hit")


def label_reciprocal(report: DataFrame) -> DataFrame:
    """Both directions of a pair reported: reciprocal; and rt_circ_rna if any row of the two is a readthrough."""
    through = F.exists("labels", lambda x: F.instr(x, "readthrough") > 0).cast("int")
    pairs = report.groupBy("g_1", "g_2").agg(F.max(through).alias("r"))
    both = pairs.alias("a").join(pairs.select(F.col("g_1").alias("g_2"), F.col("g_2").alias("g_1"), F.col("r").alias("r2")), ["g_1", "g_2"]).where("g_1 <> g_2")
    both = both.select("g_1", "g_2", F.lit(True).alias("_rec"), (F.greatest("r", "r2") == 1).alias("_circ"))
    out = report.join(both, ["g_1", "g_2"], "left")
    return with_label(with_label(out, F.col("_rec"), "reciprocal"), F.col("_circ"), "rt_circ_rna").drop("_rec", "_circ")


def label_exon_exon(report: DataFrame, exons: DataFrame, label: str = "exon-exon") -> DataFrame:
    """Both fusion points lie on an exon border: the 5' gene's exon ends and the 3' gene's exon begins there.

    ``report``: g_i, chrom_i, strand_i, at_i; ``exons``: gene, chrom, strand, start, end.
    """
    up = F.col("strand").isin("+", "1")
    ends = exons.select("gene", "chrom", "strand", F.when(up, F.col("end")).otherwise(F.col("start")).alias("at")).distinct().withColumn("_b", F.lit(True))
    begins = exons.select("gene", "chrom", "strand", F.when(up, F.col("start")).otherwise(F.col("end")).alias("at")).distinct().withColumn("_b", F.lit(True))
    out = report.join(ends.toDF("g_1", "chrom_1", "strand_1", "at_1", "_e"), ["g_1", "chrom_1", "strand_1", "at_1"], "left")
    out = out.join(begins.toDF("g_2", "chrom_2", "strand_2", "at_2", "_s"), ["g_2", "chrom_2", "strand_2", "at_2"], "left")
    return with_label(out, F.coalesce(F.col("_e") & F.col("_s"), F.lit(False)), label).drop("_e", "_s")


WIGGLE = 20


class Wiggle:
    """The greedy rule of J-F2 over the rows of one group in report order. Kept rows lie in squares of ``width`` bases, so a
    row meets those of nine squares; of kept rows at one place only those that no other outdoes are remembered."""

    def __init__(self, width: int):
        self.width, self.kept = max(1, width), {}

    def keep(self, pairs: int, reads: int, at_1: int, at_2: int, exempt: bool) -> bool:
        w = self.width
        a, b = at_1 // w, at_2 // w
        if not exempt:
            for i in (a - 1, a, a + 1):
                for j in (b - 1, b, b + 1):
                    for (x, y), best in self.kept.get((i, j), {}).items():
                        if abs(x - at_1) <= w and abs(y - at_2) <= w and any(p >= pairs and r >= reads for p, r in best):
                            return False
        place = self.kept.setdefault((a, b), {})
        place[at_1, at_2] = [*((p, r) for p, r in place.get((at_1, at_2), ()) if p > pairs or r > reads), (pairs, reads)]
        return True


def filter_wiggle(report: DataFrame, wiggle: int = WIGGLE) -> DataFrame:
    """J-F2: within an ordered gene pair, in report order (ord), drops rows that lie within ``wiggle`` bases of a kept row
    with at least their support; rows labelled exon-exon stay. Only rows on one chromosome and strand pair can match, so
    these make the groups; a task streams through its sorted groups and remembers the kept rows of the current one. The rule
    reads rows in order, so a group is one task's; its work is linear in the group. Rows pass through as Arrow batches."""
    keys = ["g_1", "g_2", "chrom_1", "strand_1", "chrom_2", "strand_2"]
    rows = report.withColumn("_exempt", F.coalesce(F.array_contains("labels", "exon-exon"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, Wiggle(wiggle)
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*keys, "pairs", "reads", "at_1", "at_2", "_exempt")]
            mask = []
            for *key, pairs, reads, at_1, at_2, exempt in zip(*cols, strict=True):
                if key != last:
                    last, state = key, Wiggle(wiggle)
                mask.append(state.keep(pairs, reads, at_1, at_2, exempt))
            yield batch.drop_columns(["_exempt"]).filter(pa.array(mask, pa.bool_()))

    return rows.repartition(*keys).sortWithinPartitions(*keys, "ord").mapInArrow(run, report.schema)


def filter_sequences(report: DataFrame, banned: DataFrame, window: int = 30) -> tuple[DataFrame, DataFrame]:
    """rows whose window around the * isn't banned, and the removed ones. ``banned``: seq."""
    keys = banned.select(junction_window("seq", window).alias("_k")).distinct()
    rows = report.withColumn("_k", junction_window("seq", window))
    return rows.join(keys, "_k", "left_anti").drop("_k"), rows.join(keys, "_k", "left_semi").drop("_k")


def inspect_sequences(report: DataFrame, poly: int = 15, short: float = 1.4, long: float = 4.5) -> DataFrame:
    """F16: labels for repeats and one-base runs in the junction sequence, without its marks."""
    bare = F.upper(F.translate("seq", "*N ", ""))
    rows = report.withColumn("_s", bare).withColumn("_a", F.round(codelength(bare, 24, 2), 2)).withColumn("_l", F.when(F.length(bare) > 50, F.round(codelength(bare, 50, 9), 2)))
    more = [F.when(F.col("_a") < short, F.array(F.lit("short_repeats"), F.concat(F.lit("sr"), F.format_number("_a", 2)))), F.when(F.col("_l") < long, F.array(F.lit("long_repeats"), F.concat(F.lit("lr"), F.format_number("_l", 2))))]
    more += [F.when(F.instr(F.col("_s"), b * poly) > 0, F.array(F.lit(f"poly{b}"))) for b in "ACGT"]
    empty = F.array().cast("array<string>")
    return rows.withColumn("labels", F.concat("labels", *[F.coalesce(m, empty) for m in more])).drop("_s", "_a", "_l")


def repeat_free(inspected: DataFrame, poly: bool = True, short: bool = True, long: bool = True) -> tuple[DataFrame, DataFrame]:
    """F16: rows without the asked labels of ``inspect_sequences``, and the removed ones."""
    names = [*([f"poly{b}" for b in "ACGT"] if poly else []), *(["short_repeats"] if short else []), *(["long_repeats"] if long else [])]
    hit = F.arrays_overlap("labels", F.array(*map(F.lit, names))) if names else F.lit(False)
    hit = F.coalesce(hit, F.lit(False))
    return inspected.where(~hit), inspected.where(hit)


def smooth_junctions(reads: DataFrame, width: int = 3) -> DataFrame:
    """Reads at cuts within ``width`` of another cut of the same pair also count there. ``reads``: key, cut_1, cut_2,
    read_id, seq_1, seq_2. A read keeps one row per cut, its own first; sequences are trimmed to the common cut."""
    cuts = reads.select("key", F.col("cut_1").alias("c1"), F.col("cut_2").alias("c2")).distinct()
    near = reads.join(cuts, "key").where(f"abs(cut_1 - c1) <= {width} and abs(cut_2 - c2) <= {width}")
    own = ((F.col("cut_1") == F.col("c1")) & (F.col("cut_2") == F.col("c2"))).cast("int")
    over = F.greatest(F.lit(0), F.col("cut_1") - F.col("c1"))
    rows = near.withColumn("_own", own).withColumn("seq_1", F.substring("seq_1", F.lit(1), F.length("seq_1") - over)).withColumn("seq_2", F.substring("seq_2", F.greatest(F.lit(0), F.col("c2") - F.col("cut_2")) + 1, F.length("seq_2")))
    w = Window.partitionBy("key", "c1", "c2", "read_id").orderBy(F.desc("_own"), "cut_1", "cut_2")
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").select("key", F.col("c1").alias("cut_1"), F.col("c2").alias("cut_2"), "read_id", "seq_1", "seq_2")


HIT = "struct<transcript:string,n:bigint,utr:bigint,last:boolean>"


def breakpoint_class(features: DataFrame, points: DataFrame) -> DataFrame:
    """R8, first half: where a point lies in its gene, and its place in each coding transcript.

    ``features``: gene, transcript, feature (exon or CDS), chrom, strand, start, end; ``points``: id, gene, chrom, at, strand.
    Kinds: --- for a gene without exons; intergenic; intronic, between two exons of a transcript; exonic(no-known-CDS); UTR;
    CDS; CDS(no-known-start-or-end) if only coding sequences with a length not divisible by three have the point. Features
    count only on the point's chromosome and strand. Returns id, kind, hits: transcript, n (place in the coding sequence), utr
    (bases of the transcript before it), last (n is its last base). Coding sequences of other lengths give no hits.
    """
    up = F.col("strand") == "+"
    parts = {k: features.where(F.col("feature") == k).groupBy("gene", "transcript", "chrom", "strand").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(k)) for k in ("exon", "CDS")}
    shape = parts["exon"].join(parts["CDS"], ["gene", "transcript", "chrom", "strand"], "left")
    about = features.groupBy("gene").agg(F.max(F.col("feature") == "exon").alias("known"), F.max(F.col("feature") == "CDS").alias("coding"))
    at = F.col("at")
    total = lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda a, e: a + e["end"] - e["start"] + 1)
    upto = lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda a, e: a + F.greatest(F.lit(0), F.least(e["end"], at) - e["start"] + 1))
    inside = lambda x: F.exists(x, lambda e: (e["start"] <= at) & (at <= e["end"]))
    place = lambda x: F.when(up, upto(x)).otherwise(total(x) - upto(x) + 1)
    met = points.join(shape, ["gene", "chrom", "strand"])
    in_cds = F.coalesce(inside(F.col("CDS")), F.lit(False))
    whole = total(F.col("CDS")) % 3 == 0
    n = place(F.col("CDS"))
    last = F.when(up, at == F.element_at("CDS", -1)["end"]).otherwise(upto(F.col("CDS")) == 1)
    between = F.exists("exon", lambda e: e["end"] < at) & F.exists("exon", lambda e: e["start"] > at)
    one = met.select("id", inside(F.col("exon")).alias("e"), between.alias("i"), (in_cds & ~whole).alias("odd"), F.when(in_cds & whole, F.struct("transcript", n.alias("n"), (place(F.col("exon")) - n).alias("utr"), last.alias("last"))).alias("h"))
    seen = one.groupBy("id").agg(F.max("e").alias("e"), F.max("i").alias("i"), F.max("odd").alias("odd"), F.array_sort(F.collect_list("h")).alias("hits"))
    out = points.join(about, "gene", "left").join(seen, "id", "left")
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    kind = F.when(~has("known"), "---").when(F.size("hits") > 0, "CDS").when(has("odd"), "CDS(no-known-start-or-end)").when(has("e") & has("coding"), "UTR").when(has("e"), "exonic(no-known-CDS)").when(has("i"), "intronic").otherwise("intergenic")
    return out.select("id", kind.alias("kind"), F.coalesce("hits", F.array().cast(f"array<{HIT}>")).alias("hits"))


def frame_pairs(hits_1: Column, hits_2: Column) -> Column:
    """All pairs of transcripts: a, b and whether the frame goes on; only the in-frame ones if there are any."""
    pairs = F.flatten(F.transform(hits_1, lambda a: F.transform(hits_2, lambda b: F.struct(((a["n"] % 3) == ((b["n"] - 1) % 3)).alias("ok"), a.alias("a"), b.alias("b")))))
    good = F.filter(pairs, lambda p: p["ok"])
    return F.when(F.size(good) > 0, good).otherwise(pairs)


def predicted_effect(kind_1: Column, hits_1: Column, kind_2: Column, hits_2: Column) -> tuple[Column, Column]:
    """R8, second half: the effect, and the in-frame (else all) transcript pairs as T1:n/T2:n, places in the transcripts."""
    pairs = frame_pairs(hits_1, hits_2)
    both = (kind_1 == "CDS") & (kind_2 == "CDS")
    one = F.when(kind_1 == "CDS", F.when(F.exists(hits_1, lambda h: h["last"]), "CDS(complete)").otherwise("CDS(truncated)")).otherwise(kind_1)
    two = F.when(kind_2 == "CDS", F.when(F.exists(hits_2, lambda h: h["n"] == 1), "CDS(complete)").otherwise("CDS(truncated)")).otherwise(kind_2)
    effect = F.when(both, F.when(F.exists(pairs, lambda p: p["ok"]), "in-frame").otherwise("out-of-frame")).otherwise(F.concat(one, F.lit("/"), two))
    place = lambda h: F.concat(h["transcript"], F.lit(":"), (h["utr"] + h["n"]).cast("string"))
    names = F.array_join(F.transform(pairs, lambda p: F.concat(place(p["a"]), F.lit("/"), place(p["b"]))), ";")
    return effect, F.when(both, names).otherwise("")


def fused_protein(seq_1: Column, hit_1: Column, seq_2: Column, hit_2: Column) -> Column:
    """The protein, without its stop, of the first transcript's coding sequence up to its place and the second transcript from
    its place on; empty if a sequence isn't known."""
    first = F.substring(seq_1, (hit_1["utr"] + 1).cast("int"), hit_1["n"].cast("int"))
    second = F.substring(seq_2, (hit_2["utr"] + hit_2["n"]).cast("int"), F.length(seq_2))
    return F.coalesce(F.rtrim(translate_dna(F.concat(first, second)), F.lit("*")), F.lit(""))


def vcf_rows(report: DataFrame) -> DataFrame:
    """SNK6: two breakend rows per fusion: ord, end, chrom, pos, id, ref, alt, qual, filter, info.

    ``report``: ord, symbol_i, g_i, chrom_i, at_i, strand_i, pairs, reads, labels[, effect, seq]. If a symbol pair occurs more
    than once, its ids end in the row's place in the whole report, from 0. The mate's strand decides the bracket. A junction
    sequence with a gap of N has twenty N beside its breakends.
    """
    pair = F.concat("symbol_1", F.lit("--"), "symbol_2")
    often = report.groupBy(pair.alias("_x")).agg(F.count("*").alias("_n"))
    rows = with_rank(report, "ord", "_i").withColumn("_x", pair).join(often, "_x")
    tail = F.when(F.col("_n") > 1, F.concat(F.lit("__"), F.col("_i").cast("string"))).otherwise("")
    event, ids = F.concat("_x", tail), [F.concat("_x", F.lit(f"__{e}"), tail) for e in ("5", "3")]
    place = [F.concat(f"chrom_{i}", F.lit(":"), F.col(f"at_{i}").cast("string")) for i in (1, 2)]
    gap = F.when(F.col("seq").contains("*NNNNNN"), "N" * 20).otherwise("") if "seq" in report.columns else F.lit("")
    alt5 = F.when(F.col("strand_2") == "-", F.concat(F.lit("N]"), place[1], F.lit("]"))).otherwise(F.concat(F.lit("N["), place[1], F.lit("[")))
    alt3 = F.when(F.col("strand_1") == "-", F.concat(F.lit("]"), place[0], F.lit("]N"))).otherwise(F.concat(F.lit("["), place[0], F.lit("[N")))
    alts = F.concat(gap, alt5), F.concat(alt3, gap)
    described = F.array_join("labels", ",")
    effect = F.coalesce(F.col("effect"), F.lit("")) if "effect" in report.columns else F.lit("")

    def info(k: int) -> Column:
        told = [("MATEID", ids[2 - k]), ("EVENT", event), None, ("FUSION", F.col("_x")), ("END", F.lit("53"[k - 1])), ("STRAND", F.col(f"strand_{k}")), ("SR", F.col("reads").cast("string")), ("SP", F.col("pairs").cast("string"))]
        told += [("GENE5", F.col("symbol_1")), ("GENS5", F.col("g_1")), ("GENE3", F.col("symbol_2")), ("GENS3", F.col("g_2")), ("EFFECT", effect), ("DESC", described)]
        published = F.when(described.contains("known"), "PUBLISHED")
        return F.concat_ws(";", F.lit("SVTYPE=BND"), *[published if x is None else F.concat(F.lit(x[0] + "="), x[1]) for x in told])

    ends = [F.struct(F.lit(k).alias("end"), F.col(f"chrom_{k}").alias("chrom"), F.col(f"at_{k}").alias("pos"), ids[k - 1].alias("id"), alts[k - 1].alias("alt"), info(k).alias("info")) for k in (1, 2)]
    out = rows.select("ord", F.explode(F.array(*ends)).alias("r"))
    return out.select("ord", "r.end", "r.chrom", "r.pos", "r.id", F.lit("N").alias("ref"), "r.alt", F.lit(".").alias("qual"), F.lit("PASS").alias("filter"), "r.info")


#: Parts of labels that make a pair known, and those that make it doubtful (fixed values).
KNOWN = ("known", "tcga", "cosmic", "prostates", "pancreases", "chimer", "mitelman", "cgp", "pcawg", "ccle", "oncokb", "cacg", "18cancer", "metastasis", "glioma", "oesophag")
DOUBTFUL = ("healthy", "conjoing", "hpa", "banned", "paralogs", "1000genomes", "cortex", "repeat", "known_rt_circ_rna", "poly", "sr1.", "sr0.", "gtex", "tcga-normal", "pseudogene", "bodymap", "ribosomal")
#: Phrases of the summary (fixed values), in order.
PHRASES = {"reciprocal": "reciprocal fusion", "known": "already known fusion", "doubtful": "probably false positive", "readthrough": "readthrough", "circular": "rt-circRNA", "exons": "exon-exon fusion junction", "novel": "probably novel fusion"}


def summary(report: DataFrame) -> DataFrame:
    """One row per unordered symbol pair, in first-appearance order: ord, pair (as in its first row), phrases.

    Names of labels match as parts of the joined label text, in any case, in any row of the pair. A pair is reciprocal if
    the report has it in both directions (or a symbol with itself). It is novel unless it is known, doubtful, a
    readthrough or a circular transcript.
    """
    text = F.lower(F.array_join("labels", ","))
    has = lambda names: F.max(F.greatest(*[(F.instr(F.col("l"), x) > 0).cast("int") for x in names], F.lit(0)))
    rows = report.select("ord", F.upper("symbol_1").alias("a"), F.upper("symbol_2").alias("b"), text.alias("l"))
    found = rows.groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(
        F.min("ord").alias("ord"),
        F.min_by(F.concat("a", F.lit("--"), "b"), "ord").alias("pair"),
        ((F.max((F.col("a") <= F.col("b")).cast("int")) == 1) & (F.max((F.col("a") >= F.col("b")).cast("int")) == 1)).alias("reciprocal"),
        *[(has(names) == 1).alias(name) for name, names in (("known", KNOWN), ("doubtful", DOUBTFUL), ("readthrough", ("readthrough",)), ("circular", ("rt_circ_rna",)), ("exons", ("exon-exon",)))],
    )
    found = found.withColumn("novel", ~(F.col("known") | F.col("doubtful") | F.col("readthrough") | F.col("circular")))
    return found.select("ord", "pair", F.concat_ws("; ", *[F.when(F.col(name), text) for name, text in PHRASES.items()]).alias("phrases"))


def summary_counts(report: DataFrame) -> DataFrame:
    """Genes, the unordered symbol pairs, and transcripts, the different symbols and fusion points, of a report."""
    a, b = F.upper("symbol_1"), F.upper("symbol_2")
    ends = [F.struct(f"chrom_{i}", f"at_{i}", f"strand_{i}") for i in (1, 2)]
    return report.agg(F.countDistinct(F.struct(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"))).alias("genes"), F.countDistinct(F.struct(a.alias("a"), b.alias("b"), ends[0].alias("p"), ends[1].alias("q"))).alias("transcripts"))


#: Parts cut out of the names of virus genomes, in this order (fixed values).
GENOME_WORDS = (",_complete_genome", "_complete_genome", "_complete_wild_type_genome", "genome", "complete", "wild", "wild_type", "__", "__")


def top_viruses(viruses: DataFrame, most: int = 3) -> DataFrame:
    """The first ``most`` different names (``ord``, n, name) with virus in them and a count other than 1: ord, name. Names
    end before ``,_`` and lose the words of GENOME_WORDS before they are compared."""
    name = F.split("name", ",_")[0]
    for word in GENOME_WORDS:
        name = F.replace(name, F.lit(word), F.lit(""))
    named = viruses.where("n <> 1 and instr(name, 'virus') > 0").select("ord", F.replace(name, F.lit("_"), F.lit(" ")).alias("name"))
    return named.groupBy("name").agg(F.min("ord").alias("ord")).orderBy("ord").limit(most).select("ord", "name")


def summary_lines(report: DataFrame, viruses: DataFrame | None = None) -> list[str]:
    """SNK7: the summary as lines of text. A report's fusions are the result of one run, so its lines reach the driver."""
    counts = summary_counts(report).first()
    lines = ["Very short summary of found candidate somatic fusion genes", "=" * 55 + " ====", ""]
    names = [r.name for r in top_viruses(viruses).collect()] if viruses is not None else []
    if names:
        lines += ["The input sample contains sequencing reads mapping on: '%s'." % "', '".join(names), ""]
    if not counts.genes:
        return [*lines, "No somatic fusion genes found.", "", "No somatic fusion transcripts found."]
    lines.append(f"Found {counts.genes} somatic fusion gene(s), which are as follows:")
    lines += [f"  * {r.pair}" + (f"  ({r.phrases})" if r.phrases else "") for r in summary(report).orderBy("ord").collect()]
    return [*lines, "", f"Found {counts.transcripts} somatic fusion transcript(s).", ""]


def matched_normals(tumour: DataFrame, normals: DataFrame, final: DataFrame, threshold: int = 2) -> DataFrame:
    """Labels pairs that a normal sample reports finally (matched-normal) or with at least ``threshold`` pairs
    preliminarily (partial-matched-normal)."""
    from helixloom.operators.pairs import label_pair_set

    partial = normals.groupBy("g_lo", "g_hi").agg(F.max("n").alias("n"))
    return label_pair_set(label_pair_set(tumour, partial, "partial-matched-normal", threshold), final.select("g_lo", "g_hi").distinct(), "matched-normal")


def split_junctions_trimmed(mappings: DataFrame, size: int = 40, reads: int = 1, anchor2: int = 150, mismatches: int = 30) -> DataFrame:
    """Support of junctions whose blocks agree within ``size`` bases of the splice site.

    ``mappings``: SITE columns, read_id, anchor, n_mism, sizes_1, starts_1, sizes_2, starts_2 (blocks on either side), seq, ord. A site is the
    pair of genes with the trimmed block coordinates on both sides; rows count by distinct untrimmed coordinates.
    """
    text = lambda blocks: F.array_join(F.transform(blocks, lambda b: F.concat(b["s"].cast("string"), F.lit("-"), b["e"].cast("string"))), ",")
    rows = mappings.where(F.col("n_mism") <= mismatches)
    rows = rows.withColumn("left", text(trimmed_coordinates(F.col("sizes_1"), F.col("starts_1"), size, True))).withColumn("right", text(trimmed_coordinates(F.col("sizes_2"), F.col("starts_2"), size, False)))
    rows = rows.withColumn("place", F.concat_ws("|", text(F.arrays_zip(F.col("starts_1").alias("s"), F.col("sizes_1").alias("e"))), text(F.arrays_zip(F.col("starts_2").alias("s"), F.col("sizes_2").alias("e")))))
    keys = ["gene_1", "gene_2", "strand_1", "strand_2", "left", "right"]
    out = rows.groupBy(*keys).agg(F.countDistinct("place").alias("unique"), F.max("anchor").alias("longest"), F.max_by("seq", F.struct("ord", "seq")).alias("seq"), F.countDistinct("read_id").alias("n_reads"))
    return out.where((F.col("unique") >= reads) | (F.col("longest") >= anchor2))


def predict_frame(report: DataFrame, features: DataFrame, transcripts: DataFrame | None = None) -> DataFrame:
    """Adds effect, transcripts and, with the ``transcripts`` sequences (transcript, seq), proteins: one for each of
    the named transcript pairs, in or out of frame, empty where a sequence isn't known.

    ``report``: ord, g_i, chrom_i, at_i, strand_i; ``features`` as for ``breakpoint_class``.
    """
    ends = [report.select(F.concat(F.col("ord").cast("string"), F.lit(f"/{i}")).alias("id"), *[F.col(f"{c}_{i}").alias(n) for c, n in (("g", "gene"), ("chrom", "chrom"), ("at", "at"), ("strand", "strand"))]) for i in (1, 2)]
    kinds = breakpoint_class(features, ends[0].union(ends[1]))
    sides = [kinds.where(F.col("id").endswith(f"/{i}")).select(F.expr("left(id, length(id) - 2)").alias("_o"), F.col("kind").alias(f"_k{i}"), F.col("hits").alias(f"_h{i}")) for i in (1, 2)]
    rows = report.withColumn("_o", F.col("ord").cast("string")).join(sides[0], "_o").join(sides[1], "_o")
    effect, names = predicted_effect(F.col("_k1"), F.col("_h1"), F.col("_k2"), F.col("_h2"))
    out = rows.withColumn("effect", effect).withColumn("transcripts", names)
    if transcripts is not None:
        pairs = rows.where("_k1 = 'CDS' and _k2 = 'CDS'").select("_o", F.posexplode(frame_pairs(F.col("_h1"), F.col("_h2"))).alias("i", "p"))
        pairs = pairs.select("_o", "i", "p.*").join(transcripts.toDF("_t1", "_s1"), F.col("a.transcript") == F.col("_t1"), "left").join(transcripts.toDF("_t2", "_s2"), F.col("b.transcript") == F.col("_t2"), "left")
        made = pairs.select("_o", F.struct("i", fused_protein(F.col("_s1"), F.col("a"), F.col("_s2"), F.col("b")).alias("x")).alias("p"))
        proteins = made.groupBy("_o").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["x"]), ";").alias("proteins"))
        out = out.join(proteins, "_o", "left").withColumn("proteins", F.coalesce("proteins", F.lit("")))
    return out.drop("_o", "_k1", "_k2", "_h1", "_h2")
