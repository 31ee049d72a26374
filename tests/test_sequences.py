import bz2
import gzip
import math
import random
import time
import zipfile
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helixloom.functions import seq as S
from helixloom.operators import alignments, annotation, reads, report
from helixloom.operators.ranks import with_rank
from helixloom.sources import readers, sinks


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr).first()[0]


def test_scalars(spark):
    assert one(spark, "ACGTN", S.reverse_complement("x")) == "AACGT"
    assert one(spark, "frag/1", S.flip_mate("x")) == "frag/2"
    assert one(spark, "5:A>C,9:G>T", S.mismatches("x")) == 2
    assert one(spark, "ACGT", S.junction_star("x", F.lit(2))) == "AC*GT"
    assert one(spark, "aacc*ggtt", S.junction_window("x", 2)) == "CC*GG"
    assert one(spark, "aaccggtt", S.junction_window("x", 2)) == ""
    assert one(spark, "ATGGCCTAAGGG", S.translate_dna("x")) == "MA*"
    assert one(spark, "7", S.zero_pad("x", 3)) == "007" and one(spark, "1234", S.zero_pad("x", 3)) == "1234"
    assert one(spark, "Actin like 3 pseudogene [Source:X] (fragment)", S.clean_description("x")) == "actin like 3"
    assert one(spark, "bcr--abl1", S.pair_symbols("x")) == ["BCR", "ABL1"]
    assert one(spark, 'gene_id "G1"; gene_name "X";', S.gtf_attributes("x")) == {"gene_id": "G1", "gene_name": "X"}
    assert one(spark, "igh_locus", S.locus_name("x")) == "IGH@" and one(spark, "Igk_Locus_2", S.locus_name("x")) == "IGK@" and one(spark, "IGHM", S.locus_name("x")) == "IGHM"
    assert one(spark, 'gene_id "G1"; tag "basic"; exon_number 3; tag "CCDS"; note "two words";', S.gtf_attributes("x")) == {"gene_id": "G1", "tag": "CCDS", "exon_number": "3"}


def test_window_entropy():
    def slow(s, w, k):
        out = []
        for i in range(len(s) - min(len(s), w) + 1):
            part = s[i : i + w]
            c = Counter(part[j : j + k] for j in range(len(part) - k + 1))
            n = sum(c.values())
            out.append(-sum(v / n * math.log2(v / n) for v in c.values()))
        return min(out)

    for s in ("ACGTTGCAACGTGGGGTTACACACACACACACACACACATTT", "AAAA", "ACG", "AC"):
        assert abs(S.window_entropy(s, 24, 2) - slow(s, 24, 2)) < 1e-9
    assert S.window_entropy("A", 24, 2) is None


def test_read_transformations(spark):
    r = spark.createDataFrame([("a/1", "NNACGTACGTAAAAAAAAAAAA", "I" * 22)], "read_id string, seq string, qual string")
    assert reads.trim(r, size=12).first().seq == "NNACGTACGT"
    assert reads.trim(r, final_size=3, end=5).first().seq == "AAA"
    assert reads.trim_poly_tails(r, least=1).first().seq == "ACGTACGT"
    assert reads.mask_low_quality(spark.createDataFrame([("a", "ACGT", "IIBB")], "read_id string, seq string, qual string")).first().seq == "ACNN"
    two = spark.createDataFrame([("a", "ACGTA", "IBIIB"), ("b", "ACGTA", "IIIII"), ("c", "ACGTA", "IIIBB")], "read_id string, seq string, qual string")
    assert [(x.seq, x.qual) for x in reads.mask_low_quality(two, find=True).orderBy("read_id").collect()] == [("ANNNN", "IBBBB"), ("ACGTA", "IIIII"), ("ACGNN", "IIIBB")]
    assert [x.read_id for x in reads.mask_low_quality(two, threshold=4).orderBy("read_id").collect()] == ["a", "b"]
    assert reads.pad(r, 24).first().seq.endswith("NN") and reads.pad(two, 7).first().qual == "IBIIBBB"
    assert [x.seq for x in reads.windows(r, 20, 1).orderBy("at").collect()] == ["NNACGTACGTAAAAAAAAAA", "NACGTACGTAAAAAAAAAAA", "ACGTACGTAAAAAAAAAAAA"]
    assert reads.clip_quality(spark.createDataFrame([("a", "ACGTACGTAC", "IIIII!!!!I")], "read_id string, seq string, qual string")).first().seq == "ACGTA"
    assert reads.convert_headers(spark.createDataFrame([("id 1:N:0", "A", "I"), ("x 1:Y:0", "A", "I")], "read_id string, seq string, qual string")).first().read_id == "id/1"
    assert reads.phred_offset(r) == 64 and reads.phred_offset(spark.createDataFrame([('a', 'AC', 'I#')], 'read_id string, seq string, qual string')) == 33
    assert reads.convert_quality(spark.createDataFrame([("a", "AC", "hB")], "read_id string, seq string, qual string"), 64, 33).first().qual == "I#"
    odd = spark.createDataFrame([("a", "ACGTAC", ";@AJhB")], "read_id string, seq string, qual string")
    assert reads.phred_format(odd) == "solexa" and reads.phred_offset(odd) == 64
    # Solexa scores -5, 0, 1, 10, 40, 2 as probabilities: 1, 3, 4, 10, 40, 4
    assert reads.convert_quality(odd, "solexa", "sanger").first().qual == "".join(chr(33 + q) for q in (1, 3, 4, 10, 40, 4))
    assert reads.convert_quality(odd.withColumn("qual", F.lit("!\"#$+I")), "sanger", "illumina-1.5").first().qual == "BBBCJh"
    many = reads.split_at(spark.createDataFrame([("a", "A" * 300, "I" * 300)], "read_id string, seq string, qual string"), spark.createDataFrame([("a", 149)], "read_id string, cut int"), wiggle=60)
    assert many.select("read_id").distinct().count() == many.count() == 242 and many.where("read_id = 'a__100a'").count() == 1
    wide = reads.fragment_pairs(spark.createDataFrame([("f", "A" * 300, "C" * 20)], "frag string, seq_1 string, seq_2 string"), 10, 2, 4)
    assert wide.select("read_id").distinct().count() == wide.count() > 100
    two = spark.createDataFrame([("a", "A" * 20 + "C" * 20, "I" * 20 + "J" * 20)], "read_id string, seq string, qual string")
    at = lambda *cuts: spark.createDataFrame([("a", c) for c in cuts], "read_id string, cut int")
    parts = lambda df: {x.read_id: (x.seq, x.qual) for x in df.collect()}
    assert parts(reads.split_at(two, at(19))) == {"a__00a": ("A" * 20, "I" * 20), "a__00b": ("C" * 20, "J" * 20)}
    assert parts(reads.split_at(two, at(19), reverse_second=True))["a__00b"] == ("G" * 20, "J" * 20)
    # part one of 15 and more, part two of 13 and more bases
    assert {k: len(v[0]) for k, v in parts(reads.split_at(two, at(13, 14, 26, 27))).items()} == {"a__00a": 15, "a__00b": 25, "a__01a": 27, "a__01b": 13}
    # one base between the parts, before and after the cut
    assert {k: len(v[0]) for k, v in parts(reads.split_at(two, at(19), gap=1)).items()} == {"a__00a": 19, "a__00b": 20, "a__01a": 20, "a__01b": 19}
    copies = parts(reads.split_at(two, at(22), anchor_max=18))
    assert {k: len(v[0]) for k, v in copies.items()} == {"a__00a": 23, "a__00b": 17, "a__01a": 18, "a__01b": 17} and copies["a__01a"][0] == "A" * 15 + "CCC"
    assert len(parts(reads.split_at(two, at(18), anchor_max=20))["a__01b"][0]) == 20
    single = reads.half_pairs(spark.createDataFrame([("q/1", "ACCGT", "abcde")], "read_id string, seq string, qual string"), 1).first()
    assert tuple(single) == ("q", "ACCG", "abcd", "ACGG", "edcb")
    pairs = reads.fragment_pairs(spark.createDataFrame([("f", "ABCDEFGHIJ", "abcdefghij")], "frag string, seq_1 string, seq_2 string"), 4, 3, 1, 1)
    assert [(x.read_id, x.seq_1, x.seq_2) for x in pairs.orderBy("read_id").collect()] == [("00_f", "ABCD", "abcd"), ("01_f", "DEFG", "abcd"), ("02_f", "GHIJ", "abcd"), ("03_f", "ABCD", "defg"), ("04_f", "ABCD", "ghij")]


def test_mates(spark):
    left = "ACGTTGCATTACGGATCCATGCAAGT"
    right = one(spark, left[10:] + "GGTTAACC", S.reverse_complement("x", keep_n=True))
    p = spark.createDataFrame([("f", left, right)], "frag string, seq_1 string, seq_2 string")
    laid = reads.mate_overlaps(p).first()
    assert (laid.fragment, laid.shift, laid.mismatches) == (34, 10, 0)
    merged = reads.merge_mates(p.withColumn("qual_1", F.repeat(F.lit("I"), F.length("seq_1"))).withColumn("qual_2", F.repeat(F.lit("J"), F.length("seq_2")))).first()
    assert (merged.merged, merged.merged_qual) == (left + "GGTTAACC", "I" * 26 + "J" * 8)
    long = "".join(random.Random(1).choices("ACGT", k=120))
    worse = list(long)
    for i in range(0, 110, 12):
        worse[i] = {"A": "C", "C": "G", "G": "T", "T": "A"}[worse[i]]
    for other, found in ((worse, None), (worse[:60] + list(long[60:]), 120)):  # 10 and 5 mismatches; log2 of 120 and 2 are 8.9
        pair = spark.createDataFrame([("f", long, one(spark, "".join(other), S.reverse_complement("x")))], "frag string, seq_1 string, seq_2 string")
        assert reads.merge_mates(pair).first().fragment == found
    # a fragment of 60 bases between adapters: mate 2 begins before mate 1
    rng = random.Random(2)
    fragments = ["".join(rng.choices("ACGT", k=60)) for _ in range(30)]
    after, ahead = "AGATCGGAAGAGCACACG", "GTTCAGAGTTCTACAGTC"
    rows = [(f"f{i:02d}", f + after, one(spark, ahead + f, S.reverse_complement("x"))) for i, f in enumerate(fragments[:3])]
    rows += [(f"f{i:02d}", f + after, str(pd.Series([ahead + f])[0][::-1].translate(str.maketrans("ACGT", "TGCA")))) for i, f in enumerate(fragments[3:], 3)]
    through = spark.createDataFrame(rows, "frag string, seq_1 string, seq_2 string")
    assert {(r.fragment, r.merged) for r in reads.merge_mates(through).collect()} == {(60, f) for f in fragments}
    assert reads.adapters(through, first=30) == (after[:13], ahead[-13:]) and reads.adapters(through, first=30_000_000) == (None, None)
    assert reads.flanks(pd.Series([fragments[0] + after]), pd.Series([ahead[-5:] + fragments[0]]), 13) == ([after[:13]], [""])
    texts = spark.createDataFrame([("ACGTACGTACGTA",), ("ACGTTGCATTCGA",), ("AAAAACGTCTGTG",), ("A",), ("",), (None,)], "x string")
    assert [r[0] for r in texts.select(reads.no_repeats(F.col("x"))).collect()] == [True, True, False, True, True, None]
    made = reads.simulated_reads(spark.createDataFrame([("s", "ACGT" * 10)], "id string, seq string"), step=10, gap=5, length=10)
    assert made.count() == 2 and made.first().seq_1 == "ACGTACGTAC"
    ids = reads.short_ids(spark.createDataFrame([("y/1", "A", "I"), ("x/1", "A", "I"), ("x/2", "A", "I")], "read_id string, seq string, qual string"))
    assert sorted(r.read_id[-2:] for r in ids.collect()) == ["/1", "/1", "/2"] and len({r.read_id[:-2] for r in ids.collect()}) == 2
    t = reads.trim_adapter(spark.createDataFrame([("a", "ACGTTGCATTACGGATCCATGCAAGATCGGAAGAGC", "I" * 36)], "read_id string, seq string, qual string"), "AGATCGGAAGAGC", mismatches=0.1)
    assert t.first().seq == "ACGTTGCATTACGGATCCATGCA"


def test_sam_to_psl(spark):
    sam = spark.createDataFrame([("r", 16, "c", 11, "2S5M3N4M1I2M", "A" * 14, 1), ("u", 4, "c", 0, "*", "A", None)], "qname string, flag int, rname string, pos int, cigar string, seq string, nm int")
    row = alignments.sam_to_psl(sam, spark.createDataFrame([("c", 100)], "rname string, length bigint")).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.matches, r.mismatches, r.q_num_insert, r.t_num_insert, r.strand, r.q_size) == (10, 1, 1, 1, "-", 14)
    assert (r.block_sizes, r.q_starts, r.t_starts) == ([5, 4, 2], [2, 7, 12], [10, 18, 22])
    assert (r.t_start, r.t_end, r.q_start, r.q_end) == (10, 24, 2, 14)


def test_split_parts_and_junctions(spark):
    parts = spark.createDataFrame([("q", "t", "+", 1, 0, 20, 100, 120, 20, 0), ("q", "t", "+", 2, 18, 40, 500, 522, 22, 1)], "q_name string, t_name string, strand string, ord int, q_start int, q_end int, t_start int, t_end int, matches int, mismatches int")
    r = alignments.merge_parts(parts).first()
    assert (r.block_sizes, r.q_starts, r.t_starts, r.matches) == ([20, 20], [0, 20], [100, 502], 40)
    psl = spark.createDataFrame([("r", "g1|g2|120", 30, 0, 0, 0, 1, 40, 2, [20, 10], [100, 160], 100, 170, 32)], "q_name string, t_name string, matches int, mismatches int, q_num_insert int, q_base_insert int, t_num_insert int, t_base_insert int, block_count int, block_sizes array<int>, t_starts array<int>, t_start int, t_end int, q_size int")
    assert alignments.fusion_hits(psl).count() == 1
    assert alignments.junction_hits(psl).first().gene_2 == "g2"
    assert alignments.border_anchors(alignments.with_border(psl), 10).first().anchor_1 == 20


def test_frames_and_effects(spark):
    rows = [("G", "T", "exon", 1, 30), ("G", "T", "exon", 50, 80), ("G", "T", "CDS", 10, 30), ("G", "T", "CDS", 50, 58), ("G", "U", "exon", 200, 260), ("G", "U", "CDS", 200, 260), ("N", "V", "exon", 1, 9), ("N", "V", "exon", 20, 30)]
    f = spark.createDataFrame([(*r, c, s) for r in rows for c, s in [("1", "+")]] + [("M", "W", "exon", 1, 30, "2", "-"), ("M", "W", "CDS", 4, 15, "2", "-"), ("M", "W", "CDS", 21, 26, "2", "-"), ("M", "W", "exon", 40, 50, "2", "-")], "gene string, transcript string, feature string, start int, end int, chrom string, strand string")
    points = [(1, "G", "1", 12, "+"), (2, "G", "1", 40, "+"), (3, "G", "1", 70, "+"), (4, "G", "1", 99, "+"), (5, "X", "1", 1, "+"), (6, "G", "1", 58, "+"), (7, "G", "1", 210, "+"), (8, "G", "2", 12, "+"), (9, "G", "1", 12, "-"), (10, "N", "1", 5, "+"), (11, "N", "1", 15, "+"), (12, "M", "2", 5, "-"), (13, "M", "2", 4, "-"), (14, "M", "2", 26, "-")]
    p = spark.createDataFrame(points, "id int, gene string, chrom string, at int, strand string")
    got = {r.id: (r.kind, [tuple(h) for h in r.hits]) for r in report.breakpoint_class(f, p).collect()}
    assert got == {
        1: ("CDS", [("T", 3, 9, False)]), 2: ("intronic", []), 3: ("UTR", []), 4: ("intergenic", []), 5: ("---", []), 6: ("CDS", [("T", 30, 9, True)]),
        7: ("CDS(no-known-start-or-end)", []), 8: ("intergenic", []), 9: ("intergenic", []), 10: ("exonic(no-known-CDS)", []), 11: ("intronic", []),
        # on the reverse strand places count from the end: 18 coding bases, 41 of the transcript
        12: ("CDS", [("W", 17, 20, False)]), 13: ("CDS", [("W", 18, 20, True)]), 14: ("CDS", [("W", 1, 15, False)]),
    }
    hit = "array<struct<transcript:string,n:bigint,utr:bigint,last:boolean>>"
    rows = spark.createDataFrame([("CDS", [("T", 3, 9, False)], "CDS", [("U", 4, 1, False)]), ("CDS", [("T", 3, 9, False)], "CDS", [("U", 5, 0, False)]), ("CDS", [("T", 3, 0, False)], "UTR", []), ("CDS", [("S", 1, 0, False), ("T", 3, 0, True)], "UTR", []), ("intronic", [], "CDS", [("U", 1, 0, False)]), ("intronic", [], "CDS", [("U", 2, 0, True)]), ("UTR", [], "CDS(no-known-start-or-end)", [])], f"k1 string, h1 {hit}, k2 string, h2 {hit}")
    effect, names = report.predicted_effect(F.col("k1"), F.col("h1"), F.col("k2"), F.col("h2"))
    assert [tuple(r) for r in rows.select(effect, names).collect()] == [("in-frame", "T:12/U:5"), ("out-of-frame", "T:12/U:5"), ("CDS(truncated)/UTR", ""), ("CDS(complete)/UTR", ""), ("intronic/CDS(complete)", ""), ("intronic/CDS(truncated)", ""), ("UTR/CDS(no-known-start-or-end)", "")]
    fusions = spark.createDataFrame([(1, "G", "1", 12, "+", "M", "2", 26, "-"), (2, "G", "1", 12, "+", "M", "2", 25, "-"), (3, "G", "1", 40, "+", "M", "2", 26, "-")], "ord int, g_1 string, chrom_1 string, at_1 int, strand_1 string, g_2 string, chrom_2 string, at_2 int, strand_2 string")
    seqs = spark.createDataFrame([("T", "C" * 9 + "ATG" + "G" * 50), ("W", "T" * 15 + "GCCAAATAAGGG" + "C" * 14)], "transcript string, seq string")
    out = {r.ord: (r.effect, r.transcripts, r.proteins) for r in report.predict_frame(fusions, f, seqs).collect()}
    assert out == {1: ("in-frame", "T:12/W:16", "MAK"), 2: ("out-of-frame", "T:12/W:17", "MPNKGPPPP"), 3: ("intronic/CDS(complete)", "", "")}


def test_mates_of_sam_rows(spark):
    rows = [("a/1", 67, "c", 10, "30M", 30, 1), ("a/2", 131, "c", 90, "20M", 20, 1), ("b/1", 83, "c", 10, "30M", 30, 0), ("b/2", 147, "c", 90, "20M", 20, 0), ("d/1", 67, "c", 1, "20M", 20, 2), ("d/2", 131, "c", 9, "30M", 30, 0), ("e/1", 67, "c", 1, "9M", 9, 0), ("e/2", 147, "c", 5, "8M", 8, 0), ("f/1", 65, "c", 1, "9M", 9, 0), ("f/2", 131, "c", 5, "8M", 8, 0)]
    sam = spark.createDataFrame([(q, f, r, p, c, "A" * n, nm) for q, f, r, p, c, n, nm in rows], "qname string, flag int, rname string, pos int, cigar string, seq string, nm int")
    got = {r.frag: (r.cigar_1, r.cigar_2, r.flag_2) for r in alignments.merge_sam_mates(sam, 3, 1).collect()}
    assert got == {"a/": ("30M20H", "30H20M", 131), "b/": ("20H30M", "20M30H", 147)}  # d: two mismatches in a short read
    got = {r.frag: (r.cigar_1, r.cigar_2, r.flag_2) for r in alignments.merge_sam_mates(sam, other_strand=True).collect()}
    assert got == {"e/": ("9M8H", "9H8M", 131)}


def test_ranks(spark):
    for values in ([], [5], list(range(3000, 0, -1)), [x * x for x in range(500)]):
        df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(3)
        got = {r.v: r.k for r in with_rank(df, "v", "k", 8).collect()}
        assert got == {v: i for i, v in enumerate(sorted(values))}
    r = spark.createDataFrame([(f"{i:04d}{'ab'[i % 2]}/{m}", "A", "I") for i in range(700) for m in (1, 2)], "read_id string, seq string, qual string")
    ids = sorted(x.read_id for x in reads.short_ids(r).collect())
    assert len(set(ids)) == 1400 and ids[0] == "00/1" and ids[-1] == "JF/2"


def test_wiggle_of_a_hot_pair():
    rng = random.Random(3)
    rows = [(rng.randint(1, 6), rng.randint(1, 6), rng.randint(0, 300), rng.randint(0, 300), rng.random() < 0.1) for _ in range(3000)]
    state, kept = report.Wiggle(20), []
    for p, r, x, y, free in rows:
        want = free or not any(q >= p and s >= r and abs(u - x) <= 20 and abs(v - y) <= 20 for q, s, u, v in kept)
        assert state.keep(p, r, x, y, free) == want
        if want:
            kept.append((p, r, x, y))


def test_inspect_and_smooth(spark):
    r = spark.createDataFrame([("A" * 20 + "*" + "CACACACACACACACACACACACACA", [])], "seq string, labels array<string>")
    labels = report.inspect_sequences(r).first().labels
    assert "polyA" in labels and "short_repeats" in labels
    reads_ = spark.createDataFrame([("k", 100, 200, "a", "AAAA", "CCCC"), ("k", 102, 200, "b", "AAAAAA", "CCCC")], "key string, cut_1 int, cut_2 int, read_id string, seq_1 string, seq_2 string")
    got = {(x.cut_1, x.read_id): x.seq_1 for x in report.smooth_junctions(reads_).collect()}
    assert got == {(100, "a"): "AAAA", (100, "b"): "AAAA", (102, "b"): "AAAAAA", (102, "a"): "AAAA"}


def test_repeat_free(spark):
    rows = spark.createDataFrame([(1, []), (2, ["polyA", "x"]), (3, ["short_repeats"]), (4, ["long_repeats"])], "i int, labels array<string>")
    ids = lambda df: sorted(r.i for r in df.collect())
    kept, gone = report.repeat_free(rows)
    assert (ids(kept), ids(gone)) == ([1], [2, 3, 4])
    assert ids(report.repeat_free(rows, long=False)[0]) == [1, 4] and ids(report.repeat_free(rows, False, False, False)[1]) == []


def test_shield_regions(spark):
    symbols = spark.createDataFrame([("g1", "ABC"), ("g2", "ABCP1"), ("g3", "ABCP2"), ("g4", "XYZP"), ("g5", "CELP"), ("g6", "RPL5"), ("g7", "CEL"), ("g8", "QQQP7")], "gene string, symbol string")
    pseudo = symbols.where("gene in ('g2', 'g3', 'g4', 'g5', 'g8')").select("gene")
    families = annotation.pseudogene_families(symbols, pseudo)
    assert {(r.base, r.gene, tuple(r.genes)) for r in families.collect()} == {("ABC", "g1", ("g2", "g3"))}
    genes = spark.createDataFrame([("g2", "2", 50, 10), ("g3", "1", 5, 9), ("g4", "1", 7, 8)], "gene string, chrom string, start int, end int")
    assert [tuple(r) for r in annotation.shield_regions(families, genes).collect()] == [("1", 4, 9), ("2", 9, 50)]
    assert [r.chrom for r in annotation.shield_regions(families, genes, symbols.where("gene = 'g3'")).collect()] == ["2"]


def test_gene_classes(spark):
    pairs = spark.createDataFrame([("ENSG00000047932", "ENSG00000047936"), ("ENSG00000047932", "ENSG00000145216")], "g_lo string, g_hi string")
    assert [tuple(r) for r in annotation.conjoined(pairs).collect()] == [("ENSG00000047932", "ENSG00000145216")]
    symbols = spark.createDataFrame([("g1", "IGHV1"), ("g2", "IGF1"), ("g3", "IGKC"), ("g4", "BIGH"), ("g1", "IGHJ")], "gene string, symbol string")
    assert sorted(r.gene for r in annotation.gene_class(symbols, *annotation.GENE_CLASSES["ig"]).collect()) == ["g1", "g3"]


def test_annotation(spark):
    seqs = spark.createDataFrame([("e1", "AC" * 50), ("e2", "GT" * 50)], "id string, seq string")
    exons = spark.createDataFrame([("t", "g", "e2", 2, 1, 100), ("t", "g", "e1", 1, 1, 100)], "transcript string, gene string, exon string, rank int, exon_start int, exon_end int")
    t = annotation.transcripts(exons, seqs).first()
    assert t.seq == "AC" * 50 + "GT" * 50 and [(x.st, x.et) for x in t.exons] == [(1, 100), (101, 200)]
    genome = spark.createDataFrame([("1", "ACGTAC")], "chrom string, seq string")
    genes = spark.createDataFrame([("a", "1", "+", 2, 4), ("b", "1", "-", 5, 8)], "gene string, chrom string, strand string, start int, end int")
    assert {r.gene: r.seq for r in annotation.gene_sequences(genes, genome).collect()} == {"a": "CGT", "b": "NNGT"}
    chroms = spark.createDataFrame([("1",), ("XIV",), ("MT",), ("chr1",), ("HSCHR",), ("",)], "c string")
    assert [r.c for r in chroms.where(annotation.is_chromosome(F.col("c"))).collect()] == ["1", "XIV", "MT"]


def test_places_in_a_transcript_of_many_exons(spark):
    n = 30_000
    exons = spark.range(n).selectExpr("'t' transcript", "'g' gene", "id exon", "cast(id as int) rank", "1 exon_start", "2 exon_end")
    seqs = spark.range(n).selectExpr("id", "case when id <> 5 then repeat('A', cast(1 + id % 3 as int)) end seq")
    began = time.time()
    t = annotation.transcripts(exons, seqs).first()
    assert time.time() - began < 60  # in square time: minutes
    want, at = [], 0
    for i in range(n):
        size = 1 + i % 3 if i != 5 else 0
        want.append((i, i, at + 1, at + size) if size else (i, i, None, None))
        at += size
    assert len(t.seq) == at and list(map(tuple, t.exons)) == want


def test_files(spark, tmp_path):
    (tmp_path / "r.fq").write_text("@a/1\nACGT\n+\n@III\n@b/1\nTT\n+\nII\n@c/1\nG\n+\n@\n")
    got = readers.fastq(spark, str(tmp_path / "r.fq")).orderBy("ord").collect()
    assert [(r.read_id, r.seq, r.qual) for r in got] == [("a/1", "ACGT", "@III"), ("b/1", "TT", "II"), ("c/1", "G", "@")]
    (tmp_path / "s.fa").write_text(">a x\nAC\nGT\n>b\nTT\n")
    assert sorted(map(tuple, readers.fasta(spark, str(tmp_path / "s.fa")).collect())) == [("a", "ACGT"), ("b", "TT")]
    (tmp_path / "x.sam").write_text("@SQ\tSN:c\tLN:9\nr\t0\tc\t1\t9\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:2\n")
    rows, heads = readers.sam(spark, str(tmp_path / "x.sam"))
    assert rows.first().nm == 2 and heads.first().length == 9
    (tmp_path / "g.gtf").write_text('#c\n1\ts\texon\t9\t5\t.\t+\t.\tgene_id "G"; x "1";\n')
    g = readers.gtf(spark, str(tmp_path / "g.gtf")).first()
    assert (g.start, g.end, g.attributes["gene_id"]) == (5, 9, "G")
    (tmp_path / "m.map").write_text("f/1\t+\tT;G\t7\tACGT\tIIII\t0\t5:A>C\n")
    m = readers.bowtie_map(spark, str(tmp_path / "m.map")).first()
    assert (m.frag, m.mate, m.transcript, m.gene, m.n_mism) == ("f", 1, "T", "G", 1)
    (tmp_path / "l.tsv").write_text("n\tc\nA--B|C--D\t7\nE--F\t1\n")
    assert sorted(map(tuple, readers.counted_pairs(spark, str(tmp_path / "l.tsv"), 0, 1).collect())) == [("A", "B"), ("C", "D")]
    (tmp_path / "q.csv").write_text('id,name,x\n1,"a, b",A::B\n2,"c ""d""",C::D::E\n')
    assert sorted(map(tuple, readers.fusion_pairs(spark, str(tmp_path / "q.csv"), 2, csv=True).collect())) == [("A", "B")]
    named = spark.createDataFrame([("TMPRSS2{NM_1.2}:r.1_142_ERG{NM_2.3}:r.444_3097",), ("A{T1}:r.1_2_B{T2}:r.3_4_A{T3}:r.5_6",), ("A{T1}:r.1_2",), ("A{T1}:r.1_A{T4}:r.2",)], "n string")
    assert sorted(map(tuple, readers.translocation_pairs(named, "n").collect())) == [("A", "B"), ("ERG", "TMPRSS2")]
    told = spark.createDataFrame([("ALK-EML4 Fusion",), ("IGH?MYC Fusion",), ("HLA-A-ROS1 Fusion",), ("BCR-HLA-B fusion",), ("X-Y-Z Fusion",), ("V600E",), ("SEC16A1-NOTCH1 Fusion",)], "n string")
    assert sorted(map(tuple, readers.alteration_pairs(told, "n").collect())) == [("ALK", "EML4"), ("BCR", "HLA-B"), ("HLA-A", "ROS1"), ("IGH@", "MYC"), ("NOTCH1", "SEC16A")]
    assert readers.dump_schema("CREATE TABLE `gene` (\n  `id` int,\n  `name` text,\n  KEY `id` (`id`)\n) ENGINE=x;", "gene").names == ["id", "name"]
    assert readers.configuration("[paths]\na = /x # note\n") == {"paths": {"a": "/x"}}
    sinks.fasta(readers.fasta(spark, str(tmp_path / "s.fa")), str(tmp_path / "out"))
    assert readers.fasta(spark, str(tmp_path / "out")).count() == 2
    blocks = sinks.divergent_blocks(spark.createDataFrame([("a", "b"), ("a", "c"), ("d", "e")], "g_1 string, g_2 string"))
    assert sorted(map(tuple, blocks.collect())) == [("a", "b", 0), ("a", "c", 1), ("d", "e", 0)]


@pytest.mark.parametrize("n", [20, 200, 20_000])
def test_fastq_of_any_packing(spark, tmp_path, n):
    rng = random.Random(n)
    want = []
    for i in range(n):
        size = rng.randint(0, 60)
        qual = "".join(rng.choice("@+!I#") for _ in range(size))
        want.append((f"r{i} 1:N:0", "".join(rng.choice("ACGTN") for _ in range(size)), qual))
    text = "".join(f"@{i}\n{s}\n+{i if k % 3 else ''}\n{q}\n" for k, (i, s, q) in enumerate(want)).encode()
    files = {"p.fq": text, "g.fq.gz": gzip.compress(text), "b.fq.bz2": bz2.compress(text)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", max(50, n))
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        for name, body in files.items():
            (tmp_path / name).write_bytes(body)
            rows = readers.fastq(spark, str(tmp_path / name)).collect()
            assert [(r.read_id, r.seq, r.qual) for r in sorted(rows, key=lambda r: r.ord)] == want, name
        both = readers.fastq(spark, f"{tmp_path}/*.fq*").groupBy("file").count().collect()
        assert sorted(r["count"] for r in both) == [n] * 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_read_files(spark, tmp_path):
    for name in ("b_1.fq.gz", "b_2.fq.gz", "a_R1_001.fastq", "a_R2_001.fastq", "single.fq", "notes.txt", "c_1.fq", "x.1.fastq.bz2", "x.2.fastq.bz2"):
        (tmp_path / name).write_text("@a\nA\n+\nI\n")
    (tmp_path / "empty_1.fq").write_text("")
    pairs, single = readers.read_files(spark, str(tmp_path))
    base = lambda p: p.rsplit("/", 1)[1]
    assert [tuple(map(base, p)) for p in pairs] == [("a_R1_001.fastq", "a_R2_001.fastq"), ("b_1.fq.gz", "b_2.fq.gz"), ("x.1.fastq.bz2", "x.2.fastq.bz2")]
    assert list(map(base, single)) == ["c_1.fq", "single.fq"]
    assert readers.paired_fastq(spark, *pairs[0]).count() == 1


def test_fasta_parts(spark, tmp_path):
    rows = [(f"s{i}", "A" * (i % 9 + 1)) for i in range(200)] + [("long", "C" * 90), ("none", None)]
    sinks.fasta_parts(spark.createDataFrame(rows, "id string, seq string").repartition(3), str(tmp_path / "p"), 40)
    parts = {}
    for r in spark.read.text(str(tmp_path / "p")).collect():
        if not r.value.startswith(">"):
            parts.setdefault(r.part, []).append(len(r.value))
    assert all(sum(x) <= 40 or x == [90] for x in parts.values()) and sum(map(sum, parts.values())) == sum(len(s or "") for _, s in rows)
    assert readers.fasta(spark, str(tmp_path / "p")).count() == len(rows)


def test_spreadsheet(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><t>x</t></is></c></row><row r="3"><c r="A3"><v>7.5</v></c><c r="B3" t="s"><v>0</v></c></row></sheetData></worksheet>'
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>BCR</t></si><si><r><t>AB</t></r><r><t>L1</t></r></si></sst>")
    got = [(r.row, r.cells) for r in readers.spreadsheet(spark, str(tmp_path / "w.xlsx")).orderBy("row").collect()]
    assert got == [(1, ["ABL1", "", "x"]), (3, ["7.5", "BCR"])]


def test_files_of_candidates(spark, tmp_path):
    rows = spark.createDataFrame([("f1", "a/1", "_x"), ("f1", "b/1", "_y"), ("f2", "a/1", "_y")], "fusion string, read_id string, role string")
    reads_ = spark.createDataFrame([("a/1", "ACGT", "IIII"), ("b/1", "GG", "II")], "read_id string, seq string, qual string")
    sinks.evidence_reads(rows, reads_, str(tmp_path / "e"))
    got = readers.fastq(spark, str(tmp_path / "e" / "fusion=f1")).collect()
    assert sorted((r.read_id, r.seq) for r in got) == [("a/1_x", "ACGT"), ("b/1_y", "GG")]
    named = spark.createDataFrame([("A", "B", "g1", "g2")], "symbol_1 string, symbol_2 string, g_1 string, g_2 string").withColumn("fusion", sinks.candidate_name("run"))
    sinks.by_candidate(named, str(tmp_path / "c"), listing=str(tmp_path / "list"))
    assert [r.value for r in spark.read.text(str(tmp_path / "list")).collect()] == ["run.A--B__g1--g2"]
    assert spark.read.parquet(str(tmp_path / "c")).first().fusion == "run.A--B__g1--g2"
