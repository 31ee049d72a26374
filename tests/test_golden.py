"""Report products against published results of a detection run on known fusions (expected values, as published)."""

import pytest
from pyspark.sql import functions as F

from helixloom.operators import report
from helixloom.sources import sinks

#: Symbols, gene ids, points, pairs, reads, labels, effect; the published report's first rows.
REPORT = [
    ("FGFR3", "TACC3", "ENSG00000068078", "ENSG00000013810", "4:1806934:+", "4:1727977:+", 857, 77, "known,adjacent,oncogene,cosmic,gliomas,oesophagus,10K<gap<100K", "in-frame"),
    ("FGFR3", "TACC3", "ENSG00000068078", "ENSG00000013810", "4:1807033:+", "4:1727832:+", 857, 10, "known,adjacent,oncogene,cosmic,gliomas,oesophagus,10K<gap<100K", "intronic/CDS(truncated)"),
    ("FIP1L1", "PDGFRA", "ENSG00000145216", "ENSG00000134853", "4:53425965:+", "4:54274925:+", 118, 48, "known,oncogene,cgp,ticdb", "in-frame"),
    ("GOPC", "ROS1", "ENSG00000047932", "ENSG00000047936", "6:117566854:-", "6:117321394:-", 73, 20, "known,oncogene,100K<gap<200K,exon-exon", "in-frame"),
    ("GOPC", "ROS1", "ENSG00000047932", "ENSG00000047936", "6:117566854:-", "6:117320030:-", 73, 2, "known,oncogene,100K<gap<200K,exon-exon", "out-of-frame"),
    ("IGH@", "CRLF2", "ENSG09000000014", "ENSG00000205755", "14:105863258:+", "X:105799296:-", 32, 10, "known,oncogene,cancer", "---/intergenic"),
    ("IGH@", "CRLF2", "ENSG09000000014", "ENSG00000205755", "14:105863262:+", "X:1228687:-", 32, 5, "known,oncogene,cancer", "---/intergenic"),
]
#: Id, mate's id, ALT of the published VCF rows of these fusions.
BREAKENDS = [
    ("4", 1806934, "FGFR3--TACC3__5__0", "FGFR3--TACC3__3__0", "N[4:1727977["),
    ("4", 1727977, "FGFR3--TACC3__3__0", "FGFR3--TACC3__5__0", "[4:1806934[N"),
    ("4", 1807033, "FGFR3--TACC3__5__1", "FGFR3--TACC3__3__1", "N[4:1727832["),
    ("4", 1727832, "FGFR3--TACC3__3__1", "FGFR3--TACC3__5__1", "[4:1807033[N"),
    ("4", 53425965, "FIP1L1--PDGFRA__5", "FIP1L1--PDGFRA__3", "N[4:54274925["),
    ("4", 54274925, "FIP1L1--PDGFRA__3", "FIP1L1--PDGFRA__5", "[4:53425965[N"),
    ("6", 117566854, "GOPC--ROS1__5__3", "GOPC--ROS1__3__3", "N]6:117321394]"),
    ("6", 117321394, "GOPC--ROS1__3__3", "GOPC--ROS1__5__3", "]6:117566854]N"),
    ("6", 117566854, "GOPC--ROS1__5__4", "GOPC--ROS1__3__4", "N]6:117320030]"),
    ("6", 117320030, "GOPC--ROS1__3__4", "GOPC--ROS1__5__4", "]6:117566854]N"),
    ("14", 105863258, "IGH@--CRLF2__5__5", "IGH@--CRLF2__3__5", "N]X:105799296]"),
    ("X", 105799296, "IGH@--CRLF2__3__5", "IGH@--CRLF2__5__5", "[14:105863258[N"),
    ("14", 105863262, "IGH@--CRLF2__5__6", "IGH@--CRLF2__3__6", "NNNNNNNNNNNNNNNNNNNNN]X:1228687]"),
    ("X", 1228687, "IGH@--CRLF2__3__6", "IGH@--CRLF2__5__6", "[14:105863262[NNNNNNNNNNNNNNNNNNNNN"),
]


@pytest.fixture(scope="module")
def final(spark):
    rows = []
    for i, (s1, s2, g1, g2, p1, p2, pairs, reads, labels, effect) in enumerate(REPORT):
        (c1, a1, d1), (c2, a2, d2) = p1.split(":"), p2.split(":")
        rows.append((10 * i, s1, s2, g1, g2, c1, int(a1), d1, c2, int(a2), d2, pairs, reads, labels.split(","), effect, "ACGTAC*NNNNNNNNAC" if i == 6 else "ACGTAC*GTACGTAC"))
    return spark.createDataFrame(rows, "ord int, symbol_1 string, symbol_2 string, g_1 string, g_2 string, chrom_1 string, at_1 int, strand_1 string, chrom_2 string, at_2 int, strand_2 string, pairs int, reads int, labels array<string>, effect string, seq string")


def test_vcf(final):
    lines = [r.value for r in sinks.vcf_lines(report.vcf_rows(final), {"source": "x"}).collect()]
    assert lines[:2] == ["##fileformat=VCFv4.3", "##source=x"]
    head, *rows = [x.split("\t") for x in lines if not x.startswith("##")]
    assert head == ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"]
    infos = [dict(x.split("=", 1) for x in r[7].split(";") if "=" in x) for r in rows]
    assert [(r[0], int(r[1]), r[2], i["MATEID"], r[4]) for r, i in zip(rows, infos, strict=True)] == BREAKENDS
    assert rows[3][7] == "SVTYPE=BND;MATEID=FGFR3--TACC3__5__1;EVENT=FGFR3--TACC3__1;PUBLISHED;FUSION=FGFR3--TACC3;END=3;STRAND=+;SR=10;SP=857;GENE5=FGFR3;GENS5=ENSG00000068078;GENE3=TACC3;GENS3=ENSG00000013810;EFFECT=intronic/CDS(truncated);DESC=known,adjacent,oncogene,cosmic,gliomas,oesophagus,10K<gap<100K"
    assert {k for i in infos for k in i} | {"PUBLISHED"} == set(sinks.VCF_INFO)


def test_summary(final):
    lines = report.summary_lines(final)
    assert lines[3:] == [
        "Found 4 somatic fusion gene(s), which are as follows:",
        "  * FGFR3--TACC3  (already known fusion)",
        "  * FIP1L1--PDGFRA  (already known fusion)",
        "  * GOPC--ROS1  (already known fusion; exon-exon fusion junction)",
        "  * IGH@--CRLF2  (already known fusion)",
        "",
        "Found 7 somatic fusion transcript(s).",
        "",
    ]
    assert report.summary_lines(final.limit(0))[3:] == ["No somatic fusion genes found.", "", "No somatic fusion transcripts found."]


def test_phrases(spark):
    rows = [(0, "a", "b", ["exon-exon"]), (1, "B", "A", ["COSMIC"]), (2, "c", "d", ["gtex", "x"]), (3, "e", "f", []), (4, "g", "h", ["rt_circ_rna", "readthrough"]), (5, "i", "i", ["short_repeats", "sr1.20"]), (6, "j", "k", ["TCGA-normal"])]
    df = spark.createDataFrame(rows, "ord int, symbol_1 string, symbol_2 string, labels array<string>")
    got = {r.pair: r.phrases for r in report.summary(df).collect()}
    assert got == {"A--B": "reciprocal fusion; already known fusion; exon-exon fusion junction", "C--D": "probably false positive", "E--F": "probably novel fusion", "G--H": "readthrough; rt-circRNA", "I--I": "reciprocal fusion; probably false positive", "J--K": "already known fusion; probably false positive"}
    names = [(1, 5, "Human_herpesvirus_4_virus,_complete_genome"), (2, 1, "x_virus"), (3, 7, "some_phage"), (4, 8, "Human_herpesvirus_4_virus_complete_genome"), (5, 2, "y_virus_strain_2")]
    assert [(r.ord, r.name) for r in report.top_viruses(spark.createDataFrame(names, "ord int, n int, name string")).collect()] == [(1, "Human herpesvirus 4 virus"), (5, "y virus strain 2")]


def test_distance_labels(spark):
    sets = [(["dist200kbp", "dist100kbp", "dist10kbp", "dist1000bp"], "gap<1K"), (["x", "dist10kbp", "dist200kbp", "dist100kbp"], "1K<gap<10K"), (["dist100kbp", "dist200kbp"], "10K<gap<100K"), (["dist200kbp"], "100K<gap<200K"), (["dist10kbp", "dist100kbp"], ""), (["x"], "")]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(sets)], "i int, labels array<string>")
    assert [r.g for r in df.orderBy("i").select(report.distance_bucket(F.col("labels")).alias("g")).collect()] == [g for _, g in sets]
