"""Registered queries and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixloom.functions import seq as S
from helixloom.operators import alignments as align
from helixloom.operators import annotation as annot
from helixloom.operators import intervals, pairs, reads, report
from helixloom.plans import analogs as A
from helixloom.plans import evidence  # noqa: F401  registers its queries
from helixloom.plans.registry import ORACLE_SQL, QUERIES, query  # noqa: F401

def _passing(spark, sf):
    return pairs.mate_pairs(A.alignments(spark, sf))


def _candidates(spark, sf):
    return pairs.pair_discovery(_passing(spark, sf))


def _labelled(spark, sf):
    return _candidates(spark, sf).withColumn("labels", F.array().cast("array<string>"))


def _num(gene):
    return F.substring(gene, 2, 99).cast("bigint")


def _pair_set(spark, sf, divisor):
    """Supplier pairs of a part as a curated pair set: g_lo, g_hi, n."""
    p = A.table(spark, sf, "part").select(F.concat(F.lit("G"), (F.col("p_partkey") % divisor).cast("string")).alias("a"), F.concat(F.lit("G"), (F.col("p_size") % divisor).cast("string")).alias("b"))
    return p.where("a <> b").groupBy(F.least("a", "b").alias("g_lo"), F.greatest("a", "b").alias("g_hi")).agg(F.count("*").alias("n"))


def _pair_set_sql(name, divisor):
    a, b = (f"'G' || CAST({c} % {divisor} AS VARCHAR)" for c in ("p_partkey", "p_size"))
    return f"{name} AS (SELECT least({a}, {b}) AS g_lo, greatest({a}, {b}) AS g_hi, count(*) AS n FROM part WHERE {a} <> {b} GROUP BY ALL)"


@query(f"WITH {A.CANDIDATES} SELECT * FROM cand")
def pair_discovery(spark, sf):
    return _candidates(spark, sf)


@query(f"WITH {A.PASSING}, d AS (SELECT DISTINCT g_lo, g_hi, frag FROM passing) SELECT g_lo, g_hi, count(*) OVER (PARTITION BY g_lo, g_hi) AS n, frag FROM d")
def pair_reads(spark, sf):
    return pairs.pair_reads(_passing(spark, sf))


@query(f"WITH {A.PASSING} SELECT least(t1 || ';' || g1, t2 || ';' || g2) AS t_lo, greatest(t1 || ';' || g1, t2 || ';' || g2) AS t_hi, count(*) AS n FROM passing GROUP BY ALL")
def transcript_pairs(spark, sf):
    return pairs.transcript_pairs(_passing(spark, sf))


@query(f"WITH {A.ALN} SELECT frag, 3 - min(mate) AS missing, min(mate) AS found, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes FROM aln GROUP BY frag HAVING min(mate) = max(mate)")
def missing_mates(spark, sf):
    return pairs.missing_mates(A.alignments(spark, sf))


@query(f"WITH {A.ALN}, d AS (SELECT DISTINCT frag, gene FROM aln) SELECT a.gene AS g_lo, b.gene AS g_hi, count(*) AS n FROM d a JOIN d b ON a.frag = b.frag AND a.gene < b.gene GROUP BY ALL HAVING count(*) >= 2")
def homolog_pairs(spark, sf):
    return pairs.homolog_pairs(A.alignments(spark, sf).select(F.col("frag").alias("read_id"), "gene"), reads=2)


@query(f"""WITH {A.ALN}, h AS (SELECT frag, gene, line % 3 AS m FROM aln), best AS (SELECT frag, min(m) AS b FROM h GROUP BY frag), d AS (SELECT DISTINCT h.frag, gene FROM h JOIN best USING (frag) WHERE NOT (b = 0 AND m = 2))
SELECT a.gene AS g_lo, b.gene AS g_hi, count(*) AS n FROM d a JOIN d b ON a.frag = b.frag AND a.gene < b.gene GROUP BY ALL""")
def homolog_pairs_best(spark, sf):
    rows = A.alignments(spark, sf).select(F.col("frag").alias("read_id"), "gene", (F.col("line") % 3).alias("n_mismatch"))
    return pairs.homolog_pairs(rows, best_only=True)


@query(f"WITH {A.CANDIDATES}, {_pair_set_sql('second', 90)}, u AS (SELECT * FROM cand UNION ALL SELECT * FROM second), s AS (SELECT g_lo, g_hi, sum(n) AS n FROM u GROUP BY ALL) SELECT g_lo, g_hi, CAST(n AS BIGINT) AS n, CASE WHEN n >= 3 THEN 'kept' ELSE 'rest' END AS side FROM s")
def pair_join_sum(spark, sf):
    kept, rest = pairs.join_homologs(_candidates(spark, sf), _pair_set(spark, sf, 90), reads=3)
    return kept.withColumn("side", F.lit("kept")).union(rest.withColumn("side", F.lit("rest")))


LABELLED = f"""{A.CANDIDATES}, {_pair_set_sql('known', 60)}, {_pair_set_sql('common', 80)}, labelled AS (
  SELECT c.g_lo, c.g_hi, c.n, list_concat(CASE WHEN k.n >= 2 THEN ['known'] ELSE [] END, CASE WHEN CAST(substr(c.g_lo, 2) AS BIGINT) % 7 = 0 OR CAST(substr(c.g_hi, 2) AS BIGINT) % 7 = 0 THEN ['paralog'] ELSE [] END,
    CASE WHEN coalesce(m.n, 0) > c.n THEN ['similar_reads'] ELSE [] END, CASE WHEN coalesce(k.n, 0) <> c.n THEN ['m' || coalesce(k.n, 0)] ELSE [] END, CASE WHEN coalesce(k.n, 0) <> c.n AND coalesce(k.n, 0) < 2 THEN ['multi'] ELSE [] END) AS labels
  FROM cand c LEFT JOIN known k USING (g_lo, g_hi) LEFT JOIN common m USING (g_lo, g_hi))"""


def _all_labels(spark, sf):
    known = _pair_set(spark, sf, 60)
    seventh = A.table(spark, sf, "supplier").where("s_suppkey % 7 = 0").select(F.concat(F.lit("G"), F.col("s_suppkey").cast("string")).alias("gene"))
    out = pairs.label_pair_set(_labelled(spark, sf), known, "known", 2)
    out = pairs.label_gene_set(out, seventh, "paralog")
    out = pairs.label_ambiguous(out, _pair_set(spark, sf, 80), "similar_reads", 1)
    return pairs.label_multi(out, known, ("m", "multi"), 2)


@query(f"WITH {LABELLED} SELECT g_lo, g_hi, n, array_to_string(labels, ',') AS labels FROM labelled")
def pair_labels(spark, sf):
    return _all_labels(spark, sf).select("g_lo", "g_hi", "n", F.array_join("labels", ",").alias("labels"))


EXTRACT = """, judged AS (
  SELECT *, list_contains(labels, 'known') AS k, n >= 2 AND (list_contains(labels, 'known') OR NOT list_contains(labels, 'paralog')) AS usual FROM labelled
), counted AS (SELECT *, coalesce(sum(CAST(usual AS INTEGER)) OVER (ORDER BY n DESC, g_lo, g_hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM judged)
SELECT g_lo, g_hi, n, array_to_string(labels, ',') AS labels, CASE WHEN usual AND before < 1000 THEN 'further_analysis' ELSE 'skipped' END AS status FROM counted"""


@query(f"WITH {LABELLED}{EXTRACT}")
def pair_extract(spark, sf):
    out = pairs.extract_candidates(_all_labels(spark, sf), threshold_pairs=2, threshold_count=1000)
    return out.select("g_lo", "g_hi", "n", F.array_join("labels", ",").alias("labels"), "status")


flagship = pair_extract


@query(f"""WITH {A.CANDIDATES}, sup AS (SELECT 'G' || CAST(s_suppkey AS VARCHAR) AS gene, s_nationkey % 5 AS chrom, s_suppkey % 2 AS strand, s_suppkey * 1000 AS s, s_suppkey * 1000 + s_nationkey * 10 AS e FROM supplier)
SELECT g_lo, g_hi, n, CASE WHEN a.chrom = b.chrom AND a.strand = b.strand AND least(abs(a.s - b.s), abs(a.s - b.e), abs(a.e - b.s), abs(a.e - b.e)) <= 10000 THEN 'dist10kbp' ELSE '' END AS labels
FROM cand LEFT JOIN sup a ON g_lo = a.gene LEFT JOIN sup b ON g_hi = b.gene""")
def pair_distance(spark, sf):
    sup = A.table(spark, sf, "supplier").select(F.concat(F.lit("G"), F.col("s_suppkey").cast("string")).alias("gene"), (F.col("s_nationkey") % 5).alias("chrom"), (F.col("s_suppkey") % 2).alias("strand"), (F.col("s_suppkey") * 1000).alias("start"), (F.col("s_suppkey") * 1000 + F.col("s_nationkey") * 10).alias("end"))
    return pairs.label_distance(_labelled(spark, sf), sup, 10000, "dist10kbp").select("g_lo", "g_hi", "n", F.array_join("labels", ",").alias("labels"))


@query(f"""WITH {A.PSL}, r AS (SELECT *, row_number() OVER w AS rn, lead(matches) OVER w AS nxt FROM psl WINDOW w AS (PARTITION BY q_name ORDER BY matches DESC, mismatches, block_count, t_name, t_start))
SELECT q_name, t_name, matches, mismatches, block_count, t_start FROM r WHERE rn = 1 AND (nxt IS NULL OR nxt <> matches)""")
def best_unique_hit(spark, sf):
    return align.best_unique_hits(A.hits(spark, sf)).select("q_name", "t_name", "matches", "mismatches", "block_count", "t_start")


@query(f"""WITH {A.PSL.replace("gene AS t_name", "substr(gene, 1, 2) AS t_name")}, t AS (SELECT * FROM psl p WHERE matches = (SELECT max(matches) FROM psl q WHERE q.q_name = p.q_name)),
f AS (SELECT *, first_value(t_start) OVER w AS s, first_value(t_end) OVER w AS e FROM t WINDOW w AS (PARTITION BY q_name ORDER BY matches DESC, mismatches, block_count, t_name, t_start)),
g AS (SELECT q_name FROM f GROUP BY q_name HAVING count(*) = 1 OR (count(DISTINCT t_name) = 1 AND bool_and(t_start <= e AND t_end >= s)))
SELECT q_name, t_name, matches, t_start, count(*) AS copies FROM f WHERE q_name IN (SELECT q_name FROM g) GROUP BY ALL""")
def best_hit_ties(spark, sf):
    rows = align.best_hits_with_ties(A.hits(spark, sf).withColumn("t_name", F.substring("t_name", 1, 2)))
    return rows.groupBy("q_name", "t_name", "matches", "t_start").agg(F.count("*").alias("copies"))


@query(f"""WITH {A.GENES} SELECT a.gene AS g_lo, b.gene AS g_hi, CASE WHEN (a.s >= b.s - 10 AND a.e <= b.e + 10) OR (b.s >= a.s - 10 AND b.e <= a.e + 10) THEN 'full' ELSE 'partial' END AS kind, a.strand = b.strand AS same_strand
FROM genes a JOIN genes b ON a.chrom = b.chrom AND a.gene < b.gene AND a.e - b.s > 10 AND b.e - a.s > 10""")
def overlap_pairs(spark, sf):
    return intervals.overlapping_genes(A.genes(spark, sf), tolerance=10, bin_size=256)


@query(f"""WITH {A.GENES} SELECT a.chrom, a.strand, a.gene AS g_first, b.gene AS g_second FROM genes a JOIN genes b ON a.chrom = b.chrom AND a.strand = b.strand AND (a.s, a.e, a.gene) < (b.s, b.e, b.gene)
WHERE b.s <= coalesce((SELECT min(k.e) FROM genes k WHERE k.chrom = a.chrom AND k.strand = a.strand AND k.s > a.e), 4611686018427387904)""")
def adjacent_pairs(spark, sf):
    return intervals.adjacent_genes(A.genes(spark, sf))


@query(f"""WITH {A.GENES}, o AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM genes),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR s >= before THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM o)
SELECT chrom, min(s) AS "start", max(e) AS "end" FROM i GROUP BY chrom, island""")
def bed_merge(spark, sf):
    return intervals.merge_intervals(A.genes(spark, sf), bin_size=4096)


@query(f"""WITH {A.GENES}, w AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e, gene ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l, min(s) OVER (PARTITION BY chrom ORDER BY s RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM genes)
SELECT gene, chrom, s AS "start", e AS "end", s - greatest(0, least(50, CASE WHEN l IS NULL THEN s - 1 ELSE CAST(floor((s - l - 1) / 2.0) AS BIGINT) END)) AS new_start,
  e + greatest(0, least(50, CASE WHEN r IS NULL THEN 1000000000 - e ELSE CAST(floor((r - e - 1) / 2.0) AS BIGINT) END)) AS new_end FROM w""")
def gene_enlargement(spark, sf):
    rows = A.genes(spark, sf)
    chroms = rows.select("chrom").distinct().withColumn("length", F.lit(1_000_000_000).cast("bigint"))
    return intervals.enlarge_genes(rows, chroms, 50)


@query("""WITH k AS (SELECT p_partkey AS k, upper(p_name || ' ' || CAST(p_partkey // 50 AS VARCHAR)) AS sym FROM part), direct AS (SELECT DISTINCT sym, 'P' || CAST(k AS VARCHAR) AS gene FROM k WHERE k % 2 = 0), syn AS (SELECT DISTINCT sym, 'Q' || CAST(k AS VARCHAR) AS gene FROM k WHERE k % 2 <> 0),
t AS (SELECT * FROM direct UNION SELECT * FROM syn WHERE sym NOT IN (SELECT sym FROM direct)), w AS (SELECT DISTINCT a.sym AS s1, b.sym AS s2 FROM k a JOIN k b ON b.k = a.k + 1 WHERE a.sym <> b.sym)
SELECT DISTINCT least(x.gene, y.gene) AS g_lo, greatest(x.gene, y.gene) AS g_hi FROM w JOIN t x ON w.s1 = x.sym JOIN t y ON w.s2 = y.sym WHERE x.gene <> y.gene""")
def symbol_resolve(spark, sf):
    """Every row of part in one of the two tables: even keys as symbols, odd ones as synonyms; a symbol is a name with the fifty of its key."""
    p = A.table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_name", F.floor(F.col("p_partkey") / 50).cast("string")).alias("symbol"))
    wanted = p.toDF("p_partkey", "symbol_1").join(p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("symbol").alias("symbol_2")), "p_partkey")
    tables = [p.where(F.col("p_partkey") % 2 == i).select(F.concat(F.lit(c), F.col("p_partkey").cast("string")).alias("gene"), "symbol") for i, c in ((0, "P"), (1, "Q"))]
    return annot.resolve_symbols(wanted, *tables)


@query("""WITH d AS (SELECT DISTINCT 'P' || CAST(p_partkey AS VARCHAR) AS gene, trim(p_name) || CASE WHEN p_partkey % 50 < 2 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS name, p_partkey % 50 = 0 AS pseudo FROM part),
g AS (SELECT * FROM d WHERE name IN (SELECT name FROM d WHERE pseudo)), p AS (SELECT DISTINCT a.gene AS g_lo, b.gene AS g_hi FROM g a JOIN g b ON a.name = b.name AND a.gene < b.gene),
par AS (SELECT DISTINCT least('P' || CAST(p_partkey AS VARCHAR), 'P' || CAST(p_partkey + 25 AS VARCHAR)) AS g_lo, greatest('P' || CAST(p_partkey AS VARCHAR), 'P' || CAST(p_partkey + 25 AS VARCHAR)) AS g_hi FROM part WHERE p_partkey % 25 = 0),
n AS (SELECT g_lo AS x, g_hi AS y FROM par UNION ALL SELECT g_hi, g_lo FROM par), e AS (SELECT g_lo AS x, g_hi AS keep FROM p UNION ALL SELECT g_hi, g_lo FROM p),
u AS (SELECT * FROM p UNION SELECT least(keep, y), greatest(keep, y) FROM e JOIN n USING (x) WHERE keep <> y)
SELECT g_lo, g_hi FROM u ANTI JOIN par USING (g_lo, g_hi)""")
def pseudogene_pairs(spark, sf):
    p = A.table(spark, sf, "part")
    gene = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    text = F.when(F.col("p_partkey") % 50 == 0, F.concat("p_name", F.lit(" pseudogene 7 [Source:X]"))).when(F.col("p_partkey") % 50 == 1, F.concat("p_name", F.lit(" (human)"))).otherwise(F.concat("p_name", F.col("p_partkey").cast("string")))
    other = F.concat(F.lit("P"), (F.col("p_partkey") + 25).cast("string"))
    paralogs = p.where("p_partkey % 25 = 0").select(F.least(gene, other).alias("g_lo"), F.greatest(gene, other).alias("g_hi")).distinct()
    return annot.pseudogene_pairs(p.select(gene.alias("gene"), text.alias("description")), paralogs)


@query("SELECT 'C' || CAST(o_custkey AS VARCHAR) AS gene FROM orders GROUP BY o_custkey HAVING max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) = 0")
def genes_no_protein(spark, sf):
    rows = A.table(spark, sf, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("gene"), F.when(F.col("o_orderstatus") == "P", "pep").otherwise("").alias("peptide"))
    return annot.genes_without_protein(rows)


JUNCTION = f"""WITH {A.ALN}, h AS (SELECT gene || '-' || CAST(part % 20 AS VARCHAR) AS junction, gene AS pair, CAST(frag AS VARCHAR) AS read_id, pos % 100 AS s, pos % 100 + qty AS e, 60 AS junct, line AS m FROM aln), near AS (SELECT * FROM h WHERE s <= junct - 10 AND e >= junct + 10),
o AS (SELECT junction, pair, s, e, count(*) AS n, min((m, read_id)) AS best, least(abs(60 - s + 1), abs(e - 60)) AS d FROM near GROUP BY junction, pair, s, e),
j AS (SELECT junction, pair, CAST(sum(n) AS BIGINT) AS counts, count(*) AS "unique", max(d) AS longest, round(avg(d), 6) AS mean_anchor, round(avg(best[1]), 6) AS mean_mismatches, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d DESC) AS anchors FROM o GROUP BY junction, pair),
k AS (SELECT * FROM j WHERE NOT ("unique" = 1 AND ((mean_mismatches > 0 AND longest / mean_mismatches <= 5) OR longest > 14)))
SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY pair, anchors ORDER BY junction) AS rn FROM k) WHERE rn = 1"""


@query(JUNCTION)
def exon_junction_summary(spark, sf):
    a = A.alignments(spark, sf)
    hits = a.select(F.concat("gene", F.lit("-"), (F.col("part") % 20).cast("string")).alias("junction"), F.col("gene").alias("pair"), F.col("frag").cast("string").alias("read_id"), (F.col("pos") % 100).alias("start"), (F.col("pos") % 100 + F.col("qty")).alias("end"), F.lit(60).alias("junct"), F.col("line").alias("n_mism"))
    return report.junction_summary(hits)


SPLITS = f"""WITH {A.REPORT}, m AS (SELECT g_1 AS gene_1, g_2 AS gene_2, chrom_1, strand_1, at_1 % 50 AS pos_1, chrom_2, strand_2, at_1 % 50 AS pos_2, CAST(ord AS VARCHAR) AS read_id, at_1 % 7 AS s, at_2 % 3 AS e, pairs AS anchor, reads AS n_mism, CASE WHEN pairs % 2 = 0 THEN 'AC*N' ELSE 'AC*G' END || CAST(ord AS VARCHAR) AS seq, ord FROM report),
g AS (SELECT * FROM m WHERE n_mism <= CASE WHEN seq LIKE '%*N%' THEN 5 ELSE 3 END),
o AS (SELECT gene_1, gene_2, chrom_1, strand_1, pos_1, chrom_2, strand_2, pos_2, s, e, max(anchor) AS anchor FROM g GROUP BY ALL),
u AS (SELECT gene_1, gene_2, chrom_1, strand_1, pos_1, chrom_2, strand_2, pos_2, count(*) AS "unique", max(anchor) AS longest FROM o GROUP BY ALL HAVING count(*) >= 2 OR max(anchor) >= 40),
r AS (SELECT gene_1, gene_2, chrom_1, strand_1, pos_1, chrom_2, strand_2, pos_2, arg_max(seq, (ord, seq)) AS seq, count(DISTINCT read_id) AS n_reads FROM g GROUP BY ALL)"""
SITE = ", ".join(report.SITE)


def _split_mappings(spark, sf):
    r = A.report(spark, sf)
    seq = F.concat(F.when(F.col("pairs") % 2 == 0, "AC*N").otherwise("AC*G"), F.col("ord").cast("string"))
    return r.select(F.col("g_1").alias("gene_1"), F.col("g_2").alias("gene_2"), "chrom_1", "strand_1", (F.col("at_1") % 50).alias("pos_1"), "chrom_2", "strand_2", (F.col("at_1") % 50).alias("pos_2"), F.col("ord").cast("string").alias("read_id"), (F.col("at_1") % 7).alias("start"), (F.col("at_2") % 3).alias("end"), F.col("pairs").alias("anchor"), F.col("reads").alias("n_mism"), seq.alias("seq"), "ord")


@query(f"{SPLITS} SELECT * FROM u JOIN r USING ({SITE})")
def split_junction_summary(spark, sf):
    return report.split_junctions(_split_mappings(spark, sf), reads=2, mismatches=3, mismatches_gap=5)


@query(f"{SPLITS} SELECT DISTINCT {SITE}, read_id FROM g JOIN u USING ({SITE})")
def split_junction_reads(spark, sf):
    rows = _split_mappings(spark, sf)
    return report.split_junction_reads(rows, report.split_junctions(rows, reads=2, mismatches=3, mismatches_gap=5), 3, 5)


SQUISH = f"""WITH {A.REPORT}, rep AS (SELECT ord, g_1, g_2, CASE WHEN g_1 LIKE '%7' THEN symbol_1 || '_Locus_x' ELSE symbol_1 END AS symbol_1, symbol_2, at_1 % 10 AS pos_1, at_2 % 10 AS pos_2, CASE WHEN pairs % 3 = 0 THEN '' ELSE 'E' || CAST(pairs AS VARCHAR) END AS exon_1, CASE WHEN pairs % 3 = 0 THEN '' ELSE 'F' || CAST(pairs AS VARCHAR) END AS exon_2, pairs, reads, reads * 1000000 + at_1 AS longest FROM report),
u AS (SELECT *, CASE WHEN ord % 2 = 0 THEN 'BOWTIE' ELSE 'BOWTIE+BLAT' END AS method FROM rep), {_pair_set_sql('common', 80)},
m AS (SELECT u.*, coalesce(n, 0) AS common_n, length(least(g_1, g_2)) AS w FROM u LEFT JOIN common c ON least(u.g_1, u.g_2) = c.g_lo AND greatest(u.g_1, u.g_2) = c.g_hi WHERE u.reads >= 2 AND u.pairs >= 2),
k AS (SELECT *, row_number() OVER (PARTITION BY pos_1, pos_2, g_1, g_2 ORDER BY pairs DESC, reads DESC, longest DESC, method) AS rn FROM m),
ms AS (SELECT pos_1, pos_2, g_1, g_2, string_agg(DISTINCT method, ';' ORDER BY method) AS methods, arg_max(exon_1, rn) FILTER (exon_1 <> '') AS x1, arg_max(exon_2, rn) FILTER (exon_1 <> '') AS x2 FROM k GROUP BY ALL)
SELECT k.pos_1, k.pos_2, k.g_1, k.g_2, CASE WHEN symbol_1 LIKE '%_Locus%' THEN replace(symbol_1, '_Locus_x', '') || '@' ELSE symbol_1 END AS symbol_1, methods, CASE WHEN exon_1 <> '' THEN exon_1 ELSE coalesce(x1, '') END AS exon_1, CASE WHEN exon_1 <> '' THEN exon_2 ELSE coalesce(x2, '') END AS exon_2, pairs, reads, common_n, CASE w WHEN 3 THEN 'known,1K<gap<10K' WHEN 2 THEN 'known,' ELSE 'known,short_distance' END AS labels
FROM k JOIN ms USING (pos_1, pos_2, g_1, g_2) WHERE rn = 1"""


@query(SQUISH)
def merge_reports_squish(spark, sf):
    """Labels by the length of a gene's name: a set of distances that is listed, one that isn't, and none."""
    exon = lambda c: F.when(F.col("pairs") % 3 == 0, "").otherwise(F.concat(F.lit(c), F.col("pairs").cast("string")))
    symbol = F.when(F.col("g_1").endswith("7"), F.concat("symbol_1", F.lit("_Locus_x"))).otherwise(F.col("symbol_1"))
    rep = A.report(spark, sf).select("ord", "g_1", "g_2", symbol.alias("symbol_1"), "symbol_2", (F.col("at_1") % 10).alias("pos_1"), (F.col("at_2") % 10).alias("pos_2"), exon("E").alias("exon_1"), exon("F").alias("exon_2"), "pairs", "reads", (F.col("reads") * 1000000 + F.col("at_1")).alias("longest"))
    labels = rep.select(F.least("g_1", "g_2").alias("g_lo"), F.greatest("g_1", "g_2").alias("g_hi")).distinct()
    texts = lambda *x: F.array(*map(F.lit, x))
    size = F.length("g_lo")
    labels = labels.withColumn("labels", F.when(size == 3, texts("known", "dist10kbp", "dist200kbp", "dist100kbp")).when(size == 2, texts("known", "short_distance", "dist10kbp", "dist100kbp")).otherwise(texts("known", "short_distance")))
    merged = report.merge_reports([(rep.where("ord % 2 = 0"), "BOWTIE"), (rep.where("ord % 2 = 1"), "BOWTIE+BLAT")], labels, _pair_set(spark, sf, 80))
    return report.squish(merged).select("pos_1", "pos_2", "g_1", "g_2", "symbol_1", "methods", "exon_1", "exon_2", "pairs", "reads", "common_n", F.array_join("labels", ",").alias("labels"))


#: The rows of a group one after the other, each with the list of those kept before it.
WIGGLE_SQL = f"""WITH RECURSIVE {A.REPORT}, r AS (SELECT ord, g_1, g_2, at_1, at_2, pairs, reads, g_1 || '|' || g_2 || '|' || chrom_1 || strand_1 || '|' || chrom_2 || strand_2 AS g, list_contains(labels, 'exon-exon') AS free, row_number() OVER (PARTITION BY g_1, g_2, chrom_1, strand_1, chrom_2, strand_2 ORDER BY ord) AS k FROM report),
t AS (SELECT g, k, ord, true AS keep, [{{'p': pairs, 'r': reads, 'x': at_1, 'y': at_2}}] AS kept FROM r WHERE k = 1
  UNION ALL SELECT g, k, ord, NOT hit, CASE WHEN hit THEN kept ELSE list_append(kept, {{'p': pairs, 'r': reads, 'x': at_1, 'y': at_2}}) END FROM (
    SELECT r.*, t.kept, NOT r.free AND len(list_filter(t.kept, lambda z: z.p >= r.pairs AND z.r >= r.reads AND abs(z.x - r.at_1) <= 20 AND abs(z.y - r.at_2) <= 20)) > 0 AS hit FROM t JOIN r ON r.g = t.g AND r.k = t.k + 1))
SELECT r.ord, g_1, g_2, at_1, at_2, pairs, reads FROM r JOIN t ON r.g = t.g AND r.k = t.k WHERE t.keep"""


@query(WIGGLE_SQL)
def wiggle_filter(spark, sf):
    return report.filter_wiggle(A.report(spark, sf)).select("ord", "g_1", "g_2", "at_1", "at_2", "pairs", "reads")


@query(f"""WITH {A.REPORT}, p AS (SELECT g_1, g_2, max(CASE WHEN list_contains(labels, 'readthrough') THEN 1 ELSE 0 END) AS r FROM report GROUP BY ALL), b AS (SELECT a.g_1, a.g_2, greatest(a.r, c.r) AS r FROM p a JOIN p c ON a.g_1 = c.g_2 AND a.g_2 = c.g_1 WHERE a.g_1 <> a.g_2)
SELECT ord, g_1, g_2, array_to_string(list_concat(labels, CASE WHEN b.r IS NULL THEN [] WHEN b.r = 1 THEN ['reciprocal', 'rt_circ_rna'] ELSE ['reciprocal'] END), ',') AS labels FROM report LEFT JOIN b USING (g_1, g_2)""")
def reciprocal(spark, sf):
    return report.label_reciprocal(A.report(spark, sf)).select("ord", "g_1", "g_2", F.array_join("labels", ",").alias("labels"))


@query(f"""WITH {A.REPORT}, x AS (SELECT DISTINCT g_1 AS gene, chrom_1 AS chrom, strand_1 AS strand, at_1 % 40 AS s, at_1 % 40 + 8 AS e FROM report),
ends AS (SELECT DISTINCT gene, chrom, strand, CASE WHEN strand = '+' THEN e ELSE s END AS at FROM x), begins AS (SELECT DISTINCT gene, chrom, strand, CASE WHEN strand = '+' THEN s ELSE e END AS at FROM x)
SELECT ord, array_to_string(list_concat(labels, CASE WHEN a.gene IS NOT NULL AND b.gene IS NOT NULL THEN ['exon-exon'] ELSE [] END), ',') AS labels
FROM report r LEFT JOIN ends a ON r.g_1 = a.gene AND r.chrom_1 = a.chrom AND r.strand_1 = a.strand AND r.at_1 % 48 = a.at LEFT JOIN begins b ON r.g_2 = b.gene AND r.chrom_2 = b.chrom AND r.strand_2 = b.strand AND r.at_2 % 48 = b.at""")
def exon_border(spark, sf):
    r = A.report(spark, sf)
    exons = r.select(F.col("g_1").alias("gene"), F.col("chrom_1").alias("chrom"), F.col("strand_1").alias("strand"), (F.col("at_1") % 40).alias("start"), (F.col("at_1") % 40 + 8).alias("end")).distinct()
    return report.label_exon_exon(r.withColumn("at_1", F.col("at_1") % 48).withColumn("at_2", F.col("at_2") % 48), exons).select("ord", F.array_join("labels", ",").alias("labels"))


@query(f"""WITH {A.ALN}, j AS (SELECT DISTINCT CAST(frag AS VARCHAR) || '/1' AS read_id, gene AS gene_1, 'G' || CAST(part % 97 AS VARCHAR) AS gene_2 FROM aln WHERE mate = 1), m AS (SELECT DISTINCT CAST(frag AS VARCHAR) || '/1' AS read_id, gene FROM aln WHERE mate = 2)
SELECT * FROM j WHERE read_id NOT IN (SELECT read_id FROM m) OR EXISTS (SELECT 1 FROM m WHERE m.read_id = j.read_id AND (m.gene = j.gene_1 OR m.gene = j.gene_2))""")
def mate_consistency(spark, sf):
    a = A.alignments(spark, sf)
    name = F.concat(F.col("frag").cast("string"), F.lit("/"), F.col("mate").cast("string"))
    junctions = a.where("mate = 1").select(name.alias("read_id"), F.col("gene").alias("gene_1"), F.concat(F.lit("G"), (F.col("part") % 97).cast("string")).alias("gene_2")).distinct()
    return align.mate_consistent(junctions, a.where("mate = 2").select(name.alias("read_id"), "gene"))


@query(f"""WITH {A.ALN}, t AS (SELECT frag, arg_min(qty % 4, ord) AS t FROM aln WHERE mate = 1 GROUP BY frag), g AS (SELECT frag, arg_min(qty % 3, ord) AS g FROM aln WHERE mate = 2 GROUP BY frag)
SELECT a.frag AS read_id, ord, qty % 4 AS n_mism FROM aln a WHERE mate = 1 AND frag NOT IN (SELECT frag FROM t JOIN g USING (frag) WHERE g < t)""")
def genome_vs_transcriptome(spark, sf):
    a = A.alignments(spark, sf)
    return align.better_on_transcriptome(a.where("mate = 1").select(F.col("frag").alias("read_id"), "ord", (F.col("qty") % 4).alias("n_mism")), a.where("mate = 2").select(F.col("frag").alias("read_id"), "ord", (F.col("qty") % 3).alias("n_mism")))


VCF = f"""WITH {A.REPORT}, n AS (SELECT *, symbol_1 || '--' || symbol_2 AS x, row_number() OVER (ORDER BY ord) - 1 AS i, count(*) OVER (PARTITION BY symbol_1, symbol_2) AS c, CASE WHEN pairs % 9 = 0 THEN repeat('N', 20) ELSE '' END AS gap FROM report),
d AS (SELECT *, CASE WHEN c > 1 THEN '__' || i ELSE '' END AS t, ';EVENT=' || x || CASE WHEN c > 1 THEN '__' || i ELSE '' END || CASE WHEN list_contains(labels, 'known') THEN ';PUBLISHED' ELSE '' END || ';FUSION=' || x AS a,
  ';SR=' || reads || ';SP=' || pairs || ';GENE5=' || symbol_1 || ';GENS5=' || g_1 || ';GENE3=' || symbol_2 || ';GENS3=' || g_2 || ';EFFECT=' || CASE WHEN reads % 2 = 0 THEN 'in-frame' ELSE '' END || ';DESC=' || array_to_string(labels, ',') AS z FROM n)
SELECT ord, 1 AS "end", chrom_1 AS chrom, at_1 AS pos, x || '__5' || t AS id, 'N' AS ref, gap || CASE WHEN strand_2 = '-' THEN 'N]' || chrom_2 || ':' || at_2 || ']' ELSE 'N[' || chrom_2 || ':' || at_2 || '[' END AS alt, '.' AS qual, 'PASS' AS filter, 'SVTYPE=BND;MATEID=' || x || '__3' || t || a || ';END=5;STRAND=' || strand_1 || z AS info FROM d
UNION ALL SELECT ord, 2, chrom_2, at_2, x || '__3' || t, 'N', CASE WHEN strand_1 = '-' THEN ']' || chrom_1 || ':' || at_1 || ']N' ELSE '[' || chrom_1 || ':' || at_1 || '[N' END || gap, '.', 'PASS', 'SVTYPE=BND;MATEID=' || x || '__5' || t || a || ';END=3;STRAND=' || strand_2 || z FROM d"""


@query(VCF)
def vcf_rows(spark, sf):
    seq = F.when(F.col("pairs") % 9 == 0, "ACGT*NNNNNNNNAC").otherwise("ACGT*ACNNNNNN")
    return report.vcf_rows(A.report(spark, sf).withColumn("seq", seq).withColumn("effect", F.when(F.col("reads") % 2 == 0, "in-frame")))


#: Labels by the number of pairs, beside those of the report.
MORE_LABELS = {11: "cosmic", 13: "TCGA-normal", 17: "gtex", 19: "known_rt_circ_rna", 23: "sr1.23", 29: "gliomas", 31: "rt_circ_rna"}


def _any(names):
    return " OR ".join(f"contains(l, '{x}')" for x in names)


@query(f"""WITH {A.REPORT}, r AS (SELECT ord, upper(symbol_1) AS a, upper(symbol_2) AS b, lower(array_to_string(list_concat(labels, CASE pairs {' '.join(f"WHEN {k} THEN ['{v}']" for k, v in MORE_LABELS.items())} ELSE [] END), ',')) AS l FROM report),
g AS (SELECT min(ord) AS ord, arg_min(a, ord) AS a, arg_min(b, ord) AS b, bool_or({_any(report.KNOWN)}) AS k, bool_or({_any(report.DOUBTFUL)}) AS q, bool_or(l LIKE '%readthrough%') AS t, bool_or(contains(l, 'rt_circ_rna')) AS c, bool_or(l LIKE '%exon-exon%') AS x FROM r GROUP BY least(a, b), greatest(a, b)),
p AS (SELECT DISTINCT a, b FROM r)
SELECT ord, g.a || '--' || g.b AS pair, concat_ws('; ', CASE WHEN p.a IS NOT NULL THEN 'reciprocal fusion' END, CASE WHEN k THEN 'already known fusion' END, CASE WHEN q THEN 'probably false positive' END, CASE WHEN t THEN 'readthrough' END, CASE WHEN c THEN 'rt-circRNA' END, CASE WHEN x THEN 'exon-exon fusion junction' END, CASE WHEN NOT (k OR q OR t OR c) THEN 'probably novel fusion' END) AS phrases FROM g LEFT JOIN p ON p.a = g.b AND p.b = g.a""")
def summary_labels(spark, sf):
    more = F.array().cast("array<string>")
    for n, label in MORE_LABELS.items():
        more = F.when(F.col("pairs") == n, F.array(F.lit(label))).otherwise(more)
    return report.summary(A.report(spark, sf).withColumn("labels", F.concat("labels", more)))


@query(f"""WITH {A.REPORT} SELECT count(DISTINCT (least(symbol_1, symbol_2), greatest(symbol_1, symbol_2))) AS genes, count(DISTINCT (symbol_1, symbol_2, chrom_1, at_1, strand_1, chrom_2, at_2, strand_2)) AS transcripts FROM report""")
def summary_counts(spark, sf):
    return report.summary_counts(A.report(spark, sf))


@query(f"""WITH {A.READS}, s AS (SELECT read_id, replace(seq, 'N', 'A') AS seq, unnest(range(1, greatest(1, length(seq) - least(length(seq), 24) + 1) + 1)) AS i FROM reads), k AS (SELECT read_id, i, substr(seq, CAST(i + j AS BIGINT), 2) AS mer FROM s, range(0, 23) t(j) WHERE j + 2 <= least(length(seq), 24)),
c AS (SELECT read_id, i, mer, count(*) AS n FROM k GROUP BY ALL), e AS (SELECT read_id, i, sum(n) AS t, sum(n * log2(n)) AS q FROM c GROUP BY ALL)
SELECT read_id, round(min(log2(t) - q / t), 6) AS entropy FROM e GROUP BY read_id HAVING min(log2(t) - q / t) > 1.4""")
def str_filter(spark, sf):
    rich, _ = reads.drop_repeats(A.reads(spark, sf))
    return rich.select("read_id", F.round("entropy", 6).alias("entropy"))


@query(f"WITH {A.READS} SELECT read_id, reverse(translate(seq, 'ACGTN', 'TGCAA')) AS rc, substr(seq, 1, greatest(0, length(seq) - 5)) AS cut3, right(seq, least(12, length(seq))) AS last12, CAST(length(seq) AS INTEGER) AS n FROM reads")
def reverse_and_trim(spark, sf):
    r = A.reads(spark, sf)
    five = reads.trim(r, final_size=12, end=5).select("read_id", F.col("seq").alias("last12"))
    three = reads.trim(r, size=5).select("read_id", F.col("seq").alias("cut3"))
    return r.select("read_id", S.reverse_complement("seq").alias("rc"), F.length("seq").alias("n")).join(three, "read_id").join(five, "read_id")


@query(f"""WITH {A.READS}, h AS (SELECT read_id, regexp_replace(seq, '^(A{{9,}}|C{{9,}}|G{{9,}}|T{{9,}}|N+)', '') AS s FROM reads), t AS (SELECT read_id, regexp_replace(s, '(A{{9,}}|C{{9,}}|G{{9,}}|T{{9,}}|N+)$', '') AS s FROM h),
c AS (SELECT read_id, CASE WHEN instr(s, repeat('A', 31)) > 0 THEN substr(s, 1, instr(s, repeat('A', 31)) - 1) WHEN instr(s, 'NNN') > 0 THEN substr(s, 1, instr(s, 'NNN') - 1) ELSE s END AS s FROM t)
SELECT read_id, CASE WHEN s = '' THEN 'A' ELSE replace(s, 'N', 'A') END AS seq FROM c""")
def poly_tails(spark, sf):
    return reads.trim_poly_tails(A.reads(spark, sf), keep_short=True).select("read_id", "seq")


@query(f"WITH {A.READS} SELECT read_id, CAST(p AS INTEGER) AS at, substr(seq, p + 1, 10) AS seq FROM (SELECT read_id, seq, unnest(range(0, length(seq) - 10 + 1, 4)) AS p FROM reads)")
def sliding_windows(spark, sf):
    return reads.windows(A.reads(spark, sf), 10, 4).select("read_id", "at", "seq")


@query(f"""WITH {A.ALN}, c AS (SELECT 200 - qty AS fragment, count(*) AS n FROM aln GROUP BY 1) SELECT fragment, n, round(100 * n / sum(n) OVER (), 6) AS share, round(100 * sum(n) OVER (ORDER BY fragment) / sum(n) OVER (), 6) AS running FROM c""")
def fragment_histogram(spark, sf):
    shares, _ = reads.fragment_histogram(A.alignments(spark, sf).select((200 - F.col("qty")).alias("fragment")), 100)
    return shares


@query(f"""WITH {_pair_set_sql('a', 60)}, {_pair_set_sql('b', 90)}, u AS (SELECT g_lo, g_hi FROM a UNION SELECT g_lo, g_hi FROM b) SELECT g_lo, g_hi, CASE WHEN (g_lo, g_hi) IN (SELECT (g_lo, g_hi) FROM a) AND (g_lo, g_hi) IN (SELECT (g_lo, g_hi) FROM b) THEN 'both' WHEN (g_lo, g_hi) IN (SELECT (g_lo, g_hi) FROM a) THEN 'first' ELSE 'second' END AS side FROM u""")
def pair_sets(spark, sf):
    a, b = (_pair_set(spark, sf, d).select("g_lo", "g_hi") for d in (60, 90))
    side = lambda df, name: df.withColumn("side", F.lit(name))
    return side(a.intersect(b), "both").union(side(a.exceptAll(b), "first")).union(side(b.exceptAll(a), "second"))


@query(f"WITH {A.CANDIDATES} SELECT * FROM cand ORDER BY n DESC, g_lo DESC, g_hi DESC LIMIT 100")
def top_pairs(spark, sf):
    return _candidates(spark, sf).orderBy(F.desc("n"), F.desc("g_lo"), F.desc("g_hi")).limit(100)


@query(f"""WITH {A.ALN}, p AS (SELECT CASE WHEN frag % 10 = 0 THEN 'normal' ELSE 'tumour' END AS kind, least(gene, 'G' || CAST(part % 97 AS VARCHAR)) AS g_lo, greatest(gene, 'G' || CAST(part % 97 AS VARCHAR)) AS g_hi, count(*) AS n FROM aln GROUP BY ALL)
SELECT g_lo, g_hi, n, concat_ws(',', CASE WHEN m >= 2 THEN 'partial-matched-normal' END, CASE WHEN m >= 3 THEN 'matched-normal' END) AS labels FROM (SELECT t.g_lo, t.g_hi, t.n, x.n AS m FROM p t LEFT JOIN p x ON x.kind = 'normal' AND t.g_lo = x.g_lo AND t.g_hi = x.g_hi WHERE t.kind = 'tumour')""")
def sample_normals(spark, sf):
    other = F.concat(F.lit("G"), (F.col("part") % 97).cast("string"))
    p = A.alignments(spark, sf).groupBy((F.col("frag") % 10 == 0).alias("normal"), F.least("gene", other).alias("g_lo"), F.greatest("gene", other).alias("g_hi")).agg(F.count("*").alias("n"))
    tumour = p.where("not normal").select("g_lo", "g_hi", "n", F.array().cast("array<string>").alias("labels"))
    normals = p.where("normal").select("g_lo", "g_hi", "n")
    return report.matched_normals(tumour, normals, normals.where("n >= 3")).select("g_lo", "g_hi", "n", F.array_join("labels", ",").alias("labels"))


@query(f"""WITH {A.ALN}, s AS (SELECT frag, mate, list_sort(list(DISTINCT gene)) AS g FROM aln GROUP BY frag, mate) SELECT a.frag AS read_id, array_to_string(a.g, ',') AS genes_1, array_to_string(b.g, ',') AS genes_2 FROM s a JOIN s b ON a.frag = b.frag AND a.mate = 1 AND b.mate = 2 WHERE len(a.g) <= 3 AND len(b.g) <= 3 AND NOT list_has_any(a.g, b.g)""")
def split_read_pairs(spark, sf):
    rows = align.split_pairs(A.alignments(spark, sf).select(F.col("frag").alias("read_id"), "gene", F.col("mate").alias("part")))
    return rows.select("read_id", F.array_join("genes_1", ",").alias("genes_1"), F.array_join("genes_2", ",").alias("genes_2"))


@query(f"""WITH {A.ALN}, h AS (SELECT frag, mate, 'G' || CAST(part % 6 AS VARCHAR) AS gene FROM aln), s AS (SELECT frag, count(*) AS n, list_sort(list_intersect(list(DISTINCT gene) FILTER (mate = 1), list(DISTINCT gene) FILTER (mate = 2))) AS g FROM h GROUP BY frag HAVING count(DISTINCT mate) = 2)
SELECT frag, array_to_string(g, ',') AS genes, CASE WHEN n < 7 AND len(g) = 2 THEN 'good' ELSE 'bad' END AS side FROM s""")
def fragment_gene_pairs(spark, sf):
    good, bad = align.filter_fragment_pairs(A.alignments(spark, sf).select("frag", "mate", F.concat(F.lit("G"), (F.col("part") % 6).cast("string")).alias("gene")))
    both = good.withColumn("side", F.lit("good")).union(bad.withColumn("side", F.lit("bad")))
    return both.select("frag", F.array_join("genes", ",").alias("genes"), "side")


@query(f"""WITH {A.READS}, j AS (SELECT read_id, substr(seq, 1, 12) || '*' || substr(seq, 13) AS s FROM reads), k AS (SELECT read_id, right(split_part(s, '*', 1), 6) || '*' || left(split_part(s, '*', 2), 6) AS w FROM j)
SELECT read_id, CASE WHEN w IN (SELECT w FROM k WHERE read_id LIKE 'R%0/1') THEN 'removed' ELSE 'kept' END AS side FROM k""")
def banned_junctions(spark, sf):
    rows = A.reads(spark, sf).select("read_id", S.junction_star("seq", F.lit(12)).alias("seq"))
    kept, removed = report.filter_sequences(rows, rows.where("read_id like 'R%0/1'"), window=6)
    return kept.select("read_id").withColumn("side", F.lit("kept")).union(removed.select("read_id").withColumn("side", F.lit("removed")))


@query(f"""WITH {A.PSL}, b AS (SELECT q_name, t_name, matches, mismatches, ord, [matches % 20, matches - matches % 20] AS sizes FROM psl), m AS (SELECT *, list_sum(list_filter(sizes, lambda x: x < 15)) AS short FROM b)
SELECT q_name, ord, CAST(matches - coalesce(short, 0) AS BIGINT) AS matches, CAST(mismatches + coalesce(short, 0) AS BIGINT) AS mismatches FROM m WHERE mismatches <= 10 AND mismatches + coalesce(short, 0) <= 10""")
def short_blocks(spark, sf):
    rows = A.hits(spark, sf).withColumn("block_sizes", F.array(F.col("matches") % 20, F.col("matches") - F.col("matches") % 20))
    return align.short_blocks_as_mismatches(rows, 15, 10).select("q_name", "ord", F.col("matches").cast("bigint").alias("matches"), F.col("mismatches").cast("bigint").alias("mismatches"))


@query("SELECT 'C' || CAST(o_custkey AS VARCHAR) AS gene, o_orderpriority AS chrom, o_orderstatus AS strand, min(o_orderkey * 10) AS \"start\", max(o_orderkey * 10 + 5) AS \"end\" FROM orders GROUP BY ALL")
def gene_bounds(spark, sf):
    rows = A.table(spark, sf, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("gene"), F.col("o_orderpriority").alias("chrom"), F.col("o_orderstatus").alias("strand"), (F.col("o_orderkey") * 10).alias("exon_start"), (F.col("o_orderkey") * 10 + 5).alias("exon_end"))
    return annot.gene_bounds(rows)


@query("SELECT DISTINCT 'P' || CAST(p_partkey AS VARCHAR) AS gene, CASE WHEN p_type ILIKE '%eco%' THEN 'economy' ELSE 'small' END AS class FROM part WHERE p_type ILIKE '%eco%' UNION SELECT 'P' || CAST(p_partkey AS VARCHAR), 'small' FROM part WHERE p_name ILIKE '%small%'")
def gene_classes(spark, sf):
    p = A.table(spark, sf, "part").withColumn("gene", F.concat(F.lit("P"), F.col("p_partkey").cast("string")))
    return annot.gene_class(p, "p_type", "eco").withColumn("class", F.lit("economy")).union(annot.gene_class(p, "p_name", "small").withColumn("class", F.lit("small")))


@query("SELECT upper(p_brand) AS symbol, 2 * count(*) AS n FROM part GROUP BY 1")
def symbol_counts(spark, sf):
    return annot.symbol_frequencies(A.table(spark, sf, "part").select(F.col("p_brand").alias("symbol_1"), F.col("p_brand").alias("symbol_2")))
