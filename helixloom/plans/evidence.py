"""Queries of alignment evidence, reads, reference sequences and late report steps, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixloom.operators import alignments as align
from helixloom.operators import annotation as annot
from helixloom.operators import intervals, junctions, pairs, reads, report
from helixloom.plans import analogs as A
from helixloom.plans.registry import query
from helixloom.streaming.pair_counts import windowed_counts

SUPPLIER_GENES = """sg AS (SELECT 'G' || CAST(s_suppkey AS VARCHAR) AS gene, s_nationkey % 5 AS chrom, s_suppkey * 1000 AS s, s_suppkey * 1000 + 3000 AS e, s_suppkey % 2 AS strand FROM supplier)"""


def _supplier_genes(spark, sf):
    return A.table(spark, sf, "supplier").select(F.concat(F.lit("G"), F.col("s_suppkey").cast("string")).alias("gene"), (F.col("s_nationkey") % 5).alias("chrom"), (F.col("s_suppkey") * 1000).alias("start"), (F.col("s_suppkey") * 1000 + 3000).alias("end"), F.when(F.col("s_suppkey") % 2 == 1, "-").otherwise("+").alias("strand"))


def _read_id(mate=None):
    return F.concat(F.col("frag").cast("string"), F.lit("/"), F.col("mate").cast("string") if mate is None else F.lit(mate))


@query(f"""WITH {A.ALN}, {SUPPLIER_GENES}, d AS (SELECT DISTINCT frag, gene, chrom, s, e FROM aln JOIN sg USING (gene)), bad AS (SELECT DISTINCT a.frag FROM d a JOIN d b ON a.frag = b.frag AND a.gene < b.gene WHERE NOT (a.chrom = b.chrom AND a.e - b.s > 50 AND b.e - a.s > 50))
SELECT CAST(frag AS VARCHAR) || '/' || m AS read_id FROM bad, (VALUES ('1'), ('2')) t(m)""")
def offending_reads(spark, sf):
    hits = A.alignments(spark, sf).select(_read_id("1").alias("read_id"), "gene")
    return pairs.offending_reads(hits, _supplier_genes(spark, sf).drop("strand"))


BLOCKS = f"""{A.ALN}, p AS (SELECT frag, ord, qty AS matches, line AS mismatches, qty + 10 AS q_size, 1 + part % 3 AS block_count, line % 3 AS t_num_insert, line % 2 AS q_num_insert, part % 6 AS q_base_insert, [qty % 30, qty - qty % 30] AS block_sizes, [pos, pos + 40] AS t_starts, pos AS t_start, pos + 90 AS t_end, gene || '|G' || CAST(part % 97 AS VARCHAR) || '|' || CAST(pos + 30 AS VARCHAR) AS t_name, pos + 30 AS border FROM aln)"""


def _blocks(spark, sf):
    q, pos = F.col("qty"), F.col("pos")
    return A.alignments(spark, sf).select("frag", "ord", q.alias("matches"), F.col("line").alias("mismatches"), (q + 10).alias("q_size"), (1 + F.col("part") % 3).alias("block_count"), (F.col("line") % 3).alias("t_num_insert"), (F.col("line") % 2).alias("q_num_insert"), (F.col("part") % 6).alias("q_base_insert"), F.array(q % 30, q - q % 30).alias("block_sizes"), F.array(pos, pos + 40).alias("t_starts"), pos.alias("t_start"), (pos + 90).alias("t_end"), F.concat("gene", F.lit("|G"), (F.col("part") % 97).cast("string"), F.lit("|"), (pos + 30).cast("string")).alias("t_name"))


F4 = "matches / q_size >= {} AND block_count = 2 AND t_num_insert = 1 AND (q_num_insert = 0 OR (q_num_insert = 1 AND q_base_insert <= 3)) AND least(block_sizes[1], block_sizes[2]) > {}"


@query(f"WITH {BLOCKS} SELECT frag, ord, 'fusion' AS kind FROM p WHERE {F4.format(0.7, 9)} UNION ALL SELECT frag, ord, 'border' FROM p WHERE {F4.format(0.6, 7)} AND t_starts[1] + block_sizes[1] <= border + 1 AND t_starts[2] + 1 > border AND t_start < border AND border < t_end UNION ALL SELECT frag, ord, 'blocks' FROM p WHERE block_count > 1 AND block_count < 9 AND t_num_insert > 0 AND t_num_insert < 7 AND q_num_insert < 7 AND mismatches <= 5 AND matches / q_size >= 0.75 AND t_start < border AND border < t_end")
def psl_filters(spark, sf):
    p = _blocks(spark, sf)
    kinds = ((align.fusion_hits(p), "fusion"), (align.junction_hits_two(p, 0.6, 8), "border"), (align.junction_hits(p, 0.75, 5), "blocks"))
    out = [df.select("frag", "ord", F.lit(k).alias("kind")) for df, k in kinds]
    return out[0].union(out[1]).union(out[2])


@query(f"""WITH {BLOCKS}, a AS (SELECT frag, ord, list_sum([greatest(0, least(block_sizes[1], border - t_starts[1])), greatest(0, least(block_sizes[2], border - t_starts[2]))]) AS l, block_sizes[1] + block_sizes[2] AS t FROM p)
SELECT frag, ord, CAST(l AS BIGINT) AS anchor_1, CAST(t - l AS BIGINT) AS anchor_2 FROM a WHERE least(l, t - l) >= 5""")
def border_anchors(spark, sf):
    rows = align.border_anchors(align.with_border(_blocks(spark, sf)), 5)
    return rows.select("frag", "ord", F.col("anchor_1").cast("bigint").alias("anchor_1"), F.col("anchor_2").cast("bigint").alias("anchor_2"))


@query(f"""WITH {A.PSL}, o AS (SELECT *, row_number() OVER (PARTITION BY q_name, matches, t_name ORDER BY mismatches, block_count, t_start) AS k FROM psl), u AS (SELECT *, row_number() OVER w AS rn, lead(matches) OVER w AS nxt FROM o WHERE k = 1 WINDOW w AS (PARTITION BY q_name ORDER BY matches DESC, mismatches, block_count, t_name, t_start))
SELECT q_name, t_name AS gene, matches, t_start FROM u WHERE rn = 1 AND (nxt IS NULL OR nxt <> matches)""")
def best_unique_by_gene(spark, sf):
    unique, _ = align.best_unique_by_gene(A.hits(spark, sf).withColumn("gene", F.col("t_name")))
    return unique.select("q_name", "gene", "matches", "t_start")


@query(f"""WITH {A.ALN}, p AS (SELECT frag AS q_name, gene || '|' || 'G' || CAST(part % 97 AS VARCHAR) AS t_name, gene AS a, 'G' || CAST(part % 97 AS VARCHAR) AS b, qty // 25 AS m, ord FROM aln), t AS (SELECT * FROM p x WHERE m = (SELECT max(m) FROM p y WHERE y.q_name = x.q_name)),
ov AS (SELECT 'G' || CAST(s_suppkey AS VARCHAR) AS lo, 'G' || CAST(s_suppkey + 1 AS VARCHAR) AS hi FROM supplier UNION SELECT 'G' || CAST(s_suppkey AS VARCHAR), 'G' || CAST(s_suppkey AS VARCHAR) FROM supplier), l AS (SELECT lo, hi FROM ov UNION SELECT hi, lo FROM ov),
bad AS (SELECT DISTINCT x.q_name FROM t x JOIN t y ON x.q_name = y.q_name AND x.t_name < y.t_name WHERE NOT EXISTS (SELECT 1 FROM l WHERE (lo = x.a OR lo = x.b) AND (hi = y.a OR hi = y.b))), n AS (SELECT q_name FROM t GROUP BY q_name HAVING count(*) = 1 OR count(*) = count(DISTINCT (least(a, b), greatest(a, b))))
SELECT q_name, t_name, ord FROM t WHERE q_name IN (SELECT q_name FROM n) AND q_name NOT IN (SELECT q_name FROM bad)""")
def best_hits_overlapping(spark, sf):
    other = F.concat(F.lit("G"), (F.col("part") % 97).cast("string"))
    rows = A.alignments(spark, sf).select(F.col("frag").alias("q_name"), F.concat("gene", F.lit("|"), other).alias("t_name"), F.col("gene").alias("gene_1"), other.alias("gene_2"), F.floor(F.col("qty") / 25).alias("matches"), "ord")
    g = lambda k: F.concat(F.lit("G"), (F.col("s_suppkey") + k).cast("string"))
    s = A.table(spark, sf, "supplier")
    over = s.select(g(0).alias("g_lo"), g(1).alias("g_hi")).union(s.select(g(0), g(0)))
    return align.best_hits_overlapping_genes(rows, over).select("q_name", "t_name", "ord")


@query(f"""WITH {A.ALN}, j AS (SELECT CAST(frag AS VARCHAR) || '/' || mate AS read_id, CAST(frag AS VARCHAR) AS frag, gene AS gene_1, 'G' || CAST(part % 97 AS VARCHAR) AS gene_2 FROM aln WHERE line <= 2), twice AS (SELECT frag FROM j GROUP BY frag HAVING min(read_id) <> max(read_id)), m AS (SELECT DISTINCT CAST(frag AS VARCHAR) || '/' || (3 - mate) AS read_id, gene FROM aln WHERE line > 2)
SELECT read_id, gene_1, gene_2 FROM j WHERE frag NOT IN (SELECT frag FROM twice) AND EXISTS (SELECT 1 FROM m WHERE m.read_id = j.read_id AND (m.gene = gene_1 OR m.gene = gene_2))""")
def mate_consistency_single(spark, sf):
    a = A.alignments(spark, sf)
    hits = a.where("line <= 2").select(_read_id().alias("read_id"), F.col("gene").alias("gene_1"), F.concat(F.lit("G"), (F.col("part") % 97).cast("string")).alias("gene_2"))
    return align.mate_consistent_single(hits, a.where("line > 2").select(_read_id().alias("read_id"), "gene"))


@query(f"""WITH {A.ALN}, r AS (SELECT CAST(frag AS VARCHAR) || '/' || mate AS read_id, frag, ord FROM aln WHERE line <= 2), twice AS (SELECT frag FROM r GROUP BY frag HAVING min(read_id) <> max(read_id)), near AS (SELECT CAST(frag AS VARCHAR) || '/' || (3 - mate) AS read_id FROM aln WHERE line > 2 AND gene LIKE 'G1%')
SELECT read_id, ord FROM r WHERE frag NOT IN (SELECT frag FROM twice) AND read_id IN (SELECT read_id FROM near)""")
def reads_with_candidate_mate(spark, sf):
    a = A.alignments(spark, sf)
    genes = a.select("gene").where("gene like 'G1%'").distinct()
    return align.reads_with_candidate_mate(a.where("line <= 2").select(_read_id().alias("read_id"), "ord"), a.where("line > 2").select(_read_id().alias("read_id"), "gene"), genes)


@query(f"""WITH {A.ALN}, p AS (SELECT frag AS q_name, part % 2 AS t_name, '+' AS strand, ord, line * 10 AS q_start, line * 10 + 10 + part % 5 AS q_end, pos AS t_start, pos + 10 AS t_end, 10 AS m FROM aln)
SELECT a.q_name, a.t_name, a.q_start, b.q_end, a.t_start, b.t_end, CAST(20 - greatest(0, a.q_end - b.q_start) AS INTEGER) AS matches, CAST(greatest(0, b.q_start - a.q_end) AS INTEGER) AS mismatches
FROM p a JOIN p b USING (q_name, t_name) WHERE (a.q_start < b.q_start OR (a.q_start = b.q_start AND a.ord < b.ord)) AND a.t_start < b.t_start AND b.q_start - a.q_end <= 9 AND b.q_start - a.q_end > -17 AND b.q_end - b.q_start > greatest(0, a.q_end - b.q_start)""")
def split_part_merge(spark, sf):
    start = F.col("line") * 10
    rows = A.alignments(spark, sf).select(F.col("frag").alias("q_name"), (F.col("part") % 2).alias("t_name"), F.lit("+").alias("strand"), "ord", start.alias("q_start"), (start + 10 + F.col("part") % 5).cast("int").alias("q_end"), F.col("pos").alias("t_start"), (F.col("pos") + 10).alias("t_end"), F.lit(10).alias("matches"), F.lit(0).alias("mismatches"))
    return align.merge_parts(rows).select("q_name", "t_name", F.col("q_start").cast("int").alias("q_start"), F.col("q_end").cast("bigint").alias("q_end"), "t_start", "t_end", F.col("matches").cast("int").alias("matches"), F.col("mismatches").cast("int").alias("mismatches"))


@query("""WITH s AS (SELECT 'r' || CAST(p_partkey AS VARCHAR) AS q, p_size AS a, 1 + p_partkey % 9 AS c, p_partkey % 50 AS n, p_partkey % 3 AS nm, p_partkey % 2 * 16 AS flag FROM part)
SELECT q AS q_name, CASE WHEN flag = 16 THEN '-' ELSE '+' END AS strand, CAST(a + c - nm AS BIGINT) AS matches, CAST(a + c + 3 AS BIGINT) AS q_size, CAST(3 AS BIGINT) AS q_start, CAST(99 AS BIGINT) AS t_start, CAST(99 + a + n + 1 + c AS BIGINT) AS t_end, '3' || ',' || CAST(3 + a AS VARCHAR) AS q_starts, CAST(a AS VARCHAR) || ',' || CAST(c AS VARCHAR) AS block_sizes FROM s""")
def sam_to_psl(spark, sf):
    p = A.table(spark, sf, "part")
    c, n = 1 + F.col("p_partkey") % 9, F.col("p_partkey") % 50 + 1
    cigar = F.concat(F.lit("3S"), F.col("p_size").cast("string"), F.lit("M"), n.cast("string"), F.lit("N"), c.cast("string"), F.lit("M"))
    sam = p.select(F.concat(F.lit("r"), F.col("p_partkey").cast("string")).alias("qname"), (F.col("p_partkey") % 2 * 16).alias("flag"), F.lit("c").alias("rname"), F.lit(100).alias("pos"), cigar.alias("cigar"), (F.col("p_partkey") % 3).cast("int").alias("nm"))
    out = align.sam_to_psl(sam, spark.createDataFrame([("c", 10_000)], "rname string, length bigint"))
    text = lambda x: F.array_join(F.transform(x, lambda v: v.cast("string")), ",")
    return out.select("q_name", "strand", *[F.col(x).cast("bigint").alias(x) for x in ("matches", "q_size", "q_start", "t_start", "t_end")], text("q_starts").alias("q_starts"), text("block_sizes").alias("block_sizes"))


@query(f"""WITH {A.READS}, q AS (SELECT read_id, seq, substr(qual, 1, length(qual) - least(length(qual), 4)) || repeat('B', least(length(qual), 4)) AS qual FROM reads)
SELECT read_id, substr(seq, 1, length(rtrim(qual, 'B'))) || repeat('N', length(seq) - length(rtrim(qual, 'B'))) AS masked, rpad(seq, 20, 'N') AS padded, replace(replace(qual, 'I', '*'), 'B', '#') AS quality FROM q""")
def quality_steps(spark, sf):
    tail = F.least(F.length("qual"), F.lit(4))
    r = A.reads(spark, sf).withColumn("qual", F.concat(F.substring(F.col("qual"), F.lit(1), F.length("qual") - tail), F.repeat(F.lit("B"), tail)))
    masked, padded, moved = reads.mask_low_quality(r), reads.pad(r, 20), reads.convert_quality(r, 64, 33)
    return masked.select("read_id", F.col("seq").alias("masked")).join(padded.select("read_id", F.col("seq").alias("padded")), "read_id").join(moved.select("read_id", F.col("qual").alias("quality")), "read_id")


def _window_ends(c):
    return f"CASE WHEN length({c}) <= 12 THEN [length({c})] WHEN length({c}) - range(12, length({c}), 8)[-1] >= 4 THEN list_append(range(12, length({c}), 8), length({c})) ELSE range(12, length({c}), 8) END"


@query(f"""WITH {A.READS}, p AS (SELECT split_part(read_id, '/', 1) AS frag, seq AS s1, left(reverse(seq), 26) AS s2 FROM reads), e AS (SELECT *, {_window_ends('s1')} AS e1, {_window_ends('s2')} AS e2 FROM p),
w AS (SELECT frag, i, j, substr(s1, greatest(0, e1[i + 1] - 12) + 1, least(12, e1[i + 1])) AS seq_1, substr(s2, greatest(0, e2[j + 1] - 12) + 1, least(12, e2[j + 1])) AS seq_2 FROM e, range(0, 30) t(i), range(0, 30) u(j) WHERE i < len(e1) AND j < len(e2) AND (i < 2 OR j < 2)),
n AS (SELECT *, row_number() OVER (PARTITION BY frag ORDER BY j >= 2, CASE WHEN j >= 2 THEN i ELSE j END, CASE WHEN j >= 2 THEN j ELSE i END) - 1 AS k FROM w) SELECT printf('%02d', k) || '_' || frag AS read_id, seq_1, seq_2 FROM n""")
def fragment_pairs(spark, sf):
    p = A.reads(spark, sf).select(F.split_part("read_id", F.lit("/"), F.lit(1)).alias("frag"), F.col("seq").alias("seq_1"), F.left(F.reverse("seq"), F.lit(26)).alias("seq_2"))
    return reads.fragment_pairs(p, 12, 8, 2, 4)


SPLIT_READS = f"""WITH {A.READS}, c AS (SELECT read_id, seq, length(seq) AS n, length(seq) // 2 - 1 + w AS c, g, d FROM reads, (VALUES (-1), (0), (1)) t(w), (VALUES (1), (2)) u(g), (VALUES (0), (1)) v(d)),
q AS (SELECT read_id, seq, n, c, g, d, c + 1 - CASE WHEN d = 0 THEN g ELSE 0 END AS a, c + 1 + CASE WHEN d = 1 THEN g ELSE 0 END AS b FROM c), f AS (SELECT read_id, seq, n, a, b, min((g, c, d)) AS o FROM q WHERE a >= 8 AND n - b >= 6 + d GROUP BY read_id, seq, n, a, b),
y AS (SELECT read_id, seq, o, 0 AS copy, 0 AS l, a, b, n AS r FROM f UNION ALL SELECT read_id, seq, o, 1, CASE WHEN a > 20 THEN a - 20 ELSE 0 END, a, b, CASE WHEN a > 20 THEN n ELSE b + 20 END FROM f WHERE a > 20 OR n - b >= 20),
k AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY o, copy) - 1 AS k FROM y)
SELECT read_id || '__' || printf('%02d', k) || x AS read_id, CASE WHEN x = 'a' THEN substr(seq, l + 1, a - l) ELSE substr(seq, b + 1, r - b) END AS seq FROM k, (VALUES ('a'), ('b')) t(x)"""


@query(SPLIT_READS)
def split_reads(spark, sf):
    r = A.reads(spark, sf)
    cuts = r.select("read_id", (F.floor(F.length("seq") / 2).cast("int") - 1).alias("cut"))
    return reads.split_at(r, cuts, wiggle=1, gap=2, anchor=8, anchor_max=20).select("read_id", "seq")


@query(f"""WITH {A.READS} SELECT read_id || '_' || CAST(p AS VARCHAR) AS frag, substr(seq, p + 1, 10) AS seq_1, reverse(translate(substr(seq, p + 16, 10), 'ACGTN', 'TGCAA')) AS seq_2 FROM (SELECT read_id, seq, unnest(range(0, length(seq) - 25 + 1, 3)) AS p FROM reads)""")
def simulated_reads(spark, sf):
    return reads.simulated_reads(A.reads(spark, sf).withColumnRenamed("read_id", "id"), step=3, gap=5, length=10)


@query(f"WITH {A.READS} SELECT CAST(length(seq) AS INTEGER) AS length, count(*) AS n FROM reads GROUP BY 1")
def read_lengths(spark, sf):
    return reads.read_lengths(A.reads(spark, sf))


@query(f"""WITH {A.ALN}, ids AS (SELECT DISTINCT CAST(frag AS VARCHAR) || '/' || mate AS read_id FROM aln WHERE gene LIKE 'G2%'), r AS (SELECT CAST(frag AS VARCHAR) || '/' || mate AS read_id, CAST(frag AS VARCHAR) || '/' || (3 - mate) AS other, ord FROM aln)
SELECT read_id, ord, 'extract' AS kind FROM r WHERE read_id IN (SELECT read_id FROM ids) UNION ALL SELECT read_id, ord, 'remove' FROM r WHERE read_id NOT IN (SELECT read_id FROM ids) UNION ALL SELECT read_id, ord, 'mate' FROM r WHERE other IN (SELECT read_id FROM ids)""")
def reads_by_ids(spark, sf):
    r = A.alignments(spark, sf).withColumn("read_id", _read_id())
    ids, rows = r.where("gene like 'G2%'").select("read_id"), r.select("read_id", "ord")
    out = [align.by_read_ids(rows, ids).withColumn("kind", F.lit("extract")), align.by_read_ids(rows, ids, extract=False).withColumn("kind", F.lit("remove")), align.by_read_ids(rows, ids, mate=True).withColumn("kind", F.lit("mate"))]
    return out[0].union(out[1]).union(out[2])


EXONS = f"""{A.READS}, x AS (SELECT 'K' || CAST(CAST(substr(split_part(read_id, '/', 1), 2) AS BIGINT) % 200 AS VARCHAR) AS gene, 'T' || CAST(CAST(substr(split_part(read_id, '/', 1), 2) AS BIGINT) % 400 AS VARCHAR) AS transcript, read_id AS exon, CAST(substr(split_part(read_id, '/', 1), 2) AS BIGINT) // 400 AS rank, seq FROM reads)"""


def _exons(spark, sf):
    n = F.substring(F.split_part("read_id", F.lit("/"), F.lit(1)), 2, 99).cast("bigint")
    return A.reads(spark, sf).select(F.concat(F.lit("K"), (n % 200).cast("string")).alias("gene"), F.concat(F.lit("T"), (n % 400).cast("string")).alias("transcript"), F.col("read_id").alias("exon"), F.floor(n / 400).alias("rank"), "seq")


def _exon_pairs(spark, sf):
    """Each gene with itself and with the next one; a pair whose second gene has no exons finds no partner in the joins."""
    n = _exons(spark, sf).select(F.substring("gene", 2, 99).cast("bigint").alias("n")).distinct()
    return n.withColumn("d", F.explode(F.array(F.lit(0), F.lit(1)))).select(F.concat(F.lit("K"), F.col("n").cast("string")).alias("g_lo"), F.concat(F.lit("K"), (F.col("n") + F.col("d")).cast("string")).alias("g_hi"))


ALL_GENES = "(SELECT DISTINCT CAST(substr(gene, 2) AS BIGINT) AS i FROM x) t"


JUNCTIONS = f"""{EXONS}, pr AS (SELECT 'K' || i AS a, 'K' || (i + d) AS b FROM {ALL_GENES}, range(0, 2) u(d)), o AS (SELECT a, b FROM pr UNION ALL SELECT b, a FROM pr WHERE a <> b),
j AS (SELECT x.gene AS gene_1, y.gene AS gene_2, x.gene || '-' || y.gene || ';' || x.transcript || '-' || y.transcript || ';' || x.exon || '-' || y.exon || ';rank_exon=' || x.rank || '-' || y.rank || ';length=' || length(right(x.seq, 8) || left(y.seq, 8)) || ';junction=' || length(right(x.seq, 8)) AS id, CAST(length(right(x.seq, 8)) AS INTEGER) AS junction, right(x.seq, 8) || left(y.seq, 8) AS seq
  FROM o JOIN x ON o.a = x.gene JOIN x y ON o.b = y.gene WHERE x.gene <> y.gene OR x.transcript < y.transcript OR (x.transcript = y.transcript AND x.rank < y.rank))"""


@query(f"WITH {JUNCTIONS} SELECT * FROM j")
def exon_exon_junctions(spark, sf):
    return junctions.exon_exon_junctions(_exon_pairs(spark, sf), _exons(spark, sf), 8)


def _junctions_by_pair(spark, sf):
    return junctions.exon_exon_junctions(_exon_pairs(spark, sf), _exons(spark, sf), 8, together=True)


@query(f"WITH {JUNCTIONS} SELECT gene_1, gene_2, seq, min(id) AS id, coalesce(array_to_string(list_sort(list(DISTINCT id))[2:], '|'), '') AS others FROM j GROUP BY gene_1, gene_2, seq")
def unique_junction_sequences(spark, sf):
    return junctions.unique_sequences(_junctions_by_pair(spark, sf)).select("gene_1", "gene_2", "seq", "id", "others")


@query(f"WITH {JUNCTIONS}, f AS (SELECT id, gene_1, gene_2, min(id) OVER (PARTITION BY gene_1, gene_2, seq) AS f FROM j) SELECT id, gene_1, gene_2, CAST(dense_rank() OVER (PARTITION BY gene_1, gene_2 ORDER BY f) - 1 AS INTEGER) AS index FROM f")
def junction_sequence_index(spark, sf):
    return junctions.sequence_index(_junctions_by_pair(spark, sf))


@query(f"WITH {EXONS}, g AS (SELECT gene, min(seq) AS seq FROM x GROUP BY gene), pr AS (SELECT 'K' || i AS a, 'K' || (i + 1) AS b FROM {ALL_GENES}), o AS (SELECT a, b FROM pr UNION ALL SELECT b, a FROM pr) SELECT a || '|' || b || '|' || length(p.seq) AS id, p.seq || q.seq AS seq FROM o JOIN g p ON a = p.gene JOIN g q ON b = q.gene")
def gene_gene_junctions(spark, sf):
    return junctions.gene_gene_junctions(_exon_pairs(spark, sf).where("g_lo <> g_hi"), _exons(spark, sf).groupBy("gene").agg(F.min("seq").alias("seq")))


@query(f"WITH {EXONS} SELECT transcript, gene, string_agg(seq, '' ORDER BY rank, exon) AS seq, string_agg(exon, ',' ORDER BY rank, exon) AS exons FROM x GROUP BY transcript, gene HAVING length(string_agg(seq, '')) > 60")
def transcript_sequences(spark, sf):
    x = _exons(spark, sf)
    rows = annot.transcripts(x.drop("seq").withColumn("exon_start", F.lit(1)).withColumn("exon_end", F.lit(1)), x.select(F.col("exon").alias("id"), "seq"), least=60)
    return rows.select("transcript", "gene", "seq", F.array_join(F.transform("exons", lambda e: e["exon"]), ",").alias("exons"))


SMOOTH = f"""{A.ALN}, r AS (SELECT gene AS key, pos AS c1, pos % 4 AS c2, CAST(ord AS VARCHAR) || '_' || CAST(frag AS VARCHAR) AS read_id FROM aln), cuts AS (SELECT DISTINCT key, c1, c2 FROM r), n AS (SELECT r.key, cuts.c1 AS cut_1, cuts.c2 AS cut_2, read_id FROM r JOIN cuts ON r.key = cuts.key AND abs(r.c1 - cuts.c1) <= 3 AND abs(r.c2 - cuts.c2) <= 3)"""


@query(f"WITH {SMOOTH} SELECT key, cut_1, cut_2, count(DISTINCT read_id) AS n FROM n GROUP BY ALL")
def smoothed_junctions(spark, sf):
    rows = A.alignments(spark, sf).select(F.col("gene").alias("key"), F.col("pos").alias("cut_1"), (F.col("pos") % 4).alias("cut_2"), F.concat_ws("_", F.col("ord").cast("string"), F.col("frag").cast("string")).alias("read_id"), F.lit("ACGTACGT").alias("seq_1"), F.lit("ACGTACGT").alias("seq_2"))
    return report.smooth_junctions(rows).groupBy("key", "cut_1", "cut_2").agg(F.count("*").alias("n"))


#: An order is an exon of two transcripts' genes; orders in status P are coding from a base of their own on. Every eleventh
#: point lies on another chromosome.
FRAMES = """f AS (SELECT 'C' || CAST(o_custkey AS VARCHAR) AS gene, 'T' || CAST(o_custkey AS VARCHAR) || '_' || CAST(o_orderkey % 2 AS VARCHAR) AS tr, 'c' || CAST(o_custkey % 5 AS VARCHAR) AS chrom, CASE WHEN o_custkey % 2 = 1 THEN '-' ELSE '+' END AS strand, o_orderkey * 100 AS s, o_orderkey * 100 + 29 AS e, o_orderkey * 100 + o_orderkey % 4 AS cs, o_orderstatus = 'P' AS coding FROM orders),
pt AS (SELECT o_orderkey AS id, 'C' || CAST(o_custkey AS VARCHAR) AS gene, CASE WHEN o_orderkey % 11 = 0 THEN 'cx' ELSE 'c' || CAST(o_custkey % 5 AS VARCHAR) END AS chrom, CASE WHEN o_custkey % 2 = 1 THEN '-' ELSE '+' END AS strand, o_orderkey * 100 + o_orderkey % 40 AS p FROM orders),
ex AS (SELECT id, tr, p, pt.strand, sum(CASE WHEN e < p THEN e - s + 1 WHEN s <= p THEN p - s + 1 ELSE 0 END) AS upto, sum(e - s + 1) AS total, bool_or(p BETWEEN s AND e) AS hit, min(e) AS e1, max(s) AS s2 FROM pt JOIN f USING (gene, chrom) GROUP BY id, tr, p, pt.strand),
cd AS (SELECT id, tr, sum(CASE WHEN e < p THEN e - cs + 1 WHEN cs <= p THEN p - cs + 1 ELSE 0 END) AS upto, sum(e - cs + 1) AS total, bool_or(p BETWEEN cs AND e) AS hit, max(e) AS e2, p FROM pt JOIN f USING (gene, chrom) WHERE coding GROUP BY id, tr, p),
h AS (SELECT id, tr, ex.strand, CAST(CASE WHEN ex.strand = '+' THEN cd.upto ELSE cd.total - cd.upto + 1 END AS BIGINT) AS n, CAST(CASE WHEN ex.strand = '+' THEN ex.upto ELSE ex.total - ex.upto + 1 END AS BIGINT) AS m, CASE WHEN ex.strand = '+' THEN e2 = cd.p ELSE cd.upto = 1 END AS final FROM cd JOIN ex USING (id, tr) WHERE cd.hit AND cd.total % 3 = 0),
k AS (SELECT id, CASE WHEN id IN (SELECT id FROM h) THEN 'CDS' WHEN id IN (SELECT id FROM cd WHERE hit AND total % 3 <> 0) THEN 'CDS(no-known-start-or-end)' WHEN id IN (SELECT id FROM ex WHERE hit) THEN CASE WHEN gene IN (SELECT gene FROM f WHERE coding) THEN 'UTR' ELSE 'exonic(no-known-CDS)' END WHEN id IN (SELECT id FROM ex WHERE e1 < p AND s2 > p) THEN 'intronic' ELSE 'intergenic' END AS kind FROM pt)"""


def _frame_features(spark, sf):
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    strand = F.when(F.col("o_custkey") % 2 == 1, "-").otherwise("+")
    chrom = F.concat(F.lit("c"), (F.col("o_custkey") % 5).cast("string"))
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.concat(F.lit("C"), cust).alias("gene"), F.concat(F.lit("T"), cust, F.lit("_"), (key % 2).cast("string")).alias("transcript"), chrom.alias("chrom"), strand.alias("strand"))
    end = (key * 100 + 29).alias("end")
    exon = o.select("gene", "transcript", F.lit("exon").alias("feature"), "chrom", "strand", (key * 100).alias("start"), end)
    coding = o.where("o_orderstatus = 'P'").select("gene", "transcript", F.lit("CDS"), "chrom", "strand", key * 100 + key % 4, end)
    points = o.select(key.alias("id"), "gene", F.when(key % 11 == 0, "cx").otherwise(F.col("chrom")).alias("chrom"), (key * 100 + key % 40).alias("at"), "strand")
    return exon.union(coding), points


@query(f"WITH {FRAMES} SELECT k.id, kind, coalesce(string_agg(tr || ':' || n || ':' || (m - n) || CASE WHEN final THEN ':last' ELSE '' END, ';' ORDER BY tr), '') AS hits FROM k LEFT JOIN h ON h.id = k.id GROUP BY k.id, kind")
def breakpoint_classes(spark, sf):
    rows = report.breakpoint_class(*_frame_features(spark, sf))
    return rows.select("id", "kind", F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["transcript"], h["n"].cast("string"), h["utr"].cast("string"), F.when(h["last"], "last"))), ";").alias("hits"))


@query(f"""WITH {A.ALN}, p AS (SELECT gene AS fusion, frag AS read_id FROM aln WHERE mate = 1), j AS (SELECT gene AS fusion, frag AS read_id FROM aln WHERE line % 3 = 0), u AS (SELECT fusion, read_id, 1 AS p, 0 AS j FROM p UNION ALL SELECT fusion, read_id, 0, 1 FROM j)
SELECT fusion, read_id, CASE WHEN max(p) = 1 AND max(j) = 1 THEN '_supports_fusion_pair_and_junction' WHEN max(p) = 1 THEN '_supports_fusion_pair' ELSE '_supports_fusion_junction' END AS role FROM u GROUP BY ALL""")
def evidence_reads(spark, sf):
    a = A.alignments(spark, sf).select(F.col("gene").alias("fusion"), F.col("frag").alias("read_id"), "mate", "line")
    return report.evidence(a.where("mate = 1"), a.where("line % 3 = 0"))


@query(f"""WITH {A.ALN}, r AS (SELECT gene AS g_lo, 'X' AS g_hi, CAST(line AS VARCHAR) || '_' || CAST(frag % 50 AS VARCHAR) AS read_id, CAST(frag % 50 AS VARCHAR) AS o FROM aln) SELECT g_lo, g_hi, count(DISTINCT read_id) AS reads, count(DISTINCT o) AS originals FROM r GROUP BY g_lo, g_hi HAVING count(DISTINCT read_id) <> count(DISTINCT o) AND count(DISTINCT o) < 60""")
def fragment_support(spark, sf):
    rows = A.alignments(spark, sf).select(F.col("gene").alias("g_lo"), F.lit("X").alias("g_hi"), F.concat_ws("_", F.col("line").cast("string"), (F.col("frag") % 50).cast("string")).alias("read_id"))
    return pairs.fragments_fusion(rows, 60)


@query(f"WITH {A.ALN}, c AS (SELECT gene AS g_lo, 'G' || CAST(part % 97 AS VARCHAR) AS g_hi, count(*) AS n, count(DISTINCT CASE WHEN qty < 10 THEN frag END) AS t FROM aln GROUP BY ALL) SELECT g_lo, g_hi, n, CASE WHEN t > 0 THEN 't' || t ELSE '' END AS labels FROM c")
def short_read_labels(spark, sf):
    rows = A.alignments(spark, sf).select(F.col("gene").alias("g_lo"), F.concat(F.lit("G"), (F.col("part") % 97).cast("string")).alias("g_hi"), F.concat_ws("_", F.col("frag").cast("string"), "gene", (F.col("part") % 97).cast("string"), F.when(F.col("qty") < 10, "s").otherwise("l")).alias("read_id"), "qty")
    cand = rows.groupBy("g_lo", "g_hi").agg(F.count("*").alias("n")).withColumn("labels", F.array().cast("array<string>"))
    out = pairs.label_short_reads(cand, rows, rows.where("qty < 10").select("read_id").distinct())
    return out.select("g_lo", "g_hi", "n", F.array_join("labels", ",").alias("labels"))


@query("SELECT CAST(min(o_orderkey) AS BIGINT) AS ord, 'Human ' || o_orderpriority || ' virus' AS name FROM orders WHERE o_custkey % 4 NOT IN (1, 2) GROUP BY o_orderpriority ORDER BY 1 LIMIT 3")
def top_viruses(spark, sf):
    kind = F.element_at(F.array(F.lit("_virus,_complete_genome"), F.lit("_virus"), F.lit("_phage"), F.lit("_virus_complete_genome")), (F.col("o_custkey") % 4 + 1).cast("int"))
    rows = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("ord"), (F.col("o_custkey") % 4).alias("n"), F.concat(F.lit("Human_"), "o_orderpriority", kind).alias("name"))
    return report.top_viruses(rows)


@query(f"""WITH {A.GENES}, b AS (SELECT DISTINCT chrom, s // 100 AS k FROM genes) SELECT gene, CASE WHEN s // 100 % 3 = 2 THEN 'not-converted' WHEN s // 100 % 2 = 0 THEN 'n' || chrom || ':' || (s // 100 * 1000 + s % 100) || ':+' ELSE 'n' || chrom || ':' || (s // 100 * 1000 + 99 - s % 100) || ':-' END AS "to" FROM genes""")
def lift_over(spark, sf):
    g = A.genes(spark, sf)
    k = F.floor(F.col("start") / 100)
    blocks = g.select("chrom", k.alias("k")).distinct().where("k % 3 <> 2").select("chrom", (F.col("k") * 100).alias("start"), (F.col("k") * 100 + 99).alias("end"), F.concat(F.lit("n"), "chrom").alias("to_chrom"), (F.col("k") * 1000).alias("to_start"), (F.col("k") % 2 == 0).alias("same"))
    points = g.select(F.col("gene").alias("id"), "chrom", F.col("start").alias("pos"), F.lit("+").alias("strand"))
    return junctions.lift_over(points, blocks, 4096).select(F.col("id").alias("gene"), "to")


@query("SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS gene, CASE WHEN s_nationkey % 3 <> 1 AND s_suppkey % 400 > 150 THEN 'kept' ELSE 'removed' END AS side FROM supplier")
def long_genes(spark, sf):
    chrom = F.element_at(F.array(F.lit("12"), F.lit("chrUn_7"), F.lit("MT")), (F.col("s_nationkey") % 3 + 1).cast("int"))
    rows = A.table(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("gene"), chrom.alias("chrom"), F.lit(1).alias("start"), (1 + F.col("s_suppkey") % 400).alias("end"))
    kept, removed = annot.long_genes(rows)
    return kept.select("gene", F.lit("kept").alias("side")).union(removed.select("gene", F.lit("removed")))


@query(f"""WITH {A.ALN}, r AS (SELECT gene || '-' || CAST(ord AS VARCHAR) || '-' || CAST(frag AS VARCHAR) AS junction, pos AS pos_1, part % 5 AS pos_2, qty AS "unique", line AS longest, part % 3 AS mm FROM aln) SELECT junction, pos_1, pos_2, "unique", longest FROM (SELECT *, row_number() OVER (PARTITION BY pos_1, pos_2 ORDER BY "unique" DESC, longest DESC, mm, junction) AS k FROM r) WHERE k = 1""")
def first_per_junction(spark, sf):
    rows = A.alignments(spark, sf).select(F.concat_ws("-", "gene", F.col("ord").cast("string"), F.col("frag").cast("string")).alias("junction"), F.col("pos").alias("pos_1"), (F.col("part") % 5).alias("pos_2"), F.col("qty").alias("unique"), F.col("line").alias("longest"), (F.col("part") % 3).alias("mean_mismatches"))
    return report.first_per_junction(rows).drop("mean_mismatches")


@query("SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_events(spark, sf):
    return windowed_counts(A.table(spark, sf, "events"), "ts", ["event_type"])


@query(f"""WITH {A.GENES} SELECT gene, chrom, s + p AS "start", least(s + p + 19, e) AS "end" FROM (SELECT *, unnest(range(0, greatest(0, e - 20 + 1 - s) + 1, 15)) AS p FROM genes)""")
def gene_tiles(spark, sf):
    return intervals.tile_genes(A.genes(spark, sf), 20, 15)


@query("""WITH x AS (SELECT 'C' || CAST(o_custkey AS VARCHAR) AS gene, 'T' || CAST(o_custkey AS VARCHAR) || '_' || CAST(o_orderkey % 2 AS VARCHAR) AS transcript, o_orderkey AS exon, o_orderkey * 10 AS s, o_orderkey * 10 + 5 AS e, o_orderstatus FROM orders), r AS (SELECT * FROM x WHERE o_orderstatus <> 'P')
SELECT gene, transcript, exon, min(s) OVER (PARTITION BY transcript) AS transcript_start, max(e) OVER (PARTITION BY transcript) AS transcript_end, min(s) OVER (PARTITION BY gene) AS gene_start, max(e) OVER (PARTITION BY gene) AS gene_end FROM r""")
def removed_features(spark, sf):
    gene = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    rows = A.table(spark, sf, "orders").select(gene.alias("gene"), F.concat(F.lit("T"), F.col("o_custkey").cast("string"), F.lit("_"), (F.col("o_orderkey") % 2).cast("string")).alias("transcript"), F.col("o_orderkey").alias("exon"), (F.col("o_orderkey") * 10).alias("exon_start"), (F.col("o_orderkey") * 10 + 5).alias("exon_end"), "o_orderstatus")
    return annot.remove_feature(rows, F.col("o_orderstatus") == "P").select("gene", "transcript", "exon", "transcript_start", "transcript_end", "gene_start", "gene_end")


@query("SELECT 'B' || CAST(p_size AS VARCHAR) AS gene, string_agg(DISTINCT replace(p_name, ' ', '_'), ',' ORDER BY replace(p_name, ' ', '_')) AS symbols FROM part GROUP BY 1")
def symbol_lists(spark, sf):
    return annot.symbol_lists(A.table(spark, sf, "part").select(F.concat(F.lit("B"), F.col("p_size").cast("string")).alias("gene"), F.col("p_name").alias("symbol")))


@query("""WITH r AS (SELECT 'id' || CAST(p_partkey AS VARCHAR) || ' ' || CAST(1 + p_partkey % 2 AS VARCHAR) || CASE WHEN p_partkey % 7 = 0 THEN ':Y:0' ELSE ':N:0' END AS h, p_name AS s FROM part)
SELECT split_part(h, ' ', 1) || '/' || substr(split_part(h, ' ', 2), 1, 1) AS read_id, s AS seq, 'convert' AS kind FROM r WHERE h NOT LIKE '%:Y:%' UNION ALL SELECT split_part(h, ' ', 1), CASE WHEN h LIKE '%:Y:%' THEN left(s, 1) ELSE s END, 'shorten' FROM r""")
def read_headers(spark, sf):
    p = F.col("p_partkey")
    head = F.concat(F.lit("id"), p.cast("string"), F.lit(" "), (1 + p % 2).cast("string"), F.when(p % 7 == 0, ":Y:0").otherwise(":N:0"))
    r = A.table(spark, sf, "part").select(head.alias("read_id"), F.col("p_name").alias("seq"), F.col("p_name").alias("qual"))
    return reads.convert_headers(r).select("read_id", "seq", F.lit("convert").alias("kind")).union(reads.shorten_failed(r).select("read_id", "seq", F.lit("shorten")))


#: Mate 2 is the read from a third on with a few bases more, or the read's first two thirds behind some bases: it begins behind
#: mate 1, or before it.
MATES = f"""{A.READS}, p AS (SELECT read_id AS frag, replace(seq, 'N', 'A') AS a, CASE WHEN length(seq) % 3 = 0 THEN 'GATTACA' || left(replace(seq, 'N', 'A'), 2 * length(seq) // 3) ELSE replace(substr(seq, length(seq) // 3 + 1), 'N', 'A') || 'ACGTTGCA' END AS b FROM reads)"""


def _mates(spark, sf):
    r = A.reads(spark, sf).withColumn("seq", F.replace("seq", F.lit("N"), F.lit("A")))
    n = F.length("seq")
    second = F.when(n % 3 == 0, F.concat(F.lit("GATTACA"), F.left("seq", F.floor(2 * n / 3).cast("int")))).otherwise(F.concat(F.substring(F.col("seq"), F.floor(n / 3).cast("int") + 1, n), F.lit("ACGTTGCA")))
    return r.select(F.col("read_id").alias("frag"), F.col("seq").alias("seq_1"), F.reverse(F.translate(second, "ACGT", "TGCA")).alias("seq_2"))


def _laid(first, second, most, wiggle, cut=""):
    """The first seed that occurs, and what it gives if the mismatches allow it."""
    sign = 1 if first == "a" else -1
    return f"""(SELECT frag, shift, mis FROM (SELECT *, len(list_filter(range(1, CAST(size AS BIGINT) + 1), lambda i: substr(a, greatest(0, shift) + i, 1) <> substr(b, greatest(0, 0 - shift) + i, 1))) AS mis FROM (
  SELECT frag, a, b, {sign} * (lo - place) AS shift, least(length(a) - greatest(0, {sign} * (lo - place)), length(b) - greatest(0, {-sign} * (lo - place))) AS size FROM (
    SELECT frag, a, b, lo, instr(left({second}, length({second}) - {wiggle}), substr({first}, lo + 1, 6)) - 1 AS place, row_number() OVER (PARTITION BY frag ORDER BY back) AS k FROM (SELECT *, length({first}) - 6 - back AS lo FROM p, (VALUES (1), (10), (20), (30)) t(back))
    WHERE lo >= 0 AND replace(substr({first}, lo + 1, 6), substr({first}, lo + 1, 1), '') <> '' AND instr(left({second}, greatest(0, length({second}) - {wiggle})), substr({first}, lo + 1, 6)) > 0) WHERE k = 1)) WHERE mis <= {most} * size {cut})"""


@query(f"""WITH {MATES}, f AS {_laid('a', 'b', 0.3, 2)}, r AS {_laid('b', 'a', 0.3, 2)}
SELECT frag, CAST(CASE WHEN a = b THEN length(a) ELSE length(b) + coalesce(f.shift, r.shift) END AS INTEGER) AS fragment, CAST(CASE WHEN a = b THEN 0 ELSE coalesce(f.mis, r.mis) END AS INTEGER) AS mismatches FROM p LEFT JOIN f USING (frag) LEFT JOIN r USING (frag)""")
def mate_overlaps(spark, sf):
    return reads.mate_overlaps(_mates(spark, sf), 0.3, 6).select("frag", "fragment", "mismatches")


@query(f"""WITH {MATES}, f AS {_laid('a', 'b', 0.1, 1, 'AND (size <= 50 OR mis - 2 <= log2(size))')}, g AS (SELECT frag, a, b, CASE WHEN a = b THEN 0 ELSE shift END AS shift, length(b) + CASE WHEN a = b THEN 0 ELSE shift END AS n FROM p LEFT JOIN f USING (frag))
SELECT frag, CAST(n AS INTEGER) AS fragment, CASE WHEN shift < 0 THEN left(a, n) WHEN length(a) < n THEN a || right(b, n - length(a)) WHEN n IS NOT NULL THEN a END AS merged FROM g""")
def merged_mates(spark, sf):
    return reads.merge_mates(_mates(spark, sf), 0.1, 6).select("frag", "fragment", "merged")


QUALITY = f"""{A.READS}, q AS (SELECT read_id, seq, array_to_string(list_transform(range(1, length(seq) + 1), lambda i: CASE WHEN (i * 7 + length(seq)) % 11 < 4 THEN '!' ELSE 'I' END), '') AS qual FROM reads),
l AS (SELECT read_id, seq, list_transform(range(1, length(seq) + 1), lambda i: CASE WHEN substr(qual, i, 1) = '!' THEN 1 ELSE 0 END) AS low FROM q), w AS (SELECT read_id, seq, low, list_filter(range(1, greatest(1, length(seq) - 4) + 1), lambda i: list_sum(low[i:i + 3]) >= 2)[1] AS w0 FROM l),
c AS (SELECT read_id, seq, CASE WHEN w0 IS NULL THEN length(seq) ELSE w0 + list_position(low[w0:w0 + 3], 1) - 2 END AS n FROM w), t AS (SELECT read_id, seq, rtrim(substr(seq, 1, n), 'N') AS s FROM c)"""


@query(f"WITH {QUALITY} SELECT read_id, substr(seq, 1, greatest(1, length(s))) AS seq FROM t")
def clipped_quality(spark, sf):
    n = F.length("seq")
    qual = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.when((i * 7 + n) % 11 < 4, "!").otherwise("I")), "")
    return reads.clip_quality(A.reads(spark, sf).withColumn("qual", qual)).select("read_id", "seq")


@query(f"""WITH {FRAMES}, j AS (SELECT a.id AS ord, a.kind AS ka, b.kind AS kb FROM k a JOIN k b ON b.id = a.id + 1), x AS (SELECT ord, a.tr || ':' || a.m || '/' || b.tr || ':' || b.m AS t, a.n % 3 = (b.n - 1) % 3 AS ok, a.tr AS ta, b.tr AS tb FROM j JOIN h a ON a.id = ord JOIN h b ON b.id = ord + 1),
y AS (SELECT ord, bool_or(ok) AS ok, string_agg(t, ';' ORDER BY ta, tb) FILTER (ok) AS good, string_agg(t, ';' ORDER BY ta, tb) AS every FROM x GROUP BY ord)
SELECT ord, CASE WHEN ka = 'CDS' AND kb = 'CDS' THEN CASE WHEN ok THEN 'in-frame' ELSE 'out-of-frame' END ELSE CASE WHEN ka = 'CDS' THEN CASE WHEN ord IN (SELECT id FROM h WHERE final) THEN 'CDS(complete)' ELSE 'CDS(truncated)' END ELSE ka END || '/' || CASE WHEN kb = 'CDS' THEN CASE WHEN ord + 1 IN (SELECT id FROM h WHERE n = 1) THEN 'CDS(complete)' ELSE 'CDS(truncated)' END ELSE kb END END AS effect, coalesce(CASE WHEN ok THEN good ELSE every END, '') AS transcripts FROM j LEFT JOIN y USING (ord)""")
def predicted_frames(spark, sf):
    features, points = _frame_features(spark, sf)
    first, second = (points.select((F.col("id") - i).alias("ord"), *[F.col(c).alias(f"{n}_{i + 1}") for c, n in (("gene", "g"), ("chrom", "chrom"), ("at", "at"), ("strand", "strand"))]) for i in (0, 1))
    return report.predict_frame(first.join(second, "ord"), features).select("ord", "effect", "transcripts")


@query(f"""WITH {A.REPORT}, m AS (SELECT g_1, g_2, strand_1, strand_2, at_1 AS s1, 30 AS n1, at_1 + 50 AS s2, 10 + reads AS n2, pairs AS anchor, reads AS n_mism, ord FROM report), t AS (SELECT *, CASE WHEN n2 >= 20 THEN (s2 + n2 - 20) || '-' || (s2 + n2) ELSE (s1 + 30 - (20 - n2)) || '-' || (s1 + 30) || ',' || s2 || '-' || (s2 + n2) END AS "left", s1 || '-' || (s1 + 20) AS "right" FROM m WHERE n_mism <= 6)
SELECT g_1 AS gene_1, g_2 AS gene_2, strand_1, strand_2, "left", "right", count(DISTINCT (s1, n2)) AS "unique", max(anchor) AS longest, count(DISTINCT ord) AS n_reads FROM t GROUP BY ALL HAVING count(DISTINCT (s1, n2)) >= 2 OR max(anchor) >= 40""")
def trimmed_junctions(spark, sf):
    r = A.report(spark, sf)
    at, n2 = F.col("at_1").cast("int"), (F.col("reads") + 10).cast("int")
    rows = r.select(F.col("g_1").alias("gene_1"), F.col("g_2").alias("gene_2"), "strand_1", "strand_2", F.col("ord").cast("string").alias("read_id"), F.col("pairs").alias("anchor"), F.col("reads").alias("n_mism"), F.array(F.lit(30), n2).alias("sizes_1"), F.array(at, at + 50).alias("starts_1"), F.array(F.lit(30), n2).alias("sizes_2"), F.array(at, at + 50).alias("starts_2"), F.lit("S").alias("seq"), "ord")
    return report.split_junctions_trimmed(rows, size=20, reads=2, anchor2=40, mismatches=6).drop("seq")


@query(f"""WITH {A.READS}, q AS (SELECT read_id, length(seq) - 1 AS n, unnest(list_transform(range(1, length(seq)), lambda i: substr(seq, i, 2))) AS two FROM reads), c AS (SELECT read_id, n, two, count(*) AS k FROM q GROUP BY ALL)
SELECT read_id FROM c GROUP BY read_id, n HAVING max(k) < n * CAST(0.3 AS DOUBLE)""")
def repeat_free_reads(spark, sf):
    return A.reads(spark, sf).where(reads.no_repeats(F.col("seq"))).select("read_id")


@query(f"""WITH {A.ALN}, s AS (SELECT frag, mate, gene AS rname, pos, qty AS n, strand = 'N' AS rev, 3 + CASE WHEN strand = 'N' THEN 16 ELSE 0 END + 64 * mate AS flag FROM aln WHERE qty % 5 <> 0 AND line <= 5 AND (qty > 20 OR line <= 4)),
p AS (SELECT a.frag, a.rname, a.pos AS pos_1, a.n AS n1, a.flag AS f1, a.rev AS r1, b.pos AS pos_2, b.n AS n2, b.flag AS f2, b.rev AS r2 FROM s a JOIN s b ON a.frag = b.frag AND a.rname = b.rname AND a.mate = 1 AND b.mate = 2)
SELECT CAST(frag AS VARCHAR) || '/' AS frag, rname, pos_1, CASE WHEN r1 THEN n2 || 'H' || n1 || 'M' ELSE n1 || 'M' || n2 || 'H' END AS cigar_1, f1 AS flag_1, pos_2, CASE WHEN r1 THEN n2 || 'M' || n1 || 'H' ELSE n1 || 'H' || n2 || 'M' END AS cigar_2, CASE WHEN r1 = r2 THEN f2 ELSE xor(f2, 16) END AS flag_2, CASE WHEN r1 = r2 THEN 'same' ELSE 'other' END AS strands FROM p""")
def sam_mate_merge(spark, sf):
    flag = F.when(F.col("qty") % 5 == 0, 1).otherwise(3) + F.when(F.col("strand") == "N", 16).otherwise(0) + 64 * F.col("mate")
    sam = A.alignments(spark, sf).select(_read_id().alias("qname"), flag.alias("flag"), F.col("gene").alias("rname"), "pos", F.concat(F.col("qty").cast("string"), F.lit("M")).alias("cigar"), F.expr("repeat('A', qty)").alias("seq"), F.col("line").alias("nm"))
    same, other = (align.merge_sam_mates(sam, 5, 4, other_strand=x).withColumn("strands", F.lit(n)) for x, n in ((False, "same"), (True, "other")))
    return same.union(other)


@query(f"WITH {A.READS} SELECT read_id AS id, CAST(length(seq) AS INTEGER) AS length FROM reads")
def sequence_lengths(spark, sf):
    return annot.sequence_lengths(A.reads(spark, sf).withColumnRenamed("read_id", "id"))


@query()
def shuffled_sequences(spark, sf):
    return junctions.shuffled(A.reads(spark, sf).withColumnRenamed("read_id", "id"))


@query("SELECT p_partkey AS ord, p_name AS seq, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END AS file FROM part")
def deinterleaved_reads(spark, sf):
    r = A.table(spark, sf, "part").select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("seq"))
    first, second = reads.deinterleave(r)
    return first.withColumn("file", F.lit(1)).union(second.withColumn("file", F.lit(2)))


@query("SELECT p_partkey AS ord, p_name AS seq, 1 AS mate FROM part UNION ALL SELECT p_partkey, p_type, 2 FROM part")
def interleaved_reads(spark, sf):
    p = A.table(spark, sf, "part")
    return reads.interleave(p.select(F.col("p_partkey").alias("ord"), F.col("p_name").alias("seq")), p.select(F.col("p_partkey").alias("ord"), F.col("p_type").alias("seq")))


@query(f"""WITH {A.ALN}, p AS (SELECT CAST(frag AS VARCHAR) AS q_name, strand, 100 AS q_size, qty AS p2, 20 + line AS n FROM aln), one AS (SELECT * FROM p WHERE q_name IN (SELECT q_name FROM p GROUP BY q_name HAVING count(*) = 1)),
c AS (SELECT q_name, strand, CASE WHEN p2 >= 20 AND p2 >= 100 - p2 - n THEN p2 WHEN 100 - p2 - n >= 20 THEN p2 + n END AS cut FROM one) SELECT q_name, CASE WHEN strand = 'N' THEN 100 - cut ELSE cut END AS cut FROM c WHERE cut IS NOT NULL""")
def clip_points(spark, sf):
    rows = A.alignments(spark, sf).select(F.col("frag").cast("string").alias("q_name"), F.when(F.col("strand") == "N", "-").otherwise("+").alias("strand"), F.lit(100).alias("q_size"), F.array(F.lit(0), F.col("qty")).alias("q_starts"), F.array(F.lit(3), 20 + F.col("line")).alias("block_sizes"))
    return align.clip_points(rows, 20)


@query(f"""WITH {A.REPORT}, d AS (SELECT DISTINCT g_1, g_2 FROM report WHERE pairs = 50), b AS (SELECT g_1, g_2 FROM d UNION SELECT g_2, g_1 FROM d)
SELECT ord, r.g_1, r.g_2, array_to_string(list_concat(labels, CASE WHEN b.g_1 IS NULL THEN [] ELSE ['matched'] END), ',') AS labels FROM report r LEFT JOIN b ON r.g_1 = b.g_1 AND r.g_2 = b.g_2""")
def found_labels(spark, sf):
    r = A.report(spark, sf)
    return report.label_found(r, r.where("pairs = 50").select("g_1", "g_2"), "matched").select("ord", "g_1", "g_2", F.array_join("labels", ",").alias("labels"))


@query(f"WITH {EXONS} SELECT 'v;' || transcript || ';' || gene AS id, seq FROM x WHERE gene LIKE 'K1%'")
def extracted_transcripts(spark, sf):
    x = _exons(spark, sf)
    return junctions.extract_transcripts(x.select(F.concat_ws(";", "transcript", "gene").alias("id"), "seq"), x.select("gene").where("gene like 'K1%'").distinct(), "v")


@query(f"""WITH {A.ALN}, {SUPPLIER_GENES}, h AS (SELECT ord, frag, gene AS gene_1, 'G' || CAST(part % 10 AS VARCHAR) AS gene_2, qty AS at_1, line AS at_2 FROM aln)
SELECT ord, frag, gene_1, gene_2, CASE WHEN a.strand = 1 THEN a.e - at_1 + 1 ELSE a.s + at_1 - 1 END AS pos_1, CASE WHEN b.strand = 1 THEN b.e - at_2 + 1 ELSE b.s + at_2 - 1 END AS pos_2 FROM h JOIN sg a ON gene_1 = a.gene JOIN sg b ON gene_2 = b.gene""")
def junction_points(spark, sf):
    hits = A.alignments(spark, sf).select("ord", "frag", F.col("gene").alias("gene_1"), F.concat(F.lit("G"), (F.col("part") % 10).cast("string")).alias("gene_2"), F.col("qty").alias("at_1"), F.col("line").alias("at_2"))
    return junctions.junction_points(hits, _supplier_genes(spark, sf)).select("ord", "frag", "gene_1", "gene_2", "pos_1", "pos_2")


@query(f"WITH {EXONS} SELECT gene, transcript, exon, CASE WHEN rank = 1 THEN 'custom' ELSE seq END AS seq FROM x")
def custom_features(spark, sf):
    x = _exons(spark, sf).select("gene", "transcript", "exon", "seq", "rank")
    more = x.where("rank = 1").withColumn("seq", F.lit("custom"))
    return junctions.add_features(x, more).select("gene", "transcript", "exon", "seq")


@query(f"WITH {A.ALN}, s AS (SELECT CAST(frag AS VARCHAR) || '/1' AS read_id, CAST(frag AS VARCHAR) AS frag, gene AS gene_1, 'G' || CAST(part % 97 AS VARCHAR) AS gene_2 FROM aln), ok AS (SELECT DISTINCT CAST(frag AS VARCHAR) AS frag, gene FROM aln WHERE line > 3) SELECT DISTINCT read_id, gene_1, gene_2 FROM s WHERE gene_1 <> gene_2 AND ((frag, gene_1) IN (SELECT (frag, gene) FROM ok) OR (frag, gene_2) IN (SELECT (frag, gene) FROM ok))")
def allowed_splits(spark, sf):
    a = A.alignments(spark, sf)
    splits = a.select(_read_id("1").alias("read_id"), F.col("gene").alias("gene_1"), F.concat(F.lit("G"), (F.col("part") % 97).cast("string")).alias("gene_2"))
    return align.filter_splits(splits, a.where("line > 3").select(F.col("frag").cast("string").alias("frag"), "gene"))


@query(f"WITH {A.ALN}, r AS (SELECT CAST(frag AS VARCHAR) || '/' || mate AS read_id, CAST(frag AS VARCHAR) AS frag, ord FROM aln) SELECT read_id, ord FROM r WHERE frag NOT IN (SELECT frag FROM r GROUP BY frag HAVING count(*) = 2) OR frag LIKE '%7'")
def incomplete_pairs(spark, sf):
    r = A.alignments(spark, sf).select(_read_id().alias("read_id"), "ord")
    keep = r.select(F.expr("left(read_id, length(read_id) - 2)").alias("frag")).where("frag like '%7'").distinct()
    return reads.drop_complete_pairs(r, keep)


GENE_EXONS = """x AS (SELECT 'C' || CAST(o_custkey AS VARCHAR) AS gene, o_custkey % 2 = 1 AS up, o_orderkey * 10 AS s, o_orderkey * 10 + 4 + o_orderkey % 5 AS e FROM orders), g AS (SELECT gene, min(s) AS gs, max(e) AS ge FROM x GROUP BY gene)"""


def _gene_exons(spark, sf):
    rows = A.table(spark, sf, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("gene"), F.when(F.col("o_custkey") % 2 == 1, 1).otherwise(-1).alias("strand"), (F.col("o_orderkey") * 10).alias("exon_start"), (F.col("o_orderkey") * 10 + 4 + F.col("o_orderkey") % 5).alias("exon_end"))
    return rows.join(rows.groupBy("gene").agg(F.min("exon_start").alias("gene_start"), F.max("exon_end").alias("gene_end")), "gene")


@query(f"""WITH {GENE_EXONS}, p AS (SELECT DISTINCT gene, ge - gs + 1 AS n, CASE WHEN up THEN s - gs + 1 ELSE ge - e + 1 END AS f, CASE WHEN up THEN e - gs + 1 ELSE ge - s + 1 END AS l FROM x JOIN g USING (gene)),
c AS (SELECT DISTINCT CAST(substr(gene, 2) AS BIGINT) AS k FROM x), o AS (SELECT 'C' || k AS a, 'C' || (k + 1) AS b FROM c UNION ALL SELECT 'C' || (k + 1), 'C' || k FROM c)
SELECT DISTINCT a || '|' || b || '|' || x1.n AS id, x1.l - 1 AS "left", x1.n + x2.f - 1 AS "right", '+' AS strand FROM o JOIN p x1 ON x1.gene = a JOIN p x2 ON x2.gene = b""")
def junction_candidates(spark, sf):
    exons = _gene_exons(spark, sf)
    n = F.expr("cast(substring(gene, 2) as bigint)")
    return junctions.junction_candidates(exons.select(F.col("gene").alias("g_lo"), F.concat(F.lit("C"), (n + 1).cast("string")).alias("g_hi")).distinct(), exons)


@query(f"""WITH {A.GENES}, w AS (SELECT gene, chrom, s, e, 1 + s % 3 AS n, s - CASE s % 2 WHEN 0 THEN 7 ELSE 0 END AS a, e + CASE WHEN s % 5 > 1 THEN 9 ELSE 0 END AS b FROM genes),
k AS (SELECT *, a < s OR b > e AS grown, e - s < 40 AS small FROM w)
SELECT gene, chrom, a AS "start", b AS "end" FROM k WHERE grown AND (n = 1 OR small) UNION ALL SELECT gene, chrom, a, s FROM k WHERE n > 1 AND NOT small AND a < s UNION ALL SELECT gene, chrom, e, b FROM k WHERE n > 1 AND NOT small AND b > e UNION ALL SELECT gene, chrom, s, e FROM k WHERE NOT grown AND n > 1 AND small""")
def synthetic_exons(spark, sf):
    g = A.genes(spark, sf)
    s = F.col("start")
    grown = g.select("gene", "chrom", "start", "end", (s - F.when(s % 2 == 0, 7).otherwise(0)).alias("new_start"), (F.col("end") + F.when(s % 5 > 1, 9).otherwise(0)).alias("new_end"))
    return intervals.synthetic_exons(grown, g.select("gene", F.explode(F.sequence(F.lit(1), 1 + s % 3)).alias("exon")), 40)


@query("""WITH s AS (SELECT 'P' || CAST(p_partkey AS VARCHAR) AS gene, 'GEN' || CAST(p_partkey % 50 AS VARCHAR) || CASE p_partkey % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'P' || CAST(p_size AS VARCHAR) WHEN 2 THEN 'L' || CAST(p_size AS VARCHAR) ELSE '' END AS sym, p_partkey % 3 <> 0 AS pseudo FROM part), own AS (SELECT sym, min(gene) AS own FROM s GROUP BY sym),
f AS (SELECT regexp_extract(sym, '^(GEN[0-9]+)([PL])([0-9]*)$', 1) AS base, regexp_extract(sym, '^(GEN[0-9]+)([PL])([0-9]*)$', 2) AS mark, min(sym) AS first, count(DISTINCT sym) AS n, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes FROM s WHERE pseudo AND sym SIMILAR TO 'GEN[0-9]+[PL][0-9]*' GROUP BY 1, 2)
SELECT f.base, f.mark, coalesce(a.own, b.own) AS gene, genes FROM f LEFT JOIN own a ON a.sym = f.base LEFT JOIN own b ON b.sym = f.first WHERE n > 1 OR a.own IS NOT NULL""")
def pseudogene_families(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    tail = F.when(key % 4 == 0, "P").when(key % 4 == 1, F.concat(F.lit("P"), size)).when(key % 4 == 2, F.concat(F.lit("L"), size)).otherwise("")
    p = A.table(spark, sf, "part").select(F.concat(F.lit("P"), key.cast("string")).alias("gene"), F.concat(F.lit("gen"), (key % 50).cast("string"), tail).alias("symbol"), (key % 3 != 0).alias("pseudo"))
    return annot.pseudogene_families(p, p.where("pseudo")).withColumn("genes", F.array_join("genes", ","))
