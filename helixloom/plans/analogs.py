"""Genomic relations read out of the TPC-H-like tables, each as a DataFrame and as the SQL of the same relation.

A fragment is an order, a gene a supplier, a transcript a part, strand and position come from return flag and ship date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paired alignments: frag, mate, ord, gene, transcript, strand, pos, qty, part, line.
ALN = """aln AS (
  SELECT l_orderkey AS frag, CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 2 END AS mate,
    CAST(l_linenumber AS BIGINT) * 10000000000000000 + l_partkey * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS ord,
    'G' || CAST(l_suppkey AS VARCHAR) AS gene, 'T' || CAST(l_partkey AS VARCHAR) AS transcript, l_returnflag AS strand,
    date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS pos, CAST(l_quantity AS INTEGER) AS qty, l_partkey AS part, l_linenumber AS line
  FROM lineitem)"""


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("l_linenumber").cast("bigint") * 10**16 + F.col("l_partkey") * 10**8 + F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frag"),
        F.when(F.col("l_linenumber") % 2 == 1, 1).otherwise(2).alias("mate"),
        order.alias("ord"),
        F.concat(F.lit("G"), F.col("l_suppkey").cast("string")).alias("gene"),
        F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("transcript"),
        F.col("l_returnflag").alias("strand"),
        F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date")).cast("bigint").alias("pos"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_partkey").alias("part"),
        F.col("l_linenumber").alias("line"),
    )


#: All passing mate combinations with their keys, as mate_pairs gives them.
PASSING = (
    ALN
    + """, shared AS (SELECT DISTINCT a.frag FROM aln a JOIN aln b ON a.frag = b.frag AND a.mate = 1 AND b.mate = 2 AND a.gene = b.gene
), passing AS (
  SELECT a.frag, a.ord AS ord_1, b.ord AS ord_2, least(a.gene, b.gene) AS g_lo, greatest(a.gene, b.gene) AS g_hi, a.transcript AS t1, b.transcript AS t2, a.gene AS g1, b.gene AS g2,
    least(a.transcript || '+++' || a.pos, b.transcript || '+++t' || b.pos) || '-+-' || greatest(a.transcript || '+++' || a.pos, b.transcript || '+++t' || b.pos) AS z
  FROM aln a JOIN aln b ON a.frag = b.frag AND a.mate = 1 AND b.mate = 2 AND a.strand <> b.strand
  WHERE a.frag NOT IN (SELECT frag FROM shared))"""
)

#: Candidate pairs with their counts (A1).
CANDIDATES = (
    PASSING
    + """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY frag, g_lo, g_hi ORDER BY ord_1, ord_2, z) AS of_pair, row_number() OVER (PARTITION BY z ORDER BY frag, ord_1, ord_2) AS of_key FROM passing
), cand AS (SELECT g_lo, g_hi, count(*) AS n FROM ranked WHERE of_pair = 1 AND of_key = 1 GROUP BY g_lo, g_hi)"""
)

#: Genes as intervals: gene, chrom, strand, start, end.
GENES = """genes AS (
  SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS gene, o_orderpriority AS chrom, o_orderstatus AS strand, o_orderkey * 10 + o_custkey % 97 AS s, o_orderkey * 10 + o_custkey % 97 + 5 + o_custkey % 60 AS e
  FROM orders)"""


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("o_orderkey") * 10 + F.col("o_custkey") % 97
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("gene"), F.col("o_orderpriority").alias("chrom"), F.col("o_orderstatus").alias("strand"), start.alias("start"), (start + 5 + F.col("o_custkey") % 60).alias("end"))


#: Alignment hits: q_name, t_name, matches, mismatches, block_count, t_start, t_end, ord.
PSL = (
    ALN
    + """, psl AS (SELECT frag AS q_name, gene AS t_name, qty AS matches, line AS mismatches, CAST(1 + part % 3 AS INTEGER) AS block_count, pos AS t_start, pos + qty AS t_end, ord FROM aln)"""
)


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(spark, sf_dir).select(F.col("frag").alias("q_name"), F.col("gene").alias("t_name"), F.col("qty").alias("matches"), F.col("line").alias("mismatches"), (1 + F.col("part") % 3).cast("int").alias("block_count"), F.col("pos").alias("t_start"), (F.col("pos") + F.col("qty")).alias("t_end"), "ord")


#: A final report over line items: one row per item, labels from its flags.
REPORT = (
    ALN
    + """, report AS (
  SELECT frag * 10000000000 + part * 1000000 + line * 100000 + pos AS ord, gene AS g_1, 'G' || CAST(part % 97 AS VARCHAR) AS g_2, 'S' || substr(gene, 2) AS symbol_1, 'S' || CAST(part % 97 AS VARCHAR) AS symbol_2,
    'c' || CAST(frag % 5 AS VARCHAR) AS chrom_1, 'c' || CAST(part % 5 AS VARCHAR) AS chrom_2, CASE WHEN strand = 'N' THEN '-' ELSE '+' END AS strand_1, CASE WHEN line % 2 = 1 THEN '-' ELSE '+' END AS strand_2,
    pos AS at_1, pos + line AS at_2, qty AS pairs, line AS reads,
    list_concat(CASE WHEN strand = 'A' THEN ['known'] ELSE [] END, CASE WHEN qty % 10 = 0 THEN ['readthrough'] ELSE [] END, CASE WHEN line = 7 THEN ['exon-exon'] ELSE [] END) AS labels
  FROM aln)"""
)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    def flag(hit, name):
        return F.when(hit, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))

    other = (F.col("part") % 97).cast("string")
    return alignments(spark, sf_dir).select(
        (F.col("frag") * 10**10 + F.col("part") * 10**6 + F.col("line") * 10**5 + F.col("pos")).alias("ord"),
        F.col("gene").alias("g_1"),
        F.concat(F.lit("G"), other).alias("g_2"),
        F.concat(F.lit("S"), F.substring("gene", 2, 99)).alias("symbol_1"),
        F.concat(F.lit("S"), other).alias("symbol_2"),
        F.concat(F.lit("c"), (F.col("frag") % 5).cast("string")).alias("chrom_1"),
        F.concat(F.lit("c"), (F.col("part") % 5).cast("string")).alias("chrom_2"),
        F.when(F.col("strand") == "N", "-").otherwise("+").alias("strand_1"),
        F.when(F.col("line") % 2 == 1, "-").otherwise("+").alias("strand_2"),
        F.col("pos").alias("at_1"),
        (F.col("pos") + F.col("line")).alias("at_2"),
        F.col("qty").alias("pairs"),
        F.col("line").alias("reads"),
        F.concat(flag(F.col("strand") == "A", "known"), flag(F.col("qty") % 10 == 0, "readthrough"), flag(F.col("line") == 7, "exon-exon")).alias("labels"),
    )


#: Sequences over ACGT from part names and documents' sources: id, seq.
READS = """reads AS (
  SELECT 'R' || CAST(p_partkey AS VARCHAR) || '/' || CAST(1 + p_partkey % 2 AS VARCHAR) AS read_id, upper(translate(p_name || repeat('a', CAST(p_size AS INTEGER)), 'abcdefghijklmnopqrstuvwxyz ', 'ACGTACGTACGTACGTACGTACGTACN')) AS seq, repeat('I', length(p_name) + p_size) AS qual
  FROM part)"""


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("p_name", F.expr("repeat('a', p_size)"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("R"), F.col("p_partkey").cast("string"), F.lit("/"), (1 + F.col("p_partkey") % 2).cast("string")).alias("read_id"),
        F.upper(F.translate(text, "abcdefghijklmnopqrstuvwxyz ", "ACGTACGTACGTACGTACGTACGTACN")).alias("seq"),
        F.expr("repeat('I', length(p_name) + p_size)").alias("qual"),
    )
