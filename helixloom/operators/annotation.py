"""Annotation relations: symbols to ids, gene classes, pseudogene pairs, bounds, curated pair sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixloom.functions.seq import clean_description


def sorted_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct unordered pairs of different members."""
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("g_lo"), F.greatest(a, b).alias("g_hi")).distinct()


def resolve_symbols(pairs: DataFrame, symbols: DataFrame, synonyms: DataFrame, loci: DataFrame | None = None, minus: DataFrame | None = None) -> DataFrame:
    """g_lo, g_hi for symbol pairs (symbol_1, symbol_2), many to many (J21 and the pair connectors).

    A symbol stands for its ids in ``symbols`` (gene, symbol), else in ``synonyms``, else for the members of its locus
    (``loci``: locus, symbol), else, if it is an id, for itself. Equal ids, pairs inside one locus and ``minus`` are dropped.
    """
    direct = symbols.select(F.upper("symbol").alias("s"), "gene").distinct()
    other = synonyms.select(F.upper("symbol").alias("s"), "gene").distinct().join(direct.select("s").distinct(), "s", "left_anti")
    table = direct.union(other)
    banned = None
    if loci is not None:
        members = loci.select(F.upper("locus").alias("l"), F.upper("symbol").alias("s")).join(table, "s").select("l", "gene").distinct()
        table = table.union(members.select(F.col("l").alias("s"), "gene").join(table.select("s").distinct(), "s", "left_anti"))
        banned = sorted_pairs(members.alias("a").join(members.select("l", F.col("gene").alias("gene_b")), "l"), "gene", "gene_b")
    literal = pairs.select(F.explode(F.array(F.upper("symbol_1"), F.upper("symbol_2"))).alias("s")).where("s like 'ENS%'").distinct()
    table = table.union(literal.join(table.select("s").distinct(), "s", "left_anti").select("s", F.col("s").alias("gene")))
    wanted = pairs.select(F.upper("symbol_1").alias("s1"), F.upper("symbol_2").alias("s2")).where("s1 <> s2 and not (s1 like '%@' and s2 like '%@' and left(s1, 2) = left(s2, 2))").distinct()
    both = wanted.join(table.toDF("s1", "gene_1"), "s1").join(table.toDF("s2", "gene_2"), "s2")
    out = sorted_pairs(both, "gene_1", "gene_2")
    for drop in (banned, minus):
        if drop is not None:
            out = out.join(drop.select("g_lo", "g_hi"), ["g_lo", "g_hi"], "left_anti")
    return out


def locus_pairs(loci: DataFrame, symbols: DataFrame) -> DataFrame:
    """All id pairs inside one locus."""
    members = loci.select("locus", F.upper("symbol").alias("s")).join(symbols.select(F.upper("symbol").alias("s"), "gene"), "s").select("locus", "gene").distinct()
    return sorted_pairs(members.join(members.withColumnRenamed("gene", "gene_b"), "locus"), "gene", "gene_b")


def symbol_frequencies(pairs: DataFrame) -> DataFrame:
    """symbol, n, by falling (n, symbol)."""
    return pairs.select(F.explode(F.array(F.upper("symbol_1"), F.upper("symbol_2"))).alias("symbol")).groupBy("symbol").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("symbol"))


def symbol_lists(symbols: DataFrame) -> DataFrame:
    """gene, symbols: a gene's symbols joined by commas, blanks as underscores."""
    return symbols.groupBy("gene").agg(F.array_join(F.array_sort(F.collect_set(F.replace("symbol", F.lit(" "), F.lit("_")))), ",").alias("symbols"))


def genes_without_protein(exons: DataFrame) -> DataFrame:
    """Genes all of whose peptides are empty."""
    return exons.groupBy("gene").agg(F.max(F.when(F.coalesce("peptide", F.lit("")) != "", 1).otherwise(0)).alias("_p")).where("_p = 0").select("gene")


def gene_class(annotation: DataFrame, text_col: str, pattern: str) -> DataFrame:
    """Distinct genes whose text matches a pattern, in any case."""
    return annotation.where(F.col(text_col).rlike("(?i)" + pattern)).select("gene").distinct()


#: Patterns of the gene classes over biotypes, descriptions or symbols (fixed values).
GENE_CLASSES = {
    "pseudogene": ("biotype", "pseudogene"),
    "lincrna": ("biotype", "lincrna|lncrna"),
    "mirna": ("biotype", "mirna"),
    "rrna": ("biotype", "rrna"),
    "trna": ("biotype", "trna"),
    "mt": ("biotype", "^mt_"),
    "snrna": ("biotype", "snrna"),
    "snorna": ("biotype", "snorna"),
    "yrna": ("symbol", "^y_rna|^rny[0-9]"),
    "7sk": ("symbol", "7sk"),
    "metazoa": ("symbol", "metazoa"),
    "hla": ("symbol", "^hla-"),
    "ig": ("symbol", "^ig[klhj]"),
    "ribosomal": ("description", "ribosomal protein"),
    "oncogene": ("description", "oncogene"),
}


#: Known fusions that lists of conjoined genes must not hide (fixed values): gene ids in order.
NOT_CONJOINED = (("ENSG00000047932", "ENSG00000047936"), ("ENSG00000134853", "ENSG00000145216"))


def conjoined(pairs: DataFrame, excluded: tuple[tuple[str, str], ...] = NOT_CONJOINED) -> DataFrame:
    """pairs (g_lo, g_hi) of conjoined genes without the ``excluded`` ones."""
    pair = F.concat_ws("|", "g_lo", "g_hi")
    return pairs.where(~pair.isin(*["|".join(sorted(p)) for p in excluded]))


def pseudogene_pairs(descriptions: DataFrame, paralogs: DataFrame) -> DataFrame:
    """Pairs of genes with one normalised description, at least one of them a pseudogene, and pairs of such a gene with
    paralogs of the other, without the paralogs themselves (J14)."""
    named = descriptions.select("gene", clean_description("description").alias("name"), F.lower("description").contains("pseudogene").alias("is_pseudo")).where("name <> ''")
    pseudo = named.where("is_pseudo").select("name").distinct()
    group = named.join(pseudo, "name", "left_semi").select("name", "gene").distinct()
    pairs = sorted_pairs(group.join(group.withColumnRenamed("gene", "other"), "name"), "gene", "other")
    near = paralogs.select("g_lo", "g_hi").union(paralogs.select("g_hi", "g_lo")).toDF("x", "y")
    ends = pairs.union(pairs.select("g_hi", "g_lo")).toDF("x", "keep")
    wider = sorted_pairs(ends.join(near, "x"), "keep", "y")
    return pairs.union(wider).distinct().join(paralogs.select("g_lo", "g_hi"), ["g_lo", "g_hi"], "left_anti")


def gene_bounds(exons: DataFrame) -> DataFrame:
    """gene, chrom, strand, start, end from exons."""
    return exons.groupBy("gene", "chrom", "strand").agg(F.min("exon_start").alias("start"), F.max("exon_end").alias("end"))


def remove_feature(exons: DataFrame, hit: Column) -> DataFrame:
    """Exons without those where ``hit``; transcript and gene bounds follow from the rest (F32)."""
    rest = exons.where(~F.coalesce(hit, F.lit(False)))
    t = rest.groupBy("transcript").agg(F.min("exon_start").alias("transcript_start"), F.max("exon_end").alias("transcript_end"))
    g = rest.groupBy("gene").agg(F.min("exon_start").alias("gene_start"), F.max("exon_end").alias("gene_end"))
    return rest.drop("transcript_start", "transcript_end", "gene_start", "gene_end").join(t, "transcript").join(g, "gene")


def is_chromosome(name: Column) -> Column:
    """The whitelist of F23: numbers, roman numerals, X, Y, MT, UN, MITO."""
    return F.upper(name).rlike(r"^([1-9][0-9]?|X{0,3}(IX|IV|V?I{0,3})|X|Y|MT|UN|MITO)$") & (name != "")


def long_genes(genes: DataFrame, least: int = 150) -> tuple[DataFrame, DataFrame]:
    """Genes on known chromosomes that are longer than ``least``, and the others."""
    good = F.coalesce(is_chromosome(F.col("chrom")) & (F.abs(F.col("start") - F.col("end")) > least), F.lit(False))
    return genes.where(good), genes.where(~good)


def transcripts(exons: DataFrame, sequences: DataFrame, least: int = 150) -> DataFrame:
    """transcript, gene, seq, exons: exon sequences joined by rank, with each exon's place in the transcript.

    Places are running sums along a transcript's sorted exons, so the work is linear in them.
    """
    rows = exons.join(sequences.select(F.col("id").alias("exon"), "seq"), "exon")
    order = Window.partitionBy("transcript", "gene").orderBy("rank", "exon", "seq", "exon_start", "exon_end")
    rows = rows.select("transcript", "gene", "rank", "exon", "seq", F.row_number().over(order).alias("_n"), F.sum(F.length("seq")).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("_end"))
    parts = rows.groupBy("transcript", "gene").agg(F.sort_array(F.collect_list(F.struct("_n", "rank", "exon", "seq", "_end"))).alias("p"))
    seq = F.array_join(F.transform("p", lambda x: x["seq"]), "")
    places = F.transform("p", lambda x: F.struct(x["exon"].alias("exon"), x["rank"].alias("rank"), (x["_end"] - F.length(x["seq"]) + 1).alias("st"), F.when(x["seq"].isNotNull(), x["_end"]).alias("et")))
    return parts.select("transcript", "gene", seq.alias("seq"), places.alias("exons")).where(F.length("seq") > least)


def gene_sequences(genes: DataFrame, genome: DataFrame) -> DataFrame:
    """gene, seq: cut from the chromosome, reverse-complemented on the minus strand, padded with N past its end."""
    from helixloom.functions.seq import reverse_complement

    cut = F.substring(F.col("seq"), F.col("start").cast("int"), (F.col("end") - F.col("start") + 1).cast("int"))
    padded = F.rpad(cut, (F.col("end") - F.col("start") + 1).cast("int"), F.lit("N"))
    both = genes.join(genome, "chrom").withColumn("s", padded)
    return both.select("gene", F.when(F.col("strand").cast("string").isin("-", "-1"), reverse_complement("s", keep_n=True)).otherwise(F.col("s")).alias("seq"))


def sequence_lengths(sequences: DataFrame) -> DataFrame:
    """Id, length."""
    return sequences.select("id", F.length("seq").alias("length"))


def pseudogene_families(symbols: DataFrame, pseudogenes: DataFrame) -> DataFrame:
    """Families of pseudogenes by their symbols: base, mark, gene (the family's own), genes (its pseudogenes, an array).

    A symbol of a pseudogene that ends in P or L and a number, or in P or L alone, belongs to the family of what is before
    the mark, of three characters and more (CEL and CELP aren't one). A family of one symbol needs a gene of the base's
    name; the family's own gene is that one, else the one of its first symbol. ``symbols``: gene, symbol.
    """
    named = symbols.select("gene", F.upper("symbol").alias("symbol"))
    alias = named.where("symbol like 'MT-%'").withColumn("symbol", F.concat(F.lit("MT"), F.expr("substring(symbol, 4)")))
    genes = named.union(alias).groupBy("symbol").agg(F.min("gene").alias("own"))
    found = []
    for mark in "PL":
        base, rest = (F.regexp_extract("symbol", f"^(.*){mark}([^{mark}]*)$", i) for i in (1, 2))
        rows = named.join(pseudogenes.select("gene").distinct(), "gene", "left_semi").withColumn("base", base).withColumn("rest", rest)
        found.append(rows.where(F.length("base") > 2).where(F.col("rest").rlike("^[0-9]+$") | ((F.col("rest") == "") & (F.col("base") != "CEL"))).withColumn("mark", F.lit(mark)))
    families = found[0].union(found[1]).groupBy("base", "mark").agg(F.min("symbol").alias("first"), F.countDistinct("symbol").alias("n"), F.array_sort(F.collect_set("gene")).alias("genes"))
    rows = families.join(genes.toDF("base", "_base"), "base", "left").join(genes.toDF("first", "_first"), "first", "left")
    return rows.where("n > 1 or _base is not null").select("base", "mark", F.coalesce("_base", "_first").alias("gene"), "genes")


def shield_regions(families: DataFrame, genes: DataFrame, ribosomal: DataFrame | None = None) -> DataFrame:
    """Chrom, start (from 0), end of the pseudogenes of all families that aren't a family's own gene, in order; without
    mitochondrial and ribosomal ones. ``genes``: gene, chrom, start, end; swapped ends are put right."""
    wanted = families.select(F.explode("genes").alias("gene")).distinct().join(families.select("gene").distinct(), "gene", "left_anti")
    if ribosomal is not None:
        wanted = wanted.join(ribosomal.select("gene").distinct(), "gene", "left_anti")
    rows = genes.where(F.lower("chrom") != "mt").join(wanted, "gene", "left_semi")
    return rows.select("chrom", (F.least("start", "end") - 1).alias("start"), F.greatest("start", "end").alias("end")).orderBy("chrom", "start", "end")
