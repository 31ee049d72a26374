import random

from pyspark.sql import functions as F

from helixloom.operators import intervals, pairs


def test_discovery_matches_a_sequential_model(spark):
    rng = random.Random(4)
    for _ in range(3):
        rows = [(f, m, o, f"G{rng.randrange(4)}", f"T{rng.randrange(3)}", rng.choice("+-"), rng.randrange(3)) for f in range(25) for o in range(3) for m in (1, 2)]
        counts, seen, reads = {}, set(), {}
        for f in range(25):
            a, b = ([r for r in rows if r[0] == f and r[1] == m] for m in (1, 2))
            if {r[3] for r in a} & {r[3] for r in b}:
                continue
            local = set()
            for x in sorted(a, key=lambda r: r[2]):
                for y in sorted(b, key=lambda r: r[2]):
                    g = tuple(sorted((x[3], y[3])))
                    z = "-+-".join(sorted((f"{x[4]}+++{x[6]}", f"{y[4]}+++t{y[6]}")))
                    if x[5] == y[5]:
                        continue
                    if g not in local:
                        if z not in seen:
                            counts[g] = counts.get(g, 0) + 1
                        reads.setdefault(g, set()).add(f)
                        local.add(g)
                    seen.add(z)
        df = spark.createDataFrame(rows, "frag bigint, mate int, ord int, gene string, transcript string, strand string, pos int")
        passing = pairs.mate_pairs(df)
        assert {(r.g_lo, r.g_hi): r.n for r in pairs.pair_discovery(passing).collect()} == counts
        assert {(r.g_lo, r.g_hi): r.n for r in pairs.pair_reads(passing).collect()} == {g: len(v) for g, v in reads.items()}


def test_extract_matches_a_sequential_model(spark):
    rng = random.Random(5)
    rows = [(f"a{i}", f"b{i}", rng.randrange(6), [x for x in ("known", "paralog", "further_fusion") if rng.random() < 0.3]) for i in range(60)]
    df = spark.createDataFrame(rows, "g_lo string, g_hi string, n bigint, labels array<string>")
    got = {r.g_lo: r.status for r in pairs.extract_candidates(df, 3, 2, 10).collect()}
    i, want = 0, {}
    for g, _, n, labels in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        ok = "further_fusion" in labels or (n >= 3 and i < 10 and ("known" in labels or "paralog" not in labels)) or (n >= 2 and i < 10 and "known" in labels)
        want[g] = "further_analysis" if ok else "skipped"
        i += ok
    assert got == want


def test_homolog_pairs_limit(spark):
    rows = [("r", f"G{i:03d}") for i in range(60)] + [("s", "G000"), ("s", "G001"), ("t", "G000")]
    got = {(r.g_lo, r.g_hi): r.n for r in pairs.homolog_pairs(spark.createDataFrame(rows, "read_id string, gene string")).collect()}
    assert len(got) == 50 * 49 // 2 and got["G000", "G001"] == 2


def test_similar_symbols(spark):
    from helixloom.functions.seq import similar_symbols

    rows = [("ABC", "ABC", True), ("MUC1-A", "MUC1", True), ("MUC1", "MUC2", False), ("TP53-AS1", "TP53", True), ("ABCD.1", "ABCD.2", True), ("AB", "AC", False)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert df.where(similar_symbols(F.col("a"), F.col("b")) != F.col("want")).collect() == []


def test_adjacent_and_overlapping(spark):
    genes = spark.createDataFrame([("a", "1", "+", 1, 10), ("b", "1", "+", 20, 30), ("d", "1", "+", 40, 50), ("e", "1", "+", 5, 45)], "gene string, chrom string, strand string, start bigint, end bigint")
    got = {frozenset((r.g_first, r.g_second)) for r in intervals.adjacent_genes(genes).collect()}
    assert got == {frozenset(x) for x in ("ab", "ae", "bd", "be", "de")}
    over = {(r.g_lo, r.g_hi, r.kind) for r in intervals.overlapping_genes(genes, 0).collect()}
    assert over == {("a", "e", "partial"), ("b", "e", "full"), ("d", "e", "partial")}


def test_merge_keeps_touching_apart(spark):
    bed = spark.createDataFrame([("1", 0, 10), ("1", 10, 20), ("1", 15, 18), ("1", 19, 30), ("2", 5, 6)], "chrom string, start bigint, end bigint")
    assert sorted(map(tuple, intervals.merge_intervals(bed).collect())) == [("1", 0, 10), ("1", 10, 30), ("2", 5, 6)]


def test_empty_inputs(spark):
    df = spark.createDataFrame([], "frag bigint, mate int, ord int, gene string, transcript string, strand string, pos int")
    assert pairs.pair_discovery(pairs.mate_pairs(df)).count() == 0
    assert pairs.missing_mates(df).count() == 0
