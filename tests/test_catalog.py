"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from helixloom.plans import catalog


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for f in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(spark, sf, con, name):
    got = catalog.QUERIES[name](spark, sf).toArrow()
    want = con.sql(catalog.ORACLE_SQL[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    con.register("got", got), con.register("want", want)
    cols = ", ".join(f'"{c}"' for c in got.column_names)
    for a, b in (("got", "want"), ("want", "got")):
        assert con.sql(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b}").fetchall() == []


def test_entry():
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.ORACLE_SQL) <= set(entry.oracle_sql())


def test_wiggle_against_sequential_rule(spark, sf):
    from helixloom.operators.report import WIGGLE
    from helixloom.plans import analogs

    rows = sorted(analogs.report(spark, sf).collect(), key=lambda r: r.ord)
    buckets, want = {}, set()
    for r in rows:
        bucket = buckets.setdefault((r.g_1, r.g_2), [])
        hit = "exon-exon" not in r.labels and any(
            k.pairs >= r.pairs and k.reads >= r.reads and (k.chrom_1, k.strand_1, k.chrom_2, k.strand_2) == (r.chrom_1, r.strand_1, r.chrom_2, r.strand_2) and abs(k.at_1 - r.at_1) <= WIGGLE and abs(k.at_2 - r.at_2) <= WIGGLE for k in bucket
        )
        if not hit:
            bucket.append(r)
            want.add(r.ord)
    assert {r.ord for r in catalog.QUERIES["wiggle_filter"](spark, sf).collect()} == want


def test_symbol_resolve_takes_every_part(spark, sf):
    rows = spark.read.parquet(f"{sf}/part.parquet").collect()
    symbol = {r.p_partkey: f"{r.p_name} {r.p_partkey // 50}".upper() for r in rows}
    tables = {}, {}
    for k, s in symbol.items():
        tables[k % 2].setdefault(s, set()).add(f"{'PQ'[k % 2]}{k}")
    ids = lambda s: tables[0].get(s) or tables[1][s]
    want = {tuple(sorted((a, b))) for k, s in symbol.items() if symbol.get(k + 1, s) != s for a in ids(s) for b in ids(symbol[k + 1])}
    got = [tuple(r) for r in catalog.QUERIES["symbol_resolve"](spark, sf).select("g_lo", "g_hi").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    hidden = {g for s, genes in tables[1].items() if s in tables[0] for g in genes}
    paired = {k for k, s in symbol.items() if any(symbol.get(k + d, s) != s for d in (-1, 1))}
    assert {f"{'PQ'[k % 2]}{k}" for k in paired} - hidden <= {g for pair in got for g in pair}


def test_junctions_take_every_gene(spark, tmp_path):
    rows = [(k, f"{'abcdefghijklmnop'[k % 13:]} {k % 7}", 1 + k % 5) for k in range(1000)]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    exons = {}
    for k, name, size in rows:
        seq = "".join("ACGTACGTACGTACGTACGTACGTACN"["abcdefghijklmnopqrstuvwxyz ".index(c)] if c.islower() or c == " " else c for c in name + "a" * size)
        exons.setdefault(k % 200, []).append((f"T{k % 400}", k // 400, f"R{k}/{1 + k % 2}", seq))
    want, firsts, genes = [], [], {n: min(e[3] for e in x) for n, x in exons.items()}
    for n in range(200):
        for m in {n - 1, n, n + 1} & set(exons):
            for a in exons[n]:
                for b in exons[m]:
                    if n != m or a[0] < b[0] or (a[0] == b[0] and a[1] < b[1]):
                        left, right = a[3][-8:], b[3][:8]
                        want.append((f"K{n}", f"K{m}", f"K{n}-K{m};{a[0]}-{b[0]};{a[2]}-{b[2]};rank_exon={a[1]}-{b[1]};length={len(left + right)};junction={len(left)}", left + right))
            if n != m:
                firsts.append((f"K{n}|K{m}|{len(genes[n])}", genes[n] + genes[m]))
    run = lambda name, *cols: sorted(tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).select(*cols).collect())
    assert run("exon_exon_junctions", "gene_1", "gene_2", "id", "seq") == sorted(want)
    assert {x[0] for x in want} == {f"K{n}" for n in range(200)}
    same = {}
    for a, b, i, seq in sorted(want):
        same.setdefault((a, b), {}).setdefault(seq, []).append(i)
    assert run("unique_junction_sequences", "gene_1", "gene_2", "seq", "id", "others") == sorted((*p, seq, ids[0], "|".join(ids[1:])) for p, by in same.items() for seq, ids in by.items())
    assert run("junction_sequence_index", "gene_1", "gene_2", "id", "index") == sorted((*p, i, k) for p, by in same.items() for k, ids in enumerate(sorted(by.values())) for i in ids)
    assert run("gene_gene_junctions", "id", "seq") == sorted(firsts)


def test_extract_goes_by_the_limit(spark):
    from helixloom.operators import pairs

    rows = [(f"A{i % 7}", f"B{i}", 1 + i % 4, ["known"] if i % 5 == 0 else ["paralog"] if i % 3 == 0 else ["further_fusion"] if i == 6 else []) for i in range(40)]
    df = spark.createDataFrame(rows, "g_lo string, g_hi string, n int, labels array<string>")
    for limit in (0, 1, 5, 12, 1000):
        taken, want = 0, set()
        for lo, hi, n, labels in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
            usual = n >= 2 and ("known" in labels or "paralog" not in labels)
            always = "further_fusion" in labels
            if always or (usual and taken < limit):
                want.add(hi)
            taken += always or usual
        got = pairs.extract_candidates(df, threshold_pairs=2, threshold_count=limit).where("status = 'further_analysis'")
        assert {r.g_hi for r in got.collect()} == want, limit


def test_exon_pairs_are_dealt_by_their_rows(spark, monkeypatch):
    from helixloom.operators import junctions

    monkeypatch.setattr(junctions, "TASK_ROWS", 100)
    exons = [(g, f"T{i % 3}" if i % 11 else None, f"E{i}" if i % 7 else None, i if i % 5 else None, "ACGT" * 3 if i % 13 else None) for g in "AB" for i in range(40)]
    exons = spark.createDataFrame(exons, "gene string, transcript string, exon string, rank int, seq string").coalesce(1)
    pairs = spark.createDataFrame([("A", "B"), ("A", "A"), ("A", "B")], "g_lo string, g_hi string").coalesce(1)
    want = []
    for one, two in [("A", "B"), ("A", "A"), ("A", "B"), ("B", "A"), ("B", "A")]:
        for a in (r for r in exons.collect() if r.gene == one):
            for b in (r for r in exons.collect() if r.gene == two):
                same = None not in (a.transcript, b.transcript) and (a.transcript < b.transcript or (a.transcript == b.transcript and None not in (a.rank, b.rank) and a.rank < b.rank))
                if one != two or same:
                    dash = lambda *x: "-".join(str(v) for v in x if v is not None)
                    left, right = a.seq and a.seq[-5:], b.seq and b.seq[:5]
                    parts = [dash(one, two), dash(a.transcript, b.transcript), dash(a.exon, b.exon), "rank_exon=" + dash(a.rank, b.rank), "length=10" if left and right else None, "junction=5" if left else None]
                    want.append((";".join(x for x in parts if x is not None), one, two, left and 5, left + right if left and right else None))
    tasks = {}
    for together in (False, True):
        rows = junctions.exon_exon_junctions(pairs, exons, 5, together=together)
        assert sorted(map(str, map(tuple, rows.collect()))) == sorted(map(str, want))
        where = rows.select("gene_1", "gene_2", F.spark_partition_id().alias("task")).distinct().collect()
        tasks[together] = max(sum((r.gene_1, r.gene_2) == p for r in where) for p in (("A", "B"), ("A", "A")))
    # few bytes, but many rows: one pair's rows come from many tasks, or from one if asked
    assert tasks[False] > 5 and tasks[True] == 1


def test_exons_are_sent_to_a_root_of_the_tasks(spark, monkeypatch):
    from helixloom.operators import junctions

    monkeypatch.setattr(junctions, "TASK_ROWS", 100)
    exons = spark.range(80).selectExpr("if(id < 40, 'A', 'B') gene", "'T' transcript", "concat('E', id) exon", "cast(id as int) rank", "'ACGTACGT' seq")
    pairs = spark.createDataFrame([("A", "B")], "g_lo string, g_hi string")
    sent, plain = [], type(exons).repartition
    monkeypatch.setattr(type(exons), "repartition", lambda self, *a: sent.append(self) or plain(self, *a))
    assert junctions.exon_exon_junctions(pairs, exons, 5).distinct().count() == 2 * 40 * 40
    # both directions of 40 by 40 exons in 16 tasks: each exon of either side goes to 4 of them
    assert [x.count() for x in sent] == [2 * 40 * 4, 2 * 40 * 4]
