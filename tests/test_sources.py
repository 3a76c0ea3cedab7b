import gzip

import numpy as np
import pytest

from bitloom.operators.features import Design
from bitloom.sources import columns, sinks, text
from bitloom.streaming import scan as streaming


def put(path, body, zipped=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    (gzip.open if zipped else open)(path, "wt", newline="").write(body)
    return str(path)


def test_axis_and_phenotype(spark, tmp_path):
    path = put(tmp_path / "acc.txt", "s1\r\n\ns2\ns3")
    assert [(r.ord, r.sample_id) for r in text.sample_list(spark, path).orderBy("ord").collect()] == [(0, "s1"), (1, "s2"), (2, "s3")]
    path = put(tmp_path / "ph.txt", "s1 1.5\ns2\t2e0 extra\n s1  3\nbroken x\ns9 4\n")
    assert [(r.sample_id, r.y) for r in text.phenotype_file(spark, path).orderBy("line_no").collect()] == [("s1", 1.5), ("s2", 2.0), ("s1", 3.0)]


def test_row_matrix(spark, tmp_path):
    put(tmp_path / "m/a.tsv.gz", "ACG\t010\nAC 01 1\nnothing\n", True)
    put(tmp_path / "m/b.tsv", "TTT 111\r\n")
    got = sorted(map(tuple, text.row_matrix(spark, str(tmp_path / "m")).collect()))
    assert got == [("a.tsv.gz", "AC", "01 1"), ("a.tsv.gz", "ACG", "010"), ("b.tsv", "TTT", "111")]
    assert text.strict_row_matrix(spark, str(tmp_path / "m/b.tsv"), 3, 3).count() == 1
    with pytest.raises(Exception, match="bit string"):
        text.strict_row_matrix(spark, str(tmp_path / "m"), 2, 3).collect()


def test_tables(spark, tmp_path):
    path = put(tmp_path / "hits.tsv", "kmer\teffect\tp\nACG\t0.5\t1e-9\nACG\t010\t0.5\t1e-9\nACN\t1\t1\nAC\t1\t1\nACG\tx\t1\n")
    assert sorted((r.kmer, r.bit, r.effect, r.p) for r in text.association_file(spark, path, 3).collect() if r.bit) == [("ACG", "010", 0.5, 1e-9)]
    assert text.association_file(spark, path, 3).count() == 2
    path = put(tmp_path / "pairs.tsv", "0\t1\t0.5\t0.1\n1\t7\t0.5\t0.1\nx\t1\t1\t1\n")
    assert text.pair_file(spark, path, 5).count() == 1 and text.pair_file(spark, path).count() == 2
    path = put(tmp_path / "map.tsv", "# c\n5 0.5 0\n7 x 1\n9 1\n11\t-1\t0.5\n")
    assert sorted((r.pos, r.p) for r in text.hit_file(spark, path).collect()) == [(5, 1e-300), (11, 0.5)]
    assert [r.pos for r in text.hit_file(spark, path, 6, 20).collect()] == [11]
    path = put(tmp_path / "dict.txt", "CCC\nAAA\nGGG\n")
    assert [(r.idx, r.kmer) for r in text.kmer_dictionary(spark, path, 3).orderBy("idx").collect()] == [(0, "CCC"), (1, "AAA"), (2, "GGG")]
    with pytest.raises(ValueError):
        text.kmer_dictionary(spark, path, 4)
    assert text.boundary_file(spark, put(tmp_path / "b.tsv", "c1\t0\t10\nlabel\tstart\tend\n")).count() == 1
    assert text.count_files(spark, put(tmp_path / "c.tsv", "s\t5\n")).first().tested == 5


def test_two_population_files(spark, tmp_path):
    path = put(tmp_path / "host.txt", "h1 010\nonly\nh2\t111\n")
    assert sorted(map(tuple, text.labelled_bits(spark, path).collect())) == [("h1", "010"), ("h2", "111")]
    with pytest.raises(Exception, match="unequal"):
        text.labelled_bits(spark, put(tmp_path / "bad.txt", "h1 010\nh2 1\n")).collect()
    assert text.grid_file(spark, put(tmp_path / "g.txt", "# x\n0 0 1.5\n\n0 1 y\n")).count() == 1
    assert text.number_matrix(spark, put(tmp_path / "u.txt", "1 2\n3 4.5\n")).orderBy("line_no").first().row == [1.0, 2.0]
    path = put(tmp_path / "x.tsv", "sample_id\ta\tb\ns1\t0\t1\n")
    assert text.transposed_sample(spark, path).first().row == [0.0, 1.0]
    with pytest.raises(Exception, match="ragged"):
        text.transposed_sample(spark, put(tmp_path / "x2.tsv", "sample_id\ta\tb\ns1\t0\n")).collect()


def test_fasta(spark, tmp_path):
    path = put(tmp_path / "r.fasta", ">Chr1 long name A>G\nacgt\nNNRA\n>empty\n>b\tx\r\nAC GT\r\n>>odd\nAC>\n")
    got = [(r.contig_idx, r.name, r.seq) for r in text.fasta(spark, path).orderBy("contig_idx").collect()]
    assert got == [(0, "Chr1", "ACGTNNNA"), (1, "empty", ""), (2, "b", "ACGT"), (3, ">odd", "ACN")]
    put(tmp_path / "many/a.fa", "; a note\n>c1 variant A>G note\nAC\n")
    put(tmp_path / "many/b.fa", ">c2\nGG")
    assert [(r.name, r.seq) for r in text.fasta(spark, str(tmp_path / "many")).orderBy("contig_idx").collect()] == [("c1", "AC"), ("c2", "GG")]


def test_columns_round_trip(spark, tmp_path):
    rows = [("ACG", "0110"), ("CCC", "0011"), ("GGG", "0110")]
    columns.write_columns(spark.createDataFrame(rows, "kmer string, bit string"), str(tmp_path / "out"), 4)
    names = "".join(gzip.open(p, "rt").read() for p in sorted((tmp_path / "out/kmers").glob("*.gz"))).split()
    assert names == ["CCC", "ACG", "GGG"]
    for j in range(4):
        put(tmp_path / f"batch/bits/col_{j:06d}.txt", "".join(r[1][j] for r in sorted(rows, key=lambda r: (r[1], r[0]))) + "\n")
    put(tmp_path / "lines/bits/col_000000.txt", "01\n1\n0")
    for path in ("batch", "out"):
        batch = columns.column_batch(spark, str(tmp_path / path))
        assert columns.probe_rows(batch) == 3 and columns.column_batch(spark, str(tmp_path / path), [1, 3]).count() == 2
        ones = sorted(map(tuple, columns.presence_of(batch).collect()))
        assert ones == [(0, 2), (0, 3), (1, 1), (1, 2), (2, 1), (2, 2)]
    assert columns.batch_facts(spark, str(tmp_path / "out"))["num_rows"] == "3"
    lines = columns.column_batch(spark, str(tmp_path / "lines"))
    assert sorted(map(tuple, columns.presence_of(lines).collect())) == [(1, 0), (2, 0)] and columns.probe_rows(lines) == 4


def test_sinks(spark, tmp_path):
    u = np.arange(6.0).reshape(3, 2)
    sinks.write_basis(spark, u, str(tmp_path / "U.bin"))
    assert np.array_equal(sinks.read_basis(spark, str(tmp_path / "U.bin"), 3), u)
    with pytest.raises(ValueError):
        sinks.read_basis(spark, str(tmp_path / "U.bin"), 4)
    hits = spark.createDataFrame([("ACG", "01", 0.25, 1e-9)], "kmer string, bit string, effect double, p double")
    sinks.write_hits(hits, str(tmp_path / "h"))
    sinks.write_candidates(hits, str(tmp_path / "c"))
    assert text.association_file(spark, str(tmp_path / "h"), 3).first().p == 1e-9
    assert text.association_file(spark, str(tmp_path / "c"), 3).first().bit == "01"
    index = spark.createDataFrame([("AAC", 1.0, 0.1, 1), ("AAA", 1.0, 0.1, 0)], "canon string, effect double, p double, shard int")
    sinks.write_index(index, str(tmp_path / "i"), 3)
    assert sinks.read_index(spark, str(tmp_path / "i"), 3).filter("shard = 1").first().canon == "AAC"
    with pytest.raises(ValueError):
        sinks.read_index(spark, str(tmp_path / "i"), 4)
    sinks.write_tsv(hits, str(tmp_path / "six"), ["effect", "p"], digits=6)
    assert spark.read.text(str(tmp_path / "six")).first().value == "2.50000e-01\t1.00000e-09"
    two = spark.createDataFrame([("h", "p", 1.5, 0.25, 3.0, 0.125)], "a string, b string, ratio double, delta double, lrt double, p double")
    sinks.write_twoway(two, str(tmp_path / "two"))
    assert spark.read.text(str(tmp_path / "two")).first().value.startswith("h p 1.500000000e+00 ")
    sinks.write_dictionary(spark.createDataFrame([(1, "AAC"), (0, "AAA")], "idx bigint, kmer string"), str(tmp_path / "d"))
    assert [tuple(r) for r in text.kmer_dictionary(spark, str(tmp_path / "d"), 2).orderBy("idx").collect()] == [(0, "AAA"), (1, "AAC")]


def test_contig_hits(spark, tmp_path):
    # every task has hits of every contig; a contig is one file all the same, and a stretch of 5,000,000 bases of a long one
    rows = [(c, 10 * i + c, -0.5 * i, 10.0**-i) for i in range(8) for c in range(40)] + [(3, 12_000_000, 0.25, 1e-300), (None, 5, 1.5, 0.0), (7, 5_000_000, None, 1.0), (7, None, 2.0, 0.5)]
    hits = spark.createDataFrame(rows, "contig_idx bigint, pos bigint, effect double, p double").repartition(8)
    path = tmp_path / "by contig%"
    put(path / "contig_99.00000.tsv", "1\t1\t1\n")  # from before
    sinks.write_contig_hits(hits, str(path))
    names = sorted(f.name for f in path.iterdir() if f.name[0] not in "_.")
    assert names == sorted([*(f"contig_{c}.00000.tsv" for c in range(40)), "contig_3.00002.tsv", "contig_7.00001.tsv", "contig_7.none.tsv", "contig_.00000.tsv"])
    assert not any(f.is_dir() for f in path.iterdir()) and not list(path.glob(".[0-9a-f]*"))
    assert [int(x.split("\t")[0]) for x in (path / "contig_5.00000.tsv").read_text().splitlines()] == [10 * i + 5 for i in range(8)]
    order = lambda r: str(tuple(r))
    got = sorted(((r.contig_idx, r.pos, r.effect, r.p) for r in text.contig_hits(spark, str(path)).collect()), key=order)
    assert got == sorted(rows, key=order)
    hits.write.partitionBy("contig_idx").csv(str(tmp_path / "folders"), sep="\t")  # as in other file systems
    got = sorted(((r.contig_idx, r.pos, r.effect, r.p) for r in text.contig_hits(spark, str(tmp_path / "folders")).collect()), key=order)
    assert got == sorted(rows, key=order)
    sinks.write_contig_hits(hits.limit(0), str(path))
    assert text.contig_hits(spark, str(path)).count() == 0 and [f.name for f in path.iterdir() if f.suffix == ".tsv"] == []


def test_stream_scan(spark, tmp_path):
    rng = np.random.default_rng(0)
    y = np.arange(12.0)
    d = Design(np.arange(12), y, np.full((12, 1), 12**-0.5))
    rows = [(i, f"s{i % 2}", "ACGTA", "".join("1" if v > rng.random() * 12 else "0" for v in y), None) for i in range(40)]
    df = spark.createDataFrame(rows, streaming.SCHEMA).selectExpr("row_id", "shard", "kmer", "bit", "timestamp'2024-01-01' + make_interval(0, 0, 0, int(row_id)) as loaded_at")
    df.write.parquet(str(tmp_path / "in"))
    df.limit(5).write.mode("append").parquet(str(tmp_path / "in"))
    from bitloom.operators import scan1d

    want = {r.row_id for r in scan1d.scan(df, d, 0.2, 1.0).collect()}
    hits = streaming.stream_hits(streaming.row_stream(spark, str(tmp_path / "in")), d, 5, 12, 0.2, 1.0)
    hits.writeStream.format("memory").queryName("hits").trigger(availableNow=True).start().awaitTermination()
    got = [r.row_id for r in spark.table("hits").collect()]
    assert set(got) == want and len(got) == len(want)
    counts = streaming.stream_counts(streaming.row_stream(spark, str(tmp_path / "in")), d, 5, 12, 0.2)
    counts.writeStream.format("memory").outputMode("complete").queryName("counts").trigger(availableNow=True).start().awaitTermination()
    assert sum(r.tested for r in spark.table("counts").collect()) >= len(want)
