import random
from datetime import datetime

import pytest

from bitloom.operators import mapping, report

K = 7
CONTIGS = "contig_idx bigint, name string, seq string, assembly string, loaded_at timestamp"
OTHER = str.maketrans("ACGT", "TGCA")


def canon(k):
    return min(k, k.translate(OTHER)[::-1])


@pytest.fixture(scope="module")
def ref(spark):
    rng = random.Random(5)
    seqs = {i: "".join(rng.choice("ACGT") for _ in range(n)) for i, n in enumerate([3000, 5, K, 400, 1])}
    seqs[3] = seqs[3][:100] + "NNNN" + seqs[3][104:]
    rows = [(i, f"Chr{i}" if i < 3 else f"scaffold_{i}", s.lower() if i == 0 else s[:50] + "\n " + s[50:], "a", datetime(2024, 1, 1)) for i, s in seqs.items()]
    rows += [(3, "scaffold_3", seqs[3].replace("N", "-"), "a", datetime(2024, 1, 2)), (7, "x", None, "a", datetime(2024, 1, 1)), (8, "x", "", "a", datetime(2024, 1, 1)), (None, "x", "ACGT", "a", None)]
    return seqs, spark.createDataFrame(rows, CONTIGS)


def windows(seqs):
    return [(c, i, s[i : i + K]) for c, s in seqs.items() for i in range(len(s) - K + 1) if "N" not in s[i : i + K]]


def test_reference_windows(spark, ref, monkeypatch):
    seqs, contigs = ref
    monkeypatch.setattr(mapping, "_CHUNK", 100)
    norm = mapping.reference(contigs)
    want = windows(seqs)
    assert sorted(map(tuple, mapping.reference_kmers(norm, K).collect())) == sorted(want)
    number = str.maketrans("ACGT", "0123")
    codes = sorted((c, i, int(canon(k).translate(number), 4)) for c, i, k in want)
    assert sorted(map(tuple, mapping.reference_keys(norm, K).collect())) == codes


@pytest.mark.parametrize("k", [1, 30, 31, 32, 51, 62, 63, 64, 100])
def test_codes_of_any_length(spark, k):
    from pyspark.sql import functions as F

    rng = random.Random(k)
    seq = "".join(rng.choice("ACGT") for _ in range(k + 60))
    seq = seq[: k + 20] + "N" + seq[k + 21 :]
    at, forward, back = mapping.window_codes(seq.encode(), k)
    assert at.tolist() == [i for i in range(len(seq) - k + 1) if "N" not in seq[i : i + k]]
    texts = [seq[i : i + k] for i in at.tolist()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, kmer string")
    rows = df.select("i", *mapping.codes_of(F.col("kmer"), k, "f"), *mapping.keys_of(F.col("kmer"), k)).orderBy("i").collect()
    words = len(mapping.word_spans(k))
    assert [list(r)[1 : 1 + words] for r in rows] == forward.T.tolist()
    assert [list(r)[1 + words :] for r in rows] == mapping._smaller(forward, back).T.tolist()


def test_reference_takes_the_latest_sequence(spark):
    t = [datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [(0, "a", "AC", "x", t[0]), (0, "b", "A c-", "x", t[1]), (0, "c", None, "x", t[2]), (1, "d", "g\n", "x", None), (2, "e", "T", "x", t[0]), (2, "e", "T", "x", t[0])]
    got = sorted(map(tuple, mapping.reference(spark.createDataFrame(rows, CONTIGS)).collect()))
    assert got == [(0, "b", 3, "ACN"), (1, "d", 1, "G"), (2, "e", 1, "T")]
    assert mapping.written_reference(spark.createDataFrame(rows, CONTIGS).limit(0)).count() == 0


@pytest.mark.parametrize("k", [40, 64])
def test_mapping_of_long_kmers(spark, ref, k):
    seqs, contigs = ref
    norm = mapping.reference(contigs)
    kmers = [seqs[0][i : i + k] for i in (0, 700, 2000)]
    flipped = [kmers[0], kmers[1].translate(OTHER)[::-1], kmers[2], "A" * k, seqs[0][:k - 1]]
    hits = spark.createDataFrame([(m, float(i), 0.1) for i, m in enumerate(flipped)], "kmer string, effect double, p double")
    got = sorted((r.contig_idx, r.pos, r.effect) for r in mapping.map_hits(norm, mapping.build_index(hits, k), k).collect())
    assert got == [(0, 0, 0.0), (0, 700, 1.0), (0, 2000, 2.0)]
    assert sorted((r.contig_idx, r.pos, r.effect) for r in mapping.map_dual(norm, hits, k).collect()) == got
    first = mapping.first_positions(norm, hits.selectExpr("cast(effect as int) as idx", "kmer"), k).collect()
    assert {r.idx: r.pos for r in first} == {0: 0, 1: 700, 2: 2000}


@pytest.mark.parametrize("small", [1, 300_000])
def test_mapping_both_strands(spark, ref, monkeypatch, small):
    seqs, contigs = ref
    monkeypatch.setattr(mapping, "_SMALL_INDEX", small)
    k0, k3 = seqs[0][10 : 10 + K], seqs[3][20 : 20 + K]
    hits = spark.createDataFrame([(k0, 1.0, 1e-5), (k0.lower(), 2.0, 1e-7), (k3.translate(OTHER)[::-1], 3.0, 1e-6), ("ACGN" + "A" * 3, 1.0, 0.1), ("ACG", 1.0, 0.1), (None, 1.0, 0.1)], "kmer string, effect double, p double")
    index = mapping.build_index(hits, K)
    entries = {canon(k0): (2.0, 1e-7), canon(k3): (3.0, 1e-6)}
    assert {r.canon: (r.effect, r.p) for r in index.collect()} == entries
    got = sorted((r.contig_idx, r.pos, r.effect, r.p) for r in mapping.map_hits(mapping.reference(contigs), index, K).collect())
    assert got == sorted((c, i, *entries[canon(k)]) for c, i, k in windows(seqs) if canon(k) in entries)
    dual = sorted((r.contig_idx, r.pos) for r in mapping.map_dual(mapping.reference(contigs), hits, K).collect())
    assert dual == [g[:2] for g in got]
    strict = mapping.map_hits(mapping.reference(contigs), index, K, max_p=5e-7).collect()
    assert {r.effect for r in strict} == {2.0}
    first = mapping.first_positions(mapping.reference(contigs), spark.createDataFrame([(5, k3), (6, "A" * K), (7, "bad")], "idx int, kmer string"), K).collect()
    starts = {0: 0, 1: 3000, 2: 3005, 3: 3012, 4: 3412}
    places = [starts[c] + i for c, i, k in windows(seqs) if canon(k) == canon(k3)]
    assert {r.idx: r.pos for r in first if r.idx != 6} == {5: min(places)}


def test_offsets(spark, ref):
    _, contigs = ref
    got = {r.contig_idx: (r.len, r.start) for r in mapping.contig_offsets(contigs, buckets=3).collect()}
    assert got == {0: (3000, 0), 1: (5, 3000), 2: (7, 3005), 3: (400, 3012), 4: (1, 3412), 7: (0, 3413), 8: (0, 3413)}
    assert mapping.contig_offsets(contigs.limit(0)).count() == 0


def two_pointers(positions, window, density):
    need, keep, until, right = int(window * density), [], 0, 0
    for i, p in enumerate(positions):
        while right < len(positions) and positions[right] <= p + window - 1:
            right += 1
        if right - i >= need:
            until = max(until, p + window - 1)
        if p <= until:
            keep.append(p)
    return keep


def test_density_filter_against_two_pointers(spark):
    rng = random.Random(2)
    rows, want = [], []
    for c in range(12):
        size = rng.choice([300, 2_000, 60_000])
        dense = {rng.randrange(size) for _ in range(size // 10)}
        start = rng.randrange(size)
        places = sorted(dense | set(range(start, start + 150)) | ({0} if c % 2 else set()))
        rows += [(c, p, "x") for p in places]
        want += [(c, p) for p in two_pointers(places, 100, 0.95)]
    df = spark.createDataFrame(rows + [(None, 5, "x"), (3, None, "x")], "contig_idx bigint, pos bigint, n string")
    got = sorted((r.contig_idx, r.pos) for r in mapping.density_filter(df).filter("contig_idx is not null").collect())
    assert got == want


def test_micro_density(spark):
    places = [0, 5, *range(10, 110), 300]
    df = spark.createDataFrame([(0, p) for p in places], "contig_idx bigint, pos bigint")
    got = sorted(r.pos for r in mapping.density_filter(df).collect())
    assert got == two_pointers(places, 100, 0.95) and 0 in got and 300 not in got


def test_pairs_and_places(spark):
    pairs = spark.createDataFrame([(1, 2, 0.5, 0.1), (2, 3, 0.5, 0.1), (1, 9, 0.5, 0.1)], "idx_a bigint, idx_b bigint, effect double, p double")
    at = spark.createDataFrame([(1, 50), (2, 20), (3, 20)], "idx bigint, pos bigint")
    assert sorted((r.pos_a, r.pos_b) for r in mapping.map_pairs(pairs, at).collect()) == [(20, 20), (20, 50)]
    ref = spark.createDataFrame([(0, "n", "ACGTNACGTA")], "contig_idx bigint, name string, seq string")
    places = spark.createDataFrame([(0, 0, 1), (0, 2, 2), (0, 5, 3), (0, 8, 4), (1, 0, 5)], "contig_idx bigint, pos bigint, kmer int")
    got = mapping.kmers_at(ref, places.drop("kmer"), 4).collect()
    assert sorted((r.pos, r.kmer) for r in got) == [(0, "ACGT"), (5, "ACGT")]


def test_locate_and_labels(spark, ref):
    offsets = mapping.contig_offsets(ref[1])
    pts = spark.createDataFrame([(0,), (2999,), (3000,), (3412,), (5000,), (None,)], "pos bigint")
    got = {r.pos: (r.contig_idx, r.local) for r in report.locate(pts, offsets, block=1000).collect()}
    assert got == {0: (0, 0), 2999: (0, 2999), 3000: (1, 0), 3412: (4, 0), 5000: (None, None), None: (None, None)}
    from pyspark.sql import functions as F

    names = ["Chr1", "chrom_02", "CHROMOSOME-3x", "chrX", "scaffold_1", "", None]
    df = spark.createDataFrame([(n,) for n in names], "name string").select(report.chromosome_label(F.col("name")))
    assert [r[0] for r in df.collect()] == ["Chr1", "Chr2", "Chr3", "Other", "Other", "Other", "Other"]


def test_regions_and_peaks(spark):
    rows = [(100, 0, 1.0, 0.1), (149, 10, 2.0, 0.01), (150, 20, 3.0, 0.01), (199, 39, -1.0, 0.01), (200, 5, 1.0, 0.1), (150, 40, 1.0, 0.1), (99, 1, 1.0, 0.1)]
    df = spark.createDataFrame(rows, "pos_a bigint, pos_b bigint, effect double, p double")
    inside = report.region(df, (100, 200), (0, 40))
    assert sorted(r.pos_a for r in inside.collect()) == [100, 149, 150, 199] and report.region(df).count() == 7
    assert report.bin_width((100, 200), (0, 40), 2) == 50
    peaks = {(r.cx, r.cy): (r.x, r.y, r.effect) for r in report.cell_peaks(inside, 50, origin=(100, 0)).collect()}
    assert peaks == {(0, 0): (125, 25, 2.0), (1, 0): (175, 25, 3.0)}
    assert report.marginal_sample(df.withColumnRenamed("pos_a", "pos"), 3).count() == 3
