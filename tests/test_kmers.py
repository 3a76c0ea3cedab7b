import random

from pyspark.sql import functions as F

from bitloom.functions import kmers


def test_kmer_expressions_against_plain_python(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ACGTacgt") for _ in range(rng.choice([1, 5, 21, 31]))) for _ in range(200)]
    other = str.maketrans("ACGT", "TGCA")
    df = spark.createDataFrame([(t,) for t in texts], "k string")
    c = kmers.canonical(F.col("k"))
    got = df.select("k", kmers.reverse_complement(F.col("k")), c, kmers.encoded(c), kmers.index_shard(c, 16), F.length("k"), kmers.is_kmer(F.col("k"))).collect()
    for k, rc, canon, code, shard, n, ok in got:
        up = k.upper()
        want = min(up, up.translate(other)[::-1])
        number = int(want.translate(str.maketrans("ACGT", "0123")), 4)
        assert rc == up.translate(other)[::-1] and canon == want and code == number and shard == number % 16 and ok


def test_decoding_inverts_encoding(spark):
    df = spark.createDataFrame([("A" * 31,), ("T" * 31,), ("ACGTACGTACGTACGTACGTACGTACGTACG",)], "k string")
    assert all(k == again for k, again in df.select("k", kmers.decoded(kmers.encoded(F.col("k")), 31)).collect())


def test_edges(spark):
    df = spark.createDataFrame([(None,), ("",), ("ACGN",), ("A" * 32,)], "k string")
    rows = df.select(kmers.is_kmer(F.col("k")), kmers.is_kmer(F.col("k"), 4), kmers.encoded(F.col("k"))).collect()
    assert [r[0] for r in rows] == [False, False, False, True]
    assert [r[1] for r in rows] == [False, False, False, False]
    assert rows[3][2] is None
