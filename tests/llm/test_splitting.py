import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bitloom.llm import splitting
from bitloom.operators import mapping

CONTIGS = "contig_idx bigint, name string, seq string, assembly string, loaded_at timestamp, pos string"


def table(spark, seqs):
    return spark.createDataFrame([(i, "n", s, "a", t, "clash") for i, s, t in seqs], CONTIGS)


def norm(s):
    return re.sub("[^ACGT]", "N", re.sub(r"[ \t\n\v\f\r]", "", s).translate(str.maketrans("acgt", "ACGT")))


def gaps(s, least):
    return [m.span() for m in re.finditer(f"N{{{least},}}", s) if m.start() > 0 and m.end() < len(s)]


def greedy(s, limit, overlap, least):
    """The pieces one after another."""
    if len(s) <= limit:
        return [(0, len(s))] if s else []
    ends = [e for _, e in gaps(s, least) if e > overlap]
    pieces, start = [], 0
    while len(s) - start > limit:
        near = [e for e in ends if start + overlap < e <= start + limit]
        cut = max(near) if near else start + limit
        pieces.append((start, cut))
        start = cut - overlap
    return [*pieces, (start, len(s))]


def dna(rng, n, gap_rate, least):
    out = ""
    while len(out) < n:
        out += "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 3 * least)))
        if rng.random() < gap_rate:
            out += "N" * rng.choice([least - 1, least, least + 3, 4 * least, 200])
    return out[:n]


T0 = datetime(2024, 1, 1)


def test_against_cutting_one_after_another(spark):
    rng = random.Random(7)
    limit, overlap, least = 100, 10, 5
    seqs = {i: dna(rng, rng.choice([1, 50, 99, 100, 101, 150, 1000, 20_000]), rng.choice([0, 0.02, 0.3]), least) for i in range(40)}
    seqs[40], seqs[41], seqs[42] = "N" * 5000, "A" * 5000, "A" * 8 + "N" * 6 + "A" * 300
    df = table(spark, [(i, s, T0) for i, s in seqs.items()])
    want = {(i, *p) for i, s in seqs.items() for p in greedy(s, limit, overlap, least)}
    rows = splitting.split_oversized(df, limit, overlap, least).collect()
    assert {(r.contig_idx, r.start, r.end) for r in rows} == want and len(rows) == len(want)
    assert all(r.seq == seqs[r.contig_idx][r.start : r.end] and len(r.seq) <= limit for r in rows)
    cases = {(r.contig_idx, r.gap_start, r.gap_end) for r in splitting.gap_cases(df, limit, overlap, least).collect()}
    wanted = {(i, *g) for i, s in seqs.items() if len(s) > limit for g in gaps(s, least) or [(-1, -1)]}
    assert cases == wanted


def test_layouts_nulls_and_redelivery(spark):
    body = "acgt" * 40 + "n" * 12 + "ACGT" * 40
    laid = "\n".join(body[i : i + 60] for i in range(0, len(body), 60)) + "\r\n"
    df = table(spark, [(1, body, T0), (1, laid, datetime(2024, 1, 2)), (1, laid, datetime(2024, 1, 2)), (1, None, datetime(2024, 1, 3)), (2, None, T0), (3, "", T0), (4, " \n", T0), (5, "acg?", T0), (None, body, T0)])
    rows = splitting.split_oversized(df, 100, 10, 10).collect()
    want = {(1, *p) for p in greedy(norm(body), 100, 10, 10)} | {(5, 0, 4)}
    assert {(r.contig_idx, r.start, r.end) for r in rows} == want and len(rows) == len(want)
    assert next(r.seq for r in rows if r.contig_idx == 5) == "ACGN"
    assert [tuple(r) for r in splitting.gap_cases(df, 100, 10, 10).collect()] == [(1, 160, 172)]


def test_empty_and_wrong_parameters(spark):
    df = table(spark, [(1, "ACGT", T0)])
    assert splitting.split_oversized(df.limit(0)).count() == 0 and splitting.gap_cases(df.limit(0)).count() == 0
    assert splitting.gap_cases(df).count() == 0
    with pytest.raises(ValueError):
        splitting.cut_points(mapping.reference(df), 10, 10)


@pytest.mark.parametrize("broken", ["some off the path", "leads too far back", "never ends"])
def test_cases_come_from_the_doubled_path(spark, monkeypatch, broken):
    rng = random.Random(3)
    seqs = {i: dna(rng, 3000, 0.3, 5) for i in range(6)} | {6: "A" * 3000}
    df = table(spark, [(i, s, T0) for i, s in seqs.items()])
    wanted = {(i, *g) for i, s in seqs.items() for g in gaps(s, 5) or [(-1, -1)]}
    right = splitting.greedy_cuts

    def wrong(*args):
        nodes = right(*args)
        if broken == "some off the path":
            return nodes.withColumn("on_path", F.col("on_path") & (F.col("pos") % 3 > 0))
        if broken == "leads too far back":
            return nodes.withColumn("nxt", F.col("nxt") - 40)
        return nodes.withColumn("on_path", F.col("on_path") & (F.col("nxt") < F.col("len")))

    cases = lambda: {tuple(r) for r in splitting.gap_cases(df, 100, 10, 5).collect()}
    assert cases() == wanted
    monkeypatch.setattr(splitting, "greedy_cuts", wrong)
    assert cases() < wanted
