import re

from bitloom.operators.parse_failures import split_parsed

LINES = "line_id bigint, shard string, line string, reason string"
RESULTS = "shard string, k int, bit_len int, loaded_at timestamp"


def brute(line, k, n):
    """Reads a line sign by sign; None for no case, a reason, or the two values."""
    if line is None:
        return None
    line = line.rstrip(" \t\n\x0b\x0c\r")
    if not line:
        return None
    sep = "\t" if "\t" in line else " "
    fields, at, bad = [], 0, False
    while True:
        if line[at : at + 1] == '"':
            value, at, closed = "", at + 1, False
            while at < len(line):
                if line.startswith('""', at):
                    value, at = value + '"', at + 2
                elif line[at] == '"':
                    at, closed = at + 1, True
                    break
                else:
                    value, at = value + line[at], at + 1
            if not closed or at < len(line) and line[at] != sep:
                bad = True
                break
            end = at
        else:
            end = line.find(sep, at)
            end = len(line) if end < 0 else end
            value = line[at:end]
            bad |= '"' in value
        fields.append(value)
        if end >= len(line):
            break
        at = end + 1
    if bad:
        return "quoting"
    if len(fields) != 2:
        return "columns"
    if not re.fullmatch(f"[ACGTacgt]{{{k}}}", fields[0]):
        return "kmer"
    if len(fields[1]) != n:
        return "bit_len"
    if set(fields[1]) - {"0", "1"}:
        return "bit_value"
    return fields[0].upper(), fields[1]


TEXTS = [
    "ACG\t0101", "acg 0101", '"ACG"\t"0101"', '"ACG" 0101', "ACG\t0101  \r", "ACG", "ACG\t0101\t1", "ACG  0101", " ACG 0101", "ACG 0101 ", "ACGT\t0101", "ACN\t0101",
    "ACG\t010", "ACG\t01012", "ACG\t010x", 'AC"G\t0101', '"ACG\t0101', '"ACG"x\t0101', '""ACG""\t0101', '"A""G"\t0101', '"A\tG"\t0101', '"AC G" 0101', '"A\tCG" 0101', "", "   ", "\t", None, "\tACG\t0101",
    'ACG\t"0101', 'ACG\t0101"', '"', '""', '"" ""', '"""" 0101', "ACG\t" + "01" * 50_000, '"' * 1001 + "\t0101", "ÄCG\t0101", "ACG\t01\x0101", "ACG\t０１０１", "ACG\x010101", '"AC\x01G"\t0101',
]


def run(spark, rows, results):
    # a column of the same name as one the operator makes, and one it has no use for
    df = spark.createDataFrame([(*r, "clash") for r in rows], LINES)
    clean, bad = split_parsed(df, spark.createDataFrame(results, RESULTS))
    return {r.line_id: (r.kmer, r.bit) for r in clean.collect()}, {r.line_id: r.reason for r in bad.collect()}


def test_against_a_reader_sign_by_sign(spark):
    rows = [(i, "s", t) for i, t in enumerate(TEXTS)]
    clean, bad = run(spark, rows, [("s", 3, 4, None)])
    for i, t in enumerate(TEXTS):
        want = brute(t, 3, 4)
        assert (clean.get(i), bad.get(i)) == ((None, None) if want is None else (None, want) if isinstance(want, str) else (want, None)), repr(t)


def test_lengths_of_shards(spark):
    from datetime import datetime

    rows = [(1, "a", "ACG\t01"), (2, "a", "ACG\t011"), (3, "a", "ACG\t010"), (4, "a", "ACG 0"), (5, "b", "AC\t1"), (6, "b", "ACG\t1"), (7, "none", "AC\t11"), (8, None, "AC\t1x"), (9, None, "AC\t11"), (None, "a", "x")]
    results = [("a", 3, None, datetime(2024, 1, 1)), ("b", 3, 1, datetime(2024, 1, 1)), ("b", 2, 1, datetime(2024, 1, 2)), (None, 1, 1, None), ("empty", 9, 9, None)]
    clean, bad = run(spark, rows, results)
    assert bad == {1: "bit_len", 4: "bit_len", 6: "kmer", 8: "bit_value"}
    assert set(clean) == {2, 3, 5, 7, 9}


def test_repeated_and_empty(spark):
    clean, bad = run(spark, [(1, "s", "x"), (1, "s", "x"), (2, "s", "ACG\t1"), (2, "s", "ACG\t1")], [("s", 3, 1, None)])
    assert bad == {1: "columns"} and set(clean) == {2}
    assert run(spark, [], []) == ({}, {})
    assert run(spark, [(1, "s", "ACG\t1")], []) == ({1: ("ACG", "1")}, {})
