"""Rows that fail to parse: cells, a rule table, and an anti-join for the clean rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom.plans.runtime import checkpointed, lookup_join

#: ASCII white space (fixed values).
BLANKS = " \t\n\x0b\x0c\r"

#: Order of precedence, reason, cell the rule looks at (-1: the line as a whole).
RULES = [
    (1, "quoting", -1),
    (2, "columns", -1),
    (3, "kmer", 0),
    (4, "bit_len", 1),
    (5, "bit_value", 1),
]

_INSIDE = "\x01"  # stands for a separator inside quotes while a line is cut
_LITERAL = "\x02"  # stands for a \x01 that was in the text before


def _fields(line: Column) -> Column:
    """The raw fields of a line as an array: tab separated, or blank separated without a tab.

    A separator with an odd number of quotes before it lies inside quotes. All
    steps are linear in the length of the line.
    """
    sep = F.when(line.contains("\t"), F.lit("\t")).otherwise(F.lit(" "))
    safe = F.replace(line, F.lit(_INSIDE), F.lit(_LITERAL))
    parts = F.transform(F.split(safe, '"', -1), lambda s, i: F.when(i % 2 == 1, F.replace(s, sep, F.lit(_INSIDE))).otherwise(s))
    shielded = F.when(line.contains('"'), F.array_join(parts, '"')).otherwise(safe)
    whole = F.when(sep == "\t", F.split(shielded, "\t", -1)).otherwise(F.split(shielded, " ", -1))
    return F.transform(whole, lambda f: F.replace(F.replace(f, F.lit(_INSIDE), sep), F.lit(_LITERAL), F.lit(_INSIDE)))


def _inner(field: Column) -> Column:
    return F.substring(field, F.lit(2), F.greatest(F.length(field) - 2, F.lit(0)))


def _badly_quoted(field: Column) -> Column:
    closed = field.startswith('"') & field.endswith('"') & (F.length(field) >= 2) & ~F.replace(_inner(field), F.lit('""'), F.lit("")).contains('"')
    return field.contains('"') & ~closed


def _value(field: Column) -> Column:
    return F.when(field.startswith('"'), F.replace(_inner(field), F.lit('""'), F.lit('"'))).otherwise(field)


def parse_cells(rows: DataFrame) -> DataFrame:
    """``rows(line_id, shard, line)`` with ``fields``, ``n_fields`` and ``bad_quotes``; null and blank lines are left out."""
    line = F.rtrim(F.col("line"), F.lit(BLANKS))
    raw = rows.select("line_id", "shard", line.alias("line")).filter("line <> ''").withColumn("raw", _fields(F.col("line")))
    return raw.select(
        "line_id", "shard", F.exists("raw", _badly_quoted).alias("bad_quotes"), F.size("raw").alias("n_fields"), F.transform("raw", _value).alias("fields")
    )


def _most_common(parsed: DataFrame, out: str, value: Column) -> DataFrame:
    """Of each shard, the commonest ``value`` over its well quoted two-field lines; ties give the smaller."""
    counted = parsed.filter("not bad_quotes and n_fields = 2").groupBy("shard", value.alias("v")).count()
    best = F.max(F.struct(F.col("count"), (-F.col("v")).alias("v")))
    return counted.groupBy("shard").agg((-best["v"]).alias(out))


def shard_shapes(results: DataFrame, rows: DataFrame) -> DataFrame:
    """``shard, k, bit_len`` of each shard of ``rows``, redelivered results counted once (the latest stands).

    Where ``bit_len`` or ``k`` is null, or the shard has no row at all, the length that most
    two-field lines of the shard have is taken; only lines of such shards are parsed for it.
    """
    last = F.max(F.struct("loaded_at", "k", "bit_len"))
    known = results.filter("shard is not null").groupBy("shard").agg(last.alias("s")).select("shard", "s.k", "s.bit_len")
    # as many rows as there are shards; used three times below
    partial = checkpointed(rows.select("shard").filter("shard is not null").distinct().join(known, "shard", "left"))
    open_ = partial.filter("k is null or bit_len is null").select("shard")
    lines = parse_cells(lookup_join(rows, open_, ["shard"], "left_semi"))
    guess = _most_common(lines, "k2", F.length(F.col("fields")[0])).join(
        _most_common(lines, "b2", F.length(F.col("fields")[1])), "shard"
    )
    return checkpointed(partial.join(guess, "shard", "left").select("shard", F.coalesce("k", "k2").alias("k"), F.coalesce("bit_len", "b2").alias("bit_len")))


def _fails(reason: Column) -> Column:
    """Whether the cell (col, value, k, bit_len, ...) breaks the rule named ``reason``."""
    value = F.col("value")
    letters = F.translate(value, "ACGTacgt", "")
    return (
        F.when(reason == "quoting", F.col("bad_quotes"))
        .when(reason == "columns", F.col("n_fields") != 2)
        .when(reason == "kmer", (F.length(value) != F.col("k")) | (letters != ""))
        .when(reason == "bit_len", F.length(value) != F.col("bit_len"))
        .when(reason == "bit_value", F.translate(value, "01", "") != "")
    )


def failures(parsed: DataFrame, shapes: DataFrame) -> DataFrame:
    """``line_id, reason``: the first rule each line breaks.

    Cells are exploded into (line, column, value) beside one pseudo cell -1 for
    the line as a whole, joined with the rule table, checked, and only broken
    rules are shuffled to their minimum per line. A line whose shard has no
    known length fails no length rule.
    """
    spark = parsed.sparkSession
    rules = spark.createDataFrame(RULES, "rule int, reason string, col int")
    shaped = lookup_join(parsed, shapes, ["shard"], "left")
    cells = shaped.select(
        "line_id", "bad_quotes", "n_fields", "k", "bit_len", F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.slice("fields", 1, 2))).alias("at", "value")
    ).withColumn("col", F.col("at") - 1)
    checked = cells.join(F.broadcast(rules), "col").filter(_fails(F.col("reason")))  # five rules, fixed
    return checked.groupBy("line_id").agg(F.min_by("reason", "rule").alias("reason"))


def split_parsed(rows: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw matrix lines as (clean rows, failures).

    ``rows`` needs ``line_id, shard, line``; ``results`` needs ``shard, k,
    bit_len, loaded_at``; further columns are ignored. Clean: ``line_id, shard,
    kmer, bit`` with the k-mer in upper case. Failures: ``line_id, reason``.

    Null and blank lines are in neither. A null ``line_id`` has no identity and is left out.
    A null shard has no lengths, so only ``quoting``, ``columns``, letters and bits are checked.
    Repeated ``line_id`` gives one failure; a clean line is kept as often as it comes.
    Empty tables give empty results.
    """
    given = rows.filter("line_id is not null").select("line_id", "shard", "line")
    parsed = parse_cells(given)
    bad = failures(parsed, shard_shapes(results, given))
    good = parsed.filter("not bad_quotes and n_fields = 2").join(bad.select("line_id"), "line_id", "left_anti")
    return good.select("line_id", "shard", F.upper(F.col("fields")[0]).alias("kmer"), F.col("fields")[1].alias("bit")), bad


def load_summary(rows: DataFrame, results: DataFrame) -> DataFrame:
    """``shard, clean, failed`` lines of each shard."""
    clean, bad = split_parsed(rows, results)
    marks = clean.select("shard", F.lit(1).alias("clean"), F.lit(0).alias("failed")).unionByName(
        bad.join(rows.select("line_id", "shard"), "line_id").select("shard", F.lit(0).alias("clean"), F.lit(1).alias("failed"))
    )
    return marks.groupBy("shard").agg(F.sum("clean").alias("clean"), F.sum("failed").alias("failed"))
