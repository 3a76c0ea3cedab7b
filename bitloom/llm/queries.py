"""Queries and oracle SQL of the training-data operators; parameters are those of production."""

from __future__ import annotations

from pyspark.sql import functions as F

from bitloom.llm import mojibake, packing, percentiles, sampling, splitting, tokenizer, top_n
from bitloom.plans.runtime import checkpointed, table


def p1_found(spark, d):
    return splitting.gap_cases(table(spark, d, "contigs"))


def p1_pieces(spark, d):
    return splitting.split_oversized(table(spark, d, "contigs"))


def p2_sample(spark, d):
    rows = table(spark, d, "kmer_rows")
    return sampling.uniform_sample(rows, 500, columns=["kmer", "bit"], row=sampling.delivered_row(rows))


def p2_properties(spark, d):
    """What holds of every sample: how many rows it has, and how many of them (and of its keys) are none of the table's or there twice."""
    rows = table(spark, d, "kmer_rows")
    got = checkpointed(sampling.keyed_sample(rows, 500, columns=["row_id", "shard", "kmer", "bit", "loaded_at"], row=sampling.delivered_row(rows)))  # 500 rows
    content = F.xxhash64("row_id", "shard", "kmer", "bit", "loaded_at").alias("c")
    strange = got.select(content).join(rows.join(F.broadcast(got.select(F.col("row_id").alias("drawn")).distinct()), F.col("row_id").eqNullSafe(F.col("drawn")), "left_semi").select(content), "c", "left_anti")
    return got.agg(F.count("*").alias("n"), (F.count("*") - F.countDistinct(sampling.KEY)).alias("twice")).crossJoin(F.broadcast(strange.agg(F.count("*").alias("strange"))))  # one row each


def p3_found(spark, d):
    return top_n.top_hits(table(spark, d, "hits")).select("contig_idx", "hit_id")


def p3_top_hits(spark, d):
    return top_n.top_hits(table(spark, d, "hits"))


def p5_percentiles(spark, d):
    return percentiles.trait_percentiles(table(spark, d, "pairs"))


def p5_day_summaries(spark, d):
    return percentiles.day_summaries(table(spark, d, "pairs"))


def _span(spark, d):
    kept = checkpointed(percentiles.day_summaries(table(spark, d, "pairs")))  # read for its ends, then for the span
    margin = "cast(least(10, floor(datediff(max(run_day), min(run_day)) / 2)) as int)"
    ends = kept.agg(F.expr(f"cast(date_add(min(run_day), {margin}) as string)"), F.expr(f"cast(date_sub(max(run_day), {margin}) as string)")).first()  # one row
    return percentiles.span_percentiles(kept, *ends), ends


def p5_span(spark, d):
    """The percentiles of all but the first and last ten days' worth of summaries (of fewer days the middle), out of what was kept per day."""
    return _span(spark, d)[0]


def p5_span_bound(spark, d):
    """``trait, measure, n, pct, within``: whether each percentile of the span has a rank within 0.5 % of the one asked for, by all values."""
    found, ends = _span(spark, d)
    errors = percentiles.rank_errors(found, table(spark, d, "pairs"), *ends)
    return errors.select("trait", "measure", "n", "pct", (F.col("error") <= 0.005).alias("within"))


def p6_ids(spark, d):
    return tokenizer.encode_documents(table(spark, d, "documents"))


def p6_decoded(spark, d):
    """``doc_id, text``: every document encoded and decoded again."""
    return tokenizer.decode_documents(tokenizer.encode_documents(table(spark, d, "documents")))


def p7_containers(spark, d):
    return packing.fill_with_documents(table(spark, d, "documents"))


def p7_fill(spark, d):
    return packing.container_fill(packing.fill_with_documents(table(spark, d, "documents")))


def p7_faults(spark, d):
    """What could be wrong with the containers: nothing is, and less than 1 % more of them are used than must be."""
    sized = checkpointed(tokenizer.count_tokens(table(spark, d, "documents")))
    out = packing.fill_faults(packing.fill_containers(sized), sized)
    return out.withColumn("spare", (F.col("spare") >= 0.01).cast("int"))


def p8_found(spark, d):
    return mojibake.mended_documents(table(spark, d, "documents")).select("doc_id")


def p8_repaired(spark, d):
    return mojibake.mended_documents(table(spark, d, "documents"))


def queries():
    named = [p1_found, p1_pieces, p2_sample, p2_properties, p3_found, p3_top_hits, p5_percentiles, p5_day_summaries, p5_span, p5_span_bound, p6_ids, p6_decoded, p7_containers, p7_fill, p7_faults, p8_found, p8_repaired]
    return {f.__name__: f for f in named}


_TOP = """
select contig_idx, hit_id, pos, pval, row_number() over (partition by contig_idx order by pval, pos, hit_id)::int as place
from (select distinct contig_idx, hit_id, pos, pval from hits
      where contig_idx >= 0 and pos >= 0 and pval >= 0 and pval <= 1 and not isnan(pval))
qualify place <= 5
"""

ORACLE = {
    "p1_found": r"""
with norm as (
  select contig_idx, loaded_at, regexp_replace(upper(regexp_replace(seq, '[ \t\n\v\f\r]', '', 'g')), '[^ACGT]', 'N', 'g') as s
  from contigs where contig_idx is not null and seq is not null),
last as (select contig_idx, s from norm qualify row_number() over (partition by contig_idx order by loaded_at desc) = 1),
long as (select * from last where length(s) > 10000),
runs as (
  select contig_idx, length(s) as n, unnest(regexp_extract_all(s, 'N+|[ACGT]+')) as run, generate_subscripts(regexp_extract_all(s, 'N+|[ACGT]+'), 1) as i from long),
placed as (
  select contig_idx, n, run, sum(length(run)) over (partition by contig_idx order by i) as upto from runs),
gaps as (
  select contig_idx, (upto - length(run))::bigint as gap_start, upto::bigint as gap_end from placed
  where run[1] = 'N' and length(run) >= 10 and upto < n and upto > length(run))
select * from gaps
union all select contig_idx, -1, -1 from long where contig_idx not in (select contig_idx from gaps)
""",
    "p1_pieces": r"""
with recursive norm as (
  select contig_idx, loaded_at, regexp_replace(upper(regexp_replace(seq, '[ \t\n\v\f\r]', '', 'g')), '[^ACGT]', 'N', 'g') as s
  from contigs where contig_idx is not null and seq is not null),
last as (select contig_idx, s from norm qualify row_number() over (partition by contig_idx order by loaded_at desc) = 1),
runs as (
  select contig_idx, length(s) as n, unnest(regexp_extract_all(s, 'N+|[ACGT]+')) as run, generate_subscripts(regexp_extract_all(s, 'N+|[ACGT]+'), 1) as i from last where length(s) > 10000),
placed as (select contig_idx, n, run, sum(length(run)) over (partition by contig_idx order by i) as upto from runs),
ends as (
  select contig_idx, list(upto::bigint) as ends from placed where run[1] = 'N' and length(run) >= 10 and upto < n and upto > length(run) group by 1),
kept as (select contig_idx, length(s)::bigint as n, coalesce(ends, []) as ends from last left join ends using (contig_idx) where s <> ''),
cut as (
  select contig_idx, n, ends, 0::bigint as a, case when n <= 10000 then n else coalesce(list_max(list_filter(ends, lambda e: e > 30 and e <= 10000)), 10000::bigint) end as b from kept
  union all
  select contig_idx, n, ends, b - 30, case when n - b <= 9970 then n else coalesce(list_max(list_filter(ends, lambda e: e > b and e <= b + 9970)), b + 9970) end from cut where b < n)
select contig_idx, a as start, b as "end", b = n or list_contains(ends, b) or s[b - 9:b] = 'NNNNNNNNNN' as in_gap, s[a + 1:b] as seq from cut join last using (contig_idx)
""",
    "p2_properties": "select least(count(*), 500) as n, 0::bigint as twice, 0::bigint as strange from kmer_rows",
    "p3_found": f"select contig_idx, hit_id from ({_TOP})",
    "p3_top_hits": _TOP,
    "p5_percentiles": """
with last as (select * from pairs qualify row_number() over (partition by trait, idx_a, idx_b order by written_at desc) = 1),
vals as (
  select trait, 'effect' as measure, effect + 0e0 as value from last union all select trait, 'pval', pval + 0e0 from last),
ranked as (
  select *, row_number() over (partition by trait, measure order by value) - 1 as r, count(*) over (partition by trait, measure) as n
  from vals where value is not null and isfinite(value)),
pcts as (select unnest([1, 5, 25, 50, 75, 95, 99])::double as pct),
near as (
  select trait, measure, n, pct, pct / 100 * (n - 1) as at_, min(value) as low, max(value) as high
  from ranked, pcts where r = floor(pct / 100 * (n - 1)) or r = ceil(pct / 100 * (n - 1)) group by all)
select trait, measure, n, pct, low + (high - low) * (at_ - floor(at_)) as value from near
""",
    "p5_span_bound": """
with last as (select * from pairs qualify row_number() over (partition by trait, idx_a, idx_b order by written_at desc) = 1),
vals as (select trait, run_day, 'effect' as measure, effect as value from last union all select trait, run_day, 'pval', pval from last),
ok as (select * from vals where value is not null and isfinite(value)),
ends as (select min(run_day) as a, max(run_day) as b, least(10, (max(run_day) - min(run_day)) // 2)::int as m from ok)
select trait, measure, count(*) as n, pct, true as within
from ok, ends, (select unnest([1, 5, 25, 50, 75, 95, 99])::double as pct) where run_day between a + m and b - m group by trait, measure, pct
""",
    "p7_faults": "select count(*) as items, 0::bigint as overfull, 0::bigint as missing, 0::bigint as twice, 0::bigint as split, 0::bigint as wrong_size, 0::int as spare from documents",
    "p6_decoded": "select doc_id, coalesce(text, '') as text from documents",
}


def oracle_sql():
    return dict(ORACLE)
