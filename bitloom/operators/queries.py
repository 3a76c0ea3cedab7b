"""Queries and oracle SQL of the core operators.

Cut-offs are those at which the given tables have hits; all else is as in production.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from bitloom.functions.kmers import canonical, decoded, encoded, index_shard, reverse_complement
from bitloom.operators import features, mapping, parse_failures, report, scan1d, structure, twoway
from bitloom.operators import pairs2d as _pairs2d
from bitloom.plans.runtime import checkpointed, scratch, table
from bitloom.streaming import scan as streaming

K, BITS = 31, 96
MIN_CORR, LOG10_P, LOG10_P_2D = 0.2, 2.0, 3.0
WINDOW, DENSITY = 200, 0.03
LONG_K = 51  #: k of the mapping by default
HOSTS, PATHOGENS = 91, 5  #: all samples, the first ones as hosts
CELL, BAND = 200_000, 24
QUOTAS, POINTS = 25_000, 2000


def _rows(spark, d):
    return features.valid_rows(table(spark, d, "kmer_rows"), K, BITS)


def _unique(spark, d):
    return features.unique_rows(table(spark, d, "kmer_rows"), K, BITS)


def _design(spark, d, grouped=False):
    samples = table(spark, d, "samples")
    groups = {r.sample_id: r.ord // BAND for r in samples.collect()} if grouped else None  # the sample axis
    return features.design(samples, table(spark, d, "phenotype"), groups=groups)


def _hits(spark, d):
    return scan1d.scan(_rows(spark, d), _design(spark, d), MIN_CORR, LOG10_P)


def _mapped_hits(spark, d):
    """Hits with a place, each once: ``contig_idx, pos, effect, p``."""
    given = table(spark, d, "hits")
    ok = given.filter("contig_idx >= 0 and pos >= 0 and pval >= 0 and pval <= 1 and not isnan(pval) and not isnan(effect)")
    return features.latest_rows(ok, ["hit_id"], "loaded_at", ["contig_idx", "pos", "effect", "pval"], given).withColumnRenamed("pval", "p")


def _ref(spark, d):
    return mapping.written_reference(table(spark, d, "contigs"))


def _index(spark, d, ref, k=K):
    """The index of the k-mers that stand where hits are."""
    return mapping.build_index(mapping.kmers_at(ref, _mapped_hits(spark, d), k), k)


def _genome_hits(spark, d):
    return mapping.to_genome(_mapped_hits(spark, d), mapping.contig_offsets(table(spark, d, "contigs")))


def _pairs(spark, d):
    given = table(spark, d, "pairs")
    pairs = features.latest_rows(given, ["trait", "idx_a", "idx_b"], "written_at", ["effect", "pval"])
    return pairs.filter("pval >= 0 and not isnan(pval) and effect is not null and not isnan(effect) and abs(effect) < 1e300").withColumnRenamed("pval", "p")


def _genome_pairs(spark, d):
    """Pairs placed on the genome: the k-th hit of the reference stands for the k-th feature (``pos_a, pos_b, effect, p``)."""
    given = table(spark, d, "hits")
    hits = features.latest_rows(given.filter("contig_idx >= 0 and pos >= 0"), ["hit_id"], "loaded_at", ["contig_idx", "pos"], given)
    at = mapping.to_genome(hits, mapping.contig_offsets(table(spark, d, "contigs")))
    return checkpointed(mapping.map_pairs(_pairs(spark, d), at.select(F.col("hit_id").alias("idx"), "pos")))  # read more than once


def p4_found(spark, d):
    return parse_failures.split_parsed(table(spark, d, "raw_rows"), table(spark, d, "load_results"))[1]


def p4_clean(spark, d):
    return parse_failures.split_parsed(table(spark, d, "raw_rows"), table(spark, d, "load_results"))[0]


def overlap(spark, d):
    return features.overlap(table(spark, d, "samples"), table(spark, d, "phenotype"))


def kmer_freq(spark, d):
    return features.allele_frequencies(_unique(spark, d), _design(spark, d)).select("row_id", "ones", F.round("freq", 9).alias("freq"))


def maf_filter(spark, d):
    return features.maf_filter(_unique(spark, d), _design(spark, d)).select("row_id", F.round("maf", 9).alias("maf"))


def bitstring_subset(spark, d):
    return _unique(spark, d).select("row_id", features.subset_bits(F.col("bit"), _design(spark, d).pieces()).alias("bits"))


def bitstring_build(spark, d):
    rows = _unique(spark, d)
    return features.bit_strings(features.presence(rows), BITS, rows)


def shard_quota_sample(spark, d):
    return features.shard_samples(_unique(spark, d), QUOTAS).select("shard", "row_id")


def sample_statistics(spark, d):
    return features.sample_statistics(_unique(spark, d), QUOTAS)


def contig_header_lengths(spark, d):
    return report.header_lengths(table(spark, d, "contigs"))


def subsample_truncate(spark, d):
    return features.subsample(_unique(spark, d), 500).select("row_id")


def matrix_sorted(spark, d):
    """``row_id, batch, place``: rows of all batches in order of (bit, k-mer)."""
    return features.sorted_places(_unique(spark, d)).select("row_id", "batch", "place")


def matrix_batches(spark, d):
    return features.batched(_unique(spark, d)).select("row_id", "batch")


def corr_prefilter(spark, d):
    got = scan1d.tested_rows(_rows(spark, d), _design(spark, d), MIN_CORR)
    return features.latest(got, ["row_id"], "loaded_at", ["r"]).select("row_id", F.round("r", 9).alias("r"))


def _scanned(got):
    # many values end in a 5 after few digits; the small shift keeps both engines from rounding those differently
    once = features.latest(got, ["row_id"], "loaded_at", ["ones", "effect", "beta", "r2", "t"])
    return once.select("row_id", "ones", *((F.round(F.col(c) + F.lit(3e-9), 6) + F.lit(0.0)).alias(c) for c in ("effect", "beta", "r2", "t")))


def scan1d_intercept(spark, d):
    return _scanned(scan1d.tested_rows(_rows(spark, d), _design(spark, d), 0.0))


def scan1d_group_covariates(spark, d):
    return _scanned(scan1d.tested_rows(_rows(spark, d), _design(spark, d, True), 0.0))


def hits_1d(spark, d):
    return _hits(spark, d).select("row_id", "kmer", F.round("t", 9).alias("t"), F.round(-F.log10("p"), 9).alias("log10p"))


def candidates_2d(spark, d):
    got = scan1d.candidates(_rows(spark, d), _design(spark, d), MIN_CORR, LOG10_P, LOG10_P_2D)
    return got.select("row_id", "kmer", "bit", F.round("t", 9).alias("t"))


def tested_counts(spark, d):
    return scan1d.tested_counts(_rows(spark, d), _design(spark, d), MIN_CORR)


def bonferroni(spark, d):
    return report.bonferroni(tested_counts(spark, d)).select("tested", F.round("threshold", 9).alias("threshold"))


def gram_matrix(spark, d):
    return structure.gram(_unique(spark, d), _design(spark, d).ords)


def _bases(spark, d):
    des = _design(spark, d)
    common = features.maf_filter(_unique(spark, d), des)
    return des, structure.covariate_bases(common, des)


def pca_basis(spark, d):
    """The projector of the single-feature basis, which unlike the basis is unique: ``sample_id, component, value``."""
    des, (u, _) = _bases(spark, d)
    return structure.basis_table(spark, des, np.round(u @ u.T, 6))


def basis_properties(spark, d):
    """What holds of both bases for certain: ``basis, samples, trace, constant, idempotent, invariant``.

    Their projectors leave the constant alone and repeat nothing; what the first
    spans beyond it is carried into itself by the centred Gram matrix of the common features.
    """
    des = _design(spark, d)
    common = checkpointed(features.maf_filter(_unique(spark, d), des))
    g = structure.centred(structure.gram_matrix(common, des.ords))
    out = []
    for name, u in zip(("single", "pair"), structure.covariate_bases(common, des)):
        p = u @ u.T
        rest = g @ p - p @ g @ p
        invariant = float(np.abs(rest).max() < 1e-6 * np.abs(g).max()) if name == "single" else None
        out.append((name, des.n, round(float(np.trace(p)), 6), round(float(np.abs(p.sum(1) - 1).max()), 6), round(float(np.abs(p @ p - p).max()), 6), invariant))
    return spark.createDataFrame(out, "basis string, samples bigint, trace double, constant double, idempotent double, invariant double")


def pair_basis(spark, d):
    des, (_, u) = _bases(spark, d)
    return structure.basis_table(spark, des, np.round(u @ u.T, 6))


def scan1d_pca(spark, d):
    """The scan adjusted for principal components of the whole matrix."""
    des, (u, _) = _bases(spark, d)
    adjusted = features.Design(des.ords, des.y, u, des.sample_ids)
    return scan1d.scan(_rows(spark, d), adjusted, MIN_CORR, LOG10_P).select("row_id", "kmer", "effect", "p")


def kmer_canonical(spark, d):
    k = _unique(spark, d)
    canon = canonical(F.col("kmer"))
    return k.select("row_id", reverse_complement(F.col("kmer")).alias("rc"), canon.alias("canon"), encoded(canon).alias("code"), decoded(encoded(canon), K).alias("again"), index_shard(canon, 16).alias("shard"))


def index_build(spark, d):
    return _index(spark, d, _ref(spark, d)).select("canon", "effect", "p", "shard")


def contig_offsets(spark, d):
    return mapping.contig_offsets(table(spark, d, "contigs"))


def reference_kmer_counts(spark, d):
    """``contig_idx, windows, kmers``: windows without N of each contig, and how many different canonical k-mers."""
    keys = mapping.reference_keys(mapping.reference(table(spark, d, "contigs")), K)
    once = keys.groupBy("contig_idx", "key").agg(F.count("*").alias("n"))
    return once.groupBy("contig_idx").agg(F.sum("n").alias("windows"), F.count("*").alias("kmers"))


def map_hits(spark, d):
    ref = _ref(spark, d)
    return mapping.map_hits(ref, _index(spark, d, ref), K).select("contig_idx", "pos", "effect", "p")


def map_dual(spark, d):
    ref = _ref(spark, d)
    return mapping.map_dual(ref, mapping.kmers_at(ref, _mapped_hits(spark, d), K), K).select("contig_idx", "pos", "effect", "p")


def density_filter(spark, d):
    places = _mapped_hits(spark, d).select("contig_idx", "pos").distinct()
    return mapping.density_filter(places, WINDOW, DENSITY)


def map_merge_filter(spark, d):
    """The flagship: hits of the index on the reference, density filtered, in genome-wide positions."""
    ref = _ref(spark, d)
    return mapping.map_merge_filter(ref, _index(spark, d, ref), K, WINDOW, DENSITY)


def map_merge_filter_51(spark, d):
    """The same with k-mers of two words."""
    ref = _ref(spark, d)
    return mapping.map_merge_filter(ref, _index(spark, d, ref, LONG_K), LONG_K, WINDOW, DENSITY)


def pair_scan_input(spark, d):
    """Index entries mapped with a bit string: that of the hit, where it has one."""
    ref, given = _ref(spark, d), table(spark, d, "hits")
    with_bits = given.filter("bitstring is not null and contig_idx >= 0 and pos >= 0 and pval >= 0 and pval <= 1 and not isnan(pval) and not isnan(effect)")
    once = features.latest_rows(with_bits, ["hit_id"], "loaded_at", ["contig_idx", "pos", "effect", "pval", "bitstring"], given).withColumnRenamed("pval", "p").withColumnRenamed("bitstring", "bit")
    found = checkpointed(mapping.kmers_at(ref, once, K))
    return mapping.pair_scan_input(ref, mapping.build_index(found, K), found, K)


def _candidates(spark, d):
    return scan1d.candidates(_rows(spark, d), _design(spark, d), MIN_CORR, LOG10_P, LOG10_P)


def _pair_features(spark, d):
    return _candidates(spark, d).select(F.col("row_id").alias("idx"), "bit")


def _pair_scan(spark, d, grouped):
    out = _pairs2d.scan_class_pairs(_pair_features(spark, d), _design(spark, d, grouped), 4.0)[0]
    return out.select("rep_a", "rep_b", (F.round(F.col("effect") + F.lit(3e-9), 6) + F.lit(0.0)).alias("effect"), F.round("r2", 9).alias("r2"), F.round("t", 9).alias("t"), F.round(-F.log10("p"), 9).alias("log10p"))


def pairs2d(spark, d):
    """Significant pairs between classes of candidates that look the same (``pairs2d_classes`` has their members)."""
    return _pair_scan(spark, d, False)


def pairs2d_group_covariates(spark, d):
    return _pair_scan(spark, d, True)


def pairs2d_classes(spark, d):
    return _pairs2d.pattern_classes(_pair_features(spark, d), _design(spark, d))


def pairs2d_cooccurrence(spark, d):
    """Classes of candidates that more than a third of the samples have together."""
    des, found = _design(spark, d), _pair_features(spark, d)
    reps = _pairs2d.pattern_classes(found, des).select(F.col("rep").alias("idx")).distinct()
    return _pairs2d.co_occurrence(found.join(reps, "idx", "left_semi"), des, des.n // 3)


def pair_dictionary(spark, d):
    return _pairs2d.renumbered(_candidates(spark, d), K)


def pattern_classes(spark, d):
    return _pairs2d.pattern_classes(_unique(spark, d).select(F.col("row_id").alias("idx"), "bit"), _design(spark, d))


def kmer_first_pos(spark, d):
    """The first place of the k-mer of every index entry; entries are named by their k-mer."""
    ref = _ref(spark, d)
    index = _index(spark, d, ref).select(F.col("canon").alias("idx"), F.col("canon").alias("kmer"))
    return mapping.first_positions(ref, index, K).withColumnRenamed("idx", "canon")


def map_2d_pairs(spark, d):
    return _genome_pairs(spark, d).select("pos_a", "pos_b", "effect", "p")


def _grid(spark, d):
    """A complete grid of hosts and pathogens: the mean price of the line items dealt to each cell by their part and supplier, 0 where there are none."""
    cell = [F.pmod("l_partkey", F.lit(HOSTS)).cast("int").alias("h"), F.pmod("l_suppkey", F.lit(PATHOGENS)).cast("int").alias("p")]
    sums = table(spark, d, "lineitem").groupBy(*cell).agg((F.avg("l_extendedprice") / 1e4).alias("y"))
    every = spark.range(HOSTS * PATHOGENS).select((F.col("id") % HOSTS).cast("int").alias("h"), F.floor(F.col("id") / HOSTS).cast("int").alias("p"))
    return every.join(F.broadcast(sums), ["h", "p"], "left").select("h", "p", F.coalesce("y", F.lit(0.0)).alias("y"))  # a row per cell


def twoway_grid_sums(spark, d):
    g = _grid(spark, d)
    return g.groupBy("h").agg(F.round(F.sum("y"), 6).alias("y"), F.count("*").alias("cells"))


def _labelled(spark, d):
    rows = _unique(spark, d)
    parts = ((1, HOSTS), (HOSTS + 1, PATHOGENS))
    return [rows.select(F.col("row_id").alias("label"), F.substring("bit", *p).alias("bit")) for p in parts]


def _sides(spark, d):
    return [twoway.classes(x) for x in _labelled(spark, d)]


def _states(out):
    """Ratios and what follows from them, where they are numbers; ``state`` tells infinite and undefined ones apart."""
    state = F.when(F.isnan("ratio"), "undefined").when(F.col("ratio") == float("inf"), "infinite").otherwise("finite")
    tell = lambda c: F.when(F.col("state") == "finite", F.round(c, 6)).alias(c)
    return out.withColumn("state", state).select("a", "b", "state", tell("ratio"), tell("lrt"), F.when(F.col("state") != "undefined", F.round("p", 6)).alias("p"))


def twoway_interaction(spark, d):
    """Pairs of patterns with p <= 0.05, and those of a constant feature, whose ratio is infinite."""
    return _states(twoway.scan_twoway(*_sides(spark, d), twoway.grid(_grid(spark, d), HOSTS, PATHOGENS, center_y=True), interaction_only=True, log10_p=float(-np.log10(0.05))))


def twoway_joint(spark, d):
    """All pairs of patterns."""
    return _states(twoway.scan_twoway(*_sides(spark, d), twoway.grid(_grid(spark, d), HOSTS, PATHOGENS, center_y=True)))


def twoway_classes(spark, d):
    """``bit, label, members`` of the host patterns, which stand for all features that look the same."""
    return _sides(spark, d)[0]


def twoway_members(spark, d):
    """``side, label, rep``: the features behind the labels of either side."""
    host, path = (twoway.members(x) for x in _labelled(spark, d))
    return host.select(F.lit("host").alias("side"), "label", "rep").unionByName(path.select(F.lit("pathogen").alias("side"), "label", "rep"))


def twoway_pca_joint(spark, d):
    """The joint test adjusted for two components of the hosts and one of the pathogens, out of all features; pairs with p <= 0.05."""
    rows = _unique(spark, d)
    u = twoway.components(structure.gram_matrix(rows, np.arange(HOSTS)), 2, HOSTS)
    v = twoway.components(structure.gram_matrix(rows, np.arange(HOSTS, HOSTS + PATHOGENS)), 1, PATHOGENS)
    grid = twoway.grid(_grid(spark, d), HOSTS, PATHOGENS, u, v, center_y=True)
    return twoway.scan_twoway(*_sides(spark, d), grid, log10_p=float(-np.log10(0.05))).select("a", "b", "lrt", "p")


def effect_percentile_filter(spark, d):
    return report.effect_cut(_genome_pairs(spark, d), 90).select("pos_a", "pos_b", "effect")


def grid_density_bins(spark, d):
    return report.cell_counts(_genome_pairs(spark, d), CELL)


def grid_dense_cells(spark, d):
    return report.dense_cells(_genome_pairs(spark, d), CELL, 90)


def grid_cell_max(spark, d):
    out = report.cell_peaks(_genome_pairs(spark, d), CELL, 50)
    return out.select("cx", "cy", "x", "y", (F.round("log10p", 9) + F.lit(0.0)).alias("log10p"), "effect")


def region_cells(spark, d):
    """Cells of the middle half of the genome by its first half, from the corner of that region, in 500 steps."""
    size = mapping.contig_offsets(table(spark, d, "contigs")).agg(F.max(F.col("start") + F.col("len"))).first()[0] or 0  # one row
    first, second = (size // 4, size // 4 * 3), (0, size // 2)
    chosen = report.region(_genome_pairs(spark, d), first, second)
    return report.cell_counts(chosen, report.bin_width(first, second, 500), (first[0], second[0]))


def marginal_sample(spark, d):
    return report.marginal_sample(_genome_hits(spark, d), POINTS, columns=("hit_id", "pos")).select("hit_id", "pos", "effect", "p")


def marker_sizes(spark, d):
    out = report.marker_sizes(report.cell_counts(_genome_pairs(spark, d), CELL), "n")
    return out.select("cx", "cy", F.round("size", 6).alias("size"))


def pos_to_contig(spark, d):
    offsets = mapping.contig_offsets(table(spark, d, "contigs"))
    return report.locate(_genome_hits(spark, d).select("hit_id", "pos"), offsets)


def chrom_bands(spark, d):
    return report.chromosome_bands(mapping.contig_offsets(table(spark, d, "contigs")))


def filter_merge(spark, d):
    return report.under(_genome_hits(spark, d), 1e-9).select("hit_id", "pos", "effect", "p")


def union_parts(spark, d):
    """Counts of both halves of the shards, merged."""
    rows, des = _rows(spark, d), _design(spark, d)
    first = F.pmod(F.xxhash64("shard"), F.lit(2)) == 0
    return report.merged_counts([scan1d.tested_counts(rows.filter(c), des, MIN_CORR) for c in (first, ~first)])


def manhattan_points(spark, d):
    out = report.manhattan_points(_genome_hits(spark, d))
    return out.select("pos", F.col("sign").cast("int").alias("sign"), (F.round("log10p", 9) + F.lit(0.0)).alias("log10p"))


def stream_hits_1d(spark, d):
    """The scan as a stream over the files of the matrix, run to its end into the shared folder."""
    out = scratch(spark, "stream")
    stream = streaming.row_stream(spark, f"{d}/kmer_rows.parque[t]")
    hits = streaming.stream_hits(stream, _design(spark, d), K, BITS, MIN_CORR, LOG10_P)
    run = hits.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch(spark, "state")).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(hits.schema).parquet(out).select("row_id", F.round("t", 9).alias("t"))


def stream_counts(spark, d):
    """Tests by shard as a stream; rows count as often as they are delivered."""
    out = scratch(spark, "stream")
    counts = streaming.stream_counts(streaming.row_stream(spark, f"{d}/kmer_rows.parque[t]"), _design(spark, d), K, BITS, MIN_CORR)
    run = counts.writeStream.outputMode("complete").foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out)).option("checkpointLocation", scratch(spark, "state")).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)


def queries():
    named = [
        p4_found, p4_clean, overlap, kmer_freq, maf_filter, bitstring_subset, bitstring_build, shard_quota_sample, sample_statistics, subsample_truncate,
        matrix_batches, matrix_sorted, corr_prefilter, scan1d_intercept, scan1d_group_covariates, hits_1d, candidates_2d, tested_counts, bonferroni, gram_matrix,
        pca_basis, pair_basis, basis_properties, scan1d_pca, kmer_canonical, index_build, contig_offsets, contig_header_lengths, reference_kmer_counts, map_hits, map_dual, density_filter,
        map_merge_filter, map_merge_filter_51, pair_scan_input, pairs2d, pairs2d_group_covariates, pairs2d_classes, pairs2d_cooccurrence, pair_dictionary, pattern_classes, kmer_first_pos, map_2d_pairs,
        twoway_grid_sums, twoway_classes, twoway_members, twoway_interaction, twoway_joint, twoway_pca_joint, effect_percentile_filter, grid_density_bins, grid_dense_cells, grid_cell_max,
        region_cells, marginal_sample, marker_sizes, pos_to_contig, chrom_bands, filter_merge, union_parts, manhattan_points, stream_hits_1d, stream_counts,
    ]
    return {f.__name__: f for f in named}


_PARSED = r"""
with lines as (
  select line_id, shard, rtrim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line from raw_rows),
cut as (
  select line_id, shard, line,
    case when contains(line, chr(9)) then '^("([^"]|"")*"|[^"\t]*)(\t("([^"]|"")*"|[^"\t]*))*$' else '^("([^"]|"")*"|[^" ]*)( ("([^"]|"")*"|[^" ]*))*$' end as good,
    case when contains(line, chr(9)) then '("(?:[^"]|"")*"|[^"\t]*)\t' else '("(?:[^"]|"")*"|[^" ]*) ' end as field,
    line || case when contains(line, chr(9)) then chr(9) else ' ' end as closed
  from lines where line <> ''),
fields as (
  select line_id, shard, not regexp_matches(line, good) as bad_quotes,
    list_transform(regexp_extract_all(closed, field, 1), lambda f: case when f[1] = '"' then replace(f[2:-2], '""', '"') else f end) as f
  from cut),
known as (
  select shard, k, bit_len from load_results qualify row_number() over (partition by shard order by loaded_at desc) = 1),
counted as (
  select shard, length(f[2]) as b, count(*) as c from fields where not bad_quotes and len(f) = 2 group by 1, 2),
usual as (select shard, b from counted qualify row_number() over (partition by shard order by c desc, b) = 1),
shapes as (select known.shard, k, coalesce(bit_len, b) as bit_len from known left join usual using (shard)),
judged as (
  select line_id, shard, f, case
    when bad_quotes then 'quoting' when len(f) <> 2 then 'columns'
    when length(f[1]) <> k or not regexp_full_match(f[1], '[ACGTacgt]*') then 'kmer'
    when length(f[2]) <> bit_len then 'bit_len'
    when not regexp_full_match(f[2], '[01]*') then 'bit_value' end as reason
  from fields left join shapes using (shard))
"""


# NaN is told by its text: range filters on a column whose statistics leave NaN out would be dropped.
_ROWS = r"""
ph as (
  select sample_id, y from phenotype where sample_id is not null and y is not null and y::varchar <> 'nan'
  qualify row_number() over (partition by sample_id order by line_no desc) = 1),
ov as (select row_number() over (order by ord) - 1 as j, ord, sample_id, y, ord // 24 as g from samples join ph using (sample_id)),
rws as (
  select row_id, shard, upper(kmer) as kmer, bit from kmer_rows
  where length(kmer) = 31 and regexp_full_match(kmer, '[ACGTacgt]*') and length(bit) = 96 and regexp_full_match(bit, '[01]*')
  qualify row_number() over (partition by row_id order by loaded_at desc) = 1),
cells as (select row_id, j, ord, y, g, case when bit[ord + 1] = '1' then 1 else 0 end as x from rws, ov),
"""


def _scan(group: str) -> str:
    return _ROWS + f"""
ng as (select {group} as g, count(*) as ng, sum(y) as gy from ov group by 1),
pop as (select count(*) as n, avg(y) as my, sum(y * y) as y2, sum(y * y) - count(*) * avg(y) * avg(y) as syy from ov),
uy as (select sum(gy * gy / ng) as uy2 from ng),
per as (select row_id, {group} as g, sum(x) as c, sum(x * y) as sy from cells group by 1, 2),
sums as (
  select row_id, sum(c) as a, sum(sy) as sy, sum(c * c / ng) as su2, sum(c * gy / ng) as suy
  from per join ng using (g) group by 1),
stat as (
  select row_id, a::int as ones, n, (sy - a * my) / sqrt((a - a * a / n) * syy) as r,
    sy - suy as xy, a - su2 as xx, y2 - uy2 as yy
  from sums, pop, uy where a > 0 and a < n),
res as (
  select row_id, ones, r, case when xx > 1e-12 then xy / (xx * yy) else 0 end as effect, case when xx > 1e-12 then xy / xx else 0 end as beta,
    case when xx > 1e-12 then least(xy * xy / (xx * yy), 1 - 1e-15) else 0 end as r2, n from stat),
scanned as (select *, -n * ln(1 - r2) as t from res),
"""


_ONE, _GROUPED = _scan("0"), _scan("g")


def _tail(x: str) -> str:
    """erfc of an SQL expression x >= 0 by a power series up to 2 and a continued fraction beyond; nothing of the library is in it."""
    series = "1e0"
    for i in range(45, 0, -1):
        series = f"(1e0+2e0*z*z/{2 * i + 1}e0*{series})"
    fraction = "z"
    for i in range(70, 0, -1):
        fraction = f"(z+{i / 2}e0/{fraction})"
    root = "sqrt(pi())"
    near = f"1e0-2e0*z/{root}*exp(-z*z)*{series}"
    return f"list_transform([{x}], lambda z: case when z < 2e0 then {near} else exp(-z*z)/{root}/{fraction} end)[1]"


_P = _tail("sqrt(t/2e0)")
_NEAR = "where abs(r) >= 0.2"

_CONTIGS = r"""
seqs as (
  select contig_idx, name, regexp_replace(upper(regexp_replace(seq, '[ \t\n\v\f\r]', '', 'g')), '[^ACGT]', 'N', 'g') as seq, loaded_at
  from contigs where contig_idx is not null
  qualify row_number() over (partition by contig_idx order by (seq is not null) desc, loaded_at desc) = 1),
offs as (
  select contig_idx, name, coalesce(length(seq), 0)::bigint as len,
    coalesce(sum(length(seq)) over (order by contig_idx rows between unbounded preceding and 1 preceding), 0)::bigint as start from seqs),
good as (
  select hit_id, contig_idx, pos, effect, pval as p, bitstring from hits
  where contig_idx >= 0 and pos >= 0 and pval >= 0 and pval <= 1  and effect::varchar <> 'nan'
  qualify row_number() over (partition by hit_id order by loaded_at desc) = 1),
placed as (select hit_id, contig_idx, pos, pos + start as gpos, effect, p from good join offs using (contig_idx)),
"""

def _kmers(k: int) -> str:
    return _CONTIGS + f"""
cut as (
  select contig_idx, off, substring(seq, off + 1, {1000 + k - 1}) as part
  from (select contig_idx, seq, unnest(range(0, length(seq) - {k - 1}, 1000)) as off from seqs where length(seq) >= {k})),
wins as (
  select contig_idx, off + i - 1 as pos, substring(part, i, {k}) as kmer
  from (select contig_idx, off, part, unnest(range(1, length(part) - {k - 1} + 1)) as i from cut)),
refk as (
  select contig_idx, pos::bigint as pos, kmer, least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) as canon from wins where not contains(kmer, 'N')),
hitk as (select good.*, kmer, canon from good join refk using (contig_idx, pos)),
idx as (
  select canon, effect, p from hitk qualify row_number() over (partition by canon order by p, effect) = 1),
"""


_KMERS = _kmers(31)

_DENSE = """
counted as (
  select *, count(*) over (partition by contig_idx order by pos range between current row and 199 following) as n from {src}),
kept as (
  select * from (
    select *, coalesce(max(case when n >= 6 then pos + 199 end) over (partition by contig_idx order by pos rows between unbounded preceding and current row), 0) as upto from counted)
  where pos <= upto),
"""

_PAIRS = _CONTIGS + """
spots as (
  select hit_id as idx, pos + start as pos from (
    select hit_id, contig_idx, pos from hits where contig_idx >= 0 and pos >= 0 qualify row_number() over (partition by hit_id order by loaded_at desc) = 1)
  join offs using (contig_idx)),
last as (
  select idx_a, idx_b, effect, pval as p from pairs qualify row_number() over (partition by trait, idx_a, idx_b order by written_at desc) = 1),
gp as (
  select least(a.pos, b.pos) as pos_a, greatest(a.pos, b.pos) as pos_b, effect, p
  from last join spots a on a.idx = idx_a join spots b on b.idx = idx_b
  where p >= 0 and p::varchar <> 'nan' and effect is not null and effect::varchar not in ('nan', 'inf', '-inf')),
cell as (select *, pos_a // 200000 as cx, pos_b // 200000 as cy from gp),
counts as (select cx, cy, count(*) as n from cell group by 1, 2),
"""

_GRID = """
grid as (
  select h, p, coalesce(y, 0) as y from (select unnest(range(91)) as h) cross join (select unnest(range(5)) as p)
  left join (select l_partkey % 91 as h, l_suppkey % 5 as p, avg(l_extendedprice) / 1e4 as y from lineitem group by 1, 2) using (h, p)),
"""

_TWO = _ROWS + _GRID.replace("grid as", "cells_of as") + """
grid as (select h, p, y - avg(y) over () as y from cells_of),
hb as (select substring(bit, 1, 91) as bit, min(row_id) as label, count(*) as members from rws group by 1),
pb as (select substring(bit, 92, 5) as bit, min(row_id) as label, count(*) as members from rws group by 1),
hx as (select label, h, case when bit[h + 1] = '1' then 1 else 0 end - length(replace(bit, '0', '')) / 91e0 as v from hb, (select unnest(range(91)) as h)),
px as (select label, p, case when bit[p + 1] = '1' then 1 else 0 end - length(replace(bit, '0', '')) / 5e0 as v from pb, (select unnest(range(5)) as p)),
flat as (select label from hb where not (contains(bit, '0') and contains(bit, '1'))),
plat as (select label from pb where not (contains(bit, '0') and contains(bit, '1'))),
rss as (select sum(y * y) as rss0 from grid),
hy as (select label, p, sum(v * y) as w from hx join grid using (h) group by 1, 2),
hn as (select label, sum(v * v) as q from hx group by 1),
pn as (select label, sum(v * v) as q from px group by 1),
hs as (select label, sum(v * y) as s from hx join grid using (h) group by 1),
ps as (select label, sum(v * y) as s from px join grid using (p) group by 1),
si as (select hy.label as a, px.label as b, sum(hy.w * px.v) as s from hy join px using (p) group by 1, 2),
known as (select a, b, s, flat.label is not null or plat.label is not null as degenerate from si left join flat on flat.label = a left join plat on plat.label = b),
duo as (
  select a, b, degenerate, case when degenerate then 0 else k.s * k.s / (hn.q * pn.q) end as d1,
    case when degenerate then 0 else hs.s * hs.s / (5 * hn.q) + ps.s * ps.s / (91 * pn.q) end as d2, rss0
  from known k join hn on hn.label = a join pn on pn.label = b join hs on hs.label = a join ps on ps.label = b, rss),
one as (select a, b, degenerate, rss0 / (rss0 - d1) as ratio, 455 * ln(rss0 / (rss0 - d1)) as t from duo),
three as (select a, b, degenerate, rss0 / (rss0 - d1 - d2) as ratio, 455 * ln(rss0 / (rss0 - d1 - d2)) as t from duo),
"""

_CANDIDATES = _ONE + f"""
cand as (select row_id, {_P} as p from scanned {_NEAR}),
looks as (select row_id, string_agg(x::varchar, '' order by j) as bits from cells join cand using (row_id) where p <= 0.01 group by 1),
"""


def _pair_sql(group: str) -> str:
    """Pairs of classes: products of sums over groups of samples, each with an indicator as covariate."""
    return "with " + _CANDIDATES + f"""
reps as (select min(row_id) as row_id, count(*) as members from looks group by bits),
cc as (select row_id, members, j, y, {group} as g from cells join reps using (row_id) where x = 1),
gs as (select {group} as g, count(*) as ng, sum(y) as gy from ov group by 1),
uy2 as (select sum(gy * gy / ng) as uy2 from gs),
own as (
  select row_id from (select row_id, g, count(*) as c from cc group by 1, 2) join gs using (g) group by 1 having sum(c) - sum(c * c / ng) > 1e-12),
pg as (
  select a.row_id as rep_a, b.row_id as rep_b, a.g, count(*) as c, sum(a.y) as sy
  from cc a join cc b on a.j = b.j and (a.row_id < b.row_id or a.row_id = b.row_id and a.members > 1) group by 1, 2, 3),
s2 as (
  select rep_a, rep_b, sum(sy) - sum(c * gy / ng) as xy, sum(c) - sum(c * c / ng) as xx from pg join gs using (g) group by 1, 2),
r as (
  select rep_a, rep_b, xy / (xx * (y2 - uy2)) as effect, least(xy * xy / (xx * (y2 - uy2)), 1 - 1e-15) as r2, n
  from s2, pop, uy2 where xx > 1e-12 and rep_a in (select row_id from own) and rep_b in (select row_id from own)),
f as (select *, -n * ln(1 - r2) as t from r),
q as (select *, {_P} as p from f)
select rep_a, rep_b, round(effect + 3e-9, 6) + 0e0 as effect, round(r2, 9) as r2, round(t, 9) as t, round(-log10(p), 9) as log10p from q where p <= 0.0001"""


def _every_row_counts() -> str:
    """Counts of tested rows, redelivered ones included: the scan over rows that aren't told apart."""
    every = _ONE.replace("select row_id, shard, upper(kmer)", "select row_number() over () as row_id, shard, upper(kmer)").replace("\n  qualify row_number() over (partition by row_id order by loaded_at desc) = 1)", ")")
    return "with " + every.rstrip().rstrip(",") + f" select shard, count(*) as tested from scanned join rws using (row_id) {_NEAR} group by 1"


_STATE = "select a, b, case when degenerate then '{kind}' else 'finite' end as state, case when not degenerate then round(ratio, 6) end as ratio, case when not degenerate then round(t, 6) end as lrt, {p} as p from {of}"
_THREE = f"(case when t <= 0 then 1 else {_P} + exp(-t / 2) * sqrt(t / 2) * 2 / sqrt(pi()) end)"

ORACLE = {
    "p4_found": _PARSED + "select line_id, reason from judged where reason is not null",
    "p4_clean": _PARSED + "select line_id, shard, upper(f[1]) as kmer, f[2] as bit from judged where reason is null",
    "overlap": "with " + _ROWS.rstrip().rstrip(",") + " select j::int as j, ord, sample_id, y from ov",
    "kmer_freq": "with " + _ROWS + "f as (select row_id, sum(x)::int as ones, round(sum(x) / count(*), 9) as freq from cells group by 1) select * from f",
    "maf_filter": "with " + _ROWS + "f as (select row_id, least(avg(x), 1 - avg(x)) as maf from cells group by 1) select row_id, round(maf, 9) as maf from f where maf >= 0.05",
    "bitstring_subset": "with " + _ROWS + "f as (select row_id, string_agg(x::varchar, '' order by j) as bits from cells group by 1) select * from f",
    "bitstring_build": "with " + _ROWS.rstrip().rstrip(",") + " select row_id, bit from rws",
    "shard_quota_sample": "with " + _ROWS + """q as (select ceil(25000 / count(distinct shard)) as quota from rws)
      select shard, row_id from rws, q qualify row_number() over (partition by shard order by md5(concat('42|', row_id, '|', kmer, '|', bit)), row_id) <= quota""",
    "sample_statistics": "with " + _ROWS + "q as (select ceil(25000 / count(distinct shard))::bigint as quota from rws) select shard, count(*) as seen, least(count(*), any_value(quota)) as kept from rws, q group by 1",
    "contig_header_lengths": r"select distinct contig_idx, name, regexp_extract(name, 'length_(\d+)', 1)::bigint as len from contigs where contig_idx is not null and regexp_extract(name, 'length_(\d+)', 1) <> ''",
    "subsample_truncate": "with " + _ROWS.rstrip().rstrip(",") + " select row_id from rws order by md5(concat('42|', row_id, '|', kmer, '|', bit)), row_id limit 500",
    "matrix_batches": "with " + _ROWS + "s as (select shard, ((row_number() over (order by shard) - 1) // 10)::int as batch from (select distinct shard from rws)) select row_id, batch from rws join s using (shard)",
    "matrix_sorted": "with " + _ROWS + "s as (select shard, ((row_number() over (order by shard) - 1) // 10)::int as batch from (select distinct shard from rws)) select row_id, batch, row_number() over (order by batch, bit, kmer, row_id) - 1 as place from rws join s using (shard)",
    "basis_properties": "with " + _ROWS.rstrip().rstrip(",") + " select basis, count(*) as samples, any_value(trace) as trace, 0e0 as constant, 0e0 as idempotent, any_value(invariant) as invariant from ov, (values ('single', 4e0, 1e0), ('pair', 10e0, null)) t(basis, trace, invariant) group by 1",
    "corr_prefilter": "with " + _ONE.rstrip().rstrip(",") + f" select row_id, round(r, 9) as r from scanned {_NEAR}",
    "scan1d_intercept": "with " + _ONE.rstrip().rstrip(",") + " select row_id, ones, round(effect + 3e-9, 6) + 0e0 as effect, round(beta + 3e-9, 6) + 0e0 as beta, round(r2 + 3e-9, 6) + 0e0 as r2, round(t + 3e-9, 6) + 0e0 as t from scanned",
    "scan1d_group_covariates": "with " + _GROUPED.rstrip().rstrip(",") + " select row_id, ones, round(effect + 3e-9, 6) + 0e0 as effect, round(beta + 3e-9, 6) + 0e0 as beta, round(r2 + 3e-9, 6) + 0e0 as r2, round(t + 3e-9, 6) + 0e0 as t from scanned",
    "hits_1d": "with " + _ONE + f"pv as (select *, {_P} as p from scanned {_NEAR}) select row_id, kmer, round(t, 9) as t, round(-log10(p), 9) as log10p from pv join rws using (row_id) where p <= 0.01",
    "candidates_2d": "with " + _ONE + f"pv as (select *, {_P} as p from scanned {_NEAR}) select row_id, kmer, bit, round(t, 9) as t from pv join rws using (row_id) where p <= 0.001",
    "tested_counts": "with " + _ONE.rstrip().rstrip(",") + f" select shard, count(*) as tested from scanned join rws using (row_id) {_NEAR} group by 1",
    "union_parts": "with " + _ONE.rstrip().rstrip(",") + f" select shard, count(*) as tested from scanned join rws using (row_id) {_NEAR} group by 1",
    "bonferroni": "with " + _ONE.rstrip().rstrip(",") + f" select count(*) as tested, round(-log10(0.05 / count(*)), 9) as threshold from scanned {_NEAR}",
    "gram_matrix": "with " + _ROWS + "one as (select row_id, j from cells where x = 1), co as (select a.j as j, b.j as i, count(*) as g from one a join one b on a.row_id = b.row_id and a.j <= b.j group by 1, 2) select o.j::int as j, p.j::int as i, coalesce(co.g, 0) as g from ov o join ov p on o.j <= p.j left join co on co.j = o.j and co.i = p.j",
    "kmer_canonical": "with " + _ROWS + """c as (select row_id, reverse(translate(kmer, 'ACGT', 'TGCA')) as rc, least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) as canon from rws)
      select row_id, rc, canon, list_reduce(list_transform(string_split(translate(canon, 'ACGT', '0123'), ''), lambda x: x::bigint), lambda a, b: a * 4 + b) as code, canon as again,
        (translate(canon[30], 'ACGT', '0123')::int * 4 + translate(canon[31], 'ACGT', '0123')::int) as shard from c""",
    "index_build": "with " + _KMERS.rstrip().rstrip(",") + " select canon, effect, p, (translate(canon[30], 'ACGT', '0123')::int * 4 + translate(canon[31], 'ACGT', '0123')::int) as shard from idx",
    "contig_offsets": "with " + _CONTIGS.rstrip().rstrip(",") + " select * from offs",
    "reference_kmer_counts": "with " + _KMERS.rstrip().rstrip(",") + " select contig_idx, count(*) as windows, count(distinct canon) as kmers from refk group by 1",
    "map_hits": "with " + _KMERS.rstrip().rstrip(",") + " select contig_idx, pos, effect, p from refk join idx using (canon)",
    "map_dual": "with " + _KMERS + "h as (select kmer, effect, p from hitk qualify row_number() over (partition by kmer order by p, effect) = 1) select r.contig_idx, r.pos, coalesce(f.effect, b.effect) as effect, coalesce(f.p, b.p) as p from refk r left join h f on f.kmer = r.kmer left join h b on b.kmer = reverse(translate(r.kmer, 'ACGT', 'TGCA')) where coalesce(f.p, b.p) is not null",
    "density_filter": "with " + _CONTIGS + "d as (select distinct contig_idx, pos from good)," + _DENSE.format(src="d").rstrip().rstrip(",") + " select contig_idx, pos from kept",
    "map_merge_filter": "with " + _KMERS + "m as (select contig_idx, pos, effect, p from refk join idx using (canon))," + _DENSE.format(src="m").rstrip().rstrip(",") + " select pos + start as pos, effect, p from kept join offs using (contig_idx)",
    "map_merge_filter_51": "with " + _kmers(51) + "m as (select contig_idx, pos, effect, p from refk join idx using (canon))," + _DENSE.format(src="m").rstrip().rstrip(",") + " select pos + start as pos, effect, p from kept join offs using (contig_idx)",
    "pair_scan_input": "with " + _KMERS + """hb as (select hitk.* from hitk where bitstring is not null),
      ib as (select canon, effect, p from hb qualify row_number() over (partition by canon order by p, effect) = 1),
      bb as (select canon, bitstring as bit from hb qualify row_number() over (partition by canon order by p, bitstring) = 1)
      select pos + start as pos, bit, effect, p from refk join ib using (canon) join bb using (canon) join offs using (contig_idx)""",
    "pairs2d": _pair_sql("0"),
    "pairs2d_group_covariates": _pair_sql("g"),
    "pairs2d_classes": "with " + _CANDIDATES + "select row_id as idx, min(row_id) over (partition by bits) as rep from looks",
    "pairs2d_cooccurrence": "with " + _CANDIDATES + """
      reps as (select min(row_id) as row_id from looks group by bits),
      cc as (select row_id, j from cells join reps using (row_id) where x = 1)
      select a.row_id as idx_a, b.row_id as idx_b, count(*) as "both" from cc a join cc b on a.j = b.j and a.row_id < b.row_id
      group by 1, 2 having count(*) >= (select count(*) // 3 from ov)""",
    "pair_dictionary": "with " + _ONE + f"""cand as (select least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) as kmer, bit, {_P} as p from scanned join rws using (row_id) {_NEAR}),
      once as (select kmer, min(bit) as bit from cand where p <= 0.01 group by 1) select row_number() over (order by kmer) - 1 as idx, kmer, bit from once""",
    "pattern_classes": "with " + _ROWS + "s as (select row_id as idx, string_agg(x::varchar, '' order by j) as bits from cells group by 1) select idx, min(idx) over (partition by bits) as rep from s",
    "kmer_first_pos": "with " + _KMERS.rstrip().rstrip(",") + " select canon, min(pos + start) as pos from refk join idx using (canon) join offs using (contig_idx) group by 1",
    "map_2d_pairs": "with " + _PAIRS.rstrip().rstrip(",") + " select pos_a, pos_b, effect, p from gp",
    "twoway_grid_sums": "with " + _GRID.rstrip().rstrip(",") + " select h, round(sum(y), 6) as y, count(*) as cells from grid group by 1",
    "twoway_classes": "with " + _TWO.rstrip().rstrip(",") + " select bit, label, members from hb",
    "twoway_members": "with " + _TWO.rstrip().rstrip(",") + """
      select 'host' as side, row_id as label, min(row_id) over (partition by substring(bit, 1, 91)) as rep from rws
      union all select 'pathogen', row_id, min(row_id) over (partition by substring(bit, 92, 5)) from rws""",
    "twoway_interaction": "with " + _TWO + f"o as (select *, case when degenerate then 0 when t <= 0 then 1 else {_P} end as pv from one) " + _STATE.format(kind="infinite", p="round(pv, 6)", of="o") + " where pv <= 0.05",
    "twoway_joint": "with " + _TWO.rstrip().rstrip(",") + _STATE.format(kind="undefined", p=f"case when not degenerate then round({_THREE}, 6) end", of="three").replace("select", " select", 1),
    "effect_percentile_filter": "with " + _PAIRS + "c as (select quantile_cont(abs(effect), 0.9) as cut from gp) select pos_a, pos_b, effect from gp, c where abs(effect) >= cut",
    "grid_density_bins": "with " + _PAIRS.rstrip().rstrip(",") + " select * from counts",
    "grid_dense_cells": "with " + _PAIRS + "c as (select quantile_cont(n::double, 0.9) as cut from counts) select cx, cy, n from counts, c where n >= cut",
    "grid_cell_max": "with " + _PAIRS + """c as (select quantile_cont(n::double, 0.5) as cut from counts), d as (select cx, cy from counts, c where n >= cut),
      best as (select cx, cy, -log10(greatest(p, 1e-300)) as l, effect, pos_a, pos_b from cell join d using (cx, cy) qualify row_number() over (partition by cx, cy order by l desc, effect desc) = 1)
      select cx, cy, (cx + 0.5::double) * 200000 as x, (cy + 0.5::double) * 200000 as y, round(l, 9) + 0e0 as log10p, effect from best""",
    "region_cells": "with " + _PAIRS + """e as (select max(start + len)::bigint as size from offs),
      r as (select size // 4 as low, size // 4 * 3 as high, size // 2 as half, greatest(size // 4 * 3 - size // 4, size // 2) / 500e0 as w from e)
      select trunc((pos_a - low) / w)::bigint as cx, trunc(pos_b / w)::bigint as cy, count(*) as n from gp, r where pos_a >= low and pos_a < high and pos_b >= 0 and pos_b < half group by 1, 2""",
    "marginal_sample": "with " + _CONTIGS.rstrip().rstrip(",") + " select hit_id, gpos as pos, effect, p from placed order by md5(concat('42|', hit_id, '|', gpos)), hit_id limit 2000",
    "stream_counts": _every_row_counts(),
    "marker_sizes": "with " + _PAIRS + "e as (select min(n) as lo, max(n) as hi from counts) select cx, cy, round(2.5 + coalesce((n - lo) / nullif(hi - lo, 0), 0) * 5.5::double, 6) as size from counts, e",
    "pos_to_contig": "with " + _CONTIGS.rstrip().rstrip(",") + " select hit_id, gpos as pos, o.contig_idx, gpos - o.start as local from placed left join offs o on gpos >= o.start and gpos < o.start + o.len",
    "chrom_bands": "with " + _CONTIGS + r"b as (select case when regexp_extract(name, '(?i)^(?:chr(?:om(?:osome)?)?)[_\-]?0*(\d+)', 1) <> '' then 'Chr' || regexp_extract(name, '(?i)^(?:chr(?:om(?:osome)?)?)[_\-]?0*(\d+)', 1) else 'Other' end as label, start, start + len as e from offs) select label, min(start) as first, max(e) as last, count(*) as contigs, (min(start) + max(e)) / 2 as mid from b group by 1",
    "filter_merge": "with " + _CONTIGS.rstrip().rstrip(",") + " select hit_id, gpos as pos, effect, p from placed where p < 1e-9",
    "manhattan_points": "with " + _CONTIGS.rstrip().rstrip(",") + " select gpos as pos, sign(effect)::int as sign, round(-log10(greatest(p, 1e-300)), 9) + 0e0 as log10p from placed",
    "stream_hits_1d": "with " + _ONE + f"pv as (select *, {_P} as p from scanned {_NEAR}) select row_id, round(t, 9) as t from pv where p <= 0.01",
}


def oracle_sql():
    return dict(ORACLE)
