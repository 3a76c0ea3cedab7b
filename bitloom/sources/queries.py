"""Queries of the readers and writers: what the given tables hold is written as the files other programs exchange and read back.

Files go to the shared folder. Results are those of the tables, so the SQL beside them knows nothing of files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from bitloom.operators import features, mapping, pairs2d, report, scan1d, structure, twoway
from bitloom.operators import queries as core
from bitloom.plans.runtime import scratch, table
from bitloom.sources import columns, sinks, text


def _lines(df, path, **options):
    """The one column of ``df`` as lines, in its order."""
    df.write.options(**options).text(path)
    return path


def file_sample_list(spark, d):
    ids = table(spark, d, "samples").orderBy("ord").select("sample_id")
    return text.sample_list(spark, _lines(ids.coalesce(1), scratch(spark, "samples")))


def file_phenotype(spark, d):
    """Values in file order, samples given twice included."""
    valid = table(spark, d, "phenotype").filter("sample_id is not null and y is not null and not isnan(y)").orderBy("line_no")
    path = _lines(valid.select(F.concat_ws(" ", "sample_id", F.col("y").cast("string"))).coalesce(1), scratch(spark, "phenotype"))
    return text.phenotype_file(spark, path).select("line_no", "sample_id", "y")


def _matrix(spark, d):
    rows = core._unique(spark, d)
    line = F.concat("kmer", F.when(F.col("row_id") % 2 == 0, "\t").otherwise(" "), "bit")
    return _lines(rows.select(line), scratch(spark, "matrix"), compression="gzip")


def file_row_matrix(spark, d):
    return text.row_matrix(spark, _matrix(spark, d)).select("kmer", "bit")


def file_strict_row_matrix(spark, d):
    return text.strict_row_matrix(spark, _matrix(spark, d), core.K, core.BITS).select("kmer", "bit")


def file_column_batch(spark, d):
    """Of each sample the ones of its column and the sum of their places, with the length of the columns."""
    path = scratch(spark, "batch")
    columns.write_columns(core._unique(spark, d), path, core.BITS)
    batch = columns.column_batch(spark, path)
    length, told = columns.probe_rows(batch), int(columns.batch_facts(spark, path)["num_rows"])
    ones = columns.presence_of(batch).groupBy("ord").agg(F.count("*").alias("ones"), F.sum("idx").cast("bigint").alias("places"))
    return ones.select("ord", "ones", "places", F.lit(length).cast("bigint").alias("rows"), F.lit(told).cast("bigint").alias("told"))


def file_kmer_dictionary(spark, d):
    """The dictionary of all k-mers in order."""
    numbered = pairs2d.renumbered(core._unique(spark, d), core.K)
    path = scratch(spark, "dictionary")
    sinks.write_dictionary(numbered, path)
    return text.kmer_dictionary(spark, path, numbered.count())


def file_basis(spark, d):
    des, path = core._design(spark, d, True), scratch(spark, "basis")
    sinks.write_basis(spark, des.basis, path)
    out = structure.basis_table(spark, des, sinks.read_basis(spark, path, des.n))
    return out.filter("value <> 0").select("sample_id", "component", F.round("value", 9).alias("value"))


def file_associations(spark, d):
    """Hits without and with bit strings, as written for the index and for the pair scan."""
    three, four = scratch(spark, "hits"), scratch(spark, "candidates")
    rows, des = core._rows(spark, d), core._design(spark, d)
    sinks.write_hits(core._hits(spark, d), three)
    sinks.write_candidates(scan1d.candidates(rows, des, core.MIN_CORR, core.LOG10_P, core.LOG10_P_2D), four)
    both = text.association_file(spark, three, core.K).unionByName(text.association_file(spark, four, core.K))
    return both.select("kmer", "bit", (F.round(F.col("effect") + F.lit(3e-9), 6) + F.lit(0.0)).alias("effect"), F.round(-F.log10("p"), 9).alias("log10p"))


def file_counts(spark, d):
    path = scratch(spark, "counts")
    sinks.write_counts(core.tested_counts(spark, d), path)
    return text.count_files(spark, path)


def file_pairs(spark, d):
    path = scratch(spark, "pairs")
    sinks.write_pairs(core._pairs(spark, d), path)
    return text.pair_file(spark, path)


def file_plot_hits(spark, d):
    """Mapped hits with 9 digits, as plots read them."""
    path = scratch(spark, "mapped")
    sinks.write_tsv(core._genome_hits(spark, d), path, ["pos", "effect", "p"], digits=9)
    return text.hit_file(spark, path, 0)


def file_contig_hits(spark, d):
    """Hits under a p-value by contig; a contig without any has no file."""
    path = scratch(spark, "by-contig")
    sinks.write_contig_hits(report.under(core._mapped_hits(spark, d), 1e-9).select("contig_idx", "pos", "effect", "p"), path)
    return text.contig_hits(spark, path)


def file_fasta(spark, d):
    """Contigs as reference files and back, numbered in order."""
    path = scratch(spark, "fasta")
    given = table(spark, d, "contigs").filter("contig_idx is not null")
    known = given.withColumn("_known", F.struct(F.col("seq").isNotNull(), "loaded_at"))
    last = features.latest_rows(known, ["contig_idx"], "_known", ["name", "seq"])
    _lines(last.orderBy("contig_idx").select(F.concat(F.lit(">"), "name", F.lit(" from>to\n"), F.coalesce("seq", F.lit("")))), path)
    return text.fasta(spark, path).select("contig_idx", "name", F.length("seq").cast("bigint").alias("len"), F.md5("seq").alias("bases"))


def file_transposed_sample(spark, d):
    """A subsample of features, a line per sample; the sample axis and the subsample bound it. Returns each sample's ones."""
    path = scratch(spark, "transposed")
    chosen = features.subsample(core._unique(spark, d), 300).select("row_id", F.posexplode(F.split("bit", "")).alias("ord", "b")).filter("b <> ''")
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "b"))), lambda x: x["b"]), "\t").alias("line")
    bits = chosen.groupBy("ord").agg(line).join(table(spark, d, "samples"), "ord").select("ord", F.concat_ws("\t", "sample_id", "line").alias("line"))
    head = chosen.groupBy().agg(F.array_join(F.transform(F.array_sort(F.collect_set("row_id")), lambda i: F.concat(F.lit("f"), i.cast("string"))), "\t").alias("ids"))
    whole = bits.unionByName(head.select(F.lit(-1).alias("ord"), F.concat_ws("\t", F.lit("sample_id"), "ids").alias("line")))
    _lines(whole.orderBy("ord").coalesce(1).select("line"), path)
    return text.transposed_sample(spark, path).select("sample_id", F.size("row").alias("features"), F.aggregate("row", F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("ones"))


def file_labelled_bits(spark, d):
    path = _lines(core._unique(spark, d).select(F.concat_ws(" ", F.col("row_id").cast("string"), "bit")), scratch(spark, "hosts"))
    return text.labelled_bits(spark, path)


def file_grid(spark, d):
    path = _lines(core._grid(spark, d).select(F.concat_ws(" ", *(F.col(c).cast("string") for c in ("h", "p", "y")))), scratch(spark, "grid"))
    return text.grid_file(spark, path).select("h", "p", F.round("y", 6).alias("y"))


def file_number_matrix(spark, d):
    """The grid as a matrix, a line per host."""
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "y"))), lambda x: x["y"].cast("string")), " ")
    path = _lines(core._grid(spark, d).groupBy("h").agg(line.alias("line")).orderBy("h").coalesce(1).select("line"), scratch(spark, "matrix"))
    each = text.number_matrix(spark, path).select(F.col("line_no").alias("h"), F.posexplode("row").alias("p", "y"))
    return each.select("h", "p", F.round("y", 6).alias("y"))


def file_boundaries(spark, d):
    path = scratch(spark, "boundaries")
    offsets = mapping.contig_offsets(table(spark, d, "contigs")).select(F.concat(F.lit("c"), F.col("contig_idx").cast("string")).alias("label"), "start", (F.col("start") + F.col("len")).alias("end"))
    sinks.write_tsv(offsets, path, ["label", "start", "end"])
    return text.boundary_file(spark, path)


def file_index(spark, d):
    path = scratch(spark, "index")
    sinks.write_index(core._index(spark, d, core._ref(spark, d)), path, core.K)
    return sinks.read_index(spark, path, core.K)


def file_twoway(spark, d):
    """Pairs of patterns with p <= 0.05 in blanks, with 10 digits."""
    path = scratch(spark, "twoway")
    found = twoway.scan_twoway(*core._sides(spark, d), twoway.grid(core._grid(spark, d), core.HOSTS, core.PATHOGENS, center_y=True), drop_monomorphic=True, log10_p=1.3)
    sinks.write_twoway(found, path)
    back = spark.read.csv(path, sep=" ", schema="a bigint, b bigint, ratio double, delta double, lrt double, p double")
    return back.select("a", "b", F.round("ratio", 4).alias("ratio"))


def queries():
    named = [
        file_sample_list, file_phenotype, file_row_matrix, file_strict_row_matrix, file_column_batch, file_kmer_dictionary, file_basis, file_associations, file_counts, file_pairs,
        file_plot_hits, file_contig_hits, file_fasta, file_transposed_sample, file_labelled_bits, file_grid, file_number_matrix, file_boundaries, file_index, file_twoway,
    ]
    return {f.__name__: f for f in named}


def oracle_sql():
    one, contigs, kmers, rows = (x.rstrip().rstrip(",") for x in (core._ONE, core._CONTIGS, core._KMERS, core._ROWS))
    return {
        "file_sample_list": "select (row_number() over (order by ord) - 1)::int as ord, sample_id from samples",
        "file_phenotype": "select (row_number() over (order by line_no) - 1)::int as line_no, sample_id, y from phenotype where sample_id is not null and y is not null and y::varchar <> 'nan'",
        "file_row_matrix": f"with {rows} select kmer, bit from rws",
        "file_strict_row_matrix": f"with {rows} select kmer, bit from rws",
        "file_column_batch": f"with {rows}, p as (select bit, row_number() over (order by bit, kmer) - 1 as idx from rws), n as (select count(*) as n from rws) select i::int as ord, count(*) as ones, sum(idx)::bigint as places, any_value(n) as \"rows\", any_value(n) as told from p, n, (select unnest(range(96)) as i) where bit[i + 1] = '1' group by 1",
        "file_kmer_dictionary": f"with {rows} select row_number() over (order by kmer) - 1 as idx, kmer from (select distinct least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) as kmer from rws)",
        "file_basis": f"with {rows}, s as (select sample_id, g, count(*) over (partition by g) as n from ov) select sample_id, (dense_rank() over (order by g) - 1)::int as component, round(1 / sqrt(n), 9) as value from s",
        "file_associations": f"with {one}, pv as (select *, {core._P} as p from scanned {core._NEAR}), h as (select kmer, bit, round(effect + 3e-9, 6) + 0e0 as effect, p from pv join rws using (row_id)) select kmer, null as bit, effect, round(-log10(p), 9) as log10p from h where p <= 0.01 union all select kmer, bit, effect, round(-log10(p), 9) from h where p <= 0.001",
        "file_counts": f"with {one} select shard, count(*) as tested from scanned join rws using (row_id) {core._NEAR} group by 1",
        "file_pairs": """select idx_a, idx_b, effect, pval as p from (select * from pairs qualify row_number() over (partition by trait, idx_a, idx_b order by written_at desc) = 1)
          where pval >= 0 and pval::varchar <> 'nan' and effect is not null and effect::varchar not in ('nan', 'inf', '-inf')""",
        "file_plot_hits": f"with {contigs} select gpos as pos, format('{{:.8e}}', effect)::double as effect, greatest(format('{{:.8e}}', p)::double, 1e-300) as p from placed",
        "file_contig_hits": f"with {contigs} select pos, effect, p, contig_idx from good where p < 1e-9",
        "file_fasta": f"with {contigs} select row_number() over (order by contig_idx) - 1 as contig_idx, regexp_extract(name, '^[^ \\t]*') as name, coalesce(length(seq), 0)::bigint as len, md5(coalesce(seq, '')) as bases from seqs",
        "file_transposed_sample": f"with {rows}, c as (select bit from rws order by md5(concat('42|', row_id, '|', kmer, '|', bit)), row_id limit 300) select sample_id, count(*)::int as features, count(*) filter (where bit[ord + 1] = '1')::bigint as ones from samples, c group by 1",
        "file_labelled_bits": f"with {rows} select row_id::varchar as label, bit from rws",
        "file_grid": "with " + core._GRID.rstrip().rstrip(",") + " select h::int as h, p::int as p, round(y, 6) as y from grid",
        "file_number_matrix": "with " + core._GRID.rstrip().rstrip(",") + " select h::int as h, p::int as p, round(y, 6) as y from grid",
        "file_boundaries": f"with {contigs} select 'c' || contig_idx as label, start, start + len as \"end\" from offs",
        "file_index": f"with {kmers} select canon, effect, p, (translate(canon[30], 'ACGT', '0123')::int * 4 + translate(canon[31], 'ACGT', '0123')::int) as shard from idx",
        "file_twoway": "with " + core._TWO + f"q as (select *, {core._THREE} as pv from three where not degenerate) select a, b, round(ratio, 4) as ratio from q where pv <= pow(10, -1.3)",
    }
