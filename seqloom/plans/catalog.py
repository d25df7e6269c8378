"""Queries of the sketch, search, graph and audit operators over the given tables.

Each takes (spark, folder) and runs over whole tables. Searches take every row whose id is divisible by 50 as queries
and search all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import streaming
from ..functions import seqfuncs as fn
from ..operators import align, audit, evidence, graph, kmers, search, triangle
from ..session import table, written
from ..sources import fasta, tables

# fixed values: bits and word length of reference sketches
BITS, SKETCH_K = 55_296, 17


def contigs(spark: SparkSession, d: str) -> DataFrame:
    """Contigs once each, with the letters of seq."""
    return table(spark, d, "contig").select("contig_id", "sag_id", "rec_name", F.coalesce(fn.letters(F.col("seq")), F.lit("")).alias("seq")).dropDuplicates(["contig_id"])


def _by_contig(spark, d):
    return contigs(spark, d).select(F.col("contig_id").alias("entity"), "seq")


def _by_sag(spark, d):
    return contigs(spark, d).filter("sag_id is not null").select(F.col("sag_id").alias("entity"), "seq")


def entity_stats(spark, d):
    s = F.col("seq")
    rows = contigs(spark, d).groupBy("sag_id").agg(
        F.count("*").alias("n_records"), F.sum(F.length(s)).alias("total_bp"), F.max(F.length(s)).cast("bigint").alias("max_contig"), F.sum(fn.count_of(s, "GC")).alias("gc_bases"), F.sum(fn.count_of(s, "ACGT")).alias("acgt_bases")
    )
    return rows.withColumn("gc_pct", F.round(fn.gc_pct(F.col("gc_bases"), F.col("total_bp")), 5))


def quality_gate(spark, d):
    s = table(spark, d, "sag").filter("id is not null").distinct()
    contamination = F.lit(100.0) * (F.col("assembly_bp") - F.col("assembly_acgt")) / F.nullif("assembly_bp", F.lit(0))
    return s.select(F.col("id").alias("sag_id"), "registered_at", F.coalesce(F.col("assembly_bp") >= 1000, F.lit(False)).alias("long_enough"), fn.gate_reason(F.col("assembly_max_contig"), contamination).alias("reason"))


def input_ids(spark, d):
    s = table(spark, d, "sag").select(F.explode(F.array("source1", "source2", "assembly")).alias("path")).filter("path is not null").distinct()
    p = F.col("path")
    return s.select("path", fn.entity_id(p).alias("entity"), fn.read_id(p).alias("read_id"), fn.mate(p).alias("mate"), fn.input_kind(p).alias("kind"), fn.safe_id(fn.base_name(p)).alias("safe"))


def taxonomy_names(spark, d):
    s = table(spark, d, "annotations").select("species").filter("species is not null").distinct()
    genus = F.regexp_extract("species", "^([A-Za-z]*)_", 1)
    tax = F.concat(F.lit("d__Bacteria;p__;g__"), genus, F.lit(";s__"), F.when(F.lower("species").contains("unclass"), "").otherwise(F.col("species")))
    t = s.select("species", tax.alias("taxonomy"))
    x = F.col("taxonomy")
    return t.select("species", fn.taxonomy_rank(x, "g").alias("genus"), fn.deepest_rank(x).alias("deepest"), fn.species_group(x).alias("species_group"), fn.species_name(x).alias("species_name"))


def accessions(spark, d):
    s = table(spark, d, "annotations").select("ref_accession").filter("ref_accession is not null").distinct()
    name = F.concat(F.lit("/db/RS_"), F.col("ref_accession"), F.lit("_genomic.fna.gz"))
    file = F.concat(F.lit("GCA_000000001.1_x_"), F.regexp_replace("ref_accession", "^REF", "GCF"), F.lit("_genomic.fna"))
    return s.select("ref_accession", fn.accession(name).alias("accession"), fn.file_accession(file).alias("file_accession"))


def kmer_counts(spark, d):
    return kmers.kmer_counts(contigs(spark, d), 5).select(kmers.word_letters(F.col("word"), 5).alias("kmer"), "n")


def scaled_sketch(spark, d):
    return kmers.scaled_sketch(_by_sag(spark, d), 15, 64).withColumnRenamed("entity", "sag_id")


def posting_index(spark, d):
    kept = search.posting_index(written(kmers.scaled_sketch(_by_sag(spark, d), 15, 64), "sketches"), 1000)
    return kept.groupBy("hash").agg(F.count("*").alias("n_entities"))


def index_info(spark, d):
    return search.index_info(search.posting_index(written(kmers.scaled_sketch(_by_sag(spark, d), 15, 64), "sketches"), 1000))


def index_search(spark, d):
    sketches = written(kmers.scaled_sketch(_by_contig(spark, d), 15, 8), "sketches")
    hits = search.index_hits(sketches.filter("entity % 50 = 0"), search.posting_index(sketches, 1000))
    return search.top_hits(hits, 5).select("query", "ref", "shared", "query_size", "rank")


def seed_table(spark, d):
    """Seeds of each SAG by number of places, without those in more than 64."""
    seeds = kmers.seed_table(_by_sag(spark, d), 9, 64)
    return seeds.groupBy("entity").agg(F.count("*").alias("n_places"), F.countDistinct("seed").alias("n_seeds")).withColumnRenamed("entity", "sag_id")


def triangle_candidates(spark, d):
    return triangle.triangle_candidates(kmers.scaled_sketch(_by_contig(spark, d), 15, 16), 1, 128, 1000)


def jaccard_classes(spark, d):
    return triangle.sketch_classes(kmers.scaled_sketch(_by_contig(spark, d), 15, 4)).select("entity", "class_id", "size")


def jaccard_pairs(spark, d):
    return triangle.similar_classes(kmers.scaled_sketch(_by_contig(spark, d), 15, 4))[1].withColumn("jaccard", F.round("jaccard", 9))


def candidate_recall(spark, d):
    sketches = kmers.scaled_sketch(_by_contig(spark, d), 15, 4)
    return audit.candidate_recall(triangle.similar_classes(sketches)[1], triangle.triangle_candidates(kmers.scaled_sketch(_by_contig(spark, d), 15, 16), 1, 128, 1000))


def sketch_votes(spark, d):
    return kmers.sketch_votes(_by_contig(spark, d), BITS, SKETCH_K)


def hamming_nearest(spark, d):
    bits = written(search.sign_bits(table(spark, d, "embeddings").select(F.col("vec_id").alias("entity"), "embedding")), "bits")
    found = search.nearest(bits.filter("entity % 50 = 0"), bits.withColumnRenamed("entity", "ref"))
    return found.withColumn("accepted", search.accepted(F.col("dist"), F.col("second")))


def latest_species(spark, d):
    """(sag_id, species): the last label of each SAG, by time and row."""
    notes = table(spark, d, "annotations").select(F.trim("sag_id").alias("sag_id"), F.trim("species").alias("species"), "annotated_at", "row_id").filter("sag_id is not null and species is not null")
    return notes.groupBy("sag_id").agg(F.max_by("species", F.struct("annotated_at", "row_id")).alias("species"))


def annotate(spark, d):
    base = contigs(spark, d)
    sketch = written(kmers.bit_sketch(base.select(F.col("contig_id").alias("entity"), "seq"), BITS, SKETCH_K), "sketch")
    labels = base.join(latest_species(spark, d), "sag_id").select(F.col("contig_id").alias("ref"), "species")
    out = search.annotate(sketch.filter("entity % 50 = 0"), sketch.withColumnRenamed("entity", "ref"), labels)
    return out.withColumnRenamed("query", "contig_id")


flagship = annotate


def published_annotations(spark, d):
    ids = table(spark, d, "sag").select(F.col("id").alias("sag_id")).filter("sag_id is not null").distinct()
    return ids.join(latest_species(spark, d), "sag_id", "left").select("sag_id", F.coalesce("species", F.lit("UNCLASSIFIED")).alias("species"))


def pending_entities(spark, d):
    ids = table(spark, d, "sag").select(F.col("id").alias("sag_id")).filter("sag_id is not null").distinct()
    return ids.join(latest_species(spark, d).filter("upper(species) <> 'UNCLASSIFIED'"), "sag_id", "left_anti")


def label_groups(spark, d):
    named = latest_species(spark, d).filter("upper(species) <> 'UNCLASSIFIED'").withColumn("species_group", fn.safe_id(F.col("species")))
    return named.groupBy("species_group").agg(F.count("*").alias("n_members"), F.min("sag_id").alias("first_member"), F.max("sag_id").alias("last_member"))


def key_closure(spark, d):
    return audit.key_closure(table(spark, d, "sag").select(F.col("id").alias("key")).distinct(), table(spark, d, "sag_task").distinct().select(F.col("sag").alias("key")))


def partition_closure(spark, d):
    parts = table(spark, d, "bin_record").select(F.col("bin_id").alias("part"), F.explode("members").alias("key"))
    return audit.partition_closure(parts, table(spark, d, "sag").select(F.col("id").alias("key")))


def bin_members(spark, d):
    """Members of more than one bin of a source table."""
    rows = table(spark, d, "bin_record").select("source_table", "bin_id", F.explode("members").alias("sag_id")).filter("sag_id is not null").distinct()
    return rows.groupBy("source_table", "sag_id").agg(F.count("*").alias("n_bins")).filter("n_bins > 1")


def _pairs(spark, d):
    return evidence.pair_estimates(table(spark, d, "estimate"))


def _attraction(spark, d):
    return evidence.attraction_edges(_pairs(spark, d), evidence.entity_gc(table(spark, d, "sag")), 90.0, 8.0)


def attraction_edges(spark, d):
    return _attraction(spark, d).select("a", "b", "ani", F.round("gc_gap", 9).alias("gc_gap"), F.round("weight", 9).alias("weight"))


def best_hits(spark, d):
    hits = table(spark, d, "hit").filter("q is not null and t is not null").distinct()
    best = evidence.best_row(hits, ["q"], F.desc(F.col("qe") - F.col("qs")), "t", "ts", "qs", "te", "rev")
    return best.select("q", "t", "qs", "qe", (F.col("qe") - F.col("qs")).alias("length"))


def pair_evidence(spark, d):
    return evidence.pair_evidence(_pairs(spark, d))


def repulsion_edges(spark, d):
    return evidence.repulsion_edges(evidence.pair_evidence(_pairs(spark, d)), 2).withColumn("weight", F.round("weight", 9))


def graph_components(spark, d):
    return graph.components(_attraction(spark, d))


def cluster_purity(spark, d):
    members = graph.components(_attraction(spark, d)).toDF("entity", "cluster")
    return evidence.cluster_purity(members.select("cluster", "entity"), _pairs(spark, d), 97.0, 3)


def cluster_names(spark, d):
    members = graph.components(_attraction(spark, d)).toDF("entity", "cluster")
    return evidence.name_clusters(members.select("cluster", "entity"), 3)


def signed_clusters(spark, d):
    nodes = table(spark, d, "sag").select(F.col("id").alias("node"))
    return graph.communities(nodes, _attraction(spark, d), evidence.repulsion_edges(evidence.pair_evidence(_pairs(spark, d)), 2), graph.SWEEP)


def sweep_selection(spark, d):
    """The parameter point with most pure communities of three or more."""
    found = written(signed_clusters(spark, d), "clusters")
    members = found.select(F.struct("point", "community").alias("cluster"), F.col("node").alias("entity"))
    pure = evidence.cluster_purity(members, _pairs(spark, d), 97.0, 3).filter("purity >= 0.9")
    scores = pure.groupBy(F.col("cluster.point").alias("ord")).agg(F.count("*").alias("n_pure"), F.sum("size").alias("n_members"))
    all_points = found.select(F.col("point").alias("ord")).distinct().join(scores, "ord", "left").fillna(0, ["n_pure", "n_members"])
    return evidence.select_parameters(all_points)


def assembly_n50(spark, d):
    return audit.n50(contigs(spark, d).select("sag_id", F.length("seq").cast("bigint").alias("len")), "sag_id", "len")


def _hits(spark, d):
    return table(spark, d, "hit").filter("t is not null").distinct()


def interval_union(spark, d):
    return audit.interval_union(_hits(spark, d), "t", "ts", "te")


def coverage_windows(spark, d):
    return audit.coverage_windows(_hits(spark, d), "t", "ts", "te", 100, 2)


def depth_segments(spark, d):
    return audit.depth_segments(_hits(spark, d), "t", "ts", "te")


def quality_class_counts(spark, d):
    rows = table(spark, d, "estimate").distinct().filter("af_ref is not null and ani is not null and not isnan(af_ref) and not isnan(ani)")
    return rows.select(F.date_format("estimated_at", "yyyy-MM").alias("month_key"), fn.quality_class(F.col("af_ref"), 100 - F.col("ani")).alias("quality")).groupBy("month_key", "quality").agg(F.count("*").alias("n"))


def metric_deltas(spark, d):
    """Changes of a pair's results from the first to the last estimate, over all pairs with several, by change of class."""
    ends = _pairs(spark, d).groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct("at", "ani", "af_ref")).alias("x"), F.max(F.struct("at", "ani", "af_ref")).alias("y")).filter("n > 1")
    kind = lambda s: fn.quality_class(F.col(f"{s}.af_ref"), 100 - F.col(f"{s}.ani"))
    change = F.col("y.ani") - F.col("x.ani")
    return ends.groupBy(F.concat_ws(">", kind("x"), kind("y")).alias("class_change")).agg(F.count("*").alias("n_pairs"), F.round(F.avg(change), 6).alias("mean_delta"), F.round(F.max(F.abs(change)), 6).alias("max_delta"))


def multiset_digest(spark, d):
    return audit.multiset_digest(contigs(spark, d), ["sag_id"], F.col("seq"))


def ordered_digest(spark, d):
    return audit.ordered_digest(contigs(spark, d).filter("rec_name is not null"), "sag_id", ["contig_id"], F.col("rec_name"))


def systematic_sample(spark, d):
    return audit.systematic_sample(table(spark, d, "sag"), "id").select(F.col("id").alias("sag_id"), "rank")


def telemetry_monotonic(spark, d):
    return audit.monotonic_series(table(spark, d, "events"), "user_id", "ts", "event_id", "value")


def telemetry_windows(spark, d):
    return streaming.telemetry_windows(table(spark, d, "events")).withColumn("total", F.round("total", 6))


def merged_fasta(spark, d):
    """Records of each labelled group as FASTA text, by its size and digest."""
    named = contigs(spark, d).join(latest_species(spark, d), "sag_id").filter("rec_name is not null and seq <> ''").withColumn("species_group", fn.safe_id(F.col("species")))
    text = fasta.merged_headers(named.withColumnRenamed("rec_name", "name"), "species_group", "sag_id")
    return text.groupBy("group").agg(F.count("*").alias("n_records"), F.sum(F.length("text")).alias("n_chars"), F.min(F.md5("text")).alias("least_md5"))


def fasta_records(spark, d):
    files = table(spark, d, "fasta_evidence").dropDuplicates(["file_id"]).select(F.col("file_id").cast("string").alias("path"), F.col("file_text").alias("content"))
    return fasta.normalised(fasta.records_of(files)).select(F.col("path").cast("bigint").alias("file_id"), "rec_idx", "name", F.length("seq").alias("n_bases"), "callable")


def mate_pairs(spark, d):
    return tables.mate_pairs(table(spark, d, "sag").select(F.explode(F.array("source1", "source2")).alias("path")).filter("path is not null"))


def evidence_kinds(spark, d):
    """Log lines by what they are evidence of: those of events, and one for each page that came without text."""
    events = table(spark, d, "events").select(F.concat_ws(" ", "event_type", "props").alias("line"))
    bare = table(spark, d, "documents").dropDuplicates(["doc_id"]).filter("text is null or trim(text) = ''").select(F.concat_ws(" ", F.lit("Empty text:"), "url").alias("line"))
    return events.unionByName(bare).groupBy(fn.evidence_kind(F.col("line")).alias("kind")).agg(F.count("*").alias("n"))


def largest_entities(spark, d):
    """The 20 SAGs with most letters."""
    sizes = contigs(spark, d).filter("sag_id is not null").groupBy("sag_id").agg(F.sum(F.length("seq")).alias("total_bp"))
    return sizes.orderBy(F.desc("total_bp"), "sag_id").limit(20)


def _sequences(spark, d):
    return written(_by_contig(spark, d), "sequences")


def ani_af_pairs(spark, d):
    """Estimates of all contig pairs that share three sketch hashes or more."""
    base = _sequences(spark, d)
    pairs = triangle.all_candidates(kmers.scaled_sketch(base, 15, 16), 3)
    return align.pair_estimates(pairs.select("a", "b"), base)


def _genomes(spark, d):
    return written(align.records_by_entity(_by_contig(spark, d)), "genomes")


def _exact(genomes):
    return align.pair_estimates(align.voted_pairs(genomes.filter("entity % 50 = 0"), genomes), genomes, min_af=15.0)


def exact_estimates(spark, d):
    """Estimates with an aligned fraction of 15 percent or more, of every contig whose id is divisible by 50 against all others; no pair is left out."""
    return _exact(_genomes(spark, d))


def estimate_recall(spark, d):
    """How many of the pairs of exact_estimates the shared hashes of ani_af_pairs name; hashes are counted for these pairs, others play no part in it."""
    genomes = _genomes(spark, d)
    near = _exact(genomes).filter("ani >= 90").select(F.least("ref", "query").alias("a"), F.greatest("ref", "query").alias("b"))
    near = written(near.distinct(), "near")
    ends = near.select(F.explode(F.array("a", "b")).alias("entity")).distinct()
    sketches = kmers.scaled_sketch(genomes.join(ends, "entity", "left_semi").select("entity", F.explode("g").alias("seq")), 15, 16)
    return audit.candidate_recall(near, triangle.shared_of(near, sketches).filter("shared >= 3"))


CATALOG = {
    f.__name__: f
    for f in (
        annotate, entity_stats, quality_gate, input_ids, taxonomy_names, accessions, kmer_counts, scaled_sketch, posting_index, index_info, index_search, seed_table, triangle_candidates,
        jaccard_classes, jaccard_pairs, candidate_recall, sketch_votes, hamming_nearest, published_annotations, pending_entities, label_groups, key_closure, partition_closure, bin_members,
        attraction_edges, best_hits, pair_evidence, repulsion_edges, graph_components, cluster_purity, cluster_names, signed_clusters, sweep_selection, assembly_n50, interval_union, coverage_windows,
        depth_segments, quality_class_counts, metric_deltas, multiset_digest, ordered_digest, systematic_sample, telemetry_monotonic, telemetry_windows, merged_fasta, fasta_records, mate_pairs, evidence_kinds,
        largest_entities, ani_af_pairs, exact_estimates, estimate_recall,
    )
}

from .catalog_sql import CATALOG_SQL  # noqa: E402, F401
