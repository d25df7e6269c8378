import pytest
from pyspark.sql import functions as F

from seqloom.functions import seqfuncs as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


NAMES = [
    (fn.entity_id, "x/SAG_A.fna", "SAG_A"),
    (fn.entity_id, "SAG-B.fa.gz", "SAG-B"),
    (fn.entity_id, "/d/SAG_007/scaffolds.fasta", "SAG_007"),
    (fn.entity_id, "contigs.fa", "contigs"),
    (fn.read_id, "/r/sample_R1.fastq", "sample"),
    (fn.read_id, "s.2_001.fq.gz", "s"),
    (fn.mate, "s_R2.fastq.gz", 2),
    (fn.mate, "s.fastq.gz", None),
    (fn.input_kind, "a.FNA.gz", "fasta"),
    (fn.input_kind, "a.fq", "fastq"),
    (fn.input_kind, "a.txt", "other"),
    (fn.safe_id, "a b/c*", "a_b_c_"),
    (fn.accession, "RS_GCF_000001.1", "GCF_000001.1"),
    (fn.accession, "'/db/GB_GCA_1.2_genomic.fna.gz'", "GCA_1.2"),
    (fn.file_accession, "GCA_1.1_x_GCF_2.3_genomic.fna", "GCF_2.3"),
    (fn.file_accession, "GCF_2.3.fna", None),
    (fn.deepest_rank, "d__B;p__P;g__;s__", "p__P"),
    (fn.deepest_rank, "d__;p__", None),
    (fn.species_group, "d__B;s__Genus sp.1/x", "Genus_sp.1_x"),
    (fn.species_name, "d__B;s__Genus one", "Genus one"),
    (fn.species_name, "d__B;s__", "UNCLASSIFIED"),
    (fn.letters, "ac-g\nT*", "ACGT"),
    (fn.callable_bases, "acgurn-x", "ACGTNNN"),
    (fn.reverse_complement, "aaCGTN", "NACGTT"),
    (fn.evidence_kind, "Found No Overlaps here", "no_overlap"),
    (fn.evidence_kind, "fine", "none"),
    (lambda c: fn.wrapped(c, 3), "ABCDEFG", "ABC\nDEF\nG\n"),
    (lambda c: fn.wrapped(c, 3), "", ""),
    (lambda c: fn.marker_tag(F.lit(7), c), "PF 1/x", "M007_PF_1_x"),
]


@pytest.mark.parametrize(("f", "given", "want"), NAMES)
def test_names(spark, f, given, want):
    assert one(spark, f(F.lit(given))) == want


def test_null_gives_null(spark):
    for f in (fn.entity_id, fn.read_id, fn.mate, fn.input_kind, fn.safe_id, fn.accession, fn.letters, fn.reverse_complement, fn.deepest_rank):
        assert one(spark, f(F.lit(None).cast("string"))) is None


def test_numbers(spark):
    assert [one(spark, fn.pairs_of(F.lit(n).cast("bigint"))) for n in (0, 1, 10, 5834)] == [0, 0, 45, 17_014_861]
    assert one(spark, fn.attraction_weight(F.lit(96.0), F.lit(20.0), F.lit(30.0))) == pytest.approx(0.07)
    assert one(spark, fn.repulsion_weight(F.lit(96.0))) == pytest.approx(1 / 97)
    assert one(spark, fn.gc_pct(F.lit(4), F.lit(0))) == 0
    gates = [(1000, 4.999999, "pass"), (1000, 5.0, "contamination_at_least_5"), (999, 5.0, "max_contig_below_1000"), (None, 1.0, "max_contig_below_1000"), (2000, None, "contamination_unknown")]
    for contig, contamination, want in gates:
        assert one(spark, fn.gate_reason(F.lit(contig).cast("bigint"), F.lit(contamination).cast("double"))) == want
    for completeness, contamination, want in [(90, 5, "HQ"), (90, 5.1, "MQ"), (50, 10, "MQ"), (49.9, 0, "LQ"), (95, 11, "LQ")]:
        assert one(spark, fn.quality_class(F.lit(completeness), F.lit(contamination))) == want
    assert one(spark, fn.is_gzip(F.unhex(F.lit("1F8B08")))) and not one(spark, fn.is_safe_id(F.lit("..")))
