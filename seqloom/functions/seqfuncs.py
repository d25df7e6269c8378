"""Column builders for names, sequences, weights and classes. All stay in the JVM.

A null input gives a null result unless stated otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: names of assembly files that say nothing about the entity, and suffixes of sequence files
GENERIC_NAMES = "scaffolds|contigs|assembly|consensus"
FASTA_SUFFIX = r"\.(fasta|fna|fa|fas)$"
FASTQ_SUFFIX = r"\.(fastq|fq)$"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)/*$", 1)


def stem(path: Column) -> Column:
    """File name without .gz and the suffix of a sequence file."""
    return F.regexp_replace(F.regexp_replace(base_name(path), r"(?i)\.gz$", ""), r"(?i)\.(fasta|fna|fa|fas|fastq|fq)$", "")


def entity_id(path: Column) -> Column:
    """Id of an assembly's entity: the stem, or the folder's name where the stem is a generic one."""
    folder = F.regexp_extract(path, "([^/]+)/+[^/]*/*$", 1)
    return F.when(stem(path).rlike(f"(?i)^({GENERIC_NAMES})$") & (folder != ""), folder).otherwise(stem(path))


def read_id(path: Column) -> Column:
    """Id of a reads file: the stem without its mate mark (_R1, .2, -R2_001 and the like)."""
    return F.regexp_replace(stem(path), r"[_.-]R?[12](_001)?$", "")


def mate(path: Column) -> Column:
    """1 or 2 of a paired file, else null."""
    return F.nullif(F.regexp_extract(stem(path), r"[_.-]R?([12])(?:_001)?$", 1), F.lit("")).cast("int")


def input_kind(path: Column) -> Column:
    plain = F.regexp_replace(path, r"(?i)\.gz$", "")
    return F.when(plain.rlike(f"(?i){FASTA_SUFFIX}"), "fasta").when(plain.rlike(f"(?i){FASTQ_SUFFIX}"), "fastq").otherwise(F.when(path.isNotNull(), "other"))


def safe_id(name: Column) -> Column:
    """Name with every character outside letters, digits, dot, underscore and hyphen as an underscore."""
    return F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_")


def is_safe_id(name: Column) -> Column:
    return name.rlike(r"^[A-Za-z0-9._-]+$") & ~name.isin(".", "..")


def taxonomy_rank(taxonomy: Column, rank: str) -> Column:
    """Name at a rank (d p c o f g s) of `d__..;p__..;..;s__..`, the last one given; null if empty or missing."""
    return F.nullif(F.element_at(F.concat(F.array(F.lit("")), F.regexp_extract_all(taxonomy, F.lit(rf"(?:^|;)\s*{rank}__([^;]*)"), F.lit(1))), -1), F.lit(""))


def deepest_rank(taxonomy: Column) -> Column:
    """Deepest rank that has a name, with its prefix."""
    named = F.filter(F.split(taxonomy, ";"), lambda r: F.trim(r).rlike("^[a-z]__.+$"))
    return F.trim(F.try_element_at(named, F.lit(-1)))


def species_group(taxonomy: Column) -> Column:
    """File-safe key of the last rank, without its s__."""
    return safe_id(F.regexp_replace(F.trim(F.element_at(F.split(taxonomy, ";"), -1)), "^s__", ""))


def species_name(taxonomy: Column, fallback: Column | None = None) -> Column:
    return F.coalesce(taxonomy_rank(taxonomy, "s"), *([] if fallback is None else [F.nullif(fallback, F.lit(""))]), F.lit("UNCLASSIFIED"))


def accession(name: Column) -> Column:
    """Accession without database prefix, quotes, folder and file suffix."""
    bare = F.regexp_replace(base_name(F.translate(F.trim(name), "'\"", "")), r"^(RS|GB)_", "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?i)\.gz$", ""), r"(?i)(_genomic)?\.(fasta|fna|fa|fas)$", "")


def file_accession(name: Column) -> Column:
    """Last assembly accession in a file name that an underscore follows, or null."""
    return F.nullif(F.regexp_extract(name, r".*(GC[FA]_\d+\.\d+)_", 1), F.lit(""))


def letters(seq: Column) -> Column:
    """Letters of a sequence in upper case."""
    return F.upper(F.regexp_replace(seq, "[^A-Za-z]+", ""))


def callable_bases(seq: Column) -> Column:
    """Upper case, U as T, and every letter that is no base as N."""
    return F.regexp_replace(F.translate(letters(seq), "U", "T"), "[^ACGT]", "N")


def count_of(seq: Column, kinds: str) -> Column:
    return F.length(F.regexp_replace(seq, f"[^{kinds}]", "")).cast("bigint")


def reverse_complement(seq: Column) -> Column:
    """Reverse complement; a letter that is no base becomes N."""
    return F.regexp_replace(F.translate(F.reverse(F.upper(seq)), "ACGTBDEFHIJKLMOPQRSUVWXYZ", "TGCANNNNNNNNNNNNNNNNNNNNN"), "[^ACGTN]", "N")


def gc_pct(gc: Column, total: Column) -> Column:
    """GC share of all bases in percent; 0 where there are none."""
    return F.when(total > 0, F.lit(100.0) * gc / total).otherwise(0.0)


def attraction_weight(ani: Column, af_ref: Column, af_query: Column) -> Column:
    return ((ani - 95) / 5) * (F.greatest(af_ref, af_query) / 100) + 0.01


def repulsion_weight(mean_identity: Column) -> Column:
    return (97 - mean_identity) / 97


def quality_class(completeness: Column, contamination: Column) -> Column:
    return F.when((completeness >= 90) & (contamination <= 5), "HQ").when((completeness >= 50) & (contamination <= 10), "MQ").otherwise("LQ")


def gate_reason(max_contig: Column, contamination: Column) -> Column:
    """Why an entity does not pass the quality gate, the first reason that holds; `pass` if none does."""
    return (
        F.when(max_contig.isNull() | (max_contig < 1000), "max_contig_below_1000")
        .when(contamination.isNull() | F.isnan(contamination), "contamination_unknown")
        .when(contamination >= 5.0, "contamination_at_least_5")
        .otherwise("pass")
    )


def marker_tag(ordinal: Column, name: Column) -> Column:
    return F.concat(F.lit("M"), F.lpad(ordinal.cast("string"), 3, "0"), F.lit("_"), F.substring(safe_id(name), 1, 50))


def pairs_of(n: Column) -> Column:
    """n choose 2, without an intermediate that overflows."""
    return F.when(n % 2 == 0, (n / 2).cast("bigint") * (n - 1)).otherwise(n * ((n - 1) / 2).cast("bigint"))


def evidence_kind(log: Column) -> Column:
    """What a log line is evidence of."""
    low = F.lower(log)
    return F.when(low.contains("no overlap"), "no_overlap").when(low.contains("empty"), "empty").when(low.contains("error"), "error").otherwise("none")


def is_gzip(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 2)) == "1F8B"


def wrapped(seq: Column, width: int = 60) -> Column:
    """Sequence in lines of a width, each with its line end."""
    return F.when(F.length(seq) > 0, F.regexp_replace(seq, f"(.{{1,{width}}})", "$1\n")).otherwise("")
