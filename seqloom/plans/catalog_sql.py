"""SQL of the catalog's queries, for the engine the results are compared with."""

_C = "c AS (SELECT DISTINCT contig_id, sag_id, rec_name, upper(regexp_replace(coalesce(seq, ''), '[^A-Za-z]+', '', 'g')) AS s FROM contig)"


def _count(kinds: str) -> str:
    return f"length(regexp_replace(s, '[^{kinds}]', '', 'g'))"


def _words(k: int, entity: str = "contig_id") -> str:
    """w(entity, pos, word, h): valid windows of k as the smaller two-bit word of both strands, and its hash."""
    pack = lambda x, n: " + ".join(f"((({x} >> {4 * i}) & 3) << {2 * i})" for i in range(n))
    low = min(k, 16)  # a number holds sixteen letters of four bits
    word = lambda x: pack(f"{x}0", low) + (f" + (({pack(f'{x}1', k - low)}) << {2 * low})" if k > low else "")
    halves = lambda x, to: f"('0x' || right({x}, {low}))::UBIGINT AS {to}0" + (f", ('0x' || left({x}, {k - low}))::UBIGINT AS {to}1" if k > low else "")
    times = lambda x, c: f"((({x})::UHUGEINT * {c}) % 18446744073709551616)::UBIGINT"
    return f"""u AS (SELECT {entity} AS entity, p AS pos, translate(replace(substr(s, p + 1, {k}), 'U', 'T'), 'ACGT', '0123') AS x FROM c, unnest(range(0, length(s) - {k - 1})) AS q(p) WHERE length(s) >= {k} AND {entity} IS NOT NULL),
v AS (SELECT entity, pos, {halves('x', 'f')}, {halves("translate(reverse(x), '0123', '3210')", 'r')} FROM u WHERE regexp_full_match(x, '[0-3]+')),
z AS (SELECT entity, pos, least({word('f')}, {word('r')})::UBIGINT AS word FROM v),
m1 AS (SELECT *, {times('xor(word, word >> 30)', 13787848793156543929)} AS y FROM z),
m2 AS (SELECT entity, pos, word, {times('xor(y, y >> 27)', 10723151780598845931)} AS y FROM m1),
w AS (SELECT entity, pos, word, xor(y, y >> 31) AS h FROM m2)"""


def _sketch(k: int, scale: int, entity: str = "contig_id") -> str:
    return f"{_C}, {_words(k, entity)}, sk AS (SELECT DISTINCT entity, h::BIGINT AS hash FROM w WHERE h <= {(2**64 - 1) // scale})"


_CAPPED = "idx AS (SELECT * FROM sk WHERE hash NOT IN (SELECT hash FROM sk GROUP BY 1 HAVING count(*) > {}))"
_capped = _CAPPED.format
_STEM = "regexp_replace(regexp_replace(regexp_extract({p}, '([^/]*)/*$', 1), '(?i)\\.gz$', ''), '(?i)\\.(fasta|fna|fa|fas|fastq|fq)$', '')"
_LATEST = """ls AS (SELECT sag, arg_max(sp, {'a': annotated_at, 'r': row_id}) AS species FROM (SELECT trim(sag_id, ' ') AS sag, trim(species, ' ') AS sp, annotated_at, row_id FROM annotations WHERE sag_id IS NOT NULL AND species IS NOT NULL) GROUP BY 1)"""
_IDS = "ids AS (SELECT DISTINCT id FROM sag WHERE id IS NOT NULL)"
_PE = """pe AS (SELECT DISTINCT least(sag1, sag2) AS a, greatest(sag1, sag2) AS b, ani, af_ref, af_query, estimated_at AS t FROM estimate WHERE sag1 <> sag2
    AND ani IS NOT NULL AND af_ref IS NOT NULL AND af_query IS NOT NULL AND NOT isnan(ani) AND NOT isnan(af_ref) AND NOT isnan(af_query))"""
_AE = f"""{_PE}, gc AS (SELECT id, arg_max(100.0::DOUBLE * assembly_gc / assembly_acgt, {{'t': registered_at, 'g': 100.0::DOUBLE * assembly_gc / assembly_acgt}}) AS g FROM sag WHERE id IS NOT NULL AND assembly_gc IS NOT NULL AND assembly_acgt > 0 GROUP BY 1),
ed AS (SELECT a, b, ani, abs(x.g - y.g) AS gap, ((ani - 95) / 5) * (greatest(af_ref, af_query) / 100) + 0.01::DOUBLE AS wt FROM pe JOIN gc x ON x.id = a JOIN gc y ON y.id = b WHERE ani >= 90 AND abs(x.g - y.g) <= 8),
ae AS (SELECT * FROM ed QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY wt DESC, ani DESC, gap DESC) = 1)"""
_CC = f"""{_AE}, bo AS (SELECT a, b FROM ae UNION SELECT b, a FROM ae), rr(v, root) AS (SELECT a, a FROM bo UNION SELECT bo.b, rr.root FROM rr JOIN bo ON rr.v = bo.a),
cc AS (SELECT v AS node, min(root) AS component FROM rr GROUP BY 1)"""
_QC = "CASE WHEN {0} >= 90 AND {1} <= 5 THEN 'HQ' WHEN {0} >= 50 AND {1} <= 10 THEN 'MQ' ELSE 'LQ' END"
_H = "hh AS (SELECT DISTINCT q, t, qs, qe, ql, ts, te, rev FROM hit WHERE t IS NOT NULL)"
_JACCARD = f"""{_sketch(15, 4)}, n AS (SELECT entity, count(*) AS size, list(hash ORDER BY hash) AS l FROM sk GROUP BY 1),
cl AS (SELECT entity, min(entity) OVER (PARTITION BY l) AS class_id, size FROM n), re AS (SELECT sk.* , cl.size FROM sk JOIN cl USING (entity) WHERE cl.entity = cl.class_id),
jp AS (SELECT x.entity AS a, y.entity AS b, count(*) AS shared, count(*)::DOUBLE / (x.size + y.size - count(*)) AS j FROM re x JOIN re y ON x.hash = y.hash AND x.entity < y.entity GROUP BY x.entity, y.entity, x.size, y.size
    HAVING count(*)::DOUBLE / (x.size + y.size - count(*)) >= 0.8)"""


def _tri(scale: int, min_shared: int, keep: int, cap: int) -> str:
    return f"""{_CAPPED.format(cap)}, ps AS (SELECT x.entity AS a, y.entity AS b, count(*) AS shared FROM idx x JOIN idx y ON x.hash = y.hash AND x.entity < y.entity GROUP BY 1, 2 HAVING count(*) >= {min_shared}),
di AS (SELECT a AS node, b AS other, shared FROM ps UNION ALL SELECT b, a, shared FROM ps),
tk AS (SELECT * FROM di QUALIFY row_number() OVER (PARTITION BY node ORDER BY shared DESC, other) <= {keep}),
tc AS (SELECT least(node, other) AS a, greatest(node, other) AS b, max(shared) AS shared, bool_or(node < other) AS by_a, bool_or(node > other) AS by_b FROM tk GROUP BY 1, 2)"""


def _digest(key: str, name: str = "dg", source: str = "v") -> str:
    """name(key, n, digest) of the values x in the source: SHA-256 over the number of rows and four sums of parts of their own."""
    parts = " || '|' || ".join(f"coalesce(sum(('0x' || substr(sha256(x), {1 + 15 * i}, 15))::UBIGINT), 0)::HUGEINT::VARCHAR" for i in range(4))
    return f"{name} AS (SELECT {key}, count(*) AS n, sha256(count(*) || '|' || {parts}) AS digest FROM {source} GROUP BY 1)"


_VOTES = f"{_C}, {_words(17)}, vo AS (SELECT entity, ((h & 9223372036854775807) % 55296)::INTEGER AS slot, CAST(sum(CASE WHEN h >> 63 = 1 THEN 1 ELSE -1 END) AS BIGINT) AS vote FROM w GROUP BY 1, 2)"
_BEST = """bs AS (SELECT query, arg_min(ref, {'d': dist, 'r': ref}) AS ref, min(dist) AS dist FROM di GROUP BY 1),
se AS (SELECT bs.query, bs.ref, bs.dist, coalesce(min(di.dist), 2147483647)::INTEGER AS second FROM bs LEFT JOIN di ON di.query = bs.query AND di.ref < bs.ref GROUP BY 1, 2, 3),
ac AS (SELECT *, CASE WHEN dist = 0 THEN true ELSE CAST((second - dist) AS FLOAT) / CAST(dist AS FLOAT) > CAST(0.01 AS FLOAT) END AS accepted FROM se)"""

CATALOG_SQL = {
    "annotate": f"""WITH {_VOTES}, {_LATEST}, en AS (SELECT DISTINCT entity FROM vo), be AS (SELECT entity, slot FROM vo WHERE vote < 0), nb AS (SELECT en.entity, count(slot) AS n FROM en LEFT JOIN be USING (entity) GROUP BY 1),
sh AS (SELECT x.entity AS query, y.entity AS ref, count(*) AS n FROM be x JOIN be y ON x.slot = y.slot WHERE x.entity % 50 = 0 AND y.entity <> x.entity GROUP BY 1, 2),
di AS (SELECT x.entity AS query, y.entity AS ref, (x.n + y.n - 2 * coalesce(sh.n, 0))::INTEGER AS dist FROM nb x JOIN nb y ON x.entity % 50 = 0 AND y.entity <> x.entity LEFT JOIN sh ON sh.query = x.entity AND sh.ref = y.entity), {_BEST}
SELECT en.entity AS contig_id, ac.ref, ac.dist, ac.second, CASE WHEN accepted THEN coalesce(nullif(ls.species, ''), 'UNCLASSIFIED') ELSE 'UNCLASSIFIED' END AS species
FROM en LEFT JOIN ac ON ac.query = en.entity LEFT JOIN c ON c.contig_id = ac.ref LEFT JOIN ls ON ls.sag = c.sag_id WHERE en.entity % 50 = 0""",
    "entity_stats": f"""WITH {_C}, g AS (SELECT sag_id, count(*) AS n_records, CAST(sum(length(s)) AS BIGINT) AS total_bp, CAST(max(length(s)) AS BIGINT) AS max_contig, CAST(sum({_count('GC')}) AS BIGINT) AS gc_bases, CAST(sum({_count('ACGT')}) AS BIGINT) AS acgt_bases FROM c GROUP BY 1)
SELECT *, round(CASE WHEN total_bp > 0 THEN 100.0::DOUBLE * gc_bases / total_bp ELSE 0 END, 5) AS gc_pct FROM g""",
    "quality_gate": """WITH s AS (SELECT DISTINCT * FROM sag WHERE id IS NOT NULL), k AS (SELECT *, 100.0::DOUBLE * (assembly_bp - assembly_acgt) / nullif(assembly_bp, 0) AS k FROM s)
SELECT id AS sag_id, registered_at, coalesce(assembly_bp >= 1000, false) AS long_enough, CASE WHEN assembly_max_contig IS NULL OR assembly_max_contig < 1000 THEN 'max_contig_below_1000' WHEN k IS NULL THEN 'contamination_unknown' WHEN k >= 5 THEN 'contamination_at_least_5' ELSE 'pass' END AS reason FROM k""",
    "input_ids": f"""WITH s AS (SELECT source1 AS p FROM sag UNION SELECT source2 FROM sag UNION SELECT assembly FROM sag), t AS (SELECT p, {_STEM.format(p='p')} AS st, regexp_extract(p, '([^/]+)/+[^/]*/*$', 1) AS folder, regexp_replace(p, '(?i)\\.gz$', '') AS bare FROM s WHERE p IS NOT NULL)
SELECT p AS path, CASE WHEN regexp_full_match(st, '(?i)(scaffolds|contigs|assembly|consensus)') AND folder <> '' THEN folder ELSE st END AS entity, regexp_replace(st, '[_.-]R?[12](_001)?$', '') AS read_id,
CAST(nullif(regexp_extract(st, '[_.-]R?([12])(?:_001)?$', 1), '') AS INTEGER) AS mate, CASE WHEN regexp_matches(bare, '(?i)\\.(fasta|fna|fa|fas)$') THEN 'fasta' WHEN regexp_matches(bare, '(?i)\\.(fastq|fq)$') THEN 'fastq' ELSE 'other' END AS kind,
regexp_replace(regexp_extract(p, '([^/]*)/*$', 1), '[^A-Za-z0-9._-]', '_', 'g') AS safe FROM t""",
    "taxonomy_names": """WITH s AS (SELECT DISTINCT species FROM annotations WHERE species IS NOT NULL), t AS (SELECT species, regexp_extract(species, '^([A-Za-z]*)_', 1) AS g, CASE WHEN contains(lower(species), 'unclass') THEN '' ELSE species END AS n FROM s)
SELECT species, nullif(g, '') AS genus, CASE WHEN n <> '' THEN trim('s__' || n, ' ') WHEN g <> '' THEN 'g__' || g ELSE 'd__Bacteria' END AS deepest, regexp_replace(regexp_replace(trim('s__' || n, ' '), '^s__', ''), '[^A-Za-z0-9._-]', '_', 'g') AS species_group, CASE WHEN n = '' THEN 'UNCLASSIFIED' ELSE n END AS species_name FROM t""",
    "accessions": """SELECT DISTINCT ref_accession, ref_accession AS accession, nullif(regexp_extract(regexp_replace(ref_accession, '^REF', 'GCF') || '_', '(GC[FA]_[0-9]+\\.[0-9]+)_', 1), '') AS file_accession FROM annotations WHERE ref_accession IS NOT NULL""",
    "kmer_counts": f"""WITH {_C}, k AS (SELECT replace(substr(s, p + 1, 5), 'U', 'T') AS x FROM c, unnest(range(0, length(s) - 4)) AS q(p) WHERE length(s) >= 5)
SELECT least(x, reverse(translate(x, 'ACGT', 'TGCA'))) AS kmer, count(*) AS n FROM k WHERE regexp_full_match(x, '[ACGT]+') GROUP BY 1""",
    "scaled_sketch": f"WITH {_sketch(15, 64, 'sag_id')} SELECT entity AS sag_id, hash FROM sk",
    "posting_index": f"WITH {_sketch(15, 64, 'sag_id')}, {_CAPPED.format(1000)} SELECT hash, count(*) AS n_entities FROM idx GROUP BY 1",
    "index_info": f"WITH {_sketch(15, 64, 'sag_id')}, {_CAPPED.format(1000)}, g AS (SELECT hash, count(*) AS n FROM idx GROUP BY 1) SELECT count(*) AS posting_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS kept_postings, coalesce(max(n), 0) AS largest_posting FROM g",
    "index_search": f"""WITH {_sketch(15, 8)}, {_CAPPED.format(1000)}, qs AS (SELECT entity AS query, count(*) AS query_size FROM sk WHERE entity % 50 = 0 GROUP BY 1),
h AS (SELECT x.entity AS query, y.entity AS ref, count(*) AS shared FROM sk x JOIN idx y ON x.hash = y.hash AND x.entity <> y.entity WHERE x.entity % 50 = 0 GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT h.query, ref, shared, query_size, CAST(row_number() OVER (PARTITION BY h.query ORDER BY shared::DOUBLE / query_size DESC, shared DESC, ref) AS INTEGER) AS rank FROM h JOIN qs ON qs.query = h.query QUALIFY rank <= 5""",
    "seed_table": f"WITH {_C}, {_words(9, 'sag_id')}, k AS (SELECT entity, word, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(*) <= 64) SELECT entity AS sag_id, CAST(sum(n) AS BIGINT) AS n_places, count(*) AS n_seeds FROM k GROUP BY 1",
    "triangle_candidates": f"WITH {_sketch(15, 16)}, {_tri(16, 1, 128, 1000)} SELECT * FROM tc",
    "jaccard_classes": f"WITH {_JACCARD} SELECT entity, class_id, size FROM cl",
    "jaccard_pairs": f"WITH {_JACCARD} SELECT a, b, shared, round(j, 9) AS jaccard FROM jp",
    "candidate_recall": f"""WITH {_JACCARD}, sk16 AS (SELECT * FROM sk WHERE hash <= {(2**64 - 1) // 16}), {_tri(16, 1, 128, 1000).replace('FROM sk', 'FROM sk16')}, f AS (SELECT jp.a, tc.a AS hit FROM jp LEFT JOIN tc ON jp.a = tc.a AND jp.b = tc.b)
SELECT count(*) AS n_truth, count(hit) AS n_found, count(*) - count(hit) AS n_missed, CASE WHEN count(*) > 0 THEN round(count(hit)::DOUBLE / count(*), 6) END AS recall FROM f""",
    "sketch_votes": f"WITH {_VOTES} SELECT * FROM vo",
    "hamming_nearest": f"""WITH di AS (SELECT x.vec_id AS query, y.vec_id AS ref, CAST(len(list_filter(list_zip(x.embedding, y.embedding), lambda z: (z[1] > 0) <> (z[2] > 0))) AS INTEGER) AS dist FROM embeddings x JOIN embeddings y ON x.vec_id % 50 = 0 AND x.vec_id <> y.vec_id), {_BEST} SELECT * FROM ac""",
    "published_annotations": f"WITH {_LATEST}, {_IDS} SELECT id AS sag_id, coalesce(species, 'UNCLASSIFIED') AS species FROM ids LEFT JOIN ls ON ls.sag = id",
    "pending_entities": f"WITH {_LATEST}, {_IDS} SELECT id AS sag_id FROM ids WHERE id NOT IN (SELECT sag FROM ls WHERE upper(species) <> 'UNCLASSIFIED')",
    "label_groups": f"WITH {_LATEST} SELECT regexp_replace(species, '[^A-Za-z0-9._-]', '_', 'g') AS species_group, count(*) AS n_members, min(sag) AS first_member, max(sag) AS last_member FROM ls WHERE upper(species) <> 'UNCLASSIFIED' GROUP BY 1",
    "key_closure": f"""WITH {_IDS}, k AS (SELECT sag, count(*) AS m FROM (SELECT DISTINCT * FROM sag_task) WHERE sag IS NOT NULL GROUP BY 1), j AS (SELECT coalesce(id, sag) AS key, CASE WHEN sag IS NULL THEN 'missing' WHEN id IS NULL THEN 'extra' WHEN m > 1 THEN 'duplicate' END AS state FROM ids FULL JOIN k ON id = sag)
SELECT * FROM j WHERE state IS NOT NULL""",
    "partition_closure": f"""WITH {_IDS}, m AS (SELECT bin_id, unnest(members) AS key FROM bin_record), k AS (SELECT key, count(DISTINCT bin_id) AS n FROM m WHERE key IS NOT NULL GROUP BY 1), j AS (SELECT id, key, n FROM ids FULL JOIN k ON id = key)
SELECT count(id) AS n_whole, count(*) FILTER (id IS NOT NULL AND n IS NOT NULL) AS n_assigned, count(*) FILTER (id IS NOT NULL AND n IS NULL) AS n_unassigned, count(*) FILTER (id IS NULL) AS n_foreign, count(*) FILTER (n > 1) AS n_twice FROM j""",
    "bin_members": "SELECT source_table, sag_id, count(*) AS n_bins FROM (SELECT DISTINCT source_table, bin_id, unnest(members) AS sag_id FROM bin_record) WHERE sag_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1",
    "attraction_edges": f"WITH {_AE} SELECT a, b, ani, round(gap, 9) AS gc_gap, round(wt, 9) AS weight FROM ae",
    "best_hits": f"WITH {_H} SELECT q, t, qs, qe, qe - qs AS length FROM hh WHERE q IS NOT NULL QUALIFY row_number() OVER (PARTITION BY q ORDER BY qe - qs DESC, t NULLS FIRST, ts NULLS FIRST, qs NULLS FIRST, te NULLS FIRST, rev NULLS FIRST) = 1",
    "pair_evidence": f"WITH {_PE} SELECT a, b, count(*) AS n_markers, round(avg(ani), 3) AS mean_pident, round(min(ani), 3) AS min_pident FROM pe GROUP BY 1, 2",
    "repulsion_edges": f"WITH {_PE}, e AS (SELECT a, b, count(*) AS n_markers, round(avg(ani), 3) AS mean_pident FROM pe GROUP BY 1, 2) SELECT *, round((97 - mean_pident) / 97, 9) AS weight FROM e WHERE n_markers >= 2 AND mean_pident < 97",
    "graph_components": f"WITH RECURSIVE {_CC} SELECT * FROM cc",
    "cluster_purity": f"""WITH RECURSIVE {_CC}, sz AS (SELECT component, count(*) AS size FROM cc GROUP BY 1 HAVING count(*) >= 3), s AS (SELECT x.component, count(*) FILTER (ani >= 97) AS ok, count(*) FILTER (ani < 97) AS bad, min(ani) AS min_ani FROM pe JOIN cc x ON x.node = a JOIN cc y ON y.node = b WHERE x.component = y.component GROUP BY 1)
SELECT sz.component AS cluster, size, coalesce(ok, 0) AS ok, coalesce(bad, 0) AS bad, CASE WHEN ok + bad > 0 THEN round_even(ok::DOUBLE / (ok + bad), 3) END AS purity, min_ani FROM sz LEFT JOIN s USING (component)""",
    "cluster_names": f"""WITH RECURSIVE {_CC}, sz AS (SELECT component, count(*) AS n, min(node) AS f FROM cc GROUP BY 1 HAVING count(*) >= 3), nm AS (SELECT component, n, 'G' || lpad(row_number() OVER (ORDER BY n DESC, f)::VARCHAR, 4, '0') AS name FROM sz)
SELECT name, node AS entity, n AS cluster_size FROM cc JOIN nm USING (component)""",
    "assembly_n50": f"""WITH {_C}, r AS (SELECT sag_id, length(s) AS l, sum(length(s)) OVER (PARTITION BY sag_id ORDER BY length(s) DESC ROWS UNBOUNDED PRECEDING) AS run, sum(length(s)) OVER (PARTITION BY sag_id) AS total FROM c WHERE s <> '')
SELECT sag_id, count(*) AS n, CAST(min(total) AS BIGINT) AS total, CAST(max(CASE WHEN run >= (total + 1) // 2 THEN l END) AS BIGINT) AS n50 FROM r GROUP BY 1""",
    "interval_union": f"""WITH {_H}, i AS (SELECT DISTINCT t, ts, te FROM hh WHERE ts < te), r AS (SELECT *, max(te) OVER (PARTITION BY t ORDER BY ts, te ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
g AS (SELECT *, sum(CASE WHEN ts <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY t ORDER BY ts, te ROWS UNBOUNDED PRECEDING) AS k FROM r), x AS (SELECT t, k, max(te) - min(ts) AS len FROM g GROUP BY 1, 2)
SELECT t, count(*) AS n_islands, CAST(sum(len) AS BIGINT) AS covered FROM x GROUP BY 1""",
    "coverage_windows": f"""WITH {_H}, e AS (SELECT t, unnest(range(ts // 100, (te - 1) // 100 + 1)) AS k FROM hh WHERE ts < te AND ts >= 0), n AS (SELECT t, k, count(*) AS n FROM e GROUP BY 1, 2), l AS (SELECT t, list(n ORDER BY n) AS a FROM n GROUP BY 1)
SELECT t, CAST(len(a) AS INTEGER) AS n_windows, a[len(a) // 2 + 1] AS upper_median, greatest(2, a[len(a) // 2 + 1]) AS threshold FROM l""",
    "depth_segments": f"""WITH {_H}, e AS (SELECT t, p, CAST(sum(d) AS BIGINT) AS d FROM (SELECT t, ts AS p, 1 AS d FROM hh WHERE ts < te UNION ALL SELECT t, te, -1 FROM hh WHERE ts < te) GROUP BY 1, 2 HAVING sum(d) <> 0),
r AS (SELECT t, p AS seg_start, lead(p) OVER (PARTITION BY t ORDER BY p) AS seg_end, CAST(sum(d) OVER (PARTITION BY t ORDER BY p) AS BIGINT) AS depth FROM e) SELECT * FROM r WHERE depth > 0""",
    "quality_class_counts": f"SELECT strftime(estimated_at, '%Y-%m') AS month_key, {_QC.format('af_ref', '(100 - ani)')} AS quality, count(*) AS n FROM (SELECT DISTINCT * FROM estimate) WHERE af_ref IS NOT NULL AND ani IS NOT NULL AND NOT isnan(af_ref) AND NOT isnan(ani) GROUP BY 1, 2",
    "metric_deltas": f"""WITH {_PE}, o AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY t NULLS FIRST, ani, af_ref) AS i, row_number() OVER (PARTITION BY a, b ORDER BY t DESC NULLS LAST, ani DESC, af_ref DESC) AS j FROM pe),
d AS (SELECT {_QC.format('x.af_ref', '(100 - x.ani)')} || '>' || {_QC.format('y.af_ref', '(100 - y.ani)')} AS class_change, y.ani - x.ani AS d FROM o x JOIN o y ON x.a = y.a AND x.b = y.b AND x.i = 1 AND y.j = 1 AND x.j > 1)
SELECT class_change, count(*) AS n_pairs, round(avg(d), 6) AS mean_delta, round(max(abs(d)), 6) AS max_delta FROM d GROUP BY 1""",
    "multiset_digest": f"WITH {_C}, v AS (SELECT sag_id, s AS x FROM c), {_digest('sag_id')} SELECT * FROM dg",
    "ordered_digest": f"WITH {_C}, v AS (SELECT sag_id, (row_number() OVER (PARTITION BY sag_id ORDER BY contig_id) - 1) || ':' || rec_name AS x FROM c WHERE rec_name IS NOT NULL), {_digest('sag_id')} SELECT * FROM dg",
    "systematic_sample": f"WITH {_IDS}, r AS (SELECT id AS sag_id, row_number() OVER (ORDER BY id) - 1 AS rank FROM ids) SELECT * FROM r WHERE rank % 4 = 0",
    "telemetry_monotonic": """WITH e AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT user_id, count(*) AS n, min(value) AS low, max(value) AS high, arg_min(value, {'t': ts, 'e': event_id}) AS first, arg_max(value, {'t': ts, 'e': event_id}) AS last, count(*) FILTER (value < p) AS n_falls FROM e GROUP BY 1""",
    "telemetry_windows": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, min(value) AS low, max(value) AS high, round(sum(value), 6) AS total FROM events WHERE ts IS NOT NULL GROUP BY 1, 2",
    "merged_fasta": f"""WITH {_C}, {_LATEST}, x AS (SELECT regexp_replace(species, '[^A-Za-z0-9._-]', '_', 'g') AS grp, '>' || sag_id || '|' || rec_name || chr(10) || regexp_replace(s, '(.{{1,60}})', '\\1' || chr(10), 'g') AS t FROM c JOIN ls ON ls.sag = sag_id WHERE rec_name IS NOT NULL AND s <> '')
SELECT grp AS "group", count(*) AS n_records, CAST(sum(length(t)) AS BIGINT) AS n_chars, min(md5(t)) AS least_md5 FROM x GROUP BY 1""",
    "fasta_records": """WITH f AS (SELECT DISTINCT file_id, replace(replace(file_text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM fasta_evidence WHERE file_text IS NOT NULL),
p AS (SELECT file_id, string_split(chr(10) || t, chr(10) || '>')[2:] AS parts FROM f), r AS (SELECT file_id, unnest(parts) AS part, unnest(range(0, len(parts))) AS i FROM p),
x AS (SELECT file_id, i, regexp_extract(part, '^([^ \\t\\n]*)', 1) AS name, regexp_replace(translate(upper(regexp_replace(regexp_replace(part, '^[^\\n]*', ''), '[^A-Za-z]+', '', 'g')), 'U', 'T'), '[^ACGT]', 'N', 'g') AS s FROM r)
SELECT file_id, CAST(i AS INTEGER) AS rec_idx, name, CAST(length(s) AS INTEGER) AS n_bases, CAST(length(replace(s, 'N', '')) AS BIGINT) AS callable FROM x WHERE s <> ''""",
    "mate_pairs": f"""WITH s AS (SELECT source1 AS p FROM sag UNION SELECT source2 FROM sag), t AS (SELECT p, {_STEM.format(p='p')} AS st FROM s WHERE p IS NOT NULL), m AS (SELECT p, regexp_replace(st, '[_.-]R?[12](_001)?$', '') AS read_id, nullif(regexp_extract(st, '[_.-]R?([12])(?:_001)?$', 1), '') AS mate FROM t)
SELECT read_id, min(p) FILTER (mate = '1') AS r1, min(p) FILTER (mate = '2') AS r2, count(*) FILTER (mate = '1') > 0 AND count(*) FILTER (mate = '2') > 0 AND count(*) = 2 AS complete FROM m WHERE mate IS NOT NULL GROUP BY 1""",
    "evidence_kinds": """WITH l AS (SELECT concat_ws(' ', event_type, props) AS x FROM events UNION ALL SELECT concat_ws(' ', 'Empty text:', url) FROM (SELECT DISTINCT doc_id, text, url FROM documents) WHERE text IS NULL OR trim(text, ' ') = '')
SELECT CASE WHEN contains(lower(x), 'no overlap') THEN 'no_overlap' WHEN contains(lower(x), 'empty') THEN 'empty' WHEN contains(lower(x), 'error') THEN 'error' ELSE 'none' END AS kind, count(*) AS n FROM l GROUP BY 1""",
    "largest_entities": f"WITH {_C} SELECT sag_id, CAST(sum(length(s)) AS BIGINT) AS total_bp FROM c WHERE sag_id IS NOT NULL GROUP BY 1 ORDER BY total_bp DESC, sag_id LIMIT 20",
}
