"""SQL of the general problems' queries, for the engine the results are compared with."""

_RESOLVED = """CASE WHEN starts_with(path, '/') THEN list_reduce(list_prepend('', list_filter(string_split(path, '/'), lambda s: s NOT IN ('', '.'))),
    lambda a, s: CASE WHEN s = '..' THEN regexp_replace(a, '/[^/]*$', '') ELSE a || '/' || s END) ELSE path END"""

_CURRENT = f"""listing AS (SELECT DISTINCT {_RESOLVED} AS path, file_id, mtime, coalesce(file_text, '') AS file_text FROM fasta_evidence WHERE path IS NOT NULL),
current AS (SELECT * FROM listing QUALIFY row_number() OVER (PARTITION BY path ORDER BY mtime DESC, file_id DESC) = 1)"""

_TRIM = "regexp_replace({}, '^[ \\t]+|[ \\t]+$', '', 'g')"
_SPECIES = "lower(regexp_replace(regexp_replace(species, '^\\s+|\\s+$', '', 'g'), '[\\s_]+', '_', 'g'))"

P1_FOUND = f"""WITH {_CURRENT},
lines AS (SELECT path, unnest(string_split_regex(file_text, '\\r\\n|\\n|\\r')) AS line FROM current)
SELECT path, regexp_extract(line, '^>([^ \\t]*)', 1) AS record_name FROM lines WHERE starts_with(line, '>')"""

P1_INDEX = f"WITH {_CURRENT} SELECT path, file_id, CAST(strlen(file_text) AS BIGINT) AS length, sha256(file_text) AS sha256 FROM current"

P1_ASSEMBLIES = f"""WITH {_CURRENT},
keys AS (SELECT path AS assembly, strlen(file_text) AS length FROM current UNION ALL SELECT regexp_replace(path, '/[^/]*$', ''), strlen(file_text) FROM current),
held AS (SELECT assembly, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS n_bytes FROM keys GROUP BY 1),
sags AS (SELECT DISTINCT sag_id, {_RESOLVED} AS assembly FROM (SELECT id AS sag_id, assembly AS path FROM sag WHERE id IS NOT NULL AND assembly IS NOT NULL))
SELECT sag_id, assembly, coalesce(n_files, 0) AS n_files, coalesce(n_bytes, 0) AS n_bytes FROM sags LEFT JOIN held USING (assembly)"""

P1_LOOKUP = f"""WITH {_CURRENT}, gone AS (SELECT DISTINCT {_RESOLVED} AS path FROM (SELECT assembly AS path FROM sag WHERE deleted_at IS NOT NULL AND assembly IS NOT NULL))
SELECT path, file_id, CAST(strlen(file_text) AS BIGINT) AS n_bytes, sha256(file_text) AS content_sha256 FROM current SEMI JOIN gone USING (path)"""

P5_BINS = """WITH b AS (SELECT source_table, bin_id, max(coalesce(declared_sags, 0))::BIGINT AS declared, count(*) AS n_rows FROM bin_record GROUP BY 1, 2),
m AS (SELECT source_table, bin_id, count(DISTINCT x) AS n_members FROM (SELECT source_table, bin_id, unnest(members) AS x FROM bin_record) GROUP BY 1, 2)
SELECT b.*, sum(declared) OVER (PARTITION BY source_table)::BIGINT AS total, coalesce(n_members, 0) AS n_members FROM b LEFT JOIN m USING (source_table, bin_id)"""

P5_SAGS = f"""SELECT {_SPECIES} AS species, count(*) AS n_rows, count(DISTINCT regexp_replace(sag_id, '^\\s+|\\s+$', '', 'g')) AS n_sags, true AS estimate_close FROM annotations WHERE species IS NOT NULL GROUP BY 1"""

P5_FOUND = f"""WITH s AS (SELECT {_SPECIES} AS k, count(*) AS n FROM annotations GROUP BY 1),
b AS (SELECT source_table, bin_id, max(coalesce(declared_sags, 0)) AS d FROM bin_record GROUP BY 1, 2),
t AS (SELECT *, sum(d) OVER (PARTITION BY source_table) AS total FROM b)
SELECT 'annotations' AS in_table, k AS hot_key FROM s WHERE k IS NOT NULL AND n * 50 >= (SELECT sum(n) FROM s)
UNION ALL SELECT 'bin_record', bin_id FROM t WHERE total > 0 AND d * 10 >= total"""

P5_SPECIES = f"""SELECT {_SPECIES} AS species, count(*) AS n_rows, min(annotated_at) AS first_at, max(annotated_at) AS last_at
FROM annotations WHERE species IS NOT NULL GROUP BY 1"""

P6_FOUND = f"""WITH r AS (
    SELECT 'annotations' AS in_table, {_TRIM.format('sag_id')} AS id, annotated_at AS t FROM annotations WHERE sag_id IS NOT NULL AND annotated_at IS NOT NULL
    UNION ALL SELECT 'sag_task', {_TRIM.format('sag')}, created_at FROM sag_task WHERE sag IS NOT NULL AND created_at IS NOT NULL),
p AS (SELECT DISTINCT {_TRIM.format('id')} AS id, registered_at, deleted_at FROM sag WHERE id IS NOT NULL),
k AS (SELECT id, min(registered_at) AS first_at FROM p GROUP BY 1),
g AS (SELECT DISTINCT in_table, id, t FROM r),
there AS (SELECT DISTINCT g.in_table, g.id, g.t FROM g JOIN p ON g.id = p.id AND p.registered_at <= g.t AND (p.deleted_at IS NULL OR g.t < p.deleted_at))
SELECT DISTINCT g.in_table, strftime(g.t, '%Y-%m') AS month_key, g.id AS sag_id,
    CASE WHEN k.id IS NULL THEN 'missing' WHEN k.first_at IS NULL OR g.t < k.first_at THEN 'late' ELSE 'deleted' END AS reason
FROM g LEFT JOIN k ON g.id = k.id LEFT JOIN there h ON h.in_table = g.in_table AND h.id = g.id AND h.t = g.t WHERE h.id IS NULL"""

GENERAL_SQL = {"p1_found": P1_FOUND, "p1_index": P1_INDEX, "p1_assemblies": P1_ASSEMBLIES, "p1_lookup": P1_LOOKUP, "p5_found": P5_FOUND, "p5_bins": P5_BINS, "p5_sags": P5_SAGS, "p5_species": P5_SPECIES, "p6_found": P6_FOUND}
