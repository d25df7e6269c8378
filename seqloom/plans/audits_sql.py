"""SQL of the audit queries, for the engine the results are compared with."""

from .catalog_sql import _BEST, _C, _CC, _H, _IDS, _LATEST, _PE, _capped, _digest, _sketch

_COMPLEMENT = "reverse(translate(x, 'ACGTN', 'TGCAN'))"
_CALLABLE = "regexp_replace(translate(s, 'U', 'T'), '[^ACGT]', 'N', 'g')"
_BACK = "regexp_replace(reverse(translate(x, 'ACGTBDEFHIJKLMOPQRSUVWXYZ', 'TGCANNNNNNNNNNNNNNNNNNNNN')), '[^ACGTN]', 'N', 'g')"
# published mixing: products of 128 bits, of which both halves are combined
_LOW = "({} % 18446744073709551616)::UBIGINT"
_HIGH = "({} // 18446744073709551616)::UBIGINT"
_EIGHT = "('0x' || hex(reverse(substr(x, {}, 8))))::UBIGINT"
_S0, _S1 = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB
_START = (_S0 * _S1 % 2**64) ^ (_S0 * _S1 // 2**64)
_STORED = f"""ends AS (SELECT contig_id, substr(s, 1, length(s) - 1) AS x FROM c WHERE length(s) > 17),
sides AS (SELECT contig_id, x FROM ends UNION ALL SELECT contig_id, {_BACK} FROM ends), win AS (SELECT contig_id, substr(x, p, 17) AS x FROM sides, unnest(range(1, length(x) - 15)) AS q(p)),
e AS (SELECT contig_id, {_EIGHT.format(1)} AS a, {_EIGHT.format(9)} AS b, {_EIGHT.format(2)} AS a2, {_EIGHT.format(10)} AS b2 FROM win),
m1 AS (SELECT *, xor(a, {_S1}::UBIGINT)::UHUGEINT * xor(b, {_START}::UBIGINT)::UHUGEINT AS y FROM e),
m2 AS (SELECT contig_id, xor(a2, {_S1}::UBIGINT)::UHUGEINT * xor(b2, xor({_LOW.format('y')}, {_HIGH.format('y')}))::UHUGEINT AS y FROM m1),
m3 AS (SELECT contig_id, xor(xor({_LOW.format('y')}, {_S0}::UBIGINT), 17::UBIGINT)::UHUGEINT * xor({_HIGH.format('y')}, {_S1}::UBIGINT)::UHUGEINT AS y FROM m2),
hs AS (SELECT contig_id, xor({_LOW.format('y')}, {_HIGH.format('y')}) AS h FROM m3),
vo AS (SELECT contig_id AS entity, ((h & 9223372036854775807) % 55296)::INTEGER AS slot, CAST(sum(CASE WHEN h >> 63 = 1 THEN 1 ELSE -1 END) AS BIGINT) AS vote FROM hs GROUP BY 1, 2)"""
_FILES = "f AS (SELECT file_id, replace(replace(coalesce(max(file_text), ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM fasta_evidence GROUP BY 1)"
_RECORDS = f"""{_FILES}, p AS (SELECT file_id, string_split(chr(10) || t, chr(10) || '>') AS parts FROM f), r AS (SELECT file_id, unnest(parts) AS part, unnest(range(0, len(parts))) - 1 AS i FROM p),
x AS (SELECT file_id, i, CASE WHEN i >= 0 THEN regexp_extract(part, '^([^\\n]*)', 1) END AS header, upper(regexp_replace(CASE WHEN i >= 0 THEN regexp_replace(part, '^[^\\n]*', '') ELSE part END, '\\s+', '', 'g')) AS seq FROM r),
n AS (SELECT *, regexp_extract(header, '^([^ \\t]*)', 1) AS name FROM x)"""


def _difference(key: str, values: str) -> str:
    """Rows of a and b (key, value columns, once each) that are missing, extra or differ; values lists (fault, condition)."""
    return f"""SELECT coalesce(a.{key}, b.{key}) AS {key}, 'missing' AS fault FROM a LEFT JOIN b USING ({key}) WHERE b.{key} IS NULL
UNION ALL SELECT b.{key}, 'extra' FROM b LEFT JOIN a USING ({key}) WHERE a.{key} IS NULL {values}"""


AUDITS_SQL = {
    "archived_votes": f"WITH {_C}, {_STORED} SELECT entity AS contig_id, count(*) AS n_slots, count(*) FILTER (vote < 0) AS n_below, CAST(sum((slot + 1) * vote) AS BIGINT) AS weighed FROM vo GROUP BY 1",
    "stored_nearest": f"""WITH {_C}, {_STORED}, be AS (SELECT entity, slot FROM vo WHERE vote < 0), nb AS (SELECT contig_id AS entity, count(slot) AS n FROM c LEFT JOIN be ON be.entity = c.contig_id GROUP BY 1),
sh AS (SELECT x.entity AS query, y.entity AS ref, count(*) AS n FROM be x JOIN be y ON x.slot = y.slot WHERE x.entity % 50 = 0 AND y.entity <> x.entity GROUP BY 1, 2),
di AS (SELECT x.entity AS query, y.entity AS ref, (x.n + y.n - 2 * coalesce(sh.n, 0))::INTEGER AS dist FROM nb x JOIN nb y ON x.entity % 50 = 0 AND y.entity <> x.entity LEFT JOIN sh ON sh.query = x.entity AND sh.ref = y.entity), {_BEST}
SELECT query, ref, dist, second FROM ac""",
    "stored_index": f"WITH {_sketch(15, 64, 'sag_id')}, {_capped(1000)}, g AS (SELECT hash, count(*) AS n_entities FROM idx GROUP BY 1) SELECT n_entities, count(*) AS n_hashes FROM g GROUP BY 1",
    "best_partners": f"""WITH {_PE}, b AS (SELECT * FROM pe QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY ani DESC, af_query DESC, af_ref DESC) = 1),
d AS (SELECT a AS query, b AS ref, ani, af_query, af_ref FROM b UNION ALL SELECT b, a, ani, af_query, af_ref FROM b)
SELECT query, ref, CAST(row_number() OVER (PARTITION BY query ORDER BY ani DESC, af_query DESC, af_ref DESC, ref) AS INTEGER) AS rank, ani FROM d QUALIFY rank <= 5""",
    "edge_faults": f"""WITH {_IDS}, e AS (SELECT sag1 AS x, sag2 AS y, CASE WHEN sag1 IS NULL OR sag2 IS NULL THEN coalesce(sag1, sag2) ELSE least(sag1, sag2) END AS a, CASE WHEN sag1 IS NULL OR sag2 IS NULL THEN coalesce(sag1, sag2) ELSE greatest(sag1, sag2) END AS b FROM (SELECT DISTINCT * FROM estimate)),
w AS (SELECT * FROM e WHERE x IS NOT NULL AND y IS NOT NULL)
SELECT DISTINCT a, b, 'null_end' AS fault FROM e WHERE x IS NULL OR y IS NULL UNION ALL SELECT DISTINCT a, b, 'self_edge' FROM w WHERE x = y
UNION ALL SELECT DISTINCT a, b, 'unknown_node' FROM w WHERE a NOT IN (SELECT id FROM ids) OR b NOT IN (SELECT id FROM ids) UNION ALL SELECT a, b, 'repeated_pair' FROM w GROUP BY 1, 2 HAVING count(*) > 1""",
    "negative_closure": f"""WITH {_PE}, m AS (SELECT min(epoch_us(t)) / 2 + max(epoch_us(t)) / 2 AS m FROM pe), ev AS (SELECT a || '|' || b AS k, count(*) AS n, round(avg(ani), 3) AS p FROM pe GROUP BY 1), lv AS (SELECT a || '|' || b AS k, count(*) AS n, round(avg(ani), 3) AS p FROM pe, m WHERE epoch_us(t) <= m GROUP BY 1),
a AS (SELECT k, (97 - p) / 97 AS w FROM ev WHERE n >= 2 AND p < 97), b AS (SELECT k, (97 - p) / 97 AS w FROM lv WHERE n >= 2 AND p < 97),
d AS ({_difference('k', "UNION ALL SELECT k, 'weight_differs' FROM a JOIN b USING (k) WHERE abs(a.w - b.w) > greatest(1e-8 * greatest(abs(a.w), abs(b.w)), 1e-10)")})
SELECT split_part(k, '|', 1) AS a, split_part(k, '|', 2) AS b, fault FROM d""",
    "declared_stats": f"""WITH {_C}, s AS (SELECT DISTINCT * FROM sag WHERE id IS NOT NULL AND assembly_bp IS NOT NULL), a AS (SELECT id AS sag_id, assembly_bp AS bp, assembly_max_contig AS longest, 100.0::DOUBLE * assembly_gc / nullif(assembly_bp, 0) AS gc FROM s
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY registered_at DESC NULLS LAST, assembly_bp DESC, assembly_max_contig DESC NULLS LAST, assembly_gc DESC NULLS LAST) = 1),
b AS (SELECT sag_id, sum(length(s)) AS bp, max(length(s)) AS longest, CASE WHEN sum(length(s)) > 0 THEN round(100.0::DOUBLE * sum(length(regexp_replace(s, '[^GC]', '', 'g'))) / sum(length(s)), 5) ELSE 0 END AS gc FROM c WHERE sag_id IS NOT NULL GROUP BY 1)
{_difference('sag_id', "".join(f"UNION ALL SELECT sag_id, '{v}_differs' FROM a JOIN b USING (sag_id) WHERE a.{v} IS DISTINCT FROM b.{v} " for v in ("bp", "longest")) + "UNION ALL SELECT sag_id, 'gc_differs' FROM a JOIN b USING (sag_id) WHERE coalesce(abs(a.gc - b.gc) > 1.1e-4, a.gc IS NOT NULL OR b.gc IS NOT NULL)")}""",
    "path_links": r"""WITH w AS (SELECT DISTINCT assembly AS path, regexp_extract(assembly, '([^/]*)/*$', 1) AS name FROM sag WHERE assembly IS NOT NULL), k AS (SELECT path, regexp_extract(path, '([^/]*)/*$', 1) AS name, min(file_id) AS id FROM fasta_evidence WHERE path IS NOT NULL GROUP BY 1, 2),
n AS (SELECT name, count(*) AS n, min(id) AS id FROM k GROUP BY 1)
SELECT w.path, CASE WHEN k.id IS NOT NULL THEN 'path' WHEN n.n = 1 THEN 'name' WHEN n.n > 1 THEN 'ambiguous' ELSE 'none' END AS how, coalesce(k.id, CASE WHEN n.n = 1 THEN n.id END) AS id FROM w LEFT JOIN k ON k.path = w.path LEFT JOIN n ON n.name = w.name""",
    "pending_stats": f"""WITH {_C}, {_LATEST}, {_IDS}, st AS (SELECT sag_id, CAST(sum(length(s)) AS BIGINT) AS total_bp, CAST(max(length(s)) AS BIGINT) AS max_contig FROM c WHERE sag_id IS NOT NULL GROUP BY 1),
p AS (SELECT id AS sag_id FROM ids WHERE id NOT IN (SELECT sag FROM ls WHERE upper(species) <> 'UNCLASSIFIED')) SELECT row_number() OVER (ORDER BY sag_id) - 1 AS rank, sag_id, total_bp, max_contig FROM p JOIN st USING (sag_id)""",
    "header_members": f"""WITH {_IDS}, h AS (SELECT q AS header FROM hit WHERE q IS NOT NULL UNION SELECT t FROM hit WHERE t IS NOT NULL),
l AS (SELECT header, arg_max(id, length(id)) AS member FROM h JOIN ids ON starts_with(header, id) AND (header = id OR starts_with(substr(header, length(id) + 1), '|') OR starts_with(substr(header, length(id) + 1), '__')) GROUP BY 1)
SELECT member, count(*) AS n_headers FROM h LEFT JOIN l USING (header) GROUP BY 1""",
    "marker_pairs": f"""WITH RECURSIVE {_CC}, {_H}, big AS (SELECT component FROM cc GROUP BY 1 HAVING count(*) >= 10), tg AS (SELECT node FROM cc SEMI JOIN big USING (component)),
m AS (SELECT regexp_extract(q, '^.*(?:\\||__)(.*)$', 1) AS marker, regexp_extract(t, '^.*(?:\\||__)(.*)$', 1) AS m2, regexp_extract(q, '^(.*)(?:\\||__)', 1) AS x, regexp_extract(t, '^(.*)(?:\\||__)', 1) AS y, qe - qs AS length FROM hh WHERE q IS NOT NULL)
SELECT marker, least(x, y) AS a, greatest(x, y) AS b, max(length) AS length FROM m WHERE marker = m2 AND x <> y AND x IN (SELECT node FROM tg) AND y IN (SELECT node FROM tg) GROUP BY 1, 2, 3""",
    "fasta_faults": f"""WITH {_RECORDS}, o AS (SELECT file_id, 'text_before_record' AS fault FROM n WHERE i < 0 AND seq <> '' UNION ALL SELECT file_id, 'no_name' FROM n WHERE i >= 0 AND name = '' UNION ALL SELECT file_id, 'padded_header' FROM n WHERE i >= 0 AND regexp_matches(header, '^\\s|\\s$')
    UNION ALL SELECT file_id, 'not_ascii' FROM n WHERE regexp_matches(coalesce(header, '') || seq, '[^\\x00-\\x7F]') UNION ALL SELECT file_id, 'no_sequence' FROM n WHERE i >= 0 AND seq = '' UNION ALL SELECT file_id, 'bad_letter' FROM n WHERE i >= 0 AND regexp_matches(seq, '[^ACGTURYSWKMBDHVN]')
    UNION ALL SELECT file_id, 'no_record' FROM n GROUP BY file_id HAVING max(i) < 0 UNION ALL SELECT file_id, 'repeated_name' FROM n WHERE i >= 0 GROUP BY file_id, name HAVING count(*) > 1)
SELECT file_id, fault, count(*) AS n FROM o GROUP BY 1, 2""",
    "fasta_digests": f"""WITH {_RECORDS}, {_digest('file_id', 'd1', "(SELECT file_id, name AS x FROM n WHERE i >= 0)")}, {_digest('file_id', 'd2', "(SELECT file_id, name || chr(9) || seq AS x FROM n WHERE i >= 0)")},
st AS (SELECT file_id, count(*) AS records, CAST(sum(length(seq)) AS BIGINT) AS bases, CAST(sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) AS BIGINT) AS gc_bases, min(length(seq)) AS min_length, max(length(seq)) AS max_length FROM n WHERE i >= 0 GROUP BY 1)
SELECT st.*, d1.digest AS id_digest, d2.digest AS record_digest FROM st JOIN d1 USING (file_id) JOIN d2 USING (file_id)""",
    "strand_digest": f"WITH {_C}, k AS (SELECT sag_id, {_CALLABLE} AS x FROM c), v AS (SELECT sag_id, least(x, {_COMPLEMENT}) AS x FROM k), {_digest('sag_id')} SELECT * FROM dg",
    "estimate_summary": f"WITH {_PE} SELECT strftime(t, '%Y-%m') AS month_key, count(*) AS n, min(ani) AS low, median(ani) AS median, max(ani) AS high FROM pe GROUP BY 1",
    "run_comparison": """WITH r AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS s, max(value) AS p, min(event_type) AS x, max(event_type) AS y FROM events WHERE ts IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2)
SELECT user_id, count(*) AS n_runs, round(avg(s), 6) AS mean_seconds, round(avg(p), 6) AS mean_peak, min(x) = max(y) AS same_output FROM r GROUP BY 1""",
    "pileup": f"""WITH {_H}, e AS (SELECT t, p, CAST(sum(d) AS BIGINT) AS d FROM (SELECT t, ts AS p, 1 AS d FROM hh WHERE ts < te UNION ALL SELECT t, te, -1 FROM hh WHERE ts < te) GROUP BY 1, 2),
r AS (SELECT t, p, lead(p) OVER (PARTITION BY t ORDER BY p) AS q, CAST(sum(d) OVER (PARTITION BY t ORDER BY p) AS BIGINT) AS depth FROM e), s AS (SELECT *, unnest(range(p // 1000, (q - 1) // 1000 + 1)) AS stretch FROM r WHERE depth > 0),
l AS (SELECT *, least(q, (stretch + 1) * 1000) - greatest(p, stretch * 1000) AS n FROM s) SELECT t, stretch, max(depth) AS max_depth, CAST(sum(n) AS BIGINT) AS n_covered, CAST(sum(n * depth) AS BIGINT) AS n_aligned FROM l GROUP BY 1, 2""",
}
