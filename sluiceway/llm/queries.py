"""The operators of this subpackage over the given tables, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import chat, repair, warc
from sluiceway.llm.ann import nearest_neighbours
from sluiceway.llm.bond import mine_negatives
from sluiceway.llm.decontaminate import find_leaks
from sluiceway.llm.licenses import DICE, RUN_PARAGRAPHS, TEMPLATES, bigrams_of, scan_licenses
from sluiceway.llm.line_dedup import LONG_LINE, MEAN_LINES, MIN_WORDS, dedup_lines
from sluiceway.llm.maxent import score_texts
from sluiceway.llm.mixing import mix
from sluiceway.llm.mtree import exact_top
from sluiceway.llm.ngram_join import jaccard_components
from sluiceway.llm.quality import score_quality
from sluiceway.llm.staging import stage
from sluiceway.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORD = r"[^\x20\x09-\x0D]+"

MIX_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, sum(2.0::DOUBLE * source_size) OVER cut - 2.0::DOUBLE * source_size AS capped,
    sum(w) OVER () - (sum(w) OVER cut - w) AS open_w, sum(source_size) OVER () AS everything,
    row_number() OVER cut AS k
  FROM s WINDOW cut AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
r AS (
  SELECT *, (1.5::DOUBLE * everything - capped) / open_w AS rate FROM o),
rate AS (SELECT rate FROM r WHERE rate * w <= 2.0::DOUBLE * source_size ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_size, least(coalesce(w * (SELECT rate FROM rate), 2.0::DOUBLE * source_size), 2.0::DOUBLE * source_size) AS target
  FROM s),
g AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.target >= t.source_size THEN 1 ELSE 0 END AS base,
    sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, sum(size) OVER (PARTITION BY source, h) AS alike FROM g)
SELECT doc_id, size, source_size, target,
  (size * (base + CASE WHEN 2 * upto - alike <= 2 * (target - base * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x
"""


@query(MIX_SQL)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, (5, 2, 1), 1.5, 2.0).select("doc_id", "size", "source_size", "target", "taken")


JOIN_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM link UNION SELECT b, a FROM link) l ON l.a = r.b)
SELECT r.a AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM reach r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""


@query(JOIN_SQL)
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs, 3, 90).select("doc_id", "n_shingles", "component_id")


def _license_sql() -> str:
    known = {n: ps for n, ps in ((n, bigrams_of(t)) for n, t in TEMPLATES.items()) if ps}
    long = {n: str("\n\n" in TEMPLATES[n]).lower() for n in known}
    values = ",\n  ".join("('{}', [{}], {})".format(n, ", ".join(f"'{p}'" for p in ps), long[n]) for n, ps in known.items())
    over, under = DICE
    return rf"""
WITH t(license, pairs, long) AS (VALUES {values}),
par AS (SELECT doc_id, regexp_split_to_array(text, '\n[ \t\r]*\n') AS p FROM documents),
u AS (
  SELECT doc_id, 'text' AS unit, 0 AS unit_no, text AS body FROM documents
  UNION ALL SELECT doc_id, 'line', unnest(range(1, len(p) + 1)), unnest(p)
    FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents) WHERE len(p) > 1
  UNION ALL SELECT doc_id, 'paragraph', unnest(range(1, len(p) + 1)), unnest(p)
    FROM par WHERE len(p) > 1
  UNION ALL SELECT doc_id, 'run ' || n, i, array_to_string(p[i:i + n - 1], chr(10))
    FROM par, range(2, {RUN_PARAGRAPHS + 1}) t(n), range(1, len(p) - n + 2) s(i)),
w AS (SELECT doc_id, unit, unit_no, list_filter(regexp_split_to_array(lower(body), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM u),
p AS (
  SELECT doc_id, unit, unit_no, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs
  FROM w WHERE len(w) > 1),
m AS (
  SELECT doc_id, unit, unit_no::INT AS unit_no, license, len(list_intersect(p.pairs, t.pairs))::INT AS shared,
    len(p.pairs)::INT AS unit_bigrams, len(t.pairs)::INT AS template_bigrams
  FROM p, t WHERE long OR unit NOT LIKE 'run%')
SELECT *, 2 * shared / (unit_bigrams + template_bigrams) AS dice FROM m
WHERE {2 * under} * shared >= {over} * (unit_bigrams + template_bigrams)
"""


@query(_license_sql())
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


@query()
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


LINES_SQL = rf"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
h AS (
  SELECT *, len(regexp_extract_all(line, '{_WORD}')) AS w, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM l),
e AS (
  SELECT *, coalesce(w >= {LONG_LINE} OR lead(w) OVER o >= {LONG_LINE}
    OR (h * 31 + coalesce(lag(h) OVER o, 0)) % {MEAN_LINES} = 0, false) AS last_line
  FROM h WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
-- lines with their chunk, the words up to them, and their place among the lines with words
k AS (
  SELECT *, coalesce(sum(last_line::INT) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
    sum(w) OVER (o ROWS UNBOUNDED PRECEDING) AS upto, sum((w > 0)::INT) OVER (o ROWS UNBOUNDED PRECEDING) AS r
  FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c AS (
  SELECT doc_id, pos, string_agg(line, chr(10) ORDER BY i) AS chunk, min(i) AS a, max(i) AS b, sum(w) AS w,
    min(r) FILTER (w > 0) AS top, max(r) AS bottom
  FROM k GROUP BY doc_id, pos),
o AS (
  SELECT *, first_value(doc_id) OVER f AS hd, first_value(top) OVER f AS ht, first_value(bottom) OVER f AS hb, row_number() OVER f AS copy
  FROM c WHERE w > 0 WINDOW f AS (PARTITION BY chunk ORDER BY doc_id, pos)),
m AS (SELECT * FROM o WHERE copy > 1),
-- equal lines beside a repeated chunk and the copy that stays, nearest first, up to {MIN_WORDS} words away
x AS (
  SELECT m.doc_id, m.pos, s.side, s.d, own.i, own.line = other.line AS same,
    sum(own.w) OVER (PARTITION BY m.doc_id, m.pos, s.side ORDER BY s.d) - own.w AS nearer,
    bool_and(coalesce(own.line = other.line, false)) OVER (PARTITION BY m.doc_id, m.pos, s.side ORDER BY s.d) AS so_far
  FROM m, (SELECT d, side FROM range(1, {MIN_WORDS} + 1) t(d), (VALUES (1), (2)) u(side)) s
  JOIN k own ON own.doc_id = m.doc_id AND own.w > 0 AND own.r = CASE s.side WHEN 1 THEN m.top - s.d ELSE m.bottom + s.d END
  LEFT JOIN k other ON other.doc_id = m.hd AND other.w > 0 AND other.r = CASE s.side WHEN 1 THEN m.ht - s.d ELSE m.hb + s.d END),
z AS (
  SELECT DISTINCT m.doc_id, least(m.a, coalesce(min(x.i), m.a)) AS a, greatest(m.b, coalesce(max(x.i), m.b)) AS b
  FROM m LEFT JOIN x ON x.doc_id = m.doc_id AND x.pos = m.pos AND x.so_far AND x.nearer < {MIN_WORDS}
  GROUP BY m.doc_id, m.pos, m.a, m.b),
-- spans run together where no words stand between them
y AS (
  SELECT doc_id, a, b, max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM z),
v AS (
  SELECT y.*, coalesce(p.upto, 0) - coalesce(q.upto, 0) > 0 OR y.before IS NULL AS opens
  FROM y LEFT JOIN k p ON p.doc_id = y.doc_id AND p.i = y.a - 1 LEFT JOIN k q ON q.doc_id = y.doc_id AND q.i = y.before),
n AS (SELECT *, sum((opens)::INT) OVER (PARTITION BY doc_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM v),
g AS (
  SELECT n.doc_id, min(a) AS a, max(b) AS b FROM n GROUP BY n.doc_id, run),
gone AS (
  SELECT g.* FROM g JOIN k t ON t.doc_id = g.doc_id AND t.i = g.b LEFT JOIN k f ON f.doc_id = g.doc_id AND f.i = g.a - 1
  WHERE t.upto - coalesce(f.upto, 0) >= {MIN_WORDS}),
j AS (SELECT k.doc_id, k.i, k.line, gone.a IS NOT NULL AS gone FROM k LEFT JOIN gone ON gone.doc_id = k.doc_id AND k.i BETWEEN gone.a AND gone.b)
SELECT j.doc_id, CASE WHEN any_value(d.missing) THEN NULL ELSE coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') END AS text,
  coalesce(count(*) FILTER (gone), 0)::INT AS lines_removed
FROM j JOIN (SELECT doc_id, text IS NULL AS missing FROM documents) d ON d.doc_id = j.doc_id GROUP BY j.doc_id
"""


@query(LINES_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))


def _escaped(text: str) -> str:
    for c in "\\<[]":
        text = f"replace({text}, '{c}', '\\{c}')"
    return text


CHAT_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (
  SELECT conv_id, string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, md5(role || chr(10) || text)) AS loss,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, md5(role || chr(10) || text)) AS turns, count(*) AS n,
    sum(length({_escaped("text")}) + CASE role WHEN 'assistant' THEN 5 WHEN 'user' THEN 15 ELSE 14 + length({_escaped("role")}) END) + 3 AS f
  FROM c GROUP BY conv_id)
SELECT conv_id, n::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  f::BIGINT AS formatted_chars
FROM l
"""


@query(CHAT_SQL)
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(chat.turn_events(turns.union(more))))


@query()
def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return nearest_neighbours(rows, rows.where("vec_id % 20 = 0"), 20)


@query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query()
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"))


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS head FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(hex, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = head THEN NULL ELSE head END AS refers_to
FROM r
"""


@query(WARC_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = scratch_path(spark, "warc")
    warc.write_warc(read(spark, sf_dir, "pages"), archives)
    index = warc.merge_index(warc.read_runs(spark, archives))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT DISTINCT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""


@query(TOP_SQL)
def op11_exact_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return exact_top(rows, rows.where("vec_id % 100 = 0"), 10, 1024)


REPAIR_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS b))),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations),
crc AS (
  SELECT raw.*, xor(list_reduce([4294967295] || list_transform(string_split(k, ''), lambda x: ord(x)::BIGINT),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c // 256)), 4294967295) % 20 AS kind
  FROM raw, tab),
d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM crc WHERE kind <> 0),
o AS (
  SELECT *, row_number() OVER w AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    substr(role, 1, 1) AS c, substr(lag(role) OVER w, 1, 1) AS p,
    regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS last_char
  FROM d
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || ':' || text), copy)),
r AS (
  SELECT *, last_char = '' AS blank, last_char <> '' AND again AS dup, last_char NOT IN ('', '.', '!', '?') AND NOT again AS cut FROM o),
-- costs by row and state: nothing yet, after a system, user, assistant row
e AS (
  SELECT conv_id, i, role, text, blank OR dup AS bad, 3 * cut::INT AS more, c FROM r),
n AS (SELECT conv_id, max(i) AS n FROM e GROUP BY conv_id),
b(conv_id, i, b0, b1, b2, b3) AS (
  SELECT conv_id, n + 1, 0, 6, 3, 0 FROM n
  UNION ALL
  SELECT conv_id, i, least(r0, 3 + r2, 6 + r3), least(r1, 3 + r2, 6 + r3), least(r2, 3 + r3), least(r3, 3 + r2)
  FROM (
    SELECT e.conv_id, e.i,
      least(4 + b0, CASE WHEN bad THEN 999999999 ELSE more + least(CASE c WHEN 's' THEN b1 WHEN 'u' THEN b2 ELSE 999999999 END, 3 + b2) END) AS r0,
      least(4 + b1, CASE WHEN bad THEN 999999999 ELSE more + least(CASE c WHEN 'u' THEN b2 ELSE 999999999 END, 3 + b2) END) AS r1,
      least(4 + b2, CASE WHEN bad THEN 999999999 ELSE more + least(CASE c WHEN 'a' THEN b3 ELSE 999999999 END, 3 + b3) END) AS r2,
      least(4 + b3, CASE WHEN bad THEN 999999999 ELSE more + least(CASE c WHEN 'u' THEN b2 ELSE 999999999 END, 3 + b2) END) AS r3
    FROM b JOIN e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.i = b.i - 1)),
l AS (SELECT conv_id, i, [b0, b1, b2, b3] AS cost FROM b),
x AS (
  SELECT l.conv_id, l.i, l.cost, z.cost AS after, e.role, e.text, e.bad, e.more, e.c
  FROM l LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM l.conv_id AND e.i = l.i
  LEFT JOIN l z ON z.conv_id IS NOT DISTINCT FROM l.conv_id AND z.i = l.i + 1),
-- the least initial of an optimal edit, step by step; states are 1 to 4
f(conv_id, i, s, audit, said) AS (
  SELECT conv_id, 1::BIGINT, 1, '', ''::VARCHAR FROM n
  UNION ALL
  SELECT conv_id, CASE WHEN edit = 'I' THEN i ELSE i + 1 END,
    CASE edit WHEN 'D' THEN s WHEN 'K' THEN CASE WHEN c = 's' THEN 2 ELSE nx END ELSE nx END,
    audit || edit,
    CASE edit WHEN 'D' THEN said ELSE said || chr(10) || CASE WHEN edit = 'K' THEN role WHEN nx = 3 THEN 'user' ELSE 'assistant' END || ':'
      || CASE edit WHEN 'I' THEN '' ELSE text END END
  FROM (
    SELECT *, CASE
      WHEN after IS NOT NULL AND 4 + after[s] = cost[s] THEN 'D'
      WHEN 3 + cost[nx] = cost[s] THEN 'I'
      WHEN NOT bad AND c = 's' AND s = 1 AND more + after[2] = cost[s] THEN 'K'
      WHEN NOT bad AND c = CASE nx WHEN 3 THEN 'u' ELSE 'a' END AND more + after[nx] = cost[s] THEN 'K'
      ELSE 'R' END AS edit
    FROM (
      SELECT f.*, CASE f.s WHEN 3 THEN 4 ELSE 3 END AS nx, x.cost, x.after, x.role, x.text, x.bad, x.more, x.c
      FROM f JOIN x ON x.conv_id IS NOT DISTINCT FROM f.conv_id AND x.i = f.i)
    WHERE after IS NOT NULL OR cost[s] > 0)),
-- a conversation's last step is its longest audit
done AS (SELECT conv_id, arg_max(audit, len(audit)) AS audit, arg_max(said, len(audit)) AS said FROM f GROUP BY conv_id),
a AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (i > 1 AND coalesce(p, '') || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(l.cost[1], 0)::BIGINT AS cost, coalesce(done.audit, '') AS audit, sha256(coalesce(substr(done.said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q
LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM q.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM q.conv_id
LEFT JOIN l ON l.conv_id IS NOT DISTINCT FROM q.conv_id AND l.i = 1
"""


@query(REPAIR_SQL)
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    rows = repair.damaged(turns)
    audits = stage(repair.audit_conversations(rows, turns), "repair-audits")
    texts = repair.digests(repair.repaired(rows, audits)).withColumnRenamed("conv_id", "of")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    told = audits.join(texts, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    return told.withColumn("repaired_sha256", F.coalesce("repaired_sha256", nothing))


NEGATIVES_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INT AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


@query(NEGATIVES_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine_negatives(moved, F.col("vec_id") % 50 == 0, 5, 3, (50, 95), 256)
