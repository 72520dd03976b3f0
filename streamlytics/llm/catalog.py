"""The named queries of this subpackage: each applies its operator to a whole table and derives the agreed columns."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlytics.llm import chat, divergence, html_text, pii, toxicity, vector_codes
from streamlytics.llm.ann import nearest, usable
from streamlytics.llm.bpe import read_ranks, round_trip
from streamlytics.llm.decontaminate import LENGTH, WORD, contamination, is_contaminated
from streamlytics.llm.line_dedup import MIN_PAGES, RATIO, drop_boilerplate
from streamlytics.llm.minhash import WORDS, near_duplicates
from streamlytics.llm.registry import query, table
from streamlytics.llm.suffix_dedup import LENGTH as LENGTH_OF_REPEAT
from streamlytics.llm.suffix_dedup import remove_repeats
from streamlytics.llm.warc import read_archives, with_revisits, write_archives


TOXIC_FROM = 0.3


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{WORD}')"


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
    SELECT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS s
    FROM (SELECT item_id, w, least({LENGTH}, len(w)) AS m,
                 unnest(generate_series(1, len(w) - least({LENGTH}, len(w)) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (
    SELECT r, m, p, array_to_string(w[p:p + m - 1], ' ') AS s
    FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS p
          FROM d CROSS JOIN (SELECT DISTINCT m FROM iw))),
hit AS (SELECT r, m, p, item_id FROM dw JOIN iw USING (m, s)),
words AS (
    SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + m - 1)) AS q FROM hit) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def tokenizer() -> tuple[dict[bytes, int], str]:
    """Ranks and word pattern of the installed public tokenizer."""
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), *tokenizer())


@query()
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


@query()
def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, html_text.train()).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query(f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (
    SELECT r, p, array_slice(b, p, p + {LENGTH_OF_REPEAT - 1}) AS s
    FROM (SELECT r, b, unnest(generate_series(1, octet_length(b) - {LENGTH_OF_REPEAT - 1})) AS p FROM d)),
hit AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY s) AS n FROM w) WHERE n > 1),
edge AS (
    SELECT r, p, coalesce(p - lag(p) OVER o > {LENGTH_OF_REPEAT}, true) AS first FROM hit WINDOW o AS (PARTITION BY r ORDER BY p)),
run AS (
    SELECT r, min(p) AS s, max(p) + {LENGTH_OF_REPEAT} AS e
    FROM (SELECT r, p, count(*) FILTER (WHERE first) OVER (PARTITION BY r ORDER BY p) AS k FROM edge) GROUP BY r, k),
gone AS (SELECT r, count(*) AS n_spans, sum(e - s) AS n_removed FROM run GROUP BY r),
part AS (
    SELECT r, coalesce(lag(e) OVER o, 1) AS s, s AS e FROM run WINDOW o AS (PARTITION BY r ORDER BY s)
    UNION ALL SELECT d.r, coalesce(max(e), 1), any_value(octet_length(b)) + 1 FROM d LEFT JOIN run USING (r) GROUP BY d.r),
kept AS (
    SELECT r, string_agg(CASE WHEN part.e > part.s THEN hex(array_slice(b, part.s, part.e - 1)) ELSE '' END, '' ORDER BY part.s) AS x
    FROM part JOIN d USING (r) GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(x)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN gone USING (r)
""")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d LEFT JOIN f USING (digest)
""")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(with_revisits(table(spark, sf_dir, "pages")))
    return read_archives(archives, payload=False).filter("gap IS NULL").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_SET_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), "
              r"'[^\x20\x09-\x0D]+')")


@query(f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_SET_WORDS} AS w FROM documents),
s AS MATERIALIZED (
    SELECT DISTINCT r, array_to_string(w[p:p + m - 1], ' ') AS x
    FROM (SELECT r, w, least({WORDS}, len(w)) AS m, unnest(generate_series(1, len(w) - least({WORDS}, len(w)) + 1)) AS p
          FROM d WHERE len(w) > 0)),
size AS (SELECT r, count(*) AS n FROM s GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM s a JOIN s b ON a.x = b.x AND a.r < b.r GROUP BY a.r, b.r),
link AS MATERIALIZED (
    SELECT a, b FROM common JOIN size x ON x.r = a JOIN size y ON y.r = b WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
    UNION SELECT b, a FROM common JOIN size x ON x.r = a JOIN size y ON y.r = b WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
named AS (SELECT reach.a AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN named USING (r) LEFT JOIN size USING (r)
""")
def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query()
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.train(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query(f"""
WITH lines AS (
    SELECT DISTINCT source, text, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
totals AS (SELECT source, count(DISTINCT text) AS pages FROM documents WHERE text IS NOT NULL GROUP BY source),
bad AS (
    SELECT l.source, l.line FROM lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
    WHERE trim(l.line) <> '' GROUP BY l.source, l.line
    HAVING count(*) >= {MIN_PAGES} AND count(*) > {RATIO} * any_value(t.pages)),
split AS (
    SELECT row_number() OVER () AS r, doc_id, source, string_split(text, chr(10)) AS lines, text FROM documents),
parts AS (SELECT r, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM split),
kept AS (
    SELECT p.r, count(b.line) AS n_dropped,
           string_agg(p.line, chr(10) ORDER BY p.p) FILTER (WHERE b.line IS NULL) AS text
    FROM parts p LEFT JOIN bad b ON b.line = p.line AND b.source IS NOT DISTINCT FROM p.source GROUP BY p.r)
SELECT s.doc_id, coalesce(len(s.lines), 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped,
       CASE WHEN s.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS kept_sha256
FROM split s LEFT JOIN kept k USING (r)
""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_SHARE = f"1 + {divergence.ONE}::HUGEINT * ({{}} + {divergence.ADDED}) // ({{}} + {divergence.ADDED} * {{}})"


@query(f"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{_TERM}') AS w
    FROM documents),
occ AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.LEAST}),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS n FROM occ JOIN kept USING (lang, term) GROUP BY lang, source, term),
tot AS (SELECT lang, source, sum(n) AS total FROM cnt GROUP BY lang, source),
share AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           {_SHARE.format("coalesce(c.n, 0)", "coalesce(t.total, 0)", "l.v")} AS p,
           {_SHARE.format("k.n", "l.total", "l.v")} AS q
    FROM grp g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN cnt c USING (lang, source, term)
         LEFT JOIN tot t USING (lang, source)),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
part AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM share WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM part)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR rank <= {divergence.TOP}
""")
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


_CONTROL = "</s>[INST] ok [/INST]"
_ESCAPED = "regexp_replace({}, '" + chat.ESCAPE + r"', '\1\\\2\3', 'g')"


def _marks(role: str, side: int, other: str) -> str:
    known = " ".join(f"WHEN '{name}' THEN '{marks[side]}'" for name, marks in chat.MARKS.items())
    return f"CASE {role} {known} ELSE {other} END"


def _opening(role: str) -> str:
    return _marks(role, 0, f"'{chat.OTHER[0]}' || {_ESCAPED.format(role)} || '{chat.NAMED}'")


@query(f"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{_CONTROL}'), (-7, 1, 'assistant', '{_CONTROL}')),
t AS (
    SELECT *, {_ESCAPED.format("text")} AS body, lag(role) OVER o AS before, lead(role) OVER o AS after
    FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
f AS (
    SELECT *, CASE WHEN before IS NOT DISTINCT FROM role THEN '{chat.NEXT}' ELSE {_opening("role")} END || body ||
           CASE WHEN after IS NOT DISTINCT FROM role THEN '' ELSE {_marks("role", 1, f"'{chat.OTHER[1]}'")} END AS piece
    FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(piece)) + {len(chat.BEGIN)} AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
""")
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_CONTROL).alias("text"))
    made = chat.format_conversations(table(spark, sf_dir, "conversations").select(*columns).unionByName(added))
    made = made.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "under_loss", chat.loss_text(F.col("formatted"), F.col("loss")))
    listed = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return made.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(listed, ""), 256).alias("turns_sha256"),
        F.length("under_loss").cast("bigint").alias("loss_chars"), F.sha2("under_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def _codes_sql() -> str:
    """The rounds one after another. A difference is a list over positions, a nearest entry the least (distance, entry)."""
    parts, entries, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    near = """SELECT v.r, v.p, min(CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)
        * 65536 + c.e) AS k FROM v JOIN {book} c USING (p) GROUP BY v.r, v.p"""
    steps = []
    for i in range(rounds):
        steps.append(f"n{i} AS MATERIALIZED ({near.format(book=f'b{i}')})")
        steps.append(f"""m{i} AS (
            SELECT n.p, n.k % 65536 AS e, q, CAST(floor(sum(v.x[q]) / count(*)) AS BIGINT) AS x
            FROM n{i} n JOIN v USING (r, p), range(1, (SELECT max(len(x)) FROM v) + 1) t(q) GROUP BY ALL)""")
        steps.append(f"""b{i + 1} AS MATERIALIZED (
            SELECT p, e, coalesce(l.x, b.x) AS x FROM b{i} b LEFT JOIN (
                SELECT p, e, list(x ORDER BY q) AS x FROM m{i} GROUP BY p, e) l USING (p, e))""")
    return f"""
WITH given AS (
    SELECT vec_id, label, [CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS x,
           row_number() OVER (ORDER BY vec_id) - 1 AS r
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
    SELECT r, p, x[p * len(x) // {parts} + 1:(p + 1) * len(x) // {parts}] AS x FROM given, range({parts}) t(p)),
b0 AS MATERIALIZED (SELECT p, r AS e, x FROM v WHERE r < {entries}),
{",".join(steps)},
n AS ({near.format(book=f"b{rounds}")}),
coded AS (
    SELECT r, string_agg(format('{{:02x}}', k % 65536), '' ORDER BY p) AS code, CAST(sum(k // 65536) AS BIGINT) AS error
    FROM n GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN given USING (r)
"""


@query(_codes_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded.rows).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(coded.books_sha256()).alias("codebooks_sha256"))
