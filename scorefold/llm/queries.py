"""The named queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorefold.llm import codes, dedup, langid, lattice, mixing, packing, quality, repeats, simhash, spelling, topk, toxicity, warc
from scorefold.llm.common import table


def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.document_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.likelihood(table(spark, sf_dir, "documents"))


def op6_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.shared_passages(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.document_language(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixture, op2_exact_dedup, op3_quality, op4_warc, op5_lattice, op6_top_inner_products, op7_packing, op8_simhash,
        op9_repeats, op10_toxicity, op11_vector_codes, op12_spelling, op13_language,
    )
}

#: The number of words, without the empty piece that leading or trailing blanks leave.
_SIZE = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

#: The checksum of a text of code points below U+0100, in a query that joins `crc(steps)`.
_CRC_TABLE = """crc AS (
  SELECT list(c ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), list_transform(range(8), lambda k: CAST(k AS BIGINT))),
      lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c
    FROM range(256) r(i)))"""


def _crc(text: str) -> str:
    points = f"list_transform(string_split({text}, ''), lambda c: CAST(unicode(c) AS BIGINT))"
    octets = f"flatten(list_transform({points}, lambda u: CASE WHEN u < 128 THEN [u] ELSE [192 + (u >> 6), 128 + (u & 63)] END))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])))"


def _vector_codes_sql(parts: int = codes.PARTS, entries: int = codes.ENTRIES, rounds: int = codes.ROUNDS) -> str:
    """Every part against every entry, round by round."""
    square = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (SELECT p, row_id, e, {square} AS d FROM parts JOIN c{r} USING (p)),
a{r} AS (SELECT p, row_id, min(d) AS d, arg_min(e, {{d: d, e: e}}) AS e FROM d{r} GROUP BY p, row_id)""")
        if r < rounds:  # a floored quotient: DuckDB's // cuts towards zero
            steps.append(f"""
s{r} AS (
  SELECT p, e, j, sum(x[j]) AS s, count(*) AS n FROM a{r} JOIN parts USING (p, row_id), range(1, (SELECT max(len(x)) + 1 FROM parts)) t(j) GROUP BY p, e, j),
m{r} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM s{r} GROUP BY p, e),
c{r + 1} AS (SELECT p, e, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (p, e))""")
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row_id, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT row_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM v, range({parts}) r(p)),
c0 AS (SELECT p, row_id - 1 AS e, x AS c FROM parts WHERE row_id <= {entries}),{",".join(steps)},
coded AS (SELECT row_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY row_id),
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (row_id), books"""


SQL = {
    "op11_vector_codes": _vector_codes_sql(),
    # two words are one edit apart if one is the other without a character, or both are equal without the same one
    "op12_spelling": f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, k, {_crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM slipped WHERE len(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM words, range(60) t(i) WHERE i < len(word)),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b USING (rest, i) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
near AS (SELECT word, count(*) AS n_near, arg_min(other, {{m: -n, o: other}}) AS other, max(n) AS other_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN near USING (word)),
way AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT way.word, f.word, f.form FROM way JOIN forms f ON f.word = way.next)
SELECT f.word, f.form, w.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN way w ON w.word = f.word AND w.next IS NULL""",
    "op13_language": f"""
WITH {_CRC_TABLE},
docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, coalesce({_crc("CAST(doc_id AS VARCHAR)")} % 3 = 1, false) AS held_out,
    regexp_extract_all(lower(text), '\\p{{L}}+') AS runs
  FROM documents, crc),
padded AS (SELECT row_id, ' ' || run || ' ' AS w, count(*) AS k FROM (SELECT row_id, unnest(runs) AS run FROM docs) GROUP BY ALL),
grams AS (
  SELECT row_id, g, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT row_id, substr(w, i, size) AS g, k FROM padded, range(1, 4) s(size), range(1, (SELECT max(len(w)) + 1 FROM padded)) t(i)
    WHERE i + size - 1 <= len(w)) WHERE g <> ' ' GROUP BY ALL),
own AS (SELECT row_id, g, row_number() OVER (PARTITION BY row_id ORDER BY n DESC, g) - 1 AS r FROM grams QUALIFY r < {langid.GRAMS}),
profiles AS (
  SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, g) - 1 AS r FROM grams JOIN docs USING (row_id)
  WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, g QUALIFY r < {langid.GRAMS}),
sizes AS (SELECT row_id, count(*) * {langid.GRAMS} AS most FROM own GROUP BY row_id),
hits AS (SELECT row_id, lang, sum({langid.GRAMS} - abs(o.r - p.r)) AS saved FROM own o JOIN profiles p USING (g) GROUP BY row_id, lang),
all_of AS (
  SELECT row_id, lang, most, most - coalesce(saved, 0) AS d FROM sizes CROSS JOIN (SELECT DISTINCT lang FROM profiles) LEFT JOIN hits USING (row_id, lang)),
best AS (SELECT row_id, arg_min(lang, {{d: d, l: lang}}) AS lang, CAST(min(d) AS DOUBLE) AS d, any_value(most) AS most FROM all_of GROUP BY row_id)
SELECT doc_id, held_out, coalesce(best.lang, 'und') AS lang_pred, coalesce(1 - d / most, 0.0) AS score FROM docs LEFT JOIN best USING (row_id)""",
    # what the schedule takes of a source is the start of its shuffled text, gone through again and again
    "op1_mixture": f"""
WITH docs AS (SELECT doc_id, source, {_SIZE} AS size, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
ranked AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS w FROM sources),
levels AS (
  SELECT *, row_number() OVER l AS pos,
    CAST((sum(source_size) OVER ()) - coalesce(sum(3 * source_size) OVER (l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / CAST(sum(w) OVER (l ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM ranked WINDOW l AS (ORDER BY CAST(3 * source_size AS DOUBLE) / w, source IS NULL, source)),
chosen AS (SELECT min_by(level, pos) AS level FROM levels WHERE level * w <= 3 * source_size),
targets AS (SELECT l.source, l.source_size, least(CAST(3 * l.source_size AS DOUBLE), c.level * l.w) AS target FROM levels l, chosen c),
placed AS (
  SELECT d.*, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS take,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(CASE WHEN size = 0 THEN 0 ELSE (take // source_size) * size + greatest(0, least(size, take % source_size - start)) END AS BIGINT) AS taken
FROM placed""",
    "op2_exact_dedup": r"""
WITH docs AS (SELECT doc_id, coalesce(length(text), 0) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS own FROM documents),
ranked AS (
  SELECT doc_id, own, first_value(doc_id) OVER g AS keep_id, row_number() OVER g AS r, count(*) OVER (PARTITION BY own) AS n
  FROM docs WINDOW g AS (PARTITION BY own ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, CAST(n AS BIGINT) AS group_size, r = 1 AS kept, sha256(own) AS text_sha256 FROM ranked""",
    "op4_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM g""",
    "op6_top_inner_products": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
