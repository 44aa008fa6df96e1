"""The registered queries of the training-text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm import (
    chat,
    merkle,
    minmax,
    mixing,
    packing,
    paths,
    periods,
    ppm,
    quality,
    sanitise,
    separators,
    toxicity,
    variants,
)
from statloom.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.examples(turns.unionByName(planted)))


# An example is a prefix of the conversation's text: its length is a running sum. A turn is its
# role and text, escaped (one backslash for each control string), and 12 + 10 + 10 characters.
ORACLE["op1_chat_prefix_targets"] = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(role) + length(text) + 32
    + len(regexp_extract_all(role || chr(10) || text,
        '[<\[]\\*(?:/?s>|/?INST\]|/?SYS>>|\|(?:im_start|im_sep|im_end|endoftext)\|>)')) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM given),
summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM sized)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR k = n)::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""


@query
def op4_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(read(spark, sf_dir, "documents"), size=3, percent=85)


# Shingles are their words joined by a space, which no word holds. Pairs are found exactly: those
# that share a shingle are counted by a join, without any hashing. Small tables only.
ORACLE["op4_minmax_near_dedup"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3
    THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
  FROM worded),
sized AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
classed AS (
  SELECT doc_id, n, min(doc_id) OVER (PARTITION BY sig) AS rep
  FROM (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS sig
        FROM shingled GROUP BY doc_id)),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id < b.doc_id
  WHERE a.doc_id IN (SELECT rep FROM classed) AND b.doc_id IN (SELECT rep FROM classed)
  GROUP BY ALL),
linked AS (
  SELECT x, y FROM shared JOIN sized p ON x = p.doc_id JOIN sized q ON y = q.doc_id
  WHERE 100 * common >= 85 * (p.n + q.n - common)),
edges AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reached AS (
  SELECT DISTINCT rep AS a, rep AS b FROM classed
  UNION SELECT a, y FROM reached JOIN edges ON b = x),
labelled AS (SELECT a, min(b) AS component FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
  coalesce(component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN classed c ON d.doc_id = c.doc_id LEFT JOIN labelled ON rep = a
"""


@query
def op3_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.identify(read(spark, sf_dir, "documents"))


@query
def op8_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


# Quartiles are values of the group (quantile_disc), as the sketch gives them while it holds all.
ORACLE["op8_adaptive_quality"] = r"""
WITH worded AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, w, range(1, greatest(len(w) - 1, 1)) AS places,
    list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: array_to_string(w[i:i + 2], ' ')) AS grams
  FROM worded),
again AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS times
              FROM (SELECT doc_id, unnest(places) AS i, unnest(grams) AS x FROM windows))
        WHERE times > 1)
  GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(l) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
  FROM worded LEFT JOIN again USING (doc_id)),
rated AS (
  SELECT *, n_symbols / nullif(n_words, 0) AS symbol_rate,
    n_dup_lines / nullif(n_lines, 0) AS dup_line_rate,
    n_repeat_words / nullif(n_words, 0) AS repeat_rate,
    n_capitals / nullif(word_chars, 0) AS capital_rate,
    word_chars / nullif(n_words, 0) AS word_length FROM counted),
grouped AS (SELECT lang, source, count(symbol_rate) AS n FROM rated GROUP BY ALL),
languages AS (SELECT lang, sum(n) AS n FROM grouped GROUP BY ALL),
levels AS (
  SELECT g.lang, g.source, CASE WHEN g.n >= 200 THEN 0 WHEN l.n >= 200 THEN 1 ELSE 2 END AS up
  FROM grouped g JOIN languages l ON g.lang IS NOT DISTINCT FROM l.lang),
limits AS (
  SELECT v.lang, v.source, {limits}
  FROM levels v JOIN rated r ON (up = 2 OR v.lang IS NOT DISTINCT FROM r.lang)
    AND (up > 0 OR v.source IS NOT DISTINCT FROM r.source)
  GROUP BY v.lang, v.source),
based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM rated)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {fine} AS kept
FROM based b LEFT JOIN limits l
  ON b.lang IS NOT DISTINCT FROM l.lang AND b.source IS NOT DISTINCT FROM l.source
""".format(
    limits=", ".join(
        "{high} + {reach} * greatest({high} - {low}, {least}) AS {r}_max, "
        "{low} - {reach} * greatest({high} - {low}, {least}) AS {r}_min".format(
            r=r, reach=quality.REACH, least=least, **{
                name: f"coalesce(quantile_disc(nullif({r}, 0), {q}), 0)" if r in quality.WHERE_ANY
                else f"quantile_disc({r}, {q})" for name, q in (("low", 0.25), ("high", 0.75))})
        for r, least in quality.RATES.items()),
    fine=" AND ".join([f"coalesce({r} <= {r}_max, false)" for r in quality.RATES]
                      + [f"coalesce({r} >= {r}_min, false)" for r in quality.TWO_SIDED]))


@query
def op10_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


ORACLE["op10_systematic_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce('+' || source, '-') AS name,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
sources AS (
  SELECT name, sum(size)::BIGINT AS source_size,
    list_extract([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE],
      (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS weight
  FROM sized GROUP BY name, source),
ratios AS (SELECT *, source_size::DOUBLE * 2 AS most, source_size::DOUBLE * 2 / weight AS ratio,
  sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS total FROM sources),
levels AS (
  SELECT *, (total - coalesce(sum(most) OVER (ORDER BY ratio, name
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY ratio, name ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    AS level FROM ratios),
planned AS (
  SELECT name, source_size, CASE WHEN level < ratio
    THEN max(level) FILTER (level < ratio) OVER () * weight ELSE most END AS target,
    ('0x' || md5('10:' || name)[1:12])::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS off
  FROM levels),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY size, key, doc_id) AS rank FROM sized),
stepped AS (
  SELECT r.*, p.source_size, target, off,
    CASE WHEN p.source_size > 0 THEN target / p.source_size ELSE 0 END AS step
  FROM ranked r JOIN planned p USING (name))
SELECT doc_id, size, source_size, target,
  ((floor(off + step * rank) - floor(off + step * (rank - 1))) * size)::BIGINT AS taken
FROM stepped
"""


@query
def op5_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op6_information_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.report(read(spark, sf_dir, "documents"))


@query
def op7_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_neighbours(read(spark, sf_dir, "documents"))


@query
def op9_order_preserving_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op2_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A document's file and its place there differ from run to run.
    return separators.token_counts(read(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


#: crc32 of a list of bytes, as DuckDB has none: the table of 256 entries, and the steps over the bytes.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT)) AS t)"""
_CRC = """xor(list_reduce({0}, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]),
    4294967295::BIGINT), 4294967295)"""


@query
def op13_descending_lcp_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(periods.find(periods.planted(read(spark, sf_dir, "documents"))))


# Runs are found without suffixes: places with equal five-word windows at one distance, in a row.
ORACLE["op13_descending_lcp_runs"] = r"""
WITH {table},
given AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    {crc} AS h
  FROM documents, crc),
placed AS (
  SELECT *, h // 10 % greatest(len(w), 1) AS a, h % 10 = 0 AND len(w) > 0 AS hit FROM given),
stepped AS (SELECT *, 1 + (len(w) - a) // (3 + h // 10 % 8) AS p FROM placed),
worded AS (
  SELECT doc_id, CASE WHEN hit THEN list_transform(range(len(w)),
    lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM stepped),
grams AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS g, len(w) AS n
  FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM worded)),
met AS (
  SELECT x.doc_id, x.i, y.i - x.i AS d FROM grams x JOIN grams y
    ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretched AS (
  SELECT doc_id, d, min(i) AS s, count(*) + 4 AS same
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM met)
  GROUP BY doc_id, d, island),
runs AS (
  SELECT doc_id, s, same + d AS l, min(d) AS q FROM stretched
  WHERE same >= 3 * d AND same + d >= 6 GROUP BY ALL),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(v.word, ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, unnest(range(len(w))) AS i, unnest(w) AS word FROM worded) v
  ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id),
best AS (
  SELECT doc_id, count(*) AS n_runs, min((-l, s, q)) AS longest,
    string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines
  FROM runs GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, longest[2] AS start, (-longest[1])::BIGINT AS length,
  longest[3] AS period, ((-longest[1]) * 1000 // longest[3])::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best USING (doc_id) LEFT JOIN kept k USING (doc_id)
""".format(table=_CRC_TABLE, crc=_CRC.format(
    "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"))


@query
def op12_reduced_alphabet_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(read(spark, sf_dir, "documents"), garbled_in=31)


# Near words without a reduced alphabet: equal after one deletion at the same place, or one a deletion of the other.
ORACLE["op12_reduced_alphabet_variants"] = r"""
WITH RECURSIVE {table},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents),
once AS (SELECT doc_id, r, count(*) AS n FROM runs WHERE length(r) >= 7 GROUP BY ALL),
hashed AS (SELECT *, {crc} AS h FROM once, crc),
made AS (
  SELECT n, CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2)
    ELSE r END AS word FROM hashed),
vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN vocabulary b ON a.rest = b.word),
near AS (
  SELECT word, count(*) AS n_near, max(n) AS most, min(other) FILTER (n = top) AS best
  FROM (SELECT *, max(n) OVER (PARTITION BY word) AS top FROM pairs) GROUP BY word),
judged AS (
  SELECT word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * v.n THEN best END AS form,
    CASE WHEN most >= 10 * v.n THEN most END AS form_n FROM vocabulary v LEFT JOIN near USING (word)),
reached AS (
  SELECT word, word AS last FROM judged
  UNION ALL SELECT r.word, j.form FROM reached r JOIN judged j ON r.last = j.word WHERE j.form IS NOT NULL)
SELECT word, form, last AS root, j.n, j.n_near, j.form_n FROM judged j
JOIN (SELECT r.word, r.last FROM reached r JOIN judged e ON r.last = e.word WHERE e.form IS NULL) USING (word)
""".format(table=_CRC_TABLE, crc=_CRC.format(
    "flatten(list_transform(string_split(doc_id || ':' || r, ''), lambda x: CASE WHEN unicode(x) < 128 "
    "THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))"))


@query
def op11_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paths.extract(read(spark, sf_dir, "pages"))
