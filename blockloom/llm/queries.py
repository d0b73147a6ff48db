"""One query per operator, over its whole table and with production parameters, and the SQL it must equal."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from blockloom.llm import bpe, html_text, language, lexical, manifest, mixing, near_dup, quality, repeats, sharding, token_counts, toxicity, vectors
from blockloom.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "word_bpe_49k.json"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    return bpe.encode_texts(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, ids=False)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


SHARD_BYTES = 1 << 20


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = token_counts.read_tokenizer(public_tokenizers.path(TOKENIZER))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), content)


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


LEVELS = ("domain", "lang", "source")
#: (level, node, weight); other nodes weigh 1.
WEIGHTS = (
    ("domain", "web", 5), ("domain", "books", 3), ("domain", "forums", 2),
    ("lang", "web/en", 4), ("lang", "web/de", 2), ("lang", "books/en", 2), ("lang", "books/es", 3),
    ("lang", "forums/fr", 0), ("source", "web/en/src0", 6), ("source", "books/de/src9", 4),
)
SHARE, EPOCHS, SEED = 0.6, 2, 7


def with_domain(docs: DataFrame) -> DataFrame:
    """The domain of a source goes by its number."""
    number = F.regexp_extract("source", r"(\d+)$", 1).try_cast("int")
    domain = F.when(number < 7, "web").when(number < 14, "books").otherwise("forums")
    return docs.withColumn("domain", domain)


def weight_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(WEIGHTS), "level string, name string, weight long")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return mixing.mix(docs, LEVELS, weight_table(spark), SHARE, EPOCHS, SEED)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.remove_repeats(table(spark, sf_dir, "documents"), 35)
    return rows.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_toxicity, op3_quality_rules, op4_near_duplicates, op5_sharding, op6_token_counts, op7_near_vectors, op8_html_text, op9_mixing, op10_language_id, op11_merkle_manifest, op12_lexical_search, op13_substring_dedup)}

_LEVELS = quality.levels()
_TRIES = ", ".join(
    f"('{r.name}', {c}, {min(k for k, own in enumerate(_LEVELS) if own[r.name] == c)})" for r in quality.RULES for c in r.cutoffs
)
_STEPS = ", ".join(f"({k}, '{name}', {c})" for k, own in enumerate(_LEVELS) for name, c in own.items())
_BROKEN = " ".join(
    f"WHEN '{r.name}' THEN 1000 * {r.over} > cutoff * {r.under}" for r in quality.RULES
)

_QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(lang, 'none') AS stratum, coalesce(text, '') AS text
  FROM documents),
split AS (
  SELECT row_id, doc_id, stratum, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs),
windows AS (
  SELECT row_id, pos, words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] AS window_words
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS pos FROM split)),
repeats AS (
  SELECT row_id, count(DISTINCT pos + d) AS n_repeat_words
  FROM (SELECT *, count(*) OVER (PARTITION BY row_id, window_words) AS times FROM windows), range(3) AS r(d)
  WHERE times > 1 GROUP BY row_id),
counts AS (
  SELECT doc_id, stratum, text, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split LEFT JOIN repeats USING (row_id)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
tries(rule, cutoff, reached) AS (VALUES {_TRIES}),
steps(level, rule, cutoff) AS (VALUES {_STEPS}),
known AS (SELECT DISTINCT doc_id, quality = 1 AS good FROM labels WHERE quality IS NOT NULL),
holdout AS (
  SELECT DISTINCT stratum, text, good, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words
  FROM based JOIN known USING (doc_id) WHERE NOT base_failed),
level_rows AS (
  SELECT stratum, text, good, level, bool_or(CASE rule {_BROKEN} END) AS breaks FROM holdout, steps GROUP BY ALL),
level_counts AS (
  SELECT stratum, level, count(*) FILTER (good) AS n_good, count(*) FILTER (good AND breaks) AS lost
  FROM level_rows GROUP BY ALL),
chances AS (
  SELECT *, CASE WHEN lost > n_good * {quality.RISK} THEN 1 ELSE
    list_sum(list_transform(range(lost + 1), lambda i: exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1)
      + i * ln({quality.RISK}) + (n_good - i) * ln(1 - {quality.RISK})))) END AS chance
  FROM level_counts),
passed AS (
  SELECT *, chance <= {quality.DOUBT} / (SELECT count(DISTINCT stratum) FROM level_counts) AS passes FROM chances),
certified AS (
  SELECT stratum, level FROM passed p
  WHERE NOT EXISTS (SELECT 1 FROM passed q WHERE q.stratum = p.stratum AND q.level <= p.level AND NOT q.passes)),
tested AS (
  SELECT stratum, rule, cutoff, count(*) FILTER (good AND (CASE rule {_BROKEN} END)) AS lost,
    count(*) FILTER (NOT good AND (CASE rule {_BROKEN} END)) AS caught
  FROM holdout JOIN (SELECT stratum, max(level) AS level FROM certified GROUP BY ALL) USING (stratum)
    JOIN tries ON reached <= level GROUP BY ALL),
chosen AS (
  SELECT stratum, rule, cutoff FROM tested WHERE caught > lost
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY caught - lost DESC, cutoff DESC) = 1),
broken AS (
  SELECT DISTINCT doc_id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words
  FROM based JOIN chosen USING (stratum) WHERE CASE rule {_BROKEN} END)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (
    SELECT 1 FROM broken b WHERE b.stratum = based.stratum AND b.n_words = based.n_words
      AND b.word_chars = based.word_chars AND b.n_symbols = based.n_symbols AND b.n_lines = based.n_lines
      AND b.n_dup_lines = based.n_dup_lines AND b.n_repeat_words = based.n_repeat_words) AS kept
FROM based"""

_SHARDS = f"""
WITH sized AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(coalesce('k' || doc_id, '')), 1, 15) AS BIGINT) AS bits FROM documents),
tried AS (SELECT *, unnest(range(0, 61)) AS depth FROM sized),
sums AS (
  SELECT depth, bits >> (60 - depth) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
  FROM tried GROUP BY ALL),
chosen AS (
  SELECT t.doc_id, t.n_bytes, t.depth, s.prefix, s.shard_bytes, s.shard_rows
  FROM tried t JOIN sums s ON s.depth = t.depth AND s.prefix = t.bits >> (60 - t.depth)
  WHERE s.shard_bytes <= {SHARD_BYTES} OR t.depth = 60
  QUALIFY row_number() OVER (PARTITION BY t.doc_id ORDER BY t.depth) = 1)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(prefix), 64, '0'), depth::INTEGER) END AS shard,
  depth::INTEGER AS depth, shard_bytes, shard_rows, shard_bytes > {SHARD_BYTES} AS oversized
FROM chosen"""


def _split(k: int, level: str) -> str:
    """Split the budgets of one level's nodes (split{k - 1}) among their children."""
    known = ", ".join(f"('{name}', {weight})" for at, name, weight in WEIGHTS if at == level)
    return f"""
weights{k}(name, weight) AS (VALUES {known}),
children{k} AS (
  SELECT path{k - 1}, path{k}, capacity, coalesce(weight, 1) AS weight, target AS budget
  FROM (SELECT path{k - 1}, path{k}, sum(capacity) AS capacity FROM nodes GROUP BY ALL)
    LEFT JOIN weights{k} ON name = path{k} JOIN split{k - 1} USING (path{k - 1})
  WHERE coalesce(weight, 1) > 0),
ranked{k} AS (
  SELECT *, budget - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rem,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM children{k} WINDOW w AS (PARTITION BY path{k - 1} ORDER BY capacity / weight, path{k})),
level{k} AS (
  SELECT path{k - 1}, rem AS first_left, rest AS first_rest FROM ranked{k} WHERE capacity * rest > rem * weight
  QUALIFY row_number() OVER (PARTITION BY path{k - 1} ORDER BY capacity / weight, path{k}) = 1),
split{k} AS (
  SELECT path{k}, CASE WHEN capacity * rest <= rem * weight THEN capacity ELSE first_left * weight // first_rest END AS target
  FROM ranked{k} LEFT JOIN level{k} USING (path{k - 1}))"""


_MIXING = f"""
WITH counted AS (
  SELECT doc_id, CASE WHEN n < 7 THEN 'web' WHEN n < 14 THEN 'books' ELSE 'forums' END AS domain,
    coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens
  FROM (SELECT *, TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS n FROM documents)),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS supply FROM counted GROUP BY ALL),
nodes AS (
  SELECT *, supply * {EPOCHS} AS capacity, '' AS path0, domain AS path1, domain || '/' || lang AS path2,
    domain || '/' || lang || '/' || source AS path3 FROM leaves),
split0 AS (
  SELECT '' AS path0, least(CAST(floor(sum(supply) * {SHARE}::DOUBLE) AS HUGEINT), sum(capacity)) AS target FROM nodes),
{",".join(_split(k, level) for k, level in enumerate(LEVELS, 1))},
plan AS (
  SELECT domain, lang, source, target // supply AS whole, target % supply AS rest
  FROM nodes JOIN split3 USING (path3) WHERE supply > 0),
placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('{SEED}-' || whole || '-' || doc_id), doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS total
  FROM counted JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, unnest(range(whole::BIGINT)) AS epoch, n_tokens FROM placed
UNION ALL
SELECT doc_id, domain, lang, source, whole::BIGINT, n_tokens FROM placed WHERE rest > 0 AND total <= rest"""



def _hashed(name: str, text: str | None = None) -> str:
    """A field of a leaf."""
    value = text or f"CAST({name} AS VARCHAR)"
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_hashed(n, text if n == 'text' else None) for n in manifest.FIELDS)})"


def _levels(tree: str, paths: str, levels: int) -> str:
    """Levels of all trees over nodes {tree}0 (branch, pos, total, digest), with the folding of {paths}0 beside them."""
    up = "CASE WHEN {0}.total > 1 THEN {0}.pos // 3 ELSE {0}.pos END"
    return ",".join(f"""
{tree}_runs{k} AS MATERIALIZED (
  SELECT branch, {up.format(f"{tree}{k}")} AS up, any_value(total) AS total, list(digest ORDER BY pos) AS run
  FROM {tree}{k} GROUP BY 1, 2),
{tree}{k + 1} AS MATERIALIZED (
  SELECT branch, up AS pos, (total + 2) // 3 AS total,
    CASE WHEN total > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS digest FROM {tree}_runs{k}),
{paths}{k + 1} AS MATERIALIZED (
  SELECT p.* REPLACE (up AS pos, (p.total + 2) // 3 AS total,
    CASE WHEN p.total > 1 THEN sha256(array_to_string(run[:pos % 3] || [folded] || run[pos % 3 + 2:], '')) ELSE folded END AS folded,
    CASE WHEN p.total > 1 THEN proof || array_to_string(run[:pos % 3] || run[pos % 3 + 2:], '') ELSE proof END AS proof)
  FROM {paths}{k} p JOIN {tree}_runs{k} r ON r.branch = p.branch AND r.up = {up.format("p")})""" for k in range(levels))


#: Levels that the SQL goes up: enough for 3^13 documents of a source and 3^7 sources.
_DEEP, _WIDE = 13, 7

_MANIFEST = f"""
WITH hashed AS MATERIALIZED (
  SELECT doc_id, coalesce('+' || source, '') AS branch, {_leaf('text')} AS leaf, {_leaf("replace(text, chr(10), '')")} AS cut,
    xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) AS crc
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY branch ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY branch) AS total
  FROM hashed),
low0 AS MATERIALIZED (SELECT branch, pos, total, leaf AS digest FROM leaves),
way0 AS MATERIALIZED (
  SELECT doc_id, leaf, branch, pos, total, CASE WHEN crc % 2 = 0 THEN cut ELSE leaf END AS folded, '' AS proof FROM leaves),
{_levels("low", "way", _DEEP)},
high0 AS MATERIALIZED (
  SELECT '' AS branch, branch AS name, row_number() OVER (ORDER BY branch) - 1 AS pos, count(*) OVER () AS total, digest FROM low{_DEEP}),
rise0 AS MATERIALIZED (
  SELECT w.* REPLACE (h.branch AS branch, h.pos AS pos, h.total AS total), digest AS subroot FROM way{_DEEP} w JOIN high0 h ON h.name = w.branch),
{_levels("high", "rise", _WIDE)}
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM rise{_WIDE}, high{_WIDE}"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_SEARCH = f"""
WITH words AS (SELECT row_number() OVER () AS row_id, doc_id, {_TERMS} AS terms FROM documents),
stats AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM words),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
found AS (
  SELECT row_id, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_id, doc_id, len(terms) AS n, unnest(terms) AS term FROM words)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
held AS (SELECT term, count(*) AS df FROM found GROUP BY term),
parts AS (
  SELECT row_id, doc_id, term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS part
  FROM found JOIN held USING (term), stats),
scores AS (
  SELECT item_id, row_id, doc_id, sum(part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY ALL HAVING sum(part) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores QUALIFY rank <= 10"""

_REPEATS = r"""
WITH split AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT row_id, pos, count(*) OVER (PARTITION BY md5(array_to_string(words[pos:pos + 34], ' '))) AS times
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 33)) AS pos FROM split)),
gone AS (SELECT row_id, list(DISTINCT pos + d) AS places FROM windows, range(35) AS r(d) WHERE times > 1 GROUP BY row_id),
kept AS (
  SELECT doc_id, words, places, list_filter(words, lambda w, i: NOT list_contains(coalesce(places, []), i)) AS rest
  FROM split LEFT JOIN gone USING (row_id))
SELECT doc_id, len(words) AS n_words, len(words) - len(rest) AS n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256
FROM kept"""

ORACLES: dict[str, str] = {
    "op3_quality_rules": _QUALITY, "op5_sharding": _SHARDS, "op9_mixing": _MIXING, "op11_merkle_manifest": _MANIFEST,
    "op12_lexical_search": _SEARCH,
    "op13_substring_dedup": _REPEATS,
}
