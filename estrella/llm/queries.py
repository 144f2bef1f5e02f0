"""The operators applied to the given tables, one query each, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from estrella.llm import (
    chat,
    exact_dedup,
    fingerprints,
    jaccard_join,
    licenses,
    mixing,
    packing,
    phrases,
    sharding,
    spelling,
    token_files,
    toxicity,
    vectors,
)
from estrella.session import materialize, work_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SEARCHED = 50  # every row whose id is divisible by this is a search query

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_registry)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


@query
def op1_chat_formatting(spark: SparkSession, directory: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    messages = _table(spark, directory, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    made = chat.format_conversations(messages)
    turns = made.withColumn("turns", chat.read_back(F.col("formatted"), F.col("loss")))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return turns.select("conv_id", "n_tokens", "formatted", "turns", said.alias("said"), F.concat_ws("", F.transform("turns", lambda t: t["loss_text"])).alias("loss")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "n_tokens",
    )


@query
def op2_license_scans(spark: SparkSession, directory: str) -> DataFrame:
    """License phrases and notices in all documents."""
    return licenses.scan_licenses(_table(spark, directory, "documents")).drop("spans")


@query
def op3_document_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts; n_near: rows within three bits, for every fiftieth id."""
    found = materialize(fingerprints.fingerprint_documents(_table(spark, directory, "documents")))
    asked = F.coalesce(F.col("doc_id") % SEARCHED == 0, F.lit(False))
    near = fingerprints.near_counts(found.filter(asked).select("fingerprint"), found.select("fingerprint"))
    return (
        found.filter(asked)
        .join(near, "fingerprint")
        .select(*found.columns, "n_near")
        .unionByName(found.filter(~asked).withColumn("n_near", F.lit(None).cast("long")))
    )


@query
def op4_token_files(spark: SparkSession, directory: str) -> DataFrame:
    """Token ids of all documents, written as ORC and read back."""
    path = work_path(spark)
    token_files.write_tokens(_table(spark, directory, "documents"), path, TOKENIZER, 1)
    return token_files.token_index(token_files.read_tokens(spark, path))


@query
def op5_ngram_jaccard_join(spark: SparkSession, directory: str) -> DataFrame:
    """Classes of documents that share three quarters of their five-word shingles."""
    return jaccard_join.jaccard_classes(_table(spark, directory, "documents"))


@query
def op6_mixing(spark: SparkSession, directory: str) -> DataFrame:
    """What a mix of one and a half times all words takes of every document."""
    docs = _table(spark, directory, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_sharding(spark: SparkSession, directory: str) -> DataFrame:
    """All documents in 40 shards whose counts differ by at most one."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = _table(spark, directory, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    sharded = sharding.shard_rows(docs, ["doc_id", "text_crc32", "size", "text_hash"], 40)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op8_packing(spark: SparkSession, directory: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(_table(spark, directory, "documents"), TOKENIZER, 2)


@query
def op9_embedding_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """Vectors linked by a cosine of 0.95 or more, and their components."""
    return vectors.near_vectors(_table(spark, directory, "embeddings"))


@query
def op10_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    """Category probabilities, toxicity score and decision for all documents."""
    docs, labels = _table(spark, directory, "documents"), _table(spark, directory, "labels")
    return toxicity.score_toxicity(docs, labels)


@query
def op11_spelling(spark: SparkSession, directory: str) -> DataFrame:
    """The words of all documents with the spelling that each is a variant of."""
    return spelling.spelling_variants(_table(spark, directory, "documents"))


@query
def op12_phrases(spark: SparkSession, directory: str) -> DataFrame:
    """The best collocations of two to five words of each language over all documents."""
    return phrases.collocations(_table(spark, directory, "documents"))


@query
def op13_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """Exact copies among all documents, which reach the index in two loads (halves by the crc of their ids)."""
    half = F.when(F.crc32(F.col("doc_id").cast("string")) < 1 << 31, "first").otherwise("second")
    rows = exact_dedup.digest_rows(_table(spark, directory, "documents"), half)
    index = exact_dedup.DigestIndex(spark, work_path(spark))
    for load in ("first", "second"):
        index.append(rows.filter(F.col("load") == load))
    return index.decide(rows)


_WORDS = r"'[^\x20\x09-\x0D]+'"



def _license_sql() -> str:
    """The set-similarity join by counting: distinct template words per run of words."""
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    small = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    every = (*licenses.BASE, *licenses.NOTICES)
    stride = max(len(licenses.license_words(t.text.encode())) for t in every)
    known = ", ".join(f"('{t.label}', '{t.text}')" for t in licenses.NOTICES)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({small.format("coalesce(text, '')")}, {word}) AS ws FROM documents),
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM d),
t AS (SELECT DISTINCT label, unnest(regexp_extract_all({small.format("text")}, {word})) AS word FROM (VALUES {known}) v(label, text)),
n AS (SELECT label, count(*) AS m FROM t GROUP BY label),
h AS (SELECT DISTINCT r, label, word, b FROM (
  SELECT r, label, word, unnest([i // {stride}, i // {stride} - 1]) AS b FROM w JOIN t USING (word)) WHERE b >= 0),
met AS (
  SELECT r, label, count(*) / CAST(m AS DOUBLE) AS c FROM h JOIN n USING (label) GROUP BY r, label, b, m
  HAVING count(*) >= ceil(0.9 * m - 1e-9)),
x AS (SELECT r, i, word AS a, lead(word) OVER p AS b, lead(word, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY r ORDER BY i)),
place AS (
  SELECT r, i, 'cc-by' AS label FROM x WHERE a = 'cc' AND b = 'by'
  UNION ALL SELECT r, i, 'gpl' FROM x WHERE a = 'general' AND b = 'public' AND c = 'license'
  UNION ALL SELECT r, i, 'reserved' FROM x WHERE a = 'all' AND b = 'rights' AND c = 'reserved'),
base AS (
  SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM place GROUP BY r),
found AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(c) AS score
  FROM (SELECT r, label, c FROM met UNION ALL SELECT r, label, 1.0 FROM place) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""


_SQL = {
    # near words by what is left when one code point is taken out; the crc32 byte by byte from its table
    "op11_spelling": r"""
WITH RECURSIVE step(b, i, c) AS (
  SELECT b, 0, b::UBIGINT FROM range(256) v(b)
  UNION ALL SELECT b, i + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM step WHERE i < 8),
t AS (SELECT list(c ORDER BY b) AS t FROM step WHERE i = 8),
d AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS name, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+') AS runs
  FROM documents),
r AS (SELECT name, run, count(*) AS n FROM (SELECT name, unnest(runs) AS run FROM d) GROUP BY 1, 2),
y AS (
  SELECT run, n, flatten(list_transform(string_split(name || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)) AS bytes
  FROM r),
h AS (
  SELECT run, n, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, bytes::UBIGINT[]),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255)::BIGINT + 1]))) AS h
  FROM y, t),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:(h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2:] ELSE run END AS word,
    sum(n)::BIGINT AS n
  FROM h GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
x AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
e AS (
  SELECT a.word AS a, b.word AS b, b.n AS nb FROM x AS a JOIN x AS b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT x.word, w.word, w.n FROM x JOIN w ON x.rest = w.word
  UNION SELECT w.word, x.word, x.n FROM x JOIN w ON x.rest = w.word),
b AS (
  SELECT *, count(*) OVER (PARTITION BY a) AS n_near FROM e
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY nb DESC, b) = 1),
f AS (
  SELECT word, CASE WHEN nb >= 2 * n THEN b END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN nb >= 2 * n THEN nb END AS form_n
  FROM w LEFT JOIN b ON a = word),
c(word, here) AS (SELECT word, word FROM f UNION ALL SELECT c.word, form FROM c JOIN f ON f.word = c.here WHERE form IS NOT NULL),
root AS (SELECT c.word, here AS root FROM c JOIN f ON f.word = c.here WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN root USING (word)
""",
    "op12_phrases": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) v(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 100),
cut AS (SELECT *, unnest(range(1, k)) AS j FROM c),
s AS (
  SELECT cut.lang, cut.phrase, a, l.f AS l, r.f AS r, n, j, 1000::HUGEINT * a * n // (l.f::HUGEINT * r.f) AS score
  FROM cut JOIN n USING (lang)
  JOIN f AS l ON l.lang = cut.lang AND l.phrase = array_to_string(ws[1:j], ' ')
  JOIN f AS r ON r.lang = cut.lang AND r.phrase = array_to_string(ws[j + 1:], ' ')),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
sub AS (SELECT lang, a, k, ws, unnest(range(2, k)) AS m FROM c WHERE k > 2),
inside AS (SELECT lang, a, m, ws, unnest(range(1, k - m + 2)) AS i FROM sub),
cover AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM inside GROUP BY 1, 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM low LEFT JOIN cover USING (lang, phrase)
WHERE longer IS NULL OR longer < a
QUALIFY rank <= 2000
""",
    "op13_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER best = 1 AS kept, text_sha256
FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST)
""",
    "op2_license_scans": _license_sql(),
    "op1_chat_formatting": r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
e AS (
  SELECT *, replace(replace(text, '\', '\0'), '<', '\1') AS shown,
    replace(replace(replace(role, '\', '\0'), '<', '\1'), '>', '\2') AS shown_role,
    len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) AS tokens
  FROM m),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, shown) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, shown) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('<turn:>') + length(shown_role) + length(shown) + length('</turn>') + 1)::BIGINT AS formatted_chars,
    sum(tokens)::BIGINT AS n_tokens
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars, n_tokens
FROM c
""",
    "op5_ngram_jaccard_join": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM p JOIN n AS o ON o.doc_id = x JOIN n AS q ON q.doc_id = y WHERE 100 * c >= 75 * (o.n + q.n - c)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS low FROM r GROUP BY x) USING (doc_id)
""",
    # the exact answer: the forest finds every link of these tables
    "op9_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x AS vec_id, min(y) AS low FROM r GROUP BY x),
k AS (SELECT x AS vec_id, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id <= coalesce(low, vec_id) AS kept
FROM v LEFT JOIN c USING (vec_id) LEFT JOIN k USING (vec_id)
""",
    "op6_mixing": f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {_WORDS})), 0)::BIGINT AS size,
    md5('0:' || coalesce(doc_id::VARCHAR, '')) AS turn
  FROM documents),
s AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
    [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, 2 * source_size / w AS ratio,
    coalesce(sum(2 * source_size) OVER o, 0) AS spent, coalesce(sum(w) OVER o, 0) AS gone
  FROM s WINDOW o AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (
  SELECT *, (sum(source_size) OVER () * 1.5 - spent) / (sum(w) OVER () - gone) AS level FROM l),
f AS (SELECT level AS found FROM v WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size::BIGINT AS source_size, least(2 * source_size, w * found) AS target
  FROM v LEFT JOIN f ON true),
c AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY turn, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS earlier
  FROM d)
SELECT doc_id, size, t.source_size, target,
  (greatest(0, least(size, floor(target)::BIGINT - earlier))
   + greatest(0, least(size, floor(target)::BIGINT - t.source_size - earlier)))::BIGINT AS taken
FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
""",
}
