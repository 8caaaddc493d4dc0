"""The registered queries of this package and their SQL for DuckDB.

Each query applies one operator to a whole table and derives the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytepairs, counts, decontaminate, importance, language, merkle, minhash, pieces, quality, secrets, substrings, topk, toxicity
from .sampling import fold
from .ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda w: w != '')"

NEAR_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {SQL_WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id != b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, p.b FROM reach r JOIN pairs p ON r.other = p.a),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""


@query("op10_minhash", NEAR_SQL)
def _(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"), k=4, percent=80)


def _sql_spans(pattern: str, kind: str, order: int, keep: str) -> str:
    """Spans of one kind in DuckDB: lists of gaps and matches, added up."""
    p = pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{p}')) + 1), lambda i: {{
      'start': (list_sum(list_transform(string_split_regex(t, '{p}')[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(regexp_extract_all(t, '{p}')[1:i - 1], lambda x: length(x))), 0))::BIGINT,
      'order': {order}, 'match': regexp_extract_all(t, '{p}')[i], 'kind': '{kind}', 'value': {keep}}}), lambda s: s.value IS NOT NULL)"""


def _secrets_sql() -> str:
    from . import secrets as S

    whole = "regexp_extract_all(t, '{}')[i]"
    a = S.ASSIGN.replace("'", "''")
    value = f"regexp_extract_all(t, '{a}', 2)[i]"
    parts = [
        _sql_spans(S.ASSIGN, "assign", 0, f"CASE WHEN length({value}) >= {S.VALUE_LENGTH} THEN {value} END"),
        _sql_spans(S.ACCESS, "access", 1, whole.format(S.ACCESS)),
        _sql_spans(S.HEX, "hex", 2, whole.format(S.HEX)),
    ]
    mixed = f"regexp_matches({whole.format(S.TOKEN)}, '[0-9]') AND regexp_matches({whole.format(S.TOKEN)}, '[A-Za-z]')"
    token = _sql_spans(S.TOKEN, "token", 3, f"CASE WHEN {mixed} THEN {whole.format(S.TOKEN)} END")
    text = "list_transform(list_sort({}), lambda s: concat(s.kind, ':', s.start, ':', s.start + length(s.match)))"
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
b AS (SELECT doc_id, owner, list_concat({parts[0]}, list_concat({parts[1]}, {parts[2]})) AS base, {token} AS tokens FROM d),
f AS (SELECT doc_id, owner, base, list_filter(tokens, lambda x: len(list_filter(base, lambda y:
    y.start < x.start + length(x.match) AND x.start < y.start + length(y.match))) = 0) AS tokens FROM b),
v AS (SELECT DISTINCT owner, unnest(list_transform(list_concat(base, tokens), lambda s: s.value)) AS value FROM f),
live AS (SELECT value FROM v GROUP BY value HAVING count(*) < 2),
n AS (SELECT list(value) AS live FROM live),
g AS (SELECT f.*, list_concat(base, list_filter(tokens, lambda s: list_contains(coalesce(n.live, []), s.value))) AS spans,
    len(list_filter(base, lambda s: list_contains(coalesce(n.live, []), s.value))) AS n_live_base FROM f, n)
SELECT doc_id, len(list_filter(base, lambda s: s.kind = 'assign'))::BIGINT AS n_assign, len(list_filter(base, lambda s: s.kind = 'access'))::BIGINT AS n_access,
  len(list_filter(base, lambda s: s.kind = 'hex'))::BIGINT AS n_hex, sha256(array_to_string({text.format('base')}, ',')) AS base_sha256,
  array_to_string({text.format('spans')}, ',') AS spans, (n_live_base + len(spans) - len(base))::BIGINT AS n_live
FROM g
"""


@query("op9_secrets", _secrets_sql())
def _(spark, folder):
    found = secrets.scan_secrets(table(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kinds = [count(k) for k in ("assign", "access", "hex")]
    return found.select(
        "doc_id", *kinds, F.sha2(secrets.joined_spans("base"), 256).alias("base_sha256"), secrets.joined_spans("spans").alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


@query("op4_toxicity")
def _(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels, learn=toxicity.training_fold())
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op3_language")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    model = language.fit(docs, fold(4) != 2)
    predicted = language.predict_language(docs, model)
    return predicted.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


@query("op5_quality")
def _(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality.score_quality(docs, quality.fit(docs, labels, learn=fold(5) != 0))
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted"))

#: A SentencePiece model file on the driver.
PIECE_MODEL = "fiberqa.llm.pieceModel"
DEFAULT_PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def piece_model(spark: SparkSession) -> str:
    return spark.conf.get(PIECE_MODEL, DEFAULT_PIECE_MODEL)


@query("op6_pieces")
def _(spark, folder):
    return pieces.encode(table(spark, folder, "documents"), piece_model(spark), keep_text=False)


@query("op2_decontaminate")
def _(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id != c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""


@query("op1_topk", TOP_SQL)
def _(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", topk.scaled("embedding").alias("v"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query("op8_counts")
def _(spark, folder):
    return counts.count_tokens(table(spark, folder, "documents"), piece_model(spark))


SUBSTRING_SQL = f"""
WITH w AS (SELECT doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS w FROM documents),
x AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w),
y AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN md5(array_to_string(w[i:i + 34], ' ')) END AS g FROM x),
c AS (SELECT g FROM y WHERE g IS NOT NULL GROUP BY g HAVING count(*) > 1),
z AS (SELECT y.doc_id, y.i, y.word,
    coalesce(max(CASE WHEN c.g IS NOT NULL THEN y.i END) OVER (PARTITION BY y.doc_id ORDER BY y.i), -99) > y.i - 35 AS gone
  FROM y LEFT JOIN c ON y.g = c.g),
a AS (SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM z GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(a.n, 0)::BIGINT AS n_removed, sha256(coalesce(a.kept, '')) AS kept_sha256
FROM w LEFT JOIN a USING (doc_id)
"""


@query("op7_substrings", SUBSTRING_SQL)
def _(spark, folder):
    return substrings.remove_repeated(table(spark, folder, "documents"), 35, texts=False)


#: A file of byte-pair ranks and the pattern that splits texts into pre-tokens.
PAIR_RANKS, PAIR_PATTERN = "fiberqa.llm.pairRanks", "fiberqa.llm.pairPattern"


def pair_model(spark: SparkSession) -> tuple[str, str]:
    """Path and pattern; without settings those of the public vocabulary that is installed."""
    path, pattern = spark.conf.get(PAIR_RANKS, None), spark.conf.get(PAIR_PATTERN, None)
    if not path or not pattern:
        import public_tokenizers

        path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    return path, pattern


@query("op13_bytepairs")
def _(spark, folder):
    model = pair_model(spark)
    ids = bytepairs.encode(table(spark, folder, "documents"), *model)
    decoded = bytepairs.decode(ids.withColumn("ids_sha256", F.sha2("ids", 256)), *model)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


#: CRC-32 of a string in DuckDB, half a byte at a time, the low half first. The sixteen numbers are fixed values.
SQL_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, 2 * strlen({0})),
  lambda i: (instr('0123456789ABCDEF', substr(hex(encode({0})), xor(i, 1) + 1, 1)) - 1)::BIGINT)),
  lambda c, b: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
    3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][(xor(c, b) & 15) + 1])), 4294967295)"""
IMPORTANCE_SQL = f"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
w AS (SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x != '') AS w FROM texts),
f AS (
  SELECT kind, id, unnest(list_concat(w, list_concat(
    list_transform(range(1, len(w)), lambda i: concat_ws(' ', w[i], w[i + 1])),
    list_transform(range(1, len(w) - 1), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2]))))) AS f FROM w),
n AS (SELECT kind, id, f, count(*) AS n FROM f GROUP BY ALL),
k AS (SELECT f, ({SQL_CRC.format("f")} % 10000)::BIGINT AS b FROM (SELECT DISTINCT f FROM n)),
x AS (SELECT kind, id, b, n FROM n JOIN k USING (f)),
g AS (
  SELECT b, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 't'), 0)::DOUBLE AS t FROM x GROUP BY b),
a AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM g),
gain AS (SELECT b, floor(1000 * ln(((g.t + 1) * (a.s + 10000)) / ((g.s + 1) * (a.t + 10000))))::BIGINT AS gain FROM g, a),
weight AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM x JOIN gain USING (b) WHERE kind = 'd' GROUP BY id),
score AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(((('0x' || sha256('42:' || id)[1:8])::BIGINT)::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN weight USING (id) WHERE kind = 'd'),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM score WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r.r <= 5 * r.n // 100 THEN r.r END AS rank FROM score LEFT JOIN r USING (doc_id)
"""


@query("op12_importance", IMPORTANCE_SQL)
def _(spark, folder):
    drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def _sql_leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(concat(" + ", ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE concat(strlen({f}), ':', {f}) END" for f in fields) + "))"


def _sql_tree(name: str, leaves: str) -> str:
    """CTEs of the nodes (g, level, i, h, n) over leaves(g, i, h, n), and of the children of each node."""
    return f"""
{name}(g, level, i, h, n) AS (
  SELECT g, 0, i, h, n FROM {leaves} UNION ALL
  SELECT g, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM {name} WHERE n > 1 GROUP BY g, level, i // 8, n),
{name}_kids AS (SELECT g, level, i // 8 AS up, list(h ORDER BY i) AS kids FROM {name} WHERE n > 1 GROUP BY g, level, i // 8)"""


MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_sql_leaf("text")} AS leaf,
    CASE WHEN {SQL_CRC.format("doc_id::VARCHAR")} % 3 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS claimed FROM documents),
p AS (SELECT *, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM d),
leaves AS (SELECT g, i, leaf AS h, n FROM p),
{_sql_tree("tree", "leaves")},
subroots AS (SELECT -1 AS g, g AS i, h, count(*) OVER () AS n FROM tree WHERE n = 1),
{_sql_tree("top", "subroots")},
kids AS (SELECT * FROM tree_kids UNION ALL SELECT * FROM top_kids),
depth AS (SELECT g, max(level) + 1 AS depth FROM tree_kids GROUP BY g),
steps AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY over, k.level) AS step,
    array_to_string(kids[1:own], '') AS l, array_to_string(kids[own + 2:len(kids)], '') AS r
  FROM (SELECT doc_id, g, i, 0 AS over FROM p UNION ALL SELECT doc_id, -1, g, 1 FROM p) x
  JOIN (SELECT *, unnest(range(len(kids))) AS own FROM kids) k ON k.g = x.g AND up * 8 + own = x.i >> (3 * k.level)),
proof AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof, max(step) AS steps FROM steps GROUP BY doc_id),
fold(doc_id, step, h) AS (
  SELECT doc_id, 0, coalesce(claimed, leaf) FROM p UNION ALL
  SELECT doc_id, fold.step + 1, sha256(l || h || r) FROM fold JOIN steps USING (doc_id) WHERE steps.step = fold.step + 1)
SELECT p.doc_id, leaf, s.h AS subroot, t.h AS root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM p JOIN tree s ON s.g = p.g AND s.n = 1 JOIN top t ON t.n = 1 LEFT JOIN proof USING (doc_id)
JOIN fold f ON f.doc_id = p.doc_id AND f.step = coalesce(steps, 0)
"""


@query("op11_merkle", MERKLE_SQL)
def _(spark, folder):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.proofs(merkle.manifest(merkle.leaf_digests(table(spark, folder, "documents"), tampered)))
