"""One query per text operator, over its whole table, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pursewatch.llm import exact_dedup as exact
from pursewatch.llm import decontamination, language, licenses, line_quality, merkle, mixing, near_dedup, packing
from pursewatch.llm import sharding, substring_dedup, tool_calls, vector_codes
from pursewatch.llm.common import n_words

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SHARDS = tuple(f"shard-{k:02d}" for k in range(16))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


MIX_SQL = r"""WITH d AS (SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS z,
    [5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS w
  FROM d GROUP BY source),
tot AS (SELECT CAST(sum(z) AS BIGINT) AS t FROM s),
-- each possible set of capped sources is those whose 3z/w is below some source's
lvl AS (SELECT a.source, (SELECT t FROM tot) - coalesce((SELECT sum(3 * b.z) FROM s b
      WHERE 3 * b.z * a.w < 3 * a.z * b.w), 0) AS num,
    (SELECT sum(b.w) FROM s b WHERE 3 * b.z * a.w >= 3 * a.z * b.w) AS den, a.z, a.w FROM s a),
best AS (SELECT num, den FROM lvl WHERE num * w <= 3 * z * den ORDER BY den DESC, num DESC LIMIT 1),
tgt AS (SELECT s.source, z,
    CASE WHEN w * num <= 3 * z * den THEN CAST(w * num AS DOUBLE) / CAST(den AS DOUBLE)
      ELSE CAST(3 * z AS DOUBLE) END AS target,
    CAST(CASE WHEN w * num <= 3 * z * den THEN (2 * w * num + den) // (2 * den) ELSE 3 * z END AS BIGINT) AS budget
  FROM s, best),
o AS (SELECT d.*, z, target, budget, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
    ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS before
  FROM d JOIN tgt ON d.source IS NOT DISTINCT FROM tgt.source)
SELECT doc_id, size, z AS source_size, target,
  CASE WHEN z = 0 THEN 0 ELSE (budget // z) * size + greatest(0, least(size, budget % z - before)) END AS taken
FROM o"""


@query(MIX_SQL)
def op2_source_mix(spark, sf):
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(
    r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY body) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g"""
)
def op9_exact_dedup(spark, sf):
    return exact.exact_dedup(table(spark, sf, "documents"))


@query(
    f"""WITH RECURSIVE s AS (SELECT k, 'shard-' || lpad(CAST(k AS VARCHAR), 2, '0') AS shard
  FROM range({len(SHARDS)}) r(k)),
h AS (SELECT list(CAST('0x' || substr(md5(shard || '#offset'), 1, 15) AS BIGINT) % {sharding.TABLE_SIZE}
    ORDER BY k) AS starts,
    list(CAST('0x' || substr(md5(shard || '#step'), 1, 15) AS BIGINT) % {sharding.TABLE_SIZE - 1} + 1
    ORDER BY k) AS steps FROM s),
fill(turn, slot, taken) AS (
  SELECT CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT turn + 1, free, list_append(taken, free) FROM (
    SELECT turn, taken, list_filter(list_transform(range({sharding.TABLE_SIZE}),
        lambda j: (starts[(turn + 1) % {len(SHARDS)} + 1] + j * steps[(turn + 1) % {len(SHARDS)} + 1])
          % {sharding.TABLE_SIZE}), lambda p: NOT list_contains(taken, p))[1] AS free
    FROM fill, h WHERE turn + 1 < {sharding.TABLE_SIZE}))
SELECT doc_id, slot, shard FROM (SELECT doc_id,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)
      % {sharding.TABLE_SIZE} AS slot FROM documents) d
  JOIN (SELECT slot, turn FROM fill WHERE turn >= 0) USING (slot) JOIN s ON s.k = turn % {len(SHARDS)}"""
)
def op10_shard_placement(spark, sf):
    return sharding.place(table(spark, sf, "documents").select("doc_id"), SHARDS)


@query(
    r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
p AS (SELECT doc_id, unnest(s) AS sh FROM s),
l AS (SELECT a.doc_id AS x, b.doc_id AS y FROM p a JOIN p b ON a.sh = b.sh AND a.doc_id != b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * ((SELECT n FROM n WHERE n.doc_id = a.doc_id)
    + (SELECT n FROM n WHERE n.doc_id = b.doc_id) - count(*))),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.doc_id),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY 1)
SELECT doc_id, n AS n_shingles, c AS component_id, doc_id = c AS kept FROM n JOIN m USING (doc_id)"""
)
def op8_near_dedup(spark, sf):
    return near_dedup.near_dedup(table(spark, sf, "documents"), size=4)


@query(
    r"""WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM w WHERE len(w) >= 13),
s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h FROM g),
f AS (SELECT h, min(doc_id) AS first FROM s GROUP BY 1),
d AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (
    SELECT doc_id, unnest(range(i, i + 13)) AS p FROM s JOIN f USING (h) WHERE first < doc_id) GROUP BY 1),
k AS (SELECT doc_id, len(w) AS n, coalesce(len(gone), 0) AS r, CASE WHEN gone IS NULL THEN w
    ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])),
      lambda x: x[1]) END AS kept FROM w LEFT JOIN d USING (doc_id))
SELECT doc_id, n AS n_words, r AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""
)
def op6_substring_dedup(spark, sf):
    return substring_dedup.substring_dedup(table(spark, sf, "documents"))


@query()
def op5_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontamination.find_leaks(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        F.array_distinct("leaks.item_id").alias("item_ids"),
        F.coalesce(F.array_max("leaks.similarity"), F.lit(0.0)).alias("similarity"),
        (F.size("leaks") > 0).alias("contaminated"),
    )


def remainder(modulus: int) -> Column:
    """What the CRC-32 of a document's id as text leaves; ids of equal remainder make a fold."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query()
def op7_line_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = line_quality.fit_on(docs, table(spark, sf, "labels"), remainder(3) != 1)
    return line_quality.score_quality(docs, model).select(
        "doc_id",
        (remainder(3) == 1).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op3_language(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    identifier = language.fit_on(docs, remainder(4) != 2)
    return language.identify(docs.select("doc_id", "text"), identifier).select(
        "doc_id",
        (remainder(4) == 2).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_accepted").alias("accepted"),
    )


def _templates_sql() -> str:
    rows = [(k, n, t.replace("'", "''")) for k, (n, t) in enumerate(licenses.TEMPLATES)]
    return ", ".join(f"({k}, '{n}', '{t}')" for k, n, t in rows)


@query(
    rf"""WITH tpl(k, license, body) AS (VALUES {_templates_sql()}),
u AS (SELECT doc_id, 'text' AS unit, 0 AS nth, text AS body FROM documents
  UNION ALL SELECT doc_id, 'paragraph', i, p[i] FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i
    FROM (SELECT doc_id, regexp_split_to_array(text, '\n[ \t\r]*\n') AS p FROM documents) WHERE len(p) > 1)
  UNION ALL SELECT doc_id, 'line', i, p[i] FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i
    FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents) WHERE len(p) > 1)),
sides AS (SELECT 0 AS side, CAST(k AS VARCHAR) AS id, body FROM tpl
  UNION ALL SELECT 1, doc_id || ' ' || unit || ' ' || nth, body FROM u),
w AS (SELECT side, id, list_filter(list_transform(regexp_extract_all(lower(body), '[^\x20\x09-\x0D]+'),
    lambda x: regexp_replace(x, '[^\pL\pN]', '', 'g')), lambda x: x != '') AS w FROM sides),
b AS (SELECT side, id, CASE WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS b
  FROM w WHERE len(w) > 0),
t AS (SELECT CAST(id AS INT) AS k, len(b) AS n, unnest(b) AS g FROM b WHERE side = 0),
d AS (SELECT id, len(b) AS n, unnest(b) AS g FROM b WHERE side = 1),
m AS (SELECT d.id, t.k, 2.0::DOUBLE * count(*) / (any_value(d.n) + any_value(t.n)) AS dice, any_value(t.n) AS n
  FROM d JOIN t USING (g) GROUP BY 1, 2),
c AS (SELECT id, license, dice FROM m JOIN tpl USING (k) WHERE dice >= {licenses.LEAST}
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY dice DESC, n, k) = 1),
r AS (SELECT CAST(split_part(id, ' ', 1) AS BIGINT) AS doc_id, license, dice FROM c)
SELECT doc_id, count(license) AS n_matches, coalesce(max(dice), 0.0) AS dice,
  coalesce(array_to_string(list_sort(list_distinct(list(license) FILTER (license IS NOT NULL))), ','), '') AS licenses
FROM documents LEFT JOIN r USING (doc_id) GROUP BY 1"""
)
def op1_license_scan(spark, sf):
    found = licenses.scan_licenses(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_matches"),
        F.coalesce(F.array_max("licenses.dice"), F.lit(0.0)).alias("dice"),
        F.array_join(F.array_sort(F.array_distinct("licenses.license")), ",").alias("licenses"),
    )


#: What the tools of the derived calls accept.
TOOLS = {
    "search": {
        "type": "object",
        "required": ["query", "limit"],
        "properties": {"query": {"type": "string", "minLength": 3}, "limit": {"type": "integer", "minimum": 1, "maximum": 40}},
        "additionalProperties": False,
    },
    "count": {"type": "object", "required": ["words"], "properties": {"words": {"type": "integer"}}},
}


def derived_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as the conversations imply them: a reply asks for a tool, the next turn answers.

    The call of a reply has the reply's text in its arguments and follows the call of the reply
    before, two turns earlier. Replies whose words are a multiple of 7 name a tool nobody knows,
    those of a multiple of 11 write arguments that are no JSON.
    """
    n = n_words(F.col("text"))
    call_id = F.concat(F.lit("call-"), F.col("turn").cast("string"))
    first = F.regexp_extract(F.coalesce("text", F.lit("")), r"^(\S*)", 1)
    arguments = F.when(F.col("turn") % 3 == 0, F.to_json(F.struct(n.alias("words")))).otherwise(
        F.to_json(F.struct(n.alias("limit"), first.alias("query")))
    )
    calls = turns.where("role = 'assistant'").select(
        "conv_id",
        call_id.alias("call_id"),
        "turn",
        F.when(n % 7 == 0, "recall").when(F.col("turn") % 3 == 0, "count").otherwise("search").alias("name"),
        F.when(n % 11 == 0, F.concat(arguments, F.lit("}"))).otherwise(arguments).alias("arguments"),
        F.when(F.col("turn") >= 2, F.concat(F.lit("call-"), (F.col("turn") - 2).cast("string"))).alias("after"),
    )
    results = turns.where("role = 'user' and turn > 0").select(
        "conv_id",
        F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        "turn",
        F.col("text").alias("content"),
    )
    return calls, results


@query()
def op4_tool_calls(spark, sf):
    calls, results = derived_calls(table(spark, sf, "conversations"))
    return tool_calls.link_calls(calls, results, TOOLS)


#: What makes up a document's leaf, in order.
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _leaf_sql(n_chars: str) -> str:
    fields = [n_chars if f == "n_chars" else f for f in LEAF_FIELDS]
    return "sha256(" + " || ".join(
        f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields
    ) + ")"


#: CRC-32 of a text of ASCII characters, bit by bit.
CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
  lambda c: list_transform(range(8), lambda k: (ascii(c)::BIGINT >> k) & 1)))),
  lambda s, b: xor(s >> 1, (xor(s, b) & 1) * 3988292384)), 4294967295)"""


@query(
    f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS tree,
  {_leaf_sql('n_chars')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND ({CRC_SQL.format('CAST(doc_id AS VARCHAR)')}) % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')}
    ELSE {_leaf_sql('n_chars')} END AS seen FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
  count(*) OVER (PARTITION BY tree) AS n FROM d),
a(tree, l, i, h, n) AS (SELECT tree, 0, i, leaf, n FROM p
  UNION ALL SELECT tree, l + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM a WHERE n > 1
  GROUP BY tree, l, i // 2, n),
s AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM a WHERE n = 1),
b(l, i, h, n) AS (SELECT 0, i, subroot, n FROM s
  UNION ALL SELECT l + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM b WHERE n > 1
  GROUP BY l, i // 2, n),
f(r, tree, l, i, n, own, beside) AS (SELECT r, tree, 0, i, n, seen, '' FROM p
  UNION ALL SELECT r, f.tree, f.l + 1, f.i // 2, (f.n + 1) // 2,
    sha256(CASE WHEN f.i % 2 = 1 THEN coalesce(h, '') || own ELSE own || coalesce(h, '') END), beside || coalesce(h, '')
  FROM f LEFT JOIN a ON a.tree = f.tree AND a.l = f.l AND a.i = xor(f.i, 1) WHERE f.n > 1),
g(r, l, i, n, own, beside) AS (SELECT r, 0, s.i, s.n, own, beside FROM f JOIN s USING (tree) WHERE f.n = 1
  UNION ALL SELECT r, g.l + 1, g.i // 2, (g.n + 1) // 2,
    sha256(CASE WHEN g.i % 2 = 1 THEN coalesce(h, '') || own ELSE own || coalesce(h, '') END), beside || coalesce(h, '')
  FROM g LEFT JOIN b ON b.l = g.l AND b.i = xor(g.i, 1) WHERE g.n > 1)
SELECT doc_id, leaf, subroot, root.h AS root, sha256(beside) AS proof_sha256, own AS folded_root,
  own = root.h AS verified
FROM g JOIN p USING (r) JOIN s USING (tree) CROSS JOIN (SELECT h FROM b WHERE n = 1) root WHERE g.n = 1"""
)
def op11_merkle_manifest(spark, sf):
    docs = table(spark, sf, "documents")
    n_chars = F.when(remainder(7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    seen = merkle.leaf_digest([n_chars if f == "n_chars" else F.col(f) for f in LEAF_FIELDS])
    manifest = merkle.build(docs, LEAF_FIELDS, "lang", "doc_id", {"seen": seen})
    root = F.lit(manifest.root).cast("string")
    proved = merkle.prove(manifest).withColumn("folded_root", merkle.fold(F.col("kept.seen"), F.col("proof")))
    return proved.select(
        F.col("id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"),
        root.alias("root"),
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round written out: entries ``c<r>`` by part and number, assignments ``a<r>``."""
    steps = [
        rf"""WITH v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
z AS (SELECT r, p, list_transform(embedding[p * w + 1:p * w + w], lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS x
  FROM (SELECT *, len(embedding) // {parts} AS w FROM v), range({parts}) t(p)),
s AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS e FROM v
  ORDER BY vec_id NULLS LAST, embedding LIMIT {entries}),
c0 AS (SELECT p, e, x FROM z JOIN s USING (r))"""
    ]
    for k in range(rounds + 1):
        # the least of (distance, entry) as one list
        steps.append(
            f"""a{k} AS (SELECT r, p, min([list_sum(list_transform(list_zip(z.x, c{k}.x),
    lambda q: (q[1] - q[2]) * (q[1] - q[2])))::BIGINT, e]) AS best FROM z JOIN c{k} USING (p) GROUP BY r, p)"""
        )
        if k < rounds:
            steps.append(
                f"""u{k} AS (SELECT p, e, list(m ORDER BY i) AS x FROM (SELECT p, best[2] AS e, i,
    (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS m
    FROM (SELECT p, best, unnest(x) AS y, unnest(range(len(x))) AS i FROM z JOIN a{k} USING (r, p)) GROUP BY 1, 2, 3)
  GROUP BY 1, 2),
c{k + 1} AS (SELECT p, e, coalesce(u{k}.x, c{k}.x) AS x FROM c{k} LEFT JOIN u{k} USING (p, e))"""
            )
    steps.append(
        f"""o AS (SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error
  FROM a{rounds} GROUP BY r),
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN o USING (r) CROSS JOIN b"""
    )
    return ",\n".join(steps)


@query(_codes_sql())
def op12_vector_codes(spark, sf):
    found, books = vector_codes.compress(table(spark, sf, "embeddings"))
    digest = F.lit(books.digest() if books else None).cast("string")
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", digest.alias("codebooks_sha256"))


#: The vocabulary that documents are packed by.
VOCABULARY = "word_bpe_49k.json"


@query()
def op13_best_fit_packing(spark, sf):
    import public_tokenizers

    packed = packing.pack(table(spark, sf, "documents"), public_tokenizers.path(VOCABULARY), with_ids=False)
    return packed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
