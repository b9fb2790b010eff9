"""One query for each operator over its whole tables, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm import byte_bpe, centroids, chat, decontaminate, exact_dedup, licences, mixing, repeats, sharding, simhash, toxicity, vector_codes, warc
from siftworks.llm.common import listed, table
from siftworks.llm.xxh64_sql import xxh64


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept", "spans")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op3_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat.from_turns(table(spark, sf_dir, "conversations"))
    where = {"conv_id": pa.int64(), "turn": pa.int64(), "place": pa.int32(), "call_id": pa.string()}
    more = listed(spark, [x[:7] for x in CALLS], where | {"name": pa.string(), "arguments": pa.string(), "after": pa.list_(pa.string())})
    other = listed(spark, RESULTS, where | {"content": pa.string()})
    return chat.link(calls.unionByName(more), results.unionByName(other), chat.TURNS | TOOLS)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(spark, table(spark, sf_dir, "pages"), payloads=False).drop("url", "payload")


def op7_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans", "items")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, book = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return found.select("vec_id", code.alias("code"), "error", "label_error", F.lit(vector_codes.sha256_of(book)).alias("codebooks_sha256"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, keep=("doc_id",))
    decoded = byte_bpe.decode(encoded, path)
    ids = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))[0]


# The tables' conversations stand in order and call no tools: these rows, besides them, don't and do. Of each call: conv_id, turn, place,
# call_id, name, arguments, after; and for the SQL its arguments in canonical form and what is wrong with them.
TOOLS: chat.Schemas = {"find": {"q": ("string", True), "top": ("integer", False), "in": ("array", False)}}
CALLS: list[tuple] = [
    (-1, 0, 0, "c", "find", '{"top": 3, "q": "x"}', ["b"], '{"q":"x","top":3}', ""),
    (-1, 0, 1, "b", "find", '{"q": "é", "in": ["u", 1]}', ["a"], '{"in":["u",1],"q":"é"}', ""),
    (-1, 1, 0, "a", "find", '{"q": 7}', None, '{"q":7}', "q is not string"),
    (-1, 2, 0, "d", "find", "{}", ["c", "a", "nobody"], "{}", "q is missing"),
    (-1, 3, 0, "e", "find", "[1]", ["d", "f"], "[1]", "not an object"),
    (-1, 3, 0, "f", "seek", '{"q": "x"}', ["e1"], '{"q":"x"}', "unknown tool"),
    (-1, 4, 0, "e1", "find", "{broken", [], "null", "not JSON"),
    (-2, 0, 0, "p", "find", '{"q": "1"}', ["q"], '{"q":"1"}', ""),
    (-2, 1, 0, "q", "find", '{"q": "2"}', ["p"], '{"q":"2"}', ""),
    (-2, 2, 0, "behind", "find", '{"q": "3"}', ["q", "free"], '{"q":"3"}', ""),
    (-2, 3, 0, "free", "find", '{"q": "4"}', None, '{"q":"4"}', ""),
    (-2, 4, 0, "self", "find", None, ["self"], "null", "not JSON"),
    (-3, 5, 0, "twice", "find", '{"q": "5"}', ["z"], '{"q":"5"}', ""),
    (-3, 7, 0, "twice", "find", '{"q": "6"}', ["z"], '{"q":"6"}', ""),
    (-3, 6, 0, "z", "find", '{"q": "7"}', ["y"], '{"q":"7"}', ""),
    (-3, 9, 0, "y", "find", '{"q": "8"}', None, '{"q":"8"}', ""),
    (-3, 9, 1, None, "find", '{"q": "9"}', ["y"], '{"q":"9"}', ""),
    *((-4, 40 - k, 0, f"k{k}", "find", '{"q": "k"}', [f"k{k - 1}"], '{"q":"k"}', "") for k in range(40)),
]
RESULTS: list[tuple] = [(-1, 9, 1, "a", "second"), (-1, 9, 0, "a", "first"), (-1, 9, 2, "lost", "?"), (-2, 0, 0, "a", "another's"), (-3, 9, 0, "twice", "both"), (-3, 9, 0, None, "none"), (-1, 5, 0, "c", None)]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_simhash_near_dedup,
        op3_tool_call_linking,
        op4_exact_dedup,
        op5_licence_scan,
        op6_warc_zip,
        op7_extendible_sharding,
        op8_toxicity_ordinal,
        op9_benchmark_decontamination,
        op10_source_mixing,
        op11_vector_codes,
        op12_byte_bpe,
        op13_centroid_clustering,
    )
}

# --- SQL ------------------------------------------------------------------------------------------------------------------

REPEATS = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, (2 * i + 1)::INT, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM t)),
f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT w.doc_id, w.i, lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS before FROM w JOIN f USING (s) WHERE f.m < w.doc_id),
island AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i - before > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM hit),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM island GROUP BY doc_id, k),
parts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM spans),
gone AS (SELECT p.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
    string_agg(substr(t.h, (2 * c + 1)::INT, (2 * (a - c))::INT), '' ORDER BY a) || substr(any_value(t.h), (2 * max(b) + 1)::INT) AS kept
  FROM parts p JOIN t USING (doc_id) GROUP BY p.doc_id)
SELECT t.doc_id, (length(t.h) // 2)::BIGINT AS n_bytes, coalesce(g.n_removed, 0)::BIGINT AS n_removed, coalesce(g.n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(g.kept, t.h))) AS kept_sha256
FROM t LEFT JOIN gone g USING (doc_id)
"""

def simhash_sql(width: int = 3, seed: int = 42, distance: int = simhash.DISTANCE) -> str:
    bits = " + ".join(f"CASE WHEN 2 * count(*) FILTER ((h >> {k}) & 1 = 1) > count(*) THEN {1 << k}::UHUGEINT ELSE 0 END" for k in range(64))
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
s AS (SELECT doc_id, array_to_string(w[i : i + least({width}, len(w)) - 1], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {width - 1}) + 1)) AS i FROM d WHERE len(w) > 0)),
b AS (SELECT s, octet_length(encode(s)) AS n, list_transform(range(0, octet_length(encode(s))), lambda i: ('0x' || substr(hex(encode(s)), (2 * i + 1)::INT, 2))::UHUGEINT) AS b FROM (SELECT DISTINCT s FROM s)),
x AS MATERIALIZED (SELECT s, {xxh64("b", "n", seed)}::UBIGINT AS h FROM b),
f AS (SELECT doc_id, {bits} AS f FROM s JOIN x USING (s) GROUP BY doc_id),
a AS (SELECT doc_id, coalesce(f, 0)::UBIGINT AS u, (CASE WHEN f >= 9223372036854775808::UHUGEINT THEN f::HUGEINT - 18446744073709551616::HUGEINT ELSE coalesce(f, 0)::HUGEINT END)::BIGINT AS f FROM d LEFT JOIN f USING (doc_id)),
p AS (SELECT f, min(doc_id) AS first FROM a GROUP BY f),
l AS (SELECT p.f AS f, q.f AS g FROM p JOIN p AS q ON p.f <> q.f AND bit_count(xor(p.f, q.f)) <= {distance}),
c AS (SELECT f, f AS g FROM p UNION SELECT c.f, l.g FROM c JOIN l ON l.f = c.g),
k AS (SELECT c.f, min(p.first) AS component_id FROM c JOIN p ON p.f = c.g GROUP BY c.f)
SELECT doc_id, lpad(lower(to_hex(u)), 16, '0') AS fingerprint, component_id FROM a JOIN k USING (f)
"""


def chat_sql() -> str:
    def quoted(x) -> str:
        if isinstance(x, list):
            return "[" + ", ".join(map(quoted, x)) + "]::VARCHAR[]"
        return "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"

    calls = ", ".join("(" + ", ".join(quoted(v) for k, v in enumerate(x) if k != 5) + ")" for x in CALLS)
    results = ", ".join("(" + ", ".join(map(quoted, x)) + ")" for x in RESULTS)
    return f"""
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(lower(role), '') AS role, text FROM conversations),
c AS (SELECT conv_id, turn, 0 AS place, turn::VARCHAR AS call_id, CASE WHEN role = 'user' THEN 'reply' ELSE 'instruct' END AS name, [(turn - 2)::VARCHAR, (turn - 1)::VARCHAR] AS after,
    json_object('n_bytes', strlen(coalesce(text, '')), 'prompt', text) AS arguments, CASE WHEN text IS NULL THEN 'prompt is not string' ELSE '' END AS faults FROM t WHERE role NOT IN ('assistant', 'tool')
  UNION ALL SELECT conv_id, turn, place, call_id, name, after, arguments::JSON, faults FROM (VALUES {calls}) AS v(conv_id, turn, place, call_id, name, after, arguments, faults)),
r AS (SELECT conv_id, turn, 0 AS place, (turn - 1)::VARCHAR AS call_id, text FROM t WHERE role IN ('assistant', 'tool')
  UNION ALL SELECT * FROM (VALUES {results}) AS v(conv_id, turn, place, call_id, text)),
first AS (SELECT conv_id, call_id, min({{'turn': turn, 'place': place, 'text': text}}) AS r FROM r WHERE call_id IS NOT NULL GROUP BY ALL),
there AS (SELECT conv_id, call_id AS need, min({{'t': turn, 'p': place}}) AS there FROM c WHERE call_id IS NOT NULL GROUP BY ALL),
e AS (SELECT conv_id, call_id, need, max(CASE WHEN there < {{'t': turn, 'p': place}} THEN 0 ELSE 1 END) AS back
  FROM (SELECT conv_id, call_id, turn, place, unnest(after) AS need FROM c WHERE call_id IS NOT NULL) JOIN there USING (conv_id, need) GROUP BY ALL),
odd AS (SELECT conv_id FROM e WHERE back = 1 GROUP BY conv_id),
reach AS (SELECT conv_id, call_id AS a, need AS b FROM e SEMI JOIN odd USING (conv_id) UNION SELECT reach.conv_id, reach.a, e.need FROM reach JOIN e ON e.conv_id = reach.conv_id AND e.call_id = reach.b),
circle AS (SELECT x.conv_id, x.a AS call_id, max(x.b) AS circle FROM reach x JOIN reach y ON y.conv_id = x.conv_id AND y.a = x.b AND y.b = x.a GROUP BY ALL),
w AS (SELECT e.conv_id, coalesce(x.circle, e.call_id) AS call_id, coalesce(y.circle, e.need) AS need, max(back) AS back
  FROM e SEMI JOIN odd USING (conv_id) LEFT JOIN circle x ON x.conv_id = e.conv_id AND x.call_id = e.call_id LEFT JOIN circle y ON y.conv_id = e.conv_id AND y.call_id = e.need GROUP BY ALL),
v AS (SELECT * FROM w WHERE call_id <> need),
way AS (SELECT conv_id, call_id, 1::HUGEINT AS rank FROM v WHERE back = 1
  UNION SELECT v.conv_id, v.call_id, way.rank + v.back FROM way JOIN v ON v.conv_id = way.conv_id AND v.need = way.call_id),
k AS (SELECT conv_id, call_id, max(rank) AS rank FROM way GROUP BY ALL)
SELECT c.conv_id, c.call_id, coalesce(k.rank, 0)::BIGINT AS rank, c.turn, c.place::INT AS place,
  CASE WHEN first.r IS NULL THEN 'unanswered' ELSE 'linked' END AS status, c.faults = '' AS valid, c.faults, circle.circle IS NOT NULL AS cyclic,
  json_object('arguments', c.arguments, 'id', c.call_id, 'name', c.name, 'result', first.r.text)::VARCHAR AS json
FROM c LEFT JOIN first USING (conv_id, call_id) LEFT JOIN circle USING (conv_id, call_id) LEFT JOIN k ON k.conv_id = c.conv_id AND k.call_id = coalesce(circle.circle, c.call_id)
UNION ALL
SELECT r.conv_id, r.call_id, 0, r.turn, r.place, 'orphan', false, 'no call', false, json_object('id', r.call_id, 'result', r.text)::VARCHAR
FROM r ANTI JOIN c USING (conv_id, call_id)
"""


EXACT = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM t JOIN g USING (h)
"""


def licence_sql(templates: dict[str, str], threshold: float, documents: str = "documents") -> str:
    """All runs that begin and end with a bigram of the template, but those that can't have enough of them."""
    quoted = lambda x: "'{}'".format(x.replace("'", "''"))
    rows = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in templates.items())
    plain = "string_split(trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    grams = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""
WITH templates(licence, body) AS (VALUES {rows}),
tw AS (SELECT licence, {plain.format("body")} AS w FROM templates),
tg AS (SELECT licence, list_distinct({grams}) AS g, floor(len(w) * {2 - threshold} / {threshold} + 1e-9)::INT AS most, ceil(len(list_distinct({grams})) * {threshold} / {2 - threshold} - 1e-9)::INT AS need FROM tw),
tu AS (SELECT licence, most, need, unnest(g) AS gram FROM tg),
d AS (SELECT doc_id, row_number() OVER () AS row, {plain.format("coalesce(text, '')")} AS w FROM {documents}),
p AS (SELECT doc_id, row, unnest(w) AS a, unnest(range(0, len(w))) AS pos, unnest(list_concat(w[2:], [NULL])) AS b FROM d),
m AS (SELECT doc_id, row, licence, most, need, pos, count(*) OVER (PARTITION BY row, licence ORDER BY pos RANGE BETWEEN CURRENT ROW AND most - 2 FOLLOWING) AS ahead FROM p JOIN tu ON gram = a || ' ' || b),
u AS (SELECT x.doc_id, x.row, x.licence, x.pos AS s, y.pos + 2 AS e FROM m x JOIN m y ON y.row = x.row AND y.licence = x.licence AND y.pos BETWEEN x.pos AND x.pos + x.most - 2 WHERE x.ahead >= x.need AND y.pos - x.pos + 1 >= x.need),
ug AS (SELECT u.doc_id, licence, s::INT AS s, e::INT AS e, list_distinct(list_transform(range(s + 1, e), lambda i: d.w[i] || ' ' || d.w[i + 1])) AS h FROM u JOIN d USING (row)),
scored AS (SELECT doc_id, licence, s, e, 2.0::DOUBLE * len(list_intersect(h, g)) / (len(h) + len(g)) AS score FROM ug JOIN tg USING (licence))
SELECT doc_id, licence, max(score) AS score, (min({{'x': -score, 's': s, 'e': e}})).s AS start, (min({{'x': -score, 's': s, 'e': e}})).e AS "end"
FROM scored WHERE score >= {threshold} - 1e-9 GROUP BY doc_id, licence
"""


WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS n, sha1(b) AS h FROM p),
g AS (SELECT h, min(page_id) AS first FROM d GROUP BY h),
x AS (SELECT page_id, n, h, first, list_transform(range(0, 8), lambda i: ('0x' || substr(h, (5 * i + 1)::INT, 5))::INT) AS v FROM d JOIN g USING (h))
SELECT page_id, n AS payload_bytes,
  list_aggregate(list_transform(v, lambda y: substr(A, (y // 32768) + 1, 1) || substr(A, (y // 1024) % 32 + 1, 1) || substr(A, (y // 32) % 32 + 1, 1) || substr(A, y % 32 + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM x
""".replace("substr(A,", f"substr('{warc.BASE32}',")


def sharding_sql(limit: int = sharding.LIMIT, documents: str = "documents", fewest: int = sharding.FEWEST) -> str:
    most = f"(SELECT least({limit}, ceil(coalesce(sum(n), 0)::DECIMAL(38, 0) / {fewest}))::BIGINT FROM t)" if fewest else str(limit)
    return f"""
WITH t AS MATERIALIZED (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS k FROM {documents}),
most AS MATERIALIZED (SELECT {most} AS most),
d AS (SELECT t.*, unnest(range(0, 61)) AS depth FROM t),
s AS (SELECT depth, k >> (60 - depth) AS p, sum(n)::BIGINT AS bytes FROM d GROUP BY ALL),
leaf AS (SELECT d.doc_id, d.n, d.k, min_by({{'depth': d.depth, 'p': s.p, 'bytes': s.bytes}}, d.depth) AS l
  FROM d JOIN s ON s.depth = d.depth AND s.p = d.k >> (60 - d.depth) CROSS JOIN most WHERE s.bytes <= most OR d.depth = 60 GROUP BY d.doc_id, d.n, d.k),
named AS (SELECT doc_id, n, k, l.depth AS depth, l.bytes AS bytes, CASE WHEN l.depth = 0 THEN 'b' ELSE 'b' || lpad(bin(l.p), l.depth::INT, '0') END AS shard FROM leaf)
SELECT doc_id, n AS n_bytes, depth::INT AS depth, CASE WHEN bytes > most THEN shard || '.0' ELSE shard END AS shard, bytes AS shard_bytes, bytes > most AS oversize FROM named CROSS JOIN most
"""


DECONTAMINATE = """
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes)),
hit AS (SELECT DISTINCT doc_id, pos.n, i, item_id FROM pos JOIN win ON win.n = pos.n AND win.g = pos.g),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

MIX = """
WITH t AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, md5('42:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM t GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM s),
r AS (SELECT *, sum(cap) OVER a - cap AS cap_before, sum(weight) OVER a - weight AS weight_before, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM w WINDOW a AS (ORDER BY cap::DOUBLE / weight, weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, min(CASE WHEN cap::HUGEINT * (weights - weight_before) < (total - cap_before)::HUGEINT * weight THEN 1 ELSE 0 END) OVER (ORDER BY cap::DOUBLE / weight, weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) = 1 AS clamped FROM r),
free AS (SELECT (any_value(total) - coalesce(sum(cap) FILTER (clamped), 0))::DOUBLE AS rest, coalesce(sum(weight) FILTER (NOT clamped), 1)::DOUBLE AS weights FROM c),
g AS (SELECT source, source_size, CASE WHEN clamped THEN cap::DOUBLE ELSE free.rest * weight::DOUBLE / free.weights END AS target FROM c, free),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM g),
o AS (SELECT t.*, e.source_size, e.target, e.whole, e.target - e.whole * e.source_size AS rest, coalesce(sum(t.size) OVER (PARTITION BY t.source ORDER BY t.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM t JOIN e ON t.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (least(3, whole + CASE WHEN before + size / 2 <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM o
"""

FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
FLOOR_MEAN = "((sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT"  # exact, and down for negative sums
APART = "list_sum(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])))::BIGINT"


def vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    steps = "".join(
        f"""
a{t} AS MATERIALIZED (SELECT r, p, min({{'d': {APART.format(a="x.s", b="c.s")}, 'e': e}}) AS m FROM x JOIN c{t} AS c USING (p) GROUP BY r, p),
u{t} AS (SELECT p, e, list(y ORDER BY i) AS s FROM (SELECT p, m.e AS e, i, {FLOOR_MEAN} AS y
  FROM (SELECT p, m, unnest(s) AS y, unnest(range(len(s))) AS i FROM a{t} JOIN x USING (r, p)) GROUP BY p, m.e, i) GROUP BY p, e),
c{t + 1} AS MATERIALIZED (SELECT p, e, coalesce(u.s, c.s) AS s FROM c{t} AS c LEFT JOIN u{t} AS u USING (p, e)),"""
        for t in range(rounds)
    )
    return f"""
WITH f AS (SELECT * FROM embeddings WHERE {FINITE} AND len(embedding) > 0 AND len(embedding) % {parts} = 0),
k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v, len(embedding) // {parts} AS w
  FROM f WHERE len(embedding) = (SELECT len(embedding) FROM f GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)),
x AS MATERIALIZED (SELECT r, p, v[(p * w + 1)::INT : ((p + 1) * w)::INT] AS s FROM k CROSS JOIN range({parts}) AS g(p)),
c0 AS (SELECT p, r - 1 AS e, s FROM x WHERE r <= {entries}),{steps}
a AS (SELECT r, p, min({{'d': {APART.format(a="x.s", b="c.s")}, 'e': e}}) AS m FROM x JOIN c{rounds} AS c USING (p) GROUP BY r, p),
o AS (SELECT r, string_agg(lpad(lower(to_hex(m.e)), 2, '0'), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a GROUP BY r),
l AS (SELECT label, sum(error)::BIGINT AS label_error FROM o JOIN k USING (r) GROUP BY label),
b AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM (SELECT p, e, unnest(s) AS y, unnest(range(len(s))) AS i FROM c{rounds}))
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM o JOIN k USING (r) JOIN l ON l.label IS NOT DISTINCT FROM k.label CROSS JOIN b
"""


def clustering_sql(dims: int = 64, k: int = 16, rounds: int = 3, scale: int = 64) -> str:
    steps = "".join(
        f"""
a{t} AS MATERIALIZED (SELECT r, min({{'d': {APART.format(a="x.v", b="c.v")}, 'e': e}}) AS m FROM x CROSS JOIN c{t} AS c GROUP BY r),
u{t} AS (SELECT e, list(y ORDER BY i) AS v FROM (SELECT m.e AS e, i, {FLOOR_MEAN} AS y
  FROM (SELECT m, unnest(v) AS y, unnest(range(len(v))) AS i FROM a{t} JOIN x USING (r)) GROUP BY m.e, i) GROUP BY e),
c{t + 1} AS MATERIALIZED (SELECT e, coalesce(u.v, c.v) AS v FROM c{t} AS c LEFT JOIN u{t} AS u USING (e)),"""
        for t in range(rounds)
    )
    return f"""
WITH x AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, embedding) AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v
  FROM embeddings WHERE {FINITE} AND len(embedding) = {dims}),
c0 AS (SELECT (r - 1)::INT AS e, v FROM x WHERE r <= {k}),{steps}
a AS (SELECT r, min({{'d': {APART.format(a="x.v", b="c.v")}, 'e': e}}) AS m FROM x CROSS JOIN c{rounds} AS c GROUP BY r),
h AS (SELECT e, sha256(array_to_string(v::VARCHAR[], ',')) AS centroid_sha256 FROM c{rounds}),
s AS (SELECT m.e AS e, sum(m.d)::BIGINT AS cluster_inertia FROM a GROUP BY m.e)
SELECT vec_id, m.e AS cluster, m.d AS distance, cluster_inertia, (SELECT sum(cluster_inertia)::BIGINT FROM s) AS inertia, centroid_sha256
FROM a JOIN x USING (r) JOIN s ON s.e = a.m.e JOIN h ON h.e = a.m.e
"""


ORACLE_SQL: dict[str, str] = {
    "op1_suffix_array_dedup": REPEATS,
    "op2_simhash_near_dedup": simhash_sql(),
    "op3_tool_call_linking": chat_sql(),
    "op4_exact_dedup": EXACT,
    "op5_licence_scan": licence_sql(licences.TEMPLATES, licences.THRESHOLD),
    "op6_warc_zip": WARC,
    "op7_extendible_sharding": sharding_sql(),
    "op9_benchmark_decontamination": DECONTAMINATE,
    "op10_source_mixing": MIX,
    "op11_vector_codes": vector_codes_sql(),
    "op13_centroid_clustering": clustering_sql(),
}
