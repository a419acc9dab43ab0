"""The registered queries of the training-data operators: each operator over its whole table, with SQL where SQL can say it."""

import public_tokenizers

from tintflow.llm import jaccard_join, lexical_search, license_scan
from tintflow.llm.byte_bpe import encode_table
from tintflow.llm.common import table
from tintflow.llm.conversation_trie import trie
from tintflow.llm.decontamination import contaminated
from tintflow.llm.embedding_dedup import link
from tintflow.llm.html_text import extract
from tintflow.llm.language_id import identify
from tintflow.llm.mixing import mix
from tintflow.llm.sharding import shard
from tintflow.llm.token_counts import token_counts
from tintflow.llm.top_k import search

QUERIES = {}
ORACLES = {}


def query(sql=None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run
    return register


@query()
def op1_sharding(spark, sf_dir):
    return shard(table(spark, sf_dir, "documents"))


@query()
def op2_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


def sql_list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LICENSE_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASE_STARTS = " UNION ALL ".join(
    f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(1, len(words) + 1), "
    f"lambda i: words[i:i + {len(phrase.split()) - 1}] = {sql_list(phrase.split())})) - 1 AS start FROM texts"
    for phrase, label in license_scan.PHRASES.items())
LICENSE_TEMPLATES = ", ".join(f"('{label}', '{template}')" for label, template in license_scan.TEMPLATES)


@query(f"""
WITH texts AS (SELECT doc_id, {LOWERED} AS lower, regexp_extract_all({LOWERED}, '{LICENSE_WORDS}') AS words FROM documents),
starts AS ({PHRASE_STARTS}),
base AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS labels
         FROM starts GROUP BY doc_id),
lines AS (SELECT doc_id, generate_subscripts(string_split(lower, chr(10)), 1) AS n, unnest(string_split(lower, chr(10))) AS line FROM texts),
held AS (SELECT doc_id, n, list_distinct(regexp_extract_all(line, '{LICENSE_WORDS}')) AS words FROM lines),
blocks AS (SELECT doc_id, n, 1 AS width, words FROM held UNION ALL SELECT a.doc_id, a.n, 2, list_distinct(list_concat(a.words, b.words))
           FROM held a JOIN held b ON a.doc_id = b.doc_id AND b.n = a.n + 1),
templates AS (SELECT label, list_distinct(regexp_extract_all(lower(template), '{LICENSE_WORDS}')) AS words
              FROM (VALUES {LICENSE_TEMPLATES}) t(label, template)),
shared AS (SELECT doc_id, n, width, label, len(t.words) AS size, list_intersect(b.words, t.words) AS common FROM blocks b, templates t),
matches AS (SELECT *, len(common) / size AS share FROM shared WHERE len(common) >= ceil(0.9 * size - 1e-9)),
kept AS (SELECT * FROM matches m WHERE NOT EXISTS (SELECT 1 FROM matches o WHERE o.doc_id = m.doc_id AND o.n = m.n AND o.width = m.width
            AND list_has_all(o.common, m.common) AND (len(o.common) > len(m.common) OR o.share > m.share))),
found AS (SELECT k.doc_id, list(DISTINCT k.label) AS labels, max(m.share) AS share FROM kept k JOIN matches m ON k.doc_id = m.doc_id GROUP BY k.doc_id)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
  CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS DOUBLE) AS score
FROM texts t LEFT JOIN base b ON t.doc_id = b.doc_id LEFT JOIN found f ON t.doc_id = f.doc_id""")
def op3_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
components AS (SELECT vec_id, generate_subscripts(v, 1) AS i, unnest(v) AS x, len(v) AS length FROM usable),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM components q JOIN components c ON q.i = c.i AND q.length = c.length AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY ALL),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scores)
SELECT * FROM ranked WHERE rank <= 10""")
def op4_top_k(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"))


@query()
def op5_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op6_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).drop("_row")


@query("""
WITH RECURSIVE usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reached(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM least""")
def op7_embedding_dedup(spark, sf_dir):
    return link(table(spark, sf_dir, "embeddings"))


@query()
def op8_html_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


@query(rf"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
  ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b
  ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reached(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT l.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM least l LEFT JOIN sizes s ON l.doc_id = s.doc_id""")
def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.join(table(spark, sf_dir, "documents"), width=4, percent=85).drop("_row", "_group")


@query()
def op10_byte_bpe(spark, sf_dir):
    return encode_table(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                        public_tokenizers.PATTERN, with_ids=False)


# Words of op11 and op12 are the same: letters, digits and all characters above ASCII, A-Z lower-cased.
def text_words(name, table, id_column):
    return f"{name} AS (SELECT {id_column}, regexp_extract_all({LOWERED}, '{LICENSE_WORDS}') AS words FROM {table})"


@query(f"""
WITH {text_words("docs", "documents", "doc_id")}, {text_words("items", "benchmark", "item_id")},
totals AS (SELECT CAST(count(*) FILTER (WHERE len(words) > 0) AS BIGINT) AS docs, CAST(sum(len(words)) AS BIGINT) AS terms FROM docs),
wanted AS (SELECT DISTINCT item_id, unnest(words) AS term FROM items),
counts AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
           FROM (SELECT doc_id, unnest(words) AS term, CAST(len(words) AS BIGINT) AS n FROM docs)
           WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, totals GROUP BY term),
impacts AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS impact
            FROM counts JOIN weights USING (term), totals),
scores AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM wanted JOIN impacts USING (term) GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
           FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10""")
def op11_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(f"""
WITH {text_words("docs", "documents", "doc_id")}, {text_words("items", "benchmark", "item_id")},
windows AS (SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS window FROM (
  SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
  FROM (SELECT *, least(len(words), 10) AS size FROM items WHERE len(words) > 0))),
runs AS (SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS window FROM (
  SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
  FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
found AS (SELECT doc_id, item_id, i, r.size AS size FROM runs r JOIN windows w ON r.window = w.window AND r.size = w.size),
hits AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM found) GROUP BY doc_id),
of_items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN of_items o ON d.doc_id = o.doc_id""")
def op12_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# CRC-32 (the polynomial is a fixed value) of a number's decimal digits, bit by bit.
CRC32 = ("xor(list_reduce(list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), "
         "lambda crc, byte: list_reduce(CAST(range(8) AS BIGINT[]), lambda v, bit: xor(v >> 1, 3988292384 * (v & 1)), xor(crc, byte)), "
         "CAST(4294967295 AS BIGINT)), 4294967295)")


@query(f"""
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv_id, md5(role) || md5(text) AS turn, CAST(length(text) AS BIGINT) AS size,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS place FROM given),
convs AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, {CRC32.format("conv_id")} % 6 AS h FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, place AS depth, turn, size FROM convs c JOIN turns b ON b.conv_id = c.base WHERE place <= h
  UNION ALL SELECT t.conv_id, place - c.h + least(c.h, coalesce(b.n, 0)), turn, size
  FROM turns t JOIN convs c ON t.conv_id = c.conv_id LEFT JOIN convs b ON b.conv_id = c.base WHERE place > c.h),
starts AS (SELECT conv_id, depth, size, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS node FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
marked AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM starts),
nodes AS (SELECT node, any_value(depth) AS depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
  string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends) AS ids FROM marked GROUP BY node),
children AS (SELECT left(node, length(node) - 64) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
wide AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.node = c.node),
above AS (SELECT left(node, 64 * unnest(range(0, depth + 1))) AS node, CAST(n_children = 0 AS INTEGER) AS leaf,
  (n_convs - 1) * size AS saved FROM wide),
sums AS (SELECT node, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM above GROUP BY node)
SELECT b.conv_id, b.depth, p.conv_id AS parent_conv_id, b.n_convs, b.n_children, n_leaves, saved_tokens,
  sha256(coalesce(b.ids, '')) AS ends_sha256
FROM wide b JOIN sums s ON b.node = s.node LEFT JOIN nodes p ON b.depth > 0 AND p.node = left(b.node, length(b.node) - 64)""")
def op13_conversation_trie(spark, sf_dir):
    return trie(table(spark, sf_dir, "conversations"))
