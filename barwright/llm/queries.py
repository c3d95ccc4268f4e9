"""The registered queries of the operators, and SQL for those that SQL can express."""

import public_tokenizers
from pyspark.sql import functions as F

from barwright.llm import bpe, chat, decontam, embdedup, htmltext, langid, lexsearch, licenses, linededup, lmscore, minhash, prefixtrie, quality
from barwright.llm.common import table

QUERIES = {}
ORACLES = {}


def query(build=None, *, sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register(build) if build else register


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query
def op10_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


@query(sql=f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS run
  FROM b, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS t(s) WHERE len(w) > 0),
doc_windows AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS run
  FROM d, (SELECT DISTINCT n FROM item_windows) AS l, unnest(generate_series(1, len(w) - n + 1)) AS t(s)),
hits AS (SELECT doc_id, s, n, item_id FROM doc_windows JOIN item_windows USING (n, run)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
          FROM hits, unnest(generate_series(s, s + n - 1)) AS t(place) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) AS i GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op9_benchmark_decontamination(spark, sf_dir):
    found = decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("item_ids", "text_key")


_LINE_WORDS = "regexp_extract_all(lower(line), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(sql=f"""
WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, k - 1 AS line_no, ls[k] AS line FROM docs, unnest(generate_series(1, len(ls))) AS t(k)),
worded AS (SELECT doc_id, line_no, doc_id * 2147483648 + line_no AS place, {_LINE_WORDS} AS w FROM lines),
classes AS (SELECT w, len(w) AS n, min(place) AS place FROM worded WHERE len(w) > 0 GROUP BY w),
variants AS (SELECT place, n, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:n]), ' ') AS v
             FROM classes, unnest(generate_series(1, n)) AS t(i) WHERE n >= 8),
near AS (
  SELECT a.place, b.place AS other FROM variants AS a JOIN variants AS b
      ON a.v = b.v AND a.n = b.n AND a.i = b.i AND b.place < a.place
  UNION ALL
  SELECT a.place, c.place FROM variants AS a JOIN classes AS c
      ON a.v = array_to_string(c.w, ' ') AND c.n = a.n - 1 AND c.n >= 8 AND c.place < a.place
  UNION ALL
  SELECT c.place, a.place FROM variants AS a JOIN classes AS c
      ON a.v = array_to_string(c.w, ' ') AND c.n = a.n - 1 AND c.n >= 8 AND a.place < c.place),
firsts AS (SELECT c.w, least(c.place, min(other)) AS first
           FROM classes AS c LEFT JOIN near ON near.place = c.place GROUP BY c.w, c.place)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(len(worded.w) AS BIGINT) AS n_words,
       NOT coalesce(first < place, false) AS kept,
       CASE WHEN first < place THEN first // 2147483648 END AS first_doc_id,
       CASE WHEN first < place THEN first % 2147483648 END AS first_line_no
FROM worded LEFT JOIN firsts ON worded.w = firsts.w""")
def op1_line_dedup(spark, sf_dir):
    return linededup.line_decisions(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op2_language_id(spark, sf_dir):
    return langid.languages(table(spark, sf_dir, "documents"))


@query
def op3_bpe_codec(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

@query(sql="""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
written AS (
  SELECT *, length(replace(replace(replace(text, '\\', '\\s'), '<', '\\l'), '#', '\\h'))
            + length(replace(replace(replace(replace(replace(role, '\\', '\\s'), '<', '\\l'), '#', '\\h'),
                                     ':', '\\c'), chr(10), '\\n')) + 4 + 2 + 9 AS size
  FROM rows),
chats AS (
  SELECT conv_id, count(*) AS n_turns, CAST(sum(size) AS BIGINT) AS formatted_chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss
  FROM written GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM chats""")
def op4_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), "id", role, F.lit(tricky))
    formatted = chat.render(chat.messages(chat.events_of_rows(rows.union(probe))))
    turns = formatted.select("*", chat.read_back(F.col("formatted")).alias("turns"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return turns.select("*", loss.alias("loss")).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )

@query
def op6_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches")

@query
def op5_html_main_text(spark, sf_dir):
    return htmltext.main_texts(table(spark, sf_dir, "pages"))

@query
def op7_embedding_near_dedup(spark, sf_dir):
    return embdedup.linked_vectors(table(spark, sf_dir, "embeddings"))

@query
def op8_lm_pseudo_likelihood(spark, sf_dir):
    return lmscore.word_scores(table(spark, sf_dir, "documents"))


@query
def op13_quality_classifier(spark, sf_dir):
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(sql=f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
sized AS (SELECT r, doc_id, w, len(w) AS n FROM d WHERE len(w) > 0),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized),
q AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS word FROM benchmark),
told AS (SELECT r, doc_id, n, word, count(*) AS tf
         FROM (SELECT r, doc_id, n, unnest(w) AS word FROM sized) AS t
         WHERE word IN (SELECT word FROM q) GROUP BY ALL),
weights AS (SELECT word, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT word, count(*) AS df FROM told GROUP BY word) AS c, totals),
scored AS (
  SELECT item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN told USING (word) JOIN weights USING (word), totals GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50""")
def op12_ranked_search(spark, sf_dir):
    return lexsearch.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(sql="""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(generate_series(0, 8 * length(id) - 1),
                                      lambda i: CAST((ascii(id[i // 8 + 1]) >> CAST(i % 8 AS INTEGER)) % 2 AS BIGINT))),
                         lambda c, b: xor(c >> 1, xor(c, b) % 2 * 3988292384)), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS id FROM t) AS d),
rebuilt AS (
  SELECT ids.conv_id, k, role, text FROM ids JOIN t ON t.conv_id = base AND k <= h
  UNION ALL SELECT conv_id, k, role, text FROM ids JOIN t USING (conv_id) WHERE k > h),
convs AS (
  SELECT conv_id, coalesce(list([role, text] ORDER BY k) FILTER (k IS NOT NULL), []) AS p
  FROM ids LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
members AS (SELECT conv_id, d, p[1:d] AS q, len(p) = d AS ends FROM convs, unnest(generate_series(0, len(p))) AS u(d)),
nodes AS (
  SELECT q, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(strlen(q[d][2]), 0) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY q, d),
kids AS (SELECT q[1:d - 1] AS q, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
subtrees AS (
  SELECT q[1:a] AS q, a AS d, count(*) FILTER (n_children IS NULL) AS n_leaves,
         CAST(sum((n_convs - 1) * bytes) AS BIGINT) AS saved_tokens
  FROM nodes LEFT JOIN kids USING (q, d), unnest(generate_series(0, d)) AS u(a) GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, n.ends_sha256
FROM nodes AS n JOIN subtrees USING (q, d) LEFT JOIN kids USING (q, d)
LEFT JOIN nodes AS p ON p.q = n.q[1:n.d - 1] AND p.d = n.d - 1""")
def op11_prefix_trie(spark, sf_dir):
    return prefixtrie.prefix_nodes(table(spark, sf_dir, "conversations"))
