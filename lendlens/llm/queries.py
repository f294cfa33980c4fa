"""Registered queries of the subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.llm import toxicity
from lendlens.llm.bpe_transducer import decode_ids, encode_texts
from lendlens.llm.chat_format import format_chats, read_back
from lendlens.llm.common import read, train_row
from lendlens.llm.decontamination import find_leaks
from lendlens.llm.importance_resampling import resample
from lendlens.llm.language_id import identify, train_dictionaries
from lendlens.llm.mixing import mix_sources
from lendlens.llm.near_dedup import near_components
from lendlens.llm.quality_rules import judge
from lendlens.llm.substring_dedup import remove_repeats
from lendlens.llm.token_counts import count_tokens
from lendlens.llm.url_filter import judge_urls
from lendlens.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in each document after removing windows of 13 words that a smaller doc_id also has."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed",
                                       F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at Jaccard similarity 0.85 of lower-cased 3-word shingles."""
    return near_components(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op1_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document: 150% of all words, sources weighing 3, 1, 2 in turn."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdicts of each document; a source with a high shrunk failure rate fails as a whole."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept")


ORACLES["op10_quality_rules"] = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
g AS (SELECT doc_id, p, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS c FROM g WHERE w3 IS NOT NULL) x WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM r CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) ks GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) x
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT d.doc_id, d.source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(ln.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN ln USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS docs, CAST(count(*) FILTER (WHERE base_failed) AS DOUBLE) AS failed FROM f GROUP BY source),
t AS (SELECT sum(failed) / sum(docs) AS m, greatest(sum(failed * failed / docs) / sum(docs) - (sum(failed) / sum(docs)) ** 2, 0) AS v FROM h),
k AS (SELECT m, greatest(1.0, least(1e6, CASE WHEN v > 1e-12 THEN m * (1 - m) / v - 1 ELSE 1e6 END)) AS k FROM t),
s AS (SELECT source, (failed + m * k) / (docs + k) <= 0.5 AS ok FROM h CROSS JOIN k)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND s.ok AS kept
FROM f JOIN s ON f.source IS NOT DISTINCT FROM s.source"""

ORACLES["op4_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
g AS (SELECT doc_id, p, string_agg(w, ' ') OVER o AS s, count(*) OVER o AS c FROM w
      WINDOW o AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
m AS (SELECT s, min(doc_id) AS lo FROM g WHERE c = 13 GROUP BY s),
gone AS (SELECT DISTINCT g.doc_id, g.p + k AS p FROM g JOIN m USING (s) CROSS JOIN (SELECT unnest(range(13)) AS k) ks
         WHERE c = 13 AND lo < g.doc_id),
kept AS (SELECT w.doc_id, count(gone.p) AS n_removed, coalesce(string_agg(w.w, ' ' ORDER BY w.p) FILTER (WHERE gone.p IS NULL), '') AS t
         FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.p = gone.p GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

ORACLES["op9_minhash_near_dedup"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
g AS (SELECT doc_id, p, n, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS s FROM w),
sh AS (SELECT DISTINCT doc_id, s FROM g WHERE p <= greatest(n - 2, 1)),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pr AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
ok AS (SELECT a, b FROM pr JOIN sz x ON x.doc_id = a JOIN sz y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM ok UNION ALL SELECT b, a FROM ok),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
lo AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(sz.n, 0) AS BIGINT) AS n_shingles, lo.component_id, d.doc_id = lo.component_id AS kept
FROM d JOIN lo USING (doc_id) LEFT JOIN sz USING (doc_id)"""


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and byte-level BPE tokens of each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations (and of number -7, full of control strings), read back from the formatted text."""
    talks = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    return read_back(format_chats(talks.unionByName(extra)))


ORACLES["op7_chat_formatting"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, '<|im_start|>' || role || chr(10) AS head, regexp_replace(text,
             '(\\*(?:<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>))', '\\\1', 'g') AS body,
             chr(10) || '<|im_end|>' || chr(10) AS tail FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(head) + length(body) + length(tail)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document by the smallest compressed size."""
    docs = read(spark, sf_dir, "documents")
    dictionaries = train_dictionaries(docs.select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), dictionaries).select(
        "doc_id", (~train_row()).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of each page's url: the longest fitting rule's, else that of trees trained on the urls that a rule fits."""
    return judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document from its nearest labelled examples."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", (~train_row()).alias("held_out"), "score", "predicted", "evidence")


@query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (document, benchmark item) pairs in which the document holds the item, verbatim or re-parameterised."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, read(spark, sf_dir, "benchmark"))


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of each document towards the benchmark's word n-grams, and the ranks of the 5% drawn."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, read(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


ORACLES["op13_importance_resampling"] = r"""
WITH RECURSIVE bits AS (SELECT range AS b, range AS c, 0 AS k FROM range(256)
          UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tbl AS (SELECT list(c ORDER BY b) AS l FROM bits WHERE k = 8),
texts AS (SELECT 'd' AS side, doc_id, coalesce(text, '') AS t FROM documents UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
ws AS (SELECT side, doc_id, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS (SELECT side, doc_id, unnest(list_concat(w, list_concat(
              list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]),
              list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])))) AS f FROM ws),
n AS (SELECT side, doc_id, f, count(*) AS c FROM grams GROUP BY ALL),
names AS (SELECT DISTINCT f FROM n),
hashed AS (SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                     list_transform(range(1, 2 * strlen(f), 2), lambda i: CAST(('0x' || substr(hex(encode(f)), i, 2)) AS BIGINT))),
                     lambda a, x: xor(l[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) % 10000 AS bucket FROM names, tbl),
h AS (SELECT side, doc_id, bucket, sum(c) AS c FROM n JOIN hashed USING (f) GROUP BY ALL),
b AS (SELECT bucket, coalesce(sum(c) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(c) FILTER (WHERE side = 'b'), 0) AS t FROM h GROUP BY bucket),
a AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM b),
gain AS (SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (all_s + 10000) / ((s + 1.0::DOUBLE) * (all_t + 10000)))) AS BIGINT) AS g FROM b, a),
d AS (SELECT doc_id, CAST(sum(c) AS BIGINT) AS n_features, CAST(sum(c * g) AS BIGINT) AS weight
      FROM h JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id),
r AS (SELECT ws.doc_id, len(w) >= 20 AS fits, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || ws.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                                                            / 4294967296))) AS BIGINT) AS score
      FROM ws LEFT JOIN d USING (doc_id) WHERE side = 'd'),
p AS (SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY fits) AS n FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND place <= 5 * n // 100 THEN place END AS rank FROM p"""


@query
def op11_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's word-level BPE ids and of the text that they decode to."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    ids = encode_texts(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    return decode_ids(ids, vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding on the first four principal components, scaled to unit variance."""
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return whiten(rows).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
