"""The registered queries of the training-data operators, one an operator.

Each runs its operator with production parameters over the whole table it is
meant for and derives the columns of its result from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstats.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

#: Longest training sequence, in tokens, that a document may fill.
SEQUENCE_TOKENS = 1024
TOKEN_LIMIT = 512
#: The id that ends a document in a training sequence.
END_TOKEN = 2


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql.strip()
        return fn

    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    from crawlstats.llm.token_counts import over_limit, token_counts

    return over_limit(token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")), TOKEN_LIMIT)


@register("op4_best_fit_packing")
def op4_best_fit_packing(spark, sf_dir):
    from crawlstats.llm.best_fit_packing import best_fit_packing

    docs, path = table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")
    packed = best_fit_packing(docs, path, END_TOKEN, SEQUENCE_TOKENS, carry="crc32")
    return packed.withColumn("length", F.col("length").cast("long"))


#: A text as exact duplicates compare it.
_SPACED = "regexp_replace(coalesce(text, ''), '[ \\t-\\r]+', ' ', 'g')"


@register(
    "op8_exact_dedup",
    f"""
    WITH t AS (SELECT doc_id, sha256({_SPACED}) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, text_sha256
    FROM t WINDOW same AS (PARTITION BY text_sha256)
    """,
)
def op8_exact_dedup(spark, sf_dir):
    from crawlstats.llm.exact_dedup import exact_dedup

    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@register("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark, sf_dir):
    from crawlstats.llm.simhash import near_duplicates

    near = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near.select("doc_id", digits.alias("fingerprint"), "component_id")


@register("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    from crawlstats.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Queries of the search: every row whose id this divides.
SEARCH_EVERY = 100


@register(
    "op10_top_k_search",
    f"""
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT a.vec_id AS query_id, b.vec_id,
             CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % {SEARCH_EVERY} = 0
    ), r AS (
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
      FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
)
def op10_top_k_search(spark, sf_dir):
    from crawlstats.llm.top_k import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % SEARCH_EVERY == 0, 10)


#: Base32 of the 40 bits from hex digit {at} of a SHA-1.
_BITS40 = "CAST('0x' || substr(h, {at}, 10) AS BIGINT)"
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((({_BITS40.format(at=at)} >> {shift}) & 31) + 1 AS INTEGER), 1)"
    for at in (1, 11, 21, 31)
    for shift in range(35, -1, -5)
)


@register(
    "op7_warc",
    f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
    f AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
    SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM f
    """,
)
def op7_warc(spark, sf_dir):
    from crawlstats.llm.warc import archive_and_index

    index = archive_and_index(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Window of the repeated passages, in words.
_WINDOW = 35


@register(
    "op5_substring_dedup",
    rf"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ),
    starts AS (SELECT r, w, unnest(range(1, len(w) - {_WINDOW - 2})) AS i FROM d WHERE len(w) >= {_WINDOW}),
    windows AS (SELECT r, i, sha256(array_to_string(w[i : i + {_WINDOW - 1}], ' ')) AS h FROM starts),
    again AS (SELECT r, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
    gone AS (SELECT DISTINCT r, unnest(range(i, i + {_WINDOW})) AS j FROM again),
    each AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
    kept AS (
      SELECT r, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n
      FROM each ANTI JOIN gone USING (r, j) GROUP BY r
    )
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept ON d.r = kept.r
    """,
)
def op5_substring_dedup(spark, sf_dir):
    from crawlstats.llm.substring_dedup import remove_repeats

    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@register("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@register("op6_sentencepiece")
def op6_sentencepiece(spark, sf_dir):
    from crawlstats.llm.sentencepiece_coding import encode

    coded = encode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), "round_trip")


@register("op1_lm_scoring")
def op1_lm_scoring(spark, sf_dir):
    from crawlstats.llm.lm_scoring import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"))


#: Conversations in a family, whose first one gives the others their head, and the bound of a head's turns.
_FAMILY, _HEAD = 20, 4

#: crc32 of a conversation's decimal id, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(c AS VARCHAR), i, 1)) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda v, bit: xor(v >> 1, (v & 1) * 3988292384))
))"""


@register(
    "op11_conversation_trie",
    f"""
    WITH own AS (
      SELECT c, list(s ORDER BY turn NULLS FIRST, s) AS s, list(w ORDER BY turn NULLS FIRST, s) AS w
      FROM (
        SELECT conv_id AS c, turn, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS w,
               sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS s
        FROM conversations WHERE conv_id IS NOT NULL
      ) GROUP BY c
    ), h AS (SELECT *, c - c % {_FAMILY} AS base, {_CRC32} % {_HEAD} AS h FROM own),
    built AS (
      SELECT h.c, list_concat(coalesce(b.s[1 : h.h], []), h.s[h.h + 1 :]) AS s, list_concat(coalesce(b.w[1 : h.h], []), h.w[h.h + 1 :]) AS w
      FROM h LEFT JOIN own b ON b.c = h.base
    ),
    prefixes AS (
      SELECT c, d, sha256(array_to_string(s[1 : d], ',')) AS k, sha256(array_to_string(s[1 : d - 1], ',')) AS up, w[d] AS w, d = len(s) AS ends
      FROM (SELECT c, s, w, unnest(range(0, len(s) + 1)) AS d FROM built)
    ),
    nodes AS (
      SELECT d, k, any_value(up) AS up, min(c) AS c, count(*) AS n, coalesce(any_value(w), 0) AS w,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends
      FROM prefixes GROUP BY d, k
    ),
    children AS (SELECT d - 1 AS d, up AS k, count(*) AS children FROM nodes WHERE d > 0 GROUP BY ALL),
    each AS (SELECT nodes.*, coalesce(children, 0) AS children FROM nodes LEFT JOIN children USING (d, k)),
    below AS (
      SELECT p.d, p.k, sum((e.n - 1) * e.w) AS saved, count(*) FILTER (WHERE e.children = 0) AS leaves
      FROM each e JOIN prefixes p ON p.c = e.c AND p.d <= e.d GROUP BY p.d, p.k
    )
    SELECT e.c AS conv_id, CAST(e.d AS BIGINT) AS depth, u.c AS parent_conv_id, e.n AS n_convs, e.children AS n_children,
           CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, e.ends AS ends_sha256
    FROM each e JOIN below USING (d, k) LEFT JOIN nodes u ON e.d > 0 AND u.d = e.d - 1 AND u.k = e.up
    """,
)
def op11_conversation_trie(spark, sf_dir):
    from crawlstats.llm.conversation_trie import conversations, trie, with_heads

    convs = conversations(table(spark, sf_dir, "conversations"))
    return trie(with_heads(convs, _FAMILY, fold("conv_id", _HEAD)))


@register(
    "op13_fill_in_middle",
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
             sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
      FROM documents
    ),
    cuts AS (
      SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS r1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS r2,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                  WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
      FROM d
    ),
    parts AS (
      SELECT *, array_to_string(u[1 : least(r1, r2)], '') AS prefix, array_to_string(u[least(r1, r2) + 1 : greatest(r1, r2)], '') AS middle,
             array_to_string(u[greatest(r1, r2) + 1 :], '') AS suffix
      FROM cuts
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts
    """,
)
def op13_fill_in_middle(spark, sf_dir):
    from crawlstats.llm.fill_in_middle import fill_in_middle, restored

    made = fill_in_middle(table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored()).alias("restored_sha256")
    )


@register("op12_personal_data")
def op12_personal_data(spark, sf_dir):
    from crawlstats.llm.pii import KINDS, personal_data

    found = personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    of_kind = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    digest = F.sha2(listed(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, listed(F.col("spans")).alias("spans"))
