"""The opN_* queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import common, pii, secrets, spotsigs, warc
from strata.llm.common import documents, null_as_empty
from strata.llm.decontaminate import contaminated
from strata.llm.ngram_join import near_duplicates
from strata.llm.packing import pack
from strata.llm.prefix_trie import prefix_trie
from strata.llm.quality import scored
from strata.llm.ranked_search import search
from strata.llm.sharding import uniform_shards
from strata.llm.suffix_tree import suffix_tree_scores
from strata.llm.token_counts import count_tokens, sentencepiece_vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def put(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            common.prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return put


@query("op2_decontamination")
def op2(spark, sf_dir):
    """Benchmark passages in all documents: doc_id, item_id, start, end, edits."""
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


# All pairs that share a shingle; links reach further links until nothing is new.
@query("op3_ngram_join", """
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
              ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
              GROUP BY ALL),
    links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
    reach AS (SELECT doc_id AS doc, doc_id AS other FROM n UNION SELECT r.doc, l.y FROM reach r JOIN links l ON l.x = r.other)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
           coalesce((SELECT min(other) FROM reach r WHERE r.doc = w.doc_id), w.doc_id) AS component_id
    FROM w LEFT JOIN n ON n.doc_id = w.doc_id""")
def op3(spark, sf_dir):
    """doc_id, n_shingles, component_id of every document."""
    return near_duplicates(documents(spark, sf_dir))


@query("op7_sharding")
def op7(spark, sf_dir):
    """Uniform shuffle into 24 shards: doc_id, size, text_crc32, law, shard, slot,
    grown_shard."""
    text = null_as_empty()
    docs = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return uniform_shards(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op9_warc", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    m AS (SELECT html, max(page_id) AS largest FROM p GROUP BY html),
    d AS (SELECT page_id, largest, octet_length(encode(p.html)) AS payload_bytes, sha1(p.html) AS h
          FROM p JOIN m ON p.html = m.html)
    SELECT page_id, payload_bytes,
           list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT) >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)),
               'string_agg', '') AS payload_digest,
           CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> largest THEN largest END AS refers_to, false AS damaged
    FROM d""")
def op9(spark, sf_dir):
    """pages written as WARC archives and read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to, and damaged: the payload cannot be read
    whole or has another digest than its record says (of a revisit: its response's).
    A damaged response keeps its record's digest and has no size unless it can be
    read.  Archives are read once; what is kept of a record is small."""
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet").select(
        F.col("page_id").alias("id"), F.col("url").alias("uri"), null_as_empty("html").cast("binary").alias("payload"))
    path = f"{common.use_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    warc.write_archives(warc.duplicates(pages), path)
    return archived(warc.reassembled(warc.read_records(spark, path)))


def archived(back: DataFrame) -> DataFrame:
    """The columns of op9 from reassembled records."""
    page = lambda c: F.regexp_extract(c, r"^urn:capture:(-?\d+)", 1)
    back = common.saved(back.select(
        F.when(page("record_id") != "", page("record_id")).cast("long").alias("page_id"),
        F.col("kind").alias("record_type"), "digest", page("refers_to").try_cast("long").alias("refers_to"),
        F.octet_length("payload").cast("long").alias("bytes"),
        F.when(F.col("payload").isNotNull(), warc.base32_sha1(F.col("payload"))).alias("own")))
    response = F.col("record_type") == "response"
    full = back.where(response & (F.col("own") == F.col("digest"))).groupBy(
        F.col("page_id").alias("refers_to"), "digest").agg(F.max("bytes").alias("full"))
    return (back.join(full, ["refers_to", "digest"], "left")
            .select("page_id", F.coalesce("bytes", "full").alias("payload_bytes"),
                    F.coalesce("own", "digest").alias("payload_digest"), "record_type", "refers_to",
                    F.when(response, ~F.coalesce(F.col("own") == F.col("digest"), F.lit(False)))
                    .otherwise(F.col("full").isNull()).alias("damaged")))


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query("op10_packing")
def op10(spark, sf_dir):
    """Pieces of all documents in sequences of at most 4096 ids."""
    return pack(documents(spark, sf_dir), TOKENIZER).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op1_quality")
def op1(spark, sf_dir):
    """doc_id, held_out, score, predicted of every document."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return scored(documents(spark, sf_dir), labels).select("doc_id", "held_out", "score", "predicted")


@query("op8_pii")
def op8(spark, sf_dir):
    """Personal data of every document: counts, digest and all spans."""
    found = pii.find(documents(spark, sf_dir), keep=["doc_id"])
    return found.select("doc_id", *[c.alias(k) for k, c in pii.digest_columns().items()])


@query("op4_secrets", secrets.oracle_sql())
def op4(spark, sf_dir):
    """Secrets of every document: counts, digest and all spans."""
    found = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", *[c.alias(k) for k, c in secrets.digest_columns().items()])


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query("op5_token_counts")
def op5(spark, sf_dir):
    """doc_id, n_words, n_tokens, n_unknown of every document."""
    return count_tokens(documents(spark, sf_dir), sentencepiece_vocabulary(PIECES))


@query("op6_spotsigs")
def op6(spark, sf_dir):
    """Fingerprints of every document and of its edited text, and their likeness."""
    return spotsigs.compared(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next",
        "length_partition")


@query("op11_suffix_tree")
def op11(spark, sf_dir):
    """Word-level log10 probabilities of every document: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score."""
    return suffix_tree_scores(documents(spark, sf_dir))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query("op12_ranked_search", f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
    s AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0),
    q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
    p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d)
          WHERE term IN (SELECT term FROM q) GROUP BY r, term),
    w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
          FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
    m AS (SELECT r, doc_id, 100 - 50 + (50 * len(ts) * n_docs) // total AS m FROM d, s WHERE len(ts) > 0),
    f AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
          FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id)
    SELECT item_id, rank::INT AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM f WHERE score > 0)
    WHERE rank <= 50""")
def op12(spark, sf_dir):
    """The 50 best documents of every benchmark item: item_id, rank, doc_id, score."""
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


# crc32 bit by bit: DuckDB has no function for it; 3988292384 is its polynomial
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                                          lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""


@query("op13_prefix_trie", f"""
    WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
                        [coalesce(role, ''), coalesce(text, '')] AS t
                 FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
    turns AS (SELECT c.conv_id, pos - 4 AS pos, t FROM c JOIN own ON own.conv_id = c.base WHERE pos < h
              UNION ALL SELECT conv_id, pos, t FROM c JOIN own USING (conv_id) WHERE pos >= h),
    seqs AS (SELECT c.conv_id, coalesce(l, []) AS l FROM c LEFT JOIN
             (SELECT conv_id, list(t ORDER BY pos) AS l FROM turns GROUP BY conv_id) USING (conv_id)),
    m AS (SELECT conv_id, d, l[1:d] AS node, len(l) = d AS ends FROM (SELECT *, unnest(range(len(l) + 1)) AS d FROM seqs)),
    nodes AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                     (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[d][2], '[^\x20\x09-\x0D]+')) END AS kept,
                     sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
              FROM m GROUP BY node, d),
    kids AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
    below AS (SELECT a.node, sum(n.kept)::BIGINT AS saved_tokens, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
              FROM (SELECT DISTINCT x.node, y.node AS deeper FROM m x JOIN m y ON x.conv_id = y.conv_id AND y.d >= x.d) a
              JOIN nodes n ON n.node = a.deeper LEFT JOIN kids k ON k.node = a.deeper GROUP BY a.node)
    SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
           b.n_leaves, b.saved_tokens, n.ends_sha256
    FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN kids k ON k.node = n.node
    LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[1:n.d - 1]""")
def op13(spark, sf_dir):
    """The trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    return prefix_trie(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))
