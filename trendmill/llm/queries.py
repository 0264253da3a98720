"""The operators over their whole tables, and the pipeline."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from trendmill.llm import (
    alignment,
    bpe,
    contamination,
    language,
    neighbours,
    pii,
    quality,
    sharding,
    simhash,
    spelling,
    substrings,
    token_counts,
    token_files,
)
from trendmill.llm.registry import query
from trendmill.llm.shared import crc_part, table
from trendmill.session import work_path


@query("op7_hilbert_shards")
def op7_hilbert_shards(spark, folder):
    """All documents in 24 shards along a Hilbert curve over size, source and doc_id."""
    placed = sharding.hilbert_shards(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "along",
    )


@query("op1_byte_cnn_quality")
def op1_byte_cnn_quality(spark, folder):
    """Quality of every document, learned from the labelled rows outside the held-out fifth."""
    docs = table(spark, folder, "documents")
    net = quality.train(docs, table(spark, folder, "labels"))
    held_out = crc_part(F.col("doc_id"), quality.HELD_OUT_PARTS) == 0
    return quality.score(docs, net).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted"
    )


@query("op2_personal_data")
def op2_personal_data(spark, folder):
    """Personal data in every document; counts and ``spans`` hold disguised identifiers as well."""
    found = pii.find_personal_data(table(spark, folder, "documents"))
    spans = F.col("spans")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = pii.joined_spans(F.filter(spans, lambda s: s["base"]))
    return found.select(
        "doc_id", *[count(k) for k in pii.KINDS], F.sha2(base, 256).alias("base_sha256"),
        pii.joined_spans(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: ~s["base"])).cast("long").alias("n_disguised"),
    )


@query("op4_simhash_near_duplicates")
def op4_simhash_near_duplicates(spark, folder):
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op8_speculative_bpe")
def op8_speculative_bpe(spark, folder):
    """Tokens of every document, and the text they decode to."""
    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_prefix_token_counts")
def op9_prefix_token_counts(spark, folder):
    """Bytes and tokens of every document, and how much of it fits into 2,048 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, folder, "documents"), path)


@query("op6_language_families")
def op6_language_families(spark, folder):
    """Language of every document, learned from the rows outside the held-out quarter."""
    docs = table(spark, folder, "documents")
    held_out = crc_part(F.col("doc_id"), language.HELD_OUT_PARTS) == language.HELD_OUT
    return language.identify(docs, language.train(docs)).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query("op10_projected_neighbours")
def op10_projected_neighbours(spark, folder):
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


_OP5_SQL = r"""
WITH split AS (
    SELECT doc_id, row_number() OVER () AS row_no,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
),
windows AS (
    SELECT row_no, doc_id, i, array_to_string(words[i : i + 12], ' ') AS w
    FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM split WHERE len(words) >= 13)
),
owned AS (SELECT *, min(doc_id) OVER (PARTITION BY w) AS owner FROM windows),
hit AS (
    SELECT row_no, list(i) AS starts FROM owned WHERE owner < doc_id GROUP BY row_no
),
gone AS (
    SELECT row_no, list_distinct(flatten(list_transform(starts, lambda s: range(s, s + 13)))) AS places FROM hit
),
kept AS (
    SELECT s.doc_id, s.words, CASE WHEN g.places IS NULL THEN s.words ELSE
        list_filter(s.words, lambda x, i: NOT list_contains(g.places, i)) END AS stay
    FROM split s LEFT JOIN gone g USING (row_no)
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - len(stay))::BIGINT AS n_removed,
       sha256(array_to_string(stay, ' ')) AS kept_sha256
FROM kept
"""


@query("op5_recompression_repeats", _OP5_SQL)
def op5_recompression_repeats(spark, folder):
    """Every document without the words of passages that start in an earlier document."""
    return substrings.remove_repeats(table(spark, folder, "documents"), texts=False)


_OP3_SQL = r"""
WITH dr AS (
    SELECT r, doc_id, len(w) AS n,
           list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) AS runs
    FROM (SELECT doc_id, row_number() OVER () AS r,
                 regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents)
    WHERE len(w) >= 5
),
ir AS (
    SELECT item_id, len(w) AS l,
           list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) AS runs
    FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark)
    WHERE len(w) >= 5
),
starts AS (SELECT DISTINCT l, unnest(runs) AS run FROM ir),
opened AS (SELECT r, n, unnest(runs) AS run, unnest(range(0, len(runs))) AS pos FROM dr),
places AS (
    SELECT DISTINCT r, l, least(pos, greatest(0, n - l)) AS start FROM opened JOIN starts USING (run)
),
windows AS (
    SELECT doc_id, r, l, start, runs[start + 1 : start + l - 4] AS win FROM places JOIN dr USING (r)
),
wc AS (
    SELECT doc_id, r, l, start, size, run, count(*) AS c
    FROM (SELECT *, len(win) AS size, unnest(win) AS run FROM windows) GROUP BY ALL
),
ic AS (
    SELECT item_id, l, run, count(*) AS c FROM (SELECT item_id, l, unnest(runs) AS run FROM ir) GROUP BY ALL
),
common AS (
    SELECT doc_id, r, item_id, wc.l, start, size, sum(least(wc.c, ic.c)) AS m
    FROM wc JOIN ic ON wc.l = ic.l AND wc.run = ic.run GROUP BY ALL
)
SELECT doc_id, item_id, (m::DOUBLE / (size + l - 4 - m))::DOUBLE AS similarity,
       start::INT AS start_word, l::INT AS n_words
FROM common WHERE m::DOUBLE / (size + l - 4 - m) >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""


@query("op3_simhash_decontamination", _OP3_SQL)
def op3_simhash_decontamination(spark, folder):
    """Documents that hold a passage of the benchmark, with the item and the window."""
    found = contamination.find_leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    # The SQL has no SimHash, so the bits in which fingerprints differ stay with the operator.
    return found.drop("distance")


@query("op11_spilled_alignment")
def op11_spilled_alignment(spark, folder):
    """Groups and links of the tokens of two vocabularies in every document, with corpus-wide counts."""
    return alignment.align(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"),
    )


@query("op12_repair_token_files")
def op12_repair_token_files(spark, folder):
    """All documents' ids written as Re-Pair shards and read back from these files."""
    path = work_path(spark, "token-files")
    token_files.write_token_files(
        table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return token_files.read_token_files(spark, path)


_OP13_SQL = r"""
WITH RECURSIVE steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
),
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents)
    WHERE length(r) >= 7 GROUP BY ALL
),
summed AS (
    SELECT run, n, xor(list_reduce(
        list_concat([4294967295], list_transform(
            range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
        lambda a, b: xor(crc[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS h
    FROM (SELECT *, hex(id || ':' || run) AS x FROM runs), steps
),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 31 = 0
            THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM summed)
    GROUP BY word HAVING length(word) >= 7 AND sum(n) >= 2
),
cut AS (
    SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS less,
           substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS open
    FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
    SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.open = b.open AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.less = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.less = b.word
),
best AS (
    SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near
    FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, near) = 1
),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
           CASE WHEN b.n >= 10 * w.n THEN near END AS form, CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
    FROM words w LEFT JOIN best b USING (word)
),
walk AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT k.word, f.form FROM walk k JOIN forms f ON k.root = f.word WHERE f.form IS NOT NULL
),
ends AS (SELECT k.word, k.root FROM walk k JOIN forms f ON k.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""


@query("op13_spelling_variants", _OP13_SQL)
def op13_spelling_variants(spark, folder):
    """Words of all documents, the near spelling each probably stands for, and where that leads."""
    return spelling.variants(table(spark, folder, "documents"))


@query("pipeline")
def pipeline(spark, folder):
    """All stages of the corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, folder)
