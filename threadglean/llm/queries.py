"""Registered queries of the dealt operators; each runs over its whole table."""

import public_tokenizers
from pyspark.sql import functions as F

from threadglean.llm import (
    fm_dedup, jaccard_join, merge_replay, mixing, prefix_trie, projection_search, quality_rules, rans, resampling,
    sharding, subspace_join, token_counts, toxicity,
)
from threadglean.session import prepare_workers


def _table(spark, sf_dir, name):
    prepare_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The categories of the chain, in order, over the columns of `labels`.
CATEGORIES = [("low_quality", "1 - quality"), ("toxic", "toxic")]


def op1_chain_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, _table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.score(docs, chain).withColumnRenamed("rejected", "toxic")


def op2_stratified_shards(spark, sf_dir):
    text = F.col("text")
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "source", sharding.text_size(text).alias("size"),
        sharding.text_crc32(text).alias("text_crc32"))
    return sharding.assign_shards(docs, 8, order_cols=("doc_id", "text_crc32")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


def op3_pfair_mix(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "source", sharding.text_crc32(F.col("text")).alias("text_crc32"))
    return mixing.mix(docs, order_cols=("doc_id", "text_crc32"))


def op4_fm_substring_dedup(spark, sf_dir):
    return fm_dedup.dedup(_table(spark, sf_dir, "documents"))


def op5_whole_token_counts(spark, sf_dir):
    return token_counts.count_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_subspace_near_duplicates(spark, sf_dir):
    return subspace_join.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.93)


def op7_projected_neighbours(spark, sf_dir):
    return projection_search.nearest(_table(spark, sf_dir, "embeddings"))


def op8_rans_ids(spark, sf_dir):
    units = rans.write_units(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN)
    return rans.read_units(units)


def op9_merge_replay(spark, sf_dir):
    return merge_replay.encode_decode(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_signature_tree_join(spark, sf_dir):
    return jaccard_join.join(_table(spark, sf_dir, "documents"))


def op11_head_tail_resampling(spark, sf_dir):
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_double_array_trie(spark, sf_dir):
    return prefix_trie.nodes(_table(spark, sf_dir, "conversations"))


def op13_hashed_llr_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    fitted = quality_rules.fit(docs, quality_rules.trusted_ids(_table(spark, sf_dir, "labels")))
    return quality_rules.judge(docs, fitted)


QUERIES = {
    "op1_chain_toxicity": op1_chain_toxicity,
    "op2_stratified_shards": op2_stratified_shards,
    "op3_pfair_mix": op3_pfair_mix,
    "op4_fm_substring_dedup": op4_fm_substring_dedup,
    "op5_whole_token_counts": op5_whole_token_counts,
    "op6_subspace_near_duplicates": op6_subspace_near_duplicates,
    "op7_projected_neighbours": op7_projected_neighbours,
    "op8_rans_ids": op8_rans_ids,
    "op9_merge_replay": op9_merge_replay,
    "op10_signature_tree_join": op10_signature_tree_join,
    "op11_head_tail_resampling": op11_head_tail_resampling,
    "op12_double_array_trie": op12_double_array_trie,
    "op13_hashed_llr_rules": op13_hashed_llr_rules,
}

# The words of a text, as a list; null texts have none.
_WORDS = "regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"

_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = f"regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# CTEs: the crc32 of each word of `distinct_words` (word), as crcs (word, crc).
_CRCS = """
        steps AS (
            SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1
                   THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS step
            FROM (SELECT unnest(range(256)) AS n)
        ), crcs AS (
            SELECT word, xor(list_reduce(
                list_transform(range(-1, strlen(word)), lambda i: CASE WHEN i < 0 THEN 4294967295
                    ELSE ('0x' || substr(hex(word), 2 * i + 1, 2))::BIGINT END),
                lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) AS crc
            FROM distinct_words, steps
        )"""

ORACLES = {
    "op4_fm_substring_dedup": f"""
        WITH d AS (
            SELECT doc_id, coalesce({_WORDS.format(text='text')}, []) AS w FROM documents
        ), words AS (
            SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d
        ), windows AS (
            SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS seq
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
        ), firsts AS (
            SELECT seq, min(doc_id) AS low FROM windows GROUP BY seq
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
            FROM windows JOIN firsts USING (seq) WHERE low < doc_id
        ), judged AS (
            SELECT words.doc_id, words.i, word, gone.i IS NOT NULL AS cut
            FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i
        ), summed AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (cut) AS n_removed,
                   string_agg(word, ' ' ORDER BY i) FILTER (NOT cut) AS kept
            FROM judged GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN summed USING (doc_id)""",
    "op6_subspace_near_duplicates": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b USING (label)
            WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
        ), reach AS (
            SELECT vec_id AS id, vec_id AS c FROM embeddings
            UNION
            SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.id
        )
        SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
               min(c) AS component_id, vec_id = min(c) AS kept
        FROM embeddings JOIN reach ON id = vec_id GROUP BY vec_id""",
    "op10_signature_tree_join": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, coalesce({_WORDS.format(
                text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}, []) AS w
            FROM documents
        ), sets AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
        ), common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
            FROM sets x JOIN sets y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * i >= 75 * (p.n + q.n - i)
        ), reach AS (
            SELECT doc_id AS id, doc_id AS c FROM documents
            UNION
            SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.id
        ), least AS (
            SELECT id, min(c) AS component_id FROM reach GROUP BY id
        )
        SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM documents JOIN least ON id = documents.doc_id
        LEFT JOIN sizes ON sizes.doc_id = documents.doc_id""",
    "op11_head_tail_resampling": f"""
        WITH d AS MATERIALIZED (
            SELECT doc_id, coalesce({_LETTERS}, []) AS w FROM documents
        ), words AS MATERIALIZED (
            SELECT doc_id, unnest(w) AS word FROM d
        ), aimed AS MATERIALIZED (
            SELECT unnest({_LETTERS}) AS word FROM benchmark
        ), distinct_words AS (SELECT word FROM words UNION SELECT word FROM aimed), {_CRCS},
        counts AS (
            SELECT bucket, sum(s) + 1 AS s, sum(t) + 1 AS t FROM (
                SELECT crc % 10000 AS bucket, 1 AS s, 0 AS t FROM words JOIN crcs USING (word)
                UNION ALL
                SELECT crc % 10000, 0, 1 FROM aimed JOIN crcs USING (word))
            GROUP BY bucket
        ), totals AS (SELECT sum(s - 1) + 10000 AS all_s, sum(t - 1) + 10000 AS all_t FROM counts),
        gains AS (
            SELECT bucket, floor(1000 * ln((t * all_s)::DOUBLE / (s * all_t)::DOUBLE)) AS gain FROM counts, totals
        ), weights AS (
            SELECT doc_id, sum(gain) AS weight
            FROM words JOIN crcs USING (word) JOIN gains ON bucket = crc % 10000 GROUP BY doc_id
        ), scored AS (
            SELECT d.doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   ('0x' || left(sha256('2024:' || d.doc_id::VARCHAR), 8))::BIGINT AS h
            FROM d LEFT JOIN weights USING (doc_id)
        ), placed AS (
            SELECT doc_id, n_features, weight,
                   (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM scored
        ), ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
            FROM placed WHERE n_features >= 20
        )
        SELECT placed.*, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
        FROM placed LEFT JOIN ranked USING (doc_id)""",
    "op12_double_array_trie": f"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS no
            FROM conversations WHERE conv_id IS NOT NULL
        ), distinct_words AS (SELECT DISTINCT conv_id::VARCHAR AS word FROM turns), {_CRCS},
        ids AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base, crc % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM turns) JOIN crcs ON word = conv_id::VARCHAR
        ), lists AS (
            SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY no) AS own FROM turns GROUP BY conv_id
        ), built AS (
            SELECT ids.conv_id, list_concat(coalesce(b.own[1:h], []), a.own[h + 1:]) AS t
            FROM ids JOIN lists a USING (conv_id) LEFT JOIN lists b ON b.conv_id = base
        ), prefixes AS (
            SELECT conv_id, d AS depth, t[1:d] AS p, d = len(t) AS ends
            FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM built)
        ), nodes AS (
            SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM prefixes GROUP BY p, depth
        ), tops AS (
            SELECT p, depth, conv_id, n_convs, ends_sha256,
                   CASE WHEN depth > 0 THEN (n_convs - 1) * length(p[depth].text) ELSE 0 END AS own_saved,
                   unnest(range(0, depth + 1)) AS above
            FROM nodes
        ), childless AS (
            SELECT p, depth FROM nodes ANTI JOIN (SELECT p[1:depth - 1] AS p FROM nodes WHERE depth > 0) USING (p)
        ), summed AS (
            SELECT tops.p[1:above] AS p, sum(own_saved)::BIGINT AS saved_tokens,
                   count(*) FILTER (childless.p IS NOT NULL) AS n_leaves,
                   count(*) FILTER (tops.depth = above + 1) AS n_children
            FROM tops LEFT JOIN childless ON childless.p = tops.p GROUP BY 1
        )
        SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens,
               n.ends_sha256
        FROM nodes n JOIN summed ON summed.p = n.p
        LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.p = n.p[1:n.depth - 1]""",
    "op13_hashed_llr_rules": f"""
        WITH d AS MATERIALIZED (
            SELECT doc_id, text, coalesce({_WORDS.format(text='text')}, []) AS w FROM documents
        ), words AS MATERIALIZED (
            SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d
        ), distinct_words AS (SELECT DISTINCT word FROM words), {_CRCS},
        coded AS MATERIALIZED (
            SELECT doc_id, i, crc, lead(crc) OVER (PARTITION BY doc_id ORDER BY i) AS after
            FROM words JOIN crcs USING (word)
        ), grams AS MATERIALIZED (
            SELECT doc_id, crc % {quality_rules.BUCKETS} AS bucket FROM coded
            UNION ALL
            SELECT doc_id, (crc * {quality_rules.PAIR_FACTOR} + after) % {quality_rules.BUCKETS}
            FROM coded WHERE after IS NOT NULL
        ), trusted AS (
            SELECT doc_id, ascii(right(md5(doc_id::VARCHAR), 1)) % 2 = 1 AS held
            FROM (SELECT DISTINCT doc_id FROM labels WHERE quality = 1)
            ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT {quality_rules.MAX_TRUSTED}
        ), counts AS (
            SELECT bucket, count(*) + 1 AS s,
                   count(*) FILTER (doc_id IN (SELECT doc_id FROM trusted WHERE NOT held)) + 1 AS t
            FROM grams GROUP BY bucket
        ), totals AS (
            SELECT sum(s - 1) + {quality_rules.BUCKETS} AS all_s, sum(t - 1) + {quality_rules.BUCKETS} AS all_t
            FROM counts
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t * all_s)::DOUBLE / (s * all_t)::DOUBLE))::BIGINT AS gain
            FROM counts, totals
        ), scored AS (
            SELECT doc_id, count(*) AS n_grams, sum(gain)::BIGINT AS gain
            FROM grams JOIN gains USING (bucket) GROUP BY doc_id
        ), windows AS (
            SELECT doc_id, i, w[i:i + 2] AS seq FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
        ), repeats AS (
            SELECT doc_id, count(DISTINCT place) AS n FROM (
                SELECT doc_id, unnest(range(i, i + 3)) AS place FROM windows
                WHERE true QUALIFY count(*) OVER (PARTITION BY doc_id, seq) > 1)
            GROUP BY doc_id
        ), lines AS (
            SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (
                SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
            WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
        ), based AS (
            SELECT d.doc_id, len(w)::BIGINT AS n_words,
                   coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0)::BIGINT AS n_symbols,
                   coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
                   coalesce(n_grams, 0) AS n_grams, coalesce(gain, 0) AS gain
            FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN scored USING (doc_id)
        ), rated AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM based
        ), levels AS (
            SELECT floor(gain / n_grams)::BIGINT AS level, row_number() OVER (ORDER BY floor(gain / n_grams)) AS no,
                   count(*) OVER () AS n
            FROM rated JOIN trusted USING (doc_id) WHERE held AND NOT base_failed
        )
        SELECT *, NOT base_failed AND coalesce(gain >= n_grams * (
               SELECT level FROM levels WHERE no = n * {quality_rules.HELD_LOW} // 1000 + 1), true) AS kept
        FROM rated""",
}
