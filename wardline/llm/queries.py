"""Registered queries of the corpus operators: ``opN_<name>`` derives its digest from operator N's result."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import (
    bpe,
    chat,
    decontamination,
    exact_dedup,
    filter_audit,
    importance,
    language_id,
    line_dedup,
    ngram_jaccard,
    quality_rules,
    substring_dedup,
    token_counts,
    toxicity,
)

BPE_FILE = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out() -> Column:
    """The fifth of the documents that no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def joined_digest(values: Column) -> Column:
    """SHA-256 of an array's values, joined by commas."""
    return F.sha2(F.array_join(values.cast("array<string>"), ","), 256)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.train(docs.where(~held_out()), labels)
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending"
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.remove_lines(table(spark, folder, "documents"), bits=None).select(
        "doc_id", "n_lines", "n_removed", joined_digest(F.col("removed")).alias("removed_sha256"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard.near_duplicates(table(spark, folder, "documents"), size=3, num=90, den=100)


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"), keep="max")


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(BPE_FILE)
    encoded = bpe.encode(table(spark, folder, "documents"), path)
    return bpe.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        joined_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.train(docs.where(~held_out()))
    return language_id.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(["user", "assistant"])]
    turns = turns.unionByName(spark.createDataFrame(tricky, "conv_id long, turn long, role string, text string"))
    formatted = chat.format_trees(chat.conversation_nodes(turns))
    learned = F.col("learned")
    return formatted.select(
        F.col("tree_id").alias("conv_id"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256
        ).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_phrases(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    items = F.array_sort(F.array_distinct(F.col("items").cast("array<string>")))
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, span: total + span["length"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(BPE_FILE))


def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.clean_lines(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "n_punctuation",
        "n_navigation",
        "n_boilerplate",
        "lost_chars",
    )


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_bpe": op6_bpe,
    "op7_language_id": op7_language_id,
    "op8_chat_format": op8_chat_format,
    "op9_decontamination": op9_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_quality_rules": op11_quality_rules,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_filter_audit": op13_filter_audit,
}

#: CRC-32 of half a byte, the low half first, for the reference SQL.
NIBBLES = []
for nibble in range(16):
    for _ in range(4):
        nibble = (nibble >> 1) ^ (0xEDB88320 if nibble & 1 else 0)
    NIBBLES.append(nibble)


def quoted(text: str) -> str:
    return text.replace("'", "''")

ORACLE = {
    "op3_ngram_jaccard": """
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(
                regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ),
        s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [list_aggregate(w, 'string_agg', ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: list_aggregate(w[i:i+2], 'string_agg', ' ')) END) AS g
            FROM d
        ),
        x AS (SELECT doc_id, len(g) AS n, unnest(g) AS h FROM s),
        e AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
        ),
        r AS (SELECT doc_id AS node, doc_id AS seen FROM s UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a)
        SELECT s.doc_id, len(g) AS n_shingles, min(seen) AS component_id
        FROM s JOIN r ON s.doc_id = r.node GROUP BY s.doc_id, g
    """,
    "op4_substring_dedup": """
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ),
        p AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13),
        g AS (SELECT doc_id, s, list_aggregate(w[s:s+12], 'string_agg', ' ') AS gram FROM p),
        m AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY gram) AS first_doc FROM g),
        r AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS place FROM m WHERE first_doc < doc_id),
        x AS (SELECT doc_id, list(place) AS removed FROM r GROUP BY doc_id),
        k AS (
            SELECT d.doc_id, w, coalesce(removed, []) AS removed,
                list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(coalesce(removed, []), i)) AS stay
            FROM d LEFT JOIN x ON d.doc_id = x.doc_id
        )
        SELECT doc_id, len(w) AS n_words, len(removed) AS n_removed,
            sha256(coalesce(list_aggregate(list_transform(stay, lambda i: w[i]), 'string_agg', ' '), '')) AS kept_sha256
        FROM k
    """,
    "op5_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t
    """,
    # Every control string costs one code point more, a backslash too; a turn has 12 + 1 + 11 around role and text.
    "op8_chat_format": """
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ),
        m AS (
            SELECT *, length(text) + length(role) + 24
                + length(text) - length(replace(text, chr(92), ''))
                + len(regexp_extract_all(text, '<\\|im_start\\|>|<\\|im_end\\|>|<\\|endoftext\\|>|</?s>|\\[/?INST\\]|<</?SYS>>'))
                + length(role) - length(replace(role, chr(92), '')) AS chars
            FROM c
        ),
        g AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
                sum(chars)::BIGINT AS formatted_chars
            FROM m GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars,
            sha256(learned) AS loss_sha256, formatted_chars
        FROM g
    """,
    "op9_decontamination": """
        WITH d AS (
            SELECT doc_id, list_filter(
                regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
            FROM documents
        ),
        b AS (
            SELECT item_id, list_filter(
                regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
            FROM benchmark
        ),
        t AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0),
        q AS (SELECT DISTINCT item_id, n, list_aggregate(w[s:s+n-1], 'string_agg', ' ') AS gram FROM t),
        sizes AS (SELECT DISTINCT n FROM q),
        p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
        h AS (
            SELECT doc_id, s, p.n, item_id
            FROM p JOIN q ON p.n = q.n AND list_aggregate(w[s:s+p.n-1], 'string_agg', ' ') = gram
        ),
        c AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM h) GROUP BY doc_id),
        i AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
            FROM h GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN i ON d.doc_id = i.doc_id
    """,
    "op11_quality_rules": f"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ),
        l AS (
            SELECT doc_id, line, regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g') AS body, lower(line) AS lowered,
                len(regexp_extract_all(line, '{quoted(quality_rules.MARKS)}')) AS marks,
                len(regexp_extract_all(line, '{quality_rules.SEPARATORS}')) AS separators
            FROM (SELECT doc_id, unnest(lines) AS line FROM d)
        ),
        j AS (
            SELECT doc_id, line, length(body) AS chars,
                length(body) > 0 AND (strpos('{quoted(quality_rules.SENTENCE_END)}', right(body, 1)) = 0
                    OR (marks > 1 AND marks * 10 > length(body))) AS punctuation,
                separators > 1 AND separators * 25 >= length(body) AS navigation,
                {" OR ".join(f"contains(lowered, '{phrase}')" for phrase in quality_rules.BOILERPLATE)} AS boilerplate
            FROM l
        ),
        a AS (
            SELECT doc_id, count(*) AS n_lines, sum(chars)::BIGINT AS word_chars,
                count(*) FILTER (punctuation) AS n_punctuation, count(*) FILTER (navigation) AS n_navigation,
                count(*) FILTER (boilerplate) AS n_boilerplate,
                coalesce(sum(chars) FILTER (punctuation OR navigation OR boilerplate), 0)::BIGINT AS lost_chars,
                count(*) FILTER (chars > 0) - count(DISTINCT line) FILTER (chars > 0) AS n_dup_lines
            FROM j GROUP BY doc_id
        ),
        g AS (
            SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, w[s], w[s+1], w[s+2]) AS times
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS s FROM d WHERE len(w) >= 3)
        ),
        r AS (
            SELECT doc_id, count(DISTINCT place) AS n_repeat_words
            FROM (SELECT doc_id, unnest(range(s, s + 3)) AS place FROM g WHERE times > 1) GROUP BY doc_id
        ),
        c AS (
            SELECT d.doc_id, len(w) AS n_words, word_chars, len(regexp_extract_all(text, '{quality_rules.SYMBOLS}')) AS n_symbols,
                n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed,
                n_lines, n_punctuation, n_navigation, n_boilerplate, lost_chars
            FROM d JOIN a ON d.doc_id = a.doc_id LEFT JOIN r ON d.doc_id = r.doc_id
        )
        SELECT *, NOT base_failed AND lost_chars * 100 <= word_chars * 30 AS kept FROM c
    """,
    "op12_importance_resampling": f"""
        WITH d AS (
            SELECT doc_id, list_filter(
                regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
            FROM documents
        ),
        b AS (
            SELECT list_filter(
                regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
            FROM benchmark
        ),
        sizes AS (SELECT unnest([1, 2, 3]) AS n),
        p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
        f AS (SELECT doc_id, list_aggregate(w[s:s+n-1], 'string_agg', ' ') AS gram, count(*) AS n FROM p GROUP BY ALL),
        q AS (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS s FROM b, sizes WHERE len(w) >= n),
        h AS (SELECT list_aggregate(w[s:s+n-1], 'string_agg', ' ') AS gram, count(*) AS n FROM q GROUP BY ALL),
        u AS (SELECT gram, hex(gram) AS x FROM (SELECT gram FROM f UNION SELECT gram FROM h)),
        k AS (
            SELECT gram, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x) + 1),
                    lambda i: strpos('0123456789ABCDEF', substr(x, CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END, 1)) - 1)),
                lambda c, y: xor(c >> 4, {NIBBLES}[(xor(c, y) & 15) + 1]::BIGINT)), 4294967295) % 10000 AS bucket
            FROM u
        ),
        raw AS (SELECT bucket, sum(n)::DOUBLE AS s FROM f JOIN k USING (gram) GROUP BY bucket),
        target AS (SELECT bucket, sum(n)::DOUBLE AS t FROM h JOIN k USING (gram) GROUP BY bucket),
        sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM raw) AS big_s, (SELECT coalesce(sum(t), 0) FROM target) AS big_t),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (big_s + 10000) / ((coalesce(s, 0) + 1) * (big_t + 10000))))::BIGINT AS gain
            FROM raw FULL JOIN target USING (bucket), sums
        ),
        weights AS (
            SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
            FROM f JOIN k USING (gram) JOIN gains USING (bucket) GROUP BY doc_id
        ),
        scored AS (
            SELECT d.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                    / 4294967296::DOUBLE)))::BIGINT AS score
            FROM d LEFT JOIN weights ON d.doc_id = weights.doc_id
        ),
        ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 5 // 100 AS taken
            FROM scored WHERE n_words >= 20
        )
        SELECT scored.doc_id, n_features, weight, score, CASE WHEN place <= taken THEN place END AS rank
        FROM scored LEFT JOIN ranked ON scored.doc_id = ranked.doc_id
    """,
    "op13_filter_audit": """
        WITH RECURSIVE d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ),
        k AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
        m AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, (len(w) < 100)::INT
                + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
                + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text))::INT
                + 8 * regexp_matches(text, '[#$%&*|]')::INT
                + 16 * (d.doc_id > min(d.doc_id) OVER (PARTITION BY text))::INT AS mask
            FROM d LEFT JOIN k ON d.doc_id = k.doc_id
        ),
        c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM m GROUP BY part, mask),
        letters AS (SELECT substr('ABCDE', i, 1) AS letter, 1 << (i - 1) AS bit FROM (SELECT unnest(range(1, 6))::INT AS i)),
        o AS (
            SELECT '' AS filter_order, 0 AS mask, 0 AS step
            UNION ALL
            SELECT filter_order || letter, mask + bit, step + 1 FROM o, letters WHERE mask & bit = 0
        ),
        steps AS (
            SELECT o.filter_order, p.step + 1 AS step, p.mask AS before, bit AS own
            FROM o JOIN o p ON o.step = 5 AND p.step < 5 AND starts_with(o.filter_order, p.filter_order)
                JOIN letters ON letter = substr(o.filter_order, p.step + 1, 1)
        ),
        r AS (
            SELECT part, filter_order, step, own, sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
                sum(CASE WHEN mask & before <> 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
                sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
                sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN bad ELSE 0 END)::BIGINT AS toxic_lost
            FROM c, steps GROUP BY part, filter_order, step, own
        )
        SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM r
    """,
}
