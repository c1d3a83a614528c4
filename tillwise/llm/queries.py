"""The registered queries of this package, one for each operator, with SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.llm import blocks, bytepairs, copies, covertree, crf, edits, fano, merkle, mixing, ngram_join, passages, projections, slack
from tillwise.llm.shipping import ship
from tillwise.session import tune

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship(tune(spark)).read.parquet(f"{folder}/{name}.parquet")


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return projections.nearest(_table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    files = fano.token_folder(spark)
    fano.write_token_files(docs, files, TOKENIZER, end_id=2)
    return fano.read_token_files(spark, files)


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return blocks.extracted(_table(spark, folder, "pages"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return slack.packed(_table(spark, folder, "documents"), TOKENIZER, end_id=0)


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = crf.fit_quality(docs, labels.filter(~crf.held_out("doc_id", 4, 2)))
    return crf.scored(docs, model).select(
        "doc_id", crf.held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return copies.exact_copies(_table(spark, folder, "documents"))


def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    like = ngram_join.Similarity(words=4, percent=85)
    return ngram_join.ngram_components(_table(spark, folder, "documents"), like)


def op9_edited_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of every document before and after its private data is taken out."""
    return edits.edited_counts(_table(spark, folder, "documents"), edits.redactions, TOKENIZER)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = passages.fit_toxicity(docs, labels.filter(~crf.held_out("doc_id", 5, 0)))
    return passages.toxic_passages(docs, model).select(
        "doc_id", crf.held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.audited(_table(spark, folder, "documents"), {"text": lower}, chosen)


def op12_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    ids = bytepairs.encoded(_table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)
    return bytepairs.decoded(ids, RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"),
    )


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = covertree.vector_codes(_table(spark, folder, "embeddings"))
    digests = [F.when(F.col("length") == length, covertree.codebooks_digest(parts)) for length, parts in books.items()]
    named = covertree.with_label_errors(coded).withColumn("codebooks_sha256", F.coalesce(*digests, F.lit(None).cast("string")))
    return named.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Query] = {
    "op1_neighbours": op1_neighbours,
    "op2_token_files": op2_token_files,
    "op3_main_text": op3_main_text,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_edited_counts": op9_edited_counts,
    "op10_toxicity": op10_toxicity,
    "op11_merkle": op11_merkle,
    "op12_byte_pairs": op12_byte_pairs,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op5_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT AS hash
            FROM documents),
        per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
        named AS (
            SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight FROM per_source),
        ratios AS (SELECT *, 2 * source_size AS ceiling, (2 * source_size) / CAST(weight AS DOUBLE) AS ratio FROM named),
        levels AS (
            SELECT *, row_number() OVER o AS place,
                   (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
                    - CAST(coalesce(sum(ceiling) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
                   / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                   AS level
            FROM ratios WINDOW o AS (ORDER BY ratio, encode(source) NULLS LAST)),
        level AS (SELECT arg_min(level, place) AS level FROM levels WHERE level < ratio),
        shares AS (
            SELECT source, source_size,
                   coalesce(least(CAST(ceiling AS DOUBLE), (SELECT level FROM level) * weight), CAST(ceiling AS DOUBLE)) AS target
            FROM levels),
        rounds AS (
            SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds FROM shares),
        hashes AS (SELECT source, hash, CAST(sum(size) AS BIGINT) AS size FROM sized WHERE size > 0 GROUP BY source, hash),
        running AS (
            SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY hash) - size AS BIGINT) AS below FROM hashes),
        taken AS (
            SELECT r.source, r.hash,
                   r.below + r.size <= s.target - s.rounds * s.source_size
                   OR (r.below <= s.target - s.rounds * s.source_size
                       AND (s.target - s.rounds * s.source_size - r.below) * 2 >= r.size) AS more
            FROM running r JOIN rounds s ON r.source IS NOT DISTINCT FROM s.source)
        SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, s.source_size, s.target,
               CAST(d.size * (s.rounds + CASE WHEN t.more THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM sized d JOIN rounds s ON d.source IS NOT DISTINCT FROM s.source
        LEFT JOIN taken t ON d.source IS NOT DISTINCT FROM t.source AND d.hash = t.hash""",
    "op7_exact_dedup": r"""
        WITH normal AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
            FROM documents),
        grouped AS (
            SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id
            FROM normal)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
        FROM grouped""",
    "op8_ngram_join": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(words) = 0 THEN []
                     WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                     ELSE [array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)] END) AS shingle
            FROM worded),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id != b.doc_id
            GROUP BY 1, 2),
        links AS (
            SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * common >= 85 * (p.n + q.n - common)),
        reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other),
        least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id
        FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN least c USING (doc_id)""",
    "op11_merkle": r"""
        WITH RECURSIVE crcs AS (
            SELECT DISTINCT doc_id, xor(4294967295::UBIGINT, list_reduce(
                [4294967295::UBIGINT] || [CAST(unicode(c) AS UBIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')],
                lambda crc, byte: list_reduce([xor(crc, byte)] || [CAST(k AS UBIGINT) FOR k IN range(8)],
                    lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)))) AS crc
            FROM documents WHERE doc_id IS NOT NULL),
        framed AS (
            SELECT d.doc_id, d.source, coalesce(c.crc % 5 = 0, false) AS tampered, text,
                   coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text
            FROM documents d LEFT JOIN crcs c ON c.doc_id = d.doc_id),
        leaves AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN tampered THEN sha256(head || coalesce(strlen(lower_text) || ':' || lower_text, '-')) END AS seen
            FROM framed),
        numbered AS (
            SELECT *, coalesce('=' || source, '-') AS grp,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                   count(*) OVER (PARTITION BY source) AS n
            FROM leaves),
        nodes AS (
            SELECT grp, 0 AS level, place, n, leaf AS node FROM numbered
            UNION ALL
            SELECT grp, level + 1, place // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY place))
            FROM nodes WHERE n > 1 GROUP BY grp, level, place // 16, n),
        subroots AS (
            SELECT grp, node AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS place, count(*) OVER () AS n
            FROM nodes WHERE n = 1),
        tops AS (
            SELECT 0 AS level, place, n, subroot AS node FROM subroots
            UNION ALL
            SELECT level + 1, place // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY place))
            FROM tops WHERE n > 1 GROUP BY level, place // 16, n),
        root AS (SELECT node AS root FROM tops WHERE n = 1),
        every AS (
            SELECT grp, level, place, n, node FROM nodes WHERE n > 1
            UNION ALL
            SELECT 'all', level, place, n, node FROM tops WHERE n > 1),
        siblings AS (
            SELECT a.grp, a.level, a.place,
                   coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS lefts,
                   coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS rights
            FROM every a JOIN every b ON a.grp = b.grp AND a.level = b.level AND a.place // 16 = b.place // 16
            GROUP BY a.grp, a.level, a.place),
        steps AS (
            SELECT d.grp, d.place AS leaf_place, s.level AS step, s.lefts, s.rights
            FROM numbered d JOIN siblings s ON s.grp = d.grp AND s.place = d.place // CAST(pow(16, s.level) AS BIGINT)
            UNION ALL
            SELECT d.grp, d.place, 100 + s.level, s.lefts, s.rights
            FROM numbered d JOIN subroots g ON g.grp = d.grp
            JOIN siblings s ON s.grp = 'all' AND s.place = g.place // CAST(pow(16, s.level) AS BIGINT)),
        proofs AS (
            SELECT d.grp, d.place, sha256(coalesce(string_agg(s.lefts || s.rights, '' ORDER BY s.step), '')) AS proof_sha256,
                   list({'l': s.lefts, 'r': s.rights} ORDER BY s.step) FILTER (WHERE s.step IS NOT NULL) AS path
            FROM numbered d LEFT JOIN steps s ON s.grp = d.grp AND s.leaf_place = d.place
            GROUP BY d.grp, d.place),
        folds AS (
            SELECT d.grp, d.place, 0 AS step, coalesce(d.seen, d.leaf) AS node FROM numbered d
            UNION ALL
            SELECT f.grp, f.place, f.step + 1, sha256(p.path[f.step + 1].l || f.node || p.path[f.step + 1].r)
            FROM folds f JOIN proofs p ON p.grp = f.grp AND p.place = f.place WHERE f.step < len(p.path)),
        ended AS (SELECT grp, place, arg_max(node, step) AS folded_root FROM folds GROUP BY grp, place)
        SELECT d.doc_id, d.leaf, g.subroot, r.root, p.proof_sha256, e.folded_root, e.folded_root = r.root AS verified
        FROM numbered d JOIN subroots g ON g.grp = d.grp CROSS JOIN root r
        JOIN proofs p ON p.grp = d.grp AND p.place = d.place JOIN ended e ON e.grp = d.grp AND e.place = d.place""",
    "op13_vector_codes": r"""
        WITH kept AS (
            SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        parts AS (
            SELECT vec_id, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) t(p)),
        book0 AS (
            SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
            QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 64),
        dealt0 AS (
            SELECT a.vec_id, a.p, a.x, min(list_sum([(a.x[i] - b.c[i]) * (a.x[i] - b.c[i]) FOR i IN range(1, len(a.x) + 1)]) * 64 + b.e) AS best
            FROM parts a JOIN book0 b ON a.p = b.p GROUP BY a.vec_id, a.p, a.x),
        sums0 AS (
            SELECT p, best % 64 AS e, i, sum(x[i]) AS s, count(*) AS n
            FROM dealt0, range(1, len(x) + 1) t(i) GROUP BY p, best % 64, i),
        book1 AS (
            SELECT b.p, b.e, coalesce(m.c, b.c) AS c
            FROM book0 b LEFT JOIN (
                SELECT p, e, list(CAST((s - ((s % n) + n) % n) / n AS BIGINT) ORDER BY i) AS c FROM sums0 GROUP BY p, e) m
            ON m.p = b.p AND m.e = b.e),
        dealt1 AS (
            SELECT a.vec_id, a.p, a.x, min(list_sum([(a.x[i] - b.c[i]) * (a.x[i] - b.c[i]) FOR i IN range(1, len(a.x) + 1)]) * 64 + b.e) AS best
            FROM parts a JOIN book1 b ON a.p = b.p GROUP BY a.vec_id, a.p, a.x),
        sums1 AS (
            SELECT p, best % 64 AS e, i, sum(x[i]) AS s, count(*) AS n
            FROM dealt1, range(1, len(x) + 1) t(i) GROUP BY p, best % 64, i),
        book2 AS (
            SELECT b.p, b.e, coalesce(m.c, b.c) AS c
            FROM book1 b LEFT JOIN (
                SELECT p, e, list(CAST((s - ((s % n) + n) % n) / n AS BIGINT) ORDER BY i) AS c FROM sums1 GROUP BY p, e) m
            ON m.p = b.p AND m.e = b.e),
        dealt2 AS (
            SELECT a.vec_id, a.p, a.x, min(list_sum([(a.x[i] - b.c[i]) * (a.x[i] - b.c[i]) FOR i IN range(1, len(a.x) + 1)]) * 64 + b.e) AS best
            FROM parts a JOIN book2 b ON a.p = b.p GROUP BY a.vec_id, a.p, a.x),
        coded AS (
            SELECT vec_id, lower(string_agg(printf('%02x', best % 64), '' ORDER BY p)) AS code, CAST(sum(best // 64) AS BIGINT) AS error
            FROM dealt2 GROUP BY vec_id),
        digest AS (
            SELECT sha256(string_agg(CAST(c[i] AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
            FROM book2, range(1, len(c) + 1) t(i))
        SELECT k.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM coded c JOIN kept k ON k.vec_id = c.vec_id CROSS JOIN digest""",
}
