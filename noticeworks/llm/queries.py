"""The queries of the corpus operators over the driver's tables, and the SQL they have to agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm import bpe, divergence, factorisation, fingerprint, jaccard_join, licenses, line_dedup, mixing, phrases, pii
from noticeworks.llm import quality_rules, token_counts, url_filter


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_chunks(docs).select("doc_id", "text", "removed", "n_removed_lines")


def op2_factorisation_machine(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = factorisation.train(docs, table(spark, folder, "labels"))
    out = docs.withColumn("held_out", factorisation.held_out(F.col("doc_id")))
    return factorisation.score(out, model).select("doc_id", "held_out", "score", "predicted")


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_copies(table(spark, folder, "documents").select("doc_id", "text"))


def op4_anchor_expansion(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    base = F.filter("spans", lambda x: x.kind.isin(pii.BASE_KINDS))
    return pii.find_personal_data(docs).select(
        "doc_id",
        *[pii.count_of(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op5_license_sentences(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.array_join("sentence_ids", "|").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_licenses"),
    )


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.verdicts(pages).select("page_id", "host", "path", "rule", "verdict")


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.digests(docs, vocabulary_path()).select("doc_id", *bpe.DIGESTS)


def op8_weighted_sampling(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.compared_with_next(table(spark, folder, "documents").select("doc_id", "text"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(table(spark, folder, "documents").select("doc_id", "source", "text"))


def op10_distribution_divergence(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality_rules.judge(docs).select("doc_id", *measures, "base_failed", "kept", "class_distance", "word_distance")


def op11_count_cells(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents").select("lang", "source", "text"))


def op12_hat_trie(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents").select("lang", "text"))


def op13_rank_synchronous(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary_path()).select("doc_id", "n_bytes", "n_tokens", "over_limit")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_factorisation_machine": op2_factorisation_machine,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_anchor_expansion": op4_anchor_expansion,
    "op5_license_sentences": op5_license_sentences,
    "op6_url_filter": op6_url_filter,
    "op7_bpe": op7_bpe,
    "op8_weighted_sampling": op8_weighted_sampling,
    "op9_mixing": op9_mixing,
    "op10_distribution_divergence": op10_distribution_divergence,
    "op11_count_cells": op11_count_cells,
    "op12_hat_trie": op12_hat_trie,
    "op13_rank_synchronous": op13_rank_synchronous,
}

SQL: dict[str, str] = {
    "op3_ngram_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, [w FOR w IN regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+') IF w <> ''] AS ws
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS s
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * k >= 75 * (p.n + q.n - k)),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, r.c AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id
        """,
    "op5_license_sentences": r"""
        WITH RECURSIVE known(sentence, id) AS (VALUES
            ('licensed under the apache license version 2 0', 'apache2-notice'),
            ('licensed under the apache license version 2 0 the license', 'apache2-header'),
            ('you may not use this file except in compliance with the license', 'apache2-comply'),
            ('licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license', 'apache2-header'),
            ('apache license', 'apache-title'),
            ('version 2 0 january 2004', 'apache2-date'),
            ('released under the mit license', 'mit-notice'),
            ('licensed under the mit license', 'mit-notice'),
            ('this project is licensed under the mit license', 'mit-notice'),
            ('mit license', 'mit-title'),
            ('the mit license', 'mit-title'),
            ('the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software', 'mit-condition'),
            ('redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met', 'bsd-grant'),
            ('redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer', 'bsd-source'),
            ('redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution', 'bsd-binary'),
            ('this work is licensed under the gnu general public license version 3', 'gpl3-notice'),
            ('this work is licensed under the gnu general public license version 2', 'gpl2-notice'),
            ('gnu general public license', 'gpl-title'),
            ('version 3 29 june 2007', 'gpl3-date'),
            ('version 2 june 1991', 'gpl2-date'),
            ('this source code form is subject to the terms of the mozilla public license v 2 0', 'mpl2-notice'),
            ('licensed under cc by nc 4 0', 'cc-by-nc-4-notice'),
            ('licensed under cc by 4 0', 'cc-by-4-notice'),
            ('licensed under cc by sa 4 0', 'cc-by-sa-4-notice'),
            ('this work is licensed under a creative commons attribution 4 0 international license', 'cc-by-4-notice'),
            ('this work is licensed under a creative commons attribution noncommercial 4 0 international license', 'cc-by-nc-4-notice'),
            ('this work is licensed under a creative commons attribution sharealike 4 0 international license', 'cc-by-sa-4-notice'),
            ('this is free and unencumbered software released into the public domain', 'unlicense-notice'),
            ('all rights reserved', 'all-rights-reserved')),
        rules(rank, name, wanted) AS (VALUES
            (1, 'Apache-2.0', '|apache-title||apache2-date|'),
            (2, 'Apache-2.0', '|apache2-header||apache2-comply|'),
            (3, 'Apache-2.0', '|apache2-header|'),
            (4, 'Apache-2.0', '|apache2-notice|'),
            (5, 'MIT', '|mit-title||mit-condition|'),
            (6, 'MIT', '|mit-condition|'),
            (7, 'MIT', '|mit-notice|'),
            (8, 'MIT', '|mit-title|'),
            (9, 'BSD', '|all-rights-reserved||bsd-grant||bsd-source||bsd-binary|'),
            (10, 'BSD', '|bsd-grant||bsd-source||bsd-binary|'),
            (11, 'GPL-3.0', '|gpl-title||gpl3-date|'),
            (12, 'GPL-3.0', '|gpl3-notice|'),
            (13, 'GPL-2.0', '|gpl-title||gpl2-date|'),
            (14, 'GPL-2.0', '|gpl2-notice|'),
            (15, 'MPL-2.0', '|mpl2-notice|'),
            (16, 'CC-BY-NC-4.0', '|cc-by-nc-4-notice|'),
            (17, 'CC-BY-SA-4.0', '|cc-by-sa-4-notice|'),
            (18, 'CC-BY-4.0', '|cc-by-4-notice|'),
            (19, 'Unlicense', '|unlicense-notice|'),
            (20, 'all rights reserved', '|all-rights-reserved|')),
        views(view, ends) AS (VALUES
            (1, '[.!?;:]+[\x20\x09-\x0D]|[\x0A\x0D]'), (2, '[.!?;:]+[\x20\x09-\x0D]|[\x0A\x0D][\x20\x09]*[\x0A\x0D]')),
        marked AS (
            SELECT doc_id, view, regexp_replace(translate(coalesce(text, '') || chr(10), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(1),
                'abcdefghijklmnopqrstuvwxyz '), ends, chr(1), 'g') AS m
            FROM documents, views),
        pieces AS (
            SELECT doc_id, view, string_split(regexp_replace(m, '[^a-z0-9' || chr(1) || ']+', ' ', 'g'), chr(1)) AS p
            FROM marked),
        placed AS (SELECT doc_id, view, unnest(p) AS piece, unnest(range(len(p))) AS place FROM pieces),
        ids AS (
            SELECT doc_id, view, string_agg(id, '|' ORDER BY place) AS shown, string_agg(id, '||' ORDER BY place) AS seq
            FROM placed JOIN known ON trim(piece) = sentence GROUP BY doc_id, view),
        walk AS (
            SELECT doc_id, view, 0 AS rank, '|' || seq || '|' AS rest, NULL::VARCHAR AS found FROM ids
            UNION ALL
            SELECT doc_id, view, r.rank, replace(rest, wanted, '|'), CASE WHEN contains(rest, wanted) THEN name END
            FROM walk w JOIN rules r ON r.rank = w.rank + 1),
        found AS (
            SELECT doc_id, string_agg(found, ',' ORDER BY first) AS licenses, count(*) AS n
            FROM (SELECT DISTINCT doc_id, found, (SELECT min(rank) FROM rules WHERE name = found) AS first
                FROM walk WHERE found IS NOT NULL)
            GROUP BY doc_id)
        SELECT d.doc_id, coalesce(i.shown, '') AS sentence_ids, coalesce(f.licenses, '') AS licenses,
            coalesce(f.n, 0) AS n_licenses
        FROM documents d LEFT JOIN ids i ON i.doc_id = d.doc_id AND i.view = 1 LEFT JOIN found f ON f.doc_id = d.doc_id
        """,
    "op6_url_filter": r"""
        WITH rules(action, host, path) AS (VALUES
            ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
            ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        listed(host) AS (
            SELECT name || '.example.' || ending
            FROM (VALUES ('ads-track'), ('adult-x'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) n(name),
                (VALUES ('com'), ('net'), ('org')) e(ending)),
        split AS (
            SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        won AS (
            SELECT page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
                max_by(action, length(r.host || r.path)) AS action
            FROM split s JOIN rules r
                ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
            GROUP BY page_id)
        SELECT page_id, host, path, rule,
            coalesce(action, CASE WHEN EXISTS (
                SELECT 1 FROM listed l WHERE split.host = l.host OR ends_with(split.host, '.' || l.host)) THEN 'block' END,
                'allow') AS verdict
        FROM split LEFT JOIN won USING (page_id)
        """,
    "op11_count_cells": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
            FROM documents),
        used AS (SELECT id, lang, source, unnest(ws) AS term FROM docs),
        kept AS (
            SELECT lang, term, count(*)::HUGEINT AS c FROM used GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
        sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        counts AS (
            SELECT g.lang, g.source, k.term, k.c AS lang_c, coalesce(u.c, 0)::HUGEINT AS c
            FROM groups g JOIN kept k USING (lang)
            LEFT JOIN (SELECT lang, source, term, count(*) AS c FROM used GROUP BY ALL) u USING (lang, source, term)),
        totals AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM counts GROUP BY lang, source),
        shares AS (
            SELECT c.lang, c.source, c.term, c.c, 1 + (1000000000 * (c.c + 1)) // (t.n + s.v) AS p,
                1 + (1000000000 * (c.lang_c + 1)) // (s.n + s.v) AS q
            FROM counts c JOIN totals t USING (lang, source) JOIN sizes s USING (lang)),
        pairs AS (
            SELECT g.lang, g.source, h.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS value
            FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
            LEFT JOIN shares x ON x.lang = g.lang AND x.source = g.source
            LEFT JOIN shares y ON y.lang = h.lang AND y.source = h.source AND y.term = x.term
            GROUP BY ALL),
        terms AS (
            SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM shares WHERE c > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM terms))
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 200
        """,
    "op12_hat_trie": r"""
        WITH pieces AS (
            SELECT row_number() OVER () AS id, lang, piece
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents)),
        split AS (SELECT id, lang, [w FOR w IN regexp_split_to_array(piece, '[\x20\x09]+') IF w <> ''] AS ws FROM pieces),
        words AS (SELECT lang, unnest(ws) AS p FROM split),
        sizes AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
        grams AS (
            SELECT lang, 1 AS k, p FROM words
            UNION ALL SELECT lang, 2, unnest([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) FROM split
            UNION ALL
            SELECT lang, 3, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)])
            FROM split),
        counts AS (SELECT lang, k, p, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
        sides AS (
            SELECT lang, k, p, f, 1 AS cut, split_part(p, ' ', 1) AS x, substr(p, length(split_part(p, ' ', 1)) + 2) AS y
            FROM counts WHERE k > 1
            UNION ALL
            SELECT lang, k, p, f, 2, split_part(p, ' ', 1) || ' ' || split_part(p, ' ', 2), split_part(p, ' ', 3)
            FROM counts WHERE k = 3),
        cuts AS (
            SELECT s.lang, s.k, s.p, s.f AS a, cut, x.f AS l, y.f AS r, (1000000 * s.f * s.f) // (x.f * y.f) AS score
            FROM sides s JOIN counts x ON x.lang = s.lang AND x.p = s.x JOIN counts y ON y.lang = s.lang AND y.p = s.y),
        least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
        covered AS (
            SELECT lang, part, max(a) AS longer
            FROM (SELECT lang, split_part(p, ' ', 1) || ' ' || split_part(p, ' ', 2) AS part, a FROM least WHERE k = 3
                UNION ALL SELECT lang, split_part(p, ' ', 2) || ' ' || split_part(p, ' ', 3), a FROM least WHERE k = 3)
            GROUP BY ALL),
        kept AS (
            SELECT l.lang, l.p AS phrase, l.a, l.l, l.r, l.score
            FROM least l LEFT JOIN covered c ON c.lang = l.lang AND c.part = l.p
            WHERE c.longer IS NULL OR 100 * c.longer < 50 * l.a),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
            score::BIGINT AS score
        FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
        """,
}
