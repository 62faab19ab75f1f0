"""Queries over the synthetic text tables, one per operator, and their SQL."""

from __future__ import annotations

from marquee.llm._frames import table
from marquee.llm.decontamination import find_passages
from marquee.llm.exact_dedup import exact_dedup
from marquee.llm.jaccard_join import near_duplicates
from marquee.llm.kd_sharding import shard_report
from marquee.llm.license_scan import license_report
from marquee.llm.lm_scoring import lm_report
from marquee.llm.mixing import mix_report
from marquee.llm.spelling_variants import variant_report
from marquee.llm.substring_dedup import window_report
from marquee.llm.suffix_dedup import suffix_report
from marquee.llm.toxicity import toxicity_report
from marquee.llm.vector_codes import vector_code_report
from marquee.llm.warc import warc_report


def op1_lm_scoring(spark, sf_dir):
    return lm_report(table(spark, sf_dir, "documents"))


def op2_decontamination(spark, sf_dir):
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_warc_revisits(spark, sf_dir):
    return warc_report(table(spark, sf_dir, "pages"))


def op4_jaccard_join(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_suffix_dedup(spark, sf_dir):
    return suffix_report(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_substring_dedup(spark, sf_dir):
    return window_report(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("bucket")


def op9_mixing(spark, sf_dir):
    return mix_report(table(spark, sf_dir, "documents"))


def op10_kd_sharding(spark, sf_dir):
    return shard_report(table(spark, sf_dir, "documents"))


def op11_license_scan(spark, sf_dir):
    return license_report(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark, sf_dir):
    return vector_code_report(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark, sf_dir):
    return variant_report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_decontamination": op2_decontamination,
    "op3_warc_revisits": op3_warc_revisits,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_mixing": op9_mixing,
    "op10_kd_sharding": op10_kd_sharding,
    "op11_license_scan": op11_license_scan,
    "op12_vector_codes": op12_vector_codes,
    "op13_spelling_variants": op13_spelling_variants,
}


def _vector_codes_sql(rounds: int = 4) -> str:
    """The rounds one after the other, every part compared with every entry."""
    steps = [r"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS x FROM kept, range(4) t(p)
), c0 AS MATERIALIZED (
  SELECT * FROM (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts) WHERE e < 256
)"""]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, label, p, any_value(x) AS x, min(d * 256 + e) % 256 AS e, min(d * 256 + e) // 256 AS d
  FROM (SELECT vec_id, label, a.p, x, e,
               list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM parts a JOIN c{k} USING (p))
  GROUP BY vec_id, label, p
)""")
        if k < rounds:
            steps.append(f"""m{k} AS (
  SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c
  FROM (SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM a{k})
        GROUP BY p, e, i) GROUP BY p, e
), c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN m{k} m ON m.p = c.p AND m.e = c.e)""")
    return "WITH " + ",\n".join(steps) + f"""
, coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
FROM coded"""


ORACLE_SQL = {
    "op12_vector_codes": _vector_codes_sql(),
    # the templates as patterns over the words, joined and framed by spaces
    "op11_license_scan": r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents
), placed AS (
  SELECT doc_id, words, ' ' || array_to_string(words, ' ') || ' ' AS t,
    list_filter(range(0, len(words) - 1), lambda i: words[i+1] = 'mit' AND words[i+2] = 'license') AS mit,
    list_filter(range(0, len(words) - 1), lambda i: words[i+1] = 'apache' AND words[i+2] = 'license') AS apache,
    list_filter(range(0, len(words) - 2), lambda i: words[i+1] = 'general' AND words[i+2] = 'public' AND words[i+3] = 'license') AS gpl
  FROM w
), f AS (
  SELECT doc_id, len(words) AS n, list_concat(mit, apache, gpl) AS places,
    list_filter([CASE WHEN len(mit) > 0 THEN 'mit' END, CASE WHEN len(apache) > 0 THEN 'apache' END,
                 CASE WHEN len(gpl) > 0 THEN 'gpl' END], lambda x: x IS NOT NULL) AS base,
    list_filter([
      CASE WHEN regexp_matches(t, ' (released|licensed|distributed|available|provided) under the (terms of the )?mit license ') THEN 'mit-notice' END,
      CASE WHEN regexp_matches(t, ' permission is hereby granted free of charge to any person obtaining a copy of this ([^ ]+ ){1,3}and associated documentation ') THEN 'mit-text' END,
      CASE WHEN regexp_matches(t, ' licensed under the apache license (version )?2 0 ') THEN 'apache-2.0' END,
      CASE WHEN regexp_matches(t, ' licensed under the apache license version 2 0 the license you may not use this ([^ ]+ ){1,3}except in compliance with the license ') THEN 'apache-2.0-header' END,
      CASE WHEN regexp_matches(t, ' licensed under the (terms of the )?(gnu )?general public license (version )?3 ') THEN 'gpl-3.0' END,
      CASE WHEN regexp_matches(t, ' general public license as published by the ([^ ]+ ){1,4}either version ([0-9]+ ){1,2}of the license or at your option any later version ') THEN 'gpl-or-later' END,
      CASE WHEN regexp_matches(t, ' licensed under (creative commons )?cc by nc 4 0 ') THEN 'cc-by-nc-4.0' END,
      CASE WHEN regexp_matches(t, ' copyright (c )?([0-9]{4} ){1,2}([^ ]+ ){1,6}all rights reserved ') THEN 'all-rights-reserved' END
    ], lambda x: x IS NOT NULL) AS found
  FROM placed
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) AS BIGINT) AS first_word,
       CAST(list_max(places) AS BIGINT) AS last_word, array_to_string(list_sort(base), ',') AS base_labels,
       array_to_string(list_sort(list_concat(base, found)), ',') AS labels,
       CAST(CASE WHEN len(found) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS score
FROM f""",
    # crc32 a byte of every run at a time; words one edit apart meet in a spelling with a character left out
    "op13_spelling_variants": r"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) t(b)
), runs AS MATERIALIZED (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k, any_value(run) AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL
), crc(k, h, pos, c) AS (
  SELECT k, hex(encode(k)), 0, CAST(4294967295 AS BIGINT) FROM runs
  UNION ALL
  SELECT k, h, pos + 1, xor(c >> 8, v)
  FROM crc JOIN crc_table ON b = xor(c & 255, CAST('0x' || substr(h, 2 * pos + 1, 2) AS BIGINT))
  WHERE 2 * pos < length(h)
), words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM runs JOIN (SELECT k, xor(c, 4294967295) AS h FROM crc WHERE 2 * pos = length(crc.h)) USING (k))
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), shorter AS (
  SELECT DISTINCT cut.word AS long, cut.n AS long_n, words.word AS short, words.n AS short_n FROM cut JOIN words ON rest = words.word
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT long, short, short_n FROM shorter
  UNION ALL SELECT short, long, long_n FROM shorter
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM near GROUP BY word
), formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
         CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), follow(word, root, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT follow.word, formed.word, formed.form FROM follow JOIN formed ON follow.form = formed.word
)
SELECT word, formed.form, root, n, n_near, form_n FROM formed JOIN follow USING (word) WHERE follow.form IS NULL""",
    "op4_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [words]
    ELSE list_transform(range(1, len(words) - 3), lambda i: words[i:i+4]) END)) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
keyed AS (SELECT doc_id, n, array_to_string(shingle, chr(1)) AS k FROM s JOIN n USING (doc_id)),
linked AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM keyed a JOIN keyed b ON a.k = b.k AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id""",
    "op5_suffix_dedup": r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM documents
), chunks AS (
  -- a text in pieces of 1024 starts, so that a start is cut from a short string
  SELECT doc_id, c * 1024 AS base, substr(hex(b), 2048 * c + 1, 2248) AS h, least(1024, n - 99 - 1024 * c) AS m
  FROM (SELECT *, unnest(range(0, (n - 100) // 1024 + 1)) AS c FROM d WHERE n >= 100)
), win AS (
  SELECT doc_id, base + j AS i, md5_number(substr(h, 2 * j + 1, 200)) AS k
  FROM (SELECT doc_id, base, h, unnest(range(0, m)) AS j FROM chunks)
), hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1
), marked AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS fresh FROM hit
), spans AS (
  SELECT doc_id, min(i) AS s, max(i) + 100 AS e
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run
), ends AS (
  SELECT doc_id, s, e FROM spans UNION ALL SELECT doc_id, n, n FROM d
), pieces AS (
  SELECT doc_id, s, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s, e), 0) AS a, e FROM ends
), kept AS (
  SELECT doc_id, n, sum(e - s) AS removed, count(*) - 1 AS spans, string_agg(substr(hex(b), 2 * a + 1, 2 * (s - a)), '' ORDER BY s, e) AS h
  FROM pieces JOIN d USING (doc_id) GROUP BY doc_id, n
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(removed AS BIGINT) AS n_removed, CAST(spans AS BIGINT) AS n_spans,
       sha256(unhex(h)) AS kept_sha256
FROM kept""",
    "op8_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50),
win AS (SELECT doc_id, i, array_to_string(words[i:i+49], ' ') AS k FROM starts),
hit AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM win) WHERE first < doc_id
), gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + 50)) AS j FROM hit) GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, words, CASE WHEN js IS NULL THEN words
    ELSE list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda p: NOT list_contains(js, p[2])), lambda p: p[1]) END AS k
  FROM w LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - len(k) AS BIGINT) AS n_removed,
       sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept""",
    "op3_warc_revisits": """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n,
         sha1(coalesce(html, '')) AS digest
  FROM pages
), m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS original FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> original THEN original END AS refers_to, url
FROM m""",
    "op7_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r""",
}
