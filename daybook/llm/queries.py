"""Queries of the operators for text corpora, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query(
    "op10_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW g AS (PARTITION BY t)
    """,
)
def op10_exact_dedup(spark, folder):
    from daybook.llm.exact_dedup import duplicates

    return duplicates(table(spark, folder, "documents"))


@query(
    "op9_decontaminate",
    r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    tests AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + 9] AS words
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    places AS (
      SELECT doc_id, n, i, w[i:i + n - 1] AS words
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM tests) WHERE len(w) >= n)),
    hits AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN tests t ON p.n = t.n AND p.words = t.words),
    items AS (
      SELECT doc_id, count(DISTINCT item_id) AS n_items,
             sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS items_sha256
      FROM hits GROUP BY doc_id),
    covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN items USING (doc_id) LEFT JOIN covered USING (doc_id)
    """,
)
def op9_decontaminate(spark, folder):
    from daybook.llm.decontaminate import contamination

    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    from daybook.llm.packing import pack

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_length"
    )


@query("op8_packing")
def op8_packing(spark, folder):
    return packed(table(spark, folder, "documents"))


@query("op7_set_join")
def op7_set_join(spark, folder):
    from daybook.llm.set_join import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


@query("op3_toxicity")
def op3_toxicity(spark, folder):
    from daybook.llm.toxicity import toxicity

    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    "op1_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
    d AS (SELECT page_id, t, max(page_id) OVER (PARTITION BY t) AS keep, sha1(t) AS s FROM p)
    SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
           list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             CAST((CAST('0x' || substr(s, (i // 4) * 5 + 1, 5) AS INTEGER) >> CAST((3 - i % 4) * 5 AS INTEGER)) & 31 AS INTEGER) + 1, 1)
             FOR i IN range(32)], 'string_agg', '') AS payload_digest,
           CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> keep THEN keep END AS refers_to
    FROM d
    """,
)
def op1_warc(spark, folder):
    from daybook.llm import warc
    from daybook.session import fresh_path

    store_path, files = fresh_path(spark, "warc-store"), fresh_path(spark, "warc-files")
    warc.archive(table(spark, folder, "pages"), store_path)
    warc.export(warc.records(spark, store_path), files)
    found = warc.read(spark, files, with_content=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_repeated_text")
def op5_repeated_text(spark, folder):
    from daybook.llm.repeated_text import remove_repeated

    found = remove_repeated(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_personal_data")
def op6_personal_data(spark, folder):
    from daybook.llm.personal_data import report

    return report(table(spark, folder, "documents"))


@query("op4_html_text")
def op4_html_text(spark, folder):
    from daybook.llm.html_text import extract

    return extract(table(spark, folder, "pages"))


@query("op2_line_templates")
def op2_line_templates(spark, folder):
    from daybook.llm.line_templates import drop_recurring_lines

    return drop_recurring_lines(table(spark, folder, "documents"))


@query(
    "op11_filter_audit",
    r"""
    WITH l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
               FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
    d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    f AS (
      SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
             || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
      FROM d LEFT JOIN l USING (doc_id)),
    c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
    x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    s AS (SELECT c.*, filter_order, step, substr(filter_order, step, 1) AS letter,
                 contains(fails, substr(filter_order, step, 1)) AS failing,
                 translate(substr(filter_order, 1, step - 1), fails, '') = substr(filter_order, 1, step - 1) AS there
          FROM c, o, (SELECT unnest(range(1, 6)) AS step)),
    r AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
                 coalesce(sum(n) FILTER (there AND NOT failing), 0) AS kept, coalesce(sum(n) FILTER (there AND failing), 0) AS removed,
                 coalesce(sum(n) FILTER (NOT there AND failing), 0) AS redundant, coalesce(sum(n) FILTER (fails = letter), 0) AS unique_fails,
                 coalesce(sum(good) FILTER (there AND failing), 0) AS good_lost, coalesce(sum(toxic) FILTER (there AND failing), 0) AS toxic_lost
          FROM s GROUP BY ALL)
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
           CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
    FROM r
    """,
)
def op11_filter_audit(spark, folder):
    from daybook.llm.filter_audit import audit

    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    "op12_divergence_audit",
    r"""
    WITH d AS (
      SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    k AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 30),
    c AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) JOIN k USING (lang, term) GROUP BY ALL),
    v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
    g AS (
      SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
    p AS (
      SELECT lang, source, term, coalesce(n, 0) AS n,
             1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 5) // CAST(total + 5 * v AS HUGEINT) AS p
      FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
    q AS (
      SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 5) // CAST(total + 5 * v AS HUGEINT) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) JOIN v USING (lang)
      JOIN (SELECT lang, sum(n) AS total FROM c GROUP BY lang) USING (lang)),
    pairs AS (
      SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                 GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    terms AS (
      SELECT lang, source, term AS item, p - q AS value, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS rank
      FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
    SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, CAST(value AS BIGINT), CAST(rank AS INTEGER) FROM terms WHERE rank <= 50
    """,
)
def op12_divergence_audit(spark, folder):
    from daybook.llm.divergence import audit

    return audit(table(spark, folder, "documents"))


@query("op13_suffix_tree")
def op13_suffix_tree(spark, folder):
    from daybook.llm.suffix_tree import score

    return score(table(spark, folder, "documents"))
