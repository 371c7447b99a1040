"""Registered queries of the corpus operators, with their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicerank.llm import html_extract, lm, quality
from servicerank.llm.bpe import encode_decode
from servicerank.llm.decontaminate import report
from servicerank.llm.exact_dedup import exact_groups
from servicerank.llm.filter_audit import audit
from servicerank.llm.mixing import mix
from servicerank.llm.ngram_join import ShingleJoin
from servicerank.llm.periodic_runs import periodic_runs
from servicerank.llm.shipping import ship
from servicerank.llm.substring_dedup import remove_repeated_words
from servicerank.llm.suffix_dedup import remove_repeats
from servicerank.llm.token_counts import EDITS, count_tokens


def tokenizer_path() -> str:
    """The public vocabulary that the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ShingleJoin(table(spark, sf_dir, "documents")).groups()


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), texts=False)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256")
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(), outputs)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_passages",
    )


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(table(spark, sf_dir, "documents"), texts=False)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text before and after three edits: words put into upper case, a cut, an appended line."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    third, size = F.floor(F.length(text) / 3), F.length(text)
    edits = F.array(
        F.struct(third.alias("start"), (third + 40).alias("stop"), F.upper(text.substr(third + 1, F.lit(40))).alias("replacement")),
        F.struct((2 * third).alias("start"), (2 * third + 25).alias("stop"), F.lit("").alias("replacement")),
        F.struct(size.cast("bigint").alias("start"), size.cast("bigint").alias("stop"), F.lit("\nRead more.").alias("replacement")),
    ).cast(EDITS)
    counted = count_tokens(docs, tokenizer_path(), edits)
    return counted.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


def op11_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled good weigh 2, bad ones a half, those without label 1."""
    labels = table(spark, sf_dir, "labels")
    weight = F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5)
    weights = labels.select("doc_id", weight.alias("weight"))
    return mix(table(spark, sf_dir, "documents"), weights).drop("source")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Id and text; in a tenth of the texts the words from one on repeat themselves."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cut = docs.select("doc_id", "text", hashed.alias("_h"), F.when(hashed % 10 == 0, words).alias("_words"))
    g = F.floor(F.col("_h") / 10)
    sized = cut.withColumn("_n", F.size("_words")).withColumn("_a", (g % F.greatest("_n", F.lit(1))).cast("int"))
    sized = sized.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8))).cast("int"))
    rest = F.col("_n") - F.col("_a")
    period = F.array_repeat(F.slice("_words", F.col("_a") + 1, F.col("_p")), F.ceil(rest / F.col("_p")).cast("int"))
    planted = F.concat(F.slice("_words", F.lit(1), F.col("_a")), F.slice(F.flatten(period), F.lit(1), rest))
    text = F.when(F.col("_n") > 0, F.concat_ws(" ", planted)).otherwise(F.col("text"))
    return sized.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    order = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))
    best = F.array_min(order)
    start, length, period = best["start"], -best["col1"], best["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_html_extract": op4_html_extract,
    "op5_bpe": op5_bpe,
    "op6_quality": op6_quality,
    "op7_lm_score": op7_lm_score,
    "op8_decontaminate": op8_decontaminate,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_mix_sources": op11_mix_sources,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op1_ngram_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                           ELSE list_sort(list_distinct([array_to_string(w[p:p + 4], ' ') FOR p IN range(1, len(w) - 3)])) END AS s
            FROM words
        ), classes AS (
            SELECT doc_id, len(s) AS n, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY s) END AS class_id,
                   CASE WHEN len(s) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY s) END AS n_class, s
            FROM sets
        ), shingles AS (
            SELECT class_id, n, n_class, unnest(s) AS x FROM classes WHERE doc_id = class_id
        ), links AS (
            SELECT a.class_id AS a, b.class_id AS b, any_value(b.n_class) AS weight
            FROM shingles a JOIN shingles b ON a.x = b.x AND a.class_id != b.class_id
            GROUP BY a.class_id, b.class_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT a AS node, a AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
        ), components AS (
            SELECT node, min(other) AS component FROM reach GROUP BY node
        ), near AS (
            SELECT a AS node, sum(weight) AS n_near FROM links GROUP BY a
        )
        SELECT doc_id, n::BIGINT AS n_shingles, coalesce(component, class_id) AS component_id, class_id,
               n_class::BIGINT AS n_class, (n_class - 1 + coalesce(n_near, 0))::BIGINT AS n_links
        FROM classes LEFT JOIN components c ON c.node = class_id LEFT JOIN near m ON m.node = class_id""",
    "op2_suffix_dedup": r"""
        WITH bytes AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), starts AS (
            SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS s
            FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 99)) AS p FROM bytes)
        ), again AS (
            SELECT doc_id, p FROM starts QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1
        ), places AS (
            SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte
            FROM (SELECT doc_id, h, unnest(range(len(h) // 2)) AS i FROM bytes)
        ), marked AS (
            SELECT b.doc_id, b.i, b.byte,
                   coalesce(max(a.p) OVER (PARTITION BY b.doc_id ORDER BY b.i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), -1) >= 0 AS gone
            FROM places b LEFT JOIN again a ON a.doc_id = b.doc_id AND a.p = b.i
        ), edged AS (
            SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS first FROM marked
        ), kept AS (
            SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (first) AS n_spans,
                   coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), '') AS h
            FROM edged GROUP BY doc_id
        )
        SELECT b.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(k.h, ''))) AS kept_sha256
        FROM bytes b LEFT JOIN kept k USING (doc_id)""",
    "op3_exact_dedup": r"""
        WITH squeezed AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY content ORDER BY n DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY content) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY content ORDER BY n DESC, doc_id) AS kept,
               sha256(content) AS text_sha256
        FROM squeezed""",
    "op8_decontaminate": r"""
        WITH cut AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents
            UNION ALL SELECT 'i', item_id, text FROM benchmark
        ), words AS (
            SELECT kind, id, list_filter(
                regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM cut
        ), counted AS (
            SELECT kind, id, w, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 4, 1) END AS n FROM words
        ), shingles AS (
            SELECT kind, id, n, p, array_to_string(w[p + 1:p + 5], ' ') AS s
            FROM (SELECT *, unnest(range(n)) AS p FROM counted)
        ), items AS (
            SELECT id AS item_id, n AS m, s, count(*) AS in_item FROM shingles JOIN counted USING (kind, id, n)
            WHERE kind = 'i' AND len(w) >= 5 GROUP BY ALL
        ), hits AS (
            SELECT d.id AS doc_id, d.n, d.p, i.item_id, i.m
            FROM shingles d JOIN items i USING (s) WHERE d.kind = 'd'
        ), starts AS (
            SELECT DISTINCT doc_id, n, item_id, m,
                   unnest(range(greatest(p - m + 1, 0), least(p, greatest(n - m, 0)) + 1)) AS start
            FROM hits
        ), held AS (
            SELECT t.doc_id, t.item_id, t.m, t.start, d.s, count(*) AS in_window
            FROM starts t JOIN shingles d ON d.kind = 'd' AND d.id = t.doc_id AND d.p BETWEEN t.start AND t.start + t.m - 1
            GROUP BY ALL
        ), compared AS (
            SELECT h.doc_id, h.item_id, h.m, h.start, sum(h.in_window) AS n,
                   sum(least(h.in_window, coalesce(i.in_item, 0))) AS shared
            FROM held h LEFT JOIN items i ON i.item_id = h.item_id AND i.s = h.s GROUP BY ALL
        ), runs AS (
            SELECT id, k, array_to_string(w[p + 1:p + k], ' ') AS s
            FROM (SELECT id, w, k, unnest(range(len(w) - k + 1)) AS p
                  FROM words, (SELECT DISTINCT len(w) AS k FROM words WHERE kind = 'i' AND len(w) BETWEEN 1 AND 4)
                  WHERE kind = 'd')
        ), found AS (
            SELECT doc_id, item_id, max(shared / (n + m - shared)) AS similarity
            FROM compared WHERE 100 * shared >= 80 * (n + m - shared) GROUP BY ALL
            UNION
            SELECT r.id, i.id, 1.0::DOUBLE
            FROM runs r JOIN words i ON i.kind = 'i' AND len(i.w) = r.k AND array_to_string(i.w, ' ') = r.s
        )
        SELECT doc_id, count(item_id) > 0 AS contaminated, count(item_id) AS n_items,
               coalesce(string_agg(item_id, ',' ORDER BY item_id), '') AS item_ids,
               coalesce(max(similarity), 0.0) AS similarity
        FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id""",
    "op9_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), windows AS (
            SELECT doc_id, p, md5(array_to_string(w[p + 1:p + 50], ' ')) AS s
            FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS p FROM words)
        ), again AS (
            SELECT doc_id, p FROM windows QUALIFY min(doc_id) OVER (PARTITION BY s) < doc_id
        ), places AS (
            SELECT doc_id, i, w[i + 1] AS word FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM words)
        ), marked AS (
            SELECT b.doc_id, b.i, b.word,
                   coalesce(max(a.p) OVER (PARTITION BY b.doc_id ORDER BY b.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), -1) >= 0 AS gone
            FROM places b LEFT JOIN again a ON a.doc_id = b.doc_id AND a.p = b.i
        ), kept AS (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed,
                   coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS text
            FROM marked GROUP BY doc_id
        )
        SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
        FROM words w LEFT JOIN kept k USING (doc_id)""",
    "op11_mix_sources": r"""
        WITH weights AS (
            SELECT doc_id AS known, max(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 END)::DOUBLE AS w
            FROM labels GROUP BY ALL
        ), sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   ('0x' || md5('11:' || coalesce(doc_id::VARCHAR, 'null'))[1:13])::BIGINT AS drawn
            FROM documents
        ), keyed AS (
            SELECT s.*, -ln((drawn + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / coalesce(w, 1) AS k
            FROM sized s LEFT JOIN weights ON known = doc_id
        ), held AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                       WHEN 0 THEN 5::DOUBLE WHEN 1 THEN 2::DOUBLE ELSE 1::DOUBLE END AS share
            FROM keyed GROUP BY source
        ), levels AS (
            SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                       - 2 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(share) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM held WINDOW o AS (ORDER BY source_size / share, source NULLS LAST)
        ), aims AS (
            SELECT source, source_size, least((2 * source_size)::DOUBLE, share * max(level) OVER ()) AS target FROM levels
        ), planned AS (
            SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs FROM aims
        ), reached AS (
            SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS budget,
                   sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.doc_id, k.size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS so_far
            FROM keyed k JOIN planned p ON k.source IS NOT DISTINCT FROM p.source
        ), copied AS (
            SELECT *, CASE WHEN size = 0 THEN 0 ELSE epochs + CASE
                       WHEN so_far <= budget THEN 1
                       WHEN so_far - size < budget AND so_far - budget < budget - (so_far - size) THEN 1 ELSE 0 END
                   END AS copies
            FROM reached
        )
        SELECT doc_id, size, source_size, target, copies::BIGINT AS copies, (copies * size)::BIGINT AS taken FROM copied""",
    "op12_filter_audit": r"""
        WITH cut AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
            FROM documents
        ), flags AS (
            SELECT doc_id AS known, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY ALL
        ), masks AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
                   + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text))::INT
                   + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask
            FROM cut LEFT JOIN flags ON known = doc_id
        ), kinds AS (
            SELECT part, good, toxic, mask, count(*) AS n FROM masks GROUP BY ALL
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
        ), orders AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
        ), steps AS (
            SELECT filter_order, s::INT AS step, instr('ABCDE', filter_order[s]) - 1 AS letter,
                   list_sum([1 << (instr('ABCDE', x) - 1) FOR x IN string_split(filter_order[:s - 1], '') IF x <> '']) AS earlier
            FROM orders, range(1, 6) r(s)
        ), told AS (
            SELECT *, (mask >> letter) & 1 = 1 AS fails, (mask & coalesce(earlier, 0)::INT) <> 0 AS gone FROM kinds, steps
        ), counted AS (
            SELECT part, filter_order, step, letter,
                   coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (mask = 1 << letter), 0)::BIGINT AS unique_fails,
                   coalesce(sum(n) FILTER (fails AND NOT gone AND good), 0)::BIGINT AS good_lost,
                   coalesce(sum(n) FILTER (fails AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
            FROM told GROUP BY ALL
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
        FROM counted""",
}
