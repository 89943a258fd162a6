"""The registered queries of the operators, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import alignment, bpe, collocations, decontamination, maxent, mixing, perplexity
from ratewise.llm import repeats, rollups, simhash, templates, toxicity, warc
from ratewise.llm.shipping import send_package
from ratewise.llm.text import id_remainder, words
from ratewise.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hex64(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


#: Shares of tokens that the mixture aims at. Where a table can't give them at the fraction
#: that is asked for, the operator goes towards them as far as it can, and says so.
MIXTURE = mixing.Targets(
    source={"src0": 0.25, "other": 0.75},
    lang={"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    topic={"prose": 0.8, "list": 0.1, "note": 0.05, "markup": 0.05},
)


def training_labels(labels: DataFrame) -> DataFrame:
    """Labelled rows that may be learnt from."""
    return labels.filter(id_remainder(F.col("doc_id"), 5) != 0)


def op1_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of each document by a model of those that aren't held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return maxent.score(docs, id_remainder(F.col("doc_id"), 7) == 2)


def op2_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell, probability and draw of each document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mix(docs, MIXTURE, fraction=0.5).select(
        "doc_id",
        F.col("_source").alias("source_cell"),
        F.col("_lang").alias("lang_cell"),
        F.col("_topic").alias("topic_cell"),
        F.col("_tokens").alias("n_tokens"),
        F.col("_probability").alias("probability"),
        F.col("_weight").alias("weight"),
        F.col("_sampled").alias("sampled"),
    )


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and recurring lines of each document, and a digest of what stays."""
    docs = _table(spark, sf_dir, "documents")
    kept = templates.drop_recurring(docs, with_counts=True)
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words of each document and the items they come from."""
    found = decontamination.contamination(
        _table(spark, sf_dir, "documents").select("doc_id", "text"),
        _table(spark, sf_dir, "benchmark"),
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and perplexity band of each document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return perplexity.assess(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "log_perplexity",
    )


def op6_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back from them."""
    folder = scratch_path(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return warc.pages_of(warc.read_archives(spark, folder))


def op7_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after a feed of changes: all documents come, under two versions of the
    tokenizer; some are counted anew without bare marks, some go; one batch comes twice."""
    docs = _table(spark, sf_dir, "documents")
    text = words(F.col("text"))
    counted = docs.select(
        "doc_id",
        "source",
        "lang",
        F.size(text).cast("bigint").alias("whole"),
        F.size(decontamination.item_words(F.col("text"))).cast("bigint").alias("bare"),
    )
    path = scratch_path(spark, "counted-documents")
    counted.write.parquet(path)
    counted = spark.read.parquet(path)

    def changes(op: str, tokenizer: str, count: str) -> DataFrame:
        return counted.select(
            F.lit(op).alias("op"), F.lit(0).cast("bigint").alias("seq"), "doc_id", "source",
            "lang", F.lit(tokenizer).alias("tokenizer"), F.col(count).alias("n_tokens"),
        )

    store = rollups.RollupStore(spark, scratch_path(spark, "rollups"))
    part = F.pmod(F.col("doc_id"), F.lit(10))
    revised = changes("revise", "words@1", "bare").filter(part == 3)
    store.commit(1, changes("insert", "words@1", "whole"))
    store.commit(2, changes("insert", "words@2", "bare"))
    store.commit(3, revised)
    store.commit(3, revised)
    store.commit(4, changes("delete", "words@1", "whole").filter(part == 4))
    return store.totals()


def op8_counterfactual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document by a model that saw no held-out label."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity.train(docs, training_labels(_table(spark, sf_dir, "labels")))
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return toxicity.score(docs, weights).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op9_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of each document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, words=3, max_bits=2).select(
        "doc_id", _hex64(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op10_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that an earlier one has in a passage of 50 words."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def _tokenizer(name: str) -> str:
    """Where the installed file of a public tokenizer is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of each document under two tokenizers."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint"), "text")
    first = alignment.read_tokenizer(_tokenizer("byte_bpe_50k.json"))
    second = alignment.read_tokenizer(_tokenizer("piece_bpe_32k.model"))
    groups = F.col("_groups")
    # The groups themselves aren't needed any further, nor are the texts.
    digest = F.when(groups != "", F.sha2(groups, 256)).otherwise("").alias("groups_sha256")
    aligned = alignment.align(docs, first, second).select("*", digest).drop("text", "_groups")
    counted = alignment.link_counts(aligned)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return counted.select("doc_id", *(F.col(f"_{c}").alias(c) for c in names), "groups_sha256")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of two and three words of each language."""
    docs = _table(spark, sf_dir, "documents").select("text", "lang")
    return collocations.collocations(docs).select(
        F.col("label").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score"
    )


def op13_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text that they decode to."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = bpe.read_vocabulary(_tokenizer("byte_bpe_50k.json"))
    encoded = bpe.encode(docs, vocabulary).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "ids",
    )
    return bpe.decode(encoded, vocabulary).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256")
    )


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hashed_maxent": op1_hashed_maxent,
    "op2_raking": op2_raking,
    "op3_line_templates": op3_line_templates,
    "op4_winnowing": op4_winnowing,
    "op5_kneser_ney": op5_kneser_ney,
    "op6_salvage": op6_salvage,
    "op7_rollups": op7_rollups,
    "op8_counterfactual": op8_counterfactual,
    "op9_golay_simhash": op9_golay_simhash,
    "op10_seed_extend": op10_seed_extend,
    "op11_token_alignment": op11_token_alignment,
    "op12_collocations": op12_collocations,
    "op13_rank_bpe": op13_rank_bpe,
}

_UPPER_TO_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Line templates of leaves of three leading tokens and one vote in each. The operator's rounds
#: have no SQL; this is what tests hold that variant against.
ONE_VOTE_SQL = r"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), listed AS (
  SELECT doc_id, text, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no FROM split
), lines AS (
  SELECT doc_id, text, line_no, line,
    list_transform(
      list_filter(string_split_regex(line, '[ \t\n\x0B\f\r]+'), lambda t: t <> ''),
      lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS tokens
  FROM listed
), long AS (
  SELECT *, row(len(tokens), tokens[1], tokens[2], tokens[3]) AS leaf FROM lines WHERE len(tokens) >= 3
), kinds AS (
  SELECT leaf, tokens, count(DISTINCT row(doc_id, text)) AS n_docs FROM long GROUP BY ALL
), mixed AS (
  SELECT leaf FROM kinds GROUP BY leaf HAVING count(*) > 1 AND sum(n_docs) >= 5
), members AS (
  SELECT k.* FROM kinds k JOIN mixed USING (leaf)
), placed AS (
  SELECT leaf, n_docs, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place FROM members
), votes AS (
  SELECT leaf, place, token, sum(n_docs) AS n FROM placed WHERE place > 3 GROUP BY ALL
), constants AS (
  SELECT leaf, place, token FROM (
    SELECT *, sum(n) OVER (PARTITION BY leaf, place) AS total FROM votes) WHERE n * 2 > total
), agreement AS (
  SELECT p.leaf, p.tokens, count(c.token) AS same FROM (
    SELECT leaf, tokens, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place
    FROM members) p
  LEFT JOIN constants c ON c.leaf = p.leaf AND c.place = p.place AND c.token = p.token
  GROUP BY ALL
), following AS (
  SELECT leaf, tokens FROM agreement WHERE len(tokens) > 3 AND same >= 0.5 * (len(tokens) - 3)
), named AS (
  SELECT l.doc_id, l.text, l.line_no,
    row(l.leaf, CASE WHEN f.leaf IS NULL THEN l.tokens END) AS template
  FROM long l LEFT JOIN following f ON f.leaf = l.leaf AND f.tokens = l.tokens
), recurring AS (
  SELECT template, min(row(doc_id, line_no)) AS first FROM named
  GROUP BY template HAVING count(DISTINCT row(doc_id, text)) >= 5
), drops AS (
  SELECT DISTINCT doc_id, text, line_no FROM named JOIN recurring USING (template)
  WHERE row(doc_id, line_no) <> first
)
SELECT l.doc_id, count(*) AS n_lines, count(d.line_no) AS n_dropped,
  sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no)
    FILTER (WHERE d.line_no IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN drops d ON d.doc_id = l.doc_id AND d.line_no = l.line_no
GROUP BY l.doc_id
"""

LLM_ORACLES: dict[str, str] = {
    "op6_salvage": """
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages
), s AS (
  SELECT page_id, octet_length(payload) AS size, sha256(payload) AS digest FROM p
), f AS (
  SELECT digest, min(page_id) AS first FROM s WHERE size >= 100 GROUP BY digest
)
SELECT s.page_id, size AS payload_bytes, s.digest AS payload_digest,
  CASE WHEN first IS NULL OR first = s.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> s.page_id THEN first END AS refers_to
FROM s LEFT JOIN f ON f.digest = s.digest AND size >= 100
""",
    "op7_rollups": rf"""
WITH d AS (
  SELECT doc_id, source, lang,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS whole,
    len(regexp_extract_all(translate(coalesce(text, ''), {_UPPER_TO_LOWER}),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS bare
  FROM documents
), t AS (
  SELECT source, lang, 'words@1' AS tokenizer,
    CASE WHEN doc_id % 10 = 3 THEN bare ELSE whole END AS n
  FROM d WHERE doc_id % 10 <> 4
  UNION ALL SELECT source, lang, 'words@2', bare FROM d
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM t GROUP BY ALL
""",
    "op4_winnowing": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER_TO_LOWER}),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER_TO_LOWER}),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), known AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
    array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS words
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS s FROM b WHERE len(w) > 0)
), windows AS (
  SELECT doc_id, s, size, array_to_string(w[s : s + size - 1], ' ') AS words FROM (
    SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s
    FROM d, (SELECT DISTINCT size FROM known))
), hits AS (
  SELECT doc_id, s, size, item_id FROM windows JOIN known USING (size, words)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(generate_series(s, s + size - 1)) AS p FROM hits) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op12_collocations": rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), {_UPPER_TO_LOWER}) AS text FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang
), f AS (
  SELECT lang, size, array_to_string(w[s : s + size - 1], ' ') AS phrase, count(*) AS f FROM (
    SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s
    FROM p, (VALUES (1), (2), (3)) AS v(size) WHERE len(w) >= size)
  GROUP BY ALL
), c AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT *, unnest(generate_series(1, size - 1)) AS k FROM c
), scores AS (
  SELECT cuts.lang, cuts.phrase, cuts.size, a, k, l.f AS l, r.f AS r,
    CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts
  JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(w[1 : k], ' ')
  JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(w[k + 1 : cuts.size], ' ')
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, a, array_to_string(w[i : i + 1], ' ') AS phrase FROM (
    SELECT *, unnest([1, 2]) AS i FROM c WHERE size = 3)
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts x WHERE x.lang = b.lang AND x.phrase = b.phrase
      AND 100 * x.a >= 50 * b.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000
""",
}
