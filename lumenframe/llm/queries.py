"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact, jaccard, langid, licenses, mixing, packing, pages, quality, secrets, urlrules

URL_RULES = ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = mixing.mix(docs, mixing.cycled_targets, F.array("source"))
    return rows.select(F.col("id").alias("doc_id"), "size", F.col("source_sizes")[0].alias("source_size"), F.col("targets")[0].alias("target"), "taken")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = secrets.BASE_RULES + secrets.MORE_RULES
    base = [k for k, r in enumerate(rules) if r.base]
    rows = secrets.scan(_table(spark, sf_dir, "documents"), rules)
    counts = [F.size(F.filter("spans", _of_rule(k))).cast("long").alias(f"n_{rules[k].kind}") for k in base]
    own = F.filter("spans", lambda s: s["rule"].isin(base))
    return rows.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(secrets.joined_spans(own, rules), 256).alias("base_sha256"), secrets.joined_spans(F.col("spans"), rules).alias("spans")
    )


def _of_rule(k: int):  # noqa: ANN202
    return lambda s: s["rule"] == k  # of one parameter: a second one would be the index


def _held_out(id_col: str = "doc_id"):  # noqa: ANN202
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs, only=~_held_out())
    rows = langid.identify(docs.select("doc_id", "text", _held_out().alias("held_out")), model)
    return rows.select("doc_id", "held_out", "lang_pred", "score")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_table(spark, sf_dir, "pages")).select(F.col("id").alias("page_id"), "url", "text", "n_chars")


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("id", "doc_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.exact_duplicates(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    rules = [urlrules.Rule.parse(r) for r in URL_RULES]
    return urlrules.match_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jaccard.near_duplicates(_table(spark, sf_dir, "documents"), k=3, least_percent=90)
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scan(_table(spark, sf_dir, "documents"))
    said = F.transform("licences", lambda x: F.concat_ws(":", x["licence"], x["start"].cast("string"), x["end"].cast("string")))
    return rows.select(F.col("id").alias("doc_id"), F.size("licences").cast("long").alias("n_licences"), F.array_join(said, ",").alias("licences"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality.trusted_ids(_table(spark, sf_dir, "labels"), (F.col("quality") == 1) & (F.col("toxic") == 0))
    return quality.judge(_table(spark, sf_dir, "documents"), trusted).withColumnRenamed("id", "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_secret_scan, op3_language_id, op4_main_text, op5_pack_sequences,
        op6_exact_dedup, op7_url_rules, op8_ngram_jaccard, op9_license_scan, op10_quality,
    )
}

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

ORACLES = {
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_NORMAL}) AS text_sha256, length(coalesce(text, '')) AS n FROM documents),
        r AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS k,
                     count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d),
        w AS (SELECT text_sha256 AS t, doc_id AS keep_id FROM r WHERE k = 1)
        SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM r JOIN w ON t = text_sha256""",
    "op7_url_rules": r"""
        WITH rules(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
            ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
        p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
        q AS (SELECT page_id, CASE WHEN contains(u, '://') THEN substr(u, instr(u, '://') + 3) ELSE '' END AS rest FROM p),
        h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM q),
        m AS (SELECT page_id, host, path, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY page_id, host, path
                     ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
              FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
        b AS (SELECT * FROM m WHERE k = 1)
        SELECT h.page_id, h.host, h.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
        FROM h LEFT JOIN b ON h.page_id = b.page_id AND h.host = b.host AND h.path = b.path""",
}
