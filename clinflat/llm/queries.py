"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat.llm import (
    bpe_chunks,
    collocations,
    compression_rules,
    decontamination,
    feistel_shards,
    hard_negatives,
    interpolated_lm,
    jaccard_join,
    license_scan,
    oracles,
    revisits,
    simhash_dedup,
    suffix_dedup,
    url_filter,
)
from clinflat.llm.texts import table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.components(table(spark, sf_dir, "documents"), width=3, radius=3)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


# Rules of the URL filter.
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]

# Labelled URLs, on hosts and paths in the style of what a crawl meets.
BLOCKED_URLS = [
    "http://ads-server.example.com/click/1", "https://www.ads-track.example.org/en/3?ref=x",
    "http://track.ads.example.com/pixel.html", "https://adult-video.example.com/en/12",
    "https://m.adult-x.example.org/es/7.html", "http://xxx-adult.example.org/",
    "https://bet-now.example.com/en/4", "http://free-bets.example.org/de/88/",
    "https://www.best-bets.example.com/fr/2", "https://casino-royal.example.com/en/10",
    "http://blog.casino-win.example.com/en/301#top", "https://win-casino.example.org/en/5",
    "http://cheap-pills.example.com/es/66?utm_source=feed", "https://pills-shop.example.org/en/9",
    "https://m.cheap-meds.example.com/en/70", "http://spam-farm.example.com/en/501.html",
    "https://www.spam-links.example.org/en/44/", "http://link-farm.example.org/de/13",
    "https://poker-win.example.com/fr/8", "http://free-casino.example.org/en/17?page=2&ref=x",
    "https://xxx-free.example.com/en/3", "http://cheap-loans.example.org/en/91",
    "https://win-free.example.com/en/6#top", "http://ads-free-bets.example.com/es/5",
]
ALLOWED_URLS = [
    "http://www.thenation.example.com/en/12", "https://blog.therest.example.org/en/301#top",
    "https://m.thing.example.com/fr/4", "http://tionale.example.org/de/8/",
    "https://thereand.example.com/en/77?utm_source=feed", "http://theother.example.org/es/31",
    "https://www.nation.example.com/en/5.html", "http://blog.station.example.org/en/18",
    "https://thin.example.com/en/63?page=2&ref=x", "http://m.thought.example.org/en/2",
    "https://thanks.example.com/es/9", "http://theatre.example.org/en/240/",
    "https://library.example.org/en/1", "http://docs.example.com/en/manual.html",
    "https://www.history.example.org/fr/90", "http://weather.example.com/de/14#top",
    "https://blog.garden.example.com/en/52", "http://school.example.org/en/7?page=2&ref=x",
    "https://recipes.example.com/es/33", "http://m.museum.example.org/en/6.html",
    "https://trains.example.com/en/81", "http://www.science.example.org/en/404",
    "https://thanthe.example.com/fr/15/", "http://tionsher.example.org/en/29",
    "https://theand.example.com/de/3", "http://blog.thentha.example.org/en/11?utm_source=feed",
]


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = [(u, 1) for u in BLOCKED_URLS] + [(u, 0) for u in ALLOWED_URLS]
    row = [F.struct(F.lit(u).alias("url"), F.lit(y).alias("blocked")) for u, y in rows]
    return spark.range(1).select(F.inline(F.array(*row)))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four captures of every page, as a crawler that asks for changes would record them.

    The first is a full response (for every 11th page a revisit without one before it), the
    others mostly revisits; every third page changes at its third visit. Later visits use
    other spellings of the URL. Some entity tags are weak, stale or absent.
    """
    k, visit = F.col("page_id"), F.col("visit")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.md5("html").alias("digest"))
    rows = pages.withColumn("visit", F.explode(F.array(*[F.lit(v) for v in range(4)])))
    status = F.when((visit == 0) & (k % 11 != 0), 200).when((visit == 2) & (k % 3 == 0), 200)
    version = F.when((visit >= 2) & (k % 3 == 0) & ~((visit == 3) & (k % 5 == 0)), "b")
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 12), version.otherwise("a"), F.lit('"'))
    tag = F.when((visit == 1) & (k % 4 == 0), F.concat(F.lit("W/"), tag)).otherwise(tag)
    day = F.concat(F.lit("2026-01-0"), version.otherwise("a"))
    absent = F.lit(None).cast("string")

    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    spelled = F.when(visit % 2 == 0, F.col("url")).otherwise(
        F.concat(F.regexp_replace("url", "[#].*$", ""), F.lit("#v"), visit.cast("string"))
    )
    headers = F.array(
        header("ETag", F.when((k + visit) % 7 == 0, absent).otherwise(tag)),
        header("Last-Modified", F.when(k % 13 == 0, absent).otherwise(day)),
        header("Date", F.concat(F.lit("day "), visit.cast("string"))),
        header("Content-Length", F.length("digest") + visit),
    )
    seconds = F.lit(1767225600) + k * 7919 % 86400 + visit * 86400
    return rows.select(
        (k * 4 + visit).alias("record_id"), spelled.alias("url"),
        F.timestamp_seconds(seconds).alias("ts"),
        F.coalesce(status, F.lit(304)).alias("status"), headers.alias("headers"),
        F.concat("digest", F.lit("/"), visit.cast("string")).alias("payload"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), labelled_urls(spark), URL_RULES)
    return judged.withColumn("score", F.round("score", 6))


def op3_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe_chunks.digests(bpe_chunks.encode_documents(docs, vocabulary()))


def op4_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.matches(docs, benchmark).drop("h1", "h2")


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_rules.judge(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards.assign(table(spark, sf_dir, "documents"))


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"]))
    lines = F.array_join(F.array_sort(fields), "\n").alias("headers")
    found = revisits.resolve(captures(spark, sf_dir))
    return found.select("record_id", "canonical_url", "ts", "state", "refers_to", lines)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_url_filter": op2_url_filter,
    "op3_bpe_chunks": op3_bpe_chunks,
    "op4_interpolated_lm": op4_interpolated_lm,
    "op5_licenses": op5_licenses,
    "op6_decontamination": op6_decontamination,
    "op7_suffix_array": op7_suffix_array,
    "op8_quality": op8_quality,
    "op9_sharding": op9_sharding,
    "op10_revisits": op10_revisits,
    "op11_collocations": op11_collocations,
    "op12_jaccard": op12_jaccard,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op2_url_filter": oracles.url_filter_sql(URL_RULES, BLOCKED_URLS, ALLOWED_URLS),
    "op7_suffix_array": oracles.SUFFIX_ARRAY,
    "op9_sharding": oracles.SHARDING,
    "op10_revisits": oracles.REVISITS,
    "op11_collocations": oracles.COLLOCATIONS,
    "op13_hard_negatives": oracles.HARD_NEGATIVES,
}
