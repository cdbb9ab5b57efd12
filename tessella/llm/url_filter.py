"""URL filters: host and path rules, and a blocked Bloom filter of listed canonical URLs before an exact hash join.

Canonical URL: lower-cased host and path without a trailing slash; scheme, query and fragment do not count. The filter has
blocks of four 64-bit words; a URL sets two bits in each word of its block, all from one 64-bit hash each for block and bits.
The blocks are a DataFrame: they are broadcast only where their number is within ``BROADCAST_BLOCKS`` and joined by a shuffle
beyond it. What passes meets the list itself in a hash join, which removes false positives, so the result is exact.

Rows: a null url, or one without ``://``, has an empty host and path and matches no rule and no list; repeated rows are judged
alike; an empty list blocks nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import pick, table

#: (host, path, verdict). A rule fits its host and all subdomains if the path starts with the rule's.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Registered names under which the production list's URLs lie, and what their pages must hold to be listed.
ADVERT = 'class="ad"'
LISTED_SITES = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
#: URLs a block of 256 bits takes, and the blocks (32 bytes each) that may be broadcast.
URLS_A_BLOCK, BROADCAST_BLOCKS = 16, 1 << 15
WORDS = 4


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Null where there is no host."""
    return F.when(host != "", F.concat(host, F.regexp_replace(path, "/+$", "")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; a short list, so it stays an expression."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("block")), F.lit(blocks)).cast("bigint")


def _masks(url: Column) -> list[Column]:
    """Two bits for each word of the block."""
    h = F.xxhash64(url, F.lit("bits"))
    bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * n).bitwiseAND(63).cast("int"))
    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3) of the listed canonical urls in column ``url``; empty blocks have no row."""
    words = [m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("url")))]
    bits = listed.select(_block(F.col("url"), blocks).alias("block"), *words)
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def listed_urls(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """The distinct urls of ``urls`` (column ``url``) that are in ``listed`` (column ``url``)."""
    listed = listed.where("url IS NOT NULL").distinct()
    blocks = max(1, -(-listed.count() // URLS_A_BLOCK))
    filter_ = bloom_blocks(listed, blocks)
    wanted = urls.where("url IS NOT NULL").distinct().withColumn("block", _block(F.col("url"), blocks))
    hits = wanted.join(F.broadcast(filter_) if blocks <= BROADCAST_BLOCKS else filter_, "block")
    for i, m in enumerate(_masks(F.col("url"))):
        hits = hits.where(F.col(f"w{i}").bitwiseAND(m) == m)
    return hits.select("url").join(listed.hint("shuffle_hash"), "url", "left_semi")


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed): the longest rule's verdict, else block where the list holds the url."""
    host, path = parts(F.col("url"))
    split = pick(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    split = split.withColumn("url", canonical(F.col("host"), F.col("path")))
    hit = listed_urls(split.select("url"), listed).withColumn("listed", F.lit(True))
    ruled = rule_of(F.col("host"), F.col("path"), rules)
    found = split.join(hit, "url", "left").withColumn("listed", F.coalesce("listed", F.lit(False))).withColumn("by", ruled)
    verdict = F.coalesce("by.verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", F.col("by.rule").alias("rule"), verdict.alias("verdict"), "listed")


def advert_list(pages: DataFrame, sites: list[str] = LISTED_SITES, advert: str = ADVERT) -> DataFrame:
    """The production list: canonical urls of the pages that carry an advert on a host with one of ``sites`` as a label.

    Other pages of these hosts are not listed, so a host says nothing about the list.
    """
    host, path = parts(F.col("url"))
    split = pages.where(F.contains("html", F.lit(advert))).select(host.alias("host"), path.alias("path"))
    return split.where(F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, sites)))).select(canonical(F.col("host"), F.col("path")).alias("url")).distinct()


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url, judged by the rules and the production list."""
    pages = table(spark, sf_dir, "pages")
    return judge(pages, advert_list(pages))


SQL = r"""
WITH s AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest, coalesce(contains(html, 'class="ad"'), false) AS advert FROM pages
), p AS (
  SELECT page_id, advert,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1, 's') AS path
  FROM s
), c AS (
  SELECT *, CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '') END AS url FROM p
), l AS (
  SELECT DISTINCT url FROM c
  WHERE advert AND list_has_any(string_split(host, '.'), ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])
), r AS (
  SELECT c.page_id, c.host, c.path, (l.url IS NOT NULL) AS listed,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM c LEFT JOIN l ON c.url = l.url
)
SELECT page_id, host, path, rule, listed,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
