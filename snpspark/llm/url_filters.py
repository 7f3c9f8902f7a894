"""Verdicts on urls from rules for hosts and paths, and from a list of canonical urls of any size.

The list is hashed into a blocked Bloom filter: a table of blocks of eight longs, in one of which each url sets BITS
bits. A url whose bits aren't all set in its block is surely not listed; the others, possible hits, are few, and only
they go through a hash join with the list itself on the canonical url, which removes the false positives. The filter
has about BITS_PER_URL bits for each listed url. It is broadcast if its counted blocks are at most `most_blocks`;
beyond that this join shuffles on the block.

A rule is a host and a path prefix. It fits its host and all subdomains where the url's path starts with the rule's;
of several the longest wins (if equally long, the one with the longer host). A url without a fitting rule is blocked if
it is listed and allowed otherwise.

Edge cases: a url that is null or has no ``://`` has an empty host and path; it is canonically its trimmed text, and a
null url is never listed. Repeated rows each give a row, columns other than the two named ones are ignored, lists and
tables may be empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table

BITS, BITS_PER_URL, BLOCK_BITS = 6, 16, 512
#: Query parameters that don't change the page.
TRACKING = r"(?:utm_[a-z]+|fbclid|gclid|ref|sessionid)"


def host_of(url: Column) -> Column:
    """Between the first :// and the next slash, question mark, number sign or end; A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www. and usual ports, path without a closing slash, other parameters in order; no scheme or fragment."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    asked = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    params = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(=|$)")))
    tail = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.concat_ws("&", params))).otherwise("")
    return F.when(F.instr(url, "://") > 0, F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), tail)).otherwise(F.trim(url))


def _places(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The url's block, and for each long of a block the bits that it needs there."""
    h, g = F.xxhash64(url), F.xxhash64(F.lit("bits"), url)
    at = [F.shiftrightunsigned(g, 9 * i).bitwiseAND(BLOCK_BITS - 1) for i in range(BITS)]
    word = lambda w: [F.when(F.shiftright(x, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int"))).otherwise(F.lit(0).cast("long")) for x in at]

    def either(xs):
        out = xs[0]
        for x in xs[1:]:
            out = out.bitwiseOR(x)
        return out

    return F.pmod(h, F.lit(blocks)), [either(word(w)) for w in range(BLOCK_BITS // 64)]


def bloom_filter(listed: DataFrame, url_col="url") -> tuple[DataFrame, int]:
    """(block, w0 to w7) of the urls' blocked Bloom filter, and the number of blocks."""
    n = listed.count()
    blocks = max(1, math.ceil(n * BITS_PER_URL / BLOCK_BITS))
    block, words = _places(F.col(url_col), blocks)
    rows = listed.select(block.alias("block"), *(w.alias(f"w{i}") for i, w in enumerate(words)))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(len(words)))), blocks


def listed_urls(rows: DataFrame, listed: DataFrame, *, most_blocks=1 << 17) -> DataFrame:
    """`rows` with a column listed; rows has canon, listed is distinct canonical urls in a column canon."""
    bloom, blocks = bloom_filter(listed, "canon")
    small = blocks <= most_blocks
    size = F.broadcast if small else (lambda df: df)
    block, words = _places(F.col("canon"), blocks)
    need = F.lit(True)
    for i, w in enumerate(words):
        need = need & (w.bitwiseAND(F.bitwise_not(F.col(f"w{i}"))) == 0)
    probed = rows.withColumn("block_", block).join(size(bloom.withColumnRenamed("block", "block_")), "block_", "left")
    # Stored, so that the rows are made and probed once for both parts.
    probed = stored(probed.withColumn("maybe_", F.coalesce(need, F.lit(False))).select(*rows.columns, "maybe_"))
    # Only possible hits meet the list; a hot url is one row there, and Spark splits its partition on this side.
    exact = listed.select("canon", F.lit(True).alias("listed"))
    hits = probed.where("maybe_").join(exact, "canon", "left").select(*rows.columns, F.coalesce("listed", F.lit(False)).alias("listed"))
    return hits.union(probed.where("not maybe_").select(*rows.columns, F.lit(False)))


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], listed: DataFrame, id_col="page_id", url_col="url", listed_col="url") -> DataFrame:
    """page_id, host, path, rule, verdict and listed for each page. rules: (verdict, "host/path prefix")."""
    listed = stored(listed.select(canonical(F.col(listed_col)).alias("canon")).where("canon is not null").distinct())
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), canonical(F.col("url")).alias("canon"))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The longest rule is asked first; rules are a short list, each a comparison.
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), len(r[1].partition("/")[0]), r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, ruled = F.when(fits, text).otherwise(rule), F.when(fits, verdict).otherwise(ruled)
    rows = rows.withColumn("rule", rule).withColumn("ruled", ruled)
    out = listed_urls(rows, listed)
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


#: The rules of the query, and host labels whose pages make its list.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
LISTED_LABELS = ["ads-track", "casino-win", "cheap-pills", "free-bets"]


def op3_url_filters(spark, sf_dir: str) -> DataFrame:
    """The list: the urls of all pages on hosts with one of the listed labels, with and without www. or parameters."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.where(host_of(F.col("url")).rlike(rf"(^|\.)({'|'.join(LISTED_LABELS)})\.")).select("url")
    return url_filter(pages, RULES, listed).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
with p as (select page_id, coalesce(url, '') as url from pages),
h as (select page_id, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') as path from p),
r as (select * from (values ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')) r(rule, verdict)),
f as (select page_id, rule, verdict, row_number() over (partition by page_id order by length(rule) desc) as k
      from h join r on (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1))) and starts_with(path, substr(rule, strpos(rule, '/'))))
select h.page_id, host, path, rule, coalesce(verdict, case when regexp_matches(host, '(^|\.)(ads-track|casino-win|cheap-pills|free-bets)\.') then 'block' else 'allow' end) as verdict
from h left join f on f.page_id = h.page_id and k = 1
"""
