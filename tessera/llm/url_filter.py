"""URL filters: a blocked Bloom filter before an exact hash join.

Listed URLs are made canonical and hashed into a blocked Bloom filter: the hash
picks one block of 512 bits, held as eight longs, and one bit in each long.
A page meets exactly one block.  Pages whose block lacks a bit are surely not
listed; the few that pass go to an exact hash join with the listed canonical
URLs, which removes false positives.

The filter takes about 16 bits a listed URL.  Up to ``MAX_FILTER_BYTES`` it is
broadcast (its size follows from the list's count, which is checked first);
above, pages are joined to their blocks by shuffle, with the same result.  A
hot URL or host is one key of that join, which AQE splits.

:func:`judge` takes any table of listed URLs.  :func:`listing` makes one from
two sources that know nothing of the rules: hosts with a label word of a
:data:`CATEGORIES` entry, and reports of toxic documents, whatever their host.

Only DataFrame functions are used.  Defined cases: a null url or one without
``://`` has empty host and path, fits no rule and is not listed; repeated rows
give repeated result rows; an empty list or table gives the rules' verdicts or
an empty result; further columns are ignored.  For the list, a null html has no
title, a null text opens nothing, a null label reports nothing, and an opening
that any labelled document shares without being reported lists no page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stage_table

#: Fixed rules of the contract: (rule, verdict).
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Words that put a host on the list when they are a whole word of one of its labels (``free-bets.example.com``).
CATEGORIES = {
    "ads and trackers": ("ads", "adserver", "adservice", "clickbait", "popunder", "telemetry", "tracker", "trackers", "tracking"),
    "adult": ("adult", "adults", "escort", "escorts", "nsfw", "porn", "porno", "xxx"),
    "fraud and malware": ("malware", "phishing", "scam", "scams", "spam", "spyware", "warez"),
    "gambling": ("bet", "bets", "betting", "casino", "casinos", "gamble", "gambling", "jackpot", "poker", "roulette", "slots"),
    "pills": ("cialis", "pill", "pills", "steroids", "viagra"),
}
#: A report names a page by the opening of its text, which is the page's title.
OPENING_CHARS, SHORTEST_OPENING = 60, 20
#: Character references in titles, in the order in which they are read.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
BLOCK_LONGS = 8
BITS_PER_URL = 16
MAX_FILTER_BYTES = 8 << 20


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Scheme, port, ``www.``, query, fragment, empty segments and a last slash do not tell URLs apart;
    null where there is no host."""
    h = F.regexp_replace(F.regexp_replace(host, r":\d*$", ""), r"^www\.", "")
    p = F.regexp_replace(F.regexp_replace(path, "/+", "/"), "/$", "")
    return F.when(h != "", F.concat(h, p))


def title_of(html: Column) -> Column:
    title = F.regexp_extract(F.coalesce(html, F.lit("")), "<title>([^<]*)</title>", 1)
    for written, meant in REFERENCES:
        title = F.replace(title, F.lit(written), F.lit(meant))
    return title


def reported_openings(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(opening): how texts begin of which every labelled one is toxic."""
    said = labels.select(F.col("doc_id").alias("_id"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
    opening = documents.select(F.col("doc_id").alias("_doc"), F.substring("text", 1, OPENING_CHARS).alias("opening"))
    found = opening.where(F.char_length("opening") >= SHORTEST_OPENING).join(said, F.col("_doc") == F.col("_id"))
    return found.groupBy("opening").agg(F.bool_and("toxic").alias("toxic")).where("toxic").select("opening")


def listing(pages: DataFrame, documents: DataFrame, labels: DataFrame, categories=CATEGORIES) -> DataFrame:
    """(url): pages on a host of a listed category, and pages titled by the opening of a reported text."""
    words = F.array(*[F.lit(w) for group in categories.values() for w in group])
    by_host = F.arrays_overlap(F.split(host_of(F.col("url")), "[.:-]"), words)
    rows = pages.select("url", by_host.alias("by_host"), title_of(F.col("html")).alias("title"))
    by_text = rows.join(reported_openings(documents, labels), F.col("title") == F.col("opening"), "left_semi")
    return rows.where("by_host").select("url").unionByName(by_text.select("url"))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null.  A short list: it becomes one CASE."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: -len(r[0])):
        h, p = rule.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.lit(rule)) if out is None else out.when(fits, F.lit(rule))
    return F.lit(None).cast("string") if out is None else out


def _bits(key: Column) -> list[Column]:
    """One bit (as a long) for each long of a block, from two hashes of the key."""
    a, b = F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)
    picks = [F.pmod(F.shiftrightunsigned(x, 6 * i), F.lit(64)).cast("int") for x in (a, b) for i in range(BLOCK_LONGS // 2)]
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, p) for p in picks]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), key), F.lit(blocks)).cast("long")


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7) from distinct keys in column ``listed_key``."""
    rows = listed.select(_block(F.col("listed_key"), blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col("listed_key")))])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(BLOCK_LONGS)])


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
          listed_col: str = "url", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, listed."""
    url = F.col(listed_col)
    listing = stage_table(listed.select(canonical(host_of(url), path_of(url)).alias("listed_key"))
                          .where(F.col("listed_key").isNotNull()).distinct(), "listed-urls")
    count = listing.count()
    blocks = max(1, -(-count * BITS_PER_URL // (64 * BLOCK_LONGS)))
    words = stage_table(bloom(listing, blocks), "url-bloom")
    if blocks * 8 * (BLOCK_LONGS + 1) <= max_filter_bytes:
        words = F.broadcast(words)
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.select("*", rule_for(F.col("host"), F.col("path"), rules).alias("rule"), canonical(F.col("host"), F.col("path")).alias("key"))
    probe = rows.withColumn("at", F.coalesce(_block(F.col("key"), blocks), F.lit(-1).cast("long")))
    inside = None
    for i, bit in enumerate(_bits(F.col("key"))):
        hit = F.col(f"w{i}").bitwiseAND(bit) != 0
        inside = hit if inside is None else inside & hit
    probe = probe.join(words, F.col("at") == F.col("block"), "left")
    probe = stage_table(probe.select("page_id", "host", "path", "rule", "key", F.coalesce(inside & F.col("key").isNotNull(), F.lit(False)).alias("maybe")), "probed-pages")
    exact = (probe.where("maybe").join(listing.hint("shuffle_hash"), F.col("key") == F.col("listed_key"), "left")
             .select("page_id", "host", "path", "rule", F.col("listed_key").isNotNull().alias("listed")))
    rest = probe.where("not maybe").select("page_id", "host", "path", "rule", F.lit(False).alias("listed"))
    out = exact.unionByName(rest)
    verdict = None
    for rule, said in rules:
        verdict = F.when(F.col("rule") == rule, F.lit(said)) if verdict is None else verdict.when(F.col("rule") == rule, F.lit(said))
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", (own if verdict is None else verdict.otherwise(own)).alias("verdict"), "listed")
