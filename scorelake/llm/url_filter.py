"""URL filters: path rules, then a blocked Bloom filter before an exact join with the list.

DataFrame functions only.
"""
from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.sources.checkpoint import materialize

#: Filter bits per listed URL; a block has 8 words of 32 bits, and a URL sets one in each.
BITS_PER_URL = 16
BLOCK_BITS = 256
#: Largest filter, in bytes, that is broadcast; a larger one is joined by block number.
BROADCAST_BYTES = 32 << 20
WORDS = [f"w{i}" for i in range(8)]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without `www.`, and path without trailing slashes; null if there is no host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", "")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both null if none fits.

    A rule `host/path` fits its host and all subdomains where the path starts with the
    rule's. Rules are a short policy, a column expression each; of equally long ones
    that both fit, `block` wins, then the smaller text.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", [-ord(c) for c in r[1]])):
        of, slash, rest = text.partition("/")
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def block_number(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bit_of(key: Column, word: int) -> Column:
    """The bit (0 to 31) that the key sets in a word of its block, from a second hash."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 5 * word).bitwiseAND(F.lit(31)).cast("int")


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w7): the filter as a table, one row per block that has a bit."""
    bits = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit_of(F.col(key), i))).alias(w) for i, w in enumerate(WORDS)]
    return listed.groupBy(block_number(F.col(key), blocks).alias("block")).agg(*bits)


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
                listed_col: str = "url", bits_per_url: int = BITS_PER_URL) -> DataFrame:
    """(id, host, path, rule, verdict, listed) per input row. The longest fitting rule
    decides; where none fits, a URL whose canonical form is listed is blocked.

    The filter has `bits_per_url` bits per distinct listed URL. It is broadcast up to
    BROADCAST_BYTES, beyond that joined by block number. What it passes is
    joined with the exact list, so the verdict has no false positive; the rest skips the join.

    Null, empty and schemeless URLs have empty host and path, no rule and verdict allow.
    Repeated rows give repeated results; null ids stay null; of other columns none is
    read. An empty list blocks nothing.
    """
    known = materialize(listed.select(canonical(host_of(F.col(listed_col)), path_of(F.col(listed_col))).alias("entry")).filter("entry IS NOT NULL").distinct(), "listed")
    blocks = max(1, math.ceil(known.count() * bits_per_url / BLOCK_BITS))
    table = bloom_filter(known, "entry", blocks)
    if blocks * 8 * (len(WORDS) + 1) <= BROADCAST_BYTES:
        table = F.broadcast(table)
    host, path = F.col("host"), F.col("path")
    parts = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = rule_of(host, path, rules)
    keyed = parts.select("id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), canonical(host, path).alias("entry"))
    asked = F.col("ruled").isNull() & F.col("entry").isNotNull()
    probes = keyed.filter(asked).withColumn("block", block_number(F.col("entry"), blocks)).join(table, "block", "left")
    maybe = F.lit(True)
    for i, w in enumerate(WORDS):
        maybe = maybe & (F.call_function("shiftright", F.col(w), bit_of(F.col("entry"), i)).bitwiseAND(F.lit(1)) == 1)
    probed = probes.withColumn("maybe", F.coalesce(maybe, F.lit(False))).drop("block", *WORDS)
    hits = probed.filter("maybe").join(known.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "entry", "left")
    columns = ["id", "host", "path", "rule", "ruled"]
    no = F.lit(False).alias("listed")
    out = hits.select(*columns, F.coalesce("listed", F.lit(False)).alias("listed")) \
        .unionByName(probed.filter("NOT maybe").select(*columns, no)).unionByName(keyed.filter(~asked).select(*columns, no))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule",
                      F.coalesce("ruled", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "listed")
