"""URLs judged by host and path rules and by a list of canonical URLs, with DataFrame functions only.

The list goes into a blocked Bloom filter: the hash of a canonical URL picks one block of four 64-bit words and two bits in
each. A block is one row of a table, made by a map-side combined bit-or. Pages meet the filter on the block: it is broadcast
up to MOST_BLOCKS blocks, so that no page is shuffled, and hash joined beyond. Only pages whose bits are all set go on to the
exact hash join on the canonical URL, which removes false positives; all others are settled and join the result by a union.

The canonical form: lower-case scheme and host, no user, default port, fragment, ``www.`` or trailing slash, and the query
without ``ref`` and ``utm_*`` parameters. Null urls and those without ``://`` have an empty host and path and are allowed.
Repeated rows are judged alike; an empty list allows everything that no rule blocks, an empty table gives an empty result.
Urls of any length are read whole; of two rules that fit the longer one wins, and rules of one length are tried in the order
given. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import Scratch

#: Listed URLs per block of 256 bits: 8 bits set for each, about 1.5 % false positives.
PER_BLOCK = 16
#: Blocks of 40 bytes up to which the filter is broadcast.
MOST_BLOCKS = 1 << 19


@dataclass(frozen=True)
class Rule:
    verdict: str
    rule: str  # host/path

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.split("/", 1)[1]


RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    scheme = _lower(F.substring(url, F.lit(1), F.instr(url, "://") - 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host_of(url), r"^.*@", ""), r":(?:80|443)?$", ""), r"^www\.", "")
    query = F.regexp_extract(_rest(url), r"(?s)^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(?:ref|utm_[a-z]+)(?:=|$)"))
    kept = F.array_join(F.array_sort(pairs), "&")
    base = F.concat(scheme, F.lit("://"), host, F.regexp_replace(path_of(url), "/+$", ""))
    return F.when(F.instr(url, "://") > 0, F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept)))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, or null; of equally long ones the first."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.rule)):  # later ones win: the longest
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, r.rule).otherwise(out)
    return out


def _probe(url: Column, blocks: Column) -> tuple[Column, list[Column]]:
    """A canonical URL's block, and its bits in the block's four words."""
    h, g = F.xxhash64(url), F.xxhash64(F.lit(7), url)
    bits = [_bit(g, 12 * w).bitwiseOR(_bit(g, 12 * w + 6)) for w in range(4)]
    return F.pmod(h, blocks), bits


def _bit(h: Column, shift: int) -> Column:
    place = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63).cast("long")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bloom(listed: DataFrame, per_block: int = PER_BLOCK) -> tuple[DataFrame, int]:
    """listed: canonical urls in ``url``. The filter's blocks (block, w0..w3) and how many there may be."""
    n = max(1, -(-listed.count() // per_block))
    block, bits = _probe(F.col("url"), F.lit(n))
    rows = listed.where("url is not null").select(block.alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)]), n


def listed_pages(pages: DataFrame, listed: DataFrame, per_block: int = PER_BLOCK, most_blocks: int = MOST_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """(pages with canonical, possible and listed; the filter). pages has url; listed has canonical ones in url."""
    listed = Scratch(pages.sparkSession).table(listed.select("url").where("url is not null").distinct())
    filt, n = bloom(listed, per_block)
    own = pages.withColumn("canonical", canonical(F.col("url")))
    block, bits = _probe(F.col("canonical"), F.lit(n))
    filt = filt.withColumnRenamed("block", "_block")
    met = own.join(F.broadcast(filt) if n <= most_blocks else filt, block == F.col("_block"), "left")
    possible = F.lit(True)
    for i, b in enumerate(bits):
        possible = possible & (F.col(f"w{i}").bitwiseAND(b) == b)
    met = met.withColumn("possible", F.coalesce(possible, F.lit(False))).drop("_block", "w0", "w1", "w2", "w3")
    exact = listed.select(F.col("url").alias("_url"))
    hits = met.where("possible").join(exact, F.col("canonical") == F.col("_url"), "left")
    hits = hits.withColumn("listed", F.col("_url").isNotNull()).drop("_url")
    return met.where("not possible").withColumn("listed", F.lit(False)).union(hits), filt


def judge(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES, per_block: int = PER_BLOCK) -> DataFrame:
    """page_id, host, path, rule, verdict, listed. ``listed`` holds canonical URLs to block in ``url``."""
    found, _ = listed_pages(pages.select("page_id", "url"), listed, per_block)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    out = found.select("page_id", host.alias("host"), path.alias("path"), "listed").withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    given = F.lit(None).cast("string")
    for r in rules:
        given = F.when(F.col("rule") == r.rule, r.verdict).otherwise(given)
    return out.select("page_id", "host", "path", "rule", F.coalesce(given, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def junk_titled(pages: DataFrame) -> DataFrame:
    """The default list: canonical URLs of the pages whose title is littered with symbols (three runs of them or more)."""
    title = F.regexp_extract("html", r"(?s)<title>([^<]*)</title>", 1)
    return pages.where(F.regexp_count(title, F.lit(r"[#%$*&]{3}")) >= 3).select(canonical(F.col("url")).alias("url")).where("url is not null").distinct()
