"""URL filter: rules by host and path, then a list of canonical URLs.

The list is met in two steps.  A blocked Bloom filter, one row of 64-bit lanes
per block, lets possible hits pass and never loses a listed URL; a hash join on
the canonical URL itself then removes its false positives.  The filter has a
fixed number of blocks whatever the list holds, so its size is known before it
is broadcast; a list too long for it costs more joining, never a wrong verdict.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"

#: Blocks of the filter; with eight lanes each it takes 4.5 MB at most.
BLOCKS = 1 << 16
LANES = 8

_LANE_SEED = 7


@dataclass(frozen=True)
class Rule:
    """A verdict on a host, its subdomains, and the paths that start alike."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        inside = (host == self.host) | host.endswith("." + self.host)
        return inside & path.startswith(self.path)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one, and for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """One form for the URLs that name one page.

    Without scheme, leading ``www.`` or ``m.``, trailing slashes, fragment and
    tracking parameters; the other parameters in order of their text.
    """
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref)="))
    )
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
    return F.concat(host, path, F.coalesce(tail, F.lit("")))


def _block(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BLOCKS))


def _lanes(key: Column) -> list[Column]:
    """One bit in each lane, from six bits each of a second hash."""
    value = F.xxhash64(key, F.lit(_LANE_SEED))
    bits = [F.shiftrightunsigned(value, 6 * i).bitwiseAND(F.lit(63)) for i in range(LANES)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), b.cast("int")) for b in bits]


def bloom_filter(keys: DataFrame, key: str) -> DataFrame:
    """The filter of a column, at most ``BLOCKS`` rows; blocks without keys are left out."""
    bits = keys.select(
        _block(F.col(key)).alias("__block"),
        *[lane.alias(f"__lane{i}") for i, lane in enumerate(_lanes(F.col(key)))],
    )
    return bits.groupBy("__block").agg(
        *[F.bit_or(f"__lane{i}").alias(f"__lane{i}") for i in range(LANES)]
    )


def with_possible_hits(frame: DataFrame, key: str, bloom: DataFrame) -> DataFrame:
    """Append ``__possible``: false only where the key is certainly not listed."""
    probed = frame.withColumn("__block", _block(F.col(key))).join(
        F.broadcast(bloom), "__block", "left"
    )
    held = F.lit(True)
    for i, lane in enumerate(_lanes(F.col(key))):
        held = held & (F.col(f"__lane{i}").bitwiseAND(lane) == lane)
    return probed.withColumn("__possible", F.coalesce(held, F.lit(False))).drop(
        "__block", *[f"__lane{i}" for i in range(LANES)]
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, key: str = "page_id"
) -> DataFrame:
    """Verdict on every row's ``url``: ``key, host, path, rule, verdict, listed``.

    The longest rule that fits decides (of equal lengths the one given first);
    ``rules`` is a short list and becomes one expression.  Other rows are
    blocked if the canonical form of their URL is that of a ``url`` in
    ``listed``.  Null and malformed URLs have an empty host and path, no rule
    and the canonical form of nothing: they are allowed.  Repeated rows are
    judged each, an empty table gives an empty result, and other columns of
    either table are ignored.
    """
    url = F.col("url")
    host, path = F.col("host"), F.col("path")
    rule = verdict = F.lit(None).cast("string")
    for one in sorted(rules, key=lambda r: len(r.text)):
        rule = F.when(one.fits(host, path), one.text).otherwise(rule)
    for one in rules:
        verdict = F.when(rule == one.text, one.verdict).otherwise(verdict)
    judged = pages.select(
        key, host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("__url")
    ).select(key, "host", "path", "__url", rule.alias("rule"), verdict.alias("__ruled"))

    wanted = (
        listed.select(canonical(F.col("url")).alias("__url")).where(F.col("__url") != "").distinct()
    )
    probed = with_possible_hits(judged, "__url", bloom_filter(wanted, "__url"))
    open_hit = F.col("rule").isNull() & F.col("__possible")
    exact = wanted.withColumn("__listed", F.lit(True)).hint("shuffle_hash")
    hits = probed.where(open_hit).join(exact, "__url", "left")
    rest = probed.where(~open_hit).withColumn("__listed", F.lit(None).cast("boolean"))
    both = hits.unionByName(rest)
    blocked = F.coalesce(F.col("__listed"), F.lit(False))
    return both.select(
        key,
        "host",
        "path",
        "rule",
        F.coalesce("__ruled", F.when(blocked, BLOCK).otherwise(ALLOW)).alias("verdict"),
        blocked.alias("listed"),
    )
