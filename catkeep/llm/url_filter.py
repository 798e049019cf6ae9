"""URL filter: blocked Bloom filter in front of an exact join with a list of canonical URLs.

Only DataFrame functions. Rules on host and path decide first; the rest is blocked when its canonical
form is listed.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule, has no
canonical form and is allowed. Repeated rows are judged each on its own. An empty list blocks nothing.
Null list entries are left out. Input columns named like a result column are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catkeep.llm.common import ascii_lower, keep_but

RESULT = ("host", "path", "rule", "canonical", "possible", "listed", "verdict")
WORDS = 4
#: Bits a listed URL may take: at 16 about one unlisted URL in 400 passes on to the exact join.
BITS_PER_URL = 16
#: The filter grows with the list up to so many blocks (40 bytes each); beyond, more URLs reach the join.
MAX_BLOCKS = 1 << 22
#: A filter of at most so many bytes is broadcast; a larger one is joined by block number.
BROADCAST_BYTES = 8 << 20
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host, path without closing slashes and sorted query without tracking; null without ``://``.

    Scheme, user, default port and fragment do not count.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^[^@]*@", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.rlike(p, F.lit(TRACKING)))
    )
    return F.when(
        F.instr(url, "://") > 0,
        F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")),
    )


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of length, name and verdict; null if none does."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(
                F.lit(len(r.name)).alias("length"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")
            ),
        )
        for r in rules
    ]
    return F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast(
        "struct<length:int,name:string,verdict:string>"
    )


def _block(canonical: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(canonical), F.lit(blocks))


def _masks(canonical: Column) -> list[Column]:
    """One bit in each word of a block."""
    bits = F.xxhash64(canonical, F.lit(17))
    return [
        F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(bits, 6 * i), F.lit(64)).cast("int")
        )
        for i in range(WORDS)
    ]


def block_count(urls: int) -> int:
    wanted = max(1, -(-urls * BITS_PER_URL // (64 * WORDS)))
    return min(MAX_BLOCKS, 1 << (wanted - 1).bit_length())


def broadcast_blocks(keys: int) -> int:
    """Blocks of a filter that is broadcast whatever the number of keys; of too many, it lets more rows through."""
    return min(block_count(keys), BROADCAST_BYTES // (8 * (WORDS + 1)))


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as a table: block number and its words; blocks nobody hashes to are left out."""
    marked = keys.select(
        _block(F.col(key), blocks).alias("_block"),
        *[m.alias(f"_word{i}") for i, m in enumerate(_masks(F.col(key)))],
    )
    return marked.groupBy("_block").agg(*[F.bit_or(f"_word{i}").alias(f"_word{i}") for i in range(WORDS)])


def with_possible(rows: DataFrame, keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows with ``possible``: false only if the row's key is not among ``keys``."""
    filter_table = bloom_blocks(keys, key, blocks)
    if blocks * 8 * (WORDS + 1) <= BROADCAST_BYTES:
        filter_table = F.broadcast(filter_table)
    hit = F.col(key).isNotNull()
    for i, mask in enumerate(_masks(F.col(key))):
        hit = hit & (F.col(f"_word{i}").bitwiseAND(mask) == mask)
    return (
        rows.withColumn("_block", _block(F.col(key), blocks))
        .join(filter_table, "_block", "left")
        .withColumn("possible", F.coalesce(hit, F.lit(False)))
        .drop("_block", *[f"_word{i}" for i in range(WORDS)])
    )


def judge(
    urls: DataFrame, listed: DataFrame, rules: list[Rule], url: str = "url", blocks: int | None = None
) -> DataFrame:
    """Every row of ``urls`` with host, path, rule, canonical, possible, listed and verdict.

    ``listed`` has a column ``canonical``. ``blocks`` sets the size of the filter; by default it
    follows the number of listed URLs. ``possible`` says whether the filter let the URL through,
    ``listed`` what the exact join found.
    """
    known = listed.select("canonical").where("canonical IS NOT NULL").distinct()
    blocks = blocks or block_count(known.count())
    address = F.col(f"`{url}`").cast("string")
    rows = urls.select(
        *keep_but(urls, RESULT),
        host_of(address).alias("host"),
        path_of(address).alias("path"),
        canonical_url(address).alias("canonical"),
    )
    probed = with_possible(rows, known, "canonical", blocks)
    passed = probed.where("possible").join(
        known.withColumn("listed", F.lit(True)), "canonical", "left"
    )
    both = passed.unionByName(probed.where("NOT possible").withColumn("listed", F.lit(False)))
    chosen = rule_for(F.col("host"), F.col("path"), rules)
    return (
        both.withColumn("listed", F.coalesce("listed", F.lit(False)))
        .withColumn("_rule", chosen)
        .withColumn("rule", F.col("_rule.name"))
        .withColumn("verdict", F.coalesce("_rule.verdict", F.when(F.col("listed"), "block").otherwise("allow")))
        .drop("_rule")
    )
