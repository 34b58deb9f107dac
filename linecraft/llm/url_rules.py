"""URL filter as a sort-merge range join.

A host is turned round label by label (``www.example.net`` becomes
``net.example.www.``), so a rule's host and all its subdomains are one interval
of keys. Pages and rules meet in key order: a sorted sweep keeps a stack of the
rules whose intervals hold the current key, and the page takes the longest rule
on the stack whose path begins the page's path.

Keys are dealt to ranges by boundaries from a bounded sample of page keys, each
with a salt, so one host with a third of all pages still spreads over many
ranges; a rule goes to every range that its interval meets. No side is
broadcast.

A url that is null or has no ``://`` has empty host and path and fits no rule.
Rules with an empty host fit every page whose path they begin. Repeated pages
each get their row; repeated rules count once, and of equal rules with
different verdicts ``block`` wins. Extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Verdict of a page that fits no rule.
OTHERWISE = "allow"
#: Sampled keys for each range; bounds what the driver sees.
SAMPLE = 32

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_LAST = "\U0010ffff"


def host_key(host: str) -> str:
    return "".join(label + "." for label in reversed(host.split("."))) if host else ""


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``page_id, host, path`` of each url."""
    cut = F.instr("url", "://")
    rest = F.when(cut > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract("rest", "^[^/?#]*", 0)
    folded = F.translate("raw", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), "^[^?#]*", 0)
    return (
        pages.select("page_id", rest.alias("rest"))
        .select("page_id", "rest", host.alias("raw"))
        .select("page_id", folded.alias("host"), path.alias("path"))
    )


def _key(host):
    """SQL form of ``host_key``."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.when(host == "", "").otherwise(F.concat(F.array_join(labels, "."), F.lit(".")))


def _ranges(pages: DataFrame, n: int) -> list[tuple[str, int]]:
    """At most n - 1 boundaries (key, salt) from at most SAMPLE * n pages, those
    with the smallest hashes."""
    rows = pages.select("key", "salt").orderBy(F.xxhash64("salt"), "key").limit(SAMPLE * n).collect()
    keys = sorted((r["key"], r["salt"]) for r in rows)
    picked = [keys[len(keys) * i // n] for i in range(1, n)] if keys else []
    return sorted(set(picked))


def _dealer(bounds):
    """Adds the range of each page."""

    def deal(batches):
        for b in batches:
            at = [bisect_right(bounds, ks) for ks in zip(b["key"].to_pylist(), b["salt"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], [*b.schema.names, "range"])

    return deal


def _sweep(batches):
    """Rows of a task by (range, key, kind): a rule (kind 0) comes before the
    pages it may hold."""
    stack: list[tuple[str, str, dict[str, str], list[int]]] = []
    here = None
    for b in batches:
        out = []
        cols = [b[c].to_pylist() for c in ("range", "key", "kind", "page_id", "host", "path", "verdict")]
        for part, key, kind, page_id, host, path, verdict in zip(*cols, strict=True):
            if part != here:
                stack, here = [], part
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, host, {}, []))
                _, _, paths, lengths = stack[-1]
                if paths.get(path) != "block":
                    paths[path] = verdict
                if len(path) not in lengths:
                    lengths.append(len(path))
                    lengths.sort(reverse=True)
                continue
            best, found = None, (OTHERWISE, None)
            for _, rule_host, paths, lengths in stack:
                for n in lengths:
                    head = path[:n]
                    if len(head) == n and head in paths:
                        size = (len(rule_host) + n, len(rule_host))
                        if best is None or size > best:
                            best, found = size, (paths[head], rule_host + head)
                        break
            out.append((page_id, host, path, found[1], found[0]))
        if out:
            names = ["page_id", "host", "path", "rule", "verdict"]
            kinds = [pa.int64()] + [pa.string()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names
            )


RESULT = "page_id bigint, host string, path string, rule string, verdict string"


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page.

    ``pages`` has ``page_id, url``; ``rules`` has ``host, path, verdict`` (nulls
    count as empty; rows without a verdict are no rules). Longest wins: the
    rule's text ``host`` + ``path``, then its host.
    """
    n = max(1, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = with_host_and_path(pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url"))
    keyed = cut.select("page_id", "host", "path", _key(F.col("host")).alias("key"), F.xxhash64("page_id", "path").alias("salt"))
    bounds = _ranges(keyed, n)
    dealt = keyed.mapInArrow(
        _dealer(bounds), "page_id bigint, host string, path string, key string, salt bigint, range int"
    ).select(
        "range", "key", F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict")
    )

    def spans(batches):
        keys = [k for k, _ in bounds]
        for b in batches:
            lo = [bisect_left(keys, k) for k in b["key"].to_pylist()]
            hi = [bisect_right(keys, k + _LAST) for k in b["key"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], [*b.schema.names, "lo", "hi"]
            )

    rule_host = F.translate(F.coalesce("host", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    named = rules.where("verdict is not null").select(
        rule_host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    met = (
        named.select("host", "path", "verdict", _key(F.col("host")).alias("key"))
        .mapInArrow(spans, "host string, path string, verdict string, key string, lo int, hi int")
        .select(F.explode(F.sequence("lo", "hi")).alias("range"), "key", "host", "path", "verdict")
        .select("range", "key", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("page_id"), "host", "path", "verdict")
    )
    return (
        met.unionByName(dealt)
        .repartitionById(n, F.col("range"))
        .sortWithinPartitions("range", "key", "kind")
        .mapInArrow(_sweep, RESULT)
    )
