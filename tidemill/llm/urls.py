"""URL filter: a sort-merge range join of urls with host-and-path rules.

A host is written with its labels reversed ("www.example.com" becomes "com.example.www."), so a rule's
host and all its subdomains form one interval of keys. Urls and rules are cut at the same key bounds, a
rule being copied to every range that its interval meets, and each range is swept in key order with a
stack of the rules whose interval is open. Intervals are nested or apart, so a rule is copied at most
once for each range, and the open ones at any key are the ancestors of one host.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = "://([^/?#]*)([^?#]*)"
#: Sorts after every key of a host and its subdomains, whose next character is a dot.
PAST_HOST = "/"
#: One range for so many urls, RANGES at least; the bounds come from a sample of about SAMPLED keys a range.
URLS_PER_RANGE = 1_000_000
RANGES = 64
SAMPLED = 100


def host_of(url) -> F.Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url) -> F.Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def host_key(host) -> F.Column:
    """Reversed labels, each followed by a dot; empty for an empty host."""
    return F.when(F.length(host) == 0, F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _bounds(urls: DataFrame, count: int, ranges: int) -> list[str]:
    """Keys that cut the urls into ranges of about equal size. They decide where a url is judged, not how."""
    share = min(1.0, SAMPLED * ranges / max(1, count))
    keys = urls.select("_key") if share == 1.0 else urls.select("_key").sample(share, seed=0)
    lows = keys.repartitionByRange(ranges, "_key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("_key").alias("low"))
    return sorted(r["low"] for r in lows.select("low").collect())[1:]  # at most `ranges` rows


def _range_of(bounds):
    """Number of the range that holds a key; ``bounds`` is a broadcast list in order."""

    @F.arrow_udf("int")
    def found(keys: pa.Array) -> pa.Array:
        return pa.array([bisect_right(bounds.value, k) for k in keys.to_pylist()], pa.int32())

    return found


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range, key and kind; a rule stands before the urls of its interval."""
    part, stack = None, []  # entries: host key, path -> verdict, lengths of these paths
    for batch in batches:
        rules: list[str | None] = []
        verdicts: list[str | None] = []
        places: list[int] = []
        columns = [batch.column(n).to_pylist() for n in ("_part", "_key", "_rule", "_path", "_verdict", "_host")]
        for i, (at, key, is_rule, path, verdict, host) in enumerate(zip(*columns, strict=True)):
            if at != part:
                part, stack = at, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if is_rule:
                if not stack or stack[-1][0] != key:
                    stack.append((key, host, {}, []))
                _, _, by_path, lengths = stack[-1]
                if path not in by_path:
                    by_path[path] = verdict
                    if len(path) not in lengths:
                        lengths.append(len(path))
                        lengths.sort(reverse=True)
                elif verdict == "block":
                    by_path[path] = verdict
                continue
            best = (-1, -1, None, None)
            for _, rule_host, by_path, lengths in stack:
                for n in lengths:
                    head = path[:n]
                    if len(head) == n and head in by_path:
                        found = (len(rule_host) + n, len(rule_host), rule_host + head, by_path[head])
                        best = max(best, found, key=lambda x: x[:2])
                        break
            places.append(i)
            rules.append(best[2])
            verdicts.append(best[3])
        kept = pa.Table.from_batches([batch]).take(pa.array(places, pa.int64()))
        for name, values in (("_rule_text", rules), ("_found", verdicts)):
            kept = kept.append_column(name, pa.array(values, pa.string()))
        yield from kept.select(["_row", "_host", "_path", "_rule_text", "_found"]).to_batches()


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", ranges: int | None = None
) -> DataFrame:
    """Per row: id, host, path, the longest fitting rule as text (else null) and its verdict (else ``default``).

    ``rules`` has host, path and verdict; a null host or path counts as empty and an empty host fits nothing.
    Among fitting rules the longest host plus path wins, then the longer host; of two equal rules block wins.
    A null url, or one without "://", has empty host and path. Equal rows are judged each for itself, a null
    id stays null, an empty table gives an empty result, and other columns are not looked at.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("_row"), host.alias("_host"), path.alias("_path"))
    # The hash behind path and id splits a url that holds a large share of all rows.
    tail = F.lpad(F.hex(F.xxhash64("_row")), 16, "0")
    urls = urls.withColumn("_key", F.concat(host_key(F.col("_host")), F.lit("\x01"), "_path", F.lit("\x01"), tail))
    marked = rules.select(
        F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("_host"),
        F.coalesce("path", F.lit("")).alias("_path"), F.col("verdict").alias("_verdict"),
    ).filter("_host <> ''").withColumn("_key", host_key(F.col("_host")))

    count = pages.count()
    ranges = ranges or max(RANGES, -(-count // URLS_PER_RANGE))
    part_of = _range_of(pages.sparkSession.sparkContext.broadcast(_bounds(urls, count, ranges)))
    last = F.concat(F.expr("substring(_key, 1, length(_key) - 1)"), F.lit(PAST_HOST))
    spread = marked.withColumn("_part", F.explode(F.sequence(part_of(F.col("_key")), part_of(last))))
    columns = ["_part", "_key", "_rule", "_path", "_verdict", "_host", "_row"]
    id_type = pages.schema[id_col].dataType
    both = urls.withColumns({"_part": part_of(F.col("_key")), "_rule": F.lit(False), "_verdict": F.lit(None).cast("string")}).select(columns).unionByName(
        spread.withColumns({"_rule": F.lit(True), "_row": F.lit(None).cast(id_type)}).select(columns)
    )
    swept = both.repartition(ranges, "_part").sortWithinPartitions("_part", "_key", F.desc("_rule")).mapInArrow(
        _sweep, f"_row {id_type.simpleString()}, _host string, _path string, _rule_text string, _found string"
    )
    return swept.select(
        F.col("_row").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_rule_text").alias("rule"), F.coalesce("_found", F.lit(default)).alias("verdict"),
    )
