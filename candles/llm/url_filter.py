"""URL filtering by a sorted sweep over reversed-host keys.

A rule is a host and a path prefix; it fits its host and all subdomains. With the host's labels
reversed, `com.example/` + `/es/` is a key of which every fitting place, seen from that host, is an
extension: the rule is an interval of the sorted keys. A place (host, path) is therefore looked up
once for each of its parent hosts. Many hosts share a key (`com/` + `/` is that of every root page below com), so
each key is judged once, and its rule goes back to the places by a join. Keys and rules are cut into the same ranges, a rule goes to each
range that its interval touches, and a sweep over the sorted range keeps a stack of the rules that
are still open; they are nested, so the top is the longest.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candles.llm.common import arrow_map, pa_schema, record, session_of, stored

#: Keys looked at for each cut between ranges; they decide the balance of the ranges, nothing else.
LOOKS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first :// to the next / ? # or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? or # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _reversed(labels: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"))


def judge(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow",
) -> DataFrame:
    """(key, host, path, rule, verdict) per row of `pages`.

    `rules` has action (allow or block), host and path. The rule with the longest host wins, then
    the longest path; of equal rules a block. A page without a rule has rule null and verdict
    `default`; a null url or one without :// has an empty host and path, which only a rule with an
    empty host fits. Rules with nulls are no rules. Any number of pages may share a url, and repeated
    rows come back as often as they came in.
    """
    session_of(pages)
    judged = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    places = judged.select("host", "path").distinct()
    best = stored(_best(places, rules), "url-rules")
    return judged.join(best, ["host", "path"], "left").select(
        key, "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


def _best(places: DataFrame, rules: DataFrame) -> DataFrame:
    labels = F.split("host", r"\.")
    probes = places.select(
        "host", "path", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("depth"))
    probes = probes.select(
        F.concat(_reversed(F.slice(labels, F.size(labels) - F.col("depth") + 1, F.col("depth"))), F.col("path")).alias("key"), "host", "path")
    keys_ = stored(probes.select("key").distinct(), "url-keys")
    none = F.lit(None).cast("string")
    asked = keys_.select("key", F.lit(1).alias("kind"), none.alias("host"), none.alias("path"), none.alias("action"))
    ruled = rules.where("action is not null and host is not null and path is not null").select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", "action")
    ruled = ruled.groupBy("host", "path").agg(F.max("action").alias("action")).select(
        F.concat(_reversed(labels), F.col("path")).alias("key"), F.lit(0).alias("kind"), "host", "path", "action")

    ranges = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = max(keys_.count(), 1)
    looks = keys_.sample(min(1.0, LOOKS * ranges / rows), seed=7).orderBy("key")
    keys = [row.key for row in looks.limit(2 * LOOKS * ranges).collect()]
    cuts = sorted(set(keys[len(keys) * i // ranges] for i in range(1, ranges) if keys))

    def placed(columns: dict) -> Iterable[dict]:
        begins = [bisect.bisect_right(cuts, k) for k in columns["key"].to_pylist()]
        last = [bisect.bisect_right(cuts, k + chr(0x10FFFF)) if kind == 0 else b for k, kind, b in zip(
            columns["key"].to_pylist(), columns["kind"].to_pylist(), begins)]
        rows = pa.array([i for i, (a, b) in enumerate(zip(begins, last)) for _ in range(a, b + 1)], pa.int64())
        yield {"range": [r for a, b in zip(begins, last) for r in range(a, b + 1)]} | {
            name: column.take(rows) for name, column in columns.items()}

    schema = "range int, key string, kind int, host string, path string, action string"
    both = arrow_map(asked.union(ruled), placed, schema)
    both = both.repartition("range").sortWithinPartitions("range", "key", "kind")
    out = "key string, rule string, action string, host_length int, path_length int"
    types = pa_schema(places.sparkSession, out)

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple] = []
        inside = None
        for batch in batches:
            made: dict[str, list] = {name: [] for name in types.names}
            for at, k, kind, host, path, action in zip(*(c.to_pylist() for c in batch.columns)):
                if at != inside:
                    inside, stack = at, []
                while stack and not k.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((k, host, path, action))
                elif stack:
                    _, rule_host, rule_path, verdict = stack[-1]
                    for name, value in zip(types.names, (
                            k, rule_host + rule_path, verdict, len(rule_host), len(rule_path))):
                        made[name].append(value)
            if made["key"]:
                yield record(made, types)

    fits = both.mapInArrow(sweep, out)
    return probes.join(fits, "key").groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "action"), F.struct("host_length", "path_length")).alias("top")
    ).select("host", "path", "top.rule", "top.action")
