"""URL filter: a sorted array of 64-bit digests, probed by binary search.

The rule list is one file: the sorted xxhash64 digests of the rules, the
offsets of their strings, and the strings. Spark ships the file to every
executor, tasks memory-map it (pages in use are shared by all tasks of a
machine), look up all candidate keys of a batch with one vectorised binary
search and compare the stored string of each hit, so that digest collisions
cannot decide anything.

Edge cases: a null url, or one without ``://``, has an empty host and path and
gets the default verdict; a host is compared after A-Z are lower-cased; a rule
fits its own host and all subdomains when the url's path starts with the
rule's path; the longest rule (host plus path) wins, of equally long ones the
one with the longer host; of two rules with the same host and path ``allow``
wins. Other columns are kept; columns named like the results are replaced.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_LIST_BYTES = 32 << 20
_TO_LOWER = str.maketrans(UPPER, LOWER)


def host_column(url):
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_column(url):
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def write_digest_file(rules: list[tuple[str, str, str]], path: str) -> None:
    """``rules``: (host, path, verdict). Layout: count and number of path
    lengths, path lengths, sorted digests, string offsets, strings."""
    held = {}
    for host, prefix, verdict in rules:
        if not host or verdict not in ("allow", "block"):
            raise ValueError(f"a rule needs a host and a verdict of allow or block: {(host, prefix, verdict)}")
        key = (host.translate(_TO_LOWER), prefix or "")
        held[key] = min(verdict, held.get(key, verdict))
    entries = sorted((xxhash.xxh64_intdigest(_key(*k)), _key(*k) + b"\0" + v.encode()) for k, v in held.items())
    lengths = sorted({len(p) for _, p in held})
    blob = b"".join(s for _, s in entries)
    offsets = np.zeros(len(entries) + 1, np.int64)
    np.cumsum([len(s) for _, s in entries], out=offsets[1:]) if entries else None
    with open(path, "wb") as out:
        out.write(np.array([len(entries), len(lengths), *lengths], np.int64).tobytes())
        out.write(np.array([d for d, _ in entries], np.uint64).tobytes())
        out.write(offsets.tobytes())
        out.write(blob)


def _key(host: str, path: str) -> bytes:
    return host.encode("utf-8", "surrogatepass") + b"\0" + path.encode("utf-8", "surrogatepass")


class DigestFile:
    """A memory-mapped rule list."""

    def __init__(self, path: str):
        head = np.fromfile(path, np.int64, 2)
        n, m = int(head[0]), int(head[1])
        self.path_lengths = np.fromfile(path, np.int64, m, offset=16).tolist()
        at = 8 * (2 + m)
        size = os.path.getsize(path)
        self.digests = np.memmap(path, np.uint64, "r", at, (n,)) if n else np.zeros(0, np.uint64)
        self.offsets = np.memmap(path, np.int64, "r", at + 8 * n, (n + 1,))
        rest = size - at - 8 * n - 8 * (n + 1)
        self.strings = np.memmap(path, np.uint8, "r", size - rest, (rest,)) if rest else np.zeros(0, np.uint8)

    def verdicts(self, keys: list[bytes]) -> list[str | None]:
        """The verdict stored for each key, or None."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        left, right = np.searchsorted(self.digests, digests, "left"), np.searchsorted(self.digests, digests, "right")
        out: list[str | None] = [None] * len(keys)
        for i in np.flatnonzero(right > left):
            for j in range(left[i], right[i]):  # more than one only where digests collide
                stored = self.strings[self.offsets[j] : self.offsets[j + 1]].tobytes()
                text, _, verdict = stored.rpartition(b"\0")
                if text == keys[i]:
                    out[i] = verdict.decode()
        return out

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None]]:
        """(rule, verdict) of each url, (None, None) where no rule fits."""
        wanted: dict[tuple[str, str], int] = {}
        tried = []
        for host, path in zip(hosts, paths, strict=True):
            own, at = [], 0
            while host and at >= 0:
                suffix = host[at:]
                own += [wanted.setdefault((suffix, path[:n]), len(wanted)) for n in self.path_lengths if n <= len(path)]
                at = host.find(".", at) + 1 or -1
            tried.append(own)
        names = list(wanted)
        found = self.verdicts([_key(*k) for k in names])
        out = []
        for own in tried:
            hits = [names[i] for i in own if found[i]]
            best = max(hits, key=lambda k: (len(k[0]) + len(k[1]), len(k[0])), default=None)
            out.append((best[0] + best[1], found[wanted[best]]) if best else (None, None))
        return out


_OPEN: dict[str, DigestFile] = {}


def _checked(rules: DataFrame) -> DataFrame:
    """``rules``, if each has a host and a verdict of allow or block."""
    fine = (F.coalesce("host", F.lit("")) != "") & F.coalesce(F.col("verdict").isin("allow", "block"), F.lit(False))
    wrong = rules.where(~fine).select("host", "path", "verdict").first()
    if wrong is not None:
        raise ValueError(f"a rule needs a host and a verdict of allow or block: {tuple(wrong)}")
    return rules


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", max_list_bytes: int = MAX_LIST_BYTES) -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``rules``: host, path, verdict.

    The rule list is read by the driver and shipped to every executor, so its
    size is measured first. A list over ``max_list_bytes`` is not shipped:
    the keys of the urls then meet the rules in a shuffled equi-join with the
    same result (:func:`filter_urls_joined`). Hosts of rules are lower-cased in
    A-Z, like those of urls; a rule without a host, or with another verdict than
    allow or block, raises ``ValueError`` either way."""
    spark, rules = pages.sparkSession, _checked(rules)
    size = rules.agg(F.sum(F.octet_length("host") + F.coalesce(F.octet_length("path"), F.lit(0)) + 30)).first()[0] or 0
    if size > max_list_bytes:
        return filter_urls_joined(pages, rules, url, default)
    path = os.path.join(tempfile.mkdtemp(prefix="rules-"), name := f"rules-{uuid.uuid4().hex}.digests")
    listed = rules.select("host", "path", "verdict").toArrow()  # of the size measured above
    write_digest_file(list(zip(*(c.to_pylist() for c in listed.columns), strict=True)), path)
    spark.sparkContext.addFile(path)

    @F.pandas_udf("struct<rule:string,verdict:string>")
    def judged(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        if name not in _OPEN:
            _OPEN.clear()
            _OPEN[name] = DigestFile(SparkFiles.get(name))
        for host, prefix in parts:
            yield pd.DataFrame(_OPEN[name].judge(host.tolist(), prefix.tolist()), columns=["rule", "verdict"])

    placed = pages.withColumns({"host": host_column(F.col(url)), "path": path_column(F.col(url))})
    out = placed.withColumn("__judged", judged.asNondeterministic()("host", "path"))
    return out.withColumns({"rule": F.col("__judged.rule"), "verdict": F.coalesce("__judged.verdict", F.lit(default))}).drop("__judged")


def filter_urls_joined(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The same judgement for lists too large to ship: the distinct (host,
    path) of the urls are expanded to candidate keys and joined with the rules.
    Needs the distinct path lengths only, of which there are few."""
    rules = _checked(rules).select(F.translate("host", UPPER, LOWER).alias("__h"), F.coalesce("path", F.lit("")).alias("__p"), F.col("verdict").alias("__v"))
    rules = rules.groupBy("__h", "__p").agg(F.min("__v").alias("__v"))
    lengths = F.array_distinct(F.array(*[F.lit(r[0]) for r in rules.select(F.length("__p")).distinct().collect()]).cast("array<int>"))
    placed = pages.withColumns({"host": host_column(F.col(url)), "path": path_column(F.col(url))})
    places = placed.select("host", "path").distinct()
    labels = F.split("host", "[.]")
    keys = places.withColumn("__i", F.explode(F.sequence(F.lit(1), F.size(labels)))).withColumn("__n", F.explode(lengths))
    keys = keys.where(F.col("__n") <= F.length("path")).select(
        "host", "path", F.array_join(F.slice(labels, F.col("__i"), F.size(labels)), ".").alias("__h"), F.substring("path", F.lit(1), F.col("__n")).alias("__p")
    )
    order = F.struct(F.length("__h") + F.length("__p"), F.length("__h"), "__h", "__p", "__v")
    best = keys.join(rules, ["__h", "__p"]).groupBy("host", "path").agg(F.max(order).alias("__best"))
    out = placed.join(best, ["host", "path"], "left").withColumns({"rule": F.concat("__best.__h", "__best.__p"), "verdict": F.coalesce("__best.__v", F.lit(default))})
    return out.drop("__best")
