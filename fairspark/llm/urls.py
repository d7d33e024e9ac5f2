"""URL rules: a trie over reversed host labels and path segments decides allow or block.

A rule ``(host, path)`` fits its host and all subdomains when the url's path starts with the
rule's path.  Of the rules that fit, the longest wins: more host labels and path characters taken
together; on a tie the longer host, then block before allow.  A url that no rule fits gets the
default verdict and a null rule.

Defined results: a null url, or one without ``://``, has an empty host and path (no rule fits, since
hosts of rules are not empty); an empty path does not start with ``/``; repeated rows are judged
one by one; extra columns are kept, and those named as a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import table

#: fixed values: the rules of the query, as (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: Characters of rules that may be sent to every task as a trie; more rules are joined instead.
MAX_TRIE_CHARS = 4_000_000

HOST = r"^[\s\S]*?://([^/?#]*)"
PATH = r"^[\s\S]*?://[^/?#]*([^?#]*)"


def host_of(url):
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


class UrlTrie:
    """Host labels from the right, then path segments; a node's ``ends`` are the rules that end in it.

    A rule's path is cut at its slashes.  Its last piece may be a part of a segment, so it is kept
    at the node of the whole segments before it and compared as a prefix of the next one.
    """

    __slots__ = ("labels", "segments", "ends")

    def __init__(self):
        self.labels: dict[str, UrlTrie] = {}
        self.segments: dict[str, UrlTrie] = {}
        self.ends: list[tuple[str, str, str]] = []  # rest of the path, rule, verdict

    @classmethod
    def of(cls, rules: Iterable[tuple[str, str, str]]) -> UrlTrie:
        root = cls()
        for host, path, verdict in rules:
            node = root
            for label in reversed(host.split(".")):
                node = node.labels.setdefault(label, cls())
            *whole, rest = path.split("/")
            for segment in whole:
                node = node.segments.setdefault(segment, cls())
            node.ends.append((rest, host + path, verdict))
        return root

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """The winning ``(rule, verdict)``."""
        best = None
        pieces = path.split("/")
        node, depth = self, 0
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            depth += 1
            at = node
            for piece in pieces:
                for rest, rule, verdict in at.ends:
                    if piece.startswith(rest):
                        key = (len(rule), depth, verdict == "block")
                        if best is None or key > best[0]:
                            best = key, rule, verdict
                at = at.segments.get(piece)
                if at is None:
                    break
        return best and best[1:]


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
               max_trie_chars: int = MAX_TRIE_CHARS) -> DataFrame:
    """``df`` with ``host, path, rule, verdict``; ``rules`` has the columns ``host, path, verdict``.

    Rules of up to ``max_trie_chars`` characters go to the tasks as one trie.  More are joined on
    the host's suffixes, which are rows per url and bounded by its labels: the same answer without
    a broadcast.
    """
    out = df.drop("host", "path", "rule", "verdict").withColumns(
        {"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    chars = rules.agg(F.sum(F.length("host") + F.length("path") + 16)).head()[0] or 0
    if chars > max_trie_chars:
        return _judge_by_join(out, rules, default)
    trie = UrlTrie.of(sorted((r["host"], r["path"], r["verdict"]) for r in rules.collect()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts = b.column(b.schema.get_field_index("host")).to_pylist()
            paths = b.column(b.schema.get_field_index("path")).to_pylist()
            found = [trie.match(h, p) or (None, default) for h, p in zip(hosts, paths)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string())],
                names=[*b.schema.names, "rule", "verdict"])

    schema = T.StructType([*out.schema.fields, T.StructField("rule", T.StringType()),
                           T.StructField("verdict", T.StringType())])
    return out.mapInArrow(run, schema)


def _judge_by_join(df: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    row = df.withColumn("_row", F.monotonically_increasing_id())
    labels = F.split("host", r"\.")
    suffixes = row.select("_row", "path", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("_suffix"))
    r = rules.select(F.col("host").alias("_suffix"), F.col("path").alias("_path"),
                     F.col("verdict").alias("_verdict"))
    rule = F.concat("_suffix", "_path")
    best = (suffixes.join(r, "_suffix").filter(F.expr("startswith(path, _path)"))
            .groupBy("_row").agg(F.max(F.struct(
                F.length(rule), F.size(F.split("_suffix", r"\.")), F.col("_verdict") == "block",
                rule.alias("rule"), F.col("_verdict").alias("verdict"))).alias("_b")))
    return (row.join(best, "_row", "left")
            .withColumns({"rule": F.col("_b.rule"), "verdict": F.coalesce("_b.verdict", F.lit(default))})
            .drop("_row", "_b"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = """
WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), m AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
      THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/')
      THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
  END AS rule FROM p
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM m
"""
