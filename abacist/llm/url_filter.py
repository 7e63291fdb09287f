"""URL filters: rules first, then gradient-boosted trees on lexical features.

A rule is a host with a path prefix; it fits the host and its subdomains, and of those that fit the
longest decides. Where none fits, boosted trees judge the address by its length, depth, digits,
entropy, parameters and the record of its host's endings, all of which the trees and the endings'
statistics have learned from labelled addresses. Features and judgement are DataFrame functions and
Spark's own tree model; rules are a short list and become one expression.

The endings' statistics are counted over all different labelled addresses; the trees are fitted to a
bounded sample, about ``most`` of them, chosen by a hash. A null address, or
one without ``://``, has an empty host and path, fits no rule and is judged by its features as they
are. Without labels of both kinds the verdict is that of the only kind, ``allow`` if there is none.
Repeated rows are each judged; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def with_parts(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Add host and path; both empty where the address is null or has no ``://``."""
    url = F.col(url_col)
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return urls.withColumns({"host": F.translate(host, UPPER, LOWER), "path": path})


def rule_of(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # the last one tried is the longest
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def entropy(text: Column) -> Column:
    """Bits per character."""

    def part(total: Column, char: Column) -> Column:
        share = (F.length(text) - F.length(F.replace(text, char, F.lit("")))) / F.length(text)
        return total - share * F.log2(share)

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), part)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the address alone."""
    url = F.coalesce(url, F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    return {
        "f_length": F.length(url),
        "f_host": F.length(host),
        "f_path": F.length(path),
        "f_depth": _count(path, "/"),
        "f_labels": _count(host, "[.]"),
        "f_digits": _count(url, "[0-9]") / size,
        "f_signs": _count(url, "[^0-9A-Za-z]") / size,
        "f_entropy": F.when(F.length(url) > 0, entropy(url)).otherwise(0.0),
        "f_parameters": _count(F.regexp_extract(url, r"\?([^#]*)", 1), "=") + _count(url, "#"),
        "f_secure": F.lower(url).startswith("https:").cast("int"),
    }


SUFFIXES = {"s1": 1, "s2": 2}


def _ends() -> dict[str, Column]:
    """The host's last one and two labels."""
    return {k: F.substring_index("host", ".", -n) for k, n in SUFFIXES.items()}


def _features(urls: DataFrame) -> DataFrame:
    """Lexical features and the host's endings."""
    return urls.withColumns({**lexical(F.col("url"), F.col("host"), F.col("path")), **_ends()})


def _with_records(rows: DataFrame, records: dict[str, DataFrame]) -> DataFrame:
    """Add what is known of the host's endings; unknown ones have the record of none."""
    for name, record in records.items():
        rows = rows.join(record, name, "left")  # as many rows as labelled endings: no hint
        rows = rows.fillna({f"f_{name}_rate": 0.5, f"f_{name}_known": 0.0})
    return rows


def judge(
    urls: DataFrame,
    labelled: DataFrame,
    rules: list[Rule],
    most: int = 20_000,
    trees: int = 12,
    depth: int = 3,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per row of ``urls``: the id, url, host, path, rule, verdict.

    ``labelled`` has the address (``url``) and ``label``: 1 for block, 0 for allow.
    """
    rows = with_parts(urls.select(id_col, F.col(url_col).alias("url")))
    text, verdict = rule_of(rules, F.col("host"), F.col("path"))
    rows = rows.withColumns({"rule": text, "__verdict": verdict})
    kept = [id_col, "url", "host", "path", "rule"]

    known = labelled.select("url", F.col("label").cast("double").alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("url").isNotNull()).distinct()
    n = known.count()
    share = (1 << 20) if n <= most else (most << 20) // n
    sides = [r[0] for r in known.select("label").distinct().collect()]
    if len(sides) < 2:
        only = F.lit("block" if sides == [1.0] else "allow")
        return rows.select(*kept, F.coalesce("__verdict", only).alias("verdict"))

    ends = with_parts(known).select("label", *(e.alias(name) for name, e in _ends().items()))
    records = {}
    for name in SUFFIXES:
        seen = ends.groupBy(name).agg(F.sum("label").alias("bad"), F.count("*").alias("all"))
        rate = (F.col("bad") + 1) / (F.col("all") + 2)
        records[name] = seen.select(name, rate.alias(f"f_{name}_rate"), F.log1p("all").alias(f"f_{name}_known"))
    sample = known.where(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < share)
    if sample.select("label").distinct().count() < 2:  # the trees need both kinds: some of either, by hash
        sample = known.where("label = 1").orderBy(F.xxhash64("url")).limit(most // 2 + 1)
        sample = sample.union(known.where("label <> 1").orderBy(F.xxhash64("url")).limit(most // 2 + 1))
    known = _with_records(_features(with_parts(sample)), records)
    inputs = [c for c in known.columns if c.startswith("f_")]
    vector = VectorAssembler(inputCols=inputs, outputCol="__features")
    model = GBTClassifier(
        featuresCol="__features", labelCol="label", predictionCol="__bad", maxIter=trees, maxDepth=depth, seed=7
    ).fit(vector.transform(known).select("__features", "label"))
    judged = model.transform(vector.transform(_with_records(_features(rows), records)))
    by_trees = F.when(F.col("__bad") > 0, "block").otherwise("allow")
    return judged.select(*kept, F.coalesce("__verdict", by_trees).alias("verdict"))


def rule_labels(urls: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """Labelled addresses from the rules: what a rule decides is a label for the rest."""
    rows = with_parts(urls.select(F.col(url_col).alias("url")))
    _, verdict = rule_of(rules, F.col("host"), F.col("path"))
    label = F.when(verdict == "block", 1.0).when(verdict == "allow", 0.0)
    return rows.select("url", label.alias("label")).where("label IS NOT NULL")
