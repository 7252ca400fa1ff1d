"""Operator 5: URL filter by host word segmentation and naive Bayes.

Names in hosts are split into words by a unigram model and the Viterbi algorithm, over word counts of
all page texts and the parts of hyphenated host names. A multinomial naive Bayes model over the words of host and path, hashed into a fixed
number of buckets, then judges a URL. It is trained on the URLs themselves: those whose host has a seed
word are examples to block, all others to allow. Explicit rules go before the model.

No dictionary is sent anywhere: each distinct name is joined with the counts of its own substrings, of
which a name of 63 letters has fewer than two thousand. The model is as long as its buckets are many.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.llm.rows import sliced
from ordertide.session import settle

#: Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Words that mark a host as an example to block.
SEEDS = tuple("spam casino porn xxx viagra pills bets betting gambling poker lottery malware phishing warez torrent ads tracker".split())
LONGEST_WORD = 24
BUCKETS = 1 << 18
HELD_WORDS = 200_000

_TAG = re.compile(r"<(script|style)\b.*?(?:</\1\s*>|$)|<!--.*?(?:-->|$)|<[^>]*>", re.S | re.I)


def url_parts(url):
    """(host, path) as columns: what follows the first ``://`` up to ``/``, ``?`` or ``#``, then up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(u, instr(u, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_column(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits, as columns; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """word, n of all runs of letters a-z in the texts of ``pages``, markup left out."""
    taken = pages.select(pages[html_col].cast("string").alias("text")).filter("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in sliced(batches, "text", 1_000_000):
            for html in batch.column(0).to_pylist():
                plain = _TAG.sub(" ", html).lower()
                held.update(w for w in re.findall(r"[a-z]+", plain) if len(w) <= LONGEST_WORD)
            if len(held) > HELD_WORDS:
                yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())})
                held = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    return taken.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def split_name(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words that make up ``name``; unknown words cost a tenth for each letter."""
    n, log_total = len(name), math.log(max(total, 1))
    best, cut = [0.0] + [-math.inf] * n, [0] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            word = name[start:end]
            seen = counts.get(word)
            cost = math.log(seen) - log_total if seen else -log_total - len(word) * math.log(10)
            if best[start] + cost > best[end]:
                best[end], cut[end] = best[start] + cost, start
    words, end = [], n
    while end:
        words.append(name[cut[end] : end])
        end = cut[end]
    return words[::-1]


def segmented_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """name, words for each distinct row of ``names``."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    places = F.sequence(F.lit(1), F.length("name"))
    widths = F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("name") - F.col("at") + 1))
    pieces = names.withColumn("at", F.explode(places)).withColumn("wide", F.explode(widths))
    pieces = pieces.select("name", F.expr("substring(name, at, wide)").alias("word")).distinct()
    known = pieces.join(counts, "word").groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))
    joined = names.join(known, "name", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [split_name(n, dict(k or ()), total) for n, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["name", "words"])

    return joined.select("name", "known").mapInArrow(run, "name string, words array<string>")


def judge_urls(pages: DataFrame, url_col: str = "url", html_col: str = "html", rules=RULES, seeds=SEEDS) -> DataFrame:
    """``row``, host, path, rule, verdict, block_score (log odds to block) for every row of ``pages``.

    A null URL, or one without ``://``, has an empty host and path; no rule fits it and its score is the
    prior alone. Without examples to block, or with no others, nothing is blocked beyond the rules.
    """
    spark = pages.sparkSession
    boxed = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("row"), pages[url_col].cast("string").alias("u"))
    host, path = url_parts(F.col("u"))
    parts = boxed.select("row", host.alias("host"), path.alias("path"))
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    parts = parts.select("row", "host", "path", rule.alias("rule"), verdict.alias("said"))

    hosts = settle(parts.select("host").distinct(), "hosts")
    inner = F.regexp_replace("host", r"(\.[^.]*)$", "")
    names = hosts.select("host", F.explode(F.filter(F.split(inner, "[^a-z]+"), lambda x: x != "")).alias("name"))
    # Parts of hyphenated host names are words by their writers' own split, and so are the seeds.
    parted = parts.select(F.explode(F.split(F.regexp_replace("host", r"\.[^.]*$", ""), r"\.")).alias("label")).filter(F.col("label").contains("-"))
    parted = parted.select(F.explode(F.split("label", "[^a-z]+")).alias("word")).filter("word <> ''")
    sown = spark.createDataFrame([(w, 1) for w in seeds], "word string, n bigint")
    counts = word_counts(pages, html_col).unionByName(parted.groupBy("word").agg(F.count("*").alias("n"))).unionByName(sown)
    counts = settle(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    segments = segmented_names(names.select("name").distinct(), counts)
    words = names.join(segments, "name").groupBy("host").agg(F.flatten(F.collect_list("words")).alias("words"))
    words = settle(hosts.join(words, "host", "left").select(F.col("host").alias("of"), F.coalesce("words", F.array().cast("array<string>")).alias("words")), "host-words")

    path_words = F.filter(F.split(F.regexp_replace(F.lower("path"), "[0-9]+", "0"), "[^a-z0]+"), lambda x: x != "")
    tokens = F.concat(F.transform("words", lambda w: F.concat(F.lit("h:"), w)), F.transform(path_words, lambda w: F.concat(F.lit("p:"), w)))
    rows = parts.join(words, F.col("host") == F.col("of"))
    seeded = F.arrays_overlap("words", F.array(*map(F.lit, seeds)))
    buckets = F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int"))
    rows = rows.select("row", "host", "path", "rule", "said", seeded.alias("seeded"), buckets.alias("buckets"))

    classes = {r["seeded"]: r["n"] for r in rows.groupBy("seeded").agg(F.count("*").alias("n")).collect()}
    counted = rows.select("seeded", F.explode("buckets").alias("bucket")).groupBy("bucket", "seeded").agg(F.count("*").alias("n"))
    sums = np.zeros((2, BUCKETS))
    for r in counted.toLocalIterator():
        sums[int(r["seeded"]), r["bucket"]] += r["n"]
    # Add-a-half smoothing over the buckets in use; a bucket without examples says nothing.
    used = sums.sum(axis=0) > 0
    sums = np.where(used, sums + 0.5, 0.0)
    shares = np.log(np.where(used, sums, 1.0)) - np.log(np.maximum(sums.sum(axis=1, keepdims=True), 1.0))
    weights = np.where(used, shares[1] - shares[0], 0.0)
    if classes.get(True) and classes.get(False):
        prior = math.log(classes[True] / classes[False])
    else:
        prior, weights = -1.0, np.zeros(BUCKETS)
    sent = spark.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(6)
            lists = lists if isinstance(lists, pa.ListArray) else pa.array(lists.to_pylist(), pa.list_(pa.int32()))
            flat, ends = lists.flatten().to_numpy(False), np.cumsum(lists.value_lengths().fill_null(0).to_numpy(False))
            running = np.append(0.0, np.cumsum(sent.value[flat].astype(np.float64)))
            score = prior + running[ends] - running[np.append(0, ends[:-1])] if len(ends) else np.empty(0)
            model = np.where(score > 0, "block", "allow")
            said = [s or m for s, m in zip(batch.column(4).to_pylist(), model.tolist())]
            columns = [*batch.columns[:4], pa.array(said, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "host", "path", "rule", "verdict", "block_score"])

    fields = T.StructType.fromDDL("host string, path string, rule string, verdict string, block_score double").fields
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *fields]))


def url_report(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    done = judge_urls(pages.select("page_id", "url", "html"))
    return done.select("row.page_id", "host", "path", "rule", "verdict", "block_score")
