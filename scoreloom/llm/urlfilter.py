"""URL filtering by rules, and by the words that host and path are made of.

Names such as ``cheappills`` are split by a unigram Viterbi search over all words of the pages
themselves: the parts of every distinct name meet the whole count table in a join, so no task and
not the driver holds a lexicon. Multinomial naive Bayes then weighs the words of host and path. Its examples are the
pages whose words include a seed word; words that keep company with them get weight of
their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.staging import stage
from scoreloom.llm.common import col

#: Words that ``learn_lexicon`` collects at most, the most frequent ones; ``judge`` counts on all words.
LEXICON = 50_000
WORD_LETTERS = (2, 20)
#: Levels of frequency for each doubling of a word's count.
LEVELS = 64
#: Seed words count as if seen so often, so that they can be split off.
SEED_COUNT = 1000
SLOTS = 1 << 16
SMOOTHING = 0.5
#: Log odds of block before any word is seen: even, as the examples are no fair sample of the web.
PRIOR = 0.0
#: Names with more than this share of all occurrences, so 1,000 at most, are split beside the tasks' rows.
OFTEN = 0.001
BLOCK, ALLOW = "block", "allow"

# The rules of the contract, as (verdict, host, path).
RULES = ((BLOCK, "net", "/"), (ALLOW, "example.net", "/en/"), (BLOCK, "example.com", "/de/"), (ALLOW, "org", "/fr/"))
# Words that mark a page as one to block or to allow.
BLOCK_SEEDS = ("casino poker bets betting jackpot slots lottery gambling pills pharma viagra cialis spam ads adserver "
               "track tracker clickbait porn xxx adult escort sex nude hookup crack warez torrent keygen malware "
               "phishing scam cheap loans payday replica counterfeit").split()
ALLOW_SEEDS = ("news blog docs wiki library university school science research museum journal health weather sports "
               "recipes travel history forum support help developer education government music books art garden "
               "kitchen family community city local").split()

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null if none fits.

    A rule fits its host and all subdomains when the path starts with the rule's. Of rules of one
    length the first listed wins.
    """
    rule, verdict = [], []
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule.append(F.when(fits, F.lit(h + p)))
        verdict.append(F.when(fits, F.lit(v)))
    none = F.lit(None).cast("string")
    return F.coalesce(*rule, none), F.coalesce(*verdict, none)


@dataclass
class Lexicon:
    """Costs of known words, and what an unknown word costs by its length."""

    costs: dict[str, float]
    total: float

    @classmethod
    def of(cls, counts: dict[str, int], total: float | None = None) -> Lexicon:
        """Costs of the given words; ``total`` is the count of all words if these are a part."""
        total = float(sum(counts.values()) if total is None else total) or 1.0
        return cls({w: float(np.log(total / n)) for w, n in counts.items()}, total)

    def split(self, name: str) -> list[str]:
        """The cheapest cut of a run of letters into words; an unknown word gets ten times rarer per letter."""
        best, back = [0.0], [0]
        longest = WORD_LETTERS[1]
        rare = np.log(self.total) - np.log(0.1)
        for end in range(1, len(name) + 1):
            choices = []
            for start in range(max(0, end - longest), end):
                size = end - start
                cost = self.costs.get(name[start:end]) if size >= WORD_LETTERS[0] else None
                choices.append((best[start] + (rare + 2.302585 * size if cost is None else cost), start))
            cost, start = min(choices)
            best.append(cost)
            back.append(start)
        out, end = [], len(name)
        while end:
            out.append(name[back[end]:end])
            end = back[end]
        return out[::-1]


def word_counts(pages: DataFrame, html_col: str, seeds: Sequence[str] = ()) -> DataFrame:
    """``(w, n)``: how often each word is in the page texts, seed words ``SEED_COUNT`` times more; staged."""
    least, most = WORD_LETTERS
    words = (pages.select(F.explode(F.split(F.lower(col(html_col).cast("string")), r"(?s)<[^>]*>|[^\p{L}]+")).alias("w"))
             .where(F.length("w").between(least, most)).select("w", F.lit(1).cast("long").alias("n")))
    if seeds:
        words = words.unionByName(pages.sparkSession.createDataFrame([(w, SEED_COUNT) for w in seeds], "w string, n long"))
    return stage(words.groupBy("w").agg(F.sum("n").alias("n")), "lexicon")


def learn_lexicon(pages: DataFrame, html_col: str, seeds: Sequence[str], size: int = LEXICON) -> Lexicon:
    """A lexicon of bounded size: the most frequent words of all page texts, at most ``size``, and the seed words.

    Words are taken by whole levels of frequency, the highest first; the first level that would go
    beyond ``size`` and all below it stay out. So the driver gets the levels and the chosen words, at any
    number of partitions.
    """
    level = F.floor(F.log2("n") * LEVELS).cast("int")
    counted = word_counts(pages, html_col)
    held, lowest = 0, None
    for r in sorted(counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        held += r["n"]
        if held > size:
            break
        lowest = r["level"]
    chosen = counted.where(level >= lowest).collect() if lowest is not None else []
    counts = {r["w"]: r["n"] for r in chosen}
    for seed in seeds:
        counts[seed] = counts.get(seed, 0) + SEED_COUNT
    return Lexicon.of(counts)


_LETTERS = re.compile(r"[^\W\d_]+")


def _names(host: Column, path: Column) -> Column:
    """The runs of letters of host and path, in order."""
    @F.pandas_udf("array<string>")
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            yield pd.Series([_LETTERS.findall(h) + _LETTERS.findall(p.lower()) for h, p in zip(hosts, paths)], dtype=object)

    return found(host, path)


def _parts(name: Column) -> Column:
    """The different parts of a name that have a word's length."""
    least, most = WORD_LETTERS

    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for names in batches:
            yield pd.Series([list({n[i:i + size] for size in range(least, most + 1) for i in range(len(n) - size + 1)})
                             for n in names], dtype=object)

    return found(name)


def split_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """Distinct names (column ``name``) with their cheapest cut ``parts`` under all words of ``counts (w, n)``.

    A name meets each word that it holds by a join, at most 19 for each of its letters, so the search
    over these is the search over the whole table.
    """
    total = float(counts.agg(F.sum("n")).first()[0] or 0)
    none = F.lit(None).cast("struct<w:string,n:bigint>")
    held = names.select("name", F.explode(_parts(F.col("name"))).alias("w")).join(counts, "w").select(
        "name", F.struct("w", "n").alias("m"))
    # the null keeps names that hold no word, and is not listed
    held = held.unionByName(names.select("name", none.alias("m"))).groupBy("name").agg(F.collect_list("m").alias("m"))

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([Lexicon.of(dict(zip(words, ns)), total).split(name) for name, words, ns in zip(*batch)],
                            dtype=object)

    return held.select("name", cut("name", F.col("m.w"), F.col("m.n")).alias("parts"))


def with_words(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with ``words``, those of ``host`` and ``path`` in order, repeats kept; every distinct name is cut once."""
    kept = rows.columns
    rows = stage(rows.withColumn("__names", _names(F.col("host"), F.col("path"))).withColumn("__row", F.monotonically_increasing_id()),
                 "names")
    placed = rows.select("__row", F.posexplode("__names").alias("at", "name"))
    names = stage(placed.groupBy("name").agg(F.count(F.lit(1)).alias("times")), "distinct")
    least = OFTEN * (names.agg(F.sum("times")).first()[0] or 0)
    cuts = stage(split_names(names.select("name"), counts).join(names, "name"), "cuts")
    # names such as com are in most urls: at most 1 / OFTEN of them go to the rows, the rows go to the others
    common = placed.join(F.broadcast(cuts.where(F.col("times") > least).select("name", "parts")), "name", "left")
    rare = (common.where("parts is null").drop("parts")
            .join(cuts.where(F.col("times") <= least).select("name", "parts"), "name"))
    words = (common.where("parts is not null").unionByName(rare).groupBy("__row")
             .agg(F.array_sort(F.collect_list(F.struct("at", "parts"))).alias("p"))
             .select("__row", F.flatten("p.parts").alias("words")))
    return (rows.join(words, "__row", "left")
            .select(*kept, F.coalesce("words", F.array().cast("array<string>")).alias("words")))


def bayes_weights(counted, slots: int = SLOTS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log odds of block per slot from (slot, block count, allow count) rows, smoothed."""
    block, allow = np.full(slots, smoothing), np.full(slots, smoothing)
    for slot, b, a in counted:
        block[slot] += b
        allow[slot] += a
    return np.log(block / block.sum()) - np.log(allow / allow.sum())


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          rules: Sequence[tuple[str, str, str]] = RULES, block_seeds: Sequence[str] = tuple(BLOCK_SEEDS),
          allow_seeds: Sequence[str] = tuple(ALLOW_SEEDS)) -> DataFrame:
    """``page_id, host, path, rule, verdict, words, score`` of every url.

    The verdict is the longest fitting rule's, else block when the log odds are over zero. A null url or
    one without ``://`` has empty host and path and no words; the prior alone allows it. Repeated
    rows and null ids are judged each by itself. An empty table gives an empty one; further columns
    are ignored. A word in a third of all urls is summed in every task before it is shuffled.
    """
    counts = word_counts(pages, html_col, [*block_seeds, *allow_seeds])
    rows = pages.select(col(id_col).alias("page_id"), host_of(col(url_col).cast("string")).alias("host"),
                        path_of(col(url_col).cast("string")).alias("path"))
    rows = stage(with_words(rows, counts), "urls")
    bad = F.arrays_overlap("words", F.array(*map(F.lit, block_seeds)))
    good = F.arrays_overlap("words", F.array(*map(F.lit, allow_seeds)))
    examples = rows.where(bad | good).select("words", bad.cast("int").alias("block"))
    def slot(word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int")

    counted = examples.select("block", F.explode("words").alias("w")).groupBy(slot(F.col("w")).alias("slot")).agg(
        F.sum("block").alias("b"), F.sum(1 - F.col("block")).alias("a")).collect()
    seeds = pages.sparkSession.createDataFrame(
        [(w, 1, 0) for w in block_seeds] + [(w, 0, 1) for w in allow_seeds], "w string, b int, a int").select(
        slot(F.col("w")).alias("slot"), "b", "a").collect()
    weights = bayes_weights([tuple(r) for r in counted + seeds])
    @F.pandas_udf("double")
    def odds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([PRIOR + float(weights[np.asarray(s, np.int64)].sum()) for s in batch])

    rows = rows.withColumn("score", odds(F.transform("words", slot)))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, F.when(F.col("score") > 0, BLOCK).otherwise(ALLOW)).alias("verdict"),
                       "words", "score")
