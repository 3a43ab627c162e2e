"""Phrase collocations: HAT-trie counting of word sequences in each task, sorted runs merged by prefix.

A task counts phrases in a shallow trie over the ids of its words. The leaves are hash containers, each
of which holds a range of keys; one that is full bursts into two at a word's border, first a border
of the first word, then deeper. When the trie is too large, whole subtrees leave it as sorted runs:
rows of phrases and counts, one row per prefix partition, which Spark deals out and adds up.

Counting goes by length. Words come first; pairs are counted where both words are frequent, longer
phrases where all of their pairs are. What is frequent goes to the tasks as a bit field of fixed
size; a false hit in it costs a row and changes no result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.functions.staging import stage
from scoreloom.llm.common import col

LEAST = 30
LONGEST = 4
TOP = 2000
#: A phrase goes when a longer one around it has this many hundredths of its count.
COVERED = 80
#: Size of the bit fields, in bits.
FIELD_BITS = 1 << 26
#: Bytes of text handled at once, entries of a container, entries of all tries of a task, words of its dictionaries.
CHUNK_BYTES, BURST, HELD, HELD_WORDS = 1_000_000, 1 << 15, 1_500_000, 400_000
#: Prefix partitions of a language at least; beyond, a 16th of the root of the number of words.
DEALS = 1024
#: A prefix with this share of all words has no partition of its own: its phrases are spread over all.
HOT_SHARE = 1000
NO_LANGUAGE = "und"

#: A-Z lower-cased, tab as blank, the marks that end a piece as line feed.
_MAPPED = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else b for b in range(256))
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_RUNS = "lang string, deal int, phrases binary, counts string"


# ------------------------------------------------------------------ the trie of one task

class Container:
    """A hash table from keys (64 bits, never 0) to counts, for many keys at a time."""

    def __init__(self, room: int = 1024):
        self.keys, self.counts, self.size = np.zeros(room, np.uint64), np.zeros(room, np.int64), 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add counts of distinct keys."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            held, self.size = self.items(), 0
            room = 1 << int(2 * (len(held[0]) + len(keys)) + 1023).bit_length()
            self.keys, self.counts = np.zeros(room, np.uint64), np.zeros(room, np.int64)
            self.add(*held)
        place = ((keys * _GOLD) >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)
        while len(keys):
            free = self.keys[place] == 0
            self.keys[place[free]] = keys[free]  # of several for one place the last stays, the others go on
            found = self.keys[place] == keys
            self.size += int(np.count_nonzero(free & found))
            self.counts[place[found]] += counts[found]
            left = ~found
            keys, counts, place = keys[left], counts[left], (place[left] + 1) & (len(self.keys) - 1)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order and their counts."""
        there = np.flatnonzero(self.keys)
        order = there[np.argsort(self.keys[there])]
        return self.keys[order], self.counts[order]


class Trie:
    """Counts of sequences of ``length`` word ids, packed into one key with the first word on top.

    ``lows`` are the least keys of the containers, each the border of a word or of the words up to it.
    """

    def __init__(self, length: int, burst: int = BURST):
        self.length, self.burst, self.bits = length, burst, 64 // length
        self.lows, self.leaves = np.zeros(1, np.uint64), [Container()]

    @property
    def size(self) -> int:
        return sum(leaf.size for leaf in self.leaves)

    def add(self, ids: list[np.ndarray]) -> None:
        """Count sequences given by their first ids, second ids and so on, all below 2 ** bits."""
        keys = ids[0].astype(np.uint64)
        for more in ids[1:]:
            keys = (keys << np.uint64(self.bits)) | more.astype(np.uint64)
        keys, counts = np.unique(keys, return_counts=True)
        cuts = np.append(np.searchsorted(keys, self.lows), len(keys))
        for leaf, a, b in zip(self.leaves, cuts[:-1], cuts[1:]):
            if b > a:
                leaf.add(keys[a:b], counts[a:b])
        while (at := max(range(len(self.leaves)), key=lambda i: self.leaves[i].size)) >= 0 and self._burst(at):
            pass

    def _burst(self, at: int) -> bool:
        """Part a full container at the border of the shortest prefix that parts it; a lone key is never parted."""
        if self.leaves[at].size < self.burst:
            return False
        keys, counts = self.leaves[at].items()
        for depth in range(1, self.length + 1):
            shift = np.uint64(self.bits * (self.length - depth))
            border = np.searchsorted(keys, (keys[len(keys) // 2] >> shift) << shift)
            if border == 0:  # the middle word begins the container: take the next one's border
                border = np.searchsorted(keys >> shift, keys[0] >> shift, side="right")
                if border == len(keys):
                    continue
            low = (keys[border] >> shift) << shift
            halves = []
            for part in (slice(None, border), slice(border, None)):
                halves.append(Container())
                halves[-1].add(keys[part], counts[part])
            self.leaves[at:at + 1] = halves
            self.lows = np.insert(self.lows, at + 1, low)
            return True
        return False

    def take(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Remove whole subtrees, the largest first, until at most ``keep`` entries are left."""
        order, size = np.argsort([-leaf.size for leaf in self.leaves]), self.size
        for at in order:
            if size <= keep:
                break
            leaf, self.leaves[at] = self.leaves[at], Container()
            size -= leaf.size
            if leaf.size:
                yield leaf.items()


# ------------------------------------------------------------------ words and bit fields

def word_hash(lang: str, word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass")))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    value = (first ^ (second >> np.uint64(29))) * _GOLD + second * _MIX
    return (value ^ (value >> np.uint64(32))) * _MIX


def in_field(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes % np.uint64(64 * len(field))
    return (field[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def bit_field(frequent: DataFrame, bits: int = FIELD_BITS) -> np.ndarray:
    """The field of the frequent words or pairs (``lang, phrase``), collected as at most ``bits`` / 64 longs."""
    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            split = [p.encode("utf-8", "surrogatepass").split(b" ") for p in batch["phrase"]]
            hashes = [np.array([word_hash(lang, words[min(i, len(words) - 1)]) for lang, words in zip(batch["lang"], split)],
                               np.uint64) for i in (0, 1)]
            paired = np.array([len(words) > 1 for words in split], bool)
            hashes = np.where(paired, pair_hash(*hashes), hashes[0]) % np.uint64(bits)
            yield pd.DataFrame({"at": (hashes >> np.uint64(6)).astype(np.int64),
                                "bit": (np.uint64(1) << (hashes & np.uint64(63))).view(np.int64)})

    found = (frequent.select("lang", "phrase").mapInPandas(places, "at long, bit long").groupBy("at")
             .agg(F.bit_or("bit").alias("bit")).toPandas())
    field = np.zeros(bits // 64, np.uint64)
    field[found["at"].to_numpy(np.int64)] = found["bit"].to_numpy(np.int64).view(np.uint64)
    return field


class Words:
    """Ids of a language's words in one task, what is known of each, and the ids that a chunk's phrases may begin with."""

    def __init__(self, lang: str, words: np.ndarray | None):
        self.lang, self.field = lang, words
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[b""], self.ids[b"\n"]
        self.hashes, self.frequent = np.zeros(2, np.uint64), np.zeros(2, bool)
        self.before = np.empty(0, np.int64)

    def read(self, text: bytes) -> np.ndarray:
        """The ids of the words and piece ends (1) of mapped text."""
        found = text.replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.ids.__getitem__, found), np.int64, len(found))
        if self.field is not None and len(self.ids) > len(self.hashes):
            names = list(self.ids)[len(self.hashes):]
            hashes = np.array([word_hash(self.lang, w) for w in names], np.uint64)
            self.hashes = np.concatenate([self.hashes, hashes])
            self.frequent = np.concatenate([self.frequent, in_field(self.field, hashes)])
        return ids[ids > 0]


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """The mapped texts with piece ends between them, in parts of about ``size`` bytes that end between words."""
    held, count = [], 0
    for text in texts:
        text, start = text.translate(_MAPPED), 0
        while len(text) - start > size:
            cut = max(text.rfind(b" ", start, start + size), text.rfind(b"\n", start, start + size))
            if cut <= start:
                ends = [e for e in (text.find(b" ", start + size), text.find(b"\n", start + size)) if e >= 0]
                cut = min(ends, default=len(text))
            yield b"\n".join([*held, text[start:cut]])
            held, count, start = [], 0, cut
        held.append(text[start:] + b"\n")
        count += len(text) - start + 2
        if count >= size:
            yield b"\n".join(held)
            held, count = [], 0
    if held:
        yield b"\n".join(held)


# ------------------------------------------------------------------ runs

def _run_rows(lang: str, names: list[bytes], keys: np.ndarray, counts: np.ndarray, length: int, bits: int,
              deals: int, hot: set[bytes]) -> Iterator[tuple]:
    """A sorted run as a row (language, deal, phrases, counts) per prefix partition.

    A phrase is dealt by its first word (a pair) or its first two, or by all of it if that prefix is hot.
    """
    import zlib

    head = 1 if length == 2 else 2
    mask = np.uint64((1 << bits) - 1)
    places = [((keys >> np.uint64(bits * (length - 1 - i))) & mask).astype(np.int64) for i in range(length)]
    suffixes = [names[i] for i in places[head].tolist()]
    if length - head == 2:
        suffixes = [a + b" " + names[i] for a, i in zip(suffixes, places[head + 1].tolist())]
    top = keys >> np.uint64(bits * (length - head))
    starts = np.flatnonzero(np.append(True, top[1:] != top[:-1]))
    ends, numbers = [*starts[1:].tolist(), len(keys)], counts.tolist()
    firsts = [p[starts].tolist() for p in places[:head]]
    dealt: dict[int, tuple[list[bytes], list[int]]] = defaultdict(lambda: ([], []))
    for place, (a, b) in enumerate(zip(starts.tolist(), ends)):
        prefix = b" ".join([names[f[place]] for f in firsts])
        if prefix in hot:
            for suffix, number in zip(suffixes[a:b], numbers[a:b]):
                phrase = prefix + b" " + suffix
                held = dealt[zlib.crc32(phrase) % deals]
                held[0].append(phrase)
                held[1].append(number)
        else:
            held, begin = dealt[zlib.crc32(prefix) % deals], prefix + b" "
            held[0].extend([begin + suffix for suffix in suffixes[a:b]])
            held[1].extend(numbers[a:b])
    yield from _dealt_rows(lang, dealt)


def _dealt_rows(lang: str, dealt: dict[int, tuple[list[bytes], list[int]]]) -> Iterator[tuple]:
    for deal, (phrases, numbers) in dealt.items():
        yield lang, deal, b"\n".join(phrases), ",".join(map(str, numbers))


def _word_rows(lang: str, names: list[bytes], counts: np.ndarray, deals: int) -> Iterator[tuple]:
    """Word counts as the same rows."""
    import zlib

    dealt: dict[int, tuple[list[bytes], list[int]]] = defaultdict(lambda: ([], []))
    for i in np.flatnonzero(counts).tolist():
        held = dealt[zlib.crc32(names[i]) % deals]
        held[0].append(names[i])
        held[1].append(int(counts[i]))
    yield from _dealt_rows(lang, dealt)


def _frames(rows: Iterator[tuple], size: int = 2_000) -> Iterator[pd.DataFrame]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pd.DataFrame(held, columns=["lang", "deal", "phrases", "counts"])
            held = []
    if held:
        yield pd.DataFrame(held, columns=["lang", "deal", "phrases", "counts"])


class Counter:
    """What a task holds of one language: its words, its tries (or word counts), and the words before the next chunk."""

    def __init__(self, lang: str, lengths: tuple[int, ...], words: np.ndarray | None, pairs: np.ndarray | None,
                 hot: dict[str, set[bytes]], deals: int):
        self.lang, self.lengths, self.pairs, self.hot, self.deals = lang, lengths, pairs, hot.get(lang, set()), deals
        self.words, self.counts = Words(lang, words), np.zeros(2, np.int64)
        self.tries = {n: Trie(n) for n in lengths if n > 1}
        # a trie's ids have 64 / length bits; where the dictionary may hold more words, it numbers those it holds
        self.own = {n: [0] for n in self.tries if HELD_WORDS >> (64 // n)}
        self.number = {n: np.zeros(0, np.int64) for n in self.own}

    @property
    def size(self) -> int:
        return sum(t.size for t in self.tries.values())

    def count(self, text: bytes) -> Iterator[tuple]:
        """Count the phrases that end in ``text``; yields runs where a trie's ids are used up."""
        ids = self.words.read(text)
        if 1 in self.lengths:
            self.counts = np.concatenate([self.counts, np.zeros(len(self.words.ids) - len(self.counts), np.int64)])
            self.counts += np.bincount(ids, minlength=len(self.counts))
        if not self.tries:
            return
        before = len(self.words.before)
        ids = np.concatenate([self.words.before, ids])
        self.words.before = ids[-(LONGEST - 1):]
        good = self.words.frequent[ids]
        good = good[:-1] & good[1:]
        if self.pairs is not None:
            at = np.flatnonzero(good)
            good[at] = in_field(self.pairs, pair_hash(self.words.hashes[ids[at]], self.words.hashes[ids[at + 1]]))
        for n in self.tries:
            begin = max(0, before - n + 1)
            fine = good[begin:len(good) - n + 2].copy()
            for i in range(1, n - 1):
                fine &= good[begin + i:len(good) - n + 2 + i]
            at = np.flatnonzero(fine) + begin
            if len(at):
                yield from self._add(n, [ids[at + i] for i in range(n)])

    def _add(self, n: int, phrases: list[np.ndarray]) -> Iterator[tuple]:
        if n not in self.own:
            self.tries[n].add(phrases)
            return
        limit = 1 << self.tries[n].bits
        if len(self.number[n]) < len(self.words.ids):
            self.number[n] = np.concatenate([self.number[n], np.zeros(len(self.words.ids) - len(self.number[n]), np.int64)])
        used = np.unique(np.concatenate(phrases))
        new = used[self.number[n][used] == 0]
        if len(self.own[n]) + len(new) > limit:
            if len(used) >= limit:  # more words at once than ids: in two parts
                half = len(phrases[0]) // 2
                yield from self._add(n, [p[:half] for p in phrases])
                yield from self._add(n, [p[half:] for p in phrases])
                return
            yield from self.runs(n, 0)
            self.own[n], self.number[n], new = [0], np.zeros(len(self.words.ids), np.int64), used
        self.number[n][new] = np.arange(len(self.own[n]), len(self.own[n]) + len(new))
        self.own[n] += new.tolist()
        self.tries[n].add([self.number[n][p] for p in phrases])

    def runs(self, n: int, keep: int) -> Iterator[tuple]:
        names = list(self.words.ids)
        if n in self.own:
            names = [names[i] for i in self.own[n]]
        for keys, counts in self.tries[n].take(keep):
            yield from _run_rows(self.lang, names, keys, counts, n, self.tries[n].bits, self.deals, self.hot)

    def rest(self) -> Iterator[tuple]:
        """All that is left."""
        if 1 in self.lengths:
            self.counts[:2] = 0
            yield from _word_rows(self.lang, list(self.words.ids), self.counts, self.deals)
        for n in self.tries:
            yield from self.runs(n, 0)


def counting(lengths: tuple[int, ...], words: np.ndarray | None = None, pairs: np.ndarray | None = None,
             hot: dict[str, set[bytes]] | None = None, deals: int = DEALS, held: int = HELD, held_words: int = HELD_WORDS,
             chunk: int = CHUNK_BYTES) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function of batches (``lang, text`` as bytes) that counts phrases of the lengths and gives sorted runs.

    Memory is bounded: beyond ``held`` entries the largest subtrees leave, beyond ``held_words`` words the
    whole of the language that has most, dictionary included.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            states: dict[str, Counter] = {}
            for batch in batches:
                for lang, texts in batch.groupby("lang", sort=False)["text"]:
                    for text in chunks(list(texts), chunk):
                        if lang not in states:
                            states[lang] = Counter(lang, lengths, words, pairs, hot or {}, deals)
                        yield from states[lang].count(text)
                        if sum(s.size for s in states.values()) > held:
                            for s in states.values():
                                for n in s.tries:
                                    yield from s.runs(n, s.tries[n].size // 4)
                        before = None
                        while sum(len(s.words.ids) for s in states.values()) > held_words:
                            gone = states.pop(max(states, key=lambda k: len(states[k].words.ids)))
                            yield from gone.rest()
                            if gone.lang == lang:
                                names = list(gone.words.ids)
                                before = b" ".join([names[i] for i in gone.words.before.tolist()])
                        if before is not None:  # the words before the next chunk go on
                            states[lang] = Counter(lang, lengths, words, pairs, hot or {}, deals)
                            states[lang].words.before = states[lang].words.read(before)
            for s in states.values():
                yield from s.rest()

        yield from _frames(rows())

    return count


def merged(runs: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, f`` of the phrases that all runs together count at least ``least`` times.

    Runs are dealt by language and prefix partition; adding up needs no further exchange, as a phrase has one of each.
    """
    phrases, counts = (F.split(F.col(c).cast("string"), sep) for c, sep in (("phrases", "\n"), ("counts", ",")))
    return (runs.repartition("lang", "deal")
            .select("lang", "deal", F.explode(F.arrays_zip(phrases.alias("phrase"), counts.alias("n"))).alias("e"))
            .groupBy("lang", "deal", F.col("e.phrase").alias("phrase"))
            .agg(F.sum(F.col("e.n").cast("long")).alias("f")).where(F.col("f") >= least)
            .select("lang", "phrase", "f"))


def _hot(frequent: DataFrame, total: int) -> dict[str, set[bytes]]:
    """The words or pairs with at least a ``HOT_SHARE``-th of all words, so at most that many."""
    out: dict[str, set[bytes]] = defaultdict(set)
    for r in frequent.where(F.col("f") * HOT_SHARE >= F.lit(total)).collect():
        out[r["lang"]].add(r["phrase"].encode("utf-8", "surrogatepass"))
    return dict(out)


# ------------------------------------------------------------------ collocations

def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(``lang, n``: all words of each language; ``lang, phrase, words, f``: phrases of 1 to 4 words counted ``least`` times).

    All texts are read three times: for words, for pairs, for longer phrases. Both results are staged. A null
    language is ``und``, as is one of that name.
    """
    rows = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                       F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    every = stage(merged(rows.mapInPandas(counting((1,)), _RUNS), 1), "words")
    sizes = stage(every.groupBy("lang").agg(F.sum("f").alias("n")), "languages")
    total = int(sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    words = stage(every.where(F.col("f") >= least), "words")
    field = bit_field(words)
    deals = max(DEALS, isqrt(total) // 16)
    pairs = stage(merged(rows.mapInPandas(counting((2,), field, None, _hot(words, total), deals), _RUNS), least), "pairs")
    longer = stage(merged(rows.mapInPandas(
        counting((3, 4), field, bit_field(pairs), _hot(pairs, total), deals), _RUNS), least), "phrases")
    found = words.unionByName(pairs).unionByName(longer)
    return sizes, found.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "f")


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 * a / (left + right)), exact for all longs."""
    whole = lambda c: c.cast("decimal(20,0)")
    top = F.lit(2_000_000).cast("decimal(8,0)") * whole(a)
    both = whole(left) + whole(right)
    return ((top - top % both) / both).cast("decimal(38,0)").cast("long")


def covered(a: Column, longer: Column, hundredths: int = COVERED) -> Column:
    """Whether 100 * longer >= hundredths * a, exact for all longs; a null count covers nothing."""
    whole = lambda c: c.cast("decimal(20,0)")
    return F.coalesce(whole(longer) * F.lit(100).cast("decimal(3,0)") >= whole(a) * F.lit(hundredths).cast("decimal(3,0)"), F.lit(False))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language by the score of their worst cut.

    Null and empty texts have no words; repeated rows count each; further columns are ignored. Languages
    without candidates, and an empty table, give no rows. Counts of parts are met by joins, whose hot
    keys (a frequent first word) adaptive execution splits; the best of each language are chosen in 64
    shares first, so that no task ranks a whole language.
    """
    sizes, found = phrase_counts(docs, text_col, lang_col, least)
    parts = found.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    words = F.split("phrase", " ")
    candidates = found.where(F.col("words") > 1).withColumnRenamed("f", "a")
    cuts = candidates.select("lang", "phrase", "a", words.alias("w"), F.explode(
        F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest"))
    for side, out in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(parts.withColumnsRenamed({"part": side, "part_f": out}), ["lang", side])
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(
        cut_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut"))

    def inside(n: int, size: int) -> list[Column]:
        return [F.array_join(F.slice(words, i + 1, n), " ") for i in range(size - n + 1)]

    around = candidates.where(F.col("words") > 2).select("lang", F.col("a").alias("longer"), F.explode(
        F.when(F.col("words") == 3, F.array(*inside(2, 3))).otherwise(F.array(*inside(2, 4), *inside(3, 4)))).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(~covered(F.col("a"), F.col("longer"))).select(
        "lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = (kept.withColumn("share", share).withColumn("nth", F.row_number().over(W.partitionBy("lang", "share").orderBy(*order)))
            .where(F.col("nth") <= top))
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
