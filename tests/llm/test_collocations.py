"""Collocations against plain counting, the trie against a counter, exact scores."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from odd_rows import ODD
from scoreloom.llm import collocations as co

BLANKS, MARKS = re.compile(r"[\x20\x09]+"), re.compile(r"[.,;:!?\x0A-\x0D]")


def words_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in BLANKS.split(piece) if w] for piece in MARKS.split(text)]


def plain(docs, least, top=2000, cover=80):
    """All rows of collocations() by counting every phrase in one process."""
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for words in words_of(text):
            sizes[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, found in counts.items():
        found = {p: f for p, f in found.items() if f >= least}
        longer = Counter()
        for p, f in found.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    longer[p[i:i + n]] = max(longer[p[i:i + n]], f)
        rows = []
        for p, a in found.items():
            if len(p) > 1 and not 100 * longer[p] >= cover * a:
                score, _, l, r = min((2_000_000 * a // (found[p[:k]] + found[p[k:]]), k, found[p[:k]], found[p[k:]])
                                     for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def text_rows(seed, n, pool):
    rng = random.Random(seed)
    return [(rng.choice(["en", "en", "de", None]), "".join(rng.choice(pool) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "?"])
                                                            for _ in range(rng.randrange(60)))) for _ in range(n)]


POOL = ["the", "The", "house", "of", "a", "é", "字字", "ÉTÉ", "x\x00y", "new", "york", "\x1f", "don't", "-"]


@pytest.mark.parametrize("least, top", [(2, 2000), (12, 2000), (3, 7)])
def test_against_plain_counting(spark, least, top):
    docs = text_rows(least, 300, POOL) + [("en", "new york city " * 40)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    got = co.collocations(df, least=least, top=top).collect()
    assert sorted(tuple(r) for r in got) == plain(docs, least, top)


def test_odd_rows(docs_of):
    docs = [(r[2], r[1]) for r in ODD]
    got = co.collocations(docs_of(ODD, extra=True).withColumn("phrase", F.lit(1)).withColumn("f", F.lit(2)), least=2).collect()
    assert sorted(tuple(r) for r in got) == plain(docs, 2)
    assert co.collocations(docs_of([])).count() == 0
    assert co.collocations(docs_of([(1, None, None, None, 0), (2, "", "en", "x", 0)])).count() == 0


def counted(docs, lengths, **limits):
    """Phrase counts of one task, its runs added up; and the number of runs that a phrase is in at most."""
    frame = pd.DataFrame([(lang or "und", (text or "").encode()) for lang, text in docs], columns=["lang", "text"])
    full = np.full(64, ~np.uint64(0), np.uint64)
    total, times = Counter(), Counter()
    batches = [frame.iloc[i:i + 50] for i in range(0, len(frame), 50)]
    for out in co.counting(lengths, full, full if max(lengths) > 2 else None, **limits)(iter(batches)):
        for lang, _, phrases, numbers in out.itertuples(index=False):
            for s, n in zip(phrases.split(b"\n"), numbers.split(",")):
                phrase = (lang, s)
                total[phrase] += int(n)
                times[phrase] += 1
    return total, max(times.values())


@pytest.mark.parametrize("limits", [{}, {"chunk": 40}, {"held": 60}, {"held_words": 9}, {"chunk": 25, "held": 30, "held_words": 12}])
def test_task_counts_under_any_limit(limits):
    """Spilled subtrees, new dictionaries and cut texts lose and repeat no phrase."""
    docs = text_rows(1, 160, POOL) + [("en", "w" * 300 + " a b c " * 30)]
    want = Counter()
    for lang, text in docs:
        for words in words_of(text):
            for n in range(1, 5):
                want.update((lang or "und", " ".join(words[i:i + n]).encode()) for i in range(len(words) - n + 1))
    got = Counter()
    for lengths in ((1,), (2,), (3, 4)):
        found, most = counted(docs, lengths, **limits)
        got.update(found)
        assert limits or most == 1
    assert got == want


def test_hot_prefix_is_spread():
    frame = pd.DataFrame([("en", " ".join(f"the w{i}" for i in range(500)).encode())], columns=["lang", "text"])
    full = np.full(64, ~np.uint64(0), np.uint64)
    for hot, spread in ((None, False), ({"en": {b"the"}}, True)):
        out = pd.concat(co.counting((2,), full, None, hot)(iter([frame])))
        begun = [sum(p.startswith(b"the ") for p in phrases.split(b"\n")) for phrases in out["phrases"]]
        assert sum(begun) == 500 and (max(begun) < 20 if spread else max(begun) == 500)


@pytest.mark.parametrize("length", [2, 3, 4])
def test_trie_bursts_and_gives_up_subtrees(length):
    rng = np.random.default_rng(length)
    trie, want = co.Trie(length, burst=64), Counter()
    for _ in range(30):
        ids = [np.minimum(rng.geometric(0.02, 700), 1000) for _ in range(length)]
        trie.add(ids)
        want.update(zip(*[i.tolist() for i in ids]))
    assert trie.size == len(want) and len(trie.leaves) > 8 and (np.diff(trie.lows.astype(float)) > 0).all()
    assert max(leaf.size for leaf in trie.leaves) < 64 + 64
    mask = (1 << trie.bits) - 1
    got, taken = Counter(), 0
    for part in (trie.take(len(want) // 2), trie.take(0)):
        for keys, counts in part:
            assert (keys[1:] > keys[:-1]).all()
            for k, c in zip(keys.tolist(), counts.tolist()):
                got[tuple((k >> (trie.bits * (length - 1 - i))) & mask for i in range(length))] += c
        taken = taken or sum(got.values())
    assert got == want and 0 < taken < sum(want.values()) and trie.size == 0


def test_small_id_spaces_are_renumbered(monkeypatch):
    """Where a trie's ids run out, it is given up and its words are numbered anew."""
    trie = co.Trie
    monkeypatch.setattr(co, "Trie", lambda n: _narrow(trie(n)))
    docs = [("en", " ".join(f"w{i % 23}" for i in range(j, j + 90))) for j in range(20)]
    got, _ = counted(docs, (3, 4), chunk=200)
    want = Counter()
    for _, text in docs:
        words = text.split()
        want.update(("en", " ".join(words[i:i + n]).encode()) for n in (3, 4) for i in range(len(words) - n + 1))
    assert got == want


def _narrow(trie):
    if trie.length == 4:
        trie.bits = 4  # fifteen words
    return trie


def test_scores_are_exact(spark):
    cases = [(30, 30, 30), (9_223_372_036_854_775_807,) * 3, (9_007_199_254_740_993, 9_007_199_254_740_995, 9_007_199_254_740_997),
             (1, 3, 3), (7_000_000_000_000_001, 7_000_000_000_000_001, 9_223_372_036_854_775_807), (33, 65, 67)]
    rows = spark.createDataFrame(cases, "a long, l long, r long").select(
        "a", "l", "r", co.cut_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(r.s == 2_000_000 * r.a // (r.l + r.r) for r in rows)
    pairs = [(5, 4), (5, 3), (10 ** 18 + 5, 8 * 10 ** 17 + 4), (10 ** 18 + 5, 8 * 10 ** 17 + 3), (30, None)]
    got = spark.createDataFrame(pairs, "a long, f long").select("a", "f", co.covered(F.col("a"), F.col("f")).alias("c")).collect()
    assert all(r.c == (r.f is not None and 100 * r.f >= 80 * r.a) for r in got)
