"""Packing, SimHash groups, fingerprints, mixing and token trees against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scoreloom.llm import fingerprints, mixing, packing, pivots, queries
from scoreloom.llm.components import components
from odd_rows import ODD


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_pieces(pieces, rows, tokenizer, window=1024):
    """Every id of every document lies in exactly one piece, sequences are gapless and within the window."""
    want = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want[(doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[(p.doc_id, p.doc_tokens)].append(p)
    whole = {}
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        whole.setdefault((doc_id, len(ids)), []).append(ids)
    assert set(by_doc) == set(whole)
    for key, found in by_doc.items():
        cover = Counter()
        for p in found:
            assert 0 < p.length <= window
            assert p.ids_crc32 in {zlib.crc32(ids[p.start:p.start + p.length].tobytes()) for ids in whole[key]}
            cover.update(range(p.start, p.start + p.length))
        assert set(cover) == set(range(key[1])) and set(cover.values()) == {len(whole[key])}
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences)


def test_packing_round_trip(spark, sf, corpus, tokenizer):
    pieces = queries.op1_packing(spark, sf).collect()
    n = check_pieces(pieces, [(r.doc_id, r.text) for r in corpus], tokenizer)
    tokens = sum(p.length for p in pieces)
    assert n <= -(-tokens // 1024) * 1.02 + 1


def test_packing_odd_rows(docs_of, tokenizer):
    pieces = packing.pack(docs_of(ODD, extra=True)).collect()
    check_pieces(pieces, [(r[0], r[1]) for r in ODD], tokenizer)
    assert packing.pack(docs_of([])).count() == 0


def test_packing_fit_fills_windows():
    combos = packing.combinations_filling([1, 2, 4, 6], 8)
    assert set(combos) == {(2, 6), (4, 4), (1, 1, 6), (2, 2, 4)}
    plan = packing.window_plan({2: 10, 6: 10, 8: 3}, 8)
    assert sum(t for _, t in plan) == 13 and all(sum(c) == 8 for c, _ in plan)
    left = Counter()
    for c, t in packing.window_plan({3: 7, 5: 9, 7: 4, 1: 2}, 8):
        left.update({n: c.count(n) * t for n in set(c)})
    assert left == Counter({3: 7, 5: 9, 7: 4, 1: 2})


def brute_simhash(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    terms = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(t, 42) for t in terms]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(pairs, radius=4):
    """Smallest id reachable for each fingerprint, by comparing all."""
    values = sorted({fp for _, fp in pairs})
    over = {v: v for v in values}

    def top(v):
        while over[v] != v:
            v = over[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                over[top(a)] = top(b)
    least = {}
    for doc_id, fp in pairs:
        if doc_id is not None:
            least[top(fp)] = min(doc_id, least.get(top(fp), doc_id))
    return {fp: least.get(top(fp)) for fp in values}


def test_simhash_groups_are_brute_force(spark, sf, corpus):
    pairs = [(r.doc_id, brute_simhash(r.text)) for r in corpus]
    groups = brute_groups(pairs)
    want = sorted((d, f"{fp:016x}", groups[fp]) for d, fp in pairs)
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in queries.op4_pivot_simhash(spark, sf).collect())
    assert got == want


def test_simhash_odd_rows(docs_of):
    docs = docs_of(ODD, extra=True)
    pairs = [(r[0], brute_simhash(r[1])) for r in ODD]
    groups = brute_groups(pairs)
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in pivots.simhash_groups(docs).collect())
    assert got == Counter((d, f"{fp:016x}", groups[fp]) for d, fp in pairs)
    kept = pivots.keep_first_of_group(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(groups.values()))
    assert pivots.simhash_groups(docs_of([])).count() == pivots.keep_first_of_group(docs_of([])).count() == 0


@pytest.mark.parametrize("cell_rows", [64, 4096])
def test_links_connect_dense_groups(spark, monkeypatch, cell_rows):
    """Clouds of fingerprints, chains within the radius, and hot cells split over tasks."""
    monkeypatch.setattr(pivots, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(pivots, "COUNTED", 1)
    rng = np.random.default_rng(5)
    values = set(rng.integers(0, 1 << 62, 150).tolist())
    for centre in rng.integers(0, 1 << 62, 4).tolist():
        for _ in range(150):
            values.add(centre ^ sum(1 << int(b) for b in rng.choice(62, rng.integers(1, 6), replace=False)))
    chain = 0
    for b in range(0, 60, 4):
        values.add(chain)
        chain |= 0b1111 << b
    values = sorted(values)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r.node: r.root for r in components(pivots.hamming_links(fps)).collect()}
    want = brute_groups([(v, v) for v in values])
    assert {v: roots.get(v, v) for v in values} == want


def test_edited_texts_and_fingerprints(spark, sf, corpus):
    rows = sorted(((r.doc_id, r.text or "") for r in corpus))
    got = {r.doc_id: r for r in queries.op6_fingerprints(spark, sf).collect()}
    assert len(got) == len(rows)
    by_text = {}
    for i, (doc_id, text) in enumerate(rows):
        half, after = len(text) // 2, rows[(i + 1) % len(rows)]
        edited = text[:len(text) - half] + after[1][:half]
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        bits = (int(r.fingerprint, 16) ^ int(got[after[0]].fingerprint, 16)).bit_count()
        assert r.near_next == pytest.approx(max(0.0, np.cos(np.pi * bits / 64)), abs=1e-9)
        bits = (int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).bit_count()
        assert r.near_edited == pytest.approx(max(0.0, np.cos(np.pi * bits / 64)), abs=1e-9)


def test_edited_odd_rows(docs_of):
    docs = docs_of(ODD, extra=True)
    got = fingerprints.edited_fingerprints(docs).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((r[0], len(r[1] or "")) for r in ODD)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.edited_fingerprints(docs_of([])).count() == 0
    alone = fingerprints.edited_fingerprints(docs_of(ODD[:1])).first()
    assert alone.near_next == 1.0


def test_block_tables_find_all(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(1 << 62), 1 << 62, 60).tolist()
    near = [v ^ sum(1 << int(b) for b in rng.choice(62, k, replace=False)) for v in base for k in (1, 3, 4)]
    asked, stored = base, base + near
    got = {(r.query, r.found, r.bits) for r in fingerprints.within_radius(
        spark.createDataFrame([(v,) for v in asked], "fp long"),
        spark.createDataFrame([(v,) for v in stored + [None]], "fp long")).collect()}
    mask = (1 << 64) - 1
    want = {(a, b, ((a ^ b) & mask).bit_count()) for a in asked for b in stored if ((a ^ b) & mask).bit_count() <= 3}
    assert got == want


def test_native_queries_hold_no_python(spark, sf):
    for name in ("op6_fingerprints", "op7_mixing"):
        plan = getattr(queries, name)(spark, sf)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_mixing_weights_and_blocks(spark, sf, corpus):
    got = queries.op7_mixing(spark, sf).collect()
    tokens = {r.doc_id: len((r.text or "").split()) for r in corpus}
    source = {r.doc_id: r.source for r in corpus}
    have, drawn = Counter(), Counter()
    for d, s in source.items():
        have[s] += tokens[d]
    for r in got:
        assert r.source == source[r.doc_id]
        assert r.order_hash == hashlib.md5(f"mix|{r.block}|{r.doc_id}".encode()).hexdigest()
        drawn[r.source] += tokens[r.doc_id]
    assert {r.doc_id for r in got} == set(tokens)
    assert len({(r.doc_id, r.block) for r in got}) == len(got)
    top = max(have.values())
    for s in have:
        assert drawn[s] <= mixing.REPETITION_LIMIT * have[s] + 1
        # the partial permutation of a block keeps the least hashes
        last = max(r.block for r in got if r.source == s)
        inside = [r.order_hash for r in got if r.source == s and r.block == last]
        others = [hashlib.md5(f"mix|{last}|{d}".encode()).hexdigest() for d in tokens if source[d] == s]
        assert sorted(others)[:len(inside)] == sorted(inside)
    exponents = {round(np.log(drawn[s] / top) / np.log(have[s] / top), 1) for s in have
                 if have[s] < 0.7 * top and have[s] > 50 * max(t for d, t in tokens.items() if source[d] == s)}
    assert len(exponents) <= 1


def test_mixing_odd_rows(docs_of):
    docs = docs_of(ODD, extra=True)
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    counts = Counter(r.doc_id for r in got.collect())
    assert set(counts) == {r[0] for r in ODD}
    assert mixing.mix(docs_of([])).count() == 0


def test_mixing_exponent_meets_its_targets(spark):
    p = [0.7, 0.2, 0.1]
    shares = spark.createDataFrame([(x, 0.7) for x in p], "p double, top double")
    e = mixing.exponent(shares, 2.0, None)
    assert (0.1 / 0.7) ** (e - 1) == pytest.approx(2.0, abs=1e-4)
    e = mixing.exponent(shares, None, 0.95)
    w = np.array(p) ** e / (np.array(p) ** e).sum()
    assert -(w * np.log(w)).sum() == pytest.approx(0.95 * np.log(3), abs=1e-4)


def test_token_trees_count_edited_texts(spark, sf, corpus, tokenizer):
    rows = queries.op10_token_trees(spark, sf)
    assert rows.count() == len(corpus)
    plain = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in corpus}
    names = [c for c in rows.columns if "token" in c.lower()]
    assert names
    before = next(c for c in names if rows.agg(F.sum(c)).first()[0] == sum(plain.values()))
    assert all(r[before] == plain[r.doc_id] for r in rows.collect())
