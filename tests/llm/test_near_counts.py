"""The search among all fingerprints against comparing all with all."""

from collections import Counter

import numpy as np
import pytest

from odd_rows import ODD
from scoreloom.llm import fingerprints, queries


def near(value, values):
    return sum((value ^ v).bit_count() <= 3 for v in values)


def test_op6_counts_near_fingerprints(spark, sf):
    got = queries.op6_fingerprints(spark, sf).collect()
    values = {int(r.fingerprint, 16) for r in got}
    for r in got:
        assert r.near_count == (near(int(r.fingerprint, 16), values) if r.doc_id % 50 == 0 else None)
    assert sum(r.near_count is not None for r in got) > 1


def test_near_counts_of_odd_rows(docs_of):
    rows = ODD + [(0, ODD[0][1], "en", "web", 1), (-50, "", "en", "web", 1), (100, None, "en", "web", 1)]
    got = fingerprints.searched_fingerprints(docs_of(rows, extra=True)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    values = {int(r.fingerprint, 16) for r in got}
    for r in got:
        assert r.near_count == (near(int(r.fingerprint, 16), values) if r.doc_id in (0, -50, 100) else None)
    assert fingerprints.searched_fingerprints(docs_of([])).count() == 0


@pytest.mark.parametrize("key_rows", [16, 4_096])
def test_block_tables_split_hot_keys(spark, monkeypatch, key_rows):
    """A cloud of fingerprints that all share 32 bits."""
    monkeypatch.setattr(fingerprints, "KEY_ROWS", key_rows)
    rng = np.random.default_rng(4)
    stored = sorted({(77 << 32) ^ int(v) for v in rng.integers(0, 1 << 12, 400)} | set(rng.integers(0, 1 << 62, 100).tolist()))
    asked = stored[::9]
    df = spark.createDataFrame([(v,) for v in stored], "fp long")
    got = sorted((r.query, r.found) for r in fingerprints.within_radius(
        spark.createDataFrame([(v,) for v in asked], "fp long"), df).collect())
    assert got == sorted((a, b) for a in asked for b in stored if (a ^ b).bit_count() <= 3)
