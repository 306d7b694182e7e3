"""The pipeline's near-dedup stage against brute force over all pairs of fingerprints."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fingerprint(text):
    words = (text or "").lower().split()
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def corpus():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = []
    for _ in range(20):
        base = [word() for _ in range(rng.choice([150, 600]))]
        texts.append(" ".join(base))
        for changes in (1, 2, 4, 9, 30):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [texts[0].upper(), texts[3], texts[3], "one", "One", "two words", "", " \t", None]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(i * 3 % 1000, texts[at], "en", "s", 1) for i, at in enumerate(order)]


def expected(rows):
    codes = [fingerprint(row[1]) for row in rows]
    least = [row[0] for row in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 4]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(least[i], least[j])
            changed |= (least[i], least[j]) != (low, low)
            least[i] = least[j] = low
    return set(least)


@pytest.mark.parametrize("repeated", [False, True])
def test_one_document_of_each_component_stays(spark, repeated):
    rows = corpus()
    docs = spark.createDataFrame(rows + rows[:40] * repeated, SCHEMA).repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    found = [tuple(r) for r in kept.collect()]
    assert sorted(r[0] for r in found) == sorted(expected(rows))
    assert set(found) <= set(rows) and 20 < len(found) < len(rows) - 20


def test_no_rows_and_no_ids(spark):
    stage = corpus_pipeline.drop_near_duplicates
    assert stage(spark, spark.createDataFrame([], SCHEMA), "").count() == 0
    rows = [(None, "a b c d e f", "en", "s", 1), (4, "A b c d e f", "en", "s", 1), (None, "z", "en", "s", 1)]
    found = stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(map(tuple, found), key=str) == sorted(rows, key=str)
