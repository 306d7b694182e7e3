"""Document operators against brute force, on rows that are odd in every way they may be."""

from __future__ import annotations

import functools
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegate.llm import ctw, mixing, packing, simhash, substrings
from tidegate.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, code long, size long, taken string"


def word(rng):
    return "".join(rng.choice("abcdeABC") for _ in range(rng.randint(1, 6)))


def corpus():
    rng = random.Random(7)
    passage = " ".join(word(rng) for _ in range(70))
    rows = []
    for i in range(60):
        text = " ".join(word(rng) for _ in range(rng.randint(1, 120)))
        if i % 5 == 0:
            text += "\n" + passage + " " + word(rng)
        if i % 7 == 0 and rows:
            text = rows[i // 2][1]
        rows.append((i * 3 % 61, text, "en" if i % 3 else None, f"s{i % 4}" if i % 9 else None))
    base = " ".join(word(rng) for _ in range(400)).split()
    for i in range(12):  # near copies
        changed = list(base)
        changed[rng.randrange(400)] = "changed"
        rows.append((100 + i, " ".join(changed), "en", "s0"))
    rows += [
        (200, None, None, None), (201, "", "en", ""), (202, " \t\n ", "de", "s1"), (203, "one", "en", "s1"),
        (204, "ä\x00\x85b " * 3, "de", "é"), (205, "w " * 9000, "en", "s2"), (205, "w " * 9000, "en", "s2"),
        (206, "x", "en", "s2"), (206, "y", "en", "s2"), (None, passage, "en", "s3"), (None, None, None, None),
    ]
    return [(*row, 1, "clash", 2, 3, "clash") for row in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def lower(text):
    return (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def brute_fingerprint(text):
    w = lower(text).split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, ids, radius):
    group = list(range(len(codes)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    out = []
    for i in range(len(codes)):
        mine = [ids[j] for j in range(len(codes)) if root(j) == root(i) and ids[j] is not None]
        out.append(min(mine) if mine else None)
    return out


@pytest.mark.parametrize("radius", [4, 9])
def test_simhash_components(spark, docs, radius):
    rows = corpus()
    codes = [brute_fingerprint(row[1]) for row in rows]
    expected = brute_components(codes, [row[0] for row in rows], radius)
    found = simhash.near_duplicates(spark, docs, 4, radius).collect()
    assert Counter((r[0], f"{c:016x}", e) for r, c, e in zip(rows, codes, expected)) == Counter(map(tuple, found))


def test_spark_hashes_shingles_alike(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c d")).alias("h")).first()
    assert row["h"] & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_large_shards_are_cut_without_losing_a_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(1)
    codes = [0] + [1 << int(b) for b in rng.permutation(64)[:40]] + [int(x) for x in rng.integers(1, 2**62, 60)]
    frame = spark.createDataFrame([(c - (c >> 63 << 64),) for c in set(codes)], "code long")
    links = simhash.near_links(spark, frame, 4).collect()
    together = {0}
    for _ in range(5):
        together |= {x for a, b in links for x in (a, b) if a in together or b in together}
    assert len(together) == 41


def test_forest_follows_only_edges_in_reach():
    rng = np.random.default_rng(2)
    code = rng.integers(0, 2**20, 300, dtype=np.uint64)
    group = np.sort(rng.integers(0, 4, 300))
    forest = simhash.Forest(group, code, np.arange(300))
    found = {(a, b) for x, y in forest.within(np.arange(300), group, 3) for a, b in zip(x.tolist(), y.tolist())}
    near = np.bitwise_count(code[:, None] ^ code[None, :]) <= 3
    same = group[:, None] == group[None, :]
    expected = {(i, j) for i, j in zip(*np.nonzero(near & same)) if i != j}
    assert found == expected


def test_mix(spark, docs):
    rows = mixing.mix(spark, docs).collect()
    sources = {}
    for row in corpus():
        sources[row[3]] = sources.get(row[3], 0) + len(words(row[1]))
    names = sorted((s for s in sources if s is not None), key=lambda s: s.encode("utf-32-be")) + [None]
    weight = {name: i % 3 + 1 for i, name in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(sources.values()) - sum(3 * sources[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sources[s] if s in capped else left * weight[s] / share for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * sources[s]}
        if not over:
            break
        capped |= over
    assert Counter(r["size"] for r in rows) == Counter(len(words(row[1])) for row in corpus())
    by_size = {sources[s]: s for s in names}
    taken = Counter()
    for r in rows:
        source = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(target[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source in names:
        assert taken[source] == pytest.approx(target[source], abs=max(3, 0.01 * target[source]))
    again = mixing.mix(spark, docs.repartition(5)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_small_sources_reach_their_target(spark):
    def texts(source, first, n, size):
        return spark.range(first, first + n).select(
            F.col("id").alias("doc_id"), F.expr(f"repeat('w ', {size})").alias("text"), F.lit(source).alias("source")
        )

    parts = [texts("a", 0, 300, 30_000), texts("b", 1000, 4, 5), texts("c", 2000, 10, 50), texts(None, 3000, 9, 700)]
    docs = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    found = {}
    for r in mixing.mix(spark, docs).collect():
        target, taken = found.get(r["source_size"], (0, 0))
        found[r["source_size"]] = (r["target"], taken + r["taken"])
    assert set(found) == {9_000_000, 20, 500, 6300}
    for target, taken in found.values():
        assert taken == pytest.approx(target, rel=0.01)


def test_mix_uses_no_python(spark, docs):
    plan = mixing.mixed_documents(spark, docs)._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "Arrow", "Pandas"))


def test_mixed_documents_hold_the_words_taken(spark, docs):
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(spark, docs.filter("doc_id < 200")).collect()}
    made = Counter()
    for row in mixing.mixed_documents(spark, docs.filter("doc_id < 200")).collect():
        made[row["doc_id"]] += len(words(row["text"]))
        assert row["n_chars"] == len(row["text"]) or row["n_chars"] == 1
    assert made == Counter({k: v for k, v in taken.items() if v})


def brute_substrings(rows):
    first = {}
    for row in rows:
        w, key = words(row[1]), math.inf if row[0] is None else row[0]
        for i in range(len(w) - 49):
            window = tuple(w[i : i + 50])
            first[window] = min(first.get(window, math.inf), key)
    for row in rows:
        w, key = words(row[1]), math.inf if row[0] is None else row[0]
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < key:
                gone |= set(range(i, i + 50))
        kept = [x for i, x in enumerate(w) if i not in gone]
        yield row[0], len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()


@pytest.mark.parametrize("unit", [600_000, 150])
def test_substrings(spark, docs, monkeypatch, unit):
    monkeypatch.setattr(substrings, "UNIT_WORDS", unit)
    monkeypatch.setattr(substrings, "UNIT_WINDOWS", unit)
    found = substrings.remove_repeats(spark, docs).collect()
    assert Counter(map(tuple, found)) == Counter(brute_substrings(corpus()))


def test_a_common_line_gathers_under_no_key(spark, monkeypatch):
    monkeypatch.setattr(substrings, "KEY_WINDOWS", 200)
    rng = random.Random(5)
    line = " ".join(word(rng) for _ in range(30))
    other = lambda n: " ".join(word(rng) for _ in range(n))
    texts = [f"{other(60)} {line} {other(60)}" for _ in range(150)]
    texts += [texts[3], f"{other(9)} {texts[5]}", None]
    rows = [(i, text, "en", "s", 1) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sizes = substrings.keyed_runs(docs).groupBy("key").agg(F.sum(F.octet_length("hashes") / 8).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 200
    found = substrings.remove_repeats(spark, docs).collect()
    assert Counter(map(tuple, found)) == Counter(brute_substrings(rows))


def test_documents_without_repeats(spark, docs):
    rows = substrings.without_repeats(spark, docs).collect()
    digests = Counter((r["doc_id"], hashlib.sha256(b" ".join(words(r["text"]))).hexdigest()) for r in rows)
    assert digests == Counter((d, h) for d, _, _, h in brute_substrings(corpus()))
    assert rows[0].asDict().keys() == dict.fromkeys(docs.columns).keys()
    untouched = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] in (200, 202)}
    assert untouched == {200: None, 202: " \t\n "}


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    found = packing.pack(spark, docs, tokenizer_path(), capacity=256).collect()
    expected = Counter()
    for row in corpus():
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [0]
        first = len(ids) if len(ids) <= 256 else len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids), 256), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[(row[0], piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in found) == expected
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= 1.03 * -(-sum(r["length"] for r in found) // 256) + 1


@pytest.mark.parametrize("text", ["a\n b", "a  b ", "<|endoftext|> x", "it's\t\n\nI'll", "é è\n日本 \x85x", "١٢ Ωμ"])
def test_ids_are_the_tokenizers(text):
    own = packing.Encoder(tokenizer_path())
    ids = own.tokenizer.encode(text, add_special_tokens=False).ids
    assert own.ids(text) == np.array(ids, "<u4").tobytes()


def test_two_pieces_replace_the_smallest():
    left = np.zeros(101, int)
    left[[60, 30, 20, 19]] = 1
    assert packing.fill(left, 100) == {60: 1, 20: 1, 19: 1}


def test_language_model(spark, docs):
    rows = corpus()
    trained = Counter()
    for row in rows:
        if zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 5 != 1:
            trained.update([*lower(row[1]).split(), None])
    n, v = sum(trained.values()), len(trained)
    expected = Counter()
    for row in rows:
        tokens = [*lower(row[1]).split(), None]
        base = sum(math.log10((trained[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        held_out = zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 5 == 1
        expected[(row[0], held_out, len(tokens), sum(trained[t] > 0 for t in tokens), n, round(base, 6))] += 1
    found = ctw.score_documents(spark, docs).collect()
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in found) == expected
    assert all(-1e9 < r["score"] < 0 for r in found)


def brute_tree(trained):
    """log10 probability of a byte after a context, from counts in dictionaries and recursion.

    trained: number of times each (context of DEPTH bytes, byte) occurs."""
    seen, counts = Counter(), {}
    for (context, byte), times in trained.items():
        for d in range(ctw.DEPTH + 1):
            seen[context[ctw.DEPTH - d :]] += times
            for k in range(8):
                pair = counts.setdefault((context[ctw.DEPTH - d :], format(byte, "08b")[:k]), [0, 0])
                pair[byte >> (7 - k) & 1] += times
    kept = {key: n for key, n in counts.items() if len(key[0]) <= ctw.TOP or seen[key[0]] >= ctw.LEAST}
    children = {}
    for context, bits in kept:
        if context:
            children.setdefault((context[1:], bits), []).append((context, bits))

    def kt(zero, one):
        return math.lgamma(zero + 0.5) + math.lgamma(one + 0.5) - math.lgamma(zero + one + 1) - math.log(math.pi)

    def rest(key):
        below = [kept[child] for child in children.get(key, [])]
        return [n - sum(pair[i] for pair in below) for i, n in enumerate(kept[key])]

    @functools.cache
    def weight(key):
        split = sum(map(weight, children.get(key, []))) + kt(*rest(key))
        return math.log(0.5) + np.logaddexp(kt(*kept[key]), split)

    def chance(context, bits):
        path = [(context[ctw.DEPTH - d :], bits) for d in range(ctw.DEPTH + 1)]
        path = [key for key in path if key in kept]
        total, left = 0.0, 1.0
        for key in path:
            stay = math.exp(math.log(0.5) + kt(*kept[key]) - weight(key))
            own = (kept[key][1] + 0.5) / (sum(kept[key]) + 1)
            total += left * stay * own
            left *= 1 - stay
        over = rest(path[-1]) if path else None
        if over and sum(over):
            own = (over[1] + 0.5) / (sum(over) + 1)
        return total + left * own if path else 0.5

    def log10_byte(context, byte):
        bits = format(byte, "08b")
        ones = [chance(context, bits[:k]) for k in range(8)]
        return sum(math.log10(p if bit == "1" else 1 - p) for p, bit in zip(ones, bits))

    return log10_byte


def coded_bytes(text):
    """(context, byte) of all that is coded of a text."""
    before = b"\0\0 "
    for word in [*lower(text).split(), b""]:
        line = b"\0" * (ctw.DEPTH - len(before)) + before + word + b" "
        for i in range(ctw.DEPTH, len(line)):
            yield line[i - ctw.DEPTH : i], line[i]
        before = (before + word + b" ")[-ctw.BEFORE :]


@pytest.mark.parametrize("share", [1 << 20, 300])
def test_scores_are_those_of_a_context_tree(spark, monkeypatch, share):
    for name in ("BATCH_BYTES", "SHARD_BYTES", "BUCKET_BYTES"):
        monkeypatch.setattr(ctw, name, share)
    rng = random.Random(8)
    stock = ["the", "then", "Thé", "a", "o", "ab", "abab", "the-end", "x1"]
    rows = [(i, " ".join(rng.choices(stock, k=rng.randint(1, 30)))) for i in range(40)]
    rows += [(50, None), (51, " "), (None, "the then"), (7, rows[7][1]), (7, rows[7][1]), (52, "new zzz \x01")]
    out = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _ in rows]
    log10_byte = brute_tree(Counter(pair for (_, text), held in zip(rows, out) if not held for pair in coded_bytes(text)))
    expected = []
    for (i, text), held in zip(rows, out):
        logs = [log10_byte(*pair) for pair in coded_bytes(text)]
        expected.append((-1 if i is None else i, held, sum(logs), -sum(logs) * math.log2(10) / len(logs)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = [
        (-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["score"], r["bits_per_byte"])
        for r in ctw.score_documents(spark, frame).collect()
    ]
    assert len(found) == len(expected)
    for one, other in zip(sorted(found), sorted(expected)):
        assert one[:2] == other[:2] and one[2:] == pytest.approx(other[2:], rel=1e-5)


def test_a_tree_of_nothing_is_a_probability(spark):
    held_out = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    frame = spark.createDataFrame([(i, "ab") for i in held_out], "doc_id long, text string")
    for row in ctw.score_documents(spark, frame).collect():
        assert row["held_out"] and row["n_known"] == row["train_tokens"] == 0 and row["bits_per_byte"] == pytest.approx(8)


def test_the_bytes_after_a_context_sum_to_one():
    keys = [k for row in corpus() for k in ctw.keys_of(row[1])]
    code, n = ctw.merged(ctw.key_codes(keys)[0], np.ones(len(ctw.key_codes(keys)[0]), np.int64))
    deep, own = ctw.deep_nodes(code, n), ctw.nodes_of(*ctw.merged(ctw.shortened(code, ctw.TOP + 1), n))
    weights, below = ctw.weighed(deep, ctw.TOP + 1)
    top = ctw.top_levels(own.key, own.zero, own.one, below)
    levels = [*top, *ctw.mixed(deep, weights, ctw.TOP + 1, top[-1])]
    for context in [0, *(code[:: len(code) // 20] >> 8)]:
        every = (int(context) << 8) | np.arange(256)
        assert (10 ** ctw.log10_codes(every, levels)).sum() == pytest.approx(1, abs=1e-9)


def test_krichevsky_trofimov_code_length():
    zeros, ones = 3, 5
    p = 1.0
    for i in range(zeros):
        p *= (i + 0.5) / (i + 1)
    for i in range(ones):
        p *= (i + 0.5) / (zeros + i + 1)
    assert ctw.log_kt(np.array([3.0]), np.array([5.0]))[0] == pytest.approx(math.log(p))


def test_no_rows_give_no_rows(spark, none):
    assert simhash.near_duplicates(spark, none).count() == 0
    assert mixing.mix(spark, none).count() == 0
    assert mixing.mixed_documents(spark, none).count() == 0
    assert substrings.remove_repeats(spark, none).count() == 0
    assert packing.pack(spark, none, tokenizer_path()).count() == 0
    assert ctw.score_documents(spark, none).count() == 0
