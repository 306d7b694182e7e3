"""Byte-pair encoding, vector codes and fill-in-the-middle against the library and brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidegate.llm import bpe, codebooks, infill
from tidegate.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
TEXTS_SCHEMA = (
    "doc_id long, text string, n long, form string, low string, parts string, ids string, decoded string"
)
CLASH = (7, "clash", "clash", "clash", "clash", "clash")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts():
    rng = random.Random(5)
    letters = "abcdefgABé’'sstΣσςİıſ漢カ한각한١²Ⅷ \t\n\x0b\x1c\x85\xa0 ​_-.!€😀👍🏽\x00ǅⱯ𐐀"
    odd = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    words = ["".join(rng.choice("aeinrsthdlou") for _ in range(rng.randint(1, 15))) for _ in range(300)]
    plain = [rng.choice(["", " ", "\n"]) + " ".join(rng.choices(words, k=k)) + rng.choice(["", "  "]) for k in range(60)]
    special = [
        None, "", " \t\n ", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "<|endof text|>", "It's THEY'LL 'S",
        "x" * 5000, "haha" * 2000, "=" * 3000, "w x\n" * 30000, "has <P> in it", "ends with <", "P> starts", "<S>", "<M",
        "<\n<", "a\r\n\x85b c", "same", "same",
    ]
    rows = [(i, text) for i, text in enumerate(odd + plain + special)]
    rows += [(None, "no id"), (None, None), (3, odd[3]), (-5, "a b c d e"), (2**62, "q r s")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*row, *CLASH) for row in texts()]
    return spark.createDataFrame(rows, TEXTS_SCHEMA).repartition(3)


def test_ids_and_decoding_are_the_library_s(spark, docs):
    library = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in texts():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    got = bpe.digests(bpe.decode(bpe.encode(docs, PATH), PATH))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_random_words_over_a_small_vocabulary():
    """Against merges applied one by one, in the order of their ranks, from the left."""
    rng = random.Random(11)
    for _ in range(30):
        symbols, merges = 3, []
        strings = [(s,) for s in range(symbols)]
        for _ in range(rng.randint(1, 25)):
            pair = (rng.randrange(len(strings)), rng.randrange(len(strings)))
            made = strings[pair[0]] + strings[pair[1]]
            if len(made) < 12 and made not in strings:
                strings.append(made)
                merges.append(pair)
        vocabulary = bpe.Vocabulary(merges, symbols)
        for _ in range(60):
            word = [rng.randrange(symbols) for _ in range(rng.randint(1, 30))]
            assert vocabulary.encode(word) == merged(word, merges, symbols)


def merged(word, merges, symbols):
    word = list(word)
    while True:
        pairs = [p for p in zip(word, word[1:]) if p in merges]
        if not pairs:
            return word
        first = min(pairs, key=merges.index)
        out, at = [], 0
        while at < len(word):
            if tuple(word[at : at + 2]) == first:
                out.append(symbols + merges.index(first))
                at += 2
            else:
                out.append(word[at])
                at += 1
        word = out


def test_the_automaton_finds_every_token_that_ends_at_a_place():
    rng = random.Random(3)
    tokens = list({"".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(25)} | {"a", "b"})
    automaton = bpe.SuffixAutomaton(dict(enumerate(tokens)))
    text = "".join(rng.choice("ab") for _ in range(400))
    state = matched = 0
    for at, symbol in enumerate(text, 1):
        while symbol not in automaton.step[state]:
            state = automaton.link[state]
            matched = automaton.length[state]
        state = automaton.step[state][symbol]
        matched += 1
        found, at_state = set(), automaton.nearest[state if automaton.length[state] <= matched else automaton.link[state]]
        while at_state:
            found.add(tokens[automaton.ends[at_state]])
            at_state = automaton.nearest[automaton.link[at_state]]
        assert found == {t for t in tokens if text[:at].endswith(t)}


def test_encoding_keeps_null_ids_and_remembers_a_bounded_number_of_words(spark, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    encoder = bpe.Encoder(PATH)
    text = "one two three four one two"
    ids = np.frombuffer(encoder.ids(text), "<i4").tolist()
    assert ids == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert len(encoder.known) <= 2
    nothing = spark.createDataFrame([(1, None)], "doc_id int, ids array<int>")
    assert [tuple(r) for r in bpe.decode(nothing, PATH).collect()] == [(1, None, None)]


def test_an_empty_table_of_documents(spark):
    none = spark.createDataFrame([], TEXTS_SCHEMA)
    assert bpe.digests(bpe.decode(bpe.encode(none, PATH), PATH)).collect() == []
    assert infill.digests(infill.transform(none)).collect() == []


def expected_infill(doc_id, text, seed=42, rate=50, suffix_first=80):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    assert "".join(tokens) == text
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, len(tokens), "plain", None, None, text
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < suffix_first:
        return doc_id, len(tokens), "spm", p, m, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(tokens), "psm", p, m, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate, suffix_first", [(50, 80), (100, 50), (0, 80)])
def test_infill_is_what_brute_force_makes(docs, rate, suffix_first):
    made = infill.transform(docs, infill.Infill(rate, suffix_first))
    want = [expected_infill(*row, rate=rate, suffix_first=suffix_first) for row in texts()]
    got = [tuple(r) for r in made.select("doc_id", "n", "form", "prefix", "middle", "output").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    digests = [tuple(r) for r in infill.digests(made).collect()]
    chars = lambda text: None if text is None else len(text)
    assert sorted(digests, key=repr) == sorted(
        (
            (i, n, form, chars(p), chars(m), sha(out), sha(text or ""))
            for (i, n, form, p, m, out), (_, text) in zip(want, texts())
        ),
        key=repr,
    )


def test_a_text_of_very_many_tokens_is_matched_without_recursion(spark):
    text = "w  x\n" * 400_000 + "   "
    rows = [(i, text) for i in range(4, 9)]
    made = infill.digests(infill.transform(spark.createDataFrame(rows, "doc_id long, text string"), infill.Infill(100)))
    found = made.collect()
    assert {r.form for r in found} <= {"psm", "spm"} and {r.n for r in found} == {800_001}
    assert {r.restored_sha256 for r in found} == {sha(text)}


VECTORS = "vec_id long, embedding array<float>, label {label}, code string, error string, kind string"


def brute_codes(rows, entries=64, rounds=2):
    """vec_id, code, error, label_error and the digest, in Python integers."""
    usable = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    widths = [len(r[1]) for r in usable]
    width = max(widths, key=lambda w: (widths.count(w), w))
    usable = [r for r in usable if len(r[1]) == width]
    # components as a float column holds them
    usable = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in usable]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    def whole(x):
        return math.floor(x * 256)
    vectors = [[whole(x) for x in v] + [0] * (-width % 16) for _, v, _ in usable]
    size = len(vectors[0]) // 16
    cut = [[tuple(v[p * size : (p + 1) * size]) for p in range(16)] for v in vectors]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(16)]

    def gap(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((gap(v[p], e), k) for k, e in enumerate(books[p])) for p in range(16)] for v in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(16):
            for k in range(len(books[p])):
                mine = [v[p] for v, f in zip(cut, found) if f[p][1] == k]
                if mine:
                    books[p][k] = tuple(sum(c) // len(mine) for c in zip(*mine))
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(usable, errors):
        by_label[label] = by_label.get(label, 0) + e
    digest = sha(",".join(str(c) for book in books for e in book for c in e))

    def fits(total):
        return total if total < 1 << 63 else None

    return [
        (i, "".join(f"{k:02x}" for _, k in f), fits(e),
         fits(by_label[label]) if all(fits(x) is not None for (_, _, l), x in zip(usable, errors) if l == label) else None,
         digest)
        for (i, _, label), f, e in zip(usable, found, errors)
    ]


def vector_rows(n, width, scale=1.0, seed=1):
    rng = random.Random(seed)
    rows = [(i * 7 % 1009, [rng.gauss(0, scale) for _ in range(width)], rng.choice([0, 1, 2, None])) for i in range(n)]
    rows += [(2000 + i, list(rows[0][1]), 5) for i in range(n // 3)]  # a hot vector
    rows += [(rows[1][0], rows[1][1], 1), (None, [0.5] * width, 2), (5000, [0.25] * (width + 1), 0)]
    rows += [(3001, None, 0), (3002, [], 0), (3003, [None] + [0.0] * (width - 1), 0)]
    rows += [(3004, [float("nan")] * width, 0), (3005, [float("inf")] + [0.0] * (width - 1), 0)]
    return rows


def check_codes(spark, rows, label="int", entries=64):
    frame = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], VECTORS.format(label=label))
    got = codebooks.compress(spark, frame.repartition(3), entries)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_codes(rows, entries), key=repr)


@pytest.mark.parametrize(
    "n, width, scale",
    [(300, 64, 0.1), (200, 16, 3.0), (40, 32, 0.1), (150, 20, 1.0), (60, 48, 2.0**21), (40, 32, 1e30)],
)
def test_codes_are_exact(spark, monkeypatch, n, width, scale):
    """Small and large chunks, fewer vectors than entries, widths 16 does not divide, huge components."""
    check_codes(spark, vector_rows(n, width, scale))


def test_codes_over_many_chunks_and_text_labels(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "CHUNK_BYTES", 4 * 32 * 130)
    rows = [(i, v, None if label is None else f"l{label}.5") for i, v, label in vector_rows(700, 32, 0.3)]
    check_codes(spark, rows, "string", 17)


def test_ties_go_to_the_lower_entry_and_empty_tables_give_no_rows(spark):
    rows = [(i, [float(i % 2)] * 16, 0) for i in range(70)]
    check_codes(spark, rows)
    for nothing in ([], [(1, None, 0, "", "", ""), (2, [None], 0, "", "", "")]):
        frame = spark.createDataFrame(nothing, VECTORS.format(label="int"))
        got = codebooks.compress(spark, frame)
        assert got.collect() == [] and got.columns[0] == "vec_id"


def test_shortlists_leave_few_entries_of_a_block():
    rng = np.random.default_rng(2)
    values = np.floor(rng.normal(size=(20_000, 64)) * 256)
    books = values[:64].reshape(64, 16, 4).transpose(1, 0, 2).astype(int).astype(object)
    chunk = codebooks.Chunk(*codebooks.Chunk.pack(values))
    listed = [len(chosen) for _, _, _, chosen, _, _ in chunk.shortlists(books)]
    assert np.mean(listed) < 36
    codes, error = chunk.codes(books)
    cut = values.reshape(-1, 16, 4)
    gaps = ((cut[:, :, None] - books.astype(float)[None]) ** 2).sum(3)
    assert (codes == gaps.argmin(2)).all() and (error == gaps.min(2).sum(1)).all()


def test_a_curve_keeps_neighbours_together():
    grid = np.stack(np.meshgrid(range(16), range(16)), -1).reshape(-1, 2)
    path = grid[np.argsort(codebooks.hilbert(grid))]
    assert abs(np.diff(path, axis=0)).sum(1).max() == 1
