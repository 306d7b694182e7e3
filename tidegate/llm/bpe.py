"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The encoding of a prefix of a word ends in exactly one token. It is found from the shorter prefixes
alone: of the tokens that are suffixes of the prefix, it is the one that may stand behind the last
token of the prefix it leaves, and that is a test of two tokens. So a word takes one pass whatever
its length, with no queue of merges: a suffix automaton over the vocabulary names the tokens that
end at each position, and the last token of every prefix points back to the one before it.

A word's last byte is another symbol than the same byte inside a word, as in vocabularies that mark
the end of words. Words repeat, so each worker remembers the ids of a bounded number of them.

Cutting a text into words follows the tokenizer file. Texts of common characters are cut by the
file's own pattern here; the library's normaliser and cutter are asked for all others, since Unicode
versions differ in rarer ones.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.packing import byte_letters

#: Words and pairs a worker remembers, and the length of a word worth remembering.
REMEMBERED = 1 << 18
REMEMBERED_LENGTH = 64
#: Ids in one batch that leaves a task, unless a single text has more.
BATCH_IDS = 1 << 20

# Characters that every Unicode version normalises, lowers and sorts into kinds alike, all of them
# unchanged by composition.
_COMMON = regex.compile(
    "[\t\n\r -~\xa0-\u024f\u0400-\u0481\u048a-\u04ff\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*"
)
# The words of the tokenizer file, a fixed value; white space between them is dropped.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class SuffixAutomaton:
    """States of all substrings of the given symbol sequences, each of which has a number.

    ``ends[state]`` is the number of the sequence that is the longest string of the state, or -1.
    Every sequence has a state of its own: it occurs at its own start, where nothing precedes it.
    """

    def __init__(self, sequences: Mapping[int, Sequence[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        own = {}
        for number, sequence in sequences.items():
            state = 0
            for symbol in sequence:
                state = self._extend(state, symbol)
            own[state] = number
        self.ends = [own.get(state, -1) for state in range(len(self.step))]
        # the nearest state on the way over suffix links, itself included, that ends a sequence
        self.nearest = [0] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            self.nearest[state] = state if self.ends[state] >= 0 else self.nearest[self.link[state]]

    def _state(self, step: dict[int, int], link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, state: int, symbol: int, target: int) -> int:
        """The state of ``state`` + ``symbol``, cut off from the longer strings of ``target``."""
        if self.length[target] == self.length[state] + 1:
            return target
        shorter = self._state(dict(self.step[target]), self.link[target], self.length[state] + 1)
        self.link[target] = shorter
        while state >= 0 and self.step[state].get(symbol) == target:
            self.step[state][symbol] = shorter
            state = self.link[state]
        return shorter

    def _extend(self, state: int, symbol: int) -> int:
        """The state of a string one symbol longer than the longest of ``state``."""
        if symbol in self.step[state]:
            return self._split(state, symbol, self.step[state][symbol])
        new = self._state({}, 0, self.length[state] + 1)
        while state >= 0 and symbol not in self.step[state]:
            self.step[state][symbol] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, symbol, self.step[state][symbol])
        return new


class Vocabulary:
    """Tokens with the merge each comes from; ids of merged tokens follow the order of the merges.

    A token whose own symbols would be merged in another way never comes up and is left out of the
    automaton.
    """

    def __init__(self, merges: Sequence[tuple[int, int]], symbols: int):
        self.symbols = symbols
        self.merged = {pair: symbols + rank for rank, pair in enumerate(merges)}
        self.parts = [(symbol, symbol) for symbol in range(symbols)] + list(merges)
        sequences: list[tuple[int, ...]] = [(symbol,) for symbol in range(symbols)]
        for left, right in merges:
            sequences.append(sequences[left] + sequences[right])
        self.size = [len(sequence) for sequence in sequences]
        reached = dict.fromkeys(range(symbols))
        for token, (left, right) in enumerate(merges, symbols):
            if left in reached and right in reached and self._compatible(left, right, token):
                reached[token] = None
        self.automaton = SuffixAutomaton({token: sequences[token] for token in reached})
        self._fits: dict[tuple[int, int], bool] = {}

    def _compatible(self, left: int, right: int, until: int | None = None) -> bool:
        """Whether ``left`` followed by ``right`` stays as it is, up to the merge ``until``.

        Walks back through the merges that made the two tokens, the latest first. At every moment the
        two symbols next to the seam must not have been a merge that came before either was used up.
        A merge of equal rank goes to the pair further left.
        """
        left_used = right_used = len(self.parts) if until is None else until
        while True:
            both = self.merged.get((left, right))
            if both is not None and both != until and both < left_used and both <= right_used:
                return False
            if max(left, right) < self.symbols:
                return True
            if left >= right:
                left_used, left = left, self.parts[left][1]
            else:
                right_used, right = right, self.parts[right][0]

    def fits(self, left: int, right: int) -> bool:
        found = self._fits.get((left, right))
        if found is None:
            if len(self._fits) >= REMEMBERED:
                self._fits.clear()
            found = self._fits[left, right] = self._compatible(left, right)
        return found

    def encode(self, word: Sequence[int]) -> list[int]:
        """Token ids of a sequence of symbols."""
        automaton = self.automaton
        step, link, length = automaton.step, automaton.link, automaton.length
        ends, nearest, fits = automaton.ends, automaton.nearest, self.fits
        last = [-1]  # last[i]: the last token of the first i symbols
        state = matched = 0
        for at, symbol in enumerate(word, 1):
            while symbol not in step[state]:
                state = link[state]
                matched = length[state]
            state = step[state][symbol]
            matched += 1
            # a state's longest string may be longer than what was matched
            found = nearest[state if length[state] <= matched else link[state]]
            while True:
                before = last[at - length[found]]
                if before < 0 or fits(before, ends[found]):
                    last.append(ends[found])
                    break
                found = nearest[link[found]]
        ids = []
        at = len(word)
        while at:
            ids.append(last[at])
            at -= self.size[last[at]]
        return ids[::-1]


class Encoder:
    """Texts to little-endian 32-bit ids, as the tokenizer file has them.

    The file's words are cut from lower-cased text and end in a marked byte. Special tokens are
    looked for in the raw text first, as the library does.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        number, mark = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        plain = [number[letters[byte]] for byte in range(256)]
        final = [number[letters[byte] + mark] for byte in range(256)]
        self.inside = {letter: number[letter] for letter in letters.values()}
        self.ending = dict(zip(plain, final))
        self.byte = plain
        merges = [tuple(number[part] for part in pair) for pair in model["merges"]]
        self.vocabulary = Vocabulary(merges, len(plain) + len(final))
        special = {token.content: id for id, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len)[::-1])) + ")")
        self.words = regex.compile(_WORDS)
        self.known = _Words(self._ids)

    def _ids(self, word: str) -> bytes:
        return self._encoded([self.byte[byte] for byte in word.encode()])

    def _encoded(self, symbols: list[int]) -> bytes:
        symbols[-1] = self.ending[symbols[-1]]
        return np.array(self.vocabulary.encode(symbols), "<i4").tobytes()

    def ids(self, text: str) -> bytes:
        if any(map(text.__contains__, self.special)):
            return b"".join(
                np.array([self.special[part]], "<i4").tobytes() if part in self.special else self._plain(part)
                for part in self.cut.split(text)
            )
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if _COMMON.fullmatch(text):
            return b"".join(map(self.known.__getitem__, self.words.findall(text.lower())))
        text = self.tokenizer.normalizer.normalize_str(text)
        words = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return b"".join(self._encoded([self.inside[letter] for letter in word]) for word, _ in words)


class _Words(dict):
    """Ids of words, each worked out once while it is remembered."""

    def __init__(self, ids):
        self.ids = ids

    def __missing__(self, word: str) -> bytes:
        found = self.ids(word)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


_encoders: dict[str, Encoder] = {}
_tokens: dict[str, list[str]] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokens(path: str) -> list[str]:
    """The tokens of a vocabulary by id, one list for each worker process."""
    if path not in _tokens:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        if tokenizer.decoder is not None:
            raise ValueError("only vocabularies without a decoder, whose tokens are joined by spaces")
        _tokens[path] = [tokenizer.id_to_token(id) or "" for id in range(tokenizer.get_vocab_size())]
    return _tokens[path]


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and ids, an array of int, for each row of ``docs``.

    The ids are those of the tokenizers library without added special tokens, truncation or padding.
    NULL and empty texts, and texts of white space, have no ids. Repeated rows and NULL ids of
    documents are kept as they are; other columns are left out.
    """
    texts = docs.select("doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = encoder(tokenizer_path).ids
        for batch in batches:
            start, held, size = 0, [], 0
            for at in range(batch.num_rows):
                held.append(encode_text(batch.column(1)[at].as_py() or ""))
                size += len(held[-1]) // 4
                if size >= BATCH_IDS or at + 1 == batch.num_rows:
                    ends = np.cumsum([0, *map(len, held)]) // 4
                    ids = pa.array(np.frombuffer(b"".join(held), "<i4"))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, len(held)), lists], names=["doc_id", "ids"]
                    )
                    start, held, size = at + 1, [], 0

    return texts.mapInArrow(task, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids and decoded: the tokens of ``ids`` joined by single spaces, special ones too.

    That is what the library makes of a vocabulary without a decoder. NULL ids decode to NULL, an
    empty array to empty text; an id outside the vocabulary is an error.
    """
    ids = encoded.select("doc_id", "ids")
    kind = ids.schema["doc_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens(tokenizer_path).__getitem__
        for batch in batches:
            texts: list[str | None] = []
            start, size = 0, 0
            for at in range(batch.num_rows):
                found = batch.column(1)[at]
                texts.append(" ".join(map(token, found.values.to_numpy())) if found.is_valid else None)
                size += len(texts[-1] or "")
                if size >= 8 * BATCH_IDS or at + 1 == batch.num_rows:
                    columns = [column.slice(start, len(texts)) for column in batch.columns]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"]
                    )
                    start, size, texts = at + 1, 0, []

    return ids.mapInArrow(task, f"doc_id {kind}, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded and decoded documents."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
