"""Byte-level BPE as a streaming transducer, and decoding as a state machine.

A row of tokens is the BPE encoding of its bytes exactly if every two neighbours
are: encoding the bytes of both gives the two again.  So each prefix of the input has
one last token, and the encoder is a transducer that keeps the last token of every
prefix it may still need.  A token is stable, and emitted, once the chains of all
prefixes that the rest of the input can continue run through it.  What has to be kept
is bounded by the lookahead of the merge list, not by the input (Berglund and van der
Merwe, "Formalizing BPE Tokenization", 2023).

Texts are read from Spark in Arrow batches; tables of the tokenizer are built once per
Python worker from its file, which every machine must have at the same path.
"""

from __future__ import annotations

import codecs
import gc
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrail.llm.texts import release

ROWS = 512  # rows that are encoded and sent on together
FEED = 4096  # bytes handed to the transducer at a time
SHORT = 256  # bytes of a piece that is settled at once
CACHED_BYTES = 64 << 20  # a generation of words whose tokens a worker remembers
PAIRS = 300_000  # neighbours whose stability a worker remembers
_NEVER = 1 << 60

# Letters, numbers and others that Unicode 17 and later added or will add;
# the tokenizers library classes them as neither letter nor number.
LATE = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_LATE = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in LATE)
#: The byte-level pre-tokenizer: contractions, words, numbers, other signs, white space.
PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{{L}}--[{_LATE}]]+| ?[\p{{N}}--[{_LATE}]]+"
    rf"| ?(?:[^\s\p{{L}}\p{{N}}]|[{_LATE}])+|\s+(?!\S)|\s+",
    regex.V1,
)
_WHITE = r"\t-\r \x85\xa0  -     　"
#: White space and what follows up to the next: no piece crosses from a sign to white space.
WORDS = re.compile(rf"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+\Z")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the files of byte-level tokenizers."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """A merge list: tokens as bytes, how each is made, and which neighbours are stable."""

    def __init__(self, vocabulary: dict[bytes, int], merges: Iterable[tuple[bytes, bytes]]):
        self.bytes_of = {i: b for b, i in vocabulary.items()}
        self.rank: dict[int, int] = {}
        self.made_of: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(merges):
            token = vocabulary[left + right]
            if token in self.made_of:
                raise ValueError("a token is made by two merges")
            pair = vocabulary[left], vocabulary[right]
            self.pairs[pair] = self.rank[token] = rank
            self.made_of[token] = pair
        singles = [vocabulary[bytes([b])] for b in range(256)]
        # A token is usable if its own bytes are encoded as that token.
        usable = set(singles)
        for token, (left, right) in self.made_of.items():
            if left in usable and right in usable and self._apart(left, right, self.rank[token]):
                usable.add(token)
        self.longest = max(len(self.bytes_of[t]) for t in usable)
        self.whole = {self.bytes_of[t]: t for t in usable}
        self.trie: dict = {}
        for token in usable:
            node = self.trie
            for byte in self.bytes_of[token]:
                node = node.setdefault(byte, {})
            node[-1] = token
        self._stable: dict[int, bool] = {}

    @property
    def lookahead(self) -> int:
        """Bytes that suffice to settle a token: merges times the bytes of the longest."""
        return max(1, len(self.made_of)) * self.longest

    def _apart(self, left: int, right: int, until: int) -> bool:
        """No merge across the border happens before rank ``until``.

        The merges inside both tokens are undone, latest first.  Between undoing, the
        tokens at the border stood side by side, and their own merge must come no
        sooner than the one that took them; of equal ranks the leftmost comes first.
        """
        left_taken = right_taken = until
        while True:
            rank_left, rank_right = self.rank.get(left, -1), self.rank.get(right, -1)
            if rank_left < 0 and rank_right < 0:
                return True
            if rank_left > rank_right:
                left_taken, left = rank_left, self.made_of[left][1]
            else:
                right_taken, right = rank_right, self.made_of[right][0]
            across = self.pairs.get((left, right))
            if across is not None and across < left_taken and across <= right_taken:
                return False

    def stable(self, left: int, right: int) -> bool:
        """Encoding the bytes of both tokens gives the two tokens."""
        known = self._stable.get(left << 32 | right)
        if known is None:
            known = (left, right) not in self.pairs and self._apart(left, right, _NEVER)
            if len(self._stable) >= PAIRS:
                self._stable.clear()
            self._stable[left << 32 | right] = known
        return known

    def encode(self, data: bytes) -> list[int]:
        """The tokens of a short piece whose end is known.

        Longest token first, with a way back: the row of stable neighbours is unique, so
        an end that led nowhere need not be tried again.
        """
        token = self.whole.get(data)
        if token is not None:
            return [token]
        n, known, stable, trie = len(data), self._stable, self.stable, self.trie
        tokens: list[int] = []
        ends: list[int] = []
        waiting: list[list[tuple[int, int]]] = []
        failed: set[int] = set()
        start = 0
        while True:
            # Tokens that start here with their ends, the longest last.
            options = []
            node = trie
            for at in range(start, n):
                node = node.get(data[at])
                if node is None:
                    break
                if -1 in node:
                    options.append((node[-1], at + 1))
            while True:
                if not options:
                    failed.add(ends.pop())
                    tokens.pop()
                    options = waiting.pop()
                    continue
                token, end = options.pop()
                if end in failed:
                    continue
                if tokens:
                    fits = known.get(tokens[-1] << 32 | token)
                    if not (fits or (fits is None and stable(tokens[-1], token))):
                        continue
                tokens.append(token)
                if end == n:
                    return tokens
                ends.append(end)
                waiting.append(options)
                start = end
                break


class Transducer:
    """Encodes one piece as its bytes come in; ``feed`` and ``end`` return settled tokens."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.data = bytearray()  # bytes after the last emitted token
        self.before = -1  # that token
        self.last = [-1]  # last[i]: the token that ends the first i bytes of data
        self.done = 0  # starts that were looked at

    def feed(self, more: bytes) -> list[int]:
        self.data += more
        self._extend(len(self.data) - self.merges.longest)
        if self.done < self.merges.longest:
            return []
        out = self._emit(self._common())
        if len(self.data) > self.merges.lookahead + FEED + 2 * self.merges.longest:
            raise RuntimeError("the lookahead of the merge list does not suffice")
        return out

    def end(self) -> list[int]:
        self._extend(len(self.data))
        return self._emit(len(self.data))

    def _extend(self, upto: int) -> None:
        """Find the tokens that start before ``upto``."""
        data, last = self.data, self.last
        n = len(data)
        last.extend([-1] * (n + 1 - len(last)))
        trie, known, stable = self.merges.trie, self.merges._stable, self.merges.stable
        for start in range(self.done, upto):
            left = last[start] if start else self.before
            node = trie
            for at in range(start, n):
                node = node.get(data[at])
                if node is None:
                    break
                token = node.get(-1)
                if token is not None:
                    if left < 0:
                        last[at + 1] = token
                    else:
                        fits = known.get(left << 32 | token)
                        if fits or (fits is None and stable(left, token)):
                            last[at + 1] = token
        self.done = max(self.done, upto)

    def _common(self) -> int:
        """The last border that the chains of all open prefixes share."""
        size = self.merges.bytes_of
        open_ends = {i for i in range(self.done, len(self.last)) if self.last[i] >= 0}
        while len(open_ends) > 1:
            end = max(open_ends)
            open_ends.remove(end)
            open_ends.add(end - len(size[self.last[end]]))
        return open_ends.pop()

    def _emit(self, end: int) -> list[int]:
        out, at = [], end
        while at > 0:
            token = self.last[at]
            out.append(token)
            at -= len(self.merges.bytes_of[token])
        if end:
            self.before = out[0]
            del self.data[:end]
            del self.last[:end]
            self.last[0] = -1
            self.done = max(0, self.done - end)
        out.reverse()
        return out


class Tokenizer:
    """A byte-level BPE file of the tokenizers library, read as text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges"))
        if not (plain and spec["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"]):
            raise ValueError("only plain byte-level BPE without normalizer is supported")
        if pre["add_prefix_space"]:
            raise ValueError("a prefix space is not supported")
        alphabet = byte_alphabet()

        def raw(shown: str) -> bytes:
            return bytes(alphabet[c] for c in shown)

        self.specials: dict[str, int] = {}
        for token in spec["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError("added tokens that take in their surroundings are not supported")
            self.specials[token["content"]] = token["id"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocabulary = {raw(t): i for t, i in model["vocab"].items() if t not in self.specials}
        self.merges = Merges(vocabulary, ((raw(a), raw(b)) for a, b in pairs))
        longest_first = sorted(self.specials, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self._words = _Remembered(self)

    def piece(self, piece: str) -> list[int]:
        data = piece.encode()
        if len(data) <= SHORT:
            return self.merges.encode(data)
        transducer, out = Transducer(self.merges), []
        for start in range(0, len(data), FEED):
            out += transducer.feed(data[start : start + FEED])
        return out + transducer.end()

    def encode(self, text: str) -> np.ndarray:
        """The token ids of a text; special tokens inside the text are found first."""
        parts = self._special.split(text) if self._special else [text]
        found = []
        for i, part in enumerate(parts):
            if i % 2:
                found.append(np.array([self.specials[part]], np.int32))
            elif part:
                tokens = chain.from_iterable(map(self._words.__getitem__, WORDS.findall(part)))
                found.append(np.fromiter(tokens, np.int32))
        return np.concatenate(found) if found else np.empty(0, np.int32)

    def remember(self) -> None:
        """Before a task: what it remembers holds no cycles, so looking for them only costs time."""
        gc.disable()

    def forget(self) -> None:
        """Free what was remembered; a worker lives on after its task."""
        gc.enable()
        self._words = _Remembered(self)
        self.merges._stable.clear()
        release()


class Decoder:
    """The bytes of every token of a file, and nothing else of it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        specials = {token["content"]: token["id"] for token in spec["added_tokens"]}
        known = {i: bytes(alphabet[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in specials}
        known.update({i: t.encode() for t, i in specials.items()})
        self._table = [known.get(i, b"") for i in range(max(known) + 1)]

    def decode(self, ids: np.ndarray | Iterable[int]) -> str:
        """The text of the ids: a state machine takes bytes and gives out whole characters.

        Bytes that are no UTF-8 become replacement characters; unknown ids have no bytes.
        """
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self._table)):
            ids = ids[(ids >= 0) & (ids < len(self._table))]
        out = []
        for start in range(0, len(ids), FEED):
            block = map(self._table.__getitem__, ids[start : start + FEED].tolist())
            out.append(machine.decode(b"".join(block)))
        out.append(machine.decode(b"", True))
        return "".join(out)


class _Remembered(dict):
    """Tokens of words that came before, in two generations: words not met again are forgotten."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.weight = 0
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = self.older.get(word)
        if found is None:
            pieces = PIECES.findall(word)
            if len(pieces) == 1:
                found = tuple(self.tokenizer.piece(word))
            else:
                found = tuple(chain.from_iterable(map(self._piece, pieces)))
        if len(word) <= 64:
            # Two objects, an entry of the table, and 8 bytes a token (the numbers are shared).
            self.weight += 250 + 2 * len(word) + 8 * len(found)
            if self.weight >= CACHED_BYTES:
                self.older = dict(self)
                self.clear()
                self.weight = 0
            self[word] = found
        return found

    def _piece(self, piece: str):
        known = self.get(piece)
        return self.tokenizer.piece(piece) if known is None else known


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, once per process."""
    return Tokenizer(path)


@lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    """The decoder of a file, once per process."""
    return Decoder(path)


def _rows(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def encode(documents: DataFrame, path: str, text_column: str = "text", ids_column: str = "token_ids") -> DataFrame:
    """All rows and columns of ``documents`` with the token ids as array<int>.

    A NULL or empty text has no tokens.  ``path`` is the tokenizer's file on every
    machine.  A column named ``ids_column`` is replaced.  An empty table stays empty.
    """
    rows = documents.drop(ids_column)
    place = rows.columns.index(text_column)

    def run(batches):
        encoder = tokenizer(path)
        encoder.remember()
        try:
            for batch in _rows(batches):
                ids = [encoder.encode(text) if (text := value.as_py()) else _NONE for value in batch.column(place)]
                yield _with_column(batch, ids_column, _lists(ids))
        finally:
            encoder.forget()

    return rows.mapInArrow(run, _schema(rows, f"{ids_column} array<int>"))


def decode(rows: DataFrame, path: str, ids_column: str = "token_ids", text_column: str = "decoded") -> DataFrame:
    """All rows and columns with the text of ``ids_column``; NULL ids give the empty text."""
    rows = rows.drop(text_column)
    place = rows.columns.index(ids_column)

    def run(batches):
        machine = decoder(path)
        for batch in _rows(batches):
            texts = [machine.decode(_ids(value.values)) if value.is_valid else "" for value in batch.column(place)]
            yield _with_column(batch, text_column, pa.array(texts, pa.string()))

    return rows.mapInArrow(run, _schema(rows, f"{text_column} string"))


def encode_and_decode(
    documents: DataFrame,
    path: str,
    text_column: str = "text",
    ids_column: str = "token_ids",
    decoded_column: str = "decoded",
) -> DataFrame:
    """``encode`` and then ``decode`` in one pass: a worker a task instead of two."""
    rows = documents.drop(ids_column, decoded_column)
    place = rows.columns.index(text_column)

    def run(batches):
        encoder, machine = tokenizer(path), decoder(path)
        encoder.remember()
        try:
            for batch in _rows(batches):
                ids = [encoder.encode(text) if (text := value.as_py()) else _NONE for value in batch.column(place)]
                texts = pa.array(map(machine.decode, ids), pa.string())
                yield _with_column(_with_column(batch, ids_column, _lists(ids)), decoded_column, texts)
        finally:
            encoder.forget()

    return rows.mapInArrow(run, _schema(rows, f"{ids_column} array<int>, {decoded_column} string"))


_NONE = np.empty(0, np.int32)


def _ids(values: pa.Array) -> np.ndarray:
    return (values.drop_null() if values.null_count else values).to_numpy(zero_copy_only=False)


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    values = np.concatenate(ids) if ids else _NONE
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, name])


def _schema(rows: DataFrame, more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [more])


def ids_text(ids_column: str):
    """The ids in decimal, joined by commas."""
    return F.array_join(F.col(ids_column).cast("array<string>"), ",")
