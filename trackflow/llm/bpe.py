"""Exact byte-pair encoding by backtracking over longest matches, and decoding by offsets.

A word is a string of symbols (bytes, the last one marked as word end). An Aho-Corasick automaton
finds every vocabulary entry in it; from each position the longest is tried first, then its
longest proper prefix, and so on. Two neighbours are accepted only when the pair table says that
the merge rules would never join across their border. A position from which no entry fits is
marked, so each is left at most once and the work is linear in the word.

Defined results: a null text is empty; an empty text has no ids and decodes to an empty text.
Nothing is truncated. Rows are mapped one to one, so repeated rows give repeated results.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from trackflow.llm.shared import per_text

CACHED_WORDS = 120_000
CACHED_PAIRS = 250_000
DECODE_CHUNK = 1 << 16

# Fixed values of the vocabulary format: white space, contractions, mark of a word's end.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WORD_END = "</w>"

_WORDS = regex.compile(rf"{CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^{WHITE_SPACE}\p{{L}}\p{{N}}]+")


def byte_symbols() -> list[str]:
    """One printable character for each byte: itself where printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, following = [], 256
    for byte in range(256):
        if byte in printable:
            symbols.append(chr(byte))
        else:
            symbols.append(chr(following))
            following += 1
    return symbols


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Words(dict):
    """Ids of words already met, as little-endian bytes. When full, its words become the older
    ones, which come back when they are met again; the ones older than that are forgotten. What
    stands between white space is kept as if it were one word."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        value = self.older.get(word)
        if value is None:
            value = self.encode(word)
        if len(word) <= 64:
            self[word] = value
        return value


class _Texts:
    """Encoding of texts by the words they are cut into; what encodes a word is left open."""

    def __init__(self, definition: str):
        self.spec = json.loads(definition)
        self.added = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        self.definition = definition
        self.safe: set[str] = set()
        self.symbols = byte_symbols()
        self.bytes_of = {s: byte for byte, s in enumerate(self.symbols)}
        self.words = _Words(lambda word: _packed(self.encode_word(word)))
        self.chunks = _Words(self.encode_chunk)

    def encode_word(self, word: str) -> list[int]:
        raise NotImplementedError

    def encode_chunk(self, chunk: str) -> bytes:
        """What stands between white space: most is one word, or one with a mark behind it, and
        needs no pattern to be cut."""
        if chunk.isalpha():
            return _packed(self.encode_word(chunk))
        if chunk[-1] in ".," and chunk[:-1].isalpha():
            return self.chunks[chunk[:-1]] + self.words[chunk[-1]]
        return b"".join(map(self.words.__getitem__, _WORDS.findall(chunk)))

    @cached_property
    def library(self) -> Tokenizer:
        """The library's own rules; only few texts need them."""
        return Tokenizer.from_str(self.definition)

    def encode_part(self, text: str) -> bytes:
        """A text without special tokens. No word crosses white space."""
        if not text.isascii() and not self.safe.issuperset(found := set(text)):
            if any(unicodedata.category(c) == "Cn" for c in found):
                return b"".join(map(self.words.__getitem__, self.split_new(text)))
            self.safe |= found
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if any(map(text.__contains__, "\x1c\x1d\x1e\x1f")):  # white space to split() alone
            return b"".join(map(self.words.__getitem__, _WORDS.findall(text)))
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def split_new(self, text: str) -> list[str]:
        """Words of a text with characters newer than Python's tables, cut by the library's."""
        normal = self.library.normalizer.normalize_str(text)
        words = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(map(self.bytes_of.__getitem__, word)).decode() for word, _ in words]

    def encode_bytes(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        parts = self.special.split(text) if "<|" in text else (text,)
        out = []
        for n, part in enumerate(parts):
            if n % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
            elif part:
                out.append(self.encode_part(part))
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4")


class LibraryEncoder(_Texts):
    """Texts cut as here, words encoded by the library's model; it has no tables to decode."""

    def __init__(self, definition: str):
        super().__init__(definition)
        del self.spec
        self.model = Tokenizer.from_str(definition).model

    def encode_word(self, word: str) -> list[int]:
        if not (word.isascii() and word.isprintable()):
            word = "".join([self.symbols[byte] for byte in word.encode()])
        return [token.id for token in self.model.tokenize(word)]


class Encoder(_Texts):
    """Tables of one vocabulary file, and the encoding and decoding of texts."""

    def __init__(self, definition: str):
        super().__init__(definition)
        model = self.spec["model"]
        self.names: dict[int, str] = {i: name for name, i in model["vocab"].items()}
        self.names.update({i: name for name, i in self.added.items()})
        self.ends = {s: chr(ord(s) + 0x1000) for s in self.symbols}
        vocab = model["vocab"]
        known = set(self.symbols) | {s + WORD_END for s in self.symbols}
        self.rank = [-1] * (max(self.names) + 1)
        self.left, self.right = list(self.rank), list(self.rank)
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ids = vocab[a], vocab[b]
            self.pairs.setdefault(ids, rank)
            if a + b not in known:
                known.add(a + b)
                whole = vocab[a + b]
                self.rank[whole], (self.left[whole], self.right[whole]) = rank, ids
        self._compatible: dict[int, bool] = {}  # by both ids in one number
        self._build([vocab[s] for s in known])
        del self.spec
        self._offsets()

    def _key(self, name: str) -> str:
        """The name with the mark of the word's end drawn into its last symbol."""
        if name.endswith(WORD_END) and len(name) > len(WORD_END):
            name = name[: -len(WORD_END)]
            return name[:-1] + self.ends[name[-1]]
        return name

    def _build(self, ids: list[int]) -> None:
        whole: dict[int, bool] = {}
        for i in sorted(ids, key=self.rank.__getitem__):
            base = self.rank[i] < 0
            a, b = self.left[i], self.right[i]
            whole[i] = base or (whole[a] and whole[b] and self._walk(a, b, False))
        keys = {self._key(self.names[i]): i for i in ids if whole[i]}
        self.whole = keys
        self.length, self.shorter = [0] * len(self.rank), [-1] * len(self.rank)
        self.automaton = ahocorasick.Automaton()
        for key, i in keys.items():
            self.length[i] = len(key)
            self.automaton.add_word(key, (len(key), i))
            for end in range(len(key) - 1, 0, -1):
                if (prefix := keys.get(key[:end])) is not None:
                    self.shorter[i] = prefix
                    break
        self.automaton.make_automaton()

    def _walk(self, a: int, b: int, first: bool = True) -> bool:
        """Whether the merge rules leave the border between two entries as it is.

        Undo merges on both sides from the last one back; a pair across the border that comes
        before the merge just undone would have been joined. Equal rules join from the left.
        """
        limit = len(self.rank) * 4
        while True:
            rank = self.pairs.get((a, b))
            if first and rank is not None and rank < limit:
                return False
            first = True
            if self.rank[a] > self.rank[b]:
                limit = self.rank[a]
                a = self.right[a]
            elif self.rank[b] >= 0:
                limit = self.rank[b] + 1
                b = self.left[b]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        found = self._compatible.get(a << 32 | b)
        if found is None:
            if len(self._compatible) >= CACHED_PAIRS:
                self._compatible.clear()
            found = self._compatible[a << 32 | b] = self._walk(a, b)
        return found

    def encode_word(self, word: str) -> list[int]:
        if word.isascii() and word.isprintable():
            key = word[:-1] + self.ends[word[-1]]
        else:
            symbols = [self.symbols[byte] for byte in word.encode()]
            key = "".join(symbols[:-1]) + self.ends[symbols[-1]]
        if (whole := self.whole.get(key)) is not None:
            return [whole]
        count, length, shorter, known = len(key), self.length, self.shorter, self._compatible
        longest = [-1] * count
        for end, (size, token) in self.automaton.iter(key):
            longest[end + 1 - size] = token  # of one start, the longest ends last
        fits = bytearray(b"\x01") * (count + 1)
        found: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < count:
            end = at + length[token]
            if fits[end]:
                fit = last < 0 or known.get(last << 32 | token)
                if fit is None:
                    fit = self.compatible(last, token)
                if fit:
                    found.append(token)
                    at, last = end, token
                    token = longest[at] if at < count else -1
                    continue
            token = shorter[token]
            if token < 0:
                fits[at] = 0
                token = found.pop()
                last = found[-1] if found else -1
                at -= length[token]
        return found

    def _offsets(self) -> None:
        self.table = _Table([self.names.get(i, "") for i in range(len(self.rank))])
        self.decimals = _Table([str(i) for i in range(len(self.rank))])

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Names joined by spaces."""
        return self.table.joined(ids)

    def decimal_bytes(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by spaces."""
        return self.decimals.joined(ids)


class _Table:
    """Texts one after the other, each with a space behind it, and where each begins."""

    def __init__(self, texts: list[str]):
        spaced = [text.encode() + b" " for text in texts]
        self.blob = np.frombuffer(b"".join(spaced), np.uint8)
        self.offset = np.zeros(len(spaced) + 1, np.int64)
        np.cumsum([len(x) for x in spaced], out=self.offset[1:])

    def joined(self, ids: np.ndarray) -> bytes:
        """The texts of the ids, copied from the table between each id's two offsets."""
        out = []
        for at in range(0, len(ids), DECODE_CHUNK):
            part = ids[at : at + DECODE_CHUNK].astype(np.int64)
            start = self.offset[part]
            size = self.offset[part + 1] - start
            ends = np.cumsum(size)
            place = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
            out.append(self.blob[place].tobytes())
        return b"".join(out)[:-1]


@lru_cache(4)
def encoder(definition: str) -> Encoder:
    return Encoder(definition)


@lru_cache(4)
def library_encoder(definition: str) -> LibraryEncoder:
    return LibraryEncoder(definition)


def read_vocabulary(path: str) -> str:
    """The vocabulary file's content; it is read on the driver and sent to the tasks once."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_documents(
    docs: DataFrame,
    vocabulary: str,
    schema: str = "ids array<long>, decoded string",
    derive: Callable[[np.ndarray, Encoder], tuple] | None = None,
) -> DataFrame:
    """Each document's ids and the text decoded from them, or what ``derive`` makes of both.

    ``vocabulary`` is the content of a vocabulary file. ``derive`` gets the ids and the
    encoder, and returns the columns that ``schema`` names.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def plain(ids: np.ndarray, tables: Encoder) -> tuple:
        return ids.tolist(), tables.decode_bytes(ids).decode()

    make = derive or plain

    def rows(text: str) -> list[tuple]:
        tables = encoder(shipped.value)
        ids = tables.encode(text)
        return [make(ids, tables)]

    return per_text(docs, schema, rows)
