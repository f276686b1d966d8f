"""Exact byte-pair encoding in linear time, and decoding by an offset table.

A text is split into words as the tokenizer's pattern says. One Aho-Corasick
pass over a word finds the longest token that starts at each place. The encoder
takes these from left to right; a token may follow another only if no merge
would have crossed their border earlier, which a table of pairs remembers. Where
none fits, shorter tokens are tried, then the last one is taken back, and a
place that led nowhere is never entered again. A sequence whose neighbours all
go together is the one that the merges in their order give, so the work grows
with the length of the word, whatever it holds.

Decoding looks up where each token's bytes lie in one long string of all
tokens' bytes and copies them with array operations.

Defined results: a null text is empty and has no ids; null ids give a null text;
ids that the vocabulary lacks, and null ones, add nothing; bytes that are no
UTF-8 become U+FFFD. Rows stay where they are, repeated ones and null document
ids included; columns that clash with the new one must be renamed by the caller,
who names it. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.llm.common import append_columns, text_bytes

VOCABULARY = "byte_bpe_50k.json"
# Words whose ids a worker remembers, and how long they may be; others are encoded anew.
CACHED_WORDS, CACHED_LETTERS = 400_000, 64
# Pairs of tokens whose compatibility a worker remembers.
CACHED_PAIRS = 250_000
# Words and ids of one text that are worked on at a time.
WORDS_AT_ONCE, IDS_AT_ONCE = 100_000, 250_000
# Bytes that start code points from U+0540 on, before which all are assigned.
LATE_CODE_POINT = re.compile(rb"[\xd5-\xff]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file.

    Printable Latin-1 bytes stand for themselves, the rest follow from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (byte for byte in range(256) if byte not in plain)
    return {chr(byte): byte for byte in plain} | {
        chr(256 + place): byte for place, byte in enumerate(others)
    }


def unassigned() -> str:
    """A pattern class of the code points without a category in this Python."""
    points = (p for p in range(0x540, 0x110000) if unicodedata.category(chr(p)) == "Cn")
    ranges: list[list[int]] = []
    for point in points:
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]"


class Merges:
    """Tokens in the order of their merges: 0 to 255 are bytes, each later one joins two.

    ``bytes_of`` holds the bytes of each token, ``parts`` the two that it
    joins, ``pairs`` the token that two join to.
    """

    def __init__(self, bytes_of: list[bytes], parts: list[tuple[int, int]]):
        self.bytes_of, self.parts = bytes_of, parts
        self.pairs = {pair: 256 + at for at, pair in enumerate(parts)}
        self.compatible: dict[tuple[int, int], bool] = {}
        # Tokens that their own bytes do not give can be part of no encoding.
        whole = [True] * 256
        for token in range(256, len(bytes_of)):
            left, right = parts[token - 256]
            whole.append(
                whole[left] and whole[right] and not self.crossed(left, right, before=token)
            )
        self.number = {b: t for t, b in enumerate(bytes_of) if whole[t]}
        self.shorter = [self._prefix(b) for b in bytes_of]
        self.lengths = [len(b) for b in bytes_of]
        self.automaton = self._automaton()

    def _prefix(self, token: bytes) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        cut = (token[:end] for end in range(len(token) - 1, 0, -1))
        return next((self.number[b] for b in cut if b in self.number), -1)

    def _automaton(self):
        import ahocorasick

        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, number in self.number.items():
            automaton.add_word(token.decode("latin-1"), number)
        automaton.make_automaton()
        return automaton

    def crossed(self, left: int, right: int, before: int) -> bool:
        """Whether a merge before ``before`` joins the end of ``left`` to the start of ``right``.

        Goes back in time: the later of the two tokens is parted first, and
        what then meets at the border met there until that token was made. Of
        two equal merges the one further left is first.
        """
        while True:
            if self.pairs.get((left, right), before) < before:
                return True
            if left < 256 and right < 256:
                return False
            if left > right:
                before, left = left, self.parts[left - 256][1]
            else:
                before, right = right + 1, self.parts[right - 256][0]

    def fit(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``; remembered."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= CACHED_PAIRS:
                self.compatible.clear()
            known = not self.crossed(left, right, before=len(self.bytes_of))
            self.compatible[left, right] = known
        return known

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one word of at least one byte."""
        longest = array("l", bytes(8 * len(word)))
        lengths, shorter = self.lengths, self.shorter
        for end, token in self.automaton.iter(word.decode("latin-1")):
            longest[end + 1 - lengths[token]] = token  # a later end is a longer token
        out: list[int] = []
        closed: set[int] = set()
        at, token = 0, longest[0]
        while at < len(word):
            while token >= 0:
                end = at + lengths[token]
                if end not in closed and (not out or self.fit(out[-1], token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < len(word) else -1
            else:
                closed.add(at)
                token = out.pop()
                at -= lengths[token]
                token = shorter[token]
        return out


def read_vocabulary(path: str) -> dict:
    """The file's content; only plain byte-level vocabularies are understood.

    Truncation and padding are not used.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split, special = spec["model"], spec["pre_tokenizer"] or {}, spec["added_tokens"]
    odd = (
        model["type"] != "BPE"
        or spec["normalizer"]
        or split.get("type") != "ByteLevel"
        or split.get("add_prefix_space")
        or not split.get("use_regex", True)
        or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        or model.get("ignore_merges")
        or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in special)
    )
    if odd:
        raise ValueError("not a plain byte-level BPE vocabulary")
    return spec


class Encoder(dict):
    """Ids of texts for one vocabulary file.

    As a dictionary it holds the ids of words already seen, as the bytes of
    32-bit numbers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        spec = read_vocabulary(path)
        model, special = spec["model"], spec["added_tokens"]
        vocabulary, letters = model["vocab"], byte_letters()

        def spelled(token: str) -> bytes:
            return bytes(map(letters.__getitem__, token))

        singles = {byte: vocabulary[letter] for letter, byte in letters.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        names = [a + b for a, b in pairs]
        number = {letter: byte for letter, byte in letters.items()}
        number |= {name: 256 + at for at, name in enumerate(names)}
        if len(number) != 256 + len(names):
            raise ValueError("two merges give the same token")
        self.merges = Merges(
            [bytes([byte]) for byte in range(256)] + [spelled(name) for name in names],
            [(number[a], number[b]) for a, b in pairs],
        )
        self.id_of = [singles[byte] for byte in range(256)] + [vocabulary[n] for n in names]
        self.special = {t["content"]: t["id"] for t in special}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.mark = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.words = self._pattern()
        self.unassigned = re.compile(unassigned())
        self.split_by_library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    @staticmethod
    def _pattern() -> regex.Pattern:
        import public_tokenizers

        return regex.compile(public_tokenizers.PATTERN)

    def __missing__(self, word: str) -> bytes:
        tokens = self.merges.encode(word.encode("utf-8"))
        ids = array("i", map(self.id_of.__getitem__, tokens)).tobytes()
        if len(word) <= CACHED_LETTERS and len(self) < CACHED_WORDS:
            self[word] = ids
        return ids

    def _words(self, text: str, late: bool) -> Iterator[list[str]]:
        """The words of a text without special tokens, some at a time."""
        if late and self.unassigned.search(text):
            # Newer letters than the library knows: it says itself how it splits.
            yield [text[a:b] for _, (a, b) in self.split_by_library(text)]
        elif len(text) < 5 * WORDS_AT_ONCE:
            yield self.words.findall(text)
        else:
            found = (m[0] for m in self.words.finditer(text))
            while some := list(islice(found, WORDS_AT_ONCE)):
                yield some

    def encode(self, text: bytes) -> bytes:
        """The ids of a text in UTF-8, as the bytes of 32-bit numbers."""
        late = LATE_CODE_POINT.search(text) is not None
        out = []
        for piece in self.mark.split(text.decode("utf-8")) if self.special else [text.decode("utf-8")]:
            if piece in self.special:
                out.append(array("i", [self.special[piece]]).tobytes())
            elif piece:
                out.extend(b"".join(map(self.__getitem__, w)) for w in self._words(piece, late))
        return b"".join(out)


class Decoder:
    """Texts of ids for one vocabulary file: the bytes of all tokens, and where each begins."""

    def __init__(self, path: str):
        spec, letters = read_vocabulary(path), byte_letters()
        texts = {
            number: bytes(map(letters.__getitem__, token))
            for token, number in spec["model"]["vocab"].items()
        }
        texts |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        sizes = [len(texts.get(number, b"")) for number in range(max(texts) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.letters = np.frombuffer(b"".join(texts[n] for n in sorted(texts)), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; those that no token has are left out."""
        return b"".join(
            self._bytes(ids[at : at + IDS_AT_ONCE]) for at in range(0, len(ids), IDS_AT_ONCE)
        ).decode("utf-8", "replace")

    def _bytes(self, ids: np.ndarray) -> bytes:
        ids = ids[(ids >= 0) & (ids < len(self.offsets) - 1)]
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        end = np.cumsum(size)
        if not len(end):
            return b""
        place = np.arange(end[-1]) + np.repeat(start - (end - size), size)
        return self.letters[place].tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(
    docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None
) -> DataFrame:
    """All columns of ``docs`` and ``ids``, the token ids of ``text`` (none if it is null)."""
    path = path or vocabulary_path()

    def compute(columns: Sequence[pa.Array]) -> list[pa.Array]:
        one = encoder(path)
        found = [one.encode(t or b"") for t in text_bytes(columns[0])]
        ends = np.cumsum([0, *map(len, found)]) // 4
        values = np.frombuffer(b"".join(found), np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))]

    return append_columns(docs, [text], [T.StructField(ids, T.ArrayType(T.IntegerType()))], compute)


def decode(
    rows: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None
) -> DataFrame:
    """All columns of ``rows`` and ``text``, what the token ``ids`` stand for."""
    path = path or vocabulary_path()

    def compute(columns: Sequence[pa.Array]) -> list[pa.Array]:
        one = decoder(path)
        texts = []
        for row in columns[0]:
            values = row.values if row.is_valid else None
            texts.append(
                None if values is None else one.decode(values.drop_null().to_numpy(zero_copy_only=False))
            )
        return [pa.array(texts, pa.string())]

    return append_columns(rows, [ids], [T.StructField(text, T.StringType())], compute)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document the number and digest of its ids, and the digest of their text."""
    encoded = encode(docs.select("doc_id", "text"), path=path).drop("text")
    return decode(encoded, path=path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
