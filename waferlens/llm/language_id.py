"""Language identification by cross-parsing entropy.

For each language a suffix automaton accepts every substring of a bounded sample
of its labelled text. A text is parsed against it: from each place the longest
match in the sample is one phrase, and the next phrase starts after it. A text
needs few long phrases in its own language and many short ones in others, so the
language with the fewest phrases, weighted by the bits a place in its sample
costs, wins.

Every language has as many letters of sample as its rows give, up to a bound that
does not depend on how many languages there are, and every letter is a symbol of
its own. An automaton is a table where its alphabet is small, else a sorted list
of transitions; both parse alike.

Texts are reduced to small letters with one blank between words, and parsed in
blocks of fixed length, from the first to the last letter: blocks of many
texts step through the automata together, so memory is bounded whatever the
length of a text.

Defined results: a null text or one without a letter is ``und`` with score 0;
ties go to the first language by name; repeated rows are judged each; without
any labelled text all are ``und``. A row without an id is not learned from. Only the
columns named are read, whatever others there are; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.llm.common import append_columns, join_bounded, staged

UNDETERMINED = "und"
BLOCK = 512
# Letters of texts parsed together by a task.
LETTERS_AT_ONCE = 4 << 20
# Cells of the tables of a model; automata beyond are lists of transitions.
TABLE_CELLS = 60_000_000


@dataclass(frozen=True)
class SampleSettings:
    """What is learned from, for each language.

    Rows are taken in the order of a hash of their text, each from its first
    letter for ``longest`` characters; the one that does not fit is cut between
    words.
    """

    rows: int = 200
    longest: int = 20_000
    letters: int = 60_000
    # The widest alphabet of a table; it changes no result.
    alphabet: int = 120


def held_out(doc_id: Column) -> Column:
    rest = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))
    return F.coalesce(rest == 2, F.lit(True))


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: that of its small letter, or 0 if it is no letter."""
    small = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        character = chr(point)
        if character.isalpha():
            lowered = character.lower()
            small[point] = ord(lowered) if len(lowered) == 1 else point
    return small, small > 0


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def normal_letters(text: str) -> np.ndarray:
    """Code points of the small letters of a text, with a 0 between words."""
    small = _letters()[0][_points(text)]
    keep = small > 0
    keep[1:] |= keep[:-1]  # the first blank after a letter stays
    return small[keep]


def _transitions(symbols: list[int]) -> list[dict[int, int]]:
    """The suffix automaton of a sample: the next state by symbol, for each state."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at != -1:
            after = moves[at][symbol]
            if length[at] + 1 == length[after]:
                link[state] = after
            else:
                copy = len(moves)
                moves.append(moves[after].copy())
                length.append(length[at] + 1)
                link.append(link[after])
                while at != -1 and moves[at].get(symbol) == after:
                    moves[at][symbol] = copy
                    at = link[at]
                link[after] = link[state] = copy
        last = state
    return moves


class Automaton:
    """Suffix automaton of a sample; a state is held as its number times the width.

    ``symbols`` are below ``count``. Its own alphabet has one more symbol, for all
    that the sample lacks: nothing leads on from there.
    """

    def __init__(self, symbols: np.ndarray, count: int, most: int, cells: int):
        known = np.unique(symbols)
        width = len(known) + 1
        self.own = np.full(count, len(known), np.min_scalar_type(width))
        self.own[known] = np.arange(len(known))
        moves = _transitions(self.own[symbols].tolist())
        dead = len(moves)
        sizes = np.fromiter(map(len, moves), np.int64, dead)
        total = int(sizes.sum())
        keys = np.repeat(np.arange(dead) * width, sizes)
        keys += np.fromiter(chain.from_iterable(moves), np.int64, total)
        after = np.fromiter(chain.from_iterable(m.values() for m in moves), np.int64, total) * width
        del moves
        self.start = np.full(width, dead * width, np.int64)
        self.start[keys[: sizes[0]]] = after[: sizes[0]]
        self.cells = (dead + 1) * width if len(known) <= most and (dead + 1) * width <= cells else 0
        if self.cells:
            self.table = np.full(self.cells, -1, np.int32)
            self.table[keys] = after
        else:
            order = np.argsort(keys)
            # The last key is past all others, so that every search ends at one.
            self.keys = np.append(keys[order], np.iinfo(np.int64).max)
            self.after = np.append(after[order], -1)
        self.bits = float(np.log2(len(symbols) + 2))

    def _follow(self, wanted: np.ndarray) -> np.ndarray:
        """The states after state plus symbol, or -1."""
        if self.cells:
            return self.table[wanted]
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.after[at], -1)

    def phrases(self, blocks: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of each block; ``blocks`` is (letters, blocks), longest block first.

        ``active[i]`` is the number of blocks that have a letter ``i``.
        """
        blocks = self.own[blocks]
        count = np.ones(blocks.shape[1], np.int64)
        state = self.start[blocks[0]]
        for at in range(1, len(blocks)):
            some = active[at]
            if not some:
                break
            symbol = blocks[at, :some]
            after = self._follow(state[:some] + symbol)
            new = after < 0
            count[:some] += new
            state[:some] = np.where(new, self.start[symbol], after)
        return count


class LanguageModel:
    def __init__(self, samples: tuple[tuple[str, str], ...], most: int):
        self.languages = [language for language, _ in samples]
        letters = [_points(sample) for _, sample in samples]
        known = np.unique(np.concatenate(letters)) if letters else np.zeros(0, np.uint32)
        known = known[known != 32]
        # 0 is the blank; the last symbol is every letter that no sample has.
        self.codes = np.zeros(0x110000, np.min_scalar_type(len(known) + 1))
        self.codes[_letters()[1]] = len(known) + 1
        self.codes[known] = np.arange(1, len(known) + 1)
        self.automata, left = [], TABLE_CELLS
        for own in letters:
            self.automata.append(Automaton(self.codes[own], len(known) + 2, most, left))
            left -= self.automata[-1].cells

    def _parse(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bits of each text (rows) in each language (columns)."""
        owner, lengths, rows = [], [], []
        for number, codes in enumerate(texts):
            for at in range(0, len(codes), BLOCK):
                rows.append(codes[at : at + BLOCK])
                owner.append(number)
                lengths.append(len(rows[-1]))
        order = np.argsort(-np.array(lengths), kind="stable")
        sizes = np.array(lengths)[order]
        table = np.zeros((len(rows), int(sizes[0])), self.codes.dtype)
        for place, number in enumerate(order.tolist()):
            table[place, : lengths[number]] = rows[number]
        blocks = np.ascontiguousarray(table.T)
        active = np.searchsorted(-sizes, -np.arange(len(blocks)), "left")
        owners = np.array(owner)[order]
        bits = np.empty((len(texts), len(self.automata)))
        for column, automaton in enumerate(self.automata):
            count = automaton.phrases(blocks, active)
            bits[:, column] = np.bincount(owners, count, len(texts)) * automaton.bits
        return bits

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names = [UNDETERMINED] * len(texts)
        scores = [0.0] * len(texts)
        if not self.languages:
            return names, scores

        def judge(numbers: list[int], letters: list[np.ndarray]) -> None:
            for number, bits in zip(numbers, self._parse(letters), strict=True):
                order = np.argsort(bits, kind="stable")
                names[number] = self.languages[order[0]]
                others = bits[order[1]] if len(bits) > 1 else np.inf
                scores[number] = float(1 - bits[order[0]] / others)

        numbers, letters, held = [], [], 0
        for number, text in enumerate(texts):
            codes = self.codes[normal_letters(text)] if text else ()
            if not len(codes):
                continue
            numbers.append(number)
            letters.append(codes)
            held += len(codes)
            if held >= LETTERS_AT_ONCE:
                judge(numbers, letters)
                numbers, letters, held = [], [], 0
        if numbers:
            judge(numbers, letters)
        return names, scores


@lru_cache(maxsize=1)
def model_of(samples: tuple[tuple[str, str], ...], most: int) -> LanguageModel:
    return LanguageModel(samples, most)


def learn(docs: DataFrame, s: SampleSettings) -> tuple[tuple[str, str], ...]:
    """(language, sample of normal letters) of each labelled language, by name.

    Rows are chosen by a small table of hashes first; only their texts are read
    on. ``docs`` has ``text`` and ``lang`` and holds nothing but rows to learn from.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("text").alias("order")
    )
    order = Window.partitionBy("lang").orderBy("order")
    chosen = staged(
        usable.select("lang", "order")
        .distinct()
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= s.rows)
        .select("lang", "order"),
        "language-sample",
    )
    # One character more than is taken tells whether the last word may be cut.
    begun = F.substring(F.regexp_extract("text", r"(?s)\p{L}.*", 0), 1, s.longest + 1)
    found = join_bounded(usable, chosen, ["lang", "order"], "inner").select(
        "lang", "order", begun.alias("text")
    )
    plain = F.regexp_replace(F.substring("text", 1, s.longest), r"\P{L}+", " ")
    earlier = Window.partitionBy("lang").orderBy("order", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        found.distinct()
        .withColumn("cut", F.substring("text", s.longest, 2).rlike(r"^\p{L}{2}$"))
        .withColumn("plain", plain)
        .withColumn("before", F.coalesce(F.sum(F.length("plain")).over(earlier), F.lit(0)))
        .where(F.col("before") < s.letters)
        .select("lang", "before", "plain", "cut")
        .collect()
    )
    samples = []
    for language in sorted({row.lang for row in rows}):
        parts, left = [], s.letters
        for row in sorted((r for r in rows if r.lang == language), key=lambda r: r.before):
            points = _whole_words(normal_letters(row.plain), left, row.cut)
            if len(points):
                parts.append("".join(chr(p) if p else " " for p in points.tolist()))
                left -= len(points) + 1
            if left <= 0:
                break
        if parts:
            samples.append((language, " ".join(parts)))
    return tuple(samples)


def _whole_words(points: np.ndarray, most: int, cut: bool) -> np.ndarray:
    """The first words of up to ``most`` points; ``cut`` if the last is a piece of one.

    Where the first word alone is too long, or cut, a piece of it.
    """
    if len(points) > most:
        cut = points[most] != 0
        points = points[:most]
    if cut:
        ends = np.flatnonzero(points == 0)
        points = points[: ends[-1]] if len(ends) else points
    return points


def identify(
    docs: DataFrame, learned: tuple[tuple[str, str], ...], s: SampleSettings = SampleSettings()
) -> DataFrame:
    """All columns of ``docs`` (with ``text``) and ``lang_pred``, ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def compute(columns: list[pa.Array]) -> list[pa.Array]:
        model = model_of(shared.value, s.alphabet)
        names, scores = model.predict(columns[0].to_pylist())
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return append_columns(docs, ["text"], fields, compute)


def language_of_documents(docs: DataFrame, s: SampleSettings = SampleSettings()) -> DataFrame:
    """Predictions for every document, learned from those that are not held out."""
    learned = learn(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"), s)
    plain = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(plain, learned, s).select("doc_id", "held_out", "lang_pred", "score")


def phrase_count(sample: str, text: str) -> int:
    """Phrases of a text by searching the sample itself, for tests."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


