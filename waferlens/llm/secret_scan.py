"""Secret scanning: fixed patterns, and novelty against a primed compressor.

Three patterns give the base spans. Besides them, every run of at least 8 letters,
digits and ``+/_=.~-`` within 256 characters of a sensitive word, before it or
after it, is a candidate. A candidate is measured by what it adds, in compressed
bytes, to the text around it, by a zstandard compressor primed with a dictionary
of common identifiers and the words of formats: names, paths and prose shrink,
because their parts were seen or have the usual letters; random strings do not.
Candidates that add at least 6.5 bits for each character and 12 bytes in all are
reported as kind ``novel``, whatever they are made of. Words and candidates are
found in one pass each, so the work grows with the length of the text.

Defined results: a null or empty text has no spans; repeated rows are scanned
each; spans count code points, with the end exclusive; spans that start together
are in the order of kinds. Other columns stay when texts are redacted, whatever
their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.llm.common import append_columns, fresh_name

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of that many, as they are never parted
# A text can match the first pattern only if its small letters hold one of these.
_ASSIGN_PARTS = (b"passw", b"secret", b"token", b"api")
_SENSITIVE = re.compile(
    r"auth|bearer|credential|private|passphrase|passw|secret|token|signature|access|api.?key|\bkey\b",
    re.IGNORECASE | re.ASCII,
)
_SENSITIVE_PARTS = (
    b"auth", b"bearer", b"credential", b"private", b"passphrase", b"passw", b"secret", b"token",
    b"signature", b"access", b"api", b"key",
)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{8,}")

# What code, settings and prose are made of; the compressor starts with it.
IDENTIFIERS = """
the and for with this that from have not are was which you all can will one has
def class return import from self None True False function const let var static
public private protected void string integer boolean float double char null undefined
request response session client server config settings options params headers body
username password passwd secret token access_key api_key apikey credential authorization
bearer basic auth signature certificate private_key public_key passphrase oauth refresh
https://www.example.com/index.html http://localhost:8080/api/v1/users/profile.json
example.org example.net github.com amazonaws.com googleapis.com application/json
/usr/local/bin/python3 /home/user/.ssh/config /etc/hosts /var/log/messages node_modules
getElementById addEventListener toString valueOf constructor prototype undefined
placeholder changeme your_token_here your-api-key-here xxxxxxxxxxxxxxxxxxxxxxxx
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890
ssh-rsa ssh-ed25519 BEGIN END CERTIFICATE sha256 md5 base64 utf-8 content-type
"""


@dataclass(frozen=True)
class Novelty:
    """How candidates are measured.

    ``reach`` characters to a sensitive word on either side, ``around``
    characters of the text on either side that it is measured with; it must add
    ``bits`` for each character and ``least`` bytes.
    """

    reach: int = 256
    around: int = 256
    bits: float = 6.5
    least: int = 12
    level: int = 3


@lru_cache(maxsize=4)
def _compressor(level: int, identifiers: str, size: int = 4096):
    """A compressor whose dictionary knows the identifiers and the usual letters, capitals too."""
    import zstandard

    words, order = identifiers.split(), random.Random(0)
    lines = [" ".join(order.choices(words, k=12)) for _ in range(400)]
    lines = [(line.upper() if at % 4 == 0 else line).encode() for at, line in enumerate(lines)]
    primed = zstandard.train_dictionary(size, lines)
    primed.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=primed)


def added_bytes(before: str, candidate: str, after: str, measure: Novelty) -> int:
    """The bytes that ``candidate`` adds to its compressed surroundings."""
    pack = _compressor(measure.level, IDENTIFIERS).compress
    plain = len(pack((before + after).encode()))
    return len(pack((before + candidate + after).encode())) - plain


def base_spans(text: str, lowered: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the three patterns find; ``lowered`` has A-Z as a-z."""
    spans = []
    if any(part in lowered for part in _ASSIGN_PARTS):
        spans += ((m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6)
    if "AKIA" in text:
        found = (m.span() for m in _ACCESS.finditer(text))
        spans += ((start, 1, end) for start, end in found if end - start >= 20)
    spans += ((m.start(), 2, m.end()) for m in _HEX.finditer(text))
    return sorted(spans)


def merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Disjoint ranges that cover the same characters, in order."""
    ranges: list[tuple[int, int]] = []
    for start, _, end in spans:
        if ranges and start < ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(end, ranges[-1][1]))
        else:
            ranges.append((start, end))
    return ranges


def novel_spans(
    text: str, lowered: bytes, base: list[tuple[int, int, int]], measure: Novelty
) -> list[tuple[int, int, int]]:
    """Candidates near a sensitive word, outside base spans, that do not compress."""
    if not any(part in lowered for part in _SENSITIVE_PARTS):
        return []
    contexts = [context.span() for context in _SENSITIVE.finditer(text)]
    taken = merged(base)
    spans, context, base_span = [], 0, 0
    for found in _CANDIDATE.finditer(text) if contexts else ():
        start, end = found.span()
        # Candidates, words and base spans are all in order, so each list is walked once.
        while context < len(contexts) and contexts[context][1] + measure.reach < start:
            context += 1
        if context == len(contexts):
            break
        while base_span < len(taken) and taken[base_span][1] <= start:
            base_span += 1
        far = contexts[context][0] > end + measure.reach
        if far or base_span < len(taken) and taken[base_span][0] < end:
            continue
        before = text[max(0, start - measure.around) : start]
        added = added_bytes(before, found[0], text[end : end + measure.around], measure)
        if added >= measure.least and 8 * added >= measure.bits * (end - start):
            spans.append((start, 3, end))
    return spans


def find_spans(text: str | None, measure: Novelty = Novelty()) -> tuple[list, list]:
    """(base spans, all spans) of a text, each sorted by start, then kind."""
    if not text:
        return [], []
    lowered = text.encode().lower()
    base = base_spans(text, lowered)
    return base, sorted(base + novel_spans(text, lowered, base, measure))


def as_string(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, measure: Novelty = Novelty()) -> DataFrame:
    """One row for each document: counts of base spans, their digest, and all spans."""

    def compute(columns: list[pa.Array]) -> list[pa.Array]:
        counts, digests, strings = ([], [], []), [], []
        for text in columns[0].to_pylist():
            base, spans = find_spans(text, measure)
            for kind in range(3):
                counts[kind].append(sum(k == kind for _, k, _ in base))
            digests.append(hashlib.sha256(as_string(base).encode()).hexdigest())
            strings.append(as_string(spans))
        return [
            *(pa.array(count, pa.int64()) for count in counts),
            pa.array(digests, pa.string()),
            pa.array(strings, pa.string()),
        ]

    fields = [
        *(T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS[:3]),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
    ]
    return append_columns(docs.select("doc_id", "text"), ["text"], fields, compute).drop("text")


def redact(
    docs: DataFrame,
    text_column: str = "text",
    length_column: str = "n_chars",
    mark: str = "[SECRET]",
    measure: Novelty = Novelty(),
) -> DataFrame:
    """``docs`` with every span in the text replaced by ``mark``.

    Overlapping spans get one mark. The length column, if there is one, is
    counted anew for changed texts. All other columns stay.
    """

    def compute(columns: list[pa.Array]) -> list[pa.Array]:
        out = []
        for text in columns[0].to_pylist():
            _, spans = find_spans(text, measure)
            parts, at = [], 0
            for start, end in merged(spans):
                parts += (text[at:start], mark)
                at = end
            out.append("".join([*parts, text[at:]]) if parts else None)
        return [pa.array(out, pa.string())]

    name = fresh_name(docs.columns, "_redacted")
    done = append_columns(docs, [text_column], [T.StructField(name, T.StringType())], compute)
    changed = F.col(name).isNotNull()
    kinds = dict(docs.dtypes)
    return done.select(
        *(
            F.when(changed, F.col(name)).otherwise(F.col(text_column)).alias(text_column)
            if c == text_column
            else F.when(changed, F.char_length(name)).otherwise(F.col(c)).cast(kinds[c]).alias(c)
            if c == length_column
            else F.col(c)
            for c in docs.columns
        )
    )
