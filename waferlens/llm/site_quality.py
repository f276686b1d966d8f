"""Document quality by hierarchical empirical Bayes.

A classifier looks at the text alone: its shape (length, repetition, capitals,
symbols) and indicator words found in labelled text, by two logistic models,
one for toxic and one for low-quality documents. Their evidence is summed up
for every host and for every section (path) of a host. Rates of small sites say
little, so a section is shrunk toward its host, and a host toward the global
prior; how strongly is estimated from how far sites differ beyond what chance
explains. A document's log odds are then moved by how much worse or better its
section is than the corpus.

The models are fitted on at most ``sample_rows`` labelled documents, chosen by
a hash; everything else covers all rows.

Defined results: a null text is empty; an empty text has the classifier's
verdict for no words; a null host or path is a site of its own name; repeated
rows are judged each; without labels of both kinds a target has probability 0,
so without any labels all documents stay. Indicators that are equally strong count
alike; texts of any length are read whole; columns of ``docs`` stay, and names of
results that clash are the caller's to choose. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.llm.common import (
    append_columns,
    fresh_name,
    join_bounded,
    shingle_hashes,
    signed,
    staged,
    text_bytes,
    word_hashes,
)

_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = bytes(range(0x30, 0x3A))
# ASCII marks other than those of ordinary sentences
_SYMBOLS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()?")
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
TARGETS = ("toxic", "low")


@dataclass(frozen=True)
class QualitySettings:
    sample_rows: int = 20_000
    # Beginnings of words, in bytes, that can be indicators besides whole words.
    stems: tuple[int, ...] = (4, 5, 6)
    # An indicator is in at least so many families of target documents, and this share of
    # them. So there are at most 250 times as many as a family has terms, in any corpus.
    indicator_rows: int = 4
    indicator_share: float = 0.004
    # Least log odds, after taking off so many standard errors, of an indicator and of a strong one.
    caution: float = 1.64
    weak: float = 0.7
    strong: float = 2.5
    ridge: float = 1e-3
    # Bounds of the prior's weight, in documents.
    weakest: float = 1.0
    strongest: float = 1e6
    threshold: float = 0.5


@dataclass
class TargetModel:
    """Probability that a document is of one kind, from its shape and indicators."""

    indicators: dict[bytes, float] = field(default_factory=dict)
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    # Beginnings of all indicators: most words have none of them.
    starts: frozenset[bytes] = frozenset()

    def predict(self, features: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(len(features))
        return _logistic(self.inputs(features) @ self.weights)

    def inputs(self, features: np.ndarray) -> np.ndarray:
        rows = (features - self.centre) / self.scale
        return np.column_stack([np.clip(rows, -8, 8), np.ones(len(rows))])


def _logistic(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


def shape_of(text: bytes) -> tuple[list[float], set[bytes]]:
    """Numbers that describe a text, and its distinct words in small letters."""
    words = text.split()
    count, size = max(1, len(words)), max(1, len(text))
    common = Counter(words)
    top = max(common.values(), default=0)
    share = lambda marks: 1 - len(text.translate(None, marks)) / size
    symbols, upper = share(_SYMBOLS), share(_UPPER)
    shape = [
        math.log1p(len(words)),
        len(common) / count,
        top / count if count >= 20 else 0.0,
        upper,
        math.sqrt(upper),
        symbols,
        math.sqrt(symbols),
        share(_DIGITS),
        common.get(b"|", 0) / count,
        math.log(size / count),
        float(not words),
    ]
    return shape, set(text.translate(_FOLD).split())


def terms_of(word: bytes, stems: Sequence[int]) -> list[bytes]:
    """A word, marked as whole, and its beginnings."""
    return [word + b" ", *(word[:size] for size in stems if len(word) >= size)]


def hints(words: set[bytes], model: TargetModel, s: QualitySettings) -> list[float]:
    """What the indicators among a text's words say: the strongest, and how many."""
    found, known, starts = [], model.indicators.get, model.starts
    shortest = min(s.stems)
    for word in words:
        if word[:shortest] in starts:
            best = known(word + b" ", 0.0)
            for size in s.stems if len(word) >= shortest else ():
                best = max(best, known(word[:size], 0.0))
            if best:
                found.append(best)
    found.sort(reverse=True)
    strong = sum(weight >= s.strong for weight in found)
    return [
        found[0] if found else 0.0,
        sum(found[:3]),
        math.log1p(strong),
        strong / math.sqrt(len(words) + 1),
    ]


def family_of(text: bytes) -> int:
    """The least hash of a text's runs of five words: near copies mostly share it."""
    words = text.lower().split()
    if not words:
        return 0
    return int(signed(shingle_hashes(word_hashes(words), min(5, len(words)))).min())


def labelled_sample(docs: DataFrame, labels: DataFrame, s: QualitySettings) -> DataFrame:
    """Texts of at most ``sample_rows`` labelled documents with family and targets.

    Labels of ids that have no text are left out before the sample is taken. An id
    counts once: with any of its labels, and the text whose hash is least. Only
    ids are read to find the sample, and texts to take it; where null texts make
    it smaller than it could be, it is taken again among ids with a text.
    """
    usable = labels.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("_id"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"),
        F.coalesce(F.col("quality") == 0, F.lit(False)).alias("low"),
    ).groupBy("_id").agg(*(F.max(target).alias(target) for target in TARGETS))
    identified = docs.where(F.col("doc_id").isNotNull())
    chosen, texts = _sampled_texts(identified, identified, usable, s)
    if texts.select("_id").distinct().count() < chosen:
        _, texts = _sampled_texts(identified.where(F.col("text").isNotNull()), identified, usable, s)
    return texts


def _sampled_texts(
    present: DataFrame, docs: DataFrame, usable: DataFrame, s: QualitySettings
) -> tuple[int, DataFrame]:
    """The number of ids chosen among ``present`` ones, and those with their texts, staged."""
    order = [F.xxhash64("_id"), "_id", *TARGETS]
    ids = present.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.count(F.lit(1)).alias("_rows"))
    sample = staged(usable.join(ids, "_id").orderBy(*order).limit(s.sample_rows), "label-sample")
    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("_id"), "text")
    # The sample has a fixed bound, so it may be broadcast.
    joined = texts.join(F.broadcast(sample.drop("_rows")), "_id")
    if sample.where(F.col("_rows") > 1).limit(1).count():
        first = F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")
        joined = joined.groupBy("_id", *TARGETS).agg(first).select("text", "_id", *TARGETS)

    def compute(columns: list[pa.Array]) -> list[pa.Array]:
        return [pa.array([family_of(text) for text in text_bytes(columns[0])], pa.int64())]

    named = append_columns(joined, ["text"], [T.StructField("family", T.LongType())], compute)
    return sample.count(), staged(named, "labelled-texts")


def _family_counts(rows: DataFrame, wanted: frozenset[bytes] | None, s: QualitySettings) -> DataFrame:
    """Families of ``rows`` in which a term occurs; of the ``wanted`` terms or of all.

    The rows of a family come together, so a task counts families as they pass
    and sends one number for each term.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        family, terms = None, set()
        for batch in batches:
            for text, own in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                if own != family:
                    counts.update(terms)
                    family, terms = own, set()
                for word in set(text.translate(_FOLD).split()):
                    terms.update(terms_of(word, s.stems))
                if wanted is not None:
                    terms &= wanted
            if len(counts) > 200_000:
                yield _counted(counts)
                counts.clear()
        counts.update(terms)
        yield _counted(counts)

    together = rows.select("text", "family").repartition("family").sortWithinPartitions("family")
    found = together.mapInArrow(run, "term binary, families long")
    return found.groupBy("term").agg(F.sum("families").alias("families"))


def _counted(counts: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
        names=["term", "families"],
    )


def find_indicators(sample: DataFrame, target: str, s: QualitySettings) -> dict[bytes, float]:
    """Terms that speak for the target, with cautious log odds.

    Documents are counted by family, so that copies of one document do not make
    its words indicators.
    """
    families = sample.groupBy(target).agg(F.count_distinct("family").alias("n"))
    counted = {row[target]: row["n"] for row in families.collect()}
    inside, outside = counted.get(True, 0), counted.get(False, 0)
    least = max(s.indicator_rows, s.indicator_share * inside)
    often = _family_counts(sample.where(F.col(target)), None, s).where(F.col("families") >= least)
    near = {bytes(row["term"]): row["families"] for row in often.collect()}
    if not near or not outside:
        return {}
    rows = _family_counts(sample.where(~F.col(target)), frozenset(near), s).collect()
    far = {bytes(row["term"]): row["families"] for row in rows}
    weights = {}
    for term, a in near.items():
        b = far.get(term, 0)
        odds = math.log((a + 0.5) / (inside + 1)) - math.log((b + 0.5) / (outside + 1))
        weight = odds - s.caution * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        if weight >= s.weak:
            weights[term] = weight
    return weights


def model_with(indicators: dict[bytes, float], s: QualitySettings) -> TargetModel:
    starts = frozenset(term.rstrip(b" ")[: min(s.stems)] for term in indicators)
    return TargetModel(indicators, starts=starts)


def describe(texts: list[bytes], models: Sequence[TargetModel], s: QualitySettings) -> list[np.ndarray]:
    """For each model the features of each text."""
    found = [shape_of(text) for text in texts]
    return [
        np.array([shape + hints(words, model, s) for shape, words in found])
        for model in models
    ]


def fit_target(features: np.ndarray, target: np.ndarray, model: TargetModel, s: QualitySettings) -> TargetModel:
    """Logistic regression by Newton steps; no weights if all documents are alike."""
    if not len(target) or not target.any() or target.all():
        return TargetModel()
    model.centre, scale = features.mean(axis=0), features.std(axis=0)
    model.scale = np.where(scale > 1e-9, scale, 1.0)
    inputs = model.inputs(features)
    weights = np.zeros(inputs.shape[1])
    ridge = s.ridge * len(inputs) * np.eye(len(weights))
    ridge[-1, -1] = 0
    for _ in range(40):
        chance = _logistic(inputs @ weights)
        slope = inputs.T @ (chance - target) + ridge @ weights
        curve = (inputs * (chance * (1 - chance) + 1e-6)[:, None]).T @ inputs + ridge
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(weights)), slope)
        weights -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    model.weights = weights
    return model


def fit(docs: DataFrame, labels: DataFrame, s: QualitySettings) -> tuple[TargetModel, ...]:
    """Models of toxic and of low-quality documents from a bounded labelled sample."""
    sample = labelled_sample(docs, labels, s)
    models = [model_with(find_indicators(sample, target, s), s) for target in TARGETS]

    def compute(columns: list[pa.Array]) -> list[pa.Array]:
        found = describe(text_bytes(columns[0]), models, s)
        return [pa.array([row.tolist() for row in table], pa.list_(pa.float64())) for table in found]

    fields = [T.StructField(f"_{target}", T.ArrayType(T.DoubleType())) for target in TARGETS]
    rows = append_columns(sample, ["text"], fields, compute).drop("text", "family").collect()
    rows.sort(key=lambda row: row["_id"])
    return tuple(
        fit_target(
            np.array([row[f"_{target}"] for row in rows]),
            np.array([row[target] for row in rows], float),
            model,
            s,
        )
        for target, model in zip(TARGETS, models, strict=True)
    )


def with_evidence(
    docs: DataFrame, models: tuple[TargetModel, ...], text_column: str, name: str, s: QualitySettings
) -> DataFrame:
    """All columns and the probability, by text alone, that a document should go."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def compute(columns: list[pa.Array]) -> list[pa.Array]:
        texts = [text or b"" for text in text_bytes(columns[0])]
        stays = np.ones(len(texts))
        if texts:
            for model, features in zip(shared.value, describe(texts, shared.value, s), strict=True):
                stays *= 1 - model.predict(features)
        return [pa.array(np.clip(1 - stays, 0, 1), pa.float64())]

    return append_columns(docs, [text_column], [T.StructField(name, T.DoubleType())], compute)


def prior_weight(
    rate: Column, count: Column, parent: Column, s: QualitySettings
) -> Column:
    """How many documents a parent's rate is worth: an aggregate over sites.

    By moments: the spread of site rates around their parents, beyond the
    binomial spread, is the true variance between sites; the weight makes a
    beta prior of that variance.
    """
    spread = F.sum(count * F.pow(rate - parent, 2))
    chance = F.sum(parent * (1 - parent))
    between = (spread - chance) / F.greatest(F.sum(count), F.lit(1))
    typical = F.sum(count * parent * (1 - parent)) / F.greatest(F.sum(count), F.lit(1))
    return F.when(
        between > 0,
        F.least(
            F.greatest(typical / between - 1, F.lit(s.weakest)),
            F.lit(s.strongest),
        ),
    ).otherwise(F.lit(s.strongest))


def site_posteriors(scored: DataFrame, name: str, s: QualitySettings) -> tuple[DataFrame, float]:
    """(host, path, posterior) of every section, and the global rate.

    ``scored`` has ``_host``, ``_path`` and the evidence. All sums are grouped
    aggregations with partial sums, so a host may have any share of the rows.
    """
    sections = staged(
        scored.groupBy("_host", "_path").agg(
            F.count(F.lit(1)).alias("_n"), F.sum(F.round(name, 9).cast("decimal(38,9)")).alias("_sum")
        ),
        "sections",
    )
    hosts = sections.groupBy("_host").agg(F.sum("_n").alias("_host_n"), F.sum("_sum").alias("_host_sum"))
    total, weight = sections.agg(F.sum("_n"), F.sum("_sum")).first()
    if not total:
        return sections.select("_host", "_path", F.lit(0.0).alias("_posterior")), 0.0
    prior = min(max(float(weight) / total, 1e-9), 1 - 1e-9)

    host_rate = F.col("_host_sum").cast("double") / F.col("_host_n")
    host_weight = hosts.agg(prior_weight(host_rate, F.col("_host_n"), F.lit(prior), s)).first()[0]
    shrunk = staged(
        hosts.select(
            "_host",
            (
                (F.col("_host_sum").cast("double") + host_weight * prior)
                / (F.col("_host_n") + F.lit(host_weight))
            ).alias("_host_rate"),
        ),
        "hosts",
    )
    with_host = staged(join_bounded(sections, shrunk, ["_host"], "inner"), "site-rates")
    rate = F.col("_sum").cast("double") / F.col("_n")
    section_weight = with_host.agg(
        prior_weight(rate, F.col("_n"), F.col("_host_rate"), s)
    ).first()[0]
    posterior = (F.col("_sum").cast("double") + section_weight * F.col("_host_rate")) / (
        F.col("_n") + F.lit(section_weight)
    )
    return staged(with_host.select("_host", "_path", posterior.alias("_posterior")), "posteriors"), prior


def _log_odds(chance: Column) -> Column:
    inside = F.least(F.greatest(chance, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(inside / (1 - inside))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    text_column: str = "text",
    s: QualitySettings = QualitySettings(),
    names: tuple[str, str, str, str] = ("p_text", "p_site", "p_reject", "keep"),
    with_text: bool = True,
) -> DataFrame:
    """All columns of ``docs`` and the evidence, the section's rate, the verdict.

    Texts are read twice, for the rates and for the verdicts, and never move.
    Without them in the result (``with_text``) they are read once, and their
    evidence is written out with the other columns.

    ``host`` and ``path`` are expressions over ``docs``; by default the source
    up to its first slash, and the rest of it with the language as section.
    """
    if host is None:
        host = F.substring_index("source", "/", 1)
    if path is None:
        rest = F.expr("substr(source, length(substring_index(source, '/', 1)) + 1)")
        path = F.concat_ws("/", F.col("lang"), rest)
    models = fit(docs, labels, s)
    evidence = names[0]
    own_host, own_path = fresh_name(docs.columns, "_host"), fresh_name(docs.columns, "_path")
    # A null site has a name that no other has.
    named = docs.withColumn(own_host, F.coalesce(host, F.lit("\x00"))).withColumn(
        own_path, F.coalesce(path, F.lit("\x00"))
    )
    scored = with_evidence(named, models, text_column, evidence, s)
    if with_text:
        columns = docs.columns
        sites = named.select(text_column, own_host, own_path)
        light = with_evidence(sites, models, text_column, evidence, s)
    else:
        columns = [name for name in docs.columns if name != text_column]
        light = scored = staged(scored.drop(text_column), "evidence")
    light = light.select(
        F.col(own_host).alias("_host"), F.col(own_path).alias("_path"), evidence
    )
    posteriors, prior = site_posteriors(light, evidence, s)
    site = posteriors.select(
        F.col("_host").alias(own_host), F.col("_path").alias(own_path), F.col("_posterior").alias(names[1])
    )
    joined = join_bounded(scored, site, [own_host, own_path], "left")
    odds = _log_odds(F.col(evidence)) + _log_odds(F.col(names[1])) - _log_odds(F.lit(prior))
    reject = 1 / (1 + F.exp(-odds))
    return joined.withColumn(names[2], reject).select(
        *columns, evidence, names[1], names[2], (F.col(names[2]) <= s.threshold).alias(names[3])
    )
