"""The Merkle manifest, byte-pair encoding and vector codes against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waferlens.llm import bpe, merkle, queries, vector_codes

SF_DIR = "/root/testdata/sf0.001"


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- 11 Merkle manifest ---------------------------------------------------------------------

DOCUMENT = "doc_id long, source string, lang string, n_chars long, text string"


def odd_documents():
    """Null and repeated rows, repeated ids, a lone leaf, many groups, a third of all rows equal."""
    rows = [(None, None, None, None, None)] * 3 + [(1, "s", "zz", 1, "A")] * 2
    rows += [(2, None, "", 0, ""), (3, "s", "lone", 5, "X" * 100_000), (4, "s", "zz", 1, "Öx\n")]
    rows += [(i, "s", f"g{i % 11}", i, f"Text {i % 50}") for i in range(400)]
    rows += [(7, "s", "hot", 1, "Same")] * 250
    rows += [(8, "s", "hot", 1, None), (8, "s", "hot", 1, "other"), (-9, "t", "hot", None, "Low")]
    return rows


@pytest.fixture(scope="module")
def leaves(spark):
    """With extra columns named like results and helpers."""
    return (
        spark.createDataFrame(odd_documents(), DOCUMENT)
        .withColumns({c: F.lit("other") for c in ("digest", "tree", "_row", "children", "root")})
        .repartition(5)
    )


@pytest.mark.parametrize("few, hot", [(1_000, 1_000), (0, 1_000), (0, 3)])
def test_proofs_equal_brute_force(leaves, monkeypatch, few, hot):
    monkeypatch.setattr(merkle, "FEW_RECORDS", few)
    monkeypatch.setattr(merkle, "HOT_COPIES", hot)
    found = collected(merkle.verify_documents(leaves))
    assert found == sorted(merkle.brute_force(odd_documents()), key=repr)


def test_manifest_query(spark):
    rows = [
        tuple(r) for r in queries.table(spark, SF_DIR, "documents").select(*merkle.FIELDS).collect()
    ]
    found = collected(queries.op11_merkle_manifest(spark, SF_DIR))
    assert found == sorted(merkle.brute_force(rows), key=repr)
    assert 0 < sum(row[-1] for row in found) < len(found)


@pytest.mark.parametrize("rows", [0, 1, 8, 9, 64, 65])
def test_sizes_at_the_borders_of_runs(spark, rows):
    data = [(i, "s", None, i, f"T{i}") for i in range(rows)]
    found = collected(merkle.verify_documents(spark.createDataFrame(data, DOCUMENT)))
    assert found == sorted(merkle.brute_force(data), key=repr)


def test_requests_touch_only_their_paths(leaves):
    manifest = merkle.build(merkle.document_leaves(leaves))
    asked = manifest.leaves.where("doc_id in (5, 16, 399)").select("tree", "pos")
    absent = asked.limit(1).withColumn("pos", F.lit(10**6).cast("long"))
    asked = asked.union(asked).union(absent)
    proofs = merkle.prove(manifest, asked)
    root = merkle.folded(F.col("digest"), F.col("path"))
    assert proofs.where(root == F.col("root")).count() == proofs.count() == 3
    # Leaves 5 and 16 share a run, so two nodes are reached for three leaves.
    assert merkle.descend(manifest, asked).count() == 2


def test_equal_subtrees_are_stored_once(leaves):
    manifest = merkle.build(merkle.document_leaves(leaves))
    shared = manifest.records.where("height = 1 and copies > 20")
    assert shared.count() == 1
    assert manifest.records.select("height", "digest").distinct().count() == manifest.records.count()


# --- 12 byte-pair encoding ------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


def bpe_texts():
    rng = random.Random(12)
    letters = "abcdefghij  \n\t\r.,-_'’éß日本語😀١Ⅷ՘\U0001fae9\xa0‍"
    texts = [None, "", " ", "\n\n  \n", "a<|endoftext|>b <|endoftext|><|endof", "'s'S 'll we'RE"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 80))) for _ in range(600)]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 300))) for _ in range(100)]
    texts += ["".join(rng.choice("-= ") for _ in range(rng.randrange(1, 300))) for _ in range(100)]
    texts += ["words and more words, " * 40_000, "x" * 200_000, "aB1 " * 10 + "\U00010d4a"]
    return texts


def test_ids_and_texts_equal_the_library(spark, library):
    texts = bpe_texts()
    rows = [(i % 300 or None, t, "z", i) for i, t in enumerate([*texts, *texts[:20]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, row int")
    decoded = bpe.decode(bpe.encode(docs.repartition(3), ids="ids"), "ids", "again")
    assert decoded.columns == [*docs.columns, "ids", "again"]
    for row in decoded.collect():
        text = row["text"] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert row["ids"] == ids
        assert row["again"] == library.decode(ids, skip_special_tokens=False) == text
    assert bpe.encode(docs.limit(0)).count() == 0


def test_every_token_by_itself(library):
    codec = bpe.encoder(bpe.vocabulary_path())
    for token in range(library.get_vocab_size()):
        text = library.decode([token], skip_special_tokens=False)
        ids = np.frombuffer(codec.encode(text.encode()), np.int32).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_mixed_tokens_equal_the_library(library):
    path, rng = bpe.vocabulary_path(), random.Random(5)
    encoder, decoder = bpe.encoder(path), bpe.decoder(path)
    size = library.get_vocab_size()
    for _ in range(5_000):
        ids = [rng.randrange(size) for _ in range(rng.randrange(1, 12))]
        text = library.decode(ids, skip_special_tokens=False)
        assert decoder.decode(np.array(ids)) == text
        found = np.frombuffer(encoder.encode(text.encode()), np.int32).tolist()
        assert found == library.encode(text, add_special_tokens=False).ids


def test_unknown_and_null_ids(spark):
    rows = spark.createDataFrame([([64, None, 10**8, -1, 65],), (None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(rows).collect()] == ["ab", None, ""]


def test_merges_are_exact_for_any_order_of_merges(library):
    """Random small vocabularies, whose tokens may cross and hide each other."""
    rng = random.Random(3)
    for _ in range(60):
        names, pairs = [bytes([b]) for b in range(256)], []
        while len(pairs) < 25:
            a, b = (rng.choice([97, 98, 99, *range(256, len(names))]) for _ in range(2))
            if names[a] + names[b] not in names:
                pairs.append((a, b))
                names.append(names[a] + names[b])
        merges = bpe.Merges(names, pairs)
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 25)))
            tokens = list(word)
            while True:
                ranks = [merges.pairs.get(p, 10**6) for p in zip(tokens, tokens[1:], strict=False)]
                if not ranks or min(ranks) == 10**6:
                    break
                at = ranks.index(min(ranks))
                tokens[at : at + 2] = [min(ranks)]
            assert merges.encode(word) == tokens


def test_byte_pair_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SF_DIR, "documents").collect()}
    rows = queries.op12_byte_pairs(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# --- 13 vector codes ------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, error int, codes string"


def odd_vectors(count=300):
    rng = random.Random(13)
    steps = [0.0, 0.001, -0.5, -0.0001]
    rows = [
        (i if i % 9 else None, [rng.choice([*steps, rng.uniform(-1, 1)]) for _ in range(16)], i % 3 or None)
        for i in range(count)
    ]
    rows += rows[:50] + [rows[20]] * 150  # repeated rows, a third of them one vector
    rows += [(5, None, 1), (6, [None] * 16, 1), (7, [float("nan")] * 16, 1), (8, [], 1)][:3]
    return [(*r, 1, "z") for r in [*rows, (8, [float("-inf")] + [0.0] * 15, 1)]]


@pytest.mark.parametrize("rows", [0, 1, 5, 40, 500])
def test_codes_equal_brute_force(spark, rows):
    table = spark.createDataFrame(odd_vectors()[:rows], VECTORS).repartition(3)
    singles = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    found = collected(vector_codes.compress(table))
    assert found == sorted(vector_codes.brute_force(singles), key=repr)


def test_codes_query(spark):
    table = queries.table(spark, SF_DIR, "embeddings")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    found = collected(queries.op13_vector_codes(spark, SF_DIR))
    assert found == sorted(vector_codes.brute_force(rows), key=repr)


def test_balls_skip_work_and_lose_nothing():
    """The assignment is that of a full search, and most distances are not taken."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 8))
    parts = centres[rng.integers(0, 16, 4000)] + rng.integers(-300, 300, (4000, 8))
    ways = ((parts[:, None] - centres[None]) ** 2).sum(axis=2)
    nearest = ways.argmin(axis=1)
    for held in (np.zeros(4000, np.int64), nearest, rng.integers(0, 16, 4000)):
        reach = [int(np.sqrt(ways[held == e, e].max(initial=0))) + 1 for e in range(16)]
        book = vector_codes.Codebook.of(centres, reach)
        best, least = book.assign(parts, held)
        assert (best == nearest).all() and (least == ways.min(axis=1)).all()
    settled = vector_codes.Codebook.of(
        centres, [int(np.sqrt(ways[nearest == e, e].max())) + 1 for e in range(16)]
    )
    inside = [
        (4 * ways[nearest == e, e] < settled.ways[e][0]).mean() if len(settled.ways[e]) else 1.0
        for e in range(16)
    ]
    assert np.mean(inside) > 0.9


def test_vectors_that_do_not_fit_are_refused(spark):
    schema = "vec_id long, embedding array<double>, label int"
    for rows in ([(1, [0.5] * 12, 1)], [(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)], [(1, [1e30] * 8, 1)]):
        with pytest.raises(Exception, match="length|8192|overflow"):
            vector_codes.compress(spark.createDataFrame(rows, schema)).collect()
