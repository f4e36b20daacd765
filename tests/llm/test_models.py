"""Importance resampling, SentencePiece and whitening against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tests.conftest import SF_DIR
from tests.llm.test_corpus import lowered
from tillspan.llm import queries, resampling, sentencepiece_bpe, whitening

# ---------------------------------------------------------------- op11


def grams(text, shortest, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    return words, [" ".join(words[k : k + n]) for n in range(shortest, longest + 1) for k in range(len(words) - n + 1)]


def resampled(documents, target, shortest=1, longest=1, buckets=10_000, least_words=20, percent=10):
    """The contract, one document after the other."""
    bucket = lambda gram: crc32(gram.encode()) % buckets
    s = Counter(bucket(g) for _, text in documents for g in grams(text, shortest, longest)[1])
    t = Counter(bucket(g) for text in target for g in grams(text, shortest, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    scored = []
    for doc_id, text in documents:
        words, found = grams(text, shortest, longest)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(g)) for g in found)
        scored.append((doc_id, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long = sorted((row for row in scored if row[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {id(row): k + 1 for k, row in enumerate(long[: len(long) * percent // 100])}
    return [(r[0], r[2], r[3], r[4], ranks.get(id(r))) for r in scored]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


def test_resampling_on_the_given_tables(spark):
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = queries.op11_importance_resampling(spark, SF_DIR)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 5
    assert in_order(map(tuple, got.collect())) == in_order(resampled(documents, target))


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_of_hostile_rows(spark, longest):
    rng = random.Random(longest)
    documents = [(None, "no id " * 30), (1, None), (2, ""), (3, "...!"), (4, "É ß 日本 A-B_c" * 9), (5, "same " * 40), (5, "same " * 40)]
    documents += [(100 + k, " ".join(rng.choice("the cat Sat on a mat x9 \n\n ; über".split(" ")) for _ in range(rng.randrange(60)))) for k in range(60)]
    documents += [(900, "word " * 200_000), (901, "q" * 300_000)]
    target = [None, "", "the mat", "the cat the cat"]
    features = lambda: resampling.Features(1, longest, 97)
    docs = spark.createDataFrame([(i, t, 7) for i, t in documents], "doc_id long, text string, weight long").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs, goal, features, least_words=5, percent=37)
    assert in_order(map(tuple, got.collect())) == in_order(resampled(documents, target, 1, longest, 97, 5, 37))


def test_resampling_of_empty_tables(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert resampling.resample(nothing, some).collect() == []
    assert [r["rank"] for r in resampling.resample(some, nothing, least_words=1, percent=100).collect()] == [1]


def test_batches_are_joined_without_ngrams_across_documents():
    texts = [b"a b", b"", b"b", b"c a b"]
    owner, bucket, n_words = resampling.Features(1, 3, 10**9)(texts)
    want = [(k, crc32(" ".join(w[p : p + n]).encode()) % 10**9) for n in (1, 2, 3) for k, t in enumerate(texts) for w in [t.decode().split()] for p in range(len(w) - n + 1)]
    assert sorted(zip(owner.tolist(), bucket.tolist(), strict=True)) == sorted(want)
    assert n_words.tolist() == [2, 0, 1, 3]


# ---------------------------------------------------------------- op12

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece_bpe.read_model(MODEL)


def unpacked(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_pieces_of_documents(spark, library):
    documents = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in queries.op12_sentencepiece(spark, SF_DIR).collect():
        ids = library.encode(documents[row["doc_id"]], add_eos=True)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


HOSTILE = [
    "", " ", "  hi  ", "a\nb", "▁x▁▁", "a\0b", "é", "日本語 한국어", "<s> </s> <0x0A> <unk>", "a" * 1000, " " * 37, "x" + " " * 5000 + "y",
    "=" * 500, "\t\t \n\n", "🤷🏽‍♀️ \U0010ffff ", "-_" * 300, "ཨ" * 50, "  ",
]


def test_pieces_of_hostile_texts(vocabulary, library):
    encoder, decoder = sentencepiece_bpe.Encoder(vocabulary), sentencepiece_bpe.Decoder(vocabulary)
    rng = random.Random(5)
    alphabets = ["ab ", "  a\n", "stion er", "=-_*# ", "abcdefghijklmnopqrstuvwxyz ", "日本語中文あいう ", "éàüßñ aeiou"]
    pieces = sorted(encoder.merger.known)
    texts = HOSTILE + ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(200))) for _ in range(500)]
    texts += ["".join(rng.choice(alphabets[k % len(alphabets)]) for _ in range(rng.randrange(150))) for k in range(700)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(500)]
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        ids = library.encode(text, add_eos=True)
        assert unpacked(packed) == ids, text
        assert decoder.decode(packed) == library.decode(ids)


def test_forgetting_words_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "REMEMBERED", 50)
    monkeypatch.setattr(sentencepiece_bpe, "AT_ONCE", 20)
    encoder, rng = sentencepiece_bpe.Encoder(vocabulary), random.Random(2)
    for _ in range(30):
        texts = [" ".join(rng.choice("alpha beta gamma delta epsilon extraordinarily zeta".split()) for _ in range(9)) for _ in range(4)]
        assert [unpacked(p) for p in encoder.encode(texts)] == library.encode(texts, add_eos=True)


def test_long_texts_without_blanks(vocabulary, library):
    rng = random.Random(4)
    encoder = sentencepiece_bpe.Encoder(vocabulary)
    for text in ("".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000)), "a" * 1_000_000, " " * 500_000):
        assert unpacked(encoder.encode([text])[0]) == library.encode(text, add_eos=True)


def test_any_ids_decode_as_in_the_library(vocabulary, library):
    decoder, rng = sentencepiece_bpe.Decoder(vocabulary), random.Random(6)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randrange(12))]
        assert decoder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_columns_nulls_and_repeated_rows(spark, vocabulary, library):
    rows = [(1, None, "x"), (1, "hello world", "y"), (1, "hello world", "y"), (None, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spelled_ string")
    got = sentencepiece_bpe.encode(df, vocabulary, spelled="spelled", back="decoded").collect()
    ids = library.encode("hello world", add_eos=True)
    assert sorted((str(r["doc_id"]), r["spelled"], r["decoded"], r["spelled_"]) for r in got) == sorted(
        [("1", "2", "", "x"), *[("1", " ".join(map(str, ids)), "hello world", "y")] * 2, ("None", "2", "", "z")]
    )
    back = sentencepiece_bpe.decode(sentencepiece_bpe.encode(df, vocabulary), vocabulary, to="again")
    assert sorted(r["again"] for r in back.collect()) == ["", "", "hello world", "hello world"]
    assert sentencepiece_bpe.encode(df.limit(0), vocabulary).collect() == []


# ---------------------------------------------------------------- op13


def plain_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, u = np.linalg.eigh(centred.T @ centred / n)
    values, u = values[::-1], u[:, ::-1]
    whole = x.astype(object) * n - sums.astype(object)
    return (whole**2).sum(1).tolist(), centred @ (u[:, :k] / np.sqrt(values[:k])), values[:k] / values.sum()


def held(found, vectors, k=8):
    """Compares whitened rows, whose ids are 0, 1, 2..., with the plain version up to the sign of each component."""
    deviations, z, explained = plain_whitening(vectors, k)
    rows = sorted(map(tuple, found.collect()))
    assert [r[:2] for r in rows] == [(i, c + 1) for i in range(len(vectors)) for c in range(k)]
    got = np.array([r[4] for r in rows]).reshape(-1, k)
    assert [r[3] for r in rows[::k]] == deviations
    assert np.allclose([r[5] for r in rows[:k]], explained, rtol=1e-9)
    assert np.abs(got * np.sign((got * z).sum(0)) - z).max() < 1e-8
    assert {r[2] for r in rows} == {len(vectors)} and rows[0][6] < 1e-10


def test_whitening_of_the_given_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in table] == list(range(len(table)))
    held(queries.op13_embedding_whitening(spark, SF_DIR), [r["embedding"] for r in table])


@pytest.mark.parametrize("kind", ["steep", "flat", "tied", "narrow"])
def test_whitening_of_spectra(spark, kind):
    rng = np.random.default_rng(3)
    dims = 6 if kind == "narrow" else 48
    spread = {"steep": 0.6 ** np.arange(dims), "flat": np.full(dims, 0.5), "tied": np.repeat([3.0, 1.0], [2, dims - 2]), "narrow": np.ones(dims)}[kind]
    turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    vectors = ((rng.standard_normal((400, dims)) * spread) @ turn).astype(np.float32).tolist()
    if kind == "steep":
        vectors[7] = vectors[8] = [500.0] * dims  # far away, and deviations that need more than 53 bits
    k = min(8, dims)
    df = spark.createDataFrame([(i, v, 1.0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, whitened double").repartition(7)
    held(whitening.whiten(df, 8), vectors, k)


def test_whitening_drops_what_it_must_and_bears_the_rest(spark):
    rng = np.random.default_rng(9)
    good = rng.standard_normal((40, 5)).tolist()
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf")] + [0.0] * 4, [1.0, 2.0]]
    rows = [*enumerate(good), *[(None, v) for v in bad]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    held(whitening.whiten(df, 3), good, 3)
    # Two different vectors span one component, one vector none.
    two = spark.createDataFrame([(None, [0.0, 1.0]), (None, [0.0, 1.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted((r["component"], r["n"]) for r in whitening.whiten(two).collect()) == [(1, 3)] * 3
    for nothing in (df.limit(0), df.where("vec_id IS NULL").where("size(embedding) = 0"), spark.createDataFrame([(1, [2.0])] * 5, df.schema)):
        assert whitening.whiten(nothing).collect() == []


def test_deviations_beyond_a_long_are_null(spark):
    vectors = [[2.0**39, 0.0], [-(2.0**39), 0.0], [0.0, 1.0]]
    got = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"), 1).collect()
    assert sorted((r["vec_id"], r["deviation"] is None) for r in got) == [(0, True), (1, True), (2, False)]
