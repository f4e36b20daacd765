"""Operators on single texts against brute force, on the smallest tables and on hostile rows."""

import hashlib
import random
import re
import zlib
from array import array

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_DIR
from tillspan.llm import bpe, fingerprints, html_extract, language_id, pii, queries, secret_scan, url_filter

WIDE = "doc_id long, text string, lang string, lang_pred string, score double, spans string"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def hostile(spark):
    """NULLs, an empty and a very long text, repeated rows, and columns that operators make themselves."""
    long = "x9" * 50_000 + " " + "7" * 50_000 + " a@b.cc"
    rows = [(1, None), (2, ""), (None, "Hello there, mail a.b@c.de now"), (4, long), (4, long), (5, "12 34"), (6, "é😀 ß")]
    return spark.createDataFrame([(i, t, None, "x", 0.5, "y") for i, t in rows], WIDE)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], WIDE)


# Personal data

BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: _is_card(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def _is_card(digits):
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))]
    return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0


def plain_spans(text):
    found = [
        (m.start(), order, f"{kind}:{m.start()}:{m.end()}")
        for order, (kind, (pattern, keep)) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if keep(m[0])
    ]
    return [s for _, _, s in sorted(found)]


def test_pii_against_plain_search(spark, documents):
    for row in queries.op5_pii(spark, SF_DIR).collect():
        base = plain_spans(documents[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(row["spans"].split(",")) | {""}
        assert row["n_email"] == sum(s.startswith("email") for s in base)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["1", "22", "4111 1111 1111 1111", "256", ".", "-", "+", " ", "@", "a", "x.y", "(", "\n", "é"]), max_size=25))
def test_pii_base_on_made_up_texts(parts):
    text = "".join(parts)
    found = [f"{kind}:{start}:{end}" for start, end, kind, _ in pii.spans_of(text) if kind in BASE]
    assert found == plain_spans(text)


def test_iban_needs_its_checksum_and_words_move_scores():
    assert [s[2] for s in pii.spans_of("IBAN GB82 WEST 1234 5698 7654 32 here")] == ["iban"]
    assert pii.spans_of("IBAN GB83 WEST 1234 5698 7654 32 here") == []
    assert [s[2] for s in pii.spans_of("ssn 078-05-1120")] == ["id"]
    assert pii.spans_of("order 078-05-1120") == []
    assert pii.mask("to a@b.cc!", pii.spans_of("to a@b.cc!")) == "to <email>!"


def test_pii_hostile(hostile, empty):
    rows = pii.pii_spans(hostile).collect()
    assert len(rows) == 7 and sum(r["n_email"] for r in rows) == 3
    assert pii.pii_spans(empty).collect() == []
    masked = pii.mask_pii(hostile)
    assert masked.columns == hostile.columns and masked.count() == 7
    assert masked.where("text LIKE '%@%'").count() == 0


# Secrets and URLs; their queries are compared with SQL in tests/test_oracle.py


def test_secrets_hostile(hostile, empty, spark):
    rows = secret_scan.secret_spans(hostile).collect()
    assert len(rows) == 7 and all(r["spans"] is not None for r in rows)
    assert secret_scan.secret_spans(empty).collect() == []
    key = "Zk3vQ9xLw7Rt2Yp5Hn8Bd4Mf6"
    texts = [f"key {key} end", "id 123e4567-e89b-12d3-a456-426614174000", f"EXAMPLE{key}", "tionthonereredthing1aaaaaaaaaaaaaaaaaaaa", f"token={key}"]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in secret_scan.secret_spans(made).collect()}
    assert found == {0: f"entropy:4:{4 + len(key)}", 1: "", 2: "", 3: "", 4: f"assign:0:{6 + len(key)}"}


def test_urls_hostile(spark):
    urls = [None, "", "nothing", "http://", "HTTP://A.NET/x?y#z", "x://net", "x://net/", "s://sub.example.net/en/1", "s://b.example.com/de/", "s://xnet/", "http://a.org/fr/?q"]
    pages = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)], "page_id long, url string, host string")
    rules = spark.createDataFrame(queries.URL_RULES + [(None, "/", "block")], "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.url_verdicts(pages, rules).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[4] == ("a.net", "/x", "net/", "block")
    assert got[5] == ("net", "", None, "allow") and got[6][2:] == ("net/", "block")
    assert got[7][2:] == ("example.net/en/", "allow") and got[8][2:] == ("example.com/de/", "block")
    assert got[9][2] is None and got[10][2:] == ("org/fr/", "allow")
    none = rules.limit(0)
    assert {r["verdict"] for r in url_filter.url_verdicts(pages, none, "block").collect()} == {"block"}
    # A filter of one block lets everything through; the join still decides.
    assert {r["page_id"]: r["rule"] for r in url_filter.url_verdicts(pages, rules, blocks=1).collect()} == {k: v[2] for k, v in got.items()}


# Byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(queries.VOCABULARY)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_against_library(spark, documents, library):
    for row in queries.op8_byte_level_bpe(spark, SF_DIR).collect():
        text = documents[row["doc_id"]]
        ids = library.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_made_up_texts(ranks, library):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["a", "th", "é", "日", " ", "1", "!", "\n", "😀", "tion"]), max_size=40).map("".join)))
    def check(text):
        assert list(array("I", encoder.encode(text))) == library.encode_ordinary(text)

    check()
    for text in ("ab" * 50_000, "é" * 30_000, " " * 20_000):
        assert list(array("I", encoder.encode(text))) == library.encode_ordinary(text)


def test_bpe_forgets_and_stays_right(ranks, library, monkeypatch, documents):
    for name, size in (("MAX_STEPS", 50), ("MAX_PIECES", 5), ("MAX_PAIRS", 20)):
        monkeypatch.setattr(bpe, name, size)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for text in list(documents.values())[:10]:
        assert list(array("I", encoder.encode(text))) == library.encode_ordinary(text)


def test_bpe_keeps_only_what_comes_again(ranks, library):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    draw = random.Random(3)
    once = sorted({"".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(5000)})
    text = " ".join(once)
    assert list(array("I", encoder.encode(text))) == library.encode_ordinary(text)
    assert len(encoder) < len(once) / 20
    # States stand for beginnings, which pieces share.
    assert len(encoder.transducer.steps) < 2 * len(once)
    for _ in range(2):
        assert list(array("I", encoder.encode(text))) == library.encode_ordinary(text)
    assert len(encoder) > len(once) * 0.95


def test_workers_give_memory_back_after_each_batch(monkeypatch):
    from types import SimpleNamespace

    from tillspan.llm import common

    given_back = []
    monkeypatch.setattr(common, "give_back_freed", lambda: given_back.append(1), raising=False)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name: "1000"))
    work = common.map_batches(SimpleNamespace(sparkSession=session, mapInArrow=lambda work, schema: work), lambda batches: batches, "x long")
    assert list(work(iter("abc"))) == ["a", "b", "c"] and len(given_back) == 3


@given(st.text(max_size=40), st.integers(1, 5))
def test_utf8_stream(text, size):
    stream, data = bpe.Utf8Stream(), text.encode()
    parts = [stream.feed(data[k : k + size]) for k in range(0, len(data), size)]
    assert "".join([*parts, stream.end()]) == text


def test_bpe_hostile(hostile, empty, ranks):
    rows = bpe.decode(bpe.encode(hostile, ranks, public_tokenizers.PATTERN), ranks).collect()
    texts = sorted(r["text"] or "" for r in hostile.collect())
    assert sorted(r["decoded"] for r in rows) == texts
    assert bpe.encode(empty, ranks, public_tokenizers.PATTERN).collect() == []


# Language


def test_language_held_out_accuracy(spark):
    rows = queries.op1_language_id(spark, "/root/testdata/sf0.01").collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) / len(held) > 0.97
    assert sum(r["rejected"] for r in rows) / len(rows) < 0.02
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_hostile(hostile, empty, spark):
    labelled = spark.createDataFrame([("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    model = language_id.learn(labelled)
    assert set(model) == {"en", "de"}
    got = [(r["doc_id"], r["lang_pred"], r["rejected"]) for r in language_id.predict(hostile, model).collect()]
    assert {g[1:] for g in got if g[0] in (1, 2, 5)} == {("und", True)} and len(got) == 7
    assert language_id.predict(empty, model).collect() == []
    assert {r["lang_pred"] for r in language_id.predict(hostile, language_id.learn(labelled.limit(0))).collect()} == {"und"}
    kept = language_id.keep_known(hostile, model)
    assert kept.columns == hostile.columns and kept.where("text IS NULL OR text = ''").isEmpty()


# Fingerprints


def test_fingerprints_against_sorted_list(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op3_document_fingerprints(spark, SF_DIR).collect()}
    ids = sorted(documents, reverse=True)
    assert set(rows) == set(ids)
    for k, i in enumerate(ids):
        text, following = documents[i], documents[ids[(k + 1) % len(ids)]]
        edited = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        row = rows[i]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = (set(fingerprints.paragraphs(t).tolist()) for t in (text, edited))
        assert row["near_edited"] == pytest.approx(1 - len(a ^ b) / max(1, len(a) + len(b)))
        assert row["edited_fingerprint"] == fingerprints.Version(edited).fingerprint()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 500), max_size=400), st.lists(st.integers(0, 500), max_size=400))
def test_sketches_give_the_exact_difference(a, b):
    one, two = (fingerprints.Version("\n".join(map(str, x))) for x in (a, b))
    only_one, only_two, _ = fingerprints.difference(one, two)
    left, right = set(one.digests.tolist()), set(two.digests.tolist())
    assert set(only_one.tolist()) == left - right and set(only_two.tolist()) == right - left


def test_fingerprints_hostile(hostile, empty):
    rows = fingerprints.fingerprints(hostile).collect()
    assert sorted(r["n_chars"] for r in rows) == sorted(len(r["text"] or "") for r in hostile.collect())
    assert fingerprints.fingerprints(empty).collect() == []
    (one,) = fingerprints.fingerprints(hostile.where("doc_id = 5")).collect()
    assert one["near_next"] == 1.0


# Pages


def test_main_text_of_articles(spark):
    import html

    got = {r["page_id"]: r["text"] for r in queries.op9_html_extraction(spark, SF_DIR).collect()}
    for row in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", inside))
        assert got[row["page_id"]] == re.sub(r"\s+", " ", html.unescape(plain)).strip()


def test_labeller_on_frames_it_was_not_shown(spark):
    import random

    weights = html_extract.learn(spark.read.parquet(f"{SF_DIR}/pages.parquet"))
    rng, right, all_ = random.Random(5), 0, 0
    texts = ["alpha beta gamma. delta epsilon", "uno dos tres cuatro cinco seis", "eins zwei drei. vier fünf"] * 5
    for _ in range(100):
        blocks = html_extract.blocks_of(html_extract.compose(texts, rng))
        labels = [text.startswith(html_extract._MARK) for _, text, _ in blocks]
        found = html_extract.scores(html_extract.vectors([(p, t.lstrip(html_extract._MARK), n) for p, t, n in blocks]), weights)
        right += sum(bool(s >= 0.5) == y for s, y in zip(found, labels, strict=True))
        all_ += len(labels)
    assert right / all_ > 0.97
    schema = "page_id long, url string, html string, text string"
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (3, "u", "<p", "x"), (4, "u", "<article><p>A &amp; <b>b</b>c<script>x</script></article>", "x")]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, schema), weights).collect()}
    assert got[1] == got[2] == "" and got[4] == "A & bc"
    assert html_extract.extract(spark.createDataFrame([], schema), weights).collect() == []
    assert html_extract.learn(spark.createDataFrame([], schema))


@pytest.mark.parametrize(
    "piece", ["<a ", "<div>x", "<div class=c>", "</p><div>", "<a \"", "<![CDATA[", "<!--x", "<!x", "<script>", "<", "<p class='a<b'>t", "&amp", "<b>x</i>"]
)
def test_hostile_pages_take_time_in_proportion(piece):
    import time

    start = time.process_time()
    blocks = html_extract.blocks_of("<p>begin</p>" + piece * (5_000_000 // len(piece)))
    assert time.process_time() - start < 60 and blocks[0][1].startswith("begin")


def test_blocks_of_odd_tags():
    texts = lambda page: [text for _, text, _ in html_extract.blocks_of(page)]
    assert texts("<div title='a > b'>x</div><p data-x=\"1 < 2\">y<p>z") == ["x", "y", "z"]
    assert texts("<title>no</title><head><p>no</p><body><p>a &lt; b</p>tail <!-- no") == ["a < b", "tail"]
    assert texts("</div></div><ul><li>one<li>two</ul>") == ["one", "two"]
    path = html_extract.blocks_of("<body><div class='x y'><div id=z><p>t")[0][0]
    assert path[-1] == "p" and set(path) == {"body", "div", ".x", ".y", ".z", "p"}


def test_ends_without_a_sentence_count():
    assert len(fingerprints.paragraphs("???")) == 1 and len(fingerprints.paragraphs("Hello.\n???\nworld")) == 3
    whole = "One. Two!? \n ... \n.5 a.b  three\n\n!!! x"
    assert "".join(fingerprints._PARAGRAPH.findall(whole)).replace(" ", "") == whole.replace(" ", "").replace("\n", "")
    assert fingerprints.difference(fingerprints.Version("???"), fingerprints.Version(""))[0].size == 1


def test_texts_without_a_letter_have_no_language():
    classifier = language_id.Classifier({"xx": [b" some words of a language "], "yy": [b" andere worte "]})
    for text in (None, "", " \n", "123 456", "\u00bd \u00b2", "\u2167", "!? \u2014", "\u0301"):
        assert classifier.predict(text) == ("und", 0.0, True)
    assert classifier.predict("some words of")[0] != "und"


def test_small_batches_hold_the_same_rows():
    import pyarrow as pa

    from tillspan.llm.common import small_batches

    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], ["x"]) for n in (0, 5, 2)]
    assert [b.column(0).to_pylist() for b in small_batches(iter(batches), 2)] == [[0, 1], [2, 3], [4], [0, 1]]


def test_operators_ask_for_small_batches(spark):
    import pyarrow as pa

    from tillspan.llm import common, pii

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        ids = spark.range(2500).coalesce(1)
        pii.mask_pii(ids.selectExpr("id AS doc_id", "'a' AS text"))
        sizes = ids.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches), "n long")
        assert [r["n"] for r in sizes.collect()] == [1000, 1000, 500]
        spark.conf.set(name, "300")
        common.map_batches(ids, lambda batches: batches, "id long")
        assert spark.conf.get(name) == "300"
    finally:
        spark.conf.set(name, before)
