"""Operators on whole corpora against brute force: the join, decontamination, licences and the pipeline."""

import random
import re
from array import array
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.conftest import SF_DIR
from tillspan.llm import bpe, decontaminate, language_id, licenses, ngram_join, pii, queries
from tillspan.llm.common import Scratch
from tillspan.llm.components import components, with_links

SCHEMA = "doc_id long, text string, component_id long, n long, a string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def all_pairs(rows, n=4, percent=85):
    """(id, size, component) by comparing every document with every other."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(x)] = find(y)
    groups = {}
    for k in range(len(sets)):
        groups.setdefault(find(k), []).append(sets[k][0])
    return sorted((sets[k][0], len(sets[k][1]), min(groups[find(k)])) for k in range(len(sets)))


def test_join_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op2_ngram_jaccard_join(spark, SF_DIR).collect())) == all_pairs(rows)


def test_join_of_edited_copies_and_hostile_rows(spark):
    rng = random.Random(3)
    rows = [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE two"), (905, "x " * 30_000), (906, "É é")]
    for family in range(6):
        words = [f"w{rng.randrange(400)}" for _ in range(120)]
        for k in range(25):
            rows.append((family * 25 + k, " ".join(words)))
            # A chain: every copy is an edit of the one before, so far ends are not similar.
            words[rng.randrange(len(words))] = f"new{family}_{k}"
    made = spark.createDataFrame([(i, t, 7, 7, "x") for i, t in rows], SCHEMA)
    got = ngram_join.near_duplicates(made)
    assert sorted(map(tuple, got.collect())) == all_pairs(rows)
    kept = ngram_join.one_of_each(made)
    assert kept.columns == made.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in all_pairs(rows)}
    assert ngram_join.near_duplicates(made.limit(0)).collect() == []


def test_join_with_repeated_and_missing_ids(spark):
    text = "a b c d e f g h"
    rows = [(5, text), (5, text), (5, "other words are in this one"), (3, text), (None, text), (None, None)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, ngram_join.near_duplicates(made).collect()), key=str)
    assert got == sorted([(5, 5, 3), (5, 5, 3), (5, 3, 5), (3, 5, 3), (None, 5, 3), (None, 0, None)], key=str)


def test_components_of_chains_and_stars(spark, tmp_path):
    links = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1100)] + [(7000, 7000)]
    df = spark.createDataFrame(links, "a long, b long")
    found = components(df, Scratch(spark, "test")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(roots) == len(found) == 301 + 100
    assert len({roots[k] for k in range(301)}) == 1 and len({roots[k] for k in range(1000, 1100)}) == 1
    assert roots[0] != roots[1000]


def test_rounds_of_components_have_tasks_for_their_links(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long")
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    scratch = Scratch(spark, "test")
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        assert len({r["root"] for r in components(links, scratch).collect()}) == 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    tables = Path(scratch.folder.removeprefix("file:"))
    files = {k: len([*(tables / str(k)).glob("part-*")]) for k in range(1, scratch.count + 1)}
    # How many links there are is not known before the first table is written.
    assert files.pop(1) > 1 and set(files.values()) == {1}


def test_components_with_later_links(spark):
    scratch = Scratch(spark, "test")
    made = lambda links: spark.createDataFrame(links, "a long, b long")
    roots = components(made([(k, k + 1) for k in range(0, 200, 2)]), scratch)
    # Links of pairs that are known, of their other ends, of a new node and of new nodes alone.
    later = [(0, 1), *((k, k + 3) for k in range(0, 100, 2)), (150, 5000), (6000, 6001), (7000, 7000)]
    found = with_links(roots, made(later), scratch).collect()
    got = {}
    for r in found:
        got.setdefault(r["root"], set()).add(r["node"])
    chain = set(range(102))
    pairs = [{k, k + 1} for k in range(102, 200, 2) if k != 150]
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, [chain, {150, 151, 5000}, {6000, 6001}, *pairs]))
    assert len(found) == 200 + 3 and all(root in nodes for root, nodes in got.items())
    assert sorted(map(tuple, with_links(roots, made([]), scratch).collect())) == sorted(map(tuple, roots.collect()))


def test_decontamination_of_hostile_rows(spark):
    ten = " ".join(f"T{k}" for k in range(10))
    docs = [(1, None), (2, ""), (3, f"...x {ten}, y"), (3, f"...x {ten}, y"), (4, "t0 t1 t2"), (5, "Äb;äb"), (None, f"{ten} {ten}"), (6, "short item here")]
    items = [(1, ten), (1, ten), (2, None), (3, ""), (4, "SHORT item"), (None, "äb")]
    documents = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n_hit int")
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = sorted([(r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"]) for r in decontaminate.contamination(documents, benchmark).collect()])
    assert got == [(0, 20, 20, 1), (1, 0, 0, 0), (2, 0, 0, 0), (3, 12, 10, 1), (3, 12, 10, 1), (4, 3, 0, 0), (5, 2, 1, 0), (6, 3, 2, 1)]
    kept = decontaminate.clean(documents, benchmark)
    assert kept.columns == documents.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4]
    assert decontaminate.contamination(documents.limit(0), benchmark).collect() == []
    assert decontaminate.contamination(documents, benchmark.limit(0)).where("contaminated").isEmpty()


def in_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def near_places(text, items, window, slack):
    """(places, items) of the near passages of a text, by looking at every place."""
    words, places, found = in_words(text), set(), set()
    for item, content in items:
        test = in_words(content)
        for k in range(len(test) - window + 1):
            phrase = test[k : k + window]
            for b in range(len(words)):
                around = words[b : b + window + slack]
                enough = all(around.count(w) >= phrase.count(w) for w in phrase)
                if words[b] in phrase and enough and not any(around[j : j + window] == phrase for j in range(slack + 1)):
                    places.add(b)
                    found.add(item)
    return len(places), sorted(str(i) for i in found if i is not None)


@pytest.mark.parametrize("few", [True, False])
def test_near_passages(spark, monkeypatch, few):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 10**6 if few else 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", 10**6 if few else 0)
    rng = random.Random(12)
    some = lambda n, of: " ".join(rng.choice(of) for _ in range(n))
    items = [(1, some(9, "abcdefgh")), (2, "x x y z z"), (2, some(12, "abcdefghijkl")), (3, "a b"), (None, some(6, "efghij")), (4, None)]
    docs = [(k, some(rng.randrange(80), rng.choice(["abcdefgh", "xyz", "abcdefghijklxyz"]))) for k in range(60)]
    docs += [(None, "A,b;C d e"), (None, "x y x z z"), (7, None), (8, ""), (9, "x " * 400 + "y z z"), (9, "x " * 400 + "y z z")]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.near_passages(documents, benchmark, window=5, slack=3).collect()
    want = [(i, *near_places(t or "", [(i, c) for i, c in items if c], 5, 3)) for i, t in docs]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(n > 0 for _, n, _ in want) > 20


def test_one_long_document_stays_small(spark):
    # With a row of all words per word this took gigabytes.
    item = " ".join(f"w{k}" for k in range(10))
    text = " ".join(f"w{k % 10}" if k % 13 else "other" for k in range(60_000))
    documents = spark.createDataFrame([(1, text)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    n_near, _ = near_places(text[:3000], [(1, item)], 10, 2)
    got = decontaminate.near_passages(documents, benchmark).collect()[0]
    assert n_near > 0 and got["n_near"] > 1000
    assert decontaminate.clean(documents.withColumnRenamed("x", "_bad"), benchmark, slack=2).isEmpty()


def test_licences(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."),
        (2, "a/b/x.py", "code"),
        (3, "a/b/c/LICENSE", "Licensed under the Apache License, Version 2.0."),
        (4, "a/b/c/d/y.py", ""),
        (4, "a/b/c/d/y.py", ""),
        (5, "z.py", None),
        (6, None, "text " * 50 + "\nThis work is licensed under the GNU General Public License, version 3."),
        (7, "ab/x", "Licensed to drive, said the man about his licence"),
    ]
    files = spark.createDataFrame([(*r, "clash") for r in rows], "id long, path string, text string, license string")
    got = sorted((r["id"], r["license"], r["how"]) for r in licenses.license_scan(files).collect())
    assert got == [
        (1, "MIT", "file"), (2, "MIT", "inherited"), (3, "Apache-2.0", "file"), (4, "Apache-2.0", "inherited"),
        (4, "Apache-2.0", "inherited"), (5, None, "none"), (6, "GPL-3.0", "header"), (7, None, "none"),
    ]
    assert licenses.license_scan(files.limit(0)).collect() == []


def test_licence_lines_of_the_documents(spark):
    found = {r["doc_id"]: r["license"] for r in queries.op10_license_scans(spark, SF_DIR).where("how IN ('header', 'file')").collect()}
    wanted = {}
    for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        for line in row["text"].split("\n"):
            wanted.update({row["doc_id"]: name for name, text in licenses.TEMPLATES if text == line.strip()})
    assert found == wanted


@pytest.fixture(scope="module")
def piped(spark):
    return {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}


def test_pipeline_against_brute_force(spark, piped):
    source = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language_id.learn(source.where(~language_id.held_out(source["doc_id"])))
    classifier = language_id.Classifier(model)
    docs = [(r["doc_id"], r["text"]) for r in source.collect() if not classifier.predict(r["text"])[2]]
    first = {i for i, _, c in all_pairs(docs, corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT) if i == c}
    docs = [(i, t) for i, t in docs if i in first]
    windows = set()
    for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        item = in_words(row["text"])
        windows |= {tuple(item[k : k + 10]) for k in range(max(1, len(item) - 9)) if item}

    def leaks(words, slack=decontaminate.SLACK):
        for b in range(len(words)):
            around = words[b : b + 10 + slack]
            for window in windows:
                if tuple(words[b : b + len(window)]) == window:
                    return True
                if len(window) == 10 and words[b] in window and all(around.count(w) >= window.count(w) for w in window):
                    return True
        return False

    docs = [(i, t) for i, t in docs if not leaks(in_words(t))]
    ranks = bpe.read_ranks(queries.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = {i: library.encode_ordinary(pii.mask(t, pii.spans_of(t))) for i, t in docs}
    assert {i: list(array("I", r["ids"])) for i, r in piped.items()} == wanted


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumnRenamed("n_chars", "score").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_header_texts_are_not_shuffled_with_their_words(spark):
    rows = [("Released under the MIT License.", 2), ("Licensed under the Apache License, Version 2.0.", 1), ("Licensed to drive", 5)]
    headers = spark.createDataFrame(rows, "header string, files long")
    templates = spark.createDataFrame(licenses.TEMPLATES, "license string, template string")
    scores = licenses.header_scores(headers, templates)
    assert sorted(r["license"] for r in scores.collect()) == ["Apache-2.0", "MIT"]
    assert "hashpartitioning(header#" not in scores._jdf.queryExecution().executedPlan().toString()
