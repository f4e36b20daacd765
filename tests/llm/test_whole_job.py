"""Cases a reviewer found where an operator did less than its whole job."""

import random
import re

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm.test_corpus import lowered
from tillspan.llm import decontaminate, fingerprints, licenses, ngram_join, pii


def likeness_of_shingles(one, two, n):
    sets = []
    for text in (one, two):
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        sets.append({tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))})
    return len(sets[0] & sets[1]), len(sets[0] | sets[1])


def smallest_ids(rows, n, percent):
    """The smallest id of every group, by comparing all pairs."""
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for x in range(len(rows)):
        for y in range(x):
            common, all_ = likeness_of_shingles(rows[x][1], rows[y][1], n)
            if 100 * common >= percent * all_:
                root[find(x)] = find(y)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    return {min(ids) for ids in groups.values()}


def test_pipeline_drops_near_copies_from_four_fifths(spark):
    rng = random.Random(8)
    rows, between = [], 0
    for family in range(30):
        words = [f"w{rng.randrange(4000)}" for _ in range(400)]
        rows.append((2 * family, " ".join(words)))
        # A new passage of 32, 38 or 44 words: similarities of 0.83, 0.81 and 0.78, and less than 0.85 in shingles of four.
        for place in range(100, 132 + 6 * (family % 3)):
            words[place] = f"new{family}_{place}"
        rows.append((2 * family + 1, " ".join(words)))
        common, all_ = likeness_of_shingles(rows[-2][1], rows[-1][1], 5)
        between += 80 <= 100 * common / all_ < 85
    assert between == 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.distinct_texts(spark, docs, SF_DIR).collect()}
    assert kept == smallest_ids(rows, 5, 80) and len(kept) == 40
    assert {r["component_id"] for r in ngram_join.near_duplicates(docs).collect()} == smallest_ids(rows, 4, 85) == {i for i, _ in rows}


def test_full_licence_texts_and_wrapped_headers(spark):
    names = ["AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "ISC", "MIT"]
    texts = licenses.full_texts()
    rows, wanted = [], []
    for k, name in enumerate(names):
        # Another holder, other lines.
        words = f"Copyright (c) 2019 Some Body and others {texts[name]}".split()
        rows.append((k, f"{name}/LICENSE", "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))))
        rows.append((100 + k, f"{name}/src/x.py", "print(1)"))
        wanted += [(k, name, "file"), (100 + k, name, "inherited")]
    code = "\nx = compute(y)\nwhile x: y(x)" * 60
    bsd = "\n".join(f" * {line}" for line in texts["BSD-3-Clause"].splitlines())
    for k, text, name in [
        (200, "/* This file is part of it.\n * It is licensed under the GNU Lesser General\n * Public License, version 3. */" + code, "LGPL-3.0"),
        (201, "Some words about the weather of today. " * 20 + "Licensed under the Apache License, Version 2.0. And more of these words here. " * 2 + code, "Apache-2.0"),
        (202, "# Permission is hereby granted, free of charge, to any person obtaining\n# a copy of this software and associated"
              " documentation files (the\n# Software), to deal in the Software without restriction" + code, "MIT"),
        (203, f"/*\n{bsd}\n*/" + code, "BSD-3-Clause"),
        (204, "A long story of the copyright of the work and the terms of this program." + code, None),
    ]:
        rows.append((k, f"src/{k}.c", text))
        wanted.append((k, name, "header" if name else "none"))
    files = spark.createDataFrame(rows, "id long, path string, text string")
    assert sorted((r["id"], r["license"], r["how"]) for r in licenses.license_scan(files).collect()) == sorted(wanted)


def test_ibans_before_words_and_numbers():
    for text, accounts in [
        ("account DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", ["DE89 3704 0044 0532 0130 00"]),
        ("pay DE89370400440532013000 EUR 500", ["DE89370400440532013000"]),
        ("GB82 WEST 1234 5698 7654 32 DE89370400440532013000 NOW", ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]),
        ("REF AB12 DE89 3704 0044 0532 0130 00 AND", ["DE89 3704 0044 0532 0130 00"]),
        ("DE88 3704 0044 0532 0130 00 EUR", []),
    ]:
        assert [text[s:e] for s, e, kind, _ in pii.spans_of(text) if kind == "iban"] == accounts
        assert not any(a in pii.mask(text, pii.spans_of(text)) for a in accounts)


def test_differences_of_millions_of_paragraphs():
    one, two = (fingerprints.Version(f"{line}\n" * 1_550_000) for line in ("ab", "cd"))
    only_one, only_two, _ = fingerprints.difference(one, two)
    assert (sorted(only_one.tolist()), sorted(only_two.tolist())) == (sorted(one.digests.tolist()), sorted(two.digests.tolist()))


def test_passages_with_words_put_in(spark):
    item = [f"word{k}" for k in range(40)]
    spread = [w for k, w in enumerate(item) for w in ([w, "new"] if k % 9 == 8 else [w])]
    docs = [(1, "before " + " ".join(spread)), (2, " ".join(item)), (3, " ".join(item[:9])), (4, " ".join(w + " a b c" for w in item)), (None, None)]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: (r["n_near"] > 0, r["near_items"]) for r in decontaminate.near_passages(documents, benchmark).collect()}
    assert got == {1: (True, ["7"]), 2: (False, []), 3: (False, []), 4: (False, []), None: (False, [])}
    assert {r["doc_id"] for r in decontaminate.clean(documents, benchmark).collect()} == {1, 3, 4, None}
    assert {r["doc_id"] for r in decontaminate.clean(documents, benchmark, slack=2).collect()} == {3, 4, None}


def test_pairs_drawn_from_a_large_group_of_near_copies(spark, monkeypatch):
    rng = random.Random(21)
    passage = [f"w{k}" for k in range(150)]
    # Every other copy is far from all others; the shortest one comes first in the lists and is far, too.
    rows = [(0, " ".join([f"odd{k}" for k in range(30)] + passage[30:149]))]
    for k in range(1, 201):
        words = list(passage)
        for place in rng.sample(range(150), 1 if k % 2 else 6):
            words[place] = f"new{k}_{place}"
        rows.append((k, " ".join(words)))
    # Turns of drawn pairs from the first open list on.
    monkeypatch.setattr(ngram_join, "OPEN_PAIRS", 0)
    turns, drawn = [], ngram_join._drawn

    def counted(open_lists, turn, band):
        pairs = drawn(open_lists, turn, band)
        turns.append((open_lists.count(), pairs.count(), pairs.where("x.root = y.root").count()))
        return pairs

    monkeypatch.setattr(ngram_join, "_drawn", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["component_id"] for r in ngram_join.near_duplicates(docs).collect()}
    assert got == smallest_ids(rows, 4, 85) and len(got) < 110
    assert turns and all(0 < made <= ngram_join.DRAWN * entries and same == 0 for entries, made, same in turns)


def test_drawn_pairs_tell_how_many_pairs_a_list_holds(spark):
    # 120 entries of a list in 60 components, and 80 of another in two.
    rows = [(1, k, 100, 0, k // 2) for k in range(120)] + [(2, k, 100, 0, k % 2) for k in range(200, 280)]
    lists = spark.createDataFrame(rows, "token long, cls long, n long, pos int, root long")
    drawn = ngram_join._drawn(lists, 1, lambda n: n * 0)
    got = {r["many"]: r["all"] for r in drawn.groupBy((drawn["y.cls"] < 200).alias("many")).agg({"stands_for": "sum"}).toDF("many", "all").collect()}
    assert abs(got[True] - (120 * 119 // 2 - 60)) < 0.05 * 7080 and abs(got[False] - 40 * 40) < 0.25 * 1600
