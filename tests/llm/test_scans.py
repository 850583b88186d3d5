"""Decontamination and license scans against brute force."""

import random
import re

import pytest

from skyweave.llm import decontaminate, licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, length=10):
    out = []
    for doc, text in docs:
        have, hit, names = words(text), set(), set()
        for item, item_text in items:
            need = words(item_text)
            for window in {tuple(need[i : i + length]) for i in range(max(1, len(need) - length + 1))} - {()}:
                for i in range(len(have) - len(window) + 1):
                    if tuple(have[i : i + len(window)]) == window:
                        hit.update(range(i, i + len(window)))
                        names.update({item} - {None})
        out.append((doc, len(have), len(hit), sorted(names)))
    return sorted(out, key=repr)


def found(docs, items, **settings):
    rows = decontaminate.find_contamination(docs, items, out="c", **settings).collect()
    return sorted(((r.doc_id, r.c.n_words, sum(h.end - h.start for h in r.c.hits), list(r.c["items"])) for r in rows), key=repr)


@pytest.fixture(scope="module")
def case(vocabulary):
    rng = random.Random(2)
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    long, short, accents = prose(25), prose(4), ["Été", "naïve", "ß", *prose(9)]
    items = [(1, " ".join(long)), (2, ", ".join(short)), (3, " ".join(accents)), (4, " ".join(long[5:20])), (5, None), (6, "..."), (None, "x y")]
    items += [(10, " ".join(long))]
    docs = [
        (1, " ".join(prose(20) + long + prose(20))), (2, " ".join(prose(5) + long[3:13] + prose(5)).upper()), (3, " ".join(long[:9])),
        (4, " ".join(short) + "! " + "-".join(short)), (5, None), (6, ""), (7, "...!"), (8, " ".join(prose(4000) + long[2:14] + prose(10))),
        (9, " ".join(accents)), (9, " ".join(accents)), (None, " ".join(long + long)), (11, " ".join(prose(50))),
    ]
    return docs, items


def test_contamination(spark, make_docs, case):
    docs, items = case
    table = spark.createDataFrame(items, "item_id long, text string")
    assert found(make_docs(docs), table) == brute(docs, items)
    assert found(make_docs(docs), table, part_bytes=60) == brute(docs, items)
    assert found(make_docs(docs).repartition(3), table, window=4) == brute(docs, items, 4)


def test_items_without_an_id_mark_words(spark, make_docs):
    items = [(None, "alpha beta"), (None, None), (3, "beta gamma")]
    docs = [(1, "so alpha beta it is"), (2, "Alpha Beta Gamma"), (3, "alpha, gamma")]
    table = spark.createDataFrame(items, "item_id long, text string")
    for settings in ({}, {"part_bytes": 1}):
        assert found(make_docs(docs), table, **settings) == [(1, 5, 2, []), (2, 3, 3, [3]), (3, 2, 0, [])]
    assert [r.doc_id for r in decontaminate.decontaminate(make_docs(docs), table).collect()] == [3]


def test_parts_find_what_one_pass_finds(spark, make_docs, case):
    """Runs that touch are one run of words and of bytes, also where their items are in different parts."""
    items = [(1, "alpha beta"), (2, "gamma delta"), (3, "beta gamma"), (4, "omega"), *case[1]]
    docs = [(20, "so Alpha beta, gamma delta - omega it is"), (21, None), *case[0]]
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        sorted((repr(r.c.asDict(True)) for r in decontaminate.find_contamination(make_docs(docs), table, out="c", **s).collect()))
        for s in ({}, {"part_bytes": 1}, {"part_bytes": 40, "keep": ["doc_id"]})
    ]
    assert rows[0] == rows[1] == rows[2]
    clean = decontaminate.decontaminate(make_docs([docs[0]]), table, remove="spans", part_bytes=1).collect()
    assert [r.text for r in clean] == ["so  it is"]


def test_no_rows(spark, make_docs, case):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert found(make_docs([]), empty) == []
    assert found(make_docs(case[0]), empty) == brute(case[0], [])


def test_removal(spark, make_docs):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = make_docs([(1, "é, Alpha beta-GAMMA! end"), (2, "clean"), (3, None)])
    whole = decontaminate.decontaminate(docs, items)
    spans = decontaminate.decontaminate(docs, items, remove="spans")
    assert whole.columns == spans.columns == docs.columns
    assert sorted(r.doc_id for r in whole.collect()) == [2, 3]
    assert {r.doc_id: r.text for r in spans.collect()} == {1: "é, ! end", 2: "clean", 3: None}


def brute_licenses(docs):
    """Every window of two blocks, compared in full."""
    out = []
    for doc, text in docs:
        have = words(text)
        for name, template in licenses.TEMPLATES:
            need = words(template)
            k = min(5, len(need))
            wanted = {tuple(need[i : i + k]) for i in range(len(need) - k + 1)}
            n, mine = len(wanted), [tuple(have[i : i + k]) for i in range(len(have) - k + 1)]
            best = max((len(wanted & set(mine[a : a + 2 * n])) for a in range(0, len(mine), n)), default=0)
            if 100 * best >= 75 * n:
                out.append((doc, name, best, n))
    return sorted(out, key=repr)


def test_licenses(make_docs, vocabulary):
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [f"{prose(rng.randrange(40))}\n{t}\n{prose(rng.randrange(40))}" for _, t in licenses.TEMPLATES for _ in range(3)]
    permission = dict(licenses.TEMPLATES)["mit-permission"]
    cut = permission.split()
    texts += [permission.upper(), " ".join(cut[:70]), " ".join(cut[:40]), " ".join(cut[:30] + ["changed"] + cut[31:]), None, "", prose(3000)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[0])]
    rows = licenses.scan_licenses(make_docs(docs)).collect()
    assert sorted(((r.doc_id, r.license, r.shingles_held, r.shingles) for r in rows), key=repr) == brute_licenses(docs)
    assert licenses.scan_licenses(make_docs([])).count() == 0


def test_bands_keep_misses_rare():
    for n in (1, 2, 7, 60):
        held = -(-n * 75 // 100)
        assert (1 - held / (3 * n - held)) ** licenses.bands_for(n) <= licenses.MISS
