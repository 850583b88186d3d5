"""The Jaccard join against brute force."""

import random
import re

import pytest

from skyweave.llm import components, jaccard
from skyweave.llm import rows as rows_module


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def brute(rows):
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(docs, **settings):
    return sorted((tuple(r) for r in jaccard.similar_documents(docs, **settings).collect()), key=repr)


@pytest.fixture(scope="module")
def rows(vocabulary):
    rng = random.Random(9)
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, base, hub = [], prose(90), prose(60)
    for k in range(25):  # copies of one original, linked to it and often not to each other
        words = list(hub)
        for _ in range(1 + k % 3):
            words[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append(" ".join(words))
    rows.append(" ".join(hub))
    for k in range(12):  # a chain: only neighbours link
        rows.append(" ".join(base[: 60 + k] if k < 6 else base[k : 60 + k]))
    passage = prose(30)
    rows += [" ".join(passage + prose(8)) for _ in range(8)]  # a shared passage, too little
    rows += ["one two", "ONE  two", "one two three four five", "one\ttwo three FOUR five", None, "", " \n ", "one two", "x"]
    numbered = [(100 - i, t) for i, t in enumerate(rows)]
    return [*numbered, (7, rows[0]), (7, rows[-3]), (None, rows[3]), (None, "only without an id at all here"), (200, " ".join(prose(6000)))]


def test_brute_force(make_docs, rows):
    assert found(make_docs(rows)) == brute(rows)


def test_small_chunks_and_few_buckets(make_docs, rows):
    assert found(make_docs(rows).repartition(3), chunk_bytes=4000, n_buckets=3) == brute(rows)


@pytest.mark.parametrize("block", [2, 1000])
def test_all_pairs(make_docs, rows, block):
    joined = jaccard.similar_pairs(make_docs(rows).repartition(2), block=block)
    pairs = [(bytes(r.a), bytes(r.b)) for r in joined.pairs.collect()]
    node = {}
    for r in joined.members.collect():
        node.setdefault(r.doc_id, bytes(r.node))
    sets = {node[d]: shingles(t) for d, t in rows if d is not None and d != 7}
    near = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    wanted = {(m, n) for m, a in sets.items() for n, b in sets.items() if m < n and near(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == wanted
    assert joined.members.count() == len(rows)


def test_texts_of_a_shingle_in_many_slots(make_docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    assert found(make_docs(rows)) == brute(rows)


def test_hot_copies_without_ids(make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_HOT", 1)
    text = "a b c d e f g h i j k l m n o p"
    rows = [(None, text), (None, text), (None, "x y"), (None, "x y"), (None, "x y"), (4, text + " q"), (4, ""), (4, "")]
    assert found(make_docs(rows)) == brute(rows)


def test_no_rows(make_docs):
    assert found(make_docs([])) == []


def test_first_of_each_group_stays(make_docs):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    docs = make_docs([(4, text), (2, text), (9, text + " more"), (5, "else"), (None, text), (6, None)])
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [2, 5, 6, None]


def test_prefix_length():
    assert [jaccard.prefix_length(n) for n in (1, 2, 4, 5, 100)] == [1, 1, 2, 2, 26]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (60, 50), (70, 60), (5, 5), (80, 81), (81, 80), (None, 3)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 70: 50, 100: 50, 80: 80, 81: 80}


def test_small_tables_take_few_files_and_rounds(spark, monkeypatch):
    tables = []

    def kept(*args):
        tables.append(rows_module.written(*args))
        return tables[-1]

    monkeypatch.setattr(components, "written", kept)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        edges = spark.range(1, 2001).selectExpr("id AS a", "id % 7 AS b").where("a > 6")
        roots = {r.node: r.root for r in components.components(edges).collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert roots == {**{n: n % 7 for n in range(7, 2001)}, **{n: n for n in range(7)}}
    assert [len(t.inputFiles()) for t in tables] == [1]
