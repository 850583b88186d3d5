"""Line dedup against brute force, and its keys."""

import random

from pyspark.sql import functions as F

from skyweave.llm import lines


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(rows, least=20):
    placed = [
        (doc, i, line) for doc, text in rows for i, line in enumerate((text or "").split("\n")) if line.strip(" \t\n\x0b\x0c\r")
    ]
    order = lambda p: (p[0] is None, p[0] or 0, p[1])
    out = {}
    for p in placed:
        long = len(p[2]) >= least
        stays = not any(
            order(q) < order(p) and (q[2] == p[2] or (long and len(q[2]) >= least and near(q[2], p[2]))) for q in placed
        )
        out.setdefault(p[0], set()).update([p[1]] if stays else [])
    return out


def found(docs):
    return {r.doc_id: set(r.kept) for r in lines.line_report(docs).collect() if r.n_lines}


def test_brute_force(make_docs):
    rng = random.Random(3)
    alphabet = "abcdé  "
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    base = [make(rng.randrange(18, 60)) for _ in range(12)] + [make(700), "short", "üüüüüüüüüüüüüüüüüüüüüü"]
    rows = []
    for doc in range(30):
        parts = []
        for _ in range(6):
            line = rng.choice(base)
            i = rng.randrange(len(line))
            parts.append(rng.choice([line, line[:i] + line[i + 1 :], line[:i] + "x" + line[i:], line[:i] + "y" + line[i + 1 :]]))
        rows.append((doc, "\n".join(parts)))
    rows += [(40, None), (41, ""), (42, "\n \n\t"), (None, base[0] + "\nonly without id, a longer line"), (43, base[12][:-1])]
    assert found(make_docs(rows)) == brute(rows)


def test_repeated_rows_keep_the_same_lines(make_docs):
    docs = make_docs([(1, "one line\nother line"), (1, "one line\nother line"), (2, "one line")])
    rows = sorted((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in lines.line_report(docs).collect())
    assert rows == [(1, 2, 0, [0, 1]), (1, 2, 0, [0, 1]), (2, 1, 1, [])]


def test_texts(make_docs):
    docs = make_docs([(1, "the same line\n\nanother"), (2, "first\nthe same line\n\nlast"), (3, None)])
    cut = lines.drop_lines(docs)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "the same line\n\nanother", 2: "first\n\nlast", 3: None}


def test_no_rows(make_docs):
    assert found(make_docs([])) == {}


def test_keys_meet_exactly_within_one_edit(spark):
    pairs = [("kitten", "sitten"), ("kitten", "kittn"), ("kitten", "kkitten"), ("kitten", "sittin"), ("ab", "ba"), ("a", "ab"), ("a", "b")]
    pairs += [("x" * 300 + "a" + "y" * 300, "x" * 300 + "y" * 300), ("x" * 600, "x" * 598), ("é" * 2100, "é" * 2099 + "e")]
    rows = spark.createDataFrame(pairs, "a string, b string")

    def keys(column):
        line = F.col(column)
        each = F.filter(
            F.transform(lines._surroundings(line, 1), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].isNotNull()
        )
        return F.flatten(F.transform(each, lambda s: lines.neighbourhood(line, s["i"], s["x"])))

    met = rows.select("a", "b", F.arrays_overlap(keys("a"), keys("b")).alias("met"))
    assert [r.met for r in met.collect()] == [near(a, b) for a, b in pairs]


def test_native(make_docs):
    plan = lines.line_report(make_docs([(1, "one line")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
