"""Manifests against a plain Merkle tree."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyweave.llm import merkle

COLUMNS = ("doc_id", "source", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests):
    """(root, path of each leaf: [(left, right), …])"""
    paths, owner, level = [[] for _ in digests], [[i] for i in range(len(digests))], list(digests)
    while len(level) > 1:
        above, owners = [], []
        for at in range(0, len(level), 16):
            run = level[at : at + 16]
            for k in range(len(run)):
                for i in owner[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h(*run))
            owners.append(sum(owner[at : at + 16], []))
        level, owner = above, owners
    return level[0], paths


def expected(rows):
    by = defaultdict(list)
    for i, text, source in rows:
        by[source].append((i, text))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        mine = sorted(by[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r[0], source, r[1])))
        digests = [leaf_of(i, source, t) for i, t in mine]
        trees.append((source, mine, digests, *tree(digests)))
    root, tops = tree([t[3] for t in trees])
    out = []
    for (source, mine, digests, subroot, paths), top in zip(trees, tops):
        for (i, text), digest, path in zip(mine, digests, paths):
            full = path + top
            now = digest
            if i is not None and zlib.crc32(str(i).encode()) % 5 == 0:
                now = leaf_of(i, source, None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for left, right in full:
                now = h(left, now, right)
            out.append((i, digest, subroot, root, h(*[a + b for a, b in full]), now, now == root))
    return sorted(out, key=repr)


def found(docs):
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    shown = merkle.check_rows(docs, F.translate("text", merkle.UPPER, merkle.LOWER), COLUMNS, changed=changed)
    assert shown.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(r) for r in shown.collect()], key=repr)


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        texts = [None, "", "lower only", "Some Upper", "é Ü", "x" * 100_000]
        rows += [(len(rows) + k, rng.choice(texts), source) for k in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 16}, {"a": 17}, {None: 1, "b": 3}, {"a": 300, None: 16, "é": 1, "z": 257, "Z": 33},
    {f"s{i:02}": 1 + i % 3 for i in range(20)},
])
def test_manifest(make_docs, sizes):
    rows = rows_of(sizes)
    assert found(make_docs(rows)) == expected(rows)


def test_repeated_and_null_ids(make_docs):
    rows = [(1, "A", "s"), (1, "A", "s"), (1, "B", "s"), (None, "A", "s"), (None, None, None), (2, "a", None)]
    assert found(make_docs(rows)) == expected(rows)


def test_empty_table(make_docs):
    assert found(make_docs([])) == []


def test_nodes_are_nested(make_docs, tmp_path):
    """Every node's interval is the union of its children's, and a change of one row changes its ancestors only."""
    rows = rows_of({"a": 40, "b": 18, None: 2})
    columns = [F.col(c) for c in COLUMNS]
    nodes = merkle.write_manifest(merkle.build_manifest(make_docs(rows), merkle.digest_of(columns)), str(tmp_path / "one"))
    one = {(r.part, r.level, r.lo, r.hi): r.digest for r in nodes.collect()}
    by = defaultdict(list)
    for part, level, lo, hi in one:
        by[part, level].append((lo, hi))
    for (part, level), spans in by.items():
        for lo, hi in spans if level else []:
            inside = sorted(s for s in by.get((part, level - 1), []) if lo <= s[0] and s[1] <= hi)
            if part == "source":
                assert inside[0][0] == lo and inside[-1][1] == hi and all(a[1] == b[0] for a, b in zip(inside, inside[1:]))
    changed = [(i, "other" if i == 5 else t, s) for i, t, s in rows]
    again = merkle.build_manifest(make_docs(changed), merkle.digest_of(columns)).nodes().collect()
    two = {(r.part, r.level, r.lo, r.hi): r.digest for r in again}
    assert one.keys() == two.keys()
    different = [k for k in one if one[k] != two[k]]
    assert len({k[:2] for k in different}) == len(different) >= 3


def test_levels_are_written_by_as_few_tasks_as_their_nodes_need(spark, make_docs):
    docs = make_docs([(i, f"text {i}", f"source {i % 3}") for i in range(400)]).repartition(16)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 16)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        manifest = merkle.build_manifest(docs, merkle.digest_of([F.col(c) for c in COLUMNS]))
        assert [len(level.inputFiles()) for level in (*manifest.levels, *manifest.top_levels)] == [1] * 3
        assert manifest.proofs().count() == 400
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
