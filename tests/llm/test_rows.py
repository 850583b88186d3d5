"""Quality rules, chat formatting, sharding, mixing and URL rules on small tables."""

import itertools
import json
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skyweave.llm import chat, mixing, quality, rows, sharding, urls

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    base = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    symbols, shouts = len(re.findall(r"[#*$%&|<>]", text)), text.count("!!")
    stops = len(set(words) & set(quality.STOP_WORDS))
    chars, n = sum(map(len, words)), len(words)
    dups = len(lines) - len(set(lines))
    kept = 100 * symbols <= 10 * n and 100 * shouts <= 20 * n and 250 * n <= 100 * chars <= 1200 * n and 100 * dups <= 50 * len(lines)
    return n, chars, symbols, dups, len(repeated), base, not base and kept and stops >= 2


TEXTS = [
    None, "", " \n\t", "word", "the cat of " * 40, " ".join(f"the word{i} of" for i in range(60)), "a b c a b c", "x\nx\n\nx\ny",
    "\n".join(["the same line of it"] * 20), " ".join(f"THE!! W{i}!! of" for i in range(30)), " ".join(f"w{i}***" for i in range(90)),
    "é" * 30 + " the of " + " ".join(f"ünd{i}" for i in range(70)), "\v\f a\rb the of " * 30, " ".join(str(i) for i in range(30_000)),
    " ".join(f"the of {i}" for i in range(40)) + "\n" + "one\n" * 30,
]


def test_quality(make_docs):
    docs = make_docs([*enumerate(TEXTS), (0, TEXTS[5]), (None, TEXTS[5])])
    judged = quality.judge_quality(docs, out="kept")
    assert judged.columns == docs.columns  # the result takes the place of the column of that name
    rows_ = judged.select("doc_id", "text", "kept.*").collect()
    assert len(rows_) == len(TEXTS) + 2
    for r in rows_:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
        assert found == measures(r.text), r.text and r.text[:60]
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in rows_)
    assert quality.judge_quality(make_docs([])).count() == 0


def turns_of(rows_):
    by = defaultdict(list)
    for key, turn, role, text in rows_:
        by[key].append((turn is not None, turn or 0, role or "", text or ""))
    return {k: [(r, t) for _, _, r, t in sorted(v)] for k, v in by.items()}


CONTROLS = chat.TEMPLATE.controls


def test_chat_round_trip(spark):
    nasty = ["", "\\", "\\0;", "\\1;x", "<|im_end|>\n", "<|im_start|>user\nhi", "a<|turn|>b", "</s>[INST] ok [/INST]", "\n\n", "é😀<s>", "".join(CONTROLS), "\\" + CONTROLS[0], "<"]
    said = [(k, i, role, text) for k, role in enumerate(["user", "assistant", "system", "tool\nx", "", None]) for i, text in enumerate(nasty)]
    said += [(90, 1, "user", "b"), (90, 1, "user", "a"), (90, 0, "assistant", None), (90, None, "assistant", "first"), (90, 0, "assistant", None)]
    said += [(None, 0, "user", "no key"), (91, 0, "assistant", "x" * 200_000), (92, 0, "assistant", "one"), (92, 1, "assistant", "two"), (92, 2, "user", "three")]
    table = spark.createDataFrame([(*r, 1) for r in said], "conv_id long, turn long, role string, text string, mask int")
    formatted = chat.format_conversations(table)
    read = formatted.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_learned(F.col("formatted"), F.col("mask")).alias("learned"))
    wanted = turns_of(said)
    found = {r.conv_id: r for r in read.collect()}
    assert found.keys() == wanted.keys()
    for key, turns in wanted.items():
        row = found[key]
        assert [tuple(t) for t in row.turns] == turns
        assert row.learned == "".join(t for r, t in turns if r == "assistant")
        assert row.formatted.count("<|im_end|>") == sum(1 for i, t in enumerate(turns) if not i or turns[i - 1][0] != t[0])
        assert not any(c in row.formatted for c in CONTROLS if c not in ("<|im_start|>", "<|im_end|>", "<|turn|>"))
    assert found[92].formatted == "<|im_start|>assistant\none<|turn|>two<|im_end|>\n<|im_start|>user\nthree<|im_end|>\n"
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_long_conversations(spark):
    """Spans of thousands of turns, and the time for them, which grows with the turns."""
    sizes = (1, 255, 256, 257, 700, 20_000)
    ids = spark.createDataFrame([(k, n) for k, n in enumerate(sizes)], "conv_id long, n int")
    turns = ids.select("conv_id", F.explode(F.sequence(F.lit(1), "n")).alias("turn"))
    role = F.when(F.col("turn") % 3 == 0, "user").otherwise("assistant")
    table = turns.select("conv_id", "turn", role.alias("role"), F.concat(F.lit("<s>é"), F.col("turn").cast("string")).alias("text"))
    formatted = chat.format_conversations(table)
    learned = chat.read_learned(F.col("formatted"), F.col("mask")).alias("learned")
    for row in formatted.select("conv_id", F.size("mask").alias("n"), learned).collect():
        wanted = [f"<s>é{i}" for i in range(1, sizes[row.conv_id] + 1) if i % 3]
        assert (row.n, row.learned) == (len(wanted), "".join(wanted))


def test_running_totals(spark):
    arrays = [[], None, [5], list(range(255)), [1] * 256, [2] * 257, [3, 0] * 1000]
    table = spark.createDataFrame([(k, a) for k, a in enumerate(arrays)], "k int, a array<int>")
    found = dict(table.select("k", rows.running_totals(F.col("a"))).collect())
    assert found == {k: None if a is None else list(itertools.accumulate(a)) for k, a in enumerate(arrays)}


@pytest.fixture(scope="module")
def mixed_rows():
    rows_ = [(i, "w " * (i % 37), "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    return [*rows_, (5, "x y", None), (5, "x y", None), (None, "z", None), (901, None, "hot"), (902, "", "empty"), (903, "big " * 5000, "one")]


def test_shards(make_docs, mixed_rows):
    docs = make_docs(mixed_rows)
    placed = sharding.shard_plan(docs, 24).collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in placed), key=repr) == sorted(
        ((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, _ in mixed_rows), key=repr
    )
    by = defaultdict(list)
    for r in placed:
        by[r["shard"]].append(r)
    counts = [len(by[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1
    for s in range(24):
        assert sorted(r.slot for r in by[s]) == list(range(counts[s]))
    source = {d: s for d, _, s in mixed_rows}
    hot = [sum(source[r.doc_id] == "hot" for r in by[s]) for s in range(24)]
    assert max(hot) - min(hot) <= 4
    again = sharding.shard_plan(docs.repartition(5), 24).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, placed), key=repr)
    assert sharding.shard_plan(make_docs([]), 24).count() == 0
    few = sharding.shard_plan(make_docs(mixed_rows[:3]), 24).collect()
    assert len({r["shard"] for r in few}) == 3


def targets(sizes):
    """Level by level, by hand."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(sizes), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= 2 * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in free}
        out |= {s: 2.0 * sizes[s] for s in full}
        left, free = left - sum(2 * sizes[s] for s in full), free - full
    return out


def test_mixture(make_docs, mixed_rows):
    docs = make_docs(mixed_rows)
    planned = mixing.mix(docs, mixing.word_count(F.col("text")))
    found = planned.documents.collect()
    sizes = Counter()
    for _, text, source in mixed_rows:
        sizes[source] += len(SPACED.findall(text or ""))
    wanted, taken = targets(dict(sizes)), Counter()
    assert sorted(((r.doc_id, r["size"]) for r in found), key=repr) == sorted(((d, len(SPACED.findall(t or ""))) for d, t, _ in mixed_rows), key=repr)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for source, target in wanted.items():
        assert taken[source] == pytest.approx(target, abs=planned.block_tokens * 20, rel=0.01)
    again = mixing.mix(docs.repartition(3), mixing.word_count(F.col("text"))).documents.collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, found), key=repr)
    slots = sorted(r.slot for r in planned.schedule.collect())
    assert len(slots) == len(set(slots))


def test_mixed_documents(make_docs, mixed_rows):
    docs = make_docs(mixed_rows)
    plan = mixing.mix(docs, mixing.word_count(F.col("text"))).documents.collect()
    rows_ = mixing.mixed_documents(docs)
    assert rows_.columns == docs.columns
    unique = Counter(r.doc_id for r in plan)
    assert {d: n for d, n in Counter(r.doc_id for r in rows_.collect()).items() if unique[d] == 1} == {
        r.doc_id: r.copies for r in plan if r.copies and unique[r.doc_id] == 1
    }
    empty = make_docs([])
    assert mixing.mix(empty, mixing.word_count(F.col("text"))).documents.count() == 0
    assert mixing.mixed_documents(make_docs([(1, None), (2, "")])).count() == 0


def test_cumulate(spark):
    table = spark.createDataFrame([(k % 3, k // 2, k) for k in range(200)] + [(None, 1, 5)] * 3, "g long, o long, v long")
    found = defaultdict(list)
    for r in rows.cumulate(table, ["o"], "v", within=["g"]).collect():
        found[r.g].append((r._rank, r._before, r.o, r.v))
    for group in found.values():
        total = 0
        for rank, (place, before, _, v) in enumerate(sorted(group)):
            assert (place, before) == (rank, total)
            total += v
        assert [x[2] for x in sorted(group)] == sorted(x[2] for x in group)


def test_url_parts(spark):
    seen = {
        "HTTP://A.Example.COM/en/x?q=/y#z": ("a.example.com", "/en/x"),
        "https://b.org?x": ("b.org", ""),
        "https://c.org#f/": ("c.org", ""),
        "no scheme/en/": ("", ""),
        "x://y://z/p": ("y:", "//z/p"),
        "a://É.com/É\n/b": ("É.com", "/É\n/b"),
        "://": ("", ""),
        "": ("", ""),
        None: ("", ""),
    }
    table = spark.createDataFrame([(u,) for u in seen], "url string")
    for r in table.select("url", urls.host_of(F.col("url")).alias("h"), urls.path_of(F.col("url")).alias("p")).collect():
        assert (r.h, r.p) == seen[r.url]


def test_listed_rules(spark):
    seen = {
        ("example.com", "/en/1"): "example.com/en/", ("www.example.com", "/en/"): "www.example.com/en/", ("x.www.example.com", "/en/"): "www.example.com/en/",
        ("badexample.com", "/en/"): "com/", ("com", "/"): "com/", ("com", ""): None, ("a.net", "/es/"): "net/es/", ("a.net", "/de/"): None, ("net", "/fr/x"): "net/fr/",
        ("", ""): None, ("xcom", "/"): None,
    }
    table = spark.createDataFrame(list(seen), "h string, p string")
    rule, verdict = urls.listed_rules(urls.LISTED, F.col("h"), F.col("p"))
    kinds = {h + p: v for h, p, v in urls.LISTED}
    for r in table.select("h", "p", rule.alias("rule"), verdict.alias("verdict")).collect():
        assert (r.rule, r.verdict) == (seen[r.h, r.p], kinds.get(seen[r.h, r.p]))


def brute_rules(baskets, support, confidence, most):
    """All token sets by counting subsets."""
    from itertools import combinations

    n, bad = Counter(), Counter()
    for tokens, label in baskets:
        for k in range(1, most + 1):
            for s in combinations(sorted(set(tokens)), k):
                n[s] += 1
                bad[s] += bool(label)
    rules = {s: bad[s] / n[s] for s in n if bad[s] >= max(1, -(-support * len(baskets) // 1)) and bad[s] / n[s] >= confidence}
    smaller = lambda s: (t for k in range(1, len(s)) for t in combinations(s, k))
    return {s for s, c in rules.items() if not any(rules.get(t, 0) >= c for t in smaller(s))}


def test_mined_rules(spark):
    kinds = [(["host=spam", "path=a"], True), (["host=spam", "path=b"], True), (["host=ok", "path=a"], False), (["host=mid", "path=a", "x"], True), (["host=mid", "path=b"], False), (["x", "path=b"], False)]
    baskets = [kinds[i % len(kinds)] for i in range(120)] + [([], True)]
    table = spark.createDataFrame(baskets, "tokens array<string>, bad boolean")
    rules = urls.mine_rules(table, 0.05, 0.7)
    found = {tuple(r.tokens) for r in rules.collect()}
    assert found == brute_rules([b for b in baskets if b[0]], 0.05, 0.7, urls.MAX_TOKENS)
    pages = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(kinds)] + [(99, [])], "page_id long, tokens array<string>")
    matched = {r.page_id for r in urls.match_rules(pages, "page_id", rules).collect()}
    assert matched == {i for i, (t, _) in enumerate(kinds) if any(set(r) <= set(t) for r in found)}


def test_rules_of_many_tokens(spark):
    five = ["host=blog", "host=net", "path=es", "path=shop", "site=example.net"]
    baskets = [(five, True)] * 10 + [([t for t in five if t != out], False) for out in five for _ in range(10)]
    baskets += [(["host=a", "host=b", "x", "y"], True)] * 10 + [(["host=a", "x"], False)] * 10
    table = spark.createDataFrame(baskets, "tokens array<string>, bad boolean")
    found = {tuple(r.tokens) for r in urls.mine_rules(table, 0.05, 0.6).collect()}
    assert found == brute_rules(baskets, 0.05, 0.6, 5)
    assert tuple(five) in found


def test_judged_urls(spark):
    pages = [(i, f"http://{'spam' if i % 2 else 'ok'}.org/x/{i}", "h", "v") for i in range(60)] + [(None, None, "h", "v"), (3, "http://spam.org/x/3", "h", "v")]
    labels = [(i, bool(i % 2)) for i in range(40)] + [(None, True), (5, None)]
    table = spark.createDataFrame(pages, "page_id long, url string, host string, verdict string")
    known = spark.createDataFrame(labels, "page_id long, bad boolean")
    rows_ = urls.judge_urls(table, known).collect()
    assert len(rows_) == len(pages)
    assert {r.page_id: r.verdict for r in rows_} == {i: ("block" if i is not None and i % 2 else "allow") for i, *_ in pages}
    assert urls.judge_urls(table.limit(0), known).count() == 0
    assert {r.verdict for r in urls.judge_urls(table, known.limit(0)).collect()} == {"allow"}


def test_names_with_blanks_and_signs(spark):
    """Paths with blanks, newlines, quotes or signs of a rule's name keep their own tokens."""
    bad = ["http://h.org/a b/x", "http://h.org/a/b & path=c/x", 'http://h.org/q"\n/x', "http://h.org/a\\u0041/x"]
    fine = ["http://h.org/a/b/x", "http://h.org/a/b/path=c/x", "http://h.org/q/x", "http://h.org/aA/x", "http://h.org/x/a path=b/p", "http://h.org/x/a/b/p"]
    urls_ = [(i, u) for i, u in enumerate((bad + fine) * 12)]
    table = spark.createDataFrame(urls_, "page_id long, url string")
    known = spark.createDataFrame([(i, u in bad) for i, u in urls_], "page_id long, bad boolean")
    found = urls.judge_urls(table, known).collect()
    assert {(r.page_id, r.verdict) for r in found} == {(i, "block" if u in bad else "allow") for i, u in urls_}
    tokens = spark.createDataFrame(urls_, "page_id long, url string").select(
        "page_id", urls.url_tokens(urls.host_of(F.col("url")), urls.path_of(F.col("url"))).alias("tokens")
    )
    have = {r.page_id: set(r.tokens) for r in tokens.collect()}
    assert all(set(json.loads(rule)) <= have[r.page_id] for r in found for rule in r.mined)
    assert any(r.mined for r in found)
