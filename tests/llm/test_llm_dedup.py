"""Operators 5, 9 and 10 against brute force."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from feedsync.llm import exact, neardup, shingles, substring, toxicity
from feedsync.llm.common import ship_package
from feedsync.llm.components import components

DOCS = "doc_id long, text string, lang string, keep_id string, kept int, class_id string, row string"


def table(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "x", 1, "c", "r") for i, t in pairs], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(seed, n=120):
    """Texts with copies, near copies, shared passages, repeats inside a text, odd rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for _ in range(n):
        kind, new = rng.random(), [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        if kind < 0.15 and texts:
            new = words(rng.choice(texts))
        elif kind < 0.35 and texts:
            new = words(rng.choice(texts))
            for _ in range(rng.randint(1, 3)):
                if new:
                    new[rng.randrange(len(new))] = rng.choice(vocabulary)
        elif kind < 0.5:
            at, size = rng.randrange(30), rng.randint(10, 30)
            new = new + passage[at : at + size] + new[:15] + new[:15]
        texts.append(rng.choice([" ", "  ", "\n", "\t "]).join(new))
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rows += [(1, None), (2, ""), (4, " \n "), (5, "é  x y"), (7, "one"), (8, "one"), (10, "ab cd")]
    rng.shuffle(rows)
    return rows


# ---------------------------------------------------------------- operator 5


def test_exact_groups(spark):
    rows = corpus(1) + [(i, "hot  copy") for i in range(1000, 1400)] + [(9000, "a\tb"), (9001, "a b"), (9001, "a b")]
    got = exact.duplicate_groups(table(spark, rows), min_hot=50).collect()
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    want = sorted((i, min(groups[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert sorted(r["keep_id"] for r in got if r["kept"]) == sorted(min(g) for g in groups.values())


def test_exact_keeps_rows_untouched(spark):
    rows = [(3, "a  b"), (1, "a b"), (2, None), (4, ""), (None, "z"), (None, "z"), (6, "z"), (7, "\tq"), (None, "n")]
    kept = exact.drop_duplicates(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect())
    assert got == sorted([("1", "a b"), ("2", "None"), ("6", "z"), ("7", "\tq"), ("None", "n")])
    assert exact.drop_duplicates(table(spark, [])).count() == 0
    assert exact.duplicate_groups(table(spark, [])).count() == 0


def test_exact_plan_is_native(spark):
    df = exact.duplicate_groups(table(spark, corpus(2)))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert plan.count("rangepartitioning") >= 1 and "CartesianProduct" not in plan


# --------------------------------------------------------------- operator 10


def brute_removal(rows):
    first = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    for i, t in order:
        w = words(t)
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - 12):
            f = first[tuple(w[j : j + 13])]
            if f is not None and (i is None or f < i):
                gone[j : j + 13] = [True] * 13
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def test_removal_equals_brute_force(spark, monkeypatch):
    ship_package(spark)
    long = " ".join(f"L{i % 5000}" for i in range(40_000))
    rows = corpus(3) + corpus(4)[:40] + [(7777, long), (7778, "x " + long), (None, long[:900]), (None, long[:900])]
    rows += [(8000 + i, "the hot passage " * 6 + f"tail {i}") for i in range(60)]
    want = brute_removal(rows)
    for chunk in (1 << 11, 2 << 20):
        monkeypatch.setattr(substring, "CHUNK_BYTES", chunk)
        got = substring.removal_digests(table(spark, rows)).collect()
        key = [
            (str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"])
            for r in got
        ]
        assert sorted(key) == sorted((str(i), n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in want)


def test_null_and_repeated_ids_spread_over_chunks(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(substring, "CHUNK_BYTES", 1 << 12)
    sizes = spark.sparkContext.accumulator(0)
    probes = substring._probes

    def counted(chunk, partitions):
        sizes.add(chunk.num_rows**2)
        return probes(chunk, partitions)

    monkeypatch.setattr(substring, "_probes", counted)
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(60)) for _ in range(200)]
    rows = [(None if i % 2 else 5, t) for i, t in enumerate(texts)] + [(1, texts[0]), (9, texts[1]), (None, texts[2])]
    got = substring.removal_digests(table(spark, rows)).collect()
    want = [(str(i), n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute_removal(rows)]
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == sorted(want)
    assert sizes.value < 5000  # 20,000 with the rows of an id in one chunk


def test_removed_text_and_spans(spark):
    ship_package(spark)
    rows = [*corpus(5), (None, None)]
    want = {i: (k, t) for i, _, k, t in brute_removal(rows)}
    source = dict(rows)
    cut = substring.remove_repeats(table(spark, rows))
    assert cut.columns == table(spark, rows).columns
    for r in cut.collect():
        removed, text = want[r["doc_id"]]
        assert r["text"] == (text if removed else source[r["doc_id"]])
        assert (r["lang"], r["keep_id"], r["row"]) == ("en", "x", "r")
    for r in substring.repeated_spans(table(spark, rows)).collect():
        w = words(source[r["doc_id"]])
        for a, b in reversed([(s["start"], s["end"]) for s in r["spans"]]):
            assert b - a >= 13
            del w[a:b]
        assert " ".join(w) == want[r["doc_id"]][1]
    assert substring.remove_repeats(table(spark, [])).count() == 0
    assert substring.removal_digests(table(spark, [(1, None), (2, "")])).count() == 2


def test_word_hashes_follow_words():
    texts = [t.encode() for t in ["a b", "", "b  a\n", "ab", " x ", "c" * 3000 + " b", "é b"]]
    h, counts = shingles.word_hashes(b"".join(texts), np.array([len(t) for t in texts]))
    flat = [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts]
    assert len(set(h.tolist())) == len(set(flat))
    seen = dict(zip(flat, h.tolist(), strict=True))
    assert [seen[w] for w in flat] == h.tolist()


def test_word_hashes_across_blocks(monkeypatch):
    text = (" ".join(f"w{i}" for i in range(5000))).encode()
    whole, _ = shingles.word_hashes(text, np.array([len(text)]))
    monkeypatch.setattr(shingles, "BLOCK", 100)
    parts, _ = shingles.word_hashes(text, np.array([len(text)]))
    assert np.array_equal(whole, parts)


# ---------------------------------------------------------------- operator 9


def shingle_set(text):
    w = (text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near_corpus():
    """A chain in which neighbours are similar and the ends are not, families, oddities."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    rows, text = [], list(base)
    for i in range(12):  # each step changes the next words
        rows.append((100 + i, " ".join(text)))
        for j in range(3):
            text[i * 12 + j] = f"c{i}-{j}"
    for i in range(150):  # near copies of one text
        copy = [f"h{k}" for k in range(120)]
        copy[rng.randrange(120)] = f"z{i}"
        rows.append((1000 + i, " ".join(copy)))
    return rows


def test_near_classes_equal_brute_force(spark):
    ship_package(spark)
    rows = corpus(6) + near_corpus()
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicate_classes(table(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_near_copies_with_a_repeated_line(spark):
    """Sets just above the similarity that differ by a line pasted many times."""
    ship_package(spark)
    rows = []
    for i in range(40):
        body = " ".join(f"p{i}-{k}" for k in range(64))
        footer = " ".join(f"f{i}-{k}" for k in range(10))
        rows += [(10 * i, body), (10 * i + 1, " ".join([body] + [footer] * (20 + 2 * i)))]
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicate_classes(table(spark, rows)).collect()}
    assert got == brute_classes(rows) == {i: i // 10 * 10 for i, _ in rows}


def test_near_odd_rows(spark):
    ship_package(spark)
    rows = [(5, "a b c d e f"), (2, "a b  c d\te f"), (7, None), (8, ""), (9, None), (None, "a b c d e f")]
    rows += [(2, "a b c d e f"), (11, "one two"), (12, "one two")]
    got = neardup.near_duplicate_classes(table(spark, rows)).collect()
    assert sorted((r["doc_id"], r["class_id"], r["kept"]) for r in got) == [
        (2, 2, True), (2, 2, True), (5, 2, False), (7, 7, True), (8, 8, True), (9, 9, True),
        (11, 11, True), (12, 11, False),
    ]
    kept = neardup.keep_one_of_each(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["11", "2", "2", "7", "8", "9", "None"]
    assert neardup.near_duplicate_classes(table(spark, [])).count() == 0


def test_near_drop_keeps_other_texts_of_a_repeated_id(spark):
    base = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"term{i}" for i in range(40))
    rows = [(3, base), (7, base + " more"), (7, other), (9, other + " more"), (None, base), (11, "alone"), (11, "alone")]
    kept = neardup.keep_one_of_each(table(spark, rows).withColumn("my col", F.lit("x")))
    assert kept.columns[-1] == "my col"
    assert sorted(((r.doc_id or 0), r.text) for r in kept.collect()) == sorted(
        [(3, base), (7, other), (0, base), (11, "alone"), (11, "alone")]
    )


def test_odd_column_names_pass_through(spark):
    rows = [(1, "a b c d e f g h i j k l m n"), (2, "x a b c d e f g h i j k l m n"), (3, None)]
    odd = table(spark, rows).withColumn("my col", F.lit("x")).withColumn("a`b.c", F.lit(1))
    cut = substring.remove_repeats(odd)
    assert cut.columns == odd.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: rows[0][1], 2: "x", 3: None}
    model = toxicity.flat_model(0.0)
    scored = toxicity.score(odd, model, keep_columns=True).select("doc_id", "score", "row.*")
    assert scored.count() == 3 and "my col" in scored.columns


def test_hot_text_without_ids_spreads(spark):
    text = "one and the same text"
    rows = [(5, text)] + [(None, text)] * 6000 + [(4, text)] * 3
    coalescing = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalescing, "false")
    try:
        marked = exact._marked(table(spark, rows).repartition(4), "doc_id", "text", 256)
        got = marked.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(coalescing, "true")
    assert len(got) > 3
    assert max(r["count"] for r in got) < 3000
    found = exact.duplicate_groups(table(spark, rows)).collect()
    assert sum(r.kept for r in found) == 1 and {r.keep_id for r in found} == {4} and {r.group_size for r in found} == {6004}


def test_sketch_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 2**63, 600, dtype=np.uint64)
    a, b = ids[:500], ids[100:]
    wa, wb = rng.uniform(1, 4, 500), rng.uniform(1, 4, 500)
    k = 4000
    sketch = neardup.prob_minhash(np.r_[a, b], np.r_[wa, wb], np.array([500, 500]), k)
    x, y = np.zeros(600), np.zeros(600)
    x[:500], y[100:] = wa, wb
    both = (x > 0) & (y > 0)
    exact_ = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in np.flatnonzero(both))
    assert abs((sketch[0] == sketch[1]).mean() - exact_) < 4 * np.sqrt(exact_ * (1 - exact_) / k)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}
    assert components(df.filter(F.lit(False)), "a", "b").count() == 0
