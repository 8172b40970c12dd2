"""Operators 11 to 13: brute force, defined results, and the SQL of the registered queries."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from feedsync.llm import centroids as C
from feedsync.llm import divergence as D
from feedsync.llm import pii as P
from feedsync.llm.common import ship_package

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("cluster", T.StringType()),
        T.StructField("my col", T.StringType()),
    ]
)


def brute_clusters(rows, k, rounds):
    """rows: (id, integer vector)."""
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    cents = [list(v) for _, v in sorted(rows, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cents))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in rows]
        for i in range(len(cents)):
            mine = [v for (_, v), f in zip(rows, found) if f == i]
            if mine:
                cents[i] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted((str(r), *nearest(v)[::-1]) for r, v in rows), cents


def test_clusters_equal_brute_force(spark):
    ship_package(spark)
    rng = random.Random(5)
    good = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(90)]
    good += [(7, [0.5, 0.5, -0.5, 0.25]), (None, [0.1, 0.2, 0.3, 0.4]), (None, [0.0] * 4)]
    good += [(1000 + i, [0.25, -0.25, 0.75, -0.75]) for i in range(40)]  # one hot vector
    bad = [(200, None), (201, [1.0, 2.0]), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan"), 0.0, 0.0, 0.0])]
    bad += [(204, [float("inf"), 0.0, 0.0, 0.0]), (205, [1e30, 0.0, 0.0, 0.0]), (206, [])]
    df = spark.createDataFrame([(*r, "x", "y") for r in good + bad], VECTORS).repartition(5)
    exact = [(i, tuple(int(np.floor(np.float64(np.float32(x)) * 256)) for x in v)) for i, v in good]
    for width, page in ((1, 1000), (2, 16), (3, 7)):
        found, cents = C.cluster(df, k=6, dims=4, rounds=4, width=width, page_rows=page)
        want, want_cents = brute_clusters(exact, 6, 4)
        assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found.collect()) == want
        assert [tuple(c) for c in cents] == [tuple(c) for c in want_cents]
    report = C.cluster_report(df, k=6, dims=4, rounds=4).collect()
    assert {r.inertia for r in report} == {sum(w[2] for w in want)}
    for r in report:
        assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cents[r.cluster])).encode()).hexdigest()


def test_clusters_of_few_and_no_rows(spark):
    ship_package(spark)
    few = spark.createDataFrame([(i, [float(i), 0.0], "", "") for i in range(3)], VECTORS)
    assert sorted((r.vec_id, r.distance) for r in C.cluster_report(few, dims=2).collect()) == [(0, 0), (1, 0), (2, 0)]
    none = C.cluster_report(few.limit(0), dims=2)
    assert none.collect() == [] and none.columns[0] == "vec_id"


def test_block_encoding_is_lossless():
    rng = np.random.default_rng(3)
    for width in (1, 2, 3, 5):
        sub = rng.integers(-(1 << 27), 1 << 27, (500, width)).astype(np.int32)
        sub[100:300] = sub[0]
        entries, code = C.encode_block(sub)
        assert (entries[code] == sub).all() and len(entries) == len({tuple(r) for r in sub.tolist()})


# ------------------------------------------------------------------ personal data


def brute_base(text):
    def luhn(d):
        t = [int(c) for c in reversed(d)]
        return (sum(t[::2]) + sum(sum(divmod(2 * v, 10)) for v in t[1::2])) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [
        ("ip", *m.span())
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m.group().split("."))
    ]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(11)
    parts = ["a", "b@", "@", "x.y", ".", "-", "+", "1", "25", "255", "0004", "256", " ", "  ", "(", ")", "4111111111111111"]
    parts += ["é", "\n", "5927243074273351", "+1 (017) 555-7713", "10.0.0.1", "me@x.org", "\U0001f600", "%", "_"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert P.base_spans(text) == brute_base(text), text


def test_base_spans_are_linear_on_long_runs():
    for run in ("a" * 300_000, "1" * 300_000, "1 " * 200_000, "1." * 200_000, "+1" + " " * 300_000, "@" * 200_000):
        P.base_spans(run + "@" + run)


@pytest.fixture(scope="module")
def model():
    return P.train()


def test_likelihood_and_gradient():
    rng = np.random.default_rng(1)
    scores, pairs = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)
    gold = np.array([[0, 2, 1, 0], [1, 1, 0, 0]])
    value, by_score, by_pair = P.likelihood(scores, pairs, mask, gold)

    def brute(scores, pairs):
        total = 0
        for s, m, g in zip(scores, mask, gold, strict=True):
            n = int(m.sum())
            path = lambda y: sum(s[t, y[t]] for t in range(n)) + sum(pairs[y[t], y[t + 1]] for t in range(n - 1))  # noqa: B023, E731
            total += path(g) - np.log(sum(np.exp(path(y)) for y in itertools.product(range(3), repeat=n)))
        return total

    assert np.isclose(value, brute(scores, pairs))
    for i in np.ndindex(scores.shape):
        moved = scores.copy()
        moved[i] += 1e-6
        assert np.isclose((brute(moved, pairs) - brute(scores, pairs)) / 1e-6, by_score[i], atol=1e-4)
    for i in np.ndindex(pairs.shape):
        moved = pairs.copy()
        moved[i] += 1e-6
        assert np.isclose((brute(scores, moved) - brute(scores, pairs)) / 1e-6, by_pair[i], atol=1e-4)


def test_decoding_with_cuts_equals_every_path(model):
    tagger = P.Tagger(model)
    rng = random.Random(2)
    words = ["the", "call", "555-0123", "(030)", "1.2.3.4", "a@b.org", "(at)", "example", "dot", "2019", "mail", "ering"]
    row, held = [], []
    classes = P._Classes(model.lexicon)
    for _ in range(60):
        held.append(np.array([classes[rng.choice(words)] for _ in range(rng.randint(1, 4))]))
    tables, gap = tagger.tables(classes.lists)
    edge = len(tables) - 1
    row = np.concatenate([[edge], *(np.r_[h, edge] for h in held)])
    labels, at = P.decode(model, row, tables, gap, area=8), 1
    for h in held:
        e = np.r_[edge, h, edge]
        s = tables[e[:-2], 0] + tables[e[1:-1], 1] + tables[e[2:], 2]
        value = lambda y: sum(s[t, y[t]] for t in range(len(y))) + sum(model.pairs[a, b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        best = max(map(value, itertools.product(range(9), repeat=len(h))))
        assert np.isclose(value(labels[at : at + len(h)].tolist()), best)
        at += len(h) + 1


HELD_OUT = [
    ("you may call [[phone 555-0171]] today", 1),
    ("my number is [[phone (040) 5550166]] , ask for Eve", 1),
    ("Telefon [[phone 030 5550 177]] ab acht Uhr", 1),
    ("appelez le [[phone 02 99 00 45 67]] vite", 1),
    ("write to [[email tom (at) example (dot) com]] now", 1),
    ("E-Mail: [[email info(at)laden.example.de]] oder hier", 1),
    ("blocked host [[ip 10[.]1[.]2[.]3]] at night", 1),
    ("paid with card [[card 4111.1111.1111.1111]] in June", 1),
    ("the meeting was on 2023-11-02 at 10:15", 0),
    ("version 3.1.4 came after 3.1.3", 0),
    ("it cost 1,399.00 in 2021 and 1,450.00 in 2022", 0),
    ("pages 12-18 and 200-212 of volume 9", 0),
    ("reference 5927243074273351 is void", 0),
    ("rows 1 2 3 4 5 6 7 8 9 10 of the list", 0),
    ("the dot at the end of the line", 0),
]


def test_model_generalises(model):
    tagger, right = P.Tagger(model), 0
    for marked, n in HELD_OUT:
        text = re.sub(r"\[\[\w+ (.*?)\]\](?=[\s.,;:!?]|$)", r"\1", marked)
        want = [(m.group(1), m.group(2)) for m in P._MARK.finditer(marked)]
        got = [(k, text[s:e]) for k, s, e in tagger.spans([text])[0]]
        assert n or not got, (text, got)
        right += got == want
    assert right >= 13


def test_added_spans_meet_no_base_span():
    base = [("ip", 10, 20), ("card", 30, 49)]
    assert P.merged(base, [("phone", 5, 11), ("phone", 20, 30), ("email", 25, 60), ("email", 60, 70)]) == [
        ("email", 60, 70), ("ip", 10, 20), ("card", 30, 49), ("phone", 20, 30)
    ]


def test_personal_data_of_odd_rows(spark):
    ship_package(spark)
    schema = "doc_id long, text string, spans string, `my col` string"
    long_text = "the ering hent of " * 150_000 + "mail jane (at) example (dot) org or +44 20 7946 0018"
    rows = [(1, "x me@a.org"), (1, "x me@a.org"), (2, None), (3, ""), (None, "10.0.0.1\n+1 (017) 555-7713"), (4, long_text)]
    df = spark.createDataFrame([(i, t, "", "") for i, t in rows], schema)
    got = P.personal_data(df).collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[1].spans == "email:2:10" and by[1].n_email == 1
    assert by[2].spans == by[3].spans == "" and by[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[None].spans == "ip:0:8,phone:9:26" and by[None].n_ip == by[None].n_phone == 1
    n = len(long_text)
    assert by[4].spans == f"email:2700005:2700032,phone:{n - 16}:{n}" and by[4].n_email == 0
    assert P.personal_data(df.limit(0)).collect() == []


# ------------------------------------------------------------------ divergence


def brute_divergence(rows, min_docs, top):
    docs = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in D.TERM.findall(text or "")]) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        terms = {t for d in mine for t in d[2]}
        kept = sorted(t for t in terms if sum(t in d[2] for d in mine) >= min_docs)

        def share(words):
            n = {t: words.count(t) for t in kept}  # noqa: B023
            total = sum(n.values()) + 5 * len(kept)  # noqa: B023
            return n, {t: 1 + 10**9 * (n[t] + 5) // total for t in kept}  # noqa: B023

        sources = {d[1] for d in mine}
        by = {s: share([w for d in mine if d[1] == s for w in d[2]]) for s in sources}
        _, q = share([w for d in mine for w in d[2]])
        for s in sources:
            n, p = by[s]
            pairs = [(-sum(abs(p[t] - by[o][1][t]) for t in kept), o.encode()) for o in sources - {s}]
            found = [(q[t] - p[t], t.encode()) for t in kept if n[t] > 0 and p[t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(found)[:top])):
                out += [(lang, s, part, o.decode(), -v, i + 1) for i, (v, o) in enumerate(items)]
    return sorted(out)


def test_divergence_equals_brute_force(spark, monkeypatch):
    ship_package(spark)
    rng = random.Random(8)
    vocabulary = [f"w{c}" for c in "abcdefghij"] + ["Été", "été", "ÄB", "日本", "don't", "x1y", "😀"]
    rows = []
    for i in range(160):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["hot", "hot", "s1", "s2", "s3", None, "é", "Z"])
        rows.append((" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) if i % 9 else None, lang, source))
    rows += [("only here", "fr", "s1"), (None, "fr", "s2"), ("", "it", "lone")]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "text string, lang string, source string, doc_id long, term string, `my col` string")
    for held, chunk, block, top in ((10, 3, 2, 3), (1000, 4096, 64, 50)):
        counts = D.staged(D.term_counts(df.repartition(4), held), "t")
        kept, groups = D._kept(counts, 6)
        pairs = D.pair_part(kept, groups, chunk, block)
        terms = D.term_part(kept, groups, top)
        got = [(r.lang, r.source, "pair", r.item, r.value, r.rank) for r in pairs.collect()]
        got += [(r.lang, r.source, "term", r.item, r.value, r.rank) for r in terms.collect()]
        assert sorted(got) == brute_divergence(rows, 6, top)
    assert D.divergence(df.limit(0)).collect() == []


def test_divergence_counts_beyond_64_bits(spark):
    """Shares of counts whose products pass 64 bits stay exact."""
    n = 10**13
    row = spark.range(1).select(D._share(D.F.lit(n), D.F.lit(3 * n), D.F.lit(7)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (3 * n + 35)


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op13_source_divergence"])
def test_query_equals_its_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    with duckdb.connect() as con:
        for t in ("documents", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        want = con.sql(entry.oracle_sql()[name]).to_arrow_table()
    got = entry.queries()[name](spark, sf).toArrow()
    cols = sorted(want.column_names)
    rows = lambda t: sorted(map(repr, zip(*(t.column(c).to_pylist() for c in cols), strict=True)))
    assert sorted(got.column_names) == cols and rows(got) == rows(want)
