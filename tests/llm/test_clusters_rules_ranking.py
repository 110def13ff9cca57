"""Centroid clustering, host-level rules and ranked search against brute force, with every odd input they name."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import clusters, common, host_rules, queries, ranking

WORD = r"[^\x20\x09-\x0D]+"


# --- clusters ---


def brute_clusters(rows, dims, k, rounds):
    """{row number: (cluster, distance)}, centroids; rows are (vec_id, vector)."""
    kept = {}
    for n, (_, v) in enumerate(rows):
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept[n] = [math.floor(1024 * x) if abs(x) < 2**52 else int(x) * 1024 for x in v]
    order = sorted(kept, key=lambda n: (rows[n][0] is None, hashlib.sha256(f"3:{rows[n][0]}".encode()).hexdigest(), kept[n]))
    centroids = [kept[n] for n in order[:k]]

    def assign():
        out = {}
        for n, v in kept.items():
            away = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out[n] = (away.index(min(away)), min(away))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            mine = [kept[n] for n, (w, _) in found.items() if w == c]
            if mine:
                centroids[c] = [sum(p) // len(mine) for p in zip(*mine)]
    return assign(), centroids


def check_clusters(spark, rows, dims=64, k=8, rounds=10, extra=""):
    schema = f"vec_id long, embedding array<double>, cluster string, distance int, __parts int, part int{extra}"
    table = spark.createDataFrame([(i, v, "x", 1, 2, 3) for i, v in rows], schema)
    got = clusters.cluster(table, dims=dims, k=k, rounds=rounds).collect()
    assigned, centroids = brute_clusters(rows, dims, k, rounds)
    total = Counter()
    for c, d in assigned.values():
        total[c] += d
    small = lambda v: v if v < 2**63 else None
    expected = Counter(
        (rows[n][0], c, small(d), small(total[c]), small(sum(total.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for n, (c, d) in assigned.items()
    )
    assert Counter((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in got) == expected


def test_clusters_with_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(i % 5, 0.6) for _ in range(64)]) for i in range(300)]
    rows += [rows[3], rows[3], (4, rows[5][1]), (None, rows[6][1]), (None, None), (900, None), (901, []), (902, [1.0] * 63), (903, [0.0] * 64)]
    rows += [(904, [float("nan")] + [0.0] * 63), (905, [None] + [0.0] * 63), (906, [float("inf")] * 64), (907, [-0.0004] * 64)]
    check_clusters(spark, rows)


def test_clusters_of_vast_and_tied_vectors(spark):
    rng = random.Random(3)
    far = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.randint(0, 30) for _ in range(3)]) for i in range(60)]
    check_clusters(spark, far, 3, 8, 4)
    ties = [(i, [float(rng.randint(-2, 2)), float(rng.randint(-2, 2))]) for i in range(200)]
    check_clusters(spark, ties, 2, 8, 5)
    check_clusters(spark, [(i, [1.0, 1.0]) for i in range(30)], 2, 8, 3)  # equal centroids: all but the first stay empty


def test_clusters_of_few_or_no_vectors(spark):
    check_clusters(spark, [(1, [1.0, 2.0]), (2, [3.0, 4.0])], 2, 8, 3)
    check_clusters(spark, [(1, None)], 2, 8, 3)
    check_clusters(spark, [], 2, 8, 3)


def test_tournament_equals_the_nearest(spark):
    rng = np.random.default_rng(4)
    c = rng.integers(-50, 50, (7, 5))
    x = rng.integers(-60, 60, (4000, 5))
    best, apart = clusters.Tournament(c.tolist()).winners(x)
    away = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (best == away.argmin(axis=1)).all() and (apart == away.min(axis=1)).all()


def test_limbs_give_back_the_sum():
    for v in [0, 1, -1, 2**32, -(2**32), 2**31, 2**95 + 12345, -(2**95) - 7]:
        assert sum(x << (clusters.LIMB * at) for at, x in clusters._limbs(v)) == v


# --- host rules ---


def brute_numbers(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \n\t\x0b\x0c\r", "one", "a b c", "a b c a b c", "a a a a", "a a a", "x\nx\n x\n\nx\n", "é ü 漢字 𝄞     z", "#*$%& |<>",
    "a b c d a b c e a b c", "line one\nline one\nline two\r\nline one", "\x1c\x1d\x1e\x1f a", "w " * 30_000 + "end",
]


def test_numbers_of_texts():
    rng = random.Random(6)
    some = [" ".join(rng.choices("abcd", k=rng.randint(1, 40))) + rng.choice(["", "\n"]) * 2 for _ in range(200)]
    for text in [*TEXTS, *some]:
        assert host_rules.numbers((text or "").encode())[:5] == brute_numbers(text), text


def test_repeats_among_very_many_words():
    ids = np.concatenate([np.arange(1 << 21), [5, 6, 7, 9, 10, 3]])  # triples that do not fit 64 bits side by side
    assert host_rules.repeated_words(ids) == 6


def clean(rng, n=80):
    return " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))


def host_table(spark, rows):
    schema = "doc_id long, text string, source string, host string, documents int, kept string, few_words int, __host int, n_lines string"
    return spark.createDataFrame([(i, t, s, "h", 1, "x", 2, 3, "y") for i, t, s in rows], schema)


def host_rows():
    rng = random.Random(7)
    rows = []
    for h in range(30):  # failures in a tenth of the documents of most hosts
        rows += [(len(rows) + j, "too short" if j == 0 else clean(rng), f"good{h}") for j in range(10)]
    rows += [(1000 + j, "too short" if j % 5 else clean(rng), "bad") for j in range(200)]
    rows += [(2000, "one bad document", "tiny"), (2001, clean(rng), None), (2002, None, None), (2003, clean(rng), "tiny2"), (2003, clean(rng), "tiny2"), (None, clean(rng), "bad")]
    return rows


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_host_verdicts_reach_their_documents(spark, monkeypatch, broadcast):
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    rows = host_rows()
    got = host_rules.judge(host_table(spark, rows)).collect()
    assert len(got) == len(rows) and "text" not in got[0].asDict()
    expected = Counter()
    for i, t, s in rows:
        n = brute_numbers(t)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        expected[(i, s, *n, failed, s == "bad", not failed and s != "bad")] += 1
    assert Counter((r["doc_id"], r["source"], *[r[c] for c in host_rules.NUMBERS[:5]], r["base_failed"], r["host_rejected"], r["kept"]) for r in got) == expected


def test_rates_are_shrunk_by_the_spread_of_hosts(spark):
    scanned = host_rules.with_numbers(host_table(spark, host_rows()))
    found = {r["host"]: r for r in host_rules.verdicts(host_rules.host_counts(scanned, "source", host_rules.RULES)).collect()}
    assert found["bad"]["documents"] == 201 and found["bad"]["few_words"] == 160 and None not in found
    assert 0.5 < found["bad"]["few_words_rate"] <= 160 / 201
    assert 0.1 < found["tiny"]["few_words_rate"] < 0.6  # one failure of one is no rate of 1
    assert not found["tiny"]["host_rejected"] and not found["good0"]["host_rejected"]
    mean = sum(r["few_words"] / r["documents"] for r in found.values()) / len(found)
    for r in found.values():  # the posterior mean lies between the host's own rate and that of all hosts
        own = r["few_words"] / r["documents"]
        assert min(mean, own) - 1e-9 <= r["few_words_rate"] <= max(mean, own) + 1e-9


def test_prior_moments():
    rng = np.random.default_rng(8)
    n = rng.integers(20, 200, 4000)
    p = rng.beta(2.0, 6.0, 4000)
    f = rng.binomial(n, p)
    def fitted(f):
        return host_rules.strength(4000, float((1 / n).sum()), float((f / n).sum()), float(((f / n) ** 2).sum()))

    mean, weight = fitted(f)
    assert abs(mean - 0.25) < 0.01 and 7 < weight < 9
    assert fitted(rng.binomial(n, 0.25))[1] > 300
    assert host_rules.strength(1, 0.1, 0.5, 0.25) == (0.5, math.inf) and host_rules.strength(0, 0.0, 0.0, 0.0) == (0.0, math.inf)


def test_host_rules_of_an_empty_table(spark):
    assert host_rules.judge(host_table(spark, [])).count() == 0


# --- ranking ---

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_terms(text):
    return [t.translate(LOWER) for t in re.findall(TERM, text or "")]


def brute_ranks(docs, items, k=20):
    held = [(i, Counter(brute_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, length = len(held), sum(s for _, _, s in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item, text in items:
        asked = Counter(brute_terms(text))
        scores = []
        for i, c, size in held:
            m = 100 - 25 + (25 * size * n) // length
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1):
            out[(item, rank, i, -s)] += 1
    return out


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["Ünder", "漢字", "MiXed", "x1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randint(1, 40))) for _ in range(n)]


def rank_tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x", [1], 2) for i, t in docs], "doc_id long, text string, id int, item_id string, terms array<int>, score int")
    q = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, doc_id int, term string")
    return d, q


def test_ranking_equals_brute_force(spark):
    rng = random.Random(9)
    docs = list(enumerate(corpus(rng, 400)))
    docs += [(500, None), (501, ""), (502, "-- !! --"), (7, docs[3][1]), (None, docs[3][1]), (None, docs[3][1]), (503, docs[3][1] * 3), (504, "q" * 3_000_000 + " w1 W1")]
    items = list(enumerate(corpus(rng, 12))) + [(20, None), (21, "..."), (22, "nowhere to be found"), (3, "w1 w1 w1 w2"), (3, "w1 w1 w1 w2"), (None, "w5 MIXED x1")]
    got = ranking.ranked(*rank_tables(spark, docs, items)).collect()
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == brute_ranks(docs, items)


def test_items_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ITEM_TERMS", 10)
    rng = random.Random(10)
    docs, items = list(enumerate(corpus(rng, 60))), list(enumerate(corpus(rng, 6)))
    assert len(list(ranking.item_blocks(rank_tables(spark, docs, items)[1], "item_id", "text"))) > 2
    got = ranking.ranked(*rank_tables(spark, docs, items), k=5).collect()
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == brute_ranks(docs, items, 5)


def test_ranking_of_empty_tables(spark):
    some = [(1, "w1 w2")]
    for docs, items in ([], some), (some, []), ([], []), ([(1, None)], some):
        found = ranking.ranked(*rank_tables(spark, docs, items))
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


@pytest.mark.parametrize("short, step", [(1, 3), (4, 7), (16, 512), (10_000, 2)])
def test_hybrid_search_of_blocks(monkeypatch, short, step):
    """Whatever is short and however far a step goes: the places are those of all scores, block after block."""
    monkeypatch.setattr(ranking, "SHORT", short)
    monkeypatch.setattr(ranking, "STEP", step)
    rng = np.random.default_rng(short)
    for _ in range(30):
        places = ranking.Places(5)
        every = []
        for block in range(4):
            n = int(rng.integers(1, 80))
            lists = []
            total = np.zeros(n, np.int64)
            for _ in range(int(rng.integers(1, 7))):
                docs = np.flatnonzero(rng.random(n) < rng.random())
                gain = rng.integers(1, 6, len(docs))
                if len(docs):
                    lists.append((docs, gain))
                    total[docs] += gain
            ids = rng.permutation(1000)[:n] + 1000 * (3 - block)
            every += [(-int(s), int(i)) for s, i in zip(total, ids) if s > 0]
            if lists:
                ranking.search_block(lists, n, ids, np.zeros(n, bool), places)
        assert [(-int(s), int(i)) for s, i in zip(places.scores, places.ids)] == sorted(every)[:5]


def test_terms_across_pieces(monkeypatch):
    rng = random.Random(11)
    texts = ["", "a", " ", "-", "AbC dé漢 x-1"] + ["".join(rng.choices("aB1 -é漢\n", k=rng.randint(1, 60))) for _ in range(300)] + ["z" * 50, " " * 30]
    for size in (1, 2, 5, 16, 1000):
        monkeypatch.setattr(ranking, "PIECE", size)
        for text in texts:
            assert [t.decode() for some in ranking.terms(text.encode()) for t in some] == brute_terms(text), (size, text)


def test_registered_queries_read_whole_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert queries.QUERIES["op12_host_rules"](spark, sf_dir).count() == docs
    sizes = queries.QUERIES["op11_bisector_clusters"](spark, sf_dir).agg(F.count("*").alias("n"), F.countDistinct("cluster").alias("k")).first()
    assert sizes["n"] == spark.read.parquet(f"{sf_dir}/embeddings.parquet").count() and sizes["k"] <= 8
