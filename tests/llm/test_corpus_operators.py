"""Operators on whole corpora: near copies, byte removal, decontamination, mixing, shards, neighbours, pipeline."""

from __future__ import annotations

import hashlib
import pathlib
import random
import re
import time
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import decontaminate, mixing, neighbours, queries, sharding, simhash
from tidewatch.llm.components import components

WORD = r"[^\x20\x09-\x0D]+"


def words_of(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(n)]


def roots_of(links, items):
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


# --- SimHash ---


def brute_fingerprint(text: str | None) -> int:
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(WORD, lower)
    found = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: dict) -> dict:
    ids, values = list(prints), np.array(list(prints.values()), np.uint64)
    links = [(ids[i], ids[j]) for i in range(len(ids)) for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 2)]
    return roots_of(links, ids)


def test_simhash_of_given_documents(spark, sf_dir, documents):
    prints = {d: brute_fingerprint(t) for d, t in documents}
    roots = brute_components(prints)
    rows = queries.QUERIES["op8_covering_simhash"](spark, sf_dir).collect()
    assert len(rows) == len(documents)
    assert all(r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == roots[r["doc_id"]] for r in rows)


def test_simhash_edges(spark, make):
    rng = random.Random(5)
    base = words_of(rng, 900)
    rows = [(1, None, None), (2, "", "s"), (3, " \n\t", "s"), (4, "One two", "s"), (5, "one  TWO", "s"), (6, "É é", "s"), (8, "x " * 700_000, "s")]
    for i in range(40):  # near copies of one long text
        changed = [*base]
        changed[rng.randrange(900)] = f"w{i}"
        rows.append((100 + i, " ".join(changed), "s"))
    prints = {d: brute_fingerprint(t) for d, t, _ in rows}
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_covering_simhash"](spark, make([*rows, rows[3]])).collect()}
    roots = brute_components(prints)
    assert len({roots[d] for d in prints if d >= 100}) < 40
    assert {d: int(r["fingerprint"], 16) for d, r in got.items()} == prints
    assert {d: r["component_id"] for d, r in got.items()} == roots


def test_simhash_of_an_empty_table(spark, make):
    assert queries.QUERIES["op8_covering_simhash"](spark, make([])).count() == 0


def test_links_are_exact_in_large_buckets(spark):
    """All one-, two- and three-bit changes of a few low bits fall into one bucket of several tables."""
    rng = random.Random(1)
    center = rng.getrandbits(64)
    values = {center ^ sum(1 << b for b in rng.sample(range(0, 64, 3), rng.choice([1, 2, 3, 5]))) for _ in range(400)}
    signed = [(v - (1 << 64) if v >= 1 << 63 else v,) for v in values]
    links = simhash.links_within(spark.createDataFrame(signed, "fp0 long"))
    got = {r["node"]: r["root"] for r in components(links).collect()}
    want = brute_components({s[0]: s[0] & (1 << 64) - 1 for s in signed})
    assert {k: got.get(k, k) for k in want} == want
    assert all((int(r["u"]) ^ int(r["v"])).bit_count() <= 2 or (r["u"] ^ r["v"]) & (1 << 64) - 1 for r in links.collect())


@pytest.mark.parametrize(("width", "radius"), [(64, 2), (32, 3), (16, 1)])
def test_covering_misses_no_pair(width, radius):
    masks = simhash.covering_masks(width, radius)
    rng = random.Random(2)
    for _ in range(3_000):
        differ = sum(1 << b for b in rng.sample(range(width), radius))
        assert any(not m & differ for m in masks)


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(1_000, 1_200)]
    hub = [(5, i) for i in range(2_000, 2_300)]
    edges = chain + hub + [(9, 9), (7, 8), (8, 7)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = roots_of([e for e in edges if e[0] != e[1]], {x for e in edges if e[0] != e[1] for x in e})
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_of_each_group_of_near_copies_stays(spark, make):
    rng = random.Random(8)
    rows = []
    for g in range(30):
        base = words_of(rng, 300)
        rows.append((g * 10, " ".join(base), "s"))
        for c in range(1, 5):
            changed = [*base]
            changed[rng.randrange(300)] = f"new{c}"
            rows.append((g * 10 + c, " ".join(changed), "s"))
        rows.append((g * 10 + 9, " ".join(base), "t"))
    rows += [(9_000, None, "s"), (9_001, "", "s"), (9_002, "short text", "s"), (9_003, "other text", "s"), (None, "no id", "s"), (None, "no id", "s")]
    docs = spark.read.parquet(f"{make(rows)}/documents.parquet")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [*[g * 10 for g in range(30)], 9_000, 9_002, 9_003, None]


def brute_kept(rows, k=5):
    """Smallest ids of the groups that links of a similarity of 0.8 make, and the links, by comparing all texts."""
    sets = {}
    for d, t, _ in rows:
        words = t.split()
        sets[d] = {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}
    numbers: dict[str, int] = {}
    ids = sorted(sets)
    table = np.zeros((len(ids), len({s for x in sets.values() for s in x})), np.float32)
    for i, d in enumerate(ids):
        table[i, [numbers.setdefault(s, len(numbers)) for s in sets[d]]] = 1
    both = table @ table.T
    size = np.diag(both)
    alike = 5 * both >= 4 * (size[:, None] + size[None] - both)
    links = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(alike, 1)), strict=True)]
    return sorted(set(roots_of(links, ids).values())), links


def test_pairs_in_a_family_of_shared_boilerplate(spark, make):
    """Members of the family are just too far from each other; some have a near copy of their own."""
    rng = random.Random(11)
    shared = words_of(rng, 261)
    rows = []
    for i in range(1_000):
        own = words_of(rng, 36)
        rows.append((10 * i, " ".join(shared + own), "s"))
        if i % 20 == 0:
            changed = shared + own
            for at in rng.sample(range(297), 5):
                changed[at] = f"new{i}"
            rows.append((10 * i + 1, " ".join(changed), "s"))
    want, links = brute_kept(rows)
    assert len(links) >= 50 and len(want) == 1_000
    kept = simhash.keep_one(spark.read.parquet(f"{make(rows)}/documents.parquet"))
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_pairs_of_every_kind_of_edit(spark, make):
    """Pairs just above the similarity: a passage more or less, words changed all over, parts repeated, short and long texts."""
    rng = random.Random(12)
    rows, kinds = [], {}
    for i in range(240):
        n, kind = [60, 300, 1_200][i % 3], ["appended", "truncated", "scattered", "repeated"][i // 3 % 4]
        base = words_of(rng, n)
        other = [*base]
        if kind == "appended":
            other = base + words_of(rng, int(0.22 * n))
        elif kind == "truncated":
            other = base[: int(0.82 * n) + 1]
        elif kind == "scattered":
            for at in rng.sample(range(n), max(1, n // 55)):
                other[at] = f"new{i}"
        else:
            other = base + base[n // 2 :] * 10
        rows += [(2 * i, " ".join(base), "s"), (2 * i + 1, " ".join(other), "s")]
        kinds[2 * i] = kind
    want, links = brute_kept(rows)
    assert {kinds[a] for a, _ in links} == set(kinds.values()) and len(links) >= 200
    kept = simhash.keep_one(spark.read.parquet(f"{make(rows)}/documents.parquet"))
    assert sorted(r["doc_id"] for r in kept.collect()) == want


# --- bytes ---


def brute_bytes(rows):
    strings = Counter()
    for _, t in rows:
        b = (t or "").encode()
        strings.update(b[i : i + 200] for i in range(len(b) - 199))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        covered = bytearray(len(b))
        for i in range(len(b) - 199):
            if strings[b[i : i + 200]] > 1:
                covered[i : i + 200] = b"\1" * 200
        spans = sum(1 for i in range(len(b)) if covered[i] and not (i and covered[i - 1]))
        out.append((d, len(b), sum(covered), spans, hashlib.sha256(bytes(x for x, c in zip(b, covered, strict=True) if not c)).hexdigest()))
    return sorted(out, key=str)


def test_bytes_of_given_documents(spark, sf_dir, documents):
    rows = queries.QUERIES["op5_bucket_pointers"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows), key=str) == brute_bytes(documents)


@pytest.mark.parametrize("hot", [20_000, 3])
def test_bytes_edges(spark, make, monkeypatch, hot):
    monkeypatch.setattr("tidewatch.llm.bytededup.HOT_PARTS", hot)
    rng = random.Random(6)
    passage = " ".join(words_of(rng, 60))
    rows = [(1, None), (2, ""), (3, "a" * 199), (4, "b" * 200), (5, "c" * 201), (6, "ab " * 400), (6, "ab " * 400), (None, "é" * 150), (7, "é" * 99 + "x")]
    for i in range(12):  # a shared passage between texts of their own, and partial copies of it
        own = " ".join(words_of(rng, 70))
        rows.append((10 + i, own + passage[: rng.randint(150, len(passage))] + own[::-1]))
        rows.append((40 + i, passage[rng.randint(0, 120) :] + own[:130]))
    rows.append((90, passage + " " + passage))
    got = queries.QUERIES["op5_bucket_pointers"](spark, make([(d, t, "s") for d, t in rows])).collect()
    assert sorted(map(tuple, got), key=str) == brute_bytes(rows)


def test_bytes_of_long_texts_in_pieces(spark, make, monkeypatch):
    rng = random.Random(9)
    long = " ".join(words_of(rng, 260_000))
    assert len(long) > 1 << 20
    rows = [(1, long + "tail"), (2, "head " + long[600_000:]), (3, long[-5_000:])]
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_bucket_pointers"](spark, make([(d, t, "s") for d, t in rows])).collect()}
    assert got[3]["n_removed"] == 5_000 and got[1]["n_removed"] == len(long) - 600_000 and got[2]["n_removed"] == len(long) - 600_000


def test_bytes_of_an_empty_table(spark, make):
    assert queries.QUERIES["op5_bucket_pointers"](spark, make([])).count() == 0


# --- decontamination ---


def brute_tiles(text: list[str], item: list[str], least: int = 5) -> int:
    a, b = [False] * len(text), [False] * len(item)
    while True:
        best = (0, 0, 0)
        for i in range(len(text)):
            for j in range(len(item)):
                n = 0
                while i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return sum(b)
        n, i, j = best
        a[i : i + n] = [True] * n
        b[j : j + n] = [True] * n


def tokens_of(text: str | None) -> list[str]:
    spaced = []
    for c in (text or "").lower():
        kind = unicodedata.category(c)
        if c.isascii() and not c.isalnum() or not c.isascii() and (kind[0] in "PSZ" or kind == "Cc"):
            spaced.append(" ")
        else:
            spaced.append(f" {c} " if any(x in unicodedata.name(c, "") for x in ("CJK", "HIRAGANA", "KATAKANA", "THAI ", "LAO ")) else c)
    return "".join(spaced).split()


def brute_found(text: str | None, item: str | None) -> int | None:
    """Covered tokens where a text is contaminated by an item."""
    a, b = tokens_of(text), tokens_of(item)
    if len(b) >= decontaminate.SEED:
        covered = brute_tiles(a, b)
        return covered if covered / len(b) >= decontaminate.COVERAGE else None
    if len(b) >= decontaminate.SHORT:
        return len(b) if any(a[i : i + len(b)] == b for i in range(len(a))) else None
    return len(b) if b and a == b else None


def test_contamination_matches_brute_force(spark, tmp_path, make):
    rng = random.Random(3)
    prompt = "Answer the question below with one word: "
    items = [prompt * (k % 2) + " ".join(words_of(rng, rng.randint(14, 50))) for k in range(6)] + [None, "", "only four tokens here", "la la la la la la la la la la"]
    items += ["今天天气很好，我们一起去公园散步吧。", "wet “quoted–words” and more of them…", "three short tokens", "yes", "two words", "สวัสดีครับ"]
    docs = []
    for i in range(40):
        item = rng.choice(items[:6]).split()
        cut = len(item) // 3
        form = i % 5
        body = {
            0: item, 1: item[cut:] + words_of(rng, 3) + item[:cut], 2: item[: len(item) // 2], 3: item[::2], 4: [w if k % 7 else "changed" for k, w in enumerate(item)],
        }[form]
        docs.append((i, " ".join(words_of(rng, 30)) + ". " + ", ".join(body).upper() + "\n" + " ".join(words_of(rng, 30)), "s"))
    docs += [(90, None, "s"), (91, "", "s"), (92, "la " * 30, "s"), (93, "only four tokens here", "s"), (0, docs[0][1], "t")]
    docs += [(94, "他说：今天天气很好。然后我们一起去公园散步吧！是的", "s"), (95, "A wet quoted words, and more — of them", "s"), (96, "in all Three, SHORT tokens. Only four", "s")]
    docs += [(97, "Yes!", "s"), (98, "yes and two words", "s"), (99, "Two words", "s"), (100, prompt * 9, "s"), (101, "บอกสวัสดีครับ", "s"), (102, "天气 only three short", "s")]
    path = make(docs)
    schema = "item_id long, text string"
    spark.createDataFrame(list(enumerate(items)), schema).write.parquet(f"{path}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["covered"] for r in queries.QUERIES["op2_string_tiling"](spark, path).collect()}
    want = {}
    for d, t, _ in docs:
        for k, item in enumerate(items):
            if (c := brute_found(t, item)) is not None:
                want[d, k] = c
    assert got == want
    assert {(93, 8), (94, 10), (95, 11), (96, 12), (97, 13), (99, 14), (101, 15)} <= set(want) and not {d for d, _ in want} & {98, 100, 102}
    kept = corpus_pipeline.drop_contaminated(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _, _ in docs} - {d for d, _ in want}
    empty = spark.createDataFrame([], schema)
    assert decontaminate.contaminated(spark.read.parquet(f"{path}/documents.parquet"), empty).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 4, 40])
def test_tiles_match_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(60):
        a, b = ([rng.randrange(letters) for _ in range(rng.randint(5, 60))] for _ in range(2))
        a[9:9] = b[: rng.randint(0, len(b))]
        sides = [(np.arange(len(x) - 4), decontaminate.seeds(np.array(x, np.uint64))) for x in (a, b)]
        covered, tiles = decontaminate.tile(*sides)
        assert covered == brute_tiles(a, b) and 5 * tiles <= covered


def test_tiles_of_many_equal_tokens_and_far_places():
    same = decontaminate.seeds(np.zeros(20_000, np.uint64))
    began = time.perf_counter()
    assert decontaminate.tile((np.arange(len(same)), same), (np.arange(len(same)), same)) == (20_000, 1)
    assert decontaminate.tile((np.arange(len(same)), same), (np.arange(996), same[:996])) == (1_000, 1)
    # A text of very many tokens with seeds at both ends takes memory for the seeds only.
    assert decontaminate.tile((np.array([0, 1, 10**9]), same[:3]), (np.arange(996), same[:996])) == (11, 2)
    assert time.perf_counter() - began < 10


# --- mixing ---


def brute_targets(sizes: dict, weights=(5, 2, 1), share=1.5, ceiling=2.0) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > ceiling * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = ceiling * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check_mix(rows, source_of):
    sizes = Counter()
    taken = Counter()
    largest = Counter()
    for r in rows:
        s = source_of(r)
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
        assert 0 <= r["taken"] <= 2 * r["size"]
    target = brute_targets(dict(sizes))
    for r in rows:
        assert r["source_size"] == sizes[source_of(r)] and r["target"] == pytest.approx(target[source_of(r)])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)


def test_mix_of_given_documents(spark, sf_dir):
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_pivotal_mix"](spark, sf_dir).collect()
    assert len(rows) == len(source)
    check_mix(rows, lambda r: source[r["doc_id"]])
    again = queries.QUERIES["op10_pivotal_mix"](spark.newSession(), sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_over_several_tree_levels(spark, make, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 20)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 40), "hot" if i % 3 else rng.choice(["a", "b", None, "é"])) for i in range(3_000)]
    rows += [(5_000, None, "a"), (5_001, "", None), (5_002, "", "zero"), (1, rows[1][1], rows[1][2])]
    source = {d: s for d, _, s in rows}
    got = queries.QUERIES["op10_pivotal_mix"](spark, make(rows)).collect()
    assert len(got) == len(rows)
    check_mix(got, lambda r: source[r["doc_id"]])


def test_mix_keeps_expectations(spark, make):
    """Over seeds, a document is taken as often as its source wants it."""
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(60)]
    docs = spark.read.parquet(f"{make(rows)}/documents.parquet")
    total = defaultdict(int)
    for seed in range(12):
        for r in mixing.copies(docs, F.size(F.split("text", " ")) - 1, [F.col("doc_id")], seed=seed).collect():
            total[r["source"]] += r["mix_copies"] / 12
            want = {r["source"]: r["mix_target"] / r["mix_source_size"] for r in [r]}
            assert int(want[r["source"]]) <= r["mix_copies"] <= int(want[r["source"]]) + 1
    assert sum(total.values()) == pytest.approx(1.5 * 60, rel=0.1)


def test_mix_of_an_empty_table(spark, make):
    assert queries.QUERIES["op10_pivotal_mix"](spark, make([])).count() == 0


# --- shards ---


@pytest.mark.parametrize("n", [0, 7, 40, 1_003])
def test_shards_are_even_and_gapless(spark, make, n):
    rows = [(i if i % 5 else None, None if i % 11 == 0 else f"t{i % 50}", "s") for i in range(n)]
    got = queries.QUERIES["op7_hash_ring"](spark, make(rows)).collect()
    assert len(got) == n
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    sizes = [len(by_shard[s]) for s in range(40)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())


def test_few_rows_move_when_a_shard_joins():
    rng = random.Random(1)
    counts = Counter(rng.randrange(sharding.RING) for _ in range(100_000))
    pieces = sharding.allot(counts, 40)
    assert len(pieces) <= len(counts) + 40
    # What stays on its own arc, and what moves: an even split of 41 must move 1/41 at least.
    assert sharding.moved_share(counts, 40) < 0.25


def test_shards_replace_clashing_columns(spark, make):
    docs = spark.read.parquet(f"{make([(i, 'x', 's') for i in range(90)])}/documents.parquet")
    got = corpus_pipeline.shard(spark, docs, "")
    assert set(got.columns) == {*docs.columns, "shard", "slot"} and dict(got.dtypes)["shard"] == "int"


# --- neighbours ---


def recall_of(spark, path, rows):
    got = defaultdict(list)
    for r in queries.QUERIES["op1_nn_descent"](spark, path).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    hit = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[ids == ids[i]] = np.inf
        order = np.lexsort((ids, d))[: min(10, int(np.isfinite(d).sum()))]
        mine = got[ids[i]]
        assert [r for _, _, r in mine] == list(range(1, len(order) + 1))
        where = {int(k): v for k, v in zip(ids, d, strict=True)}
        assert all(abs(where[v] - s) < 1e-9 for v, s, _ in mine)
        assert mine == sorted(mine, key=lambda m: (m[1], m[0]))
        hit += len({v for v, _, _ in mine} & set(ids[order].tolist()))
        total += len(order)
    return hit / max(total, 1)


def test_recall_on_given_vectors(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert recall_of(spark, sf_dir, rows) >= 0.9


def store_vectors(spark, path, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank int").write.parquet(f"{path}/embeddings.parquet")


def test_copies_ties_and_unusable_vectors(spark, tmp_path):
    rng = np.random.default_rng(0)
    usable = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(1, 400)]
    usable += [(i, [1.0] + [0.0] * 7) for i in range(400, 640)]  # one vector many times
    odd = [(1_000, None), (1_001, []), (1_002, [0.0] * 8), (1_003, [float("nan")] + [1.0] * 7), (1_004, [float("inf")] * 8), (1_005, [None] + [1.0] * 7), (1_006, [1.0] * 3), (None, [1.0] * 8)]
    store_vectors(spark, str(tmp_path), [(i, v, 0, 0) for i, v in usable + odd + usable[:2]])
    assert recall_of(spark, str(tmp_path), usable) >= 0.99


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, tmp_path, n):
    rows = [(i * 100, [float(i + 1), 2.0]) for i in range(n)]
    store_vectors(spark, str(tmp_path), [(i, v, None, None) for i, v in rows])
    assert queries.QUERIES["op1_nn_descent"](spark, str(tmp_path)).count() == n * (n - 1)
    if n > 1:
        assert recall_of(spark, str(tmp_path), rows) == 1.0


def test_graph_search_without_its_lists_fails():
    assert neighbours.LIST < neighbours.BEAM


# --- pipeline ---


def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{i}")
        kept = spark.read.parquet(f"{tmp_path}/{i}")
        n = kept.count()
        if i < 4:
            assert kept.columns == docs.columns
        if i < 3:
            assert 0 < n < before or name.startswith("benchmark")
        docs, before = kept, n
    assert {"shard", "slot"} <= set(docs.columns)
    assert corpus_pipeline.run(spark, sf_dir).count() == before


def test_pipeline_edges(spark, make, tmp_path):
    rows = [(1, None, None), (1, None, None), (None, "", "s"), (2, "a b c", "s"), (3, "x " * 400_000, "t"), (4, "Some words, that are fine. " * 4, "s")]
    for data in (rows, []):
        path = make(data)
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
        spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.mode("overwrite").parquet(f"{path}/benchmark.parquet")
        result = corpus_pipeline.run(spark, path)
        assert {"doc_id", "text", "shard", "slot"} <= set(result.columns)
        assert result.count() >= (1 if data else 0)


def test_neighbours_in_a_tight_cluster(spark):
    """Thousands of distinct near copies, closer to each other than a hundredth of a vector's largest part, in large and small numbers."""
    rng = np.random.default_rng(17)
    center = rng.normal(size=64)
    near = 1e60 * (center / np.linalg.norm(center) + 1e-4 * rng.normal(size=(2_500, 64)))
    rows = [(i, v.tolist()) for i, v in enumerate(near)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in neighbours.nearest(vectors, F.col("id") < 40).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q in range(40):
        d = ((near / 1e60 - near[q] / 1e60) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(got[q] & set(np.argsort(d)[:10].tolist()))
    assert hits >= 0.95 * 400


# --- columns of any name ---


def names_in_use() -> list[str]:
    """Every name that the operators' modules put in quotes, as columns of a table could be named."""
    folder = pathlib.Path(simhash.__file__).parent
    text = "\n".join(p.read_text() for p in [*folder.glob("*.py"), pathlib.Path(corpus_pipeline.__file__)])
    found = {n.lower() for n in re.findall(r"[\"'`.]([A-Za-z_][A-Za-z0-9_]{0,20})[\"'`]", text)}
    return sorted(found - {"doc_id", "text", "source", "lang", "shard", "slot"})


def test_stages_keep_columns_of_any_name(spark, sf_dir):
    extra = names_in_use()
    assert {"digest", "__hit", "at", "kept", "late", "leaf", "__quality", "__at", "mix_size"} <= set(extra)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    docs = docs.select("*", *[F.col("doc_id").alias(n) for n in extra])
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns + (["shard", "slot"] if name == "sharding" else []), name
        rows = got.select("doc_id", F.forall(F.array(*extra), lambda x: x == F.col("doc_id")).alias("same")).collect()
        assert rows and all(r["same"] for r in rows), name


def test_one_of_rows_that_differ_in_source_only(spark):
    rows = [(1, "a b c d e f g", s, n) for s in ("z", "b", "k") for n in (3, 2)] + [(2, "h i j k l m n o p", None, 1)]
    schema = "doc_id long, text string, source string, n int"
    first = simhash.keep_one(spark.createDataFrame(rows, schema)).collect()
    again = simhash.keep_one(spark.createDataFrame(rows[::-1], schema).repartition(5)).collect()
    assert sorted((r["doc_id"], r["source"] or "", r["n"]) for r in first) == sorted((r["doc_id"], r["source"] or "", r["n"]) for r in again) == [(1, "b", 2), (2, "", 1)]


@pytest.mark.parametrize("at", [0, 3, 8])
def test_one_very_long_vector_does_not_blind_its_group(at):
    rng = np.random.default_rng(at)
    x = rng.normal(size=(4, 9, 16))
    x[1, at] *= 1e12
    want = ((x[:, :, None, :] - x[:, None, :, :]) ** 2).sum(axis=-1)
    assert np.allclose(neighbours._distances(x), want, rtol=1e-6, atol=1e-9)
    assert np.allclose(neighbours._distances(x[1]), want[1], rtol=1e-6, atol=1e-9)
