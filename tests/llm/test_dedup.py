"""Substring dedup and the Jaccard join against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tessera.llm import jaccard_join, packed, substring_dedup
from tessera.llm.components import components
from tests.llm.helpers import AWKWARD, frame, prose, words

LAST = 2**63 - 1


def brute_dedup(rows, window=50):
    first = {}
    for i, text in rows:
        w = (text or "").encode().split()
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            first[key] = min(first.get(key, LAST), LAST if i is None else i)
    out = []
    for i, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < (LAST if i is None else i):
                gone.update(range(j, j + window))
        kept = [x for n, x in enumerate(w) if n not in gone]
        out.append((i or -1, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def passages():
    shared = [words(100 + k, n) for k, n in enumerate((49, 50, 51, 60, 120, 300))]
    rng, rows = random.Random(4), []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += words(rng.randrange(10**6), rng.randint(0, 70))
            passage = rng.choice(shared)
            a = rng.randint(0, max(0, len(passage) - 50)) if rng.random() < 0.5 else 0
            parts += passage[a : a + rng.randint(40, 310)]
        rows.append((i, " ".join(parts)))
    return [*rows, (70, "again and " * 90), (71, "again and " * 70), (5, rows[9][1]), (72, rows[9][1]), (72, rows[9][1]), (None, rows[9][1])]


def test_substring_dedup_equals_brute_force(spark):
    rows = [*AWKWARD, *passages()]
    found = substring_dedup.parse(frame(spark, rows, extra=True), with_text=True).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == brute_dedup(rows)
    for r in found:
        assert sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert r["n_removed"] == 0 or hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]
    assert substring_dedup.parse(frame(spark, [])).count() == 0


def test_pieces_cover_every_window_once_and_cut_ranges_change_nothing(spark, monkeypatch):
    hashes = np.array([hash(w) & (1 << 62) - 1 for w in words(3, 400)], np.uint64)
    first, size, _, _ = substring_dedup.pieces(hashes)
    assert (first[1:] == (first + size)[:-1]).all() and first[0] == 0 and size.sum() == 351
    monkeypatch.setattr(substring_dedup, "STARTS", 37)
    rows = passages()[:20]
    found = substring_dedup.parse(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == brute_dedup(rows)


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def brute_join(rows, least=85):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [set() for _ in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= least * len(a | b):
                parent[root(i)] = root(j)
                if a != b:
                    links[i].add(b)
                    links[j].add(a)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc if doc is not None else -1, len(sets[i]), min(ids) if ids else -1, len(links[i])))
    return sorted(out)


def near_copies(seed=9, groups=6, copies=12):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = words(1000 + g, rng.choice((4, 8, 30, 90, 200)), 50)
        for c in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = f"edit{rng.randrange(30)}"
            rows.append((g * 100 + c, " ".join(text[rng.randint(0, 1) :])))
    return rows


def test_jaccard_join_equals_brute_force(spark, monkeypatch):
    rows = [*AWKWARD, *near_copies(), (800, prose(5, 60).upper()), (801, prose(5, 60)), (None, prose(5, 60)), (802, "a b c"), (803, "A B c"), (803, "A B c"), (804, "a b c d")]
    expected = brute_join(rows)
    for block in (256, 4):
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        found = jaccard_join.join(frame(spark, rows, extra=block == 4)).collect()
        assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"], r["component_id"] if r["component_id"] is not None else -1, r["n_links"]) for r in found) == expected
    kept = jaccard_join.representatives(frame(spark, rows, extra=True))
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} - {None} == {c for d, n, c, _ in expected if d == c} - {-1}
    assert kept.columns == frame(spark, rows, extra=True).columns
    assert kept.where("doc_id = 904").count() == 1
    assert jaccard_join.join(frame(spark, [])).count() == 0


def test_metric_links_meet_every_pair_once():
    rng = random.Random(2)
    base = [rng.sample(range(4000), 60) for _ in range(8)]
    sets = [np.unique(np.array([v if rng.random() > 0.03 else rng.randrange(4000) for v in rng.choice(base)], np.uint64)) for _ in range(300)]
    group = jaccard_join.Sets(sets)
    left, right = np.arange(0, 150), np.arange(150, 300)
    found = sorted((x, int(y)) for x, near in jaccard_join.metric_links(group, left, right, 85) for y in near)
    expected = [(i, j) for i in left for j in right if 100 * len(a := set(sets[i]) & set(sets[j])) >= 85 * (len(sets[i]) + len(sets[j]) - len(a))]
    assert found == expected and len(found) > 100


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (300, 300)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 0, 200: 200, 201: 200}


def test_join_takes_width_and_least(spark):
    rows = [*AWKWARD, *near_copies(), (802, "a b c d"), (803, "A B c d")]
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        if w:
            sets.setdefault(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))), []).append(doc)
    linked = [{b for b in sets if a != b and 100 * len(a & b) >= 80 * len(a | b)} for a in sets]
    expected = sorted((doc, len(a), len(near)) for (a, docs), near in zip(sets.items(), linked) for doc in docs if doc is not None)
    found = jaccard_join.join(frame(spark, rows), 80, 5).where("doc_id is not null and n_shingles > 0").collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["n_links"]) for r in found) == expected


def by_bucket(tables):
    whole = pa.concat_tables(tables, promote_options="default")
    return [whole.filter(pc.equal(whole["bucket"], b)) for b in set(whole["bucket"].to_pylist())]


@pytest.mark.parametrize("heavy", [256, 2])
def test_packed_rounds_lose_no_link(monkeypatch, heavy):
    monkeypatch.setattr(jaccard_join, "HEAVY", heavy)
    sets = {}
    for _, text in near_copies(seed=21, groups=6, copies=60):
        values = jaccard_join.shingles(text.encode())
        sets[jaccard_join.node_of(values)[0]] = values
    nodes, buckets = sorted(sets), 5
    linked = [(a, b) for i, a in enumerate(nodes) for b in nodes[:i] if 100 * (c := len(np.intersect1d(sets[a], sets[b]))) >= 85 * (len(sets[a]) + len(sets[b]) - c)]
    assert len(linked) > 100
    sent = {}
    for extra in jaccard_join.EXTRA:
        tables = []
        for part in range(3):  # three tasks; some sets are in two of them
            regions = jaccard_join.Regions(buckets)
            for i, node in enumerate(nodes):
                if i % 3 == part or i % 7 == part:
                    regions.add(node, jaccard_join.shown(sets[node], 85, extra))
            names = jaccard_join._names(jaccard_join._REGION)
            kinds = [pa.int64(), *[pa.binary()] * 4]
            tables.append(pa.table({n: pa.array(c, k) for n, c, k in zip(names, regions.rows(), kinds)}))
        sent[extra] = by_bucket(tables)
    first, second = jaccard_join.EXTRA
    met = {}
    for table in map(jaccard_join._counted, sent[first]):
        for node, times in zip(table["node"].to_pylist(), table["met"].to_pylist()):
            met[node] = met.get(node, 0) + times
    assert all(met.get(n, 0) >= jaccard_join._needed(len(sets[n]), 85, first) for pair in linked for n in pair)
    own = np.array(nodes)
    order = np.argsort(own.view(np.uint64))
    columns = packed.dealt(buckets, (own.view(np.uint64)[order], np.array([len(sets[n]) for n in nodes], np.uint64)[order]))
    sizes = pa.table({"bucket": pa.array(columns[0], pa.int64()), "names": pa.array(columns[1], pa.binary()), "sizes": pa.array(columns[2], pa.binary())})
    edges = [jaccard_join._edges(t, 85) for t in by_bucket([*(jaccard_join._pointed(t, buckets) for t in sent[second]), sizes])]
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for table in edges:
        for a, b in zip(table["a"].to_pylist(), table["b"].to_pylist()):
            parent[root(a)] = root(b)
    assert all(root(a) == root(b) for a, b in linked)
    assert len({root(n) for n in nodes}) > 1


def test_representatives_are_the_same_at_every_run_and_keep_values(spark):
    rows = [(1, prose(3, 40), "en", "b"), (1, prose(3, 40), "en", "a"), (2, prose(3, 40), "en", "c"), (None, None, "en", "d"), (4, "", "en", "e")]
    docs = frame(spark, rows, extra=True)
    found = [sorted(map(str, jaccard_join.representatives(docs.repartition(n)).collect())) for n in (1, 4)]
    assert found[0] == found[1] and len(found[0]) == 3
    assert all("component_id='x'" in r and "all='x'" in r and "key_id='x'" in r for r in found[0])
    assert jaccard_join.representatives(frame(spark, [])).count() == 0
