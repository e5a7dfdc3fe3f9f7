"""Top-k, sharding, secrets and decontamination against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import decontamination, secrets, sharding, top_k
from tests.llm.helpers import AWKWARD, frame, prose, words

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_top(rows, k=10):
    good = [(i, [int(np.floor(1024.0 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in good if i % 100 == 0}):
        q = min(v for n, v in good if n == i)
        found = sorted((-max(2 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), n) for n, v in good if n != i)[:k]
        out += [(i, r, n, -s) for r, (s, n) in enumerate(found, 1)]
    return out


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 8))
    rows = [(i, [float(x) for x in (centres[i % 5] + rng.normal(size=8) * 0.3).round(1)]) for i in range(700)]
    rows += [(None, [1.0] * 8), (701, None), (702, [None] + [1.0] * 7), (703, [float("nan")] + [1.0] * 7), (704, [float("inf")] * 8), (705, [1.0, 2.0]), (706, []), (707, rows[3][1]), (707, rows[3][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumns({"score": F.lit(1), "rank": F.lit(2), "query_id": F.lit(3)})
    for batch in (4096, 3):
        found = sorted(tuple(r) for r in top_k.top_k(df.repartition(3), F.col("vec_id") % 100 == 0, batch=batch).collect())
        assert found == sorted(brute_top(rows))


def test_top_k_of_few_huge_and_no_rows(spark):
    rows = [(0, [1e30, -1e30]), (1, [1e30, 1.0]), (2, [-1e30, 1.0]), (100, [1e12, 1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    assert sorted(tuple(r) for r in top_k.top_k(df, F.col("vec_id") % 100 == 0).collect()) == sorted(brute_top(rows))
    assert top_k.top_k(df.where("vec_id < 0"), F.col("vec_id") % 100 == 0).count() == 0


def slow_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_sharding(spark):
    rows = [*AWKWARD, *((i, prose(i % 7, 5)) for i in range(2000)), *((5000, "same") for _ in range(25))]
    found = sharding.assign(frame(spark, rows, extra=True), 40).collect()
    expected = sorted((i if i is not None else -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "key", slow_jump(i or 0, 40), slow_jump(i or 0, 41)) for i, t in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in found) == expected
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.assign(frame(spark, []), 40).count() == 0


def test_slots_of_many_buckets_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 16)
    monkeypatch.setattr(sharding, "COPIES", 7)
    rows = [*((i, "x") for i in range(300)), *((7, "x") for _ in range(40)), (7, "a longer one"), (None, "x"), (None, None)]
    found = sharding.assign(frame(spark, rows), 3).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append((r["slot"], r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]))
    assert len(found) == len(rows) and all([s[0] for s in sorted(v)] == list(range(len(v))) for v in slots.values())
    for v in slots.values():
        assert [s[1:] for s in sorted(v)] == sorted(s[1:] for s in v)


ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


def secret_rows():
    live, example = "Zx81kkPq0aLm55TTrewQ9Zbb", "Ab12Cd34Ef56Gh78Ij90Kl12"
    rows = [(i, f"see {example} here", "en", f"repo{i}") for i in range(5)]
    rows += [(10, f"mine {live} and é\U0001f600 {live}!", "en", "own"), (11, f"PASSWORD = 'abcdefgh' {'0af' * 20} token:x api_key=\"{live}\"", "en", "own")]
    rows += [(12, "AKIA" + "A1" * 8 + " AKIAX secret: \"secret\": abcdefghijk token: secret=abcdefghij", "en", "z"), (13, " ".join(f"token={'f0' * 16}{k:04x}" for k in range(700)), "en", "z")]
    return [*AWKWARD, *rows, (14, f"x {example}", None, None), (14, f"x {example}", None, None)]


def test_secrets_keep_base_spans_and_add_owned_ones(spark):
    rows = secret_rows()
    docs = frame(spark, rows, extra=True)
    found = secrets.digests(docs).collect()
    assert len(found) == len(rows)
    by_digest = defaultdict(list)
    for r in found:
        by_digest[r["doc_id"]].append((r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]))
    for row in rows:
        spans = base_spans(row[1])
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode()).hexdigest()
        assert (*(sum(s[2] == k for s in spans) for k in ("assign", "access", "hex")), digest) in by_digest[row[0]]
    spans = {r["doc_id"]: r["spans"] for r in found}
    assert spans[0] == "" and spans[10].count("owned") == 2 and "owned:5:29" in spans[10]
    masked = {r["doc_id"]: r["text"] for r in secrets.masked(docs).collect()}
    assert masked[10] == "mine <secret> and é\U0001f600 <secret>!" and masked[0] == rows[len(AWKWARD)][1] and masked[900] is None
    assert secrets.masked(docs).columns == docs.columns
    assert secrets.digests(frame(spark, [])).count() == 0
    plan = secrets.digests(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def item_rows():
    return [(1, prose(50, 30)), (2, prose(51, 12)), (3, "Only five words, yes: five"), (4, "one"), (5, None), (6, ""), (7, prose(50, 15)), (None, prose(52, 11)), (8, "only five words yes five and then it goes on for more"), (9, "é1 Ü2 x")]


def brute_hits(text, items, window=10):
    w = decontamination.words_of((text or "").encode())
    hit, names = set(), set()
    for name, t in items:
        x = decontamination.words_of((t or "").encode())
        k = min(window, len(x))
        for j in range(len(x) - k + 1) if k else ():
            for i in range(len(w) - k + 1):
                if w[i : i + k] == x[j : j + k]:
                    hit.update(range(i, i + k))
                    names.add(str(name) if name is not None else "null")
    return len(w), len(hit), sorted(names)


def test_decontamination_equals_brute_force(spark):
    a, b = words(50, 30), words(51, 12)
    rows = [(1, " ".join(words(1, 40) + a + words(2, 10))), (2, " ".join(a[5:16] + b[1:11] + a[:9])), (3, "and ONLY, five words. Yes -- five! " + prose(3, 20)), (4, " ".join(a[:10] * 3)), (5, "zero one two é1 ü2 Ü2 É1"), (6, prose(50, 30)), (7, prose(60, 200, 12))]
    rows = [*AWKWARD, *rows, rows[1]]
    items = spark.createDataFrame(item_rows(), "item_id bigint, text string")
    docs = frame(spark, rows, extra=True)
    expected = sorted((i if i is not None else -1, *brute_hits(t, item_rows())) for i, t in rows)
    for size in (8_000_000, 60):
        found = decontamination.hits(docs, items, block_bytes=size).collect()
        assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_hit"], r["items"]) for r in found) == expected
    clean = {r["doc_id"]: r["text"] for r in decontamination.decontaminated(docs, items).collect()}
    in_passes = decontamination.decontaminated(docs.withColumn("found", F.lit("keep")), items, block_bytes=60).collect()
    assert all(r["found"] == "keep" for r in in_passes) and sorted((r["doc_id"] or -1, r["text"] or "") for r in in_passes) == sorted((r["doc_id"] or -1, r["text"] or "") for r in decontamination.decontaminated(docs, items).collect())
    assert 6 not in clean and clean[900] is None and clean[7] == rows[len(AWKWARD) + 6][1]
    assert clean[1].split() == words(1, 40) + words(2, 10)
    assert decontamination.hits(docs, items.where("item_id < 0")).where("n_hit > 0").count() == 0
    assert decontamination.hits(frame(spark, []), items).count() == 0


def test_masking_keeps_values_of_clashing_columns(spark):
    names = ("own_id", "own_row", "own_all", "masked_id", "masked_row", "masked_spans", "spans", "hash")
    docs = frame(spark, [(1, "token = Zk81kkPq0aLm55"), (2, "nothing"), (None, None), (4, "")]).withColumns({c: F.lit("keep") for c in names})
    found = secrets.masked(docs).collect()
    assert secrets.masked(docs).columns == docs.columns and all(r[c] == "keep" for r in found for c in names)
    assert {(r["doc_id"], r["text"]) for r in found} == {(1, "<secret>"), (2, "nothing"), (None, None), (4, "")}
    assert secrets.masked(frame(spark, [])).count() == 0


def test_spans_of_a_long_text(spark):
    text = "ordinary words " * 40_000 + "token: abcdefgh1"
    found = secrets.digests(frame(spark, [(1, text)])).first()
    assert found["n_assign"] == 1 and found["spans"] == f"assign:{len(text) - 16}:{len(text)}"
