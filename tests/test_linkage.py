"""Retrieval, labels, evaluation, threshold and output on small planted tables."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.config import Settings
from tessera.functions.similarity import FEATURES
from tessera.operators import blocking, evaluation, features, labels, model, output, profile, threshold, tfidf
from tessera.sources import delimited as files

RECORD = "entity_id string, source string, business_name string, business_address string, country string"


def grams_of(text):
    out = Counter()
    for token in text.split():
        padded = f" {token} "
        for n in (2, 3):
            out.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    return out


def plain_vectors(texts):
    tf = [grams_of(t) for t in texts]
    df = Counter(g for t in tf for g in t)
    out = []
    for t in tf:
        v = {g: (1 + math.log(c)) * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, c in t.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        out.append({g: x / size for g, x in v.items()})
    return out


def records(n=60, seed=3):
    rng = random.Random(seed)
    parts = ["acme", "tools", "davis", "family", "office", "north", "gate", "bakery", "12", "7"]
    return [(f"S{i % 3 + 1}-{i}", f"S{i % 3 + 1}", " ".join(rng.choices(parts, k=3)), " ".join(rng.choices(parts, k=rng.randint(0, 3))), rng.choice(["US", "us", "de", ""])) for i in range(n)]


def normalized(spark, rows):
    return spark.createDataFrame(rows, RECORD).withColumns({"norm_name": F.col("business_name"), "norm_address": F.col("business_address")})


def test_tfidf_vectors_of_two_texts(spark):
    rows = normalized(spark, [("S1-1", "S1", "a", "", ""), ("S2-2", "S2", "ab", "", "")])
    tf = tfidf.grams(rows)
    idf = {r["gram"]: r["idf"] for r in tfidf.fit(rows, tf).collect()}
    assert idf[" a"] == pytest.approx(1) and idf["ab"] == pytest.approx(1.405465, abs=1e-6)
    w = {(r["entity_id"], r["gram"]): r["w"] for r in tfidf.weights(tf, tfidf.fit(rows, tf)).collect()}
    assert w["S1-1", " a"] == pytest.approx(0.449436, abs=1e-6) and w["S2-2", " a"] == pytest.approx(0.335176, abs=1e-6)


def test_coded_grams_are_those_of_each_text():
    texts = ["acme tools", "", "a", None, "aa aa\x1caa", "x" * 9, " é\U0001f600 b "]
    place, code, n = tfidf.coded(texts)

    def gram(c):
        return "".join(chr(x) for x in (c >> 42, c >> 21 & 0x1FFFFF)) + (chr((c & 0x1FFFFF) - 1) if c & 0x1FFFFF else "")

    found = defaultdict(Counter)
    for p, c, x in zip(place.tolist(), code.tolist(), n.tolist()):
        found[p][gram(c)] += x
    assert {i: grams_of(t) for i, t in enumerate(texts) if t and t.strip()} == dict(found)


def test_ties_leave_a_block_as_k_rows(spark):
    rows = [("S1-1", "S1", "acme tools", "", "")] + [(f"S2-{i}", "S2", "acme tools", "", "") for i in range(100, 400)]
    df = normalized(spark, rows)
    tf = tfidf.grams(df, fields={"name": "norm_name"})
    found = blocking.scored(tfidf.vectors(tfidf.weights(tf, tfidf.fit(df, tf)))).collect()
    assert sorted(r["cand_id"] for r in found) == [f"S2-{i}" for i in range(100, 110)]


def test_tiles_of_a_block_equal_brute_force(monkeypatch):
    rng = random.Random(5)
    texts = [f"customer {rng.randrange(10**6):06d}" for _ in range(150)]
    texts += texts[60:100]
    grams = sorted({g for t in texts for g in grams_of(t)})
    number, vectors = {g: k for k, g in enumerate(grams)}, plain_vectors(texts)
    cells = [sorted((number[g], w) for g, w in v.items()) for v in vectors]
    sides = ["S1"] * 37 + ["S2"] * (len(texts) - 37)
    block = pa.table({"country": ["c"] * len(texts), "key": [str(i) for i in range(len(texts))], "ids": [[f"{i:03d}"] for i in range(len(texts))], "source": sides, "field": ["name"] * len(texts)})
    block = block.append_column("grams", pa.array([[g for g, _ in c] for c in cells], pa.list_(pa.int64()))).append_column("weights", pa.array([[w for _, w in c] for c in cells], pa.list_(pa.float64())))
    dot = lambda a, b: sum(w * b.get(g, 0.0) for g, w in a.items())
    expected = {}
    for q in range(37):
        scores = sorted((-round(dot(vectors[q], vectors[p]), 9), f"{p:03d}") for p in range(37, len(texts)))
        expected[str(q)] = [(i, -s) for s, i in scores[:4] if -s >= 0.05]
    wide = []
    monkeypatch.setattr(blocking.np, "ix_", lambda *a, f=np.ix_: wide.append(a) or f(*a))
    for tile in ((128, 32_768), (5, 16)):
        monkeypatch.setattr(blocking, "TILE", tile)
        monkeypatch.setattr(blocking, "SLAB", 3)
        monkeypatch.setattr(blocking, "FIRST", 8)
        found = defaultdict(list)
        for r in blocking._block(block, 4, 0.05).to_pylist():
            found[r["key"]].append((r["ids"][0], round(r["score"], 9)))
        assert {k: sorted(v, key=lambda x: (-x[1], x[0])) for k, v in found.items()} == expected
    assert not wide  # no step for each gram of a tile


def test_each_text_is_scored_once_for_all_records_that_have_it(spark):
    rows = [(f"{r[0]}{copy}", *r[1:]) for r in records() for copy in range(4)]
    df = normalized(spark, rows).repartition(3)
    top = blocking.top_texts(df, {"name": "norm_name"})
    texts = {(r[4].lower(), r[2]) for r in rows if r[1] == "S1"}
    assert top.count() <= len(texts) < sum(r[1] == "S1" for r in rows)
    tf = tfidf.grams(df)
    expected = blocking.retrieve(tfidf.vectors(tfidf.weights(tf, tfidf.fit(df, tf))))
    same = blocking.alike(df)
    found = blocking.retrieve_alike(df, same)
    assert found.select("s1_id").distinct().count() < expected.select("s1_id").distinct().count()
    whole = found.withColumnRenamed("s1_id", "rep").join(same, "rep").select(*expected.columns)
    shown = [sorted((r["s1_id"], r["cand_id"], r["source"], r["rank"], round(r["score"], 6)) for r in d.collect()) for d in (whole, expected)]
    assert shown[0] == shown[1]


@pytest.mark.parametrize("blocks", [(512, 4096), (3, 5)])
def test_retrieval_equals_brute_force(spark, blocks):
    rows = records()
    df = normalized(spark, rows).repartition(5)
    tf = tfidf.grams(df)
    vectors = tfidf.vectors(tfidf.weights(tf, tfidf.fit(df, tf)))
    top = blocking.top_by_field(blocking.scored(vectors, 4, 0.05, *blocks), 4)
    fused = blocking.capped(blocking.fused(top, Settings(top_k=4)), 5)
    plain = {"name": plain_vectors([r[2] for r in rows]), "address": plain_vectors([r[3] for r in rows])}
    expected, sums = {}, defaultdict(float)
    for i, a in enumerate(rows):
        for field, vectors_ in plain.items():
            found = defaultdict(list)
            for j, b in enumerate(rows):
                score = sum(x * vectors_[j].get(g, 0) for g, x in vectors_[i].items())
                if a[1] == "S1" and b[1] != "S1" and a[4].lower() == b[4].lower() and score >= 0.05:
                    found[b[1]].append((-round(score, 9), b[0]))
            for source, scores in found.items():
                for score, name in sorted(scores)[:4]:
                    expected[a[0], name, field] = -score
                    sums[a[0], source, name] += (0.6 if field == "name" else 0.4) * -score
    got = {(r["s1_id"], r["cand_id"], r["field"]): r["score"] for r in top.collect()}
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k], abs=1e-8) for k in got)
    by_source, final = defaultdict(list), defaultdict(list)
    for (a, source, b), score in sums.items():
        if round(score, 9) >= 0.05:
            by_source[a, source].append((-round(score, 9), b))
    for (a, _), found in by_source.items():
        final[a] += sorted(found)[:4]
    assert {(r["s1_id"], r["cand_id"]) for r in fused.collect()} == {(a, b) for a, found in final.items() for _, b in sorted(found)[:5]}


def pairs(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, cand_id string")


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "s1_id string")


def case(spark):
    truth = pairs(spark, [("E1", "S2-1"), ("E1", "S3-1"), ("E4", "S3-4"), ("E5", "S2-5")])
    said = pairs(spark, [("E1", "S2-1"), ("E3", "S2-9"), ("E5", "S2-5"), ("E5", "S3-5"), ("other", "S2-1")])
    return ids(spark, ["E1", "E2", "E3", "E4", "E5"]), truth, said


def test_evaluation_case(spark):
    counts = evaluation.entity_counts(*case(spark))
    each = {r["s1_id"]: round(r["f05"], 6) for r in evaluation.entity_metrics(counts).collect()}
    assert each == {"E1": 0.833333, "E2": 1, "E3": 0, "E4": 0, "E5": 0.555556}
    r = evaluation.report(counts).first()
    assert (r["macro_f05"], r["macro_precision"], r["macro_recall"]) == (0.477778, 0.3, 0.3)
    assert (r["micro_precision"], r["micro_recall"], r["micro_f05"]) == (0.5, 0.5, 0.5)
    assert (r["singletons"], r["matched"], r["singleton_accuracy"]) == (2, 3, 0.5)
    t = evaluation.tuning_metrics(counts).first()
    assert (t["precision"], t["recall"], t["f1"]) == (0.5, 0.5, 0.5)
    nobody = evaluation.entity_counts(ids(spark, []), *case(spark)[1:])
    assert evaluation.macro_f05(nobody).first()[0] == 0 and evaluation.report(nobody).first()["macro_f05"] == 0


def test_threshold_curve_equals_one_pass_for_each_point(spark):
    rng = random.Random(5)
    entities, truth, _ = case(spark)
    scores = spark.createDataFrame([(f"E{rng.randint(1, 6)}", f"S{rng.randint(2, 3)}-{i % 6}", rng.random()) for i in range(60)], "s1_id string, cand_id string, proba double").dropDuplicates(["s1_id", "cand_id"]).cache()
    points = [r["threshold"] for r in threshold.grid(spark).orderBy("step").collect()]
    assert len(points) == 81 and points[-1] == 0.8999999999999996
    curve = {r["threshold"]: r for r in threshold.curve(scores, truth, entities).collect()}
    for t in points[::9]:
        expected = evaluation.tuning_metrics(evaluation.entity_counts(entities, truth, threshold.decided(scores, t))).first()
        assert all(curve[t][c] == pytest.approx(expected[c]) for c in threshold.METRICS)
    best = threshold.best(threshold.curve(scores, truth, entities)).first()
    assert best["f05"] == max(r["f05"] for r in curve.values())
    with pytest.raises(ValueError):
        threshold.best(scores, "accuracy")


def test_labels_and_counts_deal_pairs_by_entity_only(spark, capsys):
    entities, truth, found = case(spark)
    frames = [labels.labelled(found, truth), labels.positives(found, truth), labels.negatives(found, truth)]
    for frame in [*frames, evaluation.entity_counts(entities, truth, found)]:
        capsys.readouterr()
        frame.explain()
        dealt = [x.split("hashpartitioning(")[1].split(")")[0] for x in capsys.readouterr().out.splitlines() if "hashpartitioning(" in x]
        assert dealt and not any("cand_id" in x for x in dealt)


def test_sampling_and_split(spark):
    rows = [("a", f"S2-{i}", int(i == 0)) for i in range(7)] + [("b", f"S2-{i}", int(i == 0)) for i in range(4)] + [("c", f"S2-{i}", 0) for i in range(5)]
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, label int")
    sample = labels.sampled(df)
    assert {r["s1_id"]: r["count"] for r in sample.groupBy("s1_id").count().collect()} == {"a": 6, "b": 4, "c": 2}
    assert sorted(map(tuple, labels.sampled(df.repartition(7)).collect())) == sorted(map(tuple, sample.collect()))
    for n, expected in ((5, 1), (25, 2), (0, 0)):
        split = labels.split(ids(spark, [f"E{i}" for i in range(n)]))
        assert split.where("is_val").count() == expected and split.count() == n
    b = labels.balance(df).first()
    assert (b["positives"], b["negatives"], b["positive_weight"]) == (2, 14, 7)
    truth = pairs(spark, [("a", "S2-0"), ("z", "S2-1")])
    assert labels.positives(df, truth).count() == 1 and labels.negatives(df, truth).count() == 15
    assert labels.labelled(df.drop("label"), truth).where("label = 1").count() == 1


def test_features_keep_missing_records_as_zeros(spark):
    rows = normalized(spark, [("S1-1", "S1", "acme", "1 road", "us"), ("S2-2", "S2", "acme", "1 road", "US"), ("S2-2", "S2", "other", "1 road", "US"), ("S3-3", "S3", "", "", "")])
    table = features.feature_table(pairs(spark, [("S1-1", "S2-2"), ("S1-1", "S2-404"), ("S1-404", "S3-3")]), rows.where("source='S1'"), rows.where("source<>'S1'"), unique=False)
    found = {r["cand_id"]: r for r in table.collect()}
    assert len(found) == 3 and not found["S2-2"]["missing"] and found["S2-404"]["missing"] and found["S3-3"]["missing"]
    assert all(found["S2-404"][f] == 0 for f in features.FEATURES) and found["S2-2"]["country_match"] == 1
    m = features.missing_counts(pairs(spark, [("S1-1", "S2-404"), ("S1-404", "S3-3")]), rows.where("source='S1'"), rows.where("source<>'S1'")).first()
    assert tuple(m) == (1, 1)


def test_output(spark):
    s1, valid = ids(spark, ["S1-1", "S1-2"]), spark.createDataFrame([("S2-1",), ("S3-1",), ("S2-10",)], "entity_id string")
    said = pairs(spark, [("S1-1", "S3-1"), ("S1-1", "S2-10"), ("S1-1", "S2-1"), ("S1-1", "S1-2"), ("S1-1", "S2-99"), ("S1-9", "S2-1")])
    results = output.matching_results(said, s1, valid)
    assert {tuple(r) for r in results.collect()} == {("S1-1", "S2-1,S2-10,S3-1"), ("S1-2", "")}
    assert tuple(output.match_rate(results).first()) == (2, 1, 1, 50.0)
    assert output.violations(said, pairs(spark, [("S1-1", "S3-1")])).count() == 5
    assert [r[0] for r in output.uncovered(s1, said).collect()] == ["S1-2"]
    assert files.to_pairs(results, "matched_entity_ids").count() == 3


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (2, "a", None), (3, None, "xyz")], "k int, s string, t string")
    by = {r["column"]: r for r in profile.columns(df).collect()}
    assert (by["s"]["n_distinct"], by["s"]["n_null"], by["s"]["null_pct"], by["k"]["uniqueness"]) == (1, 1, 25.0, 0.75)
    assert tuple(profile.duplicates(df).first()) == (4, 1, 25.0)
    assert [tuple(r) for r in profile.value_counts(df, "s").collect()] == [("a", 3, 75.0), ("MISSING", 1, 25.0)]
    assert profile.label_counts(df) is None and tuple(profile.id_uniqueness(df, "k").first()) == (4, 3, 1)
    assert profile.null_shares(df).first()["column"] == "t"
    assert profile.describe(df).first()["q50"] == 2.0 and profile.numeric_columns(df) == ["k"]
    assert sum(r["n"] for r in profile.length_histogram(df, "t").collect()) >= 3
    assert profile.summary({"x": df}).first()["missing_cells"] == 4
    assert {r["column"]: r["high"] for r in profile.lengths(df).collect()} == {"s": 1, "t": 3}


def test_losses_of_each_tree(spark):
    rows = spark.range(400).select(*(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(100)).cast("double").alias(c) for c in FEATURES), (F.col("id") % 4 == 0).alias("is_val"))
    rows = rows.withColumn("label", (F.col(FEATURES[0]) > 50).cast("int")).cache()
    fitted = model.train(rows, Settings(depth=2, least_rows=1), trees=4)
    found = model.losses(fitted, rows.where("is_val"))
    # Early stopping may keep fewer trees than it grew.
    assert 1 < len(found) == fitted.stages[-1].getNumTrees <= 4 and found == sorted(found, reverse=True) and found[0] > found[-1] > 0


def test_preview(spark):
    assert profile.preview(spark.range(9), 3).count() == 3 and profile.preview(spark.range(0)).count() == 0
