"""The pipeline on a small corpus with planted cases, and the driver's contract."""

import random

import pytest

import corpus_pipeline
from tessera.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.helpers import AWKWARD, frame, prose
from tests.llm.test_models import SYLLABLES, spoken


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    path = str(tmp_path_factory.mktemp("tables"))
    item = spoken(rng, "bb", 40)
    texts = [(i, spoken(rng, lang, 80), lang, f"src{i % 5}") for i in range(90) for lang in [sorted(SYLLABLES)[i % 3]]]
    texts += [(100, texts[4][1], "aa", "x"), (101, texts[4][1] + " ka", "aa", "x"), (102, f"{texts[5][1]} {item} {spoken(rng, 'cc', 60)}", "cc", "x"), (103, item, "bb", "x"), (104, texts[8][1][::-1] + " token = Zk81kkPq0aLm55", "bb", "x")]
    frame(spark, [*AWKWARD, *texts]).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_take_effect_and_keep_clean_documents(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "SentencePiece encoding and decoding"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.saved(stage(spark, docs, folder))
        assert n == 4 or docs.columns == columns
        seen.append({r["doc_id"]: r for r in docs.collect()})
    clean = set(range(90))
    assert not {900, 901, 902, 906} & seen[0].keys() and clean <= seen[0].keys()
    assert not {100, 101} & seen[1].keys() and clean <= seen[1].keys()
    assert 103 not in seen[2] and len(seen[2][102]["text"].split()) == 140 and clean <= seen[2].keys()
    assert "<secret>" in seen[3][104]["text"] and all(seen[3][i]["text"] == seen[0][i]["text"] for i in clean)
    assert all(r["round_trip"] for r in seen[4].values()) and clean <= seen[4].keys()
    again = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, folder).collect()}
    assert again == {i: list(r["ids"]) for i, r in seen[4].items()}


def test_every_operator_has_one_query():
    import __spark_entry__

    found = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert "pipeline" in found and set(ORACLE_SQL) <= set(QUERIES)
    assert prose(1, 3)


def test_near_duplicate_stage_takes_five_words_and_80_percent(spark):
    base = [f"v{i}" for i in range(100)]
    edited, further = list(base), list(base)
    for i in (30, 60):
        edited[i] = "other"  # 89 of 105 four-word shingles, 86 of 106 five-word ones
    for i in (20, 50, 80):
        further[i] = "another"  # 81 of 111 five-word ones
    docs = frame(spark, [(1, " ".join(base)), (2, " ".join(edited)), (3, " ".join(further))])
    assert {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, "").collect()} == {1, 3}
