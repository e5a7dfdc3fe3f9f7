"""Files, whole runs, streaming and the driver's contract."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera import oracle, queries
from tessera.config import Settings
from tessera.functions.text import with_normalized
from tessera.operators import blocking, tfidf
from tessera.plans.linkage import Linkage, main
from tessera.sources import delimited as files
from tessera.streaming.arrivals import link_arrivals

DATA = "/root/testdata/sf0.001"


def write(path, header, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join("\t".join(r) for r in [header, *rows]) + "\n")


def test_delimited_files(spark, tmp_path):
    path = str(tmp_path / "x.tsv")
    write(path, files.RECORD, [["S1-1", "NA", "", "null"], ["S1-2", '"a ""b""\tc"', '"two\nlines"', "nan"], ["S1-3", '""', "x", ""]])
    rows = {r["entity_id"]: r for r in files.fill_missing(files.read_table(spark, path, files.RECORD)).collect()}
    assert tuple(rows["S1-1"])[1:] == ("NA", "", "null") and tuple(rows["S1-2"])[1:] == ('a "b"\tc', "two\nlines", "nan") and tuple(rows["S1-3"])[1:] == ("", "x", "")
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, str(tmp_path / "none.tsv"))
    with pytest.raises(ValueError):
        files.read_table(spark, path, ("absent",))
    out = str(tmp_path / "out.tsv")
    files.save_table(files.read_table(spark, path), out, single=True)
    again = files.read_table(spark, out, files.RECORD)
    assert sorted(map(str, again.collect())) == sorted(map(str, files.read_table(spark, path, files.RECORD).collect()))
    assert files.list_files(spark, str(tmp_path))[-1].endswith("x.tsv") and files.load_sample(spark, path, 2).count() == 2
    assert files.load_threshold(spark, str(tmp_path / "t")) == 0.5
    files.save_threshold(spark, 0.37, str(tmp_path / "t"))
    assert files.load_threshold(spark, str(tmp_path / "t")) == 0.37


def test_stage_is_read_unless_it_lacks_entities(spark, tmp_path):
    made = []

    def make(n):
        def run():
            made.append(n)
            return spark.range(n).select(F.col("id").cast("string").alias("s1_id"))

        return run

    path = str(tmp_path / "stage")
    wanted = spark.range(3).select(F.col("id").cast("string").alias("s1_id"))
    files.stage(spark, path, make(2))
    assert files.stage(spark, path, make(9)).count() == 2
    assert files.stage(spark, path, make(3), covers=wanted).count() == 3
    assert files.stage(spark, path, make(4), force=True).count() == 4 and made == [2, 3, 4]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Sources with exact, typing-error, abbreviation and address-only matches, singletons and missing fields."""
    path, rng = tmp_path_factory.mktemp("sources"), random.Random(2)
    names = ["acme", "davis", "olive", "north", "harbor", "silver", "maple", "stone", "river", "eagle", "lotus", "pioneer"]
    kinds = ["tools", "bakery", "shipping", "realty", "consultancy", "textiles"]
    for split in ("train", "test"):
        s1, s2, s3, truth = [], [], [], []
        for i in range(60):
            name, place = f"{rng.choice(names)} {rng.choice(names)} {rng.choice(kinds)} {rng.randint(1, 99)}", f"{rng.randint(1, 999)} {rng.choice(names)} road"
            country = rng.choice(["US", "IN", ""])
            s1.append([f"S1-{i}", f"{name} Inc", place, country])
            mine = []
            if i % 5:
                s2.append([f"S2-{i}", f"{name} incorporated", place.replace("road", "rd"), country])
                mine.append(f"S2-{i}")
            if i % 3:
                s3.append([f"S3-{i}", name[:-4] + name[-3:], place, country])
                mine.append(f"S3-{i}")
            s2.append([f"S2-9{i}", f"{rng.choice(names)} {rng.choice(kinds)}", f"{rng.randint(1, 999)} {rng.choice(names)} street", country])
            truth.append([f"S1-{i}", ",".join(mine)])
        for n, rows in enumerate((s1, s2, s3), 1):
            write(path / f"{split}_source{n}.tsv", files.RECORD, rows)
        if split == "train":
            write(path / "train_ground_truth.tsv", files.TRUTH, truth)
    return str(path)


def test_full_run(spark, folder, tmp_path):
    settings = Settings(trees=8, depth=3, least_rows=1, validation_share=0.3)
    run = Linkage(spark, folder, str(tmp_path), settings)
    stats = run.train().first()
    assert stats["recall_ceiling"] > 0.9 and 0 < stats["reduction_ratio"] < 1
    results, broken = run.predict("test")
    assert [r[0] for r in results.collect()] == [f"S1-{i}" for i in range(60)] and broken.count() == 0
    written = spark.read.csv(f"{tmp_path}/matching_results.tsv", sep="\t", header=True).select("source1_entity_id").collect()
    assert [r[0] for r in written] == [f"S1-{i}" for i in range(60)]
    assert run.scored("test").where("proba between 0 and 1").count() >= 60 and 0 < run.tune_saved() < 1
    assert run.evaluate().first()["macro_f05"] > 0.6
    assert len([f for f in os.listdir(tmp_path) if f.startswith("candidates-")]) == 2
    before = run.candidates(run.records("test"), "test")
    assert {r["s1_id"].split("-")[0] for r in before.collect()} == {"S1"}
    run.run("EVAL")
    with pytest.raises(ValueError):
        run.run("other")
    assert main(["--mode", "eval", "--data", str(tmp_path / "nowhere"), "--work", str(tmp_path / "w"), "--log-level", "critical"]) == 1


def test_arrivals_add_up_to_one_batch_run(spark, folder, tmp_path):
    s1, s2, s3 = files.load_sources(spark, folder)
    rows = with_normalized(s1.unionByName(s2).unionByName(s3))
    tf = tfidf.grams(rows)
    vocabulary = tfidf.fit(rows, tf)
    arrived = str(tmp_path / "in")
    s2.unionByName(s3).repartition(3).write.parquet(arrived)
    stream = spark.readStream.schema(s2.schema).option("maxFilesPerTrigger", 1).parquet(arrived)
    link_arrivals(stream, s1, vocabulary, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = blocking.top_by_field(spark.read.parquet(str(tmp_path / "out")).drop("batch", "rank"))
    whole = blocking.top_by_field(blocking.scored(tfidf.vectors(tfidf.weights(tf, vocabulary))))
    key = ["s1_id", "cand_id", "source", "field"]
    assert sorted(map(tuple, found.select(*key).collect())) == sorted(map(tuple, whole.select(*key).collect()))


def test_settings_name_stages():
    assert Settings().key("train") != Settings().key("test") != Settings(top_k=5).key("test")
    assert Settings(retrain=True).key() == Settings().key()


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    found, expected = queries.QUERIES[name](spark, DATA).toPandas(), con.execute(oracle.SQL[name]).fetchdf()
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)

    def rows(frame):
        return sorted(tuple(str(float(v)) if isinstance(v, (int, float)) else str(v) for v in r) for r in frame[columns].itertuples(index=False))

    assert rows(found) == rows(expected)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
def test_contract(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_index_has_no_gaps(spark, tmp_path):
    files.save_table(spark.range(50).repartition(7).select("id"), str(tmp_path / "t.tsv"), index=True)
    found = spark.read.csv(str(tmp_path / "t.tsv"), sep="\t", header=True).collect()
    assert sorted(int(r["index"]) for r in found) == list(range(50))
