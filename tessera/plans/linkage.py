"""Candidate, training, prediction and evaluation runs over a folder of sources.

Stages are saved under names made of the split and the settings, so one split's candidates are never taken
for another's.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import Settings
from tessera.functions.text import with_normalized
from tessera.operators import blocking, evaluation, features, labels, model, output, tfidf, threshold
from tessera.sources import delimited as files

log = logging.getLogger(__name__)
LOGGED_TREES = 50
MODES = ("train", "predict", "full", "eval")


class Linkage:
    """One run's sources, settings and places."""

    def __init__(self, spark: SparkSession, data: str, work: str, settings: Settings = Settings()):
        self.spark, self.data, self.work, self.settings = spark, data, work.rstrip("/"), settings

    def records(self, split: str) -> DataFrame:
        """All sources of a split, normalised; ``place`` keeps the order of S1's rows for the results."""
        s1, s2, s3 = (with_normalized(files.load_source(self.spark, self.data, n, split, place=n == 1)) for n in (1, 2, 3))
        return s1.unionByName(s2.unionByName(s3), allowMissingColumns=True)

    def entities(self, records: DataFrame) -> DataFrame:
        return records.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "place")

    def vocabulary(self, records: DataFrame, split: str) -> DataFrame:
        """Fitted on the training split, when asked to, or where none is saved; else the saved one."""
        path = f"{self.work}/vocabulary-{self.settings.key()}"
        if split != "train" and not self.settings.refit:
            try:
                return files.load_vocabulary(self.spark, path)
            except FileNotFoundError:
                log.info("no vocabulary saved; fitting on %s", split)
        files.save_vocabulary(tfidf.fit(records, sizes=self.settings.gram_sizes, cap=self.settings.vocabulary_cap), path)
        return files.load_vocabulary(self.spark, path)

    def candidates(self, records: DataFrame, split: str) -> DataFrame:
        """Saved candidates of this split that cover every S1 id, or new ones."""

        def make() -> DataFrame:
            vocabulary = self.vocabulary(records, split)
            vectors = tfidf.vectors(tfidf.weights(tfidf.grams(records, self.settings.gram_sizes), vocabulary))
            found = blocking.retrieve(vectors, self.settings)
            # Entities without a candidate keep a row, which coverage looks for.
            return self.entities(records).drop("place").join(found, "s1_id", "left")

        path = f"{self.work}/candidates-{self.settings.key(split)}"
        held = files.stage(self.spark, path, make, self.settings.regenerate, self.entities(records))
        return held.where("cand_id is not null")

    def _features(self, pairs: DataFrame, records: DataFrame) -> DataFrame:
        return features.feature_table(pairs, records.where("source = 'S1'"), records.where("source <> 'S1'"), self.settings.use_country, unique=False)

    @property
    def model_path(self) -> str:
        return f"{self.work}/model-{self.settings.key()}"

    @property
    def threshold_path(self) -> str:
        return f"{self.work}/threshold-{self.settings.key()}"

    def train(self) -> DataFrame:
        """Train and tune; returns the candidates' statistics."""
        records = self.records("train")
        pairs = self.candidates(records, "train")
        truth = files.to_pairs(files.load_truth(self.spark, self.data), "matched_entity_ids")
        entities = self.entities(records)
        fold = labels.split(entities, self.settings)
        if self.settings.retrain or not self._has_model():
            sample = labels.sampled(labels.labelled(pairs.select("s1_id", "cand_id"), truth), self.settings).join(fold, "s1_id")
            rows = self._features(sample, records).join(sample, ["s1_id", "cand_id"])
            rows = rows.persist()
            fitted = model.train(rows, self.settings)
            model.save(fitted, self.model_path)
            for trees, loss in enumerate(model.losses(fitted, rows.where("is_val")), 1):
                if trees % LOGGED_TREES == 0:
                    log.info("%d trees: validation loss %.5f", trees, loss)
            rows.unpersist()
            for name, value in model.importances(fitted):
                log.info("importance %s %.4f", name, value)
        chosen = self.tune(records, pairs, truth, fold)
        log.info("threshold %.4f", chosen)
        return blocking.blocking_stats(pairs, truth, entities, records)

    def _has_model(self) -> bool:
        try:
            model.load(self.model_path)
            return True
        except FileNotFoundError:
            return False

    def tune(self, records: DataFrame, pairs: DataFrame, truth: DataFrame, fold: DataFrame, metric: str = "f05") -> float:
        """Best threshold on the validation entities; it is saved."""
        mine = fold.where("is_val").select("s1_id")
        scores = self.score(pairs.join(mine, "s1_id", "left_semi"), records)
        chosen = threshold.best(threshold.curve(scores, truth.join(mine, "s1_id", "left_semi"), mine, self.settings), metric).first()["threshold"]
        files.save_threshold(self.spark, chosen, self.threshold_path)
        return chosen

    def score(self, pairs: DataFrame, records: DataFrame) -> DataFrame:
        return model.score(model.load(self.model_path), self._features(pairs, records))

    def scored(self, split: str = "test") -> DataFrame:
        """Every candidate pair of a split with its probability: ``s1_id, cand_id, proba``."""
        records = self.records(split)
        return self.score(self.candidates(records, split), records)

    def predict(self, split: str = "test") -> tuple[DataFrame, DataFrame]:
        """Write both result files, in S1's order; returns matching results and violations (there should be none)."""
        records = self.records(split)
        pairs, s1 = self.candidates(records, split), self.entities(records)
        scores = self.score(pairs, records).persist()  # scored once for the file, its summary and the check
        said = threshold.decided(scores, files.load_threshold(self.spark, self.threshold_path, self.settings.default_threshold))
        valid = records.where("source <> 'S1'")
        results = output.matching_results(said, s1, valid)
        files.save_table(results, f"{self.work}/matching_results.tsv")
        files.save_table(output.candidate_pairs(pairs, s1, valid), f"{self.work}/candidate_pairs.tsv")
        return results, output.violations(said, pairs)

    def evaluate(self, split: str = "train") -> DataFrame:
        """Report on the validation entities."""
        records = self.records(split)
        pairs = self.candidates(records, split)
        truth = files.to_pairs(files.load_truth(self.spark, self.data), "matched_entity_ids")
        mine = labels.split(self.entities(records), self.settings).where("is_val").select("s1_id")
        scores = self.score(pairs.join(mine, "s1_id", "left_semi"), records)
        said = threshold.decided(scores, files.load_threshold(self.spark, self.threshold_path, self.settings.default_threshold))
        counts = evaluation.entity_counts(mine, truth.join(mine, "s1_id", "left_semi"), said)
        return evaluation.report(counts)

    def tune_saved(self) -> float:
        """Tune the threshold of the saved model once more, on the validation entities of the training split."""
        records = self.records("train")
        truth = files.to_pairs(files.load_truth(self.spark, self.data), "matched_entity_ids")
        return self.tune(records, self.candidates(records, "train"), truth, labels.split(self.entities(records), self.settings))

    def run(self, mode: str, split: str = "test") -> None:
        mode = mode.lower()
        if mode not in MODES:
            raise ValueError(f"mode must be one of {', '.join(MODES)}")
        if mode in ("train", "full"):
            self.train().show(truncate=False)
        if mode in ("predict", "full"):
            output.match_rate(self.predict(split)[0]).show()
        if mode == "eval":
            self.evaluate().show(truncate=False)


def main(arguments: list[str] | None = None) -> int:
    """Command line; a failure gives exit code 1."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--mode", type=str.lower, choices=MODES, default="full")
    parser.add_argument("--split", choices=("train", "test"), default="test")
    parser.add_argument("--data", default="data")
    parser.add_argument("--work", default="output")
    parser.add_argument("--force-retrain", action="store_true")
    parser.add_argument("--refit", action="store_true")
    parser.add_argument("--regenerate", action="store_true")
    parser.add_argument("--tune-threshold", action="store_true", help="only tune the threshold of the saved model")
    parser.add_argument("--log-level", default="INFO")
    given = parser.parse_args(arguments)
    logging.basicConfig(level=given.log_level.upper())
    spark = SparkSession.builder.appName("tessera").getOrCreate()
    try:
        settings = Settings(retrain=given.force_retrain, refit=given.refit, regenerate=given.regenerate)
        linkage = Linkage(spark, given.data, given.work, settings)
        if given.tune_threshold:
            log.info("threshold %.4f", linkage.tune_saved())
        else:
            linkage.run(given.mode, given.split)
    except Exception:
        log.exception("the run failed")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
