"""The whole linkage job: clean, retrieve, fuse, pair, learn, decide. Parquet between stages, resumable."""

from __future__ import annotations

import argparse
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import logs
from tessera.functions import text
from tessera.functions.translit import transliterate
from tessera.operators import constraints, decide, fuse, learn, pairs, profile, retrieve
from tessera.session import scratch
from tessera.sources import tables

STAGES = ("clean", "candidates", "features", "model", "threshold", "decisions", "output")


def clean(df: DataFrame, with_transliteration: bool = False) -> DataFrame:
    """The sixteen cleaned columns of a source table; row count and ids stay."""
    name, address = F.col("business_name"), F.col("business_address")
    normal = text.with_name(df, name, "business_name_normalized", transliterate if with_transliteration else None)
    normal = text.with_address(normal, address, "business_address_normalized")
    canonical = text.canonical_address(F.col("business_address_normalized"))
    return normal.select(
        "entity_id",
        "business_name",
        "business_name_normalized",
        text.canonical_name(F.col("business_name_normalized")).alias("business_name_canonical"),
        "business_address",
        "business_address_normalized",
        canonical.alias("business_address_canonical"),
        text.landmark(address).alias("address_landmark"),
        text.digit_runs(F.col("business_address_normalized")).alias("address_numbers"),
        text.postal_code(F.col("business_address_normalized")).alias("address_postal_code"),
        text.sorted_tokens(canonical).alias("address_sorted_tokens"),
        "country",
        text.country(F.col("country")).alias("country_normalized"),
        (F.col("business_name_normalized") == "").alias("business_name_is_missing"),
        (F.col("business_address_normalized") == "").alias("business_address_is_missing"),
        text.script_class(name).alias("name_script_class"),
    )


def contract(cleaned: DataFrame) -> DataFrame:
    """entity_id, clean_text, name, address, country."""
    name, address = F.col("business_name_normalized"), F.col("business_address_normalized")
    return cleaned.select("entity_id", F.trim(F.concat_ws(" ", name, address)).alias("clean_text"), name.alias("name"), address.alias("address"), F.col("country_normalized").alias("country"))


def candidates(source1: DataFrame, corpus: DataFrame, k: int = 20, with_bm25: bool = True) -> DataFrame:
    """All channels fused: exact keys, three TF-IDF views, BM25, rare tokens, sorted neighbourhood."""
    views = retrieve.multiview(source1, corpus, "entity_id", k)
    channels = {
        "exact": retrieve.exact(source1, corpus, "entity_id", ["name", "address"]),
        "tfidf": fuse.ranked(views, "score").select("source1_id", "candidate_id", "score", "rank"),
        "rare": retrieve.rare_tokens(source1, corpus, "entity_id", "clean_text").select("source1_id", "candidate_id", "score", "rank"),
        "neighbour": retrieve.sorted_neighbourhood(source1, corpus, "entity_id", "name", k=k),
    }
    if with_bm25:
        channels["bm25"] = retrieve.bm25(source1, corpus, "entity_id", "clean_text", k)
    return fuse.fuse(channels)


def paired(found: DataFrame, source1: DataFrame, corpus: DataFrame, groups=pairs.DEFAULT) -> DataFrame:
    score = F.greatest(*[F.coalesce(F.col(c), F.lit(0.0)) for c in found.columns if c in ("tfidf_score", "exact_score")], F.lit(0.0))
    table = pairs.pair_table(found.withColumn("score", F.least(F.lit(1.0), score)), source1, corpus)
    ranks = [c for c in found.columns if c.endswith("_rank")]
    return pairs.features(fuse.rrf(table, ranks), groups)


TEXTS = [f"{s}_{f}" for s in ("s1", "candidate") for f in ("name", "address", "country")]


def run(spark: SparkSession, data: str, out: str, k: int = 20, with_transliteration: bool = False, resume: bool = False, trees: int = 30) -> dict:
    """Train on the training split, decide on the test split, write both result tables. Returns the report."""
    began = time.time()
    done = tables.Stages(spark, out, STAGES)
    if not resume:
        done.clear()
    report: dict = {"k": k, "stages": {}}

    def stage(name, make) -> None:
        if not done.is_done(name):
            with logs.step(name, report["stages"]):
                make()
            done.mark_done(name)
        else:
            report["stages"][name] = "kept"

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{out}/{name}")

    def write(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{out}/{name}")

    def do_clean() -> None:
        for split in ("train", "test"):
            files = tables.split_files(data, split)
            parts = [clean(tables.read_source(spark, files[f"source{i}"], i), with_transliteration) for i in (1, 2, 3)]
            write(contract(parts[0]), f"{split}_s1")
            write(contract(parts[1]).unionByName(contract(parts[2])), f"{split}_corpus")
        truth = tables.read_truth(spark, tables.split_files(data, "train")["truth"])
        constraints.require(constraints.unknown_references(truth, "matched_id", read("train_corpus"), "entity_id"), "truth names unknown records")
        write(truth, "truth")

    def do_candidates() -> None:
        for split in ("train", "test"):
            with scratch(spark):
                write(candidates(read(f"{split}_s1"), read(f"{split}_corpus"), k), f"{split}_candidates")

    def do_features() -> None:
        for split in ("train", "test"):
            write(paired(read(f"{split}_candidates"), read(f"{split}_s1"), read(f"{split}_corpus")), f"{split}_pairs")

    def columns(df: DataFrame) -> list[str]:
        base = [*learn.PAIR, *TEXTS, *[c for c in df.columns if c.endswith("_rank") or (c.endswith("_score") and c != "rrf_score")]]
        return pairs.feature_columns(df, base)

    def do_model() -> None:
        write(pairs.label(read("train_pairs"), read("truth")), "labeled_pairs")
        labeled = read("labeled_pairs")
        folds = learn.split_entities(read("train_s1").select(F.col("entity_id").alias("source1_id")))
        write(folds, "folds")
        train_pairs, _ = learn.split_pairs(labeled, folds)
        model = learn.train_with_hard_negatives(learn.sample_negatives(train_pairs), columns(labeled), trees=trees)
        model.write().overwrite().save(f"{out}/model")
        write(learn.score(model, labeled), "train_scored")

    def do_threshold() -> None:
        held = read("folds").where("fold = 'validation'").select("source1_id")
        if not held.take(1):  # too few rows to hold any out
            held = read("folds").select("source1_id")
        scored = read("train_scored").join(held, "source1_id", "left_semi").select("source1_id", "candidate_id", "prob_match")
        truth = read("truth").join(held, "source1_id", "left_semi")
        swept = decide.sweep(scored, truth, held)
        write(swept, "sweep")

    def do_decisions() -> None:
        from pyspark.ml import PipelineModel

        model = PipelineModel.load(f"{out}/model")
        scored = learn.score(model, read("test_pairs"))
        write(scored, "test_scored")
        best = decide.best_threshold(read("sweep")).first()["threshold"]
        report["threshold"] = best
        chosen = decide.valid_ids(decide.apply_threshold(scored, best), read("test_corpus"))
        constraints.require(decide.inconsistent(chosen, read("test_candidates")), "matches that are no candidates")
        write(chosen, "matches")

    def do_output() -> None:
        ids = read("test_s1").select(F.col("entity_id").alias("source1_id"))
        for name, df, order in (("matching_results", read("matches"), None), ("candidate_pairs", read("test_candidates"), "agreement")):
            by = F.struct((-F.col(order) if order else F.lit(0)).alias("o"), F.col("candidate_id").alias("i"))
            lists = df.groupBy("source1_id").agg(F.transform(F.array_sort(F.collect_set(by)), lambda s: s["i"]).alias("matched"))
            tables.write_lists(decide.covered(lists, ids), f"{out}/{name}")

    for name, make in zip(STAGES, (do_clean, do_candidates, do_features, do_model, do_threshold, do_decisions, do_output)):
        stage(name, make)
    report["tables"] = {f"{split}_{side}": profile.summary(read(f"{split}_{side}")) for split in ("train", "test") for side in ("s1", "corpus")}
    report["truth"] = profile.truth_statistics(read("train_s1").select(F.col("entity_id").alias("source1_id")), read("truth")).first().asDict()
    report["seconds"] = round(time.time() - began, 1)
    tables.write_report(spark, f"{out}/report.json", report)
    return report


def ablation(scored: dict[str, DataFrame], truth: DataFrame, ids: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row of macro measures for each named experiment's scored pairs."""
    rows = [decide.macro(decide.outcomes(decide.apply_threshold(df, threshold), truth, ids)).select(F.lit(n).alias("experiment"), "*") for n, df in scored.items()]
    return reduce(DataFrame.unionByName, rows)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Link the records of source 1 with those of sources 2 and 3.")
    p.add_argument("--data", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--k", type=int, default=20)
    p.add_argument("--transliterate", action="store_true")
    p.add_argument("--resume", action="store_true")
    p.add_argument("--logs", help="folder of log files")
    a = p.parse_args(argv)
    logs.set_up(a.logs)
    run(SparkSession.builder.getOrCreate(), a.data, a.out, a.k, a.transliterate, a.resume)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
