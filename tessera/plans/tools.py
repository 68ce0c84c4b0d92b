"""Command line for samples of a dataset and for checks of a result file."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.operators import decide
from tessera.sources import tables


def sample(spark: SparkSession, data: str, out: str, n: int) -> None:
    """The first ``n`` source rows of the training split with their truth and every record it names."""
    files = tables.split_files(data, "train")
    read = lambda i: tables.read_source(spark, files[f"source{i}"], i)
    truth = tables.read_truth(spark, files["truth"])
    head, found, corpus = tables.sample_with_references(read(1), truth, read(2).unionByName(read(3)), n)
    tables.write_tsv(head, f"{out}/source1")
    for i in (2, 3):
        tables.write_tsv(corpus.where(F.col("entity_id").startswith(f"S{i}-")), f"{out}/source{i}")
    lists = found.groupBy("source1_id").agg(F.array_sort(F.collect_set("matched_id")).alias("matched"))
    ids = head.select(F.col("entity_id").alias("source1_id"))
    tables.write_lists(decide.covered(lists, ids), f"{out}/ground_truth")


def validate(spark: SparkSession, data: str, result: str, split: str = "test") -> list[tuple[str, int]]:
    """Issues of a result file with their counts; none if it is sound."""
    files = tables.split_files(data, split)
    submitted = tables.read_tsv(spark, result, tables.TRUTH).toDF("source1_id", "matched_ids")
    ids = tables.read_tsv(spark, files["source1"], tables.SOURCE).select(F.col("entity_id").alias("source1_id"))
    known = tables.read_tsv(spark, files["source2"], tables.SOURCE).unionByName(tables.read_tsv(spark, files["source3"], tables.SOURCE))
    return [(r["issue"], r["n"]) for r in decide.submission_issues(submitted, ids, known).where("n > 0").collect()]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    sub = p.add_subparsers(dest="what", required=True)
    s = sub.add_parser("sample")
    s.add_argument("--data", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--rows", type=int, default=1000)
    v = sub.add_parser("validate")
    v.add_argument("--data", required=True)
    v.add_argument("--result", required=True)
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if a.what == "sample":
        sample(spark, a.data, a.out, a.rows)
        return 0
    issues = validate(spark, a.data, a.result)
    for issue, n in issues:
        print(issue, n)
    return int(bool(issues))


if __name__ == "__main__":
    raise SystemExit(main())
