"""Readers and writers of the record files: tab-separated text with all-string columns, and Parquet between stages.

Empty fields are empty strings, never null; literal markers such as ``NA`` stay.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.constraints import FatalCheck, malformed_ids, repeated, require, require_columns, require_schema
from tessera.operators.reshape import conflicts, truth
from tessera.session import cut

SOURCE = ["entity_id", "business_name", "business_address", "country"]
TRUTH = ["source1_entity_id", "matched_entity_ids"]
CLEAN = ["entity_id", "clean_text"]
FEATURE = ["entity_id", "clean_name", "clean_address", "clean_country"]
ID_PATTERN = {1: r"^S1-\d+$", 2: r"^S2-\d+$", 3: r"^S3-\d+$"}


def strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None, quoted: bool = True) -> DataFrame:
    """``columns``: the exact header wanted. ``quoted`` False: quotes are data and backslash escapes."""
    reader = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", False).option("encoding", "UTF-8")
    reader = reader.option("quote", '"').option("escape", '"').option("multiLine", True) if quoted else reader.option("quote", "").option("escape", "\\")
    df = reader.csv(path)
    if columns is not None:
        require_schema(df, columns)
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def write_tsv(df: DataFrame, path: str, quoted: bool = True, single: bool = False) -> None:
    """Spark commits the folder as a whole, so a failed write leaves no half table."""
    out = df.coalesce(1) if single else df
    w = out.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "")
    (w.option("quote", '"').option("escape", '"') if quoted else w.option("quote", "").option("escape", "\\")).csv(path)


def read_source(spark: SparkSession, path: str, number: int) -> DataFrame:
    """A raw source table; malformed or repeated ids are fatal."""
    df = read_tsv(spark, path, SOURCE)
    require(malformed_ids(df, "entity_id", ID_PATTERN[number]), f"ids of source {number}")
    require(repeated(df, "entity_id"), f"repeated ids of source {number}")
    return df


def read_contract(spark: SparkSession, path: str, columns: list[str] = CLEAN) -> DataFrame:
    df = read_tsv(spark, path, quoted=False)
    require_columns(df, columns)
    require(df.where(F.trim("entity_id") == "").select("entity_id"), "blank ids")
    require(repeated(df, "entity_id"), "repeated ids")
    return df


#: Names under which truth files list the matches.
TRUTH_COLUMNS = ("matched_entity_ids", "matching_entity_ids", "match_entity_ids")


def read_truth(spark: SparkSession, path: str, quoted: bool = True) -> DataFrame:
    """Truth pairs (source1_id, matched_id); repeated source rows must agree."""
    df = read_tsv(spark, path, quoted=quoted)
    column = next((c for c in TRUTH_COLUMNS if c in df.columns), None)
    if column is None:
        raise FatalCheck(f"none of {TRUTH_COLUMNS} in {df.columns}")
    require(conflicts(df, "source1_entity_id", column), "source rows with conflicting truth")
    return truth(df.withColumnRenamed("source1_entity_id", "source1_id"), "source1_id", column)


SCORE_NAMES = ("cosine_similarity", "blocking_cosine_sim", "score")


def read_scores(df: DataFrame) -> DataFrame:
    """(source1_id, candidate_id, score); values must be numbers in [0, 1]."""
    name = next((c for c in SCORE_NAMES if c in df.columns), None)
    if name is None:
        raise FatalCheck(f"none of {SCORE_NAMES} in {df.columns}")
    out = df.withColumn("score", F.expr(f"try_cast({name} as double)"))
    require(out.where("score is null or isnan(score) or score < 0 or score > 1").select("source1_id", "candidate_id", name), "scores")
    return out.select("source1_id", "candidate_id", "score")


def write_lists(lists: DataFrame, path: str, dedupe: bool = False, column: str = "matched") -> None:
    """One row per source row, ids comma-joined, rows in order of the id as text."""
    ids = F.array_distinct(column) if dedupe else F.col(column)
    write_tsv(lists.select(F.col("source1_id").alias("source1_entity_id"), F.array_join(ids, ",").alias("matched_entity_ids")).orderBy("source1_entity_id"), path, single=True)


def write_matrix(df: DataFrame, path: str, features: list[str], ids: list[str] | None = None) -> None:
    df.select(*(ids or []), *features).write.mode("overwrite").parquet(path)


def split_files(folder: str, split: str) -> dict[str, str]:
    """Paths of one split's files; truth for the training split only."""
    out = {f"source{i}": f"{folder}/{split}/{split}_source{i}.tsv" for i in (1, 2, 3)}
    return out | ({"truth": f"{folder}/train/train_ground_truth.tsv"} if split == "train" else {})


def sample_with_references(source1: DataFrame, truth_pairs: DataFrame, corpus: DataFrame, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The first ``n`` source rows by id, their truth, and a corpus sample with every row that the truth names."""
    head = source1.orderBy("entity_id").limit(n)
    t = truth_pairs.join(head.select(F.col("entity_id").alias("source1_id")), "source1_id", "left_semi")
    first = cut(corpus.orderBy("entity_id").limit(n), "sample")
    named = corpus.join(t.select(F.col("matched_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
    more = named.join(first.select("entity_id"), "entity_id", "left_anti")
    return head, t, first.unionByName(more)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


class Stages:
    """Markers of finished stages beside their outputs, in any file system that Spark reads."""

    def __init__(self, spark: SparkSession, folder: str, names: tuple[str, ...]):
        self.spark, self.folder, self.names = spark, folder.rstrip("/"), names

    def _path(self, name: str) -> str:
        if name not in self.names:
            raise KeyError(name)
        return f"{self.folder}/_done_{name}"

    def is_done(self, name: str) -> bool:
        fs, p = _hadoop(self.spark, self._path(name))
        return fs.exists(p)

    def mark_done(self, name: str) -> None:
        fs, p = _hadoop(self.spark, self._path(name))
        fs.create(p, True).close()

    def clear(self, *names: str) -> None:
        for name in names or self.names:
            fs, p = _hadoop(self.spark, self._path(name))
            fs.delete(p, False)

    def completed(self) -> list[str]:
        return [n for n in self.names if self.is_done(n)]


def write_report(spark: SparkSession, path: str, report: dict) -> None:
    """A small report as one JSON file."""
    fs, p = _hadoop(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(report, indent=2, sort_keys=True, ensure_ascii=False).encode()))
    finally:
        out.close()


def read_mapping(spark: SparkSession, path: str) -> dict[str, str]:
    """A correction dictionary: a flat JSON map, or one under ``mapping``."""
    found = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return found.get("mapping", found)


def write_mapping(spark: SparkSession, path: str, mapping: dict[str, str]) -> None:
    """A correction dictionary as a flat JSON map, as ``read_mapping`` reads it."""
    write_report(spark, path, mapping)


def write_candidates(found: DataFrame, path: str) -> None:
    """Ids and cosine of candidate pairs, tab-separated; the score may stand under any of its names."""
    score = next((c for c in ("cosine_similarity", "blocking_cosine_sim", "score") if c in found.columns), None)
    if score is None:
        raise ValueError(f"no score among {found.columns}")
    write_tsv(found.select(F.col("source1_id").alias("source1_entity_id"), F.col("candidate_id").alias("candidate_entity_id"), F.col(score).alias("cosine_similarity")), path)


def write_labeled(pairs: DataFrame, path: str) -> None:
    """Labelled pairs with all their columns, tab-separated."""
    write_tsv(pairs, path)


def vector_index(df: DataFrame, path: str, metadata: dict) -> bool:
    """Write vectors as Parquet with metadata beside them, unless an index with equal metadata is there.

    Equality holds the sorted ids' hash, so changed rows make a new index. True if it was built.
    """
    spark = df.sparkSession
    # Order-insensitive and whole: a sum and a xor of the ids' hashes, with their number.
    h = F.xxhash64("id")
    n, s, x = df.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first()
    wanted = metadata | {"rows": n, "ids": f"{s}:{x}"}
    fs, p = _hadoop(spark, f"{path}.json")
    if fs.exists(p) and json.loads(spark.read.text(f"{path}.json", wholetext=True).first()[0]) == wanted:
        return False
    df.write.mode("overwrite").parquet(path)
    write_report(spark, f"{path}.json", wanted)
    return True
