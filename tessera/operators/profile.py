"""Profiles: collisions, duplicates, distributions and corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def collisions(df: DataFrame, keys: list[str], ident: str, top: int | None = 200, sample: int = 10) -> DataFrame:
    """Groups of more than one row with equal non-empty keys, largest first, with a few least ids.

    The sample is kept small inside the aggregate by a grouped top-n, so a hot
    key gathers ``sample`` ids and not all of its own.
    """
    full = df.where(" and ".join(f"coalesce({k}, '') <> ''" for k in keys))
    sized = full.groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1")
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(ident))
    ids = full.select(*keys, ident).withColumn("_n", first).where(F.col("_n") <= sample)
    ids = ids.groupBy(*keys).agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("_n", F.col(ident).cast("string").alias("i")))), lambda s: s["i"])).alias("ids"))
    out = sized.join(ids, keys).select(*keys, "size", "ids")
    return out.orderBy(F.desc("size"), *keys).limit(top) if top else out


def collision_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    sized = df.where(" and ".join(f"coalesce({k}, '') <> ''" for k in keys)).groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1")
    return sized.agg(F.count("*").alias("groups"), F.coalesce(F.sum("size"), F.lit(0)).alias("rows"), F.coalesce(F.max("size"), F.lit(0)).alias("largest"))


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows involved in exact duplication, and how many distinct rows they are."""
    d = df.groupBy(*df.columns).agg(F.count("*").alias("_n")).where("_n > 1")
    return d.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("duplicate_rows"), F.count("*").alias("duplicate_groups"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def missing(df: DataFrame) -> DataFrame:
    """One row: for each column, how many values are null or empty."""
    return df.agg(*[F.coalesce(F.sum((F.coalesce(F.col(c).cast("string"), F.lit("")) == "").cast("long")), F.lit(0)).alias(c) for c in df.columns])


def token_statistics(df: DataFrame, ident: str, text: str) -> DataFrame:
    """token, df and idf = ln((N + 1) / (df + 1)) over whitespace tokens."""
    tokens = df.select(F.explode(F.array_distinct(F.filter(F.split(text, " "), lambda t: t != ""))).alias("token"))
    n = df.agg(F.count("*").alias("n_docs"))
    counted = tokens.groupBy("token").agg(F.count("*").alias("df"))
    return counted.join(F.broadcast(n), how="cross").select("token", "df", F.log((F.col("n_docs") + 1) / (F.col("df") + 1)).alias("idf"))


def truth_statistics(source1: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: source rows, those without a match, mean and most matches, references to S2 and S3.

    ``source1`` has source1_id, ``truth`` source1_id and matched_id; a row without a match may lack there.
    """
    n = source1.select("source1_id").join(truth, "source1_id", "left")
    of = lambda prefix: F.count(F.when(F.col("matched_id").cast("string").startswith(prefix), 1))
    each = n.groupBy("source1_id").agg(F.count("matched_id").alias("n"), of("S2-").alias("s2"), of("S3-").alias("s3"))
    return each.agg(
        F.count("*").alias("source_rows"),
        F.count(F.when(F.col("n") == 0, 1)).alias("zero_match"),
        F.round(F.avg("n"), 6).alias("mean_matches"),
        F.max("n").alias("max_matches"),
        F.coalesce(F.sum("s2"), F.lit(0)).alias("s2_references"),
        F.coalesce(F.sum("s3"), F.lit(0)).alias("s3_references"),
    )


def summary(df: DataFrame) -> dict:
    """Rows, and empty values by column, of one table: the figures of the cleaning report."""
    empty = [F.count(F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", 1)).alias(c) for c in df.columns]
    row = df.agg(F.count("*").alias("__rows"), *empty).first().asDict()
    return {"rows": row.pop("__rows"), "empty": row}
