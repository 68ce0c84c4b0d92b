import json
import os
import random

import pytest

from tessera.operators import constraints, learn
from tessera.plans import linkage
from tessera.sources import tables

WORDS = "acme blue river steel foods bakery north gold sun hotel media tech labs green stone bridge".split()


def write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join("\t".join(r) for r in [header, *rows]) + "\n")


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    root, rng = str(tmp_path_factory.mktemp("data")), random.Random(1)
    for split, n in (("train", 40), ("test", 12)):
        s1, s2, s3, truth = [], [], [], []
        for i in range(n):
            name, address = " ".join(rng.sample(WORDS, 3)), f"{rng.randint(1, 99)} {rng.choice(WORDS)} St, {rng.randint(10000, 99999)}"
            s1.append((f"S1-{i}", name.title() + " Ltd.", address, "France"))
            hits = []
            if i % 4:
                s2.append((f"S2-{i}", name + " limited", address.replace("St", "Street"), "france"))
                hits.append(f"S2-{i}")
            if i % 3 == 0:
                s3.append((f"S3-{i}", name.replace("o", "0"), address if i % 6 else "", "FRANCE"))
                hits.append(f"S3-{i}")
            truth.append((f"S1-{i}", ",".join(hits)))
        s3.append(("S3-900", "NA", "null, नई दिल्ली", ""))
        for k, rows in enumerate((s1, s2, s3), 1):
            write(f"{root}/{split}/{split}_source{k}.tsv", tables.SOURCE, rows)
        if split == "train":
            write(f"{root}/train/train_ground_truth.tsv", tables.TRUTH, truth)
    return root


def test_whole_run_and_resume(spark, data, tmp_path):
    out = str(tmp_path / "out")
    report = linkage.run(spark, data, out, k=5, with_transliteration=True, trees=5)
    assert set(report["stages"]) == set(linkage.STAGES)
    got = tables.read_tsv(spark, f"{out}/matching_results", tables.TRUTH)
    assert got.count() == 12
    pairs = {(r[0], m) for r in got.collect() for m in r[1].split(",") if m}
    right = {p for p in pairs if p[0].split("-")[1] == p[1].split("-")[1]}
    assert len(right) >= 8 and len(right) / len(pairs) >= 0.8
    again = linkage.run(spark, data, out, k=5, resume=True)
    assert set(again["stages"].values()) == {"kept"}
    assert json.loads(open(f"{out}/report.json").read())["k"] == 5


def test_tools(spark, data, tmp_path):
    from tessera.plans import tools

    out = str(tmp_path / "sample")
    tools.sample(spark, data, out, 5)
    truth = tables.read_truth(spark, f"{out}/ground_truth")
    corpus = tables.read_tsv(spark, f"{out}/source2").unionByName(tables.read_tsv(spark, f"{out}/source3"))
    assert tables.read_tsv(spark, f"{out}/source1").count() == 5
    assert constraints.unknown_references(truth, "matched_id", corpus, "entity_id").count() == 0
    p = str(tmp_path / "r.tsv")
    write(p, tables.TRUTH, [("S1-0", "S2-1,S2-1,X-1"), ("S1-99", ""), ("S1-1", ""), ("S1-1", "")])
    issues = dict(tools.validate(spark, data, p))
    assert issues == {"missing_source": 10, "extra_source": 1, "repeated_source": 1, "repeated_in_list": 1, "bad_prefix": 1, "unknown_id": 1}


def test_clean_keeps_rows(spark, data):
    raw = tables.read_source(spark, f"{data}/train/train_source3.tsv", 3)
    cleaned = linkage.clean(raw)
    assert len(cleaned.columns) == 16 and constraints.set_difference(cleaned.select("entity_id"), raw.select("entity_id")).count() == 0
    last = cleaned.where("entity_id = 'S3-900'").first()
    assert last["business_name_is_missing"] and last["business_address_normalized"] == "नई दिल्ली" and last["name_script_class"] == "latin"


def test_fatal_sources(spark, tmp_path):
    p = str(tmp_path / "s.tsv")
    for rows in ([("S1-x", "a", "b", "c")], [("S1-1", "a", "b", "c")] * 2):
        write(p, tables.SOURCE, rows)
        with pytest.raises(constraints.FatalCheck):
            tables.read_source(spark, p, 1)
    write(p, tables.SOURCE[::-1], [("c", "b", "a", "S1-1")])
    with pytest.raises(constraints.FatalCheck):
        tables.read_source(spark, p, 1)


def test_truth_must_agree(spark, tmp_path):
    p = str(tmp_path / "t.tsv")
    write(p, tables.TRUTH, [("S1-1", "S2-1,S3-2"), ("S1-1", "S3-2, S2-1"), ("S1-2", "")])
    assert {tuple(r) for r in tables.read_truth(spark, p).collect()} == {("S1-1", "S2-1"), ("S1-1", "S3-2")}
    write(p, ["source1_entity_id", "matching_entity_ids"], [("S1-1", "S2-1"), ("S1-1", "S2-2")])
    with pytest.raises(constraints.FatalCheck):
        tables.read_truth(spark, p)


def test_unquoted_files_keep_quotes(spark, tmp_path):
    p = str(tmp_path / "c.tsv")
    write(p, tables.CLEAN, [("S2-1", 'the "best" NA'), ("S2-2", "")])
    assert [r["clean_text"] for r in tables.read_contract(spark, p).orderBy("entity_id").collect()] == ['the "best" NA', ""]


def test_index_is_rebuilt_on_change(spark, tmp_path):
    v = spark.createDataFrame([(1, [1.0]), (2, [0.5])], "id long, v array<double>")
    p = str(tmp_path / "index")
    assert tables.vector_index(v, p, {"dim": 1}) and not tables.vector_index(v, p, {"dim": 1})
    assert tables.vector_index(v, p, {"dim": 2}) and tables.vector_index(v.limit(1), p, {"dim": 2})


def test_samples(spark):
    rows = [(f"S1-{i % 9}", f"S2-{i}", int(i % 11 == 0), 0.1 * (i % 10), i % 5) for i in range(120)]
    df = spark.createDataFrame(rows, "source1_id string, candidate_id string, label int, score double, rank int")
    got = learn.sample_negatives(df, 3)
    assert got.where("label = 1").count() == 11 and got.where("label = 0").count() == 33
    assert constraints.set_difference(got, learn.sample_negatives(df.repartition(7), 3)).count() == 0
    with pytest.raises(constraints.FatalCheck):
        learn.train(df, ["score", "label"])
    with pytest.raises(constraints.FatalCheck):
        learn.train(df.where("label = 0"), ["score"])


def test_hard_negatives_are_weighted_once(spark):
    rows = [("a", f"S2-{i}", int(i % 3 == 0), float(i % 3 == 0) + 0.01 * i) for i in range(60)]
    df = spark.createDataFrame(rows, "source1_id string, candidate_id string, label int, score double")
    model = learn.train_with_hard_negatives(df, ["score"], trees=3, depth=2)
    assert learn.score(model, df).count() == 60 and learn.importance(model, ["score"])[0][0] == "score"


def test_stream_equals_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.operators import retrieve
    from tessera.streaming.incremental import match_stream

    corpus = spark.createDataFrame([("c1", "acme foods"), ("c2", "blue steel")], "id string, text string")
    rows = spark.createDataFrame([("q1", "acme"), ("q2", "steel acme")], "id string, text string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    match_stream(stream, corpus, "id", "text", 2, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    want = retrieve.tfidf(rows, corpus, "id", retrieve.words(F.col("text")), 2)
    assert constraints.set_difference(spark.read.parquet(str(tmp_path / "out")).select(*want.columns), want).count() == 0
