import json

from pyspark.sql import functions as F

from corpusloom import queries
from corpusloom.operators import model
from corpusloom.plans import pipeline
from corpusloom.sources import readers, writers
from corpusloom.streaming import steps

SCHEMA = "row_id long, text string, lang string, region_code string"


def corpus(spark, n=60):
    rows = []
    for i in range(n):
        lang, words = (("deu", "der alte Bauer trug heute zwei Körbe Äpfel zum Markt Nummer"), ("rus", "старый крестьянин нёс сегодня две корзины яблок на рынок"))[i % 2]
        rows.append((i, f"{words} w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]} " + "xy" * (i % 7), lang, "DE"))
    return spark.createDataFrame(rows, SCHEMA)


def test_round_trip_by_script(spark, tmp_path):
    df = pipeline.run("full", corpus(spark), until="route")
    writers.write_partitioned(df, f"{tmp_path}/out", ["script"], compression="none", files_per_partition=2)
    back = readers.read_shards(spark, f"{tmp_path}/out")
    assert back.count() == 60 and {r["script"] for r in back.select("script").distinct().collect()} == {"Latn", "Cyrl"}


def test_label_lines_round_trip(spark, tmp_path):
    df = corpus(spark).withColumn("split", F.lit("valid"))
    writers.write_label_lines(df, f"{tmp_path}/valid", by=[])
    got = readers.read_lines(spark, str(tmp_path))
    assert got.count() == 60 and [r["subset"] for r in got.select("subset").distinct().collect()] == ["valid"]


def test_predictions_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("__label__a", None, 0.5, 'say "x"\there'), (None, "__label__b", None, None)], "gold string, pred string, prob double, text string")
    writers.write_predictions(df, f"{tmp_path}/p")
    got = sorted(tuple(r) for r in readers.read_predictions(spark, f"{tmp_path}/p").select("prob", "text").collect())
    assert got[1] == (0.5, 'say "x" here') and got[0][0] == 0.0
    writers.write_arguments(spark, {"dim": 100}, f"{tmp_path}/a")
    assert spark.read.text(f"{tmp_path}/a").first()[0] == '{"dim": 100}'


def test_canonical_columns(spark):
    df = spark.createDataFrame([(1, "t", "s")], "doc_id long, text string, source string")
    assert readers.canonical(df, "doc_id", lang=None, region="source").columns == ["row_id", "text", "lang", "region_code"]


def test_pipelines(spark):
    wired = pipeline.run("wired", corpus(spark))
    assert wired.count() == 60 and wired.columns == ["split", "script", "value"]
    full = pipeline.run("full", corpus(spark), pipeline.Options(distance=0, bands=8))
    rows = full.collect()
    assert rows and all(r["value"].startswith("__label__") for r in rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, pipeline.run("full", corpus(spark).repartition(3), pipeline.Options(distance=0, bands=8)).collect()))


def test_full_pipeline_leaves_out_foreign_scripts(spark):
    mixed = "der alte Bauer старый trug zwei Körbe"
    labels = ["deu", "de-DE", " DEU ", "rus", "qaa", "und", "-", "english", None]
    df = spark.createDataFrame([(i, mixed, label, "DE") for i, label in enumerate(labels)], SCHEMA)
    got = {r["row_id"]: r["text"] for r in pipeline.run("full", df, until="pure").collect()}
    whole, latin = "der alte bauer старый trug zwei körbe", "der alte bauer trug zwei körbe"
    assert [got[i] for i in range(9)] == [latin, latin, latin, "старый", whole, whole, whole, whole, whole]
    kept = pipeline.run("full", df, pipeline.Options(purity=None), until="pure").collect()
    assert {r["text"] for r in kept} == {whole}


def test_pipeline_of_nothing(spark):
    assert pipeline.run("full", spark.createDataFrame([], SCHEMA)).count() == 0


def test_model_tells_languages_apart(spark):
    lines = corpus(spark).select(F.col("lang").alias("gold"), "text")
    fitted = model.train(lines, buckets=1 << 12)
    assert model.evaluate(fitted, lines).first()["accuracy"] == 1.0


def test_quantised_vectors(spark):
    df = spark.createDataFrame([(i, [float(i % 2), 1.0, float(i % 3), 0.0]) for i in range(12)] + [(99, None), (98, [1.0])], "id long, v array<float>")
    coded, centres = model.quantise(df, "v", 4, dsub=2, codes=3)
    rows = {r["id"]: r["codes"] for r in coded.collect()}
    assert rows[99] is None and rows[98] is None and len(rows[0]) == 2 and len(centres) == 2
    assert model.quantisation_gates(255, 300) == (False, True)


def test_registered_quantiser_has_the_full_code(spark, tmp_path):
    rows = [(i, [float((i * k * 37) % 101) for k in range(1, 9)]) for i in range(300)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    codes = [r["codes"] for r in queries.quantise_vectors(spark, str(tmp_path)).collect()]
    assert {len(c) for c in codes} == {2} and all(len({c[k] for c in codes}) > 16 for k in range(2))


def test_stateless_and_stateful_streams(spark, tmp_path):
    corpus(spark).withColumn("ingested_at", F.timestamp_seconds(F.col("row_id") * 3600 + 1_700_000_000)).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema

    def run(transform, name):
        q = transform(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")).writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/{name}").start()
        q.awaitTermination()
        return spark.table(name)

    assert run(steps.prepare, "prepared").count() > 0
    assert run(steps.drop_repeats, "unique_rows").count() == 60
    assert run(lambda s: steps.counts_by_window(s, delay="1 hour"), "windows").agg(F.sum("n")).first()[0] > 0


def test_training_from_lines_to_saved_models(spark, tmp_path):
    words = {"aaa": "bada gudo", "bbb": "xilo xerp"}
    rows = [(f"__label__{k}", f"{v} w{i}", "Latn", ("train", "train", "valid", "test")[i % 4]) for k, v in words.items() for i in range(24)]
    rows += [("__label__c", "one", "Cyrl", "train"), ("__label__d", "two", "Cyrl", "test"), ("__label__c", "x", "Grek", "train"), ("__label__c", "y", "Grek", "valid"), ("__label__c", "z", "Grek", "test")]
    lines = spark.createDataFrame(rows, "gold string, text string, script string, split string")
    path = str(tmp_path / "models")
    report = {r["script"]: r for r in model.train_and_save(lines, path, buckets=1 << 10, samples=2).collect()}
    assert {k: r["status"] for k, r in report.items()} == {"Latn": "trained", "Cyrl": "a split is missing", "Grek": "fewer than two labels"}
    assert report["Latn"]["accuracy"] == 1.0 and not report["Latn"]["quantised"] and len(report["Latn"]["samples"]) == 2
    assert model.train_and_save(lines, path).where("script = 'Latn'").first()["status"] == "present"
    again = model.load(spark, path, "Latn")
    assert {r["pred"] for r in model.predict(again, lines.where("script = 'Latn' and gold = '__label__aaa'")).collect()} == {"__label__aaa"}
    assert readers.read_predictions(spark, f"{path}/Latn/predictions").where("gold = pred").count() == 12
    assert json.loads(spark.read.text(f"{path}/Latn/arguments").first()[0])["loss"] == "ova"


def test_steps_count_their_rows(spark, tmp_path):
    text = "one two three four five six seven eight nine ten eleven"
    df = spark.createDataFrame([(1, text, "eng", "US"), (2, "", "eng", "US"), (3, "short", "eng", "US"), (4, text, "eng", "US")], "row_id long, text string, lang string, region_code string")
    counters = {}
    pipeline.run("full", df, until="short", counters=counters).collect()
    assert {k: v.get["rows"] for k, v in counters.items()} == {"route": 4, "clean": 4, "pure": 4, "filter_empty": 3, "exact": 2, "near": 2, "short": 1}
    pipeline.write_routed(df, str(tmp_path / "routed"))
    assert {r["script"] for r in readers.read_shards(spark, str(tmp_path / "routed")).select("script").collect()} == {"Latn", "Unknown"}
