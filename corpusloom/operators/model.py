"""A language classifier per script, its evaluation, and product quantisation of vectors."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, OneVsRest
from pyspark.ml.feature import HashingTF, IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_cutoff, shingles, words
from ..runtime import small
from ..sources.writers import write_arguments, write_predictions
from .evaluation import accuracy
from .lines import vocabulary_stats


def features(text: Column, low: int = 2, high: int = 4, word_ngrams: int = 1) -> Column:
    """Character n-grams of words with their ends marked, the words themselves, and pairs of words if asked for."""
    ws = words(F.coalesce(text, F.lit("")))
    marked = F.transform(ws, lambda w: F.concat(F.lit("<"), w, F.lit(">")))
    grams = [F.flatten(F.transform(marked, lambda w, n=n: shingles(w, n))) for n in range(low, high + 1)]
    out = [ws, *grams]
    if word_ngrams > 1:
        out.append(F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - 1, F.lit(1))), lambda i: F.array_join(F.slice(ws, i, 2), " ")))
    return F.concat(*out)


def train(lines: DataFrame, label: str = "gold", text: str = "text", low: int = 2, high: int = 4, word_ngrams: int = 1, buckets: int = 1 << 16, loss: str = "bayes") -> PipelineModel:
    """Fit on labelled texts. `loss` is `bayes`, one pass over the data, `ova`, one logistic model a label, or `softmax`."""
    base = lines.where(F.col(label).isNotNull()).select(F.col(label).alias("gold"), features(F.col(text), low, high, word_ngrams).alias("grams"))
    index = StringIndexer(inputCol="gold", outputCol="y", handleInvalid="skip", stringOrderType="alphabetAsc").fit(base)
    hashed = HashingTF(inputCol="grams", outputCol="x", numFeatures=buckets)
    kinds = {"bayes": lambda: NaiveBayes(labelCol="y", featuresCol="x"), "softmax": lambda: LogisticRegression(labelCol="y", featuresCol="x", maxIter=20, regParam=1e-4)}
    fitted = OneVsRest(classifier=LogisticRegression(maxIter=10, regParam=1e-4), labelCol="y", featuresCol="x") if loss == "ova" else kinds[loss]()
    names = IndexToString(inputCol="prediction", outputCol="pred", labels=index.labels)
    model = Pipeline(stages=[hashed, fitted, names]).fit(index.transform(base))
    model.low, model.high, model.word_ngrams = low, high, word_ngrams
    return model


def predict(model: PipelineModel, lines: DataFrame, text: str = "text") -> DataFrame:
    """The rows with `pred` and `prob` of the best label."""
    grams = features(F.col(text), getattr(model, "low", 2), getattr(model, "high", 4), getattr(model, "word_ngrams", 1))
    out = model.transform(lines.withColumn("grams", grams))
    prob = F.array_max(vector_to_array("probability")) if "probability" in out.columns else F.lit(None).cast("double")
    return out.withColumn("prob", prob).select(*lines.columns, "pred", "prob")


def train_per_script(lines: DataFrame, script: str = "script", split: str = "split", **options) -> dict[str, tuple[PipelineModel | None, str]]:
    """A model for each script with rows in all of train, valid and test; others are skipped with the reason."""
    seen = small(lines.where(F.regexp_like(F.col(script), F.lit("^[A-Za-z]{4}$"))).groupBy(script).agg(F.count_distinct(split).alias("n"), F.count_distinct("gold").alias("k")))
    out: dict[str, tuple[PipelineModel | None, str]] = {}
    for r in sorted(seen, key=lambda r: r[script]):
        if r["n"] < 3:
            out[r[script]] = (None, "a split is missing")
        elif r["k"] < 2:
            out[r[script]] = (None, "fewer than two labels")
        else:
            out[r[script]] = (train(lines.where((F.col(script) == r[script]) & (F.col(split) == "train")), **options), "trained")
    return out


def train_and_save(
    lines: DataFrame, path: str, script: str = "script", split: str = "split", loss: str = "ova", cutoff: int | None = None, samples: int = 5, **options
) -> DataFrame:
    """The whole training of `lines(gold, text, <script>, <split>)` into folders `<path>/<script>`: a report with one row
    per script, `script, status, vocab, labels, accuracy, quantised, samples`.

    A script lacking one of train, valid and test, or with fewer than two labels, is skipped, and so is one whose model is
    there already. Else the model, its arguments as JSON and its predictions of the test rows as tab-separated lines are
    saved. Where vocabulary and labels suffice for a codebook, a second model with no more features than the cutoff is
    trained and saved beside the first."""
    spark = lines.sparkSession
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    there = lambda p: files.exists(spark._jvm.org.apache.hadoop.fs.Path(p))
    known = lines.where(F.regexp_like(F.col(script), F.lit("^[A-Za-z]{4}$")))
    seen = small(known.groupBy(script).agg(F.count_distinct(F.when(F.col(split).isin("train", "valid", "test"), F.col(split))).alias("n"), F.count_distinct("gold").alias("k")))
    report = []
    for r in sorted(seen, key=lambda r: r[script]):
        name, folder = r[script], f"{path}/{r[script]}"
        if r["n"] < 3 or r["k"] < 2 or there(f"{folder}/model"):
            status = "a split is missing" if r["n"] < 3 else "fewer than two labels" if r["k"] < 2 else "present"
            report.append((name, status, None, r["k"], None, False, None))
            continue
        own = known.where(F.col(script) == name)
        fit_on = own.where(F.col(split) == "train")
        vocab = vocabulary_stats(fit_on, "text").first()["vocab"]
        model = train(fit_on, loss=loss, **options)
        model.write().overwrite().save(f"{folder}/model")
        scored = predict(model, own.where(F.col(split) == "test"))
        write_predictions(scored, f"{folder}/predictions")
        quantised = all(quantisation_gates(vocab, r["k"]))
        features_kept = spark.range(1).select(safe_cutoff(F.lit(cutoff).cast("long"), F.lit(vocab))).first()[0]
        if quantised:
            train(fit_on, loss=loss, **{**options, "buckets": int(features_kept)}).write().overwrite().save(f"{folder}/model_quantised")
        arguments = {"loss": loss, "low": 2, "high": 4, "word_ngrams": 1, "buckets": 1 << 16, **options, "cutoff": features_kept, "vocab": vocab, "labels": r["k"]}
        write_arguments(spark, arguments, f"{folder}/arguments")
        first = [f"{x['gold']} {x['pred']}" for x in scored.select("gold", "pred").limit(samples).collect()]
        report.append((name, "trained", vocab, r["k"], accuracy(scored).first()["accuracy"], quantised, first))
    return spark.createDataFrame(report, "script string, status string, vocab long, labels long, accuracy double, quantised boolean, samples array<string>")


def load(spark: SparkSession, path: str, script: str, quantised: bool = False) -> PipelineModel:
    """A saved model, ready to predict."""
    arguments = json.loads(spark.read.text(f"{path}/{script}/arguments").first()[0])
    model = PipelineModel.load(f"{path}/{script}/{'model_quantised' if quantised else 'model'}")
    model.low, model.high, model.word_ngrams = arguments["low"], arguments["high"], arguments["word_ngrams"]
    return model


def evaluate(model: PipelineModel, lines: DataFrame, text: str = "text") -> DataFrame:
    return accuracy(predict(model, lines, text))


def autotune(train_lines: DataFrame, valid_lines: DataFrame, grid: list[dict]) -> tuple[dict, PipelineModel]:
    """The options of the grid with the best accuracy on the validation lines, and their model."""
    best = None
    for options in grid:
        model = train(train_lines, **options)
        score = evaluate(model, valid_lines).first()["accuracy"]
        if best is None or score > best[0]:
            best = (score, options, model)
    return best[1], best[2]


def quantisation_gates(vocab: int, labels: int, least: int = 256) -> tuple[bool, bool]:
    """Whether inputs and outputs have the rows that a codebook of `least` entries needs."""
    return vocab >= least, labels >= least


def _first_centres(vectors: DataFrame, parts: int, width: int, codes: int, seed: int) -> np.ndarray:
    """(parts, codes, width) centres to start from: of a sample of 8 x `codes` vectors in order of a seeded hash, for each
    sub-vector the different values farthest apart, one after another."""
    drawn = vectors.orderBy(F.xxhash64(F.lit(seed), "v"), "v").limit(8 * codes).collect()
    sample = np.array([r["v"] for r in drawn], float).reshape(-1, parts, width)
    out = np.zeros((parts, codes, width))
    for k in range(parts):
        own = np.unique(sample[:, k], axis=0)
        if not len(own):
            continue
        chosen, gap = [0], ((own - own[0]) ** 2).sum(1)
        while len(chosen) < min(codes, len(own)):
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, ((own - own[chosen[-1]]) ** 2).sum(1))
        # fewer different values than codes: the rest repeat the first, which is always preferred
        out[k] = own[chosen + [chosen[0]] * (codes - len(chosen))]
    return out


def _nearest(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(vectors, parts) numbers of the nearest centres."""
    parts, _, width = centres.shape
    v = v.reshape(len(v), parts, width)
    return np.stack([((c**2).sum(1)[None] - 2 * v[:, k] @ c.T).argmin(1) for k, c in enumerate(centres)], 1)


def quantise(df: DataFrame, vector: str, dim: int, dsub: int = 4, codes: int = 256, seed: int = 1, rounds: int = 10) -> tuple[DataFrame, list]:
    """Product quantisation: the rows with `codes`, one centre number per sub-vector of width `dsub` (1 if it doesn't
    divide `dim`), and the centres. NULL vectors and those of another length have NULL codes.

    Lloyd's rounds run over all vectors and for all sub-vectors at once: each task adds up its vectors by centre, and what
    meets on the driver has the size of the codebook, which the parameters set."""
    if dim % dsub:
        dsub = 1
    parts = dim // dsub
    spark = df.sparkSession
    whole = df.withColumn("_v", F.when(F.size(vector) == dim, F.col(vector).cast("array<double>")))
    vectors = whole.where("_v is not null").select(F.col("_v").alias("v"))
    centres = _first_centres(vectors, parts, dsub, codes, seed) if parts else np.zeros((0, codes, dsub))

    def sums(shared):
        def run(frames):
            total, n = np.zeros((parts, codes, dsub)), np.zeros((parts, codes), np.int64)
            for f in frames:
                v = np.stack(f["v"].to_numpy())
                near = _nearest(v, shared.value)
                for k in range(parts):
                    np.add.at(total[k], near[:, k], v[:, k * dsub : (k + 1) * dsub])
                    n[k] += np.bincount(near[:, k], minlength=codes)
            at = np.argwhere(n > 0)
            yield pd.DataFrame({"k": at[:, 0], "c": at[:, 1], "n": [int(n[k, c]) for k, c in at], "s": [total[k, c].tolist() for k, c in at]})

        return run

    for _ in range(rounds if parts else 0):
        found = vectors.mapInPandas(sums(spark.sparkContext.broadcast(centres)), "k int, c int, n long, s array<double>")
        added = found.groupBy("k", "c").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("s", F.lit(j))) for j in range(dsub)]).alias("s")).collect()
        moved = centres.copy()
        for r in added:
            moved[r["k"], r["c"]] = np.array(r["s"]) / r["n"]
        still = np.allclose(moved, centres, rtol=0, atol=1e-6)
        centres = moved
        if still:
            break
    shared = spark.sparkContext.broadcast(centres)

    @F.pandas_udf("array<int>")
    def nearest(vectors: pd.Series) -> pd.Series:
        full = vectors.notna().to_numpy()
        out: list = [None] * len(vectors)
        if full.any():
            for i, row in zip(np.nonzero(full)[0], _nearest(np.stack(vectors[full].to_numpy()), shared.value).tolist()):
                out[i] = row
        return pd.Series(out, dtype=object)

    return whole.withColumn("codes", nearest("_v")).drop("_v"), centres.tolist()
