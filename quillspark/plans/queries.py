"""Registered queries: one per operator, over whole tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import labels as lb
from quillspark.functions import text as tx
from quillspark.operators import balance as bl
from quillspark.operators import evaluate as ev
from quillspark.operators import lexicon as lx
from quillspark.operators import models as md
from quillspark.operators import normalize as nm
from quillspark.operators import spelling as sp
from quillspark.operators import stacking as st
from quillspark.operators import vectors as vx
from quillspark.operators.cleaning import clean, clean_language, stripped, token_lengths
from quillspark.operators.extended import fit_extended, training_set
from quillspark.plans import job
from quillspark.plans import settings as sg
from quillspark.plans.features import feature_vectors, fit_features
from quillspark.plans.fixtures import DIM, base_table, resources, view, views
from quillspark.schemas import (
    CLASSES,
    EMOTIONS,
    EXT_EMOTIONS,
    LABELLED_TEXT,
    LABELS,
    SYMBOLS,
    count_column,
    default_features,
    normalized_column,
)
from quillspark.session import spread, stage, stage_path
from quillspark.sources import sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

COUNTS = [count_column(s) for s in SYMBOLS]
NORMALIZED = [normalized_column(c) for c in COUNTS]
# Features without the fitted emotion scores, so that they can be checked exactly.
PLAIN_FEATURES = ["percent_capitals", *NORMALIZED, *EMOTIONS, "slangscore"]
MIN_COUNT = 5


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _squashed(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "posts").select("id", "language", tx.squash(F.col("text")).alias("t"))


def _cleaned(spark: SparkSession, sf: str, language: str, name: str = "posts") -> DataFrame:
    return clean_language(view(spark, sf, name), language)


def _gold_and_pred(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    key = F.col("id").cast("string").alias("ID")
    gold = view(spark, sf, "tweets").select(key, "text", *LABELS)
    return gold, view(spark, sf, "predicted").select(key, *LABELS)


def _with_target(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "tweets").withColumn("Target", lb.encode_target())


# ---------------------------------------------------------------- sources and sinks


@query
def load_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Split files are written as TSV and read back by the loader."""
    tweets = stage(view(spark, sf, "tweets"), "tweets")
    folder = stage_path(spark, "splits")
    parts = []
    for language, code in (("english", "en"), ("spanish", "es")):
        for split in tables.SPLIT_STEMS:
            rows = tweets.where((F.col("language") == code) & (F.col("split") == split))
            sinks.write_tsv(
                rows.select(*LABELLED_TEXT.fieldNames()), f"{folder}/{tables.split_file(split, language)}"
            )
        parts.append(tables.load_data(spark, language, folder, multi_line=True))
    return parts[0].unionByName(parts[1])


@query
def export_gold(spark: SparkSession, sf: str) -> DataFrame:
    folder = stage_path(spark, "gold")
    sinks.write_gold(_cleaned(spark, sf, "en", "tweets"), folder, "en")
    schema = "id BIGINT, cleaned_text STRING, HS INT, TR INT, AG INT"
    return spark.read.schema(schema).options(**tables.TSV).csv(f"{folder}/en.tsv", header=True)


def _written_predictions(spark: SparkSession, sf: str) -> str:
    folder = stage_path(spark, "res")
    rows = view(spark, sf, "predicted").select("id", *[F.col(x).alias(f"{x}_prediction") for x in LABELS])
    sinks.write_predictions(rows, folder, "en")
    return folder


@query
def export_pred_a(spark: SparkSession, sf: str) -> DataFrame:
    folder = _written_predictions(spark, sf)
    rows = spark.read.schema("id BIGINT, HS_prediction INT").options(**tables.TSV)
    return rows.csv(f"{folder}/en_a.tsv", header=True)


@query
def export_pred_b(spark: SparkSession, sf: str) -> DataFrame:
    folder = _written_predictions(spark, sf)
    rows = spark.read.schema("id BIGINT, HS INT, TR INT, AG INT").options(**tables.TSV)
    return rows.csv(f"{folder}/en_b.tsv", header=True)


@query
def snapshot_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "snapshot")
    sinks.save_snapshot(_cleaned(spark, sf, "en", "tweets"), path)
    return sinks.load_snapshot(spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("!_count").alias("bangs")
    )


# ---------------------------------------------------------------- text functions


@query
def tokenize_ws(spark: SparkSession, sf: str) -> DataFrame:
    return _squashed(spark, sf).select("id", "t", F.size(tx.tokens(F.col("t"))).alias("n"))


@query
def remove_urls(spark: SparkSession, sf: str) -> DataFrame:
    return _squashed(spark, sf).select("id", tx.without_urls(F.col("t")).alias("t"))


@query
def hashtags(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("t")
    tags = F.array_join(tx.hashtags(t), " ").alias("tags")
    return _squashed(spark, sf).select("id", tags, tx.without_hashtags(t).alias("t"))


@query
def usernames(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("t")
    users = F.array_join(tx.user_names(t), " ").alias("users")
    return _squashed(spark, sf).select("id", users, tx.with_user_token(t).alias("t"))


@query
def symbol_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("t")
    counts = [tx.symbol_count(t, s).alias(count_column(s)) for s in SYMBOLS]
    return _squashed(spark, sf).select("id", *counts, tx.without_symbols(t, SYMBOLS).alias("t"))


@query
def capital_share(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("t")
    return _squashed(spark, sf).select(
        "id", tx.capital_share(t).alias("percent_capitals"), F.lower(t).alias("t")
    )


@query
def emoji_names(spark: SparkSession, sf: str) -> DataFrame:
    return _squashed(spark, sf).select("id", F.lower(tx.emoji_named(F.col("t"))).alias("t"))


@query
def tokenize_words(spark: SparkSession, sf: str) -> DataFrame:
    found = tx.word_tokens(F.col("t"))
    return _squashed(spark, sf).select(
        "id", F.size(found).alias("n"), F.array_join(found, " ").alias("tokens")
    )


def _clean_output(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "id", "language", "raw_text", "cleaned_text", F.array_join("hashtags", " ").alias("hashtags"),
        F.array_join("user_ids", " ").alias("user_ids"), "percent_capitals", *[f"`{c}`" for c in COUNTS],
    )


@query
def clean_en(spark: SparkSession, sf: str) -> DataFrame:
    return _clean_output(_cleaned(spark, sf, "en"))


@query
def clean_es(spark: SparkSession, sf: str) -> DataFrame:
    return _clean_output(_cleaned(spark, sf, "es"))


@query
def token_length_hist(spark: SparkSession, sf: str) -> DataFrame:
    return token_lengths(_squashed(spark, sf), "t")


@query
def head_rows(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "tweets").orderBy("id").limit(5).select("id", "language", *LABELS)


# ---------------------------------------------------------------- spelling


def _spelling_inputs(spark: SparkSession, sf: str, language: str = "en") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cleaned texts of a language, their tokens, and the dictionary of their frequent words."""
    texts = stage(stripped(view(spark, sf, "posts").where(F.col("language") == language)).select("id", "cleaned_text"), "texts")
    tokens = texts.select("id", F.explode(tx.tokens(F.col("cleaned_text"))).alias("word"))
    dictionary = sp.build_dictionary(tokens.where(F.col("word").rlike(r"^\p{L}+$")), MIN_COUNT)
    return texts, tokens, stage(dictionary, "dictionary")


@query
def spell_candidates(spark: SparkSession, sf: str) -> DataFrame:
    _, tokens, dictionary = _spelling_inputs(spark, sf)
    return sp.candidates(sp.unknown_tokens(tokens, dictionary), dictionary)


@query
def spell_correct(spark: SparkSession, sf: str) -> DataFrame:
    texts, _, dictionary = _spelling_inputs(spark, sf)
    return sp.correct_texts(texts, dictionary)


@query
def spell_candidates_es(spark: SparkSession, sf: str) -> DataFrame:
    _, tokens, dictionary = _spelling_inputs(spark, sf, "es")
    return sp.candidates(sp.unknown_tokens(tokens, dictionary), dictionary)


@query
def spell_correct_es(spark: SparkSession, sf: str) -> DataFrame:
    texts, _, dictionary = _spelling_inputs(spark, sf, "es")
    return sp.correct_texts(texts, dictionary)


# ---------------------------------------------------------------- labels


@query
def target_encode(spark: SparkSession, sf: str) -> DataFrame:
    return _with_target(spark, sf).select("id", "Target")


@query
def target_decode(spark: SparkSession, sf: str) -> DataFrame:
    return _with_target(spark, sf).select(
        "id", *[lb.decode_target(F.col("Target"), x).alias(f"{x}_prediction") for x in LABELS]
    )


@query
def target_code(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "tweets").select(
        "id", F.col("text").alias("body"), lb.target_code().alias("target")
    )


@query
def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bl.class_counts(_with_target(spark, sf))


@query
def class_deficit(spark: SparkSession, sf: str) -> DataFrame:
    return bl.class_deficits(_with_target(spark, sf))


@query
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return bl.class_weights(_with_target(spark, sf))


@query
def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = clean(view(spark, sf, "tweets")).withColumn("Target", lb.encode_target())
    return bl.balance(cleaned.select("percent_capitals", *[f"`{c}`" for c in COUNTS], "Target"))


@query
def class_balance_support(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each balanced class, and how many come from no original: their noise is far below half a count."""
    cleaned = clean(view(spark, sf, "tweets")).withColumn("Target", lb.encode_target())
    rows = stage(cleaned.select(*[f"`{c}`" for c in COUNTS], "Target"), "counts")
    names = [f"k{i}" for i in range(len(COUNTS))]
    real = rows.select("Target", *[F.col(f"`{c}`").cast("long").alias(k) for c, k in zip(COUNTS, names)]).distinct()
    drawn = bl.balance(rows).select("Target", *[F.round(f"`{c}`").cast("long").alias(k) for c, k in zip(COUNTS, names)])
    joined = drawn.join(real.withColumn("real", F.lit(1)), ["Target", *names], "left")
    return joined.groupBy("Target").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("real").isNull()).alias("unmatched"))


@query
def baseline_mode(spark: SparkSession, sf: str) -> DataFrame:
    return md.label_modes(view(spark, sf, "tweets").where("split = 'train'"))


# ---------------------------------------------------------------- lexicons


@query
def lexicon_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return lx.last_wins(view(spark, sf, "slang"))


@query
def stopword_anti(spark: SparkSession, sf: str) -> DataFrame:
    slang, stop_words = views(spark, sf, "slang", "stop_words")
    return lx.without_stop_words(lx.last_wins(slang), stop_words)


@query
def polarity_resolve(spark: SparkSession, sf: str) -> DataFrame:
    return lx.resolve_polarity(view(spark, sf, "polarity"))


@query
def lexicon_multimap(spark: SparkSession, sf: str) -> DataFrame:
    maps = lx.multimaps(view(spark, sf, "emotions_es"))
    return maps.select(
        "word", F.array_join("translations", " ").alias("translations"), F.array_join("emotions", " ").alias("emotions")
    )


def _scored(spark: SparkSession, sf: str, language: str) -> DataFrame:
    return stage(_cleaned(spark, sf, language).select("id", "cleaned_text"), "texts")


@query
def slang_score(spark: SparkSession, sf: str) -> DataFrame:
    texts = _scored(spark, sf, "en")
    scores = lx.slang_scores(texts, *views(spark, sf, "slang", "stop_words"))
    return lx.with_defaults(texts.select("id"), scores)


@query
def polarity_score(spark: SparkSession, sf: str) -> DataFrame:
    texts = _scored(spark, sf, "es")
    return lx.with_defaults(texts.select("id"), lx.polarity_scores(texts, view(spark, sf, "polarity")))


@query
def emotion_counts(spark: SparkSession, sf: str) -> DataFrame:
    texts = _scored(spark, sf, "en")
    return lx.with_defaults(texts.select("id"), lx.emotion_counts(texts, view(spark, sf, "emotions")))


@query
def emotion_shares(spark: SparkSession, sf: str) -> DataFrame:
    texts = _scored(spark, sf, "en")
    return lx.with_defaults(texts.select("id"), lx.emotion_shares(texts, view(spark, sf, "emotions")), 0.0)


@query
def emotion_shares_es(spark: SparkSession, sf: str) -> DataFrame:
    texts = _scored(spark, sf, "es")
    part = lx.emotion_shares(texts, view(spark, sf, "emotions_es"), suffix="_esp")
    return lx.with_defaults(texts.select("id"), part, 0.0)


# ---------------------------------------------------------------- vectors


def _checksum(column: str = "vec") -> F.Column:
    weighted = F.transform(F.col(column), lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x), 6)


@query
def vector_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Vector lines, with an earlier line of other numbers for each word, and a header."""
    vectors = spread(stage(view(spark, sf, "vectors"), "vectors"))
    line = F.concat_ws(" ", "word", F.array_join(F.col("vec").cast("array<string>"), " "))
    earlier = F.concat_ws(" ", F.col("word"), F.array_join(F.transform("vec", lambda x: (-x).cast("string")), " "))
    lines = vectors.select(
        F.inline(F.array(*[
            F.struct(text.alias("line"), F.lit(i + 1).alias("load_order")) for i, text in enumerate([earlier, line])
        ]))
    )
    header = base_table(spark, sf, "embeddings").agg(F.count(F.lit(1)).alias("c")).select(
        F.format_string("%d 64", "c").alias("line"), F.lit(0).alias("load_order")
    )
    parsed = vx.parse_vectors(lines.unionByName(header), header=True)
    return parsed.select("word", F.size("vec").alias("dim"), _checksum().alias("checksum"))


@query
def glove_lookup(spark: SparkSession, sf: str) -> DataFrame:
    texts = _scored(spark, sf, "en")
    found = vx.vector_lookup(texts, view(spark, sf, "vectors"))
    return found.select("id", "pos", "word", _checksum().alias("checksum"))


@query
def glove_mean(spark: SparkSession, sf: str) -> DataFrame:
    texts = _scored(spark, sf, "en")
    means = vx.mean_vectors(texts, view(spark, sf, "vectors"), DIM, "mean")
    full = vx.with_zero_vector(texts.select("id"), means, DIM, "mean")
    return full.select("id", F.posexplode("mean").alias("dim", "value")).select(
        "id", "dim", F.round("value", 6).alias("value")
    )


@query
def embedding_expand(spark: SparkSession, sf: str) -> DataFrame:
    return vx.expand_embedding(base_table(spark, sf, "embeddings"), "embedding", DIM)


@query
def doc_embedding_join(spark: SparkSession, sf: str) -> DataFrame:
    vectors = base_table(spark, sf, "embeddings").selectExpr("vec_id AS id", "embedding AS vec")
    joined = vx.attach_document_vectors(view(spark, sf, "posts").select("id", "language"), vectors, "sentence")
    return joined.select("id", "language", F.coalesce(F.size("sentence"), F.lit(-1)).alias("dim"),
                         F.col("sentence")[0].cast("double").alias("first"))


@query
def translation_join(spark: SparkSession, sf: str) -> DataFrame:
    texts = view(spark, sf, "posts").where("language = 'es'").select("id", "text")
    return vx.attach_translations(texts, view(spark, sf, "translations"))


# ---------------------------------------------------------------- extended emotions


@query
def ext_training_set(spark: SparkSession, sf: str) -> DataFrame:
    rows = training_set(*views(spark, sf, "emotions", "vectors"))
    return rows.select("word", *EXT_EMOTIONS, _checksum().alias("checksum"))


@query
def ext_training_set_phrases(spark: SparkSession, sf: str) -> DataFrame:
    rows = training_set(*views(spark, sf, "phrase_emotions", "vectors"), split_phrases=True)
    return rows.select("word", *EXT_EMOTIONS, _checksum().alias("checksum"))


def _ext(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    texts = _scored(spark, sf, "en")
    emotions, vectors = views(spark, sf, "emotions", "vectors")
    vectors = stage(vectors, "vectors")
    model = fit_extended(training_set(emotions, vectors))
    return lx.with_defaults(texts.select("id"), model.score_texts(texts, vectors, kind), 0.0)


@query
def ext_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _ext(spark, sf, "prob")


@query
def ext_scores_binary(spark: SparkSession, sf: str) -> DataFrame:
    return _ext(spark, sf, "binary")


# ---------------------------------------------------------------- normalisers


def _counts_by_split(spark: SparkSession, sf: str) -> DataFrame:
    return clean(view(spark, sf, "tweets")).select("id", "split", *[f"`{c}`" for c in COUNTS])


def _normalized(spark: SparkSession, sf: str, method: str, apply_to_new: bool) -> DataFrame:
    rows = _counts_by_split(spark, sf)
    train = rows.where("split = 'train'")
    model = nm.Normalizer(columns=COUNTS, method=method).fit(train)
    target = rows.where("split <> 'train'") if apply_to_new else train
    scored = model.transform(target)
    return scored.select("id", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in NORMALIZED])


@query
def norm_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf, "min_max", False)


@query
def norm_minmax_apply(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf, "min_max", True)


@query
def norm_zscore(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf, "z_score", False)


@query
def norm_zscore_apply(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf, "z_score", True)


# ---------------------------------------------------------------- features


def _plain_features(spark: SparkSession, sf: str) -> DataFrame:
    """English labelled texts with every feature that needs no fitted word model."""
    cleaned = stage(_cleaned(spark, sf, "en", "tweets"), "cleaned")
    normalizer = nm.Normalizer(columns=COUNTS, method="z_score").fit(cleaned.where("split = 'train'"))
    base, texts = normalizer.transform(cleaned), cleaned.select("id", "cleaned_text")
    names = ("slang", "stop_words", "emotions", "vectors")
    slang, stop_words, emotions, vectors = views(spark, sf, *names)
    out = lx.with_defaults(base, lx.slang_scores(texts, slang, stop_words))
    out = lx.with_defaults(out, lx.emotion_shares(texts, emotions), 0.0)
    means = vx.mean_vectors(texts, vectors, DIM, "Aggregate_embeddings")
    return vx.with_zero_vector(out, means, DIM, "Aggregate_embeddings")


@query
def feature_vectors_table(spark: SparkSession, sf: str) -> DataFrame:
    flat = feature_vectors(_plain_features(spark, sf), PLAIN_FEATURES, {"Aggregate_embeddings": DIM})
    fractional = {*NORMALIZED, *EMOTIONS, *[f"Aggregate_embeddings_dim_{i}" for i in range(DIM)]}
    return flat.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if c in fractional else F.col(f"`{c}`") for c in flat.columns])


QUERIES["feature_vectors"] = QUERIES.pop("feature_vectors_table")


def _all_features(spark: SparkSession, sf: str, language: str, fit_splits: bool) -> DataFrame:
    code = {"english": "en", "spanish": "es"}[language]
    cleaned = stage(_cleaned(spark, sf, code, "tweets"), "cleaned")
    train = cleaned.where("split = 'train'")
    model = fit_features(train, resources(spark, sf, language), language)
    target = train if fit_splits else cleaned.where("split <> 'train'")
    names = [f"`{c}`" for c in default_features(language)]
    attached = [*model.resources.document_vectors, *(["translated_text"] if language == "spanish" else [])]
    return model.transform(target).select("id", *names, *attached, "Aggregate_embeddings", *LABELS)


@query
def features_train(spark: SparkSession, sf: str) -> DataFrame:
    return _all_features(spark, sf, "english", True)


@query
def features_apply(spark: SparkSession, sf: str) -> DataFrame:
    return _all_features(spark, sf, "english", False)


@query
def features_train_es(spark: SparkSession, sf: str) -> DataFrame:
    return _all_features(spark, sf, "spanish", True)


# ---------------------------------------------------------------- models

EMBEDDINGS = ["Aggregate_embeddings"]
FOREST = {"n_estimators": 40, "criterion": "gini", "max_depth": 10, "class_weight": "balanced", "max_samples": 0.7}
# As many trees as the reference's settings, with no bound of depth but Spark's own.
WHOLE_FOREST = {**FOREST, "n_estimators": 1000, "max_depth": None}
LINEAR = {"kernel": "linear", "C": 1.0}


def _model_output(predicted: DataFrame) -> DataFrame:
    return predicted.select("id", *LABELS, *[f"{x}_prediction" for x in LABELS])


def _fit_predict(spark: SparkSession, sf: str, kind: str, target: str, params: dict) -> DataFrame:
    table = stage(_plain_features(spark, sf), "features")
    spec = md.ModelSpec(kind, target, list(LABELS), PLAIN_FEATURES, EMBEDDINGS, params)
    model = md.fit_model(table.where("split = 'train'"), spec)
    return _model_output(model.transform(table))


@query
def baseline_predict(spark: SparkSession, sf: str) -> DataFrame:
    tweets = view(spark, sf, "tweets")
    model = md.fit_model(tweets.where("split = 'train'"), md.ModelSpec("baseline"))
    return model.transform(tweets).select("id", *[f"{x}_prediction" for x in LABELS])


@query
def rf_separate(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_predict(spark, sf, "random_forest", "separate", FOREST)


@query
def rf_together(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_predict(spark, sf, "random_forest", "together", WHOLE_FOREST)


@query
def svm_separate(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_predict(spark, sf, "svm", "separate", LINEAR)


@query
def svm_together(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_predict(spark, sf, "svm", "together", LINEAR)


@query
def lr_separate(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_predict(spark, sf, "logistic_regression", "separate", {})


@query
def lr_together(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_predict(spark, sf, "logistic_regression", "together", {})


def _stack(spark: SparkSession, sf: str, ensembler: str) -> DataFrame:
    table = stage(_plain_features(spark, sf), "features")
    spec = st.StackSpec(ensembler, PLAIN_FEATURES, EMBEDDINGS, {"random_forest": FOREST, "svm": LINEAR})
    return st.fit_stack(table.where("split = 'train'"), spec).transform(table)


@query
def stack_features(spark: SparkSession, sf: str) -> DataFrame:
    """Target, class probabilities of the sub-models and the ensembler's class."""
    scored = _stack(spark, sf, "ensembler_lr").withColumn("Target", lb.encode_target())
    names = [c for c in scored.columns if c.split("_")[0] in st.PREFIXES and c.split("_", 1)[1] in CLASSES]
    return scored.select("id", "Target", *[f"`{c}`" for c in names], "Ensemble_target")


@query
def ensemble_lr(spark: SparkSession, sf: str) -> DataFrame:
    return _model_output(_stack(spark, sf, "ensembler_lr"))


@query
def ensemble_dt(spark: SparkSession, sf: str) -> DataFrame:
    return _model_output(_stack(spark, sf, "ensembler_dt"))


# ---------------------------------------------------------------- evaluation


@query
def eval_task_a(spark: SparkSession, sf: str) -> DataFrame:
    return ev.evaluate_a(*_gold_and_pred(spark, sf))


@query
def eval_task_b(spark: SparkSession, sf: str) -> DataFrame:
    return ev.evaluate_b(*_gold_and_pred(spark, sf))


@query
def eval_checks(spark: SparkSession, sf: str) -> DataFrame:
    return ev.check_counts(*_gold_and_pred(spark, sf))


@query
def eval_bad_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions in which some HS values are 2, which gold does not have."""
    gold, pred = _gold_and_pred(spark, sf)
    return ev.bad_labels(gold, pred.withColumn("HS", F.col("HS") + F.col("TR")))


@query
def eval_report(spark: SparkSession, sf: str) -> DataFrame:
    """The score lines with rounded values, since engines print doubles differently."""
    gold, pred = _gold_and_pred(spark, sf)
    rounded = [rows.withColumn("value", F.format_number("value", 6)) for rows in
               (ev.evaluate_a(gold, pred), ev.evaluate_b(gold, pred))]
    return ev.score_report(*rounded)


@query
def eval_by_file(spark: SparkSession, sf: str) -> DataFrame:
    """Prediction files of two languages in one folder, scored file by file."""
    folder = stage_path(spark, "res")
    tweets = view(spark, sf, "tweets").select("id", "language")
    rows = stage(view(spark, sf, "predicted").join(tweets, "id"), "predicted")
    renamed = [F.col(x).alias(f"{x}_prediction") for x in LABELS]
    for code in ("en", "es"):
        sinks.write_predictions(rows.where(F.col("language") == code).select("id", *renamed), folder, code)
    gold, _ = _gold_and_pred(spark, sf)
    keys = ["language", "task"]
    scored = []
    for task, labels, score in (("a", ["HS"], ev.score_a), ("b", LABELS, ev.score_b)):
        pred = tables.read_prediction_folder(spark, folder, task)
        matched = ev.match(gold, pred, labels, keys)
        scored.append(score(matched, keys=keys))
    return scored[0].unionByName(scored[1]).select(*keys, "metric", F.round("value", 6).alias("value"))


def write_job_files(spark: SparkSession, sf: str) -> dict:
    """All input files of the job in one folder, and settings that name them."""
    folder = stage_path(spark, "job")
    tweets = stage(view(spark, sf, "tweets").where("language = 'en'"), "tweets")
    for split in tables.SPLIT_STEMS:
        rows = tweets.where(F.col("split") == split).select(*LABELLED_TEXT.fieldNames())
        sinks.write_tsv(rows, f"{folder}/{tables.split_file(split, 'english')}")
    slang, stop_words, emotions, vectors = views(spark, sf, "slang", "stop_words", "emotions", "vectors")
    slang.orderBy("load_order").select("term", "score").write.options(**tables.TSV).csv(f"{folder}/slang.txt")
    stop_words.write.text(f"{folder}/stop_words.txt")
    emotions.write.options(**tables.TSV).csv(f"{folder}/emotions.tsv")
    line = F.concat_ws(" ", "word", F.array_join(F.col("vec").cast("array<string>"), " "))
    vectors.select(line).write.text(f"{folder}/vectors.txt")
    place = lambda name: {
        "input_directory": f"{folder}/{name}/", "output_directory": f"{folder}/{name}/scores/", "output_file": "scores.out",
        "goldpath": f"{folder}/{name}/ref/", "predpath": f"{folder}/{name}/res/",
    }
    return {
        "document_processing": {
            "input_tsv_files": {"filepath": folder, "language": "english", "multi_line": True},
            "save_or_load": "save", "processed_data_dir": f"{folder}/processed",
        },
        "model": {
            "feature_engineering": {
                "embedding_path": f"{folder}/vectors.txt", "embedding_dim": DIM, "nrc_embedding_file": f"{folder}/vectors.txt",
                "emotion_path": f"{folder}/emotions.tsv", "slang_dict_path": f"{folder}/slang.txt", "stop_words_path": f"{folder}/stop_words.txt",
            },
            "classification": {
                "approach": "logistic_regression",
                "params": {
                    "tasks": list(sg.TASKS), "prediction_target": "together", "features": "All", "embedding_features": EMBEDDINGS,
                    "model_params": {"logistic_regression_params": {"penalty": "l2", "solver": "sag", "max_iter": 1000}},
                },
            },
        },
        "evaluation": {"development": place("dev"), "test": place("test")},
    }


@query
def settings_job(spark: SparkSession, sf: str) -> DataFrame:
    """The job from a settings file: texts and side tables are written as files, read, cleaned, fitted and scored."""
    settings = write_job_files(spark, sf)
    path = stage_path(spark, "settings")
    spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.text(path)
    return sg.run_settings(spark, path, checked=False).scores


def end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Clean, engineer all features, fit the classifier and score the other splits."""
    spec = md.ModelSpec("logistic_regression", features=default_features(), embeddings=EMBEDDINGS)
    result = job.run(view(spark, sf, "tweets"), resources(spark, sf), spec, checked=False)
    return result.scores
