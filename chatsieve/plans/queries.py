"""One query per operator over the given tables."""

from __future__ import annotations

import re

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatsieve.functions.patterns import WORD_CHAR, folded
from chatsieve.functions.text import text_key
from chatsieve.operators import cost, evaluate, features, fuzzy, mining, models, rules, sampling
from chatsieve.operators import tokens as token_ops
from chatsieve.operators.skew import settled
from chatsieve.plans import tables, workflows
from chatsieve.plans.tables import WORDS
from chatsieve.session import scratch_path
from chatsieve.sources import model_store, readers
from chatsieve.streaming import moderation

FEW_WORDS = ("trash", "clown", "idiot")
INNER_WORDS = ("reat", "anded")
ALLOWED = ("great", "anreat", "reating", "handed", "created", "threat")
STOP_WORDS = ("the", "of", "and", "la", "die", "der", "les", "que")
QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def flagged(spark: SparkSession, d: str) -> DataFrame:
    return rules.rule_flag(tables.messages(spark, d), WORDS)


def two_filters(spark: SparkSession, d: str) -> DataFrame:
    """Messages with the verdicts of two word-list filters."""
    m = tables.messages(spark, d)
    return rules.rule_flag(rules.rule_flag(m, WORDS, out="full"), FEW_WORDS, "substring", out="short")


def text_cache(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts of the labelled texts, one per distinct text."""
    m = tables.messages(spark, d)
    return m.groupBy(text_key(F.col("message")).alias("text_key")).agg(F.bool_or("toxic").alias("verdict"))


def word_table(spark: SparkSession, d: str) -> DataFrame:
    """A word list as a table: the long words of the benchmark items and the insults."""
    bench = tables.table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("message"))
    long_words = token_ops.tokens(bench).filter(F.length("term") >= 9).select(F.col("term").alias("word"))
    insults = spark.createDataFrame([(w,) for w in WORDS], "word string")
    return long_words.unionByName(insults).distinct()


def every_word(spark: SparkSession, d: str) -> DataFrame:
    """A word table that outgrows any expression: all distinct words of the documents, and
    every two neighbouring words of the benchmark as a phrase."""
    words = F.regexp_extract_all(folded(F.col("text")), F.lit(WORD_CHAR + "+"), F.lit(0))
    pair = F.transform(F.arrays_zip("w", F.slice("w", 2, F.size("w")).alias("v")), lambda x: F.concat_ws(" ", x["w"], x["v"]))
    phrases = tables.table(spark, d, "benchmark").select(words.alias("w")).select(F.explode(pair).alias("word"))
    # An outer explode: of an inner one the optimiser finds the words again in a filter.
    every = tables.documents(spark, d).select(F.explode_outer(words).alias("word"))
    single = every.filter(F.col("word").isNotNull()).distinct()
    return single.union(phrases.filter(F.contains("word", F.lit(" "))).distinct())


def split_messages(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified_split(tables.messages(spark, d))


def train_rows(spark: SparkSession, d: str) -> DataFrame:
    return split_messages(spark, d).filter(F.col("split") == "train")


def test_rows(spark: SparkSession, d: str) -> DataFrame:
    return split_messages(spark, d).filter(F.col("split") == "test")


# --- sources and sinks -------------------------------------------------------


@query
def read_messages(spark, d):
    path = scratch_path(spark, "messages")
    rows = tables.messages(spark, d).select(
        F.col("id").alias("index"),
        F.when(F.col("id") % 29 == 0, "null").otherwise(F.col("message")).alias("message"),
        F.col("label").cast("double").alias("label"),
    )
    rows.write.csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    back = readers.stored(readers.read_messages(spark, path), scratch_path(spark, "stored"))
    return back.select("index", F.md5("message").alias("message_md5"), "label")


@query
def read_usernames(spark, d):
    path = scratch_path(spark, "names")
    tables.names(spark, d).select("id", "author").write.csv(path, header=True, quote='"', escape='"')
    return readers.read_usernames(spark, path)


@query
def read_wordlist(spark, d):
    path = scratch_path(spark, "words")
    every = F.posexplode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).alias("at", "word")
    lines = tables.documents(spark, d).select(every).select(
        F.when(F.col("at") % 7 == 0, "   ").otherwise(F.concat(F.lit("  "), F.lower("word"), F.lit("\t"))).alias("value")
    )
    lines.write.text(path)
    return readers.read_wordlist(spark, path)


@query
def save_load_model(spark, d):
    """Scores of a counts model that was saved and read again, and what was kept with it."""
    path = scratch_path(spark, "model")
    fitted = models.fit_naive_bayes(tables.messages(spark, d), min_df=3, max_df=0.2)
    model_store.save_model(spark, fitted, path, frac=0.2, seed=42)
    loaded, kept = model_store.load_model(spark, path)
    scored = models.score(tables.texts(spark, d), loaded)
    return scored.select(
        "id", F.round("probability", 6).alias("probability"), F.lit(kept["frac"]).alias("frac"), F.lit(kept["seed"]).alias("seed")
    )


@query
def union_datasets(spark, d):
    m = tables.messages(spark, d).select("id", F.md5("message").alias("message_md5"), "label")
    c = tables.table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.md5("text").alias("message_md5"), F.lit(0).alias("label")
    )
    return mining.union_datasets({"documents": m, "conversations": c})


# --- projections, filters, text functions --------------------------------------


@query
def binary_label(spark, d):
    return evaluate.binary_label(tables.messages(spark, d).drop("toxic")).select("id", "label", "toxic")


@query
def contains_word(spark, d):
    return rules.contains_word(tables.messages(spark, d), "trash")


@query
def rule_flag_boundary(spark, d):
    return rules.rule_flag(tables.texts(spark, d), WORDS).select("id", "flagged")


@query
def rule_flag_substring(spark, d):
    return rules.rule_flag(tables.texts(spark, d), WORDS, "substring").select("id", "flagged")


@query
def rule_flag_caps(spark, d):
    return rules.rule_flag(tables.names(spark, d), WORDS, "caps", text="author").select("id", "flagged")


@query
def rule_flag_names_boundary(spark, d):
    return rules.rule_flag(tables.names(spark, d), WORDS, text="author").select("id", "flagged")


@query
def rule_flag_names_substring(spark, d):
    return rules.rule_flag(tables.names(spark, d), WORDS, "substring", text="author").select("id", "flagged")


@query
def rule_flag_token(spark, d):
    return rules.rule_flag(tables.texts(spark, d), WORDS, "token").select("id", "flagged")


@query
def rule_flag_token_table(spark, d):
    return rules.rule_flag(tables.texts(spark, d).select("id", "message"), word_table(spark, d), "token").select(
        "id", "flagged"
    )


@query
def rule_flag_boundary_table(spark, d):
    return rules.rule_flag(tables.texts(spark, d), word_table(spark, d)).select("id", "flagged")


@query
def rule_flag_substring_table(spark, d):
    return rules.rule_flag(tables.names(spark, d), word_table(spark, d), "substring", text="author").select("id", "flagged")


@query
def token_hits(spark, d):
    return rules.token_hits(tables.texts(spark, d), word_table(spark, d))


@query
def rule_flag_caps_table(spark, d):
    return rules.rule_flag(tables.names(spark, d), word_table(spark, d), "caps", text="author").select("id", "flagged")


@query
def name_segments(spark, d):
    return rules.name_segments(tables.names(spark, d)).select("id", F.array_join("segments", " ").alias("segments"))


@query
def normalise_text(spark, d):
    return token_ops.normalise_text(tables.texts(spark, d)).select("id", "normalised")


@query
def rule_flag_normalised(spark, d):
    return rules.rule_flag(token_ops.normalise_text(tables.texts(spark, d)), WORDS, text="normalised").select("id", "flagged")


@query
def censor(spark, d):
    return rules.censor(tables.texts(spark, d), WORDS).select("id", "censored")


@query
def censor_per_char(spark, d):
    return rules.censor(tables.texts(spark, d), WORDS, per_char=True).select("id", "censored")


@query
def explain_match(spark, d):
    return rules.explain_match(tables.texts(spark, d), WORDS)


@query
def censor_table(spark, d):
    return rules.censor(tables.texts(spark, d), every_word(spark, d), per_char=True).select("id", "censored")


@query
def explain_match_table(spark, d):
    return rules.explain_match(tables.texts(spark, d), every_word(spark, d))


@query
def apply_exceptions(spark, d):
    return rules.apply_exceptions(tables.texts(spark, d), INNER_WORDS, ALLOWED).select("id", "flagged")


@query
def apply_exceptions_table(spark, d):
    allow = spark.createDataFrame([(w,) for w in ALLOWED], "word string")
    return rules.apply_exceptions(tables.texts(spark, d).select("id", "message"), INNER_WORDS, allow).select("id", "flagged")


@query
def apply_exceptions_two_tables(spark, d):
    """Long words of all documents as the rule, the words and phrases of the benchmark allowed."""
    rule = every_word(spark, d).filter(~F.contains("word", F.lit(" ")) & (F.length("word") >= 8))
    bench = tables.table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("message"))
    allow = token_ops.tokens(bench).select(F.col("term").alias("word"))
    return rules.apply_exceptions(tables.texts(spark, d).select("id", "message"), rule, allow).select("id", "flagged")


def stub_annotations(spark, d):
    return cost.parse_verdict(tables.replies(flagged(spark, d)))


@query
def parse_verdict(spark, d):
    return stub_annotations(spark, d).select("id", "status", "verdict")


@query
def tokens(spark, d):
    return token_ops.tokens(tables.texts(spark, d)).groupBy("id", "term").agg(F.count("*").alias("tf"))


@query
def word_ngrams(spark, d):
    return token_ops.word_ngrams(tables.texts(spark, d), 1, 2).groupBy("n", "term").agg(F.count("*").alias("total"))


@query
def char_ngrams(spark, d):
    return token_ops.char_ngram_counts(tables.texts(spark, d), 1, 4)


@query
def remove_stop_words(spark, d):
    kept = token_ops.remove_stop_words(token_ops.tokens(tables.texts(spark, d)), STOP_WORDS)
    return kept.groupBy("term").agg(F.count("*").alias("total"))


@query
def remove_stop_words_table(spark, d):
    listed = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    kept = token_ops.remove_stop_words(token_ops.tokens(tables.texts(spark, d)), listed)
    return kept.groupBy("term").agg(F.count("*").alias("total"))


@query
def identify_language(spark, d):
    return token_ops.identify_language(tables.texts(spark, d)).select("id", "lang", "language")


# --- joins ---------------------------------------------------------------------


@query
def disagreements(spark, d):
    both = two_filters(spark, d)
    a = both.select("id", "toxic", F.col("full").alias("flagged"))
    b = both.select("id", F.col("short").alias("flagged"))
    return mining.disagreements(a, b, 50)


@query
def side_by_side(spark, d):
    t = tables.texts(spark, d)
    return evaluate.side_by_side(
        {
            "full": rules.rule_flag(t, WORDS),
            "short": rules.rule_flag(t, FEW_WORDS),
            "substring": rules.rule_flag(t, WORDS, "substring"),
        }
    )


@query
def cached_annotate(spark, d):
    answers, _ = cost.cached_annotate(tables.texts(spark, d), text_cache(spark, d))
    return answers.select("id", "cache_hit", "verdict")


@query
def cached_annotate_misses(spark, d):
    _, misses = cost.cached_annotate(tables.texts(spark, d), text_cache(spark, d))
    return misses.select(F.md5("message").alias("message_md5"), "copies")


@query
def semantic_cache(spark, d):
    # Every vector takes part: odd ids are the cache, even ids ask it.
    vectors = tables.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), (F.col("label") % 2 == 0).alias("verdict")
    )
    new, cache = vectors.filter(F.col("id") % 2 == 0), vectors.filter(F.col("id") % 2 == 1)
    return cost.semantic_cache(new, cache, 0.6).select("id", "match_id", F.round("cosine", 6).alias("cosine"), "verdict")


@query
def fuzzy_hits(spark, d):
    return fuzzy.fuzzy_hits(tables.texts(spark, d), WORDS, 1)


@query
def fuzzy_flag(spark, d):
    return fuzzy.fuzzy_flag(tables.texts(spark, d).select("id", "message"), WORDS, 2).select("id", "flagged")


# --- aggregates and reports ------------------------------------------------------


@query
def label_stats(spark, d):
    return evaluate.label_stats(tables.messages(spark, d)).withColumn("pct", F.round("pct", 6))


@query
def confusion(spark, d):
    return evaluate.confusion(flagged(spark, d))


@query
def classification_report(spark, d):
    return evaluate.classification_report(flagged(spark, d))


@query
def error_rows(spark, d):
    m = rules.rule_flag(tables.messages(spark, d), INNER_WORDS, "substring")
    kinds = [evaluate.error_rows(m, k).select(F.lit(k).alias("kind"), "id", "label") for k in ("fp", "fn")]
    return kinds[0].unionByName(kinds[1])


@query
def flag_summary(spark, d):
    names = rules.rule_flag(tables.names(spark, d), WORDS, "caps", text="author")
    out = evaluate.flag_summary(names)
    return out.withColumn("flagged_pct", F.round("flagged_pct", 6)).withColumn("clean_pct", F.round("clean_pct", 6))


@query
def precision_projection(spark, d):
    names = rules.rule_flag(tables.names(spark, d), WORDS, "caps", text="author")
    # The flagged ids are written once: the sample and the count both read them.
    names = settled(names.filter("flagged").select("id", "flagged"), "flagged")
    sample = sampling.seeded_sample(names, 50)
    reviewed = sample.select("id", (F.col("id") % 10 != 3).alias("offensive"))
    return evaluate.precision_projection(names, reviewed).withColumn("precision", F.round("precision", 6))


@query
def metrics_by(spark, d):
    return evaluate.metrics_by(flagged(spark, d), "lang")


@query
def metrics_by_source(spark, d):
    return evaluate.metrics_by(flagged(spark, d), "source")


@query
def rate_triage(spark, d):
    f = rules.rule_flag(tables.texts(spark, d), WORDS)
    return evaluate.rate_triage(f, "lang", 0.001, 0.01, {"en": (0.05, 0.2), "de": (0.3, 0.5)})


@query
def filter_comparison(spark, d):
    return evaluate.filter_comparison(two_filters(spark, d), ["full", "short"])


@query
def rule_scorecard(spark, d):
    return rules.rule_scorecard(tables.messages(spark, d), WORDS).withColumn("precision", F.round("precision", 6))


@query
def rule_scorecard_table(spark, d):
    card = rules.rule_scorecard(tables.messages(spark, d), every_word(spark, d))
    return card.withColumn("precision", F.round("precision", 6))


@query
def greedy_rules(spark, d):
    return mining.greedy_rules(tables.messages(spark, d), 5)


@query
def error_terms(spark, d):
    return mining.error_terms(flagged(spark, d), None, 20)


@query
def document_frequency(spark, d):
    return token_ops.document_frequency(tables.texts(spark, d))


@query
def annotation_report(spark, d):
    return evaluate.annotation_report(stub_annotations(spark, d))


@query
def capacity_estimate(spark, d):
    return cost.capacity_estimate(tables.texts(spark, d), 0.1, 0.54, 30)


@query
def review_names(spark, d):
    """The names job: the flagged names to check by hand."""
    found = workflows.review_names(tables.names(spark, d), WORDS)
    return found["review"].select("id", "author")


@query
def review_names_summary(spark, d):
    """The names job: its totals."""
    out = workflows.review_names(tables.names(spark, d), WORDS)["summary"]
    return out.withColumn("flagged_pct", F.round("flagged_pct", 6)).withColumn("clean_pct", F.round("clean_pct", 6))


@query
def evaluate_rules_report(spark, d):
    """The evaluation job: its report."""
    return workflows.evaluate_rules(tables.messages(spark, d), WORDS)["report"]


@query
def train_evaluate(spark, d):
    """Train with cross-validation, save, read again and judge on the stored split: the support of
    each class there, and whether both reports agree."""
    path = scratch_path(spark, "trained")
    options = {"grid": (1.0, 100.0), "k": 3, "max_iter": 50}
    trained = workflows.train_model(tables.messages(spark, d), path, **options)["report"]
    judged = workflows.evaluate_model(tables.messages(spark, d), path)["report"]
    measures = ["precision", "recall", "f1", "support"]
    then = trained.select("class", F.struct(*measures).alias("then"))
    now = judged.select("class", "support", F.struct(*measures).alias("now"))
    return now.join(then, "class").select("class", "support", (F.col("now") == F.col("then")).alias("same"))


@query
def coarse_labels(spark, d):
    """Six labels as four classes."""
    mapping = {0: "clean", 1: "insult", 2: "profanity", 3: "hate", 4: "hate"}
    coarse = evaluate.coarse_label(tables.messages(spark, d), mapping, rest="profanity")
    return coarse.groupBy("coarse").agg(F.count("*").alias("n"), F.count_if("toxic").alias("toxic"))


@query
def evaluate_rules(spark, d):
    """The evaluation job: its samples of false positives and false negatives."""
    found = workflows.evaluate_rules(tables.messages(spark, d), WORDS)
    return found["false_positives"].select(F.lit("fp").alias("kind"), "id").union(
        found["false_negatives"].select(F.lit("fn").alias("kind"), "id")
    )


# --- windows, samples, splits ------------------------------------------------------


@query
def with_context(spark, d):
    c = tables.table(spark, d, "conversations")
    return sampling.with_context(c, 3).select("conv_id", "turn", "context")


@query
def pack_batches(spark, d):
    return sampling.pack_batches(tables.texts(spark, d).select("id"), 100)


@query
def request_batches(spark, d):
    packed = sampling.request_batches(tables.texts(spark, d), 100)
    ids = F.array_join(F.transform("items", lambda i: i["id"].cast("string")), ",")
    return packed.select("bucket", "batch", "n", ids.alias("ids"))


@query
def stratified_split(spark, d):
    return split_messages(spark, d).select("id", "toxic", "split")


@query
def stratified_folds(spark, d):
    return sampling.stratified_folds(tables.messages(spark, d).select("id", "toxic"))


@query
def seeded_sample(spark, d):
    return sampling.seeded_sample(evaluate.error_rows(flagged(spark, d), "fn"), 10).select("id", "label")


@query
def head_rows(spark, d):
    names = rules.rule_flag(tables.names(spark, d), WORDS, "caps", text="author")
    return sampling.head_rows(names.filter("flagged"), 50).select("id", "author")


# --- features and models -------------------------------------------------------------


@query
def tfidf(spark, d):
    return features.tfidf(tables.messages(spark, d)).select(
        "id", "term", "tf", F.round("idf", 6).alias("idf"), F.round("weight", 6).alias("weight")
    )


@query
def tfidf_model(spark, d):
    """The weights of the fitted pipeline, summed per term."""
    m = tables.messages(spark, d)
    model = features.fit_features(m, 3, 0.2)
    sums = model.transform(m).agg(Summarizer.sum(F.col("features")).alias("sums"))
    totals = sums.select(F.posexplode(vector_to_array("sums")).alias("place", "total"))
    vocabulary = spark.createDataFrame(list(enumerate(features.vocabulary_of(model))), "place int, term string")
    return totals.join(vocabulary, "place").select("term", F.round("total", 6).alias("total"))


@query
def fit_logistic(spark, d):
    model = models.fit_logistic(train_rows(spark, d))
    return evaluate.classification_report(models.score(test_rows(spark, d), model), pred="pred")


@query
def fit_logistic_cv(spark, d):
    _, search = models.fit_logistic_cv(train_rows(spark, d), parallelism=8)
    return search


@query
def score(spark, d):
    model = models.fit_logistic(train_rows(spark, d), min_df=3, max_df=0.2)
    return models.score(tables.texts(spark, d), model).select("id", F.round("probability", 6).alias("probability"), "pred")


@query
def score_names(spark, d):
    model = models.fit_logistic(train_rows(spark, d), min_df=3, max_df=0.2, ngram=(1, 3), analyzer="char")
    names = tables.names(spark, d).withColumnRenamed("author", "message")
    return evaluate.flag_summary(models.score(names, model), "pred")


@query
def grid_search(spark, d):
    grid = {"c": (1.0, 10.0), "min_df": (1, 3), "max_df": (0.2, 1.0)}
    return models.grid_search(split_messages(spark, d), grid)


@query
def grid_search_counts(spark, d):
    """The counts model on a grid of smoothing and vocabulary."""
    grid = {"alpha": (0.1, 1.0, 10.0), "min_df": (1, 2, 4)}
    found = models.grid_search(split_messages(spark, d), grid, family="naive_bayes")
    return found.select("alpha", "min_df", *[F.round(m, 6).alias(m) for m in ("accuracy", "precision", "recall", "f1")], "best", "on_edge")


@query
def random_search(spark, d):
    grid = {"c": (0.1, 1.0, 10.0, 100.0), "min_df": (2, 3, 5), "max_df": (0.1, 0.2)}
    return models.grid_search(split_messages(spark, d), grid, sample=4)


@query
def fit_naive_bayes(spark, d):
    """Log odds per term of the fitted counts model."""
    model = models.fit_naive_bayes(tables.messages(spark, d), min_df=3, max_df=0.2)
    return models.weights_table(spark, model).select("term", F.round("weight", 6).alias("log_odds"))


@query
def score_naive_bayes(spark, d):
    """Every text scored by the counts model of the labelled ones."""
    model = models.fit_naive_bayes(tables.messages(spark, d), min_df=3, max_df=0.2)
    return models.score(tables.texts(spark, d), model).select("id", F.round("probability", 6).alias("probability"))


@query
def fit_random_forest(spark, d):
    model = models.fit_random_forest(train_rows(spark, d))
    return evaluate.classification_report(models.score(test_rows(spark, d), model), pred="pred")


@query
def top_terms(spark, d):
    model = models.fit_logistic(train_rows(spark, d), min_df=3, max_df=0.2)
    return models.top_terms(spark, model, 20)


@query
def explain_score(spark, d):
    model = models.fit_logistic(train_rows(spark, d), min_df=3, max_df=0.2)
    return models.explain_score(test_rows(spark, d), model, 5)


@query
def top_terms_counts(spark, d):
    """The terms of the highest and lowest log odds in the counts model."""
    model = models.fit_naive_bayes(tables.messages(spark, d), min_df=3, max_df=0.2)
    return models.top_terms(spark, model, 20).withColumn("weight", F.round("weight", 6))


@query
def explain_counts(spark, d):
    """The terms that add most to the score of each text in the counts model."""
    model = models.fit_naive_bayes(tables.messages(spark, d), min_df=3, max_df=0.2)
    found = models.explain_score(tables.texts(spark, d), model, 5)
    return found.select("id", "place", "term", "tf", F.round("contribution", 6).alias("contribution"))


def slopes(rows: DataFrame, errors: DataFrame, weights: DataFrame, c: float, classes: int) -> DataFrame:
    """(term, df, class, slope): the gradient of the mean loss plus |w|^2 / (2 C n) by weight, from
    the long TF-IDF table, each row's errors (id, errors) and the weights (term, weights), one per
    class. Zero everywhere proves the optimum, since the objective is strictly convex."""
    values = features.tfidf(rows, 3, 0.2)
    n = rows.count()
    each = [F.get("errors", F.lit(k)).alias(f"e{k}") for k in range(classes)]
    # One row per id, as in the long table: rows that share an id are one text there.
    by_id = errors.select("id", *each).groupBy("id").agg(*[F.sum(f"e{k}").alias(f"e{k}") for k in range(classes)])
    losses = [F.sum(F.col("weight") * F.col(f"e{k}")) / n for k in range(classes)]
    loss = values.join(by_id, "id").groupBy("term").agg(F.count("*").alias("df"), F.array(*losses).alias("losses"))
    both = loss.join(weights, "term").select("term", "df", F.posexplode(F.arrays_zip("losses", "weights")).alias("class", "at"))
    slope = F.round(F.abs(F.col("at.losses") + F.col("at.weights") / (c * n)), 5)
    return both.select("term", "df", "class", slope.alias("slope"))


def logistic_slopes(spark: SparkSession, rows: DataFrame, model, c: float) -> DataFrame:
    errors = models.score(rows, model).select("id", F.array(F.col("probability") - F.col("toxic").cast("double")).alias("errors"))
    weights = models.weights_table(spark, model).select("term", F.array("weight").alias("weights"))
    return slopes(rows, errors, weights, c, 1).drop("class")


@query
def fit_logistic_optimum(spark, d):
    train = train_rows(spark, d)
    model = models.fit_logistic(train, min_df=3, max_df=0.2, max_iter=1000, tol=1e-12)
    return logistic_slopes(spark, train, model, 1.0)


@query
def fit_logistic_cv_optimum(spark, d):
    """The refit with the C that cross-validation chose from two."""
    train = train_rows(spark, d)
    model, search = models.fit_logistic_cv(train, grid=(0.1, 10.0), max_iter=1000, tol=1e-12)
    return logistic_slopes(spark, train, model, search.filter("chosen").first().c)


@query
def distil_optimum(spark, d):
    """The small model of machine-annotated rows, at its optimum on exactly those rows."""
    annotated = cost.parse_verdict(tables.replies(rules.rule_flag(tables.texts(spark, d), WORDS)))
    human = tables.messages(spark, d)
    model, _ = models.distil(annotated, human, min_df=3, max_df=0.2, max_iter=1000, tol=1e-12)
    rows = annotated.filter("status = 'OK'").join(human.select("id"), "id", "left_anti")
    return logistic_slopes(spark, rows.select("id", "message", F.col("verdict").alias("toxic")), model, 1.0)


@query
def fit_multiclass_optimum(spark, d):
    """Labels are numbered without gaps: a class without rows would have no finite optimum."""
    train = train_rows(spark, d)
    there = sorted(r.label for r in train.select("label").distinct().collect())  # of a closed set of six
    place = F.array_position(F.array(*[F.lit(x) for x in there]), F.col("label")) - 1
    train = train.withColumn("label", place.cast("int"))
    model = models.fit_multiclass(train, max_iter=1000, tol=1e-12)
    p = models.class_chances(train, model)
    error = F.transform("chances", lambda x, k: x - (F.col("label") == k).cast("double"))
    errors = p.select("id", error.alias("errors"))
    return slopes(train, errors, models.class_weights_table(spark, model), 1.0, len(there))


@query
def fit_multiclass(spark, d):
    model = models.fit_multiclass(train_rows(spark, d), max_iter=30)
    return models.score_classes(test_rows(spark, d), model).groupBy("label", "pred_label").agg(F.count("*").alias("n"))


@query
def distil(spark, d):
    """Train on annotated texts without a label, judge on the labelled ones."""
    annotated = cost.parse_verdict(tables.replies(rules.rule_flag(tables.texts(spark, d), WORDS)))
    _, judged = models.distil(annotated, tables.messages(spark, d), min_df=3, max_df=0.2)
    return evaluate.classification_report(judged, pred="pred")


def stub_classifier(texts: list[str]) -> list[str | None]:
    """A stand-in for a hosted model: a fixed answer for each text."""
    listed = set(WORDS)
    replies = []
    for text in texts:
        words = {w.lower() for w in re.findall(r"\w+", text)}
        if len(text) % 17 == 0:
            replies.append(None)
        elif len(text) % 19 == 0:
            replies.append('{"classification": ')
        else:
            replies.append('{"classification": "%s"}' % ("profane" if words & listed else "clean"))
    return replies


@query
def annotate(spark, d):
    done = cost.annotate(tables.texts(spark, d), stub_classifier, text_cache(spark, d))
    return done.select("id", "status", "verdict", "cache_hit")


# --- streams ---------------------------------------------------------------------------


@query
def stream_moderate(spark, d):
    stream = tables.document_stream(spark, d)
    done = moderation.stream_moderate(stream, WORDS).select("doc_id", "flagged", "censored")
    return moderation.drain(done, "moderated")


@query
def stream_score(spark, d):
    """Scores of a stream by the counts model of the labelled texts."""
    model = models.fit_naive_bayes(tables.messages(spark, d), min_df=3, max_df=0.2)
    stream = tables.document_stream(spark, d).select(F.col("doc_id").alias("id"), F.col("text").alias("message"))
    live = moderation.drain(moderation.stream_score(stream, model).select("id", "probability"), "scored")
    return live.select("id", F.round("probability", 6).alias("probability"))


@query
def stream_flag_rate(spark, d):
    # Flagged once, not in every micro-batch.
    said = settled(rules.rule_flag(tables.texts(spark, d), WORDS).select("id", "lang", "flagged"), "said")
    flags = tables.chat_stream(spark, d, said).select("ts", "lang", "flagged")
    rates = moderation.drain(moderation.stream_flag_rate(flags), "rates")
    return rates.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query
def stream_dedupe(spark, d):
    stream = tables.chat_stream(spark, d, tables.texts(spark, d).select("id", "message"))
    seen = moderation.stream_dedupe(stream, "40 days", text="message").select("text_key")
    return moderation.drain(seen, "distinct")
