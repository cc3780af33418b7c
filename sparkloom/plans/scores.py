"""Scores, thresholds, classes and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import boosting, models, scoring
from ..shared import written
from .registry import query

_RULES = scoring.CurriculumRules(
    ultra=("the ", "qui "), strong=("tion", "ver"), keywords=("ing", "ung", "ment", "heit", "and", "que"), negative=("die ", "der ", "und "),
    code_patterns=(r"([A-Z][a-z]{2,7})[ \-]([a-z]{3,4}),", r"([A-Z]{2,8})\.([0-9]{3,4})"), credit_patterns=(r"([0-9]+)", r"\(([0-9]+)\)"), degree_patterns=(r"m\.?s\.?", r"b\.?a\.?", "ent"),
)

_SCORE_SQL = r"""WITH d AS (SELECT doc_id, text, lower(text) AS low FROM documents),
codes AS (
  SELECT doc_id, len(list_distinct(list_concat(
    list_transform(list_zip(regexp_extract_all(text, '([A-Z][a-z]{2,7})[ \-]([a-z]{3,4}),', 1), regexp_extract_all(text, '([A-Z][a-z]{2,7})[ \-]([a-z]{3,4}),', 2)), lambda x: x[1] || ' ' || x[2]),
    list_transform(list_filter(list_zip(regexp_extract_all(text, '([A-Z]{2,8})\.([0-9]{3,4})', 1), regexp_extract_all(text, '([A-Z]{2,8})\.([0-9]{3,4})', 2)), lambda x: length(x[1]) >= 3 OR x[1] IN ('CS', 'ED')), lambda x: x[1] || ' ' || x[2]))))::INT AS course_count FROM d),
parts AS (
  SELECT doc_id, course_count,
    (contains(low, 'the ')::INT + contains(low, 'qui ')::INT) * 40 + (contains(low, 'tion')::INT + contains(low, 'ver')::INT) * 25 AS phrases,
    (len(regexp_extract_all(low, '([0-9]+)')) + len(regexp_extract_all(low, '\(([0-9]+)\)')))::INT AS credit_mentions,
    (contains(low, 'ing')::INT + contains(low, 'ung')::INT + contains(low, 'ment')::INT + contains(low, 'heit')::INT + contains(low, 'and')::INT + contains(low, 'que')::INT)::INT AS keyword_matches,
    regexp_matches(low, 'm\.?s\.?')::INT + regexp_matches(low, 'b\.?a\.?')::INT + regexp_matches(low, 'ent')::INT AS degrees,
    contains(low, 'die ')::INT + contains(low, 'der ')::INT + contains(low, 'und ')::INT AS negative
  FROM d JOIN codes USING (doc_id)),
scored AS (
  SELECT doc_id, course_count, credit_mentions, keyword_matches,
    (phrases + CASE WHEN course_count >= 10 THEN 50 WHEN course_count >= 5 THEN 35 WHEN course_count >= 2 THEN 20 ELSE 0 END
     + CASE WHEN credit_mentions >= 5 THEN 25 WHEN credit_mentions >= 2 THEN 15 ELSE 0 END + CASE WHEN keyword_matches >= 5 THEN 20 WHEN keyword_matches >= 3 THEN 10 ELSE 0 END
     + CASE WHEN degrees >= 2 THEN 10 ELSE 0 END - CASE WHEN negative >= 3 THEN 15 ELSE 0 END)::INT AS score,
    CASE WHEN course_count >= 8 THEN 40 WHEN course_count >= 4 THEN 50 ELSE 60 END AS threshold FROM parts)"""


@query(_SCORE_SQL + """
SELECT *, score >= threshold AS is_curriculum, CASE WHEN score >= 80 THEN 'Very High' WHEN score >= 60 THEN 'High' WHEN score >= 40 THEN 'Medium' WHEN score >= 20 THEN 'Low' ELSE 'Very Low' END AS level FROM scored""")
def curriculum_score(t):
    """The page score with words that the documents hold; its rule lists are parameters."""
    out = scoring.curriculum_score(t("documents").select("doc_id", "text"), "text", rules=_RULES)
    return out.select("doc_id", "course_count", "credit_mentions", "keyword_matches", "score", "threshold", "is_curriculum", "level")


@query(_SCORE_SQL + " SELECT round(count(*) FILTER (score >= threshold) / greatest(count(*), 1) * 100, 4) AS curriculum_rate, count(*) AS n FROM scored")
def curriculum_rate(t):
    out = scoring.curriculum_score(t("documents").select("doc_id", "text"), "text", rules=_RULES)
    return out.agg(F.round(F.count_if("is_curriculum") / F.greatest(F.count("*"), F.lit(1)) * 100, 4).alias("curriculum_rate"), F.count("*").alias("n"))


@query("""SELECT p_partkey, ['CS ' || (200 + p_size), 'MATH ' || (100 + p_size), 'STAT ' || (300 + p_size), 'XYZ ' || (400 + p_size)] AS codes, ['cs_data', 'math_stat'] AS areas FROM part""")
def course_codes(t):
    n = F.col("p_size")
    cell = F.concat_ws(" ", F.concat(F.lit("MATH "), 100 + n), F.concat(F.lit("or CS-"), 200 + n), F.lit("not AB 123, MATH"), F.concat(100 + n), F.concat(F.lit("STAT."), 300 + n), F.concat(F.lit("XYZ:"), 400 + n))
    rows = t("part").select("p_partkey", F.array_sort(scoring.course_codes(cell)).alias("codes"))
    return rows.withColumn("areas", scoring.subject_areas(F.col("codes")))


def _scored(t):
    rows = t("documents").join(t("labels"), "doc_id")
    return rows.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 1000 / 1000 * 0.5 + F.col("quality") * 0.4).alias("score"), F.col("quality").alias("label"))


@query()
def threshold_sweep(t):
    out = scoring.threshold_sweep(_scored(t), scoring.threshold_grid())
    return out.select("threshold", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


_SWEEP_SQL = """WITH s AS (SELECT doc_id, (length(text) % 1000) / 1000.0::DOUBLE * 0.5 + quality * 0.4 AS score, quality AS label FROM documents JOIN labels USING (doc_id)),
grid AS (SELECT unnest(generate_series(10, 89)) / 100.0::DOUBLE AS threshold),
c AS (SELECT threshold, count(*) FILTER (score >= threshold AND label = 1) AS tp, count(*) FILTER (score >= threshold AND label = 0) AS fp, count(*) FILTER (score < threshold AND label = 1) AS fn, count(*) FILTER (score < threshold AND label = 0) AS tn FROM grid, s GROUP BY threshold),
r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS "precision", CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall, (tp + tn) / (tp + fp + fn + tn) AS accuracy FROM c)"""


def _by_length(t):
    rows = t("documents").join(t("labels"), "doc_id")
    return rows.select("doc_id", ((F.length("text") % 1000) / F.lit(1000.0) * 0.5 + F.col("quality") * 0.4).alias("score"), F.col("quality").alias("label"))


@query(_SWEEP_SQL + """ SELECT threshold, tp, fp, fn, tn, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(accuracy, 6) AS accuracy,
  round(CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0.0 END, 6) AS f1 FROM r""")
def threshold_sweep_lengths(t):
    out = scoring.threshold_sweep(_by_length(t), scoring.threshold_grid())
    return out.select("threshold", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


@query(_SWEEP_SQL + """ SELECT threshold, round("precision", 6) AS "precision", round(recall, 6) AS recall FROM r WHERE recall >= 0.9 ORDER BY "precision" DESC, threshold LIMIT 1""")
def best_threshold(t):
    out = scoring.best_threshold(scoring.threshold_sweep(_by_length(t), scoring.threshold_grid()), 0.9)
    return out.select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


_PREDICTED_SQL = "p AS (SELECT doc_id, lang, quality AS label, (length(text) > 1000)::INT AS prediction FROM documents JOIN labels USING (doc_id))"


def _predicted(t):
    rows = t("documents").join(t("labels"), "doc_id")
    return rows.select("doc_id", "lang", F.col("quality").alias("label"), (F.length("text") > 1000).cast("int").alias("prediction"))


@query(f"""WITH {_PREDICTED_SQL}, k AS (SELECT unnest([0, 1]) AS class),
c AS (SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER (prediction = class) AS said, count(*) FILTER (label = class AND prediction = class) AS tp FROM k, p GROUP BY class),
r AS (SELECT *, CASE WHEN said > 0 THEN tp / said ELSE 0.0 END AS "precision", CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM c)
SELECT class, support::BIGINT AS support, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(CASE WHEN "precision" + recall > 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0 END, 6) AS f1 FROM r""")
def class_report(t):
    out = scoring.class_report(_predicted(t), "prediction", "label")
    return out.select("class", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(f"WITH {_PREDICTED_SQL} SELECT lang, count(*) FILTER (prediction = 1 AND label = 1) AS tp, count(*) FILTER (prediction = 1 AND label = 0) AS fp, count(*) FILTER (prediction = 0 AND label = 1) AS fn, count(*) FILTER (prediction = 0 AND label = 0) AS tn FROM p GROUP BY lang")
def confusion_by_lang(t):
    return scoring.confusion(_predicted(t), "prediction", "label", ["lang"]).select("lang", "tp", "fp", "fn", "tn")


@query("SELECT quality AS label, count(*) AS n, round(count(*) / (SELECT count(*) FROM labels) * 100, 4) AS pct FROM labels GROUP BY quality")
def class_balance(t):
    return scoring.class_balance(t("labels"), "quality")


@query(f"""WITH {_PREDICTED_SQL}, f AS (SELECT doc_id % 5 AS fold, avg((prediction = label)::INT) AS accuracy FROM p GROUP BY 1)
SELECT round(avg(accuracy), 8) AS mean_accuracy, round(stddev_pop(accuracy), 8) AS std_accuracy FROM f""")
def cv_fold_accuracy(t):
    rows = _predicted(t).withColumn("fold", F.col("doc_id") % 5)
    _, one = scoring.fold_accuracy(rows, "fold", "prediction", "label")
    return one.select(F.round("mean_accuracy", 8).alias("mean_accuracy"), F.round("std_accuracy", 8).alias("std_accuracy"))


@query("""SELECT doc_id, CASE WHEN p > 0.9 THEN 'very high' WHEN p > 0.78 THEN 'high' WHEN p < 0.3 THEN 'low' ELSE 'medium' END AS band, CASE WHEN p < 0.6 THEN 'review' ELSE 'accept' END AS recommendation
FROM (SELECT doc_id, (doc_id % 101) / 100.0::DOUBLE AS p FROM documents)""")
def confidence_bands(t):
    rows = t("documents").select("doc_id", ((F.col("doc_id") % 101) / F.lit(100.0)).alias("p"))
    return rows.select("doc_id", clean.confidence_band("p").alias("band"), clean.recommendation("p").alias("recommendation"))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_valuable, CASE doc_id % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'no_candidates' WHEN 2 THEN 'unparsable' ELSE 'ok' END AS state FROM documents""")
def answer_labels(t):
    k3, k4 = F.col("doc_id") % 3, F.col("doc_id") % 4
    label = clean.relevance(F.when(k3 == 0, "Relevant.").when(k3 == 1, "it is IRRELEVANT").otherwise("maybe"))
    state = clean.answer_state(F.when(k4 == 0, "Error: 500").when(k4 == 1, None).when(k4 == 2, "{broken").otherwise('{"a": 1}'))
    return t("documents").select("doc_id", label.alias("is_valuable"), state.alias("state"))


@query()
def tfidf_classify(t):
    """Train on four fifths of the labelled documents, choose a threshold there, score the rest."""
    train, test = models.split(written(_labelled(t)), F.col("doc_id"))
    model = models.fit(train, "logistic", maxIter=20)
    at = models.choose_threshold(models.scored(model, train).select("score", "label"))
    out = models.classify(model, test, "text", at)
    return out.select("doc_id", "label", "is_valuable", F.round("confidence", 6).alias("confidence"), "band", F.round("threshold_used", 6).alias("threshold_used"), "method")


@query()
def gbt_classify(t):
    """200 boosted trees of depth 7 with L1 and L2 terms on 12,000 terms: four fifths of each label train, the rest is scored."""
    rows = written(scoring.stratified_folds(_labelled(t), "label", "doc_id"))
    train, test = rows.where("fold > 0").drop("fold"), rows.where("fold = 0").drop("fold")
    model = models.boosted(train, "doc_id")
    at = models.choose_threshold(models.boosted_scores(model, train).select("score", "label"))
    out = models.classify(model, test, "text", at)
    return out.select("doc_id", "label", "is_valuable", F.round("confidence", 6).alias("confidence"), "band", F.round("threshold_used", 6).alias("threshold_used"), "method")


def _labelled(t):
    return models.labelled(t("documents").join(t("labels"), "doc_id"), "text", "quality").select("doc_id", "text", "label")


@query()
def tfidf_vectors(t):
    """The weights of the 12,000 terms in every document, those that aren't zero."""
    docs = written(t("documents").select("doc_id", models.classifier_text("text").alias("text")).where("text <> ''"))  # read three times
    vectors = boosting.sparse(models.tfidf(docs).transform(docs), "features", ["doc_id"])
    each = vectors.select("doc_id", F.explode(F.arrays_zip("index", "value")).alias("e")).select("doc_id", F.col("e.index").alias("term_no"), F.col("e.value").alias("weight"))
    return each.where("weight <> 0").withColumn("weight", F.round("weight", 6))


@query()
def cv_accuracy(t):
    """Accuracy of models fitted anew for each of five folds."""
    return models.cross_validated(_labelled(t), "doc_id", "logistic", maxIter=20).select("fold", F.round("accuracy", 6).alias("accuracy"))
