"""Anomalies to context, explanations and coverage scores."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch import config
from casewatch.functions import ids
from casewatch.functions.text import parse_yyyymmdd
from casewatch.operators.categorize import with_rule_labels
from casewatch.operators.context import claim_text, context_bundle, context_top_n, stats_block
from casewatch.operators.evaluate import faithfulness
from casewatch.operators.explain import explain_extractive
from casewatch.operators.flatten import flatten_reports
from casewatch.operators.inference import infer
from casewatch.sources.workspace import staged

FIGURES = ("date", "count", "expected_count", "zscore")
# What a model that explains or judges must return for every entity_id it is given with a `text`.
EXPLANATION = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("dominant_organ_systems", T.ArrayType(T.StringType())),
        T.StructField("dominant_severity", T.StringType()),
        T.StructField("notable_pattern", T.StringType()),
        T.StructField("confidence_caveat", T.StringType()),
    ]
)
JUDGEMENT = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("justification", T.StringType()),
    ]
)


def labelled_context(
    anomalies,
    named_reports,
    rules=None,
    n=config.CONTEXT_REPORTS,
    days=config.CONTEXT_DAYS,
):
    """The nearest reports of every anomaly, flattened and labelled.

    anomalies: drug and FIGURES, staged here because it is read twice.
    named_reports: raw reports with the tracked drug they were found by.
    Only reports of the wanted days are flattened, after the limit per anomaly.
    """
    wanted = staged(anomalies.select("drug", *FIGURES), "anomalies")
    dated = named_reports.withColumn("received", parse_yyyymmdd(F.col("receivedate")))
    nearest = context_top_n(wanted, dated, n, days)
    return with_rule_labels(flatten_reports(nearest, keep=(*FIGURES, "position", "distance")), rules)


def labelled_nearest(nearest, reports, rules=None):
    """The same from context_top_n rows of narrow mentions and the raw reports they name.

    Only ids, drugs and days travel through the ranking; the nested reports join the few chosen rows.
    """
    chosen = nearest.select("safetyreportid", "drug", *FIGURES, "position", "distance").join(reports, "safetyreportid")
    return with_rule_labels(flatten_reports(chosen, keep=(*FIGURES, "position", "distance")), rules)


def to_explain(context, days=config.CONTEXT_DAYS):
    """entity_id, drug, FIGURES, n_context_reports and the text a model explains; pass a staged context."""
    figures = context.filter("position = 1").select("drug", *FIGURES)
    day = ids.timestamp_text(F.col("date"))
    return figures.join(context_bundle(context), ["drug", "date"]).select(
        ids.entity_id(F.col("drug"), day).alias("entity_id"),
        "drug",
        *FIGURES,
        "n_context_reports",
        stats_block(days).alias("text"),
    )


def explain_with(asked, load, batch_size=1):
    """Rows of a staged to_explain with a model's answers, or `error` for those of a failed batch."""
    answers = infer(asked.select("entity_id", "text"), load, EXPLANATION, batch_size, "entity_id")
    return asked.drop("text").join(answers, "entity_id")


def to_judge(explanations, bundles):
    """entity_id, drug, date and the text a model judges: numbered sources, then the claim (a fixed format)."""
    text = F.concat(F.lit("SOURCES:\n"), F.col("context"), F.lit("\n\nCLAIM:\n"), claim_text())
    joined = explanations.join(bundles.select("drug", "date", "context"), ["drug", "date"])
    entity = ids.entity_id(F.col("drug"), F.col("date").cast("string"))
    return joined.select(entity.alias("entity_id"), "drug", "date", text.alias("text"))


def judge_with(asked, load, batch_size=1):
    """Rows of a staged to_judge with a model's scores, or `error` for those of a failed batch."""
    answers = infer(asked.select("entity_id", "text"), load, JUDGEMENT, batch_size, "entity_id")
    return asked.drop("text").join(answers, "entity_id")


def explain_and_score(context):
    """(explanations, scores) from labelled context; pass a staged context."""
    explanations = explain_extractive(context)
    scores = faithfulness(explanations, context_bundle(context), claim_text())
    return explanations, scores
