"""Label templates, accuracy, precision, and claim coverage."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch import config
from casewatch.functions.numbers import percent
from casewatch.functions.text import non_blank, normalized, stripped
from casewatch.operators.ranking import stratified_even


def labeling_template(categorized, total=config.LABEL_SAMPLE, seed=config.SEED):
    """An even per-drug sample with predictions and blank truth columns."""
    return (
        stratified_even(categorized, total, seed)
        .select("safetyreportid", "drug", "patient_summary_text", "primary_organ_system", "severity")
        .withColumnsRenamed(
            {"primary_organ_system": "predicted_organ_system", "severity": "predicted_severity"}
        )
        .withColumns({c: F.lit("") for c in ("true_organ_system", "true_severity", "notes")})
    )


def _same(true, predicted):
    return normalized(F.col(true)) == normalized(F.col(predicted))


def labelled(template):
    return template.filter(non_blank(F.col("true_organ_system")))


def categorization_accuracy(template):
    """One row: sample size, both accuracies, mismatches.

    Severity accuracy counts only rows where the severity was labelled too; null if none.
    """
    organ = _same("true_organ_system", "predicted_organ_system")
    severity = F.when(non_blank(F.col("true_severity")), _same("true_severity", "predicted_severity"))
    return labelled(template).agg(
        F.count("*").alias("n_labelled"),
        F.avg(organ.cast("double")).alias("organ_accuracy"),
        F.avg(severity.cast("double")).alias("severity_accuracy"),
        F.count_if(~organ).cast("bigint").alias("n_mismatches"),
    )


def label_mismatches(template, n=config.MISMATCHES_SHOWN):
    """The first n wrong organ systems by id."""
    return (
        labelled(template)
        .filter(~_same("true_organ_system", "predicted_organ_system"))
        .select("safetyreportid", "predicted_organ_system", "true_organ_system")
        .orderBy("safetyreportid")
        .limit(n)
    )


def ground_truth_template(explanations, seeds=None):
    """Explanations with truth columns, blank but for the seeded (drug, date) rows.

    seeds: a literal argument of known rows, {(drug, date): {column: text}}, joined as a small table.
    """
    seeds = seeds or {}
    fields = ("is_real_signal", "fda_reference_url", "notes")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("drug", "date", *[f"_{f}" for f in fields])])
    known = explanations.sparkSession.createDataFrame(
        [(drug, date, *[v.get(f, "") for f in fields]) for (drug, date), v in seeds.items()], schema
    )
    joined = explanations.withColumn("date", F.col("date").cast("string")).join(
        known, ["drug", "date"], "left"
    )
    return joined.withColumns({f: F.coalesce(F.col(f"_{f}"), F.lit("")) for f in fields}).drop(
        *[f"_{f}" for f in fields]
    )


def anomaly_precision(template):
    """One row: flagged, labelled Y or N, confirmed, precision (null without labels)."""
    mark = F.upper(stripped(F.col("is_real_signal")))
    judged = mark.isin("Y", "N")
    return template.agg(
        F.count("*").alias("n_flagged"),
        F.count_if(judged).cast("bigint").alias("n_labelled"),
        F.count_if(mark == "Y").cast("bigint").alias("n_confirmed"),
    ).withColumn(
        "precision", F.when(F.col("n_labelled") > 0, F.col("n_confirmed") / F.col("n_labelled"))
    )


def _terms(text):
    words = F.split(F.lower(text), r"[^a-z0-9]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def claim_coverage(claim, sources):
    """Share of the claim's distinct words that occur in the sources: a lexical score of its
    own, not the score of a model acting as judge."""
    wanted = _terms(claim)
    found = F.array_intersect(wanted, _terms(F.array_join(sources, " ")))
    return F.when(F.size(wanted) > 0, F.size(found) / F.size(wanted)).otherwise(F.lit(0.0))


def faithfulness(explanations, bundles, claim):
    """Score of every explanation against its own context, joined on (drug, date)."""
    joined = explanations.join(bundles.select("drug", "date", "texts"), ["drug", "date"])
    covered = claim_coverage(claim, F.col("texts"))
    return joined.select(
        "drug",
        "date",
        covered.alias("score"),
        F.concat(F.lit("Words of the claim found in the sources: "), percent(covered)).alias("justification"),
    )


def score_summary(scores):
    return scores.agg(F.avg("score").alias("mean_score"), F.count("*").alias("n"))


def report_lines(accuracy, mismatches):
    """The accuracy report as numbered lines, a fixed format; the mismatch list is already limited."""
    head = accuracy.select(
        F.posexplode(
            F.array(
                F.lit("Categorization Accuracy Report"),
                F.lit("=" * 40),
                F.concat(F.lit("Labeled sample size: "), F.col("n_labelled").cast("string")),
                F.concat(F.lit("Organ system accuracy: "), percent(F.col("organ_accuracy"))),
                F.concat(
                    F.lit("Severity accuracy: "),
                    F.coalesce(percent(F.col("severity_accuracy")), F.lit("nan%")),
                ),
                F.lit(""),
                F.concat(F.lit("Mismatches ("), F.col("n_mismatches").cast("string"), F.lit("):")),
            )
        ).alias("line_no", "line")
    )
    listed = mismatches.select(
        F.concat(
            F.lit("  - "),
            F.col("safetyreportid"),
            F.lit(": predicted='"),
            F.col("predicted_organ_system"),
            F.lit("' true='"),
            F.col("true_organ_system"),
            F.lit("'"),
        ).alias("line")
    ).agg(F.array_sort(F.collect_list("line")).alias("lines"))
    body = listed.select(F.posexplode("lines").alias("i", "line")).select(
        (F.col("i") + 7).alias("line_no"), "line"
    )
    return head.unionByName(body)


def precision_lines(precision):
    """The precision report as numbered lines, a fixed format."""
    return precision.select(
        F.posexplode(
            F.array(
                F.lit("Anomaly Precision Report"),
                F.lit("=" * 40),
                F.format_string("Labeled anomalies: %d / %d total flagged", "n_labelled", "n_flagged"),
                F.format_string("Confirmed real signals: %d", "n_confirmed"),
                F.concat(F.lit("Precision: "), F.coalesce(percent(F.col("precision")), F.lit("nan%"))),
                F.lit(""),
                F.lit("Precision of the flagged days only; days that were not flagged are not judged."),
            )
        ).alias("line_no", "line")
    )
