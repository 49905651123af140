"""Declared schemas of every table that is read from or written to files."""

from pyspark.sql import types as T


def _strings(*names):
    return [T.StructField(n, T.StringType()) for n in names]


RAW_REPORT = T.StructType(
    _strings(
        "safetyreportid",
        "receivedate",
        "serious",
        "seriousnessdeath",
        "seriousnesshospitalization",
        "seriousnesslifethreatening",
        "seriousnessdisabling",
    )
    + [
        T.StructField(
            "patient",
            T.StructType(
                _strings("patientonsetage", "patientsex")
                + [
                    T.StructField(
                        "reaction",
                        T.ArrayType(T.StructType(_strings("reactionmeddrapt"))),
                    ),
                    T.StructField(
                        "drug",
                        T.ArrayType(T.StructType(_strings("medicinalproduct"))),
                    ),
                ]
            ),
        )
    ]
)
REPORT_PAGE = T.StructType([T.StructField("results", T.ArrayType(RAW_REPORT))])

DAILY_COUNTS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("count", T.LongType()),
        T.StructField("drug", T.StringType()),
    ]
)

PATIENT_SUMMARIES = T.StructType(
    _strings(
        "safetyreportid",
        "drug",
        "receivedate",
        "patient_sex",
        "patient_age",
        "reactions",
        "drugs_involved",
        "seriousness_flags",
        "patient_summary_text",
    )
)

LABEL_ROW = T.StructType(
    _strings("id", "primary_organ_system", "severity", "likely_causal_drug")
    + [T.StructField("category_tags", T.ArrayType(T.StringType()))]
    + _strings("rationale")
)
LABEL_BATCH = T.StructType([T.StructField("reports", T.ArrayType(LABEL_ROW))])

VECTORS = T.StructType(
    _strings("id")
    + [T.StructField("embedding", T.ArrayType(T.FloatType()))]
    + _strings(
        "document",
        "drug",
        "primary_organ_system",
        "severity",
        "likely_causal_drug",
        "category_tags",
        "receivedate",
    )
)

ANOMALIES = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("count", T.LongType()),
        T.StructField("drug", T.StringType()),
        T.StructField("expected_count", T.DoubleType()),
        T.StructField("residual", T.DoubleType()),
        T.StructField("zscore", T.DoubleType()),
        T.StructField("is_anomaly_zscore", T.BooleanType()),
        T.StructField("isolation_forest_score", T.DoubleType()),
        T.StructField("is_anomaly_isoforest", T.BooleanType()),
        T.StructField("is_anomaly_high_confidence", T.BooleanType()),
    ]
)

EXPLANATIONS = T.StructType(
    _strings("drug", "date")
    + [
        T.StructField("count", T.LongType()),
        T.StructField("expected_count", T.DoubleType()),
        T.StructField("zscore", T.DoubleType()),
        T.StructField("n_context_reports", T.LongType()),
    ]
    + _strings("summary")
    + [T.StructField("dominant_organ_systems", T.ArrayType(T.StringType()))]
    + _strings("dominant_severity", "notable_pattern", "confidence_caveat")
)

FAITHFULNESS = T.StructType(
    _strings("drug", "date")
    + [T.StructField("score", T.DoubleType())]
    + _strings("justification")
)

LABELING_TEMPLATE = T.StructType(
    _strings(
        "safetyreportid",
        "drug",
        "patient_summary_text",
        "predicted_organ_system",
        "predicted_severity",
        "true_organ_system",
        "true_severity",
        "notes",
    )
)

GROUND_TRUTH = T.StructType(
    _strings("drug", "date", "pattern", "is_real_signal", "notes", "fda_reference_url")
)
