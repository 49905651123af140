"""Categorisation of report texts: built-in keyword rules and the pluggable model form."""

import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from casewatch import config, schemas
from casewatch.functions.severity import ladder_of, severity_by_ladder
from casewatch.operators.inference import infer

OTHER = "other/unclassified"
# Where a summary sentence states what.
STATED = r"Seriousness: ([^.]*)\."
PRODUCT = r"patient taking (.*?)(?:,| experienced)"
TAKING = r"patient taking (.*?) experienced"

# Keyword stems of the built-in rules, per organ system.
CLINICAL_RULES = {
    "cardiovascular": ("cardi", "hypertens", "hypotens", "palpitation", "tachy", "brady", "infarct", "angina"),
    "neurological": ("headache", "dizz", "seizure", "tremor", "neuropath", "paraesthesia", "stroke"),
    "gastrointestinal": ("nausea", "vomit", "diarrh", "abdominal", "gastr", "constipat", "dyspepsia"),
    "dermatological": ("rash", "prurit", "urticaria", "dermat", "epidermal", "erythema", "skin"),
    "psychiatric": ("depress", "anxiety", "insomnia", "suicid", "hallucinat", "agitat", "psych"),
    "hepatic": ("hepat", "liver", "jaundice", "bilirubin", "transaminase"),
    "renal": ("renal", "kidney", "nephr", "creatinine", "dialysis"),
    "hematologic": ("anaemia", "anemia", "thrombocyt", "neutropen", "haemorrhag", "bleeding", "leukopen"),
    "respiratory": ("dyspn", "cough", "asthma", "pneumon", "respirat", "bronch"),
    "musculoskeletal": ("myalgia", "arthralgia", "muscle", "rhabdomyol", "back pain", "fracture"),
    "endocrine/metabolic": ("hypoglyc", "hyperglyc", "lactic acidosis", "thyroid", "diabet", "hyponatr"),
}


def _hits(text, words):
    hits = F.lit(0)
    for word in words:
        hits = hits + F.contains(text, F.lit(word)).cast("int")
    return hits


def organ_system(text, rules=None):
    """The system with most keyword hits in the whole text; rule order breaks ties."""
    rules = CLINICAL_RULES if rules is None else rules
    lowered = F.lower(text)
    scored = [
        F.struct(_hits(lowered, words).alias("hits"), F.lit(-i).alias("o"), F.lit(name).alias("name"))
        for i, (name, words) in enumerate(rules.items())
    ]
    best = F.array_max(F.array(*scored))
    return F.when(best["hits"] > 0, best["name"]).otherwise(F.lit(OTHER))


def stated_seriousness(text):
    return F.regexp_extract(text, STATED, 1)


def first_product(text):
    return F.regexp_extract(text, PRODUCT, 1)


def label_columns(reports, text="patient_summary_text", rules=None):
    """The label fields of reports, as named columns.

    Organ keywords are searched in the reactions and drugs are read from drugs_involved where the
    rows have these columns, so that a product's name is no symptom; bare texts are searched whole.
    """
    sentence = F.col(text)
    severity = severity_by_ladder(stated_seriousness(sentence))
    organ = organ_system(F.col("reactions") if "reactions" in reports.columns else sentence, rules)
    if "drugs_involved" in reports.columns:
        products = F.split("drugs_involved", "; ")
        cause, several = F.coalesce(F.nullif(F.get(products, 0), F.lit("")), first_product(sentence)), F.size(products) > 1
    else:
        several = F.contains(F.regexp_extract(sentence, TAKING, 1), F.lit(","))
        cause = first_product(sentence)
    return {
        "primary_organ_system": organ,
        "severity": severity,
        "likely_causal_drug": cause,
        "category_tags": F.array_compact(
            F.array(
                F.lit("known_side_effect"),
                F.when(several, F.lit("drug_interaction_suspected")),
                F.when(severity == "fatal", F.lit("fatal_outcome")),
            )
        ),
        "rationale": F.concat(F.lit("Keyword rules matched "), organ, F.lit(".")),
    }


def categorize_rules(reports, rules=None, text="patient_summary_text", id_column="safetyreportid"):
    """Rule-based label rows, all inside the JVM."""
    fields = label_columns(reports, text, rules)
    return reports.select(
        F.col(id_column).cast("string").alias("id"), *[c.alias(n) for n, c in fields.items()]
    )


def with_rule_labels(reports, rules=None, text="patient_summary_text"):
    """Reports with their rule labels beside them, without a join."""
    return reports.withColumns(label_columns(reports, text, rules))


def _automaton(rules):
    """All keywords of all systems in one automaton; a word's value is its place in (system, word) order."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, (system, word) in enumerate((s, w) for s, words in enumerate(rules.values()) for w in words):
        held = found.get(word, ())
        found.add_word(word, (*held, (i, system)))
    found.make_automaton()
    return found


def keyword_model(rules=None, text="patient_summary_text", id_column="safetyreportid"):
    """The rules of label_columns() as a pandas model: an example for, and a check of, `infer`.

    A text is searched for all keywords at once; missing texts count as empty.
    """
    rules = CLINICAL_RULES if rules is None else rules
    names, fields = [*rules, OTHER], pd.Index(schemas.LABEL_ROW.names)

    def load():
        automaton = _automaton(rules)
        stated, taking, product = (re.compile(p) for p in (STATED, TAKING, PRODUCT))

        def organ(value):
            hits = [0] * len(rules)
            for _, system in {hit for _, found in automaton.iter(value.lower()) for hit in found}:
                hits[system] += 1
            best = max(hits, default=0)
            return names[hits.index(best) if best else -1]

        def first_group(pattern, value):
            match = pattern.search(value)
            return match[1] if match else ""

        def model(batch: pd.DataFrame) -> pd.DataFrame:
            # Batches are small: one array in and one out, as each column of a frame takes longer than its values.
            given = dict(zip(batch.columns, batch.to_numpy(dtype=object).T.tolist()))
            texts = [t if isinstance(t, str) else "" for t in given[text]]
            ids = given[id_column]
            if not all(type(i) is str for i in ids):
                ids = batch[id_column].astype(str).tolist()
            organs = [organ(t) if isinstance(t, str) else OTHER for t in given.get("reactions", texts)]
            severities = [ladder_of(first_group(stated, t)) for t in texts]
            if "drugs_involved" in given:
                products = [d.split("; ") if isinstance(d, str) else [] for d in given["drugs_involved"]]
                causes = [(p[0] if p else "") or first_group(product, t) for p, t in zip(products, texts)]
                several = [len(p) > 1 for p in products]
            else:
                causes = [first_group(product, t) for t in texts]
                several = ["," in first_group(taking, t) for t in texts]
            tags = [
                ["known_side_effect"] + ["drug_interaction_suspected"] * many + ["fatal_outcome"] * (grade == "fatal")
                for many, grade in zip(several, severities)
            ]
            rationales = [f"Keyword rules matched {o}." for o in organs]
            answers = np.empty((len(batch), len(fields)), dtype=object)
            for answer, row in zip(answers, zip(ids, organs, severities, causes, tags, rationales)):
                answer[:] = row
            return pd.DataFrame(answers, columns=fields, dtype=object)

        return model

    return load


def categorize(reports, load, batch_size=config.CATEGORIZE_BATCH, id_column="safetyreportid"):
    """Labels from a pluggable model; failed batches carry `error`."""
    rows = reports.withColumnRenamed(id_column, "id") if id_column != "id" else reports
    return infer(rows, load, schemas.LABEL_ROW, batch_size, id_column="id")
