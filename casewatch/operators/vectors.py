"""Text vectors: embedding, and exact similarity search."""

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch import config
from casewatch.functions.text import blank_if_missing, join_tags
from casewatch.operators.incremental import pending
from casewatch.operators.inference import infer, succeeded
from casewatch.operators.ranking import top_n_per_key

METADATA = ("drug", "primary_organ_system", "severity", "likely_causal_drug", "category_tags", "receivedate")


def l2_normalize(array):
    """Unit-length vector in double precision; a zero vector stays zero."""
    norm = F.sqrt(F.aggregate(array, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(array, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(F.lit(0.0)))


def vector_metadata(reports):
    """Metadata columns as text, missing values blank, tags joined."""
    out = reports
    for name in METADATA:
        if name not in reports.columns:
            out = out.withColumn(name, F.lit(""))
        elif isinstance(reports.schema[name].dataType, T.ArrayType):
            out = out.withColumn(name, join_tags(F.col(name)))
        else:
            out = out.withColumn(name, blank_if_missing(F.col(name)))
    return out


# ---- embedding


def fit_embedding(corpus, text="document", dim=config.EMBED_DIM):
    """Hashed TF-IDF with unit length. The fitted state is one weight per dimension."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(corpus)


def embed(docs, model):
    """Add `embedding` to docs with a model from fit_embedding."""
    return (
        model.transform(docs)
        .withColumn("embedding", vector_to_array("_unit", "float32"))
        .drop("_words", "_tf", "_tfidf", "_unit")
    )


def embed_with(docs, load, batch_size=config.EMBED_BATCH, id_column="id"):
    """Embedding by a pluggable model; failed batches carry `error`."""
    schema = T.StructType(
        [T.StructField(id_column, T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
    )
    return infer(docs, load, schema, batch_size, id_column)


def build_vectors(reports, store, model=None, text="patient_summary_text", id_column="safetyreportid", load=None):
    """Embedded rows of the reports that the store lacks, to be appended to it; of the store only ids are read.

    model: from fit_embedding; load: a model for embed_with instead. Reports of its failed batches stay pending.
    """
    rows = reports.withColumn(id_column, F.col(id_column).cast("string"))
    todo = pending(rows, store, id_column, "id")
    docs = vector_metadata(todo).select(F.col(id_column).alias("id"), F.col(text).alias("document"), *METADATA)
    if load is None:
        new = embed(docs, model)
    else:
        new = docs.join(succeeded(embed_with(docs.select("id", "document"), load)), "id")
    return new.select(*store.columns)


# ---- search


def _partial_top_k(queries, k, id_column):
    """Best k of each query within one task, kept while streaming over its batches."""
    queries = np.asarray(queries, dtype=np.float64)
    norms = np.linalg.norm(queries, axis=1)
    unit = queries / np.where(norms > 0, norms, 1.0)[:, None]

    def run(batches):
        kept = [None] * len(unit)
        for batch in batches:
            column = batch.column("embedding")
            if batch.num_rows == 0:
                continue
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            matrix = flat.reshape(batch.num_rows, -1)
            lengths = np.linalg.norm(matrix, axis=1)
            ids = np.asarray(batch.column(id_column).to_pylist(), dtype=object)
            # 12 digits: equal vectors get equal similarity whatever block they were in
            sims = np.round(matrix @ unit.T / np.where(lengths > 0, lengths, 1.0)[:, None], 12)
            for q in range(len(unit)):
                s, i = sims[:, q], ids
                if len(s) > k:
                    at_least = np.partition(s, len(s) - k)[len(s) - k]
                    near = s >= at_least
                    s, i = s[near], i[near]
                if kept[q] is not None:
                    s, i = np.concatenate([kept[q][0], s]), np.concatenate([kept[q][1], i])
                best = sorted(zip(-s, i))[:k]
                kept[q] = (np.array([-b[0] for b in best]), np.array([b[1] for b in best], dtype=object))
        rows = [(q, i, float(s)) for q, top in enumerate(kept) if top is not None for s, i in zip(*top)]
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0], pa.int32()),
                    pa.array(cols[1], pa.string()),
                    pa.array(cols[2], pa.float64()),
                ],
                names=["query", "id", "similarity"],
            )

    return run


def filtered(vectors, where):
    """where: condition or {column: value} on metadata, or None for all."""
    if isinstance(where, dict):
        for name, value in where.items():
            vectors = vectors.filter(F.col(name) == value)
        return vectors
    return vectors if where is None else vectors.filter(where)


def search(vectors, queries, k=config.SEARCH_K, where=None, id_column="id"):
    """Exact top k by cosine for each query vector, ties by id.

    queries: local list of vectors, the argument of the call. The stored vectors are read
    once and never shuffled: each task keeps k rows per query and only those move.
    where: condition or {column: value} on metadata, applied before scoring.
    """
    candidates = filtered(vectors, where).filter(F.col("embedding").isNotNull()).select(
        F.col(id_column).cast("string").alias("id"), "embedding"
    )
    partial = candidates.mapInArrow(
        _partial_top_k(queries, k, "id"), "query int, id string, similarity double"
    )
    return top_n_per_key(partial, ["query"], [F.desc("similarity"), F.asc("id")], k, rank="rank")


def hits_with_documents(hits, vectors, columns):
    """Attach stored columns to the few hits."""
    return hits.join(vectors.select("id", *columns), "id")
