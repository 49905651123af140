"""Pluggable batch inference on executors.

A model is a function of one pandas batch returning one pandas batch. Batching, failure
isolation and the declared result schema belong to the engine; the model may be anything
that runs in a Python worker. It is built once per task by `load`.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ERROR = T.StructField("error", T.StringType())
ROWS_PER_RESULT = 4096


def _slices(frames, size):
    """Batches of exactly `size` rows across Arrow batches, except the last of a task."""
    held = None
    for frame in frames:
        if held is not None and len(held):
            frame = pd.concat([held, frame], ignore_index=True)
        whole = len(frame) - len(frame) % size
        for start in range(0, whole, size):
            yield frame.iloc[start : start + size].reset_index(drop=True)
        held = frame.iloc[whole:]
    if held is not None and len(held):
        yield held.reset_index(drop=True)


def _guarded(schema, id_column):
    """A function of (model, named batches) that yields frames of checked answers beside the batches' names.

    A failed batch gives its ids with the reason. What a conversion to Arrow costs is its start, not
    its rows: the types of about ROWS_PER_RESULT rows are checked at once, and by halves where that fails.
    """
    names = [f.name for f in schema.fields]
    types = to_arrow_schema(schema)

    def one_frame(results):
        return pd.DataFrame(np.concatenate([r.to_numpy() for r in results]), columns=names, dtype=object)

    def check_types(results):
        """Refuses values of another type."""
        pa.RecordBatch.from_pandas(results[0] if len(results) == 1 else one_frame(results), types, preserve_index=False)

    def check_ids(result, batch):
        told = result[id_column].tolist()
        if len(set(told)) < len(told) or not set(batch[id_column].tolist()).issuperset(told):
            raise ValueError("answers to ids that were not asked, or repeated ones")

    def answer(model, batch):
        """The answers, their types yet unchecked, or None; and why there are none."""
        try:
            result = model(batch)
            if not (isinstance(result, pd.DataFrame) and result.columns.tolist() == names):
                result = result[names]  # for a small frame this takes longer than all the rest
            result = result.astype(object)
            try:
                check_ids(result, batch)
            except Exception:
                check_types([result])  # this reason comes first
                raise
            return result, None
        except Exception as failure:  # noqa: BLE001 - any model failure is isolated
            return None, failure

    def mistyped(results):
        """For each of the results, why its types are refused, or None."""
        try:
            check_types(results)
            return [None] * len(results)
        except Exception as failure:  # noqa: BLE001
            half = len(results) // 2
            return mistyped(results[:half]) + mistyped(results[half:]) if half else [failure]

    def refused(asked):
        ids = pd.Series(asked, dtype=object)
        return pd.DataFrame({n: ids if n == id_column else None for n in names}, index=ids.index, dtype=object)

    def checked(held):
        given = [result for _, _, result, _ in held if result is not None]
        later = iter(mistyped(given) if given else [])
        failures = [next(later) if failure is None else failure for _, _, _, failure in held]
        results = [r if f is None else refused(asked) for (_, asked, r, _), f in zip(held, failures, strict=True)]
        told = lambda values: np.repeat(np.array(values, dtype=object), [len(r) for r in results])
        frame = one_frame(results)
        frame["error"] = told([None if f is None else f"{type(f).__name__}: {f}" for f in failures])
        return told([name for name, *_ in held]), frame

    def answers(model, batches):
        held, n = [], 0
        for name, batch in batches:
            result, failure = answer(model, batch)
            held.append((name, batch[id_column].tolist(), result, failure))
            n += len(batch)
            if n >= ROWS_PER_RESULT:
                yield checked(held)
                held, n = [], 0
        if held:
            yield checked(held)

    return answers


def infer(df, load, schema, batch_size, id_column="safetyreportid"):
    """Run a model over df and isolate failing batches.

    load: no-argument function returning the model function.
    schema: StructType of the model's output, which includes id_column.
    Answers of a wrong type, to foreign ids or repeated ones fail their batch like an exception.
    A failed batch gives one row per input id with only `error` set; such ids are not done
    and come back in the next run.
    """
    out = T.StructType([*schema.fields, ERROR])
    answers = _guarded(schema, id_column)

    def run(frames):
        for _, frame in answers(load(), ((None, batch) for batch in _slices(frames, batch_size))):
            yield frame

    return df.mapInPandas(run, out)


def infer_batches(batches, load, schema, id_column="id"):
    """Run a model once per batch of make_batches: its batch_id, answers and `error`, as in infer."""
    out = T.StructType([T.StructField("batch_id", T.StringType()), *schema.fields, ERROR])
    types, answers = to_arrow_schema(out), _guarded(schema, id_column)

    def items_of(tables):
        for table in tables:
            for batch_id, items in zip(table.column(0), table.column(1), strict=True):
                yield batch_id.as_py(), pa.RecordBatch.from_struct_array(items.values).to_pandas()

    def run(tables):
        for batch_ids, frame in answers(load(), items_of(tables)):
            frame.insert(0, "batch_id", batch_ids)
            yield pa.RecordBatch.from_pandas(frame, types, preserve_index=False)

    return batches.select("batch_id", "items").mapInArrow(run, out)


def succeeded(results):
    return results.filter("error is null").drop("error")


def failed(results):
    return results.filter("error is not null")
