"""Model slot: batched predictions inside Arrow-fed Python workers.

The model itself is the user's: any picklable callable that maps a list of
strings to a list of strings of the same length. Options of a run (beam size and the
like) reach it as keyword arguments. With a ``load(model)`` method it is loaded once
per Python worker process: the worker keeps it between its tasks, until another
model is asked for. Two deterministic predictors ship for tests and demos; no model
weights exist in this repo.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .._util import require_columns

Predictor = Callable[..., list[str]]


class ReverseWordsPredictor:
    """Deterministic stand-in model: the words of each line in reverse order."""

    def __call__(self, batch: list[str]) -> list[str]:
        return [" ".join(reversed(s.split(" "))) for s in batch]


class PhraseTablePredictor:
    """Word-by-word look-up in a table (case-sensitive); unknown words kept."""

    def __init__(self, table: dict[str, str]):
        self.table = dict(table)

    def __call__(self, batch: list[str]) -> list[str]:
        return [" ".join(self.table.get(w, w) for w in s.split(" ")) for s in batch]


def loaded_predictor(predictor: Predictor, model, key: str) -> Predictor:
    """The worker process's loaded copy of ``predictor``. One is kept at a time, under the
    ``key`` of its pickled form; the interpreter outlives a task, the modules pickled
    into a task may not."""
    if not hasattr(predictor, "load"):
        return predictor
    kept = sys.__dict__.setdefault("_bitext_model", {})
    if kept.get("key") != (key, model):
        kept.clear()
        predictor.load(model)
        kept.update(key=(key, model), predictor=predictor)
    return kept["predictor"]


def predict(texts: list[str], predictor: Predictor, batch_size: int, options: dict) -> list[str]:
    """Predictions in the order of ``texts``. Batches hold texts of like length, so that
    a model that pads computes little padding; ties keep their order."""
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    out: list[str] = [""] * len(texts)
    for at in range(0, len(order), batch_size):
        places = order[at:at + batch_size]
        found = list(predictor([texts[i] for i in places], **options))
        if len(found) != len(places):
            raise ValueError(f"the model answered {len(found)} of {len(places)} texts of a batch")
        for i, text in zip(places, found):
            out[i] = text
    return out


def translate_batch(df: DataFrame, text_col: str, predictor: Predictor, batch_size: int = 4,
                    out_col: str = "translation", model=None, options: dict | None = None) -> DataFrame:
    """Add ``out_col`` = predictor output for ``text_col``.

    ``model`` names what ``load`` loads (a path or a type such as ``baseline`` or
    ``finetuned``), ``options`` are keyword arguments of every call (``beam_size=5``).
    ``mapInPandas`` streams Arrow batches through the predictor, ``batch_size`` texts
    of like length at a time; as many answers as texts must come back, else the
    task fails. NULL text is ``""``. Empty partitions never call (or load) the model.
    Callers should translate *distinct* texts and write the result, since a
    model call is the expensive, non-replayable step.
    """
    require_columns(df, text_col)
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    options, key = dict(options or {}), hashlib.sha256(cloudpickle.dumps(predictor)).hexdigest()
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType())])

    def run(batches: Iterator):
        for pdf in batches:
            if pdf.empty:
                continue
            texts = [t if isinstance(t, str) else "" for t in pdf[text_col]]
            loaded = loaded_predictor(predictor, model, key)
            yield pdf.assign(**{out_col: predict(texts, loaded, batch_size, options)})

    return df.mapInPandas(run, schema)
