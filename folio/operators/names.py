"""Names of persons in texts: chunks, a recogniser, and cleaning."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import chunks, clean_name, split_joined_capitals
from folio.operators.sections import MARKER, NO_HEADERS, TEXT


class Recognizer(Protocol):
    """A column of the person spans (array of string) in a column of text, in the order of the text."""

    def persons(self, text: Column) -> Column: ...


class CapitalizedRuns:
    """The default: runs of at least min_words capitalised ASCII words. It stays in the JVM."""

    def __init__(self, min_words: int = 2):
        self.min_words = min_words

    def persons(self, text: Column) -> Column:
        more = f"{{{self.min_words - 1},}}"
        return F.regexp_extract_all(text, F.lit(rf"[A-Z][a-z]+(?: [A-Z][a-z]+){more}"), F.lit(0))


class SpacyRecognizer:
    """PERSON entities of a spaCy model, loaded once in each Python worker; the first model that is there is used.

    Texts go through the model in batches. With a graphics processor, which counts only for models with a transformer,
    batches are larger. Tasks are parallel already, so the model starts no processes of its own.
    """

    #: Models in the order in which they are tried, the parts of a pipeline that are kept, what a person is labelled.
    MODELS = ("en_core_web_trf", "en_core_web_lg", "en_core_web_md", "en_core_web_sm")
    KEEP = ("transformer", "ner")
    PERSON = "PERSON"
    #: Texts of a batch without and with a graphics processor.
    BATCH, GPU_BATCH = 256, 1024

    def __init__(self, models: tuple[str, ...] = MODELS, batch: int | None = None):
        self.models, self.batch = models, batch

    def entities(self, text: Column) -> Column:
        """All entities of a text in order: array of struct(text, label, start), start in characters from 0."""
        models, batch, keep, sizes = self.models, self.batch, self.KEEP, (self.BATCH, self.GPU_BATCH)

        @F.pandas_udf("array<struct<text: string, label: string, start: int>>")
        def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            nlp = _spacy(models)
            size = batch or sizes["transformer" in nlp.pipe_names and _has_gpu()]
            with nlp.select_pipes(disable=[p for p in nlp.pipe_names if p not in keep]):
                for part in parts:
                    found = nlp.pipe(part.fillna(""), batch_size=size)
                    yield pd.Series([sorted(({"text": e.text, "label": e.label_, "start": e.start_char} for e in d.ents), key=lambda e: e["start"]) for d in found])

        return run(text)

    def persons(self, text: Column) -> Column:
        found = F.filter(self.entities(text), lambda e: e["label"] == self.PERSON)
        return F.transform(found, lambda e: e["text"])


def _has_gpu() -> bool:
    try:
        import torch  # optional
    except ImportError:
        return False
    return bool(torch.cuda.is_available())


def first_person(text: Column, recognizer: Recognizer | None) -> Column:
    """The first person in a text; the whole text where there is none, or no recogniser."""
    return text if recognizer is None else F.coalesce(F.get(recognizer.persons(text), F.lit(0)), text)


_loaded: dict = {}


def _spacy(models: tuple[str, ...]):
    if models not in _loaded:
        import spacy  # optional

        found = next((m for m in models if spacy.util.is_package(m)), None)
        if not found:
            raise RuntimeError(f"none of these models is installed: {', '.join(models)}")
        _loaded[models] = spacy.load(found)
    return _loaded[models]


def candidates(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, idx and chunk of each text."""
    return texts.select(*keys, F.posexplode(chunks(F.col("text"))).alias("idx", "chunk"))


def names_in(texts: DataFrame, keys: list[str], recognizer: Recognizer | None = None) -> DataFrame:
    """Distinct keys and name. Every distinct chunk is recognised once, and its names joined back."""
    recognizer = recognizer or CapitalizedRuns()
    own = candidates(texts, keys).select(*keys, "chunk").distinct()
    if isinstance(recognizer, CapitalizedRuns):
        # The regular expression is cheaper than a shuffle of the chunks.
        spans = own.select(*keys, F.explode(recognizer.persons(F.col("chunk"))).alias("span"))
    else:
        found = own.select("chunk").distinct().select("chunk", F.explode(recognizer.persons(F.col("chunk"))).alias("span"))
        spans = own.join(found, "chunk").select(*keys, "span")
    named = spans.select(*keys, clean_name(split_joined_capitals(F.col("span"))).alias("name"))
    return named.where("name IS NOT NULL").distinct()


def names_from(text: Column, recognizer: CapitalizedRuns) -> Column:
    """The names in a text, by a recogniser that is an expression: an array that may hold a name more than once."""
    spans = F.flatten(F.transform(chunks(text), recognizer.persons))
    return F.filter(F.transform(spans, lambda s: clean_name(split_joined_capitals(s))), lambda n: n.isNotNull())


def section_names(rows: DataFrame, recognizer: Recognizer | None = None) -> DataFrame:
    """book, marker, header, page (the header's) and names (sorted, distinct) of the sections of filled rows (sections.rows_of).

    With a recogniser that is an expression the rows are not shuffled again; another one reads each distinct chunk once.
    """
    recognizer = recognizer or CapitalizedRuns()
    own = rows.where((F.col("marker") > 0) | ~F.col("headed"))
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    kept = [F.max(of(MARKER, F.col("text"))).alias("header"), F.max(of(MARKER, F.col("page"))).alias("page"), F.count_if(F.col("kind") == TEXT).alias("_texts")]
    none = F.array().cast("array<string>")
    if isinstance(recognizer, CapitalizedRuns):
        own = own.withColumn("_found", of(TEXT, names_from(F.col("text"), recognizer)))
        found = F.flatten(F.collect_list(F.when(F.size("_found") > 0, F.col("_found"))))
        held = own.groupBy("book", "marker").agg(*kept, F.array_sort(F.array_distinct(found)).alias("names"))
    else:
        each = names_in(own.where(F.col("kind") == TEXT).select("book", "marker", "text"), ["book", "marker"], recognizer)
        each = each.groupBy("book", "marker").agg(F.array_sort(F.collect_set("name")).alias("_names"))
        each = each.select(F.col("book").alias("_book"), F.col("marker").alias("_marker"), "_names")
        held = own.groupBy("book", "marker").agg(*kept).join(each, F.col("book").eqNullSafe(F.col("_book")) & (F.col("marker") == F.col("_marker")), "left")
        held = held.withColumn("names", F.coalesce("_names", none))
    held = held.where((F.col("marker") > 0) | (F.col("_texts") > 0))
    header = F.when(F.col("marker") == 0, F.lit(NO_HEADERS)).otherwise(F.col("header"))
    return held.select("book", "marker", header.alias("header"), "page", "names")
