"""From pages to blocks, sections, names and corrected names; what is done is not done again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folio.operators import ocr
from folio.operators.correct import NameCorrector, NoOpCorrector
from folio.operators.names import Recognizer, section_names
from folio.operators.sections import rows_of, sections_of
from folio.operators.shared import written
from folio.plans.resume import Manifest, page_sums
from folio.sources.ingest import page_files
from folio.sources.sinks import exists, to_bundles, to_tables


@dataclass
class Config:
    """Which stages run, and what they use."""

    extract_text: bool = True
    extract_names: bool = True
    correct_names: bool = False
    strict_zero_bounds: bool = False
    min_tokens: int = 0
    recognizer: Recognizer | None = None
    corrector: NoOpCorrector | NameCorrector | None = None
    settings: dict[str, object] | None = None
    bundles: bool = False


def _named(rows: DataFrame, found: DataFrame, config: Config) -> DataFrame:
    names = section_names(rows, config.recognizer)
    if config.correct_names and config.corrector:
        names = corrected(names, config)
    names = names.select(F.col("book").alias("_book"), F.col("marker").alias("_marker"), "names")
    same = F.col("book").eqNullSafe(F.col("_book")) & (F.col("marker") == F.col("_marker"))
    return found.drop("texts").join(names, same).drop("_book", "_marker")


def sections_with_names(blocks: DataFrame, config: Config = Config(), book_pages: DataFrame | None = None) -> DataFrame:
    """book, marker, header, start_page, end_page, pages, names."""
    rows = rows_of(blocks, config.strict_zero_bounds, book_pages)
    return _named(rows, sections_of(rows), config)


def corrected(names: DataFrame, config: Config) -> DataFrame:
    """names (book, marker, header, names) with each name of min_tokens or more corrected, sorted and distinct again."""
    each = names.select("book", "marker", F.explode("names").alias("name"))
    long = F.size(F.split("name", " ")) >= config.min_tokens
    fixed = config.corrector.correct(each.where(long).select("name").distinct())
    each = each.join(fixed, "name", "left").withColumn("name", F.coalesce("corrected", "name"))
    held = each.groupBy("book", "marker").agg(F.array_sort(F.collect_set("name")).alias("_names"))
    out = names.join(held, ["book", "marker"], "left")
    return out.withColumn("names", F.coalesce("_names", "names")).drop("_names")


def text_outputs(pages: DataFrame, config: Config = Config(), books: DataFrame | None = None) -> dict[str, DataFrame]:
    """pages (compiled), blocks, meta, headers_index and texts_clean of pages (book, page, value).

    Pages are parsed once: all of these read the same two tables in the shared folder.
    """
    compiled = written(ocr.compiled(pages, books), "compiled")
    found = written(ocr.blocks(compiled), "blocks")
    return {"pages": compiled, "blocks": found, "meta": ocr.meta(compiled, found, config.settings), "headers_index": ocr.headers_index(found), "texts_clean": ocr.texts_clean(compiled)}


def name_outputs(blocks: DataFrame, book_pages: DataFrame, config: Config = Config()) -> dict[str, DataFrame]:
    """sections_with_text, sections_count and, if the config has it, sections_with_names: of one pass over the blocks."""
    rows = written(rows_of(blocks, config.strict_zero_bounds, book_pages), "section-rows")
    held = written(sections_of(rows), "sections")
    out = {"sections_with_text": held, "sections_count": ocr.sections_count(held)}
    return out | ({"sections_with_names": _named(rows, held, config)} if config.extract_names else {})


def from_json(spark: SparkSession, pages: DataFrame, config: Config = Config(), books: DataFrame | None = None) -> dict[str, DataFrame]:
    """All outputs for pages (book, page, value); books (book, page_count): then what is not there of these is a page without content."""
    out = text_outputs(pages, config, books)
    return out | name_outputs(out["blocks"], out["pages"].select("book", "page"), config)


def write_outputs(outputs: dict[str, DataFrame], folder: str) -> None:
    """A table by book for each output; books that are not in an output keep what they have there."""
    for name, df in outputs.items():
        # A page is written as JSON text, which any reader takes.
        rows = df.withColumn("v", F.to_json("v")).withColumnRenamed("v", "value") if "v" in df.columns else df
        to_tables(rows, f"{folder.rstrip('/')}/{name}")


def results(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """An output as it stands in the folder; empty if it is not there."""
    path = f"{folder.rstrip('/')}/{name}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


_PAGES = "page int, value string, book string"
_BLOCKS = "page int, pos int, y double, label string, content string, bbox array<double>, book string"


def _text_stage(spark: SparkSession, pages: DataFrame, folder: str, config: Config, books: DataFrame | None, manifest: Manifest) -> dict[str, DataFrame]:
    todo = manifest.open("text", page_sums(pages))
    own = pages.join(todo, "book", "left_semi")
    outputs = text_outputs(own, config, books.join(todo, "book", "left_semi") if books is not None else None)
    if not todo.isEmpty():
        write_outputs(outputs, folder)
        if config.bundles:
            to_bundles(outputs["pages"], outputs["meta"], outputs["headers_index"], f"{folder.rstrip('/')}/bundles")
        manifest.commit("text", page_sums(own))
    return outputs


def _name_stage(spark: SparkSession, folder: str, config: Config, manifest: Manifest) -> dict[str, DataFrame]:
    """Reads what the stage before has written, also in an earlier run."""
    done = manifest.done("text")
    todo = manifest.open("names", done)
    own = lambda name, schema: results(spark, folder, name, schema).join(todo, "book", "left_semi")
    outputs = name_outputs(own("blocks", _BLOCKS), own("pages", _PAGES).select("book", "page"), config)
    if not todo.isEmpty():
        write_outputs(outputs, folder)
        manifest.commit("names", done.join(todo, "book", "left_semi"))
    return outputs


def run(spark: SparkSession, path: str, folder: str, config: Config = Config(), books: DataFrame | None = None) -> dict[str, DataFrame]:
    """Reads the page files under path and writes the outputs to folder; returns those of the books that it has worked on.

    A manifest in the folder says which pages of which books each stage has done. A book of which a page is new, changed or gone is
    done again as a whole, others are left alone; a path that holds nothing gives empty outputs and writes nothing. Of files for one
    page the last counts (ocr.unique_pages). books (book, page_count): pages that are not there are written without content.
    """
    manifest = Manifest(spark, f"{folder.rstrip('/')}/manifest")
    outputs = {}
    if config.extract_text:
        pages = written(ocr.unique_pages(page_files(spark, path)).select("book", "page", "value"), "pages")
        outputs |= _text_stage(spark, pages, folder, config, books, manifest)
    if config.extract_names:
        outputs |= _name_stage(spark, folder, config, manifest)
    return outputs


def page_counters(pages: DataFrame) -> tuple[DataFrame, Observation]:
    """pages (book, page, value), and what is counted as they pass: existing (pages that are there) and created (those that are JSON)."""
    seen = Observation("pages")
    return pages.observe(seen, F.count_if(F.col("value").isNotNull()).alias("existing"), F.count_if(F.try_parse_json("value").isNotNull()).alias("created")), seen
