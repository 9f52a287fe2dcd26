"""PDF and OCR sources. The libraries that render and recognise are optional and live in the Python workers."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folio.functions.text import scale_of
from folio.operators.shared import ranked

PAGE_SCHEMA = "book string, page int, width int, height int, rgb binary, gray binary, error string"


def pdf_files(spark: SparkSession, pdf: str | None = None, pdf_dir: str | None = None) -> DataFrame:
    """book, path, content: the file if it can be found, else the *.pdf of the folder, not below it; neither: empty."""
    for path, options in ((pdf, {}), (pdf_dir, {"pathGlobFilter": "*.pdf"})):
        if not path:
            continue
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            files = spark.read.format("binaryFile").options(**options).load(path)
            stem = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
            return files.select(stem.alias("book"), "path", "content")
    return spark.createDataFrame([], "book string, path string, content binary")


def pdf_listing(spark: SparkSession, pdf: str | None = None, pdf_dir: str | None = None) -> DataFrame:
    """book, path and idx, the order of the paths from 0; contents are not read."""
    return ranked(pdf_files(spark, pdf, pdf_dir).select("book", "path"), [F.asc("path")])


PAGE_FILE = "book string, page int, value string, name string, modified timestamp"


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """book, page, value, name, modified of <path>/<book>/*.json; page is the number in the file's name, null if it
    is not pageNNNN.json. No such file: empty."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place):
        return spark.createDataFrame([], PAGE_FILE)
    files = spark.read.text(path, wholetext=True).select("value", "_metadata.file_path", "_metadata.file_modification_time")
    name = F.regexp_extract("file_path", r"([^/]+)$", 1)
    number = F.regexp_extract("file_path", r"page(\d+)\.json$", 1)
    found = files.where(name.endswith(".json")).withColumns({"name": name, "book": F.regexp_extract("file_path", r"([^/]+)/[^/]*$", 1)})
    return found.select("book", F.when(number != "", number.try_cast("int")).alias("page"), "value", "name", F.col("file_modification_time").alias("modified"))


def json_pages(spark: SparkSession, path: str) -> DataFrame:
    """book, page, value of <path>/<book>/pageNNNN.json; the page is the number in the file's name. No such file: empty."""
    return page_files(spark, path).where("page IS NOT NULL").select("book", "page", "value")


#: How each kind of image is saved, and the mode it is turned to first (None: its own).
SAVED = {
    "jpg": {"format": "JPEG", "mode": "RGB", "options": {"optimize": True, "progressive": False}, "lossy": True},
    "png": {"format": "PNG", "mode": None, "options": {"optimize": True}, "lossy": False},
}


def encode_image(image, kind: str, quality: int) -> bytes:
    """The image in a format of SAVED; any kind that is not there is PNG."""
    how, out = SAVED.get(kind.lower(), SAVED["png"]), io.BytesIO()
    ready = image.convert(how["mode"]) if how["mode"] else image
    ready.save(out, how["format"], **how["options"], **({"quality": quality} if how["lossy"] else {}))
    return out.getvalue()


#: Pages of a file that one task renders.
PAGES_AT_ONCE = 50


def page_ranges(files: DataFrame, pages: int = PAGES_AT_ONCE) -> DataFrame:
    """book, first, pages, content, error: each file as files of so many pages, which tasks can render apart.

    first is the number of the first page, and pages that of all pages of the book. A file that fails has one row with its error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import fitz  # optional

        for batch in batches:
            for book, content in zip(batch["book"], batch["content"], strict=True):
                try:
                    with fitz.open(stream=content, filetype="pdf") as pdf:
                        n = len(pdf)
                        for at in range(0, n, pages):
                            with fitz.open() as part:
                                part.insert_pdf(pdf, from_page=at, to_page=min(at + pages, n) - 1)
                                yield pd.DataFrame([(book, at + 1, n, part.tobytes(), None)], columns=["book", "first", "pages", "content", "error"])
                except Exception as e:  # a file can be broken in any way
                    yield pd.DataFrame([(book, None, None, None, f"{type(e).__name__}: {e}")], columns=["book", "first", "pages", "content", "error"])

    return files.select("book", "content").mapInPandas(run, "book string, first int, pages int, content binary, error string")


def rendered(files: DataFrame, dpi: int = 300, kind: str = "jpg", quality: int = 95, pages: int = PAGES_AT_ONCE) -> DataFrame:
    """A row for each page of each file. A page that fails has a row with its error, a file that cannot be opened one in all,
    and no other suffers.

    Files are cut into ranges of pages, which are dealt to tasks, so a long file is not one task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import fitz  # optional
        from PIL import Image  # optional

        def image(page, space, mode):
            pixels = page.get_pixmap(matrix=fitz.Matrix(scale_of(dpi), scale_of(dpi)), colorspace=space, alpha=False)
            return Image.frombytes(mode, (pixels.width, pixels.height), pixels.samples)

        def one(book, k, page):
            try:
                rgb, gray = image(page, fitz.csRGB, "RGB"), image(page, fitz.csGRAY, "L")
                return (book, k, rgb.width, rgb.height, encode_image(rgb, kind, quality), encode_image(gray, kind, quality), None)
            except Exception as e:  # a page can be broken in any way
                return (book, k, None, None, None, None, f"{type(e).__name__}: {e}")

        for batch in batches:
            for book, first, content, error in zip(batch["book"], batch["first"], batch["content"], batch["error"], strict=True):
                rows = [(book, None, None, None, None, None, error)]
                if content is not None:
                    with fitz.open(stream=content, filetype="pdf") as pdf:
                        rows = [one(book, k, page) for k, page in enumerate(pdf, int(first))]
                yield pd.DataFrame(rows, columns=["book", "page", "width", "height", "rgb", "gray", "error"])

    parts = page_ranges(files, pages)
    dealt = parts.repartition("book", "first")  # hash by range, so that the ranges of a book spread
    return dealt.mapInPandas(run, PAGE_SCHEMA)


def counted(images: DataFrame) -> tuple[DataFrame, Observation]:
    """images, and what is counted as they pass: pages with a colour image, with a gray one, and files or ranges that failed."""
    seen = Observation("images")
    return images.observe(seen, F.count_if(F.col("rgb").isNotNull()).alias("have_rgb"), F.count_if(F.col("gray").isNotNull()).alias("have_gray"), F.count_if(F.col("error").isNotNull()).alias("failed")), seen


def recognised(images: DataFrame, backend: Callable[[], Callable[[list[bytes]], list[str]]], batch: int = 64) -> DataFrame:
    """book, page, value: JSON text of each page. backend() is called once in each task and returns what reads a list of images."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = backend()
        for part in batches:
            for at in range(0, len(part), batch):
                own = part.iloc[at : at + batch]
                yield pd.DataFrame({"book": own["book"], "page": own["page"], "value": read(list(own["gray"]))})

    return images.where("error IS NULL").select("book", "page", "gray").mapInPandas(run, "book string, page int, value string")
