from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from folio.operators import ocr, sections
from folio.operators.names import CapitalizedRuns, names_in
from folio.plans import pipeline
from folio.plans.pipeline import Config, from_json, sections_with_names
from folio.sources import ingest, sinks

BLOCK = "book string, page int, pos int, y double, label string, content string"


def block(spark, rows):
    return spark.createDataFrame(rows, BLOCK)


def test_section_fixture(spark):
    heads = [("b", 1, 0, 5.0, "header", "A"), ("b", 2, 1, 3.0, "Paragraph_Title", "B"), ("b", 2, 2, 5.0, "header", "BASKETBALL PLAYERS")]
    texts = [("b", p, k, float(y), "text", f"{p},{y}") for k, (p, y) in enumerate([(1, 2), (1, 5), (1, 9), (2, 1), (2, 3), (2, 8)], 3)]
    found = {r.header: (r.texts, r.pages) for r in sections.sections(block(spark, heads + texts)).collect()}
    assert found == {"A": (["1,5", "1,9", "2,1"], [1, 2]), "B": (["2,3", "2,8"], [2])}


def test_section_pages_and_empty_sections(spark):
    rows = [("b", 3, 0, 1.0, "header", "H"), ("b", 3, 1, 1.0, "header", "I"), ("b", 4, 2, 1.0, "text", "x"), ("b", 5, 3, 1.0, None, "y"), ("b", 5, 4, 1.0, "footer", "z")]
    found = {r.header: (r.start_page, r.end_page, r.pages, r.texts) for r in sections.sections(block(spark, rows)).collect()}
    assert found == {"H": (3, 3, [3], []), "I": (4, 5, [4, 5], ["x", "y"])}


def test_no_headers(spark):
    rows = [("b", 1, 0, 1.0, "text", "x"), ("b", 2, 1, 1.0, "text", "  "), ("c", 1, 0, 1.0, "text", " ")]
    found = sections.sections(block(spark, rows)).collect()
    assert [(r.book, r.header, r.pages, r.texts) for r in found] == [("b", "(no headers found)", [1, 2], ["x"])]


def test_pages_without_blocks_and_boxes(spark, tmp_path):
    pages = [("b", 1, '{"parsing_res_list": [{"block_label": "text", "block_content": "t", "block_bbox": [1, 2.5, 3, 4]}]}'), ("b", 2, "{}"), ("b", 3, "no json")]
    pages += [("c", 1, '{"items": [{"text": "x", "bbox": [1, 2]}], "texts": ["a", ""]}'), ("c", 2, '{"parsing_res_list": [{"block_label": "header", "block_content": "H", "block_bbox": "none"}], "rec_texts": []}')]
    out = pipeline.from_json(spark, spark.createDataFrame(pages, "book string, page int, value string"), pipeline.Config(settings={"dpi": 300}))
    held = {(r.book, r.header): (r.pages, r.start_page, r.end_page) for r in out["sections_with_text"].collect()}
    assert held == {("b", sections.NO_HEADERS): ([1, 2, 3], 1, 3), ("c", "H"): ([2], 2, 2)}
    assert sorted((r.book, r.bbox) for r in out["blocks"].collect() if r.bbox) == [("b", [1.0, 2.5, 3.0, 4.0]), ("c", [1.0, 2.0])]
    assert [tuple(r) for r in out["headers_index"].collect()] == [("c", 2, 0, "H", None)]
    assert {r.book: (r.file_name, r.total_pages, r.pipeline_settings) for r in out["meta"].collect()} == {"b": ("b.pdf", 3, {"dpi": "300"}), "c": ("c.pdf", 2, {"dpi": "300"})}
    assert {r.book: r.sections_count for r in out["sections_count"].collect()} == {"b": 1, "c": 1}
    assert {r.book: r.n for r in ocr.texts_clean(ocr.parsed(spark.createDataFrame(pages, "book string, page int, value string"))).collect()}["c"] == 2
    pipeline.write_outputs(out, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "sections_with_names")).count() == 2
    empty = pipeline.run(spark, str(tmp_path / "nothing" / "*"), str(tmp_path / "none"))
    assert all(df.count() == 0 for df in empty.values()) and not (tmp_path / "none").exists()


def test_zero_bound(spark):
    rows = block(spark, [("b", 1, 0, -1.0, "header", "A"), ("b", 1, 1, 0.0, "header", "B"), ("b", 1, 2, 4.0, "text", "t")])
    assert [r.marker for r in sections.assigned(rows).collect()] == [2]
    assert sorted(r.marker for r in sections.assigned(rows, True).collect()) == [1, 2]


def test_assignment_against_a_direct_model(spark):
    r = random.Random(11)
    rows, wanted = [], []
    for book in range(150):
        own = [(str(book), r.randint(1, 3), k, float(r.randint(-1, 4)), r.choice(["header", "text"]), f"{k}") for k in range(r.randint(0, 9))]
        rows += own
        heads = sorted((x[1], x[3], x[2]) for x in own if x[4] == "header")
        for b, page, pos, y, label, _ in own:
            if label != "text":
                continue
            for i, (p, at, _) in enumerate(heads):
                after = heads[i + 1][:2] if i + 1 < len(heads) else None
                inside = (page, y) >= (p, at) and (after is None or (page, y) < after)
                zero = after is not None and after[0] == p == page and after[1] == 0 and y >= at
                if inside or zero:
                    wanted.append((b, i + 1, pos))
    found = sections.assigned(block(spark, rows), True)
    assert sorted((x.book, x.marker, x.pos) for x in found.collect()) == sorted(wanted)


def test_clean_arrays(spark):
    rows = [(["a", "", " ", None, "b"], [1, 2, 3], None), (None, [1], ["x"])]
    df = spark.createDataFrame(rows, "rec_texts array<string>, rec_scores array<int>, rec_boxes array<string>")
    assert [tuple(r) for r in ocr.clean_arrays(df).collect()] == [(["a", "b"], [1], None), (None, [1], ["x"])]


PAGES = [
    {"parsing_res_list": [{"block_label": "header", "block_content": "Staff", "block_bbox": [1, "2.5", 3, 4]}, "odd", {"block_content": 5, "block_bbox": None}, {"block_label": "text", "block_content": "Jane DoeSmith. Al Bo", "block_bbox": [1]}], "rec_texts": ["a"]},
    {"items": [{"text": "Mary Poppins, nurse", "bbox": [0, 7]}], "texts": ["x", "y"]},
    "no page",
]


def test_ocr_pages(spark):
    df = spark.createDataFrame([("b", k, json.dumps(p)) for k, p in enumerate(PAGES, 1)] + [("b", 4, "{broken")], "book string, page int, value string")
    found = from_json(spark, df)
    rows = [(r.page, r.pos, r.y, r.label, r.content) for r in found["blocks"].orderBy("page", "pos").collect()]
    assert rows == [(1, 0, 2.5, "header", "Staff"), (1, 2, -1.0, "None", ""), (1, 3, -1.0, "text", "Jane DoeSmith. Al Bo"), (2, 0, 7.0, "text", "Mary Poppins, nurse")]
    meta = found["meta"].first()
    assert meta.total_pages == 4 and meta.counts_by_block_label == {"None": 1, "header": 1, "text": 2}
    assert [r.content for r in found["headers_index"].collect()] == ["Staff"]
    named = found["sections_with_names"].first()
    assert (named.header, named.pages, named.names) == ("Staff", [2], ["Mary Poppins"])
    assert ocr.texts_clean(ocr.parsed(df)).first().n == 3


def test_names(spark):
    df = spark.createDataFrame([(1, "Jane DoeSmith went. O Neil, Bo Li"), (2, None)], "k int, text string")
    assert sorted(r.name for r in names_in(df, ["k"]).collect()) == ["Bo Li", "Jane Doe"]

    class Spans(CapitalizedRuns):
        pass

    assert sorted(r.name for r in names_in(df, ["k"], Spans(1)).collect()) == ["Bo Li", "Jane Doe", "Neil", "Smith"]


def test_missing_and_finished(spark):
    books = spark.createDataFrame([("a", 2), ("b", 3)], "book string, page_count int")
    pages = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "book string, page int")
    assert sorted(map(tuple, ocr.missing(pages, books).collect())) == [("b", 2), ("b", 3)]
    assert [r.book for r in ocr.finished(pages, books).collect()] == ["a"]
    assert ocr.complete(pages, books).count() == 5


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "pdf" / "deep").mkdir(parents=True)
    for f in ("a.pdf", "b.pdf", "c.txt", "deep/d.pdf"):
        (tmp_path / "pdf" / f).write_bytes(b"%PDF")
    folder = str(tmp_path / "pdf")
    assert sorted(r.book for r in ingest.pdf_files(spark, None, folder).collect()) == ["a", "b"]
    assert [r.book for r in ingest.pdf_files(spark, f"{folder}/b.pdf", folder).collect()] == ["b"]
    assert ingest.pdf_files(spark, f"{folder}/none.pdf", None).count() == 0
    (tmp_path / "ocr" / "bk").mkdir(parents=True)
    (tmp_path / "ocr" / "bk" / "page0003.json").write_text("{}")
    assert [tuple(r) for r in ingest.json_pages(spark, str(tmp_path / "ocr" / "*")).collect()] == [("bk", 3, "{}")]
    images = spark.createDataFrame([("b", 1, bytearray(b"x"), None)], "book string, page int, gray binary, error string")
    assert ingest.recognised(images, lambda: lambda parts: [f'{{"n": {len(p)}}}' for p in parts]).first().value == '{"n": 1}'
    df = spark.createDataFrame([("b", None, ["x"])], "book string, page int, names array<string>")
    value = sinks.as_json(df, ["book"]).first().value
    assert json.loads(value) == {"page": None, "names": ["x"]} and "\n" in value
    sinks.to_tables(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    sinks.to_json_files(df, str(tmp_path / "j"))


def test_correction_in_the_pipeline(spark):
    class Shout:
        enabled = True

        def correct(self, names):
            return names.select("name", F.upper("name").alias("corrected"))

    rows = block(spark, [("b", 1, 0, 1.0, "header", "H"), ("b", 1, 1, 2.0, "text", "Jane Doe, Al Bo")])
    out = sections_with_names(rows, Config(correct_names=True, corrector=Shout(), min_tokens=2)).first()
    assert out.names == ["AL BO", "JANE DOE"]


def test_arriving_pages(spark, tmp_path):
    from folio.streaming.files import arriving_pages

    (tmp_path / "in" / "bk").mkdir(parents=True)
    (tmp_path / "in" / "bk" / "page0001.json").write_text(json.dumps(PAGES[0]))
    found = ocr.blocks(ocr.parsed(arriving_pages(spark, str(tmp_path / "in"))))
    q = found.writeStream.format("memory").queryName("arrived").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("arrived").count() == 3


def test_zero_bounds_in_one_pass(spark, tmp_path):
    """Books in a window against books in ranges, and the blocks are read once for both kinds of sections."""
    rng = random.Random(17)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]), i, rng.choice([-1.0, 0.0, 0.0, 1.0, 2.0, None]), rng.choice(["header", "text", "text"]), f"t{i}") for i in range(400)]
    block(spark, rows).write.parquet(f"{tmp_path}/b")
    blocks = spark.read.parquet(f"{tmp_path}/b")
    one = sections.assigned(blocks, True)
    found = sorted(map(str, one.collect()))
    assert found == sorted(map(str, sections.assigned(blocks, True, giant=1).collect()))
    assert len(found) > sections.assigned(blocks).count()
    assert one._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
