"""Pages from files to bundles, with stand-ins for the libraries that render, recognise and find names."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from folio.functions import text as fn
from folio.operators import correct, ocr, sections
from folio.operators.names import CapitalizedRuns, SpacyRecognizer, first_person, names_in, section_names
from folio.plans import pipeline, resume
from folio.sources import ingest, sinks

PAGES = "book string, page int, value string"
FILES = "book string, page int, value string, name string, modified timestamp"


def pages_of(spark, values):
    return spark.createDataFrame([("b", k, v if isinstance(v, str) or v is None else json.dumps(v, ensure_ascii=False)) for k, v in enumerate(values, 1)], PAGES)


def naive_page(page, number):
    """What a page is after cleaning and numbering; page is an object or anything else."""
    if not isinstance(page, dict):
        return page
    out = dict(page)
    for name, others in (("rec_texts", ("rec_scores", "rec_polys", "rec_boxes")), ("texts", ("scores", "polys", "boxes"))):
        if isinstance(page.get(name), list):
            keep = [t is not None and str(t).strip() != "" for t in page[name]]
            for key in (name, *others):
                if isinstance(page.get(key), list):
                    out[key] = [x for x, k in zip(page[key], keep) if k]
    out["page_number"] = number
    if isinstance(page.get("parsing_res_list"), list):
        out["parsing_res_list"] = [{**b, "page_number": number} if isinstance(b, dict) else b for b in page["parsing_res_list"]]
    return out


ODD = [
    {"rec_texts": ["a", "", None, " ", 5, {"q": [1]}, [], "é "], "rec_scores": [0.5, 1, 2, 3], "rec_polys": [[[1, 2], [3.5, 4]], [], None, 1, {"z": 1}, 6, 7, 8, 9], "rec_boxes": "none", "extra": {"n": None, "deep": [{"k": [None, ""]}]}},
    {"texts": "none", "scores": [1, 2], "page_number": 99, "parsing_res_list": [{"block_label": "header", "page_number": "x", "more": None}, 3, "s", None, [1, {"a": 2}], {}]},
    {"texts": [], "scores": [1], "rec_texts": None, "rec_scores": [1], "parsing_res_list": {"a": 1}, "null": None, "": 1, "a.b": {"$": 1}},
    [1, {"texts": [""]}], "5", '"text"', "null", {}, {"rec_texts": ["x"], "texts": [" ", "y"], "boxes": [[1], [2]], "parsing_res_list": []},
]


def test_pages_are_cleaned_and_numbered(spark):
    found = {r.page: json.loads(r.v) for r in ocr.compiled(pages_of(spark, ODD)).select("page", F.to_json("v").alias("v")).collect()}
    wanted = [json.loads(v) if isinstance(v, str) else v for v in ODD]
    assert found == {k: naive_page(v, k) for k, v in enumerate(wanted, 1)}


def test_absent_pages_have_an_index(spark):
    books = spark.createDataFrame([("b", 4), ("c", 1)], "book string, page_count int")
    pages = pages_of(spark, [{"texts": ["x"]}, "{broken", None]).unionByName(spark.createDataFrame([("b", 9, "{}"), ("d", 1, "{}")], PAGES))
    found = {(r.book, r.page): json.loads(r.v) for r in ocr.compiled(pages, books).select("book", "page", F.to_json("v").alias("v")).collect()}
    absent = lambda k: {"page_index": k - 1, "page_number": k}
    assert found == {("b", 1): {"texts": ["x"], "page_number": 1}, ("b", 2): absent(2), ("b", 3): absent(3), ("b", 4): absent(4), ("c", 1): absent(1)}
    assert ocr.compiled(pages.where("false")).count() == 0


def at(second):
    return dt.datetime(2024, 1, 1, 0, 0, second)


def test_one_row_for_a_page_in_every_partitioning(spark):
    rng = random.Random(2)
    rows = [("b", rng.choice([1, 2, 3, None]), rng.choice([None, '{"a":1}', '{"a":2}', "{x"]), rng.choice(["page0001.json", "page1.json", "odd.json"]), at(rng.randint(0, 3))) for _ in range(80)] + [("c", 7, "{}", "page0007.json", None)]
    seen = set()
    for parts in (1, 3, 8):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, FILES).repartition(parts)
        seen.add(tuple(sorted((r.book, r.page, r.value, r.name, r.copies) for r in ocr.unique_pages(df).collect())))
    wanted = set()
    for key in {(b, p) for b, p, *_ in rows if p is not None}:
        own = [r for r in rows if r[:2] == key]
        best = max(own, key=lambda r: (r[4] is not None, r[4] or at(0), r[3], r[2] or ""))
        wanted.add((*key, best[2] or None, best[3], len(own)))
    assert len(seen) == 1 and {(*r[:2], r[2] or None, *r[3:]) for r in seen.pop()} == wanted


def test_pages_that_come_again_replace_older_ones(spark, tmp_path):
    path = str(tmp_path / "pages")
    first = [("b", 1, '{"n":1}', "page0001.json", at(5)), ("b", 2, '{"n":2}', "page0002.json", at(5)), ("0007", 1, "{}", "page0001.json", at(1))]
    second = [("b", 1, '{"n":3}', "page0001.json", at(9)), ("b", 2, '{"n":4}', "page0002.json", at(2)), ("b", 3, '{"n":5}', "page0003.json", at(2))]
    for batch in (first, second, second, first):
        resume.save_pages(spark, spark.createDataFrame(batch, FILES), path)
    held = spark.read.schema(f"{FILES}, copies long").parquet(path).collect()
    assert sorted((r.book, r.page, r.value) for r in held) == [("0007", 1, "{}"), ("b", 1, '{"n":3}'), ("b", 2, '{"n":2}'), ("b", 3, '{"n":5}')]


def test_what_is_odd_about_pages(spark):
    rows = [("b", 1, "{}", "page0001.json", at(1)), ("b", 1, "{}", "page1.json", at(1)), ("b", 2, "{x", "page0002.json", at(1)), ("b", None, "{}", "cover.json", at(1)), ("b", 9, "{}", "page0009.json", at(1)), ("u", 1, "{}", "page0001.json", at(1))]
    books = spark.createDataFrame([("b", 3), ("empty", 2)], "book string, page_count int")
    found = {tuple(r) for r in ocr.mismatches(spark.createDataFrame(rows, FILES), books).collect()}
    assert found == {
        ("b", "duplicate", 1, "page1.json", 2), ("b", "odd name", None, "cover.json", 1), ("b", "no json", 2, "page0002.json", 1), ("b", "beyond", 9, "page0009.json", 1),
        ("b", "count", None, None, 2), ("empty", "count", None, None, 0), ("u", "unknown book", None, None, 1),
    }


def book(folder, name, pages):
    (folder / name).mkdir(parents=True, exist_ok=True)
    for k, page in pages.items():
        (folder / name / f"page{k:04d}.json").write_text(json.dumps(page))


def blocks_page(*blocks):
    return {"parsing_res_list": [{"block_label": a, "block_content": b, "block_bbox": [0, k, 1, 1]} for k, (a, b) in enumerate(blocks)]}


def state(folder):
    """Every file of the outputs and when it was written."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, files in os.walk(folder) for f in files if f.startswith("part-")}


def names_in_folder(spark, folder):
    rows = pipeline.results(spark, str(folder), "sections_with_names", "header string, names array<string>, book string").collect()
    return sorted((r.book, r.header, tuple(r.names)) for r in rows)


def test_runs_go_on_where_others_ended(spark, tmp_path, monkeypatch):
    source, out = tmp_path / "in", tmp_path / "out"
    book(source, "0001", {1: blocks_page(("header", "Staff"), ("text", "Jane Doe")), 2: {}})
    book(source, "two", {1: blocks_page(("text", "Al Bo, Cy Di"))})
    run = lambda **more: pipeline.run(spark, str(source / "*"), str(out), pipeline.Config(bundles=True, **more))
    # Killed after the outputs of the text stage, before it is noted as done.
    commit = resume.Manifest.commit
    with monkeypatch.context() as m:
        m.setattr(resume.Manifest, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            run()
    assert run()["blocks"].select("book").distinct().count() == 2
    both = [("0001", "Staff", ("Jane Doe",)), ("two", sections.NO_HEADERS, ("Al Bo", "Cy Di"))]
    assert names_in_folder(spark, out) == both
    # Nothing is new: nothing is read, made or written.
    before = state(out)
    assert all(df.count() == 0 for df in run().values()) and state(out) == before
    # One page changes, one book comes, killed between the stages.
    book(source, "two", {1: blocks_page(("text", "Ed Fo"))})
    book(source, "three", {1: {}, 2: {"texts": ["a", ""]}})
    with monkeypatch.context() as m:
        m.setattr(resume.Manifest, "commit", lambda self, stage, done: commit(self, stage, done) if stage == "text" else (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            run()
    after = run()
    assert after["blocks"].count() == 0 and names_in_folder(spark, out) == [both[0], ("two", sections.NO_HEADERS, ("Ed Fo",))]
    now = state(out)
    assert all(now[f] == t for f, t in before.items() if "book=0001" in f)
    # A book without any block has its counts, its meta and its bundle.
    meta = pipeline.results(spark, str(out), "meta", "total_pages long, counts_by_block_label map<string,long>, book string").where("book = 'three'").first()
    assert (meta.total_pages, meta.counts_by_block_label) == (2, {})
    assert pipeline.results(spark, str(out), "texts_clean", "n long, book string").where("book = 'three'").first().n == 1
    # A page goes: the book is done again.
    os.remove(source / "0001" / "page0002.json")
    assert [r.page for r in run()["pages"].collect()] == [1]
    assert run(extract_text=False, extract_names=False) == {}


def test_bundles(spark, tmp_path):
    pages = [("b", 2, json.dumps({"texts": ["x", " "], "n": {"deep": [1, {"k": "é\n\""}]}})), ("b", 1, json.dumps(blocks_page(("header", "H"), ("header", "I"), ("text", "t")))), ("c", 1, "{}"), ("d", 1, "[1]")]
    out = pipeline.text_outputs(spark.createDataFrame(pages, PAGES), pipeline.Config(settings={"dpi": 300}))
    sinks.to_bundles(out["pages"], out["meta"], out["headers_index"], str(tmp_path / "x"))
    for name, numbers in {"b": [1, 2], "c": [1], "d": [1]}.items():
        files = [f for f in os.listdir(tmp_path / "x" / f"book={name}") if f.startswith("part-")]
        assert len(files) == 1
        value = (tmp_path / "x" / f"book={name}" / files[0]).read_text()
        held = json.loads(value)
        assert list(held) == ["meta", "headers_index", "pages"] and held["meta"]["total_pages"] == len(numbers)
        own = {p: json.loads(v) for b, p, v in pages if b == name}
        assert held["pages"] == [naive_page(own[k], k) for k in numbers]
        assert [h["content"] for h in held["headers_index"]] == (["H", "I"] if name == "b" else [])
        # The layout is that of a whole document with two spaces a level.
        assert value == json.dumps(held, ensure_ascii=False, indent=2) + "\n"


def random_blocks(spark, seed, books=12, most=60):
    rng = random.Random(seed)
    rows = [(f"b{b}" if b else None, rng.randint(1, 4), k, float(rng.randint(-1, 4)), rng.choice(["header", "text", "text", "image", None]), rng.choice(["x", " ", "H", "a player"])) for b in range(books) for k in range(rng.randint(0, most))]
    return spark.createDataFrame(rows, "book string, page int, pos int, y double, label string, content string").repartition(3)


@pytest.mark.parametrize("strict", [False, True])
def test_large_books_are_spread_over_tasks(spark, strict):
    blocks = random_blocks(spark, 5)
    own = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert own(sections.assigned(blocks, strict)) == own(sections.assigned(blocks, strict, giant=20)) == own(sections.assigned(blocks, strict, giant=0))
    assert own(sections.sections(blocks, strict)) == own(sections.sections(blocks, strict, giant=20))
    # One book: no task of the fill has most of it.
    rows = spark.range(20_000).selectExpr("'b' book", "CAST(id % 7 + 1 AS int) page", "CAST(id AS int) pos", "CAST(hash(id) % 50 AS double) y", "IF(id % 90 = 0, 'header', 'text') label", "'t' content")
    filled = sections.filled(rows, giant=1000)
    sizes = sorted(r["count"] for r in filled.groupBy(F.spark_partition_id()).count().collect())
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and sizes[-1] < 15_000 and sum(sizes) == 20_000
    assert filled.agg(F.max("marker")).first()[0] == 223


def test_sections_take_one_exchange(spark):
    plan = sections.sections(random_blocks(spark, 6))._jdf.queryExecution().executedPlan().toString()
    found = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(found) == 1 and "hashpartitioning(book" in found[0] and plan.count("Scan") == 1


@pytest.mark.parametrize("strict", [False, True])
def test_names_of_sections_by_both_ways(spark, strict):
    blocks = spark.createDataFrame([("b", 1, 0, 0.0, "header", "H"), ("b", 1, 1, 1.0, "text", "Jane Doe, Al Bo. Jane Doe"), ("b", 2, 2, 0.0, "header", "I"), ("c", 1, 0, 1.0, "text", "Ed Fo"), ("d", 1, 0, 1.0, "header", "J")], "book string, page int, pos int, y double, label string, content string")

    class Other:
        def persons(self, text):
            return CapitalizedRuns().persons(text)

    rows = sections.rows_of(blocks, strict)
    own = lambda r: sorted((x.book, x.marker, x.header, x.page, tuple(x.names)) for x in section_names(rows, r).collect() if x.page or x.marker == 0)
    wanted = [("b", 1, "H", 1, ("Al Bo", "Jane Doe")), ("b", 2, "I", 2, ()), ("c", 0, sections.NO_HEADERS, None, ("Ed Fo",)), ("d", 1, "J", 1, ())]
    assert own(None) == own(Other()) == wanted


def test_pages_are_rendered_in_ranges(spark):
    files = [("long", b"%PDF" + json.dumps([f"p{k}" for k in range(1, 121)]).encode()), ("bad", b"none"), ("part", b"%PDF" + json.dumps(["a", "b", "broken", "d"]).encode()), ("empty", b"%PDF[]")]
    df = spark.createDataFrame(files, "book string, content binary")
    ranges = sorted((r.book, r["first"], r["pages"]) for r in ingest.page_ranges(df, 50).where("error IS NULL").collect())
    assert ranges == [("long", 1, 120), ("long", 51, 120), ("long", 101, 120), ("part", 1, 4)]
    images, seen = ingest.counted(ingest.rendered(df, 144, "jpg", 90, 2))
    rows = images.collect()
    by = {(r.book, r.page): r for r in rows if r.error is None}
    assert sorted(by) == [("long", k) for k in sorted(range(1, 121))] + [("part", 1), ("part", 2), ("part", 4)]
    one = by["long", 77]
    assert (one.width, one.height) == (20, 40) and json.loads(one.rgb) == {"format": "JPEG", "mode": "RGB", "text": "p77" * 3, "optimize": True, "progressive": False, "quality": 90}
    assert json.loads(one.gray)["text"] == "p77"
    assert sorted((r.book, r.page, r.error) for r in rows if r.error) == [("bad", None, "ValueError: no PDF"), ("part", 3, "ValueError: broken page")]
    # What was counted on the way is what a count of the result says.
    assert seen.get == {"have_rgb": len(by), "have_gray": len(by), "failed": 2}
    assert json.loads(ingest.rendered(df.where("book = 'part'"), kind="tiff").where("page = 1").first().rgb) == {"format": "PNG", "mode": "RGB", "text": "aaa", "optimize": True}


def test_images_are_read_in_batches(spark):
    images = spark.createDataFrame([("b", k, bytearray(f"t{k}".encode()), None) for k in range(1, 8)] + [("c", None, None, "broken")], "book string, page int, gray binary, error string")

    def backend():
        return lambda parts: [json.dumps({"texts": [p.decode()], "n": len(parts)}) for p in parts]

    pages, seen = pipeline.page_counters(ingest.recognised(images.coalesce(1), backend, 3).unionByName(spark.createDataFrame([("b", 8, "{x"), ("b", 9, None)], PAGES)))
    found = {r.page: r.value and r.value[:4] != "{x" and json.loads(r.value) for r in pages.collect()}
    assert [found[k]["texts"] for k in range(1, 8)] == [[f"t{k}"] for k in range(1, 8)] and max(found[k]["n"] for k in range(1, 8)) == 3
    assert seen.get == {"existing": 8, "created": 7}


def test_files_in_the_order_of_their_paths(spark, tmp_path):
    for f in ("b.pdf", "a.pdf", "c.txt"):
        (tmp_path / f).write_bytes(b"%PDF")
    assert [(r.book, r.idx) for r in ingest.pdf_listing(spark, None, str(tmp_path)).orderBy("idx").collect()] == [("a", 0), ("b", 1)]


def test_persons_of_a_model(spark):
    df = spark.createDataFrame([(1, "Acme met Jane Doe in Paris. Al Bo"), (2, None), (3, "no one")], "k int, text string")
    assert sorted((r.k, r.name) for r in names_in(df, ["k"], SpacyRecognizer()).collect()) == [(1, "Al Bo"), (1, "Jane Doe")]
    found = df.select("k", SpacyRecognizer().entities(F.col("text")).alias("e")).orderBy("k").collect()
    assert [(e.text, e.label, e.start) for e in found[0].e] == [("Acme", "ORG", 0), ("Jane Doe", "PERSON", 9), ("Paris", "ORG", 21), ("Al Bo", "PERSON", 28)]
    assert found[1].e == []


def test_the_first_person_is_split(spark):
    first = spark.createDataFrame([("john", 9, 0), ("mary", 5, 1)], "name string, weight int, idx int")
    last = spark.createDataFrame([("smith", 1, 0), ("jones", 2, 1)], "name string, weight int, idx int")
    values = ["acme john smith jr", "jon smyth acme mary jones", "acme paris", "mary jones, acme", "", "paris mary smth III"]
    names = spark.createDataFrame([(v,) for v in values] * 2, "name string")
    corrector = correct.NameCorrector(first, last, recognizer=SpacyRecognizer())
    split = {r.name: (r.p.given, r.p["last"], r.p.suffix) for r in corrector.split(names).collect()}
    assert split == {
        "acme john smith jr": (["John"], "Smith", "Jr"), "jon smyth acme mary jones": (["Jon"], "Smyth", ""), "acme paris": (["Acme"], "Paris", ""),
        "mary jones, acme": (["Mary"], "Jones", "Acme"), "": ([], "", ""), "paris mary smth III": (["Mary"], "Smth", "Iii"),
    }
    done = {r.name: r.corrected for r in corrector.correct(names).collect()}
    assert done["acme john smith jr"] == "John Smith, Jr" and done["jon smyth acme mary jones"] == "John Smith" and done["paris mary smth III"] == "Mary Smith, Iii" and done[""] == ""
    whole = names.select("name", first_person(F.col("name"), None).alias("w")).where("name <> w").count()
    assert whole == 0


def test_stamps_in_any_time_zone(spark):
    df = spark.createDataFrame([(1_604_214_000,), (1_583_650_800,), (0,)], "s long").select(fn.utc_stamp(F.timestamp_seconds("s")).alias("t"))
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        found = [r.t for r in df.collect()]
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert found == ["2020-11-01T07:00:00Z", "2020-03-08T07:00:00Z", "1970-01-01T00:00:00Z"]


def test_similarity_with_a_processor(spark):
    df = spark.createDataFrame([("SMTH", "smith", "x"), (None, "", "x")], "a string, b string, c string")
    assert [r[0] for r in df.select(fn.similarity(F.col("a"), F.col("b"), processor=F.lower)).collect()] == [50.0, 100.0]
