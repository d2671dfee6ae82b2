"""Round trips through files, streaming, and queries against their SQL."""

import json

import duckdb
import pytest

from cardloom import schemas
from cardloom.operators.layout import cards
from cardloom.operators import state
from cardloom.operators.merge import not_blank
from cardloom.sources import files, sinks
from cardloom.streaming import levels, resume

PAGES = [
    {"file": "a.pdf", "page": 1, "ok": True, "line_texts": ["old"], "raw": {"data": {"line_rects": []}}},
    {"file": "a.pdf", "page": 1, "ok": True, "line_texts": ["张三", "Acme Co., Ltd"], "raw": {"data": {"line_rects": [{"x": 1, "y": 1}, {"x": 1, "y": 30}]}}},
    {"file": "a.pdf", "page": 2, "ok": False, "error": "quota", "http_like_code": 50400},
    {"file": "a.pdf", "page": None, "ok": True},
]


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "ocr_results.jsonl").write_text("\n\n".join(json.dumps(p, ensure_ascii=False) for p in PAGES) + "\n", encoding="utf-8")
    return tmp_path


def test_pages(spark, folder):
    path = str(folder / "in" / "ocr_results.jsonl")
    rows = {r.page: r for r in files.pages(spark, path).collect()}
    assert sorted(rows) == [1, 2] and rows[1].line_texts[0] == "张三"
    good = files.good_pages(spark, path)
    assert good.count() == 3 and cards(good).count() == 18
    sinks.write_pages(files.pages(spark, path), str(folder / "out"))
    assert sorted(p.name for p in (folder / "out").iterdir()) == ["ocr_contacts.csv", "ocr_failed.csv"]
    with pytest.raises(Exception):
        (folder / "in" / "bad.jsonl").write_text("{not json\n")
        files.json_lines(spark, str(folder / "in" / "bad.jsonl")).collect()
    assert files.results(spark, str(folder / "none.jsonl")).count() == 0


def test_partitions_of_cards(spark, folder):
    for run in ("r1", "r2"):
        (folder / run).mkdir()
        rows = [{"file": "f", "page": 1, "card_no": i, "has_text": i == 1, "line_texts": ["x"]} for i in (1, 2)]
        (folder / run / "ocr_card_results.jsonl").write_text("\n".join(map(json.dumps, rows)))
    found = files.partition_cards(spark, str(folder), [("r1", "A"), ("r2", "B")]).collect()
    assert sorted(r.card_key for r in found) == ["A|f|1|1", "B|f|1|1"]
    assert [r.source_label for r in files.partition_cards(spark, str(folder), [("r1", "A"), ("r2", "B")], only="B").collect()] == ["B"]
    with pytest.raises(Exception):
        files.partition_cards(spark, str(folder), [("r3", "C")]).collect()


def test_csv_in_two_encodings(spark, folder):
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    (folder / "u.csv").write_bytes("﻿name,phones\n张三,\"1,\"\"2\"\n".encode())
    (folder / "g.csv").write_bytes("name,phones\n李四,3\n".encode("gb18030"))
    rows = files.csv_rows(spark, [str(folder / "u.csv"), str(folder / "g.csv")])
    assert sorted(map(tuple, rows.collect())) == [("张三", '1,"2'), ("李四", "3")]


    given = files.csv_rows(spark, str(folder / "g.csv"), encoding="GB18030", lines=False)
    assert given.first().name == "李四"
    (folder / "empty.csv").write_bytes(b"")
    assert files.csv_rows(spark, str(folder / "empty.csv"), "name string, phones string").count() == 0


def test_changed_input_starts_anew(spark, folder):
    import os

    path = folder / "in" / "scan.pdf"
    path.write_bytes(b"one")
    os.utime(path, (1, 1))
    first = files.inputs(spark, str(folder / "in"), ["pdf"])
    units = first.selectExpr("run", "input_fingerprint", "explode(array(1, 2)) AS unit")
    log = state.logged(units.selectExpr("*", "unit = 1 AS ok", "5L AS tokens"))
    assert log.columns == [c.split()[0] for c in schemas.RUN_LOG.split(", ")]
    log = spark.createDataFrame(log.collect(), log.schema)
    assert [r.unit for r in state.pending_units(units, log).collect()] == ["2"]
    total = first.selectExpr("run", "input_fingerprint", "2 AS total_units")
    assert [(r.status, r.n_ok, r.tokens) for r in state.status(total, log).collect()] == [("interrupted", 1, 10)]
    path.write_bytes(b"other")
    again = files.inputs(spark, str(folder / "in"), ["pdf"]).selectExpr("run", "input_fingerprint", "explode(array(1, 2)) AS unit")
    assert sorted(r.unit for r in state.pending_units(again, log).collect()) == ["1", "2"]


def test_page_documents(spark, folder, monkeypatch):
    """The splitting of documents and the change of images, with modules in their libraries' place."""
    place = folder / "modules"
    place.mkdir()
    (place / "pypdf.py").write_text(
        "class PdfReader:\n    def __init__(self, f):\n        data = f.read()\n        if data == b'bad':\n            raise ValueError('no pages')\n        self.pages = data.split(b'|')\n"
        "class PdfWriter:\n    def add_page(self, page):\n        self.page = page\n    def write(self, out):\n        out.write(self.page)\n"
    )
    for name, content in (("a.pdf", b"one|two"), ("b.pdf", b"bad")):
        (folder / name).write_bytes(content)
    spark.sparkContext.addPyFile(str(place / "pypdf.py"))
    rows = files.pdf_pages(spark, [str(folder / "a.pdf"), str(folder / "b.pdf")]).collect()
    assert sorted((r.page or 0, r.content and bytes(r.content), r.error) for r in rows) == [(0, None, "ValueError: no pages"), (1, b"one", None), (2, b"two", None)]
    images = spark.createDataFrame([("a.JPG", b"x"), ("b.heic", b"y")], "path string, content binary")
    found = [r.c and bytes(r.c) for r in images.select(files.as_jpeg(images.path, images.content).alias("c")).collect()]
    assert found == [b"x", None]  # null without the library


def test_commands(spark, folder):
    """Chain B from cards to its workbook, with answers as the service's own text; pages to contacts."""
    import argparse

    from cardloom import cli

    def args(*given, **more):
        return argparse.Namespace(**({"input": list(given), "output": "", "workbook": None, "provider": None, "model": "m-1"} | more))

    (folder / "service.py").write_text(
        "import json\ndef ask(batch):\n    cards = [{'card_key': c['card_key'], 'name': 'Li Lei', 'mobiles': ['13900000001']} for c in batch]\n"
        "    return '```json\\n' + json.dumps({'cards': cards}) + '\\n```', 3\n"
    )
    spark.sparkContext.addPyFile(str(folder / "service.py"))
    cards = spark.createDataFrame(
        [("P|f|1|1", "P", "d", "f", 1, 1, "r1c1", ["x"], None), ("P|f|1|2", "P", "d", "f", 1, 2, "r1c2", ["y"], None)],
        "card_key string, source_label string, source_dataset string, file string, page int, card_no int, grid_pos string, line_texts array<string>, extracted string",
    )
    cards.write.parquet(str(folder / "work"))
    for _ in range(2):  # the second run has nothing left to ask
        cli.enriched(spark, args(str(folder / "work"), output=str(folder / "answers"), provider="service:ask"))
    answers = spark.read.parquet(str(folder / "answers"))
    assert answers.count() == 2 and {r.name_std for r in answers.collect()} == {"Li Lei"} and answers.agg({"tokens": "sum"}).first()[0] == 3
    spark.createDataFrame([("P", "f", 1, 1, "13900000001")], "source_label string, file string, page int, card_no int, phone_normalized string").write.parquet(str(folder / "a"))
    cli.exported(spark, args(str(folder / "a"), str(folder / "answers"), output=str(folder / "out"), workbook=str(folder / "b.xlsx")))
    assert spark.read.parquet(str(folder / "out" / "phone_processed")).count() == 2
    figures = {r.metric: r.value for r in files.sheet_rows(spark, str(folder / "b.xlsx"), ["metric", "value"], "处理统计").collect()}
    assert len(figures) == 14 and figures["llm_cards_processed"] == "2.0" and figures["phones_in_both"] == "1.0"
    cli.extract(spark, args(str(folder / "in" / "ocr_results.jsonl"), output=str(folder / "pages")))
    assert "Acme" in "".join(p.read_text(encoding="utf-8") for p in (folder / "pages" / "ocr_contacts.csv").glob("*.csv"))


def test_run_of_all_stages(spark, folder):
    """Stages in turn with the log of what is done: nothing is asked twice, a failed stage comes again, changed inputs start anew."""
    import argparse

    from cardloom import cli

    (folder / "asking.py").write_text(
        "import os\ndef ask(batch):\n    if os.path.exists(%r):\n        raise ValueError('down')\n"
        "    return [{'card_key': c['card_key'], 'name': 'Li Lei', 'mobiles': ['13900000001']} for c in batch], 1\n" % str(folder / "down")
    )
    spark.sparkContext.addPyFile(str(folder / "asking.py"))
    page = json.loads(json.dumps(PAGES[1])) | {"page": 7, "ok": True, "line_texts": ["Li Lei", "Tel: +86 139 0000 0001"]}
    (folder / "in" / "more.jsonl").write_text(json.dumps(page) + "\n")
    given = argparse.Namespace(input=[str(folder / "in")], output=str(folder / "out"), workbook=None, provider="asking:missing", model="m-1", label="P")
    with pytest.raises(AttributeError):
        cli.run(spark, given)
    log = spark.read.parquet(str(folder / "out" / "run_log"))
    assert [(r.unit, r.ok) for r in log.orderBy("at").collect()] == [("extract", True), ("cut", True), ("expand", True), ("enrich", False)]
    given.provider = "asking:ask"
    cli.run(spark, given)
    log = spark.read.parquet(str(folder / "out" / "run_log"))
    assert [(r.unit, r.ok) for r in log.orderBy("at").collect()][4:] == [("enrich", True), ("export", True), ("compare", True)]
    said = json.loads((folder / "out" / "run.json").read_text())
    assert said["status"] == "completed" and said["started_at"].endswith("Z")
    cli.run(spark, given)
    assert spark.read.parquet(str(folder / "out" / "run_log")).count() == 7
    metrics = {r.metric: r.value for r in spark.read.parquet(str(folder / "out" / "report" / "overview")).collect()}
    assert len(metrics) == 20 and metrics["llm_unique_phones"] == 1 and metrics["phones_in_both"] == 1
    (folder / "in" / "last.jsonl").write_text(json.dumps(page | {"page": 8}) + "\n")
    cli.run(spark, given)
    assert spark.read.parquet(str(folder / "out" / "run_log")).count() == 13


def test_lines_that_are_malformed_are_kept_apart(spark, folder):
    (folder / "lines.jsonl").write_text('{"a": 1}\n\n{"a": \n{"a": "x"}\nnull\n{"a": 2, "b": 3}\n')
    good, bad = files.json_lines_apart(spark, str(folder / "lines.jsonl"), "a int")
    assert sorted(r.a for r in good.collect()) == [1, 2] and sorted(r.text for r in bad.collect()) == ["null", '{"a": ', '{"a": "x"}']
    assert bad.first().path.endswith("lines.jsonl")
    log = files.lines_log(good, bad, "r", "f")
    inputs = spark.createDataFrame([("r", "f", 5)], "run string, input_fingerprint string, total_units long")
    found = state.status(inputs, log).first()
    assert (found.status, found.n_ok, found.n_failed) == ("interrupted", 2, 3) and found.last_error.startswith("malformed line: ")


def test_workbook(spark, folder):
    rows = spark.createDataFrame([("a & <b>", True, None), ("", None, ["x", "y"])], "name string, ok boolean, phones array<string>")
    path = str(folder / "book.xlsx")
    sinks.write_workbook({"phone_processed": rows, "other": rows.limit(0)}, path)
    back = files.sheet_rows(spark, path, ["name", "ok", "phones", "none"])
    assert [(r.name, r.ok, r.phones, r.none) for r in back.orderBy("ord").collect()] == [("a & <b>", "True", "", ""), ("", "", "x;y", "")]
    blank = spark.createDataFrame([("",), ("x",)], "name string")
    assert not_blank(blank).count() == 1


def test_large_workbook_is_read_by_several_tasks(spark, folder, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(files, "PART_BYTES", 20_000)
    rows = spark.range(9000).selectExpr("cast(id as string) AS a", "concat('row ', id) AS b")
    sinks.write_workbook({"phone_processed": rows.orderBy(F.col("a").cast("long"))}, str(folder / "large.xlsx"))
    found = files.sheet_rows(spark, str(folder / "large.xlsx"), ["a", "b"])
    got = found.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.ord, r.a, r.b) for r in got) == [(i, str(i), f"row {i}") for i in range(9000)]
    assert len({r.task for r in got}) > 1


def test_listing_and_atomic_json(spark, folder):
    for name in ("b.PDF", "a.jpg", "c.txt"):
        (folder / "in" / name).write_bytes(b"x")
    names = [r.path.rsplit("/", 1)[1] for r in files.listed(spark, str(folder / "in")).orderBy("path").collect()]
    assert names == ["a.jpg", "b.PDF"]
    sinks.write_json_atomically({"x": "张"}, str(folder / "state" / "c.json"))
    assert json.loads((folder / "state" / "c.json").read_text()) == {"x": "张"}


def test_streams_resume(spark, folder):
    stream = resume.new_cards(resume.page_stream(spark, str(folder / "in")))
    for _ in range(2):
        resume.append(stream, str(folder / "cards"), str(folder / "check")).awaitTermination()
    assert spark.read.parquet(str(folder / "cards")).count() == 18  # three good pages, once each
    (folder / "in" / "more.jsonl").write_text(json.dumps(PAGES[1] | {"page": 3}))
    resume.append(stream, str(folder / "cards"), str(folder / "check")).awaitTermination()
    assert spark.read.parquet(str(folder / "cards")).count() == 24


def test_batches_upsert(spark, folder):
    rows = spark.readStream.schema(schemas.PAGE).json(str(folder / "in")).where("page IS NOT NULL").selectExpr("file", "page", "ok", "size(line_texts) AS o")
    work = resume.upsert_into(spark, str(folder / "table"), ["file", "page"], "o")
    resume.each_batch(rows, work, str(folder / "check2")).awaitTermination()
    found = resume.latest(spark, str(folder / "table"), ["file", "page"], "o")
    assert sorted((r.page, r.o) for r in found.collect()) == [(1, 2), (2, None)] and found.columns == ["file", "page", "ok", "o"]
    resume.compacted(spark, str(folder / "table"), str(folder / "small"), ["file", "page"], "o")
    resume.upsert_into(spark, str(folder / "small"), ["file", "page"], "o")(spark.createDataFrame([("a.pdf", 2, True, 9)], "file string, page int, ok boolean, o int"), 0)
    assert sorted((r.page, r.o) for r in resume.latest(spark, str(folder / "small"), ["file", "page"], "o").collect()) == [(1, 2), (2, 9)]


def test_runs_are_the_digits_of_the_number_of_batches():
    assert levels.runs_of(23, 4) == [(2, 0), (1, 16), (0, 20), (0, 21), (0, 22)] and levels.runs_of(0, 4) == [] and levels.runs_of(1, 2) == [(0, 0)]
    for n in range(1, 300):
        own = [i for level, first in levels.runs_of(n, 3) for i in range(first, first + 3**level)]
        assert own == list(range(n)) and len(levels.runs_of(n, 3)) <= 2 * 6


def explained(df):
    import contextlib
    import io

    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_pages_are_written_in_parts(spark, folder):
    """Results of pages are sorted by many tasks, a range of events each, and the order of files is that of events."""
    from cardloom.plans import queries

    (folder / "sf").mkdir()
    spark.range(2000).selectExpr("id AS event_id", "id % 50 AS user_id", "'view' AS event_type").repartition(3).write.parquet(str(folder / "sf" / "events.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = queries._written_pages(spark, str(folder / "sf"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = files.json_lines(spark, path).selectExpr("ord", "ord.file_path AS file_path", "cast(line_texts[1] AS bigint) AS event_id")
    assert rows.select("file_path").distinct().count() > 1
    assert [r.event_id for r in rows.orderBy("ord").collect()] == list(range(2000))


def test_live_status(spark, folder):
    """Entries of several batches with a restart between them, and a run that falls silent."""
    from datetime import UTC, datetime, timedelta

    from cardloom.streaming import status

    began = datetime(2024, 1, 1, tzinfo=UTC)

    def entry(run, unit, ok, minute, error=None, fatal=False, tokens=2):
        return run, "f", unit, ok, fatal, error, tokens, began + timedelta(minutes=minute)

    inputs = spark.createDataFrame([("a", "f", 2), ("b", "f", 2), ("c", "f", 1), ("d", "f", 9), ("e", "f", 9)], "run string, input_fingerprint string, total_units int")
    (folder / "log").mkdir()
    stream = spark.readStream.schema(schemas.RUN_LOG).parquet(str(folder / "log"))
    batches = [
        [entry("a", "1", True, 0), entry("b", "1", False, 0, "slow"), entry("b", "2", False, 1, "late"), entry("d", "1", True, 1), ("a", "old", "9", True, False, None, 1, began)],
        [entry("a", "2", True, 2), entry("b", "2", True, 2), entry("c", "1", False, 2, "denied", True), entry("a", "1", True, -5, tokens=50)],
        [entry("b", "1", True, 40)],
        [entry("d", "2", True, 90), entry("b", "1", True, 91)],
    ]
    said = []
    for rows in batches:
        spark.createDataFrame(rows, schemas.RUN_LOG).write.mode("append").parquet(str(folder / "log"))
        status.kept(status.live(stream, inputs), str(folder / "live"), str(folder / "check3")).awaitTermination()
        found = status.current(spark, str(folder / "live"), inputs)
        expected = {r.run: r for r in state.status(inputs, spark.read.schema(schemas.RUN_LOG).parquet(str(folder / "log"))).collect()}
        got = {r.run: r for r in found.collect()}
        columns = ["n_ok", "n_failed", "tokens", "updated_at", "last_error"]
        assert all([r[c] for c in columns] == [expected[k][c] for c in columns] for k, r in got.items())
        said.append({k: r.status for k, r in got.items()})
        assert all(s == expected[k].status for k, s in said[-1].items() if k != "d")
    assert [x["d"] for x in said] == ["running", "running", "interrupted", "running"]
    assert [x["b"] for x in said] == ["interrupted", "interrupted", "completed", "completed"] and said[-1]["c"] == "fatal" and said[-1]["e"] == "pending"


def test_live_status_in_pieces(spark, folder):
    """The units of one run are folded by many keys, blocks that come again are merged, and the sums are those of the whole log."""
    from cardloom.streaming import status

    inputs = spark.createDataFrame([("a", "f", 3000)], "run string, input_fingerprint string, total_units int")
    (folder / "log").mkdir()
    stream = spark.readStream.schema(schemas.RUN_LOG).parquet(str(folder / "log"))
    for n in range(2):
        rows = spark.range(n * 1000, n * 1000 + 2000).selectExpr(
            "'a' AS run", "'f' AS input_fingerprint", "cast(id AS string) AS unit", f"id % 7 <> {n} AS ok", "false AS fatal",
            f"CASE WHEN id % 7 = {n} THEN concat('error ', id) END AS error", "id % 5 AS tokens", f"timestamp_seconds(10000 * {n} + id + 1) AS at",
        )
        rows.write.mode("append").parquet(str(folder / "log"))
        status.kept(status.live(stream, inputs, quiet="1000 days"), str(folder / "live"), str(folder / "check")).awaitTermination()
        columns = ["run", "status", "n_ok", "n_failed", "tokens", "updated_at", "last_error"]
        whole = state.status(inputs, spark.read.schema(schemas.RUN_LOG).parquet(str(folder / "log"))).select(*columns).collect()
        assert status.current(spark, str(folder / "live"), inputs).select(*columns).collect() == whole
    assert spark.read.parquet(str(folder / "live")).select("run", "piece").distinct().count() > 8


def test_upserts_in_levels(spark, folder):
    """After every batch, also one that comes twice, the last row of each key; few runs are read, and only some buckets for some keys."""
    import random

    rng, at = random.Random(3), levels.Levels(str(folder / "levels"), ("k", "j"), "o", fanout=2, buckets=4)
    expected, schema = {}, "k int, j string, o int, v string, first int"
    for n in range(9):
        rows = [(rng.randrange(12), rng.choice("ab"), rng.randrange(5), f"{n}-{i}", 7) for i in range(10)]
        best = {}
        for r in [*rows, (None, "a", 1, "dropped", 7)]:
            if r[0] is not None and r[2] > best.get(r[:2], (0, 0, -1))[2]:
                best[r[:2]] = r
        unique = [r for r in rows if r is best[r[:2]]]  # of equal order any row would do
        expected |= {r[:2]: r for r in unique}
        batch = spark.createDataFrame([*unique, (None, "a", 1, "dropped", 7)], schema)
        for _ in range(2 if n == 5 else 1):
            at.put(batch, n)
        if n in (0, 5, 8):
            assert sorted(tuple(r) for r in at.read(spark, n + 1).select("k", "j", "o", "v", "first").collect()) == sorted(expected.values())
    found = at.read(spark, 9)
    places = {p.split("/level=")[1].split("/_bucket")[0] for p in found.inputFiles()}
    assert places == {"3/first=0", "0/first=8"}
    some = spark.createDataFrame([(k, "a") for k in (1, 2)], "k int, j string")
    assert sorted(tuple(r) for r in at.look_up(some, 9).collect()) == sorted(v for k, v in expected.items() if k in ((1, "a"), (2, "a")))
    assert "PartitionFilters: [_bucket" in explained(at.look_up(some, 9))
    at.forget(spark, 9)
    assert at.read(spark, 9).count() == len(expected) and spark.read.parquet(f"{folder}/levels/level=0/first=3").isEmpty()
    at.put(spark.createDataFrame([(99, "z", 1, "new", 7)], schema), 9)
    assert at.read(spark, 10).count() == len(expected) + 1


def test_queries_equal_their_sql(spark):
    from cardloom.plans.queries import ORACLES, QUERIES

    folder, db = "/root/testdata/sf0.001", duckdb.connect()
    for name in ("region", "customer", "nation", "orders", "documents", "pages", "events", "conversations"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, folder)
        found = db.execute(sql)
        at = [[d[0] for d in found.description].index(c) for c in got.columns]
        assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr(tuple(r[i] for i in at)) for r in found.fetchall()), name
