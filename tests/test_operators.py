"""Merging, comparing, state and enrichment on small tables."""

from datetime import datetime

import pytest

from cardloom.operators import compare, enrich, merge, phones, state

ROWS = "source_label string, file string, page int, card_no int, ord int, name string, company string, phone_normalized string"
B_ROWS = "source_label string, file string, page int, card_no int, ord int, name_std string, company_std string, is_key_person boolean, phone_normalized string"


def sides(spark):
    a = [("P", "f", 1, 1, 0, "", "Acme", "1"), ("P", "f", 1, 1, 1, "Li", "Other", "2"), ("P", "f", 1, 2, 2, " ", None, "3"), ("P", "f", 1, 3, 3, "X", "", "4")]
    b = [("P", "f", 1, 1, 0, "Li", "", False, "2"), ("P", "f", 1, 1, 1, "", "A", True, "1"), ("P", "f", 1, 2, 2, "", "", None, "9"), ("P", "f", 1, 4, 3, "", "", False, "8"), ("P", "f", 1, 5, 4, "", "", True, "")]
    return spark.createDataFrame(a, ROWS), spark.createDataFrame(b, B_ROWS)


def test_comparison(spark):
    a, b = sides(spark)
    m = compare.overview(a, b).first()
    assert len(m) == 20
    assert (m.rule_phone_rows, m.llm_phone_rows, m.rule_unique_phones, m.llm_unique_phones, m.phones_in_both, m.phones_only_in_rule, m.phones_only_in_llm) == (4, 5, 4, 4, 2, 2, 2)
    assert (m.cards_phone_set_equal, m.cards_phone_set_diff, m.cards_only_rule_has_phone, m.cards_only_llm_has_phone) == (1, 1, 1, 1)
    assert (m.llm_cards_in_export, m.llm_kp_cards, m.llm_kp_rows, m.llm_non_kp_rows, m.cards_with_name_rule, m.cards_with_company_rule, m.cards_with_name_std_llm) == (4, 2, 2, 3, 2, 1, 1)
    first = {r.card_key: r for r in compare.by_card(a).collect()}["P|f|1|1"]
    assert (first.name, first.company, first.phones) == ("Li", "Acme", ["1", "2"])
    assert [(r.card_key, r.phones_a, r.phones_b) for r in compare.card_diffs(a, b).collect()] == [("P|f|1|2", "3", "9"), ("P|f|1|3", "4", ""), ("P|f|1|4", "", "8")]
    assert compare.card_diffs(a, b, most=1).count() == 1
    assert sorted(r.phone for r in compare.phone_diffs(a, b).collect()) == ["3", "4", "8", "9"]
    sheets = compare.compared(a, b, calls=2, tokens=10).sheets()
    assert sheets["overview"].count() == 20 and sheets["conclusion"].count() == 6


def test_comparison_of_nothing(spark):
    a, b = (x.limit(0) for x in sides(spark))
    assert set(compare.overview(a, b).first().asDict().values()) == {0}
    assert compare.card_diffs(a, b).count() == 0 and compare.rule_and_llm(a, b, spark.createDataFrame([], "mobiles array<string>, is_key_person boolean")).first().llm_kp_rate_pct == 0


def test_merge_and_summary(spark):
    first = spark.createDataFrame([("1", "x"), ("", None)], "phone string, name string")
    second = spark.createDataFrame([("2", "dropped")], "phone string, more string")
    rows = merge.merged({"A": first, "B": second, "C": first.limit(0)}, dataset="d")
    assert sorted(map(tuple, rows.collect())) == [("A", "d", "1", "x"), ("B", "d", "2", "")]
    found = merge.summary(rows, merge.partition_dim(spark, [("r1", "A"), ("r2", "B"), ("r3", "C")]), total="all")
    assert [(r.source_label, r.row_count) for r in found.collect()] == [("A", 1), ("B", 1), ("C", 0), ("all", 2)]
    assert merge.partition_dim(spark).count() == 12
    with pytest.raises(ValueError):
        merge.merged({})


def test_state(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 9, "x"), (2, 1, "c")], "k int, o int, v string")
    assert sorted((r.k, r.v) for r in state.keep_last(rows, ["k"], "o").collect()) == [(1, "b"), (2, "c")]
    new = spark.createDataFrame([(2, 5, "z"), (3, 1, "n")], "k int, o int, v string")
    assert sorted((r.k, r.v) for r in state.upserted(rows, new, ["k"], "o").collect()) == [(1, "b"), (2, "z"), (3, "n")]
    clash = spark.createDataFrame([(1, 1, "a", "x")], "k int, o int, _new string, place string")
    assert [tuple(r) for r in state.upserted(clash, clash.limit(0), ["k"], "o").collect()] == [(1, 1, "a", "x")]
    work = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    results = spark.createDataFrame([(1, True), (2, False), (3, None)], "k int, ok boolean")
    assert sorted(r.k for r in state.pending_pages(work, results, ["k"]).collect()) == [2, 3, 4]
    good, failed = state.split_ok(results)
    assert (good.count(), failed.count()) == (1, 2)
    t = datetime(2026, 1, 1)
    log = spark.createDataFrame([("a", "f", "1", True, False, None, 3, t), ("b", "f", "1", False, True, "quota", 0, t), ("c", "old", "1", True, False, None, 1, t), ("d", "f", "1", False, False, "e", 0, t)], "run string, input_fingerprint string, unit string, ok boolean, fatal boolean, error string, tokens bigint, at timestamp")
    inputs = spark.createDataFrame([(x, "f", 1) for x in "abcd"], "run string, input_fingerprint string, total_units int")
    assert {r.run: r.status for r in state.status(inputs, log).collect()} == {"a": "completed", "b": "fatal", "c": "pending", "d": "interrupted"}
    runs = spark.createDataFrame([("P2PartA",), ("P3PartB",)], "tag string")
    assert [r.tag for r in state.without_parts(runs, ["B"]).collect()] == ["P2PartA"]
    files = spark.createDataFrame([("/x/run_1", t), ("/x/other", datetime(2027, 1, 1))], "path string, modified timestamp")
    assert state.latest_run(files, "^run_").first().path == "/x/run_1"


def provider():
    """A scripted service; a closure, so that workers need not import this file."""

    def scripted(batch):
        if any(c["card_key"] == "bad" for c in batch):
            raise ValueError("no JSON")
        if any(c["card_key"] == "last" for c in batch):
            raise RuntimeError("quota exceeded")
        answers = [{"card_key": c["card_key"], "name": "Li Lei", "mobiles": "139 0000 0001;13900000002", "is_key_person": "false"} for c in batch if c["card_key"] != "none"]
        return [*answers, {"card_key": "unknown"}, {"card_key": "two", "name": "Han", "mobiles": [13900000003], "is_key_person": 0}], 7

    return scripted


def test_enrichment_resumes(spark):
    cards = spark.createDataFrame([(k, [k], None) for k in ("one", "two", "none", "bad", "done")], "card_key string, line_texts array<string>, extracted string")
    done = spark.createDataFrame([("done", None)], "card_key string, error string")
    rows = {r.card_key: r for r in enrich.standardise(cards, done, provider(), "m-1", batch=1, retries=1, wait=0.0, at_once=1).collect()}
    assert sorted(rows) == ["bad", "none", "one", "two"]
    assert rows["one"].mobiles == ["13900000002"] and rows["one"].is_key_person and rows["one"].tokens == 7
    assert rows["two"].name_std == "Han" and rows["two"].mobiles == ["13900000003"] and not rows["two"].is_key_person
    assert rows["none"].name_std == "" and rows["none"].error is None and "no JSON" in rows["bad"].error and not rows["bad"].fatal


def test_final_error_ends_the_calls(spark):
    cards = spark.createDataFrame([(k, [], None) for k in ("last", "x", "y")], "card_key string, line_texts array<string>, extracted string").coalesce(1)
    rows = enrich.call(cards, provider(), batch=1, wait=0.0).collect()
    assert all(r.fatal for r in rows) and len(rows) == 3


def test_answers_as_text():
    rows = [{"card_key": "a"}]
    for text in ('[{"card_key": "a"}]', '```json\n{"cards": [{"card_key": "a"}]}\n```', '```\n[{"card_key": "a"}]```', rows):
        assert enrich._parsed(text) == rows
    for text in ("no JSON", '"x"', "3"):
        with pytest.raises(ValueError):
            enrich._parsed(text)
    assert enrich.provider_at("json:dumps")([]) == "[]"


def test_phone_rows(spark):
    cards = spark.createDataFrame([("a", "13900000001;13900000001"), ("b", ""), ("c", None)], "k string, phones string")
    assert [(r.k, r.phone_normalized) for r in phones.phone_rows(cards).collect()] == [("a", "13900000001")]


def test_calls_in_flight(spark):
    """Eight slow calls at a time in one task take about an eighth of the time, and give the same rows."""
    import time

    def slow(batch):
        time.sleep(0.15)
        return [{"card_key": c["card_key"], "name": f"name {c['card_key']}"} for c in batch], 1

    cards = spark.createDataFrame([(str(i), ["x"], None) for i in range(64)], "card_key string, line_texts array<string>, extracted string").coalesce(1)
    took, rows = {}, {}
    for n in (1, 8):
        began = time.perf_counter()
        rows[n] = sorted((r.card_key, r.answer.name, r.tokens) for r in enrich.call(cards, slow, batch=1, in_flight=n).collect())
        took[n] = time.perf_counter() - began
    assert rows[1] == rows[8] and len(rows[8]) == 64
    assert took[1] > 64 * 0.15 and took[8] < 0.3 * took[1]


def test_answers_come_in_large_batches(spark):
    """Answers of many calls are one batch, and the query's calls are dealt to several tasks though its table is one small file."""
    made = list(enrich._gathered([enrich._row(str(i), {}, 0)] for i in range(2 * enrich.SENT + 1)))
    assert len(made) <= 4 and [x for b in made for x in b.column(0).to_pylist()] == [str(i) for i in range(2 * enrich.SENT + 1)]
    assert list(enrich._gathered([])) == []
    from cardloom.plans import queries

    assert queries.provider_calls(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() > 1


def test_window_of_calls_is_bounded():
    """Work is read only while the window has room, and calls that end early come first."""
    import threading

    read, gate = [], threading.Event()

    def work():
        for i in range(10):
            read.append(i)
            yield [{"i": i}]

    def ask(some):
        if some[0]["i"] == 0:
            gate.wait(10)
        return some

    found = enrich._in_flight(work(), ask, 3)
    first = [next(found)[0]["i"] for _ in range(5)]
    assert 0 not in first and len(read) <= len(first) + 3
    gate.set()
    assert sorted(first + [x[0]["i"] for x in found]) == list(range(10))


def test_final_error_stops_all_later_batches(spark, tmp_path):
    """After a final error in a batch the next one makes no call; a new attempt asks for what is left and nothing else."""
    from pyspark.errors import StreamingQueryException

    from cardloom.streaming import enriching

    class Denied(Exception):
        code = 403

    calls = spark.sparkContext.accumulator(0)

    def refusing(batch):
        calls.add(1)
        if any(c["card_key"] == "c13" for c in batch):
            raise Denied("access denied")
        return [{"card_key": c["card_key"], "name": "Li"} for c in batch], 1

    def willing(batch):
        calls.add(1)
        return [{"card_key": c["card_key"], "name": "Li"} for c in batch], 1

    schema = "card_key string, line_texts array<string>, extracted string"
    import time

    for k in range(4):  # a file a batch
        spark.createDataFrame([(f"c{i}", ["x"], None) for i in range(10 * k, 10 * k + 10)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/work")
        time.sleep(1.1)
    cards = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/work")
    place, check = f"{tmp_path}/answers", f"{tmp_path}/check"
    query = enriching.enriched(cards, refusing, "m", place, check, "one", batch=1, wait=0.0, in_flight=1)
    with pytest.raises(StreamingQueryException, match="access denied"):
        query.awaitTermination()
    assert calls.value == 14  # ten of the first batch, four of the second up to the error, none of the third
    got = {r.card_key: r.error for r in enriching.last_answers(spark, place).collect()}
    assert len(got) == 20 and sum(e is None for e in got.values()) == 13
    log = enriching.run_log(spark, place, "r", "f")
    inputs = spark.createDataFrame([("r", "f", 40)], "run string, input_fingerprint string, total_units long")
    assert state.status(inputs, log).first().status == "fatal"
    enriching.enriched(cards, willing, "m", place, check, "two", batch=1, wait=0.0).awaitTermination()
    assert calls.value == 14 + 20
    table = spark.read.schema(schema).parquet(f"{tmp_path}/work")
    enriching.catch_up(table, willing, "m", place, "two", batch=1, wait=0.0)
    assert calls.value == 14 + 20 + 7 and enriching.unanswered(table, place).count() == 0
    done = enriching.last_answers(spark, place)
    assert done.count() == 40 and {r.name_std for r in done.collect()} == {"Li"} and state.status(inputs, enriching.run_log(spark, place, "r", "f")).first().status == "completed"


def test_comparison_in_increments(spark, tmp_path):
    """Random rows, spread over increments, one of which comes twice and one of which has no rows of A: after each as if compared at once."""
    import random

    from cardloom.streaming.comparing import Comparing

    rng = random.Random(6)
    a = [("P", "f", 1, rng.randrange(12), i, rng.choice(["", " ", None, "Li", "Wu"]), rng.choice(["", "Acme"]), rng.choice(["", "1", "2", "3", "4"])) for i in range(60)]
    b = [("P", "f", 1, rng.randrange(14), i, rng.choice(["", "Li"]), rng.choice(["", "A"]), rng.choice([True, False, None]), rng.choice(["", "1", "2", "5"])) for i in range(60)]
    comparing = Comparing(str(tmp_path / "c"), fanout=2, buckets=3)
    for n, (i, j) in enumerate([(15, 20), (15, 40), (45, 41), (60, 60)]):
        start = [(0, 0), (15, 20), (15, 40), (45, 41)][n]
        for _ in range(2 if n == 2 else 1):
            comparing.take(spark.createDataFrame(a[start[0] : i], ROWS), spark.createDataFrame(b[start[1] : j], B_ROWS), n)
        whole = spark.createDataFrame(a[:i], ROWS), spark.createDataFrame(b[:j], B_ROWS)
        assert comparing.metrics(spark, n + 1).first().asDict() == compare.overview(*whole).first().asDict(), n
    assert comparing.card_sides(spark, 4).count() == compare.card_sides(*whole).count()
