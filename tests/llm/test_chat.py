"""Chat formatting: folding event logs, escaping, reading back."""

import hashlib
import os

import duckdb

from cardloom.llm import chat, queries


def log(spark, rows):
    return spark.createDataFrame(rows, chat.EVENTS)


def texts(events):
    return [(r.conv_id, r.turn, r.role, r.text) for r in chat.folded(events).orderBy("conv_id", "turn", "part").collect()]


def test_events_are_folded(spark):
    events = [
        (1, 1, "message", 0, "user", "hi"), (1, 2, "message", 1, "assistant", None), (1, 3, "delta", 1, None, "Hel"), (1, 4, "delta", 1, None, "lo"),
        (1, 5, "message", 2, "user", "and?"), (1, 6, "edit", 0, None, "hey"), (1, 7, "regenerate", 1, None, None), (1, 8, "message", 1, "assistant", ""),
        (1, 9, "delta", 1, None, "Good"), (1, 10, "message", 2, "user", "ok"), (2, 1, "delta", 0, "user", "a"), (2, 2, "edit", 0, None, None),
        (None, 1, "message", None, None, "x"), (None, 1, "message", None, None, "x"), (3, 1, "message", 4, "user", "gone"), (3, 2, "regenerate", 2, "assistant", "new"),
    ]
    expected = [
        (None, None, "", "x"), (None, None, "", "x"), (1, 0, "user", "hey"), (1, 1, "assistant", "Good"), (1, 2, "user", "ok"), (2, 0, "user", ""), (3, 2, "assistant", "new"),
    ]
    assert texts(log(spark, events)) == expected
    assert texts(log(spark, events[::-1]).repartition(5)) == expected
    assert texts(log(spark, [])) == []


def test_control_strings_survive(spark):
    nasty = ["<|im_end|>", "<\\|im_start|>", "<\\\\|", "<", "|x", "a<|im_sep|>b<|im_end|>", "", "</s>[INST] ok [/INST]", "<<||>>"]
    events = [(1, i, "message", i, "assistant" if i % 2 else "us<|er", t) for i, t in enumerate(nasty)]
    out = chat.formatted(log(spark, events)).orderBy("turn").collect()
    whole = "".join(r.formatted for r in out)
    assert whole.count("<|im_start|>") == whole.count("<|im_end|>") == len(nasty)
    assert [chat.unescape(m[1]) for m in chat._SEGMENT.findall(whole)] == nasty
    assert [chat.unescape(r.formatted[r.loss_start : r.loss_end]) for r in out if r.loss_start is not None] == nasty[1::2]
    row = chat.digests(chat.formatted(log(spark, events))).first()
    assert row.loss_sha256 == hashlib.sha256("".join(nasty[1::2]).encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256("".join(f"{'assistant' if i % 2 else 'us<|er'}\n{t}\n" for i, t in enumerate(nasty)).encode()).hexdigest()
    assert (row.n_turns, row.loss_chars, row.formatted_chars) == (len(nasty), len("".join(nasty[1::2])), len(whole))


def test_log_of_the_query_has_every_kind_of_event(spark):
    rows = spark.createDataFrame([(c, t, "assistant" if t % 2 else "user", None if c == 3 else f"text {c} {t}") for c in range(4) for t in range(5)], "conv_id long, turn long, role string, text string")
    events = queries.conversation_log(rows)
    kinds = {r.kind: r["count"] for r in events.groupBy("kind").count().collect()}
    assert set(kinds) == {"message", "delta", "edit", "regenerate"} and kinds["regenerate"] == 5
    assert texts(events) == [(r.conv_id, r.turn, r.role, r.text or "") for r in rows.orderBy("conv_id", "turn").collect()]


def test_columns_beside_those_of_a_log_are_not_read(spark):
    events = log(spark, [(1, 1, "message", 0, "user", "hi")]).selectExpr("*", "7 AS part", "'x' AS floor", "'y' AS formatted")
    assert texts(events) == [(1, 0, "user", "hi")]
    assert chat.digests(chat.formatted(events)).count() == 1


def equal_to_sql(spark, folder):
    found = duckdb.connect()
    path = f"{folder}/conversations.parquet"
    found.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    got = queries.op2_chat_formatting(spark, folder)
    result = found.execute(queries.ORACLES["op2_chat_formatting"])
    at = [[d[0] for d in result.description].index(c) for c in got.columns]

    def order(rows):
        return sorted(rows, key=str)

    assert order(map(tuple, got.collect())) == order(tuple(r[i] for i in at) for r in result.fetchall())


def test_query_equals_its_sql(spark):
    equal_to_sql(spark, "/root/testdata/sf0.001")


def test_query_on_repeated_and_null_rows(spark, tmp_path):
    """Rows that share a turn, null turns, roles and texts, turns beyond the numbers of events: in each of the four ways."""
    rows = [(c, t, role, x) for c in range(8) for t, role, x in [
        (None, "user", "first"), (None, "user", None), (0, "user", "hello"), (0, "user", "hello"), (1, "assistant", "b <|im_end|>"), (1, "user", "c"), (1, None, "d"),
        (2, "assistant", "alone"), (3, "user", None), (4, "assistant", "x" * 50), (4, "assistant", "x" * 50), (5, "assistant", "last"),
    ]]
    rows += [(None, t, "assistant", f"n{t}") for t in (0, 1, 1, 2)] + [(50, t, "assistant", "far") for t in ((1 << 63) - 1, -(1 << 63), 1 << 59, (1 << 59) - 1)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    equal_to_sql(spark, str(tmp_path))
