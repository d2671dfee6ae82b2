"""Fields of cards against hand-made cases."""

from pyspark.sql import functions as F

from cardloom.functions import text


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return frame.select(column.alias("x")).first()["x"]


def test_fields_of_a_card(spark):
    lines = ["　张三 ", "Acme Trading Co., Ltd", "Sales Director", "Tel: +86 139 0000 0001", "a@b.com | www.acme.cn/x y", "微信：wxid_99", "QQ 123456", "Guangzhou 路 8"]
    got = one(spark, text.extracted("v"), v=lines)
    assert (got.name, got.company, got.title, got.address) == ("张三", lines[1], lines[2], lines[7])
    assert got.phones == ["+8613900000001"] and got.emails == ["a@b.com"] and got.websites == ["www.acme.cn/x"]
    assert got.wechat_ids == ["wxid_99"] and got.qq_ids == ["123456"] and got.full_text == "\n".join(lines)


def test_no_lines_and_null_lines(spark):
    for value in ([], None):
        frame = spark.createDataFrame([(value,)], "v array<string>")
        got = frame.select(text.extracted("v").alias("x")).first()["x"]
        assert got.name is None and got.company is None and got.phones == [] and got.full_text == ""


def test_names(spark):
    cases = {"A": None, "Al": "Al", "A" * 12: "A" * 12, "A" * 13: None, "张三1": None, "张三１": None, "x@y.zz": None, "Director": "Director", "DIRECTOR": None}
    for value, page in cases.items():
        assert one(spark, text.guessed_name("v", text.PAGE), v=[value]) == page
    assert one(spark, text.guessed_name("v"), v=["A" * 30]) == "A" * 30
    assert one(spark, text.guessed_name("v"), v=["A" * 31]) is None
    assert one(spark, text.guessed_name("v"), v=["DIRECTORS", " Li Lei\t"]) == "Li Lei"


def test_keywords_are_substrings(spark):
    assert one(spark, text.first_line_with("v", text.CARD.titles), v=["x", "Our factory", "CEO"]) == "Our factory"
    assert one(spark, text.first_line_with("v", text.CARD.companies), v=["Hunan province"]) == "Hunan province"
    assert one(spark, text.first_line_with("v", text.PAGE.companies, text.PAGE), v=["acme inc", "Acme Inc"]) == "Acme Inc"


def test_phones_in_two_steps(spark):
    cases = {
        "13900000001 13900000002": (["13900000001"], ["13900000001", "13900000002"]),
        "13900000001/13900000002": (["13900000001", "13900000002"],) * 2,
        "+86 139 0000 0001": (["13900000001"], []),
        "+86-139-0000-0001": (["13900000001"],) * 2,
        "(0755) 8888 6666": ([], []),
        "１３９００００００１": ([], []),
        "8686139000000019": (["13900000001"],) * 2,
        "0086139000000011390000000、": (["13900000001"],) * 2,
    }
    for value, (chain_a, direct) in cases.items():
        assert one(spark, text.mobiles(text.joined(text.phone_candidates(F.array("v")))), v=value) == chain_a, value
        assert one(spark, text.mobiles("v"), v=value) == direct, value
    assert one(spark, text.mobiles("v"), v="13900000002;13900000001；13900000002") == ["13900000002", "13900000001"]
    assert one(spark, text.mobiles("v"), v=None) == []


def test_dirty_fields(spark):
    for value in (None, "", "x", "  ", "***", "_-_", "́́", "x.com", "HTTP", "@@@", "a lyzd1"):
        assert one(spark, text.cleaned("v"), v=value) == "", value
    for value in ("公司", "①②", "½½", "Li", "lyzdx", "***a"):
        assert one(spark, text.cleaned("v"), v=value) == value
    assert one(spark, text.cleaned("v"), v="　Li Lei\n") == "Li Lei"


def test_keys_tags_and_errors(spark):
    assert one(spark, text.card_key("a", "b", "c"), a="x", b=None, c=3) == "x||3"
    cases = {"2期A区.pdf": "P2PartA", "广交会3期 d 区.pdf": "P3PartD", "1期 B区.pdf": "PartB", "x.1期.pdf": "PartX", "一.pdf": "PartX", "第2期 kz.PDF": "P2PartK"}
    for value, tag in cases.items():
        assert one(spark, text.part_tag("v"), v=f"/in/{value}") == tag, value
    assert one(spark, text.is_fatal("s", "m", "e"), s=402, m=None, e=None)
    assert one(spark, text.is_fatal("s", "m", "e"), s=200, m="", e="Quota exceeded")
    assert not one(spark, text.is_fatal("s", "m", "e"), s=None, m="timeout", e="quota")
    assert one(spark, text.truthy("v"), v="maybe") and not one(spark, text.truthy("v"), v=None) and not one(spark, text.truthy("v"), v="false")
    assert one(spark, text.model_tag("v"), v="a-b.1") == "a_b_1"
    assert [one(spark, text.model_short("v"), v=x) for x in ("x-flash", "x-pro", "a-b")] == ["dsv4flash", "dsv4p", "ab"]


def test_utc_now(spark):
    import re
    from datetime import datetime, timezone

    now = spark.range(1).select(text.utc_now().alias("t")).first().t
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", now)
    assert abs((datetime.now(timezone.utc) - datetime.strptime(now, "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)).total_seconds()) < 120
