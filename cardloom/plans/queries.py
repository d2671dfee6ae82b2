"""Queries over the driver's tables, one per operator, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..operators import compare, enrich, layout, merge, phones, state
from ..sources import files, sinks
from ..sources.session import work_folder
from ..streaming import resume, status
from ..streaming.comparing import Comparing
from ..streaming.levels import Levels
from . import corpus
from .corpus import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


# The oracle's spelling of the patterns: explicit classes in place of Unicode ones, which agree on these tables.
_SPACE = r" \t\n\r\x0b\x0c"
_PHONE = rf"(?:\+?[0-9]{{1,4}}[-{_SPACE}]?)?(?:\(?[0-9]{{2,4}}\)?[-{_SPACE}]?)?[0-9]{{3,4}}[-{_SPACE}]?[0-9]{{4}}(?:[-{_SPACE}]?[0-9]{{1,4}})?"
_SITE = r"(?:https?://|www\.)[A-Za-z0-9.\-]+\.[A-Za-z]{2,}(?:/[^ \t\n\r\x0b\x0c\xa0]*)?"
_SEPARATE = r"[;,，/|、 \t\n\r]+"
_CARDS, _ANSWERS = corpus.cards_sql("varchar"), corpus.answers_sql("varchar")


def _found(pattern: str, column: str, group: int = 0, clean: str = "x") -> str:
    return f"array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all({column}, '{pattern}', {group}), lambda x: {clean}))), ';')"


def _mobiles(phones: str) -> str:
    """SQL for the list of mobiles of a string, in token order, repeats included."""
    return (
        f"flatten(list_transform(string_split_regex({phones}, '{_SEPARATE}'), "
        f"lambda t: regexp_extract_all(regexp_replace(t, '[^0-9+]', '', 'g'), '{fixed.MOBILE}')))"
    )


_LINES = "string_split(coalesce(text, ''), chr(10))"


def _lines(column: str = "text") -> Column:
    return F.split(F.coalesce(F.col(column), F.lit("")), "\n")


@_query(f"SELECT source_label, count(*) AS n_rows, count(DISTINCT phone) AS n_phones FROM (SELECT source_label, ord, unnest(list_distinct({_mobiles('phones')})) AS phone FROM ({_CARDS})) GROUP BY source_label")
def phone_rows_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: mobiles of all cards, one row each, counted by partition."""
    rows = phones.phone_rows(corpus.cards(spark, sf_dir))
    return rows.groupBy("source_label").agg(F.count("*").alias("n_rows"), F.count_distinct("phone_normalized").alias("n_phones"))


@_query(f"SELECT doc_id, {_found(fixed.EMAIL, 'text')} AS emails FROM documents WHERE len(regexp_extract_all(text, '{fixed.EMAIL}')) > 0")
def extract_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", text.joined(text.emails(_lines())).alias("emails"))
    return rows.where("emails <> ''")


@_query(
    f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(flatten(list_transform({_LINES}, lambda l: regexp_extract_all(l, '{_PHONE}'))), "
    f"lambda x: regexp_replace(x, '[^0-9+]', '', 'g')))), ';') AS phones FROM documents WHERE len(flatten(list_transform({_LINES}, lambda l: regexp_extract_all(l, '{_PHONE}')))) > 0"
)
def extract_phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", text.joined(text.phone_candidates(_lines())).alias("phones"))
    return rows.where("phones <> ''")


@_query(f"SELECT page_id, {_found(_SITE, 'html')} AS websites FROM pages")
def extract_websites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.joined(text.websites(F.split("html", "\n"))).alias("websites"))


_IDS = "CASE WHEN c_custkey % 3 = 0 THEN concat('WeChat: wx_', cast(c_custkey as {t}), ' | QQ：', cast(10000 + c_custkey as {t})) WHEN c_custkey % 3 = 1 THEN concat('微信', c_name, ' qq 12') ELSE concat('QQ', cast(c_custkey as {t})) END"


@_query(
    f"SELECT c_custkey, {_found('(?:微信|wechat|WeChat|WX|vx)[:： ]*([A-Za-z0-9_-]{5,})', 'line', 1)} AS wechat, {_found('(?:QQ|qq)[:： ]*([1-9][0-9]{4,11})', 'line', 1)} AS qq "
    f"FROM (SELECT c_custkey, {_IDS.format(t='varchar')} AS line FROM customer)"
)
def extract_messenger_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.array(F.expr(_IDS.format(t="string")))
    return table(spark, sf_dir, "customer").select("c_custkey", text.joined(text.wechat_ids(lines)).alias("wechat"), text.joined(text.qq_ids(lines)).alias("qq"))


def _hit(words: list[str], line: str = "l") -> str:
    return "(" + " OR ".join(f"contains(lower({line}), '{w.lower()}')" for w in words) + ")"


def _cased(words: tuple[str, ...], line: str = "l") -> str:
    return "(" + " OR ".join(f"contains({line}, '{w}')" for w in words) + ")"


@_query(
    f"SELECT doc_id, coalesce(list_filter({_LINES}, lambda l: {_hit(fixed.COMPANIES)})[1], '') AS company, coalesce(list_filter({_LINES}, lambda l: {_hit(fixed.TITLES)})[1], '') AS title, "
    f"coalesce(list_filter({_LINES}, lambda l: {_hit(fixed.ADDRESSES)})[1], '') AS address FROM documents"
)
def first_keyword_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"company": text.CARD.companies, "title": text.CARD.titles, "address": text.CARD.addresses}
    return table(spark, sf_dir, "documents").select("doc_id", *[F.coalesce(text.first_line_with(_lines(), w), F.lit("")).alias(c) for c, w in fields.items()])


_STRIPPED = f"list_transform({_LINES}, lambda l: regexp_replace(l, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g'))"


@_query(
    f"SELECT doc_id, coalesce(list_filter({_STRIPPED}, lambda l: length(l) BETWEEN 2 AND 30 AND NOT {_hit(fixed.COMPANIES + fixed.TITLES + fixed.ADDRESSES)} "
    f"AND NOT regexp_matches(l, '{fixed.EMAIL}') AND NOT regexp_matches(l, '{_SITE}') AND NOT regexp_matches(l, '[0-9]'))[1], '') AS name FROM documents"
)
def guess_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(text.guessed_name(_lines()), F.lit("")).alias("name"))


@_query(f"SELECT ord, array_to_string(list_sort(list_distinct({_mobiles('phones')})), ';') AS mobiles FROM ({_CARDS})")
def normalize_mobiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.cards(spark, sf_dir).select("ord", text.joined(F.array_sort(text.mobiles("phones"))).alias("mobiles"))


@_query(f"SELECT source_label, file, page, card_no, unnest(list_distinct({_mobiles('phones')})) AS phone_normalized FROM ({_CARDS})")
def expand_by_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phones.phone_rows(corpus.cards(spark, sf_dir)).select("source_label", "file", "page", "card_no", "phone_normalized")


_FIRST_STEP = f"array_to_string(list_transform(flatten(list_transform({_LINES}, lambda l: regexp_extract_all(l, '{_PHONE}'))), lambda x: regexp_replace(x, '[^0-9+]', '', 'g')), ';')"


@_query(f"SELECT DISTINCT doc_id, phone FROM (SELECT doc_id, unnest({_mobiles(_FIRST_STEP)}) AS phone FROM documents)")
def chain_a_mobiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of each line first, mobiles of the joined candidates then."""
    found = table(spark, sf_dir, "documents").select("doc_id", text.joined(text.phone_candidates(_lines())).alias("phones"))
    return phones.phone_rows(found, out="phone").select("doc_id", "phone")


def _cleaned(value: str) -> str:
    own = f"regexp_replace({value}, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"
    return f"CASE WHEN {value} IS NULL OR length({own}) < 2 OR regexp_full_match({own}, '[^\\p{{L}}\\p{{N}}]+') OR regexp_matches(lower({own}), 'lyzd[0-9]|\\.com|http|www\\.|@@@') THEN '' ELSE {own} END"


_B = f"SELECT *, {_cleaned('name')} AS name_std, {_cleaned('company')} AS company_std, {_cleaned('kp_role')} AS role_std, list_distinct({_mobiles('mobiles')}) AS found FROM ({_ANSWERS})"
_A_ROWS = f"SELECT source_label, file, page, card_no, ord, name, company, unnest(list_distinct({_mobiles('phones')})) AS phone FROM ({_CARDS})"
_B_ROWS = f"SELECT source_label, file, page, card_no, ord, name_std, company_std, role_std AS kp_role, is_key_person, coalesce(unnest(CASE WHEN len(found) = 0 THEN [''] ELSE found END), '') AS phone FROM ({_B})"


def _standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain B's standardised rows."""
    own = corpus.answers(spark, sf_dir)
    answer = F.struct(
        "name", "title", "company", "address", "kp_role", F.array("mobiles").alias("mobiles"), F.when(F.col("is_key_person"), "true").otherwise("false").alias("is_key_person")
    )
    kept = own.select(
        "source_label", F.lit(fixed.DATASET).alias("source_dataset"), "file", "page", "card_no", F.lit("r1c1").alias("grid_pos"), "ord",
        text.card_key("source_label", "file", "page", "card_no").alias("card_key"), F.lit("some-flash-1.0").alias("llm_model"), answer.alias("answer"),
    )
    return kept.withColumns(phones.standardised("answer")).drop("answer")


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Phone rows of both chains with their order."""
    a = phones.phone_rows(corpus.cards(spark, sf_dir))
    standard = _standard(spark, sf_dir)
    b = phones.phone_rows_outer(standard).withColumn("ord", F.col("page") * 6 + F.col("card_no") - 1)
    return a, b


@_query(f"SELECT source_label, file, page, card_no, name_std, company_std, kp_role, is_key_person, phone AS phone_normalized, 'some_flash_1_0' AS pipeline FROM ({_B_ROWS})")
def phone_rows_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = phones.phone_rows_outer(_standard(spark, sf_dir))
    return rows.select("source_label", "file", "page", "card_no", "name_std", "company_std", "kp_role", "is_key_person", "phone_normalized", "pipeline")


@_query(f"SELECT conv_id, turn, {_cleaned('role')} AS role, {_cleaned('text')} AS value FROM conversations")
def clean_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.cleaned("role").alias("role"), text.cleaned("text").alias("value"))


_NAMES = "concat(CASE WHEN c_custkey % 4 = 0 THEN '2期' WHEN c_custkey % 4 = 1 THEN '第3期 ' ELSE '' END, CASE WHEN c_custkey % 3 = 0 THEN 'd 区' WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE '9' END, '.pdf')"


@_query(
    f"SELECT c_custkey, concat(CASE WHEN regexp_extract(stem, '([23])期', 1) <> '' THEN concat('P', regexp_extract(stem, '([23])期', 1)) ELSE '' END, 'Part', "
    f"upper(coalesce(nullif(regexp_extract(stem, '([A-Da-d])[ ]*区', 1), ''), nullif(regexp_extract(stem, '([A-Za-z])', 1), ''), 'X'))) AS tag "
    f"FROM (SELECT c_custkey, regexp_replace({_NAMES}, '[.]pdf$', '') AS stem FROM customer)"
)
def classify_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", text.part_tag(F.expr(_NAMES)).alias("tag"))


@_query(f"SELECT ord, concat(source_label, '|', file, '|', cast(page as varchar), '|', CASE WHEN ord % 10 = 0 THEN '' ELSE cast(card_no as varchar) END) AS card_key FROM ({_CARDS})")
def card_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.when(F.col("ord") % 10 != 0, F.col("card_no"))
    return corpus.cards(spark, sf_dir).select("ord", text.card_key("source_label", "file", "page", number).alias("card_key"))


_MESSAGE = "CASE WHEN event_type = 'error' THEN concat('Quota used up: ', props) WHEN event_type = 'signup' THEN 'access denied' ELSE props END"


@_query(
    f"SELECT event_id, status IN (401, 402, 403) OR {' OR '.join(f'contains(lower(said), {chr(39)}{w}{chr(39)})' for w in fixed.FATAL_WORDS)} AS fatal "
    f"FROM (SELECT event_id, cast(395 + event_id % 10 as integer) AS status, {_MESSAGE} AS said FROM events)"
)
def fatal_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (F.lit(395) + F.col("event_id") % 10).cast("int")
    return table(spark, sf_dir, "events").select("event_id", text.is_fatal(status, F.lit(""), F.expr(_MESSAGE)).alias("fatal"))


@_query("SELECT event_type <> 'error' AS ok, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def ok_failed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, failed = state.split_ok(table(spark, sf_dir, "events").withColumn("ok", F.when(F.col("event_type") != "error", F.lit(True))))
    each = [x.agg(F.lit(k).alias("ok"), F.count("*").alias("n"), F.sum("event_id").alias("ids")) for k, x in ((True, good), (False, failed))]
    return each[0].unionByName(each[1])


@_query("SELECT count(*) AS n, count(*) FILTER (WHERE event_type <> 'error') AS n_ok, count(*) FILTER (WHERE event_type = 'error') AS n_failed FROM events")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.counters(table(spark, sf_dir, "events").withColumn("ok", F.col("event_type") != "error"))


@_query(
    f"SELECT source_label, '{fixed.DATASET}' AS source_dataset, file, cast(page as varchar) AS page, cast(card_no as varchar) AS card_no, phone AS phone_normalized, "
    f"CASE WHEN source_label = 'P0' THEN name ELSE '' END AS name FROM ({_A_ROWS})"
)
def merge_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All partitions, with unlike columns: the first has a name, the others lack it; P9 is empty, and P3 has blank rows, which go."""
    rows = phones.phone_rows(corpus.cards(spark, sf_dir))
    parts = {f"P{i}": rows.where(F.col("source_label") == f"P{i}").select("file", "page", "card_no", "phone_normalized", *(["name"] if i == 0 else ["company"])) for i in range(5)}
    blank = table(spark, sf_dir, "region").select(F.lit("").alias("file"), *[F.lit(None).cast("long").alias(c) for c in ("page", "card_no")], F.lit("").alias("phone_normalized"), F.lit("").alias("company"))
    return merge.merged(parts | {"P3": parts["P3"].unionByName(blank), "P9": rows.where("false")})


@_query(
    f"WITH n AS (SELECT source_label, count(*) AS row_count FROM ({_A_ROWS}) GROUP BY 1), d AS (SELECT * FROM (VALUES (0, 'P0'), (1, 'P1'), (2, 'P2'), (3, 'P3'), (4, 'P4'), (5, 'P5')) t(ord, source_label)) "
    f"SELECT ord, source_label, coalesce(row_count, 0) AS row_count FROM d LEFT JOIN n USING (source_label) UNION ALL SELECT 6, '{fixed.TOTAL}', cast(coalesce(sum(row_count), 0) as bigint) FROM n"
)
def partition_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = merge.partition_dim(spark, [(f"run{i}", f"P{i}") for i in range(6)])
    return merge.summary(phones.phone_rows(corpus.cards(spark, sf_dir)), dim)


_KEY = "concat_ws('|', source_label, file, cast(page as varchar), cast(card_no as varchar)) AS card_key"
_A_CARDS = (
    f"SELECT {_KEY}, any_value(source_label) AS source_label, list_sort(list_distinct(list(phone))) AS phones, any_value(name) AS name, any_value(company) AS company FROM ({_A_ROWS}) GROUP BY card_key"
)
_B_CARDS = (
    f"SELECT {_KEY}, any_value(source_label) AS source_label, list_sort(list_distinct(list_filter(list(phone), lambda p: p <> ''))) AS phones, any_value(name_std) AS name_std, "
    f"any_value(company_std) AS company_std, bool_or(is_key_person) AS is_key_person FROM ({_B_ROWS}) GROUP BY card_key"
)


@_query(f"SELECT card_key, source_label, array_to_string(phones, ';') AS phones, name_std, company_std, is_key_person FROM ({_B_CARDS})")
def aggregate_by_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compare.by_card(_sides(spark, sf_dir)[1])
    return found.select("card_key", "source_label", text.joined("phones").alias("phones"), "name_std", "company_std", "is_key_person")


@_query(
    "SELECT user_id, arg_min(event_type, event_id) FILTER (WHERE event_id % 3 = 0) AS name FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_id % 3 = 0) > 0"
)
def first_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first filled value of each key over many rows, blanks passed over."""
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("card_no"), F.lit("").alias("source_label"), F.lit("").alias("file"), F.lit("").alias("page"), F.lit("").alias("phone_normalized"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise("  ").alias("name"), F.col("event_id").alias("ord"),
    )
    return compare.by_card(rows).where("name <> ''").select(F.col("card_no").cast("long").alias("user_id"), "name")


_BOTH = f"a AS ({_A_CARDS}), b AS ({_B_CARDS}), ra AS ({_A_ROWS}), rb AS ({_B_ROWS}), pa AS (SELECT DISTINCT phone FROM ra WHERE phone <> ''), pb AS (SELECT DISTINCT phone FROM rb WHERE phone <> ''), "
_JOINED = (
    "j AS (SELECT coalesce(a.card_key, b.card_key) AS card_key, coalesce(a.source_label, b.source_label) AS source_label, coalesce(a.phones, []) AS x, coalesce(b.phones, []) AS y, "
    "a.name, a.company, b.name_std, b.company_std, b.is_key_person, b.card_key IS NOT NULL AS in_b FROM a FULL JOIN b ON a.card_key = b.card_key) "
)
_PHONE_METRICS = (
    "(SELECT count(*) FROM pa) AS rule_unique_phones, (SELECT count(*) FROM pb) AS llm_unique_phones, (SELECT count(*) FROM pa JOIN pb USING (phone)) AS phones_in_both, "
    "(SELECT count(*) FROM pa ANTI JOIN pb USING (phone)) AS phones_only_in_rule, (SELECT count(*) FROM pb ANTI JOIN pa USING (phone)) AS phones_only_in_llm, "
    "(SELECT count(*) FROM rb WHERE is_key_person) AS llm_kp_rows, (SELECT count(*) FROM rb WHERE NOT is_key_person) AS llm_non_kp_rows"
)


_OVERVIEW = (
    f"WITH {_BOTH} {_JOINED} SELECT (SELECT count(*) FROM ra) AS rule_phone_rows, (SELECT count(*) FROM rb) AS llm_phone_rows, {_PHONE_METRICS}, "
    "count(*) FILTER (WHERE len(x) > 0) AS rule_cards_with_phone, count(*) FILTER (WHERE in_b) AS llm_cards_in_export, count(*) FILTER (WHERE is_key_person) AS llm_kp_cards, "
    "count(*) FILTER (WHERE len(x) > 0 AND x = y) AS cards_phone_set_equal, count(*) FILTER (WHERE len(x) > 0 AND len(y) > 0 AND x <> y) AS cards_phone_set_diff, "
    "count(*) FILTER (WHERE len(x) > 0 AND len(y) = 0) AS cards_only_rule_has_phone, count(*) FILTER (WHERE len(x) = 0 AND len(y) > 0) AS cards_only_llm_has_phone, "
    "count(*) FILTER (WHERE name <> '') AS cards_with_name_rule, count(*) FILTER (WHERE name_std <> '') AS cards_with_name_std_llm, "
    "count(*) FILTER (WHERE company <> '') AS cards_with_company_rule, count(*) FILTER (WHERE company_std <> '') AS cards_with_company_std_llm FROM j"
)


@_query(_OVERVIEW)
def compare_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.overview(*_sides(spark, sf_dir))


@_query(_OVERVIEW)
def compare_in_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after three increments, over which the rows of a card and of a number are spread."""
    folder = work_folder(spark, "comparing")
    part = F.pmod(F.xxhash64("file", "page", "card_no", "phone_normalized"), F.lit(3))
    for name, rows in zip("ab", _sides(spark, sf_dir)):
        rows.withColumn("part", part).write.partitionBy("part").parquet(f"{folder}/{name}")
    comparing = Comparing(f"{folder}/state", fanout=2, buckets=4)
    for number in range(3):
        comparing.take(*(spark.read.parquet(f"{folder}/{name}").where(F.col("part") == number).drop("part") for name in "ab"), number)
    return comparing.metrics(spark, 3)


@_query(
    f"WITH {_BOTH} {_JOINED} SELECT card_key, source_label, array_to_string(x, ';') AS phones_a, array_to_string(y, ';') AS phones_b, "
    f"CASE WHEN len(x) > 0 AND len(y) > 0 THEN '{fixed.NOTE_DIFFERENT}' WHEN len(x) > 0 THEN '{fixed.NOTE_A}' ELSE '{fixed.NOTE_B}' END AS note "
    "FROM j WHERE x <> y ORDER BY card_key LIMIT 500"
)
def card_diffs_top500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.card_diffs(*_sides(spark, sf_dir))


@_query(
    f"WITH {_BOTH} one AS (SELECT 1) (SELECT '{fixed.KIND_A}' AS kind, phone FROM pa ANTI JOIN pb USING (phone) ORDER BY phone LIMIT 2000) "
    f"UNION ALL (SELECT '{fixed.KIND_B}' AS kind, phone FROM pb ANTI JOIN pa USING (phone) ORDER BY phone LIMIT 2000)"
)
def phone_diffs_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.phone_diffs(*_sides(spark, sf_dir))


# Every order is a card of one number; a third of them have another number in chain B.
_ORDER_CARDS = (
    "SELECT concat('P', cast(o_orderkey % 5 as {t})) AS source_label, 'orders.pdf' AS file, cast(floor(o_orderkey / 6) as bigint) AS page, cast(o_orderkey % 6 + 1 as bigint) AS card_no, "
    "cast(o_orderkey as bigint) AS ord, concat('13', lpad(cast(o_orderkey * 2 as {t}), 9, '0')) AS a, concat('13', lpad(cast(o_orderkey * 2 + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END as {t}), 9, '0')) AS b FROM orders"
)


def _order_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = spark.sql(_ORDER_CARDS.format(t="string").replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))
    return rows.withColumnRenamed("a", "phone_normalized").drop("b"), rows.withColumnRenamed("b", "phone_normalized").drop("a")


@_query(
    f"SELECT concat_ws('|', source_label, file, cast(page as varchar), cast(card_no as varchar)) AS card_key, source_label, a AS phones_a, b AS phones_b, '{fixed.NOTE_DIFFERENT}' AS note "
    f"FROM ({_ORDER_CARDS.format(t='varchar')}) WHERE a <> b ORDER BY card_key LIMIT 500"
)
def card_diffs_beyond_the_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More differing cards than a report lists: the first 500 by key."""
    return compare.card_diffs(*_order_sides(spark, sf_dir))


@_query(
    f"WITH o AS ({_ORDER_CARDS.format(t='varchar')}) (SELECT '{fixed.KIND_A}' AS kind, a AS phone FROM o WHERE a <> b ORDER BY a LIMIT 2000) "
    f"UNION ALL (SELECT '{fixed.KIND_B}' AS kind, b AS phone FROM o WHERE a <> b ORDER BY b LIMIT 2000)"
)
def phone_diffs_beyond_the_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More numbers that one side lacks than a report lists: the first 2,000 of each."""
    return compare.phone_diffs(*_order_sides(spark, sf_dir))


@_query(
    f"WITH {_BOTH} c AS ({_B}) SELECT (SELECT count(*) FROM ra) AS rule_pipeline_rows, (SELECT count(*) FROM rb) AS llm_total_rows, {_PHONE_METRICS}, "
    "(1000 * count(*) FILTER (WHERE is_key_person) // count(*) + CASE WHEN 2 * (1000 * count(*) FILTER (WHERE is_key_person) % count(*)) > count(*) THEN 1 ELSE 0 END) / 10 AS llm_kp_rate_pct, "
    "count(*) AS llm_cards_processed, count(*) FILTER (WHERE is_key_person) AS llm_kp_cards, count(*) FILTER (WHERE NOT is_key_person) AS llm_non_kp_cards, "
    "count(*) FILTER (WHERE len(found) > 0) AS llm_cards_with_mobile FROM c"
)
def rule_vs_llm_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of an export."""
    a, b = _sides(spark, sf_dir)
    return compare.rule_and_llm(a, b, _standard(spark, sf_dir))


@_query(
    f"WITH {_BOTH} {_JOINED}, m AS (SELECT {_PHONE_METRICS}, count(*) FILTER (WHERE is_key_person) AS kp, count(*) FILTER (WHERE name <> '') AS na, count(*) FILTER (WHERE name_std <> '') AS nb FROM j) "
    "SELECT unnest([0, 1, 2, 3, 4, 5])::INTEGER AS ord, unnest(['unique phones', 'phones in both', 'names', 'key persons', 'cost', 'overall']) AS topic, "
    "unnest([rule_unique_phones::VARCHAR, phones_in_both::VARCHAR, concat(na, ' cards, first line that fits'), 'none', 'recognition and rules', '-']) AS chain_a, "
    "unnest([llm_unique_phones::VARCHAR, phones_in_both::VARCHAR, concat(nb, ' cards, standardised'), concat(kp, ' cards'), '12 calls, 345 tokens', '-']) AS chain_b, "
    "unnest([concat(CASE WHEN rule_unique_phones > llm_unique_phones THEN 'A' WHEN rule_unique_phones < llm_unique_phones THEN 'B' ELSE 'neither' END, ' has more; ', phones_only_in_llm, ' only in B and ', "
    "phones_only_in_rule, ' only in A: merge by purpose'), concat('check samples of the ', phones_only_in_rule, ' and ', phones_only_in_llm, ' that one side lacks'), 'A lists only cards with a phone, B all cards', "
    "'take B to choose by rank', 'A is the base, B adds to it', concat('numbers of A are the base (', rule_unique_phones, '), B adds ', phones_only_in_llm, ' more, standardised fields and ', kp, "
    "' cards of key persons: deliver A with B''s key persons, or both merged after a check of samples')]) AS advice FROM m"
)
def report_conclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conclusion in words, with the figures of the comparison."""
    return compare.conclusion(compare.overview(*_sides(spark, sf_dir)), calls=12, tokens=345)

@_query(f"WITH {_BOTH} one AS (SELECT 1) SELECT card_key FROM a ANTI JOIN b USING (card_key)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (compare.by_card(x) for x in _sides(spark, sf_dir))
    return state.pending(a, b, ["card_key"]).select("card_key")


@_query("SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.keep_last(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], "event_id")


@_query(
    "SELECT user_id, arg_max(event_type, 2 * e + n) AS event_type, max(e) AS event_id FROM (SELECT user_id, event_type, event_id AS e, 0 AS n FROM events WHERE event_id % 2 = 0 "
    "UNION ALL SELECT user_id, 'again', event_id, 1 FROM events WHERE event_id % 5 = 1) GROUP BY user_id"
)
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    new = rows.where("event_id % 5 = 1").withColumn("event_type", F.lit("again"))
    return state.upserted(rows.where("event_id % 2 = 0"), new, ["user_id"], "event_id")


@_query(
    "SELECT user_id, arg_max(event_type, k) AS event_type, arg_max(event_id, k) AS event_id FROM (SELECT user_id, event_type, event_id, (event_id % 7) * 1000000000000 + event_id AS k FROM events) GROUP BY user_id"
)
def upserts_in_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven batches of upserts, merged by twos: the last row of each key by batch and order."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    levels = Levels(work_folder(spark, "levels"), ("user_id",), "event_id", fanout=2, buckets=4)
    for number in range(7):
        levels.put(rows.where(F.col("event_id") % 7 == number), number)
    return levels.read(spark, 7)


def _answer_some(batch: list[dict]) -> tuple[list[dict], int]:
    """A service in the place of a real one: no answer to some cards, an error for others."""
    found = []
    for card in batch:
        number = int(card["line_texts"][0])
        if number % 101 == 0:
            raise ValueError(f"no answer to {number}")
        if number % 10 != 3:
            found.append({"card_key": card["card_key"], "name": card["line_texts"][1].upper(), "mobiles": card["line_texts"][2], "is_key_person": number % 2 == 0})
    return found, len(found)


@_query(
    f"SELECT ord, CASE WHEN ord % 101 = 0 OR ord % 10 = 3 THEN NULL ELSE upper(name) END AS name, CASE WHEN ord % 101 = 0 OR ord % 10 = 3 OR phones = '' THEN '' ELSE phones END AS mobiles, "
    f"CASE WHEN ord % 101 = 0 OR ord % 10 = 3 OR ord % 2 = 1 THEN 'false' ELSE 'true' END AS is_key_person, CASE WHEN ord % 101 = 0 OR ord % 10 = 3 THEN 0 ELSE 1 END::BIGINT AS tokens, "
    f"CASE WHEN ord % 101 = 0 THEN concat('ValueError: no answer to ', ord) END AS error FROM ({_CARDS})"
)
def provider_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A call for each card, several in flight in each task, with retries."""
    own = corpus.cards(spark, sf_dir).select("ord", F.col("ord").cast("string").alias("card_key"), F.array(F.col("ord").cast("string"), "name", "phones").alias("line_texts"), F.lit(None).alias("extracted"))
    called = enrich.call(own, _answer_some, batch=1, retries=1, wait=0.0, at_once=spark.sparkContext.defaultParallelism)
    return called.select(F.col("card_key").cast("long").alias("ord"), "answer.name", text.joined("answer.mobiles").alias("mobiles"), "answer.is_key_person", "tokens", "error")


@_query(f"WITH b AS ({_B}) SELECT c.ord, coalesce(name_std, '') AS name_std, coalesce(array_to_string(list_sort(found), ';'), '') AS mobiles, coalesce(is_key_person, false) AS is_key_person FROM ({_CARDS}) c LEFT JOIN b USING (ord)")
def llm_left_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards with their answers; those without one get empty fields."""
    key = text.card_key("source_label", "file", "page", "card_no").alias("card_key")
    answers = corpus.answers(spark, sf_dir).select(
        key, F.struct("name", "title", "company", "address", F.array("mobiles").alias("mobiles"), F.col("is_key_person").cast("string").alias("is_key_person"), "kp_role").alias("answer")
    )
    found = enrich.with_answers(corpus.cards(spark, sf_dir).select("ord", key), answers, "some-model")
    return found.select("ord", "name_std", text.joined(F.array_sort("mobiles")).alias("mobiles"), "is_key_person")


@_query(f"SELECT file, page, s AS card_no, concat('r', cast((s - 1) // 2 + 1 as varchar), 'c', cast((s - 1) % 2 + 1 as varchar)) AS grid_pos FROM (SELECT DISTINCT file, page FROM ({_CARDS})) CROSS JOIN (SELECT cast(unnest(range(1, 7)) as integer) AS s)")
def six_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = corpus.cards(spark, sf_dir).select("file", "page").distinct()
    none = F.array().cast("array<struct<x:double,y:double,width:double,height:double>>")
    empty = pages.withColumns({"line_texts": F.array().cast("array<string>"), "line_rects": none})
    return layout.cards(empty).select("file", "page", "card_no", "grid_pos")


_RECTS = "transform(lines, (l, i) -> named_struct('x', cast(i % 2 * 300 + length(l) % 7 as double), 'y', cast(i div 2 * 40 + length(l) % 5 as double), 'width', cast(length(l) % 11 as double), 'height', 10D))"


def _document_cards(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Documents as pages of twelve lines, laid out in two columns."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.filter(_lines(), lambda x: x != "").alias("all"))
    numbered = rows.select("doc_id", "all", F.explode(F.slice(F.sequence(F.lit(1), F.size("all") + 1), 1, F.ceil(F.size("all") / 12).cast("int"))).alias("page"))
    pages = numbered.select("doc_id", "page", F.slice("all", F.col("page") * 12 - 11, 12).alias("lines"))
    return layout.cards(pages.select("doc_id", "page", F.col("lines").alias("line_texts"), F.expr(_RECTS).alias("line_rects")), fields=fields or ("full_text",))


# Agglomeration step by step: a cluster is a stretch of the sorted centres, told by where it starts.
_CLUSTERED = f"""
WITH RECURSIVE pages AS (
    SELECT doc_id, page, list_slice(every, page * 12 - 11, page * 12) AS lines FROM (
        SELECT doc_id, every, unnest(range(1, cast(ceil(len(every) / 12) as bigint) + 1)) AS page FROM (SELECT doc_id, list_filter({_LINES}, lambda l: l <> '') AS every FROM documents))
), items AS (
    SELECT doc_id, page, i, lines[i + 1] AS l, cast(i % 2 * 300 + length(lines[i + 1]) % 7 as double) AS x, cast(i // 2 * 40 + length(lines[i + 1]) % 5 as double) AS y,
        cast(length(lines[i + 1]) % 11 as double) AS w FROM (SELECT doc_id, page, lines, unnest(range(0, len(lines))) AS i FROM pages)
), steps AS (
    SELECT doc_id, page, axis, v, range(1, len(v) + 1) AS s, CASE WHEN axis = 'y' THEN least(3, len(v)) ELSE 2 END AS target FROM (
        SELECT doc_id, page, 'y' AS axis, list(y + 5 ORDER BY y + 5) AS v FROM items GROUP BY ALL UNION ALL SELECT doc_id, page, 'x', list(x + w / 2 ORDER BY x + w / 2) FROM items GROUP BY ALL)
    UNION ALL
    SELECT doc_id, page, axis, v, list_concat(list_slice(s, 1, best), list_slice(s, best + 2, len(s))), target FROM (
        SELECT *, list_position(gaps, list_min(gaps)) AS best FROM (
            SELECT *, list_transform(range(1, len(m)), lambda k: m[k + 1] - m[k]) AS gaps FROM (
                SELECT *, {{medians}} AS m FROM steps WHERE len(s) > target)))
), centers AS (SELECT doc_id, page, axis, {{medians}} AS c FROM steps WHERE len(s) <= target),
placed AS (
    SELECT i.*, (list_position(list_transform(cy.c, lambda k: abs(i.y + 5 - k)), list_min(list_transform(cy.c, lambda k: abs(i.y + 5 - k)))) - 1) * 2
        + list_position(list_transform(cx.c, lambda k: abs(i.x + i.w / 2 - k)), list_min(list_transform(cx.c, lambda k: abs(i.x + i.w / 2 - k)))) AS card_no
    FROM items i JOIN centers cy ON (i.doc_id, i.page, 'y') = (cy.doc_id, cy.page, cy.axis) JOIN centers cx ON (i.doc_id, i.page, 'x') = (cx.doc_id, cx.page, cx.axis)
), cards AS (
    SELECT p.doc_id, p.page, n.card_no, coalesce(list(l ORDER BY y, x, i) FILTER (WHERE l IS NOT NULL), []) AS own
    FROM pages p CROSS JOIN (SELECT unnest(range(1, 7)) AS card_no) n LEFT JOIN placed q ON (p.doc_id, p.page, n.card_no) = (q.doc_id, q.page, q.card_no) GROUP BY ALL
)
SELECT doc_id, cast(page as integer) AS page, cast(card_no as integer) AS card_no, concat('r', cast((card_no + 1) // 2 as varchar), 'c', cast((card_no - 1) % 2 + 1 as varchar)) AS grid_pos,
    len(own) > 0 AS has_text, array_to_string(own, ';') AS lines,
    list_filter(list_transform(own, lambda l: regexp_replace(l, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')), lambda l: length(l) BETWEEN 2 AND 30 AND NOT {_hit(fixed.COMPANIES + fixed.TITLES + fixed.ADDRESSES)}
        AND NOT regexp_matches(l, '{fixed.EMAIL}') AND NOT regexp_matches(l, '{_SITE}') AND NOT regexp_matches(l, '[0-9]'))[1] AS name,
    list_filter(own, lambda l: {_hit(fixed.COMPANIES)})[1] AS company FROM cards
""".replace("{medians}", "list_transform(range(1, len(s) + 1), lambda k: (v[(s[k] + coalesce(s[k + 1], len(v) + 1) - 1) // 2] + v[(s[k] + coalesce(s[k + 1], len(v) + 1)) // 2]) / 2)")


@_query(_CLUSTERED)
def cluster_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The central operator: lines to cards, with two of their fields."""
    return _document_cards(spark, sf_dir, "name", "company").select("doc_id", "page", "card_no", "grid_pos", "has_text", text.joined("line_texts").alias("lines"), "extracted.name", "extracted.company")


@_query(
    f"SELECT cast(sum(p) as bigint) AS pages, cast(sum(p) * 6 as bigint) AS cards, cast(sum(n) as bigint) AS lines FROM (SELECT n, cast(ceil(n / 12) as bigint) AS p FROM (SELECT len(list_filter({_LINES}, lambda l: l <> '')) AS n FROM documents))"
)
def card_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No card and no line is lost on the way."""
    return state.card_counters(_document_cards(spark, sf_dir)).select("pages", "cards", "lines")


_PHONES_FOUND = f"list_sort(list_distinct(list_transform(flatten(list_transform({_LINES}, lambda l: regexp_extract_all(l, '{_PHONE}'))), lambda x: regexp_replace(x, '[^0-9+]', '', 'g'))))"


@_query(
    f"SELECT doc_id, list_filter({_STRIPPED}, lambda l: length(l) BETWEEN 2 AND 30 AND NOT {_hit(fixed.COMPANIES + fixed.TITLES + fixed.ADDRESSES)} AND NOT regexp_matches(l, '{fixed.EMAIL}') "
    f"AND NOT regexp_matches(l, '{_SITE}') AND NOT regexp_matches(l, '[0-9]'))[1] AS name, {', '.join(f'list_filter({_LINES}, lambda l: {_hit(w)})[1] AS {c}' for c, w in (('company', fixed.COMPANIES), ('title', fixed.TITLES), ('address', fixed.ADDRESSES)))}, "
    f"array_to_string({_PHONES_FOUND}, ';') AS phones, {_found(fixed.EMAIL, 'text')} AS emails, {_found(_SITE, 'text')} AS websites, "
    f"{_found('(?:微信|wechat|WeChat|WX|vx)[:： ]*([A-Za-z0-9_-]{5,})', 'text', 1)} AS wechat_ids, {_found('(?:QQ|qq)[:： ]*([1-9][0-9]{4,11})', 'text', 1)} AS qq_ids, sha256(text) AS full_text FROM documents WHERE text IS NOT NULL"
)
def all_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten fields of documents read as cards."""
    own = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", text.extracted(_lines()).alias("x"))
    lists = [text.joined(f"x.{c}").alias(c) for c in ("phones", "emails", "websites", "wechat_ids", "qq_ids")]
    return own.select("doc_id", "x.name", "x.company", "x.title", "x.address", *lists, F.sha2("x.full_text", 256).alias("full_text"))


_GOOD = "(event_id % 97 <> 0 OR event_type <> 'view')"


_STATUS = (
    "SELECT event_type AS run, CASE WHEN n_ok >= 1900 THEN 'completed' WHEN n_bad > 0 THEN 'interrupted' ELSE 'running' END AS status, n_ok, n_bad AS n_failed, tokens, last_error FROM ("
    f"SELECT event_type, count(*) FILTER (WHERE {_GOOD}) AS n_ok, count(*) FILTER (WHERE NOT {_GOOD}) AS n_bad, cast(sum(event_id % 5) as bigint) AS tokens, "
    f"arg_max(concat('error ', cast(event_id as varchar)), event_id) FILTER (WHERE NOT {_GOOD}) AS last_error FROM events GROUP BY 1)"
)


def _log_of(events: DataFrame) -> DataFrame:
    """Units of a run are events in the order of their ids."""
    good = F.expr(_GOOD)
    return events.select(
        F.col("event_type").alias("run"), F.lit("f").alias("input_fingerprint"), F.col("event_id").cast("string").alias("unit"), good.alias("ok"), F.lit(False).alias("fatal"),
        F.when(~good, F.concat(F.lit("error "), F.col("event_id").cast("string"))).alias("error"), (F.col("event_id") % 5).alias("tokens"), F.timestamp_seconds(F.col("event_id") + 1).alias("at"),
    )


def _inputs_of(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_type").alias("run")).distinct().withColumns({"input_fingerprint": F.lit("f"), "total_units": F.lit(1900)})


@_query(_STATUS)
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of an older fingerprint do not count."""
    events = table(spark, sf_dir, "events")
    log = _log_of(events)
    older = log.withColumns({"input_fingerprint": F.lit("old"), "ok": F.lit(True), "error": F.lit("none of this")})
    return state.status(_inputs_of(events), log.unionByName(older)).select("run", "status", "n_ok", "n_failed", "tokens", "last_error")


@_query(_STATUS)
def live_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream of the log's entries, folded into the state of each run."""
    events = table(spark, sf_dir, "events")
    log = _log_of(spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]"))  # a pattern, since the table may be a single file
    folder, inputs = work_folder(spark, "live"), _inputs_of(events)
    status.kept(status.live(log, inputs, quiet="30000 days"), f"{folder}/rows", f"{folder}/state").awaitTermination()
    return status.current(spark, f"{folder}/rows", inputs).select("run", "status", "n_ok", "n_failed", "tokens", "last_error")


@_query(
    "SELECT count(*) FILTER (WHERE event_id % 89 <> 5) AS n_ok, count(*) FILTER (WHERE event_id % 89 = 5) AS n_failed, sum(event_id) FILTER (WHERE event_id % 89 <> 5)::BIGINT AS ids, "
    "'interrupted' AS status, max(concat('{\"event_id\":', event_id, ', cut')) FILTER (WHERE event_id % 89 = 5) AS last_text FROM events"
)
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, some of them cut: good ones are read, the others kept apart, and the run's status counts both."""
    events, folder = table(spark, sf_dir, "events"), work_folder(spark, "lines")
    broken = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(", cut"))
    events.select(F.when(F.col("event_id") % 89 == 5, broken).otherwise(F.to_json(F.struct("event_id", "event_type")))).write.text(folder)
    good, bad = files.json_lines_apart(spark, folder, "event_id long, event_type string")
    log = files.lines_log(good, bad, "events", "f")
    inputs = good.agg(F.lit("events").alias("run"), F.lit("f").alias("input_fingerprint"), (F.count("*") + 1).alias("total_units"))
    counts = state.status(inputs, log).select("n_ok", "n_failed", "status")
    return counts.crossJoin(good.agg(F.sum("event_id").alias("ids"))).crossJoin(bad.agg(F.max("text").alias("last_text")))  # single rows


def _written_pages(spark: SparkSession, sf_dir: str) -> str:
    """A folder of results of pages as JSON lines, in the order of events: each file holds a range of them, and names of files follow the ranges."""
    folder = work_folder(spark, "pages")
    rows = table(spark, sf_dir, "events").select(
        F.lit("f.pdf").alias("file"), F.when(F.col("event_id") % 7 != 3, F.col("user_id").cast("int")).alias("page"), (F.col("event_id") % 5 != 1).alias("ok"),
        F.array(F.col("event_type"), F.col("event_id").cast("string")).alias("line_texts"), "event_id",
    ).repartitionByRange("event_id").sortWithinPartitions("event_id")
    rows.drop("event_id").write.json(folder)
    return folder


_READ = ["file", "cast(page as bigint) AS page", "cast(line_texts[1] as bigint) AS event_id", "line_texts[0] AS event_type"]


@_query("SELECT 'f.pdf' AS file, user_id AS page, ok, event_id, event_type FROM (SELECT *, event_id % 5 <> 1 AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events WHERE event_id % 7 <> 3) WHERE n = 1")
def keyed_pages_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last result of each page counts, lines without a page go."""
    return files.pages(spark, _written_pages(spark, sf_dir)).selectExpr("ok", *_READ)


@_query("SELECT 'f.pdf' AS file, CASE WHEN event_id % 7 <> 3 THEN user_id END AS page, event_id, event_type FROM events WHERE event_id % 5 <> 1")
def good_pages_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every good result."""
    return files.good_pages(spark, _written_pages(spark, sf_dir)).selectExpr(*_READ)


@_query(
    f"SELECT c_custkey FROM (SELECT c_custkey, regexp_replace({_NAMES}, '[.]pdf$', '') AS stem FROM customer) WHERE upper(coalesce(nullif(regexp_extract(stem, '([A-Da-d])[ ]*区', 1), ''), "
    "nullif(regexp_extract(stem, '([A-Za-z])', 1), ''), 'X')) NOT IN ('B', 'X') AND NOT (regexp_extract(stem, '([23])期', 1) = '3' AND regexp_extract(stem, '([A-Da-d])[ ]*区', 1) = 'd')"
)
def parts_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by file name, without two zones and one part."""
    runs = table(spark, sf_dir, "customer").select("c_custkey", text.part_tag(F.expr(_NAMES)).alias("tag"))
    return state.without_parts(runs, ["B", "X", "P3PartD"]).select("c_custkey")


@_query("SELECT concat('/runs/', event_type, '_', event_id) AS path, ts AS modified FROM events WHERE event_type = 'purchase' AND event_id % 2 = 0 ORDER BY ts DESC, event_id DESC LIMIT 1")
def newest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest entry whose name matches."""
    entries = table(spark, sf_dir, "events").select(F.concat(F.lit("/runs/"), F.col("event_type"), F.lit("_"), F.col("event_id").cast("string")).alias("path"), F.col("ts").alias("modified"))
    return state.latest_run(entries, "^purchase_[0-9]*[02468]$")


@_query(f"SELECT event_id FROM events WHERE NOT {_GOOD} OR event_id % 10 = 3")
def changed_inputs_start_anew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a unit of an input of its own size and time; a tenth of the inputs have changed since they were logged."""
    events = table(spark, sf_dir, "events")

    def mark(size: Column) -> Column:
        return text.fingerprint(F.concat(F.lit("/in/"), F.col("event_type"), F.lit("_"), F.col("event_id").cast("string"), F.lit(".pdf")), size, F.timestamp_seconds("event_id"))

    units = events.select("event_id", F.col("event_type").alias("run"), mark(F.col("event_id")).alias("input_fingerprint"), F.col("event_id").cast("string").alias("unit"))
    results = events.select(
        F.col("event_type").alias("run"), mark(F.when(F.col("event_id") % 10 == 3, F.lit(0)).otherwise(F.col("event_id"))).alias("input_fingerprint"),
        F.col("event_id").cast("string").alias("unit"), F.expr(_GOOD).alias("ok"),
    )
    return state.pending_units(units, state.logged(results)).select("event_id")


@_query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key once from a stream of all events, written by the stream and read back."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")  # a pattern, since the table may be a single file
    rows = events.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("at"))
    folder = work_folder(spark, "stream")
    resume.append(resume.first_seen(rows, ["user_id", "event_type"], "at", "10000 days"), f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("user_id", "event_type")


@_query(
    f"SELECT doc_id, {', '.join(f'coalesce(list_filter({_LINES}, lambda l: {_cased(w)})[1], {chr(39) * 2}) AS {c}' for c, w in (('company', text.PAGE.companies), ('title', text.PAGE.titles), ('address', text.PAGE.addresses)))}, "
    f"coalesce(list_filter({_STRIPPED}, lambda l: length(l) BETWEEN 2 AND 12 AND NOT {_cased(text.PAGE.companies + text.PAGE.titles + text.PAGE.addresses)} "
    f"AND NOT regexp_matches(l, '{fixed.EMAIL}') AND NOT regexp_matches(l, '{_SITE}') AND NOT regexp_matches(l, '[0-9]'))[1], '') AS name FROM documents"
)
def page_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of whole pages: the shorter lists, in their case, and short names."""
    own = table(spark, sf_dir, "documents").select("doc_id", text.extracted(_lines(), text.PAGE).alias("x"))
    return own.select("doc_id", *[F.coalesce(f"x.{c}", F.lit("")).alias(c) for c in ("company", "title", "address", "name")])


@_query("SELECT event_id, CASE WHEN value > 50 THEN 'True' ELSE 'False' END AS high, coalesce(event_type, '') AS event_type FROM events")
def csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.as_csv_text(table(spark, sf_dir, "events").select("event_id", (F.col("value") > 50).alias("high"), "event_type")).withColumn("event_id", F.col("event_id").cast("long"))
