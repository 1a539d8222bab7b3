"""A query over the driver's tables for each operator, and SQL that gives the same rows.

Stand-ins: ``events`` are listings of (user, day) whose later event replaces an earlier one, a publication being an eighth of
the event ids; ``embeddings`` are observations; ``documents`` are bytes to hash; ``pages.url`` are path-like texts.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import columns as C
from skyledger.functions.values import MarketDate
from skyledger.operators import compare, resolve, sketches, temporal
from skyledger.operators.network import Creature, Predictor, activation_columns, score
from skyledger.sources.publish import write_archive
from skyledger.sources.scratch import scratch_path
from skyledger.streaming.restated import restated_rows_merged

#: A model of 5 inputs: two ReLU neurons, of which one feeds the other, and a LOGISTIC one, summed by the output.
MODEL = {
    "input": 5, "output": 1, "forwardOnly": True,
    "neurons": [
        {"type": "hidden", "uuid": "rise", "bias": 0.0625, "squash": "ReLU"}, {"type": "hidden", "uuid": "gate", "bias": -0.5, "squash": "LOGISTIC"},
        {"type": "hidden", "uuid": "rest", "bias": 0.25, "squash": "ReLU"}, {"type": "output", "uuid": "sum", "bias": -1.0, "squash": "IDENTITY"},
    ],
    "synapses": [
        {"fromUUID": f, "toUUID": t, "weight": w} for f, t, w in (
            ("input-0", "rise", 1.5), ("input-4", "rise", -0.75), ("input-1", "gate", 2.0), ("rise", "gate", 0.5), ("rise", "rest", -1.25), ("input-2", "rest", 0.625), ("input-3", "rest", 1.0),
            ("gate", "sum", 3.0), ("rest", "sum", 0.875), ("input-3", "sum", -0.25),
        )
    ],
}
#: A model of 8 inputs, three hidden neurons on two levels with each squash, and two outputs.
WIDE_MODEL = {
    "input": 8, "output": 2, "forwardOnly": True,
    "neurons": [
        {"type": "hidden", "uuid": "a", "bias": 0.25, "squash": "LOGISTIC"}, {"type": "hidden", "uuid": "b", "bias": -0.125, "squash": "ReLU"}, {"type": "hidden", "uuid": "c", "bias": 0.0, "squash": "TANH"},
        {"type": "output", "uuid": "o1", "bias": 0.5, "squash": "IDENTITY"}, {"type": "output", "uuid": "o2", "bias": 0.0, "squash": "TANH"},
    ],
    "synapses": [
        {"fromUUID": "input-0", "toUUID": "a", "weight": 1.5}, {"fromUUID": "input-7", "toUUID": "a", "weight": -2.0}, {"fromUUID": "input-3", "toUUID": "b", "weight": 3.0}, {"fromUUID": "a", "toUUID": "c", "weight": 1.0},
        {"fromUUID": "b", "toUUID": "c", "weight": -1.0}, {"fromUUID": "c", "toUUID": "o1", "weight": 2.0}, {"fromUUID": "input-5", "toUUID": "o1", "weight": 0.5}, {"fromUUID": "c", "toUUID": "o2", "weight": 1.0}, {"fromUUID": "a", "toUUID": "o2", "weight": 1.0},
    ],
}
_RISE = "greatest(0, 1.5::DOUBLE * {x}[1] - 0.75::DOUBLE * {x}[5] + 0.0625::DOUBLE)"
_MODEL_SQL = f"(3 / (1 + exp(0.5::DOUBLE - 2 * {{x}}[2]::DOUBLE - 0.5::DOUBLE * {_RISE})) + 0.875::DOUBLE * greatest(0, 0.25::DOUBLE - 1.25::DOUBLE * {_RISE} + 0.625::DOUBLE * {{x}}[3] + {{x}}[4]) - 0.25::DOUBLE * {{x}}[4] - 1)"
_WIDE_SQL = """a AS (SELECT *, 1 / (1 + exp(-(0.25 + 1.5 * x[1] - 2.0 * x[8]))) AS a, greatest(0, -0.125 + 3.0 * x[4]) AS b FROM e), c AS (SELECT *, tanh(a - b) AS c FROM a)"""
_E_SQL = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings)"


_PLACED = "SELECT '{dataset}' AS dataset, vec_id, 2021 AS year, month(DATE '2021-01-01' + (vec_id % 90)::INTEGER)::INTEGER AS month, CASE WHEN vec_id % 8 = 6 THEN '_' ELSE substr('ABCXYZ^3', (vec_id % 8 + 1)::INTEGER, 1) END AS prefix FROM embeddings"
_ROWS_SQL, _AGAIN_SQL = _PLACED.format(dataset="ds1"), _PLACED.format(dataset="ds2") + " WHERE vec_id % 5 = 0"


def _rounded(value: str) -> str:
    """To two decimals, without the sign that DuckDB leaves on a zero."""
    return f"CASE WHEN round({value}, 2) = 0 THEN 0::DOUBLE ELSE round({value}, 2) END"


def _close(made: str, exact: str) -> Column:
    return (F.abs(F.col(made) - F.col(exact)) <= 1e-5).alias("close")


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _values(spark: SparkSession, rows: list[str]) -> DataFrame:
    return spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "n int, v string")


def _sql_values(rows: list[str]) -> str:
    def quoted(v: str) -> str:
        parts = [f"'{p}'" for p in v.replace("'", "''").split("\n")]
        return " || chr(10) || ".join(parts)

    return "(VALUES " + ", ".join(f"({i}, {quoted(v)})" for i, v in enumerate(rows)) + ") AS t(n, v)"


def _listings(spark: SparkSession, d: str) -> DataFrame:
    """events as listings: symbol, date, publication, place."""
    letter = F.substring(F.lit("abCXYZ^3"), (F.col("user_id") % 8 + 1).cast("int"), F.lit(1))
    return _t(spark, d, "events").select(
        F.concat(letter, F.col("user_id").cast("string")).alias("symbol"), F.to_date("ts").alias("date"), F.expr("event_id div 1250").alias("pub_seq"), F.col("event_id").alias("idx_seq"), F.col("event_type").alias("exchange")
    )


_SYMBOL = "substr('abCXYZ^3', (user_id % 8 + 1)::INTEGER, 1) || user_id"
_LISTINGS = f"l AS (SELECT {_SYMBOL} AS symbol, ts::DATE AS date, event_id // 1250 AS pub_seq, event_id AS idx_seq, event_type AS exchange FROM events)"
_WINNERS = f"{_LISTINGS}, w AS (SELECT symbol, date, arg_max(idx_seq, (pub_seq, idx_seq)) AS idx_seq, arg_max(exchange, (pub_seq, idx_seq)) AS exchange FROM l GROUP BY ALL)"
_PARTS = "p AS (SELECT *, year(date)::INTEGER AS year, month(date)::INTEGER AS month, CASE WHEN regexp_matches(symbol, '^[0-9A-Za-z]') THEN upper(substr(symbol, 1, 1)) ELSE '_' END AS prefix FROM w)"


def _winners(spark: SparkSession, d: str) -> DataFrame:
    return resolve.latest_rows(_listings(spark, d), ["pub_seq", "idx_seq"])


def _text(date: Column) -> Column:
    return C.format_date(date)


def _x(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").alias("x"))


def _placed(rows: DataFrame) -> DataFrame:
    """Adds the symbol and date under which vectors are published."""
    letter = F.substring(F.lit("ABCXYZ^3"), (F.col("vec_id") % 8 + 1).cast("int"), F.lit(1))
    return rows.withColumns({"symbol": F.concat(letter, F.col("vec_id").cast("string")), "date": F.date_add(F.lit("2021-01-01").cast("date"), (F.col("vec_id") % 90).cast("int"))})


def _spoilt(spark: SparkSession, d: str) -> DataFrame:
    """embeddings whose first value is not finite in every tenth row."""
    bad = F.when(F.col("vec_id") % 30 == 0, float("nan")).when(F.col("vec_id") % 30 == 10, float("inf")).when(F.col("vec_id") % 30 == 20, -float("inf"))
    return _x(spark, d).withColumn("x", F.transform("x", lambda v, i: F.when(i == 0, F.coalesce(bad, v.cast("double"))).otherwise(v.cast("double"))))


_SPOILT = """s AS (SELECT vec_id, label, list_concat([CASE vec_id % 30 WHEN 0 THEN 'nan'::DOUBLE WHEN 10 THEN 'inf'::DOUBLE WHEN 20 THEN '-inf'::DOUBLE ELSE embedding[1]::DOUBLE END], embedding[2:]::DOUBLE[]) AS x FROM embeddings)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# Flagship: scan, slice, score, refuse, summarise.
@query(f"""WITH {_E_SQL}, y AS (SELECT label, {_MODEL_SQL.format(x='x')} AS y FROM e)
SELECT label, count(*) AS n_rows, round(min(y), 6) AS min_y, round(max(y), 6) AS max_y, round(avg(y), 6) AS avg_y FROM y WHERE isfinite(y) GROUP BY label""")
def score_summary(spark, d):
    y = activation_columns(MODEL, F.col("x"))[0]
    rows = _x(spark, d).select("label", y.alias("y")).where(C.is_finite(F.col("y")))
    return rows.groupBy("label").agg(F.count("*").alias("n_rows"), *[F.round(f("y"), 6).alias(f"{n}_y") for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))])


def _range(first, last):
    def run(spark, d):
        rows = _t(spark, d, "events").where(C.date_range(F.to_date("ts"), first, last))
        return rows.select("event_id", F.to_date("ts").cast("string").alias("date"))

    return run


for _name, _first, _last in (("date_range_inclusive", "2024-01-05", "2024-01-12"), ("date_range_open_from", None, "2024-01-12"), ("date_range_open_to", "2024-01-05", None)):
    QUERIES[_name] = _range(_first, _last)
    ORACLES[_name] = "SELECT event_id, ts::DATE::VARCHAR AS date FROM events WHERE true" + (f" AND ts::DATE >= DATE '{_first}'" if _first else "") + (f" AND ts::DATE <= DATE '{_last}'" if _last else "")

_SYMBOLS = ["^WIND", "Ü", "ı", "ſ", "", "3m", "bhp", "_x", " a"]


@query(f"""SELECT s, CASE WHEN regexp_matches(s, '^[0-9A-Za-z]') THEN upper(substr(s, 1, 1)) ELSE '_' END AS prefix
FROM (SELECT c_name AS s FROM customer UNION ALL SELECT p_name FROM part UNION ALL SELECT url FROM pages UNION ALL SELECT v FROM {_sql_values(_SYMBOLS)})""")
def symbol_prefix(spark, d):
    texts = [_t(spark, d, t).select(F.col(c).alias("s")) for t, c in (("customer", "c_name"), ("part", "p_name"), ("pages", "url"))]
    rows = texts[0].union(texts[1]).union(texts[2]).union(_values(spark, _SYMBOLS).select("v"))
    return rows.select("s", C.prefix_for_symbol(F.col("s")).alias("prefix"))


#: Dates of events as texts, most of them spoilt in one of nine ways by their key; the same SQL for both engines.
_DAY = "CAST(CAST(ts AS DATE) AS STRING)"
_SPOILT_DATE = f"""CASE event_id % 10 WHEN 1 THEN replace({_DAY}, '-0', '-') WHEN 2 THEN ' ' || {_DAY} WHEN 3 THEN {_DAY} || chr(10) WHEN 4 THEN substr({_DAY}, 1, 5) || '02-' || substr({_DAY}, 9, 2)
WHEN 5 THEN '1900-02-' || substr({_DAY}, 9, 2) WHEN 6 THEN '2000-02-' || substr({_DAY}, 9, 2) WHEN 7 THEN substr({_DAY}, 1, 5) || '13-' || substr({_DAY}, 9, 2) WHEN 8 THEN {_DAY} || 'T00' WHEN 9 THEN replace({_DAY}, '-', '/') ELSE {_DAY} END"""


@query(f"""WITH t AS (SELECT event_id, {_SPOILT_DATE} AS v FROM events)
SELECT event_id, CASE WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast(v AS DATE)::VARCHAR END AS date,
CASE WHEN NOT regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'format' WHEN try_cast(v AS DATE) IS NULL THEN 'range' END AS fault FROM t""")
def strict_date_parse(spark, d):
    rows = _t(spark, d, "events").select("event_id", F.expr(_SPOILT_DATE).alias("v"))
    return rows.select("event_id", C.parse_date(F.col("v")).cast("string").alias("date"), C.date_fault(F.col("v")).alias("fault"))


_ID = "CAST(page_id AS STRING)"
_IDS = f"CASE page_id % 9 WHEN 1 THEN '.' WHEN 2 THEN '..' WHEN 3 THEN '..' || {_ID} WHEN 4 THEN url WHEN 5 THEN 'a b' || {_ID} WHEN 6 THEN repeat('x', CAST(120 + page_id % 20 AS INT)) WHEN 7 THEN 'é' || {_ID} WHEN 8 THEN {_ID} || chr(10) ELSE '-page_' || {_ID} END"


@query(f"WITH t AS (SELECT page_id, {_IDS} AS v FROM pages) SELECT page_id, regexp_full_match(v, '[A-Za-z0-9._-]{{1,128}}') AND v NOT IN ('.', '..') AS valid FROM t")
def dataset_id_valid(spark, d):
    return _t(spark, d, "pages").select("page_id", C.is_valid_dataset_id(F.expr(_IDS)).alias("valid"))


_PATHS = ["a.bin", "2021/05/A/0.bin", "a/..b/c", "", "/a", "a//b", "a/", "../a", "a/./b", "a\\b", ".."]


@query(f"""SELECT v, NOT contains(v, chr(92)) AND len(list_filter(string_split(v, '/'), lambda s: s IN ('', '.', '..'))) = 0 AS safe
FROM (SELECT url AS v FROM pages UNION ALL SELECT replace(url, '://', '/') FROM pages UNION ALL SELECT v FROM {_sql_values(_PATHS)})""")
def safe_path(spark, d):
    urls = _t(spark, d, "pages").select(F.col("url").alias("v"))
    rows = urls.union(urls.select(F.replace("v", F.lit("://"), F.lit("/")))).union(_values(spark, _PATHS).select("v"))
    return rows.select("v", C.is_safe_relative_path(F.col("v")).alias("safe"))


_SPACES = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_NAMES = "CASE c_custkey % 9 WHEN 1 THEN ' ' || c_name WHEN 2 THEN c_name || ' ' WHEN 3 THEN c_name || chr(10) WHEN 4 THEN '\u00a0' || c_name WHEN 5 THEN c_name || '\u3000' WHEN 6 THEN '' WHEN 7 THEN c_name || '\u200b' WHEN 8 THEN c_name || '\u2028' ELSE c_name END"


@query(f"WITH t AS (SELECT c_custkey, {_NAMES} AS v FROM customer) SELECT c_custkey, v <> '' AND NOT regexp_matches(v, '^[{_SPACES}]') AND NOT regexp_matches(v, '[{_SPACES}]\\z') AS canonical FROM t")
def canonical_symbol(spark, d):
    return _t(spark, d, "customer").select("c_custkey", C.is_canonical_symbol(F.expr(_NAMES)).alias("canonical"))


@query("SELECT o_orderkey, day(last_day(o_orderdate))::INTEGER AS days, strftime(o_orderdate, '%Y-%m-%d') AS date, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day FROM orders")
def days_in_month(spark, d):
    date = F.to_date("o_orderdate")
    made = C.make_date(F.year(date), F.month(date), F.day(date))
    return _t(spark, d, "orders").select("o_orderkey", C.days_in_month(date).alias("days"), _text(made).alias("date"), F.year(date).alias("year"), F.month(date).alias("month"), F.day(date).alias("day"))


@query(f"WITH {_WINNERS} SELECT symbol, date::VARCHAR AS date, idx_seq, exchange FROM w")
def latest_wins(spark, d):
    return _winners(spark, d).select("symbol", _text(F.col("date")).alias("date"), "idx_seq", "exchange")


@query(f"WITH {_LISTINGS} SELECT (count(*) - count(DISTINCT (symbol, date)))::BIGINT AS superseded_rows FROM l")
def superseded_count(spark, d):
    return resolve.superseded_rows(_listings(spark, d))


#: Every component of every vector.
_EVERY = "SELECT vec_id, generate_subscripts(embedding, 1)::INTEGER AS i, unnest(embedding)::DOUBLE {times} AS v FROM embeddings"
_TWICE = "* CASE WHEN vec_id % 5 = 0 THEN 2 ELSE 1 END"


def _components(rows: DataFrame) -> DataFrame:
    """vec_id, place from 1 and value of every component of rows (vec_id, x)."""
    return rows.select("vec_id", F.posexplode("x").alias("i", "v")).select("vec_id", (F.col("i") + 1).alias("i"), F.col("v").cast("double").alias("v"))


def _vec_id() -> Column:
    return F.substring("symbol", 2, 30).cast("long").alias("vec_id")


@query(_EVERY.format(times=""))
def pinned_snapshot(spark, d):
    """The first of two datasets of an archive, read while the second is the newest."""
    rows = spark.read.format("observations").option("dataset", "ds1").load(_registered(spark, _published(spark, d)))
    return _components(rows.select(_vec_id(), "x"))


@query(f"WITH {_WINNERS}, {_PARTS} SELECT year, month, prefix, count(*) AS row_count, printf('%04d/%02d/%s', year, month, prefix) AS id FROM p GROUP BY year, month, prefix")
def partition_groups(spark, d):
    rows = resolve.partition_summary(resolve.partition_columns(_winners(spark, d)))
    return rows.withColumn("id", C.partition_id(F.col("year"), F.col("month"), F.col("prefix")))


@query(f"WITH {_WINNERS}, {_PARTS}, g AS (SELECT year, month, prefix, count(*) AS row_count FROM p GROUP BY ALL) SELECT year, month, prefix, row_number() OVER (ORDER BY year, month, prefix)::INTEGER AS place FROM g")
def partition_order(spark, d):
    from pyspark.sql.window import Window

    rows = resolve.partition_summary(resolve.partition_columns(_winners(spark, d)))  # a row for each month and letter
    return rows.select("year", "month", "prefix", F.row_number().over(Window.orderBy("year", "month", "prefix")).alias("place"))


@query(f"WITH {_WINNERS}, {_PARTS} SELECT symbol, date::VARCHAR AS date, row_number() OVER (PARTITION BY year, month, prefix ORDER BY symbol, date) - 1 AS row FROM p")
def row_ordinals(spark, d):
    return resolve.with_ordinals(resolve.partition_columns(_winners(spark, d))).select("symbol", _text(F.col("date")).alias("date"), "row")


_STEPS = "SELECT 'd' || {key} AS dataset_id, CASE WHEN {key} > 1 THEN 'd' || ({key} - 1) {last} END AS previous_dataset_id FROM {table}"


def _chain(spark: SparkSession, d: str, table: str, key: str, loop: bool) -> DataFrame:
    """A chain over a table's keys, which begin at 1: each dataset follows the one before it; ``loop``: the first follows the tenth."""
    name = lambda c: F.concat(F.lit("d"), c.cast("string"))
    before = F.when(F.col(key) > 1, name(F.col(key) - 1))
    manifests = _t(spark, d, table).select(name(F.col(key)).alias("dataset_id"), (before.otherwise("d10") if loop else before).alias("previous_dataset_id"))
    (most,) = _t(spark, d, table).agg(F.max(key)).first()
    return resolve.snapshot_chain(manifests, f"d{most}")


@query(f"""WITH RECURSIVE m AS ({_STEPS.format(key='p_partkey', table='part', last='')}), c AS (SELECT dataset_id, previous_dataset_id, 0 AS depth FROM m WHERE dataset_id = (SELECT 'd' || max(p_partkey) FROM part)
UNION ALL SELECT m.dataset_id, m.previous_dataset_id, depth + 1 FROM c JOIN m ON c.previous_dataset_id = m.dataset_id) SELECT dataset_id, depth FROM c""")
def snapshot_chain(spark, d):
    """A chain as long as the table of parts."""
    return _chain(spark, d, "part", "p_partkey", False)


@query(f"""WITH RECURSIVE m AS ({_STEPS.format(key='s_suppkey', table='supplier', last="ELSE 'd10'")}), c AS (SELECT dataset_id, previous_dataset_id, 0 AS depth, [dataset_id] AS path FROM m WHERE dataset_id = (SELECT 'd' || max(s_suppkey) FROM supplier)
UNION ALL SELECT m.dataset_id, m.previous_dataset_id, depth + 1, list_append(path, m.dataset_id) FROM c JOIN m ON c.previous_dataset_id = m.dataset_id WHERE NOT list_contains(path, m.dataset_id)) SELECT dataset_id, depth FROM c""")
def chain_loop(spark, d):
    """A chain that comes back to its tenth dataset."""
    return _chain(spark, d, "supplier", "s_suppkey", True)


@query("SELECT count(*) FILTER (n_regionkey <> 0)::BIGINT AS mismatches FROM nation")
def semantics_uniform(spark, d):
    rows = _t(spark, d, "nation").select(F.col("n_regionkey").alias("observation_extension"), F.lit(64).alias("input_count"), F.lit("f").alias("feature_fingerprint"))
    return resolve.semantic_mismatches(rows, F.struct(F.lit(0).alias("observation_extension"), F.lit(64).alias("input_count"), F.lit("f").alias("feature_fingerprint")))


@query(f"""WITH r AS ({_ROWS_SQL} UNION ALL {_AGAIN_SQL})
SELECT printf('%04d/%02d/%s', year, month, prefix) AS place, dataset, count(*) AS declared, count(*) AS listed, (count(*) * 256)::BIGINT AS bytes, true AS agree FROM r GROUP BY dataset, year, month, prefix""")
def manifest_index_crosscheck(spark, d):
    """Entries of the manifests of an archive against the rows that its indexes list."""
    root = _published(spark, d)
    entries = resolve.flatten_shards(spark.read.json(f"{root}/datasets/*.json", multiLine=True).withColumn("pub_seq", F.col("datasetId")))
    listed = resolve.flatten_rows(spark.read.json(f"{root}/*/*/*/*.index.json", multiLine=True), "shardFile", "year", "month", "prefix")
    path = F.concat(C.partition_id(F.col("year"), F.col("month"), F.col("prefix")), F.lit("/"), F.col("shardFile"))
    found = resolve.crosscheck(entries, listed.select(path.alias("path"), "row"))
    dataset = F.regexp_extract("path", "([^/-]+)-[^/]*$", 1)  # a dataset may have several shards a partition
    return found.groupBy(F.regexp_extract("path", "^(.*)/", 1).alias("place"), dataset.alias("dataset")).agg(*[F.sum(c).alias(c) for c in ("declared", "listed", "bytes")], F.min("agree").alias("agree"))


@query("SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_shard_path(spark, d):
    return resolve.duplicates(_t(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@query("""WITH g AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, sum(CASE WHEN l_linenumber >= 6 THEN n ELSE n - 1 END)::BIGINT AS faults FROM g GROUP BY 1 HAVING faults > 0""")
def ordinal_faults(spark, d):
    return resolve.ordinal_faults(_t(spark, d, "lineitem"), ["l_suppkey"], "l_linenumber", F.lit(6))


@query("SELECT label, (sum(len(embedding)) * 4)::BIGINT AS payload_bytes, (sum(len(embedding)) * 8)::BIGINT AS output_bytes FROM embeddings GROUP BY label")
def payload_bytes(spark, d):
    values = F.sum(F.size("x"))
    return _x(spark, d).groupBy("label").agg((values * 4).cast("long").alias("payload_bytes"), (values * 8).cast("long").alias("output_bytes"))


@query("SELECT doc_id, sha256(text) AS sha256, 'sha256:' || sha256(text) AS creature_uuid FROM documents")
def sha256_text(spark, d):
    sha = F.sha2(F.col("text").cast("binary"), 256)
    return _t(spark, d, "documents").select("doc_id", sha.alias("sha256"), C.creature_uuid(sha).alias("creature_uuid"))


@query("""SELECT doc_id, substr(sha256('retrospective_fixed_model|creature=sha256:' || sha256(text) || '|inputs=64|outputs=1|extension=116|features=' || lang || '|width=64|dataset=' || source || '|engine=e|engineVersion=1'), 1, 32) AS key FROM documents""")
def identity_key(spark, d):
    key = C.identity_key(C.creature_uuid(F.sha2(F.col("text").cast("binary"), 256)), F.lit(64), F.lit(1), F.lit(116), F.col("lang"), F.col("source"), F.lit("e"), F.lit("1"))
    return _t(spark, d, "documents").select("doc_id", key.alias("key"))


@query(f"WITH {_E_SQL} SELECT vec_id, {_rounded(_MODEL_SQL.format(x='x'))} AS y, true AS close FROM e")
def activate_single(spark, d):
    """One row at a time; ``close``: within 1e-5 of the formula in double precision."""
    model = Predictor(Creature("", "", MODEL), 64)

    def one(batches):
        for batch in batches:
            y = [float(model.activate_one(np.array(x, np.float32))[0]) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(y, pa.float64())], names=["vec_id", "y"])

    made = _x(spark, d).select("vec_id", "x").mapInArrow(one, "vec_id long, y double")
    exact = _x(spark, d).select("vec_id", activation_columns(MODEL, F.col("x"))[0].alias("exact"))
    return made.join(exact, "vec_id").select("vec_id", F.round("y", 2).alias("y"), _close("y", "exact"))


@query(f"WITH {_E_SQL}, n AS (SELECT vec_id, x[1:5] AS x FROM e) SELECT vec_id, round({_MODEL_SQL.format(x='x')}, 6) AS y FROM n")
def activate_narrow(spark, d):
    wide, narrow = activation_columns(MODEL, F.col("x"))[0], activation_columns(MODEL, C.first_inputs(F.col("x"), 5))[0]
    return _x(spark, d).select("vec_id", F.round(F.when(wide == narrow, narrow), 6).alias("y"))


@query(f"WITH {_E_SQL}, {_WIDE_SQL} SELECT vec_id, round(0.5 + 2.0 * c + 0.5 * x[6], 6) AS o1, round(tanh(c + a), 6) AS o2 FROM c")
def activate_multi_output(spark, d):
    one, two = activation_columns(WIDE_MODEL, F.col("x"))
    return _x(spark, d).select("vec_id", F.round(one, 6).alias("o1"), F.round(two, 6).alias("o2"))


@query(f"WITH {_E_SQL}, {_WIDE_SQL} SELECT vec_id, {_rounded('0.5 + 2.0 * c + 0.5 * x[6]')} AS o1, {_rounded('tanh(c + a)')} AS o2, true AS close FROM c")
def activate_bulk(spark, d):
    """The kernel's own values, in single precision; ``close``: all within 1e-5 of the formula in double precision."""
    exact = activation_columns(WIDE_MODEL, F.col("x"))
    made = score(_x(spark, d).select("vec_id", "x", F.array(*exact).alias("exact")), Predictor(Creature("", "", WIDE_MODEL), 64))
    near = F.forall(F.zip_with("y", "exact", lambda y, e: F.abs(y - e) <= 1e-5), lambda v: v)
    return made.select("vec_id", *[F.round(F.col("y")[i].cast("double"), 2).alias(f"o{i + 1}") for i in range(2)], near.alias("close"))


@query(f"WITH {_E_SQL}, s AS (SELECT vec_id, v.i AS i, x[v.i + 1] * v.w AS v FROM e, (VALUES (0, 0.5::DOUBLE), (1, -1.25::DOUBLE), (2, 0.75::DOUBLE)) AS v(i, w)) SELECT vec_id, round(sum(v), 6) AS total FROM s GROUP BY vec_id")
def activate_level_join(spark, d):
    synapses = spark.createDataFrame([(0, 0.5), (1, -1.25), (2, 0.75)], "i int, w double")  # a level's synapses: a fixed few rows
    inputs = _x(spark, d).select("vec_id", F.posexplode(C.first_inputs(F.col("x"), 3)).alias("i", "v"))
    return inputs.join(F.broadcast(synapses), "i").groupBy("vec_id").agg(F.round(F.sum(F.col("v").cast("double") * F.col("w")), 6).alias("total"))


@query(f"WITH {_SPOILT} SELECT vec_id, 0 AS input, CASE WHEN isnan(x[1]) THEN 'NaN' WHEN x[1] > 0 THEN 'inf' ELSE '-inf' END AS value FROM s WHERE NOT isfinite(x[1])")
def nonfinite_inputs(spark, d):
    rows = _spoilt(spark, d).select("vec_id", F.posexplode("x").alias("input", "v")).where(~C.is_finite(F.col("v")))
    return rows.select("vec_id", "input", F.when(F.isnan("v"), "NaN").when(F.col("v") > 0, "inf").otherwise("-inf").alias("value"))


def _scored_spoilt(spark, d) -> DataFrame:
    y = F.element_at("x", 1) * 2 + F.element_at("x", 2)
    return _spoilt(spark, d).select("vec_id", "label", F.array(y).alias("y"))


@query(f"WITH {_SPOILT} SELECT vec_id, 'non-finite output ' || CASE WHEN isnan(x[1]) THEN 'NaN' WHEN x[1] > 0 THEN 'inf' ELSE '-inf' END AS reason FROM s WHERE NOT isfinite(x[1])")
def refused_rows(spark, d):
    return resolve.split_refused(_scored_spoilt(spark, d))[1].select("vec_id", "reason")


@query(f"""WITH {_SPOILT}, p AS ({_ROWS_SQL}) SELECT year, month, prefix, vec_id, row_number() OVER (PARTITION BY year, month, prefix ORDER BY prefix || vec_id) - 1 AS row, round(x[1] * 2 + x[2], 6) AS y
FROM s JOIN p USING (vec_id) WHERE isfinite(x[1])""")
def written_rows(spark, d):
    """Rows with finite outputs, numbered in their partitions as they are written."""
    placed = _placed(_scored_spoilt(spark, d).select("vec_id", "y"))
    kept = resolve.with_ordinals(resolve.partition_columns(resolve.split_refused(placed)[0]))
    return kept.select("year", "month", "prefix", "vec_id", "row", F.round(F.col("y")[0], 6).alias("y"))


@query(_EVERY.format(times=""))
def widen_f32(spark, d):
    return _components(_x(spark, d).select("vec_id", C.widen(F.col("x")).alias("x")))


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS utc FROM events")
def utc_format(spark, d):
    ts = F.col("ts").cast("timestamp")
    return _t(spark, d, "events").select("event_id", C.format_utc(F.floor(F.unix_micros(ts) / 1_000_000)).alias("utc"))


@query(f"""WITH g AS (SELECT year, month, prefix, count(*) AS n FROM ({_ROWS_SQL}) GROUP BY ALL)
SELECT count(*) AS partitions, sum(n)::BIGINT AS row_count, (SELECT count(*) FROM embeddings WHERE vec_id % 5 = 0) AS superseded_rows, string_agg(printf('%04d/%02d/%s', year, month, prefix), ',' ORDER BY year, month, prefix) AS paths FROM g""")
def run_manifest_summary(spark, d):
    """What the manifest of a run says of it."""
    root = _published(spark, d)
    made = _run(spark, root).manifest
    row = (len(made["partitions"]), made["rowCount"], made["supersededRows"], ",".join(p["path"] for p in made["partitions"]))
    return spark.createDataFrame([row], "partitions long, row_count long, superseded_rows long, paths string")


@query(f"""WITH {_E_SQL}, a AS (SELECT vec_id, {_MODEL_SQL.format(x='x')} AS v FROM e WHERE vec_id % 50 <> 1), b AS (SELECT vec_id, {_MODEL_SQL.format(x='x')} + CASE WHEN vec_id % 7 = 0 THEN 0.001 * vec_id ELSE 0 END AS v FROM e WHERE vec_id % 50 <> 2)
SELECT count(*) FILTER (a.vec_id IS NOT NULL AND b.vec_id IS NOT NULL) AS compared, count(*) FILTER (a.v = b.v) AS identical, round(max(abs(a.v - b.v)), 6) AS max_abs_diff, arg_max(a.vec_id, abs(a.v - b.v)) AS worst_vec_id,
count(*) FILTER (b.vec_id IS NULL) AS only_in_first, count(*) FILTER (a.vec_id IS NULL) AS only_in_second, false AS agree FROM a FULL JOIN b ON a.vec_id = b.vec_id""")
def prediction_diff(spark, d):
    y = activation_columns(MODEL, F.col("x"))[0]
    rows = _x(spark, d).select("vec_id", y.alias("value"))
    other = rows.where("vec_id % 50 <> 2").withColumn("value", F.col("value") + F.when(F.col("vec_id") % 7 == 0, 0.001 * F.col("vec_id")).otherwise(0.0))
    made = compare.prediction_diff(rows.where("vec_id % 50 <> 1"), other, ("vec_id",))
    return made.withColumn("max_abs_diff", F.round("max_abs_diff", 6))


@query("SELECT vec_id FROM embeddings WHERE vec_id % 50 = 2")
def prediction_missing(spark, d):
    rows = _x(spark, d).select("vec_id")
    return compare.missing_rows(rows, rows.where("vec_id % 50 <> 2"), ("vec_id",))


def _registered(spark: SparkSession, root: str) -> str:
    from skyledger.plans.run import register

    register(spark)
    return root


def _run(spark: SparkSession, root: str, **dates: MarketDate):
    """A run of MODEL over the archive."""
    from skyledger.plans.run import PredictRequest, run
    from skyledger.sources.files import write_bytes

    base = root[: -len("/116/f00d")]
    write_bytes(f"{base}/model.json", json.dumps(MODEL).encode())
    return run(spark, PredictRequest(f"{base}/model.json", root, f"{base}/predictions/run", **dates))


def _published(spark: SparkSession, d: str) -> str:
    """An archive of all embeddings in two publications; the second restates every fifth row with its values doubled."""
    root = f"{scratch_path(spark, 'archive')}/116/f00d"
    rows = _placed(_x(spark, d).select("vec_id", "x")).withColumn("exchange", F.lit("X"))
    write_archive(rows, root, "ds1", 64, 116, "f00d")
    write_archive(rows.where("vec_id % 5 = 0").withColumn("x", F.transform("x", lambda v: v * 2)), root, "ds2", 64, 116, "f00d")
    return root


@query(_EVERY.format(times=_TWICE))
def f32le_roundtrip(spark, d):
    from skyledger.plans.run import observations
    from skyledger.sources.archive import open_archive

    rows = observations(spark, open_archive(spark, _published(spark, d)))
    return _components(rows.select(_vec_id(), "x"))


@query(f"""WITH {_E_SQL}, v AS (SELECT vec_id, list_transform(x, lambda i: i * CASE WHEN vec_id % 5 = 0 THEN 2 ELSE 1 END) AS x FROM e WHERE DATE '2021-01-01' + (vec_id % 90)::INTEGER BETWEEN DATE '2021-01-15' AND DATE '2021-02-20')
SELECT vec_id, {_rounded(_MODEL_SQL.format(x='x'))} AS y, true AS close FROM v""")
def archive_end_to_end(spark, d):
    """A run over an archive, read back: the kernel's own values; ``close``: within 1e-5 of the formula in double precision."""
    made = _run(spark, _published(spark, d), first=MarketDate(2021, 1, 15), last=MarketDate(2021, 2, 20))
    rows = spark.read.format("predictions").load(made.output).select(_vec_id(), F.col("y")[0].alias("made"))
    current = F.transform("x", lambda v: v * F.when(F.col("vec_id") % 5 == 0, 2).otherwise(1))
    exact = _x(spark, d).select("vec_id", activation_columns(MODEL, current)[0].alias("exact"))
    return rows.join(exact, "vec_id").select("vec_id", F.round("made", 2).alias("y"), _close("made", "exact"))


#: Damage to the index or payload of a partition, and the kind of the fault: what is changed where. Each is done to another partition.
_DAMAGE = [
    ("schema", "index", {"schema": "x"}), ("semantics", "index", {"inputCount": 3}), ("corrupt", "index", {"shardFile": "x.bin"}), ("corrupt", "index", {"rowCount": 2}), ("corrupt", "index", {"shardBytes": 3}), ("hash", "index", {"shardSha256": "0"}),
    ("corrupt", "index", {"month": 12}), ("corrupt", "row", {"symbol": " A"}), ("corrupt", "row", {"date": "2021-5-04"}), ("corrupt", "row", {"row": 99999999}), ("corrupt", "row", {"symbol": "é"}), ("json", "index", {"rows": 3}),
    ("corrupt", "payload", b"\0"), ("hash", "payload", "zeros"), ("io", "payload", None), ("corrupt", "payload", "nan"),
]
_KINDS = ", ".join(f"({k + 1}, '{kind}')" for k, (kind, *_) in enumerate(_DAMAGE))


def _edit(path: str, change: Callable[[dict], object]) -> None:
    from skyledger.sources.files import pretty, read_bytes, write_bytes

    made = json.loads(read_bytes(path))
    change(made)
    write_bytes(path, pretty(made))


def _damage(root: str, entry: dict, where: str, change) -> None:
    """Spoils the index or payload of a shard; payloads that are to differ in values alone get their hash everywhere."""
    from skyledger.functions.values import sha256_hex
    from skyledger.sources.files import file_system, read_bytes, write_bytes

    path = f"{root}/{entry['path']}"
    index = f"{path[:-4]}.index.json"
    if where == "index":
        _edit(index, lambda made: made.update(change))
    elif where == "row":
        _edit(index, lambda made: made["rows"][0].update(change))
    elif change is None:
        fs, at = file_system(path)
        fs.delete_file(at)
    elif change == "zeros":
        write_bytes(path, b"\0" * entry["bytes"])
    elif change == "nan":
        data = b"\0\0\xc0\x7f" + read_bytes(path)[4:]
        write_bytes(path, data)
        entry["sha256"] = sha256_hex(data)
        _edit(index, lambda made: made.update(shardSha256=entry["sha256"]))
    else:
        write_bytes(path, change)


@query(f"""WITH r AS ({_ROWS_SQL}), g AS (SELECT year, month, prefix, count(*) AS n, row_number() OVER (ORDER BY year, month, prefix) AS k FROM r GROUP BY year, month, prefix)
SELECT year, month, prefix, CASE WHEN kind IS NULL THEN n END AS n_rows, kind FROM g LEFT JOIN (VALUES {_KINDS}) AS t(k, kind) USING (k)""")
def archive_faults(spark, d):
    """An archive of all embeddings with damage of another kind in each of its first partitions, as its reader tells of them: the fault of each
    damaged partition, and the rows of the others."""
    root = f"{scratch_path(spark, 'archive')}/116/f00d"
    rows = _placed(_x(spark, d).select("vec_id", "x"))
    write_archive(rows.coalesce(1), root, "ds1", 64, 116, "f00d")
    _registered(spark, root)

    def spoil(manifest: dict) -> None:
        shards: dict[tuple, dict] = {}
        for e in manifest["shards"]:
            shards.setdefault((e["year"], e["month"], e["prefix"].encode()), e)
        for (_, where, change), key in zip(_DAMAGE, sorted(shards)):
            _damage(root, shards[key], where, change)

    _edit(f"{root}/datasets/ds1.json", spoil)
    found = spark.read.format("observations").option("faults", "rows").load(root)
    kind = F.get_json_object("fault", "$[0]")
    return found.groupBy("year", "month", "prefix").agg(F.nullif(F.count("symbol"), F.lit(0)).alias("n_rows"), F.max(kind).alias("kind"))


#: Damage to the chain's documents: name, kind of the fault, the datasets whose manifests change, and how; an entry's change is one of its first shard.
_CHAIN_DAMAGE = [
    ("none", "ok", [], {}), ("unsafe previous id", "corrupt", ["ds2"], {"previousDatasetId": ".."}), ("loop", "corrupt", ["ds1"], {"previousDatasetId": "ds2"}), ("manifest schema", "schema", ["ds1"], {"schema": "x"}),
    ("byte order", "schema", ["ds2"], {"byteOrder": "big-endian"}), ("other name", "corrupt", ["ds1"], {"datasetId": "ds9"}), ("no width", "corrupt", ["ds1", "ds2"], {"inputCount": 0}), ("mixed semantics", "semantics", ["ds1"], {"featureFingerprint": "x"}),
    ("other root", "semantics", ["ds1", "ds2"], {"observationExtension": 7}), ("missing dataset", "io", ["ds2"], {"previousDatasetId": "ds0"}), ("no field", "json", ["ds2"], {"inputCount": None}), ("entry without .bin", "corrupt", ["ds2"], {"path": "2021/01/A/ds2.dat"}),
    ("entry outside", "corrupt", ["ds2"], {"path": "../ds2.bin"}), ("entry with other rows", "corrupt", ["ds2"], {"rowCount": 1 << 40}), ("entry with other bytes", "corrupt", ["ds2"], {"bytes": 3}), ("entry twice", "corrupt", ["ds2"], {"path": "first"}),
]


@query("SELECT damage, kind, (SELECT count(*) + count(*) FILTER (vec_id % 5 = 0) FROM embeddings) AS listed FROM (VALUES " + ", ".join(f"('{name}', '{kind}')" for name, kind, *_ in _CHAIN_DAMAGE) + ") AS t(damage, kind)")
def chain_faults(spark, d):
    """What the reader says of the archive of all embeddings when documents of its chain are spoilt, one way at a time."""
    from skyledger.sources.archive import open_archive
    from skyledger.sources.files import ArchiveError, read_bytes, write_bytes

    root = _published(spark, d)
    whole = {name: read_bytes(f"{root}/datasets/{name}.json") for name in ("ds1", "ds2")}
    first = json.loads(whole["ds1"])["shards"][0]["path"]
    listed = sum(e["rowCount"] for text in whole.values() for e in json.loads(text)["shards"])

    def spoil(change: dict) -> Callable[[dict], object]:
        return lambda made: [made["shards"][0].update({k: first if v == "first" else v}) if k in ("path", "rowCount", "bytes") else made.update({k: v}) for k, v in change.items()]

    def kind_of(names: list[str], change: dict) -> str:
        try:
            for name in names:
                _edit(f"{root}/datasets/{name}.json", spoil(change))
            open_archive(spark, root)
            return "ok"
        except ArchiveError as e:
            return e.kind
        finally:
            for name in names:
                write_bytes(f"{root}/datasets/{name}.json", whole[name])

    return spark.createDataFrame([(name, kind_of(names, change), listed) for name, _, names, change in _CHAIN_DAMAGE], "damage string, kind string, listed long")


#: An output of 1e20 * 2e19 times the first value, which single precision can't hold for most rows.
_HOT_MODEL = {
    "input": 1, "output": 1, "forwardOnly": True,
    "neurons": [{"type": "hidden", "uuid": "far", "bias": 0.0, "squash": "IDENTITY"}, {"type": "output", "uuid": "farther", "bias": 0.0, "squash": "IDENTITY"}],
    "synapses": [{"fromUUID": "input-0", "toUUID": "far", "weight": 1e20}, {"fromUUID": "far", "toUUID": "farther", "weight": 2e19}],
}


@query(f"""WITH c AS (SELECT count(*) AS every, count(*) FILTER (abs(embedding[1]::DOUBLE {_TWICE}) * 2e39 < 3.4028235677973366e38) AS finite FROM embeddings)
SELECT n, request, outcome, CASE k WHEN 1 THEN every WHEN 2 THEN finite ELSE 0 END::BIGINT AS n_rows FROM c,
(VALUES (1, 'first', '0', 1), (2, 'again', 'complete', 1), (3, 'other dates', '73', 0), (4, 'dates in reverse', '64', 0), (5, 'no model', '66', 0), (6, 'refused rows', '3', 2), (7, 'again with refused rows', 'complete', 2), (8, 'damaged payload', '65', 0)) AS t(n, request, outcome, k)""")
def run_outcomes(spark, d):
    """How runs over the archive of all embeddings end: exit codes, or ``complete`` for a run that was there; and how many rows the output holds."""
    from skyledger.plans.run import PredictRequest, exit_code, run
    from skyledger.sources.files import write_bytes

    root = _published(spark, d)
    base = root[: -len("/116/f00d")]
    write_bytes(f"{base}/model.json", json.dumps(MODEL).encode())
    write_bytes(f"{base}/hot.json", json.dumps(_HOT_MODEL).encode())
    found = []

    def ends(n: int, name: str, **changes) -> None:
        request = PredictRequest(**({"creature": f"{base}/model.json", "archive": root, "output": f"{base}/out/run"} | changes))
        try:
            made = run(spark, request)
            outcome = "complete" if made.already_complete else "3" if made.manifest["refused"] else "0"
            found.append((n, name, outcome, made.manifest["rowCount"]))
        except Exception as e:
            found.append((n, name, str(exit_code(e)), 0))

    ends(1, "first")
    ends(2, "again")
    ends(3, "other dates", first=MarketDate(2021, 1, 1))
    ends(4, "dates in reverse", first=MarketDate(2021, 1, 2), last=MarketDate(2021, 1, 1))
    ends(5, "no model", creature=f"{base}/none.json")
    hot = {"creature": f"{base}/hot.json", "output": f"{base}/out/hot"}
    ends(6, "refused rows", **hot)
    ends(7, "again with refused rows", **hot)
    from skyledger.sources.files import read_bytes

    write_bytes(f"{root}/{json.loads(read_bytes(f'{root}/datasets/ds2.json'))['shards'][0]['path']}", b"")
    ends(8, "damaged payload", output=f"{base}/out/damaged")
    return spark.createDataFrame(found, "n int, request string, outcome string, n_rows long")


@query(f"""WITH e AS ({_ROWS_SQL}) SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 'ds2' ELSE 'ds1' END AS dataset, (vec_id % 5 = 0)::INTEGER + 1 AS publications, embedding[64]::DOUBLE {_TWICE} AS last FROM e JOIN embeddings USING (vec_id)""")
def change_feed(spark, d):
    """The publications of an archive as a feed: how often each vector was published, and what the last of them says."""
    rows = spark.read.format("observation_changes").load(_registered(spark, _published(spark, d)))
    last = F.max_by(F.struct("dataset", F.element_at("x", 64).cast("double").alias("last")), "publication").alias("r")
    return rows.groupBy(_vec_id()).agg(F.count("*").cast("int").alias("publications"), last).select("vec_id", "r.dataset", "publications", "r.last")


@query(f"""WITH e AS ({_ROWS_SQL}) SELECT vec_id, month, embedding[1]::DOUBLE {_TWICE} AS first FROM e JOIN embeddings USING (vec_id) WHERE (prefix = 'Z' OR vec_id = 7) AND month <= 2""")
def symbol_pruning(spark, d):
    """Rows by symbol: only the folders of its letter are opened, a month each."""
    root = _registered(spark, _published(spark, d))
    rows = lambda: spark.read.format("observations").option("pushdown", "true").load(root)  # noqa: E731  a load each
    z, one = rows().where("symbol LIKE 'Z%' AND month <= 2"), rows().where("symbol = '37' AND date < DATE'2021-03-01'")
    return z.unionByName(one).select(_vec_id(), "month", F.element_at("x", 1).cast("double").alias("first"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey % 150 AS u, TIMESTAMP '2024-01-01' + to_seconds((o_orderkey * 7919) % 2592000) AS t FROM orders),
e AS (SELECT user_id, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id, ts)
SELECT o_orderkey, e.event_id AS right_event_id, round(e.value, 6) AS right_value FROM o ASOF LEFT JOIN e ON o.u = e.user_id AND o.t >= e.ts""")
def asof_last_event(spark, d):
    """The last event of a user at or before the moment of each order."""
    moment = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("o_orderkey") * 7919, F.lit(2592000))).cast("timestamp_ntz")
    orders = _t(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 150).alias("u"), moment.alias("t"))
    found = temporal.asof_join(orders, _t(spark, d, "events").select("event_id", "user_id", "ts", "value"), ("u", "user_id"), ("t", "ts"), ("event_id",))
    return found.select("o_orderkey", "right_event_id", F.round("right_value", 6).alias("right_value"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey % 150 AS user_id, (o_orderkey * 7919) % 2592000 AS s FROM orders), e AS (SELECT event_id, user_id, epoch(ts)::BIGINT - 1704067200 AS s FROM events)
SELECT o_orderkey, count(*) AS n_events, max(event_id) AS last_event FROM o JOIN e ON o.user_id = e.user_id AND e.s BETWEEN o.s AND o.s + 21600 + o_orderkey % 7 * 3600 GROUP BY o_orderkey""")
def interval_events(spark, d):
    """Events of a user within some hours of each order's moment, as a join of intervals by bins."""
    begin = F.pmod(F.col("o_orderkey") * 7919, F.lit(2592000))
    orders = _t(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 150).alias("user_id"), begin.alias("low"), (begin + 21600 + F.col("o_orderkey") % 7 * 3600).alias("high"))
    at = F.rint(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long") - 1704067200  # the nearest second, halves to even
    events = _t(spark, d, "events").select("event_id", "user_id", at.alias("at"))
    pairs = temporal.interval_join(orders, events, ["user_id"], (F.col("low"), F.col("high")), (F.col("at"), F.col("at")), 28800)
    return pairs.groupBy("o_orderkey").agg(F.count("*").alias("n_events"), F.max("event_id").alias("last_event"))


@query(f"""WITH {_E_SQL}, v AS (SELECT vec_id, list_transform(x, lambda i: i {_TWICE}) AS x FROM e WHERE DATE '2021-01-01' + (vec_id % 90)::INTEGER BETWEEN DATE '2021-01-15' AND DATE '2021-02-20'),
p AS (SELECT vec_id, month, row_number() OVER (PARTITION BY year, month, prefix ORDER BY prefix || vec_id) - 1 AS row FROM ({_ROWS_SQL}) JOIN v USING (vec_id))
SELECT vec_id, month, row, {_rounded(_MODEL_SQL.format(x='x'))} AS y, true AS close FROM v JOIN p USING (vec_id)""")
def archive_scored_in_sql(spark, d):
    """The range of archive_end_to_end, scored by a statement: the kernel's own values, and each row's place in its partition."""
    from skyledger.sources.files import write_bytes

    root = _registered(spark, _published(spark, d))
    model = f"{root[: -len('/116/f00d')]}/model.json"
    write_bytes(model, json.dumps(MODEL).encode())
    rows = spark.read.format("observations").load(root)
    made = spark.sql(
        """SELECT * FROM score_archive(TABLE(SELECT * FROM {rows} WHERE date BETWEEN DATE '2021-01-15' AND DATE '2021-02-20')
        PARTITION BY (year, month, prefix) ORDER BY (symbol, date), {model})""",
        rows=rows, model=model,
    )
    current = F.transform("x", lambda v: v * F.when(F.col("vec_id") % 5 == 0, 2).otherwise(1))
    exact = _x(spark, d).select("vec_id", activation_columns(MODEL, current)[0].alias("exact"))
    scored = made.where("refused IS NULL").select(_vec_id(), "month", "row", F.col("y")[0].alias("made"))
    return scored.join(exact, "vec_id").select("vec_id", "month", "row", F.round("made", 2).alias("y"), _close("made", "exact"))


_QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


@query(f"""WITH {_E_SQL}, p AS (SELECT month, {_MODEL_SQL.format(x='v.x')} AS y FROM (SELECT vec_id, list_transform(x, lambda i: i {_TWICE}) AS x FROM e) AS v JOIN ({_ROWS_SQL}) USING (vec_id))
SELECT month, count(*) AS n_rows, {_rounded('min(y)')} AS least, {_rounded('max(y)')} AS most, {_rounded('avg(y)')} AS mean, true AS quantiles_within, true AS symbols_within FROM p GROUP BY ROLLUP (month)""")
def prediction_sketches(spark, d):
    """What the sketches kept beside a run say of each month and of all: exact counts and extremes, and whether quantiles and numbers of symbols lie
    within the stated errors of the outputs' own."""
    output = _run(spark, _published(spark, d)).output
    kept = sketches.keep_sketches(spark, output)
    said = sketches.merged(kept, "month", quantiles=_QUANTILES).unionByName(sketches.merged(kept, quantiles=_QUANTILES).withColumn("month", F.lit(None).cast("int")))
    rows = spark.read.format("predictions").load(output).select("symbol", F.explode(F.array("month", F.lit(None).cast("int"))).alias("m"), F.col("y")[0].alias("y"))
    met = rows.join(F.broadcast(said.select(F.col("month").alias("m2"), "quantiles")), F.col("m").eqNullSafe(F.col("m2")))  # a row a month
    ranks = [F.array(F.avg((F.col("y") < F.col("quantiles")[i]).cast("int")), F.avg((F.col("y") <= F.col("quantiles")[i]).cast("int"))) for i in range(len(_QUANTILES))]
    true = met.groupBy("m").agg(F.array(*ranks).alias("ranks"), F.count_distinct("symbol").alias("symbols"))
    both = said.join(true, F.col("month").eqNullSafe(F.col("m")))
    q, slack = F.array(*[F.lit(v) for v in _QUANTILES]), 2 * sketches.RANK_ERROR  # a sketch may miss its error once in 100 times
    near = F.forall(F.zip_with("ranks", q, lambda r, v: (r[0] <= v + slack) & (r[1] >= v - slack)), lambda v: v)
    symbols = F.abs(F.col("n_symbols") - F.col("symbols")) <= 1 + 2 * sketches.DISTINCT_ERROR * F.col("symbols")
    return both.select("month", "n_rows", *[F.round(c, 2).alias(c) for c in ("least", "most", "mean")], near.alias("quantiles_within"), symbols.alias("symbols_within"))


@query(f"WITH {_WINNERS} SELECT symbol, date::VARCHAR AS date, pub_seq, idx_seq, exchange, 1::BIGINT AS net FROM w JOIN (SELECT pub_seq, idx_seq FROM l) USING (idx_seq)")
def restated_changes(spark, d):
    """The listings as a stream whose second half restates keys of the first: what is left when every ``-`` has taken its ``+`` away."""
    base = scratch_path(spark, "restated")
    listings = _listings(spark, d)
    for half in range(2):  # the stream goes on where it stopped
        listings.where(F.col("idx_seq") % 2 == half).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(listings.schema).parquet(f"{base}/in")
        restated_rows_merged(stream, ["pub_seq", "idx_seq"], base).trigger(availableNow=True).start().awaitTermination()
    changes = spark.read.parquet(f"{base}/changes").withColumn("date", _text(F.col("date")))
    net = F.sum(F.when(F.col("change") == "+", 1).otherwise(-1)).alias("net")
    return changes.groupBy("symbol", "date", "pub_seq", "idx_seq", "exchange").agg(net).where("net <> 0")
