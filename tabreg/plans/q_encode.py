"""Dictionary encoding of many-valued columns (A10, F4, F5, F7) and type
inference on read (IO1-IO3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabreg.operators import dictionary as D
from tabreg.operators import prep as R
from tabreg.operators.frames import lookup
from tabreg.plans.sql import is_test
from tabreg.session import shared_scratch
from tabreg.sources.dictionary_file import read_dictionary
from tabreg.sources.infer import FORMS, csv_type_profile, infer_csv
from tabreg.sources.tables import read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Beyond this many values these queries' columns are encoded by a table.
LITERALS = 1000


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ dictionaries

def _coded(spark, sf):
    """lineitem with a many-valued key, null for one line in seven, and its text."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"])
    key = F.when(F.col("l_linenumber") != 4, F.col("l_orderkey"))
    return li.select("l_orderkey", "l_linenumber", key.alias("order_code"), key.cast("string").alias("order_text"))


CODED = """li AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 4 THEN l_orderkey END AS order_code,
         CAST(CASE WHEN l_linenumber <> 4 THEN l_orderkey END AS VARCHAR) AS order_text FROM lineitem)"""
SPLIT = f"tr AS (SELECT * FROM li WHERE NOT {is_test('l_orderkey')}), te AS (SELECT * FROM li WHERE {is_test('l_orderkey')} OR l_linenumber < 3)"


def _split(spark, sf):
    """Training rows, and rows to encode: unseen orders and a part of the seen ones."""
    df = _coded(spark, sf)
    held = R.with_split(df, "l_orderkey", 0.2)
    return held.filter("NOT is_test").drop("is_test"), held.filter("is_test OR l_linenumber < 3").drop("is_test")


@q("dictionary_categories")
def dictionary_categories(spark, sf):
    return D.category_table(D.fit_dictionaries(_coded(spark, sf), ["order_code", "order_text"]))


ORACLES["dictionary_categories"] = f"""
WITH {CODED},
c AS (SELECT order_code AS v, count(*) AS n FROM li GROUP BY 1),
t AS (SELECT order_text AS v, count(*) AS n FROM li GROUP BY 1)
SELECT 'order_code' AS "column", CAST(v AS VARCHAR) AS value, dense_rank() OVER (ORDER BY v NULLS LAST) - 1 AS code, n FROM c
UNION ALL
SELECT 'order_text', v, dense_rank() OVER (ORDER BY v NULLS LAST) - 1, n FROM t"""


@q("label_encode_dictionary")
def label_encode_dictionary(spark, sf):
    train, rows = _split(spark, sf)
    model = R.OrdinalEncoder({"order_code": None, "order_text": None}, literals=LITERALS).fit(train)
    return model.transform(rows)


ORACLES["label_encode_dictionary"] = f"""
WITH {CODED}, {SPLIT},
c AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT order_code AS v FROM tr) WHERE v IS NOT NULL),
t AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT order_text AS v FROM tr) WHERE v IS NOT NULL)
SELECT l_orderkey, l_linenumber, CAST(coalesce(c.code, -1) AS DOUBLE) AS order_code,
       CAST(coalesce(t.code, -1) AS DOUBLE) AS order_text
FROM te LEFT JOIN c ON order_code = c.v LEFT JOIN t ON order_text = t.v"""


def _slots(spark, sf, drop_first):
    """One-hot as (row, slot, name): the non-zero of each row's sparse vector."""
    train, rows = _split(spark, sf)
    fitted = D.fit_dictionary(train, "order_code")
    coded = fitted.with_code(rows.select("l_orderkey", "l_linenumber", "order_code"), "code", null="own")
    names = fitted.one_hot_names(drop_first)
    slot = (F.col("code") - int(drop_first)).alias("row_slot")
    return coded.select("l_orderkey", "l_linenumber", slot).join(names, F.col("row_slot") == F.col("slot")).drop("row_slot")


def _slots_sql(first):
    return f"""
WITH {CODED}, {SPLIT},
c AS (SELECT v, row_number() OVER (ORDER BY v NULLS LAST) - 1 - {first} AS slot FROM (SELECT DISTINCT order_code AS v FROM tr))
SELECT l_orderkey, l_linenumber, slot, 'order_code_' || coalesce(CAST(v AS VARCHAR), 'nan') AS name
FROM te JOIN c ON order_code IS NOT DISTINCT FROM c.v WHERE slot >= 0"""


@q("one_hot_dictionary")
def one_hot_dictionary(spark, sf):
    return _slots(spark, sf, False)


ORACLES["one_hot_dictionary"] = _slots_sql(0)


@q("one_hot_dictionary_drop_first")
def one_hot_dictionary_drop_first(spark, sf):
    return _slots(spark, sf, True)


ORACLES["one_hot_dictionary_drop_first"] = _slots_sql(1)

# ------------------------------------------------------------------ inference

TEXT_COLUMNS = ["order_key", "price", "order_date", "changed", "is_final", "price_or_missing", "key_or_word", "nothing",
                "comment_like"]


def _orders_csv(spark, sf):
    """orders as CSV in the shared folder: every candidate type, missing tokens, a mixed column."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate"])
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = o.select(
        F.col("o_orderkey").cast("string").alias("order_key"), F.col("o_totalprice").cast("string").alias("price"),
        day.alias("order_date"), F.concat(day, F.lit(" 12:30:15")).alias("changed"),
        F.when(F.col("o_orderstatus") == "F", "True").otherwise("False").alias("is_final"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("string")).otherwise("NA").alias("price_or_missing"),
        F.when(F.col("o_orderkey") % 100 == 1, F.concat(F.lit("no key, "), F.col("o_orderkey")))
        .otherwise(F.col("o_orderkey").cast("string")).alias("key_or_word"),
        F.lit("None").alias("nothing"), F.concat(F.lit('a "quoted", '), F.col("o_orderpriority")).alias("comment_like"))
    path = shared_scratch(spark, "csv-inferred")
    text.write.option("header", True).option("escape", '"').csv(path)
    return path


ORDERS_TEXT = """t AS (
  SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders)"""


@q("csv_type_profile")
def csv_types(spark, sf):
    return csv_type_profile(spark, _orders_csv(spark, sf))


def _counts(column, null="0", values=None, inferred="string", conflicts="0", conflict="NULL"):
    values = values or {}
    return (f"SELECT '{column}' AS \"column\", count(*) AS n_rows, {null} AS n_null, "
            + ", ".join(f"{values.get(k, 0)} AS n_{k}" for k in FORMS)
            + f", '{inferred}' AS inferred, {conflicts} AS n_conflicts, {conflict} AS conflict FROM t")


_OTHER = "count(*) FILTER (o_orderstatus <> 'F')"
_WORDS = "count(*) FILTER (o_orderkey % 100 = 1)"
ORACLES["csv_type_profile"] = f"WITH {ORDERS_TEXT} " + " UNION ALL ".join((
    _counts("order_key", values={"long": "count(*)", "double": "count(*)"}, inferred="long"),
    _counts("price", values={"double": "count(*)"}, inferred="double"),
    _counts("order_date", values={"date": "count(*)", "timestamp": "count(*)"}, inferred="date"),
    _counts("changed", values={"timestamp": "count(*)"}, inferred="timestamp"),
    _counts("is_final", values={"boolean": "count(*)"}, inferred="boolean"),
    _counts("price_or_missing", null=_OTHER, values={"double": f"count(*) - {_OTHER}"}, inferred="double"),
    _counts("key_or_word", values={"long": f"count(*) - {_WORDS}", "double": f"count(*) - {_WORDS}"},
            conflicts=_WORDS, conflict="min('no key, ' || o_orderkey) FILTER (o_orderkey % 100 = 1)"),
    _counts("nothing", null="count(*)", inferred="double"),
    _counts("comment_like")))


@q("csv_inferred_read")
def csv_inferred_read(spark, sf):
    """The same file, read with the types that inference finds."""
    df = infer_csv(spark, _orders_csv(spark, sf))
    return df.select("order_key", "price", F.date_add("order_date", 1).cast("string").alias("next_day"),
                     (F.col("changed") + F.expr("INTERVAL 1 HOUR")).cast("string").alias("an_hour_on"),
                     "is_final", "price_or_missing", "key_or_word", "nothing", "comment_like")


ORACLES["csv_inferred_read"] = f"""
WITH {ORDERS_TEXT}
SELECT o_orderkey AS order_key, o_totalprice AS price, strftime(day + 1, '%Y-%m-%d') AS next_day,
       strftime(day, '%Y-%m-%d') || ' 13:30:15' AS an_hour_on, o_orderstatus = 'F' AS is_final,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price_or_missing,
       CASE WHEN o_orderkey % 100 = 1 THEN 'no key, ' ELSE '' END || o_orderkey AS key_or_word,
       CAST(NULL AS DOUBLE) AS nothing, 'a "quoted", ' || o_orderpriority AS comment_like
FROM t"""

# ------------------------------------------------------------------ data dictionary as text


def _dictionary_text(spark, sf):
    """A dictionary file of two columns, every fifth part's meaning over two lines."""
    part = read_table(spark, sf, "part", ["p_partkey", "p_name", "p_type"])
    nation = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    head = spark.createDataFrame([
        (0, 0, "p_partkey: Number of a part.\t\n"), (1, 0, "\nc_nationkey: Nation of a customer,\n  by number: 0 to 24\n")],
        "block int, place long, value string")
    codes = part.select(F.lit(0).alias("block"), (F.col("p_partkey") + 1).alias("place"), F.concat(
        F.lit("        "), "p_partkey", F.lit("\t"), "p_name",
        F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("\n            of type "), "p_type")).otherwise(F.lit("\t"))).alias("value"))
    nations = nation.select(F.lit(1).alias("block"), (F.col("n_nationkey") + 1).cast("long").alias("place"), F.concat(
        F.lit("       "), "n_nationkey", F.lit(" \t"), "n_name").alias("value"))
    path = shared_scratch(spark, "dictionary-text")
    head.unionByName(codes).unionByName(nations).orderBy("block", "place").select("value").write.text(path)
    return path


DICTIONARY = """d AS (
  SELECT 'p_partkey' AS "column", NULL AS code, 'Number of a part.' AS meaning
  UNION ALL SELECT 'c_nationkey', NULL, 'Nation of a customer, by number: 0 to 24'
  UNION ALL SELECT 'c_nationkey', CAST(n_nationkey AS VARCHAR), n_name FROM nation
  UNION ALL SELECT 'p_partkey', CAST(p_partkey AS VARCHAR),
                   p_name || CASE WHEN p_partkey % 5 = 0 THEN ' of type ' || p_type ELSE '' END FROM part)"""


@q("data_dictionary")
def data_dictionary(spark, sf):
    return read_dictionary(spark, _dictionary_text(spark, sf))


ORACLES["data_dictionary"] = f"WITH {DICTIONARY} SELECT * FROM d"


@q("data_dictionary_lookup")
def data_dictionary_lookup(spark, sf):
    """Customers with the meaning of their nation's code, from the file."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"]).withColumn("c_nationkey", F.col("c_nationkey").cast("string"))
    return lookup(c, "c_nationkey", read_dictionary(spark, _dictionary_text(spark, sf)))


ORACLES["data_dictionary_lookup"] = f"""
WITH {DICTIONARY}
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, meaning AS c_nationkey_meaning
FROM customer LEFT JOIN d ON "column" = 'c_nationkey' AND code = CAST(c_nationkey AS VARCHAR)"""
