"""Group A queries: scans, parsers, manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.manifest import dataset_manifest, split_at_years, split_rolling_years
from ..sources.parsing import (coerce_double, decode_product_code, encode_product_code, extract_list_items,
                               json_arrays_to_rows, locale_double)
from ..session import scratch_folder
from ..sources.readers import coalesce_sources, read_dataset, read_newest, write_table
from .inputs import SQL_INTERVALS, order_intervals
from .registry import Tables, query

DOC_ROWS = 24  # values per columnar JSON document (one "request" = one day of hours)


@query("a1_read_dataset", """
SELECT event_id, ts, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""",
       doubles=["value"])
def q_read(spark, sf_dir):
    """A1: declared-schema read; the filter and projection reach the parquet scan."""
    df = read_dataset(spark, f"{sf_dir}/events.parquet")
    return df.filter(F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp")).select(
        "event_id", "ts", "event_type", "value")


@query("a2_newest_snapshot", """
SELECT year(o_orderdate) AS year, count(*) AS orders, sum(o_totalprice) AS total FROM orders GROUP BY 1""",
       doubles=["total"], ints=["year"])
def q_newest(spark, sf_dir):
    """A2: three snapshots of a dataset, each with more of ``orders``, and a later dataset whose name begins alike;
    the newest snapshot of the exact name is found from file metadata and read."""
    root = scratch_folder(spark, "snapshots")
    o = Tables(spark, sf_dir)("orders", "o_orderdate", "o_totalprice")
    for name, upto in (("first", "1997-01-01"), ("second", "1999-01-01"), ("third", "9999-01-01")):
        write_table(o.where(F.col("o_orderdate") < F.lit(upto).cast("timestamp")), f"{root}/orders/{name}")
    write_table(o.withColumn("o_totalprice", F.col("o_totalprice") * 2), f"{root}/orders_forecast/fourth")
    return (read_newest(spark, root, "orders").groupBy(F.year("o_orderdate").alias("year"))
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("total")))


@query("a3_preferred_source", """
WITH c AS (SELECT o_orderpriority AS series_id, o_orderdate AS ts, sum(o_totalprice) AS value FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
r AS (SELECT o_orderpriority AS series_id, o_orderdate AS ts, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2)
SELECT coalesce(c.series_id, r.series_id) AS series_id, coalesce(c.ts, r.ts) AS ts, coalesce(c.value, r.value) AS value
FROM c FULL JOIN r ON c.series_id = r.series_id AND c.ts = r.ts""", doubles=["value"])
def q_preferred(spark, sf_dir):
    """A3: a cleaned source (finished orders) where it has a value, the raw one (all orders) elsewhere."""
    o = Tables(spark, sf_dir)("orders", "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderstatus")
    key = [F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").alias("ts")]
    total = F.sum("o_totalprice").alias("value")
    return coalesce_sources(o.where("o_orderstatus = 'F'").groupBy(*key).agg(total), o.groupBy(*key).agg(total),
                            ["series_id", "ts"], "value")


@query("a9_partitioned_write", """
SELECT year(o_orderdate) AS year, o_orderpriority AS series_id, count(*) AS orders, sum(o_totalprice) AS total
FROM orders GROUP BY 1, 2""", doubles=["total"], ints=["year"])
def q_written(spark, sf_dir):
    """``orders`` written by year to the shared folder, one file a year and task, and read back with the year
    as partition column (a filter on it reads only its folders; tests look at the plan)."""
    return (written_by_year(spark, sf_dir).groupBy("year", F.col("o_orderpriority").alias("series_id"))
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("total")))


def written_by_year(spark, sf_dir):
    """``orders`` as a table partitioned by year, read back."""
    path = scratch_folder(spark, "by-year")
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    write_table(o.withColumn("year", F.year("o_orderdate")), path, ["year"])
    return read_dataset(spark, path)


@query("a4_json_arrays", f"""
SELECT event_id // {DOC_ROWS} AS doc_id, date_trunc('minute', ts) AS ts, value, 'forecast' AS source
FROM events""", doubles=["value"])
def q_json(spark, sf_dir):
    """A4: columnar JSON documents (parallel arrays, ``_previous_day1`` suffix) → rows.

    The documents are built from ``events`` in bounded chunks of 24 rows, then
    parsed back with ``from_json`` + ``inline(arrays_zip)``.
    """
    t = Tables(spark, sf_dir)
    ev = t("events", "event_id", "ts", "value")
    arr = F.array_sort(F.collect_list(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("t"),
                                               "value")))
    docs = (ev.groupBy((F.col("event_id") / DOC_ROWS).cast("bigint").alias("doc_id"))
            .agg(arr.alias("a"))
            .select("doc_id", F.to_json(F.struct(F.struct(
                F.transform("a", lambda x: x["t"]).alias("time"),
                F.transform("a", lambda x: x["value"]).alias("value_previous_day1")).alias("hourly"))).alias("doc")))
    return json_arrays_to_rows(docs, "doc", ["value"], source="forecast", keep=["doc_id"])


_ITEM = r'<li><a href="([^"]*)">([^<]*)</a></li>'


@query("a5_html_list_items", f"""
SELECT page_id, i - 1 AS pos, items[i] AS item FROM (
  SELECT page_id, items, unnest(generate_series(1, len(items))) AS i
  FROM (SELECT page_id, regexp_extract_all(html, '{_ITEM}', 2) AS items FROM pages))""", ints=["pos"])
def q_html(spark, sf_dir):
    """A5: repeating elements (list items) extracted from each page's HTML."""
    return extract_list_items(Tables(spark, sf_dir)("pages", "page_id", "html"), "html", keep=["page_id"])


@query("a6_locale_number", """
SELECT event_id, translate(format('{:,.2f}', value), ',.', '.,') AS text,
       TRY_CAST(replace(replace(translate(format('{:,.2f}', value), ',.', '.,'), '.', ''), ',', '.') AS DOUBLE)
         AS parsed
FROM events""", doubles=["parsed"])
def q_locale(spark, sf_dir):
    """Decimal-comma / thousands-dot text → DOUBLE."""
    ev = Tables(spark, sf_dir)("events", "event_id", "value")
    text = F.translate(F.format_number("value", 2), ",.", ".,")
    return ev.select("event_id", text.alias("text"), locale_double(text).alias("parsed"))


@query("a7_coerce_numeric", """
SELECT event_id, TRY_CAST(regexp_extract(props, '"k": ([^}]*)', 1) AS DOUBLE) AS k,
       TRY_CAST(event_type AS DOUBLE) AS bad
FROM events""", doubles=["k", "bad"])
def q_coerce(spark, sf_dir):
    """Numeric text → DOUBLE, unparseable text → NULL."""
    ev = Tables(spark, sf_dir)("events", "event_id", "props", "event_type")
    return ev.select("event_id", coerce_double(F.regexp_extract("props", r'"k": ([^}]*)', 1)).alias("k"),
                     coerce_double("event_type").alias("bad"))


@query("a8_product_code", """
WITH l AS (SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS loc FROM events),
c AS (SELECT event_id, 'QH-' || strftime(loc, '%y%m%d') || '-' ||
             lpad(CAST(hour(loc) * 4 + minute(loc) // 15 + 1 AS VARCHAR), 2, '0') AS code FROM l),
d AS (SELECT event_id, code, CAST(strptime(substr(code, 4, 6), '%y%m%d') AS DATE) AS delivery_date,
             CAST(substr(code, 11, 2) AS INTEGER) AS quarter FROM c)
SELECT event_id, code, delivery_date, quarter,
       ((CAST(delivery_date AS TIMESTAMP) + (quarter - 1) * INTERVAL 15 MINUTE) AT TIME ZONE 'Europe/Sofia')
         AT TIME ZONE 'UTC' AS ts
FROM d""", ints=["quarter"], dates=["delivery_date"])
def q_product(spark, sf_dir):
    """``QH-YYMMDD-NN`` quarter-hour product codes → delivery date, quarter, instant."""
    ev = Tables(spark, sf_dir)("events", "event_id", "ts")
    c = ev.select("event_id", encode_product_code(F.from_utc_timestamp("ts", "Europe/Sofia")).alias("code"))
    d = decode_product_code("code")
    return c.select("event_id", "code", d["delivery_date"].alias("delivery_date"), d["quarter"].alias("quarter"),
                    d["ts"].alias("ts"))


_EXPECTED = ["click", "error", "purchase", "refund", "signup", "view"]


@query("a10_dataset_manifest", f"""
WITH s AS (SELECT event_type AS dataset, count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts
           FROM events GROUP BY 1),
e AS (SELECT unnest({_EXPECTED!r}) AS dataset)
SELECT e.dataset, coalesce(s.rows, 0) AS rows, coalesce(s.rows, 0) > 0 AS ok, s.first_ts, s.last_ts,
       CASE WHEN s.rows > 0 THEN 'ts,event_id,value' END AS columns
FROM e LEFT JOIN s USING (dataset)""")
def q_manifest(spark, sf_dir):
    """A10: per-dataset rows / ok / first / last / columns; absent datasets show ok = false."""
    ev = Tables(spark, sf_dir)("events", "event_type", "ts", "event_id", "value").withColumnRenamed(
        "event_type", "dataset")
    return dataset_manifest(ev, _EXPECTED, columns=["ts", "event_id", "value"])


@query("a11_year_split", f"""
WITH i AS ({SQL_INTERVALS}), y AS (
  SELECT l_orderkey, l_linenumber, start, "end", unnest(generate_series(year(start), year("end"))) AS yr
  FROM i WHERE "end" > start)
SELECT l_orderkey, l_linenumber, greatest(start, make_timestamp(yr, 1, 1, 0, 0, 0)) AS chunk_start,
       least("end", make_timestamp(yr, 12, 31, 0, 0, 0)) AS chunk_end
FROM y""")
def q_year_split(spark, sf_dir):
    """Cut each interval of dates at calendar-year boundaries (closed pieces)."""
    i = order_intervals(Tables(spark, sf_dir)).filter(F.col("end") > F.col("start"))
    return i.select("l_orderkey", "l_linenumber",
                    F.inline(split_at_years(F.col("start"), F.col("end"), whole_days=True)))


@query("a11_rolling_years", """
WITH i AS (SELECT o_custkey, CAST(min(o_orderdate) AS TIMESTAMP) AS start, CAST(max(o_orderdate) AS TIMESTAMP) AS "end"
           FROM orders GROUP BY 1),
k AS (SELECT *, unnest(range(year("end") - year(start) + 1)) AS k FROM i),
c AS (SELECT o_custkey, "end", CASE WHEN k = 0 THEN start ELSE start + INTERVAL 1 YEAR + to_years(CAST(k - 1 AS INTEGER)) END
             AS chunk_start FROM k)
SELECT o_custkey, chunk_start, least(chunk_start + INTERVAL 1 YEAR, "end") AS chunk_end FROM c WHERE chunk_start < "end\"""")
def q_rolling_years(spark, sf_dir):
    """Cut each customer's time from first to last order into half-open pieces of at most a year."""
    o = Tables(spark, sf_dir)("orders", "o_custkey", "o_orderdate")
    ts = F.col("o_orderdate").cast("timestamp")
    i = o.groupBy("o_custkey").agg(F.min(ts).alias("start"), F.max(ts).alias("end"))
    return i.select("o_custkey", F.inline(split_rolling_years(F.col("start"), F.col("end"))))
