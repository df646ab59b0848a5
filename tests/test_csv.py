"""The CSV feed: binding by name, rescue, lineage, strict dates."""

import glob
import gzip
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from basketry import contracts as C
from basketry.functions import dates, measures as M, text
from basketry.operators import quality as Q
from basketry.plans import bronze, silver
from basketry.sources import sales_csv, tables
from basketry.streaming import ingest

HEADERS = [header for header, _, _ in C.RAW_FIELDS]
SAMPLE = {
    "Customer ID": "00123", "Customer Name": " Ann ", "Last Name": "Lee",
    "Date of Birth": "1990-02-28", "Sales": "10.5", "Year": "2020", "Outlet Type": "Large",
    "City Type": "Tier 1", "Category of Goods": "Furniture", "Region": "East", "Country": "India",
    "Segment": "Consumer", "Sales Date": "2020-01-01", "Order ID": "O-1",
    "Order Date": "2020-01-01", "Ship Date": "2020-01-03", "Ship Mode": "Same Day", "State": "Goa",
    "Postal Code": "403001", "Product ID": "P-1", "Sub-Category": "Chairs",
    "Product Name": "Chair, red", "Quantity": "2", "Discount": "0.1", "Profit": "1.5",
}


def write(folder, name, rows, headers=HEADERS):
    os.makedirs(folder, exist_ok=True)
    quote = lambda v: f'"{v}"' if "," in v else v
    lines = [",".join(headers)]
    lines += [",".join(quote(row.get(h, "")) for h in headers) for row in rows]
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    return path


def test_columns_bind_by_name_in_any_order(spark, folder):
    paths = [write(folder, "a.csv", [SAMPLE]),
             write(folder, "b c.csv", [{**SAMPLE, "Order ID": "O-2"}], HEADERS[::-1])]
    got = sales_csv.read_files(spark, paths).orderBy("order_id").collect()
    assert [r.order_id for r in got] == ["O-1", "O-2"]
    for row in got:
        assert (row.customer_id, row.sales, row.quantity, row.postal_code, row.product_name) == (
            "00123", 10.5, 2, 403001, "Chair, red")
        assert row[C.RESCUED] is None
        assert row[C.SOURCE_FILE].endswith(".csv") and row[C.FILE_MODIFIED] is not None


def test_rescue_keeps_what_does_not_fit(spark, folder):
    bad = {**SAMPLE, "Quantity": "two", "Sales": "12", "Colour": "red"}
    path = write(folder, "a.csv", [bad, {**SAMPLE, "Order ID": "O-2"}], ["Colour", *HEADERS])
    got = {r.order_id: r for r in sales_csv.read_files(spark, [path]).collect()}
    assert got["O-1"].quantity is None and got["O-1"].sales == 12.0
    assert json.loads(got["O-1"][C.RESCUED]) == {"Quantity": "two", "Colour": "red"}
    assert got["O-2"][C.RESCUED] is None


def test_missing_column_and_broken_line(spark, folder):
    path = write(folder, "a.csv", [SAMPLE], [h for h in HEADERS if h != "Profit"])
    row = sales_csv.read_files(spark, [path]).first()
    assert row.profit is None and row[C.RESCUED] is None
    with open(path, "a") as out:
        out.write("x,y\n")
    rows = sales_csv.read_files(spark, [path]).collect()
    rescued = [json.loads(r[C.RESCUED]) for r in rows if r[C.RESCUED]]
    assert rescued == [{"_broken_line": "x,y"}]


def test_empty_files_give_no_rows(spark, folder):
    path = write(folder, "a.csv", [], [])
    frame = sales_csv.read_files(spark, [path])
    assert frame.count() == 0
    assert frame.columns == sales_csv.feed_with_lineage_schema().names


def test_each_file_once_across_restarts(spark, folder):
    landing, root = f"{folder}/landing", f"{folder}/tables"
    checkpoint = f"{landing}/_checkpoints/ingest"
    at = F.lit("2026-01-15 06:00:00").cast("timestamp")
    stored = lambda: spark.read.parquet(f"{root}/{C.BRONZE_SALES}")
    write(landing, "a.csv", [SAMPLE, {**SAMPLE, "Order ID": ""}])
    write(f"{landing}/_checkpoints", "hidden.csv", [SAMPLE])
    ingest.ingest(spark, landing, root, checkpoint, ingested_at=at)
    assert stored().count() == 1
    ingest.ingest(spark, landing, root, checkpoint, ingested_at=at)
    assert stored().count() == 1
    write(landing, "b.csv", [{**SAMPLE, "Order ID": "O-2"}], HEADERS[::-1])
    ingest.ingest(spark, landing, root, checkpoint, ingested_at=at)
    assert sorted(r.order_id for r in stored().collect()) == ["O-1", "O-2"]
    partitions = {(r[C.INGEST_YEAR], r[C.INGEST_MONTH]) for r in stored().collect()}
    assert partitions == {(2026, 1)}
    bad = spark.read.parquet(f"{root}/{C.BRONZE_QUARANTINE}").collect()
    assert [(r.order_id, r._failure_reason) for r in bad] == [(None, "order_id IS NULL")]


def test_max_files_per_trigger(spark, folder):
    landing = f"{folder}/landing"
    for i in range(3):
        write(landing, f"{i}.csv", [{**SAMPLE, "Order ID": f"O-{i}"}])
    query = ingest.ingest(spark, landing, f"{folder}/t", f"{folder}/_c", max_files=1)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert spark.read.parquet(f"{folder}/t/{C.BRONZE_SALES}").count() == 3


@pytest.mark.parametrize("value, day", [
    ("2020-01-05", "2020-01-05"), ("2020-02-29", "2020-02-29"), ("2021-02-29", None),
    ("2020-1-5", None), ("2020-01-05 ", None), ("05.01.2020", None), ("bad-date", None),
    ("2020-13-01", None), ("", None), (None, None), ("2020-01-05T00:00", None),
])
def test_strict_days(spark, value, day):
    row = spark.createDataFrame([(value,)], "v string").select(dates.parsed_day("v")).first()
    assert (str(row[0]) if row[0] else None) == day


def test_scalar_edges(spark):
    rows = spark.createDataFrame([(" a ", None, 0.0, 5.0), ("\tb", "c", 2.0, None)],
                                 "x string, y string, s double, p double")
    got = rows.select(
        text.trimmed("x"), text.joined("x", "y").alias("j"), text.filled("x").alias("f"),
        M.guarded_ratio("p", "s").alias("r"), M.growth_percent("p", "s").alias("g"),
    ).collect()
    assert [tuple(r) for r in got] == [("a", "a", True, None, None),
                                       ("\tb", "\tb c", True, None, None)]
    rounded = spark.range(1).select(
        F.round(F.lit(1.005), 2), F.round(F.lit(-2.5), 0), dates.days_between(
            F.lit("2020-03-01").cast("date"), F.lit("2020-02-28").cast("date"))).first()
    assert tuple(rounded) == (1.01, -3.0, -2)


def test_rename_covers_the_feed(spark):
    frame = spark.createDataFrame([], C.raw_schema())
    assert bronze.renamed(frame).columns == C.FEED_COLUMNS
    assert [f.dataType for f in C.raw_schema()] == [f.dataType for f in C.feed_schema()]


def test_column_contracts(spark):
    base = spark.createDataFrame([], ingest.bronze_schema())
    assert silver.customer_rows(base).columns == [
        "customer_id", "first_name", "last_name", "full_name", "dob", "segment", "city_type",
        "region", "outlet_type", "state", "country", "_ingestion_ts", "_source_file"]
    assert silver.product_rows(base).columns == [
        "product_id", "product_name", "sub_category", "category_of_goods", "_ingestion_ts",
        "_source_file"]
    orders = silver.with_order_period(silver.order_rows(base))
    assert len(orders.columns) == 29
    assert dict(orders.dtypes)["order_year"] == "string"
    assert len(silver.quarantine(base, complete=False).columns) == 12


def test_files_of_any_name_are_loaded(spark, folder):
    landing = f"{folder}/landing"
    for number, name in enumerate(("1.csv", "2.CSV", "4.txt", "5")):
        write(landing, name, [{**SAMPLE, "Order ID": f"O-{number}"}])
    with open(f"{landing}/1.csv", "rb") as plain, gzip.open(f"{landing}/3.csv.gz", "wb") as packed:
        packed.write(plain.read().replace(b"O-0", b"O-9"))
    ingest.load(spark, landing, f"{folder}/table", f"{folder}/check")
    stored = tables.batches(spark, f"{folder}/table", sales_csv.feed_with_lineage_schema())
    assert sorted(r.order_id for r in stored.collect()) == ["O-0", "O-1", "O-2", "O-3", "O-9"]


def test_headers_of_many_files_take_one_job(spark, folder):
    def jobs(paths):
        context, group = spark.sparkContext, f"headers-{len(paths)}"
        context.setJobGroup(group, group)
        try:
            groups = sales_csv.by_header(spark, paths)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        return groups, len(context.statusTracker().getJobIdsForGroup(group))

    paths = []
    for n in range(40):
        headers = HEADERS[::-1] if n % 3 else HEADERS
        paths.append(write(folder, f"{n} ä%25.csv", [SAMPLE] * n, headers))
    for path in paths[:9]:
        with open(path, "rb") as plain, gzip.open(f"{path}.gz", "wb") as packed:
            packed.write(b"\n \n" + plain.read())
        paths.append(f"{path}.gz")
    few, once = jobs(paths[:3])
    many, again = jobs(paths)
    assert once == 1 and again <= 2  # Spark lists more than 32 paths in a job of its own
    assert {h: len(p) for h, p in many.items()} == {tuple(HEADERS): 17, tuple(HEADERS[::-1]): 32}
    assert sorted(p for ps in many.values() for p in ps) == sorted(paths) and len(few) == 2


def test_only_the_first_line_of_a_large_file_is_read(spark, folder):
    path = write(folder, "large.csv", [SAMPLE])
    with open(path, "ab") as out:
        out.write(b"\xff\xfe" * 30_000_000 + b"\n")  # several splits, which would be read in full otherwise
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    assert sales_csv.first_lines(session, [path]) == {path: ",".join(HEADERS)}


def test_headers_and_rescue_take_neither_python_nor_lambdas(spark, folder, monkeypatch):
    def refused(*_):
        raise AssertionError("a Python function receives every line of the files, however early it stops")

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", refused)
    path = write(folder, "a.csv", [{**SAMPLE, "Quantity": "two", "Profit": ""}, SAMPLE])
    assert sales_csv.first_lines(spark, [path]) == {path: ",".join(HEADERS)}
    frame = sales_csv.read_files(spark, [path])
    assert "lambda" not in frame._jdf.queryExecution().toString()
    assert sorted(str(r[C.RESCUED]) for r in frame.collect()) == ["None", '{"Quantity":"two"}']


def test_a_split_batch_is_stored_not_cached(spark, folder, monkeypatch):
    def refused(*_):
        raise AssertionError("a batch must not be held by the executors")

    monkeypatch.setattr(type(spark.range(1)), "persist", refused)
    landing, root = f"{folder}/landing", f"{folder}/tables"
    write(landing, "a.csv", [SAMPLE, {**SAMPLE, "Order ID": ""}, {**SAMPLE, "Quantity": "11"}])
    for _ in range(2):
        ingest.ingest(spark, landing, root, f"{folder}/check")
    good = tables.batches(spark, f"{root}/{C.BRONZE_SALES}", ingest.bronze_schema())
    bad = tables.batches(spark, f"{root}/{C.BRONZE_QUARANTINE}", ingest.quarantine_schema())
    assert [r.order_id for r in good.collect()] == ["O-1"]
    assert sorted((r.order_id or "", r._failure_reason) for r in bad.collect()) == [
        ("", "order_id IS NULL"), ("O-1", "quantity out of range [1, 10]")]
    assert good.select(C.INGESTED_AT).union(bad.select(C.INGESTED_AT)).distinct().count() == 1
    assert spark.read.parquet(f"{root}/{C.BRONZE_QUARANTINE}/_batch").count() == 0


@pytest.mark.parametrize("line, options", [
    ("a,b,c", {}), ('"a,b",c', {}), ("a;b", {"sep": ";"}), ("a,,A,b", {}), ("x\ty", {"delimiter": "\t"}),
    ("'a,b',c", {"quote": "'"}), (" a, b ", {}), ("a,a,a", {}), ("one", {})])
def test_header_lines_are_read_as_spark_does(spark, folder, line, options):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/h.csv", "w") as out:
        out.write(f"{line}\n")
    assert list(sales_csv.header_of(line, **options)) == spark.read.options(header=True, **options).csv(f"{folder}/h.csv").columns


def test_varied_columns_are_stored_without_a_dictionary(spark, folder):
    landing, root = f"{folder}/landing", f"{folder}/tables"
    write(landing, "a.csv", [SAMPLE, {**SAMPLE, "Order ID": ""}] * 50)
    ingest.ingest(spark, landing, root, f"{folder}/check")
    ingest.load(spark, landing, f"{root}/loaded", f"{folder}/check-load")
    for table in (C.BRONZE_SALES, C.BRONZE_QUARANTINE, "loaded"):
        files = glob.glob(f"{root}/{table}/batch=0/**/*.parquet", recursive=True)
        group = next(g for g in (pq.ParquetFile(f).metadata.row_group(0) for f in files) if g.num_rows)
        chunks = [group.column(i) for i in range(group.num_columns)]
        coded = {c.path_in_schema for c in chunks if c.has_dictionary_page}
        assert "product_id" not in coded and C.SOURCE_FILE not in coded and "region" in coded


def test_rows_of_the_feed_are_stored_with_zstandard(spark, folder):
    landing, root = f"{folder}/landing", f"{folder}/tables"
    write(landing, "a.csv", [SAMPLE, {**SAMPLE, "Order ID": ""}] * 50)
    ingest.ingest(spark, landing, root, f"{folder}/check")
    ingest.load(spark, landing, f"{root}/loaded", f"{folder}/check-load")
    for table in (C.BRONZE_SALES, C.BRONZE_QUARANTINE, "loaded"):
        files = glob.glob(f"{root}/{table}/batch=0/**/*.parquet", recursive=True)
        groups = [m.row_group(i) for m in (pq.ParquetFile(f).metadata for f in files) for i in range(m.num_row_groups)]
        assert {g.column(0).compression for g in groups} == {"ZSTD"}


def test_rules_are_told_without_lambdas(spark):
    rows = spark.createDataFrame(
        [("O-1", 1.0, 5), (None, 1.0, 5), (None, None, None), ("O-2", 0.0, 11)],
        "order_id string, sales double, quantity int")
    tagged = bronze.tagged(rows)
    assert "lambda" not in tagged._jdf.queryExecution().toString()
    assert [r._violations for r in tagged.collect()] == [
        [], ["order_id_not_null"], ["order_id_not_null", "sales_positive", "quantity_valid"],
        ["sales_positive", "quantity_valid"]]
    assert [r.v for r in rows.select(Q.violated([]).alias("v")).collect()] == [[]] * 4
