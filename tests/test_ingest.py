import os

import pytest

from tidewater.operators import provenance, routing
from tidewater.plans import bronze
from tidewater.sources import files

CFG = "file_pattern string, table_name string, sensitive_cols string, active_flag string"


def _route(spark, names, cfg_rows):
    fdf = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "path int, file_name string")
    out = routing.route_files(fdf, spark.createDataFrame(cfg_rows, CFG)).orderBy("path").collect()
    return [r["table_name"] for r in out]


def test_routing_edge_rows(spark):
    cfg = [("cust", "customers", "A,B", "Y"), ("cust_x", "customers_x", "", "Y"),
           ("pol", "policies", "", "N"), (None, "nothing", "", "Y")]
    names = ["zzz.csv", "cust_x_1.csv", "pol_1.csv", "CUST_1.csv", "a_cust.json"]
    assert _route(spark, names, cfg) == [None, "customers_x", None, None, "customers"]


def test_routing_empty_pattern_is_fallback(spark):
    cfg = [("", "catch_all", "", "Y"), ("cust", "customers", "", "Y")]
    assert _route(spark, ["x.csv", "cust.csv"], cfg) == ["catch_all", "customers"]


def test_json_single_object_nested(spark, tmp):
    p = f"{tmp}/one.json"
    with open(p, "w") as f:
        f.write('{\n "emp_id": 5,\n "name": "N",\n "department": {"dept_id": 10, "dept_name": "D"}\n}')
    r = files.read_json(spark, [p]).select("emp_id", "department.dept_id", "department.dept_name").first()
    assert tuple(r) == ("5", "10", "D")


def test_csv_is_text_by_name(spark, tmp):
    for name, head in (("a", "id,phone"), ("b", "phone,id")):
        os.makedirs(f"{tmp}/{name}.csv")
        with open(f"{tmp}/{name}.csv/part.csv", "w") as f:
            f.write(f"{head}\n020111,020222\n")
    assert files.csv_header(spark, f"{tmp}/b.csv") == ("phone", "id")
    assert files.read_csv(spark, [f"{tmp}/b.csv"]).first()["phone"] == "020111"
    with pytest.raises(Exception):     # a part with another header is no silent shift
        files.read_csv(spark, [f"{tmp}/b.csv"], ("id", "phone")).collect()


def test_typed_values(spark):
    from tidewater.functions.parse import typed
    rows = [("12345.0", "43831"), ("7", "2020-1-5"), ("1.5", "x"), ("X2", None), (None, "")]
    df = spark.createDataFrame(rows, "n string, d string")
    got = [tuple(map(str, r)) for r in df.select(typed("n", "bigint"), typed("d", "date")).collect()]
    assert got == [("12345", "2020-01-01"), ("7", "2020-01-05"), ("None", "None"), ("None", "None"), ("None", "None")]


def test_harmonize_types_rejects_and_keeps(spark):
    from tidewater.operators.quality import harmonize
    df = spark.createDataFrame([("7", "x@y", "z", "q")], "cust string, MAIL string, extra string, email string")
    out = harmonize(df, {"cust": "id", "mail": "Email"}, {"id": "bigint", "Email": "string", "when": "date"}, keep_unknown=True)
    assert out.dtypes[:3] == [("id", "bigint"), ("Email", "string"), ("when", "date")]
    r = out.first()
    assert (r["id"], r["Email"], r["when"], r["extra"]) == (7, "x@y", None, "z") and "email" in out.columns
    bad = harmonize(spark.createDataFrame([("seven",)], "id string"), {}, {"id": "bigint"}).first()
    assert bad["id"] is None and bad["_rejected"][0].asDict() == {"column": "id", "value": "seven"}


STAMPS = "_src_country string, SnapshotDate string, FileName string"


def test_append_evolve_and_idempotent(spark, tmp):
    path = f"{tmp}/bronze"
    a = spark.createDataFrame([(1, "x", "India", "2024-01-01", "f1")], "id int, a string, " + STAMPS)
    b = spark.createDataFrame([("y", 2, 9, "India", "2024-01-01", "f2")], "a string, id int, extra int, " + STAMPS)
    c = spark.createDataFrame([(3, "z", "Chile", "2024-01-01", "f1")], "id int, a string, " + STAMPS)
    for df in (a, b, c, b):
        provenance.append_partitioned(df, path)
    h = provenance.read_history(spark, path)
    rows = sorted((r["id"], r["a"], r["extra"], r["_src_country"]) for r in h.collect())
    assert rows == [(1, "x", None, "India"), (2, "y", 9, "India"), (3, "z", None, "Chile")]
    assert h.schema["SnapshotDate"].dataType.simpleString() == "string"


def _land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_each_delivery_keeps_its_own_sensitive_list(spark, tmp):
    land = f"{tmp}/landing/x/landing"         # a folder of the landing's name further up
    _land(land, "cust_a_2024-01-01.csv", "Email,CustomerID,FirstName\nme@x.com,1,Ann\n")
    _land(land, "cust_b_2024-01-01.csv", "FirstName,CustomerID,mail,Tier\nLee,bad,you@x.com,gold\n")
    _land(land, "cust_c_2024-01-01.pdf", "?")
    cfg = bronze.config_frame(spark, [("cust_a", "c", "Email", "Y"), ("cust_b", "c", "FirstName", "Y"), ("cust_c", "c", "", "Y")])
    report = bronze.ingest(spark, land, f"{tmp}/bronze", cfg, "0123456789abcdef", "uk",
                           schemas={"c": "CustomerID bigint, FirstName string, Email string"})
    assert {(r["delivery"][:6], r["status"]) for r in report.collect()} == {
        ("cust_a", "ingested"), ("cust_b", "ingested"), ("cust_c", "unknown format")}
    rows = {r["FileName"][:6]: r for r in provenance.read_history(spark, f"{tmp}/bronze/c").collect()}
    a, b = rows["cust_a"], rows["cust_b"]
    assert a["CustomerID"] == 1 and a["FirstName"] == "Ann" and a["Email"] != "me@x.com" and a["Tier"] is None
    assert b["CustomerID"] is None and b["FirstName"] != "Lee" and b["Email"] == "you@x.com" and b["Tier"] == "gold"
    assert a["_src_country"] == "UnitedKingdom"
    bad = provenance.read_history(spark, f"{tmp}/bronze/quarantine/c").collect()
    assert [(r["column"], r["value"]) for r in bad] == [("CustomerID", "bad")]


def test_undated_delivery_needs_a_run_date(spark, tmp):
    _land(f"{tmp}/landing", "insurance_customer.csv", "CustomerID\n1\n")
    args = (spark, f"{tmp}/landing", f"{tmp}/bronze", bronze.config_frame(spark), "0123456789abcdef", "india")
    with pytest.raises(Exception):
        bronze.ingest(*args)
    bronze.ingest(*args, run_date="2024-02-03")
    assert provenance.read_history(spark, f"{tmp}/bronze/insurance_customer").first()["SnapshotDate"] == "2024-02-03"


def test_ingest_unrouted_and_twice(spark, tmp):
    land = f"{tmp}/landing"
    os.makedirs(land)
    with open(f"{land}/insurance_customer_2024-05-01.csv", "w") as f:
        f.write("CustomerID,FirstName,Email\n1,Ann,a@b.c\n")
    with open(f"{land}/mystery_2024-05-01.csv", "w") as f:
        f.write("x\n1\n")
    cfg = bronze.config_frame(spark)
    schemas = {"insurance_customer": "CustomerID bigint, FirstName string, Email string"}
    for _ in range(2):
        report = bronze.ingest(spark, land, f"{tmp}/bronze", cfg, "0123456789abcdef", "india",
                               schemas=schemas)
    routed = {r["delivery"]: r["table_name"] for r in report.collect()}
    assert routed["mystery_2024-05-01.csv"] is None
    out = provenance.read_history(spark, f"{tmp}/bronze/insurance_customer").collect()
    assert len(out) == 1
    r = out[0]
    assert r["FirstName"] != "Ann" and r["_src_country"] == "India"
    assert r["FileName"] == "insurance_customer_2024-05-01.csv"
    assert str(r["SnapshotDate"]) == "2024-05-01"


def test_workbook_roundtrip(spark, tmp):
    import pandas as pd

    from tidewater.sources import workbooks

    pdf = pd.DataFrame({"id": [1, 2, 3], "name": ["a", "b & <c>", None], "when": ["2020-01-05", "43831", "x"]})
    with open(f"{tmp}/book.xlsx", "wb") as fh:
        fh.write(workbooks.workbook_bytes(pdf))
    df = workbooks.read_xlsx(spark, f"{tmp}/book.xlsx")
    rows = sorted((r["id"], r["name"], r["when"]) for r in df.collect())
    assert rows == [("1", "a", "2020-01-05"), ("2", "b & <c>", "43831"), ("3", None, "x")]
    land = f"{tmp}/insurance_2024-01-01.XLSX"
    workbooks.write_xlsx(df.drop("_source_path").repartition(2), land, rows_per_book=1)
    assert workbooks.read_xlsx(spark, land).select("id").distinct().count() == 3


def test_first_sheet_and_cells_without_references():
    import io
    import zipfile

    from tidewater.sources import workbooks

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet = '<worksheet {}><sheetData><row><c t="inlineStr"><is><t>{}</t></is></c><c><v>5</v></c></row></sheetData></worksheet>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="b" sheetId="2" r:id="rId9"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   f'<Relationship Id="rId9" Type="{rel}/worksheet" Target="worksheets/sheet10.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", sheet.format(ns, "wrong"))
        z.writestr("xl/worksheets/sheet10.xml", sheet.format(ns, "right"))
    assert list(workbooks.workbook_rows(buf.getvalue())) == [["right", "5"]]


def test_evolve_conflicting_type_fails_loudly(spark, tmp):
    """A column whose type changes between snapshots is not silently merged."""
    path = f"{tmp}/bronze"
    provenance.append_partitioned(
        spark.createDataFrame([(1, "India", "2024-01-01", "f")], "x int, " + STAMPS), path)
    provenance.append_partitioned(
        spark.createDataFrame([("a", "India", "2024-02-01", "f")], "x string, " + STAMPS), path)
    with pytest.raises(Exception):
        provenance.read_history(spark, path).collect()


def test_catalog_tables_follow_the_warehouse(spark):
    """Two data folders in one session: SQL binds to the caller's tables."""
    from tidewater.plans.catalog import QUERIES
    a = QUERIES["sql_kpi_claims_summary"](spark, "/root/testdata/sf0.001").first()["TotalClaims"]
    b = QUERIES["sql_kpi_claims_summary"](spark, "/root/testdata/sf0.01").first()["TotalClaims"]
    a2 = QUERIES["sql_kpi_claims_summary"](spark, "/root/testdata/sf0.001").first()["TotalClaims"]
    assert a == a2 and b == 20046 and a < b


def test_create_or_replace_table(spark, tmp):
    from tidewater.operators.catalog_tables import create_or_replace_table, ensure_database
    ensure_database(spark, "tw_test", f"{tmp}/tw_test.db")
    a = spark.createDataFrame([(1,), (2,)], "x int")
    create_or_replace_table(spark, a, "tw_test", "t", f"{tmp}/t")
    assert spark.sql("SELECT SUM(x) AS s FROM tw_test.t").first()["s"] == 3
    b = spark.createDataFrame([(10,)], "x int")
    create_or_replace_table(spark, b, "tw_test", "t", f"{tmp}/t")   # replace
    assert spark.sql("SELECT SUM(x) AS s FROM tw_test.t").first()["s"] == 10
    # a table replaced by what it holds itself
    more = spark.table("tw_test.t").selectExpr("x + 1 AS x")
    create_or_replace_table(spark, more, "tw_test", "t", f"{tmp}/t")
    assert spark.sql("SELECT SUM(x) AS s FROM tw_test.t").first()["s"] == 11
    create_or_replace_table(spark, b.selectExpr("'n' AS name"), "tw_test", "t", f"{tmp}/t")   # other columns
    assert spark.table("tw_test.t").first()["name"] == "n"
    with pytest.raises(ValueError):
        create_or_replace_table(spark, b, "tw_test", "t; DROP", f"{tmp}/t")


def test_ship_package_once(spark):
    import zipfile

    from tidewater import session
    names = zipfile.ZipFile(session.package_archive()).namelist()
    assert "tidewater/__init__.py" in names and "tidewater/operators/scd2.py" in names
    session.ship_package(spark)
    session.ship_package(spark)          # second call is a no-op, no duplicate registration
    assert id(spark.sparkContext) in session._SHIPPED


def test_silver_run_quarantines_and_takes_the_latest(spark, tmp):
    from tidewater.plans import layers
    land = f"{tmp}/landing"
    _land(land, "policy_claims_2024-01-01.csv", "ClaimID,CustomerID,SettledAmount_INR\n1,1,10\n2,1,5\n,1,7\n")
    _land(land, "policy_claims_2024-02-01.csv", "ClaimID,CustomerID,SettledAmount_INR\n1,1,20\nX,1,9\n")
    bronze.ingest(spark, land, f"{tmp}/bronze", bronze.config_frame(spark), "0123456789abcdef", "india")
    assert set(layers.run_silver(spark, f"{tmp}/bronze", f"{tmp}/silver", "0123456789abcdef")) == {"claims"}
    got = {r["ClaimID"]: float(r["SettledAmount_INR"]) for r in layers.read_silver(spark, f"{tmp}/silver", "claims").collect()}
    assert got == {1: 20.0, 2: 5.0}
    assert layers.read_silver(spark, f"{tmp}/silver", "quarantine/claims").count() == 2
    assert tuple(layers.audit_silver(spark, f"{tmp}/bronze", f"{tmp}/silver").first()) == ("claims", 5, 2, 2, 1)
    # a table that cannot be read is an error, not a table that never landed
    _land(f"{tmp}/bronze/policies_master", "part-0.parquet", "no parquet")
    with pytest.raises(Exception):
        layers.run_silver(spark, f"{tmp}/bronze", f"{tmp}/silver", "0123456789abcdef")


def test_phones_are_not_dates_or_addresses(spark):
    from tidewater.functions import text
    rows = {"2024-01-01": 0, "192.168.100.10": 0, "order 1234567890123": 0, "+91-(020) 12345": 1, "call 555-123-4567 now": 1,
            "(020) 7946 0958": 1, "0044 20 7946 0958": 1, "user.555-123-4567@x.com": 0, "2024-01-01 12:30:00.123": 0}
    df = spark.createDataFrame([(k, v) for k, v in rows.items()], "t string, n int")
    for r in df.select("t", "n", text.count_phones("t").alias("got"), text.mask_pii("t").alias("m")).collect():
        assert r["got"] == r["n"] and ("<PHONE>" in r["m"]) == (r["n"] > 0), r


def test_countries_by_lookup(spark):
    from tidewater.functions.text import country_name
    df = spark.createDataFrame([(c,) for c in ("unitedkingdom", "United Kingdom", "UK", "india", "BRAZIL")], "c string")
    assert [r[0] for r in df.select(country_name("c")).collect()] == [
        "UnitedKingdom", "UnitedKingdom", "UnitedKingdom", "India", "Brazil"]
