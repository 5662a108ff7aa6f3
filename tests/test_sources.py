"""Readers, name standardiser, raw preparation, ingestion contract."""

import json
import os

import pytest
from pyspark.sql import types as T

from salesmart.schemas import CUSTOMER_SOURCE, ORDER_SOURCE, PRODUCT_SOURCE
from salesmart.settings import Settings
from salesmart.sources.files import prepare, read_csv, read_json, snake_case, standardize
from salesmart.sources.xlsx import parse_address, plain_number, read_xlsx, workbook_bytes


def test_snake_case():
    assert snake_case("Customer ID") == "customer_id"
    assert snake_case("Price per product") == "price_per_product"
    assert snake_case("Sub-Category") == "sub_category"
    assert snake_case("  __Weird  Name!! ") == "weird_name"


def test_prepare_adds_metadata(spark):
    df = spark.createDataFrame([("C1", "Al")], ["Customer ID", "Customer Name"])
    out = prepare(df, "Customer.xlsx")
    assert out.columns == ["customer_id", "customer_name", "source_file_name", "ingestion_timestamp"]
    row = out.first()
    assert row["source_file_name"] == "Customer.xlsx" and row["ingestion_timestamp"] is not None


def test_duplicate_standardised_columns(spark):
    df = spark.createDataFrame([("a", "b")], ["Customer ID", "Customer-ID"])
    with pytest.raises(ValueError, match="Duplicate standardized columns"):
        standardize(df)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_csv_positional_binding_and_permissive(spark, tmp_dir):
    path = _write(f"{tmp_dir}/p.csv", "\n".join([
        "Whatever,Header,Names,Here,X,Y",
        "FUR-BO-10000001,Furniture,Chairs,Chair,Texas,10.5",
        "FUR-BO-10000002,Furniture",
        "FUR-BO-10000003,Furniture,Chairs,Chair,Texas,12,extra",
        "FUR-BO-10000004,Furniture,Chairs,Chair,Texas,abc",
        "",
        'FUR-BO-10000005,"",Chairs,Chair,Texas,1',
    ]))
    rows = read_csv(spark, path, PRODUCT_SOURCE).collect()
    assert len(rows) == 5
    assert rows[0]["Price per product"] == 10.5
    assert rows[1]["Sub-Category"] is None and rows[1]["Price per product"] is None
    assert rows[2]["Price per product"] == 12.0
    assert rows[3]["Price per product"] is None
    assert rows[4]["Category"] is None


def test_csv_escape_setting(spark, tmp_dir):
    path = _write(f"{tmp_dir}/q.csv", "a,b,c,d,e,f\n" 'X,Furniture,Binders,"Xerox 12"" binder, blue",Texas,3.5\n')
    default = read_csv(spark, path, PRODUCT_SOURCE).first()
    rfc = read_csv(spark, path, PRODUCT_SOURCE, escape='"').first()
    assert default["Price per product"] is None  # the doubled quote splits the field
    assert rfc["Product Name"] == 'Xerox 12" binder, blue' and rfc["Price per product"] == 3.5


def test_json_binding(spark, tmp_dir):
    rows = [
        {"Row ID": 1, "Order ID": "CA-1", "Quantity": 2, "Price": 1.5, "Customer ID": 123},
        {"row id": 2, "Order ID": "CA-2", "Quantity": 2.5, "Price": "x"},
    ]
    path = _write(f"{tmp_dir}/o.json", json.dumps(rows, indent=2))
    out = read_json(spark, path, ORDER_SOURCE).collect()
    assert out[0]["Row ID"] == 1 and out[0]["Customer ID"] == "123" and out[0]["Quantity"] == 2
    assert out[1]["Row ID"] is None and out[1]["Quantity"] is None and out[1]["Price"] is None


def test_json_broken_and_empty(spark, tmp_dir):
    broken = read_json(spark, _write(f"{tmp_dir}/b/o.json", '[{"Row ID": 1,'), ORDER_SOURCE).collect()
    assert len(broken) == 1 and all(v is None for v in broken[0])
    assert read_json(spark, _write(f"{tmp_dir}/e/o.json", "[]"), ORDER_SOURCE).isEmpty()


def test_xlsx_cells(spark, tmp_dir):
    header = [f.name for f in CUSTOMER_SOURCE.fields]
    rows = [
        ["AB-10001", "José Núñez", "a@b.com", 5551234, "1 Main", "Consumer", "United States", "Austin", "Texas", 1234, "Central"],
        ["AB-10002", "", None, None, None, None, None, None, None, None],  # blank + missing trailing cells
        [None] * 11,  # empty row is skipped
        ["AB-10003", "Bo", "c@d.com", "x", "y", "Corporate", "United States", "Dallas", "Texas", 1.5e3, "South"],
    ]
    os.makedirs(f"{tmp_dir}/wb", exist_ok=True)
    with open(f"{tmp_dir}/wb/a.xlsx", "wb") as fh:
        fh.write(workbook_bytes(header, rows))
    with open(f"{tmp_dir}/wb/b.xlsx", "wb") as fh:
        fh.write(workbook_bytes(header, rows[:1], inline_strings=True))
    out = read_xlsx(spark, f"{tmp_dir}/wb", CUSTOMER_SOURCE).collect()
    got = sorted(out, key=lambda r: (r["Customer ID"], r["Customer Name"] or ""))
    assert len(got) == 4
    assert got[0]["Postal Code"] == "1234" and got[0]["phone"] == "5551234" and got[0]["Customer Name"] == "José Núñez"
    assert got[1]["Postal Code"] == "1234"
    assert got[2]["Customer Name"] is None and got[2]["Region"] is None
    assert got[3]["Postal Code"] == "1500"


def test_xlsx_wrong_sheet_is_an_error(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/ws", exist_ok=True)
    with open(f"{tmp_dir}/ws/a.xlsx", "wb") as fh:
        fh.write(workbook_bytes(["a"], [["x"]], sheet="Other"))
    schema = T.StructType([T.StructField("a", T.StringType())])
    with pytest.raises(Exception, match="Unknown sheet"):
        read_xlsx(spark, f"{tmp_dir}/ws", schema).collect()
    assert read_xlsx(spark, f"{tmp_dir}/ws", schema, address="'Other'!A1").first()["a"] == "x"


def test_xlsx_address_and_numbers():
    assert parse_address("'Worksheet'!A1") == ("Worksheet", 0, 1)
    assert parse_address("'It''s'!$C$5") == ("It's", 2, 5)
    assert parse_address("B2") == (None, 1, 2)
    assert plain_number("1.1000000000000001") == "1.1" and plain_number("1234", 5) == "01234" and plain_number("-7", 3) == "-007"
    assert plain_number("1234.0") == "1234" and plain_number("1.5E3") == "1500" and plain_number("0.25") == "0.25"


def test_xlsx_keeps_every_row_that_has_cells(spark, tmp_dir):
    """Blank in the schema's columns with a note beside, full, three empty cells:
    as many rows as the same data gives as CSV."""

    os.makedirs(f"{tmp_dir}/blank", exist_ok=True)
    rows = [["", "", "note"], ["a", "b", ""], ["", "", ""]]
    with open(f"{tmp_dir}/blank/a.xlsx", "wb") as fh:
        fh.write(workbook_bytes(["x", "y", "z"], rows))
    _write(f"{tmp_dir}/blank_csv/a.csv", "x,y,z\n" + "".join(",".join(f'"{v}"' for v in r) + "\n" for r in rows))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "xy"])
    got = read_xlsx(spark, f"{tmp_dir}/blank", schema).collect()
    assert len(got) == 3 == spark.read.option("header", True).csv(f"{tmp_dir}/blank_csv").count()
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, [(None, None), ("a", "b"), (None, None)]))


def test_xlsx_address_offset(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/off", exist_ok=True)
    with open(f"{tmp_dir}/off/a.xlsx", "wb") as fh:
        fh.write(workbook_bytes(["junk", "junk"], [["x", "h"], ["y", "1"], ["z", "2"]]))
    schema = T.StructType([T.StructField("v", T.LongType())])
    assert [r[0] for r in read_xlsx(spark, f"{tmp_dir}/off", schema, address="'Worksheet'!B2").collect()] == [1, 2]


def test_ingest_order_and_empty_source(spark, tmp_dir):
    from salesmart.plans.pipeline import ingest
    from salesmart.sources.tables import create_zones

    s = Settings(landing=tmp_dir, prefix="ing_")
    create_zones(spark, s)
    header = [f.name for f in CUSTOMER_SOURCE.fields]
    os.makedirs(os.path.dirname(s.source_path("customers")), exist_ok=True)
    with open(s.source_path("customers"), "wb") as fh:
        fh.write(workbook_bytes(header, [["AB-10001"] + ["v"] * 10]))
    _write(s.source_path("products"), "h\nFUR-BO-10000001,Furniture,Chairs,Chair,Texas,1\n")
    _write(s.source_path("orders"), json.dumps([{"Row ID": 1}]))
    summary = ingest(spark, s)
    assert list(summary) == ["customers", "products", "orders"]
    assert all(v["status"] == "SUCCESS" and v["rows_written"] == 1 for v in summary.values())
    assert spark.table("ing_raw.orders").columns[-2:] == ["source_file_name", "ingestion_timestamp"]

    s2 = Settings(landing=f"{tmp_dir}/empty", prefix="ing_")
    os.makedirs(os.path.dirname(s2.source_path("customers")), exist_ok=True)
    with open(s2.source_path("customers"), "wb") as fh:
        fh.write(workbook_bytes(header, []))
    with pytest.raises(RuntimeError, match="customers file contains no rows"):
        ingest(spark, s2)


def _zip_workbook(path, sheet_xml, sst_xml, prefix=""):
    import zipfile

    p = f"{prefix}:" if prefix else ""
    ns = f'xmlns{":" + prefix if prefix else ""}="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/workbook.xml", f'<{p}workbook {ns} {rns}><{p}sheets><{p}sheet name="Worksheet" sheetId="1" r:id="rId7"/></{p}sheets></{p}workbook>')
        zf.writestr("xl/_rels/workbook.xml.rels",
                    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                    '<Relationship Id="rId7" Target="/xl/worksheets/data.xml" Type="x"/></Relationships>')
        zf.writestr("xl/worksheets/data.xml", f'<{p}worksheet {ns}><{p}dimension ref="A1:D3"/><{p}sheetData>{sheet_xml}</{p}sheetData></{p}worksheet>')
        zf.writestr("xl/sharedStrings.xml", f'<{p}sst {ns}>{sst_xml}</{p}sst>')


def test_xlsx_real_world_cell_shapes(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/rw", exist_ok=True)
    sst = ('<si><t>Name</t></si>'
           '<si><r><rPr><b/></rPr><t>Jo</t></r><r><t xml:space="preserve">sé </t></r><rPh sb="0" eb="1"><t>JO</t></rPh></si>'
           '<si><t>Flag</t></si><si><t>Val</t></si><si><t>Calc</t></si>')
    sheet = ('<row r="1" spans="1:4"><c r="A1" s="3" t="s"><v>0</v></c><c r="B1" t="s"><v>2</v></c>'
             '<c r="C1" t="s"><v>3</v></c><c r="D1" t="s"><v>4</v></c></row>'
             '<row r="2"><c r="A2" s="1" t="s"><v>1</v></c><c r="B2" t="b"><v>1</v></c>'
             '<c r="C2" t="e"><v>#N/A</v></c><c r="D2" t="str"><f>A2&amp;"!"</f><v>José !</v></c></row>'
             '<row r="4"><c r="A4"><v>1.2345E3</v></c><c r="D4" s="2"/></row>')
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "flag", "val", "calc")])
    for i, prefix in enumerate(("", "x")):
        _zip_workbook(f"{tmp_dir}/rw/w{i}.xlsx", sheet.replace("<", f"<{prefix}:").replace(f"<{prefix}:/", f"</{prefix}:") if prefix else sheet,
                      sst.replace("<", f"<{prefix}:").replace(f"<{prefix}:/", f"</{prefix}:") if prefix else sst, prefix)
        rows = read_xlsx(spark, f"{tmp_dir}/rw/w{i}.xlsx", schema).collect()
        assert [tuple(r) for r in rows] == [("José ", "TRUE", None, "José !"), ("1234.5", None, None, None)], prefix


def test_customers_land_at_a_path_only_hadoop_can_open(spark, tmp_dir):
    from salesmart.sources import bridge
    from salesmart.sources.files import read_source
    from salesmart.sources.landing import land_benchmark

    sf = "/root/testdata/sf0.001"
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.landing.link./in", f"file://{tmp_dir}")
    settings = land_benchmark(spark, sf, "viewfs://landing/in/customers", datasets=("customers",))
    got, want = read_source(spark, "customers", settings), bridge.SOURCES["customers"](spark, sf)
    assert got.count() == want.count() > 0
    assert sorted(r.customer_id for r in got.collect()) == sorted(r.customer_id for r in want.collect())


def test_customers_land_in_workbooks_of_bounded_rows(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F

    from salesmart.schemas import CUSTOMER_SOURCE
    from salesmart.sources import landing
    from salesmart.sources.files import read_source, snake_case

    monkeypatch.setattr(landing, "WORKBOOK_ROWS", 50)
    names = [snake_case(f.name) for f in CUSTOMER_SOURCE.fields]
    raw = spark.range(0, 420, 1, 1).select(*[F.when(F.col("id") % 7 != i, F.concat(F.lit(f"{n} "), (F.col("id") % 400).cast("string"))).alias(n) for i, n in enumerate(names)])
    settings = landing.land(spark, {"customers": raw}, tmp_dir, ("customers",))
    files = spark.read.format("binaryFile").load(settings.source_path("customers"))
    assert files.count() == 9  # one partition, but no workbook holds all rows
    per_file = [len(read_xlsx(spark, r.path, CUSTOMER_SOURCE).collect()) for r in files.select("path").collect()]
    assert sum(per_file) == 420 and max(per_file) <= 60
    got = read_source(spark, "customers", settings).select(*names)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, raw.collect()), key=str)


def test_orders_land_in_arrays_of_bounded_rows(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F

    from salesmart.sources import landing
    from salesmart.sources.files import read_source, snake_case

    monkeypatch.setattr(landing, "ARRAY_ROWS", 50)
    raw = spark.range(0, 400, 1, 4).where("id < 100 or id > 217").select(*[
        F.when(F.col("id") % 13 != i, F.col("id") if i else F.col("id") % 390).cast(f.dataType).alias(snake_case(f.name))
        for i, f in enumerate(ORDER_SOURCE.fields)
    ])
    settings = landing.land(spark, {"orders": raw}, tmp_dir, ("orders",))
    path = settings.source_path("orders")
    # partitions of 100, 0, 82 and 100 rows
    per_file = [read_json(spark, r.path, ORDER_SOURCE).count() for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert sorted(n for n in per_file if n) == [32, 50, 50, 50, 50, 50]
    got = read_source(spark, "orders", settings).select(*raw.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, raw.collect()), key=str)
