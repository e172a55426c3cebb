import pytest

from lakestar.operators.bronze import to_bronze
from lakestar.operators.classify import REASON, classify
from lakestar.sources.csv import assert_well_formed, read_raw_csv
from lakestar.sources.staging import export_star, read_bronze, read_export, write_bronze
from lakestar.schema import BRONZE_SCHEMA, FACT_SALES

HEADER = "Invoice No,Stock Code,Description,Quantity,Unit Price,Invoice Date,Customer ID,Country\n"


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_csv_header_normalised_and_order_kept(spark, tmp_path):
    body = "".join(f"INV{i},SKU-{i % 3},d,{i + 1},1.00,2025-01-0{1 + i % 5},C-{i},UK\n" for i in range(50))
    body += "INV1,SKU-1,d,2,1.00,2025-01-02,C-1,UK\n"  # duplicate of line 2
    path = _write(tmp_path, "orders.csv", HEADER + body)
    raw = read_raw_csv(spark, path)
    assert raw.columns[:8] == ["invoice_no", "stock_code", "description", "quantity", "unit_price",
                               "invoice_date", "customer_id", "country"]
    out = classify(to_bronze(raw)).orderBy("_ord").collect()
    assert len(out) == 51
    assert [r.invoice_no for r in out[:3]] == ["INV0", "INV1", "INV2"]
    assert out[-1][REASON] == "duplicate_invoice_line" and out[1][REASON] is None
    assert_well_formed(raw)


def test_csv_missing_column(spark, tmp_path):
    path = _write(tmp_path, "bad.csv", "invoice_no,stock_code\nA,B\n")
    with pytest.raises(ValueError, match="missing required columns"):
        read_raw_csv(spark, path)


def test_csv_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw_csv(spark, str(tmp_path / "nope.csv"))


def test_csv_surplus_fields_fail(spark, tmp_path):
    path = _write(tmp_path, "x.csv", HEADER + "A,B,C,1,1.0,2025-01-01,C-1,UK,EXTRA\n")
    with pytest.raises(ValueError, match="malformed"):
        assert_well_formed(read_raw_csv(spark, path))


def test_bronze_staging_roundtrip(spark, tmp_path):
    path = _write(tmp_path, "o.csv", HEADER + "INV1,SKU-1,d,3,2.50,2025-01-01,C-1,UK\n")
    bronze = to_bronze(read_raw_csv(spark, path))
    for fmt in ("parquet", "csv"):
        target = str(tmp_path / f"stage-{fmt}")
        write_bronze(bronze, target, fmt)
        back = read_bronze(spark, target, fmt, ord_schema=bronze.schema["_ord"].dataType)
        cols = [f.name for f in BRONZE_SCHEMA.fields]
        assert back.select(*cols).collect() == bronze.select(*cols).collect()


def test_export_parquet_and_csv(spark, tmp_path):
    from conftest import line, raw_rows
    from lakestar.operators.star import build_star
    star = build_star(to_bronze(raw_rows(spark, [line(), line(invoice="INV2")])))
    for fmt in ("parquet", "csv"):
        out = export_star(star.tables(), str(tmp_path / fmt), fmt)
        assert set(out) == {"dim_product", "dim_customer", "dim_date", "fact_sales"}
        back = read_export(spark, out["fact_sales"], FACT_SALES, fmt)
        assert sorted(back.collect()) == sorted(star.fact_sales.collect())


def test_csv_quotes_and_short_rows(spark, tmp_path):
    from lakestar.schema import RAW_COLUMNS
    from lakestar.sources.csv import assert_well_formed, read_raw_csv

    path = tmp_path / "odd.csv"
    path.write_text(",".join(RAW_COLUMNS) + "\n"
                    'I1,S1,"12"" mug, red",1,2.00,2025-01-01,C1,UK\n'
                    'I2,S2,"tray ""A""",1,2.00,2025-01-01,C1,UK\n'
                    'I3,S3,ends in \\,1,2.00,2025-01-01,C1,UK\n'
                    'I4,S4,short,1\n')
    raw = read_raw_csv(spark, str(path))
    assert_well_formed(raw)
    rows = {r[RAW_COLUMNS[0]]: r for r in raw.collect()}
    assert [rows[k][RAW_COLUMNS[2]] for k in ("I1", "I2", "I3", "I4")] == ['12" mug, red', 'tray "A"', "ends in \\", "short"]
    assert rows["I4"][RAW_COLUMNS[7]] is None and rows["I3"][RAW_COLUMNS[7]] == "UK"


def test_csv_files_match_columns_by_name(spark, tmp_path):
    rest = "description,quantity,unit_price,invoice_date,customer_id,country\n"
    (tmp_path / "a.csv").write_text("invoice_no,stock_code," + rest + "I1,S1,mug,1,2.00,2025-01-01,C1,UK\n")
    (tmp_path / "b.csv").write_text("Stock Code,Invoice No," + rest + "S2,I2,mug,1,2.00,2025-01-01,C1,UK\n")
    rows = read_raw_csv(spark, str(tmp_path)).orderBy("_ord").collect()
    assert [(r.invoice_no, r.stock_code) for r in rows] == [("I1", "S1"), ("I2", "S2")]


def test_csv_header_is_read_from_first_bytes(spark, tmp_path):
    import gzip

    names = ["Invoice No", "Stock Code", "Description", "Quantity", "Unit Price", "Invoice Date", "Customer ID", "Country"]
    body = "I{0},S{0},mug,1,2.00,2025-01-01,C1,UK\n"
    folder = tmp_path / "a b ü%20"
    folder.mkdir()
    (folder / "x 1.csv").write_text("\n \n" + ",".join(f'"{n}"' for n in names) + "\n" + body.format(1))
    (folder / "ü#2.csv").write_bytes(b"\xef\xbb\xbf" + ",".join(names).encode() + b"\r\n" + body.format(2).encode())
    wide = ["n" * 50_000, *names]  # longer than a block, another order of columns
    (folder / "p+q.csv").write_text(",".join(wide) + "\n" + "z," + body.format(3))
    with gzip.open(folder / "z.csv.gz", "wt") as f:
        f.write(",".join(names) + "\n" + body.format(4))
    (folder / "empty.csv").write_text("")
    rows = read_raw_csv(spark, str(folder)).collect()
    assert sorted((r.invoice_no, r.stock_code, r.country) for r in rows) == [(f"I{i}", f"S{i}", "UK") for i in range(1, 5)]
    assert len({r._ord for r in rows}) == 4


def test_csv_header_with_line_break(spark, tmp_path):
    names = "invoice_no,stock_code,description,quantity,unit_price,invoice_date,customer_id,country"
    path = _write(tmp_path, "n.csv", names + ',"a\nnote"\nI1,S1,mug,1,2.00,2025-01-01,C1,UK,x\n')
    with pytest.raises(ValueError, match="line break"):
        read_raw_csv(spark, path)
    assert [r.invoice_no for r in read_raw_csv(spark, path, multiline=True).collect()] == ["I1"]
    for text in ("", "\n\n", '"no end\n'):
        with pytest.raises(ValueError):
            read_raw_csv(spark, _write(tmp_path, "odd.csv", text))
