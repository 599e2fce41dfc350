"""CSV loaders: header rules of the training file and the dashboard upload."""

import tempfile

from storecast.sources import csv_io as C


def _write(text):
    d = tempfile.mkdtemp(prefix="storecast-csv-")
    with open(f"{d}/part.csv", "w") as f:
        f.write(text)
    return d


def test_upload_aliases_and_coercion(spark):
    # "Pred" is renamed, but "Country" is not: "pais" already exists
    d = _write(" Transaction Date ;Partner Name;Country;pais;Pred;Local Amount\n"
               "2024-01-02;A;X;Y;10;12.5\n"
               "not a date;A;X;Y;1;1\n"
               "2024-01-03;A;X;Y;x;7\n")
    df = C.load_pred_vs_real(spark, d, ";")
    assert set(df.columns) == {"fecha", "partner", "country", "pais", "ventas_predichas", "ventas_reales"}
    rows = sorted(df.collect(), key=lambda r: r["fecha"])
    assert len(rows) == 2                                  # the bad date row is dropped
    assert rows[0]["ventas_predichas"] == 10.0 and rows[0]["pais"] == "Y"
    assert rows[1]["ventas_predichas"] is None             # "x" -> null


def test_sales_loader_renames_present_headers(spark):
    d = _write("Partner Code,Store Code,Process Date,Billings,Extra\nP1,7,2024-01-02,5.5,z\nP1,7,2024-01-03,oops,z\n")
    df = C.load_sales(spark, d)
    assert {"partner_code", "store_code", "date", "billings", "Extra", "store_id"} <= set(df.columns)
    got = sorted(((r["store_id"], r["billings"]) for r in df.collect()), key=lambda t: (t[1] is not None, t))
    assert got == [("P1_7", None), ("P1_7", 5.5)]


def test_csv_dir_union_by_name(spark):
    d = tempfile.mkdtemp(prefix="storecast-csvdir-")
    with open(f"{d}/a.csv", "w") as f:
        f.write("Transaction Date,Country,Local Amount\n2024-01-01,X,1\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write("Transaction Date,Local Amount,City\n2024-01-02,2,Z\n")
    df = C.load_csv_dir(spark, d)
    rows = {r["Transaction Date"]: r.asDict() for r in df.collect()}
    assert rows["2024-01-01"]["City"] is None and rows["2024-01-02"]["Country"] is None
    assert rows["2024-01-02"]["City"] == "Z"


def test_csv_dir_layouts_are_found_by_tasks(spark):
    import os
    d = tempfile.mkdtemp(prefix="storecast-csvdir-")
    os.mkdir(f"{d}/deeper")
    with open(f"{d}/deeper/c.csv", "w") as f:                      # not of this folder
        f.write("Transaction Date,Country,Local Amount\n2024-01-09,X,100\n")
    for k in range(40):
        with open(f"{d}/a {k}%.csv", "w") as f:                    # names that URIs escape
            f.write(f"Transaction Date,Local Amount\n2024-01-01,{k}\n2024-01-02,{k}\n")
    with open(f"{d}/bom.csv", "wb") as f:
        f.write(b"\xef\xbb\xbfTransaction Date,Local Amount\n2024-01-03,7\n")
    with open(f"{d}/broken.csv", "w") as f:                        # a line break inside a quoted header
        f.write('"Transaction\nDate",Local Amount\n2024-01-04,8\n')
    for name, text in (("empty", ""), ("header", "Transaction Date,City\n"), ("notes.txt", "x\ny\n")):
        with open(f"{d}/{name}" + ("" if "." in name else ".csv"), "w") as f:
            f.write(text)
    layouts = C.csv_layouts(spark, d)
    assert [len(files) for _, files in layouts] == [1, 1, 41]
    df = C.load_csv_dir(spark, d)
    assert set(df.columns) == {"Transaction Date", "Transaction\nDate", "Local Amount", "City"}
    rows = df.collect()
    assert len(rows) == 82 and sum(int(r["Local Amount"]) for r in rows) == 2 * sum(range(40)) + 15
    assert [r["Local Amount"] for r in rows if r["Transaction\nDate"]] == ["8"]
    assert C.load_csv_dir(spark, f"{d}/deeper").count() == 1
    os.mkdir(f"{d}/none")
    assert C.load_csv_dir(spark, f"{d}/none").count() == 0
