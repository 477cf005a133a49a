from __future__ import annotations

import csv
import random
import re
from contextlib import contextmanager
from decimal import Decimal

import pytest

from ordermill.plans.lake import Lake
from ordermill.schemas import RAW_COLUMNS
from ordermill.sources import csv_files, split_csv
from ordermill.sources.copying import copy_tables, load_report


def write_csv(path, header, rows, **kwargs):
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, **kwargs)
        writer.writerow(header)
        writer.writerows(rows)


REVIEW_HEADER = list(RAW_COLUMNS["reviews"])


def review(i, title="", message=""):
    return [f"r{i}", f"o{i}", i % 5 + 1, title, message, "2018-01-01 00:00:00", "2018-01-02 10:11:12"]


def test_load(spark, tmp_path):
    write_csv(
        tmp_path / "shop_customers_dataset.csv",
        list(RAW_COLUMNS["customers"]),
        [["c1", "u1", "01037", "sao paulo", "SP"], ["c2", "u2", "NA", "", "RJ"]],
    )
    header = list(RAW_COLUMNS["products"])
    header[2] = "product_name_length"
    write_csv(
        tmp_path / "shop_products_dataset.csv",
        header,
        [["p1", "toys", "40", "287.0", "1", "225", "16", "10", "14"], ["p2", "", "", "", "", "", "", "", ""]],
    )
    write_csv(
        tmp_path / "shop_order_reviews_dataset.csv",
        REVIEW_HEADER,
        [review(1, 'say "hi"', "two\nlines, one comma"), review(2, "null", "x")],
    )
    write_csv(
        tmp_path / "product_category_name_translation.csv",
        list(RAW_COLUMNS["category_translation"]),
        [["brinquedos", "toys"]],
    )
    lake = Lake(spark, str(tmp_path / "lake"))
    report = {r["table_name"]: (r["status"], r["n_rows"]) for r in csv_files.load_raw(spark, str(tmp_path), lake, "shop_").collect()}
    assert report["customers"] == ("loaded", 2)
    assert report["category_translation"] == ("loaded", 1)
    assert report["orders"] == ("skipped", None)
    assert len(report) == 8
    assert lake.raw("orders").count() == 0

    customers = lake.raw("customers").orderBy("customer_id").collect()
    assert customers[0]["customer_zip_code_prefix"] == "01037"
    assert customers[1]["customer_zip_code_prefix"] is None and customers[1]["customer_city"] is None
    assert customers[0]["ingested_at"] is not None
    products = lake.raw("products").orderBy("product_id").collect()
    assert products[0]["product_name_lenght"] == 40 and products[0]["product_description_lenght"] == 287
    assert products[0]["product_weight_g"] == Decimal("225.00") and products[1]["product_photos_qty"] is None
    reviews = lake.raw("reviews").orderBy("review_id").collect()
    assert reviews[0]["review_comment_title"] == 'say "hi"'
    assert reviews[0]["review_comment_message"] == "two\nlines, one comma"
    assert reviews[1]["review_comment_title"] is None

    # loading again replaces, it does not append
    csv_files.load_raw(spark, str(tmp_path), lake, "shop_").collect()
    assert lake.raw("customers").count() == 2


def test_bad_number_fails_the_load(spark, tmp_path):
    write_csv(tmp_path / "p.csv", list(RAW_COLUMNS["payments"]), [["o1", "1", "boleto", "1", "ten"]])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        csv_files.read_csv(spark, str(tmp_path / "p.csv"), "payments").collect()


def test_missing_column_is_named(spark, tmp_path):
    write_csv(tmp_path / "s.csv", ["seller_id"], [["s1"]])
    with pytest.raises(ValueError, match="seller_zip_code_prefix"):
        csv_files.read_csv(spark, str(tmp_path / "s.csv"), "sellers")


def test_nothing_to_load(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv_files.load_raw(spark, str(tmp_path), Lake(spark, str(tmp_path / "lake")))


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
@pytest.mark.parametrize("block", [97, 400, 100000])
def test_split_reader_equals_one_task(spark, tmp_path, line_end, block):
    rng = random.Random(block)
    pieces = ["a", "b c", "\n", "\r\n", '"', ",", "", "é", "\n\n", '""']
    rows = [
        review(i, "".join(rng.choices(pieces, k=2)), "".join(rng.choices(pieces, k=rng.randrange(9))))
        for i in range(120)
    ]
    folder = tmp_path / "reviews.csv"
    folder.mkdir()
    write_csv(folder / "a.csv", REVIEW_HEADER, rows[:70], lineterminator=line_end)
    write_csv(folder / "b.csv", REVIEW_HEADER, rows[70:], lineterminator=line_end)
    with _blocks_of(spark, str(block)):
        got = split_csv.read_split_csv(spark, str(folder), REVIEW_HEADER).collect()
    assert all(r[split_csv.EXTRA] is None for r in got)
    found = {r["review_id"]: [r[c] or "" for c in REVIEW_HEADER] for r in got}
    assert len(got) == len(rows)
    assert found == {r[0]: [str(v) for v in r] for r in rows}


@pytest.mark.parametrize("bits", [0, 2])
@pytest.mark.parametrize("block", ["700", "1g"])
def test_records_over_many_stretches(spark, tmp_path, monkeypatch, bits, block):
    monkeypatch.setattr(split_csv, "_STRETCH_BITS", bits)
    rows = [review(i, "a,\n\"b\"" if i % 2 else "t", "\n" * (i % 40) + "x") for i in range(80)]
    path = tmp_path / "r.csv"
    write_csv(path, REVIEW_HEADER, rows)
    with _blocks_of(spark, block):
        got = split_csv.read_split_csv(spark, str(path), REVIEW_HEADER).collect()
    assert sorted([r[c] for c in REVIEW_HEADER] for r in got) == sorted([str(v) for v in r] for r in rows)


def test_a_field_over_a_whole_block_fails_the_load(spark, tmp_path):
    write_csv(tmp_path / "r.csv", REVIEW_HEADER, [review(1, "t", "line\n" * 200), review(2)])
    with _blocks_of(spark, "100"), pytest.raises(Exception, match="spans a whole block"):
        split_csv.read_split_csv(spark, str(tmp_path / "r.csv"), REVIEW_HEADER).collect()


def test_a_block_is_dealt_over_many_tasks(spark, tmp_path):
    """All lines of a file block went to one task, which sorted them several times."""
    write_csv(tmp_path / "r.csv", REVIEW_HEADER, [review(i, "t", f"x\n{i}") for i in range(30_000)])
    with _blocks_of(spark, "1g"):
        rows = split_csv.read_split_csv(spark, str(tmp_path / "r.csv"), REVIEW_HEADER)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        sorted_by = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
        text_moves = [keys for keys in sorted_by if "block" in keys or "record" in keys]
        assert text_moves and all("stretch" in keys or "record" in keys for keys in text_moves)
        assert rows.count() == 30_000


BAD_RECORDS = {
    "short": ("r9,o9,5", ("o9", 5, None, None)),
    "stray quote": ('r9,o9,5,screen 5" big,one "word",2018-01-01 00:00:00,2018-01-02 00:00:00', ("o9", 5, 'screen 5" big', 'one "word"')),
    "empty extra": ("r9,o9,5,t,m,2018-01-01 00:00:00,2018-01-02 00:00:00,", ("o9", 5, "t", "m")),
    "text behind a quote": ('r9,o9,5,"",m,2018-01-01 00:00:00,2018-01-02 00:00:00', ("o9", 5, None, "m")),
}


@pytest.mark.parametrize("block", ["150", "1g"])
@pytest.mark.parametrize("case", list(BAD_RECORDS))
def test_odd_records_are_read_alike_at_any_size(spark, tmp_path, case, block):
    line, expect = BAD_RECORDS[case]
    path = tmp_path / "r.csv"
    write_csv(path, REVIEW_HEADER, [review(i, "a title", f"line one\nline {i}") for i in range(12)])
    with open(path, "a", encoding="utf-8") as f:
        f.write(line + "\n")
        csv.writer(f).writerows([review(100 + i, "t", "x\n,y") for i in range(12)])
    with _blocks_of(spark, block):
        rows = csv_files.read_csv(spark, str(path), "reviews").collect()
    assert len(rows) == 25
    odd = next(r for r in rows if r["review_id"] == "r9" and r["order_id"] == "o9" and r["review_comment_message"] != "line one\nline 9")
    assert (odd["order_id"], odd["review_score"], odd["review_comment_title"], odd["review_comment_message"]) == expect
    assert sum(r["review_comment_message"] == "x\n,y" for r in rows) == 12


@pytest.mark.parametrize("table,line", [("reviews", "r9,o9,5,t,m,,,more"), ("sellers", "s1,01037,rio,RJ,more"), ("sellers", 's1,01037,rio,RJ,"a,b",c')])
def test_a_record_with_too_many_fields_fails_the_load(spark, tmp_path, table, line):
    path = tmp_path / "r.csv"
    for block in ("150", "1g"):
        with open(path, "w", encoding="utf-8") as f:
            f.write(",".join(RAW_COLUMNS[table]) + "\n" + line + "\n")
        with _blocks_of(spark, block), pytest.raises(Exception, match="has more than"):
            csv_files.read_csv(spark, str(path), table).collect()


def test_short_and_quoted_records_of_plain_tables(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01037\ns2,02,"rio, centro",RJ\ns3,03,5" inch,SP,\n')
    rows = {r["seller_id"]: tuple(r)[1:] for r in csv_files.read_csv(spark, str(path), "sellers").collect()}
    assert rows == {"s1": ("01037", None, None), "s2": ("02", "rio, centro", "RJ"), "s3": ("03", '5" inch', "SP")}


@pytest.mark.parametrize("table", ["sellers", "reviews"])
def test_a_folder_with_other_headers_is_refused(spark, tmp_path, table):
    columns = list(RAW_COLUMNS[table])
    folder = tmp_path / "files"
    folder.mkdir()
    cells = {c: "1" for c in columns} | ({c: "2018-01-01 00:00:00" for c in columns if "date" in c or "timestamp" in c})
    write_csv(folder / "a.csv", columns, [[cells[c] for c in columns]])
    write_csv(folder / "b.csv", columns, [[cells[c] for c in columns]])
    assert csv_files.read_csv(spark, str(folder), table).count() == 2
    turned = columns[::-1]
    write_csv(folder / "c.csv", turned, [[cells[c] for c in turned]])
    with pytest.raises(Exception, match="(?i)header"):
        csv_files.read_csv(spark, str(folder), table).collect()


@pytest.mark.parametrize("block", ["400", "1g"])
@pytest.mark.parametrize("table", list(RAW_COLUMNS))
def test_every_table_may_have_line_breaks_in_quoted_fields(spark, tmp_path, table, block):
    columns = RAW_COLUMNS[table]
    text = [c for c, kind in columns.items() if kind.typeName() == "string"]

    def row(i):
        odd = f"x{i},\n\n\"y\"\r\nz" if i % 3 == 0 else f"x {i}"
        return [odd if c == text[-1] else f"k{i}" if c in text else "2018-01-01 00:00:00" if kind.typeName() == "timestamp_ntz" else str(i) for c, kind in columns.items()]

    folder = tmp_path / "two files[1].csv"
    folder.mkdir()
    write_csv(folder / "broken {a}.csv", list(columns), [row(i) for i in range(30)])
    write_csv(folder / "plain.csv", list(columns), [row(i) for i in range(31, 90) if i % 3])
    with _blocks_of(spark, block):
        path = str(folder).replace("[", "\\[").replace("]", "\\]")
        assert [f.rsplit("/", 1)[1] for f in csv_files.split_files(spark, path)] in (["broken%20%7Ba%7D.csv"], ["broken {a}.csv"])
        got = csv_files.read_csv(spark, path, table).collect()
    want = sorted([row(i) for i in range(30)] + [row(i) for i in range(31, 90) if i % 3])
    assert sorted([str(v) for v in (r[c] for c in text)] for r in got) == sorted([r[list(columns).index(c)] for c in text] for r in want)


def test_a_lone_carriage_return_inside_quotes_is_text(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_bytes(b'seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01,"rio\rsul",RJ\ns2,02,sao,SP\n')
    rows = {r["seller_id"]: tuple(r)[1:] for r in csv_files.read_csv(spark, str(path), "sellers").collect()}
    assert rows == {"s1": ("01", "rio\rsul", "RJ"), "s2": ("02", "sao", "SP")}


def test_files_without_such_lines_are_not_read_in_blocks(spark, tmp_path):
    write_csv(tmp_path / "s.csv", list(RAW_COLUMNS["sellers"]), [["s1", "01", 'a "quoted", city', "RJ"], ["s2", "02", 'x"y', "SP"]])
    assert csv_files.split_files(spark, str(tmp_path / "s.csv")) == []
    plan = csv_files.read_csv(spark, str(tmp_path / "s.csv"), "sellers")._jdf.queryExecution().toString()
    assert "Window" not in plan and "csv" in plan.lower()


def test_many_files_with_line_breaks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_files, "NAMED_FILES", 2)
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(5):
        write_csv(folder / f"{i}.csv", list(RAW_COLUMNS["sellers"]), [[f"s{i}", "01", "a\nb" if i else "c", "RJ"]])
    rows = {r["seller_id"]: r["seller_city"] for r in csv_files.read_csv(spark, str(folder), "sellers").collect()}
    assert rows == {"s0": "c", **{f"s{i}": "a\nb" for i in range(1, 5)}}


def test_only_the_tables_asked_for_are_loaded(spark, tmp_path):
    for name in ("sellers_dataset", "customers_dataset"):
        table = name.split("_")[0]
        write_csv(tmp_path / f"{name}.csv", list(RAW_COLUMNS[table]), [["1", "2", "3", "4", "5"][: len(RAW_COLUMNS[table])]])
    lake = Lake(spark, str(tmp_path / "lake"))
    report = csv_files.load_raw(spark, str(tmp_path), lake, tables=["sellers"]).collect()
    assert [tuple(r) for r in report] == [("sellers", "loaded", 1)]
    assert not lake.exists("raw", "customers")


@contextmanager
def _blocks_of(spark, size):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_copy(spark, tmp_path):
    source = {"a": spark.range(10).toDF("x"), "b": None}
    report = copy_tables(source, str(tmp_path)).collect()
    assert [(r["table_name"], r["status"], r["n_rows"]) for r in report] == [("a", "copied", 10), ("b", "skipped", None)]
    assert all(r["seconds"] >= 0 for r in report)
    copy_tables({"a": spark.range(3).toDF("x")}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 3


def test_load_report_counts(spark):
    rows = load_report({"a": spark.range(4), "b": None}).collect()
    assert [tuple(r) for r in rows] == [("a", "loaded", 4), ("b", "skipped", None)]
