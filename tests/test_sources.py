import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.sources import files, quoted
from tradewind.sources.schemas import RAW_COLUMNS, STAGING_TYPES


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_free_text_survives(spark, tmp_path):
    header = ",".join(RAW_COLUMNS["order_reviews"])
    path = write(
        tmp_path / "r.csv",
        f'{header}\n"r1","o1",5,,"two\nlines, and ""quotes""","2018-01-01 00:00:00","2018-01-02 00:00:00"\nr2,o2,1,NA,  kept ,,\n',
    )
    got = rows(files.read_entity(spark, path, "order_reviews"))
    assert got == [
        ("r1", "o1", "5", None, 'two\nlines, and "quotes"', "2018-01-01 00:00:00", "2018-01-02 00:00:00"),
        ("r2", "o2", "1", None, "  kept ", None, None),
    ]


def test_byte_order_mark_and_missing_final_newline(spark, tmp_path):
    path = write(tmp_path / "t.csv", "\ufeffproduct_category_name,product_category_name_english\na,A\nb,B")
    got = rows(files.read_entity(spark, path, "product_category_name_translation"))
    assert got == [("a", "A"), ("b", "B")]


def test_wrong_header_and_short_rows_fail(spark, tmp_path):
    wrong = write(tmp_path / "w.csv", "a,b\n1,2\n")
    short = write(tmp_path / "s.csv", "product_category_name,product_category_name_english\nonly one\n")
    for path in (wrong, short):
        with pytest.raises(Exception):
            files.read_entity(spark, path, "product_category_name_translation").collect()


def test_csv_round_trip(spark, frame, tmp_path):
    data = [("r1", 'say "hi", you\nthere'), ("r2", None), ("r3", "plain")]
    df = frame("id string, text string", data)
    files.write_csv(df, str(tmp_path / "out.csv"))
    back = files.read_csv(spark, str(tmp_path / "out.csv"), "id string, text string", multi_line=True)
    assert rows(back) == rows(df)


@pytest.fixture
def ranges_of(spark):
    """Sets the bytes of a range, so that a small file has many."""
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_to
    spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_across_ranges(spark, tmp_path, ranges_of, size, end):
    pick = random.Random(size)
    bits = ["a", "é", "\n", "\n\n", '""', ",", " ", '"",""', '\n"",', "x" * 90, ""]
    lines = ["id,text,more"]
    for i in range(40):
        field = "".join(pick.choice(bits) for _ in range(pick.randint(0, 6)))
        lines.append(f'{i},"{field}",{pick.choice(["z", "", "NA"])}' if i % 4 else f"{i},plain,")
        if i == 20:
            lines.append("")  # a blank line between records
    path = write(tmp_path / "q.csv", end.join(lines) + (end if size != 64 else ""))
    ddl = "id string, text string, more string"
    ranges_of(1 << 30)
    want = rows(files.read_csv(spark, path, ddl, multi_line=True))
    ranges_of(size)
    assert quoted._lines(spark, path).rdd.getNumPartitions() > (10 if size < 100 else 0)
    got = rows(quoted.read_quoted_csv(spark, path, ddl))
    assert got == want and len(got) == 40


def test_several_files_and_a_folder_of_quoted_text(spark, tmp_path, ranges_of):
    ranges_of(30)
    for name in ("a", "b"):
        write(tmp_path / f"{name}.csv", f'\ufeffid,text\n{name}1,"one\ntwo"\n{name}2,"x"\n')
    write(tmp_path / "c.csv", "id,text\n")
    got = rows(quoted.read_quoted_csv(spark, str(tmp_path), "id string, text string"))
    assert got == [("a1", "one\ntwo"), ("a2", "x"), ("b1", "one\ntwo"), ("b2", "x")]


@pytest.mark.parametrize("text", ['id,text\n1,"open\n2,x\n3,y\n', "id,other\n1,2\n", "id,text\n1\n", 'id,text\n1,"a\nb",c\n'])
def test_faulty_quoted_text_fails(spark, tmp_path, ranges_of, text):
    ranges_of(9)
    path = write(tmp_path / "f.csv", text)
    with pytest.raises(Exception, match="(?i)malformed|header|does not end"):
        quoted.read_quoted_csv(spark, path, "id string, text string").collect()


def test_a_review_file_is_read_by_many_tasks(spark, small, tmp_path, ranges_of):
    files.write_csv(small.raw("order_reviews").coalesce(1), str(tmp_path / "reviews"))
    ranges_of(4096)
    read = files.read_entity(spark, str(tmp_path / "reviews"), "order_reviews")
    assert quoted._lines(spark, str(tmp_path / "reviews")).rdd.getNumPartitions() > 20
    assert rows(read) == rows(small.raw("order_reviews"))


def test_catalog_lists_entities_in_name_order(spark, tmp_path):
    for e in ("sellers", "customers"):
        write(tmp_path / f"{e}.csv", ",".join(RAW_COLUMNS[e]) + "\n")
    names = {"sellers": "sellers.csv", "customers": "customers.csv"}
    catalog = files.scan_catalog(spark, str(tmp_path), names)
    assert list(catalog) == ["customers", "sellers"]
    assert catalog["sellers"].columns == RAW_COLUMNS["sellers"]
    listed = files.list_files(spark, str(tmp_path)).collect()
    assert [r.path.rsplit("/", 1)[1] for r in listed] == ["customers.csv", "sellers.csv"]


def test_typed_staging(frame):
    df = frame("order_id string, payment_sequential string, payment_type string, payment_installments string, payment_value string", [
        ("o1", "1", "voucher", "2", "10.555"),
        ("o2", "x", None, "1", None),
    ])
    types = STAGING_TYPES["order_payments"]
    typed = files.to_typed(df, types)
    assert dict(typed.dtypes) == types
    assert [str(r.payment_value) for r in typed.orderBy("order_id").collect()] == ["10.56", "None"]
    with pytest.raises(Exception, match="payment_sequential is not int: x"):
        files.to_typed(df, types, on_error="fail").collect()
    with pytest.raises(ValueError):
        files.to_typed(df, types, on_error="ignore")


def test_partitioned_write_replaces_and_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select("id", (F.col("id") % 3 + 201701).alias("m"))
    for n in (1000, 500):
        stored = files.write_table(df.filter(F.col("id") < n), path, "m", ["id"])
        assert stored.count() == n
    plan = stored.filter("m = 201702")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(m" in plan


def test_large_partition_gets_several_writers(spark, tmp_path):
    """A month that holds nearly everything must not be left to one task."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256KB")
    try:
        df = spark.range(0, 400000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("s"),
            F.when(F.col("id") % 50 == 0, 1).otherwise(2).alias("m"),
        )
        stored = files.write_table(df, str(tmp_path / "t"), "m")
        writers = stored.filter("m = 2").select("_metadata.file_path").distinct().count()
        assert writers > 4
        assert stored.count() == 400000
    finally:
        spark.conf.set(key, before)
