"""CSV readers, the parallel multiline reader and the writers."""

import csv
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyshore.schemas import COMPLAINT_COLUMNS
from tallyshore.sources import multiline, readers, writers

HEADER = list(COMPLAINT_COLUMNS)


def complaint(number, narrative, received="2023-07-11T15:12:42.000Z", product="Mortgage", state="CA"):
    row = dict.fromkeys(HEADER, "")
    row |= {"Date received": received, "Product": product, "State": state,
            "Consumer complaint narrative": narrative, "Complaint ID": str(number)}
    return [row[h] for h in HEADER]


def write_csv(path, rows, header=HEADER, newline="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=newline)
        out.writerow(header)
        out.writerows(rows)
    return str(path)


def test_events_ids_and_timestamps(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(
        "id,user_id,sequence_number,session_id,created_at,ip_address,city,state,postal_code,"
        "browser,traffic_source,uri,event_type\n"
        "1,15495.0,3,s1,2023-07-11 15:12:42,1.1.1.1,A,B,1,C,D,/x,cart\n"
        "2,,1,s2,2023-07-11 15:12:42 UTC,1.1.1.1,A,B,1,C,D,/x,home\n")
    rows = readers.read_shop_csv(spark, "events", str(path)).orderBy("id").collect()
    assert [r.user_id for r in rows] == [15495, None]
    assert dict(readers.read_shop_csv(spark, "events", str(path)).dtypes)["user_id"] == "bigint"


def test_bad_value_fails_the_load_check(spark, tmp_path):
    path = tmp_path / "distribution_centers.csv"
    path.write_text("id,name,latitude,longitude\n1,A,1.0,2.0\n2,B,north,2.0\n")
    df = readers.read_shop_csv(spark, "distribution_centers", str(path))
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|parse"):
        readers.load_check(df).collect()


def test_renamed_header_fails(spark, tmp_path):
    path = tmp_path / "distribution_centers.csv"
    path.write_text("id,title,latitude,longitude\n1,A,1.0,2.0\n")
    with pytest.raises(Exception):
        readers.load_check(readers.read_shop_csv(spark, "distribution_centers", str(path))).collect()


def test_missing_key_is_found_and_fingerprint_ignores_order(spark, tmp_path):
    path = tmp_path / "distribution_centers.csv"
    path.write_text("id,name,latitude,longitude\n1,A,1.0,2.0\n,B,3.0,2.0\n")
    df = readers.read_shop_csv(spark, "distribution_centers", str(path))
    assert readers.missing_keys(df, "id").count() == 1
    assert (readers.load_check(df).collect()
            == readers.load_check(df.orderBy(F.desc("name"))).collect())


ROWS = [
    complaint(1, 'He said ""no"" twice,\nthen "left"\n\nfor good', "2023-07-11T15:12:42.000Z"),
    complaint(2, "plain", "2023-07-11"),
    complaint(3, "", "07/11/2023"),
    complaint(4, "a,b,c", ""),
]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_complaints_reader(spark, tmp_path, newline):
    path = write_csv(tmp_path / "c.csv", ROWS, newline=newline)
    rows = {r.complaint_id: r for r in readers.read_complaints_csv(spark, path).collect()}
    assert rows[1].narrative == ROWS[0][5]
    assert rows[1].date_received == dt.date(2023, 7, 11) == rows[2].date_received
    assert rows[3].narrative is None and rows[3].date_received is None
    assert rows[4].narrative == "a,b,c" and rows[4].date_received is None
    assert list(rows[1].asDict()) == list(COMPLAINT_COLUMNS.values())


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_split_reader_equals_one_task_reader(spark, tmp_path, newline):
    """Many small splits, so that records and quoted newlines cross their borders."""
    rng = random.Random(5)
    words = ["pay", '"', "\n", ",", "XXXX", "é", '""', "loan\n\n", "'"]
    rows = [complaint(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))))
            for i in range(400)]
    path = write_csv(tmp_path / "c.csv", rows, newline=newline)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        lines = multiline.stage_lines(spark, path, str(tmp_path / "lines1"))
        assert lines.select("block").distinct().count() > 10
        split = multiline.read_complaints_split(spark, path, str(tmp_path / "lines2"))
        ours = {r.complaint_id: r for r in split.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    theirs = {r.complaint_id: r for r in readers.read_complaints_csv(spark, path).collect()}
    assert len(ours) == 400 and ours == theirs


def test_split_reader_keeps_records_with_bare_quotes(spark, tmp_path):
    """Unquoted fields with odd and even numbers of quotes, beside quoted ones over several lines."""
    rng, lines = random.Random(8), []
    for i in range(200):
        text = rng.choice(['a 5" pipe', 'a 5" by 6" pipe', 'plain', '"said ""no"",\n\nthen left"', '"x\ny ""z"""', ''])
        fields = complaint(i, "")
        fields = [str(f) for f in fields]
        fields[5] = text
        lines.append(",".join(fields))
    path = tmp_path / "bare"
    path.mkdir()
    for part in range(2):
        (path / f"{part}.csv").write_text("\n".join([",".join(HEADER), *lines[part::2]]) + "\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        split = multiline.read_complaints_split(spark, str(path), str(tmp_path / "l"))
        ours = {r.complaint_id: r for r in split.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    theirs = {r.complaint_id: r for r in readers.read_complaints_csv(spark, str(path)).collect()}
    assert len(ours) == 200 and ours == theirs


def test_split_reader_rejects_open_quotes_and_wrong_headers(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(",".join(HEADER) + "\n" + ",".join(["x"] * 5 + ['"pipe'] + ["x"] * 10) + "\n")
    with pytest.raises(ValueError, match="quotes"):
        multiline.read_complaints_split(spark, str(path), str(tmp_path / "l"))
    both = tmp_path / "both"
    both.mkdir()
    write_csv(both / "a.csv", ROWS)
    write_csv(both / "b.csv", ROWS, header=[HEADER[1], HEADER[0], *HEADER[2:]])
    with pytest.raises(ValueError, match="header"):
        multiline.read_complaints_split(spark, str(both), str(tmp_path / "l2"))


def test_every_header_is_judged_however_it_is_spelled(spark, tmp_path):
    """Many valid spellings don't hide a wrong one, wherever it stands in the order of files and headers."""
    folder = tmp_path / "many"
    folder.mkdir()
    plain, quoted = ",".join(HEADER), ",".join(f'"{h}"' for h in HEADER)
    valid = [plain, plain + "\r", "\ufeff" + plain, "\ufeff" + quoted + "\r", quoted, quoted.replace('"', "", 2)]
    record = ",".join(str(f) for f in complaint(1, "text"))
    for i, header in enumerate(valid):
        (folder / f"a{i}.csv").write_text(f"{header}\n{record}\n", encoding="utf-8", newline="")
    lines = multiline.stage_lines(spark, str(folder), str(tmp_path / "l1"))
    assert multiline.wrong_headers(lines, HEADER).collect() == []
    assert multiline.read_complaints_split(spark, str(folder), str(tmp_path / "l2")).count() == len(valid)
    wrong = {"b_swapped": ",".join([HEADER[1], HEADER[0], *HEADER[2:]]), "b_short": ",".join(HEADER[:-1]),
             "a0_long": plain + ",more", "z_trailing": plain + ",", "0_empty": ""}
    for name, header in wrong.items():
        (folder / f"{name}.csv").write_text(f"{header}\n{record}\n")
    lines = multiline.stage_lines(spark, str(folder), str(tmp_path / "l3"))
    found = {r.file.rsplit("/", 1)[1].removesuffix(".csv") for r in multiline.wrong_headers(lines, HEADER).collect()}
    assert found == set(wrong)
    with pytest.raises(ValueError, match="0_empty"):
        multiline.read_complaints_split(spark, str(folder), str(tmp_path / "l4"))


def test_unparsable_rows_are_kept_and_quarantined(spark, tmp_path):
    rows = [complaint("oops", "text"), complaint(5, "fine")]
    path = write_csv(tmp_path / "c.csv", rows)
    one = readers.read_complaints_csv(spark, path, keep_corrupt=True).cache()
    assert one.count() == 2 and readers.quarantine(one).count() == 1
    split = multiline.read_complaints_split(spark, path, str(tmp_path / "l"), keep_corrupt=True)
    assert readers.quarantine(split).count() == 1


def test_parquet_once_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "bronze")
    assert writers.parquet_once(spark, path, build).count() == 3
    assert writers.parquet_once(spark, path, build).count() == 3
    assert len(calls) == 1


def test_tables_and_json(spark, tmp_path):
    tables = writers.write_tables({"a": spark.range(2), "b": spark.range(3)}, str(tmp_path))
    assert [t.count() for t in tables.values()] == [2, 3]
    writers.register(writers.read_tables(spark, str(tmp_path), ["a", "b"]))
    assert spark.sql("select count(*) from b").first()[0] == 3
    writers.write_json(spark.range(2), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 2
