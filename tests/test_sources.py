import contextlib
import csv
import gzip
import random
import re
import xml.etree.ElementTree as ElementTree

import pytest
from pyspark.sql import Observation

from firmloom.operators.ordinals import Blocks, dense_ordinal
from firmloom.sources import csv_records, splits, tables, xml_records as xml


@contextlib.contextmanager
def split_size(spark, size):
    """Files are cut into splits of about `size` bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


ENTITIES = """<?xml version="1.0"?>
<lei:LEIData xmlns:lei="x"><lei:LEIHeader><lei:ContentDate> 2026-01-01 </lei:ContentDate>
<lei:Nested><lei:ContentDate>no</lei:ContentDate></lei:Nested></lei:LEIHeader><lei:LEIRecords>
<lei:LEIRecord><lei:LEI>A1</lei:LEI><lei:Entity><lei:LegalName xml:lang="en">
 Foo &amp; B&#228;r
 Inc.</lei:LegalName><lei:LegalName>second</lei:LegalName>
 <lei:LegalAddress><lei:Country>DE</lei:Country></lei:LegalAddress>
 <lei:HeadquartersAddress><lei:Country>US</lei:Country></lei:HeadquartersAddress>
 <lei:RegistrationAuthority><lei:RegistrationAuthorityID>R1</lei:RegistrationAuthorityID></lei:RegistrationAuthority>
 <lei:EntityStatus>ACTIVE</lei:EntityStatus></lei:Entity></lei:LEIRecord>
<lei:LEIRecord id="7" kind="x">
 <lei:LEI>A2</lei:LEI><lei:Entity><lei:LegalName> </lei:LegalName>
 <lei:LegalAddress><lei:Country>FR</lei:Country></lei:LegalAddress></lei:Entity></lei:LEIRecord>
<lei:LEIRecord><lei:LEI>BAD</lei:LEI><lei:Entity></lei:LEIRecord>
<lei:LEIRecord><lei:LEI>A3</lei:LEI></lei:LEIRecord>
</lei:LEIRecords></lei:LEIData>"""


def test_entities(spark, tmp_path):
    (tmp_path / "a.xml").write_text(ENTITIES)
    rows = xml.read_entities_xml(spark, str(tmp_path / "a.xml")).orderBy("row_id").collect()
    assert [(r.row_id, r.lei) for r in rows] == [(1, "A1"), (2, "A2"), (4, "A3")]
    first, second, last = rows
    assert first.legal_name == "Foo & Bär\n Inc." and first.legal_name_clean == "foo and bar"
    assert (first.country, first.legal_address_country, first.registration_authority) == ("US", "DE", "R1")
    assert (second.legal_name, second.country, second.headquarters_country) == (None, "FR", None)
    assert (last.legal_name, last.legal_name_clean, last.country) == (None, "", None)
    assert {(r.source_file, r.source_snapshot_date) for r in rows} == {("a.xml", "2026-01-01")}
    assert xml.snapshot_date(spark, str(tmp_path / "a.xml")).first().source_snapshot_date == "2026-01-01"
    assert tuple(xml.parse_counters(spark, str(tmp_path / "a.xml")).first()) == (4, 3, 1)


def test_truncated_and_bad_records(spark, tmp_path):
    (tmp_path / "t.xml").write_text("<D><LEIHeader/><LEIRecord><LEI>A</LEI></LEIRecord><LEIRecord><LEI>B</LEI>")
    path = str(tmp_path / "t.xml")
    assert [r.lei for r in xml.read_entities_xml(spark, path).collect()] == ["A"]
    assert tuple(xml.parse_counters(spark, path).first()) == (2, 1, 1)
    with pytest.raises(ValueError, match="1 LEIRecord"):
        xml.read_entities_xml(spark, path, on_bad="fail")
    (tmp_path / "b.xml").write_text(ENTITIES)
    with pytest.raises(Exception, match="unreadable record"):
        xml.read_entities_xml(spark, str(tmp_path / "b.xml"), on_bad="fail").collect()
    assert [(r.row_id, "BAD" in r.record) for r in xml.bad_records(spark, str(tmp_path / "b.xml")).collect()] == [(3, True)]


def test_record_text_is_not_shuffled(spark, tmp_path):
    (tmp_path / "e.xml").write_text(ENTITIES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = xml.read_entities_xml(spark, str(tmp_path / "e.xml"))
        text = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"BroadcastHashJoin \[_file#\d+, _start", text)
    assert not re.search(r"SortMergeJoin \[_file#\d+, _start", text)


def test_csv_keeps_text(spark, tmp_path):
    odd = ["  two  ", "a\nb", 'q"q', "back\\slash\\", '"', "", "tab\t", "a,b\n\n c "]
    tables.write_table(spark.createDataFrame([(x,) for x in odd], "t string"), str(tmp_path / "c"), "csv")
    back = tables.read_register(spark, str(tmp_path / "c"), ["t"], "csv", multi_line=True)
    assert sorted(r.t for r in back.collect()) == sorted(odd)


def test_ordinals_over_many_splits_and_files(spark, tmp_path):
    for number in range(3):
        records = "".join(
            f"<LEIRecord><LEI>{number:02d}-{i:04d}</LEI></LEIRecord>\n" for i in range(400)
        )
        text = f"<D><LEIHeader><ContentDate>d{number}</ContentDate></LEIHeader>{records}</D>"
        if number == 1:
            (tmp_path / f"{number}.xml.gz").write_bytes(gzip.compress(text.encode()))
        else:
            (tmp_path / f"{number}.xml").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        rows = xml.read_entities_xml(spark, str(tmp_path)).orderBy("row_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.row_id for r in rows] == list(range(1, 1201))
    assert [r.lei for r in rows] == sorted(r.lei for r in rows)
    assert {(r.lei[:2], r.source_snapshot_date) for r in rows} == {("00", "d0"), ("01", "d1"), ("02", "d2")}


def test_relationships_take_the_first_period(spark, tmp_path):
    period = "<rr:RelationshipPeriod><rr:StartDate>{}</rr:StartDate><rr:PeriodType>{}</rr:PeriodType></rr:RelationshipPeriod>"
    text = (
        "<rr:X xmlns:rr='r'><rr:Header><rr:ContentDate>d</rr:ContentDate></rr:Header>"
        "<rr:RelationshipRecord><rr:Relationship><rr:StartNode><rr:NodeID>C</rr:NodeID></rr:StartNode>"
        "<rr:EndNode><rr:NodeID>P</rr:NodeID></rr:EndNode><rr:RelationshipType>T</rr:RelationshipType>"
        "<rr:RelationshipPeriods>" + period.format("2001-01-01", "ONE") + period.format("2002-01-01", "TWO") +
        "</rr:RelationshipPeriods></rr:Relationship></rr:RelationshipRecord>"
        "<rr:RelationshipRecord><rr:Relationship/></rr:RelationshipRecord></rr:X>"
    )
    (tmp_path / "r.xml").write_text(text)
    one, two = xml.read_relationships_xml(spark, str(tmp_path / "r.xml")).orderBy("row_id").collect()
    assert (one.parent_lei, one.child_lei, one.start_date, one.period_type) == ("P", "C", "2001-01-01", "ONE")
    assert (two.parent_lei, two.start_date, two.source_snapshot_date) == (None, None, "d")


def test_exceptions(spark, tmp_path):
    (tmp_path / "e.xml").write_text(
        "<E><Header><ContentDate>d</ContentDate></Header><Exception><LEI>L</LEI><ExceptionCategory>C"
        "</ExceptionCategory><ExceptionReason>R</ExceptionReason></Exception></E>"
    )
    row = xml.read_exceptions_xml(spark, str(tmp_path / "e.xml")).first()
    assert (row.row_id, row.lei, row.exception_category, row.next_version) == (1, "L", "C", None)
    assert xml.read_exceptions_xml(spark, None) is None


def test_member_list_keeps_order_and_blanks_tokens(spark, tmp_path):
    (tmp_path / "l.csv").write_text('Company Name,Country\n"A, ""x"" Ltd",NA\n b ,null\n"",DE\n')
    rows = tables.read_member_list(spark, str(tmp_path / "l.csv")).orderBy("ordinal").collect()
    assert [tuple(r) for r in rows] == [(1, 'A, "x" Ltd', ""), (2, "b", ""), (3, "", "DE")]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_register_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([("L1", None, 'a "b", c'), ("NA", "US", "x")], "lei string, country string, name string")
    tables.write_table(df, str(tmp_path / "t"), fmt)
    back = tables.read_register(spark, str(tmp_path / "t"), ["lei", "country", "name"], fmt)
    assert sorted(map(tuple, back.collect())) == [("L1", "", 'a "b", c'), ("NA", "US", "x")]


def test_empty_table_keeps_its_columns(spark, tmp_path):
    tables.write_table(spark.createDataFrame([], "a string, b string"), str(tmp_path / "t"), "csv")
    assert spark.read.csv(str(tmp_path / "t"), header=True).columns == ["a", "b"]


@pytest.mark.parametrize("rows, depth", [(1000, 1), (200, 2), (45, 3)])
def test_ordinal_blocks_hold_few_rows(spark, rows, depth):
    """However many rows there are: more levels of blocks, not larger ones."""
    df = spark.range(5000).selectExpr("cast(id % 2 as int) g", "if(id < 4000, id, id * 1000000007) as o")
    blocks = Blocks(df, "g", "o", rows, 4)
    assert len(blocks.levels) == depth
    counts = blocks.counts().collect()
    assert max(r._n for r in counts) <= rows and sum(r._n for r in counts) == 5000
    numbered = dense_ordinal(df, "g", "o", "n", rows=rows, ways=4)
    assert [r.n for r in numbered.orderBy("g", "o").collect()] == list(range(1, 5001))
    assert dense_ordinal(df.limit(0), "g", "o", "n").collect() == []


def test_dense_ordinal_is_contiguous(spark):
    df = spark.range(3000).selectExpr("cast(id % 3 as int) g", "id * id as o")
    rows = dense_ordinal(df, "g", "o", "n", rows=200, ways=20).orderBy("g", "o").collect()
    assert [r.n for r in rows] == list(range(1, 3001))


def parsed(path):
    """LEI and name of every record, by a plain parser."""
    def text(e):
        return (e.text or "").strip() or None if e is not None else None

    out = []
    for _, e in ElementTree.iterparse(path):
        if e.tag.split("}")[-1] == "LEIRecord":
            out.append((text(e.find("{x}LEI")), text(e.find("{x}Entity/{x}LegalName"))))
    return out


def odd_xml(rng, records):
    """A well-formed file full of things that look like record tags and are none."""
    def noise():
        return rng.choice([
            "", "", "\n", "<!-- <l:LEIRecord><l:LEI>NO</l:LEI></l:LEIRecord> -->", "<?p </l:LEIRecord> ?>", "<!-- LEIRecord> -->",
            "<!-- ]]> <![CDATA[ -->",
        ])

    def inner():
        return rng.choice(["", "<![CDATA[ </l:LEIRecord> ]]>", "<![CDATA[<!--]]>", "<!-- </l:LEIRecord> -->", "<l:LEIRecordX/>", "&lt;/l:LEIRecord&gt;"])

    out = ["<?xml version='1.0'?><l:D xmlns:l='x'><!-- <l:LEIHeader><l:ContentDate>no</l:ContentDate></l:LEIHeader> -->"
           "<l:LEIHeader><l:ContentDate>2026-02-03</l:ContentDate></l:LEIHeader>"]
    for i in range(records):
        opened = rng.choice(["<l:LEIRecord>", "<l:LEIRecord>", "<l:LEIRecord a='>'>", '<l:LEIRecord\n b="x>y" >'])
        closed = rng.choice(["</l:LEIRecord>", "</l:LEIRecord>", "</l:LEIRecord >", "</l:LEIRecord\n>"])
        if i % 37 == 5:
            out.append("<l:LEIRecord/>")
        else:
            out.append(f"{opened}{noise()}<l:LEI>L{i}</l:LEI><l:Entity>{noise()}<l:LegalName>N{i} {inner().replace('<l:LEIRecordX/>', '')}</l:LegalName>{inner()}</l:Entity>{closed}")
        out.append(noise())
    return "".join(out) + "</l:D>\n"


@pytest.mark.parametrize("size", [10_000_000, 9000, 1700])
def test_xml_agrees_with_a_parser(spark, tmp_path, size):
    rng = random.Random(size)
    for k in range(3):
        (tmp_path / f"{k}.xml").write_text(odd_xml(rng, 150))
    want = [r for k in range(3) for r in parsed(str(tmp_path / f"{k}.xml"))]
    with split_size(spark, size):
        if size < 10_000:
            assert splits.text_pieces(spark, str(tmp_path), "LEIRecord>").rdd.getNumPartitions() > 6
        counters = Observation()
        rows = xml.read_entities_xml(spark, str(tmp_path), counters=counters).collect()
        assert counters.get == {"rows_seen": 450, "rows_written": 450, "skipped_rows": 0}
    rows.sort(key=lambda r: r.row_id)
    assert [r.row_id for r in rows] == list(range(1, 451))
    assert [(r.lei, r.legal_name) for r in rows] == want
    assert {r.source_snapshot_date for r in rows} == {"2026-02-03"} and {r.source_file for r in rows} == {"0.xml", "1.xml", "2.xml"}


def test_commented_records_are_not_records(spark, tmp_path):
    (tmp_path / "c.xml").write_text(
        "<x:D xmlns:x='x'><x:LEIRecord><x:LEI>1</x:LEI><x:Entity><x:LegalName><![CDATA[a </x:LEIRecord> b]]></x:LegalName></x:Entity></x:LEIRecord>"
        "<!-- <x:LEIRecord><x:LEI>9</x:LEI></x:LEIRecord> --><x:LEIRecord><x:LEI>2</x:LEI></x:LEIRecord></x:D>"
    )
    rows = xml.read_entities_xml(spark, str(tmp_path / "c.xml")).orderBy("row_id").collect()
    assert [(r.row_id, r.lei, r.legal_name) for r in rows] == [(1, "1", "a </x:LEIRecord> b"), (2, "2", None)]
    assert tuple(xml.parse_counters(spark, str(tmp_path / "c.xml")).first()) == (2, 2, 0)
    (tmp_path / "w.xml").write_text("<D>" + "".join(f"<LEIRecord><LEI>{i}</LEI></LEIRecord{' ' * (i == 2)}>" for i in (1, 2, 3)) + "</D>")
    assert [r.lei for r in xml.read_entities_xml(spark, str(tmp_path / "w.xml")).orderBy("row_id").collect()] == ["1", "2", "3"]


def test_unclosed_records_count_by_file(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<D><LEIRecord><LEI>1</LEI></LEIRecord></LEIRecord></D>")  # one closing too many
    (tmp_path / "b.xml").write_text("<D><LEIRecord><LEI>2</LEI><LEIRecord><LEI>3</LEI></LEIRecord><LEIRecord><LEI>4")
    assert xml.count_unclosed(spark, str(tmp_path)) == 2
    assert tuple(xml.parse_counters(spark, str(tmp_path)).first()) == (4, 2, 2)
    assert [(r.row_id, r.record) for r in xml.bad_records(spark, str(tmp_path)).collect()] == [(None, "<LEI>2</LEI>"), (None, "<LEI>4")]


def test_one_reading_pass_gives_rows_and_counters(spark, tmp_path):
    """Rows, numbers, dates and counters take two looks at the text: one sums up splits, one reads."""
    (tmp_path / "a.xml").write_text(ENTITIES)
    counters = Observation()
    rows = xml.read_entities_xml(spark, str(tmp_path / "a.xml"), counters=counters)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CollectMetrics") == 1
    assert rows.count() == 3 and counters.get == {"rows_seen": 4, "rows_written": 3, "skipped_rows": 1}


CELLS = ["a", "two words", 'q"q', '"', "line\nbreak", "\n", 'a,b\n\n"c"\n', "", "back\\", '5" pipe', "x\ry", "\u00e9\n\u00fc", "  pad  "]


@pytest.mark.parametrize("size", [10_000_000, 5000, 1200])
def test_split_csv_equals_the_whole_reader(spark, tmp_path, size):
    rng = random.Random(size)
    rows = [(str(i), *[rng.choice(CELLS) for _ in range(2)]) for i in range(1500)]
    for name, part in (("x", rows), ("y", rows[:40])):
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            writer = csv.writer(f, lineterminator="\n")
            writer.writerow(["id", "First Col", "b`c"])
            writer.writerows(part)
            if name == "x":
                f.write('7000,5" stray,and "more" here\n\n7001,"q"tail,x\n7002,"open at end\nof file')
    want = spark.read.csv(str(tmp_path), header=True, escape='"', multiLine=True)
    with split_size(spark, size):
        if size < 10_000:
            assert splits.text_pieces(spark, str(tmp_path / "x.csv"), "\n").rdd.getNumPartitions() > 5
        found = csv_records.read_csv(spark, str(tmp_path), "n").collect()
    assert found[0].__fields__ == ["n", "id", "First Col", "b`c"]
    assert sorted((tuple(r)[1:] for r in found), key=str) == sorted(map(tuple, want.collect()), key=str)
    found.sort(key=lambda r: r.n)
    assert [r.n for r in found] == list(range(1, len(found) + 1))
    assert [r.id for r in found] == [r[0] for r in rows] + ["7000", "7001", "7002"] + [r[0] for r in rows[:40]]


def test_a_cell_longer_than_a_split_is_an_error(spark, tmp_path):
    (tmp_path / "l.csv").write_text('id,t\n1,"' + "\n".join(f"line {i}" for i in range(2000)) + '"\n2,b\n')
    path = str(tmp_path / "l.csv")
    assert csv_records.read_csv(spark, path).count() == 2
    with split_size(spark, 2000), pytest.raises(Exception, match="longer than the split"):
        csv_records.read_csv(spark, path).collect()


def test_member_list_with_line_breaks(spark, tmp_path):
    (tmp_path / "l.csv").write_text('Company Name,Country\r\n"A,\n ""x"" Ltd",NA\r\n b ,null\r\n')
    rows = tables.read_member_list(spark, str(tmp_path / "l.csv"), multi_line=True).orderBy("ordinal").collect()
    assert [tuple(r) for r in rows] == [(1, 'A,\n "x" Ltd', ""), (2, "b", "")]
    assert tables.read_member_list(spark, str(tmp_path / "l.csv"), None, multi_line=True).columns == ["Company Name", "Country"]
