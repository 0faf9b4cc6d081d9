"""Raw zone, hourly load and warehouse tables."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest

from tillwright.operators.cleaning import clean_sales
from tillwright.operators.dimensions import DIMENSION_KEYS, dimension_parts, dimensions_of_parts, transaction_dimensions
from tillwright.plans.hourly_load import PARTS, load_hour
from tillwright.schemas import RAW_GROUPS
from tillwright.session import work_folder
from tillwright.sinks import warehouse as wh
from tillwright.sources import raw_zone
from tillwright.sources.raw_zone import hour_partition, hour_path, land_group, land_hour, read_group, read_raw_zone
from tillwright.sources.raw_zone import write_csv as wh_csv

AS_OF = dt.datetime(2024, 1, 1, 0, 20, tzinfo=dt.timezone.utc)
HEADER = ",".join(RAW_GROUPS["sales_transactions"].names)


def sale(number, day="2023-12-31", customer=1, agent=7, offer_1="", mail="ann@mail.com"):
    return (
        f"{number},{day},{customer},Ann,Lee,{mail},{agent},3,11,lamp,home,{offer_1},,,,,2,10.0,yes,Card,Street/Cairo/Giza/1"
    )


def drop(landing, name, lines, header=HEADER, group="sales_transactions", at=None):
    folder = landing / name
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{group}_{name}.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    if at:
        os.utime(path, (at.timestamp(), at.timestamp()))


@pytest.fixture
def warehouse(spark, tmp_path):
    return wh.Warehouse(spark, str(tmp_path / "dwh"), f"retail_{uuid.uuid4().hex}")


def rows(frame, *names):
    return sorted((tuple(row) for row in frame.select(*names).collect()), key=lambda row: [(v is None, v) for v in row])


def test_previous_hour():
    assert hour_partition(AS_OF) == {"year": "2023", "month": "12", "day": "31", "hour": "23"}
    assert hour_path("/raw/", AS_OF) == "/raw/year=2023/month=12/day=31/hour=23"


def test_landing_takes_the_files_of_the_last_hour(spark, tmp_path):
    landing, raw = tmp_path / "in", str(tmp_path / "raw")
    hour = dt.timedelta(hours=1)
    drop(landing, "early", [sale("early")], at=AS_OF - hour - dt.timedelta(seconds=1))
    drop(landing, "first", [sale("first")], at=AS_OF - hour)
    drop(landing, "last", [sale("last", day="2022-13-45")], at=AS_OF - dt.timedelta(seconds=1))
    drop(landing, "next", [sale("next")], at=AS_OF)
    naive = AS_OF.replace(tzinfo=None)
    for _ in range(2):  # a rerun lands the same rows once
        land_group(spark, str(landing), raw, "sales_transactions", naive)
    landed = read_raw_zone(spark, raw, "sales_transactions")
    assert rows(landed, "transaction_id", "transaction_date", "year", "month", "day", "hour") == [
        ("first", "2023-12-31", "2023", "12", "31", "23"),
        ("last", "2022-13-45", "2023", "12", "31", "23"),
    ]
    assert land_group(spark, str(landing), raw, "branches", naive) is None


BRANCH_HEADERS = {"a": "class,branch_id,location,establish_date,extra", "b": "branch_id,location,establish_date,class"}


def test_columns_are_taken_by_the_header_of_each_file(spark, tmp_path):
    drop(tmp_path / "in", "a", ["A,7,Cairo,2020-01-01,zz"], BRANCH_HEADERS["a"], "branches")
    drop(tmp_path / "in", "b", ["8,Giza,2021-01-01,B"], BRANCH_HEADERS["b"], "branches")
    expected = [(7, "Cairo", "2020-01-01", "A"), (8, "Giza", "2021-01-01", "B")]
    names = RAW_GROUPS["branches"].names
    for folder in ("a", "b"):
        assert rows(read_group(spark, str(tmp_path / "in" / folder), "branches"), *names)[0] in expected
    naive = AS_OF.replace(tzinfo=None)
    target = land_group(spark, str(tmp_path / "in"), str(tmp_path / "raw"), "branches", naive, False)
    assert rows(read_raw_zone(spark, str(tmp_path / "raw"), "branches"), *names) == expected
    assert rows(read_group(spark, hour_path(str(tmp_path / "raw"), naive), "branches"), *names) == expected
    extra = spark.read.option("header", True).csv(target)
    assert {row["branch_id"]: row["extra"] for row in extra.collect()} == {"7": "zz", "8": None}


def test_a_file_without_a_declared_column_raises(spark, tmp_path):
    drop(tmp_path, "a", ["7,Cairo"], "branch_id,location", "branches")
    with pytest.raises(ValueError, match="establish_date, class"):
        read_group(spark, str(tmp_path / "a"), "branches")


def test_values_with_line_breaks_are_found_and_read(spark, tmp_path):
    agent = spark.createDataFrame([(1, "a\nb", "2020-01-01")], RAW_GROUPS["sales_agents"])
    with pytest.raises(Exception, match="line break"):
        wh_csv(agent, str(tmp_path / "x" / "sales_agents.csv"))
    wh_csv(agent, str(tmp_path / "y" / "sales_agents.csv"), multi_line=True)
    assert rows(read_group(spark, str(tmp_path / "y"), "sales_agents"), "name") == [("a\nb",)]


@pytest.mark.parametrize(
    ("line", "open_"),
    [
        ("a,b", False), ('"a","b"', False), ('"a', True), ('x,"a, b', True), ('x,"say ""hi"", ', True), ('x,"say ""hi"""', False),
        (r'x,"say \"hi\""', False), (r'x,"say \"hi', True), ('5" pipe,b', False), ('5" pipe,"a', True), ('b",6" x', False),
        ('"c:\\\\"', False), ('"c:\\"', True), ('a, "b', True), ('"","",""', False), ('"', True), ("", False), ('"a","b",,"', True),
    ],
)
def test_lines_that_end_inside_quotes(spark, line, open_):
    frame = spark.createDataFrame([(line,)], "value string")
    assert frame.select(raw_zone.ends_inside_quotes(frame["value"])).first()[0] is open_


def test_lines_without_quotes_are_not_searched(spark):
    frame = spark.range(1).selectExpr("'a,b' AS value")
    plain = "regexp_replace(value"
    for found in (raw_zone.ends_inside_quotes, raw_zone.closes_quotes):
        assert str(found(frame["value"])._jc.toString()).startswith("CASE WHEN")
        assert plain not in str(found(frame["value"])._jc.toString()).split("THEN")[1]


def test_plain_lines_land_as_they_are(spark, tmp_path):
    header = "sales_person_id,name,hire_date"
    lines = ["1,Ann,2020-01-01", r'2," b ",2020-01-01', "", "  ", "3, c ,", '4,"",x,more', "5", r"6,c:\dir,2020-01-01", '7,6" x,2020-01-01', "8,#,", "9,'\t',"]
    drop(tmp_path / "in", "x", lines, header, "sales_agents")
    drop(tmp_path / "in", "y", ["10,Bob,2020-01-02", header], header, "sales_agents")
    drop(tmp_path / "in", "z", ["11,Cy,2020-01-03"], header, "sales_agents")
    expected = [row for name in "xyz" for row in rows(read_group(spark, str(tmp_path / "in" / name), "sales_agents"), "sales_person_id", "name", "hire_date")]
    naive = AS_OF.replace(tzinfo=None)
    facts = raw_zone.survey(spark, [str(path) for path in sorted((tmp_path / "in").rglob("*.csv"))])
    assert raw_zone._alike(facts)
    target = land_hour(spark, str(tmp_path / "in"), str(tmp_path / "raw"), naive, ["sales_agents"], only_last_hour=False)["sales_agents"]
    landed = read_group(spark, hour_path(str(tmp_path / "raw"), naive), "sales_agents")
    assert sorted(map(str, rows(landed, "sales_person_id", "name", "hire_date"))) == sorted(map(str, expected)) and len(expected) == 12
    copied = [line for row in spark.read.text(target).collect() if (line := row.value) != header]
    assert set(copied) == {line for line in lines if line.strip()} | {"10,Bob,2020-01-02", "11,Cy,2020-01-03"}
    assert all(name.endswith(".csv.lz4") for name in os.listdir(target) if name.startswith("part-"))


@pytest.mark.parametrize("again, parsed", [([], False), (["name"], True)])
def test_lines_are_copied_without_the_reader_of_csv(spark, tmp_path, monkeypatch, again, parsed):
    """Where a row is like the header, which text alone can't tell, lines are read as values of CSV."""
    header, lines = "sales_person_id,name,hire_date", ["1, Ann,x", "", " \t", r'2,"b\",y ', "3,c"]
    drop(tmp_path / "in", "x", lines, header, "sales_agents")
    drop(tmp_path / "in", "y", ["4,d,z", *[header] * len(again)], header, "sales_agents")
    written, write = [], raw_zone.write_csv
    plan = lambda frame: frame._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(raw_zone, "write_csv", lambda frame, *args, **how: (written.append(plan(frame)), write(frame, *args, **how)))
    naive = AS_OF.replace(tzinfo=None)
    target = land_hour(spark, str(tmp_path / "in"), str(tmp_path / "raw"), naive, ["sales_agents"], only_last_hour=False)["sales_agents"]
    assert [" csv" in plan for plan in written] == [parsed]
    landed = rows(spark.read.text(target), "value")
    assert [value for value, in landed if value != header] == sorted([*(line for line in lines if line.strip()), "4,d,z"])
    names = rows(read_group(spark, hour_path(str(tmp_path / "raw"), naive), "sales_agents"), "name")
    assert len(names) == 4 + len(again) and (("name",) in names) == bool(again)


def test_headers_that_differ_as_text_are_not_copied_as_rows(spark, tmp_path):
    for name, header in {"x": "sales_person_id,name,hire_date", "y": "sales_person_id, name,hire_date", "z": '"sales_person_id",name,hire_date'}.items():
        drop(tmp_path / "in", name, [f"1,{name},", "sales_person_id,name,hire_date"][: 1 + (name == "x")], header, "sales_agents")
    naive = AS_OF.replace(tzinfo=None)
    land_hour(spark, str(tmp_path / "in"), str(tmp_path / "raw"), naive, ["sales_agents"], only_last_hour=False)
    landed = read_group(spark, hour_path(str(tmp_path / "raw"), naive), "sales_agents")
    assert rows(landed, "name") == [("name",), ("x",), ("y",), ("z",)]


@pytest.mark.parametrize("odd", ["\x01", "\x00", "#"])
def test_lines_that_hold_the_separator_of_lines_are_parsed(spark, tmp_path, odd):
    header = "sales_person_id,name,hire_date"
    drop(tmp_path / "in", "x", ["1,Ann,2020-01-01", f"2,a{odd}b,2020-01-01", f"3,{odd}c{odd},", "#,e,"], header, "sales_agents")
    drop(tmp_path / "in", "y", ["4,d,"], header, "sales_agents")
    naive = AS_OF.replace(tzinfo=None)
    land_hour(spark, str(tmp_path / "in"), str(tmp_path / "raw"), naive, ["sales_agents"], only_last_hour=False)
    landed = read_group(spark, hour_path(str(tmp_path / "raw"), naive), "sales_agents")
    assert rows(landed, "name") == sorted([("Ann",), (f"a{odd}b",), (f"{odd}c{odd}",), ("d",), ("e",)])


def test_dimensions_of_one_pass_are_those_of_five(spark, raw_sales):
    sales = clean_sales(raw_sales(
        {}, {}, {"customer_id": None, "customer_fname": None}, {"cusomter_email": None},
        {"product_id": None, "product_name": None, "product_category": None},
        {"shipping_address": "Street/Cairo/Giza/1", "offer_1": True}, {"shipping_address": "Street/Cairo/Giza/2", "offer_1": False},
        {"shipping_address": "Street/Cairo", "offer_5": False}, {"is_online": None, "offer_3": True}, {"payment_method": None},
    ))
    one, five = dimensions_of_parts(dimension_parts(sales)), transaction_dimensions(sales)
    assert list(one) == list(five)
    for table, frame in five.items():
        assert one[table].schema.simpleString() == frame.schema.simpleString()
        assert rows(one[table], *frame.columns) == rows(frame, *frame.columns), table
    empty = sales.where("false")
    assert all(frame.count() == 0 for frame in dimensions_of_parts(dimension_parts(empty)).values())


def test_parts_of_dimensions_are_grouping_sets(spark, raw_sales):
    """Spark expands rows to sets without making an array of structs for each sale."""
    parts = dimension_parts(clean_sales(raw_sales({}, {"customer_id": None}, {"customer_id": None, "product_id": None})))
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "Generate" not in plan
    assert sorted(row["part"] for row in parts.collect()) == ["customer"] * 2 + ["other"] + ["product"] * 2


def test_parts_of_dimensions_are_narrow(spark, raw_sales):
    """Rows that are compared and shuffled for each sale have the columns of one part, and not those of all."""
    sales = clean_sales(raw_sales({"offer_1": True, "offer_3": False}, {"offer_5": False}, {"shipping_address": "S/Cairo/Giza/1"}))
    parts = dimension_parts(sales)
    assert len(parts.columns) <= 6
    offers = rows(dimensions_of_parts(parts)["offer_Dim"], "offer_name")
    assert offers == [("offer_1",), ("offer_3",), ("offer_5",)]


def test_line_breaks_land_and_only_their_files_are_read_whole(spark, tmp_path):
    values = ['"two\nlines"', r'"a \"quoted\"' + '\nword, and\n\n more"', r'"c:\\"', "plain", '"ends\n"']
    drop(tmp_path / "in", "x", [f"{n},{value},2020-01-01" for n, value in enumerate(values)], "sales_person_id,name,hire_date", "sales_agents")
    drop(tmp_path / "in", "y", [r'7,"Ann, \"A\"",2020-01-01', r'8,"c:\dir\",2020-01-01'], "sales_person_id,name,hire_date", "sales_agents")
    facts = raw_zone.survey(spark, [str(path) for path in sorted((tmp_path / "in").rglob("*.csv"))])
    assert [file.multi_line for file in facts] == [True, False]
    naive = AS_OF.replace(tzinfo=None)
    land_hour(spark, str(tmp_path / "in"), str(tmp_path / "raw"), naive, only_last_hour=False)
    expected = rows(read_group(spark, str(tmp_path / "in" / "x"), "sales_agents"), "sales_person_id", "name", "hire_date")
    assert [row[1] for row in expected] == ["two\nlines", 'a "quoted"\nword, and\n\n more', "c:\\", "plain", "ends\n"]
    stray = rows(read_group(spark, str(tmp_path / "in" / "y"), "sales_agents"), "sales_person_id", "name", "hire_date")
    assert stray[0] == (7, 'Ann, "A"', "2020-01-01") and len(stray) == 2
    expected = sorted([*expected, *stray])
    for landed in (read_group(spark, hour_path(str(tmp_path / "raw"), naive), "sales_agents"), read_raw_zone(spark, str(tmp_path / "raw"), "sales_agents")):
        assert rows(landed, "sales_person_id", "name", "hire_date") == expected


@pytest.mark.parametrize(
    ("line", "closes"),
    [("a,b", False), ('lines",x', True), ('"', True), ('",x', True), ('"a",b', False), ('b","c', True), ('5" pipe', False),
     ('x,"a', False), (r'\"b\""', True), ('a, b"', True), ('"a, b"', False), (',"a"', False), ("", False)],
)
def test_lines_that_close_quotes(spark, line, closes):
    frame = spark.createDataFrame([(line,)], "value string")
    assert frame.select(raw_zone.closes_quotes(frame["value"])).first()[0] is closes


def test_line_breaks_beside_stray_quotes_need_a_word(spark, tmp_path):
    drop(tmp_path, "h", ['1,"a', 'b",2020-01-01', '2,"c,2020-01-01'], "sales_person_id,name,hire_date", "sales_agents")
    with pytest.raises(ValueError, match="stray quotes"):
        read_group(spark, str(tmp_path / "h"), "sales_agents")
    assert read_group(spark, str(tmp_path / "h"), "sales_agents", multi_line=True).count() == 2
    assert read_group(spark, str(tmp_path / "h"), "sales_agents", multi_line=False).count() == 3


def test_a_header_over_two_lines(spark, tmp_path):
    for name in ("a", "b"):
        drop(tmp_path, name, ["7,Ann,2020-01-01,z"], f'sales_person_id,name,hire_date,"extra\n{name}"', "sales_agents")
    facts = raw_zone.survey(spark, [str(path) for path in sorted(tmp_path.rglob("*.csv"))])
    assert [file.columns[-1] for file in facts] == ["extra\na", "extra\nb"] and all(file.multi_line for file in facts)
    assert rows(read_group(spark, str(tmp_path / "a"), "sales_agents"), "name") == [("Ann",)]


def test_jobs_do_not_grow_with_the_number_of_files(spark, tmp_path):
    def jobs(folder, number):
        for k in range(number):
            drop(tmp_path / folder, f"d{k}", [f"{k},Ann,2020-01-01"], "sales_person_id,name,hire_date", "sales_agents")
        spark.sparkContext.setJobGroup(folder, folder)
        land_hour(spark, str(tmp_path / folder), str(tmp_path / f"raw-{folder}"), AS_OF.replace(tzinfo=None), only_last_hour=False)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(folder))

    few, many = jobs("few", 40), jobs("many", 200)
    assert 0 < many <= few + 2
    assert read_raw_zone(spark, str(tmp_path / "raw-many"), "sales_agents").count() == 200


def test_an_hour_needs_all_groups_and_its_commit_marker(spark, tmp_path, warehouse):
    naive, raw = AS_OF.replace(tzinfo=None), str(tmp_path / "raw")
    drop(tmp_path / "in", "x", ["7,Ann,2020-01-01"], "sales_person_id,name,hire_date", "sales_agents")
    assert raw_zone.missing_groups(spark, hour_path(raw, naive)) == list(RAW_GROUPS)
    land_group(spark, str(tmp_path / "in"), raw, "sales_agents", naive, False)
    assert raw_zone.missing_groups(spark, hour_path(raw, naive)) == ["branches", "sales_transactions"]
    with pytest.raises(FileNotFoundError, match="branches, sales_transactions"):
        load_hour(spark, raw, warehouse, naive)
    assert not warehouse.exists("sales_agents_Dim")
    for group in ("branches", "sales_transactions"):
        land_group(spark, str(tmp_path / "in"), raw, group, naive, False)
    load_hour(spark, raw, warehouse, naive)
    assert rows(warehouse.table("sales_agents_Dim"), "name") == [("Ann",)]


def test_a_landing_that_breaks_leaves_no_commit_marker(spark, tmp_path, monkeypatch):
    naive, raw = AS_OF.replace(tzinfo=None), str(tmp_path / "raw")
    land(spark, tmp_path, naive, [sale("a")])
    assert raw_zone.missing_groups(spark, hour_path(raw, naive)) == []

    def broken(*_, **__):
        raise OSError("disk")

    monkeypatch.setattr(raw_zone, "write_csv", broken)
    with pytest.raises(OSError):
        land(spark, tmp_path, naive, [sale("a"), sale("b")])
    assert raw_zone.missing_groups(spark, hour_path(raw, naive)) == list(RAW_GROUPS)
    monkeypatch.undo()
    land(spark, tmp_path, naive, [sale("a"), sale("b")])
    assert raw_zone.missing_groups(spark, hour_path(raw, naive)) == []
    assert read_raw_zone(spark, raw, "sales_transactions").count() == 2


def test_folders_that_other_tools_filled_need_files_of_every_group(spark, tmp_path):
    drop(tmp_path, "h", [sale("a")])
    assert raw_zone.missing_groups(spark, str(tmp_path / "h")) == ["branches", "sales_agents"]
    drop(tmp_path, "h", ["7,Ann,2020-01-01"], "sales_person_id,name,hire_date", "sales_agents")
    drop(tmp_path, "h", ["3,Cairo,2019-05-05,A"], "branch_id,location,establish_date,class", "branches")
    assert raw_zone.missing_groups(spark, str(tmp_path / "h")) == []


def test_older_files_that_are_in_no_hour_are_reported_and_can_be_landed(spark, tmp_path):
    landing, raw, naive = tmp_path / "in", str(tmp_path / "raw"), AS_OF.replace(tzinfo=None)
    drop(landing, "done", [sale("done")], at=AS_OF - dt.timedelta(minutes=90))
    drop(landing, "copied", [sale("copied")], at=AS_OF - dt.timedelta(days=3))
    drop(landing, "now", [sale("now")], at=AS_OF - dt.timedelta(minutes=30))
    older = lambda: raw_zone.unlanded_files(spark, str(landing), raw, "sales_transactions", naive - dt.timedelta(hours=1)).count()
    assert older() == 2
    land_hour(spark, str(landing), raw, naive - dt.timedelta(hours=1))
    assert older() == 1
    land_hour(spark, str(landing), raw, naive)
    assert older() == 1
    land_hour(spark, str(landing), raw, naive, late=True)
    assert older() == 0
    assert rows(read_raw_zone(spark, raw, "sales_transactions"), "transaction_id", "hour") == [
        ("copied", "23"), ("done", "22"), ("now", "23"),
    ]


def test_landing_again_never_loses_what_was_landed(spark, tmp_path):
    landing, raw, naive = tmp_path / "in", str(tmp_path / "raw"), AS_OF.replace(tzinfo=None)
    half = AS_OF - dt.timedelta(minutes=30)
    drop(landing, "one", [sale("one")], at=half)
    drop(landing, "two", [sale("two")], at=half)
    land_it = lambda **how: land_group(spark, str(landing), raw, "sales_transactions", naive, **how)
    landed = lambda: rows(read_raw_zone(spark, raw, "sales_transactions"), "transaction_id")
    assert land_it() and landed() == [("one",), ("two",)]
    drop(landing, "one", [sale("one")], at=AS_OF)  # touched: it is no longer of that hour
    with pytest.raises(ValueError):
        land_it()
    drop(landing, "two", [sale("two")], at=AS_OF)
    assert land_it() is None and landed() == [("one",), ("two",)]
    drop(landing, "two", [sale("two")], at=half)
    assert land_it(replace=True) and landed() == [("two",)]
    drop(landing, "late", [sale("late")], at=half)
    assert land_it() and landed() == [("late",), ("two",)]


def test_groups_do_not_mix_and_missing_groups_are_empty(spark, tmp_path):
    drop(tmp_path, "h", [sale("a")])
    drop(tmp_path, "h", ["7,Ann,2020-01-01"], "sales_person_id,name,hire_date", "sales_agents")
    folder = str(tmp_path / "h")
    assert read_group(spark, folder, "sales_transactions").count() == 1
    assert rows(read_group(spark, folder, "sales_agents"), "name") == [("Ann",)]
    empty = read_group(spark, folder, "branches")
    assert empty.count() == 0 and empty.schema == RAW_GROUPS["branches"]


def test_an_hour_of_blank_flags_keeps_its_types(spark, tmp_path):
    drop(tmp_path, "h", [sale("a"), sale("b", offer_1="")])
    assert dict(read_group(spark, str(tmp_path / "h"), "sales_transactions").dtypes)["offer_1"] == "boolean"


def test_landing_carries_values_as_they_are(spark, tmp_path):
    odd = ['" lamp "', "' x", '"a, b"', r'"say \"hi\""', "back\\slash", '""', "", "  ", "ünï", '"c:\\dir\\"', "tab\there", "x\\"]
    lines = [sale(n).replace(",lamp,", f",{value},") for n, value in enumerate(odd)]
    drop(tmp_path / "in", "x", lines)
    land_group(spark, str(tmp_path / "in"), str(tmp_path / "raw"), "sales_transactions", AS_OF.replace(tzinfo=None), False)
    before = read_group(spark, str(tmp_path / "in" / "x"), "sales_transactions")
    after = read_raw_zone(spark, str(tmp_path / "raw"), "sales_transactions")
    names = RAW_GROUPS["sales_transactions"].names
    read = lambda frame: sorted((repr(tuple(row)) for row in frame.select(*names).collect()))
    assert read(after) == read(before) and len(lines) == after.count()


def land(spark, tmp_path, as_of, lines, agents=("7,Ann,2020-01-01",)):
    landing = tmp_path / f"in-{as_of:%H}"
    drop(landing, "x", lines)
    drop(landing, "x", agents, "sales_person_id,name,hire_date", "sales_agents")
    drop(landing, "x", ["3,Cairo,2019-05-05,A"], "branch_id,location,establish_date,class", "branches")
    land_hour(spark, str(landing), str(tmp_path / "raw"), as_of, only_last_hour=False)


def test_hourly_load_is_incremental_and_repeatable(spark, tmp_path, warehouse):
    first, second = AS_OF.replace(tzinfo=None), AS_OF.replace(tzinfo=None) + dt.timedelta(hours=1)
    land(spark, tmp_path, first, [sale("a"), sale("b", day="2024-01-01", offer_1="true"), sale("x", day="2022-13-45")])
    land(spark, tmp_path, second, [sale("c", day="2024-01-01"), sale("d", customer=2), sale("e", mail="new@mail.com")],
         agents=("7,Changed,2021-01-01", "8,Bob,2021-01-01"))
    raw, rejects = str(tmp_path / "raw"), str(tmp_path / "rejects")

    def state():
        fact = rows(warehouse.table(wh.FACT_TABLE), "transaction_id", "batch_hour", "total_price")
        return fact, {t: sorted(map(tuple, warehouse.table(t).collect()), key=repr) for t in DIMENSION_KEYS}

    load_hour(spark, raw, warehouse, first, rejects_folder=rejects)
    load_hour(spark, raw, warehouse, second, rejects_folder=rejects)
    fact, dimensions = state()
    assert fact == [("a", "2023123123", 20.0), ("b", "2023123123", 19.0), ("c", "2024010100", 20.0),
                    ("d", "2024010100", 20.0), ("e", "2024010100", 20.0), ("x", "2023123123", 20.0)]
    assert [row[:2] for row in dimensions["sales_agents_Dim"]] == [(7, "Ann"), (8, "Bob")]
    assert [(row[0], row[3]) for row in dimensions["customer_Dim"]] == [(1, "ann@mail.com"), (2, "ann@mail.com")]
    assert dimensions["offer_Dim"] == [("5-offer_1", "offer_1", 5)]
    assert warehouse.table(wh.DATE_TABLE).count() == 4018

    load_hour(spark, raw, warehouse, first, rejects_folder=rejects)
    load_hour(spark, raw, warehouse, second, rejects_folder=rejects)
    assert state() == (fact, dimensions)
    assert rows(spark.read.parquet(f"{rejects}/sales_transactions"), "transaction_id") == [("x",)]


def test_an_append_to_a_dimension_does_not_read_the_sales_again(spark, tmp_path, warehouse, monkeypatch):
    """What the dimensions are made of is read from the raw files once, also where a plan names it twice."""
    naive, raw = AS_OF.replace(tzinfo=None), str(tmp_path / "raw")
    second = naive + dt.timedelta(hours=1)
    land(spark, tmp_path, naive, [sale("a"), sale("b", offer_1="true")])
    land(spark, tmp_path, second, [sale("c"), sale("d", customer=2)])
    load_hour(spark, raw, warehouse, naive)
    landed, hidden = f"{hour_path(raw, second)}/sales_transactions.csv", f"{tmp_path}/hidden"
    new_rows, appended = wh.new_rows_for_small_batch, {}

    def without_raw_files(batch, stored, key, one_per_key=False):
        batch.count()  # kept from here on
        os.rename(landed, hidden)
        try:
            appended[key] = len((fresh := new_rows(batch, stored, key, one_per_key).persist()).collect())
        finally:
            os.rename(hidden, landed)
        return fresh

    monkeypatch.setattr(wh, "new_rows_for_small_batch", without_raw_files)
    load_hour(spark, raw, warehouse, second)
    assert appended == dict.fromkeys(DIMENSION_KEYS.values(), 0) | {"customer_id": 1}
    assert rows(warehouse.table("customer_Dim"), "customer_id") == [(1,), (2,)]
    assert warehouse.table(wh.FACT_TABLE).count() == 4
    assert not list((tmp_path / "dwh" / PARTS).iterdir())


def test_a_failed_load_leaves_no_parts_and_the_next_one_replaces_those_of_a_killed_one(spark, tmp_path, warehouse, monkeypatch):
    naive, raw = AS_OF.replace(tzinfo=None), str(tmp_path / "raw")
    land(spark, tmp_path, naive, [sale("a")])
    parts = tmp_path / "dwh" / PARTS / "batch_hour=2023123123"
    with monkeypatch.context() as patched:
        patched.setattr(wh.Warehouse, "load_dimension", lambda *args: pytest.fail("load"))
        with pytest.raises(pytest.fail.Exception):
            load_hour(spark, raw, warehouse, naive)
    assert not parts.exists()
    spark.createDataFrame([("other", "Nowhere", "None")], "part string, city string, state string").write.parquet(str(parts))
    load_hour(spark, raw, warehouse, naive)
    assert rows(warehouse.table("location_Dim"), "location_id") == [("Cairo-Giza",)] and not parts.exists()


def test_an_hour_without_files_loads_nothing_and_the_next_one_loads(spark, tmp_path, warehouse):
    naive = AS_OF.replace(tzinfo=None)
    with pytest.raises(FileNotFoundError):
        load_hour(spark, str(tmp_path / "raw"), warehouse, naive)
    assert not any(land_hour(spark, str(tmp_path / "none"), str(tmp_path / "raw"), naive).values())
    land(spark, tmp_path, naive + dt.timedelta(hours=1), [sale("a")])
    load_hour(spark, str(tmp_path / "raw"), warehouse, naive)
    assert warehouse.table(wh.FACT_TABLE).count() == 0
    load_hour(spark, str(tmp_path / "raw"), warehouse, naive + dt.timedelta(hours=1))
    assert rows(warehouse.table(wh.FACT_TABLE), "transaction_id") == [("a",)]
    assert {t: warehouse.table(t).count() for t in DIMENSION_KEYS} == dict.fromkeys(DIMENSION_KEYS, 1) | {"offer_Dim": 0}


def test_fact_partitions_are_padded_text_and_prune(spark, tmp_path, warehouse):
    fact = spark.createDataFrame(
        [("20220501", "2022", "05", "01", 1), ("20220502", "2022", "05", "02", 2), (None, None, None, None, 3)],
        "transaction_date_id string, year string, month string, day string, units int",
    )
    warehouse.load_fact(fact, "2022050109")
    stored = warehouse.table(wh.FACT_TABLE)
    one = stored.where("year = '2022' and month = '05' and day = '01'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan[plan.index("PartitionFilters"):].split("]")[0]
    assert [row["units"] for row in one.collect()] == [1]
    assert rows(stored, "units") == [(1,), (2,), (3,)]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_reloading_an_hour_replaces_all_of_it_and_nothing_else(spark, warehouse, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        _reload(spark, warehouse)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def _reload(spark, warehouse):
    schema = "transaction_date_id string, year string, month string, day string, units int"
    day = lambda d, n: (f"202205{d}", "2022", "05", d, n)
    warehouse.load_fact(spark.createDataFrame([day("01", 1), day("02", 2)], schema), "2022050109")
    warehouse.load_fact(spark.createDataFrame([day("01", 3)], schema), "2022050110")
    warehouse.load_fact(spark.createDataFrame([day("02", 4)], schema), "2022050109")
    assert rows(warehouse.table(wh.FACT_TABLE), "batch_hour", "units") == [("2022050109", 4), ("2022050110", 3)]
    with pytest.raises(ValueError):
        warehouse.load_fact(spark.createDataFrame([], schema), "x' or 'y")
    with pytest.raises(ValueError):  # nothing does not replace something, unless that is meant
        warehouse.load_fact(spark.createDataFrame([], schema), "2022050109")
    assert warehouse.table(wh.FACT_TABLE).count() == 2
    warehouse.load_fact(spark.createDataFrame([], schema), "2022050109", allow_empty=True)
    assert rows(warehouse.table(wh.FACT_TABLE), "batch_hour", "units") == [("2022050110", 3)]


FACT = "transaction_date_id string, year string, month string, day string, units int"


def merged_rows(warehouse):
    return rows(warehouse.table(wh.FACT_TABLE), "batch_hour", "day", "units")


def test_closed_days_are_merged_and_hours_can_be_loaded_again(spark, tmp_path, warehouse):
    day = lambda d, n: (f"202205{d}", "2022", "05", d, n)
    load = lambda hour, *days: warehouse.load_fact(spark.createDataFrame(list(days), FACT).repartition(3), hour)
    for hour in range(6):
        load(f"202205010{hour}", day("01", hour), day("02", 10 + hour), (None, None, None, None, 20 + hour))
    load("2022050200", day("02", 99))
    before, files = merged_rows(warehouse), lambda: len(list((tmp_path / "dwh").rglob("*.parquet")))
    small = files()
    assert warehouse.merge_closed_days(dt.date(2022, 5, 2)) == ["20220501"]
    assert merged_rows(warehouse) == before and warehouse.table(wh.FACT_TABLE).columns[-4:] == wh.FACT_PARTITIONS
    assert warehouse.merge_closed_days(dt.date(2022, 5, 2)) == []
    assert warehouse.remove_merged() == 6 and warehouse.remove_merged() == 0
    assert merged_rows(warehouse) == before and files() < small / 2
    # An hour of the merged day again, with fewer days; then an hour of nothing.
    load("2022050103", day("01", 7))
    expected = sorted([row for row in before if row[0] != "2022050103"] + [("2022050103", "01", 7)], key=str)
    assert sorted(merged_rows(warehouse), key=str) == expected
    warehouse.load_fact(spark.createDataFrame([], FACT), "2022050104", allow_empty=True)
    expected = [row for row in expected if row[0] != "2022050104"]
    assert sorted(merged_rows(warehouse), key=str) == expected
    assert warehouse.merge_closed_days(dt.date(2022, 5, 3)) == ["20220501", "20220502"]
    assert warehouse.remove_merged() == 3  # two hours, and the first merge
    assert sorted(merged_rows(warehouse), key=str) == expected
    # A session without the catalog finds the same rows, and hours are still loaded.
    other = wh.Warehouse(spark, str(tmp_path / "dwh"), f"retail_{uuid.uuid4().hex}")
    assert sorted(merged_rows(other), key=str) == expected
    other.load_fact(spark.createDataFrame([day("01", 5)], FACT), "2022050300")
    assert sorted(merged_rows(other), key=str) == sorted([*expected, ("2022050300", "01", 5)], key=str)


def test_a_merge_that_broke_is_not_seen_and_done_again(spark, warehouse, monkeypatch):
    day = lambda d, n: (f"202205{d}", "2022", "05", d, n)
    for hour in range(2):
        warehouse.load_fact(spark.createDataFrame([day("01", hour)], FACT), f"202205010{hour}")
    before, commit = merged_rows(warehouse), wh.fact_merge._commit
    calls = []

    def broken(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("disk")
        commit(*args)

    monkeypatch.setattr(wh.fact_merge, "_commit", broken)
    with pytest.raises(OSError):
        warehouse.merge_closed_days(dt.date(2022, 5, 2))
    assert merged_rows(warehouse) == before
    monkeypatch.undo()
    assert warehouse.merge_closed_days(dt.date(2022, 5, 2)) == ["20220501"]
    assert merged_rows(warehouse) == before


def test_merged_days_prune_by_sales_day(spark, warehouse):
    day = lambda d, n: (f"202205{d}", "2022", "05", d, n)
    warehouse.load_fact(spark.createDataFrame([day("01", 1), day("02", 2)], FACT), "2022050100")
    warehouse.merge_closed_days(dt.date(2022, 5, 2))
    one = warehouse.table(wh.FACT_TABLE).where("year = '2022' and month = '05' and day = '02'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(year") == 2 and [row["units"] for row in one.collect()] == [2]


def test_days_are_hashed_only_where_that_is_asked_for(spark):
    fact = spark.range(100).selectExpr("id units", "'2022' year", "'05' month", "cast(id % 10 as string) day")
    plan = lambda **how: wh.by_day(fact, **how)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan(hash_days=True)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan()


def test_hot_day_is_split_over_tasks(spark, tmp_path):
    fact = spark.range(0, 2_000_000, 1, 8).selectExpr(
        "cast(xxhash64(id) as string) transaction_id", "'2022' year", "'05' month", "'01' day"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        wh.write_fact_folder(fact, str(tmp_path / "fact"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "fact").rglob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "fact")).count() == 2_000_000


def test_static_table_is_written_once(spark, warehouse):
    assert warehouse.load_static("t", spark.range(3))
    assert not warehouse.load_static("t", spark.range(5))
    assert warehouse.table("t").count() == 3


def test_rows_without_key_are_stored_by_no_load(spark, tmp_path, warehouse):
    first, second = AS_OF.replace(tzinfo=None), AS_OF.replace(tzinfo=None) + dt.timedelta(hours=1)
    land(spark, tmp_path, first, [sale("a"), sale("b", customer="")])
    land(spark, tmp_path, second, [sale("c", customer=""), sale("d", customer=2)])
    rejects = str(tmp_path / "rejects")
    for hour in (first, second, first):
        load_hour(spark, str(tmp_path / "raw"), warehouse, hour, rejects_folder=rejects)
    assert rows(warehouse.table("customer_Dim"), "customer_id") == [(1,), (2,)]
    assert spark.read.parquet(f"{rejects}/customer_Dim").count() == 2
    assert rows(warehouse.table(wh.FACT_TABLE), "transaction_id") == [("a",), ("b",), ("c",), ("d",)]


def test_dimension_first_load_may_keep_one_row_per_key(spark, warehouse):
    batch = spark.createDataFrame([(1, "b"), (1, "a")], "id long, name string")
    warehouse.load_dimension("d", "id", batch, one_per_key=True)
    assert rows(warehouse.table("d"), "id", "name") == [(1, "a")]


def test_work_folders_are_new_and_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    one, two = work_folder(spark, "x"), work_folder(spark, "x")
    assert one != two
    assert not shared or one.startswith(shared.rstrip("/") + "/")


def test_rows_without_a_catalog_entry_are_found_again(spark, tmp_path):
    schema = "transaction_date_id string, year string, month string, day string, units int"
    day = lambda d, n: (f"202205{d}", "2022", "05", d, n)
    batch = spark.createDataFrame([(1, "a")], "id long, name string")
    for number in range(2):  # two sessions that share the folder but no catalog
        warehouse = wh.Warehouse(spark, str(tmp_path / "dwh"), f"retail_{uuid.uuid4().hex}")
        assert warehouse.exists("d") == (number == 1)
        warehouse.load_dimension("d", "id", batch)
        warehouse.load_fact(spark.createDataFrame([day("01", number)], schema), f"202205010{number}")
    assert rows(warehouse.table("d"), "id") == [(1,)]
    assert rows(warehouse.table(wh.FACT_TABLE), "batch_hour", "day", "units") == [
        ("2022050100", "01", 0), ("2022050101", "01", 1),
    ]
    with pytest.raises(LookupError):
        warehouse.table("unknown")


def test_a_broken_first_load_is_replaced(spark, tmp_path, warehouse):
    (tmp_path / "dwh" / "d" / "_temporary" / "0").mkdir(parents=True)
    warehouse.load_dimension("d", "id", spark.range(3))
    assert warehouse.table("d").count() == 3
