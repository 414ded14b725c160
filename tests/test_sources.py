import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.sources import JdbcSource, SourceConfig, TableSource, read_sources
from skyledger.sources import readers
from skyledger.sources.paths import Staging, exists

AIRCRAFT_CSV = """aircraft_reg_code,manufacturer_serial_number,aircraft_model,aircraft_manufacturer
XY-AAA,MSN 1,A350 XWB,Airbus
XY-BBB,MSN 2,"737, MAX",Boeing
XY-CCC,MSN 3,,Embraer"""
PERSONNEL_CSV = "airport,reporteurid\nCGN, 12 \nBCN,34\n"


@pytest.fixture
def lookups(tmp_path):
    (tmp_path / "aircraft-manufaturerinfo-lookup.csv").write_text(AIRCRAFT_CSV)
    (tmp_path / "maintenance_personnel.csv").write_text(PERSONNEL_CSV)
    return tmp_path


def test_second_spelling_of_the_aircraft_file(spark, lookups):
    rows = [tuple(r) for r in readers.read_aircrafts(spark, str(lookups)).collect()]
    assert rows == [("XY-AAA", "A350 XWB", "Airbus"), ("XY-BBB", "737, MAX", "Boeing"), ("XY-CCC", "", "Embraer")]


def test_first_spelling_is_preferred(spark, lookups):
    (lookups / "aircraft-manufacturerinfo-lookup.csv").write_text(AIRCRAFT_CSV.splitlines()[0] + "\nXY-ZZZ,1,2,Airbus\n")
    assert readers.read_aircrafts(spark, str(lookups)).first().registration == "XY-ZZZ"


def test_columns_go_by_name(spark, lookups):
    assert [tuple(r) for r in readers.read_personnel(spark, str(lookups)).collect()] == [(" 12 ", "CGN"), ("34", "BCN")]


def test_missing_lookup(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="aircraft-manufacturerinfo-lookup.csv"):
        readers.read_aircrafts(spark, str(tmp_path))


def test_read_sources(spark, make, lookups, tmp_path):
    flights = make.flights([("XY-AAA", "2024-01-01T08:00", "2024-01-01T09:00", None, None, True)])
    flights.write.parquet(str(tmp_path / "f"))
    make.maintenance([("XY-AAA", "2024-01-01T08:00", "2024-01-01T09:00", True)], keyed=False).write.json(str(tmp_path / "m"))
    make.reports([("XY-AAA", "2024-01-01T08:00", 1, "PIREP")]).write.option("header", True).csv(str(tmp_path / "r"))
    config = SourceConfig(
        TableSource(str(tmp_path / "f")),
        TableSource(str(tmp_path / "m"), "json"),
        TableSource(str(tmp_path / "r"), "csv", {"header": "true"}),
        str(lookups),
    )
    got = read_sources(spark, config)
    assert got["flights"].columns == [*schemas.FLIGHTS.fieldNames(), "row_key"]
    assert got["maintenance"].columns == schemas.MAINTENANCE.fieldNames()
    assert [f.dataType for f in got["reports"].schema] == [f.dataType for f in schemas.REPORTS]
    assert got["reports"].first().reporteurid == 1 and got["maintenance"].first().programmed is True


def test_csv_columns_go_by_name_and_keep_the_row_key(spark, make, tmp_path):
    flights = make.flights([
        ("XY-AAA", "2024-01-01T08:00", "2024-01-01T09:00", "2024-01-01T08:05", None, None),
        ("XY-BBB", "2024-01-02T08:00", "2024-01-02T09:00", None, None, True),
    ])
    mixed = flights.select(F.lit("F1").alias("flightid"), *reversed(flights.columns), F.lit(None).cast("string").alias("more"))
    for number, form in enumerate(("csv", "json", "parquet")):
        mixed.write.format(form).option("header", True).save(str(tmp_path / form))
        got = TableSource(str(tmp_path / form), form, row_key=form == "json").load(spark, schemas.FLIGHTS)
        assert got.columns == [*schemas.FLIGHTS.fieldNames(), "row_key"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, flights.select(got.columns).collect()), key=str)
    mixed.drop("actualarrival").write.option("header", True).csv(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="actualarrival"):
        TableSource(str(tmp_path / "short"), "csv").load(spark, schemas.FLIGHTS)


def test_a_malformed_line_fails_the_read(spark, tmp_path):
    (tmp_path / "r.csv").write_text("aircraftregistration,reportingdate,reporteurid,reporteurclass\nA,2024-01-01,x,PIREP\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        TableSource(str(tmp_path / "r.csv"), "csv").load(spark, schemas.REPORTS).collect()


SECRET = {"url": "jdbc:postgresql://db/x", "password": "hush"}


def test_jdbc_properties():
    sources = readers.jdbc_sources(SECRET, "2015-01-01", "2025-01-01", 64)
    properties = sources["reports"].properties()
    assert sources["reports"].table == '"AMOS"."postflightreports"'
    assert properties["preferTimestampNTZ"] == "true" and "url" not in properties
    assert "hush" not in repr(sources["flights"])
    with pytest.raises(ValueError, match="bounds") as error:
        JdbcSource(SECRET, "t", "c").predicates()
    assert "hush" not in str(error.value)
    assert JdbcSource(SECRET, "t").predicates() is None


@pytest.mark.parametrize("name,schema", [("flights", schemas.FLIGHTS), ("maintenance", schemas.MAINTENANCE), ("reports", schemas.REPORTS)])
def test_jdbc_ranges_split_all_times_without_a_zone(spark, name, schema):
    """Every time, also outside the bounds and none, meets exactly one condition."""
    source = readers.jdbc_sources(SECRET, "2015-01-01", "2016-01-01", 7)[name]
    conditions = source.predicates()
    assert len(conditions) == 7 + 3
    column = next(f for f in schema.fields if f.name == source.partition_column)
    assert column.dataType.typeName() == "timestamp_ntz"
    times = [None, "1900-01-01T00:00", "2014-12-31T23:59:59.999999", "2015-01-01T00:00", "2015-12-31T23:59:59.999999", "2016-01-01T00:00"]
    times += [f"2015-{m:02}-{d:02}T{h:02}:00" for m in range(1, 13) for d in (1, 22) for h in (0, 13)]
    times += [c.split("'")[1].replace(" ", "T") for c in conditions if "'" in c]
    rows = spark.createDataFrame([(t and dt.datetime.fromisoformat(t),) for t in times], f"{column.name} timestamp_ntz")
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
    try:
        met = rows.select(sum((F.when(F.expr(c), 1).otherwise(0) for c in conditions), F.lit(0)).alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.timestampType")
    assert {r.n for r in met} == {1}


def test_staging_writes_once_and_cleans_up(spark):
    stage = Staging(spark)
    assert stage.folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    df = stage(spark.range(5), "numbers")
    assert df.count() == 5 and exists(spark, stage.folder)
    stage(spark.range(1), "more")
    stage.remove("more", "none of this name")
    assert not exists(spark, f"{stage.folder}/more") and df.count() == 5
    stage.close()
    assert not exists(spark, stage.folder)


BROKEN = {
    "XY-B": readers.MISCOUNTED,
    "XY-C,1,m,Airbus,more": readers.MISCOUNTED,
    'XY-D,1,m,"Airbus': readers.UNCLOSED,
    'XY-E,1,"m,Airbus': readers.UNCLOSED,
}
SOUND = ['XY-F,1,"a ""quoted"" m",Airbus', "XY-G,,,", " XY-H ,1,m,B", '"XY,I",1,m,B']


def aircraft_file(folder, lines):
    header = AIRCRAFT_CSV.splitlines()[0]
    (folder / readers.AIRCRAFT_FILES[0]).write_text("\n".join([header, *lines, "", "  "]))


def test_broken_lookup_lines_are_set_aside(spark, lookups, tmp_path):
    aircraft_file(lookups, [*SOUND, *BROKEN])
    found = readers.read_lookup_lines(spark, str(lookups / readers.AIRCRAFT_FILES[0]), readers.AIRCRAFT_COLUMNS)
    assert {r.line: r.reason for r in found.broken.collect()} == BROKEN
    assert sorted(map(tuple, found.rows.collect())) == sorted(
        [("XY-F", 'a "quoted" m', "Airbus"), ("XY-G", "", ""), (" XY-H ", "m", "B"), ("XY,I", "m", "B")]
    )


@pytest.mark.parametrize("line", BROKEN)
def test_a_broken_lookup_line_fails_the_read(spark, lookups, line):
    aircraft_file(lookups, [*SOUND, line])
    with pytest.raises(Exception, match="malformed line"):
        readers.read_aircrafts(spark, str(lookups)).collect()


def test_a_lookup_without_a_column(spark, lookups):
    (lookups / readers.AIRCRAFT_FILES[0]).write_text("aircraft_reg_code,aircraft_model\nXY-A,m\n")
    with pytest.raises(ValueError, match="aircraft_manufacturer"):
        readers.read_aircrafts(spark, str(lookups))


def test_a_folder_of_lookup_files_has_a_header_in_each(spark, tmp_path):
    folder = tmp_path / readers.PERSONNEL_FILE
    spark.createDataFrame([(str(i), "CGN") for i in range(9)], "reporteurid string, airport string").repartition(4).write.csv(str(folder), header=True)
    assert sorted(r.reporteurid for r in readers.read_personnel(spark, str(tmp_path)).collect()) == list("012345678")


def test_broken_lines_option(spark, make, lookups, tmp_path):
    aircraft_file(lookups, [*SOUND, *BROKEN])
    for name, df in (("f", make.flights([])), ("m", make.maintenance([])), ("r", make.reports([]))):
        df.write.parquet(str(tmp_path / name))
    tables = [TableSource(str(tmp_path / n)) for n in "fmr"]
    found = read_sources(spark, SourceConfig(*tables, str(lookups), "set_aside"))
    assert found["broken_lines"].count() == 4 and found["aircrafts"].count() == 4 and found["personnel"].count() == 2
    assert "broken_lines" not in read_sources(spark, SourceConfig(*tables, str(lookups)))
    with pytest.raises(ValueError, match="broken_lines"):
        read_sources(spark, SourceConfig(*tables, str(lookups), "ignore"))
