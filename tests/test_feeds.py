"""The feeds on small literal views."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.hashing import zone_free
from tidemark.operators.projection import stamp_load_id
from tidemark.plans.feeds import (
    attribute_type_feed,
    blocks_feed,
    communications_feed,
    inspections_feed,
    key_lookup_feed,
    key_value_feed,
    residents_feed,
    schemes_feed,
    survey_findings,
    survey_rows,
    units_feed,
)
from tidemark.plans.feeds.communications import current_parties
from tidemark.plans.feeds.inspections import inspections_bad_dates, HASHED
from tidemark.plans.feeds.residents import COLUMNS, DATES, residents_bad_dates
from tidemark.plans.load import incremental_load
from tidemark.sinks import PathTarget

NOW = dt.datetime(2019, 3, 15, 14, 5, 6)
STAMP = {"as_of": NOW, "creator": "tests"}


def by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def survey(spark):
    asset = spark.createDataFrame([(1, "U1"), (2, "U2"), (3, "U3")], "AssetID int, UPRN string")
    attributes = spark.createDataFrame([
        (1, 10, "Kitchen", 100, "Sink", 1, 501, "steel", dt.datetime(2010, 1, 1), "ann"),
        (1, 10, "Kitchen", 100, "Sink", 2, 502, "brass", dt.datetime(2012, 1, 1), None),
        (2, 11, "HHSRS", 101, "Risk", 3, 503, "high", None, "bob"),
        (2, 12, None, 102, "Door", 4, 504, "oak", None, "bob"),
        (9, 13, "Roof", 103, "Tile", 5, 505, "clay", None, "bob"),
    ], "AssetID int, RepairElementID int, RepairElement string, ComponentID int, Component string, AttributeID int, "
       "SurveyAttributeID int, Attribute string, InstallationDate timestamp_ntz, Surveyor string")
    repairs = spark.createDataFrame([
        (1, "Kitchen", 100, "Sink", 1, 9001, "replace", 2.0, 2025, 99.5, "zoe"),
        (3, "Roof", 103, "Tile", 2, 7, "patch", 1.0, 2021, 10.0, "zoe"),
        (3, "Portfolio Investment Opportunity", 104, "Plan", 3, 8, "sell", 1.0, 2022, 1.0, "zoe"),
        (3, "Portfolio Investment Opportunity ", 104, "Plan", 3, 8, "sell", 1.0, 2022, 1.0, "zoe"),
    ], "AssetID int, RepairElement string, ComponentID int, Component string, RepairID int, SurveyRepairID int, "
       "RepairDescription string, Quantity double, YearDue int, RepairCost double, Surveyor string")
    return asset, survey_findings(attributes, repairs)


class TestSurvey:
    def test_rows_of_known_assets_padded(self, survey):
        rows = survey_rows(*survey)
        assert rows.count() == 8
        assert len(rows.columns) == 17
        assert rows.where("SurveyRepairID IS NOT NULL AND SurveyAttributeID IS NOT NULL").isEmpty()

    def test_key_lookup(self, survey):
        feed = by(key_lookup_feed(*survey, **STAMP), "ATTRIBUTE_KEY_LOOKUP_ID")
        assert {k: r["KEY_NAME"] for k, r in feed.items()} == {
            100: "Sink", 101: "Risk", 102: "Door", 103: "Tile", 104: "Plan"
        }
        row = feed[100]
        assert (row["F_SOURCE_SYSTEM"], row["F_DATA_OWNERSHIP"], row["B_CREDATE"]) == (41, 1, NOW)
        assert row["VALID_FROM"] == dt.datetime(2019, 3, 14, 14, 5, 6)
        assert row["VALID_TO"] == dt.datetime(2027, 7, 15, 14, 5, 6)

    def test_attribute_type_leaves_repairs_out(self, survey):
        feed = by(attribute_type_feed(*survey, **STAMP), "PROP_ATTRIBUTE_TYPE_ID")
        assert {k: r["TYPE_NAME"] for k, r in feed.items()} == {"TP_10": "Kitchen", "TP_11": "HHSRS", "TP_12": None}
        assert feed["TP_10"]["F_SOURCE_SYSTEM"] == "41"

    def test_key_value(self, survey):
        feed = by(key_value_feed(*survey, **STAMP), "F_ATTRIBUTE_KEY_LOOKUP")
        # The NULL element and the excluded ones are out; blanks at the end make no difference.
        assert set(feed) == {100, 103}
        sink, tile = feed[100], feed[103]
        assert (sink["ATTRIBUTE_VALUE"], sink["ATTRIBUTE_DATE"], sink["REPLACEMENT"], sink["QUANTITY"]) == (
            "steel", dt.datetime(2012, 1, 1), "replace", 2.0
        )
        assert (sink["F_PROP_ATTRIBUTE_TYPE"], sink["SURVEYOR"], sink["DUE_DATE"]) == ("TP_10", "zoe", 2025)
        # Repairs alone have no element id, hence no type key.
        assert (tile["F_PROP_ATTRIBUTE_TYPE"], tile["ATTRIBUTE_VALUE"], tile["REPLACEMENT_COST"]) == (None, None, 10.0)
        assert (sink["PROP_ATTRIBUTE_KEY_VALUE_"], tile["PROP_ATTRIBUTE_KEY_VALUE_"]) == (1, 2)

    def test_repeated_assets_do_not_repeat_groups(self, spark, survey):
        asset, findings = survey
        twice = asset.unionByName(asset).unionByName(spark.createDataFrame([(1, "U1b")], asset.schema))
        feed = key_value_feed(twice, findings, **STAMP).collect()
        assert sorted((r["F_PROPERTY_ATTRIBUTES"], r["F_ATTRIBUTE_KEY_LOOKUP"]) for r in feed) == [
            ("U1", 100), ("U1b", 100), ("U3", 103)
        ]

    def test_number_shifts_but_natural_key_does_not(self, spark, survey):
        asset, findings = survey
        late = findings.where("AssetID = 3")
        numbers = [
            by(key_value_feed(asset, rows, **STAMP), "F_ATTRIBUTE_KEY_LOOKUP")[103]["PROP_ATTRIBUTE_KEY_VALUE_"]
            for rows in (findings, late)
        ]
        naturals = [
            by(key_value_feed(asset, rows, numbered=False, **STAMP), "F_ATTRIBUTE_KEY_LOOKUP")[103]["PROP_ATTRIBUTE_KEY_VALUE_"]
            for rows in (findings, late)
        ]
        assert numbers == [2, 1] and naturals[0] == naturals[1]


class TestResidents:
    @pytest.fixture
    def view(self, spark):
        dates = [("04-MAR-2019 02:05:06", None, "04-Mar-75 12:00:00"), ("junk", "04-MAR-2019", ""), (None, None, None)]
        df = spark.createDataFrame([(i, *d) for i, d in enumerate(dates)], ["RESIDENTS_ID", *DATES])
        others = [F.lit(c).alias(c) for c in COLUMNS if c not in (*DATES, "RESIDENTS_ID")]
        return df.select("*", *others)

    def test_dates(self, view):
        feed = residents_feed(view)
        assert feed.columns == COLUMNS and len(COLUMNS) == 25
        rows = by(feed, "RESIDENTS_ID")
        assert [rows[0][c] for c in DATES] == [dt.datetime(2019, 3, 4, 2, 5, 6), None, dt.datetime(1975, 3, 4)]
        assert [rows[1][c] for c in DATES] == [None, dt.datetime(2019, 3, 4), None]
        assert [rows[2][c] for c in DATES] == [None, None, None]

    def test_bad_dates(self, view):
        assert residents_bad_dates(view).first().asDict() == {"START_OF_TERM": 1, "END_OF_TERM": 0, "B_CREDATE": 1}
        with pytest.raises(PySparkException, match="not a date"):
            residents_feed(view, strict=True).collect()


class TestProperty:
    @pytest.fixture
    def building(self, spark):
        return spark.createDataFrame(
            [("B1", "One House", 1, 7), ("B2", "Two House", 1, None), ("B3", "Lost House", 99, 7), (None, "No Ref", 1, 8)],
            "buildingRef_ string, name_ string, area_ int, address_ int",
        )

    @pytest.fixture
    def area(self, spark):
        return spark.createDataFrame([(1, "A1", "North"), (2, None, "South")], "ID int, code_ string, name_ string")

    def test_units(self, spark, building, area):
        columns = [
            "Property Code", "Property Name", "Full Address", "Property Number", "Address Line1", "Address Line2",
            "Street", "Postcode", "Bedrooms", "Property Status", "Floor", "Comments", "Building",
        ]
        schema = ", ".join(f"`{c}` string" for c in columns)
        unit = lambda code, status, floor, house, bedrooms="2": (
            code, "Name", None, "1", "l1", "l2", "St", "PC", bedrooms, status, floor, None, house
        )
        index = spark.createDataFrame([
            unit("u1", "Available", "2/3-Mez", "One House", None), unit("u2", "On Hold ", "G ", "Two House  "),
            unit("u3", "Sold", None, "No Ref"), unit("u4", "Booked", "1", "Lost House"), unit("u5", None, "99", "Gone"),
        ], schema)
        feed = by(units_feed(index, building, area), "UNITS_ID")
        assert {k: (r["OCCUPANCY_STATUS"], r["FLOOR_LEVEL"], r["NO_OF_BEDROOMS"]) for k, r in feed.items()} == {
            "u1": ("022", "030", ""), "u2": ("024", "002", "2"), "u3": ("000", "000", "2")
        }
        assert feed["u3"]["HASH_VALUE"] == hashlib.sha1(b"NAu3NameNA1l1l2StPCNA").hexdigest()
        numbered = index.withColumn("Bedrooms", F.col("Bedrooms").cast("int"))
        assert by(units_feed(numbered, building, area), "UNITS_ID")["u1"]["NO_OF_BEDROOMS"] == 0

    def test_blocks_keep_buildings_without_address(self, spark, building, area):
        address = spark.createDataFrame(
            [(7, "l1", None, "Town", "PC")], "ID int, line1_ string, line2_ string, line3_ string, postcode_ string"
        )
        feed = by(blocks_feed(building, area, address), "BLOCKS_ID")
        assert {k: (r["F_SCHEMES"], r["GEOADDRESS1"]) for k, r in feed.items()} == {
            "B1": ("A1", "l1"), "B2": ("A1", None), None: ("A1", None)
        }

    def test_schemes(self, area):
        feed = by(schemes_feed(area, estate="E"), "SCHEME_NAME")
        assert feed["North"]["F_ESTATES"] == "E" and feed["South"]["SCHEMES_ID"] is None
        assert feed["North"]["HASH_VALUE"] != feed["South"]["HASH_VALUE"]


def test_inspections(spark):
    values = {
        "p2": {"grounds_contractor": "Just Ask  ", "grounds_team": "   ", "cleaning_contractor": "Other",
               "staff_grounds_last_date": "2019-03-04  ", "grounds_due": "  ", "cleaning_due": "soon"},
        "p1": {"grounds_contractor": None, "grounds_team": "T1 ", "cleaning_contractor": "Cleanscapes"},
    }
    rows = [(ref + "   ", *[v.get(c) for c in HASHED[1:]]) for ref, v in values.items()]
    view = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in HASHED))
    feed = by(inspections_feed(view, **STAMP), "FD_SCHEMES")
    first, second = feed["p1"], feed["p2"]
    assert (first["ESTATE_INSP_AND_CLEANING_"], second["ESTATE_INSP_AND_CLEANING_"]) == (1, 2)
    assert (first["FD_CONTRACTOR_INSP"], first["FD_CONTRACTOR_CLEANING"], first["GROUNDS_TEAM"]) == ("21", "4", "T1")
    assert (second["FD_CONTRACTOR_INSP"], second["FD_CONTRACTOR_CLEANING"], second["GROUNDS_TEAM"]) == ("1", "21", "")
    assert second["STAFF_GROUNDS_LASTDATE"] == dt.date(2019, 3, 4)
    assert {first["GROUNDS_DUE"], second["GROUNDS_DUE"]} == {dt.date(1900, 1, 1)} and second["CLEANING_DUE"] is None
    bad = inspections_bad_dates(view).first().asDict()
    assert bad.pop("cleaning_due") == 1 and set(bad.values()) == {0}
    assert first["PRIORITY"] == "" and len(feed["p1"]) == 24


def test_communications(spark):
    ts = lambda *a: dt.datetime(*a)
    contacts = spark.createDataFrame([
        (1, 11, "0123", "home", "1", "TELEPHONE"), (2, 11, "a@b", None, "2", "EMAIL"), (3, 12, "c", "n", "x", "OTHER"),
        (4, 13, "d", "n", None, None), (5, 14, "e", "n", "1", "FAX, EBILL,FACEBOOK,TWITTER"), (6, 99, "f", "n", "1", "WORK"),
    ], "cde_refno int, cde_par_refno int, cde_contact_value string, cde_contact_name string, cde_precedence string, "
       "cde_frv_cme_code string")
    parties = spark.createDataFrame([(p,) for p in (11, 12, 13, 14)], "par_refno int")
    # 11 by lease and tenancy, 12 by tenancy ending exactly now, 13 by ended ones, 14 by an open lease.
    lease_parties = spark.createDataFrame([(1, 11), (2, 13), (3, 14), (1, 99)], "lpt_las_lea_pro_refno int, lpt_par_refno int")
    assignments = spark.createDataFrame([
        (1, ts(2019, 1, 1), ts(2019, 12, 31)), (1, ts(2018, 1, 1), None), (2, ts(2018, 1, 1), ts(2019, 1, 1)),
        (3, ts(2019, 1, 1), None), (2, None, None),
    ], "las_lea_pro_refno int, las_start_date timestamp_ntz, las_end_date timestamp_ntz")
    instances = spark.createDataFrame([(1, 1), (2, 2), (2, 1)], "tin_hop_refno int, tin_tcy_refno int")
    persons = spark.createDataFrame([(1, 11), (2, 12), (3, 13)], "hop_refno int, hop_par_refno int")
    tenancies = spark.createDataFrame([(1, ts(2019, 1, 1), NOW), (2, ts(2020, 1, 1), None)],
                                      "tcy_refno int, tcy_act_start_date timestamp_ntz, tcy_act_end_date timestamp_ntz")
    current = current_parties(lease_parties, assignments, instances, persons, tenancies, as_of=NOW)
    assert sorted(r[0] for r in current.collect()) == [11, 12, 14, 99]
    feed = by(communications_feed(contacts, parties, current, **STAMP), "COMMUNICATION_ID")
    assert {k: (r["F_PERSON"], r["F_COMMUNICATION_TYPE"], r["DEFAULT_COMMUNICATION"]) for k, r in feed.items()} == {
        1: (11, "ZCM-MT1", "001"), 2: (11, "ZCM-UE1", "002"), 3: (12, "ZCM-O", "000"), 5: (14, "ZCM-O", "001"),
    }
    assert feed[2]["HASH_VALUE"] == hashlib.sha1(b"a@b00211ZCM-UE12").hexdigest()
    assert feed[1]["B_CREDATE"] == "2019-03-15 02:05:06" and feed[1]["OTHER_INFO"] is None


def test_a_session_in_another_zone_finds_nothing_new(spark, survey, tmp_path):
    """Views of instants, as files hold them: hashes, numbers and dates are those of the first session."""
    asset, findings = survey
    zone = spark.conf.get("spark.sql.session.timeZone")
    path, target = str(tmp_path / "findings"), None
    found = []
    try:
        for n, name in enumerate(("UTC", "Pacific/Auckland", "America/New_York"), start=1):
            spark.conf.set("spark.sql.session.timeZone", name)
            if n == 1:
                findings.withColumn("InstallationDate", F.col("InstallationDate").cast("timestamp")).write.parquet(path)
            instants = spark.read.parquet(path)
            assert instants.schema["InstallationDate"].dataType.simpleString() == "timestamp"
            feed = key_value_feed(asset, instants, as_of=NOW, creator="tests", numbered=False)
            target = target or PathTarget(str(tmp_path / "target"), stamp_load_id(feed, 1).schema)
            found.append(incremental_load(feed, target, keys="PROP_ATTRIBUTE_KEY_VALUE_", load_id=n).inserted)
            assert {r["ATTRIBUTE_DATE"] for r in feed.collect()} == {dt.datetime(2012, 1, 1), None}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == [2, 0, 0]


def test_frames_without_instants_are_left_as_they_are(spark):
    df = spark.range(2)
    assert zone_free(df) is df
