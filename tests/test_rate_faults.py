"""Faulty rate payloads are kept apart, and no good rate is lost over them."""

import datetime as dt

import pytest

from tallybook.plans.curate import rescue_landed_rates
from tallybook.plans.daily import land_rate_day
from tallybook.plans.zones import Zones
from tallybook.schemas import RATE_FAULTS
from tallybook.sources import rates as rate_source

DAY = dt.date(2024, 5, 2)
GOOD = '[{"data": "02/05/2024", "valor": "0.04"}]'


def faults_of(spark, *payloads):
    frame = spark.createDataFrame([(DAY, p) for p in payloads], "date date, payload string")
    return sorted(r.reason for r in rate_source.rate_faults(frame).collect())


@pytest.mark.parametrize(("payload", "reasons"), [
    (GOOD, []), (None, []), ("", []), ("  ", []), ("[]", []), (" [ ] ", []),
    (GOOD[:-3], ["no array"]), ("null", ["no array"]), ("oops", ["no array"]), ('{"data": "02/05/2024", "valor": "0.04"}', ["no array"]),
    ("[1, null]", ["no object", "no object"]), ('["x"]', ["no object"]),
    ('[{"valor": "0.04"}]', ["no date"]), ('[{"data": "2024-05-02", "valor": "0.04"}]', ["no date"]),
    ('[{"data": "03/05/2024", "valor": "0.04"}]', ["other day"]),
    ('[{"data": "02/05/2024", "valor": "x"}]', ["no number"]), ('[{"data": "02/05/2024"}]', ["no number"]),
    (f'{GOOD[:-1]}, {{"data": "02/05/2024", "valor": ""}}]', ["no number"]),
])
def test_reasons(spark, payload, reasons):
    assert faults_of(spark, payload) == reasons


def test_a_bad_answer_keeps_the_good_one_and_is_seen(spark, tmp_path):
    zones = Zones(str(tmp_path))
    assert rate_source.read_rescued_rates(spark, zones.rescued_rates).schema == RATE_FAULTS
    land_rate_day(spark, zones, DAY, GOOD)
    land_rate_day(spark, zones, DAY, GOOD[:15])
    assert [r.valor for r in rate_source.read_landed_rates(spark, zones.raw_rates, DAY).collect()] == ["0.04"]
    (fault,) = rate_source.read_rescued_rates(spark, zones.rescued_rates).collect()
    assert (fault.date, fault.payload, fault.reason) == (DAY, GOOD[:15], "no array")
    land_rate_day(spark, zones, DAY, GOOD)
    assert rate_source.read_rescued_rates(spark, zones.rescued_rates).isEmpty()


def test_landed_files_of_others_are_looked_through(spark, tmp_path):
    zones = Zones(str(tmp_path))
    rescue_landed_rates(spark, zones, "2024-05-01", "2024-05-31")
    folder = tmp_path / "raw" / "cdi" / "data=2024-05-02"
    folder.mkdir(parents=True)
    (folder / "data.json").write_text(GOOD[:-4])
    rescue_landed_rates(spark, zones, "2024-05-01", "2024-05-31")
    assert [(r.date, r.reason) for r in rate_source.read_rescued_rates(spark, zones.rescued_rates).collect()] == [(DAY, "no array")]
