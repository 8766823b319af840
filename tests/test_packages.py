"""Reading packages, rule by rule."""

import copy
import math

import pytest
from packages import COUNTS, ENTRY, ITEM, RADIANCE, SESSION, write_package

from rasterloom.plans import radiance
from rasterloom.sources import package as source


def changed(document, **changes):
    found = copy.deepcopy(document)
    for path, value in changes.items():
        *parents, last = path.split("__")
        at = found
        for p in parents:
            at = at[p]
        if value is KeyError:
            del at[last]
        else:
            at[last] = value
    return found


def test_scene_and_bands(spark, tmp_path):
    p = source.read_packages(spark, write_package(tmp_path / "p"))
    scene = p.scenes.first()
    assert (scene["scene_id"], scene["acquired_at"], scene["start_ms"], scene["offset_s"]) == ("SCENE_7", "1970-01-01T00:00:01Z", 1000.0, 0.0)
    assert '"count": 2' in scene["metadata"]["Scenes"] and scene["metadata"]["Operator"] == "none"
    assert scene["ancillary"] == '{"orbit": 7}'
    (band,) = p.bands.collect()
    assert (band["band"], band["band_id"], band["cwl_nm"], band["width"], band["height"], band["dtype"], band["nodata"], band["tdi"]) == ("R", 0, 665.0, 3, 4, "uint16", 0.0, 4)
    assert [(r["y"], r["sample_line"]) for r in p.samples.orderBy("ord").collect()] == [(0.0, 0.0), (3.0, 3.0)]
    assert p.unmatched.count() == 0


def test_many_packages_are_one_read(spark, tmp_path):
    for i in range(3):
        write_package(tmp_path / f"p{i}", item=changed(ITEM, id=f"S{i}"))
    p = source.read_packages(spark, str(tmp_path))
    assert sorted(r["scene_id"] for r in p.scenes.collect()) == ["S0", "S1", "S2"]
    assert p.bands.count() == 3
    contexts = radiance.band_contexts(p)
    paths = [r["path"] for r in p.bands.collect()]
    lines = radiance.radiance_lines(spark, contexts, paths)
    assert lines.select("package").distinct().count() == 3
    assert {tuple(r["radiance"]) for r in lines.collect()} == {tuple(map(float, r)) for r in RADIANCE}


def test_no_item_falls_back_to_files(spark, tmp_path):
    p = source.read_packages(spark, write_package(tmp_path / "p", item="{not json"))
    scene = p.scenes.first()
    assert (scene["scene_id"], scene["acquired_at"]) == ("unknown", None)
    assert [r["band"] for r in p.bands.collect()] == ["R"]
    assert p.samples.where("sample_line is not null").count() == 0


def test_unmatched_band_is_reported(spark, tmp_path):
    p = source.read_packages(spark, write_package(tmp_path / "p", item=None, rasters={"R": COUNTS, "X": COUNTS}))
    assert [r["band"] for r in p.unmatched.collect()] == ["X"]
    assert [r["band"] for r in p.bands.collect()] == ["R"]


@pytest.mark.parametrize(
    ("changes", "timed"),
    [
        ({}, True),
        ({"TimeSync": [{"PPS": 1}]}, False),
        ({"TimeSync": KeyError}, False),
        ({"ImagerConfiguration__LinePeriod": 0}, False),
        ({"ImagerTelemetry": [{"SensorTemperature": -1.0}, {"ImagerTime": 9, "SensorTemperature": 2.0}]}, False),
    ],
)
def test_timing(spark, tmp_path, changes, timed):
    p = source.read_packages(spark, write_package(tmp_path / "p", session=changed(SESSION, **changes)))
    found = p.samples.collect()
    assert len(found) == 2 and all((r["sample_line"] is not None) == timed for r in found)


def test_present_null_temperature_is_kept(spark, tmp_path):
    telemetry = [{"ImagerTime": 1, "SensorTemperature": None}, {"ImagerTime": 2}]
    p = source.read_packages(spark, write_package(tmp_path / "p", session=changed(SESSION, ImagerTelemetry=telemetry)))
    (row,) = p.samples.collect()
    assert math.isnan(row["y"])


def test_offset_and_start(spark, tmp_path):
    item = changed(ITEM, properties={"start_datetime": "1970-01-01T00:00:02", "a:time_sync_offset": "-0.5", "b:time_sync_offset": "9"})
    scene = source.read_packages(spark, write_package(tmp_path / "p", item=item)).scenes.first()
    assert (scene["start_ms"], scene["offset_s"]) == (2000.0, -0.5)
    item = changed(ITEM, properties={"datetime": "not-a-date", "time_sync_offset": "junk"})
    scene = source.read_packages(spark, write_package(tmp_path / "q", item=item)).scenes.first()
    assert (scene["start_ms"], scene["offset_s"]) == (None, 0.0)


def test_first_entry_calibrates_last_uuid_is_named(spark, tmp_path):
    entries = [ENTRY, dict(ENTRY, absolute=9.0, UUID="second"), dict(ENTRY, tdi=8, UUID="last")]
    p = source.read_packages(spark, write_package(tmp_path / "p", entries=entries))
    from rasterloom.operators import calibration

    assert radiance.band_contexts(p).first()["absolute"] == 2.0
    assert calibration.last_uuids(p.entries, ["band"]).first()["uuid"] == "last"


@pytest.mark.parametrize("offset", [None, KeyError])
def test_missing_offset_is_zero(spark, tmp_path, offset):
    p = source.read_packages(spark, write_package(tmp_path / "p", entries=[changed(ENTRY, absolute_offset=offset)]))
    assert p.entries.first()["absolute_offset"] == 0.0


def test_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        source.read_packages(spark, str(tmp_path / "absent"))
    with pytest.raises(FileNotFoundError):
        source.read_packages(spark, write_package(tmp_path / "a", entries=None))
    with pytest.raises(Exception, match="Sessions"):
        source.read_packages(spark, write_package(tmp_path / "b", session=None)).scenes.collect()
    with pytest.raises(Exception, match="no calibration entry"):
        radiance.band_contexts(source.read_packages(spark, write_package(tmp_path / "c", entries=[dict(ENTRY, tdi=8)]))).collect()
    with pytest.raises(Exception, match="configuration key"):
        source.read_packages(spark, write_package(tmp_path / "d", session=changed(SESSION, ImagerConfiguration__BandCWL=KeyError))).scenes.collect()
    with pytest.raises(Exception):  # a malformed calibration document
        (tmp_path / "a" / "calibration" / "CPF_1.json").write_text("{")
        source.read_packages(spark, str(tmp_path / "a")).entries.collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        source.read_packages(spark, write_package(tmp_path / "e", entries=[dict(ENTRY, absolute_offset="x")])).entries.collect()


def test_short_wavelength_list_is_nan(spark, tmp_path):
    p = source.read_packages(spark, write_package(tmp_path / "p", session=changed(SESSION, ImagerConfiguration__BandCWL=[])))
    assert math.isnan(p.bands.first()["cwl_nm"])
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        source.read_packages(spark, write_package(tmp_path / "q", session=changed(SESSION, ImagerConfiguration__BandSetup=[]))).bands.collect()


def test_nearest_calibration(spark, tmp_path):
    p = source.read_packages(spark, write_package(tmp_path / "p", entries=[dict(ENTRY, tdi=9, absolute=1.0), dict(ENTRY, tdi=3, absolute=7.0)]))
    assert radiance.band_contexts(p, radiance.Options(nearest_calibration=True)).first()["absolute"] == 7.0
