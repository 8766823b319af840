"""Small synthetic packages."""

import json
import os
import struct

import numpy as np

ITEM = {
    "stac_version": "1.1.0",
    "id": "SCENE_7",
    "properties": {"start_datetime": "", "datetime": "1970-01-01T00:00:01Z", "vendor:time_sync_offset": "0"},
    "assets": {"R": {"href": "R.tif", "type": "image/TIFF; application=geotiff"}, "raw": {"href": "raw.tif", "type": "image/tiff"}, "thumb": {"href": "t.png", "type": "image/png"}},
}
SESSION = {
    "ImagerConfiguration": {"LinePeriod": 500, "SpectralBands": 1, "BandSetup": [4], "BandStartRow": [0], "BandCWL": [665.0], "ScanDirection": 1, "BinningFactor": 0},
    "ImagerTelemetry": [{"ImagerTime": 1_000_000, "SensorTemperature": 0.0}, {"Other": 1}, {"ImagerTime": 1_001_500, "SensorTemperature": 3.0}],
    "TimeSync": [{"PPS": 5}, {"TimeFormat": 1, "ImagerTime": 1_000_000, "PlatformTime": 1000}, {"TimeFormat": 1, "ImagerTime": 9, "PlatformTime": 9}],
    "Scenes": {"a": {"x": 1}, "b": {"x": 2}},
    "Operator": "none",
}
ENTRY = {"band": "R", "row": 0, "tdi": 4, "absolute": 2.0, "absolute_offset": 100.0, "coefficients": [[1, 2, 0.5], [10, 0, 4], [1, 0, 2]], "UUID": "first"}
FILTERS = [{"name": "R", "id": 5}, {"name": "R", "id": "0"}]
COUNTS = np.array([[100, 100, 100], [200, 150, 120], [300, 250, 130], [400, 350, 140]], dtype="<u2")
RADIANCE = np.array([[280, 500, 196], [478, 700, 214], [676, 1100, 222], [874, 1500, 230]], dtype=np.float32)


def strip_tiff(values, nodata=None):
    """An uncompressed little-endian TIFF in strips of two lines."""
    height, width = values.shape
    strips = [values[i : i + 2].tobytes() for i in range(0, height, 2)]
    entries = [(256, 4, [width]), (257, 4, [height]), (258, 3, [values.dtype.itemsize * 8]), (259, 3, [1]), (278, 3, [2]), (339, 3, [{"u": 1, "f": 3}[values.dtype.kind]])]
    head = 8 + 2 + 12 * (len(entries) + 2 + (nodata is not None)) + 4
    tables = head + 8 * len(strips)
    value = "" if nodata is None else f"{nodata:.4f}"  # long enough to be kept outside its entry
    text = b"" if nodata is None else f"{value}\0".encode().ljust(8, b"\0")
    offsets = [tables + len(text) + sum(map(len, strips[:i])) for i in range(len(strips))]
    rows = [struct.pack("<HHII", t, k, 1, v[0]) for t, k, v in entries]
    one = len(strips) == 1
    rows += [struct.pack("<HHII", 273, 4, len(strips), offsets[0] if one else head), struct.pack("<HHII", 279, 4, len(strips), len(strips[0]) if one else head + 4 * len(strips))]
    if nodata is not None:
        rows.append(struct.pack("<HHII", 42113, 2, len(value) + 1, tables))
    rows.sort(key=lambda r: struct.unpack("<H", r[:2])[0])
    body = struct.pack(f"<{len(strips)}I", *offsets) + struct.pack(f"<{len(strips)}I", *map(len, strips))
    return struct.pack("<2sHIH", b"II", 42, 8, len(rows)) + b"".join(rows) + struct.pack("<I", 0) + body + text + b"".join(strips)


def write_package(folder, *, item=ITEM, session=SESSION, entries=(ENTRY,), filters=FILTERS, rasters=None, nodata=0):
    os.makedirs(f"{folder}/calibration", exist_ok=True)
    put = lambda name, doc: open(f"{folder}/{name}", "w").write(doc if isinstance(doc, str) else json.dumps(doc))  # noqa: E731,SIM115
    if item is not None:
        put("item.json", item)
    if session is not None:
        put("metadata.json", {"Sessions": {"z": session, "a": {}}})
    put("ancillary.json", {"orbit": 7})
    if entries is not None:
        put("calibration/CPF_1.json", {"radiometric": list(entries), "geometric": {"k": 1}})
    put("calibration/filters_1.json", filters)
    for name, values in (rasters or {"R": COUNTS}).items():
        with open(f"{folder}/{name}.tif", "wb") as f:
            f.write(strip_tiff(values, nodata))
    return str(folder)
