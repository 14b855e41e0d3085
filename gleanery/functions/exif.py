"""The scalar EXIF fields of JPEG files."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of tags; others keep their number.
TAGS = {
    256: "ImageWidth", 257: "ImageLength", 270: "ImageDescription", 271: "Make", 272: "Model", 274: "Orientation", 296: "ResolutionUnit", 305: "Software",
    306: "DateTime", 315: "Artist", 531: "YCbCrPositioning", 33432: "Copyright", 34665: "ExifOffset", 34853: "GPSInfo",
}


def scalars(content: bytes | None) -> dict[str, str]:
    """Texts and single whole numbers of the first directory; none if there is no readable EXIF."""
    data = content or b""
    at = 2
    try:
        if data[:2] != b"\xff\xd8":
            return {}
        while data[at] == 0xFF and data[at + 1] != 0xDA:
            size = struct.unpack(">H", data[at + 2 : at + 4])[0]
            if data[at + 1] == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
                return _directory(data[at + 10 : at + 2 + size])
            at += 2 + size
    except (IndexError, struct.error):
        pass
    return {}


def _directory(tiff: bytes) -> dict[str, str]:
    order = {b"II": "<", b"MM": ">"}.get(tiff[:2])
    if not order:
        return {}
    start = struct.unpack(order + "I", tiff[4:8])[0]
    out = {}
    for k in range(struct.unpack(order + "H", tiff[start : start + 2])[0]):
        tag, kind, n = struct.unpack(order + "HHI", tiff[start + 2 + 12 * k : start + 10 + 12 * k])
        value = tiff[start + 10 + 12 * k : start + 14 + 12 * k]
        name = TAGS.get(tag, str(tag))
        if kind == 2:
            where = struct.unpack(order + "I", value)[0]
            out[name] = (value[:n] if n <= 4 else tiff[where : where + n]).split(b"\0")[0].decode("latin-1")
        elif kind in (3, 4) and n == 1:
            out[name] = str(struct.unpack(order + ("H" if kind == 3 else "I"), value[: 2 if kind == 3 else 4])[0])
    return out


def exif(content: Column) -> Column:
    """A map of the scalar fields of each file."""

    def run(files: pd.Series) -> pd.Series:
        return files.map(scalars)

    return F.pandas_udf(run, "map<string,string>")(content)
