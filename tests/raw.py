"""Generated raw files for tests of the file side."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import zstandard

from wakeline.schema import LEGACY_NAMES

MODERN = (
    "mmsi,base_date_time,longitude,latitude,sog,cog,heading,vessel_name,imo,call_sign,"
    "vessel_type,status,length,width,draft,cargo,transceiver"
)
LEGACY = ",".join(LEGACY_NAMES)  # latitude before longitude


def day_rows(date: str, vessels: int = 12, step_minutes: int = 10, seed: int = 7) -> list[dict]:
    rng = random.Random(f"{date}{seed}")
    start = dt.datetime.fromisoformat(date)
    rows = []
    for v in range(vessels):
        mmsi = 366000000 + v
        for i in range(0, 24 * 60, step_minutes):
            time = start + dt.timedelta(minutes=i, seconds=v)
            quiet = v % 4 == 1 and 300 < i < 700  # a pause that ends a voyage
            if quiet:
                continue
            rows.append(
                {
                    "mmsi": mmsi,
                    "base_date_time": time.isoformat(),
                    "longitude": round(-90 + v + i / 1000, 5),
                    "latitude": round(25 + v / 10 + i / 2000, 5),
                    "sog": "" if i % 70 == 0 else round(rng.uniform(0, 15), 1),
                    "cog": round(rng.uniform(0, 360), 1),
                    "heading": float(rng.randrange(360)),
                    "vessel_name": f"SHIP {v}",
                    "imo": f"IMO{9000000 + v}",
                    "call_sign": f"WD{v}",
                    "vessel_type": f"{70 + v % 3}.0",
                    "status": i % 3,
                    "length": 100.0 + v,
                    "width": 20.0,
                    "draft": 7.5,
                    "cargo": 70,
                    "transceiver": "A",
                }
            )
    return rows


def write_day(folder: Path, date: str, rows: list[dict], legacy: bool = False,
              name: str | None = None, extra_lines: list[str] = ()) -> Path:
    header = LEGACY if legacy else MODERN
    names = [LEGACY_NAMES.get(h, h) for h in header.split(",")]
    lines = [header, *[",".join(str(r[n]) for n in names) for r in rows], *extra_lines]
    text = ("\n".join(lines) + "\n").encode()
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / (name or f"ais-{date}.csv.zst")
    path.write_bytes(zstandard.ZstdCompressor().compress(text))
    return path
