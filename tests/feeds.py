"""Builders of landing files for tests (invented values).

Price files cover a *local* (Europe/Stockholm) day with offset timestamps,
as the price feed does; weather files cover a UTC day with offset-less
times, as the weather feed does.  Both are named ``{yyyy}/{mm-dd}_{region}.json``.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from zoneinfo import ZoneInfo

STOCKHOLM = ZoneInfo("Europe/Stockholm")
UTC = dt.timezone.utc
REGIONS = ["SE1", "SE2", "SE3", "SE4"]


def _path(root: str, day: dt.date, region: str) -> str:
    d = os.path.join(root, f"{day:%Y}")
    os.makedirs(d, exist_ok=True)
    return os.path.join(d, f"{day:%m-%d}_{region}.json")


def local_day_starts(day: dt.date, step_minutes: int = 60) -> list[dt.datetime]:
    """Aware local start times of every interval of a local day (23, 24 or 25
    hours long)."""
    start = dt.datetime(day.year, day.month, day.day, tzinfo=STOCKHOLM).astimezone(UTC)
    nxt = day + dt.timedelta(days=1)
    end = dt.datetime(nxt.year, nxt.month, nxt.day, tzinfo=STOCKHOLM).astimezone(UTC)
    out, t = [], start
    while t < end:
        out.append(t.astimezone(STOCKHOLM))
        t += dt.timedelta(minutes=step_minutes)
    return out


def price_value(region: str, t: dt.datetime) -> float:
    return round(0.5 + REGIONS.index(region) * 0.1 + t.astimezone(UTC).hour / 100, 4) \
        if region in REGIONS else 1.0


def price_records(day: dt.date, region: str, step_minutes: int = 60, value=price_value,
                  exr: float = 11.5) -> list[dict]:
    recs = []
    for t in local_day_starts(day, step_minutes):
        end = (t.astimezone(UTC) + dt.timedelta(minutes=step_minutes)).astimezone(STOCKHOLM)
        eur = value(region, t)
        recs.append({"SEK_per_kWh": round(eur * exr, 6), "EUR_per_kWh": eur, "EXR": exr,
                     "time_start": t.isoformat(timespec="seconds"),
                     "time_end": end.isoformat(timespec="seconds")})
    return recs


def write_price_file(root: str, day: dt.date, region: str, records: list[dict]) -> str:
    p = _path(root, day, region)
    with open(p, "w") as f:
        json.dump(records, f)
    return p


def weather_payload(day: dt.date, region: str, drop_hours: set[int] = frozenset(),
                    short: dict[str, int] | None = None) -> dict:
    hours = [h for h in range(24) if h not in drop_hours]
    base = REGIONS.index(region) if region in REGIONS else 9
    hourly = {
        "time": [f"{day.isoformat()}T{h:02d}:00" for h in hours],
        "temperature_2m": [round(-5.0 + base + h * 0.5, 2) for h in hours],
        "relative_humidity_2m": [80 + (h % 5) for h in hours],
        "precipitation": [0.1 * (h % 3) for h in hours],
        "wind_speed_10m": [3.0 + h % 4 for h in hours],
        "weather_code": [h % 4 for h in hours],
    }
    for name, n in (short or {}).items():
        hourly[name] = hourly[name][:n]
    return {"latitude": 60.0, "longitude": 18.0, "hourly": hourly}


def write_weather_file(root: str, day: dt.date, region: str, payload: dict) -> str:
    p = _path(root, day, region)
    with open(p, "w") as f:
        json.dump(payload, f)
    return p


def write_feeds(price_root: str, weather_root: str, days: list[dt.date],
                regions: list[str] = REGIONS, step_minutes: int = 60) -> None:
    """Prices for the local days around ``days`` (so they cover the UTC days
    fully) and weather for exactly the UTC ``days``."""
    price_days = sorted({d + dt.timedelta(days=k) for d in days for k in (-1, 0, 1)})
    for r in regions:
        for d in price_days:
            write_price_file(price_root, d, r, price_records(d, r, step_minutes))
        for d in days:
            write_weather_file(weather_root, d, r, weather_payload(d, r))


def days(start: str, n: int) -> list[dt.date]:
    d0 = dt.date.fromisoformat(start)
    return [d0 + dt.timedelta(days=i) for i in range(n)]
