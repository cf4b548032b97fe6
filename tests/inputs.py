"""Small raw files: a month of eleven rides, two zones, a month of weather."""
from __future__ import annotations

import calendar
import hashlib
import io
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

RIDES = 11
MINUTE = timedelta(minutes=1)

# Column, type and usual value of a ride that starts at noon of the
# second day; a duration stands for that moment and so much more.
USUAL = (
    ("tpep_pickup_datetime", pa.timestamp("us"), 0 * MINUTE),
    ("tpep_dropoff_datetime", pa.timestamp("us"), 15 * MINUTE),
    ("PULocationID", pa.int64(), 1),
    ("DOLocationID", pa.int64(), 2),
    ("passenger_count", pa.float64(), 1.0),
    ("trip_distance", pa.float64(), 2.5),
    ("fare_amount", pa.float64(), 15.0),
    ("tip_amount", pa.float64(), 3.0),
    ("total_amount", pa.float64(), 20.0),
    ("payment_type", pa.int64(), 1),
)

# Row, column, value that departs from the usual, and the flag it raises.
ODD = (
    (2, "fare_amount", -10.0, "negative_money"),
    (3, "passenger_count", None, "unusual_passengers"),
    (4, "tpep_dropoff_datetime", -1 * MINUTE, "reversed_timestamp"),
    (5, "tpep_pickup_datetime", None, "missing_timestamp"),
    (6, "PULocationID", 999, "unknown_zone"),
    (7, "trip_distance", -1.0, "invalid_distance"),
    (8, "total_amount", float("nan"), "invalid_money"),
    (9, "tpep_pickup_datetime", timedelta(days=-10), "outside_source_month"),
    (10, "trip_distance", 0.0, "zero_distance"),
)
SCHEMA = pa.schema([(name, kind) for name, kind, _ in USUAL])


def rides(period: str, all_invalid: bool = False) -> pa.Table:
    """The rides of a month, column by column; with `all_invalid` none has a possible distance."""
    year, month = map(int, period.split("-"))
    start = datetime(year, month, 2, 12)
    columns = {name: [usual] * RIDES for name, _, usual in USUAL}
    for row, name, value, _ in ODD:
        columns[name][row] = value
    if all_invalid:
        columns["trip_distance"] = [-1.0] * RIDES
    moved = {
        name: [start + v if isinstance(v, timedelta) else v for v in values] for name, values in columns.items()}
    return pa.table(moved, schema=SCHEMA)


def write_rides(folder: Path, table: pa.Table) -> Path:
    """Different tables get different names, as registered files must not change."""
    buffer = io.BytesIO()
    pq.write_table(table, buffer)
    path = folder / f"rides-{hashlib.md5(buffer.getvalue()).hexdigest()}.parquet"
    path.write_bytes(buffer.getvalue())
    return path


def write_zones(folder: Path, rows=((1, "Manhattan", "Example A", "Yellow"),
                                    (2, "Queens", "Example B", "Yellow"))) -> Path:
    path = folder / "zones.csv"
    header = ("LocationID", "Borough", "Zone", "service_zone")
    path.write_text("".join(",".join(map(str, line)) + "\n" for line in (header, *rows)))
    return path


def write_weather(folder: Path, period: str, attributes: str = ",,W,", days: int | None = None,
                  station: str = "USW00094728", rain: str = "0") -> Path:
    last = calendar.monthrange(*map(int, period.split("-")))[1] if days is None else days
    path = folder / f"{period}-weather.csv"
    with path.open("w") as out:
        print("STATION,DATE,PRCP,SNOW,TMIN,TMAX,PRCP_ATTRIBUTES", file=out)
        for day in range(last):
            print(f'{station},{period}-{day + 1:02d},{rain},0,1,9,"{attributes}"', file=out)
    return path


def sha256(path) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def register_month(refresh, folder: Path, period: str = "2025-01", all_invalid: bool = False) -> None:
    """Land and register trips and weather of a month, and the zones before anything else."""
    first = refresh.ledger.rows().isEmpty()
    zones = [("zones", "zones", str(write_zones(folder)))] if first else []
    refresh.register([
        *zones, ("trips", period, str(write_rides(folder, rides(period, all_invalid)))),
        ("weather", period, str(write_weather(folder, period)))])
