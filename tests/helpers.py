"""Small readings and plain-Python answers to compare with."""

from __future__ import annotations

import datetime as dt
import random

import pyarrow as pa

from roomtrace import schema as S

DAY = dt.datetime(2019, 3, 5)
AREAS = ["armchair", "bathroom", "kitchen", "sleep"]

COLUMNS = {
    "event_id": pa.int64(),
    "house_id": pa.string(),
    "event_ts": pa.timestamp("us"),
    "id_device": pa.string(),
    "property_device": pa.string(),
    "value_property_device": pa.string(),
    "area": pa.string(),
}


def at(minute: float) -> dt.datetime:
    return DAY + dt.timedelta(minutes=minute)


def readings(spark, rows):
    """rows: (house, minute, device, property, value, area); event ids count up."""
    full = [(i, h, at(m), dev, prop, value, area) for i, (h, m, dev, prop, value, area) in enumerate(rows)]
    return table(spark, full)


def table(spark, full):
    arrays = [pa.array([r[i] for r in full], t) for i, t in enumerate(COLUMNS.values())]
    return spark.createDataFrame(pa.table(arrays, names=list(COLUMNS)))


def presence(spark, rows):
    """rows: (house, minute, device, value, area)."""
    return readings(spark, [(h, m, dev, S.PRESENCE, v, a) for h, m, dev, v, a in rows])


def random_rows(seed: int, n: int, houses: int, span: int, hot: float = 0.0):
    """Presence rows with many equal instants; a share ``hot`` of them falls on one house and minute."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        if rnd.random() < hot:
            house, minute = "h0", span // 2
        else:
            house, minute = f"h{rnd.randrange(houses)}", rnd.randrange(span)
        out.append(
            (
                i,
                house,
                at(minute),
                f"dev-{rnd.randrange(3)}",
                S.PRESENCE,
                rnd.choice(["on", "on", "off"]),
                rnd.choice(AREAS),
            )
        )
    return out


def brute_visits(full):
    out = []
    for e, h, ts, _, _, v, a in full:
        if v != "on":
            continue
        later = [(t2, d2, e2) for e2, h2, t2, d2, _, v2, a2 in full if h2 == h and a2 == a and v2 == "off" and t2 > ts]
        if later:
            t2, d2, _ = min(later)
            out.append((h, a, e, ts, t2, d2))
    return sorted(out)


def brute_movements(full):
    on = [r for r in full if r[5] == "on"]
    out = []
    for e, h, ts, _, _, _, a in on:
        later = [(t2, a2) for _, h2, t2, _, _, _, a2 in on if h2 == h and a2 != a and t2 > ts]
        if later:
            t2, a2 = min(later)
            out.append((h, e, a, a2, ts, t2))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())
