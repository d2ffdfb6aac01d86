"""Geodesics on WGS-84, and the projection for areas.

The inverse and direct problems follow Vincenty's published series with a fixed
number of iterations. As column expressions they are some hundred nested terms,
which take Catalyst seconds to analyse for each use; so they are Arrow-batched
NumPy kernels. Pairs for which the iteration doesn't settle, near-antipodal ones, are
solved for the azimuth at one end, by Newton's steps within a bracket.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galetrack.functions.workers import importable

# WGS-84 and the authalic sphere.
A = 6378137.0
FLATTENING = 1 / 298.257223563
B = A * (1 - FLATTENING)
E2 = FLATTENING * (2 - FLATTENING)
MEAN_RADIUS_KM = 6371.0088


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return F.lit(2 * MEAN_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def _series(ca2):
    """The series' two coefficients from the squared cosine of the equatorial azimuth."""
    k = ca2 * ((A * A - B * B) / (B * B))
    return 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))), k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))


def _delta(small, ss, cs, m):
    return small * ss * (m + small / 4 * (cs * (-1 + 2 * m * m) - small / 6 * m * (-3 + 4 * ss * ss) * (-3 + 4 * m * m)))


def _longitude_term(ca2, sa, sig, ss, cs, m):
    c = FLATTENING / 16 * ca2 * (4 + FLATTENING * (4 - 3 * ca2))
    return (1 - c) * FLATTENING * sa * (sig + c * ss * (m + c * cs * (-1 + 2 * m * m)))


def inverse(lon1, lat1, lon2, lat2, iterations: int = 6):
    """Distances in km and forward azimuths in radians of arrays of positions."""
    u1, u2 = (np.arctan((1 - FLATTENING) * np.tan(np.radians(lat))) for lat in (lat1, lat2))
    span = np.radians(np.mod(lon2 - lon1 + 180, 360) - 180)
    s1, c1, s2, c2, lam = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2), span
    for _ in range(iterations):
        before = lam
        sl, cl = np.sin(lam), np.cos(lam)
        ss = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
        cs = s1 * s2 + c1 * c2 * cl
        sig = np.arctan2(ss, cs)
        sa = np.where(ss == 0, 0, c1 * c2 * sl / np.where(ss == 0, 1, ss))
        ca2 = 1 - sa * sa
        m = np.where(ca2 == 0, 0, cs - 2 * s1 * s2 / np.where(ca2 == 0, 1, ca2))
        lam = span + _longitude_term(ca2, sa, sig, ss, cs, m)
    big, small = _series(ca2)
    km, az = B / 1000 * big * (sig - _delta(small, ss, cs, m)), np.arctan2(c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam))
    open_ = np.flatnonzero((np.abs(lam - before) > 1e-11) | (np.abs(lam) > np.pi))
    if len(open_):
        km, az = np.array(km, dtype=float), np.array(az, dtype=float)
        km[open_], az[open_] = _by_azimuth(*(np.broadcast_to(a, km.shape)[open_] for a in (u1, u2, span)))
    return km, az


def _by_azimuth(u1, u2, span, steps: int = 80):
    """Distances and forward azimuths of pairs by the azimuth at one end.

    The pair is turned so that the first point is the one farther from the equator, in
    the south, and the other lies east; then the longitude that an azimuth reaches rises
    with it from 0 to half a turn, so each step keeps a bracket.
    """
    swap = np.abs(u1) < np.abs(u2)
    first, second = np.where(swap, u2, u1), np.where(swap, u1, u2)
    north, east = first > 0, span >= 0
    b1, b2 = np.minimum(np.where(north, -first, first), -1e-14), np.where(north, -second, second)
    lon, s1, c1, s2, c2 = np.abs(span), np.sin(b1), np.cos(b1), np.sin(b2), np.cos(b2)

    def reached(a):
        sa = np.sin(a) * c1
        to = np.sqrt(np.maximum(0.0, (np.cos(a) * c1) ** 2 + (c2 - c1) * (c2 + c1))) / c2
        g1, g2 = np.arctan2(s1, np.cos(a) * c1), np.arctan2(s2, to * c2)
        ca2, sig = 1 - sa * sa, np.mod(g2 - g1, 2 * np.pi)
        turn = np.arctan2(sa * np.sin(g2), np.cos(g2)) - np.arctan2(sa * np.sin(g1), np.cos(g1))
        m = np.cos(g1 + g2)
        return turn - _longitude_term(ca2, sa, sig, np.sin(sig), np.cos(sig), m), ca2, sig, m, sa / c2, to

    low, high = np.zeros(len(lon)), np.full(len(lon), np.pi)
    a = np.full(len(lon), np.pi / 2)
    for _ in range(steps):
        off = reached(a)[0] - lon
        low, high = np.where(off < 0, a, low), np.where(off < 0, high, a)
        slope = (reached(a + 1e-7)[0] - reached(a - 1e-7)[0]) / 2e-7
        newton = a - off / np.where(slope == 0, np.inf, slope)
        a = np.where((newton > low) & (newton < high) & (np.abs(off) < 0.1), newton, (low + high) / 2)
    _, ca2, sig, m, sa2, to = reached(a)
    big, small = _series(ca2)
    km = B / 1000 * big * (sig - _delta(small, np.sin(sig), np.cos(sig), m))
    x, y = np.where(swap, sa2, np.sin(a)), np.where(swap, to, np.cos(a))
    return km, np.arctan2(x * np.where(east, 1.0, -1.0), y * np.where(swap == north, 1.0, -1.0))


def direct(lon, lat, azimuth, km, iterations: int = 6):
    """Positions at distances along azimuths (radians)."""
    u = np.arctan((1 - FLATTENING) * np.tan(np.radians(lat)))
    sa1, ca1, su, cu = np.sin(azimuth), np.cos(azimuth), np.sin(u), np.cos(u)
    s1, sa = np.arctan2(np.tan(u), ca1), cu * sa1
    ca2 = 1 - sa * sa
    big, small = _series(ca2)
    base = km * 1000 / B / big
    sig = base
    for _ in range(iterations):
        sig = base + _delta(small, np.sin(sig), np.cos(sig), np.cos(2 * s1 + sig))
    ss, cs, m = np.sin(sig), np.cos(sig), np.cos(2 * s1 + sig)
    x = su * ss - cu * cs * ca1
    lat2 = np.arctan2(su * cs + cu * ss * ca1, (1 - FLATTENING) * np.sqrt(sa * sa + x * x))
    lam = np.arctan2(ss * sa1, cu * cs - su * ss * ca1) - _longitude_term(ca2, sa, sig, ss, cs, m)
    return np.mod(lon + np.degrees(lam) + 540, 360) - 180, np.degrees(lat2)


def with_geodesic(df: DataFrame, out: str, lon1: str, lat1: str, lon2: str, lat2: str, iterations: int = 6, azimuth: str | None = None) -> DataFrame:
    """``df`` with the geodesic distance in km, and the forward azimuth in radians."""
    importable(df.sparkSession)

    @F.pandas_udf("struct<km: double, az: double>")
    def measured(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
        km, az = inverse(*[s.to_numpy(float) for s in (a, b, c, d)], iterations)
        return pd.DataFrame({"km": km, "az": az})

    outs = {out: "km"} | ({azimuth: "az"} if azimuth else {})
    known = F.col(lon1).isNotNull() & F.col(lat1).isNotNull() & F.col(lon2).isNotNull() & F.col(lat2).isNotNull()
    rows = df.withColumn("__geodesic", measured(lon1, lat1, lon2, lat2))
    return rows.select(*[c for c in df.columns if c not in outs], *[F.when(known, F.col(f"__geodesic.{f}")).alias(n) for n, f in outs.items()])


def with_destination(df: DataFrame, lon_out: str, lat_out: str, lon: str, lat: str, azimuth: str, km: str, iterations: int = 6) -> DataFrame:
    """``df`` with the point at a distance along an azimuth (radians)."""
    importable(df.sparkSession)

    @F.pandas_udf("struct<x: double, y: double>")
    def moved(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
        x, y = direct(*[s.to_numpy(float) for s in (a, b, c, d)], iterations)
        return pd.DataFrame({"x": x, "y": y})

    rows = df.withColumn("__moved", moved(lon, lat, azimuth, km))
    return rows.select(*[c for c in df.columns if c not in (lon_out, lat_out)], F.col("__moved.x").alias(lon_out), F.col("__moved.y").alias(lat_out))


def equal_area_x(lon: Column) -> Column:
    """Metres east in the cylindrical equal-area projection with latitude of true scale 30."""
    p = math.radians(30)
    k = math.cos(p) / math.sqrt(1 - E2 * math.sin(p) ** 2)
    return F.radians(lon) * F.lit(A * k)


def equal_area_y(lat: Column) -> Column:
    """Metres north in the same projection."""
    p = math.radians(30)
    k = math.cos(p) / math.sqrt(1 - E2 * math.sin(p) ** 2)
    e, s = math.sqrt(E2), F.sin(F.radians(lat))
    q = F.lit(1 - E2) * (s / (F.lit(1.0) - F.lit(E2) * s * s) - F.lit(1 / (2 * e)) * F.log((F.lit(1.0) - F.lit(e) * s) / (F.lit(1.0) + F.lit(e) * s)))
    return q * F.lit(A / (2 * k))
