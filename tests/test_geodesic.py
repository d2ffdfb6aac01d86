"""Geodesics: published pairs, and that the direct problem leads back."""

import numpy as np
import pytest

from galetrack.functions import geodesy, sql

#: Published distances in m from (0, 0), near-antipodal ones and half a meridian.
PUBLISHED = {(179.5, 0.5): 19936288.579, (179.7, 0.5): 19944127.421, (180.0, 0.0): 20003931.4586, (10.0, 0.0): 1113194.9079}


def test_published_pairs():
    for (lon, lat), metres in PUBLISHED.items():
        km, _ = geodesy.inverse(*[np.array([v]) for v in (0.0, 0.0, lon, lat)], 12)
        assert km[0] * 1000 == pytest.approx(metres, abs=1e-3)


@pytest.mark.parametrize("near", [True, False])
def test_there_and_back(near):
    rng, n = np.random.default_rng(4), 5000
    lon1, lat1 = rng.uniform(-180, 180, n), rng.uniform(-89, 89, n)
    lat2 = np.clip(-lat1 + rng.uniform(-1.5, 1.5, n), -89.9, 89.9) if near else rng.uniform(-89, 89, n)
    lon2 = (lon1 + 180 + rng.uniform(-2, 2, n) + 180) % 360 - 180 if near else rng.uniform(-180, 180, n)
    km, az = geodesy.inverse(lon1, lat1, lon2, lat2, 12)
    x, y = geodesy.direct(lon1, lat1, az, km, 12)
    assert np.isfinite(km).all() and (geodesy.inverse(x, y, lon2, lat2, 12)[0] < 1e-6).all()
    back, _ = geodesy.inverse(lon2, lat2, lon1, lat1, 12)
    assert back == pytest.approx(km, abs=1e-6)


def test_short_and_equal_pairs():
    km, _ = geodesy.inverse(np.array([5.0, 5.0, 0.0]), np.array([5.0, 5.0, 90.0]), np.array([5.0, 5.00001, 77.0]), np.array([5.0, 5.0, 90.0]), 6)
    assert km[0] == 0 and 0.0010 < km[1] < 0.0012 and km[2] == pytest.approx(0, abs=1e-6)


def test_functions_from_sql(spark):
    names = sql.register(spark)
    assert {"gale_category", "gale_along"} <= set(names)
    row = spark.sql("select gale_category(96) as a, gale_category(null) as b, gale_class('EX', 90) as c, gale_class('HU', null) as d, gale_decade(1999) as e, gale_arc_km(0, 0, 0, 90) as f").first()
    assert (row["a"], row["b"], row["e"]) == ("3", "UNK", 1990) and row["f"] == pytest.approx(10007.557, abs=1e-3)
    over = spark.sql("select j, lon from gale_along(179.0D, 0.0D, -179.0D, 0.0D, 60.0D) order by j").collect()
    assert [round(r["lon"], 6) for r in over] == [179.0, 179.5, 180.0, -179.5, -179.0]
