"""Orbit geometry as plain column expressions (whole-stage codegen, no UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with published constants: WGS-84 gravity and rotation, SI light speed.
MU = 3.986004418e14
EARTH_RATE = 7.2921150e-5
LIGHT = 299_792_458.0
EARTH_RADIUS_KM = 6371.0
RADIUS_MIN_M, RADIUS_MAX_M = 6_578_000.0, 8_378_000.0
RANGE_MIN_M, RANGE_MAX_M = 5.0e5, 6.0e6


def norm3(x: Column, y: Column, z: Column) -> Column:
    return F.sqrt(x * x + y * y + z * z)


def dot(a: tuple, b: tuple) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: tuple, b: tuple) -> tuple:
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def sma_from_mean_motion(rad_per_min: Column) -> Column:
    """Semi-major axis (m) by Kepler's third law."""
    n = rad_per_min / 60.0
    return F.pow(F.lit(MU) / (n * n), F.lit(1.0 / 3.0))


def circular_position(rad_per_min: Column, inclination: Column, node: Column, seconds: Column) -> tuple[Column, Column, Column]:
    """Position (m) on the circular orbit of a mean motion, so many seconds after the body passed the angle ``node`` in its plane."""
    a, u = sma_from_mean_motion(rad_per_min), node + rad_per_min / 60.0 * seconds
    return a * F.cos(u), a * F.sin(u) * F.cos(inclination), a * F.sin(u) * F.sin(inclination)


def altitude_km(rad_per_min: Column) -> Column:
    return sma_from_mean_motion(rad_per_min) / 1000.0 - EARTH_RADIUS_KM


def angle_delta(after: Column, before: Column) -> tuple[Column, Column]:
    """Wrapped difference in [-pi, pi) and whether wrapping changed it."""
    raw = after - before
    wrapped = F.pmod(raw + F.lit(math.pi), F.lit(2 * math.pi)) - F.lit(math.pi)
    return wrapped, F.abs(wrapped - raw) > 1e-12


def inertial_velocity(pos: tuple, vel: tuple) -> tuple:
    """Earth-fixed velocity plus omega x r (z axis form)."""
    return vel[0] - EARTH_RATE * pos[1], vel[1] + EARTH_RATE * pos[0], vel[2]


def vis_viva_sma(pos: tuple, vel: tuple) -> Column:
    """Osculating semi-major axis (m); NULL for unbound states."""
    inv = 2.0 / norm3(*pos) - dot(vel, vel) / MU
    return F.when(inv > 0, 1.0 / inv)


def rac_projection(pos: tuple, vel: tuple, diff: tuple) -> tuple[Column, Column, Column]:
    """Radial, along-track, cross-track parts of ``diff`` for an Earth-fixed state."""
    v = inertial_velocity(pos, vel)
    r = norm3(*pos)
    radial = tuple(p / r for p in pos)
    h = cross(pos, v)
    hn = norm3(*h)
    normal = tuple(c / hn for c in h)
    along = cross(normal, radial)
    return dot(diff, radial), dot(diff, along), dot(diff, normal)


def geodetic_to_ecef(lon_deg: Column, lat_deg: Column, height_m: Column, axis_m: float, flattening: float) -> tuple:
    e2 = flattening * (2.0 - flattening)
    lon, lat = F.radians(lon_deg), F.radians(lat_deg)
    prime = F.lit(axis_m) / F.sqrt(1.0 - e2 * F.sin(lat) * F.sin(lat))
    flat = (prime + height_m) * F.cos(lat)
    return flat * F.cos(lon), flat * F.sin(lon), (prime * (1.0 - e2) + height_m) * F.sin(lat)


def sigma_bound_km(base: Column, growth_per_day: Column, seconds: Column) -> Column:
    return base + growth_per_day * F.abs(seconds) / 86400.0


def classical_elements(pos: tuple, vel: tuple, mu: float = MU) -> dict[str, Column]:
    """Elements of an inertial state; undefined angles of circular or equatorial orbits are zero."""
    tiny = 1e-12
    r, v2, rv = norm3(*pos), dot(vel, vel), dot(pos, vel)
    h = cross(pos, vel)
    hn = norm3(*h)
    node = (-h[1], h[0], F.lit(0.0))
    nn = norm3(*node)
    ev = tuple(((v2 - mu / r) * p - rv * v) / mu for p, v in zip(pos, vel))
    e = norm3(*ev)
    energy = v2 / 2 - mu / r
    a = F.when(energy < 0, -mu / (2 * energy))

    def arc(cosine: Column, flip: Column) -> Column:
        base = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
        return F.when(flip, 2 * math.pi - base).otherwise(base)

    raan = F.when(nn > tiny, arc(node[0] / nn, node[1] < 0)).otherwise(0.0)
    argp = F.when((nn > tiny) & (e > tiny), arc(dot(node, ev) / (nn * e), ev[2] < 0)).otherwise(0.0)
    nu = F.when(e > tiny, arc(dot(ev, pos) / (e * r), rv < 0)).otherwise(0.0)
    ecc = 2 * F.atan2(F.sqrt(1 - e) * F.sin(nu / 2), F.sqrt(1 + e) * F.cos(nu / 2))
    return {
        "sma_m": a, "eccentricity": e, "inclination": F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), h[2] / hn))), "raan": raan, "arg_perigee": argp,
        "true_anomaly": nu, "mean_anomaly": F.when(e < 1, F.pmod(ecc - e * F.sin(ecc), F.lit(2 * math.pi))),
        "mean_motion": F.sqrt(F.lit(mu) / (a * a * a)), "period_s": 2 * math.pi * F.sqrt(a * a * a / mu), "angular_momentum": hn, "energy": energy,
    }
