"""Seawater equation of state (Jackett and McDougall 1995) as Column expressions.

No UDF: each function builds one arithmetic expression that stays inside
whole-stage code generation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The published JMD95 coefficients, in the order of their polynomials.
DENSITY_FRESH = [999.842594, 6.793952e-02, -9.095290e-03, 1.001685e-04, -1.120083e-06, 6.536332e-09]
DENSITY_SALT = [8.244930e-01, -4.089900e-03, 7.643800e-05, -8.246700e-07, 5.387500e-09]
DENSITY_SALT_3_2 = [-5.724660e-03, 1.022700e-04, -1.654600e-06]
DENSITY_SALT_2 = [4.831400e-04]
BULK_FRESH = [1.965933e04, 1.444304e02, -1.706103e00, 9.648704e-03, -4.190253e-05]
BULK_SALT = [5.284855e01, -3.101089e-01, 6.283263e-03, -5.084188e-05]
BULK_SALT_3_2 = [3.886640e-01, 9.085835e-03, -4.619924e-04]
BULK_P = [3.186519e00, 2.212276e-02, -2.984642e-04, 1.956415e-06]
BULK_P_SALT = [6.704388e-03, -1.847318e-04, 2.059331e-07]
BULK_P_SALT_3_2 = [1.480266e-04]
BULK_P2 = [2.102898e-04, -1.202016e-05, 1.394680e-07]
BULK_P2_SALT = [-2.040237e-06, 6.128773e-08, 6.207323e-10]
#: Gravity in km/s^2 and reference density; 0.1 bar make one decibar.
GRAVITY_KM = 0.0098
REFERENCE_DENSITY = 1025.0
BAR_PER_DBAR = 0.1


def _column(x: Column | str | float) -> Column:
    return (F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(float(x))).cast("double")


def _horner(coefficients: list[float], t: Column) -> Column:
    value = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        value = value * t + F.lit(c)
    return value


def _root(s: Column) -> Column:
    """Square root of salinity: NULL, not NaN, below zero."""
    return F.when(s >= 0, F.sqrt(s))


def bulk_modulus(salt: Column | str, theta: Column | str, p_bar: Column | str | float) -> Column:
    """Secant bulk modulus; pressure in bar."""
    s, t, p = map(_column, (salt, theta, p_bar))
    s32 = s * _root(s)
    surface = _horner(BULK_FRESH, t) + s * _horner(BULK_SALT, t) + s32 * _horner(BULK_SALT_3_2, t)
    linear = _horner(BULK_P, t) + s * _horner(BULK_P_SALT, t) + s32 * F.lit(BULK_P_SALT_3_2[0])
    return surface + p * linear + p * p * (_horner(BULK_P2, t) + s * _horner(BULK_P2_SALT, t))


def surface_density(salt: Column | str, theta: Column | str) -> Column:
    s, t = map(_column, (salt, theta))
    s32 = s * _root(s)
    return _horner(DENSITY_FRESH, t) + s * _horner(DENSITY_SALT, t) + s32 * _horner(DENSITY_SALT_3_2, t) + F.lit(DENSITY_SALT_2[0]) * s * s


def density(salt: Column | str, theta: Column | str, p_dbar: Column | str | float = 0.0) -> Column:
    """In-situ density in kg/m^3; pressure in dbar.  At pressure 0 the bulk modulus drops out."""
    rho0 = surface_density(salt, theta)
    if not isinstance(p_dbar, (Column, str)) and float(p_dbar) == 0.0:
        return rho0
    p = _column(p_dbar) * F.lit(BAR_PER_DBAR)
    return F.try_divide(rho0, F.lit(1.0) - F.try_divide(p, bulk_modulus(salt, theta, p)))


def buoyancy(salt: Column | str = "salt", theta: Column | str = "theta") -> Column:
    """Surface buoyancy ``g * rho / rho_ref`` with g in km/s^2."""
    return F.lit(GRAVITY_KM) * density(salt, theta, 0.0) / F.lit(REFERENCE_DENSITY)


def negative_salinity(df: DataFrame, salt: str = "salt") -> DataFrame:
    """One row: how many salinities are negative (their density is NULL)."""
    return df.agg(F.count_if(F.col(salt) < 0).alias("negative_salinity"))


def any_negative_salinity(df: DataFrame, salt: str = "salt") -> DataFrame:
    """``face, any_negative``: whether a face holds a negative salinity; missing ones are not negative."""
    return df.groupBy("face").agg(F.coalesce(F.bool_or(F.col(salt) < 0), F.lit(False)).alias("any_negative"))


def observed(df: DataFrame, salt: str = "salt") -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that holds ``negative_salinity`` once an action has run over them."""
    seen = Observation(f"salinity-{uuid.uuid4().hex}")
    return df.observe(seen, F.count_if(F.col(salt) < 0).alias("negative_salinity")), seen


def register(spark) -> None:
    """Create temporary SQL functions ``seawater_density`` and ``seawater_bulk_modulus``."""
    for name, pressure in (("seawater_density", "p_dbar"), ("seawater_bulk_modulus", "p_bar")):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(salt DOUBLE, theta DOUBLE, {pressure} DOUBLE) RETURNS DOUBLE RETURN {sql_text(name)}")


def _poly_sql(c: list[float], t: str) -> str:
    out = f"({c[-1]!r}D)" if "e" in repr(c[-1]) else f"{c[-1]!r}D"
    for x in reversed(c[:-1]):
        out = f"({out} * {t} + ({x!r}D))"
    return out


def sql_text(name: str) -> str:
    """Spark SQL body of the registered functions."""
    root = "(salt * CASE WHEN salt >= 0 THEN sqrt(salt) END)"

    def bulk(p: str) -> str:
        return (
            f"({_poly_sql(BULK_FRESH, 'theta')} + salt * {_poly_sql(BULK_SALT, 'theta')} + {root} * {_poly_sql(BULK_SALT_3_2, 'theta')}"
            f" + {p} * ({_poly_sql(BULK_P, 'theta')} + salt * {_poly_sql(BULK_P_SALT, 'theta')} + {root} * {BULK_P_SALT_3_2[0]!r}D)"
            f" + {p} * {p} * ({_poly_sql(BULK_P2, 'theta')} + salt * {_poly_sql(BULK_P2_SALT, 'theta')}))"
        )

    if name == "seawater_bulk_modulus":
        return bulk("p_bar")
    rho0 = f"({_poly_sql(DENSITY_FRESH, 'theta')} + salt * {_poly_sql(DENSITY_SALT, 'theta')} + {root} * {_poly_sql(DENSITY_SALT_3_2, 'theta')} + {DENSITY_SALT_2[0]!r}D * salt * salt)"
    return f"try_divide({rho0}, 1.0D - try_divide(p_dbar * {BAR_PER_DBAR}D, {bulk(f'(p_dbar * {BAR_PER_DBAR}D)')}))"
