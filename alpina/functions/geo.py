"""Grid-cell arithmetic and slope / aspect from elevation gradients."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alpina.fixed_values import MIN_SLOPE_FOR_ASPECT_DEG


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grid_cell(e, n, size: int) -> dict[str, Column]:
    """Lower-left cell corner ``floor(x/size)*size``, its centre, and id ``E<e>_N<n>``."""
    ce = (F.floor(_col(e) / size) * size).cast("long")
    cn = (F.floor(_col(n) / size) * size).cast("long")
    return {
        "cell_e": ce,
        "cell_n": cn,
        "center_e": ce + F.lit(size / 2.0),
        "center_n": cn + F.lit(size / 2.0),
        "cell_id": F.concat(F.lit("E"), ce.cast("string"), F.lit("_N"), cn.cast("string")),
    }


def slope_aspect(dz_de, dz_dn, min_slope_deg: float = MIN_SLOPE_FOR_ASPECT_DEG) -> dict[str, Column]:
    """Slope in degrees, aspect in degrees (0 = N, 90 = E, direction of steepest descent),
    and the aspect's cos / sin components, NULL where the slope is below ``min_slope_deg``."""
    de, dn = _col(dz_de), _col(dz_dn)
    slope = F.degrees(F.atan(F.hypot(de, dn)))
    aspect = F.pmod(F.degrees(F.atan2(-de, -dn)), F.lit(360.0))
    sloped = slope >= F.lit(min_slope_deg)
    return {
        "slope": slope,
        "aspect": aspect,
        "cos_a": F.when(sloped, F.cos(F.radians(aspect))),
        "sin_a": F.when(sloped, F.sin(F.radians(aspect))),
    }
