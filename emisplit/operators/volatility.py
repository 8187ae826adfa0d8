"""Volatility class of a species from its vapour pressure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emisplit.functions import double

#: Upper bound of log10 saturation concentration per class (fixed values).
CLASSES = (
    (-0.5, "SVOCN1"),
    (0.5, "SVOCP0"),
    (1.5, "SVOCP1"),
    (2.5, "SVOCP2"),
    (3.5, "IVOCP3"),
    (4.5, "IVOCP4"),
    (5.5, "IVOCP5"),
    (6.5, "IVOCP6"),
)

#: Pa per mmHg, mmHg per atm, gas constant in m3 atm/(mol K), temperature in K
#: (fixed values).
_UNITS = (133.3223684, 760.0, 0.0000821, 298.15)


def volatility_class(species: DataFrame) -> DataFrame:
    """Class per species; blank when the vapour pressure is not known.

    A known pressure with a molar mass that has no logarithm raises.
    """
    grams = double("molecular_weight") * double("vp_epi") * 1000000.0
    for unit in _UNITS:
        grams = grams / unit
    level = F.when(
        F.col("molecular_weight") <= 0,
        F.raise_error(F.concat(F.lit("molecular weight is not positive, species "), "specie_id")).cast("double"),
    ).otherwise(F.log10(grams))
    name = F.when(F.col("level") < CLASSES[0][0], CLASSES[0][1])
    for bound, label in CLASSES[1:]:
        name = name.when(F.col("level") < bound, label)
    known = name.otherwise("VOC")
    pressure = F.col("vp_epi")
    leveled = species.select("specie_id", "specie_name", "vp_epi", F.when(pressure > 0, level).alias("level"))
    return leveled.select(
        "specie_id",
        "specie_name",
        F.when(pressure > 0, known).when(pressure == 0, CLASSES[0][1]).otherwise(" ").alias("voc_class"),
    )
