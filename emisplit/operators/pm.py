"""Particulate speciation: gap filling, fractions, model-specific names.

The profile weights are the large table and are processed like the gas ones:
``totals`` puts per-profile facts next to each row, so every gap-filling rule
is a row expression. New species of a profile are emitted next to its first
row (smallest species id), which needs no further pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emisplit.functions import carried, splittable, store, totals
from emisplit.functions.grouping import Total

# Species ids (fixed values).
SULFATE = "699"
SULFUR = "700"
AMMONIUM = "784"
ORGANIC_CARBON = "626"
WATER = "2668"
NON_CARBON_ORGANIC = "2669"
METAL_OXYGEN = "2670"

#: Species that would be counted twice (fixed values): NH3, TC, PO4, CO3=, OC2,
#: OC3, OC4, EC1, EC3, SO2, H2S, OC1, EC2.
DOUBLE_COUNTED = (
    "294", "436", "665", "788", "789", "790", "791", "794", "796", "830", "831", "1183", "1190",
)

#: Ion and atom of the same element (fixed values): K, Na, Cl, Ca, Mg. The last
#: two may come from an oxide, at the mass ratio of element to oxide.
ELEMENTS = (
    ("2302", "669", None, None),
    ("785", "696", None, None),
    ("337", "795", None, None),
    ("2303", "329", "2847", (40, 56)),
    ("2772", "525", "2852", (24, 40)),
)

#: Atoms and oxides that the ions replace.
REPLACED = tuple(s for _, atom, oxide, _ in ELEMENTS for s in (atom, oxide) if s)

VBS_TYPE = "PM-VBS"
PLAIN_TYPE = "PM"
PM_TYPES = (PLAIN_TYPE, "PM-AE6", VBS_TYPE)

#: Only this mechanism processes profiles of the volatility-basis-set type.
VBS_MECHANISM = "AE8"

INVENTORY_NAME = "PM2_5"

RAW_COLUMNS = ["profile_id", "profile_type", "gen_mechanism", "sec_equipment", "specie_id", "percent"]


def select_pm(profiles: DataFrame) -> DataFrame:
    """Profiles that a particulate run may process."""
    return profiles.where(F.col("profile_type").isin(*PM_TYPES))


def _with_profile(profiles: DataFrame, weights: DataFrame) -> DataFrame:
    known = profiles.select("profile_id", "profile_type", "gen_mechanism", "sec_equipment")
    return weights.join(known, "profile_id").select(
        "profile_id",
        "profile_type",
        "gen_mechanism",
        "sec_equipment",
        "specie_id",
        store("percent", 15, 8).alias("percent"),
    )


def pm_raw_weights(profiles: DataFrame, weights: DataFrame) -> DataFrame:
    """Weights of the fine (0 to 2.5 micrometre) particulate profiles."""
    fine = select_pm(profiles).where("lower_size = 0 and upper_size = 2.5")
    return _with_profile(fine, weights)


def pm_user_weights(profiles: DataFrame, user_weights: DataFrame) -> DataFrame:
    """User weights of any size; profiles unknown to the table yield nothing."""
    return _with_profile(select_pm(profiles), user_weights)


#: Non-carbon part of organic matter by kind of source (fixed values).
PNCOM_FACTOR = """CAST(CASE
    WHEN sec_equipment LIKE '%biomass burning%' AND sec_equipment NOT LIKE '%boiler%' THEN 0.7
    WHEN gen_mechanism = 'Combustion' AND sec_equipment LIKE '%Mobile%' THEN 0.25
    ELSE 0.4 END AS DECIMAL(10,6))"""


def _in(*species: str) -> str:
    return "specie_id IN (" + ", ".join(f"'{s}'" for s in species) + ")"


def _percent_of(*species: str) -> Total:
    """Sum over the given species, NULL when the profile has none of them."""
    return F.sum, F.expr(f"CASE WHEN {_in(*species)} THEN percent END")


def _has(species: str) -> Total:
    """Whether the profile has a positive amount of the species."""
    return F.max, F.expr(f"specie_id = '{species}' AND percent > 0")


def _profile_facts() -> dict[str, Total]:
    facts = {
        "sulfate": _percent_of(SULFATE),
        "sulfur": _percent_of(SULFUR),
        "ammonium": _percent_of(AMMONIUM),
        "carbon": _percent_of(ORGANIC_CARBON),
        "water": _percent_of(WATER),
        "bound_oxygen": (F.sum, F.expr("percent * o2m_ratio")),
        "ratio_of_sulfate": (F.max, F.col("sulfate_ratio")),
        "ratio_of_water": (F.max, F.col("water_ratio")),
        "lead": (F.min, F.col("specie_id")),
    }
    for ion, atom, oxide, _ in ELEMENTS:
        facts[f"has_{ion}"] = _has(ion)
        facts[f"has_{atom}"] = _has(atom)
        if oxide:
            facts[f"oxide_{ion}"] = (F.sum, F.expr(f"CASE WHEN specie_id = '{oxide}' AND percent > 0 THEN percent END"))
    return facts


def _ratio_lookup(o2m: DataFrame) -> DataFrame:
    """Oxygen ratios by species, with those of sulfate and water at their sources.

    Sulfate and water may be added to a profile later, so their ratios are
    looked up from the species they would be derived from.
    """
    ratio, none = F.col("o2m_ratio"), F.lit(None).cast("decimal(10,6)")

    def entry(specie_id: Column, own: Column, sulfate: Column, water: Column) -> list[Column]:
        return [
            specie_id.alias("specie_id"),
            own.alias("o2m_ratio"),
            sulfate.alias("sulfate_ratio"),
            water.alias("water_ratio"),
        ]

    water_sources = F.explode(F.array(F.lit(SULFUR), F.lit(SULFATE), F.lit(AMMONIUM)))
    own = o2m.select(entry(F.col("specie_id"), ratio, none, none))
    sulfate = o2m.where(F.col("specie_id") == SULFATE).select(entry(F.lit(SULFUR), none, ratio, none))
    water = o2m.where(F.col("specie_id") == WATER).select(entry(water_sources, none, none, ratio))
    return (
        own.unionByName(sulfate)
        .unionByName(water)
        .groupBy("specie_id")
        .agg(*[F.max(c).alias(c) for c in ("o2m_ratio", "sulfate_ratio", "water_ratio")])
    )


def fill_gaps(rows: DataFrame, o2m: DataFrame) -> DataFrame:
    """Complete each profile for a mechanism with explicit species.

    Sulfate is derived from sulfur, and ions replace atoms and oxides, in every
    profile. Water, metal-bound oxygen and non-carbon organics are added to
    plain profiles only, and plain profiles over 101 percent are scaled down.
    Each row has its profile's ``lowest`` percent.
    """
    return _scale_over_101(_fill_species(rows, o2m))


def _fill_species(rows: DataFrame, o2m: DataFrame) -> DataFrame:
    facts = totals(rows.join(splittable(_ratio_lookup(o2m), "specie_id"), "specie_id", "left"), ["profile_id"], **_profile_facts())
    facts = facts.withColumn(
        "new_sulfate", F.expr("CASE WHEN sulfate IS NULL THEN CAST(sulfur * 3 AS DECIMAL(15,8)) END")
    ).withColumn("all_sulfate", F.expr("CAST(coalesce(sulfate, new_sulfate) AS DECIMAL(15,8))"))
    wet = f"profile_type = '{PLAIN_TYPE}' AND water IS NULL AND coalesce(gen_mechanism, '') <> 'Combustion'"
    humid = "CAST((coalesce(all_sulfate, 0) + coalesce(ammonium, 0)) * 0.24 AS DECIMAL(15,8))"
    # A profile without sulfate and ammonium has none of it: the sum is zero.
    facts = facts.withColumn("new_water", F.expr(f"CASE WHEN {wet} THEN nullif({humid}, 0) END"))
    facts = facts.withColumns(
        {
            "metal_oxygen": F.expr(
                "CAST(coalesce(bound_oxygen, 0) + coalesce(new_sulfate * ratio_of_sulfate, 0)"
                " + coalesce(new_water * ratio_of_water, 0) AS DECIMAL(26,14))"
            ),
            # Ammonium takes 96 / 2 per 18 of sulfate; a sixth of the rest is oxygen.
            "free_sulfate": F.expr("CAST(coalesce(all_sulfate * 18 - coalesce(ammonium, 0) * 48, 0) AS DECIMAL(20,8))"),
        }
    )
    adjusted = "CASE WHEN free_sulfate <= 0 THEN metal_oxygen ELSE (metal_oxygen * 108 - free_sulfate) / 108 END"
    plain = f"CASE WHEN profile_type = '{PLAIN_TYPE}' THEN {{}} END"
    added = [
        (SULFATE, "new_sulfate"),
        (WATER, "new_water"),
        (METAL_OXYGEN, plain.format(f"greatest(CAST({adjusted} AS DECIMAL(15,8)), 0)")),
        (NON_CARBON_ORGANIC, plain.format(f"carbon * {PNCOM_FACTOR}")),
    ]
    for ion, atom, oxide, ratio in ELEMENTS:
        if oxide:
            amount = f"CAST(oxide_{ion} * {ratio[0]} AS DECIMAL(26,18)) / {ratio[1]}"
            added.append((ion, f"CASE WHEN NOT has_{ion} AND NOT has_{atom} THEN {amount} END"))

    salt = "".join(f", '{c}', {c}" for c in carried(rows))

    def row(specie_id: str, percent: str) -> str:
        return (
            "named_struct('profile_id', profile_id, 'profile_type', profile_type, "
            f"'specie_id', {specie_id}, 'percent', CAST({percent} AS DECIMAL(15,8)){salt})"
        )

    own = row(*_resolved())
    extra = ", ".join(row(f"'{specie}'", percent) for specie, percent in added)
    out = f"inline(CASE WHEN specie_id = lead THEN array({own}, {extra}) ELSE array({own}) END)"
    return facts.selectExpr(out).where("percent is not null")


def _resolved() -> tuple[str, str]:
    """Species and percent of an input row; NULL percent drops the row.

    A positive atom takes the place of its ion where the ion is absent. Empty
    ions, atoms and oxides, double counted species and replaced ones go.
    """
    renames = " ".join(
        f"WHEN specie_id = '{atom}' AND percent > 0 AND NOT has_{ion} THEN '{ion}'" for ion, atom, _, _ in ELEMENTS
    )
    takes_ion = " OR ".join(f"(specie_id = '{atom}' AND percent > 0 AND NOT has_{ion})" for ion, atom, _, _ in ELEMENTS)
    members = [s for ion, atom, oxide, _ in ELEMENTS for s in (ion, atom, oxide) if s]
    dropped = (
        f"(percent = 0 AND {_in(*members)}) OR {_in(*DOUBLE_COUNTED)} OR ({_in(*REPLACED)} AND NOT ({takes_ion}))"
    )
    return f"CASE {renames} ELSE specie_id END", f"CASE WHEN NOT ({dropped}) THEN percent END"


def _scale_over_101(rows: DataFrame) -> DataFrame:
    """Bring plain profiles over 101 percent back to 100.

    Organic matter alone is scaled when it can absorb the excess, otherwise
    every species of the profile is. Sulfur does not count in the sum.
    ``lowest`` is the profile's smallest percent afterwards: scaling keeps the
    order within the organic species and within the others.
    """
    organic = F.col("specie_id").isin(ORGANIC_CARBON, NON_CARBON_ORGANIC)
    sums = totals(
        rows,
        ["profile_id"],
        total=(F.sum, F.when(F.col("specie_id") != SULFUR, F.col("percent"))),
        organics=_percent_of(ORGANIC_CARBON, NON_CARBON_ORGANIC),
        low_organic=(F.min, F.when(organic, F.col("percent"))),
        low_other=(F.min, F.when(~organic, F.col("percent"))),
    )
    over = (F.col("profile_type") == PLAIN_TYPE) & (F.col("total") > 101)
    total, organics = store("total", 15, 8), store("organics", 15, 8)
    room = 100 - (total - organics)
    by_organics = over & (organics > 0) & (room > 0)

    def scaled(percent: str, is_organic: Column) -> Column:
        value = F.col(percent)
        return (
            F.when(by_organics & is_organic, store(store(value * room, 24, 16) / organics, 15, 8))
            .when(by_organics, value)
            .when(over, store(value / total * 100, 15, 8))
            .otherwise(value)
        )

    lowest = F.least(scaled("low_organic", F.lit(True)), scaled("low_other", F.lit(False)))
    return sums.select(
        "profile_id", "profile_type", "specie_id", scaled("percent", organic).alias("percent"), *carried(rows), lowest.alias("lowest")
    )


def pm_mechanism_rows(pm_mechanism: DataFrame, runs: DataFrame) -> DataFrame:
    """Species rows of each scenario's mechanism and its computed pollutant.

    The computed pollutant takes the mass that no species row explains.
    """
    named = F.broadcast(runs.select("scenario_id", "mechanism"))
    rows = pm_mechanism.join(named, "mechanism")
    computed = rows.where("compute").groupBy("scenario_id").agg(F.max("aqm_poll").alias("other_poll"))
    return (
        rows.where("not compute")
        .select("scenario_id", "specie_id", "aqm_poll", (F.col("mechanism") == VBS_MECHANISM).alias("takes_vbs"))
        .join(computed, "scenario_id")
    )


def mechanism_weights(filled: DataFrame, mech: DataFrame) -> DataFrame:
    """Gap-filled weights of the mechanism's species with the profile sums."""
    matched = filled.join(mech, "specie_id").where((F.col("profile_type") != VBS_TYPE) | F.col("takes_vbs"))
    return totals(
        matched,
        ["profile_id", "scenario_id"],
        total=(F.sum, F.col("percent")),
        lead=(F.min, F.struct("specie_id", "aqm_poll")),
    ).withColumn("sum_pct", store("total", 15, 8))


def is_over_100() -> Column:
    """Whole percents over 100, not counting the volatility-basis-set type."""
    return (F.floor("sum_pct") > 100) & (F.col("profile_type") != VBS_TYPE)


def pm_fractions(weights: DataFrame) -> DataFrame:
    """Mass fractions per model species plus the unexplained remainder."""
    kept = weights.where(~is_over_100() & (F.col("lowest") >= 0))

    def row(name: str, fraction: Column) -> Column:
        return F.struct(
            "scenario_id",
            "profile_id",
            F.lit(INVENTORY_NAME).alias("eminv_poll"),
            F.col(name).alias("aqm_poll"),
            store(fraction, 17, 10).alias("fraction"),
        )

    own = row("aqm_poll", F.col("percent") / 100)
    rest = row("other_poll", 1 - F.col("sum_pct") / 100)
    first = F.struct("specie_id", "aqm_poll") == F.col("lead")
    out = F.when(first & (F.col("sum_pct") < 100), F.array(own, rest)).otherwise(F.array(own))
    return kept.select(F.inline(out))


#: Model species by CAMx name (fixed values). Organic carbon goes to two names.
_CAMX_NAMES = {
    "PNCOM": ("POA",),
    "POC": ("POA", "POC"),
    "PFE": ("FPRM",),
    "PAL": ("FPRM",),
    "PSI": ("FPRM",),
    "PTI": ("FPRM",),
    "PCA": ("FPRM",),
    "PMG": ("FPRM",),
    "PK": ("FPRM",),
    "PMN": ("FPRM",),
    "PMOTHR": ("FPRM",),
    "PEC": ("PEC",),
    "PH2O": ("PH2O",),
    "PNH4": ("PNH4",),
    "PSO4": ("PSO4",),
    "PNO3": ("PNO3",),
    "PCL": ("PCL",),
    "PNA": ("NA",),
}

_CAMX_SUMS = ("POA", "FPRM")


def camx_fractions(fractions: DataFrame, fcrs: DataFrame | None) -> DataFrame:
    """CAMx names: organics and metals are summed, other species dropped."""
    names = F.create_map(
        *[x for poll, to in _CAMX_NAMES.items() for x in (F.lit(poll), F.array(*[F.lit(t) for t in to]))]
    )
    renamed = fractions.select(
        "scenario_id", "profile_id", "eminv_poll", "fraction", F.explode(F.try_element_at(names, "aqm_poll")).alias("aqm_poll")
    )
    sums = renamed.groupBy("scenario_id", "profile_id", "eminv_poll", "aqm_poll").agg(F.sum("fraction").alias("total"))
    rounded = F.when(F.col("aqm_poll").isin(*_CAMX_SUMS), store(store("total", 15, 8), 17, 10)).otherwise(
        store("total", 17, 10)
    )
    out = sums.select("scenario_id", "profile_id", "eminv_poll", "aqm_poll", rounded.alias("fraction"))
    if fcrs is None:
        return out
    crustal = fcrs.select("profile_id", F.lit(True).alias("crustal")).distinct()
    name = F.when(F.col("crustal") & (F.col("aqm_poll") == "FPRM"), "FCRS").otherwise(F.col("aqm_poll"))
    return (
        out.join(crustal, "profile_id", "left")
        .withColumn("aqm_poll", name)
        .select("scenario_id", "profile_id", "eminv_poll", "aqm_poll", "fraction")
    )


def pm_splits(fractions: DataFrame) -> DataFrame:
    share = store("fraction", 15, 10)
    return fractions.select(
        "scenario_id",
        "profile_id",
        "eminv_poll",
        "aqm_poll",
        share.alias("split_factor"),
        store(F.lit(1), 12, 8).alias("divisor"),
        share.alias("mass_fraction"),
    )
