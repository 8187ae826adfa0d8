"""The set of input tables a run reads."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tables:
    """Reference tables, and the optional per-scenario ones.

    Only the tables that the requested outputs use have to be given.
    """

    species: DataFrame | None = None
    profiles: DataFrame | None = None
    profile_weights: DataFrame | None = None
    mechanism: DataFrame | None = None
    mechanism_description: DataFrame | None = None
    carbons: DataFrame | None = None
    invtable: DataFrame | None = None
    pm_mechanism: DataFrame | None = None
    o2m_ratios: DataFrame | None = None
    camx_fcrs: DataFrame | None = None
    vbs_svoc_factors: DataFrame | None = None
    vbs_ivoc_factors: DataFrame | None = None
    ivoc_species: DataFrame | None = None
    static: DataFrame | None = None
    rename_species: DataFrame | None = None
    metadata: DataFrame | None = None
    toxics: DataFrame | None = None
    gas_process: DataFrame | None = None
    primary: DataFrame | None = None
    user_profile_wts: DataFrame | None = None

    def same(self, other: "Tables") -> bool:
        """Whether all tables have the same plans, hence the same rows."""
        pairs = [(getattr(self, f.name), getattr(other, f.name)) for f in fields(self)]
        return all(a is b or (a is not None and b is not None and a.sameSemantics(b)) for a, b in pairs)

    def with_(self, **changes: DataFrame | None) -> "Tables":
        return replace(self, **changes)
