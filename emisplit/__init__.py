"""Emission speciation as Spark DataFrame plans."""

from emisplit.errors import SpeciationError
from emisplit.plans.scenario import Scenario
from emisplit.plans.tables import Tables

__all__ = ["Scenario", "SpeciationError", "Tables"]
