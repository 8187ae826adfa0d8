"""Scenario settings of one run."""

from __future__ import annotations

from dataclasses import dataclass

from emisplit.errors import SpeciationError

#: Keywords a run may set (fixed values). MECH_FILE and HAPS_FILE are accepted
#: but have no effect.
SETTINGS = (
    "MECH_BASIS",
    "RUN_TYPE",
    "AQM",
    "MECH_FILE",
    "TOX_FILE",
    "HAPS_FILE",
    "PRO_FILE",
    "PROC_FILE",
    "PRIMARY_FILE",
    "SPLITS_OUT",
    "CNV_OUT",
    "OUTPUT",
    "TOLERANCE",
)

#: The scenario table: settings as they take effect, a row per run; ``output`` is as written.
RUN_COLUMNS = "scenario_id string, mechanism string, aqm string, kind string, outputs string, output string, pro_file string, proc_file string"

CRITERIA = "CRITERIA"
INTEGRATE = "INTEGRATE"
NOINTEGRATE = "NOINTEGRATE"
HAPLIST = "HAPLIST"
VBS = "VBS"

#: Run types that read the toxics list and the inventory's HAPs.
HAP_RUNS = (INTEGRATE, NOINTEGRATE, HAPLIST)

DEFAULT_TOLERANCE = 5.0


def _upper(text: str | None) -> str | None:
    return None if text is None else text.upper()


@dataclass(frozen=True)
class Scenario:
    """Settings as written by the user; properties give the effective value."""

    run_name: str
    mech_basis: str | None = None
    run_type: str | None = None
    aqm: str | None = None
    mech_file: str | None = None
    tox_file: str | None = None
    haps_file: str | None = None
    pro_file: str | None = None
    proc_file: str | None = None
    primary_file: str | None = None
    splits_out: str | None = None
    cnv_out: str | None = None
    output: str | None = None
    tolerance: str | float | None = None

    @property
    def mechanism(self) -> str | None:
        return _upper(self.mech_basis)

    @property
    def kind(self) -> str | None:
        return _upper(self.run_type)

    @property
    def model(self) -> str | None:
        return _upper(self.aqm)

    @property
    def outputs(self) -> str | None:
        return _upper(self.output)

    @property
    def tolerance_pct(self) -> float:
        if self.tolerance is None or self.tolerance == "":
            return DEFAULT_TOLERANCE
        return float(self.tolerance)

    @property
    def wants_gas(self) -> bool:
        return self.outputs is None or "VOC" in self.outputs

    @property
    def wants_pm(self) -> bool:
        return self.outputs is not None and "PM" in self.outputs

    @property
    def wants_static(self) -> bool:
        return self.outputs is not None and "STATIC" in self.outputs

    @property
    def writes_conversions(self) -> bool:
        """Whether conversion factors and volatility classes are written."""
        if not self.output:
            return True
        return self.output == "VOC" and self.kind != HAPLIST

    def check_required(self) -> "Scenario":
        """Stop when a setting that the requested output needs is missing."""
        needed = ["aqm"]
        if not self.output or self.output == "VOC":
            needed += ["mech_basis", "run_type"]
        elif self.output == "PM":
            needed += ["mech_basis"]
        missing = [name.upper() for name in needed if not getattr(self, name)]
        if missing:
            raise SpeciationError(f"run {self.run_name}: not set: {', '.join(missing)}")
        return self

    def check_pm_run_type(self) -> "Scenario":
        """Particulate output exists for CRITERIA and VBS runs only."""
        if self.wants_pm and self.kind not in (CRITERIA, VBS):
            raise SpeciationError(f"run {self.run_name}: RUN_TYPE {self.kind} is not supported for PM")
        return self
