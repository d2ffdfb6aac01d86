"""Settings with a register of calibrations that must be approved before use."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path
from typing import Any

USABLE = ("sourced", "confirmed")


class CalibrationError(ValueError):
    """A calibration that is missing, malformed or not approved."""


@dataclass(frozen=True)
class Calibration:
    name: str
    value: float
    status: str
    source: str = ""
    confirmed_by: str = ""
    confirmed_on: str = ""

    @classmethod
    def parse(cls, name: str, entry: Any) -> Calibration:
        """From a mapping: usable statuses need a source, ``confirmed`` an approver too."""
        if not isinstance(entry, dict) or "value" not in entry or "status" not in entry:
            raise CalibrationError(f"{name}: a mapping with value and status is needed")
        made = cls(name, float(entry["value"]), str(entry["status"]), *[str(entry.get(k) or "") for k in ("source", "confirmed_by", "confirmed_on")])
        if made.status in USABLE and not made.source.strip():
            raise CalibrationError(f"{name}: {made.status} without a source")
        if made.status == "confirmed" and not made.confirmed_by.strip():
            raise CalibrationError(f"{name}: confirmed without an approver")
        return made

    def usable(self) -> float:
        if self.status not in USABLE:
            raise CalibrationError(f"{self.name}: status {self.status} may not be used")
        return self.value


class Config:
    """A YAML file's settings, with dotted names and paths relative to a root."""

    def __init__(self, settings: dict[str, Any], root: Path):
        self.settings, self.root = settings, root
        self.calibrations = {n: Calibration.parse(n, e) for n, e in (settings.get("calibration") or {}).items()}

    @classmethod
    def load(cls, path: str | Path) -> Config:
        import yaml

        file = Path(path).resolve()
        root = next((p for p in file.parents if (p / "pyproject.toml").exists() or (p / ".git").exists()), file.parent)
        return cls(yaml.safe_load(file.read_text(encoding="utf-8")) or {}, root)

    def get(self, name: str, default: Any = None) -> Any:
        at: Any = self.settings
        for part in name.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return at

    def path(self, name: str) -> Path:
        value = self.get(name)
        if not value:
            raise KeyError(name)
        return self.root / value

    def calibration(self, name: str) -> float:
        if name not in self.calibrations:
            raise CalibrationError(f"{name}: not declared")
        return self.calibrations[name].usable()

    def basin_paths(self) -> dict[str, Path]:
        """Existing files of the enabled basins."""
        out = {}
        for basin, entry in (self.get("basins") or {}).items():
            if entry.get("enabled", True):
                out[basin] = self.root / entry["path"]
                if not out[basin].exists():
                    raise FileNotFoundError(f"{basin}: {out[basin]}")
        return out

    def provenance(self) -> str:
        """The register as text, one line a calibration."""
        lines = [f"{c.name}\t{c.value:g}\t{c.status}\t{' '.join(c.source.split())}" for _, c in sorted(self.calibrations.items())]
        return "\n".join(["name\tvalue\tstatus\tsource", *lines]) + "\n"
