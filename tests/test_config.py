import pytest

from galetrack.sources.config import CalibrationError, Config


def load(tmp_path, text):
    (tmp_path / "c.yaml").write_text(text)
    return Config.load(tmp_path / "c.yaml")


def test_register(tmp_path):
    c = load(tmp_path, "a: {b: 1}\ncalibration:\n  r: {value: 111.12, status: sourced, source: 'one  degree'}\n  q: {value: 1, status: UNCONFIRMED}\n")
    assert c.calibration("r") == 111.12 and c.get("a.b") == 1 and c.get("a.x", 5) == 5 and "one degree" in c.provenance()
    for name in ("q", "other"):
        with pytest.raises(CalibrationError):
            c.calibration(name)


@pytest.mark.parametrize("entry", ["5", "{value: 1, status: sourced}", "{value: 1, status: confirmed, source: x}", "{status: sourced, source: x}"])
def test_refused(tmp_path, entry):
    with pytest.raises(CalibrationError):
        load(tmp_path, f"calibration:\n  r: {entry}\n")


def test_basins(tmp_path):
    (tmp_path / "al.txt").write_text("")
    c = load(tmp_path, "basins:\n  AL: {path: al.txt}\n  EP: {path: ep.txt, enabled: false}\n")
    assert list(c.basin_paths()) == ["AL"]
    with pytest.raises(FileNotFoundError):
        load(tmp_path, "basins:\n  EP: {path: ep.txt}\n").basin_paths()
