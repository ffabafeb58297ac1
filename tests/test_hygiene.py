"""Source-level rules: shared folders only, no local checkpoints, no Python UDFs."""

import pathlib

SRC = pathlib.Path(__file__).resolve().parents[1] / "vela"


def _sources():
    return {p: p.read_text() for p in SRC.rglob("*.py") if p.relative_to(SRC).parts[0] != "llm"}


def test_no_local_checkpoint_and_no_udfs():
    for p, s in _sources().items():
        assert "localCheckpoint" not in s, p
        for udf in ("@udf", "F.udf(", "pandas_udf", "mapInPandas", "applyInPandas", ".rdd.map", "mapPartitions"):
            assert udf not in s, (p, udf)


def test_machine_local_folders_only_as_unset_fallback():
    for p, s in _sources().items():
        if p.name == "session.py":
            continue
        assert "tempfile" not in s and "/tmp" not in s, p
