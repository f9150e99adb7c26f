from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from subledger.session import checkpoint_dir, get_spark

    s = get_spark("local[*]", shuffle_partitions=8)
    checkpoint_dir(s)  # unset in tests: a fresh local scratch folder is registered
    yield s


@pytest.fixture
def scratch() -> str:
    """A new scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="subledger-test-", dir="/tmp")


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def files(root: str) -> dict[str, set[str]]:
    """Data files by partition folder of a table on local disk."""
    return {d.name: {f.name for f in d.glob("*.parquet")} for d in Path(root).iterdir() if "=" in d.name}
