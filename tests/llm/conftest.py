import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def given():
    """The given documents as (doc_id, text)."""
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
