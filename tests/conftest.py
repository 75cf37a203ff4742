from __future__ import annotations

import sys
from pathlib import Path

import pytest

for folder in (Path(__file__).resolve().parent, Path(__file__).resolve().parents[1]):
    sys.path.insert(0, str(folder))

from contract_rows import HEADER, contract_line  # noqa: E402
from decantry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("decantry-tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def contracts_csv(tmp_path):
    """Twelve contracts: seven sound, one priced zero, one that is dated far ahead, and
    three ragged rows whose values a missing or a surplus separator has moved."""
    lines = [
        contract_line("library", "NORTE", "2021-03-09", "812.5"),
        contract_line("harbour", "SUR", "2021-11-30", "64000"),
        contract_line("archive", "NORTE", "2022-07-18", "0"),
        # One separator less before the date: it is read as the column before it.
        contract_line("theatre", "ESTE", "2022-08-02", "990").replace(",2022", "2022"),
        contract_line("museum", "OESTE", "2020-02-29", "15750"),
        # One more before the price: it is read as the column after it.
        contract_line("stadium", "SUR", "2021-05-05", "410").replace(",410", ",,410"),
        contract_line("market", "ESTE", "2022-12-31", "2200"),
        contract_line("bridge", "CENTRO", "2099-01-01", "7300"),
        contract_line("tunnel", "CENTRO", "2021-09-14", "128000"),
        contract_line("garden", "OESTE", "2022-01-22", "15"),
        # And one before the date, which moves both.
        contract_line("tower", "NORTE", "2020-10-10", "3600").replace(",2020", ",,2020"),
        contract_line("well", "PEÑA", "2022-06-01", "45.25"),
    ]
    path = tmp_path / "contracts.csv"
    path.write_text("\n".join([",".join(HEADER), *lines]) + "\n", encoding="utf-8")
    return str(path)
