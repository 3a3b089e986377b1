from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from saldero.session import build_session  # noqa: E402
from saldero.sources.lake import Lake  # noqa: E402
from saldero.sources.sales import load_source  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def shared_csv_lines() -> list[str]:
    """24 sales over four days, two months and two dealers."""
    days = ("2022-01-30", "2022-01-31", "2022-02-01", "2022-02-02")
    lines = [
        "Car_id,Date,Customer Name,Gender,Annual Income,Dealer_Name,Company,Model,Price ($),"
        "Phone,Dealer_Region"
    ]
    for i in range(24):
        lines.append(
            f"C{i:03d},{days[i // 6]},x,M,1000,{('Norte', 'Sur')[i % 2]},"
            f"{('Ford', 'Nissan', 'Ford')[i % 3]},{('m1', 'm2', 'm3', 'm1')[i % 4]},"
            f"{15000 + 500 * i},1,R"
        )
    return lines


def gap_csv_lines() -> list[str]:
    """Four sales with a day missing and no region."""
    days = ("2022-01-01", "2022-01-01", "2022-01-02", "2022-01-04")
    lines = ["Car_id,Date,Customer Name,Gender,Dealer_Name,Company,Model,Price ($),Phone"]
    for i, day in enumerate(days):
        lines.append(
            f"{i + 1},{day},x,M,{'AB'[i % 2]},{('Ford', 'Nissan')[i % 2]},"
            f"{('m1', 'm2')[i % 2]},{100 * (i + 1)},1"
        )
    return lines


def write_lines(path: Path, lines: list[str]) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="session")
def shared_csv(tmp_path_factory) -> str:
    return write_lines(tmp_path_factory.mktemp("src") / "sales 2022.csv", shared_csv_lines())


@pytest.fixture
def shared_sales(spark, shared_csv):
    return load_source(spark, shared_csv)


@pytest.fixture
def lake(tmp_path) -> Lake:
    return Lake(str(tmp_path / "lake"))


D = dt.date
