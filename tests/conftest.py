from __future__ import annotations

import random
import sys
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskloom.plans.fixtures import Tables  # noqa: E402
from riskloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(
        "8",
        app="riskloom-tests",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__sql__shuffle__partitions="4",
    )


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


ROW_SCHEMA = (
    "transaction_id string, timestamp timestamp, amount decimal(18,2), card_id string, "
    "merchant_id string, is_history boolean"
)


def make_rows(seed: int, n: int, cards: int = 4, *, ties: bool = True, hot: float = 0.0):
    """Random rows: few cards, some without card or merchant, many sharing a timestamp."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        minutes = rng.randrange(0, 60 * 24 * 12)
        if ties and rng.random() < 0.5:
            minutes -= minutes % 360
        card = "hot" if rng.random() < hot else f"c{rng.randrange(cards)}"
        rows.append(
            (
                f"t{i:05d}",
                start + timedelta(minutes=minutes, microseconds=0 if ties else rng.randrange(10**6)),
                Decimal(rng.choice([500, 500, rng.randrange(1, 10**6)])) / 100,
                None if rng.random() < 0.1 else card,
                None if rng.random() < 0.1 else f"m{rng.randrange(5)}",
                rng.random() < 0.7,
            )
        )
    return rows
