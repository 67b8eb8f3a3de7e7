from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))


@pytest.fixture(scope="module")
def odd(spark):
    from odd import odd_documents

    from weirgate.llm.common import prepare

    prepare(spark)
    return odd_documents(spark).cache()
