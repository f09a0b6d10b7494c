"""Memory of workers."""

import re
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from rankloom.llm.common import giving_back


def _anonymous_mb() -> int:
    return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) // 1024


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_task_gives_its_memory_back():
    pins = []

    def run(batches):
        # Blocks too small to be mapped, below one that stays: freeing them alone returns nothing.
        made = [np.ones(1250) for _ in range(20_000)]
        pins.append(np.ones(1250))
        del made
        pins.append(_anonymous_mb())
        yield from batches

    batch = pa.RecordBatch.from_pydict({"a": [1, 2]})
    assert list(giving_back(run)(iter([batch]))) == [batch]
    assert pins[1] - _anonymous_mb() > 100
