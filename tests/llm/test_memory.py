"""A Python worker is used again: what a task no longer needs goes back to the system."""

import re
from pathlib import Path

import pyarrow as pa

from larder.llm import common


def private_mb() -> int:
    return sum(map(int, re.findall(r"\nPrivate_Dirty:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) // 1024


def test_freed_memory_goes_back_when_the_batches_end():
    batch = pa.RecordBatch.from_pydict({"text": [b"a b", b"c"]})
    held = [bytes([k % 251]) * 2048 for k in range(100_000)]
    high = private_mb()
    pins = held[::1000]  # a few that stay, among them the last, keep the allocator from shrinking its heap by itself
    pins.append(held[-1])
    del held
    assert sum(some.num_rows for some in common.slices(iter([batch]), "text")) == 2
    assert high - private_mb() > 100 and len(pins) == 101
