"""Slices stay bounded where texts are empty or null."""

import pyarrow as pa
import pytest

from strata.llm.common import gathered


@pytest.mark.parametrize("text", ["", None])
def test_rows_without_text_are_sliced_too(text):
    n = 20_000
    batch = pa.RecordBatch.from_pydict({"i": list(range(n)), "text": pa.array([text] * n, pa.string())})
    parts = [sum(b.num_rows for b in held) for held in gathered(iter([batch] * 5), "text", 1 << 20)]
    assert sum(parts) == 5 * n
    assert max(parts) <= (1 << 20) // 512


def test_a_long_text_is_one_slice():
    batch = pa.RecordBatch.from_pydict({"text": ["a", "b" * 5000, "c", None]})
    parts = [pa.Table.from_batches(h).column("text").to_pylist() for h in gathered(iter([batch]), "text", 2000)]
    assert [t for p in parts for t in p] == ["a", "b" * 5000, "c", None]
    assert ["b" * 5000] in parts
