import tracemalloc

import pyarrow as pa

from presswork.llm import periodic


def test_memory_is_bounded_by_parts_of_a_batch():
    """Many texts in a batch take no more than a few do."""

    def peak(n):
        texts = [" ".join(f"w{(i * k) % 601}" for k in range(600)) for i in range(n)]
        batch = pa.record_batch([pa.array(range(n), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
        del texts
        tracemalloc.start()
        rows = sum(len(out) for out in periodic.annotated(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == n
        return most / 1e6

    assert peak(1500) < 40
