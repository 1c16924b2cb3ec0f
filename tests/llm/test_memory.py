"""What a worker process holds at once: it keeps what it once took, in the next stage, too."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from firmloom.llm import decontaminate, resample, secrets


def _peak(run) -> int:
    tracemalloc.start()
    run()
    found = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return found


def _run_of(made) -> object:
    """The function that a DataFrame's plan sends to the workers, as the operator hands it to Spark."""
    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, layout):
            return run

    return made(Docs())


def _batch(texts: list[bytes]) -> pa.RecordBatch:
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array(texts, pa.binary())],
        names=["doc_id", "row_key", "text"],
    )


def test_character_pairs_are_counted_in_parts(spark, monkeypatch):
    texts = [b"abc def", b"", b"x" * 70_000, b"9/+=" * 20_000, b"\xc3\xa9t\xc3\xa9"] * 12
    run = _run_of(secrets.scan_documents)
    found = [out.column(4)[-1].as_py() for out in run(iter([_batch(texts)]))][-1]
    codes = secrets.NUMBER[np.frombuffer(b"\n".join(texts), dtype=np.uint8)]
    want = np.bincount(codes[:-1] * secrets.WIDTH + codes[1:], minlength=secrets.WIDTH**2)
    assert found == want.tolist()
    assert _peak(lambda: list(run(iter([_batch(texts)])))) < 16 * sum(map(len, texts))


def test_words_of_a_segment_are_no_python_objects(spark):
    texts = [b" ".join(b"w%d" % (i * k % 977) for i in range(2000)) for k in range(1, 151)] + [b"", b"one"]
    run = _run_of(decontaminate.build_index)
    row = next(iter(run(iter([_batch(texts)])))).to_pylist()[0]
    words = [w for t in texts for w in decontaminate.words_of(t)]
    assert row["n_words"] == [len(t.split()) for t in texts]
    assert row["terms"].split(b"\n") == sorted(set(words))
    segment = decontaminate.Segment(row, sorted(set(words)))
    assert segment.sizes.sum() == len(words)
    # the words of all texts as objects are over 40 bytes each
    assert _peak(lambda: list(run(iter([_batch(texts)])))) < 40 * len(words)


def test_weights_do_not_depend_on_slices(spark, monkeypatch):
    rows = [(i, f"words of text {i % 7} and {'more ' * (i % 50)}", 10) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    labels = spark.createDataFrame([(i, int(i % 7 < 4), 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    found = []
    for size in (1 << 20, 300):
        monkeypatch.setattr(resample, "BATCH_BYTES", size)
        found.append(sorted(r.doc_id for r in resample.select_rows(docs, labels).collect()))
    assert found[0] == found[1] and found[0]
