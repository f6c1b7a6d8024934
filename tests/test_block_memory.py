"""Memory of a block's scores."""

import numpy as np

from corpusforge.operators import ranked


def test_block_scores_weigh_one_query_at_a_time():
    import tracemalloc

    import pyarrow as pa
    n, asks = 2048, 400
    docs, tfs = np.arange(n, dtype=np.int32).tobytes(), np.ones(n, dtype=np.int32).tobytes()
    qids = list(range(asks))
    rows = pa.table({"block": [0] * 9, "docs": [docs] * 8 + [None], "tfs": [tfs] * 8 + [None], "ids": pa.array([None] * 8 + [list(range(n))], pa.list_(pa.int64())),
                     "lengths": pa.array([None] * 8 + [[5] * n], pa.list_(pa.int64())), "avgdl": pa.array([5.0] * 8 + [None]),
                     "qids": pa.array([qids] * 8 + [None], pa.list_(pa.int64())), "weights": pa.array([[1.0] * asks] * 8 + [None], pa.list_(pa.float64()))})
    run = ranked._score_blocks(3, 1.2, 0.75, 6, pa.int64(), pa.int64())
    tracemalloc.start()
    out = run(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == 3 * asks and peak < 8 * n * 8 * asks / 4  # a weighed copy for each query and list takes four times that
